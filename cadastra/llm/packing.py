"""Best-fit packing of token sequences by hierarchical merging of residual bins.

Pieces, without their texts, are dealt evenly to partitions, so that each has
every kind of length, and every partition packs all of its pieces best-fit in
decreasing length. Bins that are full are done. Underfull bins are sent on as items to fewer partitions
and packed again, until one partition is left or their number no longer falls.
A bin carries its pieces, so rounds move only underfull bins and need no joins.
"""

from __future__ import annotations

import re
import zlib
from array import array
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .storage import text_batches, written

CAPACITY = 2048
END_ID = 0
#: Unused places in a bin that counts as full.
SLACK = 0
#: Pieces that a partition of the first round gets, and bins one of a merge round, about.
MERGE_ITEMS = 50_000
FAN_IN = 8
#: Pieces in a row that are packed together where sequences follow an order.
WINDOW_ITEMS = 4096
#: Runs of characters whose ids a Python worker keeps.
CACHE_RUNS = 450_000
#: New words that the library encodes as one text.
JOINED_WORDS = 64
#: Texts looked up at once.
GROUP = 256

#: Ends a token that ends a word, in the vocabulary file.
WORD_END = "</w>"
#: Marks that usually follow a word.
MARKS = ".,;:!?"

#: The vocabulary's special strings.
_SPECIAL = re.compile(r"<\|(?:startoftext|endoftext)\|>")
#: A character that the normaliser may treat otherwise than str.lower() does.
_OTHER = re.compile("[^\t\n\r -~À-ÖØ-öø-įı-ſ–-„€]")

PIECES = "piece int, start long, length long, ids_crc32 long"


class Ids:
    """Token ids of texts as little-endian bytes: a run between blanks is encoded once and looked up.

    The vocabulary's pattern never joins characters across blanks, so the ids of
    a text are those of its runs one after the other; nor does it join letters
    with other characters, so letters before a run's last marks are looked up by
    themselves. Words of letters are one match of the pattern each and thus end
    at the first id that ends a word: many are encoded as one text and cut there.
    Other than plain texts go to the library whole.
    """

    def __init__(self, vocabulary: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(vocabulary)
        self.known: dict[str, bytes] = {}
        size = self.tokenizer.get_vocab_size()
        self.ends = np.array([(self.tokenizer.id_to_token(i) or "").endswith(WORD_END) for i in range(size)])

    def _encode(self, texts: list[str]) -> list[bytes]:
        found = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [array("I", x.ids).tobytes() for x in found]

    def _encode_words(self, words: list[str]) -> dict[str, bytes]:
        """Ids of distinct words of letters."""
        known = {}
        groups = [words[at : at + JOINED_WORDS] for at in range(0, len(words), JOINED_WORDS)]
        for group, data in zip(groups, self._encode([" ".join(g) for g in groups]), strict=True):
            ends = (np.flatnonzero(self.ends[np.frombuffer(data, np.uint32)]) + 1).tolist()
            if len(ends) != len(group):
                known.update(zip(group, self._encode(group), strict=True))
                continue
            at = 0
            for word, end in zip(group, ends, strict=True):
                known[word] = data[4 * at : 4 * end]
                at = end
        return known

    def _runs(self, runs: list[str]) -> dict[str, bytes]:
        """Ids of distinct runs that are not known."""
        known, found, cores, alone = self.known, {}, [], []
        for run in runs:
            core = run.rstrip(MARKS)
            if not core.isalpha():
                alone.append(run)
            elif core is run or len(core) == len(run):
                cores.append((run, run, ""))
            else:
                cores.append((run, core, run[len(core) :]))
        if alone:
            found.update(zip(alone, self._encode(alone), strict=True))
        found.update(self._encode_words(list({c for _, c, _ in cores if c not in known})))
        tails = list({t for _, _, t in cores})
        tail_ids = dict(zip(tails, self._encode(tails), strict=True))
        for run, core, tail in cores:
            if tail:
                found[run] = (found[core] if core in found else known[core]) + tail_ids[tail]
        return found

    def of(self, texts: list[str]) -> list[bytes]:
        runs = [None if _OTHER.search(t) or _SPECIAL.search(t) else t.lower().split() for t in texts]
        known = self.known
        found = self._runs([w for w in set().union(*[r for r in runs if r]) if w not in known])
        if len(known) + len(found) <= CACHE_RUNS:
            known.update(found)
            return [self._encode([t])[0] if r is None else b"".join([known[w] for w in r]) for t, r in zip(texts, runs, strict=True)]
        return [self._encode([t])[0] if r is None else b"".join([known[w] if w in known else found[w] for w in r]) for t, r in zip(texts, runs, strict=True)]


_ids: dict[str, Ids] = {}


def ids_of(vocabulary: str) -> Ids:
    """One per Python worker, so that what it has looked up serves later tasks."""
    if vocabulary not in _ids:
        _ids[vocabulary] = Ids(vocabulary)
    return _ids[vocabulary]


def _piece_rows(vocabulary: str, capacity: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids = ids_of(vocabulary)
        end = END_ID.to_bytes(4, "little")
        for batch in batches:
            rows, piece, start, length, crc = [], [], [], [], []
            texts = batch.column("text")
            coded = (d for at in range(0, len(texts), GROUP) for d in ids.of([t or "" for t in texts.slice(at, GROUP).to_pylist()]))
            for row, data in enumerate(coded):
                data += end
                for k, at in enumerate(range(0, len(data), 4 * capacity)):
                    part = data[at : at + 4 * capacity]
                    rows.append(row)
                    piece.append(k)
                    start.append(at // 4)
                    length.append(len(part) // 4)
                    crc.append(zlib.crc32(part))
            columns = [pa.array(piece, pa.int32()), pa.array(start, pa.int64()), pa.array(length, pa.int64()), pa.array(crc, pa.int64())]
            kept = batch.drop_columns(["text"]).take(pa.array(rows, pa.int64()))
            yield pa.record_batch([*kept.columns, *columns], names=[*kept.schema.names, "piece", "start", "length", "ids_crc32"])

    return run


def pieces(docs: DataFrame, vocabulary: str, text: str = "text", capacity: int = CAPACITY) -> DataFrame:
    """Rows of ``docs`` without text, one per piece: piece, start, length, ids_crc32.

    A null text is an empty one and has the end id alone. Only documents longer
    than ``capacity`` are cut. Columns of the names above are replaced.
    """
    text_batches(docs)
    names = ("piece", "start", "length", "ids_crc32", text)
    rest = [c for c in docs.columns if c not in names]
    schema = ", ".join(f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in rest)
    own = docs.select(*[F.col(f"`{c}`") for c in rest], F.col(f"`{text}`").cast("string").alias("text"))
    return own.mapInArrow(_piece_rows(vocabulary, capacity), f"{schema}, {PIECES}" if rest else PIECES)


def best_fit(lengths: list[int], capacity: int) -> list[list[int]]:
    """Bins as lists of item numbers: longest item first, into the bin it fills best.

    Open bins are kept by free places; a bit mask of the sizes that occur gives
    the smallest fitting one in constant time.
    """
    bins: list[list[int]] = []
    by_free: list[list[int]] = [[] for _ in range(capacity + 1)]
    mask = 0
    for i in sorted(range(len(lengths)), key=lambda i: -lengths[i]):
        need = lengths[i]
        fits = mask >> need
        if fits:
            free = need + (fits & -fits).bit_length() - 1
            b = by_free[free].pop()
            if not by_free[free]:
                mask ^= 1 << free
        else:
            free, b = capacity, len(bins)
            bins.append([])
        bins[b].append(i)
        left = free - need
        if left:
            by_free[left].append(b)
            mask |= 1 << left
    return bins


def _packed(capacity: int, window: int | None) -> Callable:
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        whole = pd.concat(list(frames), ignore_index=True)
        step = window or len(whole)
        for at in range(0, len(whole), step):
            rows = whole.iloc[at : at + step]
            lengths, first, members = (rows[c].tolist() for c in ("used", "first", "members"))
            found = best_fit(lengths, capacity)
            used = [sum(lengths[i] for i in b) for b in found]
            joined = [[m for i in b for m in members[i]] for b in found]
            yield pd.DataFrame({"used": used, "items": [len(x) for x in joined], "first": [min(first[i] for i in b) for b in found], "members": joined})

    def guarded(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rows = [x for x in frames if len(x)]
        if rows:
            yield from run(iter(rows))

    return guarded


def pack(items: DataFrame, length: str = "length", capacity: int = CAPACITY, slack: int = SLACK, order: str | None = None) -> DataFrame:
    """Rows of ``items`` with sequence_id and offset, each sequence at most ``capacity`` long.

    Lengths are 1 to ``capacity``. Offsets have no gaps. Items of any columns.
    Ties are dealt as they come. Sequences are numbered by the least whole number
    that their items have in column ``order``; items near to each other in it are
    packed together. Without it the numbers of sequences mean nothing.

    After a round, no two bins of a partition fit together, so at most one of
    them is half empty, and bins that are not cannot join each other. Partitions
    are merged until each has MERGE_ITEMS underfull bins; the rounds left out then
    could save one sequence a partition at most.
    """
    spark = items.sparkSession
    rest = [c for c in items.columns if c not in ("sequence_id", "offset")]
    payload = F.struct(*[F.col(f"`{c}`") for c in rest])
    schema = "used long, items int, first long, members array<" + items.select(payload.alias("m")).schema["m"].dataType.simpleString() + ">"
    items = written(items, "pieces")
    bins = items.select(F.col(length).cast("long").alias("used"), F.lit(1).alias("items"), (F.col(f"`{order}`") if order else F.lit(0)).cast("long").alias("first"), F.array(payload).alias("members"))
    wanted = max(1, -(-items.count() // MERGE_ITEMS))
    # without an order, neighbouring rows, of like lengths perhaps, go to different partitions
    bins = bins.repartitionByRange(wanted, "first").sortWithinPartitions("first") if order else bins.repartition(wanted)
    done, parts, window = None, wanted, WINDOW_ITEMS if order else None
    while True:
        bins = written(bins.mapInPandas(_packed(capacity, window), schema), "bins")
        full = bins.where(F.col("used") >= capacity - slack)
        done = full if done is None else done.unionByName(full)
        bins = bins.where(F.col("used") < capacity - slack)
        rows = bins.count()
        merged = max(1, -(-rows // MERGE_ITEMS), -(-parts // FAN_IN))
        # after windows, which leave a bin each, partitions are packed once as wholes
        if rows == 0 or (merged >= parts and not window):
            done = done.unionByName(bins)
            break
        parts, window = merged, None
        # bins of every fill go to every partition, so that each can complete others
        bins = bins.repartition(parts)
    done = done.orderBy("first") if order else done
    numbered = done.withColumn("sequence_id", F.monotonically_increasing_id())
    each = numbered.select("sequence_id", F.posexplode("members").alias("_pos", "m")).select("m.*", "sequence_id", "_pos")
    before = Window.partitionBy("sequence_id").orderBy("_pos").rowsBetween(Window.unboundedPreceding, -1)
    return each.withColumn("offset", F.coalesce(F.sum(length).over(before), F.lit(0)).cast("long")).drop("_pos")


def pack_documents(docs: DataFrame, vocabulary: str, text: str = "text", capacity: int = CAPACITY) -> DataFrame:
    """Documents as pieces packed into sequences; see :func:`pieces` and :func:`pack`."""
    return pack(pieces(docs, vocabulary, text, capacity), "length", capacity)
