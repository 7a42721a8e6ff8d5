"""Substring de-duplication with prefix-partitioned suffix trees.

A repeat is a run of ``window`` words that starts at two places of the corpus.
Suffixes are sampled: in every window the leftmost k-word prefix with the
smallest hash is taken, so equal windows sample equal suffixes at equal
offsets. Sampled suffixes are dealt out by that prefix. A prefix found once is
a leaf and needs no tree. A prefix group that fits in memory becomes a subtree:
its suffixes are sorted by words and neighbouring common-prefix lengths give
the internal nodes; the words left of the sample are sorted the same way, so a
node of depth ``window - j`` whose members also share ``j`` words to the left
is a repeat. The windows of a group too large for memory are sampled again by a
prefix half as long again (8, 12, 18, 27 words), which splits the group; equal
windows stay together, as they sample alike each time. Where 27 words still
leave a group too large, the prefix is the window itself: its group is one node
of full depth, and its members are counted with partial sums.

Words are compared by 64-bit hashes; two different windows are alike for at most one in 2^55 choices of their random factors (:mod:`.words`).
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .storage import bucketed, distinct_texts, sized, text_batches, text_key, written
from .words import Words, chunks

WINDOW = 35
PREFIX = 8
#: Rows of a group that one task sorts; a row takes about 1 kB there.
GROUP_ROWS = 1 << 16
#: Suffixes sorted at once in a task; whole groups, so a group may exceed it.
TREE_ROWS = 16384

_SAMPLES = pa.schema([("prefix", pa.int64()), ("key", pa.binary()), ("pos", pa.int32())])
_SEGMENTS = pa.schema([("prefix", pa.int64()), ("key", pa.binary()), ("first", pa.int32()), ("lead", pa.int32()), ("starts", pa.int32()), ("body", pa.string())])
_WINDOWS = pa.schema([("w1", pa.int64()), ("w2", pa.int64()), ("key", pa.binary()), ("first", pa.int32())])
_SPANS = pa.schema([("key", pa.binary()), ("first", pa.int32()), ("last", pa.int32())])


def prefix_lengths(window: int, prefix: int) -> list[int]:
    """Words of the prefixes tried one after the other, all shorter than the window."""
    lengths = [prefix]
    while lengths[-1] * 3 // 2 < window:
        lengths.append(max(lengths[-1] + 1, lengths[-1] * 3 // 2))
    return lengths


def sampled(words: Words, starts: np.ndarray, window: int, prefix: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Sampled positions of the windows at ``starts``, their prefix hashes, and the range of starts each stands for."""
    if not len(starts):
        none = np.zeros(0, np.int64)
        return none, np.zeros(0, np.int64), none, none
    grams = words.grams(prefix)
    width, at, span = window - prefix + 1, np.arange(len(grams)), 1

    def smaller(shift: int, at: np.ndarray) -> np.ndarray:
        a, b = at[: len(at) - shift], at[shift:]
        return np.where(grams[a] <= grams[b], a, b)

    while span * 2 <= width:
        at, span = smaller(span, at), span * 2
    if span < width:
        at = smaller(width - span, at)
    own = at[starts]
    change = np.flatnonzero(np.concatenate(([True], (own[1:] != own[:-1]) | (starts[1:] != starts[:-1] + 1))))
    ends = np.concatenate((change[1:], [len(own)])) - 1
    pos = own[change]
    return pos, grams[pos].view(np.int64), starts[change], starts[ends]


def _binary(keys: pa.Array, rows: np.ndarray) -> pa.Array:
    return keys.take(pa.array(rows))


def _ranges(low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """All numbers from each low to its high."""
    counts = high - low + 1
    return np.repeat(low - (np.cumsum(counts) - counts), counts) + np.arange(counts.sum())


def _samples(part: pa.RecordBatch, words: Words, window: int, lengths: list[int]) -> tuple[np.ndarray, ...]:
    """Samples of a chunk by the last of the prefix lengths.

    Each length before it leaves the windows open whose samples stand in the row's
    list ``at0``, ``at1``, ...; a list of the last length picks its samples.
    """
    starts = words.whole(window)
    for level, prefix in enumerate(lengths):
        found = sampled(words, starts, window, prefix)
        if f"at{level}" in part.schema.names:
            lists = part.column(f"at{level}")
            listed = np.repeat(words.bounds[:-1], np.diff(np.asarray(lists.offsets))) + np.asarray(lists.flatten())
            keep = np.isin(found[0], listed)
            found = tuple(c[keep] for c in found)
        starts = _ranges(found[2], found[3])
    return found


def _sample_rows(window: int, lengths: list[int]) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in chunks(batch, "text"):
                words = Words(part.column("text"))
                pos, hashes, _, _ = _samples(part, words, window, lengths)
                rows = words.rows[pos]
                offsets = (pos - words.bounds[rows]).astype(np.int32)
                yield pa.record_batch([pa.array(hashes), _binary(part.column("key"), rows), pa.array(offsets)], schema=_SAMPLES)

    return run


def _segment_rows(window: int, lengths: list[int]) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in chunks(batch, "text"):
                words = Words(part.column("text"))
                pos, hashes, low, high = _samples(part, words, window, lengths)
                if not len(pos):
                    continue
                raw, rows = words.data.tobytes(), words.rows[pos]
                body = [raw[a:b].decode() for a, b in zip(words.starts[low].tolist(), words.ends[high + window - 1].tolist(), strict=True)]
                yield pa.record_batch(
                    [
                        pa.array(hashes),
                        _binary(part.column("key"), rows),
                        pa.array((low - words.bounds[rows]).astype(np.int32)),
                        pa.array((pos - low).astype(np.int32)),
                        pa.array((high - low + 1).astype(np.int32)),
                        pa.array(body, pa.string()),
                    ],
                    schema=_SEGMENTS,
                )

    return run


def _window_rows(window: int, lengths: list[int]) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in chunks(batch, "text"):
                words = Words(part.column("text"))
                _, _, low, high = _samples(part, words, window, lengths)
                if not len(low):
                    continue
                starts = _ranges(low, high)
                rows = words.rows[starts]
                yield pa.record_batch(
                    [
                        pa.array(words.grams(window, 1)[starts].view(np.int64)),
                        pa.array(words.grams(window, 2)[starts].view(np.int64)),
                        _binary(part.column("key"), rows),
                        pa.array((starts - words.bounds[rows]).astype(np.int32)),
                    ],
                    schema=_WINDOWS,
                )

    return run


def _tree_nodes(table: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rows of words sorted, as each row's place and the words shared with the row before it."""
    n, width = table.shape
    order = np.lexsort(table.T[::-1]) if width else np.arange(n)
    ranked = table[order]
    same = np.zeros((n, width + 1), bool)
    same[1:, :width] = ranked[1:] == ranked[:-1]
    shared = np.argmin(same, axis=1)
    place = np.empty(n, np.int64)
    place[order] = np.arange(n)
    return place, shared


def subtree_repeats(bodies: pa.Array, lead: np.ndarray, starts: np.ndarray, window: int, prefix: int) -> np.ndarray:
    """Which windows of each segment lie in a deep node with another one: rows x offsets."""
    words = Words(bodies)
    n, left = len(lead), window - prefix
    origin = words.bounds[:-1] + lead
    reach = origin[:, None] + np.arange(window)[None, :]
    padded = np.concatenate((words.hashes, np.zeros(1, np.uint64)))
    right = np.where(reach < words.bounds[1:, None], padded[np.minimum(reach, len(padded) - 1)], np.uint64(0))
    reach = origin[:, None] - 1 - np.arange(left)[None, :]
    before = np.where(reach >= words.bounds[:-1, None], padded[np.maximum(reach, 0)], np.uint64(0))
    place, shared = _tree_nodes(right)
    left_place, left_shared = _tree_nodes(before)
    found = np.zeros((n, left + 1), bool)
    for j in range(left + 1):
        here = np.flatnonzero((j <= lead) & (j > lead - starts))
        if len(here) < 2:
            continue
        node = np.cumsum(shared < window - j)[place[here]]
        beside = np.cumsum(left_shared < j)[left_place[here]] if j else 0
        _, group, size = np.unique(node * (n + 1) + beside, return_inverse=True, return_counts=True)
        found[here, j] = size[group] > 1
    return found


def _span_rows(table: pa.RecordBatch, window: int, prefix: int) -> pa.RecordBatch:
    first, lead, starts = (table.column(c).to_numpy() for c in ("first", "lead", "starts"))
    found = subtree_repeats(table.column("body"), lead, starts, window, prefix)[:, ::-1]
    edge = np.zeros((len(first), 1), bool)
    step = np.diff(np.concatenate((edge, found, edge), axis=1).astype(np.int8), axis=1)
    rows, begin = np.nonzero(step == 1)
    _, end = np.nonzero(step == -1)
    base = first[rows] + lead[rows] - (window - prefix)
    return pa.record_batch([_binary(table.column("key"), rows), pa.array((base + begin).astype(np.int32)), pa.array((base + end + window - 1).astype(np.int32))], schema=_SPANS)


def _trees(window: int, prefix: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []

        def rows() -> int:
            return sum(b.num_rows for b in held)

        for batch in batches:
            at = 0
            while at < batch.num_rows:
                piece = batch.slice(at, TREE_ROWS)
                at += piece.num_rows
                held.append(piece)
                if rows() < TREE_ROWS:
                    continue
                table = pa.Table.from_batches(held).combine_chunks().to_batches()[0]
                prefixes = table.column("prefix").to_numpy()
                cut = int(np.searchsorted(prefixes, prefixes[-1], "left"))
                if cut:
                    yield _span_rows(table.slice(0, cut), window, prefix)
                held = [table.slice(cut)]
        if rows():
            yield _span_rows(pa.Table.from_batches(held).combine_chunks().to_batches()[0], window, prefix)

    return run


def repeated_spans(texts: DataFrame, window: int = WINDOW, prefix: int = PREFIX, group_rows: int = GROUP_ROWS) -> DataFrame:
    """Spans of words covered by repeats: key, first, last (exclusive).

    ``texts`` has key, text and copies as :func:`distinct_texts` gives them, best
    bucketed by key, as it is read once for each prefix length in use. A text with
    copies repeats itself as a whole and is left to the caller; here each distinct
    text counts once. Spans of a text may touch or overlap.
    """
    lengths, lists, found = prefix_lengths(window, prefix), None, []

    def listed(rows: DataFrame, level: int) -> DataFrame:
        own = rows.groupBy("key").agg(F.collect_list("pos").alias(f"at{level}"))
        return own if lists is None else own.join(lists, "key")

    for level in range(len(lengths)):
        used = lengths[: level + 1]
        open_ = texts.select("key", "text") if lists is None else texts.join(lists, "key").drop("copies")
        samples = written(open_.mapInArrow(_sample_rows(window, used), "prefix long, key binary, pos int"), "samples")
        sizes = written(samples.groupBy("prefix").agg(F.count(F.lit(1)).alias("size")).where("size > 1"), "sizes")
        # one large prefix for every group_rows samples at most, so the rest has no hot key
        large = sized(sizes.where(F.col("size") > group_rows).select("prefix"))
        small = samples.join(large, "prefix", "left_anti").join(sizes.where(F.col("size") <= group_rows).select("prefix"), "prefix", "left_semi")
        segments = texts.join(listed(small, level), "key").drop("copies").mapInArrow(_segment_rows(window, used), "prefix long, key binary, first int, lead int, starts int, body string")
        found.append(segments.repartition("prefix").sortWithinPartitions("prefix").mapInArrow(_trees(window, used[-1]), "key binary, first int, last int"))
        if large.isEmpty():
            break
        lists = written(listed(samples.join(large, "prefix", "left_semi"), level), "lists")
    else:
        windows = texts.join(lists, "key").drop("copies").mapInArrow(_window_rows(window, lengths), "w1 long, w2 long, key binary, first int")
        deep = windows.groupBy("w1", "w2").agg(F.count(F.lit(1)).alias("size")).where("size > 1").drop("size")
        found.append(windows.join(deep, ["w1", "w2"]).select("key", "first", (F.col("first") + window).alias("last")))
    return reduce(DataFrame.unionByName, found)


def _removed_rows(window: int, rest: int, texts_out: bool) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in chunks(batch, "text"):
                words = Words(part.column("text"))
                n = len(words.hashes)
                edges = np.zeros(n + 1, np.int64)
                spans = part.column("spans")
                flat, counts = spans.flatten(), np.diff(np.asarray(spans.offsets))
                base = np.repeat(words.bounds[:-1], counts)
                np.add.at(edges, base + flat.field("first").to_numpy(), 1)
                np.add.at(edges, base + flat.field("last").to_numpy(), -1)
                gone = np.cumsum(edges[:n]) > 0
                copied = (part.column("copies").to_numpy() > 1) & (words.counts >= window)
                gone |= copied[words.rows]
                total = np.concatenate(([0], np.cumsum(gone)))
                removed = total[words.bounds[1:]] - total[words.bounds[:-1]]
                raw, kept, digests = words.data.tobytes(), [], []
                starts, ends, stays = words.starts.tolist(), words.ends.tolist(), (~gone).tolist()
                for a, b in zip(words.bounds[:-1].tolist(), words.bounds[1:].tolist(), strict=True):
                    text = b" ".join([raw[starts[i] : ends[i]] for i in range(a, b) if stays[i]])
                    digests.append(hashlib.sha256(text).hexdigest())
                    if texts_out:
                        kept.append(text.decode())
                names = [f"c{i}" for i in range(rest)]
                columns = [part.column(c) for c in names] + [pa.array(words.counts.astype(np.int64)), pa.array(removed.astype(np.int64)), pa.array(digests, pa.string())]
                names += ["n_words", "n_removed", "kept_sha256"]
                if texts_out:
                    columns, names = [*columns, part.column("text"), pa.array(kept, pa.string())], [*names, "own_text", "kept_text"]
                yield pa.record_batch(columns, names=names)

    return run


def remove_repeats(docs: DataFrame, text: str = "text", window: int = WINDOW, keep_text: bool = True) -> DataFrame:
    """Every row of ``docs`` with n_words, n_removed, kept_sha256 and, if asked for, kept_text.

    Each word covered by a window of ``window`` words whose sequence also starts
    anywhere else is removed, judged on the input; kept words are joined by one
    space. A null or wordless text has 0 words and keeps the empty text. Copies
    of a text of at least ``window`` words lose everything, the first included.
    Columns of ``docs`` stay, whatever their names, the text itself only with
    ``keep_text`` (a string then); result columns replace columns of the same names.

    Distinct texts are shuffled once and written in buckets of their key; rows
    and lists come to the buckets, so texts are not moved again.
    """
    text_batches(docs)
    texts = bucketed(distinct_texts(docs, text), "texts", "key")
    spans = repeated_spans(texts, window).groupBy("key").agg(F.collect_list(F.struct("first", "last")).alias("spans"))
    marked = texts.join(spans, "key", "left").select("key", "text", "copies", "spans")
    names = ("n_words", "n_removed", "kept_sha256", "kept_text")
    rest = [c for c in docs.columns if c not in (*names, text)]
    rows = docs.select(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(rest)], text_key(text).alias("key"))
    empty = F.array().cast("array<struct<first:int,last:int>>")
    joined = rows.join(marked, "key", "left").select(*[f"c{i}" for i in range(len(rest))], "text", F.coalesce("copies", F.lit(1)).alias("copies"), F.coalesce("spans", empty).alias("spans"))
    schema = ", ".join([*(f"c{i} {docs.schema[c].dataType.simpleString()}" for i, c in enumerate(rest)), "n_words long, n_removed long, kept_sha256 string"])
    out = joined.mapInArrow(_removed_rows(window, len(rest), keep_text), schema + ", own_text string, kept_text string" * keep_text)
    shown = [F.col("own_text").alias(c) if c == text else F.col(f"c{rest.index(c)}").alias(c) for c in docs.columns if c not in names and (keep_text or c != text)]
    return out.select(*shown, *names[: 3 + keep_text])
