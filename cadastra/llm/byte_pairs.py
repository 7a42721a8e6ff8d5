"""Byte-level BPE: texts to token ids through an index of pair occurrences, and ids back to texts.

A task takes its texts in groups of about GROUP_BYTES and cuts them into the
pieces that merges do not cross. The distinct pieces that it has not met yet lie
end to end as one linked sequence of symbols. The pair index maps the rank of every pair
that can be merged to all places where it stands. Ranks are applied in ascending
order, each at all its places from left to right; a merge changes the pairs with both
neighbours, whose new places go into the lists of their ranks. As a rank's
symbols are made by lower ranks only (checked when the vocabulary is read), no pair of a
lower rank comes up again, so pieces that lie together do not influence one another.
"""

from __future__ import annotations

import json
import re
from collections.abc import Callable, Iterable, Iterator
from heapq import heapify, heappop, heappush
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .storage import text_batches

#: Bytes of texts whose new pieces are indexed together.
GROUP_BYTES = 4 << 20
#: Pieces and runs between spaces whose ids a Python worker keeps.
CACHE_PIECES = 500_000

#: Fixed value: the published pattern of byte-level pieces.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: A character outside these blocks may be newer than one of the two pattern libraries; such texts are cut by the tokenizer's own.
_COMMON = "\u0000-՗֐-߿ -⁯₠-₿　-ヿ一-鿿가-힣"
END = -1


def byte_alphabet() -> list[str]:
    """The character that stands for each byte in a byte-level vocabulary: printable ones for themselves, others from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = iter(range(256, 512))
    return [chr(b) if b in set(plain) else chr(next(rest)) for b in range(256)]


class BytePairs:
    """A byte-level BPE vocabulary file of the tokenizers library."""

    def __init__(self, path: str):
        import regex
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as f:
            data = json.load(f)
        model, kind = data["model"], data["pre_tokenizer"]
        plain = data["normalizer"] is None and kind == {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": kind["trim_offsets"], "use_regex": True}
        added = data["added_tokens"]
        if not plain or model.get("dropout") or model.get("ignore_merges") or any(a["lstrip"] or a["rstrip"] or a["single_word"] for a in added):
            raise ValueError(f"{path}: not a plain byte-level BPE vocabulary")
        vocab = model["vocab"]
        alphabet = byte_alphabet()
        back = {c: b for b, c in enumerate(alphabet)}
        self.size = max(max(vocab.values()), *(a["id"] for a in added), 0) + 1
        self.bytes = [b""] * self.size
        for token, i in vocab.items():
            self.bytes[i] = bytes(back[c] for c in token)
        self.first = np.array([vocab[c] for c in alphabet], np.int64)
        #: (left * size + right) -> rank, and what each rank makes
        self.rank: dict[int, int] = {}
        self.merges: list[tuple[int, int, int]] = []
        made = {int(i): -1 for i in self.first}
        for r, pair in enumerate(model["merges"]):
            a, b = pair.split(" ") if isinstance(pair, str) else pair
            left, right, whole = vocab[a], vocab[b], vocab[a + b]
            if left not in made or right not in made or whole in made:
                raise ValueError(f"{path}: merge {r} is made of symbols that come later")
            made[whole] = r
            self.rank[left * self.size + right] = r
            self.merges.append((left, right, whole))
        self.byte_rank = np.full((256, 256), -1, np.int64)
        of_byte = {int(i): b for b, i in enumerate(self.first)}
        for r, (left, right, _) in enumerate(self.merges):
            if left in of_byte and right in of_byte:
                self.byte_rank[of_byte[left], of_byte[right]] = r
        self.special = {a["content"]: a["id"] for a in added}
        for content, i in self.special.items():
            self.bytes[i] = content.encode()
        self._special = regex.compile("(" + "|".join(regex.escape(c) for c in sorted(self.special, key=len, reverse=True)) + ")") if added else None
        self._odd = regex.compile(f"[^{_COMMON}]")
        self._pieces = regex.compile(PATTERN)
        self._library = Tokenizer.from_file(path).pre_tokenizer
        # a space before white space, or one at the end after it: then runs between spaces hang on each other
        self._uneven = re.compile(r" \s|\s \Z")
        #: Ids of what follows a space, up to the next one or as a piece, and of pieces without a space before
        self.known: dict[str, bytes] = {}
        self.bare: dict[str, bytes] = {}

    def pieces(self, text: str) -> list[str]:
        if self._odd.search(text) is None:
            return self._pieces.findall(text)
        return [text[a:b] for _, (a, b) in self._library.pre_tokenize_str(text)]

    def merged(self, pieces: list[bytes]) -> list[list[int]]:
        """Ids of each piece, none of them empty, all through one index of pairs."""
        if not pieces:
            return []
        size, rank, merges = self.size, self.rank, self.merges
        lengths = np.array([len(p) for p in pieces], np.int64)
        data = np.frombuffer(b"".join(pieces), np.uint8)
        n = len(data)
        edge = np.cumsum(lengths)
        last = np.zeros(n, bool)
        last[edge - 1] = True
        symbol = self.first[data].tolist()
        after = np.where(last, END, np.arange(1, n + 1))
        first = np.zeros(n, bool)
        first[edge - lengths] = True
        before = np.where(first, END, np.arange(-1, n - 1)).tolist()
        ranks = np.full(n, -1, np.int64)
        ranks[:-1] = np.where(last[:-1], -1, self.byte_rank[data[:-1], data[1:]])
        after = after.tolist()
        there = np.flatnonzero(ranks >= 0)
        there = there[np.argsort(ranks[there], kind="stable")]
        active, begin = np.unique(ranks[there], return_index=True)
        index: dict[int, list[int]] = {r: p.tolist() for r, p in zip(active.tolist(), np.split(there, begin[1:]), strict=True)} if len(there) else {}
        heap = active.tolist()
        heapify(heap)
        while heap:
            r = heappop(heap)
            left, right, whole = merges[r]
            for p in sorted(index.pop(r)):
                q = after[p]
                # the place may have been merged since, or overlap with the one before
                if symbol[p] != left or q == END or symbol[q] != right:
                    continue
                symbol[p], symbol[q] = whole, END
                s = after[q]
                after[p] = s
                if s != END:
                    before[s] = p
                    new = rank.get(whole * size + symbol[s])
                    if new is not None:
                        if new in index:
                            index[new].append(p)
                        else:
                            index[new] = [p]
                            heappush(heap, new)
                s = before[p]
                if s != END:
                    new = rank.get(symbol[s] * size + whole)
                    if new is not None:
                        if new in index:
                            index[new].append(s)
                        else:
                            index[new] = [s]
                            heappush(heap, new)
        left = np.array(symbol, np.int64)
        kept = np.flatnonzero(left != END)
        ids, cut = left[kept].tolist(), np.searchsorted(kept, edge).tolist()
        return [ids[a:b] for a, b in zip([0, *cut[:-1]], cut, strict=True)]

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of each text, as little-endian unsigned 32-bit numbers."""
        plans = []
        for text in texts:
            parts = self._special.split(text) if self._special is not None and self._special.search(text) else (text,)
            for i, part in enumerate(parts):
                if i % 2:
                    plans.append((None, [part], ()))
                elif not part or self._odd.search(part) or self._uneven.search(part):
                    plans.append((None, (), self.pieces(part) if part else ()))
                else:
                    first, *runs = part.split(" ")
                    plans.append((runs, (), self._pieces.findall(first)))
            plans.append(None)
        known, bare = self.known, self.bare
        runs = {r: self._pieces.findall(" " + r) for r in set().union(*[x[0] for x in plans if x and x[0]]).difference(known)}
        new = set(chain.from_iterable(runs.values())).union(*[x[2] for x in plans if x and x[2]])
        new = [x for x in new if (x[1:] not in known if x[0] == " " else x not in bare)]
        found = dict(zip(new, (np.array(i, "<u4").tobytes() for i in self.merged([x.encode() for x in new])), strict=True))
        full = len(known) + len(bare) + len(new) + len(runs) > CACHE_PIECES
        for x, i in found.items():
            if x[0] == " ":
                known[x[1:]] = i
            else:
                bare[x] = i

        def ids(pieces: Iterable[str]) -> bytes:
            return b"".join([known[x[1:]] if x[0] == " " else bare[x] for x in pieces])

        known.update({r: ids(pieces) for r, pieces in runs.items()})
        look = known.__getitem__
        out, own = [], []
        for plan in plans:
            if plan is None:
                out.append(b"".join(own))
                own = []
                continue
            own.append(ids(plan[2]))
            own.extend(self.special[x].to_bytes(4, "little") for x in plan[1])
            if plan[0]:
                own.append(b"".join(map(look, plan[0])))
        if full:
            # what does not fit into the cache was known to this group alone
            for x in new:
                if x[0] == " ":
                    known.pop(x[1:], None)
                else:
                    bare.pop(x, None)
            for r in runs:
                known.pop(r, None)
        return out


_vocabularies: dict[str, BytePairs] = {}


def vocabulary(path: str) -> BytePairs:
    """One per Python worker, so that what it has merged serves later tasks."""
    if path not in _vocabularies:
        _vocabularies[path] = BytePairs(path)
    return _vocabularies[path]


def _groups(batch: pa.RecordBatch, column: str, size: int) -> Iterator[pa.RecordBatch]:
    """Runs of rows with about ``size`` bytes in a column, a row at least."""
    ends = np.cumsum(np.array([len(x.as_buffer()) if x.is_valid else 0 for x in batch.column(column)], np.int64))
    row = 0
    while row < batch.num_rows:
        begin = ends[row - 1] if row else 0
        end = max(row + 1, int(np.searchsorted(ends, begin + size, "right")))
        yield batch.slice(row, end - row)
        row = end


def _encode(path: str) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = vocabulary(path)
        for batch in batches:
            for group in _groups(batch, "text", GROUP_BYTES):
                ids = coder.encode([t or "" for t in group.column("text").to_pylist()])
                offsets = np.cumsum([0, *(len(i) // 4 for i in ids)], dtype=np.int32)
                ids = np.frombuffer(b"".join(ids), np.int32)
                own = group.drop_columns(["text"])
                yield pa.record_batch([*own.columns, pa.ListArray.from_arrays(pa.array(offsets), pa.array(ids))], names=[*own.schema.names, "ids"])

    return run


def encoded(docs: DataFrame, path: str, text: str = "text") -> DataFrame:
    """Rows of ``docs`` with the token ids of their texts in place of the text: ids array<int>.

    The vocabulary's special strings in a text become their ids; none are added.
    A null text is an empty one, without ids. Every row stays, repeated ones too; a column
    named ids is replaced. Texts of any length are taken whole.
    """
    text_batches(docs)
    rest = [c for c in docs.columns if c not in (text, "ids")]
    schema = "".join(f"`c{i}` {docs.schema[c].dataType.simpleString()}, " for i, c in enumerate(rest))
    own = docs.select(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(rest)], F.col(f"`{text}`").cast("string").alias("text"))
    out = own.mapInArrow(_encode(path), f"{schema}ids array<int>")
    return out.select(*[F.col(f"c{i}").alias(c) for i, c in enumerate(rest)], "ids")


def _decode(path: str, keep_ids: bool) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = vocabulary(path)
        # the id after the last stands for those that the vocabulary lacks
        size = np.array([*map(len, coder.bytes), 0], np.int64)
        data = np.frombuffer(b"".join(coder.bytes), np.uint8)
        begin = np.cumsum(size) - size
        for batch in batches:
            texts = []
            for ids in batch.column("ids"):
                if not ids.is_valid:
                    texts.append(None)
                    continue
                own = ids.values.to_numpy(zero_copy_only=False)
                own = np.where(np.isnan(own), -1, own).astype(np.int64) if own.dtype.kind == "f" else own.astype(np.int64)
                own = np.where((own < 0) | (own >= coder.size), coder.size, own)
                n = size[own]
                at = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(begin[own], n)
                texts.append(data[at].tobytes().decode("utf-8", "replace"))
            kept = batch if keep_ids else batch.drop_columns(["ids"])
            yield pa.record_batch([*kept.columns, pa.array(texts, pa.string())], names=[*kept.schema.names, "decoded"])

    return run


def decoded(rows: DataFrame, path: str, ids: str = "ids", keep_ids: bool = False) -> DataFrame:
    """Rows with the text of their ids in column decoded, in place of the ids or beside them.

    Special ids give their strings; ids that the vocabulary lacks, null ones too, give
    nothing; bytes that are no UTF-8 give U+FFFD. A null list gives a null text. A column
    named decoded is replaced.
    """
    rest = [c for c in rows.columns if c not in (ids, "decoded")]
    schema = "".join(f"`c{i}` {rows.schema[c].dataType.simpleString()}, " for i, c in enumerate(rest))
    schema += f"ids {rows.schema[ids].dataType.simpleString()}, " if keep_ids else ""
    own = rows.select(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(rest)], F.col(f"`{ids}`").alias("ids"))
    out = own.mapInArrow(_decode(path, keep_ids), f"{schema}decoded string")
    return out.select(*[F.col(f"c{i}").alias(c) for i, c in enumerate(rest)], *([F.col("ids").alias(ids)] if keep_ids else []), "decoded")
