"""Vectorised words and word shingles over Arrow string columns.

Texts are laid end to end as bytes and read in blocks that end between words,
so the cost is a few numpy passes per byte and a very long text takes no more
memory for its bytes than a short one. Words are the byte runs
``[^\\x20\\x09-\\x0D]+``; they are known by a 64-bit multilinear hash: a sum of
(byte + 1) times a random number of the place in the word. Two different words
hash alike for at most one in 2^55 choices of these numbers, whatever the words.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

#: Bytes of texts in a chunk of rows, and of a block that is hashed at once.
CHUNK_BYTES = 1 << 19
BLOCK_BYTES = 1 << 18

_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def mix(x: np.ndarray, seed: int = 0) -> np.ndarray:
    """A bijection of 64-bit integers that spreads every input bit."""
    x = x + np.uint64((seed * 0x9E3779B97F4A7C15 + 0x632BE59BD9B4E019) % 2**64)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _factors(n: int, seed: int) -> np.ndarray:
    """Odd random numbers of the first n places."""
    return mix(np.arange(n, dtype=np.uint64), seed) | np.uint64(1)


def text_buffers(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string column and its n + 1 offsets; a null counts as empty."""
    texts = texts.combine_chunks() if isinstance(texts, pa.ChunkedArray) else texts
    if texts.null_count:
        texts = texts.fill_null("")
    wide = pa.types.is_large_string(texts.type)
    if not len(texts):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = texts.buffers()
    offsets = np.frombuffer(offsets, np.int64 if wide else np.int32)
    offsets = offsets[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
    data = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def chunks(batch: pa.RecordBatch, text: str, size: int = CHUNK_BYTES) -> Iterator[pa.RecordBatch]:
    """The batch cut into runs of rows with about ``size`` bytes of text, a row at least."""
    _, offsets = text_buffers(batch.column(text))
    row, n = 0, batch.num_rows
    while row < n:
        end = int(np.searchsorted(offsets, offsets[row] + size, "right")) - 1
        end = min(max(end, row + 1), n)
        yield batch.slice(row, end - row)
        row = end


def _block_words(data: np.ndarray, cut: np.ndarray, at: int, lower: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts, ends and hashes of a block's words; ``cut`` holds the places where a row begins."""
    inside = ~_SPACE[data]
    before = np.zeros(len(data), bool)
    before[1:] = inside[:-1]
    before[cut] = False
    starts = np.flatnonzero(inside & ~before)
    if not len(starts):
        return starts, starts, np.zeros(0, np.uint64)
    after = np.zeros(len(data), bool)
    after[:-1] = inside[1:] & before[1:]
    ends = np.flatnonzero(inside & ~after) + 1
    lengths = ends - starts
    kept = np.flatnonzero(inside)
    place = np.arange(len(kept)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    bytes_ = (_LOWER[data[kept]] if lower else data[kept]).astype(np.uint64) + np.uint64(1)
    sums = np.add.reduceat(bytes_ * _factors(int(lengths.max()), 5)[place], np.cumsum(lengths) - lengths)
    return starts + at, ends + at, mix(sums)


class Words:
    """The words of a chunk: byte spans, hashes and the row each belongs to."""

    def __init__(self, texts: pa.Array, lower: bool = False, block: int = BLOCK_BYTES):
        self.data, offsets = text_buffers(texts)
        found = []
        at, n = 0, len(self.data)
        borders = offsets[1:-1]
        while at < n:
            end = min(at + block, n)
            # a block ends where no word goes on
            while end < n and not _SPACE[self.data[end]]:
                step = np.flatnonzero(_SPACE[self.data[end : end + block]])
                end = end + int(step[0]) if len(step) else min(end + block, n)
            lo, hi = np.searchsorted(borders, [at, end])
            found.append(_block_words(self.data[at:end], borders[lo:hi] - at, at, lower))
            at = end
        none = np.zeros(0, np.int64)
        self.starts, self.ends = (np.concatenate([f[i] for f in found]) if found else none for i in (0, 1))
        self.hashes = np.concatenate([f[2] for f in found]) if found else np.zeros(0, np.uint64)
        #: number of the first word of each row, and of the word after the last
        self.bounds = np.searchsorted(self.starts, offsets)
        self.counts = np.diff(self.bounds)
        self.rows = np.repeat(np.arange(len(self.counts)), self.counts)

    def grams(self, k: int, seed: int = 0) -> np.ndarray:
        """Hash of the k words from each position on, also where they run into the next row."""
        n = len(self.hashes) - k + 1
        if n <= 0:
            return np.zeros(0, np.uint64)
        total = np.zeros(n, np.uint64)
        for j, factor in enumerate(_factors(k, 6 + seed)):
            total += self.hashes[j : j + n] * factor
        return mix(total, seed)

    def whole(self, k: int) -> np.ndarray:
        """Positions with k words left in their row."""
        if len(self.hashes) < k:
            return np.zeros(0, np.int64)
        left = self.bounds[1:][self.rows] - np.arange(len(self.rows))
        return np.flatnonzero(left >= k)


def shingle_sets(texts: pa.Array, k: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """Distinct k-word shingles of each lower-cased text, as (row, hash) sorted by both.

    A text of fewer than k words has the whole sequence as its one shingle;
    a text without words has none.
    """
    words = Words(texts, lower=True)
    at = words.whole(k)
    rows, hashes = words.rows[at], words.grams(k)[at]
    short = np.flatnonzero((words.counts > 0) & (words.counts < k))
    if len(short):
        own = np.zeros(len(short), np.uint64)
        for j, factor in enumerate(_factors(k, 6)[: k - 1]):
            has = words.counts[short] > j
            own[has] += words.hashes[words.bounds[short[has]] + j] * factor
        rows = np.concatenate((rows, short))
        hashes = np.concatenate((hashes, mix(own, 77) ^ words.counts[short].astype(np.uint64)))
    order = np.argsort(hashes)
    narrow = rows.astype(np.uint16) if len(words.counts) < 2**16 else rows
    order = order[np.argsort(narrow[order], kind="stable")]
    rows, hashes = rows[order], hashes[order]
    keep = np.ones(len(rows), bool)
    keep[1:] = (rows[1:] != rows[:-1]) | (hashes[1:] != hashes[:-1])
    return rows[keep], hashes[keep]
