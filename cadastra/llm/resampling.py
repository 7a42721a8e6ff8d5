"""Importance resampling towards a target distribution by hashed word runs of one and two.

Every feature (a word, or two words joined by a space) falls into the bucket
crc32 modulo BUCKETS. A bucket's gain compares its share in the target with its
share in the raw texts; a document weighs the mean gain of its features, and
Gumbel noise makes a draw without replacement out of a plain ranking.

CRCs are worked out from a vocabulary of head and tail. Head words, each at
least 1/HEAD_SHARE of all words, hence at most HEAD_SHARE of them, are broadcast
with the CRC of the word, of the word and a space, and their length. Pairs of
two words of at least 1/PAIR_SHARE each have their bucket in a broadcast table
of at most PAIR_SHARE squared entries. Any other word takes its CRC from its bytes, and
any other pair is the state after its first word, moved on by the length of the
second, with the CRC of the second put in. Both ways give the same exact numbers.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .storage import text_batches, written

BUCKETS = 10_000
#: Shares of all words, as one in so many, from which a word is in the head, and from which its pairs are.
HEAD_SHARE = 1 << 18
PAIR_SHARE = 1 << 10
#: Bytes of text worked on at once, and distinct words that a task counts before it sends them.
BLOCK_BYTES = 1 << 19
FLUSH_WORDS = 300_000
#: Lengths of words for which the moves of a CRC are tabled; longer words are read.
TABLED = 64

#: A-Z lowered; whatever is no digit, letter or byte of a character beyond ASCII is a blank.
_WORD_BYTES = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


def _moves() -> np.ndarray:
    """CRC registers moved on by 0 to TABLED zero bytes, by place and value of each of their four bytes."""
    step = np.array([zlib.crc32(bytes([b])) for b in range(256)], np.uint32) ^ np.uint32(zlib.crc32(b"\0"))
    moved = [np.arange(256, dtype=np.uint32)[None] << np.arange(0, 32, 8, dtype=np.uint32)[:, None]]
    for _ in range(TABLED):
        last = moved[-1]
        moved.append((last >> np.uint32(8)) ^ step[last & np.uint32(255)])
    return np.stack(moved)


_MOVES = _moves()
_BLANK = np.uint32(zlib.crc32(b" "))


def _moved(crc: np.ndarray, length: np.ndarray | int) -> np.ndarray:
    out = _MOVES[length, 0, crc & np.uint32(255)]
    for k in (1, 2, 3):
        out = out ^ _MOVES[length, k, (crc >> np.uint32(8 * k)) & np.uint32(255)]
    return out


@dataclass
class Head:
    """Frequent words with what their features' CRCs need; the first ``pairs`` of them have tabled pairs."""

    number: dict[bytes, int]
    crc: np.ndarray
    length: np.ndarray
    pairs: int
    pair_bucket: np.ndarray

    @classmethod
    def of(cls, words: list[bytes], pairs: int, buckets: int) -> Head:
        crc = np.array([zlib.crc32(w) for w in words], np.uint32)
        length = np.array([len(w) for w in words], np.int64)
        first = np.array([zlib.crc32(w + b" ") for w in words[:pairs]], np.uint32)
        table = np.zeros((pairs, pairs), np.uint32)
        for i, w in enumerate(words[:pairs]):
            short = len(w) <= TABLED
            table[:, i] = _moved(first, len(w)) ^ crc[i] if short else [zlib.crc32(w, int(s)) for s in first]
        return cls({w: i for i, w in enumerate(words)}, crc, length, pairs, (table % np.uint32(buckets)).astype(np.int32).ravel())


def word_blocks(texts: pa.Array, size: int = BLOCK_BYTES) -> Iterator[tuple[list[bytes], np.ndarray, bool]]:
    """(words, row of each, lead) of runs of texts of about ``size`` bytes; a longer text is cut between words.

    With ``lead`` the first word is the last one of the block before, there for its pair alone.
    """
    words: list[bytes] = []
    rows: list[int] = []
    counts: list[int] = []
    lead, held = False, 0

    def block() -> tuple[list[bytes], np.ndarray, bool]:
        return words, np.repeat(np.array(rows, np.int64), counts), lead

    for row, text in enumerate(texts):
        data = text.as_buffer() if text.is_valid else b""
        at, n = 0, len(data)
        data = bytes(data).translate(_WORD_BYTES) if n else b""
        while at < n:
            end = n
            if n - at > size and (end := data.find(b" ", at + size)) < 0:
                end = n
            own = data[at:end].split()
            words += own
            rows.append(row)
            counts.append(len(own))
            held += end - at
            at = end
            if held >= size:
                yield block()
                last = words[-1:] if at < n else []
                words, rows, counts, lead, held = list(last), [row] * len(last), [1] * len(last), bool(last), 0
    if words:
        yield block()


class Features:
    """Buckets of a block's words and pairs."""

    def __init__(self, words: list[bytes], rows: np.ndarray, lead: bool, head: Head, buckets: int):
        ids = np.fromiter(map(head.number.get, words, repeat(-1)), np.int64, len(words))
        tail = np.flatnonzero(ids < 0)
        if len(head.crc):
            crc, length = head.crc[ids], head.length[ids]
        else:
            crc, length = np.zeros(len(ids), np.uint32), np.zeros(len(ids), np.int64)
        crc[tail] = [zlib.crc32(words[i]) for i in tail]
        length[tail] = [len(words[i]) for i in tail]
        self.rows = rows[1:] if lead else rows
        self.words = (crc % np.uint32(buckets)).astype(np.int64)[int(lead) :]
        first = np.flatnonzero(rows[:-1] == rows[1:])
        self.pair_rows = rows[first]
        tabled = (ids < head.pairs) & (ids >= 0)
        both = tabled[first] & tabled[first + 1]
        pairs = np.zeros(len(first), np.int64)
        known, rest = first[both], first[~both]
        if len(known):
            pairs[both] = head.pair_bucket[ids[known] * head.pairs + ids[known + 1]]
        state, then = _moved(crc[rest], 1) ^ _BLANK, length[rest + 1]
        found = _moved(state, np.minimum(then, TABLED)) ^ crc[rest + 1]
        for i in np.flatnonzero(then > TABLED):
            found[i] = zlib.crc32(words[rest[i] + 1], int(state[i]))
        pairs[~both] = found % np.uint32(buckets)
        self.pairs = pairs


def _count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    known: Counter[bytes] = Counter()

    def sent() -> pa.RecordBatch:
        out = pa.record_batch([pa.array(list(known), pa.binary()), pa.array(list(known.values()), pa.int64())], names=["word", "n"])
        known.clear()
        return out

    for batch in batches:
        for words, _, lead in word_blocks(batch.column("text")):
            known.update(words)
            if lead:
                known[words[0]] -= 1
            if len(known) >= FLUSH_WORDS:
                yield sent()
    if known:
        yield sent()


def _text(df: DataFrame, text: str) -> DataFrame:
    text_batches(df)
    return df.select(F.col(f"`{text}`").cast("string").alias("text")).where("text is not null")


def word_counts(texts: DataFrame, text: str = "text") -> DataFrame:
    """(word binary, n): how often each word occurs in all texts. Tasks send their sums, so a frequent word costs a row per task."""
    return _text(texts, text).mapInArrow(_count_words, "word binary, n long").groupBy("word").agg(F.sum("n").alias("n")).where("n > 0")


def frequent_words(counts: DataFrame, buckets: int = BUCKETS, head_share: int = HEAD_SHARE, pair_share: int = PAIR_SHARE) -> Head:
    """The head of written word counts: at most ``head_share`` words, by share of all."""
    total = counts.agg(F.sum("n")).first()[0] or 0
    top = counts.where(F.col("n") * head_share >= total).collect()
    words = sorted(((r.n, bytes(r.word)) for r in top), key=lambda x: (-x[0], x[1]))
    return Head.of([w for _, w in words], sum(n * pair_share >= total for n, _ in words), buckets)


def _count_pairs(head: Broadcast, buckets: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            for words, rows, lead in word_blocks(batch.column("text")):
                total += np.bincount(Features(words, rows, lead, head.value, buckets).pairs, minlength=buckets)
        seen = np.flatnonzero(total)
        yield pa.record_batch([pa.array(seen), pa.array(total[seen])], names=["bucket", "n"])

    return run


def bucket_totals(texts: DataFrame, counts: DataFrame, head: Broadcast, text: str = "text", buckets: int = BUCKETS) -> np.ndarray:
    """Features of all texts in each bucket: words from their counts, pairs from the texts."""
    own = counts.select(F.pmod(F.crc32("word"), F.lit(buckets)).alias("bucket"), "n")
    pairs = _text(texts, text).mapInArrow(_count_pairs(head, buckets), "bucket long, n long")
    total = np.zeros(buckets, np.int64)
    for bucket, n in own.unionByName(pairs).groupBy("bucket").agg(F.sum("n")).collect():
        total[bucket] = n
    return total


def gains(raw: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Thousandths of the log ratio of smoothed shares, floored, per bucket."""
    s, t, n = raw.astype(float), target.astype(float), len(raw)
    return np.floor(1000 * np.log((t + 1) * (s.sum() + n) / ((s + 1) * (t.sum() + n)))).astype(np.int64)


def _weigh(head: Broadcast, gain: np.ndarray) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n_words, n_pairs, total = (np.zeros(batch.num_rows, np.int64) for _ in range(3))
            for words, rows, lead in word_blocks(batch.column("text")):
                f = Features(words, rows, lead, head.value, len(gain))
                for where, bucket, n in ((f.rows, f.words, n_words), (f.pair_rows, f.pairs, n_pairs)):
                    if len(where):
                        begin = np.flatnonzero(np.r_[True, where[1:] != where[:-1]])
                        total[where[begin]] += np.add.reduceat(gain[bucket], begin)
                        n[where[begin]] += np.diff(np.r_[begin, len(where)])
            columns = [pa.array(n_words), pa.array(n_words + n_pairs), pa.array(total)]
            yield pa.record_batch([*batch.drop_columns(["text"]).columns, *columns], names=[*batch.drop_columns(["text"]).schema.names, "n_words", "n_features", "total"])

    return run


def noise(key: str, seed: int) -> Column:
    """Thousandths of a Gumbel variate, floored, from the SHA-256 of the seed and an id."""
    text = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(key).cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(text.cast("binary"), 256), 1, 8), 16, 10).cast("double")
    return F.floor(-1000 * F.log(-F.log((h + 0.5) / 4294967296.0))).cast("long")


def resample(
    docs: DataFrame, target: DataFrame, key: str = "doc_id", text: str = "text", target_text: str = "text", percent: int = 25, least: int = 20, seed: int = 7, buckets: int = BUCKETS
) -> DataFrame:
    """Every row of ``docs`` (key, n_words, n_features, weight, score, rank); rank is null where it is not drawn.

    Of the rows with at least ``least`` words, ``percent`` in a hundred (floored)
    are drawn by descending score, ties to the smaller key, a null key first. A null or empty text
    has no features and weighs 0; so does every text if neither table holds a feature.
    Rows of one key and equal score, repeated rows among them, are ranked by their features and then as they
    come. An empty table gives an empty result. Other columns take no part.
    """
    counts, goal = (written(word_counts(t, c), "words") for t, c in ((docs, text), (target, target_text)))
    head = docs.sparkSession.sparkContext.broadcast(frequent_words(counts, buckets))
    gain = gains(bucket_totals(docs, counts, head, text, buckets), bucket_totals(target, goal, head, target_text, buckets))
    kind = docs.schema[key].dataType.simpleString()
    own = docs.select(F.col(f"`{key}`").alias("key"), F.col(f"`{text}`").cast("string").alias("text"))
    rows = own.mapInArrow(_weigh(head, gain), f"key {kind}, n_words long, n_features long, total long")
    weight = F.when(F.col("n_features") > 0, F.expr("(total - pmod(total, n_features)) div n_features")).otherwise(F.lit(0)).cast("long")
    rows = written(rows.withColumn("weight", weight).withColumn("score", F.col("weight") + noise("key", seed)).drop("total"), "scored")
    # scores are whole thousandths of logarithms, some tens of thousands of values whatever the rows
    tally = sorted(((r.score, r.n) for r in rows.where(F.col("n_words") >= least).groupBy("score").agg(F.count(F.lit(1)).alias("n")).collect()), reverse=True)
    wanted = sum(n for _, n in tally) * percent // 100
    before, above = [], 0
    for score, n in tally:
        if above < wanted:
            before.append((score, above))
        above += n
    places = F.broadcast(docs.sparkSession.createDataFrame(before, "score long, above long"))
    cut = before[-1][0] if before else None
    able = (F.col("n_words") >= least) & (F.col("score") >= cut) if before else F.lit(False)
    place = F.expr("row_number() over (partition by score order by key nulls first, n_features, weight)")
    ranked = rows.where(able).join(places, "score").withColumn("rank", F.col("above") + place)
    ranked = ranked.withColumn("rank", F.when(F.col("rank") <= wanted, F.col("rank")))
    out = rows.where(~able).withColumn("rank", F.lit(None).cast("long")).unionByName(ranked.drop("above"))
    return out.select(F.col("key").alias(key), "n_words", "n_features", "weight", "score", F.col("rank").cast("long").alias("rank"))
