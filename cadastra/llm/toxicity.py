"""Toxicity: a character n-gram linear classifier scaled by naive Bayes log-count ratios.

Features are hashed n-grams of bytes (A-Z lower-cased, blanks alike), counted
once a document. A feature's value is r = log of its smoothed share among toxic
documents over that among clean ones; a logistic regression is fitted on these
values. Training takes a bounded sample of labelled rows; every document is scored.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .storage import text_batches, written
from .words import _LOWER, _SPACE, chunks, text_buffers

ORDERS = (4, 5, 6, 7, 8)
BITS = 20
#: Labelled rows that the classifier is fitted on at most, those of the least hashed ids.
TRAIN_ROWS = 10_000
#: Features kept, those of the largest ratios in standard errors.
FEATURES = 3072
SMOOTHING = 0.1
#: Strength of the squared penalty on the regression's weights.
PENALTY = 1e-4
ROUNDS = 800
#: Bytes whose features are worked out at once.
BLOCK_BYTES = 1 << 17
THRESHOLD = 0.3

_BYTES = _LOWER.copy()
_BYTES[_SPACE] = 0x20


def features(texts: pa.Array, wanted: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Distinct (row, feature) pairs of a chunk, sorted; of the wanted features only, if given.

    Bytes are read in blocks, so a very long text needs memory for its distinct features only.
    """
    data, offsets = text_buffers(texts)
    found = [np.zeros(0, np.int64)]
    for start in range(0, len(data), BLOCK_BYTES):
        block = _BYTES[data[start : start + BLOCK_BYTES + max(ORDERS) - 1]].astype(np.uint32)
        n = min(BLOCK_BYTES, len(data) - start)
        rows = np.searchsorted(offsets, np.arange(start, start + n), "right") - 1
        left = offsets[rows + 1] - np.arange(start, start + n)
        h, own = np.zeros(len(block), np.uint32), []
        for k in range(1, min(max(ORDERS), len(block)) + 1):
            h = h[: len(block) - k + 1] * np.uint32(0x01000193) + block[k - 1 :]
            if k not in ORDERS:
                continue
            x = h[:n]
            x = (x ^ (x >> np.uint32(15))) * np.uint32(0x9E3779B1 + 2 * k)
            x >>= np.uint32(32 - BITS)
            ok = left[: len(x)] >= k
            at = np.flatnonzero(ok & wanted[x] if wanted is not None else ok)
            own.append((rows[at] << BITS) | x[at])
        if own:
            found.append(np.unique(np.concatenate(own)))
    pairs = np.unique(np.concatenate(found))
    return pairs >> BITS, pairs & ((1 << BITS) - 1)


def _count_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts = np.zeros((2, 1 << BITS), np.int64)
    for batch in batches:
        for part in chunks(batch, "text", BLOCK_BYTES):  # all features of a chunk are sorted at once
            rows, found = features(part.column("text"))
            toxic = part.column("toxic").to_numpy()[rows]
            for c in (0, 1):
                counts[c] += np.bincount(found[toxic == c], minlength=1 << BITS)
    seen = np.flatnonzero(counts.sum(axis=0) > 0)
    yield pa.record_batch([pa.array(seen), pa.array(counts[1, seen]), pa.array(counts[0, seen])], names=["feature", "toxic", "clean"])


def _active_rows(ids: np.ndarray) -> Callable:
    """Per document the numbers, in ``ids``, of its features."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wanted = np.zeros(1 << BITS, bool)
        wanted[ids] = True
        for batch in batches:
            for part in chunks(batch, "text"):
                rows, found = features(part.column("text"), wanted)
                lists = pa.ListArray.from_arrays(pa.array(np.searchsorted(rows, np.arange(part.num_rows + 1)).astype(np.int32)), pa.array(np.searchsorted(ids, found)))
                yield pa.record_batch([part.column("order"), part.column("toxic"), lists], names=["order", "toxic", "active"])

    return run


def fit(active: list[np.ndarray], toxic: np.ndarray, ratios: np.ndarray) -> tuple[np.ndarray, float]:
    """Weights of the features and the bias, by Nesterov's gradient steps on the logistic loss."""
    rows = np.repeat(np.arange(len(active)), [len(x) for x in active])
    cols = np.concatenate(active).astype(np.int64) if len(active) else np.zeros(0, np.int64)
    values, n = ratios[cols], max(len(toxic), 1)
    prior = (toxic.sum() + 0.5) / (n + 1)
    w, b = np.full(len(ratios), 0.1), float(np.log(prior / (1 - prior)))
    squares = np.bincount(rows, values**2, len(toxic)) + 1
    step = 1.0 / (0.25 * max(np.mean(squares), 1e-9) * 4 + PENALTY)
    w0, b0 = w.copy(), b
    for t in range(ROUNDS):
        z = np.bincount(rows, values * w[cols], len(toxic)) + b
        slope = (1 / (1 + np.exp(-np.clip(z, -40, 40))) - toxic) / n
        w1 = w - step * (np.bincount(cols, values * slope[rows], len(ratios)) + PENALTY * w)
        b1 = b - step * slope.sum()
        speed = t / (t + 3)
        w, b, w0, b0 = w1 + speed * (w1 - w0), b1 + speed * (b1 - b0), w1, b1
    return w0 * ratios, b0


def _fit_rows(ratios: np.ndarray) -> Callable:
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sample = pd.concat(list(frames)).sort_values("order", kind="stable")
        weights, bias = fit([np.asarray(x) for x in sample["active"]], sample["toxic"].to_numpy(float), ratios)
        yield pd.DataFrame({"number": np.arange(len(weights) + 1) - 1, "weight": np.concatenate(([bias], weights))})

    return run


def train(docs: DataFrame, labels: DataFrame, id: str = "doc_id", text: str = "text", label: str = "toxic", rows: int = TRAIN_ROWS) -> tuple[np.ndarray, np.ndarray, float]:
    """Feature numbers, their weights and the bias, from labelled rows of ``docs``.

    At most ``rows`` labels are taken, those of the least hashed ids, and those
    are broadcast. Null ids, texts and labels take no part; of several labels of
    an id the largest holds, of several texts the one of the least hash. Without
    both classes only the bias is fitted.
    """
    text_batches(docs)
    chosen = labels.select(F.col(id).alias("_id"), F.col(label).cast("int").alias("toxic")).dropna().where("toxic in (0, 1)").groupBy("_id").agg(F.max("toxic").alias("toxic"))
    chosen = chosen.orderBy(F.xxhash64("_id"), "_id").limit(rows)
    known = docs.select(F.col(id).alias("_id"), F.col(text).cast("string").alias("text")).dropna()
    sample = known.join(F.broadcast(chosen), "_id").groupBy("_id").agg(F.min_by("text", F.xxhash64("text")).alias("text"), F.first("toxic").alias("toxic"))
    sample = sample.select(F.xxhash64("_id").alias("order"), "text", "toxic")
    sample = written(sample.repartition(8, "order"), "sample")
    totals = {r[0]: r[1] for r in sample.groupBy("toxic").count().collect()}
    if len(totals) < 2:
        prior = (totals.get(1, 0) + 0.5) / (sum(totals.values()) + 1)
        return np.zeros(0, np.int64), np.zeros(0), float(np.log(prior / (1 - prior)))
    counts = sample.select("text", "toxic").mapInArrow(_count_rows, "feature long, toxic long, clean long").groupBy("feature").agg(F.sum("toxic").alias("p"), F.sum("clean").alias("q"))
    a = SMOOTHING
    ratio = F.log((F.col("p") + a) / (totals[1] + 2 * a)) - F.log((F.col("q") + a) / (totals[0] + 2 * a))
    error = F.sqrt(1 / (F.col("p") + a) + 1 / (F.col("q") + a))
    kept = counts.where("p + q >= 3").select("feature", ratio.alias("r"), F.abs(ratio / error).alias("z")).orderBy(F.desc("z"), "feature").limit(FEATURES).select("feature", "r").collect()
    kept.sort()
    ids, ratios = np.array([k[0] for k in kept], np.int64), np.array([k[1] for k in kept])
    active = sample.select("order", "text", "toxic").mapInArrow(_active_rows(ids), "order long, toxic int, active array<long>")
    weights = dict(active.repartition(1).mapInPandas(_fit_rows(ratios), "number long, weight double").collect())
    return ids, np.array([weights[i] for i in range(len(ids))]), weights[-1]


def _score_rows(ids: np.ndarray, weights: np.ndarray, bias: float, text: str, keep: bool) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        dense = np.zeros(1 << BITS)
        dense[ids] = weights
        wanted = np.zeros(1 << BITS, bool)
        wanted[ids] = True
        for batch in batches:
            for part in chunks(batch, text, BLOCK_BYTES):
                rows, found = features(part.column(text), wanted)
                total = np.bincount(rows, dense[found], part.num_rows) + bias
                score = 1 / (1 + np.exp(-np.clip(total, -500, 500)))
                rest = part if keep else part.drop_columns([text])
                yield pa.record_batch([*rest.columns, pa.array(score)], names=[*rest.schema.names, "score"])

    return run


def score(docs: DataFrame, model: tuple[np.ndarray, np.ndarray, float], text: str = "text", keep_text: bool = False, threshold: float = THRESHOLD) -> DataFrame:
    """Rows of ``docs`` with score (0 to 1) and predicted (1 if score >= threshold).

    A null text counts as empty and gets the score of the bias alone. The text
    column stays (as a string) only if asked for; it is sent to Python once.
    Columns score and predicted are replaced.
    """
    text_batches(docs)
    own = [c for c in docs.columns if c not in ("score", "predicted") or c == text]
    names = {c: f"c{i}" for i, c in enumerate(own)}
    kinds = {c: "string" if c == text else docs.schema[c].dataType.simpleString() for c in own}
    rows = docs.select(*[F.col(f"`{c}`").cast("string").alias(n) if c == text else F.col(f"`{c}`").alias(n) for c, n in names.items()])
    shown = [c for c in own if keep_text or c != text]
    schema = ", ".join([*(f"{names[c]} {kinds[c]}" for c in shown), "score double"])
    out = rows.mapInArrow(_score_rows(*model, names[text], keep_text), schema)
    return out.select(*[F.col(names[c]).alias(c) for c in shown if c not in ("score", "predicted")], "score", F.when(F.col("score") >= threshold, 1).otherwise(0).alias("predicted"))


def held_out(id: str):
    """Rows never trained on: CRC-32 of the id as text leaves 2 when divided by 4."""
    return F.coalesce(F.crc32(F.col(id).cast("string").cast("binary")) % 4 == 2, F.lit(False))
