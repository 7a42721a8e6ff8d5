"""The opN_ queries on the smallest tables: columns, types and what their contracts fix; texts longer than a block."""

import hashlib
import re
import zlib

import pytest
from pyspark.sql import functions as F

from cadastra.llm import packing, substring_dedup, toxicity, words
from cadastra.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"
TYPES = {
    "op2_nearest_neighbours": {"query_id": "bigint", "rank": "int", "vec_id": "bigint", "score": "double"},
    "op3_sharding": {"doc_id": "bigint", "size": "bigint", "text_crc32": "bigint", "law": "string", "shard": "int", "slot": "bigint", "grown_shard": "int"},
    "op4_substring_dedup": {"doc_id": "bigint", "n_words": "bigint", "n_removed": "bigint", "kept_sha256": "string"},
    "op7_ngram_jaccard_join": {"doc_id": "bigint", "n_shingles": "bigint", "component_id": "bigint"},
    "op9_best_fit_packing": {"doc_id": "bigint", "piece": "int", "start": "bigint", "length": "bigint", "ids_crc32": "bigint", "sequence_id": "bigint", "offset": "bigint"},
    "op10_toxicity": {"doc_id": "bigint", "held_out": "boolean", "score": "double", "predicted": "int"},
}


@pytest.fixture(scope="module")
def docs(spark):
    return {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}


@pytest.fixture(scope="module")
def results(spark):
    out = {}
    for name, kinds in TYPES.items():
        df = QUERIES[name](spark, SF)
        assert {c: t for c, t in df.dtypes if c in kinds} == kinds, name
        out[name] = df.toPandas()
    return out


def test_sharding(results, docs):
    out = results["op3_sharding"]
    assert sorted(out.doc_id) == sorted(docs) and set(out.law) == {"bytes"} and out.grown_shard.isna().all()
    for r in out.itertuples():
        data = (docs[r.doc_id] or "").encode()
        assert (r.size, r.text_crc32) == (len(data) + 16, zlib.crc32(data))
    by = out.groupby("shard")
    assert set(by.groups) <= set(range(40))
    for _, rows in by:
        assert sorted(rows.slot) == list(range(len(rows)))
    # a shard ends at the row next to an even border, so it is off by no more than the largest row
    sizes = by["size"].sum()
    assert (abs(sizes - sizes.sum() / 40) <= out["size"].max() + 1).all()


def test_held_out_rows_and_scores(results, docs):
    out = results["op10_toxicity"]
    assert sorted(out.doc_id) == sorted(docs)
    assert (out.held_out == [zlib.crc32(str(i).encode()) % 4 == 2 for i in out.doc_id]).all()
    assert out.score.between(0, 1).all() and (out.predicted == (out.score >= 0.3)).all()


def test_removed_words(results, docs):
    out = results["op4_substring_dedup"]
    assert sorted(out.doc_id) == sorted(docs)
    found = {i: re.findall(r"[^\x20\x09-\x0d]+", t or "") for i, t in docs.items()}
    assert all(r.n_words == len(found[r.doc_id]) for r in out.itertuples())
    whole = out[out.n_removed == 0]
    assert all(r.kept_sha256 == hashlib.sha256(" ".join(found[r.doc_id]).encode()).hexdigest() for r in whole.itertuples())


def test_pieces(results, docs):
    out = results["op9_best_fit_packing"]
    assert set(out.doc_id) == set(docs)
    for _, rows in out.sort_values("piece").groupby("doc_id"):
        assert list(rows.piece) == list(range(len(rows))) and list(rows.start) == [2048 * i for i in range(len(rows))]
    for _, rows in out.sort_values("offset").groupby("sequence_id"):
        assert rows.length.sum() <= 2048 and list(rows.offset) == [0, *rows.length.cumsum()[:-1]]


def test_neighbours(results, spark):
    import numpy as np

    table = spark.read.parquet(f"{SF}/embeddings.parquet").select("vec_id", "embedding").toPandas()
    vectors = {i: np.array(v, float) for i, v in zip(table.vec_id, table.embedding, strict=True)}
    out = results["op2_nearest_neighbours"]
    assert set(out.query_id) == {i for i in vectors if i % 20 == 0}
    hit = total = 0
    for q, rows in out.sort_values("rank").groupby("query_id"):
        want = sorted((-float(vectors[q] @ v), i) for i, v in vectors.items() if i != q)[:20]
        assert list(rows["rank"]) == list(range(1, len(want) + 1))
        assert all(abs(r.score - float(vectors[q] @ vectors[r.vec_id])) < 1e-9 for r in rows.itertuples())
        hit += len({i for _, i in want} & set(rows.vec_id))
        total += len(want)
    assert hit >= 0.9 * total


def test_packing_in_many_partitions_is_near_the_bound(spark, monkeypatch):
    monkeypatch.setattr(packing, "MERGE_ITEMS", 500)
    rows = spark.range(12_000).select("id", (F.col("id") * 7919 % 1500 + 20).alias("length")).orderBy("length")
    out = packing.pack(rows).toPandas()
    assert sorted(out.id) == list(range(12_000))
    bound = -(-out.length.sum() // packing.CAPACITY)
    assert out.sequence_id.nunique() <= 1.01 * bound


def test_texts_longer_than_any_block(spark):
    # words of one to nine letters over several blocks and chunks; a passage is repeated across a border
    passage = " ".join(f"repeated{i}" for i in range(60))
    filler = [" ".join(f"{k}w{i}" for i in range(80_000)) for k in range(3)]
    texts = [f"{filler[0]} {passage} {filler[1]}", f"{passage} {filler[2]}", "short text"]
    assert len(texts[0]) > 2 * words.CHUNK_BYTES > 2 * words.BLOCK_BYTES
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    out = {r.doc_id: r for r in substring_dedup.remove_repeats(rows).collect()}
    assert [out[i].n_removed for i in range(3)] == [60, 60, 0]
    assert out[0].kept_text == f"{filler[0]} {filler[1]}" and out[1].kept_text == filler[2]
    labels = spark.createDataFrame([(0, 1), (1, 0), (2, 0)], "doc_id long, toxic int")
    again = rows.withColumn("text", F.concat(F.col("text"), F.lit(" "), F.col("doc_id").cast("string")))
    scored = toxicity.score(again, toxicity.train(again, labels)).collect()
    assert len(scored) == 3 and all(0 <= r.score <= 1 for r in scored)
