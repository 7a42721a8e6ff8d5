"""Tables that grow with the texts are not broadcast, however small Spark takes them for."""

import re

import pytest
from cadastra.llm import components as components_, jaccard_join, storage


@pytest.fixture
def plans(monkeypatch):
    """The plans of the tables written by the join, by name, before any of their stages ran."""
    found = {}

    def kept(df, name):
        found.setdefault(name, []).append(df._jdf.queryExecution().executedPlan().toString())
        return storage.written(df, name)

    for module in (jaccard_join, components_):
        monkeypatch.setattr(module, "written", kept)
    return found


@pytest.fixture
def docs(spark):
    words = [f"{w}{i}" for i in range(40) for w in ("some", "words")]
    texts = [" ".join(words[i // 2 : i // 2 + 40]) + (" more" if i % 2 else "") for i in range(40)]
    return spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")


def test_texts_and_their_keys_are_shuffled(docs, plans):
    classes = jaccard_join.text_components(docs)
    assert "Broadcast" not in plans["survivors"][0]
    assert "BroadcastHashJoin [node" not in plans["links"][1]
    assert "Broadcast" not in classes._jdf.queryExecution().executedPlan().toString()


def test_labels_and_clusters_are_shuffled_if_many(docs, plans, monkeypatch):
    monkeypatch.setattr(storage, "BROADCAST_ROWS", 0)
    assert {r.component_id for r in jaccard_join.jaccard_components(docs).select("component_id").collect()} == {0}
    # what is broadcast in these plans is neither the table of labels nor the clusters of a task
    of_nodes = r"BroadcastExchange.*\n(.*(Filter|Project).*\n)*.*(MapInArrow|FileScan parquet \[node#\d+L,component#\d+L\])"
    for name in ("members", "clusters"):
        assert not re.search(of_nodes, plans[name][0])


def test_sizes_of_many_bands(spark, monkeypatch):
    monkeypatch.setattr(jaccard_join, "BLOCK_TEXTS", 2)
    monkeypatch.setattr(jaccard_join, "PAIRED", 0)
    # shingles of a text are the first of the next one's; 75 of 100 link, and 74 do not
    sizes = [27, 36, 48, 64, 65, 87, 116, 117, 157, 160, 213, 284, 285, 286]
    words = [f"w{i}" for i in range(300)]
    docs = spark.createDataFrame([(i, " ".join(words[: n + 4])) for i, n in enumerate(sizes)], "doc_id long, text string")
    want, first = set(), 0
    for i, n in enumerate(sizes):
        first = first if i and 100 * sizes[i - 1] >= 75 * n else i
        want.add((i, n, first))
    assert {tuple(r) for r in jaccard_join.jaccard_components(docs).select("doc_id", "n_shingles", "component_id").collect()} == want
    assert len({c for *_, c in want}) == 3


def test_pipeline_stage_shuffles_keys_of_texts(spark, docs, monkeypatch):
    import corpus_pipeline

    found = {}

    def kept(df, name):
        found[name] = df._jdf.queryExecution().executedPlan().toString()
        return storage.written(df, name)

    monkeypatch.setattr(corpus_pipeline, "written", kept)
    rows = docs.selectExpr("doc_id", "text", "'en' AS lang", "'a' AS source", "length(text) + 0L AS n_chars")
    assert [r.doc_id for r in corpus_pipeline.near_duplicates(spark, rows, "").collect()] == [0]
    assert "Broadcast" not in found["held"]
