"""Operators against brute force on small tables with nulls, empty, repeated and tied rows."""

import collections
import hashlib
import itertools
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from cadastra.llm import images, jaccard_join, licenses, mixing, neighbours, packing, piece_counts, sharding, substring_dedup, toxicity
from cadastra.llm.components import components
from cadastra.llm.queries import word_vocabulary

WORD = re.compile(r"[^\x20\x09-\x0d]+")
LONG = " ".join(f"w{i}" for i in range(60))
TEXTS = [
    LONG,
    LONG,
    LONG.upper(),
    " ".join(f"w{i}" for i in range(58)) + " x y",
    "start " + " ".join(f"w{i}" for i in range(10, 50)) + " end of it",
    " ".join(f"w{i}" for i in range(10, 40)),
    "a b c d e f g h " * 12,
    "one two three",
    "one two three",
    "one\ttwo\nthree four",
    "Été garçon naïve 漢字 " * 3,
    "",
    " \t\n ",
    None,
    None,
    "z" * 5000,
]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i if i != 5 else None, t, "en", f"s{i % 3}" if i % 7 else None, 1, "clash") for i, t in enumerate(TEXTS)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_removed long, component_id string").repartition(3)


@pytest.fixture(scope="module")
def none(docs):
    return docs.where("false")


def words(text):
    return WORD.findall(text or "")


@pytest.mark.parametrize("group_rows", [substring_dedup.GROUP_ROWS, 3, 1])
def test_substring_dedup(docs, none, monkeypatch, group_rows):
    monkeypatch.setattr(substring_dedup.repeated_spans, "__defaults__", (substring_dedup.WINDOW, substring_dedup.PREFIX, group_rows))
    count = collections.Counter(tuple(w[i : i + 35]) for w in map(words, TEXTS) for i in range(len(w) - 34))
    want = []
    for i, t in enumerate(TEXTS):
        w = words(t)
        gone = [any(count[tuple(w[j : j + 35])] > 1 for j in range(max(0, k - 34), min(k, len(w) - 35) + 1)) for k in range(len(w))]
        kept = " ".join(x for x, g in zip(w, gone, strict=True) if not g)
        want.append((None if i == 5 else i, len(w), sum(gone), hashlib.sha256(kept.encode()).hexdigest(), kept))
    out = substring_dedup.remove_repeats(docs)
    got = [(r.doc_id, r.n_words, r.n_removed, r.kept_sha256, r.kept_text) for r in out.collect()]
    assert sorted(got, key=repr) == sorted(want, key=repr)
    assert "component_id" in out.columns
    assert substring_dedup.remove_repeats(none).count() == 0


def shingles(text):
    w = words(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set()


@pytest.mark.parametrize(("texts", "paired"), [(1024, 16), (1, 2), (2, 0)])
def test_jaccard_components(docs, none, monkeypatch, texts, paired):
    monkeypatch.setattr(jaccard_join, "BLOCK_TEXTS", texts)
    monkeypatch.setattr(jaccard_join, "PAIRED", paired)
    sets = [shingles(t) for t in TEXTS]
    group = list(range(len(TEXTS)))
    for _ in TEXTS:
        for i, j in itertools.combinations(range(len(TEXTS)), 2):
            if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= 75 * len(sets[i] | sets[j]):
                group[i] = group[j] = min(group[i], group[j])
    ids = [None if i == 5 else i for i in range(len(TEXTS))]
    want = []
    for i, s in enumerate(sets):
        own = [ids[j] for j in range(len(TEXTS)) if group[j] == group[i] and ids[j] is not None]
        want.append((ids[i], len(s), (min(own) if own else None) if s else ids[i]))
    got = [(r.doc_id, r.n_shingles, r.component_id) for r in jaccard_join.jaccard_components(docs).collect()]
    assert sorted(got, key=repr) == sorted(want, key=repr)
    assert jaccard_join.jaccard_components(none).count() == 0


def test_components(spark, monkeypatch):
    edges = spark.createDataFrame([(1, 2), (2, 3), (9, 8), (7, 8), (3, 3), (4, None), (20, 1)], "a long, b long")
    want = {(1, 1), (2, 1), (3, 1), (20, 1), (7, 7), (8, 7), (9, 7)}
    assert {tuple(r) for r in components(edges).collect()} == want
    monkeypatch.setattr("cadastra.llm.components.TASK_EDGES", 0)
    assert {tuple(r) for r in components(edges).collect()} == want


def test_mixing_deviates_less_than_a_block(docs, none, spark):
    rows = spark.range(300).select(F.col("id").alias("doc_id"), F.when(F.col("id") < 200, "big").when(F.col("id") < 290, "mid").alias("source"), F.lit("x").alias("position"))
    weights = {"big": 5.0, "mid": 3.0, None: 1.0}
    out = mixing.mix(rows, weights=weights, block_rows=2).toPandas().fillna({"source": "none"})
    assert sorted(out.doc_id) == list(range(300))
    blocks = out.groupby("position").source.agg(["first", "nunique"])
    assert list(blocks.index) == list(range(len(blocks))) and (blocks["nunique"] == 1).all()
    # while all sources last
    seen = collections.Counter()
    for t, s in enumerate(blocks["first"][:9], 1):
        seen[s] += 1
        for name, share in (("big", 5), ("mid", 3), ("none", 1)):
            assert abs(seen[name] - share * t / 9) < 1
    assert mixing.mix(docs).count() == len(TEXTS)
    assert mixing.mix(none).count() == 0
    with pytest.raises(ValueError):
        mixing.mix(rows, weights={"big": 1.0})


def test_sharding(docs, none, spark):
    rows = spark.range(2000).select((F.col("id") * 37 % 2000 - 500).alias("k"), (F.col("id") % 50 + 1).alias("size"), F.lit("x").alias("slot"))
    out = sharding.shard_by_bytes(rows, "size", "k", 8).toPandas()
    total = out.groupby("shard")["size"].sum()
    assert len(out) == 2000 and len(total) == 8 and total.max() - total.min() <= 2 * 51
    for _, part in out.groupby("shard"):
        assert sorted(part.slot) == list(range(len(part)))
        assert (part.sort_values("slot").k.diff().dropna() > 0).all()
    assert sharding.shard_by_bytes(docs.withColumn("size", F.octet_length("text")), "size", "doc_id", 4).count() == len(TEXTS)
    assert sharding.shard_by_bytes(none.withColumn("size", F.lit(1)), "size", "doc_id", 4).count() == 0


def test_groups_split_by_longer_prefixes(spark, monkeypatch):
    """Texts share 8, 14, 20, 30 or 50 words; groups of more than 6 suffixes go to the next prefix length."""
    random = np.random.default_rng(3)
    shared = [f"c{i}" for i in range(50)]
    texts = []
    for i in range(60):
        n = [8, 14, 20, 30, 50][i % 5]
        own = [f"u{x}" for x in random.integers(0, 4000, 60)]
        texts.append(" ".join(own[:20] + shared[:n] + own[20 : 20 + int(random.integers(5, 40))] + shared[: n // 2]))
    count = collections.Counter(tuple(w[i : i + 35]) for w in map(words, texts) for i in range(len(w) - 34))
    want = {}
    for i, t in enumerate(texts):
        w = words(t)
        want[i] = len({p + q for p in range(len(w) - 34) if count[tuple(w[p : p + 35])] > 1 for q in range(35)})
    monkeypatch.setattr(substring_dedup.repeated_spans, "__defaults__", (substring_dedup.WINDOW, substring_dedup.PREFIX, 6))
    out = substring_dedup.remove_repeats(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4))
    assert {r.doc_id: r.n_removed for r in out.collect()} == want
    assert substring_dedup.prefix_lengths(35, 8) == [8, 12, 18, 27]


def test_packing(docs, none):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(word_vocabulary())
    out = packing.pack_documents(docs, word_vocabulary(), capacity=64).toPandas()
    want = collections.Counter()
    for i, t in enumerate(TEXTS):
        ids = [*tokenizer.encode(t or "", add_special_tokens=False).ids, 0]
        for k, at in enumerate(range(0, len(ids), 64)):
            part = ids[at : at + 64]
            want[(-1 if i == 5 else i, k, at, len(part), zlib.crc32(np.array(part, "<u4").tobytes()))] += 1
    got = collections.Counter(zip(out.doc_id.fillna(-1).astype(int), out.piece, out.start, out.length, out.ids_crc32, strict=True))
    assert got == want
    for _, part in out.sort_values("offset").groupby("sequence_id"):
        assert list(part.offset) == [0, *np.cumsum(part.length)[:-1]] and part.length.sum() <= 64
    assert packing.pack_documents(none, word_vocabulary()).count() == 0


def test_best_fit_is_tight():
    rng = np.random.default_rng(1)
    lengths = rng.integers(1, 100, 500).tolist()
    bins = packing.best_fit(lengths, 100)
    assert sorted(i for b in bins for i in b) == list(range(500))
    assert max(sum(lengths[i] for i in b) for b in bins) <= 100
    assert len(bins) <= sum(lengths) / 100 * 1.1 + 1


def test_piece_counts(docs, none):
    vocabulary = set(piece_counts.vocabulary_pieces(word_vocabulary()))

    def greedy(word):
        rest, n = (*word.encode(), piece_counts.END), 0
        while rest:
            size = next(k for k in range(len(rest), 0, -1) if rest[:k] in vocabulary)
            rest, n = rest[size:], n + 1
        return n

    got = {r.doc_id: (r.n_words, r.n_pieces) for r in piece_counts.piece_counts(docs, word_vocabulary()).where("doc_id is not null").collect()}
    for i, t in enumerate(TEXTS):
        if i != 5:
            found = piece_counts.WORD.findall((t or "").lower())
            assert got[i] == (len(found), sum(map(greedy, found)))
    assert piece_counts.piece_counts(none, word_vocabulary()).count() == 0


def test_licenses(spark, docs, none):
    files = [
        ("a/LICENSE", "Released under the MIT License."),
        ("a/x.txt", "nothing here"),
        ("a/b/c/y.txt", "far below"),
        ("a/b/z.txt", "long text " * 60 + "\nLicensed under the Apache License, Version 2.0.\nmore"),
        ("d/only.txt", "no license that is known to anybody at all"),
        ("d/empty.txt", ""),
        ("d/null.txt", None),
        (None, "Licensed under CC BY-NC 4.0."),
    ]
    df = spark.createDataFrame(files, "path string, text string").withColumn("score", F.lit("clash"))
    out = licenses.scan_licenses(df, "path", "text")
    got = {r.path: (r.licence, r.origin) for r in out.collect()}
    assert got["a/LICENSE"] == ("MIT", "own")
    assert got["a/x.txt"] == got["a/b/c/y.txt"] == ("MIT", "inherited")
    assert got["a/b/z.txt"] == ("Apache-2.0", "own")
    assert got["d/only.txt"] == got["d/empty.txt"] == got["d/null.txt"] == (None, "none")
    assert len(got) == len(files)
    assert licenses.scan_licenses(df.where("false"), "path", "text").count() == 0


def test_toxicity(spark, docs, none):
    rng = np.random.default_rng(3)
    plain = ["".join(rng.choice(list("abcdefghij"), 5)) for _ in range(200)]
    rows = []
    for i in range(400):
        w = list(rng.choice(plain, 30))
        if i % 4 == 0:
            w[7] = ("vilest", "rotten")[i % 8 == 0]
        rows.append((i, " ".join(w), int(i % 4 == 0)))
    df = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    model = toxicity.train(df.where("doc_id < 300"), df.where("doc_id < 300").select("doc_id", "toxic"))
    out = toxicity.score(df.where("doc_id >= 300"), model).toPandas()
    assert (out.predicted == out.toxic).mean() > 0.9
    odd = toxicity.score(docs, model)
    assert odd.count() == len(TEXTS) and odd.where("score is null or score < 0 or score > 1").isEmpty()
    assert toxicity.score(none, model).count() == 0
    assert toxicity.score(docs, toxicity.train(none, df.select("doc_id", "toxic"))).count() == len(TEXTS)


def test_nearest(spark):
    rng = np.random.default_rng(5)
    rows = [(i, [float(x) for x in v]) for i, v in enumerate(rng.standard_normal((300, 8)))]
    rows += [(300 + i, rows[7][1]) for i in range(40)]
    rows += [(400, None), (401, [0.0] * 8), (402, [float("nan")] * 8), (403, [1.0]), (404, []), (None, rows[0][1]), (20, rows[20][1])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    x = {i: np.array(v, np.float32).astype(float) for i, v in rows[:340]}
    out = neighbours.nearest(df, F.col("id") % 20 == 0, k=5).toPandas()
    hits = total = 0
    for q in (i for i in x if i % 20 == 0):
        want = sorted((-float(x[q] @ x[i]), i) for i in x if i != q)[:5]
        got = out[out.query_id == q].sort_values("rank")
        assert list(got["rank"]) == [1, 2, 3, 4, 5]
        hits += len(set(got.vec_id) & {i for _, i in want})
        total += 5
    assert hits / total >= 0.9
    assert neighbours.nearest(df.where("vec_id < 3"), F.col("id") == 0).count() == 2
    assert neighbours.nearest(df.where("false"), F.col("id") == 0).count() == 0


def test_images(spark):
    rng = np.random.default_rng(9)
    rows = [(i, [float(x) for x in v], i % 3) for i, v in enumerate(rng.standard_normal((30, 64)))]
    rows += [(30, rows[1][1], 1), (31, None, 0), (32, [1.0], 0), (None, rows[2][1], 0)]
    drawn = images.drawn_images(spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int"))
    extra = spark.createDataFrame([(900, 16, 16, bytearray(b"x")), (901, None, 16, None), (902, 64, 64, bytearray(4096))], "image_id long, height int, width int, pixels binary")
    got = {r.image_id: r.group_id for r in images.image_copies(drawn.unionByName(extra)).collect()}
    edited = [i for i in got if i % 2 and i < 60]
    assert len(edited) == 10 and sum(got[i] == i - 1 for i in edited) >= 9
    assert got[60] == 2 and all(got[i] == i for i in (900, 901, 902))
    assert all(got[i] == i for i in range(0, 60, 2))
    assert images.image_copies(extra.where("false")).count() == 0
    assert images.image_copies(drawn).columns == ["image_id", "group_id"]


def test_packing_does_not_hang_on_batches(spark):
    rng = np.random.default_rng(4)
    lengths = np.sort(np.concatenate([rng.integers(1100, 1700, 3000), rng.integers(200, 600, 6000)]))
    rows = spark.createDataFrame([(i, int(x)) for i, x in enumerate(lengths)], "i long, length long").coalesce(1)
    packing.text_batches(rows)
    out = packing.pack(rows).toPandas()
    assert sorted(out.i) == list(range(9000)) and out.groupby("sequence_id").length.sum().max() <= packing.CAPACITY
    assert out.sequence_id.nunique() <= 1.01 * len(packing.best_fit(lengths.tolist(), packing.CAPACITY))


def test_graph_is_stable(spark, monkeypatch):
    monkeypatch.setattr(neighbours, "GROUP", 16)
    monkeypatch.setattr(neighbours, "CUTS", 2)
    monkeypatch.setattr(neighbours, "JOINED", 2)
    x = np.random.default_rng(3).standard_normal((800, 6))
    x = (x / np.linalg.norm(x, axis=1)[:, None]).astype(np.float32)
    nodes = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "node long, x array<float>")
    score = x @ x.T
    np.fill_diagonal(score, -np.inf)
    want = {(i, int(j)) for i, row in enumerate(score) for j in np.argsort(-row)[:10]}
    got = {(r.node, r.near) for r in neighbours.build_graph(nodes, 10).collect()}
    assert len(want & got) / len(want) >= 0.9


def test_search_goes_on_until_all_is_seen(spark):
    nodes = spark.createDataFrame([(i, [float(i), 1.0]) for i in range(10)], "node long, x array<float>")
    graph = spark.createDataFrame([(i, i + 1, 0.0) for i in range(9)], "node long, near long, score double")
    queries = spark.createDataFrame([(0, [1.0, 0.0], 0)], "query long, q array<float>, node long")
    found, scored = neighbours.search_graph(queries, nodes, graph)
    assert {r.near for r in found.collect()} == set(range(10))
    pairs = [(r["query"], r.near) for r in scored.collect()]
    assert len(pairs) == len(set(pairs)) == 10


def test_links_of_a_hub_are_bounded(spark, monkeypatch):
    monkeypatch.setattr(neighbours, "LINKED", 3)
    graph = spark.createDataFrame([(i, 0, float(i)) for i in range(1, 200)] + [(0, 5, 5.0)], "node long, near long, score double")
    links = {(r.node, r.near) for r in neighbours._links(graph).collect()}
    assert {y for x, y in links if x == 0} == {5, 197, 198, 199}
    assert all((i, 0) in links for i in range(1, 200))


def test_mixing_over_many_cycles(spark):
    rows = spark.range(9000).select(F.col("id").alias("doc_id"), F.when(F.col("id") < 5000, "big").when(F.col("id") < 8000, "mid").otherwise("small").alias("source"))
    blocks = mixing.mix(rows, weights={"big": 5.0, "mid": 3.0, "small": 1.0}, block_rows=1).toPandas().sort_values("position").source
    for name, share in (("big", 5), ("mid", 3), ("small", 1)):
        assert np.abs((blocks == name).cumsum().to_numpy() - share * np.arange(1, 9001) / 9).max() < 1


def test_mixing_with_many_sources(spark):
    counts = {"large": 50_000, **{f"s{i}": 100 for i in range(999)}}
    rows = spark.createDataFrame([(s, n) for s, n in counts.items()], "source string, n int")
    rows = rows.select("source", F.explode(F.sequence(F.lit(1), "n"))).withColumn("doc_id", F.monotonically_increasing_id()).drop("col")
    blocks = mixing.mix(rows, block_rows=1).where("position < 50000").groupBy("source").count().toPandas().set_index("source")["count"]
    total = sum(n**0.5 for n in counts.values())
    assert all(abs(blocks.get(s, 0) - 50_000 * n**0.5 / total) < 1 for s, n in counts.items())
