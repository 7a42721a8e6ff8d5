"""Divergence audit, byte-level BPE and resampling against brute force, on nulls, ties, repeats, long texts and empty tables."""

import collections
import hashlib
import math
import re
import zlib

import duckdb
import pandas as pd
import pytest
from pyspark.sql import functions as F

from cadastra.llm import byte_pairs, divergence, queries, resampling

LONG = "Überlang wort " * 3000
TEXTS = [
    "The cat sat on the mat. The cat ran, didn't it?",
    "The cat sat on the mat. The cat ran, didn't it?",
    "  two  spaces \n and\ttabs \r\n\r\n end ",
    "Été garçon naïve 漢字 ꟎ 😀 ²³ <|endoftext|> x<|endoftext|>",
    "aaaaaaaaaaaaaaaa " * 40,
    " ".join(f"Word{i % 37} {'a' * (i % 90)}" for i in range(400)),
    LONG,
    "zq" * 4000,
    "the cat the dog the cat",
    "",
    " \n ",
    None,
    None,
    "one two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen sixteen seventeen eighteen nineteen twenty",
]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i if i != 5 else None, t, ("en", "fr", None)[i % 3], f"s{i % 4}" if i % 5 else None, "clash", 1) for i, t in enumerate([*TEXTS, *TEXTS, *TEXTS, TEXTS[0]])]
    rows.append(rows[0])
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, ids string, rank int").repartition(3)


@pytest.fixture(scope="module")
def none(docs):
    return docs.where("false")


def lowered(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def test_divergence(docs, none):
    rows = [(r.lang or "", r.source or "", re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", lowered(r.text))) for r in docs.collect()]
    groups = {(lang, s) for lang, s, _ in rows}
    want = set()
    for lang in {lang for lang, _ in groups}:
        seen = collections.Counter(t for x, _, w in rows if x == lang for t in set(w))
        kept = [t for t, n in seen.items() if n >= 3]
        count = {s: collections.Counter(t for x, y, w in rows if (x, y) == (lang, s) for t in w) for x, s in groups if x == lang}
        count[None] = sum(count.values(), collections.Counter())

        def p(s, t, count=count, kept=kept):
            return 1 + 1_000_000_000 * (count[s][t] + 1) // (sum(count[s][k] for k in kept) + len(kept))

        f = lambda a, b: (a - b) ** 2 // b
        for s in count.keys() - {None}:
            pairs = [(-sum(f(p(s, t), p(q, t)) for t in kept), q) for q in count.keys() - {None, s}]
            terms = [(-f(p(s, t), p(None, t)), t.encode(), t) for t in kept if count[s][t] and p(s, t) > p(None, t)]
            want |= {(lang, s, "pair", q, -v, i + 1) for i, (v, q) in enumerate(sorted(pairs))}
            want |= {(lang, s, "term", t, -v, i + 1) for i, (v, _, t) in enumerate(sorted(terms)[:200])}
    got = divergence.audit(docs)
    assert got.dtypes == [("lang", "string"), ("source", "string"), ("part", "string"), ("item", "string"), ("value", "bigint"), ("rank", "int")]
    assert sorted(map(tuple, got.collect())) == sorted(want)
    assert any(r[2] == "term" for r in want)
    assert divergence.audit(none).collect() == []
    limited = divergence.audit(docs, top=1).where("part = 'term'")
    assert sorted(map(tuple, limited.collect())) == sorted(r for r in want if r[2] == "term" and r[5] == 1)


def test_divergence_small_blocks_and_large_counts(docs, monkeypatch):
    monkeypatch.setattr(divergence, "FLUSH_TERMS", 5)
    monkeypatch.setattr(divergence, "BLOCK_POSTINGS", 3)
    small = sorted(map(tuple, divergence.audit(docs).collect()))
    monkeypatch.undo()
    assert small == sorted(map(tuple, divergence.audit(docs).collect()))
    import numpy as np

    counts, weight = np.array([0, 7, 10**12, 10**15 - 1]), np.array([10**15, 3 * 10**14 + 7, 10**15, 10**15])
    assert divergence.shares(counts, weight).tolist() == [1 + 10**9 * (int(c) + 1) // int(w) for c, w in zip(counts, weight, strict=True)]


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(queries.byte_vocabulary())


def test_byte_pairs(docs, none, library, monkeypatch):
    path = queries.byte_vocabulary()
    for cache, group in ((500_000, 4 << 20), (3, 100)):
        monkeypatch.setattr(byte_pairs, "CACHE_PIECES", cache)
        monkeypatch.setattr(byte_pairs, "GROUP_BYTES", group)
        rows = byte_pairs.encoded(docs.select("doc_id", "text", "ids", "rank"), path)
        assert rows.columns == ["doc_id", "rank", "ids"]
        got = sorted(((r.doc_id, r.ids) for r in rows.collect()), key=repr)
        want = [(r.doc_id, library.encode(r.text or "", add_special_tokens=False).ids) for r in docs.collect()]
        assert got == sorted(want, key=repr)
        back = byte_pairs.decoded(rows.select("doc_id", "ids"), path)
        assert back.columns == ["doc_id", "decoded"]
        texts = [(i, library.decode(ids, skip_special_tokens=False)) for i, ids in want]
        assert sorted(map(tuple, back.collect()), key=repr) == sorted(texts, key=repr)
    assert byte_pairs.encoded(none.select("doc_id", "text"), path).collect() == []


def test_decoding_parts(spark, library):
    cut = library.encode("漢字 text", add_special_tokens=False).ids
    rows = spark.createDataFrame([(1, cut[:1]), (2, cut[1:]), (3, []), (4, None), (5, [cut[-1], None, 999_999, -4])], "k int, ids array<int>")
    got = {r.k: r.decoded for r in byte_pairs.decoded(rows, queries.byte_vocabulary()).collect()}
    assert got == {1: library.decode(cut[:1]), 2: library.decode(cut[1:]), 3: "", 4: None, 5: " text"}


def test_byte_pairs_against_library_on_all_characters(library):
    coder = byte_pairs.vocabulary(queries.byte_vocabulary())
    chars = [chr(c) for c in range(0x110000) if not 0xD800 <= c <= 0xDFFF]
    texts = ["".join(f"a{c}1{c}.{c} " for c in chars[at : at + 64]) for at in range(0, len(chars), 64)]
    own = coder.encode(texts)
    for text, data, found in zip(texts, own, library.encode_batch(texts, add_special_tokens=False), strict=True):
        assert memoryview(data).cast("I").tolist() == found.ids, text[:3]


def drawn(rows, target):
    words = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lowered(t))
    runs = lambda w: [zlib.crc32(f.encode()) % 10_000 for f in [*w, *map(" ".join, zip(w, w[1:]))]]
    s = collections.Counter(f for _, t in rows for f in runs(words(t)))
    t = collections.Counter(f for x in target for f in runs(words(x)))
    n, m = s.total(), t.total()
    gain = [math.floor(1000 * math.log((t[i] + 1) * (n + 10_000) / ((s[i] + 1) * (m + 10_000)))) for i in range(10_000)]
    out = []
    for i, text in rows:
        w = words(text)
        f = runs(w)
        weight = sum(gain[x] for x in f) // len(f) if f else 0
        h = int(hashlib.sha256(f"7:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        out.append((i, len(w), len(f), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))))
    able = sorted((r for r in out if r[1] >= 20), key=lambda r: (-r[4], -1 if r[0] is None else r[0], r[2], r[3]))
    ranks = collections.defaultdict(list)
    for k, r in enumerate(able[: 25 * len(able) // 100]):
        ranks[r].append(k + 1)
    return [(*r, ranks[r].pop() if ranks[r] else None) for r in out]


@pytest.mark.parametrize("block", [1 << 19, 64])
@pytest.mark.parametrize(("head", "pair"), [(1 << 18, 1 << 10), (16, 8), (1, 1)])
def test_resampling(spark, docs, none, monkeypatch, block, head, pair):
    monkeypatch.setattr(resampling.word_blocks, "__defaults__", (block,))
    monkeypatch.setattr(resampling.frequent_words, "__defaults__", (10_000, head, pair))
    extra = spark.createDataFrame([(100 + i, " ".join(f"w{(i * j) % 23}" for j in range(1, 30))) for i in range(40)], "doc_id long, text string")
    rows = docs.select("doc_id", "text").unionByName(extra)
    target = spark.createDataFrame([("w1 w2 the cat sat",), ("Überlang wort w4",), (None,), ("",)], "text string")
    got = resampling.resample(rows.withColumn("score", F.lit("clash")), target)
    want = drawn([tuple(r) for r in rows.collect()], [r.text for r in target.collect()])
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(want, key=repr)
    assert sum(r[5] is not None for r in want) > 5
    if block == 64:
        assert resampling.resample(none, target).collect() == []
        bare = resampling.resample(docs, target.where("false"))
        assert sorted(map(tuple, bare.collect()), key=repr) == sorted(drawn([(r.doc_id, r.text) for r in docs.collect()], []), key=repr)


def test_contract_columns_and_sql(spark):
    folder = "/root/testdata/sf0.001"
    con = duckdb.connect()
    for t in ("documents", "benchmark"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{folder}/{t}.parquet'")
    types = {
        "op11_source_divergence": {"lang": "string", "source": "string", "part": "string", "item": "string", "value": "bigint", "rank": "int"},
        "op12_byte_pairs": {"doc_id": "bigint", "n_tokens": "bigint", "ids_sha256": "string", "decoded_sha256": "string"},
        "op13_resampling": {"doc_id": "bigint", "n_features": "bigint", "weight": "bigint", "score": "bigint", "rank": "bigint"},
    }
    for name, kinds in types.items():
        out = queries.QUERIES[name](spark, folder)
        assert dict(out.dtypes) == kinds
        if name in queries.ORACLES:
            want = con.execute(queries.ORACLES[name]).df()[out.columns].astype(object)
            plain = lambda df: sorted((tuple(None if pd.isna(x) else x for x in r) for r in df.itertuples(index=False, name=None)), key=repr)
            assert plain(out.toPandas().astype(object)) == plain(want)


def test_round_trip_of_the_query(spark, library):
    docs = {r.doc_id: r.text or "" for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()}
    for r in queries.op12_byte_pairs(spark, "/root/testdata/sf0.001").collect():
        ids = library.encode(docs[r.doc_id], add_special_tokens=False).ids
        sha = lambda x: hashlib.sha256(x.encode()).hexdigest()
        assert (r.n_tokens, r.ids_sha256, r.decoded_sha256) == (len(ids), sha(",".join(map(str, ids))), sha(library.decode(ids, skip_special_tokens=False)))
