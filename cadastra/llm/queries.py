"""Registered queries of this subpackage: name -> (spark, sf_dir) -> DataFrame."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .byte_pairs import decoded, encoded
from .divergence import LEAST_DOCUMENTS, TOP_TERMS, audit
from .images import drawn_images, image_copies
from .jaccard_join import jaccard_components
from .licenses import BLOCK, COMMON, FILE_SHARE, THRESHOLD, scan_licenses, template_terms, TEMPLATES
from .mixing import mix
from .neighbours import nearest
from .packing import pack_documents
from .piece_counts import piece_counts
from .resampling import resample
from .sharding import SIZE_OVERHEAD, shard_by_bytes
from .substring_dedup import remove_repeats
from .toxicity import held_out, score, train


def _documents(spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", *columns)


def op1_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents mixed by source, in proportion to the square root of the sources' rows."""
    return mix(_documents(spark, sf_dir, "source"))


def op2_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 nearest other rows of every vector whose id is divisible by 20; see :func:`nearest` on vectors that take no part."""
    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "embedding")
    return nearest(vectors, F.col("id") % 20 == 0)


SHARDS = 40


def op3_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in 40 shards of even bytes; a null text has 16 bytes, equal texts may lie apart."""
    size = F.coalesce(F.octet_length("text"), F.lit(0)) + SIZE_OVERHEAD
    crc = F.crc32(F.coalesce("text", F.lit("")).cast("binary"))
    rows = _documents(spark, sf_dir, "text").select("doc_id", size.cast("long").alias("size"), crc.alias("text_crc32"))
    out = shard_by_bytes(rows, "size", "doc_id", SHARDS)
    return out.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def op4_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without words of windows that start elsewhere, too; null and empty texts have no words."""
    out = remove_repeats(_documents(spark, sf_dir, "text"), keep_text=False)
    return out.select("doc_id", "n_words", "n_removed", "kept_sha256")


def op5_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as files of a tree: source, language, thousands of ids."""
    docs = _documents(spark, sf_dir, "text", "lang", "source")
    path = F.concat_ws("/", "source", "lang", F.floor(F.col("doc_id") / 10_000), F.floor(F.col("doc_id") / 1000), "doc_id")
    files = docs.select("doc_id", path.alias("path"), "text")
    return scan_licenses(files, "path", "text").select("doc_id", "path", "licence", F.round("score", 6).alias("score"), "origin")


def op6_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Greedy pieces of every document; a null text has none."""
    return piece_counts(_documents(spark, sf_dir, "text"), word_vocabulary()).select("doc_id", "n_words", "n_pieces")


def op7_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with its component; null texts and texts without words are alone."""
    return jaccard_components(_documents(spark, sf_dir, "text")).select("doc_id", "n_shingles", "component_id")


def word_vocabulary() -> str:
    """The packing tokenizer's file; it stays where it is installed."""
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def op8_image_copies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Images drawn from all embeddings, with edited copies of some; group_id tells copies."""
    return image_copies(drawn_images(spark.read.parquet(f"{sf_dir}/embeddings.parquet")))


def op9_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pieces of all documents in sequences; a null text is one end id."""
    out = pack_documents(_documents(spark, sf_dir, "text"), word_vocabulary())
    return out.select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scores of every document, null and empty texts included; labels of held-out ids are not learnt from."""
    docs = _documents(spark, sf_dir, "text")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").where(~held_out("doc_id"))
    out = score(docs, train(docs, labels))
    return out.select("doc_id", held_out("doc_id").alias("held_out"), "score", "predicted")


def op11_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each source against the others of its language, and the terms it uses more than the language does."""
    return audit(_documents(spark, sf_dir, "text", "lang", "source"))


def byte_vocabulary() -> str:
    """The byte-level tokenizer's file; it stays where it is installed."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def op12_byte_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents to ids and back; digests of the ids as decimals and of the decoded text."""
    ids = encoded(_documents(spark, sf_dir, "text"), byte_vocabulary())
    out = decoded(ids, byte_vocabulary(), keep_ids=True)
    decimal = F.array_join(F.col("ids").cast("array<string>"), ",")
    return out.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), F.sha2(decimal.cast("binary"), 256).alias("ids_sha256"), F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"))


def op13_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A quarter of the documents of 20 words or more, drawn towards the distribution of the benchmark texts."""
    out = resample(_documents(spark, sf_dir, "text"), spark.read.parquet(f"{sf_dir}/benchmark.parquet").select("text"))
    return out.select("doc_id", "n_features", "weight", "score", "rank")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_mixing": op1_mixing,
    "op2_nearest_neighbours": op2_nearest_neighbours,
    "op3_sharding": op3_sharding,
    "op4_substring_dedup": op4_substring_dedup,
    "op5_license_scan": op5_license_scan,
    "op6_token_counts": op6_token_counts,
    "op7_ngram_jaccard_join": op7_ngram_jaccard_join,
    "op8_image_copies": op8_image_copies,
    "op9_best_fit_packing": op9_best_fit_packing,
    "op10_toxicity": op10_toxicity,
    "op11_source_divergence": op11_source_divergence,
    "op12_byte_pairs": op12_byte_pairs,
    "op13_resampling": op13_resampling,
}

def _quoted(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def _license_sql() -> str:
    """op5 in DuckDB: every line, block and whole text against every template, without the bound on shares."""
    terms = ", ".join(f"({i}, {_quoted(licence)}, {_quoted(t)}, {n})" for i, licence, t, n in template_terms(TEMPLATES))
    common = ", ".join(map(_quoted, COMMON))
    split = "list_filter(string_split_regex(lower({0}), '[^a-z0-9]+'), lambda t: t <> '' AND t NOT IN ({1}))"
    words = "len(list_filter(string_split_regex({0}, '[ \\t\\r\\n]+'), lambda w: w <> ''))"
    return f"""WITH t(number, licence, term, n) AS (VALUES {terms}),
 f AS (SELECT doc_id, concat_ws('/', source, lang, CAST(floor(doc_id / 10000) AS BIGINT), CAST(floor(doc_id / 1000) AS BIGINT), doc_id) AS path, coalesce(text, '') AS text FROM documents),
 total AS (SELECT count(*) AS total FROM f),
 df AS (SELECT term, count(*) AS df FROM (SELECT doc_id, unnest(list_distinct({split.format("text", common)})) AS term FROM f) WHERE term IN (SELECT term FROM t) GROUP BY 1),
 idf AS (SELECT DISTINCT term, ln((1 + total) / (1 + coalesce(df, 0))) + 1 AS idf FROM t LEFT JOIN df USING (term), total),
 v AS (SELECT number, licence, term, n * idf AS v FROM t JOIN idf USING (term)),
 notice AS (SELECT number, licence, term, v / sqrt(sum(v * v) OVER (PARTITION BY number)) AS v FROM v),
 u AS (SELECT path, text, unnest(list_distinct(list_concat(string_split(text, chr(10)), string_split_regex(text, {_quoted(BLOCK)}), [text]))) AS unit FROM f),
 d AS (SELECT unit, term, count(*) AS tf FROM (SELECT unit, unnest({split.format("unit", common)}) AS term FROM (SELECT DISTINCT unit FROM u)) GROUP BY 1, 2),
 w AS (SELECT unit, term, tf * coalesce(idf, ln(1 + total) + 1) AS w FROM d LEFT JOIN idf USING (term), total),
 norm AS (SELECT unit, sqrt(sum(w * w)) AS length FROM w GROUP BY 1),
 c AS (SELECT unit, licence, round(sum(w * v) / min(length), 9) AS score FROM w JOIN notice USING (term) JOIN norm USING (unit) GROUP BY unit, number, licence),
 m AS (SELECT unit, licence, score FROM (SELECT *, row_number() OVER (PARTITION BY unit ORDER BY score DESC, licence) AS r FROM c) WHERE r = 1 AND score >= {THRESHOLD}),
 own AS (SELECT path, licence, score, {words.format("unit")} >= {FILE_SHARE} * {words.format("text")} AS is_file FROM (SELECT *, row_number() OVER (PARTITION BY path ORDER BY score DESC, length(unit) DESC, licence, unit) AS r FROM u JOIN m USING (unit)) WHERE r = 1),
 dir AS (SELECT regexp_extract(path, '^(.*)/[^/]*$', 1) AS up, licence, score FROM (SELECT *, row_number() OVER (PARTITION BY regexp_extract(path, '^(.*)/[^/]*$', 1) ORDER BY path) AS r FROM own WHERE is_file) WHERE r = 1),
 near AS (SELECT path, dir.licence, dir.score FROM (SELECT f.path, max(length(up)) AS depth FROM f JOIN dir ON up = '' OR starts_with(f.path, up || '/') GROUP BY 1) x JOIN dir ON length(up) = depth AND (up = '' OR starts_with(path, up || '/')))
 SELECT doc_id, f.path, coalesce(own.licence, near.licence) AS licence, round(coalesce(own.score, near.score), 6) AS score, CASE WHEN own.licence IS NOT NULL THEN 'own' WHEN near.licence IS NOT NULL THEN 'inherited' ELSE 'none' END AS origin
 FROM f LEFT JOIN own ON own.path = f.path LEFT JOIN near ON near.path = f.path"""


def _lowered(text: str) -> str:
    return f"translate({text}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


def _divergence_sql() -> str:
    """op11 in DuckDB: every pair of groups over every kept term."""
    words = f"regexp_extract_all({_lowered('text')}, '[^\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]+')"
    f = "CAST((p - q) * (p - q) // q AS BIGINT)"
    share = "1 + (1000000000 * (CAST(coalesce({n}, 0) AS HUGEINT) + 1)) // ({total} + kept)"
    return f"""WITH d AS (SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source, coalesce(text, '') AS text FROM documents),
 w AS (SELECT r, lang, source, unnest({words}) AS term FROM d),
 k AS (SELECT lang, term, count(*) AS n FROM w GROUP BY 1, 2 HAVING count(DISTINCT r) >= {LEAST_DOCUMENTS}),
 c AS (SELECT lang, source, term, count(*) AS n FROM w WHERE (lang, term) IN (SELECT (lang, term) FROM k) GROUP BY 1, 2, 3),
 l AS (SELECT lang, count(*) AS kept, sum(n) AS total FROM k GROUP BY 1),
 g AS (SELECT lang, source, coalesce(kept, 0) AS kept, coalesce((SELECT sum(n) FROM c WHERE c.lang = s.lang AND c.source = s.source), 0) AS total FROM (SELECT DISTINCT lang, source FROM d) s LEFT JOIN l USING (lang)),
 p AS (SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS n, {share.format(n="c.n", total="g.total")} AS p FROM g JOIN k ON k.lang = g.lang LEFT JOIN c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term),
 pair AS (SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // b.p) AS value FROM p a JOIN p b ON b.lang = a.lang AND b.term = a.term AND b.source <> a.source GROUP BY 1, 2, 3),
 term AS (SELECT lang, source, term AS item, {f} AS value FROM (SELECT p.lang, p.source, p.term, p, {share.format(n="k.n", total="l.total")} AS q FROM p JOIN k ON k.lang = p.lang AND k.term = p.term JOIN l ON l.lang = p.lang WHERE p.n > 0) WHERE p > q),
 u AS (SELECT a.lang, a.source, 'pair' AS part, b.source AS item, CAST(coalesce(value, 0) AS BIGINT) AS value FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source LEFT JOIN pair ON pair.lang = a.lang AND pair.source = a.source AND pair.item = b.source UNION ALL SELECT lang, source, 'term', item, value FROM term)
 SELECT lang, source, part, item, value, CAST(r AS INTEGER) AS rank FROM (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS r FROM u) WHERE part = 'pair' OR r <= {TOP_TERMS}"""


def _resampling_sql() -> str:
    """op13 in DuckDB, which has no CRC: bytes are taken through the table of the polynomial."""
    table = [i for i in range(256)]
    for _ in range(8):
        table = [(c >> 1) ^ (0xEDB88320 if c & 1 else 0) for c in table]
    hex_byte = "(instr('0123456789ABCDEF', h[2*i+1]) - 1) * 16 + instr('0123456789ABCDEF', h[2*i+2]) - 1"
    step = f"xor({table}[CAST((xor(c, b) & 255) + 1 AS INTEGER)], c >> 8)"
    words = f"regexp_extract_all({_lowered('text')}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"
    runs = f"list_concat(w, list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]))"
    return f"""WITH d AS (SELECT row_number() OVER () AS r, doc_id, {words} AS w FROM (SELECT doc_id, coalesce(text, '') AS text FROM documents)),
 e AS (SELECT {words} AS w FROM benchmark WHERE text IS NOT NULL),
 df AS (SELECT r, unnest({runs}) AS f FROM d), ef AS (SELECT unnest({runs}) AS f FROM e),
 x AS (SELECT f, hex(encode(f)) AS h FROM (SELECT f FROM df UNION SELECT f FROM ef)),
 v AS (SELECT f, list_transform(range(length(h) // 2), lambda i: CAST({hex_byte} AS BIGINT)) AS bytes FROM x),
 b AS (SELECT f, xor(list_reduce(bytes, lambda c, b: {step}, CAST(4294967295 AS BIGINT)), 4294967295) % 10000 AS bucket FROM v),
 s AS (SELECT bucket, count(*) AS s FROM df JOIN b USING (f) GROUP BY 1), t AS (SELECT bucket, count(*) AS t FROM ef JOIN b USING (f) GROUP BY 1),
 n AS (SELECT (SELECT count(*) FROM df) AS all_s, (SELECT count(*) FROM ef) AS all_t),
 g AS (SELECT i AS bucket, CAST(floor(1000 * ln(CAST(coalesce(t, 0) + 1 AS DOUBLE) * (all_s + 10000) / (CAST(coalesce(s, 0) + 1 AS DOUBLE) * (all_t + 10000)))) AS BIGINT) AS gain FROM range(10000) q(i) CROSS JOIN n LEFT JOIN s ON s.bucket = i LEFT JOIN t ON t.bucket = i),
 m AS (SELECT r, count(*) AS n_features, CAST(sum(gain) AS BIGINT) AS total FROM df JOIN b USING (f) JOIN g USING (bucket) GROUP BY 1),
 z AS (SELECT doc_id, len(w) AS n_words, coalesce(n_features, 0) AS n_features, CASE WHEN n_features > 0 THEN (total - ((total % n_features) + n_features) % n_features) // n_features ELSE 0 END AS weight, CAST('0x' || substr(sha256('7:' || coalesce(CAST(doc_id AS VARCHAR), '')), 1, 8) AS BIGINT) AS h FROM d LEFT JOIN m USING (r)),
 y AS (SELECT *, weight + CAST(floor(-1000 * ln(-ln((h + 0.5::DOUBLE) / 4294967296))) AS BIGINT) AS score FROM z),
 o AS (SELECT *, row_number() OVER (PARTITION BY n_words >= 20 ORDER BY score DESC, doc_id) AS k, count(*) FILTER (n_words >= 20) OVER () * 25 // 100 AS wanted FROM y)
 SELECT doc_id, n_features, weight, score, CASE WHEN n_words >= 20 AND k <= wanted THEN k END AS rank FROM o"""


#: The other operators are held against brute force in tests.
ORACLES: dict[str, str] = {"op5_license_scan": _license_sql(), "op11_source_divergence": _divergence_sql(), "op13_resampling": _resampling_sql()}
