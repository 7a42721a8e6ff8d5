"""How far each source's wording lies from that of other sources of its language, and by which terms.

A group is a (lang, source). Per language the terms found in enough documents
are kept, and every group and the language as a whole give each of them a
smoothed share p in whole billionths. The divergence of p from q is
floor((p - q)^2 / q), summed over all kept terms for a pair of groups.

Pairs are worked out row by row as in Gustavson's sparse product: the term-major
index holds per kept term its counts by source, and each group scatters its
terms through it into a dense accumulator with one place per peer, so pairs of
postings are never rows. Terms that one side or both lack are part of the sum,
too: all terms start at the baseline of two zero counts, and a term that the
group or the peer has puts in the difference. Differences of terms that only the group or
only the peer has hang on the count alone, so each distinct count is worked out once per block.

Whole numbers are exact: p comes from a long division by thousands, and sums of
f stay below 2^63, as the p of a group add up to at most 10^9 and one per kept term.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .storage import text_batches, written

#: Documents of a language that a kept term is in, at least; ranks of terms that are returned.
LEAST_DOCUMENTS = 3
TOP_TERMS = 200
#: Distinct (group, term) that a task counts before it sends them, and postings scattered at once.
FLUSH_TERMS = 300_000
BLOCK_POSTINGS = 1 << 17

#: A-Z lowered; other bytes of ASCII than letters are blanks.
_TERM_BYTES = bytes(b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


def _count_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts: dict[tuple[str, str], tuple[Counter, Counter]] = {}
    held = 0

    def sent() -> Iterator[pa.RecordBatch]:
        for (lang, source), (n, docs) in counts.items():
            terms = list(n)
            columns = [pa.array([lang]).take(pa.array(np.zeros(len(terms), np.int32))), pa.array([source]).take(pa.array(np.zeros(len(terms), np.int32)))]
            columns += [pa.array(terms, pa.binary()).cast(pa.string()), pa.array(list(n.values()), pa.int64()), pa.array([docs[t] for t in terms], pa.int64())]
            yield pa.record_batch(columns, names=["lang", "source", "term", "n", "docs"])
        counts.clear()

    for batch in batches:
        for lang, source, text in zip(*(batch.column(c) for c in ("lang", "source")), batch.column("text"), strict=True):
            data = bytes(text.as_buffer()).translate(_TERM_BYTES)
            key = (lang.as_py(), source.as_py())
            n, docs = counts.setdefault(key, (Counter(), Counter()))
            before = len(n)
            terms = data.split()
            n.update(terms)
            docs.update(set(terms))
            held += len(n) - before
            if held >= FLUSH_TERMS:
                yield from sent()
                held = 0
    yield from sent()


def term_counts(docs: DataFrame) -> DataFrame:
    """(lang, source, term, n, docs): occurrences and documents of each term. ``docs`` has lang, source, text, none null."""
    text_batches(docs)
    own = docs.select("lang", "source", "text").where("text <> ''")
    sent = own.mapInArrow(_count_terms, "lang string, source string, term string, n long, docs long")
    return sent.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))


def term_index(counts: DataFrame, least: int = LEAST_DOCUMENTS) -> DataFrame:
    """(lang, term, n, postings): each kept term with its count by source, written, in order of lang within a file.

    A posting list has at most one entry per source of the language.
    """
    posting = F.collect_list(F.struct("source", "n"))
    index = counts.groupBy("lang", "term").agg(F.sum("docs").alias("docs"), F.sum("n").alias("n"), posting.alias("postings")).where(F.col("docs") >= least).drop("docs")
    return written(index.sortWithinPartitions("lang"), "index")


@dataclass
class Language:
    """A language's sources in order, their term counts N, and the number V of its kept terms."""

    sources: list[str]
    totals: np.ndarray
    kept: int
    total: int


def _languages(groups: DataFrame, index: DataFrame) -> dict[str, Language]:
    """Driver-held: one entry per (lang, source). The result has a row for each pair of them."""
    by_lang = {r.lang: (r.kept, r.total) for r in index.groupBy("lang").agg(F.count(F.lit(1)).alias("kept"), F.sum("n").alias("total")).collect()}
    postings = index.select("lang", F.explode("postings").alias("p"))
    totals = {(r.lang, r.source): r.total for r in postings.groupBy("lang", F.col("p.source").alias("source")).agg(F.sum("p.n").alias("total")).collect()}
    found: dict[str, list[str]] = {}
    for lang, source in groups.collect():
        found.setdefault(lang, []).append(source)
    out = {}
    for lang, sources in found.items():
        sources.sort()
        kept, total = by_lang.get(lang, (0, 0))
        out[lang] = Language(sources, np.array([totals.get((lang, s), 0) for s in sources], np.int64), kept, total)
    return out


def shares(count: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """1 + floor(10^9 * (count + 1) / weight), exact."""
    whole, rest = np.divmod(count + 1, weight)
    for _ in range(3):
        step, rest = np.divmod(rest * 1000, weight)
        whole = whole * 1000 + step
    return whole + 1


def share(count: Column, weight: Column) -> Column:
    """The same as a column."""
    whole, rest = _div(count + 1, weight), (count + 1) % weight
    for _ in range(3):
        whole, rest = whole * 1000 + _div(rest * 1000, weight), (rest * 1000) % weight
    return whole + 1


def _div(a: Column, b: Column) -> Column:
    """Whole quotient of numbers that are not negative."""
    return F.call_function("div", a, b)


def divergence(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    return (p - q) * (p - q) // q


def _scatter(languages: Broadcast) -> Callable:
    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, pa.Table]]:
        """Runs of index rows of one language with about BLOCK_POSTINGS postings."""
        for batch in batches:
            lang = batch.column("lang").to_pylist()
            ends = np.asarray(batch.column("postings").offsets).astype(np.int64)
            row = 0
            while row < batch.num_rows:
                end = int(np.searchsorted(ends, ends[row] + BLOCK_POSTINGS, "right")) - 1
                end = min(max(end, row + 1), batch.num_rows)
                while lang[end - 1] != lang[row]:
                    end = row + next(i for i, x in enumerate(lang[row:end]) if x != lang[row])
                yield lang[row], batch.slice(row, end - row).column("postings")
                row = end

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: tuple[str, np.ndarray] | None = None
        for lang, postings in blocks(batches):
            known = languages.value[lang]
            if held is None or held[0] != lang:
                if held is not None:
                    yield sent(*held)
                held = (lang, np.zeros((len(known.sources), len(known.sources)), np.int64))
            _scatter_block(postings, known, held[1])
        if held is not None:
            yield sent(*held)

    def sent(lang: str, acc: np.ndarray) -> pa.RecordBatch:
        group, peer = np.nonzero(acc)
        names = pa.array(languages.value[lang].sources, pa.string())
        columns = [pa.array([lang] * len(group), pa.string()), names.take(pa.array(group)), names.take(pa.array(peer)), pa.array(acc[group, peer])]
        return pa.record_batch(columns, names=["lang", "source", "item", "value"])

    return run


def _scatter_block(postings: pa.Array, known: Language, acc: np.ndarray) -> None:
    """Add to ``acc`` (group, peer) what the block's terms change against two zero counts."""
    n_groups = len(known.sources)
    weight = known.totals + known.kept
    number = {s: i for i, s in enumerate(known.sources)}
    flat = postings.flatten()
    source = np.fromiter(map(number.__getitem__, flat.field("source").to_pylist()), np.int64, len(flat))
    count = flat.field("n").to_numpy(zero_copy_only=False)
    begin = np.asarray(postings.offsets).astype(np.int64) - postings.offsets[0].as_py()
    term = np.repeat(np.arange(len(postings)), np.diff(begin))
    p, zero = shares(count, weight[source]), shares(np.zeros(n_groups, np.int64), weight)
    base = divergence(zero[:, None], zero[None])
    order = np.argsort(source, kind="stable")
    edge = np.searchsorted(source[order], np.arange(n_groups + 1))
    for g in range(n_groups):
        own = order[edge[g] : edge[g + 1]]
        if not len(own):
            continue
        # terms of the group against a peer without them, and the other way round, by distinct count
        value, times = np.unique(p[own], return_counts=True)
        acc[g] += ((divergence(value[:, None], zero[None]) - base[g]) * times[:, None]).sum(axis=0)
        acc[:, g] += ((divergence(zero[:, None], value[None]) - base[:, g, None]) * times[None]).sum(axis=1)
        # terms of both: through the index to every peer's posting
        size = begin[term[own] + 1] - begin[term[own]]
        at = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size) + np.repeat(begin[term[own]], size)
        mine, theirs, peer = np.repeat(p[own], size), p[at], source[at]
        changed = divergence(mine, theirs) - divergence(mine, zero[peer]) - divergence(zero[g], theirs) + base[g, peer]
        np.add.at(acc[g], peer, changed)


def audit(docs: DataFrame, least: int = LEAST_DOCUMENTS, top: int = TOP_TERMS) -> DataFrame:
    """(lang, source, part, item, value, rank) for every group of ``docs`` (lang, source, text; nulls count as '').

    Part ``pair``: the group's divergence from each other source of its language, all ranks.
    Part ``term``: terms that the group uses more than its language as a whole, the ``top`` of each group.
    Ranks go by descending value, ties by the item's bytes. A language without
    kept terms has pairs of value 0, a source alone in its language has none.
    Repeated rows count each; an empty table gives an empty result; other columns take no part.
    """
    spark = docs.sparkSession
    own = docs.select(*[F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")).alias(c) for c in ("lang", "source", "text")])
    index = term_index(term_counts(own), least)
    groups = own.select("lang", "source").distinct()
    known = _languages(groups, index)
    rows = [(lang, s, int(n), x.kept, x.total) for lang, x in known.items() for s, n in zip(x.sources, x.totals, strict=True)]
    table = F.broadcast(spark.createDataFrame(rows, "lang string, source string, total long, kept long, lang_total long"))
    changed = index.select("lang", "postings").mapInArrow(_scatter(spark.sparkContext.broadcast(known)), "lang string, source string, item string, value long")
    changed = changed.groupBy("lang", "source", "item").agg(F.sum("value").alias("changed"))
    other = table.select("lang", F.col("source").alias("item"), F.col("total").alias("item_total"))
    p, q = (share(F.lit(0).cast("long"), F.col(c) + F.col("kept")) for c in ("total", "item_total"))
    pairs = table.join(other, "lang").where("source <> item").join(changed, ["lang", "source", "item"], "left")
    base = F.when(F.col("kept") > 0, F.col("kept") * _div((p - q) * (p - q), q)).otherwise(0)
    pairs = pairs.select("lang", "source", F.lit("pair").alias("part"), "item", (base + F.coalesce("changed", F.lit(0))).alias("value"))
    posting = index.select("lang", "term", F.col("n").alias("lang_n"), F.explode("postings").alias("p")).select("lang", F.col("p.source").alias("source"), F.col("term").alias("item"), "lang_n", F.col("p.n").alias("n"))
    terms = posting.join(table, ["lang", "source"])
    terms = terms.select("lang", "source", "item", share(F.col("n"), F.col("total") + F.col("kept")).alias("p"), share(F.col("lang_n"), F.col("lang_total") + F.col("kept")).alias("q")).where("p > q")
    terms = terms.select("lang", "source", F.lit("term").alias("part"), "item", _div((F.col("p") - F.col("q")) * (F.col("p") - F.col("q")), F.col("q")).alias("value"))
    place = F.expr("row_number() over (partition by lang, source, part order by value desc, item)").alias("rank")
    # the window's limit is applied in every task before rows are exchanged
    best = terms.select("*", place).where(F.col("rank") <= top)
    return pairs.select("*", place).unionByName(best)
