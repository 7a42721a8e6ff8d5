"""N-gram Jaccard join by filtering under multiple global orders.

Under any order of all tokens, two sets with Jaccard similarity t share tokens
among the first ones of both. With set size n and o = ceil(t * n), the first
n - o + r tokens hold at least r common ones, r = ``extra`` of the smaller set.
Each order is (level in a count sketch of fixed size, hash with the order's seed),
so tokens of very many documents come last in all orders, and the orders differ
in the rest. A text survives an order if enough of its prefix is shared with
other texts; orders are applied one after the other to the survivors. What is
left lies in buckets of equal prefix tokens. First every text is compared with
one pivot of its buckets, the text that shares most with all others: the one that
a group was copied from, if it is there, as the copies lack some of its tokens.
Buckets that then hold several groups are left. Small ones give pairs; pairs and
large buckets tie texts to clusters, which are cut into bands of set sizes, and
those into blocks of bounded size. A task takes two blocks, of a band or of two
neighbouring ones, and compares texts of different groups that pass the filters
of all orders. No pairs are emitted within a large bucket.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .components import components
from .storage import bounded, distinct_texts, text_batches, text_key, unbroadcast, written
from .words import Words, chunks, mix, shingle_sets

SHINGLE = 5
PERCENT = 75
#: Common prefix tokens asked for beyond one, in hundredths of the set size.
EXTRA_PERCENT = 4
#: Slots of the sketches over all texts and over those that survive the first order.
SLOTS = (1 << 16, 1 << 18)
#: Seed of each order and the sketch it uses.
ORDERS = ((1, 0), (2, 1), (3, 1))
#: Members of a bucket that gives pairs; the texts of a larger one are one cluster.
PAIRED = 16
#: Texts, and shingles, of a block of a cluster, about; a task compares two blocks at a time.
BLOCK_TEXTS = 1024
BLOCK_SHINGLES = 1_000_000
BLOCK_ROWS = 1024
#: Share of rows that a pass of pruning must keep for it to be the last.
PRUNED = 0.9


def extra(n):
    """Prefix tokens that two sets must share, by the size of the smaller."""
    return 1 + n * EXTRA_PERCENT // 100


def _slots(hashes: np.ndarray, slots: int) -> np.ndarray:
    return (mix(hashes, 99) >> np.uint64(32)).astype(np.int64) & (slots - 1)


_SKETCH = "key binary, n_shingles long, slot int, count long"


def _profile_rows(k: int, slots: int, keys: bool) -> Callable:
    """Per task its counts of shingles by sketch slot; with keys, per text its key and set size."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(slots, np.int64)
        names = ["key", "n_shingles", "slot", "count"]
        for batch in batches:
            for part in chunks(batch, "text"):
                rows, hashes = shingle_sets(part.column("text"), k)
                counts += np.bincount(_slots(hashes, slots), minlength=slots)
                if keys:
                    n = np.bincount(rows, minlength=part.num_rows)
                    yield pa.record_batch([part.column("key"), pa.array(n.astype(np.int64)), pa.nulls(part.num_rows, pa.int32()), pa.nulls(part.num_rows, pa.int64())], names=names)
        seen = np.flatnonzero(counts)
        yield pa.record_batch([pa.nulls(len(seen), pa.binary()), pa.nulls(len(seen), pa.int64()), pa.array(seen.astype(np.int32)), pa.array(counts[seen])], names=names)

    return run


def _levels(sketch: DataFrame, slots: int) -> np.ndarray:
    """How far above the mean a slot's count is, in half powers of two; the driver holds ``slots`` numbers."""
    counts = np.zeros(slots)
    # as columns: rows of Python objects take a hundred bytes a number
    summed = sketch.where("slot is not null").groupBy("slot").agg(F.sum("count").alias("count")).toArrow()
    counts[summed["slot"].to_numpy()] = summed["count"].to_numpy()
    mean = max(counts.mean(), 1)
    return np.maximum(0, np.floor(2 * np.log2(np.maximum(counts, 1) / mean))).astype(np.uint64)


def prefixes(rows: np.ndarray, hashes: np.ndarray, levels: np.ndarray, order: int, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """Which tokens of (row, hash) sets are in the prefix under an order, and all set sizes by row."""
    n = np.bincount(rows) if len(rows) else np.zeros(0, np.int64)
    rank = (levels[_slots(hashes, len(levels))] << np.uint64(56)) | (mix(hashes, order) >> np.uint64(8))
    by = np.argsort(rank, kind="stable")
    by = by[np.argsort(rows[by], kind="stable")]
    first = np.concatenate(([0], np.cumsum(n)))[:-1]
    place = np.arange(len(rows)) - first[rows[by]]
    size = n[rows[by]]
    length = size + (-size * percent // 100) + extra(size)
    return by[place < length], n


def _prefix_rows(k: int, levels, order: tuple[int, int], percent: int, key: str) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in chunks(batch, "text"):
                rows, hashes = shingle_sets(part.column("text"), k)
                if not len(rows):
                    continue
                kept, _ = prefixes(rows, hashes, levels.value[order[1]], order[0], percent)
                yield pa.record_batch([pa.array(hashes[kept].view(np.int64)), part.column(key).take(pa.array(rows[kept]))], names=["token", key])

    return run


def _needed(percent: int):
    return F.expr(f"1 + floor(ceil(n * {percent} / 100) * {EXTRA_PERCENT} / 100)")


def _shared(rows: DataFrame, key: str) -> DataFrame:
    """Rows whose token another text has, too."""
    same = Window.partitionBy("token")
    marked = rows.withColumns({"least": F.min(key).over(same), "most": F.max(key).over(same)})
    return marked.where("least != most").select("token", key)


class _Sets:
    """Shingle sets of texts and their prefixes under every order."""

    def __init__(self, texts: pa.Array, k: int, levels: list[np.ndarray], percent: int):
        self.sets: list[np.ndarray] = []
        self.heads: list[list[np.ndarray]] = [[] for _ in ORDERS]
        for part in chunks(pa.record_batch([texts], names=["text"]), "text"):
            rows, hashes = shingle_sets(part.column("text"), k)
            self.sets += self._split(rows, hashes, part.num_rows)
            for (order, sketch), heads in zip(ORDERS, self.heads, strict=True):
                kept = np.sort(prefixes(rows, hashes, levels[sketch], order, percent)[0])
                heads += self._split(rows[kept], hashes[kept], part.num_rows)

    @staticmethod
    def _split(rows: np.ndarray, hashes: np.ndarray, n: int) -> list[np.ndarray]:
        return np.split(hashes, np.cumsum(np.bincount(rows, minlength=n))[:-1])

    def linked(self, i: int, j: int, percent: int) -> bool:
        """Every order's prefixes share enough, and so do the whole sets."""
        a, b = self.sets[i], self.sets[j]
        need = extra(min(len(a), len(b)))
        if any(len(np.intersect1d(h[i], h[j], assume_unique=True)) < need for h in self.heads):
            return False
        common = len(np.intersect1d(a, b, assume_unique=True))
        return 100 * common >= percent * (len(a) + len(b) - common)


def _verified_rows(k: int, levels, percent: int) -> Callable:
    """For pairs that carry both texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in chunks(batch, "text_a"):
                _, index, inverse = np.unique(part.column("b").to_numpy(), return_index=True, return_inverse=True)
                other = part.column("text_b").take(pa.array(index))
                both = _Sets(pa.concat_arrays([part.column("text_a"), other]), k, levels.value, percent)
                linked = [both.linked(i, part.num_rows + int(j), percent) for i, j in enumerate(inverse)]
                yield pa.record_batch([part.column("a"), part.column("b"), pa.array(linked, pa.bool_())], names=["a", "b", "linked"])

    return run


def _cluster_rows(k: int, levels, percent: int) -> Callable:
    """Links between the texts of two blocks, or of one; rows come sorted by ``cluster``, a number of both."""

    def links(table: pa.RecordBatch) -> pa.RecordBatch:
        sets = _Sets(table.column("text"), k, levels.value, percent)
        node, cluster = table.column("node").to_numpy(), table.column("cluster").to_numpy()
        side, one = table.column("side").to_numpy(), table.column("one").to_numpy(zero_copy_only=False)
        n = np.array([len(x) for x in sets.sets])
        _, root = np.unique(table.column("component").to_numpy(), return_inverse=True)
        members: dict[int, list[int]] = {}
        for i, r in enumerate(root.tolist()):
            members.setdefault(r, []).append(i)
        # postings of the prefixes of one order, within a cluster
        heads = sets.heads[-2]
        owner = np.repeat(np.arange(len(n)), [len(h) for h in heads])
        token = np.concatenate(heads) ^ mix(cluster[owner].astype(np.uint64))
        by = np.argsort(token, kind="stable")
        token, posted = token[by], owner[by]
        begin = np.searchsorted(token, token, "left")
        end = np.searchsorted(token, token, "right")
        first, last = np.empty_like(begin), np.empty_like(end)
        first[by], last[by] = begin, end
        bounds = np.concatenate(([0], np.cumsum([len(h) for h in heads])))
        found = []
        for i in range(len(n)):
            lo, hi = first[bounds[i] : bounds[i + 1]], last[bounds[i] : bounds[i + 1]]
            width = hi - lo
            if not len(width) or width.max() < 2:
                continue
            at = np.repeat(lo - np.concatenate(([0], np.cumsum(width)[:-1])), width) + np.arange(width.sum())
            shared = np.bincount(posted[at], minlength=len(n))
            near = (shared >= extra(np.minimum(n, n[i]))) & (100 * np.minimum(n, n[i]) >= percent * np.maximum(n, n[i])) & (cluster == cluster[i])
            near[: i + 1] = False
            near &= one[i] | (side != side[i])
            for j in np.flatnonzero(near).tolist():
                # members of one component need no further link
                if root[i] != root[j] and sets.linked(i, j, percent):
                    found.append((node[i], node[j]))
                    keep, gone = root[i], root[j]
                    moved = members.pop(gone)
                    root[moved] = keep
                    members[keep] += moved
        return pa.record_batch([pa.array([x for x, _ in found], pa.int64()), pa.array([x for _, x in found], pa.int64()), pa.array([True] * len(found), pa.bool_())], names=["a", "b", "linked"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for batch in batches:
            for at in range(0, batch.num_rows, BLOCK_ROWS):
                held.append(batch.slice(at, BLOCK_ROWS))
                table = pa.Table.from_batches(held).combine_chunks().to_batches()[0]
                clusters = table.column("cluster").to_numpy()
                cut = int(np.searchsorted(clusters, clusters[-1], "left"))
                if cut:
                    yield links(table.slice(0, cut))
                held = [table.slice(cut)]
        if held:
            yield links(pa.Table.from_batches(held).combine_chunks().to_batches()[0])

    return run


def _carried(pairs: DataFrame, texts: DataFrame, k: int, levels, percent: int) -> DataFrame:
    """Pairs (a, b) with linked, both texts brought to each pair."""
    ta, tb = (texts.select(F.col("node").alias(x), F.col("text").alias(f"text_{x}")) for x in "ab")
    sides = pairs.join(ta, "a").join(tb, "b").select("a", "b", "text_a", "text_b")
    return sides.mapInArrow(_verified_rows(k, levels, percent), "a long, b long, linked boolean")


def text_components(docs: DataFrame, text: str = "text", k: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """Per distinct text with words: key, n_shingles, and the class key it is linked to.

    Texts without words have class null. The class key is that of one member.
    """
    spark = docs.sparkSession
    text_batches(docs)
    own = docs.select(F.col(text).cast("string").alias("text")).where(F.col("text").isNotNull())
    profile = written(
        own.select(text_key("text").alias("key"), "text").mapInArrow(_profile_rows(k, SLOTS[0], True), _SKETCH),
        "profile",
    )
    sizes = profile.where("key is not null").groupBy("key").agg(F.first("n_shingles").alias("n_shingles"))
    # nodes are numbers, so that tokens travel with 8 bytes of their text
    # a row per text: its joins never go through the driver
    sizes = unbroadcast(written(sizes.withColumn("node", F.monotonically_increasing_id()), "sizes"))
    sketches = [_levels(profile, SLOTS[0])]
    levels = spark.sparkContext.broadcast(sketches)

    numbered = distinct_texts(docs, text).join(sizes.where("n_shingles > 0"), "key")
    numbered = numbered.select("node", "text", "copies", F.col("n_shingles").alias("n"))
    rows = numbered.mapInArrow(_prefix_rows(k, levels, ORDERS[0], percent, "node"), "token long, node long")
    alive = _shared(rows, "node").groupBy("node").agg(F.count(F.lit(1)).alias("shared"))
    alive = alive.join(sizes.select("node", F.col("n_shingles").alias("n")), "node").where(F.col("shared") >= _needed(percent)).select("node")
    alive = sizes.where("n_shingles > 0").join(alive, "node").select("key", "node", F.col("n_shingles").alias("n"))
    first = distinct_texts(docs, text).join(unbroadcast(alive), "key").select("node", "text", "copies", "n")
    first = written(first, "survivors")
    sketches.append(_levels(first.select("text").mapInArrow(_profile_rows(k, SLOTS[1], False), _SKETCH), SLOTS[1]))
    levels = spark.sparkContext.broadcast(sketches)

    rows = first.select("node", "text").mapInArrow(_prefix_rows(k, levels, ORDERS[1], percent, "node"), "token long, node long")
    shared = written(_shared(rows, "node"), "buckets")
    same = Window.partitionBy("token")
    alive = shared.withColumn("size", F.count(F.lit(1)).over(same)).groupBy("node").agg(F.count(F.lit(1)).alias("shared"), F.sum("size").alias("weight"))
    alive = alive.join(first.select("node", "n"), "node").where(F.col("shared") >= _needed(percent)).select("node", "n", "weight")
    buckets = shared.join(alive, "node").select("token", "node", "n", "weight")

    source = first.select("node", "text")

    def active(members: DataFrame) -> DataFrame:
        """Rows of buckets that hold more than one component."""
        return members.withColumns({"least": F.min("component").over(same), "most": F.max("component").over(same)}).where("least != most").drop("least", "most")

    def pruned(members: DataFrame, name: str) -> DataFrame:
        """Rows of buckets of several components, of texts that have enough of them for a link; few are left out by then."""
        # the smaller set of a link has at least percent of n shingles
        enough = F.expr(f"1 + floor(ceil(n * {percent} / 100) * {EXTRA_PERCENT} / 100)")
        rows = members.count()
        while True:
            members = active(members)
            held = members.groupBy("node").agg(F.count(F.lit(1)).alias("held"), F.first("n").alias("n")).where(F.col("held") >= enough)
            members = written(members.join(held.select("node"), "node"), name)
            before, rows = rows, members.count()
            if rows >= PRUNED * before:
                return members

    def proposed(members: DataFrame, others: DataFrame, near: str) -> DataFrame:
        others = others.select("token", *[F.col(c).alias(f"{c}_b") for c in others.columns if c != "token"])
        fit = f"{near} and component != component_b and 100 * least(n, n_b) >= {percent} * greatest(n, n_b)"
        return members.join(others, "token").where(fit)

    # first each text with the pivot that it shares most with
    members = active(buckets.withColumn("component", F.col("node")))
    heads = members.groupBy("token").agg(F.max_by(F.struct("node", "n", "component"), F.struct("weight", -F.col("node"))).alias("p")).select("token", "p.*")
    best = proposed(members, heads, "node != node_b").groupBy("node", "node_b").agg(F.count(F.lit(1)).alias("shared"))
    best = best.groupBy("node").agg(F.max_by("node_b", F.struct("shared", -F.col("node_b"))).alias("b"))
    best = best.select(F.greatest("node", "b").alias("a"), F.least("node", "b").alias("b")).distinct()
    links = written(_carried(best, source, k, levels, percent).where("linked").select("a", "b"), "links")
    labels = bounded(written(components(links), "labels"))

    # then the buckets of several components
    members = pruned(buckets.join(labels, "node", "left").withColumn("component", F.coalesce("component", "node")), "members")
    members = written(members.withColumn("size", F.count(F.lit(1)).over(same)), "members")
    wide = members.where(F.col("size") > PAIRED)
    counts = wide.groupBy("node").agg(F.count(F.lit(1)).alias("wide"))
    narrow = members.where(F.col("size") <= PAIRED).join(counts, "node", "left").select("token", "node", "n", "component", F.coalesce("wide", F.lit(0)).alias("wide"))
    pairs = proposed(narrow, narrow, "node > node_b").groupBy("node", "node_b", "n", "n_b", "wide", "wide_b").agg(F.count(F.lit(1)).alias("shared"))
    # other common prefix tokens lie in wide buckets of both
    enough = F.col("shared") + F.least("wide", "wide_b") >= F.expr(f"1 + floor(least(n, n_b) * {EXTRA_PERCENT} / 100)")
    pairs = pairs.where(enough).select(F.col("node").alias("a"), F.col("node_b").alias("b"))
    # a pair without narrow buckets needs enough wide ones
    wide = pruned(wide, "wide").withColumn("head", F.min("node").over(same))
    hung = wide.where("node != head").select(F.col("node").alias("a"), F.col("head").alias("b")).distinct()
    inside = components(pairs.union(hung)).withColumnRenamed("component", "cluster")
    facts = members.groupBy("node").agg(F.first("n").alias("n"), F.first("component").alias("component"))
    inside = written(inside.join(facts, "node"), "clusters")
    blocks = F.greatest(F.ceil(F.count(F.lit(1)) / BLOCK_TEXTS), F.ceil(F.sum("n") / BLOCK_SHINGLES)).cast("int")
    # a cluster of one component is done
    open_ = inside.groupBy("cluster").agg(blocks.alias("blocks"), F.min("component").alias("least"), F.max("component").alias("most")).where("least != most").select("cluster", "blocks")
    # the sizes of a link are of one band or of neighbouring ones; bands are a little wider than that, for rounding
    band = F.when(F.col("blocks") > 1, F.floor(F.log("n") / math.log(1.005 * 100 / percent))).otherwise(0)
    banded = inside.join(open_, "cluster").select("cluster", "node", "n", "component", band.alias("band"))
    bands = banded.groupBy("cluster", "band").agg(blocks.alias("blocks"))
    others = bands.select("cluster", F.explode(F.array(*map(F.lit, (-1, 0, 1)))).alias("step"), "band", F.col("blocks").alias("others")).withColumn("band", F.col("band") - F.col("step"))
    sides = banded.join(bands.join(others, ["cluster", "band"]), ["cluster", "band"])
    # a row per text and band to compare it with; it is multiplied by that band's blocks where it is sent to them
    sides = sides.select("cluster", "node", "component", "band", "step", F.pmod(F.xxhash64("node"), "blocks").cast("int").alias("own"), "others")
    dealt = unbroadcast(sides).join(source, "node").withColumn("other", F.explode(F.sequence(F.lit(0), F.col("others") - 1)))
    upper = F.when(F.col("step") == 0, F.col("own") > F.col("other")).otherwise(F.col("step") < 0)
    ends = [F.when(upper, x).otherwise(y) for x, y in ((F.col("other"), F.col("own")), (F.col("own"), F.col("other")))]
    both = F.xxhash64("cluster", F.least("band", F.col("band") + F.col("step")), F.abs("step"), *ends)
    one = (F.col("step") == 0) & (F.col("own") == F.col("other"))
    dealt = dealt.select(both.alias("cluster"), "node", "component", upper.cast("int").alias("side"), one.alias("one"), "text")
    dealt = dealt.repartition("cluster").sortWithinPartitions("cluster", "node")
    found = written(dealt.mapInArrow(_cluster_rows(k, levels, percent), "a long, b long, linked boolean").select("a", "b"), "links")
    labels = components(links.union(found))
    named = labels.join(sizes.select("node", "key"), "node").join(sizes.select(F.col("node").alias("component"), F.col("key").alias("class")), "component")
    out = sizes.join(named.select("key", "class"), "key", "left")
    return out.select("key", "n_shingles", F.when(F.col("n_shingles") > 0, F.coalesce("class", "key")).alias("class"))


def jaccard_components(docs: DataFrame, id: str = "doc_id", text: str = "text", k: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """Every row of ``docs`` with n_shingles and component_id, the least id reachable by links.

    Two texts link when 100 * intersection >= percent * union of their sets of
    lower-cased k-word shingles (a text of fewer words is one shingle). Texts
    that are null or without words have size 0 and only themselves. Null ids are
    passed over in the minimum; a component of null ids has a null id. Columns
    of ``docs`` stay; result columns replace columns of the same names.
    """
    classes = text_components(docs, text, k, percent)
    names = ("n_shingles", "component_id")
    left = docs.select(*[F.col(f"`{c}`") for c in docs.columns if c not in names], text_key(text).alias("_key"))
    keyed = docs.select(F.col(f"`{id}`").alias("_id"), text_key(text).alias("key"))
    least = keyed.join(classes, "key").groupBy("class").agg(F.min("_id").alias("_least")).where("class is not null")
    named = classes.join(least, "class", "left").select(F.col("key").alias("_key"), F.col("n_shingles").alias("_n"), F.col("class").alias("_class"), "_least")
    out = left.join(named, "_key", "left")
    return out.select(
        *[F.col(f"`{c}`") for c in docs.columns if c not in names],
        F.coalesce("_n", F.lit(0)).cast("long").alias("n_shingles"),
        F.when(F.col("_class").isNull(), F.col(f"`{id}`")).otherwise(F.col("_least")).alias("component_id"),
    )
