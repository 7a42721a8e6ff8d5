"""Edited and cropped copies of images by local descriptors.

Corners are found at several scales, turned to the direction of their patch's
intensity centroid and described by 256 binary tests of smoothed brightness.
Two descriptors match if three of their five parts agree, as those of all pairs
at most 2 bits apart do: a table has one key for every three parts, and only
numbers of images and corners go through it. Images are linked if enough of
their matched corners move by one similarity transform.

Pairs are not emitted within a key. First every image is compared with the one
that is the least of most of its keys. Then pivots of a key are compared with its
other members of other groups, groups are joined, and a pivot leaves its keys.
This goes on, with twice as many pivots each time, until every key holds one group.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .components import components
from .storage import text_batches, written

#: A scale is this much smaller than the one before; the least is the last with this many pixels a side.
STEP = 0.75
LEAST_SIDE = 38
#: Strongest corners kept at each scale, at least; larger images keep more, by their side.
CORNERS = 16
CORNER_PIXELS = 4
RADIUS = 11
#: First bits of the parts of a descriptor, and its end; so many parts make a key.
PARTS = (0, 52, 103, 154, 205, 256)
KEY_PARTS = 3
#: Pivots of a key in the second round.
PIVOTS = 1
#: Corners that must agree on a transform, its tolerance in pixels.
AGREE = 3
TOLERANCE = 2.0
BATCH = 64
#: Transforms of a pair that are tried at once.
TRIED = 64

_rng = np.random.default_rng(11)
_TESTS = np.clip(_rng.normal(0, RADIUS / 2.2, (256, 4)), -RADIUS, RADIUS)
_DISC = np.array([(y, x) for y in range(-RADIUS, RADIUS + 1) for x in range(-RADIUS, RADIUS + 1) if x * x + y * y <= RADIUS * RADIUS])

DESCRIPTORS = "image long, corner int, scale float, x float, y float, angle float, p0 long, p1 long, p2 long, p3 long, p4 long"


def _box(a: np.ndarray, r: int) -> np.ndarray:
    """Mean over squares of side 2r + 1, edges repeated; images along the first axis."""
    for axis in (1, 2):
        pad = [(0, 0)] * 3
        pad[axis] = (r + 1, r)
        s = np.cumsum(np.pad(a, pad, mode="edge"), axis=axis)
        n = a.shape[axis]
        upper, lower = [slice(None)] * 3, [slice(None)] * 3
        upper[axis], lower[axis] = slice(2 * r + 1, 2 * r + 1 + n), slice(0, n)
        a = (s[tuple(upper)] - s[tuple(lower)]) / (2 * r + 1)
    return a


def _resized(a: np.ndarray, scale: float) -> np.ndarray:
    if scale == 1.0:
        return a
    h, w = (max(8, int(s * scale)) for s in a.shape[1:])
    y, x = np.arange(h) / scale, np.arange(w) / scale
    y0, x0 = np.minimum(y.astype(int), a.shape[1] - 2), np.minimum(x.astype(int), a.shape[2] - 2)
    fy, fx = np.clip(y - y0, 0, 1)[None, :, None], np.clip(x - x0, 0, 1)[None, None, :]
    top = a[:, y0][:, :, x0] * (1 - fx) + a[:, y0][:, :, x0 + 1] * fx
    low = a[:, y0 + 1][:, :, x0] * (1 - fx) + a[:, y0 + 1][:, :, x0 + 1] * fx
    return top * (1 - fy) + low * fy


def scales(shape: tuple[int, ...]) -> list[float]:
    """1 and the smaller scales of an image."""
    n = max(0, int(np.floor(np.log(LEAST_SIDE / min(shape)) / np.log(STEP)))) if min(shape) > LEAST_SIDE else 0
    return [STEP**k for k in range(n + 1)]


def describe(images: np.ndarray) -> tuple[np.ndarray, ...]:
    """Corners of equally large grey images: image number, scale, x, y, angle and tests."""
    found = []
    corners = max(CORNERS, int(np.sqrt(images.shape[1] * images.shape[2]) / CORNER_PIXELS))
    for scale in scales(images.shape[1:]):
        a = _resized(images.astype(np.float64), scale)
        smooth = _box(a, 1)
        dy, dx = np.gradient(smooth, axis=(1, 2))
        xx, yy, xy = _box(dx * dx, 2), _box(dy * dy, 2), _box(dx * dy, 2)
        strength = xx * yy - xy * xy - 0.05 * (xx + yy) ** 2
        margin = RADIUS // 2
        strength[:, :margin] = strength[:, -margin:] = 0
        strength[:, :, :margin] = strength[:, :, -margin:] = 0
        peak = strength > 0
        for sy in (-2, -1, 0, 1, 2):
            for sx in (-2, -1, 0, 1, 2):
                if sy or sx:
                    peak &= strength >= np.roll(strength, (sy, sx), (1, 2))
        h, w = a.shape[1:]
        flat = np.where(peak, strength, 0).reshape(len(a), -1)
        best = np.argsort(-flat, axis=1, kind="stable")[:, :corners]
        at = np.repeat(np.arange(len(a)), best.shape[1])
        keep = np.take_along_axis(flat, best, 1).ravel() > 0
        at, y, x = at[keep], best.ravel()[keep] // w, best.ravel()[keep] % w
        py, px = np.clip(y[:, None] + _DISC[:, 0], 0, h - 1), np.clip(x[:, None] + _DISC[:, 1], 0, w - 1)
        patch = smooth[at[:, None], py, px]
        angle = np.arctan2((patch * _DISC[:, 0]).sum(1), (patch * _DISC[:, 1]).sum(1))
        c, s = np.cos(angle)[:, None], np.sin(angle)[:, None]
        value = []
        for ty, tx in ((_TESTS[:, 0], _TESTS[:, 1]), (_TESTS[:, 2], _TESTS[:, 3])):
            ry, rx = np.rint(y[:, None] + s * tx + c * ty).astype(int), np.rint(x[:, None] + c * tx - s * ty).astype(int)
            value.append(smooth[at[:, None], np.clip(ry, 0, h - 1), np.clip(rx, 0, w - 1)])
        bits = value[0] < value[1]
        found.append((at, np.full(len(at), scale), x / scale, y / scale, angle, bits))
    return tuple(np.concatenate(c) for c in zip(*found, strict=True))


def _descriptor_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        shapes = list(zip(batch.column("height").to_pylist(), batch.column("width").to_pylist(), strict=True))
        for shape in dict.fromkeys(shapes):
            rows = np.array([i for i, s in enumerate(shapes) if s == shape])
            for at in range(0, len(rows), BATCH):
                own = rows[at : at + BATCH]
                pixels = np.stack([np.frombuffer(batch.column("pixels")[int(i)].as_py(), np.uint8).reshape(shape) for i in own])
                image, scale, x, y, angle, bits = describe(pixels)
                parts = [np.packbits(np.pad(bits[:, a:b], ((0, 0), (64 - (b - a), 0))), axis=1).view(">i8")[:, 0].astype(np.int64) for a, b in zip(PARTS[:-1], PARTS[1:], strict=True)]
                by = np.argsort(image, kind="stable")
                image = image[by]
                corner = np.arange(len(image)) - np.searchsorted(image, image)
                yield pa.record_batch(
                    [
                        batch.column("image").take(pa.array(own[image])),
                        pa.array(corner.astype(np.int32)),
                        *(pa.array(c[by].astype(np.float32)) for c in (scale, x, y, angle)),
                        *(pa.array(p[by]) for p in parts),
                    ],
                    names=["image", "corner", "scale", "x", "y", "angle", "p0", "p1", "p2", "p3", "p4"],
                )


def agreeing(x1: np.ndarray, y1: np.ndarray, x2: np.ndarray, y2: np.ndarray, turn: np.ndarray, zoom: np.ndarray) -> int:
    """The most matches, at different places of the first image, that the transform of one of them explains."""
    c, s = np.cos(turn) * zoom, np.sin(turn) * zoom
    tx, ty = x2 - (c * x1 - s * y1), y2 - (s * x1 + c * y1)
    # corners of several scales at one place count once
    _, place = np.unique(np.stack([x1 // 2, y1 // 2]), axis=1, return_inverse=True)
    most = 0
    for at in range(0, len(c), TRIED):
        p = slice(at, at + TRIED)
        ex = c[p, None] * x1 - s[p, None] * y1 + tx[p, None] - x2
        ey = s[p, None] * x1 + c[p, None] * y1 + ty[p, None] - y2
        which, match = np.nonzero(ex * ex + ey * ey <= TOLERANCE**2)
        count = np.unique(which * (place.max() + 1) + place.ravel()[match]) // (place.max() + 1)
        most = max(most, int(np.bincount(count).max()))
    return most


def _common(keys: list[np.ndarray], corners: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of corners of two images that share a key."""
    by = np.argsort(keys[1], kind="stable")
    there = keys[1][by]
    low = np.searchsorted(there, keys[0], "left")
    n = np.searchsorted(there, keys[0], "right") - low
    other = by[np.repeat(low - (np.cumsum(n) - n), n) + np.arange(n.sum())]
    pairs = np.unique(np.repeat(corners[0], n).astype(np.int64) << 32 | corners[1][other])
    return pairs >> 32, pairs & 0xFFFFFFFF


def _agreeing_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """How many corners of each pair of images agree on a transform."""
    for batch in batches:
        most = []
        for row in range(batch.num_rows):
            held = {f"{c}_{i}": batch.column(f"{c}_{i}")[row].values.to_numpy() for i in "ab" for c in ("keys", "at", "corner", "x", "y", "angle", "scale")}
            found = _common([held["keys_a"], held["keys_b"]], [held["at_a"], held["at_b"]])
            if len(np.unique(found[0])) < AGREE:
                most.append(0)
                continue
            place = {}
            for i, corner in zip("ab", found, strict=True):
                by = np.argsort(held[f"corner_{i}"])
                index = by[np.searchsorted(held[f"corner_{i}"][by], corner)]
                place |= {f"{c}_{i}": held[f"{c}_{i}"][index].astype(np.float64) for c in ("x", "y", "angle", "scale")}
            most.append(agreeing(place["x_a"], place["y_a"], place["x_b"], place["y_b"], place["angle_b"] - place["angle_a"], place["scale_a"] / place["scale_b"]))
        yield pa.record_batch([batch.column("a"), batch.column("b"), pa.array(most, pa.int32())], names=["a", "b", "agree"])


def _verified(pairs: DataFrame, held: DataFrame) -> DataFrame:
    """(a, b, agree) of the pairs with AGREE corners or more under one transform."""
    for i in "ab":
        pairs = pairs.join(held.select(F.col("image").alias(i), *[F.col(c).alias(f"{c}_{i}") for c in held.columns if c != "image"]), i)
    return pairs.mapInArrow(_agreeing_rows, "a long, b long, agree int").where(F.col("agree") >= AGREE)


def image_groups(images: DataFrame) -> DataFrame:
    """(node, component): images, by number, that are linked with another, and the least number of their group.

    ``images`` has image (a number), height, width and pixels (grey, one byte each).
    """
    text_batches(images)
    corners = written(images.select("image", "height", "width", "pixels").mapInArrow(_descriptor_rows, DESCRIPTORS), "corners")
    keys = F.array(*[F.xxhash64(F.lit(n), *(f"p{i}" for i in of)) for n, of in enumerate(combinations(range(len(PARTS) - 1), KEY_PARTS))])
    same = Window.partitionBy("key")
    entries = corners.select(F.explode(keys).alias("key"), "image", "corner")
    shared = entries.withColumns({"least": F.min("image").over(same), "most": F.max("image").over(same)}).where("least != most")
    entries = written(shared.select("key", "image", "corner"), "entries")
    # a row per image, as lists of plain numbers; 32 bits of a key do to find what two images share
    short = F.col("key").bitwiseAND(F.lit(0x7FFFFFFF).cast("long")).cast("int")
    keys = entries.groupBy("image").agg(F.collect_list(short).alias("keys"), F.collect_list("corner").alias("at"))
    places = corners.join(entries.select("image", "corner").distinct(), ["image", "corner"])
    places = places.groupBy("image").agg(*[F.collect_list(c).alias(c) for c in ("corner", "x", "y", "angle", "scale")])
    held = written(keys.join(places, "image"), "held")

    members = entries.select("key", "image").distinct()
    links = labels = checked = None
    pivots = PIVOTS
    while True:
        grouped = members.withColumn("component", F.col("image"))
        if labels is not None:
            grouped = members.join(labels.withColumnRenamed("node", "image"), "image", "left").withColumn("component", F.coalesce("component", "image"))
        grouped = written(grouped, "members")
        # a pivot for each class of a hash: partial minima, so a key of very many images costs each task a few rows
        chosen = F.pmod(F.xxhash64("image", F.lit(pivots)), F.lit(pivots))
        open_ = grouped.groupBy("key").agg(F.min("component").alias("least"), F.max("component").alias("most")).where("least != most").select("key")
        heads = grouped.join(open_, "key").groupBy("key", chosen.alias("class")).agg(F.min(F.struct("image", "component")).alias("p"))
        heads = written(heads.select("key", F.col("p.image").alias("b"), F.col("p.component").alias("cb")), "pivots")
        if heads.isEmpty():
            break
        pairs = grouped.withColumnRenamed("image", "a").join(heads, "key").where("a != b and component != cb")
        star = labels is None
        if star:
            best = F.max_by("b", F.struct("n", -F.col("b")))
            pairs = pairs.groupBy("a", "b").agg(F.count(F.lit(1)).alias("n")).groupBy("a").agg(best.alias("b"))
        pairs = pairs.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
        if not star:
            pairs = pairs.join(checked, ["a", "b"], "left_anti")
        pairs = written(pairs, "pairs")
        found = written(_verified(pairs, held), "links")
        links, checked = (found, pairs) if links is None else (links.union(found), checked.union(pairs))
        labels = written(components(links.select("a", "b")), "groups")
        if star:
            continue
        members = grouped.join(heads.select("key").distinct(), "key", "left_semi").join(heads.select("key", F.col("b").alias("image")), ["key", "image"], "left_anti").select("key", "image")
        pivots *= 2
    none = images.select(F.col("image").alias("node"), F.col("image").alias("component")).where("false")
    return none if labels is None else labels


def image_copies(images: DataFrame, id: str = "image_id") -> DataFrame:
    """(id, group_id): each image's least id among its copies; copies of copies are one group.

    Images of equal pixels and size are one. Null, empty or mis-sized pixels take
    no part: their group is their own id. Of a group without ids the id is null.
    """
    text_batches(images)
    own = images.select(F.col(id).alias("_id"), "height", "width", "pixels")
    sound = F.coalesce((F.col("height") >= 16) & (F.col("width") >= 16) & (F.octet_length("pixels") == F.col("height") * F.col("width")), F.lit(False))
    key = F.when(sound, F.unhex(F.md5(F.concat(F.col("pixels"), F.concat_ws("x", "height", "width").cast("binary")))))
    keyed = own.select("_id", key.alias("key"))
    distinct = own.where(sound).withColumn("key", key).groupBy("key", "height", "width").agg(F.first("pixels").alias("pixels"))
    distinct = written(distinct.withColumn("image", F.monotonically_increasing_id()), "images")
    groups = image_groups(distinct.select("image", "height", "width", "pixels"))
    named = distinct.select("key", "image").join(groups.withColumnRenamed("node", "image"), "image", "left").select("key", F.coalesce("component", "image").alias("component"))
    named = keyed.join(named, "key", "left")
    least = named.where("component is not null").groupBy("component").agg(F.min("_id").alias("least"))
    out = named.join(least, "component", "left")
    return out.select(F.col("_id").alias(id), F.coalesce("least", "_id").alias("group_id"))


def _drawn_rows(side: int, cell: int) -> Callable:
    size = side * cell

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at = np.clip((np.arange(size) + 0.5) / cell - 0.5, 0, side - 1 - 1e-9)
        low = at.astype(int)
        weight = np.zeros((size, side))
        weight[np.arange(size), low] = 1 - (at - low)
        weight[np.arange(size), low + 1] += at - low
        for b in (batch.slice(at, BATCH) for batch in batches for at in range(0, batch.num_rows, BATCH)):
            grid = b.column("grid").flatten().to_numpy().reshape(-1, side, side)
            image = np.einsum("ya,nab,xb->nyx", weight, grid, weight)
            span = np.maximum(np.abs(image).max(axis=(1, 2), keepdims=True), 1e-12)
            pixels = np.rint(127 + 120 * image / span).astype(np.uint8)
            ids, edited = b.column("vec_id").to_numpy(), b.column("edited").to_numpy(zero_copy_only=False)
            rows = [(2 * i, size, size, p.tobytes()) for i, p in zip(ids.tolist(), pixels, strict=True)]
            # an edited copy: cropped, darker and flatter
            rows += [(2 * i + 1, size - 8, size - 12, (20 + p[3:-5, 5:-7] * 0.8).astype(np.uint8).tobytes()) for i, p, e in zip(ids.tolist(), pixels, edited, strict=True) if e]
            yield pa.record_batch([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), (pa.int64(), pa.int32(), pa.int32(), pa.binary()), strict=True)], names=["image_id", "height", "width", "pixels"])

    return run


def drawn_images(embeddings: DataFrame) -> DataFrame:
    """Images made of 64 numbers each: a smooth 64 x 64 picture, and an edited copy where label is 0."""
    grid = F.col("embedding").cast("array<double>").alias("grid")
    rows = embeddings.where("vec_id is not null and size(embedding) = 64").select("vec_id", grid, F.coalesce(F.col("label") == 0, F.lit(False)).alias("edited"))
    rows = rows.where(F.forall("grid", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))))
    return rows.mapInArrow(_drawn_rows(8, 8), "image_id long, height int, width int, pixels binary")
