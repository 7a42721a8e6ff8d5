"""Short rings judged many at once against the judgement one by one."""

import random
import time

import numpy as np
import pyarrow as pa

from cadastra.functions import validity

KIND = pa.list_(pa.list_(pa.struct([("x", pa.float64()), ("y", pa.float64())])))


def column(rings):
    return pa.array([None if r is None else [None if q is None else [{"x": x, "y": y} for x, y in q] for q in r] for r in rings], KIND)


def one_by_one(shapes):
    return [validity._one_status(s) for s in shapes]


def test_random_short_rings():
    rng, rings = random.Random(5), [None, [], [[]], [None], [[(0.0, 0.0)]], [[(0.0, 0.0), (1.0, None), (1.0, 1.0), (0.0, 0.0)]]]
    for k in range(4000):
        scale, shift = rng.choice([(1, 0), (1, 4e6), (0.1, 0.3), (1e-9, 1), (1 / 3, 1e7)]), 0
        points = [(rng.randint(0, 4) * scale[0] + scale[1], rng.randint(0, 4) * scale[0] + scale[1]) for _ in range(rng.randint(2, 8))]
        rings.append([points + points[:1] if k % 9 else points])
        if k % 50 == 0:
            rings.append([points + points[:1], points])
    shapes = column(rings)
    assert validity._status(shapes).to_pylist() == one_by_one(shapes)
    assert validity._status(shapes.slice(7, 900)).to_pylist() == one_by_one(shapes.slice(7, 900))


def test_many_boxes_take_little_time():
    boxes = column([[[(x, y), (x + 9, y), (x + 9, y + 7), (x, y + 7), (x, y)]] for x, y in np.random.default_rng(1).integers(0, 10**6, (5000, 2)).astype(float).tolist()])
    t = time.process_time()
    some = one_by_one(boxes[:500])
    each, t = (time.process_time() - t) * 10, time.process_time()
    assert validity._status(boxes).to_pylist() == some * 10 == ["valid"] * 5000
    assert (time.process_time() - t) * 5 < each
