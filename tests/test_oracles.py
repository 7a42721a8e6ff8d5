"""Every building query against its SQL in DuckDB, at sf0.001; those that decide by areas at sf0.01, too, where ratios lie on the limits."""

import decimal
import math
from pathlib import Path

import duckdb
import pytest

from cadastra.plans.queries import ORACLES, QUERIES

FOLDER = "/root/testdata"
AREAS = ("g11_", "g17_", "j02_", "j03_", "j09_", "j18_", "j19_merge", "d01_", "d02_")
CASES = [("sf0.001", n) for n in sorted(QUERIES)] + [("sf0.01", n) for n in sorted(QUERIES) if n.startswith(AREAS)]


@pytest.fixture(scope="module")
def duck():
    found = {}
    for sf in {sf for sf, _ in CASES}:
        found[sf] = duckdb.connect()
        for path in Path(FOLDER, sf).glob("*.parquet"):
            found[sf].execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    return found


def plain(v):
    if isinstance(v, decimal.Decimal):
        v = float(v)
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 6) + 0.0
    return tuple(map(plain, v)) if isinstance(v, (list, tuple)) else v


@pytest.mark.parametrize(("sf", "name"), CASES)
def test_query(spark, duck, sf, name):
    df = QUERIES[name](spark, f"{FOLDER}/{sf}")
    cols = sorted(df.columns)
    got = sorted((tuple(plain(r[c]) for c in cols) for r in df.collect()), key=repr)
    if name not in ORACLES:
        assert got
        return
    cursor = duck[sf].execute(ORACLES[name])
    names = [c[0] for c in cursor.description]
    assert sorted(names) == cols
    want = sorted((tuple(plain(r[names.index(c)]) for c in cols) for r in cursor.fetchall()), key=repr)
    assert got == want
