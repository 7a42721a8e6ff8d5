"""Queries on copies of the tables with shifted keys, whose sites lie far to the north, against their SQL."""

import duckdb
import pytest
from pyspark.sql import functions as F
from test_oracles import plain

from cadastra.plans.queries import ORACLES, QUERIES

FOLDER = "/root/testdata/sf0.001"
#: Rows of units: two that share three digits and the country, and one beyond 65 degrees.
ROWS = (1322, 1327, 8192)
FAR = ("g03_projection", "u02_cover_faults")


@pytest.fixture(scope="module")
def far(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("far"))
    orders = spark.read.parquet(f"{FOLDER}/orders.parquet").withColumn("r", F.explode(F.array(*[F.lit(r) for r in ROWS])))
    orders.withColumn("o_orderkey", F.col("o_orderkey") + F.col("r") * 1024).drop("r").write.parquet(f"{path}/orders.parquet")
    spark.read.parquet(f"{FOLDER}/customer.parquet").write.parquet(f"{path}/customer.parquet")
    return path


@pytest.mark.parametrize("name", FAR)
def test_far_sites(spark, far, name):
    duck = duckdb.connect()
    for table in ("orders", "customer"):
        duck.execute(f"CREATE VIEW {table} AS SELECT * FROM '{far}/{table}.parquet/*.parquet'")
    df = QUERIES[name](spark, far)
    cursor = duck.execute(ORACLES[name])
    names = [c[0] for c in cursor.description]
    want = sorted((tuple(plain(v) for v in r) for r in cursor.fetchall()), key=repr)
    assert sorted((tuple(plain(r[c]) for c in names) for r in df.collect()), key=repr) == want
