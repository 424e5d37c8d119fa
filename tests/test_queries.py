import zlib
from collections import Counter

import duckdb
import pytest
from pyspark.sql import SparkSession

from runledger.queries import QUERIES, SQL

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def spark():
    return SparkSession.builder.master("local[4]").config("spark.sql.shuffle.partitions", "4").config("spark.sql.session.timeZone", "UTC").config("spark.ui.enabled", "false").getOrCreate()


@pytest.mark.parametrize("name", SQL)
def test_equals_sql(spark, name):
    db = duckdb.connect()
    for t in ("region", "nation", "customer", "supplier", "orders", "lineitem", "part", "documents", "events", "conversations", "embeddings", "pages", "labels", "benchmark"):
        db.sql(f"CREATE VIEW {t} AS FROM '{SF}/{t}.parquet'")
    df = QUERIES[name](spark, SF)
    columns = sorted(df.columns)
    want = db.sql(f"SELECT {', '.join(columns)} FROM ({SQL[name]})").fetchall()
    assert sorted(map(repr, map(tuple, df.select(columns).collect()))) == sorted(map(repr, want))
    assert want


def test_shards_and_sizes(spark):
    """crc32 is not in the other engine: shards, runs and round sizes against plain sums."""
    rows = spark.sql(f"SELECT o_custkey AS a, CASE WHEN month(o_orderdate) < 7 THEN year(o_orderdate) - 1 ELSE year(o_orderdate) END AS y, o_orderpriority AS p FROM parquet.`{SF}/orders.parquet`").collect()
    size = Counter((r["y"], r["p"]) for r in rows)
    shard = lambda a: zlib.crc32(str(a).encode()) % 64
    want = {}
    for s in {shard(r["a"]) for r in rows}:
        own = [r for r in rows if shard(r["a"]) == s]
        met = {(r["y"], r["p"]) for r in own}
        want[s] = (len({r["a"] for r in own}), len(own), len(met), sum(size[m] for m in met))
    got = {r["shard"]: (r["n_athletes"], r["n_runs"], r["n_rounds"], r["round_sizes"]) for r in QUERIES["shards_and_sizes"](spark, SF).collect()}
    assert got == want
