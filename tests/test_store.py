"""The published store: versions, pruning by the manifest, stale and missing files, sweeping."""

import glob
import os

import pytest
from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from runledger.sources import store


@pytest.fixture(scope="module")
def spark():
    return SparkSession.builder.master("local[4]").config("spark.sql.shuffle.partitions", "4").config("spark.sql.session.timeZone", "UTC").config("spark.ui.enabled", "false").getOrCreate()


def runs(spark, rows):
    return spark.createDataFrame(rows, "run_id long, score long, season string")


ROWS = [(1, 10, "a"), (2, 20, "a"), (3, None, "b"), (4, 40, "c"), (4, 40, "c")]


@pytest.fixture
def root(spark, tmp_path):
    store.publish(spark, str(tmp_path), {"runs": (runs(spark, ROWS), "season")}, 1)
    return str(tmp_path)


def test_reads_only_the_wanted_partition(spark, root):
    one = store.read(spark, root, "runs", ["a"])
    assert sorted(map(tuple, one.collect())) == [(1, 10, "a"), (2, 20, "a")]
    assert one.inputFiles() and all("season=a" in f for f in one.inputFiles())
    scan = one._jdf.queryExecution().executedPlan().toString()
    assert "season=b" not in scan and "InMemoryFileIndex(1 paths)" in scan
    pruned = store.read(spark, root, "runs").filter("season = 'b'").select("run_id")
    plan = pruned._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(season" in plan and "ReadSchema: struct<run_id:bigint>" in plan
    assert sorted(map(tuple, store.read(spark, root, "runs").collect()), key=repr) == sorted(ROWS, key=repr)


def test_second_version_keeps_equal_partitions_and_drops_vanished_ones(spark, root):
    before = {f: os.path.getmtime(f) for f in glob.glob(f"{root}/data/runs/season=a/h=*/part-*")}
    second = [(2, 20, "a"), (1, 10, "a"), (4, 41, "c"), (9, 90, "d")]
    store.publish(spark, root, {"runs": (runs(spark, second).repartition(3), "season")}, 2)
    assert {f: os.path.getmtime(f) for f in glob.glob(f"{root}/data/runs/season=a/h=*/part-*")} == before
    assert sorted(map(tuple, store.read(spark, root, "runs").collect())) == sorted(second)
    with pytest.raises(LookupError):
        store.read(spark, root, "runs", ["b"])
    assert len(store.sweep(spark, root)) == 2
    assert not glob.glob(f"{root}/data/runs/season=b/h=*") and len(glob.glob(f"{root}/data/runs/season=c/h=*")) == 1
    assert sorted(map(tuple, store.read(spark, root, "runs").collect())) == sorted(second)
    assert store.sweep(spark, root) != [] and store.verify(spark, root, "runs").filter("NOT hash <=> hash_found").isEmpty()


def test_files_without_a_manifest_are_not_seen(spark, root):
    """A publication that broke off before its manifest leaves the old version."""
    runs(spark, [(7, 70, "a")]).withColumn("h", F.lit("new")).write.mode("append").partitionBy("season", "h").parquet(f"{root}/data/runs")
    assert sorted(map(tuple, store.read(spark, root, "runs").collect()), key=repr) == sorted(ROWS, key=repr)


def test_stale_and_missing_files(spark, root):
    (path,) = glob.glob(f"{root}/data/runs/season=a/h=*")
    runs(spark, [(1, 11, "a"), (2, 20, "a")]).drop("season").write.mode("overwrite").parquet(path)
    found = {r["part"]: (r["n"] == r["n_found"], r["hash"] == r["hash_found"]) for r in store.verify(spark, root, "runs").collect()}
    assert found == {"a": (True, False), "b": (True, True), "c": (True, True)}
    (path,) = glob.glob(f"{root}/data/runs/season=b/h=*")
    os.rename(path, f"{root}/elsewhere")
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        store.read(spark, root, "runs").collect()


def test_hash_ignores_order_and_sees_copies_and_swaps(spark):
    of = lambda rows: [(r["n"], r["hash"]) for r in store.content_hash(runs(spark, rows).repartition(3), ["season"], ["run_id", "score"]).collect()]
    one = of([(1, 2, "a"), (2, 1, "a"), (3, 3, "a")])
    assert one == of([(3, 3, "a"), (2, 1, "a"), (1, 2, "a")])
    assert one != of([(1, 1, "a"), (2, 2, "a"), (3, 3, "a")]) and one != of([(1, 2, "a"), (1, 2, "a"), (3, 3, "a")]) and one != of([(1, 2, "a"), (2, 1, "a"), (3, None, "a")])
