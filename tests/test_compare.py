"""Two readings against plain loops: fields, arrays, nulls, missing and repeated keys, multisets both ways."""

import pytest
from pyspark.sql import SparkSession

from runledger.operators.compare import compare_pairs, compare_readings, multiset_both_ways


@pytest.fixture(scope="module")
def spark():
    return SparkSession.builder.master("local[4]").config("spark.sql.shuffle.partitions", "4").config("spark.ui.enabled", "false").getOrCreate()


def test_fields(spark):
    schema = "k int, name string, score double, marks array<double>, n int"
    a = [(1, "x", 1.0, [1.0, 2.0], 1), (2, "x", 1.0, [1.0, None], 1), (3, None, None, None, None), (4, "x", 1.0, [], 2), (5, "a", 1.0, [], 1), (7, "t", 1.0, [], 1), (7, "t", 1.0, [], 1)]
    b = [(1, "x", 1.004, [1.0, 2.004], 1), (2, "y", 1.01, [1.0, 0.0], None), (3, None, None, None, None), (4, "x", None, [1.0], 2), (6, "b", 1.0, [], 1), (7, "t", 1.0, [], 1)]
    got = sorted(map(repr, map(tuple, compare_readings(spark.createDataFrame(a, schema), spark.createDataFrame(b, schema), ["k"]).collect())))
    want = [(2, "name", "x", "y"), (2, "score", "1.0", "1.01"), (2, "marks", "[1.0,null]", "[1.0,0.0]"), (2, "n", "1", None), (4, "score", "1.0", None), (4, "marks", "[]", "[1.0]"), (5, "only a", "1", None), (6, "only b", None, "1"), (7, "repeated", "2", "1")]
    assert got == sorted(map(repr, want))


def test_multisets(spark):
    schema = "g int, v long"
    a, b = [(1, 5), (1, 5), (1, 6), (2, 1), (3, None)], [(1, 5), (1, 7), (1, 7), (3, None), (4, 2)]
    got = {tuple(r) for r in multiset_both_ways(spark.createDataFrame(a, schema), spark.createDataFrame(b, schema), ["g"], "v").collect()}
    assert got == {(1, 3, 3, 2, 2), (2, 1, 0, 1, 0), (3, 1, 1, 0, 0), (4, 0, 1, 0, 1)}


def test_pairs_side_by_side(spark):
    """Keys with a null equal none, as in a join; a reading that lacks a key or has it twice is not compared."""
    rows = [(1, 1, 1, ("x", 1.0), ("y", 1.0)), (2, 1, 1, ("x", 1.0), ("x", 1.004)), (None, 1, 1, ("x", 1.0), ("x", 1.0)), (3, 2, 1, ("x", 1.0), ("z", 1.0)), (4, 1, None, ("x", 1.0), None), (5, None, 1, None, ("x", 1.0)), (None, None, 1, None, ("x", 1.0))]
    both = spark.createDataFrame(rows, "k int, n_a long, n_b long, a struct<name: string, score: double>, b struct<name: string, score: double>")
    got = sorted(map(repr, map(tuple, compare_pairs(both, ["k"]).collect())))
    assert got == sorted(map(repr, [(1, "name", "x", "y"), (None, "only a", "1", None), (None, "only b", None, "1"), (3, "repeated", "2", "1"), (4, "only a", "1", None), (5, "only b", None, "1"), (None, "only b", None, "1")]))
