"""Exact top-k against brute force, and how many partial scores are resolved pair by pair."""

import numpy as np
import pytest
from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from runledger.llm.topk import Lists, top_k

COLUMNS = "vec_id long, v array<double>, score string, rank int"


@pytest.fixture(scope="module")
def spark():
    return SparkSession.builder.master("local[4]").config("spark.sql.shuffle.partitions", "4").config("spark.ui.enabled", "false").getOrCreate()


def brute(rows, asks, k):
    out = []
    for q, v in {q: max(v for i, v in rows if i == q) for q, _ in rows if asks(q)}.items():
        scores = sorted((-int(sum(x * y for x, y in zip(v, w))), i) for i, w in rows if i != q)
        out += [(q, n + 1, i, -s) for n, (s, i) in enumerate(scores[:k])]
    return sorted(out)


@pytest.mark.parametrize(("segments", "block"), [(2, 8192), (3, 4), (1, 8192), (50, 8192)])
def test_equals_brute_force(spark, segments, block):
    pick = np.random.default_rng(5)
    centres = pick.integers(-60, 60, (4, 12))
    rows = [(int(i), [float(x) for x in centres[i % 4] + pick.integers(-9, 9, 12)]) for i in range(300)]
    rows += [(300 + i, rows[i % 5][1]) for i in range(40)] + [(400, []), (401, [1.0]), (402, [0.0] * 20), (10, rows[10][1]), (7, rows[3][1])]
    df = spark.createDataFrame([(i, v, "x", 1) for i, v in rows], COLUMNS).repartition(7)
    got = sorted(map(tuple, top_k(df, F.col("vec_id") % 10 == 0, 5, segments, block).collect()))
    assert got == brute(rows, lambda q: q % 10 == 0, 5)


def test_few_candidates_and_empty_table(spark):
    rows = [(0, [1.0, 2.0]), (1, [3.0, -4.0]), (2, [3.0, -4.0])]
    df = spark.createDataFrame([(i, v, "x", 1) for i, v in rows], COLUMNS)
    assert sorted(map(tuple, top_k(df, F.col("vec_id") == 0).collect())) == [(0, 1, 1, -5), (0, 2, 2, -5)]
    assert top_k(df.filter("vec_id > 9"), F.col("vec_id") == 0).collect() == []


def test_few_pairs_are_resolved():
    pick = np.random.default_rng(6)
    centres = pick.integers(-60, 60, (40, 64))
    rows = np.array([centres[i % 40] + pick.integers(-9, 9, 64) for i in range(1000)], float)
    ids = np.arange(0, 1000, 50)
    lists = Lists(ids, rows[ids], 5, 2)
    c = lists.cut(rows)
    first = lists.best(np.arange(1000), *lists.first(np.arange(1000), c))
    cutoff = first.groupby("query_id")["score"].min().reindex(ids).to_numpy(float)
    lists.resolved = 0
    found = lists.best(np.arange(1000), *lists.sufficient(np.arange(1000), c, cutoff))
    assert lists.resolved < 0.2 * len(ids) * 1000
    assert len(found) == 5 * len(ids)
