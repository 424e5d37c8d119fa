"""Clusters, greedy pairs, overlaps and ranks against plain loops."""

import random

import pytest
from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from runledger.operators.ranks import competition_rank
from runledger.operators.sequences import anchored_clusters, best_of, greedy_pairs, overlaps


@pytest.fixture(scope="module")
def spark():
    return SparkSession.builder.master("local[4]").config("spark.sql.shuffle.partitions", "4").config("spark.sql.session.timeZone", "UTC").config("spark.ui.enabled", "false").getOrCreate()


def rows(seed, n=400):
    pick = random.Random(seed)
    return [(pick.randrange(5), i, pick.randrange(120) if pick.random() < 0.9 else 50, pick.choice("mw")) for i in range(n)]


@pytest.mark.parametrize("seed", range(4))
def test_anchored_clusters(spark, seed):
    data = rows(seed, 60)
    want, gaps = {}, {}
    for g in range(5):
        first, last, n, m = None, None, 0, 0
        for k, i in sorted((k, i) for h, i, k, _ in data if h == g):
            if first is None or k - first > 7:
                first, n = k, n + 1
            m += last is None or k - last > 7
            last, want[i], gaps[i] = k, n, m
    got = anchored_clusters(spark.createDataFrame(data, "g int, i long, k long, s string").repartition(3), ["g"], "k", "i", 7)
    assert {r["i"]: r["cluster"] for r in got.collect()} == want
    assert want != gaps


@pytest.mark.parametrize("seed", range(4))
def test_greedy_pairs(spark, seed):
    """The plain rule: in order, each free row takes the first later free row of the other side in reach."""
    data, want, mutual = rows(seed, 150), set(), True
    for g in range(5):
        own = sorted((k, i, s) for h, i, k, s in data if h == g)
        used = set()
        for n, (k, i, s) in enumerate(own):
            if i in used:
                continue
            mate = next(((j, q) for q, j, t in own[n + 1 :] if j not in used and t != s and q - k <= 2), None)
            if mate:
                used |= {i, mate[0]}
                want.add((g, i, mate[0], mate[1] - k))
                near = min(((abs(q - mate[1]), j) for q, j, t in own if t == s), default=None)
                mutual &= near[1] == i
    got = greedy_pairs(spark.createDataFrame(data, "g int, i long, k long, s string").repartition(3), ["g"], "k", "i", "s", 2)
    assert {tuple(r) for r in got.collect()} == want
    assert not mutual


def test_one_long_stretch_and_empty_table(spark):
    data = [(1, i, i, "mw"[i % 2]) for i in range(600)]
    frame = spark.createDataFrame(data, "g int, i long, k long, s string")
    assert greedy_pairs(frame, ["g"], "k", "i", "s", 2).count() == 300
    assert anchored_clusters(frame, ["g"], "k", "i", 9).agg(F.max("cluster")).first()[0] == 60
    assert greedy_pairs(frame.filter("i < 0"), ["g"], "k", "i", "s", 2).collect() == [] == anchored_clusters(frame.filter("i < 0"), ["g"], "k", "i", 9).collect()


def test_overlaps(spark):
    pick = random.Random(3)
    a = {(g, f"a{i}"): {pick.randrange(15) for _ in range(6)} for g in range(3) for i in range(5)}
    b = {(g, f"b{i}"): {pick.randrange(15) for _ in range(6)} for g in range(3) for i in range(4)}
    flat = lambda sets, name: spark.createDataFrame([(g, x, k) for (g, x), own in sets.items() for k in own], f"g int, {name} string, k int")
    found = overlaps(flat(a, "l"), flat(b, "r"), ["g"], "k", "l", "r")
    assert {(r["g"], r["l"], r["r"]): r["common"] for r in found.collect()} == {(g, x, y): len(s & t) for (g, x), s in a.items() for (h, y), t in b.items() if g == h and s & t}
    best = best_of(found, ["g", "l"], F.struct("common", "r"), ["r", "common"])
    assert {(r["g"], r["l"]): r["r"] for r in best.collect()} == {(g, x): max((len(s & t), y) for (h, y), t in b.items() if h == g)[1] for (g, x), s in a.items() if any(s & t for (h, _), t in b.items() if h == g)}


def test_rows_without_a_value_have_no_rank(spark):
    frame = spark.createDataFrame([("a", 9), ("a", 9), ("a", 8), ("a", None), ("b", None), ("b", 1)], "g string, v long")
    got = sorted(((r["g"], r["v"], r["rank"]) for r in competition_rank(frame, ["g"], "v").collect()), key=repr)
    assert got == sorted([("a", 9, 1), ("a", 9, 1), ("a", 8, 3), ("a", None, None), ("b", None, None), ("b", 1, 1)], key=repr)
    tied = competition_rank(frame.withColumn("i", F.monotonically_increasing_id()), ["g"], "v", then=[F.asc("i")]).orderBy("i").collect()
    assert [r["rank"] for r in tied] == [1, 2, 3, None, None, 1]
