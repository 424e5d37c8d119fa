"""Operators on ordered rows whose next step depends on the last one: anchored clusters and greedy pairs; and the best overlap of sets.

A window first cuts the rows of a group where no state can cross (a gap wider than the tolerance), so the folds below see one connected stretch each,
however large the group is.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def stretches(df: DataFrame, by: list[str], key: str, then: list[str], tolerance) -> DataFrame:
    """df with `stretch`: runs of rows whose neighbours' keys differ by the tolerance at most."""
    order = Window.partitionBy(*by).orderBy(key, *then)
    far = F.coalesce(F.col(key) - F.lag(key).over(order) > tolerance, F.lit(True))
    return df.withColumn("_far", far.cast("long")).withColumn("stretch", F.sum("_far").over(order.rowsBetween(Window.unboundedPreceding, 0))).drop("_far")


def anchored_clusters(df: DataFrame, by: list[str], key: str, row: str, tolerance) -> DataFrame:
    """by, row, cluster (from 1 in each group): a row belongs to the cluster of the row before it while its key is within the tolerance of the cluster's first
    key. Chains do not drift, unlike gaps between neighbours. key and tolerance: whole numbers."""
    item = F.struct(F.col(key).alias("k"), F.col(row).alias("r"))
    each = stretches(df.select(*by, key, row), by, key, [row], tolerance).groupBy(*by, "stretch").agg(F.array_sort(F.collect_list(item)).alias("items"))
    empty = F.struct(F.lit(None).cast("long").alias("first"), F.lit(0).cast("long").alias("n"), F.array().cast("array<bigint>").alias("out"))

    def step(s, x):
        new = s["first"].isNull() | (x["k"] - s["first"] > tolerance)
        n = s["n"] + new.cast("long")
        return F.struct(F.when(new, x["k"]).otherwise(s["first"]).alias("first"), n.alias("n"), F.concat(s["out"], F.array(n)).alias("out"))

    folded = each.withColumn("state", F.aggregate("items", empty, step))
    earlier = F.coalesce(F.sum("state.n").over(Window.partitionBy(*by).orderBy("stretch").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    rows = folded.withColumn("earlier", earlier).select(*by, "earlier", F.inline(F.arrays_zip(F.col("items.r").alias(row), F.col("state.out").alias("k"))))
    return rows.select(*by, row, (F.col("earlier") + F.col("k")).alias("cluster"))


def greedy_pairs(df: DataFrame, by: list[str], key: str, row: str, side: str, tolerance: int) -> DataFrame:
    """by, a, b, gap: in the order of keys each row that is still free takes the nearest later free row of the other side within the tolerance. Rows of
    one side wait in line, so the one that has waited longest is served first; the fold keeps this line alone."""
    item = F.struct(F.col(key).alias("k"), F.col(row).alias("r"), F.col(side).alias("side"))
    each = stretches(df.select(*by, key, row, side), by, key, [row], tolerance).groupBy(*by, "stretch").agg(F.array_sort(F.collect_list(item)).alias("items"), F.count_distinct(side).alias("sides")).filter("sides > 1")
    types = df.select(key, row, side).dtypes
    waiting = f"array<struct<k:{types[0][1]},r:{types[1][1]},side:{types[2][1]}>>"
    pairs = f"array<struct<a:{types[1][1]},b:{types[1][1]},gap:bigint>>"

    def step(s, x):
        open_ = F.filter(s["line"], lambda w: x["k"] - w["k"] <= tolerance)
        mate = F.get(F.filter(open_, lambda w: w["side"] != x["side"]), F.lit(0))
        found = F.array(F.struct(mate["r"].alias("a"), x["r"].alias("b"), (x["k"] - mate["k"]).cast("long").alias("gap"))).cast(pairs)
        line = F.when(mate.isNull(), F.concat(open_, F.array(x).cast(waiting))).otherwise(F.filter(open_, lambda w: w["r"] != mate["r"]))
        return F.struct(line.alias("line"), F.when(mate.isNull(), s["out"]).otherwise(F.concat(s["out"], found)).alias("out"))

    start = F.struct(F.array().cast(waiting).alias("line"), F.array().cast(pairs).alias("out"))
    return each.select(*by, F.inline(F.aggregate("items", start, step)["out"]))


def overlaps(a: DataFrame, b: DataFrame, by: list[str], key: str, left: str, right: str) -> DataFrame:
    """left, right, common: how many keys two sets of one group share, by an inverted join on (group, key); pairs that share none do not arise. a: by, left,
    key; b: by, right, key; keys distinct within a set. Whole sets never meet, and a hot group is dealt by its keys."""
    return a.join(b, [*by, key]).groupBy(*by, left, right).agg(F.count("*").alias("common"))


def best_of(rows: DataFrame, by: list[str], order: Column, columns: list[str]) -> DataFrame:
    """One row a group, that of the greatest order, without a sort: partial maxima meet in one exchange."""
    return rows.groupBy(*by).agg(F.max_by(F.struct(*columns), order).alias("_best")).select(*by, "_best.*")
