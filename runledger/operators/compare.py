"""Two readings of the same records, compared field by field and as multisets."""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _same(a: Column, b: Column, kind: str, tolerance: float) -> Column:
    if kind in ("double", "float") or kind.startswith("decimal"):
        return F.coalesce(F.abs(a - b) <= tolerance, a.isNull() & b.isNull())
    if kind in ("array<double>", "array<float>"):
        near = F.forall(F.arrays_zip(a.alias("x"), b.alias("y")), lambda p: F.coalesce(F.abs(p["x"] - p["y"]) <= tolerance, p["x"].isNull() & p["y"].isNull()))
        return F.coalesce((F.size(a) == F.size(b)) & near, a.isNull() & b.isNull())
    return a.eqNullSafe(b)


def _text(x: Column, kind: str) -> Column:
    return F.concat(F.lit("["), F.array_join(x.cast("array<string>"), ",", "null"), F.lit("]")) if kind.startswith("array") else x.cast("string")


def compare_readings(a: DataFrame, b: DataFrame, keys: list[str], tolerance: float = 0.005) -> DataFrame:
    """keys, field, a, b: one row for each key that one reading lacks (`only a`, `only b`) or has twice (`repeated`), and for each field that differs. Numbers
    agree within the tolerance, arrays element by element; two nulls agree, one null does not. The fields are a's columns. Each side is grouped by key, so the join adds no exchange."""
    fields = [c for c in a.columns if c not in keys]

    def side(df, x):
        return df.groupBy(*keys).agg(F.count("*").alias(f"n_{x}"), *[F.max(c).alias(c) for c in fields]).select(*keys, f"n_{x}", F.struct(*fields).alias(x))

    return compare_pairs(side(a, "a").join(side(b, "b"), keys, "full"), keys, tolerance)


def compare_pairs(both: DataFrame, keys: list[str], tolerance: float = 0.005) -> DataFrame:
    """The rows of compare_readings for readings that already stand side by side: keys, structs a and b of the same fields, and n_a and n_b, how many rows of the key each
    reading has (null: none). A key that holds a null equals none. Texts are made for fields that differ alone."""
    kinds = both.select("a.*").dtypes
    same = {c: _same(F.col("a")[c], F.col("b")[c], t, tolerance) for c, t in kinds}
    row = lambda field, a, b: F.struct(field.alias("field"), a.cast("string").alias("a"), b.cast("string").alias("b"))
    fields = [F.when(~same[c], row(F.lit(c), _text(F.col("a")[c], t), _text(F.col("b")[c], t))) for c, t in kinds]
    keyed = reduce(and_, [F.col(k).isNotNull() for k in keys])
    whole = keyed & F.coalesce((F.col("n_a") == 1) & (F.col("n_b") == 1), F.lit(False))
    n_a, n_b, none = F.col("n_a"), F.col("n_b"), F.lit(None)
    kind = F.when(n_b.isNull(), "only a").when(n_a.isNull(), "only b").otherwise("repeated")
    apart = F.array(F.when(n_a.isNotNull(), row(F.lit("only a"), n_a, none)), F.when(n_b.isNotNull(), row(F.lit("only b"), none, n_b)))
    found = F.when(whole, F.array(*fields)).when(keyed, F.array(row(kind, n_a, n_b))).otherwise(apart)
    return both.filter(~whole | ~reduce(and_, same.values())).select(*keys, F.explode(found).alias("_f")).filter("_f IS NOT NULL").select(*keys, "_f.*")


def multiset_both_ways(a: DataFrame, b: DataFrame, by: list[str], value: str) -> DataFrame:
    """by, n_a, n_b, only_a, only_b: values of a group that one side has more often than the other, with how often they are too many."""
    of = lambda s: F.count_if(F.col("_side") == s)
    both = a.select(*by, value, F.lit("a").alias("_side")).unionByName(b.select(*by, value, F.lit("b").alias("_side"))).groupBy(*by, value).agg(of("a").alias("_a"), of("b").alias("_b"))
    return both.groupBy(*by).agg(F.sum("_a").alias("n_a"), F.sum("_b").alias("n_b"), F.sum(F.greatest(F.col("_a") - F.col("_b"), F.lit(0))).alias("only_a"), F.sum(F.greatest(F.col("_b") - F.col("_a"), F.lit(0))).alias("only_b"))
