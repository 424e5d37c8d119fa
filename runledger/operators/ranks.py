"""Competition ranks that do not sort a whole group in one task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def competition_rank(df: DataFrame, by: list[str], value: str, name: str = "rank", best_first: bool = True, then: list[Column] | None = None) -> DataFrame:
    """1 + the rows of the group that are strictly better; `then` orders rows of equal value (none: they share the better rank).

    Rows are counted by (group, value) first, so the window that adds up better values sees one row a value, and the window of `then` one value's
    rows. Rows without a value stay and have no rank; `by` columns must not be null.
    """
    order = F.desc(value) if best_first else F.asc(value)
    better = F.sum("_n").over(Window.partitionBy(*by).orderBy(order).rowsBetween(Window.unboundedPreceding, -1))
    counts = df.filter(F.col(value).isNotNull()).groupBy(*by, value).agg(F.count("*").alias("_n")).select(*by, value, F.coalesce(better, F.lit(0)).alias("_better"))
    own = F.rank().over(Window.partitionBy(*by, value).orderBy(*then)) if then else F.lit(1)
    return df.withColumn("_own", own).join(counts, [*by, value], "left").withColumn(name, (F.col("_better") + F.col("_own")).cast("long")).drop("_own", "_better")
