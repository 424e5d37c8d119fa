"""What users add: adapters by name, rules as rows, candidate formulas and mutations by label."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from runledger.functions.exact import counting_total, total

RECORD = ("event_id", "run_id", "marks")
ADAPTERS: dict[str, Callable[[DataFrame], DataFrame]] = {}
#: Candidate formulas for a printed total of marks.
FORMULAS: dict[str, Callable[[], Column]] = {
    "all": lambda: total(F.col("marks")), "trimmed": lambda: counting_total(F.col("marks"), F.lit(True)), "best": lambda: F.array_max("marks"),
}
#: Changes that a check must notice.
MUTATIONS: dict[str, Callable[[DataFrame], DataFrame]] = {
    "total one higher": lambda df: df.withColumn("printed", F.col("printed") + 1), "marks in reverse": lambda df: df.withColumn("marks", F.reverse("marks")),
    "first mark lost": lambda df: df.withColumn("marks", F.slice("marks", 2, 100)),
}


def adapter(name: str):
    """Registers a function from an adapter's events to records."""
    return lambda f: ADAPTERS.setdefault(name, f)


def load(events: DataFrame) -> tuple[DataFrame, list[str]]:
    """Records of all adapters in one table of fixed columns, and the adapters that no one registered."""
    names = sorted(r["adapter"] for r in events.select("adapter").distinct().collect())
    parts = [ADAPTERS[n](events.filter(F.col("adapter") == n)).select(*RECORD) for n in names if n in ADAPTERS]
    spark = events.sparkSession
    out = spark.createDataFrame([], "event_id string, run_id string, marks array<bigint>")
    for part in parts:
        out = out.unionByName(part)
    return out, [n for n in names if n not in ADAPTERS]


def by_rule(records: DataFrame, rules: DataFrame) -> DataFrame:
    """Totals by each event's rule row (trim, floor): a rule is data."""
    return records.join(rules, "event_id", "left").withColumn("total", F.greatest(counting_total(F.col("marks"), F.coalesce("trim", F.lit(False))), F.col("floor")))


def unexplained(printed: DataFrame) -> DataFrame:
    """By candidate formula, how many printed totals it does not give."""
    tried = F.explode(F.array(*[F.struct(F.lit(name).alias("formula"), make().alias("value")) for name, make in FORMULAS.items()]))
    return printed.select("printed", tried.alias("t")).groupBy("t.formula").agg(F.count_if(~F.col("t.value").eqNullSafe(F.col("printed"))).alias("n_differ"))
