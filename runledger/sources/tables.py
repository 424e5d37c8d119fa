"""The given tables and the views that queries share: runs (orders as scored results) and marks (judge marks of embeddings)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from runledger.functions.exact import hundredths


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: Rows of the largest table that one task sorts or groups. Spark joins small shuffle partitions until there is one a core, so without a number of its own a task grows with the tables.
ROWS_A_TASK = 250_000


def parts(rows: DataFrame) -> int:
    """How many parts hold ROWS_A_TASK of the table's rows each, one a core at least. The count comes from the files' footers."""
    return max(rows.sparkSession.sparkContext.defaultParallelism, -(-rows.count() // ROWS_A_TASK))


def season(date):
    """Season text of a date; seasons start in July."""
    start = F.year(date) - (F.month(date) < 7).cast("int")
    return F.format_string("%d-%02d", start, (start + 1) % 100)


def runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    return orders.select(
        F.col("o_orderkey").alias("run_id"),
        F.col("o_custkey").alias("athlete"),
        F.to_date("o_orderdate").alias("date"),
        season(F.col("o_orderdate")).alias("season"),
        F.col("o_orderpriority").alias("series"),
        F.when(F.col("o_orderstatus") == "P", "DNF").otherwise("OK").alias("status"),
        F.floor(F.col("o_totalprice") / 1000).cast("long").alias("score_k"),
    )


def marks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Five judge marks and two air marks of each vector, as hundredths."""
    rows = table(spark, sf_dir, "embeddings").filter("size(embedding) >= 7")
    return rows.select("vec_id", F.transform(F.slice("embedding", 1, 5), hundredths).alias("m"), F.transform(F.slice("embedding", 6, 2), hundredths).alias("air"))


def ladder(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first run of each athlete (user and day) and round; `error` events are runs not finished and carry no round."""
    step = F.coalesce(*(F.when(F.col("event_type") == t, F.lit(k).cast("long")) for t, k in (("view", 1), ("click", 2), ("signup", 3), ("purchase", 4))))
    w = Window.partitionBy("user_id", "day", "step").orderBy("ts", "event_id")
    rows = table(spark, sf_dir, "events").select("event_id", "user_id", "ts", F.to_date("ts").alias("day"), step.alias("step"), F.round(F.col("value") * 100).cast("long").alias("score"))
    return rows.filter("step IS NOT NULL").withColumn("rn", F.row_number().over(w)).filter("rn = 1").drop("rn", "ts")


MARKS = "marks AS (SELECT vec_id, list_transform(embedding[1:5], lambda x: CAST(trunc(CAST(x AS DOUBLE) * 100) AS BIGINT)) AS m, list_transform(embedding[6:7], lambda x: CAST(trunc(CAST(x AS DOUBLE) * 100) AS BIGINT)) AS air FROM embeddings WHERE len(embedding) >= 7)"
LADDER = """ladder AS (SELECT event_id, user_id, day, step, score FROM (SELECT *, row_number() OVER (PARTITION BY user_id, day, step ORDER BY ts, event_id) AS rn FROM
 (SELECT event_id, user_id, ts, CAST(ts AS DATE) AS day, CAST(round(value * 100) AS BIGINT) AS score,
 CAST(CASE event_type WHEN 'view' THEN 1 WHEN 'click' THEN 2 WHEN 'signup' THEN 3 WHEN 'purchase' THEN 4 END AS BIGINT) AS step FROM events) WHERE step IS NOT NULL) WHERE rn = 1)"""
