"""Small files beside the tables: registries, settings, manifests, surveys, audit logs. Schemas are given, never inferred."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

EVENT = "event_id string, adapter string, season string, skip string"
SURVEY = "event_id string, kind string, jpn array<string>, note string"


def registry(spark: SparkSession, folder: str, adapter: str | None = None, event: str | None = None) -> DataFrame:
    """Events of all JSON files of a folder with their file and place in it, without those marked to skip; adapter equal, event containing."""
    files = spark.read.schema(f"events array<struct<{', '.join(c.replace(' ', ':') for c in EVENT.split(', '))}>>").option("multiLine", True).json(folder, pathGlobFilter="*.json")
    rows = files.select(F.col("_metadata.file_name").alias("file"), F.posexplode("events")).select("file", F.col("pos").alias("place"), "col.*")
    rows = rows.filter(F.coalesce("skip", F.lit("")) == "").drop("skip")
    if adapter is not None:
        rows = rows.filter(F.col("adapter") == adapter)
    return rows.filter(F.contains("event_id", F.lit(event))) if event else rows


def optional(spark: SparkSession, folder: str, name: str, schema: str) -> DataFrame:
    """A JSON-lines setting by its name in a folder; no rows where there is no such file."""
    return spark.read.schema(schema).json(folder, pathGlobFilter=name)


def manifest(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A CSV file with a header; a byte order mark before it is no part of the first name."""
    return spark.read.schema(schema).option("header", True).option("enforceSchema", True).csv(path)


def survey(spark: SparkSession, path: str) -> DataFrame:
    """JSON lines; supplements are left out, and of an event's lines the last in the file counts."""
    lines = spark.read.text(path).select(F.monotonically_increasing_id().alias("line"), F.from_json("value", SURVEY).alias("r")).select("line", "r.*")
    last = F.row_number().over(Window.partitionBy("event_id").orderBy(F.desc("line")))
    return lines.filter("event_id IS NOT NULL AND NOT kind <=> 'supplement'").withColumn("rn", last).filter("rn = 1").drop("rn", "line")


def append_audit(records: DataFrame, path: str, checked: str) -> None:
    """Adds records (event_id, jpn) to a JSON-lines log with the number of entries and the day of the check."""
    records.withColumn("jpn_total", F.coalesce(F.size("jpn"), F.lit(0))).withColumn("checked", F.lit(checked)).write.mode("append").json(path)
