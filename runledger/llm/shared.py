"""Session helpers: shared scratch tables, bounded statistics and column hygiene."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor sees. Only a local session that has none gets one here; on a cluster a machine's own folder would not do."""
    if folder := spark.conf.get("spark.checkpoint.dir", None):
        return folder.rstrip("/")
    if folder := spark.sparkContext.getCheckpointDir():
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="spark-"))
    return spark.sparkContext.getCheckpointDir().rstrip("/")


def materialize(df: DataFrame, what: str) -> DataFrame:
    """Cut lineage with a written table in the shared folder; it outlives any executor."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{what}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def id_and_text(docs: DataFrame) -> DataFrame:
    """doc_id and text alone: other columns, whatever their names, never reach an operator."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))


def crc_mod(column: str, modulus: int) -> Column:
    return F.crc32(F.col(column).cast("string").cast("binary")) % F.lit(modulus)


def blocks_for(df: DataFrame, column: str, target_bytes: int) -> int:
    """How many blocks of about target_bytes the column fills; at least one."""
    total = df.agg(F.sum(F.octet_length(column).cast("long")).alias("b")).first()["b"] or 0
    return max(1, -(-int(total) // target_bytes))
