"""A store of published tables: partitions under their content hash, and a manifest that is swapped last.

`publish` writes each partition of a table once, under data/<table>/<partition>/h=<hash>; partitions whose content is there already are not written
again. Then one manifest file names, for every table, the partitions that make up the version. A reader takes the greatest version, so it sees the old
or the new state whole, never a mixture; partitions that vanished are in no manifest any more and `sweep` deletes their files. Hashes do not depend on the
order or the files of the rows: per row two 60-bit numbers of its SHA-256 are added up exactly. Partitions (seasons, shards) are few by nature: their
list alone passes the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: A partition of more rows is dealt to several tasks, each with a file of its own.
ROWS_PER_FILE = 2_000_000
MANIFEST = "version long, name string, part string, hash string, n long, path string, schema string"


def row_text(columns: list[str]):
    """A row as text: values in the order given, nulls told apart from empty texts."""
    return F.concat_ws("|", *[F.coalesce(F.col(c).cast("string"), F.lit("~")) for c in columns])


def halves(text):
    """Two 60-bit numbers of a text's SHA-256."""
    sha = F.sha2(text, 256)
    return [F.conv(F.substring(sha, at, 15), 16, 10).cast("decimal(38,0)") for at in (1, 16)]


def content_hash(rows: DataFrame, by: list[str], columns: list[str]) -> DataFrame:
    """by, n, hash: one row a partition, whatever the order of its rows."""
    a, b = halves(row_text(columns))
    sums = rows.groupBy(*by).agg(F.count("*").alias("n"), F.sum(a).alias("a"), F.sum(b).alias("b"))
    return sums.select(*by, "n", F.substring(F.sha2(F.concat_ws(":", "n", "a", "b"), 256), 1, 16).alias("hash"))


def manifests(spark: SparkSession, root: str) -> DataFrame:
    """All versions' rows."""
    return spark.read.schema(MANIFEST).json(f"{root}/manifest")


def current(spark: SparkSession, root: str) -> DataFrame:
    """The rows of the greatest version."""
    rows = manifests(spark, root)
    return rows.join(F.broadcast(rows.agg(F.max("version").alias("version"))), "version")


def publish(spark: SparkSession, root: str, tables: dict[str, tuple[DataFrame, str]], version: int) -> None:
    """tables: name -> (rows, partition column). The manifest is written last, as one file."""
    kept = {(r["name"], r["part"], r["hash"]) for r in manifests(spark, root).select("name", "part", "hash").distinct().collect()} if version > 1 else set()
    lines = []
    for name, (rows, part) in tables.items():
        columns = [c for c in rows.columns if c != part]
        found = content_hash(rows, [part], columns).collect()
        schema = ", ".join(f"{c} {kind}" for c, kind in rows.select(*columns, F.col(part).cast("string").alias(part)).dtypes)
        lines += [(version, name, str(r[part]), r["hash"], r["n"], f"{part}={r[part]}/h={r['hash']}", schema) for r in found]
        new = [(r[part], r["hash"]) for r in found if (name, str(r[part]), r["hash"]) not in kept]
        if new:
            own = spark.createDataFrame(new, rows.select(part).schema.add("h", "string"))
            salt = F.pmod(F.xxhash64(*columns), F.lit(max(r["n"] for r in found) // ROWS_PER_FILE + 1))
            rows.join(F.broadcast(own), part).repartition(part, salt).write.mode("append").partitionBy(part, "h").parquet(f"{root}/data/{name}")
    spark.createDataFrame(lines, MANIFEST).coalesce(1).write.mode("append").json(f"{root}/manifest")


def read(spark: SparkSession, root: str, name: str, parts: list[str] | None = None) -> DataFrame:
    """A published table by its manifest, or some of its partitions: no other file is listed or read. Raises where the manifest has no such rows."""
    rows = current(spark, root).filter(F.col("name") == name)
    rows = (rows if parts is None else rows.filter(F.col("part").isin(parts))).select("path", "schema").collect()
    if not rows or parts is not None and len(rows) != len(set(parts)):
        raise LookupError(f"the manifest of {root} lacks {name} {parts or ''}")
    return spark.read.schema(rows[0]["schema"]).option("basePath", f"{root}/data/{name}").parquet(*[f"{root}/data/{name}/{r['path']}" for r in rows]).drop("h")


def verify(spark: SparkSession, root: str, name: str) -> DataFrame:
    """part, n, hash by the manifest beside n_found, hash_found of the files that it names; a stale file differs, a missing one raises on reading."""
    promised = current(spark, root).filter(F.col("name") == name).select("part", "n", "hash")
    rows = read(spark, root, name)
    part = rows.columns[-1]
    found = content_hash(rows, [part], rows.columns[:-1]).select(F.col(part).alias("part"), F.col("n").alias("n_found"), F.col("hash").alias("hash_found"))
    return promised.join(found, "part", "left")


def sweep(spark: SparkSession, root: str) -> list[str]:
    """Deletes the files of partitions that the current manifest does not name; returns their paths."""
    paths = F.concat_ws("/", F.lit("data"), "name", "path").alias("p")
    stale = [r["p"] for r in manifests(spark, root).select(paths).distinct().join(current(spark, root).select(paths), "p", "left_anti").collect()]
    folder = spark._jvm.org.apache.hadoop.fs.Path
    for p in stale:
        at = folder(f"{root}/{p}")
        at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)
    return sorted(stale)
