"""Seconds per query; prints one JSON line."""

import json
import os
import time

from pyspark.sql import SparkSession

from runledger.queries import QUERIES

sf = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
cpus = os.environ.get("BENCH_CPUS", "8")
spark = SparkSession.builder.master(f"local[{cpus}]").config("spark.sql.shuffle.partitions", cpus).config("spark.sql.session.timeZone", "UTC").config("spark.ui.enabled", "false").getOrCreate()
spark.sparkContext.setLogLevel("ERROR")
took = {}
for name, query in QUERIES.items():
    began = time.time()
    query(spark, sf).write.format("noop").mode("overwrite").save()
    took[name] = round(time.time() - began, 3)
print(json.dumps({"metric": "total", "value": round(sum(took.values()), 3), "unit": "sec", "queries": took, "sf": sf.rpartition("sf")[2]}))
