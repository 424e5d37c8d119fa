import zlib

import duckdb
from pyspark.sql import SparkSession

from runledger.llm.registry import QUERIES, SQL

SF = "/root/testdata/sf0.01"
spark = SparkSession.builder.master("local[4]").config("spark.sql.shuffle.partitions", "4").config("spark.ui.enabled", "false").getOrCreate()


def test_topk_equals_sql():
    db = duckdb.connect()
    db.sql(f"CREATE VIEW embeddings AS FROM '{SF}/embeddings.parquet'")
    want = db.sql(f"SELECT query_id, rank, vec_id, score FROM ({SQL['op2_topk']})").fetchall()
    assert sorted(map(tuple, QUERIES["op2_topk"](spark, SF).collect())) == sorted(want)


def test_shards():
    rows = QUERIES["op7_shards"](spark, SF).collect()
    text = {r["doc_id"]: (r["text"] or "").encode() for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    assert sorted(r["doc_id"] for r in rows) == sorted(text)
    assert all(r["size"] == len(text[r["doc_id"]]) + 1 and r["text_crc32"] == zlib.crc32(text[r["doc_id"]]) for r in rows)
    shards = {s: [r for r in rows if r["shard"] == s] for s in range(8)}
    for own in shards.values():
        assert sorted(r["slot"] for r in own) == list(range(len(own)))
    total = [sum(r["size"] for r in own) for own in shards.values()]
    assert max(total) < 1.15 * sum(total) / 8
