from pyspark.sql import SparkSession

from runledger.llm.registry import QUERIES

SF = "/root/testdata/sf0.01"


def test_held_out_accuracy():
    spark = SparkSession.builder.master("local[4]").config("spark.sql.shuffle.partitions", "4").config("spark.ui.enabled", "false").getOrCreate()
    lang = {r["doc_id"]: r["lang"] for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    rows = QUERIES["op10_language"](spark, SF).collect()
    assert sorted(r["doc_id"] for r in rows) == sorted(lang)
    held = [r for r in rows if r["held_out"]]
    right = sum(r["lang_pred"] == lang[r["doc_id"]] for r in held) / len(held)
    print("held-out accuracy", right, "rejected", sum(r["rejected"] for r in rows), min(r["score"] for r in rows))
    assert right > 0.95
