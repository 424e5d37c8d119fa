"""Junk and an unlearned language are rejected whatever their length; short clean texts stay."""

import random

from pyspark.sql import SparkSession

from runledger.llm.language import keep_identified, predict

SF = "/root/testdata/sf0.01"
FINNISH = "kaikki ihmiset syntyvät vapaina ja tasavertaisina arvoltaan ja oikeuksiltaan heille on annettu järki ja omatunto ja heidän on toimittava toisiaan kohtaan veljeyden hengessä "


def session():
    return SparkSession.builder.master("local[4]").config("spark.sql.shuffle.partitions", "4").config("spark.ui.enabled", "false").getOrCreate()


def test_long_junk_is_rejected_and_short_texts_stay():
    spark, pick = session(), random.Random(1)
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text", "lang")
    junk = [" ".join("".join(pick.choices(letters, k=pick.randint(2, 9))) for _ in range(n)) for letters in ("abcdefghijklmnopqrstuvwxyz", [chr(c) for c in range(0x4E00, 0x9FA5)]) for n in (100, 1000)]
    bad = [*junk, FINNISH, FINNISH * 20]
    good = ["this is the story of the house", "und das ist der Weg"]
    extra = spark.createDataFrame([(-1 - i, t, None) for i, t in enumerate(bad + good)], docs.schema)
    both = docs.union(extra)
    got = {r["doc_id"]: r for r in predict(both).collect()}
    print([(round(got[-1 - i]["score"], 3), got[-1 - i]["rejected"]) for i in range(len(bad + good))], "rejected of the table", sum(r["rejected"] for d, r in got.items() if d >= 0))
    assert [got[-1 - i]["rejected"] for i in range(len(bad + good))] == [True] * len(bad) + [False] * len(good)
    assert sum(r["rejected"] for d, r in got.items() if d >= 0) <= 0.005 * docs.count()
    assert sorted(r["doc_id"] for r in keep_identified(both).select("doc_id").collect()) == sorted(d for d, r in got.items() if not r["rejected"])
