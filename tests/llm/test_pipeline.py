"""The pipeline's stages: each on nulls, empty and repeated rows and clashing columns, and the whole against its stages and the library's ids."""

import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import SparkSession
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from runledger.llm.language import keep_identified, predict
from runledger.llm.quality import classify, keep_good

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def spark():
    return SparkSession.builder.master("local[4]").config("spark.sql.shuffle.partitions", "4").config("spark.ui.enabled", "false").getOrCreate()


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    """300 documents with null, empty and repeated rows and columns named like the operators' own."""
    path = tmp_path_factory.mktemp("sf")
    docs = spark.read.parquet(f"{SF}/documents.parquet").filter("doc_id < 300")
    odd = spark.createDataFrame([(9000, None, "en", "s", 0), (9001, "", None, "s", 0), (9002, " \n", "en", None, 3), (None, "one", "en", "s", 3)], docs.schema)
    docs.union(odd).union(docs.filter("doc_id < 5")).withColumn("kept", F.lit("x")).withColumn("score", F.lit(1)).coalesce(2).write.parquet(f"{path}/documents.parquet")
    spark.read.parquet(f"{SF}/labels.parquet").filter("doc_id < 300").write.parquet(f"{path}/labels.parquet")
    return str(path)


def read(spark, folder, name):
    return spark.read.parquet(f"{folder}/{name}.parquet")


def test_quality_stage_keeps_what_the_classifier_keeps(spark, folder):
    docs, labels = read(spark, folder, "documents"), read(spark, folder, "labels")
    stage = keep_good(docs, labels)
    assert stage.columns == docs.columns
    kept = {r["doc_id"] for r in classify(docs, labels).filter("kept").collect()}
    want = Counter(r["doc_id"] for r in docs.collect() if r["doc_id"] in kept)
    assert Counter(r["doc_id"] for r in stage.collect()) == want
    assert not kept & {9000, 9001, 9002} and sum(want.values()) > 200


def test_language_stage_keeps_what_is_not_rejected(spark, folder):
    docs = read(spark, folder, "documents")
    stage = keep_identified(docs)
    assert stage.columns == docs.columns
    kept = {r["doc_id"] for r in predict(docs).filter("NOT rejected").collect()}
    assert Counter(r["doc_id"] for r in stage.collect()) == Counter(r["doc_id"] for r in docs.collect() if r["doc_id"] in kept)
    assert not kept & {9000, 9001, 9002} and len(kept) > 250


def test_empty_tables(spark, folder):
    docs, labels = read(spark, folder, "documents").limit(0), read(spark, folder, "labels")
    for name, stage in corpus_pipeline.STAGES[:3]:
        assert stage(spark, docs, folder).collect() == [], name


def test_run_packs_what_the_stages_keep(spark, folder):
    assert [name for name, _ in corpus_pipeline.STAGES] == ["quality", "language", "near_duplicates", "packing"]
    got = corpus_pipeline.run(spark, folder).collect()
    docs = read(spark, folder, "documents")
    for _, stage in corpus_pipeline.STAGES[:3]:
        docs = stage(spark, docs, folder)
    text = {r["doc_id"]: r["text"] for r in docs.collect()}
    assert len(text) == docs.count() and len(set(text.values())) == len(text)
    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    want = set()
    for d, t in text.items():
        ids = np.array([*library.encode(t, add_special_tokens=False).ids, 2], "<u4")
        first = (len(ids) - 1) % 1024 + 1
        for i, (a, b) in enumerate(zip([0, *range(first, len(ids), 1024)], [*range(first, len(ids), 1024), len(ids)])):
            want.add((d, i, a, b - a, zlib.crc32(ids[a:b].tobytes())))
    assert {(r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in got} == want and len(got) == len(want)
    places = defaultdict(list)
    for r in got:
        places[r["sequence_id"]].append((r["offset"], r["length"]))
    for own in places.values():
        own.sort()
        assert [o for o, _ in own] == list(np.cumsum([0] + [n for _, n in own])[:-1]) and sum(n for _, n in own) <= 1024
    assert len(places) <= sum(r["length"] for r in got) / 1024 * 1.02 + 1
