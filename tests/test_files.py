"""Readers of small files and the extension surface, on fixtures of a few rows."""

import json

import pytest
from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from runledger.functions.exact import close, hundredths
from runledger.plans import extension
from runledger.sources import files


@pytest.fixture(scope="module")
def spark():
    return SparkSession.builder.master("local[4]").config("spark.sql.shuffle.partitions", "4").config("spark.sql.session.timeZone", "UTC").config("spark.ui.enabled", "false").getOrCreate()


def test_registry(spark, tmp_path):
    (tmp_path / "b.json").write_text(json.dumps({"events": [{"event_id": "E3", "adapter": "web"}, {"event_id": "E4", "adapter": "pdf", "skip": "twice"}]}, indent=1))
    (tmp_path / "a.json").write_text(json.dumps({"events": [{"event_id": "E1", "adapter": "pdf", "season": "2024-25", "skip": ""}, {"event_id": "X2", "adapter": "pdf", "other": 1}]}))
    (tmp_path / "notes.txt").write_text("no registry")
    rows = files.registry(spark, str(tmp_path)).orderBy("file", "place").collect()
    assert [(r["file"], r["event_id"], r["season"]) for r in rows] == [("a.json", "E1", "2024-25"), ("a.json", "X2", None), ("b.json", "E3", None)]
    assert [r["event_id"] for r in files.registry(spark, str(tmp_path), "pdf", "E").collect()] == ["E1"]


def test_optional_setting(spark, tmp_path):
    assert files.optional(spark, str(tmp_path), "names.json", "a string").collect() == []
    (tmp_path / "names.json").write_text('{"a": "x"}\n')
    assert [r["a"] for r in files.optional(spark, str(tmp_path), "names.json", "a string").collect()] == ["x"]


def test_manifest_with_byte_order_mark(spark, tmp_path):
    path = tmp_path / "m.csv"
    path.write_text("﻿code,name\n007,\"A, B\"\n", encoding="utf-8")
    assert [tuple(r) for r in files.manifest(spark, str(path), "code string, name string").collect()] == [("007", "A, B")]


def test_survey_and_audit(spark, tmp_path):
    path = tmp_path / "s.jsonl"
    lines = [{"event_id": "E1", "jpn": ["a"], "note": "old"}, {"event_id": "E2", "kind": "supplement"}, {"event_id": "E1", "jpn": ["a", "b"], "note": "new"}, {"event_id": "E3"}]
    path.write_text("\n".join(map(json.dumps, lines)) + "\n")
    got = files.survey(spark, str(path))
    assert sorted((r["event_id"], r["note"]) for r in got.collect()) == [("E1", "new"), ("E3", None)]
    log = str(tmp_path / "audit")
    for day in ("2026-01-01", "2026-01-02"):
        files.append_audit(got.select("event_id", "jpn"), log, day)
    back = spark.read.schema("event_id string, jpn_total int, checked string").json(log)
    assert sorted(map(tuple, back.collect())) == [(e, n, d) for e, n in (("E1", 2), ("E3", 0)) for d in ("2026-01-01", "2026-01-02")]


def test_adapters_rules_formulas_mutations(spark):
    extension.adapter("web")(lambda e: e.select("event_id", F.concat("event_id", F.lit("-1")).alias("run_id"), F.array(F.lit(5), F.lit(1), F.lit(4), F.lit(2), F.lit(3)).cast("array<bigint>").alias("marks")))
    events = spark.createDataFrame([("E1", "web"), ("E2", "web"), ("E3", "unknown")], "event_id string, adapter string")
    records, missing = extension.load(events)
    assert missing == ["unknown"] and tuple(records.columns) == extension.RECORD
    rules = spark.createDataFrame([("E1", True, 0), ("E2", False, 20)], "event_id string, trim boolean, floor bigint")
    assert {r["event_id"]: r["total"] for r in extension.by_rule(records, rules).collect()} == {"E1": 9, "E2": 20}
    printed = records.withColumn("printed", F.lit(9).cast("long"))
    of = lambda df: {r["formula"]: r["n_differ"] for r in extension.unexplained(df).collect()}
    assert of(printed) == {"all": 2, "trimmed": 0, "best": 2}
    noticed = {name: of(change(printed))["trimmed"] > 0 for name, change in extension.MUTATIONS.items()}
    assert noticed == {"total one higher": True, "marks in reverse": False, "first mark lost": True}


def test_truncation_and_tolerance(spark):
    df = spark.createDataFrame([(-2.999, 1, None), (2.999, None, None), (0.0, 5, 6)], "x double, a bigint, b bigint")
    rows = df.select(hundredths(F.col("x")), close(F.col("a"), F.col("b"), 1, True), close(F.col("a"), F.col("b"), 1, False)).collect()
    assert [tuple(r) for r in rows] == [(-299, False, False), (299, True, False), (0, True, True)]
