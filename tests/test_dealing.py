"""Rows are dealt by how many there are, whatever the session's number of shuffle partitions, so that a task's memory does not grow with the tables."""

import re

import pytest
from pyspark.sql import SparkSession

from runledger.queries import QUERIES
from runledger.sources import tables

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def spark():
    return SparkSession.builder.master("local[4]").config("spark.sql.shuffle.partitions", "4").config("spark.sql.session.timeZone", "UTC").config("spark.ui.enabled", "false").getOrCreate()


def test_parts_follow_the_rows(spark, monkeypatch):
    cores = spark.sparkContext.defaultParallelism
    assert tables.parts(spark.range(10)) == tables.parts(spark.range(0)) == cores
    monkeypatch.setattr(tables, "ROWS_A_TASK", 10)
    assert tables.parts(spark.range(10 * cores + 1)) == cores + 1


DEALT = ("reprinted_marks", "page_carry", "page_blocks", "reader_fields", "carried_tail")


@pytest.mark.parametrize("name", DEALT)
def test_every_exchange_has_as_many_parts_as_the_lines_need(spark, monkeypatch, name):
    monkeypatch.setattr(tables, "ROWS_A_TASK", 2000)
    n = tables.parts(tables.table(spark, SF, "lineitem"))
    assert n >= 30
    plan = QUERIES[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
    sizes = {int(x) for x in re.findall(r"hashpartitioning\([^)]*, (\d+)\)", plan)}
    assert sizes == {n}


def test_reader_fields_reads_the_lines_once(spark):
    plan = QUERIES["reader_fields"](spark, SF)._jdf.queryExecution().optimizedPlan().toString()
    assert len(re.findall(r"Relation \[l_orderkey", plan)) == 1


@pytest.mark.parametrize("name", ("verification_matrix", "verification_report"))
def test_runs_findings_and_rounds_are_dealt_by_the_lines(spark, monkeypatch, name):
    """Labels alone are dealt by the session; the upstream comparison has two rows an order."""
    monkeypatch.setattr(tables, "ROWS_A_TASK", 2000)
    n, orders = (tables.parts(tables.table(spark, SF, t)) for t in ("lineitem", "orders"))
    plan = QUERIES[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
    sizes = {(key, int(x)) for key, x in re.findall(r"hashpartitioning\((\w+)#[^)]*, (\d+)\)", plan)}
    assert {s for s in sizes if s[0] not in ("vec_id", "tier")} == {("athlete", n), ("run_id", n), ("l_orderkey", n), ("o_orderkey", 2 * orders)}


@pytest.mark.parametrize("name", ("score_findings", "verification_matrix", "verification_report"))
def test_labels_and_scored_runs_are_dealt_by_the_larger_of_their_tables(spark, monkeypatch, name):
    monkeypatch.setattr(tables, "ROWS_A_TASK", 20)
    n = max(tables.parts(tables.table(spark, SF, t)) for t in ("labels", "embeddings"))
    assert n >= 10
    plan = QUERIES[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert {int(x) for x in re.findall(r"hashpartitioning\(vec_id#[^)]*, (\d+)\)", plan)} == {n}
