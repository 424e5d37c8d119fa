"""Saved pages: result lists, single races, ranking pages by their address."""

import json

import pytest
from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from runledger.sources.saved_pages import plain_text, ranking_pages, result_list, single_races


@pytest.fixture(scope="module")
def spark():
    return SparkSession.builder.master("local[4]").config("spark.sql.shuffle.partitions", "4").config("spark.ui.enabled", "false").getOrCreate()


def line(rank, bib, code, name, year, nation, score):
    cell = lambda mark, x: f'<div class="g {mark}">\n {x} </div>'
    inner = cell("justify-right pr-1 bold", rank) + cell("hidden-sm-down gray", bib) + cell("justify-right gray", code) + cell("justify-left bold", name) + cell("hidden-sm-down justify-left", year) + f'<span class="country__name-short">{nation}</span>' + cell("blue bold", score)
    return f'<a class="table-row" href="/x/athlete-biography.html?id={code}" target="_self">{inner}</a>'


def test_result_list(spark):
    page = line(1, 7, 2500001, "M&Uuml;LLER <b>Ann</b>".replace("&Uuml;", "&#220;"), 2001, "AUT", "81.23") + '<a class="table-row" href="/other">no</a>' + line("", "", 2500002, "DOE  Jo&eacute; &amp; Co", 1999, "FRA", "12.00") + line(2, 9, 2500003, "X", "", "JPN", "")
    pages = spark.createDataFrame([(1, page), (2, "<p>none</p>"), (3, None)], "race int, html string")
    got = [tuple(r) for r in result_list(pages, ["race"]).orderBy("place").collect()]
    assert got == [(1, 0, 1, 7, "2500001", "MÜLLER Ann", 2001, "AUT", 81.23), (1, 1, None, None, "2500002", "DOE Joé & Co", 1999, "FRA", None), (1, 2, 2, 9, "2500003", "X", None, "JPN", None)]


def test_plain_text(spark):
    rows = [("a&nbsp;<i>b</i>\n c &#233;&#12354;&lt;",), ("",), (None,)]
    assert [r[0] for r in spark.createDataFrame(rows, "x string").coalesce(1).select(plain_text(F.col("x"))).collect()] == ["a b c éあ<", "", None]


def test_single_races(spark):
    events = spark.createDataFrame([(1, "Ruka", "FIN"), (2, "Idre", "SWE")], "event_id int, venue string, nation string")
    races = spark.createDataFrame([(1, 9001, "Moguls", "M", "d"), (1, 9002, "Dual Moguls", "M", "d"), (2, 9003, "Moguls Qualification", "W", "d"), (2, 9004, "Aerials", "W", "d"), (2, 9005, "MOGULS dual", "W", "d"), (3, 9006, "Moguls", "W", "d")], "event_id int, codex int, discipline string, gender string, date string")
    assert sorted((r["codex"], r["venue"], r["nation"]) for r in single_races(events, races).collect()) == [(9001, "Ruka", "FIN"), (9003, "Idre", "SWE")]


def test_ranking_pages(spark, tmp_path):
    (tmp_path / "2026_0443.json").write_text(json.dumps({"rows": [{"rank": "1", "code": "07", "name": "A", "score": "80.1"}, {"rank": "2", "code": "08", "name": "B", "score": None}]}, indent=1))
    (tmp_path / "2026_0444.json").write_text(json.dumps({"rows": []}))
    url = "https://example.org/freestyle/{}/competition/{}/result"
    wanted = spark.createDataFrame([("a", url.format(2026, "0443")), ("b", url.format(2026, "0444")), ("c", url.format(2025, "0001")), ("d", "https://example.org/other"), ("e", None), ("f", url.format(2026, "0443"))], "round string, page_url string")
    got = {r["round"]: (r["state"], len(r["rows"] or [])) for r in ranking_pages(spark, str(tmp_path), wanted).collect()}
    assert got == {"a": ("read", 2), "b": ("empty", 0), "c": ("not saved", 0), "d": ("no key", 0), "e": ("no key", 0), "f": ("read", 2)}
