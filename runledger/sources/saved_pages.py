"""Readers of saved web pages: result lists and event lists as typed rows, and ranking pages found by a key of their address.

A page is cut into blocks and a block into fields by patterns given as data, all in column functions; a field that a block lacks is null. Pages are one row each, so
they are dealt by page.
"""

from __future__ import annotations

import html

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# The classes that mark the fields of a result list, with the form and the type of each, and the address of a ranking page.
RESULT_BLOCK = r'(?s)<a class="table-row"\s+href="[^"]*athlete-biography[^"]*"[^>]*>(.*?)</a>'
RESULT = {
    "rank": ("justify-right pr-1 bold", r"\d*", "int"), "bib": ("hidden-sm-down gray", r"\d*", "int"), "fis_code": ("justify-right gray", r"\d+", "string"),
    "name": ("justify-left bold", r".*?", "text"), "year": ("hidden-sm-down justify-left", r"\d{4}", "int"), "nation": ("country__name-short", r"\w+", "string"), "run_score": ("blue bold", r"[\d.]+", "double"),
}
ADDRESS = r"/freestyle/(\d{4})/competition/(\d+)/result"
RANKING = "rows array<struct<rank:string,code:string,name:string,score:string>>"
#: Entities by name that pages use, decoded by the standard's table.
ENTITIES = {f"&{name};": html.unescape(f"&{name};") for name in ("nbsp", "lt", "gt", "quot", "apos", "eacute", "egrave", "uuml", "ouml", "auml", "ntilde", "ccedil")}


def plain_text(x: Column) -> Column:
    """Without tags, entities decoded (numbered ones of one code unit too), white space single."""
    x = F.regexp_replace(x, "<[^>]+>", " ")
    for entity, sign in ENTITIES.items():
        x = F.replace(x, F.lit(entity), F.lit(sign))
    numbered = F.regexp_extract_all(x, F.lit(r"&#(\d{1,5});"), F.lit(1))
    x = F.aggregate(numbered, x, lambda text, n: F.replace(text, F.concat(F.lit("&#"), n, F.lit(";")), F.decode(F.unhex(F.lpad(F.hex(n.cast("long")), 4, "0")), "UTF-16BE")))
    return F.trim(F.regexp_replace(F.replace(x, F.lit("&amp;"), F.lit("&")), r"[\s ]+", " "))


def fields_of(pages: DataFrame, keys: list[str], page: str, block: str, fields: dict) -> DataFrame:
    """keys, place (from 0 in its page) and the fields of each block. fields: name -> (class, form, type)."""
    blocks = pages.select(*keys, F.posexplode(F.regexp_extract_all(F.col(page), F.lit(block), F.lit(1))).alias("place", "_block"))

    def field(name, mark, form, kind):
        found = F.get(F.regexp_extract_all("_block", F.lit(rf'(?s){mark}">\s*({form})\s*<{"/div>" if kind == "text" else ""}'), F.lit(1)), F.lit(0))
        return (plain_text(found) if kind == "text" else F.nullif(found, F.lit("")).try_cast(kind)).alias(name)

    return blocks.select(*keys, "place", *[field(name, *rule) for name, rule in fields.items()])


def result_list(pages: DataFrame, keys: list[str], page: str = "html") -> DataFrame:
    """A result page's rows; without a rank (not started, not finished) rank and score are null."""
    rows = fields_of(pages, keys, page, RESULT_BLOCK, RESULT)
    return rows.withColumn("run_score", F.when(F.col("rank").isNotNull(), F.col("run_score")))


def single_races(events: DataFrame, races: DataFrame) -> DataFrame:
    """Races of single moguls with the venue and nation of their event; dual and other disciplines are left out. events: event_id, venue, nation; races:
    event_id, codex, discipline, gender, date."""
    text = F.lower("discipline")
    return races.filter(F.startswith(text, F.lit("moguls")) & ~F.contains(text, F.lit("dual"))).join(events.select("event_id", "venue", "nation"), "event_id")


def ranking_pages(spark: SparkSession, folder: str, wanted: DataFrame) -> DataFrame:
    """wanted (page_url and its own columns) with the rows of the saved page of its address (<season>_<number>.json), `state` telling pages that are there, empty, not saved
    or of another address. The folder's files are read once, whatever is wanted."""
    saved = spark.read.schema(RANKING).option("multiLine", True).json(folder, pathGlobFilter="*.json").select(F.regexp_replace(F.col("_metadata.file_name"), r"\.json$", "").alias("_key"), "rows")
    parts = [F.regexp_extract("page_url", ADDRESS, i) for i in (1, 2)]
    asked = wanted.withColumn("_key", F.when(parts[0] != "", F.concat_ws("_", *parts)))
    both = asked.join(saved.withColumn("_saved", F.lit(True)), "_key", "left")
    state = F.when(F.col("_key").isNull(), "no key").when(F.col("_saved").isNull(), "not saved").when(F.coalesce(F.size("rows"), F.lit(0)) < 1, "empty").otherwise("read")
    return both.withColumn("state", state).drop("_key", "_saved")
