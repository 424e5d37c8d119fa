"""Query catalogue over the driver's tables; each query has an independent SQL statement beside it."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from runledger.operators.ranks import competition_rank
from runledger.plans import checks, ladder, matching, names, progress, publish, published, readers, records, report, rounds, scoring, sequences, sheets, texts, wording
from runledger.sources.tables import runs, table


RUNS = """runs AS (SELECT o_orderkey AS run_id, o_custkey AS athlete, CAST(o_orderdate AS DATE) AS date,
 printf('%d-%02d', y, (y + 1) % 100) AS season, o_orderpriority AS series,
 CASE WHEN o_orderstatus = 'P' THEN 'DNF' ELSE 'OK' END AS status, CAST(floor(o_totalprice / 1000) AS BIGINT) AS score_k
 FROM (SELECT *, year(o_orderdate) - CASE WHEN month(o_orderdate) < 7 THEN 1 ELSE 0 END AS y FROM orders))"""
BLOCK = ("season", "series")


def season_rank(spark, sf_dir):
    return competition_rank(runs(spark, sf_dir).filter("status = 'OK'").select("run_id", *BLOCK, "score_k"), list(BLOCK), "score_k")


def topn_with_ties(spark, sf_dir):
    return season_rank(spark, sf_dir).filter("rank <= 16")


def rank_tiebreak_keys(spark, sf_dir):
    rows = runs(spark, sf_dir).filter("status = 'OK'").select("run_id", *BLOCK, "score_k", "date")
    return competition_rank(rows, list(BLOCK), "score_k", then=[F.col("date"), F.col("run_id")]).select("run_id", *BLOCK, "rank")


def series_summary(spark, sf_dir):
    return runs(spark, sf_dir).groupBy("series").agg(
        F.countDistinct("season").alias("seasons"), F.min("season").alias("first_season"), F.max("season").alias("last_season"),
        F.count("*").alias("n_runs"), F.countDistinct("athlete").alias("athletes"),
    )


def cut_lines(spark, sf_dir):
    """Winner and 16th place (the last, where there are fewer) of each block; only the first 16 rows of a block are ever sorted together."""
    rows = runs(spark, sf_dir).filter("status = 'OK'").select("run_id", *BLOCK, "score_k", "date")
    counts = rows.groupBy(*BLOCK).agg(F.count("*").alias("n_ok"))
    first = rows.withColumn("rank", F.row_number().over(Window.partitionBy(*BLOCK).orderBy(F.desc("score_k"), "date", "run_id"))).filter("rank <= 16")
    return first.groupBy(*BLOCK).agg(F.min_by("run_id", "rank").alias("winner"), F.max_by("run_id", "rank").alias("cut")).join(counts, list(BLOCK))


def athlete_dimension(spark, sf_dir):
    return runs(spark, sf_dir).groupBy("athlete").agg(
        F.count("*").alias("n_runs"), F.max("date").alias("last_date"), F.max_by("series", F.struct("date", "run_id")).alias("last_series"),
        F.max(F.when(F.col("status") == "OK", F.col("score_k"))).alias("best"),
    )


def completeness(spark, sf_dir):
    """Orders without a line, or with other than the printed number of lines, and whether their lines are numbered twice."""
    lines = table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(F.count("*").alias("n_lines"), F.countDistinct("l_linenumber").alias("n_numbers"))
    orders = table(spark, sf_dir, "orders").select("o_orderkey", (F.col("o_custkey") % 7 + 1).alias("printed"))
    both = orders.join(lines, orders.o_orderkey == lines.l_orderkey, "left").select("o_orderkey", "printed", F.coalesce("n_lines", F.lit(0)).alias("n_lines"), F.coalesce("n_numbers", F.lit(0)).alias("n_numbers"))
    kind = F.when(F.col("n_lines") == 0, "none").when(F.col("n_lines") != F.col("n_numbers"), "repeated").when(F.col("n_lines") != F.col("printed"), "count").otherwise("ok")
    return both.select("o_orderkey", "printed", "n_lines", kind.alias("kind")).filter("kind <> 'ok'")


def repeated_rows(spark, sf_dir):
    return table(spark, sf_dir, "lineitem").groupBy("l_orderkey", "l_linenumber").agg(F.count("*").alias("n")).filter("n > 1")


def shared_document(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select(F.sha2("text", 256).alias("sha"), "source")
    return docs.groupBy("sha").agg(F.countDistinct("source").alias("n_sources")).filter("n_sources > 1")


def gap_clusters(spark, sf_dir):
    w = Window.partitionBy("user_id").orderBy("ts", "event_id")
    gap = F.col("ts") - F.lag("ts").over(w) > F.expr("INTERVAL 6 HOURS")
    flagged = table(spark, sf_dir, "events").select("event_id", "user_id", "ts", F.when(gap, 1).otherwise(0).alias("g"))
    return flagged.select("event_id", "user_id", F.sum("g").over(w).alias("cluster"))


def heading_fill_forward(spark, sf_dir):
    order = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    lines = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    marked = lines.withColumn("heading", F.when(F.col("role") == "user", F.col("turn")))
    return marked.select("conv_id", "turn", "role", F.last("heading", ignorenulls=True).over(order).alias("heading"))


def dd_consistency(spark, sf_dir):
    return table(spark, sf_dir, "part").groupBy("p_brand", "p_type").agg(F.countDistinct("p_size").alias("n_sizes"), F.min("p_size").alias("least"), F.max("p_size").alias("most")).filter("n_sizes > 1")


QUERIES = {f.__name__: f for f in (season_rank, topn_with_ties, rank_tiebreak_keys, series_summary, cut_lines, athlete_dimension, completeness, repeated_rows, shared_document, gap_clusters, heading_fill_forward, dd_consistency)}
_RANK = "SELECT run_id, season, series, score_k, rank() OVER (PARTITION BY season, series ORDER BY score_k DESC) AS rank FROM runs WHERE status = 'OK'"
_KEYS = "SELECT run_id, season, series, rank() OVER (PARTITION BY season, series ORDER BY score_k DESC, date, run_id) AS rank FROM runs WHERE status = 'OK'"
SQL = {
    "season_rank": f"WITH {RUNS} {_RANK}",
    "topn_with_ties": f"WITH {RUNS} SELECT * FROM ({_RANK}) WHERE rank <= 16",
    "rank_tiebreak_keys": f"WITH {RUNS} {_KEYS}",
    "series_summary": f"WITH {RUNS} SELECT series, count(DISTINCT season) AS seasons, min(season) AS first_season, max(season) AS last_season, count(*) AS n_runs, count(DISTINCT athlete) AS athletes FROM runs GROUP BY series",
    "cut_lines": f"WITH {RUNS}, k AS ({_KEYS}) SELECT season, series, arg_min(run_id, rank) AS winner, arg_max(run_id, rank) FILTER (WHERE rank <= 16) AS cut, count(*) AS n_ok FROM k GROUP BY season, series",
    "athlete_dimension": f"WITH {RUNS}, o AS (SELECT *, row_number() OVER (PARTITION BY athlete ORDER BY date DESC, run_id DESC) AS rn FROM runs) SELECT athlete, count(*) AS n_runs, max(date) AS last_date, max(CASE WHEN rn = 1 THEN series END) AS last_series, max(CASE WHEN status = 'OK' THEN score_k END) AS best FROM o GROUP BY athlete",
    "completeness": """WITH l AS (SELECT o_orderkey, o_custkey % 7 + 1 AS printed, count(l_orderkey) AS n_lines, count(DISTINCT l_linenumber) AS d FROM orders LEFT JOIN lineitem ON o_orderkey = l_orderkey GROUP BY 1, 2)
 SELECT o_orderkey, printed, n_lines, CASE WHEN n_lines = 0 THEN 'none' WHEN n_lines <> d THEN 'repeated' ELSE 'count' END AS kind FROM l WHERE n_lines = 0 OR n_lines <> d OR n_lines <> printed""",
    "repeated_rows": "SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1",
    "shared_document": "SELECT sha256(text) AS sha, count(DISTINCT source) AS n_sources FROM documents GROUP BY 1 HAVING count(DISTINCT source) > 1",
    "gap_clusters": "SELECT event_id, user_id, CAST(sum(g) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS BIGINT) AS cluster FROM (SELECT event_id, user_id, ts, CASE WHEN ts - lag(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) > INTERVAL 6 HOUR THEN 1 ELSE 0 END AS g FROM events)",
    "heading_fill_forward": "SELECT conv_id, turn, role, last_value(CASE WHEN role = 'user' THEN turn END IGNORE NULLS) OVER (PARTITION BY conv_id ORDER BY turn, role, text RANGE UNBOUNDED PRECEDING) AS heading FROM conversations",
    "dd_consistency": "SELECT p_brand, p_type, count(DISTINCT p_size) AS n_sizes, min(p_size) AS least, max(p_size) AS most FROM part GROUP BY 1, 2 HAVING count(DISTINCT p_size) > 1",
}
for module in (scoring, checks, ladder, texts, matching, rounds, publish, published, wording, names, sequences, records, readers, report, sheets, progress):
    QUERIES |= {f.__name__: f for f in module.LIST}
    SQL |= module.SQL
