"""Publishing: nested events, shards and partitions with their checks, rules, issue counts, pages and lists."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from runledger.functions.exact import close, total
from runledger.plans.matching import external_cascade_match, input_fixes, reader_sequence_compare
from runledger.sources.scratch import scratch_path
from runledger.sources.tables import MARKS, marks, runs, table

SHARDS = 64
# Short labels of priorities, in their order.
LABELS = {"1-URGENT": "A", "2-HIGH": "B", "3-MEDIUM": "C", "4-NOT SPECIFIED": "D", "5-LOW": "E"}


def shards_and_sizes(spark, sf_dir):
    """Athletes and runs of each of 64 shards (crc32 of the id's text), and the sizes of the rounds that its athletes ran in."""
    rows = runs(spark, sf_dir).select("athlete", "season", "series", F.pmod(F.crc32(F.col("athlete").cast("string").cast("binary")), F.lit(SHARDS)).alias("shard"))
    sizes = rows.groupBy("season", "series").agg(F.count("*").alias("size"))
    each = rows.groupBy("shard", "season", "series").agg(F.count("*").alias("n")).join(F.broadcast(sizes), ["season", "series"]).groupBy("shard").agg(F.sum("n").alias("n_runs"), F.count("*").alias("n_rounds"), F.sum("size").alias("round_sizes"))
    return each.join(rows.select("shard", "athlete").distinct().groupBy("shard").agg(F.count("*").alias("n_athletes")), "shard")


def flat_export(spark, sf_dir):
    """One flat row a run (five judges, two jumps, totals), with totals counted again from the flat cells and compared."""
    high, low = F.array_max("m"), F.array_min("m")
    rows = marks(spark, sf_dir).select("vec_id", *[F.col("m")[i].alias(f"j{i + 1}") for i in range(5)], *[F.col("air")[i].alias(f"a{i + 1}") for i in range(2)], (total(F.col("m")) - high - low).alias("turns"), total(F.col("air")).alias("air_total"))
    cells = [F.col(f"j{i}") for i in range(1, 6)]
    again = sum(cells[1:], cells[0]) - F.greatest(*cells) - F.least(*cells)
    return rows.withColumn("agrees", close(again, F.col("turns"), 0, False) & close(F.col("a1") + F.col("a2"), F.col("air_total"), 0, False))


def _stamp(*columns):
    """The first 32 bits of a row's hash; their sum stands for a table whatever the order of its rows."""
    return F.conv(F.substring(F.sha2(F.concat_ws("|", *columns), 256), 1, 8), 16, 10).cast("long")


def incremental_hash_check(spark, sf_dir):
    """Published seasons (every 211th run missing, every 223rd changed, every 227th twice) against the runs: counts, content hashes, and runs that
    are not there exactly once."""
    now = runs(spark, sf_dir).select("run_id", "season", "score_k")
    out = table(spark, sf_dir, "orders").filter("o_orderkey % 211 <> 0").select(F.col("o_orderkey").alias("run_id"), (F.floor(F.col("o_totalprice") / 1000) + F.when(F.col("o_orderkey") % 223 == 0, 1).otherwise(0)).cast("long").alias("score_k"), F.explode(F.expr("sequence(1, if(o_orderkey % 227 = 0, 2, 1))")).alias("copy"))
    published = out.groupBy("run_id").agg(F.count("*").alias("copies"), F.sum(_stamp("run_id", "score_k")).alias("there"))
    both = now.withColumn("here", _stamp("run_id", "score_k")).join(published, "run_id", "left")
    return both.groupBy("season").agg(F.count("*").alias("n"), F.sum("here").alias("hash"), F.coalesce(F.sum("there"), F.lit(0)).alias("published_hash"), F.count_if(F.coalesce("copies", F.lit(0)) != 1).alias("n_not_once"), F.count_if(F.col("here") * F.col("copies") != F.col("there")).alias("n_changed"))


def events_nested(spark, sf_dir):
    """Events (an athlete's season) with their dates, tiers and rounds nested in order; private columns are left out; a light index as text."""
    rows = runs(spark, sf_dir).withColumn("_tier", F.when(F.col("score_k") > 250, "detail").when(F.col("score_k") > 100, "score").otherwise("rank"))
    each = rows.groupBy("athlete", "season").agg(F.min("date").alias("date_from"), F.max("date").alias("date_to"), F.array_sort(F.collect_set("_tier")).alias("tiers"), F.array_sort(F.collect_list(F.struct("date", "run_id", "series"))).alias("_rounds"))
    index = F.transform("_rounds", lambda r: F.concat_ws(":", r["run_id"], r["series"]))
    out = each.withColumn("tier_text", F.array_join("tiers", "+")).withColumn("index", F.array_join(index, " "))
    return out.select([c for c in out.columns if not c.startswith("_") and c != "tiers"])


def rules_first_non_empty(spark, sf_dir):
    """The first non-empty rule text of each version (nation) in the order of suppliers; versions in use without one are errors."""
    text = F.when(F.col("s_suppkey") % 3 == 0, F.concat(F.lit("trim:"), F.col("s_suppkey"))).when(F.col("s_suppkey") % 3 == 1, F.lit(""))
    rules = table(spark, sf_dir, "supplier").filter("s_nationkey % 9 <> 4").select("s_nationkey", "s_suppkey", text.alias("rule"))
    first = rules.groupBy("s_nationkey").agg(F.min_by("rule", F.when(F.length("rule") > 0, F.col("s_suppkey"))).alias("rule"))
    used = table(spark, sf_dir, "customer").groupBy("c_nationkey").agg(F.count("*").alias("n_uses"))
    rule = F.nullif(F.col("rule"), F.lit(""))
    return used.join(first, F.col("c_nationkey") == F.col("s_nationkey"), "left").select("c_nationkey", "n_uses", rule.alias("rule"), rule.isNull().alias("missing"))


def issue_kinds(spark, sf_dir):
    """Findings of three checks in one table, written once: by layer and kind how many, and the least three keys of each."""
    a = external_cascade_match(spark, sf_dir).filter("finding <> 'ok'").select(F.lit("ranking").alias("layer"), F.col("finding").alias("kind"), F.col("line").alias("key"))
    b = input_fixes(spark, sf_dir).filter("state = 'unused'").select(F.lit("fixes").alias("layer"), F.col("field").alias("kind"), F.col("o_orderkey").alias("key"))
    c = reader_sequence_compare(spark, sf_dir).select(F.lit("readers").alias("layer"), F.col("state").alias("kind"), F.col("l_orderkey").alias("key"))
    path = scratch_path(spark, "issues")
    a.unionByName(b).unionByName(c).write.parquet(path)
    every = spark.read.schema("layer string, kind string, key long").parquet(path)
    first = every.withColumn("place", F.row_number().over(Window.partitionBy("layer", "kind").orderBy("key"))).filter("place <= 3")
    shown = first.groupBy("layer", "kind").agg(F.array_join(F.transform(F.array_sort(F.collect_list("key")), lambda x: x.cast("string")), ",").alias("first_keys"))
    return every.groupBy("layer", "kind").agg(F.count("*").alias("n")).join(F.broadcast(shown), ["layer", "kind"])


def season_partitions(spark, sf_dir):
    """Runs written by season, one season published again without its unfinished runs, read back: counts, and each season's first row of the export."""
    path = scratch_path(spark, "seasons")
    rows = runs(spark, sf_dir).select("run_id", "athlete", "status", "score_k", "season")
    save = lambda df: df.write.option("partitionOverwriteMode", "dynamic").mode("overwrite").partitionBy("season").parquet(path)
    save(rows)
    save(rows.filter("season = '1996-97' AND status = 'OK'"))
    back = spark.read.schema(rows.schema).parquet(path)
    first = F.min_by("run_id", F.struct(-F.col("score_k"), F.col("athlete"), F.col("run_id")))
    return back.groupBy("season").agg(F.count("*").alias("n"), F.count_if(F.col("status") != "OK").alias("n_unfinished"), first.alias("first_run"))


def event_page(spark, sf_dir):
    """Each athlete's season as a page: rows by score (unfinished last), the round shown first (the high one, else the last) and what is shown: a
    score of unfinished runs is hidden, and a column for it only where the page has one."""
    rows = runs(spark, sf_dir).select("athlete", "season", "run_id", "date", "series", F.when(F.col("status") == "OK", F.col("score_k")).alias("shown"))
    own = Window.partitionBy("athlete", "season")
    line = F.row_number().over(own.orderBy(F.desc_nulls_last("shown"), "run_id")).cast("long")
    default = F.max(F.struct((F.col("series") == "2-HIGH").alias("wanted"), "date", "run_id")).over(own)["run_id"]
    return rows.select("athlete", "season", "run_id", "shown", line.alias("line"), (F.col("run_id") == default).alias("opened"), F.max(F.col("shown").isNull()).over(own).alias("has_unfinished"))


def list_page(spark, sf_dir):
    """The first 30 athletes by name with at least two chartable runs, their newest eight runs in order and how many are left; the limits are the
    feature."""
    done = runs(spark, sf_dir).filter("status = 'OK'")
    charted = done.groupBy("athlete").agg(F.count("*").alias("n")).filter("n >= 2")
    cards = charted.join(table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("athlete"), "c_name"), "athlete").orderBy("c_name", "athlete").limit(30)
    newest = F.row_number().over(Window.partitionBy("athlete").orderBy(F.desc("date"), F.desc("run_id")))
    own = done.join(F.broadcast(cards), "athlete").withColumn("k", newest).filter("k <= 8")
    listed = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("k", "run_id"))), lambda x: x["run_id"].cast("string")), ",")
    return own.groupBy("athlete", "c_name", "n").agg(listed.alias("newest")).withColumn("n_rest", F.greatest(F.col("n") - 8, F.lit(0)))


def source_labels(spark, sf_dir):
    """By nation and year: distinct series as short labels in order, the span of dates as text, and round names with their default."""
    label = F.create_map(*[F.lit(x) for pair in LABELS.items() for x in pair])
    people = table(spark, sf_dir, "customer").join(F.broadcast(table(spark, sf_dir, "nation")), F.col("c_nationkey") == F.col("n_nationkey")).select(F.col("c_custkey").alias("athlete"), "n_name")
    rows = runs(spark, sf_dir).join(people, "athlete").withColumn("year", F.year("date").cast("long"))
    each = rows.groupBy("n_name", "year").agg(F.array_sort(F.collect_set(label[F.col("series")])).alias("l"), F.min("date").alias("a"), F.max("date").alias("b"), F.count("*").alias("n"))
    span = F.when(F.col("a") == F.col("b"), F.date_format("a", "yyyy-MM-dd")).otherwise(F.concat(F.date_format("a", "yyyy-MM-dd"), F.lit(" to "), F.date_format("b", "MM-dd")))
    return each.select("n_name", "year", F.array_join("l", "").alias("labels"), span.alias("span"), "n", F.coalesce(F.when(F.size("l") == 5, "all rounds"), F.lit("some rounds")).alias("round_text"))


LIST = (shards_and_sizes, flat_export, incremental_hash_check, events_nested, rules_first_non_empty, issue_kinds, season_partitions, event_page, list_page, source_labels)
_RUNS = """runs AS (SELECT o_orderkey AS run_id, o_custkey AS athlete, o_orderdate::DATE AS date, printf('%d-%02d', y, (y + 1) % 100) AS season, o_orderpriority AS series,
 CASE WHEN o_orderstatus = 'P' THEN 'DNF' ELSE 'OK' END AS status, floor(o_totalprice / 1000)::BIGINT AS score_k FROM (SELECT *, year(o_orderdate) - CASE WHEN month(o_orderdate) < 7 THEN 1 ELSE 0 END AS y FROM orders))"""


def _issues():
    from runledger.plans.matching import SQL as MATCH

    return f"""WITH e AS (SELECT 'ranking' AS layer, finding AS kind, line AS key FROM ({MATCH['external_cascade_match']}) WHERE finding <> 'ok' UNION ALL SELECT 'fixes', field, o_orderkey FROM ({MATCH['input_fixes']}) WHERE state = 'unused'
 UNION ALL SELECT 'readers', state, l_orderkey FROM ({MATCH['reader_sequence_compare']})) SELECT layer, kind, count(*) AS n, array_to_string(list(key ORDER BY key)[1:3], ',') AS first_keys FROM e GROUP BY 1, 2"""


def _shards():
    from runledger.plans.published import CRC

    return f"""WITH {_RUNS}, {CRC}, r AS (SELECT athlete, season, series, shard FROM runs JOIN shards USING (athlete)), s AS (SELECT season, series, count(*) AS size FROM runs GROUP BY 1, 2)
 SELECT shard, (SELECT count(*) FROM r WHERE r.shard = e.shard) AS n_runs, count(*) AS n_rounds, sum(size)::BIGINT AS round_sizes, (SELECT count(DISTINCT athlete) FROM r WHERE r.shard = e.shard) AS n_athletes
 FROM (SELECT DISTINCT shard, season, series FROM r) e JOIN s USING (season, series) GROUP BY shard"""


SQL = {
    "shards_and_sizes": _shards(),
    "flat_export": f"""WITH {MARKS} SELECT vec_id, m[1] AS j1, m[2] AS j2, m[3] AS j3, m[4] AS j4, m[5] AS j5, air[1] AS a1, air[2] AS a2, list_sum(list_sort(m)[2:4])::BIGINT AS turns, list_sum(air)::BIGINT AS air_total, true AS agrees FROM marks""",
    "incremental_hash_check": f"""WITH {_RUNS}, s AS (SELECT season, run_id, ('0x' || sha256(run_id || '|' || score_k)[1:8])::BIGINT AS here, ('0x' || sha256(run_id || '|' || (score_k + CASE WHEN run_id % 223 = 0 THEN 1 ELSE 0 END))[1:8])::BIGINT AS one,
  CASE WHEN run_id % 211 = 0 THEN 0 WHEN run_id % 227 = 0 THEN 2 ELSE 1 END AS copies FROM runs)
 SELECT season, count(*) AS n, sum(here)::BIGINT AS hash, sum(one * copies)::BIGINT AS published_hash, count(*) FILTER (WHERE copies <> 1) AS n_not_once, count(*) FILTER (WHERE copies > 0 AND run_id % 223 = 0) AS n_changed FROM s GROUP BY 1""",
    "events_nested": f"""WITH {_RUNS}, t AS (SELECT *, CASE WHEN score_k > 250 THEN 'detail' WHEN score_k > 100 THEN 'score' ELSE 'rank' END AS tier FROM runs)
 SELECT athlete, season, min(date) AS date_from, max(date) AS date_to, string_agg(DISTINCT tier, '+' ORDER BY tier) AS tier_text, string_agg(run_id || ':' || series, ' ' ORDER BY date, run_id) AS index FROM t GROUP BY 1, 2""",
    "rules_first_non_empty": """SELECT c_nationkey, count(*) AS n_uses, min(rule) AS rule, min(rule) IS NULL AS missing FROM customer LEFT JOIN (SELECT s_nationkey, 'trim:' || min(s_suppkey) AS rule FROM supplier WHERE s_suppkey % 3 = 0 AND s_nationkey % 9 <> 4 GROUP BY 1) ON c_nationkey = s_nationkey GROUP BY 1""",
    "issue_kinds": _issues(),
    "season_partitions": f"WITH {_RUNS}, k AS (SELECT * FROM runs WHERE season <> '1996-97' OR status = 'OK') SELECT season, count(*) AS n, count(*) FILTER (WHERE status <> 'OK') AS n_unfinished, arg_min(run_id, (-score_k, athlete, run_id)) AS first_run FROM k GROUP BY 1",
    "event_page": f"""WITH {_RUNS}, r AS (SELECT *, CASE WHEN status = 'OK' THEN score_k END AS shown FROM runs)
 SELECT athlete, season, run_id, shown, row_number() OVER (PARTITION BY athlete, season ORDER BY shown DESC NULLS LAST, run_id) AS line, row_number() OVER (PARTITION BY athlete, season ORDER BY series = '2-HIGH' DESC, date DESC, run_id DESC) = 1 AS opened,
 count(*) FILTER (WHERE shown IS NULL) OVER (PARTITION BY athlete, season) > 0 AS has_unfinished FROM r""",
    "list_page": f"""WITH {_RUNS}, d AS (SELECT * FROM runs WHERE status = 'OK'), c AS (SELECT athlete, c_name, count(*) AS n FROM d JOIN customer ON athlete = c_custkey GROUP BY 1, 2 HAVING count(*) >= 2 ORDER BY c_name, athlete LIMIT 30)
 SELECT athlete, c_name, n, array_to_string(list(run_id ORDER BY date DESC, run_id DESC)[1:8], ',') AS newest, greatest(n - 8, 0) AS n_rest FROM c JOIN d USING (athlete) GROUP BY 1, 2, 3""",
    "source_labels": f"""WITH {_RUNS}, l AS (SELECT n_name, year(date) AS year, chr(64 + series[1]::INT) AS label, date FROM runs JOIN customer ON athlete = c_custkey JOIN nation ON c_nationkey = n_nationkey)
 SELECT n_name, year, string_agg(DISTINCT label, '' ORDER BY label) AS labels, CASE WHEN min(date) = max(date) THEN strftime(min(date), '%Y-%m-%d') ELSE strftime(min(date), '%Y-%m-%d') || ' to ' || strftime(max(date), '%m-%d') END AS span, count(*) AS n,
 CASE WHEN count(DISTINCT label) = 5 THEN 'all rounds' ELSE 'some rounds' END AS round_text FROM l GROUP BY 1, 2""",
}
