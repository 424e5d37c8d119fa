"""Records as they are read and shown: normalised runs, jumps, rounds, event lists, histories, searches and states."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from runledger.functions.exact import hundredths
from runledger.functions.names import slug
from runledger.sources.tables import runs, table

# The cap of a search, the order of groups, words of a round, letters of jumps.
MOST = 200
GROUPS = ["BUILDING", "AUTOMOBILE", "MACHINERY", "HOUSEHOLD", "FURNITURE"]
JUMPS = ["bT", "bG", "bL", "TT"]
QUERIES = ["", "customer#0000000", "77", "  CUSTOMER#00000012 ", "nobody"]


def normalised(spark, sf_dir):
    """Runs of the vectors: five base marks and five deductions (printed without a sign; none printed where the sixth component is above 0.2), two jumps
    of two marks and a factor (a jump without a factor is none), seconds; every mark empty where the last components say so."""
    x = F.transform("embedding", hundredths)
    rows = table(spark, sf_dir, "embeddings").filter("size(embedding) >= 20").select("vec_id", "label", x.alias("x"))
    printed = F.when(F.col("x")[5] <= 20, F.transform(F.slice("x", 6, 5), lambda v: F.abs(v)))
    empty = (F.col("x")[18] > 15) & (F.col("x")[19] > 0)
    base = F.when(empty, F.array_repeat(F.lit(None).cast("long"), 5)).otherwise(F.transform(F.slice("x", 1, 5), lambda v: F.abs(v)))

    def jump(at):
        dd = F.col("x")[at + 2]
        return F.when(~empty & (dd > -10), F.struct(F.abs(F.col("x")[at]).alias("j6"), F.abs(F.col("x")[at + 1]).alias("j7"), F.get(F.array(*map(F.lit, JUMPS)), F.pmod(dd, F.lit(len(JUMPS))).cast("int")).alias("jump"), (F.abs(dd) + 50).alias("dd")))

    status = F.when(F.col("x")[17] > 12, "DNF").otherwise("OK")
    tier = F.when(F.col("x")[16] > 8, "detail").when(F.col("x")[16] > -12, "score").otherwise("rank")
    ded = F.when(printed.isNull(), F.array_repeat(F.lit(0).cast("long"), 5)).otherwise(F.transform(printed, lambda v: -v))
    rows = rows.select("vec_id", "label", status.alias("status"), tier.alias("tier"), base.alias("base"), ded.alias("ded"), printed.isNull().alias("ded_missing"), F.array_compact(F.array(jump(10), jump(13))).alias("air"), F.when(~empty, F.abs(F.col("x")[16]) + 2000).alias("seconds"))
    blank = F.forall("base", lambda v: v.isNull()) & (F.size("air") == 0) & F.col("seconds").isNull()
    return rows.withColumn("empty", (F.col("status") == "OK") & blank)


def run_records(spark, sf_dir):
    """Normalised runs as texts, whether deductions were missing, whether the block is empty though finished, and cells that a reader must not accept: a mark above
    0.4, or fewer than five judges."""
    text = lambda c: F.array_join(F.transform(c, lambda v: v.cast("string")), ",")
    air = F.array_join(F.transform("air", lambda a: F.concat_ws("/", a["j6"], a["j7"], a["jump"], a["dd"])), " ")
    wrong = F.size(F.filter("base", lambda v: v > 40)) + (F.size(F.array_compact("base")) < 5).cast("int")
    rows = normalised(spark, sf_dir)
    return rows.select("vec_id", "status", "tier", text("base").alias("base"), text("ded").alias("ded"), "ded_missing", air.alias("air"), F.size("air").cast("long").alias("n_jumps"), "seconds", "empty", wrong.cast("long").alias("n_wrong"))


def jump_rows(spark, sf_dir):
    """Jumps of finished runs at detail tier: the place in the run, the jump, its factor and the execution score (mean of the two marks, in half hundredths)."""
    rows = normalised(spark, sf_dir).filter("tier = 'detail' AND status = 'OK' AND size(air) > 0").select("vec_id", F.posexplode("air").alias("place", "a"))
    return rows.select("vec_id", F.col("place").cast("long").alias("place"), "a.jump", "a.dd", (F.col("a.j6") + F.col("a.j7")).alias("execution"))


def run_summaries(spark, sf_dir):
    """By round (label): a run's summary holds its status, its jumps without marks and its best mark; how many summaries differ, how many are of each tier, and the
    most frequent one."""
    air = F.array_join(F.transform("air", lambda a: F.concat(a["jump"], a["dd"].cast("string"))), "+")
    rows = normalised(spark, sf_dir).select("label", "tier", F.concat_ws("|", "status", air, F.coalesce(F.array_max("base").cast("string"), F.lit("-"))).alias("summary"))
    each = rows.groupBy("label", "summary").agg(F.count("*").alias("n"), *[F.count_if(F.col("tier") == t).alias(t) for t in ("detail", "score", "rank")])
    return each.groupBy("label").agg(F.sum("n").alias("n_runs"), F.count("*").alias("n_summaries"), *[F.sum(t).alias(f"n_{t}") for t in ("detail", "score", "rank")], F.min_by("summary", F.struct(-F.col("n"), "summary")).alias("most_frequent"))


def round_rows(spark, sf_dir):
    """Rounds (a series' season) with their venue (nation of most runs), round text with its default, judges (the five suppliers of most lines) by id and name, and the
    number of runs of each tier."""
    rows = runs(spark, sf_dir)
    people = table(spark, sf_dir, "customer").join(F.broadcast(table(spark, sf_dir, "nation")), F.col("c_nationkey") == F.col("n_nationkey")).select(F.col("c_custkey").alias("athlete"), "n_name")
    by = ["season", "series"]
    venue = rows.join(people, "athlete").groupBy(*by, "n_name").agg(F.count("*").alias("n")).groupBy(*by).agg(F.min_by("n_name", F.struct(-F.col("n"), "n_name")).alias("venue"))
    lines = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("run_id"), "l_suppkey")
    judged = rows.select("run_id", *by).join(lines, "run_id").groupBy(*by, "l_suppkey").agg(F.count("*").alias("n"))
    first = judged.withColumn("k", F.row_number().over(Window.partitionBy(*by).orderBy(F.desc("n"), "l_suppkey"))).filter("k <= 5")
    named = first.join(F.broadcast(table(spark, sf_dir, "supplier").select("s_suppkey", "s_name")), F.col("l_suppkey") == F.col("s_suppkey"))
    judge = F.struct("k", F.concat(F.lit("judge-"), slug(F.col("s_name"))).alias("id"))
    judges = named.groupBy(*by).agg(F.array_join(F.transform(F.array_sort(F.collect_list(judge)), lambda j: j["id"]), " ").alias("judges"))
    tier = F.when(F.col("score_k") > 250, "detail").when(F.col("score_k") > 100, "score").otherwise("rank")
    counts = rows.withColumn("tier", tier).groupBy(*by).agg(*[F.count_if(F.col("tier") == t).alias(f"n_{t}") for t in ("detail", "score", "rank")])
    text = F.when(F.substring("series", 1, 1) <= "2", F.initcap(F.substring("series", 3, 20)))
    return counts.join(venue, by).join(judges, by).select(*by, "venue", F.coalesce(text, F.lit("Round")).alias("round_text"), "judges", "n_detail", "n_score", "n_rank")


def _events(spark, sf_dir):
    """An athlete's season as an event: dates of its finished runs alone (none: null), its rounds nested, its group."""
    each = runs(spark, sf_dir).groupBy("athlete", "season").agg(F.min(F.when(F.col("status") == "OK", F.col("date"))).alias("date_from"), F.collect_list(F.struct("run_id", "series", F.when(F.pmod("run_id", F.lit(3)) == 0, "W").otherwise("M").alias("gender"))).alias("rounds"))
    people = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("athlete"), F.col("c_mktsegment").alias("group"), "c_name")
    return each.join(people, "athlete").withColumn("event_id", F.concat_ws("-", "athlete", "season"))


def event_list(spark, sf_dir):
    """Events of one season and group with a women's round, whose name holds a text without regard to case and blanks: newest first, then by id
    from behind (no date comes last)."""
    wanted = F.lower(F.regexp_replace(F.lit("Customer #0000 00"), r"\s", ""))
    rows = _events(spark, sf_dir).filter((F.col("season") == "1996-97") & F.col("group").isin("BUILDING", "MACHINERY") & F.exists("rounds", lambda r: r["gender"] == "W"))
    rows = rows.filter(F.contains(F.lower(F.regexp_replace("c_name", r"\s", "")), wanted))
    date = F.coalesce(F.col("date_from").cast("string"), F.lit(""))
    place = F.row_number().over(Window.partitionBy("season").orderBy(F.desc(date), F.desc("event_id")))
    return rows.select("event_id", date.alias("date_from"), F.size("rounds").cast("long").alias("n_rounds"), place.cast("long").alias("place"))


def filter_choices(spark, sf_dir):
    """What the filters offer: seasons from the newest, series in order, groups in their fixed order, each with its number of events."""
    rows = _events(spark, sf_dir).select("event_id", "season", "group", F.array_distinct(F.transform("rounds", lambda r: r["series"])).alias("series"))
    group = F.array_position(F.array(*map(F.lit, GROUPS)), F.col("value")).cast("int")
    seasons = rows.groupBy(F.col("season").alias("value")).agg(F.count("*").alias("n")).select(F.lit("season").alias("kind"), "value", "n", (-F.substring("value", 1, 4).cast("int")).alias("o"))
    series = rows.select(F.explode("series").alias("value")).groupBy("value").agg(F.count("*").alias("n")).select(F.lit("series").alias("kind"), "value", "n", F.substring("value", 1, 1).cast("int").alias("o"))
    groups = rows.groupBy(F.col("group").alias("value")).agg(F.count("*").alias("n")).select(F.lit("group").alias("kind"), "value", "n", F.when(group > 0, group).otherwise(99).alias("o"))
    every = seasons.unionByName(series).unionByName(groups)
    return every.select("kind", "value", "n", F.row_number().over(Window.partitionBy("kind").orderBy("o", "value")).cast("long").alias("place"))


def athlete_history(spark, sf_dir):
    """An athlete's finished runs, newest first: the best of each series' season counts, the second best is the other run of a best-of-two, the rest is not shown.
    With the place in the list of counting runs, in the list of all, and the round's size."""
    rows = runs(spark, sf_dir).filter("status = 'OK'")
    sizes = rows.groupBy("season", "series").agg(F.count_distinct("athlete").alias("round_size"))
    block = F.row_number().over(Window.partitionBy("athlete", "season", "series").orderBy(F.desc("score_k"), "date", "run_id"))
    shown = rows.withColumn("k", block).filter("k <= 2").join(F.broadcast(sizes), ["season", "series"])
    event = F.concat_ws("-", "athlete", "season")
    order = [F.desc_nulls_last("date"), F.desc(event), F.asc("series"), F.desc("run_id")]
    every = F.row_number().over(Window.partitionBy("athlete").orderBy(*order))
    counting = F.sum((F.col("k") == 1).cast("long")).over(Window.partitionBy("athlete").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0))
    return shown.select("athlete", "run_id", "season", "series", (F.col("k") == 1).alias("counting"), every.cast("long").alias("place"), F.when(F.col("k") == 1, counting).alias("place_counting"), "round_size")


def search_results(spark, sf_dir):
    """Athletes found by a text (name without regard to case and blanks, or the whole number), by name, at most 200; an empty text finds the members: those with twenty
    runs or more. The cap is the feature."""
    counts = runs(spark, sf_dir).groupBy("athlete").agg(F.count("*").alias("n"))
    people = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("athlete"), "c_name").join(counts, "athlete", "left")
    asked = spark.createDataFrame([(q,) for q in QUERIES], "asked string").withColumn("plain", F.lower(F.regexp_replace("asked", r"\s", "")))
    hit = F.when(F.col("plain") == "", F.coalesce("n", F.lit(0)) >= 20).otherwise(F.contains(F.lower("c_name"), F.col("plain")) | (F.col("athlete").cast("string") == F.col("plain")))
    found = people.join(F.broadcast(asked), hit)
    place = F.row_number().over(Window.partitionBy("asked").orderBy("c_name", "athlete"))
    return found.withColumn("place", place.cast("long")).filter(F.col("place") <= MOST).select("asked", "place", "athlete")


def verification_states(spark, sf_dir):
    """Rounds by what their layers say: scores (lines without a price), ranks (two finished runs of one score), sources (runs without lines), each ok, error or not done; the
    state is ng with an error, gap where a layer is not done, else ok; and the label of the cut at sixteen (ties included)."""
    rows = runs(spark, sf_dir)
    lines = table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(F.count("*").alias("n_lines"), F.min("l_discount").alias("least"))
    both = rows.join(lines, F.col("run_id") == F.col("l_orderkey"), "left")
    by = ["season", "series"]
    each = both.groupBy(*by).agg(F.count("*").alias("n"), F.count_if(F.col("n_lines").isNull()).alias("n_bare"), F.count_if(F.col("least") > 0.09).alias("n_dear"), F.count_if(F.col("status") != "OK").alias("n_open"))
    top = rows.filter("status = 'OK'").groupBy(*by, "score_k").agg(F.count("*").alias("same"))
    reached = F.sum("same").over(Window.partitionBy(*by).orderBy(F.desc("score_k")).rowsBetween(Window.unboundedPreceding, -1))
    cut = top.withColumn("before", F.coalesce(reached, F.lit(0))).filter("before < 16").groupBy(*by).agg(F.sum("same").alias("n_cut"), F.max("same").alias("most_tied"), F.min("score_k").alias("cut_score"))
    sources = F.when(F.col("n_bare") * 6 > F.col("n"), "error").otherwise("ok")
    scores = F.when(F.col("n_open") * 30 > F.col("n"), "none").when(F.col("n_dear") * 12 > F.col("n"), "error").otherwise("ok")
    ranks = F.when(F.col("most_tied") > 6, "error").otherwise("ok")
    out = each.join(cut, by, "left").select(*by, F.concat_ws(" ", sources, scores, ranks).alias("layers"), "n_cut", "cut_score")
    state = F.when(F.contains("layers", F.lit("error")), "ng").when(F.contains("layers", F.lit("none")), "gap").otherwise("ok")
    label = F.when(F.col("n_cut") > 16, F.format_string("top 16 (%d with ties) at %d", "n_cut", "cut_score")).when(F.col("n_cut") == 16, F.format_string("top 16 at %d", "cut_score")).otherwise("all")
    return out.select(*by, "layers", state.alias("state"), label.alias("cut_label"))


def upstream_sync(spark, sf_dir):
    """Sources with one row for each different document: the ids of the rounds that share it, the first known language, and the status of the check beyond: taken over
    only where it is ok or missing there; whether the code is new here (no labelled document of the source has it)."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", F.when(F.pmod("doc_id", F.lit(4)) > 0, F.col("lang")).alias("lang"), F.sha2("text", 256).alias("sha"))
    labels = table(spark, sf_dir, "labels").select("doc_id", "quality")
    both = docs.join(labels, "doc_id", "left")
    ids = F.array_join(F.transform(F.array_sort(F.collect_list("doc_id")), lambda i: i.cast("string")), ",")
    each = both.groupBy("source", "sha").agg(ids.alias("rounds"), F.min_by("lang", F.when(F.col("lang").isNotNull(), F.col("doc_id"))).alias("lang"), F.min("quality").alias("least"), F.max("quality").alias("most"))
    known = docs.join(labels.filter("quality = 1"), "doc_id").select(F.col("source").alias("of"), F.col("lang").alias("code")).filter("code IS NOT NULL").distinct()
    both = each.join(known, (F.col("source") == F.col("of")) & (F.col("lang") == F.col("code")), "left")
    status = F.when(F.col("least").isNull(), "missing").when(F.col("least") == 1, "ok")
    return both.select("source", "sha", "rounds", "lang", status.alias("status"), (F.col("lang").isNotNull() & F.col("code").isNull()).alias("new_code"))


LIST = (run_records, jump_rows, run_summaries, round_rows, event_list, filter_choices, athlete_history, search_results, verification_states, upstream_sync)
_RUNS = """runs AS (SELECT o_orderkey AS run_id, o_custkey AS athlete, o_orderdate::DATE AS date, printf('%d-%02d', y, (y + 1) % 100) AS season, o_orderpriority AS series,
 CASE WHEN o_orderstatus = 'P' THEN 'DNF' ELSE 'OK' END AS status, floor(o_totalprice / 1000)::BIGINT AS score_k FROM (SELECT *, year(o_orderdate) - CASE WHEN month(o_orderdate) < 7 THEN 1 ELSE 0 END AS y FROM orders))"""
_NORMAL = """x AS (SELECT vec_id, label, list_transform(embedding, lambda v: trunc(CAST(v AS DOUBLE) * 100)::BIGINT) AS x FROM embeddings WHERE len(embedding) >= 20),
 y AS (SELECT *, x[19] > 15 AND x[20] > 0 AS e, CASE WHEN x[18] > 12 THEN 'DNF' ELSE 'OK' END AS status, CASE WHEN x[17] > 8 THEN 'detail' WHEN x[17] > -12 THEN 'score' ELSE 'rank' END AS tier FROM x),
 n AS (SELECT vec_id, label, status, tier, e, CASE WHEN e THEN [NULL, NULL, NULL, NULL, NULL]::BIGINT[] ELSE list_transform(x[1:5], lambda v: abs(v)) END AS base, x[6] > 20 AS ded_missing, CASE WHEN x[6] > 20 THEN [0, 0, 0, 0, 0]::BIGINT[] ELSE list_transform(x[6:10], lambda v: -abs(v)) END AS ded,
  list_filter([CASE WHEN NOT e AND x[13] > -10 THEN {'j6': abs(x[11]), 'j7': abs(x[12]), 'jump': ['bT', 'bG', 'bL', 'TT'][((x[13] % 4) + 4) % 4 + 1], 'dd': abs(x[13]) + 50} END, CASE WHEN NOT e AND x[16] > -10 THEN {'j6': abs(x[14]), 'j7': abs(x[15]), 'jump': ['bT', 'bG', 'bL', 'TT'][((x[16] % 4) + 4) % 4 + 1], 'dd': abs(x[16]) + 50} END], lambda a: a IS NOT NULL) AS air,
  CASE WHEN NOT e THEN abs(x[17]) + 2000 END AS seconds FROM y)"""
_EV = f"""{_RUNS}, ev AS (SELECT athlete, season, athlete || '-' || season AS event_id, min(date) FILTER (WHERE status = 'OK') AS date_from, count(*) AS n_rounds, list(DISTINCT series) AS series, bool_or(run_id % 3 = 0) AS women, any_value(c_mktsegment) AS grp, any_value(c_name) AS c_name FROM runs JOIN customer ON athlete = c_custkey GROUP BY 1, 2)"""
SQL = {
    "run_records": f"""WITH {_NORMAL} SELECT vec_id, status, tier, coalesce(array_to_string(base, ','), '') AS base, array_to_string(ded, ',') AS ded, ded_missing, array_to_string(list_transform(air, lambda a: a.j6 || '/' || a.j7 || '/' || a.jump || '/' || a.dd), ' ') AS air, len(air) AS n_jumps, seconds, status = 'OK' AND e AS empty,
 len(list_filter(base, lambda v: v > 40)) + CASE WHEN e THEN 1 ELSE 0 END AS n_wrong FROM n""",
    "jump_rows": f"""WITH {_NORMAL}, p AS (SELECT vec_id, unnest(range(len(air))) AS place, unnest(air) AS a FROM n WHERE tier = 'detail' AND status = 'OK') SELECT vec_id, place, a.jump AS jump, a.dd AS dd, a.j6 + a.j7 AS execution FROM p""",
    "run_summaries": f"""WITH {_NORMAL}, s AS (SELECT label, tier, status || '|' || array_to_string(list_transform(air, lambda a: a.jump || a.dd), '+') || '|' || coalesce(list_max(base)::VARCHAR, '-') AS summary FROM n),
 g AS (SELECT label, summary, count(*) AS n FROM s GROUP BY 1, 2), m AS (SELECT label, summary FROM g QUALIFY row_number() OVER (PARTITION BY label ORDER BY n DESC, summary) = 1)
 SELECT s.label, count(*) AS n_runs, count(DISTINCT s.summary) AS n_summaries, count(*) FILTER (WHERE tier = 'detail') AS n_detail, count(*) FILTER (WHERE tier = 'score') AS n_score, count(*) FILTER (WHERE tier = 'rank') AS n_rank, any_value(m.summary) AS most_frequent FROM s JOIN m ON s.label IS NOT DISTINCT FROM m.label GROUP BY 1""",
    "round_rows": f"""WITH {_RUNS}, v AS (SELECT season, series, n_name, count(*) AS n FROM runs JOIN customer ON athlete = c_custkey JOIN nation ON c_nationkey = n_nationkey GROUP BY 1, 2, 3 QUALIFY row_number() OVER (PARTITION BY season, series ORDER BY count(*) DESC, n_name) = 1),
 j AS (SELECT season, series, l_suppkey, count(*) AS n, row_number() OVER (PARTITION BY season, series ORDER BY count(*) DESC, l_suppkey) AS k FROM runs JOIN lineitem ON run_id = l_orderkey GROUP BY 1, 2, 3),
 t AS (SELECT season, series, string_agg('judge-' || regexp_replace(regexp_replace(lower(s_name), '[^a-z0-9]+', '-', 'g'), '^-|-$', '', 'g'), ' ' ORDER BY k) AS judges FROM j JOIN supplier ON l_suppkey = s_suppkey WHERE k <= 5 GROUP BY 1, 2)
 SELECT season, series, n_name AS venue, CASE series WHEN '1-URGENT' THEN 'Urgent' WHEN '2-HIGH' THEN 'High' ELSE 'Round' END AS round_text, any_value(judges) AS judges, count(*) FILTER (WHERE score_k > 250) AS n_detail, count(*) FILTER (WHERE score_k BETWEEN 101 AND 250) AS n_score, count(*) FILTER (WHERE score_k <= 100) AS n_rank
 FROM runs JOIN v USING (season, series) JOIN t USING (season, series) GROUP BY 1, 2, 3""",
    "event_list": f"""WITH {_EV} SELECT event_id, coalesce(date_from::VARCHAR, '') AS date_from, n_rounds, row_number() OVER (ORDER BY coalesce(date_from::VARCHAR, '') DESC, event_id DESC) AS place FROM ev WHERE season = '1996-97' AND grp IN ('BUILDING', 'MACHINERY') AND women AND c_name ILIKE '%customer#000000%'""",
    "filter_choices": f"""WITH {_EV}, c AS (SELECT 'season' AS kind, season AS value, count(*) AS n, -season[1:4]::INT AS o FROM ev GROUP BY season UNION ALL SELECT 'series', s, count(*), s[1]::INT FROM (SELECT unnest(series) AS s FROM ev) GROUP BY s
 UNION ALL SELECT 'group', grp, count(*), coalesce(list_position(['BUILDING', 'AUTOMOBILE', 'MACHINERY', 'HOUSEHOLD', 'FURNITURE'], grp), 99) FROM ev GROUP BY grp) SELECT kind, value, n, row_number() OVER (PARTITION BY kind ORDER BY o, value) AS place FROM c""",
    "athlete_history": f"""WITH {_RUNS}, k AS (SELECT *, row_number() OVER (PARTITION BY athlete, season, series ORDER BY score_k DESC, date, run_id) AS k FROM runs WHERE status = 'OK'), z AS (SELECT season, series, count(DISTINCT athlete) AS round_size FROM runs WHERE status = 'OK' GROUP BY 1, 2),
 s AS (SELECT k.*, round_size FROM k JOIN z USING (season, series) WHERE k <= 2)
 SELECT athlete, run_id, season, series, k = 1 AS counting, row_number() OVER h AS place, CASE WHEN k = 1 THEN (count(*) FILTER (WHERE k = 1) OVER h) END AS place_counting, round_size FROM s WINDOW h AS (PARTITION BY athlete ORDER BY date DESC, athlete || '-' || season DESC, series, run_id DESC ROWS UNBOUNDED PRECEDING)""",
    "search_results": f"""WITH {_RUNS}, q AS (SELECT asked, lower(replace(asked, ' ', '')) AS plain FROM (VALUES {", ".join(f"('{q}')" for q in QUERIES)}) t(asked)), p AS (SELECT c_custkey AS athlete, c_name, count(run_id) AS n FROM customer LEFT JOIN runs ON c_custkey = athlete GROUP BY 1, 2)
 SELECT asked, row_number() OVER (PARTITION BY asked ORDER BY c_name, athlete) AS place, athlete FROM p JOIN q ON CASE WHEN plain = '' THEN n >= 20 ELSE contains(lower(c_name), plain) OR athlete::VARCHAR = plain END QUALIFY place <= {MOST}""",
    "verification_states": f"""WITH {_RUNS}, l AS (SELECT l_orderkey, min(l_discount) AS least FROM lineitem GROUP BY 1),
 e AS (SELECT season, series, count(*) AS n, count(*) FILTER (WHERE l_orderkey IS NULL) AS bare, count(*) FILTER (WHERE least > 0.09) AS dear, count(*) FILTER (WHERE status <> 'OK') AS open FROM runs LEFT JOIN l ON run_id = l_orderkey GROUP BY 1, 2),
 t AS (SELECT season, series, score_k, rank() OVER (PARTITION BY season, series ORDER BY score_k DESC) AS r, count(*) OVER (PARTITION BY season, series, score_k) AS same FROM runs WHERE status = 'OK'),
 c AS (SELECT season, series, count(*) AS n_cut, max(same) AS tied, min(score_k) AS cut FROM t WHERE r <= 16 GROUP BY 1, 2),
 s AS (SELECT season, series, CASE WHEN bare * 6 > n THEN 'error' ELSE 'ok' END || ' ' || CASE WHEN open * 30 > n THEN 'none' WHEN dear * 12 > n THEN 'error' ELSE 'ok' END || ' ' || CASE WHEN tied > 6 THEN 'error' ELSE 'ok' END AS layers, n_cut, cut FROM e LEFT JOIN c USING (season, series))
 SELECT season, series, layers, CASE WHEN contains(layers, 'error') THEN 'ng' WHEN contains(layers, 'none') THEN 'gap' ELSE 'ok' END AS state, CASE WHEN n_cut > 16 THEN format('top 16 ({{}} with ties) at {{}}', n_cut, cut) WHEN n_cut = 16 THEN format('top 16 at {{}}', cut) ELSE 'all' END AS cut_label FROM s""",
    "upstream_sync": """WITH d AS (SELECT doc_id, source, CASE WHEN doc_id % 4 > 0 THEN lang END AS lang, sha256(text) AS sha, quality FROM documents LEFT JOIN labels USING (doc_id)), k AS (SELECT DISTINCT source, lang AS code FROM d WHERE quality = 1 AND lang IS NOT NULL),
 e AS (SELECT source, sha, string_agg(doc_id::VARCHAR, ',' ORDER BY doc_id) AS rounds, arg_min(lang, doc_id) FILTER (WHERE lang IS NOT NULL) AS lang, min(quality) AS least FROM d GROUP BY 1, 2)
 SELECT e.source, sha, rounds, lang, CASE WHEN least IS NULL THEN 'missing' WHEN least = 1 THEN 'ok' END AS status, lang IS NOT NULL AND code IS NULL AS new_code FROM e LEFT JOIN k ON e.source = k.source AND lang = code""",
}
