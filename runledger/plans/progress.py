"""How athletes go on and what they leave behind: who was expected in a final, where a round is cut, histories, profiles, panels and rosters."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from runledger.operators.ranks import competition_rank
from runledger.plans.names import printed_names
from runledger.sources.tables import LADDER, ladder, runs, table


def progression_union(spark, sf_dir):
    """Finals of a day (views stand for Q1, clicks for Q2, sign-ups for the final): their sizes are inferred (those not in Q2 came directly from Q1, the others by Q2); expected are Q1 and Q2 down to
    these ranks, ties with the last included. By day: sizes, and with the first of each kind those expected but missing (warning), present outside the cut (error), present but in neither round
    (warning)."""
    rows = ladder(spark, sf_dir).filter("step <= 3").select("day", "user_id", "step", "score")
    at = lambda k: F.max(F.when(F.col("step") == k, F.col("score")))
    each = rows.groupBy("day", "user_id").agg(at(1).alias("q1"), at(2).alias("q2"), F.max((F.col("step") == 3).cast("long")).alias("final"))
    each = competition_rank(competition_rank(each, ["day"], "q1", "r1"), ["day"], "q2", "r2")
    direct, by_q2 = (F.col("final") == 1) & F.col("q2").isNull(), (F.col("final") == 1) & F.col("q2").isNotNull()
    sizes = each.groupBy("day").agg(F.count_if(direct).alias("n_direct"), F.count_if(by_q2).alias("n_by_q2"))
    each = each.join(sizes, "day").withColumn("expected", F.coalesce(F.col("r1") <= F.col("n_direct"), F.lit(False)) | F.coalesce(F.col("r2") <= F.col("n_by_q2"), F.lit(False)))
    present, known = F.col("final") == 1, F.col("q1").isNotNull() | F.col("q2").isNotNull()
    kind = F.when(F.col("expected") & ~present, "missing").when(present & ~known, "never").when(present & ~F.col("expected"), "outside")
    of = lambda k: (F.count_if(F.col("kind") == k).alias(f"n_{k}"), F.min(F.when(F.col("kind") == k, F.col("user_id"))).alias(f"first_{k}"))
    return each.withColumn("kind", kind).groupBy("day", "n_direct", "n_by_q2").agg(F.count_if(present).alias("n_present"), F.count_if("expected").alias("n_expected"), *of("missing"), *of("outside"), *of("never"))


def cut_rows(spark, sf_dir):
    """Winner and cut line of each round (scores in steps of twenty thousand, so that many tie): of those at the largest rank down to n the one with the greatest key, n by the round's series;
    where no number is known, the last row. With the label of the line."""
    n = F.element_at(F.create_map(*[F.lit(x) for pair in (("1-URGENT", 64), ("2-HIGH", 16), ("3-MEDIUM", 8), ("4-NOT SPECIFIED", 2)) for x in pair]), F.col("series"))
    rows = runs(spark, sf_dir).filter("status = 'OK'").select("run_id", "season", "series", (F.col("score_k") / 20).cast("long").alias("score"))
    ranked = competition_rank(rows, ["season", "series"], "score").withColumn("n", n.cast("long"))
    row = F.struct("rank", "run_id", "score")
    within = F.col("n").isNull() | (F.col("rank") <= F.col("n"))
    each = ranked.groupBy("season", "series", "n").agg(F.min(row).alias("first"), F.max(F.when(within, row)).alias("cut"), F.count_if(within).alias("n_within"))
    label = F.when(F.col("n").isNull(), "last").when(F.col("n_within") == F.col("n"), F.concat(F.lit("top "), F.col("n"))).when(F.col("n_within") > F.col("n"), F.concat(F.lit("top "), F.col("n"), F.lit(" and ties"))).otherwise(F.concat(F.lit("all "), F.col("n_within")))
    return each.select("season", "series", F.col("first.run_id").alias("winner"), F.col("first.score").alias("best"), F.col("cut.run_id").alias("cut"), F.col("cut.rank").alias("cut_rank"), F.col("cut.score").alias("cut_score"), label.alias("label"))


def history_sections(spark, sf_dir):
    """An athlete's history in sections of a season, the newest open: for each series the counting run (the best, marked by a star), then its other runs by score, those without a score last;
    series by the score of their counting run."""
    finished = F.col("status") == "OK"
    item = F.struct((~finished).cast("int").alias("open"), F.when(finished, -F.col("score_k")).alias("below"), F.col("run_id"))
    each = runs(spark, sf_dir).groupBy("athlete", "season", "series").agg(F.array_sort(F.collect_list(item)).alias("items"), F.count_if(finished).alias("n_finished"))
    head = F.col("items")[0]
    text = F.array_join(F.transform("items", lambda x, i: F.concat(x["run_id"].cast("string"), F.when((i == 0) & (x["open"] == 0), "*").otherwise(""))), " ")
    each = each.select("athlete", "season", F.struct(head["open"].alias("open"), head["below"].alias("below"), "series", text.alias("text")).alias("part"), F.size("items").alias("n"), (F.col("n_finished") > 0).cast("long").alias("counts"))
    sections = each.groupBy("athlete", "season").agg(F.sum("n").alias("n_runs"), F.sum("counts").alias("n_counting"), F.array_sort(F.collect_list("part")).alias("parts"))
    newest = F.max("season").over(Window.partitionBy("athlete"))
    return sections.select("athlete", "season", (F.col("season") == newest).alias("is_open"), "n_runs", "n_counting", F.array_join(F.transform("parts", lambda p: p["text"]), ", ").alias("rows"))


def athlete_profile(spark, sf_dir):
    """One row an athlete: names by how often they were printed (of equals by code points), the latest known place (the series of its last open order), counting results, seasons and
    series in order, the best run (of equals the first), and the last run's day."""
    names = printed_names(spark, sf_dir).groupBy("athlete", "form").agg(F.count("*").alias("n"))
    names = names.groupBy("athlete").agg(F.array_sort(F.collect_list(F.struct((-F.col("n")).alias("n"), "form"))).alias("f")).select("athlete", F.array_join(F.transform("f", lambda x: x["form"]), "; ").alias("names"))
    finished = F.col("status") == "OK"
    status = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("run_id"), (F.col("o_orderstatus") == "O").alias("is_open"))
    rows = runs(spark, sf_dir).join(status, "run_id")
    best = F.when(finished, F.struct("score_k", (-F.col("run_id")).alias("id")))
    each = rows.groupBy("athlete").agg(
        F.count_if(finished).alias("n_counting"), F.array_join(F.array_sort(F.collect_set("season")), " ").alias("seasons"), F.array_join(F.array_sort(F.collect_set("series")), " ").alias("series"),
        F.max(best).alias("best"), F.max("date").alias("last_day"), F.max(F.when(F.col("is_open"), F.struct("date", "run_id", "series"))).alias("place"),
    )
    return each.join(names, "athlete", "left").select("athlete", "names", F.col("place.series").alias("place"), "n_counting", "seasons", "series", (-F.col("best.id")).alias("best_run"), F.col("best.score_k").alias("best"), "last_day")


def panel_consistency(spark, sf_dir):
    """Panels (the different suppliers of an order's first three line numbers, in order) of the events and statuses in which they differ: how many there are, how many runs, and the first run whose panel is not
    the commonest (of equals the least)."""
    panels = table(spark, sf_dir, "lineitem").filter("l_linenumber <= 3").groupBy("l_orderkey").agg(F.array_join(F.sort_array(F.collect_set("l_suppkey")).cast("array<string>"), " ").alias("panel"))
    rows = runs(spark, sf_dir).join(panels, F.col("run_id") == F.col("l_orderkey")).select("athlete", "season", "status", "run_id", "panel")
    by = ["athlete", "season", "status"]
    each = rows.groupBy(*by, "panel").agg(F.count("*").alias("n"), F.min("run_id").alias("first"))
    common = each.groupBy(*by).agg(F.count("*").alias("n_panels"), F.sum("n").alias("n_runs"), F.min(F.struct((-F.col("n")).alias("n"), "panel", "first")).alias("common")).filter("n_panels > 1")
    other = each.join(common, by).filter("panel <> common.panel").groupBy(*by).agg(F.min("first").alias("first_other"))
    return common.join(other, by).select(*by, "n_panels", "n_runs", F.col("common.panel").alias("panel"), "first_other")


def roster_numbers(spark, sf_dir):
    """Members of the roster (parts) whose number is never seen (in lines of 49 and more), with those of the same name that are: how many numbers, the least and the greatest; a name is its letters in
    lower case without blanks. One row a name meets the members, never its numbers."""
    key = F.lower(F.replace("p_name", F.lit(" "), F.lit(""))).alias("key")
    roster = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("number"), F.col("p_name").alias("name"), key)
    seen = table(spark, sf_dir, "lineitem").filter("l_quantity >= 49").select(F.col("l_partkey").alias("number")).distinct()
    known = roster.join(seen, "number").groupBy("key").agg(F.count("*").alias("n_others"), F.min("number").alias("least"), F.max("number").alias("greatest"))
    return roster.join(seen, "number", "left_anti").join(known, "key", "left").select("number", "name", F.coalesce("n_others", F.lit(0)).alias("n_others"), "least", "greatest")


LIST = (progression_union, cut_rows, history_sections, athlete_profile, panel_consistency, roster_numbers)
_RUNS = """r AS (SELECT o_orderkey AS run_id, o_custkey AS athlete, CAST(o_orderdate AS DATE) AS date, o_orderstatus AS s, CASE WHEN o_orderstatus = 'P' THEN 'DNF' ELSE 'OK' END AS status, o_orderpriority AS series, floor(o_totalprice / 1000)::BIGINT AS k,
 printf('%d-%02d', y, (y + 1) % 100) AS season FROM (SELECT *, year(o_orderdate) - CASE WHEN month(o_orderdate) < 7 THEN 1 ELSE 0 END AS y FROM orders))"""


def _profile():
    from runledger.plans.names import SQL as NAMES

    forms = NAMES["display_names"].split(" g AS MATERIALIZED")[0].rstrip().rstrip(",")
    return f"""{forms}, {_RUNS}, t AS (SELECT athlete, form, count(*) AS n FROM f GROUP BY 1, 2)
 SELECT r.athlete, (SELECT string_agg(form, '; ' ORDER BY n DESC, form) FROM t WHERE t.athlete = r.athlete) AS names, arg_max(series, (date, run_id)) FILTER (WHERE s = 'O') AS place, count(*) FILTER (WHERE status = 'OK') AS n_counting,
 string_agg(DISTINCT season, ' ' ORDER BY season) AS seasons, string_agg(DISTINCT series, ' ' ORDER BY series) AS series, arg_max(run_id, (k, -run_id)) FILTER (WHERE status = 'OK') AS best_run, max(k) FILTER (WHERE status = 'OK') AS best, max(date) AS last_day FROM r GROUP BY 1"""


SQL = {
    "progression_union": f"""WITH {LADDER}, p AS (SELECT day, user_id, max(score) FILTER (WHERE step = 1) AS q1, max(score) FILTER (WHERE step = 2) AS q2, count(*) FILTER (WHERE step = 3) AS f FROM ladder WHERE step <= 3 GROUP BY 1, 2),
 z AS (SELECT day, count(*) FILTER (WHERE f > 0 AND q2 IS NULL) AS n_direct, count(*) FILTER (WHERE f > 0 AND q2 IS NOT NULL) AS n_by_q2, count(*) FILTER (WHERE f > 0) AS n_present FROM p GROUP BY 1),
 e AS (SELECT day, user_id FROM (SELECT day, user_id, rank() OVER (PARTITION BY day ORDER BY q1 DESC) AS r FROM p WHERE q1 IS NOT NULL) JOIN z USING (day) WHERE r <= n_direct UNION SELECT day, user_id FROM (SELECT day, user_id, rank() OVER (PARTITION BY day ORDER BY q2 DESC) AS r FROM p WHERE q2 IS NOT NULL) JOIN z USING (day) WHERE r <= n_by_q2),
 m AS (SELECT day, user_id, CASE WHEN f = 0 THEN 'missing' END AS kind FROM e JOIN p USING (day, user_id) UNION ALL SELECT day, user_id, CASE WHEN q1 IS NULL AND q2 IS NULL THEN 'never' ELSE 'outside' END FROM p WHERE f > 0 AND (day, user_id) NOT IN (SELECT (day, user_id) FROM e))
 SELECT z.*, (SELECT count(*) FROM e WHERE e.day = z.day) AS n_expected, {", ".join(f"(SELECT count(*) FROM m WHERE m.day = z.day AND kind = '{k}') AS n_{k}, (SELECT min(user_id) FROM m WHERE m.day = z.day AND kind = '{k}') AS first_{k}" for k in ("missing", "outside", "never"))} FROM z""",
    "cut_rows": f"""WITH {_RUNS}, a AS (SELECT *, k // 20 AS score, rank() OVER (PARTITION BY season, series ORDER BY k // 20 DESC) AS rank, CASE series WHEN '1-URGENT' THEN 64 WHEN '2-HIGH' THEN 16 WHEN '3-MEDIUM' THEN 8 WHEN '4-NOT SPECIFIED' THEN 2 END AS n FROM r WHERE status = 'OK'),
 b AS (SELECT *, row_number() OVER (PARTITION BY season, series ORDER BY rank, run_id) AS up, row_number() OVER (PARTITION BY season, series ORDER BY n IS NULL OR rank <= n DESC, rank DESC, run_id DESC) AS down, count(*) FILTER (WHERE n IS NULL OR rank <= n) OVER (PARTITION BY season, series) AS w FROM a)
 SELECT x.season, x.series, x.run_id AS winner, x.score AS best, y.run_id AS cut, y.rank AS cut_rank, y.score AS cut_score, CASE WHEN x.n IS NULL THEN 'last' WHEN x.w = x.n THEN 'top ' || x.n WHEN x.w > x.n THEN 'top ' || x.n || ' and ties' ELSE 'all ' || x.w END AS label
 FROM b x JOIN b y ON x.season = y.season AND x.series = y.series WHERE x.up = 1 AND y.down = 1""",
    "history_sections": f"""WITH {_RUNS}, o AS (SELECT *, row_number() OVER (PARTITION BY athlete, season, series ORDER BY status = 'OK' DESC, k DESC, run_id) AS rn FROM (SELECT athlete, season, series, run_id, status, CASE WHEN status = 'OK' THEN k END AS k FROM r)),
 s AS (SELECT athlete, season, series, count(*) AS n, bool_or(status = 'OK')::INT AS c, max(k) AS top, string_agg(run_id || CASE WHEN rn = 1 AND status = 'OK' THEN '*' ELSE '' END, ' ' ORDER BY rn) AS text FROM o GROUP BY 1, 2, 3)
 SELECT athlete, season, season = max(season) OVER (PARTITION BY athlete) AS is_open, n_runs, n_counting, rows FROM (SELECT athlete, season, sum(n)::BIGINT AS n_runs, sum(c)::BIGINT AS n_counting, string_agg(text, ', ' ORDER BY top DESC NULLS LAST, series) AS rows FROM s GROUP BY 1, 2)""",
    "athlete_profile": _profile(),
    "panel_consistency": f"""WITH {_RUNS}, p AS (SELECT l_orderkey, string_agg(s::VARCHAR, ' ' ORDER BY s) AS panel FROM (SELECT DISTINCT l_orderkey, l_suppkey AS s FROM lineitem WHERE l_linenumber <= 3) GROUP BY 1),
 g AS (SELECT athlete, season, status, panel, count(*) AS n, min(run_id) AS first FROM r JOIN p ON run_id = l_orderkey GROUP BY 1, 2, 3, 4), w AS (SELECT *, row_number() OVER (PARTITION BY athlete, season, status ORDER BY n DESC, panel) AS rn FROM g)
 SELECT athlete, season, status, count(*) AS n_panels, sum(n)::BIGINT AS n_runs, max(panel) FILTER (WHERE rn = 1) AS panel, min(first) FILTER (WHERE rn > 1) AS first_other FROM w GROUP BY 1, 2, 3 HAVING count(*) > 1""",
    "roster_numbers": """WITH s AS (SELECT DISTINCT l_partkey FROM lineitem WHERE l_quantity >= 49), p AS (SELECT p_partkey AS number, p_name AS name, lower(replace(p_name, ' ', '')) AS key, p_partkey IN (FROM s) AS seen FROM part)
 SELECT number, name, n_others, least, greatest FROM (SELECT *, count(*) FILTER (WHERE seen) OVER w AS n_others, min(number) FILTER (WHERE seen) OVER w AS least, max(number) FILTER (WHERE seen) OVER w AS greatest FROM p WINDOW w AS (PARTITION BY key)) WHERE NOT seen""",
}
