"""Rounds: their shape, carried and relisted rows, panels, scores by rule, choices of rows. An event is a day, a round a step of its ladder."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from runledger.functions.exact import close, counting_total, total
from runledger.operators.ranks import competition_rank
from runledger.sources.tables import LADDER, MARKS, ladder, marks, runs, table


def carried_rows(spark, sf_dir):
    """Overall pages by day and step hold the step's own rows and rows carried from the step before (every third user's). A carried row equals the
    athlete's row of the latest earlier step; a page of carried rows alone is dropped."""
    rows = ladder(spark, sf_dir).select("day", "step", "user_id", "score")
    copied = rows.filter("user_id % 3 = 0 AND step < 4").withColumn("step", F.col("step") + 1).join(rows.select("day", "step", "user_id"), ["day", "step", "user_id"], "left_anti")
    page = rows.unionByName(copied)
    earlier = rows.select("day", "user_id", F.col("step").alias("at"), F.col("score").alias("was"))
    before = page.join(earlier, ["day", "user_id"]).filter("at < step").groupBy("day", "step", "user_id", "score").agg(F.max_by("was", "at").alias("was"))
    carried = before.filter("score = was").select("day", "step", "user_id", F.lit(True).alias("carried"))
    out = page.join(carried, ["day", "step", "user_id"], "left").groupBy("day", "step").agg(F.count("*").alias("n_rows"), F.count("carried").alias("n_carried"))
    return out.withColumn("dropped", F.col("n_rows") == F.col("n_carried"))


def relisted_tables(spark, sf_dir):
    """Tables (a day's users of one event type, three at least) whose rows another, larger table of the day holds as well."""
    rows = table(spark, sf_dir, "events").select(F.to_date("ts").alias("day"), "event_type", F.expr("user_id div 4").alias("who")).distinct()
    size = rows.groupBy("day", "event_type").agg(F.count("*").alias("n"))
    a, b = (rows.select("day", "who", F.col("event_type").alias(x)) for x in ("small", "big"))
    both = a.join(b, ["day", "who"]).filter("small <> big").groupBy("day", "small", "big").agg(F.count("*").alias("n_common"))
    of = lambda x: size.select("day", F.col("event_type").alias(x), F.col("n").alias(f"n_{x}"))
    return both.join(of("small"), ["day", "small"]).join(of("big"), ["day", "big"]).filter("n_common = n_small AND n_small >= 3 AND n_small < n_big").drop("n_common")


def panel_size(spark, sf_dir):
    """Judges who really marked, by section (label): trailing columns that are null throughout are dropped, those zero throughout down to three."""
    k = F.col("label")
    m = F.transform("m", lambda x, i: F.when((k % 3 == 0) & (i == 4), None).when((k % 3 == 1) & (i >= 3), F.lit(0).cast("long")).otherwise(x))
    rows = marks(spark, sf_dir).join(table(spark, sf_dir, "embeddings").select("vec_id", "label"), "vec_id").select(k, m.alias("m"))
    flags = rows.groupBy("label").agg(
        F.array(*(F.bool_and(F.col("m")[i].isNull()) for i in range(5))).alias("none"), F.array(*(F.bool_and(F.coalesce(F.col("m")[i] == 0, F.lit(False))) for i in range(5))).alias("zero")
    )
    start = F.struct(F.lit(5).alias("keep"), F.lit(True).alias("going"))
    step = lambda a, i: F.struct(
        (a["keep"] - (a["going"] & (F.element_at("none", i) & (i > 1) | F.element_at("zero", i) & (i > 3))).cast("int")).alias("keep"),
        (a["going"] & (F.element_at("none", i) & (i > 1) | F.element_at("zero", i) & (i > 3))).alias("going"),
    )
    return flags.select("label", F.aggregate(F.array(*(F.lit(i) for i in (5, 4, 3, 2, 1))), start, step)["keep"].cast("long").alias("n_judges"))


def block_boundary(spark, sf_dir):
    """Each athlete's first place in order of dates whose score is above the one before, and the blocks that such places begin."""
    w = Window.partitionBy("athlete").orderBy("date", "run_id")
    rows = runs(spark, sf_dir).filter("status = 'OK'").select("athlete", F.row_number().over(w).cast("long").alias("place"), (F.col("score_k") > F.lag("score_k").over(w)).alias("up"))
    return rows.groupBy("athlete").agg(F.min(F.when(F.col("up"), F.col("place"))).alias("boundary"), (F.count_if("up") + 1).alias("n_blocks"), F.count("*").alias("n"))


def best_block_per_athlete(spark, sf_dir):
    """The best run of each user, day and type (of equal ones the first), whether the user only ever viewed, and the first run's event."""
    rows = table(spark, sf_dir, "events").filter("event_type <> 'error'").select("user_id", F.to_date("ts").alias("day"), "event_type", "ts", "event_id", F.round(F.col("value") * 100).cast("long").alias("score"))
    each = rows.groupBy("user_id", "day", "event_type").agg(
        F.max("score").alias("best"), F.min_by("event_id", F.struct(-F.col("score"), F.col("ts"), F.col("event_id"))).alias("best_event"), F.min_by("event_id", F.struct("ts", "event_id")).alias("first_event")
    )
    return each.withColumn("direct", F.bool_and(F.col("event_type") == "view").over(Window.partitionBy("user_id", "day")))


def partial_round_gap(spark, sf_dir):
    """By day and step: who is there, who of them misses the step below, who of those below goes on, and whether the steps shrink strictly."""
    rows = ladder(spark, sf_dir).select("day", "user_id", "step")
    below = rows.select("day", "user_id", (F.col("step") + 1).alias("step"), F.lit(True).alias("below"))
    n = rows.join(below, ["day", "user_id", "step"], "left").groupBy("day", "step").agg(F.count("*").alias("n"), F.count_if(F.col("below").isNull() & (F.col("step") > 1)).alias("n_missing_below"), F.count("below").alias("n_advanced"))
    w = Window.partitionBy("day").orderBy("step")
    return n.withColumn("shrinks", F.coalesce(F.col("n") < F.lag("n").over(w), F.lit(True)))


def pair_reshape(spark, sf_dir):
    """Clicks and signups of a user and day as runs Q1 and Q2: with exactly one of each, in this order, one pair; else codes by the k-th run."""
    rows = table(spark, sf_dir, "events").filter("event_type IN ('click', 'signup')").select("user_id", F.to_date("ts").alias("day"), "ts", "event_id", F.when(F.col("event_type") == "click", "Q1").otherwise("Q2").alias("label"), F.round(F.col("value") * 100).cast("long").alias("score"))
    each = rows.groupBy("user_id", "day").agg(F.array_sort(F.collect_list(F.struct("ts", "event_id", "label", "score"))).alias("r"))
    paired = F.array_join("r.label", ",") == "Q1,Q2"
    codes = F.transform("r", lambda x, i: F.concat(F.coalesce(F.try_element_at(F.array(F.lit("F1"), F.lit("F2"), F.lit("F3")), i + 1), F.lit("F3+")), F.lit(":"), x["label"]))
    return each.select("user_id", "day", paired.alias("paired"), F.when(paired, F.col("r")[0]["score"]).alias("q1"), F.when(paired, F.col("r")[1]["score"]).alias("q2"), F.when(~paired, F.array_join(codes, " ")).alias("codes"))


def nonstarters_guard(spark, sf_dir):
    """By day: users with errors alone did not start; they are dropped only where the starters are as many as printed (every second day one more)."""
    users = table(spark, sf_dir, "events").select(F.to_date("ts").alias("day"), "user_id", (F.col("event_type") != "error").alias("ran")).groupBy("day", "user_id").agg(F.bool_or("ran").alias("ran"))
    days = users.groupBy("day").agg(F.count_if("ran").alias("n_starters"), F.count_if(~F.col("ran")).alias("n_dns"))
    said = table(spark, sf_dir, "events").filter("event_type <> 'error'").select(F.to_date("ts").alias("day"), "user_id").distinct().groupBy("day").agg((F.count("*") + F.dayofmonth("day") % 2).alias("printed"))
    both = days.join(said, "day", "left")
    fits = F.coalesce(F.col("printed") == F.col("n_starters"), F.lit(False))
    return both.select("day", "n_starters", "n_dns", F.when(fits, F.col("n_starters")).otherwise(F.col("n_starters") + F.col("n_dns")).alias("n_kept"))


def continuity(spark, sf_dir):
    """By season and series: printed ranks (without every 41st run) that leave a gap, and whether finishers come before the others by date."""
    done = runs(spark, sf_dir).filter("status = 'OK'")
    printed = competition_rank(done, ["season", "series"], "score_k").filter("run_id % 41 <> 0")
    groups = printed.groupBy("season", "series", "rank").agg(F.count("*").alias("n"))
    before = F.coalesce(F.sum("n").over(Window.partitionBy("season", "series").orderBy("rank").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    gaps = groups.withColumn("due", before + 1).groupBy("season", "series").agg(F.count_if(F.col("rank") != F.col("due")).alias("n_gaps"), F.sum("n").alias("n_printed"))
    ends = runs(spark, sf_dir).groupBy("season", "series").agg(F.max(F.when(F.col("status") == "OK", F.col("date"))).alias("last"), F.min(F.when(F.col("status") != "OK", F.col("date"))).alias("first"))
    return gaps.join(ends, ["season", "series"]).select("season", "series", "n_gaps", "n_printed", F.coalesce(F.col("last") < F.col("first"), F.lit(True)).alias("finishers_first"))


def golden_selection(spark, sf_dir):
    """Rows of each athlete's list worth checking by hand, with all reasons: first finished, last, page border (every fourth), not finished, tied."""
    w = Window.partitionBy("athlete").orderBy("date", "run_id")
    own = Window.partitionBy("athlete")
    place, first = F.row_number().over(w), F.min(F.when(F.col("status") == "OK", F.struct("date", "run_id"))).over(own)["run_id"]
    rows = runs(spark, sf_dir).select("*", place.alias("place"), F.count("*").over(own).alias("n"), first.alias("first"), F.count("*").over(Window.partitionBy("athlete", "score_k")).alias("equal"))
    why = F.array(
        F.when(F.col("run_id") == F.col("first"), "first"), F.when(F.col("place") == F.col("n"), "last"), F.when((F.col("place") % 4 == 0) | ((F.col("place") % 4 == 1) & (F.col("place") > 1)), "border"),
        F.when(F.col("status") != "OK", "not finished"), F.when(F.col("equal") > 1, "tied"),
    )
    return rows.select("run_id", "athlete", F.array_join(F.array_compact(why), ", ").alias("reasons")).filter("reasons <> ''")


def ruled(spark, sf_dir):
    """Marks with the rule of their version (label): rules are rows of a joined table, never branches of code."""
    rules = table(spark, sf_dir, "embeddings").filter("label IS NOT NULL").groupBy("label").agg(F.count("*").alias("n")).select(
        "label", (F.col("label") % 2 == 0).alias("trim"), F.when(F.col("label") % 3 == 0, -20).otherwise(10).cast("long").alias("floor"), (15 + F.col("label") % 4 * 5).cast("long").alias("cap"), (F.col("label") % 5 + 1).cast("long").alias("dd"),
        F.when(F.col("label") % 4 == 0, "score").otherwise("detail").alias("tier"), F.when(F.col("label") % 7 == 0, None).otherwise(F.col("label") % 7).cast("long").alias("own_n"),
    )
    rows = marks(spark, sf_dir).join(table(spark, sf_dir, "embeddings").select("vec_id", "label"), "vec_id")
    return rows.join(F.broadcast(rules), "label")


def _scored(df):
    """turns: counting total, lifted to the floor; air: each mark times difficulty (sevenths of ten), cut toward zero and held under the cap, then the
    mean of the two, cut again."""
    raw = counting_total(F.col("m"), F.col("trim"))
    jump = lambda x: F.least(F.col("cap"), (x * F.col("dd") * 10 / F.lit(7)).cast("long"))
    sum_ = total(F.transform("air", jump))
    return df.select(
        "vec_id", "label", "tier", "own_n", raw.alias("raw"), F.greatest(raw, F.col("floor")).alias("turns"), (raw < F.col("floor")).alias("floored"), (sum_ / 2).cast("long").alias("air")
    ).withColumn("total", F.col("turns") + F.col("air"))


def round_context(spark, sf_dir):
    """Runs scored by their version's rule, with the id's suffix, the places that go on (own number, else the shared one of 4) and the layers of
    checks that apply to their tier."""
    rows = _scored(ruled(spark, sf_dir))
    layers = F.when(F.col("tier") == "detail", "L0,L1,L2,L3").otherwise("L0,L1,L3")
    suffix = F.when(F.col("vec_id") % 3 == 0, "-R2").when(F.col("vec_id") % 3 == 1, "-R1").otherwise("-Q1ref")
    return rows.select("vec_id", F.concat(F.col("vec_id").cast("string"), suffix).alias("run_id"), F.coalesce("own_n", F.lit(4).cast("long")).alias("goes_on"), "turns", "floored", "air", "total", layers.alias("layers"))


def independent_identities(spark, sf_dir):
    """Published totals (every 89th is one too high, every 83rd missing) against a second way of counting: sorted marks without their ends; by label
    the checks made and failed, and whether every row was checked."""
    own = ruled(spark, sf_dir)
    published = _scored(own).filter("vec_id % 83 <> 0").select("vec_id", (F.col("turns") + F.when(F.col("vec_id") % 89 == 0, 1).otherwise(0)).alias("published"))
    middle = F.when(F.col("trim") & (F.size("m") >= 5), F.slice(F.array_sort("m"), 2, F.size("m") - 2)).otherwise(F.col("m"))
    again = own.select("label", "vec_id", F.greatest("floor", F.aggregate(middle, F.lit(0).cast("long"), lambda a, x: a + x)).alias("again"))
    both = again.join(published, "vec_id", "left")
    out = both.groupBy("label").agg(F.count("published").alias("n_checks"), F.count_if(F.col("published").isNotNull() & ~close(F.col("published"), F.col("again"), 0, False)).alias("n_bad"), F.count("*").alias("n_rows"))
    return out.withColumn("enough", F.col("n_checks") >= F.col("n_rows"))


def dd_lookup_lowered(spark, sf_dir):
    """Jumps (an order's parts) whose difficulty (size) is lowered by a jump of the same category (type) with the other grab state (name's colour)."""
    part = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("l_partkey"), F.col("p_type").alias("category"), F.col("p_name").startswith("red").alias("grab"), F.col("p_size").cast("long").alias("dd"))
    jumps = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey").distinct().join(part, "l_partkey")
    least = jumps.groupBy("l_orderkey", "category").agg(F.min(F.when(F.col("grab"), F.col("dd"))).alias("with"), F.min(F.when(~F.col("grab"), F.col("dd"))).alias("without"))
    other = F.when(F.col("grab"), F.col("without")).otherwise(F.col("with"))
    return jumps.join(least, ["l_orderkey", "category"]).select("l_orderkey", "l_partkey", "dd", F.least("dd", other).alias("expected")).filter("expected < dd")


LIST = (carried_rows, relisted_tables, panel_size, block_boundary, best_block_per_athlete, partial_round_gap, pair_reshape, nonstarters_guard, continuity, golden_selection, round_context, independent_identities, dd_lookup_lowered)
_RUNS = """runs AS (SELECT o_orderkey AS run_id, o_custkey AS athlete, o_orderdate::DATE AS date, printf('%d-%02d', y, (y + 1) % 100) AS season, o_orderpriority AS series,
 CASE WHEN o_orderstatus = 'P' THEN 'DNF' ELSE 'OK' END AS status, floor(o_totalprice / 1000)::BIGINT AS score_k FROM (SELECT *, year(o_orderdate) - CASE WHEN month(o_orderdate) < 7 THEN 1 ELSE 0 END AS y FROM orders))"""
_RULED = f"""{MARKS}, x AS (SELECT vec_id, e.label, m, air, e.label % 2 = 0 AS trim, CASE WHEN e.label % 3 = 0 THEN -20 ELSE 10 END AS floor, 15 + e.label % 4 * 5 AS cap, e.label % 5 + 1 AS dd,
 CASE WHEN e.label % 4 = 0 THEN 'score' ELSE 'detail' END AS tier, nullif(e.label % 7, 0) AS own_n FROM marks JOIN embeddings e USING (vec_id) WHERE e.label IS NOT NULL),
 y AS (SELECT *, (list_sum(m) - CASE WHEN trim THEN list_max(m) + list_min(m) ELSE 0 END)::BIGINT AS raw, trunc(list_sum(list_transform(air, lambda v: least(cap, trunc(v * dd * 10 / 7)))) / 2)::BIGINT AS a FROM x)"""
SQL = {
    "carried_rows": f"""WITH {LADDER}, p AS (SELECT day, step, user_id, score FROM ladder UNION ALL SELECT day, step + 1, user_id, score FROM ladder l WHERE user_id % 3 = 0 AND step < 4
  AND NOT EXISTS (FROM ladder x WHERE x.day = l.day AND x.user_id = l.user_id AND x.step = l.step + 1)),
 c AS (SELECT *, (SELECT arg_max(x.score, x.step) FROM ladder x WHERE x.day = p.day AND x.user_id = p.user_id AND x.step < p.step) AS was FROM p)
 SELECT day, step, count(*) AS n_rows, count(*) FILTER (WHERE was = score) AS n_carried, count(*) = count(*) FILTER (WHERE was = score) AS dropped FROM c GROUP BY 1, 2""",
    "relisted_tables": """WITH t AS (SELECT ts::DATE AS day, event_type, list(DISTINCT user_id // 4) AS who FROM events GROUP BY 1, 2)
 SELECT a.day, a.event_type AS small, b.event_type AS big, len(a.who) AS n_small, len(b.who) AS n_big FROM t a JOIN t b ON a.day = b.day AND len(a.who) >= 3 AND len(a.who) < len(b.who) AND list_has_all(b.who, a.who)""",
    "panel_size": f"WITH {MARKS} SELECT label, CASE label % 3 WHEN 0 THEN 4 WHEN 1 THEN 3 ELSE 5 END::BIGINT AS n_judges FROM embeddings JOIN marks USING (vec_id) WHERE label IS NOT NULL GROUP BY label",
    "block_boundary": f"""WITH {_RUNS}, o AS (SELECT athlete, row_number() OVER w AS place, score_k > lag(score_k) OVER w AS up FROM runs WHERE status = 'OK' WINDOW w AS (PARTITION BY athlete ORDER BY date, run_id))
 SELECT athlete, min(place) FILTER (WHERE up) AS boundary, count(*) FILTER (WHERE up) + 1 AS n_blocks, count(*) AS n FROM o GROUP BY 1""",
    "best_block_per_athlete": """WITH e AS (SELECT user_id, ts::DATE AS day, event_type, ts, event_id, round(value * 100)::BIGINT AS score FROM events WHERE event_type <> 'error'),
 r AS (SELECT *, row_number() OVER (PARTITION BY user_id, day, event_type ORDER BY score DESC, ts, event_id) AS b, row_number() OVER (PARTITION BY user_id, day, event_type ORDER BY ts, event_id) AS f,
  count(*) FILTER (WHERE event_type <> 'view') OVER (PARTITION BY user_id, day) = 0 AS direct FROM e)
 SELECT user_id, day, event_type, max(score) AS best, max(event_id) FILTER (WHERE b = 1) AS best_event, max(event_id) FILTER (WHERE f = 1) AS first_event, bool_and(direct) AS direct FROM r GROUP BY 1, 2, 3""",
    "partial_round_gap": f"""WITH {LADDER}, n AS (SELECT a.day, a.step, count(*) AS n, count(*) FILTER (WHERE b.step IS NULL AND a.step > 1) AS n_missing_below, count(b.step) AS n_advanced
 FROM ladder a LEFT JOIN ladder b ON a.day = b.day AND a.user_id = b.user_id AND b.step = a.step - 1 GROUP BY 1, 2) SELECT *, coalesce(n < lag(n) OVER (PARTITION BY day ORDER BY step), true) AS shrinks FROM n""",
    "pair_reshape": """WITH e AS (SELECT user_id, ts::DATE AS day, CASE event_type WHEN 'click' THEN 'Q1' ELSE 'Q2' END AS label, round(value * 100)::BIGINT AS score, row_number() OVER (PARTITION BY user_id, ts::DATE ORDER BY ts, event_id) AS k
  FROM events WHERE event_type IN ('click', 'signup')), g AS (SELECT user_id, day, string_agg(label, ',' ORDER BY k) = 'Q1,Q2' AS paired, max(score) FILTER (WHERE k = 1) AS s1, max(score) FILTER (WHERE k = 2) AS s2,
  string_agg(CASE k WHEN 1 THEN 'F1' WHEN 2 THEN 'F2' WHEN 3 THEN 'F3' ELSE 'F3+' END || ':' || label, ' ' ORDER BY k) AS c FROM e GROUP BY 1, 2)
 SELECT user_id, day, paired, CASE WHEN paired THEN s1 END AS q1, CASE WHEN paired THEN s2 END AS q2, CASE WHEN NOT paired THEN c END AS codes FROM g""",
    "nonstarters_guard": """WITH u AS (SELECT ts::DATE AS day, user_id, bool_or(event_type <> 'error') AS ran FROM events GROUP BY 1, 2), d AS (SELECT day, count(*) FILTER (WHERE ran) AS n_starters, count(*) FILTER (WHERE NOT ran) AS n_dns FROM u GROUP BY 1)
 SELECT *, CASE WHEN day(day) % 2 = 0 AND n_starters > 0 THEN n_starters ELSE n_starters + n_dns END AS n_kept FROM d""",
    "continuity": f"""WITH {_RUNS}, k AS (SELECT *, rank() OVER (PARTITION BY season, series ORDER BY score_k DESC) AS rank FROM runs WHERE status = 'OK'), p AS (SELECT *, rank() OVER (PARTITION BY season, series ORDER BY rank) AS due FROM k WHERE run_id % 41 <> 0),
 g AS (SELECT season, series, count(DISTINCT rank) FILTER (WHERE rank <> due) AS n_gaps, count(*) AS n_printed FROM p GROUP BY 1, 2), e AS (SELECT season, series, max(date) FILTER (WHERE status = 'OK') AS a, min(date) FILTER (WHERE status <> 'OK') AS b FROM runs GROUP BY 1, 2)
 SELECT season, series, n_gaps, n_printed, coalesce(a < b, true) AS finishers_first FROM g JOIN e USING (season, series)""",
    "golden_selection": f"""WITH {_RUNS}, o AS (SELECT *, row_number() OVER (PARTITION BY athlete ORDER BY date, run_id) AS place, count(*) OVER (PARTITION BY athlete) AS n, count(*) OVER (PARTITION BY athlete, score_k) AS equal,
 row_number() OVER (PARTITION BY athlete, status ORDER BY date, run_id) = 1 AND status = 'OK' AS first FROM runs)
 SELECT * FROM (SELECT run_id, athlete, concat_ws(', ', CASE WHEN first THEN 'first' END, CASE WHEN place = n THEN 'last' END, CASE WHEN place % 4 = 0 OR place % 4 = 1 AND place > 1 THEN 'border' END, CASE WHEN status <> 'OK' THEN 'not finished' END, CASE WHEN equal > 1 THEN 'tied' END) AS reasons FROM o) WHERE reasons <> ''""",
    "round_context": f"""WITH {_RULED} SELECT vec_id, vec_id || CASE vec_id % 3 WHEN 0 THEN '-R2' WHEN 1 THEN '-R1' ELSE '-Q1ref' END AS run_id, coalesce(own_n, 4)::BIGINT AS goes_on, greatest(raw, floor)::BIGINT AS turns, raw < floor AS floored, a AS air,
 (greatest(raw, floor) + a)::BIGINT AS total, CASE WHEN tier = 'detail' THEN 'L0,L1,L2,L3' ELSE 'L0,L1,L3' END AS layers FROM y""",
    "independent_identities": f"""WITH {_RULED} SELECT label, count(*) FILTER (WHERE vec_id % 83 <> 0) AS n_checks, count(*) FILTER (WHERE vec_id % 83 <> 0 AND vec_id % 89 = 0) AS n_bad, count(*) AS n_rows, count(*) FILTER (WHERE vec_id % 83 = 0) = 0 AS enough FROM y GROUP BY 1""",
    "dd_lookup_lowered": """WITH j AS (SELECT DISTINCT l_orderkey, l_partkey, p_type AS category, p_name LIKE 'red%' AS g, p_size::BIGINT AS dd FROM lineitem JOIN part ON l_partkey = p_partkey),
 e AS (SELECT a.l_orderkey, a.l_partkey, a.dd, least(a.dd, min(b.dd)) AS expected FROM j a JOIN j b ON a.l_orderkey = b.l_orderkey AND a.category = b.category AND a.g <> b.g GROUP BY 1, 2, 3) SELECT * FROM e WHERE expected < dd""",
}
