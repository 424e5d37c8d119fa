"""Sequences across pages, tails and blocks; greedy pairs, largest overlaps, golden rows and ranks with offsets."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from runledger.operators.ranks import competition_rank
from runledger.operators.sequences import anchored_clusters, best_of, greedy_pairs, overlaps
from runledger.sources.tables import parts, runs, table

# Rounds from the last to the first, and the rounds that a section's heading stands for.
LADDER = ["F3", "F2", "F1", "Q"]
HEADINGS = {"view": "Q", "signup": "F", "purchase": "SF"}
BASES = {"Q": ["Q"], "F": ["F1", "Q"], "SF": ["F2", "F1", "Q"]}


def _micros(ts: str):
    """Microseconds of a local time since 1970, whatever the session's time zone."""
    minutes = F.unix_date(F.to_date(ts)).cast("long") * 1440 + F.hour(ts) * 60 + F.minute(ts)
    return minutes * 60_000_000 + (F.expr(f"extract(SECOND FROM {ts})") * 1_000_000).cast("long")


def anchor_lines(spark, sf_dir):
    """A user's events in lines of six hours, each counted from the first event of its line."""
    rows = table(spark, sf_dir, "events").select("user_id", "event_id", _micros("ts").alias("at"))
    return anchored_clusters(rows, ["user_id"], "at", "event_id", 6 * 3600 * 1_000_000)


def greedy_pairing(spark, sf_dir):
    """Views and clicks of a user paired by the six-hour slot of their time, at most two slots apart, in the order of slots."""
    rows = table(spark, sf_dir, "events").filter("event_type IN ('view', 'click')").withColumn("at", _micros("ts")).select("user_id", "event_id", "event_type", F.expr("at div 21600000000").alias("slot"))
    return greedy_pairs(rows, ["user_id"], "slot", "event_id", "event_type", 2)


def carried_tail(spark, sf_dir):
    """A report lists an order's own lines and, behind them, those of the customer's order before it (returned ones with another quantity). By order: how
    many rows the tail has, how many do not equal a row of the order before, how many suppliers are in both, and whether the tail may be removed (a place printed twice in the head forbids it)."""
    own = Window.partitionBy("o_custkey").orderBy("o_orderdate", "o_orderkey")
    every = table(spark, sf_dir, "lineitem")
    n = parts(every)
    orders = table(spark, sf_dir, "orders").repartition(n, "o_custkey").select("o_orderkey", F.lag("o_orderkey").over(own).alias("before")).filter("before IS NOT NULL")
    lines = every.select("l_orderkey", F.col("l_suppkey").alias("bib"), F.col("l_linenumber").alias("place"), F.col("l_quantity").cast("long").alias("score"), "l_returnflag").repartition(n, "l_orderkey")
    head = lines.groupBy("l_orderkey").agg(F.count("*").alias("n_head"), F.collect_list("place").alias("places"), F.collect_set("bib").alias("bibs"))
    printed = F.struct("bib", "place", (F.col("score") + (F.col("l_returnflag") == "R").cast("long")).alias("score"))
    tails = lines.groupBy("l_orderkey").agg(F.collect_list(printed).alias("tail"), F.collect_set(F.struct("bib", "place", "score")).alias("rows"))
    both = orders.repartition(n, "o_orderkey").join(head, F.col("o_orderkey") == F.col("l_orderkey")).drop("l_orderkey").repartition(n, "before").join(tails, F.col("before") == F.col("l_orderkey"))
    n_bad = F.size(F.filter("tail", lambda t: ~F.array_contains(F.col("rows"), t)))
    n_both = F.size(F.array_intersect("bibs", F.array_distinct(F.transform("tail", lambda t: t["bib"]))))
    in_order = F.size(F.array_distinct("places")) == F.col("n_head")
    each = both.select("o_orderkey", "n_head", F.size("tail").cast("long").alias("n_tail"), n_bad.cast("long").alias("n_bad"), n_both.cast("long").alias("n_both"), in_order.alias("in_order"))
    state = F.when(~F.col("in_order"), "ranks").when(F.col("n_bad") > 0, "broken").when(F.col("n_both") > 0, "overlap").otherwise("removed")
    return each.select("o_orderkey", "n_head", "n_tail", "n_bad", "n_both", state.alias("state"), F.when(state == "removed", F.col("n_head")).otherwise(F.col("n_head") + F.col("n_tail")).alias("n_left"))


def page_carry(spark, sf_dir):
    """A customer's orders as pages of one report: a line numbered 1 starts an athlete, returned lines start another of its runs. Runs go on at the top of the next
    page (no further; there from its first run's start alone) and have four lines at most. Runs of several pages, their values and how many were carried. Lines are dealt by
    customer into as many parts as they need; windows stand in the order of their sorts, so three sorts serve five of them."""
    every = table(spark, sf_dir, "lineitem")
    n = parts(every)
    pages = table(spark, sf_dir, "orders").repartition(n, "o_custkey").select("o_custkey", F.col("o_orderkey").alias("l_orderkey"), F.dense_rank().over(Window.partitionBy("o_custkey").orderBy("o_orderdate", "o_orderkey")).alias("page"))
    lines = every.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", F.col("l_quantity").cast("long").alias("q"), (F.col("l_linenumber") == 1).alias("start"), (F.col("l_returnflag") == "R").alias("run"))
    doc = Window.partitionBy("o_custkey").orderBy("page", "l_linenumber", "l_partkey", "l_suppkey", "q")
    so_far = doc.rowsBetween(Window.unboundedPreceding, 0)
    rows = lines.repartition(n, "l_orderkey").join(pages.repartition(n, "l_orderkey"), "l_orderkey").drop("l_orderkey").repartition(n, "o_custkey")
    rows = rows.withColumn("athlete", F.count_if("start").over(so_far)).filter("athlete > 0")
    athlete = Window.partitionBy("o_custkey", "athlete")
    begun = F.count_if("run").over(Window.partitionBy("o_custkey", "athlete", "page").orderBy("l_linenumber", "l_partkey", "l_suppkey", "q").rowsBetween(Window.unboundedPreceding, 0))
    rows = rows.withColumn("begun", begun).withColumn("first_page", F.min("page").over(athlete)).filter("page = first_page OR page = first_page + 1 AND begun > 0")
    own = athlete.orderBy("page", "l_linenumber", "l_partkey", "l_suppkey", "q")
    rows = rows.withColumn("k", F.count_if(F.col("run") & ~F.col("start")).over(own.rowsBetween(Window.unboundedPreceding, 0)))
    place = F.row_number().over(Window.partitionBy("o_custkey", "athlete", "k").orderBy("page", "l_linenumber", "l_partkey", "l_suppkey", "q"))
    blocks = rows.withColumn("place", place).filter("place <= 4").groupBy("o_custkey", "athlete", "k")
    carried = F.col("page") > F.col("first_page")
    each = blocks.agg(F.min("page").alias("page"), F.count("*").alias("n_values"), F.sum("q").alias("total"), F.count_if(carried).alias("n_carried"), F.sum(F.when(carried, F.col("q"))).alias("carried"))
    return each.filter("n_carried > 0")


def golden_regression(spark, sf_dir):
    """Golden rows (finished and open orders) against the output (orders that are not pending; open ones without their dearest line): the row is there, the score
    is equal, and the golden marks are a sub-multiset of the output's marks. A golden row holds its order's shipped lines and, where the customer's order
    before had one line, that line too. One finding a field; rounds without a golden row are `uncovered`."""
    cents = F.round(F.col("o_totalprice") * 100).cast("long")
    every = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("run_id"), "o_custkey", "o_orderdate", F.col("o_orderstatus").alias("status"), cents.alias("cents"))
    lines = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("run_id"), F.col("l_quantity").cast("long").alias("mark"), "l_linestatus", "l_extendedprice")
    dearest = lines.groupBy("run_id").agg(F.max("l_extendedprice").alias("most"), F.count("*").alias("n_lines"), F.max("mark").alias("one"))
    shown = every.filter("status <> 'P'").join(lines, "run_id").join(dearest.select("run_id", "most"), "run_id").filter("status <> 'O' OR l_extendedprice < most")
    out = shown.groupBy("run_id", "mark").agg(F.count("*").alias("n_out"))
    own = Window.partitionBy("o_custkey").orderBy("o_orderdate", "run_id")
    golden = every.withColumn("before", F.lag("run_id").over(own)).withColumn("want", F.col("cents") + F.when(F.lag("status").over(own) == "P", 1).otherwise(0)).filter(F.pmod("cents", F.lit(3)) > 0)
    extra = golden.join(dearest.filter("n_lines = 1").select(F.col("run_id").alias("before"), F.col("one").alias("mark")), "before").select("run_id", "mark")
    wanted = golden.select("run_id").join(lines.filter("l_linestatus = 'F'").select("run_id", "mark"), "run_id").unionByName(extra).groupBy("run_id", "mark").agg(F.count("*").alias("n_golden"))
    short = wanted.join(out, ["run_id", "mark"], "left").filter("n_golden > coalesce(n_out, 0)").groupBy("run_id").agg(F.sum(F.col("n_golden") - F.coalesce("n_out", F.lit(0))).alias("n"))
    there = F.col("status") != "P"
    missing = golden.filter(~there).select("run_id", F.lit("missing").alias("field"), F.lit(1).cast("long").alias("n"))
    score = golden.filter(there & (F.col("want") != F.col("cents"))).select("run_id", F.lit("score").alias("field"), F.lit(1).cast("long").alias("n"))
    air = short.join(golden.filter(there).select("run_id"), "run_id").select("run_id", F.lit("air").alias("field"), "n")
    return missing.unionByName(score).unionByName(air)


def section_codes(spark, sf_dir):
    """Sections (a user's events of one type on a day) to round codes: by the heading's word; `click` is a final, the super final where there is a semi-final (`signup`); a heading
    without a word (`error`) takes the first free code in the order of counts. Codes twice, or counts that do not fall from Q to F to SF, are problems."""
    sections = table(spark, sf_dir, "events").groupBy("user_id", F.to_date("ts").alias("day"), "event_type").agg(F.count("*").alias("n"))
    word = F.create_map(*[F.lit(x) for pair in HEADINGS.items() for x in pair])
    section = F.struct(F.col("n"), "event_type")
    each = sections.groupBy("user_id", "day").agg(F.collect_list(section).alias("s"))
    has = lambda kind: F.exists("s", lambda x: x["event_type"] == kind)
    click = F.when(has("signup"), "SF").otherwise("F")
    named = lambda x: F.coalesce(F.element_at(word, x["event_type"]), F.when(x["event_type"] == "click", click))
    each = each.withColumn("taken", F.array_compact(F.transform("s", named)))
    larger = F.size(F.filter("s", lambda x: (x["event_type"] != "error") & (x["n"] >= F.element_at(F.filter("s", lambda y: y["event_type"] == "error"), 1)["n"])))
    free = F.filter(F.array(*map(F.lit, ("Q", "F", "SF"))), lambda c: ~F.array_contains("taken", c))
    at = F.least(larger, F.size(free) - 1)
    rows = each.select("user_id", "day", F.inline(F.transform("s", lambda x: F.struct(x["event_type"].alias("heading"), x["n"].alias("n"), F.coalesce(named(x), F.when(F.size(free) > 0, F.get(free, at))).alias("code")))))
    own = Window.partitionBy("user_id", "day")
    height = F.when(F.col("code") == "Q", 0).when(F.col("code") == "F", 1).otherwise(2)
    falls = F.lag("n").over(own.orderBy(height, "heading")) > F.col("n")
    problem = F.when(F.col("code").isNull(), "no code").when(F.count("*").over(Window.partitionBy("user_id", "day", "code")) > 1, "twice").when(~F.coalesce(falls, F.lit(True)), "count").otherwise("")
    return rows.select("user_id", "day", "heading", "n", "code", problem.alias("problem"))


def run_codes(spark, sf_dir):
    """The k-th run of an athlete (a user's events of a day, the last first) to a round: by the section of its last event, widened upward where there are more runs than the
    section's rounds; more runs than the ladder has get none."""
    own = Window.partitionBy("user_id", "day")
    rows = table(spark, sf_dir, "events").filter("event_type <> 'error'").select("user_id", F.to_date("ts").alias("day"), "event_id", "ts", "event_type")
    rows = rows.withColumn("k", F.row_number().over(own.orderBy(F.desc("ts"), F.desc("event_id")))).withColumn("n", F.count("*").over(own))
    section = F.first("event_type").over(own.orderBy("k").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    words = HEADINGS | {"click": "F"}
    base = F.create_map(*[x for kind, code in words.items() for x in (F.lit(kind), F.array(*map(F.lit, BASES[code])))])
    ladder = F.array(*map(F.lit, LADDER))
    rows = rows.withColumn("base", F.element_at(base, section))
    codes = F.when(F.col("n") <= F.size("base"), F.col("base")).when(F.col("n") <= len(LADDER), F.slice(ladder, F.lit(len(LADDER) + 1) - F.col("n"), F.col("n")))
    return rows.select("user_id", "day", "event_id", F.col("k").cast("long").alias("k"), F.get(codes, F.col("k") - 1).alias("code"))


def rank_offsets(spark, sf_dir):
    """Printed ranks of two blocks in each round (finished orders first; open ones count on from the least rank printed there) against ranks by score. Tied rows may be printed apart only in the official order
    (price, then earlier day). Some rounds print ties apart officially, some by key, some as ties, and some start the lower block one too late."""
    cents = F.round(F.col("o_totalprice") * 100).cast("long")
    keyed = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("run_id"), cents.alias("cents"))
    rows = runs(spark, sf_dir).filter("status = 'OK'").join(keyed, "run_id").join(table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("run_id"), F.col("o_orderstatus").alias("block")), "run_id")
    by = ["season", "series", "block"]
    rows = rows.select("run_id", *by, "date", "cents", (F.col("score_k") / 4).cast("long").alias("score"))
    ranked = competition_rank(rows, by, "score", "rank")
    ranked = competition_rank(ranked, by, "score", "official", then=[F.desc("cents"), F.asc("date")])
    ranked = competition_rank(ranked, by, "score", "by_key", then=[F.asc("run_id")])
    upper = rows.filter("block = 'F'").groupBy("season", "series").agg(F.count("*").alias("n_upper"))
    style = F.pmod(F.substring("season", 4, 1).cast("int") + F.substring("series", 1, 1).cast("int"), F.lit(4))
    printed = F.when(style == 0, F.col("rank")).when(style == 1, F.col("by_key")).otherwise(F.col("official"))
    late = ((style == 3) & (F.col("block") == "O")).cast("long")
    ranked = ranked.join(F.broadcast(upper), ["season", "series"], "left").withColumn("printed", printed + late + F.when(F.col("block") == "O", F.coalesce("n_upper", F.lit(0))).otherwise(0))
    least = ranked.groupBy(*by).agg(F.min("printed").alias("least"))
    ranked = ranked.join(F.broadcast(least), by).withColumn("offset", F.when(F.col("block") == "O", F.col("least") - 1).otherwise(0))
    tied = ranked.groupBy(*by, "score").agg((F.bool_and(F.col("printed") == F.col("official") + F.col("offset")) & (F.count("*") > 1)).alias("official_split"))
    both = ranked.join(tied, [*by, "score"])
    kind = F.when(F.col("printed") == F.col("rank") + F.col("offset"), "ok").when(F.col("official_split"), "official").otherwise("error")
    return both.groupBy(*by).agg(F.max("offset").alias("rank_offset"), F.count_if(kind == "ok").alias("n_ok"), F.count_if(kind == "official").alias("n_official"), F.count_if(kind == "error").alias("n_error"), F.min(F.when(kind == "error", F.col("run_id"))).alias("first_error"))


def largest_overlap(spark, sf_dir):
    """A customer's page names the suppliers of its lines that were not returned; of its orders, by series, the group that shares most suppliers with the page is compared (of equals the
    first series), the others are skipped."""
    lines = table(spark, sf_dir, "orders").select("o_custkey", "o_orderkey", F.col("o_orderpriority").alias("series")).join(table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("o_orderkey"), "l_suppkey", "l_returnflag", "l_linestatus"), "o_orderkey")
    page = lines.filter("l_returnflag = 'N'").select("o_custkey", "l_suppkey", F.lit("page").alias("page")).distinct()
    groups = lines.filter("l_linestatus = 'F'").select("o_custkey", "series", "l_suppkey").distinct()
    common = overlaps(groups, page, ["o_custkey"], "l_suppkey", "series", "page").drop("page")
    every = groups.groupBy("o_custkey", "series").agg(F.count("*").alias("n_group")).join(common, ["o_custkey", "series"], "left").withColumn("common", F.coalesce("common", F.lit(0)))
    best = best_of(every, ["o_custkey"], F.struct("common", -F.substring("series", 1, 1).cast("int")), ["series"]).withColumnRenamed("series", "chosen")
    both = every.join(best, "o_custkey")
    return both.select("o_custkey", "series", "n_group", "common", F.when(F.col("series") == F.col("chosen"), "compared").otherwise("skipped").alias("state"))


LIST = (anchor_lines, greedy_pairing, carried_tail, page_carry, golden_regression, section_codes, run_codes, rank_offsets, largest_overlap)
_RUNS = """runs AS (SELECT o_orderkey AS run_id, o_custkey AS athlete, o_orderdate::DATE AS date, printf('%d-%02d', y, (y + 1) % 100) AS season, o_orderpriority AS series, o_orderstatus AS block, round(o_totalprice * 100)::BIGINT AS cents,
 CASE WHEN o_orderstatus = 'P' THEN 'DNF' ELSE 'OK' END AS status, floor(o_totalprice / 1000)::BIGINT AS score_k FROM (SELECT *, year(o_orderdate) - CASE WHEN month(o_orderdate) < 7 THEN 1 ELSE 0 END AS y FROM orders))"""
_DOC = "PARTITION BY {} ORDER BY page, l_linenumber, l_partkey, l_suppkey, q ROWS UNBOUNDED PRECEDING"
SQL = {
    "anchor_lines": """WITH RECURSIVE e AS MATERIALIZED (SELECT user_id, event_id, ts, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS i FROM events),
 w AS (SELECT user_id, event_id, i, ts AS first, 1::BIGINT AS cluster FROM e WHERE i = 1
  UNION ALL SELECT e.user_id, e.event_id, e.i, CASE WHEN e.ts - w.first > INTERVAL 6 HOUR THEN e.ts ELSE w.first END, w.cluster + CASE WHEN e.ts - w.first > INTERVAL 6 HOUR THEN 1 ELSE 0 END FROM w JOIN e ON e.user_id = w.user_id AND e.i = w.i + 1)
 SELECT user_id, event_id, cluster FROM w""",
    "greedy_pairing": """WITH RECURSIVE e AS MATERIALIZED (SELECT user_id, event_id, event_type AS side, floor(epoch(ts) / 21600)::BIGINT AS slot, row_number() OVER (PARTITION BY user_id ORDER BY floor(epoch(ts) / 21600), event_id) AS i FROM events WHERE event_type IN ('view', 'click')),
 w AS (SELECT user_id, 0::BIGINT AS i, []::BIGINT[] AS used, NULL::BIGINT AS a, NULL::BIGINT AS b, NULL::BIGINT AS gap FROM (SELECT DISTINCT user_id FROM e)
  UNION ALL SELECT w.user_id, e.i, CASE WHEN list_contains(w.used, e.i) OR m.i IS NULL THEN w.used ELSE list_append(w.used, m.i) END, CASE WHEN list_contains(w.used, e.i) OR m.i IS NULL THEN NULL ELSE e.event_id END,
   CASE WHEN list_contains(w.used, e.i) THEN NULL ELSE m.event_id END, CASE WHEN list_contains(w.used, e.i) THEN NULL ELSE m.slot - e.slot END
  FROM w JOIN e ON e.user_id = w.user_id AND e.i = w.i + 1 LEFT JOIN LATERAL (SELECT o.i, o.event_id, o.slot FROM e o WHERE o.user_id = e.user_id AND o.i > e.i AND o.slot - e.slot <= 2 AND o.side <> e.side AND NOT list_contains(w.used, o.i) ORDER BY o.i LIMIT 1) m ON true)
 SELECT user_id, a, b, gap FROM w WHERE a IS NOT NULL AND b IS NOT NULL""",
    "carried_tail": """WITH o AS (SELECT * FROM (SELECT o_orderkey, lag(o_orderkey) OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS before FROM orders) WHERE before IS NOT NULL),
 l AS MATERIALIZED (SELECT l_orderkey, l_suppkey AS bib, l_linenumber AS place, trunc(l_quantity)::BIGINT AS score, l_returnflag = 'R' AS back FROM lineitem),
 h AS (SELECT l_orderkey, count(*) AS n_head, count(DISTINCT place) = count(*) AS in_order FROM l GROUP BY 1),
 t AS (SELECT o_orderkey, count(*) AS n_tail, count(*) FILTER (WHERE NOT EXISTS (FROM l x WHERE x.l_orderkey = o.before AND x.bib = t.bib AND x.place = t.place AND x.score = t.score + t.back::INT)) AS n_bad,
  count(DISTINCT bib) FILTER (WHERE EXISTS (FROM l x WHERE x.l_orderkey = o.o_orderkey AND x.bib = t.bib)) AS n_both FROM o JOIN l t ON t.l_orderkey = o.before GROUP BY 1),
 s AS (SELECT o_orderkey, n_head, n_tail, n_bad, n_both, CASE WHEN NOT in_order THEN 'ranks' WHEN n_bad > 0 THEN 'broken' WHEN n_both > 0 THEN 'overlap' ELSE 'removed' END AS state FROM t JOIN h ON o_orderkey = l_orderkey)
 SELECT *, CASE WHEN state = 'removed' THEN n_head ELSE n_head + n_tail END AS n_left FROM s""",
    "page_carry": f"""WITH p AS (SELECT o_custkey, o_orderkey AS l_orderkey, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS page FROM orders),
 l AS (SELECT o_custkey, page, l_linenumber, l_partkey, l_suppkey, trunc(l_quantity)::BIGINT AS q, (l_linenumber = 1)::INT AS start, (l_returnflag = 'R')::INT AS run FROM lineitem JOIN p USING (l_orderkey)),
 a AS (SELECT *, sum(start) OVER ({_DOC.format("o_custkey")}) AS athlete FROM l), b AS (SELECT *, min(page) OVER (PARTITION BY o_custkey, athlete) AS first_page, sum(run) OVER ({_DOC.format("o_custkey, athlete, page")}) AS begun FROM a WHERE athlete > 0),
 c AS (SELECT *, sum(run * (1 - start)) OVER ({_DOC.format("o_custkey, athlete")}) AS k FROM b WHERE page = first_page OR page = first_page + 1 AND begun > 0),
 d AS (SELECT *, row_number() OVER (PARTITION BY o_custkey, athlete, k ORDER BY page, l_linenumber, l_partkey, l_suppkey, q) AS place FROM c)
 SELECT o_custkey, athlete::BIGINT AS athlete, k::BIGINT AS k, min(page)::INTEGER AS page, count(*) AS n_values, sum(q)::BIGINT AS total, count(*) FILTER (WHERE page > first_page) AS n_carried, (sum(q) FILTER (WHERE page > first_page))::BIGINT AS carried
 FROM d WHERE place <= 4 GROUP BY 1, 2, 3 HAVING count(*) FILTER (WHERE page > first_page) > 0""",
    "golden_regression": """WITH o AS (SELECT o_orderkey AS run_id, o_orderstatus AS status, round(o_totalprice * 100)::BIGINT AS cents, lag(o_orderkey) OVER w AS before, lag(o_orderstatus) OVER w AS status_before FROM orders WINDOW w AS (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey)),
 g AS (SELECT *, cents + CASE WHEN status_before = 'P' THEN 1 ELSE 0 END AS want FROM o WHERE cents % 3 > 0),
 l AS MATERIALIZED (SELECT l_orderkey AS run_id, trunc(l_quantity)::BIGINT AS mark, l_linestatus, l_extendedprice = max(l_extendedprice) OVER (PARTITION BY l_orderkey) AS dearest, count(*) OVER (PARTITION BY l_orderkey) AS n FROM lineitem),
 x AS (SELECT run_id, mark, count(*) AS n FROM l JOIN o USING (run_id) WHERE status = 'F' OR status = 'O' AND NOT dearest GROUP BY 1, 2),
 y AS (SELECT run_id, mark, count(*) AS n FROM (SELECT run_id, mark FROM l JOIN g USING (run_id) WHERE l_linestatus = 'F' UNION ALL SELECT g.run_id, mark FROM g JOIN l ON g.before = l.run_id WHERE l.n = 1) GROUP BY 1, 2)
 SELECT run_id, 'missing' AS field, 1::BIGINT AS n FROM g WHERE status = 'P' UNION ALL SELECT run_id, 'score', 1 FROM g WHERE status <> 'P' AND status_before = 'P'
 UNION ALL SELECT run_id, 'air', sum(y.n - coalesce(x.n, 0))::BIGINT FROM y LEFT JOIN x USING (run_id, mark) JOIN g USING (run_id) WHERE status <> 'P' AND y.n > coalesce(x.n, 0) GROUP BY 1""",
    "section_codes": """WITH s AS (SELECT user_id, ts::DATE AS day, event_type AS heading, count(*) AS n FROM events GROUP BY 1, 2, 3), h AS (SELECT *, count(*) FILTER (WHERE heading = 'signup') OVER d > 0 AS with_semi, max(n) FILTER (WHERE heading = 'error') OVER d AS e FROM s WINDOW d AS (PARTITION BY user_id, day)),
 c AS (SELECT *, CASE heading WHEN 'view' THEN 'Q' WHEN 'signup' THEN 'F' WHEN 'purchase' THEN 'SF' WHEN 'click' THEN CASE WHEN with_semi THEN 'SF' ELSE 'F' END END AS named FROM h),
 f AS (SELECT *, list_filter(['Q', 'F', 'SF'], lambda x: NOT list_contains(coalesce(list(named) FILTER (WHERE named IS NOT NULL) OVER d, []), x)) AS free, count(*) FILTER (WHERE heading <> 'error' AND n >= e) OVER d AS larger FROM c WINDOW d AS (PARTITION BY user_id, day)),
 r AS (SELECT user_id, day, heading, n, coalesce(named, free[least(larger, len(free) - 1) + 1]) AS code FROM f),
 p AS (SELECT *, count(*) OVER (PARTITION BY user_id, day, code) AS same, lag(n) OVER (PARTITION BY user_id, day ORDER BY CASE code WHEN 'Q' THEN 0 WHEN 'F' THEN 1 ELSE 2 END, heading) AS above FROM r)
 SELECT user_id, day, heading, n, code, CASE WHEN code IS NULL THEN 'no code' WHEN same > 1 THEN 'twice' WHEN above <= n THEN 'count' ELSE '' END AS problem FROM p""",
    "run_codes": """WITH e AS (SELECT user_id, ts::DATE AS day, event_id, event_type, row_number() OVER w AS k, count(*) OVER (PARTITION BY user_id, ts::DATE) AS n, first_value(event_type) OVER w AS last FROM events WHERE event_type <> 'error' WINDOW w AS (PARTITION BY user_id, ts::DATE ORDER BY ts DESC, event_id DESC)),
 b AS (SELECT *, CASE last WHEN 'view' THEN ['Q'] WHEN 'purchase' THEN ['F2', 'F1', 'Q'] ELSE ['F1', 'Q'] END AS base FROM e)
 SELECT user_id, day, event_id, k, CASE WHEN n <= len(base) THEN base[k] WHEN n <= 4 THEN ['F3', 'F2', 'F1', 'Q'][4 - n + k] END AS code FROM b""",
    "rank_offsets": f"""WITH {_RUNS}, r AS (SELECT run_id, season, series, block, (score_k // 4) AS score, (season[4]::INT + series[1]::INT) % 4 AS style, rank() OVER (g ORDER BY score_k // 4 DESC) AS rank, rank() OVER (g ORDER BY score_k // 4 DESC, cents DESC, date) AS official,
  row_number() OVER (g ORDER BY score_k // 4 DESC, run_id) AS by_key, count(*) FILTER (WHERE block = 'F') OVER (PARTITION BY season, series) AS n_upper FROM runs WHERE status = 'OK' WINDOW g AS (PARTITION BY season, series, block)),
 p AS (SELECT *, CASE style WHEN 0 THEN rank WHEN 1 THEN by_key ELSE official END + CASE WHEN block = 'O' THEN n_upper + (style = 3)::INT ELSE 0 END AS printed FROM r),
 o AS (SELECT *, CASE WHEN block = 'O' THEN min(printed) OVER (PARTITION BY season, series, block) - 1 ELSE 0 END AS off FROM p),
 t AS (SELECT *, bool_and(printed = official + off) OVER (PARTITION BY season, series, block, score) AND count(*) OVER (PARTITION BY season, series, block, score) > 1 AS split FROM o)
 SELECT season, series, block, max(off)::BIGINT AS rank_offset, count(*) FILTER (WHERE printed = rank + off) AS n_ok, count(*) FILTER (WHERE printed <> rank + off AND split) AS n_official, count(*) FILTER (WHERE printed <> rank + off AND NOT split) AS n_error, min(run_id) FILTER (WHERE printed <> rank + off AND NOT split) AS first_error FROM t GROUP BY 1, 2, 3""",
    "largest_overlap": """WITH l AS (SELECT o_custkey, o_orderpriority AS series, l_suppkey, l_returnflag, l_linestatus FROM orders JOIN lineitem ON o_orderkey = l_orderkey),
 g AS (SELECT o_custkey, series, list(DISTINCT l_suppkey) AS s FROM l WHERE l_linestatus = 'F' GROUP BY 1, 2), p AS (SELECT o_custkey, list(DISTINCT l_suppkey) AS s FROM l WHERE l_returnflag = 'N' GROUP BY 1),
 c AS (SELECT g.o_custkey, series, len(g.s) AS n_group, coalesce(len(list_intersect(g.s, p.s)), 0) AS common FROM g LEFT JOIN p ON g.o_custkey = p.o_custkey)
 SELECT *, CASE WHEN row_number() OVER (PARTITION BY o_custkey ORDER BY common DESC, series) = 1 THEN 'compared' ELSE 'skipped' END AS state FROM c""",
}
