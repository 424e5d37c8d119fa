"""Rounds, progression and placing; an event is a day, an athlete a user of that day."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from runledger.operators.ranks import competition_rank
from runledger.sources.tables import LADDER, ladder, runs, table


def _placed(spark, sf_dir):
    """Each athlete in the highest round that holds them."""
    top = F.max(F.struct("step", "score")).alias("top")
    return ladder(spark, sf_dir).groupBy("day", "user_id").agg(top).select("day", "user_id", "top.step", "top.score")


def ladder_placing(spark, sf_dir):
    """Places count on from the higher rounds; ties share a place and leave a gap."""
    key = F.col("step") * (1 << 40) + F.col("score")
    return competition_rank(_placed(spark, sf_dir).withColumn("_key", key), ["day"], "_key", "place").drop("_key")


def ladder_dense(spark, sf_dir):
    key = F.col("step") * (1 << 40) + F.col("score")
    return competition_rank(_placed(spark, sf_dir).withColumn("_key", key), ["day"], "_key", "position", then=[F.col("user_id")]).select("day", "user_id", "step", "position")


def progression_check(spark, sf_dir):
    """Who of a day's best 16 of one round misses the next, and who is there without a place: counts by day and round."""
    w = Window.partitionBy("day", "step").orderBy(F.desc("score"))
    ranked = ladder(spark, sf_dir).withColumn("r", F.rank().over(w))
    due = ranked.filter("r <= 16 AND step < 4").select("day", "user_id", (F.col("step") + 1).alias("step"), F.lit(1).alias("due"), F.lit(0).alias("there"))
    there = ranked.filter("step > 1").select("day", "user_id", "step", F.lit(0).alias("due"), F.lit(1).alias("there"))
    each = due.unionAll(there).groupBy("day", "step", "user_id").agg(F.max("due").alias("due"), F.max("there").alias("there"))
    return each.groupBy("day", "step").agg(F.count_if((F.col("due") == 1) & (F.col("there") == 0)).alias("missing"), F.count_if((F.col("due") == 0) & (F.col("there") == 1)).alias("outside"))


def best_of_two(spark, sf_dir):
    """The first two finished runs of an athlete and season; the better one counts."""
    own = Window.partitionBy("athlete", "season")
    first = runs(spark, sf_dir).filter("status = 'OK'").withColumn("seq", F.row_number().over(own.orderBy("date", "run_id")).cast("long")).filter("seq <= 2")
    rn = F.row_number().over(own.orderBy(F.desc("score_k"), "seq"))
    return first.select("run_id", "athlete", "season", "seq", F.max("score_k").over(own).alias("best"), (rn == 1).alias("counting"))


def best_score_order(spark, sf_dir):
    """How often an athlete's scores rise in the order of dates, by season."""
    w = Window.partitionBy("athlete", "season").orderBy("date", "run_id")
    rises = F.when(F.col("score_k") > F.lag("score_k").over(w), 1).otherwise(0)
    return runs(spark, sf_dir).select("athlete", "season", rises.alias("up")).groupBy("athlete", "season").agg(F.sum("up").alias("rises"), F.count("*").alias("n"))


def affiliation_islands(spark, sf_dir):
    """Stretches of one event type in each user's order of time."""
    w = Window.partitionBy("user_id").orderBy("ts", "event_id")
    rows = table(spark, sf_dir, "events").select("user_id", "ts", "event_id", "event_type")
    new = F.when(F.lag("event_type").over(w).eqNullSafe(F.col("event_type")), 0).otherwise(1)
    marked = rows.withColumn("new", new).withColumn("island", F.sum("new").over(w))
    return marked.groupBy("user_id", "island", "event_type").agg(F.count("*").alias("n"), F.min(F.struct("ts", "event_id")).getField("event_id").alias("first_event"))


def carried_value(spark, sf_dir):
    """At each event, the value (hundredths) of the user's last purchase so far."""
    w = Window.partitionBy("user_id").orderBy("ts", "event_id")
    known = F.when(F.col("event_type") == "purchase", F.round(F.col("value") * 100).cast("long"))
    return table(spark, sf_dir, "events").select("event_id", "user_id", F.last(known, ignorenulls=True).over(w).alias("carried"))


def set_algebra(spark, sf_dir):
    """Sets of a day's athletes: clicks and signups, their union, difference both ways, common part and symmetric difference; and the baseline that
    keeps what was registered (the day before) or is published now, without the forgotten (every seventh)."""
    sets = ladder(spark, sf_dir).groupBy("day", "user_id").agg(F.max((F.col("step") == 2).cast("int")).alias("c"), F.max((F.col("step") == 3).cast("int")).alias("s"))
    now = sets.groupBy("day").agg(
        F.count_if((F.col("c") == 1) | (F.col("s") == 1)).alias("n_union"), F.count_if((F.col("c") == 1) & (F.col("s") == 1)).alias("n_both"),
        F.count_if((F.col("c") == 1) & (F.col("s") == 0)).alias("n_clicks_only"), F.count_if((F.col("c") == 0) & (F.col("s") == 1)).alias("n_signups_only"), F.count_if(F.col("c") != F.col("s")).alias("n_symmetric"),
    )
    published = sets.filter("s = 1").select("day", "user_id")
    kept = published.unionByName(published.withColumn("day", F.date_add("day", 1))).distinct().filter("user_id % 7 <> 0").groupBy("day").agg(F.count("*").alias("n_baseline"))
    return now.join(kept, "day", "left").fillna(0, ["n_baseline"])


def identity_unify(spark, sf_dir):
    """The key that each user showed first, and how many events show another."""
    k = F.get_json_object("props", "$.k").cast("long")
    rows = table(spark, sf_dir, "events").select("user_id", "ts", "event_id", k.alias("k"))
    first = F.first("k").over(Window.partitionBy("user_id").orderBy("ts", "event_id"))
    return rows.withColumn("first_k", first).groupBy("user_id", "first_k").agg(F.count_if(F.col("k") != F.col("first_k")).alias("n_other"), F.count("*").alias("n"))


def page_of_results(spark, sf_dir):
    """The second page of 50 of all runs by score; the limit is the feature."""
    return runs(spark, sf_dir).orderBy(F.desc("score_k"), "run_id").offset(50).limit(50).select("run_id", "athlete", "score_k")


def history_page(spark, sf_dir):
    """Each athlete's seasons: runs, finished ones, best score."""
    return runs(spark, sf_dir).groupBy("athlete", "season").agg(F.count("*").alias("n_runs"), F.count_if(F.col("status") == "OK").alias("n_ok"), F.max(F.when(F.col("status") == "OK", F.col("score_k"))).alias("best"))


LIST = (ladder_placing, ladder_dense, progression_check, best_of_two, best_score_order, affiliation_islands, carried_value, set_algebra, identity_unify, page_of_results, history_page)
_RUNS = """runs AS (SELECT o_orderkey AS run_id, o_custkey AS athlete, o_orderdate::DATE AS date, printf('%d-%02d', y, (y + 1) % 100) AS season,
 CASE WHEN o_orderstatus = 'P' THEN 'DNF' ELSE 'OK' END AS status, floor(o_totalprice / 1000)::BIGINT AS score_k FROM (SELECT *, year(o_orderdate) - CASE WHEN month(o_orderdate) < 7 THEN 1 ELSE 0 END AS y FROM orders))"""
_PLACED = f"WITH {LADDER}, p AS (SELECT day, user_id, step, score FROM (SELECT *, row_number() OVER (PARTITION BY day, user_id ORDER BY step DESC) AS rn FROM ladder) WHERE rn = 1)"
SQL = {
    "ladder_placing": f"{_PLACED} SELECT *, rank() OVER (PARTITION BY day ORDER BY step DESC, score DESC) AS place FROM p",
    "ladder_dense": f"{_PLACED} SELECT day, user_id, step, row_number() OVER (PARTITION BY day ORDER BY step DESC, score DESC, user_id) AS position FROM p",
    "progression_check": f"""WITH {LADDER}, r AS (SELECT *, rank() OVER (PARTITION BY day, step ORDER BY score DESC) AS r FROM ladder),
 due AS (SELECT day, user_id, step + 1 AS step FROM r WHERE r <= 16 AND step < 4), there AS (SELECT day, user_id, step FROM r WHERE step > 1)
 SELECT day, step, count(*) FILTER (WHERE d AND t IS NULL) AS missing, count(*) FILTER (WHERE t AND d IS NULL) AS outside
 FROM (SELECT *, true AS d FROM due) FULL JOIN (SELECT *, true AS t FROM there) USING (day, user_id, step) GROUP BY 1, 2""",
    "best_of_two": f"""WITH {_RUNS}, f AS (SELECT *, row_number() OVER (PARTITION BY athlete, season ORDER BY date, run_id) AS seq FROM runs WHERE status = 'OK')
 SELECT run_id, athlete, season, seq, max(score_k) OVER (PARTITION BY athlete, season) AS best, row_number() OVER (PARTITION BY athlete, season ORDER BY score_k DESC, seq) = 1 AS counting FROM f WHERE seq <= 2""",
    "best_score_order": f"""WITH {_RUNS}, u AS (SELECT athlete, season, score_k > lag(score_k) OVER (PARTITION BY athlete, season ORDER BY date, run_id) AS up FROM runs)
 SELECT athlete, season, count(*) FILTER (WHERE up) AS rises, count(*) AS n FROM u GROUP BY 1, 2""",
    "affiliation_islands": """WITH m AS (SELECT *, CASE WHEN lag(event_type) OVER w IS NOT DISTINCT FROM event_type THEN 0 ELSE 1 END AS new FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)),
 i AS (SELECT *, sum(new) OVER (PARTITION BY user_id ORDER BY ts, event_id)::BIGINT AS island FROM m) SELECT user_id, island, event_type, count(*) AS n, arg_min(event_id, (ts, event_id)) AS first_event FROM i GROUP BY 1, 2, 3""",
    "carried_value": "SELECT event_id, user_id, last_value(CASE WHEN event_type = 'purchase' THEN round(value * 100)::BIGINT END IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS carried FROM events",
    "set_algebra": f"""WITH {LADDER}, c AS (SELECT DISTINCT day, user_id FROM ladder WHERE step = 2), s AS (SELECT DISTINCT day, user_id FROM ladder WHERE step = 3), d AS (SELECT DISTINCT day FROM ladder), p AS (SELECT * FROM s UNION SELECT day + 1, user_id FROM s),
 n AS (SELECT day, (SELECT count(*) FROM c WHERE c.day = d.day) AS nc, (SELECT count(*) FROM s WHERE s.day = d.day) AS ns, (SELECT count(*) FROM c JOIN s USING (day, user_id) WHERE c.day = d.day) AS n_both, (SELECT count(*) FROM p WHERE p.day = d.day AND user_id % 7 <> 0) AS n_baseline FROM d)
 SELECT day, nc + ns - n_both AS n_union, n_both, nc - n_both AS n_clicks_only, ns - n_both AS n_signups_only, nc + ns - 2 * n_both AS n_symmetric, n_baseline FROM n""",
    "identity_unify": """WITH k AS (SELECT user_id, ts, event_id, regexp_extract(props, '"k": *(\\d+)', 1)::BIGINT AS k FROM events), f AS (SELECT *, first_value(k) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS first_k FROM k)
 SELECT user_id, first_k, count(*) FILTER (WHERE k <> first_k) AS n_other, count(*) AS n FROM f GROUP BY 1, 2""",
    "page_of_results": f"WITH {_RUNS} SELECT run_id, athlete, score_k FROM runs ORDER BY score_k DESC, run_id LIMIT 50 OFFSET 50",
    "history_page": f"WITH {_RUNS} SELECT athlete, season, count(*) AS n_runs, count(*) FILTER (WHERE status = 'OK') AS n_ok, max(score_k) FILTER (WHERE status = 'OK') AS best FROM runs GROUP BY 1, 2",
}
