"""Published tables: written under content hashes, published again after corrections, read back through the manifest and checked."""

from pyspark.sql import functions as F

from runledger.sources import store
from runledger.sources.scratch import scratch_path
from runledger.sources.tables import runs, table

SHARDS = 64
GONE, CUT = "1992-93", "1998-01-01"


def _shard(column):
    return F.pmod(F.crc32(F.col(column).cast("string").cast("binary")), F.lit(SHARDS)).cast("int")


def _events(rows):
    """An athlete's season: what the page of events shows, with its rounds nested in order, and the light entry of the index."""
    nested = F.array_sort(F.collect_list(F.struct("date", "run_id", "series", "score_k")))
    each = rows.groupBy("athlete", "season").agg(F.min("date").alias("date_from"), F.max("date").alias("date_to"), nested.alias("rounds"))
    light = F.array_join(F.transform("rounds", lambda r: F.concat_ws(":", r["run_id"], r["series"])), " ")
    full = F.array_join(F.transform("rounds", lambda r: F.concat_ws(":", r["date"].cast("string"), r["run_id"], r["series"], r["score_k"])), " ")
    return each.select("athlete", "date_from", "date_to", light.alias("light"), full.alias("rounds"), "season")


def _twice(spark, sf_dir, of, part):
    """A store with two versions: the runs before the cut, then all runs without one season."""
    root, rows = scratch_path(spark, "store"), runs(spark, sf_dir)
    for version, own in ((1, rows.filter(F.col("date") < CUT)), (2, rows.filter(F.col("season") != GONE))):
        store.publish(spark, root, {name: (df, part) for name, df in of(own).items()}, version)
    return root


def published_seasons(spark, sf_dir):
    """Runs published by season, then again after more runs came and one season vanished: by season what became of it (kept partitions are not written
    again), its rows and content hash by the manifest and by the files, and runs that are not there exactly once."""
    root = _twice(spark, sf_dir, lambda rows: {"runs": rows.select("run_id", "athlete", "status", "score_k", "season")}, "season")
    of = lambda v, c: F.max(F.when(F.col("version") == v, F.col(c)))
    states = store.manifests(spark, root).groupBy("part").agg(of(1, "hash").alias("old"), of(2, "hash").alias("new"))
    state = F.expr("CASE WHEN old IS NULL THEN 'new' WHEN new IS NULL THEN 'gone' WHEN old = new THEN 'kept' ELSE 'changed' END")
    store.sweep(spark, root)
    back = store.read(spark, root, "runs").groupBy("run_id", "season").agg(F.count("*").alias("copies"))
    want = runs(spark, sf_dir).filter(F.col("season") != GONE).select("run_id", "season", F.lit(1).alias("wanted"))
    placed = want.join(back, ["run_id", "season"], "full").groupBy("season").agg(F.count_if(~F.col("wanted").eqNullSafe(F.col("copies"))).alias("n_not_once"))
    found = store.verify(spark, root, "runs").select("part", "n", "hash", (F.col("hash") == F.col("hash_found")).alias("whole"))
    out = states.select("part", state.alias("state")).join(found, "part", "left").join(placed, F.col("part") == F.col("season"), "left")
    return out.select(F.col("part").alias("season"), "state", "n", "hash", "whole", "n_not_once")


def published_shards(spark, sf_dir):
    """Runs published by athlete shard with the sizes of their rounds beside them, read back by shard: every run once, in its shard, content equal, and
    each round's size equal to the runs of all shards."""
    rows = runs(spark, sf_dir)
    sizes = rows.groupBy("season", "series").agg(F.count_if(F.col("status") == "OK").alias("size"))
    own = rows.withColumn("shard", _shard("athlete"))
    beside = own.select("shard", "season", "series").distinct().join(sizes, ["season", "series"])
    root = scratch_path(spark, "store")
    store.publish(spark, root, {"runs": (own.select("run_id", "athlete", "season", "series", "status", "score_k", "shard"), "shard"), "round_sizes": (beside.select("season", "series", "size", "shard"), "shard")}, 1)
    back, there = store.read(spark, root, "runs"), store.read(spark, root, "round_sizes")
    again = back.groupBy("season", "series").agg(F.count_if(F.col("status") == "OK").alias("again"))
    sized = there.join(again, ["season", "series"], "left").groupBy("shard").agg(F.sum("size").alias("round_sizes"), F.count("*").alias("n_rounds"), F.count_if(~F.col("size").eqNullSafe(F.col("again"))).alias("n_sizes_wrong"))
    each = back.groupBy("shard").agg(F.count("*").alias("n_runs"), F.countDistinct("run_id").alias("n_different"), F.countDistinct("athlete").alias("n_athletes"), F.count_if(_shard("athlete") != F.col("shard").cast("int")).alias("n_misplaced"))
    whole = store.verify(spark, root, "runs").select(F.col("part").alias("shard"), "hash", (F.col("hash") == F.col("hash_found")).alias("whole"))
    return each.join(sized, "shard").join(whole, "shard").withColumn("shard", F.col("shard").cast("int"))


def published_index(spark, sf_dir):
    """Events published by season, and the index of the version before them: by season the events in both, entries that the index lacks or has too
    many, entries whose dates or rounds differ from the files, and events whose place in the order by date changed."""
    root = _twice(spark, sf_dir, lambda rows: {"events": _events(rows)}, "season")
    index = _events(runs(spark, sf_dir).filter(F.col("date") < CUT)).drop("rounds")
    files = store.read(spark, root, "events").drop("rounds")
    both = index.select("athlete", "season", F.struct("date_from", "date_to", "light").alias("i")).join(files.select("athlete", "season", F.struct("date_from", "date_to", "light").alias("f")), ["athlete", "season"], "full")
    differs = F.col("i").isNotNull() & F.col("f").isNotNull()
    return both.groupBy("season").agg(
        F.count_if(differs).alias("n_both"), F.count_if(F.col("i").isNull()).alias("n_missing"), F.count_if(F.col("f").isNull()).alias("n_surplus"),
        F.count_if(differs & ((F.col("i.date_from") != F.col("f.date_from")) | (F.col("i.date_to") != F.col("f.date_to")))).alias("n_dates_differ"),
        F.count_if(differs & (F.col("i.light") != F.col("f.light"))).alias("n_rounds_differ"),
        F.count_if(differs & (F.col("i.date_to") < F.col("f.date_from"))).alias("n_moved"),
    )


def manifest_summary(spark, sf_dir):
    """The published version in one row a series: counts, first and last season, the newest event, and whether all of its events are green (no
    unfinished run, no score of zero)."""
    root, rows = scratch_path(spark, "store"), runs(spark, sf_dir)
    store.publish(spark, root, {"runs": (rows.select("run_id", "athlete", "date", "series", "status", "score_k", "season"), "season")}, 1)
    back = store.read(spark, root, "runs")
    green = back.groupBy("series", "season", "athlete").agg(F.count("*").alias("n"), F.max("date").alias("date"), F.bool_and((F.col("status") == "OK") & (F.col("score_k") > 0)).alias("green"))
    return green.groupBy("series").agg(F.sum("n").alias("n_runs"), F.count("*").alias("n_events"), F.countDistinct("athlete").alias("n_athletes"), F.min("season").alias("first_season"), F.max("season").alias("last_season"), F.max("date").alias("newest"), F.count_if("green").alias("n_green"), F.bool_and("green").alias("all_green"))


def upstream_rounds(spark, sf_dir):
    """Another site's runs, found through its manifest and checked by hash, imported at score tier: judge marks and rounds known at detail tier here stay
    out; runs grouped by round with their best and how many of its athletes are known here."""
    root = scratch_path(spark, "upstream")
    lines = table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(F.sort_array(F.collect_list(F.col("l_quantity").cast("long"))).alias("marks"))
    theirs = runs(spark, sf_dir).filter("status = 'OK'").join(lines, F.col("run_id") == F.col("l_orderkey"), "left")
    store.publish(spark, root, {"runs": (theirs.select("run_id", "athlete", "series", "score_k", F.array_join(F.col("marks").cast("array<string>"), ",").alias("marks"), "season"), "season")}, 1)
    good = store.verify(spark, root, "runs").filter("hash = hash_found AND n = n_found").select(F.col("part").alias("season"))
    imported = store.read(spark, root, "runs").drop("marks").join(F.broadcast(good), "season")
    detail = runs(spark, sf_dir).groupBy("season", "series").agg((F.count_if(F.col("status") != "OK") * 40 < F.count("*")).alias("here")).filter("here").select("season", "series")
    known = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("athlete"), F.lit(1).alias("known"))
    rows = imported.join(detail, ["season", "series"], "left_anti").join(known, "athlete", "left")
    return rows.groupBy("season", "series").agg(F.count("*").alias("n_runs"), F.max("score_k").alias("best"), F.count_if(F.col("known") == 1).alias("n_known"), F.lit("score").alias("tier"))


LIST = (published_seasons, published_shards, published_index, manifest_summary, upstream_rounds)
_RUNS = """runs AS (SELECT o_orderkey AS run_id, o_custkey AS athlete, o_orderdate::DATE AS date, printf('%d-%02d', y, (y + 1) % 100) AS season, o_orderpriority AS series,
 CASE WHEN o_orderstatus = 'P' THEN 'DNF' ELSE 'OK' END AS status, floor(o_totalprice / 1000)::BIGINT AS score_k FROM (SELECT *, year(o_orderdate) - CASE WHEN month(o_orderdate) < 7 THEN 1 ELSE 0 END AS y FROM orders))"""
#: CRC-32 of decimal ids: its table from the polynomial, then one step a digit.
CRC = """crc_table AS MATERIALIZED (SELECT list_transform(range(256), lambda i: list_reduce(list_prepend(i, range(8)), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS t),
shards AS MATERIALIZED (SELECT id AS athlete, xor(4294967295, list_reduce(list_prepend(4294967295, list_transform(string_split(id::VARCHAR, ''), lambda d: ascii(d)::BIGINT)), lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1]))) % 64 AS shard
 FROM (SELECT DISTINCT o_custkey AS id FROM orders), crc_table)"""


def _hash(rows: str, by: str, text: str) -> str:
    halves = ", ".join(f"sum(('0x' || sha256({text})[{a}:{a + 14}])::BIGINT)" for a in (1, 16))
    return f"SELECT {by}, n, sha256(n || ':' || a || ':' || b)[1:16] AS hash FROM (SELECT {by}, count(*) AS n, {halves.replace(', sum', ' AS a, sum')} AS b FROM {rows} GROUP BY {by})"


_EVENTS = "SELECT athlete, season, min(date) AS date_from, max(date) AS date_to, string_agg(run_id || ':' || series, ' ' ORDER BY date, run_id) AS light FROM runs WHERE {} GROUP BY 1, 2"
SQL = {
    "published_seasons": f"""WITH {_RUNS}, x AS (SELECT *, run_id || '|' || athlete || '|' || status || '|' || score_k AS line FROM runs),
 o AS ({_hash(f"(FROM x WHERE date < DATE '{CUT}')", "season", "line")}), n AS ({_hash(f"(FROM x WHERE season <> '{GONE}')", "season", "line")})
 SELECT coalesce(n.season, o.season) AS season, CASE WHEN o.hash IS NULL THEN 'new' WHEN n.hash IS NULL THEN 'gone' WHEN o.hash = n.hash THEN 'kept' ELSE 'changed' END AS state, n.n AS n, n.hash AS hash,
 CASE WHEN n.hash IS NOT NULL THEN true END AS whole, CASE WHEN n.hash IS NOT NULL THEN 0::BIGINT END AS n_not_once FROM o FULL JOIN n ON o.season = n.season""",
    "published_shards": f"""WITH {_RUNS}, {CRC}, r AS (SELECT runs.*, shard FROM runs JOIN shards USING (athlete)), s AS (SELECT season, series, count(*) FILTER (WHERE status = 'OK') AS size FROM runs GROUP BY 1, 2),
 h AS ({_hash("r", "shard", "run_id || '|' || athlete || '|' || season || '|' || series || '|' || status || '|' || score_k")}),
 z AS (SELECT shard, sum(size)::BIGINT AS round_sizes, count(*) AS n_rounds FROM (SELECT DISTINCT shard, season, series FROM r) JOIN s USING (season, series) GROUP BY 1)
 SELECT r.shard::INTEGER AS shard, count(*) AS n_runs, count(DISTINCT run_id) AS n_different, count(DISTINCT athlete) AS n_athletes, 0::BIGINT AS n_misplaced, any_value(round_sizes) AS round_sizes, any_value(n_rounds) AS n_rounds, 0::BIGINT AS n_sizes_wrong, any_value(hash) AS hash, true AS whole
 FROM r JOIN z ON r.shard = z.shard JOIN h ON r.shard = h.shard GROUP BY r.shard""",
    "published_index": f"""WITH {_RUNS}, i AS ({_EVENTS.format(f"date < DATE '{CUT}'")}), f AS ({_EVENTS.format(f"season <> '{GONE}'")})
 SELECT coalesce(f.season, i.season) AS season, count(*) FILTER (WHERE f.season IS NOT NULL AND i.season IS NOT NULL) AS n_both, count(*) FILTER (WHERE i.season IS NULL) AS n_missing, count(*) FILTER (WHERE f.season IS NULL) AS n_surplus,
 count(*) FILTER (WHERE i.date_from <> f.date_from OR i.date_to <> f.date_to) AS n_dates_differ, count(*) FILTER (WHERE i.light <> f.light) AS n_rounds_differ, count(*) FILTER (WHERE i.date_to < f.date_from) AS n_moved
 FROM i FULL JOIN f ON i.athlete = f.athlete AND i.season = f.season GROUP BY 1""",
    "manifest_summary": f"""WITH {_RUNS}, g AS (SELECT series, season, athlete, count(*) AS n, max(date) AS date, bool_and(status = 'OK' AND score_k > 0) AS green FROM runs GROUP BY 1, 2, 3)
 SELECT series, sum(n)::BIGINT AS n_runs, count(*) AS n_events, count(DISTINCT athlete) AS n_athletes, min(season) AS first_season, max(season) AS last_season, max(date) AS newest, count(*) FILTER (WHERE green) AS n_green, bool_and(green) AS all_green FROM g GROUP BY 1""",
    "upstream_rounds": f"""WITH {_RUNS}, d AS (SELECT season, series FROM runs GROUP BY 1, 2 HAVING count(*) FILTER (WHERE status <> 'OK') * 40 < count(*))
 SELECT season, series, count(*) AS n_runs, max(score_k) AS best, count(c_custkey) AS n_known, 'score' AS tier FROM runs ANTI JOIN d USING (season, series) LEFT JOIN customer ON athlete = c_custkey WHERE status = 'OK' GROUP BY 1, 2""",
}
