"""Cross-checks between readings of the same results; where both sides share the key, one grouped union takes the place of a full outer join (one shuffle)."""

from pyspark.sql import functions as F

from runledger.operators.ranks import competition_rank
from runledger.sources.tables import parts, runs, season, table


def readings(spark, sf_dir):
    """Line items by two readers: the second is off by one on every 97th order and lacks every 101st."""
    a = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", F.col("l_quantity").cast("long").alias("qty"))
    return a, a.filter("l_orderkey % 101 <> 0").withColumn("qty", F.expr("qty + if(l_orderkey % 97 = 0, 1, 0)"))


def _sided(a, b):
    return a.withColumn("side", F.lit("a")).unionAll(b.withColumn("side", F.lit("b")))


def reader_compare(spark, sf_dir):
    """Keys that one reader lacks or whose totals differ."""
    of = lambda s: F.sum(F.when(F.col("side") == s, F.col("qty")))
    both = _sided(*readings(spark, sf_dir)).groupBy("l_orderkey", "l_linenumber").agg(of("a").alias("qty_a"), of("b").alias("qty_b"))
    return both.filter("NOT (qty_a <=> qty_b)")


def multiset_diff(spark, sf_dir):
    """Rows of the first reading that the second does not hold as often."""
    a, b = readings(spark, sf_dir)
    return a.exceptAll(b)


def consume_once_band(spark, sf_dir):
    """Values that an order needs more often than they are printed."""
    of = lambda s: F.count_if(F.col("side") == s)
    both = _sided(*readings(spark, sf_dir)).groupBy("l_orderkey", "qty").agg(of("a").alias("n_expected"), of("b").alias("n_printed"))
    return both.filter("n_expected > n_printed")


def baseline_drift(spark, sf_dir):
    """Rounds against their registered sizes (made without every 1009th run, without one season's slow runs, and with a round that is gone)."""
    sizes = runs(spark, sf_dir).groupBy("season", "series").agg(F.count("*").alias("n"))
    known = table(spark, sf_dir, "orders").filter("o_orderkey % 1009 <> 0").select(season(F.col("o_orderdate")).alias("season"), F.col("o_orderpriority").alias("series"))
    known = known.filter("NOT (season = '1995-96' AND series = '5-LOW')").withColumn("season", F.when((F.col("season") == "1994-95") & (F.col("series") == "2-HIGH"), "1893-94").otherwise(F.col("season")))
    both = sizes.join(known.groupBy("season", "series").agg(F.count("*").alias("n_expected")), ["season", "series"], "full")
    state = F.when(F.col("n").isNull(), "gone").when(F.col("n_expected").isNull(), "new").otherwise("changed")
    return both.filter("NOT (n <=> n_expected)").withColumn("state", state)


def incremental_inputs(spark, sf_dir):
    """State of each changed input against stored fingerprints: changed, new or gone."""
    now = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus", F.sha2(F.concat_ws("|", "o_orderkey", "o_custkey", "o_orderstatus"), 256).alias("sha"))
    old = now.filter("o_orderkey % 83 <> 0").withColumn("sha", F.expr("if(o_orderkey % 89 = 0, 'old', sha)"))
    now = now.filter("o_orderkey % 79 <> 0")
    of = lambda s: F.max(F.when(F.col("side") == s, F.col("sha")))
    both = _sided(now, old).groupBy("o_orderkey").agg(of("a").alias("a"), of("b").alias("b")).filter("NOT (a <=> b)")
    return both.select("o_orderkey", F.expr("CASE WHEN a IS NULL THEN 'gone' WHEN b IS NULL THEN 'new' ELSE 'changed' END").alias("state"))


def rank_block_verify(spark, sf_dir):
    """Printed ranks (of another reading: every 61st score one higher, every 67th run not ranked) against ranks by score and tie mark (T1, A2, …: the
    smaller number is better). A missing printed rank is filled from the computed one."""
    k = F.col("run_id")
    mark = F.when(k % 2 == 0, F.concat(F.element_at(F.array(F.lit("T"), F.lit("A"), F.lit("S")), (k % 3 + 1).cast("int")), k % 4))
    value = F.when(mark.rlike("^[TAS][0-9]+$"), -F.regexp_extract(mark, "[0-9]+", 0).try_cast("long")).otherwise(F.lit(0).cast("long"))
    own = runs(spark, sf_dir).filter("status = 'OK'").select(k, "season", "series", "score_k", value.alias("tie"))
    computed = competition_rank(own, ["season", "series"], "score_k", then=[F.desc("tie")])
    other = table(spark, sf_dir, "orders").filter("o_orderstatus <> 'P' AND o_orderkey % 67 <> 0").select(
        F.col("o_orderkey").alias("run_id"), season(F.col("o_orderdate")).alias("season"), F.col("o_orderpriority").alias("series"), F.expr("cast(floor(o_totalprice / 1000) AS bigint) + if(o_orderkey % 61 = 0, 1, 0)").alias("score")
    )
    printed = competition_rank(other, ["season", "series"], "score", "printed")
    both = computed.select("run_id", "season", "series", "rank", "tie").join(printed.select("run_id", "printed"), "run_id", "left")
    kind = F.when(F.col("printed").isNull(), "filled").when(F.col("printed") == F.col("rank"), "ok").when(F.col("printed") < F.col("rank"), "printed higher").otherwise("printed lower")
    return both.select("run_id", "season", "series", "rank", "printed", F.coalesce("printed", "rank").alias("used"), kind.alias("kind")).filter("kind <> 'ok'")


def publication_gate(spark, sf_dir):
    """Events (an athlete's season) and whether they may be published: errors of two layers (sequences that a reader lacks, values that readers see
    otherwise) keep an event back as a whole, unless its revision is accepted; with the state of each layer."""
    from runledger.plans.matching import reader_sequence_compare

    found = reader_sequence_compare(spark, sf_dir).filter("state IN ('missing', 'values')").select(F.col("l_orderkey").alias("run_id"), "state")
    accepted = table(spark, sf_dir, "customer").filter("c_custkey % 10 = 0").select(F.col("c_custkey").alias("athlete"), F.lit(True).alias("accepted"))
    rows = runs(spark, sf_dir).select("run_id", "athlete", "season").join(found, "run_id", "left").join(accepted, "athlete", "left")
    events = rows.groupBy("athlete", "season").agg(F.count("*").alias("n_runs"), F.count_if(F.col("state") == "missing").alias("n_missing"), F.count_if(F.col("state") == "values").alias("n_values"), F.max(F.coalesce("accepted", F.lit(False))).alias("accepted"))
    of = lambda c: F.when(F.col(c) > 0, "error").otherwise("ok")
    return events.select("athlete", "season", "n_runs", F.concat_ws(" ", of("n_missing"), of("n_values")).alias("layers"), ((F.col("n_missing") == 0) & ((F.col("n_values") == 0) | F.col("accepted"))).alias("published"))


def manifest_counts(spark, sf_dir):
    """Counts of a publication: runs, ranked ones, rounds, athletes."""
    return runs(spark, sf_dir).agg(F.count("*").alias("parsed"), F.count_if(F.col("status") == "OK").alias("ranked"), F.countDistinct("season", "series").alias("rounds"), F.countDistinct("athlete").alias("athletes"))


def consistency_sets(spark, sf_dir):
    """Parts that occur with several discounts: how many, least and most, in hundredths."""
    d = F.round(F.col("l_discount") * 100).cast("long")
    return table(spark, sf_dir, "lineitem").groupBy("l_partkey").agg(F.countDistinct(d).alias("n_values"), F.min(d).alias("least"), F.max(d).alias("most")).filter("n_values > 1")


def judges_dimension(spark, sf_dir):
    """One row for each supplier: orders, lines, first and last day."""
    day = F.to_date("l_shipdate")
    return table(spark, sf_dir, "lineitem").groupBy("l_suppkey").agg(F.countDistinct("l_orderkey").alias("n_orders"), F.count("*").alias("n_lines"), F.min(day).alias("first_day"), F.max(day).alias("last_day"))


def meet_grouping(spark, sf_dir):
    """Customers' months with several orders, no two of one day."""
    rows = table(spark, sf_dir, "orders").select("o_custkey", F.date_format("o_orderdate", "yyyy-MM").alias("month"), F.to_date("o_orderdate").alias("day"))
    return rows.groupBy("o_custkey", "month").agg(F.count("*").alias("n"), F.countDistinct("day").alias("n_days")).filter("n > 1 AND n = n_days")


def upstream_compare(spark, sf_dir):
    """Fields that differ between the orders and an upstream table (its own rows: every 103rd missing, ten ids of its own, other states and customers, a
    null every 107th): one row a field, a null on one side is a difference."""
    every = table(spark, sf_dir, "orders")
    n = 2 * parts(every)
    own = every.select("o_orderkey", F.expr("stack(2, 'status', o_orderstatus, 'customer', cast(o_custkey AS string)) AS (field, own)"))
    k = F.col("o_orderkey")
    up = every.filter(k % 103 != 0).select(
        F.when(k % 1499 == 1, -k).otherwise(k).alias("o_orderkey"), F.when(k % 107 == 0, None).when(k % 71 == 0, "X").otherwise(F.col("o_orderstatus")).alias("status"), (F.col("o_custkey") + F.when(k % 73 == 0, 1).otherwise(0)).cast("string").alias("customer")
    ).unpivot("o_orderkey", ["status", "customer"], "field", "copy")
    own, up = (rows.withColumn(side, F.lit(True)).repartition(n, "o_orderkey", "field") for rows, side in ((own, "here"), (up, "there")))
    both = own.join(up, ["o_orderkey", "field"], "full")
    side = F.when(F.col("there").isNull(), "not upstream").when(F.col("here").isNull(), "upstream alone").otherwise("differs")
    return both.filter("NOT (own <=> copy) OR here IS NULL OR there IS NULL").select("o_orderkey", "field", "own", "copy", side.alias("side"))


LIST = (reader_compare, multiset_diff, consume_once_band, baseline_drift, incremental_inputs, rank_block_verify, publication_gate, manifest_counts, consistency_sets, judges_dimension, meet_grouping, upstream_compare)
_READ = """a AS (SELECT l_orderkey, l_linenumber, trunc(l_quantity)::BIGINT AS qty FROM lineitem),
 b AS (SELECT l_orderkey, l_linenumber, qty + CASE WHEN l_orderkey % 97 = 0 THEN 1 ELSE 0 END AS qty FROM a WHERE l_orderkey % 101 <> 0)"""
_ROUND = "(SELECT o_orderkey AS run_id, o_custkey AS athlete, o_orderstatus AS s, o_orderpriority AS series, printf('%d-%02d', y, (y + 1) % 100) AS season FROM (SELECT *, year(o_orderdate) - CASE WHEN month(o_orderdate) < 7 THEN 1 ELSE 0 END AS y FROM orders))"
SQL = {
    "reader_compare": f"""WITH {_READ}, x AS (SELECT l_orderkey, l_linenumber, sum(qty)::BIGINT AS qty_a FROM a GROUP BY 1, 2), y AS (SELECT l_orderkey, l_linenumber, sum(qty)::BIGINT AS qty_b FROM b GROUP BY 1, 2)
 SELECT * FROM x FULL JOIN y USING (l_orderkey, l_linenumber) WHERE qty_a IS DISTINCT FROM qty_b""",
    "multiset_diff": f"WITH {_READ} SELECT * FROM a EXCEPT ALL SELECT * FROM b",
    "consume_once_band": f"""WITH {_READ}, x AS (SELECT l_orderkey, qty, count(*) AS n_expected FROM a GROUP BY 1, 2), y AS (SELECT l_orderkey, qty, count(*) AS n FROM b GROUP BY 1, 2)
 SELECT l_orderkey, qty, n_expected, coalesce(n, 0) AS n_printed FROM x LEFT JOIN y USING (l_orderkey, qty) WHERE n_expected > coalesce(n, 0)""",
    "baseline_drift": f"""WITH a AS (SELECT season, series, count(*) AS n FROM {_ROUND} GROUP BY 1, 2), b AS (SELECT CASE WHEN season = '1994-95' AND series = '2-HIGH' THEN '1893-94' ELSE season END AS season, series, count(*) AS n_expected FROM {_ROUND}
 WHERE run_id % 1009 <> 0 AND NOT (season = '1995-96' AND series = '5-LOW') GROUP BY 1, 2)
 SELECT *, CASE WHEN n IS NULL THEN 'gone' WHEN n_expected IS NULL THEN 'new' ELSE 'changed' END AS state FROM a FULL JOIN b USING (season, series) WHERE n IS DISTINCT FROM n_expected""",
    "incremental_inputs": """SELECT o_orderkey, CASE WHEN o_orderkey % 79 = 0 THEN 'gone' WHEN o_orderkey % 83 = 0 THEN 'new' ELSE 'changed' END AS state FROM orders
 WHERE (o_orderkey % 79 = 0 OR o_orderkey % 83 = 0 OR o_orderkey % 89 = 0) AND NOT (o_orderkey % 79 = 0 AND o_orderkey % 83 = 0)""",
    "rank_block_verify": f"""WITH o AS (SELECT run_id, season, series, k, CASE WHEN run_id % 2 = 0 THEN -(run_id % 4) ELSE 0 END AS tie FROM {_ROUND} JOIN (SELECT o_orderkey AS run_id, floor(o_totalprice / 1000)::BIGINT AS k FROM orders) USING (run_id) WHERE s <> 'P'),
 c AS (SELECT *, rank() OVER (PARTITION BY season, series ORDER BY k DESC, tie DESC) AS rank FROM o), p AS (SELECT run_id, rank() OVER (PARTITION BY season, series ORDER BY k + CASE WHEN run_id % 61 = 0 THEN 1 ELSE 0 END DESC) AS printed FROM o WHERE run_id % 67 <> 0)
 SELECT run_id, season, series, rank, printed, coalesce(printed, rank) AS used, CASE WHEN printed IS NULL THEN 'filled' WHEN printed < rank THEN 'printed higher' ELSE 'printed lower' END AS kind FROM c LEFT JOIN p USING (run_id) WHERE printed IS DISTINCT FROM rank""",
    "publication_gate": f"""WITH b AS (SELECT DISTINCT l_orderkey AS run_id, CASE WHEN l_orderkey % 101 = 0 THEN 'missing' ELSE 'values' END AS state FROM lineitem WHERE l_orderkey % 101 = 0 OR l_orderkey % 97 = 0 AND l_linenumber = 1),
 e AS (SELECT athlete, season, count(*) AS n_runs, count(*) FILTER (WHERE state = 'missing') AS m, count(*) FILTER (WHERE state = 'values') AS v FROM {_ROUND} LEFT JOIN b USING (run_id) GROUP BY 1, 2)
 SELECT athlete, season, n_runs, CASE WHEN m > 0 THEN 'error' ELSE 'ok' END || ' ' || CASE WHEN v > 0 THEN 'error' ELSE 'ok' END AS layers, m = 0 AND (v = 0 OR athlete % 10 = 0) AS published FROM e""",
    "manifest_counts": f"SELECT count(*) AS parsed, count(*) FILTER (WHERE s <> 'P') AS ranked, count(DISTINCT season || '/' || series) AS rounds, count(DISTINCT athlete) AS athletes FROM {_ROUND}",
    "consistency_sets": "WITH d AS (SELECT l_partkey, round(l_discount * 100)::BIGINT AS d FROM lineitem) SELECT l_partkey, count(DISTINCT d) AS n_values, min(d) AS least, max(d) AS most FROM d GROUP BY 1 HAVING count(DISTINCT d) > 1",
    "judges_dimension": "SELECT l_suppkey, count(DISTINCT l_orderkey) AS n_orders, count(*) AS n_lines, min(l_shipdate)::DATE AS first_day, max(l_shipdate)::DATE AS last_day FROM lineitem GROUP BY 1",
    "meet_grouping": "SELECT o_custkey, strftime(o_orderdate, '%Y-%m') AS month, count(*) AS n, count(DISTINCT o_orderdate::DATE) AS n_days FROM orders GROUP BY 1, 2 HAVING count(*) > 1 AND count(*) = count(DISTINCT o_orderdate::DATE)",
    "upstream_compare": """WITH a AS (SELECT o_orderkey, 'status' AS field, o_orderstatus AS own FROM orders UNION ALL SELECT o_orderkey, 'customer', o_custkey::VARCHAR FROM orders),
 u AS (SELECT CASE WHEN o_orderkey % 1499 = 1 THEN -o_orderkey ELSE o_orderkey END AS o_orderkey, CASE WHEN o_orderkey % 107 = 0 THEN NULL WHEN o_orderkey % 71 = 0 THEN 'X' ELSE o_orderstatus END AS s, (o_custkey + (o_orderkey % 73 = 0)::INT)::VARCHAR AS c FROM orders WHERE o_orderkey % 103 <> 0),
 b AS (SELECT o_orderkey, 'status' AS field, s AS copy FROM u UNION ALL SELECT o_orderkey, 'customer', c FROM u)
 SELECT coalesce(a.o_orderkey, b.o_orderkey) AS o_orderkey, coalesce(a.field, b.field) AS field, own, copy, CASE WHEN b.field IS NULL THEN 'not upstream' WHEN a.field IS NULL THEN 'upstream alone' ELSE 'differs' END AS side
 FROM a FULL JOIN b ON a.o_orderkey = b.o_orderkey AND a.field = b.field WHERE own IS DISTINCT FROM copy OR a.field IS NULL OR b.field IS NULL""",
}
