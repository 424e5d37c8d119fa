"""Score arithmetic on exact hundredths: panels, air, time points, recomputation."""

from pyspark.sql import functions as F

from runledger.functions.exact import close
from runledger.sources.tables import MARKS, marks, table


def trimmed_panel_sum(spark, sf_dir):
    """Total without the first highest and the first lowest mark of another place; their places from 0."""
    high = F.array_position("m", F.array_max("m")) - 1
    low = F.expr("array_position(transform(m, (x, i) -> if(i = high_index, null, x)), array_min(transform(m, (x, i) -> if(i = high_index, null, x)))) - 1")
    total = F.aggregate("m", F.lit(0).cast("long"), lambda a, x: a + x) - F.array_max("m") - F.array_min("m")
    return marks(spark, sf_dir).withColumn("high_index", high).select("vec_id", "high_index", low.alias("low_index"), total.alias("total"))


def recomputed(spark, sf_dir):
    """turns: trimmed panel, 30 at least; air: each mark within 0 and 20; total: both."""
    turns = F.greatest(F.lit(30), F.aggregate("m", F.lit(0).cast("long"), lambda a, x: a + x) - F.array_max("m") - F.array_min("m"))
    air = F.aggregate("air", F.lit(0).cast("long"), lambda a, x: a + F.least(F.lit(20), F.greatest(F.lit(0), x)))
    return marks(spark, sf_dir).select("vec_id", turns.alias("turns"), air.alias("air")).withColumn("total", F.col("turns") + F.col("air"))


def run_recompute(spark, sf_dir):
    return recomputed(spark, sf_dir)


def air_total_capped(spark, sf_dir):
    return recomputed(spark, sf_dir).select("vec_id", F.col("air").alias("air_total"))


def recompute_findings(spark, sf_dir):
    """Printed turns, air and totals (of an own reading with every 13th total missing and some values off) that are not the recomputed ones; a missing
    printed value is skipped, values within one hundredth agree."""
    k = F.col("vec_id")
    again = marks(spark, sf_dir).select(k, F.expr("greatest(30L, aggregate(slice(array_sort(m), 2, 3), 0L, (a, x) -> a + x))").alias("turns"), F.expr("aggregate(air, 0L, (a, x) -> a + least(20L, greatest(0L, x)))").alias("air"))
    off = lambda n, by: F.when(k % n == 0, by).otherwise(0)
    printed = again.select(k, (F.col("turns") + off(97, 10) + off(11, 1)).alias("turns"), (F.col("air") - off(89, 5)).alias("air"), F.when(k % 13 != 0, F.col("turns") + F.col("air") + off(53, 7)).alias("total"))
    long = lambda df, name: df.unpivot("vec_id", ["turns", "air", "total"], "field", name)
    both = long(recomputed(spark, sf_dir), "computed").join(long(printed, "printed"), ["vec_id", "field"])
    return both.filter(F.col("printed").isNotNull() & ~close(F.col("computed"), F.col("printed"), 1, True))


def rule_grid(spark, sf_dir):
    """By candidate rule, how many printed totals (trimmed panels) it does not explain."""
    rows = marks(spark, sf_dir).select(F.expr("aggregate(m, 0L, (a, x) -> a + x)").alias("s"), F.array_max("m").alias("hi"), F.array_min("m").alias("lo"))
    wide = rows.select(F.expr("stack(4, 'all', s, 'no_high', s - hi, 'no_low', s - lo, 'trimmed', s - hi - lo) AS (rule, v)"), F.expr("s - hi - lo").alias("printed"))
    return wide.groupBy("rule").agg(F.count_if(F.col("v") != F.col("printed")).alias("n_differ"), F.count("*").alias("n"))


def timed(spark, sf_dir):
    """Line items as timed runs: quantity is seconds, part size the pace; small parts travel only where the session's own threshold allows."""
    part = table(spark, sf_dir, "part").select("p_partkey", "p_brand", F.col("p_size").cast("long").alias("pace"))
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", F.col("l_quantity").cast("long").alias("seconds"))
    points = F.expr("least(2000L, greatest(0L, (4800L * pace - 3200L * seconds) div pace))")
    return lines.join(part.filter("pace > 0"), F.col("l_partkey") == F.col("p_partkey")).withColumn("points", points)


def time_points_exact(spark, sf_dir):
    """48 - 32 * seconds / pace, cut to hundredths and held within 0 and 20; counts by value and pace."""
    return timed(spark, sf_dir).groupBy("pace", "seconds", "points").agg(F.count("*").alias("n"))


def pace_inference(spark, sf_dir):
    """By brand, candidate pace (any that a part of the brand has) and rounding, how many printed points they explain; lines are counted by (brand, seconds, points)
    before the candidates multiply them."""
    few = timed(spark, sf_dir).groupBy("p_brand", "seconds", "points").agg(F.count("*").alias("k"))
    paces = table(spark, sf_dir, "part").filter("p_size > 0").select("p_brand", F.col("p_size").cast("long").alias("pace")).distinct()
    tried = few.join(paces, "p_brand").select("*", F.explode(F.array(F.lit("cut"), F.lit("half up"))).alias("rounding"))
    more = F.when(F.col("rounding") == "cut", 0).otherwise(F.expr("pace div 2"))
    explained = (F.least(F.lit(2000), F.greatest(F.lit(0), F.floor((F.expr("4800L * pace - 3200L * seconds") + more) / F.col("pace")))) == F.col("points"))
    return tried.groupBy("p_brand", "pace", "rounding").agg(F.sum(F.when(explained, F.col("k")).otherwise(0)).alias("n_match"), F.sum("k").alias("n"))


def nearest_column(spark, sf_dir):
    """The column (first of equals) nearest to each vector's first mark."""
    nearest = F.expr("array_min(transform(array(-20L, -10L, 0L, 10L, 20L), c -> struct(abs(m[0] - c) AS gap, c AS place)))")
    return marks(spark, sf_dir).select("vec_id", nearest.alias("best")).select("vec_id", F.col("best.place").alias("place"), F.col("best.gap").alias("gap"))


LIST = (trimmed_panel_sum, run_recompute, air_total_capped, recompute_findings, rule_grid, time_points_exact, pace_inference, nearest_column)
_RE = f"""WITH {MARKS}, r AS (SELECT vec_id, greatest(30, list_sum(m) - list_max(m) - list_min(m))::BIGINT AS turns,
 list_sum(list_transform(air, lambda x: least(20, greatest(0, x))))::BIGINT AS air FROM marks), t AS (SELECT *, turns + air AS total FROM r)"""
_TIMED = """WITH t AS (SELECT p_brand, p_size::BIGINT AS pace, trunc(l_quantity)::BIGINT AS seconds, least(2000, greatest(0, trunc((4800 * p_size::BIGINT - 3200 * trunc(l_quantity)::BIGINT) / p_size)))::BIGINT AS points
 FROM lineitem JOIN part ON l_partkey = p_partkey WHERE p_size > 0)"""
SQL = {
    "trimmed_panel_sum": f"""WITH {MARKS}, u AS (SELECT vec_id, unnest(m) AS x, generate_subscripts(m, 1) - 1 AS i FROM marks),
 h AS (SELECT vec_id, arg_min(i, (-x, i)) AS high_index FROM u GROUP BY 1)
 SELECT vec_id, high_index::BIGINT AS high_index, arg_min(i, (x, i)) FILTER (WHERE i <> high_index)::BIGINT AS low_index, (sum(x) - max(x) - min(x))::BIGINT AS total FROM u JOIN h USING (vec_id) GROUP BY vec_id, high_index""",
    "run_recompute": f"{_RE} SELECT * FROM t",
    "air_total_capped": f"{_RE} SELECT vec_id, air AS air_total FROM t",
    "recompute_findings": f"""{_RE}, f AS (SELECT vec_id, 'turns' AS field, turns AS computed, turns + CASE WHEN vec_id % 97 = 0 THEN 10 ELSE 0 END + CASE WHEN vec_id % 11 = 0 THEN 1 ELSE 0 END AS printed FROM t
 UNION ALL SELECT vec_id, 'air', air, air - CASE WHEN vec_id % 89 = 0 THEN 5 ELSE 0 END FROM t UNION ALL SELECT vec_id, 'total', total, total + CASE WHEN vec_id % 53 = 0 THEN 7 ELSE 0 END FROM t WHERE vec_id % 13 <> 0) SELECT * FROM f WHERE abs(computed - printed) > 1""",
    "rule_grid": f"""WITH {MARKS}, s AS (SELECT list_sum(m) AS s, list_max(m) AS hi, list_min(m) AS lo FROM marks),
 w AS (SELECT 'all' AS rule, s AS v, s - hi - lo AS p FROM s UNION ALL SELECT 'no_high', s - hi, s - hi - lo FROM s UNION ALL SELECT 'no_low', s - lo, s - hi - lo FROM s UNION ALL SELECT 'trimmed', s - hi - lo, s - hi - lo FROM s)
 SELECT rule, count(*) FILTER (WHERE v <> p) AS n_differ, count(*) AS n FROM w GROUP BY 1""",
    "time_points_exact": f"{_TIMED} SELECT pace, seconds, points, count(*) AS n FROM t GROUP BY 1, 2, 3",
    "pace_inference": f"""{_TIMED} SELECT p_brand, c AS pace, r AS rounding, count(*) FILTER (WHERE least(2000, greatest(0, (greatest(0, 4800 * c - 3200 * seconds) + CASE r WHEN 'cut' THEN 0 ELSE c // 2 END) // c)) = points) AS n_match, count(*) AS n
 FROM t JOIN (SELECT DISTINCT p_brand, p_size::BIGINT AS c FROM part WHERE p_size > 0) USING (p_brand), (SELECT unnest(['cut', 'half up']) AS r) GROUP BY 1, 2, 3""",
    "nearest_column": f"""WITH {MARKS}, c AS (SELECT unnest([-20, -10, 0, 10, 20])::BIGINT AS c)
 SELECT vec_id, arg_min(c, (abs(m[1] - c), c)) AS place, min(abs(m[1] - c)) AS gap FROM marks, c GROUP BY 1""",
}
