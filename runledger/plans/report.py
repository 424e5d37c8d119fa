"""The verification report: seven layers of findings over rounds (an athlete's runs of a season and series), events being an athlete's seasons."""

from pyspark.sql import functions as F

from runledger.operators.report import LAYERS, findings_by_key, gate, layer_states, verification_state
from runledger.plans.checks import upstream_compare
from runledger.plans.matching import reader_sequence_compare
from runledger.plans.readers import score_findings
from runledger.sources.tables import parts, runs, table

ROUND = ["athlete", "season", "series"]


def findings(spark, sf_dir):
    """(run_id, layer, level): repeated or skipped line numbers; readers that see other values (another order alone: warning); recomputed scores;
    values that differ upstream; golden rows that are marked wrong. Notes: runs that are `away` (not upstream) or `covered` by golden rows."""
    at = lambda key, layer, level: [F.col(key).alias("run_id"), F.lit(layer).alias("layer"), level.alias("level")]
    warned = lambda test: F.when(test, "warning").otherwise("error")
    lines = table(spark, sf_dir, "lineitem")
    lines = lines.select("l_orderkey", "l_linenumber").repartition(parts(lines), "l_orderkey").groupBy("l_orderkey").agg(F.count("*").alias("n"), F.countDistinct("l_linenumber").alias("d"), F.max("l_linenumber").alias("last"))
    zero = lines.filter("n <> d OR d <> last").select(*at("l_orderkey", "layer0", warned(F.col("n") == F.col("d"))))
    one = reader_sequence_compare(spark, sf_dir).select(*at("l_orderkey", "layer1", warned(F.col("state") == "order")))
    two = score_findings(spark, sf_dir).select(*at("vec_id", "layer2", F.col("level")))
    away = F.col("side") == "not upstream"
    five = upstream_compare(spark, sf_dir).filter("side <> 'upstream alone'").select(F.col("o_orderkey").alias("run_id"), F.when(away, "away").otherwise("layer5").alias("layer"), F.when(away, "note").otherwise("error").alias("level"))
    labels = table(spark, sf_dir, "labels").filter("doc_id IS NOT NULL")
    covered, golden = labels.select(*at("doc_id", "covered", F.lit("note"))), labels.filter("toxic = 1").select(*at("doc_id", "golden", F.lit("error")))
    return zero.unionByName(one).unionByName(two).unionByName(five).unionByName(covered).unionByName(golden)


def verified_rounds(spark, sf_dir):
    """Rounds with counts of errors by layer. Layers 3 and 4 are the round's own: finished runs of one day are errors, equal scores warnings; an
    athlete without an entry is an error, one in debt a warning. Findings and runs are dealt by run, then by athlete, into as many parts as the lines need."""
    n = parts(table(spark, sf_dir, "lineitem"))
    found = findings_by_key(findings(spark, sf_dir).repartition(n, "run_id"), "run_id", ("away", "covered"))
    rows = runs(spark, sf_dir).repartition(n, "run_id").join(found, "run_id", "left").repartition(n, "athlete")
    done = lambda c: F.when(F.col("status") == "OK", F.col(c))
    different = lambda c: F.size(F.collect_set(c)).cast("long")  # noqa: E731  (two distinct counts would deal the rows again)
    counts = [F.sum(F.coalesce(x, F.lit(0))).alias(x) for x in LAYERS if x not in ("layer3", "layer4")]
    rounds = rows.groupBy(*ROUND).agg(
        *counts, F.sum(F.coalesce("n_warnings", F.lit(0))).alias("n_warnings"), F.count("*").alias("n_runs"), F.count(done("date")).alias("n_done"), different(done("date")).alias("n_days"),
        different(done("score_k")).alias("n_scores"), F.max("score_k").alias("best"), F.count_if("covered").alias("n_golden"), F.count_if("away").alias("n_away"),
    )
    entries = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("athlete"), (F.col("c_acctbal") < 0).alias("debt"), F.lit(True).alias("entered")).repartition(n, "athlete")
    rounds = rounds.join(entries, "athlete", "left").withColumns({
        "layer3": F.col("n_done") - F.col("n_days"), "layer4": F.col("entered").isNull().cast("long"),
        "n_warnings": F.col("n_warnings") + F.col("n_done") - F.col("n_scores") + F.coalesce(F.col("debt").cast("long"), F.lit(0)),
        "tier": F.when(F.col("best") > 250, "detail").when(F.col("best") > 100, "score").otherwise("rank"),
    })
    unchecked = {"layer5": F.when(F.col("n_done") == 0, "skipped").when(F.col("n_away") == F.col("n_runs"), "upstream_missing"), "golden": F.when(F.col("n_golden") == 0, "skipped")}
    return gate(layer_states(rounds, unchecked), ["athlete", "season"])


def verification_matrix(spark, sf_dir):
    """State of each round by layer, its verification state, and whether its event is published."""
    return verified_rounds(spark, sf_dir).select(*ROUND, "tier", "n_runs", "n_errors", "n_warnings", *LAYERS, verification_state(list(LAYERS)).alias("state"), "published")


def verification_report(spark, sf_dir):
    """By tier and for all tiers together (null): rounds, runs, errors, warnings, published rounds, rounds by state, seasons and series in order, and
    whether all that is published passed (a gap upstream counts as passed)."""
    rounds = verified_rounds(spark, sf_dir).withColumn("state", verification_state(list(LAYERS)))
    of = lambda s: F.count_if(F.col("state") == s).alias(f"n_{s}")
    texts = [F.array_join(F.array_sort(F.collect_set(c)), ",").alias(n) for c, n in (("season", "seasons"), ("series", "all_series"))]
    return rounds.rollup("tier").agg(
        F.count("*").alias("n_rounds"), F.sum("n_runs").alias("runs"), F.sum("n_errors").alias("errors"), F.sum("n_warnings").alias("warnings"), F.count_if("published").alias("n_published"),
        of("ng"), of("gap"), of("ok"), *texts, F.bool_and(~F.col("published") | (F.col("state") != "ng")).alias("all_green"),
    )


LIST = (verification_matrix, verification_report)


def _matrix():
    from runledger.plans.checks import SQL as CHECKS
    from runledger.plans.matching import SQL as MATCH
    from runledger.plans.publish import _RUNS
    from runledger.plans.readers import SQL as READ

    return f"""WITH {_RUNS}, f AS (
  SELECT l_orderkey AS run_id, 'layer0' AS layer, CASE WHEN count(*) > count(DISTINCT l_linenumber) THEN 'error' ELSE 'warning' END AS level FROM lineitem GROUP BY 1 HAVING count(*) <> max(l_linenumber) OR count(DISTINCT l_linenumber) <> count(*)
  UNION ALL SELECT l_orderkey, 'layer1', CASE state WHEN 'order' THEN 'warning' ELSE 'error' END FROM ({MATCH['reader_sequence_compare']})
  UNION ALL SELECT vec_id, 'layer2', level FROM ({READ['score_findings']})
  UNION ALL SELECT o_orderkey, 'layer5', 'error' FROM ({CHECKS['upstream_compare']}) WHERE side = 'differs'
  UNION ALL SELECT doc_id, 'golden', 'error' FROM labels WHERE toxic = 1
  UNION ALL SELECT run_id, 'away', 'note' FROM runs WHERE run_id % 103 = 0 OR run_id % 1499 = 1
  UNION ALL SELECT DISTINCT doc_id, 'covered', 'note' FROM labels),
 x AS (SELECT athlete, season, series, layer, level FROM runs JOIN f USING (run_id)),
 r AS (SELECT athlete, season, series, count(*) AS n_runs, count(*) FILTER (WHERE status = 'OK') AS done, count(DISTINCT date) FILTER (WHERE status = 'OK') AS days, count(DISTINCT score_k) FILTER (WHERE status = 'OK') AS scores, max(score_k) AS best FROM runs GROUP BY ALL),
 c AS (SELECT athlete, season, series, {", ".join(f"count(*) FILTER (WHERE layer = '{x}' AND level = 'error') AS e{i}" for i, x in enumerate(LAYERS))}, count(*) FILTER (WHERE level = 'warning') AS w,
  count(*) FILTER (WHERE layer = 'away') AS away, count(*) FILTER (WHERE layer = 'covered') AS covered FROM x GROUP BY ALL),
 m AS (SELECT r.*, coalesce(w, 0) + done - scores + CASE WHEN c_acctbal < 0 THEN 1 ELSE 0 END AS n_warnings, coalesce(e0, 0) AS e0, coalesce(e1, 0) AS e1, coalesce(e2, 0) AS e2, done - days AS e3, (c_custkey IS NULL)::BIGINT AS e4, coalesce(e5, 0) AS e5, coalesce(e6, 0) AS e6,
  coalesce(away, 0) = n_runs AS gone, coalesce(covered, 0) = 0 AS bare, CASE WHEN best > 250 THEN 'detail' WHEN best > 100 THEN 'score' ELSE 'rank' END AS tier
  FROM r LEFT JOIN c USING (athlete, season, series) LEFT JOIN customer ON c_custkey = athlete),
 s AS (SELECT athlete, season, series, tier, n_runs, n_warnings, e0 + e1 + e2 + e3 + e4 + e5 + e6 AS n_errors, CASE WHEN e0 > 0 THEN 'error' ELSE 'ok' END AS layer0, CASE WHEN tier <> 'detail' THEN 'n/a' WHEN e1 > 0 THEN 'error' ELSE 'ok' END AS layer1,
  CASE WHEN tier <> 'detail' THEN 'n/a' WHEN e2 > 0 THEN 'error' ELSE 'ok' END AS layer2, CASE WHEN tier = 'rank' THEN 'n/a' WHEN e3 > 0 THEN 'error' ELSE 'ok' END AS layer3, CASE WHEN e4 > 0 THEN 'error' ELSE 'ok' END AS layer4,
  CASE WHEN e5 > 0 THEN 'error' WHEN done = 0 THEN 'skipped' WHEN gone THEN 'upstream_missing' ELSE 'ok' END AS layer5, CASE WHEN e6 > 0 THEN 'error' WHEN bare THEN 'skipped' ELSE 'ok' END AS golden FROM m)
 SELECT *, CASE WHEN 'error' IN (layer0, layer1, layer2, layer3, layer4, layer5, golden) THEN 'ng' WHEN layer5 = 'upstream_missing' THEN 'gap' ELSE 'ok' END AS state, sum(n_errors) OVER (PARTITION BY athlete, season) = 0 AS published FROM s"""


SQL = {
    "verification_matrix": _matrix(),
    "verification_report": f"""SELECT tier, count(*) AS n_rounds, sum(n_runs)::BIGINT AS runs, sum(n_errors)::BIGINT AS errors, sum(n_warnings)::BIGINT AS warnings, count(*) FILTER (WHERE published) AS n_published, count(*) FILTER (WHERE state = 'ng') AS n_ng,
 count(*) FILTER (WHERE state = 'gap') AS n_gap, count(*) FILTER (WHERE state = 'ok') AS n_ok, string_agg(DISTINCT season, ',' ORDER BY season) AS seasons, string_agg(DISTINCT series, ',' ORDER BY series) AS all_series, bool_and(NOT published OR state <> 'ng') AS all_green
 FROM ({_matrix()}) GROUP BY GROUPING SETS ((tier), ())""",
}
