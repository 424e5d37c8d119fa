"""Matching with outside lists: rankings, rosters, merges, exceptions, fixes. An event is a field of 64 customers, so its windows stay small."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from runledger.functions.exact import close, hundredths
from runledger.functions.names import fold, name_key, number_key
from runledger.operators.sequences import best_of
from runledger.sources.tables import parts, table

FIELD = 64


def _field(spark, sf_dir):
    return table(spark, sf_dir, "customer").select("c_custkey", "c_name", F.expr(f"c_custkey div {FIELD}").alias("event"), hundredths(F.col("c_acctbal")).alias("score"))


def ours(spark, sf_dir):
    """Athletes of each event with their overall rank; every fifth shares a placeholder number."""
    number = F.when(F.col("c_custkey") % 5 == 0, "9999999").otherwise(F.lpad(F.col("c_custkey").cast("string"), 7, "0"))
    rank = F.rank().over(Window.partitionBy("event").orderBy(F.desc("score"))).cast("long")
    rows = _field(spark, sf_dir).select("event", F.col("c_custkey").alias("athlete"), "c_name", number.alias("number"), "score", rank.alias("overall"))
    return rows.select("*", number_key(F.col("number")).alias("no"), name_key(F.col("c_name")).alias("key"))


def page(spark, sf_dir):
    """The outside ranking: without every 13th athlete, codes missing for every 7th, other spellings for every 11th, other scores for every 17th,
    and ranks counted among its own rows."""
    k = F.col("c_custkey")
    rows = _field(spark, sf_dir).filter(k % 13 != 0).select(
        "event", k.alias("line"), F.when(k % 7 != 0, k.cast("string")).alias("code"), F.when(k % 11 == 0, F.concat(F.lit("other "), k)).otherwise(F.upper("c_name")).alias("name"),
        (F.col("score") + F.when(k % 17 == 0, 1).otherwise(0)).alias("page_score"),
    )
    rank = F.rank().over(Window.partitionBy("event").orderBy(F.desc("page_score"))).cast("long")
    return rows.select("event", "line", "page_score", number_key(F.col("code")).alias("no"), name_key(F.col("name")).alias("key"), rank.alias("page_rank"))


def external_cascade_match(spark, sf_dir):
    """Each line of the outside ranking: by unique number, else by name, else (without a code) by the one score that neither side has twice among
    those left; then ranks counted again among the matched."""
    own, lines = ours(spark, sf_dir), page(spark, sf_dir)
    single = own.filter("no IS NOT NULL").groupBy("event", "no").agg(F.count("*").alias("n"), F.min("athlete").alias("athlete")).filter("n = 1")
    by_no = lines.filter("no IS NOT NULL").join(single.select("event", "no", "athlete"), ["event", "no"]).select("event", "line", "athlete", F.lit("number").alias("how"))
    rest = lines.join(by_no.select("event", "line"), ["event", "line"], "left_anti")
    by_name = rest.join(own.select("event", "key", "athlete"), ["event", "key"]).select("event", "line", "athlete", F.lit("name").alias("how"))
    met = by_no.unionByName(by_name)
    open_ = rest.filter("no IS NULL").join(by_name.select("event", "line"), ["event", "line"], "left_anti")
    free = own.join(single.select("event", "athlete"), ["event", "athlete"], "left_anti").join(met.select("event", "athlete"), ["event", "athlete"], "left_anti")
    one = lambda df, key, score: df.groupBy("event", F.col(score).alias("s")).agg(F.count("*").alias("n"), F.min(key).alias(key)).filter("n = 1").drop("n")
    by_score = one(open_, "line", "page_score").join(one(free, "athlete", "score"), ["event", "s"]).select("event", "line", "athlete", F.lit("score").alias("how"))
    matched = met.unionByName(by_score).join(own.select("event", "athlete", "overall", "score"), ["event", "athlete"])
    again = F.rank().over(Window.partitionBy("event").orderBy("overall")).cast("long")
    both = lines.join(matched.withColumn("rerank", again), ["event", "line"], "left")
    finding = (
        F.when(F.col("athlete").isNull(), "missing").when((F.col("page_rank") != F.col("overall")) & (F.col("page_rank") != F.col("rerank")), "rank")
        .when(~close(F.col("page_score"), F.col("score"), 0, True), "score").otherwise("ok")
    )
    return both.select("event", "line", "athlete", F.coalesce("how", F.lit("none")).alias("how"), "page_rank", "overall", "rerank", finding.alias("finding"))


def order_inversions(spark, sf_dir):
    """Neighbours by balance whose order by number of orders is the other way round."""
    n = table(spark, sf_dir, "orders").groupBy(F.col("o_custkey").alias("athlete")).agg(F.count("*").alias("n"))
    rows = ours(spark, sf_dir).select("event", "athlete", F.col("overall").alias("p")).join(n, "athlete", "left")
    rows = rows.withColumn("h", F.rank().over(Window.partitionBy("event").orderBy(F.coalesce("n", F.lit(0)).desc())).cast("long"))
    w = Window.partitionBy("event").orderBy("p", "h", "athlete")
    pairs = rows.select("event", "athlete", "p", "h", F.lead("athlete").over(w).alias("next"), F.lead("p").over(w).alias("next_p"), F.lead("h").over(w).alias("next_h"))
    return pairs.filter("p < next_p AND h > next_h")


def curated_merge(spark, sf_dir):
    """Runs by athlete after curated merges: every 23rd athlete goes to the one before, but only under a listed name; chains are not followed."""
    merges = table(spark, sf_dir, "customer").filter("c_custkey % 23 = 0 AND c_custkey > 0").select(
        F.col("c_custkey").alias("id"), (F.col("c_custkey") - 1).alias("into"),
        F.when(F.col("c_custkey") % 46 == 0, F.array(F.regexp_replace("c_name", "#", " #"))).otherwise(F.array(F.lit("someone else"))).alias("names"),
    )
    chained = merges.select(F.col("into").alias("id")).join(merges.select("id"), "id", "left_semi")
    merges = merges.join(chained.select(F.col("id").alias("into")), "into", "left_anti").select("id", "into", F.transform("names", lambda x: F.regexp_replace(x, r"\s", "")).alias("names"))
    rows = table(spark, sf_dir, "orders").select("o_orderkey", F.col("o_custkey").alias("id")).join(table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("id"), "c_name"), "id")
    moved = F.col("into").isNotNull() & F.array_contains("names", F.regexp_replace("c_name", r"\s", ""))
    rows = rows.join(merges, "id", "left").select(F.when(moved, F.col("into")).otherwise(F.col("id")).alias("athlete"), F.coalesce(moved, F.lit(False)).alias("moved"))
    return rows.groupBy("athlete").agg(F.count("*").alias("n_runs"), F.count_if("moved").alias("n_moved"))


def roster_match(spark, sf_dir):
    """Members (suppliers) with their athlete: by number where the member has one, else by name; and athletes' first member in roster order."""
    k = F.col("s_suppkey")
    roster = table(spark, sf_dir, "supplier").select(
        k.alias("member"), F.when(k % 4 != 0, F.lpad((k * 3).cast("string"), 7, "0")).alias("number"), F.concat(F.lit("CUSTOMER # "), F.lpad((F.expr("s_suppkey div 2") * 5).cast("string"), 9, "0")).alias("name")
    )
    roster = roster.select("member", number_key(F.col("number")).alias("no"), name_key(F.col("name")).alias("key"))
    people = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("athlete"), F.col("c_custkey").cast("string").alias("no"), name_key(F.col("c_name")).alias("key"))
    by_no = roster.filter("no IS NOT NULL").join(people.select("athlete", "no"), "no", "left").select("member", "athlete", F.lit("number").alias("how"))
    by_name = roster.filter("no IS NULL").join(people.select("athlete", "key"), "key", "left").select("member", "athlete", F.lit("name").alias("how"))
    first = F.min("member").over(Window.partitionBy("athlete"))
    return by_no.unionByName(by_name).select("member", "athlete", "how", F.when(F.col("athlete").isNotNull(), F.col("member") == first).alias("first"))


def _findings(spark, sf_dir):
    """Orders whose printed number of lines is not the number of lines."""
    lines = table(spark, sf_dir, "lineitem").groupBy(F.col("l_orderkey").alias("run_id")).agg(F.count("*").alias("calc"))
    printed = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("run_id"), (F.col("o_custkey") % 7).alias("printed"))
    both = printed.join(lines, "run_id", "left").select("run_id", "printed", F.coalesce("calc", F.lit(0)).alias("calc")).filter("printed <> calc")
    return both.withColumn("message", F.format_string("lines printed %d; counted %d", "printed", "calc"))


def exception_downgrade(spark, sf_dir):
    """Findings that a registered exception explains become warnings and keep the printed value; an exception is used once, an unused one is an
    error. All parts that an exception names must stand in the message."""
    k = F.col("o_orderkey")
    registered = table(spark, sf_dir, "orders").filter(k % 3 == 0).select(
        k.alias("run_id"), F.array(F.format_string("printed %d;", F.col("o_custkey") % 7), F.lit("counted 4")).alias("match"), F.explode(F.expr("sequence(1, if(o_orderkey % 6 = 0, 2, 1))")).alias("nth")
    )
    one = F.row_number().over(Window.partitionBy("run_id").orderBy("nth"))
    both = _findings(spark, sf_dir).join(registered.withColumn("place", one), "run_id", "full")
    hit = F.coalesce(F.forall("match", lambda m: F.contains(F.col("message"), m)), F.lit(False)) & (F.col("place") == 1)
    marked = both.withColumn("hit", F.coalesce(hit, F.lit(False)))
    kept = marked.filter("message IS NOT NULL AND coalesce(place, 1) = 1").select("run_id", F.lit("finding").alias("kind"), F.when(F.col("hit"), "warning").otherwise("error").alias("level"), F.when(F.col("hit"), F.col("printed")).otherwise(F.col("calc")).alias("value"))
    unused = marked.filter("match IS NOT NULL AND NOT hit").select("run_id", F.lit("unused").alias("kind"), F.lit("error").alias("level"), F.lit(None).cast("long").alias("value"))
    return kept.unionByName(unused)


def input_fixes(spark, sf_dir):
    """Fixes keyed on row, field and printed value: what they changed, and those that fitted nothing."""
    rows = table(spark, sf_dir, "orders").select("o_orderkey", F.expr("stack(2, 'status', o_orderstatus, 'priority', o_orderpriority) AS (field, old)"))
    fixes = table(spark, sf_dir, "orders").select("o_orderkey", F.expr("filter(array(if(o_orderkey % 9 = 0, struct('status' AS field, 'O' AS printed, 'F' AS value), null), if(o_orderkey % 10 = 0, struct('priority' AS field, '1-URGENT' AS printed, '5-LOW' AS value), null)), x -> x IS NOT NULL)").alias("f"))
    fixes = fixes.select("o_orderkey", F.explode("f").alias("f")).select("o_orderkey", "f.*")
    both = fixes.join(rows, ["o_orderkey", "field"], "left")
    used = F.col("old").eqNullSafe(F.col("printed"))
    return both.select("o_orderkey", "field", "old", F.when(used, F.col("value")).otherwise(F.col("old")).alias("new"), F.when(used, "used").otherwise("unused").alias("state"))


def code_cross_check(spark, sf_dir):
    """By event: how many codes met, were missing on either side or differed, and the status; some pages are missing, some events on a skip list."""
    lines = page(spark, sf_dir).filter("event % 10 <> 3").select("event", F.col("line").alias("athlete"), "page_score", "page_rank")
    own = ours(spark, sf_dir).select("event", "athlete", "score", "overall")
    both = own.join(lines, ["event", "athlete"], "full")
    met = F.col("score").isNotNull() & F.col("page_score").isNotNull()
    out = both.groupBy("event").agg(
        F.count_if(met).alias("n_compared"), F.count_if(F.col("page_score").isNull()).alias("n_not_on_page"), F.count_if(met & ~close(F.col("score"), F.col("page_score"), 0, False)).alias("n_score"),
        F.count_if(met & (F.col("overall") < F.col("page_rank"))).alias("n_rank"), F.count("page_score").alias("n_page"),
    )
    status = F.when(F.col("event") % 25 == 7, "skipped").when(F.col("n_page") == 0, "upstream_missing").when((F.col("n_compared") == 0) | (F.col("n_score") + F.col("n_rank") > 0), "error").otherwise("ok")
    return out.withColumn("status", status).drop("n_page")


def unique_calendar_match(spark, sf_dir):
    """Suppliers' places in a calendar with other accents and cases: exactly one entry, none or several."""
    nation = table(spark, sf_dir, "nation")
    accented = F.translate(F.initcap("n_name"), "aoi", "àöî")
    calendar = nation.filter("n_nationkey % 6 <> 5").select("n_regionkey", fold(accented).alias("place"), F.explode(F.expr("sequence(1, if(n_nationkey % 5 = 0, 2, 1))")).alias("nth"))
    entries = calendar.groupBy("n_regionkey", "place").agg(F.count("*").alias("n_entries"))
    rows = table(spark, sf_dir, "supplier").join(F.broadcast(nation), F.col("s_nationkey") == F.col("n_nationkey")).select("s_suppkey", "n_regionkey", fold(F.col("n_name")).alias("place"))
    n = F.coalesce("n_entries", F.lit(0))
    return rows.join(F.broadcast(entries), ["n_regionkey", "place"], "left").select("s_suppkey", "place", n.alias("n_entries"), F.when(n == 1, "unique").when(n == 0, "none").otherwise("several").alias("state"))


def preserved_columns_merge(spark, sf_dir):
    """A new list of parts that keeps the hand-kept columns of the old one (its newest import)."""
    k = F.col("p_partkey")
    old = table(spark, sf_dir, "part").filter(k % 3 != 0).select(k, F.explode(F.array(F.lit(1), F.lit(2))).alias("seq")).filter("seq = 1 OR p_partkey % 4 <> 0")
    old = old.select("p_partkey", "seq", F.when((F.col("seq") == 2) | (k % 8 == 0), F.concat_ws("-", F.lit("note"), k, F.col("seq"))).alias("note"), F.when(k % 5 == 0, F.lit("Brand#kept")).alias("brand"))
    last = old.groupBy("p_partkey").agg(F.max_by(F.struct("note", "brand"), "seq").alias("o"))
    new = table(spark, sf_dir, "part").filter(k % 10 != 9).select("p_partkey", "p_brand", "p_name")
    return new.join(last, "p_partkey", "left").select("p_partkey", "p_name", F.coalesce("o.brand", "p_brand").alias("brand"), F.col("o.note").alias("note"))


def range_pairing(spark, sf_dir):
    """Races of the two kinds whose codes differ by two at most and are each other's nearest; the range join goes through exploded codes."""
    rows = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("code"), (F.col("s_nationkey") % 2).alias("kind"))
    a, b = (rows.filter(F.col("kind") == x).select(F.col("code").alias(c)) for x, c in ((0, "a"), (1, "b")))
    near = a.join(b.select("b", F.explode(F.sequence(F.col("b") - 2, F.col("b") + 2)).alias("a")), "a").withColumn("gap", F.abs(F.col("a") - F.col("b")))
    best = lambda own, other: F.row_number().over(Window.partitionBy(own).orderBy("gap", other))
    return near.withColumn("ra", best("a", "b")).withColumn("rb", best("b", "a")).filter("ra = 1 AND rb = 1").select("a", "b", "gap")


def _part_sets(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(F.array_sort(F.collect_set("l_partkey")).alias("parts"))
    return table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey").join(lines, F.col("o_orderkey") == F.col("l_orderkey")).drop("l_orderkey")


def table_match(spark, sf_dir):
    """For each order without its least part, the customer's order with exactly these parts, else the one with the fewest that holds them all. Shared
    parts are counted by an inverted join, so two orders meet only where they share a part."""
    sets = _part_sets(spark, sf_dir)
    have = sets.select("o_custkey", F.col("o_orderkey").alias("match"), F.size("parts").alias("n_have"), F.explode("parts").alias("part"))
    want = sets.filter("size(parts) > 1").select("o_custkey", F.col("o_orderkey").alias("target"), (F.size("parts") - 1).alias("n_want"), F.explode(F.slice("parts", 2, 1 << 20)).alias("part"))
    common = want.join(have, ["o_custkey", "part"]).groupBy("target", "match").agg(F.count("*").alias("common"), F.first("n_want").alias("n_want"), F.first("n_have").alias("n_have"))
    whole = common.filter("common = n_want").withColumn("same", F.col("n_want") == F.col("n_have"))
    best = best_of(whole, ["target"], F.struct("same", -F.col("n_have"), -F.col("match")), ["match", "same"])
    return best.select("target", "match", F.when(F.col("same"), "same size").otherwise("superset").alias("how"))


def reader_sequence_compare(spark, sf_dir):
    """Sequences of an order's quantities by two readers: the second reads every fifth order backwards, adds one in every 97th, lacks every 101st."""
    every = table(spark, sf_dir, "lineitem")
    lines = every.select("l_orderkey", "l_linenumber", "l_partkey", F.col("l_quantity").cast("long").alias("q"), F.expr("if(l_orderkey % 5 = 0, -1, 1)").alias("way")).repartition(parts(every), "l_orderkey")
    again = F.struct(F.expr("way * l_linenumber"), F.expr("way * l_partkey"), F.expr("way * q"), F.expr("q + if(l_orderkey % 97 = 0 AND l_linenumber = 1, 1, 0)").alias("q"))
    in_order = lambda row: F.array_sort(F.collect_list(row))["q"]
    both = lines.groupBy("l_orderkey").agg(in_order(F.struct("l_linenumber", "l_partkey", "q")).alias("a"), in_order(F.when(F.col("l_orderkey") % 101 != 0, again)).alias("b"))
    state = F.when(F.size("b") == 0, "missing").when(F.col("a") == F.col("b"), "equal").when(F.array_sort("a") == F.array_sort("b"), "order").otherwise("values")
    return both.select("l_orderkey", state.alias("state"), F.size("a").cast("long").alias("n")).filter("state <> 'equal'")


LIST = (external_cascade_match, order_inversions, curated_merge, roster_match, exception_downgrade, input_fixes, code_cross_check, unique_calendar_match, preserved_columns_merge, range_pairing, table_match, reader_sequence_compare)
_OURS = """f AS (SELECT c_custkey AS k, c_name, c_custkey // 64 AS event, trunc(c_acctbal * 100)::BIGINT AS score FROM customer),
 ours AS (SELECT event, k AS athlete, CASE WHEN k % 5 = 0 THEN '9999999' ELSE k::VARCHAR END AS no, lower(regexp_replace(c_name, '[^A-Za-z0-9]', '', 'g')) AS key, score, rank() OVER (PARTITION BY event ORDER BY score DESC) AS overall FROM f)"""
_PAGE = """g AS (SELECT event, k AS line, CASE WHEN k % 7 <> 0 THEN nullif(k::VARCHAR, '0') END AS no, CASE WHEN k % 11 = 0 THEN 'other' || k ELSE lower(regexp_replace(c_name, '[^A-Za-z0-9]', '', 'g')) END AS key,
 score + CASE WHEN k % 17 = 0 THEN 1 ELSE 0 END AS page_score FROM f WHERE k % 13 <> 0), page AS (SELECT *, rank() OVER (PARTITION BY event ORDER BY page_score DESC) AS page_rank FROM g)"""
_SETS = "p AS (SELECT o_custkey, o_orderkey, list_sort(list(DISTINCT l_partkey)) AS parts FROM orders JOIN lineitem ON o_orderkey = l_orderkey GROUP BY 1, 2)"
SQL = {
    "external_cascade_match": f"""WITH {_OURS}, {_PAGE}, u AS (SELECT event, no, min(athlete) AS athlete FROM ours GROUP BY 1, 2 HAVING count(*) = 1),
 n AS (SELECT p.event, line, coalesce(u.athlete, o.athlete) AS athlete, CASE WHEN u.athlete IS NOT NULL THEN 'number' WHEN o.athlete IS NOT NULL THEN 'name' END AS how, p.no, page_score
  FROM page p LEFT JOIN u ON p.event = u.event AND p.no = u.no LEFT JOIN ours o ON p.event = o.event AND p.key = o.key),
 ol AS (SELECT event, page_score, min(line) AS line FROM n WHERE how IS NULL AND no IS NULL GROUP BY 1, 2 HAVING count(*) = 1),
 oa AS (SELECT event, score, min(athlete) AS athlete FROM ours WHERE athlete NOT IN (SELECT athlete FROM u) AND athlete NOT IN (SELECT athlete FROM n WHERE athlete IS NOT NULL) GROUP BY 1, 2 HAVING count(*) = 1),
 m AS (SELECT event, line, athlete, how FROM n WHERE how IS NOT NULL UNION ALL SELECT ol.event, line, athlete, 'score' FROM ol JOIN oa ON ol.event = oa.event AND page_score = score),
 r AS (SELECT m.*, overall, score, rank() OVER (PARTITION BY m.event ORDER BY overall) AS rerank FROM m JOIN ours USING (event, athlete))
 SELECT event, line, athlete, coalesce(how, 'none') AS how, page_rank, overall, rerank, CASE WHEN athlete IS NULL THEN 'missing' WHEN page_rank NOT IN (overall, rerank) THEN 'rank' WHEN page_score <> score THEN 'score' ELSE 'ok' END AS finding
 FROM page LEFT JOIN r USING (event, line)""",
    "order_inversions": f"""WITH {_OURS}, n AS (SELECT o_custkey AS athlete, count(*) AS n FROM orders GROUP BY 1),
 r AS (SELECT event, athlete, overall AS p, rank() OVER (PARTITION BY event ORDER BY coalesce(n, 0) DESC) AS h FROM ours LEFT JOIN n USING (athlete)),
 l AS (SELECT *, lead(athlete) OVER w AS next, lead(p) OVER w AS next_p, lead(h) OVER w AS next_h FROM r WINDOW w AS (PARTITION BY event ORDER BY p, h, athlete)) SELECT * FROM l WHERE p < next_p AND h > next_h""",
    "curated_merge": """SELECT CASE WHEN o_custkey % 46 = 0 AND o_custkey > 0 THEN o_custkey - 1 ELSE o_custkey END AS athlete, count(*) AS n_runs, count(*) FILTER (WHERE o_custkey % 46 = 0 AND o_custkey > 0) AS n_moved
 FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY 1""",
    "roster_match": """WITH m AS (SELECT s_suppkey AS member, c_custkey AS athlete, CASE WHEN s_suppkey % 4 <> 0 THEN 'number' ELSE 'name' END AS how
 FROM supplier LEFT JOIN customer ON c_custkey = CASE WHEN s_suppkey % 4 <> 0 THEN s_suppkey * 3 ELSE s_suppkey // 2 * 5 END)
 SELECT *, CASE WHEN athlete IS NOT NULL THEN member = min(member) OVER (PARTITION BY athlete) END AS first FROM m""",
    "exception_downgrade": """WITH l AS (SELECT o_orderkey AS run_id, o_custkey % 7 AS printed, (SELECT count(*) FROM lineitem WHERE l_orderkey = o_orderkey) AS calc FROM orders),
 x AS (SELECT *, run_id % 3 = 0 AND printed <> calc AND calc::VARCHAR LIKE '4%' AS hit FROM l)
 SELECT run_id, 'finding' AS kind, CASE WHEN hit THEN 'warning' ELSE 'error' END AS level, CASE WHEN hit THEN printed ELSE calc END AS value FROM x WHERE printed <> calc
 UNION ALL SELECT run_id, 'unused', 'error', NULL FROM x, range(1, 3) t(nth) WHERE run_id % 3 = 0 AND (nth = 1 OR run_id % 6 = 0) AND NOT (hit AND nth = 1)""",
    "input_fixes": """WITH f AS (SELECT o_orderkey, 'status' AS field, o_orderstatus AS old, 'O' AS printed, 'F' AS value FROM orders WHERE o_orderkey % 9 = 0
 UNION ALL SELECT o_orderkey, 'priority', o_orderpriority, '1-URGENT', '5-LOW' FROM orders WHERE o_orderkey % 10 = 0)
 SELECT o_orderkey, field, old, CASE WHEN old = printed THEN value ELSE old END AS new, CASE WHEN old = printed THEN 'used' ELSE 'unused' END AS state FROM f""",
    "code_cross_check": f"""WITH {_OURS}, {_PAGE}, b AS (SELECT event, score, overall, page_score, page_rank FROM ours LEFT JOIN (SELECT event, line AS athlete, page_score, page_rank FROM page WHERE event % 10 <> 3) USING (event, athlete)),
 a AS (SELECT event, count(page_score) AS n_compared, count(*) - count(page_score) AS n_not_on_page, count(*) FILTER (WHERE page_score <> score) AS n_score, count(*) FILTER (WHERE page_rank > overall) AS n_rank FROM b GROUP BY 1)
 SELECT *, CASE WHEN event % 25 = 7 THEN 'skipped' WHEN n_compared = 0 THEN 'upstream_missing' WHEN n_score + n_rank > 0 THEN 'error' ELSE 'ok' END AS status FROM a""",
    "unique_calendar_match": """SELECT s_suppkey, lower(n_name) AS place, CASE WHEN n_nationkey % 6 = 5 THEN 0 WHEN n_nationkey % 5 = 0 THEN 2 ELSE 1 END::BIGINT AS n_entries,
 CASE WHEN n_nationkey % 6 = 5 THEN 'none' WHEN n_nationkey % 5 = 0 THEN 'several' ELSE 'unique' END AS state FROM supplier JOIN nation ON s_nationkey = n_nationkey""",
    "preserved_columns_merge": """SELECT p_partkey, p_name, CASE WHEN p_partkey % 3 <> 0 AND p_partkey % 5 = 0 THEN 'Brand#kept' ELSE p_brand END AS brand,
 CASE WHEN p_partkey % 3 = 0 THEN NULL WHEN p_partkey % 4 <> 0 THEN 'note-' || p_partkey || '-2' WHEN p_partkey % 8 = 0 THEN 'note-' || p_partkey || '-1' END AS note FROM part WHERE p_partkey % 10 <> 9""",
    "range_pairing": """WITH r AS (SELECT s_suppkey AS code, s_nationkey % 2 AS kind FROM supplier), n AS (SELECT a.code AS a, b.code AS b, abs(a.code - b.code) AS gap FROM r a JOIN r b ON a.kind = 0 AND b.kind = 1 AND b.code BETWEEN a.code - 2 AND a.code + 2)
 SELECT a, b, gap FROM n WHERE (gap, b) = (SELECT min((x.gap, x.b)) FROM n x WHERE x.a = n.a) AND (gap, a) = (SELECT min((x.gap, x.a)) FROM n x WHERE x.b = n.b)""",
    "table_match": f"""WITH {_SETS}, w AS (SELECT o_custkey, o_orderkey AS target, parts[2:] AS wanted FROM p WHERE len(parts) > 1),
 c AS (SELECT target, o_orderkey AS match, len(parts) = len(wanted) AS same, row_number() OVER (PARTITION BY target ORDER BY len(parts) = len(wanted) DESC, len(parts), o_orderkey) AS rn FROM w JOIN p USING (o_custkey) WHERE list_has_all(parts, wanted))
 SELECT target, match, CASE WHEN same THEN 'same size' ELSE 'superset' END AS how FROM c WHERE rn = 1""",
    "reader_sequence_compare": """WITH a AS (SELECT l_orderkey, list(trunc(l_quantity)::BIGINT ORDER BY l_linenumber, l_partkey, l_quantity) AS a, list(trunc(l_quantity)::BIGINT + CASE WHEN l_orderkey % 97 = 0 AND l_linenumber = 1 THEN 1 ELSE 0 END ORDER BY l_linenumber, l_partkey, l_quantity) AS b FROM lineitem GROUP BY 1),
 s AS (SELECT l_orderkey, len(a) AS n, CASE WHEN l_orderkey % 101 = 0 THEN 'missing' WHEN a = CASE WHEN l_orderkey % 5 = 0 THEN list_reverse(b) ELSE b END THEN 'equal' WHEN list_sort(a) = list_sort(b) THEN 'order' ELSE 'values' END AS state FROM a)
 SELECT * FROM s WHERE state <> 'equal'""",
}
