"""Texts: layouts, printed lines, repaired words, keys, dates, numbers as text."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from runledger.functions.names import name_key, number_key, placeholder, slug
from runledger.sources.tables import runs, table

MONTHS = ("JAN", "FEB", "MAR", "APR", "MAY", "JUN", "JUL", "AUG", "SEP", "OCT", "NOV", "DEC")
# Stage names as printed, glued or in the plural.
STAGES = {"smallfinals": "small final", "smallfinal": "small final", "bigfinals": "big final", "bigfinal": "big final", "semifinals": "semifinal", "quaterfinals": "quarterfinal"}


def layout_classifier(spark, sf_dir):
    """Documents by layout (the first marker that fits) and source, with the numbers in their texts: a minus may be glued to the word before."""
    t = F.coalesce("text", F.lit(""))
    layout = (
        F.when(t == "", "empty").when(t.rlike("(?i)licen[sc]e|all rights reserved"), "license").when(t.rlike("https?://"), "links").when(t.rlike("(?m)^[^\n]{1,40}$"), "short lines").when(~t.rlike("[A-Za-z]"), "no letters").otherwise("prose")
    )
    numbers = F.regexp_extract_all(t, F.lit(r"-?[0-9]+(?:\.[0-9]+)?"), 0)
    rows = table(spark, sf_dir, "documents").select("source", layout.alias("layout"), F.size(numbers).alias("k"), F.size(F.filter(numbers, lambda x: x.startswith("-"))).alias("m"))
    return rows.groupBy("source", "layout").agg(F.count("*").alias("n"), F.sum("k").alias("n_numbers"), F.sum("m").alias("n_negative"))


def printed_line_check(spark, sf_dir):
    """Lines of a conversation: the first word of a user's line must stand on that line or the next; misses of registered conversations (every
    fifth) are as printed."""
    w = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    lines = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text", F.lead("text").over(w).alias("following"), F.row_number().over(w).alias("line"))
    said = lines.filter("role = 'user'").select("conv_id", "turn", "line", "following", F.lower(F.regexp_extract("text", r"([A-Za-z]+)", 1)).alias("word"))
    registered = table(spark, sf_dir, "conversations").filter("conv_id % 5 = 0").select("conv_id").distinct().withColumn("known", F.lit(True))
    found = F.contains(F.lower(F.coalesce("following", F.lit(""))), F.col("word"))
    out = said.join(registered, "conv_id", "left")
    return out.select("conv_id", "turn", F.col("line").cast("long").alias("line"), F.when(found, "found").when(F.col("known"), "printed as is").otherwise("missing").alias("state"))


def text_repair(spark, sf_dir):
    """Parts' names printed with every sign doubled and repaired, a survey line split to its fields, ASCII told from other letters, and a name put
    together from two lines (no space after a hyphen)."""
    printed = F.regexp_replace("p_name", "(.)", "$1$1")
    single = F.array_join(F.filter(F.split(printed, ""), lambda x, i: i % 2 == 0), "")
    repaired = F.when(printed.rlike(r"^(?:(.)\1)+$"), single).otherwise(printed)
    line = F.concat_ws(" ", "p_size", F.when(F.col("p_partkey") % 4 == 0, "-").otherwise(F.col("p_partkey").cast("string")), F.regexp_replace("p_brand", "#", ""), "p_name")
    f = F.split(line, " ", 4)
    mixed = F.translate("p_name", "ae", "山川")
    parts = F.when(F.col("p_partkey") % 3 == 0, F.array(F.concat("p_type", F.lit("-")), F.col("p_brand"))).otherwise(F.array("p_type", "p_brand"))
    return table(spark, sf_dir, "part").select(
        "p_partkey", repaired.alias("repaired"), f[0].try_cast("long").alias("rank"), F.nullif(f[1], F.lit("-")).alias("bib"), f[2].alias("code"), f[3].alias("name"),
        F.regexp_replace(mixed, "[^\\x00-\\x7F]", "").alias("ascii"), F.regexp_replace(mixed, "[\\x00-\\x7F]", "").alias("other"), F.regexp_replace(F.array_join(parts, " "), "- ", "-").alias("joined"),
    )


def display_name_choice(spark, sf_dir):
    """The name shown for each athlete: the most common form (of equal ones the first seen), but the newest where the surname changed (no letter in
    common with it, same given name)."""
    form = F.when(F.col("o_orderkey") % 5 < 3, F.concat(F.lit("Kim "), F.col("o_custkey"))).when(F.col("o_orderkey") % 5 == 3, F.concat(F.lit("Kima "), F.col("o_custkey"))).otherwise(F.concat(F.lit("Loe "), F.col("o_custkey")))
    rows = table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("athlete"), form.alias("name"), F.struct("o_orderdate", "o_orderkey").alias("seq"))
    each = rows.groupBy("athlete", "name").agg(F.count("*").alias("n"), F.min("seq").alias("first"), F.max("seq").alias("last"))
    picks = each.groupBy("athlete").agg(F.min_by("name", F.struct(-F.col("n"), F.col("first"))).alias("common"), F.max_by("name", "last").alias("newest"), F.count("*").alias("n_forms"))
    own, new = F.split("common", " "), F.split("newest", " ")
    apart = (own[1] == new[1]) & (F.size(F.array_intersect(F.split(F.lower(own[0]), ""), F.split(F.lower(new[0]), ""))) == 0)
    return picks.select("athlete", F.when(apart, F.col("newest")).otherwise(F.col("common")).alias("name"), apart.alias("changed"), "n_forms")


def printed_values_unpivot(spark, sf_dir):
    """Every number expected in print, as (field, hundredths) with its place in the order's block: counts and sums by field and place."""
    w = Window.partitionBy("l_orderkey").orderBy("l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice")
    cents = lambda c: F.round(F.col(c) * 100).cast("long").alias(c)
    names = ("l_quantity", "l_extendedprice", "l_discount", "l_tax")
    rows = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", F.row_number().over(w).cast("long").alias("place"), *map(cents, names))
    long = rows.unpivot(["l_orderkey", "l_linenumber", "place"], list(names), "field", "value")
    return long.groupBy("field", "place").agg(F.count("*").alias("n"), F.sum("value").alias("total"))


def web_rows_zip(spark, sf_dir):
    """Saved rows [status, cells…] zipped to their header: numbers parsed where they are numbers, rows of a wrong length told apart."""
    key = F.get_json_object("props", "$.k")
    cells = F.array(F.col("event_type"), F.when(F.col("event_id") % 19 == 0, "DNF").otherwise(key), F.col("user_id").cast("string"))
    row = F.when(F.col("event_id") % 23 == 0, F.slice(cells, 1, 2)).otherwise(cells)
    rows = table(spark, sf_dir, "events").select("event_id", row.alias("row"))
    zipped = F.when(F.size("row") == 3, F.map_from_arrays(F.array(F.lit("k"), F.lit("user")), F.slice("row", 2, 2)))
    out = rows.select("event_id", F.col("row")[0].alias("status"), zipped.alias("z"))
    return out.select("event_id", "status", F.col("z")["k"].try_cast("long").alias("k"), F.col("z")["user"].try_cast("long").alias("user"), F.when(F.col("z").isNull(), "wrong length").when(F.col("z")["k"].try_cast("long").isNull(), "not a number").otherwise("ok").alias("state"))


def normal_keys(spark, sf_dir):
    """Keys of customers: slug, name and number keys, placeholders, and the id by source."""
    k = F.col("c_custkey")
    number = F.when(k % 8 == 0, F.concat(F.lit("9999"), F.lpad((k % 1000).cast("string"), 3, "0"))).when(k % 8 < 5, F.lpad(k.cast("string"), 7, "0"))
    code = F.when(k % 4 == 1, F.concat(F.lit("25"), k))
    saj = F.when(~placeholder(number), number_key(number))
    id_ = F.coalesce(code, F.concat(F.lit("saj-"), saj), F.concat(F.lit("x-"), slug(F.col("c_name")), F.lit("-"), F.lower("c_mktsegment")))
    return table(spark, sf_dir, "customer").select("c_custkey", slug(F.col("c_name")).alias("slug"), name_key(F.col("c_name")).alias("name_key"), number_key(number).alias("number_key"), placeholder(number).alias("placeholder"), id_.alias("id"), F.col("c_name").rlike("[\\x{2E80}-\\x{10FFFF}]").alias("cjk"))


def stage_and_dates(spark, sf_dir):
    """Dates printed in three forms and read back (a slash form is read only where it can mean one day alone), season labels, stages and bracket legs."""
    d, k = F.to_date("o_orderdate"), F.col("o_orderkey")
    printed = F.when(k % 3 == 0, F.upper(F.date_format(d, "EEE dd MMM yyyy"))).when(k % 3 == 1, F.date_format(d, "MMMM d, yyyy")).otherwise(F.date_format(d, "dd/MM/yyyy"))
    glued = F.when(k % 4 == 0, "SmallFinals").when(k % 4 == 1, "Big Final").when(k % 4 == 2, "Quaterfinals").otherwise("Round of 16")
    rows = table(spark, sf_dir, "orders").select(k, printed.alias("printed"), glued.alias("stage"), F.concat(F.lit("R32-"), k % 7 + 1, F.lit(":Rk"), k % 5 + 1, F.lit("R16-"), k % 3 + 1).alias("legs"), "o_orderstatus")
    word = F.regexp_extract("printed", r"^[A-Z]{3} ([0-9]{2} [A-Z]{3} [0-9]{4})$", 1)
    slash = F.regexp_extract("printed", r"^([0-9]{2})/([0-9]{2})/[0-9]{4}$", 1).try_cast("int") > 12
    month = F.array_position(F.array(*map(F.lit, MONTHS)), F.upper(F.substring("printed", 1, 3)))
    long = F.regexp_extract("printed", r"^[A-Z][a-z]+ ([0-9]+), ([0-9]{4})$", 2)
    date = F.coalesce(
        F.when(word != "", F.try_to_date(F.concat(F.substring(word, 1, 3), F.initcap(F.substring(word, 4, 3)), F.substring(word, 7, 5)), "dd MMM yyyy")),
        F.when(long != "", F.make_date(long.cast("int"), month.cast("int"), F.regexp_extract("printed", r" ([0-9]+),", 1).try_cast("int"))), F.when(slash, F.try_to_date("printed", "dd/MM/yyyy")),
    )
    stage = F.lower(F.regexp_replace("stage", " ", ""))
    known = F.create_map(*[F.lit(x) for pair in STAGES.items() for x in pair])
    end = F.year("date") + (F.month("date") >= 7).cast("int")
    out = rows.select("o_orderkey", date.alias("date"), F.coalesce(known[stage], F.lower("stage")).alias("stage"), F.regexp_replace("legs", r"(Rk[0-9])(?=R[0-9])", "$1 ").alias("legs"), F.when(F.col("o_orderstatus") == "P", "DNF").otherwise("OK").alias("status"))
    return out.withColumn("season_end", end.cast("long"))


def number_text(spark, sf_dir):
    """By athlete: best score as text with two decimals, signed gap between the last two finished runs, chart bounds in tens, and years on the axis."""
    rows = runs(spark, sf_dir).filter("status = 'OK'").select("athlete", "date", "run_id", "score_k")
    each = rows.groupBy("athlete").agg(F.max("score_k").alias("hi"), F.min("score_k").alias("lo"), F.slice(F.sort_array(F.collect_list(F.struct("date", "run_id", "score_k")), asc=False), 1, 2).alias("t"), F.array_sort(F.collect_set(F.year("date"))).alias("y"))
    gap = F.when(F.size("t") == 2, F.col("t")[0]["score_k"] - F.try_element_at("t", F.lit(2))["score_k"])
    return each.select(
        "athlete", F.format_string("%d.%02d", F.expr("hi div 100"), F.expr("hi % 100")).alias("best"), F.when(gap.isNull(), "").when(gap > 0, F.concat(F.lit("+"), gap)).otherwise(gap.cast("string")).alias("gap"),
        (F.floor(F.col("lo") / 10) * 10).cast("long").alias("axis_from"), (F.ceil(F.col("hi") / 10) * 10).cast("long").alias("axis_to"), F.array_join("y", " ").alias("years"),
    )


LIST = (layout_classifier, printed_line_check, text_repair, display_name_choice, printed_values_unpivot, web_rows_zip, normal_keys, stage_and_dates, number_text)
SQL = {
    "layout_classifier": r"""WITH t AS (SELECT source, coalesce(text, '') AS t FROM documents), c AS (SELECT source, CASE WHEN t = '' THEN 'empty' WHEN regexp_matches(t, '(?i)licen[sc]e|all rights reserved') THEN 'license' WHEN regexp_matches(t, 'https?://') THEN 'links'
 WHEN len(list_filter(string_split(t, chr(10)), lambda x: length(x) BETWEEN 1 AND 40)) > 0 THEN 'short lines' WHEN NOT regexp_matches(t, '[A-Za-z]') THEN 'no letters' ELSE 'prose' END AS layout, regexp_extract_all(t, '-?[0-9]+(?:\.[0-9]+)?') AS x FROM t)
 SELECT source, layout, count(*) AS n, sum(len(x))::BIGINT AS n_numbers, sum(len(list_filter(x, lambda v: v[1] = '-')))::BIGINT AS n_negative FROM c GROUP BY 1, 2""",
    "printed_line_check": """WITH l AS (SELECT conv_id, turn, role, text, lead(text) OVER w AS following, row_number() OVER w AS line FROM conversations WINDOW w AS (PARTITION BY conv_id ORDER BY turn, role, text))
 SELECT conv_id, turn, line, CASE WHEN contains(lower(coalesce(following, '')), lower(regexp_extract(text, '([A-Za-z]+)', 1))) THEN 'found' WHEN conv_id % 5 = 0 THEN 'printed as is' ELSE 'missing' END AS state FROM l WHERE role = 'user'""",
    "text_repair": """SELECT p_partkey, p_name AS repaired, p_size::BIGINT AS rank, CASE WHEN p_partkey % 4 <> 0 THEN p_partkey::VARCHAR END AS bib, replace(p_brand, '#', '') AS code, p_name AS name, replace(replace(p_name, 'a', ''), 'e', '') AS ascii,
 replace(replace(regexp_replace(p_name, '[^ae]', '', 'g'), 'a', chr(23665)), 'e', chr(24029)) AS other, p_type || CASE WHEN p_partkey % 3 = 0 THEN '-' ELSE ' ' END || p_brand AS joined FROM part""",
    "display_name_choice": """WITH f AS (SELECT o_custkey AS athlete, CASE WHEN o_orderkey % 5 < 3 THEN 'Kim ' WHEN o_orderkey % 5 = 3 THEN 'Kima ' ELSE 'Loe ' END || o_custkey AS name, o_orderdate AS d, o_orderkey AS k FROM orders),
 e AS (SELECT athlete, name, count(*) AS n, min((d, k)) AS first, max((d, k)) AS last FROM f GROUP BY 1, 2),
 r AS (SELECT *, row_number() OVER (PARTITION BY athlete ORDER BY n DESC, first) AS c, row_number() OVER (PARTITION BY athlete ORDER BY last DESC) AS w, count(*) OVER (PARTITION BY athlete) AS n_forms FROM e),
 p AS (SELECT athlete, n_forms, max(name) FILTER (WHERE c = 1) AS common, max(name) FILTER (WHERE w = 1) AS newest FROM r GROUP BY 1, 2)
 SELECT athlete, CASE WHEN (common LIKE 'Loe%') <> (newest LIKE 'Loe%') THEN newest ELSE common END AS name, (common LIKE 'Loe%') <> (newest LIKE 'Loe%') AS changed, n_forms FROM p""",
    "printed_values_unpivot": """WITH p AS (SELECT l_quantity, l_extendedprice, l_discount, l_tax, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_extendedprice) AS place FROM lineitem)
 SELECT field, place, count(*) AS n, sum(round(value * 100)::BIGINT)::BIGINT AS total FROM (UNPIVOT p ON l_quantity, l_extendedprice, l_discount, l_tax INTO NAME field VALUE value) GROUP BY 1, 2""",
    "web_rows_zip": r"""WITH c AS (SELECT event_id, event_type AS status, CASE WHEN event_id % 23 <> 0 AND event_id % 19 <> 0 THEN regexp_extract(props, '"k": *(\d+)', 1)::BIGINT END AS k, CASE WHEN event_id % 23 <> 0 THEN user_id END AS user FROM events)
 SELECT *, CASE WHEN event_id % 23 = 0 THEN 'wrong length' WHEN k IS NULL THEN 'not a number' ELSE 'ok' END AS state FROM c""",
    "normal_keys": """WITH n AS (SELECT *, CASE WHEN c_custkey % 8 = 0 THEN '9999' || lpad((c_custkey % 1000)::VARCHAR, 3, '0') WHEN c_custkey % 8 < 5 THEN nullif(c_custkey::VARCHAR, '0') END AS no FROM customer)
 SELECT c_custkey, lower(replace(c_name, '#', '-')) AS slug, lower(replace(c_name, '#', '')) AS name_key, no AS number_key, c_custkey % 8 = 0 AS placeholder,
 CASE WHEN c_custkey % 4 = 1 THEN '25' || c_custkey WHEN c_custkey % 8 <> 0 AND no IS NOT NULL THEN 'saj-' || no ELSE 'x-' || lower(replace(c_name, '#', '-')) || '-' || lower(c_mktsegment) END AS id, false AS cjk FROM n""",
    "stage_and_dates": """WITH o AS (SELECT o_orderkey AS k, o_orderdate::DATE AS d, o_orderstatus AS s FROM orders), r AS (SELECT *, CASE WHEN k % 3 = 2 AND day(d) <= 12 THEN NULL ELSE d END AS date FROM o)
 SELECT k AS o_orderkey, date, CASE k % 4 WHEN 0 THEN 'small final' WHEN 1 THEN 'big final' WHEN 2 THEN 'quarterfinal' ELSE 'round of 16' END AS stage, 'R32-' || (k % 7 + 1) || ':Rk' || (k % 5 + 1) || ' R16-' || (k % 3 + 1) AS legs,
 CASE WHEN s = 'P' THEN 'DNF' ELSE 'OK' END AS status, year(date) + CASE WHEN month(date) >= 7 THEN 1 ELSE 0 END AS season_end FROM r""",
    "number_text": """WITH r AS (SELECT o_custkey AS athlete, o_orderdate::DATE AS date, o_orderkey AS run_id, floor(o_totalprice / 1000)::BIGINT AS s FROM orders WHERE o_orderstatus <> 'P'),
 g AS (SELECT athlete, max(s) AS hi, min(s) AS lo, list(s ORDER BY date DESC, run_id DESC) AS t, string_agg(DISTINCT year(date)::VARCHAR, ' ' ORDER BY year(date)::VARCHAR) AS years FROM r GROUP BY 1)
 SELECT athlete, printf('%d.%02d', hi // 100, hi % 100) AS best, CASE WHEN len(t) < 2 THEN '' WHEN t[1] > t[2] THEN '+' || (t[1] - t[2]) ELSE (t[1] - t[2])::VARCHAR END AS gap, (lo // 10 * 10)::BIGINT AS axis_from, ((hi + 9) // 10 * 10)::BIGINT AS axis_to, years FROM g""",
}
