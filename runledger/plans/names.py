"""Names and texts in many printed forms: display names, affiliations, normal forms."""

import unicodedata

from pyspark.sql import functions as F

from runledger.functions.affiliations import affiliation_key, split_interleaved
from runledger.functions.unicode import fold, normal
from runledger.operators import display
from runledger.sources.tables import table

# The affiliations of the printed forms.
KNOWN = ["africa", "america", "asia", "europe", "middleeast"]
#: A to Z, then the same letters in full width.
WIDE = ("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "".join(chr(0xFF21 + i) for i in range(26)))


def printed_names(spark, sf_dir):
    """Each order's print of its customer's name (a part's, by key): as it is, without the blank, with the region's letters mixed in, or in later years
    under another part's surname, by the cents of the price."""
    parts = table(spark, sf_dir, "part").select("p_partkey", "p_name")
    n = parts.agg(F.count("*").alias("n"))
    regions = table(spark, sf_dir, "nation").join(F.broadcast(table(spark, sf_dir, "region")), F.col("n_regionkey") == F.col("r_regionkey")).select("n_nationkey", F.lower(F.regexp_replace("r_name", " ", "")).alias("aff"))
    people = table(spark, sf_dir, "customer").join(F.broadcast(regions), F.col("c_nationkey") == F.col("n_nationkey")).select(F.col("c_custkey").alias("athlete"), "aff").crossJoin(F.broadcast(n))
    named = people.join(parts.withColumnRenamed("p_name", "own"), F.pmod("athlete", "n") == F.col("p_partkey")).drop("p_partkey")
    named = named.join(parts.withColumnRenamed("p_name", "next"), F.pmod(F.col("athlete") * 7 + 3, F.col("n")) == F.col("p_partkey"))
    orders = table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("athlete"), F.col("o_orderkey").alias("run_id"), F.to_date("o_orderdate").alias("date"), F.pmod(F.round(F.col("o_totalprice") * 100).cast("long"), F.lit(10)).alias("k"))
    own, aff = F.col("own"), F.col("aff")
    mixed = F.concat(F.substring(own, 1, 2), F.substring(aff, 1, 1), F.substring(own, 3, 3), F.expr("substring(aff, 2)"), F.expr("substring(own, 6)"))
    married = F.concat(F.split("next", " ")[0], F.lit(" "), F.split("own", " ")[1])
    form = F.when(F.col("k") < 3, mixed).when(F.col("k") == 3, F.replace(own, F.lit(" "), F.lit(""))).when((F.col("k") > 6) & (F.col("date") >= "1997-01-01"), married).otherwise(own)
    return orders.join(named, "athlete").select("athlete", "run_id", "date", "aff", form.alias("form"))


def display_names(spark, sf_dir):
    """The name to show of each athlete, how many forms were printed, and how many of these are another form with the affiliation's letters in it."""
    return display.display_names(printed_names(spark, sf_dir), "athlete", "form", F.struct("date", "run_id"), F.array(*map(F.lit, KNOWN)))


def affiliation_forms(spark, sf_dir):
    """Printed affiliations and clubs (full width, blanks, middle dots, endings; clubs printed in the affiliation's place) by their key: forms and prints."""
    regions = table(spark, sf_dir, "nation").join(F.broadcast(table(spark, sf_dir, "region")), F.col("n_regionkey") == F.col("r_regionkey")).select("n_nationkey", "r_name")
    rows = table(spark, sf_dir, "customer").join(F.broadcast(regions), F.col("c_nationkey") == F.col("n_nationkey")).withColumn("k", F.pmod(F.floor(F.col("c_acctbal")).cast("long"), F.lit(6)))
    wide = lambda c: F.translate(c, *WIDE)
    pref = F.when(F.col("k") == 0, wide("r_name")).when(F.col("k") == 1, F.concat("r_name", F.lit("県"))).when(F.col("k") == 2, F.lower("r_name")).when(F.col("k") == 3, F.concat(F.lit("TEAM "), F.col("r_name"))).when(F.col("k") == 4, F.lit(None).cast("string")).otherwise(F.col("r_name"))
    club = F.when(F.col("k") < 2, wide(F.concat(F.substring("c_mktsegment", 1, 4), F.lit("・"), F.expr("substring(c_mktsegment, 5)")))).when(F.col("k") == 3, F.lit("")).otherwise(F.col("c_mktsegment"))
    a, c = affiliation_key(pref, club, F.array(*map(F.lit, KNOWN)))
    rows = rows.select("c_custkey", pref.alias("printed"), club.alias("club_printed"), a.alias("affiliation"), c.alias("club"))
    return rows.groupBy("affiliation", "club").agg(F.count("*").alias("n"), F.countDistinct(F.struct(F.coalesce("printed", F.lit("~")), "club_printed")).alias("n_forms"), F.min("c_custkey").alias("first"))


def folded_words(spark, sf_dir):
    """Words of all documents by language without accents and case: how often, and in how many spellings, for those with more than one."""
    words = table(spark, sf_dir, "documents").select("lang", F.explode(F.regexp_extract_all("text", F.lit(r"[\p{L}]+"), F.lit(0))).alias("word")).groupBy("lang", "word").agg(F.count("*").alias("n"))
    each = words.groupBy("lang", fold(F.col("word")).alias("folded")).agg(F.sum("n").alias("n"), F.count("*").alias("spellings"), F.min("word").alias("first"))
    return each.filter("spellings > 1")


def normal_lines(spark, sf_dir):
    """Lines of documents that are one in normal form (widths, marks typed apart, blanks) though printed in several: a third of the documents is read in
    full width and a third with its accents as marks of their own."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    lines = docs.select("doc_id", F.explode(F.split("text", "\n")).alias("line")).filter(F.length("line") > 0)
    apart = F.col("line")
    for letter in "\u00e9\u00e8\u00f1\u00fc\u00e7":
        apart = F.replace(apart, F.lit(letter), F.lit(unicodedata.normalize("NFD", letter)))
    k = F.pmod("doc_id", F.lit(3))
    printed = F.when(k == 0, F.translate("line", *WIDE)).when(k == 1, apart).otherwise(F.col("line"))
    each = lines.select("doc_id", printed.alias("printed"), normal(printed).alias("key")).groupBy("key").agg(F.countDistinct("printed").alias("n_printed"), F.count("*").alias("n"), F.min("doc_id").alias("first"))
    return each.filter("n_printed > 1").select(F.sha2("key", 256).alias("key"), "n_printed", "n", "first")


def interleaved_words(spark, sf_dir):
    """Words in which ASCII and other letters are mixed, taken apart: by language and remainder how many, how many different ASCII parts, and whether the
    remainder is a known one (of at most two letters that stand alone in some document)."""
    words = table(spark, sf_dir, "documents").select("lang", F.explode(F.split("text", r"[^\p{L}]+")).alias("word")).groupBy("lang", "word").agg(F.count("*").alias("n"))
    own = words.filter(F.col("word").rlike(r"^[^\x00-\x7F]{1,2}$")).select(F.col("word").alias("alone"), F.lit(True).alias("known")).distinct()
    plain, rest, _ = split_interleaved(F.col("word"), F.array(F.lit("")))
    mixed = words.select("lang", "n", plain.alias("plain"), rest.alias("rest")).filter("plain <> '' AND rest <> ''")
    each = mixed.groupBy("lang", "rest").agg(F.sum("n").alias("n"), F.countDistinct("plain").alias("n_plain"))
    return each.join(own, F.col("rest") == F.col("alone"), "left").select("lang", "rest", "n", "n_plain", F.coalesce("known", F.lit(False)).alias("known"))


LIST = (display_names, affiliation_forms, folded_words, normal_lines, interleaved_words)
_AFF = "lower(replace(r_name, ' ', ''))"
_REST = "list_reduce(string_split({k}, ''), lambda s, c: CASE WHEN s.i < length({o}) AND c = {o}[s.i + 1] THEN {{'i': s.i + 1, 'rest': s.rest}} ELSE {{'i': s.i, 'rest': s.rest || c}} END, {{'i': 0::BIGINT, 'rest': ''}})"
SQL = {
    "display_names": f"""WITH m AS (SELECT count(*) AS n FROM part), p AS (SELECT c_custkey AS athlete, {_AFF} AS aff, a.p_name AS own, b.p_name AS next FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey, m
  JOIN part a ON a.p_partkey = c_custkey % m.n JOIN part b ON b.p_partkey = (c_custkey * 7 + 3) % m.n),
 o AS (SELECT o_custkey AS athlete, o_orderkey AS run_id, o_orderdate::DATE AS date, round(o_totalprice * 100)::BIGINT % 10 AS k FROM orders),
 f AS (SELECT athlete, run_id, date, CASE WHEN k < 3 THEN own[1:2] || aff[1] || own[3:5] || aff[2:] || own[6:] WHEN k = 3 THEN replace(own, ' ', '') WHEN k > 6 AND date >= DATE '1997-01-01' THEN split_part(next, ' ', 1) || ' ' || split_part(own, ' ', 2) ELSE own END AS form FROM o JOIN p USING (athlete)),
 g AS MATERIALIZED (SELECT athlete, form, replace(form, ' ', '') AS key, count(*) AS n, min((date, run_id)) AS first, max((date, run_id)) AS last FROM f GROUP BY 1, 2),
 x AS (SELECT DISTINCT athlete, form FROM (SELECT a.athlete, a.form, b.key AS o, {_REST.format(k="a.key", o="b.key")} AS s FROM g a JOIN g b ON a.athlete = b.athlete AND a.key <> b.key) WHERE s.i = length(o) AND s.rest IN ('africa', 'america', 'asia', 'europe', 'middleeast')),
 c AS (SELECT g.*, x.form IS NOT NULL AS glued FROM g LEFT JOIN x ON g.athlete = x.athlete AND g.form = x.form),
 d AS (SELECT *, bool_and(glued) OVER (PARTITION BY athlete) AS every FROM c),
 e AS (SELECT athlete, arg_min(form, (-n, first)) AS best, arg_max(form, last) AS newest FROM d WHERE every OR NOT glued GROUP BY 1),
 s AS (SELECT *, string_split(best, ' ') AS a, string_split(newest, ' ') AS b FROM e)
 SELECT s.athlete, CASE WHEN len(a) = 2 AND len(b) = 2 AND a[2] = b[2] AND NOT list_has_any(string_split(a[1], ''), string_split(b[1], '')) THEN newest ELSE best END AS name, t.n_forms, t.n_glued
 FROM s JOIN (SELECT athlete, count(*) AS n_forms, count(*) FILTER (WHERE glued) AS n_glued FROM c GROUP BY 1) t ON s.athlete = t.athlete""",
    "affiliation_forms": f"""WITH r AS (SELECT c_custkey, floor(c_acctbal)::BIGINT AS b, r_name, {_AFF} AS aff, c_mktsegment AS seg FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey),
 k AS (SELECT *, ((b % 6) + 6) % 6 AS k FROM r)
 SELECT CASE WHEN k IN (3, 4) THEN NULL ELSE aff END AS affiliation, CASE WHEN k = 3 THEN 'team' || aff ELSE lower(seg) END AS club, count(*) AS n, count(DISTINCT (CASE WHEN k = 4 THEN '~' WHEN k = 3 THEN r_name ELSE k::VARCHAR END, CASE WHEN k = 3 THEN '' ELSE seg END)) AS n_forms, min(c_custkey) AS first FROM k GROUP BY 1, 2""",
    "folded_words": r"""WITH w AS (SELECT lang, word, count(*) AS n FROM (SELECT lang, unnest(regexp_extract_all(text, '[\p{L}]+')) AS word FROM documents) GROUP BY 1, 2)
 SELECT lang, lower(strip_accents(word)) AS folded, sum(n)::BIGINT AS n, count(*) AS spellings, min(word) AS first FROM w GROUP BY 1, 2 HAVING count(*) > 1""",
    "normal_lines": r"""WITH l AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM documents), k AS (SELECT doc_id, line, doc_id % 3 AS k, regexp_replace(line, '[\t-\r ]', '', 'g') AS key FROM l WHERE line <> ''),
 p AS (SELECT *, CASE WHEN k = 0 AND regexp_matches(line, '[A-Z]') THEN '0' WHEN k = 1 AND regexp_matches(line, '[éèñüç]') THEN '1' ELSE '2' END || line AS printed FROM k)
 SELECT sha256(key) AS key, count(DISTINCT printed) AS n_printed, count(*) AS n, min(doc_id) AS first FROM p GROUP BY p.key HAVING count(DISTINCT printed) > 1""",
    "interleaved_words": r"""WITH w AS (SELECT lang, word, count(*) AS n FROM (SELECT lang, unnest(regexp_split_to_array(text, '[^\p{L}]+')) AS word FROM documents) GROUP BY 1, 2),
 o AS (SELECT DISTINCT word AS alone FROM w WHERE regexp_matches(word, '^[^\x00-\x7F]{1,2}$')), m AS (SELECT lang, n, regexp_replace(word, '[^\x00-\x7F]', '', 'g') AS plain, regexp_replace(word, '[\x00-\x7F]', '', 'g') AS rest FROM w)
 SELECT lang, rest, sum(n)::BIGINT AS n, count(DISTINCT plain) AS n_plain, any_value(alone) IS NOT NULL AS known FROM m LEFT JOIN o ON rest = alone WHERE plain <> '' AND rest <> '' GROUP BY 1, 2""",
}
