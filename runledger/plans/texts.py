"""Lines, links and headings of read documents."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from runledger.sources.tables import table


def duplicate_consecutive(spark, sf_dir):
    """Documents with lines that repeat the line before: how many; lines stay in their row, so nothing is shuffled."""
    lines = F.split("text", "\n", -1)
    again = F.expr("size(filter(lines, (x, i) -> i > 0 AND x = lines[i - 1]))").cast("long")
    return table(spark, sf_dir, "documents").select("doc_id", lines.alias("lines")).select("doc_id", again.alias("n_repeated")).filter("n_repeated > 0")


def html_rows(spark, sf_dir):
    """Links of each page in order, each address once: address, title without tags, entities resolved."""
    href, title = (F.regexp_extract_all("html", F.lit('<a [^>]*href="([^"]*)"[^>]*>(.*?)</a>'), i) for i in (1, 2))
    rows = table(spark, sf_dir, "pages").select("page_id", F.posexplode(F.arrays_zip(href.alias("href"), title.alias("title")))).select("page_id", (F.col("pos") + 1).cast("long").alias("place"), "col.href", "col.title")
    plain = F.replace(F.regexp_replace("title", "<[^>]*>", ""), F.lit("&amp;"), F.lit("&"))
    return rows.groupBy("page_id", "href").agg(F.min("place").alias("place"), F.min_by(plain, "place").alias("title"), F.count("*").alias("n"))


def document_hash(spark, sf_dir):
    """Expected pages against a store of its own (every 31st not stored, every 37th of older text, some stored under addresses nobody expects)."""
    now = table(spark, sf_dir, "pages").select("page_id", F.sha2("html", 256).alias("sha"))
    k = F.col("page_id")
    store = table(spark, sf_dir, "pages").filter(k % 31 != 0).select(F.when(k % 41 == 0, -k - 1).otherwise(k).alias("page_id"), F.sha2(F.when(k % 37 == 0, F.concat("html", F.lit("old"))).otherwise(F.col("html")), 256).alias("stored"))
    state = F.when(F.col("stored").isNull(), "missing").when(F.col("sha").isNull(), "unexpected").otherwise("mismatched")
    return now.join(store, "page_id", "full").filter("NOT (sha <=> stored)").select("page_id", "sha", "stored", state.alias("state"))


def file_manifest(spark, sf_dir):
    """Pages by host and language part of their address."""
    parts = table(spark, sf_dir, "pages").select(F.regexp_extract("url", "^https?://([^/]+)", 1).alias("host"), F.regexp_extract("url", "^https?://[^/]+/([^/?]+)", 1).alias("part"))
    return parts.groupBy("host", "part").agg(F.count("*").alias("n"))


def header_roles(spark, sf_dir):
    """The how-manieth line of its role each line of a conversation is."""
    w = Window.partitionBy("conv_id", "role").orderBy("turn", "text")
    return table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", F.row_number().over(w).cast("long").alias("nth"))


def anchor_blocks(spark, sf_dir):
    """Blocks of a conversation, each from a user's line on: lines and letters in it."""
    w = Window.partitionBy("conv_id").orderBy("turn", "role", "text").rowsBetween(Window.unboundedPreceding, 0)
    rows = table(spark, sf_dir, "conversations").select("conv_id", F.length("text").cast("long").alias("n_chars"), F.sum(F.when(F.col("role") == "user", 1).otherwise(0)).over(w).alias("block"))
    return rows.groupBy("conv_id", "block").agg(F.count("*").alias("n_lines"), F.sum("n_chars").alias("n_chars"))


def text_search(spark, sf_dir):
    """Suggestions for what is typed ("Red RI"): eight customers whose folded name or segment holds it or whose code is the one typed, five parts whose
    folded name, brand or type holds it; the limits are the feature."""
    typed = F.lower(F.regexp_replace(F.lit("Red RI"), r"\s", ""))
    folded = lambda c: F.lower(F.regexp_replace(c, r"\s", ""))
    holds = lambda *columns: F.exists(F.array(*map(folded, columns)), lambda x: F.contains(x, typed))
    people = table(spark, sf_dir, "customer").filter(holds("c_name", "c_mktsegment") | (F.concat(F.lit("redri"), F.col("c_custkey") % 100) == F.concat(typed, F.lit("7"))))
    parts = table(spark, sf_dir, "part").filter(holds("p_name", "p_brand", "p_type"))
    first = people.orderBy("c_name", "c_custkey").limit(8).select(F.lit("athlete").alias("kind"), F.col("c_custkey").alias("id"), F.col("c_name").alias("label"))
    return first.unionByName(parts.orderBy("p_name", "p_partkey").limit(5).select(F.lit("event").alias("kind"), F.col("p_partkey").alias("id"), F.col("p_name").alias("label")))


def quality_predicates(spark, sf_dir):
    """By source: texts that are missing, empty, wrongly counted or end without a full stop."""
    n, text = F.length("text"), F.col("text")
    return table(spark, sf_dir, "documents").groupBy("source").agg(
        F.count("*").alias("n"), F.count_if(text.isNull()).alias("n_null"), F.count_if(n == 0).alias("n_empty"), F.count_if(n != F.col("n_chars")).alias("n_miscounted"), F.count_if(~F.endswith(text, F.lit("."))).alias("n_open"),
    )


LIST = (duplicate_consecutive, html_rows, document_hash, file_manifest, header_roles, anchor_blocks, text_search, quality_predicates)
SQL = {
    "duplicate_consecutive": """WITH l AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS x, generate_subscripts(string_split(text, chr(10)), 1) AS i FROM documents),
 p AS (SELECT *, lag(x) OVER (PARTITION BY doc_id ORDER BY i) AS b FROM l) SELECT doc_id, count(*) AS n_repeated FROM p WHERE x = b GROUP BY 1""",
    "html_rows": """WITH l AS (SELECT page_id, unnest(regexp_extract_all(html, '<a [^>]*href="([^"]*)"[^>]*>(.*?)</a>', 1)) AS href, unnest(regexp_extract_all(html, '<a [^>]*href="([^"]*)"[^>]*>(.*?)</a>', 2)) AS title,
 generate_subscripts(regexp_extract_all(html, '<a [^>]*href="([^"]*)"[^>]*>(.*?)</a>', 1), 1) AS place FROM pages)
 SELECT page_id, href, min(place) AS place, arg_min(replace(regexp_replace(title, '<[^>]*>', '', 'g'), '&amp;', '&'), place) AS title, count(*) AS n FROM l GROUP BY 1, 2""",
    "document_hash": """WITH s AS (SELECT CASE WHEN page_id % 41 = 0 THEN -page_id - 1 ELSE page_id END AS page_id, sha256(html || CASE WHEN page_id % 37 = 0 THEN 'old' ELSE '' END) AS stored FROM pages WHERE page_id % 31 <> 0)
 SELECT page_id, sha, stored, CASE WHEN stored IS NULL THEN 'missing' WHEN sha IS NULL THEN 'unexpected' ELSE 'mismatched' END AS state FROM (SELECT page_id, sha256(html) AS sha FROM pages) FULL JOIN s USING (page_id) WHERE sha IS DISTINCT FROM stored""",
    "file_manifest": "SELECT regexp_extract(url, '^https?://([^/]+)', 1) AS host, regexp_extract(url, '^https?://[^/]+/([^/?]+)', 1) AS part, count(*) AS n FROM pages GROUP BY 1, 2",
    "header_roles": "SELECT conv_id, turn, role, row_number() OVER (PARTITION BY conv_id, role ORDER BY turn, text) AS nth FROM conversations",
    "anchor_blocks": """WITH b AS (SELECT conv_id, length(text) AS c, sum(CASE WHEN role = 'user' THEN 1 ELSE 0 END) OVER (PARTITION BY conv_id ORDER BY turn, role, text ROWS UNBOUNDED PRECEDING)::BIGINT AS block FROM conversations)
 SELECT conv_id, block, count(*) AS n_lines, sum(c)::BIGINT AS n_chars FROM b GROUP BY 1, 2""",
    "text_search": """(SELECT 'athlete' AS kind, c_custkey AS id, c_name AS label FROM customer WHERE c_custkey % 100 = 7 OR lower(replace(c_name || '|' || c_mktsegment, ' ', '')) LIKE '%redri%' ORDER BY c_name, c_custkey LIMIT 8)
 UNION ALL (SELECT 'event', p_partkey, p_name FROM part WHERE lower(replace(p_name || '|' || p_brand || '|' || p_type, ' ', '')) LIKE '%redri%' ORDER BY p_name, p_partkey LIMIT 5)""",
    "quality_predicates": """SELECT source, count(*) AS n, count(*) FILTER (WHERE text IS NULL) AS n_null, count(*) FILTER (WHERE text = '') AS n_empty, count(*) FILTER (WHERE length(text) <> n_chars) AS n_miscounted,
 count(*) FILTER (WHERE text NOT LIKE '%.') AS n_open FROM documents GROUP BY 1""",
}
