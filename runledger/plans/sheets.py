"""Tables as they are printed: blocks that run over pages, values that a page does not print, columns by their headers, and the forms of numbers, dates and attachments."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from runledger.plans.sequences import _micros
from runledger.sources.tables import parts, table

BEFORE = (Window.unboundedPreceding, -1)
SO_FAR = (Window.unboundedPreceding, 0)


def page_blocks(spark, sf_dir):
    """Blocks of a customer's report (orders are pages, in order of days; a page's table is told by its status): a line of return flag `A` starts a block, which runs on over the next pages of
    the same table until the next such line. By block its pages, lines and quantity; lines before a table's first anchor have block 0. Lines are dealt by table into as many parts as they need."""
    pages = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", F.to_date("o_orderdate").alias("day"))
    every = table(spark, sf_dir, "lineitem")
    n = parts(every)
    lines = every.select("l_orderkey", "l_linenumber", "l_partkey", F.col("l_quantity").cast("long").alias("qty"), (F.col("l_returnflag") == "A").cast("long").alias("anchor"))
    rows = lines.repartition(n, "l_orderkey").join(pages.repartition(n, "o_orderkey"), F.col("l_orderkey") == F.col("o_orderkey")).drop("l_orderkey").repartition(n, "o_custkey", "o_orderstatus")
    order = Window.partitionBy("o_custkey", "o_orderstatus").orderBy("day", "o_orderkey", "l_linenumber", "l_partkey", "qty").rowsBetween(*SO_FAR)
    rows = rows.withColumn("block", F.sum("anchor").over(order))
    blocks = rows.groupBy("o_custkey", "o_orderstatus", "block").agg(F.count("*").alias("n_lines"), F.sum("qty").alias("qty"), F.min(F.struct("day", "o_orderkey")).alias("first"), F.max(F.struct("day", "o_orderkey")).alias("last"))
    return blocks.select("o_custkey", "o_orderstatus", "block", "n_lines", "qty", F.col("first.o_orderkey").alias("first_page"), F.col("last.o_orderkey").alias("last_page"))


def table_pace(spark, sf_dir):
    """The tax of each order (a page): the one it prints itself (its least returned line), else the last that the customer's pages of the same status printed before it (open and
    finished ones only), else the page's greatest; and which of these it is."""
    tax = F.round(F.col("l_tax") * 100).cast("long")
    own = table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(F.min(F.when(F.col("l_returnflag") == "R", tax)).alias("own"), F.max(tax).alias("page"))
    pages = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", F.to_date("o_orderdate").alias("day")).join(own, F.col("o_orderkey") == F.col("l_orderkey"))
    order = Window.partitionBy("o_custkey", "o_orderstatus").orderBy("day", "o_orderkey").rowsBetween(*BEFORE)
    known = F.when(F.col("o_orderstatus") != "P", F.last("own", ignorenulls=True).over(order))
    pages = pages.withColumn("known", known)
    how = F.when(F.col("own").isNotNull(), "own").when(F.col("known").isNotNull(), "known").otherwise("page")
    return pages.select("o_orderkey", F.coalesce("own", "known", "page").alias("pace"), how.alias("how"))


def column_meanings(spark, sf_dir):
    """Columns of a header (a user's day; views stand for `J`, clicks for `Total`, sign-ups for `DD`) by their place: the n-th `J` before the first `Total` is a turn judge, after a `DD` an
    air judge; the first `Total` turns, the second air. Purchases and errors are cells: each falls to the nearest column (of two, the left one). Two cells in one column collide;
    the difference is cell less column, in hundredths."""
    rows = table(spark, sf_dir, "events").select("event_id", "user_id", F.to_date("ts").alias("day"), _micros("ts").alias("x"), "event_type", F.round(F.col("value") * 100).cast("long").alias("cents"))
    order = Window.partitionBy("user_id", "day").orderBy("x", "event_id")
    is_ = lambda t: (F.col("event_type") == t).cast("long")
    rows = rows.withColumn("totals", F.coalesce(F.sum(is_("click")).over(order.rowsBetween(*BEFORE)), F.lit(0))).withColumn("dds", F.coalesce(F.sum(is_("signup")).over(order.rowsBetween(*BEFORE)), F.lit(0)))
    turn, air = is_("view") * (F.col("totals") == 0).cast("long"), is_("view") * ((F.col("totals") > 0) & (F.col("dds") > 0)).cast("long")
    so_far = order.rowsBetween(*SO_FAR)
    view = F.when(turn == 1, F.concat(F.lit("turn "), F.sum(turn).over(so_far))).when(air == 1, F.concat(F.lit("air "), F.sum(air).over(so_far))).otherwise("unknown")
    click = F.when(F.col("totals") == 0, "turns").when(F.col("totals") == 1, "air").otherwise("unknown")
    rows = rows.withColumn("meaning", F.when(F.col("event_type") == "view", view).when(F.col("event_type") == "click", click).when(F.col("event_type") == "signup", "factor"))
    column = F.when(F.col("meaning").isNotNull(), F.struct("x", "event_id", "meaning", "cents"))
    rows = rows.withColumn("left", F.last(column, ignorenulls=True).over(so_far)).withColumn("right", F.first(column, ignorenulls=True).over(order.rowsBetween(0, Window.unboundedFollowing)))
    cells = rows.filter("meaning IS NULL")
    near = F.when(F.col("left").isNull() | ((F.col("right.x") - F.col("x")) < (F.col("x") - F.col("left.x"))), F.col("right")).otherwise(F.col("left"))
    cells = cells.withColumn("near", near)
    held = F.count("*").over(Window.partitionBy("user_id", "day", "near.event_id"))
    state = F.when(F.col("near").isNull(), "no column").when(held > 1, "collision").otherwise("ok")
    return cells.select("event_id", F.col("near.event_id").alias("column_id"), F.col("near.meaning").alias("meaning"), state.alias("state"), (F.col("cents") - F.col("near.cents")).alias("difference"))


def number_tokens(spark, sf_dir):
    """Words with digits, of all documents by language and of printed order lines (`lines`: a bib with R, a price whose glyphs are doubled where the line was returned, a quantity with the
    discount glued behind it by its minus), as numbers: how many words and numbers of each kind, how many different ones, and their sum in hundredths."""
    price = F.format_string("%.2f", F.col("l_extendedprice"))
    price = F.when(F.col("l_returnflag") == "R", F.regexp_replace(price, "(.)", "$1$1")).otherwise(price)
    line = F.concat_ws(" ", F.concat(F.lit("R"), F.col("l_linenumber")), price, F.concat(F.col("l_quantity").cast("long"), F.lit("-"), F.round(F.col("l_discount") * 100).cast("long")))
    texts = table(spark, sf_dir, "documents").select("lang", "text").unionByName(table(spark, sf_dir, "lineitem").select(F.lit("lines").alias("lang"), line.alias("text")))
    words = F.filter(F.regexp_extract_all("text", F.lit("([^\\x20\\x09-\\x0D]+)"), 1), lambda w: w.rlike("[0-9]"))
    rows = texts.select("lang", F.explode(words).alias("word")).withColumn("w", F.regexp_replace("word", "^[(]+|[,;:!?)]+$|[.]+[,;:!?)]*$", ""))
    w = F.col("w")
    doubled = w.rlike("^(?:([0-9.])\\1)+$") & w.contains("..")
    kind = F.when(w.rlike("^R[0-9]{1,9}$"), "bib").when(doubled, "doubled").when(w.rlike("^-?[0-9]{1,9}([.][0-9]+)?$"), "plain").when(w.rlike("^[0-9]{1,9}([.][0-9]+)?(-[0-9]{1,9}([.][0-9]+)?)+$"), "glued").otherwise("text")
    parts = (
        F.when(kind == "bib", F.array(F.substring(w, 2, 9)))
        .when(kind == "doubled", F.array(F.regexp_replace(w, "(.)\\1", "$1")))
        .when(kind == "plain", F.array(w))
        .when(kind == "glued", F.regexp_extract_all(w, F.lit("(-?[0-9.]+)"), 1))
        .otherwise(F.array(F.lit(None).cast("string")))
    )
    hundredths = F.round(F.col("part").try_cast("double") * 100).cast("long")
    each = rows.select("lang", "word", kind.alias("kind"), F.posexplode(parts).alias("at", "part")).withColumn("v", hundredths)
    return each.groupBy("lang", "kind").agg(F.count_if(F.col("at") == 0).alias("n_words"), F.count("v").alias("n_numbers"), F.count_distinct("v").alias("n_values"), F.coalesce(F.sum("v"), F.lit(0)).alias("total"))


#: The first year of each era less one; English months in order.
ERAS = {"S": 1925, "H": 1988, "R": 2018, "昭和": 1925, "平成": 1988, "令和": 2018}
MONTHS = ("January", "February", "March", "April", "May", "June", "July", "August", "September", "October", "November", "December")


def read_date(text):
    """The date of a printed form, as a column: `SAT 30 NOV 2024`, `December 17, 2016`, `H28.12.17` and `平成28年12月17日` (eras), `2016年12月17日`, `17/12/2016`. A slash form
    that could be read both ways, a day that does not exist and any other text give null."""
    month = F.create_map(*[F.lit(x) for i, m in enumerate(MONTHS, 1) for x in (m[:3].upper(), i)])
    era = F.create_map(*[F.lit(x) for pair in ERAS.items() for x in pair])
    got = lambda pattern, g: F.nullif(F.regexp_extract(text, pattern, g), F.lit(""))
    whole = lambda pattern, g: got(pattern, g).try_cast("int")
    made = lambda y, m, d: F.format_string("%04d-%02d-%02d", y, m, d).try_cast("date")
    named = lambda pattern, g: F.try_element_at(month, F.upper(F.substring(got(pattern, g), 1, 3)))
    day_first, month_first = r"^[A-Z]{3} (\d{1,2}) ([A-Z]{3}) (\d{4})$", r"^([A-Z][a-z]+) (\d{1,2}), (\d{4})$"
    eras, western, slash = r"^([SHR]|昭和|平成|令和)(\d{1,2})(?:[.]|年)(\d{1,2})(?:[.]|月)(\d{1,2})日?$", r"^(\d{4})年(\d{1,2})月(\d{1,2})日$", r"^(\d{1,2})/(\d{1,2})/(\d{4})$"
    a, b, y = (whole(slash, g) for g in (1, 2, 3))
    return F.coalesce(
        made(whole(day_first, 3), named(day_first, 2), whole(day_first, 1)),
        made(whole(month_first, 3), named(month_first, 1), whole(month_first, 2)),
        made(F.try_element_at(era, got(eras, 1)) + whole(eras, 2), whole(eras, 3), whole(eras, 4)),
        made(whole(western, 1), whole(western, 2), whole(western, 3)),
        F.when((b > 12) | (a == b), made(y, a, b)).when(a > 12, made(y, b, a)),
    )


def printed_dates(spark, sf_dir):
    """Days of all orders, printed in seven forms by the cents of the price (the seventh is a day that does not exist), read back; with season label and end year."""
    day = F.to_date("o_orderdate")
    rows = table(spark, sf_dir, "orders").select("o_orderkey", day.alias("day"), F.pmod(F.round(F.col("o_totalprice") * 100).cast("long"), F.lit(7)).alias("form"))
    d, m, y = F.dayofmonth("day"), F.month("day"), F.year("day")
    name = F.element_at(F.array(*map(F.lit, MONTHS)), m)
    week = F.element_at(F.array(*[F.lit(x) for x in ("SUN", "MON", "TUE", "WED", "THU", "FRI", "SAT")]), F.dayofweek("day"))
    printed = (
        F.when(F.col("form") == 0, F.format_string("%s %02d %s %d", week, d, F.upper(F.substring(name, 1, 3)), y))
        .when(F.col("form") == 1, F.format_string("%s %d, %d", name, d, y))
        .when(F.col("form") == 2, F.format_string("平成%d年%d月%d日", y - ERAS["平成"], m, d))
        .when(F.col("form") == 3, F.format_string("H%d.%d.%d", y - ERAS["H"], m, d))
        .when(F.col("form") == 4, F.format_string("%d年%d月%d日", y, m, d))
        .when(F.col("form") == 5, F.format_string("%d/%d/%d", d, m, y))
        .otherwise(F.format_string("%s 31 FEB %d", week, y))
    )
    rows = rows.select("o_orderkey", printed.alias("printed")).withColumn("date", read_date(F.col("printed")))
    end = F.year("date") + (F.month("date") >= 7).cast("int")
    return rows.select("o_orderkey", "printed", "date", end.cast("long").alias("end_year"), F.format_string("%d/%02d", end - 1, end % 100).alias("season_label")).withColumn("season_label", F.when(F.col("date").isNotNull(), F.col("season_label")))


#: Rounds by the first letter of an attachment's title, and their order.
ROUND_OF = {"a": "F", "d": "Q1", "e": "Q", "s": "Q2", "t": "Q"}
ROUND_ORDER = ("Q", "Q1", "Q2", "F")


def page_attachments(spark, sf_dir):
    """Attachments (links) of each page: those to one address count once, entities of titles are read, titles name rounds; the general qualification is dropped where one of its two parts
    is there. Rounds in order, how many links, addresses and unnamed ones."""
    html = F.regexp_replace("html", "(?s)<(script|style)[^>]*>.*?</(script|style)>", "")
    links = table(spark, sf_dir, "pages").select("page_id", F.posexplode(F.regexp_extract_all(html, F.lit('(<a [^>]*href="[^"]*"[^>]*>[^<]*</a>)'), 1)).alias("at", "link"))
    title = F.regexp_replace(F.regexp_extract("link", ">([^<]*)<", 1), "&nbsp;", " ")
    for entity, sign in (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&amp;", "&")):
        title = F.replace(title, F.lit(entity), F.lit(sign))
    links = links.select("page_id", "at", F.regexp_extract("link", 'href="([^"]*)"', 1).alias("href"), F.trim(title).alias("title"))
    one = links.groupBy("page_id", "href").agg(F.count("*").alias("n"), F.min_by("title", "at").alias("title"))
    word = F.create_map(*[F.lit(x) for pair in ROUND_OF.items() for x in pair])
    one = one.withColumn("code", F.try_element_at(word, F.lower(F.substring("title", 1, 1))))
    each = one.groupBy("page_id").agg(F.sum("n").alias("n_links"), F.count("*").alias("n_addresses"), F.count_if(F.col("code").isNull()).alias("n_unnamed"), F.collect_set("code").alias("codes"), F.max("title").alias("last_title"))
    parts = F.array_contains("codes", "Q1") | F.array_contains("codes", "Q2")
    kept = F.filter(F.array(*map(F.lit, ROUND_ORDER)), lambda c: F.array_contains("codes", c) & ~((c == "Q") & parts))
    return each.select("page_id", "n_links", "n_addresses", "n_unnamed", F.array_join(kept, " ").alias("rounds"), "last_title")


LIST = (page_blocks, table_pace, column_meanings, number_tokens, printed_dates, page_attachments)
_DAY = "CAST(o_orderdate AS DATE)"
_CLEAN = r"regexp_replace(word, '^[(]+|[,;:!?)]+$|[.]+[,;:!?)]*$', '', 'g')"
SQL = {
    "page_blocks": f"""WITH r AS (SELECT o_custkey, o_orderstatus, o_orderkey, {_DAY} AS day, l_linenumber, l_partkey, trunc(l_quantity)::BIGINT AS qty, l_returnflag FROM lineitem JOIN orders ON l_orderkey = o_orderkey),
 b AS (SELECT *, count(*) FILTER (WHERE l_returnflag = 'A') OVER (PARTITION BY o_custkey, o_orderstatus ORDER BY day, o_orderkey, l_linenumber, l_partkey, qty ROWS UNBOUNDED PRECEDING) AS block FROM r)
 SELECT o_custkey, o_orderstatus, block, count(*) AS n_lines, sum(qty)::BIGINT AS qty, arg_min(o_orderkey, (day, o_orderkey)) AS first_page, arg_max(o_orderkey, (day, o_orderkey)) AS last_page FROM b GROUP BY 1, 2, 3""",
    "table_pace": f"""WITH t AS (SELECT l_orderkey, min(round(l_tax * 100)::BIGINT) FILTER (WHERE l_returnflag = 'R') AS own, max(round(l_tax * 100)::BIGINT) AS page FROM lineitem GROUP BY 1),
 p AS (SELECT o_orderkey, o_custkey, o_orderstatus AS s, {_DAY} AS day, own, page FROM orders JOIN t ON l_orderkey = o_orderkey)
 SELECT o_orderkey, coalesce(own, k, page) AS pace, CASE WHEN own IS NOT NULL THEN 'own' WHEN k IS NOT NULL THEN 'known' ELSE 'page' END AS how
 FROM (SELECT p.*, (SELECT arg_max(q.own, (q.day, q.o_orderkey)) FROM p q WHERE q.own IS NOT NULL AND q.o_custkey = p.o_custkey AND q.s = p.s AND p.s <> 'P' AND (q.day, q.o_orderkey) < (p.day, p.o_orderkey)) AS k FROM p)""",
    "column_meanings": """WITH e AS (SELECT event_id, user_id, CAST(ts AS DATE) AS day, epoch_us(ts) AS x, event_type AS t, round(value * 100)::BIGINT AS cents FROM events),
 f AS (SELECT user_id, day, min((x, event_id)) FILTER (WHERE t = 'click') AS total, min((x, event_id)) FILTER (WHERE t = 'signup') AS dd FROM e GROUP BY 1, 2),
 c AS (SELECT e.*, CASE WHEN t = 'click' THEN 'click' WHEN t = 'signup' THEN 'factor' WHEN total IS NULL OR (x, event_id) < total THEN 'turn' WHEN dd IS NOT NULL AND (x, event_id) > dd THEN 'air' ELSE 'unknown' END AS class FROM e JOIN f USING (user_id, day) WHERE t IN ('view', 'click', 'signup')),
 n AS (SELECT *, row_number() OVER (PARTITION BY user_id, day, class ORDER BY x, event_id) AS k FROM c),
 m AS (SELECT *, CASE WHEN class = 'click' THEN CASE k WHEN 1 THEN 'turns' WHEN 2 THEN 'air' ELSE 'unknown' END WHEN class IN ('turn', 'air') THEN class || ' ' || k ELSE class END AS meaning FROM n),
 p AS (SELECT a.event_id, a.user_id, a.day, a.cents, b.event_id AS column_id, b.meaning, b.cents AS of_column, row_number() OVER (PARTITION BY a.event_id ORDER BY abs(a.x - b.x), CASE WHEN (b.x, b.event_id) < (a.x, a.event_id) THEN 0 ELSE 1 END,
  CASE WHEN (b.x, b.event_id) < (a.x, a.event_id) THEN -b.event_id ELSE b.event_id END) AS rn FROM e a LEFT JOIN m b ON a.user_id = b.user_id AND a.day = b.day WHERE a.t IN ('purchase', 'error'))
 SELECT event_id, column_id, meaning, CASE WHEN column_id IS NULL THEN 'no column' WHEN count(*) OVER (PARTITION BY column_id) > 1 THEN 'collision' ELSE 'ok' END AS state, cents - of_column AS difference FROM p WHERE rn = 1""",
    "number_tokens": rf"""WITH l AS (SELECT 'lines' AS lang, 'R' || l_linenumber || ' ' || CASE WHEN l_returnflag = 'R' THEN regexp_replace(printf('%.2f', l_extendedprice), '(.)', '\1\1', 'g') ELSE printf('%.2f', l_extendedprice) END
  || ' ' || trunc(l_quantity)::BIGINT || '-' || round(l_discount * 100)::BIGINT AS text FROM lineitem),
 w AS (SELECT lang, unnest(regexp_extract_all(text, '[^ \t-\r]+')) AS word FROM (SELECT lang, text FROM documents UNION ALL FROM l)),
 c AS (SELECT lang, {_CLEAN} AS w FROM w WHERE regexp_matches(word, '[0-9]')),
 k AS (SELECT lang, w, CASE WHEN regexp_matches(w, '^R[0-9]{{1,9}}$') THEN 'bib' WHEN contains(w, '..') AND regexp_full_match(w, '[0-9.]+') AND regexp_replace(regexp_replace(w, '(.).', '\1', 'g'), '(.)', '\1\1', 'g') = w THEN 'doubled'
  WHEN regexp_matches(w, '^-?[0-9]{{1,9}}([.][0-9]+)?$') THEN 'plain' WHEN regexp_matches(w, '^[0-9]{{1,9}}([.][0-9]+)?(-[0-9]{{1,9}}([.][0-9]+)?)+$') THEN 'glued' ELSE 'text' END AS kind FROM c),
 p AS (SELECT lang, kind, unnest(s) AS part FROM (SELECT *, CASE kind WHEN 'bib' THEN [w[2:]] WHEN 'doubled' THEN [regexp_replace(w, '(.).', '\1', 'g')] WHEN 'plain' THEN [w] WHEN 'glued' THEN regexp_extract_all(w, '-?[0-9.]+') ELSE [NULL] END AS s FROM k)),
 v AS (SELECT *, round(try_cast(part AS DOUBLE) * 100)::BIGINT AS v FROM p)
 SELECT a.lang, a.kind, n_words, n_numbers, n_values, total FROM (SELECT lang, kind, count(v) AS n_numbers, count(DISTINCT v) AS n_values, coalesce(sum(v), 0)::BIGINT AS total FROM v GROUP BY 1, 2) a JOIN (SELECT lang, kind, count(*) AS n_words FROM k GROUP BY 1, 2) b ON a.lang = b.lang AND a.kind = b.kind""",
    "printed_dates": f"""WITH o AS (SELECT o_orderkey, {_DAY} AS d, round(o_totalprice * 100)::BIGINT % 7 AS f FROM orders),
 p AS (SELECT o_orderkey, CASE f WHEN 0 THEN upper(strftime(d, '%a %d %b %Y')) WHEN 1 THEN strftime(d, '%B %-d, %Y') WHEN 2 THEN '平成' || (year(d) - 1988) || '年' || month(d) || '月' || day(d) || '日' WHEN 3 THEN 'H' || (year(d) - 1988) || '.' || month(d) || '.' || day(d)
  WHEN 4 THEN strftime(d, '%Y年%-m月%-d日') WHEN 5 THEN strftime(d, '%-d/%-m/%Y') ELSE upper(strftime(d, '%a')) || ' 31 FEB ' || year(d) END AS printed, CASE WHEN f = 6 OR f = 5 AND day(d) <= 12 AND day(d) <> month(d) THEN NULL ELSE d END AS date FROM o)
 SELECT *, year(date + INTERVAL 6 MONTH) AS end_year, CASE WHEN date IS NOT NULL THEN printf('%d/%02d', year(date + INTERVAL 6 MONTH) - 1, year(date + INTERVAL 6 MONTH) % 100) END AS season_label FROM p""",
    "page_attachments": r"""WITH h AS (SELECT page_id, regexp_replace(html, '(?s)<(?:script|style)[^>]*>.*?</(?:script|style)>', '', 'g') AS html FROM pages),
 l AS (SELECT page_id, unnest(x) AS link, generate_subscripts(x, 1) AS i FROM (SELECT page_id, regexp_extract_all(html, '<a [^>]*href="[^"]*"[^>]*>[^<]*</a>') AS x FROM h)),
 t AS (SELECT page_id, i, regexp_extract(link, 'href="([^"]*)"', 1) AS href, trim(replace(replace(replace(replace(replace(regexp_extract(link, '>([^<]*)<', 1), '&nbsp;', ' '), '&lt;', '<'), '&gt;', '>'), '&quot;', '"'), '&amp;', '&')) AS title FROM l),
 o AS (SELECT page_id, href, count(*) AS n, arg_min(title, i) AS title FROM t GROUP BY 1, 2),
 c AS (SELECT *, CASE lower(title[1]) WHEN 'a' THEN 'F' WHEN 'd' THEN 'Q1' WHEN 'e' THEN 'Q' WHEN 's' THEN 'Q2' WHEN 't' THEN 'Q' END AS code FROM o),
 k AS (SELECT DISTINCT page_id, code FROM c a WHERE code IS NOT NULL AND NOT (code = 'Q' AND EXISTS (SELECT 1 FROM c b WHERE b.page_id = a.page_id AND b.code IN ('Q1', 'Q2'))))
 SELECT page_id, sum(n)::BIGINT AS n_links, count(*) AS n_addresses, count(*) FILTER (WHERE code IS NULL) AS n_unnamed, coalesce((SELECT string_agg(code, ' ' ORDER BY CASE code WHEN 'Q' THEN 0 WHEN 'Q1' THEN 1 WHEN 'Q2' THEN 2 ELSE 3 END) FROM k WHERE k.page_id = c.page_id), '') AS rounds, max(title) AS last_title FROM c GROUP BY 1""",
}
