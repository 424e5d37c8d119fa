"""The one name to show of many printed forms."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from runledger.functions.affiliations import glued, surname_changed


def display_names(prints: DataFrame, by: str, form: str, order: Column, known: Column, foreign: Column | None = None) -> DataFrame:
    """by, name, n_forms, n_glued: one row a person. order tells prints apart and puts them in time.

    Forms in CJK letters go before the rest (a foreigner's Latin ones before kana alone), glued ones (of another form in the same letters) behind clean
    ones; then the most frequent, of equals the one seen first. A newer surname replaces it, and a name of CJK letters without a blank gives way to
    its spaced form. Prints are counted before anything else, so a person's windows see one row a form; all steps share one exchange by person.
    """
    own = Window.partitionBy(by)
    cjk = F.col(form).rlike("[\u3005\u3041-\u30ff\u3400-\u9fff\uf900-\ufaff]")
    forms = prints.groupBy(by, form).agg(F.count("*").alias("n"), F.min(order).alias("first"), F.max(order).alias("last"), F.bool_or(F.lit(False) if foreign is None else foreign).alias("foreign"))
    forms = forms.withColumn("cjk", cjk).withColumn("others", F.collect_list(form).over(Window.partitionBy(by, "cjk")))
    forms = forms.withColumn("glued", glued(F.col(form), F.col("others"), known)).drop("others")
    kanji = F.col("cjk") & ~F.col("glued") & F.col(form).rlike("[\u4e00-\u9fff]")
    any_ = lambda x: F.bool_or(x).over(own)
    pool = F.when(any_(F.col("foreign")) & any_(~F.col("cjk")) & ~any_(kanji), ~F.col("cjk")).otherwise(F.col("cjk") | ~any_(F.col("cjk")))
    forms = forms.withColumn("pool", pool)
    forms = forms.withColumn("fits", F.col("pool") & (~F.col("glued") | ~any_(F.col("pool") & ~F.col("glued"))))
    rank, fits = F.struct((-F.col("n")).alias("n"), "first"), F.col("fits")
    spaced = F.collect_list(F.when(fits & F.col("cjk") & F.contains(form, F.lit(" ")), F.struct(rank.alias("rank"), F.col(form).alias("form"))))
    each = forms.groupBy(by).agg(
        F.min_by(form, F.when(fits, rank)).alias("best"), F.max_by(form, F.when(fits, F.col("last"))).alias("newest"), F.array_sort(spaced).alias("spaced"),
        F.count("*").alias("n_forms"), F.count_if("glued").alias("n_glued"),
    )
    each = each.withColumn("name", F.when(surname_changed(F.col("best"), F.col("newest")), F.col("newest")).otherwise(F.col("best")))
    same = F.filter("spaced", lambda x: F.replace(x["form"], F.lit(" "), F.lit("")) == F.col("name"))
    return each.select(by, F.coalesce(F.get(same, F.lit(0))["form"], F.col("name")).alias("name"), "n_forms", "n_glued")
