"""Unicode forms against Python's tables, names with affiliations in them against plain versions."""

import random
import unicodedata

import pytest
from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from runledger.functions import affiliations, unicode
from runledger.operators.display import display_names


@pytest.fixture(scope="module")
def spark():
    return SparkSession.builder.master("local[4]").config("spark.sql.shuffle.partitions", "4").config("spark.sql.session.timeZone", "UTC").config("spark.ui.enabled", "false").getOrCreate()


def test_every_code_point(spark):
    rows = [(c, "a" + chr(c) + "b") for c in range(1, 0x110000) if not 0xD800 <= c < 0xE000]
    frame = spark.createDataFrame(rows, "c long, x string").repartition(4).select("c", unicode.nfkc(F.col("x")).alias("k"), unicode.normal(F.col("x")).alias("n"), unicode.fold(F.col("x")).alias("f"))
    texts = dict(rows)
    for r in frame.toLocalIterator():
        x = texts[r["c"]]
        k = unicodedata.normalize("NFKC", x)
        assert (r["k"], r["n"]) == (k, "".join(k.split()))
        assert r["f"] == "".join(d for d in unicodedata.normalize("NFKD", x) if not unicodedata.combining(d)).lower()


def test_nulls_and_marks(spark):
    rows = [(None,), ("",), ("Ｓｏｒｅｎ Å",), ("é　x",)]
    got = spark.createDataFrame(rows, "x string").select(unicode.normal(F.col("x")), unicode.fold(F.col("x")), unicode.alnum_key(F.col("x"))).collect()
    assert [tuple(r) for r in got] == [(None, None, None), ("", "", ""), ("SorenÅ", "soren a", "sorenå"), ("éx", "e x", "éx")]


KNOWN = ["千葉", "愛知", "韓国", "asia"]


def plain_glued(name, others):
    """Try all ways to take `other` out of the name in order, each letter at its first chance."""
    key = "".join(name.split())
    for other in others:
        o = "".join(other.split())
        if not o or o == key:
            continue
        at, taken = -1, []
        for c in o:
            at = key.find(c, at + 1)
            taken.append(at)
            if at < 0:
                break
        if -1 in taken:
            continue
        rest = "".join(c for i, c in enumerate(key) if i not in taken and not "｡" <= c <= "ﾟ")
        if (rest[:-1] if rest.endswith("県") else rest) in KNOWN:
            return True
    return False


def test_glued(spark):
    pick = random.Random(5)
    people, known = ["松本 ベンジャミン", "久保田 さくら", "ab cab", "aasia b", "千葉 愛"], F.array(*map(F.lit, KNOWN))
    rows = []
    for _ in range(400):
        name, aff = pick.choice(people), pick.choice(KNOWN + ["東京"]) + pick.choice(["", "県", "ﾁｰﾑ"])
        at = sorted(pick.randrange(len(name) + 1) for _ in aff)
        mixed = list(name)
        for i, c in reversed(list(zip(at, aff))):
            mixed.insert(i, c)
        rows.append(("".join(mixed), pick.sample(people, 3)))
    got = [r[0] for r in spark.createDataFrame(rows, "x string, o array<string>").coalesce(1).select(affiliations.glued(F.col("x"), F.col("o"), known)).collect()]
    assert got == [plain_glued(x, o) for x, o in rows] and 20 < sum(got) < 380


def shown(spark, prints, foreign=False):
    rows = [(1, form, i) for i, form in enumerate(prints)]
    frame = spark.createDataFrame(rows, "athlete long, form string, at long")
    return display_names(frame, "athlete", "form", F.col("at"), F.array(*map(F.lit, KNOWN)), F.lit(foreign)).collect()[0]["name"]


@pytest.mark.parametrize(("prints", "foreign", "want"), [
    (["MORI Aki"] * 3 + ["森 秋"], False, "森 秋"),
    (["KIM Jun"] + ["キム ジュン"] * 2, True, "KIM Jun"),
    (["KIM Jun"] + ["キム ジュン"] * 2 + ["金 俊"], True, "キム ジュン"),
    (["KIM Jun", "キム ジュン", "キム ジュン韓国"], True, "KIM Jun"),
    (["松本 ベンジャミ千ン葉"] * 3 + ["松本 ベンジャミン"], False, "松本 ベンジャミン"),
    (["新田 奈津"] * 3 + ["浅見 奈津"], False, "浅見 奈津"),
    (["山碕 彰子"] * 2 + ["山崎 彰子"], False, "山碕 彰子"),
    (["島田知弥"] * 2 + ["島田 知弥"], False, "島田 知弥"),
    (["b a", "a b"], False, "b a"),
    (["only千葉"], False, "only千葉"),
])
def test_display_name(spark, prints, foreign, want):
    assert shown(spark, prints, foreign) == want


def test_affiliation_key_and_split(spark):
    rows = [("千葉県", "ﾁｰﾑ ｼﾞｮｯｸｽ"), ("千葉", "チームジョックス"), ("ﾁｰﾑ", "ｽﾉｰ"), (None, "Ａ・Ｂ"), ("千葉", None), ("ASIA", "x")]
    a, c = affiliations.affiliation_key(F.col("p"), F.col("c"), F.array(*map(F.lit, KNOWN)))
    got = [tuple(r) for r in spark.createDataFrame(rows, "p string, c string").coalesce(1).select(a, c).collect()]
    assert got == [("千葉", "チームジョックス"), ("千葉", "チームジョックス"), (None, "チームスノー"), (None, "ab"), ("千葉", ""), ("asia", "x")]
    split = affiliations.split_interleaved(F.col("x"), F.array(*map(F.lit, KNOWN)))
    got = [tuple(r) for r in spark.createDataFrame([("K千im J葉un",), ("Kim",), ("金Kim",)], "x string").coalesce(1).select(*split).collect()]
    assert got == [("Kim Jun", "千葉", "千葉"), ("Kim", "", None), ("Kim", "金", None)]
