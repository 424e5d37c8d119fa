"""Ranked lexical search against a plain version, with several owners, bundles and groups, ties, nulls and repeated rows."""

import math
import random
import re
from collections import Counter

import pytest
from pyspark.sql import SparkSession

from runledger.llm.lexical import TERM, search


@pytest.fixture(scope="module")
def spark():
    return SparkSession.builder.master("local[4]").config("spark.sql.shuffle.partitions", "4").config("spark.ui.enabled", "false").getOrCreate()


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text)


def plain(docs, items, k):
    terms = [(i, re.findall(TERM, lower(t or ""))) for i, t in docs]
    n_docs, length = sum(bool(t) for _, t in terms), sum(len(t) for _, t in terms)
    df = Counter(w for _, t in terms for w in set(t))
    asked = {}
    for i, t in items:
        if i is not None:
            asked.setdefault(i, set()).update(re.findall(TERM, lower(t or "")))
    out = []
    for item, words in asked.items():
        scores = []
        for i, t in terms:
            tf = Counter(t)
            m = 100 - 90 + (90 * len(t) * n_docs) // max(1, length)
            s = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[w] + 1))) * ((10**9 * tf[w]) // (1000 * tf[w] + 8 * m)) for w in words if tf[w])
            if s > 0:
                scores.append((-s, i is None, i or 0, i))
        out += [(item, n + 1, i, -s) for n, (s, _, _, i) in enumerate(sorted(scores)[:k])]
    return sorted(map(repr, out))


def fixture(seed):
    pick = random.Random(seed)
    words = [f"w{i}" for i in range(300)] + ["Und", "das", "ist", "ñandú", "東京", "x1"]
    text = lambda n: " ".join(pick.choice(words[-6:] if pick.random() < 0.5 else words) + pick.choice(["", ",", ".-", "!\n"]) for _ in range(n))
    docs = [(i, text(pick.randrange(1, 60))) for i in range(250)]
    docs += [(i + 300, docs[i % 7][1]) for i in range(40)] + [(400, None), (401, ""), (402, "... --- !"), (5, docs[9][1]), (None, docs[3][1]), (403, text(30_000)), (404, "W1 W1 ÑANDÚ")]
    items = [(i, text(12)) for i in range(20)] + [(50, None), (51, ""), (52, "zzz yyy"), (None, "w1 w2"), (53, "und das ist"), (3, "w5 w6"), (54, docs[3][1])]
    return docs, items


@pytest.mark.parametrize(("owners", "bundle", "group"), [(4, 256, 8 << 20), (1, 256, 8 << 20), (7, 5, 8 << 20), (3, 4, 600)])
def test_equals_plain_version(spark, owners, bundle, group):
    docs, items = fixture(owners)
    table = spark.createDataFrame([(i, t, "x", 1) for i, t in docs], "doc_id long, text string, block string, score int").repartition(6)
    asked = spark.createDataFrame([(i, t, 2) for i, t in items], "item_id long, text string, rank int")
    assert sorted(map(repr, map(tuple, search(table, asked, 10, owners, bundle, group).collect()))) == plain(docs, items, 10)


def test_empty_tables(spark):
    docs, items = spark.createDataFrame([(1, "a b")], "doc_id long, text string"), spark.createDataFrame([(1, "a")], "item_id long, text string")
    assert search(docs.filter("doc_id > 1"), items).collect() == []
    assert search(docs, items.filter("item_id > 1")).collect() == []
    assert [tuple(r)[:3] for r in search(docs, items).collect()] == [(1, 1, 1)]
