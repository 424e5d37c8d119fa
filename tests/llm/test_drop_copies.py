"""The pipeline's near-duplicate stage against brute force, with repeated rows, shared ids and null ids among the rows."""

import random
from collections import Counter

from pyspark.sql import SparkSession

from runledger.llm.neardup import drop_copies


def shingles(text):
    w = (text or "").split()
    return {tuple(w[i : i + 3]) for i in range(max(1, len(w) - 2))} if w else set()


def test_one_row_of_each_component_stays():
    spark = SparkSession.builder.master("local[4]").config("spark.sql.shuffle.partitions", "4").config("spark.ui.enabled", "false").getOrCreate()
    pick = random.Random(7)
    words = ["".join(pick.choices("abcde", k=4)) for _ in range(300)]
    fresh = lambda: " ".join(pick.choices(words, k=60))
    a, b = fresh(), fresh()
    near = " ".join([*a.split()[:-1], "other"])
    rows = [(1, a, "x"), (1, a, "x"), (1, a, "x"), (2, a, "y"), (2, b, "clean"), (3, near, "near"), (4, fresh(), "z"), (4, fresh(), "z"), (5, None, "n"), (5, None, "n"), (6, "", "e"), (None, b, "null id"), (None, fresh(), "null id")]
    rows += [(10 + i // 2, fresh(), "f") for i in range(20)]
    root = list(range(len(rows)))
    for _ in rows:
        for i in range(len(rows)):
            for j in range(i):
                p, q = shingles(rows[i][1]), shingles(rows[j][1])
                if p and q and 100 * len(p & q) >= 80 * len(p | q):
                    root[i] = root[j] = min(root[i], root[j])
    least = {}
    for i, r in sorted(enumerate(rows), key=lambda v: (v[1][0] is None, v[1][0] or 0, v[0])):
        least.setdefault(root[i], r)
    got = drop_copies(spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(5), 3, 80)
    assert got.columns == ["doc_id", "text", "lang"]
    assert Counter(map(tuple, got.collect())) == Counter(least.values())
