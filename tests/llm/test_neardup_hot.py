"""Large buckets: a group of near copies, a chain and texts that share a long passage, searched in small blocks, against brute force."""

import random

import pytest
from pyspark.sql import SparkSession

from runledger.llm import neardup


def texts():
    pick = random.Random(11)
    words = ["".join(pick.choices("abcdefgh", k=5)) for _ in range(2000)]
    fresh = lambda n: pick.choices(words, k=n)
    base, passage, out = fresh(120), fresh(100), []
    for _ in range(60):
        near = list(base)
        near[pick.randrange(120)] = pick.choice(words)
        out.append(near)
    chain = list(base)
    for i in range(0, 120, 2):
        chain[i] = pick.choice(words)
        out.append(list(chain))
    out += [passage + fresh(12) for _ in range(60)]
    out += [fresh(40) for _ in range(20)]
    pick.shuffle(out)
    return [" ".join(w) for w in out]


def plain(data):
    sets = [{tuple(w[i : i + 3]) for i in range(len(w) - 2)} for w in map(str.split, data)]
    root = list(range(len(data)))

    def top(i):
        while root[i] != i:
            i = root[i]
        return i

    for a in range(len(sets)):
        for b in range(a):
            if 100 * len(sets[a] & sets[b]) >= 85 * len(sets[a] | sets[b]):
                x, y = sorted((top(a), top(b)))
                root[y] = x
    return {i: top(i) for i in range(len(data))}


@pytest.mark.parametrize("stars", [0, 1])
def test_large_buckets_equal_brute_force(monkeypatch, stars):
    spark = SparkSession.builder.master("local[4]").config("spark.sql.shuffle.partitions", "4").config("spark.ui.enabled", "false").getOrCreate()
    monkeypatch.setattr(neardup, "BLOCK", 7)
    data = texts()
    docs = spark.createDataFrame(list(enumerate(data)), "doc_id long, text string").repartition(3)
    want = plain(data)
    got = {r["doc_id"]: r["component_id"] for r in neardup.near_duplicates(docs, 3, 85, stars=stars).collect()}
    assert got == want and 20 < len(set(want.values())) < len(data) - 60


def test_words_that_share_polynomial_hashes():
    """The Thue-Morse word and its complement are different words, so the two texts share no shingle."""
    import pyarrow as pa

    word = "a"
    for _ in range(10):
        word += word.translate(str.maketrans("ab", "ba"))
    column = pa.array([word, word.translate(str.maketrans("ab", "ba")), word.upper()], pa.large_string())
    ((_, _, borders, s),) = neardup.shingle_sets(column, 3)
    sets = [set(s[a:b].tolist()) for a, b in zip(borders[:-1], borders[1:])]
    assert sets[0] == sets[2] and not sets[0] & sets[1]
