"""K-d shards against a plain tree over the same rows, with nulls, empty, repeated and long texts."""

import zlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import SparkSession

from runledger.llm.kd_shards import shard_by_bytes

COLUMNS = "doc_id long, text string, size int, shard string, node long"


@pytest.fixture(scope="module")
def spark():
    return SparkSession.builder.master("local[4]").config("spark.sql.shuffle.partitions", "4").config("spark.ui.enabled", "false").getOrCreate()


def rows():
    texts = [None, "", "", "x" * 4000] + ["word " * (i % 37 + 1) + str(i) for i in range(400)] + ["日本語" * (i % 11 + 1) + str(i) for i in range(150)] + ["copy of one text"] * 30
    return [*enumerate(texts), (3, texts[3]), (None, "no id"), (None, "no id")]


def test_laws(spark):
    data = rows()
    got = shard_by_bytes(spark.createDataFrame([(d, t, 1, "x", 2) for d, t in data], COLUMNS)).collect()
    want = Counter((d, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for d, t in data)
    assert Counter((r["doc_id"], r["size"], r["text_crc32"]) for r in got) == want
    shards, of_text = defaultdict(list), defaultdict(set)
    for r in got:
        shards[r["shard"]].append(r)
        of_text[r["text_crc32"], r["size"]].add(r["shard"])
    assert sorted(shards) == list(range(8)) and all(len(s) == 1 for s in of_text.values())
    assert all(sorted(r["slot"] for r in own) == list(range(len(own))) for own in shards.values())
    size = [sum(r["size"] for r in own) for own in shards.values()]
    assert max(size) - min(size) <= 2 * 4001
    assert {(r["law"], r["grown_shard"]) for r in got} == {("bytes", None)}


def test_target_bytes_and_hot_text(spark):
    data = [(i, "the same text " * 20) for i in range(200)] + [(1000 + i, f"text {i} " * 30) for i in range(400)]
    df = spark.createDataFrame([(d, t, 1, "x", 2) for d, t in data], COLUMNS)
    size = Counter()
    for r in shard_by_bytes(df, target_bytes=10_000).collect():
        size[r["shard"]] += r["size"]
    hot = 200 * (len("the same text " * 20) + 1)
    assert sorted(size.values())[-1] >= hot and sorted(size.values())[-2] <= 10_000 * 2**0.5


def test_empty_table(spark):
    assert shard_by_bytes(spark.createDataFrame([], COLUMNS)).collect() == []


def plain_tree(sizes, shards=8):
    """{text: shard} by a plain k-d tree: heavy texts first, then cuts at the nearer side of the shards' share."""
    import math

    import xxhash

    total, weight, out = sum(w for _, w in sizes), Counter(), {}
    for t, w in sizes:
        weight[t] += w
    top = sorted(weight, key=lambda t: -weight[t])
    for t in top[: shards - 1]:
        if weight[t] * (shards - len(out)) < total:
            break
        total -= weight[t]
        out[t] = shards - 1 - len(out)
    h = {t: xxhash.xxh64_intdigest(t.encode(), seed=42) & ((1 << 40) - 1) for t in weight}
    fine = (1 << 20) - 1
    d = {t: (math.floor(min(math.log2(len(t.encode()) + 1) / 40, 1) * fine), math.floor(min((len(t.encode()) + 1) / (len(t) + 1) - 1, 3) / 3 * fine)) for t in weight}

    def cut(texts, first, k):
        if k == 1 or len(texts) == 1:
            out.update(dict.fromkeys(texts, first))
            return
        if not texts:
            return
        spread = [max(d[t][i] for t in texts) - min(d[t][i] for t in texts) for i in (0, 1)]
        dim = int(spread[1] > spread[0])
        texts = sorted(texts, key=lambda t: (d[t][dim], h[t]))
        whole, share, before = sum(weight[t] for t in texts), k // 2 / k, 0
        for n, t in enumerate(texts):  # noqa: B007
            if whole * share <= before + weight[t]:
                break
            before += weight[t]
        if not (before and (whole * share - before < before + weight[t] - whole * share or before + weight[t] == whole)):
            n += 1
        cut(texts[:n], first, k // 2)
        cut(texts[n:], first + k // 2, k - k // 2)

    cut([t for t in weight if t not in out], 0, shards - len(out))
    return out


def lengths(seed):
    import random

    pick = random.Random(seed)
    return [max(1, int(pick.lognormvariate(6, 1.3))) for _ in range(pick.choice([3, 9, 20, 60]))]


@pytest.mark.parametrize("seed", range(8))
def test_skewed_tables_equal_a_plain_tree(spark, seed):
    """Small tables of heavy-tailed lengths: shards 0 to 7 alone, as the plain tree has them."""
    texts = [chr(97 + i % 26) * n + str(i) for i, n in enumerate(lengths(seed))] * 1
    got = shard_by_bytes(spark.createDataFrame([(i, t, 1, "x", 2) for i, t in enumerate(texts)], COLUMNS)).collect()
    want = plain_tree([(t, len(t.encode()) + 1) for t in texts])
    assert {r["doc_id"]: r["shard"] for r in got} == {i: want[t] for i, t in enumerate(texts)}
    assert {r["shard"] for r in got} <= set(range(8))


def test_plain_tree_is_near_equal():
    """200 random tables: eight shards, none far above an even share or the heaviest text."""
    for seed in range(200):
        texts = [chr(97 + i % 26) * n + str(i) for i, n in enumerate(lengths(seed + 1000))]
        sizes = [(t, len(t) + 1) for t in texts]
        shard, load = plain_tree(sizes), Counter()
        for t, w in sizes:
            load[shard[t]] += w
        assert set(load) <= set(range(8))
        if len(texts) >= 20:
            assert max(load.values()) <= max(max(w for _, w in sizes), 2.2 * sum(w for _, w in sizes) / 8)
