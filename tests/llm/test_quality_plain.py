"""op3's classifier against plain counts over dictionaries: n-grams, model, threshold, keys and the rows kept."""

import math
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from runledger.llm.bytescan import mix, span_hashes
from runledger.llm.quality import AGAIN, BITS, classify

SF = "/root/testdata/sf0.01"
TOKEN = re.compile(rb"([0-9a-z\x80-\xff]+)|([^0-9a-z\x80-\xff\x20\x09-\x0d]+)")


def hash_of(token: bytes, seen={}) -> int:  # noqa: B006
    if token not in seen:
        seen[token] = int(span_hashes(np.frombuffer(token, np.uint8), np.array([0]), np.array([len(token)]))[0])
    return seen[token]


def bucket(code: int) -> int:
    return int(mix(np.array([code % 2**64], np.uint64))[0]) >> (64 - BITS)


def plain_grams(text) -> Counter:
    codes, last = [], None
    for word, sign in TOKEN.findall((text or "").encode().lower()):
        codes.append(int(AGAIN) if word and word == last else hash_of(word or sign))
        last = word or last
    return Counter([bucket(c) for c in codes] + [bucket(a * 3 + b) for a, b in zip(codes, codes[1:])])


@pytest.fixture(scope="module")
def spark():
    return SparkSession.builder.master("local[4]").config("spark.sql.shuffle.partitions", "4").config("spark.ui.enabled", "false").getOrCreate()


def test_equals_plain_resampling(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").filter("doc_id < 600 AND length(text) < 8000").select("doc_id", "text")
    odd = spark.createDataFrame([(9000, None), (9001, ""), (9002, " \n"), (None, "no id at all"), (9003, "no no no, no - No: NO"), (9004, "Été !!")], docs.schema)
    docs = docs.union(odd).union(docs.filter("doc_id < 4"))
    labels = spark.read.parquet(f"{SF}/labels.parquet").filter("doc_id < 600").select("doc_id", "quality")
    data = [(r["doc_id"], plain_grams(r["text"])) for r in docs.collect()]
    fold = {r["doc_id"]: (r["quality"], r["fold"]) for r in labels.select("doc_id", "quality", F.pmod(F.xxhash64(F.col("doc_id").cast("long")), F.lit(2)).alias("fold")).collect()}
    raw, target = Counter(), Counter()
    for d, grams in data:
        raw.update(grams)
        if fold.get(d) == (1, 0):
            target.update(grams)
    n_raw, n_target = (sum(c.values()) + 2**BITS for c in (raw, target))
    weight = [sum(n * (math.log((target[b] + 1) / n_target) - math.log((raw[b] + 1) / n_raw)) for b, n in grams.items()) for _, grams in data]
    size = [sum(grams.values()) for _, grams in data]
    seen = [(w / n, fold[d][0]) for (d, _), w, n in zip(data, weight, size) if n and fold.get(d, (0, 0))[1] == 1]
    at = sorted({x for x, _ in seen})
    good, bad = ([x for x, q in seen if (q == 1) == want] for want in (True, False))
    assert len(good) > 20 and len(bad) > 3
    threshold = max(((a + b) / 2 for a, b in zip(at, at[1:])), key=lambda t: (2 * sum(x >= t for x in good) / len(good) + sum(x < t for x in bad) / len(bad), -t))
    noise = [-math.log(-math.log((int(mix(np.array([((d or 0) * 0x9E3779B97F4A7C15 + 77) % 2**64], np.uint64))[0]) >> 11) / 2**53)) for d, _ in data]
    key = [w - threshold * n + g if n else -math.inf for w, n, g in zip(weight, size, noise)]
    k = sum(n > 0 and w >= threshold * n for w, n in zip(weight, size))
    cutoff = sorted(key, reverse=True)[k - 1]
    assert 0 < k < len(data)
    order = lambda rows: sorted(rows, key=lambda r: (r[0] is None, r[0] or 0))
    want = order((d, n, w, x >= cutoff - 1e-6) for (d, _), n, w, x in zip(data, size, weight, key))
    got = order((r["doc_id"], r["n_grams"], r["log_weight"], r["kept"]) for r in classify(docs, labels).collect())
    assert [(d, n, kept) for d, n, _, kept in got] == [(d, n, kept) for d, n, _, kept in want]
    assert np.allclose([r[2] for r in got], [r[2] for r in want], rtol=1e-9, atol=1e-6)
