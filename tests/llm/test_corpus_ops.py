"""Small fixtures with null, empty, repeated, long and tied rows and clashing extra columns, against plain versions."""

import hashlib
import itertools
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import SparkSession

from runledger.llm import fingerprint, lm, neardup, packing, quality

COLUMNS = "doc_id long, text string, lang string, node long, key double, block int"
LOW = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


@pytest.fixture(scope="module")
def spark():
    return SparkSession.builder.master("local[4]").config("spark.sql.shuffle.partitions", "4").config("spark.ui.enabled", "false").getOrCreate()


def rows():
    pick = random.Random(5)
    words = ["".join(pick.choices("abcdeÉß", k=4)) for _ in range(300)]
    texts = [None, "", "  \n", "One", "one", "two Words"]
    base = pick.choices(words, k=60)
    for i in range(30):
        near = list(base)
        for _ in range(i % 5):
            near[pick.randrange(60)] = pick.choice(words)
        texts.append(" ".join(near))
    texts += [" ".join(pick.choices(words, k=pick.randint(1, 80))) for _ in range(20)] + [" ".join(pick.choices(words, k=4000))] * 2
    return [(i * 3, t, None if i % 4 else "en", 1, 0.5, i) for i, t in enumerate(texts)]


def words_of(text):
    return re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOW))


def test_near_duplicates_equal_brute_force(spark):
    data = rows()
    got = {r["doc_id"]: r for r in neardup.near_duplicates(spark.createDataFrame(data, COLUMNS), 3, 85).collect()}
    sets, root = {}, {d: d for d, *_ in data}
    for d, text, *_ in data:
        w = words_of(text)
        sets[d] = {tuple(w[i : i + 3]) for i in range(max(1, len(w) - 2))} if w else set()
    for _ in data:
        for a, b in itertools.combinations(sets, 2):
            if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 85 * len(sets[a] | sets[b]):
                root[a] = root[b] = min(root[a], root[b])
    assert {d: (r["n_shingles"], r["component_id"], r["kept"]) for d, r in got.items()} == {d: (len(sets[d]), root[d], root[d] == d) for d in sets}


@pytest.mark.parametrize(("order", "block_bytes"), [(2, 4000), (3, 4000), (4, 1 << 24)])
def test_language_model_equals_plain_sums(spark, order, block_bytes):
    data = [*rows(), (1000, "one two words", None, 1, 0.5, 7), (1000, "one two words", None, 1, 0.5, 7), (None, "null id", None, 1, 0.5, 8)]
    held = {d: d is not None and zlib.crc32(str(d).encode()) % 5 == 1 for d, *_ in data}
    grams, mu = Counter(), 7.0
    for d, text, *_ in data:
        v = ("<", *words_of(text), ">")
        if not held[d]:
            grams.update(v[i : i + k] for k in range(1, order + 1) for i in range(len(v) - k + 1))
    start = grams.pop(("<",))
    total, distinct = (f(c for g, c in grams.items() if len(g) == 1) for f in (sum, lambda c: len(list(c))))
    grams["<",] = start

    def chance(h, w):
        if not h:
            return (grams[w,] + 0.5) / (total + 0.5 * (distinct + 1))
        return (grams[*h, w] + mu * chance(h[1:], w)) / (grams[h] + mu)

    want = []
    for d, text, *_ in data:
        v = ("<", *words_of(text), ">")
        base = sum(math.log10(chance((), w)) for w in v[1:])
        full = sum(math.log10(chance(v[max(0, i - order + 1) : i], v[i])) for i in range(1, len(v)))
        want.append((d, held[d], len(v) - 1, sum((w,) in grams for w in v[1:]), total, base, full))
    got = lm.score(spark.createDataFrame(data, COLUMNS).repartition(3), order=order, mu=mu, block_bytes=block_bytes).collect()
    got = sorted((-1 if r["doc_id"] is None else r["doc_id"], *r[1:]) for r in got)
    assert len(got) == len(want)
    for g, w in zip(got, sorted((-1 if d is None else d, *r) for d, *r in want)):
        assert g[:5] == w[:5] and math.isclose(g[5], w[5], rel_tol=1e-9) and math.isclose(g[6], w[6], rel_tol=1e-9)


def test_fingerprints(spark):
    data = rows()
    text = {d: t or "" for d, t, *_ in data}
    ids = sorted(text, reverse=True)
    following = dict(zip(ids, ids[1:] + ids[:1]))
    got = {r["doc_id"]: r for r in fingerprint.compare_with_next(spark.createDataFrame(data, COLUMNS), range_bytes=5000).collect()}
    assert got.keys() == text.keys()
    for d, r in got.items():
        x, n = text[d], len(text[d])
        edited = x[: n - n // 3] + text[following[d]][: n // 3]
        assert r["n_chars"] == n and r["edited_sha256"] == hashlib.sha256(edited.encode()).hexdigest()
        assert (r["fingerprint"], r["edited_fingerprint"]) == (fingerprint.fingerprint(x), fingerprint.fingerprint(edited))
        assert r["near_edited"] == plain_likeness(r["fingerprint"], r["edited_fingerprint"])
        assert r["near_next"] == plain_likeness(r["fingerprint"], got[following[d]]["fingerprint"])


def plain_likeness(x, y):
    if x == y:
        return 1.0
    sides, best = [], 0.0
    for mark in (x, y):
        size, single, double = mark.split(":")
        sides.append({int(size): single, 2 * int(size): double})
    for size in sides[0]:
        a, b = sides[0][size], sides[1].get(size, "")
        if a and b:
            row = list(range(len(b) + 1))
            for i, c in enumerate(a, 1):
                last, row[0] = row[0], i
                for j, e in enumerate(b, 1):
                    last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (c != e))
            best = max(best, 1 - row[-1] / max(len(a), len(b)))
    return best


def test_fingerprints_of_one_hot_id(spark):
    """One id on most rows, equal rows among them, and null ids: every row once, each row's next differs in place alone."""
    texts = [f"text {i % 40} " * 30 for i in range(300)]
    data = [(7 if i % 10 else (None if i % 20 else 9), t, None, 1, 0.5, i) for i, t in enumerate(texts)]
    got = fingerprint.compare_with_next(spark.createDataFrame(data, COLUMNS), range_bytes=4000).collect()
    assert Counter((r["doc_id"], r["fingerprint"]) for r in got) == Counter((d, fingerprint.fingerprint(t)) for d, t, *_ in data)
    edited = {(hashlib.sha256((a[: len(a) - len(a) // 3] + b[: len(a) // 3]).encode()).hexdigest()) for a in set(texts) for b in set(texts)}
    assert all(r["edited_sha256"] in edited for r in got)
    lone = fingerprint.compare_with_next(spark.createDataFrame(data[:1], COLUMNS)).collect()
    assert len(lone) == 1 and lone[0]["near_edited"] == lone[0]["near_next"] == 1.0


def test_packing_covers_every_token_once(spark):
    got = packing.pack(spark.createDataFrame(rows(), COLUMNS), public_tokenizers.path("byte_bpe_50k.json")).collect()
    places, docs = defaultdict(list), defaultdict(list)
    for r in got:
        places[r["sequence_id"]].append((r["offset"], r["length"]))
        docs[r["doc_id"]].append((r["piece"], r["start"], r["length"]))
    for own in places.values():
        end = 0
        for offset, length in sorted(own):
            assert offset == end
            end += length
        assert end <= 1024
    for own in docs.values():
        own.sort()
        assert [p for p, *_ in own] == list(range(len(own))) and [s for _, s, _ in own] == list(np.cumsum([0] + [n for *_, n in own])[:-1])
        assert all(n == 1024 for *_, n in own[1:])
    assert len(places) <= sum(r["length"] for r in got) / 1024 * 1.05 + 1


def test_quality_on_labelled_rows(spark):
    sf = "/root/testdata/sf0.01"
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    got = {r["doc_id"]: r["kept"] for r in quality.classify(spark.read.parquet(f"{sf}/documents.parquet"), labels).collect()}
    known = [(r["quality"], got[r["doc_id"]]) for r in labels.collect() if r["doc_id"] in got]
    assert sum(k for q, k in known if q == 1) >= 0.97 * sum(q == 1 for q, _ in known)
    assert sum(k for q, k in known if q == 0) <= 0.1 * sum(q == 0 for q, _ in known)


@pytest.mark.parametrize("run", [lambda d: neardup.near_duplicates(d), lambda d: lm.score(d), lambda d: fingerprint.compare_with_next(d), lambda d: packing.pack(d, public_tokenizers.path("byte_bpe_50k.json"))])
def test_empty_table(spark, run):
    assert run(spark.createDataFrame([], COLUMNS)).collect() == []


def test_empty_table_quality(spark):
    assert quality.classify(spark.createDataFrame([], COLUMNS), spark.createDataFrame([], "doc_id long, quality int")).collect() == []
