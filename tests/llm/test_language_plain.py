"""op10's query columns against a plain nearest-centroid model: dictionaries of trigrams, idf, spherical k-means and cosines."""

import math
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
from pyspark.sql import SparkSession

from runledger.llm.language import DIM, letters, predict


def trigrams(text) -> Counter:
    b = text.encode()
    return Counter((((b[i] << 16 | b[i + 1] << 8 | b[i + 2]) * 0x9E3779B1) % 2**32) >> 20 for i in range(len(b) - 2))


def rows():
    pick = random.Random(3)
    stems = {"aa": "the house road story and of is was", "bb": "der das und ist weg haus nicht ein", "cc": "日本 東京 言葉 道路 家族"}
    out = [(i, " ".join(pick.choices(words.split(), k=pick.randint(3, 40))) + f" {i}", lang) for i, (lang, words) in enumerate(list(stems.items()) * 30)]
    odd = [None, "", " \n", "12 345 !?", "a", "The HOUSE", "the house " * 3000]
    return out + [(1000 + i, t, "aa" if i % 2 else None) for i, t in enumerate(odd)] + out[:3] + [(None, "das haus", "bb")]


def test_equals_plain_centroids():
    spark = SparkSession.builder.master("local[4]").config("spark.sql.shuffle.partitions", "4").config("spark.ui.enabled", "false").getOrCreate()
    data = rows()
    docs = spark.createDataFrame([(d, t, lang, 0.5, False) for d, t, lang in data], "doc_id long, text string, lang string, score double, held_out boolean").repartition(3)
    clean = {r[0]: r[1] for r in docs.select("text", letters(docs["text"])).distinct().collect()}
    held = lambda d: d is not None and zlib.crc32(str(d).encode()) % 3 == 1
    lettered = lambda t: bool(t) and any(c.isalpha() for c in t)
    train = [(d, t, lang) for d, t, lang in data if d is not None and not held(d) and lettered(t) and lang]
    df = Counter(b for _, t, _ in train for b in trigrams(clean[t]))
    idf = np.array([math.log((1 + len(train)) / (1 + df[b])) + 1 for b in range(DIM)])

    def vector(text):
        v = np.zeros(DIM)
        for b, n in trigrams(clean[text]).items():
            v[b] = n * idf[b]
        return v / max(math.sqrt(float(v @ v)), 1e-12)

    by_lang = defaultdict(list)
    for _, t, lang in sorted(set(train)):
        by_lang[lang].append(vector(t).astype(np.float16).tobytes())
    model = []
    for lang in sorted(by_lang):
        x = [np.frombuffer(b, np.float16).astype(float) for b in sorted(by_lang[lang])]
        c = [x[int(i)] for i in np.linspace(0, len(x) - 1, 3)]
        for _ in range(8):
            own = [max(range(3), key=lambda j: float(v @ c[j])) for v in x]
            sums = [sum((v for v, o in zip(x, own) if o == j), np.zeros(DIM)) if j in own else c[j] for j in range(3)]
            c = [s / max(math.sqrt(float(s @ s)), 1e-12) for s in sums]
        model += [(lang, v) for v in c]
    want = []
    for d, t, _ in data:
        best = max(((float(vector(t) @ c), lang) for lang, c in model), key=lambda p: p[0]) if lettered(t) else (0.0, "und")
        want.append((d, held(d), best[1], best[0]))
    order = lambda rows: sorted(rows, key=lambda r: (r[0] is None, r[0] or 0))
    got = order((r["doc_id"], r["held_out"], r["lang_pred"], r["score"]) for r in predict(docs).collect())
    want = order(want)
    sure = [w[3] > 0 or w[2] == "und" for w in want]
    assert [g[:2] for g in got] == [w[:2] for w in want]
    assert [g[2] for g, s in zip(got, sure) if s] == [w[2] for w, s in zip(want, sure) if s]
    assert np.allclose([g[3] for g in got], [w[3] for w in want], atol=1e-6)
