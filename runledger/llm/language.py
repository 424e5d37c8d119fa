"""Nearest-centroid language identification on hashed TF-IDF byte trigrams of letters, several centroids a language.

Document frequencies cover all training texts; centroids are fitted by spherical k-means on at most `sample` training texts, shared
out evenly over the languages, LEAST a language at least (different rows of least hash, two bytes a dimension); all other texts are only scored.

A text that is null, empty or without a letter is `und` with score 0; `rejected` marks these and texts whose best cosine is below the floor of their
language and length class, learned from all training texts' cosines (`least` is the lowest floor). Very long texts are one slice of their own,
scored whole; of equal cosines the language first in order wins; other columns are ignored; repeated rows give repeated results; an empty table
gives no rows; with no training text every row is `und`; a row without an id is predicted, not learned from, and not `held_out`.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from runledger.llm.bytescan import slices, text_column
from runledger.llm.shared import crc_mod

DIM = 4096
#: Texts of a slice: their matrix stays under 32 MB, however short they are.
ROWS = 1024


def counts(texts, most: int = 1 << 19):
    """(first row, row count, matrix of trigram counts) by slices; a trigram never crosses two texts."""
    column = text_column(pa.table({"text": pa.array(texts, pa.string())}))
    for first, end, data, offsets in slices(column, most, ROWS):
        d = data.astype(np.uint32)
        n = end - first
        if len(d) < 3:
            yield first, n, np.zeros((n, DIM))
            continue
        h = ((d[:-2] << 16 | d[1:-1] << 8 | d[2:]) * np.uint32(0x9E3779B1)) >> np.uint32(20)
        row = np.repeat(np.arange(n), np.diff(offsets))
        same = row[:-2] == row[2:]
        yield first, n, np.bincount(row[:-2][same] * DIM + h[same], minlength=n * DIM).reshape(n, DIM).astype(float)


def unit(x: np.ndarray) -> np.ndarray:
    return x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-12)


def centroids(x: np.ndarray, k: int, rounds: int = 8) -> np.ndarray:
    c = x[np.linspace(0, len(x) - 1, min(k, len(x))).astype(int)]
    for _ in range(rounds):
        own = (x @ c.T).argmax(1)
        c = unit(np.stack([x[own == i].sum(0) if (own == i).any() else c[i] for i in range(len(c))]))
    return c


CLEAN, ANY = "[^\\p{L}]+", "\\p{L}"


def letters(text):
    """The text's letters in lower case, all else as single spaces."""
    return F.regexp_replace(F.lower(text), CLEAN, " ")


LEAST = 40


def chosen(train: DataFrame, sample: int) -> DataFrame:
    """lang and text of as many rows of each language: its different rows (by doc_id and text) of least hash. A threshold by the language's
    number of different rows bounds what is sorted to about four times that."""
    rows = train.select("lang", "text", F.xxhash64("doc_id", "text").alias("h"))
    different = {r["lang"]: r["n"] for r in rows.groupBy("lang").agg(F.approx_count_distinct("h").alias("n")).collect()}
    each = max(LEAST, sample // max(1, len(different)))
    part = {lang: 4 * each / max(n, 1) for lang, n in different.items()}
    if few := {lang: p for lang, p in part.items() if p < 1}:
        shares = F.create_map(*(F.lit(x) for pair in few.items() for x in pair))
        rows = rows.filter(F.pmod("h", F.lit(1 << 30)) < F.coalesce(shares[F.col("lang")], F.lit(1.0)) * (1 << 30))
    by_hash = Window.partitionBy("lang").orderBy(F.pmod("h", F.lit(1 << 30)), "h")
    once = rows.groupBy("lang", "h").agg(F.min("text").alias("text"))
    return once.withColumn("place", F.row_number().over(by_hash)).filter(F.col("place") <= each).select("lang", letters(F.col("text")).alias("text"))


def fit(docs: DataFrame, sample: int = 2000, k: int = 3):
    """(names, centroids, idf) from the training documents."""
    train = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), F.col("lang").cast("string").alias("lang"))
    train = train.filter((crc_mod("doc_id", 3) != 1) & F.col("text").rlike(ANY) & F.col("lang").isNotNull())

    def frequencies(batches):
        total = np.zeros(DIM + 1)
        for pdf in batches:
            for _, n, x in counts(pdf["text"]):
                total[:DIM] += (x > 0).sum(0)
                total[DIM] += n
        yield pd.DataFrame({"bin": range(DIM + 1), "n": total.astype(np.int64)})

    df = np.zeros(DIM + 1)
    for r in train.select(letters(F.col("text")).alias("text")).mapInPandas(frequencies, "bin int, n long").groupBy("bin").agg(F.sum("n").alias("n")).collect():
        df[r["bin"]] = r["n"]
    idf = np.log((1 + df[DIM]) / (1 + df[:DIM])) + 1

    def fitted(batches):
        for pdf in batches:
            for first, n, x in counts(pdf["text"]):
                yield pd.DataFrame({"lang": pdf["lang"][first : first + n].to_numpy(), "x": [v.tobytes() for v in unit(x * idf).astype(np.float16)]})

    got = chosen(train, sample).select("text", "lang").mapInPandas(fitted, "lang string, x binary").toPandas()
    names, parts = [], []
    for lang, own in got.sort_values(["lang", "x"]).groupby("lang"):
        c = centroids(np.frombuffer(b"".join(own["x"]), np.float16).reshape(-1, DIM).astype(float), k)
        parts.append(c)
        names += [lang] * len(c)
    return np.array(names or ["und"], object), np.concatenate(parts) if parts else np.zeros((1, DIM)), idf


def nearest(model, texts):
    """(language, cosine) of each text."""
    names, c, idf = model
    best, score = np.empty(len(texts), object), np.zeros(len(texts))
    for first, n, x in counts(texts):
        cosine = unit(x * idf) @ c.T
        best[first : first + n], score[first : first + n] = names[cosine.argmax(1)], cosine.max(1)
    return best, np.clip(score, 0, 1)


#: Texts of up to so many characters are a class each, longer ones another; the floors over all languages do not fall with length.
CLASSES = np.array([20, 50, 100, 400])
BINS, RARE, FEW, SLACK = 1000, 0.001, 1000, 0.8


def classes(texts) -> np.ndarray:
    return np.searchsorted(CLASSES, [len(t.strip()) if t else 0 for t in texts])


def floors(docs: DataFrame, model, least: float) -> tuple[dict, np.ndarray]:
    """({(language, class): floor}, floors by class of languages with under FEW training texts in it): SLACK times the cosine that a share of
    RARE of the class's training texts stays under; texts of under 100 characters, where a class has few, keep `least`."""
    train = docs.filter((crc_mod("doc_id", 3) != 1) & F.col("text").rlike(ANY) & F.col("lang").isNotNull()).select(letters(F.col("text")).alias("text"))

    def binned(batches):
        for pdf in batches:
            best, score = nearest(model, pdf["text"])
            frame = pd.DataFrame({"lang": best, "size": classes(pdf["text"]), "bin": (score * BINS).astype(int)})
            yield frame.groupby(["lang", "size", "bin"]).size().rename("n").reset_index()

    got = train.mapInPandas(binned, "lang string, size long, bin long, n long").groupBy("lang", "size", "bin").agg(F.sum("n").alias("n")).collect()
    count: dict = {}
    for r in got:
        for lang in (r["lang"], None):
            count.setdefault((lang, r["size"]), np.zeros(BINS + 1))[r["bin"]] += r["n"]

    def low(n):
        return SLACK * np.searchsorted(np.cumsum(n), RARE * n.sum(), "right") / BINS

    pooled = np.full(len(CLASSES) + 1, least)
    for i in range(len(pooled)):
        n = count.get((None, i))
        if n is not None and (i > 2 or n.sum() >= FEW):
            pooled[i] = max(least, low(n))
        elif i > 2:
            pooled[i] = pooled[i - 1]
    pooled = np.minimum.accumulate(pooled[::-1])[::-1]
    return {(lang, i): max(least, low(n)) for (lang, i), n in count.items() if lang is not None and n.sum() >= FEW}, pooled


def below(best, score, texts, learned) -> np.ndarray:
    own, pooled = learned
    size = classes(texts)
    return score < np.array([own.get((lang, i), pooled[i]) for lang, i in zip(best, size.tolist())], float)


def predict(docs: DataFrame, sample: int = 2000, k: int = 3, least: float = 0.05) -> DataFrame:
    model = fit(docs, sample, k)
    learned = floors(docs, model, least)
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), letters(F.col("text")).alias("text"),
        F.coalesce(F.col("text").rlike(ANY), F.lit(False)).alias("lettered"), F.coalesce(crc_mod("doc_id", 3) == 1, F.lit(False)).alias("held_out"),
    )

    def run(batches):
        for pdf in batches:
            best, score = nearest(model, pdf["text"])
            ok = pdf["lettered"].to_numpy(bool)
            score = np.where(ok, score, 0)
            yield pd.DataFrame({"doc_id": pdf["doc_id"], "held_out": pdf["held_out"], "lang_pred": np.where(ok, best, "und"), "score": score, "rejected": ~ok | below(best, score, pdf["text"], learned)})

    return rows.mapInPandas(run, "doc_id long, held_out boolean, lang_pred string, score double, rejected boolean")


def keep_identified(docs: DataFrame, sample: int = 2000, k: int = 3, least: float = 0.05) -> DataFrame:
    """The documents that are not rejected, all columns as they came; rows are scored in place, never joined."""
    model = fit(docs, sample, k)
    learned = floors(docs, model, least)

    def run(batches):
        for batch in batches:
            texts = batch.column(batch.num_columns - 1).to_pandas()
            ok = np.array([bool(t and t.strip()) for t in texts], bool) & ~below(*nearest(model, texts), texts, learned)
            yield batch.select(list(range(batch.num_columns - 1))).filter(pa.array(ok))

    return docs.select("*", letters(F.col("text")).alias("_letters")).mapInArrow(run, docs.schema)
