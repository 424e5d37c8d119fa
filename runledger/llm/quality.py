"""Quality by importance resampling: log ratio of two hashed n-gram models (target: labelled good; raw: all documents), then Gumbel top-k.

Tokens: runs of letters and digits, and runs of other signs; a token equal to its predecessor of the same kind becomes one "again" token.
Unigrams and bigrams fall into 2**16 buckets. Raw counts cover all texts; the target model is fitted on half of at most `labelled` labelled
rows (those of least hash), the threshold on the other half. k is the number of documents above the threshold, so sampling moves only those
near it. Null or empty text has no tokens and is rejected; very long texts are one slice of their own, weighed whole; without labels of both kinds
everything with tokens is kept; rows that tie with the k-th key are all kept; repeated rows are treated alike unless their ids differ; an empty
table gives no rows; other columns pass through untouched.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from runledger.llm.bytescan import LOWER, SPACE, U64, mix, rows_of, slices, span_hashes, spans, text_column
from runledger.llm.shared import materialize

BITS = 16
_CODES = np.arange(256)
WORD = ((_CODES >= 48) & (_CODES <= 57)) | ((_CODES >= 97) & (_CODES <= 122)) | (_CODES >= 128)
SIGN = ~WORD & ~SPACE
AGAIN = U64(0x5851F42D4C957F2D)


def grams(column):
    """(first row, rows, row of each n-gram, its bucket) by slices."""
    for first, end, data, offsets in slices(column):
        data = LOWER[data]
        starts, codes = [], []
        for kind in (WORD, SIGN):
            a, b = spans(kind[data], offsets)
            h, row = span_hashes(data, a, b), rows_of(a, offsets)
            if len(h) > 1:
                again = (h[1:] == h[:-1]) & (row[1:] == row[:-1]) if kind is WORD else np.zeros(len(h) - 1, bool)
                h[1:][again] = AGAIN
            starts.append(a)
            codes.append(h)
        start, code = np.concatenate(starts), np.concatenate(codes)
        order = np.argsort(start, kind="stable")
        code, row = code[order], rows_of(start[order], offsets)
        same = row[1:] == row[:-1]
        two = mix(code[:-1] * U64(3) + code[1:])[same]
        yield first, end - first, np.concatenate([row, row[:-1][same]]), (np.concatenate([mix(code), two]) >> U64(64 - BITS)).astype(np.int64)


def _labels(labels: DataFrame, most: int) -> DataFrame:
    one = labels.filter("doc_id IS NOT NULL AND quality IS NOT NULL").groupBy(F.col("doc_id").cast("long").alias("id")).agg(F.min("quality").alias("quality"))
    return one.select("*", F.xxhash64("id").alias("h")).orderBy("h", "id").limit(most)


def _log_ratio(marked: DataFrame) -> np.ndarray:
    def count(batches):
        total = np.zeros((2, 1 << BITS), np.int64)
        for batch in batches:
            target = np.asarray(batch.column("target").to_pylist(), bool)
            for first, n, row, bucket in grams(text_column(batch)):
                total[0] += np.bincount(bucket, minlength=1 << BITS)
                total[1] += np.bincount(bucket[target[first : first + n][row]], minlength=1 << BITS)
        at = np.flatnonzero(total[0])
        yield pa.RecordBatch.from_pydict({"bucket": at, "raw": total[0][at], "target": total[1][at]})

    both = np.zeros((2, 1 << BITS))
    for r in marked.mapInArrow(count, "bucket long, raw long, target long").groupBy("bucket").agg(F.sum("raw").alias("raw"), F.sum("target").alias("target")).collect():
        both[:, r["bucket"]] = r["raw"], r["target"]
    if not both[1].any():
        return np.zeros(1 << BITS)
    p = (both + 1) / (both + 1).sum(1, keepdims=True)
    return np.log(p[1] / p[0])


def _weights(ratio, batch):
    column = text_column(batch)
    total, n_grams = np.zeros(len(column)), np.zeros(len(column), np.int64)
    for first, n, row, bucket in grams(column):
        total[first : first + n] = np.bincount(row, ratio[bucket], minlength=n)
        n_grams[first : first + n] = np.bincount(row, minlength=n)
    return total, n_grams


def _gumbel(ids) -> np.ndarray:
    u = (mix(ids.astype(U64) * U64(0x9E3779B97F4A7C15) + U64(77)) >> U64(11)).astype(float) / 2.0**53
    return -np.log(-np.log(np.clip(u, 1e-16, 1 - 1e-16)))


def _keys(ratio, threshold, batch):
    total, n = _weights(ratio, batch)
    ids = batch.column("doc_id").cast(pa.int64()).fill_null(0).to_numpy(zero_copy_only=False)
    return total, n, np.where(n > 0, total - threshold * n + _gumbel(ids), -np.inf)


def kth_largest(values: DataFrame, column: str, k: int) -> float:
    """Exact k-th largest value by rounds of 1024-bin histograms; the driver sees one histogram a round."""
    low, high = values.agg(F.min(column), F.max(column)).first()
    for _ in range(7):
        if k < 1 or low is None or low >= high:
            break
        width = (high - low) / 1024
        binned = values.filter(F.col(column).between(low, high)).groupBy(F.least(F.floor((F.col(column) - low) / width), F.lit(1023)).alias("bin"))
        for r in sorted(binned.agg(F.count("*").alias("n"), F.min(column).alias("a"), F.max(column).alias("b")).collect(), key=lambda r: -r["bin"]):
            if k <= r["n"]:
                low, high = r["a"], r["b"]
                break
            k -= r["n"]
    return low if low is not None else 0.0


def fit(docs: DataFrame, labels: DataFrame, labelled: int = 20_000):
    """(log ratios, threshold, cutoff of the keys, scored table)."""
    chosen = F.broadcast(_labels(labels, labelled))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).join(chosen, F.col("doc_id") == F.col("id"), "left")
    fold = F.pmod("h", F.lit(2))
    ratio = _log_ratio(rows.select("text", F.coalesce((F.col("quality") == 1) & (fold == 0), F.lit(False)).alias("target")))

    def score(batches):
        for batch in batches:
            total, n = _weights(ratio, batch)
            yield pa.RecordBatch.from_pydict({"doc_id": batch.column("doc_id"), "log_weight": total, "n_grams": n, "quality": batch.column("quality")})

    test = rows.filter(F.col("quality").isNotNull() & (fold == 1)).select("doc_id", "text", F.col("quality").cast("int").alias("quality"))
    seen = [(r["log_weight"] / r["n_grams"], r["quality"]) for r in test.mapInArrow(score, "doc_id long, log_weight double, n_grams long, quality int").collect() if r["n_grams"]]
    good, bad = (np.sort([x for x, q in seen if (q == 1) == want]) for want in (True, False))
    threshold = -1e9
    if len(good) and len(bad):
        at = np.unique(np.concatenate([good, bad]))
        at = (at[1:] + at[:-1]) / 2 if len(at) > 1 else at
        gain = 2 * (1 - np.searchsorted(good, at) / len(good)) + np.searchsorted(bad, at) / len(bad)
        threshold = float(at[gain.argmax()])

    def keyed(batches):
        for batch in batches:
            total, n, key = _keys(ratio, threshold, batch)
            yield pa.RecordBatch.from_pydict({"doc_id": batch.column("doc_id"), "n_grams": n, "log_weight": total, "key": key})

    scored = materialize(rows.select("doc_id", "text").mapInArrow(keyed, "doc_id long, n_grams long, log_weight double, key double"), "quality")
    k = scored.filter((F.col("n_grams") > 0) & (F.col("log_weight") >= threshold * F.col("n_grams"))).count()
    cutoff = kth_largest(scored.filter("n_grams > 0"), "key", k) if k else float("inf")
    return ratio, threshold, cutoff, scored


def classify(docs: DataFrame, labels: DataFrame) -> DataFrame:
    _, _, cutoff, scored = fit(docs, labels)
    return scored.withColumn("kept", (F.col("key") >= cutoff) & (F.col("n_grams") > 0))


def keep_good(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents that are kept, all columns as they came; rows are scored in place, never joined."""
    ratio, threshold, cutoff, _ = fit(docs, labels)

    def run(batches):
        for batch in batches:
            yield batch.filter(pa.array(_keys(ratio, threshold, batch)[2] >= cutoff))

    return docs.mapInArrow(run, docs.schema)
