"""Exact top-k inner products in three phases with one uniform threshold.

Each vector is cut into `segments` lists of partial scores. Phase 1 gathers every list's best entries, resolves them exactly and keeps the k-th
best of each query as a safe cutoff. Phase 2 collects the sufficient entries, those whose partial score is at least cutoff / segments: any result
has one in some list. A list is not scored for rows that the norms of its segment keep below that. Phase 3 resolves the missing partial scores of
just the collected pairs, and drops a pair as soon as the norms of its missing segments cannot lift it to the cutoff.

Queries come in blocks of `block` rows, so what is broadcast is bounded; each block's result is a written table, so the plan does not grow;
candidates are never shuffled. Vectors that are null or hold null or non-finite components take no part; shorter vectors count as padded with
zeros; rows with the query's id are its own; rows that repeat a candidate's id are candidates each; ties go to the smaller vec_id; an empty
table gives no rows; other columns, whatever their names, are ignored. Scores must fit a long and 53 bits.
"""

from __future__ import annotations

import functools

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from runledger.llm.shared import materialize

CHUNK = 1024
SCHEMA = "query_id long, vec_id long, score long"


def _matrix(vectors, width: int) -> np.ndarray:
    out = np.zeros((len(vectors), max(width, max(map(len, vectors), default=0))))
    for i, v in enumerate(vectors):
        out[i, : len(v)] = v
    return out[:, :width]


class Lists:
    """The lists of partial scores of one block of queries; `resolved` counts the partial scores computed pair by pair."""

    def __init__(self, ids: np.ndarray, q: np.ndarray, k: int, segments: int):
        self.ids, self.k = ids, k
        self.parts = [q[:, s] for s in np.array_split(np.arange(q.shape[1]), max(1, min(segments, q.shape[1])))]
        self.norms = [np.linalg.norm(p, axis=1) for p in self.parts]
        self.resolved = 0

    def cut(self, c: np.ndarray) -> list[np.ndarray]:
        ends = np.cumsum([0, *(p.shape[1] for p in self.parts)])
        return [c[:, a:b] for a, b in zip(ends[:-1], ends[1:])]

    def resolve(self, a, b, known: dict, c: list[np.ndarray], cutoff) -> tuple:
        """Whole scores of the pairs (a, b); known: list -> its partial scores. Pairs that cannot reach the cutoff are dropped on the way."""
        total = np.zeros(len(a))
        for own in known.values():
            total += own
        missing = [s for s in range(len(self.parts)) if s not in known]
        norms = {s: np.linalg.norm(c[s], axis=1) for s in missing} if cutoff is not None else {}
        for i, s in enumerate(missing):
            if cutoff is not None:
                most = total + sum(self.norms[m][a] * norms[m][b] for m in missing[i:])
                stay = most >= cutoff[a] - 0.5
                a, b, total = a[stay], b[stay], total[stay]
            total = total + np.einsum("ij,ij->i", self.parts[s][a], c[s][b])
            self.resolved += len(a)
        return a, b, total

    def first(self, own: np.ndarray, c: list[np.ndarray]):
        """Phase 1: each list's best entries, resolved."""
        found = []
        m = min(len(own), self.k + 1)
        for s, p in enumerate(self.parts):
            partial = p @ c[s].T
            b = np.argpartition(-partial, m - 1, axis=1)[:, :m]
            a = np.repeat(np.arange(len(self.ids)), m)
            found.append(self.resolve(a, b.ravel(), {s: np.take_along_axis(partial, b, 1).ravel()}, c, None))
        return [np.concatenate(x) for x in zip(*found)]

    def sufficient(self, own: np.ndarray, c: list[np.ndarray], cutoff: np.ndarray):
        """Phases 2 and 3: the sufficient entries of each list, resolved where they can reach the cutoff. A pair is taken in the first list that
        holds it."""
        found, least = [], cutoff / len(self.parts)
        before = []
        for s, p in enumerate(self.parts):
            reach = np.linalg.norm(c[s], axis=1) * self.norms[s].max(initial=0) >= np.min(least, initial=np.inf) - 0.5
            rows = np.flatnonzero(reach)
            if not len(rows):
                before.append(None)
                continue
            partial = p @ c[s][rows].T
            enough = partial >= least[:, None]
            a, b = np.nonzero(enough)
            own_partial, b = partial[a, b], rows[b]
            new = np.ones(len(a), bool)
            for earlier in filter(lambda e: e is not None, before):
                new &= ~earlier[a, b]
            mark = np.zeros((len(self.ids), len(own)), bool)
            mark[a, b] = True
            before.append(mark)
            found.append(self.resolve(a[new], b[new], {s: own_partial[new]}, c, cutoff))
        if not found:
            return np.zeros(0, int), np.zeros(0, int), np.zeros(0)
        a, b, total = (np.concatenate(x) for x in zip(*found))
        stay = total >= cutoff[a]
        return a[stay], b[stay], total[stay]

    def best(self, own: np.ndarray, a, b, total) -> pd.DataFrame:
        """The k best of each query, each pair once."""
        other = self.ids[a] != own[b]
        a, b, s = a[other], b[other], np.rint(total[other]).astype(np.int64)
        order = np.lexsort((b, own[b], -s, a))
        a, b, s = a[order], b[order], s[order]
        once = np.ones(len(a), bool)
        once[1:] = (a[1:] != a[:-1]) | (b[1:] != b[:-1])
        a, b, s = a[once], b[once], s[once]
        place = np.arange(len(a)) - np.searchsorted(a, a)
        a, b, s = a[place < self.k], b[place < self.k], s[place < self.k]
        return pd.DataFrame({"query_id": self.ids[a], "vec_id": own[b], "score": s})

    def scan(self, batches, cutoff=None):
        width = sum(p.shape[1] for p in self.parts)
        for pdf in batches:
            for i in range(0, len(pdf), CHUNK):
                own = pdf["vec_id"].to_numpy()[i : i + CHUNK]
                c = self.cut(_matrix(list(pdf["v"][i : i + CHUNK]), width))
                yield self.best(own, *(self.first(own, c) if cutoff is None else self.sufficient(own, c, cutoff)))


def top_k(vectors: DataFrame, is_query, k: int = 5, segments: int = 2, block: int = 8192) -> DataFrame:
    """vectors: vec_id, v (array of doubles with whole values). Columns out: query_id, rank, vec_id, score."""
    vectors = vectors.select("vec_id", "v", F.coalesce(is_query, F.lit(False)).alias("asks"))
    queries = vectors.filter("asks").select("vec_id", "v")
    n = max(1, -(-queries.count() // block))
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")

    def ranked(found: DataFrame) -> DataFrame:
        return found.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k)

    done = []
    for i in range(n):
        rows = queries.filter(F.pmod(F.xxhash64("vec_id"), F.lit(n)) == i).groupBy("vec_id").agg(F.max("v").alias("v")).collect()
        if not rows:
            continue
        lists = Lists(np.array([r["vec_id"] for r in rows]), _matrix([r["v"] for r in rows], max(1, *(len(r["v"]) for r in rows))), k, segments)
        own = vectors.select("vec_id", "v")
        first = ranked(own.mapInPandas(lists.scan, SCHEMA)).groupBy("query_id").agg(F.count("*").alias("n"), F.min("score").alias("s")).filter(F.col("n") == k)
        at = {r["query_id"]: float(r["s"]) for r in first.collect()}
        # Fewer than k candidates in all: every entry is sufficient.
        cutoff = np.array([at.get(x, -np.inf) for x in lists.ids.tolist()])
        found = ranked(own.mapInPandas(functools.partial(lists.scan, cutoff=cutoff), SCHEMA))
        done.append(materialize(found, "top") if n > 1 else found)
    if not done:
        return vectors.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    return functools.reduce(DataFrame.union, done).select("query_id", "rank", "vec_id", "score")
