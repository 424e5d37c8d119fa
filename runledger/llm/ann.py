"""Approximate nearest neighbours by largest inner product: lists around centroids, scanned adaptively over the dimensions.

Vectors get one more component, so that all are equally long; the largest inner product is then the smallest distance. A random rotation follows. Its
columns are stored in blocks. Within a probed list the distance grows block by block, and a candidate is abandoned as soon as the hypothesis that it is
within the query's cutoff is rejected: under a random rotation the share of a squared distance that lies in d of D columns has a Beta(d/2, (D-d)/2)
law, so a candidate goes when its partial distance exceeds the law's upper quantile (`significance`) times the squared cutoff. Survivors are scored
exactly on the original vectors. The cutoff is the k-th best score of the query's nearest list, scanned first.

The index is fitted on bounded samples: centroids on `FIT_ROWS` vectors, and the number of lists to probe on `PROBE_QUERIES` queries whose exact
neighbours among all rows are found by brute force (one scan): the least number that holds `recall` of them. Every row is indexed. Lists and their
queries are dealt to groups of about `GROUP_ROWS` vectors by `GROUP_QUERIES` queries, so a hot list is many groups; nothing grows in one task.

Vectors that are null, zero, or hold null or non-finite components, and rows without an id take no part; shorter vectors count as padded with zeros. Rows
with the query's id are its own; of rows that repeat a query's id the greatest vector asks; rows that repeat a candidate's id are candidates each; ties go
to the smaller vec_id; an empty table gives no rows; other columns, whatever their names, are ignored.
"""

from __future__ import annotations

import functools

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from runledger.llm.shared import materialize

FIT_ROWS, PROBE_QUERIES, MOST_LISTS = 8192, 256, 2048
GROUP_ROWS, GROUP_QUERIES, PACK_ROWS, DENSE = 8192, 1024, 32768, 0.1
CHUNK = "list int, part long, n int, ids binary, blocks binary, vectors binary"
CHUNK_ARROW = pa.schema([("list", pa.int32()), ("part", pa.int64()), ("n", pa.int32()), ("ids", pa.binary()), ("blocks", pa.binary()), ("vectors", pa.binary())])
FOUND = "query_id long, vec_id long, score double"
FOUND_ARROW = pa.schema([("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.float64())])


def beta_quantile(p: float, a: float, b: float) -> float:
    """The p-quantile of a Beta law, by its density added up on a fine grid."""
    x = (np.arange(200_000) + 0.5) / 200_000
    log = (a - 1) * np.log(x) + (b - 1) * np.log1p(-x)
    total = np.cumsum(np.exp(log - log.max()))
    return float(x[np.searchsorted(total, p * total[-1])])


def padded(vectors: pa.Array, width: int) -> np.ndarray:
    ends = vectors.offsets.to_numpy().astype(np.int64)
    flat = vectors.values.to_numpy(zero_copy_only=False)
    sizes = np.diff(ends)
    if len(sizes) and (sizes == width).all():
        return flat[ends[0] : ends[-1]].reshape(-1, width)
    out = np.zeros((len(sizes), width))
    for i, (a, b) in enumerate(zip(ends[:-1], ends[1:])):
        out[i, : b - a] = flat[a:b]
    return out


def clusters(rows: np.ndarray, n: int, rounds: int = 10) -> np.ndarray:
    """Lloyd's algorithm from evenly chosen rows; an empty cluster keeps its centroid."""
    centres = rows[np.linspace(0, len(rows) - 1, n).astype(int)].copy()
    for _ in range(rounds):
        own = nearest_lists(rows, centres, 1)[:, 0]
        sums, counts = np.zeros_like(centres), np.bincount(own, minlength=n)
        np.add.at(sums, own, rows)
        centres[counts > 0] = sums[counts > 0] / counts[counts > 0, None]
    return centres


def nearest_lists(rows: np.ndarray, centres: np.ndarray, n: int) -> np.ndarray:
    far = (centres**2).sum(1) - 2 * rows @ centres.T
    return np.argsort(far, axis=1, kind="stable")[:, :n]


class Index:
    """What tasks need: rotation, column blocks, quantiles, centroids. A few MB at most."""

    def __init__(self, width: int, longest: float, sample: np.ndarray, n: int, k: int, significance: float, columns: int):
        self.width, self.longest, self.k = width, longest, k
        pick = np.random.default_rng(20240611)
        turn, signs = np.linalg.qr(pick.standard_normal((width + 1, width + 1)))
        self.turn = turn * np.sign(np.diag(signs))
        ends = [*range(columns, width + 1, columns)]
        ends = [*(e for e in ends if width + 1 - e >= columns // 2), width + 1]
        self.blocks = list(zip([0, *ends[:-1]], ends))
        self.share = [beta_quantile(1 - significance, e / 2, (width + 1 - e) / 2) for e in ends[:-1]] + [1.0]
        self.centres = clusters(self.rotate(sample), n)

    def rotate(self, v: np.ndarray) -> np.ndarray:
        rest = np.sqrt(np.maximum(self.longest - (v**2).sum(1), 0))
        return np.concatenate([v, rest[:, None]], 1) @ self.turn

    def rotate_query(self, v: np.ndarray) -> np.ndarray:
        return np.concatenate([v, np.zeros((len(v), 1))], 1) @ self.turn

    def pack(self, batches):
        """Rows of chunks: the vectors of one list that a task has met, rotated, block after block of columns, beside the original ones."""
        held: list = []
        count, part = 0, 0

        def flush():
            nonlocal held, count, part
            ids, v = np.concatenate([h[0] for h in held]), np.concatenate([h[1] for h in held])
            turned = self.rotate(v)
            own = nearest_lists(turned, self.centres, 1)[:, 0]
            order = np.argsort(own, kind="stable")
            cuts = np.flatnonzero(np.diff(own[order], prepend=-1))
            for a, b in zip(cuts, [*cuts[1:], len(order)]):
                for at in range(a, b, GROUP_ROWS):
                    rows = order[at : min(b, at + GROUP_ROWS)]
                    blob = b"".join(np.ascontiguousarray(turned[rows, x:y]).tobytes() for x, y in self.blocks)
                    part += 1
                    yield pa.RecordBatch.from_arrays([pa.array([x], f.type) for x, f in zip((int(own[rows[0]]), part, len(rows), ids[rows].tobytes(), blob, v[rows].tobytes()), CHUNK_ARROW)], schema=CHUNK_ARROW)
            held, count = [], 0

        for batch in batches:
            if batch.num_rows:
                held.append((batch.column("vec_id").to_numpy(), padded(batch.column("v"), self.width)))
                count += batch.num_rows
                if count >= PACK_ROWS:
                    yield from flush()
        if held:
            yield from flush()

    def route(self, batches, probes: int):
        """The lists that each query probes, nearest first."""
        for batch in batches:
            if batch.num_rows:
                v = padded(batch.column("v"), self.width)
                lists = nearest_lists(self.rotate_query(v), self.centres, probes)
                yield pa.RecordBatch.from_arrays([batch.column("vec_id"), batch.column("v"), pa.array(lists.tolist(), pa.list_(pa.int32()))], names=["vec_id", "v", "lists"])

    def scan(self, ids, blocks, v, query_ids, q, cutoff):
        """The best k candidates of each query that the tests leave, as rows of (query, candidate, score)."""
        turned = self.rotate_query(q)
        # Rounding must not abandon a tie, here or below.
        reach = (self.longest + (q**2).sum(1) - 2 * cutoff) * (1 + 1e-9) + 1e-9 * self.longest
        a = b = partial = None
        for (x, y), block, share in zip(self.blocks, blocks, self.share):
            t = turned[:, x:y]
            if a is None:
                step = (t**2).sum(1)[:, None] + (block**2).sum(1) - 2 * t @ block.T
                partial = step if partial is None else partial + step
                alive = partial <= share * reach[:, None]
                if alive.mean() < DENSE:
                    a, b = np.nonzero(alive)
                    partial = partial[a, b]
            else:
                partial = partial + ((t[a] - block[b]) ** 2).sum(1)
                stay = partial <= share * reach[a]
                a, b, partial = a[stay], b[stay], partial[stay]
        if a is None:
            a, b = np.nonzero(alive)
        other = query_ids[a] != ids[b]
        a, b = a[other], b[other]
        score = np.concatenate([np.einsum("ij,ij->i", q[a[i : i + 65536]], v[b[i : i + 65536]]) for i in range(0, len(a), 65536)] or [np.zeros(0)])
        stay = score >= cutoff[a] - 1e-12 * np.abs(cutoff[a])
        return self.best(query_ids, ids, a[stay], b[stay], score[stay])

    def best(self, query_ids, ids, a, b, score):
        order = np.lexsort((ids[b], -score, a))
        a, b, score = a[order], b[order], score[order]
        stay = np.arange(len(a)) - np.searchsorted(a, a) < self.k
        return query_ids[a[stay]], ids[b[stay]], score[stay]

    def unpack(self, chunks: pa.Table):
        """Ids, column blocks and original vectors of the chunks of a group."""
        rows = chunks.to_pylist()
        ids = np.concatenate([np.frombuffer(r["ids"], np.int64) for r in rows])
        v = np.concatenate([np.frombuffer(r["vectors"]).reshape(-1, self.width) for r in rows])
        blocks = [[] for _ in self.blocks]
        for r in rows:
            flat = np.frombuffer(r["blocks"])
            for i, (x, y) in enumerate(self.blocks):
                blocks[i].append(flat[x * r["n"] : y * r["n"]].reshape(r["n"], y - x))
        return ids, [np.concatenate(b) for b in blocks], v

    def group(self, chunks: pa.Table, queries: pa.Table) -> pa.Table:
        if not chunks.num_rows or not queries.num_rows:
            return FOUND_ARROW.empty_table()
        queries = queries.combine_chunks()
        query_ids, q = queries["vec_id"].to_numpy(), padded(queries["v"].combine_chunks(), self.width)
        cutoff = queries["cutoff"].fill_null(-np.inf).to_numpy()
        return pa.Table.from_arrays([pa.array(x) for x in self.scan(*self.unpack(chunks), query_ids, q, cutoff)], schema=FOUND_ARROW)

    def exact(self, batches, query_ids, q):
        """Brute force over a task's chunks: each query's best k with the list that holds them."""
        score, vec, lists = (np.zeros((len(q), 0), t) for t in (float, np.int64, np.int32))
        for batch in batches:
            for r in batch.to_pylist():
                ids, v = np.frombuffer(r["ids"], np.int64), np.frombuffer(r["vectors"]).reshape(-1, self.width)
                new = np.where(query_ids[:, None] == ids, -np.inf, q @ v.T)
                score, vec, lists = np.hstack([score, new]), np.hstack([vec, np.broadcast_to(ids, new.shape)]), np.hstack([lists, np.full(new.shape, r["list"], np.int32)])
                top = np.argsort(-score, axis=1, kind="stable")[:, : self.k]
                score, vec, lists = (np.take_along_axis(x, top, 1) for x in (score, vec, lists))
        for i in range(len(q)):
            real = np.isfinite(score[i])
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in (np.full(real.sum(), query_ids[i]), vec[i][real], lists[i][real], score[i][real])], names=["query_id", "vec_id", "list", "score"])

    def probes_for(self, query_ids, q, found: list, recall: float) -> int:
        """The least number of lists that holds the wanted share of the found neighbours."""
        rank = np.argsort(nearest_lists(self.rotate_query(q), self.centres, len(self.centres)), axis=1)
        at = {x: i for i, x in enumerate(query_ids.tolist())}
        needed = np.sort([rank[at[r["query_id"]], r["list"]] for r in found]) + 1
        return int(needed[int(np.ceil(recall * len(needed))) - 1])


def top(rows: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return rows.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def search(vectors: DataFrame, is_query, k: int = 20, recall: float = 0.97, significance: float = 5e-4, columns: int = 16, lists: int | None = None) -> DataFrame:
    """vectors: vec_id, v. Columns out: query_id, rank, vec_id, score. lists: the number of lists, else about the root of the rows."""
    spark = vectors.sparkSession
    v = F.col("v").cast("array<double>")
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), v.alias("v"), F.coalesce(is_query, F.lit(False)).alias("asks")).filter("vec_id IS NOT NULL AND v IS NOT NULL")
    rows = rows.filter(~F.exists("v", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))).filter(F.exists("v", lambda x: x != 0))
    norm = F.aggregate("v", F.lit(0.0), lambda a, x: a + x * x)
    n, width, longest = rows.agg(F.count("*"), F.max(F.size("v")), F.max(norm)).first()
    if not n:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    sample = rows.orderBy(F.xxhash64("vec_id", "v"), "vec_id").limit(FIT_ROWS).select("v")
    sample = padded(sample.toArrow()["v"].combine_chunks(), width)
    index = Index(width, longest, sample, min(len(sample), lists or max(1, min(MOST_LISTS, round(n**0.5)))), k, significance, columns)
    chunks = materialize(rows.select("vec_id", "v").mapInArrow(index.pack, CHUNK), "lists")
    queries = rows.filter("asks").groupBy("vec_id").agg(F.max("v").alias("v"))
    some = queries.orderBy(F.xxhash64("vec_id"), "vec_id").limit(PROBE_QUERIES).toArrow()
    if not some.num_rows:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    some_ids, some_q = some["vec_id"].to_numpy(), padded(some["v"].combine_chunks(), width)
    held = top(chunks.select("list", "ids", "vectors").mapInArrow(functools.partial(index.exact, query_ids=some_ids, q=some_q), "query_id long, vec_id long, list int, score double"), k)
    found = held.select("query_id", "list").collect()
    probes = index.probes_for(some_ids, some_q, found, recall) if found else 1
    routed = queries.mapInArrow(functools.partial(index.route, probes=probes), "vec_id long, v array<double>, lists array<int>")
    routed = materialize(routed.select("vec_id", "v", F.posexplode("lists").alias("place", "list")), "probes")
    # How many parts a list's vectors and its queries are dealt to: one row a list.
    parts = chunks.groupBy("list").agg(F.sum("n").alias("n")).collect()
    of_vectors = {r["list"]: -(-r["n"] // GROUP_ROWS) for r in parts}

    def scan(asked: DataFrame) -> DataFrame:
        of_queries = {r["list"]: -(-r["n"] // GROUP_QUERIES) for r in asked.groupBy("list").agg(F.count("*").alias("n")).collect()}

        def parts_of(sizes):
            known = F.array(*[F.lit(sizes.get(i, 1)) for i in range(len(index.centres))])
            return F.element_at(known, F.col("list") + 1)

        every = lambda sizes: F.explode(F.sequence(F.lit(0), parts_of(sizes) - 1))
        left = chunks.withColumn("vp", F.pmod(F.xxhash64("ids"), parts_of(of_vectors)).cast("int")).withColumn("qp", every(of_queries))
        right = asked.withColumn("qp", F.pmod(F.xxhash64("vec_id"), parts_of(of_queries)).cast("int")).withColumn("vp", every(of_vectors))
        return left.groupBy("list", "vp", "qp").cogroup(right.groupBy("list", "vp", "qp")).applyInArrow(lambda a, b: index.group(a, b), FOUND)

    first = materialize(top(scan(routed.filter("place = 0").withColumn("cutoff", F.lit(None).cast("double"))), k), "nearest")
    if probes == 1:
        return first.select("query_id", "rank", "vec_id", "score")
    cutoffs = first.filter(F.col("rank") == k).select(F.col("query_id").alias("vec_id"), F.col("score").alias("cutoff"))
    rest = scan(routed.filter("place > 0").join(cutoffs, "vec_id", "left"))
    return top(first.select("query_id", "vec_id", "score").unionByName(rest), k).select("query_id", "rank", "vec_id", "score")
