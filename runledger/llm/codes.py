"""Vector codes of four bytes by dual-tree Lloyd, in whole numbers.

Components become floor(1024 x); a vector is cut into four equal consecutive parts and each part position has a codebook of at most 256 entries. Tasks
pack `BLOCK_ROWS` vectors to a block and build a tree over each position's parts once: boxes and sums of all nodes are stored with the block. In
each round a second tree over the entries descends beside it. A pair of nodes is pruned when the least distance of their boxes exceeds the largest distance to some
other box of entries; a node left with one entry takes it whole, with its cached sum; leaves left with several are settled by exact
integer distances to those. Only sums and counts of (position, entry) are shuffled; codebooks alone reach the driver (1,024 entries).

Vectors that are null or hold null or non-finite components are dropped, as are rows without an id; shorter vectors, and widths that four does not divide,
count as padded with zeros; rows that repeat an id are rows each (among the 256 smallest ids the smaller vector comes first); fewer than 256 rows give that many
entries; equal entries and other ties go to the lower index; a null label is a label; an empty table gives no rows; other columns, whatever their
names, are ignored. Components of 2**28 / 1024 or more in size raise an error: their squares would not fit.
"""

from __future__ import annotations

import functools
import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from runledger.llm.shared import materialize

PARTS, ENTRIES, ROUNDS, BLOCK_ROWS, LEAF = 4, 256, 4, 4096, 32
BLOCK_ARROW = pa.schema([("rows", pa.list_(pa.struct([("vec_id", pa.int64()), ("label", pa.int64())]))), ("trees", pa.list_(pa.binary()))])
BLOCK = "rows array<struct<vec_id:long,label:long>>, trees array<binary>"
SUMS = "part int, entry int, position int, total long, n long"
CODES = "vec_id long, label long, code string, error long"


def borders(n: int, level: int) -> np.ndarray:
    """Where the nodes of a level begin and end: each node is half of the one above."""
    return (n * np.arange((1 << level) + 1, dtype=np.int64)) >> level


def depth(n: int, leaf: int) -> int:
    level = 0
    while n > leaf << level:
        level += 1
    return level


class Tree:
    """Rows ordered so that the nodes of each level are ranges; box and sum of every node."""

    def __init__(self, rows: np.ndarray, leaf: int, order: np.ndarray | None = None, nodes: list | None = None):
        self.levels = depth(len(rows), leaf)
        if order is None:
            order = np.arange(len(rows))
            for level in range(self.levels):
                at = borders(len(rows), level)
                node = np.repeat(np.arange(1 << level), np.diff(at))
                own = rows[order]
                wide = (np.maximum.reduceat(own, at[:-1]) - np.minimum.reduceat(own, at[:-1])).argmax(1)
                order = order[np.lexsort((own[np.arange(len(own)), wide[node]], node))]
            rows = rows[order]
            nodes = []
            for level in range(self.levels + 1):
                at = borders(len(rows), level)[:-1]
                nodes.append((np.minimum.reduceat(rows, at), np.maximum.reduceat(rows, at), np.add.reduceat(rows, at)))
        self.rows, self.order, self.nodes = rows, order, nodes

    def blob(self) -> bytes:
        return self.order.astype(np.int64).tobytes() + self.rows.tobytes() + b"".join(x.tobytes() for level in self.nodes for x in level)

    @classmethod
    def read(cls, blob: bytes, n: int) -> Tree:
        flat = np.frombuffer(blob, np.int64)
        levels = depth(n, LEAF)
        wide = (len(flat) - n) // (n + 3 * ((2 << levels) - 1))
        rows, at, nodes = flat[n : n + n * wide].reshape(n, wide), n + n * wide, []
        for level in range(levels + 1):
            size = wide << level
            nodes.append(tuple(flat[at + i * size : at + (i + 1) * size].reshape(-1, wide) for i in range(3)))
            at += 3 * size
        return cls(rows, LEAF, flat[:n], nodes)


def entry_tree(book: np.ndarray) -> Tree:
    """A tree with one entry a leaf; copies of the first entry, numbered from the book's end on, fill it up to a power of two."""
    fill = (1 << depth(len(book), 1)) - len(book)
    return Tree(np.concatenate([book, np.repeat(book[:1], fill, axis=0)]), 1)


def box_distances(low, high, to_low, to_high) -> tuple[np.ndarray, np.ndarray]:
    """Least and largest squared distance between each box of one side and each box of the other."""
    least = np.maximum(np.maximum(to_low[None] - high[:, None], low[:, None] - to_high[None]), 0)
    most = np.maximum(to_high[None] - low[:, None], high[:, None] - to_low[None])
    return (least**2).sum(2), (most**2).sum(2)


def nearest_entry(rows: np.ndarray, entries: np.ndarray) -> np.ndarray:
    """Place of the nearest entry, ties to the first. Exact: products stay in doubles while they fit 53 bits, else in 64-bit integers."""
    peak = max(np.abs(rows).max(initial=0), np.abs(entries).max(initial=0))
    kind = np.float64 if 4 * rows.shape[1] * int(peak) ** 2 < 1 << 53 else np.int64
    a, b = rows.astype(kind), entries.astype(kind)
    return ((b**2).sum(1) - 2 * (a @ b.T)).argmin(1)


def assign(points: Tree, book: np.ndarray, entries: Tree) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
    """(entry of each row in the tree's order, sums and counts by entry, rows that whole nodes settled)."""
    n = len(points.rows)
    code, settled = np.full(n, -1), 0
    sums, counts = np.zeros_like(book), np.zeros(len(book), np.int64)
    level, below = 0, 0
    nodes, alive = np.zeros(1, np.int64), np.ones((1, 1), bool)
    while True:
        low, high, total = (x[nodes] for x in points.nodes[level])
        to_low, to_high, _ = entries.nodes[below]
        least, most = box_distances(low, high, to_low, to_high)
        bound = np.where(alive, most, np.iinfo(np.int64).max).min(1)
        alive &= least <= bound[:, None]
        at = borders(n, level)
        if below == entries.levels:
            alive &= entries.order < len(book)
            for i in np.flatnonzero(alive.sum(1) == 1):
                entry = entries.order[alive[i].argmax()]
                own = slice(at[nodes[i]], at[nodes[i] + 1])
                code[own] = entry
                sums[entry] += total[i]
                counts[entry] += own.stop - own.start
                settled += own.stop - own.start
            stay = alive.sum(1) > 1
            nodes, alive = nodes[stay], alive[stay]
            if level == points.levels:
                break
        if level < points.levels:
            level += 1
            nodes, alive = np.repeat(nodes * 2, 2), np.repeat(alive, 2, axis=0)
            nodes[1::2] += 1
        # Entries descend twice as fast: their tree is deeper for its size.
        for _ in range(2):
            if below < entries.levels:
                below += 1
                alive = np.repeat(alive, 2, axis=1)
        if not len(nodes):
            break
    at = borders(n, points.levels)
    for i, node in enumerate(nodes):
        own = slice(at[node], at[node + 1])
        left = np.sort(entries.order[alive[i]])
        entry = left[nearest_entry(points.rows[own], book[left])]
        code[own] = entry
        np.add.at(sums, entry, points.rows[own])
        np.add.at(counts, entry, 1)
    return code, sums, counts, settled


def pack(batches, width: int):
    """Blocks with a tree for each part position."""
    ids, labels, vectors = [], [], []

    def block(n: int):
        rows = np.zeros((n, width), np.int64)
        for i, v in enumerate(vectors[:n]):
            rows[i, : len(v)] = v
        trees = [Tree(np.ascontiguousarray(p), LEAF).blob() for p in np.split(rows, PARTS, axis=1)]
        own = [{"vec_id": i, "label": x} for i, x in zip(ids[:n], labels[:n])]
        for x in (ids, labels, vectors):
            del x[:n]
        return pa.RecordBatch.from_arrays([pa.array([own], BLOCK_ARROW[0].type), pa.array([trees], BLOCK_ARROW[1].type)], schema=BLOCK_ARROW)

    for batch in batches:
        ids += batch.column("vec_id").to_pylist()
        labels += batch.column("label").to_pylist()
        vectors += list(batch.column("c").to_numpy(zero_copy_only=False))
        while len(ids) >= BLOCK_ROWS:
            yield block(BLOCK_ROWS)
    if ids:
        yield block(len(ids))


def trees_of(batches):
    for batch in batches:
        for r in batch.to_pylist():
            yield r["rows"], [Tree.read(t, len(r["rows"])) for t in r["trees"]]


def totals(batches, books: list[np.ndarray]):
    """Sums and counts of a task's rows by (position, entry)."""
    entries = [entry_tree(b) for b in books]
    sums, counts = [np.zeros_like(b) for b in books], [np.zeros(len(b), np.int64) for b in books]
    for _, trees in trees_of(batches):
        for p, tree in enumerate(trees):
            _, more, n, _ = assign(tree, books[p], entries[p])
            sums[p] += more
            counts[p] += n
    for p in range(len(books)):
        used = np.flatnonzero(counts[p])
        wide = books[p].shape[1]
        yield pa.RecordBatch.from_arrays([
            pa.array(np.full(len(used) * wide, p, np.int32)), pa.array(np.repeat(used, wide).astype(np.int32)), pa.array(np.tile(np.arange(wide), len(used)).astype(np.int32)),
            pa.array(sums[p][used].ravel()), pa.array(np.repeat(counts[p][used], wide))], names=["part", "entry", "position", "total", "n"])


def codes_of(batches, books: list[np.ndarray]):
    entries = [entry_tree(b) for b in books]
    for rows, trees in trees_of(batches):
        code, error = np.zeros((len(rows), PARTS), np.int64), np.zeros(len(rows), np.int64)
        for p, tree in enumerate(trees):
            own = assign(tree, books[p], entries[p])[0]
            code[tree.order, p] = own
            error[tree.order] += ((tree.rows - books[p][own]) ** 2).sum(1)
        text = ["".join(f"{x:02x}" for x in c) for c in code.tolist()]
        yield pa.RecordBatch.from_arrays([pa.array([r["vec_id"] for r in rows], pa.int64()), pa.array([r["label"] for r in rows], pa.int64()), pa.array(text), pa.array(error)], names=["vec_id", "label", "code", "error"])


def with_label_error(coded: DataFrame, few: int = 50_000, salts: int = 32) -> DataFrame:
    """The error of all rows of an equal label; one row a label is broadcast while there are few, else dealt with salt, so that a hot label is many groups."""
    sums = coded.groupBy("label").agg(F.sum("error").alias("label_error"))
    same = coded["label"].eqNullSafe(F.col("of"))
    sums = sums.withColumnRenamed("label", "of")
    if sums.limit(few + 1).count() <= few:
        return coded.join(F.broadcast(sums), same, "left").drop("of")
    salted = coded.withColumn("salt", F.pmod(F.xxhash64("vec_id"), F.lit(salts)))
    every = sums.withColumn("deal", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    return salted.join(every, salted["label"].eqNullSafe(every["of"]) & (salted["salt"] == every["deal"]), "left").drop("of", "salt", "deal")


def encode(vectors: DataFrame) -> DataFrame:
    """vectors: vec_id, v, label. Columns out: vec_id, code, error, label_error, codebooks_sha256."""
    spark, v = vectors.sparkSession, F.col("v").cast("array<double>")
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), v.alias("v"), F.col("label").cast("long").alias("label")).filter("vec_id IS NOT NULL AND v IS NOT NULL")
    rows = rows.filter(~F.exists("v", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))))
    whole = rows.select("vec_id", "label", F.transform("v", lambda x: F.floor(x * 1024).cast("long")).alias("c"))
    n, widest, peak = whole.agg(F.count("*"), F.max(F.size("c")), F.max(F.array_max(F.transform("c", F.abs)))).first()
    if not n:
        return spark.createDataFrame([], "vec_id long, code string, error long, label_error long, codebooks_sha256 string")
    if (peak or 0) >= 1 << 28:
        raise ValueError(f"a component of {peak} / 1024 is too large for exact squares")
    width = max(PARTS, -(-widest // PARTS) * PARTS)
    start = whole.orderBy("vec_id", "c").limit(ENTRIES).collect()
    first = np.zeros((len(start), width), np.int64)
    for i, r in enumerate(start):
        first[i, : len(r["c"])] = r["c"]
    books = [np.ascontiguousarray(p) for p in np.split(first, PARTS, axis=1)]
    blocks = materialize(whole.mapInArrow(functools.partial(pack, width=width), BLOCK), "blocks")
    for _ in range(ROUNDS):
        met = blocks.mapInArrow(functools.partial(totals, books=books), SUMS).groupBy("part", "entry", "position").agg(F.sum("total").alias("total"), F.sum("n").alias("n"))
        books = [b.copy() for b in books]
        for r in met.collect():
            books[r["part"]][r["entry"], r["position"]] = r["total"] // r["n"]
    text = ",".join(str(x) for b in books for x in b.ravel().tolist())
    coded = materialize(blocks.mapInArrow(functools.partial(codes_of, books=books), CODES), "codes")
    return with_label_error(coded).select("vec_id", "code", "error", "label_error", F.lit(hashlib.sha256(text.encode()).hexdigest()).alias("codebooks_sha256"))
