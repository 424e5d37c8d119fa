"""Near-duplicate components: SetSketch registers, banded candidates, joint likelihood, confirmation on full shingle sets.

A document's set holds its distinct `width`-word shingles (fewer words: the whole sequence as one). Registers are minima of exponentially
spaced values, truncated to a byte; unions take the greater register. Sets equal as wholes are one node. Links come in stages: in each
star stage a node meets one leader; then every bucket that still spans several components is searched for links across components,
in blocks of bounded size that return joining links alone. Links are confirmed on full sets, so a wrong candidate never links. A linked pair is missed
by all 25 bands with chance (1 - s**5)**25 at most, 4.3e-7 at s = 0.85.
Null or empty texts have no set and are components of their own; very long texts are one slice of their own, their sets whole; a similarity equal
to the bound links; repeated rows and equal ids give a row each; a row without an id joins a row with an id and an equal set alone, and is
always kept; words and shingles are compared as 64-bit hashes (of long words xxHash64), so unlike ones coincide by chance alone,
about 2**-63 a pair; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from runledger.llm.bytescan import U64, mix, slices, text_column, word_hashes
from runledger.llm.shared import id_and_text, materialize

BANDS, PER_BAND = 25, 5
M = BANDS * PER_BAND
SPACING, SCALE = 1.1, 20.0
SEEDS = np.random.default_rng(977).integers(1, 1 << 63, (2, M), dtype=U64) | U64(1)
GROUP = 200
BLOCK = 400
#: About so many rows with their sets are searched by one call, and so many pairs of them at once.
TOGETHER, PAIRS = 1000, 1 << 14


def shingle_sets(column, width: int):
    """(first row, rows, set border of each row, distinct shingles sorted within each row) by slices."""
    for first, end, data, offsets in slices(column):
        h, row = word_hashes(data, offsets)
        n = end - first
        words = np.bincount(row, minlength=n)
        starts = np.concatenate([[0], np.cumsum(words)[:-1]])
        size = np.where(words == 0, 0, np.minimum(words, width))
        at = np.flatnonzero(np.arange(len(h)) - starts[row] <= (words - size)[row])
        s, own, length = np.zeros(len(at), U64), row[at], size[row[at]]
        for k in range(width):
            has = k < length
            s[has] = mix(s[has] * U64(0x9E3779B97F4A7C15) + h[at[has] + k])
        s = mix(s + length.astype(U64))
        order = np.lexsort((s, own))
        s, own = s[order], own[order]
        new = np.ones(len(s), bool)
        new[1:] = (s[1:] != s[:-1]) | (own[1:] != own[:-1])
        s, own = s[new], own[new]
        yield first, n, np.concatenate([[0], np.cumsum(np.bincount(own, minlength=n))]).astype(np.int64), s


def registers(s: np.ndarray, borders: np.ndarray) -> np.ndarray:
    """One byte a register for each non-empty set."""
    at = borders[:-1][np.diff(borders) > 0]
    out = np.empty((len(at), M), np.uint8)
    for i in range(M):
        least = np.minimum.reduceat(mix_light(s, i), at) if len(at) else np.zeros(0, U64)
        x = -np.log1p(-(least.astype(float) + 1) / 2.0**64 * (1 - 1e-16))
        out[:, i] = np.clip(np.floor(1 - np.log(np.maximum(x / SCALE, 1e-300)) / np.log(SPACING)), 0, 255)
    return out


def mix_light(s: np.ndarray, i: int) -> np.ndarray:
    h = (s ^ SEEDS[0, i]) * SEEDS[1, i]
    return (h ^ (h >> U64(29))) * U64(0xC4CEB9FE1A85EC53)


def set_hashes(s: np.ndarray, borders: np.ndarray) -> np.ndarray:
    """One hash for each non-empty set."""
    size = np.diff(borders)
    at = borders[:-1][size > 0]
    return mix(np.add.reduceat(mix(s ^ U64(0x1234567)), at) + size[size > 0].astype(U64)).view(np.int64) if len(at) else np.zeros(0, np.int64)


def sketch(docs: DataFrame, width: int) -> DataFrame:
    """doc_id, n_shingles, node (hash of the set; null without one), regs."""

    def run(batches):
        for batch in batches:
            for first, n, borders, s in shingle_sets(text_column(batch), width):
                size = np.diff(borders)
                some = size > 0
                node, regs = np.zeros(n, np.int64), np.full(n, None, object)
                if some.any():
                    node[some] = set_hashes(s, borders)
                    regs[some] = [r.tobytes() for r in registers(s, borders)]
                yield pa.RecordBatch.from_pydict({
                    "doc_id": batch.column("doc_id").slice(first, n), "n_shingles": size, "node": pa.array(node, mask=~some), "regs": pa.array(list(regs), pa.binary())
                })

    return id_and_text(docs).mapInArrow(run, "doc_id long, n_shingles long, node long, regs binary")


def band_keys(regs: np.ndarray) -> np.ndarray:
    r = regs.reshape(-1, BANDS, PER_BAND)
    key = np.tile(np.arange(1, BANDS + 1, dtype=U64), (len(r), 1))
    for k in range(PER_BAND):
        key = mix(key * U64(0x9E3779B97F4A7C15) + r[:, :, k].astype(U64))
    return key.view(np.int64)


def buckets(nodes: DataFrame) -> DataFrame:
    """node, bucket: one row a band."""

    def run(batches):
        for batch in batches:
            key = band_keys(np.frombuffer(b"".join(batch.column("regs").to_pylist()), np.uint8).reshape(-1, M))
            node = np.repeat(batch.column("node").to_numpy(), BANDS)
            yield pa.RecordBatch.from_pydict({"node": node, "bucket": key.ravel()})

    found = materialize(nodes.select("node", "regs").mapInArrow(run, "node long, bucket long"), "buckets")
    shared = found.groupBy("bucket").agg(F.count("*").alias("members")).filter("members > 1")
    return materialize(found.join(shared, "bucket"), "shared-buckets")


def likely(a: np.ndarray, b: np.ndarray, na: np.ndarray, nb: np.ndarray, least: float) -> np.ndarray:
    """Where the likelihood's maximum over the similarity is no more than five standard errors below `least`."""
    above, below = (a > b).sum(-1), (a < b).sum(-1)
    u = (na / (na + nb))[:, None]
    j = np.minimum(np.linspace(0, 1, 41)[None, :], np.minimum(u, 1 - u) / np.maximum(u, 1 - u))
    p = [-np.log1p(-np.maximum(x, 0) * (SPACING - 1) / SPACING) / np.log(SPACING) for x in (u - (1 - u) * j, 1 - u - u * j)]
    log = above[:, None] * np.log(p[0] + 1e-9) + below[:, None] * np.log(p[1] + 1e-9) + (M - above - below)[:, None] * np.log(np.maximum(1 - p[0] - p[1], 1e-9))
    best = np.take_along_axis(j, log.argmax(1)[:, None], 1)[:, 0]
    fits = np.minimum(na, nb) >= least * np.maximum(na, nb) * (1 - 1e-9)
    return fits & (best >= least - 5 * np.sqrt(least * (1 - least) / M))


def estimated(pairs: DataFrame, nodes: DataFrame, least: float) -> DataFrame:
    """Distinct pairs a, b that the registers do not rule out."""
    a, b = (nodes.select(F.col("node").alias(x), F.col("regs").alias(f"r{x}"), F.col("n_shingles").alias(f"n{x}")) for x in "ab")

    def run(batches):
        for batch in batches:
            ra, rb = (np.frombuffer(b"".join(batch.column(c).to_pylist()), np.uint8).reshape(-1, M) for c in ("ra", "rb"))
            ok = likely(ra, rb, batch.column("na").to_numpy(), batch.column("nb").to_numpy(), least)
            yield pa.RecordBatch.from_pydict({c: batch.column(c) for c in "ab"}).filter(pa.array(ok))

    return pairs.select("a", "b").distinct().join(a, "a").join(b, "b").mapInArrow(run, "a long, b long")


def full_sets(wanted: DataFrame, nodes: DataFrame, docs: DataFrame, width: int) -> DataFrame:
    """node, set: the sorted shingle hashes of each wanted node."""
    ids = wanted.distinct().join(nodes.select("node", "doc_id"), "node")

    def run(batches):
        for batch in batches:
            for first, n, borders, s in shingle_sets(text_column(batch), width):
                sets = pa.array([x.tobytes() for x in np.split(s, borders[1:-1])], pa.binary())
                want, own = batch.column("node").slice(first, n), np.zeros(n, np.int64)
                own[np.diff(borders) > 0] = set_hashes(s, borders)
                yield pa.RecordBatch.from_arrays([want, sets], ["node", "set"]).filter(pa.array(own == want.to_numpy()))

    rows = id_and_text(docs).join(ids, "doc_id").select("node", "text").mapInArrow(run, "node long, set binary")
    return materialize(rows.dropDuplicates(["node"]), "sets")


def confirm(pairs: DataFrame, nodes: DataFrame, docs: DataFrame, width: int, percent: int) -> DataFrame:
    """Pairs whose full sets reach the similarity. A leader's set goes once to each group of at most about GROUP partners."""
    pairs = materialize(pairs, "candidates")
    sizes = pairs.groupBy("b").agg(F.ceil(F.count("*") / GROUP).alias("chunks"))
    placed = pairs.join(sizes, "b").withColumn("chunk", F.pmod(F.xxhash64("a"), F.col("chunks"))).drop("chunks")
    seats = placed.select(F.col("a").alias("node"), "b", "chunk").union(placed.select(F.col("b").alias("node"), "b", "chunk").distinct())
    rows = full_sets(seats.select("node"), nodes, docs, width)

    def compare(pdf: pd.DataFrame) -> pd.DataFrame:
        b, own = pdf["b"].iloc[0], {node: np.frombuffer(s, U64) for node, s in zip(pdf["node"], pdf["set"])}
        leader, out = own[b], []
        for a, s in own.items():
            if a != b:
                common = len(np.intersect1d(leader, s, assume_unique=True))
                if 100 * common >= percent * (len(leader) + len(s) - common):
                    out.append((a, b))
        return pd.DataFrame(out, columns=["a", "b"])

    return seats.join(rows, "node").groupBy("b", "chunk").applyInPandas(compare, "a long, b long")


def components(links: DataFrame) -> DataFrame:
    """node, root by alternating large-star and small-star until nothing changes; each round is a written table."""
    edges = materialize(links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter("a <> b").distinct(), "edges")
    before = None
    while True:
        both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.join(least, "a").filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(low, "a")
        small = small.select(F.col("b").alias("a"), F.col("m").alias("b")).filter("a <> b").union(low.select("a", F.col("m").alias("b"))).distinct()
        edges = materialize(small, "edges")
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == before:
            return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
        before = now


def pairs_within(bucket: np.ndarray):
    """Chunks of index pairs of one bucket; rows are sorted by bucket."""
    held_a, held_b, size = [], [], 0
    at = np.arange(len(bucket))
    for step in range(1, len(bucket)):
        at = at[at + step < len(bucket)]
        at = at[bucket[at] == bucket[at + step]]
        if not len(at):
            break
        held_a.append(at)
        held_b.append(at + step)
        size += len(at)
        if size >= PAIRS:
            yield np.concatenate(held_a), np.concatenate(held_b)
            held_a, held_b, size = [], [], 0
    if held_a:
        yield np.concatenate(held_a), np.concatenate(held_b)


def pairs_between(left: np.ndarray, right: np.ndarray):
    """Chunks of index pairs with one row of each side."""
    step = max(1, PAIRS // max(1, len(right)))
    for i in range(0, len(left), step):
        own = left[i : i + step]
        yield np.repeat(own, len(right)), np.tile(right, len(own))


def across(where: DataFrame, nodes: DataFrame, docs: DataFrame, width: int, percent: int) -> DataFrame:
    """Links between different roots in one bucket; where: node, bucket, members, root. Buckets of up to BLOCK nodes are searched many to a
    call. In a larger one the nodes of its commonest root and the rest fill blocks of about BLOCK nodes of their own; a call sees two blocks,
    never two of the commonest root, so a bucket costs its size times the nodes outside that root, over BLOCK. Nodes bring their full sets;
    each likely pair is checked in the first bucket that both share, and only links that join what the call has not joined yet are returned."""
    least = percent / 100
    sets = full_sets(where.select("node"), nodes, docs, width)
    shares = where.filter(F.col("members") > BLOCK).groupBy("bucket", "root").agg(F.count("*").alias("n"))
    commonest = shares.groupBy("bucket").agg(F.max(F.struct("n", "root")).alias("top"))
    own = where.join(nodes.select("node", "regs", "n_shingles"), "node").join(commonest, "bucket", "left")
    own = own.withColumn("alike", F.ceil(F.col("top.n") / BLOCK)).withColumn("blocks", F.col("alike") + F.ceil((F.col("members") - F.col("top.n")) / BLOCK))
    inside, by_hash = F.col("root") == F.col("top.root"), F.xxhash64("node", F.lit(5))
    block = F.when(inside, F.pmod(by_hash, "alike")).otherwise(F.col("alike") + F.pmod(by_hash, F.col("blocks") - F.col("alike")))
    meets = F.sequence(F.when(inside, F.col("alike")).otherwise(F.lit(0).cast("long")), F.col("blocks") - 1)
    small = F.col("top").isNull()
    own = own.withColumn("own", F.when(small, F.lit(0).cast("long")).otherwise(block))
    own = own.withColumn("other", F.explode(F.when(small, F.array(F.lit(0).cast("long"))).otherwise(meets)))
    calls = F.lit(max(1, where.count() // TOGETHER))
    call = F.when(small, F.pmod(F.xxhash64("bucket", F.lit(9)), calls)).otherwise(F.col("bucket"))
    seated = own.select(call.alias("call"), "bucket", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("k"), "own", "node", "root", "n_shingles", "regs").join(sets, "node")

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["bucket", "node"], kind="stable")
        bucket, node, root, size, side = (pdf[c].to_numpy().copy() for c in ("bucket", "node", "root", "n_shingles", "own"))
        regs = np.frombuffer(b"".join(pdf["regs"]), np.uint8).reshape(-1, M)
        full = [np.frombuffer(s, U64) for s in pdf["set"]]
        keys = band_keys(regs)
        earlier = np.arange(BANDS)[None, :] < (keys == bucket[:, None]).argmax(1)[:, None]
        i, k = pdf["i"].iloc[0], pdf["k"].iloc[0]
        out = []
        for x, y in pairs_within(bucket) if i == k else pairs_between(np.flatnonzero(side == i), np.flatnonzero(side == k)):
            open_ = root[x] != root[y]
            x, y = x[open_], y[open_]
            first = ~((keys[x] == keys[y]) & earlier[x]).any(1)
            x, y = x[first], y[first]
            if not len(x):
                continue
            good = likely(regs[x], regs[y], size[x], size[y], least)
            for a, b in zip(x[good].tolist(), y[good].tolist()):
                if root[a] != root[b]:
                    common = len(np.intersect1d(full[a], full[b], assume_unique=True))
                    if 100 * common >= percent * (len(full[a]) + len(full[b]) - common):
                        out.append((node[a], node[b]))
                        root[root == root[b]] = root[a]
        return pd.DataFrame(out, columns=["a", "b"]).astype("int64")

    return seated.groupBy("call", "i", "k").applyInPandas(run, "a long, b long")


def near_duplicates(docs: DataFrame, width: int = 5, percent: int = 80, stars: int = 2) -> DataFrame:
    """doc_id, n_shingles, component_id, kept: links where 100 * intersection >= percent * union, component named by its least doc_id."""
    least = percent / 100
    sets = materialize(sketch(docs, width), "sketches")
    nodes = sets.filter("node IS NOT NULL AND doc_id IS NOT NULL").groupBy("node").agg(F.min("doc_id").alias("doc_id"), F.max("n_shingles").alias("n_shingles"), F.max("regs").alias("regs"))
    nodes = materialize(nodes, "nodes")
    shared = buckets(nodes)
    members = shared.select("node").distinct()
    roots, links = members.withColumn("root", F.col("node")), None
    for step in range(stars + 1):
        where = shared.join(roots, "node")
        split = where.groupBy("bucket").agg(F.min("root").alias("r0"), F.max("root").alias("r1")).filter("r0 <> r1").select("bucket")
        where = materialize(where.join(split, "bucket"), "open-buckets")
        if where.isEmpty():
            break
        if step < stars:
            rank = F.struct(F.xxhash64("node", F.lit(step)).alias("h"), F.col("node").alias("b"), F.col("root").alias("rb"))
            leaders = where.groupBy("bucket").agg(F.min(rank).alias("lead"))
            met = where.join(leaders, "bucket").filter("root <> lead.rb").groupBy(F.col("node").alias("a")).agg(F.min("lead").alias("lead"))
            found = confirm(estimated(met.select("a", F.col("lead.b").alias("b")), nodes, least), nodes, docs, width, percent)
        else:
            found = across(where, nodes, docs, width, percent)
        found = materialize(found, "links")
        links = found if links is None else links.union(found)
        joined = components(links)
        roots = materialize(members.join(joined, "node", "left").select("node", F.coalesce("root", "node").alias("root")), "roots")
    named = nodes.select("node", "doc_id").join(roots, "node", "left").select("node", F.coalesce("root", "node").alias("root"), "doc_id")
    least_id = named.groupBy("root").agg(F.min("doc_id").alias("component_id"))
    named = named.join(least_id, "root").select("node", "component_id")
    out = sets.select("doc_id", "n_shingles", "node").join(named, "node", "left").withColumn("component_id", F.coalesce("component_id", "doc_id"))
    return out.select("doc_id", "n_shingles", "component_id", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)).alias("kept"))


def drop_copies(docs: DataFrame, width: int = 5, percent: int = 80) -> DataFrame:
    """One row of each component, that of least doc_id (null last; of equal ids any one); all columns as they came. Rows are numbered once in a
    written table and decided by number, so repeated rows and rows that share an id are told apart."""
    rows = materialize(docs.withColumn("_row", F.monotonically_increasing_id()), "rows")
    found = materialize(near_duplicates(rows.select(F.col("_row").alias("doc_id"), "text"), width, percent).select(F.col("doc_id").alias("_row"), "component_id"), "components")
    named = found.join(rows.select("_row", F.col("doc_id").cast("long").alias("doc_id")), "_row")
    lead = named.groupBy("component_id").agg(F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "_row")).alias("lead")).select(F.col("lead._row").alias("_row"))
    return rows.join(found.select("_row").join(lead, "_row", "left_anti"), "_row", "left_anti").select(*docs.columns)
