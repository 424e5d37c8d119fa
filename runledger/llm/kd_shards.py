"""K-d tree sharding by weight, in DataFrame functions only.

A row's metadata are the size of its text and its bytes per code point (which tells scripts apart), both functions of the text, so equal texts
share a shard and no row has to meet another one to find its place. A node stands for a number of shards. It is cut along its widest dimension at the
weighted quantile that splits its shards in two (the nearer side of the text that crosses it), until it stands for one shard or holds one text. Texts that outweigh
an even shard of what is left get shards of their own first. With `target_bytes` there are as many shards as that fills. Null text counts as empty (size
1); a null id is placed like any other; an empty table gives an empty result; fewer different texts than shards leave shards empty; ties in a dimension are cut by the text's
hash; very long texts weigh what they weigh; repeated rows are kept, each with its own slot, in the shard of their text, however many they are; other
columns, whatever their names, are ignored.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from runledger.llm.shared import id_and_text, materialize

BITS, STEP, FINE = 60, 12, 20
DIMENSIONS = ("d0", "d1")


def small(spark: SparkSession, **columns: list[int]) -> DataFrame:
    """A table of whole numbers, one row a node, made from a literal."""
    rows = [dict(zip(columns, values)) for values in zip(*columns.values())]
    schema = f"array<struct<{','.join(f'{c}:bigint' for c in columns)}>>"
    return spark.range(1).select(F.inline(F.from_json(F.lit(json.dumps(rows)), schema)))


def weighted_cuts(keyed: DataFrame, share: dict[int, float]) -> dict[int, int]:
    """Per node the key at or below which about its share of the weight lies; a histogram of 4096 bins a node and round reaches the driver."""
    spark = keyed.sparkSession
    low: dict[int, int] = {}
    weight: dict[int, int] = {}
    before = dict.fromkeys(share, 0)
    for shift in range(BITS - STEP, -1, -STEP):
        binned = keyed.withColumn("bin", F.shiftright("key", shift))
        if low:
            at = small(spark, node=list(low), above=list(low.values()))
            binned = binned.join(F.broadcast(at), "node").filter(F.shiftright("bin", STEP) == F.col("above"))
        bins: dict[int, list] = {}
        for r in binned.groupBy("node", "bin").agg(F.sum("size").alias("w")).collect():
            bins.setdefault(r["node"], []).append((r["bin"], r["w"]))
        for node, pairs in bins.items():
            whole = weight.setdefault(node, sum(w for _, w in pairs))
            for value, w in sorted(pairs):
                low[node] = value
                if whole * share[node] <= before[node] + w:
                    last = w
                    break
                before[node] += w
            if not shift:
                under, over = whole * share[node] - before[node], before[node] + last - whole * share[node]
                if before[node] and (under < over or before[node] + last == whole):
                    low[node] -= 1
    return low


def heavy_texts(rows: DataFrame, total: int, shards: int, most: int = 4096) -> list:
    """The texts that weigh at least an even shard of what is left without the heavier ones; at most `most` rows reach the driver."""
    first = rows.groupBy("h", "text_crc32").agg(F.sum("size").alias("w")).orderBy(F.desc("w"), "h").limit(min(shards - 1, most)).collect() if shards > 1 else []
    for n, r in enumerate(first):
        if r["w"] * (shards - n) < total:
            return first[:n]
        total -= r["w"]
    return first


def shard_by_bytes(docs: DataFrame, shards: int = 8, target_bytes: int | None = None, rows_per_slot_block: int = 100_000) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot, grown_shard."""
    spark, text = docs.sparkSession, F.coalesce("text", F.lit(""))
    wide, fine = F.octet_length(text).cast("double"), F.lit((1 << FINE) - 1)
    rows = id_and_text(docs).select(
        "doc_id", (F.octet_length(text) + 1).cast("long").alias("size"), F.crc32(text.cast("binary")).alias("text_crc32"), F.xxhash64(text).alias("h"),
        F.floor(F.least(F.log2(wide + 1) / 40, F.lit(1.0)) * fine).cast("long").alias("d0"),
        F.floor(F.least((wide + 1) / (F.length(text) + 1) - 1, F.lit(3.0)) / 3 * fine).cast("long").alias("d1"),
    )
    rows = materialize(rows, "sizes")
    total = rows.agg(F.sum("size")).first()[0] or 0
    if target_bytes:
        shards = max(1, -(-total // target_bytes))
    heavy = heavy_texts(rows, total, shards)
    own = small(spark, h=[r["h"] for r in heavy], text_crc32=[r["text_crc32"] for r in heavy], node=[-1 - i for i in range(len(heavy))])
    cut_rows = rows.join(F.broadcast(own), ["h", "text_crc32"], "left").withColumn("node", F.coalesce("node", F.lit(1).cast("long")))
    #: Node: (its first shard, how many it stands for).
    stands = {1: (0, shards - len(heavy))} | {-1 - i: (shards - 1 - i, 1) for i in range(len(heavy))}
    while True:
        spread = [(F.max(d) - F.min(d)).alias(d) for d in DIMENSIONS]
        nodes = cut_rows.filter("node > 0").groupBy("node").agg(F.min("h").alias("h0"), F.max("h").alias("h1"), *spread).collect()
        open_ = {r["node"]: int(r["d1"] > r["d0"]) for r in nodes if stands[r["node"]][1] > 1 and r["h0"] != r["h1"]}
        if not open_:
            break
        dims = small(spark, node=list(open_), dimension=list(open_.values()))
        d = F.when(F.col("dimension") == 1, F.col("d1")).otherwise(F.col("d0"))
        key = F.shiftleft(d, BITS - FINE).bitwiseOR(F.col("h").bitwiseAND(F.lit((1 << (BITS - FINE)) - 1)))
        keyed = cut_rows.join(F.broadcast(dims), "node").select("node", key.alias("key"), "size")
        found = weighted_cuts(keyed, {n: (stands[n][1] // 2) / stands[n][1] for n in open_})
        cuts = small(spark, node=list(open_), dimension=list(open_.values()), cut=[found[n] for n in open_])
        for n in open_:
            first, k = stands[n]
            stands |= {2 * n: (first, k // 2), 2 * n + 1: (first + k // 2, k - k // 2)}
        node = F.when(F.col("cut").isNull(), F.col("node")).otherwise(F.col("node") * 2 + (key > F.col("cut")).cast("long"))
        cut_rows = cut_rows.join(F.broadcast(cuts), "node", "left").withColumn("node", node).drop("dimension", "cut")
    leaves = small(spark, node=list(stands), shard=[first for first, _ in stands.values()]).withColumn("shard", F.col("shard").cast("int"))
    n = max(1, rows.count() // rows_per_slot_block)
    placed = materialize(cut_rows.join(F.broadcast(leaves), "node").withColumn("part", F.pmod(F.xxhash64("doc_id", "text_crc32"), F.lit(n))), "placed")
    order = Window.partitionBy("shard").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    first = placed.groupBy("shard", "part").agg(F.count("*").alias("n")).select("shard", "part", F.coalesce(F.sum("n").over(order), F.lit(0)).alias("first"))
    slot = F.row_number().over(Window.partitionBy("shard", "part").orderBy("doc_id", "text_crc32")) - 1
    return placed.join(first, ["shard", "part"]).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", (F.col("first") + slot).cast("long").alias("slot"), F.lit(None).cast("int").alias("grown_shard")
    )
