"""Context-triggered piecewise hashing: a rolling hash cuts chunks, each chunk gives one sign, signatures compare by edit distance.

A text has signatures at its block size and at twice that; fingerprints compare where block sizes agree. Documents are sorted by falling doc_id in
ranges that a task reads as a stream, each row against the one after it; the last row of each range meets the first of the next by a join.
Equal ids follow the hashes of their texts, and equal rows their input partitions, so that one id may fill many ranges. Null text counts as empty;
a null id comes last; a lone document is its own next; very long texts stay whole within a range; ties of likeness do not arise,
as each document meets one other; other columns are ignored; repeated rows give a row each; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from runledger.llm.bytescan import _BYTE_CODE, U64, mix, span_hashes
from runledger.llm.shared import blocks_for, id_and_text, materialize

SIGNS = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/"
WINDOW, LONGEST, LEAST_BLOCK = 7, 64, 3
SCHEMA = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"
#: Rows of a range's stream: results (no range), or the range's first and last row with their texts.
STREAM = f"{SCHEMA}, range int, first boolean, text string"
KINDS = (pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64(), pa.int32(), pa.bool_(), pa.string())
NAMES = [part.split()[0] for part in STREAM.split(", ")]


def fingerprint(text: str) -> str:
    data = np.frombuffer(text.encode(), np.uint8)
    rolling = np.zeros(len(data), U64)
    code = _BYTE_CODE[data]
    for k in range(min(WINDOW, len(data))):
        rolling[k:] += code[: len(code) - k] * U64(0x9E3779B97F4A7C15 ** (k + 1) % (1 << 64))
    rolling = mix(rolling)
    size = LEAST_BLOCK
    while size * LONGEST < len(data):
        size *= 2

    def signature(size: int, longest: int) -> str:
        cuts = np.flatnonzero(rolling % U64(size) == U64(size - 1)) + 1
        cuts = cuts[: longest - 1]
        borders = np.concatenate([[0], cuts, [len(data)]]) if not len(cuts) or cuts[-1] < len(data) else np.concatenate([[0], cuts])
        if not len(data):
            return ""
        return "".join(SIGNS[x] for x in (span_hashes(data, borders[:-1], borders[1:]) >> U64(58)).tolist())

    while True:
        first = signature(size, LONGEST)
        if len(first) >= LONGEST // 2 or size == LEAST_BLOCK:
            return f"{size}:{first}:{signature(2 * size, LONGEST // 2)}"
        size //= 2


def edit_distance(a: str, b: str) -> int:
    """Bit-parallel Levenshtein distance of two signatures."""
    if not a:
        return len(b)
    match: dict[str, int] = {}
    for i, x in enumerate(a):
        match[x] = match.get(x, 0) | 1 << i
    full, last = (1 << len(a)) - 1, 1 << len(a) - 1
    up, down, distance = full, 0, len(a)
    for y in b:
        m = match.get(y, 0)
        d = (((m & up) + up) ^ up) | m | down
        plus, minus = down | ~(d | up) & full, up & d
        distance += bool(plus & last) - bool(minus & last)
        plus = plus << 1 | 1
        up, down = (minus << 1 | ~(d | plus)) & full, plus & d & full
    return distance


def likeness(x: str, y: str) -> float:
    """0 to 1; signatures without a common size have none."""
    if x == y:
        return 1.0
    own, other = ({int(s) * k: sign for k, sign in ((1, a), (2, b))} for s, a, b in (x.split(":"), y.split(":")))
    shared = own.keys() & other.keys()
    return max((1 - edit_distance(own[k], other[k]) / max(len(own[k]), len(other[k]), 1) for k in shared if own[k] and other[k]), default=0.0)


def compared(doc, text: str, own: str, after: str, following: str) -> tuple:
    """The result of one document with fingerprint `own`, before a text `after` with fingerprint `following`."""
    n = len(text)
    changed = text[: n - n // 3] + after[: n // 3]
    new = fingerprint(changed)
    return doc, n, hashlib.sha256(changed.encode()).hexdigest(), own, new, likeness(own, new), likeness(own, following)


def record_batch(rows: list[tuple], width: int) -> pa.RecordBatch:
    columns = zip(*rows) if rows else [[]] * width
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, KINDS)], NAMES[:width])


def stream(batches):
    """Results of all rows but the last, and both ends, of one range in order."""
    kept = None
    for batch in batches:
        out = []
        for doc, text, range_ in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "text", "range"))):
            mark = fingerprint(text)
            if kept:
                out.append((*compared(*kept[:3], text, mark), None, None, None))
            else:
                out.append((doc, None, None, mark, None, None, None, range_, True, text))
            kept = doc, text, mark, range_
        yield record_batch(out, len(KINDS))
    if kept:
        doc, text, mark, range_ = kept
        yield record_batch([(doc, None, None, mark, None, None, None, range_, False, text)], len(KINDS))


def join_ends(batches):
    for batch in batches:
        rows = zip(*(batch.column(c).to_pylist() for c in ("doc_id", "text", "fingerprint", "after", "following")))
        yield record_batch([compared(*row) for row in rows], 7)


def compare_with_next(docs: DataFrame, range_bytes: int = 32 << 20, most_ranges: int = 50_000) -> DataFrame:
    """The digest columns of each document; ranges of about range_bytes of text, as many as the session has cores at least. Beyond most_ranges,
    which keeps the shuffle's blocks and the sample of its bounds in check, ranges grow instead: they are streams, and Spark's sort spills."""
    rows = id_and_text(docs).withColumn("text", F.coalesce("text", F.lit("")))
    ranges = max(docs.sparkSession.sparkContext.defaultParallelism, min(most_ranges, blocks_for(rows, "text", range_bytes)))
    keyed = rows.withColumn("place", F.coalesce("doc_id", F.lit(-(1 << 63)))).withColumn("tie", F.xxhash64("text")).withColumn("part", F.spark_partition_id())
    dealt = keyed.repartitionByRange(ranges, F.desc("place"), "tie", "part").sortWithinPartitions(F.desc("place"), "tie")
    streamed = materialize(dealt.select("doc_id", "text", F.spark_partition_id().alias("range")).mapInArrow(stream, STREAM), "fingerprints")

    # One number a range, without its texts, tells which range comes next; the last is followed by the first.
    firsts = streamed.filter("first").select(F.col("range").alias("next"), F.col("text").alias("after"), F.col("fingerprint").alias("following"))
    in_order = Window.orderBy("range")
    below = firsts.select(F.col("next").alias("range")).select("range", F.coalesce(F.lead("range").over(in_order), F.first("range").over(in_order)).alias("next"))
    lasts = streamed.filter("NOT first").select("doc_id", "text", "fingerprint", "range")
    ends = lasts.join(below, "range").join(firsts, "next").select("doc_id", "text", "fingerprint", "after", "following").mapInArrow(join_ends, SCHEMA)
    return streamed.filter("range IS NULL").select(*NAMES[:7]).unionByName(ends)
