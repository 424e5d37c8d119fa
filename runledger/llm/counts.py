"""What other blocks add to each block's counts of keys, by an exchange whose rows grow with the number of blocks.

Each block sends its distinct 63-bit keys once, sorted and delta-coded, to the parts that own their ranges; a part answers each sender in the
sender's own order. Up to `fan` parts a block sends to every part itself. Beyond that, ranges hold `fan` parts each: the blocks of a team first
merge their keys of one range, the merged keys go to the range's parts, and the answers are settled with the blocks' own messages. So a block
causes at most `fan` rows for the parts, and one row for each range (as many as blocks over half of `fan`), where sending to all parts would
take blocks x parts. A team has about as many blocks as there are ranges, so no task holds much more than a block's or a part's keys.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from runledger.llm.bytescan import U64
from runledger.llm.shared import materialize

MESSAGE = "part long, block long, k long, own binary, counts binary"
ANSWER = "part long, block long, k long, n long, own long, added binary"
#: Rows of an answer that carry a part's counted keys (in `n`) and distinct ones (in `own`) have this block.
SUMMARY = -1


def packed(values: np.ndarray) -> bytes:
    """Whole numbers by byte planes, compressed: planes of zeros cost next to nothing."""
    return zstandard.compress(np.ascontiguousarray(values.astype("<u8").view(np.uint8).reshape(-1, 8).T).tobytes(), 1)


def unpacked(data: bytes) -> np.ndarray:
    planes = np.frombuffer(zstandard.decompress(data), np.uint8).reshape(8, -1)
    return np.ascontiguousarray(planes.T).view("<u8").ravel()


def mark(keys: np.ndarray) -> int:
    return int(np.bitwise_xor.reduce(keys).view(np.int64))


def messages(block: int, k: int, keys: np.ndarray, counts: np.ndarray, first: int, last: int, of: int) -> pa.Table:
    """Sorted keys and their counts, cut into the parts `first` to `last` - 1 of `of` equal ranges; parts without keys get no row."""
    cuts = np.searchsorted(keys, np.array([(p << 63) // of for p in range(first + 1, last)], U64))
    pieces = [(p, x, c) for p, x, c in zip(range(first, last), np.split(keys, cuts), np.split(counts, cuts)) if len(x)]
    n = len(pieces)
    return pa.table({
        "part": pa.array([p for p, _, _ in pieces], pa.int64()), "block": pa.array([block] * n, pa.int64()), "k": pa.array([k] * n, pa.int64()),
        "own": pa.array([packed(np.diff(x, prepend=U64(0))) for _, x, _ in pieces], pa.binary()), "counts": pa.array([packed(c) for _, _, c in pieces], pa.binary()),
    })


def received(table: pa.Table) -> Iterator[tuple[int, list[int], list[np.ndarray], np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """By k: its senders, their keys, all counts one after another, the distinct keys, each count's place among them, and their totals."""
    kinds, block = table.column("k").to_pylist(), table.column("block").to_pylist()
    own, counts = table.column("own").to_pylist(), table.column("counts").to_pylist()
    for kind in sorted(set(kinds)):
        at = [i for i, x in enumerate(kinds) if x == kind]
        keys = [np.cumsum(unpacked(own[i]), dtype=U64) for i in at]
        count = np.concatenate([unpacked(counts[i]).astype(np.int64) for i in at])
        different, back = np.unique(np.concatenate(keys), return_inverse=True)
        yield kind, [block[i] for i in at], keys, count, different, back, np.bincount(back, count, len(different)).astype(np.int64)


def answered(part: int, kind: int, senders: list[int], keys: list[np.ndarray], added: np.ndarray) -> pa.Table:
    ends = np.cumsum([0, *map(len, keys)])
    return pa.table({
        "part": [part] * len(keys), "block": senders, "k": [kind] * len(keys), "n": [len(x) for x in keys], "own": [mark(x) for x in keys],
        "added": pa.array([packed(added[a:b]) for a, b in zip(ends[:-1], ends[1:])], pa.binary()),
    })


def elsewhere(sent: DataFrame, parts: int, fan: int, apart: int) -> tuple[DataFrame, int, int]:
    """(answers, all counts of k = 0, its distinct keys with a count). `sent`: messages over ranges(parts, fan) ranges; `apart`: a key left out of both figures."""
    whole = ranges(parts, fan)
    direct = whole == parts
    fine = 1 if direct else fan

    def answer(table: pa.Table) -> pa.Table:
        part, out = table.column("part")[0].as_py(), []
        for kind, senders, keys, count, different, back, total in received(table):
            if kind == 0:
                counted = different != U64(apart)
                out.append(pa.table({"part": [-1], "block": [SUMMARY], "k": [0], "n": [int(total[counted].sum())], "own": [int((total[counted] > 0).sum())], "added": [b""]}))
            out.append(answered(part, kind, senders, keys, total[back] - count))
        return pa.concat_tables(out)

    def merge(table: pa.Table) -> pa.Table:
        part, team = table.column("part")[0].as_py(), table.column("team")[0].as_py()
        return pa.concat_tables([messages(team, kind, different, total, part * fine, (part + 1) * fine, whole * fine) for kind, _, _, _, different, _, total in received(table)])

    def settle(table: pa.Table, others: pa.Table) -> pa.Table:
        part, out, others = table.column("part")[0].as_py(), [], others.sort_by([("k", "ascending"), ("fine", "ascending")])
        for kind, senders, keys, count, _, back, total in received(table):
            from_others = np.concatenate([unpacked(x).astype(np.int64) for x in others.filter(pc.equal(others.column("k"), kind)).column("added").to_pylist()])
            out.append(answered(part, kind, senders, keys, (total + from_others)[back] - count))
        return pa.concat_tables(out)

    if not direct:
        sent = materialize(sent, "messages").withColumn("team", F.expr(f"pmod(xxhash64(block), {-(-parts // (2 * whole))})"))
    finest = sent if direct else sent.groupBy("team", "part").applyInArrow(merge, MESSAGE)
    answers = materialize(finest.groupBy("part").applyInArrow(answer, ANSWER), "answers")
    total, distinct = answers.filter(F.col("block") == SUMMARY).agg(F.coalesce(F.sum("n"), F.lit(0)), F.coalesce(F.sum("own"), F.lit(0))).first()
    answers = answers.filter(F.col("block") != SUMMARY)
    if not direct:
        back = answers.select(F.col("block").alias("team"), F.expr(f"part div {fine}").alias("part"), F.col("part").alias("fine"), "k", "added")
        answers = sent.groupBy("team", "part").cogroup(back.groupBy("team", "part")).applyInArrow(settle, ANSWER)
    return answers, total, distinct


def ranges(parts: int, fan: int) -> int:
    """How many ranges a block cuts its keys into: the parts themselves, or one for each `fan` of them."""
    return parts if parts <= fan else -(-parts // fan)
