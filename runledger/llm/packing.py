"""Packing pieces of documents into sequences: configuration linear program over the length histogram.

Multiplicative weights price the lengths by the share of their demand that is covered, an unbounded knapsack by dynamic programming finds the
best configuration through each length, and rounds go on until all are covered nearly evenly. The mixture is rounded by largest remainder; best
fit packs what is left, into its free tokens first; pieces as long as a sequence are placed as they are. The driver
sees one count a length (at most `capacity`) and returns a table of runs of equal sequences; pieces find their place by their rank among pieces
of their length.
Null text counts as empty (one closing id); very long texts are cut into pieces, none dropped; pieces of one length are exchangeable, so ties between
them may fall either way; an empty table gives no rows; other columns are ignored; repeated rows and rows without an id are packed each.
"""

from __future__ import annotations

import json
import logging
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from runledger.llm.shared import id_and_text, materialize

LOG = logging.getLogger(__name__)
PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"


def encoder(path: str):
    """Function from a text to its ids. A byte-level vocabulary numbered in the order of its merges is run by tiktoken, which gives the ids that
    the tokenizers library gives in less time; any other vocabulary, and texts that hold one of its added tokens, by the tokenizers library."""
    with open(path, encoding="utf-8") as file:
        spec = json.load(file)
    vocab, merges, split = spec["model"]["vocab"], spec["model"].get("merges", []), spec.get("pre_tokenizer") or {}
    pairs = [m.split(" ") if isinstance(m, str) else m for m in merges]
    tokenizer = Tokenizer.from_file(path)
    tokenizer.no_truncation()

    def exact(text: str) -> list[int]:
        return tokenizer.encode(text, add_special_tokens=False).ids

    plain = split.get("type") == "ByteLevel" and split.get("use_regex") and not split.get("add_prefix_space") and not spec.get("normalizer")
    if plain and all(vocab.get(a + b) == 256 + i for i, (a, b) in enumerate(pairs)):
        shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
        byte_of = {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(sorted(set(range(256)) - set(shown)))}
        ranks = {bytes(byte_of[c] for c in token): n for token, n in vocab.items() if n < 256 + len(pairs)}
        fast = tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}).encode_ordinary
        special = [t["content"] for t in spec.get("added_tokens") or []]
        return lambda text: exact(text) if any(t in text for t in special) else fast(text)
    return exact


def cut(docs: DataFrame, path: str, end: int = 2, capacity: int = 1024, batch_chars: int = 4 << 20) -> DataFrame:
    def run(batches):
        ids_of = encoder(path)

        def encode(docs, texts):
            out = []
            for doc, text in zip(docs, texts):
                ids = np.array([*ids_of(text), end], "<u4")
                at, piece, n = 0, 0, len(ids)
                while at < n:
                    size = min(capacity, n) if piece else (n - 1) % capacity + 1
                    out.append((doc, piece, at, size, zlib.crc32(ids[at : at + size].tobytes())))
                    at, piece = at + size, piece + 1
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()))], ["doc_id", "piece", "start", "length", "ids_crc32"])

        for batch in batches:
            docs, texts, size = [], [], 0
            for doc, text in zip(batch.column("doc_id"), batch.column("text")):
                docs.append(doc.as_py())
                texts.append(text.as_py() or "")
                size += len(texts[-1])
                if size >= batch_chars:
                    yield encode(docs, texts)
                    docs, texts, size = [], [], 0
            if docs:
                yield encode(docs, texts)

    return id_and_text(docs).mapInArrow(run, PIECES)


def knapsack(price: np.ndarray, lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, list[int]]:
    """By room: the value of the dearest multiset that fits (unbounded) and the index of one of its lengths, -1 where one token stays free."""
    value, choice = np.zeros(capacity + 1), [-1] * (capacity + 1)
    ends = np.searchsorted(lengths, np.arange(capacity + 1), "right")
    for room in range(1, capacity + 1):
        value[room] = value[room - 1]
        if n := ends[room]:
            got = value[room - lengths[:n]] + price[:n]
            i = int(got.argmax())
            if got[i] > value[room]:
                value[room], choice[room] = got[i], i
    return value, choice


def filling(i: int, choice: list[int], lengths: list[int], capacity: int) -> dict[int, int]:
    """Counts by index of the dearest configuration that holds length i."""
    out, room = {i: 1}, capacity - lengths[i]
    while room > 0:
        if (j := choice[room]) < 0:
            room -= 1
        else:
            out[j] = out.get(j, 0) + 1
            room -= lengths[j]
    return out


def weights(lengths: np.ndarray, counts: np.ndarray, capacity: int, gap: float = 0.1, margin: float = 1.5, near: float = 0.1, step: float = 0.25, most: int = 4096):
    """(sequences by configuration, coverage by length) of the program's fractional solution.

    A length starts at a price in proportion to its tokens and loses a factor e each time its demand is covered; one that is `margin` coverages
    ahead of the last is free. One knapsack a round gives the dearest configuration through every length; those within `near` of the best are
    raised together, no length by more than `step`. Rounds end when the least coverage is margin / gap: then all lie within about 1 + gap of it.
    """
    covered, found, plain = np.zeros(len(lengths)), {}, lengths.tolist()
    for _ in range(most):
        if covered.min() >= margin / gap:
            break
        ahead = covered - covered.min()
        price = np.where(ahead < margin, np.exp(-ahead), 0) * lengths
        value, choice = knapsack(price, lengths, capacity)
        reach, budget = price + value[capacity - lengths], np.full(len(lengths), step)
        for i in np.argsort(-reach, kind="stable").tolist():
            if reach[i] < (1 - near) * value[capacity]:
                break
            if price[i] == 0 or budget[i] <= 1e-9:
                continue
            config = filling(i, choice, plain, capacity)
            at, n = list(config), np.array(list(config.values()))
            copies = float((budget[at] * counts[at] / n).min())
            if copies > 1e-9:
                budget[at] -= n * copies / counts[at]
                covered[at] += n * copies / counts[at]
                key = tuple(sorted(config.items()))
                found[key] = found.get(key, 0) + copies
    else:
        LOG.warning("packing: rounds ran out, coverage %.3f to %.3f", covered.min(), covered.max())
    return found, covered


def mixture(lengths: np.ndarray, counts: np.ndarray, capacity: int) -> list[tuple[int, np.ndarray]]:
    """(copies, configuration): the fractional solution, scaled to cover no length too often, rounded down and then up by largest remainder while
    the pieces last."""
    found, covered = weights(lengths, counts, capacity)
    left, rounded = counts.copy(), []
    for key, x in found.items():
        at, n = (np.array(v) for v in zip(*key))
        whole = int(x / covered.max())
        left[at] -= whole * n
        rounded.append([x / covered.max() - whole, whole, at, n])
    rounded.sort(key=lambda r: -r[0])
    for r in rounded:
        if (left[r[2]] >= r[3]).all():
            r[1] += 1
            left[r[2]] -= r[3]
    out = []
    for _, copies, at, n in rounded:
        if copies:
            config = np.zeros(len(lengths), np.int32)
            config[at] = n
            out.append((copies, config))
    return out


def best_fit(lengths: np.ndarray, counts: np.ndarray, capacity: int, begun=()) -> list[tuple[int, np.ndarray]]:
    """Longest first, each into the fullest place that takes it, those begun first; equal fillings are made in bulk."""
    left, out = counts.copy(), []
    begun = sorted(begun, key=lambda p: capacity - p[1] @ lengths)[::-1]
    while begun or left.any():
        most, start = begun.pop() if begun else (int(left.sum()), np.zeros(len(lengths), np.int64))
        added, room = np.zeros(len(lengths), np.int64), capacity - start @ lengths
        for i in np.flatnonzero(left[: np.searchsorted(lengths, room, "right")])[::-1]:
            n = min(room // lengths[i], left[i])
            added[i], room = n, room - n * lengths[i]
            if room < lengths[0]:
                break
        used = added > 0
        copies = min(most, int((left[used] // added[used]).min())) if used.any() else most
        left -= copies * added
        out.append((copies, (start + added).astype(np.int32)))
        if start.any() and copies < most:
            begun.append((most - copies, start))
    return out


def plan(lengths: np.ndarray, counts: np.ndarray, capacity: int = 1024) -> list[tuple[int, np.ndarray]]:
    """The program's sequences, best fit for the rest. Pieces that fill a sequence are placed as they are. Of the
    program's configurations those with the fewest free tokens are taken, so that what is left to best fit keeps small pieces among it. The share is
    chosen by the number of sequences in the end, of equal ones for the most sequences from the program."""
    whole = np.where(lengths == capacity, counts, 0)
    out = [(int(whole.sum()), np.where(lengths == capacity, 1, 0))] if whole.any() else []
    counts = counts - whole
    some = np.flatnonzero(counts)
    if not len(some):
        return out
    few, left = lengths[some], counts[some]
    found = sorted(mixture(few, left, capacity), key=lambda x: capacity - int(x[1] @ few))
    reach = np.cumsum([copies for copies, _ in found])
    best = None
    for share in (1.0, 0.98, 0.95, 0.9, 0.85, 0.8, 0.7, 0.6, 0.5, 0.4, 0.3, 0.2, 0.1):
        kept = found[: int(np.searchsorted(reach, share * reach[-1], "right"))] if found else []
        rest = left.copy()
        for copies, c in kept:
            at = np.flatnonzero(c)
            rest[at] -= copies * c[at].astype(np.int64)
        both = best_fit(few, rest, capacity, kept)
        found_ = (sum(copies for copies, _ in both), -sum(copies for copies, _ in kept))
        LOG.debug("packing: sequences and those of the program at share %s: %s", share, found_)
        if best is None or found_ < best[:2]:
            best = (*found_, both)
    total, program, both = best
    LOG.info("packing: %d whole pieces; of %d more sequences %d from the linear program", whole.sum(), total, -program)
    for copies, c in both:
        config = np.zeros(len(lengths), np.int32)
        config[some] = c
        out.append((copies, config))
    return out


def places(lengths: np.ndarray, configs: list[tuple[int, np.ndarray]]) -> dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """By length: first ranks, first sequences and offsets of the runs that take its pieces in turn."""
    out: dict[int, list] = {int(n): [] for n in lengths}
    taken = dict.fromkeys(out, 0)
    base = 0
    for copies, config in configs:
        offset = 0
        for i in np.flatnonzero(config):
            n = int(lengths[i])
            for _ in range(config[i]):
                out[n].append((taken[n], base, offset))
                taken[n] += copies
                offset += n
        base += copies
    return {n: tuple(np.array(x, np.int64) for x in zip(*rows)) for n, rows in out.items() if rows}


def pack(docs: DataFrame, path: str, capacity: int = 1024, rows_per_block: int = 100_000) -> DataFrame:
    pieces = materialize(cut(docs, path, capacity=capacity), "pieces")
    histogram = sorted((r["length"], r["n"]) for r in pieces.groupBy("length").agg(F.count("*").alias("n")).collect())
    lengths, counts = (np.array(x, np.int64) for x in (zip(*histogram) if histogram else ([], [])))
    where = places(lengths, plan(lengths, counts, capacity)) if histogram else {}
    blocks = max(1, int(counts.sum()) // rows_per_block)
    pieces = materialize(pieces.withColumn("part", F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), F.lit(blocks))), "parts")
    order = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    first = pieces.groupBy("length", "part").agg(F.count("*").alias("n")).select("length", "part", F.coalesce(F.sum("n").over(order), F.lit(0)).alias("first"))
    rank = F.row_number().over(Window.partitionBy("part", "length").orderBy("doc_id", "piece", "ids_crc32")) - 1
    ranked = pieces.withColumn("rank", rank.cast("long")).join(F.broadcast(first) if blocks <= 64 else first, ["length", "part"])

    def place(batches):
        for batch in batches:
            length, rank = (batch.column(c).to_numpy() for c in ("length", "rank"))
            sequence, offset = np.zeros(len(length), np.int64), np.zeros(len(length), np.int64)
            for n in np.unique(length):
                at = np.flatnonzero(length == n)
                ranks, bases, offsets = where[int(n)]
                run = np.searchsorted(ranks, rank[at], "right") - 1
                sequence[at], offset[at] = bases[run] + rank[at] - ranks[run], offsets[run]
            kept = [batch.column(c) for c in ("doc_id", "piece", "start", "length", "ids_crc32")]
            yield pa.RecordBatch.from_arrays([*kept, pa.array(sequence), pa.array(offset)], ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"])

    ranked = ranked.select("doc_id", "piece", "start", "length", "ids_crc32", (F.col("first") + F.col("rank")).alias("rank"))
    return ranked.mapInArrow(place, PIECES + ", sequence_id long, offset long")
