"""Log-probabilities by a weighted backoff automaton over word n-grams.

A state is a context (up to order - 1 tokens, or the start of a text) seen in training; its arc for token w weighs
(c(hw) + mu * p(w | shorter h)) / (c(h) + mu), its failure arc mu / (c(h) + mu) leads to the shorter context; the root's arcs carry the add-half
base probability. A state is fixed by the last order - 1 tokens, so a traversal that starts that many tokens back is in the same state: all
positions of a block are traversed at once, from their highest state down the failure arcs to the first arc that fits.

Documents lie in blocks of about `block_bytes`, written once in the shared folder, so that a lost executor or an input that comes in another
order changes no block. Each block sends its n-grams once to the parts that own their ranges of hashes and gets back what other blocks add to
each count (`counts`; beyond `fan` parts by way of teams of blocks). So no task and no broadcast sees the whole model, the model grows with the
corpus, and the rows exchanged grow with the number of blocks. Keys are 63-bit hashes.

Null text counts as empty (one end token); an empty table gives no rows; a null id is a training text; very long texts are blocks of their own;
other columns, whatever their names, are ignored; repeated rows are scored and counted each.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from runledger.llm.bytescan import U64, mix, slices, text_column, word_hashes
from runledger.llm.counts import MESSAGE, elsewhere, mark, messages, ranges, unpacked
from runledger.llm.shared import crc_mod, id_and_text, materialize

START, END = U64(0x6C62272E07BB0142), U64(0xA24BAED4963EE407)
START_KEY = mix(np.array([START ^ U64(1)])) >> U64(1)
ROW = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"


def tokens(column):
    """(first row, rows, token hashes with a start before and an end after each text, token borders) by slices."""
    for first, end, data, offsets in slices(column):
        h, row = word_hashes(data, offsets)
        n = end - first
        borders = np.concatenate([[0], np.cumsum(np.bincount(row, minlength=n) + 2)]).astype(np.int64)
        out = np.full(borders[-1], END, U64)
        out[borders[:-1]] = START
        out[np.arange(len(h)) + 2 * row + 1] = h
        yield first, n, out, borders


def keys(t: np.ndarray, borders: np.ndarray, order: int) -> list[np.ndarray]:
    """By length, the key of the n-gram that ends at each token; 0 where the text is too short."""
    at = np.arange(len(t)) - np.repeat(borders[:-1], np.diff(borders))
    whole = [mix(t ^ U64(1))]
    for k in range(1, order):
        key = np.zeros(len(t), U64)
        key[1:] = mix(whole[-1][:-1] * U64(0x9E3779B97F4A7C15) + t[1:])
        key[at < k] = 0
        whole.append(key)
    return [np.where(at >= k, np.maximum(key >> U64(1), U64(1)), U64(0)) for k, key in enumerate(whole)]


def hashed(table: pa.Table, order: int):
    """Rows of a block as one run: (keys by length, training flag of each token, borders of the rows)."""
    train = np.asarray(table.column("train").to_pylist(), bool)
    parts, flags, borders = [[] for _ in range(order)], [], [np.zeros(1, np.int64)]
    for first, n, t, own in tokens(text_column(table)):
        for k, key in enumerate(keys(t, own, order)):
            parts[k].append(key)
        flags.append(np.repeat(train[first : first + n], np.diff(own)))
        borders.append(own[1:] + borders[-1][-1])
    return [np.concatenate(p) for p in parts], np.concatenate(flags), np.concatenate(borders)


def blocks_of(batches, block_bytes: int):
    """(block number, its rows) of a task's rows in input order."""
    base, index, held, size = TaskContext.get().partitionId() << 24, 0, [], 0
    for batch in batches:
        text = text_column(batch)
        lengths = np.diff(np.frombuffer(text.buffers()[1], np.int64)[text.offset : text.offset + len(text) + 1]) if len(text) else np.zeros(0, np.int64)
        begin, room = 0, np.cumsum(lengths)
        while begin < len(text):
            taken = room[begin - 1] if begin else 0
            stop = min(len(text), max(begin + 1, int(np.searchsorted(room, taken + block_bytes - size, "right"))))
            held.append(batch.slice(begin, stop - begin))
            size += int(room[stop - 1] - taken)
            begin = stop
            if size >= block_bytes or begin < len(text):
                yield base + index, pa.Table.from_batches(held)
                index, held, size = index + 1, [], 0
    if held:
        yield base + index, pa.Table.from_batches(held)


class Automaton:
    """States, arcs and failure arcs of the n-grams that a block holds."""

    def __init__(self, key: list[np.ndarray], counts, total: int, distinct: int, mu: float):
        """key: by length and position; counts(k, distinct keys, training counts within the block): their counts everywhere."""
        self.order, self.state, self.count, self.arc, self.fail = len(key), [], [], [], []
        for k, own in enumerate(key):
            different, at, back = np.unique(own, return_index=True, return_inverse=True)
            none = int(len(different) and different[0] == 0)
            c = np.concatenate([np.zeros(none, np.int64), counts(k, different[none:], back, none)])
            if k == 0:
                p = (c + 0.5) / (total + 0.5 * (distinct + 1))
            else:
                context, suffix = self.state[k - 1][at - 1], self.state[k - 1][at]
                p = (c + mu * self.chance[suffix]) / (self.count[k - 1][context] + mu)
            self.chance = p
            self.state.append(back.astype(np.int32))
            self.count.append(c)
            self.arc.append(np.log10(p))
            self.fail.append(np.log10(mu / (c + mu)))

    def traverse(self, key: list[np.ndarray]) -> np.ndarray:
        """The log-probability that each position adds, carried from its highest state down to the first arc that fits."""
        n = len(key[0])
        out, open_ = np.zeros(n), np.arange(n)
        for k in range(self.order - 1, 0, -1):
            here = open_[key[k][open_] > 0]
            state, arc = self.state[k - 1][here - 1], self.state[k][here]
            fits, known = self.count[k][arc] > 0, self.count[k - 1][state] > 0
            out[here[fits]] += self.arc[k][arc[fits]]
            fell = known & ~fits
            out[here[fell]] += self.fail[k - 1][state[fell]]
            still = np.ones(n, bool)
            still[here[fits]] = False
            open_ = open_[still[open_]]
        out[open_] += self.arc[0][self.state[0][open_]]
        return out


def score(docs: DataFrame, order: int = 3, mu: float = 100.0, block_bytes: int = 8 << 20, fan: int = 8192) -> DataFrame:
    held = F.coalesce(crc_mod("doc_id", 5) == 1, F.lit(False))
    rows = id_and_text(docs).select("doc_id", "text", (~held).alias("train"))

    def gather(batches):
        """The rows of a block as one compressed table, so that texts move once and small."""
        for block, table in blocks_of(batches, block_bytes):
            sink = pa.BufferOutputStream()
            with pa.ipc.new_stream(sink, table.schema, options=pa.ipc.IpcWriteOptions(compression=pa.Codec("zstd", 3))) as writer:
                writer.write_table(table)
            size = pc.sum(pc.binary_length(table.column("text"))).as_py() or 0
            yield pa.RecordBatch.from_pydict({"block": [block], "bytes": [size], "rows": [sink.getvalue().to_pybytes()]})

    blocks = materialize(rows.mapInArrow(gather, "block long, bytes long, rows binary"), "blocks")
    parts = 2 * max(1, -(-int(blocks.agg(F.coalesce(F.sum("bytes"), F.lit(0))).first()[0]) // block_bytes))
    cut = ranges(parts, fan)

    def send(batches):
        """A block's distinct n-grams with their training counts, cut into the ranges."""
        for batch in batches:
            for block, data in zip(batch.column("block").to_pylist(), batch.column("rows")):
                key, train, _ = hashed(pa.ipc.open_stream(data.as_buffer()).read_all(), order)
                for k, own in enumerate(key):
                    own = np.sort((own << U64(1) | train.astype(U64))[own > 0])
                    if not len(own):
                        continue
                    at = np.flatnonzero(np.append(True, own[1:] >> U64(1) != own[:-1] >> U64(1)))
                    yield from messages(block, k, own[at] >> U64(1), np.add.reduceat((own & U64(1)).astype(np.int64), at), 0, cut, cut).to_batches()

    answers, total, distinct = elsewhere(blocks.select("block", "rows").mapInArrow(send, MESSAGE), parts, fan, int(START_KEY[0]))

    def traverse(texts: pa.Table, answers: pa.Table) -> pa.Table:
        table = pa.ipc.open_stream(texts.column("rows")[0].as_buffer()).read_all()
        key, train, borders = hashed(table, order)
        answers = answers.sort_by([("k", "ascending"), ("part", "ascending")])

        def counts(k, different, back, none):
            mine = answers.filter(pc.equal(answers.column("k"), k))
            added = [unpacked(x).astype(np.int64) for x in mine.column("added").to_pylist()]
            ends = np.cumsum([0, *map(len, added)])
            if ends[-1] != len(different) or [mark(different[a:b]) for a, b in zip(ends[:-1], ends[1:])] != mine.column("own").to_pylist():
                raise RuntimeError("answers do not fit the block's keys")
            own = np.bincount(back, train, none + len(different)).astype(np.int64)[none:]
            return own + np.concatenate(added) if added else own

        model_ = Automaton(key, counts, total, distinct, mu)
        word = np.ones(borders[-1], bool)
        word[borders[:-1]] = False
        base, full = np.where(word, model_.arc[0][model_.state[0]], 0), np.where(word, model_.traverse(key), 0)
        known = word & (model_.count[0][model_.state[0]] > 0)
        at = borders[:-1]
        return pa.table({
            "doc_id": table.column("doc_id"), "held_out": pc.invert(table.column("train")), "n_tokens": np.diff(borders) - 1, "n_known": np.add.reduceat(known.astype(np.int64), at),
            "train_tokens": np.full(len(at), total, np.int64), "base_score": np.add.reduceat(base, at), "score": np.add.reduceat(full, at),
        })

    answers = answers.select("block", "part", "k", "own", "added")
    return blocks.select("block", "rows").groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(traverse, ROW)
