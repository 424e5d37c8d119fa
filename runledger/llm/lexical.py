"""Ranked lexical search: bundles of items carry sparse document accumulators through successive term owners.

Documents are read once. Every task turns slices of texts into blocks of at most `BLOCK_ROWS` documents: their token counts and the postings of the
items' terms. Terms belong to `owners` in falling order of weight, each owner with an equal share of the items' weight. A stage meets an owner's
postings of a block with the accumulators of a bundle of items on that block (cogroup), adds integer contributions, and drops accumulators that
even the whole weight of the owners to come cannot lift to the item's k-th best partial score in all blocks so far. What is left after
the last owner are whole scores, whose best k are the result. No group is larger than one block by one bundle, however common a term is.

Terms are compared as bytes, never as hashes. Items are searched in groups whose terms have about `group_bytes` together (a scan each), so what is
sent to tasks is bounded. Null and empty texts hold no term; items without terms, or without an id, give no rows; rows of items with one id count
as one item; rows of documents that repeat are documents each; a document without an id counts and comes last among equal scores; very long texts
are never cut; empty tables give no rows; other columns, whatever their names, are ignored.
"""

from __future__ import annotations

import functools
import math
import string
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from runledger.llm.bytescan import LOWER, rows_of, slices, spans, text_column
from runledger.llm.shared import id_and_text, materialize

TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
#: Bytes of terms: digits, letters, and every byte of a code point beyond ASCII.
INSIDE = np.array([b >= 0x80 or chr(b) in string.ascii_letters + string.digits for b in range(256)])
BLOCK_BYTES, BLOCK_ROWS = 8 << 20, 16384
UNIT = 10**9 // 1000
NO_ID = np.iinfo(np.int64).max
INDEX = "block string, n_docs long, n_terms long, ids binary, lengths binary, df array<struct<term:int,n:long>>, terms binary, counts binary, docs binary, tfs binary"
PARTIAL = "block string, bundle int, items binary, docs binary, scores binary, best array<struct<item:int,score:long>>"
FOUND = "item int, doc_id long, score long"


def index_blocks(batches, vocabulary: list[bytes]):
    """Blocks with the token count of each document and the postings of the vocabulary, sorted by term, then document."""
    words, made = pa.array(vocabulary, pa.large_binary()), 0
    for batch in batches:
        ids = pc.fill_null(batch.column("doc_id"), NO_ID).to_numpy(zero_copy_only=False)
        part = batch.column("part")[0].as_py() if batch.num_rows else 0
        for first, end, data, offsets in slices(text_column(batch), BLOCK_BYTES, BLOCK_ROWS):
            inside = INSIDE[data]
            starts, ends = spans(inside, offsets)
            row = rows_of(starts, offsets)
            lengths = np.bincount(row, minlength=end - first)
            cuts = np.concatenate([[0], np.cumsum(ends - starts)]).astype(np.int64)
            tokens = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(cuts), pa.py_buffer(LOWER[data[inside]])])
            term = pc.fill_null(pc.index_in(tokens, words), -1).to_numpy(zero_copy_only=False)
            known = term >= 0
            pairs, tfs = np.unique(term[known].astype(np.int64) * BLOCK_ROWS + row[known], return_counts=True)
            terms, counts = np.unique(pairs // BLOCK_ROWS, return_counts=True)
            yield pa.RecordBatch.from_pydict({
                "block": [f"{part}-{made}"], "n_docs": [int((lengths > 0).sum())], "n_terms": [int(lengths.sum())], "ids": [ids[first:end].astype(np.int64).tobytes()],
                "lengths": [lengths.astype(np.int32).tobytes()], "df": [[{"term": int(t), "n": int(n)} for t, n in zip(terms, counts)]], "terms": [terms.astype(np.int32).tobytes()],
                "counts": [counts.astype(np.int32).tobytes()], "docs": [(pairs % BLOCK_ROWS).astype(np.uint16).tobytes()], "tfs": [tfs.astype(np.int32).tobytes()],
            }, schema=INDEX_ARROW)
            made += 1


def _arrow(schema: str) -> pa.Schema:
    kinds = {"string": pa.string(), "long": pa.int64(), "int": pa.int32(), "binary": pa.binary(), "array<struct<term:int,n:long>>": pa.list_(pa.struct([("term", pa.int32()), ("n", pa.int64())])),
             "array<struct<item:int,score:long>>": pa.list_(pa.struct([("item", pa.int32()), ("score", pa.int64())]))}
    return pa.schema([(c.split(" ")[0], kinds[c.split(" ")[1]]) for c in schema.split(", ")])


INDEX_ARROW, PARTIAL_ARROW, FOUND_ARROW = _arrow(INDEX), _arrow(PARTIAL), _arrow(FOUND)


class Plan:
    """One group of items: terms per item in falling order of weight, the owner of each term, and each item's weight still to come."""

    def __init__(self, items: list[tuple[int, str]], df: dict[int, int], vocabulary: list[bytes], n_docs: int, n_terms: int, owners: int, bundle: int):
        place = {t: i for i, t in enumerate(vocabulary)}
        self.ids = sorted({i for i, _ in items})
        at = {x: i for i, x in enumerate(self.ids)}
        self.n_docs, self.n_terms, self.bundle = n_docs, n_terms, bundle
        self.weight = np.array([math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df.get(t, 0) + 1))) for t in range(len(vocabulary))], np.int64)
        pairs = np.array(sorted((at[i], place[t.encode()]) for i, t in items), np.int64).reshape(-1, 2)
        # Terms that no document holds contribute nothing.
        pairs = pairs[np.array([df.get(int(t), 0) > 0 for t in pairs[:, 1]], bool)]
        share = np.bincount(pairs[:, 1], weights=self.weight[pairs[:, 1]], minlength=len(vocabulary))
        order = np.argsort(-self.weight, kind="stable")
        reached = np.empty(len(vocabulary))
        reached[order] = np.cumsum(share[order]) - share[order]
        self.owner = np.minimum(reached * owners // max(1.0, share.sum()), owners - 1).astype(np.int64)
        self.stages = sorted(set(self.owner[pairs[:, 1]].tolist()))
        self.terms = [[] for _ in self.ids]
        for i, t in pairs.tolist():
            self.terms[i].append(t)
        self.to_come = {s: np.bincount(pairs[later, 0], weights=self.weight[pairs[later, 1]], minlength=len(self.ids)).astype(np.int64) * UNIT for s in self.stages for later in [self.owner[pairs[:, 1]] > s]}
        self.bundles = -(-len(self.ids) // bundle)

    def owned(self, batches, stage: int):
        """Of each block the postings of one owner."""
        for batch in batches:
            for r in batch.to_pylist():
                terms, counts = np.frombuffer(r["terms"], np.int32), np.frombuffer(r["counts"], np.int32)
                own = self.owner[terms] == stage
                held = np.repeat(own, counts)
                yield pa.RecordBatch.from_pydict({k: [v] for k, v in {
                    "block": r["block"], "ids": r["ids"], "lengths": r["lengths"], "terms": terms[own].tobytes(), "counts": counts[own].tobytes(),
                    "docs": np.frombuffer(r["docs"], np.uint16)[held].tobytes(), "tfs": np.frombuffer(r["tfs"], np.int32)[held].tobytes()}.items()}, schema=OWNED_ARROW)

    def add(self, key, left: pa.Table, right: pa.Table, stage: int, cutoff: dict[int, int], k: int) -> pa.Table:
        """A bundle's accumulators on one block after this owner; after the last owner the block's best k of each item."""
        last, (block, bundle) = stage == self.stages[-1], (x.as_py() for x in key)
        r = right.to_pylist()[0]
        lengths = np.frombuffer(r["lengths"], np.int32).astype(np.int64)
        terms, ends = np.frombuffer(r["terms"], np.int32), np.cumsum(np.frombuffer(r["counts"], np.int32))
        docs, tfs = np.frombuffer(r["docs"], np.uint16), np.frombuffer(r["tfs"], np.int32).astype(np.int64)
        m = 100 - 90 + (90 * lengths * self.n_docs) // max(1, self.n_terms)
        gain = (10**9 * tfs) // (1000 * tfs + 8 * m[docs])
        spans_of = {int(t): slice(int(e - n), int(e)) for t, e, n in zip(terms, ends, np.diff(ends, prepend=0))}
        before = {}
        for x in left.to_pylist():
            items = np.frombuffer(x["items"], np.int32)
            cuts = np.flatnonzero(np.diff(items, prepend=-1))
            for a, b in zip(cuts, [*cuts[1:], len(items)]):
                before[int(items[a])] = np.frombuffer(x["docs"], np.uint16)[a:b], np.frombuffer(x["scores"], np.int64)[a:b]
        ids, kept, best = np.frombuffer(r["ids"], np.int64), [], []
        for item in range(bundle * self.bundle, min(len(self.ids), (bundle + 1) * self.bundle)):
            own = [t for t in self.terms[item] if t in spans_of]
            if not own and item not in before:
                continue
            score = np.zeros(len(lengths), np.int64)
            if item in before:
                score[before[item][0]] = before[item][1]
            for t in own:
                score[docs[spans_of[t]]] += self.weight[t] * gain[spans_of[t]]
            least = max(1, cutoff.get(item, 1))
            if (score > 0).sum() >= k:
                least = max(least, int(np.partition(score, len(score) - k)[len(score) - k]))
            stay = np.flatnonzero((score > 0) & (score + self.to_come[stage][item] >= least))
            top = stay[np.lexsort((ids[stay], -score[stay]))[:k]]
            best += [(item, int(d), int(score[d])) for d in top]
            if len(stay):
                kept.append((np.full(len(stay), item, np.int32), stay.astype(np.uint16), score[stay]))
        if last:
            return pa.Table.from_pydict({"item": [i for i, _, _ in best], "doc_id": [None if ids[d] == NO_ID else int(ids[d]) for _, d, _ in best], "score": [s for _, _, s in best]}, schema=FOUND_ARROW)
        blobs = [np.concatenate(x).tobytes() for x in zip(*kept)] if kept else [b"", b"", b""]
        return pa.Table.from_pydict({"block": [block], "bundle": [bundle], "items": blobs[:1], "docs": blobs[1:2], "scores": blobs[2:], "best": [[{"item": i, "score": s} for i, _, s in best]]}, schema=PARTIAL_ARROW)


OWNED = "block string, ids binary, lengths binary, terms binary, counts binary, docs binary, tfs binary"
OWNED_ARROW = _arrow(OWNED)


def best_of(rows: DataFrame, k: int, *ties) -> DataFrame:
    order = Window.partitionBy("item").orderBy(F.desc("score"), *ties)
    return rows.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def search_group(docs: DataFrame, items: list[tuple[int, str]], k: int, owners: int, bundle: int) -> DataFrame | None:
    vocabulary = sorted({t.encode() for _, t in items})
    index = materialize(docs.withColumn("part", F.spark_partition_id()).mapInArrow(functools.partial(index_blocks, vocabulary=vocabulary), INDEX), "index")
    n_docs, n_terms = index.agg(F.sum("n_docs"), F.sum("n_terms")).first()
    counts = index.select(F.inline("df")).groupBy("term").agg(F.sum("n").alias("n"))
    plan = Plan(items, {r["term"]: r["n"] for r in counts.collect()}, vocabulary, n_docs or 0, n_terms or 0, owners, bundle)
    if not plan.stages:
        return None
    bundles, partial, cutoff = F.explode(F.sequence(F.lit(0), F.lit(plan.bundles - 1))), None, {}
    for stage in plan.stages:
        right = index.select(*OWNED_ARROW.names).mapInArrow(functools.partial(plan.owned, stage=stage), OWNED).withColumn("bundle", bundles)
        left = docs.sparkSession.createDataFrame([], PARTIAL) if partial is None else partial
        add = functools.partial(plan.add, stage=stage, cutoff=cutoff, k=k)
        met = left.groupBy("block", "bundle").cogroup(right.groupBy("block", "bundle"))
        if stage == plan.stages[-1]:
            found = best_of(met.applyInArrow(lambda key, a, b: add(key, a, b), FOUND), k, F.asc_nulls_last("doc_id"))
            names = F.element_at(F.lit(plan.ids), F.col("item") + 1)
            return found.select(names.cast("long").alias("item_id"), "rank", "doc_id", "score")
        partial = materialize(met.applyInArrow(lambda key, a, b: add(key, a, b), PARTIAL), "accumulators")
        tenth = best_of(partial.select(F.inline("best")), k).filter(F.col("rank") == k)
        cutoff = {r["item"]: r["score"] for r in tenth.collect()}


def search(docs: DataFrame, items: DataFrame, k: int = 10, owners: int = 4, bundle: int = 256, group_bytes: int = 8 << 20) -> DataFrame:
    """docs: doc_id, text; items: item_id, text. Columns out: item_id, rank, doc_id, score."""
    lower = F.translate(F.col("text").cast("string"), string.ascii_uppercase, string.ascii_lowercase)
    asked = items.select(F.col("item_id").cast("long").alias("item_id"), F.explode(F.regexp_extract_all(lower, F.lit(TERM), F.lit(0))).alias("term")).filter("item_id IS NOT NULL").distinct()
    asked = materialize(asked, "items")
    groups = max(1, -(-int(asked.agg(F.sum(F.octet_length("term") + 8)).first()[0] or 0) // group_bytes))
    done = []
    for g in range(groups):
        rows = asked.filter(F.pmod(F.xxhash64("item_id"), F.lit(groups)) == g).collect()
        found = search_group(id_and_text(docs), [(r["item_id"], r["term"]) for r in rows], k, owners, bundle) if rows else None
        if found is not None:
            done.append(materialize(found, "found") if groups > 1 else found)
    if not done:
        return docs.sparkSession.createDataFrame([], "item_id long, rank int, doc_id long, score long")
    return functools.reduce(DataFrame.union, done)
