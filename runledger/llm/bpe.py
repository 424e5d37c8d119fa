"""Byte-level BPE by a rank queue over all new pieces of a batch.

The queue is a bitmap hierarchy over merge ranks: the lowest set bit names the next rank, its bucket holds positions of a linked list of tokens;
positions whose pair has changed since are stale and skipped. All live positions of a rank merge in one step (of overlapping ones every other,
from the left), so the cost grows with the bytes, not with the square of a piece's length. Where a vocabulary lets a merged token join at a lower
rank than its own, such a rank merges one position of each piece at a time, which keeps the order exact.

Null text counts as empty; an empty text has no ids and an empty table no rows; very long texts are one slice of their own; ties of rank merge from
the left; repeated rows and null ids give a row each; other columns, whatever their names, are ignored.
"""

from __future__ import annotations

import base64
import hashlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from runledger.llm.bytescan import slices, span_array, text_column
from runledger.llm.shared import id_and_text

MOST_KEPT, KEPT_BYTES = 1 << 20, 64 << 20
SLICE = 8 << 20
NONE = 1 << 30
OTHER, LETTER, NUMBER, SPACE = range(4)
APOSTROPHE, BLANK = 0x27, 0x20
#: Endings that an apostrophe takes with it (a fixed part of the public pattern).
ENDINGS = ("s", "t", "re", "ve", "m", "ll", "d")
_kinds: list[np.ndarray] = []


def kinds() -> np.ndarray:
    """The class of every code point, by the regular expression library's own tables."""
    if not _kinds:
        table = np.zeros(0x110000, np.uint8)
        for first in (0, 0xE000):
            every = "".join(map(chr, range(first, 0xD800 if first == 0 else 0x110000)))
            for kind, pattern in ((LETTER, r"\p{L}+"), (NUMBER, r"\p{N}+"), (SPACE, r"\s+")):
                for m in regex.finditer(pattern, every):
                    table[first + m.start() : first + m.end()] = kind
        _kinds.append(table)
    return _kinds[0]


def split_points(codes: np.ndarray, borders: np.ndarray) -> np.ndarray:
    """First code point of each match of the public pattern; borders: where texts begin and, last, end."""
    n = len(codes)
    if not n:
        return np.zeros(0, np.int64)
    kind = kinds()[codes]
    fresh = np.zeros(n, bool)
    fresh[0] = True
    fresh[1:] = kind[1:] != kind[:-1]
    text_start = np.zeros(n + 1, bool)
    text_start[borders] = True
    fresh |= text_start[:n]
    run = np.flatnonzero(fresh)
    end = np.append(run[1:], n)
    own = kind[run]
    point = fresh
    # A run of white space before something else leaves its last sign to what follows; a blank joins it.
    before = (own == SPACE) & ~text_start[end]
    last = end[before] - 1
    point[last] = True
    joined = last[codes[last] == BLANK] + 1
    point[joined] = False
    # A lone apostrophe that begins a match takes its ending from the letters behind it.
    lone = (own == OTHER) & (end - run == 1) & (codes[run] == APOSTROPHE) & point[run]
    lone[:-1] &= (own[1:] == LETTER) & ~text_start[run[1:]]
    lone[-1] = False
    at = np.flatnonzero(lone)
    letters, stop = run[at + 1], end[at + 1]
    for ending in ENDINGS:
        k = len(ending)
        ok = stop - letters >= k
        for i, sign in enumerate(ending):
            ok &= codes[np.minimum(letters + i, n - 1)] == ord(sign)
        point[letters[ok]] = False
        rest = letters[ok] + k
        point[rest[rest < stop[ok]]] = True
    return np.flatnonzero(point)


def regex_points(pattern, text: str, borders: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of any pattern's matches, text by text."""
    found = [(a + m.start(), a + m.end()) for a, b in zip(borders[:-1].tolist(), borders[1:].tolist()) for m in pattern.finditer(text[a:b]) if m.end() > m.start()]
    out = np.array(found, np.int64).reshape(-1, 2)
    return out[:, 0], out[:, 1]


class Codec:
    """Encoder and decoder of one vocabulary; pieces that recur are merged once, up to MOST_KEPT of them are kept."""

    def __init__(self, path: str, pattern: str = public_tokenizers.PATTERN):
        with open(path, "rb") as lines:
            self.ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        self.bytes_of = {v: k for k, v in self.ranks.items()}
        self.words = max(self.bytes_of) + 1
        self.byte_ids = np.array([self.ranks[bytes([i])] for i in range(256)])
        get, pairs = self.ranks.get, []
        for token, rank in self.ranks.items():
            for i in range(1, len(token)):
                a, b = get(token[:i]), get(token[i:])
                if a is not None and b is not None:
                    pairs.append((a << 24 | b, rank))
        pairs.sort()
        self.pair, self.pair_rank = (np.array(x, np.int64) for x in (zip(*pairs) if pairs else ([-1], [NONE])))
        a, b, low = self.pair >> 24, self.pair & 0xFFFFFF, self.pair_rank
        self.one_by_one = set(np.concatenate([a[low < a], b[low < b]]).tolist())
        self.pattern, self.plain = regex.compile(pattern), pattern == public_tokenizers.PATTERN
        self.forget()

    def forget(self) -> None:
        self.known, self.kept_bytes = {}, 0
        self.first, self.count, self.flat = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)

    def rank_of(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        wanted = a << 24 | b
        at = np.searchsorted(self.pair, wanted)
        at[at == len(self.pair)] = 0
        return np.where(self.pair[at] == wanted, self.pair_rank[at], NONE)

    def merge(self, data: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids, how many each piece has) of pieces laid end to end; starts: where each (non-empty) piece begins."""
        n, ends = len(data), np.append(starts[1:], len(data))
        token = np.append(self.byte_ids[data], -1)
        after, before = np.arange(1, n + 2), np.arange(-1, n)
        after[ends - 1], before[starts] = n, n
        piece = np.repeat(np.arange(len(starts)), ends - starts)
        rank = np.append(self.rank_of(token[:n], token[after[:n]]), NONE)
        rank[:n][after[:n] == n] = NONE
        leaves, top, later = [0] * ((self.words >> 8) + 1), 0, defaultdict(list)
        live = np.flatnonzero(rank < NONE)
        live = live[np.argsort(rank[live], kind="stable")]
        values, at = np.unique(rank[live], return_index=True)
        begun = dict(zip(values.tolist(), np.split(live, at[1:]))) if len(live) else {}
        for r in begun:
            leaves[r >> 8] |= 1 << (r & 255)
            top |= 1 << (r >> 8)
        while top:
            high = (top & -top).bit_length() - 1
            bits = leaves[high]
            r = high << 8 | (bits & -bits).bit_length() - 1
            leaves[high] = bits & (bits - 1)
            if not leaves[high]:
                top ^= 1 << high
            pos = begun.pop(r, None)
            if more := later.pop(r, None):
                pos = np.sort(np.array(more) if pos is None else np.concatenate([pos, np.array(more)]))
                pos = pos[np.append(True, pos[1:] != pos[:-1])]
            pos = pos[rank[pos] == r]
            if not len(pos):
                continue
            if len(pos) > 1:
                chained = after[pos[:-1]] == pos[1:]
                if chained.any():
                    head = np.append(True, ~chained)
                    index = np.arange(len(pos))
                    pos = pos[(index - np.maximum.accumulate(np.where(head, index, 0))) % 2 == 0]
                if r in self.one_by_one:
                    first = np.append(True, np.diff(piece[pos]) > 0)
                    if not first.all():
                        later[r], pos = pos[~first].tolist(), pos[first]
                        leaves[high] |= 1 << (r & 255)
                        top |= 1 << high
            gone = after[pos]
            following = after[gone]
            token[pos], token[gone], rank[gone] = r, -1, NONE
            after[pos], before[following] = following, pos
            left = before[pos]
            side = left < n
            place = np.concatenate([pos, left[side]])
            new = self.rank_of(token[place], token[after[place]])
            rank[place] = new
            ok = new < NONE
            for x, p in zip(new[ok].tolist(), place[ok].tolist()):
                if not (bucket := later[x]) and x not in begun:
                    leaves[x >> 8] |= 1 << (x & 255)
                    top |= 1 << (x >> 8)
                bucket.append(p)
        stay = token[:n] >= 0
        return token[:n][stay], np.add.reduceat(stay.astype(np.int64), starts)

    def learn(self, pieces: list[bytes]) -> None:
        """Keep the ids of pieces not met before."""
        get = self.ranks.get
        whole = np.array([get(p, -1) for p in pieces], np.int64)
        apart = np.flatnonzero(whole < 0)
        count, flat = np.ones(len(pieces), np.int64), whole
        if len(apart):
            size = np.array([len(pieces[i]) for i in apart])
            ids, count[apart] = self.merge(np.frombuffer(b"".join(pieces[i] for i in apart), np.uint8), np.cumsum(size) - size)
            flat = np.empty(count.sum(), np.int64)
            inner = np.repeat(whole < 0, count)
            flat[inner], flat[~inner] = ids, whole[whole >= 0]
        first = len(self.flat) + np.cumsum(count) - count
        self.known.update(zip(pieces, range(len(self.known), len(self.known) + len(pieces))))
        self.kept_bytes += sum(map(len, pieces))
        self.flat, self.first, self.count = np.concatenate([self.flat, flat]), np.concatenate([self.first, first]), np.concatenate([self.count, count])

    def encode_slice(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts, borders of the texts in them); data: UTF-8 bytes, offsets: of each text."""
        lead = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])
        text = data.tobytes().decode()
        borders = lead[offsets]
        if self.plain:
            codes = np.frombuffer(text.encode("utf-32-le"), np.uint32)
            point = split_points(codes, borders)
            stop = np.append(point[1:], len(codes))
        else:
            point, stop = regex_points(self.pattern, text, borders)
        at_byte = np.append(np.flatnonzero((data & 0xC0) != 0x80), len(data))
        starts, ends = at_byte[point], at_byte[stop]
        found = span_array(data, starts, ends).dictionary_encode()
        different = found.dictionary.to_pylist()
        if len(self.known) + len(different) > MOST_KEPT or self.kept_bytes > KEPT_BYTES:
            self.forget()
        if new := [p for p in different if p not in self.known]:
            self.learn(new)
        place = np.fromiter(map(self.known.__getitem__, different), np.int64, len(different))[found.indices.to_numpy()]
        count = self.count[place]
        reach = np.concatenate([[0], np.cumsum(count)])
        ids = self.flat[np.arange(reach[-1]) + np.repeat(self.first[place] - reach[:-1], count)]
        return ids, reach[np.searchsorted(starts, offsets)]

    def encode(self, text: str) -> list[int]:
        data = np.frombuffer(text.encode(), np.uint8)
        return self.encode_slice(data, np.array([0, len(data)]))[0].tolist()

    def decode(self, ids: list[int]) -> bytes:
        return b"".join(map(self.bytes_of.__getitem__, ids))


def digests(docs: DataFrame, path: str) -> DataFrame:
    """doc_id, n_tokens and the digests of each text's ids and of the bytes decoded from them."""

    def run(batches):
        codec = Codec(path)
        decimal = [str(i) for i in range(codec.words)]
        for batch in batches:
            for first, n, data, offsets in slices(text_column(batch), SLICE):
                ids, borders = codec.encode_slice(data, offsets)
                out = []
                for a, b in zip(borders[:-1].tolist(), borders[1:].tolist()):
                    own = ids[a:b].tolist()
                    shown, back = " ".join(map(decimal.__getitem__, own)), codec.decode(own)
                    out.append((hashlib.sha256(shown.encode()).hexdigest(), hashlib.sha256(back).hexdigest()))
                yield pa.RecordBatch.from_pydict({
                    "doc_id": batch.column("doc_id").slice(first, n - first), "n_tokens": np.diff(borders), "ids_sha256": [a for a, _ in out], "decoded_sha256": [b for _, b in out],
                })

    return id_and_text(docs).mapInArrow(run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
