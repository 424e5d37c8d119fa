"""Vectorised scans over Arrow text buffers: words, rolling hashes and n-gram hashes without a Python loop per word.

Texts are taken in slices of a few MB, so memory is bounded whatever the batch size; one text is never cut.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash

U64 = np.uint64
SLICE_BYTES = 2 << 20
SHORT = 16
#: Odd multiplier of the rolling hash and its inverse modulo 2**64.
BASE = 0x9E3779B97F4A7C15
BASE_INVERSE = pow(BASE, -1, 1 << 64)
#: ASCII white space: space and \t \n \v \f \r.
SPACE = np.isin(np.arange(256), [0x20, *range(0x09, 0x0E)])
LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A") : ord("Z") + 1] += 32
_BYTE_CODE = np.random.default_rng(20240229).integers(1, 1 << 63, 256, dtype=U64) | U64(1)
_powers = [np.ones(1, U64), np.ones(1, U64)]


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """BASE**i and BASE**-i for i below n (kept per worker, grown when a longer slice comes)."""
    if len(_powers[0]) < n:
        size = max(n, SLICE_BYTES + 1)
        for k, base in enumerate((BASE, BASE_INVERSE)):
            step = np.full(size, base, U64)
            step[0] = 1
            _powers[k] = np.multiply.accumulate(step)
    return _powers[0][:n], _powers[1][:n]


def mix(h: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (xor-shift and multiply)."""
    h = h ^ (h >> U64(33))
    h = h * U64(0xFF51AFD7ED558CCD)
    h ^= h >> U64(33)
    h *= U64(0xC4CEB9FE1A85EC53)
    h ^= h >> U64(33)
    return h


def text_column(batch: pa.RecordBatch | pa.Table, name: str = "text") -> pa.Array:
    column = batch.column(name)
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return pc.fill_null(column, "").cast(pa.large_string())


def slices(column: pa.Array, most: int = SLICE_BYTES, rows: int = 1 << 20) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, last row + 1, bytes, offsets from 0) of consecutive rows, at most `rows`, with about `most` bytes together."""
    n = len(column)
    if not n:
        return
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64)[column.offset : column.offset + n + 1]
    data = np.frombuffer(data, np.uint8) if data is not None and len(data) else np.zeros(0, np.uint8)
    row = 0
    while row < n:
        end = max(row + 1, int(np.searchsorted(offsets, offsets[row] + most, "right")) - 1)
        end = min(end, n, row + rows)
        yield row, end, data[offsets[row] : offsets[end]], offsets[row : end + 1] - offsets[row]
        row = end


def spans(inside: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the maximal runs where `inside` holds; a run never crosses a text's border."""
    if not len(inside):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    start, end = inside.copy(), inside.copy()
    start[1:] &= ~inside[:-1]
    end[:-1] &= ~inside[1:]
    cuts = offsets[1:-1]
    cuts = cuts[(cuts > 0) & (cuts < len(inside))]
    cuts = cuts[inside[cuts] & inside[cuts - 1]]
    start[cuts] = True
    end[cuts - 1] = True
    return np.flatnonzero(start), np.flatnonzero(end) + 1


def rows_of(starts: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    return np.searchsorted(offsets, starts, "right") - 1


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each span's bytes, by differences of one prefix sum. Some long spans share it by construction: only for features and signatures."""
    up, down = powers(len(data) + 1)
    prefix = np.zeros(len(data) + 1, U64)
    np.cumsum(_BYTE_CODE[data] * up[:-1], out=prefix[1:])
    return mix((prefix[ends] - prefix[starts]) * down[starts] + (ends - starts).astype(U64) * U64(0xD6E8FEB86659FD93))


def span_array(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> pa.LargeBinaryArray:
    """The spans' bytes as an Arrow array."""
    size = ends - starts
    cuts = np.concatenate([[0], np.cumsum(size)]).astype(np.int64)
    own = data[np.arange(cuts[-1]) + np.repeat(starts - cuts[:-1], size)] if len(starts) and cuts[-1] != ends[-1] - starts[0] else data[starts[0] : ends[-1]] if len(starts) else data[:0]
    return pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(cuts), pa.py_buffer(np.ascontiguousarray(own))])


def word_hashes(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(hash, row) of each word: maximal runs without ASCII white space, A-Z lower-cased. Words of over SHORT bytes are told apart by their bytes and
    each different one is hashed by xxHash64, for long spans can share a polynomial hash by construction; two words share a hash by chance alone."""
    data = LOWER[data]
    starts, ends = spans(~SPACE[data], offsets)
    h = span_hashes(data, starts, ends)
    long = np.flatnonzero(ends - starts > SHORT)
    if len(long):
        words = span_array(data, starts[long], ends[long]).dictionary_encode()
        h[long] = np.fromiter(map(xxhash.xxh64_intdigest, words.dictionary.to_pylist()), U64, len(words.dictionary))[words.indices.to_numpy()]
    return h, rows_of(starts, offsets)
