"""Words of Arrow text columns as arrays: places and 64-bit hashes, without a Python object per word.

Equal words have equal hashes; different ones collide with a chance of about 2**-64 a pair.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import blake2b

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

# Bytes hashed at once; the eight-byte arrays of a piece stay in a core's cache.
PIECE = 1 << 17
# Bytes of text whose arrays are held at once; a longer text makes a slice of its own.
SLICE = 1 << 19
_MASK = (1 << 64) - 1
_BASE = 0x9E3779B97F4A7C15
_STEP = 0xC2B2AE3D27D4EB4F


def byte_table(separators: bytes) -> np.ndarray:
    """True for each byte that belongs to a word."""
    table = np.ones(256, bool)
    table[list(separators)] = False
    return table


# The classes of the word definitions.
SPACED = byte_table(bytes([0x20, *range(0x09, 0x0E)]))
LETTERS = byte_table(bytes([*range(0x00, 0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x80)]))
LINES = byte_table(b"\n")

_VALUES = np.random.default_rng(20240101).integers(1, 1 << 63, 256, dtype=np.uint64)
_FOLDED = _VALUES.copy()
_FOLDED[ord("A") : ord("Z") + 1] = _VALUES[ord("a") : ord("z") + 1]


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base & _MASK, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


_UP = _powers(_BASE, PIECE + 1)
_DOWN = _powers(pow(_BASE, -1, 1 << 64), PIECE + 1)


def finish(h: np.ndarray) -> np.ndarray:
    """Spread every bit of a hash over all others."""
    h = h ^ (h >> np.uint64(31))
    h *= np.uint64(0x7FB5D329728EA185)
    h ^= h >> np.uint64(27)
    h *= np.uint64(0x81DADEF4BC2DD44D)
    h ^= h >> np.uint64(33)
    return h


def text_slices(batch: pa.RecordBatch, column: int | str, limit: int = SLICE) -> Iterator[pa.RecordBatch]:
    """The batch in runs of rows with about `limit` bytes of text."""
    offsets = raw(batch.column(column))[1]
    at, n = 0, batch.num_rows
    while at < n:
        to = max(at + 1, int(np.searchsorted(offsets, offsets[at] + limit, "right")) - 1)
        yield batch.slice(at, to - at)
        at = to


def raw(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string column; null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = pc.fill_null(column, "" if not pa.types.is_binary(column.type) else b"")
    if not len(column):
        return np.empty(0, np.uint8), np.zeros(1, np.int64)
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64 if wide else np.int32)[column.offset : column.offset + len(column) + 1]
    offsets = offsets.astype(np.int64)
    values = np.frombuffer(data, np.uint8) if data is not None else np.empty(0, np.uint8)
    return values[offsets[0] : offsets[-1]], offsets - offsets[0]


def places(values: np.ndarray, offsets: np.ndarray, table: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(starts, ends, first): byte places of the words; text i has words first[i] to first[i + 1] - 1."""
    inside = table[values]
    edge = np.zeros(len(values) + 1, bool)
    edge[offsets] = True
    opens = inside.copy()
    opens[1:] &= ~inside[:-1] | edge[1:-1]
    starts = np.flatnonzero(opens)
    closes = inside.copy()
    closes[:-1] &= ~inside[1:] | edge[1:-1]
    ends = np.flatnonzero(closes) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def hashed(values: np.ndarray, starts: np.ndarray, ends: np.ndarray, fold: bool = False) -> np.ndarray:
    """A 64-bit hash of values[start:end] for each sorted, disjoint range; `fold` takes A-Z as a-z."""
    table = _FOLDED if fold else _VALUES
    out = np.empty(len(starts), np.uint64)
    at, n = 0, len(starts)
    while at < n:
        base = starts[at]
        to = int(np.searchsorted(ends, base + PIECE, "right"))
        if to <= at:  # one range longer than a piece
            word = values[base : ends[at]]
            if fold:
                word = np.where((word >= 65) & (word <= 90), word + 32, word).astype(np.uint8)
            out[at] = int.from_bytes(blake2b(word.tobytes(), digest_size=8).digest(), "little")
            at += 1
            continue
        piece = table[values[base : ends[to - 1]]]
        piece *= _UP[: len(piece)]
        total = np.zeros(len(piece) + 1, np.uint64)
        np.cumsum(piece, out=total[1:])
        s, e = starts[at:to] - base, ends[at:to] - base
        out[at:to] = finish((total[e] - total[s]) * _DOWN[s])
        at = to
    return out


def windows(h: np.ndarray, k: int) -> np.ndarray:
    """Hash of the k items that start at each place of `h` (len(h) - k + 1 of them), by doubling."""
    size = len(h) - k + 1
    if size <= 0:
        return np.empty(0, np.uint64)
    total, at, block, span = None, 0, h, 1
    while True:
        factor = np.uint64(pow(_STEP, span, 1 << 64))
        if k & span:
            part = block[at : at + size]
            total = part.copy() if total is None else total * factor + part
            at += span
        if span * 2 > k:
            return finish(total + np.uint64(k))
        block = block[:-span] * factor + block[span:]
        span *= 2


def room(first: np.ndarray) -> np.ndarray:
    """For each word, the number of words from it to the end of its text."""
    counts = np.diff(first)
    return np.repeat(first[1:], counts) - np.arange(first[0], first[-1])


def owner(first: np.ndarray) -> np.ndarray:
    """For each word, the number of its text."""
    return np.repeat(np.arange(len(first) - 1), np.diff(first))


def covered(starts: np.ndarray, ends: np.ndarray, n: int) -> np.ndarray:
    """True for each of n places inside any range [start, end)."""
    delta = np.zeros(n + 1, np.int32)
    np.add.at(delta, starts, 1)
    np.add.at(delta, ends, -1)
    return np.cumsum(delta[:-1]) > 0


def per_text(flags: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Sum of flags over each text."""
    total = np.zeros(len(flags) + 1, np.int64)
    np.cumsum(flags, out=total[1:])
    return total[first[1:]] - total[first[:-1]]


def signed(h: np.ndarray) -> np.ndarray:
    return h.view(np.int64)
