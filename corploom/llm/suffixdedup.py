"""Repeated byte strings, found by suffix arrays over shards that hold all places of a core."""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corploom.llm import words as W
from corploom.llm.ranges import bit_filter, passes, remove_ranges, row_key
from corploom.llm.shared import settled
from corploom.llm.suffixes import common_prefixes, suffix_array

# Window starts of which pieces are sought at once; bounds the eight-byte arrays.
BLOCK = 1 << 16
STEPS = 4
# Bytes of one suffix array, and different pieces of one core that may share it.
SHARD_BYTES = 1 << 20
GROUP = 512
_LOW = np.uint64((1 << 20) - 1)


def anchor_width(length: int) -> int:
    return max(1, length // 8)


@lru_cache(maxsize=2)
def _scales(n: int) -> tuple[np.ndarray, np.ndarray]:
    return W._powers(W._BASE, n), W._powers(pow(W._BASE, -1, 1 << 64), n)


def core_step(length: int) -> int:
    """Windows of one anchor are dealt to STEPS pieces by the anchor's place in them."""
    return -(-(length - anchor_width(length) + 1) // STEPS)


def pieces(values: np.ndarray, offsets: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(first start, number of starts, core's place, core's hash) of the pieces of all windows of `length` bytes.

    A window's anchor is the last of its least strings of `anchor_width` bytes; windows of one
    anchor with the anchor at nearly one place are a piece, and the bytes that all windows of
    such a piece can hold are its core. Anchor, piece and core follow from the window's bytes
    alone, so equal windows lie in pieces of equal cores.
    """
    k, step = anchor_width(length), core_step(length)
    span = length - k + 1
    up, down = _scales(BLOCK + length)
    ends = np.repeat(offsets[1:], np.diff(offsets))
    found: list[tuple[np.ndarray, ...]] = []
    for at in range(0, len(values) - length + 1, BLOCK):
        block = values[at : at + BLOCK + length - 1]
        total = np.zeros(len(block) + 1, np.uint64)
        np.cumsum(W._VALUES[block] * up[: len(block)], out=total[1:])
        h = (total[k:] - total[:-k]) * down[: len(block) - k + 1]
        h ^= h >> np.uint64(32)
        h *= np.uint64(W._STEP)
        h &= ~_LOW
        h |= _LOW - np.arange(len(h), dtype=np.uint64)
        least, width = h, 1
        while width * 2 <= span:
            least = np.minimum(least[:-width], least[width:])
            width *= 2
        n = len(h) - span + 1
        least = np.minimum(least[:n], least[span - width : span - width + n])
        start = np.flatnonzero(at + np.arange(n) + length <= ends[at : at + n])
        if not len(start):
            continue
        anchor = (_LOW - (least[start] & _LOW)).astype(np.int64)
        part = (anchor - start) // step
        new = np.ones(len(start), bool)
        new[1:] = (np.diff(start) != 1) | (anchor[1:] != anchor[:-1]) | (part[1:] != part[:-1])
        opens = np.flatnonzero(new)
        low = part[opens] * step
        core = anchor[opens] - low
        stop = anchor[opens] - np.minimum(low + step, span) + 1 + length
        hashes = W.finish((total[stop] - total[core]) * down[core] + part[opens].astype(np.uint64))
        found.append((start[opens] + at, np.diff(np.append(opens, len(start))), core + at, hashes))
    if not found:
        return (*(np.empty(0, np.int64) for _ in range(3)), np.empty(0, np.uint64))
    return tuple(np.concatenate(x) for x in zip(*found, strict=True))


def core_hashes(docs: DataFrame, text: str, length: int) -> DataFrame:
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in W.text_slices(batch, 0, BLOCK):
                yield pa.RecordBatch.from_arrays([pa.array(W.signed(pieces(*W.raw(part.column(0)), length)[3]))], ["h"])

    return docs.select(text).mapInArrow(scan, "h long")


def place_number(keys: np.ndarray, starts: np.ndarray) -> np.ndarray:
    return W.finish(keys.view(np.uint64) + starts.astype(np.uint64) * np.uint64(W._BASE))


def place_filter(places: DataFrame) -> Broadcast:
    """A bit filter of the places (_key, start)."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, starts = (batch.column(i).to_numpy(zero_copy_only=False) for i in (0, 1))
            yield pa.RecordBatch.from_arrays([pa.array(W.signed(place_number(keys, starts)))], ["place"])

    return bit_filter(places.select("_key", "start").mapInArrow(scan, "place long"), "place")


def surroundings(docs: DataFrame, key: str, text: str, length: int, known: Broadcast, shown: Broadcast | None = None) -> DataFrame:
    """(_key, h, around, start, stop) for each piece whose core may be repeated: the range of the
    bytes of all its windows, and a hash of them. With `shown`, only at places that may be in
    that filter, and with the bytes as content."""
    whole = shown is not None

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in W.text_slices(batch, 1, BLOCK):
                values, offsets = W.raw(part.column(1))
                found = pieces(values, offsets, length)
                start, n, core, h = (x[passes(known.value, found[3])] for x in found)
                if not len(start):
                    continue
                owner = np.searchsorted(offsets, start, "right") - 1
                if whole:
                    keys = part.column(0).to_numpy(zero_copy_only=False)[owner]
                    hit = passes(shown.value, place_number(keys, start - offsets[owner]))
                    start, n, core, h, owner = start[hit], n[hit], core[hit], h[hit], owner[hit]
                stop = start + n - 1 + length
                contents = [values[a:b].tobytes() for a, b in zip(start, stop, strict=True)]
                around = [
                    int.from_bytes(sha256(p.to_bytes(4, "little") + c).digest()[:8], "little", signed=True)
                    for p, c in zip((core - start).tolist(), contents, strict=True)
                ]
                keys = part.column(0).to_numpy(zero_copy_only=False)[owner]
                columns = [pa.array(keys), pa.array(W.signed(h)), pa.array(around, pa.int64())]
                columns += [pa.array(start - offsets[owner]), pa.array(stop - offsets[owner])]
                if whole:
                    columns.append(pa.array(contents, pa.binary()))
                yield pa.RecordBatch.from_arrays(columns, ["_key", "h", "around", "start", "stop", "content"][: len(columns)])

    schema = "_key long, h long, around long, start long, stop long" + ", content binary" * whole
    return docs.select(row_key(key, text).alias("_key"), text).mapInArrow(scan, schema)


def _joined(rows: list[dict]) -> list[tuple[int, int, bytes]]:
    """(key, start, bytes): surroundings of one document that overlap become one stretch."""
    out: list[tuple[int, int, bytes]] = []
    for r in sorted(rows, key=lambda r: (r["_key"], r["start"], r["stop"])):
        if out and out[-1][0] == r["_key"] and r["start"] <= out[-1][1] + len(out[-1][2]):
            key, start, content = out[-1]
            more = r["stop"] - start - len(content)
            if more > 0:
                out[-1] = (key, start, content + r["content"][-more:])
        else:
            out.append((r["_key"], r["start"], r["content"]))
    return out


def shard_repeats(rows: list[dict], length: int) -> Iterator[tuple[int, int, int]]:
    """(key, from, to): runs of bytes covered by windows that start twice in the shard."""
    stretches = _joined(rows)
    sizes = np.array([len(c) for _, _, c in stretches])
    t = np.zeros(int(sizes.sum()) + len(sizes), np.int32)  # 0 ends each stretch
    begins = np.cumsum(sizes + 1) - sizes - 1
    for begin, (_, _, content) in zip(begins, stretches, strict=True):
        t[begin : begin + len(content)] = np.frombuffer(content, np.uint8).astype(np.int32) + 1
    sa = suffix_array(t)
    prefixes = common_prefixes(t, sa, length)
    left = np.repeat(begins + sizes, sizes + 1) - np.arange(len(t))
    starts = np.zeros(len(t), bool)
    pairs = np.flatnonzero(prefixes[sa[1:]] >= length) + 1  # ranks whose suffix shares a window with the one before
    a, b = sa[pairs], sa[pairs - 1]
    fit = (left[a] >= length) & (left[b] >= length)
    starts[a[fit]] = True
    starts[b[fit]] = True
    at = np.flatnonzero(starts)
    if not len(at):
        return
    covered = W.covered(at, at + length, len(t) + 1)
    edges = np.flatnonzero(np.diff(np.concatenate([[0], covered.astype(np.int8), [0]])))
    of = np.searchsorted(begins, edges[::2], "right") - 1
    for i, low, high in zip(of.tolist(), edges[::2].tolist(), edges[1::2].tolist(), strict=True):
        key, start, _ = stretches[i]
        yield key, start + low - int(begins[i]), start + high - int(begins[i])


def suffix_shards(rows: DataFrame, length: int) -> DataFrame:
    """(_key, _from, _to) from rows (h, _key, start, stop, content): cores are dealt to tasks by hash,
    whole cores fill a shard up to about SHARD_BYTES, and each shard is one suffix array."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[dict] = []
        size, last = 0, None

        def done() -> pa.RecordBatch:
            found = list(shard_repeats(held, length)) if held else []
            columns = [pa.array([f[i] for f in found], pa.int64()) for i in range(3)]
            return pa.RecordBatch.from_arrays(columns, ["_key", "_from", "_to"])

        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                for r in batch.slice(at, 256).to_pylist():
                    if r["h"] != last and size >= SHARD_BYTES:
                        yield done()
                        held, size = [], 0
                    held.append(r)
                    size, last = size + len(r["content"]), r["h"]
        yield done()

    ordered = rows.select("h", "_key", "start", "stop", "content").repartition("h").sortWithinPartitions("h")
    return ordered.mapInArrow(scan, "_key long, _from long, _to long")


def single_windows(rows: DataFrame, length: int) -> DataFrame:
    """(_key, _from, _to) for cores with too many pieces for a task: their windows are counted by hash."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                values, offsets = W.raw(part.column(2))
                h = W.windows(W._VALUES[values], length)
                place = np.arange(len(h))
                owner = np.searchsorted(offsets, place, "right") - 1
                fit = place + length <= offsets[owner + 1]
                keys = part.column(0).to_numpy(zero_copy_only=False)[owner[fit]]
                start = part.column(1).to_numpy(zero_copy_only=False)[owner[fit]] + (place - offsets[owner])[fit]
                yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array(start), pa.array(W.signed(h[fit]))], ["_key", "start", "w"])

    windows = rows.select("_key", "start", "content").mapInArrow(scan, "_key long, start long, w long")
    places = windows.groupBy("w").agg(
        F.min(F.struct("_key", "start")).alias("low"), F.max(F.struct("_key", "start")).alias("high")
    )
    twice = places.filter("low <> high").select("w")
    return windows.join(twice, "w").select("_key", F.col("start").alias("_from"), (F.col("start") + length).alias("_to"))


def repeated_ranges(docs: DataFrame, key: str, text: str, length: int) -> DataFrame:
    """(_key, _from, _to): byte ranges covered by strings of `length` bytes that start more than once anywhere.

    1. Windows of `length` bytes fall into pieces with a core of most of a window, chosen by
       their bytes; cores seen twice go into a bit filter. 2. Pieces of equal bytes are repeats
       throughout, known from hashes. 3. Cores with different pieces go, one copy of each, to
       shards with a suffix array. Only cores with more than GROUP different pieces, which no
       task should gather, have their windows counted by hash.
    """
    seen = core_hashes(docs, text, length).groupBy("h").agg(F.count("*").alias("n")).filter("n > 1").select("h")
    known = bit_filter(seen, "h")
    placed = settled(surroundings(docs, key, text, length, known))
    counted = settled(
        placed.groupBy("h", "around")
        .agg(F.count("*").alias("times"), F.min(F.struct("_key", "start", "stop")).alias("first"))
    )
    groups = counted.groupBy("h").agg(F.count("*").alias("kinds"))
    split = counted.join(groups.filter("kinds > 1"), "h").select("h", "around", "kinds", "times", "first")
    known_again = settled(counted.filter("times > 1").select("h", "around"))
    same = placed.join(known_again, ["h", "around"])
    whole = same.filter(F.col("stop") - F.col("start") >= length).select("_key", F.col("start").alias("_from"), F.col("stop").alias("_to"))
    shown = settled(split.select("h", "around", "kinds", F.col("first._key").alias("_key"), F.col("first.start").alias("start")))
    content = settled(
        surroundings(docs, key, text, length, known, place_filter(shown))
        .join(shown, ["h", "around", "_key", "start"])
        .select("h", "kinds", "_key", "start", "stop", "content")
        .dropDuplicates(["h", "_key", "start"])
    )
    few = suffix_shards(content.filter(F.col("kinds") <= GROUP), length)
    many = single_windows(content.filter(F.col("kinds") > GROUP), length)
    return settled(whole.unionByName(few).unionByName(many).distinct())


def cut_bytes(text: bytes, starts: list[int], ends: list[int]) -> dict:
    values = np.frombuffer(text, np.uint8)
    removed = W.covered(np.array(starts, np.int64), np.array(ends, np.int64), len(values)) if starts else np.zeros(len(values), bool)
    edges = np.diff(np.concatenate([[0], removed.astype(np.int8)]))
    kept = values[~removed].tobytes() if starts else text
    return {
        "n_bytes": len(text),
        "n_removed": int(removed.sum()),
        "n_spans": int((edges > 0).sum()),
        "kept_sha256": sha256(kept).hexdigest(),
        "kept_text": kept.decode("utf-8", "replace"),
    }


def cut_bytes_narrow(text: bytes, starts: list[int], ends: list[int]) -> dict:
    return {k: v for k, v in cut_bytes(text, starts, ends).items() if k != "kept_text"}


def remove_repeats(docs: DataFrame, key: str = "doc_id", text: str = "text", length: int = 400, texts: bool = True) -> DataFrame:
    """`key`, n_bytes, n_removed, n_spans, kept_sha256 and (with `texts`) kept_text for every row.

    Every UTF-8 byte inside a string of `length` bytes that also starts elsewhere, in the same
    text too, is removed; all copies go, overlaps count, strings are judged on the input and
    don't cross texts. kept_text shows a character that was cut through as U+FFFD; the hash is
    of the bytes. A null or empty text has no bytes; shorter texts stay whole; repeated rows are
    copies of each other. An empty table gives no rows; other columns are left out. Places are
    compared by bytes in the suffix arrays and by 64-bit hashes elsewhere.
    """
    narrow = docs.select(key, text)
    ranges = repeated_ranges(narrow, key, text, length)
    schema = "n_bytes long, n_removed long, n_spans long, kept_sha256 string" + ", kept_text string" * texts
    return remove_ranges(narrow, ranges, key, text, cut_bytes if texts else cut_bytes_narrow, schema)
