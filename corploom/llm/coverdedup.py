"""Repeated passages of words, found through anchors at difference-cover positions."""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corploom.llm import words as W
from corploom.llm.ranges import bit_filter, passes, remove_ranges, row_key
from corploom.llm.shared import settled

# Perfect difference sets. Any two positions have a shift below the period that
# takes both to positions whose remainder is in the set.
COVERS = {7: (0, 1, 3), 13: (0, 1, 3, 9), 21: (0, 1, 4, 14, 16), 31: (0, 1, 3, 8, 12, 18)}
# Windows in a run of candidates are cut about every so many, where their hash says so.
CUT = 32


def period(width: int) -> int:
    """The largest known period that leaves an anchor at least 2/5 of a window, or all positions."""
    return max((v for v in COVERS if width - v + 1 >= max(1, width * 2 // 5)), default=1)


def _cover(v: int) -> np.ndarray:
    table = np.zeros(v, bool)
    table[list(COVERS.get(v, (0,)))] = True
    return table


def _tokens(batch: pa.RecordBatch, column: int) -> tuple[np.ndarray, np.ndarray]:
    values, offsets = W.raw(batch.column(column))
    starts, ends, first = W.places(values, offsets, W.SPACED)
    return W.hashed(values, starts, ends), first


def _anchors(h: np.ndarray, first: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """(places, hashes) of the anchor windows at cover positions of each text."""
    v = period(width)
    a = W.windows(h, width - v + 1)
    place = (np.arange(len(h)) - np.repeat(first[:-1], np.diff(first)))[: len(a)]
    at = np.flatnonzero(_cover(v)[place % v] & (W.room(first)[: len(a)] >= width - v + 1))
    return at, a[at]


def anchor_hashes(docs: DataFrame, text: str, width: int) -> DataFrame:
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in W.text_slices(batch, 0):
                yield pa.RecordBatch.from_arrays([pa.array(W.signed(_anchors(*_tokens(part, 0), width)[1]))], ["h"])

    return docs.select(text).mapInArrow(scan, "h long")


def segments(docs: DataFrame, key: str, text: str, width: int, known: Broadcast, whole: bool) -> DataFrame:
    """Runs of candidate windows, cut where the content says so: (_key, start, n, segment) and,
    with `whole`, the hashes of the windows.

    A window is a candidate if it holds an anchor that may be repeated. Equal runs are cut alike
    inside, so most repeats show as equal segments.
    """
    v = period(width)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in W.text_slices(batch, 1):
                h, first = _tokens(part, 1)
                at, a = _anchors(h, first, width)
                at = at[passes(known.value, a)]
                if not len(at):
                    continue
                begin = np.repeat(first[:-1], np.diff(first))
                near = W.covered(np.maximum(at - v + 1, begin[at]), at + 1, len(h))
                w = W.windows(h, width)
                s = np.flatnonzero(near[: len(w)] & (W.room(first)[: len(w)] >= width))
                if not len(s):
                    continue
                hashes, text_of = w[s], W.owner(first)[s]
                new = np.ones(len(s), bool)
                new[1:] = (np.diff(s) != 1) | (text_of[1:] != text_of[:-1]) | (hashes[1:] % np.uint64(CUT) == 0)
                opens = np.flatnonzero(new)
                n = np.diff(np.append(opens, len(s)))
                order = (np.arange(len(s)) - np.repeat(opens, n)).astype(np.uint64)
                segment = W.finish(np.add.reduceat(W.finish(hashes + order * np.uint64(W._BASE)), opens) + n.astype(np.uint64))
                keys = part.column(0).to_numpy(zero_copy_only=False)[text_of[opens]]
                columns = [pa.array(keys), pa.array(s[opens] - begin[s[opens]]), pa.array(n), pa.array(W.signed(segment))]
                if whole:
                    bounds = pa.array(np.append(opens, len(s)).astype(np.int32))
                    columns.append(pa.ListArray.from_arrays(bounds, pa.array(W.signed(hashes))))
                yield pa.RecordBatch.from_arrays(columns, ["_key", "start", "n", "segment", "windows"][: len(columns)])

    schema = "_key long, start long, n long, segment long" + ", windows array<long>" * whole
    return docs.select(row_key(key, text).alias("_key"), text).mapInArrow(scan, schema)


def repeated_ranges(docs: DataFrame, key: str, text: str, width: int) -> DataFrame:
    """(_key, _from, _to): ranges of words covered by windows that start more than once anywhere.

    1. Anchors (hashes of width - period + 1 words at cover positions) are counted; two equal
       windows always share one. Those seen twice go into a bit filter.
    2. Candidate windows are counted by segment. A segment seen twice is repeated throughout.
    3. The windows of the other segments, and of one copy of each repeated one, are counted
       singly, which is the exact extension of the anchors.
    Every count is folded before its shuffle; joins back to a hot hash are split by the
    adaptive join. No group is gathered.
    """
    seen = anchor_hashes(docs, text, width).groupBy("h").agg(F.count("*").alias("n")).filter("n > 1").select("h")
    known = bit_filter(seen, "h")
    counted = settled(
        segments(docs, key, text, width, known, False)
        .groupBy("segment")
        .agg(F.count("*").alias("times"), F.min(F.struct("_key", "start")).alias("first"))
    )
    resolved = F.col("times") > 1
    shown = ~resolved | (F.struct("_key", "start") == F.col("first"))
    placed = settled(
        segments(docs, key, text, width, known, True)
        .join(counted, "segment")
        .select("_key", "start", "n", resolved.alias("resolved"), F.when(shown, F.col("windows")).alias("windows"))
    )
    whole = placed.filter("resolved").select(
        "_key", F.col("start").alias("_from"), (F.col("start") + F.col("n") + (width - 1)).alias("_to")
    )
    single = placed.select("_key", "start", "resolved", F.posexplode("windows").alias("i", "h"))
    twice = single.groupBy("h").agg(F.count("*").alias("times")).filter("times > 1").select("h")
    rest = (
        single.filter("not resolved")
        .join(twice, "h")
        .select("_key", (F.col("start") + F.col("i")).alias("_from"), (F.col("start") + F.col("i") + width).alias("_to"))
    )
    return settled(whole.unionByName(rest))


def cut_words(text: bytes, starts: list[int], ends: list[int]) -> dict:
    words = text.split()
    if starts:
        removed = W.covered(np.array(starts), np.array(ends), len(words))
        kept = [w for w, gone in zip(words, removed, strict=True) if not gone]
    else:
        kept = words
    return {
        "n_words": len(words),
        "n_removed": len(words) - len(kept),
        "kept_text": (joined := b" ".join(kept)).decode(),
        "kept_sha256": sha256(joined).hexdigest(),
    }


def cut_words_narrow(text: bytes, starts: list[int], ends: list[int]) -> dict:
    return {k: v for k, v in cut_words(text, starts, ends).items() if k != "kept_text"}


def remove_repeats(docs: DataFrame, key: str = "doc_id", text: str = "text", width: int = 35, texts: bool = True) -> DataFrame:
    """`key`, n_words, n_removed, kept_text (with `texts`) and kept_sha256 for every row.

    Every word in a window of `width` words that also starts elsewhere, in the same text too, is
    removed; all copies go, and windows are judged on the input. A null or empty text has no
    words and keeps the hash of nothing; shorter texts than a window stay whole; repeated rows
    are copies of each other. An empty table gives no rows; other columns are left out. Word and
    window hashes have 64 bits, so an unequal pair is taken as equal with a chance of 2**-64.
    """
    narrow = docs.select(key, text)
    ranges = repeated_ranges(narrow, key, text, width)
    schema = "n_words long, n_removed long, " + "kept_text string, " * texts + "kept_sha256 string"
    return remove_ranges(narrow, ranges, key, text, cut_words if texts else cut_words_narrow, schema)
