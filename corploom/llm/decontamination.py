"""Benchmark decontamination through suffix arrays of training shards."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corploom.llm import words as W

# Benchmark words searched at once; a longer benchmark is searched in several blocks.
BLOCK_WORDS = 1_000_000
# Words of a suffix that must begin some benchmark suffix for it to enter a shard's array.
SEED = 3
_SEED_BITS = 22
# Pairs of places that are extended at once.
PAIRS = 1 << 20

SPAN = "struct<start: int, end: int>"
MATCH = "struct<item_id: string, item_start: int, doc_start: int, length: int>"
_SPAN = pa.struct([("start", pa.int32()), ("end", pa.int32())])
_MATCH = pa.struct([("item_id", pa.string()), ("item_start", pa.int32()), ("doc_start", pa.int32()), ("length", pa.int32())])
_NONE = np.uint64(0x6C62272E07BB0142)


def _flat(first: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(of, at): the entries at[j] of the lists rows[of[j]], where list i is first[i] to first[i + 1] - 1."""
    return _ranges(first[rows], first[rows + 1])


def _ranges(low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(of, at): every place at[j] from low to high - 1, and the number of its range."""
    counts = high - low
    of = np.repeat(np.arange(len(low)), counts)
    return of, np.arange(len(of)) - np.repeat(np.cumsum(counts) - counts, counts) + low[of]


def _bisect(low: np.ndarray, high: np.ndarray, below) -> np.ndarray:
    """For each range, the first place that is not below what it is asked for; `below(which, places)` tells."""
    low, high = low.copy(), high.copy()
    while len(which := np.flatnonzero(low < high)):
        middle = (low[which] + high[which]) // 2
        less = below(which, middle)
        low[which[less]] = middle[less] + 1
        high[which[~less]] = middle[~less]
    return low


@dataclass
class Suffixes:
    """Benchmark suffixes, cut to the words that must match: the distinct ones as rows, where they stand, and whose they are."""

    h: np.ndarray  # word hashes of all texts, one after another
    first: np.ndarray  # of each text: its first word
    ids: list[list[str]]  # of each text: the ids that carry it
    at: np.ndarray  # of each row: a place where it begins
    depth: np.ndarray
    where_first: np.ndarray  # the places of row i are where[where_first[i]:where_first[i + 1]]
    where: np.ndarray
    kin: np.ndarray  # of each row: the number of its set of texts
    kin_first: np.ndarray  # the texts of set i are kin_texts[kin_first[i]:kin_first[i + 1]]
    kin_texts: np.ndarray
    seeds: list[np.ndarray]  # by seed width: bits of the seeds, eight a byte
    made: dict = field(default_factory=dict)  # what `longest` keeps from shard to shard

    def __getstate__(self) -> dict:
        return {**self.__dict__, "made": {}}


def _seed_bits(h: np.ndarray, n: int) -> np.ndarray:
    return (W.windows(h, n) >> np.uint64(64 - _SEED_BITS)).astype(np.int64)


def suffixes(texts: list[str], ids: list[list[str]], k: int) -> Suffixes:
    """Every suffix of at least k words, and the whole of a shorter text.

    All of it is arrays of 4 or 8 bytes a word, some 40 bytes a word together.
    """
    values, offsets = W.raw(pa.array(texts, pa.large_string()))
    starts, ends, first = W.places(values, offsets, W.LETTERS)
    h = W.hashed(values, starts, ends, fold=True)
    del values, starts, ends
    room, counts = W.room(first), np.diff(first)
    owner = W.owner(first).astype(np.int32)
    keys, begins, depths, seeds = [], [], [], [np.zeros(0, np.uint8) for _ in range(SEED + 1)]
    for depth in range(1, k + 1):
        # Short texts begin one suffix each, the others one at each place with k words ahead.
        begin = np.flatnonzero(room >= k) if depth == k else first[:-1][counts == depth]
        if not len(begin):
            continue
        keys.append(W.windows(h, depth)[begin])
        begins.append(begin)
        depths.append(np.full(len(begin), depth, np.int16))
        width = min(SEED, depth)
        if not len(seeds[width]):
            seeds[width] = np.zeros(1 << _SEED_BITS - 3, np.uint8)
        bits = _seed_bits(h, width)[begin]
        np.bitwise_or.at(seeds[width], bits >> 3, np.uint8(1) << (bits & 7).astype(np.uint8))
    if not begins:
        none, zero = np.zeros(0, np.int64), np.zeros(1, np.int64)
        return Suffixes(h, first, ids, none, none, zero, none, none, zero, none, seeds)
    key, begin, depth = np.concatenate(keys), np.concatenate(begins), np.concatenate(depths)
    _, one, row = np.unique(key, return_index=True, return_inverse=True)
    order = np.lexsort((begin, row))
    where_first = np.searchsorted(row[order], np.arange(len(one) + 1))
    # Rows of the same texts share a set of texts, known by the sum of the texts' hashes.
    pairs = np.unique(row * len(texts) + owner[begin])
    texts_of, whose = pairs % len(texts), pairs // len(texts)
    total = np.zeros(len(one), np.uint64)
    np.add.at(total, whose, W.finish((texts_of + 1).astype(np.uint64) * _NONE))
    texts_first = np.searchsorted(whose, np.arange(len(one) + 1))
    _, sample, kin = np.unique(total, return_index=True, return_inverse=True)
    of, at = _flat(texts_first, sample)
    return Suffixes(
        h, first, ids, begin[one], depth[one].astype(np.int64), where_first, begin[order].astype(np.int32),
        kin.astype(np.int32), np.searchsorted(of, np.arange(len(sample) + 1)), texts_of[at].astype(np.int32), seeds,
    )


def shard_array(h: np.ndarray, left: np.ndarray, asked: Suffixes, k: int) -> tuple[np.ndarray, list[np.ndarray]]:
    """(places, words): the shard's suffixes that begin with a seed, in lexical order of their first k words.

    The order is that of word hashes, words beyond the text's end are zero; a suffix without a
    seed can match nothing asked, so leaving it out changes no answer.
    """
    wanted = np.zeros(len(h), bool)
    for width, bits in enumerate(asked.seeds):
        if width and len(bits) and len(h) >= width:
            seed = _seed_bits(h, width)
            known = (bits[seed >> 3] >> (seed & 7).astype(np.uint8)) & 1
            wanted[: len(seed)] |= known.astype(bool) & (left[: len(seed)] >= width)
    at = np.flatnonzero(wanted)
    columns = [np.where(left[at] > j, h[np.minimum(at + j, len(h) - 1)], np.uint64(0)) for j in range(k)]
    order = np.lexsort(columns[::-1]) if len(at) else at
    return at[order], [c[order] for c in columns]


def find(columns: list[np.ndarray], asked: Suffixes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, low, high): the suffixes asked that occur, each with its range of the shard's array.

    One word after another narrows the range of each suffix by binary search.
    """
    word = asked.h[asked.at]
    low, high = np.searchsorted(columns[0], word, "left"), np.searchsorted(columns[0], word, "right")
    row = np.flatnonzero(low < high)
    low, high = low[row], high[row]
    for j in range(1, len(columns)):
        deep = np.flatnonzero(asked.depth[row] > j)
        if not len(deep):
            break
        column, word = columns[j], asked.h[asked.at[row[deep]] + j]
        begin = _bisect(low[deep], high[deep], lambda which, at: column[at] < word[which])  # noqa: B023
        high[deep] = _bisect(begin, high[deep], lambda which, at: column[at] <= word[which])  # noqa: B023
        low[deep] = begin
        some = low < high
        row, low, high = row[some], low[some], high[some]
    return row, low, high


@dataclass
class Hits:
    """What a shard's texts share with the benchmark."""

    inside: np.ndarray  # of each word: is it hit
    items: list[set[str]]  # of each text: the ids found
    place: np.ndarray  # word places where a suffix asked begins, and which
    row: np.ndarray


def search(h: np.ndarray, first: np.ndarray, asked: Suffixes, k: int) -> Hits:
    """Hits are as many as the shard's suffixes (times the different depths) at most, however often the benchmark repeats them."""
    none = np.zeros(0, np.int64)
    hits = Hits(np.zeros(len(h), bool), [set() for _ in range(len(first) - 1)], none, none)
    if not len(h) or not len(asked.at):
        return hits
    places, columns = shard_array(h, W.room(first), asked, k)
    if not len(places):
        return hits
    row, low, high = find(columns, asked)
    of, at = _ranges(low, high)
    hits.place, hits.row = places[at], row[of]
    hits.inside = W.covered(hits.place, hits.place + asked.depth[hits.row], len(h))
    doc = np.searchsorted(first, hits.place, "right") - 1
    found = np.unique(doc * len(asked.kin_first) + asked.kin[hits.row])
    doc, kin = found // len(asked.kin_first), found % len(asked.kin_first)
    for d in np.unique(doc):
        texts = np.zeros(len(asked.ids), bool)
        for s in kin[np.searchsorted(doc, d) : np.searchsorted(doc, d, "right")]:
            texts[asked.kin_texts[asked.kin_first[s] : asked.kin_first[s + 1]]] = True
        for t in np.flatnonzero(texts):
            hits.items[d].update(asked.ids[t])
    return hits


def _runs(rows: np.ndarray) -> int:
    """Length of the longest run of rows that are not below zero."""
    ends = np.flatnonzero(np.concatenate([[True], rows < 0, [True]]))
    return int(np.diff(ends).max()) - 1


def _doubled(level: np.ndarray, span: int) -> np.ndarray:
    """Keys of 2 * span rows from keys of span rows; what would pass the end is no key of any run."""
    out = np.full(len(level), _NONE, np.uint64)
    if len(level) > span:
        both = W.finish(level[:-span] * _NONE + W.finish(level[span:] + np.uint64(span)))
        out[:-span] = np.where(level[span:] == _NONE, _NONE, both)
    return out


def _room_at(first: np.ndarray, place: np.ndarray) -> np.ndarray:
    """Words from each place to the end of its text."""
    return first[np.searchsorted(first, place, "right")] - place


def longest(h: np.ndarray, first: np.ndarray, asked: Suffixes, hits: Hits) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(doc place, benchmark place, words) of the matches that can't be extended.

    A match begins where the words before differ, so places are paired only with benchmark places
    that another word precedes: as many pairs as matches, not as places times places. Keys of runs
    of 1, 2, 4, ... rows tell how far a pair goes on.
    """
    if not len(hits.place):
        return (np.zeros(0, np.int64),) * 3
    made = asked.made
    if not made:
        begins = np.isin(asked.where, asked.first[:-1])
        before = np.where(begins, np.uint64(0), asked.h[np.maximum(asked.where.astype(np.int64) - 1, 0)])
        whose = np.repeat(np.arange(len(asked.at)), np.diff(asked.where_first))
        order = np.lexsort((before, ~begins, whose))
        made["where"], made["before"], made["after"] = asked.where[order].astype(np.int64), before[order], ~begins[order]
        rows = np.full(len(asked.h), -1, np.int64)
        rows[asked.where] = whose
        made["levels"] = [W.finish(rows.astype(np.uint64) + np.uint64(3))]
    where, before, after = made["where"], made["before"], made["after"]
    # A place of a text begins one row: the whole of a short text has no other.
    own = np.full(len(h), -2, np.int64)
    deep = asked.depth[hits.row]
    full = deep == deep.max()
    own[hits.place[full]] = hits.row[full]
    levels, run = [W.finish(own.astype(np.uint64) + np.uint64(3))], _runs(own)
    while 1 << len(levels) <= run:
        levels.append(_doubled(levels[-1], 1 << len(levels) - 1))
    while len(made["levels"]) < len(levels):
        made["levels"].append(_doubled(made["levels"][-1], 1 << len(made["levels"]) - 1))
    has_before = ~np.isin(hits.place, first[:-1])
    previous = h[np.maximum(hits.place - 1, 0)]
    low, high = asked.where_first[hits.row], asked.where_first[hits.row + 1]
    # Entries of a row: those that begin a text, then the others by the word before.
    same = _bisect(low, high, lambda i, at: ~after[at] | (before[at] < previous[i]))
    past = _bisect(same, high, lambda i, at: before[at] <= previous[i])
    same, past = np.where(has_before, same, high), np.where(has_before, past, high)
    ends = np.cumsum(same - low + high - past)
    out, at = [], 0
    while at < len(ends):
        to = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + PAIRS, "right")))
        a, i = _ranges(low[at:to], same[at:to])
        b, j = _ranges(past[at:to], high[at:to])
        hit = np.concatenate([a, b]) + at
        place, entry = hits.place[hit], where[np.concatenate([i, j])]
        more = np.zeros(len(hit), np.int64)
        whole = np.flatnonzero(own[place] == hits.row[hit])
        for n in reversed(range(len(levels))):
            p, q = place[whole] + more[whole], entry[whole] + more[whole]
            near = (p < len(h)) & (q < len(asked.h))
            p, q = np.minimum(p, len(h) - 1), np.minimum(q, len(asked.h) - 1)
            more[whole[near & (levels[n][p] == made["levels"][n][q]) & (levels[n][p] != _NONE)]] += 1 << n
        words = asked.depth[hits.row[hit]] + np.maximum(more - 1, 0)
        ahead = np.minimum(_room_at(first, place), _room_at(asked.first, entry))
        out.append((place, entry, np.minimum(words, ahead)))
        at = to
    return tuple(np.concatenate(c) for c in zip(*out, strict=True))


def item_blocks(items: DataFrame, key: str, text: str, block_words: int) -> Iterator[tuple[list[str], list[list[str]]]]:
    """The benchmark's distinct texts with their ids, in blocks of bounded size."""
    content = F.coalesce(F.col(text), F.lit(""))
    texts = items.select(F.coalesce(F.col(key).cast("string"), F.lit("null")).alias("id"), content.alias("text")).filter(
        F.length("text") > 0
    )
    # At least two bytes a word, but for the last.
    total = texts.agg(F.sum(F.floor(F.octet_length("text") / 2) + 1 + F.floor(F.octet_length("id") / 2))).first()[0] or 0
    blocks = max(1, -(-total // block_words))
    for b in range(blocks):
        rows = texts.filter(F.pmod(F.xxhash64("text", "id"), F.lit(blocks)) == b).collect() if total else []
        ids: dict[str, set[str]] = {}
        for row in rows:
            ids.setdefault(row["text"], set()).add(row["id"])
        yield list(ids), [sorted(v) for v in ids.values()]


def _lists(counts: np.ndarray, values: pa.Array) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(counts)]), pa.int32()), values)


def _match_column(h: np.ndarray, first: np.ndarray, asked: Suffixes, hits: Hits) -> pa.ListArray:
    place, entry, length = longest(h, first, asked, hits)
    text = np.searchsorted(asked.first, entry, "right") - 1
    ids_first = np.concatenate([[0], np.cumsum([len(i) for i in asked.ids])]).astype(np.int64)
    of, at = _flat(ids_first, text)  # a text that several ids carry matches for each
    place, entry, length, text = place[of], entry[of], length[of], text[of]
    doc = np.searchsorted(first, place, "right") - 1
    order = np.lexsort((entry, place))
    names = pa.array([i for ids in asked.ids for i in ids], pa.string())
    columns = [
        names.take(pa.array(at[order], pa.int64())),
        pa.array((entry - asked.first[text])[order], pa.int32()),
        pa.array((place - first[doc])[order], pa.int32()),
        pa.array(length[order], pa.int32()),
    ]
    return _lists(np.bincount(doc, minlength=len(first) - 1), pa.StructArray.from_arrays(columns, fields=list(_MATCH)))


def match_benchmark(
    docs: DataFrame,
    items: DataFrame,
    text: str = "text",
    item_key: str = "item_id",
    item_text: str = "text",
    k: int = 10,
    block_words: int = BLOCK_WORDS,
    matches: bool = True,
) -> DataFrame:
    """The columns of `docs` plus n_words, hits, items, n_hit and contaminated, and matches if asked for.

    Each Arrow batch of documents is cut into shards of about 512 KB (`words.SLICE`), each with a
    suffix array over words. It holds only suffixes whose first SEED words hit a seed table of
    2**22 bits of the benchmark (no other can match) and is ordered by their first `k` words;
    every benchmark suffix, cut to `k` words, is binary-searched in every shard. `hits` has the
    runs of words that are inside occurrences (start and end, counted in words from 0, end
    exclusive), n_hit their number of words, `items` the sorted ids whose windows occur. Ranges of
    the array are marked as they are: a word repeated in a document and in an item costs the sum of
    both numbers, not the product.

    A match is a run of at least `k` words, or a whole item of fewer, that can't be extended;
    `matches` has its item, both places and its length. There are as many as places times benchmark
    places that different words precede, so ask for them only where they are wanted.

    The benchmark is searched in blocks of about `block_words` words, so what is
    broadcast is bounded and every row meets the whole benchmark; documents are never shuffled.

    Words are `[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+` after lower-casing A-Z. A null or empty text has
    no words and no matches, an item without words occurs nowhere, items of one id count once,
    a null id is `null`. Repeated rows are judged alike; an empty table gives no rows. Columns
    of `docs` with the names of results are replaced.
    """
    results = ("n_words", "hits", "items", "matches", "n_hit", "contaminated")
    kept = [c for c in docs.columns if c not in results]
    rows = docs.select(*[F.col(f"`{c}`") for c in kept])
    place = kept.index(text)
    added = f"n_words long, hits array<{SPAN}>, items array<string>" + (f", matches array<{MATCH}>" if matches else "")
    schema = T.StructType([*rows.schema.fields, *T.StructType.fromDDL(added).fields])
    begun = False
    for texts, ids in item_blocks(items, item_key, item_text, block_words):
        asked = docs.sparkSession.sparkContext.broadcast(suffixes(texts, ids, k))

        def scan(batches, asked=asked, begun=begun):
            for batch in batches:
                for part in W.text_slices(batch, place):
                    values, offsets = W.raw(part.column(place))
                    starts, ends, first = W.places(values, offsets, W.LETTERS)
                    h = W.hashed(values, starts, ends, fold=True)
                    found = search(h, first, asked.value, k)
                    if begun:  # what earlier blocks found
                        before = part.column("hits")
                        shift = np.repeat(first[:-1], before.value_lengths().to_numpy())
                        start, end = (c.to_numpy().astype(np.int64) + shift for c in before.flatten().flatten())
                        found.inside |= W.covered(start, end, len(h))
                        for own, earlier in zip(found.items, part.column("items").to_pylist(), strict=True):
                            own.update(earlier)
                    start, end, begins = _spans(found.inside, first)
                    shift = np.repeat(first[:-1], np.diff(begins))
                    spans = [pa.array(start - shift, pa.int32()), pa.array(end - shift, pa.int32())]
                    columns = [part.column(i) for i in range(len(kept))]
                    columns += [
                        pa.array(np.diff(first)),
                        _lists(np.diff(begins), pa.StructArray.from_arrays(spans, fields=list(_SPAN))),
                        pa.array([sorted(i) for i in found.items], pa.list_(pa.string())),
                    ]
                    if matches:
                        column = _match_column(h, first, asked.value, found)
                        columns.append(_joined(part.column("matches"), column) if begun else column)
                    yield pa.RecordBatch.from_arrays(columns, schema.names)

        rows, begun = rows.mapInArrow(scan, schema), True
    return rows.withColumn("n_hit", words_hit(F.col("hits"))).withColumn("contaminated", F.col("n_hit") > 0)


def _spans(inside: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(starts, ends, begins): the runs of true places within texts; text i has runs begins[i] to begins[i + 1] - 1."""
    edge = np.zeros(len(inside) + 1, bool)
    edge[first] = True
    opens, closes = inside.copy(), inside.copy()
    opens[1:] &= ~inside[:-1] | edge[1:-1]
    closes[:-1] &= ~inside[1:] | edge[1:-1]
    starts = np.flatnonzero(opens)
    return starts, np.flatnonzero(closes) + 1, np.searchsorted(starts, first)


def _joined(a: pa.ListArray, b: pa.ListArray) -> pa.ListArray:
    """List by list, what a holds and then what b holds."""
    na, nb = a.value_lengths().to_numpy().astype(np.int64), b.value_lengths().to_numpy().astype(np.int64)
    owner = np.concatenate([np.repeat(np.arange(len(a)), na), np.repeat(np.arange(len(b)), nb)])
    values = pa.concat_arrays([a.flatten(), b.flatten()])
    return _lists(na + nb, values.take(pa.array(np.argsort(owner, kind="stable"), pa.int64())))


def words_hit(hits: Column) -> Column:
    """Number of words inside runs that don't overlap."""
    return F.aggregate(hits, F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])


def items_found(matches: Column) -> Column:
    """The distinct ids of the items with a match, sorted as strings."""
    return F.array_sort(F.array_distinct(F.transform(matches, lambda m: m["item_id"])))
