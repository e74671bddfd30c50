"""Exact and near duplicates, repeated lines."""

from __future__ import annotations

import sys
from collections.abc import Iterator
from hashlib import md5

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corploom.functions import text as tx
from corploom.operators.bitfilter import bit_table, bits_for, join_hits, may_hold
from corploom.operators.components import components, connected
from corploom.operators.lookup import BROADCAST_ROWS, lookup, settled

# Functions of this module travel to the workers whole, so these need no copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def flag_exact(df: DataFrame, text: Column, row_id: str, out: str = "duplicate") -> DataFrame:
    """Flag every row whose text already occurs under a lower `row_id`.

    The first id per hash comes from a pre-aggregated groupBy and is joined back
    on the unique id, so a text copied into a third of all rows loads no single task.
    """
    firsts = (
        df.groupBy(tx.text_hash(text).alias("_hash"))
        .agg(F.min(row_id).alias(row_id))
        .select(row_id, F.lit(False).alias(out))
    )
    return df.join(firsts, row_id, "left").withColumn(out, F.coalesce(F.col(out), F.lit(True)))


def keep_last_by_key(df: DataFrame, key: str, seq: str, payload: list[str]) -> DataFrame:
    """One row per key: the payload of the highest `seq`, at the position of the lowest.

    Positions come from a pre-aggregated groupBy; the payload itself moves once,
    on the unique `seq`.
    """
    ends = df.filter(F.coalesce(F.col(key), F.lit("")) != "").groupBy(key).agg(
        F.max(seq).alias(seq), F.min(seq).alias("pos")
    )
    return ends.select(seq, "pos").join(df.select(key, seq, *payload), seq).select(key, "pos", *payload)


def exploded_lines(df: DataFrame, text: str, *keep: str) -> DataFrame:
    return (
        df.select(*keep, F.posexplode(tx.lines(F.col(text))).alias("pos", "line"))
        .withColumn("line", F.trim("line"))
        .filter(F.length("line") > 0)
    )


def repeated_lines(df: DataFrame, text: str, row_id: str, at_least: int = 2) -> DataFrame:
    """Lines seen more than once, with the number of occurrences."""
    return exploded_lines(df, text, row_id).groupBy("line").agg(F.count("*").alias("n")).filter(F.col("n") >= at_least)


def drop_boilerplate(df: DataFrame, text: str, row_id: str, at_least: int) -> DataFrame:
    """Text without the lines that occur at least `at_least` times in the corpus.

    Lines travel as hashes. A boilerplate line is by nature a hot key, hence the
    split look-up instead of a plain anti-join. Only the places of dropped lines are
    gathered per row and applied where the text lies; only texts with a hit are shuffled; every
    row keeps its row.
    """
    rows = exploded_lines(df, text, row_id).select(row_id, "pos", F.md5("line").alias("line_hash"))
    frequent = rows.groupBy("line_hash").agg(F.count("*").alias("n")).filter(F.col("n") >= at_least)
    flagged = lookup(
        rows, frequent.withColumn("boilerplate", F.lit(True)), "line_hash", F.concat_ws(":", row_id, "pos"), "n"
    )
    hits = settled(flagged.filter("boilerplate").groupBy(row_id).agg(F.collect_set("pos").alias("_dropped")))
    trimmed = F.transform(tx.lines(F.col(text)), lambda line: F.trim(line))
    kept = F.filter(trimmed, lambda line, i: (F.length(line) > 0) & ~F.array_contains(F.col("_places"), i))
    return (
        join_hits(df.select(row_id, text), hits, row_id)
        .withColumn("_places", F.coalesce("_dropped", F.array().cast("array<int>")))
        .select(
            row_id,
            F.coalesce(F.array_join(kept, "\n"), F.lit("")).alias("text_kept"),
            F.size("_places").cast("long").alias("lines_dropped"),
        )
    )


# Multipliers and offsets of the min-hash family, from a linear congruential rule.
PRIME = (1 << 31) - 1
# Shingles that a worker takes to their minima at once.
_SLICE = 1 << 16
# Rows and shingles of a band up to which one task finishes what its first leader left; of a longer one, those that lead a round.
BAND_ROWS, BAND_VALUES = 4000, 1 << 20
# Rows that meet one copy of their leader's text.
LEADER_ROWS = 1000
# What bytes, their places in a word and the places of words in a shingle are multiplied with.
_BYTES = np.random.default_rng(20240101).integers(1, 1 << 63, 256, dtype=np.uint64)
_BASE, _STEP = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)


def hash_family(n: int) -> list[tuple[int, int]]:
    state, pairs = 20240101, []
    for _ in range(n):
        pair = []
        for _ in range(2):
            state = (state * 48271) % PRIME
            pair.append(state)
        pairs.append((pair[0], pair[1]))
    return pairs


def _shingle_hashes(joined: str, width: int) -> np.ndarray:
    """The first 64 bits of the md5 of each shingle of a text whose words are joined by one space."""
    raw = joined.encode()
    spaces = np.flatnonzero(np.frombuffer(raw, np.uint8) == 32)
    starts, ends = [0, *(spaces + 1).tolist()], [*spaces.tolist(), len(raw)]
    if len(starts) < width:
        starts, ends = starts[:1], ends[-1:]
    places = zip(starts, ends[width - 1 :] if len(starts) >= width else ends)
    return np.frombuffer(b"".join([md5(raw[i:j]).digest()[:8] for i, j in places]), ">u8").astype(np.uint64)


def _powers(base: np.uint64, n: int) -> np.ndarray:
    out = np.full(n, base)
    out[0] = 1
    return np.multiply.accumulate(out)


def _mixed(h: np.ndarray) -> np.ndarray:
    """Spread every bit of a hash over all others."""
    for shift, factor in ((31, 0x7FB5D329728EA185), (27, 0x81DADEF4BC2DD44D)):
        h = (h ^ (h >> np.uint64(shift))) * np.uint64(factor)
    return h ^ (h >> np.uint64(33))


def _shingle_set(joined: str, width: int) -> np.ndarray:
    """The different shingles of a text whose words are joined by one space, as sorted 64-bit hashes, without an object per word."""
    raw = np.frombuffer(joined.encode(), np.uint8)
    spaces = np.flatnonzero(raw == 32)
    starts, ends = np.concatenate(([0], spaces + 1)), np.concatenate((spaces, [len(raw)]))
    words = np.empty(len(starts), np.uint64)
    for at in range(0, len(starts), _SLICE):
        first, last = starts[at : at + _SLICE], ends[at : at + _SLICE]
        sizes = last - first
        piece = raw[first[0] : last[-1]]
        letters = _BYTES[piece[piece != 32]]
        firsts = np.cumsum(sizes) - sizes
        letters *= _powers(_BASE, sizes.max())[np.arange(len(letters)) - np.repeat(firsts, sizes)]
        words[at : at + _SLICE] = _mixed(np.add.reduceat(letters, firsts))
    width = min(width, len(words))
    runs = np.zeros(len(words) - width + 1, np.uint64)
    for i, factor in enumerate(_powers(_STEP, width)):
        runs += words[i : i + len(runs)] * factor
    return np.unique(_mixed(runs))


def _minima(hashes: np.ndarray, firsts: list[int], family: list[tuple[int, int]]) -> np.ndarray:
    """One row per text, whose hashes begin at `firsts`: the least value under each function of the family."""
    prime = np.uint64(PRIME)
    h = hashes >> np.uint64(32)
    h -= h // prime * prime
    least = np.empty((len(firsts), len(family)), np.uint32)
    for i, (a, b) in enumerate(family):
        x = h * np.uint64(a) + np.uint64(b)
        x -= x // prime * prime
        least[:, i] = np.minimum.reduceat(x, firsts)
    return least


def minhash_signatures(
    df: DataFrame, keys: list[str], text: str, bands: int, rows: int, width: int, with_sets: bool = False, with_digests: bool = False
) -> DataFrame:
    """(keys..., band_keys): `bands * rows` minima per row in one pass over the texts, without a shuffle.

    `with_sets` adds `set`, the different shingles of the row as 64-bit hashes; `with_digests` only their number,
    `values`, and a `digest` of 64 bits that equal sets share. A text without words gives no row.
    """
    family = hash_family(bands * rows)
    schema = T.StructType([*df.select(*keys).schema.fields, T.StructField("band_keys", T.ArrayType(T.StringType()))])
    if with_sets:
        schema.add("set", T.ArrayType(T.LongType()))
    if with_digests:
        schema.add("values", T.LongType()).add("digest", T.LongType())

    def signed(batch: pa.RecordBatch, places: list[int], hashes: list[np.ndarray]) -> pa.RecordBatch:
        firsts = np.cumsum([0, *[len(h) for h in hashes[:-1]]]).tolist()
        least = _minima(np.concatenate(hashes), firsts, family)
        found = [[md5(b"%d:" % b + m[b * rows : (b + 1) * rows].tobytes()).hexdigest() for b in range(bands)] for m in least]
        columns = [batch.column(i).take(pa.array(places)) for i in range(len(keys))]
        columns.append(pa.array(found, pa.list_(pa.string())))
        if with_sets:
            sets = [np.unique(h).view(np.int64) for h in hashes]
            ends = np.cumsum([0, *[len(s) for s in sets]])
            columns.append(pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.concatenate(sets))))
        if with_digests:
            sets = [np.unique(h) for h in hashes]
            columns.append(pa.array([len(s) for s in sets], pa.int64()))
            columns.append(pa.array([int.from_bytes(md5(s.tobytes()).digest()[:8], "big", signed=True) for s in sets], pa.int64()))
        return pa.RecordBatch.from_arrays(columns, schema.names)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            places, hashes, held = [], [], 0
            for place, joined in enumerate(batch.column(len(keys))):
                if not (value := joined.as_py()):
                    continue
                places.append(place)
                hashes.append(_shingle_hashes(value, width))
                held += len(hashes[-1])
                if held >= _SLICE:
                    yield signed(batch, places, hashes)
                    places, hashes, held = [], [], 0
            if places:
                yield signed(batch, places, hashes)

    return df.select(*keys, tx.joined_words(F.col(text))).mapInArrow(scan, schema)


def near_duplicates(
    df: DataFrame, text: str, row_id: str, source: str, bands: int = 5, rows: int = 8, width: int = 3
) -> DataFrame:
    """Near-duplicate groups: rows that share a min-hash band, taken transitively.

    Each removed row names the row it duplicates (lowest id of its group) and that
    row's source. No pairs are formed: a row links to its bands, and labels spread
    over that two-sided graph.
    """
    signed = settled(
        minhash_signatures(df, [row_id, source], text, bands, rows, width).select(
            row_id, source, "band_keys", F.md5(F.array_join("band_keys", "")).alias("signature")
        )
    )
    # 1. Rows with one signature share every band: one of them stands for all.
    firsts = settled(signed.groupBy("signature").agg(F.min(row_id).alias("first_id"), F.count("*").alias("_n")))
    heads = signed.join(firsts.select(F.col("first_id").alias(row_id)), row_id, "left_semi")
    labels = connected(heads.select(row_id, F.explode("band_keys").alias("band_key")), row_id, "band_key")
    # 2. Back from the heads to all rows, on the signature.
    head_labels = firsts.join(labels.withColumnRenamed(row_id, "first_id"), "first_id")
    narrow = signed.select(row_id, source, "signature")
    placed = settled(lookup(narrow, head_labels.select("signature", "label", "_n"), "signature", F.col(row_id), "_n"))
    sizes = placed.groupBy("label").agg(F.count("*").alias("group_size")).filter("group_size > 1")
    kept = narrow.select(F.col(row_id).alias("label"), F.col(source).alias("kept_source"))
    group = sizes.join(kept, "label").withColumn("_n", F.col("group_size"))
    return (
        lookup(placed.select(row_id, source, "label"), group, "label", F.col(row_id), "_n")
        .filter(F.col("group_size").isNotNull())
        .select(
            row_id,
            source,
            (F.col(row_id) != F.col("label")).alias("removed"),
            F.col("label").alias("removed_by"),
            F.col("kept_source").alias("removed_source"),
            "group_size",
        )
    )


def _settled_round(df: DataFrame) -> DataFrame:
    """A settled table of one of many rounds. A checkpoint keeps the planner's estimate of its size, a product over the
    joins before it: carried from round to round, its digits and the driver's time double with each. So it is left behind."""
    kept = settled(df)._jdf
    return DataFrame(df.sparkSession._jsparkSession.createDataFrame(kept.toJavaRDD(), kept.schema()), df.sparkSession)


def _texts_of(texts: DataFrame, listed: DataFrame, key: str, n: int) -> DataFrame:
    """The words of each row that `listed` (settled or narrow, at most `n` rows) names by `key`; only these texts leave the scan."""
    row_id, text = texts.columns
    listed = listed.withColumnRenamed(key, row_id)
    if n <= BROADCAST_ROWS:
        met = texts.join(F.broadcast(listed), row_id)
    else:
        hashes = settled(listed.select(F.xxhash64(row_id).alias("_h")))
        bits = bits_for(hashes)
        met = texts.filter(may_hold(bit_table(hashes, "_h", bits), F.xxhash64(row_id), bits)).join(listed, row_id)
    return met.select(*listed.columns, tx.joined_words(F.col(text)).alias("words")).withColumnRenamed(row_id, key)


def _judged(texts: DataFrame, pairs: DataFrame, n: int, least: float, width: int) -> DataFrame:
    """(row_id, leader, similarity) of the different pairs (row_id, leader), at most `n`, that are similar enough.

    Texts travel, not sets, which are longer: a row's once a pair, a leader's once for each LEADER_ROWS of its rows.
    """
    row_id = texts.columns[0]
    load = pairs.groupBy("leader").agg(F.count("*").alias("_n")).withColumn("slices", F.ceil(F.col("_n") / LEADER_ROWS))
    placed = lookup(pairs, load, "leader", F.col(row_id), "_n").select(
        row_id, "leader", F.pmod(F.xxhash64(row_id, "leader"), "slices").alias("slice")
    )
    copies = load.select("leader", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("slices") - 1)).alias("slice"))
    leading = _texts_of(texts, copies, "leader", n).withColumnRenamed("words", "leader_words")
    both = _texts_of(texts, placed, row_id, n).join(leading, ["leader", "slice"])
    schema = T.StructType([*both.select(row_id, "leader").schema.fields, T.StructField("similarity", T.DoubleType())])

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, own = "", None
        for batch in batches:
            places, scores = [], []
            for place in range(batch.num_rows):
                words, other = batch.column(2)[place].as_py(), batch.column(3)[place].as_py()
                if not (words and other):
                    continue
                if other != held:
                    held, own = other, _shingle_set(other, width)
                values = _shingle_set(words, width)
                inner = int((own[np.minimum(np.searchsorted(own, values), len(own) - 1)] == values).sum())
                if (score := inner / (len(values) + len(own) - inner)) >= least:
                    places.append(place)
                    scores.append(score)
            taken = pa.array(places, pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(0).take(taken), batch.column(1).take(taken), pa.array(scores, pa.float64())], schema.names)

    return both.select(row_id, "leader", "words", "leader_words").mapInArrow(judge, schema)


def _different_bands(rows: DataFrame, row_id: str) -> DataFrame:
    """`rows` (settled, different in `row_id` and band) without the bands of one row and those that hold the rows of another: these give the same links.

    A band's rows are told by their number, their lowest and two 64-bit sums of hashes.
    """
    sums = [F.bit_xor(F.xxhash64(F.lit(i), row_id)).alias(f"_sum{i}") for i in range(2)]
    held = rows.groupBy("band").agg(F.count("*").alias("_n"), F.min(row_id).alias("_low"), *sums).filter("_n > 1")
    one = held.groupBy("_n", "_low", "_sum0", "_sum1").agg(F.min("band").alias("band")).select("band", "_n", F.lit(True).alias("_one"))
    return lookup(rows, one, "band", F.col(row_id), "_n").filter("_one").drop("_one")


def _fits(least: float, *spans: tuple[str, str]) -> Column:
    """Whether sets of these spans of sizes (least, most) can be similar enough; the smaller may lie in the larger."""
    (low, high), (other_low, other_high) = spans
    return F.least(high, other_high) / F.greatest(low, other_low) >= least


def _parted_by_size(rows: DataFrame, row_id: str, least: float) -> DataFrame:
    """Short bands cut where the next larger set is too large for all smaller ones: no pair across the cut can be similar enough."""
    below = Window.partitionBy("band").orderBy("low", row_id)
    before = F.max("high").over(below.rowsBetween(Window.unboundedPreceding, -1))
    cut = rows.withColumn("_cut", F.coalesce((before / F.col("low") < least).cast("int"), F.lit(0)))
    return cut.select(row_id, F.xxhash64("band", F.sum("_cut").over(below)).alias("band"))


def _led_by_lowest(texts: DataFrame, left: DataFrame, least: float, width: int) -> tuple[DataFrame, DataFrame]:
    """(links, rest) of bands (row_id, low, high, band): each row against the lowest of its band."""
    row_id = texts.columns[0]
    first = F.min(F.struct(row_id, "low", "high"))
    leaders = left.groupBy("band").agg(first.alias("_first"), F.count("*").alias("_n")).filter("_n > 1")
    leaders = leaders.select("band", "_n", F.col(f"_first.{row_id}").alias("leader"), F.col("_first.low").alias("_low"), F.col("_first.high").alias("_high"))
    asked = lookup(left, leaders, "band", F.col(row_id), "_n").filter(F.col("leader").isNotNull() & (F.col(row_id) != F.col("leader")))
    asked = _settled_round(asked.withColumn("_fits", _fits(least, ("low", "high"), ("_low", "_high"))).drop("_low", "_high"))
    pairs = asked.filter("_fits").select(row_id, "leader").distinct()
    links = _settled_round(_judged(texts, pairs, asked.filter("_fits").count(), least, width))
    rest = asked.join(links.select(row_id, "leader"), [row_id, "leader"], "left_anti").select(*left.columns)
    return links, _settled_round(rest)


def _led_by_blocks(texts: DataFrame, left: DataFrame, least: float, width: int) -> tuple[DataFrame, DataFrame]:
    """(links, rest) of long bands (row_id, low, high, band): each row against the lowest of its band, as many as a task takes.

    The others of a band are dealt over as many tasks as they ask for, each with a copy of these lowest rows.
    """
    row_id = texts.columns[0]
    order = Window.partitionBy("band").orderBy(row_id)
    lowest = left.withColumn("_rank", F.row_number().over(order)).filter(F.col("_rank") <= BAND_ROWS)
    lowest = lowest.withColumn("_values", F.sum("high").over(order)).filter((F.col("_rank") == 1) | (F.col("_values") <= BAND_VALUES))
    others = left.join(lowest.select(row_id, "band"), [row_id, "band"], "left_anti")
    slices = F.ceil(F.greatest(F.count("*") / BAND_ROWS, F.sum("high") / BAND_VALUES))
    sizes = others.groupBy("band").agg(F.count("*").alias("_n"), slices.alias("slices"))
    dealt = lookup(others, sizes, "band", F.col(row_id), "_n").withColumn("slice", F.pmod(F.xxhash64(row_id, "band"), "slices"))
    copies = lowest.select(*left.columns).join(sizes.drop("_n"), "band").withColumn("slice", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("slices") - 1)))
    columns = [*left.columns, "slice"]
    asked = _settled_round(dealt.select(*columns, F.lit(0).alias("leads")).unionByName(copies.select(*columns, F.lit(1).alias("leads"))))
    links = _settled_round(_within_bands(_texts_of(texts, asked.drop("low", "high"), row_id, asked.count()), row_id, least, width))
    rest = asked.filter("leads = 0").join(links.select(row_id, "band"), [row_id, "band"], "left_anti").select(*left.columns)
    return links.drop("band"), _settled_round(rest)


def _within_bands(rows: DataFrame, row_id: str, least: float, width: int) -> DataFrame:
    """(row_id, leader, similarity, band) for the rows (row_id, band, slice, leads, words) of each band and slice: the lowest row
    left leads, as long as it is one that `leads`; these are the lowest of all."""
    kind = rows.schema[row_id].dataType.simpleString()

    def finish(band: pa.Table) -> pa.Table:
        band = band.filter(pc.fill_null(pc.not_equal(band.column("words"), ""), False)).sort_by([("leads", "descending"), (row_id, "ascending")])
        sets = [_shingle_set(words.as_py(), width) for words in band.column("words")]
        sizes = np.array([len(s) for s in sets], np.int64)
        values = np.concatenate([*sets, np.empty(0, np.uint64)])
        order = np.argsort(values)
        values, holders = values[order], np.repeat(np.arange(len(sets)), sizes)[order]
        left = np.ones(len(sets), bool)
        led, leaders, scores = [np.arange(0)], [np.arange(0)], [np.empty(0)]
        for head in range(int(pc.sum(band.column("leads")).as_py() or 0)):
            if not left[head]:
                continue
            left[head] = False
            begin, end = (np.searchsorted(values, sets[head], side) for side in ("left", "right"))
            many = end - begin
            met = holders[np.repeat(end - np.cumsum(many), many) + np.arange(many.sum())]
            inner = np.bincount(met, minlength=len(sets))
            score = inner / (sizes + sizes[head] - inner)
            linked = np.flatnonzero(left & (score >= least))
            left[linked] = False
            led.append(linked)
            leaders.append(np.full(len(linked), head))
            scores.append(score[linked])
        places = np.concatenate(led)
        columns = [band.column(row_id).take(pa.array(at)) for at in (places, np.concatenate(leaders))]
        columns += [pa.array(np.concatenate(scores)), band.column("band").take(pa.array(places))]
        return pa.table(columns, [row_id, "leader", "similarity", "band"])

    return rows.groupBy("band", "slice").applyInArrow(finish, f"{row_id} {kind}, leader {kind}, similarity double, band bigint")


def verified_duplicates(
    df: DataFrame, text: str, row_id: str, source: str, least: float = 0.8, bands: int = 20, rows: int = 5, width: int = 5
) -> DataFrame:
    """Groups of rows linked by verified similarity: sets of word shingles with Jaccard of at least `least`.

    A min-hash band only proposes. The rows of a band are compared with its lowest row; those
    that are not similar enough form the band's next group, until none is left, so each row is
    tied to the first leader it is verified against and no pairs within a group are formed. After a band's
    first leader, one task finishes it if it has few rows left; in a longer one as many of the lowest rows as a task takes lead
    the next round over all tasks. Rows with one and the same set are one row there. Groups are connected by these links; each removed row
    names the lowest row of its group, that row's source, and `similarity`, the highest of its own verified links
    (1 for equal sets; of links to rows it leads, if it has no leader).

    A pair at similarity s meets in a band with 1 - (1 - s**rows)**bands (0.9996 at 0.8). Rows without words
    are in no group. A row in no group of two or more is left out.

    Shingles are never kept or shuffled: they take several times the room of their text. Signatures, sizes and ids tell which
    pairs to compare, and the texts of these alone travel, once a pair. Bands that hold the same rows are one band.
    """
    signed = minhash_signatures(df, [row_id, source], text, bands, rows, width, False, True)
    signed = settled(signed.select(row_id, source, "digest", "values", F.transform("band_keys", lambda b: F.xxhash64(b)).alias("bands")))
    texts = df.select(row_id, text)
    # 1. Rows with equal sets: the lowest stands for all.
    firsts = settled(signed.groupBy("digest").agg(F.min(row_id).alias("head"), F.count("*").alias("_n")))
    heads = firsts.select(F.col("head").alias(row_id))
    # 2. Groups of heads by band; a band of one row proposes nothing. An id that comes again has the bands of all its texts.
    spans = [F.min("values").alias("low"), F.max("values").alias("high")]
    whole = signed.join(heads, row_id, "left_semi").groupBy(row_id).agg(*spans, F.flatten(F.collect_list("bands")).alias("bands"))
    placed = whole.select(row_id, "low", "high", F.explode(F.array_distinct("bands")).alias("band"))
    shared = placed.groupBy("band").agg(F.count("*").alias("_n")).filter("_n > 1").withColumn("_shared", F.lit(True))
    left = settled(lookup(placed, shared, "band", F.col(row_id), "_n").filter("_shared").drop("_shared"))
    left = settled(_different_bands(left, row_id))
    links = short = None
    while left.limit(1).count():
        led = _led_by_lowest if links is None else _led_by_blocks
        found, rest = led(texts, left, least, width)
        links = found if links is None else links.unionByName(found)
        load = rest.groupBy("band").agg(F.count("*").alias("_n"), F.sum("high").alias("_values")).filter("_n > 1")
        few = load.select("band", "_n", ((F.col("_n") <= BAND_ROWS) & (F.col("_values") <= BAND_VALUES)).alias("_few"))
        marked = lookup(rest, few, "band", F.col(row_id), "_n").filter(F.col("_few").isNotNull())
        ending = marked.filter("_few").drop("_few")
        short = ending if short is None else short.unionByName(ending)
        left = marked.filter("not _few").drop("_few")
    if links is None:
        links = pairs_of_none(df, row_id)
    else:
        short = settled(_different_bands(settled(_parted_by_size(short, row_id, least)), row_id))
        ending = _texts_of(texts, short.select("*", F.lit(0).alias("slice"), F.lit(1).alias("leads")), row_id, short.count())
        links = links.unionByName(_within_bands(ending, row_id, least, width).drop("band"))
    links = settled(links.groupBy(row_id, "leader").agg(F.max("similarity").alias("similarity")))
    # 3. Groups of heads, then of all rows.
    named = components(links, row_id, "leader").withColumnRenamed("id", "head").withColumnRenamed("label", "group")
    ends = links.select(F.col(row_id).alias("head"), "similarity").unionByName(links.select(F.col("leader").alias("head"), "similarity"))
    best = ends.groupBy("head").agg(F.max("similarity").alias("similarity"))
    grouped = firsts.join(named.join(best, "head"), "head", "left").withColumn("group", F.coalesce("group", "head"))
    narrow = signed.select(row_id, source, "digest")
    rows_ = lookup(narrow, grouped.select("digest", "group", F.col("similarity").alias("linked"), "_n", (F.col("_n") > 1).alias("copied")), "digest", F.col(row_id), "_n")
    sized = settled(rows_)
    sizes = sized.groupBy("group").agg(F.count("*").alias("group_size")).filter("group_size > 1")
    kept = narrow.select(F.col(row_id).alias("group"), F.col(source).alias("kept_source"))
    whole = lookup(sized, sizes.join(kept, "group").withColumn("_uses", F.col("group_size")), "group", F.col(row_id), "_uses")
    return whole.filter(F.col("group_size").isNotNull()).select(
        row_id,
        source,
        (F.col(row_id) != F.col("group")).alias("removed"),
        F.col("group").alias("removed_by"),
        F.col("kept_source").alias("removed_source"),
        F.when(F.col("copied"), 1.0).otherwise(F.col("linked")).alias("similarity"),
        "group_size",
    )


def pairs_of_none(df: DataFrame, row_id: str) -> DataFrame:
    kind = df.schema[row_id].dataType.simpleString()
    return df.sparkSession.createDataFrame([], f"{row_id} {kind}, leader {kind}, similarity double")
