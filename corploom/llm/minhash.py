"""Near duplicates by HyperMinHash registers: banded, estimated, then confirmed on full shingle sets."""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corploom.llm import words as W
from corploom.llm.ranges import KEY_BITS, bit_filter, passes
from corploom.llm.shared import settled
from corploom.operators.components import components

# At similarity 0.8 a pair shares none of 40 bands of 5 registers with a chance of 1.3e-7.
BANDS, ROWS = 40, 5
MANTISSA = 10
# Pairs whose estimate is this far below the threshold (7 standard errors) aren't confirmed.
MARGIN = 0.2
# Sets on each side of a block that is compared in full.
BLOCK_SETS = 1000
_TEXT_SLICE = 1 << 18
_SET_ROWS = 4096

_generator = np.random.default_rng(9)
_SEEDS = _generator.integers(1, 1 << 32, BANDS * ROWS, dtype=np.uint32)
_ODD = _generator.integers(1, 1 << 31, BANDS * ROWS, dtype=np.uint32) * np.uint32(2) + np.uint32(1)


def shingle_sets(batch: pa.RecordBatch, column: int, width: int) -> Iterator[np.ndarray]:
    """The sorted distinct shingle hashes of each text."""
    values, offsets = W.raw(batch.column(column))
    starts, ends, first = W.places(values, offsets, W.SPACED)
    h = W.hashed(values, starts, ends, fold=True)
    by_length = {k: W.windows(h, k) for k in {min(width, n) for n in np.diff(first).tolist()} if k}
    for a, b in zip(first[:-1], first[1:], strict=True):
        k = min(width, b - a)
        yield np.unique(by_length[k][a : b - k + 1]) if k else np.empty(0, np.uint64)


def registers(shingles: np.ndarray) -> np.ndarray:
    """One 16-bit register per bucket: leading zeros of the least hash, then its next mantissa bits.

    Each bucket has a permutation of its own, so short texts fill all buckets too.
    """
    x = (shingles >> np.uint64(32)).astype(np.uint32)
    least = np.full(len(_SEEDS), 0xFFFFFFFF, np.uint32)
    for at in range(0, len(x), _SET_ROWS):
        block = x[at : at + _SET_ROWS, None] ^ _SEEDS
        block *= _ODD
        np.minimum(least, block.min(axis=0), out=least)
    zeros = 32 - np.frexp(least.astype(np.float64))[1].astype(np.int64)
    mantissa = ((least.astype(np.uint64) << (zeros + 1).astype(np.uint64)) & np.uint64(0xFFFFFFFF)) >> np.uint64(32 - MANTISSA)
    return ((zeros.astype(np.uint64) << np.uint64(MANTISSA)) | mantissa).astype(np.uint16)


def set_number(shingles: np.ndarray) -> int:
    return int.from_bytes(blake2b(shingles.tobytes(), digest_size=8).digest(), "little", signed=True)


def sketches(docs: DataFrame, key: str, text: str, width: int) -> DataFrame:
    """(_id, n_shingles, set, registers); a text without words has no set and no registers."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in W.text_slices(batch, 1, _TEXT_SLICE):
                sizes, sets, found = [], [], []
                for s in shingle_sets(part, 1, width):
                    sizes.append(len(s))
                    sets.append(set_number(s) if len(s) else None)
                    found.append(registers(s).tobytes() if len(s) else None)
                columns = [part.column(0), pa.array(sizes, pa.int64()), pa.array(sets, pa.int64()), pa.array(found, pa.binary())]
                yield pa.RecordBatch.from_arrays(columns, ["_id", "n_shingles", "set", "registers"])

    schema = T.StructType([T.StructField("_id", docs.schema[key].dataType), *T.StructType.fromDDL("n_shingles long, set long, registers binary").fields])
    return docs.select(F.col(key).alias("_id"), text).mapInArrow(scan, schema)


def full_sets(docs: DataFrame, text: str, width: int, wanted: Broadcast) -> DataFrame:
    """(set, shingles) of the texts whose set may be wanted, once each."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()  # at most the rows of one partition
        for batch in batches:
            for part in W.text_slices(batch, 0, _TEXT_SLICE):
                numbers, contents = [], []
                for s in shingle_sets(part, 0, width):
                    n = set_number(s)
                    if len(s) and n not in seen and passes(wanted.value, np.array([n], np.int64).view(np.uint64))[0]:
                        seen.add(n)
                        numbers.append(n)
                        contents.append(s.tobytes())
                yield pa.RecordBatch.from_arrays([pa.array(numbers, pa.int64()), pa.array(contents, pa.binary())], ["set", "shingles"])

    return docs.select(text).mapInArrow(scan, "set long, shingles binary").dropDuplicates(["set"])


def chance_equal(n: np.ndarray, m: np.ndarray) -> np.ndarray:
    """Chance that registers of unrelated sets of n and m shingles agree: same leading zeros, same mantissa."""
    zeros = np.arange(33.0)[:, None]
    with np.errstate(divide="ignore"):
        least = lambda k: 1 - np.exp(k * np.log1p(-np.minimum(2.0**-zeros, 1 - 1e-12)))
    cell = lambda k: np.diff(-least(k), axis=0, append=0)
    return (cell(n) * cell(m)).sum(axis=0) * 2.0**-MANTISSA


def estimated(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """`pairs` (a, b) plus the similarity estimated from the registers, corrected for chance agreement."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            x, y = (np.frombuffer(W.raw(batch.column(i))[0], np.uint16).reshape(batch.num_rows, -1) for i in (2, 3))
            agree = (x == y).mean(axis=1)
            n, m = (batch.column(i).to_numpy().astype(float) for i in (4, 5))
            chance = chance_equal(n, m)
            estimate = (agree - chance) / (1 - chance)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(estimate)], ["a", "b", "estimate"])

    side = lambda c: sets.select(F.col("set").alias(c), F.col("registers").alias(f"r{c}"), F.col("n").alias(f"n{c}"))
    both = pairs.select("a", "b").join(side("a"), "a").join(side("b"), "b").select("a", "b", "ra", "rb", "na", "nb")
    return both.mapInArrow(scan, "a long, b long, estimate double")


def confirmed(pairs: DataFrame, docs: DataFrame, text: str, width: int, percent: int) -> DataFrame:
    """The pairs (a, b) with 100 * intersection >= percent * union, on full sets."""
    ends = pairs.select(F.explode(F.array("a", "b")).alias("set")).distinct()
    full = settled(full_sets(docs, text, width, bit_filter(ends, "set", KEY_BITS)))

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            linked = []
            for x, y in zip(batch.column(2), batch.column(3), strict=True):
                s, t = (np.frombuffer(v.as_buffer(), np.uint64) for v in (x, y))
                both = np.sort(np.concatenate([s, t]))
                common = int((both[1:] == both[:-1]).sum())
                linked.append(100 * common >= percent * (len(s) + len(t) - common))
            yield batch.select([0, 1]).filter(pa.array(linked, pa.bool_()))

    side = lambda c: full.select(F.col("set").alias(c), F.col("shingles").alias(f"s{c}"))
    both = pairs.select("a", "b").join(side("a"), "a").join(side("b"), "b").select("a", "b", "sa", "sb")
    return both.mapInArrow(scan, "a long, b long")


def labelled(rows: DataFrame, labels: DataFrame | None, column: str, out: str) -> DataFrame:
    if labels is None:
        return rows.withColumn(out, F.col(column))
    known = labels.select(F.col("id").alias(column), F.col("label").alias(out))
    return rows.join(known, column, "left").withColumn(out, F.coalesce(out, column))


def block_links(rest: list[tuple], others: list[tuple], percent: int) -> list[tuple[int, int]]:
    """For each (set, label, shingles) of `rest`, a linked set of each other label among `others`, on full sets."""
    tokens = np.concatenate([s for _, _, s in others])
    sizes = np.array([len(s) for _, _, s in others])
    labels = np.array([label for _, label, _ in others])
    order = np.argsort(tokens, kind="stable")
    tokens, owner = tokens[order], np.repeat(np.arange(len(others)), sizes)[order]
    found = []
    for number, label, s in rest:
        low, high = np.searchsorted(tokens, s, "left"), np.searchsorted(tokens, s, "right")
        n = high - low
        at = np.repeat(low - (np.cumsum(n) - n), n) + np.arange(n.sum())
        common = np.bincount(owner[at], minlength=len(others))
        linked = np.flatnonzero((100 * common >= percent * (len(s) + sizes - common)) & (labels != label))
        _, first = np.unique(labels[linked], return_index=True)
        found += [(number, others[i][0]) for i in linked[first].tolist()]
    return found


def compared(groups: DataFrame, docs: DataFrame, text: str, width: int, percent: int) -> DataFrame:
    """Links (a, b) between sets of different labels inside each group; `groups` has (hub, set, label).

    A group's sets outside its largest label meet all of its sets, in blocks of at most BLOCK_SETS
    a side, each block a task's unit of work. No pair becomes a row unless it is a link that joins
    two labels, and one link from a set to a label is enough.
    """
    full = settled(full_sets(docs, text, width, bit_filter(groups.select("set").distinct(), "set", KEY_BITS)))
    counts = groups.groupBy("hub", "label").agg(F.count("*").alias("n"))
    main = counts.groupBy("hub").agg(
        F.max_by("label", F.struct("n", "label")).alias("main"), F.sum("n").alias("all"), (F.sum("n") - F.max("n")).alias("rest"),
        F.count("*").alias("labels"),
    ).filter("labels > 1")
    dealt = lambda n: F.pmod(F.xxhash64("set"), F.ceil(F.col(n) / BLOCK_SETS)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), (F.ceil(F.col(n) / BLOCK_SETS) - 1).cast("int")))
    rows = groups.join(main, "hub")
    asked = rows.filter("label <> main").withColumn("i", dealt("rest")).withColumn("j", every("all")).withColumn("asks", F.lit(True))
    others = rows.withColumn("j", dealt("all")).withColumn("i", every("rest")).withColumn("asks", F.lit(False))
    columns = ["hub", "i", "j", "asks", "set", "label"]

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[bool, list[tuple]] = {True: [], False: []}
        block = None

        def done() -> pa.RecordBatch:
            links = block_links(held[True], held[False], percent) if held[True] and held[False] else []
            return pa.RecordBatch.from_arrays([pa.array([x[i] for x in links], pa.int64()) for i in (0, 1)], ["a", "b"])

        for batch in batches:
            for r in batch.to_pylist():
                if (r["hub"], r["i"], r["j"]) != block:
                    yield done()
                    held, block = {True: [], False: []}, (r["hub"], r["i"], r["j"])
                held[r["asks"]].append((r["set"], r["label"], np.frombuffer(r["shingles"], np.uint64)))
        yield done()

    dealt_rows = asked.select(*columns).unionByName(others.select(*columns)).join(full, "set")
    keys = ["hub", "i", "j"]
    return dealt_rows.repartition(*keys).sortWithinPartitions(*keys).select(*columns, "shingles").mapInArrow(scan, "a long, b long")


def linked_sets(docs: DataFrame, sets: DataFrame, text: str, width: int, percent: int) -> DataFrame | None:
    """(id, label) of the sets that have links; None without any.

    The hub of a bucket is its set with most neighbours over all buckets, such as the text that
    others are copies of; a bucket of m sets gives m - 1 pairs with its hub. 1. The best estimated
    pair of each set is confirmed. 2. Buckets that still hold several groups are compared in
    full, by hub, in blocks. Pairs inside one group can't change it, so no link between groups
    is lost, and nothing is capped.
    """
    floor = percent / 100 - MARGIN
    width_bytes = 2 * ROWS
    keys = F.array(*[F.xxhash64(F.lit(i), F.substring("registers", 1 + i * width_bytes, width_bytes)) for i in range(BANDS)])
    bands = sets.select("set", F.explode(keys).alias("band"))
    buckets = bands.groupBy("band").agg(F.count("*").alias("size")).filter("size > 1")
    shared = settled(bands.join(buckets, "band").select("band", "set", "size"))
    known = shared.groupBy("set").agg(F.sum("size").alias("known"))
    hubs = shared.join(known, "set").groupBy("band").agg(F.max_by("set", F.struct("known", "set")).alias("hub"))
    members = settled(shared.join(hubs, "band").select("band", "set", "hub", "size"))
    stars = members.filter("set <> hub").select(F.col("set").alias("a"), F.col("hub").alias("b")).distinct()
    scored = settled(estimated(stars, sets).filter(F.col("estimate") >= floor))
    best = settled(scored.groupBy("a").agg(F.max_by("b", F.struct("estimate", "b")).alias("b")))
    edges = settled(confirmed(best, docs, text, width, percent))
    labels = settled(components(edges, "a", "b"))

    wide = labelled(members.filter("size > 2"), labels, "set", "label")
    mixed = wide.groupBy("band").agg(F.min("label").alias("l1"), F.max("label").alias("l2")).filter("l1 <> l2").select("band")
    open_pairs = scored.select("a", "b").join(best, ["a", "b"], "left_anti").select(F.col("b").alias("hub"), F.col("a").alias("set"))
    loose = wide.join(mixed, "band").select("hub", "set").unionByName(open_pairs).distinct()
    loose = loose.unionByName(loose.select("hub", F.col("hub").alias("set"))).distinct()
    named = labelled(loose, labels, "set", "label")
    several = named.groupBy("hub").agg(F.min("label").alias("l1"), F.max("label").alias("l2")).filter("l1 <> l2").select("hub")
    groups = settled(named.join(several, "hub").select("hub", "set", "label"))
    if not groups.isEmpty():
        more = settled(compared(groups, docs, text, width, percent))
        if not more.isEmpty():
            labels = settled(components(edges.unionByName(more), "a", "b"))
    return labels


def near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text", width: int = 5, percent: int = 80) -> DataFrame:
    """`key`, n_shingles, component_id and kept for every row of `docs`.

    Texts are sets of distinct shingles of `width` words (`[^\\x20\\x09-\\x0D]+`, A-Z lower-cased);
    a text of fewer words is one shingle. Texts with 100 * intersection >= percent * union are
    linked; component_id is the smallest key reachable, kept tells the row that carries it.
    Candidates share a band of registers; a link is confirmed on full sets. A link at the
    threshold is missed with a chance of 1.3e-7 and usually replaced by another way through its
    group.

    A null or empty text, or one without words, is linked with nothing and kept. Equal sets are
    folded before anything is compared. Repeated rows share a component, and rows that share its
    key are all kept; a null key never names a component unless all keys in it are null. An
    empty table gives no rows; other columns are left out.
    """
    rows = settled(sketches(docs.select(key, text), key, text, width))
    sets = settled(rows.filter("n_shingles > 0").groupBy("set").agg(F.first("registers").alias("registers"), F.first("n_shingles").alias("n")))
    labels = linked_sets(docs.select(text), sets, text, width, percent)
    named = labelled(rows.filter("n_shingles > 0").select("_id", "n_shingles", "set"), labels, "set", "label")
    lowest = named.groupBy("label").agg(F.min("_id").alias("component_id"))
    found = named.join(lowest, "label").select("_id", "n_shingles", "component_id")
    alone = rows.filter("n_shingles = 0").select("_id", "n_shingles", F.col("_id").alias("component_id"))
    return found.unionByName(alone).select(
        F.col("_id").alias(key), "n_shingles", "component_id", F.col("_id").eqNullSafe(F.col("component_id")).alias("kept")
    )
