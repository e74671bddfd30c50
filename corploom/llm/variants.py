"""Spelling variants: words one code point apart meet in a dictionary of trie-node pairs."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corploom.llm.shared import settled
from corploom.operators.lookup import lookup

# Letters of a word, and the only ones that are lower-cased.
LETTERS = "A-Za-zÀ-ÿ"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
# One run in so many loses a letter.
SLIP = 97
# Kinds of dictionary entries: a place between two letters, or a skipped letter, which may begin a row of equal letters.
CUT, GAP, GAP_FIRST = 0, 1, 2


def _slipped(key: Column, run: Column) -> Column:
    """The run, or, where 97 divides the crc32 of `<key>:<run>`, the run without the code point at crc32 % length."""
    h = F.crc32(F.concat(F.coalesce(key.cast("string"), F.lit("null")), F.lit(":"), run))
    at = (h % F.length(run)).cast("int")
    return F.when(h % SLIP == 0, F.overlay(run, F.lit(""), at + 1, F.lit(1))).otherwise(run)


def count_words(docs: DataFrame, key: str = "doc_id", text: str = "text", shortest: int = 5, fewest: int = 3) -> DataFrame:
    """(word, n) of the words with at least `shortest` code points and `fewest` occurrences.

    Counts are folded before the shuffle, so no frequent word is hot. A null or empty text has no
    words; a null key is hashed as `null`; rows that repeat count again.
    """
    rows = docs.select(F.col(key).alias("_key"), F.col(text).alias("_text"))
    runs = rows.select("_key", F.explode(F.regexp_extract_all("_text", F.lit(f"([{LETTERS}]{{{shortest},}})"), F.lit(1))).alias("run"))
    # The built-in lower-casing settles most runs; those it changes may hold other capitals, which stay.
    folded = F.when(F.lower("run") == F.col("run"), F.col("run")).otherwise(F.translate("run", UPPER, LOWER))
    words = runs.select("_key", folded.alias("run")).select(_slipped(F.col("_key"), F.col("run")).alias("word"))
    counts = words.filter(F.length("word") >= shortest).groupBy("word").agg(F.count("*").alias("n"))
    return counts.filter(F.col("n") >= fewest)


def _shared(a: str, b: str) -> int:
    """Number of code points that two words share from the start."""
    n = min(len(a), len(b))
    if a[:n] == b[:n]:
        return n
    for i in range(n):
        if a[i] != b[i]:
            return i
    return n


def trie_nodes(words: DataFrame, word: str, longest: int) -> DataFrame:
    """The columns of `words` plus `place`, the word's place in code-point order, and `nodes`.

    `nodes[d]` numbers the trie node of the word's first d code points: equal for two words just if
    they share them. Words are sorted over range partitions, of which each is read as a stream; a
    node is numbered by the place of its first word and its depth, packed into a long, and the root
    is 0. What a partition begins with may lie under nodes of the one before: the driver
    carries the open nodes of each partition's last word to the next, one word a partition.
    """
    rows = settled(words.repartitionByRange(word).sortWithinPartitions(word).withColumn("_part", F.spark_partition_id()))
    at, part_at = rows.columns.index(word), rows.columns.index("_part")
    stride = longest + 1

    def ends(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, first, before, opened, part = 0, None, "", np.zeros(0, np.int64), None
        for batch in batches:
            part = batch.column(part_at)[0].as_py() if batch.num_rows else part
            for this in batch.column(at).to_pylist():
                opened = np.concatenate([opened[: _shared(before, this)], np.full(len(this) - _shared(before, this), n)])
                first, before, n = this if first is None else first, this, n + 1
        if n:
            yield pa.RecordBatch.from_pylist([{"part": part, "n": n, "first": first, "last": before, "opened": opened.tolist()}], schema=_ENDS)

    parts = sorted(rows.mapInArrow(ends, "part int, n long, first string, last string, opened array<long>").collect())
    begins: dict[int, tuple[int, str, np.ndarray]] = {}
    base, before, opened = 0, "", np.zeros(0, np.int64)
    for part in parts:
        begins[part["part"]] = (base, before, opened)
        shared = _shared(before, part["first"])
        own = np.array(part["opened"], np.int64)
        # Nodes opened by the partition's first word are older if that word shares them with the word before.
        older = min(shared, int((own == 0).sum()))
        opened = np.concatenate([opened[:older], own[older:] + base])
        base, before = base + part["n"], part["last"]

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place, before, opened = None, "", np.zeros(0, np.int64)
        for batch in batches:
            if not batch.num_rows:
                continue
            if place is None:
                place, before, opened = begins[batch.column(part_at)[0].as_py()]
            own, from_place = [], place
            for this in batch.column(at).to_pylist():
                shared = _shared(before, this)
                opened = np.concatenate([opened[:shared], np.full(len(this) - shared, place)])
                own += [np.zeros(1, np.int64), opened * stride + np.arange(1, len(this) + 1)]
                before, place = this, place + 1
            sizes = np.cumsum([0, *(len(a) + 1 for a in own[1::2])])
            nodes = pa.ListArray.from_arrays(pa.array(sizes, pa.int32()), pa.array(np.concatenate(own)))
            kept = [c for i, c in enumerate(batch.columns) if i != part_at]
            yield pa.RecordBatch.from_arrays([*kept, pa.array(np.arange(from_place, place)), nodes], names)

    names = [*[c for c in rows.columns if c != "_part"], "place", "nodes"]
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.drop("_part").schema)
    return rows.mapInArrow(number, f"{schema}, place long, nodes array<long>")


_ENDS = pa.schema([("part", pa.int32()), ("n", pa.int64()), ("first", pa.string()), ("last", pa.string()), ("opened", pa.list_(pa.int64()))])


def _dictionary(words: DataFrame) -> DataFrame:
    """(prefix, suffix, n, place, kind): the node pairs of every word, around each letter and between each two."""
    size = F.size("forward")
    letters = F.col("letters")
    kinds = F.transform(letters, lambda x, i: F.when((i > 0) & (F.get(letters, i - 1) == x), GAP).otherwise(GAP_FIRST))
    skipped = F.arrays_zip(
        F.slice("forward", 1, size - 1).alias("prefix"), F.reverse(F.slice("backward", 1, size - 1)).alias("suffix"), kinds.alias("kind")
    )
    between = F.arrays_zip(
        F.col("forward").alias("prefix"), F.reverse("backward").alias("suffix"), F.array_repeat(F.lit(CUT), size).alias("kind")
    )
    split = words.withColumn("letters", F.split("word", ""))
    return split.select("n", "place", F.inline(F.concat(skipped, between)))


def _best(members: Column) -> Column:
    """The member of largest n, the earliest word of equal ones."""
    return F.array_max(F.transform(members, lambda m: F.struct(m["n"].alias("n"), (-m["place"]).alias("behind"))))


def near_words(words: DataFrame) -> DataFrame:
    """(place, n_near, best) of every word that has near words; `best` is (n, -place) of the leading one.

    Two words that differ by a replaced letter skip a letter between the same two nodes; a word and
    one with a letter more meet where the shorter has a place between the two nodes and the
    longer skips a letter there. Of a row of equal letters only the first counts as the inserted
    one, so each pair meets once. A pair of nodes fixes all but one letter: its words are at
    most one for each letter of the alphabet and one without, so no group is large, and each
    meets the group's leaders instead of every other member.
    """
    groups = (
        _dictionary(words)
        .groupBy("prefix", "suffix")
        .agg(F.collect_list(F.struct("n", "place", "kind")).alias("members"))
        .filter(F.size("members") > 1)
        .withColumn("gaps", F.filter("members", lambda m: m["kind"] != CUT))
        .withColumn("firsts", F.filter("members", lambda m: m["kind"] == GAP_FIRST))
        .withColumn("cuts", F.filter("members", lambda m: m["kind"] == CUT))
    )

    def met(m: Column) -> Column:
        others = F.filter("gaps", lambda o: o["place"] != m["place"])
        near = F.when(m["kind"] == CUT, F.col("firsts")).when(m["kind"] == GAP, others).otherwise(F.concat(others, "cuts"))
        return F.struct(m["place"].alias("place"), F.size(near).cast("long").alias("near"), _best(near).alias("best"))

    found = groups.select(F.inline(F.transform("members", met))).filter("near > 0")
    return found.groupBy("place").agg(F.sum("near").alias("n_near"), F.max("best").alias("best"))


def _followed(forms: DataFrame) -> DataFrame:
    """(place, root): the last word of each chain of forms, by doubling; n at least doubles at each step, so chains are short."""
    state = settled(forms.select("place", F.col("form").alias("root")))
    while True:
        onward = state.select(F.col("place").alias("root"), F.col("root").alias("_next"))
        uses = onward.join(state.groupBy("root").agg(F.count("*").alias("_uses")), "root")
        state = settled(lookup(state, uses, "root", F.xxhash64("place"), "_uses"))
        moved = state.filter("_next is not null").limit(1).count()
        state = state.select("place", F.coalesce("_next", "root").alias("root"))
        if not moved:
            return state


def variants(words: DataFrame, word: str = "word", n: str = "n", ratio: int = 2) -> DataFrame:
    """word, form, root, n, n_near, form_n for every row of `words` (distinct words and their counts).

    Two words are near if they differ by one inserted, deleted or replaced code point. A word's
    form is its near word of largest n (the first in code-point order among equals) if that n
    is at least `ratio` times its own (more than once, so that chains end), else null; `root`
    follows forms to the last and is the word itself without one. Words without near words have
    n_near 0. Rows with a null word are left out; an empty word is near all words of one letter;
    further columns of `words` are dropped, whatever their names; an empty table gives no rows.
    """
    if ratio < 2:
        raise ValueError("ratio below 2: chains of forms could be long or endless")
    plain = settled(words.select(F.col(word).alias("word"), F.col(n).cast("long").alias("n")).filter("word is not null"))
    longest = plain.agg(F.max(F.length("word"))).first()[0] or 0
    forward = trie_nodes(plain, "word", longest).withColumnRenamed("nodes", "forward")
    mirrored = trie_nodes(plain.select(F.reverse("word").alias("mirrored")), "mirrored", longest)
    backward = mirrored.select(F.reverse("mirrored").alias("word"), F.col("nodes").alias("backward"))
    places = settled(forward.select("word", "n", "place"))
    near = near_words(forward.join(backward, "word"))
    joined = places.join(near, "place", "left")
    leads = F.col("best.n") >= ratio * F.col("n")
    judged = settled(
        joined.select(
            *places.columns,
            F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
            F.when(leads, -F.col("best.behind")).alias("form"),
            F.when(leads, F.col("best.n")).alias("form_n"),
        )
    )
    roots = _followed(judged.filter("form is not null"))
    ended = judged.join(roots, "place", "left")

    def named(rows: DataFrame, place: str, name: str) -> DataFrame:
        uses = rows.filter(F.col(place).isNotNull()).groupBy(place).agg(F.count("*").alias("_uses"))
        asked = places.select(F.col("place").alias(place), F.col("word").alias(name)).join(uses, place)
        return lookup(rows, asked, place, F.xxhash64("word"), "_uses")

    ended = named(named(settled(ended), "form", "form_word"), "root", "root_word")
    return ended.select(
        "word", F.col("form_word").alias("form"), F.coalesce("root_word", "word").alias("root"), "n", "n_near", "form_n"
    )
