"""Frequency dictionaries, synthetic typos, suggestions, unknown words, variants, dictionary translation."""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corploom.functions import text as tx
from corploom.operators.lookup import BROADCAST_ROWS, lookup, settled

# Words that a worker replaces at once; a longer text is a slice of its own.
_SLICE = 1 << 18

# Functions of this module travel to the workers whole, so these need no copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def words(df: DataFrame, text: str, script: str, *keep: str, at_least: int = 3) -> DataFrame:
    """One row per word of at least `at_least` letters of the script, lower-cased."""
    found = tx.script_tokens(F.lower(F.col(text)), script, at_least)
    return df.select(*keep, F.explode(found).alias("word"))


def frequency(df: DataFrame, text: str, script: str, at_least: int = 3) -> DataFrame:
    return words(df, text, script, at_least=at_least).groupBy("word").agg(F.count("*").alias("count"))


def top_words(freq: DataFrame, size: int = 300, min_count: int = 1) -> DataFrame:
    """The `size` most frequent words; ties in word order."""
    return freq.filter(F.col("count") >= min_count).orderBy(F.desc("count"), "word").limit(size)


def alphabet(top: DataFrame, size: int = 100) -> DataFrame:
    """Letters of the `size` most frequent words."""
    head = top.orderBy(F.desc("count"), "word").limit(size)
    return head.select(F.explode(F.split("word", "")).alias("letter")).filter("letter <> ''").distinct()


def with_typos(gold: DataFrame, letters: DataFrame, seed: int = 11) -> DataFrame:
    """Delete, swap or replace one letter; which and where follows from the word's hash.

    A swap at the last letter becomes a replacement, as does one by the same letter;
    words under four letters stay as they are.
    """
    alpha = letters.agg(F.array_sort(F.collect_list("letter"))).scalar()
    w, n = F.col("gold"), F.length("gold")
    h = tx.hash_number("gold", seed=seed)
    i = (h % n).cast("int")
    op = F.floor(h / 1009) % 3
    letter = F.element_at(alpha, ((F.floor(h / 7919) % F.size(alpha)) + 1).cast("int"))
    head, tail = F.substring(w, F.lit(1), i), F.substring(w, i + 2, n)
    swap = F.concat(head, F.substring(w, i + 2, F.lit(1)), F.substring(w, i + 1, F.lit(1)), F.substring(w, i + 3, n))
    typo = (
        F.when(n < 4, w)
        .when(op == 0, F.concat(head, tail))
        .when((op == 1) & (i < n - 1), swap)
        .otherwise(F.concat(head, letter, tail))
    )
    return gold.withColumn("typo", typo)


def suggest(typos: DataFrame, vocab: DataFrame, limit: int = 3) -> DataFrame:
    """Nearest words of a bounded vocabulary (a top-n list) for every typo, by edit distance.

    The list is one array value, so each typo is compared where it lies: no pairs are
    shuffled. Ties go to the more frequent word, then word order. Vocabularies without
    a fixed bound go through `near_words`.
    """
    entries = vocab.agg(F.collect_list(F.struct("word", "count"))).scalar()
    scored = F.transform(
        F.col("_vocab"),
        lambda v: F.struct(
            F.levenshtein(F.col("typo"), v["word"]).alias("d"), (-v["count"]).alias("rare"), v["word"].alias("word")
        ),
    )
    best = F.slice(F.array_sort(scored), 1, limit)
    similarity = lambda s: F.round(
        100 * (1 - s["d"] / F.greatest(F.length("typo"), F.length(s["word"]), F.lit(1))), 4
    )
    return (
        typos.withColumn("_vocab", entries)
        .withColumn("_best", best)
        .withColumn("top1", F.try_element_at("_best", F.lit(1))["word"])
        .withColumn("top1_score", similarity(F.try_element_at("_best", F.lit(1))))
        .withColumn("top3", F.transform("_best", lambda s: s["word"]))
        .drop("_best", "_vocab")
    )


def evaluate(suggested: DataFrame) -> DataFrame:
    return suggested.withColumn("top1_correct", F.coalesce(F.col("top1") == F.col("gold"), F.lit(False))).withColumn(
        "top3_correct", F.array_contains("top3", F.col("gold"))
    )


def deletions(word: Column, distance: int) -> Column:
    """The word and all forms with up to `distance` letters taken out."""
    forms = F.array(word)
    for _ in range(distance):
        shorter = F.flatten(
            F.transform(
                forms,
                lambda f: F.transform(
                    F.sequence(F.lit(1), F.greatest(F.length(f), F.lit(1))),
                    lambda i: F.concat(F.substring(f, F.lit(1), i - 1), F.substring(f, i + 1, F.length(f))),
                ),
            )
        )
        forms = F.array_distinct(F.concat(forms, shorter))
    return forms


def near_words(unknown: DataFrame, vocab: DataFrame, distance: int = 1, limit: int = 3) -> DataFrame:
    """All vocabulary words within the edit distance, found by shared deletions, best `limit` kept.

    Two words at distance d share a form with at most d letters deleted from each, so the
    equi-join misses nothing. How many words can share a form is bounded by the alphabet
    and the word length, not by the corpus.
    """
    # A word longer than all candidates by more than the distance has none; it is left out of the search alone.
    longest = vocab.agg(F.coalesce(F.max(F.length("word")), F.lit(0))).scalar()
    forms = lambda w: F.explode(F.transform(deletions(w, distance), lambda f: F.xxhash64(f))).alias("form")
    left = unknown.filter(F.length("word") <= longest + distance).select("word", forms(F.col("word")))
    right = vocab.select(F.col("word").alias("candidate"), F.col("count").alias("n"), forms(F.col("word")))
    pairs = (
        left.join(right, "form")
        .withColumn("d", F.levenshtein("word", "candidate", distance))
        .filter(F.col("d") >= 0)
        .groupBy("word", "candidate")
        .agg(F.min("d").alias("d"), F.max("n").alias("n"))
    )
    ranked = pairs.groupBy("word").agg(
        F.slice(F.array_sort(F.collect_list(F.struct("d", (-F.col("n")).alias("rare"), "candidate"))), 1, limit).alias("best")
    )
    return ranked.select("word", F.transform("best", lambda b: b["candidate"]).alias("candidates"))


def word_list(df: DataFrame, text: str, source: str, script: str, at_least: int = 3) -> DataFrame:
    """word, count, source_count; two pre-aggregated steps instead of a distinct count."""
    per_source = words(df, text, script, source, at_least=at_least).groupBy("word", source).agg(F.count("*").alias("n"))
    return per_source.groupBy("word").agg(F.sum("n").alias("count"), F.count("*").alias("source_count"))


def with_status(listed: DataFrame, foreign: DataFrame, min_sources: int = 2) -> DataFrame:
    """accepted / unsure / reject, with notes: a word of a dominant language is for a person to look at
    if several sources have it, else rejected; a word of too few sources is unsure."""
    marked = listed.join(foreign.select("word", F.lit(True).alias("foreign")), "word", "left")
    foreign_word, several = F.coalesce("foreign", F.lit(False)), F.col("source_count") >= min_sources
    notes = F.array_compact(
        F.array(F.when(foreign_word, "frequent in the dominant language"), F.when(~several, "too few sources"))
    )
    return (
        marked.withColumn("status", F.when(foreign_word & ~several, "reject").when(~foreign_word & several, "accepted").otherwise("unsure"))
        .withColumn("notes", F.array_join(notes, "; "))
        .withColumn("foreign", foreign_word)
    )


NAME_NOTE = "capitalised inside sentences"


def name_shares(df: DataFrame, text: str, script: str, at_least: int = 3) -> DataFrame:
    """(word, inner, capitalised): occurrences that do not begin a sentence, and how many of them have a capital first."""
    placed = df.select(F.explode(tx.sentences(F.col(text))).alias("sentence")).select(
        F.posexplode(tx.script_tokens(F.col("sentence"), script, at_least)).alias("pos", "token")
    )
    first = F.substring("token", 1, 1)
    inner = placed.filter("pos > 0").select(F.lower("token").alias("word"), (first != F.lower(first)).alias("capital"))
    return inner.groupBy("word").agg(F.count("*").alias("inner"), F.count_if("capital").alias("capitalised"))


def with_names(listed: DataFrame, shares: DataFrame, least: float = 0.5, min_count: int = 2) -> DataFrame:
    """The word list with `name_share` and the flag `name`, told in the notes: a word that is mostly
    capitalised where no sentence begins is likely a name, which a first word of a sentence can't show."""
    share = F.col("capitalised") / F.nullif(F.col("inner"), F.lit(0))
    is_name = F.coalesce((share >= least) & (F.col("capitalised") >= min_count), F.lit(False))
    noted = F.concat_ws("; ", F.nullif(F.col("notes"), F.lit("")), F.when(is_name, NAME_NOTE))
    return (
        listed.join(shares, "word", "left")
        .withColumn("name_share", F.round(share, 6))
        .withColumn("notes", noted)
        .withColumn("name", is_name)
        .drop("inner", "capitalised")
    )


def unknown_words(freq: DataFrame, accepted: DataFrame, distance: int = 1) -> DataFrame:
    """Words missing from the accepted list, with candidates; never corrected without a decision."""
    unknown = freq.join(accepted.select("word"), "word", "left_anti")
    candidates = near_words(unknown.select("word"), accepted, distance)
    return (
        unknown.join(candidates, "word", "left")
        .withColumn("candidates", F.coalesce("candidates", F.array().cast("array<string>")))
        .withColumn("decision", F.lit("pending"))
        .withColumn("band", frequency_band(F.col("count")))
    )


def frequency_band(count: Column) -> Column:
    return F.when(count == 1, "once").when(count <= 5, "rare").otherwise("common")


def detection_scores(flagged: DataFrame, truth: str, guess: str, band: str) -> DataFrame:
    """Precision, recall and false positives of error detection, per frequency band."""
    t, g = F.col(truth), F.col(guess)
    tp, fp, fn = F.count_if(t & g), F.count_if(~t & g), F.count_if(t & ~g)
    return flagged.groupBy(band).agg(
        tp.alias("true_positives"),
        fp.alias("false_positives"),
        fn.alias("false_negatives"),
        F.round(tp / F.nullif(tp + fp, F.lit(0)), 6).alias("precision"),
        F.round(tp / F.nullif(tp + fn, F.lit(0)), 6).alias("recall"),
    )


def standardise(found: DataFrame, variants: DataFrame, mapping: tuple[str, str] = ("", "")) -> DataFrame:
    """Variant -> chosen standard, else script mapping; every change carries its kind, the form is kept."""
    marked = found.join(variants.select(F.col("variant").alias("word"), "standard"), "word", "left")
    mapped = F.translate("word", *mapping) if mapping[0] else F.col("word")
    return marked.withColumn("form", F.coalesce("standard", mapped)).withColumn(
        "kind",
        F.when(F.col("standard").isNotNull(), "normalisation")
        .when(F.col("form") != F.col("word"), "transliteration")
        .otherwise("unchanged"),
    )


def _replaced(rows: DataFrame, row_id: str, words: str, dictionary: DataFrame) -> DataFrame:
    """(row_id, translation, words, known_words) where the words lie, by a dictionary short enough to be broadcast."""
    entries = rows.sparkSession.sparkContext.broadcast(dictionary.toArrow())

    def replace(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, values = (pa.array(entries.value[c].combine_chunks(), pa.string()) for c in ("word", "translation"))
        for batch in batches:
            for part in _slices(batch):
                listed = part.column(1)
                found = pc.index_in(listed.flatten(), value_set=keys)
                known = found.is_valid()
                offsets = listed.offsets.to_numpy() - listed.offsets[0].as_py()
                new = pc.coalesce(values.take(found), listed.flatten())
                hits = np.concatenate([[0], np.cumsum(known.to_numpy(zero_copy_only=False), dtype=np.int64)])[offsets]
                joined = pc.binary_join(pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), new), " ")
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), joined, pa.array(np.diff(offsets), pa.int64()), pa.array(np.diff(hits), pa.int64())],
                    [row_id, "translation", "words", "known_words"],
                )

    kind = rows.schema[row_id].dataType.simpleString()
    return rows.select(row_id, words).mapInArrow(replace, f"{row_id} {kind}, translation string, words long, known_words long")


def _slices(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """A batch in slices of about `_SLICE` words; a longer row is a slice of its own."""
    offsets = batch.column(1).offsets.to_numpy()
    begin = 0
    while begin < batch.num_rows:
        end = max(begin + 1, int(np.searchsorted(offsets, offsets[begin] + _SLICE, "right")) - 1)
        yield batch.slice(begin, end - begin)
        begin = end


def translate_by_dictionary(
    segments: DataFrame, text: str, row_id: str, dictionary: DataFrame, broadcast_rows: int = BROADCAST_ROWS
) -> DataFrame:
    """Word-for-word baseline: known words replaced, unknown ones kept and counted; a row without words keeps its row.

    A dictionary of few rows goes to where the texts lie. Of a longer one, the places of
    known words are gathered per row.
    """
    dictionary = settled(dictionary.select("word", "translation").filter("word is not null and translation is not null"))
    found = F.coalesce(tx.tokens(F.lower(F.col(text))), F.array().cast("array<string>"))
    if dictionary.count() <= broadcast_rows:
        return _replaced(segments.select(row_id, found.alias("_words")), row_id, "_words", dictionary)
    split = segments.select(row_id, F.posexplode(tx.tokens(F.lower(F.col(text)))).alias("pos", "word"))
    counts = split.groupBy("word").agg(F.count("*").alias("n"))
    entries = counts.join(dictionary, "word")
    placed = lookup(split, entries, "word", F.concat_ws(":", row_id, "pos"), "n")
    hits = placed.filter(F.col("translation").isNotNull()).groupBy(row_id).agg(
        F.map_from_entries(F.collect_set(F.struct("pos", "translation"))).alias("_known")
    )
    joined = segments.select(row_id, text).join(hits, row_id, "left")
    known = F.coalesce("_known", F.create_map().cast("map<int,string>"))
    rows = joined.select(row_id, known.alias("_known"), found.alias("_words"))
    return rows.select(
        row_id,
        F.array_join(F.transform("_words", lambda w, i: F.coalesce(F.try_element_at("_known", i), w)), " ").alias("translation"),
        F.size("_words").cast("long").alias("words"),
        F.size("_known").cast("long").alias("known_words"),
    )
