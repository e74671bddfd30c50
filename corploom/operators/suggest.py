"""Suggestions out of a word list of any length: swaps count as one edit, ties may go to a similarity ratio."""

from __future__ import annotations

import sys
from collections.abc import Iterator

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corploom.operators import spell

cloudpickle.register_pickle_by_value(sys.modules[__name__])


def swapped(a: Column, b: Column) -> Column:
    """Whether two words of one length differ by two neighbouring letters that changed places."""
    return (F.length(a) == F.length(b)) & F.exists(
        F.sequence(F.lit(1), F.greatest(F.length(a) - 1, F.lit(1))),
        lambda i: F.concat(F.substring(a, F.lit(1), i - 1), F.substring(a, i + 1, F.lit(1)), F.substring(a, i, F.lit(1)), F.substring(a, i + 2, F.length(a))) == b,
    )


def edit_or_swap(a: Column, b: Column) -> Column:
    """0 for equal words, 1 for one insertion, deletion, replacement or swap of neighbours, else null."""
    plain = F.levenshtein(a, b, 2)
    return F.when((plain >= 0) & (plain <= 1), plain).when((plain == 2) & swapped(a, b), 1)


def common_length(a: str, b: str) -> int:
    """Length of the longest common subsequence, with one bit for each letter of `a`."""
    marks: dict[str, int] = {}
    for i, letter in enumerate(a):
        marks[letter] = marks.get(letter, 0) | 1 << i
    whole = (1 << len(a)) - 1
    state = whole
    for letter in b:
        met = state & marks.get(letter, 0)
        state = ((state + met) | (state - met)) & whole
    return len(a) - state.bit_count()


@F.pandas_udf(T.DoubleType())
def ratio(pairs: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
    """Twice the common subsequence over both lengths, in percent; 100 for two empty words, null for null."""
    for left, right in pairs:
        yield pd.Series(
            [None if a is None or b is None else 200 * common_length(a, b) / (len(a) + len(b)) if a or b else 100.0 for a, b in zip(left, right, strict=True)],
            dtype="float64",
        )


def suggestions(unknown: DataFrame, vocab: DataFrame, limit: int = 3, scorer: str = "distance") -> DataFrame:
    """(word, best): the `limit` best words of `vocab` (word, count) at most one edit or swap away, as structs (d, ratio, count, candidate).

    Words one edit or swap apart share a form with at most one letter taken out of each, so an equi-join on
    hashed forms misses none, and how many words share a form is bounded by alphabet and length. They are
    ranked by distance, or with `scorer` = "ratio" by similarity ratio first; then by count,
    then in word order. A word without candidates is left out; words repeated in `unknown` count once.
    """
    if scorer not in ("distance", "ratio"):
        raise ValueError(f"no scorer {scorer}")
    longest = vocab.agg(F.coalesce(F.max(F.length("word")), F.lit(0))).scalar()
    forms = lambda w: F.explode(F.transform(spell.deletions(w, 1), lambda f: F.xxhash64(f))).alias("form")
    left = unknown.select("word").distinct().filter(F.length("word") <= longest + 1).select("word", forms(F.col("word")))
    right = vocab.select(F.col("word").alias("candidate"), F.col("count").alias("n"), forms(F.col("word")))
    pairs = left.join(right, "form").select("word", "candidate", "n").distinct()
    near = pairs.withColumn("d", edit_or_swap(F.col("word"), F.col("candidate"))).filter("d is not null")
    score = F.round(ratio("word", "candidate"), 4) if scorer == "ratio" else F.lit(None).cast("double")
    first = (-F.col("ratio"),) if scorer == "ratio" else ()
    scored = near.withColumn("ratio", score)
    order = F.struct(*[c.alias(f"_{i}") for i, c in enumerate((*first, F.col("d"), -F.col("n"), F.col("candidate")))], "d", "ratio", F.col("n").alias("count"), "candidate")
    listed = scored.groupBy("word").agg(F.slice(F.array_sort(F.collect_list(order)), 1, limit).alias("best"))
    return listed.select("word", F.transform("best", lambda b: F.struct(b["d"].alias("d"), b["ratio"].alias("ratio"), b["count"].alias("count"), b["candidate"].alias("candidate"))).alias("best"))
