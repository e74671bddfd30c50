"""Error rates and translation scores over (hypothesis, reference) rows."""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corploom.functions import text as tx

# Characters (of both sides) whose n-grams a worker counts at once; a longer pair is a slice of its own.
_SLICE = 1 << 18

# Functions of this module travel to the workers whole, so these need no copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Letters with marks and their plain forms.
MARKED = "àâäáãåçéèêëíìîïñóòôöõúùûüýÿÀÂÄÁÃÅÇÉÈÊËÍÌÎÏÑÓÒÔÖÕÚÙÛÜÝŸӝӟӥӧӵӜӞӤӦӴёЁ"
PLAIN = "aaaaaaceeeeiiiinooooouuuuyyAAAAAACEEEEIIIINOOOOOUUUUYYжзиочЖЗИОЧеЕ"


def unmarked(text: Column) -> Column:
    return F.translate(text, MARKED, PLAIN)


def word_codes(words: Column, index: Column) -> Column:
    """Words as single characters (plane 1 and up), so that the built-in levenshtein counts words."""
    codes = F.transform(words, lambda w: F.lpad(F.hex(F.array_position(index, w) + F.lit(0x10000)), 8, "0"))
    return F.decode(F.unhex(F.array_join(codes, "")), "UTF-32")


def word_distance(hypothesis: Column, reference: Column) -> Column:
    split = lambda t: F.regexp_extract_all(t, F.lit(rf"(?U)[^{tx.SPACE_CLASS}]+"), F.lit(0))
    h, r = split(hypothesis), split(reference)
    changed = tx.let(
        F.array_distinct(F.concat(h, r)), lambda index: F.levenshtein(word_codes(h, index), word_codes(r, index))
    )
    return F.when(hypothesis == reference, F.lit(0)).otherwise(changed)


def error_counts(pairs: DataFrame, hypothesis: str, reference: str) -> DataFrame:
    """Character and word edits per line; equal lines skip the dynamic programme."""
    h, r = F.col(hypothesis), F.col(reference)
    edits = F.when(h == r, F.lit(0)).otherwise(F.levenshtein(h, r))
    plain = F.when(h == r, F.lit(0)).otherwise(F.levenshtein(unmarked(h), unmarked(r)))
    return (
        pairs.withColumn("char_edits", edits)
        .withColumn("mark_edits", edits - plain)
        .withColumn("chars", F.length(r))
        .withColumn("word_edits", word_distance(h, r))
        .withColumn("words", tx.whitespace_token_count(r))
    )


def error_rates(counted: DataFrame, group: str) -> DataFrame:
    """Micro-averaged rates per group, edits in marks apart."""
    chars, words = F.greatest(F.sum("chars"), F.lit(1)), F.greatest(F.sum("words"), F.lit(1))
    return counted.groupBy(group).agg(
        F.count("*").alias("lines"),
        F.sum("char_edits").alias("char_edits"),
        F.sum("mark_edits").alias("mark_edits"),
        F.round(F.sum("char_edits") / chars, 6).alias("cer"),
        F.round(F.sum("word_edits") / words, 6).alias("wer"),
    )


def error_table(pairs: DataFrame, hypothesis: str, reference: str) -> DataFrame:
    """Error type of each recognised line: none, case, marks, punctuation, length, substitution."""
    h, r = F.col(hypothesis), F.col(reference)
    bare = lambda t: F.regexp_replace(t, f"[^{tx.WORD_CLASS}]+", "")
    kind = (
        F.when(h == r, "none")
        .when(F.lower(h) == F.lower(r), "case")
        .when(unmarked(h) == unmarked(r), "marks")
        .when(bare(h) == bare(r), "punctuation")
        .when(F.length(h) < F.length(r), "omission")
        .when(F.length(h) > F.length(r), "insertion")
        .otherwise("substitution")
    )
    return pairs.withColumn("error_type", kind)


def first_difference(pairs: DataFrame, hypothesis: str, reference: str) -> DataFrame:
    """Counts of (read, correct) characters at the first place where two unequal lines part."""
    h, r = F.col(hypothesis), F.col(reference)
    zipped = F.arrays_zip(F.split(h, "").alias("h"), F.split(r, "").alias("r"))
    differ = F.filter(zipped, lambda z: ~z["h"].eqNullSafe(z["r"]))
    first = F.try_element_at(differ, F.lit(1))
    return (
        pairs.filter(h != r)
        .select(F.coalesce(first["h"], F.lit("")).alias("read"), F.coalesce(first["r"], F.lit("")).alias("correct"))
        .groupBy("read", "correct")
        .agg(F.count("*").alias("n"))
    )


def _units(texts: list[str], words: bool) -> tuple[np.ndarray, np.ndarray]:
    """(codes, lengths) of the units of texts that follow each other: words between blanks, or characters."""
    if words:
        split = [[w for w in t.split(" ") if w] for t in texts]
        codes = pd.factorize(np.array([w for ws in split for w in ws], dtype=object))[0] if any(split) else np.empty(0, np.int64)
        return codes.astype(np.int64), np.array([len(ws) for ws in split])
    codes = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32)
    return codes.astype(np.int64), np.array([len(t) for t in texts])


def _slice_totals(hypotheses: list[str], references: list[str], order: int, words: bool) -> list[tuple[int, int, int, int]]:
    """(n, hyp, ref, matched) of some pairs, matches clipped pair by pair.

    An n-gram is numbered by its first n - 1 units and its last, so numbers stay dense and exact.
    """
    codes, lengths = _units(hypotheses + references, words)
    codes = np.unique(codes, return_inverse=True)[1].astype(np.int64)
    pair = np.repeat(np.arange(len(lengths)) % len(hypotheses), lengths)
    is_hyp = np.arange(len(codes)) < lengths[: len(hypotheses)].sum()
    ends = np.repeat(np.cumsum(lengths), lengths)
    places, grams, kinds, totals = np.arange(len(codes)), codes, len(codes) + 1, []
    for n in range(1, order + 1):
        if n > 1:
            inside = places + n <= ends[places]
            places, grams = places[inside], grams[inside]
            grams = np.unique(grams * kinds + codes[places + n - 1], return_inverse=True)[1].astype(np.int64)
        _, group = np.unique(pair[places] * kinds + grams, return_inverse=True)
        side = is_hyp[places]
        h, r = np.bincount(group[side], minlength=len(places)), np.bincount(group[~side], minlength=len(places))
        totals.append((n, int(side.sum()), int((~side).sum()), int(np.minimum(h, r).sum())))
    return totals


def _clipped(pairs: DataFrame, hypothesis: Column, reference: Column, order: int, words: bool) -> DataFrame:
    """(n, hyp, ref, matched) over all rows: n-grams are counted where the pair lies, only totals of slices travel."""

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            h, r, total, sums = [], [], 0, np.zeros((order, 3), np.int64)
            for x, y in zip(b["h"], b["r"]):
                x, y = x or "", y or ""
                if h and total + len(x) + len(y) > _SLICE:
                    sums += np.array(_slice_totals(h, r, order, words))[:, 1:]
                    h, r, total = [], [], 0
                h.append(x)
                r.append(y)
                total += len(x) + len(y)
            if h:
                sums += np.array(_slice_totals(h, r, order, words))[:, 1:]
            yield pd.DataFrame({"n": range(1, order + 1), "hyp": sums[:, 0], "ref": sums[:, 1], "matched": sums[:, 2]})

    counts = pairs.select(hypothesis.alias("h"), reference.alias("r")).mapInPandas(count, "n int, hyp long, ref long, matched long")
    totals = counts.groupBy("n").agg(F.sum("hyp").alias("hyp"), F.sum("ref").alias("ref"), F.sum("matched").alias("matched"))
    return totals.filter("hyp + ref > 0")


def chrf(pairs: DataFrame, row_id: str, hypothesis: str, reference: str, order: int = 6, beta: float = 2.0) -> DataFrame:
    """Corpus chrF: character n-grams without white space, mean F-beta over the orders, in percent."""
    packed = lambda c: F.regexp_replace(c, rf"(?U)[{tx.SPACE_CLASS}]+", "")
    totals = _clipped(pairs, packed(F.col(hypothesis)), packed(F.col(reference)), order, words=False)
    p, r = F.col("matched") / F.greatest("hyp", F.lit(1)), F.col("matched") / F.greatest("ref", F.lit(1))
    b2 = beta * beta
    f = F.when(p + r > 0, (1 + b2) * p * r / (b2 * p + r)).otherwise(F.lit(0.0))
    return totals.agg(F.round(100 * F.avg(f), 4).alias("chrf"), F.sum("matched").alias("matched_ngrams"))


def bleu(pairs: DataFrame, row_id: str, hypothesis: str, reference: str, order: int = 4) -> DataFrame:
    """Corpus BLEU on white-space tokens: clipped precisions, geometric mean, brevity penalty, in percent."""
    spaced = lambda c: tx.normalize_space(F.col(c))
    totals = _clipped(pairs, spaced(hypothesis), spaced(reference), order, words=True)
    one = totals.agg(
        F.sum(F.when(F.col("n") == 1, F.col("hyp"))).alias("hyp_words"),
        F.sum(F.when(F.col("n") == 1, F.col("ref"))).alias("ref_words"),
        F.count_if(F.col("matched") > 0).alias("orders_matched"),
        F.avg(F.ln(F.col("matched") / F.greatest("hyp", F.lit(1)))).alias("log_precision"),
    )
    brevity = F.when(F.col("hyp_words") >= F.col("ref_words"), F.lit(1.0)).otherwise(
        F.exp(1 - F.col("ref_words") / F.greatest("hyp_words", F.lit(1)))
    )
    score = F.when(F.col("orders_matched") == order, 100 * brevity * F.exp("log_precision")).otherwise(F.lit(0.0))
    return one.select("hyp_words", "ref_words", F.round(score, 4).alias("bleu"))
