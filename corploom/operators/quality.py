"""Corpus features, filters, profiles, cleaning rules and review samples."""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corploom.functions import text as tx
from corploom.operators.dedup import flag_exact
from corploom.operators.lookup import settled


def raw_corpus(df: DataFrame, text: str, script: str) -> DataFrame:
    """Raw text with length, script share and line count."""
    t = F.col(text)
    return (
        df.withColumn("chars", F.length(t))
        .withColumn("script_share", tx.char_share(t, script))
        .withColumn("line_count", tx.line_count(t))
    )


def filtered_corpus(raw: DataFrame, text: str, row_id: str, min_chars: int = 200, min_share: float = 0.45) -> DataFrame:
    """Long enough and strictly above the share; copies flagged among the rows kept."""
    kept = raw.filter((F.col("chars") >= min_chars) & (F.col("script_share") > min_share))
    return flag_exact(kept, F.col(text), row_id, "duplicate_text")


def clean_measures(
    df: DataFrame, text: str, row_id: str, script: str, *keep: str, min_chars: int = 300, min_share: float = 0.45
) -> DataFrame:
    """Measures and hash of the normalised text, copies flagged over all rows, and the keep decision.

    The text is read and normalised once and left behind; what is shuffled is narrow.
    """
    t = F.col("_t.clean")
    normal = df.select(row_id, *keep, tx.computed_once(clean=tx.normalize_space(F.col(text))).alias("_t"))
    measures = tx.computed_once(
        text_hash=tx.text_hash(t), chars=F.length(t), tokens=tx.token_count(t), script_share=tx.char_share(t, script)
    )
    narrow = settled(normal.select(row_id, *keep, measures.alias("_m")).select(row_id, *keep, "_m.*"))
    firsts = narrow.groupBy("text_hash").agg(F.min(row_id).alias(row_id)).select(row_id, F.lit(False).alias("duplicate"))
    flagged = narrow.join(firsts, row_id, "left").withColumn("duplicate", F.coalesce("duplicate", F.lit(True)))
    enough = (F.col("chars") >= min_chars) & (F.col("script_share") >= min_share) & ~F.col("duplicate")
    return flagged.withColumn("keep", enough)


def clean_corpus(
    df: DataFrame, text: str, row_id: str, script: str, min_chars: int = 300, min_share: float = 0.45
) -> DataFrame:
    """The rows with `clean_measures` and the normalised text, joined where the text is to be written."""
    measures = clean_measures(df, text, row_id, script, min_chars=min_chars, min_share=min_share)
    return df.withColumn("text_clean", tx.normalize_space(F.col(text))).join(measures, row_id)


def filter_review(raw: DataFrame, text: str, min_chars: int = 200, min_share: float = 0.45) -> DataFrame:
    """One-row report of the strict filter.

    Copies among the kept rows are rows kept less different texts kept, so hashes
    are grouped (pre-aggregated) and no flag per row is needed.
    """
    short, low = F.col("chars") < min_chars, F.col("script_share") <= min_share
    kept = ~short & ~low
    per_text = raw.groupBy(F.when(kept, tx.text_hash(F.col(text))).alias("hash")).agg(
        F.count("*").alias("n"),
        F.count_if(kept).alias("kept"),
        F.count_if(short).alias("short"),
        F.count_if(low).alias("low"),
    )
    return per_text.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("n_sources"),
        F.coalesce(F.sum("kept"), F.lit(0)).alias("n_texts_kept"),
        F.coalesce(F.sum("short"), F.lit(0)).alias("too_short"),
        F.coalesce(F.sum("low"), F.lit(0)).alias("low_script_share"),
        (F.coalesce(F.sum("kept"), F.lit(0)) - F.count("hash")).alias("duplicates"),
    )


def corpus_profile(df: DataFrame, text: str, keys: list[str], short: int = 300) -> DataFrame:
    t = F.col(text)
    return df.groupBy(*keys).agg(
        F.count("*").alias("docs"),
        F.sum(F.length(t)).alias("chars"),
        F.sum(tx.token_count(t)).alias("words"),
        F.round(F.avg((F.length(t) < short).cast("double")), 6).alias("short_share"),
        F.round(F.avg((F.trim(t) == "").cast("double")), 6).alias("empty_share"),
    )


def coverage(df: DataFrame, fields: list[str]) -> DataFrame:
    """How many rows carry each value of each metadata field present (genre, age group, dialect, ...)."""
    present = [f for f in fields if f in df.columns]
    pairs = F.array(*[F.struct(F.lit(f).alias("field"), F.col(f).cast("string").alias("value")) for f in present])
    return df.select(F.explode(pairs).alias("p")).groupBy("p.field", "p.value").agg(F.count("*").alias("docs"))


# Characters unified before comparison.
APOSTROPHES, HYPHENS = "ʼ’‘`´′", "‐‑‒–−"


@F.pandas_udf(T.StringType())
def _nfc(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
    for texts in batches:
        yield texts.map(lambda s: None if s is None else unicodedata.normalize("NFC", s))


def unify_unicode(text: Column) -> Column:
    """NFC form with one apostrophe and one hyphen. Only texts beyond ASCII visit Python."""
    beyond = F.rlike(text, F.lit(r"[^\x00-\x7f]"))
    composed = F.coalesce(_nfc(F.when(beyond, text)), text)
    marks = "'" * len(APOSTROPHES) + "-" * len(HYPHENS)
    return F.translate(composed, APOSTROPHES + HYPHENS, marks)


# Patterns of personal data and of markup left in a text.
EMAIL = r"[A-Za-z0-9._%+\-]+@[A-Za-z0-9.\-]+\.[A-Za-z]{2,}"
PHONE = r"\+?[0-9][0-9()\- ]{7,}[0-9]"
MARKUP = r"<[A-Za-z/!][^<>]*>|&[A-Za-z]+;|&#[0-9]+;"


def personal_data(df: DataFrame, text: str) -> DataFrame:
    t = F.col(text)
    masked = F.regexp_replace(F.regexp_replace(t, EMAIL, "[EMAIL]"), PHONE, "[PHONE]")
    return (
        df.withColumn("emails", F.regexp_count(t, F.lit(EMAIL)))
        .withColumn("phones", F.regexp_count(F.regexp_replace(t, EMAIL, "[EMAIL]"), F.lit(PHONE)))
        .withColumn("text_masked", masked)
    )


def cleaning_rules(text: Column, script: str, other_script: str) -> dict[str, Column]:
    """A flag per rule: does it touch this text?"""
    return {
        "markup": F.rlike(text, F.lit(MARKUP)),
        "blank_lines": F.rlike(text, F.lit(r"\n[ \t]*\n")),
        "edge_spaces": F.rlike(text, F.lit(r"(^|\n)[ \t]+|[ \t]+(\n|$)|  ")),
        "marks": F.rlike(text, F.lit(f"[{APOSTROPHES}{HYPHENS}]")),
        "mixed_script": F.rlike(text, F.lit(f"[{script}]")) & F.rlike(text, F.lit(f"[{other_script}]")),
        "personal_data": F.rlike(text, F.lit(EMAIL)) | F.rlike(text, F.lit(PHONE)),
    }


def cleaning_rule_counts(df: DataFrame, text: str, script: str, other_script: str) -> DataFrame:
    """Rows touched per rule, and surplus copies, from one pre-aggregated grouping."""
    rules = cleaning_rules(F.col(text), script, other_script)
    per_text = df.groupBy(tx.text_hash(F.col(text)).alias("hash")).agg(
        F.count("*").alias("n"), *[F.count_if(c).alias(r) for r, c in rules.items()]
    )
    return per_text.agg(
        F.sum("n").alias("documents"),
        *[F.sum(r).alias(r) for r in rules],
        (F.sum("n") - F.count("*")).alias("duplicates"),
    )


def review_sample(df: DataFrame, row_id: str, size: int = 30, seed: int = 7) -> DataFrame:
    """A repeatable random sample: the `size` lowest hashes (a distributed top-n)."""
    return df.orderBy(tx.seeded_md5(row_id, seed=seed), row_id).limit(size)


def provenance(df: DataFrame, text: str, load_date: str, version: str) -> DataFrame:
    return (
        df.withColumn("load_date", F.lit(load_date))
        .withColumn("text_hash", tx.text_hash(F.col(text)))
        .withColumn("pipeline_version", F.lit(version))
    )


def unmarked_synthetic(df: DataFrame, label: str, text: str) -> DataFrame:
    """Synthetic-text check: rows without a label, and texts claimed as both human and synthetic."""
    per_text = df.groupBy(tx.text_hash(F.col(text)).alias("hash")).agg(
        F.count("*").alias("n"),
        F.count_if(~F.coalesce(F.col(label), F.lit("")).isin("human", "synthetic")).alias("unmarked"),
        F.bool_or(F.col(label) == "human").alias("human"),
        F.bool_or(F.col(label) == "synthetic").alias("synthetic"),
    )
    return per_text.agg(
        F.sum("n").alias("rows_total"),
        F.sum("unmarked").alias("rows_unmarked"),
        F.count_if(F.col("human") & F.col("synthetic")).alias("texts_mixed"),
    )
