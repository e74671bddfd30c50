"""Data cards and JSON reports from aggregates."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def data_card_totals(clean: DataFrame) -> DataFrame:
    kept = F.when(F.col("keep"), F.col("chars"))
    return clean.agg(
        F.count("*").alias("raw_documents"),
        F.count_if("keep").alias("kept_documents"),
        F.coalesce(F.sum(kept), F.lit(0)).alias("kept_chars"),
    )


def data_card(totals: DataFrame, title: str, source: str, license_note: str, min_chars: int = 300, share: float = 0.45) -> DataFrame:
    """Markdown card, one row."""
    parts = [
        F.lit(f"# Data card: {title}\n"),
        F.lit(f"## Source\n{source}\n"),
        F.lit("## Size"),
        F.concat(F.lit("- Raw documents: "), F.col("raw_documents").cast("string")),
        F.concat(F.lit("- Kept documents: "), F.col("kept_documents").cast("string")),
        F.concat(F.lit("- Total kept characters: "), F.col("kept_chars").cast("string"), F.lit("\n")),
        F.lit("## Filtering\n- Removed exact duplicates"),
        F.lit(f"- Removed documents shorter than {min_chars} characters"),
        F.lit(f"- Required script share >= {share}\n"),
        F.lit("## Known limitations\n- Human language review is still required\n"),
        F.lit(f"## License\n{license_note}\n"),
    ]
    return totals.select(F.concat_ws("\n", *parts).alias("card"))


def breakdown(clean: DataFrame, key: str) -> DataFrame:
    """Per-source or per-licence rows of the card."""
    return clean.groupBy(key).agg(
        F.count("*").alias("documents"),
        F.count_if("keep").alias("kept"),
        F.coalesce(F.sum(F.when(F.col("keep"), F.col("chars"))), F.lit(0)).alias("kept_chars"),
    )


def as_json(df: DataFrame, out: str = "json") -> DataFrame:
    return df.select(F.to_json(F.struct("*")).alias(out))
