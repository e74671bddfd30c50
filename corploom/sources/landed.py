"""Readers of landed API answers (newline-delimited JSON files), with declared schemas."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

CORPORA_ANSWER = (
    "corpora array<struct<corpus: string, source: string, target: string, alignment_pairs: string, "
    "documents: string, preprocessing: string, version: string>>"
)
CARD = (
    "id string, description string, tags array<string>, downloads bigint, likes bigint, "
    "cardData struct<dataset_info: struct<splits: array<struct<name: string, num_examples: bigint>>, "
    "features: array<struct<name: string, dtype: string>>>>, siblings array<struct<rfilename: string>>"
)
SEARCH_ANSWER = "query struct<search: array<struct<title: string, pageid: bigint>>>"
PAGES_ANSWER = "query struct<pages: map<string, struct<title: string, extract: string, fullurl: string, pageid: bigint>>>"


def read_answers(spark: SparkSession, path: str) -> DataFrame:
    """One answer per line, with the file it came from."""
    return spark.read.text(path).select(F.col("value").alias("raw"), F.col("_metadata.file_name").alias("file"))


def corpora_rows(answers: DataFrame, raw: str = "raw", *keep: str) -> DataFrame:
    """Corpora of each answer in the order given (`pos`)."""
    parsed = answers.withColumn("_a", F.from_json(F.col(raw), CORPORA_ANSWER))
    return parsed.select(*keep, F.posexplode("_a.corpora").alias("pos", "c")).select(*keep, "pos", "c.*")


def cards(answers: DataFrame, raw: str = "raw", *keep: str) -> DataFrame:
    """Dataset cards of each answer; an answer that is no list gives no rows."""
    is_list = F.startswith(F.ltrim(F.col(raw)), F.lit("["))
    parsed = answers.filter(is_list).withColumn("_a", F.from_json(F.col(raw), f"array<struct<{_struct(CARD)}>>"))
    return parsed.select(*keep, F.posexplode("_a").alias("pos", "c")).select(*keep, "pos", "c.*")


def search_hits(answers: DataFrame, raw: str = "raw", *keep: str) -> DataFrame:
    parsed = answers.withColumn("_a", F.from_json(F.col(raw), SEARCH_ANSWER))
    return parsed.select(*keep, F.posexplode("_a.query.search").alias("pos", "h")).select(*keep, "pos", "h.*")


def page_extracts(answers: DataFrame, raw: str = "raw", *keep: str) -> DataFrame:
    """Pages of each answer, keyed by page id in the source; a missing extract is ''."""
    parsed = answers.withColumn("_a", F.from_json(F.col(raw), PAGES_ANSWER))
    return parsed.select(*keep, F.explode(F.map_values("_a.query.pages")).alias("p")).select(
        *keep, "p.title", "p.pageid", F.col("p.fullurl").alias("url"), F.coalesce("p.extract", F.lit("")).alias("text")
    )


def _struct(ddl: str) -> str:
    """Top-level `name type` pairs of a DDL string as struct fields `name: type`."""
    fields, depth, start = [], 0, 0
    for i, ch in enumerate(ddl + ","):
        depth += (ch == "<") - (ch == ">")
        if ch == "," and depth == 0:
            name, kind = ddl[start:i].strip().split(" ", 1)
            fields.append(f"{name}: {kind}")
            start = i + 1
    return ", ".join(fields)
