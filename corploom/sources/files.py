"""Tables and reports on shared storage."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

JSONL_SCHEMA = "id string, source string, text string, metadata map<string, string>"
METADATA_SCHEMA = "field string, value string"
# Scope, sources and caveat of the inventory.
SCOPE = "Initial course inventory: major living languages of peoples of Russia, no dialect-level coverage."
SOURCES = "OPUS API; Hugging Face dataset API."
CAVEAT = "Counts are API snapshots and need linguistic/community review before publication."


def read_csv(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Quoted UTF-8 CSV with a header; cells may hold line breaks."""
    return (
        spark.read.schema(schema)
        .option("header", True)
        .option("multiLine", True)
        .option("escape", '"')
        .csv(path)
    )


def write_csv(df: DataFrame, path: str) -> None:
    """CSV export: arrays are joined by '; ' as a CSV has no lists. Parquet stays the stored form."""
    flat = [
        F.array_join(F.col(f.name).cast("array<string>"), "; ").alias(f.name) if isinstance(f.dataType, T.ArrayType) else F.col(f.name)
        for f in df.schema.fields
    ]
    df.select(*flat).write.mode("overwrite").option("header", True).option("escape", '"').csv(path)


def write_table(df: DataFrame, path: str, *partitions: str) -> None:
    df.write.mode("overwrite").partitionBy(*partitions).parquet(path)


def write_report(df: DataFrame, path: str) -> None:
    """Rows as JSON objects, one per line; letters stay unescaped."""
    df.select(F.to_json(F.struct("*"), {"ignoreNullFields": "false"})).write.mode("overwrite").text(path)


def write_text(df: DataFrame, column: str, path: str) -> None:
    df.select(column).write.mode("overwrite").option("lineSep", "\n").text(path)


def read_or_else(spark: SparkSession, path: str, fallback: DataFrame) -> DataFrame:
    """The table at `path`, or the fallback (same columns) where there is none; any other fault is raised."""
    try:
        return spark.read.parquet(path).select(*fallback.columns)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return fallback


def read_package_files(spark: SparkSession, path: str) -> DataFrame:
    """(package, name, content): whole files, the package being the path of the folder they lie in."""
    whole = spark.read.text(path, wholetext=True)
    parts = F.split(F.col("_metadata.file_path"), "/")
    return whole.select(
        F.url_decode(F.array_join(F.slice(parts, F.lit(1), F.size(parts) - 1), "/")).alias("package"),
        F.url_decode(F.element_at(parts, -1)).alias("name"),
        F.col("value").alias("content"),
    )


def read_jsonl(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(JSONL_SCHEMA).json(path)


def write_jsonl(df: DataFrame, path: str, row_id: str, source: str, text: str, *metadata: str) -> None:
    pairs = [c for m in metadata for c in (F.lit(m), F.col(m).cast("string"))]
    df.select(
        F.col(row_id).cast("string").alias("id"), F.col(source).alias("source"), F.col(text).alias("text"),
        F.create_map(*pairs).alias("metadata"),
    ).write.mode("overwrite").json(path)


def write_inventory(table: DataFrame, path: str) -> None:
    """The inventory and its metadata, side by side as two tables."""
    table.write.mode("overwrite").parquet(f"{path}/inventory")
    inventory_metadata(table).write.mode("overwrite").parquet(f"{path}/metadata")


def inventory_metadata(table: DataFrame) -> DataFrame:
    checked = F.coalesce(F.max("checked_at_utc").cast("string"), F.lit(""))
    entry = lambda field, value: F.struct(F.lit(field).alias("field"), value.alias("value"))
    one = table.agg(
        F.array(
            entry("scope", F.lit(SCOPE)), entry("sources", F.lit(SOURCES)),
            entry("checked_at_utc", checked), entry("caveat", F.lit(CAVEAT)),
            entry("languages", F.count("*").cast("string")),
            entry("with_parallel", F.count_if(F.col("opus_ru_parallel_pairs") > 0).cast("string")),
            entry("parallel_pairs", F.coalesce(F.sum("opus_ru_parallel_pairs"), F.lit(0)).cast("string")),
        ).alias("m")
    )
    return one.select(F.inline("m"))
