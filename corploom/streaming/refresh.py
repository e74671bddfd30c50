"""Scheduled refresh: take in what landed since the last run, once, then stop."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from corploom.operators import quality
from corploom.sources.files import read_or_else

DOCUMENT_SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"


def refresh_texts(
    spark: SparkSession, landing: str, table: str, state: str, script: str, schema: str = DOCUMENT_SCHEMA
) -> StreamingQuery:
    """Clean new files of `landing` and append texts not stored yet to `table`.

    `state` keeps the file log of the stream. Each batch looks up its hashes in the
    stored table, so text that comes again under another name is not stored twice,
    and a batch that runs again after a lost executor first drops what it wrote before.
    """
    stream = spark.readStream.schema(schema).parquet(landing)

    def store(batch: DataFrame, batch_id: int) -> None:
        clean = quality.clean_corpus(batch, "text", "doc_id", script)
        clean = clean.filter("NOT duplicate")
        empty = clean.select("text_hash", F.lit(0).cast("long").alias("batch")).limit(0)
        known = read_or_else(spark, table, empty).filter(F.col("batch") != batch_id).select("text_hash").distinct()
        fresh = clean.join(known, "text_hash", "left_anti").withColumn("batch", F.lit(batch_id).cast("long"))
        (
            fresh.write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy("batch")
            .parquet(table)
        )

    return (
        stream.writeStream.foreachBatch(store)
        .option("checkpointLocation", state)
        .trigger(availableNow=True)
        .start()
    )
