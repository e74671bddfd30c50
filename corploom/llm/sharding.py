"""Shards that each hold the mixture of the sources: proportional stratified interleaving."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from corploom.llm.shared import running_totals, settled, shared_table

# Rows that one window ranks; sources and the whole are cut into hash buckets of about this many.
BUCKET_ROWS = 4096


def interleave(
    rows: DataFrame, shards: int, source: str, key: str, ties: list[str], seed: int = 17, bucket_rows: int = BUCKET_ROWS
) -> DataFrame:
    """The columns of `rows` plus shard and slot.

    Rows are ranked in a seeded order within their source; rank r of n stands at
    (r - 1 + u) / n with a share u that follows from the source's name, and the rows in the
    order of these fractions are cut into `shards` runs. So any run holds every source in
    proportion, and row counts differ by one at most.

    Ranks are counted in buckets: a histogram gives where each bucket begins, a window ranks
    inside it, so neither a hot source nor the whole is sorted by one task. Rows alike in key
    and `ties` are interchangeable, hence reruns agree. A null source is a source; null keys
    follow the hash of null. An empty table gives no rows.
    """
    name = F.coalesce(F.concat(F.lit("="), F.col(source).cast("string")), F.lit(""))
    position = F.shiftrightunsigned(
        F.xxhash64(F.lit(seed), F.coalesce(F.col(key).cast("string"), F.lit("\x00null")), *ties), 1
    )
    base = settled(rows.select("*", name.alias("_source"), position.alias("_hash")))
    counts = base.groupBy("_source").agg(F.count("*").alias("_n"))
    sizes = shared_table(
        counts.select(
            "_source",
            "_n",
            F.ceil(F.col("_n") / bucket_rows).alias("_buckets"),
            (F.shiftrightunsigned(F.xxhash64(F.lit(seed), "_source"), 11) / float(1 << 53)).alias("_share"),
        ),
        "shard-sources",
    )
    total = sizes.agg(F.sum("_n")).first()[0] or 0
    placed = base.join(sizes, "_source").withColumn(
        "_bucket", F.shiftright(F.shiftright("_hash", 32) * F.col("_buckets"), 31)
    )
    begins = running_totals(
        placed.groupBy("_source", "_bucket").agg(F.count("*").alias("_rows")), ["_source"], "_bucket", "_rows"
    )
    inside = Window.partitionBy("_source", "_bucket").orderBy("_hash", key, *ties)
    ranked = placed.withColumn("_rank", F.row_number().over(inside)).join(begins, ["_source", "_bucket"])
    ranked = ranked.withColumn("_at", (F.col("before") + F.col("_rank") - 1 + F.col("_share")) / F.col("_n")).drop("before")
    pieces = max(1, -(-total // bucket_rows))
    ranked = settled(ranked.withColumn("_piece", F.least(F.floor(F.col("_at") * pieces), F.lit(pieces - 1))))
    begins = running_totals(ranked.groupBy("_piece").agg(F.count("*").alias("_rows")), [], "_piece", "_rows")
    across = Window.partitionBy("_piece").orderBy("_at", "_source", "_rank", key, *ties)
    place = (F.col("before") + F.col("_order") - 1).cast("long")
    return (
        ranked.withColumn("_order", F.row_number().over(across))
        .join(begins, "_piece")
        .withColumn("_place", place)
        .withColumn("shard", F.expr(f"cast(_place * {shards} div {max(1, total)} as int)"))
        .withColumn("slot", F.expr(f"_place - (cast(shard as bigint) * {max(1, total)} + {shards - 1}) div {shards}"))
        .select(*rows.columns, "shard", "slot")
    )


def shard_table(
    docs: DataFrame, shards: int = 40, text: str = "text", source: str = "source", key: str = "doc_id", seed: int = 17
) -> DataFrame:
    """doc_id, size (UTF-8 bytes plus 16), text_crc32, law, shard, slot and grown_shard for every row.

    The law is `rows`: counts differ by one at most. A null text has no bytes (size 16, CRC 0).
    Rows of equal texts are placed like any others, rows alike in everything are interchangeable.
    Columns beside key, text and source are left out, whatever their names. Only these measures are
    shuffled, never the text.
    """
    content = F.coalesce(F.col(text), F.lit(""))
    rows = docs.select(
        F.col(key).alias("doc_id"),
        F.col(source).alias("source"),
        (F.octet_length(content) + 16).cast("long").alias("size"),
        F.crc32(content.cast("binary")).alias("text_crc32"),
    )
    return interleave(rows, shards, "source", "doc_id", ["text_crc32", "size"], seed).select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("rows").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
        "source",
    )
