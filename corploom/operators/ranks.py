"""Row numbers and running totals within groups, of which no task needs to hold one whole."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from corploom.operators.lookup import settled


def running_totals(counts: DataFrame, group: list[str], bucket: str, n: str, block: int = 1024) -> DataFrame:
    """(group, bucket, `before`): sum of `n` over the group's smaller buckets.

    Two levels: no window holds more than `block` buckets or the number of blocks.
    """
    blocks = counts.withColumn("_block", F.floor(F.col(bucket) / block))
    inner = Window.partitionBy(*group, "_block").orderBy(bucket).rowsBetween(Window.unboundedPreceding, -1)
    outer = Window.partitionBy(*group).orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        blocks.groupBy(*group, "_block")
        .agg(F.sum(n).alias("_sum"))
        .select(*group, "_block", F.coalesce(F.sum("_sum").over(outer), F.lit(0)).alias("_base"))
    )
    return (
        blocks.join(starts, [*group, "_block"])
        .withColumn("before", F.coalesce(F.sum(n).over(inner), F.lit(0)) + F.col("_base"))
        .select(*group, bucket, "before")
    )


def row_numbers(rows: DataFrame, group: str, key: str, name: str) -> DataFrame:
    """`key` and `name`, the place of each row in its group's order of `key`, from 1; a null group is a group.

    Spark's range partitions of (group, key) are the buckets: a window numbers the rows of one
    bucket alone, and running totals of the bucket counts tell where it begins in its group.
    """
    named = rows.select(F.coalesce(F.concat(F.lit("="), F.col(group).cast("string")), F.lit("")).alias("_group"), key)
    placed = settled(named.repartitionByRange("_group", key).withColumn("_bucket", F.spark_partition_id()))
    begins = running_totals(placed.groupBy("_group", "_bucket").agg(F.count("*").alias("_rows")), ["_group"], "_bucket", "_rows")
    inside = Window.partitionBy("_group", "_bucket").orderBy(key)
    return (
        placed.withColumn("_number", F.row_number().over(inside))
        .join(begins, ["_group", "_bucket"])
        .select(key, (F.col("before") + F.col("_number")).cast("int").alias(name))
    )
