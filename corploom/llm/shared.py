"""Helpers of the operators: tables in the shared folder, and those of the library."""

from __future__ import annotations

import gc

from pyspark.sql import DataFrame, SparkSession

from corploom.operators.lookup import settled
from corploom.operators.ranks import running_totals
from corploom.session import shared_folder

__all__ = ["drop_folder", "release", "running_totals", "settled", "shared_folder", "shared_table"]


def shared_table(df: DataFrame, name: str) -> DataFrame:
    """The table written once to the shared folder; read back, its size is known to the planner,
    which then broadcasts it only if it is short."""
    path = shared_folder(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def drop_folder(spark: SparkSession, path: str) -> None:
    """Remove a folder of this run, once nothing reads it any more."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


def release(spark: SparkSession) -> None:
    """Let go of what earlier jobs left on the driver and executors: broadcasts, shuffle files, checkpoints, generated code.

    Spark drops them once the driver's garbage collector finds their handles unused, which in a
    driver with room to spare may be half an hour later.
    """
    gc.collect()
    spark._jvm.System.gc()
