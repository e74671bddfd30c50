"""Joins of a large table against one row per key, safe for hot keys."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corploom.session import ensure_checkpoint_dir

# A side of at most this many rows is broadcast; its rows are counted first, never guessed.
BROADCAST_ROWS = 1_000_000


def settled(df: DataFrame) -> DataFrame:
    """A table read several times, computed once and kept in the shared checkpoint folder."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint()


def lookup(
    big: DataFrame,
    small: DataFrame,
    key: str,
    spread: Column,
    count: str,
    shares: int = 1000,
    broadcast_rows: int = BROADCAST_ROWS,
) -> DataFrame:
    """Left join of `big` to `small` (one row per `key`) that no hot key can stall.

    `small[count]` says how many rows of `big` carry the key. A small side of few rows
    is broadcast. Else, keys with at least 1/`shares` of all rows number at most
    `shares`, so they are broadcast; the rest meet in an ordinary join, in which hot
    rows carry a key that matches nothing and is spread by `spread` (any evenly
    distributed column of `big`).
    """
    values = [c for c in small.columns if c not in (key, count)]
    small = settled(small)
    if small.count() <= broadcast_rows:
        return big.join(F.broadcast(small.drop(count)), key, "left").select(*big.columns, *values)
    total = small.agg(F.sum(count)).scalar()
    is_hot = F.col(count) * shares >= total
    hot = small.filter(is_hot).select(key, *[F.col(v).alias(f"_hot_{v}") for v in values], F.lit(True).alias("_hot"))
    cold = small.filter(~is_hot).select(F.col(key).cast("string").alias("_key"), *[F.col(v).alias(f"_cold_{v}") for v in values])
    marked = big.join(F.broadcast(hot), key, "left").withColumn(
        "_key", F.when(F.col("_hot"), F.concat(F.lit("\x00"), spread.cast("string"))).otherwise(F.col(key).cast("string"))
    )
    joined = marked.join(cold, "_key", "left")
    return joined.select(*big.columns, *[F.coalesce(f"_hot_{v}", f"_cold_{v}").alias(v) for v in values])


def join_keyed(
    big: DataFrame,
    small: DataFrame,
    key: str,
    spread: Column,
    how: str = "inner",
    salts: int = 16,
    broadcast_rows: int = BROADCAST_ROWS,
) -> DataFrame:
    """Join `big` (the left side) to `small`, whose keys need not be unique.

    A small side of few rows is broadcast; a longer one meets `salts` slices of `big`,
    so that a hot key is divided among that many tasks.
    """
    small = settled(small)
    if small.count() <= broadcast_rows:
        return big.join(F.broadcast(small), key, how)
    repeated = small.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    salted = big.withColumn("_salt", F.pmod(F.xxhash64(spread), F.lit(salts)).cast("int"))
    return salted.join(repeated, [key, "_salt"], how).drop("_salt")
