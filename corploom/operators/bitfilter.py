"""A bit table of bounded size that tells in the scan which rows a list cannot concern; built-in expressions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# 2**23 bits are 1 MB for the driver and each executor, whatever the data; a shorter list has a smaller table.
# A fuller table lets more rows through to the exact step behind it and never loses one.
MOST_BITS, LEAST_BITS = 23, 12


def bits_for(hashes: DataFrame) -> int:
    """Sixteen bits for each hash of a settled table, within bounds."""
    return min(MOST_BITS, max(LEAST_BITS, (16 * hashes.count()).bit_length()))


def _bits(h: Column, bits: int) -> list[Column]:
    """Two bit numbers of a 64-bit hash."""
    return [F.shiftrightunsigned(h, 64 - bits), h.bitwiseAND((1 << bits) - 1)]


def bit_table(hashes: DataFrame, column: str, bits: int) -> Column:
    """The table of a long column, as one array value; words are folded before the shuffle."""
    places = hashes.select(F.explode(F.array(*_bits(F.col(column), bits))).alias("bit"))
    words = places.groupBy(F.shiftright("bit", 6).alias("at")).agg(
        F.bit_or(F.call_function("shiftleft", F.lit(1).cast("bigint"), F.col("bit").bitwiseAND(63).cast("int"))).alias("word")
    )
    every = hashes.sparkSession.range(1 << (bits - 6)).withColumnRenamed("id", "at").join(words, "at", "left")
    listed = F.array_sort(F.collect_list(F.struct("at", F.coalesce("word", F.lit(0).cast("bigint")).alias("word"))))
    return every.agg(F.transform(listed, lambda x: x["word"])).scalar()


def may_hold(table: Column, h: Column, bits: int) -> Column:
    """False only if the hash is not in the table."""
    hit = [F.getbit(F.get(table, F.shiftright(b, 6).cast("int")), b.bitwiseAND(63).cast("int")) == 1 for b in _bits(h, bits)]
    return hit[0] & hit[1]


# Bytes of hits (as text) up to which they travel to the rows instead.
BROADCAST_BYTES = 8 << 20


def join_hits(df: DataFrame, hits: DataFrame, key: str, broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """Left join of `df` to `hits` (settled, one row per key, few of all); only the rows concerned are shuffled.

    Hits of few bytes, which are measured, are broadcast. Else a row whose key a bit table of the hits rules
    out is finished in the scan, with nulls, and the others meet `hits`.
    """
    size = hits.agg(F.coalesce(F.sum(F.octet_length(F.to_json(F.struct("*")))), F.lit(0))).first()[0]
    if size <= broadcast_bytes:
        return df.join(F.broadcast(hits), key, "left").select(*df.columns, *[c for c in hits.columns if c != key])
    bits = bits_for(hits)
    table = bit_table(hits.select(F.xxhash64(key).alias("_h")), "_h", bits)
    concerned = F.coalesce(may_hold(table, F.xxhash64(key), bits), F.lit(False))
    values = [f for f in hits.schema.fields if f.name != key]
    clear = df.filter(~concerned).select("*", *[F.lit(None).cast(f.dataType).alias(f.name) for f in values])
    rest = df.filter(concerned).join(hits, key, "left").select(*df.columns, *[f.name for f in values])
    return clear.unionByName(rest)
