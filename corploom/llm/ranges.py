"""Removing ranges of words or bytes from documents; a bit filter of bounded size that prunes earlier scans."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# 2**27 bits are 16 MB for the driver and each worker, whatever the data. A fuller filter passes
# more rows to the exact step behind it and never loses one.
FILTER_BITS = 27
# For filters of document keys and sets, of which there are far fewer: 2 MB.
KEY_BITS = 24
_PAGE_BITS = 12
_SECOND = 0xD6E8FEB86659FD93


def _bits(h: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    shift = np.uint64(64 - bits)
    return (h >> shift).astype(np.int64), ((h * np.uint64(_SECOND)) >> shift).astype(np.int64)


def bit_filter(hashes: DataFrame, column: str, bits: int = FILTER_BITS) -> Broadcast:
    """A broadcast bit table that holds every value of a long column: each page is made by a
    group of at most 4,096 bit numbers, and pages together are 2**bits bits."""

    def places(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, b = _bits(batch.column(0).to_numpy(zero_copy_only=False).view(np.uint64), bits)
            both = np.unique(np.concatenate([a, b]))
            yield pa.RecordBatch.from_arrays(
                [pa.array((both >> _PAGE_BITS).astype(np.int32)), pa.array((both & ((1 << _PAGE_BITS) - 1)).astype(np.int16))], ["page", "bit"]
            )

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            pages = []
            for found in batch.column(1):
                flags = np.zeros(1 << _PAGE_BITS, np.uint8)
                flags[found.values.to_numpy(zero_copy_only=False)] = 1
                pages.append(np.packbits(flags, bitorder="little").tobytes())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(pages, pa.binary())], ["page", "bits"])

    pages = (
        hashes.select(column)
        .mapInArrow(places, "page int, bit short")
        .groupBy("page")
        .agg(F.collect_set("bit").alias("found"))
        .mapInArrow(pack, "page int, bits binary")
    )
    table = bytearray(1 << (bits - 3))
    width = 1 << (_PAGE_BITS - 3)
    for page, content in pages.collect():
        table[page * width : (page + 1) * width] = content
    return hashes.sparkSession.sparkContext.broadcast(bytes(table))


def passes(table: bytes, h: np.ndarray) -> np.ndarray:
    """True for each hash that may be in the table."""
    bits = np.frombuffer(table, np.uint8)
    a, b = _bits(h, (len(table) * 8).bit_length() - 1)
    hit = lambda i: ((bits[i >> 3] >> (i & 7).astype(np.uint8)) & 1).astype(bool)
    return hit(a) & hit(b)


def row_key(key: str, text: str) -> Column:
    """A row's number inside the operators: rows alike in key and text share it and their fate."""
    return F.xxhash64(F.coalesce(F.col(key).cast("string"), F.lit("\x00null")), F.coalesce(F.col(text), F.lit("")))


def remove_ranges(
    docs: DataFrame, ranges: DataFrame, key: str, text: str, cut: Callable[[bytes, list[int], list[int]], dict], schema: str
) -> DataFrame:
    """`key` and the columns of `schema` for every row of `docs`.

    `ranges` has (_key, _from, _to). `cut(text, starts, ends)` gives the result columns of one
    text; texts that no range can concern, by a bit filter of the keys, are finished in the scan,
    so that only the others are shuffled. Ranges are made distinct before they are gathered, so a
    document's list is bounded by its length however often its row is repeated.
    """
    distinct = ranges.groupBy("_key", "_from", "_to").agg(F.lit(1).alias("_one"))
    gathered = distinct.groupBy("_key").agg(
        F.collect_list("_from").alias("_starts"), F.collect_list("_to").alias("_ends")
    )
    concerned = bit_filter(ranges.select("_key").distinct(), "_key")
    kind = docs.schema[key].dataType
    fields = T.StructType.fromDDL(schema)
    names = fields.names
    result = pa.schema([(f.name, _arrow(f.dataType)) for f in fields])

    def first(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in _parts(batch):
                hit = passes(concerned.value, part.column(1).to_numpy(zero_copy_only=False).view(np.uint64))
                rows = [
                    dict.fromkeys(names) if h else cut((t.as_py() or "").encode(), [], [])
                    for h, t in zip(hit, part.column(2), strict=True)
                ]
                done = pa.RecordBatch.from_pylist(rows, schema=result)
                texts = [(t.as_py() or "") if h else None for h, t in zip(hit, part.column(2), strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), pa.array(texts, pa.string()), *done.columns], ["_id", "_key", "_text", *names]
                )

    def second(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in _parts(batch):
                rows = part.select(names).to_pylist()
                for i, t in enumerate(part.column("_text")):
                    if t.is_valid:
                        starts, ends = part.column("_starts")[i].as_py() or [], part.column("_ends")[i].as_py() or []
                        rows[i] = cut(t.as_py().encode(), starts, ends)
                done = pa.RecordBatch.from_pylist(rows, schema=result)
                yield pa.RecordBatch.from_arrays([part.column("_id"), *done.columns], [key, *names])

    begun = T.StructType(
        [T.StructField("_id", kind), T.StructField("_key", T.LongType()), T.StructField("_text", T.StringType()), *fields]
    )
    rows = docs.select(F.col(key).alias("_id"), row_key(key, text).alias("_key"), F.col(text).alias("_text"))
    joined = rows.mapInArrow(first, begun).join(gathered, "_key", "left")
    return joined.mapInArrow(second, T.StructType([T.StructField(key, kind), *fields]))


def _parts(batch: pa.RecordBatch, rows: int = 512) -> Iterator[pa.RecordBatch]:
    for at in range(0, batch.num_rows, rows):
        yield batch.slice(at, rows)


def _arrow(kind: T.DataType) -> pa.DataType:
    return {T.LongType(): pa.int64(), T.StringType(): pa.string()}[kind]


def one_of_each(docs: DataFrame, marks: DataFrame, number: str) -> DataFrame:
    """The rows of `docs` without those that `marks` drops, and one of the rows that share a number.

    `marks` has (`number`, kept) for every number that several rows share or that is dropped; a
    number (a long) is a hash of what makes rows alike. A bit filter lets most rows through
    without a shuffle; of the few that it may concern, one of each number is left before the
    numbers themselves are compared, so that no repeated row is hot.
    """
    known = bit_filter(marks.select(number), number, KEY_BITS)
    place = docs.columns.index(number)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hit = passes(known.value, batch.column(place).to_numpy(zero_copy_only=False).view(np.uint64))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(hit)], [*batch.schema.names, "_concerned"])

    schema = T.StructType([*docs.schema.fields, T.StructField("_concerned", T.BooleanType())])
    flagged = docs.mapInArrow(scan, schema)
    clear = flagged.filter("not _concerned").select(*docs.columns)
    rest = flagged.filter("_concerned").select(*docs.columns).dropDuplicates([number])
    return clear.unionByName(rest.join(marks.filter("not kept").select(number), number, "left_anti").select(*docs.columns))
