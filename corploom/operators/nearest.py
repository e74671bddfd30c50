"""A nearest-neighbour index of sign projections: candidates by equi-join, exact rescoring."""

from __future__ import annotations

import math
import sys
from collections.abc import Iterator
from hashlib import md5

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corploom.operators import align
from corploom.operators.lookup import settled

# Components are cut to whole multiples of this before they are projected, so that every engine finds the same signs.
GRAIN = 1 << 20

cloudpickle.register_pickle_by_value(sys.modules[__name__])


def bits_for(rows: int) -> int:
    """Bits of a bucket number: about the square root of the number of rows are buckets."""
    return max(1, round(math.log2(max(rows, 2)) / 2))


def planes(tables: int, bits: int, dims: int) -> np.ndarray:
    """tables * bits directions of +1 and -1, by the first half-byte of md5('table:bit:dimension')."""
    sign = lambda t, b, d: 1.0 if md5(f"{t}:{b}:{d}".encode()).hexdigest()[0] < "8" else -1.0
    return np.array([[sign(t, b, d) for d in range(dims)] for t in range(tables) for b in range(bits)]).reshape(tables * bits, dims)


def bucketed(df: DataFrame, row_id: str, vector: str, dims: int, tables: int, bits: int, probes: int, prefix: str) -> DataFrame:
    """(<prefix>_id, v, cell): each row once for every table and probe.

    `cell` packs table and bucket; beyond its own bucket a row may be placed in those that differ
    in one bit, those with the smallest projections first (ties: lower bit), up to `probes` in all.
    """
    directions = planes(tables, bits, dims)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            m = np.array(batch.column(1).to_pylist(), float).reshape(batch.num_rows, dims)
            x = (np.floor(m * GRAIN) @ directions.T).reshape(-1, tables, bits)
            own = ((x >= 0) << np.arange(bits)).sum(2)
            near = np.argsort(np.abs(x), axis=2, kind="stable")[:, :, : probes - 1]
            buckets = np.concatenate([own[:, :, None], own[:, :, None] ^ (1 << near)], axis=2)
            cells = (buckets + (np.arange(tables) << bits)[None, :, None]).reshape(batch.num_rows, -1)
            norms = np.linalg.norm(m, axis=1, keepdims=True)
            unit = np.divide(m, norms, out=np.zeros_like(m), where=norms > 0)
            lists = lambda a, kind: pa.array(a.tolist(), pa.list_(kind))
            yield pa.RecordBatch.from_arrays([batch.column(0), lists(unit, pa.float64()), lists(cells, pa.int64())], ["id", "v", "cells"])

    kind = df.schema[row_id].dataType.simpleString()
    rows = df.select(F.col(row_id).alias("id"), F.col(vector).cast("array<double>").alias("v"))
    placed = rows.mapInArrow(place, f"id {kind}, v array<double>, cells array<bigint>")
    return placed.select(F.col("id").alias(f"{prefix}_id"), "v", F.explode("cells").alias("cell"))


def nearest(
    left: DataFrame,
    right: DataFrame,
    left_id: str,
    right_id: str,
    vector: str,
    k: int = 1,
    exclude_same: bool = False,
    tables: int = 10,
    bits: int | None = None,
    probes: int | None = None,
    block: int = 4096,
) -> DataFrame:
    """(left_id, right_id, score, rank): the k most similar right rows among those that share a bucket.

    Scores are exact cosines; only candidates may be missed. The right side is placed once in
    each table, the left side in `probes` buckets of each (all that differ in at most one bit,
    unless told otherwise), so a vector is copied at most tables x probes times, and once more for each
    further block of a bucket with over `block` rows, which no task then holds whole. With
    2**bits near the square root of the right rows, a left row meets tables x probes x sqrt(n) rows, not n.
    A pair whose bits agree with chance p each is found with 1 - (1 - p**b - b * p**(b-1) * (1-p))**tables.

    Rows with a null vector, or one of another length than the longest, take no part (they have no cosine
    with the others); a zero vector scores 0; ties go to the lower right id; without right
    rows the result is empty.
    """
    usable = lambda df: df.filter(F.col(vector).isNotNull() & ~F.exists(vector, lambda x: x.isNull() | F.isnan(x)))
    right, left = usable(right), usable(left)
    total, dims = right.agg(F.count("*"), F.coalesce(F.max(F.size(vector)), F.lit(0))).first()
    bits = bits or bits_for(total)
    probes = min(probes or bits + 1, bits + 1)
    full = F.size(vector) == dims
    r = settled(bucketed(right.filter(full), right_id, vector, dims, tables, bits, 1, "right"))
    l = settled(bucketed(left.filter(full), left_id, vector, dims, tables, bits, probes, "left"))
    found = align._block_top(l, r, k, block, exclude_same).dropDuplicates(["left_id", "right_id"])
    return align._ranked(found, k)
