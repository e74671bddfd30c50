"""Hard negatives against brute force in whole numbers."""

import itertools
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from corploom.llm import hardnegatives as H


def brute(rows, step=10, positives=5, negatives=5, share=(80, 100), scale=256):
    taken = set()
    for key, vector, label, *_ in rows:
        if key is None or label is None or vector is None or any(x is None or not math.isfinite(x) for x in vector):
            continue
        taken.add((key, label, tuple(math.floor(scale * x) for x in vector)))
    out = []
    for anchor in taken:
        if anchor[0] % step:
            continue
        dot = lambda row: sum(a * b for a, b in zip(anchor[2], row[2], strict=False))
        scored = sorted((-max(-H._LONG, min(H._LONG, dot(r))), r[0], r[1] == anchor[1]) for r in taken if r != anchor)
        for down, key, _ in [s for s in scored if s[2]][:positives]:
            own = [s for s in scored if not s[2] and share[0] * -down <= share[1] * -s[0] <= share[1] * -down][:negatives]
            out += [(anchor[0], key, i + 1, s[1], -down, -s[0]) for i, s in enumerate(own)]
    return sorted(out)


def table(spark, rows):
    return spark.createDataFrame([(*r, "x", 1) for r in rows], "vec_id long, embedding array<double>, label int, q string, block long")


def asked(spark, rows, step=10, **more):
    return sorted(tuple(r) for r in H.mine(table(spark, rows), F.col("vec_id") % step == 0, **more).collect())


def clustered(seed, n=300, dims=6, unit=False):
    r = np.random.default_rng(seed)
    centres = r.normal(size=(5, dims))
    rows = []
    for i in range(n):
        v = centres[i % 5] + 0.4 * r.normal(size=dims)
        rows.append((i, [float(x) for x in (v / np.linalg.norm(v) if unit else np.round(v, 1))], int(r.integers(0, 4))))
    return rows


@pytest.mark.parametrize("seed,block,chunk", [(1, None, H.CHUNK_VALUES), (2, 16, 48)])
def test_by_brute_force(spark, seed, block, chunk):
    rows = clustered(seed, unit=seed == 1)
    nan, inf = float("nan"), float("inf")
    rows += [(None, [1.0] * 6, 1), (1000, None, 1), (1010, [1.0, None], 2), (1020, [nan] * 6, 1), (1030, [inf] * 6, 1), (1040, [0.5] * 6, None)]
    rows += [(1050, [], 1), (1060, [1.0, 0.5], 2), rows[10], rows[10], (10, [0.1] * 6, 2), (1070, [0.0] * 6, 0)]
    rows += [(2000 + i, [1.0] * 6, i % 2) for i in range(60)]
    assert asked(spark, rows, block_rows=block, chunk_values=chunk) == brute(rows)


def test_scores_beyond_doubles(spark):
    r = random.Random(3)
    rows = [(i, [r.choice([1e9, -1e9, 3.0, 1e300, 7e8]) for _ in range(3)], i % 3) for i in range(40)]
    assert asked(spark, rows, block_rows=8) == brute(rows)


def test_no_rows_no_anchors(spark):
    assert asked(spark, []) == []
    assert asked(spark, [(1, [1.0], 1), (2, [1.0], 2)]) == []
    assert H.mine(table(spark, [(10, [1.0], 1)]), F.col("vec_id") % 10 == 0).columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]


@pytest.mark.parametrize("dims,bits", [(2, 3), (3, 2), (2, 1)])
def test_hilbert_curve_visits_neighbours(dims, bits):
    cells = np.array(list(itertools.product(range(1 << bits), repeat=dims)))
    path = cells[sorted(range(len(cells)), key=H.hilbert_keys(cells, bits).__getitem__)]
    assert (np.abs(np.diff(path, axis=0)).sum(1) == 1).all()


def test_bounds_hold(spark):
    r = np.random.default_rng(1)
    rows, asked_ = r.integers(-50, 50, (40, 5)).astype(float), r.integers(-50, 50, (7, 5)).astype(float)
    low, high = H.bounds(asked_, rows.min(0)[None], rows.max(0)[None])
    scores = asked_ @ rows.T
    assert (low <= scores.min(1, keepdims=True)).all() and (scores.max(1, keepdims=True) <= high).all()


def test_zone_maps_leave_blocks_unread(spark):
    """On far clusters, an anchor's chunk reads a few blocks only, by their directories."""
    r = np.random.default_rng(2)
    rows = [(i, [float(x) for x in np.eye(8)[i % 8] + 0.01 * r.normal(size=8)], int(i // 8 % 2)) for i in range(800)]
    vectors = H.quantised(table(spark, rows), "vec_id", "embedding", "label", F.col("vec_id") == 0, 256)
    blocks = H.write_blocks(vectors, 25)
    assert blocks.zones.count() >= 32
    own = blocks.read(spark, F.col("anchor")).toArrow()
    chunk = H.Anchors(own.column("key").to_numpy(), np.array(own.column("label").to_pylist(), object), own.column("block").to_numpy(), H._matrix(own.column("q"), 8), np.array([[65_000.0]]))
    sent = spark.sparkContext.broadcast(chunk)
    needed = [len(H._needed(blocks, sent, own, (80, 100))) for own in (True, False)]
    assert all(1 <= n <= 6 for n in needed), needed
    plan = blocks.read(spark, F.col("block").isin([1, 2]))._jdf.queryExecution().toString()
    assert "PartitionFilters: [block" in plan
