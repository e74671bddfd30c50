"""Alignment by vector similarity, exact and blocked, and what follows from it."""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corploom.functions import text as tx
from corploom.operators.lookup import settled

_SLACK = 1e-7
# Left and right rows that meet at once: what a worker holds is this many scores.
_ROWS, _COLUMNS = 256, 4096
# Components of pairs scored one by one, where few can be among the best; where more can, all are scored at once.
_SINGLE = 1 << 21
# More than what rounding a score to 12 digits moves it by, on both sides.
_ROUNDED = 1e-11

# Functions of this module travel to the workers whole, so these need no copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def corpus_slice(df: DataFrame, order: str, head: int = 80, size: int = 50, names: tuple[str, str] = ("tat", "rus")) -> DataFrame:
    """First rows by `order`, first two string columns, nulls dropped, then the first `size`."""
    strings = [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)][:2]
    first = df.orderBy(order).limit(head).select(order, *strings).dropna(subset=strings)
    return first.orderBy(order).limit(size).toDF(order, *names)


def shuffled(df: DataFrame, row_id: str, seed: int = 7) -> Column:
    """Sort key of a repeatable shuffle."""
    return tx.seeded_md5(row_id, seed=seed)


def _unit(vectors: pd.Series) -> np.ndarray:
    m = np.array(vectors.to_list(), dtype=np.float64)
    norms = np.linalg.norm(m, axis=1, keepdims=True)
    return np.divide(m, norms, out=np.zeros_like(m), where=norms > 0)


def _pivots(df: DataFrame, row_id: str, vector: str, cells: int) -> np.ndarray:
    """At most `cells` vectors, chosen by hash. They steer the work, never the result."""
    rows = df.orderBy(tx.seeded_md5(row_id, seed=3)).select(vector).limit(cells).collect()
    return _unit(pd.Series([r[0] for r in rows]))


def _placed(df: DataFrame, row_id: str, vector: str, pivots, prefix: str) -> DataFrame:
    """(id, v, cell, angles): the vector as it came, nearest pivot, angle to every pivot."""

    def place(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        p = pivots.value
        for b in batches:
            if not len(b):
                continue
            angles = np.arccos(np.clip(_unit(b["v"]) @ p.T, -1.0, 1.0))
            yield pd.DataFrame(
                {"id": b["id"], "v": b["v"], "cell": angles.argmin(axis=1).astype("int32"), "angles": list(angles)}
            )

    types = {c: df.schema[c].dataType.simpleString() for c in (row_id, vector)}
    placed = df.select(F.col(row_id).alias("id"), F.col(vector).alias("v")).mapInPandas(
        place, f"id {types[row_id]}, v {types[vector]}, cell int, angles array<double>"
    )
    return placed.select(F.col("id").alias(f"{prefix}_id"), "v", "cell", "angles")


def _blocked(rows: DataFrame, own: str, other: str, side: str, block: int) -> DataFrame:
    """Cut every cell of one side into blocks of about `block` rows, and repeat each row for the blocks of the other side."""
    mine = F.pmod(F.xxhash64(f"{side}_id"), F.col(own)).cast("int")
    return rows.withColumn(f"_{side}", mine).withColumn(
        "_other", F.explode(F.sequence(F.lit(0), F.col(other) - 1))
    )


def _first(rows: np.ndarray, columns: np.ndarray, kept: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of (row, column, score) the `n` highest finite scores per row, in order; ties: lowest column."""
    order = np.lexsort((columns, -kept, rows))
    rows, columns, kept = rows[order], columns[order], kept[order]
    taken = (np.arange(len(rows)) - np.searchsorted(rows, rows) < n) & np.isfinite(kept)
    return rows[taken], columns[taken], kept[taken]


def _best_of(scores: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, column, score to 12 digits) of the `n` highest finite scores per row; ties: lowest column."""
    n = min(n, scores.shape[1])
    least = scores.max(axis=1) if n == 1 else np.partition(scores, -n, axis=1)[:, -n]
    rows, columns = np.nonzero(scores >= least[:, None] - _ROUNDED)
    return _first(rows, columns, np.round(scores[rows, columns], 12), n)


def _best_pairs(
    l: np.ndarray, r: np.ndarray, l_ids: np.ndarray, r_ids: np.ndarray, floor: np.ndarray, n: int, exclude_same: bool
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, column, score) of the `n` best columns per row of `l` against `r`, slice by slice.

    Single precision rules out what can't reach a row's floor, or its n-th best score so
    far, even with the largest rounding error; the rest is scored in double precision.
    """
    exclude_same = exclude_same and bool(np.isin(l_ids, r_ids).any())
    lows, highs = l.astype(np.float32), np.ascontiguousarray(r.T, dtype=np.float32)
    longest = [np.linalg.norm(m, axis=1).max(initial=0.0) for m in (l, r)]
    error = _ROUNDED + (l.shape[1] + 8) * float(np.finfo(np.float32).eps) * longest[0] * longest[1]
    found = []
    for begin in range(0, len(l), _ROWS):
        part = slice(begin, begin + _ROWS)
        bar, best = floor[part].copy(), (np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0))
        for at in range(0, len(r), _COLUMNS):
            cols = slice(at, at + _COLUMNS)
            near = lows[part] @ highs[:, cols] >= np.nextafter((bar - error).astype(np.float32), np.float32(-np.inf))[:, None]
            hits = np.flatnonzero(near)
            if not len(hits):
                continue
            if len(hits) * l.shape[1] <= _SINGLE:
                rows, columns = np.divmod(hits, near.shape[1])
                if exclude_same:
                    other = l_ids[part][rows] != r_ids[cols][columns]
                    rows, columns = rows[other], columns[other]
                kept = np.round(np.einsum("ij,ij->i", l[part][rows], r[cols][columns]), 12)
            else:
                scores = l[part] @ r[cols].T
                if exclude_same:
                    scores[l_ids[part][:, None] == r_ids[cols][None, :]] = -np.inf
                rows, columns, kept = _best_of(scores, n)
            best = _first(*(np.concatenate(x) for x in zip(best, (rows, columns + at, kept))), n)
            full = np.flatnonzero(np.bincount(best[0], minlength=len(bar)) == n)
            last = np.searchsorted(best[0], full, "right") - 1
            bar[full] = np.maximum(bar[full], best[2][last])
        reached = best[2] >= floor[part][best[0]]
        found.append((best[0][reached] + begin, best[1][reached], best[2][reached]))
    return tuple(np.concatenate(x) for x in zip(*found))


def _block_top(left: DataFrame, right: DataFrame, k: int, block: int, exclude_same: bool) -> DataFrame:
    """Best `k` right rows per left row within each shared cell, as blocked matrix products.

    Left rows may bring a `floor`; pairs below it are left out.
    """

    def per_cell(df: DataFrame, name: str) -> DataFrame:
        return df.groupBy("cell").agg(F.ceil(F.count("*") / F.lit(block)).cast("int").alias(name))

    blocks = per_cell(left, "nl").join(per_cell(right, "nr"), "cell")
    blocks = F.broadcast(blocks)  # one row per cell
    floors = ["floor"] if "floor" in left.columns else []
    l = _blocked(left.join(blocks, "cell"), "nl", "nr", "left", block).select(
        "left_id", "v", *floors, "cell", F.col("_left").alias("bl"), F.col("_other").alias("br")
    )
    r = _blocked(right.join(blocks, "cell"), "nr", "nl", "right", block).select(
        "right_id", "v", "cell", F.col("_other").alias("bl"), F.col("_right").alias("br")
    )

    def best(key, a: pd.DataFrame, b: pd.DataFrame) -> pd.DataFrame:
        b = b.sort_values("right_id", kind="stable")
        if not len(a) or not len(b):
            return pd.DataFrame({"left_id": a["left_id"][:0], "right_id": b["right_id"][:0], "score": []})
        l, r = _unit(a["v"]), _unit(b["v"])
        floor = a["floor"].fillna(-np.inf).to_numpy(float) if "floor" in a else np.full(len(a), -np.inf)
        left_ids, right_ids = a["left_id"].to_numpy(), b["right_id"].to_numpy()
        # a vector that is not finite has no score
        whole_l, whole_r = np.isfinite(l).all(axis=1), np.isfinite(r).all(axis=1)
        if not (whole_l.all() and whole_r.all()):
            l, floor, left_ids, r, right_ids = l[whole_l], floor[whole_l], left_ids[whole_l], r[whole_r], right_ids[whole_r]
        if not len(l) or not len(r):
            return pd.DataFrame({"left_id": left_ids[:0], "right_id": right_ids[:0], "score": []})
        rows, columns, kept = _best_pairs(l, r, left_ids, right_ids, floor, k, exclude_same)
        return pd.DataFrame({"left_id": left_ids[rows], "right_id": right_ids[columns], "score": kept})

    lt = left.schema["left_id"].dataType.simpleString()
    rt = right.schema["right_id"].dataType.simpleString()
    keys = ["cell", "bl", "br"]
    return l.groupBy(*keys).cogroup(r.groupBy(*keys)).applyInPandas(best, f"left_id {lt}, right_id {rt}, score double")


def _ranked(pairs: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("left_id").orderBy(F.desc("score"), "right_id")
    return pairs.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def top_matches(
    left: DataFrame,
    right: DataFrame,
    left_id: str,
    right_id: str,
    vector: str,
    k: int = 1,
    exclude_same: bool = False,
    cells: int = 32,
    block: int = 32768,
) -> DataFrame:
    """(left_id, right_id, score, rank): the k most similar right rows of every left row, exactly.

    The right side is divided into cells around pivot vectors. A first pass looks into
    each left row's own cell and yields a lower bound; the second visits only cells that
    can still beat it (angle to the pivot less the cell's radius). Cells are cut into
    blocks on both sides, so a task holds about `block` rows of each side however large a
    cell is, and of a left row at most k pairs that reach its bound leave a block. A row is
    copied once for every block of the other side that it meets, in the type it came in.
    """
    spark = right.sparkSession
    pivots = spark.sparkContext.broadcast(_pivots(right, right_id, vector, cells))
    r = settled(_placed(right, right_id, vector, pivots, "right"))
    l = settled(_placed(left, left_id, vector, pivots, "left"))
    reach = r.groupBy("cell").agg(F.max(F.element_at("angles", F.col("cell") + 1)).alias("radius"))
    r = r.drop("angles")
    home = _block_top(l.drop("angles"), r, k, block, exclude_same)
    home = settled(home)
    floor = _ranked(home, k).groupBy("left_id").agg(F.when(F.count("*") >= k, F.min("score")).alias("floor"))
    cells_with_reach = reach.agg(F.collect_list(F.struct("cell", "radius"))).scalar()
    bounded = l.join(floor, "left_id", "left").select(
        "left_id", "v", F.col("cell").alias("home"), "angles", "floor", F.explode(cells_with_reach).alias("c")
    )
    nearest = F.greatest(F.element_at("angles", F.col("c.cell") + 1) - F.col("c.radius"), F.lit(0.0))
    visits = bounded.filter(
        (F.col("c.cell") != F.col("home"))
        & (F.col("floor").isNull() | (F.cos(nearest) + F.lit(_SLACK) >= F.col("floor")))
    ).select("left_id", "v", "floor", F.col("c.cell").alias("cell"))
    away = _block_top(visits, r, k, block, exclude_same)
    return _ranked(home.unionByName(away), k)


def alignment_report(matches: DataFrame, threshold: float = 0.5) -> DataFrame:
    return matches.agg(
        F.count("*").alias("pairs"),
        F.round(F.avg(F.col("correct_exact").cast("double")), 6).alias("exact_alignment_accuracy"),
        F.count_if(F.col("score") < threshold).alias("low_confidence_pairs"),
    )


def segments(df: DataFrame, row_id: str, text: str, language: str, source: str) -> DataFrame:
    """Sentence-like segments with an id of document and position."""
    return df.select(
        F.col(row_id).alias("doc_id"),
        F.posexplode(tx.sentences(F.col(text))).alias("pos", "text"),
        F.col(language).alias("language"),
        F.col(source).alias("source"),
    ).select(F.concat_ws("-", "doc_id", "pos").alias("segment_id"), "doc_id", "text", "language", "source")


def mined_pairs(matches: DataFrame, left: DataFrame, right: DataFrame, min_score: float, max_ratio: float) -> DataFrame:
    """Candidates that pass score, length ratio and language; status waits for a person.

    `left`/`right` bring (left_id | right_id, chars, language, source).
    """
    a = left.select("left_id", F.col("chars").alias("left_chars"), F.col("language").alias("left_language"), F.col("source").alias("left_source"))
    b = right.select("right_id", F.col("chars").alias("right_chars"), F.col("language").alias("right_language"), F.col("source").alias("right_source"))
    ratio = F.greatest("left_chars", "right_chars") / F.greatest(F.least("left_chars", "right_chars"), F.lit(1))
    return (
        matches.filter(F.col("score") >= min_score)
        .join(a, "left_id")
        .join(b, "right_id")
        .withColumn("length_ratio", ratio)
        .filter((F.col("length_ratio") <= max_ratio) & (F.col("left_language") != F.col("right_language")))
        .withColumn("review_status", F.lit("unreviewed"))
    )
