"""Hard negatives: anchors read only those blocks of candidates whose zone maps can reach their windows."""

from __future__ import annotations

import math
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from corploom.llm.shared import drop_folder, settled, shared_folder

# Bits of each dimension in the curve, and limits of a block's rows: about 2 * sqrt(rows) between them.
CURVE_BITS = 4
LEAST_ROWS, MOST_ROWS = 256, 1 << 16
# Components of the anchors that are broadcast at once (8 bytes each); more anchors are taken in several chunks.
CHUNK_VALUES = 1 << 22
# Scores computed at once in a task.
_TILE = 1 << 21
_EXACT = 2.0**53
_LONG = (1 << 63) - 1
# Components count as this far at most on the curve, whose squares doubles must hold; their scores are not touched.
_FAR = 1e100
# Rows scored at once.
_RUN = 8192

RESULT = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"


def hilbert_keys(cells: np.ndarray, bits: int) -> list[bytes]:
    """Place of each row of `cells` (n x dimensions, `bits` bits each) on the Hilbert curve, as sortable bytes.

    Skilling's transform: undo the excess turns from the highest bit down, then Gray-encode; the
    bits are read across the dimensions, highest first.
    """
    x = cells.astype(np.int64).T.copy()
    dims = len(x)
    if not dims or not x.shape[1]:
        return [b""] * len(cells)
    for bit in range(bits - 1, 0, -1):
        high, low = 1 << bit, (1 << bit) - 1
        for i in range(dims):
            turned = (x[i] & high) != 0
            swap = np.where(turned, 0, (x[0] ^ x[i]) & low)
            x[0] ^= np.where(turned, low, swap)
            x[i] ^= swap
    for i in range(1, dims):
        x[i] ^= x[i - 1]
    flips = np.zeros_like(x[0])
    for bit in range(bits - 1, 0, -1):
        flips ^= np.where(x[-1] & (1 << bit), (1 << bit) - 1, 0)
    x ^= flips
    planes = [((x[i] >> bit) & 1).astype(np.uint8) for bit in range(bits - 1, -1, -1) for i in range(dims)]
    return [row.tobytes() for row in np.packbits(np.stack(planes, axis=1), axis=1)]


def _matrix(column: pa.Array, dims: int) -> np.ndarray:
    """Rows of an array column, with zeros behind the shorter ones."""
    lists = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    sizes = np.diff(lists.offsets.to_numpy())
    values = lists.flatten().to_numpy(zero_copy_only=False)
    if (sizes == dims).all():
        return values.reshape(-1, dims)
    out = np.zeros((len(sizes), dims))
    out[np.arange(dims)[None, :] < sizes[:, None]] = values
    return out


class Anchors(NamedTuple):
    """A chunk of anchors; `found` holds the scores of their positives, best first, NaN for none."""

    keys: np.ndarray
    labels: np.ndarray
    homes: np.ndarray  # block of each
    values: np.ndarray
    found: np.ndarray


def bounds(values: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(least, most) inner product of each row of `values` with any point of each box, by interval arithmetic."""
    plus, minus = np.maximum(values, 0), np.minimum(values, 0)
    return plus @ low.T + minus @ high.T, plus @ high.T + minus @ low.T


def _scores(a: np.ndarray, b: np.ndarray, exact: bool) -> np.ndarray:
    """Integer inner products; beyond the reach of doubles in whole numbers, clipped to the range of a long."""
    if exact:
        return a @ b.T
    whole = np.array([[int(v) for v in row] for row in a], object).reshape(a.shape) @ np.array([[int(v) for v in row] for row in b], object).reshape(b.shape).T
    return np.clip(whole, -_LONG, _LONG)


class Best:
    """The `k` best (score, key) of each anchor and window in a task: higher scores first, then smaller keys."""

    def __init__(self, n: int, k: int) -> None:
        self.scores = np.full((n, k), -np.inf)
        self.keys = np.full((n, k), _LONG, np.int64)
        self.whole: dict[int, list[tuple[int, int]]] = {}
        self.k = k

    def add(self, which: np.ndarray, scores: np.ndarray, keys: np.ndarray) -> None:
        """`scores` is which x rows, -inf for rows that don't count; `keys` rise."""
        rows = len(keys)
        if rows > self.k:
            # Whole scores and places in one number, so that the k largest are in the wanted order of ties.
            order = scores * rows + np.arange(rows - 1, -1, -1)
            top = np.argpartition(order, rows - self.k, axis=1)[:, rows - self.k :]
            scores, keys = np.take_along_axis(scores, top, 1), keys[top]
        else:
            keys = np.broadcast_to(keys, scores.shape)
        scores = np.concatenate([self.scores[which], scores], axis=1)
        keys = np.concatenate([self.keys[which], np.where(scores[:, self.k :] > -np.inf, keys, _LONG)], axis=1)
        order = np.lexsort((keys, -scores), axis=1)[:, : self.k]
        self.scores[which] = np.take_along_axis(scores, order, 1)
        self.keys[which] = np.take_along_axis(keys, order, 1)

    def add_whole(self, which: int, found: list[tuple[int, int]]) -> None:
        """The same for scores that doubles don't hold."""
        self.whole[which] = sorted([*self.whole.get(which, []), *found], key=lambda x: (-x[0], x[1]))[: self.k]

    def rows(self) -> Iterator[tuple[int, int, int]]:
        """(which, key, score), to be ranked with those of other tasks."""
        for i, j in zip(*np.nonzero(self.scores > -np.inf), strict=True):
            yield int(i), int(self.keys[i, j]), int(self.scores[i, j])
        for i, found in self.whole.items():
            for score, key in found:
                yield i, key, score


def _runs(batch: pa.RecordBatch, dims: int) -> Iterator[tuple[int, np.ndarray, np.ndarray, object]]:
    """(block, keys, values, label) of each stretch of one block in a batch, at most _RUN rows by rising keys."""
    blocks = batch.column("block").to_numpy(zero_copy_only=False)
    edges = [0, *(np.flatnonzero(np.diff(blocks)) + 1).tolist(), len(blocks)]
    for a, b in zip(edges, edges[1:], strict=False):
        if b > a:
            for c in range(a, b, _RUN):
                part = batch.slice(c, min(_RUN, b - c))
                keys = part.column("key").to_numpy(zero_copy_only=False)
                order = np.argsort(keys, kind="stable")
                yield int(blocks[a]), keys[order], _matrix(part.column("q"), dims)[order], part.column("label")[0].as_py()


class Blocks(NamedTuple):
    """Candidates in the shared folder, one directory a block of one label, and the blocks' zone maps."""

    path: str
    zones: DataFrame  # (block, label, low, high), several rows for a block read in parts
    dims: int
    exact: bool  # whether doubles hold every score, and scores times rows

    def read(self, spark: SparkSession, wanted: Column | None = None) -> DataFrame:
        rows = spark.read.schema("key long, label string, q array<double>, anchor boolean, block long").parquet(self.path)
        return rows if wanted is None else rows.filter(wanted)


def write_blocks(rows: DataFrame, block_rows: int | None = None) -> Blocks | None:
    """`rows` (key, label, q, anchor) sorted by label and Hilbert key into blocks; None without rows.

    The curve runs through the dimensions by falling variance, each cut into 16 cells between its least
    and largest value. Equal vectors are told apart by their keys, so a very common one is
    split over ranges like any other.
    """
    spark = rows.sparkSession
    rows = settled(rows.dropDuplicates(["key", "label", "q"]))
    sized = rows.agg(F.count("*"), F.max(F.size("q"))).first()
    total, dims = sized[0], sized[1] or 0
    if not total:
        return None
    per = block_rows or min(MOST_ROWS, max(LEAST_ROWS, math.isqrt(4 * total)))

    def spreads(batches):
        for batch in batches:
            v = np.clip(_matrix(batch.column("q"), dims), -_FAR, _FAR)
            yield pa.RecordBatch.from_arrays([pa.array(range(dims), pa.int32()), pa.array(v.sum(0)), pa.array((v * v).sum(0)), pa.array(v.min(0)), pa.array(v.max(0))], ["dim", "s", "ss", "low", "high"])

    stats = rows.select("q").mapInArrow(spreads, "dim int, s double, ss double, low double, high double").groupBy("dim")
    stats = sorted(stats.agg(F.sum("s"), F.sum("ss"), F.min("low"), F.max("high")).collect())
    s, ss, low, high = (np.array([r[i] for r in stats], float) for i in range(1, 5))
    turns = np.argsort(-(ss / total - (s / total) ** 2), kind="stable")
    width = np.maximum(high - low, 1)
    exact = max(1, dims) * float(np.maximum(high, -low).max(initial=1)) ** 2 * _RUN < _EXACT

    def place(batches):
        for batch in batches:
            cells = np.minimum((np.clip(_matrix(batch.column("q"), dims), -_FAR, _FAR) - low) / width * (1 << CURVE_BITS), (1 << CURVE_BITS) - 1)
            keys = hilbert_keys(cells[:, turns] if dims else cells, CURVE_BITS)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(keys, pa.binary())], [*batch.schema.names, "curve"])

    fields = "key long, label string, q array<double>, anchor boolean"
    ranges = max(1, math.ceil(total / (8 * per)))
    order = ["label", "curve", "key", "q"]
    ranged = rows.select("key", "label", "q", "anchor").mapInArrow(place, f"{fields}, curve binary").repartitionByRange(ranges, *order)
    sorted_ = ranged.sortWithinPartitions(*order).select("key", "label", "q", "anchor", F.spark_partition_id().cast("long").alias("block"))

    def number(batches):
        before, block, used = None, 0, 0
        for batch in batches:
            labels, numbers = batch.column("label").to_pylist(), []
            for label in labels:
                if used == per or (label != before and before is not None):
                    block, used = block + 1, 0
                before, used = label, used + 1
                numbers.append(block)
            own = batch.column("block").to_numpy(zero_copy_only=False) * (1 << 32) + np.array(numbers, np.int64)
            yield pa.RecordBatch.from_arrays([*batch.columns[:4], pa.array(own)], batch.schema.names)

    path = shared_folder(spark, "blocks")
    sorted_.mapInArrow(number, f"{fields}, block long").write.partitionBy("block").parquet(path)
    blocks = Blocks(path, rows, dims, exact)

    def zone(batches):
        for batch in batches:
            rows = [{"block": b, "label": label, "low": v.min(0).tolist(), "high": v.max(0).tolist()} for b, _, v, label in _runs(batch, dims)]
            yield pa.RecordBatch.from_pylist(rows, schema=_ZONE)

    maps = blocks.read(spark).select("key", "label", "q", "block").mapInArrow(zone, "block long, label string, low array<double>, high array<double>")
    return blocks._replace(zones=settled(maps))


_ZONE = pa.schema([("block", pa.int64()), ("label", pa.string()), ("low", pa.list_(pa.float64())), ("high", pa.list_(pa.float64()))])
_FOUND = pa.schema([("which", pa.int32()), ("window", pa.int32()), ("key", pa.int64()), ("score", pa.int64())])


def _thresholds(own: bool, anchors: Anchors, share: tuple[int, int]) -> tuple[np.ndarray, np.ndarray]:
    """(least, most) score that counts, anchors x windows; NaN where there is no window."""
    if own:
        return anchors.found, np.full_like(anchors.found, np.inf)
    low = -(-share[0] * anchors.found // share[1])
    return np.where(anchors.found >= 0, low, np.nan), np.where(anchors.found >= 0, anchors.found, np.nan)


def _needed(blocks: Blocks, anchors, own: bool, share: tuple[int, int]) -> list[int]:
    """Blocks that at least one anchor of the chunk must read; at most the number of blocks comes to the driver."""
    dims, exact = blocks.dims, blocks.exact

    def select(batches):
        chunk = anchors.value
        least, most = _thresholds(own, chunk, share)
        for batch in batches:
            hit = (chunk.labels[:, None] == np.array(batch.column("label").to_pylist(), object)[None, :]) == own
            if exact:
                below, above = bounds(chunk.values, _matrix(batch.column("low"), dims), _matrix(batch.column("high"), dims))
                reached = np.zeros(hit.shape, bool)
                for j in range(least.shape[1]):
                    reached |= (above >= least[:, j : j + 1]) & (below <= most[:, j : j + 1])
                hit &= reached
            yield pa.RecordBatch.from_arrays([batch.column("block").filter(pa.array(hit.any(0)))], ["block"])

    return [r[0] for r in blocks.zones.mapInArrow(select, "block long").distinct().collect()]


def _read(spark: SparkSession, blocks: Blocks, wanted: Column, anchors, k: int, own: bool, share: tuple[int, int], home: bool = False) -> DataFrame:
    """(which, window, place, key, score): the `k` best rows of each anchor and window among the blocks asked for.

    Each task keeps its own `k` best; an anchor skips a stretch of a block whose bounds can't beat them.
    With `home`, anchors see the rows of their own block only.
    """
    dims, exact = blocks.dims, blocks.exact

    def score(batches):
        chunk = anchors.value
        least, most = _thresholds(own, chunk, share)
        best = [Best(len(chunk.keys), k) for _ in range(least.shape[1])]
        for batch in batches:
            for block, keys, values, label in _runs(batch, dims):
                fits = chunk.homes == block if home else (chunk.labels == label) == own
                step = max(1, _TILE // len(keys))
                for at in range(0, len(fits), step):
                    which = at + np.flatnonzero(fits[at : at + step])
                    if exact:
                        which = which[_hopeful(chunk, which, values, best, least, most)]
                    if not len(which):
                        continue
                    scores = _scores(chunk.values[which], values, exact)
                    others = _others(chunk, which, keys, values) if own else True
                    for j, kept in enumerate(best):
                        counts = others & (scores >= least[which, j][:, None]) & (scores <= most[which, j][:, None])
                        if exact:
                            kept.add(which, np.where(counts, scores, -np.inf), keys)
                        else:
                            for i, w in enumerate(which):
                                kept.add_whole(int(w), [(int(scores[i, r]), int(keys[r])) for r in np.flatnonzero(counts[i])])
        rows = [{"which": i, "window": j, "key": key, "score": s} for j, kept in enumerate(best) for i, key, s in kept.rows()]
        yield pa.RecordBatch.from_pylist(rows, schema=_FOUND)

    found = blocks.read(spark, wanted).select("key", "label", "q", "block").mapInArrow(score, "which int, window int, key long, score long")
    order = Window.partitionBy("which", "window").orderBy(F.desc("score"), "key")
    ranked = found.withColumn("place", F.row_number().over(order)).filter(F.col("place") <= k)
    return ranked.select("which", "window", "place", "key", "score")


def _others(chunk: Anchors, which: np.ndarray, keys: np.ndarray, values: np.ndarray) -> np.ndarray:
    """False where a row of the anchors' label is the anchor itself: equal in key and vector."""
    out = np.ones((len(which), len(keys)), bool)
    near = np.flatnonzero(np.isin(keys, chunk.keys[which]))
    for r in near:
        alike = np.flatnonzero(chunk.keys[which] == keys[r])
        out[alike, r] = (chunk.values[which[alike]] != values[r]).any(1)
    return out


def _hopeful(chunk: Anchors, which: np.ndarray, values: np.ndarray, best: list[Best], least: np.ndarray, most: np.ndarray) -> np.ndarray:
    """Which of the anchors the rows' own zone map allows a row that some window would keep."""
    below, above = bounds(chunk.values[which], values.min(0)[None, :], values.max(0)[None, :])
    out = np.zeros(len(which), bool)
    for j, kept in enumerate(best):
        out |= (above[:, 0] >= np.fmax(least[which, j], kept.scores[which, -1])) & (below[:, 0] <= most[which, j])
    return out


def quantised(vectors: DataFrame, key: str, vector: str, label: str, anchor: Column, scale: int) -> DataFrame:
    """(key, label, q, anchor) of the rows that take part; q = floor(scale * component), as whole doubles."""
    whole = F.transform(F.col(vector), lambda x: x.cast("double"))
    rows = vectors.select(F.col(key).cast("long").alias("key"), F.col(label).cast("string").alias("label"), whole.alias("q"), anchor.alias("anchor"))
    # A component whose multiple is beyond doubles is as good as infinite.
    finite = F.forall("q", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) * scale < float("inf")))
    taken = rows.filter("key is not null and label is not null and q is not null").filter(finite)

    def floors(batches):
        for batch in batches:
            q = batch.column("q")
            values = pa.array(np.floor(q.flatten().to_numpy(zero_copy_only=False) * scale) + 0.0)
            offsets = q.offsets.to_numpy()
            lists = pa.ListArray.from_arrays(pa.array(offsets - offsets[0], pa.int32()), values)
            yield pa.RecordBatch.from_arrays([batch.column("key"), batch.column("label"), lists, batch.column("anchor")], batch.schema.names)

    return taken.withColumn("anchor", F.coalesce("anchor", F.lit(False))).mapInArrow(floors, "key long, label string, q array<double>, anchor boolean")


def mine(
    vectors: DataFrame,
    anchor: Column,
    key: str = "vec_id",
    vector: str = "embedding",
    label: str = "label",
    positives: int = 5,
    negatives: int = 5,
    share: tuple[int, int] = (80, 100),
    scale: int = 256,
    block_rows: int | None = None,
    chunk_values: int = CHUNK_VALUES,
) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    Components become floor(`scale` * x); a row's score is its integer inner product with the anchor,
    higher first, then the smaller key. An anchor's positives are its first `positives` other
    rows of the same label; for each, the first `negatives` rows of other labels are returned whose score is between
    share[0] / share[1] of the positive's score and that score.

    Candidates lie in blocks of one label along a Hilbert curve, about 2 * sqrt(rows) each, with the
    least and largest value of every dimension. Anchors come in chunks of `chunk_values` components,
    neighbours on the curve together. A chunk first reads the blocks it lies in, which gives each anchor a
    least score of its positives; interval arithmetic over the zone maps then names the blocks
    that can hold a better one, and later those that can reach a window; only their directories
    are read. Nothing is cut off: a block that can't be ruled out is read.

    Rows with a null key, label, vector or component, or one that is not finite, take no part. Shorter
    vectors count as if zeros followed; an empty one scores 0. Rows equal in key, label and vector count
    once; a row is "other" than an anchor if it differs in any of them. Scores beyond a long
    are clipped to its range. No rows or no anchors give an empty result; other columns are ignored.
    """
    spark = vectors.sparkSession
    blocks = write_blocks(quantised(vectors, key, vector, label, anchor, scale), block_rows)
    out = shared_folder(spark, "hardnegatives")
    if blocks is None:
        return spark.createDataFrame([], RESULT)
    counts = blocks.read(spark).filter("anchor").groupBy("block").agg(F.count("*").alias("n")).orderBy("block").collect()
    room = max(1, chunk_values // max(1, blocks.dims))
    chunks, held = [], 0
    for block, n in counts:
        if not chunks or held + n > room:
            chunks.append([block, block])
            held = 0
        chunks[-1][1] = block
        held += n
    for first, last in chunks:
        near = F.col("block").between(first, last)
        found = _mine_chunk(spark, blocks, near, positives, negatives, share)
        found.write.mode("append").parquet(out)
    drop_folder(spark, blocks.path)
    return spark.read.schema(RESULT).parquet(out) if chunks else spark.createDataFrame([], RESULT)


def _mine_chunk(spark: SparkSession, blocks: Blocks, near: Column, positives: int, negatives: int, share: tuple[int, int]) -> DataFrame:
    """The result rows of the anchors in the blocks `near`."""
    send = spark.sparkContext.broadcast
    own = blocks.read(spark, near).filter("anchor").select("key", "label", "block", "q").toArrow()
    n = own.num_rows
    labels = np.array(own.column("label").to_pylist(), object)
    base = Anchors(own.column("key").to_numpy(), labels, own.column("block").to_numpy(), _matrix(own.column("q"), blocks.dims), np.full((n, 1), -np.inf))
    kind = float if blocks.exact else object
    least = base.found.astype(kind)
    for r in _read(spark, blocks, near, send(base), positives, True, share, home=True).filter(F.col("place") == positives).collect():
        least[r["which"], 0] = r["score"]
    sent = send(base._replace(found=least))
    best = _read(spark, blocks, F.col("block").isin(_needed(blocks, sent, True, share)), sent, positives, True, share).collect()
    scores = np.full((n, positives), np.nan, kind)
    for r in best:
        scores[r["which"], r["place"] - 1] = r["score"]
    sent = send(base._replace(found=scores))
    found = _read(spark, blocks, F.col("block").isin(_needed(blocks, sent, False, share)), sent, negatives, False, share)
    names = pa.table(
        {
            "which": pa.array([r["which"] for r in best], pa.int32()),
            "window": pa.array([r["place"] - 1 for r in best], pa.int32()),
            "anchor_id": pa.array([int(base.keys[r["which"]]) for r in best], pa.int64()),
            "positive_id": pa.array([r["key"] for r in best], pa.int64()),
            "positive_score": pa.array([r["score"] for r in best], pa.int64()),
        }
    )
    joined = found.join(F.broadcast(spark.createDataFrame(names)), ["which", "window"])
    rank, negative, score = F.col("place").cast("int").alias("rank"), F.col("key").alias("negative_id"), F.col("score").alias("negative_score")
    return joined.select("anchor_id", "positive_id", rank, negative, "positive_score", score)
