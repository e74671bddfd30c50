"""Language of a text by sparse multinomial logistic regression on character n-grams."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corploom.llm import words as W

# Labelled rows that the weights are fitted on, about; languages and document frequencies are counted over all.
SAMPLE_ROWS = 4000
# However many languages share these rows, each has so many, about, or all that it has.
LANGUAGE_ROWS = 50
BUCKET_BITS = 15
ORDERS = 3
UNKNOWN = "und"
_SLICE = 256 << 10
_FACTORS = np.array([0x9E3779B1, 0x85EBCA77, 0xC2B2AE3D, 0x27D4EB2F], np.uint32)
# Features are relative frequencies; this brings them to the order of one.
SCALE = 30.0


def grams(texts: pa.Array) -> tuple[np.ndarray, list[np.ndarray], list[np.ndarray]]:
    """(offsets, buckets by order, fits by order) of the n-grams of lower-cased texts with a space at both ends.

    Signs and digits of ASCII are spaces. `fits` tells where an n-gram lies inside one text.
    """
    parts = [f" {(t.as_py() or '').lower()} ".encode("utf-32-le", "surrogatepass") for t in texts]
    sizes = np.array([len(p) // 4 for p in parts])
    offsets = np.concatenate([[0], np.cumsum(sizes)])
    code = np.frombuffer(b"".join(parts), np.uint32).copy()
    code[(code < 128) & ~((code >= 97) & (code <= 122))] = 32
    left = np.repeat(offsets[1:], sizes) - np.arange(len(code))
    buckets, fits = [], []
    for n in range(1, ORDERS + 1):
        h = np.full(max(0, len(code) - n + 1), n * 0x165667B1 & 0xFFFFFFFF, np.uint32)
        for j in range(n):
            h = (h ^ code[j : len(code) - n + 1 + j]) * _FACTORS[j]
            h ^= h >> np.uint32(15)
        h *= _FACTORS[3]
        buckets.append((h >> np.uint32(32 - BUCKET_BITS)).astype(np.int32))
        fits.append(left[: len(h)] >= n)
    return offsets, buckets, fits


def has_letter(text: Column) -> Column:
    return F.coalesce(text.rlike(r"\p{L}"), F.lit(False))


def remainder(key: Column) -> Column:
    """crc32 of the key as text, modulo 4; null for a null key."""
    return F.pmod(F.crc32(key.cast("string").cast("binary")), F.lit(4))


def counted(texts: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray, int]]:
    """(buckets, counts, number of n-grams) of each text."""
    offsets, buckets, fits = grams(texts)
    for a, b in zip(offsets[:-1], offsets[1:], strict=True):
        own = np.concatenate([x[a:b][f[a:b]] for x, f in zip(buckets, fits, strict=True)])
        n = np.bincount(own, minlength=1 << BUCKET_BITS)
        at = np.flatnonzero(n)
        yield at, n[at], len(own)


def document_frequencies(rows: DataFrame) -> tuple[int, np.ndarray]:
    """(texts, texts by bucket) over all rows (text); each task sends one count a bucket."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((1 << BUCKET_BITS) + 1, np.int64)
        for batch in batches:
            for part in W.text_slices(batch, 0, _SLICE):
                total[-1] += part.num_rows
                for at, _, _ in counted(part.column(0)):
                    total[at] += 1
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(total[at])], ["bucket", "n"])

    found = np.zeros((1 << BUCKET_BITS) + 1, np.int64)
    for bucket, n in rows.mapInArrow(scan, "bucket int, n long").groupBy("bucket").agg(F.sum("n")).collect():
        found[bucket] = n
    return int(found[-1]), found[:-1]


def place(rows: DataFrame) -> DataFrame:
    """lang, `at` (a hash of key and text in 0 to 1) and text of each row."""
    order = F.shiftrightunsigned(F.xxhash64(F.lit("langid"), F.col("key"), F.col("text")), 1) / float(1 << 63)
    return rows.select("lang", order.alias("at"), "text")


def language_counts(rows: DataFrame) -> list[tuple[str, int, float]]:
    """(lang, rows, lowest `at`) of every language, in order; rows alike in key and text count once."""
    found = place(rows).select("lang", "at").distinct().groupBy("lang").agg(F.count("*"), F.min("at"))
    return sorted(tuple(r) for r in found.collect())


def quota(counts: list[int], sample_rows: int) -> int:
    """Rows that a language may give so that all give about `sample_rows`: what rarer ones lack goes to the others."""
    left = sample_rows
    for i, n in enumerate(sorted(counts)):
        share = left // (len(counts) - i)
        if n > share:
            return max(share, LANGUAGE_ROWS)
        left -= n
    return max(counts)


def sampled(rows: DataFrame, counts: list[tuple[str, int, float]], sample_rows: int) -> list:
    """(lang, order, buckets, counts, grams) of about `quota` rows of each language, those of smallest hash.

    A rarer language gives all its rows, and each gives the row of its lowest hash at least.
    """
    most = quota([n for _, n, _ in counts], sample_rows)
    limits = [(lang, 1.0 if n <= most else max(most / n, lowest)) for lang, n, lowest in counts]
    bounds = rows.sparkSession.createDataFrame(limits, "lang string, limit double")
    chosen = place(rows).join(F.broadcast(bounds), "lang").filter("at <= limit").select("lang", (F.col("at") / F.col("limit")).alias("at"), "text")

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in W.text_slices(batch, 2, _SLICE):
                found = list(counted(part.column(2)))
                columns = [part.column(0), part.column(1), pa.array([f[0].astype(np.int32) for f in found], pa.list_(pa.int32()))]
                columns += [pa.array([f[1].astype(np.int32) for f in found], pa.list_(pa.int32())), pa.array([f[2] for f in found], pa.int64())]
                yield pa.RecordBatch.from_arrays(columns, ["lang", "at", "buckets", "counts", "grams"])

    schema = "lang string, at double, buckets array<int>, counts array<int>, grams long"
    table = chosen.mapInArrow(scan, schema).dropDuplicates(["at", "lang"]).toArrow()
    return sorted(table.to_pylist(), key=lambda r: (r["at"], r["lang"]))


@dataclass(frozen=True)
class Model:
    """Languages, document-frequency weights times coefficients (languages x buckets), and the temperature."""

    languages: list[str]
    weights: np.ndarray
    temperature: float


def softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


def follow_the_leader(
    examples: list[tuple[int, np.ndarray, np.ndarray]], classes: int, epochs: int, alpha: float, beta: float, l1: float, l2: float
) -> np.ndarray:
    """FTRL-proximal with elastic net: coefficients stay zero until their gradients outweigh `l1`."""
    z = np.zeros((classes, 1 << BUCKET_BITS))
    n = np.zeros_like(z)

    def coefficients(zs: np.ndarray, ns: np.ndarray) -> np.ndarray:
        return np.where(np.abs(zs) <= l1, 0.0, -(zs - np.sign(zs) * l1) / ((beta + np.sqrt(ns)) / alpha + l2))

    for _ in range(epochs):
        for label, at, x in examples:
            zs, ns = z[:, at], n[:, at]
            w = coefficients(zs, ns)
            p = softmax(w @ x)
            p[label] -= 1.0
            g = p[:, None] * x
            more = ns + g * g
            z[:, at] = zs + g - (np.sqrt(more) - np.sqrt(ns)) / alpha * w
            n[:, at] = more
    return coefficients(z, n)


def temperature(logits: np.ndarray, labels: np.ndarray, weights: np.ndarray) -> float:
    """The divisor of the logits with the least weighted log loss, by golden-section search over its logarithm."""
    if not len(labels):
        return 1.0

    def loss(t: float) -> float:
        p = softmax(logits / np.exp(t))[np.arange(len(labels)), labels]
        return float(-(weights * np.log(np.maximum(p, 1e-12))).sum() / weights.sum())

    low, high, ratio = np.log(0.05), np.log(20.0), (5**0.5 - 1) / 2
    for _ in range(40):
        a, b = high - ratio * (high - low), low + ratio * (high - low)
        low, high = (low, b) if loss(a) < loss(b) else (a, high)
    return float(np.exp((low + high) / 2))


def fit(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    lang: str = "lang",
    sample_rows: int = SAMPLE_ROWS,
    epochs: int = 4,
    alpha: float = 0.5,
    beta: float = 1.0,
    l1: float = 0.05,
    l2: float = 0.05,
) -> Model | None:
    """A model from rows with a language, a letter and a key whose remainder isn't 2; None without any.

    Languages and document frequencies are counted over all such rows; coefficients are fitted on
    about `sample_rows` of them, the same number of each language or all rows of a rarer one, and
    LANGUAGE_ROWS of each at least. A fifth of each language's rows is kept for the temperature, in
    which a language weighs as much as it has rows; one of fewer than five rows is fitted on all.
    One language alone is always predicted.
    """
    wanted = F.col(lang).isNotNull() & has_letter(F.col(text)) & (remainder(F.col(key)) != 2)
    rows = docs.filter(wanted).select(F.col(key).cast("string").alias("key"), F.col(lang).cast("string").alias("lang"), F.col(text).alias("text"))
    total, found = document_frequencies(rows.select("text"))
    if not total:
        return None
    idf = np.log((1 + total) / (1 + found)) + 1
    counts = language_counts(rows)
    languages = [name for name, _, _ in counts]
    label_of = {name: i for i, name in enumerate(languages)}
    kept, used, seen = [], [], Counter()
    for r in sampled(rows, counts, sample_rows):
        at, label = np.array(r["buckets"]), label_of[r["lang"]]
        seen[label] += 1
        (used if seen[label] % 5 else kept).append((label, at, SCALE * idf[at] * np.array(r["counts"]) / max(1, r["grams"])))
    w = follow_the_leader(used, len(languages), epochs, alpha, beta, l1, l2)
    logits = np.array([w[:, at] @ x for _, at, x in kept]).reshape(len(kept), len(languages))
    labels = np.array([label for label, _, _ in kept], np.int64)
    held = np.bincount(labels, minlength=len(languages))
    t = temperature(logits, labels, np.array([n for _, n, _ in counts])[labels] / held[labels])
    return Model(languages, (w * idf * SCALE).astype(np.float32), t)


def predict(docs: DataFrame, model: Model | None, key: str = "doc_id", text: str = "text") -> DataFrame:
    """`key`, held_out, lang_pred and score for every row, from the whole text alone.

    held_out: the key's remainder is 2 (a null key isn't). A text that is null or has no letter
    is `und` with score 0, as is every text without a model; ties go to the first language in
    order. The score is the calibrated probability of the prediction. Repeated rows are judged
    alike; an empty table gives no rows; other columns are left out.
    """
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(model)
    kind = docs.schema[key].dataType

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        for batch in batches:
            for part in W.text_slices(batch, 3, _SLICE):
                lettered = part.column(2).to_numpy(zero_copy_only=False).astype(bool)
                names = np.full(part.num_rows, UNKNOWN, object)
                scores = np.zeros(part.num_rows)
                if known is not None and lettered.any():
                    offsets, buckets, fits = grams(part.column(3))
                    total = sum(W.per_text(f, np.minimum(offsets, len(f))) for f in fits)
                    logits = np.zeros((part.num_rows, len(known.languages)))
                    for x, f in zip(buckets, fits, strict=True):
                        bounds = np.minimum(offsets, len(x))
                        for c, row in enumerate(known.weights):
                            cumulated = np.zeros(len(x) + 1)
                            np.cumsum(np.where(f, row[x], 0), out=cumulated[1:])
                            logits[:, c] += cumulated[bounds[1:]] - cumulated[bounds[:-1]]
                    p = softmax(logits / np.maximum(total, 1)[:, None] / known.temperature)
                    best = p.argmax(axis=1)
                    names[lettered] = np.array(known.languages, object)[best][lettered]
                    scores[lettered] = p.max(axis=1)[lettered]
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(names, pa.string()), pa.array(scores)], out.names)

    out = T.StructType([T.StructField(key, kind), *T.StructType.fromDDL("held_out boolean, lang_pred string, score double").fields])
    held = F.coalesce(remainder(F.col(key)) == 2, F.lit(False))
    rows = docs.select(F.col(key), held.alias("held_out"), has_letter(F.col(text)).alias("letters"), F.col(text).alias("text"))
    return rows.mapInArrow(scan, out)
