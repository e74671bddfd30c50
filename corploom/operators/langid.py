"""Language identification from anchor texts: ranked character n-gram profiles."""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corploom.operators.lookup import BROADCAST_ROWS, join_keyed, settled

# Characters that a worker takes to their n-grams at once; a longer text is a slice of its own.
_SLICE = 1 << 20

# Functions of this module travel to the workers whole, so these need no copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def folded(text: Column) -> Column:
    """The letters in lower case between two spaces, other runs as one space."""
    return F.concat(F.lit(" "), F.trim(F.regexp_replace(F.lower(text), r"[^\p{L}]+", " ")), F.lit(" "))


def ngrams(text: Column, width: int = 3) -> Column:
    """Overlapping character n-grams of the folded text (linear scan)."""
    return F.regexp_extract_all(folded(text), F.lit(f"(?=(.{{{width}}}))"), F.lit(1))


def _slices(texts: pd.Series) -> Iterator[tuple[int, list[str]]]:
    """(place of the first, texts) of at most `_SLICE` characters together, or a single longer one."""
    first, total, held = 0, 0, []
    for i, t in enumerate(texts):
        t = t or ""
        if held and total + len(t) > _SLICE:
            yield first, held
            first, total, held = i, 0, []
        held.append(t)
        total += len(t)
    if held:
        yield first, held


def _codes(texts: list[str]) -> np.ndarray:
    return np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32)


def _packed(codes: np.ndarray, width: int) -> np.ndarray:
    """Each run of `width` code points as one value: 21 bits a character, or a string where 64 bits are too few."""
    n = max(len(codes) - width + 1, 0)
    if width > 3:
        return np.ascontiguousarray(np.lib.stride_tricks.sliding_window_view(codes, width)).view(f"<U{width}")[:, 0] if n else np.empty(0, f"<U{width}")
    keys = np.zeros(n, np.uint64)
    for i in range(width):
        keys = (keys << np.uint64(21)) | codes[i : i + n]
    return keys


def _within(lengths: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """(text, place) of the n-grams that lie within one text, of texts that follow each other."""
    text = np.repeat(np.arange(len(lengths)), lengths)
    ends = np.repeat(np.cumsum(lengths), lengths)
    places = np.flatnonzero(np.arange(len(text)) + width <= ends)
    return text[places], places


def profiles(anchors: DataFrame, text: str, lang: str, size: int = 300, width: int = 3) -> DataFrame:
    """(gram, lang, weight): the `size` most frequent n-grams per language, heavier when more frequent."""

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for profile_lang, part in b.groupby("profile_lang", dropna=False):
                for _, texts in _slices(part["t"]):
                    codes = _codes(texts)
                    _, places = _within(np.array([len(t) for t in texts]), width)
                    _, firsts, n = np.unique(_packed(codes, width)[places], return_index=True, return_counts=True)
                    whole = "".join(texts)
                    grams = [whole[i : i + width] for i in places[firsts].tolist()]
                    yield pd.DataFrame({"profile_lang": None if pd.isna(profile_lang) else profile_lang, "gram": grams, "n": n})

    kind = anchors.schema[lang].dataType.simpleString()
    counts = (
        anchors.select(F.col(lang).alias("profile_lang"), folded(F.col(text)).alias("t"))
        .mapInPandas(count, f"profile_lang {kind}, gram string, n long")
        .groupBy("profile_lang", "gram")
        .agg(F.sum("n").alias("n"))
    )
    rank = F.row_number().over(Window.partitionBy("profile_lang").orderBy(F.desc("n"), "gram"))
    ranked = counts.withColumn("rank", rank).filter(F.col("rank") <= size)
    return ranked.select("gram", "profile_lang", (F.lit(size + 1) - F.col("rank")).cast("long").alias("weight"))


def _scored(df: DataFrame, row_id: str, text: str, profile: DataFrame, width: int) -> DataFrame:
    """(row_id, ranked): summed weights of the languages hit, as (score, profile_lang), taken where the text lies."""
    rows = [r for r in profile.select("gram", "profile_lang", "weight").collect() if len(r["gram"]) == width]
    langs = sorted({r["profile_lang"] for r in rows}, key=lambda l: (l is not None, l))
    place = {l: i for i, l in enumerate(langs)}
    keys = _packed(_codes([r["gram"] for r in rows]), width)[::width]
    known, at = np.unique(keys, return_inverse=True)
    weights, hit = np.zeros((len(known) + 1, len(langs)), np.int64), np.zeros((len(known) + 1, len(langs)), bool)
    np.add.at(weights, (at, [place[r["profile_lang"]] for r in rows]), [r["weight"] for r in rows])
    hit[at, [place[r["profile_lang"]] for r in rows]] = True
    shared = df.sparkSession.sparkContext.broadcast((known, weights, hit))

    def score(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known, weights, hit = shared.value
        for b in batches:
            for first, texts in _slices(b["t"]):
                text, places = _within(np.array([len(t) for t in texts]), width)
                keys = _packed(_codes(texts), width)[places]
                gram = np.minimum(np.searchsorted(known, keys), len(known) - 1)
                found = known[gram] == keys
                # Grams of a text are counted first, so that a language costs a pass over what occurs, not over the text.
                pairs, n = np.unique(text[found] * len(known) + gram[found], return_counts=True)
                row, gram = pairs // len(known), pairs % len(known)
                ids = b["id"].iloc[first : first + len(texts)].to_numpy()
                for i in range(weights.shape[1]):
                    total = np.bincount(row, weights[gram, i] * n, len(texts)).astype(np.int64)
                    seen = np.bincount(row, hit[gram, i], len(texts)) > 0
                    yield pd.DataFrame({row_id: ids[seen], "_l": i, "score": total[seen]})

    kind = df.schema[row_id].dataType.simpleString()
    scored = df.select(F.col(row_id).alias("id"), folded(F.col(text)).alias("t")).mapInPandas(
        score, f"`{row_id}` {kind}, _l int, score long"
    )
    names = F.array(*[F.lit(l) for l in langs])
    return scored.select(row_id, F.element_at(names, F.col("_l") + 1).alias("profile_lang"), "score")


def identify(
    df: DataFrame, row_id: str, text: str, declared: str, profile: DataFrame, margin: float = 0.1, width: int = 3
) -> DataFrame:
    """Best language per text, 'mixed' when the runner-up is within `margin`, 'unknown' without evidence.

    The profile is bounded (size x languages) and counted; a short one travels to the texts, whose n-grams are
    looked up where they lie, so that only a score a text and language is shuffled. A long one is joined.
    """
    profile = settled(profile)
    n = profile.count()
    if 0 < n <= BROADCAST_ROWS:
        scored = _scored(df, row_id, text, profile, width)
    else:
        per_gram = profile.groupBy("gram").agg(F.collect_list(F.struct("profile_lang", "weight")).alias("hits"))
        grams = df.select(row_id, F.explode(ngrams(F.col(text), width)).alias("gram"))
        scored = (
            join_keyed(grams, per_gram, "gram", F.col(row_id))
            .select(row_id, F.explode("hits").alias("hit"))
            .select(row_id, "hit.profile_lang", F.col("hit.weight").alias("score"))
        )
    scored = scored.groupBy(row_id, "profile_lang").agg(F.sum("score").alias("score"))
    ranked = scored.groupBy(row_id).agg(
        F.reverse(F.array_sort(F.collect_list(F.struct("score", "profile_lang")))).alias("ranked")
    )
    first = F.coalesce(F.try_element_at("ranked", F.lit(1))["score"], F.lit(0))
    second = F.coalesce(F.try_element_at("ranked", F.lit(2))["score"], F.lit(0))
    verdict = (
        F.when(first == 0, "unknown")
        .when((first - second) < first * F.lit(margin), "mixed")
        .otherwise(F.try_element_at("ranked", F.lit(1))["profile_lang"])
    )
    return df.select(row_id, declared).join(ranked, row_id, "left").select(
        row_id,
        declared,
        verdict.alias("lang_classifier"),
        first.alias("score"),
        second.alias("runner_up_score"),
        (verdict == F.col(declared)).alias("agrees"),
    )
