"""Text measures, and quality rules learned as an ordered list of threshold conjunctions."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corploom.llm import words as W

# Labelled rows from which rules are learned, at most.
SAMPLE_ROWS = 20_000

BASE = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
EXTRA = ("n_lines", "n_distinct", "n_upper", "n_digits", "n_marks")
_SYMBOLS = ~W.byte_table(b"#*$%&|<>")
_UPPER = ~W.byte_table(bytes(range(65, 91)))
_DIGITS = ~W.byte_table(b"0123456789")
_MARKS = ~W.byte_table(b".,;:!?'\"()-")
_GROUP = np.uint64(0x9E3779B97F4A7C15)


def _repeated(keys: np.ndarray) -> np.ndarray:
    """True for each key that occurs more than once."""
    s = np.sort(keys)
    twice = np.unique(s[1:][s[1:] == s[:-1]])
    if not len(twice):
        return np.zeros(len(keys), bool)
    at = np.minimum(np.searchsorted(twice, keys), len(twice) - 1)
    return twice[at] == keys


def text_measures(values: np.ndarray, offsets: np.ndarray, window: int = 8) -> dict[str, np.ndarray]:
    starts, ends, first = W.places(values, offsets, W.SPACED)
    h = W.hashed(values, starts, ends)
    owner = W.owner(first).astype(np.uint64)
    n_texts = len(offsets) - 1
    tally = lambda flags: W.per_text(flags, offsets)
    line_starts, line_ends, _ = W.places(values, offsets, W.LINES)
    inked = np.searchsorted(starts, line_ends) > np.searchsorted(starts, line_starts)
    line_starts, line_ends = line_starts[inked], line_ends[inked]
    line_owner = np.searchsorted(offsets, line_starts, "right") - 1
    keys = W.finish(W.hashed(values, line_starts, line_ends) + line_owner.astype(np.uint64) * _GROUP)
    _, index = np.unique(keys, return_index=True)
    n_lines = np.bincount(line_owner, minlength=n_texts)
    _, word_index = np.unique(W.finish(h + owner * _GROUP), return_index=True)
    w = W.windows(h, window)
    at = np.flatnonzero(W.room(first)[: len(w)] >= window)
    again = at[_repeated(W.finish(w[at] + owner[at] * _GROUP))]
    inside = W.SPACED[values]
    return {
        "n_words": np.diff(first),
        "word_chars": tally(inside & ((values & 0xC0) != 0x80)),
        "n_symbols": tally(_SYMBOLS[values]),
        "n_dup_lines": n_lines - np.bincount(line_owner[index], minlength=n_texts),
        "n_repeat_words": W.per_text(W.covered(again, again + window, len(h)), first),
        "n_lines": n_lines,
        "n_distinct": np.bincount(owner[word_index].astype(np.int64), minlength=n_texts),
        "n_upper": tally(_UPPER[values]),
        "n_digits": tally(_DIGITS[values]),
        "n_marks": tally(_MARKS[values]),
    }


def measured(docs: DataFrame, text: str = "text", keep_text: bool = False) -> DataFrame:
    """The columns of `docs` (the text only with `keep_text`) plus BASE and EXTRA, from whole texts.

    Words are `[^\\x20\\x09-\\x0D]+`. A null or empty text has zeros. Columns of `docs` with the
    names of measures are replaced.
    """
    names = (*BASE, *EXTRA)
    kept = [c for c in docs.columns if c not in names]
    place = kept.index(text)
    out = [i for i, c in enumerate(kept) if keep_text or c != text]
    fields = [docs.schema[kept[i]] for i in out] + [T.StructField(n, T.LongType()) for n in names]
    schema = T.StructType(fields)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in W.text_slices(batch, place):
                found = text_measures(*W.raw(part.column(place)))
                columns = [part.column(i) for i in out] + [pa.array(found[n].astype(np.int64)) for n in names]
                yield pa.RecordBatch.from_arrays(columns, schema.names)

    return docs.select(*[F.col(f"`{c}`") for c in kept]).mapInArrow(scan, schema)


def base_failed() -> Column:
    """Too short, or repetitive in runs of 8 words."""
    return (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))


def statistics() -> dict[str, Column]:
    """The statistics that rules may test, each a plain expression over the measures."""
    share = lambda a, b: F.col(a) / F.greatest(F.col(b), F.lit(1))
    return {
        "words": F.col("n_words").cast("double"),
        "mean_word_chars": share("word_chars", "n_words"),
        "symbols_per_word": share("n_symbols", "n_words"),
        "dup_line_share": share("n_dup_lines", "n_lines"),
        "repeat_word_share": share("n_repeat_words", "n_words"),
        "words_per_line": share("n_words", "n_lines"),
        "distinct_share": share("n_distinct", "n_words"),
        "upper_share": share("n_upper", "word_chars"),
        "digit_share": share("n_digits", "word_chars"),
        "marks_per_word": share("n_marks", "n_words"),
    }


@dataclass(frozen=True)
class Rule:
    """A conjunction of (statistic, '<=' or '>', threshold) and its rows and hits among those left when it was learned."""

    tests: tuple[tuple[str, str, float], ...]
    rows: int
    hits: int

    def column(self) -> Column:
        known = statistics()
        out = F.lit(True)
        for name, op, threshold in self.tests:
            out = out & ((known[name] <= threshold) if op == "<=" else (known[name] > threshold))
        return out

    def __str__(self) -> str:
        return " and ".join(f"{n} {op} {t:.6g}" for n, op, t in self.tests)


def _fires(tests: list, x: dict[str, np.ndarray], n: int) -> np.ndarray:
    out = np.ones(n, bool)
    for name, op, threshold in tests:
        out &= (x[name] <= threshold) if op == "<=" else (x[name] > threshold)
    return out


def _grow(x: dict[str, np.ndarray], bad: np.ndarray, thresholds: int, most_tests: int) -> list:
    """Add the test with the best information gain until no good row is covered."""
    tests: list = []
    inside = np.ones(len(bad), bool)
    while len(tests) < most_tests:
        p0, n0 = int((inside & bad).sum()), int((inside & ~bad).sum())
        if not p0 or not n0:
            break
        best = (1e-9, None)
        for name, column in x.items():
            pos, neg = np.sort(column[inside & bad]), np.sort(column[inside & ~bad])
            cuts = np.unique(np.quantile(np.concatenate([pos, neg]), np.linspace(0, 1, thresholds + 1)[:-1]))
            cuts = np.unique(np.concatenate([cuts, np.quantile(pos, [0.0, 0.02, 0.05, 0.95, 0.98, 1.0])]))
            p, n = np.searchsorted(pos, cuts, "right"), np.searchsorted(neg, cuts, "right")
            for op, ps, ns in (("<=", p, n), (">", len(pos) - p, len(neg) - n)):
                with np.errstate(divide="ignore", invalid="ignore"):
                    gain = np.where(ps > 0, ps * (np.log2(ps / (ps + ns)) - np.log2(p0 / (p0 + n0))), 0.0)
                i = int(gain.argmax())
                if gain[i] > best[0]:
                    values = np.concatenate([pos, neg])
                    above = values[values > cuts[i]]  # the threshold goes halfway to the next value
                    best = (float(gain[i]), (name, op, float((cuts[i] + above.min()) / 2 if len(above) else cuts[i])))
        if best[1] is None:
            break
        tests.append(best[1])
        inside &= _fires([best[1]], x, len(bad))
    return tests


def _prune(tests: list, x: dict[str, np.ndarray], bad: np.ndarray) -> list:
    """The leading tests whose hits less false hits, as a share of the pruning rows covered, are most."""
    worth = []
    for k in range(1, len(tests) + 1):
        inside = _fires(tests[:k], x, len(bad))
        p, n = int((inside & bad).sum()), int((inside & ~bad).sum())
        worth.append(((p - n) / (p + n) if p + n else -1.0, p, -k))
    return tests[: -max(worth)[2]] if worth else []


def cover(
    x: dict[str, np.ndarray], bad: np.ndarray, order: np.ndarray, precision: float = 0.95, most_rules: int = 24, most_tests: int = 4, thresholds: int = 64
) -> list[Rule]:
    """Sequential covering: grow a rule on two thirds of the rows, prune it on the rest, take out what
    it covers, and go on until a rule isn't precise on the pruning rows. `order` in [0, 1) splits the rows."""
    rules: list[Rule] = []
    left = np.ones(len(bad), bool)
    growing = order < 2 / 3
    while len(rules) < most_rules:
        g, p = left & growing, left & ~growing
        tests = _grow({k: v[g] for k, v in x.items()}, bad[g], thresholds, most_tests)
        tests = _prune(tests, {k: v[p] for k, v in x.items()}, bad[p])
        if not tests:
            break
        judged, all_left = _fires(tests, {k: v[p] for k, v in x.items()}, int(p.sum())), _fires(tests, x, len(bad)) & left
        hits, rows = int((judged & bad[p]).sum()), int(judged.sum())
        if rows < 2 or hits < precision * rows or not (all_left & growing).any():
            break
        rules.append(Rule(tuple(tests), int(all_left.sum()), int((all_left & bad).sum())))
        left &= ~all_left
    return rules


def learn(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "quality", bad: int = 0, sample_rows: int = SAMPLE_ROWS) -> list[Rule]:
    """Rules for the rows whose label is `bad`, from at most `sample_rows` labelled rows by hash of the key.

    The sample's keys, whose number is bounded, are broadcast, so only these texts are measured;
    rows are ordered by hash before the bound is applied, so reruns agree. Rows without a key or
    a label teach nothing, nor do keys with two different labels; equal labels of a key count once,
    and each row of a key that `docs` repeats is an example. Without both kinds of label, or with an
    empty table, there are no rules.
    """
    known = labels.filter(F.col(key).isNotNull() & F.col(label).isNotNull()).groupBy(F.col(key).alias("_key"))
    agreed = known.agg(F.min(label).alias("_label"), F.max(label).alias("_most")).filter("_label = _most").drop("_most")
    order = F.xxhash64(F.lit("rules"), "_key")
    chosen = agreed.withColumn("_order", order).orderBy("_order", "_key").limit(sample_rows)
    rows = docs.select(F.col(key).alias("_key"), F.col(text).alias("text")).join(F.broadcast(chosen), "_key")
    stats = statistics()
    sample = (
        measured(rows)
        .select("_label", "_order", *[c.alias(n) for n, c in stats.items()])
        .orderBy("_order", *stats)
        .limit(sample_rows)
        .toPandas()
    )
    if not len(sample):
        return []
    order = ((sample["_order"].to_numpy() >> 11) & ((1 << 52) - 1)) / float(1 << 52)
    return cover({n: sample[n].to_numpy() for n in stats}, (sample["_label"] == bad).to_numpy(), order)


def decision(rules: list[Rule]) -> Column:
    """The number of the first rule that fires, from 1; null if none does."""
    out = F.lit(None).cast("int")
    for i, rule in reversed(list(enumerate(rules, 1))):
        out = F.when(rule.column(), F.lit(i)).otherwise(out)
    return out


def judge(docs: DataFrame, rules: list[Rule], text: str = "text", keep_text: bool = False) -> DataFrame:
    """`measured` rows plus base_failed, rule (the first that fires, else null) and kept.

    kept is false if base_failed or a rule fires. A null or empty text fails the base. Of rules
    that fire together the first counts; repeated rows are judged alike, an empty table gives no rows.
    """
    rows = measured(docs, text, keep_text).withColumn("base_failed", base_failed()).withColumn("rule", decision(rules))
    return rows.withColumn("kept", ~F.col("base_failed") & F.col("rule").isNull())
