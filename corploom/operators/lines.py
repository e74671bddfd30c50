"""Monotone alignment of the lines of two versions of a text: match, join, split, drop."""

from __future__ import annotations

import sys
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corploom.operators import metrics

# Most lines of one side that may stand for one line of the other.
JOINED = 3
_PAIR = pa.list_(pa.struct([("kind", pa.string()), ("recognized_text", pa.string()), ("correct_text", pa.string())]))

cloudpickle.register_pickle_by_value(sys.modules[__name__])


def _grams(lines: list[str]) -> Counter:
    """Pairs of neighbouring characters of the lines run together, blanks aside; the ends count too."""
    text = "\x02" + "".join("".join(lines).split()) + "\x03"
    return Counter(zip(text, text[1:], strict=False))


def cost(a: list[str], b: list[str]) -> int:
    """Character pairs that only one side has; each further line of a side costs one more, an empty side all of the other's."""
    x, y = _grams(a) if a else Counter(), _grams(b) if b else Counter()
    return (x - y).total() + (y - x).total() + max(0, len(a) - 1) + max(0, len(b) - 1)


STEPS = [(1, 1), *[(1, k) for k in range(2, JOINED + 1)], *[(k, 1) for k in range(2, JOINED + 1)], (0, 1), (1, 0)]


def _block(h: list[str], r: list[str]) -> list[tuple[int, int]]:
    """Cheapest steps through two lists (dynamic programme); of equal ways the earlier step of STEPS."""
    grams = lambda lines: {(i, k): _grams(lines[i : i + k]) for i in range(len(lines)) for k in range(1, JOINED + 1) if i + k <= len(lines)}
    x, y = grams(h), grams(r)
    sizes = {id(c): c.total() for c in (*x.values(), *y.values())}
    best = [[(0, (0, 0))] * (len(r) + 1) for _ in range(len(h) + 1)]
    for i in range(len(h), -1, -1):
        for j in range(len(r), -1, -1):
            ways = []
            for rank, (a, b) in enumerate(STEPS):
                if i + a > len(h) or j + b > len(r):
                    continue
                p, q = x.get((i, a)), y.get((j, b))
                if p is None or q is None:
                    price = sizes[id(p if q is None else q)]
                else:
                    common = sum(min(n, q[g]) for g, n in p.items() if g in q)
                    price = sizes[id(p)] + sizes[id(q)] - 2 * common + a + b - 2
                ways.append((price + best[i + a][j + b][0], rank, (a, b)))
            if ways:
                total, _, step = min(ways)
                best[i][j] = (total, step)
    out, i, j = [], 0, 0
    while i < len(h) or j < len(r):
        a, b = best[i][j][1]
        out.append((a, b))
        i, j = i + a, j + b
    return out


def _anchors(h: list[str], r: list[str]) -> list[tuple[int, int]]:
    """Places of lines found once on each side and equal: the longest chain in order."""
    once = lambda lines: {line: i for i, line in enumerate(lines) if counts[line] == 1}
    counts = Counter(h)
    left = once(h)
    counts = Counter(r)
    right = once(r)
    pairs = [(i, right[line]) for line, i in left.items() if line.strip() and line in right]
    ends, last, before = [], [], {}
    for i, j in pairs:
        at = bisect_left(ends, j)
        before[j] = last[at - 1] if at else None
        ends[at:] = [j]
        last[at:] = [(i, j)]
    chain, step = [], last[-1] if last else None
    while step:
        chain.append(step)
        step = before[step[1]]
    return chain[::-1]


def align(h: list[str], r: list[str]) -> list[tuple[list[str], list[str]]]:
    """Blocks of lines that stand for each other, in order; one side of a block may be empty."""
    out, i, j = [], 0, 0
    for a, b in [*_anchors(h, r), (len(h), len(r))]:
        p, q = i, j
        for m, n in _block(h[i:a], r[j:b]):
            out.append((h[p : p + m], r[q : q + n]))
            p, q = p + m, q + n
        if a < len(h):
            out.append(([h[a]], [r[b]]))
        i, j = a + 1, b + 1
    return out


def _kind(h: list[str], r: list[str]) -> str:
    if not h or not r:
        return "surplus" if h else "missing"
    return "match" if len(h) == len(r) else "joined" if len(r) > len(h) else "split"


def aligned_lines(df: DataFrame, hypothesis: str, reference: str, *keep: str) -> DataFrame:
    """(keep..., line_id, kind, recognized_text, correct_text): the lines of two versions, each with its partner.

    Lines equal and unique on both sides are fixed first (their longest chain in order); between
    them a dynamic programme finds the cheapest way to match lines, to let up to JOINED lines of one
    side stand for one of the other (kinds joined and split), or to leave one without a partner (missing
    from the recognised text, or surplus in it). A joined or dropped line so shifts none of those after it. Work
    is the product of the numbers of lines between two fixed ones. Lines of a block are set together by
    blanks. A null text has no lines, an empty one has one empty line, which matches an empty one.
    """
    rows = df.select(*keep, F.col(hypothesis).alias("_h"), F.col(reference).alias("_r"))
    schema = T.StructType([*rows.schema.fields[:-2], *T.StructType.fromDDL("_z array<struct<kind: string, recognized_text: string, correct_text: string>>").fields])

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            for h, r in zip(batch.column("_h").to_pylist(), batch.column("_r").to_pylist(), strict=True):
                blocks = align(h.split("\n") if h is not None else [], r.split("\n") if r is not None else [])
                found.append([{"kind": _kind(a, b), "recognized_text": " ".join(a), "correct_text": " ".join(b)} for a, b in blocks])
            yield pa.RecordBatch.from_arrays([*batch.columns[:-2], pa.array(found, _PAIR)], schema.names)

    placed = rows.mapInArrow(scan, schema).select(*keep, F.posexplode("_z").alias("line_id", "z"))
    return placed.select(*keep, "line_id", "z.*")


def alignment_rates(pairs: DataFrame, group: str) -> DataFrame:
    """Error rates per group over aligned lines, with the lines of each kind counted apart."""
    kinds: list[Column] = [F.count_if(F.col("kind") == k).alias(f"{k}_lines") for k in ("match", "joined", "split", "missing", "surplus")]
    counted = metrics.error_counts(pairs, "recognized_text", "correct_text")
    return metrics.error_rates(counted, group).join(pairs.groupBy(group).agg(*kinds), group)
