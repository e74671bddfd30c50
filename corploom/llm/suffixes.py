"""Suffix arrays of one shard by induced sorting, with numpy doing a bucket at a time."""

from __future__ import annotations

import numpy as np

from corploom.llm import words as W


def _types(t: np.ndarray) -> np.ndarray:
    """True for each suffix that is smaller than the next one; the end is smaller than all."""
    step = np.zeros(len(t), np.int8)
    step[:-1] = np.sign(np.diff(t.astype(np.int32)))
    step[-1] = -1
    moves = np.flatnonzero(step)
    return step[moves[np.searchsorted(moves, np.arange(len(t)))]] > 0


def _induce(t: np.ndarray, smaller: np.ndarray, seeds: np.ndarray, symbols: int) -> np.ndarray:
    """All suffixes in order, induced from the order of the leftmost-smaller ones.

    Each bucket is scanned in waves: what a wave puts into its own bucket is the next wave, so
    a scan is sequential only in the buckets and in the longest run of one symbol.
    """
    counts = np.bincount(t, minlength=symbols)
    ends = np.cumsum(counts)
    begins = ends - counts
    sa = np.full(len(t), -1, np.int64)
    seeds_by = np.searchsorted(t[seeds], np.arange(symbols + 1))
    free = begins.copy()

    def put(found: np.ndarray) -> None:
        symbol = t[found]
        order = np.argsort(symbol, kind="stable")
        symbol = symbol[order]
        n = np.bincount(symbol, minlength=symbols)
        sa[free[symbol] + np.arange(len(found)) - (np.cumsum(n) - n)[symbol]] = found[order]
        free[:] += n

    def larger_before(wave: np.ndarray) -> np.ndarray:
        found = wave[wave > 0] - 1
        return found[~smaller[found]]

    put(np.array([len(t) - 1]))
    used = np.flatnonzero(counts)
    for c in used:
        at = begins[c]
        while at < free[c]:
            wave, at = sa[at : free[c]], free[c]
            found = larger_before(wave)
            if len(found):
                put(found)
        found = larger_before(seeds[seeds_by[c] : seeds_by[c + 1]])
        if len(found):
            put(found)
    last = ends.copy()

    def put_back(found: np.ndarray) -> None:  # in falling order
        symbol = t[found]
        order = np.argsort(symbol, kind="stable")
        symbol = symbol[order]
        n = np.bincount(symbol, minlength=symbols)
        sa[last[symbol] - 1 - np.arange(len(found)) + (np.cumsum(n) - n)[symbol]] = found[order]
        last[:] -= n

    def smaller_before(wave: np.ndarray) -> np.ndarray:
        found = wave[wave > 0] - 1
        return found[smaller[found]]

    for c in used[::-1]:
        at = ends[c]
        while at > last[c]:
            wave, at = sa[last[c] : at][::-1], last[c]
            found = smaller_before(wave)
            if len(found):
                put_back(found)
        found = smaller_before(sa[begins[c] : free[c]][::-1])
        if len(found):
            put_back(found)
    return sa


def _rank_suffixes(names: np.ndarray) -> np.ndarray:
    """Suffix order of the reduced string; its alphabet is as long as itself, so by doubling ranks."""
    n, rank, span = len(names), names.astype(np.int64), 1
    order = np.argsort(rank, kind="stable")
    while rank.max() < n - 1:
        behind = np.zeros(n, np.int64)
        behind[:-span] = rank[span:] + 1
        pair = rank * (n + 1) + behind
        order = np.argsort(pair, kind="stable")
        s = pair[order]
        rank = np.empty(n, np.int64)
        rank[order] = np.concatenate([[0], np.cumsum(s[1:] != s[:-1])])
        span *= 2
        if span >= n:
            break
    return order


def suffix_array(t: np.ndarray) -> np.ndarray:
    """Suffix array of an array of small symbols (an end smaller than all is implied), in linear work a level."""
    if len(t) < 2:
        return np.arange(len(t))
    symbols = int(t.max()) + 1
    smaller = _types(t)
    leftmost = np.flatnonzero(smaller[1:] & ~smaller[:-1]) + 1
    if not len(leftmost):
        return _induce(t, smaller, leftmost, symbols)
    by_symbol = leftmost[np.argsort(t[leftmost], kind="stable")]
    rough = _induce(t, smaller, by_symbol, symbols)
    is_leftmost = np.zeros(len(t), bool)
    is_leftmost[leftmost] = True
    ordered = rough[is_leftmost[rough]]
    # A leftmost-smaller substring ends at the next one; equal ones get one name.
    until = np.minimum(np.append(leftmost[1:] + 1, len(t)), len(t))
    lengths = np.zeros(len(t), np.int64)
    lengths[leftmost] = until - leftmost
    content = _content(t, leftmost, until)
    of = np.zeros(len(t), np.uint64)
    of[leftmost] = content
    a, b = ordered[1:], ordered[:-1]
    new = (of[a] != of[b]) | (lengths[a] != lengths[b])
    name = np.zeros(len(t), np.int64)
    name[ordered] = np.concatenate([[0], np.cumsum(new)])
    if not new.all():
        ordered = leftmost[_rank_suffixes(name[leftmost])]
    return _induce(t, smaller, ordered, symbols)


def _content(t: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hashes of t[start:end], ranges that overlap by their ends included; the last may reach the end."""
    values = W.finish(t.astype(np.uint64) + np.uint64(1))
    up, down = W._powers(W._BASE, len(t) + 1), W._powers(pow(W._BASE, -1, 1 << 64), len(t) + 1)
    total = np.zeros(len(t) + 1, np.uint64)
    np.cumsum(values * up[:-1], out=total[1:])
    h = (total[ends] - total[starts]) * down[starts]
    h[ends == len(t)] += np.uint64(W._STEP)  # holds the implied end
    return h


def common_prefixes(t: np.ndarray, sa: np.ndarray, limit: int) -> np.ndarray:
    """Permuted common prefixes: for each place, the common prefix with the suffix before it in
    order, up to the least 2**k - 1 >= limit; by halving over hashes of doubling windows."""
    n = len(t)
    before = np.full(n, -1, np.int64)
    before[sa[1:]] = sa[:-1]
    # Ends all differ, so that no match runs past the array.
    levels = [W.finish(t.astype(np.uint64) + np.uint64(1))]
    while (2 << len(levels)) - 1 <= 2 * limit and (1 << len(levels)) <= limit:
        block, span = levels[-1], 1 << (len(levels) - 1)
        wider = np.arange(n, dtype=np.uint64)
        if n > span:
            wider[: n - span] = block[: n - span] * np.uint64(pow(W._STEP, span, 1 << 64)) + block[span:]
        wider[max(0, n - 2 * span + 1) :] = np.arange(max(0, n - 2 * span + 1), n, dtype=np.uint64) * np.uint64(W._STEP)
        levels.append(wider)
    length = np.zeros(n, np.int64)
    live = before >= 0
    place, other = np.arange(n), np.maximum(before, 0)
    for k in range(len(levels) - 1, -1, -1):
        i, j = np.minimum(place + length, n - 1), np.minimum(other + length, n - 1)
        same = live & (levels[k][i] == levels[k][j]) & (np.maximum(place, other) + length < n)
        length += same.astype(np.int64) << k
    return length
