"""Spelling variants against brute force."""

import random
import re
import zlib
from collections import Counter

import pytest

from corploom.llm import variants

UPPER = {ord(c): chr(ord(c) + 32) for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"}


def counted(rows, shortest=5, fewest=3):
    found = Counter()
    for key, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(UPPER)
            h = zlib.crc32(f"{'null' if key is None else key}:{run}".encode())
            if h % 97 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            found[run] += 1
    return {w: n for w, n in found.items() if len(w) >= shortest and n >= fewest}


def near(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    short, long_ = sorted((a, b), key=len)
    return len(long_) - len(short) == 1 and any(long_[:i] + long_[i + 1 :] == short for i in range(len(long_)))


def expected(words):
    forms, out = {}, {}
    for w, n in words.items():
        others = [o for o in words if near(w, o)]
        best = min(others, key=lambda o: (-words[o], o), default=None)
        forms[w] = best if best is not None and words[best] >= 2 * n else None
        out[w] = len(others)
    rows = set()
    for w, n in words.items():
        root = w
        while forms[root] is not None:
            root = forms[root]
        rows.add((w, forms[w], root, n, out[w], words[forms[w]] if forms[w] is not None else None))
    return rows


def asked(spark, words, parts=None):
    table = spark.createDataFrame([(w, n, "x") for w, n in words.items()], "word string, n long, place string")
    found = variants.variants(table).collect()
    assert len(found) == len(words)
    return {tuple(r) for r in found}


def many(seed, n=400):
    r = random.Random(seed)
    words = {"".join(r.choice("abàÿÀ") for _ in range(r.randint(1, 7))): r.randint(1, 200) for _ in range(n)}
    return words | {"aaaaaaa": 3, "aaaaaa": 9, "": 4, "zebra": 1, "b" * 3000: 2, "b" * 2999: 5, "b" * 1500 + "a" + "b" * 1500: 2, "𐍈ab": 2, "ab𐍈": 7, "ab": 3}


@pytest.mark.parametrize("seed", [1, 2])
def test_variants_by_brute_force(spark, seed):
    words = many(seed)
    assert asked(spark, words) == expected(words)


def test_partition_borders_without_broadcasts(spark, monkeypatch):
    words = many(5, 150)
    whole = expected(words)
    parts = spark.conf.get("spark.sql.shuffle.partitions")
    plain = variants.lookup
    monkeypatch.setattr(variants, "lookup", lambda *a: plain(*a, broadcast_rows=0))
    try:
        for n in (1, 61):
            spark.conf.set("spark.sql.shuffle.partitions", n)
            spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
            assert asked(spark, words) == whole
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", parts)
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_node_numbers(spark):
    words = sorted(many(7, 200))
    table = spark.createDataFrame([(w,) for w in words], "word string").repartition(5)
    rows = sorted(variants.trie_nodes(table, "word", 3001).collect(), key=lambda r: r["place"])
    assert [r["word"] for r in rows] == words
    seen = {}
    for r in rows:
        assert len(r["nodes"]) == len(r["word"]) + 1
        for d, node in enumerate(r["nodes"][:9]):
            assert seen.setdefault(node, r["word"][:d]) == r["word"][:d]
    prefixes = {w[:d] for w in words for d in range(min(len(w), 8) + 1)}
    assert len(seen) == len(prefixes)


def test_counted_words(spark):
    r = random.Random(4)
    vocabulary = ["".join(r.choice("abÉé×÷À") for _ in range(r.randint(3, 6))) for _ in range(40)]
    rows = [(i, " ".join(r.choice(vocabulary).title() + r.choice(["", ".", "-"]) for _ in range(60))) for i in range(80)]
    rows += [(3, "Wiederholt wiederholt"), (3, "Wiederholt wiederholt"), (None, "wiederholt"), (None, None), (9, ""), (10, "lang" * 300_000), (11, "lang" * 300_000 + " x"), (12, "LANG" * 300_000)]
    docs = spark.createDataFrame([(*row, 5, "w") for row in rows], "doc_id long, text string, n long, word string")
    found = {r["word"]: r["n"] for r in variants.count_words(docs).collect()}
    assert found == counted(rows)
    assert any(len(w) >= 1_200_000 - 1 for w in found)


def test_empty_and_null(spark):
    assert variants.variants(spark.createDataFrame([], "word string, n long")).collect() == []
    only = spark.createDataFrame([(None, 3), ("abc", 2)], "word string, n long")
    assert [tuple(r) for r in variants.variants(only).collect()] == [("abc", None, "abc", 2, 0, None)]
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert variants.variants(variants.count_words(docs)).collect() == []


def test_chain_of_forms(spark):
    words = {"a" * 5 + "b" * i: 2**i for i in range(12)}
    found = {r["word"]: r["root"] for r in variants.variants(spark.createDataFrame(list(words.items()), "word string, n long")).collect()}
    assert set(found.values()) == {"a" * 5 + "b" * 11}


def test_ratio_must_end_chains(spark):
    with pytest.raises(ValueError):
        variants.variants(spark.createDataFrame([("a", 1)], "word string, n long"), ratio=1)
