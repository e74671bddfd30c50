"""Benchmark matches under repetition: longest matches against all pairs, hot words, long texts, blocks."""

import random
import time
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from corploom.llm import decontamination as D
from corploom.llm import words as W
from corploom.llm import rules


def matches_of(doc, item, k):
    """All (item_start, doc_start, length) that can't be extended."""
    depth, out = min(k, len(item)), set()
    for p in range(len(doc)):
        for s in range(len(item)):
            n = 0
            while p + n < len(doc) and s + n < len(item) and doc[p + n] == item[s + n]:
                n += 1
            extends = p and s and doc[p - 1] == item[s - 1]
            if depth and n >= depth and not extends:
                out.add((s, p, n))
    return out


def shard(texts):
    import pyarrow as pa

    values, offsets = W.raw(pa.array(texts, pa.string()))
    starts, ends, first = W.places(values, offsets, W.LETTERS)
    return W.hashed(values, starts, ends, fold=True), first


@pytest.mark.parametrize("k", [1, 2, 3, 5, 10])
def test_longest_matches_equal_all_pairs(k):
    r = random.Random(k)
    draw = lambda n: [r.choice("ab") for _ in range(n)]
    for _ in range(60):
        items = [draw(r.choice([0, 1, 2, 4, 9, 30])) for _ in range(r.randrange(5))]
        items = [list(x) for x in {tuple(i) for i in items}]
        docs = [draw(r.choice([0, 1, 3, 12, 40])) + r.choice([[], items[0] if items else []]) for _ in range(4)]
        asked = D.suffixes([" ".join(i) for i in items], [[str(i)] for i in range(len(items))], k)
        h, first = shard([" ".join(d) for d in docs])
        hits = D.search(h, first, asked, k)
        place, entry, length = D.longest(h, first, asked, hits)
        got = Counter()
        for p, e, n in zip(place.tolist(), entry.tolist(), length.tolist(), strict=True):
            d, t = np.searchsorted(first, p, "right") - 1, np.searchsorted(asked.first, e, "right") - 1
            got[(int(d), int(t), e - int(asked.first[t]), p - int(first[d]), n)] += 1
        expected = Counter((d, t, *m) for d, x in enumerate(docs) for t, y in enumerate(items) for m in matches_of(x, y, k))
        assert got == expected
        for d, x in enumerate(docs):
            inside = {w for (dd, _, _, p, n) in expected for w in range(p, p + n) if dd == d}
            assert hits.inside[first[d] : first[d + 1]].tolist() == [w in inside for w in range(len(x))]
            assert hits.items[d] == {str(t) for (dd, t, *_) in expected if dd == d}


def test_a_word_repeated_in_document_and_item():
    begun = time.time()
    asked = D.suffixes(["spam " * 5_000, "Spam ham " * 2_000], [["a"], ["b", "c"]], 10)
    h, first = shard(["x " + "SPAM " * 50_000, "ham spam " * 20_000, "spam " * 9])
    hits = D.search(h, first, asked, 10)
    assert [int(n) for n in W.per_text(hits.inside, first)] == [50_000, 40_000, 0]
    assert hits.items == [{"a"}, {"b", "c"}, set()]
    place, entry, length = D.longest(h, first, asked, hits)
    assert (length[(place == 1) & (entry == 0)] == 5_000).all() and int((length == 5_000).sum()) == 45_001
    assert time.time() - begun < 20


def test_a_block_is_small():
    import pickle

    r = random.Random(1)
    texts = [" ".join(f"w{r.randrange(50_000)}" for _ in range(200)) for _ in range(1_000)]
    asked = D.suffixes(texts, [[str(i)] for i in range(len(texts))], 10)
    assert len(pickle.dumps(asked)) < 60 * 200_000


def test_long_texts_and_blocks(spark):
    r = random.Random(2)
    item = [f"q{i}" for i in range(40)]
    long = [f"w{r.randrange(10**6)}" for _ in range(300_000)]
    long[250_000:250_000] = item[5:30]
    table = [(1, " ".join(long)), (2, " ".join(item)), (2, " ".join(item)), (None, None), (3, "")]
    docs = spark.createDataFrame(table, "doc_id long, text string").selectExpr("*", "1 as hits", "'x' as items")
    assert len(table[0][1]) > 4 * W.SLICE
    items = spark.createDataFrame([(7, " ".join(item)), (8, " ".join(item[20:35])), (9, "q39")], "item_id long, text string")
    for block in (10**6, 20):
        for asked in (True, False):
            rows = D.match_benchmark(docs, items, block_words=block, matches=asked)
            assert ("matches" in rows.columns) == asked
            got = Counter((x["doc_id"], x["n_words"], x["n_hit"], tuple(x["items"]), tuple(map(tuple, x["hits"]))) for x in rows.collect())
            whole = (2, 40, 40, ("7", "8", "9"), ((0, 40),))
            assert got == Counter([(1, 300_025, 25, ("7", "8"), ((250_000, 250_025),)), whole, whole, (None, 0, 0, (), ()), (3, 0, 0, (), ())])
        found = D.match_benchmark(docs, items, block_words=block).filter("doc_id = 1").select(F.explode("matches").alias("m")).collect()
        assert {tuple(x["m"]) for x in found} == {("7", 5, 250_000, 25), ("8", 0, 250_015, 10)}


def test_labels_in_conflict_teach_nothing(spark):
    r = random.Random(3)
    table = [(i, " ".join(f"{'!!' if i % 2 else ''}w{r.randrange(900)}" for _ in range(60))) for i in range(400)]
    docs = spark.createDataFrame(table, "doc_id long, text string")
    labels = [(i, 1 - i % 2) for i in range(400)]
    plain = rules.learn(docs, spark.createDataFrame(labels[:300], "doc_id long, quality int"))
    mixed = labels + [(i, i % 2) for i in range(300, 400)] + labels[:50] + [(None, 0), (5, None)]
    for seed in (1, 2):
        random.Random(seed).shuffle(mixed)
        assert rules.learn(docs, spark.createDataFrame(mixed, "doc_id long, quality int")) == plain
    assert plain
