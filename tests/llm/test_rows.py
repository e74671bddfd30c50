"""Shards against plain ranks and fractions; rows that are null, repeated or very long through the pipeline's stages."""

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from corploom.llm import sharding

DATA = "/root/testdata/sf0.001"


def in_plain_python(rows, shards):
    """(doc_id, shard, slot) from (doc_id, source, name, hash, share): rank, fraction, order, cut."""
    ranked, counts = [], Counter(r[2] for r in rows)
    for name in counts:
        own = sorted((r for r in rows if r[2] == name), key=lambda r: r[3])
        ranked += [((rank + own[0][4]) / counts[name], name, rank, r[0]) for rank, r in enumerate(own)]
    n, out, slots = len(rows), [], Counter()
    for place, (_, _, _, doc) in enumerate(sorted(ranked)):
        shard = place * shards // n
        out.append((doc, shard, slots[shard]))
        slots[shard] += 1
    return sorted(out)


@pytest.mark.parametrize("shards", [1, 7, 40])
def test_shards_equal_plain_ranks(spark, shards):
    r = random.Random(shards)
    table = [(i, f"text {i % 50}", r.choice(["hot"] * 6 + ["a", "b", "rare", None])) for i in range(900)]
    docs = spark.createDataFrame(table, "doc_id long, text string, source string")
    size, crc = F.octet_length("text") + 16, F.crc32(F.col("text").cast("binary"))
    name = F.coalesce(F.concat(F.lit("="), "source"), F.lit(""))
    hashed = F.shiftrightunsigned(F.xxhash64(F.lit(17), F.col("doc_id").cast("string"), crc, size.cast("long")), 1)
    share = F.shiftrightunsigned(F.xxhash64(F.lit(17), name), 11) / float(1 << 53)
    facts = [tuple(x) for x in docs.select("doc_id", "source", name, hashed, share).collect()]
    base = docs.select("doc_id", "source", size.cast("long").alias("size"), crc.alias("text_crc32"))
    for bucket in (4096, 16):
        got = sharding.interleave(base, shards, "source", "doc_id", ["text_crc32", "size"], bucket_rows=bucket)
        assert sorted((x["doc_id"], x["shard"], x["slot"]) for x in got.collect()) == in_plain_python(facts, shards)
    whole = sharding.shard_table(docs.withColumn("shard", F.lit("x")).withColumn("_n", F.lit(1)), shards)
    assert sorted((x["doc_id"], x["shard"], x["slot"]) for x in whole.collect()) == in_plain_python(facts, shards)


def test_stages_take_nulls_repeats_and_clashing_columns(spark):
    r = random.Random(4)
    words = [f"{a}{b}er" for a in "bdfglmnprst" for b in "aeiou"]
    text = lambda n: " ".join(r.choice(words) for _ in range(n))
    long = text(260_000)
    table = [(1, text(80), "s"), (2, None, "s"), (None, text(70), None), (3, "", None), (4, long, "t")]
    table += [(5, text(60), "t")] * 3 + [(5, text(60), "t"), (6, "x", "t"), (None, None, None)]
    docs = spark.createDataFrame(table, "doc_id long, text string, source string")
    docs = docs.selectExpr("*", "1 as kept", "2 as hits", "3 as size", "4 as _n", "5 as n_words")
    assert len(long) > 1 << 20
    columns, at = docs.columns, docs
    left = {"quality_rules": 7, "near_duplicates": 5, "benchmark_decontamination": 5}
    for name, stage in corpus_pipeline.STAGES:
        at = stage(spark, at, DATA).cache()
        got = at.collect()
        if name in left:
            assert at.columns == columns and len(got) == left[name]
            assert Counter(got) <= Counter(docs.collect())
    assert [x["slot"] for x in got] and max(Counter((x["shard"], x["slot"]) for x in got).values()) == 1
