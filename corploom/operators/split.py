"""Train/dev/test splits, folds, leak reports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corploom.functions import text as tx
from corploom.operators.bitfilter import bit_table, bits_for, may_hold
from corploom.operators.lookup import lookup, settled

NAMES = ("train", "dev", "test")


def exact_split(df: DataFrame, row_id: str, seed: int = 42, cuts: tuple[float, float] = (0.8, 0.9)) -> DataFrame:
    """Split by rank in hash order with exact sizes floor(n * cut).

    No row is ranked against all others: a histogram over the first four hash
    digits (65,536 bins at most) finds the bins holding the cut ranks, a second one
    splits these by the next four, and only what is left (n / 2**32 rows a cut) is
    sorted to read the two cut hashes. `df` is checkpointed (it is read
    several times): pass ids and numbers, and join the texts where they are written.
    """
    df = settled(df.withColumn("_h", tx.seeded_md5(row_id, seed=seed)))
    hashes = df.select(F.col("_h").alias("h"))
    binned = hashes.withColumn("bin", F.substring("h", 1, 4))
    before = F.sum("n").over(Window.orderBy("bin").rowsBetween(Window.unboundedPreceding, Window.currentRow)) - F.col("n")
    histogram = binned.groupBy("bin").agg(F.count("*").alias("n")).select("bin", "n", before.alias("before"))
    total = hashes.agg(F.count("*")).scalar()
    ranks = F.array(*[F.struct(F.lit(i).alias("cut"), F.floor(total * F.lit(c)).alias("k")) for i, c in enumerate(cuts)])
    cut_bins = (
        histogram.select("bin", "n", "before", F.explode(ranks).alias("r"))
        .filter((F.col("r.k") >= F.col("before")) & (F.col("r.k") < F.col("before") + F.col("n")))
        .select("bin", "r.cut", (F.col("r.k") - F.col("before") + 1).alias("nth"))
    )
    # The bins that hold the cuts are split once more by the next four digits.
    finer = hashes.withColumn("bin", F.substring("h", 1, 4)).join(F.broadcast(cut_bins), "bin").withColumn("fine", F.substring("h", 1, 8))
    within = Window.partitionBy("cut").orderBy("fine").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    fine_bins = (
        finer.groupBy("cut", "nth", "fine")
        .agg(F.count("*").alias("n"))
        .withColumn("before", F.sum("n").over(within) - F.col("n"))
        .filter((F.col("nth") > F.col("before")) & (F.col("nth") <= F.col("before") + F.col("n")))
        .select("cut", "fine", (F.col("nth") - F.col("before")).alias("nth"))
    )
    order = Window.partitionBy("cut").orderBy("h")
    cut_hashes = (
        hashes.withColumn("fine", F.substring("h", 1, 8))
        .join(F.broadcast(fine_bins), "fine")
        .withColumn("rn", F.row_number().over(order))
        .filter(F.col("rn") == F.col("nth"))
        .agg(*[F.max(F.when(F.col("cut") == i, F.col("h"))).alias(f"t{i}") for i in range(len(cuts))])
    )
    bounds = cut_hashes.select(F.struct(*cut_hashes.columns)).scalar()
    h = F.col("_h")
    return df.withColumn(
        "split",
        F.when(h < bounds.getField("t0"), NAMES[0]).when(h < bounds.getField("t1"), NAMES[1]).otherwise(NAMES[2]),
    ).drop("_h")


def threshold_split(key: Column | str, seed: int = 42, cuts: tuple[float, float] = (0.8, 0.9)) -> Column:
    """Split decided per row by its hash: no shuffle, and stable while the data grows.

    Rows with the same key share a split; pass a text hash, a source or an author
    to keep copies, or whole groups, together.
    """
    u = tx.hash_fraction(key, seed=seed)
    return F.when(u < cuts[0], NAMES[0]).when(u < cuts[1], NAMES[1]).otherwise(NAMES[2])


def fold(key: Column | str, folds: int, seed: int = 42) -> Column:
    return F.pmod(tx.hash_number(key, seed=seed), F.lit(folds))


def leaks(df: DataFrame, text: Column, split: str = "split") -> DataFrame:
    """Texts present in more than one split, counted per combination of splits."""
    per_text = df.groupBy(tx.text_hash(text).alias("hash"), split).agg(F.count("*").alias("n"))
    return (
        per_text.groupBy("hash")
        .agg(F.array_join(F.array_sort(F.collect_set(split)), "+").alias("splits"), F.sum("n").alias("n"))
        .filter(F.contains("splits", F.lit("+")))
        .groupBy("splits")
        .agg(F.count("*").alias("texts"), F.sum("n").alias("documents"))
    )


def held_out_overlap(
    df: DataFrame, row_id: str, text: str, held_out: DataFrame, held_text: str, width: int = 8
) -> DataFrame:
    """Rows that share word n-grams with a held-out set, and how many of them.

    A bit table of the held-out n-grams lets through few others in the scan; what passes is compared
    exactly, so that no more than the hits (and rare false ones) are shuffled, however long either side is.
    """
    asked = held_out.select(F.explode(tx.word_ngrams(F.col(held_text), width)).alias("gram"))
    asked = settled(asked.select(F.xxhash64("gram").alias("h"), F.md5("gram").alias("gram")).distinct())
    bits = bits_for(asked)
    known = bit_table(asked, "h", bits)
    grams = df.select(row_id, F.explode(F.array_distinct(tx.word_ngrams(F.col(text), width))).alias("gram"))
    hits = settled(grams.filter(may_hold(known, F.xxhash64("gram"), bits)).select(row_id, F.md5("gram").alias("gram")))
    uses = hits.groupBy("gram").agg(F.count("*").alias("_n")).join(asked.select("gram", F.lit(True).alias("held")), "gram")
    shared = lookup(hits, uses, "gram", F.col(row_id), "_n").filter("held")
    return shared.groupBy(row_id).agg(F.count("*").alias("shared_ngrams"))
