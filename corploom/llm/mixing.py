"""Mixing sources to target weights by hash thresholds."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from corploom.llm.shared import settled, shared_table

# Bits of the hash that each histogram level resolves; 4 levels resolve all 63.
BITS = 16
LEVELS = 4


def targets(sizes: DataFrame, weights: tuple[int, ...], most: float) -> DataFrame:
    """(_source, _null, source_size, target) from one row per source.

    Sources take the weights in code-point order (null last), repeating. A target stops at
    `most` times its source; the level at which all caps hold comes from one pass over the
    sources in order of cap per weight, which is where repeated resharing ends.
    """
    by_name = Window.orderBy("_null", "_source")
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.row_number().over(by_name) - 1) % len(weights) + 1)
    rows = sizes.select("*", weight.alias("_weight"), (F.col("source_size") * most).alias("_cap"))
    rows = rows.withColumn("_ratio", F.col("_cap") / F.col("_weight"))
    by_ratio = Window.orderBy("_ratio", "_null", "_source")
    below = by_ratio.rowsBetween(Window.unboundedPreceding, -1)
    above = by_ratio.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    everything = Window.partitionBy()
    rows = rows.withColumn(
        "_level",
        (F.sum("source_size").over(everything) - F.coalesce(F.sum("_cap").over(below), F.lit(0.0)))
        / F.sum("_weight").over(above),
    )
    place = F.when(F.col("_level") <= F.col("_ratio"), F.struct("_ratio", "_null", "_source"))
    level = F.min_by("_level", place).over(everything)
    capped = rows.withColumn("_common", level)
    return capped.select(
        "_source", "_null", "source_size", F.least("_cap", F.coalesce(F.col("_weight") * F.col("_common"), "_cap")).alias("target")
    )


def thresholds(narrow: DataFrame, weights: tuple[int, ...], most: float) -> DataFrame:
    """One row per source: whole passes, and the hash below which documents get one pass more.

    The words of a source are summed by hash bucket; the bucket in which the budget ends is
    the only one that the next level splits. At the last level a bucket is one hash.
    """
    sizes = narrow.groupBy("_source", "_null").agg(F.sum("_size").alias("source_size"))
    plan = targets(sizes, weights, most)
    passes = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0)
    plan = plan.withColumn("_passes", passes.cast("long"))
    left = F.col("target") - F.col("_passes") * F.col("source_size")
    plan = shared_table(
        plan.withColumn("_rest", F.greatest(F.lit(0.0), F.least(left, F.col("source_size") - 0.5))), "mix-targets"
    )
    state = plan.select("_source", F.lit(0).cast("long").alias("_prefix"), F.col("_rest").alias("_need"))
    ordered = Window.partitionBy("_source").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    for level in range(LEVELS):
        shift = BITS * (LEVELS - 1 - level)
        inside = narrow.withColumn("_bucket", F.shiftright("_hash", shift))
        counts = inside.groupBy("_source", "_bucket").agg(F.sum("_size").alias("_sum")) if level == 0 else (
            inside.withColumn("_prefix", F.shiftright("_bucket", BITS))
            .join(state.select("_source", "_prefix"), ["_source", "_prefix"])
            .groupBy("_source", "_bucket")
            .agg(F.sum("_size").alias("_sum"))
        )
        edge = (
            counts.withColumn("_upto", F.sum("_sum").over(ordered))
            .join(state.select("_source", "_need"), "_source")
            .filter((F.col("_upto") > F.col("_need")) & (F.col("_upto") - F.col("_sum") <= F.col("_need")))
        )
        state = shared_table(
            edge.select(
                "_source",
                F.col("_bucket").alias("_prefix"),
                (F.col("_need") - F.col("_upto") + F.col("_sum")).alias("_need"),
                F.col("_sum").alias("_there"),
            ),
            "mix-level",
        )
    cuts = state.select("_source", F.col("_prefix").alias("_cut"), "_need", "_there")
    return shared_table(plan.join(cuts, "_source", "left"), "mix-cuts")


def mix(
    docs: DataFrame,
    size: Column,
    source: str = "source",
    key: str = "doc_id",
    weights: tuple[int, ...] = (5, 2, 1),
    most: float = 3.0,
    seed: int = 17,
    whole: bool = False,
) -> DataFrame:
    """The columns of `docs` plus size, source_size, target and taken.

    The sum of all sizes is shared among the sources by `weights`. A source whose target is
    over its size is repeated; of the last pass, documents below the source's hash threshold
    are taken. The document at the threshold is taken in part, as a budget that ends inside a
    document, or with `whole` either fully or not, whichever is nearer.

    Nothing is sorted or collected: the cost is a scan, one histogram of at most 65,536 buckets
    a source, and one row per source for each finer level. Rows of one key share its hash, so
    repeated rows are taken alike and share the rest in proportion. A null text has size 0 and
    takes nothing; a null source is a source of its own; a null key has a hash of its own. An
    empty table gives no rows. Columns of `docs` with the names of results are replaced.
    """
    name = F.coalesce(F.concat(F.lit("="), F.col(source).cast("string")), F.lit(""))
    position = F.shiftrightunsigned(F.xxhash64(F.lit(seed), F.coalesce(F.col(key).cast("string"), F.lit("\x00null"))), 1)
    named = [name.alias("_source"), F.col(source).isNull().alias("_null"), position.alias("_hash"), size.cast("long").alias("_size")]
    cuts = thresholds(settled(docs.select(*named)), weights, most).drop("_null")
    kept = [c for c in docs.columns if c not in ("size", "source_size", "target", "taken")]
    rows = docs.select(*[F.col(f"`{c}`") for c in kept], *named).join(cuts, "_source", "left")
    whole_part = F.when(F.col("_need") * 2 >= F.col("_there"), F.col("_size")).otherwise(0)
    part = whole_part if whole else F.floor(F.col("_size") * F.col("_need") / F.col("_there"))
    last = F.when(F.col("_hash") < F.col("_cut"), F.col("_size")).when(F.col("_hash") == F.col("_cut"), part).otherwise(0)
    return rows.select(
        *[F.col(f"`{c}`") for c in kept],
        F.col("_size").alias("size"),
        "source_size",
        "target",
        (F.col("_passes") * F.col("_size") + F.coalesce(last, F.lit(0))).cast("long").alias("taken"),
    )
