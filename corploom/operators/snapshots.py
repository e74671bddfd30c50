"""Comparing, repairing and refreshing snapshots."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corploom.functions import text as tx


def diff(old: DataFrame, new: DataFrame, key: str, value: str, name: str) -> DataFrame:
    """New keys, missing keys and changed counts; unchanged rows leave no trace."""
    a = old.select(key, F.col(value).cast("long").alias("old_pairs"), F.lit(True).alias("_old"))
    b = new.select(key, F.col(value).cast("long").alias("new_pairs"), F.col(name), F.lit(True).alias("_new"))
    both = a.join(b, key, "full_outer")
    added, gone = F.col("_old").isNull(), F.col("_new").isNull()
    changed = ~added & ~gone
    delta = F.col("new_pairs") - F.col("old_pairs")
    kind = (
        F.when(added, "new_language").when(gone, "missing_language").when(delta != 0, "parallel_count_changed")
    )
    large = F.abs(delta) > F.greatest(F.lit(1000.0), F.col("old_pairs") * 0.5)
    return (
        both.select(
            key,
            F.when(changed, F.col(name)).alias(name),
            kind.alias("change_type"),
            F.when(changed, F.col("old_pairs")).alias("old_pairs"),
            F.when(changed, F.col("new_pairs")).alias("new_pairs"),
            F.when(changed, delta).alias("delta"),
            F.when(changed, large).otherwise(True).alias("needs_human_review"),
        )
        .filter(F.col("change_type").isNotNull())
        .orderBy(key)
    )


def carry_forward(current: DataFrame, previous: DataFrame, key: str, checked: str, code: str, values: list[str]) -> DataFrame:
    """Where a source could not be checked, keep the previous counts and say so."""
    last = previous.select(key, *[F.col(v).alias(f"_prev_{v}") for v in values], F.lit(True).alias("_seen"))
    use = ~F.col(checked) & F.col(code).isNotNull() & F.coalesce("_seen", F.lit(False))
    joined = current.join(last, key, "left")
    others = [c for c in current.columns if c not in values]
    return joined.select(
        *others,
        *[F.when(use, F.col(f"_prev_{v}")).otherwise(F.col(v)).alias(v) for v in values],
        use.alias("cached_from_previous_run"),
    )


def as_of(runs: DataFrame, key: str, run: str, checked: str, code: str, error: str, values: list[str]) -> DataFrame:
    """Every run of an inventory as it was known then: where a key could not be checked, its last checked values.

    `runs` has a row for each key and run (each run a partition). A key with a code that was not checked
    takes the values of the latest earlier run that checked it, with `from_run` naming that run and
    `cached_from_previous_run` set; without an earlier one its values are 0. `error` stays the run's own.
    A key has one row a run, so a window holds no more rows than there are runs.
    """
    before = Window.partitionBy(key).orderBy(run).rowsBetween(Window.unboundedPreceding, -1)
    good = F.when(F.col(checked), F.struct(*values, F.col(run).alias("_run")))
    known = F.last(good, ignorenulls=True).over(before)
    use = ~F.col(checked) & F.col(code).isNotNull() & F.col("_known").isNotNull()
    return runs.withColumn("_known", known).select(
        *[c for c in runs.columns if c not in (*values, error)],
        F.when(~F.col(checked), F.coalesce(error, F.lit(""))).otherwise("").alias(error),
        *[F.when(use, F.col("_known")[v]).when(F.col(checked), F.coalesce(v, F.lit(0))).otherwise(0).alias(v) for v in values],
        F.when(use, F.col("_known")["_run"]).when(F.col(checked), F.col(run)).alias("from_run"),
        use.alias("cached_from_previous_run"),
    )


def update_where(df: DataFrame, mask: Column, column: str, value: Column) -> DataFrame:
    return df.withColumn(column, F.when(mask, value).otherwise(F.col(column)))


def safe_update(old: DataFrame, new: DataFrame, changes: DataFrame, key: str, safe: list[str]) -> DataFrame:
    """Take over safe fields (counts, dates, links) except where a change waits for review."""
    held = changes.filter("needs_human_review").select(key, F.lit(True).alias("_held"))
    fresh = new.select(key, *[F.col(s).alias(f"_new_{s}") for s in safe])
    joined = old.join(fresh, key, "left").join(held, key, "left")
    rest = [c for c in old.columns if c not in safe]
    return joined.select(
        *rest,
        *[F.when(F.col("_held").isNull(), F.coalesce(f"_new_{s}", s)).otherwise(F.col(s)).alias(s) for s in safe],
    )


def changed_texts(current: DataFrame, text: Column, row_id: str, known_hashes: DataFrame) -> DataFrame:
    """Texts not seen before: one row per new hash (lowest id, number of copies).

    Hashes are made unique first, so the anti-join meets no hot key.
    """
    fresh = current.groupBy(tx.text_hash(text).alias("text_hash")).agg(
        F.min(row_id).alias(row_id), F.count("*").alias("copies")
    )
    return fresh.join(known_hashes.select("text_hash").distinct(), "text_hash", "left_anti")
