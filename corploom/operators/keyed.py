"""A table of last known values by key, and what a landing of fresh answers does to it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

STATE = "key string, scope string, name string, value bigint, pending_value bigint, status string, cached boolean, changed_batch bigint"
CHANGE = "key string, scope string, name string, change_type string, old_value bigint, new_value bigint, delta bigint, needs_human_review boolean"
LANDING = "key string, scope string, name string, value bigint, checked boolean"


def large_change(old: Column, new: Column) -> Column:
    return F.abs(new - old) > F.greatest(F.lit(1000.0), old * 0.5)


def one_answer_per_key(landing: DataFrame) -> DataFrame:
    """Of several answers to a key in one landing, a checked one, then the highest value, then the last name in order."""
    order = F.struct("checked", "value", "name")
    named = landing.filter("key is not null").withColumn("scope", F.coalesce("scope", F.lit("")))
    filled = named.withColumn("checked", F.coalesce("checked", F.lit(False)) & F.col("value").isNotNull())
    return filled.groupBy("scope", "key").agg(F.max_by(F.struct("name", "value", "checked"), order).alias("a")).select("scope", "key", "a.*")


def upsert(state: DataFrame, landing: DataFrame, batch_id: int) -> DataFrame:
    """Full outer join of the state with a landing that lists its scopes whole, each row judged once.

    Every row has the columns of STATE as they are after the landing and, as `change`, what is to
    be reported (null for most). A key without an answer any more is kept and marked missing; one that
    could not be checked keeps its value and is marked as cached; a small change is taken
    over; a large one waits in `pending_value` and is reported once, however often it lands again; a value
    that falls back to the known one clears what waits. New, missing and returned keys are always for review.
    """
    known = state.select("scope", "key", F.struct(*[c for c in state.columns if c not in ("scope", "key")]).alias("s"))
    fresh = one_answer_per_key(landing).select("scope", "key", F.struct("name", "value", "checked").alias("b"))
    both = known.join(fresh, ["scope", "key"], "full_outer")
    s, b = F.col("s"), F.col("b")
    checked = F.coalesce(b["checked"], F.lit(False))
    gone = b.isNull()
    first = ~gone & checked & (s.isNull() | s["value"].isNull())
    returned = ~gone & s.isNotNull() & (s["status"] == "missing") & ~first
    delta = b["value"] - s["value"]
    differs = checked & s["value"].isNotNull() & (delta != 0)
    held = differs & large_change(s["value"], b["value"])
    told = F.coalesce(s["pending_value"] == b["value"], F.lit(False))
    kind = (
        F.when(gone & (s["status"] != "missing"), "missing")
        .when(first, "new")
        .when(differs & ~(held & told), "changed")
        .when(returned, "returned")
    )
    change = F.when(
        kind.isNotNull(),
        F.struct(
            kind.alias("change_type"),
            s["value"].alias("old_value"),
            F.when(checked, b["value"]).alias("new_value"),
            F.when(checked, delta).alias("delta"),
            F.when(kind == "changed", held).otherwise(True).alias("needs_human_review"),
        ),
    )
    value = F.when(first | (differs & ~held), b["value"]).otherwise(s["value"])
    pending = F.when(held, b["value"]).when(~checked, s["pending_value"])
    return both.select(
        "key",
        "scope",
        F.coalesce(b["name"], s["name"]).alias("name"),
        value.alias("value"),
        pending.alias("pending_value"),
        F.when(gone, "missing").otherwise("present").alias("status"),
        (~gone & ~checked & s["value"].isNotNull()).alias("cached"),
        F.when(change.isNotNull(), F.lit(batch_id)).otherwise(s["changed_batch"]).cast("bigint").alias("changed_batch"),
        change.alias("change"),
    )
