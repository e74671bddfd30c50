"""An append-only log of decisions about proposed words, and what it says about each of them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# One row for each decision: `seq` rises as events are appended, `decided_at` is when the person decided.
EVENT = "seq bigint, word string, candidate string, decision string, decided_at bigint"
ACCEPT, REJECT = "accept", "reject"


def latest(events: DataFrame) -> DataFrame:
    """(word, decision, form, decided_at, events, overruled, late): the decision in force for each word.

    The one decided last holds, whenever it arrived; of several at one time, the last appended.
    `overruled` says that an earlier decision was another one, `late` that the log's last event
    was decided before another, so it changed nothing. All are folded before the shuffle.
    """
    known = events.filter(F.col("word").isNotNull() & F.col("decision").isin(ACCEPT, REJECT))
    what = F.struct("decision", "candidate")
    order = F.struct("decided_at", "seq")
    return (
        known.groupBy("word")
        .agg(
            F.max_by(F.struct("decision", "candidate", "decided_at"), order).alias("last"),
            F.count("*").alias("events"),
            (F.min(what) != F.max(what)).alias("overruled"),
            (F.max_by("decided_at", "seq") < F.max("decided_at")).alias("late"),
        )
        .select("word", "last.decision", F.when(F.col("last.decision") == ACCEPT, F.col("last.candidate")).alias("form"), "last.decided_at", "events", "overruled", "late")
    )


def decided(proposals: DataFrame, events: DataFrame) -> DataFrame:
    """The proposals (one row per word) with `decision` (pending, accepted, rejected) and `form`, the word that stands.

    Nothing is applied without a decision: a pending or rejected word keeps its form. An event about a word
    that is not proposed has no effect. Columns of `proposals` with the names of results are replaced.
    """
    results = ("decision", "form", "decided_at", "events", "overruled", "late")
    kept = [c for c in proposals.columns if c not in results]
    joined = proposals.select(*kept).join(latest(events).withColumnRenamed("form", "_form"), "word", "left")
    state = F.when(F.col("decision") == ACCEPT, "accepted").when(F.col("decision") == REJECT, "rejected").otherwise("pending")
    return joined.select(
        *kept,
        state.alias("decision"),
        F.coalesce("_form", "word").alias("form"),
        "decided_at",
        F.coalesce("events", F.lit(0)).cast("bigint").alias("events"),
        F.coalesce("overruled", F.lit(False)).alias("overruled"),
        F.coalesce("late", F.lit(False)).alias("late"),
    )
