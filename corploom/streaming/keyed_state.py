"""Scheduled refresh with state by key: a landing reads and rewrites its own buckets only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from corploom.operators import keyed
from corploom.operators.lookup import settled
from corploom.sources.files import read_or_else

# Buckets of scopes, and parts of each: a scope of any size is spread over its parts.
SCOPES, PARTS = 64, 4


class KeyedState:
    """State in the folder `path`: rows by (batch, bucket), changes by batch, and a log of written buckets.

    A batch writes new versions of the buckets that hold its scopes, then, as its last step, says so in the
    log. Readers take each bucket's latest logged version, so a batch that dies halfway is
    invisible, and one that runs again reads what was there before it and writes the same.
    """

    def __init__(self, spark: SparkSession, path: str, scopes: int = SCOPES, parts: int = PARTS) -> None:
        self.spark, self.path, self.scopes, self.parts = spark, path, scopes, parts

    def scope_bucket(self, scope: Column) -> Column:
        return F.pmod(F.xxhash64(scope), F.lit(self.scopes)).cast("int")

    def bucket(self) -> Column:
        return self.scope_bucket(F.col("scope")) * self.parts + F.pmod(F.xxhash64("key"), F.lit(self.parts)).cast("int")

    def versions(self, before: int | None = None) -> dict[int, int]:
        """Latest batch of each bucket; at most scopes * parts numbers."""
        empty = self.spark.createDataFrame([], "bucket int, batch bigint")
        log = read_or_else(self.spark, f"{self.path}/log", empty)
        if before is not None:
            log = log.filter(F.col("batch") < before)
        return {r["bucket"]: r["last"] for r in log.groupBy("bucket").agg(F.max("batch").alias("last")).collect()}

    def rows(self, buckets: list[int] | None = None, before: int | None = None) -> DataFrame:
        """The state, or its part in some buckets: other directories are not read."""
        wanted = {b: v for b, v in self.versions(before).items() if buckets is None or b in buckets}
        if not wanted:
            return self.spark.createDataFrame([], keyed.STATE)
        table = self.spark.read.schema(f"{keyed.STATE}, batch bigint, bucket int").parquet(f"{self.path}/rows")
        return table.filter(F.concat_ws("/", "batch", "bucket").isin([f"{v}/{b}" for b, v in wanted.items()])).drop("batch", "bucket")

    def changes(self) -> DataFrame:
        """Everything reported, with the batch that did; those flagged make up the review queue."""
        empty = self.spark.createDataFrame([], f"{keyed.CHANGE}, batch bigint")
        logged = self.spark.createDataFrame([(v,) for v in self._logged()], "batch bigint")
        return read_or_else(self.spark, f"{self.path}/changes", empty).join(F.broadcast(logged), "batch", "left_semi")

    def _logged(self) -> list[int]:
        log = read_or_else(self.spark, f"{self.path}/log", self.spark.createDataFrame([], "bucket int, batch bigint"))
        return [r[0] for r in log.select("batch").distinct().collect()]

    def apply(self, landing: DataFrame, batch_id: int) -> None:
        """Diff, carry forward, masked update and report of one landing, in one upsert."""
        landing = settled(landing)
        scopes = F.coalesce("scope", F.lit(""))
        found = [r[0] for r in landing.filter("key is not null").select(self.scope_bucket(scopes)).distinct().collect()]
        buckets = [s * self.parts + p for s in found for p in range(self.parts)]
        if not buckets:
            return
        # Scopes that share a bucket with one of the landing are carried over as they are.
        state = self.rows(buckets, before=batch_id)
        listed = landing.filter("key is not null").select(scopes.alias("scope")).distinct()
        asked = state.join(listed, "scope", "left_semi")
        others = state.join(listed, "scope", "left_anti").withColumn("change", F.lit(None).cast(_CHANGE))
        judged = settled(keyed.upsert(asked, landing, batch_id).withColumn("change", F.col("change").cast(_CHANGE)).unionByName(others))
        versioned = judged.drop("change").withColumn("batch", F.lit(batch_id).cast("bigint")).withColumn("bucket", self.bucket())
        _overwrite(versioned.repartition("bucket"), f"{self.path}/rows", "batch", "bucket")
        reported = judged.filter("change is not null").select("key", "scope", "name", "change.*")
        _overwrite(reported.withColumn("batch", F.lit(batch_id).cast("bigint")), f"{self.path}/changes", "batch")
        done = self.spark.createDataFrame([(b, batch_id) for b in buckets], "bucket int, batch bigint")
        _overwrite(done.coalesce(1), f"{self.path}/log", "batch")


_CHANGE = "struct<change_type: string, old_value: bigint, new_value: bigint, delta: bigint, needs_human_review: boolean>"


def _overwrite(df: DataFrame, path: str, *by: str) -> None:
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*by).parquet(path)


def refresh_keys(state: KeyedState, landings: str, progress: str) -> StreamingQuery:
    """Take in the landings (files of LANDING rows) that came since the last run, then stop.

    A landing lists all keys of each scope it names; a scope it doesn't name is neither read nor touched.
    """
    stream = state.spark.readStream.schema(keyed.LANDING).parquet(landings)
    return stream.writeStream.foreachBatch(state.apply).option("checkpointLocation", progress).trigger(availableNow=True).start()
