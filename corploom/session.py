"""Session helpers: a local session for tests, and where checkpoints go."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Set by local_session for tests and the bench, whose tables are files of a single row group.
LOCAL_SPREAD = "spark.corploom.localSpread"


def local_session(cpus: int | str = 8, app: str = "corploom", memory: str = "12g") -> SparkSession:
    """A single-JVM session for tests and the bench; a cluster brings its own."""
    return (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(cpus))
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        .config(LOCAL_SPREAD, "true")
        .getOrCreate()
    )


def spread(df: DataFrame, key: str) -> DataFrame:
    """In local sessions alone, give every core a share of a table that is one split; on a cluster, nothing."""
    if df.sparkSession.conf.get(LOCAL_SPREAD, "false") != "true":
        return df
    return df.repartition(df.sparkSession.sparkContext.defaultParallelism, key)


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Keep the cluster's shared checkpoint folder; pick a scratch one only for a local master."""
    sc = spark.sparkContext
    if sc.getCheckpointDir():
        return
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        sc.setCheckpointDir(configured)
    elif sc.master.startswith("local"):
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="corploom-ckpt-"))
    else:
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")


def shared_folder(spark: SparkSession, name: str) -> str:
    """A new path below the session's checkpoint folder, which the driver and all executors share."""
    ensure_checkpoint_dir(spark)
    return f"{spark.sparkContext.getCheckpointDir()}/{name}-{uuid.uuid4().hex}"
