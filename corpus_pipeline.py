"""From raw documents to sharded training data, in stages that each read what the one before kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corploom.llm import decontamination, minhash, mixing, rules, sharding
from corploom.llm.ranges import one_of_each, row_key
from corploom.llm.shared import release, settled, shared_table

KEY, TEXT, SOURCE = "doc_id", "text", "source"


def _plain(docs: DataFrame) -> tuple[DataFrame, list, dict[str, str]]:
    """The rows under names that clash with no result; the columns that restore them; the new names."""
    names = {c: f"_in{i}" for i, c in enumerate(docs.columns)}
    return docs.toDF(*names.values()), [F.col(n).alias(c) for c, n in names.items()], names


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base and that no learned rule rejects.

    Each row is judged by its text alone, so repeated rows fare alike. A null, empty or short text
    fails the base. Columns with the names of measures come back as they were. Without labels the
    base alone decides; an empty table gives no rows.
    """
    release(spark)
    learned = rules.learn(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    rows, back, names = _plain(docs)
    return rules.judge(rows, learned, names[TEXT], keep_text=True).filter("kept").select(*back)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates (5-word shingles, similarity of 0.8 or more): the smallest key.

    Each row is judged on its own, by a number made of key and text: rows of one key with
    different texts may fare differently, a null key comes after the others, and of rows alike
    in both, one is left.
    """
    release(spark)
    rows, back, names = _plain(docs)
    key, text = names[KEY], names[TEXT]
    rows = rows.withColumn("_row", F.xxhash64(row_key(key, text), F.col(key).isNull(), F.col(text).isNull()))
    order = F.struct(F.col(key).isNull().alias("last"), F.col(key).alias("key"), F.col("_row").alias("row"))
    judged = minhash.near_duplicates(rows.select(order.alias("_order"), text), "_order", text)
    alike = judged.groupBy(F.col("_order.row").alias("_row")).agg(F.count("*").alias("n"), F.min("kept").alias("kept"))
    marks = settled(alike.filter("n > 1 or not kept").select("_row", "kept"))
    return one_of_each(rows, marks, "_row").select(*back)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a run of 10 benchmark words, or a whole item of fewer.

    Each row is judged by its text alone, of any length; a null or empty text has no words and
    stays, and so do all documents if the benchmark has no words. Null keys and repeated rows are
    judged like others, columns with the names of results come back as they were, and an empty
    table gives no rows.
    """
    release(spark)
    rows, back, names = _plain(docs)
    found = decontamination.match_benchmark(rows, spark.read.parquet(f"{sf_dir}/benchmark.parquet"), names[TEXT], matches=False)
    return found.filter("not contaminated").select(*back)


def source_mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Whole documents by the target weights, each as often as the mix takes it (0 to 3 times).

    A null source is a source, the last by order. A document without words, such as a null text, adds
    nothing to a target and is not taken. Rows of one key share its hash and are taken alike; columns with
    the names of results come back as they were, and an empty table gives no rows.
    """
    release(spark)
    rows, back, names = _plain(docs)
    size = F.coalesce(F.regexp_count(names[TEXT], F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0))
    mixed = mixing.mix(rows, size, names[SOURCE], names[KEY], whole=True)
    copies = F.when(F.col("size") > 0, F.col("taken") / F.col("size")).otherwise(0).cast("int")
    return mixed.withColumn("_copy", F.explode(F.array_repeat(F.lit(0), copies))).select(*back)


def interleaved_shards(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The shard and slot of each document, with its key, size, CRC and source.

    A row that the mix took several times has as many slots. A null text has size 16 and CRC 0, a null
    key or source is placed like any other, columns beside key, text and source are left out, and an
    empty table gives no rows.
    """
    release(spark)
    return sharding.shard_table(docs, text=TEXT, source=SOURCE, key=KEY)


STAGES = [
    ("quality_rules", quality_rules),
    ("near_duplicates", near_duplicates),
    ("benchmark_decontamination", benchmark_decontamination),
    ("source_mixing", source_mixing),
    ("interleaved_shards", interleaved_shards),
]

# Learned rules and linked groups can't be put into SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`; each result is written to the shared folder and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = shared_table(stage(spark, docs, sf_dir), name)
    return docs


QUERIES = {"pipeline": run}
ORACLES: dict[str, str] = {}
