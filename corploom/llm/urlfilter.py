"""URL rules over hosts and paths as an equi-join on short hash prefixes; DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Hex digits of a digest on which expressions and rules meet before the whole digest is compared.
PREFIX_DIGITS = 8


def url_host(url: Column) -> Column:
    """What stands between the first `://` and the next `/`, `?`, `#` or the end, A-Z lower-cased; else empty."""
    host = F.regexp_extract(_rest(url), r"^([^/?#]*)", 1)
    return F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def url_path(url: Column) -> Column:
    """What follows the host up to `?`, `#` or the end; empty without `://`."""
    return F.regexp_extract(_rest(url), r"^[^/?#]*([^?#]*)", 1)


def _rest(url: Column) -> Column:
    at = F.instr(url, "://")
    return F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise(F.lit(""))


def rules_table(spark: SparkSession, rules: list[tuple[str, str, str]]) -> DataFrame:
    """(verdict, rule_host, rule_path) rows from literals."""
    rows = [F.struct(F.lit(v).alias("verdict"), F.lit(h).alias("rule_host"), F.lit(p).alias("rule_path")) for v, h, p in rules]
    return spark.range(1).select(F.inline(F.array(*rows)))


def _digest(host: Column, path: Column) -> Column:
    return F.sha2(F.concat(host, F.lit("\x00"), path), 256)


def judge(pages: DataFrame, rules: DataFrame, url: str = "url", default: str = "allow") -> DataFrame:
    """The columns of `pages` plus host, path, rule and verdict.

    `rules` has verdict (allow or block), rule_host and rule_path. A rule fits its host and all
    subdomains if the path starts with the rule's. Of those that fit, the longest host and path
    together wins, then the longer host, then block. A page that no rule fits gets `default` and
    a null rule; so does a null URL or one without `://`, whose host and path are empty.

    Each distinct (host, path) is expanded to the pairs of host suffix and path prefix whose
    shape (number of labels, length of path) occurs among the rules; only the set of shapes is
    brought to the driver, whatever the number of rules. Expressions meet rules on 32 bits of a
    digest and are confirmed on all 256. Repeated URLs are folded before the shuffle; a hot
    host's rows are spread by their paths. Columns of `pages` with the names of results are
    replaced; an empty table or rule set gives no rows or the default.
    """
    kept = [c for c in pages.columns if c not in ("host", "path", "rule", "verdict")]
    rows = pages.select(
        *[F.col(f"`{c}`") for c in kept],
        F.coalesce(url_host(F.col(url)), F.lit("")).alias("host"),
        F.coalesce(url_path(F.col(url)), F.lit("")).alias("path"),
    )
    ruled = rules.filter(F.col("rule_host") != "").select(
        "verdict",
        "rule_host",
        F.coalesce("rule_path", F.lit("")).alias("rule_path"),
        F.size(F.split("rule_host", r"\.")).alias("labels"),
    )
    shapes = ruled.select("labels", F.length("rule_path").alias("chars")).distinct().collect()
    if not shapes:
        return rows.withColumn("rule", F.lit(None).cast("string")).withColumn("verdict", F.lit(default))
    digests = ruled.withColumn("digest", _digest(F.col("rule_host"), F.col("rule_path"))).select(
        F.substring("digest", 1, PREFIX_DIGITS).alias("short"), "digest", "verdict", "rule_host", "rule_path"
    )
    labels = F.size(F.split("host", r"\."))
    expressions = F.array(
        *[
            F.when(
                (F.col("labels") >= s["labels"]) & (F.length("path") >= s["chars"]),
                _digest(F.substring_index("host", ".", -s["labels"]), F.substring("path", 1, s["chars"])),
            )
            for s in shapes
        ]
    )
    urls = rows.filter(F.col("host") != "").select("host", "path").distinct().withColumn("labels", labels)
    asked = urls.select("host", "path", F.explode(F.array_compact(expressions)).alias("asked"))
    fitting = asked.withColumn("short", F.substring("asked", 1, PREFIX_DIGITS)).join(digests, "short").filter(
        F.col("asked") == F.col("digest")
    )
    order = F.struct(
        (F.length("rule_host") + F.length("rule_path")).alias("chars"),
        F.length("rule_host").alias("host_chars"),
        (F.col("verdict") == "block").alias("blocks"),
    )
    best = fitting.groupBy("host", "path").agg(
        F.max_by(F.struct(F.concat("rule_host", "rule_path").alias("rule"), "verdict"), order).alias("_best")
    )
    return rows.join(best, ["host", "path"], "left").select(
        *[F.col(f"`{c}`") for c in kept],
        "host",
        "path",
        F.col("_best.rule").alias("rule"),
        F.coalesce("_best.verdict", F.lit(default)).alias("verdict"),
    )
