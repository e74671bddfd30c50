"""The numbered queries over the driver tables, each beside its SQL where SQL can express it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corploom.llm import coverdedup, decontamination, hardnegatives, langid, minhash, mixing, personal, rules, sharding, suffixdedup, urlfilter, variants, warc

SPACED_WORD = r"[^\x20\x09-\x0D]+"


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def op1_mixing(spark: SparkSession, folder: str) -> DataFrame:
    docs = _table(spark, folder, "documents").select("doc_id", "text", "source")
    size = F.coalesce(F.regexp_count("text", F.lit(SPACED_WORD)), F.lit(0))
    return mixing.mix(docs, size).select("doc_id", "size", "source_size", "target", "taken", "source")


def op2_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    docs = _table(spark, folder, "documents").select("doc_id", "text")
    found = decontamination.match_benchmark(docs, _table(spark, folder, "benchmark"), matches=False)
    items = F.col("items")
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size(items).cast("long").alias("n_items"),
        F.sha2(F.array_join(items, ","), 256).alias("items_sha256"),
        "contaminated",
    )


def op3_substring_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return coverdedup.remove_repeats(_table(spark, folder, "documents").select("doc_id", "text"), texts=False)


def op4_warc(spark: SparkSession, folder: str) -> DataFrame:
    _, records = warc.round_trip(_table(spark, folder, "pages").select("page_id", "url", "html"))
    return records.select(
        F.col("page_id").cast("long").alias("page_id"),
        "payload_bytes",
        "payload_digest",
        "record_type",
        F.col("refers_to").cast("long").alias("refers_to"),
    )


def op5_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    docs = _table(spark, folder, "documents").select("doc_id", "text")
    learned = rules.learn(docs, _table(spark, folder, "labels"))
    return rules.judge(docs, learned).select("doc_id", *rules.BASE, "base_failed", "kept", "rule")


# The rules of the query.
URL_RULES = [
    ("allow", "org", "/"),
    ("block", "example.org", "/es/"),
    ("block", "example.org", "/en/1"),
    ("allow", "com", "/fr/"),
    ("block", "com", "/de/"),
]


def op6_url_filter(spark: SparkSession, folder: str) -> DataFrame:
    pages = _table(spark, folder, "pages").select("page_id", "url")
    return urlfilter.judge(pages, urlfilter.rules_table(spark, URL_RULES)).select("page_id", "host", "path", "rule", "verdict")


def op7_suffix_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return suffixdedup.remove_repeats(_table(spark, folder, "documents").select("doc_id", "text"), texts=False)


def op8_sharding(spark: SparkSession, folder: str) -> DataFrame:
    return sharding.shard_table(_table(spark, folder, "documents").select("doc_id", "text", "source"))


def op9_near_duplicates(spark: SparkSession, folder: str) -> DataFrame:
    return minhash.near_duplicates(_table(spark, folder, "documents").select("doc_id", "text"), width=2)


def op10_language_id(spark: SparkSession, folder: str) -> DataFrame:
    docs = _table(spark, folder, "documents").select("doc_id", "text", "lang")
    return langid.predict(docs, langid.fit(docs))


def op11_personal_data(spark: SparkSession, folder: str) -> DataFrame:
    found = personal.find(_table(spark, folder, "documents").select("doc_id", "text"))
    spans = F.col("spans")
    return found.select(
        "doc_id",
        *[personal.count(spans, kind).alias(f"n_{kind}") for kind in personal.BASE],
        F.sha2(personal.listed(spans, personal.BASE), 256).alias("base_sha256"),
        personal.listed(spans).alias("spans"),
    )


def op12_hard_negatives(spark: SparkSession, folder: str) -> DataFrame:
    vectors = _table(spark, folder, "embeddings").select("vec_id", "embedding", "label")
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hardnegatives.mine(vectors.withColumn("label", moved), F.col("vec_id") % 100 == 0)


def op13_spelling_variants(spark: SparkSession, folder: str) -> DataFrame:
    return variants.variants(variants.count_words(_table(spark, folder, "documents").select("doc_id", "text")))


QUERIES = {
    "op1_mixing": op1_mixing,
    "op2_decontamination": op2_decontamination,
    "op3_substring_dedup": op3_substring_dedup,
    "op4_warc": op4_warc,
    "op5_quality_rules": op5_quality_rules,
    "op6_url_filter": op6_url_filter,
    "op7_suffix_dedup": op7_suffix_dedup,
    "op8_sharding": op8_sharding,
    "op9_near_duplicates": op9_near_duplicates,
    "op10_language_id": op10_language_id,
    "op11_personal_data": op11_personal_data,
    "op12_hard_negatives": op12_hard_negatives,
    "op13_spelling_variants": op13_spelling_variants,
}

_BASE32_SQL = " || ".join(
    f"substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + ((('0x' || substr(h, {1 + 10 * (i // 8)}, 10))::BIGINT >> {35 - 5 * (i % 8)}) & 31)::INT, 1)"
    for i in range(32)
)

ORACLES = {
    "op4_warc": f"""
        WITH p AS (SELECT page_id, coalesce(html, '') AS html, sha1(coalesce(html, '')) AS h FROM pages),
        q AS (SELECT page_id, strlen(html)::BIGINT AS payload_bytes, {_BASE32_SQL} AS payload_digest,
                     min(page_id) OVER (PARTITION BY h) AS first_id FROM p)
        SELECT page_id, payload_bytes, payload_digest,
               CASE WHEN page_id = first_id THEN 'response' ELSE 'revisit' END AS record_type,
               CASE WHEN page_id <> first_id THEN first_id END AS refers_to
        FROM q
    """,
    "op6_url_filter": r"""
        WITH p AS (SELECT page_id, CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages),
        q AS (SELECT page_id,
                     translate(regexp_extract(rest, '^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
                     regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM p),
        rules(v, h, p) AS (VALUES ('allow', 'org', '/'), ('block', 'example.org', '/es/'), ('block', 'example.org', '/en/1'),
                                  ('allow', 'com', '/fr/'), ('block', 'com', '/de/')),
        fits AS (SELECT q.page_id, arg_max(rules.h || rules.p, length(rules.h || rules.p)) AS rule,
                        arg_max(rules.v, length(rules.h || rules.p)) AS verdict
                 FROM q JOIN rules ON (q.host = rules.h OR ends_with(q.host, '.' || rules.h)) AND starts_with(q.path, rules.p)
                 GROUP BY 1)
        SELECT q.page_id, q.host, q.path, fits.rule, coalesce(fits.verdict, 'allow') AS verdict
        FROM q LEFT JOIN fits USING (page_id)
    """,
    "op12_hard_negatives": """
        WITH v AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
                          list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS q
                   FROM embeddings
                   WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
                     AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
        s AS (SELECT a.vec_id AS anchor_id, b.vec_id AS other_id, a.label = b.label AS same,
                     list_inner_product(a.q, b.q)::BIGINT AS score
              FROM v a JOIN v b ON a.vec_id <> b.vec_id WHERE a.vec_id % 100 = 0),
        p AS (SELECT anchor_id, other_id AS positive_id, score AS positive_score FROM s WHERE same
              QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other_id) <= 5)
        SELECT p.anchor_id, positive_id,
               row_number() OVER (PARTITION BY p.anchor_id, positive_id ORDER BY score DESC, other_id)::INTEGER AS rank,
               other_id AS negative_id, positive_score, score AS negative_score
        FROM p JOIN s ON s.anchor_id = p.anchor_id AND NOT s.same
                     AND 80 * positive_score <= 100 * score AND score <= positive_score
        QUALIFY row_number() OVER (PARTITION BY p.anchor_id, positive_id ORDER BY score DESC, other_id) <= 5
    """,
}
