"""Tables of the driver, and tables of the corpus work derived from them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from corploom.functions import text as tx
from corploom.functions import urls
from corploom.operators import pages as pg
from corploom.operators import ranks, spell
from corploom.session import spread
from corploom.sources import seed

RUN_DATE = "2024-01-01"
SCRIPT = tx.LATIN_WIDE


def load(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def documents(spark: SparkSession, folder: str) -> DataFrame:
    return spread(load(spark, folder, "documents"), "doc_id")


def languages(docs: DataFrame) -> DataFrame:
    """One row per language of the corpus, named after its two most frequent longer words."""
    counts = spell.words(docs, "text", SCRIPT, "lang", at_least=4).groupBy("lang", "word").agg(F.count("*").alias("n"))
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("n"), "word"))
    top = counts.withColumn("rank", rank).filter("rank <= 2")
    names = top.groupBy("lang").agg(
        F.max(F.when(F.col("rank") == 1, F.col("word"))).alias("language_en"),
        F.max(F.when(F.col("rank") == 2, F.col("word"))).alias("language_ru"),
    )
    return names.select(
        "language_ru",
        "language_en",
        F.concat(F.lit("family "), F.substring("lang", 1, 1)).alias("family"),
        F.col("lang").alias("branch"),
        F.col("lang").alias("iso639_3"),
        F.when(F.col("lang") != "es", F.col("lang")).alias("opus_code"),
    )


LANGUAGES_SQL = r"""
lang_words AS (
  SELECT lang, word, count(*) AS n
  FROM (SELECT lang, unnest(regexp_extract_all(lower(text), '[A-Za-zÀ-ÖØ-öø-ÿ]{4,}')) AS word FROM documents)
  GROUP BY lang, word),
lang_ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY n DESC, word) AS rk FROM lang_words),
langs AS (
  SELECT max(CASE WHEN rk = 2 THEN word END) AS language_ru, max(CASE WHEN rk = 1 THEN word END) AS language_en,
         'family ' || substr(lang, 1, 1) AS family, lang AS branch, lang AS iso639_3,
         CASE WHEN lang <> 'es' THEN lang END AS opus_code
  FROM lang_ranked WHERE rk <= 2 GROUP BY lang)"""


def all_languages(spark: SparkSession, docs: DataFrame) -> DataFrame:
    return seed.languages(spark).unionByName(languages(docs))


def _sql(value: str | None) -> str:
    return "NULL" if value is None else "'" + value.replace("'", "''") + "'"


SEED_SQL = "seed(language_ru, language_en, family, branch, iso639_3, opus_code) AS (VALUES " + ", ".join(
    "(" + ", ".join(_sql(v) for v in row) + ")" for row in seed.LANGUAGES
) + ")"
ALL_LANGUAGES_SQL = SEED_SQL + "," + LANGUAGES_SQL + """,
all_langs AS (SELECT * FROM seed UNION ALL
  SELECT language_ru, language_en, family, branch, iso639_3, opus_code FROM langs)"""


def corpora(docs: DataFrame) -> DataFrame:
    """Landed corpora rows: each (language, source) is a corpus, once as a pair with ru and once alone."""
    counts = docs.groupBy("lang", "source").agg(
        F.count("*").alias("n"), F.sum(tx.line_count(F.col("text"))).alias("n_lines")
    )
    early = F.col("source") < "src5"
    n = F.col("n").cast("string")
    pair = F.struct(
        F.col("source").alias("corpus"),
        F.when(early, F.lit("ru")).otherwise(F.col("lang")).alias("source"),
        F.when(early, F.col("lang")).otherwise(F.lit("ru")).alias("target"),
        n.alias("alignment_pairs"),
        F.when(F.col("n") < 10, F.lit("")).otherwise(n).alias("documents"),
    )
    alone = F.struct(
        F.col("source").alias("corpus"),
        F.col("lang").alias("source"),
        F.when(~early, F.lit("")).alias("target"),
        F.col("n_lines").cast("string").alias("alignment_pairs"),
        n.alias("documents"),
    )
    return counts.select(F.col("lang").alias("code"), F.col("source").alias("pos"), F.explode(F.array(pair, alone)).alias("c")).select(
        "code", "pos", "c.*"
    )


LINE_SQL = (
    r"len(regexp_extract_all(text, '[^\s\x0b\x1c-\x1f\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
    r"[^\n\r\x0b\x0c\x1c-\x1e\x{85}\x{2028}\x{2029}]*'))"
)
CORPORA_SQL = f"""
corpora_base AS (
  SELECT lang, source, count(*) AS n, sum({LINE_SQL})::BIGINT AS n_lines FROM documents GROUP BY lang, source),
corpora AS (
  SELECT lang AS code, source AS pos, source AS corpus, CASE WHEN source < 'src5' THEN 'ru' ELSE lang END AS source,
         CASE WHEN source < 'src5' THEN lang ELSE 'ru' END AS target, n::VARCHAR AS alignment_pairs,
         CASE WHEN n < 10 THEN '' ELSE n::VARCHAR END AS documents, 'pair' AS kind
  FROM corpora_base
  UNION ALL
  SELECT lang, source, source, lang, CASE WHEN source >= 'src5' THEN '' END, n_lines::VARCHAR, n::VARCHAR, 'mono'
  FROM corpora_base)"""


def landed_cards(docs: DataFrame) -> DataFrame:
    """Dataset cards as answers bring them: copies of a document share an id."""
    low = F.lower("text")
    extra = lambda lang, word: F.when((F.col("lang") != lang) & F.contains(low, F.lit(word)), F.lit(f"language:{lang}"))
    size = F.when(F.col("n_chars") < 1000, "n<1K").when(F.col("n_chars") < 10000, "1K<n<10K").otherwise("10K<n<100K")
    files = F.transform(
        F.sequence(F.lit(1), F.lit(7)),
        lambda i: F.struct(F.concat(F.lit("data/"), F.col("source"), F.lit("-"), i.cast("string"), F.lit(".parquet")).alias("rfilename")),
    )
    info = F.struct(
        F.array(F.struct(F.col("lang").alias("name"), F.col("n_chars").alias("num_examples"))).alias("splits"),
        F.array(
            F.struct(F.lit("text").alias("name"), F.lit("string").alias("dtype")),
            F.struct(F.col("lang").alias("name"), F.lit("string").alias("dtype")),
        ).alias("features"),
    )
    return docs.select(
        F.concat("source", F.lit("/"), F.substring(F.md5("text"), 1, 12)).alias("id"),
        F.col("doc_id").alias("seq"),
        F.col("text").alias("description"),
        F.array_compact(
            F.array(
                F.concat(F.lit("language:"), "lang"),
                F.concat(F.lit("size_categories:"), size),
                extra("en", " in "),
                extra("fr", " la "),
                F.when(F.contains("text", F.lit("!!")), F.lit("task_categories:translation")),
            )
        ).alias("tags"),
        F.when(F.col("n_chars") >= 300, F.col("n_chars")).alias("downloads"),
        F.length("source").cast("long").alias("likes"),
        F.struct(info.alias("dataset_info")).alias("cardData"),
        files.alias("siblings"),
    )


CARDS_SQL = """
landed AS (
  SELECT source || '/' || substr(md5(text), 1, 12) AS id, doc_id AS seq, text AS description,
    ['language:' || lang,
     'size_categories:' || CASE WHEN n_chars < 1000 THEN 'n<1K' WHEN n_chars < 10000 THEN '1K<n<10K' ELSE '10K<n<100K' END]
    || CASE WHEN lang <> 'en' AND contains(lower(text), ' in ') THEN ['language:en'] ELSE []::VARCHAR[] END
    || CASE WHEN lang <> 'fr' AND contains(lower(text), ' la ') THEN ['language:fr'] ELSE []::VARCHAR[] END
    || CASE WHEN contains(text, '!!') THEN ['task_categories:translation'] ELSE []::VARCHAR[] END AS tags,
    CASE WHEN n_chars >= 300 THEN n_chars END AS downloads, length(source) AS likes, lang, source, n_chars
  FROM documents),
cards AS (
  SELECT * EXCLUDE (rn_last) FROM (
    SELECT *, min(seq) OVER (PARTITION BY id) AS pos, row_number() OVER (PARTITION BY id ORDER BY seq DESC) AS rn_last FROM landed)
  WHERE rn_last = 1)"""


def host_pages(spark: SparkSession, folder: str) -> DataFrame:
    return spread(load(spark, folder, "pages"), "page_id").withColumn("host", urls.host_of(F.col("url")))


def search_results(pages: DataFrame) -> DataFrame:
    """Search answers per host: its pages stand for the queries, their links for the results."""
    asked = ranks.row_numbers(pages, "host", "page_id", "number").select("page_id", (F.col("number") - 1).alias("query_no"))
    links = pg.page_links(pages, ["host", "page_id"], "url", "html").join(asked, "page_id")
    return links.select(
        "host",
        "query_no",
        (F.col("pos") - 1).alias("rank"),
        "url",
        F.col("label").alias("title"),
        F.when(F.lower("label") == "the", F.lit("challenge")).alias("error"),
    )


def package_files(spark: SparkSession, folder: str) -> DataFrame:
    """Conversations as packages: each turn is a file."""
    turns = load(spark, folder, "conversations")
    text, turn = F.col("text"), F.col("turn")
    name = (
        F.when(turn == 0, "README.md")
        .when(turn == 1, "DATA_CARD.md")
        .when(turn == 2, "sources.csv")
        .when(turn == 3, "EVAL_REPORT.md")
        .otherwise(F.concat(F.lit("notes_"), turn.cast("string"), F.lit(".txt")))
    )
    content = (
        F.when(turn == 0, F.concat(text, F.when(F.length(text) < 150, " See DATA_CARD.md, replace me.").otherwise(" See notes_4.txt.")))
        .when(turn == 1, F.concat(F.when(F.length(text) > 300, "License: see sources. It needs a check. ").otherwise(""), text))
        .when(
            turn == 2,
            F.concat(
                F.when(F.length(text) > 150, F.lit("title,url,type,license_or_access,notes\n")).otherwise(F.lit("title,url,notes\n")),
                F.concat_ws(
                    ",",
                    F.col("role"),
                    F.lit('"https://example.org/a,b"'),
                    F.lit("web"),
                    F.when(F.length(text) > 200, "CC BY").otherwise("Unknown"),
                    F.lit("note"),
                ),
            ),
        )
        .otherwise(text)
    )
    return turns.select(F.col("conv_id").alias("package"), name.alias("name"), content.alias("content"))


PACKAGES_SQL = """
files AS (
  SELECT conv_id AS package,
    CASE turn WHEN 0 THEN 'README.md' WHEN 1 THEN 'DATA_CARD.md' WHEN 2 THEN 'sources.csv' WHEN 3 THEN 'EVAL_REPORT.md'
      ELSE 'notes_' || turn || '.txt' END AS name,
    CASE turn
      WHEN 0 THEN text || CASE WHEN length(text) < 150 THEN ' See DATA_CARD.md, replace me.' ELSE ' See notes_4.txt.' END
      WHEN 1 THEN CASE WHEN length(text) > 300 THEN 'License: see sources. It needs a check. ' ELSE '' END || text
      WHEN 2 THEN CASE WHEN length(text) > 150 THEN 'title,url,type,license_or_access,notes' ELSE 'title,url,notes' END || chr(10)
        || role || ',"https://example.org/a,b",web,' || CASE WHEN length(text) > 200 THEN 'CC BY' ELSE 'Unknown' END || ',note'
      ELSE text END AS content,
    length(text) AS text_len
  FROM conversations)"""
