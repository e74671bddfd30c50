"""Landed answers read with declared schemas, round trips through files, the scheduled refresh."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corploom.functions import text as tx
from corploom.plans import tables as tb
from corploom.plans.corpus import CLEAN_SQL
from corploom.plans.tables import SCRIPT, documents, load
from corploom.session import shared_folder
from corploom.sources import files, landed
from corploom.streaming.refresh import refresh_texts

# ---- landed answers ------------------------------------------------------


def landed_corpora(spark: SparkSession, d: str) -> DataFrame:
    """Corpora answers, one per language and source, each with the pair and the single corpus."""
    fields = ["corpus", "source", "target", "alignment_pairs", "documents"]
    rows = tb.corpora(documents(spark, d)).select("code", F.col("pos").alias("answer"), F.struct(*fields).alias("c"))
    listed = rows.groupBy("code", "answer").agg(F.array_sort(F.collect_list("c")).alias("corpora"))
    answers = listed.select("code", "answer", F.to_json(F.struct("corpora")).alias("raw"))
    return landed.corpora_rows(answers, "raw", "code", "answer").select("code", "answer", "pos", *fields)


LANDED_CORPORA = f"""
WITH {tb.CORPORA_SQL}
SELECT code, pos AS answer, row_number() OVER (PARTITION BY code, pos ORDER BY source, target) - 1 AS pos,
  corpus, source, target, alignment_pairs, documents FROM corpora"""


def landed_cards(spark: SparkSession, d: str) -> DataFrame:
    """Dataset cards out of one answer per document; German answers are no list and give no rows."""
    cards = tb.landed_cards(documents(spark, d))
    one = F.to_json(F.struct(*[c for c in cards.columns if c != "seq"]))
    refused = F.array_contains("tags", "language:de")
    answers = cards.select("seq", F.when(refused, one).otherwise(F.concat(F.lit("["), one, F.lit("]"))).alias("raw"))
    return landed.cards(answers, "raw", "seq").select(
        "seq", "pos", "id", "downloads", "likes", F.array_join("tags", "; ").alias("tags"),
        F.md5("description").alias("description_md5"), F.size("siblings").alias("files"),
    )


LANDED_CARDS = f"""
WITH {tb.CARDS_SQL}
SELECT seq, 0 AS pos, id, downloads, likes, array_to_string(tags, '; ') AS tags, md5(description) AS description_md5, 7 AS files
FROM landed WHERE NOT list_contains(tags, 'language:de')"""


def landed_search(spark: SparkSession, d: str) -> DataFrame:
    """Search hits out of landed files with one answer per document: its language, then its source."""
    hit = lambda c: F.struct(F.col(c).alias("title"), F.col("doc_id").alias("pageid"))
    found = F.struct(F.array(hit("lang"), hit("source")).alias("search"))
    path = shared_folder(spark, "answers")
    files.write_text(documents(spark, d).select(F.to_json(F.struct(found.alias("query"))).alias("raw")), "raw", path)
    return landed.search_hits(landed.read_answers(spark, path)).select("pageid", "pos", "title")


LANDED_SEARCH = """
SELECT doc_id AS pageid, 0 AS pos, lang AS title FROM documents UNION ALL SELECT doc_id, 1, source FROM documents"""


def landed_pages(spark: SparkSession, d: str) -> DataFrame:
    """Page extracts out of one answer per document, keyed by page id; every tenth lacks its extract."""
    page = F.struct(
        F.col("lang").alias("title"),
        F.when(F.col("doc_id") % 10 != 0, F.col("text")).alias("extract"),
        F.concat(F.lit("https://example.org/"), "source").alias("fullurl"),
        F.col("doc_id").alias("pageid"),
    )
    found = F.struct(F.create_map(F.col("doc_id").cast("string"), page).alias("pages"))
    answers = documents(spark, d).select(F.to_json(F.struct(found.alias("query"))).alias("raw"))
    return landed.page_extracts(answers).select("pageid", "title", "url", F.md5("text").alias("text_md5"))


LANDED_PAGES = """
SELECT doc_id AS pageid, lang AS title, 'https://example.org/' || source AS url,
  md5(CASE WHEN doc_id % 10 <> 0 THEN text ELSE '' END) AS text_md5 FROM documents"""


def landed_page_texts(spark: SparkSession, d: str) -> DataFrame:
    """The whole extract of every document, landed in files and read back."""
    path = shared_folder(spark, "page-answers")
    page = F.struct(F.col("lang").alias("title"), F.col("text").alias("extract"), F.col("doc_id").alias("pageid"))
    found = F.struct(F.create_map(F.col("doc_id").cast("string"), page).alias("pages"))
    files.write_text(documents(spark, d).select(F.to_json(F.struct(found.alias("query"))).alias("raw")), "raw", path)
    return landed.page_extracts(landed.read_answers(spark, path)).select("pageid", "title", "text")


LANDED_PAGE_TEXTS = "SELECT doc_id AS pageid, lang AS title, coalesce(text, '') AS text FROM documents"


# ---- round trips ---------------------------------------------------------


def csv_round_trip(spark: SparkSession, d: str) -> DataFrame:
    """Documents with a list column written as CSV and read back."""
    path = shared_folder(spark, "csv")
    files.write_csv(documents(spark, d).select("doc_id", "text", F.array("lang", "source").alias("marks")), path)
    back = files.read_csv(spark, path, "doc_id bigint, text string, marks string")
    return back.select("doc_id", F.md5("text").alias("text_md5"), "marks")


CSV_ROUND_TRIP = "SELECT doc_id, md5(text) AS text_md5, lang || '; ' || source AS marks FROM documents"


def jsonl_round_trip(spark: SparkSession, d: str) -> DataFrame:
    """Documents written as JSON lines with their metadata and read back."""
    path = shared_folder(spark, "jsonl")
    files.write_jsonl(documents(spark, d), path, "doc_id", "source", "text", "lang", "n_chars")
    back = files.read_jsonl(spark, path)
    return back.select("id", "source", F.md5("text").alias("text_md5"), F.col("metadata")["lang"].alias("lang"), F.col("metadata")["n_chars"].alias("n_chars"))


JSONL_ROUND_TRIP = """
SELECT doc_id::VARCHAR AS id, source, md5(text) AS text_md5, lang, n_chars::VARCHAR AS n_chars FROM documents"""


def refreshed_texts(spark: SparkSession, d: str) -> DataFrame:
    """Documents landed in two parts and taken in by two runs of the stream; what is stored after both."""
    landing, table, state = (shared_folder(spark, name) for name in ("landing", "stored", "stream"))
    docs = load(spark, d, "documents")
    early = F.pmod(F.xxhash64(tx.normalize_space(F.col("text"))), F.lit(2)) == 0
    for part in (early, ~early):
        docs.filter(part).write.mode("append").parquet(landing)
        refresh_texts(spark, landing, table, state, SCRIPT).awaitTermination()
    return spark.read.parquet(table).select("doc_id", "text_hash", "chars", "tokens", "keep")


REFRESHED_TEXTS = f"""
WITH {CLEAN_SQL} SELECT doc_id, sha256(text_clean) AS text_hash, chars, tokens, keep FROM clean WHERE NOT duplicate"""


NAMES = [
    "landed_corpora", "landed_cards", "landed_search", "landed_pages", "landed_page_texts", "csv_round_trip", "jsonl_round_trip", "refreshed_texts",
]
QUERIES = {n: globals()[n] for n in NAMES}
ORACLES = {n: globals()[n.upper()] for n in NAMES}
