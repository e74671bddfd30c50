"""Catalogue queries: corpora rows, dataset cards, the language inventory, snapshots, decisions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corploom.functions import text as tx
from corploom.functions import urls
from corploom.operators import catalog, snapshots
from corploom.operators.lookup import settled
from corploom.plans import tables as tb
from corploom.plans.tables import RUN_DATE, documents, load
from corploom.sources import files

# ---- corpora -------------------------------------------------------------


def corpora_summary(spark: SparkSession, d: str) -> DataFrame:
    return catalog.corpora_summary(tb.corpora(documents(spark, d)), "code", "pos")


_AS_INT = "coalesce(nullif({}, ''), '0')::BIGINT"
_PAIRS, _DOCS = _AS_INT.format("alignment_pairs"), _AS_INT.format("documents")
_ITEM = f"corpus || ' (' || {_PAIRS} || ')'"
SUMMARY_SQL = f"""
summary AS (
  SELECT code,
    coalesce(sum({_PAIRS}) FILTER (kind = 'pair'), 0)::BIGINT AS ru_parallel_pairs,
    coalesce(sum({_DOCS}) FILTER (kind = 'pair'), 0)::BIGINT AS ru_parallel_documents,
    coalesce(string_agg({_ITEM}, '; ' ORDER BY pos) FILTER (kind = 'pair'), '') AS ru_parallel_corpora,
    coalesce(sum({_PAIRS}) FILTER (kind = 'mono'), 0)::BIGINT AS mono_pairs_or_segments,
    coalesce(sum({_DOCS}) FILTER (kind = 'mono'), 0)::BIGINT AS mono_documents,
    coalesce(string_agg({_ITEM}, '; ' ORDER BY pos) FILTER (kind = 'mono'), '') AS mono_corpora
  FROM corpora GROUP BY code)"""
CORPORA_SUMMARY = f"WITH {tb.CORPORA_SQL}, {SUMMARY_SQL} SELECT * FROM summary"


def corpora_totals(spark: SparkSession, d: str) -> DataFrame:
    rows = tb.corpora(documents(spark, d)).withColumn("order", F.concat_ws("|", "pos", "code", "alignment_pairs", "source"))
    return catalog.corpora_totals(rows, "code", "order")


CORPORA_TOTALS = f"""
WITH {tb.CORPORA_SQL}
SELECT code, sum({_PAIRS})::BIGINT AS pairs, sum({_DOCS})::BIGINT AS documents,
  string_agg(corpus || ' (' || alignment_pairs || ')', '; ' ORDER BY pos || '|' || code || '|' || alignment_pairs || '|' || source) AS corpora
FROM corpora GROUP BY code"""


def corpora_conform(spark: SparkSession, d: str) -> DataFrame:
    """Rows brought to the expected columns (two of them never landed), with page and API addresses."""
    rows = catalog.conform(tb.corpora(documents(spark, d)).drop("code", "pos"), catalog.CORPORA_COLUMNS)
    target = F.coalesce("target", F.lit(""))
    return rows.select(
        "*",
        tx.as_int(F.col("alignment_pairs")).alias("pairs"),
        urls.pair_page_url(F.col("source"), target, F.col("corpus")).alias("page_url"),
        urls.pair_api_url(F.col("source"), target).alias("api_url"),
    )


CORPORA_CONFORM = f"""
WITH {tb.CORPORA_SQL}
SELECT corpus, source, target, alignment_pairs, documents, '' AS preprocessing, '' AS version, {_PAIRS} AS pairs,
  'https://opus.nlpl.eu/datasets/' || corpus || '?hi=' || source || '&pair=' || coalesce(target, '') AS page_url,
  'https://opus.nlpl.eu/opusapi?source=' || source || '&target=' || coalesce(target, '') || '&preprocessing=xml&version=latest' AS api_url
FROM corpora"""

# ---- cards ---------------------------------------------------------------


def cards(spark: SparkSession, d: str) -> DataFrame:
    return catalog.dedup_cards(tb.landed_cards(documents(spark, d)))


def catalog_dedup_last(spark: SparkSession, d: str) -> DataFrame:
    return cards(spark, d).select("id", "pos", "downloads", F.md5("description").alias("description_md5"))


CATALOG_DEDUP_LAST = f"WITH {tb.CARDS_SQL} SELECT id, pos, downloads, md5(description) AS description_md5 FROM cards"


def card_brief(spark: SparkSession, d: str) -> DataFrame:
    return catalog.brief_table(cards(spark, d))


_LANG_TAGS = "array_to_string(list_filter(tags, lambda t: starts_with(t, 'language:')), '; ')"
_SIZE_TAGS = "array_to_string(list_transform(list_filter(tags, lambda t: starts_with(t, 'size_categories:')), lambda t: replace(t, 'size_categories:', '')), '; ')"
CARD_BRIEF = f"""
WITH {tb.CARDS_SQL}
SELECT id, downloads, likes, {_LANG_TAGS} AS language_tags, {_SIZE_TAGS} AS size_categories,
  'https://huggingface.co/datasets/' || id AS url FROM cards"""


def card_fields(spark: SparkSession, d: str) -> DataFrame:
    return catalog.card_fields(cards(spark, d))


CARD_FIELDS = f"""
WITH {tb.CARDS_SQL}
SELECT id AS dataset_id, 'https://huggingface.co/datasets/' || id AS page, 'https://huggingface.co/api/datasets/' || id AS api_url,
  downloads, likes, {_LANG_TAGS} AS language_tags, {_SIZE_TAGS} AS size_categories,
  lang || ' (' || n_chars || ' examples)' AS splits, 'text:string; ' || lang || ':string' AS features,
  array_to_string(list_transform([1, 2, 3, 4, 5], lambda i: 'data/' || source || '-' || i || '.parquet'), '; ') AS files
FROM cards"""


def _languages(spark: SparkSession, d: str) -> DataFrame:
    """The language table, computed once: it is small and read in many places."""
    return settled(tb.all_languages(spark, documents(spark, d)))


def matches(spark: SparkSession, d: str, languages: DataFrame | None = None) -> DataFrame:
    return catalog.card_matches(cards(spark, d), languages or _languages(spark, d))


def catalog_matches(spark: SparkSession, d: str) -> DataFrame:
    return matches(spark, d).select("iso639_3", "id", "downloads", "ru_parallel", "named")


_BOUND = r"[^\p{L}\p{N}_-]"
MATCHES_SQL = rf"""
parts AS (
  SELECT iso639_3, trim(unnest(string_split_regex(lower(name), '\s*/\s*|\s+-\s+'))) AS part
  FROM (SELECT iso639_3, language_en AS name FROM all_langs UNION ALL SELECT iso639_3, language_ru FROM all_langs)),
pats AS (SELECT DISTINCT iso639_3, part, '(^|{_BOUND})' || part || '($|{_BOUND})' AS pat FROM parts WHERE length(part) >= 4),
facts AS (SELECT *, lower(id || ' ' || description || ' ' || array_to_string(tags, ' ')) AS txt, lower(id || ' ' || description) AS own FROM cards),
tagset AS (SELECT iso639_3, 'language:' || iso639_3 AS tag FROM all_langs UNION
  SELECT iso639_3, 'language:' || opus_code FROM all_langs WHERE opus_code IS NOT NULL),
near AS MATERIALIZED (SELECT p.iso639_3, p.pat, f.id, f.txt, f.own FROM facts f JOIN pats p ON contains(f.txt, p.part)),
m0 AS MATERIALIZED (
  SELECT t.iso639_3, f.id, FALSE AS named FROM facts f JOIN tagset t ON list_contains(f.tags, t.tag)
  UNION ALL
  SELECT iso639_3, id, regexp_matches(own, pat) FROM near WHERE regexp_matches(txt, pat)),
m AS (
  SELECT iso639_3, m0.id, any_value(f.pos) AS pos, coalesce(any_value(f.downloads), 0) AS downloads, any_value(f.tags) AS tags,
    bool_or(list_contains(f.tags, 'language:ru') OR contains(f.txt, 'russian') OR contains(f.txt, 'рус') OR contains(f.txt, 'rus-')) AS ru_parallel,
    bool_or(named) AS named
  FROM m0 JOIN facts f ON f.id = m0.id GROUP BY iso639_3, m0.id)"""
_CAT = f"{tb.CARDS_SQL}, {tb.ALL_LANGUAGES_SQL}, {MATCHES_SQL}"
CATALOG_MATCHES = f"WITH {_CAT} SELECT iso639_3, id, downloads, ru_parallel, named FROM m"


def catalog_top5(spark: SparkSession, d: str) -> DataFrame:
    return catalog.top_cards(matches(spark, d)).select("iso639_3", "rank", "id", "score", "downloads")


TOP_SQL = """
top AS (
  SELECT * FROM (
    SELECT *, row_number() OVER (PARTITION BY iso639_3 ORDER BY score DESC, downloads DESC, pos) AS rank FROM (
      SELECT *, CASE WHEN named THEN 2
        WHEN len(list_distinct(list_filter(tags, lambda t: starts_with(t, 'language:')))) <= 5 THEN 1 ELSE 0 END AS score FROM m))
  WHERE rank <= 5)"""
CATALOG_TOP5 = f"WITH {_CAT}, {TOP_SQL} SELECT iso639_3, rank, id, score, downloads FROM top"


def size_categories(spark: SparkSession, d: str) -> DataFrame:
    return catalog.size_categories(matches(spark, d))


SIZES_SQL = """
sizes AS (
  SELECT iso639_3, string_agg(DISTINCT c, '; ' ORDER BY c) AS size_categories
  FROM (SELECT iso639_3, replace(unnest(list_filter(tags, lambda t: starts_with(t, 'size_categories:'))), 'size_categories:', '') AS c FROM m)
  GROUP BY iso639_3)"""
SIZE_CATEGORIES = f"WITH {_CAT}, {SIZES_SQL} SELECT * FROM sizes"


def _log(languages: DataFrame) -> DataFrame:
    # A query that failed when it landed: names with a slash are refused by this stand-in source.
    return catalog.query_log(languages).withColumn("error", F.when(F.contains("query", F.lit("/")), "bad request"))


def card_summary(spark: SparkSession, d: str, languages: DataFrame | None = None) -> DataFrame:
    languages = languages or _languages(spark, d)
    return catalog.card_summary(matches(spark, d, languages), _log(languages))


CARD_SUMMARY_SQL = f"""
qlog AS (
  SELECT iso639_3, q FROM (
    SELECT DISTINCT iso639_3, tag AS q FROM tagset UNION ALL SELECT iso639_3, language_en FROM all_langs
    UNION ALL SELECT iso639_3, language_ru FROM all_langs)),
lg AS (SELECT iso639_3, count(*) AS a, count(*) FILTER (NOT contains(q, '/')) AS s FROM qlog GROUP BY iso639_3),
cnt AS (SELECT iso639_3, count(*) AS n, count(*) FILTER (ru_parallel) AS r, sum(downloads)::BIGINT AS dl FROM m GROUP BY iso639_3),
topj AS (SELECT iso639_3, string_agg(id, '; ' ORDER BY rank) AS t FROM top GROUP BY iso639_3),
card_summary AS (
  SELECT iso639_3, s > 0 AS hf_checked, a AS hf_query_attempts, s AS hf_query_successes, coalesce(n, 0) AS hf_dataset_count,
    coalesce(r, 0) AS hf_ru_parallel_candidates, coalesce(t, '') AS hf_top_datasets, coalesce(dl, 0) AS hf_downloads_sum,
    coalesce(size_categories, '') AS hf_size_categories
  FROM lg LEFT JOIN cnt USING (iso639_3) LEFT JOIN topj USING (iso639_3) LEFT JOIN sizes USING (iso639_3))"""
_FULL = f"{_CAT}, {TOP_SQL}, {SIZES_SQL}, {CARD_SUMMARY_SQL}"
CARD_SUMMARY = f"WITH {_FULL} SELECT * FROM card_summary"


def query_errors(spark: SparkSession, d: str) -> DataFrame:
    """Error rows kept beside the results: (language, query type, query, error)."""
    log = _log(tb.all_languages(spark, documents(spark, d)))
    return log.filter(F.col("error").isNotNull())


QUERY_ERRORS = f"""
WITH {tb.ALL_LANGUAGES_SQL}
SELECT iso639_3, 'search' AS query_type, name AS query, 'bad request' AS error
FROM (SELECT iso639_3, language_en AS name FROM all_langs UNION ALL SELECT iso639_3, language_ru FROM all_langs) WHERE contains(name, '/')"""


def pair_candidates(spark: SparkSession, d: str) -> DataFrame:
    """Candidates for the pair de-en."""
    langs = tb.languages(documents(spark, d))
    fields = ("language_en", "iso639_3", "opus_code")
    pair = langs.agg(
        *[
            F.max(F.when(F.col("iso639_3") == code, F.col(c))).alias(f"{side}_{c}")
            for side, code in (("l", "de"), ("r", "en"))
            for c in fields
        ]
    )
    return catalog.pair_candidates(cards(spark, d), pair).select("id", "has_both_tags", "has_term")


PAIR_CANDIDATES = f"""
WITH {tb.CARDS_SQL}, {tb.LANGUAGES_SQL},
l AS (SELECT * FROM langs WHERE iso639_3 = 'de'), r AS (SELECT * FROM langs WHERE iso639_3 = 'en'),
terms AS (
  SELECT lower(unnest([l.language_en || ' ' || r.language_en, r.language_en || ' ' || l.language_en, l.iso639_3 || '-' || r.iso639_3,
    r.iso639_3 || '-' || l.iso639_3, l.opus_code || '-' || r.opus_code, r.opus_code || '-' || l.opus_code])) AS term FROM l, r),
c AS (SELECT id, (SELECT list_contains(tags, 'language:' || l.iso639_3) OR coalesce(list_contains(tags, 'language:' || l.opus_code), FALSE) FROM l)
    AND (SELECT list_contains(tags, 'language:' || r.iso639_3) OR coalesce(list_contains(tags, 'language:' || r.opus_code), FALSE) FROM r) AS has_both_tags,
  coalesce((SELECT bool_or(contains(lower(id || ' ' || description || ' ' || array_to_string(tags, ' ')), term)) FROM terms WHERE term IS NOT NULL), FALSE) AS has_term
  FROM cards)
SELECT * FROM c WHERE has_both_tags OR has_term"""


def query_templates(spark: SparkSession, d: str) -> DataFrame:
    return catalog.query_templates(tb.all_languages(spark, documents(spark, d)))


QUERY_TEMPLATES = f"""
WITH {tb.ALL_LANGUAGES_SQL}
SELECT iso639_3, 0 AS query_no, language_en || ' dataset corpus' AS query FROM all_langs UNION ALL
SELECT iso639_3, 1, language_en || ' Russian parallel corpus' FROM all_langs UNION ALL
SELECT iso639_3, 2, language_en || ' language GitHub corpus' FROM all_langs UNION ALL
SELECT iso639_3, 3, language_ru || ' корпус скачать датасет' FROM all_langs"""

# ---- inventory -----------------------------------------------------------


def inventory(spark: SparkSession, d: str, languages: DataFrame | None = None) -> DataFrame:
    languages = languages or _languages(spark, d)
    return catalog.inventory(languages, corpora_summary(spark, d), card_summary(spark, d, languages), RUN_DATE)


INVENTORY_SQL = f"""
inv AS (
  SELECT language_ru, language_en, family, branch, l.iso639_3, opus_code, opus_code IS NOT NULL AS opus_checked,
    coalesce(ru_parallel_pairs, 0) AS opus_ru_parallel_pairs, coalesce(ru_parallel_documents, 0) AS opus_ru_parallel_documents,
    coalesce(mono_pairs_or_segments, 0) AS opus_mono_pairs_or_segments, coalesce(mono_documents, 0) AS opus_mono_documents,
    coalesce(ru_parallel_corpora, '') AS opus_ru_parallel_corpora, coalesce(mono_corpora, '') AS opus_mono_corpora,
    hf_checked, hf_query_attempts, hf_query_successes, hf_dataset_count, hf_ru_parallel_candidates, hf_downloads_sum,
    hf_top_datasets, hf_size_categories, 'https://huggingface.co/datasets' AS hf_source_url,
    'https://opus.nlpl.eu/opusapi' AS parallel_with_russian_source,
    'OPUS monolingual rows; Hugging Face dataset search' AS monolingual_source, '{RUN_DATE}' AS checked_at_utc
  FROM all_langs l LEFT JOIN summary s ON s.code = l.opus_code LEFT JOIN card_summary c ON c.iso639_3 = l.iso639_3)"""
_INV = f"{tb.CORPORA_SQL}, {SUMMARY_SQL}, {_FULL}, {INVENTORY_SQL}"
INVENTORY = f"WITH {_INV} SELECT * FROM inv"


def inventory_summary(spark: SparkSession, d: str) -> DataFrame:
    languages = _languages(spark, d)
    return catalog.inventory_summary(inventory(spark, d, languages), languages)


INVENTORY_SUMMARY = f"""
WITH {_INV}
SELECT (SELECT count(*) FROM all_langs) AS languages_total, count(*) FILTER (opus_checked OR hf_checked) AS languages_checked,
  count(*) FILTER (opus_ru_parallel_pairs > 0) AS with_opus_ru_parallel, count(*) FILTER (hf_dataset_count > 0) AS with_hf_candidates,
  count(*) FILTER (hf_query_attempts > hf_query_successes) AS errors FROM inv"""


def inventory_metadata(spark: SparkSession, d: str) -> DataFrame:
    return files.inventory_metadata(inventory(spark, d))


INVENTORY_METADATA = f"""
WITH {_INV}
SELECT 'scope' AS field, '{files.SCOPE}' AS value UNION ALL SELECT 'sources', '{files.SOURCES}'
UNION ALL SELECT 'checked_at_utc', '{RUN_DATE}' UNION ALL SELECT 'caveat', '{files.CAVEAT}'
UNION ALL SELECT 'languages', count(*)::VARCHAR FROM inv
UNION ALL SELECT 'with_parallel', (count(*) FILTER (opus_ru_parallel_pairs > 0))::VARCHAR FROM inv
UNION ALL SELECT 'parallel_pairs', sum(opus_ru_parallel_pairs)::BIGINT::VARCHAR FROM inv"""


def family_totals(spark: SparkSession, d: str) -> DataFrame:
    return catalog.family_totals(inventory(spark, d))


FAMILY_TOTALS = f"""
WITH {_INV}
SELECT family, sum(opus_ru_parallel_pairs)::BIGINT AS opus_ru_parallel_pairs,
  sum(opus_mono_pairs_or_segments)::BIGINT AS opus_mono_pairs_or_segments FROM inv GROUP BY family"""


def family_branches(spark: SparkSession, d: str) -> DataFrame:
    return catalog.family_branches(tb.all_languages(spark, documents(spark, d)))


FAMILY_BRANCHES = f"WITH {tb.ALL_LANGUAGES_SQL} SELECT family, branch, count(*) AS languages FROM all_langs GROUP BY family, branch"

# ---- snapshots -----------------------------------------------------------


def _counts(docs: DataFrame) -> DataFrame:
    key = F.concat_ws("-", "lang", "source").alias("iso639_3")
    return docs.groupBy(key).agg(F.min("lang").alias("language_ru"), F.sum("n_chars").alias("pairs"))


def _old_and_new(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    """Old snapshot: documents labelled so far; new snapshot: documents of fair length."""
    docs = documents(spark, d)
    old = docs.join(load(spark, d, "labels").select("doc_id"), "doc_id", "left_semi")
    return _counts(old), _counts(docs.filter("n_chars >= 1000"))


_OLD_NEW = """
old AS (SELECT lang || '-' || source AS k, min(lang) AS l, sum(n_chars)::BIGINT AS p FROM documents
  WHERE doc_id IN (SELECT doc_id FROM labels) GROUP BY 1),
new AS (SELECT lang || '-' || source AS k, min(lang) AS l, sum(n_chars)::BIGINT AS p FROM documents WHERE n_chars >= 1000 GROUP BY 1)"""


def snapshot_diff(spark: SparkSession, d: str) -> DataFrame:
    old, new = _old_and_new(spark, d)
    return snapshots.diff(old, new, "iso639_3", "pairs", "language_ru")


SNAPSHOT_DIFF = f"""
WITH {_OLD_NEW}, j AS (SELECT coalesce(o.k, n.k) AS k, n.l, o.p AS a, n.p AS b, o.k IS NULL AS added, n.k IS NULL AS gone
  FROM old o FULL JOIN new n ON o.k = n.k)
SELECT k AS iso639_3, CASE WHEN NOT added AND NOT gone THEN l END AS language_ru,
  CASE WHEN added THEN 'new_language' WHEN gone THEN 'missing_language' ELSE 'parallel_count_changed' END AS change_type,
  CASE WHEN NOT added AND NOT gone THEN a END AS old_pairs, CASE WHEN NOT added AND NOT gone THEN b END AS new_pairs,
  b - a AS delta, CASE WHEN added OR gone THEN TRUE ELSE abs(b - a) > greatest(1000, a * 0.5::DOUBLE) END AS needs_human_review
FROM j WHERE added OR gone OR a <> b"""


def _checked(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    """Current run: keys of which nothing was labelled count as not checked, with zero pairs."""
    docs = documents(spark, d)
    old, _ = _old_and_new(spark, d)
    every = _counts(docs)
    seen = old.select("iso639_3", F.col("pairs").alias("now"))
    current = every.join(seen, "iso639_3", "left").select(
        "iso639_3",
        F.when(F.col("language_ru") != "es", F.col("language_ru")).alias("code"),
        F.col("now").isNotNull().alias("checked"),
        F.coalesce("now", F.lit(0)).alias("pairs"),
    )
    return current, every


def snapshot_carry_forward(spark: SparkSession, d: str) -> DataFrame:
    current, previous = _checked(spark, d)
    return snapshots.carry_forward(current, previous, "iso639_3", "checked", "code", ["pairs"])


SNAPSHOT_CARRY_FORWARD = f"""
WITH {_OLD_NEW}, al AS (SELECT lang || '-' || source AS k, min(lang) AS l, sum(n_chars)::BIGINT AS p FROM documents GROUP BY 1)
SELECT al.k AS iso639_3, nullif(al.l, 'es') AS code, old.k IS NOT NULL AS checked,
  CASE WHEN old.k IS NULL AND al.l <> 'es' THEN al.p ELSE coalesce(old.p, 0) END AS pairs,
  old.k IS NULL AND al.l <> 'es' AS cached_from_previous_run FROM al LEFT JOIN old ON old.k = al.k"""


def snapshot_update(spark: SparkSession, d: str) -> DataFrame:
    """Counts raised on a mask, then taken over except where the change waits for review."""
    old, new = _old_and_new(spark, d)
    raised = snapshots.update_where(new, F.col("language_ru") == "fr", "pairs", F.col("pairs") + 250)
    changes = snapshots.diff(old, raised, "iso639_3", "pairs", "language_ru")
    return snapshots.safe_update(old, raised, changes, "iso639_3", ["pairs"])


SNAPSHOT_UPDATE = f"""
WITH {_OLD_NEW}, n2 AS (SELECT k, l, p + CASE WHEN l = 'fr' THEN 250 ELSE 0 END AS p FROM new)
SELECT o.k AS iso639_3, o.l AS language_ru,
  CASE WHEN n.k IS NULL OR abs(n.p - o.p) > greatest(1000, o.p * 0.5::DOUBLE) THEN o.p ELSE n.p END AS pairs
FROM old o LEFT JOIN n2 n ON n.k = o.k"""

# ---- decisions -----------------------------------------------------------


def _answers(spark: SparkSession, d: str) -> DataFrame:
    """Landed answers about labelled documents: JSON, except that toxic ones answer in prose."""
    docs = documents(spark, d).select("doc_id", "text", "lang")
    labelled = load(spark, d, "labels").join(docs, "doc_id")
    answer = F.struct(
        F.when(F.col("lang") != "de", F.col("doc_id").cast("string")).alias("dataset_id"),
        F.when(F.col("quality") == 1, "parallel_corpus").otherwise("not_parallel_broad_multilingual").alias("label"),
        F.when(F.length("text") > 1000, "high").otherwise("low").alias("confidence"),
        F.col("lang").alias("reason"),
        F.substring("text", 1, 40).alias("evidence"),
        (F.col("quality") == 0).alias("needs_human_review"),
    )
    return labelled.select("doc_id", F.when(F.col("toxic") == 1, F.col("text")).otherwise(F.to_json(answer)).alias("raw"))


def parsed_decisions(spark: SparkSession, d: str) -> DataFrame:
    return catalog.parse_decisions(_answers(spark, d), "raw", "doc_id")


DECISIONS_SQL = """
dec AS (
  SELECT doc_id::VARCHAR AS dataset_id,
    CASE WHEN toxic = 1 THEN 'llm_unparsed' WHEN quality = 1 THEN 'parallel_corpus' ELSE 'not_parallel_broad_multilingual' END AS label,
    CASE WHEN toxic = 1 THEN '' WHEN length(text) > 1000 THEN 'high' ELSE 'low' END AS confidence,
    CASE WHEN toxic = 1 THEN '' ELSE lang END AS reason,
    CASE WHEN toxic = 1 THEN '' ELSE substr(text, 1, 40) END AS evidence, toxic = 1 OR quality = 0 AS needs_human_review,
    CASE WHEN toxic = 1 THEN text END AS raw_answer
  FROM labels JOIN documents USING (doc_id))"""
PARSED_DECISIONS = f"WITH {DECISIONS_SQL} SELECT * FROM dec"


def review_queue(spark: SparkSession, d: str) -> DataFrame:
    return catalog.review_queue(parsed_decisions(spark, d)).select("dataset_id", "label", "confidence")


REVIEW_QUEUE = f"WITH {DECISIONS_SQL} SELECT dataset_id, label, confidence FROM dec ORDER BY label, confidence, dataset_id LIMIT 30"


def label_counts(spark: SparkSession, d: str) -> DataFrame:
    return catalog.label_counts(parsed_decisions(spark, d))


LABEL_COUNTS = f"WITH {DECISIONS_SQL} SELECT label, count(*) AS count FROM dec GROUP BY label"


def parallel_decisions(spark: SparkSession, d: str) -> DataFrame:
    wanted = F.col("label").isin("parallel_corpus", "parallel_candidate_needs_review")
    return parsed_decisions(spark, d).filter(wanted).select(
        "dataset_id", "label", "confidence", "reason", urls.catalogue_page_url(F.col("dataset_id")).alias("url")
    )


PARALLEL_DECISIONS = f"""
WITH {DECISIONS_SQL}
SELECT dataset_id, label, confidence, reason, 'https://huggingface.co/datasets/' || dataset_id AS url FROM dec WHERE label = 'parallel_corpus'"""


def undecided_cards(spark: SparkSession, d: str) -> DataFrame:
    return catalog.undecided(cards(spark, d))


UNDECIDED_CARDS = f"""
WITH {tb.CARDS_SQL}
SELECT id AS dataset_id, 'needs_openrouter_key' AS label, 'none' AS confidence,
  'классификация параллельности отключена: нет OPENROUTER_API_KEY' AS reason,
  substr(lower(id || ' ' || description || ' ' || array_to_string(tags, ' ')), 1, 500) AS evidence, TRUE AS needs_human_review,
  downloads, {_LANG_TAGS} AS language_tags, array_to_string(list_filter(tags, lambda t: starts_with(t, 'task_categories:')), '; ') AS task_tags,
  'https://huggingface.co/datasets/' || id AS url, 'no_llm' AS mode FROM cards"""


def decision_records(spark: SparkSession, d: str) -> DataFrame:
    """Every answer as a decision with its page and mode; cards without an answer follow as undecided."""
    answered = catalog.decision_records(parsed_decisions(spark, d), "llm")
    cards_left = catalog.undecided(cards(spark, d)).withColumn("raw_answer", F.lit(None).cast("string"))
    return answered.unionByName(cards_left.select(*answered.columns))


DECISION_RECORDS = f"""
WITH {DECISIONS_SQL}, u AS ({UNDECIDED_CARDS})
SELECT *, 'https://huggingface.co/datasets/' || dataset_id AS url, 'llm' AS mode FROM dec
UNION ALL BY NAME
SELECT dataset_id, label, confidence, reason, evidence, needs_human_review, url, mode FROM u"""


def unparsable_numbers(spark: SparkSession, d: str) -> DataFrame:
    """Fields of documents read as numbers: each cell that is none, such as a first word."""
    rows = tb.documents(spark, d).withColumn("first_word", F.split("text", " ", 2)[0])
    return catalog.unparsable_numbers(rows, "doc_id", "first_word", "source", "n_chars")


UNPARSABLE_NUMBERS = r"""
WITH cells AS (
  SELECT doc_id, 'first_word' AS field, split_part(text, ' ', 1) AS value FROM documents
  UNION ALL SELECT doc_id, 'source', source FROM documents
  UNION ALL SELECT doc_id, 'n_chars', n_chars::VARCHAR FROM documents)
SELECT * FROM cells WHERE value <> '' AND NOT (regexp_full_match(value, '\s*[+-]?[0-9]+\s*') AND TRY_CAST(value AS BIGINT) IS NOT NULL)"""

NAMES = [
    "corpora_summary", "corpora_totals", "corpora_conform", "catalog_dedup_last", "card_brief", "card_fields", "catalog_matches",
    "catalog_top5", "size_categories", "card_summary", "query_errors", "pair_candidates", "query_templates", "inventory",
    "inventory_summary", "inventory_metadata", "family_totals", "family_branches", "snapshot_diff", "snapshot_carry_forward",
    "snapshot_update", "parsed_decisions", "review_queue", "label_counts", "parallel_decisions", "undecided_cards",
    "decision_records", "unparsable_numbers",
]
QUERIES = {n: globals()[n] for n in NAMES}
ORACLES = {n: globals()[n.upper()] for n in NAMES}
