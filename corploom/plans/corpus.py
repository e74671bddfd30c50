"""Queries over `documents`: features, copies, filters, splits, cards, profiles (each with its SQL oracle)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corploom.functions import text as tx
from corploom.functions import urls
from corploom.operators import dedup, langid, quality, report, snapshots, split
from corploom.plans import tables as tb
from corploom.plans.tables import RUN_DATE, SCRIPT, documents, load

SP = r"\s\x0b\x1c-\x1f\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
LW = "A-Za-zÀ-ÖØ-öø-ÿ"
W = r"\p{L}\p{N}_"


def _norm(t: str) -> str:
    return f"trim(regexp_replace({t}, '[{SP}]+', ' ', 'g'))"


def _n(t: str, pattern: str) -> str:
    return f"len(regexp_extract_all({t}, '{pattern}'))"


def _share(t: str, cls: str) -> str:
    return f"({_n(t, f'[{cls}]')}::DOUBLE / greatest(length({t}), 1))"


SQL_TOKENS = _n("text", f"[{W}]+")


# ---- features ------------------------------------------------------------


def text_features(spark: SparkSession, d: str) -> DataFrame:
    t = F.col("text")
    words = tx.script_tokens(t, SCRIPT)
    return documents(spark, d).select(
        "doc_id",
        F.length(t).alias("chars"),
        F.length(tx.normalize_space(t)).alias("chars_clean"),
        tx.token_count(t).alias("tokens"),
        tx.whitespace_token_count(t).alias("ws_tokens"),
        F.round(tx.char_share(t, SCRIPT), 6).alias("script_share"),
        F.round(tx.char_share(t, tx.LATIN), 6).alias("latin_share"),
        tx.letter_share(t, tx.LATIN, SCRIPT).alias("plain_letter_share"),
        F.round(tx.outside_share(t, SCRIPT + tx.OCR_PUNCTUATION), 6).alias("weird_char_share"),
        tx.outside_count(t, tx.WORD_CLASS + tx.PROSE_PUNCTUATION + SCRIPT).alias("weird_char_count"),
        F.size(words).alias("tokens_2plus"),
        tx.unique_lower_count(words).alias("unique_tokens_2plus"),
        tx.short_token_count(t).alias("short_tokens"),
        tx.line_count(t).alias("line_count"),
        tx.preview(t, 400).alias("extract_preview"),
    )


_OCR = r"0-9\s\x0b\x1c-\x1f\x{85}\x{a0}.,:;!?()\-—\"«»"
_PROSE = r"\s\x0b\x1c-\x1f\x{85}\x{a0}.,:;!?()\-«»\"''/"
TEXT_FEATURES = f"""
SELECT doc_id, length(text) AS chars, length({_norm('text')}) AS chars_clean, {SQL_TOKENS} AS tokens,
  {_n('text', f'[^{SP}]+')} AS ws_tokens,
  round({_share('text', LW)}, 6) AS script_share, round({_share('text', 'A-Za-z')}, 6) AS latin_share,
  coalesce(round({_n('text', '[A-Za-z]')}::DOUBLE / nullif({_n('text', f'[{LW}]')}, 0), 3), 0.0) AS plain_letter_share,
  round({_n('text', f'[^{LW}{_OCR}]')}::DOUBLE / greatest(length(text), 1), 6) AS weird_char_share,
  {_n('text', f'[^{W}{_PROSE}{LW}]')} AS weird_char_count,
  {_n('text', f'[{LW}]{{2,}}')} AS tokens_2plus,
  len(list_distinct(list_transform(regexp_extract_all(text, '[{LW}]{{2,}}'), lambda x: lower(x)))) AS unique_tokens_2plus,
  len(list_filter(regexp_extract_all(lower(text), '[{W}]+'), lambda x: length(x) <= 2)) AS short_tokens,
  {tb.LINE_SQL} AS line_count, substr(text, 1, 400) AS extract_preview
FROM documents"""


def sources_table(spark: SparkSession, d: str) -> DataFrame:
    title = F.concat_ws(" ", "lang", "source", F.col("doc_id").cast("string"), F.regexp_extract("text", r"^\S+", 0))
    return documents(spark, d).select(
        title.alias("title"),
        F.col("doc_id").alias("pageid"),
        urls.title_url("https://example.org/wiki/", title).alias("url"),
        F.lit("wiki_article").alias("type"),
        F.lit("check page history and terms").alias("license_or_access"),
        F.lit("API search result").alias("notes"),
    )


SOURCES_TABLE = r"""
WITH t AS (SELECT doc_id, concat_ws(' ', lang, source, doc_id::VARCHAR, regexp_extract(text, '^[^\s\x0b]+', 0)) AS title FROM documents)
SELECT title, doc_id AS pageid, 'https://example.org/wiki/' || replace(url_encode(replace(title, ' ', '_')), '%2F', '/') AS url,
  'wiki_article' AS type, 'check page history and terms' AS license_or_access, 'API search result' AS notes FROM t"""


# ---- copies and filters --------------------------------------------------


def exact_duplicates(spark: SparkSession, d: str) -> DataFrame:
    flagged = dedup.flag_exact(documents(spark, d), F.col("text"), "doc_id")
    return flagged.select("doc_id", "source", "duplicate")


EXACT_DUPLICATES = """
SELECT doc_id, source, row_number() OVER (PARTITION BY text ORDER BY doc_id) > 1 AS duplicate FROM documents"""


def _raw(spark: SparkSession, d: str) -> DataFrame:
    return quality.raw_corpus(documents(spark, d), "text", SCRIPT)


def quality_filter_strict(spark: SparkSession, d: str) -> DataFrame:
    kept = quality.filtered_corpus(_raw(spark, d), "text", "doc_id")
    return kept.select("doc_id", "chars", F.round("script_share", 6).alias("script_share"), "line_count", "duplicate_text")


QUALITY_FILTER_STRICT = f"""
WITH f AS (SELECT *, length(text) AS chars, {_share('text', LW)} AS sh, {tb.LINE_SQL} AS line_count FROM documents)
SELECT doc_id, chars, round(sh, 6) AS script_share, line_count,
  row_number() OVER (PARTITION BY text ORDER BY doc_id) > 1 AS duplicate_text
FROM f WHERE chars >= 200 AND sh > 0.45"""


def clean(spark: SparkSession, d: str) -> DataFrame:
    return quality.clean_measures(documents(spark, d), "text", "doc_id", SCRIPT, "source")


def quality_filter_keep(spark: SparkSession, d: str) -> DataFrame:
    return clean(spark, d).select(
        "doc_id", "chars", "tokens", F.round("script_share", 6).alias("script_share"), "duplicate", "keep"
    )


CLEAN_SQL = f"""
norm AS (SELECT *, {_norm('text')} AS text_clean FROM documents),
feat AS (SELECT *, length(text_clean) AS chars, {_n('text_clean', f'[{W}]+')} AS tokens, {_share('text_clean', LW)} AS sh,
    row_number() OVER (PARTITION BY text_clean ORDER BY doc_id) > 1 AS duplicate FROM norm),
clean AS (SELECT *, chars >= 300 AND sh >= 0.45 AND NOT duplicate AS keep FROM feat)"""
QUALITY_FILTER_KEEP = f"""
WITH {CLEAN_SQL}
SELECT doc_id, chars, tokens, round(sh, 6) AS script_share, duplicate, keep FROM clean"""


def filter_review(spark: SparkSession, d: str) -> DataFrame:
    return quality.filter_review(_raw(spark, d), "text")


FILTER_REVIEW = f"""
WITH f AS (SELECT text, length(text) AS chars, {_share('text', LW)} AS sh FROM documents),
k AS (SELECT * FROM f WHERE chars >= 200 AND sh > 0.45)
SELECT (SELECT count(*) FROM f) AS n_sources, (SELECT count(*) FROM k) AS n_texts_kept,
  (SELECT count(*) FROM f WHERE chars < 200) AS too_short, (SELECT count(*) FROM f WHERE sh <= 0.45) AS low_script_share,
  (SELECT count(*) - count(DISTINCT text) FROM k) AS duplicates"""


def filter_review_json(spark: SparkSession, d: str) -> DataFrame:
    return report.as_json(filter_review(spark, d))


FILTER_REVIEW_JSON = f"""
WITH r AS ({FILTER_REVIEW})
SELECT '{{"n_sources":' || n_sources || ',"n_texts_kept":' || n_texts_kept || ',"too_short":' || too_short
  || ',"low_script_share":' || low_script_share || ',"duplicates":' || duplicates || '}}' AS json FROM r"""


# ---- splits --------------------------------------------------------------


def kept(spark: SparkSession, d: str) -> DataFrame:
    narrow = clean(spark, d).select("doc_id", "chars", "tokens", "script_share", "keep")
    return narrow.filter("keep").drop("keep")


def hash_split_exact(spark: SparkSession, d: str) -> DataFrame:
    return split.exact_split(kept(spark, d), "doc_id").select("doc_id", "chars", "split")


_RANKED = """ranked AS (
  SELECT *, row_number() OVER (ORDER BY md5('42:' || doc_id)) - 1 AS i, count(*) OVER () AS n FROM clean WHERE keep),
parts AS (
  SELECT *, CASE WHEN i >= floor(n * 0.9::DOUBLE) THEN 'test' WHEN i >= floor(n * 0.8::DOUBLE) THEN 'dev' ELSE 'train' END AS split
  FROM ranked)"""
HASH_SPLIT_EXACT = f"WITH {CLEAN_SQL}, {_RANKED} SELECT doc_id, chars, split FROM parts"


def split_totals(spark: SparkSession, d: str) -> DataFrame:
    """The flagship: normalise, measure, flag copies, keep, split exactly, total per split."""
    parts = split.exact_split(kept(spark, d), "doc_id")
    return parts.groupBy("split").agg(
        F.count("*").alias("documents"),
        F.sum("chars").alias("chars"),
        F.sum("tokens").alias("tokens"),
        F.round(F.avg("script_share"), 6).alias("mean_script_share"),
    )


SPLIT_TOTALS = f"""
WITH {CLEAN_SQL}, {_RANKED}
SELECT split, count(*) AS documents, sum(chars)::BIGINT AS chars, sum(tokens)::BIGINT AS tokens,
  round(avg(sh), 6) AS mean_script_share FROM parts GROUP BY split"""


def hash_split_threshold(spark: SparkSession, d: str) -> DataFrame:
    return kept(spark, d).select("doc_id", split.threshold_split("doc_id").alias("split"))


def _u(key: str, seed: int = 42) -> str:
    return f"(('0x' || substr(md5('{seed}:' || {key}), 1, 13))::BIGINT / 4503599627370496.0::DOUBLE)"


def _split_sql(key: str) -> str:
    return f"CASE WHEN {_u(key)} < 0.8::DOUBLE THEN 'train' WHEN {_u(key)} < 0.9::DOUBLE THEN 'dev' ELSE 'test' END"


HASH_SPLIT_THRESHOLD = f"WITH {CLEAN_SQL} SELECT doc_id, {_split_sql('doc_id')} AS split FROM clean WHERE keep"


def group_split(spark: SparkSession, d: str) -> DataFrame:
    """Whole sources stay in one split; five folds by text for small sets."""
    return documents(spark, d).select(
        "doc_id",
        "source",
        split.threshold_split("source").alias("split"),
        split.fold(tx.text_hash(F.col("text")), 5).alias("fold"),
    )


GROUP_SPLIT = f"""
SELECT doc_id, source, {_split_sql('source')} AS split,
  ('0x' || substr(md5('42:' || sha256(text)), 1, 13))::BIGINT % 5 AS fold FROM documents"""


def split_leaks(spark: SparkSession, d: str) -> DataFrame:
    """Texts that a split by document spreads over several splits."""
    return split.leaks(documents(spark, d).withColumn("split", split.threshold_split("doc_id")), F.col("text"))


SPLIT_LEAKS = f"""
WITH s AS (SELECT text, {_split_sql('doc_id')} AS split FROM documents),
g AS (SELECT text, string_agg(DISTINCT split, '+' ORDER BY split) AS splits, count(*) AS n FROM s GROUP BY text)
SELECT splits, count(*) AS texts, sum(n)::BIGINT AS documents FROM g WHERE contains(splits, '+') GROUP BY splits"""


def split_leaks_grouped(spark: SparkSession, d: str) -> DataFrame:
    """The same count when copies share a key: no text crosses, so the report is a row of zeros."""
    docs = documents(spark, d).withColumn("split", split.threshold_split(tx.text_hash(F.col("text"))))
    return split.leaks(docs, F.col("text")).agg(
        F.count("*").alias("crossing_combinations"), F.coalesce(F.sum("texts"), F.lit(0)).alias("crossing_texts")
    )


SPLIT_LEAKS_GROUPED = f"""
WITH s AS (SELECT text, {_split_sql('sha256(text)')} AS split FROM documents),
g AS (SELECT text, count(DISTINCT split) AS k, string_agg(DISTINCT split, '+' ORDER BY split) AS splits FROM s GROUP BY text)
SELECT count(DISTINCT splits) FILTER (k > 1) AS crossing_combinations, count(*) FILTER (k > 1) AS crossing_texts FROM g"""


def benchmark_overlap(spark: SparkSession, d: str) -> DataFrame:
    return split.held_out_overlap(documents(spark, d), "doc_id", "text", load(spark, d, "benchmark"), "text")


def _grams_sql(table: str, key: str) -> str:
    return f"""SELECT DISTINCT {key}, unnest(list_transform(range(1, len(w) - 6), lambda i: array_to_string(w[i:i+7], ' '))) AS gram
  FROM (SELECT {key}, regexp_extract_all(lower(text), '[{W}]+') AS w FROM {table}) WHERE len(w) >= 8"""


BENCHMARK_OVERLAP = f"""
WITH d AS ({_grams_sql('documents', 'doc_id')}), b AS ({_grams_sql('benchmark', 'item_id')})
SELECT doc_id, count(*) AS shared_ngrams FROM d WHERE gram IN (SELECT gram FROM b) GROUP BY doc_id"""


# ---- cards and profiles --------------------------------------------------


def data_card_totals(spark: SparkSession, d: str) -> DataFrame:
    return report.data_card_totals(clean(spark, d))


DATA_CARD_TOTALS = f"""
WITH {CLEAN_SQL}
SELECT count(*) AS raw_documents, count(*) FILTER (keep) AS kept_documents,
  coalesce(sum(chars) FILTER (keep), 0)::BIGINT AS kept_chars FROM clean"""


def data_card_text(spark: SparkSession, d: str) -> DataFrame:
    return report.data_card(data_card_totals(spark, d), "driver documents", "documents table", "Check the terms of each source.")


DATA_CARD_TEXT = f"""
WITH t AS ({DATA_CARD_TOTALS})
SELECT replace('# Data card: driver documents||## Source|documents table||## Size|- Raw documents: ' || raw_documents
  || '|- Kept documents: ' || kept_documents || '|- Total kept characters: ' || kept_chars
  || '||## Filtering|- Removed exact duplicates|- Removed documents shorter than 300 characters|- Required script share >= 0.45|'
  || '|## Known limitations|- Human language review is still required||## License|Check the terms of each source.|', '|', chr(10)) AS card
FROM t"""


def data_card_sources(spark: SparkSession, d: str) -> DataFrame:
    return report.breakdown(clean(spark, d), "source")


DATA_CARD_SOURCES = f"""
WITH {CLEAN_SQL}
SELECT source, count(*) AS documents, count(*) FILTER (keep) AS kept, coalesce(sum(chars) FILTER (keep), 0)::BIGINT AS kept_chars
FROM clean GROUP BY source"""


def corpus_profile(spark: SparkSession, d: str) -> DataFrame:
    return quality.corpus_profile(documents(spark, d), "text", ["lang", "source"])


CORPUS_PROFILE = f"""
SELECT lang, source, count(*) AS docs, sum(length(text))::BIGINT AS chars, sum({SQL_TOKENS})::BIGINT AS words,
  round(avg((length(text) < 300)::INT), 6) AS short_share, round(avg((trim(text) = '')::INT), 6) AS empty_share
FROM documents GROUP BY lang, source"""


def coverage(spark: SparkSession, d: str) -> DataFrame:
    return quality.coverage(documents(spark, d), ["lang", "source", "genre", "age_group", "dialect"])


COVERAGE = """
SELECT 'lang' AS field, lang AS value, count(*) AS docs FROM documents GROUP BY lang
UNION ALL SELECT 'source', source, count(*) FROM documents GROUP BY source"""


def provenance(spark: SparkSession, d: str) -> DataFrame:
    docs = documents(spark, d).select(
        F.concat(F.lit("https://example.org/"), "source", F.lit("/"), F.col("doc_id").cast("string")).alias("url"),
        F.regexp_extract("text", r"^[^\n]*", 0).alias("title"),
        F.col("lang").alias("lang_source"),
        F.lit("unknown").alias("license"),
        "text",
        "doc_id",
    )
    traced = quality.provenance(docs, "text", RUN_DATE, "0.1.0").drop("text")
    judged = langid.identify(documents(spark, d), "doc_id", "text", "lang", _profiles(spark, d))
    return traced.join(judged.select("doc_id", "lang_classifier"), "doc_id", "left").drop("doc_id")


# ---- lines, rules, personal data -----------------------------------------


def repeated_lines(spark: SparkSession, d: str) -> DataFrame:
    return dedup.repeated_lines(documents(spark, d), "text", "doc_id")


_LINES = r"""lines AS (SELECT doc_id, pos, trim(line) AS line FROM (
  SELECT doc_id, unnest(l) AS line, generate_subscripts(l, 1) AS pos
  FROM (SELECT doc_id, string_split_regex(text, '\r\n|[\n\r\x0b\x0c\x1c-\x1e\x{85}\x{2028}\x{2029}]') AS l FROM documents))
  WHERE length(trim(line)) > 0)"""
REPEATED_LINES = f"WITH {_LINES} SELECT line, count(*) AS n FROM lines GROUP BY line HAVING count(*) >= 2"


def boilerplate_removed(spark: SparkSession, d: str) -> DataFrame:
    kept_text = dedup.drop_boilerplate(documents(spark, d), "text", "doc_id", at_least=10)
    return kept_text.select("doc_id", F.md5("text_kept").alias("kept_hash"), "lines_dropped")


BOILERPLATE_REMOVED = f"""
WITH {_LINES}, c AS (SELECT *, count(*) OVER (PARTITION BY line) AS n FROM lines)
SELECT doc_id, md5(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (n < 10), '')) AS kept_hash,
  count(*) FILTER (n >= 10) AS lines_dropped FROM documents LEFT JOIN c USING (doc_id) GROUP BY doc_id"""


def cleaning_rule_counts(spark: SparkSession, d: str) -> DataFrame:
    return quality.cleaning_rule_counts(documents(spark, d), "text", tx.LATIN, "À-ÖØ-öø-ÿ")


_EMAIL = r"[A-Za-z0-9._%+\-]+@[A-Za-z0-9.\-]+\.[A-Za-z]{2,}"
_PHONE = r"\+?[0-9][0-9()\- ]{7,}[0-9]"
CLEANING_RULE_COUNTS = rf"""
SELECT count(*) AS documents,
  count(*) FILTER (regexp_matches(text, '<[A-Za-z/!][^<>]*>|&[A-Za-z]+;|&#[0-9]+;')) AS markup,
  count(*) FILTER (regexp_matches(text, '\n[ \t]*\n')) AS blank_lines,
  count(*) FILTER (regexp_matches(text, '(^|\n)[ \t]+|[ \t]+(\n|$)|  ')) AS edge_spaces,
  count(*) FILTER (regexp_matches(text, '[ʼ’‘`´′‐‑‒–−]')) AS marks,
  count(*) FILTER (regexp_matches(text, '[A-Za-z]') AND regexp_matches(text, '[À-ÖØ-öø-ÿ]')) AS mixed_script,
  count(*) FILTER (regexp_matches(text, '{_EMAIL}') OR regexp_matches(text, '{_PHONE}')) AS personal_data,
  count(*) - count(DISTINCT text) AS duplicates FROM documents"""


def pii_flags(spark: SparkSession, d: str) -> DataFrame:
    return quality.personal_data(documents(spark, d), "text").select(
        "doc_id", "emails", "phones", F.md5("text_masked").alias("masked_hash")
    )


PII_FLAGS = rf"""
WITH m AS (SELECT doc_id, text, regexp_replace(text, '{_EMAIL}', '[EMAIL]', 'g') AS t FROM documents)
SELECT doc_id, {_n('text', _EMAIL)} AS emails, {_n('t', _PHONE)} AS phones,
  md5(regexp_replace(t, '{_PHONE}', '[PHONE]', 'g')) AS masked_hash FROM m"""


def unicode_unified(spark: SparkSession, d: str) -> DataFrame:
    unified = quality.unify_unicode(F.col("text"))
    return documents(spark, d).select("doc_id", F.md5(unified).alias("unified_hash"), (unified != F.col("text")).alias("changed"))


UNICODE_UNIFIED = """
WITH u AS (SELECT doc_id, text, translate(nfc_normalize(text), 'ʼ’‘`´′‐‑‒–−', '''''''''''''-----') AS t FROM documents)
SELECT doc_id, md5(t) AS unified_hash, t <> text AS changed FROM u"""


def synthetic_check(spark: SparkSession, d: str) -> DataFrame:
    """Synthetic-text check with labels standing in: texts judged good as human, bad as synthetic."""
    marks = load(spark, d, "labels").select(
        "doc_id", F.when(F.col("quality") == 1, "human").otherwise("synthetic").alias("origin")
    )
    docs = documents(spark, d).join(marks, "doc_id", "left")
    return quality.unmarked_synthetic(docs, "origin", "text")


SYNTHETIC_CHECK = """
WITH m AS (SELECT text, CASE quality WHEN 1 THEN 'human' WHEN 0 THEN 'synthetic' END AS origin
  FROM documents LEFT JOIN labels USING (doc_id)),
g AS (SELECT text, count(DISTINCT origin) AS k FROM m GROUP BY text)
SELECT (SELECT count(*) FROM m) AS rows_total, (SELECT count(*) FROM m WHERE origin IS NULL) AS rows_unmarked,
  (SELECT count(*) FROM g WHERE k > 1) AS texts_mixed"""


# ---- review samples ------------------------------------------------------


def review_sample(spark: SparkSession, d: str) -> DataFrame:
    return quality.review_sample(documents(spark, d), "doc_id").select("doc_id", "lang", "source", F.md5("text").alias("text_md5"))


REVIEW_SAMPLE = """
SELECT doc_id, lang, source, md5(text) AS text_md5 FROM documents ORDER BY md5('7:' || doc_id), doc_id LIMIT 30"""


def review_label_shares(spark: SparkSession, d: str) -> DataFrame:
    """Shares of usable and of toxic texts among the labelled documents, per language."""
    labelled = load(spark, d, "labels").join(documents(spark, d).select("doc_id", "lang"), "doc_id")
    return labelled.groupBy("lang").agg(
        F.count("*").alias("reviewed"),
        F.round(F.avg("quality"), 6).alias("usable_share"),
        F.round(F.avg("toxic"), 6).alias("toxic_share"),
    )


REVIEW_LABEL_SHARES = """
SELECT lang, count(*) AS reviewed, round(avg(quality), 6) AS usable_share, round(avg(toxic), 6) AS toxic_share
FROM labels JOIN documents USING (doc_id) GROUP BY lang"""


# ---- near copies, languages, extraction ----------------------------------

BANDS, ROWS, WIDTH = 5, 8, 3


def near_duplicates(spark: SparkSession, d: str) -> DataFrame:
    return dedup.near_duplicates(documents(spark, d), "text", "doc_id", "source", BANDS, ROWS, WIDTH)


_MINIMA = ", ".join(f"min((h * {a} + {b}) % {dedup.PRIME}) AS m{i}" for i, (a, b) in enumerate(dedup.hash_family(BANDS * ROWS)))
_KEYS = ", ".join(
    "'" + str(b) + ":' || concat_ws(',', " + ", ".join(f"m{b * ROWS + r}" for r in range(ROWS)) + ")" for b in range(BANDS)
)
NEAR_DUPLICATES = f"""
WITH RECURSIVE w AS (SELECT doc_id, source, regexp_extract_all(lower(text), '[{W}]+') AS w FROM documents),
sh AS (SELECT doc_id, ('0x' || substr(md5(s), 1, 8))::BIGINT % {dedup.PRIME} AS h FROM (
  SELECT doc_id, unnest(list_transform(range(1, greatest(len(w) - {WIDTH - 1}, 1) + 1),
    lambda i: array_to_string(w[i:i + {WIDTH - 1}], ' '))) AS s FROM w WHERE len(w) > 0)),
sig AS (SELECT doc_id, {_MINIMA} FROM sh GROUP BY doc_id),
links AS (SELECT doc_id, unnest([{_KEYS}]) AS k FROM sig),
hub AS (SELECT k, min(doc_id) AS lo FROM links GROUP BY k HAVING count(*) > 1),
e AS (SELECT DISTINCT doc_id AS a, lo AS b FROM links JOIN hub USING (k)),
e2 AS (SELECT a, b FROM e UNION SELECT b, a FROM e),
reach AS (SELECT doc_id AS a, doc_id AS b FROM w UNION SELECT r.a, e2.b FROM reach r JOIN e2 ON e2.a = r.b),
lab AS (SELECT a AS doc_id, min(b) AS label FROM reach GROUP BY a),
sz AS (SELECT label, count(*) AS group_size FROM lab GROUP BY label HAVING count(*) > 1)
SELECT w.doc_id, w.source, w.doc_id <> label AS removed, label AS removed_by, k.source AS removed_source, group_size
FROM w JOIN lab USING (doc_id) JOIN sz USING (label) JOIN w AS k ON k.doc_id = label"""


def _profiles(spark: SparkSession, d: str) -> DataFrame:
    good = load(spark, d, "labels").filter("quality = 1").select("doc_id")
    return langid.profiles(documents(spark, d).join(good, "doc_id", "left_semi"), "text", "lang")


def language_id(spark: SparkSession, d: str) -> DataFrame:
    return langid.identify(documents(spark, d), "doc_id", "text", "lang", _profiles(spark, d))


def _trigrams(columns: str, source: str) -> str:
    return rf"""SELECT {columns}, unnest(list_transform(range(1, len(c) - 1), lambda i: c[i] || c[i+1] || c[i+2])) AS gram
  FROM (SELECT {columns}, string_split(' ' || trim(regexp_replace(lower(text), '[^\p{{L}}]+', ' ', 'g')) || ' ', '') AS c FROM {source})"""


_LANGID = rf"""
anchors AS (SELECT lang AS profile_lang, text FROM documents JOIN labels USING (doc_id) WHERE quality = 1),
pc AS (SELECT profile_lang, gram, count(*) AS n FROM ({_trigrams('profile_lang', 'anchors')}) GROUP BY ALL),
prof AS (SELECT profile_lang, gram, 301 - rk AS weight FROM (
  SELECT *, row_number() OVER (PARTITION BY profile_lang ORDER BY n DESC, gram) AS rk FROM pc) WHERE rk <= 300),
dg AS ({_trigrams('doc_id', 'documents')}),
sc AS (SELECT doc_id, profile_lang, sum(weight)::BIGINT AS score FROM dg JOIN prof USING (gram) GROUP BY ALL),
rk AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY score DESC, profile_lang DESC) AS r FROM sc),
best AS (SELECT doc_id, max(CASE WHEN r = 1 THEN profile_lang END) AS l, coalesce(max(CASE WHEN r = 1 THEN score END), 0) AS s1,
  coalesce(max(CASE WHEN r = 2 THEN score END), 0) AS s2 FROM rk GROUP BY doc_id),
ident AS (SELECT doc_id, lang, coalesce(CASE WHEN s1 - s2 < s1 * 0.1::DOUBLE THEN 'mixed' ELSE l END, 'unknown') AS lang_classifier,
  coalesce(s1, 0) AS score, coalesce(s2, 0) AS runner_up_score FROM documents LEFT JOIN best USING (doc_id))"""
LANGUAGE_ID = f"WITH {_LANGID} SELECT *, lang_classifier = lang AS agrees FROM ident"


PROVENANCE = rf"""
WITH {_LANGID}
SELECT 'https://example.org/' || d.source || '/' || doc_id AS url, regexp_extract(d.text, '^[^\n]*', 0) AS title, d.lang AS lang_source,
  i.lang_classifier, 'unknown' AS license, '{RUN_DATE}' AS load_date, sha256(d.text) AS text_hash, '0.1.0' AS pipeline_version
FROM documents d LEFT JOIN (SELECT doc_id, lang_classifier FROM ident) i USING (doc_id)"""


def monolingual_extract(spark: SparkSession, d: str) -> DataFrame:
    """Language filter, copies out, boilerplate out, length, then volume per source: one table per language."""
    docs = documents(spark, d)
    agreed = langid.identify(docs, "doc_id", "text", "lang", _profiles(spark, d)).filter("agrees").select("doc_id")
    unique = dedup.flag_exact(docs, F.col("text"), "doc_id").filter("NOT duplicate").select("doc_id")
    text = dedup.drop_boilerplate(docs, "text", "doc_id", at_least=10)
    kept_text = (
        text.filter(F.length("text_kept") >= 300)
        .join(agreed, "doc_id", "left_semi")
        .join(unique, "doc_id", "left_semi")
        .join(docs.select("doc_id", "lang", "source"), "doc_id")
    )
    return quality.corpus_profile(kept_text, "text_kept", ["lang", "source"])


MONOLINGUAL_EXTRACT = f"""
WITH {_LANGID}, {_LINES}, c AS (SELECT *, count(*) OVER (PARTITION BY line) AS n FROM lines),
t AS (SELECT doc_id, coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (n < 10), '') AS text FROM c GROUP BY doc_id),
firsts AS (SELECT min(doc_id) AS doc_id FROM documents GROUP BY text)
SELECT lang, source, count(*) AS docs, sum(length(t.text))::BIGINT AS chars, sum({_n('t.text', f'[{W}]+')})::BIGINT AS words,
  0.0 AS short_share, 0.0 AS empty_share
FROM t JOIN documents USING (doc_id) WHERE length(t.text) >= 300 AND doc_id IN (SELECT doc_id FROM firsts)
  AND doc_id IN (SELECT doc_id FROM ident WHERE lang_classifier = lang) GROUP BY lang, source"""


def incremental_refresh(spark: SparkSession, d: str) -> DataFrame:
    """Texts not seen in the state so far (here: the labelled documents), one row per new text."""
    docs = documents(spark, d)
    seen = docs.join(load(spark, d, "labels").select("doc_id"), "doc_id", "left_semi")
    known = seen.select(tx.text_hash(F.col("text")).alias("text_hash"))
    return snapshots.changed_texts(docs, F.col("text"), "doc_id", known)


INCREMENTAL_REFRESH = """
WITH known AS (SELECT DISTINCT sha256(text) AS text_hash FROM documents WHERE doc_id IN (SELECT doc_id FROM labels))
SELECT sha256(text) AS text_hash, min(doc_id) AS doc_id, count(*) AS copies FROM documents
WHERE sha256(text) NOT IN (SELECT text_hash FROM known) GROUP BY text"""

NAMES = [
    "text_features", "sources_table", "exact_duplicates", "quality_filter_strict", "quality_filter_keep", "filter_review",
    "filter_review_json", "hash_split_exact", "split_totals", "hash_split_threshold", "group_split", "split_leaks",
    "split_leaks_grouped", "benchmark_overlap", "data_card_totals", "data_card_text", "data_card_sources", "corpus_profile",
    "coverage", "provenance", "repeated_lines", "boilerplate_removed", "cleaning_rule_counts", "pii_flags", "unicode_unified",
    "synthetic_check", "review_sample", "review_label_shares", "near_duplicates", "language_id", "monolingual_extract",
    "incremental_refresh",
]
QUERIES = {n: globals()[n] for n in NAMES}
ORACLES = {n: globals()[n.upper()] for n in NAMES}
