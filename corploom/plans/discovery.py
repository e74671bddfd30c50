"""Page, alignment, recognition and package queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corploom.functions import text as tx
from corploom.functions import urls
from corploom.operators import align, markup, packages, pages, recognition
from corploom.operators.lookup import join_keyed
from corploom.plans import tables as tb
from corploom.plans.corpus import LW, SP, W, _n, _norm, _share
from corploom.plans.tables import SCRIPT, documents, load
from corploom.session import spread

# ---- pages ---------------------------------------------------------------


def page_text(spark: SparkSession, d: str) -> DataFrame:
    return tb.host_pages(spark, d).select("page_id", pages.page_text(F.col("html")).alias("text"))


_HIDDEN = r"(?is)<!--.*?-->|<script\b[^>]*>.*?</script\s*>|<style\b[^>]*>.*?</style\s*>|<noscript\b[^>]*>.*?</noscript\s*>"
_ENT = [("&quot;", '"'), ("&middot;", "·"), ("&copy;", "©"), ("&lt;", "<"), ("&gt;", ">"), ("&amp;", "&")]


def _unescaped(column: str) -> str:
    for name, mark in _ENT:
        column = f"replace({column}, '{name}', '{mark}')"
    return column


_BARE = rf"regexp_replace(regexp_replace(html, '{_HIDDEN}', ' ', 'g'), '(?s)<[A-Za-z/!?][^>]*>', ' ', 'g')"
_PTEXT = f"ptext AS (SELECT page_id, url, html, {_norm(_unescaped(_BARE))} AS text FROM pages)"
PAGE_TEXT = f"WITH {_PTEXT} SELECT page_id, text FROM ptext"


def page_links(spark: SparkSession, d: str) -> DataFrame:
    return pages.page_links(tb.host_pages(spark, d), ["page_id"], "url", "html")


_A = r"(?is)<a\s[^>]*\bhref\s*=\s*(\"[^\"]*\"|''[^'']*''|[^\s>]+)[^>]*>(.*?)</a\s*>"
_LINKS = rf"""
anchors AS (SELECT page_id, url AS base, lower(regexp_extract(url, '^[a-z]+://([^/?#]*)', 1)) AS host,
    regexp_extract_all(regexp_replace(html, '{_HIDDEN}', ' ', 'g'), '{_A}', 1) AS hs,
    regexp_extract_all(regexp_replace(html, '{_HIDDEN}', ' ', 'g'), '{_A}', 2) AS ls FROM pages),
links AS (
  SELECT page_id, host, base, pos, regexp_extract(base, '^[a-z]+://[^/?#]*') || {_unescaped("trim(hs[pos], '\"')")} AS url,
    substr({_norm(_unescaped("regexp_replace(ls[pos], '(?s)<[A-Za-z/!?][^>]*>', ' ', 'g')"))}, 1, 160) AS label
  FROM (SELECT *, unnest(range(1, len(hs) + 1)) AS pos FROM anchors))"""
PAGE_LINKS = f"WITH {_LINKS} SELECT page_id, pos, url, label FROM links"


def download_links(spark: SparkSession, d: str) -> DataFrame:
    """Per page: links in all, and the first three that look like data."""
    listed = pages.links_in_row(markup.of(F.col("html")), F.col("url"))
    rows = tb.host_pages(spark, d).select("page_id", tx.computed_once(links=listed).alias("_p")).filter(F.size("_p.links") > 0)
    found = rows.select("page_id", F.size("_p.links").cast("long").alias("links"), pages.downloads_in_row(F.col("_p.links")).alias("d"))
    return found.select("page_id", "links", "d.download_link_count", "d.download_links")


_DOWN = (
    r"(regexp_matches(lower(url), '\.(zip|tar\.gz|tgz|csv|tsv|json|jsonl|txt|xml|conllu|parquet|xlsx|wav|mp3)|raw\.githubusercontent\.com|/resolve/|releases/download')"
    " OR contains(lower(url || ' ' || label), 'download'))"
)
_DL = f"""
dl AS (SELECT page_id, count(*) AS download_link_count, string_agg(url, '; ' ORDER BY pos) AS download_links FROM (
  SELECT *, row_number() OVER (PARTITION BY page_id ORDER BY pos) AS rn FROM links WHERE {_DOWN}) WHERE rn <= 3 GROUP BY page_id)"""
DOWNLOAD_LINKS = f"""
WITH {_LINKS}, {_DL}
SELECT l.page_id, l.links, coalesce(download_link_count, 0) AS download_link_count, coalesce(download_links, '') AS download_links
FROM (SELECT page_id, count(*) AS links FROM links GROUP BY page_id) l LEFT JOIN dl USING (page_id)"""


def unwrapped_urls(spark: SparkSession, d: str) -> DataFrame:
    """Addresses wrapped into a search redirect, and taken out again."""
    wrapped = F.concat(F.lit("//duckduckgo.com/l/?uddg="), F.url_encode("url"), F.lit("&rut=1"))
    redirect = F.when(F.contains("url", F.lit("?")), wrapped).otherwise(F.col("url"))
    return tb.host_pages(spark, d).select("page_id", urls.unwrap_redirect(redirect).alias("url"))


UNWRAPPED_URLS = "SELECT page_id, url FROM pages"


def url_frontier(spark: SparkSession, d: str) -> DataFrame:
    return pages.frontier(tb.search_results(tb.host_pages(spark, d)), "host").select("host", "slot", "query_no", "rank", "url", "title")


_RESULTS = """
firstp AS (SELECT page_id, query_no FROM (
  SELECT page_id, row_number() OVER (PARTITION BY host ORDER BY page_id) - 1 AS query_no FROM anchors)),
results AS (SELECT l.host, f.query_no, l.pos - 1 AS rank, l.url, l.label AS title,
  CASE WHEN lower(l.label) = 'the' THEN 'challenge' END AS error FROM links l JOIN firstp f USING (page_id))"""
URL_FRONTIER = f"""
WITH {_LINKS}, {_RESULTS},
u AS (SELECT *, row_number() OVER (PARTITION BY host, url ORDER BY query_no, rank) AS nth FROM results
  WHERE query_no < 4 AND rank < 4 AND error IS NULL AND url <> ''),
s AS (SELECT *, row_number() OVER (PARTITION BY host ORDER BY query_no, rank) AS slot FROM u WHERE nth = 1)
SELECT host, slot, query_no, rank, url, title FROM s WHERE slot <= 10"""


def search_errors(spark: SparkSession, d: str) -> DataFrame:
    """Error rows of the search answers, kept beside the results: (host, query type, query, rank, error)."""
    results = tb.search_results(tb.host_pages(spark, d))
    return results.filter(F.col("error").isNotNull()).select("host", F.lit("search").alias("query_type"), "query_no", "rank", "error")


SEARCH_ERRORS = f"""
WITH {_LINKS}, {_RESULTS} SELECT host, 'search' AS query_type, query_no, rank, error FROM results WHERE error IS NOT NULL"""


def _classified(spark: SparkSession, d: str) -> DataFrame:
    """Pages with their rule labels: the markup is read once, links are judged in the row, no text is shuffled."""
    langs = tb.languages(documents(spark, d)).select(
        F.col("iso639_3").alias("page_lang"), F.array("language_en", "language_ru", "iso639_3").alias("names")
    )
    read = tb.host_pages(spark, d).select(
        "page_id", "host", "url", F.regexp_extract("html", r'<html[^>]*\blang="([a-z]+)"', 1).alias("page_lang"),
        markup.of(F.col("html")).alias("parts"),
    )
    found = pages.downloads_in_row(pages.links_in_row(F.col("parts"), F.col("url")))
    opened = read.select(
        "page_id", "host", "url", "page_lang", tx.computed_once(text=pages.visible(F.col("parts")), found=found).alias("_p")
    ).select("page_id", "host", "url", "page_lang", "_p.text", "_p.found.*")
    joined = join_keyed(opened, langs, "page_lang", F.col("page_id"), "left")
    return pages.classify(joined, "text", "url", F.col("names"), "download_link_count")


def page_candidates(spark: SparkSession, d: str) -> DataFrame:
    return _classified(spark, d).select(
        "page_id", "url", "page_lang", "label", "confidence", "dataset_type", "evidence", "needs_human_review", "human_review_note",
        "mode", F.coalesce("download_link_count", F.lit(0)).alias("download_link_count"),
    )


def _hits(words: list[str]) -> str:
    return " + ".join(f"(contains(lower(text), '{w}') OR contains(lower(url), '{w}'))::INT" for w in words)


_CLASS = rf"""
{tb.LANGUAGES_SQL}, {_PTEXT}, {_LINKS}, {_DL},
h AS (SELECT p.page_id, p.url, p.text, regexp_extract(p.html, '<html[^>]*\blang="([a-z]+)"', 1) AS page_lang,
  coalesce(download_link_count, 0) AS dlc, {_hits(pages.DATASET_WORDS).replace('text', 'p.text').replace('(url', '(p.url')} AS dh,
  {_hits(pages.SOURCE_ONLY_WORDS).replace('text', 'p.text').replace('(url', '(p.url')} AS sh
  FROM ptext p LEFT JOIN dl USING (page_id)),
k AS (SELECT h.*, coalesce((SELECT bool_or(contains(lower(h.text), lower(x)) OR contains(lower(h.url), lower(x)))
    FROM (SELECT unnest([language_en, language_ru, iso639_3]) AS x FROM langs WHERE iso639_3 = h.page_lang)), FALSE) AS lh FROM h),
cand AS (SELECT *, CASE WHEN dh >= 2 AND lh THEN 'dataset_candidate' WHEN dh >= 1 AND dlc > 0 THEN 'possible_dataset_candidate'
    WHEN sh > 0 THEN 'source_or_reference_only' ELSE 'unclear' END AS label FROM k)"""
PAGE_CANDIDATES = f"""
WITH {_CLASS}
SELECT page_id, url, page_lang, label, CASE WHEN label IN ('dataset_candidate', 'source_or_reference_only') THEN 'medium' ELSE 'low' END AS confidence,
  'unknown' AS dataset_type, substr(text, 1, 500) AS evidence, TRUE AS needs_human_review,
  CASE WHEN dlc > 0 THEN '{pages.REVIEW_LINKS}; ' ELSE '' END
  || CASE WHEN contains(lower(text), 'license') OR contains(lower(text), 'лиценз') THEN '{pages.REVIEW_LICENSE}' ELSE '{pages.REVIEW_NO_LICENSE}' END
  || CASE WHEN sh > 0 THEN '; {pages.REVIEW_SOURCE_ONLY}' ELSE '' END AS human_review_note,
  'heuristic' AS mode, dlc AS download_link_count FROM cand"""


def page_labels(spark: SparkSession, d: str) -> DataFrame:
    return _classified(spark, d).groupBy("label", "confidence").agg(F.count("*").alias("pages"))


PAGE_LABELS = f"""
WITH {_CLASS}
SELECT label, CASE WHEN label IN ('dataset_candidate', 'source_or_reference_only') THEN 'medium' ELSE 'low' END AS confidence,
  count(*) AS pages FROM cand GROUP BY label"""


def discovery_report(spark: SparkSession, d: str) -> DataFrame:
    """Per host: its search answers, its pages (spam hosts fail to open), its candidates."""
    results = tb.search_results(tb.host_pages(spark, d))
    failed = F.contains("host", F.lit("spam"))
    opened = tb.host_pages(spark, d).select("host", F.when(failed, "error").otherwise("200").alias("status"))
    candidates = _classified(spark, d).filter(~failed)
    return pages.discovery_report(results, opened, candidates, "host")


DISCOVERY_REPORT = f"""
WITH {_CLASS}, {_RESULTS},
a AS (SELECT host, count(DISTINCT query_no) AS queries, count(*) AS search_results FROM results GROUP BY host),
b AS (SELECT host, count(*) AS pages_opened, count(*) FILTER (contains(host, 'spam')) AS errors FROM anchors GROUP BY host),
c AS (SELECT host, count(*) AS n, count(*) FILTER (label IN ('dataset_candidate', 'possible_dataset_candidate')) AS useful,
  count(*) FILTER (dlc > 0) AS probes FROM cand JOIN anchors USING (page_id) WHERE NOT contains(host, 'spam') GROUP BY host)
SELECT host, coalesce(queries, 0) AS queries, coalesce(search_results, 0) AS search_results, pages_opened, errors,
  coalesce(n, 0) AS candidates_total, coalesce(useful, 0) AS dataset_candidates, coalesce(probes, 0) AS download_probes
FROM b LEFT JOIN a USING (host) LEFT JOIN c USING (host)"""


def _media_answers(spark: SparkSession, d: str) -> DataFrame:
    """Pages as media answers: plain addresses count as images, the rest as HTML."""
    mime = F.when(F.rlike("url", F.lit(r"[?#]|\.html$")), "text/html").otherwise("image/jpeg")
    value = lambda c: F.struct(c.alias("value"))
    meta = F.struct(value(F.lit("CC BY")).alias("LicenseShortName"), value(F.col("host")).alias("Artist"))
    info = F.struct("url", mime.alias("mime"), F.length("html").alias("width"), F.lit(100).alias("height"), meta.alias("extmetadata"))
    answer = F.struct(F.concat(F.lit("File:"), F.col("page_id").cast("string")).alias("title"), F.array(info).alias("imageinfo"))
    return tb.host_pages(spark, d).select("page_id", "host", F.to_json(answer).alias("raw"))


def media_candidates(spark: SparkSession, d: str) -> DataFrame:
    fields = pages.media_fields(_media_answers(spark, d), "raw", "host", "page_id")
    return pages.first_raster(fields, "host", "page_id", "File:fallback.jpg").select(
        "host", "title", "url", "mime", "width", "license", "artist", "is_fallback"
    )


MEDIA_CANDIDATES = r"""
WITH m AS (SELECT page_id, url, lower(regexp_extract(url, '^[a-z]+://([^/?#]*)', 1)) AS host, length(html) AS width,
  NOT regexp_matches(url, '[?#]|\.html$') AS raster FROM pages),
b AS (SELECT host, min(page_id) FILTER (raster) AS page_id FROM m GROUP BY host)
SELECT b.host, coalesce('File:' || m.page_id, 'File:fallback.jpg') AS title, m.url, CASE WHEN m.url IS NOT NULL THEN 'image/jpeg' END AS mime,
  m.width, CASE WHEN m.url IS NOT NULL THEN 'CC BY' END AS license, m.host AS artist, m.url IS NULL AS is_fallback
FROM b LEFT JOIN m USING (page_id)"""

# ---- alignment -----------------------------------------------------------


def corpus_slice(spark: SparkSession, d: str) -> DataFrame:
    """First 80 documents, first two string columns, first 50 rows: the reference's own slice."""
    return align.corpus_slice(documents(spark, d), "doc_id")


CORPUS_SLICE = """
SELECT doc_id, text AS tat, lang AS rus FROM (SELECT * FROM documents ORDER BY doc_id LIMIT 80)
WHERE text IS NOT NULL AND lang IS NOT NULL ORDER BY doc_id LIMIT 50"""


def align_shuffled(spark: SparkSession, d: str) -> DataFrame:
    """Candidate order of the right side: each vector with its sort key."""
    return load(spark, d, "embeddings").select("vec_id", align.shuffled(load(spark, d, "embeddings"), "vec_id").alias("sort_key"))


ALIGN_SHUFFLED = "SELECT vec_id, md5('7:' || vec_id) AS sort_key FROM embeddings"


def _top(spark: SparkSession, d: str, k: int) -> DataFrame:
    vectors = load(spark, d, "embeddings")
    return align.top_matches(vectors, vectors, "vec_id", "vec_id", "embedding", k=k, exclude_same=True)


def _gold(spark: SparkSession, d: str) -> DataFrame:
    """Best other vector per vector; the gold answer is a vector of the same label."""
    v = load(spark, d, "embeddings")
    left = v.select(F.col("vec_id").alias("left_id"), F.col("label").alias("gold_label"))
    right = v.select(F.col("vec_id").alias("right_id"), F.col("label").alias("best_label"))
    found = _top(spark, d, 1).join(left, "left_id").join(right, "right_id")
    return found.withColumn("correct_exact", F.col("best_label") == F.col("gold_label"))


def align_best(spark: SparkSession, d: str) -> DataFrame:
    return _gold(spark, d).select("left_id", "right_id", F.round("score", 6).alias("score"), "gold_label", "correct_exact")


_SIM = """sim AS (
  SELECT a.vec_id AS left_id, b.vec_id AS right_id, a.label AS gold_label, b.label AS best_label,
    round(list_cosine_similarity(a.embedding::DOUBLE[], b.embedding::DOUBLE[]), 12) AS score
  FROM embeddings a, embeddings b WHERE a.vec_id <> b.vec_id),
rk AS (SELECT *, row_number() OVER (PARTITION BY left_id ORDER BY score DESC, right_id) AS rank FROM sim)"""
ALIGN_BEST = f"""
WITH {_SIM} SELECT left_id, right_id, round(score, 6) AS score, gold_label, gold_label = best_label AS correct_exact FROM rk WHERE rank = 1"""


def align_report(spark: SparkSession, d: str) -> DataFrame:
    return align.alignment_report(_gold(spark, d))


ALIGN_REPORT = f"""
WITH {_SIM} SELECT count(*) AS pairs, round(avg((gold_label = best_label)::INT), 6) AS exact_alignment_accuracy,
  count(*) FILTER (score < 0.5) AS low_confidence_pairs FROM rk WHERE rank = 1"""


def align_topk(spark: SparkSession, d: str) -> DataFrame:
    return _top(spark, d, 3).select("left_id", "right_id", "rank", F.round("score", 6).alias("score"))


ALIGN_TOPK = f"WITH {_SIM} SELECT left_id, right_id, rank, round(score, 6) AS score FROM rk WHERE rank <= 3"


def mined_pairs(spark: SparkSession, d: str) -> DataFrame:
    """Top-3 pairs filtered by score, length ratio and language; each vector stands for the document of its id."""
    facts = documents(spark, d).select("doc_id", F.length("text").alias("chars"), F.col("lang").alias("language"), "source")
    left, right = facts.withColumnRenamed("doc_id", "left_id"), facts.withColumnRenamed("doc_id", "right_id")
    kept = align.mined_pairs(_top(spark, d, 3), left, right, min_score=0.2, max_ratio=3.0)
    return kept.select(
        "left_id", "right_id", F.round("score", 6).alias("score"), F.round("length_ratio", 6).alias("length_ratio"),
        "left_source", "right_source", "review_status",
    )


MINED_PAIRS = f"""
WITH {_SIM}, p AS (SELECT left_id, right_id, score, a.source AS left_source, b.source AS right_source, a.lang AS la, b.lang AS lb,
  greatest(length(a.text), length(b.text)) / greatest(least(length(a.text), length(b.text)), 1)::DOUBLE AS ratio
  FROM rk JOIN documents a ON a.doc_id = left_id JOIN documents b ON b.doc_id = right_id WHERE rank <= 3 AND score >= 0.2)
SELECT left_id, right_id, round(score, 6) AS score, round(ratio, 6) AS length_ratio, left_source, right_source, 'unreviewed' AS review_status
FROM p WHERE ratio <= 3 AND la <> lb"""


def segments(spark: SparkSession, d: str) -> DataFrame:
    return align.segments(documents(spark, d), "doc_id", "text", "lang", "source")


SEGMENTS = r"""
WITH s AS (SELECT doc_id, lang, source,
    list_filter(list_transform(string_split(regexp_replace(text, '([.!?…])\s+|\n+', '\1' || chr(1), 'g'), chr(1)), lambda x: trim(x)), lambda x: length(x) > 0) AS l
  FROM documents)
SELECT doc_id || '-' || (pos - 1) AS segment_id, doc_id, l[pos] AS text, lang AS language, source
FROM (SELECT *, unnest(range(1, len(l) + 1)) AS pos FROM s)"""

# ---- recognised text -----------------------------------------------------


def _ocr(spark: SparkSession, d: str) -> DataFrame:
    """Two versions of each document: as read, and with odd marks and doubled signs cleaned."""
    t = F.col("text")
    cleaned = F.regexp_replace(F.regexp_replace(t, r"[#$%&*@]+", ""), "!!+", "!")
    both = recognition.by_version(documents(spark, d).select("doc_id", "text"), {"raw": t, "preprocessed": cleaned})
    return recognition.ocr_diagnostics(both, "text", SCRIPT)


def ocr_diagnostics(spark: SparkSession, d: str) -> DataFrame:
    return _ocr(spark, d).drop("text").withColumn("weird_char_share", F.round("weird_char_share", 6))


_OCRC = r"0-9\s\x0b\x1c-\x1f\x{85}\x{a0}.,:;!?()\-—\"«»"
_OCR = rf"""
ver AS (SELECT doc_id, 'raw' AS version, text FROM documents UNION ALL
  SELECT doc_id, 'preprocessed', regexp_replace(regexp_replace(text, '[#$%&*@]+', '', 'g'), '!!+', '!', 'g') FROM documents),
diag AS (SELECT doc_id, version, length(text) AS chars, {_n('text', f'[{LW}]')} AS script_letters, {_n('text', f'[{LW}]{{2,}}')} AS tokens_2plus,
  len(list_distinct(list_transform(regexp_extract_all(text, '[{LW}]{{2,}}'), lambda x: lower(x)))) AS unique_tokens_2plus,
  {_n('text', f'[^{LW}{_OCRC}]')}::DOUBLE / greatest(length(text), 1) AS weird FROM ver)"""
OCR_DIAGNOSTICS = f"""
WITH {_OCR} SELECT doc_id, version, chars, script_letters, tokens_2plus, unique_tokens_2plus, round(weird, 6) AS weird_char_share FROM diag"""


def next_step(spark: SparkSession, d: str) -> DataFrame:
    return recognition.next_step(_ocr(spark, d), "doc_id")


NEXT_STEP = f"""
WITH {_OCR}, b AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY tokens_2plus DESC, weird, version DESC) AS r FROM diag)
SELECT doc_id, version, tokens_2plus, CASE WHEN tokens_2plus < 20 THEN '{recognition.STEP_NEW_SCAN}' WHEN weird > 0.1 THEN '{recognition.STEP_PREPROCESS}'
  ELSE '{recognition.STEP_SAMPLE}' END AS next_human_step FROM b WHERE r = 1"""


def transcript_stats(spark: SparkSession, d: str) -> DataFrame:
    turns = spread(load(spark, d, "conversations"), "conv_id")
    return recognition.transcript_stats(turns, "text", SCRIPT).drop("text")


TRANSCRIPT_STATS = f"""
SELECT conv_id, turn, role, length(text) AS chars, {_n('text', f'[^{SP}]+')} AS tokens, round({_share('text', LW)}, 6) AS script_share,
  round({_share('text', 'A-Za-z')}, 6) AS latin_share FROM conversations"""


def _diagnosed(spark: SparkSession, d: str) -> DataFrame:
    return recognition.text_diagnostics(documents(spark, d).select("doc_id", "text"), "text", tx.LATIN, SCRIPT)


def review_tasks(spark: SparkSession, d: str) -> DataFrame:
    return recognition.review_tasks(_diagnosed(spark, d)).select(
        "doc_id", "chars", "tokens", "script_share", "short_token_share", "weird_char_count", F.array_join("human_tasks", " | ").alias("human_tasks")
    )


_PROSE = r"\s\x0b\x1c-\x1f\x{85}\x{a0}.,:;!?()\-«»\"''/"


def _diag_sql(t: str) -> str:
    short = f"len(list_filter(regexp_extract_all(lower({t}), '[{W}]+'), lambda x: length(x) <= 2))"
    tokens = _n(f"lower({t})", f"[{W}]+")
    return f"""length({t}) AS chars, {tokens} AS tokens,
  coalesce(round({_n(t, '[A-Za-z]')}::DOUBLE / nullif({_n(t, f'[{LW}]')}, 0), 3), 0.0) AS script_share,
  round({short}::DOUBLE / greatest({tokens}, 1), 3) AS short_token_share, {_n(t, f'[^{W}{_PROSE}A-Za-z]')} AS weird_char_count"""


REVIEW_TASKS = f"""
WITH x AS (SELECT doc_id, {_diag_sql('text')} FROM documents)
SELECT *, coalesce(nullif(concat_ws(' | ', CASE WHEN chars < 100 THEN '{recognition.TASK_EMPTY}' END,
  CASE WHEN script_share < 0.7 THEN '{recognition.TASK_SCRIPT}' END, CASE WHEN short_token_share > 0.45 THEN '{recognition.TASK_SHORT}' END), ''),
  '{recognition.TASK_DEFAULT}') AS human_tasks FROM x"""


def control_pages(spark: SparkSession, d: str) -> DataFrame:
    title = F.concat_ws(" ", "source", F.col("doc_id").cast("string"))
    probed = recognition.control_pages(documents(spark, d), title, "text", tx.LATIN, SCRIPT, "https://example.org/wiki/")
    return probed.select("doc_id", "title", "chars", "tokens", "script_share", "url", "extract_preview")


CONTROL_PAGES = f"""
SELECT doc_id, source || ' ' || doc_id AS title, length(text) AS chars, {_n('lower(text)', f'[{W}]+')} AS tokens,
  coalesce(round({_n('text', '[A-Za-z]')}::DOUBLE / nullif({_n('text', f'[{LW}]')}, 0), 3), 0.0) AS script_share,
  'https://example.org/wiki/' || source || '_' || doc_id AS url, substr(text, 1, 400) AS extract_preview FROM documents"""


def control_probe(spark: SparkSession, d: str) -> DataFrame:
    """Diagnostics of all previews pooled into one text."""
    return recognition.pooled_diagnostics(control_pages(spark, d), "doc_id", "extract_preview", tx.LATIN, SCRIPT)


CONTROL_PROBE = f"""
WITH j AS (SELECT string_agg(substr(text, 1, 400), ' ' ORDER BY doc_id) AS text FROM documents)
SELECT {_diag_sql('text')}, substr(text, 1, 700) AS sample FROM j"""


def metadata_gate(spark: SparkSession, d: str) -> DataFrame:
    """Turns as recordings: metadata taken from role, turn and length."""
    turn, role = F.col("turn"), F.col("role")
    rows = load(spark, d, "conversations").select(
        "conv_id", "turn",
        F.col("conv_id").cast("string").alias("speaker_id"),
        F.lit("und").alias("language"),
        F.when(turn != 3, "standard").alias("dialect_or_variety"),
        role.alias("genre"),
        F.lit("phone").alias("device"),
        F.when(F.length("text") < 60, " ").otherwise("indoor").alias("environment"),
        F.when(role == "user", "given").when(role == "assistant", "signed").otherwise("refused").alias("consent_status"),
        F.when(turn < 4, "public").otherwise("closed").alias("publication_level"),
    )
    return recognition.metadata_gate(rows).select("conv_id", "turn", F.array_join("missing_fields", ",").alias("missing_fields"), "publishable")


METADATA_GATE = """
SELECT conv_id, turn, concat_ws(',', CASE WHEN turn = 3 THEN 'dialect_or_variety' END, CASE WHEN length(text) < 60 THEN 'environment' END) AS missing_fields,
  turn <> 3 AND length(text) >= 60 AND role IN ('user', 'assistant') AND turn < 4 AS publishable FROM conversations"""

# ---- packages ------------------------------------------------------------


def _seen(spark: SparkSession, d: str) -> DataFrame:
    return packages.overview(tb.package_files(spark, d))


def package_checks(spark: SparkSession, d: str) -> DataFrame:
    return packages.checks(_seen(spark, d))


_TRIMMED = rf"length(regexp_replace(content, '^[{SP}]+|[{SP}]+$', '', 'g'))"
_CHECKS = f"""
pk AS (SELECT DISTINCT package FROM files),
req AS (SELECT package, unnest(['README.md', 'DATA_CARD.md', 'EVAL_REPORT.md', 'sources.csv']) AS name FROM pk),
rf AS (SELECT r.package, r.name, f.content FROM req r LEFT JOIN files f ON f.package = r.package AND f.name = r.name),
cols AS (SELECT package, unnest(['title', 'url', 'type', 'license_or_access', 'notes']) AS c FROM pk),
hdr AS (SELECT package, string_split(string_split(content, chr(10))[1], ',') AS h FROM files WHERE name = 'sources.csv'),
checks AS (
  SELECT package, name || ' exists' AS check, content IS NOT NULL AS ok, package || '/' || name AS details FROM rf
  UNION ALL SELECT package, name || ' is not empty', {_TRIMMED} > 40, length(content) || ' chars' FROM rf WHERE content IS NOT NULL
  UNION ALL SELECT c.package, 'sources.csv has column ' || c, coalesce(list_contains(h, c), FALSE), '' FROM cols c LEFT JOIN hdr USING (package))"""
PACKAGE_CHECKS = f"WITH {tb.PACKAGES_SQL}, {_CHECKS} SELECT * FROM checks"


def package_tasks(spark: SparkSession, d: str) -> DataFrame:
    seen = _seen(spark, d)
    tasks = packages.publication_tasks(seen, packages.checks(seen))
    return tasks.select("package", "package_ready", F.array_join("tasks_before_publication", " | ").alias("tasks"))


PACKAGE_TASKS = f"""
WITH {tb.PACKAGES_SQL}, {_CHECKS}, g AS (
  SELECT package, bool_and(ok) AS all_ok FROM checks GROUP BY package),
f AS (SELECT package,
    bool_or(name = 'sources.csv' AND text_len > 150 AND text_len <= 200) AS unk,
    bool_or(name = 'README.md' AND contains(lower(content), 'replace')) AS rep,
    bool_or(name = 'DATA_CARD.md' AND (contains(lower(content), 'human review') OR contains(lower(content), 'needs'))) AS rev
  FROM files GROUP BY package),
t AS (SELECT package, concat_ws(' | ', CASE WHEN NOT all_ok THEN '{packages.TASK_FILES}' END, CASE WHEN unk THEN '{packages.TASK_LICENSES}' END,
  CASE WHEN rep THEN '{packages.TASK_PLACEHOLDERS}' END, CASE WHEN rev THEN '{packages.TASK_REVIEW}' END) AS tasks FROM g JOIN f USING (package))
SELECT package, tasks = '' AS package_ready, tasks FROM t"""


def package_status(spark: SparkSession, d: str) -> DataFrame:
    return packages.status_table(_seen(spark, d))


_ART = ", ".join(f"('{a}', '{n}', '{s}')" for a, n, s in packages.ARTIFACTS)
PACKAGE_STATUS = f"""
WITH {tb.PACKAGES_SQL}, art(artifact, name, next_step) AS (VALUES {_ART}), pk AS (SELECT DISTINCT package FROM files)
SELECT pk.package, artifact, next_step, CASE WHEN content IS NOT NULL AND (art.name = 'sources.csv' OR {_TRIMMED} > 40) THEN '{packages.DONE}'
  ELSE '{packages.OPEN}' END AS status
FROM pk CROSS JOIN art LEFT JOIN files f ON f.package = pk.package AND f.name = art.name"""


def package_promises(spark: SparkSession, d: str) -> DataFrame:
    return packages.promises(tb.package_files(spark, d))


PACKAGE_PROMISES = rf"""
WITH {tb.PACKAGES_SQL}, p AS (
  SELECT DISTINCT package, unnest(regexp_extract_all(content, '[A-Za-z0-9_\-]+\.(?:md|csv|tsv|jsonl|json|txt|yaml|py)')) AS name FROM files WHERE name = 'README.md')
SELECT p.package, 'missing file: ' || p.name AS finding FROM p LEFT JOIN files f ON f.package = p.package AND f.name = p.name WHERE f.name IS NULL
UNION ALL SELECT package, 'data card without license' FROM files WHERE name = 'DATA_CARD.md' AND NOT regexp_matches(lower(content), 'license|licence|лиценз')
UNION ALL SELECT package, 'report without test set' FROM files WHERE name = 'EVAL_REPORT.md' AND NOT regexp_matches(lower(content), 'test set|тестов')"""

NAMES = [
    "page_text", "page_links", "download_links", "unwrapped_urls", "url_frontier", "search_errors", "page_candidates", "page_labels",
    "discovery_report", "media_candidates", "corpus_slice", "align_shuffled", "align_best", "align_report", "align_topk",
    "mined_pairs", "segments", "ocr_diagnostics", "next_step", "transcript_stats", "review_tasks", "control_pages",
    "control_probe", "metadata_gate", "package_checks", "package_tasks", "package_status", "package_promises",
]
QUERIES = {n: globals()[n] for n in NAMES}
ORACLES = {n: globals()[n.upper()] for n in NAMES}
