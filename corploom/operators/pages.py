"""Stored pages: visible text, links, rule labels, the URL frontier, the discovery report."""

from __future__ import annotations

import html
from collections.abc import Iterator
from functools import reduce
from operator import add, or_

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corploom.functions import text as tx
from corploom.functions import urls
from corploom.operators import markup

@F.pandas_udf(T.StringType())
def _unescape(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
    for texts in batches:
        yield texts.map(lambda s: None if s is None else html.unescape(s))


def unescape(text: Column) -> Column:
    """Entities of a plain text decoded; only texts that hold an '&' visit Python."""
    return F.coalesce(_unescape(F.when(F.contains(text, F.lit("&")), text)), text)


def visible(parts: Column, max_chars: int | None = None) -> Column:
    """Visible text out of `markup.of(page)`, with single spaces; `max_chars` keeps a leading part (evidence use)."""
    out = tx.normalize_space(parts["text"])
    return F.substring(out, 1, max_chars) if max_chars else out


def page_text(page: Column, max_chars: int | None = None) -> Column:
    return visible(markup.of(page), max_chars)


def _label(link: Column, label_chars: int) -> Column:
    return F.substring(tx.normalize_space(link["label"]), 1, label_chars)


def page_links(pages: DataFrame, key: list[str], url: str, page: str, max_links: int | None = None, label_chars: int = 160) -> DataFrame:
    """(key..., pos, url, label): anchors in order, addresses made absolute."""
    links = markup.of(F.col(page))["links"]
    if max_links:
        links = F.slice(links, 1, max_links)
    rows = pages.select(*key, F.col(url).alias("base"), F.posexplode(links).alias("pos", "a"))
    return rows.select(
        *key,
        (F.col("pos") + 1).alias("pos"),
        urls.resolve(F.col("base"), F.col("a.href")).alias("url"),
        _label(F.col("a"), label_chars).alias("label"),
    )


def links_in_row(parts: Column, base: Column, label_chars: int = 160) -> Column:
    """The links of `markup.of(page)` as array<struct<url, label>>, addresses made absolute."""
    return F.transform(
        parts["links"], lambda a: F.struct(urls.resolve(base, a["href"]).alias("url"), _label(a, label_chars).alias("label"))
    )


def downloads_in_row(links: Column, size: int = 3) -> Column:
    """struct<download_link_count, download_links, probe_target> of the first `size` download links in the row's array."""
    first = F.transform(F.slice(F.filter(links, lambda a: is_download_link(a["url"], a["label"])), 1, size), lambda a: a["url"])
    return tx.let(
        first,
        lambda u: F.struct(
            F.size(u).cast("long").alias("download_link_count"),
            F.array_join(u, "; ").alias("download_links"),
            F.get(u, F.lit(0)).alias("probe_target"),
        ),
    )


# Word lists and file endings of the page rules.
DOWNLOAD_ENDINGS = [
    ".zip", ".tar.gz", ".tgz", ".csv", ".tsv", ".json", ".jsonl", ".txt",
    ".xml", ".conllu", ".parquet", ".xlsx", ".wav", ".mp3",
]
DOWNLOAD_PLACES = ["raw.githubusercontent.com", "/resolve/", "releases/download"]
DATASET_WORDS = [
    "dataset", "corpus", "parallel corpus", "monolingual corpus", "treebank",
    "download", "github", "huggingface", "csv", "jsonl", "conllu", "archive",
    "датасет", "корпус", "параллельный корпус", "скачать", "данные",
]
SOURCE_ONLY_WORDS = [
    "wikipedia", "encyclopedia", "news", "article", "blog", "dictionary only",
    "википедия", "новость", "статья",
]
REVIEW_LINKS = "проверить скачиваемые ссылки и формат"
REVIEW_LICENSE = "проверить лицензию"
REVIEW_NO_LICENSE = "лицензия не найдена автоматически"
REVIEW_SOURCE_ONLY = "не считать источником финальных чисел без ручной проверки"


def _any_of(text: Column, words: list[str]) -> Column:
    return reduce(or_, [F.contains(text, F.lit(w)) for w in words])


def is_download_link(url: Column, label: Column) -> Column:
    u = F.lower(F.coalesce(url, F.lit("")))
    both = F.concat_ws(" ", u, F.lower(F.coalesce(label, F.lit(""))))
    return _any_of(u, DOWNLOAD_ENDINGS + DOWNLOAD_PLACES) | F.contains(both, F.lit("download"))


def download_links(links: DataFrame, key: list[str], size: int = 3) -> DataFrame:
    """First `size` download links per page by position: count, joined list, the one to probe."""
    rank = F.row_number().over(Window.partitionBy(*key).orderBy("pos"))
    kept = links.filter(is_download_link(F.col("url"), F.col("label"))).withColumn("rn", rank).filter(F.col("rn") <= size)
    ordered = F.transform(F.array_sort(F.collect_list(F.struct("rn", "url"))), lambda s: s["url"])
    return kept.groupBy(*key).agg(
        F.count("*").alias("download_link_count"),
        F.array_join(ordered, "; ").alias("download_links"),
        F.try_element_at(ordered, F.lit(1)).alias("probe_target"),
    )


def hits(text: Column, url: Column, words: list[str] | Column) -> Column:
    """How many words occur in the text or in the URL (both lower-cased)."""
    if isinstance(words, list):
        return reduce(add, [(F.contains(text, F.lit(w)) | F.contains(url, F.lit(w))).cast("int") for w in words])
    return tx.let(
        F.struct(text.alias("t"), url.alias("u")),
        lambda p: F.size(F.filter(words, lambda w: F.contains(p["t"], w) | F.contains(p["u"], w))),
    )


def classify(pages: DataFrame, text: str, url: str, names: Column, download_count: str) -> DataFrame:
    """Rule label, confidence and review note. `names` = array of names and codes of the page's language."""
    t, u = F.lower(F.col(text)), F.lower(F.col(url))
    lang_hits = F.coalesce(hits(t, u, F.transform(names, F.lower)), F.lit(0))
    rows = (
        pages.withColumn("lang_hits", lang_hits)
        .withColumn("dataset_hits", hits(t, u, DATASET_WORDS))
        .withColumn("source_only_hits", hits(t, u, SOURCE_ONLY_WORDS))
    )
    has_links = F.coalesce(F.col(download_count), F.lit(0)) > 0
    label = (
        F.when((F.col("dataset_hits") >= 2) & (F.col("lang_hits") > 0), "dataset_candidate")
        .when((F.col("dataset_hits") >= 1) & has_links, "possible_dataset_candidate")
        .when(F.col("source_only_hits") > 0, "source_or_reference_only")
        .otherwise("unclear")
    )
    licensed = F.contains(t, F.lit("license")) | F.contains(t, F.lit("лиценз"))
    note = F.array_compact(
        F.array(
            F.when(has_links, REVIEW_LINKS),
            F.when(licensed, REVIEW_LICENSE).otherwise(REVIEW_NO_LICENSE),
            F.when(F.col("source_only_hits") > 0, REVIEW_SOURCE_ONLY),
        )
    )
    return (
        rows.withColumn("label", label)
        .withColumn("confidence", F.when(F.col("label").isin("dataset_candidate", "source_or_reference_only"), "medium").otherwise("low"))
        .withColumn("dataset_type", F.lit("unknown"))
        .withColumn("evidence", tx.preview(F.col(text), 500))
        .withColumn("needs_human_review", F.lit(True))
        .withColumn("human_review_note", F.array_join(note, "; "))
        .withColumn("mode", F.lit("heuristic"))
    )


def frontier(results: DataFrame, run: str, queries: int = 4, per_query: int = 4, pages: int = 10) -> DataFrame:
    """Addresses to open per run: first results of the first queries, each address once, at most `pages`.

    `results` has run, query_no and rank (both from 0), url, error. Error rows and rows without an
    address use their place in the answer but are not opened. Caps come first, so each
    run holds at most queries x per_query rows when it reaches a window.
    """
    capped = results.filter((F.col("query_no") < queries) & (F.col("rank") < per_query))
    usable = capped.filter(F.col("error").isNull() & (F.coalesce("url", F.lit("")) != ""))
    order = ["query_no", "rank"]
    first = F.row_number().over(Window.partitionBy(run, "url").orderBy(*order))
    slot = F.row_number().over(Window.partitionBy(run).orderBy(*order))
    return usable.withColumn("nth", first).filter("nth = 1").drop("nth").withColumn("slot", slot).filter(F.col("slot") <= pages)


def discovery_report(results: DataFrame, opened: DataFrame, candidates: DataFrame, run: str) -> DataFrame:
    """One row per run: queries, results, pages opened, candidates, useful ones, probes, errors."""
    a = results.groupBy(run).agg(
        F.count_distinct("query_no").alias("queries"), F.count("*").alias("search_results")
    )
    b = opened.groupBy(run).agg(
        F.count("*").alias("pages_opened"), F.count_if(F.col("status") == "error").alias("errors")
    )
    useful = F.col("label").isin("dataset_candidate", "possible_dataset_candidate")
    c = candidates.groupBy(run).agg(
        F.count("*").alias("candidates_total"),
        F.count_if(useful).alias("dataset_candidates"),
        F.count_if(F.coalesce("download_link_count", F.lit(0)) > 0).alias("download_probes"),
    )
    joined = a.join(b, run, "full_outer").join(c, run, "full_outer")
    numbers = [x for x in joined.columns if x != run]
    return joined.select(run, *[F.coalesce(n, F.lit(0)).alias(n) for n in numbers])


# ---- media candidates ----------------------------------------------------

# Image types that can be opened as a raster.
RASTER_TYPES = ["image/jpeg", "image/png", "image/tiff", "image/webp"]
MEDIA_SCHEMA = (
    "title string, imageinfo array<struct<url: string, mime: string, width: int, height: int, "
    "extmetadata: struct<LicenseShortName: struct<value: string>, Artist: struct<value: string>, "
    "ImageDescription: struct<value: string>>>>"
)


def media_fields(answers: DataFrame, raw: str, *keep: str) -> DataFrame:
    """Flat media rows out of landed JSON answers."""
    info = F.try_element_at("m.imageinfo", F.lit(1))
    meta = info["extmetadata"]
    return answers.withColumn("m", F.from_json(F.col(raw), MEDIA_SCHEMA)).select(
        *keep,
        F.col("m.title").alias("title"),
        info["url"].alias("url"),
        info["mime"].alias("mime"),
        info["width"].alias("width"),
        info["height"].alias("height"),
        meta["LicenseShortName"]["value"].alias("license"),
        meta["Artist"]["value"].alias("artist"),
        meta["ImageDescription"]["value"].alias("description"),
    )


def is_raster(url: Column, mime: Column) -> Column:
    return (F.coalesce(url, F.lit("")) != "") & F.coalesce(mime, F.lit("")).isin(*RASTER_TYPES)


def first_raster(media: DataFrame, group: str, pos: str, fallback: str) -> DataFrame:
    """First raster per group by position; a group without one gets the fallback title."""
    fields = [c for c in media.columns if c not in (group, pos)]
    raster = is_raster(F.col("url"), F.col("mime"))
    best = media.groupBy(group).agg(F.min_by(F.struct(*fields), F.when(raster, F.col(pos))).alias("best"), F.count_if(raster).alias("n"))
    picked = F.when(F.col("n") > 0, F.col("best"))
    return best.select(
        group,
        F.coalesce(picked["title"], F.lit(fallback)).alias("title"),
        *[picked[f].alias(f) for f in fields if f != "title"],
        (F.col("n") == 0).alias("is_fallback"),
    )
