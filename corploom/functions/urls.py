"""URL helpers as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# API and page addresses that appear in result rows.
CORPORA_API = "https://opus.nlpl.eu/opusapi"
CORPORA_PAGES = "https://opus.nlpl.eu/datasets"
CATALOGUE_PAGES = "https://huggingface.co/datasets"
CATALOGUE_API = "https://huggingface.co/api/datasets"

_PARTS = r"^(?:([A-Za-z][A-Za-z0-9+.\-]*):)?(//[^/?#]*)?([^?#]*)(\?[^#]*)?(#.*)?$"


def quote(text: Column) -> Column:
    """Percent-encoding that keeps '/' and leaves no '+': the form encoder's output, put right."""
    out = F.url_encode(text)
    for coded, plain in (("+", "%20"), ("%2F", "/"), ("%7E", "~"), ("*", "%2A")):
        out = F.replace(out, F.lit(coded), F.lit(plain))
    return out


def title_url(base: str, title: Column) -> Column:
    return F.concat(F.lit(base), quote(F.replace(title, F.lit(" "), F.lit("_"))))


def pair_page_url(source: Column, target: Column, corpus: Column) -> Column:
    return F.concat(
        F.lit(CORPORA_PAGES + "/"), corpus, F.lit("?hi="), source, F.lit("&pair="), target
    )


def pair_api_url(source: Column, target: Column) -> Column:
    return F.concat(
        F.lit(CORPORA_API + "?source="),
        source,
        F.lit("&target="),
        target,
        F.lit("&preprocessing=xml&version=latest"),
    )


def catalogue_page_url(dataset_id: Column) -> Column:
    return F.concat(F.lit(CATALOGUE_PAGES + "/"), dataset_id)


def catalogue_api_url(dataset_id: Column) -> Column:
    return F.concat(F.lit(CATALOGUE_API + "/"), dataset_id)


def _decode(value: Column, plus_is_space: bool) -> Column:
    # url_decode rejects a '%' without two hex digits; such marks stay as they are.
    value = F.regexp_replace(value, "%(?![0-9A-Fa-f]{2})", "%25")
    if not plus_is_space:
        value = F.replace(value, F.lit("+"), F.lit("%2B"))
    return F.url_decode(value)


def unwrap_redirect(href: Column, host: str = "duckduckgo.com", path: str = "/l/", key: str = "uddg") -> Column:
    """The target held in a search redirect link; other links pass, null becomes ''."""
    on_host = F.contains(F.regexp_extract(href, _PARTS, 2), F.lit(host))
    on_path = F.startswith(F.regexp_extract(href, _PARTS, 3), F.lit(path))
    raw = F.regexp_extract(F.regexp_extract(href, _PARTS, 4), rf"[?&]{key}=([^&]*)", 1)
    target = _decode(_decode(raw, True), False)
    return F.when(F.coalesce(href, F.lit("")) == "", F.lit("")).when(on_host & on_path, target).otherwise(href)


def host_of(url: Column) -> Column:
    return F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.\-]*://([^/?#]*)", 1))


def _without_dots(path: Column) -> Column:
    """Resolve '.' and '..' segments of an absolute path."""
    segments = F.split(path, "/")
    last = F.element_at(segments, -1)
    inner = F.slice(segments, F.lit(2), F.greatest(F.size(segments) - 1, F.lit(0)))
    kept = F.aggregate(
        inner,
        F.array().cast("array<string>"),
        lambda acc, s: F.when(s == "..", F.slice(acc, F.lit(1), F.greatest(F.size(acc) - 1, F.lit(0))))
        .when(s == ".", acc)
        .otherwise(F.concat(acc, F.array(s))),
    )
    tail = F.when(last.isin(".", ".."), F.lit("/")).otherwise(F.lit(""))
    joined = F.concat(F.lit("/"), F.array_join(kept, "/"))
    return F.when(F.endswith(joined, F.lit("/")), joined).otherwise(F.concat(joined, tail))


def resolve(base: Column, href: Column) -> Column:
    """Absolute form of a link found on a page with http(s) address `base`."""
    b = [F.regexp_extract(base, _PARTS, i) for i in range(6)]
    r = [F.regexp_extract(href, _PARTS, i) for i in range(6)]
    site = F.concat(b[1], F.lit(":"), b[2])
    base_path = F.when(b[3] == "", F.lit("/")).otherwise(b[3])
    folder = F.regexp_replace(base_path, "[^/]*$", "")
    has_dots = F.rlike(href, F.lit(r"(^|/)\.\.?(/|$|[?#])"))
    rooted = F.when(F.startswith(r[3], F.lit("/")), r[3]).otherwise(F.concat(folder, r[3]))
    path = F.when(has_dots, _without_dots(rooted)).otherwise(rooted)
    return (
        F.when(href == "", base)
        .when((r[1] != "") & ~F.lower(r[1]).isin("http", "https"), href)
        .when(r[1] != "", href)
        .when(r[2] != "", F.concat(b[1], F.lit(":"), href))
        .when((r[3] == "") & (r[4] == ""), F.concat(site, b[3], b[4], r[5]))
        .when(r[3] == "", F.concat(site, b[3], r[4], r[5]))
        .otherwise(F.concat(site, path, r[4], r[5]))
    )
