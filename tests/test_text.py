"""Column builders against plain Python on Cyrillic and awkward text."""

import html
import time
import unicodedata
from urllib.parse import quote, urljoin


from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from corploom.functions import text as tx
from corploom.functions import urls
from corploom.operators import pages, quality

SAMPLES = [
    "", " ", "Ӟеч лык, удмурт кыл!", "a\u001cb\tc\r\nd e\n\n  \n f", "Ёлка и ӧ 12_3 x", "слово-слово ́ é", "!!! ???",
    "\u0085x\x0by", "один  два\nтри", "ӝӟӥ Latin мешан текст", "😀 ӝ",
]


def run(spark, samples, **columns):
    rows = [(i, s) for i, s in enumerate(samples)]
    df = spark.createDataFrame(rows, "i int, t string")
    return [r.asDict() for r in df.select("i", "t", *[c.alias(n) for n, c in columns.items()]).orderBy("i").collect()]


LINE_ENDS = set("\n\r\x0b\x0c\x1c\x1d\x1e\x85\u2028\u2029")
SIGNS = set(".,:;!?()-—\"«»0123456789")


def expected(s):
    """The measures from one walk over the characters, by Unicode category."""
    script = [c in "Ёё" or "А" <= c <= "я" or "Ӑ" <= c <= "ӿ" for c in s]
    word = [unicodedata.category(c)[0] in "LN" or c == "_" for c in s]
    blank = [c.isspace() for c in s]

    def runs(flags):
        out, run = [], ""
        for c, inside in [*zip(s, flags, strict=True), ("", False)]:
            if inside:
                run += c
            elif run:
                out.append(run)
                run = ""
        return out

    two = [w for w in runs(script) if len(w) > 1]
    words, lines, inked = runs(word), 0, False
    for c, space in [*zip(s, blank, strict=True), ("\n", True)]:
        if c in LINE_ENDS:
            lines += inked
            inked = False
        else:
            inked |= not space
    n = max(len(s), 1)
    return {
        "norm": " ".join(runs([not b for b in blank])),
        "tokens": len(words),
        "ws": len(runs([not b for b in blank])),
        "share": sum(script) / n,
        "lines": lines,
        "two": len(two),
        "unique": len({w.lower() for w in two}),
        "weird": sum(not (a or b or c in SIGNS) for a, b, c in zip(script, blank, s, strict=True)) / n,
        "short": sum(len(w.lower()) <= 2 for w in words),
    }


def columns():
    t = F.col("t")
    two = tx.script_tokens(t, tx.CYRILLIC)
    return {
        "norm": tx.normalize_space(t),
        "tokens": tx.token_count(t),
        "ws": tx.whitespace_token_count(t),
        "share": tx.char_share(t, tx.CYRILLIC),
        "lines": tx.line_count(t),
        "two": F.size(two),
        "unique": tx.unique_lower_count(two),
        "weird": tx.outside_share(t, tx.CYRILLIC + tx.OCR_PUNCTUATION),
        "short": tx.short_token_count(t),
    }


def test_features_match_python(spark):
    for row in run(spark, SAMPLES, **columns()):
        want = expected(row["t"])
        assert all(row[k] == want[k] for k in want), (row, want)


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.text(alphabet="абвЁӝabZ09_ .,!-\n\t\r \u001d «»é", max_size=40), min_size=20, max_size=40))
def test_features_match_python_on_random_text(spark, texts):
    for row in run(spark, texts, **columns()):
        want = expected(row["t"])
        assert all(row[k] == want[k] for k in want), (row, want)


def test_letter_share_and_as_int(spark):
    rows = run(spark, ["abв", "123", "ӝӟ"], s=tx.letter_share(F.col("t"), tx.CYRILLIC_EXTENDED, "A-Za-z" + tx.CYRILLIC_EXTENDED))
    assert [r["s"] for r in rows] == [0.333, 0.0, 1.0]
    rows = run(spark, ["", "12", "x"], n=tx.as_int(F.col("t")))
    assert [r["n"] for r in rows] == [0, 12, None]


def test_word_ngrams(spark):
    rows = run(spark, ["Раз два, три четыре", "раз"], g=tx.word_ngrams(F.col("t"), 3))
    assert [r["g"] for r in rows] == [["раз два три", "два три четыре"], []]


def test_quote_and_resolve(spark):
    titles = ["Удмурт кыл", "a/b (c)*~", "x+y&z=1"]
    assert [r["q"] for r in run(spark, titles, q=urls.quote(F.col("t")))] == [quote(t) for t in titles]
    base = "https://example.org/a/b/c.html?x=1#top"
    links = ["/root", "rel.html", "../up", "./same/", "../../far", "?q=2", "#frag", "//other.org/p", "https://z.org/", "mailto:a@b.c", "", "d/../e"]
    rows = run(spark, links, u=urls.resolve(F.lit(base), F.col("t")))
    assert [r["u"] for r in rows] == [urljoin(base, x) for x in links]


def test_unwrap_redirect(spark):
    links = [
        "//duckduckgo.com/l/?uddg=https%3A%2F%2Fa.org%2Fx%3Fy%3D1%2B2&rut=9", "https://duckduckgo.com/l/?rut=9",
        "https://a.org/l/?uddg=zzz", "", "https://duckduckgo.com/about",
    ]
    rows = run(spark, links, u=urls.unwrap_redirect(F.col("t")))
    assert [r["u"] for r in rows] == ["https://a.org/x?y=1+2", "", "https://a.org/l/?uddg=zzz", "", "https://duckduckgo.com/about"]


def test_unicode_and_entities(spark):
    texts = ["é it’s a‑b", "plain"]
    assert [r["u"] for r in run(spark, texts, u=quality.unify_unicode(F.col("t")))] == ["é it's a-b", "plain"]
    texts = ["&lt;b&gt; &amp;lt; &#1073;&nbsp;&copy;", "none", None]
    want = [None if t is None else html.unescape(t) for t in texts]
    assert [r["u"] for r in run(spark, texts, u=pages.unescape(F.col("t")))] == want


def test_sentences_lose_no_digits_that_name_their_place(spark):
    rows = run(spark, ["0 a.  1 b 1. 22 c\n 3 d 3 ", "00", None], s=tx.sentences(F.col("t")))
    assert [r["s"] for r in rows] == [["0 a.", "1 b 1.", "22 c", "3 d 3"], ["00"], None]


def test_class_and_line_counts_cost_about_what_a_plain_scan_does(spark):
    """A negated class of several ranges took some eight times as long."""
    df = spark.range(0, 64, 1, 8).select(F.repeat(F.lit("Déjà vu, un mot et l'autre.\n"), 20000).alias("t")).localCheckpoint()
    t = F.col("t")

    def seconds(c):
        runs = []
        for _ in range(3):
            start = time.perf_counter()
            df.agg(F.sum(c)).collect()
            runs.append(time.perf_counter() - start)
        return min(runs)

    plain = seconds(F.length(tx.normalize_space(t)))
    assert seconds(tx.class_count(t, tx.LATIN_WIDE)) < 3 * plain
    assert seconds(tx.line_count(t)) < 3 * plain


def test_line_count_at_every_kind_of_break(spark):
    breaks = ["\n", "\r", "\r\n", "\x0b", "\x0c", "\x1c", "\x1d", "\x1e", "\x85", "\u2028", "\u2029"]
    inside = ["\t", "\x1f", "\x84", "\x86", "\u2027", "\u202a", "\uffff", "\U0001f600", "\U0010ffff"]
    rows = run(spark, [f"a{x}b" for x in breaks + inside], n=tx.line_count(F.col("t")), c=tx.class_count(F.col("t"), tx.LATIN_WIDE))
    assert [r["n"] for r in rows] == [2] * len(breaks) + [1] * len(inside)
    assert [r["c"] for r in rows] == [2] * len(rows)
