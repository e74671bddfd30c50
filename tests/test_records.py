"""Aligned lines, CSV records, suggestions, decisions, names and run histories against brute force."""

import csv
import io
import random
import time
from functools import cache

import pytest
from pyspark.sql import functions as F

from corploom.functions import text as tx
from corploom.operators import catalog, decisions, lines, packages, snapshots, spell, suggest


def frame(spark, rows, schema):
    return spark.createDataFrame(rows, schema)


# ---- aligned lines -------------------------------------------------------------


def cheapest(h, r):
    """Least cost of any monotone alignment, by trying every step everywhere."""

    @cache
    def rest(i, j):
        if i == len(h) and j == len(r):
            return 0
        ways = [(a, b) for a, b in lines.STEPS if i + a <= len(h) and j + b <= len(r)]
        return min(lines.cost(h[i : i + a], r[j : j + b]) + rest(i + a, j + b) for a, b in ways)

    return rest(0, 0)


def test_alignment_is_cheapest_between_fixed_lines():
    r = random.Random(3)
    make = lambda: [" ".join(r.choice(["ab", "abc", "b c", "dd", ""]) for _ in range(r.randint(0, 3))) for _ in range(r.randint(0, 6))]
    for _ in range(300):
        a, b = make(), make()
        steps = lines._block(a, b)
        i = j = total = 0
        for m, n in steps:
            total += lines.cost(a[i : i + m], b[j : j + n])
            i, j = i + m, j + n
        assert (i, j) == (len(a), len(b)) and total == cheapest(tuple(a), tuple(b))
        blocks = lines.align(a, b)
        assert [x for h, _ in blocks for x in h] == a and [x for _, c in blocks for x in c] == b


def test_joined_and_dropped_lines_shift_nothing(spark):
    reference = "the first line\nan exam-\nple of joining\nthe third line\nonly here\nthe last line"
    hypothesis = "the first 1ine\nan example of joining\nthe third line\nthe last line\n???"
    df = frame(spark, [(1, hypothesis, reference), (2, None, "a"), (3, None, None), (4, "", ""), (5, "a", "")], "id int, h string, r string")
    rows = lines.aligned_lines(df, "h", "r", "id").orderBy("id", "line_id").collect()
    assert [(x["kind"], x["recognized_text"], x["correct_text"]) for x in rows if x["id"] == 1] == [
        ("match", "the first 1ine", "the first line"),
        ("joined", "an example of joining", "an exam- ple of joining"),
        ("match", "the third line", "the third line"),
        ("missing", "", "only here"),
        ("match", "the last line", "the last line"),
        ("surplus", "???", ""),
    ]
    assert [(x["id"], x["kind"]) for x in rows if x["id"] > 1] == [(2, "missing"), (4, "match"), (5, "match")]
    rates = lines.alignment_rates(lines.aligned_lines(df, "h", "r", "id"), "id").filter("id = 1").first()
    assert [rates[f"{k}_lines"] for k in ("match", "joined", "split", "missing", "surplus")] == [3, 1, 0, 1, 1]
    assert lines.aligned_lines(df.limit(0), "h", "r", "id").collect() == []


def test_long_similar_texts_are_aligned_between_fixed_lines():
    r = random.Random(5)
    reference = [f"line {i} {r.random()}" for i in range(6000)]
    hypothesis = [x if i % 50 else x.replace("line", "1ine") for i, x in enumerate(reference) if i % 97]
    begin = time.perf_counter()
    blocks = lines.align(hypothesis, reference)
    assert time.perf_counter() - begin < 30
    kinds = [lines._kind(a, b) for a, b in blocks]
    # A changed line beside a dropped one may be taken for the join of both.
    assert 0 <= len(reference) - len(hypothesis) - kinds.count("missing") <= 2 and kinds.count("match") >= len(hypothesis) - 2


# ---- CSV records ------------------------------------------------------------------


def test_csv_records_agree_with_the_standard_reader(spark):
    r = random.Random(1)
    rows = []
    for i in range(200):
        table = [[r.choice(["a", "b,c", 'say "x"', "two\nlines", "", " s ", '"', '""', ","]) for _ in range(r.randint(2, 4))] for _ in range(r.randint(1, 4))]
        out = io.StringIO()
        csv.writer(out, lineterminator=r.choice(["\n", "\r\n"]), quoting=r.choice([csv.QUOTE_MINIMAL, csv.QUOTE_ALL])).writerows(table)
        rows.append((i, out.getvalue().rstrip("\r\n"), table))
    rows = [x for x in rows if list(csv.reader(io.StringIO(x[1]))) == x[2]]
    got = {x["i"]: x["c"] for x in frame(spark, [(i, t) for i, t, _ in rows], "i int, t string").select("i", packages.csv_records(F.col("t")).alias("c")).collect()}
    assert len(rows) > 150
    for i, text, table in rows:
        assert got[i] == [[c.strip(" ") for c in row] for row in table], text


def test_csv_records_of_long_null_and_open_quotes(spark):
    df = frame(spark, [(1, None), (2, ""), (3, 'a,"b\nc'), (4, ('"' + "x," * 500_000 + '",' + "y," * 200_000))], "i int, t string")
    begin = time.perf_counter()
    got = {x["i"]: x["c"] for x in df.select("i", packages.csv_records(F.col("t")).alias("c")).collect()}
    assert time.perf_counter() - begin < 60
    assert (got[1], got[2], got[3]) == (None, [[""]], [["a", "b\nc"]])
    assert len(got[4]) == 1 and len(got[4][0]) == 200_002 and len(got[4][0][0]) == 1_000_000


def test_quoted_line_break_in_the_list_of_sources(spark):
    text = 'title,url,type,license_or_access,notes\n"A\nB",u,t,"cc, by","unknown\nspeaker"\nC,u,t,ok,n'
    files = frame(spark, [("p", "sources.csv", text), ("q", "sources.csv", text.replace('"cc, by"', "Unknown"))], "package string, name string, content string")
    got = {x["package"]: x for x in packages.overview(files).collect()}
    assert got["p"]["columns"] == packages.SOURCE_COLUMNS and not got["p"]["unknown_license"]
    assert got["q"]["unknown_license"]


# ---- suggestions ------------------------------------------------------------------


def edits(a, b):
    """Edits with swaps of neighbours."""
    d = {(i, 0): i for i in range(len(a) + 1)} | {(0, j): j for j in range(len(b) + 1)}
    for i in range(1, len(a) + 1):
        for j in range(1, len(b) + 1):
            d[i, j] = min(d[i - 1, j] + 1, d[i, j - 1] + 1, d[i - 1, j - 1] + (a[i - 1] != b[j - 1]))
            if i > 1 and j > 1 and a[i - 1] == b[j - 2] and a[i - 2] == b[j - 1]:
                d[i, j] = min(d[i, j], d[i - 2, j - 2] + 1)
    return d[len(a), len(b)]


def common(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        new = [0]
        for j, y in enumerate(b):
            new.append(row[j] + 1 if x == y else max(row[j + 1], new[j]))
        row = new
    return row[-1]


def test_common_length_by_brute_force():
    r = random.Random(8)
    for _ in range(500):
        a, b = ("".join(r.choice("abcж") for _ in range(r.randint(0, 90))) for _ in range(2))
        assert suggest.common_length(a, b) == common(a, b)


@pytest.mark.parametrize("scorer", ["distance", "ratio"])
def test_suggestions_by_brute_force(spark, scorer):
    r = random.Random(6)
    vocab = {"".join(r.choice("abcдж") for _ in range(r.randint(2, 6))): r.randint(1, 9) for _ in range(200)}
    asked = ["".join(r.choice("abcдж") for _ in range(r.randint(1, 7))) for _ in range(80)] + ["", "a" * 100_000]
    found = suggest.suggestions(frame(spark, [(a,) for a in asked + asked[:5]] + [(None,)], "word string"), frame(spark, list(vocab.items()), "word string, count bigint"), 3, scorer)
    got = {x["word"]: [tuple(b) for b in x["best"]] for x in found.collect()}
    for a in asked:
        near = [(edits(a, v), v, n) for v, n in vocab.items() if abs(len(a) - len(v)) < 2 and edits(a, v) <= 1]
        ratio = lambda v, a=a: round(200 * common(a, v) / (len(a) + len(v)), 4)
        if scorer == "ratio":
            want = [(d, ratio(v), n, v) for d, v, n in sorted(near, key=lambda x: (-ratio(x[1]), x[0], -x[2], x[1]))[:3]]
        else:
            want = [(d, None, n, v) for d, v, n in sorted(near, key=lambda x: (x[0], -x[2], x[1]))[:3]]
        assert got.get(a, []) == want
    assert None not in got


def test_a_swap_is_one_edit(spark):
    vocab = frame(spark, [("form", 5), ("farm", 9)], "word string, count bigint")
    (row,) = suggest.suggestions(frame(spark, [("from",)], "word string"), vocab).collect()
    assert [(b["candidate"], b["d"]) for b in row["best"]] == [("form", 1)]


# ---- decisions ---------------------------------------------------------------------


def test_decisions_by_replay(spark):
    r = random.Random(2)
    words = [f"w{i}" for i in range(30)]
    events = [(seq, r.choice(words), r.choice("xyz"), r.choice(["accept", "reject"]), r.randint(0, 12)) for seq in range(80)] + [(99, None, "x", "accept", 1), (98, "w1", "x", "maybe", 50), (97, "other", "x", "accept", 1)]
    got = {x["word"]: x for x in decisions.decided(frame(spark, [(w, 7, "old") for w in [*words, "none"]], "word string, count int, decision string"), frame(spark, events, decisions.EVENT)).collect()}
    for w in [*words, "none"]:
        own = sorted((e for e in events if e[1] == w and e[3] in ("accept", "reject")), key=lambda e: (e[4], e[0]))
        x = got[w]
        assert x["events"] == len(own) and x["count"] == 7
        if not own:
            assert (x["decision"], x["form"], x["overruled"], x["late"]) == ("pending", w, False, False)
            continue
        last = own[-1]
        assert x["decision"] == {"accept": "accepted", "reject": "rejected"}[last[3]]
        assert x["form"] == (last[2] if last[3] == "accept" else w)
        assert x["overruled"] == (len({(e[3], e[2]) for e in own}) > 1)
        assert x["late"] == (max(own)[4] < last[4])
    assert "other" not in got


# ---- names ----------------------------------------------------------------------------


def test_names_by_capitals_inside_sentences(spark):
    text = "Then we met Anna there. Anna said that the Volga is long. The river Volga, says Anna. then THE end"
    docs = frame(spark, [(1, text), (2, None), (3, "")], "id int, text string")
    shares = spell.name_shares(docs, "text", tx.LATIN)
    listed = frame(spark, [(w, "") for w in ("anna", "volga", "the", "then")] + [("absent", "too few sources")], "word string, notes string")
    got = {x["word"]: x for x in spell.with_names(listed, shares).collect()}
    assert {w for w, x in got.items() if x["name"]} == {"anna", "volga"}
    assert got["anna"]["notes"] == spell.NAME_NOTE and got["anna"]["name_share"] == 1.0
    assert (got["absent"]["notes"], got["absent"]["name_share"], got["the"]["name_share"]) == ("too few sources", None, 0.5)


# ---- inventory over runs -----------------------------------------------------------------


def test_runs_as_they_were_known(spark):
    rows = [
        ("a", "c", 1, True, None, 5), ("a", "c", 2, False, "timeout", None), ("a", "c", 3, False, "timeout", 9), ("a", "c", 4, True, "old", 8),
        ("b", "c", 1, False, "timeout", None), ("b", "c", 2, True, None, 3), ("n", None, 1, False, None, None), ("n", None, 2, False, None, 4),
    ]
    got = snapshots.as_of(frame(spark, rows, "k string, code string, run int, checked boolean, error string, pairs bigint"), "k", "run", "checked", "code", "error", ["pairs"])
    found = {(x["k"], x["run"]): (x["error"], x["pairs"], x["from_run"], x["cached_from_previous_run"]) for x in got.collect()}
    assert found == {
        ("a", 1): ("", 5, 1, False), ("a", 2): ("timeout", 5, 1, True), ("a", 3): ("timeout", 5, 1, True), ("a", 4): ("", 8, 4, False),
        ("b", 1): ("timeout", 0, None, False), ("b", 2): ("", 3, 2, False), ("n", 1): ("", 0, None, False), ("n", 2): ("", 0, None, False),
    }


def test_decision_records_and_unparsable_numbers(spark):
    answers = spark.createDataFrame(
        [(1, '{"dataset_id": "a/b", "label": "parallel_corpus"}'), (2, "no json"), (3, '{"dataset_id": "", "label": "x"}'), (None, "")],
        "doc_id long, raw string",
    )
    rows = catalog.decision_records(catalog.parse_decisions(answers, "raw", "doc_id"), "llm").collect()
    assert {r["mode"] for r in rows} == {"llm"}
    assert [(r["dataset_id"], r["label"], r["url"].split("/datasets/")[-1]) for r in rows] == [
        ("a/b", "parallel_corpus", "a/b"), ("2", "llm_unparsed", "2"), ("", "x", ""), (None, "llm_unparsed", ""),
    ]
    table = [(1, "12", " -3 "), (2, "", None), (3, "1.5", "9" * 30), (4, "12 k", "0"), (None, "x", "x")]
    found = catalog.unparsable_numbers(spark.createDataFrame(table, "k long, a string, b string"), "k", "a", "b").collect()
    assert sorted(map(tuple, found), key=str) == sorted(
        [(3, "a", "1.5"), (3, "b", "9" * 30), (4, "a", "12 k"), (None, "a", "x"), (None, "b", "x")], key=str
    )
    assert catalog.unparsable_numbers(spark.createDataFrame([], "k long, a string"), "k", "a").count() == 0
