"""Operators on small fixtures, and brute-force checks where an index or a split join does the work."""

import collections
import itertools
import math
import random
import time

import numpy as np
import pandas as pd
import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from corploom.functions import text as tx
from corploom.operators import (
    align, catalog, components, dedup, langid, lookup, metrics, packages, pages, quality, recognition, snapshots, spell, split,
)
from corploom.plans import spelling
from corploom.sources import files, landed, seed


def frame(spark, rows, schema):
    return spark.createDataFrame(rows, schema)


# ---- copies, splits ------------------------------------------------------


def test_planted_duplicate_fires_once(spark):
    rows = [(1, "а б"), (2, "в"), (3, "а  б"), (4, "а б")]
    out = dedup.flag_exact(frame(spark, rows, "id bigint, t string"), F.col("t"), "id").orderBy("id").collect()
    assert [r["duplicate"] for r in out] == [False, False, False, True]
    again = dedup.flag_exact(frame(spark, [r[:2] for r in out if not r["duplicate"]], "id bigint, t string"), F.col("t"), "id")
    assert again.filter("duplicate").count() == 0


def test_hot_text_is_flagged_whole(spark):
    df = spark.range(3000).select("id", F.when(F.col("id") % 3 == 0, "same").otherwise(F.col("id").cast("string")).alias("t"))
    assert dedup.flag_exact(df, F.col("t"), "id").filter("duplicate").count() == 999


def test_split_sizes(spark):
    wanted = {1: (0, 0, 1), 2: (1, 0, 1), 4: (3, 0, 1), 5: (4, 0, 1), 6: (4, 1, 1), 9: (7, 1, 1), 10: (8, 1, 1), 11: (8, 1, 2), 19: (15, 2, 2), 20: (16, 2, 2)}
    for n, sizes in wanted.items():
        got = {r["split"]: r["count"] for r in split.exact_split(spark.range(n), "id").groupBy("split").count().collect()}
        assert tuple(got.get(s, 0) for s in split.NAMES) == sizes, n


def test_exact_split_is_by_hash_order(spark):
    rows = split.exact_split(spark.range(5000), "id").withColumn("h", tx.seeded_md5("id", seed=42)).orderBy("h").collect()
    assert [r["split"] for r in rows] == ["train"] * 4000 + ["dev"] * 500 + ["test"] * 500


def test_split_by_text_does_not_leak(spark):
    df = frame(spark, [(i, f"t{i % 7}") for i in range(60)], "id bigint, t string")
    assert split.leaks(df.withColumn("split", split.threshold_split(tx.text_hash(F.col("t")))), F.col("t")).count() == 0
    assert split.leaks(df.withColumn("split", split.threshold_split("id")), F.col("t")).count() > 0


def test_components_against_brute_force(spark):
    rng = np.random.default_rng(5)
    links = [(int(a), f"k{b}") for a, b in zip(rng.integers(0, 120, 150), rng.integers(0, 110, 150))] + [(i, f"c{j}") for i in range(200, 230) for j in (i, i + 1)]
    parent = {a: a for a, _ in links}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    by_key = {}
    for a, k in links:
        by_key.setdefault(k, []).append(a)
    for members in by_key.values():
        for m in members[1:]:
            x, y = sorted((find(members[0]), find(m)))
            parent[y] = x
    got = components.connected(frame(spark, links, "id bigint, k string"), "id", "k").collect()
    assert {r["id"]: r["label"] for r in got} == {a: find(a) for a in parent}


def test_near_duplicates_find_an_edited_copy(spark):
    words = [f"w{i}" for i in range(300)]
    edited = words[:150] + ["changed"] + words[151:]
    rows = [(1, " ".join(words), "a"), (2, " ".join(edited), "b"), (3, " ".join(f"z{i}" for i in range(300)), "c"), (4, " ".join(words).upper(), "d")]
    got = dedup.near_duplicates(frame(spark, rows, "id bigint, t string, s string"), "t", "id", "s", bands=16, rows=4, width=3)
    assert {(r["id"], r["removed"], r["removed_by"], r["removed_source"]) for r in got.collect()} == {(1, False, 1, "a"), (2, True, 1, "a"), (4, True, 1, "a")}


def test_lookup_equals_left_join_with_a_hot_key(spark):
    big = spark.range(4000).select("id", F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("k"), (F.col("id") % 900).cast("string"))).alias("k"))
    small = big.groupBy("k").agg(F.count("*").alias("n")).filter("n > 3").withColumn("v", F.length("k"))
    for limit in (0, 10_000):
        got = {tuple(r) for r in lookup.lookup(big, small, "k", F.col("id"), "n", shares=10, broadcast_rows=limit).collect()}
        assert got == {tuple(r) for r in big.join(small.drop("n"), "k", "left").select("id", "k", "v").collect()}
        kept = lookup.join_keyed(big, small.select("k"), "k", F.col("id"), "left_semi", broadcast_rows=limit)
        assert kept.count() == big.join(small, "k", "left_semi").count()


def test_boilerplate_lines_go(spark):
    rows = [(i, f"menu\nunique {i}\n") for i in range(5)]
    got = dedup.drop_boilerplate(frame(spark, rows, "id bigint, t string"), "t", "id", at_least=5).collect()
    assert {(r["text_kept"], r["lines_dropped"]) for r in got} == {(f"unique {i}", 1) for i in range(5)}


def test_quality_filter_bounds(spark):
    rows = [(1, "я" * 200), (2, "я" * 199), (3, "я" * 90 + "x" * 110), (4, "я" * 91 + "x" * 109)]
    raw = quality.raw_corpus(frame(spark, rows, "id bigint, t string"), "t", tx.CYRILLIC)
    assert {r["id"] for r in quality.filtered_corpus(raw, "t", "id").collect()} == {1, 4}
    rows = [(1, "я" * 135 + "x" * 165), (2, "я" * 134 + "x" * 166), (3, "я" * 135 + "x" * 165)]
    kept = quality.clean_corpus(frame(spark, rows, "id bigint, t string"), "t", "id", tx.CYRILLIC)
    assert {r["id"] for r in kept.filter("keep").collect()} == {1}


def test_language_id_has_mixed_and_unknown(spark):
    anchors = frame(spark, [("the cat and the dog and the hat " * 4, "en"), ("кошка и собака и шляпа " * 4, "ru")], "t string, l string")
    profile = langid.profiles(anchors, "t", "l")
    docs = frame(spark, [(1, "the dog and the cat", "en"), (2, "собака и кошка", "ru"), (3, "12345", "en"), (4, "the cat and кошка и собака", "en")], "id bigint, t string, l string")
    got = {r["id"]: r["lang_classifier"] for r in langid.identify(docs, "id", "t", "l", profile, margin=0.5).collect()}
    assert got == {1: "en", 2: "ru", 3: "unknown", 4: "mixed"}


# ---- catalogue -----------------------------------------------------------


def test_seed(spark):
    langs = seed.languages(spark)
    assert (langs.count(), langs.filter("opus_code is null").count()) == (42, 6)


def test_phrase_match_and_specificity(spark):
    langs = seed.languages(spark).filter("iso639_3 in ('crh', 'tat', 'sah', 'kpv', 'udm')")
    cards = [
        ("a/x", 0, "Crimean Tatar texts", ["language:crh"], 5), ("a/y", 1, "non-tatar", [], 6), ("a/udm", 2, "Yakut and удмуртский", ["language:ru"], 7),
        ("a/w", 3, "коми-зырянский корпус", [f"language:l{i}" for i in range(6)] + ["language:udm"], None),
    ]
    got = catalog.card_matches(frame(spark, cards, "id string, pos bigint, description string, tags array<string>, downloads bigint"), langs)
    rows = {(r["iso639_3"], r["id"]): r for r in got.collect()}
    assert set(rows) == {("crh", "a/x"), ("tat", "a/x"), ("sah", "a/udm"), ("udm", "a/udm"), ("kpv", "a/w"), ("udm", "a/w")}
    assert rows["udm", "a/udm"]["ru_parallel"] and not rows["udm", "a/w"]["named"] and rows["kpv", "a/w"]["named"]
    score = got.select("iso639_3", "id", catalog.specificity(F.col("named"), F.col("tags")).alias("s")).collect()
    assert {(r["iso639_3"], r["id"]): r["s"] for r in score}[("udm", "a/w")] == 0


def test_top_ties_go_to_the_earlier_position(spark):
    rows = [("x", f"c{p}", p, 10, ["language:a"], False, False) for p in (3, 1, 2)]
    m = frame(spark, rows, "iso639_3 string, id string, pos bigint, downloads bigint, tags array<string>, ru_parallel boolean, named boolean")
    assert [r["id"] for r in catalog.top_cards(m).orderBy("rank").collect()] == ["c1", "c2", "c3"]


def test_corpora_summary(spark):
    rows = [
        ("udm", 0, "A", "ru", "udm", "500", "2"), ("udm", 1, "B", "udm", "ru", "", None), ("udm", 2, "C", "udm", "", "7", "1"),
        ("udm", 3, "D", "udm", None, "3", ""), ("udm", 4, "E", "en", "udm", "99", "9"),
    ]
    r = catalog.corpora_summary(frame(spark, rows, "code string, pos int, corpus string, source string, target string, alignment_pairs string, documents string"), "code", "pos").first()
    assert (r["ru_parallel_pairs"], r["ru_parallel_documents"], r["ru_parallel_corpora"]) == (500, 2, "A (500); B (0)")
    assert (r["mono_pairs_or_segments"], r["mono_documents"], r["mono_corpora"]) == (10, 1, "C (7); D (3)")


def test_pair_terms_drop_missing_codes(spark):
    pair = frame(spark, [("Russian", "rus", "ru", "Khanty", "kca", None)], "l_language_en string, l_iso639_3 string, l_opus_code string, r_language_en string, r_iso639_3 string, r_opus_code string")
    assert catalog.pair_terms(pair).first()["terms"] == ["Russian Khanty", "Khanty Russian", "rus-kca", "kca-rus"]


def test_snapshot_diff(spark):
    schema = "iso639_3 string, language_ru string, p bigint"
    old = frame(spark, [("udm", "у", 526), ("tat", "т", 2000), ("bak", "б", 5000), ("aaa", "а", 1)], schema)
    new = frame(spark, [("udm", "у", 776), ("tat", "т", 3001), ("bak", "б", 7000), ("zzz", "я", 1)], schema)
    got = {r["iso639_3"]: (r["change_type"], r["delta"], r["needs_human_review"], r["language_ru"]) for r in snapshots.diff(old, new, "iso639_3", "p", "language_ru").collect()}
    assert got == {
        "udm": ("parallel_count_changed", 250, False, "у"), "tat": ("parallel_count_changed", 1001, True, "т"),
        "bak": ("parallel_count_changed", 2000, False, "б"), "aaa": ("missing_language", None, True, None), "zzz": ("new_language", None, True, None),
    }
    assert snapshots.diff(old, old, "iso639_3", "p", "language_ru").count() == 0


def test_decisions_that_do_not_parse_are_kept(spark):
    rows = [("a", '{"label": "x", "dataset_id": "b", "needs_human_review": false}'), ("c", "no json"), ("d", '{"label": "y"}')]
    got = {r["dataset_id"]: (r["label"], r["needs_human_review"], r["raw_answer"]) for r in catalog.parse_decisions(frame(spark, rows, "id string, raw string"), "raw", "id").collect()}
    assert got == {"b": ("x", False, None), "c": ("llm_unparsed", True, "no json"), "d": ("y", True, None)}


# ---- pages ---------------------------------------------------------------

PAGE = (
    '<html><head><title>T &amp; t</title><script>var a="</p><a href=x>no</a>";</script><style>p{}</style></head><body><!-- <a href="/c">c</a> -->'
    '<p>Hello<b>world</b>&nbsp;x</p><noscript>hidden</noscript><a class="k" href=\'data.zip\'>Get <i>it</i></a><A HREF="/y?a=1&amp;b=2">Y</A></body></html>'
)


def test_page_text_and_links(spark):
    df = frame(spark, [(1, "http://h.org/d/p.html", PAGE)], "id bigint, url string, html string")
    assert df.select(pages.page_text(F.col("html"))).first()[0] == "T & t Hello world x Get it Y"
    assert df.select(pages.page_text(F.col("html"), 5)).first()[0] == "T & t"
    links = pages.page_links(df, ["id"], "url", "html")
    assert [tuple(r) for r in links.orderBy("pos").collect()] == [(1, 1, "http://h.org/d/data.zip", "Get it"), (1, 2, "http://h.org/y?a=1&b=2", "Y")]
    assert pages.download_links(links, ["id"]).first()["download_links"] == "http://h.org/d/data.zip"


def test_four_labels(spark):
    rows = [
        (1, "A parallel corpus of Udmurt, license CC", "http://a/", 0), (2, "a dataset", "http://a/", 2),
        (3, "latest News", "http://a/", 0), (4, "nothing", "http://a/", 1), (5, "dataset corpus", "http://a/", 0),
    ]
    df = frame(spark, rows, "id bigint, text string, url string, n bigint")
    names = F.array(F.lit("Udmurt"), F.lit("удмуртский"), F.lit("udm"))
    got = {r["id"]: (r["label"], r["confidence"], r["human_review_note"]) for r in pages.classify(df, "text", "url", names, "n").collect()}
    assert [got[i][0] for i in range(1, 6)] == ["dataset_candidate", "possible_dataset_candidate", "source_or_reference_only", "unclear", "unclear"]
    assert got[1][1:] == ("medium", pages.REVIEW_LICENSE)
    assert got[2][2] == f"{pages.REVIEW_LINKS}; {pages.REVIEW_NO_LICENSE}"


def test_frontier_has_no_address_twice(spark):
    rows = [("r", q, k, f"u{(q * 3 + k) % 9}", None) for q in range(6) for k in range(6)] + [("s", 0, 0, "", None), ("s", 0, 1, "x", "error"), ("s", 0, 2, "y", None)]
    got = pages.frontier(frame(spark, rows, "run string, query_no int, rank int, url string, error string"), "run").collect()
    seen, want = set(), []
    for q, k in itertools.product(range(4), range(4)):
        u = f"u{(q * 3 + k) % 9}"
        if u not in seen and len(want) < 10:
            seen.add(u)
            want.append(u)
    assert [r["url"] for r in sorted((r for r in got if r["run"] == "r"), key=lambda r: r["slot"])] == want
    assert [r["url"] for r in got if r["run"] == "s"] == ["y"]


# ---- alignment, spelling, metrics ---------------------------------------


def test_best_of_a_block_by_full_sort():
    r = np.random.default_rng(5)
    for n in (1, 2, 3, 9):
        scores = np.round(r.normal(size=(300, 9)), 1) + r.choice([0, 1e-14], size=(300, 9))
        scores[r.random((300, 9)) < 0.2] = -np.inf
        want = []
        for i, row in enumerate(np.round(scores, 12)):
            want += [(i, j, row[j]) for j in np.argsort(-row, kind="stable")[:n] if np.isfinite(row[j])]
        assert list(zip(*(x.tolist() for x in align._best_of(scores, n)))) == want


def test_block_scores_are_held_in_slices(spark, monkeypatch):
    """A block's whole matrix of scores is never held: no slice has more rows than a worker takes at once."""
    import tracemalloc

    taken = {}
    monkeypatch.setattr(align, "_ROWS", 64)
    rows = pd.DataFrame({"left_id": range(4000), "v": list(np.random.default_rng(1).normal(size=(4000, 8)))})
    frame_ = spark.createDataFrame([(0, [1.0], 0)], "left_id long, v array<double>, cell int")
    group = type(frame_.groupBy("cell").cogroup(frame_.groupBy("cell")))
    monkeypatch.setattr(group, "applyInPandas", lambda self, fn, schema: taken.setdefault("fn", fn))
    align._block_top(frame_, frame_.withColumnRenamed("left_id", "right_id"), 3, 4096, True)
    tracemalloc.start()
    found = taken["fn"]((0,), rows, rows.rename(columns={"left_id": "right_id"}))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert len(found) == 12000 and (found["left_id"] != found["right_id"]).all() and peak < 60_000_000


@pytest.mark.parametrize("single", [0, 40, 1 << 21])
def test_best_pairs_by_full_scores(monkeypatch, single):
    """Slices, ties, copies and floors: what single precision rules out is never among the best."""
    r = np.random.default_rng(8)
    monkeypatch.setattr(align, "_ROWS", 32)
    monkeypatch.setattr(align, "_COLUMNS", 50)
    monkeypatch.setattr(align, "_SINGLE", single)
    right = r.normal(size=(333, 8))
    right[100:160] = right[7] + 1e-9 * r.integers(0, 2, (60, 1))
    right = align._unit(pd.Series(list(right)))
    left, ids = right[::3], np.arange(333)
    for n in (1, 3):
        for floor in (-np.inf, 0.8):
            scores = np.round(left @ right.T, 12)
            scores[ids[::3, None] == ids[None, :]] = -np.inf
            want = [(i, j, row[j]) for i, row in enumerate(scores) for j in np.argsort(-row, kind="stable")[:n] if row[j] >= floor and np.isfinite(row[j])]
            got = align._best_pairs(left, right, ids[::3], ids, np.full(len(left), floor), n, True)
            assert [(i, j) for i, j, _ in want] == list(zip(*(x.tolist() for x in got[:2])))
            assert np.abs(got[2] - np.array([w[2] for w in want])).max() < 1e-11


def test_pairs_below_a_floor_stay_in_their_task(spark):
    """A block returns what can still win, and rows travel in the type they came in."""
    v = np.random.default_rng(6).normal(size=(120, 8)).astype("f4")
    table = lambda name: frame(spark, [(i, [float(x) for x in m], 0) for i, m in enumerate(v)], f"{name} bigint, v array<float>, cell int")
    left = table("left_id").withColumn("floor", F.when(F.col("left_id") > 0, F.lit(0.7)))
    got = align._block_top(left, table("right_id"), 3, 50, True).collect()
    unit = v / np.linalg.norm(v.astype(float), axis=1, keepdims=True)
    sim = unit @ unit.T
    assert all(r["score"] >= 0.7 for r in got if r["left_id"]) and sum(r["left_id"] == 0 for r in got) == 9
    best = [(i, int(j)) for i in range(1, 120) for j in [j for j in np.argsort(-sim[i]) if j != i][:3] if sim[i, j] >= 0.7]
    assert set(best) <= {(r["left_id"], r["right_id"]) for r in got}
    pivots = spark.sparkContext.broadcast(align._pivots(left, "left_id", "v", 4))
    assert align._placed(left, "left_id", "v", pivots, "left").schema["v"].dataType.simpleString() == "array<float>"


def test_top_matches_against_brute_force(spark):
    rng = np.random.default_rng(3)
    centres = rng.normal(size=(6, 8))
    left = centres[rng.integers(0, 6, 90)] + 0.05 * rng.normal(size=(90, 8))
    right = centres[np.minimum(rng.integers(0, 9, 200), 5)] + 0.05 * rng.normal(size=(200, 8))
    right[17] = right[4]
    df = lambda m, name: frame(spark, [(i, [float(x) for x in v]) for i, v in enumerate(m)], f"{name} bigint, v array<double>")
    got = align.top_matches(df(left, "l"), df(right, "r"), "l", "r", "v", k=3, cells=7, block=16)
    unit = lambda m: m / np.linalg.norm(m, axis=1, keepdims=True)
    sim = np.round(unit(left) @ unit(right).T, 12)
    want = {(i, int(j), k + 1) for i in range(90) for k, j in enumerate(np.argsort(-sim[i], kind="stable")[:3])}
    assert {(r["left_id"], r["right_id"], r["rank"]) for r in got.collect()} == want


def test_corpus_slice_cuts_before_dropping_nulls(spark):
    rows = [(i, i, None if i < 5 else f"a{i}", f"b{i}") for i in range(100)]
    got = align.corpus_slice(frame(spark, rows, "n bigint, k int, x string, y string"), "n").orderBy("n").collect()
    assert (len(got), got[0]["tat"], got[-1]["rus"]) == (50, "a5", "b54")


def edit(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def test_error_counts(spark):
    rows = [("а б в", "а б в"), ("кот сидит", "кит сидит тут"), ("", "один два"), ("é à", "e a"), ("x y z", "y z x")]
    got = metrics.error_counts(frame(spark, rows, "h string, r string"), "h", "r").collect()
    for r in got:
        assert r["char_edits"] == edit(r["h"], r["r"])
        assert r["word_edits"] == edit(r["h"].split(), r["r"].split())
    assert [r["mark_edits"] for r in got] == [0, 0, 0, 2, 0]


def test_bleu_and_chrf_of_equal_text_are_full(spark):
    df = frame(spark, [(1, "the cat sat on the mat", "the cat sat on the mat")], "id bigint, h string, r string")
    assert metrics.bleu(df, "id", "h", "r").first()["bleu"] == 100.0
    assert metrics.chrf(df, "id", "h", "r").first()["chrf"] == 100.0


def test_near_words_against_brute_force(spark):
    vocab = [("кот", 5), ("кит", 5), ("коты", 2), ("рот", 9), ("окно", 1), ("ко", 3)]
    unknown = ["кто", "коот", "ркот", "окна", "zzz"]
    for distance in (1, 2):
        got = {r["word"]: r["candidates"] for r in spell.near_words(frame(spark, [(u,) for u in unknown], "word string"), frame(spark, vocab, "word string, count bigint"), distance).collect()}
        for u in unknown:
            near = sorted((edit(u, w), -n, w) for w, n in vocab if edit(u, w) <= distance)[:3]
            assert got.get(u, []) == [w for _, _, w in near]


def test_typos_differ_by_one_operation(spark):
    gold = frame(spark, [(w,) for w in ("корова", "слово", "дом", "тетрадь", "песня")], "gold string")
    letters = frame(spark, [(c,) for c in "абвгд"], "letter string")
    for r in spell.with_typos(gold, letters).collect():
        assert edit(r["gold"], r["typo"]) <= 2 and (len(r["gold"]) >= 4 or r["typo"] == r["gold"])


def test_variants_and_dictionary(spark):
    words = frame(spark, [("шкап",), ("дом",), ("qala",)], "word string")
    got = spell.standardise(words, frame(spark, [("шкап", "шкаф")], "variant string, standard string"), ("qal", "кал"))
    assert {tuple(r) for r in got.select("word", "form", "kind").collect()} == {
        ("шкап", "шкаф", "normalisation"), ("дом", "дом", "unchanged"), ("qala", "кала", "transliteration")
    }
    out = spell.translate_by_dictionary(frame(spark, [(1, "Мин өй кирәк")], "id bigint, t string"), "t", "id", frame(spark, [("өй", "дом")], "word string, translation string")).first()
    assert (out["translation"], out["words"], out["known_words"]) == ("мин дом кирәк", 3, 1)


# ---- recognition, packages, files ---------------------------------------


def test_next_step(spark):
    rows = [("f", "raw", 10, 0.0), ("f", "prep", 30, 0.2), ("g", "raw", 30, 0.2), ("g", "prep", 30, 0.05), ("h", "raw", 3, 0.0)]
    got = {r["file"]: (r["version"], r["next_human_step"]) for r in recognition.next_step(frame(spark, rows, "file string, version string, tokens_2plus int, weird_char_share double"), "file").collect()}
    assert got == {"f": ("prep", recognition.STEP_PREPROCESS), "g": ("prep", recognition.STEP_SAMPLE), "h": ("raw", recognition.STEP_NEW_SCAN)}


SAMPLE = {
    "README.md": "# Mini project\n\nGoal: a tiny documented corpus prototype.\nLanguage: Udmurt / replace with your language.\nSee model.txt\n",
    "DATA_CARD.md": "# Data card\n\nSources: a wiki.\nLicense: check pages.\nKnown limitations: small sample, needs human review.\n",
    "EVAL_REPORT.md": "# Evaluation report\n\nMetric: manual inspection and simple script diagnostics.\n",
    "sources.csv": 'title,url,type,license_or_access,notes\n"Example, one",https://example.org,web,unknown,change me\n',
}


def test_package_audit(spark):
    rows = [("p", n, c) for n, c in SAMPLE.items()] + [("q", "README.md", "short")]
    seen = packages.overview(frame(spark, rows, "package string, name string, content string"))
    checked = packages.checks(seen)
    assert checked.filter("package = 'p'").count() == 13 and checked.filter("package = 'p' AND NOT ok").count() == 0
    assert checked.filter("package = 'q'").count() == 10
    tasks = {r["package"]: (r["package_ready"], r["tasks_before_publication"]) for r in packages.publication_tasks(seen, checked).collect()}
    assert tasks == {"p": (False, [packages.TASK_LICENSES, packages.TASK_PLACEHOLDERS, packages.TASK_REVIEW]), "q": (False, [packages.TASK_FILES])}
    broken = packages.promises(frame(spark, rows, "package string, name string, content string")).filter("package = 'p'").collect()
    assert {r["finding"] for r in broken} == {"missing file: model.txt", "report without test set"}


def test_files_round_trip(spark, tmp_path):
    df = frame(spark, [("1", "s, \"q\"", "строка\nдва", ["a", "b"])], "id string, source string, text string, tags array<string>")
    files.write_csv(df, f"{tmp_path}/csv")
    assert [tuple(r) for r in files.read_csv(spark, f"{tmp_path}/csv", "id string, source string, text string, tags string").collect()] == [("1", 's, "q"', "строка\nдва", "a; b")]
    files.write_jsonl(df, f"{tmp_path}/jsonl", "id", "source", "text", "source")
    assert files.read_jsonl(spark, f"{tmp_path}/jsonl").first()["metadata"] == {"source": 's, "q"'}
    files.write_report(df, f"{tmp_path}/report")
    assert "строка" in spark.read.text(f"{tmp_path}/report").first()[0]
    folder = tmp_path / "packages" / "p one"
    folder.mkdir(parents=True)
    (folder / "README.md").write_text("привет\nмир", encoding="utf-8")
    found = files.read_package_files(spark, f"{tmp_path}/packages/*/*").collect()
    assert [(r["package"].removeprefix("file:"), *tuple(r)[1:]) for r in found] == [(str(folder), "README.md", "привет\nмир")]
    assert files.read_or_else(spark, f"{tmp_path}/absent", df).count() == 1


def test_landed_answers(spark):
    rows = [
        ('{"corpora": [{"corpus": "A", "source": "ru", "target": "udm", "alignment_pairs": 5}]}',),
        ('[{"id": "d/x", "tags": ["language:udm"], "cardData": {"dataset_info": {"splits": [{"name": "train", "num_examples": 3}]}}}]',),
        ('{"query": {"pages": {"7": {"title": "T", "fullurl": "u"}}}}',),
    ]
    df = frame(spark, rows, "raw string")
    assert [(r["corpus"], r["alignment_pairs"]) for r in landed.corpora_rows(df).collect()] == [("A", "5")]
    assert [(r["id"], r["cardData"]["dataset_info"]["splits"][0]["num_examples"]) for r in landed.cards(df).collect()] == [("d/x", 3)]
    assert [(r["title"], r["text"]) for r in landed.page_extracts(df).collect()] == [("T", "")]


def test_refresh_stores_each_text_once(spark, tmp_path):
    from corploom.streaming.refresh import refresh_texts

    schema = "doc_id bigint, text string, lang string, source string, n_chars bigint"
    landing, table, state = f"{tmp_path}/in", f"{tmp_path}/out", f"{tmp_path}/state"
    frame(spark, [(1, "раз", "ru", "s", 3), (2, "раз", "ru", "s", 3)], schema).write.mode("append").parquet(landing)
    refresh_texts(spark, landing, table, state, tx.CYRILLIC).awaitTermination(120)
    frame(spark, [(3, "раз", "ru", "s", 3), (4, "два", "ru", "s", 3)], schema).write.mode("append").parquet(landing)
    refresh_texts(spark, landing, table, state, tx.CYRILLIC).awaitTermination(120)
    assert sorted(r["doc_id"] for r in spark.read.parquet(table).collect()) == [1, 4]


# --- long chains, kept rows, silent answers ----------------------------------------------------


@pytest.mark.parametrize("shuffled", [False, True])
def test_chains_of_two_thousand_rows_take_few_rounds(spark, monkeypatch, shuffled):
    from corploom.operators import components as module

    n = 2000
    ids = list(range(n))
    if shuffled:
        random.Random(3).shuffle(ids)
    else:
        ids = [*range(1, n), 0]
    rounds = []
    plain = module._mark
    monkeypatch.setattr(module, "_mark", lambda state: rounds.append(1) or plain(state))
    edges = spark.createDataFrame(list(zip(ids, ids[1:], strict=False)), "a long, b long").coalesce(2)
    labels = module.components(edges, "a", "b").collect()
    assert len(labels) == n and {r["label"] for r in labels} == {0}
    assert len(rounds) <= 2 * math.ceil(math.log2(n))


def test_rows_without_lines_or_words_keep_their_row(spark):
    rows = [(1, None), (2, ""), (3, " \n "), (4, "same\nown"), (5, "same\n\nother")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    kept = {r["doc_id"]: (r["text_kept"], r["lines_dropped"]) for r in dedup.drop_boilerplate(df, "text", "doc_id", 2).collect()}
    assert kept == {1: ("", 0), 2: ("", 0), 3: ("", 0), 4: ("own", 1), 5: ("other", 1)}
    pairs = spark.createDataFrame([("same", "gleich")], "word string, translation string")
    out = {r["doc_id"]: tuple(r)[1:] for r in spell.translate_by_dictionary(df, "text", "doc_id", pairs).collect()}
    assert out == {1: ("", 0, 0), 2: ("", 0, 0), 3: ("", 0, 0), 4: ("gleich own", 2, 1), 5: ("gleich other", 2, 1)}


def test_translation_is_made_where_the_text_lies(spark, monkeypatch):
    """A short dictionary moves no text; a long one gives the same rows."""
    monkeypatch.setattr(spell, "_SLICE", 7)
    r = random.Random(2)
    texts = [None, "", "...", "Ä a", *(" ".join(r.choice(["Ä", "b", "ça", "d1", "é.f"]) for _ in range(r.randrange(12))) for _ in range(60))]
    df = frame(spark, list(enumerate(texts)), "id bigint, t string")
    pairs = frame(spark, [("ä", "a"), ("ça", "ca ca"), ("é", ""), ("b", None), (None, "x"), ("zz", "y")], "word string, translation string")
    short = spell.translate_by_dictionary(df, "t", "id", pairs)
    plan = short._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Join" not in plan
    got = {tuple(x) for x in short.collect()}
    assert got == {tuple(x) for x in spell.translate_by_dictionary(df, "t", "id", pairs, broadcast_rows=0).collect()}
    table, want = {"ä": "a", "ça": "ca ca", "é": ""}, set()
    for i, t in enumerate(texts):
        words = (t or "").lower().replace(".", " ").split()
        want.add((i, " ".join(table.get(w, w) for w in words), len(words), sum(w in table for w in words)))
    assert got == want
    assert spell.translate_by_dictionary(df, "t", "id", pairs.limit(0)).filter("known_words > 0").count() == 0


def test_marked_words_are_counted_once(spark):
    """Each variant with its standard, from one count of the words."""
    freq = frame(spark, [("ca", 5), ("ça", 2), ("cä", 5), ("é", 1), ("çà", 4), ("x", 9)], "word string, count bigint")
    marked = spelling._marked(freq)
    assert {tuple(x) for x in marked.collect()} == {("ça", "ca"), ("çà", "ca")}
    assert "Join" not in marked._jdf.queryExecution().executedPlan().toString()


def test_texts_without_words_are_no_group(spark):
    df = spark.createDataFrame([(1, "...", "a"), (2, "!!", "a"), (3, "one two three four", "a"), (4, "one two three four", "b")], "doc_id long, text string, source string")
    assert {r["doc_id"] for r in dedup.near_duplicates(df, "text", "doc_id", "source").collect()} == {3, 4}


def test_href_is_the_attribute_of_that_name(spark):
    page = '<a href="/x" data-href="/t">A</a><a data-href="/t" href="/y">B</a><a class="c" href=/z>C</a>'
    df = spark.createDataFrame([(1, "http://h.org/", page)], "page_id int, url string, html string")
    assert [r["url"] for r in pages.page_links(df, ["page_id"], "url", "html").orderBy("pos").collect()] == [
        "http://h.org/x", "http://h.org/y", "http://h.org/z",
    ]


def test_only_a_missing_table_falls_back(spark, tmp_path):
    fallback = spark.createDataFrame([(1,)], "a int")
    assert files.read_or_else(spark, f"{tmp_path}/none", fallback).count() == 1
    spark.createDataFrame([(1,)], "b int").write.parquet(f"{tmp_path}/t")
    with pytest.raises(AnalysisException):
        files.read_or_else(spark, f"{tmp_path}/t", fallback)


def test_repeated_package_files_do_not_stop_the_audit(spark):
    df = spark.createDataFrame([("p", "README.md", "x" * 50), ("p", "README.md", "y"), ("q", "notes.txt", "z")], "package string, name string, content string")
    seen = {r["package"]: r["chars"] for r in packages.overview(df).collect()}
    assert seen["p"]["README.md"] == 50 and (seen["q"] is None or seen["q"].get("README.md") is None)


def test_equal_versions_are_decided_by_order(spark):
    df = spark.createDataFrame([(1, "preprocessed", 30, 0.0), (1, "raw", 30, 0.0)], "doc_id int, version string, tokens_2plus int, weird_char_share double")
    assert recognition.next_step(df, "doc_id").first()["version"] == "raw"


def test_word_statuses(spark):
    listed = spark.createDataFrame([("a", 5, 2), ("b", 5, 1), ("c", 5, 2), ("d", 5, 1)], "word string, count long, source_count long")
    foreign = spark.createDataFrame([("c",), ("d",)], "word string")
    assert {r["word"]: r["status"] for r in spell.with_status(listed, foreign).collect()} == {"a": "accepted", "b": "unsure", "c": "unsure", "d": "reject"}


def test_a_word_of_100000_letters_has_no_candidates(spark):
    unknown = spark.createDataFrame([("a" * 100_000,), ("katz",)], "word string")
    vocab = spark.createDataFrame([("katze", 3)], "word string, count long")
    assert [tuple(r) for r in spell.near_words(unknown, vocab).collect()] == [("katz", ["katze"])]


def test_counts_that_are_no_number_are_named(spark):
    rows = [("de", 0, "A", "ru", "de", "12", "3"), ("de", 1, "B", "de", "ru", "many", "x"), ("de", 2, "C", "ru", "de", "", None)]
    df = spark.createDataFrame(rows, "code string, pos int, corpus string, source string, target string, alignment_pairs string, documents string")
    out = catalog.corpora_summary(df, "code", "pos").first()
    assert (out["ru_parallel_pairs"], out["ru_parallel_documents"]) == (12, 3)
    assert out["ru_parallel_corpora"] == "A (12); B (no number: many); C (0)"
    assert [r[0] for r in df.orderBy("pos").select(tx.bad_int(F.col("alignment_pairs"))).collect()] == [False, True, False]


def test_search_results_number_pages_in_buckets(spark):
    from corploom.plans import tables

    hosts = ["hot"] * 500 + ["small"] * 3 + [None] * 4
    page = '<a href="http://x/">t</a>'
    rows = [(7 * i % 507 + 10**6 * (i % 2), h, "http://h/", page) for i, h in enumerate(hosts)]
    found = tables.search_results(spark.createDataFrame(rows, "page_id long, host string, url string, html string"))
    expected = {h: list(range(hosts.count(h))) for h in set(hosts)}
    got = {h: sorted(r["query_no"] for r in found.collect() if r["host"] == h) for h in expected}
    assert got == expected
    # A window whose only partition column is the host would rank all pages of a host in one task.
    assert "windowspecdefinition(host#" not in found._jdf.queryExecution().toString()
    numbers = tables.ranks.row_numbers(spark.createDataFrame(rows, "page_id long, host string, url string, html string"), "host", "page_id", "n")
    order = {h: sorted(r[0] for r in rows if r[1] == h) for h in expected}
    host_of = {r[0]: r[1] for r in rows}
    assert all(order[host_of[r["page_id"]]][r["n"] - 1] == r["page_id"] for r in numbers.collect())


def test_mixed_script_words_are_whole_words_in_one_scan(spark):
    rows = [("a", "añb cc ñ x1ñ_ zz. éé-aé"), ("a", None), ("b", "plain words"), ("b", "a" * 50000 + " " + "añ")]
    found = recognition.mixed_script_words(frame(spark, rows, "k string, t string"), "t", "A-Za-z", "À-ÖØ-öø-ÿ", "k")
    assert sorted(map(tuple, found.collect())) == [("a", "aé"), ("a", "añb"), ("a", "x1ñ_"), ("b", "añ")]
    # The pattern that held both letters at once went over a long word again from each of its letters.
    long = spark.createDataFrame([(1, "a" * 50000)], "k int, t string")
    start = time.perf_counter()
    assert recognition.mixed_script_words(long, "t", "A-Za-z", "À-ÖØ-öø-ÿ", "k").count() == 0
    assert time.perf_counter() - start < 10


def test_language_scores_by_lookup_equal_those_of_a_join(spark, monkeypatch):
    rng = random.Random(5)
    rows = [(i, "".join(rng.choices("abcé я😀1 .", k=rng.randrange(60))), rng.choice(["x", "y", "z"])) for i in range(200)]
    docs = frame(spark, rows + [(200, None, "x"), (201, "", None), (202, "q", "y")], "id bigint, t string, l string")
    for width in (2, 3, 5):
        monkeypatch.setattr(langid, "_SLICE", 1 << 20)
        profile = langid.profiles(docs.filter("id < 100 and l is not null"), "t", "l", size=40, width=width)
        counted = docs.filter("id < 100 and l is not null").select("l", F.explode(langid.ngrams(F.col("t"), width)).alias("g"))
        most = {(r["l"], r["g"]): r["count"] for r in counted.groupBy("l", "g").count().collect()}
        for lang in ("x", "y", "z"):
            want = sorted((g for l, g in most if l == lang), key=lambda g: (-most[lang, g], g.encode()))[:40]
            got = profile.filter(F.col("profile_lang") == lang).orderBy(F.desc("weight")).collect()
            assert [(r["gram"], r["weight"]) for r in got] == [(g, 40 - i) for i, g in enumerate(want)]
        quick = langid.identify(docs, "id", "t", "l", profile, width=width)
        assert "regexp_extract_all" not in quick._jdf.queryExecution().optimizedPlan().toString()
        monkeypatch.setattr(langid, "BROADCAST_ROWS", 0)
        joined = langid.identify(docs, "id", "t", "l", profile, width=width).collect()
        monkeypatch.setattr(langid, "BROADCAST_ROWS", 1000)
        assert sorted(quick.collect(), key=lambda r: r["id"]) == sorted(joined, key=lambda r: r["id"])
        monkeypatch.setattr(langid, "_SLICE", 50)
        again = langid.identify(docs, "id", "t", "l", profile, width=width).collect()
        assert sorted(again, key=lambda r: r["id"]) == sorted(joined, key=lambda r: r["id"])


def test_scores_of_random_pairs_by_hand(spark, monkeypatch):
    """N-grams are counted pair by pair in slices: no row a character is made or shuffled, whatever the length."""
    rng = random.Random(9)
    line = lambda: "".join(rng.choices("ab é\n😀", k=rng.randrange(40)))
    rows = [(i, line(), line()) for i in range(60)] + [(60, None, "a b"), (61, "", ""), (62, "ab " * 500, "ba " * 400), (63, "a b é ab a", "a b é ab a")]
    df = frame(spark, rows, "id bigint, h string, r string")
    units = {"chrf": lambda s: list("".join((s or "").split())), "bleu": lambda s: (s or "").split()}

    def totals(n, name):
        grams = lambda s: collections.Counter(tuple(u[i : i + n]) for u in [units[name](s)] for i in range(len(u) - n + 1))
        sides = [(grams(h), grams(r)) for _, h, r in rows]
        return [sum(sum(x.values()) for x in side) for side in zip(*sides)] + [sum(((h & r).total()) for h, r in sides)]

    for size in (1 << 18, 64):
        monkeypatch.setattr(metrics, "_SLICE", size)
        f = [5 * (m / h) * (m / r) / (4 * m / h + m / r) for h, r, m in (totals(n, "chrf") for n in range(1, 7))]
        got = metrics.chrf(df, "id", "h", "r")
        assert "Generate" not in got._jdf.queryExecution().optimizedPlan().toString()
        assert got.first()["chrf"] == pytest.approx(100 * sum(f) / 6, abs=1e-4)
        assert got.first()["matched_ngrams"] == sum(totals(n, "chrf")[2] for n in range(1, 7))
        counts = [totals(n, "bleu") for n in range(1, 5)]
        score = metrics.bleu(df, "id", "h", "r").first()
        assert (score["hyp_words"], score["ref_words"]) == tuple(counts[0][:2])
        brevity = min(1.0, math.exp(1 - counts[0][1] / counts[0][0]))
        assert score["bleu"] == pytest.approx(100 * brevity * math.exp(sum(math.log(m / h) for h, _, m in counts) / 4), abs=1e-4)
