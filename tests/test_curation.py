"""Index, keyed refresh, verified duplicates, page tokenizer and scan filters against brute force."""

import hashlib
import random
import re
import time

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from corploom.operators import align, bitfilter, dedup, keyed, markup, nearest, pages, split
from corploom.streaming.keyed_state import KeyedState

FOLDER = "/root/testdata/sf0.01"


def frame(spark, rows, schema):
    return spark.createDataFrame(rows, schema)


# ---- nearest neighbours ----------------------------------------------------


def test_index_recall_against_the_exact_search(spark):
    v = spark.read.parquet(f"{FOLDER}/embeddings.parquet")
    pairs = lambda df: {(r["left_id"], r["right_id"]) for r in df.collect()}
    exact = pairs(align.top_matches(v, v, "vec_id", "vec_id", "embedding", 3, exclude_same=True))
    found = pairs(nearest.nearest(v, v, "vec_id", "vec_id", "embedding", 3, exclude_same=True))
    assert len(exact & found) / len(exact) >= 0.95


def test_index_finds_translations_among_many(spark):
    """Noisy copies (cosine about 0.9) among 3,000 others: recall at 1, and how few rows a row meets."""
    r = np.random.default_rng(4)
    right = r.normal(size=(3000, 32))
    right /= np.linalg.norm(right, axis=1, keepdims=True)
    left = right[:400] + 0.08 * r.normal(size=(400, 32))
    table = lambda m, name: frame(spark, [(i, [float(x) for x in row]) for i, row in enumerate(m)], f"{name} int, v array<double>")
    l, rr = table(left, "l"), table(right, "r")
    got = {x["left_id"]: x["right_id"] for x in nearest.nearest(l, rr, "l", "r", "v").collect()}
    assert sum(got.get(i) == i for i in range(400)) / 400 >= 0.97
    bits = nearest.bits_for(3000)
    placed = nearest.bucketed(l, "l", "v", 32, 10, bits, bits + 1, "left")
    counts = placed.groupBy("left_id").count().agg(F.min("count"), F.max("count")).first()
    assert tuple(counts) == (10 * (bits + 1),) * 2
    assert 10 * (bits + 1) / 2**bits <= 1.2


def test_index_edges(spark):
    rows = [(1, [1.0, 0.0]), (2, None), (3, [1.0, None]), (4, [1.0]), (5, [0.0, 0.0]), (6, [2.0, 0.0]), (7, [2.0, 0.0]), (8, [float("nan"), 1.0])]
    v = frame(spark, rows, "id int, v array<double>")
    got = sorted((r["left_id"], r["right_id"], round(r["score"], 6)) for r in nearest.nearest(v, v, "id", "id", "v", 1, True, block=1).collect())
    assert [g for g in got if g[0] != 5] == [(1, 6, 1.0), (6, 1, 1.0), (7, 1, 1.0)]
    assert nearest.nearest(v, v.limit(0), "id", "id", "v").collect() == []


# ---- keyed state -------------------------------------------------------------


def landing(spark, rows):
    return frame(spark, rows, keyed.LANDING)


def state_of(state):
    return {(r["scope"], r["key"]): (r["name"], r["value"], r["pending_value"], r["status"], r["cached"]) for r in state.rows().collect()}


def told(state):
    return sorted((r["batch"], r["key"], r["change_type"], r["old_value"], r["new_value"], r["delta"], r["needs_human_review"]) for r in state.changes().collect())


def test_keyed_state_over_landings(spark, tmp_path):
    state = KeyedState(spark, str(tmp_path), scopes=2, parts=2)
    state.apply(landing(spark, [("a", "s", "A", 100, True), ("b", "s", "B", 5000, True), ("c", "s", "C", 7, True), ("d", None, "D", 1, True), (None, "s", "X", 1, True)]), 0)
    second = [("a", "s", "A2", 130, True), ("b", "s", "B", 90000, True), ("b", "s", "B", 3, False), ("e", "s", "E", None, True), ("n", "s", "N", 1, True)]
    state.apply(landing(spark, second), 1)
    expected = {
        ("s", "a"): ("A2", 130, None, "present", False),
        ("s", "b"): ("B", 5000, 90000, "present", False),
        ("s", "c"): ("C", 7, None, "missing", False),
        ("", "d"): ("D", 1, None, "present", False),
        ("s", "e"): ("E", None, None, "present", False),
        ("s", "n"): ("N", 1, None, "present", False),
    }
    assert state_of(state) == expected
    news = [(1, "a", "changed", 100, 130, 30, False), (1, "b", "changed", 5000, 90000, 85000, True), (1, "c", "missing", 7, None, None, True), (1, "n", "new", None, 1, None, True)]
    assert [t for t in told(state) if t[0] == 1] == news
    before = told(state)
    state.apply(landing(spark, second), 1)  # the batch again
    assert (state_of(state), told(state)) == (expected, before)
    state.apply(landing(spark, second), 2)  # the same answers in a later run: nothing to tell
    assert (state_of(state), told(state)) == (expected, before)
    state.apply(landing(spark, [("a", "s", "A2", None, True), ("b", "s", "B", 5000, True), ("c", "s", "C", 7, True), ("n", "s", "N", 1, False)]), 3)
    got = state_of(state)
    assert got[("s", "a")] == ("A2", 130, None, "present", True)  # carried forward
    assert got[("s", "b")] == ("B", 5000, None, "present", False)  # fell back
    assert got[("s", "n")][1:] == (1, None, "present", True)
    assert [t[1:3] for t in told(state) if t[0] == 3] == [("c", "returned"), ("e", "missing")]


def test_keyed_state_reads_and_writes_its_own_buckets(spark, tmp_path):
    state = KeyedState(spark, str(tmp_path), scopes=16, parts=2)
    scopes = [f"s{i}" for i in range(12)]
    state.apply(landing(spark, [(f"{s}-{i}", s, "n", i, True) for s in scopes for i in range(20)]), 0)
    own = frame(spark, [("s3",)], "scope string").select(state.scope_bucket(F.col("scope"))).first()[0]
    buckets = [own * 2, own * 2 + 1]
    mine = state.rows(buckets, before=1)
    assert mine.count() >= 20
    leaf = mine._jdf.queryExecution().executedPlan().collectLeaves().apply(0)
    mine._jdf.collectToPython()
    assert leaf.metrics().apply("numPartitions").value() == len({r["b"] for r in mine.select(state.bucket().alias("b")).distinct().collect()})
    assert "PartitionFilters: [concat_ws" in state.rows(buckets, before=1)._jdf.queryExecution().toString()
    state.apply(landing(spark, [(f"s3-{i}", "s3", "n", i + 1, True) for i in range(20)]), 1)
    assert {b for b, v in state.versions().items() if v == 1} == set(buckets)
    assert state.rows().count() == 240


def test_keyed_state_ignores_a_batch_that_died(spark, tmp_path):
    state = KeyedState(spark, str(tmp_path), scopes=1, parts=1)
    state.apply(landing(spark, [("a", "s", "A", 1, True)]), 0)
    ghost = state.rows().withColumn("value", F.lit(99).cast("bigint")).withColumn("batch", F.lit(1).cast("bigint")).withColumn("bucket", F.lit(0))
    ghost.write.mode("append").partitionBy("batch", "bucket").parquet(f"{tmp_path}/rows")
    assert state_of(state) == {("s", "a"): ("A", 1, None, "present", False)}
    state.apply(landing(spark, [("a", "s", "A", 5, True)]), 1)
    assert state_of(state)[("s", "a")][1] == 5
    state.apply(landing(spark, []), 2)
    assert state.versions() == {0: 1}


# ---- verified near duplicates --------------------------------------------------


def shingle_set(text, width):
    words = re.findall(r"[^\W]+", (text or "").lower())
    return frozenset(tuple(words[i : i + width]) for i in range(len(words) - width + 1)) or (frozenset([tuple(words)]) if words else frozenset())


def test_verified_duplicates_are_similar_enough(spark):
    r = random.Random(7)
    vocabulary = [f"w{i}" for i in range(60)]
    rows = []
    for group in range(8):
        original = [r.choice(vocabulary) for _ in range(90)]
        for copy in range(6):
            words = list(original)
            for _ in range(copy * 2):
                words[r.randrange(90)] = r.choice(vocabulary)
            rows.append((len(rows), " ".join(words), f"s{group}"))
    rows += [(100, rows[0][1], "again"), (101, rows[0][1].upper() + "!", "again"), (102, None, "x"), (103, "", "x"), (104, "one two", "x"), (105, "One, two.", "x")]
    got = {x["id"]: x for x in dedup.verified_duplicates(frame(spark, rows, "id bigint, t string, s string"), "t", "id", "s", 0.6, width=3).collect()}
    sets = {i: shingle_set(t, 3) for i, t, _ in rows}
    score = lambda a, b: len(sets[a] & sets[b]) / max(1, len(sets[a] | sets[b]))
    links = {(a, b) for a in sets for b in sets if a < b and sets[a] and score(a, b) >= 0.6}
    group = {i: i for i in sets}
    for _ in sets:
        for a, b in links:
            group[a] = group[b] = min(group[a], group[b])
    # Every removed row is verified; every group of brute force is found (its rows are all linked to leaders here).
    for i, x in got.items():
        assert x["removed"] == (i != x["removed_by"])
        assert any(i in link for link in links) and x["similarity"] >= 0.6
        assert group[i] == group[x["removed_by"]]
        best = max(score(i, j) for j in sets if j != i and group[j] == group[i])
        assert x["similarity"] <= best + 1e-12
    copies = {0: 0, 100: 0, 101: 0, 104: 104, 105: 104}
    assert all(got[i]["removed_by"] == g and got[i]["similarity"] == 1.0 for i, g in copies.items())
    assert not {102, 103} & set(got)
    strong = {b for a, b in links if score(a, b) >= 0.75}
    assert strong <= {i for i, x in got.items() if x["removed"]}


def test_verified_duplicates_of_dissimilar_band_mates(spark, monkeypatch):
    """All rows share a band, two families do not: the band's head rejects the other family, which finds its own leader."""
    rows = [(i, " ".join([f"a{j}" if i % 2 else f"b{j}" for j in range(30)] + [f"x{i}"]), "s") for i in range(10)]
    plain = dedup.minhash_signatures
    monkeypatch.setattr(dedup, "minhash_signatures", lambda *a: plain(*a).withColumn("band_keys", F.array(F.lit("one"))))
    got = dedup.verified_duplicates(frame(spark, rows, "id bigint, t string, s string"), "t", "id", "s", 0.8, width=3).collect()
    assert {(x["id"], x["removed_by"], x["group_size"]) for x in got} == {(i, i % 2, 5) for i in range(10)}
    assert dedup.verified_duplicates(frame(spark, [], "id bigint, t string, s string"), "t", "id", "s").collect() == []


@pytest.mark.parametrize("band_rows", [1000, 1])
def test_verified_duplicates_of_a_band_of_strangers(spark, monkeypatch, band_rows):
    """One task finishes a short band after its first leader; a long one takes rounds whose plans do not swell."""
    n = 16 if band_rows > 1 else 6
    rows = [(i, " ".join([f"w{i}x{j}" for j in range(20)]), "s") for i in range(n)] + [(n + i, f"w{i}x0 y " + " ".join([f"w{i}x{j}" for j in range(1, 20)]), "s") for i in range(n)]
    plain, settled, made = dedup.minhash_signatures, dedup.settled, []
    monkeypatch.setattr(dedup, "minhash_signatures", lambda *a: plain(*a).withColumn("band_keys", F.array(F.lit("one"))))
    monkeypatch.setattr(dedup, "settled", lambda df: made.append(df) or settled(df))
    monkeypatch.setattr(dedup, "BAND_ROWS", band_rows)
    got = dedup.verified_duplicates(frame(spark, rows, "id bigint, t string, s string"), "t", "id", "s", 0.8, width=2).collect()
    assert {(x["id"], x["removed_by"], x["similarity"]) for x in got} == {(i, i % n, 18 / 21) for i in range(2 * n)}
    assert len(made) <= (12 if band_rows > 1 else 6 + 4 * n)
    sizes = [len(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())) for df in made]
    assert max(sizes) < 200


@pytest.mark.parametrize("limits", [(1000, 1000, 1_000_000), (3, 2, 0)])
def test_verified_duplicates_by_brute_force(spark, monkeypatch, limits):
    """Bands that hold the same rows, sets of very different sizes, hot leaders and lists too long to broadcast give the links of the plain process."""
    for name, value in zip(("BAND_ROWS", "LEADER_ROWS", "BROADCAST_ROWS"), limits):
        monkeypatch.setattr(dedup, name, value)
    r = random.Random(3)
    rows = []
    for i in range(36):
        words = [f"f{i % 4}x{j}" for j in range(r.choice([12, 13, 40, 41, 90]))]
        words[r.randrange(len(words))] = f"y{i}"
        rows.append((i, " ".join(words), "s"))
    names = lambda i: {"a", f"b{i % 5}", f"c{i % 5}", f"d{i // 9}"}
    keys = [F.lit("a"), F.concat(F.lit("b"), F.col("id") % 5), F.concat(F.lit("c"), F.col("id") % 5), F.concat(F.lit("d"), F.floor(F.col("id") / 9))]
    plain = dedup.minhash_signatures
    monkeypatch.setattr(dedup, "minhash_signatures", lambda *a: plain(*a).withColumn("band_keys", F.array(*keys)))
    got = dedup.verified_duplicates(frame(spark, rows, "id bigint, t string, s string"), "t", "id", "s", 0.6, width=2).collect()
    sets = {i: shingle_set(t, 2) for i, t, _ in rows}
    score = lambda a, b: len(sets[a] & sets[b]) / len(sets[a] | sets[b])
    links = {}
    for band in set().union(*map(names, sets)):
        left = sorted(i for i in sets if band in names(i))
        while left:
            lead, *left = left
            links.update({(lead, i): score(lead, i) for i in left if score(lead, i) >= 0.6})
            left = [i for i in left if (lead, i) not in links]
    group = {i: i for i in sets}
    for _ in sets:
        for a, b in links:
            group[a] = group[b] = min(group[a], group[b])
    best = {i: max(s for link, s in links.items() if i in link) for i in sets if any(i in link for link in links)}
    assert len(set(group.values())) > 4 and any(s < 0.8 for s in links.values())
    assert {x["id"]: (x["removed_by"], round(x["similarity"], 9)) for x in got} == {i: (group[i], round(s, 9)) for i, s in best.items()}
    assert len(got) == len(best)


def test_verified_duplicates_keep_no_sets(spark, monkeypatch):
    """All that is kept on the way takes less room than the texts."""
    r = random.Random(5)
    texts = [" ".join(f"w{r.randrange(100_000)}" for _ in range(3000)) for _ in range(12)]
    rows = [(i, t, "s") for i, t in enumerate(texts)] + [(12 + i, t + " end", "s") for i, t in enumerate(texts)]
    settled, made = dedup.settled, []

    def kept(df):
        made.append(settled(df))
        return made[-1]

    monkeypatch.setattr(dedup, "settled", kept)
    got = dedup.verified_duplicates(frame(spark, rows, "id bigint, t string, s string"), "t", "id", "s").collect()
    assert {(x["id"], x["removed_by"]) for x in got} == {(i, i % 12) for i in range(24)}
    size = F.coalesce(F.sum(F.octet_length(F.to_json(F.struct("*")))), F.lit(0))
    assert sum(df.agg(size).first()[0] for df in made) < sum(len(t) for _, t, _ in rows)


def test_shingle_sets_by_brute_force(monkeypatch):
    monkeypatch.setattr(dedup, "_SLICE", 5)
    r = random.Random(2)
    texts = [" ".join(r.choice(["a", "b", "ab", "ж", "ё", "x" * 70]) for _ in range(r.randint(1, 30))) for _ in range(300)]
    sets = [shingle_set(t, 3) for t in texts]
    found = [set(dedup._shingle_set(t, 3).tolist()) for t in texts]
    hashes = {}
    for s, h in zip(sets, found):
        assert len(s) == len(h)
        for other, known in list(hashes.items())[:20]:
            assert len(s & other) == len(h & known)
        hashes[s] = h


def test_signatures_by_brute_force(spark):
    texts = ["a b c d", "One, two", "x", "", None, "Ж ё Ж ё Ж ё Ж", "a b c d e f g"]
    got = {x["id"]: x for x in dedup.minhash_signatures(frame(spark, list(enumerate(texts)), "id bigint, t string"), ["id"], "t", 3, 2, 3, True).collect()}
    first = lambda s: int(hashlib.md5(" ".join(s).encode()).hexdigest()[:16], 16)
    sets = {i: {first(s) for s in shingle_set(t, 3)} for i, t in enumerate(texts) if shingle_set(t, 3)}
    assert {i: {v % 2**64 for v in x["set"]} for i, x in got.items()} == sets
    family = dedup.hash_family(6)
    least = {i: [min(((v >> 32) % dedup.PRIME * a + b) % dedup.PRIME for v in s) for a, b in family] for i, s in sets.items()}
    for i, x in got.items():
        for j, y in got.items():
            assert [p == q for p, q in zip(x["band_keys"], y["band_keys"])] == [least[i][2 * b : 2 * b + 2] == least[j][2 * b : 2 * b + 2] for b in range(3)]


# ---- markup ------------------------------------------------------------------

HIDDEN = r"(?is)<!--.*?-->|<script\b[^>]*>.*?</script\s*>|<style\b[^>]*>.*?</style\s*>|<noscript\b[^>]*>.*?</noscript\s*>"
ANCHOR = r"(?is)<a\s(?:[^>]*?[^\w>-])??href\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s>]+)[^>]*>(.*?)</a\s*>"
PIECES = [
    "<a ", "<a\n", "<A href=", "href=", "href = ", '"', "'", ">", "</a>", "</A >", "<script", "<script>", "</script>", "</script ",
    "<!--", "-->", "--", "<style a>", "</style>", "x", "/y", "-href=", "xhref=", " ", "<b>", "</b>", "&amp;", "<noscript>", "</noscript>", "<", "data-",
]


def test_one_pass_agrees_with_the_patterns():
    r = random.Random(1)
    for _ in range(20000):
        page = "".join(r.choice(PIECES) for _ in range(r.randint(1, 22)))
        bare = re.sub(HIDDEN, " ", page, flags=re.ASCII)
        assert markup.shown(page) == bare
        assert markup.without_tags(bare) == re.sub(r"(?s)<[A-Za-z/!?][^>]*>", " ", bare)
        assert markup.anchors(bare) == [(m[1], m[2]) for m in re.finditer(ANCHOR, bare, re.ASCII)]


@pytest.mark.parametrize("piece", ["<script", "<!--", "<a ", '<a href="', "<a href=x>", "<script>"])
def test_unclosed_markup_is_linear(piece):
    begin = time.perf_counter()
    markup.parts(piece * 1_000_000)
    assert time.perf_counter() - begin < 60


def test_entities_without_semicolon_stay_as_written():
    page = '<p>a&amp;&amp</p>&lt;b&gt; &amp;lt; &#1073;&#x431; &AMP; &ampx; &no; &<a href="/q?a=1&copy=2&amp;b=3">&quo</a>&copy;'
    text, links = markup.parts(page)
    assert text.split() == ["a&&amp", "<b>", "&lt;", "бб", "&", "&ampx;", "&no;", "&", "&quo", "©"]
    assert links == [{"href": "/q?a=1&copy=2&b=3", "label": "&quo"}]


def test_pages_of_a_batch_are_parsed_in_slices(monkeypatch):
    seen, plain = [], markup._rows
    monkeypatch.setattr(markup, "_rows", lambda pages: seen.append(len(pages)) or plain(pages))
    rows = ["<p>a</p><a href=x>b</a>", None, ""] * 100
    for given in (rows, []):
        (got,) = markup.page_parts.func(iter([pa.array(given, pa.string())]))
        assert got.to_pylist() == [{"text": None, "links": []} if p is None else dict(zip(("text", "links"), markup.parts(p))) for p in given]
    assert seen == [128, 128, 44, 0]


def test_markup_of_null_and_in_row_links(spark):
    rows = [(1, "http://h.org/a/", '<p>T</p><a href="x.zip">d</a><a href=/y>e</a><a href="z.csv">f</a>'), (2, "http://h.org/", None), (3, "http://h.org/", "")]
    df = frame(spark, rows, "id int, url string, html string")
    links = pages.links_in_row(markup.of(F.col("html")), F.col("url"))
    got = {r["id"]: r for r in df.select("id", markup.of(F.col("html"))["text"].alias("text"), links.alias("links"), pages.downloads_in_row(links, 1).alias("d")).collect()}
    assert [tuple(x) for x in got[1]["links"]] == [("http://h.org/a/x.zip", "d"), ("http://h.org/y", "e"), ("http://h.org/a/z.csv", "f")]
    assert tuple(got[1]["d"]) == (1, "http://h.org/a/x.zip", "http://h.org/a/x.zip")
    assert (got[2]["text"], got[2]["links"], got[3]["text"]) == (None, [], "")
    assert tuple(got[2]["d"]) == (0, "", None)


def test_page_text_meets_no_exchange(spark):
    from corploom.plans import discovery

    spark.conf.set("spark.corploom.localSpread", "false")
    try:
        plan = discovery.page_candidates(spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.corploom.localSpread", "true")
    assert plan.count("ArrowEvalPython") == 1
    assert not [line for line in plan.splitlines() if "Exchange hashpartitioning(page_id" in line]


# ---- bit tables ----------------------------------------------------------------


def test_bit_table_loses_nothing(spark):
    some = spark.range(500).select(F.xxhash64("id").alias("h"))
    for bits in (8, 14):
        table = bitfilter.bit_table(some, "h", bits)
        assert some.filter(bitfilter.may_hold(table, F.col("h"), bits)).count() == 500
    others = spark.range(500, 50_500).select(F.xxhash64("id").alias("h"))
    assert others.filter(bitfilter.may_hold(bitfilter.bit_table(some, "h", 14), F.col("h"), 14)).count() < 500
    assert others.filter(bitfilter.may_hold(bitfilter.bit_table(some.limit(0), "h", 12), F.col("h"), 12)).count() == 0


def test_join_hits_shuffles_only_rows_concerned(spark):
    df = frame(spark, [(i, "t" * i) for i in range(200)] + [(None, "n")], "id bigint, text string")
    hits = frame(spark, [(3, [1]), (7, [2, 3])], "id bigint, places array<int>")
    ways = [bitfilter.join_hits(df, hits, "id", limit) for limit in (0, 1 << 20)]
    for joined in ways:
        assert {(r["id"], tuple(r["places"])) for r in joined.collect() if r["places"]} == {(3, (1,)), (7, (2, 3))}
        assert joined.count() == 201
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = bitfilter.join_hits(df, hits, "id", 0)._jdf.queryExecution().toString()
        optimized = plan.split("== Optimized Logical Plan ==")[1].split("== Physical Plan ==")[0]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    union, join = optimized.index("Union"), optimized.index("Join LeftOuter")
    assert union < join and "Filter" in optimized[join:] and "getbit" in optimized[join:].lower() + "getbit" * ("bit_get" in optimized[join:])


def test_held_out_overlap_by_brute_force(spark):
    r = random.Random(2)
    make = lambda n: " ".join(r.choice("abcde") for _ in range(n))
    docs = [(i, make(r.randint(0, 40))) for i in range(60)] + [(90, None)]
    held = [(make(12),) for _ in range(30)] + [(None,), ("",)]
    got = {x["id"]: x["shared_ngrams"] for x in split.held_out_overlap(frame(spark, docs, "id bigint, t string"), "id", "t", frame(spark, held, "h string"), "h", 4).collect()}
    grams = lambda t: {tuple(t.split()[i : i + 4]) for i in range(len(t.split()) - 3)} if t else set()
    asked = set().union(*(grams(h) for (h,) in held))
    assert got == {i: len(grams(t) & asked) for i, t in docs if grams(t) & asked}
