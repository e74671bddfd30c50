"""The training-data operators against brute force on small tables with nulls, repeats, ties and clashing columns."""

import base64
import hashlib
import random
import re
import subprocess
import sys
import zlib
from collections import Counter, defaultdict
from pathlib import Path

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from corploom.llm import (
    coverdedup,
    decontamination,
    langid,
    minhash,
    mixing,
    rules,
    sharding,
    suffixdedup,
    suffixes,
    urlfilter,
    warc,
    words,
)

DATA = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, size long, n_words long, kept boolean, rule string, label string"
VOCABULARY = [a + b for a in ("ka", "lo", "mi", "tu", "Ñe") for b in ("", "n", "r", "s", "é", "X")]


def spaced(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def folded(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def texts(seed=3, n=60):
    r = random.Random(seed)
    make = lambda k: " ".join(r.choice(VOCABULARY) for _ in range(k))
    passage, line = make(45), make(9)
    out = [None, "", "  \n\t ", "one", "One", "two words", line, f"{line}\n{line}\n{line}"]
    for i in range(n):
        kind = i % 6
        if kind == 0:
            out.append(make(r.randint(1, 90)))
        elif kind == 1:
            out.append(f"{make(r.randint(0, 20))}\n{passage} {make(r.randint(0, 20))}")
        elif kind == 2:
            out.append(r.choice(out[8:] or ["x"]))
        elif kind == 3:
            near = spaced(out[-1]) or ["y"]
            near[r.randrange(len(near))] = "changed"
            out.append(" ".join(near))
        elif kind == 4:
            out.append(f"{make(3)} " * 14)
        else:
            out.append(make(40) + "\n# a | b $\r\n" + line + "\n" + line)
    out += [make(6000), passage * 3, "ab" * 700]
    return out


def rows(seed=3, n=60):
    r = random.Random(seed)
    out = [(i, t, r.choice(["aa", "bb", None]), r.choice(["s0", "s0", "s0", "s1", "é", None]), 7, 7, True, "x", "y") for i, t in enumerate(texts(seed, n))]
    out += [out[20], out[20], (None, out[21][1], "aa", "s1", 1, 1, False, None, None), (None, None, None, None, None, None, None, None, None)]
    return out


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(rows(), SCHEMA).repartition(3).cache()


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def found(df):
    return Counter(tuple(r) for r in df.collect())


# --- words and suffixes -------------------------------------------------------------------------


def test_words_are_the_contract_words():
    batch = pa.array(texts())
    for table, pattern, fold in ((words.SPACED, r"[^\x20\x09-\x0D]+", False), (words.LETTERS, r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", True)):
        values, offsets = words.raw(batch)
        starts, ends, first = words.places(values, offsets, table)
        h = words.hashed(values, starts, ends, fold).tolist()
        expected = [re.findall(pattern, (folded(t) if fold else t) or "") for t in texts()]
        assert np.diff(first).tolist() == [len(w) for w in expected]
        flat = [w for t in expected for w in t]
        if not fold:
            assert len(set(flat)) == len(set(h)) == len(set(zip(flat, h, strict=True)))


def test_folded_words_take_capitals_as_small_letters():
    values, offsets = words.raw(pa.array(["ab zé 9q", "ab zé-9q"]))
    starts, ends, first = words.places(values, offsets, words.LETTERS)
    h = words.hashed(values, starts, ends, True).tolist()
    values, offsets = words.raw(pa.array(["aB Zé 9Q"]))
    assert h[:3] == h[3:] == words.hashed(values, np.array([0, 3, 7]), np.array([2, 6, 9]), True).tolist()


def test_long_words_and_pieces(monkeypatch):
    text = "x" * 5000 + " Ab ab " + "y" * 30 + " x ab"
    plain = words.raw(pa.array([text]))
    starts, ends, _ = words.places(*plain, words.SPACED)
    whole = words.hashed(plain[0], starts, ends, True)
    monkeypatch.setattr(words, "PIECE", 40)
    pieces = words.hashed(plain[0], starts, ends, True)
    assert whole[1] == whole[2] == whole[5]
    assert pieces[1:].tolist() == whole[1:].tolist()


def test_windows_agree_with_tuples():
    r = random.Random(5)
    items = [r.randint(0, 2) for _ in range(400)]
    h = words.finish(np.array(items, np.uint64) + np.uint64(3))
    for k in (1, 2, 3, 7, 8, 10, 35):
        w = words.windows(h, k).tolist()
        plain = [tuple(items[i : i + k]) for i in range(len(items) - k + 1)]
        assert len(set(zip(w, plain, strict=True))) == len(set(w)) == len(set(plain))


def test_suffix_arrays():
    r = random.Random(1)
    for _ in range(150):
        s = [r.randint(0, r.choice([1, 2, 26])) for _ in range(r.randint(1, 90))] * r.choice([1, 1, 4])
        t = np.array(s, np.int32)
        order = suffixes.suffix_array(t)
        assert order.tolist() == sorted(range(len(s)), key=lambda i: s[i:])
        limit = r.randint(1, 20)
        prefixes = suffixes.common_prefixes(t, order, limit)
        for i, j in zip(order[1:].tolist(), order.tolist()):
            same = next((k for k in range(len(s)) if i + k >= len(s) or j + k >= len(s) or s[i + k] != s[j + k]), len(s))
            assert min(prefixes[i], limit) == min(same, limit)


# --- 1 mixing -----------------------------------------------------------------------------------


def size():
    return F.coalesce(F.regexp_count("text", F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0))


def test_mixing_meets_targets(docs):
    out = [r.asDict() for r in mixing.mix(docs, size()).collect()]
    assert len(out) == len(rows())
    by = defaultdict(list)
    for r in out:
        assert 0 <= r["taken"] <= 3 * r["size"]
        by[r["source"]].append(r)
    order = sorted((s for s in by if s is not None)) + [None]
    total = sum(r["size"] for r in out)
    weights = {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}
    targets, open_ = {}, set(order)
    while True:
        left = total - sum(targets.values())
        share = {s: left * weights[s] / sum(weights[t] for t in open_) for s in open_}
        over = {s for s in open_ if share[s] > 3 * sum(r["size"] for r in by[s])}
        if not over:
            break
        for s in over:
            targets[s] = 3 * sum(r["size"] for r in by[s])
        open_ -= over
    targets |= share
    for s, group in by.items():
        assert group[0]["source_size"] == sum(r["size"] for r in group)
        assert group[0]["target"] == pytest.approx(targets[s])
        assert abs(sum(r["taken"] for r in group) - targets[s]) <= len(group) / 10 + 2
    assert found(mixing.mix(docs, size())) == found(mixing.mix(docs.repartition(5), size()))


def test_mixing_whole_documents(docs):
    out = mixing.mix(docs, size(), whole=True).collect()
    assert all(r["taken"] % r["size"] == 0 if r["size"] else r["taken"] == 0 for r in out)


def test_mixing_empty_and_without_words(spark, empty):
    assert mixing.mix(empty, size()).count() == 0
    blank = spark.createDataFrame([(1, None, None, "a"), (2, " ", None, None)], "doc_id long, text string, lang string, source string")
    assert [r["taken"] for r in mixing.mix(blank, size()).collect()] == [0, 0]


# --- 8 sharding ---------------------------------------------------------------------------------


def test_shards(docs, empty):
    out = [r.asDict() for r in sharding.shard_table(docs, shards=7).collect()]
    by = defaultdict(list)
    for r in out:
        by[r["shard"]].append(r)
    assert len(out) == len(rows()) and set(by) == set(range(7))
    assert max(map(len, by.values())) - min(map(len, by.values())) <= 1
    for group in by.values():
        assert sorted(r["slot"] for r in group) == list(range(len(group)))
    for s, n in Counter(r["source"] for r in out).items():
        if s == "s0":
            assert max(abs(sum(r["source"] == s for r in g) - n / 7) for g in by.values()) <= 2.5
    text = {r[0]: r[1] or "" for r in rows() if r[0] is not None}
    for r in out:
        if r["doc_id"] is not None:
            assert r["size"] == len(text[r["doc_id"]].encode()) + 16 and r["text_crc32"] == zlib.crc32(text[r["doc_id"]].encode())
    assert found(sharding.shard_table(docs, 7)) == found(sharding.shard_table(docs.repartition(5), 7))
    assert sharding.shard_table(empty).count() == 0


def test_shards_with_small_buckets_and_more_shards_than_rows(spark):
    table = spark.createDataFrame([(i, f"s{i % 3 if i % 2 else 9}", i % 5) for i in range(500)], "doc_id long, source string, extra int")
    out = sharding.interleave(table, 13, "source", "doc_id", ["extra"], bucket_rows=16).collect()
    n = Counter(r["shard"] for r in out)
    assert len(out) == 500 and max(n.values()) - min(n.values()) <= 1
    assert sorted((r["shard"], r["slot"]) for r in out) == [(s, i) for s in sorted(n) for i in range(n[s])]
    assert Counter(r["shard"] for r in sharding.interleave(table.limit(3), 40, "source", "doc_id", []).collect()).most_common(1)[0][1] == 1


# --- 6 URL filter -------------------------------------------------------------------------------

URLS = [
    None, "", "no scheme", "http://", "http://ORG/x", "http://a.Example.ORG/es/1", "https://example.org/en/1x?q#f", "http://badexample.org/es/",
    "http://x.com/fr/a#b", "http://x.com/fr", "http://com/de/?x", "http://y.net/de/", "http://example.org?x/es/", "a://b://example.org/es/",
    "http://example.org:80/es/", "http://example.org./es/", "http://x.com/de/" + "p" * 5000, "http://" + "a." * 300 + "org/",
]
RULES = [("allow", "org", "/"), ("block", "example.org", "/es/"), ("block", "example.org", "/en/1"), ("allow", "com", "/fr/"), ("block", "com", "/de/")]


def judged(url, table, default="allow"):
    rest = url.split("://", 1)[1] if url and "://" in url else ""
    host = re.match(r"[^/?#]*", rest)[0]
    path = re.match(r"[^?#]*", rest[len(host) :])[0] if rest[len(host) :].startswith("/") else ""
    host = folded(host)
    fit = [(len(h + p), len(h), v == "block", h + p, v) for v, h, p in table if (host == h or host.endswith("." + h)) and path.startswith(p)]
    best = max(fit, default=None)
    return host, path, best[3] if best else None, best[4] if best else default


def test_url_rules(spark):
    pages = spark.createDataFrame([(i % 15, u, "x", "y", "z") for i, u in enumerate(URLS * 2)], "page_id int, url string, host string, rule string, best string")
    for table, default in ((RULES, "allow"), ([*RULES, ("allow", "example.org", "/es/"), ("block", "y.net", "")], "block"), ([], "allow")):
        if table:
            made = urlfilter.rules_table(spark, table)
        else:
            made = spark.createDataFrame([], "verdict string, rule_host string, rule_path string")
        out = Counter((r["url"], r["host"], r["path"], r["rule"], r["verdict"]) for r in urlfilter.judge(pages, made, default=default).collect())
        assert out == Counter((u, *judged(u, table, default)) for u in URLS * 2)
    assert urlfilter.judge(pages.limit(0), urlfilter.rules_table(spark, RULES)).count() == 0


# --- 4 WARC -------------------------------------------------------------------------------------

PAGES = [
    (1, "http://a/", "<p>é</p>\r\n\r\nWARC/1.1\r\n\r\n"), (2, "http://b/ c\r\nd", "same"), (3, None, "same"), (4, "u", None), (5, "u", ""),
    (6, "u", "x" * 300_000), (0, "u", "same"), (6, "u", "x" * 300_000), (7, "w", "\r\n\r\n"),
]


def test_warc_round_trip(spark, tmp_path):
    pages = spark.createDataFrame(PAGES, "page_id long, url string, html string").withColumn("length", F.lit(1)).repartition(3)
    for least in (0, 5):
        folder = f"file://{tmp_path}/a{least}"
        index = warc.write_archives(pages, folder, min_bytes=least, archive_bytes=1000)
        out = warc.read_records(index, folder).collect()
        payload = Counter((str(i), (h or "").encode()) for i, _, h in PAGES)
        first = {}
        for i, _, h in PAGES:
            first[h or ""] = min(i, first.get(h or "", i))
        expected = Counter()
        for i, _, h in PAGES:
            content = (h or "").encode()
            again = len(content) >= least and first[h or ""] != i
            digest = base64.b32encode(hashlib.sha1(content).digest()).decode()
            expected[(str(i), len(content), digest, "revisit" if again else "response", str(first[h or ""]) if again else None)] += 1
        assert Counter((r["page_id"], r["payload_bytes"], r["payload_digest"], r["record_type"], r["refers_to"]) for r in out) == expected
        assert all(payload[(r["page_id"], bytes(r["payload"]))] for r in out if r["record_type"] == "response")
        chosen = warc.read_records(index.filter("page_id in (2, 6)"), folder).collect()
        assert sorted(r["page_id"] for r in chosen) == ["2", "6", "6"]
        archive = b"".join(p.read_bytes() for p in sorted(Path(f"{tmp_path}/a{least}").rglob("part-*")))
        assert archive.count(b"WARC-Type: ") == len(PAGES)


def test_warc_damage_is_noticed(spark, tmp_path):
    pages = spark.createDataFrame([(1, "u", "whole payload"), (2, "v", "whole payload")], "page_id long, url string, html string")
    index = warc.write_archives(pages, f"file://{tmp_path}/a")
    assert [r["payload_bytes"] for r in warc.read_records(index, f"file://{tmp_path}/a").collect()] == [13, 13]
    (path,) = [p for p in Path(f"{tmp_path}/a").rglob("part-*") if b"whole payload" in p.read_bytes()]
    record = path.read_bytes().split(b"\r\n\r\nWARC/")[0].removesuffix(b"\r\n\r\n")
    assert warc.parse_record(record)["payload"] == b"whole payload"
    for damaged in (record.replace(b"whole payload", b"other payload"), record.replace(b"X-Payload-Length: 13", b"X-Payload-Length: 14")):
        with pytest.raises(ValueError, match="payload"):
            warc.parse_record(damaged)


def test_warc_without_pages(spark):
    index, records = warc.round_trip(spark.createDataFrame([], "page_id long, url string, html string"))
    assert index.count() == records.count() == 0


# --- 5 quality rules ----------------------------------------------------------------------------


def measures(text):
    text = text or ""
    w, seen, repeated, n = spaced(text), set(), 0, set()
    for line in text.split("\n"):
        if spaced(line):
            repeated += line in seen
            seen.add(line)
    windows = Counter(tuple(w[i : i + 8]) for i in range(len(w) - 7))
    for i in range(len(w) - 7):
        if windows[tuple(w[i : i + 8])] > 1:
            n |= set(range(i, i + 8))
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), repeated, len(n)


def test_measures(docs, empty):
    out = rules.judge(docs, [])
    expected = Counter()
    for r in rows():
        m = measures(r[1])
        failed = m[0] < 20 or 100 * m[4] > 30 * m[0]
        expected[(r[0], *m, failed, not failed)] += 1
    assert found(out.select("doc_id", *rules.BASE, "base_failed", "kept")) == expected
    assert rules.judge(empty, []).count() == 0


def test_rules_are_learned(spark):
    r = random.Random(4)
    good = [" ".join(r.choice(VOCABULARY) for _ in range(r.randint(30, 200))) for _ in range(300)]
    shout = [t.upper().replace(" ", "!! ") for t in good[:40]]
    marked = [t.replace(" ", " ### ") for t in good[40:80]]
    table = [(i, t) for i, t in enumerate(good + shout + marked)]
    docs = spark.createDataFrame(table, "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i < 300), 0) for i, _ in table if i % 3] + [(None, 1, 0), (1, None, 0)], "doc_id long, quality int, toxic int")
    learned = rules.learn(docs, labels)
    assert learned and learned == rules.learn(docs.repartition(4), labels)
    out = {r["doc_id"]: r for r in rules.judge(docs, learned).collect()}
    wrong = [i for i, _ in table if out[i]["kept"] != (i < 300)]
    assert len(wrong) <= 4
    assert rules.learn(docs, labels.filter("quality = 1")) == [] == rules.learn(docs, labels.limit(0))


# --- 2 decontamination --------------------------------------------------------------------------


def low_words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", folded(text))


def contamination(table, items, k=10):
    window = defaultdict(set)
    for i, t in items:
        w = low_words(t)
        n = min(k, len(w))
        for s in range(len(w) - n + 1) if n else ():
            window[tuple(w[s : s + n])].add(str(i) if i is not None else "null")
    out = Counter()
    for r in table:
        w, hit, ids = low_words(r[1]), set(), set()
        for n in {len(x) for x in window}:
            for s in range(len(w) - n + 1):
                if tuple(w[s : s + n]) in window:
                    ids |= window[tuple(w[s : s + n])]
                    hit |= set(range(s, s + n))
        out[(r[0], len(w), len(hit), tuple(sorted(ids)), bool(hit))] += 1
    return out


def benchmark_items():
    t = texts()
    return [(1, t[9]), (2, t[9]), (2, t[9]), (10, "One"), (3, "two WORDS!"), (4, None), (5, "...\n"), (None, t[6]), (7, " ".join(spaced(t[13])[:12])), (8, t[-3])]


def test_decontamination(spark, docs, empty):
    items = spark.createDataFrame(benchmark_items(), "item_id long, text string")
    for block in (10**6, 400):
        out = decontamination.match_benchmark(docs, items, block_words=block)
        ids = decontamination.items_found(F.col("matches"))
        got = Counter((r[0], r[1], r[2], tuple(r[3]), r[4]) for r in out.select("doc_id", "n_words", "n_hit", ids, "contaminated").collect())
        assert got == contamination(rows(), benchmark_items())
    assert not decontamination.match_benchmark(docs, items.limit(0)).filter("contaminated or n_hit > 0").count()
    assert decontamination.match_benchmark(empty, items).count() == 0


def test_matches_are_longest(spark):
    w = [f"w{i}" for i in range(60)]
    docs = spark.createDataFrame([(1, "x y " + " ".join(w[5:40]) + " z " + " ".join(w[50:60]))], "doc_id long, text string")
    items = spark.createDataFrame([(9, " ".join(w))], "item_id long, text string")
    m = decontamination.match_benchmark(docs, items).first()["matches"]
    assert sorted((x["item_start"], x["doc_start"], x["length"]) for x in m) == [(5, 2, 35), (50, 38, 10)]


# --- 3 and 7 repeated passages ------------------------------------------------------------------


def kept_words(table, width):
    w = [spaced(r[1]) for r in table]
    times = Counter(tuple(x[i : i + width]) for x in w for i in range(len(x) - width + 1))
    out = Counter()
    for r, x in zip(table, w, strict=True):
        gone = set()
        for i in range(len(x) - width + 1):
            if times[tuple(x[i : i + width])] > 1:
                gone |= set(range(i, i + width))
        left = " ".join(v for i, v in enumerate(x) if i not in gone)
        out[(r[0], len(x), len(gone), left, hashlib.sha256(left.encode()).hexdigest())] += 1
    return out


@pytest.mark.parametrize("width", [35, 6])
def test_cover_dedup(docs, empty, width):
    assert found(coverdedup.remove_repeats(docs, width=width)) == kept_words(rows(), width)
    if width == 35:
        assert coverdedup.remove_repeats(empty).count() == 0


def test_covers_are_difference_covers():
    for v, cover in coverdedup.COVERS.items():
        assert {(a - b) % v for a in cover for b in cover} == set(range(v))


def kept_bytes(table, length):
    b = [(r[1] or "").encode() for r in table]
    times = Counter(x[i : i + length] for x in b for i in range(len(x) - length + 1))
    out = Counter()
    for r, x in zip(table, b, strict=True):
        gone = bytearray(len(x))
        for i in range(len(x) - length + 1):
            if times[x[i : i + length]] > 1:
                gone[i : i + length] = b"\1" * length
        left = bytes(c for c, g in zip(x, gone, strict=True) if not g)
        out[(r[0], len(x), sum(gone), len(re.findall(b"\1+", bytes(gone))), hashlib.sha256(left).hexdigest())] += 1
    return out


@pytest.mark.parametrize(("length", "group"), [(400, 512), (50, 512), (50, 1)])
def test_suffix_dedup(docs, empty, monkeypatch, length, group):
    monkeypatch.setattr(suffixdedup, "GROUP", group)
    assert found(suffixdedup.remove_repeats(docs, length=length, texts=False)) == kept_bytes(rows(), length)
    if length == 400:
        assert suffixdedup.remove_repeats(empty).count() == 0


# --- 9 near duplicates --------------------------------------------------------------------------


def groups(table, width, percent=80):
    sets = []
    for r in table:
        w = spaced(folded(r[1]))
        k = min(width, len(w))
        sets.append({tuple(w[i : i + k]) for i in range(len(w) - k + 1)} if k else set())
    label = list(range(len(table)))
    for i in range(len(table)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and 100 * both >= percent * len(sets[i] | sets[j]) and label[i] != label[j]:
                a, b = label[i], label[j]
                label = [b if x == a else x for x in label]
    least = {}
    for r, x in zip(table, label, strict=True):
        if r[0] is not None:
            least[x] = min(least.get(x, r[0]), r[0])
    return Counter((r[0], len(s), least.get(x), r[0] == least.get(x)) for r, s, x in zip(table, sets, label, strict=True))


@pytest.mark.parametrize("width", [2, 5])
def test_near_duplicates(docs, empty, width):
    assert found(minhash.near_duplicates(docs, width=width)) == groups(rows(), width)
    if width == 5:
        assert minhash.near_duplicates(empty).count() == 0


def test_drifting_chain_is_one_group(spark):
    w = [f"w{i}" for i in range(400)]
    table = [(i * 7 % 101, " ".join(w[i : i + 60])) for i in range(0, 101)]
    docs = spark.createDataFrame(table, "doc_id long, text string").repartition(4)
    out = minhash.near_duplicates(docs, width=2).collect()
    assert {r["component_id"] for r in out} == {0} and sum(r["kept"] for r in out) == 1


def test_registers_estimate_similarity():
    r = np.random.default_rng(2)
    for share in (0.5, 0.8, 0.95):
        a = r.integers(0, 1 << 63, 1000, dtype=np.uint64)
        n = int(round(1000 * 2 * share / (1 + share)))
        b = np.concatenate([a[:n], r.integers(0, 1 << 63, 1000 - n, dtype=np.uint64)])
        agree = (minhash.registers(np.sort(a)) == minhash.registers(np.sort(b))).mean()
        chance = minhash.chance_equal(np.array([1000.0]), np.array([1000.0]))[0]
        assert 0 < chance < 0.01 and abs((agree - chance) / (1 - chance) - n / (2000 - n)) < 0.12


# --- 10 language --------------------------------------------------------------------------------


def test_languages_of_held_out_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    out = {r["doc_id"]: r for r in langid.predict(docs, langid.fit(docs)).collect()}
    truth = {r["doc_id"]: r["lang"] for r in docs.select("doc_id", "lang").collect()}
    assert all(out[i]["held_out"] == (zlib.crc32(str(i).encode()) % 4 == 2) for i in truth)
    held = [i for i in truth if out[i]["held_out"]]
    assert sum(out[i]["lang_pred"] == truth[i] for i in held) / len(held) > 0.97
    assert all(0 <= r["score"] <= 1 for r in out.values())


def test_language_edges(spark, docs, empty):
    model = langid.fit(docs)
    out = langid.predict(docs, model).collect()
    assert len(out) == len(rows())
    blank = spark.createDataFrame([(1, None, None), (2, "123 !?", "en"), (None, "abc", "en")], "doc_id long, text string, lang string")
    assert sorted(r["lang_pred"] == "und" for r in langid.predict(blank, model).collect()) == [False, True, True]
    assert langid.fit(blank) is None and langid.fit(empty) is None
    assert {r["lang_pred"] for r in langid.predict(blank, None).collect()} == {"und"}


def test_rare_languages_are_learned(spark):
    r = random.Random(11)
    letters = {"aa": "abcdefgh", "bb": "ijklmnop"} | {f"r{i}": "".join(chr(0x4E00 + 6 * i + j) for j in range(6)) for i in range(12)}
    rows, i = [], 0
    for lang, n in {name: 600 if len(set(name)) == 1 else 6 for name in letters}.items():
        while n:
            i += 1
            if zlib.crc32(str(i).encode()) % 4 != 2:
                rows.append((i, " ".join("".join(r.choice(letters[lang]) for _ in range(5)) for _ in range(20)), lang))
                n -= 1
    docs = spark.createDataFrame(rows + 300 * rows[-1:], "doc_id long, text string, lang string")
    model = langid.fit(docs, sample_rows=100)
    assert model.languages == sorted(letters)
    out = {x["doc_id"]: x["lang_pred"] for x in langid.predict(docs, model).collect()}
    assert all(out[i] == lang for i, _, lang in rows)


def test_language_quota():
    assert langid.quota([7000, 3000, 500, 3], 4000) == 1748
    assert langid.quota([10, 20], 4000) == 20
    assert langid.quota([9000] * 1000, 4000) == langid.LANGUAGE_ROWS


# --- pipeline and entry -------------------------------------------------------------------------


def test_pipeline_stages(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet").withColumn("kept", F.lit(1)).withColumn("size", F.lit("s"))
    columns = docs.columns
    at = docs
    for name, stage in corpus_pipeline.STAGES:
        before = {r["doc_id"]: r for r in at.collect()}
        out = stage(spark, at, DATA).cache()
        got = out.collect()
        if name == "interleaved_shards":
            assert len(got) == at.count()
            continue
        assert out.columns == columns
        assert all(r == before[r["doc_id"]] for r in got)
        table = [(i, r["text"]) for i, r in before.items()]
        ids = {r["doc_id"] for r in got}
        if name == "near_duplicates":
            assert ids == {i for i, _, _, kept in groups(table, 5) if kept}
        if name == "benchmark_decontamination":
            items = [tuple(r) for r in spark.read.parquet(f"{DATA}/benchmark.parquet").select("item_id", "text").collect()]
            assert ids == {r[0] for r in contamination(table, items) if not r[4]}
        if name == "source_mixing":
            assert max(Counter(r["doc_id"] for r in got).values()) <= 3
        at = spark.createDataFrame(got, out.schema)


def test_near_duplicate_stage_judges_rows(spark):
    r = random.Random(5)
    a, b, c, d = (" ".join(r.choice(VOCABULARY) for _ in range(80)) for _ in range(4))
    near = lambda t: t + " more"
    table = [
        (1, a), (2, near(a)), (2, b), (3, c), (3, c), (3, c), (None, near(c)), (None, c),
        (None, d), (None, near(d)), (None, d), (4, b), (5, None), (5, ""), (5, ""), (None, None), (None, None),
    ]
    docs = spark.createDataFrame([(i, t, "s") for i, t in table], "doc_id long, text string, source string")
    got = [(x["doc_id"], x["text"]) for x in corpus_pipeline.near_duplicates(spark, docs, DATA).collect()]
    (last,) = [t for i, t in got if i is None and t]
    assert last in (d, near(d))
    expected = [(1, a), (2, b), (3, c), (None, last), (5, None), (5, ""), (None, None)]
    assert Counter(got) == Counter(expected)


def test_pipeline_runs_and_takes_empty_tables(spark):
    assert corpus_pipeline.run(spark, DATA).count() > 0
    none = spark.read.parquet(f"{DATA}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, none, DATA).count() == 0


def test_entry_without_the_subpackage():
    code = (
        "import sys\n"
        "class Gone:\n"
        "    def find_spec(self, name, path=None, target=None):\n"
        "        if name == 'corploom.llm' or name.startswith('corploom.llm.') or name == 'corpus_pipeline':\n"
        "            raise ModuleNotFoundError(f'No module named {name!r}', name=name)\n"
        "sys.meta_path.insert(0, Gone())\n"
        "import __spark_entry__ as e\n"
        "assert not [q for q in e.queries() if q.startswith('op') and q[2].isdigit() or q == 'pipeline']\n"
        "assert len(e.queries()) > 90\n"
    )
    subprocess.run([sys.executable, "-c", code], cwd=Path(__file__).parents[2], check=True, timeout=120)
