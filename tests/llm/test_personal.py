"""Personal data against the fixed patterns, and what the method adds."""

import random
import re
import time

from hypothesis import given, settings
from hypothesis import strategies as st

from corploom.llm import personal


def luhn(digits):
    odd = [int(d) for d in digits[-1::-2]]
    even = [sum(divmod(2 * int(d), 10)) for d in digits[-2::-2]]
    return (sum(odd) + sum(even)) % 10 == 0


def digits(m):
    return re.sub("[^0-9]", "", m[0])


PATTERNS = {
    "email": (r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda m: True),
    "ip": (r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda m: all(int(p) <= 255 for p in m[0].split("."))),
    "card": (r"[0-9]([\x20-]?[0-9])+", lambda m: 16 <= len(digits(m)) <= 19 and luhn(digits(m))),
    "phone": (r"\+[0-9][\x20().0-9-]+[0-9]", lambda m: 8 <= len(digits(m)) <= 15),
}


def base(text):
    return [(k, m.start(), m.end()) for k, (p, good) in PATTERNS.items() for m in re.finditer(p, text or "") if good(m)]


def found(text, kinds=personal.BASE):
    return [s for s in personal.spans(text) if s[0] in kinds]


PIECES = ["@", ".", "-", "+", " ", "a", "é", "x.yz", "0", "7", "12", "255", "256", "1.2.3.4", "4111 1111 1111 1111", "(", ")", "a@b.cd", "%", "_", "\n", "00", "+1 (974) 555-3436"]


@settings(max_examples=1500, deadline=None)
@given(st.lists(st.sampled_from(PIECES), max_size=25).map("".join))
def test_base_spans_are_the_patterns(text):
    assert found(text) == base(text)


def test_numbers_with_check_digits():
    r = random.Random(5)
    for _ in range(3000):
        text = "".join(r.choice(DIGITS) + r.choice(["", "", "", " ", "-", "  "]) for _ in range(r.randint(14, 40)))
        assert found(text) == base(text)


DIGITS = "0123456789"


def test_added_kinds():
    cases = {
        "imail": [("jörg.ö@exämple.de", True), ("größe@mail.example.com,", True), (".ö@x.de", False), ("ö@x", False), ("a@b.de", False), ("ö@-x.de", False)],
        "login": [("ftp://user:pw@host.example:21/x", True), ("https://example.com/a@b", False), ("://a@b", False)],
        "tel": [("tel:0123 456-789", True), ("TEL: 030/1", False), ("hotel:0123456789", False)],
        "iban": [("IBAN: DE89 3704 0044 0532 0130 00", True), ("IBAN: DE89 3704 0044 0532 0130 01", False), ("iban GB82WEST12345698765432.", True)],
        "ssn": [("SSN 078-05-1120", True), ("ssn 078-05-11201", False)],
        "account": [("Account no. 12345678", True), ("account 12", False), ("account of 12345678", False)],
        "secret": [('token = "04dbebab91ab85687d33eeaa"', True), ("token = aaaaaaaaaaaaaaaaaaaaaaa", False), ("Password: hunter2!", True), ("password", False)],
    }
    for kind, texts in cases.items():
        for text, good in texts:
            assert bool(found(f"é {text} z", (kind,))) == good, text
    (span,) = found('é token = "04dbebab91ab85687d33eeaa" z', ("secret",))
    assert 'é token = "04dbebab91ab85687d33eeaa" z'[span[1] : span[2]] == "04dbebab91ab85687d33eeaa"


def test_clean_text_has_no_spans():
    assert personal.spans("A token of thanks: the account was 12 pages, see 3.14 and 10-12, or +5. Secret: none.") == []


def test_masked():
    text = "é a@b.cd, 1.2.3.4!"
    assert personal.masked(text, personal.spans(text)) == "é <email>, <ip>!"
    assert personal.masked("x", []) == "x"


def test_long_texts_are_linear():
    begin = time.perf_counter()
    for text in ("a" * 2_000_000 + "@" + "b" * 2_000_000, "@" * 500_000, "1" * 2_000_000, "1." * 500_000, "+1" * 300_000, "+1 " * 300_000, "a@b.c" * 200_000, "1 " * 500_000, "a" * 1_000_000 + "@b@" * 10):
        assert len(found(text)) >= 0
    assert time.perf_counter() - begin < 60
    text = "1.2.3.4." * 1000 + " x@y.zz" * 1000
    assert found(text) == base(text)


def test_find(spark):
    r = random.Random(2)
    rows = [(i, "".join(r.choice(PIECES) for _ in range(30)), "x", [1]) for i in range(300)]
    rows += [(None, None, None, None), (7, "", "m", []), rows[3], rows[3], (9, "z" * 1_200_000 + " a@b.cd", "m", [])]
    docs = spark.createDataFrame(rows, "doc_id long, text string, masked string, spans array<int>")
    got = personal.find(docs, mask=True).collect()
    want = sorted((repr((row[0], row[1])), repr(personal.spans(row[1])), repr(personal.masked(row[1], personal.spans(row[1])))) for row in rows)
    assert sorted((repr((g["doc_id"], g["text"])), repr([tuple(s) for s in g["spans"]]), repr(g["masked"])) for g in got) == want
    assert personal.find(docs).columns == ["doc_id", "text", "masked", "spans"]
    assert personal.find(docs.limit(0)).collect() == []
    only = spark.createDataFrame([("a@b.cd",)], "spans string")
    assert [tuple(s) for s in personal.find(only, "spans").first()["spans"]] == [("email", 0, 6)]


def test_query_columns(spark, tmp_path):
    from corploom.llm import queries

    rows = [(1, "a@b.cd +1 (974) 555-3436 tel:0123 456-789"), (2, None), (3, "1.2.3.4 5.6.7.8"), (None, "")]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    import hashlib

    got = {r["doc_id"]: r for r in queries.op11_personal_data(spark, str(tmp_path)).collect()}
    for key, text in rows:
        row, want = got[key], base(text)
        assert [row[f"n_{k}"] for k in personal.BASE] == [sum(s[0] == k for s in want) for k in personal.BASE]
        assert row["base_sha256"] == hashlib.sha256(",".join(":".join(map(str, s)) for s in want).encode()).hexdigest()
        assert row["spans"] == ",".join(":".join(map(str, s)) for s in personal.spans(text))
