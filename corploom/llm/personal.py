"""Personal data by anchors: an Aho-Corasick automaton finds them, local parsers expand and validate each."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from functools import cache

import ahocorasick
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corploom.llm import words as W

# Kinds in the order of results: those of the fixed definitions, then what the method adds.
BASE = ("email", "ip", "card", "phone")
ADDED = ("imail", "login", "tel", "iban", "ssn", "account", "secret")
SPAN = "struct<kind: string, start: int, end: int>"
_SPAN = pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())])

DIGITS = "0123456789"
# Cues of identifiers; each also stands with a capital and in capitals.
SCHEME_CUES = ("tel:",)
ACCOUNT_CUES = ("iban", "ssn", "account", "acct", "konto")
SECRET_CUES = ("token", "secret", "apikey", "api_key", "api-key", "access_key", "password", "passwd")

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_WIDE_DOMAIN = re.compile(r"(?:[^\W_]|-)+(?:\.(?:[^\W_]|-)+)+")
_DOTTED = re.compile(r"[0-9]+(?:\.[0-9]+)+")
_CHAIN = re.compile(r"[0-9](?:[ -]?[0-9])+")
_DIALLED = re.compile(r"[ ().0-9-]*")
_USER = re.compile(r"[^\s/?#@\\\"'<>]+@")
_HOST = re.compile(r"(?:[^\W_]|[.-])+(?::[0-9]+)?")
_GIVEN = re.compile(r"[ \t]{0,3}(?:(?:no|nr|number)\b\.?)?[ \t]{0,3}[:#=]?[ \t]{0,3}")
_IBAN = re.compile(r"[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]){11,30}(?![A-Za-z0-9])")
_SSN = re.compile(r"[0-9]{3}[- ]?[0-9]{2}[- ]?[0-9]{4}(?![0-9])")
_ACCOUNT = re.compile(r"[0-9](?:[ -]?[0-9]){6,19}(?![0-9])")
_SECRET = re.compile(r"[ \t]{0,3}[=:][ \t]{0,3}[\"']?([A-Za-z0-9_+/=.~-]{16,})")
_PASSWORD = re.compile(r"[ \t]{0,3}[=:][ \t]{0,3}[\"']?([^\s\"']{6,})")


def luhn(digits: str) -> bool:
    """Whether the digits end with their check digit."""
    total = 0
    for i, d in enumerate(reversed(digits)):
        value = ord(d) - 48
        total += value if i % 2 == 0 else value * 2 - 9 * (value > 4)
    return total % 10 == 0


def _small(part: str) -> bool:
    part = part.lstrip("0")
    return len(part) <= 3 and int(part or "0") <= 255


def _digits(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


class _Scan:
    """The spans of one text; `past` holds, by kind, where the next span may begin."""

    def __init__(self, text: str) -> None:
        self.text, self.past = text, dict.fromkeys((*BASE, *ADDED), 0)
        self.found: dict[str, list[tuple[int, int]]] = {k: [] for k in self.past}

    def keep(self, kind: str, start: int, end: int) -> None:
        if start >= self.past[kind]:
            self.found[kind].append((start, end))
            self.past[kind] = end

    def at_sign(self, start: int, end: int) -> None:
        """An address around an at-sign: the local part as far left as it goes, the labels as far right."""
        text, low = self.text, self.past["email"]
        begin = start
        while begin > low and text[begin - 1] in _LOCAL:
            begin -= 1
        domain = _DOMAIN.match(text, end)
        if begin < start and domain:
            self.keep("email", begin, domain.end())
        wide, low = start, self.past["imail"]
        while wide > low and (text[wide - 1] in _LOCAL or text[wide - 1].isalnum()):
            wide -= 1
        domain = _WIDE_DOMAIN.match(text, end)
        if wide < start and domain and not text[wide : domain.end()].isascii():
            labels = domain[0].split(".")
            whole = text[wide] != "." and text[start - 1] != "."
            if whole and len(labels[-1]) > 1 and labels[-1].isalpha() and not any(x[0] == "-" or x[-1] == "-" for x in labels):
                self.keep("imail", wide, domain.end())

    def dotted(self, start: int, end: int) -> None:
        """Addresses in a chain of numbers and dots: each four numbers are one, good or not."""
        if start < self.past["ip"]:
            return
        low = self.past["ip"]
        while start > low and "0" <= self.text[start - 1] <= "9":
            start -= 1
        chain = _DOTTED.match(self.text, start)
        parts, at = chain[0].split("."), start
        for i in range(0, len(parts) - 3, 4):
            four = parts[i : i + 4]
            width = sum(map(len, four)) + 3
            if all(map(_small, four)):
                self.found["ip"].append((at, at + width))
            at += width + 1
        self.past["ip"] = chain.end()

    def number(self, start: int, end: int) -> None:
        """The whole chain of digits with single blanks or hyphens between them."""
        if start < self.past["card"]:
            return
        chain = _CHAIN.match(self.text, start)
        digits = _digits(chain[0]) if len(chain[0]) < 40 else ""
        if 16 <= len(digits) <= 19 and luhn(digits):
            self.found["card"].append(chain.span())
        self.past["card"] = chain.end()

    def plus(self, start: int, end: int) -> None:
        """A plus, a digit, and dialled characters up to the last digit."""
        run = _DIALLED.match(self.text, end)[0].rstrip(" ().-")
        if len(run) > 1 and 8 <= 1 + len(_digits(run)) <= 15:
            self.keep("phone", start, end + len(run))

    def scheme(self, start: int, end: int) -> None:
        """An address with a user before its host."""
        user = _USER.match(self.text, end)
        host = user and _HOST.match(self.text, user.end())
        begin, low = start, self.past["login"]
        while begin > low and self.text[begin - 1].isascii() and (self.text[begin - 1].isalnum() or self.text[begin - 1] in "+.-"):
            begin -= 1
        if host and begin < start and self.text[begin].isalpha():
            self.keep("login", begin, host.end())

    def call(self, start: int, end: int) -> None:
        run = _DIALLED.match(self.text, end)[0].rstrip(" ().-")
        if run and 7 <= len(_digits(run)) <= 15 and self._begins(start):
            first = next(i for i, c in enumerate(run) if c in DIGITS)
            self.keep("tel", end + first, end + len(run))

    def account(self, start: int, end: int) -> None:
        """The identifier that follows its cue, by the form and check digits of its kind."""
        cue = self.text[start:end].lower()
        at = _GIVEN.match(self.text, end).end()
        if not self._begins(start) or at == end:
            return
        if cue == "iban":
            found = _IBAN.match(self.text, at)
            if found:
                plain = found[0].replace(" ", "")
                if int("".join(str(int(c, 36)) for c in plain[4:] + plain[:4])) % 97 == 1:
                    self.keep("iban", *found.span())
        elif found := (_SSN if cue == "ssn" else _ACCOUNT).match(self.text, at):
            self.keep("ssn" if cue == "ssn" else "account", *found.span())

    def secret(self, start: int, end: int) -> None:
        """The value that a cue assigns, of letters and digits if it is no password."""
        password = self.text[start:end].lower().startswith("pass")
        found = (_PASSWORD if password else _SECRET).match(self.text, end)
        if found and (password or re.search("[0-9]", found[1]) and re.search("[A-Za-z]", found[1])):
            self.keep("secret", *found.span(1))

    def _begins(self, start: int) -> bool:
        return start == 0 or not self.text[start - 1].isalnum()


@cache
def _automaton() -> ahocorasick.Automaton:
    """All anchors, each with its parser and its length."""
    anchors: dict[str, Callable] = {"@": _Scan.at_sign, "://": _Scan.scheme}
    anchors |= {f"+{d}": _Scan.plus for d in DIGITS} | {f"{a}.{b}": _Scan.dotted for a in DIGITS for b in DIGITS}
    anchors |= {f"{a}{s}{b}": _Scan.number for a in DIGITS for s in ("", " ", "-") for b in DIGITS}
    for cues, parser in ((SCHEME_CUES, _Scan.call), (ACCOUNT_CUES, _Scan.account), (SECRET_CUES, _Scan.secret)):
        anchors |= {form: parser for cue in cues for form in (cue, cue.capitalize(), cue.upper())}
    automaton = ahocorasick.Automaton()
    for anchor, parser in anchors.items():
        automaton.add_word(anchor, (parser, len(anchor)))
    automaton.make_automaton()
    return automaton


def spans(text: str | None) -> list[tuple[str, int, int]]:
    """(kind, start, end) in code points, by kind in the order of BASE and ADDED, then by start."""
    if not text:
        return []
    scan = _Scan(text)
    for last, (parser, width) in _automaton().iter(text):
        parser(scan, last + 1 - width, last + 1)
    return [(kind, start, end) for kind, places in scan.found.items() for start, end in places]


def masked(text: str | None, found: list[tuple[str, int, int]]) -> str | None:
    """The text with each span, or run of spans that overlap, replaced by its first kind in angle brackets."""
    out, at = [], 0
    for kind, start, end in sorted(found, key=lambda s: (s[1], -s[2])):
        if start >= at:
            out += [text[at:start], f"<{kind}>"]
        at = max(at, end)
    return text if not found else "".join([*out, text[at:]])


def find(docs: DataFrame, text: str = "text", mask: bool = False) -> DataFrame:
    """The columns of `docs` plus `spans`, and with `mask` the text without them as `masked`.

    Base kinds are the leftmost non-overlapping matches of fixed patterns (see `BASE` and the
    tests); a match that fails its check (numbers over 255, wrong check digit, too few or many digits)
    is dropped and its text is not tried again. `ADDED` kinds overlap no span of their own kind, but
    may overlap others: addresses with letters beyond ASCII (imail), addresses with a user before
    the host (login), numbers after `tel:`, bank accounts with right check digits (iban), numbers after
    the cues ssn and account, values after secret cues. Work is linear in the text, whose
    batches are scanned in slices of about 512 KB; a longer text is a slice of its own, whole.

    A null or empty text has no spans (masked null or empty); repeated rows are judged alike; an empty
    table gives no rows; columns of `docs` named like the results are replaced.
    """
    results = ("spans", "masked") if mask else ("spans",)
    kept = [c for c in docs.columns if c not in results or c == text]
    place = kept.index(text)
    names = [*[c if c not in results else f"_{c}" for c in kept], *results]
    rows = docs.select(*[F.col(f"`{c}`").alias(n) for c, n in zip(kept, names, strict=False)])
    schema = T.StructType([*rows.schema.fields, *T.StructType.fromDDL(f"spans array<{SPAN}>" + ", masked string" * mask).fields])

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in W.text_slices(batch, place):
                texts = part.column(place).to_pylist()
                found = [spans(t) for t in texts]
                columns = [*part.columns, pa.array([[dict(zip(("kind", "start", "end"), s, strict=True)) for s in f] for f in found], pa.list_(_SPAN))]
                if mask:
                    columns.append(pa.array([masked(t, f) for t, f in zip(texts, found, strict=True)], pa.string()))
                yield pa.RecordBatch.from_arrays(columns, schema.names)

    return rows.mapInArrow(scan, schema).select(*names)


def count(found: Column, kind: str) -> Column:
    return F.size(F.filter(found, lambda s: s["kind"] == kind)).cast("long")


def listed(found: Column, kinds: tuple[str, ...] = BASE + ADDED) -> Column:
    """kind:start:end of the spans of these kinds, comma-joined in their order."""
    own = F.filter(found, lambda s: s["kind"].isin(*kinds))
    return F.array_join(F.transform(own, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")
