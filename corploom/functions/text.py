"""Column builders for text measures (all built-in expressions, no Python per row).

A script is given as the body of a regex character class, so that the same
builder serves Cyrillic corpora, Latin ones, or any other.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Script classes and allow-lists that results are compared on.
CYRILLIC = "А-Яа-яЁёӐ-ӿ"
CYRILLIC_EXTENDED = "А-Яа-яЁёӜӝӞӟӤӥӦӧӴӵӸӹІіЇїЄєЎўҐґ"
LATIN = "A-Za-z"
LATIN_WIDE = "A-Za-zÀ-ÖØ-öø-ÿ"
OCR_PUNCTUATION = r"0-9\s\x1c-\x1f.,:;!?()\-—\"«»"
PROSE_PUNCTUATION = r"\s\x1c-\x1f.,:;!?()\-«»\"'/"

WORD_CLASS = r"\p{L}\p{N}_"
WORD = f"[{WORD_CLASS}]+"
# Java's \s is ASCII; Python's also takes NBSP and U+001C..U+001F.
SPACE_CLASS = r"\s\x1c-\x1f"
LINE_BREAKS = r"\n\r\x0b\x0c\x1c-\x1e\x{85}\x{2028}\x{2029}"
# All other characters, as ranges: Java runs a negated class of several ranges many times slower.
IN_LINE = r"\x00-\x09\x0e-\x1b\x1f-\x{84}\x{86}-\x{2027}\x{202a}-\x{10ffff}"


def normalize_space(text: Column) -> Column:
    return F.trim(F.regexp_replace(text, rf"(?U)[{SPACE_CLASS}]+", " "))


def class_count(text: Column, chars: str) -> Column:
    """How many characters fall in the class: by how much the text is shorter without them."""
    return F.length(text) - F.length(F.regexp_replace(text, f"[{chars}]+", ""))


def outside_count(text: Column, chars: str) -> Column:
    return F.length(F.regexp_replace(text, f"(?U)[{chars}]+", ""))


def token_count(text: Column) -> Column:
    return F.regexp_count(text, F.lit(WORD))


def tokens(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(WORD), F.lit(0))


def whitespace_token_count(text: Column) -> Column:
    return F.regexp_count(text, F.lit(rf"(?U)[^{SPACE_CLASS}]+"))


def char_share(text: Column, chars: str) -> Column:
    """Share of the class over all characters; 0 for an empty text."""
    return class_count(text, chars) / F.greatest(F.length(text), F.lit(1))


def outside_share(text: Column, chars: str) -> Column:
    return outside_count(text, chars) / F.greatest(F.length(text), F.lit(1))


def letter_share(text: Column, chars: str, letters: str) -> Column:
    """Share of the class over the letters only, three digits; 0.0 without letters."""
    total = class_count(text, letters)
    return F.coalesce(F.round(class_count(text, chars) / F.nullif(total, F.lit(0)), 3), F.lit(0.0))


def joined_words(text: Column) -> Column:
    """The lower-cased words, joined by one space."""
    return F.trim(F.regexp_replace(F.lower(text), f"[^{WORD_CLASS}]+", " "))


def word_ngrams(text: Column, width: int) -> Column:
    """Overlapping runs of `width` lower-cased words, in one linear scan of the text."""
    pattern = f"(?<![^ ])(?=([^ ]+(?: [^ ]+){{{width - 1}}}))"
    return F.regexp_extract_all(joined_words(text), F.lit(pattern), F.lit(1))


def computed_once(**measures: Column) -> Column:
    """Measures as one struct behind a generator: a later filter on one is not copied below it and computed again."""
    return F.explode_outer(F.array_repeat(F.struct(*[c.alias(n) for n, c in measures.items()]), 1))


def let(value: Column, body) -> Column:
    """Bind a value once for use inside a lambda, which would compute it again per element."""
    return F.element_at(F.transform(F.array(value), body), 1)


def script_tokens(text: Column, chars: str, at_least: int = 2) -> Column:
    return F.regexp_extract_all(text, F.lit(f"([{chars}]{{{at_least},}})"), F.lit(1))


def unique_lower_count(words: Column) -> Column:
    """Number of different words, case apart; one lower() over the joined words, no branch that repeats them."""
    folded = F.array_distinct(F.split(F.lower(F.array_join(words, " ")), " "))
    return F.size(F.array_remove(folded, ""))


def short_token_count(text: Column, longest: int = 2) -> Column:
    pattern = rf"(?<![{WORD_CLASS}])[{WORD_CLASS}]{{1,{longest}}}(?![{WORD_CLASS}])"
    return F.regexp_count(F.lower(text), F.lit(pattern))


def short_token_share(text: Column, longest: int = 2) -> Column:
    n = F.greatest(token_count(F.lower(text)), F.lit(1))
    return F.round(short_token_count(text, longest) / n, 3)


def line_count(text: Column) -> Column:
    """Lines with something other than white space: one match runs from the first ink to the line's end."""
    return F.regexp_count(text, F.lit(rf"(?U)[^{SPACE_CLASS}\x{{85}}][{IN_LINE}]*"))


def lines(text: Column) -> Column:
    return F.split(text, rf"\r\n|[{LINE_BREAKS}]")


def preview(text: Column, n: int) -> Column:
    return F.substring(text, 1, n)


def text_hash(text: Column) -> Column:
    return F.sha2(text, 256)


def hash_fraction(*parts: Column | str, seed: int = 0) -> Column:
    """A repeatable number in [0, 1) from md5 of seed and parts (52 bits, exact as a double)."""
    return hash_number(*parts, seed=seed) / F.lit(float(1 << 52))


def hash_number(*parts: Column | str, seed: int = 0) -> Column:
    digest = F.substring(seeded_md5(*parts, seed=seed), 1, 13)
    return F.conv(digest, 16, 10).cast("long")


def seeded_md5(*parts: Column | str, seed: int = 0) -> Column:
    columns = [F.col(p).cast("string") if isinstance(p, str) else p.cast("string") for p in parts]
    return F.md5(F.concat_ws(":", F.lit(str(seed)), *columns))


def as_int(value: Column) -> Column:
    """Empty or null counts as 0; text that is no number gives null."""
    return F.when(F.coalesce(value.cast("string"), F.lit("")) == "", F.lit(0)).otherwise(
        value.try_cast("long")
    )


def bad_int(value: Column) -> Column:
    """True where a value is there but is no whole number."""
    text = F.coalesce(value.cast("string"), F.lit(""))
    return (text != "") & value.try_cast("long").isNull()


def sentences(text: Column) -> Column:
    """Segments ending in . ! ? or a line break, blanks dropped."""
    parts = F.split(text, r"(?<=[.!?…])\s+|\n+")
    # F.trim itself takes a second argument, for which transform would hand it the place.
    return F.filter(F.transform(parts, lambda s: F.trim(s)), lambda s: F.length(s) > 0)
