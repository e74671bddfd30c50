"""Diagnostics of recognised text (scans and speech), review tasks, metadata gates."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corploom.functions import text as tx
from corploom.functions import urls

# Texts of the advice that the rules give.
STEP_NEW_SCAN = "Нужен другой скан или ручная разметка маленького ground truth: baseline почти не читает текст."
STEP_PREPROCESS = "Нужна дополнительная предобработка и проверка символов."
STEP_SAMPLE = "Можно отобрать 30-50 строк для ручной оценки ошибок OCR."
TASK_EMPTY = "OCR почти ничего не извлек: выбрать другой скан или улучшить предобработку."
TASK_SCRIPT = "В тексте много некириллического шума: проверить язык OCR и качество изображения."
TASK_SHORT = "Много коротких фрагментов: нужна ручная проверка строк и сегментации."
TASK_DEFAULT = "Выбрать 20-30 строк и вручную оценить ошибки OCR."


def ocr_diagnostics(df: DataFrame, text: str, script: str) -> DataFrame:
    t = F.col(text)
    words = tx.script_tokens(t, script)
    return (
        df.withColumn("chars", F.length(t))
        .withColumn("script_letters", tx.class_count(t, script))
        .withColumn("tokens_2plus", F.size(words))
        .withColumn("unique_tokens_2plus", tx.unique_lower_count(words))
        .withColumn("weird_char_share", tx.outside_share(t, script + tx.OCR_PUNCTUATION))
    )


def by_version(df: DataFrame, versions: dict[str, Column], out: str = "text") -> DataFrame:
    """One row per version of a text, from one pass over the table."""
    forms = F.array(*[F.struct(F.lit(v).alias("version"), c.alias(out)) for v, c in versions.items()])
    return df.select(*df.columns, F.explode(forms).alias("_f")).select(*[c for c in df.columns if c != out], "_f.*")


def next_step(diagnostics: DataFrame, file_id: str, versions: tuple[str, ...] = ("raw", "preprocessed")) -> DataFrame:
    """Best version per file (most tokens, then fewest odd characters, then the first of `versions`) and the advice for it."""
    place = F.array_position(F.array(*[F.lit(v) for v in versions]), F.col("version"))
    rank = F.struct(F.col("tokens_2plus"), (-F.col("weird_char_share")).alias("clean"), (-place).alias("first"))
    best = diagnostics.groupBy(file_id).agg(
        F.max_by(F.struct("version", "tokens_2plus", "weird_char_share"), rank).alias("b")
    )
    step = (
        F.when(F.col("b.tokens_2plus") < 20, STEP_NEW_SCAN)
        .when(F.col("b.weird_char_share") > 0.1, STEP_PREPROCESS)
        .otherwise(STEP_SAMPLE)
    )
    return best.select(file_id, "b.version", "b.tokens_2plus", step.alias("next_human_step"))


def transcript_stats(df: DataFrame, text: str, script: str, other: str = tx.LATIN) -> DataFrame:
    t = F.col(text)
    return (
        df.withColumn("chars", F.length(t))
        .withColumn("tokens", tx.whitespace_token_count(t))
        .withColumn("script_share", F.round(tx.char_share(t, script), 6))
        .withColumn("latin_share", F.round(tx.char_share(t, other), 6))
    )


def text_diagnostics(df: DataFrame, text: str, script: str, letters: str, sample: int = 700) -> DataFrame:
    t = F.col(text)
    return (
        df.withColumn("chars", F.length(t))
        .withColumn("tokens", tx.token_count(F.lower(t)))
        .withColumn("script_share", tx.letter_share(t, script, letters))
        .withColumn("short_token_share", tx.short_token_share(t))
        .withColumn("weird_char_count", tx.outside_count(t, tx.WORD_CLASS + tx.PROSE_PUNCTUATION + script))
        .withColumn("sample", tx.preview(t, sample))
    )


def review_tasks(diagnosed: DataFrame) -> DataFrame:
    tasks = F.array_compact(
        F.array(
            F.when(F.col("chars") < 100, TASK_EMPTY),
            F.when(F.col("script_share") < 0.7, TASK_SCRIPT),
            F.when(F.col("short_token_share") > 0.45, TASK_SHORT),
        )
    )
    return diagnosed.withColumn("human_tasks", F.when(F.size(tasks) == 0, F.array(F.lit(TASK_DEFAULT))).otherwise(tasks))


def control_pages(df: DataFrame, title: Column, text: str, script: str, letters: str, base: str, size: int = 400) -> DataFrame:
    t = F.col(text)
    return (
        df.withColumn("title", title)
        .withColumn("chars", F.length(t))
        .withColumn("tokens", tx.token_count(F.lower(t)))
        .withColumn("script_share", tx.letter_share(t, script, letters))
        .withColumn("url", urls.title_url(base, F.col("title")))
        .withColumn("extract_preview", tx.preview(t, size))
    )


def pooled_diagnostics(pages: DataFrame, row_id: str, preview: str, script: str, letters: str, sample: int = 700) -> DataFrame:
    """Diagnostics of all previews joined by spaces, without joining them.

    Every measure adds up over the parts (a space breaks tokens); only the sample
    needs text, and its first characters come from the first rows.
    """
    p = F.col(preview)
    lowered = F.lower(p)
    sums = pages.agg(
        (F.sum(F.length(p)) + F.count("*") - 1).alias("chars"),
        F.sum(tx.token_count(lowered)).alias("tokens"),
        F.sum(tx.class_count(p, script)).alias("_script"),
        F.sum(tx.class_count(p, letters)).alias("_letters"),
        F.sum(tx.short_token_count(p)).alias("_short"),
        F.sum(tx.outside_count(p, tx.WORD_CLASS + tx.PROSE_PUNCTUATION + script)).alias("weird_char_count"),
    )
    first = pages.select(row_id, p.alias("p")).orderBy(row_id).limit(sample + 1)
    joined = F.array_join(
        F.transform(F.array_sort(F.collect_list(F.struct(row_id, "p"))), lambda s: s["p"]), " "
    )
    head = first.agg(F.substring(joined, 1, sample)).scalar()
    return sums.select(
        "chars",
        "tokens",
        F.coalesce(F.round(F.col("_script") / F.nullif("_letters", F.lit(0)), 3), F.lit(0.0)).alias("script_share"),
        F.round(F.col("_short") / F.greatest("tokens", F.lit(1)), 3).alias("short_token_share"),
        "weird_char_count",
        head.alias("sample"),
    )


# Cautious post-correction rules (pattern, replacement, name), applied in order.
CORRECTIONS = [
    (r"([A-Za-z])- *\n *([a-z])", "$1$2", "joined_break"),
    (r"!!+", "!", "repeated_mark"),
    (r"[“”„«»]", "\"", "quote"),
    (r"[éèêë]", "e", "letter_e"),
    (r" +([,.;:!?])", "$1", "space_before_mark"),
]


def post_correct(df: DataFrame, text: str, rules: list[tuple[str, str, str]] | None = None) -> DataFrame:
    """Raw text and corrected text side by side, with the number of rule hits."""
    rules = CORRECTIONS if rules is None else rules
    corrected = reduce(lambda c, r: F.regexp_replace(c, r[0], r[1]), rules, F.col(text))
    return df.withColumn("corrected", corrected).withColumn("changed", F.col("corrected") != F.col(text))


def mixed_script_words(df: DataFrame, text: str, script: str, other: str, *keep: str) -> DataFrame:
    """Words that hold letters of both scripts: words are taken in one scan, then each is looked at by itself."""
    both = lambda w: F.rlike(w, F.lit(f"[{other}]")) & F.rlike(w, F.lit(f"[{script}]"))
    return df.select(*keep, F.explode(F.filter(tx.tokens(F.col(text)), both)).alias("word"))


# Recording metadata and the consent and publication levels that allow release.
RECORDING_FIELDS = [
    "speaker_id", "language", "dialect_or_variety", "genre",
    "device", "environment", "consent_status", "publication_level",
]
CONSENT_GIVEN = ["given", "signed"]
PUBLIC_LEVELS = ["public", "research"]


def metadata_gate(df: DataFrame) -> DataFrame:
    """Missing fields per recording, and whether consent and level allow publication."""
    missing = F.array_compact(
        F.array(*[F.when(F.coalesce(F.trim(F.col(c).cast("string")), F.lit("")) == "", F.lit(c)) for c in RECORDING_FIELDS])
    )
    allowed = F.coalesce(F.col("consent_status").isin(*CONSENT_GIVEN), F.lit(False)) & F.coalesce(
        F.col("publication_level").isin(*PUBLIC_LEVELS), F.lit(False)
    )
    return df.withColumn("missing_fields", missing).withColumn("publishable", (F.size(missing) == 0) & allowed)


def line_pairs(df: DataFrame, hypothesis: str, reference: str, *keep: str) -> DataFrame:
    """Line-by-line pairs of two versions of a text; surplus lines face an empty one."""
    zipped = F.arrays_zip(F.split(F.col(hypothesis), "\n").alias("h"), F.split(F.col(reference), "\n").alias("r"))
    return df.select(*keep, F.posexplode(zipped).alias("line_id", "z")).select(
        *keep,
        "line_id",
        F.coalesce("z.h", F.lit("")).alias("recognized_text"),
        F.coalesce("z.r", F.lit("")).alias("correct_text"),
    )
