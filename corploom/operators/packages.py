"""Audit of project packages: many packages as rows (package, name, content)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corploom.functions import text as tx

# What a package must hold, and the texts of the findings.
REQUIRED_FILES = ["README.md", "DATA_CARD.md", "EVAL_REPORT.md", "sources.csv"]
SOURCE_COLUMNS = ["title", "url", "type", "license_or_access", "notes"]
TASK_FILES = "исправить отсутствующие или пустые обязательные файлы"
TASK_LICENSES = "уточнить лицензии в sources.csv"
TASK_PLACEHOLDERS = "заменить placeholder-описания в README.md"
TASK_REVIEW = "запланировать ручную проверку носителем/экспертом"
DONE, OPEN = "готово", "нужно доработать"
ARTIFACTS = [
    ("README", "README.md", "уточнить цель и пользователей"),
    ("sources.csv", "sources.csv", "добавить реальные лицензии"),
    ("DATA_CARD", "DATA_CARD.md", "описать ограничения"),
    ("EVAL_REPORT", "EVAL_REPORT.md", "добавить примеры ошибок"),
]
LICENSE_WORDS = ["license", "licence", "лиценз"]
TEST_SET_WORDS = ["test set", "тестов"]

def csv_records(content: Column) -> Column:
    """Records of a CSV text as array<array<string>>, cells trimmed; quoted cells may hold commas, line breaks and doubled quotes.

    Cut at its quotes, the text has quoted parts at every second place; an empty part between two
    quoted ones is a doubled quote. Commas and line breaks of quoted parts are put aside while
    records and cells are cut, so the work is linear. A quote that is never closed takes the rest
    of the text. Control characters 1 and 2 are dropped; records without any text stay.
    """
    parts = F.split(F.translate(content, "\x01\x02\r", ""), '"')
    kept = tx.let(
        parts,
        lambda p: F.transform(
            p,
            lambda s, i: F.when(i % 2 == 1, F.translate(s, ",\n", "\x01\x02"))
            .when((s == "") & (i > 0) & (i < F.size(p) - 1), F.lit('"'))
            .otherwise(s),
        ),
    )
    records = F.split(F.array_join(kept, ""), "\n")
    return F.transform(records, lambda r: F.transform(F.split(r, ","), lambda c: F.trim(F.translate(c, "\x01\x02", ",\n"))))


def _by_name(value: str) -> Column:
    """Map of the required files to the largest value; a name may occur more than once, a missing one has null."""
    return F.create_map(*[c for n in REQUIRED_FILES for c in (F.lit(n), F.max(F.when(F.col("name") == n, F.col(value))))])


def overview(files: DataFrame) -> DataFrame:
    """One row per package with the few facts all rules need; contents stay behind in the scan."""
    body, low = F.col("content"), F.lower(F.col("content"))
    name = F.col("name")
    # Only the list of sources is read as a table, once.
    rows = F.col("_csv.rows")
    header = F.try_element_at(rows, F.lit(1))
    at = F.array_position(header, F.lit("license_or_access")).cast("int")
    cell = lambda record, i: F.lower(F.coalesce(F.try_element_at(record, F.nullif(i, F.lit(0))), F.lit("")))
    data = F.slice(rows, F.lit(2), F.greatest(F.size(rows) - 1, F.lit(0)))
    unknown = tx.let(at, lambda i: F.exists(data, lambda record: F.contains(cell(record, i), F.lit("unknown"))))
    unknown = F.coalesce(unknown, F.lit(False))
    facts = files.select(
        "package", "name", "content", tx.computed_once(rows=F.when(name == "sources.csv", csv_records(body))).alias("_csv")
    ).select(
        "package",
        "name",
        F.length(body).alias("chars"),
        F.length(F.regexp_replace(body, rf"(?U)^[{tx.SPACE_CLASS}]+|[{tx.SPACE_CLASS}]+$", "")).alias("trimmed"),
        F.when(name == "sources.csv", header).alias("columns"),
        ((name == "sources.csv") & unknown).alias("unknown_license"),
        ((name == "README.md") & F.contains(low, F.lit("replace"))).alias("placeholder"),
        (
            (name == "DATA_CARD.md") & (F.contains(low, F.lit("human review")) | F.contains(low, F.lit("needs")))
        ).alias("wants_review"),
    ).filter(name.isin(*REQUIRED_FILES))
    return files.groupBy("package").agg(F.count("*").alias("files")).join(
        facts.groupBy("package").agg(
            _by_name("chars").alias("chars"),
            _by_name("trimmed").alias("trimmed"),
            F.first("columns", ignorenulls=True).alias("columns"),
            F.bool_or("unknown_license").alias("unknown_license"),
            F.bool_or("placeholder").alias("placeholder"),
            F.bool_or("wants_review").alias("wants_review"),
        ),
        "package",
        "left",
    )


def checks(seen: DataFrame) -> DataFrame:
    """Check rows: file exists, file is not empty (only when it exists), source columns present."""

    def one(check: str, ok: Column, details: Column) -> Column:
        return F.struct(F.lit(check).alias("check"), F.coalesce(ok, F.lit(False)).alias("ok"), details.alias("details"))

    rows = []
    for name in REQUIRED_FILES:
        size = F.try_element_at("chars", F.lit(name))
        path = F.concat_ws("/", "package", F.lit(name))
        rows.append(one(f"{name} exists", size.isNotNull(), path))
        full = one(f"{name} is not empty", F.try_element_at("trimmed", F.lit(name)) > 40, F.concat(size.cast("string"), F.lit(" chars")))
        rows.append(F.when(size.isNotNull(), full))
    for column in SOURCE_COLUMNS:
        rows.append(one(f"sources.csv has column {column}", F.array_contains("columns", column), F.lit("")))
    return seen.select("package", F.explode(F.array_compact(F.array(*rows))).alias("c")).select("package", "c.*")


def publication_tasks(seen: DataFrame, checked: DataFrame) -> DataFrame:
    """Tasks before publication; a package without any is ready."""
    all_ok = checked.groupBy("package").agg(F.bool_and("ok").alias("all_ok"))
    flag = lambda c: F.coalesce(F.col(c), F.lit(False))
    tasks = F.array_compact(
        F.array(
            F.when(~flag("all_ok"), TASK_FILES),
            F.when(flag("unknown_license"), TASK_LICENSES),
            F.when(flag("placeholder"), TASK_PLACEHOLDERS),
            F.when(flag("wants_review"), TASK_REVIEW),
        )
    )
    return seen.join(all_ok, "package", "left").select(
        "package", (F.size(tasks) == 0).alias("package_ready"), tasks.alias("tasks_before_publication")
    )


def status_table(seen: DataFrame) -> DataFrame:
    def status(name: str) -> Column:
        if name == "sources.csv":
            ok = F.try_element_at("chars", F.lit(name)).isNotNull()
        else:
            ok = F.try_element_at("trimmed", F.lit(name)) > 40
        return F.when(ok, DONE).otherwise(OPEN)

    rows = F.array(
        *[F.struct(F.lit(a).alias("artifact"), status(n).alias("status"), F.lit(s).alias("next_step")) for a, n, s in ARTIFACTS]
    )
    return seen.select("package", F.explode(rows).alias("r")).select("package", "r.*")


def promises(files: DataFrame) -> DataFrame:
    """Broken promises: files named in the README but absent, a card without licence, a report without test set."""
    low = F.lower(F.col("content"))
    named = F.array_distinct(F.regexp_extract_all("content", F.lit(r"([A-Za-z0-9_\-]+\.(?:md|csv|tsv|jsonl|json|txt|yaml|py))"), F.lit(1)))
    promised = files.filter("name = 'README.md'").select("package", F.explode(named).alias("name"))
    missing = promised.join(files.select("package", "name"), ["package", "name"], "left_anti").select(
        "package", F.concat(F.lit("missing file: "), "name").alias("finding")
    )

    def lacks(name: str, words: list[str], finding: str) -> DataFrame:
        has = F.exists(F.array(*[F.lit(w) for w in words]), lambda w: F.contains(low, w))
        return files.filter((F.col("name") == name) & ~has).select("package", F.lit(finding).alias("finding"))

    return missing.unionByName(lacks("DATA_CARD.md", LICENSE_WORDS, "data card without license")).unionByName(
        lacks("EVAL_REPORT.md", TEST_SET_WORDS, "report without test set")
    )
