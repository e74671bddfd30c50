"""Catalogue inventory: corpora summaries, dataset cards, language matches, the inventory table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corploom.functions import text as tx
from corploom.functions import urls
from corploom.operators.dedup import keep_last_by_key
from corploom.operators.lookup import join_keyed, settled

CORPORA_COLUMNS = ["corpus", "source", "target", "alignment_pairs", "documents", "preprocessing", "version"]
PARALLEL_SOURCE = urls.CORPORA_API
MONOLINGUAL_SOURCE = "OPUS monolingual rows; Hugging Face dataset search"


def conform(df: DataFrame, columns: list[str]) -> DataFrame:
    """Exactly these columns; absent ones become ''."""
    return df.select(*[F.col(c) if c in df.columns else F.lit("").alias(c) for c in columns])


def is_parallel(source: Column, target: Column, code: Column, pivot: str = "ru") -> Column:
    pair = F.array_sort(F.array(source, F.coalesce(target, F.lit(""))))
    return pair == F.array_sort(F.array(F.lit(pivot), code))


def is_monolingual(source: Column, target: Column, code: Column) -> Column:
    return (source == code) & (F.coalesce(target, F.lit("")) == "")


def unparsable_numbers(rows: DataFrame, key: str, *columns: str) -> DataFrame:
    """(key, field, value): one row for each cell of `columns` that is there but is no whole number.

    Null and empty cells count as 0 and are no errors; numbers beyond 64 bits are.
    """
    cell = lambda c: F.struct(F.lit(c).alias("field"), F.col(c).cast("string").alias("value"), tx.bad_int(F.col(c)).alias("bad"))
    bad = F.filter(F.array(*[cell(c) for c in columns]), lambda s: s["bad"])
    return rows.select(F.col(key), F.inline(bad)).drop("bad")


def corpora_summary(corpora: DataFrame, code: str, pos: str, pivot: str = "ru") -> DataFrame:
    """Per language code: pairs, documents and a rendered list, for parallel and for mono rows.

    A count that is no number adds nothing, and the list names it; `tx.bad_int` flags such rows.
    """
    pairs, docs = tx.as_int(F.col("alignment_pairs")), tx.as_int(F.col("documents"))
    shown = F.coalesce(pairs.cast("string"), F.concat(F.lit("no number: "), F.col("alignment_pairs").cast("string")))
    item = F.concat(F.col("corpus"), F.lit(" ("), shown, F.lit(")"))
    parallel = F.coalesce(is_parallel(F.col("source"), F.col("target"), F.col(code), pivot), F.lit(False))
    mono = F.coalesce(is_monolingual(F.col("source"), F.col("target"), F.col(code)), F.lit(False))

    def part(mask: Column, names: tuple[str, str, str]) -> list[Column]:
        listed = F.array_sort(F.collect_list(F.when(mask, F.struct(F.col(pos), item.alias("item")))))
        return [
            F.coalesce(F.sum(F.when(mask, pairs)), F.lit(0)).alias(names[0]),
            F.coalesce(F.sum(F.when(mask, docs)), F.lit(0)).alias(names[1]),
            F.array_join(F.transform(listed, lambda s: s["item"]), "; ").alias(names[2]),
        ]

    return corpora.groupBy(code).agg(
        *part(parallel, ("ru_parallel_pairs", "ru_parallel_documents", "ru_parallel_corpora")),
        *part(mono, ("mono_pairs_or_segments", "mono_documents", "mono_corpora")),
    )


def corpora_totals(corpora: DataFrame, answer: str, pos: str) -> DataFrame:
    """Totals of each answer as a whole, without the language filter; list items keep the raw count."""
    item = F.concat(F.col("corpus"), F.lit(" ("), F.col("alignment_pairs").cast("string"), F.lit(")"))
    listed = F.array_sort(F.collect_list(F.struct(F.col(pos), item.alias("item"))))
    return corpora.groupBy(answer).agg(
        F.sum(tx.as_int(F.col("alignment_pairs"))).alias("pairs"),
        F.sum(tx.as_int(F.col("documents"))).alias("documents"),
        F.array_join(F.transform(listed, lambda s: s["item"]), "; ").alias("corpora"),
    )


# ---- dataset cards -------------------------------------------------------


def with_prefix(tags: Column, prefix: str) -> Column:
    return F.filter(F.coalesce(tags, F.array().cast("array<string>")), lambda t: F.startswith(t, F.lit(prefix)))


def joined_tags(tags: Column, prefix: str, strip: bool) -> Column:
    found = with_prefix(tags, prefix)
    if strip:
        found = F.transform(found, lambda t: F.replace(t, F.lit(prefix), F.lit("")))
    return F.array_join(found, "; ")


def search_text(card_id: Column, description: Column, tags: Column | None = None) -> Column:
    parts = [F.coalesce(card_id, F.lit("")), F.coalesce(description, F.lit(""))]
    if tags is not None:
        parts.append(F.array_join(F.coalesce(tags, F.array().cast("array<string>")), " "))
    return F.lower(F.concat_ws(" ", *parts))


def dedup_cards(cards: DataFrame) -> DataFrame:
    """One card per id: the last payload at the first position."""
    return keep_last_by_key(cards, "id", "seq", [c for c in cards.columns if c not in ("id", "seq", "pos")])


def brief_table(cards: DataFrame) -> DataFrame:
    return cards.select(
        "id",
        "downloads",
        "likes",
        joined_tags(F.col("tags"), "language:", strip=False).alias("language_tags"),
        joined_tags(F.col("tags"), "size_categories:", strip=True).alias("size_categories"),
        urls.catalogue_page_url(F.coalesce("id", F.lit(""))).alias("url"),
    )


def card_fields(cards: DataFrame) -> DataFrame:
    """Fields out of the nested card: tags, splits, features, first five files."""

    def text(c: Column) -> Column:
        return F.coalesce(c.cast("string"), F.lit("None"))

    info = F.col("cardData")["dataset_info"]
    splits = F.transform(
        info["splits"], lambda s: F.concat(text(s["name"]), F.lit(" ("), text(s["num_examples"]), F.lit(" examples)"))
    )
    features = F.transform(info["features"], lambda f: F.concat(text(f["name"]), F.lit(":"), text(f["dtype"])))
    files = F.transform(F.slice("siblings", 1, 5), lambda s: F.coalesce(s["rfilename"], F.lit("")))

    def rendered(values: Column) -> Column:
        return F.coalesce(F.array_join(values, "; "), F.lit(""))

    return cards.select(
        F.col("id").alias("dataset_id"),
        urls.catalogue_page_url(F.col("id")).alias("page"),
        urls.catalogue_api_url(F.col("id")).alias("api_url"),
        "downloads",
        "likes",
        joined_tags(F.col("tags"), "language:", strip=False).alias("language_tags"),
        joined_tags(F.col("tags"), "size_categories:", strip=True).alias("size_categories"),
        rendered(splits).alias("splits"),
        rendered(features).alias("features"),
        rendered(files).alias("files"),
    )


def looks_ru_parallel(text: Column, tags: Column) -> Column:
    """Broad on purpose: the bare substrings also hit words such as 'walrus-'."""
    hints = [F.contains(text, F.lit(h)) for h in ("russian", "рус", "-rus-", "rus-")]
    hit = F.coalesce(F.array_contains(tags, "language:ru"), F.lit(False))
    for h in hints:
        hit = hit | h
    return hit


def language_tags(language: DataFrame) -> Column:
    """Tags of a language row: its corpus code and its ISO code, empty ones dropped."""
    codes = F.filter(F.array("opus_code", "iso639_3"), lambda c: F.coalesce(c, F.lit("")) != "")
    return F.array_distinct(F.transform(codes, lambda c: F.concat(F.lit("language:"), c)))


def name_parts(languages: DataFrame) -> DataFrame:
    """(iso639_3, part, first_token, pattern): searchable parts of the names, four letters or more."""
    names = F.array(F.lower("language_en"), F.lower("language_ru"))
    parts = F.flatten(F.transform(F.filter(names, lambda n: n.isNotNull()), lambda n: F.split(n, r"(?U)\s*/\s*|\s+-\s+")))
    rows = languages.select("iso639_3", F.explode(F.array_distinct(F.transform(parts, lambda p: F.trim(p)))).alias("part"))
    rows = rows.filter(F.length("part") >= 4)
    escaped = F.regexp_replace("part", r"([\\.\[\]{}()*+?^$|\-])", r"\\$1")
    return rows.select(
        "iso639_3",
        "part",
        F.regexp_extract("part", tx.WORD, 0).alias("first_token"),
        F.concat(F.lit(r"(?U)(?<![\w-])"), escaped, F.lit(r"(?![\w-])")).alias("pattern"),
    )


def card_matches(cards: DataFrame, languages: DataFrame) -> DataFrame:
    """(iso639_3, id, named, ...): cards tagged with a language or naming it as a whole phrase.

    Tag matches are an equi-join. For names, a card's tokens are intersected with the
    first tokens of all names (one array: ISO 639-3 has fewer than 8,000 codes), and
    only those hits are exploded, joined and verified.
    """
    facts = cards.select(
        "id",
        "pos",
        "tags",
        F.coalesce("downloads", F.lit(0)).cast("long").alias("downloads"),
        search_text(F.col("id"), F.col("description"), F.col("tags")).alias("text"),
        search_text(F.col("id"), F.col("description")).alias("own_text"),
    )
    small = facts.select("id", "pos", "downloads", "tags", looks_ru_parallel(F.col("text"), F.col("tags")).alias("ru"))
    wanted = languages.select("iso639_3", F.explode(language_tags(languages)).alias("tag"))
    tag_rows = small.withColumn("tag", F.explode(F.array_distinct("tags")))
    tagged = (
        join_keyed(tag_rows, wanted, "tag", F.col("id"))
        .select("iso639_3", "id", "pos", "downloads", "tags", "ru", F.lit(False).alias("named"))
    )
    parts = name_parts(languages)
    heads = parts.agg(F.array_distinct(F.collect_list("first_token"))).scalar()
    hits = F.array_intersect(tx.tokens(F.col("text")), heads)
    mentioned = (
        join_keyed(facts.withColumn("first_token", F.explode(hits)), parts, "first_token", F.col("id"))
        .filter(F.rlike("text", F.col("pattern")))
        .select(
            "iso639_3",
            "id",
            "pos",
            "downloads",
            "tags",
            looks_ru_parallel(F.col("text"), F.col("tags")).alias("ru"),
            F.rlike("own_text", F.col("pattern")).alias("named"),
        )
    )
    return tagged.unionByName(mentioned).groupBy("iso639_3", "id").agg(
        F.max("pos").alias("pos"),
        F.max("downloads").alias("downloads"),
        F.any_value("tags").alias("tags"),
        F.bool_or("ru").alias("ru_parallel"),
        F.bool_or("named").alias("named"),
    )


def specificity(named: Column, tags: Column) -> Column:
    """2 = names the language itself, 1 = at most five language tags, 0 = broad collection."""
    distinct_tags = F.size(F.array_distinct(with_prefix(tags, "language:")))
    return F.when(named, 2).when(distinct_tags <= 5, 1).otherwise(0)


def top_cards(matches: DataFrame, size: int = 5) -> DataFrame:
    """Best cards per language; the window's group limit drops the rest before the shuffle."""
    scored = matches.withColumn("score", specificity(F.col("named"), F.col("tags")))
    order = Window.partitionBy("iso639_3").orderBy(F.desc("score"), F.desc("downloads"), "pos")
    return scored.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= size)


def size_categories(matches: DataFrame) -> DataFrame:
    """Different size categories per language, sorted and joined."""
    pairs = (
        matches.select("iso639_3", F.explode(with_prefix(F.col("tags"), "size_categories:")).alias("tag"))
        .select("iso639_3", F.replace("tag", F.lit("size_categories:"), F.lit("")).alias("category"))
        .distinct()
    )
    return pairs.groupBy("iso639_3").agg(
        F.array_join(F.array_sort(F.collect_list("category")), "; ").alias("size_categories")
    )


def card_summary(matches: DataFrame, query_log: DataFrame) -> DataFrame:
    """Per language: queries tried and answered, cards, parallel candidates, downloads, top five, sizes."""
    matches = settled(matches)  # read three times; ids and flags only
    log = query_log.groupBy("iso639_3").agg(
        F.count("*").alias("query_attempts"), F.count_if(F.col("error").isNull()).alias("query_successes")
    )
    counts = matches.groupBy("iso639_3").agg(
        F.count("*").alias("dataset_count"),
        F.count_if("ru_parallel").alias("ru_parallel_candidates"),
        F.sum("downloads").alias("downloads_sum"),
    )
    top = top_cards(matches).groupBy("iso639_3").agg(
        F.array_join(
            F.transform(F.array_sort(F.collect_list(F.struct("rank", "id"))), lambda s: s["id"]), "; "
        ).alias("top_datasets")
    )
    joined = log.join(counts, "iso639_3", "left").join(top, "iso639_3", "left").join(
        size_categories(matches), "iso639_3", "left"
    )
    return joined.select(
        "iso639_3",
        (F.col("query_successes") > 0).alias("hf_checked"),
        F.col("query_attempts").alias("hf_query_attempts"),
        F.col("query_successes").alias("hf_query_successes"),
        F.coalesce("dataset_count", F.lit(0)).alias("hf_dataset_count"),
        F.coalesce("ru_parallel_candidates", F.lit(0)).alias("hf_ru_parallel_candidates"),
        F.coalesce("top_datasets", F.lit("")).alias("hf_top_datasets"),
        F.coalesce("downloads_sum", F.lit(0)).alias("hf_downloads_sum"),
        F.coalesce("size_categories", F.lit("")).alias("hf_size_categories"),
    )


def query_log(languages: DataFrame) -> DataFrame:
    """The queries each language calls for: one per tag, one per name."""
    tagged = F.transform(language_tags(languages), lambda t: F.struct(F.lit("filter").alias("query_type"), t.alias("query")))
    named = F.transform(
        F.filter(F.array("language_en", "language_ru"), lambda n: F.coalesce(n, F.lit("")) != ""),
        lambda n: F.struct(F.lit("search").alias("query_type"), n.alias("query")),
    )
    return languages.select("iso639_3", F.explode(F.concat(tagged, named)).alias("q")).select("iso639_3", "q.*")


# ---- pairs ---------------------------------------------------------------


def pair_terms(pairs: DataFrame) -> DataFrame:
    """Six search terms per language pair (columns l_*, r_*); terms with a missing code are dropped."""
    terms = F.array(
        *[
            F.concat(F.col(f"{a}_{field}"), F.lit(sep), F.col(f"{b}_{field}"))
            for field, sep in (("language_en", " "), ("iso639_3", "-"), ("opus_code", "-"))
            for a, b in (("l", "r"), ("r", "l"))
        ]
    )
    return pairs.withColumn("terms", F.filter(terms, lambda t: t.isNotNull()))


def pair_candidates(cards: DataFrame, pair: DataFrame) -> DataFrame:
    """Cards with tags of both languages of the pair, or holding one of its terms.

    `pair` is a single row; its tags and terms reach every card as scalar values.
    """

    def tags_of(side: str) -> Column:
        codes = F.filter(F.array(f"{side}_opus_code", f"{side}_iso639_3"), lambda c: F.coalesce(c, F.lit("")) != "")
        return F.transform(codes, lambda c: F.concat(F.lit("language:"), c))

    one = pair_terms(pair).select(
        F.struct(tags_of("l").alias("left"), tags_of("r").alias("right"), F.transform("terms", F.lower).alias("terms"))
    ).scalar()
    text = search_text(F.col("id"), F.col("description"), F.col("tags"))
    both = F.arrays_overlap("tags", "_pair.left") & F.arrays_overlap("tags", "_pair.right")
    named = tx.let(text, lambda whole: F.exists(F.col("_pair.terms"), lambda t: F.contains(whole, t)))
    return (
        cards.withColumn("_pair", one)
        .withColumn("has_both_tags", F.coalesce(both, F.lit(False)))
        .withColumn("has_term", named)
        .filter(F.col("has_both_tags") | F.col("has_term"))
        .drop("_pair")
    )


# ---- inventory -----------------------------------------------------------


def inventory(languages: DataFrame, corpora: DataFrame, cards: DataFrame, run_date: str) -> DataFrame:
    """Seed table with both summaries; a language without a corpus code counts as not checked."""
    checked = F.coalesce(F.col("opus_code"), F.lit("")) != ""
    zero = ["ru_parallel_pairs", "ru_parallel_documents", "mono_pairs_or_segments", "mono_documents"]
    blank = ["ru_parallel_corpora", "mono_corpora"]
    joined = languages.join(corpora.withColumnRenamed("code", "opus_code"), "opus_code", "left").join(cards, "iso639_3", "left")
    return joined.select(
        "language_ru",
        "language_en",
        "family",
        "branch",
        "iso639_3",
        "opus_code",
        checked.alias("opus_checked"),
        *[F.coalesce(c, F.lit(0)).alias(f"opus_{c}") for c in zero],
        *[F.coalesce(c, F.lit("")).alias(f"opus_{c}") for c in blank],
        F.coalesce("hf_checked", F.lit(False)).alias("hf_checked"),
        *[
            F.coalesce(c, F.lit(0)).alias(c)
            for c in ("hf_query_attempts", "hf_query_successes", "hf_dataset_count", "hf_ru_parallel_candidates", "hf_downloads_sum")
        ],
        F.coalesce("hf_top_datasets", F.lit("")).alias("hf_top_datasets"),
        F.coalesce("hf_size_categories", F.lit("")).alias("hf_size_categories"),
        F.lit(urls.CATALOGUE_PAGES).alias("hf_source_url"),
        F.lit(PARALLEL_SOURCE).alias("parallel_with_russian_source"),
        F.lit(MONOLINGUAL_SOURCE).alias("monolingual_source"),
        F.lit(run_date).alias("checked_at_utc"),
    ).orderBy("family", "branch", "language_ru")


def inventory_summary(table: DataFrame, languages: DataFrame) -> DataFrame:
    """Languages known and checked by either source, with data, and with failed queries."""
    expected = languages.agg(F.count("*")).scalar()
    return table.agg(
        expected.alias("languages_total"),
        F.count_if(F.col("opus_checked") | F.col("hf_checked")).alias("languages_checked"),
        F.count_if(F.col("opus_ru_parallel_pairs") > 0).alias("with_opus_ru_parallel"),
        F.count_if(F.col("hf_dataset_count") > 0).alias("with_hf_candidates"),
        F.count_if(F.col("hf_query_attempts") > F.col("hf_query_successes")).alias("errors"),
    )


def family_totals(table: DataFrame) -> DataFrame:
    return (
        table.groupBy("family")
        .agg(
            F.sum("opus_ru_parallel_pairs").alias("opus_ru_parallel_pairs"),
            F.sum("opus_mono_pairs_or_segments").alias("opus_mono_pairs_or_segments"),
        )
        .orderBy(F.desc("opus_ru_parallel_pairs"), "family")
    )


def family_branches(languages: DataFrame) -> DataFrame:
    return languages.groupBy("family", "branch").agg(F.count("*").alias("languages"))


def query_templates(languages: DataFrame, size: int = 4) -> DataFrame:
    """Search queries per language, numbered in order."""
    en, ru = F.col("language_en"), F.col("language_ru")
    queries = F.array(
        F.concat(en, F.lit(" dataset corpus")),
        F.concat(en, F.lit(" Russian parallel corpus")),
        F.concat(en, F.lit(" language GitHub corpus")),
        F.concat(ru, F.lit(" корпус скачать датасет")),
    )
    return languages.select("iso639_3", F.posexplode(F.slice(queries, 1, size)).alias("query_no", "query"))


# ---- decisions about cards ----------------------------------------------

DECISION_SCHEMA = (
    "dataset_id string, label string, confidence string, reason string, evidence string, needs_human_review boolean"
)


def parse_decisions(answers: DataFrame, raw: str, card_id: str) -> DataFrame:
    """Decision rows out of landed JSON answers; what does not parse is kept for review."""
    parsed = F.from_json(F.col(raw), DECISION_SCHEMA, {"mode": "PERMISSIVE"})
    ok = F.col("d.label").isNotNull()
    return answers.withColumn("d", parsed).select(
        F.coalesce("d.dataset_id", F.col(card_id).cast("string")).alias("dataset_id"),
        F.when(ok, F.col("d.label")).otherwise("llm_unparsed").alias("label"),
        F.coalesce("d.confidence", F.lit("")).alias("confidence"),
        F.coalesce("d.reason", F.lit("")).alias("reason"),
        F.coalesce("d.evidence", F.lit("")).alias("evidence"),
        F.coalesce("d.needs_human_review", F.lit(True)).alias("needs_human_review"),
        F.when(~ok, F.col(raw)).alias("raw_answer"),
    )


def decision_records(decisions: DataFrame, mode: str) -> DataFrame:
    """Decisions with the page of what they judge and how they came about.

    An empty or null id has no page; what did not parse keeps its page, for the reviewer.
    """
    known = F.coalesce(F.col("dataset_id"), F.lit("")) != ""
    page = F.when(known, urls.catalogue_page_url(F.col("dataset_id"))).otherwise("")
    return decisions.withColumn("url", page).withColumn("mode", F.lit(mode))


def undecided(cards: DataFrame) -> DataFrame:
    """Placeholder rows while no answers exist; label, confidence, reason and mode are fixed values."""
    return cards.select(
        F.col("id").alias("dataset_id"),
        F.lit("needs_openrouter_key").alias("label"),
        F.lit("none").alias("confidence"),
        F.lit("классификация параллельности отключена: нет OPENROUTER_API_KEY").alias("reason"),
        tx.preview(search_text(F.col("id"), F.col("description"), F.col("tags")), 500).alias("evidence"),
        F.lit(True).alias("needs_human_review"),
        "downloads",
        joined_tags(F.col("tags"), "language:", strip=False).alias("language_tags"),
        joined_tags(F.col("tags"), "task_categories:", strip=False).alias("task_tags"),
        urls.catalogue_page_url(F.col("id")).alias("url"),
        F.lit("no_llm").alias("mode"),
    )


def review_queue(decisions: DataFrame, size: int = 30) -> DataFrame:
    return decisions.orderBy("label", "confidence", "dataset_id").limit(size)


def label_counts(decisions: DataFrame) -> DataFrame:
    return decisions.groupBy("label").agg(F.count("*").alias("count"))
