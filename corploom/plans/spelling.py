"""Dictionary, spelling, error-rate and translation-score queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from corploom.functions import text as tx
from corploom.operators import metrics, recognition, spell
from corploom.plans.corpus import SP, W
from corploom.plans.tables import SCRIPT, documents, load
from corploom.session import spread

LW = "A-Za-zÀ-ÖØ-öø-ÿ"


def frequency_dictionary(spark: SparkSession, d: str) -> DataFrame:
    return spell.frequency(documents(spark, d), "text", SCRIPT)


_WORDS = f"words AS (SELECT doc_id, source, lang, unnest(regexp_extract_all(lower(text), '[{LW}]{{3,}}')) AS word FROM documents)"
_FREQ = f"{_WORDS}, freq AS MATERIALIZED (SELECT word, count(*) AS count FROM words GROUP BY word)"
FREQUENCY_DICTIONARY = f"WITH {_FREQ} SELECT * FROM freq"


def _top(spark: SparkSession, d: str) -> DataFrame:
    return spell.top_words(frequency_dictionary(spark, d))


def top_words(spark: SparkSession, d: str) -> DataFrame:
    return _top(spark, d)


_TOP = f"{_FREQ}, top AS (SELECT * FROM freq ORDER BY count DESC, word LIMIT 300)"
TOP_WORDS = f"WITH {_TOP} SELECT * FROM top"


def alphabet(spark: SparkSession, d: str) -> DataFrame:
    return spell.alphabet(_top(spark, d)).orderBy("letter")


_ALPHA = f"{_TOP}, alpha AS (SELECT DISTINCT unnest(string_split(word, '')) AS letter FROM (SELECT word FROM top ORDER BY count DESC, word LIMIT 100))"
ALPHABET = f"WITH {_ALPHA} SELECT letter FROM alpha"


def _gold(spark: SparkSession, d: str) -> DataFrame:
    return spell.top_words(_top(spark, d), size=40).select(F.col("word").alias("gold"), "count")


def typos(spark: SparkSession, d: str) -> DataFrame:
    return spell.with_typos(_gold(spark, d), spell.alphabet(_top(spark, d)))


_TYPOS = f"""{_ALPHA}, al AS (SELECT list(letter ORDER BY letter) AS a FROM alpha),
g AS (SELECT word AS gold, count, ('0x' || substr(md5('11:' || word), 1, 13))::BIGINT AS h, length(word) AS n
  FROM (SELECT * FROM top ORDER BY count DESC, word LIMIT 40)),
p AS (SELECT *, h % n AS i, (h // 1009) % 3 AS op, a[((h // 7919) % len(a)) + 1] AS r FROM g, al),
typos AS (SELECT gold, count, CASE WHEN n < 4 THEN gold
  WHEN op = 0 THEN gold[1:i] || gold[i+2:]
  WHEN op = 1 AND i < n - 1 THEN gold[1:i] || gold[i+2] || gold[i+1] || gold[i+3:]
  ELSE gold[1:i] || r || gold[i+2:] END AS typo FROM p)"""
TYPOS = f"WITH {_TYPOS} SELECT gold, count, typo FROM typos"


_EVERY_TYPO = _TYPOS.replace("(SELECT * FROM top ORDER BY count DESC, word LIMIT 40)", "freq")


def _suggested(spark: SparkSession, d: str) -> DataFrame:
    return spell.evaluate(spell.suggest(typos(spark, d), _top(spark, d)))


def spell_suggest(spark: SparkSession, d: str) -> DataFrame:
    return _suggested(spark, d).select(
        "typo", "gold", "top1", "top1_score", F.array_join("top3", "; ").alias("top3"), "top1_correct", "top3_correct"
    )


# The SQL engine's levenshtein counts bytes: letters with marks become single control characters first.
_MARKS = "àâäáãåçéèêëíìîïñóòôöõúùûüýÿßæœøþð"
_CODES = " || ".join(f"chr({c})" for c in list(range(1, 9)) + list(range(14, 32)) + list(range(35, 35 + len(_MARKS) - 26)))
_ASCII = "translate({}, '" + _MARKS + "', " + _CODES + ")"
_SUGG = f"""{_TYPOS},
sc AS (SELECT typo, gold, word, count, levenshtein({_ASCII.format('typo')}, {_ASCII.format('word')}) AS dist
  FROM typos t, (SELECT word, count AS c2 FROM top) v),
rk AS (SELECT s.typo, s.gold, s.word, s.dist, row_number() OVER (PARTITION BY s.gold ORDER BY dist, t.count DESC, s.word) AS r
  FROM sc s JOIN top t USING (word)),
sugg AS (SELECT any_value(typo) AS typo, gold, max(CASE WHEN r = 1 THEN word END) AS top1,
  round(100 * (1 - max(CASE WHEN r = 1 THEN dist / greatest(length(typo), length(word)) END)), 4) AS top1_score,
  string_agg(word, '; ' ORDER BY r) FILTER (r <= 3) AS top3, bool_or(r = 1 AND word = gold) AS top1_correct,
  bool_or(r <= 3 AND word = gold) AS top3_correct FROM rk GROUP BY gold)"""
SPELL_SUGGEST = f"WITH {_SUGG} SELECT * FROM sugg"


def spell_eval(spark: SparkSession, d: str) -> DataFrame:
    return _suggested(spark, d).agg(
        F.count("*").alias("words"),
        F.round(F.avg(F.col("top1_correct").cast("double")), 6).alias("top1_accuracy"),
        F.round(F.avg(F.col("top3_correct").cast("double")), 6).alias("top3_accuracy"),
    )


SPELL_EVAL = f"""
WITH {_SUGG}
SELECT count(*) AS words, round(avg(top1_correct::INT), 6) AS top1_accuracy, round(avg(top3_correct::INT), 6) AS top3_accuracy FROM sugg"""


def detection_eval(spark: SparkSession, d: str) -> DataFrame:
    """Does "not in the dictionary" find errors planted in every word, rare ones apart? Clean words are judged too."""
    freq = frequency_dictionary(spark, d)
    gold = freq.select(F.col("word").alias("gold"), "count")
    planted = spell.with_typos(gold, spell.alphabet(_top(spark, d)))
    judged = planted.select(F.col("typo").alias("word"), "count", (F.col("typo") != F.col("gold")).alias("truth")).unionByName(
        planted.select(F.col("gold").alias("word"), "count", F.lit(False).alias("truth"))
    )
    known = freq.filter("count > 1").select("word", F.lit(True).alias("known"))
    flagged = judged.join(known, "word", "left").withColumn("guess", F.col("known").isNull())
    banded = flagged.withColumn("band", spell.frequency_band(F.col("count")))
    return spell.detection_scores(banded, "truth", "guess", "band")


DETECTION_EVAL = f"""
WITH {_EVERY_TYPO}, j AS (SELECT typo AS word, count, typo <> gold AS truth FROM typos UNION ALL SELECT gold, count, FALSE FROM typos),
kn AS (SELECT word, TRUE AS known FROM freq WHERE count > 1),
f AS (SELECT CASE WHEN count = 1 THEN 'once' WHEN count <= 5 THEN 'rare' ELSE 'common' END AS band, truth, known IS NULL AS guess FROM j LEFT JOIN kn USING (word))
SELECT band, count(*) FILTER (truth AND guess) AS true_positives, count(*) FILTER (NOT truth AND guess) AS false_positives,
  count(*) FILTER (truth AND NOT guess) AS false_negatives,
  round(count(*) FILTER (truth AND guess) / nullif(count(*) FILTER (guess), 0)::DOUBLE, 6) AS precision,
  round(count(*) FILTER (truth AND guess) / nullif(count(*) FILTER (truth), 0)::DOUBLE, 6) AS recall
FROM f GROUP BY band"""


def _word_list(spark: SparkSession, d: str) -> DataFrame:
    docs = documents(spark, d)
    english = spell.frequency(docs.filter("lang = 'en'"), "text", SCRIPT).filter("count >= 5")
    return spell.with_status(spell.word_list(docs, "text", "source", SCRIPT), english.select("word"))


def wordlist_sources(spark: SparkSession, d: str) -> DataFrame:
    return _word_list(spark, d).select("word", "count", "source_count", "status", "foreign", "notes")


WORDLIST_SOURCES = f"""
WITH {_WORDS}, dom AS (SELECT word FROM words WHERE lang = 'en' GROUP BY word HAVING count(*) >= 5),
l AS (SELECT word, count(*) AS count, count(DISTINCT source) AS source_count FROM words GROUP BY word)
SELECT l.*, dom.word IS NOT NULL AS foreign,
  CASE WHEN dom.word IS NOT NULL AND source_count < 2 THEN 'reject' WHEN dom.word IS NULL AND source_count >= 2 THEN 'accepted' ELSE 'unsure' END AS status,
  concat_ws('; ', CASE WHEN dom.word IS NOT NULL THEN 'frequent in the dominant language' END, CASE WHEN source_count < 2 THEN 'too few sources' END) AS notes
FROM l LEFT JOIN dom USING (word)"""


def unknown_words(spark: SparkSession, d: str) -> DataFrame:
    """Words of all documents missing from a list accepted out of the good ones, with candidates one edit away."""
    docs = documents(spark, d)
    good = docs.join(load(spark, d, "labels").filter("quality = 1").select("doc_id"), "doc_id", "left_semi")
    accepted = spell.word_list(good, "text", "source", SCRIPT).filter("source_count >= 2")
    found = spell.unknown_words(spell.frequency(docs, "text", SCRIPT), accepted)
    return found.withColumn("candidates", F.array_join("candidates", "; "))


_DEL = "list_distinct([word] || list_transform(range(1, length(word) + 1), lambda i: substr(word, 1, i - 1) || substr(word, i + 1)))"
UNKNOWN_WORDS = f"""
WITH {_FREQ},
acc AS MATERIALIZED (SELECT word, count(*) AS n FROM words WHERE doc_id IN (SELECT doc_id FROM labels WHERE quality = 1)
  GROUP BY word HAVING count(DISTINCT source) >= 2),
unk AS MATERIALIZED (SELECT * FROM freq ANTI JOIN acc USING (word)),
uf AS (SELECT word, unnest({_DEL}) AS form FROM unk), af AS (SELECT word AS cand, n, unnest({_DEL}) AS form FROM acc),
p AS MATERIALIZED (SELECT DISTINCT word, cand, n FROM uf JOIN af USING (form)),
ok AS (SELECT * FROM p WHERE levenshtein({_ASCII.format('word')}, {_ASCII.format('cand')}) <= 1),
r AS (SELECT *, row_number() OVER (PARTITION BY word ORDER BY n DESC, cand) AS rk FROM ok),
b AS (SELECT word, string_agg(cand, '; ' ORDER BY rk) AS candidates FROM r WHERE rk <= 3 GROUP BY word)
SELECT unk.word, count, coalesce(candidates, '') AS candidates, 'pending' AS decision,
  CASE WHEN count = 1 THEN 'once' WHEN count <= 5 THEN 'rare' ELSE 'common' END AS band FROM unk LEFT JOIN b USING (word)"""


def _marked(freq: DataFrame) -> DataFrame:
    """(variant, standard): words written with marks whose plain form occurs as well and more often.

    Plain forms hold no marks, so a word and its plain form share their group.
    """
    plain = metrics.unmarked(F.col("word"))
    standard = F.max(F.when(F.col("word") == plain, F.col("count"))).over(Window.partitionBy("standard"))
    grouped = freq.withColumn("standard", plain).withColumn("standard_count", standard)
    return grouped.filter("standard <> word AND standard_count > count").select(F.col("word").alias("variant"), "standard")


def variants(spark: SparkSession, d: str) -> DataFrame:
    """Each word written with marks is a variant of its plain form if that occurs as well and more often."""
    freq = frequency_dictionary(spark, d)
    return spell.standardise(freq, _marked(freq), ("ç", "c")).select("word", "count", "form", "kind")


_FOLD = "translate({}, '" + metrics.MARKED + "', '" + metrics.PLAIN + "')"
VARIANTS = f"""
WITH {_FREQ}, v AS (SELECT f.word AS variant, s.word AS standard FROM freq f JOIN freq s ON s.word = {_FOLD.format('f.word')}
  WHERE s.word <> f.word AND s.count > f.count)
SELECT f.word, f.count, coalesce(standard, replace(f.word, 'ç', 'c')) AS form,
  CASE WHEN standard IS NOT NULL THEN 'normalisation' WHEN contains(f.word, 'ç') THEN 'transliteration' ELSE 'unchanged' END AS kind
FROM freq f LEFT JOIN v ON v.variant = f.word"""

# ---- recognised against correct text ------------------------------------


def _turns(spark: SparkSession, d: str) -> DataFrame:
    return spread(load(spark, d, "conversations"), "conv_id")


def _line_pairs(spark: SparkSession, d: str) -> DataFrame:
    corrected = recognition.post_correct(_turns(spark, d), "text")
    return recognition.line_pairs(corrected, "corrected", "text", "conv_id", "turn", "role")


def error_rates(spark: SparkSession, d: str) -> DataFrame:
    """Character and word error rates per role: post-corrected lines against the lines as they were."""
    counted = metrics.error_counts(_line_pairs(spark, d), "recognized_text", "correct_text")
    return metrics.error_rates(counted, "role")


_CORR = {
    0: r"regexp_replace({}, '([A-Za-z])- *\n *([a-z])', '\1\2', 'g')",
    1: "regexp_replace({}, '!!+', '!', 'g')",
    2: "regexp_replace({}, '[“”„«»]', '\"', 'g')",
    3: "regexp_replace({}, '[éèêë]', 'e', 'g')",
    4: r"regexp_replace({}, ' +([,.;:!?])', '\1', 'g')",
}


def _corrected(column: str) -> str:
    for rule in _CORR.values():
        column = rule.replace("{}", column)
    return column


_PAIRS = f"""pairs AS (
  SELECT conv_id, turn, role, unnest(range(1, greatest(len(hl), len(rl)) + 1)) - 1 AS line_id, hl, rl FROM (
    SELECT conv_id, turn, role, string_split({_corrected('text')}, chr(10)) AS hl, string_split(text, chr(10)) AS rl FROM conversations)),
lp AS (SELECT conv_id, turn, role, line_id, coalesce(hl[line_id + 1], '') AS h, coalesce(rl[line_id + 1], '') AS r FROM pairs)"""
_LOWER_MARKS = "àâäáãåçéèêëíìîïñóòôöõúùûüýÿß"
_UPPER_MARKS = "ÀÂÄÁÃÅÇÉÈÊËÍÌÎÏÑÓÒÔÖÕÚÙÛÜÝŸ"


def _bytewise(column: str) -> str:
    """One byte per character: marked letters to spare ASCII (control characters and signs not used in the texts)."""
    found = "éèêëàâäáçíñóúüöïîôûùßÉÈÊËÀÂÄÁÇÍÑÓÚÜÖ"
    spare = [1, 2, 3, 4, 5, 6, 7, 8, 11, 12, 14, 15, 16, 17, 18, 19, 20, 21, 22, 23, 24, 25, 26, 27, 28, 29, 30, 31, 35, 36, 37, 38, 64, 94, 95, 96, 126]
    assert len(found) == len(spare[: len(found)])
    return f"translate({column}, '{found}', " + " || ".join(f"chr({c})" for c in spare[: len(found)]) + ")"


ERROR_RATES = f"""
WITH {_PAIRS}, x AS (
  SELECT role, h, r, levenshtein({_bytewise('h')}, {_bytewise('r')}) AS ce, levenshtein({_bytewise(_FOLD.format('h'))}, {_bytewise(_FOLD.format('r'))}) AS pe,
    length(r) AS chars, regexp_extract_all(h, '[^{SP}]+') AS hw, regexp_extract_all(r, '[^{SP}]+') AS rw FROM lp),
y AS (SELECT *, list_distinct(hw || rw) AS ix FROM x),
z AS (SELECT *, array_to_string(list_transform(hw, lambda w: chr(list_position(ix, w)::INT)), '') AS hc,
  array_to_string(list_transform(rw, lambda w: chr(list_position(ix, w)::INT)), '') AS rc FROM y)
SELECT role, count(*) AS lines, sum(ce)::BIGINT AS char_edits, sum(ce - pe)::BIGINT AS mark_edits,
  round(sum(ce) / greatest(sum(chars), 1)::DOUBLE, 6) AS cer,
  round(sum(CASE WHEN h = r THEN 0
  WHEN len(hw) = len(rw) THEN len(list_filter(range(1, len(hw) + 1), lambda k: hw[k] <> rw[k])) ELSE levenshtein(hc, rc) END) / greatest(sum(len(rw)), 1)::DOUBLE, 6) AS wer
FROM z GROUP BY role"""


def error_types(spark: SparkSession, d: str) -> DataFrame:
    typed = metrics.error_table(_line_pairs(spark, d), "recognized_text", "correct_text")
    return typed.groupBy("role", "error_type").agg(F.count("*").alias("lines"))


ERROR_TYPES = f"""
WITH {_PAIRS}, t AS (SELECT role, CASE WHEN h = r THEN 'none' WHEN lower(h) = lower(r) THEN 'case'
  WHEN {_FOLD.format('h')} = {_FOLD.format('r')} THEN 'marks'
  WHEN regexp_replace(h, '[^{W}]+', '', 'g') = regexp_replace(r, '[^{W}]+', '', 'g') THEN 'punctuation'
  WHEN length(h) < length(r) THEN 'omission' WHEN length(h) > length(r) THEN 'insertion' ELSE 'substitution' END AS error_type FROM lp)
SELECT role, error_type, count(*) AS lines FROM t GROUP BY role, error_type"""


def error_pairs(spark: SparkSession, d: str) -> DataFrame:
    return metrics.first_difference(_line_pairs(spark, d), "recognized_text", "correct_text")


ERROR_PAIRS = f"""
WITH {_PAIRS}, c AS (SELECT string_split(h, '') AS hc, string_split(r, '') AS rc, length(h) AS hn, length(r) AS rn FROM lp WHERE h <> r),
i AS (SELECT *, list_min(list_filter(range(1, greatest(hn, rn) + 1), lambda k: coalesce(CASE WHEN k <= hn THEN hc[k] END, '') <> coalesce(CASE WHEN k <= rn THEN rc[k] END, ''))) AS k FROM c)
SELECT coalesce(CASE WHEN k <= hn THEN hc[k] END, '') AS read, coalesce(CASE WHEN k <= rn THEN rc[k] END, '') AS correct, count(*) AS n
FROM i GROUP BY 1, 2"""


def post_correction(spark: SparkSession, d: str) -> DataFrame:
    out = recognition.post_correct(documents(spark, d), "text")
    return out.select("doc_id", F.md5("corrected").alias("corrected_hash"), F.md5("text").alias("raw_hash"), "changed")


POST_CORRECTION = f"""
SELECT doc_id, md5({_corrected('text')}) AS corrected_hash, md5(text) AS raw_hash, {_corrected('text')} <> text AS changed FROM documents"""


def mixed_script_words(spark: SparkSession, d: str) -> DataFrame:
    found = recognition.mixed_script_words(documents(spark, d), "text", tx.LATIN, "À-ÖØ-öø-ÿ", "lang")
    return found.groupBy("lang").agg(F.count("*").alias("words"), F.count_distinct("word").alias("different_words"))


MIXED_SCRIPT_WORDS = f"""
WITH w AS (SELECT lang, unnest(regexp_extract_all(text, '[{W}]+')) AS word FROM documents)
SELECT lang, count(*) AS words, count(DISTINCT word) AS different_words FROM w
WHERE regexp_matches(word, '[A-Za-z]') AND regexp_matches(word, '[À-ÖØ-öø-ÿ]') GROUP BY lang"""

# ---- translation ---------------------------------------------------------


def _reply_pairs(spark: SparkSession, d: str) -> DataFrame:
    """Each turn against the turn after it, met on (conversation, turn)."""
    turns = _turns(spark, d)
    after = turns.select("conv_id", (F.col("turn") - 1).alias("turn"), F.col("text").alias("hypothesis"))
    both = turns.select("conv_id", "turn", F.col("text").alias("reference")).join(after, ["conv_id", "turn"])
    return both.select(F.concat_ws("-", "conv_id", "turn").alias("pair_id"), "hypothesis", "reference")


_REPLIES = """pairs AS (SELECT a.conv_id || '-' || a.turn AS id, b.text AS h, a.text AS r
  FROM conversations a JOIN conversations b ON b.conv_id = a.conv_id AND b.turn = a.turn + 1)"""


def chrf(spark: SparkSession, d: str) -> DataFrame:
    return metrics.chrf(_reply_pairs(spark, d), "pair_id", "hypothesis", "reference")


def _ngram_totals(units: str, order: int, sep: str) -> str:
    def grams(side: str, n: int) -> str:
        joined = f"array_to_string({side}[i:i+{n - 1}], '{sep}')"
        return f"SELECT id, {n} AS n, '{side}' AS side, unnest(list_transform(range(1, len({side}) - {n} + 2), lambda i: {joined})) AS gram FROM u"

    union = " UNION ALL ".join(grams(s, n) for s in ("h", "r") for n in range(1, order + 1))
    return f"""{_REPLIES}, u AS (SELECT id, {units.replace('{}', 'h')} AS h, {units.replace('{}', 'r')} AS r FROM pairs), g AS ({union}),
c AS (SELECT id, n, gram, count(*) FILTER (side = 'h') AS h, count(*) FILTER (side = 'r') AS r FROM g GROUP BY ALL),
t AS (SELECT n, sum(h)::DOUBLE AS hyp, sum(r)::DOUBLE AS ref, sum(least(h, r))::DOUBLE AS m FROM c GROUP BY n)"""


CHRF = f"""
WITH {_ngram_totals("string_split(regexp_replace({}, '[" + SP + "]+', '', 'g'), '')", 6, "")}
SELECT round(100 * avg(CASE WHEN m > 0 THEN 5 * (m / hyp) * (m / ref) / (4 * (m / hyp) + m / ref) ELSE 0 END), 4) AS chrf,
  sum(m)::BIGINT AS matched_ngrams FROM t"""


def bleu(spark: SparkSession, d: str) -> DataFrame:
    return metrics.bleu(_reply_pairs(spark, d), "pair_id", "hypothesis", "reference")


BLEU = f"""
WITH {_ngram_totals("regexp_extract_all({}, '[^" + SP + "]+')", 4, " ")},
s AS (SELECT max(hyp) FILTER (n = 1) AS hw, max(ref) FILTER (n = 1) AS rw, count(*) FILTER (m > 0) AS k, avg(ln(nullif(m, 0) / hyp)) AS lp FROM t)
SELECT hw::BIGINT AS hyp_words, rw::BIGINT AS ref_words,
  round(CASE WHEN k = 4 THEN 100 * CASE WHEN hw >= rw THEN 1 ELSE exp(1 - rw / hw) END * exp(lp) ELSE 0 END, 4) AS bleu FROM s"""


def dictionary_mt(spark: SparkSession, d: str) -> DataFrame:
    """Word-for-word output per document; the dictionary maps marked words to their standard forms."""
    pairs = _marked(frequency_dictionary(spark, d)).toDF("word", "translation")
    out = spell.translate_by_dictionary(documents(spark, d), "text", "doc_id", pairs)
    return out.select("doc_id", F.md5("translation").alias("translation_hash"), "words", "known_words")


DICTIONARY_MT = f"""
WITH {_FREQ}, v AS (SELECT f.word, s.word AS translation FROM freq f JOIN freq s ON s.word = {_FOLD.format('f.word')}
  WHERE s.word <> f.word AND s.count > f.count),
t AS (SELECT doc_id, unnest(w) AS word, generate_subscripts(w, 1) AS pos
  FROM (SELECT doc_id, regexp_extract_all(lower(text), '[{W}]+') AS w FROM documents))
SELECT doc_id, md5(coalesce(string_agg(coalesce(translation, t.word), ' ' ORDER BY pos), '')) AS translation_hash, count(t.word) AS words,
  count(translation) AS known_words FROM documents LEFT JOIN t USING (doc_id) LEFT JOIN v ON v.word = t.word GROUP BY doc_id"""


def dictionary_coverage(spark: SparkSession, d: str) -> DataFrame:
    """Share of running words the dictionary knows, and the untranslated words."""
    pairs = variants(spark, d).filter("kind = 'normalisation'").select("word", F.lit(True).alias("known"))
    counted = frequency_dictionary(spark, d).join(pairs, "word", "left")
    return counted.agg(
        F.sum("count").alias("running_words"),
        F.count_if(F.col("known").isNull()).alias("untranslated_words"),
        F.round(F.sum(F.when(F.col("known"), F.col("count")).otherwise(0)) / F.sum("count"), 6).alias("coverage"),
    )


DICTIONARY_COVERAGE = f"""
WITH {_FREQ}, v AS (SELECT f.word FROM freq f JOIN freq s ON s.word = {_FOLD.format('f.word')} WHERE s.word <> f.word AND s.count > f.count)
SELECT sum(count)::BIGINT AS running_words, count(*) FILTER (v.word IS NULL) AS untranslated_words,
  round(coalesce(sum(count) FILTER (v.word IS NOT NULL), 0) / sum(count)::DOUBLE, 6) AS coverage FROM freq LEFT JOIN v USING (word)"""

NAMES = [
    "frequency_dictionary", "top_words", "alphabet", "typos", "spell_suggest", "spell_eval", "detection_eval", "wordlist_sources",
    "unknown_words", "variants", "error_rates", "error_types", "error_pairs", "post_correction", "mixed_script_words", "chrf",
    "bleu", "dictionary_mt", "dictionary_coverage",
]
QUERIES = {n: globals()[n] for n in NAMES}
ORACLES = {n: globals()[n.upper()] for n in NAMES}
