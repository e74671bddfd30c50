"""Queries over what the library keeps between runs, verifies, or searches by an index (each with its SQL oracle)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corploom.operators import align, decisions, dedup, lines, nearest, recognition, snapshots, spell, suggest
from corploom.operators.lookup import settled
from corploom.plans import spelling
from corploom.plans.corpus import W
from corploom.plans.tables import SCRIPT, documents, load
from corploom.session import shared_folder
from corploom.streaming.keyed_state import KeyedState, refresh_keys

# ---- nearest neighbours by an index ---------------------------------------

TABLES = 10


def nearest_indexed(spark: SparkSession, d: str) -> DataFrame:
    """The three most similar other vectors found through the index, for every vector."""
    v = load(spark, d, "embeddings")
    found = nearest.nearest(v, v, "vec_id", "vec_id", "embedding", 3, exclude_same=True, tables=TABLES)
    return found.select("left_id", "right_id", "rank", F.round("score", 6).alias("score"))


_INDEXED = f"""
v AS (SELECT vec_id, embedding, list_transform(embedding, lambda x: floor(x::DOUBLE * {nearest.GRAIN})) AS q FROM embeddings),
size AS (SELECT greatest(1, round(log2(greatest(count(*), 2)) / 2))::INT AS bits, max(len(embedding)) AS dims FROM v),
signs AS (SELECT t, b, d, CASE WHEN substr(md5(t || ':' || b || ':' || d), 1, 1) < '8' THEN 1.0::DOUBLE ELSE -1.0::DOUBLE END AS s
  FROM size, range({TABLES}) tt(t), range(size.bits) bb(b), range(size.dims) dd(d)),
planes AS (SELECT t, b, list(s ORDER BY d) AS p FROM signs GROUP BY t, b),
proj AS (SELECT vec_id, t, b, list_inner_product(q, p) AS x FROM v, planes),
own AS (SELECT vec_id, t, sum(CASE WHEN x >= 0 THEN 1 << b ELSE 0 END)::BIGINT AS bucket FROM proj GROUP BY vec_id, t),
probes AS (SELECT vec_id, t, bucket FROM own UNION ALL SELECT vec_id, t, xor(bucket, 1 << b) FROM own JOIN proj USING (vec_id, t)),
pairs AS (SELECT DISTINCT p.vec_id AS left_id, o.vec_id AS right_id FROM probes p JOIN own o USING (t, bucket) WHERE p.vec_id <> o.vec_id),
sim AS (SELECT left_id, right_id, round(list_cosine_similarity(a.embedding::DOUBLE[], c.embedding::DOUBLE[]), 12) AS score
  FROM pairs JOIN v a ON a.vec_id = left_id JOIN v c ON c.vec_id = right_id),
rk AS (SELECT *, row_number() OVER (PARTITION BY left_id ORDER BY score DESC, right_id) AS rank FROM sim)"""
NEAREST_INDEXED = f"WITH {_INDEXED} SELECT left_id, right_id, rank, round(score, 6) AS score FROM rk WHERE rank <= 3"


def mined_indexed(spark: SparkSession, d: str) -> DataFrame:
    """Bitext candidates found through the index, filtered by score, length ratio and language."""
    facts = documents(spark, d).select("doc_id", F.length("text").alias("chars"), F.col("lang").alias("language"), "source")
    left, right = facts.withColumnRenamed("doc_id", "left_id"), facts.withColumnRenamed("doc_id", "right_id")
    v = load(spark, d, "embeddings")
    found = nearest.nearest(v, v, "vec_id", "vec_id", "embedding", 3, exclude_same=True, tables=TABLES)
    kept = align.mined_pairs(found, left, right, min_score=0.2, max_ratio=3.0)
    return kept.select("left_id", "right_id", F.round("score", 6).alias("score"), F.round("length_ratio", 6).alias("length_ratio"), "review_status")


MINED_INDEXED = f"""
WITH {_INDEXED}, p AS (SELECT left_id, right_id, score, a.lang AS la, b.lang AS lb,
  greatest(length(a.text), length(b.text)) / greatest(least(length(a.text), length(b.text)), 1)::DOUBLE AS ratio
  FROM rk JOIN documents a ON a.doc_id = left_id JOIN documents b ON b.doc_id = right_id WHERE rank <= 3 AND score >= 0.2)
SELECT left_id, right_id, round(score, 6) AS score, round(ratio, 6) AS length_ratio, 'unreviewed' AS review_status
FROM p WHERE ratio <= 3 AND la <> lb"""

# ---- refresh with state by key ---------------------------------------------


def _landings(docs: DataFrame) -> list[DataFrame]:
    """Three landings out of all documents: most of them; half the sources again, with changes; these once more.

    What happens to a document follows from the digits of its hash: it comes late, vanishes, changes
    much or little, or can't be checked.
    """
    h = F.md5(F.col("doc_id").cast("string"))
    rows = docs.select(
        F.col("doc_id").cast("string").alias("key"), F.col("source").alias("scope"), F.col("lang").alias("name"),
        F.col("n_chars").cast("bigint").alias("value"), F.substring(h, 1, 1).alias("_a"), F.substring(h, 2, 1).alias("_b"),
    )
    early = rows.filter("_a <> '0'").withColumn("checked", F.lit(True))
    again = rows.filter((F.col("_a") != "1") & (F.substring(F.md5("scope"), 1, 1) < "8"))
    moved = F.when(F.col("_b") == "0", F.col("value") * 3 + 2000).when(F.col("_b") == "1", F.col("value") + 10).otherwise(F.col("value"))
    again = again.withColumn("checked", F.col("_b") != "2").withColumn("value", F.when(F.col("checked"), moved))
    return [x.drop("_a", "_b") for x in (early, again, again)]


def refreshed_keys(spark: SparkSession, d: str) -> DataFrame:
    """State and reports after three runs of the refresh over three landings."""
    landing, progress = shared_folder(spark, "landing"), shared_folder(spark, "progress")
    state = KeyedState(spark, shared_folder(spark, "state"))
    for rows in _landings(load(spark, d, "documents")):
        rows.write.mode("append").parquet(landing)
        refresh_keys(state, landing, progress).awaitTermination()
    none = F.lit(None)
    kept = state.rows().select(
        "key", "scope", "name", "status", "value", "pending_value", "cached", F.col("changed_batch").alias("batch"),
        none.cast("string").alias("change_type"), none.cast("bigint").alias("delta"), none.cast("boolean").alias("needs_human_review"),
    )
    told = state.changes().select(
        "key", "scope", "name", none.cast("string").alias("status"), F.col("old_value").alias("value"), F.col("new_value").alias("pending_value"),
        none.cast("boolean").alias("cached"), "batch", "change_type", "delta", "needs_human_review",
    )
    return kept.unionByName(told)


REFRESHED_KEYS = """
WITH r AS (SELECT doc_id::VARCHAR AS key, source AS scope, lang AS name, n_chars AS v,
    substr(md5(doc_id::VARCHAR), 1, 1) AS a, substr(md5(doc_id::VARCHAR), 2, 1) AS b, substr(md5(source), 1, 1) < '8' AS again FROM documents),
m AS (SELECT *, CASE b WHEN '0' THEN v * 3 + 2000 WHEN '1' THEN v + 10 ELSE v END AS w FROM r),
f AS (SELECT *, a = '0' AS late, again AND a = '1' AS gone, again AND a <> '1' AND b = '2' AS unchecked,
    again AND a NOT IN ('0', '1') AND b IN ('0', '1') AS moved, abs(w - v) > greatest(1000.0, v * 0.5) AS big FROM m),
state AS (SELECT key, scope, name, CASE WHEN gone THEN 'missing' ELSE 'present' END AS status,
    CASE WHEN late AND unchecked THEN NULL WHEN late THEN w WHEN moved AND NOT big THEN w ELSE v END AS value,
    CASE WHEN moved AND big THEN w END AS pending_value, unchecked AND NOT late AS cached,
    CASE WHEN late AND unchecked THEN NULL WHEN late OR gone OR moved THEN 1 ELSE 0 END AS batch,
    NULL::VARCHAR AS change_type, NULL::BIGINT AS delta, NULL::BOOLEAN AS needs_human_review
  FROM f WHERE NOT late OR again),
told AS (
  SELECT key, scope, name, NULL::BIGINT AS value, v AS pending_value, 0 AS batch, 'new' AS change_type, NULL::BIGINT AS delta, TRUE AS review FROM f WHERE NOT late
  UNION ALL SELECT key, scope, name, NULL, w, 1, 'new', NULL, TRUE FROM f WHERE late AND again AND NOT unchecked
  UNION ALL SELECT key, scope, name, v, NULL, 1, 'missing', NULL, TRUE FROM f WHERE gone
  UNION ALL SELECT key, scope, name, v, w, 1, 'changed', w - v, big FROM f WHERE moved)
SELECT key, scope, name, status, value, pending_value, cached, batch, change_type, delta, needs_human_review FROM state
UNION ALL SELECT key, scope, name, NULL, value, pending_value, NULL, batch, change_type, delta, review FROM told"""

# ---- verified near duplicates ----------------------------------------------

LEAST, BANDS, ROWS, WIDTH = 0.8, 20, 5, 5


def verified_duplicates(spark: SparkSession, d: str) -> DataFrame:
    found = dedup.verified_duplicates(documents(spark, d), "text", "doc_id", "source", LEAST, BANDS, ROWS, WIDTH)
    return found.withColumn("similarity", F.round("similarity", 6))


_MINIMA = ", ".join(f"min((h * {a} + {b}) % {dedup.PRIME}) AS m{i}" for i, (a, b) in enumerate(dedup.hash_family(BANDS * ROWS)))
_KEYS = ", ".join(
    "'" + str(b) + ":' || concat_ws(',', " + ", ".join(f"m{b * ROWS + r}" for r in range(ROWS)) + ")" for b in range(BANDS)
)
VERIFIED_DUPLICATES = f"""
WITH RECURSIVE w AS (SELECT doc_id, source, regexp_extract_all(lower(text), '[{W}]+') AS w FROM documents),
sh AS (SELECT DISTINCT doc_id, s, ('0x' || substr(md5(s), 1, 8))::BIGINT % {dedup.PRIME} AS h FROM (
  SELECT doc_id, unnest(list_transform(range(1, greatest(len(w) - {WIDTH - 1}, 1) + 1),
    lambda i: array_to_string(w[i:i + {WIDTH - 1}], ' '))) AS s FROM w WHERE len(w) > 0)),
st AS (SELECT doc_id, count(*) AS n, md5(string_agg(s, '|' ORDER BY s)) AS digest FROM sh GROUP BY doc_id),
hd AS MATERIALIZED (SELECT *, min(doc_id) OVER (PARTITION BY digest) AS head, count(*) OVER (PARTITION BY digest) AS copies FROM st),
sig AS (SELECT doc_id, {_MINIMA} FROM sh SEMI JOIN (SELECT head AS doc_id FROM hd) USING (doc_id) GROUP BY doc_id),
links AS MATERIALIZED (SELECT doc_id, unnest([{_KEYS}]) AS k FROM sig),
cand AS (SELECT DISTINCT a.doc_id AS a, b.doc_id AS b FROM links a JOIN links b ON a.k = b.k AND a.doc_id > b.doc_id),
inner_ AS (SELECT a, b, count(*) AS n FROM cand JOIN sh x ON x.doc_id = a JOIN sh y ON y.doc_id = b AND y.s = x.s GROUP BY a, b),
js AS MATERIALIZED (SELECT a, b, i.n / (x.n + y.n - i.n)::DOUBLE AS score FROM inner_ i JOIN st x ON x.doc_id = a JOIN st y ON y.doc_id = b),
it AS (SELECT k, doc_id, 0 AS r FROM links
  UNION ALL SELECT l.k, l.doc_id, l.r + 1 FROM (SELECT *, min(doc_id) OVER (PARTITION BY k) AS leader FROM it) l
    LEFT JOIN js ON js.a = l.doc_id AND js.b = l.leader WHERE l.doc_id <> l.leader AND coalesce(js.score, 0) < {LEAST}::DOUBLE),
lead AS (SELECT *, min(doc_id) OVER (PARTITION BY k, r) AS leader FROM it),
e AS (SELECT DISTINCT js.a, js.b, js.score FROM lead JOIN js ON js.a = doc_id AND js.b = leader WHERE js.score >= {LEAST}::DOUBLE),
e2 AS (SELECT a, b, score FROM e UNION ALL SELECT b, a, score FROM e),
reach AS (SELECT DISTINCT head AS a, head AS b FROM hd UNION SELECT r.a, e2.b FROM reach r JOIN e2 ON e2.a = r.b),
lab AS (SELECT a AS head, min(b) AS grp FROM reach GROUP BY a),
bs AS (SELECT a AS head, max(score) AS best FROM e2 GROUP BY a),
al AS (SELECT hd.doc_id, grp, CASE WHEN copies > 1 THEN 1.0 ELSE best END AS similarity FROM hd JOIN lab USING (head) LEFT JOIN bs USING (head)),
sz AS (SELECT grp, count(*) AS group_size FROM al GROUP BY grp HAVING count(*) > 1)
SELECT al.doc_id, w.source, al.doc_id <> grp AS removed, grp AS removed_by, k.source AS removed_source, round(similarity, 6) AS similarity, group_size
FROM al JOIN sz USING (grp) JOIN w USING (doc_id) JOIN w AS k ON k.doc_id = grp"""

# ---- aligned lines -----------------------------------------------------------


def aligned_error_rates(spark: SparkSession, d: str) -> DataFrame:
    """Error rates per role where a line that correction joined meets the lines it came from; joined and dropped ones apart."""
    corrected = recognition.post_correct(load(spark, d, "conversations"), "text")
    pairs = settled(lines.aligned_lines(corrected, "corrected", "text", "conv_id", "turn", "role"))
    return lines.alignment_rates(pairs, "role")


# ---- suggestions and decisions -------------------------------------------------


def _planted(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    """Every word with a typo, and the dictionary."""
    freq = settled(spelling.frequency_dictionary(spark, d))
    gold = freq.select(F.col("word").alias("gold"), "count")
    planted = spell.with_typos(gold, spell.alphabet(spell.top_words(freq)))
    return settled(planted.filter(F.col("typo") != F.col("gold"))), freq


def swap_suggestions(spark: SparkSession, d: str) -> DataFrame:
    """For every planted typo the three best words of the whole dictionary at most one edit or swap away."""
    planted, freq = _planted(spark, d)
    found = suggest.suggestions(planted.select(F.col("typo").alias("word")), freq)
    names = F.transform("best", lambda b: b["candidate"])
    rows = planted.join(found.select(F.col("word").alias("typo"), names.alias("top3")), "typo", "left")
    return rows.select(
        "gold", "typo", F.array_join("top3", "; ").alias("top3"),
        F.coalesce(F.get("top3", F.lit(0)) == F.col("gold"), F.lit(False)).alias("top1_correct"),
        F.coalesce(F.array_contains("top3", F.col("gold")), F.lit(False)).alias("top3_correct"),
    )


_FORMS = "list_distinct([{0}] || list_transform(range(1, length({0}) + 1), lambda i: substr({0}, 1, i - 1) || substr({0}, i + 1)))"
SWAP_SUGGESTIONS = f"""
WITH {spelling._EVERY_TYPO}, pl AS MATERIALIZED (SELECT typo, gold FROM typos WHERE typo <> gold),
u AS (SELECT w AS typo, unnest({_FORMS.format('w')}) AS form FROM (SELECT DISTINCT typo AS w FROM pl)),
v AS (SELECT word, count, unnest({_FORMS.format('word')}) AS form FROM freq),
c AS (SELECT DISTINCT typo, word, count FROM u JOIN v USING (form)),
n AS (SELECT *, damerau_levenshtein({spelling._ASCII.format('typo')}, {spelling._ASCII.format('word')}) AS d FROM c),
r AS (SELECT *, row_number() OVER (PARTITION BY typo ORDER BY d, count DESC, word) AS r FROM n WHERE d <= 1),
t AS (SELECT typo, list(word ORDER BY r) AS top3 FROM r WHERE r <= 3 GROUP BY typo)
SELECT gold, typo, array_to_string(top3, '; ') AS top3, coalesce(top3[1] = gold, FALSE) AS top1_correct,
  coalesce(list_contains(top3, gold), FALSE) AS top3_correct FROM pl LEFT JOIN t USING (typo)"""


def decided_words(spark: SparkSession, d: str) -> DataFrame:
    """Proposals out of planted typos, and a log of decisions about most of them: pending, accepted, overruled, late.

    The log follows from the digits of a word's hash: none; accepted; accepted, then rejected;
    accepted, then a rejection that was decided before and arrived after; rejected.
    """
    planted, _ = _planted(spark, d)
    proposals = planted.groupBy(F.col("typo").alias("word")).agg(F.min("gold").alias("candidate"))
    digit = F.substring(F.md5("word"), 1, 1)
    event = lambda seq, decision, at: F.struct(F.lit(seq).alias("seq"), F.lit(decision).alias("decision"), F.lit(at).alias("decided_at"))
    log = (
        F.when(digit < "4", F.array().cast("array<struct<seq: int, decision: string, decided_at: int>>"))
        .when(digit < "a", F.array(event(1, "accept", 100)))
        .when(digit < "d", F.array(event(1, "accept", 100), event(2, "reject", 200)))
        .when(digit < "e", F.array(event(1, "accept", 200), event(2, "reject", 150)))
        .otherwise(F.array(event(1, "reject", 100)))
    )
    events = proposals.select("word", "candidate", F.inline(log))
    return decisions.decided(proposals, events)


DECIDED_WORDS = f"""
WITH {spelling._EVERY_TYPO}, dp AS (SELECT typo AS word, min(gold) AS candidate, substr(md5(typo), 1, 1) AS g FROM typos WHERE typo <> gold GROUP BY typo)
SELECT word, candidate, CASE WHEN g < '4' THEN 'pending' WHEN g < 'a' OR g = 'd' THEN 'accepted' ELSE 'rejected' END AS decision,
  CASE WHEN g >= '4' AND g < 'a' OR g = 'd' THEN candidate ELSE word END AS form,
  CASE WHEN g < '4' THEN NULL WHEN g < 'a' OR g > 'd' THEN 100 ELSE 200 END AS decided_at,
  CASE WHEN g < '4' THEN 0 WHEN g < 'a' OR g > 'd' THEN 1 ELSE 2 END AS events, g BETWEEN 'a' AND 'd' AS overruled, g = 'd' AS late FROM dp"""


def named_words(spark: SparkSession, d: str) -> DataFrame:
    """The word list with names told by capitals where no sentence begins."""
    shares = spell.name_shares(documents(spark, d), "text", SCRIPT)
    return spell.with_names(spelling.wordlist_sources(spark, d), shares)


NAMED_WORDS = rf"""
WITH s AS (SELECT unnest(list_filter(list_transform(string_split(regexp_replace(text, '([.!?…])\s+|\n+', '\1' || chr(1), 'g'), chr(1)), lambda x: trim(x)), lambda x: length(x) > 0)) AS s FROM documents),
tk AS (SELECT regexp_extract_all(s, '[{spelling.LW}]{{3,}}') AS t FROM s),
i AS (SELECT unnest(t[2:]) AS token FROM tk),
sh AS (SELECT lower(token) AS word, count(*) AS n, count(*) FILTER (token[1] <> lower(token[1])) AS c FROM i GROUP BY 1),
l AS ({spelling.WORDLIST_SOURCES})
SELECT l.* EXCLUDE (notes), round(c / nullif(n, 0)::DOUBLE, 6) AS name_share, coalesce(c / n::DOUBLE >= 0.5::DOUBLE AND c >= 2, FALSE) AS name,
  concat_ws('; ', nullif(notes, ''), CASE WHEN coalesce(c / n::DOUBLE >= 0.5::DOUBLE AND c >= 2, FALSE) THEN '{spell.NAME_NOTE}' END) AS notes
FROM l LEFT JOIN sh USING (word)"""

# ---- inventory over several runs -------------------------------------------------


def inventory_runs(spark: SparkSession, d: str) -> DataFrame:
    """Three runs over the corpora (language and source): each counts more documents; some corpora time out in the second run, some always."""
    docs = load(spark, d, "documents")
    at = F.substring(F.md5(F.col("doc_id").cast("string")), 1, 1)
    key = F.concat_ws("/", "lang", "source")
    counted = docs.groupBy(key.alias("corpus")).agg(*[F.count_if(at < c).cast("bigint").alias(f"r{i}") for i, c in enumerate(("6", "b", "g"), 1)])
    digit = F.substring(F.md5("corpus"), 1, 1)
    runs = counted.select(
        "corpus",
        F.when(digit != "f", F.split("corpus", "/")[0]).alias("code"),
        F.explode(F.array(*[F.struct(F.lit(i).alias("run"), F.col(f"r{i}").alias("pairs")) for i in (1, 2, 3)])).alias("x"),
    ).select("corpus", "code", "x.run", "x.pairs")
    fails = (F.col("code").isNull()) | (digit < "2") | ((digit < "8") & (F.col("run") == 2))
    checked = runs.withColumn("checked", ~fails).withColumn("opus_error", F.when(fails & F.col("code").isNotNull(), "timeout"))
    checked = checked.withColumn("pairs", F.when(F.col("checked"), F.col("pairs")))
    return snapshots.as_of(checked, "corpus", "run", "checked", "code", "opus_error", ["pairs"])


INVENTORY_RUNS = """
WITH c AS (SELECT lang || '/' || source AS corpus, lang, substr(md5(doc_id::VARCHAR), 1, 1) AS a FROM documents),
n AS (SELECT corpus, any_value(lang) AS lang, substr(md5(corpus), 1, 1) AS g, count(*) FILTER (a < '6') AS r1, count(*) FILTER (a < 'b') AS r2, count(*) AS r3 FROM c GROUP BY corpus),
r AS (SELECT corpus, CASE WHEN g <> 'f' THEN lang END AS code, g, run, CASE run WHEN 1 THEN r1 WHEN 2 THEN r2 ELSE r3 END AS pairs, r1 FROM n, range(1, 4) t(run)),
f AS (SELECT *, g = 'f' OR g < '2' OR g < '8' AND run = 2 AS fails FROM r)
SELECT corpus, code, run::INT AS run, NOT fails AS checked, CASE WHEN fails AND g <> 'f' THEN 'timeout' ELSE '' END AS opus_error,
  CASE WHEN NOT fails THEN pairs WHEN run = 2 AND g >= '2' AND g < '8' THEN r1 ELSE 0 END AS pairs,
  CASE WHEN NOT fails THEN run WHEN run = 2 AND g >= '2' AND g < '8' THEN 1 END::INT AS from_run, fails AND run = 2 AND g >= '2' AND g < '8' AS cached_from_previous_run FROM f"""

NAMES = [
    "nearest_indexed", "mined_indexed", "refreshed_keys", "verified_duplicates", "aligned_error_rates", "swap_suggestions",
    "decided_words", "named_words", "inventory_runs",
]
QUERIES = {n: globals()[n] for n in NAMES}
ORACLES = {n: globals()[n.upper()] for n in NAMES if n.upper() in globals()}
