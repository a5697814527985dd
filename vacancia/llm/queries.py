"""The registered queries of this subpackage, ``opN_<name>``, and their SQL where there is any."""

from __future__ import annotations

import zlib

import numpy as np
import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vacancia.llm import brown, bwt, covertree, language, leaks, lines, negatives, periodic, pieces, quality, quotes, shards, simhash
from vacancia.llm.common import stored, table

TOKENIZER = "piece_bpe_32k.model"


def op1_quotes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quotes.reply_order(table(spark, sf_dir, "conversations"))


def op2_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held_out = F.coalesce(language.crc_remainder("doc_id", 3) == 1, F.lit(False))
    dictionaries = language.train(docs.where(~held_out))
    found = language.classify(docs.select("doc_id", "text"), dictionaries)
    return found.select("doc_id", held_out.alias("held_out"), "lang_pred", "score", "rejected")


def op3_line_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = lines.drop_repeated(table(spark, sf_dir, "documents").select("doc_id", "text"))
    n_lines = F.when(F.col("text").isNull(), 0).otherwise(F.size(F.split("text", "\n"))).cast("long")
    kept = F.sha2(F.coalesce("kept", F.lit("")).cast("binary"), 256)
    return out.select("doc_id", n_lines.alias("n_lines"), "n_removed", "n_runs", kept.alias("kept_sha256"))


OP3_SQL = """
WITH d AS (SELECT doc_id, text, string_split(text, chr(10)) AS l FROM documents WHERE text IS NOT NULL),
w AS (SELECT doc_id, l, unnest(range(len(l) - 2)) AS pos FROM d WHERE len(l) > 2),
later AS (
  SELECT doc_id, pos FROM w
  QUALIFY row_number() OVER (PARTITION BY l[pos + 1], l[pos + 2], l[pos + 3] ORDER BY doc_id, pos) > 1
),
gone AS (SELECT DISTINCT doc_id, pos + k AS pos FROM later, (SELECT unnest([0, 1, 2]) AS k)),
counted AS (
  SELECT doc_id, count(*) AS n_removed, count(*) FILTER (WHERE fresh) AS n_runs
  FROM (SELECT doc_id, coalesce(lag(pos) OVER (PARTITION BY doc_id ORDER BY pos) < pos - 1, true) AS fresh FROM gone) GROUP BY doc_id
),
kept AS (
  SELECT e.doc_id, string_agg(e.line, chr(10) ORDER BY e.pos) AS text
  FROM (SELECT doc_id, unnest(l) AS line, unnest(range(len(l))) AS pos FROM d) e ANTI JOIN gone USING (doc_id, pos) GROUP BY e.doc_id
)
SELECT o.doc_id, CASE WHEN o.text IS NULL THEN 0 ELSE len(string_split(o.text, chr(10))) END AS n_lines,
       coalesce(c.n_removed, 0) AS n_removed, coalesce(c.n_runs, 0) AS n_runs, sha256(coalesce(k.text, '')) AS kept_sha256
FROM documents o LEFT JOIN counted c USING (doc_id) LEFT JOIN kept k USING (doc_id)
"""


def op4_brown(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    held_out = F.coalesce(language.crc_remainder("doc_id", 7) == 2, F.lit(False))
    learn = docs.where(~held_out)
    counts = stored(brown.word_counts(learn), "counts")
    model = brown.train(learn, counts)
    out = brown.score(docs, model, counts, extra=(held_out.alias("held_out"),))
    return out.withColumn("train_tokens", F.lit(model.tokens).cast("long"))


def op5_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    model = pieces.model_bytes(public_tokenizers.path(TOKENIZER))
    return pieces.digests(table(spark, sf_dir, "documents"), model)


def op6_kd_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = shards.shard_documents(table(spark, sf_dir, "documents"))
    none = F.lit(None).cast("int").alias("grown_shard")
    return out.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), F.col("shard").cast("int"), "slot", none)


def op7_cover_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = covertree.top_k(table(spark, sf_dir, "embeddings"), "id % 50 = 0")
    return found.select("query_id", "rank", F.col("id").alias("vec_id"), "score")


OP7_SQL = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = len(embedding)
)
SELECT q.vec_id AS query_id, CAST(row_number() OVER w AS INTEGER) AS rank, d.vec_id AS vec_id,
       CAST(list_sum(list_transform(list_zip(q.v, d.v), lambda p: p[1] * p[2])) AS BIGINT) AS score
FROM v q JOIN v d ON q.vec_id <> d.vec_id AND len(q.v) = len(d.v) WHERE q.vec_id % 50 = 0
WINDOW w AS (PARTITION BY q.vec_id ORDER BY list_sum(list_transform(list_zip(q.v, d.v), lambda p: p[1] * p[2])) DESC, d.vec_id)
QUALIFY rank <= 5
"""


def op8_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


def op9_leaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return leaks.leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op10_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = bwt.remove_repeats(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


# bytes as two hexadecimal digits each
OP10_SQL = """
WITH d AS (SELECT doc_id, encode(coalesce(text, '')) AS bytes, hex(encode(coalesce(text, ''))) AS x FROM documents),
w AS (SELECT doc_id, unnest(range(1, octet_length(bytes) - 48)) AS i, bytes FROM d WHERE octet_length(bytes) >= 50),
s AS (SELECT doc_id, 2 * i - 1 AS pos, min(doc_id) OVER (PARTITION BY hash(array_slice(bytes, i, i + 49))) AS least FROM w),
r AS (SELECT doc_id, pos, lag(pos) OVER (PARTITION BY doc_id ORDER BY pos) AS before FROM s WHERE least < doc_id),
g AS (SELECT doc_id, pos, sum(CASE WHEN before + 100 >= pos THEN 0 ELSE 1 END) OVER (PARTITION BY doc_id ORDER BY pos) AS span FROM r),
p AS (SELECT doc_id, span, min(pos) AS a, max(pos) + 100 AS b FROM g GROUP BY ALL),
k AS (
  SELECT doc_id, a, b, coalesce(lag(b) OVER (PARTITION BY doc_id ORDER BY a), 1) AS from_, row_number() OVER (PARTITION BY doc_id ORDER BY a DESC) = 1 AS final FROM p
),
t AS (
  SELECT k.doc_id, sum(b - a) / 2 AS n_removed, count(*) AS n_spans,
         string_agg(substr(x, from_, a - from_) || CASE WHEN final THEN substr(x, b) ELSE '' END, '' ORDER BY a) AS kept
  FROM k JOIN d USING (doc_id) GROUP BY k.doc_id
)
SELECT d.doc_id, CAST(length(x) / 2 AS BIGINT) AS n_bytes, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed, coalesce(n_spans, 0) AS n_spans,
       sha256(unhex(coalesce(kept, x))) AS kept_sha256
FROM d LEFT JOIN t USING (doc_id)
"""



def op11_strassen_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = F.expr("CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END")
    return negatives.hard_negatives(table(spark, sf_dir, "embeddings").withColumn("label", label), "id % 100 = 0")


OP11_SQL = """
WITH v AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = len(embedding)
),
s AS (
  SELECT a.vec_id AS anchor_id, d.vec_id AS id, a.label = d.label AS same,
         CAST(list_sum(list_transform(list_zip(a.v, d.v), lambda p: p[1] * p[2])) AS BIGINT) AS score
  FROM v a JOIN v d ON a.vec_id <> d.vec_id AND len(a.v) = len(d.v) WHERE a.vec_id % 100 = 0
),
p AS (SELECT anchor_id, id, score FROM s WHERE same QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= 5)
SELECT p.anchor_id, p.id AS positive_id, CAST(row_number() OVER w AS INTEGER) AS rank, s.id AS negative_id,
       p.score AS positive_score, s.score AS negative_score
FROM p JOIN s ON p.anchor_id = s.anchor_id AND NOT s.same AND 80 * p.score <= 100 * s.score AND 100 * s.score <= 100 * p.score
WINDOW w AS (PARTITION BY p.anchor_id, p.id ORDER BY s.score DESC, s.id)
QUALIFY rank <= 5
"""


def op12_risk_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = quality.judge(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return out.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


OP12_SQL = r"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, text, coalesce('=' || lang, '') AS stratum, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w,
         list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS l FROM documents
),
words AS (SELECT r, unnest(w) AS w, unnest(range(len(w))) AS i FROM d),
five AS (
  SELECT r, i, w AS a, lead(w, 1) OVER o AS b, lead(w, 2) OVER o AS c, lead(w, 3) OVER o AS e, lead(w, 4) OVER o AS f FROM words
  WINDOW o AS (PARTITION BY r ORDER BY i)
),
twice AS (SELECT r, i FROM five WHERE f IS NOT NULL QUALIFY count(*) OVER (PARTITION BY r, a, b, c, e, f) > 1),
covered AS (
  SELECT r, sum(least(5, i - before)) AS n FROM (SELECT r, i, coalesce(lag(i) OVER (PARTITION BY r ORDER BY i), -5) AS before FROM twice) GROUP BY r
),
counted AS (
  SELECT d.r, doc_id, stratum, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(list_sum(list_transform(w, lambda x: length(x))), 0) AS BIGINT) AS word_chars,
         CAST(length(coalesce(text, '')) - length(regexp_replace(coalesce(text, ''), '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
         CAST(len(l) AS BIGINT) AS n_lines, CAST(len(l) - len(list_distinct(l)) AS BIGINT) AS n_dup_lines, CAST(coalesce(n, 0) AS BIGINT) AS n_repeat_words
  FROM d LEFT JOIN covered USING (r)
),
levels AS (
  SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed,
         least(1000, 1000 * n_symbols // greatest(word_chars, 1)) AS symbols, least(1000, 1000 * n_dup_lines // greatest(n_lines, 1)) AS dup_lines,
         least(1000, 1000 * n_repeat_words // greatest(n_words, 1)) AS repeats, least(1000, 10 * word_chars // greatest(n_words, 1)) AS long_words,
         1000 - least(1000, 100 * word_chars // greatest(n_words, 1)) AS short_words FROM counted
),
marks AS (SELECT doc_id, bool_or(quality = 1) AS good FROM labels WHERE quality IS NOT NULL GROUP BY doc_id),
labelled AS (
  UNPIVOT (SELECT stratum, good, symbols, dup_lines, repeats, long_words, short_words FROM levels JOIN marks USING (doc_id) WHERE NOT base_failed)
  ON symbols, dup_lines, repeats, long_words, short_words INTO NAME rule VALUE level
),
tally AS (SELECT stratum, rule, level, count(*) FILTER (good) AS good, count(*) FILTER (NOT good) AS bad FROM labelled GROUP BY ALL),
sizes AS (SELECT stratum, CAST(sum(good) AS BIGINT) AS n FROM tally WHERE rule = 'symbols' GROUP BY stratum),
terms AS (SELECT stratum, n, unnest(range(CAST(ceil(n * 0.004) AS BIGINT) + 1)) AS i FROM sizes),
upto AS (
  SELECT stratum, i, sum(exp(lgamma(n + 1) - lgamma(i + 1) - lgamma(n - i + 1) + i * ln(0.004) + (n - i) * ln(0.996))) OVER (PARTITION BY stratum ORDER BY i) AS p
  FROM terms
),
allowed AS (
  SELECT stratum, max(i) AS allowed FROM upto WHERE p <= 0.01 / (SELECT greatest(count(*) FILTER (n > 0), 1) FROM sizes) GROUP BY stratum
),
tried AS (SELECT stratum, rule, level, sum(good) OVER o AS wrong, sum(bad) OVER o AS right_ FROM tally WINDOW o AS (PARTITION BY stratum, rule ORDER BY level DESC)),
cutoffs AS (
  SELECT stratum, rule, level FROM tried JOIN allowed USING (stratum) WHERE wrong <= allowed AND right_ > wrong
  QUALIFY row_number() OVER (PARTITION BY stratum, rule ORDER BY right_ - wrong DESC, level DESC) = 1
),
wide AS (
  SELECT stratum, max(level) FILTER (rule = 'symbols') AS a, max(level) FILTER (rule = 'dup_lines') AS b, max(level) FILTER (rule = 'repeats') AS c,
         max(level) FILTER (rule = 'long_words') AS d, max(level) FILTER (rule = 'short_words') AS e FROM cutoffs GROUP BY stratum
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND NOT coalesce(symbols >= a, false) AND NOT coalesce(dup_lines >= b, false) AND NOT coalesce(repeats >= c, false)
       AND NOT coalesce(long_words >= d, false) AND NOT coalesce(short_words >= e, false) AS kept
FROM levels LEFT JOIN wide USING (stratum)
"""

def planted_runs(doc_id: int | None, n: int) -> np.ndarray | None:
    """Places of words that make every tenth document periodic from a word on, by the CRC-32 of its id; null ids stay."""
    h = zlib.crc32(str(doc_id).encode())
    if doc_id is None or h % 10 or not n:
        return None
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    places = np.arange(n)
    places[a:] = a + (places[a:] - a) % p
    return places


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = periodic.periodic_runs(table(spark, sf_dir, "documents"), rearrange=planted_runs)
    best = F.array_min(F.transform("runs", lambda r: F.struct((-r["length"]).alias("l"), r["start"].alias("start"), r["period"].alias("period"))))
    line = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"].cast("string"), r["length"].cast("string"), r["period"].cast("string")), F.lit("\n")))
    out = out.withColumn("best", best).withColumn("length", -F.col("best.l"))
    return out.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        "best.start",
        "length",
        "best.period",
        F.expr("1000 * length div best.period").alias("exponent_milli"),
        F.sha2(F.array_join(line, "").cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"),
    )


QUERIES = {
    "op1_quotes": op1_quotes,
    "op2_language": op2_language,
    "op3_line_runs": op3_line_runs,
    "op4_brown": op4_brown,
    "op5_pieces": op5_pieces,
    "op6_kd_shards": op6_kd_shards,
    "op7_cover_tree": op7_cover_tree,
    "op8_simhash": op8_simhash,
    "op9_leaks": op9_leaks,
    "op10_repeats": op10_repeats,
    "op11_strassen_negatives": op11_strassen_negatives,
    "op12_risk_rules": op12_risk_rules,
    "op13_periodic_runs": op13_periodic_runs,
}
ORACLE = {"op3_line_runs": OP3_SQL, "op7_cover_tree": OP7_SQL, "op10_repeats": OP10_SQL, "op11_strassen_negatives": OP11_SQL, "op12_risk_rules": OP12_SQL}
