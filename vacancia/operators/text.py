"""TF-IDF over titles and descriptions, as relations and as feature vectors."""

from __future__ import annotations

import sys
import unicodedata
from collections.abc import Sequence
from functools import cache

from pyspark.ml.feature import StopWordsRemover
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from vacancia.operators.keys import top_k


# Hangul syllables decompose by their number: 588 per first letter, 28 per vowel, the last letter may be missing.
_HANGUL = 0xAC00
_HANGUL_END = _HANGUL + 19 * 588
_FIRSTS, _VOWELS, _LASTS = ("".join(map(chr, range(a, a + n))) for a, n in ((0x1100, 19), (0x1161, 21), (0x11A8, 27)))


def plain_letters(text: str) -> str:
    """Compatibility decomposition without combining marks."""
    return "".join(c for c in unicodedata.normalize("NFKD", text) if not unicodedata.combining(c))


@cache
def _accent_table() -> tuple[str, str, dict[str, str]]:
    """Every character whose plain letters are not itself: one-to-one, and one-to-many (or to nothing). Hangul goes by rule."""
    one_from, one_to, many = [], [], {}
    for code in [*range(0xA0, 0xD800), *range(0xE000, sys.maxunicode + 1)]:
        ch = chr(code)
        if _HANGUL <= code < _HANGUL_END:
            continue
        plain = plain_letters(ch)
        if plain == ch:
            continue
        if len(plain) == 1:
            one_from.append(ch)
            one_to.append(plain)
        else:
            many[ch] = plain
    return "".join(one_from), "".join(one_to), many


@cache
def _char_class(some: str) -> str:
    """The characters as the inside of a regular expression's class, neighbours as ranges."""
    codes, runs = sorted(map(ord, some)), []
    for c in codes:
        if runs and c == runs[-1][1] + 1:
            runs[-1][1] = c
        else:
            runs.append([c, c])
    return "".join(rf"\x{{{a:x}}}-\x{{{b:x}}}" for a, b in runs)


def _spelled(part: Column, table: Column) -> Column:
    """One character that becomes several, or a stretch of others as it is."""
    at = F.ascii(part) - F.lit(_HANGUL)
    first = F.substr(F.lit(_FIRSTS), (at / 588).cast("int") + 1, F.lit(1))
    vowel = F.substr(F.lit(_VOWELS), (at % 588 / 28).cast("int") + 1, F.lit(1))
    last = F.when(at % 28 > 0, F.substr(F.lit(_LASTS), (at % 28).cast("int"), F.lit(1))).otherwise(F.lit(""))
    hangul = F.rlike(part, F.lit(rf"^[\x{{{_HANGUL:x}}}-\x{{{_HANGUL_END - 1:x}}}]"))
    spelled = F.when(hangul, F.concat(first, vowel, last)).otherwise(F.coalesce(F.element_at(table, part), part))
    return F.when(F.ascii(part) < 128, part).otherwise(spelled)


def strip_accents(df: DataFrame, col: str) -> DataFrame:
    """Drop accents from a text column: the compatibility decomposition of every character, without combining marks.

    Plain ASCII texts stay as they are. Characters that become several are spelled out only in texts that hold one. Whether
    one does is looked up in a table; a regular expression would try hundreds of ranges on every character.
    """
    one_from, one_to, many = _accent_table()
    hangul = rf"\x{{{_HANGUL:x}}}-\x{{{_HANGUL_END - 1:x}}}"
    special = _char_class("".join(many)) + hangul
    pairs = "\x01".join(f"{ch}\x02{plain}" for ch, plain in many.items())
    table = F.str_to_map(F.lit(pairs), F.lit("\x01"), F.lit("\x02"))
    parts = F.regexp_extract_all(col, F.lit(rf"([\x00-\x7f]+|[{special}]|[^\x00-\x7f{special}]+)"), F.lit(1))
    spelled = F.array_join(F.transform(parts, lambda x: _spelled(x, table)), "")
    other = F.regexp_replace(col, r"[\x00-\x7f]+", "")
    several = (F.translate(other, "".join(many), "") != other) | F.rlike(other, F.lit(f"[{hangul}]"))
    whole = F.when(several, spelled).otherwise(F.col(col))
    bare = F.translate(whole, one_from, one_to)
    return df.withColumn(col, F.when(F.rlike(col, F.lit(r"[^\x00-\x7f]")), bare).otherwise(F.col(col)))


def _joined(fields: Sequence[str]):
    return lambda gram: F.concat_ws(" ", *(gram[f] for f in fields))


def with_tokens(
    df: DataFrame,
    text_col: str,
    name: str,
    accents: bool = True,
    ngrams: tuple[int, int] = (1, 1),
    stop_words: Sequence[str] = (),
) -> DataFrame:
    """Adds lower-case words of two or more letters or digits, then the n-grams over them, as one array.

    Each step is a column of its own, so the text is cut once per row however often the words are used.
    """
    out = df.withColumn(name, F.lower(F.coalesce(F.col(text_col), F.lit(""))))
    if accents:
        out = strip_accents(out, name)
    out = out.withColumn(name, F.regexp_extract_all(name, F.lit(r"([\p{L}\p{N}_]{2,})"), F.lit(1)))
    if stop_words:
        out = out.withColumn(name, F.filter(name, lambda w: ~w.isin(*stop_words)))
    if tuple(ngrams) == (1, 1):
        return out
    parts = []
    for n in range(ngrams[0], ngrams[1] + 1):
        if n == 1:
            parts.append(F.col(name))
            continue
        # The n-th word of each gram stands beside the first ones; short texts give no gram.
        shifted = [F.slice(name, F.lit(i + 1), F.greatest(F.size(name) - (n - 1), F.lit(0))) for i in range(n)]
        zipped = F.arrays_zip(*(x.alias(f"w{i}") for i, x in enumerate(shifted)))
        parts.append(F.transform(zipped, _joined([f"w{i}" for i in range(n)])))
    return out.withColumn(name, F.concat(*parts))


def stop_list(stop_words: str | Sequence[str] | None) -> list[str]:
    """A list as given, or Spark's own list for a language name."""
    if stop_words is None:
        return []
    return StopWordsRemover.loadDefaultStopWords(stop_words) if isinstance(stop_words, str) else list(stop_words)


def _one_per_row(df: DataFrame, keep: Sequence[str], items: str, name: str) -> DataFrame:
    """Array items as rows. The outer form keeps Spark from testing the array, and so cutting the text, twice."""
    return df.select(*keep, F.explode_outer(items).alias(name)).where(F.col(name).isNotNull())


def vocabulary(docs: DataFrame, toks: str, max_features: int) -> DataFrame:
    """The most frequent terms with their smoothed inverse document frequency: (term, term_no, idf).

    Ties go to the smaller term. One pass: a document gives its words as they stand and once more each word by itself, so
    the former count the term and the latter its documents. Both combine map-side and no text is shuffled.
    """
    both = [(F.col(toks), 0), (F.array_distinct(toks), 1)]
    lists = F.array(*(F.struct(words.alias("terms"), F.lit(once).alias("once")) for words, once in both))
    halves = docs.select(F.explode(lists).alias("e")).select("e.terms", "e.once")
    rows = _one_per_row(halves, ["once"], "terms", "term")
    counts = rows.groupBy("term").agg(F.sum(1 - F.col("once")).alias("total"), F.sum("once").alias("df"))
    n = docs.agg(F.count("*").alias("n")).scalar()
    return (
        top_k(counts, [F.desc("total"), "term"], max_features)
        .withColumn("term_no", F.row_number().over(W.orderBy("term")) - 1)  # max_features rows
        .select("term", "term_no", (F.log((n + 1) / (F.col("df") + 1)) + 1).alias("idf"))
    )


def tfidf(
    df: DataFrame,
    id_col: str,
    text_col: str,
    ngrams: tuple[int, int] = (1, 2),
    max_features: int = 300,
    sublinear: bool = True,
    accents: bool = True,
    stop_words: str | Sequence[str] | None = None,
) -> DataFrame:
    """(id, term, weight): term frequency times inverse document frequency, unit length per document."""
    docs = with_tokens(df.select(id_col, text_col), text_col, "_t", accents, ngrams, stop_list(stop_words))
    docs = docs.select(id_col, "_t")
    vocab = vocabulary(docs, "_t", max_features)
    counted = (
        _one_per_row(docs, [id_col], "_t", "term")
        .join(F.broadcast(vocab), "term")  # max_features rows
        .groupBy(id_col, "term", "idf")
        .agg(F.count("*").alias("n"))
    )
    tf = F.log(F.col("n")) + 1 if sublinear else F.col("n")
    raw = counted.select(id_col, "term", (tf * F.col("idf")).alias("_w"))
    norm = F.sqrt(F.sum(F.col("_w") * F.col("_w")).over(W.partitionBy(id_col)))
    return raw.select(id_col, "term", (F.col("_w") / norm).alias("weight"))
