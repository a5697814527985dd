"""Quality rules whose cutoffs reject few good documents, proven on labelled ones; DataFrame operations only (operator 12)."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from vacancia.llm.common import stored

WORD = r"[^\x20\x09-\x0D]+"
SYMBOLS = r"[#*$%&|<>]"
WINDOW = 5  # words
TOP = 1000  # levels are whole numbers from 0 to this

#: Level of each rule, the greater the worse, from the counts below.
RULES = {
    "symbols": "1000 * n_symbols div greatest(word_chars, 1)",
    "dup_lines": "1000 * n_dup_lines div greatest(n_lines, 1)",
    "repeats": "1000 * n_repeat_words div greatest(n_words, 1)",
    "long_words": "10 * word_chars div greatest(n_words, 1)",
    "short_words": "1000 - least(1000, 100 * word_chars div greatest(n_words, 1))",
}


def counts(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` without its text, with counts over the whole text (null: none): n_words, word_chars (code points in words),
    n_symbols, n_lines (with a word), n_dup_lines (with a word, equal to an earlier one), n_repeat_words (in windows of
    WINDOW words that the text holds twice or more), all long.

    Windows are found by sorting a row's own window hashes, only in texts where two are equal; equal hashes are confirmed
    word by word. No text leaves its row.
    """
    word = lambda i: F.get("__w", i)
    count = lambda c: F.coalesce(c.cast("long"), F.lit(0).cast("long"))
    cut = docs.withColumns({
        "__w": F.regexp_extract_all(F.coalesce(F.col(text), F.lit("")), F.lit(f"({WORD})"), 1),
        "__l": F.filter(F.split(F.col(text), "\n", -1), lambda x: x.rlike(WORD)),
    })
    n = F.size("__w")
    hashes = F.transform(F.sequence(F.lit(0), n - WINDOW), lambda i: F.xxhash64(*(word(i + k) for k in range(WINDOW))))
    counted = cut.withColumns({
        "n_words": count(n),
        "word_chars": count(F.aggregate("__w", F.lit(0).cast("long"), lambda a, x: a + F.length(x))),
        "n_symbols": count(F.length(text) - F.length(F.regexp_replace(text, SYMBOLS, ""))),
        "n_lines": count(F.size("__l")),
        "n_dup_lines": count(F.size("__l") - F.size(F.array_distinct("__l"))),
        "__h": F.when(n >= WINDOW, hashes),
    }).withColumns({"n_lines": F.greatest("n_lines", F.lit(0)), "n_dup_lines": F.greatest("n_dup_lines", F.lit(0))})
    marks = F.sort_array(F.transform("__h", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    marked = counted.withColumn("__m", F.when(F.size(F.array_distinct("__h")) < F.size("__h"), marks))

    def twin(m: Column, j: Column) -> Column:
        other = F.get("__m", j)
        same = m["h"] == other["h"]
        for k in range(WINDOW):
            same = same & (word(m["i"] + k) == word(other["i"] + k))
        return F.coalesce(same, F.lit(False))

    starts = F.filter(F.transform("__m", lambda m, j: F.when(twin(m, j - 1) | twin(m, j + 1), m["i"])), lambda i: i.isNotNull())
    found = marked.withColumn("__s", F.sort_array(starts))
    zero = F.struct(F.lit(-WINDOW).alias("before"), F.lit(0).cast("long").alias("n"))
    step = lambda a, s: F.struct(s.alias("before"), (a["n"] + F.least(F.lit(WINDOW), s - a["before"])).alias("n"))
    out = found.withColumn("n_repeat_words", count(F.aggregate("__s", zero, step, lambda a: a["n"])))
    return out.drop("__w", "__l", "__h", "__m", "__s", text)


def most_failures(n: Column, risk: float, level: Column) -> Column:
    """The greatest k with P(Binomial(n, risk) <= k) <= level, -1 where there is none: with k or fewer failures among n the exact
    (Clopper-Pearson) bound on the rate of failures is ``risk`` at most, at confidence 1 - ``level``.

    The terms are added up from k = 0 on, as logarithms; beyond the mean no k can do.
    """
    odds = F.lit(risk / (1 - risk))

    def step(a: Column, i: Column) -> Column:
        total = F.greatest(a["total"], a["term"]) + F.log1p(F.exp(-F.abs(a["total"] - a["term"])))
        term = a["term"] + F.log(F.greatest(n - i, F.lit(1)) / (i + 1) * odds)
        return F.struct(term.alias("term"), total.alias("total"), F.when(total <= F.log(level), i).otherwise(a["k"]).alias("k"))

    first = F.struct((n * F.log(F.lit(1 - risk))).alias("term"), F.lit(-1e300).alias("total"), F.lit(-1).cast("long").alias("k"))
    return F.aggregate(F.sequence(F.lit(0).cast("long"), F.ceil(n * risk).cast("long")), first, step, lambda a: a["k"])


def cutoffs(labelled: DataFrame, rules: Mapping[str, str], risk: float, level: float) -> DataFrame:
    """(stratum, rule, at): per stratum the level from which a rule rejects; no row where a rule rejects nothing.

    ``labelled`` has stratum, good and the rules' levels. A stratum's good documents are to be rejected at a rate of ``risk`` at
    most by all rules together, in all strata at once with confidence 1 - ``level``. Each rule gets an equal part of the
    risk, each pair of rule and stratum an equal part of ``level``. A pair's levels are tested from the laxest on; the number
    of good documents rejected grows on the way, so those that pass come first and testing stops at the first that does not
    (a fixed sequence, which needs no further correction). Of those that pass, all valid together, the one is taken that rejects
    most bad documents less good ones, the laxest of equals.
    """
    names = list(rules)
    pairs = F.explode(F.map_from_arrays(F.array(*map(F.lit, names)), F.array(*names))).alias("rule", "level")
    tally = labelled.select("stratum", "good", pairs).groupBy("stratum", "rule", "level")
    tally = tally.agg(F.count_if(F.col("good")).alias("good"), F.count_if(~F.col("good")).alias("bad"))  # at most TOP + 1 rows a rule and stratum
    tally = stored(tally, "tally")
    sizes = tally.where(F.col("rule") == names[0]).groupBy("stratum").agg(F.sum("good").alias("n"))
    tests = sizes.agg(F.count_if(F.col("n") > 0).alias("strata"))
    allowed = sizes.join(F.broadcast(tests)).withColumn(
        "allowed", most_failures(F.col("n"), risk / len(names), F.lit(level / len(names)) / F.greatest("strata", F.lit(1)))
    )
    down = Window.partitionBy("stratum", "rule").orderBy(F.desc("level"))
    tried = tally.select("stratum", "rule", "level", F.sum("good").over(down).alias("wrong"), F.sum("bad").over(down).alias("right"))
    valid = tried.join(allowed.select("stratum", "allowed"), "stratum").where("wrong <= allowed and right > wrong")
    return valid.groupBy("stratum", "rule").agg(F.max(F.struct(F.expr("right - wrong"), "level"))["level"].alias("at"))


def judge(
    docs: DataFrame,
    labels: DataFrame,
    rules: Mapping[str, str] = RULES,
    strata: str = "lang",
    id_col: str = "doc_id",
    text: str = "text",
    good: str = "quality = 1",
    risk: float = 0.02,
    level: float = 0.05,
    least_words: int = 10,
    most_repeats: int = 20,
) -> DataFrame:
    """(id, counts of ``counts``, stratum, base_failed, failed, kept), one row per row of ``docs``.

    base_failed: fewer than ``least_words`` words, or over ``most_repeats`` percent of the words in repeated windows. kept: not
    so, and no rule's level reaches its cutoff; ``failed`` names the rules that do, in the order of the rules. Cutoffs are those
    of ``cutoffs``, learned from the rows with a label in ``labels`` (id, and a condition ``good``) that pass the base.
    Several labels of a document count as good if one is; labels that are null or of no document are not used. ``strata`` is a
    column of ``docs``, null a stratum of its own; a stratum without enough good labels rejects nothing. Null text has no
    words. Repeated rows count and come out as often as they came in, null ids as well; without labels only the base decides.
    """
    named = docs.select(F.col(id_col).alias("id"), F.col(text).alias("text"), F.coalesce(F.col(strata).cast("string"), F.lit("")).alias("stratum"), F.col(strata).isNull().alias("none"))
    made = counts(named).withColumn("stratum", F.when(F.col("none"), "").otherwise(F.concat(F.lit("="), "stratum"))).drop("none")
    failed = (F.col("n_words") < least_words) | (100 * F.col("n_repeat_words") > most_repeats * F.col("n_words"))
    made = made.withColumns({"base_failed": failed, **{r: F.least(F.lit(TOP), F.expr(e)).cast("int") for r, e in rules.items()}})
    made = stored(made, "counts")
    marks = labels.select(F.col(id_col).alias("id"), F.expr(good).alias("good")).where("id is not null and good is not null")
    marks = marks.groupBy("id").agg(F.max("good").alias("good"))
    labelled = made.where("not base_failed").select("id", "stratum", *rules).join(marks, "id")
    found = cutoffs(labelled, rules, risk, level)
    wide = found.groupBy("stratum").agg(*(F.max(F.when(F.col("rule") == r, F.col("at"))).alias(f"at_{r}") for r in rules))
    judged = made.join(stored(wide, "cutoffs"), "stratum", "left")  # a small file: Spark checks its size before it broadcasts
    over = F.filter(F.array(*(F.when(F.col(r) >= F.col(f"at_{r}"), F.lit(r)) for r in rules)), lambda x: x.isNotNull())
    judged = judged.withColumn("failed", over).withColumn("kept", ~F.col("base_failed") & (F.size("failed") == 0))
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    return judged.select(F.col("id").alias(id_col), *names, "base_failed", "kept", F.expr("nullif(substring(stratum, 2), '')").alias("stratum"), "failed")
