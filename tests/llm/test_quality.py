"""Quality rules (operator 12) against a brute-force version."""

import collections
import math
import random
import re

import pytest
from pyspark.sql import functions as F

from vacancia.llm import quality

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def counted(t):
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words and n_lines."""
    t = t or ""
    w = WORD.findall(t)
    own = [x for x in t.split("\n") if WORD.search(x)]
    seen = collections.Counter(tuple(w[i : i + 5]) for i in range(len(w) - 4))
    inside = {i + k for i in range(len(w) - 4) if seen[tuple(w[i : i + 5])] > 1 for k in range(5)}
    return len(w), sum(map(len, w)), sum(t.count(c) for c in "#*$%&|<>"), len(own) - len(set(own)), len(inside), len(own)


def levels(c):
    words, chars, symbols, dup, repeats, own = c
    raw = [1000 * symbols // max(chars, 1), 1000 * dup // max(own, 1), 1000 * repeats // max(words, 1), 10 * chars // max(words, 1)]
    return [min(1000, x) for x in raw] + [1000 - min(1000, 100 * chars // max(words, 1))]


def most_failures(n, risk, level):
    total, k = 0.0, -1
    for i in range(n + 1):
        total += math.comb(n, i) * risk**i * (1 - risk) ** (n - i)
        if total > level:
            break
        k = i
    return k


def judged(rows, labels, risk, level):
    """rows: (id, text, lang). Kept or not, per row."""
    marks = {}
    for i, q in labels:
        if i is not None and q is not None:
            marks[i] = marks.get(i, False) or q == 1
    seen = [counted(t) for _, t, _ in rows]
    base = [c[0] < 10 or 100 * c[4] > 20 * c[0] for c in seen]
    held = [(lang, marks[i], levels(c)) for (i, _, lang), c, bad in zip(rows, seen, base, strict=True) if not bad and i in marks]
    n = {lang: sum(good for x, good, _ in held if x == lang) for lang, _, _ in held}
    strata, cut = sum(x > 0 for x in n.values()), {}
    for lang in n:
        allowed = most_failures(n[lang], risk / 5, level / 5 / max(strata, 1))
        for r in range(5):
            best = None
            for v in sorted({x[r] for at, _, x in held if at == lang}, reverse=True):
                wrong, right = (sum(x[r] >= v and good is want for at, good, x in held if at == lang) for want in (True, False))
                if wrong <= allowed and right > wrong and (best is None or right - wrong > best[0]):
                    best = (right - wrong, v)
            cut[lang, r] = best and best[1]
    return [not bad and not any(cut.get((lang, r)) is not None and x >= cut[lang, r] for r, x in enumerate(levels(c))) for (_, _, lang), c, bad in zip(rows, seen, base, strict=True)]


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(12)
    vocab = [f"{a}{b}" for a in ("ka", "lo", "mira", "été", "日本") for b in ("", "n", "tor", "s", "lu", "ben")]
    text = lambda n: " ".join(rng.choice(vocab) for _ in range(n))
    out = []
    for i in range(700):
        t = text(rng.randint(8, 60))
        if i % 7 == 0:  # junk
            t += " " + " ".join(rng.choice(["#*$", "<x>", "a|b", "zzzzzzzzzzzzzzzzzzzz"]) for _ in range(rng.randint(4, 20)))
        if i % 11 == 0:
            t = "\n".join([t, "line again", "  ", "line again"] * rng.randint(1, 2))
        out.append((i, t, rng.choice(["en", "en", "fr", None, "", "rare" if i < 5 else "en"])))
    same = text(6)
    out += [(800, None, "en"), (801, "", "en"), (802, " \n\t\x0b\x0c\r \n", "fr"), (803, "x" * 200_000, "en"), (804, (text(7) + " ") * 6000, "en"), (None, out[7][1], "en")]
    out += [(805, "a b c d e " * 2, "en"), (806, "a b c d e", "en"), (807, "    a b " * 5, "en"), out[3], out[3]]
    return out + [(900 + i, same + " " + text(12) + " " + same, "fr") for i in range(30)]


@pytest.fixture(scope="module")
def docs(spark, rows):
    made = spark.createDataFrame([(*r, 1, "x", 2, True) for r in rows], "doc_id long, text string, lang string, n_words int, stratum string, symbols int, kept boolean")
    return made.repartition(4).cache()


def test_counts(docs, rows):
    got = quality.counts(docs.select("doc_id", "text")).collect()
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines"]
    assert collections.Counter((r.doc_id, *(r[n] for n in names)) for r in got) == collections.Counter((i, *counted(t)) for i, t, _ in rows)


def test_binomial_bound(spark):
    cases = [(n, p, d) for n in (0, 1, 5, 40, 300, 900) for p in (0.004, 0.05, 0.3) for d in (0.2, 0.01, 1e-5)]
    for p in (0.004, 0.05, 0.3):
        own = [(n, d) for n, q, d in cases if q == p]
        df = spark.createDataFrame(own, "n long, level double").withColumn("k", quality.most_failures(F.col("n"), p, F.col("level")))
        assert {(r.n, r.level): r.k for r in df.collect()} == {(n, d): most_failures(n, p, d) for n, d in own}
    large = spark.range(1).select(quality.most_failures(F.lit(2_000_000).cast("long"), 0.01, F.lit(1e-6)).alias("k")).first().k
    assert 20_000 - 5.2 * 141 < large < 20_000 - 4.3 * 141  # terms far under the least double at the start


@pytest.mark.parametrize(("risk", "level"), [(0.02, 0.05), (0.3, 0.2), (0.9, 0.5)])
def test_judge(spark, docs, rows, risk, level):
    rng = random.Random(5)
    labels = [(i, rng.choice([0, 1]) if i % 7 == 0 else int(rng.random() < 0.97)) for i in range(700) if rng.random() < 0.9]
    labels += [(None, 1), (3, None), (7, 0), (7, 1), (99_999, 1), (901, 1), (902, 0)]
    marks = spark.createDataFrame([(*x, 0, "q") for x in labels], "doc_id long, quality int, toxic int, text string")
    want = judged(rows, labels, risk, level)
    got = quality.judge(docs, marks, risk=risk, level=level)
    assert collections.Counter((r.doc_id, r.kept) for r in got.collect()) == collections.Counter((i, k) for (i, _, _), k in zip(rows, want, strict=True))
    assert got.where("kept = (base_failed or size(failed) > 0)").count() == 0
    if risk > 0.02:
        assert got.where("size(failed) > 0").count() > 0


def test_without_labels_or_rows(spark, docs):
    none = spark.createDataFrame([], "doc_id long, quality int")
    assert quality.judge(docs, none).where("kept = base_failed").count() == 0
    assert quality.judge(docs.limit(0), none).count() == 0


def test_new_documents_are_rejected_within_the_risk(spark):
    """Cutoffs learned on one half hold on the other: the promise is for documents not seen."""
    rng = random.Random(1)
    sample = [(rng.choice("ab"), i % 4 > 0, min(1000, int(abs(rng.gauss(0, 90 if i % 4 else 300)))), rng.randint(0, 1000)) for i in range(24_000)]
    df = spark.createDataFrame(sample[:12_000], "stratum string, good boolean, x int, y int")
    found = {(r.stratum, r.rule): r["at"] for r in quality.cutoffs(df, {"x": "", "y": ""}, 0.05, 0.05).collect()}
    assert {("a", "x"), ("b", "x")} <= set(found)
    for s in "ab":
        good = [r for r in sample[12_000:] if r[0] == s and r[1]]
        wrong = sum(x >= found[s, "x"] or y >= found.get((s, "y"), 2000) for _, _, x, y in good)
        bad = [r for r in sample[12_000:] if r[0] == s and not r[1]]
        assert wrong <= 0.05 * len(good) and sum(r[2] >= found[s, "x"] for r in bad) > 0.3 * len(bad)
