from pyspark.sql import functions as F

from vacancia import functions as fn
from vacancia.functions.measures import BANDS_40_80_150


def values(spark, rows, schema, *cols):
    return [tuple(r) for r in spark.createDataFrame(rows, schema).select(*cols).collect()]


def test_title_clean_follows_str_title(spark):
    words = [
        " full-time ", "MID-SENIOR level", "o'neill & sons", "école supérieure", "a1b2c3", "\tother\n", "", "nan", "x",
        "it's 3d-printing", "中文abc def", "ÜBER größe",
    ]
    got = values(spark, [(w,) for w in words] + [(None,)], "w string", fn.title_clean("w").alias("t"))
    want = [None if w.strip().title() == "Nan" else w.strip().title() for w in words] + [None]
    assert [g[0] for g in got] == want


def test_annualize(spark):
    rows = [(10.0, "hourly "), (10.0, "ANNUALLY"), (10.0, "BIWEEKLY"), (10.0, None), (None, "YEARLY"), (2.0, "weekly")]
    got = values(
        spark, rows, "v double, p string", fn.annualize("v", "p").alias("a"), fn.annualize("v", "p", "null").alias("b")
    )
    assert got == [(20800.0, 20800.0), (10.0, 10.0), (10.0, None), (None, None), (None, None), (104.0, 104.0)]


def test_salary_mid(spark):
    rows = [(1.0, 3.0, None), (1.0, 3.0, 5.0), (None, 4.0, None), (None, None, None), (1.0, None, 2.0)]
    cols = fn.salary_mid("a", "b", "m", "etl").alias("e"), fn.salary_mid("a", "b", "m", "clean").alias("c")
    got = values(spark, rows, "a double, b double, m double", *cols)
    assert got == [(2.0, 2.0), (5.0, 3.0), (None, 4.0), (None, None), (2.0, 1.5)]


def test_band_edges_and_guard(spark):
    rows = [(None,), (float("nan"),), (-1.0,), (0.0,), (39999.99,), (40000.0,), (80000.0,), (150000.0,)]
    low, mid, high, top = BANDS_40_80_150[1]
    got = values(
        spark, rows, "v double", fn.band("v", *BANDS_40_80_150).alias("g"), fn.band("v", *BANDS_40_80_150, False).alias("n")
    )
    assert [g[0] for g in got] == ["Unknown"] * 4 + [low, mid, high, top]
    assert [g[1] for g in got] == ["Unknown", "Unknown", low, low, low, mid, high, top]


def test_small_columns(spark):
    rows = [("12", 0, 3, True), ("12.5", 4, None, False), ("x", None, 2, None), ("NaN", 4, 2, True)]
    got = values(
        spark, rows, "t string, views int, applies int, f boolean",
        fn.to_number("t"), fn.safe_ratio("applies", "views"), fn.engagement("views", "applies"), fn.flag("f"),
        fn.as_category("f"), fn.contains_text("t", "N"), fn.map_values("t", {"X": "hit"}, "miss", fold_case=True),
    )
    assert got == [
        (12.0, 0.0, 30, 1, "1", False, "miss"),
        (12.5, 0.0, 4, 0, "0", False, "miss"),
        (None, 0.0, 20, 0, "Unknown", False, "hit"),
        (None, 0.5, 24, 1, "1", True, "miss"),
    ]


def test_epoch_and_months(spark):
    rows = [("1711280400000",), ("1713571199999.0",), ("bad",), (None,)]
    t = fn.epoch_ms("ms")
    got = values(spark, rows, "ms string", fn.listed_date(t).cast("string"), fn.listed_month(t))
    assert got == [("2024-03-24", "2024-03"), ("2024-04-19", "2024-04"), (None, None), (None, None)]


def test_experience_group_folds_case(spark):
    rows = [("Mid-Senior Level",), ("Entry level",), ("Internship",), (None,), ("Chief",)]
    got = values(spark, rows, "e string", fn.experience_group("e"))
    assert [g[0] for g in got] == ["Mid-Senior", "Entry", "Entry", "Unknown", "Unknown"]


def test_half_even(spark):
    got = values(spark, [(0.5,), (1.5,), (2.5,)], "v double", fn.half_even(F.col("v"), 0))
    assert [g[0] for g in got] == [0.0, 2.0, 2.0]


def test_accents_of_any_letter(spark):
    from vacancia.operators.text import plain_letters, strip_accents

    rows = [("ﬁnance ｅｎｇｉｎｅｅｒ",), ("Çà et là",), ("plain",), (None,), ("é 😀 ｅ",), ("",)]
    got = [r.t for r in strip_accents(spark.createDataFrame(rows, "t string").coalesce(1), "t").collect()]
    assert got == ["finance engineer", "Ca et la", "plain", None, "e 😀 e", ""]
    # every 7th character, Hangul and ligatures among them, alone and inside a text
    some = [chr(i) for i in [*range(1, 0xD800, 7), *range(0xF900, 0x1FFFF, 7)]]
    rows = [(c, f"aé{c}b{c}") for c in some]
    out = strip_accents(strip_accents(spark.createDataFrame(rows, "c string, t string"), "t"), "c")
    assert "Python" not in out._jdf.queryExecution().executedPlan().toString()
    got = {(r.c, r.t) for r in out.collect()}
    assert got == {(plain_letters(c), plain_letters(t)) for c, t in rows}


def test_no_long_character_class_is_tried_on_whole_texts(spark, monkeypatch):
    from vacancia.operators.text import plain_letters, strip_accents

    asked, rlike = [], F.rlike
    monkeypatch.setattr(F, "rlike", lambda text, pattern: asked.append(str(pattern)) or rlike(text, pattern))
    rows = ["plain", "\u00e9t\u00e9", "\u00bd cup\u2026 \u00e9", "\uac01 x", "\ufb01n e\u0301 \u0416"]
    out = strip_accents(spark.createDataFrame([(t, t) for t in rows], "t string, c string"), "c")
    assert asked and max(map(len, asked)) < 200
    assert {r.t: r.c for r in out.collect()} == {t: plain_letters(t) for t in rows}
