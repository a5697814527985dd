import os

import pytest
from pyspark.sql import functions as F

from vacancia.operators import audit, keys, star, stats
from vacancia.plans import master, standins
from vacancia.plans.master import build_master, clean_salaries
from vacancia.sources import tables as src
from vacancia.sources.schemas import SCHEMAS

FOLDER = os.environ.get("VACANCIA_SF_DIR", "/root/testdata/sf0.001")


def test_csv_with_breaks_quotes_and_float_ids(spark, tmp_path):
    (tmp_path / "postings.csv").write_text(
        'job_id,company_id,title,description,views,listed_time\n'
        '9007199254740993,12.0,"A ""B"" C","line 1\nline 2, more",7.0,1711280400000\n'
        "2,,X,,bad,\n"
    )
    with pytest.warns(UserWarning):
        t = src.load_tables(spark, str(tmp_path), missing="skip")
    assert list(t) == ["postings"] and t["postings"].columns == SCHEMAS["postings"].names
    rows = t["postings"].select("job_id", "company_id", "title", "description", "views", "applies").collect()
    assert tuple(rows[0]) == (9007199254740993, 12, 'A "B" C', "line 1\nline 2, more", 7, None)
    assert tuple(rows[1]) == (2, None, "X", None, None, None)
    with pytest.raises(FileNotFoundError):
        src.load_tables(spark, str(tmp_path))


def test_write_read_and_first_available(spark, tmp_path):
    df = spark.createDataFrame([(1, 'say "hi"'), (2, None)], "id bigint, t string")
    src.write_table(df, f"{tmp_path}/a.parquet")
    got = src.first_available(spark, [f"{tmp_path}/none.parquet", f"{tmp_path}/a.parquet"])
    assert sorted(map(tuple, got.collect())) == [(1, 'say "hi"'), (2, None)]
    with pytest.raises(FileNotFoundError):
        src.first_available(spark, [f"{tmp_path}/none.parquet"])
    assert src.preview(df, 1)[0] == ["id", "t"]
    assert [tuple(r) for r in src.data_dictionary(df, {"id": "key"}).collect()] == [(1, "id", "bigint", "key"), (2, "t", "string", None)]


def test_duplicates_count_null_keys_as_equal(spark):
    df = spark.createDataFrame([(1, "a"), (1, "a"), (None, "a"), (None, "a"), (2, None)], "k bigint, v string")
    r = audit.key_dups(df, ["k"], "t").first()
    assert (r["total_rows"], r["key_duplicates"], r["duplicate_pct"]) == (5, 2, 0.4)
    assert audit.full_row_dups(df).first()["full_row_duplicates"] == 2
    none = audit.key_dups(df.limit(0), ["k"], "t").first()
    assert (none["total_rows"], none["key_duplicates"], none["duplicate_pct"]) == (0, 0, 0.0)


def test_orphans_and_null_keys(spark):
    child = spark.createDataFrame([(1,), (1,), (9,), (None,)], "k bigint")
    parent = spark.createDataFrame([(1,), (None,)], "id bigint")
    strict = audit.orphans(child, "k", parent, "id").first()
    loose = audit.orphans(child, "k", parent, "id", null_is_invalid=True).first()
    assert (strict["invalid_records_count"], loose["invalid_records_count"]) == (1, 2)
    assert loose["invalid_records_pct"] == 0.5
    assert keys.orphan_rows(child, "k", parent, "id").count() == 1
    assert keys.orphan_rows(child, "k", parent, "id", null_is_invalid=True).count() == 2


def test_best_and_latest_rows(spark):
    df = spark.createDataFrame([(1, None, 1), (1, 5.0, 2), (1, 5.0, 3), (2, None, 4)], "k bigint, m double, i bigint")
    assert {(r["k"], r["i"]) for r in keys.best_per_key(df, ["k"], "m", ["i"]).collect()} == {(1, 2), (2, 4)}
    plan = keys.best_per_key(df, ["k"], "m", ["i"])._jdf.queryExecution().toString()
    assert "WindowGroupLimit" in plan  # a hot key is cut down before the shuffle


def test_salted_enrichment_equals_plain(spark):
    fact = spark.range(500).select("id", F.when(F.col("id") % 3 != 0, F.lit(1)).cast("bigint").alias("k"))
    dim = spark.createDataFrame([(1, "a"), (2, "b")], "k bigint, v string")
    plain = keys.enrich(fact, dim, "k", ["v"])
    salted = keys.enrich(fact, dim, "k", ["v"], salt=4)
    assert sorted(map(str, plain.collect())) == sorted(map(str, salted.collect())) and salted.count() == 500
    with pytest.raises(ValueError):
        keys.enrich(plain, dim, "k", ["v"])


def test_histogram_edges_and_empty(spark):
    df = spark.createDataFrame([(0.0,), (1.0,), (2.5,), (10.0,), (None,)], "v double")
    assert [r["n"] for r in stats.histogram(df, "v", 5).orderBy("bin").collect()] == [2, 1, 0, 0, 1]
    one = stats.histogram(df.where("v = 1"), "v", 3).orderBy("bin").collect()
    assert [r["n"] for r in one] == [0, 1, 0] and (one[0]["left_edge"], one[2]["right_edge"]) == (0.5, 1.5)


def test_calendar_is_continuous_with_iso_weeks(spark):
    df = spark.createDataFrame([("2024-12-28",), ("2025-01-02",), (None,)], "d string").select(F.to_date("d").alias("d"))
    rows = star.dim_calendar(df, "d").orderBy("date").collect()
    assert [r["day"] for r in rows] == [28, 29, 30, 31, 1, 2]
    assert [(r["week"], r["is_weekend"], r["day_name"]) for r in rows[:3]] == [(52, 1, "Saturday"), (52, 1, "Sunday"), (1, 0, "Monday")]
    assert star.dim_calendar(df, "d", observed_only=True).count() == 2


def _tables(spark):
    d = lambda rows, schema: spark.createDataFrame(rows, schema)
    posts = d(
        [
            (1, 10, " data analyst ", "Full-time", None, 50000.0, 70000.0, "YEARLY", 4, 1, 1711280400000, None),
            (1, 10, " data analyst ", "Full-time", None, 50000.0, 70000.0, "YEARLY", 4, 1, 1711280400000, None),
            (2, None, "nan", None, 30.0, None, None, "HOURLY", 8, None, 1711366800000, 61000.0),
            (3, 11, "CEO", "contract", None, None, None, None, 0, 2, 1711366800000, None),
        ],
        """job_id bigint, company_id bigint, title string, formatted_work_type string, med_salary double,
        min_salary double, max_salary double, pay_period string, views bigint, applies bigint, listed_time bigint,
        normalized_salary double""",
    ).selectExpr("*", "'Director' AS formatted_experience_level", "1 AS sponsored", "CAST(NULL AS INT) AS remote_allowed", "'abc' AS description")
    return {
        "postings": posts,
        "companies": d([(10, "acme", 3.0), (10, "acme", 3.0)], "company_id bigint, name string, company_size double"),
        "employee_counts": d(
            [(10, 100, 5, 1), (10, 120, 6, 2), (11, 7, 1, 1)],
            "company_id bigint, employee_count bigint, follower_count bigint, time_recorded bigint",
        ),
        "job_skills": d([(1, "IT"), (1, "IT"), (1, "FIN"), (99, "IT")], "job_id bigint, skill_abr string"),
        "job_industries": d([(1, 5), (1, 4), (3, None)], "job_id bigint, industry_id bigint"),
        "industries": d([(4, "Retail"), (5, "Banking")], "industry_id bigint, industry_name string"),
        "benefits": d([(2, "401k"), (2, "401k"), (2, None)], "job_id bigint, type string"),
        "salaries": d(
            [(1, 1, 70000.0, None, 50000.0, "YEARLY"), (2, 1, 40.0, None, None, "hourly"), (3, 3, 5.0, None, None, "DAILY")],
            "salary_id bigint, job_id bigint, max_salary double, med_salary double, min_salary double, pay_period string",
        ),
    }


def test_master_keeps_one_row_per_job_in_both_variants(spark):
    t = _tables(spark)
    etl = {r["job_id"]: r for r in build_master(t, "etl").collect()}
    assert sorted(etl) == [1, 2, 3]
    assert (etl[1]["normalized_salary"], etl[1]["skill_count"], etl[1]["primary_industry_name"]) == (60000.0, 3, "Retail")
    assert (etl[2]["normalized_salary"], etl[2]["company_id"], etl[2]["benefit_count"]) == (61000.0, -1, 2)
    assert (etl[3]["has_salary"], etl[3]["employee_count"], etl[3]["primary_industry_id"]) == (0, 7, -1)
    assert [etl[i]["is_hot_job"] for i in (1, 2, 3)] == [0, 1, 0] and etl[1]["employee_count"] == 120
    assert (etl[1]["title"], etl[3]["applies_per_view"], etl[2]["engagement_score"]) == (" data analyst ", 0.0, 8)

    clean = {r["job_id"]: r for r in build_master(t, "clean", salary_source="coalesce").collect()}
    assert sorted(clean) == [1, 2, 3]
    assert (clean[1]["title"], clean[2]["title"], clean[3]["title"]) == ("Data Analyst", None, "Ceo")
    assert (clean[1]["skill_count"], clean[2]["benefit_count"], clean[1]["name"]) == (2, 1, "Acme")
    assert clean[3]["employee_count"] == 7 and clean[2]["salary_band"] == "Mid (40-80k)"
    assert clean[1]["normalized_salary"] == pytest.approx(60000 + 0.99 * 23200)  # the better row, pulled in to p99


def test_clean_salaries_keeps_rows_without_known_period(spark):
    got = {r["job_id"]: r["normalized_salary"] for r in clean_salaries(_tables(spark)["salaries"], clip=False).collect()}
    assert got == {1: 83200.0, 3: None}


def test_build_report_shows_what_the_steps_do(spark, monkeypatch):
    """Counts are those of the build itself: a side left with two rows of a job shows in its join, and the last step mends it."""
    d = FOLDER
    tables = standins.tables(spark, d)
    posts = tables["postings"]
    n = posts.count()
    tables["postings"] = posts.union(posts.limit(7))  # repeated rows
    got = {r.step: r for r in master.build_report(tables).collect()}
    assert list(got) == [step for step, *_ in master.BUILD_STEPS] and len(got) == 15
    assert (got["drop_dup_job_id"].rows_in, got["drop_dup_job_id"].rows_out) == (n + 7, n)
    assert all((r.rows_in, r.rows_out) == (n, n) for step, r in got.items() if step.startswith(("join", "postings", "dedup")))
    assert got["benefits_agg"].rows_in == tables["benefits"].count() > got["benefits_agg"].rows_out
    twice = master.benefit_counts
    monkeypatch.setattr(master, "benefit_counts", lambda b, distinct: twice(b, distinct).union(twice(b, distinct)))
    grown = {r.step: r for r in master.build_report(tables).collect()}
    jobs = got["benefits_agg"].rows_out
    assert grown["join_benefits"].rows_out == grown["join_skills"].rows_in == n + jobs
    assert (grown["dedup_final"].rows_in, grown["dedup_final"].rows_out) == (n + jobs, n)


def test_build_report_of_empty_tables(spark):
    tables = {name: df.limit(0) for name, df in standins.tables(spark, FOLDER).items()}
    got = master.build_report(tables).collect()
    assert len(got) == 15 and all((r.rows_in, r.rows_out) == (0, 0) for r in got)
    some = {**standins.tables(spark, FOLDER), "benefits": tables["benefits"]}
    got = {r.step: r for r in master.build_report(some).collect()}
    assert got["benefits_agg"].rows_in == 0 and got["join_benefits"].rows_out == some["postings"].count()


def test_bridge_deals_rows_by_job(spark):
    from vacancia.operators import star

    child = spark.createDataFrame([(1, "a"), (1, "a"), (2, "b"), (3, "c"), (None, "d")], "job_id bigint, skill string")
    fact = spark.createDataFrame([(1,), (3,), (3,)], "job_id bigint")
    rows = star.bridge(child, fact, "job_id", ["job_id", "skill"], 5)
    assert sorted(map(tuple, rows.collect())) == [(1, "a"), (1, "a"), (3, "c")]
    assert rows.rdd.getNumPartitions() == 5
