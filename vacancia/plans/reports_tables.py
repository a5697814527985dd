"""Registered queries: sources, audit, filters, cleaning, joins."""

from __future__ import annotations

from pyspark.sql import functions as F

from vacancia.functions import (
    annualize,
    as_category,
    code_clean,
    contains_text,
    epoch_ms,
    fill,
    flag,
    half_even,
    label_from_expm1,
    label_to_log1p,
    listed_date,
    listed_month,
    salary_mid,
    text_length,
    title_clean,
    to_number,
)
from vacancia.operators import audit, children, keys
from vacancia.operators import features as ft
from vacancia.plans import shared as q
from vacancia.plans import standins as s
from vacancia.plans.master import clean_salaries, latest_counts
from vacancia.plans.registry import query, rounded, with_
from vacancia.session import scratch_folder
from vacancia.sources import tables as src
from vacancia.sources.schemas import SCHEMAS

# --- sources ------------------------------------------------------------------


@query(
    "csv_round_trip",
    "A1 A2 A6",
    with_(q.JOB_SKILLS, select="SELECT job_id, skill_abr, count(*) AS n FROM job_skills GROUP BY job_id, skill_abr"),
)
def csv_round_trip(spark, d):
    """Write a table as CSV, load the folder by schema, skip the tables that are not there."""
    folder = scratch_folder(spark, "csv")
    src.write_table(s.job_skills(spark, d), f"{folder}/job_skills.csv", "csv")
    found = src.load_tables(spark, folder, {"job_skills": SCHEMAS["job_skills"]}, missing="skip")
    return found["job_skills"].groupBy("job_id", "skill_abr").agg(F.count("*").alias("n"))


@query("pruned_scan", "A3 C2", "SELECT o_orderkey AS job_id, o_totalprice AS salary FROM orders")
def pruned_scan(spark, d):
    return s.raw(spark, d, "orders").select("o_orderkey", "o_totalprice").withColumnsRenamed(
        {"o_orderkey": "job_id", "o_totalprice": "salary"}
    )


@query("table_preview", "A4")
def table_preview(spark, d):
    return src.preview(s.postings(spark, d), 10)[1]


@query(
    "first_available_source",
    "A5",
    "SELECT o_custkey AS company_id, count(*) AS n FROM orders GROUP BY o_custkey",
)
def first_available_source(spark, d):
    df = src.first_available(spark, [f"{d}/no_such_table.parquet", f"{d}/orders.parquet"])
    return df.groupBy(F.col("o_custkey").alias("company_id")).agg(F.count("*").alias("n"))


@query(
    "company_from_fact",
    "A5",
    with_(
        q.P,
        select="""SELECT company_id, formatted_work_type, views FROM (
  SELECT *, row_number() OVER (PARTITION BY company_id ORDER BY formatted_work_type, views NULLS FIRST) AS rn
  FROM p WHERE company_id IS NOT NULL) WHERE rn = 1""",
    ),
)
def company_from_fact(spark, d):
    return keys.dim_from_fact(s.postings(spark, d), "company_id", ["formatted_work_type", "views"])


@query("schema_listing", "A8 B1")
def schema_listing(spark, d):
    """The dictionary of a table, with how many of its rows each column fills."""
    df = s.postings(spark, d)
    listed = src.data_dictionary(df, {"job_id": "Unique job posting identifier"})
    counts = audit.column_profile(df, "postings").select("column_name", "n_rows", "missing_count")
    return listed.join(counts, "column_name")


# --- audit ----------------------------------------------------------------------

_PROFILED = [a for _, a in s.POSTING_COLUMNS]


def _profile_sql(table: str, cols: list[str]) -> str:
    return " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, count(*) AS n_rows, count(*) - count({c}) AS missing_count, "
        f"round((count(*) - count({c})) / CAST(count(*) AS DOUBLE), 4) AS missing_pct FROM {table}"
        for c in cols
    )


@query(
    "column_profile",
    "B1 B2",
    with_(
        q.P,
        f"prof AS ({_profile_sql('p', _PROFILED)})",
        select=f"""SELECT *, CAST({len(_PROFILED)} AS BIGINT) AS n_cols,
  CAST((SELECT count(*) FROM p) - (SELECT count(*) FROM (SELECT DISTINCT * FROM p)) AS BIGINT) AS full_row_duplicates FROM prof""",
    ),
)
def column_profile(spark, d):
    out = audit.column_profile(s.postings(spark, d), "postings", full_dups=True)
    return rounded(out.select("column_name", "n_rows", "n_cols", "missing_count", "missing_pct", "full_row_duplicates"))


@query(
    "full_row_duplicates",
    "B2",
    with_(
        q.JOB_SKILLS,
        select="""SELECT 'job_skills' AS table_name,
  CAST((SELECT count(*) FROM job_skills) - (SELECT count(*) FROM (SELECT DISTINCT * FROM job_skills)) AS BIGINT)
    AS full_row_duplicates""",
    ),
)
def full_row_duplicates(spark, d):
    return audit.full_row_dups(s.job_skills(spark, d), "job_skills")


_KEYS = {
    "postings": ["job_id"],
    "companies": ["company_id"],
    "employee_counts": ["company_id"],
    "job_skills": ["job_id", "skill_abr"],
    "job_industries": ["job_id", "industry_id"],
    "salaries": ["job_id"],
    "benefits": ["job_id", "type"],
    "industries": ["industry_id"],
    "skills": ["skill_abr"],
}
_CTE_OF = {"employee_counts": "counts", "postings": "p"}


def _key_sql() -> str:
    return " UNION ALL ".join(
        f"SELECT '{t}' AS table_name, '{', '.join(k)}' AS key_columns, CAST(sum(c) AS BIGINT) AS total_rows, "
        f"CAST(sum(c - 1) AS BIGINT) AS key_duplicates, round(sum(c - 1) / CAST(sum(c) AS DOUBLE), 4) AS duplicate_pct "
        f"FROM (SELECT count(*) AS c FROM {_CTE_OF.get(t, t)} GROUP BY {', '.join(k)})"
        for t, k in _KEYS.items()
    )


@query(
    "key_duplicates",
    "B3",
    with_(*q.TABLE_CTES, select=_key_sql()),
)
def key_duplicates(spark, d):
    return rounded(audit.key_dup_report(s.tables(spark, d), _KEYS))


_LINKS = [
    ("postings", "company_id", "companies", "company_id"),
    ("orders", "o_orderkey", "lineitem", "l_orderkey"),
    ("documents", "doc_id", "labels", "doc_id"),
    ("events", "user_id", "customer", "c_custkey"),
]


def _linked(spark, d):
    out = {n: s.raw(spark, d, n) for n in ("orders", "lineitem", "documents", "labels", "events", "customer")}
    return {**out, "postings": s.postings(spark, d), "companies": s.companies(spark, d)}


def _link_sql(null_is_invalid: bool) -> str:
    lines = []
    for c, ck, p, pk in _LINKS:
        cte = {"postings": "p"}.get(c, c)
        nulls = "" if null_is_invalid else f"{ck} IS NOT NULL AND "
        bad = f"{nulls}NOT EXISTS (SELECT 1 FROM {p} x WHERE x.{pk} = {cte}.{ck})"
        lines.append(
            f"SELECT '{c}' AS child_table, '{ck}' AS child_key, '{p}' AS parent_table, '{pk}' AS parent_key, "
            f"count(*) FILTER (WHERE {bad}) AS invalid_records_count, "
            f"round(count(*) FILTER (WHERE {bad}) / CAST(count(*) AS DOUBLE), 4) AS invalid_records_pct FROM {cte}"
        )
    return " UNION ALL ".join(lines)


@query("referential_integrity", "B4 E8", with_(q.P, q.COMPANIES, select=_link_sql(False)))
def referential_integrity(spark, d):
    return rounded(audit.integrity_report(_linked(spark, d), _LINKS))


@query("referential_integrity_with_nulls", "B4", with_(q.P, q.COMPANIES, select=_link_sql(True)))
def referential_integrity_with_nulls(spark, d):
    return rounded(audit.integrity_report(_linked(spark, d), _LINKS, null_is_invalid=True))


def _gaps_sql(table: str) -> str:
    cte = _CTE_OF.get(table, table)
    return (
        f"SELECT '{table}' AS table_name, (SELECT count(*) FROM {cte}) AS n_rows, filled "
        f"FROM (UNPIVOT (SELECT count(COLUMNS(*)) FROM {cte}) ON COLUMNS(*) INTO NAME c VALUE filled)"
    )


@query(
    "missing_by_table",
    "B5",
    with_(
        *q.TABLE_CTES,
        f"prof AS ({' UNION ALL '.join(_gaps_sql(t) for t in _KEYS)})",
        select="""SELECT table_name, max(n_rows) AS total_rows, round(avg((n_rows - filled) / CAST(n_rows AS DOUBLE)), 4)
  AS avg_missing_pct, count(*) FILTER (WHERE filled < n_rows) AS cols_with_missing FROM prof GROUP BY table_name""",
    ),
)
def missing_by_table(spark, d):
    return rounded(audit.missing_summary(audit.profile_tables(s.tables(spark, d))))


# --- filters ----------------------------------------------------------------------

_PRICED_COLS = "job_id, round(normalized_salary, 4) AS normalized_salary"


def priced(spark, d):
    from vacancia.plans.master import etl_salary

    return etl_salary(s.postings(spark, d))


@query(
    "available_columns",
    "C1",
    with_(q.P, select="SELECT job_id, views, applies FROM p"),
)
def available_columns(spark, d):
    return keys.select_available(s.postings(spark, d), ["job_id", "views", "fips", "applies"])[0]


@query(
    "complete_rows",
    "C3",
    with_(q.P, select="SELECT job_id, company_id, views FROM p WHERE company_id IS NOT NULL AND views IS NOT NULL"),
)
def complete_rows(spark, d):
    return s.postings(spark, d).select("job_id", "company_id", "views").na.drop(subset=["company_id", "views"])


@query(
    "priced_jobs",
    "C4",
    with_(q.P, q.PRICED, select=f"SELECT {_PRICED_COLS} FROM priced WHERE normalized_salary > 0"),
)
def priced_jobs(spark, d):
    return rounded(keys.valid_salary(priced(spark, d)).select("job_id", "normalized_salary"))


@query(
    "realistic_salaries",
    "C5",
    with_(q.P, q.PRICED, select=f"SELECT {_PRICED_COLS} FROM priced WHERE normalized_salary BETWEEN 20000 AND 400000"),
)
def realistic_salaries(spark, d):
    df = keys.valid_salary(priced(spark, d), low=20_000, high=400_000)
    return rounded(df.select("job_id", "normalized_salary"))


@query(
    "levels_in_set",
    "C6",
    with_(
        q.P,
        select="""SELECT formatted_experience_level, count(*) AS n FROM p
  WHERE formatted_experience_level IN ('Executive', 'Director') GROUP BY 1""",
    ),
)
def levels_in_set(spark, d):
    df = s.postings(spark, d).where(F.col("formatted_experience_level").isin("Executive", "Director"))
    return df.groupBy("formatted_experience_level").agg(F.count("*").alias("n"))


@query(
    "pattern_filter",
    "C7",
    with_(
        q.P,
        select="""SELECT job_id, formatted_experience_level, formatted_work_type FROM p
  WHERE lower(formatted_experience_level) LIKE '%senior%' AND lower(formatted_work_type) LIKE '%time%'""",
    ),
)
def pattern_filter(spark, d):
    df = s.postings(spark, d).select("job_id", "formatted_experience_level", "formatted_work_type")
    return df.where(contains_text("formatted_experience_level", "SENIOR", literal=True)).where(
        contains_text("formatted_work_type", "(full|part).TIME")
    )


# --- cleaning ---------------------------------------------------------------------


@query(
    "first_benefit_per_job",
    "D1",
    with_(
        q.BENEFITS,
        select="SELECT job_id, min(type) AS type FROM benefits GROUP BY job_id",
    ),
)
def first_benefit_per_job(spark, d):
    return keys.dedup_first(s.benefits(spark, d), ["job_id"], ["type"])


@query(
    "latest_headcount",
    "D2",
    with_(
        q.COUNTS,
        select="""SELECT company_id, employee_count, follower_count, time_recorded, snapshot_id FROM (
  SELECT *, row_number() OVER (PARTITION BY company_id ORDER BY time_recorded DESC, snapshot_id DESC) AS rn
  FROM counts WHERE company_id IS NOT NULL) WHERE rn = 1""",
    ),
)
def latest_headcount(spark, d):
    return latest_counts(s.employee_counts(spark, d))


_SAL_YEAR = """yearly AS (
  SELECT salary_id, job_id, pay_period,
    (COALESCE(min_salary, 0) + COALESCE(max_salary, 0) + COALESCE(med_salary, 0)) / nullif(
      (CASE WHEN min_salary IS NULL THEN 0 ELSE 1 END) + (CASE WHEN max_salary IS NULL THEN 0 ELSE 1 END)
      + (CASE WHEN med_salary IS NULL THEN 0 ELSE 1 END), 0)
    * CASE upper(trim(pay_period)) WHEN 'YEARLY' THEN 1 WHEN 'ANNUAL' THEN 1 WHEN 'ANNUALLY' THEN 1
        WHEN 'MONTHLY' THEN 12 WHEN 'WEEKLY' THEN 52 WHEN 'HOURLY' THEN 2080 END AS raw_salary
  FROM salaries),
ends AS (SELECT quantile_cont(raw_salary, 0.01) AS lo, quantile_cont(raw_salary, 0.99) AS hi FROM yearly),
clean_sal AS (
  SELECT salary_id, job_id, upper(trim(pay_period)) AS pay_period, normalized_salary FROM (
    SELECT *, row_number() OVER (PARTITION BY job_id ORDER BY normalized_salary DESC NULLS LAST, salary_id) AS rn
    FROM (SELECT salary_id, job_id, pay_period, CASE WHEN raw_salary IS NULL THEN NULL
            WHEN raw_salary < lo THEN lo WHEN raw_salary > hi THEN hi ELSE raw_salary END AS normalized_salary
          FROM yearly, ends)) WHERE rn = 1)"""


@query(
    "clean_salaries",
    "D3 D5 D8 D9 D11 G3",
    with_(
        q.P,
        q.SALARIES,
        _SAL_YEAR,
        select="SELECT salary_id, job_id, pay_period, round(normalized_salary, 4) AS normalized_salary FROM clean_sal",
    ),
)
def clean_salaries_report(spark, d):
    out = clean_salaries(s.salaries(spark, d))
    return rounded(out.select("salary_id", "job_id", code_clean("pay_period").alias("pay_period"), "normalized_salary"))


_TITLE = """list_aggregate(list_transform(regexp_extract_all({0}, '[A-Za-z]+|[^A-Za-z]+'),
    lambda w: upper(substr(w, 1, 1)) || lower(substr(w, 2))), 'string_agg', '')"""


@query(
    "title_cased_categories",
    "D4",
    with_(
        q.P,
        select=f"""SELECT job_id, {_TITLE.format('trim(formatted_work_type)')} AS work_type,
  {_TITLE.format('trim(formatted_experience_level)')} AS experience FROM p""",
    ),
)
def title_cased_categories(spark, d):
    return s.postings(spark, d).select(
        "job_id",
        title_clean("formatted_work_type").alias("work_type"),
        title_clean("formatted_experience_level").alias("experience"),
    )


@query(
    "part_names_titled",
    "D4",
    f"""SELECT p_partkey,
  {_TITLE.format("trim(concat(' ', upper(p_name), chr(39), 's ', lower(p_type), '-', p_brand, ' '))")} AS title
FROM part""",
)
def part_names_titled(spark, d):
    raw = F.concat(F.lit(" "), F.upper("p_name"), F.lit("'s "), F.lower("p_type"), F.lit("-"), "p_brand", F.lit(" "))
    return s.raw(spark, d, "part").select("p_partkey", title_clean(raw).alias("title"))


@query(
    "numbers_from_text",
    "D6",
    """SELECT event_id, TRY_CAST(CASE WHEN event_type = 'error' THEN 'n/a' ELSE substr(props, 7, length(props) - 7) END
  AS DOUBLE) AS k FROM events""",
)
def numbers_from_text(spark, d):
    text = F.expr("CASE WHEN event_type = 'error' THEN 'n/a' ELSE substr(props, 7, length(props) - 7) END")
    return s.raw(spark, d, "events").select("event_id", to_number(text).alias("k"))


@query(
    "epoch_dates",
    "D7",
    """SELECT event_id, CAST(ts AS DATE) AS listed_date, strftime(ts, '%Y-%m') AS listed_month,
  CAST(hour(ts) AS INTEGER) AS listed_hour FROM events""",
)
def epoch_dates(spark, d):
    ms = F.unix_millis(F.col("ts").cast("timestamp"))
    df = s.raw(spark, d, "events").select("event_id", epoch_ms(ms).alias("t"))
    return df.select(
        "event_id", listed_date("t").alias("listed_date"), listed_month("t").alias("listed_month"),
        F.hour("t").alias("listed_hour"),
    )


def _annual_sql(unknown: str) -> str:
    return f"""CASE upper(trim(pay_period)) WHEN 'YEARLY' THEN 1 WHEN 'MONTHLY' THEN 12 WHEN 'WEEKLY' THEN 52
    WHEN 'HOURLY' THEN 2080 ELSE {unknown} END"""


@query(
    "annualized_salaries",
    "D8 D9 D10",
    with_(
        q.P,
        select=f"""SELECT job_id,
  round(COALESCE(med_salary, (min_salary + max_salary) / 2) * {_annual_sql('CASE WHEN pay_period IS NOT NULL THEN 1 END')}, 4)
    AS passed_through,
  round((min_salary + max_salary + COALESCE(med_salary, 0)) / (2 + CASE WHEN med_salary IS NULL THEN 0 ELSE 1 END)
    * {_annual_sql('NULL')}, 4) AS known_only,
  round(COALESCE(med_salary, (min_salary + max_salary) / 2), 8) AS stated_or_middle FROM p""",
    ),
)
def annualized_salaries(spark, d):
    rng = ("min_salary", "max_salary", "med_salary")
    return s.postings(spark, d).select(
        "job_id",
        F.round(annualize(salary_mid(*rng, "etl"), "pay_period", "passthrough"), 4).alias("passed_through"),
        F.round(annualize(salary_mid(*rng, "clean"), "pay_period", "null"), 4).alias("known_only"),
        F.round(F.coalesce("med_salary", salary_mid(*rng, "etl")), 8).alias("stated_or_middle"),
    )


@query(
    "winsorized_prices",
    "D11",
    """SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, round(least(greatest(l_extendedprice,
  (SELECT quantile_cont(l_extendedprice, 0.01) FROM lineitem)),
  (SELECT quantile_cont(l_extendedprice, 0.99) FROM lineitem)), 4) AS price FROM lineitem""",
)
def winsorized_prices(spark, d):
    df = s.raw(spark, d, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", F.col("l_extendedprice").alias("price")
    )
    return rounded(ft.clip_quantiles(df, "price"))


@query(
    "flags_lengths_defaults",
    "D12 D13 D14 D18",
    with_(
        q.P,
        select="""SELECT job_id, COALESCE(remote_allowed, 0) AS is_remote, COALESCE(sponsored, 0) AS is_sponsored,
  length(COALESCE(description, '')) AS description_length, COALESCE(applies, 0) AS applies,
  COALESCE(formatted_experience_level, 'Unknown') AS experience FROM p""",
    ),
)
def flags_lengths_defaults(spark, d):
    return s.postings(spark, d).select(
        "job_id",
        flag("remote_allowed").alias("is_remote"),
        flag("sponsored").alias("is_sponsored"),
        text_length("description").cast("long").alias("description_length"),
        fill("applies", 0).alias("applies"),
        as_category("formatted_experience_level").alias("experience"),
    )


@query(
    "rounding_and_logs",
    "D16 D17",
    """SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, round_even(l_quantity / 2, 0) AS half_quantity,
  round(ln(1 + l_extendedprice), 6) AS log_price, round(exp(ln(1 + l_extendedprice)) - 1, 2) AS price FROM lineitem""",
)
def rounding_and_logs(spark, d):
    logged = label_to_log1p("l_extendedprice")
    return s.raw(spark, d, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
        half_even(F.col("l_quantity") / 2, 0).alias("half_quantity"),
        F.round(logged, 6).alias("log_price"),
        F.round(label_from_expm1(logged), 2).alias("price"),
    )


# --- joins ----------------------------------------------------------------------------


@query(
    "jobs_with_company",
    "E1 E2",
    with_(
        q.P,
        q.COMPANIES,
        select="""SELECT job_id, p.company_id, formatted_work_type, name, country, company_size
  FROM p LEFT JOIN companies c ON c.company_id = p.company_id""",
    ),
)
def jobs_with_company(spark, d):
    p = s.postings(spark, d).select("job_id", "company_id", "formatted_work_type")
    return keys.enrich(p, s.companies(spark, d), "company_id", ["name", "country", "company_size"], suffix="_comp")


@query(
    "jobs_with_company_salted",
    "E1 E2",
    with_(
        q.P,
        q.COMPANIES,
        select="""SELECT job_id, p.company_id, p.company_id AS name, c.name AS name_comp
  FROM p LEFT JOIN companies c ON c.company_id = p.company_id""",
    ),
)
def jobs_with_company_salted(spark, d):
    p = s.postings(spark, d).select("job_id", "company_id", F.col("company_id").alias("name"))
    return keys.enrich(p, s.companies(spark, d), "company_id", ["name"], suffix="_comp", salt=8)


@query(
    "company_name_lookup",
    "E3",
    with_(
        q.P,
        q.COMPANIES,
        select="""SELECT job_id, p.company_id, COALESCE(name, '(Unknown Company)') AS name
  FROM p LEFT JOIN companies c ON c.company_id = p.company_id""",
    ),
)
def company_name_lookup(spark, d):
    p = s.postings(spark, d).select("job_id", "company_id")
    return keys.lookup(p, "company_id", s.companies(spark, d), "name", "(Unknown Company)")


@query(
    "skill_names_per_job",
    "E4",
    """SELECT l_orderkey AS job_id, p_brand AS skill_abr, p_brand AS skill_name, count(*) AS n
  FROM lineitem JOIN part ON p_partkey = l_partkey GROUP BY 1, 2, 3""",
)
def skill_names_per_job(spark, d):
    named = s.job_skills(spark, d).join(s.skills(spark, d), "skill_abr", "left")
    return named.groupBy("job_id", "skill_abr", "skill_name").agg(F.count("*").alias("n"))


@query(
    "labels_with_documents",
    "E5",
    "SELECT doc_id, quality, lang, n_chars FROM labels JOIN documents USING (doc_id)",
)
def labels_with_documents(spark, d):
    docs = s.raw(spark, d, "documents").select("doc_id", "lang", "n_chars")
    return s.raw(spark, d, "labels").select("doc_id", "quality").join(docs, "doc_id", "inner")


@query(
    "documents_with_label",
    "E6",
    "SELECT doc_id, lang FROM documents WHERE doc_id IN (SELECT doc_id FROM labels)",
)
def documents_with_label(spark, d):
    docs = s.raw(spark, d, "documents").select("doc_id", "lang")
    return keys.keep_known(docs, s.raw(spark, d, "labels"), "doc_id")


@query(
    "orders_without_lines",
    "E7",
    "SELECT o_orderkey, o_custkey FROM orders WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem)",
)
def orders_without_lines(spark, d):
    orders = s.raw(spark, d, "orders").select("o_orderkey", "o_custkey")
    return keys.orphan_rows(orders, "o_orderkey", s.raw(spark, d, "lineitem"), "l_orderkey")


@query(
    "unlabelled_document_keys",
    "E8",
    "SELECT doc_id FROM documents EXCEPT SELECT doc_id FROM labels",
)
def unlabelled_document_keys(spark, d):
    return keys.invalid_keys(s.raw(spark, d, "documents"), "doc_id", s.raw(spark, d, "labels"))


@query(
    "company_with_unknown_member",
    "E9",
    with_(
        q.COMPANIES,
        select="""SELECT company_id, name, company_size, country, state FROM companies
  UNION ALL SELECT -1, '(Unknown Company)', 0.0, 'Unknown', NULL""",
    ),
)
def company_with_unknown_member(spark, d):
    values = {"company_id": -1, "name": "(Unknown Company)", "company_size": 0, "country": "Unknown"}
    return keys.add_unknown_member(s.companies(spark, d), values)


@query(
    "top_and_bottom_customers",
    "E10 G4",
    """SELECT * FROM (SELECT c_custkey, c_acctbal, 'top' AS side FROM customer ORDER BY c_acctbal DESC, c_custkey LIMIT 10)
UNION ALL
SELECT * FROM (SELECT c_custkey, c_acctbal, 'bottom' AS side FROM customer ORDER BY c_acctbal, c_custkey LIMIT 10)""",
)
def top_and_bottom_customers(spark, d):
    df = s.raw(spark, d, "customer").select("c_custkey", "c_acctbal")
    return keys.top_bottom(df, "c_acctbal", 10, ["c_custkey"])


# --- children ------------------------------------------------------------------------


@query(
    "skill_and_benefit_counts",
    "F1",
    with_(
        q.JOB_SKILLS,
        select="""SELECT job_id, count(skill_abr) AS skill_count, count(DISTINCT skill_abr) AS distinct_skills
  FROM job_skills GROUP BY job_id""",
    ),
)
def skill_and_benefit_counts(spark, d):
    js = s.job_skills(spark, d)
    raw = children.child_count(js, "job_id", "skill_abr", "skill_count")
    return raw.join(children.child_count(js, "job_id", "skill_abr", "distinct_skills", distinct=True), "job_id")


@query(
    "benefit_lists",
    "F2",
    with_(
        q.BENEFITS,
        select="""SELECT job_id, string_agg(type, ', ' ORDER BY type) AS benefit_types
  FROM (SELECT DISTINCT job_id, type FROM benefits) GROUP BY job_id""",
    ),
)
def benefit_lists(spark, d):
    return children.child_list(s.benefits(spark, d), "job_id", "type", "benefit_types")


@query(
    "primary_industries",
    "F3",
    with_(
        q.JOB_INDUSTRIES,
        q.INDUSTRIES,
        select="""SELECT job_id, industry_id, industry_name FROM (
  SELECT *, row_number() OVER (PARTITION BY job_id ORDER BY position, tie_1, tie_2) AS rn FROM job_industries)
  LEFT JOIN industries USING (industry_id) WHERE rn = 1""",
    ),
)
def primary_industries(spark, d):
    order = ["position", "tie_1", "tie_2"]
    ji, ind = s.job_industries(spark, d), s.industries(spark, d)
    return children.primary_child(ji, "job_id", "industry_id", order, ind, "industry_name")


@query(
    "skill_sets",
    "F4",
    with_(
        q.JOB_SKILLS,
        select="""SELECT job_id, string_agg(skill_abr, '|' ORDER BY skill_abr) AS skills, count(*) AS n
  FROM (SELECT DISTINCT job_id, skill_abr FROM job_skills) GROUP BY job_id""",
    ),
)
def skill_sets(spark, d):
    sets = children.child_set(s.job_skills(spark, d), "job_id", "skill_abr", "skills")
    return sets.select("job_id", F.array_join("skills", "|").alias("skills"), F.size("skills").cast("long").alias("n"))
