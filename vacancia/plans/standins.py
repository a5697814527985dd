"""The job tables, played by the tables at hand.

Each is a projection of whole tables; nulls and codes are value rules, applied to
every row, so that null and unknown branches have something to do. The expressions
run unchanged on any SQL engine, and the check queries use the same text.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from vacancia.operators.keys import first_per_key, latest_per_key

# (expression, column) over orders
POSTING_COLUMNS = [
    ("o_orderkey", "job_id"),
    ("CASE WHEN o_orderkey % 70 = 0 THEN NULL ELSE o_custkey END", "company_id"),
    (
        "CASE o_orderstatus WHEN 'F' THEN 'full-time' WHEN 'O' THEN 'CONTRACT' ELSE ' part-time' END",
        "formatted_work_type",
    ),
    (
        "CASE o_orderpriority WHEN '1-URGENT' THEN 'Executive' WHEN '2-HIGH' THEN 'Director' "
        "WHEN '3-MEDIUM' THEN 'Mid-Senior level' WHEN '4-NOT SPECIFIED' THEN NULL ELSE 'Entry level' END",
        "formatted_experience_level",
    ),
    (
        "CASE WHEN o_orderkey % 10 < 4 OR o_orderkey % 3 = 0 THEN NULL WHEN o_orderkey % 5 = 0 THEN o_totalprice / 2080 "
        "WHEN o_orderkey % 5 = 1 THEN o_totalprice / 12 WHEN o_orderkey % 5 = 2 THEN o_totalprice / 52 "
        "ELSE o_totalprice END",
        "med_salary",
    ),
    (
        "CASE WHEN o_orderkey % 10 < 4 THEN NULL WHEN o_orderkey % 5 = 0 THEN o_totalprice / 2080 "
        "WHEN o_orderkey % 5 = 1 THEN o_totalprice / 12 WHEN o_orderkey % 5 = 2 THEN o_totalprice / 52 "
        "ELSE o_totalprice END * 0.875",
        "min_salary",
    ),
    (
        "CASE WHEN o_orderkey % 10 < 4 THEN NULL WHEN o_orderkey % 5 = 0 THEN o_totalprice / 2080 "
        "WHEN o_orderkey % 5 = 1 THEN o_totalprice / 12 WHEN o_orderkey % 5 = 2 THEN o_totalprice / 52 "
        "ELSE o_totalprice END * 1.125",
        "max_salary",
    ),
    (
        "CASE WHEN o_orderkey % 10 < 4 THEN NULL WHEN o_orderkey % 5 = 0 THEN 'HOURLY' "
        "WHEN o_orderkey % 5 = 1 THEN 'MONTHLY' WHEN o_orderkey % 5 = 2 THEN 'WEEKLY' "
        "WHEN o_orderkey % 5 = 3 THEN 'YEARLY' ELSE 'BIWEEKLY' END",
        "pay_period",
    ),
    ("CASE WHEN o_orderkey % 73 = 0 THEN NULL ELSE o_orderkey * 7919 % 200 END", "views"),
    ("CASE WHEN o_orderkey % 5 <> 0 THEN NULL ELSE o_orderkey * 31 % 40 END", "applies"),
    ("CASE WHEN o_orderkey % 8 = 0 THEN 1 END", "remote_allowed"),
    ("CAST(o_orderkey % 2 AS INT)", "sponsored"),
    (
        "CASE WHEN o_orderkey % 71 = 0 THEN NULL ELSE concat(o_orderpriority, ' ', CAST(o_custkey AS VARCHAR(20))) END",
        "description",
    ),
    ("o_orderdate", "listed_time"),
]

# The posting's own yearly salary, for the variant that has one.
STATED_SALARY = (
    "CASE WHEN o_orderkey % 10 < 4 OR o_orderkey % 6 = 0 THEN NULL ELSE o_totalprice END",
    "normalized_salary",
)


def posting_sql(stated: bool = False) -> str:
    cols = POSTING_COLUMNS + ([STATED_SALARY] if stated else [])
    return "SELECT " + ", ".join(f"{e} AS {a}" for e, a in cols) + " FROM orders"


def raw(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def postings(spark: SparkSession, folder: str, stated: bool = False) -> DataFrame:
    cols = POSTING_COLUMNS + ([STATED_SALARY] if stated else [])
    return raw(spark, folder, "orders").selectExpr(*(f"{e} AS {a}" for e, a in cols))


def companies(spark: SparkSession, folder: str) -> DataFrame:
    nation = raw(spark, folder, "nation").selectExpr("n_nationkey AS c_nationkey", "n_name")
    return (
        raw(spark, folder, "customer")
        .join(nation, "c_nationkey")
        .selectExpr(
            "c_custkey AS company_id",
            "c_name AS name",
            "CAST(c_nationkey % 8 AS DOUBLE) AS company_size",
            "n_name AS country",
            "c_mktsegment AS state",
        )
    )


COMPANY_SQL = (
    "SELECT c_custkey AS company_id, c_name AS name, CAST(c_nationkey % 8 AS DOUBLE) AS company_size, "
    "n_name AS country, c_mktsegment AS state FROM customer JOIN nation ON n_nationkey = c_nationkey"
)


def employee_counts(spark: SparkSession, folder: str) -> DataFrame:
    return raw(spark, folder, "orders").selectExpr(
        "o_custkey AS company_id",
        "CAST(floor(o_totalprice) AS BIGINT) AS employee_count",
        "o_orderkey % 1000 AS follower_count",
        "o_orderdate AS time_recorded",
        "o_orderkey AS snapshot_id",
    )


COUNT_SQL = (
    "SELECT o_custkey AS company_id, CAST(floor(o_totalprice) AS BIGINT) AS employee_count, "
    "o_orderkey % 1000 AS follower_count, o_orderdate AS time_recorded, o_orderkey AS snapshot_id FROM orders"
)


def job_skills(spark: SparkSession, folder: str) -> DataFrame:
    part = raw(spark, folder, "part").selectExpr("p_partkey AS l_partkey", "p_brand AS skill_abr")
    lines = raw(spark, folder, "lineitem").select("l_orderkey", "l_partkey")
    return lines.join(part, "l_partkey").selectExpr("l_orderkey AS job_id", "skill_abr")


SKILL_SQL = "SELECT l_orderkey AS job_id, p_brand AS skill_abr FROM lineitem JOIN part ON p_partkey = l_partkey"


def titles(spark: SparkSession, folder: str) -> DataFrame:
    """A title per job: the name of the part on its first line."""
    part = raw(spark, folder, "part").selectExpr("p_partkey AS l_partkey", "p_name AS title")
    lines = raw(spark, folder, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
    first = first_per_key(lines, ["l_orderkey"], ["l_linenumber", "l_partkey", "l_suppkey"])
    return first.join(part, "l_partkey").selectExpr("l_orderkey AS job_id", "title")


def profile_words(spark: SparkSession, folder: str) -> DataFrame:
    """A profile per customer: the brands of the newest order, in the customer's spelling, and the segment."""
    orders = raw(spark, folder, "orders").select("o_custkey", "o_orderkey", "o_orderdate")
    newest = latest_per_key(orders, ["o_custkey"], "o_orderdate", ["o_orderkey"])
    brands = newest.join(job_skills(spark, folder).withColumnRenamed("job_id", "o_orderkey"), "o_orderkey")
    words = brands.selectExpr("o_custkey AS profile_id", "upper(skill_abr) AS skill")
    segments = raw(spark, folder, "customer").selectExpr("c_custkey AS profile_id", "c_mktsegment AS skill")
    return words.unionByName(segments)


PROFILE_SQL = """words AS (
  SELECT o_custkey AS profile_id, upper(p_brand) AS skill FROM (
    SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey) AS rn FROM orders)
  JOIN lineitem ON l_orderkey = o_orderkey JOIN part ON p_partkey = l_partkey WHERE rn = 1
  UNION ALL SELECT c_custkey, c_mktsegment FROM customer),
mapped AS (
  SELECT profile_id, p_brand AS skill_name FROM words JOIN part ON upper(p_brand) = upper(skill)
  UNION SELECT profile_id, 'Brand#7' FROM words WHERE lower(skill) LIKE '%build%' OR lower(skill) LIKE '%house%')"""

# What the customers' segment words stand for.
PROFILE_ALIASES = {"Brand#7": ["build", "house"]}


def skills(spark: SparkSession, folder: str) -> DataFrame:
    return raw(spark, folder, "part").selectExpr("p_brand AS skill_abr", "p_brand AS skill_name").distinct()


def benefits(spark: SparkSession, folder: str) -> DataFrame:
    return raw(spark, folder, "lineitem").selectExpr(
        "l_orderkey AS job_id", "concat(l_returnflag, l_linestatus) AS type"
    )


BENEFIT_SQL = "SELECT l_orderkey AS job_id, concat(l_returnflag, l_linestatus) AS type FROM lineitem"


def job_industries(spark: SparkSession, folder: str) -> DataFrame:
    sup = raw(spark, folder, "supplier").selectExpr("s_suppkey AS l_suppkey", "CAST(s_nationkey AS BIGINT) AS industry_id")
    lines = raw(spark, folder, "lineitem").select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber")
    return lines.join(sup, "l_suppkey").selectExpr(
        "l_orderkey AS job_id", "industry_id", "l_linenumber AS position", "l_partkey AS tie_1", "l_suppkey AS tie_2"
    )


INDUSTRY_SQL = (
    "SELECT l_orderkey AS job_id, CAST(s_nationkey AS BIGINT) AS industry_id, l_linenumber AS position, "
    "l_partkey AS tie_1, l_suppkey AS tie_2 FROM lineitem JOIN supplier ON s_suppkey = l_suppkey"
)


def industries(spark: SparkSession, folder: str) -> DataFrame:
    return raw(spark, folder, "nation").selectExpr("CAST(n_nationkey AS BIGINT) AS industry_id", "n_name AS industry_name")


def salaries(spark: SparkSession, folder: str) -> DataFrame:
    """Two rows per job with a salary: as stated, and the middle once more per year."""
    p = postings(spark, folder).where("pay_period IS NOT NULL")
    stated = p.selectExpr("job_id * 2 AS salary_id", "job_id", "max_salary", "med_salary", "min_salary", "pay_period")
    yearly = p.selectExpr(
        "job_id * 2 + 1 AS salary_id",
        "job_id",
        "CAST(NULL AS DOUBLE) AS max_salary",
        "med_salary",
        "CAST(NULL AS DOUBLE) AS min_salary",
        "'Yearly ' AS pay_period",
    )
    return stated.unionByName(yearly)


SALARY_SQL = (
    "SELECT job_id * 2 AS salary_id, job_id, max_salary, med_salary, min_salary, pay_period FROM p "
    "WHERE pay_period IS NOT NULL UNION ALL "
    "SELECT job_id * 2 + 1, job_id, NULL, med_salary, NULL, 'Yearly ' FROM p WHERE pay_period IS NOT NULL"
)

BUILDERS: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "postings": postings,
    "companies": companies,
    "employee_counts": employee_counts,
    "job_skills": job_skills,
    "job_industries": job_industries,
    "salaries": salaries,
    "industries": industries,
    "skills": skills,
    "benefits": benefits,
}


def tables(spark: SparkSession, folder: str, stated: bool = False) -> dict[str, DataFrame]:
    out = {name: build(spark, folder) for name, build in BUILDERS.items()}
    out["postings"] = postings(spark, folder, stated)
    return out
