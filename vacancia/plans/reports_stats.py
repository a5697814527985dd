"""Registered queries: statistics, feature columns, the masters, the star schema."""

from __future__ import annotations

from pyspark.sql import functions as F

from vacancia.operators import audit, keys, star, stats
from vacancia.operators import features as ft
from vacancia.plans import shared as q
from vacancia.plans import standins as s
from vacancia.plans.master import build_master, build_report, child_summaries, etl_salary, posting_features
from vacancia.plans.registry import query, rounded, with_

MASTER = q.MASTER_CTES


def jobs(spark, d):
    """Postings with every column a posting yields by itself; no join."""
    from vacancia.plans.master import clean_postings

    return posting_features(etl_salary(clean_postings(s.postings(spark, d), "etl")))


def master(spark, d):
    return build_master(s.tables(spark, d), "etl")


_PAID = "master WHERE has_salary = 1"

# --- the flagship ---------------------------------------------------------------------

_LEVELS = ["Executive", "Director", "Mid-Senior level", "Associate", "Entry level"]
_LEVEL_ROWS = ", ".join(f"({i}, '{v}')" for i, v in enumerate(_LEVELS))


@query(
    "salary_by_experience",
    "C4 D8 F7 F12 H6",
    with_(
        q.P,
        q.PRICED,
        f"lv(position, formatted_experience_level) AS (VALUES {_LEVEL_ROWS})",
        select="""SELECT lv.position, formatted_experience_level, job_count, mean, median, p25, p75,
    CASE WHEN median IS NULL OR median <= 0 THEN 'Unknown' WHEN median < 40000 THEN 'Low (<40k)'
      WHEN median < 80000 THEN 'Mid (40-80k)' WHEN median < 150000 THEN 'High (80-150k)' ELSE 'Very High (>150k)' END
      AS median_band
  FROM lv LEFT JOIN (
    SELECT formatted_experience_level, count(*) AS job_count, round(avg(normalized_salary), 4) AS mean,
      round(quantile_cont(normalized_salary, 0.5), 4) AS median,
      round(quantile_cont(normalized_salary, 0.25), 4) AS p25, round(quantile_cont(normalized_salary, 0.75), 4) AS p75
    FROM priced WHERE normalized_salary > 0 GROUP BY 1) USING (formatted_experience_level)""",
    ),
)
def salary_by_experience(spark, d):
    """Yearly salary statistics per experience level, levels in their fixed order."""
    paid = keys.valid_salary(etl_salary(s.postings(spark, d)))
    by_level = stats.group_stats(paid, ["formatted_experience_level"], "normalized_salary")
    out = stats.reorder(by_level, "formatted_experience_level", _LEVELS)
    return rounded(ft.salary_bands(out, "median_band", salary="median"))


# --- masters -----------------------------------------------------------------------------

_MASTER_COLS = """job_id, company_id, listed_date, listed_month, has_salary, salary_disclosure_status, views, applies,
  work_type_clean, experience_group_clean, salary_band_clean, is_hot_job, is_remote, is_sponsored, benefit_count,
  skill_count, primary_industry_id, primary_industry_name, employee_count, company_known_flag, industry_known_flag,
  engagement_score""".replace("\n", "")


@query(
    "jobs_master",
    "E1 F1 F3 H1 H2 H3 H4 H5 H6 H7 H8",
    with_(
        *MASTER,
        select=f"""SELECT {_MASTER_COLS}, CAST(description_length AS BIGINT) AS description_length,
  round(normalized_salary, 4) AS normalized_salary, round(applies_per_view, 4) AS applies_per_view FROM master""",
    ),
)
def jobs_master(spark, d):
    cols = [c.strip() for c in _MASTER_COLS.split(",")]
    df = master(spark, d).withColumn("description_length", F.col("description_length").cast("long"))
    return rounded(df.select(*cols, "description_length", "normalized_salary", "applies_per_view"))


_SAL = """yearly AS (
  SELECT salary_id, job_id,
    (COALESCE(min_salary, 0) + COALESCE(max_salary, 0) + COALESCE(med_salary, 0)) / nullif(
      (CASE WHEN min_salary IS NULL THEN 0 ELSE 1 END) + (CASE WHEN max_salary IS NULL THEN 0 ELSE 1 END)
      + (CASE WHEN med_salary IS NULL THEN 0 ELSE 1 END), 0)
    * CASE upper(trim(pay_period)) WHEN 'YEARLY' THEN 1 WHEN 'MONTHLY' THEN 12 WHEN 'WEEKLY' THEN 52
        WHEN 'HOURLY' THEN 2080 END AS raw_salary FROM salaries),
sal AS (
  SELECT job_id, max(CASE WHEN raw_salary IS NULL THEN NULL ELSE least(greatest(raw_salary,
    (SELECT quantile_cont(raw_salary, 0.01) FROM yearly)), (SELECT quantile_cont(raw_salary, 0.99) FROM yearly)) END)
    AS clean_salary FROM yearly GROUP BY job_id)"""


@query(
    "jobs_master_clean",
    "E1 E2 D4 D6 H6 H7 H8",
    with_(
        q.P_STATED, q.SALARIES, _SAL, q.COMPANIES, q.COUNTS, q.JOB_SKILLS, q.BENEFITS,
        """newest AS (SELECT company_id, employee_count FROM (
    SELECT *, row_number() OVER (PARTITION BY company_id ORDER BY time_recorded DESC, snapshot_id DESC) AS rn
    FROM counts) WHERE rn = 1)""",
        select="""SELECT p.job_id, CASE o WHEN 'f' THEN 'Full-Time' WHEN 'C' THEN 'Contract' ELSE 'Part-Time' END AS formatted_work_type,
  round(COALESCE(normalized_salary, clean_salary), 4) AS normalized_salary,
  CASE WHEN COALESCE(normalized_salary, clean_salary) IS NULL THEN 'Unknown'
    WHEN COALESCE(normalized_salary, clean_salary) < 40000 THEN 'Low (<40k)'
    WHEN COALESCE(normalized_salary, clean_salary) < 80000 THEN 'Mid (40-80k)'
    WHEN COALESCE(normalized_salary, clean_salary) < 150000 THEN 'High (80-150k)' ELSE 'Very High (>150k)' END AS salary_band,
  CASE WHEN views > (SELECT quantile_cont(views, 0.75) FROM p) THEN 1 ELSE 0 END AS is_high_views,
  CASE WHEN applies > (SELECT quantile_cont(applies, 0.75) FROM p) THEN 1 ELSE 0 END AS is_high_applies,
  COALESCE(b.n, 0) AS benefit_count, COALESCE(k.n, 0) AS skill_count, name, company_size, employee_count
FROM (SELECT *, substr(trim(formatted_work_type), 1, 1) AS o FROM p) p LEFT JOIN sal USING (job_id)
  LEFT JOIN (SELECT job_id, count(DISTINCT type) AS n FROM benefits GROUP BY 1) b USING (job_id)
  LEFT JOIN (SELECT job_id, count(DISTINCT skill_abr) AS n FROM job_skills GROUP BY 1) k USING (job_id)
  LEFT JOIN companies c ON c.company_id = p.company_id LEFT JOIN newest n ON n.company_id = p.company_id""",
    ),
)
def jobs_master_clean(spark, d):
    df = build_master(s.tables(spark, d, stated=True), "clean", salary_source="coalesce")
    return rounded(
        df.select(
            "job_id", "formatted_work_type", "normalized_salary", "salary_band", "is_high_views", "is_high_applies",
            "benefit_count", "skill_count", "name", "company_size", "employee_count",
        )
    )


@query(
    "master_build_report",
    "B7 D1",
    with_(
        q.P, q.SALARIES, q.BENEFITS, q.JOB_SKILLS, q.JOB_INDUSTRIES, q.COMPANIES, q.COUNTS,
        "j AS (SELECT job_id, min(company_id) AS company_id FROM p GROUP BY job_id)",
        select="""SELECT 'drop_dup_job_id' AS step, count(*) AS rows_in, count(DISTINCT job_id) AS rows_out FROM p
  UNION ALL SELECT 'salaries_final', count(*), count(DISTINCT job_id) FROM salaries
  UNION ALL SELECT 'benefits_agg', count(*), count(DISTINCT job_id) FROM benefits
  UNION ALL SELECT 'job_skills_agg', count(*), count(DISTINCT job_id) FROM job_skills
  UNION ALL SELECT 'job_industries_primary', count(*), count(DISTINCT job_id) FROM job_industries
  UNION ALL SELECT 'companies_final', count(*), count(DISTINCT company_id) FROM companies
  UNION ALL SELECT 'employee_counts_latest', count(*), count(DISTINCT company_id) FROM counts
  UNION ALL SELECT 'postings_final', count(DISTINCT job_id), count(DISTINCT job_id) FROM p
  UNION ALL SELECT 'join_salary', (SELECT count(*) FROM j), count(*) FROM j LEFT JOIN (SELECT DISTINCT job_id FROM salaries) USING (job_id)
  UNION ALL SELECT 'join_benefits', (SELECT count(*) FROM j), count(*) FROM j LEFT JOIN (SELECT DISTINCT job_id FROM benefits) USING (job_id)
  UNION ALL SELECT 'join_skills', (SELECT count(*) FROM j), count(*) FROM j LEFT JOIN (SELECT DISTINCT job_id FROM job_skills) USING (job_id)
  UNION ALL SELECT 'join_industry', (SELECT count(*) FROM j), count(*) FROM j
    LEFT JOIN (SELECT DISTINCT job_id FROM job_industries) USING (job_id)
  UNION ALL SELECT 'join_company', (SELECT count(*) FROM j), count(*) FROM j
    LEFT JOIN (SELECT DISTINCT company_id FROM companies) USING (company_id)
  UNION ALL SELECT 'join_employee_counts', (SELECT count(*) FROM j), count(*) FROM j
    LEFT JOIN (SELECT DISTINCT company_id FROM counts) USING (company_id)
  UNION ALL SELECT 'dedup_final', (SELECT count(*) FROM j), count(DISTINCT job_id) FROM j""",
    ),
)
def master_build_report(spark, d):
    return build_report(s.tables(spark, d)).select("step", "rows_in", "rows_out")


@query(
    "child_summaries",
    "F1 F2",
    with_(
        q.BENEFITS, q.JOB_SKILLS,
        select="""SELECT job_id, benefit_count, benefit_types, skill_count, skill_list FROM
  (SELECT job_id, count(type) AS benefit_count, string_agg(DISTINCT type, ', ' ORDER BY type) AS benefit_types
   FROM benefits GROUP BY job_id)
  JOIN (SELECT job_id, count(skill_abr) AS skill_count, string_agg(DISTINCT skill_abr, ', ' ORDER BY skill_abr)
    AS skill_list FROM job_skills GROUP BY job_id) USING (job_id)""",
    ),
)
def child_summaries_report(spark, d):
    parts = child_summaries(s.tables(spark, d))
    return parts["benefits_agg"].join(parts["skills_agg"], "job_id")


# --- statistics ----------------------------------------------------------------------------


@query(
    "market_overview",
    "F5",
    with_(
        *MASTER,
        select="""SELECT count(*) AS total_jobs, count(DISTINCT company_id) AS unique_companies,
  count(DISTINCT primary_industry_id) AS unique_industries, round(avg(skill_count), 4) AS avg_skills,
  round(avg(has_salary) * 100, 4) AS disclosed_pct, round(avg(1 - has_salary) * 100, 4) AS hidden_pct,
  round(avg(is_remote) * 100, 4) AS remote_pct, round(avg(is_sponsored) * 100, 4) AS sponsored_pct,
  min(listed_date) AS date_min, max(listed_date) AS date_max FROM master""",
    ),
)
def market_overview(spark, d):
    return rounded(stats.overview(master(spark, d)))


@query(
    "build_summary",
    "F5",
    with_(
        *MASTER,
        select="""SELECT count(*) AS total_rows, CAST(sum(has_salary) AS BIGINT) AS salary_disclosed,
  CAST(sum(1 - has_salary) AS BIGINT) AS salary_hidden, CAST(sum(is_remote) AS BIGINT) AS remote_jobs,
  CAST(sum(is_hot_job) AS BIGINT) AS hot_jobs, CAST(sum(company_known_flag) AS BIGINT) AS companies_known,
  CAST(sum(industry_known_flag) AS BIGINT) AS industries_known, min(listed_date) AS date_min,
  max(listed_date) AS date_max FROM master""",
    ),
)
def build_summary(spark, d):
    return stats.build_summary(master(spark, d)).drop("total_columns")


@query(
    "salary_description",
    "F6",
    with_(
        q.P, q.PRICED,
        select="""SELECT count(normalized_salary) AS n, round(avg(normalized_salary), 4) AS mean,
  round(median(normalized_salary), 4) AS median, round(stddev_samp(normalized_salary), 4) AS std,
  round(max(normalized_salary), 4) AS max FROM priced""",
    ),
)
def salary_description(spark, d):
    return rounded(stats.describe_num(etl_salary(s.postings(spark, d)), "normalized_salary"))


@query(
    "salary_by_work_type",
    "F7",
    with_(
        q.P, q.PRICED,
        select="""SELECT formatted_work_type, count(*) AS job_count, round(avg(normalized_salary), 4) AS mean,
  round(quantile_cont(normalized_salary, 0.5), 4) AS median, round(quantile_cont(normalized_salary, 0.25), 4) AS p25,
  round(quantile_cont(normalized_salary, 0.75), 4) AS p75 FROM priced WHERE normalized_salary > 0 GROUP BY 1""",
    ),
)
def salary_by_work_type(spark, d):
    paid = keys.valid_salary(etl_salary(s.postings(spark, d)))
    return rounded(stats.group_stats(paid, ["formatted_work_type"], "normalized_salary"))


@query(
    "price_quantiles_by_supplier",
    "F7 F9",
    """SELECT l_suppkey, count(*) AS job_count, round(avg(l_extendedprice), 4) AS mean,
  round(quantile_cont(l_extendedprice, 0.5), 4) AS median, round(quantile_cont(l_extendedprice, 0.25), 4) AS p25,
  round(quantile_cont(l_extendedprice, 0.75), 4) AS p75 FROM lineitem GROUP BY 1""",
)
def price_quantiles_by_supplier(spark, d):
    return rounded(stats.group_stats(s.raw(spark, d, "lineitem"), ["l_suppkey"], "l_extendedprice"))


@query(
    "top_companies",
    "F8 G4",
    with_(
        q.P, q.PRICED, q.COMPANIES,
        select="""SELECT name, count(job_id) AS job_count, round(avg(normalized_salary), 4) AS avg_salary,
  round(median(normalized_salary), 4) AS median_salary FROM priced JOIN companies USING (company_id)
  GROUP BY name ORDER BY job_count DESC, name LIMIT 20""",
    ),
)
def top_companies(spark, d):
    p = etl_salary(s.postings(spark, d)).select("job_id", "company_id", "normalized_salary")
    named = keys.enrich(p, s.companies(spark, d), "company_id", ["name"])
    return rounded(stats.top_groups(named, "name", "normalized_salary", 20, "job_id"))


@query(
    "top_industries",
    "F8",
    with_(
        *MASTER,
        select="""SELECT primary_industry_name, count(job_id) AS job_count, round(avg(normalized_salary), 4) AS avg_salary,
  round(median(normalized_salary), 4) AS median_salary FROM master WHERE primary_industry_name IS NOT NULL
  GROUP BY 1 ORDER BY job_count DESC, 1 LIMIT 15""",
    ),
)
def top_industries(spark, d):
    return rounded(stats.top_groups(master(spark, d), "primary_industry_name", "normalized_salary", 15, "job_id"))


@query(
    "median_salary_by_group",
    "F9",
    with_(
        q.P, q.PRICED,
        select=f"""SELECT {q.EXP_GROUP} AS experience_group_clean, round(median(normalized_salary), 4) AS median
  FROM priced WHERE normalized_salary > 0 GROUP BY 1""",
    ),
)
def median_salary_by_group(spark, d):
    paid = jobs(spark, d).where("has_salary = 1")
    return rounded(stats.group_median(paid, "experience_group_clean", "normalized_salary"))


@query(
    "skills_by_disclosure",
    "F9",
    with_(*MASTER, select="SELECT salary_disclosure_status, round(avg(skill_count), 4) AS mean FROM master GROUP BY 1"),
)
def skills_by_disclosure(spark, d):
    return rounded(stats.group_mean(master(spark, d), "salary_disclosure_status", "skill_count"))


@query(
    "disclosure_rate_by_remote",
    "F10",
    with_(
        q.P, q.PRICED,
        select="""SELECT COALESCE(remote_allowed, 0) AS is_remote,
  round(avg(CASE WHEN normalized_salary > 0 THEN 1 ELSE 0 END) * 100, 4) AS rate_pct FROM priced GROUP BY 1""",
    ),
)
def disclosure_rate_by_remote(spark, d):
    return rounded(stats.group_rate(jobs(spark, d), "is_remote", "has_salary"))


@query(
    "salary_band_counts",
    "F11",
    with_(
        q.P, q.PRICED,
        select=f"""SELECT salary_band_clean, count(*) AS n, round(count(*) / (SELECT count(*) FROM priced), 4) AS share
  FROM (SELECT {q.BAND_40} AS salary_band_clean FROM priced) GROUP BY 1""",
    ),
)
def salary_band_counts(spark, d):
    return rounded(stats.value_counts(jobs(spark, d), "salary_band_clean", normalize=True))


_BANDS = ["Low (<40k)", "Mid (40-80k)", "High (80-150k)", "Very High (>150k)", "Executive pay", "Unknown"]


@query(
    "engagement_by_band",
    "F9 F12 H3",
    with_(
        q.P, q.PRICED,
        "b(position, salary_band_clean) AS (VALUES " + ", ".join(f"({i}, '{v}')" for i, v in enumerate(_BANDS)) + ")",
        select=f"""SELECT b.position, salary_band_clean, mean FROM b LEFT JOIN (
    SELECT salary_band_clean, round(avg(e), 4) AS mean FROM (
      SELECT {q.BAND_40} AS salary_band_clean, COALESCE(views, 0) + COALESCE(applies, 0) * 10 AS e FROM priced)
    GROUP BY 1) USING (salary_band_clean)""",
    ),
)
def engagement_by_band(spark, d):
    means = stats.group_mean(jobs(spark, d), "salary_band_clean", "engagement_score")
    return rounded(stats.reorder(means, "salary_band_clean", _BANDS))


@query(
    "jobs_by_month",
    "F13",
    """SELECT listed_month, n AS job_count, CASE WHEN row_number() OVER (ORDER BY n DESC, listed_month) = 1 THEN 1 ELSE 0 END
  AS is_peak FROM (SELECT strftime(o_orderdate, '%Y-%m') AS listed_month, count(*) AS n FROM orders GROUP BY 1
  ORDER BY 1 DESC LIMIT 18)""",
)
def jobs_by_month(spark, d):
    df = s.postings(spark, d).select(F.date_format("listed_time", "yyyy-MM").alias("listed_month"))
    return stats.monthly_trend(df)


@query(
    "salary_skill_correlation",
    "F14",
    with_(*MASTER, select=f"SELECT round(corr(normalized_salary, skill_count), 6) AS r FROM {_PAID}"),
)
def salary_skill_correlation(spark, d):
    paid = master(spark, d).where("has_salary = 1")
    return rounded(stats.correlation(paid, "normalized_salary", "skill_count"), 6)


_VARS = ["normalized_salary", "views", "applies", "benefit_count", "skill_count", "description_length", "employee_count"]


@query(
    "correlation_matrix",
    "F15",
    with_(
        *MASTER,
        select=" UNION ALL ".join(
            f"SELECT '{a}' AS variable, "
            + ", ".join(f"round(corr(CAST({a} AS DOUBLE), CAST({b} AS DOUBLE)), 3) + 0.0 AS {b}" for b in _VARS)
            + " FROM master"
            for a in _VARS
        ),
    ),
)
def correlation_matrix(spark, d):
    return stats.corr_matrix(master(spark, d), _VARS)


def _hist_sql(table: str, col: str, bins: int, lo: str, hi: str) -> str:
    return f"""b AS (SELECT CAST({lo} AS DOUBLE) AS lo, CAST({hi} AS DOUBLE) AS hi FROM {table}),
c AS (SELECT least(CAST(floor(({col} - lo) / (hi - lo) * {bins}) AS INTEGER), {bins - 1}) AS bin, count(*) AS n
  FROM {table}, b WHERE {col} BETWEEN lo AND hi GROUP BY 1)
SELECT CAST(i AS INTEGER) AS bin, round(lo + i * ((hi - lo) / {bins}), 4) AS left_edge,
  round(lo + (i + 1) * ((hi - lo) / {bins}), 4) AS right_edge, COALESCE(n, 0) AS n
FROM b, range({bins}) r(i) LEFT JOIN c ON c.bin = i"""


@query(
    "salary_histogram",
    "F16",
    with_(q.P, q.PRICED, select="")
    + ", "
    + _hist_sql("priced", "normalized_salary", 50, "min(normalized_salary)", "max(normalized_salary)"),
)
def salary_histogram(spark, d):
    return rounded(stats.histogram(etl_salary(s.postings(spark, d)), "normalized_salary", 50))


@query(
    "salary_histogram_trimmed",
    "F17",
    with_(q.P, q.PRICED, select="")
    + ", "
    + _hist_sql(
        "priced", "normalized_salary", 49, "quantile_cont(normalized_salary, 0.01)",
        "quantile_cont(normalized_salary, 0.99)",
    ),
)
def salary_histogram_trimmed(spark, d):
    df = etl_salary(s.postings(spark, d))
    return rounded(stats.histogram(df, "normalized_salary", 49, 0.01, 0.99))


@query(
    "salary_boxes",
    "F18",
    with_(
        q.P, q.PRICED,
        """w AS (SELECT formatted_work_type AS g, normalized_salary AS v FROM priced WHERE normalized_salary > 0),
f AS (SELECT g, quantile_cont(v, 0.25) AS q1, quantile_cont(v, 0.5) AS median, quantile_cont(v, 0.75) AS q3 FROM w GROUP BY g)""",
        select="""SELECT g AS formatted_work_type, count(*) AS n, round(q1, 4) AS q1, round(median, 4) AS median,
  round(q3, 4) AS q3,
  round(min(v) FILTER (WHERE v BETWEEN q1 - (q3 - q1) * 1.5 AND q3 + (q3 - q1) * 1.5), 4) AS whisker_low,
  round(max(v) FILTER (WHERE v BETWEEN q1 - (q3 - q1) * 1.5 AND q3 + (q3 - q1) * 1.5), 4) AS whisker_high,
  count(*) FILTER (WHERE NOT (v BETWEEN q1 - (q3 - q1) * 1.5 AND q3 + (q3 - q1) * 1.5)) AS outliers
  FROM w JOIN f USING (g) GROUP BY g, q1, median, q3""",
    ),
)
def salary_boxes(spark, d):
    paid = keys.valid_salary(etl_salary(s.postings(spark, d)))
    return rounded(stats.box_stats(paid, "formatted_work_type", "normalized_salary"))


@query(
    "discount_price_boxes",
    "F18",
    """SELECT l_discount, count(*) AS n, round(q1, 4) AS q1, round(median, 4) AS median, round(q3, 4) AS q3,
  round(min(v) FILTER (WHERE v BETWEEN q1 - (q3 - q1) * 1.5 AND q3 + (q3 - q1) * 1.5), 4) AS whisker_low,
  round(max(v) FILTER (WHERE v BETWEEN q1 - (q3 - q1) * 1.5 AND q3 + (q3 - q1) * 1.5), 4) AS whisker_high,
  count(*) FILTER (WHERE NOT (v BETWEEN q1 - (q3 - q1) * 1.5 AND q3 + (q3 - q1) * 1.5)) AS outliers
FROM (SELECT l_discount, l_extendedprice AS v FROM lineitem) JOIN (
  SELECT l_discount, quantile_cont(v, 0.25) AS q1, quantile_cont(v, 0.5) AS median, quantile_cont(v, 0.75) AS q3
  FROM (SELECT l_discount, l_extendedprice AS v FROM lineitem) GROUP BY 1) USING (l_discount)
GROUP BY l_discount, q1, median, q3""",
)
def discount_price_boxes(spark, d):
    df = s.raw(spark, d, "lineitem").select("l_discount", F.col("l_extendedprice").alias("v"))
    return rounded(stats.box_stats(df, "l_discount", "v"))


@query(
    "price_quantity_line",
    "F19",
    """SELECT round(regr_slope(l_extendedprice, l_quantity), 4) AS slope,
  round(regr_intercept(l_extendedprice, l_quantity), 4) AS intercept,
  CAST(regr_count(l_extendedprice, l_quantity) AS BIGINT) AS n FROM lineitem""",
)
def price_quantity_line(spark, d):
    return rounded(stats.fit_line(s.raw(spark, d, "lineitem"), "l_quantity", "l_extendedprice"))


@query(
    "dashboard_measures",
    "F20 I7",
    with_(
        q.P, q.PRICED,
        select="""SELECT count(DISTINCT job_id) AS jobs, round(sum(applies) / sum(views), 6) AS conversion_rate,
  round(avg(normalized_salary) - avg(pred_salary), 4) AS salary_gap,
  CAST(sum(COALESCE(views, 0) + COALESCE(applies, 0) * 10) AS BIGINT) AS total_engagement,
  round(avg(CASE WHEN views = 0 OR views IS NULL OR applies IS NULL THEN 0.0 ELSE applies / views END), 6)
    AS avg_applies_per_view
FROM priced LEFT JOIN (SELECT job_id, med_salary * 12 AS pred_salary FROM p) USING (job_id)""",
    ),
)
def dashboard_measures(spark, d):
    stored = s.postings(spark, d).select("job_id", (F.col("med_salary") * 12).alias("salary_pred"))
    fact = star.attach_scores(jobs(spark, d), {"pred_salary": (stored, "salary_pred")})
    out = stats.measures(fact.withColumn("skill_count", F.lit(0)))
    return rounded(out.drop("skills_intensity"), 6).withColumn("salary_gap", F.round("salary_gap", 4))


@query(
    "top_skills",
    "F20 F11 G4",
    with_(
        q.JOB_SKILLS,
        select="SELECT skill_abr, count(*) AS n FROM job_skills GROUP BY 1 ORDER BY n DESC, skill_abr LIMIT 10",
    ),
)
def top_skills(spark, d):
    return keys.top_k(stats.value_counts(s.job_skills(spark, d), "skill_abr"), [F.desc("n"), "skill_abr"], 10)


# --- windows, limits, samples --------------------------------------------------------------


@query(
    "hot_flags",
    "G1 G2 H7",
    with_(
        q.P,
        select="""SELECT job_id, views,
  CASE WHEN views >= (SELECT quantile_cont(views, 0.75) FROM p) THEN 1 ELSE 0 END AS at_or_above_p75,
  CASE WHEN views > (SELECT quantile_cont(views, 0.75) FROM p) THEN 1 ELSE 0 END AS above_p75,
  CASE WHEN views >= 8 THEN 1 ELSE 0 END AS at_least_8 FROM p""",
    ),
)
def hot_flags(spark, d):
    df = s.postings(spark, d).select("job_id", "views")
    df = ft.quantile_flags(df, {"at_or_above_p75": ("views", 0.75, ">="), "above_p75": ("views", 0.75, ">")})
    return ft.threshold_flag(df, "views", 8, "at_least_8")


@query(
    "best_salaries_first",
    "G3 G4",
    with_(
        q.P, q.PRICED,
        select="""SELECT job_id, round(normalized_salary, 4) AS normalized_salary FROM priced
  ORDER BY normalized_salary DESC NULLS LAST, job_id LIMIT 25""",
    ),
)
def best_salaries_first(spark, d):
    df = etl_salary(s.postings(spark, d)).select("job_id", "normalized_salary")
    return rounded(keys.top_k(df, [F.desc_nulls_last("normalized_salary"), "job_id"], 25))


@query(
    "busiest_day",
    "G4",
    """SELECT CAST(o_orderdate AS DATE) AS listed_date, count(*) AS n FROM orders GROUP BY 1
ORDER BY n DESC, listed_date LIMIT 1""",
)
def busiest_day(spark, d):
    days = s.raw(spark, d, "orders").groupBy(F.to_date("o_orderdate").alias("listed_date")).agg(F.count("*").alias("n"))
    return keys.argmax(days, "listed_date", "n")


@query("seeded_sample", "G5", with_(q.P, select=f"SELECT job_id, views FROM p ORDER BY {q.key_hash('job_id', 42)} LIMIT 5000"))
def seeded_sample(spark, d):
    return stats.sample_n(s.postings(spark, d).select("job_id", "views"), 5_000, 42, ["job_id"])


@query(
    "work_type_shares",
    "G6",
    with_(
        q.P,
        select="""SELECT formatted_work_type, count(*) AS n, round(count(*) * 100.0 / (SELECT count(*) FROM p), 4) AS pct
  FROM p GROUP BY 1""",
    ),
)
def work_type_shares(spark, d):
    return rounded(stats.share(s.postings(spark, d), "formatted_work_type"))


# --- feature columns -----------------------------------------------------------------------


@query(
    "posting_features",
    "H1 H2 H3 H5 H6 H7 D15",
    with_(
        q.P, q.PRICED,
        select=f"""SELECT job_id, CASE WHEN normalized_salary > 0 THEN 1 ELSE 0 END AS has_salary,
  CASE WHEN normalized_salary > 0 THEN 'Disclosed' ELSE 'Hidden' END AS salary_disclosure_status,
  round(CASE WHEN views IS NULL OR views = 0 OR applies IS NULL THEN 0.0 ELSE CAST(applies AS DOUBLE) / views END, 4)
    AS applies_per_view,
  COALESCE(views, 0) + COALESCE(applies, 0) * 10 AS engagement_score, {q.EXP_GROUP} AS experience_group_clean,
  {q.BAND_40} AS salary_band_clean,
  CASE WHEN normalized_salary IS NULL OR normalized_salary <= 0 THEN 'Unknown' WHEN normalized_salary < 50000 THEN '<50k'
    WHEN normalized_salary < 100000 THEN '50k-100k' WHEN normalized_salary < 150000 THEN '100k-150k' ELSE '150k+' END
    AS export_band,
  CASE WHEN views >= (SELECT quantile_cont(views, 0.75) FROM p) THEN 1 ELSE 0 END AS is_hot_job FROM priced""",
    ),
)
def posting_features_report(spark, d):
    from vacancia.functions.measures import BANDS_50_100_150

    df = ft.salary_bands(jobs(spark, d), "export_band", *BANDS_50_100_150)
    return rounded(
        df.select(
            "job_id", "has_salary", "salary_disclosure_status", "applies_per_view", "engagement_score",
            "experience_group_clean", "salary_band_clean", "export_band", "is_hot_job",
        )
    )


@query(
    "sentinel_keys",
    "H4 D14",
    with_(
        q.P,
        select="""SELECT job_id, COALESCE(company_id, -1) AS company_id,
  CASE WHEN company_id IS NULL THEN 0 ELSE 1 END AS company_known_flag FROM p""",
    ),
)
def sentinel_keys(spark, d):
    return ft.sentinel_keys(s.postings(spark, d).select("job_id", "company_id"), {"company_id": "company_known_flag"})


# --- star schema -----------------------------------------------------------------------------


@query(
    "fact_jobs",
    "I1 C1",
    with_(
        *MASTER,
        select="""SELECT job_id, listed_date, company_id, primary_industry_id, round(normalized_salary, 4) AS normalized_salary,
  has_salary, salary_disclosure_status, skill_count, benefit_count, views, applies,
  round(applies_per_view, 4) AS applies_per_view, engagement_score, work_type_clean, experience_group_clean, is_remote,
  is_sponsored, is_hot_job, salary_band_clean, company_known_flag, industry_known_flag FROM master""",
    ),
)
def fact_jobs(spark, d):
    return rounded(star.fact_jobs(master(spark, d), "etl"))


@query(
    "dim_company",
    "I2 E9 E3",
    with_(
        q.P, q.COMPANIES,
        """sized AS (SELECT COALESCE(p.company_id, -1) AS company_id, job_id, company_size FROM p
    LEFT JOIN companies c ON c.company_id = p.company_id),
first_size AS (SELECT company_id, arg_min(company_size, job_id) FILTER (WHERE company_size IS NOT NULL) AS sz
    FROM sized GROUP BY 1),
dim AS (SELECT * FROM companies UNION ALL SELECT -1, '(Unknown Company)', 0.0, 'Unknown', NULL)""",
        select="""SELECT company_id, name, company_size, country, state, COALESCE(sz, 0.0) AS company_size_clean
  FROM dim LEFT JOIN first_size USING (company_id)""",
    ),
)
def dim_company(spark, d):
    companies = s.companies(spark, d)
    p = s.postings(spark, d).select("job_id", "company_id")
    sized = ft.sentinel_keys(keys.enrich(p, companies, "company_id", ["company_size"]), {"company_id": "known"})
    return star.dim_company(companies, sized)


@query(
    "dim_company_referenced",
    "I2 E6",
    with_(
        q.P, q.COMPANIES,
        select="SELECT * FROM companies WHERE company_id IN (SELECT company_id FROM p WHERE company_id IS NOT NULL)",
    ),
)
def dim_company_referenced(spark, d):
    return star.dim_company(s.companies(spark, d), s.postings(spark, d), referenced_only=True)


@query(
    "dim_industry",
    "I3",
    with_(q.INDUSTRIES, select="SELECT * FROM industries UNION ALL SELECT -1, '(Unknown Industry)'"),
)
def dim_industry(spark, d):
    return star.dim_simple(s.industries(spark, d), {"industry_id": -1, "industry_name": "(Unknown Industry)"})


@query("dim_skill", "I3", "SELECT DISTINCT p_brand AS skill_abr, p_brand AS skill_name FROM part")
def dim_skill(spark, d):
    return star.dim_simple(s.skills(spark, d))


_CALENDAR = """SELECT CAST(d AS DATE) AS date, CAST(year(d) AS INTEGER) AS year, CAST(quarter(d) AS INTEGER) AS quarter,
  CAST(month(d) AS INTEGER) AS month, strftime(d, '%B') AS month_name, CAST(weekofyear(d) AS INTEGER) AS week,
  CAST(day(d) AS INTEGER) AS day, strftime(d, '%A') AS day_name,
  CASE WHEN isodow(d) >= 6 THEN 1 ELSE 0 END AS is_weekend FROM """


@query(
    "dim_calendar",
    "I4",
    _CALENDAR
    + """(SELECT unnest(generate_series((SELECT min(o_orderdate) FROM orders), (SELECT max(o_orderdate) FROM orders),
  INTERVAL 1 DAY)) AS d)""",
)
def dim_calendar(spark, d):
    return star.dim_calendar(s.postings(spark, d), "listed_time")


@query("dim_calendar_observed", "I5", _CALENDAR + "(SELECT DISTINCT o_orderdate AS d FROM orders)")
def dim_calendar_observed(spark, d):
    return star.dim_calendar(s.postings(spark, d), "listed_time", observed_only=True)


def _line_parts(spark, d):
    """Tasks for the lines: eight a file split, so that a task's share has a bound however many lines there are."""
    return 8 * s.raw(spark, d, "lineitem").rdd.getNumPartitions()


@query(
    "bridge_job_benefit",
    "I6 E6",
    with_(
        q.P, q.BENEFITS,
        select="""SELECT job_id, type, count(*) AS n FROM benefits
  WHERE job_id IN (SELECT job_id FROM p WHERE views IS NOT NULL) GROUP BY job_id, type""",
    ),
)
def bridge_job_benefit(spark, d):
    fact = s.postings(spark, d).where(F.col("views").isNotNull())
    rows = star.bridge(s.benefits(spark, d), fact, "job_id", ["job_id", "type"], _line_parts(spark, d))
    return rows.groupBy("job_id", "type").agg(F.count("*").alias("n"))


@query(
    "bridge_job_skill",
    "I6 E6",
    with_(
        q.P, q.JOB_SKILLS,
        select="""SELECT job_id, skill_abr, count(*) AS n FROM job_skills
  WHERE job_id IN (SELECT job_id FROM p WHERE views IS NOT NULL) GROUP BY job_id, skill_abr""",
    ),
)
def bridge_job_skill(spark, d):
    fact = s.postings(spark, d).where(F.col("views").isNotNull())
    rows = star.bridge(s.job_skills(spark, d), fact, "job_id", ["job_id", "skill_abr"], _line_parts(spark, d))
    return rows.groupBy("job_id", "skill_abr").agg(F.count("*").alias("n"))


@query(
    "star_checks",
    "B6 B8 E7",
    with_(
        q.P, q.JOB_SKILLS, q.BENEFITS,
        "fact AS (SELECT * FROM p WHERE views IS NOT NULL)",
        select="""SELECT 'null_company_id' AS check_name, count(*) FILTER (WHERE company_id IS NULL) AS value,
    count(*) FILTER (WHERE company_id IS NULL) = 0 AS ok FROM fact
  UNION ALL SELECT 'null_job_id', count(*) FILTER (WHERE job_id IS NULL), count(*) FILTER (WHERE job_id IS NULL) = 0 FROM fact
  UNION ALL SELECT 'skill_orphans', count(*), count(*) = 0 FROM job_skills WHERE job_id NOT IN (SELECT job_id FROM fact)
  UNION ALL SELECT 'benefit_orphans', count(*), count(*) = 0 FROM benefits
    WHERE job_id NOT IN (SELECT job_id FROM fact)
  UNION ALL SELECT 'calendar_days', count(*), count(*) = max(date_diff('day', lo, hi)) + 1 FROM
    (SELECT DISTINCT o_orderdate FROM orders), (SELECT min(o_orderdate) AS lo, max(o_orderdate) AS hi FROM orders)""",
    ),
)
def star_checks(spark, d):
    posts = s.postings(spark, d)
    fact = posts.where(F.col("views").isNotNull())
    skill_bridge = s.job_skills(spark, d)
    return audit.validate_star(
        fact,
        star.dim_calendar(posts, "listed_time", observed_only=True),
        {"skill": skill_bridge, "benefit": s.benefits(spark, d)},
        ["company_id", "job_id"],
    )


@query(
    "fact_with_scores",
    "I7 I1 E3",
    with_(
        *MASTER,
        select="""SELECT m.job_id, m.company_id, listed_date, listed_month, round(normalized_salary, 4) AS normalized_salary,
  round(salary * 1.0, 4) AS pred_salary, round(prob, 6) AS hot_job_prob, formatted_work_type, formatted_experience_level,
  is_remote, is_sponsored, views, applies, CAST(description_length AS BIGINT) AS description_length, skill_count,
  benefit_count, primary_industry_id
FROM master m LEFT JOIN (SELECT o_orderkey AS job_id, o_totalprice * 0.5 AS salary, o_totalprice / 1000000 AS prob FROM orders)
  USING (job_id)""",
    ),
)
def fact_with_scores(spark, d):
    """The dashboard fact with stored predictions attached; absent wanted columns are left out."""
    stored = s.raw(spark, d, "orders").selectExpr(
        "o_orderkey AS job_id", "o_totalprice * 0.5 AS salary", "o_totalprice / 1000000 AS prob"
    )
    scored = star.attach_scores(
        master(spark, d), {"pred_salary": (stored, "salary"), "hot_job_prob": (stored, "prob")}
    )
    out = star.fact_jobs(scored, "dashboard")
    prob = F.round("hot_job_prob", 6).alias("hot_job_prob")
    length = F.col("description_length").cast("long").alias("description_length")
    rest = rounded(out.drop("hot_job_prob", "description_length")).columns
    return rounded(out.withColumn("hot_job_prob", prob), 6).select(*rest, length, "hot_job_prob").withColumns(
        {c: F.round(c, 4) for c in ("normalized_salary", "pred_salary")}
    )
