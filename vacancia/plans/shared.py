"""SQL text shared by the twins."""

from __future__ import annotations

from vacancia.plans import standins as s

def key_hash(col: str, seed: int) -> str:
    """The key hash of splits and samples."""
    return f"CAST('0x' || substr(md5(CAST({col} AS VARCHAR) || '|{seed}'), 1, 13) AS BIGINT)"


P = f"p AS ({s.posting_sql()})"
P_STATED = f"p AS ({s.posting_sql(stated=True)})"
COMPANIES = f"companies AS ({s.COMPANY_SQL})"
COUNTS = f"counts AS ({s.COUNT_SQL})"
JOB_SKILLS = f"job_skills AS ({s.SKILL_SQL})"
BENEFITS = f"benefits AS ({s.BENEFIT_SQL})"
JOB_INDUSTRIES = f"job_industries AS ({s.INDUSTRY_SQL})"
INDUSTRIES = "industries AS (SELECT CAST(n_nationkey AS BIGINT) AS industry_id, n_name AS industry_name FROM nation)"
SKILLS = "skills AS (SELECT DISTINCT p_brand AS skill_abr, p_brand AS skill_name FROM part)"
SALARIES = f"salaries AS ({s.SALARY_SQL})"

# Yearly salary of a posting: middle, else halfway between the ends, times periods per year.
PRICED = """priced AS (
  SELECT *, COALESCE(med_salary, (min_salary + max_salary) / 2) *
    CASE upper(trim(pay_period)) WHEN 'YEARLY' THEN 1 WHEN 'ANNUAL' THEN 1 WHEN 'ANNUALLY' THEN 1
      WHEN 'MONTHLY' THEN 12 WHEN 'WEEKLY' THEN 52 WHEN 'HOURLY' THEN 2080
      ELSE CASE WHEN pay_period IS NOT NULL THEN 1 END END AS normalized_salary
  FROM p)"""

BAND_40 = """CASE WHEN normalized_salary IS NULL OR normalized_salary <= 0 THEN 'Unknown'
    WHEN normalized_salary < 40000 THEN 'Low (<40k)' WHEN normalized_salary < 80000 THEN 'Mid (40-80k)'
    WHEN normalized_salary < 150000 THEN 'High (80-150k)' ELSE 'Very High (>150k)' END"""

EXP_GROUP = """CASE lower(formatted_experience_level) WHEN 'internship' THEN 'Entry' WHEN 'entry level' THEN 'Entry'
    WHEN 'associate' THEN 'Associate' WHEN 'mid-senior level' THEN 'Mid-Senior' WHEN 'director' THEN 'Executive'
    WHEN 'executive' THEN 'Executive' ELSE 'Unknown' END"""

# The etl master, one CTE per step.
MASTER = f"""m0 AS (
  SELECT job_id, company_id, formatted_work_type, formatted_experience_level, med_salary, min_salary, max_salary,
    pay_period, views, applies, remote_allowed, sponsored, description, listed_time, normalized_salary,
    CAST(listed_time AS DATE) AS listed_date, strftime(listed_time, '%Y-%m') AS listed_month,
    CASE WHEN normalized_salary > 0 THEN 1 ELSE 0 END AS has_salary,
    CASE WHEN normalized_salary > 0 THEN 'Disclosed' ELSE 'Hidden' END AS salary_disclosure_status,
    CASE WHEN views IS NULL OR views = 0 OR applies IS NULL THEN 0.0 ELSE CAST(applies AS DOUBLE) / views END
      AS applies_per_view,
    COALESCE(views, 0) + COALESCE(applies, 0) * 10 AS engagement_score,
    COALESCE(formatted_work_type, 'Other') AS work_type_clean,
    {EXP_GROUP} AS experience_group_clean,
    {BAND_40} AS salary_band_clean,
    CASE WHEN views >= (SELECT quantile_cont(views, 0.75) FROM p) THEN 1 ELSE 0 END AS is_hot_job,
    COALESCE(remote_allowed, 0) AS is_remote, COALESCE(sponsored, 0) AS is_sponsored,
    length(COALESCE(description, '')) AS description_length
  FROM priced),
benefit_n AS (SELECT job_id, count(type) AS benefit_count FROM benefits GROUP BY job_id),
skill_n AS (SELECT job_id, count(skill_abr) AS skill_count FROM job_skills GROUP BY job_id),
first_ind AS (
  SELECT job_id, industry_id, industry_name FROM (
    SELECT *, row_number() OVER (PARTITION BY job_id ORDER BY position, tie_1, tie_2) AS rn FROM job_industries)
  LEFT JOIN industries USING (industry_id) WHERE rn = 1),
newest AS (
  SELECT company_id, employee_count, follower_count FROM (
    SELECT *, row_number() OVER (PARTITION BY company_id ORDER BY time_recorded DESC, snapshot_id DESC) AS rn
    FROM counts) WHERE rn = 1),
master AS (
  SELECT m0.* EXCLUDE (company_id), COALESCE(m0.company_id, -1) AS company_id,
    COALESCE(benefit_count, 0) AS benefit_count, COALESCE(skill_count, 0) AS skill_count,
    COALESCE(industry_id, -1) AS primary_industry_id, industry_name AS primary_industry_name, employee_count,
    CASE WHEN m0.company_id IS NOT NULL THEN 1 ELSE 0 END AS company_known_flag,
    CASE WHEN industry_id IS NOT NULL THEN 1 ELSE 0 END AS industry_known_flag
  FROM m0 LEFT JOIN benefit_n USING (job_id) LEFT JOIN skill_n USING (job_id) LEFT JOIN first_ind USING (job_id)
    LEFT JOIN newest ON newest.company_id = m0.company_id)"""

MASTER_CTES = [P, PRICED, JOB_SKILLS, BENEFITS, JOB_INDUSTRIES, INDUSTRIES, COUNTS, MASTER]

# Every stand-in table.
TABLE_CTES = [P, COMPANIES, COUNTS, JOB_SKILLS, JOB_INDUSTRIES, SALARIES, INDUSTRIES, SKILLS, BENEFITS]
