"""Schemas of the eleven input tables. Names and types of the published files."""

from __future__ import annotations

from pyspark.sql.types import DoubleType, IntegerType, LongType, StringType, StructField, StructType

_COLUMNS = {
    "postings": """
        job_id bigint, company_name string, title string, description string, max_salary double, pay_period string,
        location string, company_id bigint, views bigint, med_salary double, min_salary double,
        formatted_work_type string, applies bigint, original_listed_time bigint, remote_allowed int,
        job_posting_url string, application_url string, application_type string, expiry bigint, closed_time bigint,
        formatted_experience_level string, skills_desc string, listed_time bigint, posting_domain string,
        sponsored int, work_type string, currency string, compensation_type string, normalized_salary double,
        zip_code double, fips double""",
    "companies": """
        company_id bigint, name string, description string, company_size double, state string, country string,
        city string, zip_code string, address string, url string""",
    "employee_counts": "company_id bigint, employee_count bigint, follower_count bigint, time_recorded bigint",
    "job_skills": "job_id bigint, skill_abr string",
    "job_industries": "job_id bigint, industry_id bigint",
    "salaries": """
        salary_id bigint, job_id bigint, max_salary double, med_salary double, min_salary double, pay_period string,
        currency string, compensation_type string""",
    "industries": "industry_id bigint, industry_name string",
    "skills": "skill_abr string, skill_name string",
    "benefits": "job_id bigint, inferred int, type string",
    "company_industries": "company_id bigint, industry string",
    "company_specialities": "company_id bigint, speciality string",
}

_TYPES = {"bigint": LongType(), "int": IntegerType(), "double": DoubleType(), "string": StringType()}


def _struct(columns: str) -> StructType:
    pairs = (c.split() for c in columns.split(","))
    return StructType([StructField(name, _TYPES[kind]) for name, kind in pairs])


SCHEMAS: dict[str, StructType] = {name: _struct(columns) for name, columns in _COLUMNS.items()}

# Free text may hold line breaks; such files cannot be split, so the others are read without.
MULTILINE = {"postings", "companies"}
