"""Star schema: lean facts, dimensions with an unknown member, calendar, bridges."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vacancia.operators.keys import add_unknown_member, dedup_first, keep_known, lookup, select_available

# The columns of the three fact exports.
FACT_COLUMNS = {
    "etl": [
        "job_id", "listed_date", "company_id", "primary_industry_id", "normalized_salary", "has_salary",
        "salary_disclosure_status", "skill_count", "benefit_count", "views", "applies", "applies_per_view",
        "engagement_score", "work_type_clean", "experience_group_clean", "is_remote", "is_sponsored", "is_hot_job",
        "salary_band_clean", "company_known_flag", "industry_known_flag",
    ],
    "scored": [
        "job_id", "listed_date", "company_id", "primary_industry_id", "normalized_salary", "has_salary",
        "salary_disclosure_status", "skill_count", "benefit_count", "views", "applies", "applies_per_view",
        "engagement_score", "work_type_clean", "experience_group_clean", "is_remote", "hot_job_prob",
        "salary_band_clean",
    ],
    "dashboard": [
        "job_id", "company_id", "title", "location", "listed_date", "listed_month", "normalized_salary",
        "pred_salary", "hot_job_prob", "formatted_work_type", "formatted_experience_level", "is_remote",
        "is_sponsored", "views", "applies", "description_length", "skill_count", "benefit_count", "salary_band",
        "primary_industry_id",
    ],
}


def fact_jobs(master: DataFrame, cols: Sequence[str] | str = "etl") -> DataFrame:
    """The wanted columns that the master has."""
    return select_available(master, FACT_COLUMNS[cols] if isinstance(cols, str) else cols)[0]


def dim_company(
    companies: DataFrame,
    master: DataFrame | None = None,
    referenced_only: bool = False,
    size_col: str = "company_size",
    order: Sequence[str] = (),
) -> DataFrame:
    """One row per company, an unknown member, and the size as the master has it.

    ``referenced_only`` keeps the companies the master names and adds nothing.
    """
    if referenced_only:
        return keep_known(companies, master.select("company_id").distinct(), "company_id")
    rest = list(order) or [c for c in companies.columns if c != "company_id"]
    dim = add_unknown_member(
        dedup_first(companies, ["company_id"], rest),
        {"company_id": -1, "name": "(Unknown Company)", size_col: 0, "country": "Unknown"},
    )
    if master is None or size_col not in master.columns:
        return dim
    # One row per company before the join: the first size by job.
    sizes = master.groupBy("company_id").agg(F.min_by(size_col, "job_id").alias("_size"))
    return lookup(dim, "company_id", sizes, "_size", 0, name="company_size_clean")


def dim_simple(dim: DataFrame, unknown: Mapping[str, object] | None = None) -> DataFrame:
    return dim if unknown is None else add_unknown_member(dim, unknown)


def dim_calendar(df: DataFrame, col: str = "listed_date", observed_only: bool = False) -> DataFrame:
    """One row per day from the first to the last date, or per date that occurs."""
    dates = df.select(F.to_date(col).alias("date")).where(F.col("date").isNotNull())
    if observed_only:
        days = dates.distinct()
    else:
        ends = dates.agg(F.min("date").alias("lo"), F.max("date").alias("hi")).where(F.col("lo").isNotNull())
        days = ends.select(F.explode(F.sequence("lo", "hi")).alias("date"))
    return days.select(
        "date",
        F.year("date").alias("year"),
        F.quarter("date").alias("quarter"),
        F.month("date").alias("month"),
        F.date_format("date", "MMMM").alias("month_name"),
        F.weekofyear("date").alias("week"),
        F.day("date").alias("day"),
        F.date_format("date", "EEEE").alias("day_name"),
        (F.weekday("date") >= 5).cast("int").alias("is_weekend"),
    )


def bridge(child: DataFrame, fact: DataFrame, key: str, cols: Sequence[str], parts: int | None = None) -> DataFrame:
    """The child rows whose job is in the fact.

    ``parts`` deals the child rows to that many tasks by job first: counts per job and value then need no table of
    nearly all rows of a file split, as a job's rows are spread over the files.
    """
    rows = child.select(*cols)
    return keep_known(rows if parts is None else rows.repartition(parts, key), fact, key)


def attach_scores(fact: DataFrame, scores: Mapping[str, tuple[DataFrame, str]], key: str = "job_id") -> DataFrame:
    """Adds stored predictions: ``scores`` maps the new column to (table, its column)."""
    for name, (table, col) in scores.items():
        fact = lookup(fact, key, table, col, name=name)
    return fact
