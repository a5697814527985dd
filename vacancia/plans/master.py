"""One row per job from the raw tables, in the two published variants.

Everything a posting knows by itself is worked out before the joins. All job-grain
children are aggregated to one row per job, so the joins on job_id share one partitioning
and cannot grow the fact. Company tables are combined with each other first, so the
only possibly hot key joins once.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vacancia.functions import (
    annualize,
    epoch_ms,
    listed_date,
    listed_month,
    salary_mid,
    text_length,
    title_clean,
    to_number,
)
from vacancia.operators import features as ft
from vacancia.operators.audit import StepCounts
from vacancia.operators.children import child_count, child_list, primary_child
from vacancia.operators.keys import best_per_key, dedup_first, enrich, latest_per_key

Tables = Mapping[str, DataFrame]
Mark = Callable[[str, DataFrame], DataFrame]

# The text columns that are title-cased.
POSTING_TEXT = [
    "title", "company_name", "location", "formatted_work_type", "formatted_experience_level", "application_type",
    "pay_period", "work_type", "currency", "compensation_type",
]
COMPANY_TEXT = ["name", "state", "country", "city"]
TIMES = ["listed_time", "original_listed_time", "expiry", "closed_time"]


def _order(df: DataFrame, wanted: Sequence[str], keys: Sequence[str]) -> list[str]:
    """Tie-breaking columns: the wanted ones the table has, else all others."""
    return [c for c in wanted if c in df.columns] or [c for c in df.columns if c not in keys]


def _dated(df: DataFrame) -> DataFrame:
    times = {c: epoch_ms(c) for c in TIMES if c in df.columns and dict(df.dtypes)[c] not in ("timestamp", "timestamp_ntz")}
    df = df.withColumns(times) if times else df
    return df.withColumns({"listed_date": listed_date("listed_time"), "listed_month": listed_month("listed_time")})


def _unmarked(mark: str, df: DataFrame) -> DataFrame:
    return df


def clean_postings(
    postings: DataFrame, variant: str = "clean", order: Sequence[str | Column] = (), at: Mark = _unmarked
) -> DataFrame:
    # Any fixed order will do where the caller names none; the row hash makes it total.
    order = order or [*(c for c in ("listed_time",) if c in postings.columns), F.xxhash64(*postings.columns)]
    df = at("drop_dup_job_id", dedup_first(at("postings", postings), ["job_id"], order))
    if variant == "clean":
        df = df.withColumns({c: title_clean(c) for c in POSTING_TEXT if c in df.columns})
        df = df.withColumns({c: to_number(c) for c in ("views", "applies") if c in df.columns})
        if "description" in df.columns:
            df = df.withColumn("description_length", text_length("description"))
    return ft.post_flags(_dated(df))


def clean_salaries(salaries: DataFrame, clip: bool = True, approx: bool = False) -> DataFrame:
    """Yearly salary per job: mean of the stated figures times pay periods, outliers pulled in, best row kept."""
    df = salaries.withColumns({c: to_number(c) for c in ("min_salary", "max_salary", "med_salary")})
    mid = salary_mid("min_salary", "max_salary", "med_salary", "clean")
    df = df.withColumn("normalized_salary", annualize(mid, "pay_period", "null"))
    if clip:
        df = ft.clip_quantiles(df, "normalized_salary", 0.01, 0.99, approx)
    return best_per_key(df, ["job_id"], "normalized_salary", _order(df, ["salary_id"], ["job_id"]))


def clean_companies(companies: DataFrame, title: bool = True) -> DataFrame:
    df = dedup_first(companies, ["company_id"], _order(companies, [], ["company_id"]))
    if title:
        df = df.withColumns({c: title_clean(c) for c in COMPANY_TEXT if c in df.columns})
    return df.withColumn("company_size", to_number("company_size")) if "company_size" in df.columns else df


def latest_counts(counts: DataFrame) -> DataFrame:
    tie = _order(counts, ["snapshot_id"], ["company_id", "time_recorded"])
    return latest_per_key(counts, ["company_id"], "time_recorded", [F.col(c).desc() for c in tie])


def benefit_counts(benefits: DataFrame, distinct: bool) -> DataFrame:
    return child_count(benefits, "job_id", "type", "benefit_count", distinct)


def skill_counts(job_skills: DataFrame, distinct: bool) -> DataFrame:
    return child_count(job_skills, "job_id", "skill_abr", "skill_count", distinct)


def child_summaries(tables: Tables) -> dict[str, DataFrame]:
    """The interim child tables: counts with sorted lists."""
    b = benefit_counts(tables["benefits"], False).join(
        child_list(tables["benefits"], "job_id", "type", "benefit_types"), "job_id"
    )
    s = skill_counts(tables["job_skills"], False).join(
        child_list(tables["job_skills"], "job_id", "skill_abr", "skill_list"), "job_id"
    )
    return {"benefits_agg": b, "skills_agg": s}


def primary_industry(job_industries: DataFrame, industries: DataFrame, order: Sequence[str | Column]) -> DataFrame:
    first = primary_child(job_industries, "job_id", "industry_id", order, industries, "industry_name")
    return first.withColumnsRenamed(
        {"industry_id": "primary_industry_id", "industry_name": "primary_industry_name"}
    )


def _industry_order(df: DataFrame) -> list[str]:
    return _order(df, ["position", "tie_1", "tie_2"], []) if "position" in df.columns else ["industry_id"]


def _company_side(tables: Tables, variant: str, at: Mark = _unmarked) -> tuple[DataFrame, list[str]]:
    """Company attributes and newest headcount side by side, one row per company."""
    counts = at("employee_counts_latest", latest_counts(at("employee_counts", tables["employee_counts"])))
    if variant == "etl":
        return counts.select("company_id", "employee_count"), ["employee_count"]
    companies = at("companies_final", clean_companies(at("companies", tables["companies"])))
    cols = [c for c in ("name", "state", "country", "city", "company_size", "url") if c in companies.columns]
    more = [c for c in ("employee_count", "follower_count") if c in counts.columns]
    both = companies.select("company_id", *cols).join(counts.select("company_id", *more), "company_id", "full")
    return both.where(F.col("company_id").isNotNull()), cols + more


def etl_salary(postings: DataFrame) -> DataFrame:
    """Stated yearly salary, else the one worked out from the range and the pay period."""
    stated = F.col("normalized_salary") if "normalized_salary" in postings.columns else F.lit(None).cast("double")
    df = postings.withColumn("salary_raw", salary_mid("min_salary", "max_salary", "med_salary", "etl"))
    df = df.withColumn("calc_salary", annualize("salary_raw", "pay_period", "passthrough"))
    return df.withColumn("normalized_salary", F.coalesce(stated, F.col("calc_salary")))


def posting_features(df: DataFrame, approx: bool = False) -> DataFrame:
    """The analysis columns a posting yields by itself."""
    df = ft.clean_categories(ft.performance(ft.disclosure(df)))
    df = ft.salary_bands(df)
    return ft.quantile_flag(df, "views", 0.75, ">=", "is_hot_job", approx)


def build_master(
    tables: Tables,
    variant: str = "etl",
    salary_source: str = "posting",
    approx: bool = False,
    counts: StepCounts | None = None,
) -> DataFrame:
    """One row per job.

    ``etl``: raw text, analysis columns, unknown keys as -1. ``clean``: title-cased text, company
    attributes, strict (>) high-view flags. ``salary_source`` (clean only): the posting's own
    salary, the cleaned one, or the posting's with the cleaned one behind it. ``counts`` takes the rows at every
    step of the build when the result is written; ``counts.report(BUILD_STEPS)`` lists them (clean only).
    """
    if variant not in ("etl", "clean"):
        raise ValueError(f"variant must be 'etl' or 'clean', not {variant!r}")
    if salary_source not in ("posting", "clean", "coalesce"):
        raise ValueError(f"salary_source must be posting, clean or coalesce, not {salary_source!r}")
    distinct = variant == "clean"
    at = counts.at if counts else _unmarked
    df = clean_postings(tables["postings"], variant, at=at)
    if variant == "etl":
        df = posting_features(etl_salary(df), approx)
    else:
        high = {"is_high_views": ("views", 0.75, ">"), "is_high_applies": ("applies", 0.75, ">")}
        df = at("postings_final", ft.quantile_flags(df, high, approx))
        sal = at("salaries_final", clean_salaries(at("salaries", tables["salaries"]), approx=approx))
        cols = ["normalized_salary", "min_salary", "max_salary", "med_salary", "pay_period", "currency", "compensation_type"]
        df = enrich(df, sal, "job_id", [c for c in cols if c in sal.columns], suffix="_sal")
        df = at("join_salary", df)
        clean = F.col("normalized_salary_sal") if "normalized_salary_sal" in df.columns else F.col("normalized_salary")
        if salary_source == "clean":
            df = df.withColumn("normalized_salary", clean)
        elif salary_source == "coalesce":
            df = df.withColumn("normalized_salary", F.coalesce("normalized_salary", clean))
        df = ft.salary_bands(df, "salary_band", guard_nonpositive=False)
    benefits = at("benefits_agg", benefit_counts(at("benefits", tables["benefits"]), distinct))
    df = at("join_benefits", enrich(df, benefits, "job_id", ["benefit_count"], fills={"benefit_count": 0}))
    skills = at("job_skills_agg", skill_counts(at("job_skills", tables["job_skills"]), distinct))
    df = at("join_skills", enrich(df, skills, "job_id", ["skill_count"], fills={"skill_count": 0}))
    order = _industry_order(tables["job_industries"])
    ind = primary_industry(at("job_industries", tables["job_industries"]), tables["industries"], order)
    ind = at("job_industries_primary", ind)
    df = at("join_industry", enrich(df, ind, "job_id", ["primary_industry_id", "primary_industry_name"]))
    side, cols = _company_side(tables, variant, at)
    df = at("join_company", enrich(df, side, "company_id", cols, suffix="_comp"))
    if variant == "etl":
        keys = {"company_id": "company_known_flag", "primary_industry_id": "industry_known_flag"}
        df = ft.sentinel_keys(df, keys)
    return df


# The published steps and their order. A step goes from one mark of the build to another; headcounts
# are joined with the companies, so their own step changes nothing.
BUILD_STEPS = [
    ("drop_dup_job_id", "postings", "drop_dup_job_id", "duplicate job_id removed"),
    ("postings_final", "drop_dup_job_id", "postings_final", ""),
    ("salaries_final", "salaries", "salaries_final", ""),
    ("benefits_agg", "benefits", "benefits_agg", ""),
    ("job_skills_agg", "job_skills", "job_skills_agg", ""),
    ("job_industries_primary", "job_industries", "job_industries_primary", ""),
    ("companies_final", "companies", "companies_final", ""),
    ("employee_counts_latest", "employee_counts", "employee_counts_latest", ""),
    ("join_salary", "postings_final", "join_salary", ""),
    ("join_benefits", "join_salary", "join_benefits", ""),
    ("join_skills", "join_benefits", "join_skills", ""),
    ("join_industry", "join_skills", "join_industry", ""),
    ("join_company", "join_industry", "join_company", ""),
    ("join_employee_counts", "join_company", "join_company", "joined with the company"),
    ("dedup_final", "join_company", "dedup_final", "ensure 1-row-per-job_id"),
]


def build_report(tables: Tables, **how) -> DataFrame:
    """Rows in and out of every step of the clean build, counted in one run of the build itself.

    The last step looks at job_id alone: the build keeps one row per job, a join that grew it would show there.
    """
    counts = StepCounts()
    jobs = build_master(tables, "clean", counts=counts, **how).select("job_id")
    kept = counts.at("dedup_final", dedup_first(jobs, ["job_id"], ["job_id"]))
    kept.write.format("noop").mode("overwrite").save()
    return counts.report(BUILD_STEPS)
