"""Descriptive and diagnostic statistics over the master."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vacancia.operators.keys import top_k
from vacancia.operators.ranks import first_by_hash, quantiles, with_group


def _same_keys(df: DataFrame, other: DataFrame, by: Sequence[str], how: str = "inner") -> DataFrame:
    return df.join(other, list(by), how)


def overview(df: DataFrame) -> DataFrame:
    """The headline figures of a master, in one row."""
    pct = lambda c: F.avg(c) * 100
    return df.agg(
        F.count("*").alias("total_jobs"),
        F.countDistinct("company_id").alias("unique_companies"),
        F.countDistinct("primary_industry_id").alias("unique_industries"),
        F.avg("skill_count").alias("avg_skills"),
        pct("has_salary").alias("disclosed_pct"),
        pct(1 - F.col("has_salary")).alias("hidden_pct"),
        pct("is_remote").alias("remote_pct"),
        pct("is_sponsored").alias("sponsored_pct"),
        F.min("listed_date").alias("date_min"),
        F.max("listed_date").alias("date_max"),
    )


def build_summary(df: DataFrame) -> DataFrame:
    """The figures of the build report: rows, columns, sums of the flags, date range."""
    return df.agg(
        F.count("*").alias("total_rows"),
        F.lit(len(df.columns)).cast("long").alias("total_columns"),
        F.sum("has_salary").alias("salary_disclosed"),
        F.sum(1 - F.col("has_salary")).alias("salary_hidden"),
        F.sum("is_remote").alias("remote_jobs"),
        F.sum("is_hot_job").alias("hot_jobs"),
        F.sum("company_known_flag").alias("companies_known"),
        F.sum("industry_known_flag").alias("industries_known"),
        F.min("listed_date").alias("date_min"),
        F.max("listed_date").alias("date_max"),
    )


def describe_num(df: DataFrame, col: str, approx: bool = False) -> DataFrame:
    """Count, mean, median, sample standard deviation and maximum of one column."""
    mid = quantiles(df, col, {"median": 0.5}, approx=approx).scalar()
    return df.agg(
        F.count(col).alias("n"),
        F.avg(col).alias("mean"),
        F.stddev_samp(col).alias("std"),
        F.max(col).alias("max"),
    ).select("n", "mean", mid.alias("median"), "std", "max")


def _grouped(df: DataFrame, by: Sequence[str]) -> DataFrame:
    return df.na.drop(subset=list(by))


def group_stats(
    df: DataFrame,
    by: Sequence[str],
    val: str,
    probs: Mapping[str, float] | None = None,
    key: str | None = None,
    approx: bool = False,
) -> DataFrame:
    """Count, mean and quantiles of ``val`` per group; rows without a group are left out.

    ``key`` counts that column instead of rows.
    """
    probs = probs if probs is not None else {"median": 0.5, "p25": 0.25, "p75": 0.75}
    rows = _grouped(df, by)
    out = rows.groupBy(*by).agg(F.count(key or "*").alias("job_count"), F.avg(val).alias("mean"))
    if not probs:
        return out
    return _same_keys(out, quantiles(rows, val, probs, by, approx), by, "left")


def top_groups(df: DataFrame, by: str, val: str, n: int, key: str | None = None) -> DataFrame:
    """The n largest groups with mean and median. Medians are worked out for those n groups only."""
    rows = _grouped(df, [by])
    counted = rows.groupBy(by).agg(F.count(key or "*").alias("job_count"), F.avg(val).alias("avg_salary"))
    top = top_k(counted, [F.desc("job_count"), by], n)
    mine = rows.join(F.broadcast(top.select(by)), by, "left_semi")  # n rows
    medians = quantiles(mine, val, {"median_salary": 0.5}, [by])
    return top.join(medians, by, "left").orderBy(F.desc("job_count"), by)


def group_median(df: DataFrame, by: str, val: str, name: str = "median", approx: bool = False) -> DataFrame:
    return quantiles(_grouped(df, [by]), val, {name: 0.5}, [by], approx).orderBy(F.desc(name), by)


def group_mean(df: DataFrame, by: str, val: str, name: str = "mean") -> DataFrame:
    return _grouped(df, [by]).groupBy(by).agg(F.avg(val).alias(name)).orderBy(F.desc(name), by)


def group_rate(df: DataFrame, by: str, flag: str, name: str = "rate_pct") -> DataFrame:
    """Share of rows with the flag set per group, in percent."""
    return _grouped(df, [by]).groupBy(by).agg((F.avg(flag) * 100).alias(name)).orderBy(F.desc(name), by)


def value_counts(df: DataFrame, col: str, normalize: bool = False) -> DataFrame:
    """Rows per value, missing values left out; with ``normalize`` also the share of the total.

    The total is a scalar of its own, not a window over all groups.
    """
    rows = _grouped(df, [col])
    out = rows.groupBy(col).agg(F.count("*").alias("n"))
    if normalize:
        total = rows.agg(F.count("*").alias("t")).scalar()
        out = out.withColumn("share", F.col("n") / total)
    return out.orderBy(F.desc("n"), col)


def share(df: DataFrame, col: str) -> DataFrame:
    """Rows per value and their percentage."""
    total = df.agg(F.count("*").alias("t")).scalar()
    return df.groupBy(col).agg(F.count("*").alias("n")).withColumn("pct", F.col("n") / total * 100).orderBy(col)


def reorder(df: DataFrame, col: str, order: Sequence[str], keep_absent: bool = True) -> DataFrame:
    """Rows in a stated category order; categories without a row appear with nulls, others go."""
    spark = df.sparkSession
    ranks = F.array(*(F.struct(F.lit(i).alias("position"), F.lit(v).alias(col)) for i, v in enumerate(order)))
    wanted = spark.range(1).select(F.explode(ranks).alias("e")).select("e.*")
    out = wanted.join(df, col, "left" if keep_absent else "inner")
    return out.select("position", *df.columns).orderBy("position")


def monthly_trend(df: DataFrame, month: str = "listed_month", last: int = 18) -> DataFrame:
    """Rows per month over the last months, the busiest one marked (the first of equals)."""
    months = top_k(_grouped(df, [month]).groupBy(month).agg(F.count("*").alias("job_count")), [F.desc(month)], last)
    # At most `last` rows from here on.
    peak = top_k(months, [F.desc("job_count"), month], 1).select(F.col(month).alias("m")).scalar()
    return months.withColumn("is_peak", (F.col(month) == peak).cast("int")).orderBy(month)


def correlation(df: DataFrame, x: str, y: str, name: str = "r") -> DataFrame:
    return df.agg(F.corr(x, y).alias(name))


def corr_matrix(df: DataFrame, cols: Sequence[str], digits: int | None = 3) -> DataFrame:
    """Pairwise-complete Pearson correlations, one row per variable. All pairs in one aggregate."""
    pairs = [(a, b) for i, a in enumerate(cols) for b in cols[i:]]
    both = lambda a, b: F.col(a).isNotNull() & F.col(b).isNotNull()
    wide = df.agg(
        *(
            F.corr(F.when(both(a, b), F.col(a).cast("double")), F.when(both(a, b), F.col(b).cast("double"))).alias(
                f"_{a}|{b}"
            )
            for a, b in pairs
        )
    )

    def cell(a: str, b: str) -> Column:
        r = F.col(f"`_{a}|{b}`") if (a, b) in pairs else F.col(f"`_{b}|{a}`")
        return r if digits is None else F.round(r, digits)

    lines = [F.struct(F.lit(a).alias("variable"), *(cell(a, b).alias(b) for b in cols)) for a in cols]
    return wide.select(F.explode(F.array(*lines)).alias("e")).select("e.*")


def histogram(
    df: DataFrame, col: str, bins: int, lo_q: float | None = None, hi_q: float | None = None
) -> DataFrame:
    """Counts in ``bins`` equal bins from the minimum to the maximum, the last edge included.

    With ``lo_q``/``hi_q`` the range runs between those quantiles and rows outside are left out.
    Bins nothing fell into are there with 0.
    """
    v = F.col(col).cast("double")
    rows = df.select(v.alias("_v")).where(F.col("_v") <= F.lit(float("inf")))
    if lo_q is None or hi_q is None:
        ends = rows.agg(F.min("_v").alias("lo"), F.max("_v").alias("hi"))
    else:
        ends = quantiles(rows, "_v", {"lo": lo_q, "hi": hi_q})
    # A constant column gets a range of 1 around its value.
    pad = F.when(F.col("lo") == F.col("hi"), 0.5).otherwise(0.0)
    ends = ends.select((F.col("lo") - pad).alias("lo"), (F.col("hi") + pad).alias("hi"))
    span = ends.select(F.struct("lo", "hi").alias("s"))
    placed = rows.withColumn("_s", span.scalar()).where(F.col("_v").between(F.col("_s.lo"), F.col("_s.hi")))
    place = F.floor((F.col("_v") - F.col("_s.lo")) / (F.col("_s.hi") - F.col("_s.lo")) * bins)
    counts = (
        placed.select(F.coalesce(F.least(place, F.lit(bins - 1)), F.lit(0)).cast("int").alias("bin"))
        .groupBy("bin")
        .agg(F.count("*").alias("n"))
    )
    grid = ends.select(F.explode(F.sequence(F.lit(0), F.lit(bins - 1))).alias("bin"), "lo", "hi")
    width = (F.col("hi") - F.col("lo")) / bins
    return grid.join(counts, "bin", "left").select(
        "bin",
        (F.col("lo") + F.col("bin") * width).alias("left_edge"),
        (F.col("lo") + (F.col("bin") + 1) * width).alias("right_edge"),
        F.coalesce(F.col("n"), F.lit(0)).alias("n"),
    )


def box_stats(df: DataFrame, by: str, val: str, whisker: float = 1.5) -> DataFrame:
    """Per group: quartiles, the outermost values within 1.5 interquartile ranges, and how many lie beyond."""
    rows = _grouped(df, [by]).where(F.col(val).isNotNull()).select(by, F.col(val).alias("_v"))
    q = quantiles(rows, "_v", {"q1": 0.25, "median": 0.5, "q3": 0.75}, [by])
    reach = (F.col("q3") - F.col("q1")) * whisker
    fenced = with_group(rows, q, [by], "_v")
    inside = F.col("_v").between(F.col("q1") - reach, F.col("q3") + reach)
    return (
        fenced.groupBy(by, "q1", "median", "q3")
        .agg(
            F.count("*").alias("n"),
            F.min(F.when(inside, F.col("_v"))).alias("whisker_low"),
            F.max(F.when(inside, F.col("_v"))).alias("whisker_high"),
            F.count(F.when(~inside, 1)).alias("outliers"),
        )
        .select(by, "n", "q1", "median", "q3", "whisker_low", "whisker_high", "outliers")
    )


def fit_line(df: DataFrame, x: str, y: str) -> DataFrame:
    """Least-squares line of y on x over rows with both."""
    return df.agg(
        F.regr_slope(y, x).alias("slope"), F.regr_intercept(y, x).alias("intercept"), F.regr_count(y, x).alias("n")
    )


def sample_n(df: DataFrame, n: int, seed: int, keys: Sequence[str]) -> DataFrame:
    """n rows (all if there are fewer), chosen by key hash: the same rows on any partitioning."""
    return first_by_hash(df, keys, F.lit(n), seed).where("_picked").drop("_picked")


def measures(fact: DataFrame) -> DataFrame:
    """Dashboard measures: conversion as a ratio of sums, salary gap, mean skills, distinct jobs."""
    return fact.agg(
        F.countDistinct("job_id").alias("jobs"),
        F.try_divide(F.sum("applies"), F.sum("views")).alias("conversion_rate"),
        (F.avg("normalized_salary") - F.avg("pred_salary")).alias("salary_gap"),
        F.avg("skill_count").alias("skills_intensity"),
        F.sum("engagement_score").alias("total_engagement"),
        F.avg("applies_per_view").alias("avg_applies_per_view"),
    )
