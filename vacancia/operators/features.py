"""Columns added to the master."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vacancia.functions import band, engagement, experience_group, flag, safe_ratio, text_length
from vacancia.functions.measures import BANDS_40_80_150
from vacancia.operators.ranks import column_quantiles, quantiles


def disclosure(df: DataFrame, salary: str = "normalized_salary") -> DataFrame:
    has = F.when(F.col(salary) > 0, 1).otherwise(0)
    return df.withColumn("has_salary", has).withColumn(
        "salary_disclosure_status", F.when(F.col("has_salary") == 1, "Disclosed").otherwise("Hidden")
    )


def performance(df: DataFrame, weight: int = 10) -> DataFrame:
    return df.withColumns(
        {"applies_per_view": safe_ratio("applies", "views"), "engagement_score": engagement("views", "applies", weight)}
    )


def sentinel_keys(df: DataFrame, cols: Mapping[str, str]) -> DataFrame:
    """Null keys become -1 with a 0/1 flag beside them: ``cols`` maps key to flag name."""
    df = df.withColumns({c: F.coalesce(F.col(c), F.lit(-1)) for c in cols})
    return df.withColumns({name: F.when(F.col(c) != -1, 1).otherwise(0) for c, name in cols.items()})


def clean_categories(df: DataFrame) -> DataFrame:
    return df.withColumns(
        {
            "work_type_clean": F.coalesce(F.col("formatted_work_type"), F.lit("Other")),
            "experience_group_clean": experience_group("formatted_experience_level"),
        }
    )


def salary_bands(
    df: DataFrame,
    name: str = "salary_band_clean",
    edges: Sequence[float] = BANDS_40_80_150[0],
    labels: Sequence[str] = BANDS_40_80_150[1],
    guard_nonpositive: bool = True,
    salary: str = "normalized_salary",
) -> DataFrame:
    return df.withColumn(name, band(salary, edges, labels, guard_nonpositive))


def quantile_flags(df: DataFrame, flags: Mapping[str, tuple[str, float, str]], approx: bool = False) -> DataFrame:
    """For each name: (column, quantile, ``>=`` or ``>``), 1 where the column is beyond its own quantile, else 0.

    The thresholds of all flags come from the same two scans, as one row that is read once.
    """
    cuts = column_quantiles(df, {name: (col, q) for name, (col, q, _) in flags.items()}, approx)
    marked = df.withColumn("_cuts", cuts.select(F.struct(*flags)).scalar())
    beyond = {
        name: F.col(col) >= F.col(f"_cuts.{name}") if op == ">=" else F.col(col) > F.col(f"_cuts.{name}")
        for name, (col, _, op) in flags.items()
    }
    return marked.withColumns({name: F.when(test, 1).otherwise(0) for name, test in beyond.items()}).drop("_cuts")


def quantile_flag(df: DataFrame, col: str, q: float, op: str, name: str, approx: bool = False) -> DataFrame:
    """1 where the column is beyond its own quantile. The threshold is one number, read once."""
    return quantile_flags(df, {name: (col, q, op)}, approx)


def threshold_flag(df: DataFrame, col: str, threshold: float, name: str) -> DataFrame:
    return df.withColumn(name, F.when(F.col(col) >= threshold, 1).otherwise(0))


def clip_quantiles(df: DataFrame, col: str, lo: float = 0.01, hi: float = 0.99, approx: bool = False) -> DataFrame:
    """Pull values beyond the two quantiles back onto them; nulls stay null."""
    ends = quantiles(df, col, {"lo": lo, "hi": hi}, approx=approx).select(F.struct("lo", "hi").alias("s"))
    clipped = F.greatest(F.least(F.col(col), F.col("_s.hi")), F.col("_s.lo"))
    return (
        df.withColumn("_s", ends.scalar())
        .withColumn(col, F.when(F.col(col).isNotNull(), clipped))
        .drop("_s")
    )


def post_flags(df: DataFrame) -> DataFrame:
    """Remote and sponsored as 0/1 and the description length, for whichever source columns exist."""
    have = set(df.columns)
    out = {
        "is_remote": flag("remote_allowed") if "remote_allowed" in have else F.lit(0),
        "is_sponsored": flag("sponsored") if "sponsored" in have else F.lit(0),
    }
    if "description" in have:
        out["description_length"] = text_length("description")
    return df.withColumns(out)


def name_clusters(profile: DataFrame, salary: str = "normalized_salary") -> DataFrame:
    """Cluster names from the mean salary of each cluster."""
    name = (
        F.when(F.col(salary) > 100_000, "Premium / Expert")
        .when(F.col(salary) > 50_000, "Mid-Market / Professional")
        .otherwise("Entry / Volume")
    )
    return profile.withColumn("cluster_name", name)


def label_clusters(df: DataFrame, names: Mapping[int, str], default: str = "Unknown") -> DataFrame:
    """Cluster names from a given table."""
    out = None
    for k, v in names.items():
        test = F.col("cluster") == k
        out = F.when(test, F.lit(v)) if out is None else out.when(test, F.lit(v))
    return df.withColumn("cluster_name", F.lit(default) if out is None else out.otherwise(F.lit(default)))
