"""Salary and engagement arithmetic."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from vacancia.functions.cleaning import ColumnOrName, _col, code_clean, literal_map, map_values

# How many pay periods make a year.
PERIODS_PER_YEAR = {"YEARLY": 1, "ANNUAL": 1, "ANNUALLY": 1, "MONTHLY": 12, "WEEKLY": 52, "HOURLY": 2080}

# Experience level to reporting group.
EXPERIENCE_GROUPS = {
    "Internship": "Entry",
    "Entry level": "Entry",
    "Associate": "Associate",
    "Mid-Senior level": "Mid-Senior",
    "Director": "Executive",
    "Executive": "Executive",
}

# The two band scales in use.
BANDS_40_80_150 = ([40_000, 80_000, 150_000], ["Low (<40k)", "Mid (40-80k)", "High (80-150k)", "Very High (>150k)"])
BANDS_50_100_150 = ([50_000, 100_000, 150_000], ["<50k", "50k-100k", "100k-150k", "150k+"])


def annualize(value: ColumnOrName, period: ColumnOrName, unknown: str = "passthrough") -> Column:
    """Salary per pay period to salary per year.

    ``unknown`` says what a period outside the table does: ``passthrough`` keeps
    the amount as it is, ``null`` drops it. No period gives no amount either way.
    """
    if unknown not in ("passthrough", "null"):
        raise ValueError(f"unknown must be 'passthrough' or 'null', not {unknown!r}")
    factor = literal_map(PERIODS_PER_YEAR)[code_clean(period)]
    if unknown == "passthrough":
        factor = F.coalesce(factor, F.when(_col(period).isNotNull(), F.lit(1)))
    return _col(value) * factor


def salary_mid(lowest: ColumnOrName, highest: ColumnOrName, middle: ColumnOrName, variant: str = "etl") -> Column:
    """One salary from the stated range.

    ``etl``: the middle, else halfway between the ends. ``clean``: the mean of whichever of the three is there.
    """
    lo, hi, mid = _col(lowest), _col(highest), _col(middle)
    if variant == "etl":
        return F.coalesce(mid, (lo + hi) / 2)
    if variant == "clean":
        zero = F.lit(0.0)
        total = F.coalesce(lo, zero) + F.coalesce(hi, zero) + F.coalesce(mid, zero)
        given = lo.isNotNull().cast("int") + hi.isNotNull().cast("int") + mid.isNotNull().cast("int")
        return F.try_divide(total, given)
    raise ValueError(f"variant must be 'etl' or 'clean', not {variant!r}")


def band(
    value: ColumnOrName,
    edges: Sequence[float],
    labels: Sequence[str],
    guard_nonpositive: bool = True,
    unknown: str = "Unknown",
) -> Column:
    """Left-closed bands: ``labels[i]`` holds values below ``edges[i]``, the last label the rest."""
    if len(labels) != len(edges) + 1:
        raise ValueError("one more label than edges is needed")
    c = _col(value)
    missing = c.isNull() | F.isnan(c.cast("double"))
    out = F.when(missing | (c <= 0) if guard_nonpositive else missing, F.lit(unknown))
    for edge, label in zip(edges, labels):
        out = out.when(c < edge, F.lit(label))
    return out.otherwise(F.lit(labels[-1]))


def safe_ratio(part: ColumnOrName, whole: ColumnOrName) -> Column:
    """part / whole, and 0 where either is missing or the whole is 0."""
    return F.coalesce(F.try_divide(_col(part).cast("double"), _col(whole).cast("double")), F.lit(0.0))


def engagement(views: ColumnOrName, applies: ColumnOrName, weight: int = 10) -> Column:
    return F.coalesce(_col(views), F.lit(0)) + F.coalesce(_col(applies), F.lit(0)) * F.lit(weight)


def experience_group(level: ColumnOrName) -> Column:
    """Folds case, so title-cased and raw masters get the same groups."""
    return map_values(level, EXPERIENCE_GROUPS, default="Unknown", fold_case=True)


def label_to_log1p(c: ColumnOrName) -> Column:
    return F.log1p(_col(c))


def label_from_expm1(c: ColumnOrName) -> Column:
    return F.expm1(_col(c))
