"""Column expressions. Nothing here leaves the JVM."""

from vacancia.functions.cleaning import (
    as_category,
    code_clean,
    contains_text,
    epoch_ms,
    fill,
    flag,
    half_even,
    listed_date,
    listed_month,
    map_values,
    not_nan,
    text_length,
    title_clean,
    to_number,
)
from vacancia.functions.measures import (
    annualize,
    band,
    engagement,
    experience_group,
    label_from_expm1,
    label_to_log1p,
    safe_ratio,
    salary_mid,
)

__all__ = [
    "annualize",
    "as_category",
    "band",
    "code_clean",
    "contains_text",
    "engagement",
    "epoch_ms",
    "experience_group",
    "fill",
    "flag",
    "half_even",
    "label_from_expm1",
    "label_to_log1p",
    "listed_date",
    "listed_month",
    "map_values",
    "not_nan",
    "safe_ratio",
    "salary_mid",
    "text_length",
    "title_clean",
    "to_number",
]
