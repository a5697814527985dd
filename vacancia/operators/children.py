"""Child tables brought to the grain of their parent before any join."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vacancia.operators.keys import enrich, first_per_key


def child_count(df: DataFrame, key: str, col: str, name: str, distinct: bool = False) -> DataFrame:
    """How many children each parent has; ``distinct`` counts a repeated child once."""
    if distinct:
        pairs = df.na.drop(subset=[key, col]).select(key, col).distinct()
        return pairs.groupBy(key).agg(F.count(col).alias(name))
    return df.where(F.col(key).isNotNull()).groupBy(key).agg(F.count(col).alias(name))


def child_set(df: DataFrame, key: str, col: str, name: str) -> DataFrame:
    """Sorted distinct children per parent. Repeats go map-side; one output row holds one parent's set."""
    return df.where(F.col(key).isNotNull()).groupBy(key).agg(F.array_sort(F.collect_set(col)).alias(name))


def child_list(df: DataFrame, key: str, col: str, name: str, sep: str = ", ") -> DataFrame:
    """Sorted distinct children per parent as one text."""
    return child_set(df, key, col, name).withColumn(name, F.array_join(name, sep))


def primary_child(
    df: DataFrame, key: str, child: str, order: Sequence[str | Column], names: DataFrame, name_col: str
) -> DataFrame:
    """The first child of each parent with its name: (key, child, name)."""
    first = first_per_key(df.na.drop(subset=[key, child]), [key], order).select(key, child)
    return enrich(first, names, child, [name_col])
