"""One row per key, semi and anti filters, lookups, enrichment.

Ranking windows here always keep the first few rows, so Spark drops the rest
before the shuffle: a hot key ships at most k rows from each map task.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def _order(order: Sequence[str | Column]) -> list[Column]:
    return [F.col(o) if isinstance(o, str) else o for o in order]


def first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column], k: int = 1) -> DataFrame:
    """The first ``k`` rows of every key in ``order``. Null keys equal each other."""
    rank = F.row_number().over(W.partitionBy(*keys).orderBy(*_order(order)))
    return df.withColumn("_rank", rank).where(F.col("_rank") <= k).drop("_rank")


def dedup_first(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column]) -> DataFrame:
    """Keep the first row per key. Files have no order on a cluster, so the order is named."""
    return first_per_key(df, keys, order)


def latest_per_key(df: DataFrame, keys: Sequence[str], ts: str, tie: Sequence[str | Column] = ()) -> DataFrame:
    """Keep the newest snapshot per key; rows without a key go."""
    return first_per_key(df.na.drop(subset=list(keys)), keys, [F.col(ts).desc_nulls_last(), *tie])


def best_per_key(df: DataFrame, keys: Sequence[str], metric: str, tie: Sequence[str | Column] = ()) -> DataFrame:
    """Keep the row with the highest metric per key, rows without one last."""
    return first_per_key(df, keys, [F.col(metric).desc_nulls_last(), *tie])


def top_k(df: DataFrame, by: Sequence[str | Column], k: int) -> DataFrame:
    return df.orderBy(*_order(by)).limit(k)


def top_bottom(df: DataFrame, col: str, n: int, tie: Sequence[str] = ()) -> DataFrame:
    """The n highest and the n lowest rows. A row in both halves shows twice, as in a head plus a tail."""
    high = top_k(df, [F.col(col).desc_nulls_last(), *tie], n)
    low = top_k(df, [F.col(col).asc_nulls_last(), *tie], n)
    return high.withColumn("side", F.lit("top")).unionByName(low.withColumn("side", F.lit("bottom")))


def argmax(df: DataFrame, what: str, metric: str) -> DataFrame:
    """The value of ``what`` where ``metric`` is highest; among equals the smallest."""
    best = df.where(F.col(metric).isNotNull())
    return top_k(best, [F.col(metric).desc(), F.col(what).asc()], 1).select(what, metric)


def select_available(df: DataFrame, cols: Sequence[str]) -> tuple[DataFrame, list[str]]:
    """The wanted columns that exist, and the names of those that do not."""
    have = set(df.columns)
    return df.select(*[c for c in cols if c in have]), [c for c in cols if c not in have]


def valid_salary(df: DataFrame, col: str = "normalized_salary", low: float | None = None, high: float | None = None):
    """Rows with a positive salary, within [low, high] if given."""
    df = df.where(F.col(col) > 0)
    return df if low is None or high is None else df.where(F.col(col).between(low, high))


def keep_known(child: DataFrame, parent: DataFrame, key: str, parent_key: str | None = None) -> DataFrame:
    """Child rows whose key the parent has."""
    p = parent.select(F.col(parent_key or key).alias("_p"))
    return child.join(p, child[key] == p["_p"], "left_semi")


def orphan_rows(
    child: DataFrame, key: str, parent: DataFrame, parent_key: str | None = None, null_is_invalid: bool = False
) -> DataFrame:
    """Child rows whose key the parent lacks. Null keys count only if ``null_is_invalid``."""
    p = parent.select(F.col(parent_key or key).alias("_p"))
    c = child if null_is_invalid else child.where(F.col(key).isNotNull())
    return c.join(p, c[key] == p["_p"], "left_anti")


def invalid_keys(child: DataFrame, key: str, parent: DataFrame, parent_key: str | None = None) -> DataFrame:
    """Distinct keys of the child that the parent lacks."""
    c = child.select(F.col(key)).where(F.col(key).isNotNull())
    return c.subtract(parent.select(F.col(parent_key or key).alias(key)))


def lookup(df: DataFrame, key: str, dim: DataFrame, value: str, default=None, dim_key: str | None = None, name=None):
    """Adds one value found by id. ``dim`` has one row per id."""
    side = dim.select(F.col(dim_key or key).alias("_lk"), F.col(value).alias("_lv"))
    joined = df.join(side, df[key] == side["_lk"], "left").drop("_lk")
    found = F.col("_lv") if default is None else F.coalesce(F.col("_lv"), F.lit(default))
    return joined.withColumn(name or value, found).drop("_lv")


def enrich(
    fact: DataFrame,
    dim: DataFrame,
    on: str,
    cols: Sequence[str],
    suffix: str = "",
    fills: Mapping[str, object] | None = None,
    salt: int = 0,
) -> DataFrame:
    """Left-join columns of a table with one row per key; the fact's row count stays.

    Columns that clash get ``suffix``. Which side is broadcast is left to Spark, which
    measures it; a hot key (nulls are one too) is split by its skew join. ``salt`` > 1
    splits every key into that many parts instead, for sessions that run without it.
    """
    taken = set(fact.columns)
    clash = [c for c in cols if c in taken]
    if clash and not suffix:
        raise ValueError(f"columns {clash} exist already, give a suffix")
    renamed = {c: c + suffix if c in taken else c for c in cols}
    side = dim.select(F.col(on).alias("_on"), *(F.col(c).alias(n) for c, n in renamed.items()))
    if salt > 1:
        side = side.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salt - 1))))
        left = fact.withColumn("_s", F.pmod(F.xxhash64(*fact.columns), F.lit(salt)).cast("int"))
        out = left.join(side, (F.col(on) == F.col("_on")) & (F.col("_s") == F.col("_salt")), "left")
        out = out.drop("_on", "_s", "_salt")
    else:
        out = fact.join(side, fact[on] == side["_on"], "left").drop("_on")
    if fills:
        out = out.withColumns({c: F.coalesce(F.col(c), F.lit(v)) for c, v in fills.items()})
    return out


def add_unknown_member(dim: DataFrame, values: Mapping[str, object]) -> DataFrame:
    """Append one row; columns not named are null. Types follow the table."""
    types = dict(dim.dtypes)
    extra = [c for c in values if c not in types]
    row = dim.sparkSession.range(1).select(
        *(F.lit(v).cast(types[c]).alias(c) if c in types else F.lit(v).alias(c) for c, v in values.items())
    )
    out = dim.unionByName(row, allowMissingColumns=True)
    return out.select(*dim.columns, *extra)


def dim_from_fact(fact: DataFrame, key: str, cols: Sequence[str]) -> DataFrame:
    """Re-derive a dimension where its source is gone: the smallest row of each key."""
    rest = [c for c in cols if c != key]
    return dedup_first(fact.select(key, *rest).where(F.col(key).isNotNull()), [key], rest)
