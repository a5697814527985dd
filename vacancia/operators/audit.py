"""Data quality: profiles, duplicates, referential integrity, export checks."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from vacancia.operators.keys import orphan_rows


def _is_missing(df: DataFrame, c: str) -> Column:
    missing = F.col(c).isNull()
    return missing | F.isnan(c) if dict(df.dtypes)[c] in ("double", "float") else missing


def full_row_dups(df: DataFrame, name: str = "table") -> DataFrame:
    """How many rows repeat an earlier one in every column."""
    counted = df.groupBy(*df.columns).agg(F.count("*").alias("_c"))
    return counted.agg(F.coalesce(F.sum(F.col("_c") - 1), F.lit(0)).alias("full_row_duplicates")).select(
        F.lit(name).alias("table_name"), "full_row_duplicates"
    )


def column_profile(df: DataFrame, name: str, full_dups: bool = False) -> DataFrame:
    """One row per column: rows, columns, type, missing count and share. One scan, one aggregate row."""
    counts = df.agg(
        F.count("*").alias("_n"),
        *(F.count(F.when(_is_missing(df, c), 1)).alias(f"_m{i}") for i, c in enumerate(df.columns)),
    )
    entries = [
        F.struct(F.lit(c).alias("column_name"), F.lit(t).alias("dtype"), F.col(f"_m{i}").alias("missing_count"))
        for i, (c, t) in enumerate(df.dtypes)
    ]
    out = counts.select("_n", F.explode(F.array(*entries)).alias("e")).select(
        F.lit(name).alias("table_name"),
        F.col("e.column_name"),
        F.col("_n").alias("n_rows"),
        F.lit(len(df.columns)).cast("long").alias("n_cols"),
        F.col("e.dtype"),
        F.col("e.missing_count"),
        F.coalesce(F.try_divide(F.col("e.missing_count"), F.col("_n")), F.lit(0.0)).alias("missing_pct"),
    )
    if full_dups:
        out = out.withColumn("full_row_duplicates", full_row_dups(df).select("full_row_duplicates").scalar())
    return out


def profile_tables(tables: Mapping[str, DataFrame], full_dups: bool = False) -> DataFrame:
    return reduce(DataFrame.unionByName, (column_profile(df, n, full_dups) for n, df in tables.items()))


def missing_summary(profiles: DataFrame) -> DataFrame:
    """Per table: mean missing share and how many columns have gaps; the worst first."""
    return (
        profiles.groupBy("table_name")
        .agg(
            F.max("n_rows").alias("total_rows"),
            F.avg("missing_pct").alias("avg_missing_pct"),
            F.count(F.when(F.col("missing_count") > 0, 1)).alias("cols_with_missing"),
        )
        .orderBy(F.desc("avg_missing_pct"), "table_name")
    )


def key_dups(df: DataFrame, keys: Sequence[str], name: str) -> DataFrame:
    """Rows beyond the first of their key. Null keys equal each other."""
    counted = df.groupBy(*keys).agg(F.count("*").alias("_c"))
    return counted.agg(
        F.coalesce(F.sum("_c"), F.lit(0)).alias("total_rows"),
        F.coalesce(F.sum(F.col("_c") - 1), F.lit(0)).alias("key_duplicates"),
    ).select(
        F.lit(name).alias("table_name"),
        F.lit(", ".join(keys)).alias("key_columns"),
        "total_rows",
        "key_duplicates",
        F.coalesce(F.try_divide(F.col("key_duplicates"), F.col("total_rows")), F.lit(0.0)).alias("duplicate_pct"),
    )


def key_dup_report(tables: Mapping[str, DataFrame], keys: Mapping[str, Sequence[str]]) -> DataFrame:
    return reduce(DataFrame.unionByName, (key_dups(tables[t], k, t) for t, k in keys.items() if t in tables))


def orphans(
    child: DataFrame,
    child_key: str,
    parent: DataFrame,
    parent_key: str,
    null_is_invalid: bool = False,
    names: tuple[str, str] = ("child", "parent"),
) -> DataFrame:
    """How many child rows point nowhere, and their share of all child rows.

    The child is cut to counts per key first, so a hot key joins as one row.
    """
    per_key = child.groupBy(F.col(child_key).alias("_key")).agg(F.count("*").alias("_c"))
    known = parent.select(F.col(parent_key).alias("_p")).where(F.col("_p").isNotNull()).distinct()
    checked = per_key.join(known, F.col("_key") == F.col("_p"), "left")
    bad = F.col("_p").isNull() if null_is_invalid else F.col("_p").isNull() & F.col("_key").isNotNull()
    return checked.agg(
        F.coalesce(F.sum(F.when(bad, F.col("_c"))), F.lit(0)).alias("invalid_records_count"),
        F.coalesce(F.sum("_c"), F.lit(0)).alias("_n"),
    ).select(
        F.lit(names[0]).alias("child_table"),
        F.lit(child_key).alias("child_key"),
        F.lit(names[1]).alias("parent_table"),
        F.lit(parent_key).alias("parent_key"),
        "invalid_records_count",
        F.coalesce(F.try_divide(F.col("invalid_records_count"), F.col("_n")), F.lit(0.0)).alias(
            "invalid_records_pct"
        ),
    )


def integrity_report(
    tables: Mapping[str, DataFrame], checks: Sequence[tuple[str, str, str, str]], null_is_invalid: bool = False
) -> DataFrame:
    """``checks`` holds (child, child key, parent, parent key); pairs with a missing table are left out."""
    found = [c for c in checks if c[0] in tables and c[2] in tables]
    return reduce(
        DataFrame.unionByName,
        (orphans(tables[c], ck, tables[p], pk, null_is_invalid, (c, p)) for c, ck, p, pk in found),
    )


def _check(name: str, df: DataFrame, value: Column, ok: Column | None = None) -> DataFrame:
    out = df.agg(value.cast("long").alias("value"))
    return out.select(
        F.lit(name).alias("check_name"), "value", (ok if ok is not None else F.col("value") == 0).alias("ok")
    )


def validate_star(
    fact: DataFrame,
    calendar: DataFrame,
    bridges: Mapping[str, DataFrame],
    foreign_keys: Sequence[str] = ("company_id", "primary_industry_id"),
    key: str = "job_id",
) -> DataFrame:
    """Checks after an export: no null foreign key, no bridge orphan, no day missing from the calendar."""
    nulls = [_check(f"null_{k}", fact, F.count(F.when(F.col(k).isNull(), 1))) for k in foreign_keys]
    loose = [_check(f"{n}_orphans", orphan_rows(b, key, fact), F.count("*")) for n, b in bridges.items()]
    span = F.datediff(F.max("date"), F.min("date")) + 1
    days = calendar.agg(F.count("*").alias("value"), F.coalesce(span, F.lit(0)).alias("_span")).select(
        F.lit("calendar_days").alias("check_name"), "value", (F.col("value") == F.col("_span")).alias("ok")
    )
    return reduce(DataFrame.unionByName, [*nulls, *loose, days])


def step_report(steps: Sequence[tuple[str, DataFrame, DataFrame, str]]) -> DataFrame:
    """Rows in and out of every build step: (step, before, after, note). One plan; equal scans are shared."""

    def line(i: int, step: str, before: DataFrame, after: DataFrame, note: str) -> DataFrame:
        rows_in = before.agg(F.count("*").alias("rows_in"))
        rows_out = after.agg(F.count("*").alias("rows_out"))
        return rows_out.select(
            F.lit(i).alias("step_no"),
            F.lit(step).alias("step"),
            rows_in.scalar().alias("rows_in"),
            "rows_out",
            F.lit(note).alias("note"),
        )

    return reduce(DataFrame.unionByName, (line(i, *s) for i, s in enumerate(steps, 1)))


class StepCounts:
    """Row counts at marked places of a plan, taken while the plan runs: no step is run twice for its report.

    ``at`` marks a place, ``report`` makes (step_no, step, rows_in, rows_out, note) of two marks per step. It needs an
    action over the marked plan first. A place that the optimizer took out of the plan (it does so with
    a side that turns out empty) is counted by itself.
    """

    def __init__(self) -> None:
        self._marks: dict[str, tuple[DataFrame, Observation]] = {}

    def at(self, mark: str, df: DataFrame) -> DataFrame:
        seen = Observation()
        self._marks[mark] = df, seen
        return df.observe(seen, F.count(F.lit(1)).alias("n"))

    def count(self, mark: str) -> int:
        df, seen = self._marks[mark]
        try:
            return seen.get["n"]
        except Py4JJavaError:  # no count was taken here, which PySpark cannot hand over
            return df.count()

    def report(self, steps: Sequence[tuple[str, str, str, str]]) -> DataFrame:
        """``steps``: (step, mark before, mark after, note)."""
        n = {m: self.count(m) for m in {m for _, before, after, _ in steps for m in (before, after)}}
        rows = [(i, step, n[before], n[after], note) for i, (step, before, after, note) in enumerate(steps, 1)]
        spark = next(iter(self._marks.values()))[0].sparkSession
        return spark.createDataFrame(rows, "step_no int, step string, rows_in long, rows_out long, note string")
