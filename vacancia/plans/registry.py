"""Named queries over the test tables, each with its SQL twin where there is one."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

Run = Callable[[SparkSession, str], DataFrame]


@dataclass(frozen=True)
class Query:
    run: Run
    survey: str
    oracle: str | None


CATALOG: dict[str, Query] = {}


def query(name: str, survey: str, oracle: str | None = None) -> Callable[[Run], Run]:
    """Register a query under ``name``; ``survey`` lists the inventory ids it shows."""

    def add(run: Run) -> Run:
        if name in CATALOG:
            raise ValueError(f"{name} is registered already")
        CATALOG[name] = Query(run, survey, oracle)
        return run

    return add


def rounded(df: DataFrame, digits: int = 4) -> DataFrame:
    """Doubles at a fixed number of digits, so that two engines can be compared by value."""
    cols = {c: F.round(F.col(c), digits) for c, t in df.dtypes if t in ("double", "float")}
    return df.withColumns(cols) if cols else df


def with_(*parts: str, select: str) -> str:
    return "WITH " + ",\n".join(parts) + "\n" + select
