"""Cleaning of single values: text, codes, numbers, timestamps, flags."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnOrName = Column | str

# The characters a text strip removes.
BLANKS = " \t\n\r\x0b\x0c"


def _col(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


def not_nan(c: ColumnOrName) -> Column:
    """NaN is a value to Spark and a gap to the readers of these tables: make it null."""
    return F.nanvl(_col(c), F.lit(None).cast("double"))


def literal_map(mapping: Mapping) -> Column:
    """A small constant map; a look-up names its key once, where a chain of tests would repeat it."""
    return F.create_map(*(F.lit(x) for pair in mapping.items() for x in pair))


def title_clean(c: ColumnOrName, missing: str = "Nan") -> Column:
    """Strip, then upper-case the first letter of every run of letters; the text ``Nan`` is missing.

    ``initcap`` splits on blanks only, so ``full-time`` would become ``Full-time``.
    """
    runs = F.regexp_extract_all(
        F.btrim(_col(c), F.lit(BLANKS)), F.lit(r"([\p{Lu}\p{Ll}\p{Lt}]+|[^\p{Lu}\p{Ll}\p{Lt}]+)"), F.lit(1)
    )
    titled = F.array_join(
        F.transform(runs, lambda r: F.concat(F.upper(F.substring(r, 1, 1)), F.lower(F.substr(r, F.lit(2))))), ""
    )
    return F.nullif(titled, F.lit(missing))


def code_clean(c: ColumnOrName) -> Column:
    return F.upper(F.btrim(_col(c), F.lit(BLANKS)))


def to_number(c: ColumnOrName) -> Column:
    """Number, or null where the text is none."""
    return not_nan(_col(c).try_cast("double"))


def epoch_ms(c: ColumnOrName) -> Column:
    """Epoch milliseconds (number or numeric text) to a timestamp."""
    return F.timestamp_millis(_col(c).try_cast("double").cast("long"))


def listed_date(ts: ColumnOrName) -> Column:
    return F.to_date(_col(ts))


def listed_month(ts: ColumnOrName) -> Column:
    return F.date_format(_col(ts), "yyyy-MM")


def flag(c: ColumnOrName) -> Column:
    """Nullable number or boolean to 0/1."""
    return F.coalesce(_col(c).cast("int"), F.lit(0))


def text_length(c: ColumnOrName) -> Column:
    return F.length(F.coalesce(_col(c), F.lit("")))


def fill(c: ColumnOrName, value) -> Column:
    return F.coalesce(_col(c), F.lit(value))


def as_category(c: ColumnOrName, unknown: str = "Unknown") -> Column:
    """Category text for an encoder. Booleans become 0/1 first, so both spellings meet."""
    c = _col(c)
    text = F.when(c.cast("string") == "true", "1").when(c.cast("string") == "false", "0").otherwise(c.cast("string"))
    return F.when(text.isNull() | F.lower(text).isin("nan", "none"), F.lit(unknown)).otherwise(text)


def map_values(c: ColumnOrName, mapping: Mapping[str, str], default=None, fold_case: bool = False) -> Column:
    """Look the value up among a few literals; what is not there gets ``default``."""
    if not mapping:
        return F.lit(default)
    key = F.lower(_col(c)) if fold_case else _col(c)
    found = literal_map({k.lower() if fold_case else k: v for k, v in mapping.items()})[key]
    return found if default is None else F.coalesce(found, F.lit(default))


def half_even(c: ColumnOrName, digits: int) -> Column:
    """Rounding that sends exact halves to the even digit."""
    return F.bround(_col(c), digits)


def contains_text(c: ColumnOrName, pattern: str, literal: bool = False) -> Column:
    """Case-insensitive pattern search; a missing value does not match."""
    c = _col(c)
    hit = F.contains(F.lower(c), F.lit(pattern.lower())) if literal else F.rlike(c, F.lit("(?iu)" + pattern))
    return F.coalesce(hit, F.lit(False))

