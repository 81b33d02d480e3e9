"""Column expressions used by several stages. All of them compile to built-in Spark expressions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from factorspark.params import WINSOR_LIMIT

__all__ = [
    "DATE_FORMATS",
    "clean_ticker",
    "growth",
    "is_weekday",
    "month_index",
    "parse_date",
    "parse_number",
    "ratio",
    "significant",
    "span_within",
    "winsorised",
]


def ratio(num: Column, den: Column) -> Column:
    """``num / den`` with NULL instead of an error when the denominator is zero."""
    return F.try_divide(num, den)


def growth(end: Column, start: Column) -> Column:
    """Simple return from ``start`` to ``end``."""
    return ratio(end, start) - F.lit(1.0)


def month_index(day: Column) -> Column:
    """Consecutive integer per calendar month."""
    return (F.year(day) * 12 + F.month(day)).cast("int")


def span_within(start: Column, end: Column, limits: tuple[int, int]) -> Column:
    """True when ``end - start`` in days lies inside ``limits`` (inclusive)."""
    return F.datediff(end, start).between(*limits)


def is_weekday(day: Column) -> Column:
    return F.weekday(day) < 5


def winsorised(z: Column, limit: float = WINSOR_LIMIT) -> Column:
    """Clamp to +/- ``limit``. A NULL must be filtered first: least/greatest would skip it."""
    return F.least(F.greatest(z, F.lit(-limit)), F.lit(limit))


def significant(x: Column, digits: int = 10) -> Column:
    """Round a double to ``digits`` significant digits; NULL, NaN and infinity stay."""
    finite = x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))
    return F.when(finite, F.format_string(f"%.{digits - 1}e", x).try_cast("double")).otherwise(x)


# --- lenient parsing of raw input -------------------------------------------------------------

# The Unicode whitespace that is stripped from tickers, the characters a decimal
# number may consist of, and the spelling of infinity.
_SPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005"
    "\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
)
_DECIMAL = r"^[0-9eE.+\-\s]+$"
_INFINITY = r"(?i)^\s*[+-]?inf(inity)?\s*$"


def clean_ticker(col: Column) -> Column:
    return F.upper(F.btrim(col.cast("string"), F.lit(_SPACE)))


# Text dates besides ISO that are read unless other formats are asked for: no two fit the same text.
DATE_FORMATS = ("yyyyMMdd", "yyyy/M/d", "MMM d, yyyy", "d MMM yyyy", "d-MMM-yyyy")


def parse_date(col: Column, dtype: str, formats: Sequence[str] = DATE_FORMATS) -> Column:
    """Date part of a date, timestamp or text column; anything else becomes NULL.

    Text is ISO, with or without a time, or in the first of ``formats`` that fits. A timestamp with
    time zone gives its date in the session's zone; one without gives its own."""
    if dtype == "date":
        return col
    if dtype.startswith("timestamp"):
        return F.to_date(col)
    if dtype == "string":
        # eight digits are a date in one format, not a year of eight digits
        digits = col.rlike(r"^\s*\d{5,}\s*$")
        # without time zone: the wall-clock date in the text is kept, whatever the session zone
        iso = F.when(~digits, col.try_cast("timestamp_ntz").cast("date"))
        text = F.btrim(col, F.lit(_SPACE))
        return F.coalesce(iso, *[F.try_to_date(text, f) for f in formats])
    return F.lit(None).cast("date")


def parse_number(col: Column, dtype: str) -> Column:
    """Double from a numeric or text column; text that is no number, and NaN, become NULL."""
    if dtype == "string":
        # the pattern keeps out spellings that only Java knows, such as "1.5d" and "0x1p3"
        numeric = F.when(col.rlike(_DECIMAL) | col.rlike(_INFINITY), col.try_cast("double"))
    elif dtype in ("date", "binary") or dtype.startswith(("timestamp", "array", "map", "struct")):
        return F.lit(None).cast("double")
    else:
        numeric = col.cast("double")
    return F.when(~F.isnan(numeric), numeric)
