"""Names and text predicates."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

# Club-type markers removed from a lower-cased name, in this order, wherever they occur.
NAME_MARKERS = (" fc", "fc ", " ca", "sc ")
# Characters trimmed from both ends of a name.
BLANKS = (
    " \t\n\x0b\x0c\r\x1c\x1d\x1e\x1f\x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004"
    "\u2005\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
)


def _column(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def clean_name(name: Column | str, markers: Sequence[str] = NAME_MARKERS) -> Column:
    """Comparison key of a name; a null name has the empty key."""
    key = F.lower(F.coalesce(_column(name), F.lit("")))
    for marker in markers:
        key = F.replace(key, F.lit(marker), F.lit(""))
    return F.trim(key, F.lit(BLANKS))


def contains_ci(text: Column | str, pattern: Column | str) -> Column:
    """Case-insensitive regular-expression search; false for a null text. A str pattern is a literal."""
    pattern = F.lit(pattern) if isinstance(pattern, str) else pattern
    found = F.rlike(_column(text), F.concat(F.lit("(?iu)"), pattern))
    return F.coalesce(found, F.lit(False))


def contains_literal(text: Column | str, part: str) -> Column:
    """LIKE '%part%' with every character of `part` taken as it is."""
    return _column(text).cast("string").contains(F.lit(part))


def blank_nulls(df: DataFrame) -> DataFrame:
    """Presentation copy: every column as text, nulls as ''."""
    return df.select(
        *(F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")).alias(c) for c in df.columns)
    )
