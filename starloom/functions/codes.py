"""Coded columns: fixed code maps, region codes, widths and casing."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

# Visa categories of the arrivals data (code -> label).
VISA_CATEGORIES = {1: "Business", 2: "Pleasure", 3: "Student"}

# Fixed value: a state code is the two word characters after the first
# "xx-" of an ISO region such as "US-CA"; no match gives NULL.
REGION_STATE_PATTERN = r"\w{2}-(\w{2})"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def code_label(code: Column | str, mapping: Mapping = VISA_CATEGORIES) -> Column:
    """Map a small fixed code set to labels; unknown or NULL codes give NULL.

    Numeric keys compare numerically, so a DOUBLE ``1.0`` matches key ``1``.
    Large or data-driven maps belong in a lookup table and a join instead.
    """
    c = _col(code)
    numeric = all(isinstance(k, (int, float)) for k in mapping)
    probe = c.cast("double") if numeric else c.cast("string")
    expr = None
    for key, label in mapping.items():
        cond = probe == (F.lit(float(key)) if numeric else F.lit(str(key)))
        expr = F.when(cond, F.lit(label)) if expr is None else expr.when(cond, F.lit(label))
    return expr if expr is not None else F.lit(None).cast("string")


def region_state(region: Column | str) -> Column:
    """ISO region ``US-CA`` -> ``CA``; NULL when the pattern does not occur."""
    return F.nullif(F.regexp_extract(_col(region), REGION_STATE_PATTERN, 1), F.lit(""))


def upper_name(c: Column | str) -> Column:
    """Upper-case a name column (city and state names are compared upper-cased)."""
    return F.upper(_col(c))


def char_cast(c: Column | str, width: int | None = None) -> Column:
    """``CAST(x AS CHAR(n))`` as Spark 4 evaluates it in a query: a string.

    With ``width`` the value is cut to ``width`` characters (no padding).
    """
    s = _col(c).cast("string")
    return F.substring(s, 1, width) if width else s
