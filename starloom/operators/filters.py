"""Row filters. Written as plain predicates so Catalyst pushes them into
the Parquet scan (``PushedFilters``)."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .project import quoted


def where_equal(df: DataFrame, column: str, value) -> DataFrame:
    """``column = value``; pushed into the Parquet scan."""
    return df.where(quoted(column) == F.lit(value))


def require_columns(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    """Keep rows where every listed column is non-NULL.

    Unlike ``dropna`` this keeps NaN values, which are not missing.
    """
    cond = None
    for c in columns:
        p = quoted(c).isNotNull()
        cond = p if cond is None else cond & p
    return df if cond is None else df.where(cond)
