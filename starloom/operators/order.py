"""Sorting, top-k and previews.

``orderBy(...).limit(k)`` plans as ``TakeOrderedAndProject``: each task keeps
a k-row heap and only k rows per task reach the final merge, so a top-k
never sorts or shuffles the whole input. Ties are broken by extra keys so
the answer is defined.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame

from .project import quoted


def _c(c: str | Column) -> Column:
    return quoted(c) if isinstance(c, str) else c


def top_k(df: DataFrame, k: int, by: str | Column, tie_breakers: Sequence[str | Column] = ()
          ) -> DataFrame:
    """The ``k`` rows with the largest ``by`` (NULLs last), ties by ascending
    ``tie_breakers``."""
    order = [_c(by).desc_nulls_last()] + [_c(t).asc_nulls_last() for t in tie_breakers]
    return df.orderBy(*order).limit(k)


def preview(df: DataFrame, n: int, keys: Sequence[str | Column]) -> DataFrame:
    """First ``n`` rows in key order (a defined answer, unlike bare limit)."""
    return df.orderBy(*[_c(k).asc_nulls_last() for k in keys]).limit(n)


def sorted_distinct(df: DataFrame, columns: Sequence[str], order: Sequence[str]) -> DataFrame:
    """``SELECT DISTINCT ... ORDER BY ...`` (range-partitioned global sort)."""
    return df.select([quoted(c) for c in columns]).distinct().orderBy(
        *[quoted(c).asc_nulls_first() for c in order])


def clustered_for_write(df: DataFrame, keys: Sequence[str], partitions: int | None = None
                        ) -> DataFrame:
    """Range-partition by ``keys`` and sort inside partitions: files come out
    ordered and non-overlapping without one global sort task. Without
    ``partitions`` AQE merges small ranges, so the file count follows the data."""
    cols = [quoted(k) for k in keys]
    ranged = df.repartitionByRange(partitions, *cols) if partitions else df.repartitionByRange(*cols)
    return ranged.sortWithinPartitions(*cols)
