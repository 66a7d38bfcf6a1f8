"""Aggregates, group-wise maxima and de-duplication.

Everything here aggregates with map-side partial aggregation, so a group
that holds a large share of the rows is reduced on every map task before
the shuffle instead of arriving whole at one reducer. Per-key windows
(which sort a whole group inside one task) are avoided for that reason.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .project import quoted


def _names(cols: str | Sequence[str]) -> list[str]:
    return [cols] if isinstance(cols, str) else list(cols)


def group_max(df: DataFrame, keys: str | Sequence[str], measure: str,
              alias: str | None = None) -> DataFrame:
    """``MAX(measure)`` per group (partial aggregation before the shuffle)."""
    keys = _names(keys)
    return df.groupBy(*[quoted(k) for k in keys]).agg(
        F.max(quoted(measure)).alias(alias or measure))


def rows_at_group_max(df: DataFrame, keys: str | Sequence[str], measure: str) -> DataFrame:
    """Rows whose ``measure`` equals the maximum of their group; ties kept.

    Same result as joining a table to its own ``GROUP BY ... MAX``: rows with
    a NULL key or a NULL measure are not returned. Built as a partial
    aggregate plus a left-semi join on ``(keys, measure)``, so a hot group
    is neither sorted in one task nor duplicated; AQE broadcasts the
    per-group maxima when they are small.
    """
    keys = _names(keys)
    mx = "__group_max"
    maxima = (df.groupBy(*[quoted(k) for k in keys])
              .agg(F.max(quoted(measure)).alias(mx)))
    cond = None
    for k in keys:
        p = df[k] == maxima[k]
        cond = p if cond is None else cond & p
    cond = cond & (df[measure] == maxima[mx])
    return df.join(maxima, cond, "left_semi")


def group_count(df: DataFrame, keys: str | Sequence[str], column: str | None = None,
                alias: str = "n") -> DataFrame:
    """``COUNT(column)`` (non-NULL values) or ``COUNT(*)`` per group."""
    keys = _names(keys)
    agg = F.count(quoted(column)) if column else F.count(F.lit(1))
    return df.groupBy(*[quoted(k) for k in keys]).agg(agg.alias(alias))


def distinct_projection(df: DataFrame, columns: Sequence[str | Column]) -> DataFrame:
    """``SELECT DISTINCT columns`` (partial aggregation before the shuffle)."""
    cols = [quoted(c) if isinstance(c, str) else c for c in columns]
    return df.select(cols).distinct()


def first_by_key(df: DataFrame, keys: str | Sequence[str],
                 order: Sequence[str | Column], descending: bool = False) -> DataFrame:
    """One row per key: the first in ``order`` (or the last if ``descending``).

    Deterministic: remaining ties are broken by the other column values.
    Evaluated as ``min``/``max`` of a struct ``(order..., row)`` per key, an
    aggregate with map-side partial aggregation, so a hot key costs one row
    per map task in the shuffle. NULL order values sort first ascending and
    last descending.
    """
    keys = _names(keys)
    order_cols = [quoted(c) if isinstance(c, str) else c for c in order]
    rest = [c for c in df.columns if c not in keys]
    packed = F.struct(*[c.alias(f"_o{i}") for i, c in enumerate(order_cols)],
                      F.struct(*[quoted(c) for c in rest]).alias("_row"))
    pick = F.max(packed) if descending else F.min(packed)
    return (df.groupBy(*[quoted(k) for k in keys]).agg(pick.alias("_best"))
            .select(*[quoted(k) for k in keys], "_best._row.*")
            .select(*[quoted(c) for c in df.columns]))
