"""Projections, renames and casts."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def quoted(name: str) -> Column:
    """Column whose name holds blanks, dots or hyphens (``Median Age``)."""
    return F.col("`" + name.replace("`", "``") + "`")


def rename(df: DataFrame, mapping: Mapping[str, str]) -> DataFrame:
    """Keep only ``mapping``'s columns, renamed (source -> target), in order."""
    return df.select([quoted(src).alias(dst) for src, dst in mapping.items()])


def cast_columns(df: DataFrame, casts: Mapping[str, tuple[str, str]],
                 lenient: bool = True) -> DataFrame:
    """``{source: (type, target)}``; lenient casts give NULL where a value does
    not fit the type instead of failing the job (ANSI mode raises)."""
    cols = []
    for src, (typ, dst) in casts.items():
        c = quoted(src)
        cols.append((c.try_cast(typ) if lenient else c.cast(typ)).alias(dst))
    return df.select(cols)


def select_star(df: DataFrame) -> DataFrame:
    """``SELECT *``: every column, unchanged."""
    return df.select("*")


def as_map(pairs: Mapping[str, Column]) -> Column:
    """``map('k1', v1, 'k2', v2 ...)`` with string values."""
    args = []
    for k, v in pairs.items():
        args += [F.lit(k), v.cast("string")]
    return F.create_map(*args)


def map_element(m: Column | str, key: str) -> Column:
    """``m[key]``; NULL when the key is absent."""
    m = F.col(m) if isinstance(m, str) else m
    return F.element_at(m, F.lit(key))
