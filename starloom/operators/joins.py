"""Joins of the star schema.

Broadcast policy: a side is broadcast explicitly only when its size is
bounded by construction (a code-dictionary block) or checked by
:func:`bounded_broadcast`. Everything else is left to Catalyst and AQE,
which switches a sort-merge join to a broadcast join at runtime when the
measured side is small, and splits skewed partitions otherwise.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .project import quoted

# Largest lookup we broadcast after a size check: a code-dictionary block or a
# dimension of that order. Both the row count and the bytes are checked, so a
# few very wide rows cannot slip through; larger sides use a shuffle join.
BROADCAST_MAX_ROWS = 200_000
BROADCAST_MAX_BYTES = 64 * 1024 * 1024

_VARIABLE_WIDTH = (T.StringType, T.BinaryType)
_FIXED_WIDTH_BOUND = 16  # bytes; the widest fixed-width value is a 128-bit decimal


def _width(field: T.StructField):
    """Upper bound of a column's bytes in one row: actual bytes for strings
    and binaries, a fixed bound for everything else."""
    if isinstance(field.dataType, _VARIABLE_WIDTH):
        return F.coalesce(F.octet_length(F.col(f"`{field.name}`")), F.lit(0)).cast("long")
    return F.lit(_FIXED_WIDTH_BOUND).cast("long")


def bounded_broadcast(df: DataFrame, max_rows: int = BROADCAST_MAX_ROWS,
                      max_bytes: int = BROADCAST_MAX_BYTES) -> DataFrame:
    """``broadcast(df)`` if it has at most ``max_rows`` rows and ``max_bytes``
    bytes of data, else ``df``.

    One job reads at most ``max_rows + 1`` rows (it stops early on a large
    input) and sums their widths; nested columns fail the check.
    """
    if any(isinstance(f.dataType, (T.ArrayType, T.MapType, T.StructType)) for f in df.schema):
        return df
    width = sum((_width(f) for f in df.schema.fields), F.lit(0).cast("long"))
    # widths first, so the limit's single-partition exchange carries one long per row
    n, size = (df.select(width.alias("_w")).limit(max_rows + 1)
               .agg(F.count(F.lit(1)), F.sum("_w")).first())
    return F.broadcast(df) if n <= max_rows and (size or 0) <= max_bytes else df


def role_lookup(df: DataFrame, lookup: DataFrame, lookup_key: str, lookup_value: str,
                roles: Mapping[str, str], broadcast: bool = True) -> DataFrame:
    """Resolve several code columns through the same lookup (role-playing).

    ``roles`` maps a code column of ``df`` to the name of its label column;
    each role is one LEFT join, so unknown codes keep their row with NULL.
    """
    lk = lookup.select(F.col(lookup_key).alias("_k"), F.col(lookup_value).alias("_v"))
    if broadcast:
        lk = bounded_broadcast(lk)
    out = df
    for code_col, label_col in roles.items():
        role = lk.select(F.col("_k").alias(f"_k_{label_col}"), F.col("_v").alias(label_col))
        out = (out.join(role, out[code_col] == role[f"_k_{label_col}"], "left")
               .drop(f"_k_{label_col}"))
    return out


def conform(left: DataFrame, lookup: DataFrame, keys: Mapping[str, str],
            broadcast: bool = True) -> DataFrame:
    """Inner join by name columns (``{left_col: lookup_col}``).

    This is ``LEFT JOIN ... WHERE lookup_key IS NOT NULL`` written as what it
    is. One key (name only) or two (name and state) are the usual forms; a
    name shared by several lookup rows fans out, as in SQL.
    """
    lk = bounded_broadcast(lookup) if broadcast else lookup
    cond = None
    for lc, rc in keys.items():
        p = left[lc] == lk[rc]
        cond = p if cond is None else cond & p
    out = left.join(lk, cond, "inner")
    for rc in keys.values():  # equal to the left key by the join condition
        out = out.drop(lk[rc])
    return out


def cast_key_join(left: DataFrame, right: DataFrame, left_key: str, right_key: str,
                  key_type: str, how: str = "inner", broadcast: bool = True) -> DataFrame:
    """Join where the right key (a code lookup) is text holding the left
    key's type.

    The right key is converted once with ``try_cast`` (a code that is not a
    number becomes NULL and matches nothing) instead of casting per
    comparison or failing under ANSI mode. The lookup is broadcast if it
    passes the size check (rows and bytes).
    """
    r = right.withColumn("_jk", F.col(right_key).try_cast(key_type))
    if broadcast and how in ("inner", "left", "left_outer", "left_semi", "left_anti"):
        r = bounded_broadcast(r)
    return left.join(r, left[left_key] == r["_jk"], how).drop("_jk")


def star_join(fact: DataFrame, dims: Sequence[tuple[DataFrame, str, str]],
              how: str = "left") -> DataFrame:
    """Fact to several dimensions: ``[(dim, fact_key, dim_key), ...]``."""
    out = fact
    for dim, fk, dk in dims:
        out = out.join(dim, out[fk] == dim[dk], how)
    return out


# Most keys that a sketch of hot keys lists; each listed key holds more than a fair share
# of a shuffle partition, so there are fewer than shuffle partitions anyway.
HOT_KEYS_MAX = 100_000
SALTS_PER_SHARE = 16  # salts meet in a partition by chance; many small ones even that out
SKETCH_GROUPS = 256   # sketches of tasks are merged in so many groups first
_HOT_JOINS = ("inner", "left", "left_semi", "left_anti")


def _key_hash(df: DataFrame, keys: Sequence[str]) -> Column:
    """64-bit hash of a key, equal for whole numbers of any width; NULL if a part is NULL."""
    parts = []
    for k in keys:
        kind = df.schema[k].dataType
        if isinstance(kind, (T.FloatType, T.DoubleType, T.ArrayType, T.MapType, T.StructType)):
            raise ValueError(f"join key {k} of type {kind.simpleString()} cannot be split by hash")
        parts.append(quoted(k).cast("bigint") if isinstance(kind, T.IntegralType) else quoted(k))
    whole = reduce(lambda a, b: a & b, [quoted(k).isNotNull() for k in keys])
    return F.when(whole, F.xxhash64(*parts))


def hot_keys(df: DataFrame, keys: str | Sequence[str], shares: int | None = None) -> DataFrame:
    """``(key_hash, n_salts)`` of the keys that hold more than one of ``shares`` equal parts of
    the rows (by default the session's shuffle partitions), with ``SALTS_PER_SHARE`` salts
    for each part.

    One pass with a frequent-items sketch per task; the sketches are merged in two steps and
    no key is shuffled. The sketch never counts too low, so a key a little below its
    part may be listed, and only far rarer keys than listed ones can be missed. Fewer
    than ``shares`` rows or little more.
    """
    keys = [keys] if isinstance(keys, str) else list(keys)
    shares = shares or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    listed = min(shares, HOT_KEYS_MAX)
    tracked = max(10_000, 8 * listed)
    top = (df.select(_key_hash(df, keys).alias("_h")).where("_h IS NOT NULL")
           .withColumn("_g", F.pmod(F.spark_partition_id(), F.lit(SKETCH_GROUPS)))
           .groupBy("_g").agg(F.expr(f"approx_top_k_accumulate(_h, {tracked})").alias("sketch"),
                              F.count(F.lit(1)).alias("n"))
           .groupBy(F.lit("all"))  # no row without input, where combining would fail
           .agg(F.expr(f"approx_top_k_combine(sketch, {tracked})").alias("sketch"), F.sum("n").alias("n"))
           .select(F.explode(F.expr(f"approx_top_k_estimate(sketch, {listed})")).alias("x"), "n"))
    part = F.col("x.count") * F.lit(shares) / F.col("n")
    return (top.where(part > 1)
            .select(F.col("x.item").alias("key_hash"),
                    F.ceil(part * SALTS_PER_SHARE).cast("int").alias("n_salts")))


def hot_key_join(left: DataFrame, right: DataFrame, keys: Mapping[str, str],
                 spread_by: Sequence[str], how: str = "inner",
                 shares: int | None = None) -> DataFrame:
    """Equi-join ``{left_col: right_col}`` whose hot left keys are split over tasks.

    A hot key (:func:`hot_keys`) is dealt over salts in proportion to its rows and its right
    rows are copied to each of them; all other keys have one salt, so this is one shuffle
    join on (key, salt) and does not depend on AQE. With unique right keys the copies add
    up to about ``SALTS_PER_SHARE * shares`` rows at most; the list of hot keys, some
    ``shares`` rows of 12 bytes, is the only thing that is broadcast. Left rows with a
    NULL key, which match nothing, are dealt over all tasks.

    ``spread_by`` names left columns that differ within a key (a row id): the salt is their
    hash, so a task that runs again deals its rows as before. ``how`` is inner, left,
    left_semi or left_anti. The result has the rows and columns of
    ``left.join(right, keys equal, how)``; what the sketch finds changes the plan only.
    """
    if how not in _HOT_JOINS:
        raise ValueError(f"how must be one of {', '.join(_HOT_JOINS)}, not {how}")
    for lk, rk in keys.items():
        a, b = left.schema[lk].dataType, right.schema[rk].dataType
        if a != b and not (isinstance(a, T.IntegralType) and isinstance(b, T.IntegralType)):
            raise ValueError(f"join keys {lk} {a.simpleString()} and {rk} {b.simpleString()} "
                             "differ in type")
    shares = shares or int(left.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    hot = F.broadcast(hot_keys(left, list(keys), shares))
    dealt = F.pmod(F.xxhash64(*[quoted(c) for c in spread_by]),
                   F.when(F.col("_hash").isNull(), F.lit(SALTS_PER_SHARE * shares))
                   .otherwise(F.coalesce("n_salts", F.lit(1)))).cast("int")
    l = (left.withColumn("_hash", _key_hash(left, list(keys)))
         .join(hot, F.col("_hash") == F.col("key_hash"), "left")
         .withColumn("_salt", dealt).select(*[quoted(c) for c in left.columns], "_salt"))
    names = [f"_r{i}" for i in range(len(right.columns))]  # no clash with the left's
    r = (right.withColumn("_hash", _key_hash(right, list(keys.values())))
         .join(hot, F.col("_hash") == F.col("key_hash"), "left")
         .select(*[quoted(c).alias(n) for c, n in zip(right.columns, names)],
                 F.explode(F.sequence(F.lit(0), F.coalesce("n_salts", F.lit(1)) - 1)).alias("_copy")))
    at = dict(zip(right.columns, names))
    same = reduce(lambda a, b: a & b, [quoted(lk) == F.col(at[rk]) for lk, rk in keys.items()],
                  F.col("_salt") == F.col("_copy"))
    out = l.join(r, same, how).drop("_salt", "_copy")
    if how in ("inner", "left"):
        out = out.select(*[quoted(c) for c in left.columns],
                         *[F.col(n).alias(c) for c, n in zip(right.columns, names)])
    return out
