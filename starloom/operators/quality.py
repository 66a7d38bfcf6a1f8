"""Data-quality checks as Spark jobs.

Each check returns a small DataFrame of findings (one row per table,
column or relation); :func:`raise_on_failure` turns failed rows into an
exception. Key checks aggregate keys first (partial aggregation), so a
hot key value is collapsed before any shuffle or join.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .project import quoted


def dq_schema(spark: SparkSession,
              tables: Mapping[str, tuple[DataFrame, T.StructType]]) -> DataFrame:
    """Compare each table's columns with its declared model, over the data.

    Rows ``(table_name, column_name, expected_type, actual_type, n_values, ok)``; a
    column missing on either side has a NULL type, ``n_values`` counts the
    values that the scan could read as the actual type. One aggregate per table.
    """
    parts = []
    for name, (df, expected) in tables.items():
        actual = {f.name: f.dataType.simpleString() for f in df.schema.fields}
        wanted = {f.name: f.dataType.simpleString() for f in expected.fields}
        cols = list(wanted) + [c for c in actual if c not in wanted]
        counts = df.agg(*[(F.count(quoted(c)) if c in actual else F.count(F.lit(None)))
                          .alias(f"n{i}") for i, c in enumerate(cols)])
        rows = F.explode(F.array(*[F.struct(
            F.lit(c).alias("column_name"), F.lit(wanted.get(c)).cast("string").alias("expected_type"),
            F.lit(actual.get(c)).cast("string").alias("actual_type"),
            F.col(f"n{i}").alias("n_values")) for i, c in enumerate(cols)]))
        parts.append(counts.select(F.lit(name).alias("table_name"), rows.alias("r"))
                     .select("table_name", "r.*"))
    return reduce(DataFrame.unionByName, parts).withColumn(
        "ok", F.coalesce(F.col("expected_type") == F.col("actual_type"), F.lit(False)))


def dq_non_empty(tables: Mapping[str, DataFrame]) -> DataFrame:
    """``(table_name, n_rows, ok)`` for every table; ok means ``n_rows > 0``."""
    parts = [df.agg(F.count(F.lit(1)).alias("n_rows"))
             .select(F.lit(name).alias("table_name"), "n_rows")
             for name, df in tables.items()]
    return reduce(DataFrame.unionByName, parts).withColumn("ok", F.col("n_rows") > 0)


def dq_pk_unique(df: DataFrame, keys: str | Sequence[str], table_name: str) -> DataFrame:
    """One row: ``(table_name, key_columns, n_rows, n_null_keys, n_keys,
    n_duplicate_keys, ok)``; ok when no key is NULL or repeated."""
    keys = [keys] if isinstance(keys, str) else list(keys)
    any_null = reduce(lambda a, b: a | b, [quoted(k).isNull() for k in keys])
    per_key = (df.groupBy(*[quoted(k) for k in keys])
               .agg(F.count(F.lit(1)).alias("c"),
                    F.max(any_null.cast("int")).alias("null_key")))
    return (per_key.agg(
        F.coalesce(F.sum("c"), F.lit(0)).cast("bigint").alias("n_rows"),
        F.coalesce(F.sum(F.when(F.col("null_key") == 1, F.col("c"))), F.lit(0))
        .cast("bigint").alias("n_null_keys"),
        F.count(F.lit(1)).alias("n_keys"),
        F.count(F.when(F.col("c") > 1, True)).alias("n_duplicate_keys"))
        .select(F.lit(table_name).alias("table_name"),
                F.lit(",".join(keys)).alias("key_columns"), "*")
        .withColumn("ok", (F.col("n_null_keys") == 0) & (F.col("n_duplicate_keys") == 0)))


def dq_fk_orphans(child: DataFrame, fk: str | Sequence[str], parent: DataFrame,
                  pk: str | Sequence[str], relation: str) -> DataFrame:
    """One row: ``(relation, n_rows, n_null_fk, n_orphan_rows, n_orphan_keys, ok)``.

    Orphans are child rows whose non-NULL foreign key has no parent row.
    The child is first reduced to one row per key value with its row count,
    so the join moves distinct keys, not rows, and a hot key is one row.
    """
    fk = [fk] if isinstance(fk, str) else list(fk)
    pk = [pk] if isinstance(pk, str) else list(pk)
    keys = [f"_k{i}" for i in range(len(fk))]
    keyed = child.select(*[quoted(c).alias(k) for c, k in zip(fk, keys)])
    # Grouped by the key alone, so the result is already partitioned the
    # way the join below needs it; the NULL flag is a function of the key.
    per_key = (keyed.groupBy(*keys).agg(F.count(F.lit(1)).alias("c"))
               .withColumn("_null", reduce(lambda a, b: a | b,
                                           [F.col(k).isNull() for k in keys])))
    parents = (parent.select(*[quoted(c).alias(f"_p{i}") for i, c in enumerate(pk)])
               .distinct().withColumn("_found", F.lit(True)))
    cond = reduce(lambda a, b: a & b,
                  [per_key[f"_k{i}"] == parents[f"_p{i}"] for i in range(len(fk))])
    marked = per_key.join(parents, cond, "left")
    orphan = ~F.col("_null") & F.col("_found").isNull()
    return (marked.agg(
        F.coalesce(F.sum("c"), F.lit(0)).cast("bigint").alias("n_rows"),
        F.coalesce(F.sum(F.when(F.col("_null"), F.col("c"))), F.lit(0))
        .cast("bigint").alias("n_null_fk"),
        F.coalesce(F.sum(F.when(orphan, F.col("c"))), F.lit(0))
        .cast("bigint").alias("n_orphan_rows"),
        F.count(F.when(orphan, True)).alias("n_orphan_keys"))
        .select(F.lit(relation).alias("relation"), "*")
        .withColumn("ok", F.col("n_orphan_rows") == 0))


def dq_references(child: DataFrame,
                  relations: Sequence[tuple[str, Sequence[str], DataFrame, Sequence[str]]]
                  ) -> DataFrame:
    """:func:`dq_fk_orphans` for several references of one child table with
    one scan of it: ``relations`` are ``(name, fk, parent, pk)``.

    Every child row gives one typed key per relation, every parent row one key marked as
    found, and one aggregate over both adds up rows and marks per (relation, key). Map
    tasks count before the only shuffle of keys, so a hot key is one row per task, and
    there is no join.
    """
    spark = child.sparkSession
    slots: dict[str, str] = {}      # key columns that the relations share, by type
    places = []
    for _, _, parent, pk in relations:
        used: dict[str, int] = {}
        own = []
        for c in pk:
            kind = _carrier(parent.schema[c].dataType)
            used[kind] = used.get(kind, 0) + 1
            own.append(f"{kind} {used[kind]}")
            slots[own[-1]] = kind
        places.append(own)

    def key(rel, own, columns, types, null, found):
        values = dict(zip(own, [quoted(c).cast(t) for c, t in zip(columns, types)]))
        return F.struct(F.lit(rel).alias("rel"), null.alias("null"), *[
            F.when(~null, values[s].cast(kind)).alias(s) if s in values
            else F.lit(None).cast(kind).alias(s) for s, kind in slots.items()],
            F.lit(0 if found else 1).cast("bigint").alias("c"), F.lit(found).alias("found"))
    never = F.lit(False)
    keys, marked = [], []
    for i, ((_, fk, parent, pk), own) in enumerate(zip(relations, places)):
        types = [parent.schema[c].dataType for c in pk]
        null = reduce(lambda a, b: a | b, [quoted(c).isNull() for c in fk])
        keys.append(key(i, own, fk, types, null, False))
        marked.append(parent.select(key(i, own, pk, types, never, True).alias("x")).select("x.*"))
    rows = child.select(F.explode(F.array(*keys)).alias("x")).select("x.*")
    # a row of each relation, so that an empty child has its line too
    empty = spark.range(len(relations)).select(
        F.col("id").cast("int").alias("rel"), F.lit(True).alias("null"),
        *[F.lit(None).cast(kind).alias(s) for s, kind in slots.items()],
        F.lit(0).cast("bigint").alias("c"), never.alias("found"))
    per_key = (reduce(DataFrame.unionByName, [rows, empty, *marked])
               .groupBy("rel", "null", *[quoted(s) for s in slots]).agg(F.sum("c").alias("c"), F.max("found").alias("found")))
    orphan = ~F.col("null") & ~F.col("found")

    def total(cond):
        return F.coalesce(F.sum(F.when(cond, F.col("c"))), F.lit(0)).cast("bigint")
    names = F.array(*[F.lit(r[0]) for r in relations])
    return (per_key.groupBy("rel").agg(
        F.sum("c").alias("n_rows"), total(F.col("null")).alias("n_null_fk"),
        total(orphan).alias("n_orphan_rows"), F.count(F.when(orphan, True)).alias("n_orphan_keys"))
        .select(names[F.col("rel")].alias("relation"), "n_rows", "n_null_fk", "n_orphan_rows",
                "n_orphan_keys").withColumn("ok", F.col("n_orphan_rows") == 0))


def _carrier(kind: T.DataType) -> str:
    """Type of the column that carries keys of a type: whole numbers share one."""
    return "bigint" if isinstance(kind, T.IntegralType) else kind.simpleString()


def dq_null_profile(df: DataFrame, table_name: str,
                    columns: Sequence[str] | None = None) -> DataFrame:
    """Missing values per column in one pass over the table.

    Rows ``(table_name, column_name, n_rows, n_null, null_fraction)``: one
    aggregate computes every count, ``stack`` turns the result into rows.
    """
    columns = list(columns or df.columns)
    aggs = [F.count(F.lit(1)).alias("n_rows")] + [
        F.count(F.when(quoted(c).isNull(), True)).alias(f"_n{i}")
        for i, c in enumerate(columns)]
    wide = df.agg(*aggs)
    args = ", ".join(f"'{c.replace(chr(39), chr(39) * 2)}', _n{i}"
                     for i, c in enumerate(columns))
    long = wide.selectExpr("n_rows", f"stack({len(columns)}, {args}) AS (column_name, n_null)")
    return long.select(
        F.lit(table_name).alias("table_name"), "column_name", "n_rows", "n_null",
        (F.col("n_null").cast("double") / F.col("n_rows")).alias("null_fraction"))


def raise_on_failure(findings: DataFrame, what: str = "data quality", shown: int = 20) -> None:
    """Raise ``ValueError`` listing the failed rows (``ok = false``).

    The message names how many rows failed and shows the first ``shown``; the
    caller has the findings themselves.
    """
    bad = findings.where(~F.col("ok"))
    first = bad.limit(shown).collect()
    if first:
        raise ValueError(f"{what} check failed, {bad.count()} findings, the first {len(first)}: "
                         + "; ".join(str(r.asDict()) for r in first))
