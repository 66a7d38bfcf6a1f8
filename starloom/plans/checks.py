"""Quality checks over a written star (schema, non-empty, keys, references).

All checks are Spark jobs over the tables; the result is one small findings
table with an ``ok`` column per check. :func:`check_star` raises on failure
when asked to.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schemas
from ..operators import (dq_non_empty, dq_pk_unique, dq_references, dq_schema,
                         raise_on_failure)
from .star import PERSON_KEY

PRIMARY_KEYS = {"fact_immigration": ["id"], "dim_personal": list(PERSON_KEY),
                "dim_flight": ["adm_num"], "dim_airports": ["airport_id"],
                "dim_city_population": ["city_code"], "dim_city_stats": ["city_code"]}
# References of the fact table. Every person and flight comes from the same
# arrivals and must be there; ports and states may lie outside the lists of
# cities and airports, so those two count as coverage: reported, never failed.
REFERENCES = [(list(PERSON_KEY), "dim_personal", list(PERSON_KEY), True),
              (["adm_num"], "dim_flight", ["adm_num"], True),
              (["port"], "dim_city_population", ["city_code"], False),
              (["port"], "dim_city_stats", ["city_code"], False),
              (["state_code"], "dim_airports", ["region"], False)]


def star_findings(spark: SparkSession, tables: dict[str, DataFrame]) -> DataFrame:
    """``(check, subject, detail, ok)`` for every check on the star tables."""
    parts = []
    sch = dq_schema(spark, {n: (df, schemas.STAR_SCHEMAS[n]) for n, df in tables.items()})
    parts.append(sch.select(F.lit("schema").alias("check"), F.col("table_name").alias("subject"),
                            F.concat_ws(" ", "column_name", F.coalesce("expected_type", F.lit("-")),
                                        F.coalesce("actual_type", F.lit("-"))).alias("detail"),
                            "ok"))
    ne = dq_non_empty(tables)
    parts.append(ne.select(F.lit("non_empty").alias("check"), F.col("table_name").alias("subject"),
                           F.concat(F.lit("rows="), F.col("n_rows").cast("string")).alias("detail"),
                           "ok"))
    for name, keys in PRIMARY_KEYS.items():
        if name in tables:
            pk = dq_pk_unique(tables[name], keys, name)
            parts.append(pk.select(
                F.lit("primary_key").alias("check"),
                F.concat_ws(".", "table_name", "key_columns").alias("subject"),
                F.concat(F.lit("duplicates="), F.col("n_duplicate_keys").cast("string"),
                         F.lit(" nulls="), F.col("n_null_keys").cast("string")).alias("detail"),
                "ok"))
    known = [(f"fact_immigration.{','.join(fk)}->{parent}.{','.join(pk)}", fk, tables[parent], pk,
              must) for fk, parent, pk, must in REFERENCES if parent in tables]
    if "fact_immigration" in tables and known:
        must = [name for name, *_, m in known if m]
        found = dq_references(tables["fact_immigration"], [k[:4] for k in known])
        needed = F.col("relation").isin(must)
        parts.append(found.select(
            F.when(needed, "reference").otherwise("coverage").alias("check"),
            F.col("relation").alias("subject"),
            F.concat(F.lit("orphan_rows="), F.col("n_orphan_rows").cast("string")).alias("detail"),
            (F.col("ok") | ~needed).alias("ok")))
    return reduce(DataFrame.unionByName, parts)


def check_star(spark: SparkSession, star_dir: str, raise_errors: bool = True) -> DataFrame:
    """Run every check on the tables under ``star_dir``."""
    from .star import read_star
    findings = star_findings(spark, read_star(spark, star_dir))
    if raise_errors:
        raise_on_failure(findings, "star")
    return findings
