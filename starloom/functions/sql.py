"""SQL-callable names for the library's expressions.

``CREATE TEMPORARY FUNCTION ... RETURN <expr>`` defines a SQL function whose
body is inlined into the plan: SQL users get named functions without a
Python worker, and the optimiser still sees (and pushes down) the
expression. Bodies mirror :mod:`starloom.functions.dates` and ``codes``.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

from . import text as tx
from .codes import REGION_STATE_PATTERN, VISA_CATEGORIES
from .dates import EPOCH_DAYS_BEFORE_1970, MICROS_PER_DAY, SAS_EPOCH


def _lit(pattern: str) -> str:
    """A Spark SQL string literal holding ``pattern`` exactly."""
    return "'" + pattern.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _visa_case() -> str:
    whens = " ".join(f"WHEN {k} THEN '{v}'" for k, v in VISA_CATEGORIES.items())
    return f"CASE CAST(v AS DOUBLE) {whens} END"


def function_definitions() -> dict[str, str]:
    """``{name: signature and body}`` of every SQL function (see module doc)."""
    return {
        "sas_to_timestamp": (
            "(d DOUBLE) RETURNS TIMESTAMP_NTZ RETURN "
            f"timestampadd(MICROSECOND, try_cast(round(d * {MICROS_PER_DAY}D) AS BIGINT), "
            f"TIMESTAMP_NTZ'{SAS_EPOCH}')"),
        "timestamp_to_sas": (
            "(t TIMESTAMP_NTZ) RETURNS DOUBLE RETURN "
            f"CAST(((CAST(unix_date(CAST(t AS DATE)) AS BIGINT) + {EPOCH_DAYS_BEFORE_1970}) * 86400 "
            "+ hour(t) * 3600 + minute(t) * 60) * 1000000 "
            "+ CAST(extract(SECOND FROM t) * 1000000 AS BIGINT) AS DOUBLE) "
            f"/ {MICROS_PER_DAY}D"),
        "visa_category": f"(v DOUBLE) RETURNS STRING RETURN {_visa_case()}",
        "region_state": (
            "(r STRING) RETURNS STRING RETURN "
            f"nullif(regexp_extract(r, r'{REGION_STATE_PATTERN}', 1), '')"),
        # dictionary lines: code and label of an entry line ('' if none)
        "label_code": (
            "(line STRING) RETURNS STRING RETURN "
            f"trim(regexp_extract(regexp_replace(line, {_lit(tx.QUOTED_OR_COMMENT)}, '$1'), "
            f"{_lit(tx.ENTRY)}, 1))"),
        "label_text": (
            "(line STRING) RETURNS STRING RETURN "
            f"rtrim(replace(regexp_extract(regexp_replace(line, {_lit(tx.QUOTED_OR_COMMENT)}, '$1'), "
            f"{_lit(tx.ENTRY)}, 2), \"''\", \"'\"))"),
        # port labels: city and state candidates (no check against a state list)
        "port_city": (
            "(label STRING) RETURNS STRING RETURN "
            f"nullif(trim(regexp_extract(label, {_lit(tx.PORT_SPLIT)}, 1)), '')"),
        "port_state": (
            "(label STRING) RETURNS STRING RETURN "
            f"nullif(regexp_extract(label, {_lit(tx.PORT_SPLIT)}, 2), '')"),
    }


def register_sql_functions(spark: SparkSession) -> list[str]:
    """Define the temporary SQL functions on ``spark``; returns their names."""
    defs = function_definitions()
    for name, body in defs.items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}{body}")
    return list(defs)
