"""A code dictionary derived from the driver tables, in the arrivals format.

Blocks are generated from whole tables (countries from ``customer``, ports
from ``part``, modes from ``region``, states from ``nation``), so parsing
work grows with the data. Each line is a SQL expression that Spark SQL and
DuckDB evaluate identically; the oracle side uses the same expressions, so
the parsed tables can be compared with their generating columns.

Port labels rotate through the label shapes of the real dictionary
(comma, blank, no blank, bracket and ``#`` suffixes, doubled quote, two
commas, no state, an unknown two-letter suffix).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

Q = "chr(39)"
TAB = "chr(9)"


def _esc(e: str) -> str:
    return f"replace({e}, {Q}, {Q} || {Q})"


STATE_OF_PART = "'S' || chr(CAST(65 + p_partkey % 25 AS INTEGER))"
STATE_OF_NATION = "'S' || chr(CAST(65 + n_nationkey AS INTEGER))"
CITY = "upper(p_name)"
COUNTRY_NAME = (f"CASE CAST(c_custkey % 4 AS INTEGER) WHEN 0 THEN upper(c_name) || ' (OLD)' "
                f"WHEN 1 THEN upper(c_name) || {Q} || 'S LAND' "
                f"WHEN 2 THEN upper(c_name) || '    ' ELSE upper(c_name) END")
PORT_LABEL = (
    f"CASE CAST(p_partkey % 8 AS INTEGER) "
    f"WHEN 0 THEN {CITY} || ', ' || {STATE_OF_PART} || '      ' "
    f"WHEN 1 THEN {CITY} || ' ' || {STATE_OF_PART} || '   ' "
    f"WHEN 2 THEN {CITY} || ',' || {STATE_OF_PART} "
    f"WHEN 3 THEN {CITY} || ', ' || {STATE_OF_PART} || ' (BPS)' "
    f"WHEN 4 THEN {CITY} || ', ' || {STATE_OF_PART} || ' #INTL' "
    f"WHEN 5 THEN {CITY} || {Q} || 'S LANDING, ' || {STATE_OF_PART} "
    f"WHEN 6 THEN {CITY} || ', ' || upper(p_type) || ', ' || {STATE_OF_PART} "
    f"WHEN 7 THEN CASE WHEN p_partkey % 16 = 7 "
    f"THEN 'NO PORT CODE (' || CAST(p_partkey AS STRING) || ')' "
    f"ELSE {CITY} || ' ZZ' END END")
# What the parser must give back for each port line.
PORT_CITY = (
    f"CASE CAST(p_partkey % 8 AS INTEGER) "
    f"WHEN 5 THEN {CITY} || {Q} || 'S LANDING' "
    f"WHEN 6 THEN {CITY} || ', ' || upper(p_type) "
    f"WHEN 7 THEN CASE WHEN p_partkey % 16 = 7 "
    f"THEN 'NO PORT CODE (' || CAST(p_partkey AS STRING) || ')' "
    f"ELSE {CITY} || ' ZZ' END ELSE {CITY} END")
PORT_STATE = f"CASE WHEN p_partkey % 8 = 7 THEN NULL ELSE {STATE_OF_PART} END"

# (table, section, kind, order key, line) for generated lines; kind 1 = entry.
ENTRY_LINES = [
    ("customer", 1, 1, "c_custkey",
     f"'   ' || CAST(c_custkey AS STRING) || ' =  ' || {Q} || {_esc(COUNTRY_NAME)} || {Q}"),
    ("part", 3, 1, "p_partkey",
     f"'   ' || {Q} || CAST(p_partkey AS STRING) || {Q} || {TAB} || '=' || {TAB} "
     f"|| {Q} || {_esc(PORT_LABEL)} || {Q}"),
    ("region", 5, 1, "r_regionkey",
     f"{TAB} || CAST(r_regionkey + 1 AS STRING) || ' = ' || {Q} || r_name || {Q}"),
    ("nation", 7, 1, "n_nationkey",
     f"{TAB} || {Q} || {STATE_OF_NATION} || {Q} || '=' || {Q} || {_esc('n_name')} || {Q}"),
]

# Fixed lines around the blocks: (section, kind, order key, text).
FIXED_LINES = [
    (0, 0, 0, "options derived from tables ;"),
    (0, 0, 1, "/* a remark over"),
    (0, 0, 2, "   value $two lines; */"),
    (0, 0, 3, "/* customers as lands */"),
    (1, 0, 0, "  value i94cntyl"),
    (1, 2, 0, ";"),
    (2, 0, 0, ""),
    (2, 0, 1, "/* parts as landing places */"),
    (3, 0, 0, "  value $i94prtl"),
    (3, 0, 1, "   /* 'NONE' = 'a remark inside the block',"),
    (3, 0, 2, "      which ends with a semicolon; */"),
    (3, 2, 0, ";"),
    (4, 0, 0, "/* regions as ways to travel */"),
    (5, 0, 0, "value i94model"),
    (5, 2, 0, "\t;"),
    (6, 0, 0, "/* not a block:"),
    (6, 0, 1, "   1 = Plain"),
    (6, 0, 2, "   2 = 'Quoted'"),
    (6, 0, 3, "*/"),
    (7, 0, 0, "value i94addrl"),
    (7, 2, 0, " ;"),
    (8, 0, 0, "run ;"),
]


def _sql_str(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def dictionary_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All lines with their order: ``(sec, kind, k, value)``."""
    parts = [spark.read.parquet(f"{sf_dir}/{t}.parquet").selectExpr(
        f"{sec} AS sec", f"{kind} AS kind", f"CAST({key} AS BIGINT) AS k", f"{line} AS value")
        for t, sec, kind, key, line in ENTRY_LINES]
    fixed = spark.createDataFrame(FIXED_LINES, "sec int, kind int, k bigint, value string")
    out = fixed
    for p in parts:
        out = out.unionByName(p)
    return out


def write_dictionary(spark: SparkSession, sf_dir: str, path: str) -> str:
    """Write the dictionary as text in order (range-partitioned sort, so the
    part files are ordered among themselves and inside)."""
    lines = dictionary_lines(spark, sf_dir)
    lines.orderBy("sec", "kind", "k").select("value").write.mode("overwrite").text(path)
    return path


def oracle_lines_sql() -> str:
    """DuckDB: every line of the dictionary (a multiset, order not kept)."""
    sel = [f"SELECT {line} AS value FROM {t}" for t, _s, _k, _key, line in ENTRY_LINES]
    sel += [f"SELECT {_sql_str(text)} AS value" for _s, _k, _key, text in FIXED_LINES]
    return "\nUNION ALL\n".join(sel)


def oracle_entries_sql() -> str:
    """DuckDB: ``(fmt, code, label)`` of every entry the parser must find."""
    return "\nUNION ALL\n".join([
        f"SELECT 'i94cntyl' AS fmt, CAST(c_custkey AS STRING) AS code, "
        f"rtrim({COUNTRY_NAME}) AS label FROM customer",
        f"SELECT '$i94prtl', CAST(p_partkey AS STRING), rtrim({PORT_LABEL}) FROM part",
        "SELECT 'i94model', CAST(r_regionkey + 1 AS STRING), r_name FROM region",
        f"SELECT 'i94addrl', {STATE_OF_NATION}, n_name FROM nation",
    ])


def oracle_ports_sql() -> str:
    return (f"SELECT CAST(p_partkey AS STRING) AS port_code, {PORT_CITY} AS city, "
            f"{PORT_STATE} AS state_code FROM part")


def oracle_countries_sql() -> str:
    return (f"SELECT CAST(c_custkey AS INTEGER) AS country_code, "
            f"rtrim({COUNTRY_NAME}) AS country_name FROM customer")


def oracle_states_sql() -> str:
    return f"SELECT {STATE_OF_NATION} AS state_code, n_name AS state_name FROM nation"


# Used by Spark-side queries that need the same derived columns.
def part_city_state(part: DataFrame) -> DataFrame:
    return part.selectExpr("p_partkey", f"{CITY} AS city", f"{STATE_OF_PART} AS state",
                           "p_retailprice")

