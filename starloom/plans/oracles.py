"""DuckDB SQL for every key of :mod:`.driver_tables` (independent oracle).

Conventions: NULL placement is always written out (Spark sorts NULLs first
ascending, DuckDB last); double -> integer casts truncate explicitly
(DuckDB rounds); casts to text use ``STRING``, which both engines accept.
"""

from __future__ import annotations

from .. import schemas
from . import dictionary_fixture as dfx
from .driver_tables import DQ_TABLES, FK_CHECKS, PK_CHECKS, STAR_DIGEST, _relation_name

CITIES = f"""
  SELECT p_partkey, {dfx.CITY} AS city, {dfx.STATE_OF_PART} AS state, p_retailprice
  FROM part"""

PORTS = f"""
  SELECT port_code AS city_code, city AS port_city, state_code AS port_state
  FROM ({dfx.oracle_ports_sql()})"""


def _pk_sql(t: str, keys: list[str]) -> str:
    k = ", ".join(keys)
    null = " OR ".join(f"{c} IS NULL" for c in keys)
    nn = "coalesce(sum(CASE WHEN nk THEN c END), 0)"
    return f"""SELECT '{t}' AS table_name, '{",".join(keys)}' AS key_columns,
      CAST(sum(c) AS BIGINT) AS n_rows, CAST({nn} AS BIGINT) AS n_null_keys,
      count(*) AS n_keys, count(*) FILTER (WHERE c > 1) AS n_duplicate_keys,
      ({nn} = 0 AND count(*) FILTER (WHERE c > 1) = 0) AS ok
    FROM (SELECT {k}, count(*) AS c, bool_or({null}) AS nk FROM {t} GROUP BY {k})"""


def _fk_sql(child, fk, parent, pk, where) -> str:
    w = f" WHERE {where}" if where else ""
    orphan = f"x.{fk} IS NOT NULL AND p.k IS NULL"
    rel = _relation_name(child, fk, parent, pk, where).replace("'", "''")
    return f"""SELECT '{rel}' AS relation,
      count(*) AS n_rows, count(*) FILTER (WHERE x.{fk} IS NULL) AS n_null_fk,
      count(*) FILTER (WHERE {orphan}) AS n_orphan_rows,
      count(DISTINCT CASE WHEN {orphan} THEN x.{fk} END) AS n_orphan_keys,
      count(*) FILTER (WHERE {orphan}) = 0 AS ok
    FROM {child} x LEFT JOIN (SELECT DISTINCT {pk} AS k FROM {parent}{w}) p ON x.{fk} = p.k"""


ORDERS_WITH_GAPS = """(SELECT o_orderkey, nullif(o_orderpriority, '5-LOW') AS o_orderpriority,
    nullif(o_orderstatus, 'P') AS o_orderstatus, o_totalprice FROM orders)"""

from . import arrivals_fixture as afx

STAR_CLEAN = f"WITH clean AS ({afx.ORACLE_CLEAN})"
STAR_CITY_PARTS = f"""cities AS ({afx.ORACLE_CITIES}), ports AS ({afx.ORACLE_PORTS})"""
STAR_CITY = f"""WITH {STAR_CITY_PARTS},
city_pop AS (SELECT c.city, c.state, p.city_code, c.state_code, c.male_population,
  c.female_population, c.total_population, c.veteran_population, c.foreign_population, c.race,
  c.median_age, c.avg_household_size
  FROM cities c JOIN ports p ON c.city = p.port_city AND c.state_code = p.port_state)"""
STAR_NAMED = f"""{STAR_CLEAN}, lands AS ({afx.ORACLE_COUNTRIES}),
named AS (SELECT clean.*, (SELECT any_value(country_name) FROM lands
                           WHERE country_code = citizen_country) AS home,
                 (SELECT any_value(country_name) FROM lands
                  WHERE country_code = residence_country) AS stay FROM clean)"""
# one record per month and number, one per admission number
PERSON_SQL = """SELECT cicid, year, month, home AS citizen_country, stay AS residence_country, age,
  birth_year, gender FROM named QUALIFY 1 = row_number() OVER (PARTITION BY year, month, cicid
  ORDER BY age NULLS FIRST, birth_year NULLS FIRST, gender NULLS FIRST,
           citizen_country NULLS FIRST, residence_country NULLS FIRST)"""
FLIGHT_SQL = """SELECT adm_num, flight_no, airline, visatype FROM clean
QUALIFY 1 = row_number() OVER (PARTITION BY adm_num ORDER BY year DESC NULLS LAST,
  month DESC NULLS LAST, flight_no, airline, visatype)"""


def _women_sql(gender: str) -> str:
    """How many arrivals are of women at the port city with most foreign-born
    inhabitants; a person's gender is that of the month's first record."""
    return f"""{STAR_CITY}, clean AS ({afx.ORACLE_CLEAN}),
women AS (SELECT year, month, cicid FROM (
    SELECT *, row_number() OVER (PARTITION BY year, month, cicid ORDER BY age NULLS FIRST,
      birth_year NULLS FIRST, {gender} NULLS FIRST) AS nth FROM clean)
  WHERE nth = 1 AND {gender} = 'F'),
arrived AS (SELECT port, count(*) AS n FROM clean SEMI JOIN women USING (year, month, cicid)
            GROUP BY port),
markets AS (SELECT city, foreign_population, city_code FROM city_pop)
SELECT city, CAST(sum(n) AS BIGINT) AS n_female_arrivals, foreign_population
FROM arrived LEFT JOIN markets ON city_code = port
GROUP BY city, foreign_population
ORDER BY foreign_population DESC NULLS LAST, city NULLS LAST LIMIT 1"""


def _digest_sql(name: str, source: str) -> str:
    def text(c):
        value = f"strftime({c}, '%Y%m%d%H')" if c.endswith("_date") else f"CAST({c} AS STRING)"
        return f"coalesce({value}, '~')"
    row = " || '|' || ".join(text(c) for c in STAR_DIGEST[name])
    return f"""SELECT '{name}' AS table_name, count(*) AS n_rows,
  CAST(sum(CAST('0x' || substr(md5({row}), 1, 7) AS BIGINT)) AS BIGINT) AS digest FROM ({source})"""


UNION_OF_DIGESTS = "\nUNION ALL\n".join([
    _digest_sql("fact_immigration", "SELECT * FROM clean"),
    _digest_sql("dim_personal", PERSON_SQL), _digest_sql("dim_flight", FLIGHT_SQL),
    _digest_sql("dim_airports", afx.ORACLE_AIRPORTS),
    _digest_sql("dim_city_population", "SELECT * FROM market"),
    _digest_sql("dim_city_stats", "SELECT * FROM market")])


def _schema_sql() -> str:
    """Declared types against those DuckDB finds in the data."""
    spark_type = """CASE typeof(any_value({c})) WHEN 'BIGINT' THEN 'bigint' WHEN 'INTEGER' THEN 'int'
  WHEN 'VARCHAR' THEN 'string' WHEN 'DOUBLE' THEN 'double' WHEN 'TIMESTAMP' THEN 'timestamp_ntz' END"""
    altered = """(SELECT CAST(o_orderkey AS INTEGER) AS o_orderkey, o_custkey, o_orderstatus,
      o_totalprice, o_orderdate, nullif(o_orderstatus, 'P') AS o_extra FROM orders)"""
    rows = []
    for name, source in [(t, t) for t in DQ_TABLES] + [("orders_altered", altered)]:
        declared = {f.name: f.dataType.simpleString()
                    for f in schemas.DRIVER[name.removesuffix("_altered")].fields}
        present = set(declared) if name == source else set(declared) - {"o_orderpriority"}
        for c in [*declared, *(["o_extra"] if name != source else [])]:
            want = f"'{declared[c]}'" if c in declared else "CAST(NULL AS STRING)"
            there = c in present or c == "o_extra"
            got = spark_type.format(c=c) if there else "CAST(NULL AS STRING)"
            n = f"count({c})" if there else "CAST(0 * count(*) AS BIGINT)"
            rows.append(f"SELECT '{name}' AS table_name, '{c}' AS column_name, {want} AS expected_type,"
                        f" {got} AS actual_type, {n} AS n_values FROM {source}")
    union = "\nUNION ALL\n".join(rows)
    return f"SELECT *, coalesce(expected_type = actual_type, false) AS ok FROM ({union})"


DQ_SCHEMA = _schema_sql()

ORACLE = {
    "flagship_top_market": """
SELECT s.s_name AS market, count(l.l_orderkey) AS n_facts, s.s_acctbal AS market_size
FROM lineitem l
LEFT JOIN supplier s ON l.l_suppkey = s.s_suppkey
LEFT JOIN orders o ON l.l_orderkey = o.o_orderkey
WHERE o.o_orderpriority = '1-URGENT'
GROUP BY s.s_name, s.s_acctbal
ORDER BY s.s_acctbal DESC NULLS LAST, s.s_name ASC NULLS LAST
LIMIT 1""",
    "scan_parquet": "SELECT * FROM orders",
    "scan_glob": "SELECT *, CAST(year(o_orderdate) AS INTEGER) AS o_year FROM orders",
    "scan_text_lines": dfx.oracle_lines_sql(),
    "scan_csv_semicolon": "SELECT * FROM part",
    "scan_csv_comma": """SELECT *, CAST(c_custkey AS STRING) || ', ' || CAST(c_nationkey AS STRING)
  AS coordinates FROM customer""",
    "scan_csv_inferred": "SELECT * FROM part",
    "scan_csv_malformed": """WITH judged AS (
  SELECT *, CASE WHEN p_partkey % 13 = 0 THEN 'number of fields'
                 WHEN p_partkey % 11 = 0 THEN 'p_size: not int' END AS reason FROM part)
SELECT p_partkey, p_name || CASE WHEN p_partkey % 7 = 0 THEN chr(10) || 'and more' ELSE '' END AS p_name,
  p_brand, p_type, p_size, p_retailprice, reason, CAST(1 AS BIGINT) AS n FROM judged WHERE reason IS NULL
UNION ALL
SELECT NULL, NULL, NULL, NULL, NULL, NULL, reason, count(*) FROM judged WHERE reason IS NOT NULL
GROUP BY reason""",
    "sql_over_views": """
SELECT c.c_mktsegment, count(o.o_orderkey) AS n_orders, max(o.o_totalprice) AS max_totalprice
FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey GROUP BY c.c_mktsegment""",
    "label_sections": dfx.oracle_entries_sql(),
    "parquet_overwrite_roundtrip": "SELECT * FROM orders",
    "preview_limit": "SELECT * FROM orders ORDER BY o_orderkey ASC NULLS LAST LIMIT 20",
    "row_count": "\nUNION ALL\n".join(
        f"SELECT '{t}' AS table_name, count(*) AS n_rows FROM {t}"
        for t in ["lineitem", "orders", "customer", "part", "supplier", "nation", "region"]),
    "project_rename": """SELECT o_orderkey AS id, o_custkey AS person_id, o_orderstatus AS status,
  o_orderdate AS arrival_date FROM orders""",
    "project_quoted_names": """SELECT p_partkey AS part_key, p_name AS part_name,
  p_retailprice AS retail_price, p_size AS size_class FROM part""",
    "cast_numeric": """SELECT l_orderkey, l_linenumber, CAST(trunc(l_quantity) AS INTEGER) AS quantity,
  CAST(trunc(l_extendedprice) AS BIGINT) AS price_whole FROM lineitem""",
    "cast_char": """SELECT o_orderkey, o_orderstatus AS status,
  substring(o_orderpriority, 1, 1) AS priority_code FROM orders""",
    "select_star": "SELECT * FROM supplier",
    "map_element": f"""SELECT CAST(c_custkey AS STRING) AS country_code,
  rtrim({dfx.COUNTRY_NAME}) AS country_name FROM customer""",
    "filter_eq": "SELECT * FROM lineitem WHERE l_linenumber = 1",
    "filter_string_eq": "SELECT * FROM customer WHERE c_mktsegment = 'BUILDING'",
    "require_columns": """SELECT * FROM (SELECT o_orderkey, nullif(o_orderpriority, '5-LOW') AS priority,
  nullif(o_orderstatus, 'P') AS status, o_totalprice FROM orders)
WHERE priority IS NOT NULL AND status IS NOT NULL""",
    "rows_at_group_max": """SELECT * FROM part
QUALIFY p_retailprice = max(p_retailprice) OVER (PARTITION BY p_brand)""",
    "role_playing_lookup": """
SELECT DISTINCT l.l_orderkey AS order_key, cn.n_name AS customer_nation,
  sn.n_name AS supplier_nation, o.o_orderpriority AS priority
FROM lineitem l
JOIN orders o ON l.l_orderkey = o.o_orderkey
JOIN customer c ON o.o_custkey = c.c_custkey
JOIN supplier s ON l.l_suppkey = s.s_suppkey
LEFT JOIN nation cn ON c.c_nationkey = cn.n_nationkey
LEFT JOIN nation sn ON s.s_nationkey = sn.n_nationkey""",
    "conform_by_name": f"""
WITH cities AS ({CITIES}), ports AS ({PORTS}),
top AS (SELECT * FROM cities QUALIFY p_retailprice = max(p_retailprice) OVER (PARTITION BY city))
SELECT t.city, t.state, p.city_code, p.port_state, t.p_partkey, t.p_retailprice
FROM top t JOIN ports p ON t.city = p.port_city""",
    "conform_by_name_state": f"""
WITH cities AS ({CITIES}), ports AS ({PORTS}),
top AS (SELECT * FROM cities
        QUALIFY p_retailprice = max(p_retailprice) OVER (PARTITION BY city, state))
SELECT t.city, t.state, p.city_code, t.p_partkey, t.p_retailprice
FROM top t JOIN ports p ON t.city = p.port_city AND t.state = p.port_state""",
    "star_left_join": """
SELECT f.l_orderkey, f.l_linenumber, s.s_name, o.o_orderpriority
FROM (SELECT l_orderkey, l_linenumber, CASE WHEN l_linenumber <> 7 THEN l_suppkey END AS supp_key
      FROM lineitem) f
LEFT JOIN supplier s ON f.supp_key = s.s_suppkey
LEFT JOIN orders o ON f.l_orderkey = o.o_orderkey""",
    "star_join_hot_keys": """
WITH f AS (SELECT l_orderkey, l_linenumber,
                  CASE WHEN l_partkey % 3 = 0 THEN 1 ELSE l_orderkey END AS person,
                  CASE WHEN l_linenumber = 7 THEN NULL WHEN l_partkey % 3 = 0 THEN 1
                       ELSE l_suppkey END AS port FROM lineitem)
SELECT f.l_orderkey, f.l_linenumber, CAST(f.person AS BIGINT) AS person, s.s_name, o.o_orderpriority
FROM f LEFT JOIN supplier s ON s.s_suppkey = f.port LEFT JOIN orders o ON o.o_orderkey = f.person""",
    "top_market_hot_persons": """
WITH f AS (SELECT CASE WHEN l_partkey % 3 = 0 THEN 1 ELSE l_orderkey END AS person,
                  CASE WHEN l_partkey % 3 = 0 THEN 1 ELSE l_suppkey END AS port FROM lineitem),
urgent AS (SELECT o_orderkey FROM orders WHERE o_orderpriority = '1-URGENT')
SELECT s.s_name AS market, count(*) AS n_facts, s.s_acctbal AS market_size
FROM f JOIN urgent ON f.person = urgent.o_orderkey LEFT JOIN supplier s ON s.s_suppkey = f.port
GROUP BY ALL ORDER BY market_size DESC NULLS LAST, market NULLS LAST LIMIT 20""",
    "join_cast_key": """
SELECT c.c_custkey, l.name AS nation_name
FROM customer c JOIN (SELECT CAST(n_nationkey AS STRING) AS code, n_name AS name FROM nation
                      UNION ALL SELECT r_name, r_name FROM region) l
  ON c.c_nationkey = TRY_CAST(l.code AS INTEGER)""",
    "group_max": "SELECT p_brand, max(p_retailprice) AS max_retailprice FROM part GROUP BY p_brand",
    "group_count": """SELECT o_orderstatus, o_orderpriority, count(o_orderkey) AS n_orders
FROM orders GROUP BY o_orderstatus, o_orderpriority""",
    "distinct_projection": "SELECT DISTINCT o_custkey, o_orderstatus FROM orders",
    "dedup_by_key": """SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM (
  SELECT *, row_number() OVER (PARTITION BY c_nationkey
                               ORDER BY c_acctbal DESC NULLS LAST, c_custkey ASC) AS rn
  FROM customer) WHERE rn = 1""",
    "distinct_sorted": """SELECT DISTINCT o_custkey, o_orderpriority FROM orders
ORDER BY o_custkey ASC NULLS FIRST, o_orderpriority ASC NULLS FIRST""",
    "top_k_desc": """SELECT * FROM customer
ORDER BY c_acctbal DESC NULLS LAST, c_custkey ASC NULLS LAST LIMIT 10""",
    "upper_case": "SELECT p_partkey, upper(p_name) AS city, upper(p_type) AS type_upper FROM part",
    "surrogate_key": "SELECT count(*) AS n, count(*) AS n_distinct FROM lineitem",
    "sas_date_to_timestamp": """SELECT event_id,
  CAST(epoch_us(ts) - epoch_us(TIMESTAMP '1960-01-01 00:00:00') AS DOUBLE)
    / CAST(86400000000 AS DOUBLE) AS sas_day,
  ts AS ts_back, CAST(date_trunc('day', ts) AS TIMESTAMP) AS day_start
FROM events""",
    "code_to_label": """SELECT l_orderkey, l_linenumber,
  CASE l_linenumber WHEN 1 THEN 'Business' WHEN 2 THEN 'Pleasure' WHEN 3 THEN 'Student' END AS visa
FROM lineitem""",
    "parse_region_code": r"""SELECT p_partkey, iso_region,
  nullif(regexp_extract(iso_region, '\w{2}-(\w{2})', 1), '') AS region
FROM (SELECT p_partkey, CASE WHEN p_size % 2 = 0 THEN p_type || '-' || p_name
                             ELSE 'X-' || p_name END AS iso_region FROM part)""",
    "parse_country_label": dfx.oracle_countries_sql(),
    "parse_port_label": dfx.oracle_ports_sql(),
    "parse_state_label": dfx.oracle_states_sql(),
    "sql_function_surface": """SELECT l_orderkey, l_linenumber,
  CASE l_linenumber WHEN 1 THEN 'Business' WHEN 2 THEN 'Pleasure' WHEN 3 THEN 'Student' END AS visa,
  l_returnflag || l_linestatus AS region,
  l_shipdate + INTERVAL 12 HOUR AS ship_noon
FROM lineitem""",
    "fact_monthly_refresh": """SELECT o_orderkey AS id, o_custkey AS person_id,
  CAST(year(o_orderdate) AS INTEGER) AS year, CAST(month(o_orderdate) AS INTEGER) AS month,
  o_orderpriority AS priority, o_totalprice
FROM orders WHERE o_orderstatus <> 'P'""",
    "star_clean_arrivals": f"{STAR_CLEAN} SELECT * FROM clean",
    "star_fact": f"""{STAR_CLEAN} SELECT cicid, year, month, port, state_code, visa, arrival_date,
  departure_date, adm_num FROM clean""",
    "star_dim_personal": f"""{STAR_NAMED}
SELECT DISTINCT cicid, home AS citizen_country, stay AS residence_country, age, birth_year, gender
FROM named""",
    "star_dim_personal_keyed": f"{STAR_NAMED} {PERSON_SQL}",
    "star_dim_flight": f"""{STAR_CLEAN}
SELECT DISTINCT adm_num, flight_no, airline, visatype FROM clean""",
    "star_dim_airports": afx.ORACLE_AIRPORTS,
    "star_monthly_refresh": f"""{STAR_CLEAN} SELECT cicid, year, month, port, state_code, visa,
  arrival_date, departure_date, adm_num FROM clean""",
    "star_refresh_personal": f"{STAR_NAMED} {PERSON_SQL}",
    "star_refresh_flight": f"{STAR_CLEAN} {FLIGHT_SQL}",
    "star_refresh_ids": f"{STAR_CLEAN} SELECT count(*) AS n, count(*) AS n_distinct FROM clean",
    "star_compact_rerun": f"{STAR_NAMED} {PERSON_SQL}",
    "star_refresh_ledger": f"""{STAR_CLEAN} SELECT cicid, year, month, port, state_code, visa,
  arrival_date, departure_date, adm_num FROM clean""",
    "star_stable_ids": f"""{STAR_CLEAN}
SELECT count(*) AS n, count(*) AS n_distinct, count(*) AS n_equal FROM clean""",
    "star_summary_counts": f"""{STAR_CLEAN}, decided AS (
  SELECT year, month, port, first_value(CASE WHEN adm_num % 2 = 0 THEN 'F' ELSE 'M' END) OVER (
    PARTITION BY year, month, cicid ORDER BY age, adm_num % 2) AS gender FROM clean)
SELECT year, month, port, gender, count(*) AS n FROM decided GROUP BY ALL""",
    "star_summary_answer": _women_sql("CASE WHEN adm_num % 2 = 0 THEN 'F' ELSE 'M' END"),
    "star_rebuild_dynamic": f"""{STAR_CLEAN}
SELECT year, month, count(*) AS n_rows FROM clean WHERE year = 1997 GROUP BY year, month""",
    "star_build": f"""{STAR_NAMED}, {STAR_CITY_PARTS}, one_city AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY city, state_code
    ORDER BY race, foreign_population, avg_household_size) AS nth FROM cities) WHERE nth = 1),
market AS (SELECT c.*, p.city_code FROM one_city c
           JOIN ports p ON c.city = p.port_city AND c.state_code = p.port_state)
{UNION_OF_DIGESTS}""",
    "star_dim_city_population": f"""{STAR_CITY}
SELECT city, state, city_code, state_code, male_population, female_population, total_population,
  veteran_population, foreign_population, race FROM city_pop""",
    "star_dim_city_stats": f"""{STAR_CITY}
SELECT city, state, city_code, state_code, median_age, avg_household_size FROM city_pop""",
    "star_top_female_port_city": _women_sql("gender"),
    "star_person_per_month": _women_sql("CASE WHEN month % 2 = 0 THEN 'F' ELSE 'M' END"),
    "star_tied_cities": _women_sql("gender"),
    "dq_schema": DQ_SCHEMA,
    "dq_non_empty": "\nUNION ALL\n".join(
        f"SELECT '{t}' AS table_name, count(*) AS n_rows, count(*) > 0 AS ok FROM {t}"
        for t in DQ_TABLES),
    "dq_pk_unique": "\nUNION ALL\n".join(_pk_sql(t, k) for t, k in PK_CHECKS),
    "dq_fk_orphans_single": _fk_sql("orders", "o_custkey", "customer", "c_custkey",
                                    "c_mktsegment = 'BUILDING'").replace(
        " [c_mktsegment = ''BUILDING'']", ""),
    "dq_fk_orphans": "\nUNION ALL\n".join(_fk_sql(*c) for c in FK_CHECKS),
    "dq_null_profile": "\nUNION ALL\n".join(
        f"""SELECT 'orders' AS table_name, '{c}' AS column_name, count(*) AS n_rows,
  count(*) FILTER (WHERE {c} IS NULL) AS n_null,
  CAST(count(*) FILTER (WHERE {c} IS NULL) AS DOUBLE) / count(*) AS null_fraction
FROM {ORDERS_WITH_GAPS}""" for c in ["o_orderkey", "o_orderpriority", "o_orderstatus",
                                     "o_totalprice"]),
}
