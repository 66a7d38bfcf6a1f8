"""Raw inputs of the star build, derived from the driver tables.

``raw_arrivals``: one arrival record per ``lineitem`` row joined to its
order, in the raw arrivals schema (DOUBLE codes, SAS day numbers):
person ``l_orderkey``, month of ``l_shipdate``, citizenship ``l_suppkey`` /
residence ``l_partkey`` (codes of the derived dictionary's country block),
port ``l_partkey`` (its port block), arrival = order date (+12h on line 2),
departure = ship date (missing on line 6), mode 1 for open lines else 2,
visa = line number (4+ unknown), gender from the order priority (missing
for ``5-LOW``).

``demographics``: one row per part in the demographics schema: city =
part name, state code = the part's derived state, race = part type,
count = part size.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schemas
from ..functions import timestamp_to_sas_day
from . import dictionary_fixture as dfx

GENDER_BY_PRIORITY = {"1-URGENT": "F", "2-HIGH": "M", "3-MEDIUM": "F", "4-NOT SPECIFIED": "M"}


def raw_arrivals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw arrival records derived from ``lineitem`` joined to ``orders`` (module doc)."""
    li = spark.read.schema(schemas.DRIVER["lineitem"]).parquet(f"{sf_dir}/lineitem.parquet")
    o = spark.read.schema(schemas.DRIVER["orders"]).parquet(f"{sf_dir}/orders.parquet")
    j = li.join(o, li.l_orderkey == o.o_orderkey)
    d = lambda c: F.col(c).cast("double")
    gender = None
    for k, v in GENDER_BY_PRIORITY.items():
        cond = F.col("o_orderpriority") == k
        gender = F.when(cond, v) if gender is None else gender.when(cond, v)
    cols = {
        "cicid": d("l_orderkey"),
        "i94yr": F.year("l_shipdate").cast("double"),
        "i94mon": F.month("l_shipdate").cast("double"),
        "i94cit": d("l_suppkey"),
        "i94res": d("l_partkey"),
        "i94port": F.col("l_partkey").cast("string"),
        "arrdate": timestamp_to_sas_day("o_orderdate")
        + F.when(F.col("l_linenumber") == 2, F.lit(0.5)).otherwise(F.lit(0.0)),
        "i94mode": F.when(F.col("l_linestatus") == "O", F.lit(1.0)).otherwise(F.lit(2.0)),
        "i94addr": F.expr(dfx.STATE_OF_PART.replace("p_partkey", "l_partkey")),
        "depdate": F.when(F.col("l_linenumber") != 6, timestamp_to_sas_day("l_shipdate")),
        "i94bir": d("l_quantity"),
        "i94visa": d("l_linenumber"),
        "biryear": F.lit(2000.0) - F.col("l_quantity"),
        "gender": gender,
        "airline": F.col("l_returnflag"),
        "admnum": (F.col("l_orderkey") * 10 + F.col("l_linenumber")).cast("double"),
        "fltno": F.col("l_suppkey").cast("string"),
        "visatype": F.col("o_orderstatus"),
    }
    return j.select([(cols[f.name] if f.name in cols else F.lit(None)).cast(f.dataType)
                     .alias(f.name) for f in schemas.ARRIVALS_RAW.fields])


def demographics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Demographics rows derived from ``part`` (module doc)."""
    p = spark.read.schema(schemas.DRIVER["part"]).parquet(f"{sf_dir}/part.parquet")
    state = F.expr(dfx.STATE_OF_PART)
    cols = {
        "City": F.col("p_name"), "State": F.concat(F.lit("state "), state),
        "Median Age": (F.col("p_size") / 2).cast("double"),
        "Male Population": F.col("p_size") * 100, "Female Population": F.col("p_size") * 110,
        "Total Population": F.col("p_size") * 210, "Number of Veterans": F.col("p_size"),
        "Foreign-born": (F.col("p_partkey") % 997).cast("int"),
        "Average Household Size": F.col("p_retailprice") / 1000,
        "State Code": state, "Race": F.col("p_type"), "Count": F.col("p_size"),
    }
    return p.select([cols[f.name].cast(f.dataType).alias(f.name)
                     for f in schemas.DEMOGRAPHICS_RAW.fields])


# Airports from suppliers: nations 0-9 are the 'US' ones; every third nation
# has a region without a two-character state part.
AIRPORT_COLUMNS = {
    "ident": "'A' || CAST(s_suppkey AS STRING)",
    "type": "CASE WHEN s_acctbal > 5000 THEN 'large_airport' ELSE 'small_airport' END",
    "name": "s_name",
    "elevation_ft": "s_nationkey * 100",
    "iso_country": "CASE WHEN s_nationkey < 10 THEN 'US' ELSE 'XX' END",
    "iso_region": ("CASE WHEN s_nationkey % 3 = 0 THEN 'US-U-A' "
                   "ELSE 'US-' || chr(CAST(65 + s_nationkey AS INTEGER)) || 'Q' END"),
    "municipality": "upper(s_name)",
    "coordinates": "CAST(s_suppkey AS STRING) || ', ' || CAST(s_nationkey AS STRING)",
}


def airports(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Airports derived from ``supplier`` (see ``AIRPORT_COLUMNS``)."""
    s = spark.read.schema(schemas.DRIVER["supplier"]).parquet(f"{sf_dir}/supplier.parquet")
    return s.select([(F.expr(AIRPORT_COLUMNS[f.name]) if f.name in AIRPORT_COLUMNS
                      else F.lit(None)).cast(f.dataType).alias(f.name)
                     for f in schemas.AIRPORTS_RAW.fields])


# --- DuckDB side (independent formulation) ----------------------------------

STATE_OF_LINE = dfx.STATE_OF_PART.replace("p_partkey", "l_partkey")

ORACLE_CLEAN = f"""
SELECT CAST(l.l_orderkey AS BIGINT) AS cicid,
  CAST(year(l.l_shipdate) AS INTEGER) AS year, CAST(month(l.l_shipdate) AS INTEGER) AS month,
  CAST(l.l_suppkey AS INTEGER) AS citizen_country, CAST(l.l_partkey AS INTEGER) AS residence_country,
  CAST(l.l_partkey AS STRING) AS port,
  CAST(o.o_orderdate AS TIMESTAMP)
    + CASE WHEN l.l_linenumber = 2 THEN INTERVAL 12 HOUR ELSE INTERVAL 0 HOUR END AS arrival_date,
  CAST(l.l_shipdate AS TIMESTAMP) AS departure_date,
  {STATE_OF_LINE} AS state_code,
  CAST(trunc(l.l_quantity) AS INTEGER) AS age,
  CAST(trunc(2000 - l.l_quantity) AS INTEGER) AS birth_year,
  CASE l.l_linenumber WHEN 1 THEN 'Business' WHEN 2 THEN 'Pleasure' WHEN 3 THEN 'Student' END AS visa,
  CASE o.o_orderpriority WHEN '1-URGENT' THEN 'F' WHEN '3-MEDIUM' THEN 'F' ELSE 'M' END AS gender,
  l.l_orderkey * 10 + l.l_linenumber AS adm_num,
  CAST(l.l_suppkey AS STRING) AS flight_no, l.l_returnflag AS airline, o.o_orderstatus AS visatype
FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
WHERE l.l_linestatus = 'O' AND l.l_linenumber <> 6 AND o.o_orderpriority <> '5-LOW'"""

ORACLE_COUNTRIES = f"""
SELECT c_custkey AS country_code, rtrim({dfx.COUNTRY_NAME}) AS country_name FROM customer"""

ORACLE_PORTS = f"""
SELECT CAST(p_partkey AS STRING) AS city_code, {dfx.PORT_CITY} AS port_city,
  {dfx.PORT_STATE} AS port_state FROM part"""

ORACLE_CITIES = f"""
SELECT upper(p_name) AS city, upper('state ' || st) AS state, st AS state_code,
  p_size * 100 AS male_population, p_size * 110 AS female_population,
  p_size * 210 AS total_population, p_size AS veteran_population,
  CAST(p_partkey % 997 AS INTEGER) AS foreign_population, p_type AS race,
  CAST(p_size AS DOUBLE) / 2 AS median_age, p_retailprice / 1000 AS avg_household_size
FROM (SELECT *, max(p_size) OVER (PARTITION BY p_name, st) AS largest
      FROM (SELECT *, {dfx.STATE_OF_PART} AS st FROM part))
WHERE p_size = largest"""

ORACLE_AIRPORTS = f"""
SELECT {AIRPORT_COLUMNS["ident"]} AS airport_id, {AIRPORT_COLUMNS["type"]} AS type,
  s_name AS name, s_nationkey * 100 AS elevation_ft,
  CASE WHEN s_nationkey % 3 = 0 THEN NULL
       ELSE chr(CAST(65 + s_nationkey AS INTEGER)) || 'Q' END AS region,
  upper(s_name) AS municipality, {AIRPORT_COLUMNS["coordinates"]} AS coordinates
FROM supplier WHERE s_nationkey < 10"""
