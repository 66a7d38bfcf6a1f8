"""Declared schemas: raw inputs, star-schema outputs and the driver tables.

Explicit schemas replace ``inferSchema``: one pass less over the input and
types that do not drift between files.
"""

from __future__ import annotations

from pyspark.sql import types as T


def _s(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(n, t, True) for n, t in fields])


D, L, I, S = T.DoubleType(), T.LongType(), T.IntegerType(), T.StringType()
TS = T.TimestampNTZType()

# Column names and types of the raw files and of the star tables
# must equal those of the data and of its users.
# --- raw inputs -----------------------------------------------------------

ARRIVALS_RAW = _s(
    ("cicid", D), ("i94yr", D), ("i94mon", D), ("i94cit", D), ("i94res", D),
    ("i94port", S), ("arrdate", D), ("i94mode", D), ("i94addr", S),
    ("depdate", D), ("i94bir", D), ("i94visa", D), ("count", D),
    ("dtadfile", S), ("visapost", S), ("occup", S), ("entdepa", S),
    ("entdepd", S), ("entdepu", S), ("matflag", S), ("biryear", D),
    ("dtaddto", S), ("gender", S), ("insnum", S), ("airline", S),
    ("admnum", D), ("fltno", S), ("visatype", S),
)

DEMOGRAPHICS_RAW = _s(
    ("City", S), ("State", S), ("Median Age", D), ("Male Population", I),
    ("Female Population", I), ("Total Population", I),
    ("Number of Veterans", I), ("Foreign-born", I),
    ("Average Household Size", D), ("State Code", S), ("Race", S), ("Count", I),
)

AIRPORTS_RAW = _s(
    ("ident", S), ("type", S), ("name", S), ("elevation_ft", I),
    ("continent", S), ("iso_country", S), ("iso_region", S),
    ("municipality", S), ("gps_code", S), ("iata_code", S),
    ("local_code", S), ("coordinates", S),
)

# --- star schema outputs ----------------------------------------------------

FACT_IMMIGRATION = _s(
    ("id", L), ("cicid", L), ("year", I), ("month", I), ("port", S),
    ("state_code", S), ("visa", S), ("arrival_date", TS),
    ("departure_date", TS), ("adm_num", L),
)

# cicid numbers start anew every month, so a person row belongs to one month
DIM_PERSONAL = _s(
    ("cicid", L), ("year", I), ("month", I), ("citizen_country", S),
    ("residence_country", S), ("age", I), ("birth_year", I), ("gender", S),
)

DIM_FLIGHT = _s(("adm_num", L), ("flight_no", S), ("airline", S), ("visatype", S))

DIM_AIRPORTS = _s(
    ("airport_id", S), ("type", S), ("name", S), ("elevation_ft", I),
    ("region", S), ("municipality", S), ("coordinates", S),
)

DIM_CITY_POPULATION = _s(
    ("city", S), ("state", S), ("city_code", S), ("state_code", S),
    ("male_population", I), ("female_population", I), ("total_population", I),
    ("veteran_population", I), ("foreign_population", I), ("race", S),
)

DIM_CITY_STATS = _s(
    ("city", S), ("state", S), ("city_code", S), ("state_code", S),
    ("median_age", D), ("avg_household_size", D),
)

STAR_SCHEMAS = {
    "fact_immigration": FACT_IMMIGRATION,
    "dim_personal": DIM_PERSONAL,
    "dim_flight": DIM_FLIGHT,
    "dim_airports": DIM_AIRPORTS,
    "dim_city_population": DIM_CITY_POPULATION,
    "dim_city_stats": DIM_CITY_STATS,
}

# --- driver tables (read-only test data) -------------------------------------

DRIVER = {
    "region": _s(("r_regionkey", I), ("r_name", S)),
    "nation": _s(("n_nationkey", I), ("n_name", S), ("n_regionkey", I)),
    "customer": _s(("c_custkey", L), ("c_name", S), ("c_nationkey", I),
                   ("c_acctbal", D), ("c_mktsegment", S)),
    "supplier": _s(("s_suppkey", L), ("s_name", S), ("s_nationkey", I), ("s_acctbal", D)),
    "part": _s(("p_partkey", L), ("p_name", S), ("p_brand", S), ("p_type", S),
               ("p_size", I), ("p_retailprice", D)),
    "orders": _s(("o_orderkey", L), ("o_custkey", L), ("o_orderstatus", S),
                 ("o_totalprice", D), ("o_orderdate", TS), ("o_orderpriority", S)),
    "lineitem": _s(("l_orderkey", L), ("l_partkey", L), ("l_suppkey", L),
                   ("l_linenumber", I), ("l_quantity", D), ("l_extendedprice", D),
                   ("l_discount", D), ("l_tax", D), ("l_returnflag", S),
                   ("l_linestatus", S), ("l_shipdate", TS)),
    "events": _s(("event_id", L), ("ts", TS), ("user_id", L), ("event_type", S),
                 ("value", D), ("props", S)),
    "documents": _s(("doc_id", L), ("text", S), ("lang", S), ("source", S), ("n_chars", L)),
}


def with_field(schema: T.StructType, name: str, data_type: T.DataType) -> T.StructType:
    """A copy of ``schema`` with one more nullable field (does not mutate)."""
    return T.StructType(list(schema.fields) + [T.StructField(name, data_type, True)])
