"""Every operator of the inventory, run on the driver tables.

Mapping of the arrivals star onto the driver tables: ``lineitem`` is the
fact (``l_suppkey`` the port, ``l_orderkey`` the person), ``orders`` the
person dimension (``o_orderpriority`` the attribute filtered on),
``supplier`` the market/city dimension (``s_acctbal`` its size measure),
``nation`` the country lookup, ``part`` the demographics (``p_name`` the
city, ``p_retailprice`` the group measure), and a code dictionary derived
from ``customer``/``part``/``region``/``nation`` the label file.

Each ``q_<key>(spark, sf_dir)`` returns a lazy DataFrame over whole tables;
``ORACLE[key]`` is the same question in DuckDB SQL.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schemas
from ..functions import (char_cast, code_label, region_state, register_sql_functions,
                         sas_day_to_timestamp, timestamp_to_sas_day, upper_name)
from ..operators import (as_map, bounded_broadcast, cast_columns, conform, dq_fk_orphans, dq_non_empty,
                         dq_null_profile, dq_pk_unique, dq_references, dq_schema,
                         distinct_projection,
                         first_by_key, group_count, group_max, hot_key_join, map_element, preview,
                         rename, require_columns, role_lookup, rows_at_group_max,
                         select_star, sorted_distinct, star_join, top_k, where_equal,
                         cast_key_join)
from ..session import scratch_path
from ..streaming import read_refreshed, start_refresh
from ..sources import labels as lb
from ..sources.files import (read_csv, read_csv_by_name, read_parquet, read_parquet_glob, read_text_lines,
                             write_csv, write_parquet)
from . import arrivals_fixture as afx
from . import dictionary_fixture as dfx
from . import star
from .olap import top_female_port_city, top_female_port_city_by_counts, top_market


def table(spark: SparkSession, sf_dir: str, name: str, declared: bool = True) -> DataFrame:
    """A driver table, read with its declared schema unless ``declared=False``."""
    schema = schemas.DRIVER.get(name) if declared else None
    return read_parquet(spark, f"{sf_dir}/{name}.parquet", schema)


def _dictionary(spark: SparkSession, sf_dir: str) -> str:
    return dfx.write_dictionary(spark, sf_dir, scratch_path(spark, "code_dictionary"))


def _entries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parsed dictionary, staged: queries use it more than once."""
    return star.load_lookups(spark, _dictionary(spark, sf_dir))["entries"]


# --- composed: the OLAP question --------------------------------------------

def q_flagship_top_market(spark, d):
    return top_market(
        table(spark, d, "lineitem"), table(spark, d, "supplier"), table(spark, d, "orders"),
        fact_id="l_orderkey", fact_port="l_suppkey", fact_person="l_orderkey",
        market_code="s_suppkey", market_name="s_name", market_size="s_acctbal",
        person_key="o_orderkey", person_attr="o_orderpriority", person_value="1-URGENT",
        out_name="market", out_count="n_facts", out_size="market_size")


# --- sources ------------------------------------------------------------------

def q_scan_parquet(spark, d):
    return table(spark, d, "orders")


def q_scan_glob(spark, d):
    root = scratch_path(spark, "orders_by_year")
    src = table(spark, d, "orders").withColumn("o_year", F.year("o_orderdate"))
    write_parquet(src, root, partition_by=["o_year"])
    schema = schemas.with_field(schemas.DRIVER["orders"], "o_year", schemas.I)
    return read_parquet_glob(spark, f"{root}/o_year=*/*.parquet", base_path=root,
                             schema=schema)


def q_scan_text_lines(spark, d):
    return read_text_lines(spark, _dictionary(spark, d)).select("value")


def q_scan_csv_semicolon(spark, d):
    path = write_csv(table(spark, d, "part"), scratch_path(spark, "part_csv"), sep=";")
    return read_csv(spark, path, sep=";", schema=schemas.DRIVER["part"])


def q_scan_csv_comma(spark, d):
    src = table(spark, d, "customer").withColumn(
        "coordinates", F.concat_ws(", ", F.col("c_custkey").cast("string"),
                                   F.col("c_nationkey").cast("string")))
    path = write_csv(src, scratch_path(spark, "customer_csv"), sep=",")
    return read_csv(spark, path, sep=",",
                    schema=schemas.with_field(schemas.DRIVER["customer"], "coordinates", schemas.S))


def q_scan_csv_inferred(spark, d):
    """Types found by an inference pass over the file, then cast to the declared ones."""
    path = write_csv(table(spark, d, "part"), scratch_path(spark, "part_inferred"), sep=",")
    found = read_csv(spark, path, sep=",", infer=True)
    return found.select(*[F.col(f.name).cast(f.dataType) for f in schemas.DRIVER["part"].fields])


# Headers of three files of parts; the third has a column that nobody declared.
PART_HEADERS = (("p_partkey", "p_name", "p_brand", "p_type", "p_size", "p_retailprice"),
                ("p_retailprice", "p_size", "p_type", "p_brand", "p_name", "p_partkey"),
                ("p_brand", "note", "p_partkey", "p_name", "p_type", "p_retailprice", "p_size"))


def _malformed_parts(spark, d) -> str:
    """Parts in three files whose headers differ: every 7th name holds a line break, every 11th
    size is no number, every 13th record lacks its last field."""
    part = table(spark, d, "part")
    every = lambda n: F.col("p_partkey") % n == 0
    cells = {c: F.coalesce(F.col(c).cast("string"), F.lit("")) for c in part.columns}
    cells["p_size"] = F.concat(cells["p_size"], F.when(every(11), "x").otherwise(""))
    cells["p_name"] = F.concat(F.lit('"'), "p_name", F.when(every(7), "\nand more").otherwise(""),
                               F.lit('"'))
    cells["note"] = F.lit("a note")
    lines = []
    for i, header in enumerate(PART_HEADERS):
        own = part.where(F.col("p_partkey") % 3 == i)
        whole = F.concat_ws(";", *[cells[c] for c in header])
        torn = F.concat_ws(";", *[cells[c] for c in header[:-1]])
        lines.append(own.select(F.lit(i).alias("f"), F.lit(1).alias("nth"),
                                F.when(every(13), torn).otherwise(whole).alias("value")))
        lines.append(spark.createDataFrame([(i, 0, ";".join(header))], "f int, nth int, value string"))
    path = scratch_path(spark, "parts_malformed")
    (reduce(DataFrame.unionByName, lines).repartition("f").sortWithinPartitions("f", "nth")
     .drop("nth").write.partitionBy("f").text(path))
    return path


def q_scan_csv_malformed(spark, d):
    """Good records by name, and how many were rejected for what."""
    rows, rejected = read_csv_by_name(spark, f"{_malformed_parts(spark, d)}/f=*",
                                      schemas.DRIVER["part"], ";", multiline=True)
    return rows.withColumns({"reason": F.lit(None).cast("string"), "n": F.lit(1).cast("long")}).unionByName(
        rejected.groupBy("reason").agg(F.count("record").alias("n")), allowMissingColumns=True)


def q_sql_over_views(spark, d):
    table(spark, d, "orders").createOrReplaceTempView("sl_orders")
    table(spark, d, "customer").createOrReplaceTempView("sl_customer")
    return spark.sql("""
        SELECT c.c_mktsegment, count(o.o_orderkey) AS n_orders,
               max(o.o_totalprice) AS max_totalprice
        FROM sl_orders o JOIN sl_customer c ON o.o_custkey = c.c_custkey
        GROUP BY c.c_mktsegment""")


def q_label_sections(spark, d):
    return _entries(spark, d)


# --- sinks and actions ----------------------------------------------------------

def q_parquet_overwrite_roundtrip(spark, d):
    path = scratch_path(spark, "orders_overwrite")
    orders = table(spark, d, "orders")
    write_parquet(where_equal(orders, "o_orderstatus", "F"), path)
    write_parquet(orders, path)  # full overwrite replaces the first write
    return read_parquet(spark, path, schemas.DRIVER["orders"])


def q_preview_limit(spark, d):
    return preview(table(spark, d, "orders"), 20, ["o_orderkey"])


def q_row_count(spark, d):
    names = ["lineitem", "orders", "customer", "part", "supplier", "nation", "region"]
    return reduce(DataFrame.unionByName, [
        table(spark, d, n).agg(F.count(F.lit(1)).alias("n_rows"))
        .select(F.lit(n).alias("table_name"), "n_rows") for n in names])


# --- projections and casts --------------------------------------------------------

def q_project_rename(spark, d):
    return rename(table(spark, d, "orders"), {
        "o_orderkey": "id", "o_custkey": "person_id", "o_orderstatus": "status",
        "o_orderdate": "arrival_date"})


def q_project_quoted_names(spark, d):
    wide = table(spark, d, "part").select(
        F.col("p_partkey").alias("Part Key"), F.col("p_name").alias("Part Name"),
        F.col("p_retailprice").alias("Retail Price"), F.col("p_size").alias("Size-Class"))
    return rename(wide, {"Part Key": "part_key", "Part Name": "part_name",
                         "Retail Price": "retail_price", "Size-Class": "size_class"})


def q_cast_numeric(spark, d):
    return cast_columns(table(spark, d, "lineitem"), {
        "l_orderkey": ("bigint", "l_orderkey"), "l_linenumber": ("int", "l_linenumber"),
        "l_quantity": ("int", "quantity"), "l_extendedprice": ("bigint", "price_whole")})


def q_cast_char(spark, d):
    o = table(spark, d, "orders")
    return o.select("o_orderkey", char_cast("o_orderstatus").alias("status"),
                    char_cast("o_orderpriority", 1).alias("priority_code"))


def q_select_star(spark, d):
    return select_star(table(spark, d, "supplier"))


def q_map_element(spark, d):
    e = _entries(spark, d).where(F.col("fmt") == lb.COUNTRY_FMT)
    parsed = e.select(as_map({"code": F.col("code"), "country": F.col("label")}).alias("parsed"))
    return parsed.select(map_element("parsed", "code").alias("country_code"),
                         map_element("parsed", "country").alias("country_name"))


# --- filters ------------------------------------------------------------------------

def q_filter_eq(spark, d):
    return where_equal(table(spark, d, "lineitem"), "l_linenumber", 1)


def q_filter_string_eq(spark, d):
    return where_equal(table(spark, d, "customer"), "c_mktsegment", "BUILDING")


def q_require_columns(spark, d):
    o = table(spark, d, "orders").select(
        "o_orderkey", F.nullif("o_orderpriority", F.lit("5-LOW")).alias("priority"),
        F.nullif("o_orderstatus", F.lit("P")).alias("status"), "o_totalprice")
    return require_columns(o, ["priority", "status"])


# --- joins ----------------------------------------------------------------------------

def q_rows_at_group_max(spark, d):
    return rows_at_group_max(table(spark, d, "part"), ["p_brand"], "p_retailprice")


LINES_PER_TASK = 500_000


def q_role_playing_lookup(spark, d):
    li = table(spark, d, "lineitem").select("l_orderkey", "l_suppkey")
    o = table(spark, d, "orders").select("o_orderkey", "o_custkey", "o_orderpriority")
    c = table(spark, d, "customer").select("c_custkey", "c_nationkey")
    s = table(spark, d, "supplier").select("s_suppkey", "s_nationkey")
    # Lineitem rows meet the supplier first and shrink to distinct
    # (order, supplier nation) pairs, partially aggregated before the shuffle,
    # so a hot order collapses map-side; only those pairs meet the
    # orders-sized order/customer side. That join sorts both sides and holds the distinct
    # rows of a task, so its tasks become more with the rows, not larger.
    n = max(int(spark.conf.get("spark.sql.shuffle.partitions")), 1 + li.count() // LINES_PER_TASK)
    pairs = (li.join(bounded_broadcast(s), li.l_suppkey == s.s_suppkey)
             .select("l_orderkey", "s_nationkey").distinct().repartition(n, "l_orderkey"))
    orders = (o.join(c, o.o_custkey == c.c_custkey)
              .select("o_orderkey", "o_orderpriority", "c_nationkey").repartition(n, "o_orderkey"))
    staged = pairs.join(orders, pairs.l_orderkey == orders.o_orderkey)
    named = role_lookup(staged, table(spark, d, "nation"), "n_nationkey", "n_name",
                        {"c_nationkey": "customer_nation", "s_nationkey": "supplier_nation"})
    return distinct_projection(named, [F.col("l_orderkey").alias("order_key"),
                                       "customer_nation", "supplier_nation",
                                       F.col("o_orderpriority").alias("priority")])


def _cities(spark, d, keys):
    cities = rows_at_group_max(dfx.part_city_state(table(spark, d, "part")), keys,
                               "p_retailprice")
    entries = _entries(spark, d)
    ports = lb.ports(entries, lb.states(entries)).select(
        F.col("port_code").alias("city_code"), F.col("city").alias("port_city"),
        F.col("state_code").alias("port_state"))
    return cities, ports


def q_conform_by_name(spark, d):
    cities, ports = _cities(spark, d, ["city"])
    out = conform(cities, ports, {"city": "port_city"}, broadcast=False)
    return out.select("city", "state", "city_code", "port_state", "p_partkey", "p_retailprice")


def q_conform_by_name_state(spark, d):
    cities, ports = _cities(spark, d, ["city", "state"])
    out = conform(cities, ports, {"city": "port_city", "state": "port_state"},
                  broadcast=False)
    return out.select("city", "state", "city_code", "p_partkey", "p_retailprice")


def q_star_left_join(spark, d):
    f = table(spark, d, "lineitem").select(
        "l_orderkey", "l_linenumber",
        F.when(F.col("l_linenumber") != 7, F.col("l_suppkey")).alias("supp_key"))
    s = table(spark, d, "supplier").select("s_suppkey", "s_name")
    o = table(spark, d, "orders").select("o_orderkey", "o_orderpriority")
    out = star_join(f, [(s, "supp_key", "s_suppkey"), (o, "l_orderkey", "o_orderkey")])
    return out.select("l_orderkey", "l_linenumber", "s_name", "o_orderpriority")


def _hot_lineitem(spark, d):
    """Order lines of which every third is moved to the first order and the first supplier."""
    moved = F.col("l_partkey") % 3 == 0
    return table(spark, d, "lineitem").select(
        "l_orderkey", "l_linenumber",
        F.when(moved, F.lit(1).cast("bigint")).otherwise(F.col("l_orderkey").cast("bigint")).alias("person"),
        F.when(moved, F.lit(1).cast("bigint")).otherwise(F.col("l_suppkey").cast("bigint")).alias("port"))


def q_star_join_hot_keys(spark, d):
    f = _hot_lineitem(spark, d).withColumn(
        "port", F.when(F.col("l_linenumber") != 7, F.col("port")))
    s = table(spark, d, "supplier").select("s_suppkey", "s_name")
    o = table(spark, d, "orders").select("o_orderkey", "o_orderpriority")
    row = ["l_orderkey", "l_linenumber"]
    out = hot_key_join(f, s, {"port": "s_suppkey"}, row, "left")
    out = hot_key_join(out, o, {"person": "o_orderkey"}, row, "left")
    return out.select("l_orderkey", "l_linenumber", "person", "s_name", "o_orderpriority")


def q_top_market_hot_persons(spark, d):
    return top_market(
        _hot_lineitem(spark, d), table(spark, d, "supplier"), table(spark, d, "orders"),
        fact_id="l_orderkey", fact_port="port", fact_person="person",
        market_code="s_suppkey", market_name="s_name", market_size="s_acctbal",
        person_key="o_orderkey", person_attr="o_orderpriority", person_value="1-URGENT",
        out_name="market", out_count="n_facts", out_size="market_size", k=20,
        spread_by=["l_orderkey", "l_linenumber"])


def q_join_cast_key(spark, d):
    lk = (table(spark, d, "nation").select(F.col("n_nationkey").cast("string").alias("code"),
                                           F.col("n_name").alias("name"))
          .unionByName(table(spark, d, "region").select(F.col("r_name").alias("code"),
                                                        F.col("r_name").alias("name"))))
    out = cast_key_join(table(spark, d, "customer"), lk, "c_nationkey", "code", "int")
    return out.select("c_custkey", F.col("name").alias("nation_name"))


# --- aggregation and distinct ----------------------------------------------------------

def q_group_max(spark, d):
    return group_max(table(spark, d, "part"), "p_brand", "p_retailprice", "max_retailprice")


def q_group_count(spark, d):
    return group_count(table(spark, d, "orders"), ["o_orderstatus", "o_orderpriority"],
                       "o_orderkey", "n_orders")


def q_distinct_projection(spark, d):
    return distinct_projection(table(spark, d, "orders"), ["o_custkey", "o_orderstatus"])


def q_dedup_by_key(spark, d):
    c = table(spark, d, "customer")
    return first_by_key(c, "c_nationkey", [F.col("c_acctbal"), -F.col("c_custkey")],
                        descending=True)


# --- sort, limit, top-k ---------------------------------------------------------------

def q_distinct_sorted(spark, d):
    return sorted_distinct(table(spark, d, "orders"), ["o_custkey", "o_orderpriority"],
                           ["o_custkey", "o_orderpriority"])


def q_top_k_desc(spark, d):
    return top_k(table(spark, d, "customer"), 10, "c_acctbal", ["c_custkey"])


# --- scalar functions -------------------------------------------------------------------

def q_upper_case(spark, d):
    p = table(spark, d, "part")
    return p.select("p_partkey", upper_name("p_name").alias("city"),
                    upper_name("p_type").alias("type_upper"))


def q_surrogate_key(spark, d):
    ids = table(spark, d, "lineitem").select(F.monotonically_increasing_id().alias("id"))
    return ids.agg(F.count(F.lit(1)).alias("n"), F.count_distinct("id").alias("n_distinct"))


def q_sas_date_to_timestamp(spark, d):
    e = table(spark, d, "events").select("event_id", timestamp_to_sas_day("ts").alias("sas_day"))
    return e.select("event_id", "sas_day",
                    sas_day_to_timestamp("sas_day").alias("ts_back"),
                    sas_day_to_timestamp(F.floor("sas_day")).alias("day_start"))


def q_code_to_label(spark, d):
    li = table(spark, d, "lineitem")
    return li.select("l_orderkey", "l_linenumber", code_label("l_linenumber").alias("visa"))


def q_parse_region_code(spark, d):
    p = table(spark, d, "part").select(
        "p_partkey",
        F.when(F.col("p_size") % 2 == 0, F.concat_ws("-", "p_type", "p_name"))
        .otherwise(F.concat(F.lit("X-"), F.col("p_name"))).alias("iso_region"))
    return p.select("p_partkey", "iso_region", region_state("iso_region").alias("region"))


def q_parse_country_label(spark, d):
    return lb.countries(_entries(spark, d))


def q_parse_port_label(spark, d):
    entries = _entries(spark, d)
    return lb.ports(entries, lb.states(entries))


def q_parse_state_label(spark, d):
    return lb.states(_entries(spark, d))


def q_sql_function_surface(spark, d):
    register_sql_functions(spark)
    table(spark, d, "lineitem").createOrReplaceTempView("sl_lineitem")
    return spark.sql("""
        SELECT l_orderkey, l_linenumber,
               visa_category(l_linenumber) AS visa,
               region_state(l_returnflag || l_linestatus || '-' || l_returnflag || l_linestatus)
                   AS region,
               sas_to_timestamp(timestamp_to_sas(l_shipdate) + 0.5D) AS ship_noon
        FROM sl_lineitem""")


# --- composed: the star build on derived raw inputs ------------------------------------

def _lookups(spark, d):
    """Dictionary parsed once and kept as a small Parquet table (as in build_star)."""
    return star.load_lookups(spark, _dictionary(spark, d))


def _clean(spark, d):
    return star.clean_arrivals(afx.raw_arrivals(spark, d))


def q_star_clean_arrivals(spark, d):
    return _clean(spark, d).drop("id")


def q_star_fact(spark, d):
    return star.fact_immigration(_clean(spark, d)).drop("id")


def q_star_dim_personal(spark, d):
    return star.dim_personal(_clean(spark, d), _lookups(spark, d)["countries"],
                             one_row_per_key=False)


def q_star_dim_personal_keyed(spark, d):
    """One person row per month and number; among differing records the
    smallest attribute values (a total order, so the answer is defined)."""
    return star.dim_personal(_clean(spark, d), _lookups(spark, d)["countries"],
                             one_row_per_key=True)


def q_star_dim_flight(spark, d):
    return star.dim_flight(_clean(spark, d), one_row_per_key=False)


def star_inputs(spark, d) -> dict:
    """Raw inputs of the star build in their original formats, derived from
    the driver tables and written to the scratch folder."""
    arrivals = write_parquet(afx.raw_arrivals(spark, d), scratch_path(spark, "star_arrivals"))
    return {"arrivals": arrivals, **_other_inputs(spark, d)}


def _other_inputs(spark, d) -> dict:
    """The inputs beside the arrivals, for stars whose arrivals come in several loads."""
    root = scratch_path(spark, "star_inputs")
    return {
        "dictionary": _dictionary(spark, d),
        "demographics": write_csv(afx.demographics(spark, d), f"{root}/demographics", sep=";"),
        "airports": write_csv(afx.airports(spark, d), f"{root}/airports", sep=","),
    }


def q_star_build(spark, d):
    """The whole build (six tables written) on driver-derived inputs; rows
    and a digest of the contents per written table."""
    p = star_inputs(spark, d)
    out = star.build_star(spark, p["arrivals"], p["dictionary"], p["demographics"],
                          p["airports"], scratch_path(spark, "star_out"))
    return reduce(DataFrame.unionByName, [
        spark.read.parquet(path).agg(F.count(F.lit(1)).alias("n_rows"),
                                     _digest(STAR_DIGEST[name]).alias("digest"))
        .select(F.lit(name).alias("table_name"), "n_rows", "digest") for name, path in out.items()])


# A micro-batch has few files; with small row groups all cores read them.
LANDED_ROW_GROUP = 8 * 1024 * 1024


def _landed(df: DataFrame, name: str, partition_by: list[str] | None = None) -> str:
    """Arrivals written to a new folder, no more files than tasks that write at a time: a load's
    files, and so its micro-batches, do not become more with its rows. Partitions (months) have
    one file each."""
    if partition_by:
        df = df.repartition(*partition_by)
    else:
        df = df.coalesce(df.sparkSession.sparkContext.defaultParallelism)
    return write_parquet(df, scratch_path(df.sparkSession, name), partition_by=partition_by,
                         row_group_bytes=LANDED_ROW_GROUP)


# What the digest of each star table covers (ids are not comparable).
STAR_DIGEST = {name: [f.name for f in schema.fields if f.name != "id"]
               for name, schema in schemas.STAR_SCHEMAS.items()}


def _digest(columns: list[str]):
    """Sum of the first 28 bits of each row's MD5; times to the hour."""
    def text(c):
        value = F.date_format(c, "yyyyMMddHH") if c.endswith("_date") else F.col(c).cast("string")
        return F.coalesce(value, F.lit("~"))
    row = F.md5(F.concat_ws("|", *[text(c) for c in columns]).cast("binary"))
    return F.sum(F.conv(F.substring(row, 1, 7), 16, 10).cast("bigint"))


def q_star_monthly_refresh(spark, d):
    """Build a refreshable star from the arrivals shipped before 1997, then
    stream the later months into it (one folder per month, 12 files per
    micro-batch); the refreshed fact equals a one-shot build."""
    from ..streaming import refresh_star
    raw = afx.raw_arrivals(spark, d).withColumn("ym", F.col("i94yr") * 100 + F.col("i94mon"))
    early = _landed(raw.where(F.col("i94yr") < 1997).drop("ym"), "arrivals_early")
    late = _landed(raw.where(~(F.col("i94yr") < 1997) | F.col("i94yr").isNull()), "arrivals_late",
                   ["ym"])
    p = _other_inputs(spark, d)
    out = scratch_path(spark, "star_refreshed")
    star.build_star(spark, early, p["dictionary"], p["demographics"], p["airports"], out,
                    refreshable=True)
    refresh_star(spark, f"{late}/ym=*", out, p["dictionary"],
                 max_files_per_trigger=12).awaitTermination()
    return star.read_star(spark, out)["fact_immigration"].drop("id")


def _late_refreshed(spark, d) -> tuple[str, DataFrame]:
    """A refreshable star of all months before 1997 but one, then two refresh runs
    from different landing folders: the months from 1997 on, then the older
    month that came late. Returns the folder and the raw arrivals."""
    from ..streaming import refresh_star
    raw = afx.raw_arrivals(spark, d)
    late = (F.col("i94yr") == 1996) & (F.col("i94mon") == 3)
    parts = {"first": (F.col("i94yr") < 1997) & ~late, "next": ~(F.col("i94yr") < 1997), "late": late}
    paths = {k: _landed(raw.where(c), f"arrivals_{k}") for k, c in parts.items()}
    p = _other_inputs(spark, d)
    labels = star.load_lookups(spark, p["dictionary"])
    out = scratch_path(spark, "star_late")
    star.build_star(spark, paths["first"], labels, p["demographics"], p["airports"], out,
                    refreshable=True)
    for k in ("next", "late"):
        refresh_star(spark, paths[k], out, labels, max_files_per_trigger=3).awaitTermination()
    return out, raw


def q_star_refresh_personal(spark, d):
    return star.read_star(spark, _late_refreshed(spark, d)[0])["dim_personal"]


def q_star_refresh_flight(spark, d):
    """Compacted half way, which changes nothing for the reader."""
    out, _ = _late_refreshed(spark, d)
    star.compact_star(spark, out)
    return star.read_star(spark, out)["dim_flight"]


def q_star_refresh_ids(spark, d):
    ids = star.read_star(spark, _late_refreshed(spark, d)[0])["fact_immigration"].select("id")
    return ids.agg(F.count("id").alias("n"), F.count_distinct("id").alias("n_distinct"))


def _loads(spark, d, parts: dict, raw: DataFrame | None = None) -> tuple[str, dict, dict]:
    """A refreshable star of the arrivals of the first of ``parts`` (name: condition); returns
    its folder, the landing folder of every part and the dictionary's lookups."""
    raw = afx.raw_arrivals(spark, d) if raw is None else raw
    paths = {k: _landed(raw.where(c), f"arrivals_{k}") for k, c in parts.items()}
    p = _other_inputs(spark, d)
    labels = star.load_lookups(spark, p["dictionary"])
    out = scratch_path(spark, "star_loaded")
    star.build_star(spark, next(iter(paths.values())), labels, p["demographics"], p["airports"],
                    out, refreshable=True)
    return out, paths, labels


def q_star_compact_rerun(spark, d):
    """Persons after a refresh, a load that failed before its commit, a compaction, the same
    load again and a second compaction."""
    from ..sources.files import with_place
    from ..streaming import refresh_star
    from ..streaming.refresh import write_arrivals
    late = (F.col("i94yr") == 1996) & (F.col("i94mon") == 3)
    out, paths, labels = _loads(spark, d, {"first": (F.col("i94yr") < 1997) & ~late,
                                           "next": F.col("i94yr") >= 1997, "late": late})
    refresh_star(spark, paths["next"], out, labels).awaitTermination()
    landed = with_place(read_parquet(spark, paths["late"], schemas.ARRIVALS_RAW))
    write_arrivals(spark, landed, out, star.load_lookups(spark, labels)["countries"])
    star.compact_star(spark, out)
    refresh_star(spark, paths["late"], out, labels).awaitTermination()
    star.compact_star(spark, out)
    return star.read_star(spark, out)["dim_personal"]


def q_star_refresh_ledger(spark, d):
    """Facts after the same months have landed under three spellings of their folder, one of
    them the folder that the star was built from."""
    from ..streaming import refresh_star
    raw = afx.raw_arrivals(spark, d).withColumn("year", F.col("i94yr").cast("int"))
    root = write_parquet(raw, scratch_path(spark, "arrivals_by_year"), partition_by=["year"])
    p = _other_inputs(spark, d)
    out = scratch_path(spark, "star_ledger")
    star.build_star(spark, f"{root}/year=1996", p["dictionary"], p["demographics"], p["airports"],
                    out, refreshable=True)
    for spelled in (f"{root}/year=199[67]", f"{root}/*", f"{root}/../{root.rsplit('/', 1)[1]}/year=*"):
        refresh_star(spark, spelled, out, p["dictionary"]).awaitTermination()
    return star.read_star(spark, out)["fact_immigration"].drop("id")


def q_star_stable_ids(spark, d):
    """Arrivals staged twice, the second time in other splits: ids, different ids, and rows that are
    equal with their id."""
    path = write_parquet(afx.raw_arrivals(spark, d), scratch_path(spark, "arrivals_twice"))
    first, _ = star.stage_arrivals(spark, path)
    key = "spark.sql.files.maxPartitionBytes"
    before = spark.conf.get(key)
    spark.conf.set(key, "64k")
    try:
        second, _ = star.stage_arrivals(spark, path)
    finally:
        spark.conf.set(key, before)
    both = first.join(second.withColumnsRenamed({c: f"{c}_2" for c in second.columns}),
                      F.col("id") == F.col("id_2"))
    same = reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"{c}_2")) for c in first.columns])
    return both.agg(F.count("id").alias("n"), F.count_distinct("id").alias("n_distinct"),
                    F.count(F.when(same, 1)).alias("n_equal"))


def _summary_star(spark, d) -> str:
    """A star whose second load changes persons of the first: records of one person differ in
    gender, and the younger ones, which decide, come last."""
    from ..streaming import refresh_star
    raw = afx.raw_arrivals(spark, d).withColumn("gender", F.when(
        F.col("gender").isNotNull(), F.when(F.col("i94visa") % 2 == 0, "F").otherwise("M")))
    out, paths, labels = _loads(spark, d, {"old": F.col("i94bir") >= 30, "young": F.col("i94bir") < 15,
                                           "middle": F.col("i94bir").between(15, 29)}, raw)
    for part in ("young", "middle"):
        refresh_star(spark, paths[part], out, labels).awaitTermination()
    return out


def q_star_summary_counts(spark, d):
    """Arrivals per month, port and gender as the refreshes have kept them, compacted at last."""
    out = _summary_star(spark, d)
    star.compact_star(spark, out)
    return star.read_summary(spark, out)


def q_star_summary_answer(spark, d):
    """The OLAP question from the kept counts."""
    out = _summary_star(spark, d)
    return top_female_port_city_by_counts(star.read_summary(spark, out),
                                          star.read_star(spark, out)["dim_city_population"])


def q_star_rebuild_dynamic(spark, d):
    """A star rebuilt from fewer months, in a session that asks for dynamic
    overwrite, holds these months only."""
    raw = afx.raw_arrivals(spark, d)
    key = "spark.sql.sources.partitionOverwriteMode"
    before, out = spark.conf.get(key), scratch_path(spark, "fact_rebuilt")
    spark.conf.set(key, "dynamic")
    try:
        for part in (raw, raw.where("i94yr = 1997")):
            write_parquet(star.fact_immigration(star.clean_arrivals(part)), out,
                          partition_by=["year", "month"])
    finally:
        spark.conf.set(key, before)
    return spark.read.parquet(out).groupBy("year", "month").agg(F.count("id").alias("n_rows"))


def q_star_person_per_month(spark, d):
    """Person numbers that mean a woman in even months and a man in odd ones:
    arrivals of women per city are counted within the month."""
    raw = afx.raw_arrivals(spark, d).withColumn(
        "gender", F.when(F.col("gender").isNotNull(),
                         F.when(F.col("i94mon") % 2 == 0, "F").otherwise("M")))
    lk = _lookups(spark, d)
    staged = spark.read.parquet(write_parquet(star.clean_arrivals(raw),
                                              scratch_path(spark, "arrivals_gender")))
    return top_female_port_city(star.fact_immigration(staged),
                                star.dim_city_population(_demog_cities(spark, d), lk["ports"]),
                                star.dim_personal(staged, lk["countries"], one_row_per_key=True))


def q_star_tied_cities(spark, d):
    """Every city has two groups of equal count: one row per city stays and
    no arrival counts twice."""
    demog = afx.demographics(spark, d)
    tied = demog.unionByName(demog.withColumn("Race", F.concat(F.lit("~"), F.col("Race"))))
    lk = _lookups(spark, d)
    staged = spark.read.parquet(write_parquet(_clean(spark, d), scratch_path(spark, "arrivals_tied")))
    cities = star.majority_rows(tied, tie_break="Race")
    return top_female_port_city(star.fact_immigration(staged),
                                star.dim_city_population(cities, lk["ports"]),
                                star.dim_personal(staged, lk["countries"], one_row_per_key=True))


def q_star_dim_airports(spark, d):
    return star.us_airports(afx.airports(spark, d))


def _demog_cities(spark, d):
    return star.majority_rows(afx.demographics(spark, d), ("City", "State"))


def q_star_dim_city_population(spark, d):
    return star.dim_city_population(_demog_cities(spark, d), _lookups(spark, d)["ports"])


def q_star_dim_city_stats(spark, d):
    return star.dim_city_stats(_demog_cities(spark, d), _lookups(spark, d)["ports"])


def q_star_top_female_port_city(spark, d):
    """The original OLAP question on a star built from the driver tables.

    As in build_star: the cleaned arrivals are staged once in the scratch
    folder (fact and person dimension both read them) and the dictionary is
    parsed once.
    """
    lk = _lookups(spark, d)
    staged = spark.read.parquet(write_parquet(_clean(spark, d),
                                              scratch_path(spark, "arrivals_clean")))
    return top_female_port_city(star.fact_immigration(staged),
                                star.dim_city_population(_demog_cities(spark, d), lk["ports"]),
                                star.dim_personal(staged, lk["countries"], one_row_per_key=True))


# --- streaming: monthly refresh -------------------------------------------------------

def _orders_fact(df: DataFrame, batch_id: int) -> DataFrame:
    return df.where(F.col("o_orderstatus") != "P").select(
        F.col("o_orderkey").alias("id"), F.col("o_custkey").alias("person_id"),
        F.year("o_orderdate").alias("year"), F.month("o_orderdate").alias("month"),
        F.col("o_orderpriority").alias("priority"), "o_totalprice")


def q_fact_monthly_refresh(spark, d):
    """Orders arrive as one folder per month; a stream loads them (20 files
    per micro-batch) into a fact table partitioned by year and month."""
    landing = scratch_path(spark, "orders_landing")
    o = table(spark, d, "orders")
    write_parquet(o.withColumn("ym", F.date_format("o_orderdate", "yyyyMM")), landing,
                  partition_by=["ym"])
    target = scratch_path(spark, "orders_fact")
    q = start_refresh(spark, f"{landing}/ym=*", target, _orders_fact, schemas.DRIVER["orders"],
                      max_files_per_trigger=20)
    q.awaitTermination()
    return read_refreshed(spark, target)


# --- data quality -----------------------------------------------------------------------

DQ_TABLES = ["orders", "lineitem", "customer", "part", "supplier", "nation", "region"]


def q_dq_schema(spark, d):
    """The driver tables against their declarations, and one that fails: orders
    with a narrowed key, a missing and an undeclared column."""
    tables = {n: (table(spark, d, n, declared=False), schemas.DRIVER[n]) for n in DQ_TABLES}
    o = table(spark, d, "orders")
    tables["orders_altered"] = (
        o.select(F.col("o_orderkey").cast("int").alias("o_orderkey"),
                 *[c for c in o.columns if c not in ("o_orderkey", "o_orderpriority")],
                 F.nullif("o_orderstatus", F.lit("P")).alias("o_extra")), schemas.DRIVER["orders"])
    return dq_schema(spark, tables)


def q_dq_non_empty(spark, d):
    return dq_non_empty({n: table(spark, d, n) for n in DQ_TABLES})


PK_CHECKS = [("orders", ["o_orderkey"]), ("customer", ["c_custkey"]), ("part", ["p_partkey"]),
             ("supplier", ["s_suppkey"]), ("lineitem", ["l_orderkey", "l_linenumber"]),
             ("lineitem", ["l_orderkey"])]


def q_dq_pk_unique(spark, d):
    return reduce(DataFrame.unionByName, [dq_pk_unique(table(spark, d, t), k, t)
                                          for t, k in PK_CHECKS])


FK_CHECKS = [("lineitem", "l_orderkey", "orders", "o_orderkey", None),
             ("lineitem", "l_suppkey", "supplier", "s_suppkey", None),
             ("lineitem", "l_partkey", "part", "p_partkey", None),
             ("orders", "o_custkey", "customer", "c_custkey", None),
             ("customer", "c_nationkey", "nation", "n_nationkey", None),
             ("orders", "o_custkey", "customer", "c_custkey", "c_mktsegment = 'BUILDING'")]


def _relation_name(child, fk, parent, pk, where):
    return f"{child}.{fk}->{parent}.{pk}" + (f" [{where}]" if where else "")


def q_dq_fk_orphans(spark, d):
    parts = []
    for child in dict.fromkeys(c[0] for c in FK_CHECKS):  # one scan per child table
        relations = []
        for c, fk, parent, pk, where in FK_CHECKS:
            if c == child:
                p = table(spark, d, parent)
                relations.append((_relation_name(c, fk, parent, pk, where), [fk],
                                  p.where(where) if where else p, [pk]))
        parts.append(dq_references(table(spark, d, child), relations))
    return reduce(DataFrame.unionByName, parts)


def q_dq_fk_orphans_single(spark, d):
    """One reference by a join of distinct keys."""
    return dq_fk_orphans(table(spark, d, "orders"), "o_custkey",
                         table(spark, d, "customer").where("c_mktsegment = 'BUILDING'"), "c_custkey",
                         "orders.o_custkey->customer.c_custkey")


def _orders_with_gaps(spark, d):
    return table(spark, d, "orders").select(
        "o_orderkey", F.nullif("o_orderpriority", F.lit("5-LOW")).alias("o_orderpriority"),
        F.nullif("o_orderstatus", F.lit("P")).alias("o_orderstatus"), "o_totalprice")


def q_dq_null_profile(spark, d):
    return dq_null_profile(_orders_with_gaps(spark, d), "orders")


QUERIES = {name[2:]: fn for name, fn in sorted(globals().items())
           if name.startswith("q_") and callable(fn)}
