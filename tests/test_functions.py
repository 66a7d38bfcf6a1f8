"""Native expressions replacing the row UDFs."""

import datetime as dt

from hypothesis import given, settings, strategies as st

from starloom.functions import (char_cast, code_label, region_state, register_sql_functions,
                                sas_day_to_timestamp, timestamp_to_sas_day)


def _one(spark, col, rows, schema):
    return [r[0] for r in spark.createDataFrame(rows, schema).select(col).collect()]


def test_sas_day_to_timestamp(spark):
    got = _one(spark, sas_day_to_timestamp("d"), [(20574.0,), (20574.5,), (None,), (0.0,)],
               "d double")
    assert got == [dt.datetime(2016, 4, 30), dt.datetime(2016, 4, 30, 12),
                   None, dt.datetime(1960, 1, 1)]


def test_sas_day_out_of_range_is_null(spark):
    assert _one(spark, sas_day_to_timestamp("d"), [(1e300,)], "d double") == [None]


@settings(max_examples=40, deadline=None)
@given(st.integers(min_value=-200_000_000_000_000, max_value=3_000_000_000_000_000))
def test_sas_roundtrip_is_exact(spark, micros):
    ts = dt.datetime(1960, 1, 1) + dt.timedelta(microseconds=micros)
    df = spark.createDataFrame([(ts,)], "t timestamp_ntz")
    back = df.select(sas_day_to_timestamp(timestamp_to_sas_day("t"))).first()[0]
    assert back == ts


def test_code_label_numeric_and_unknown(spark):
    got = _one(spark, code_label("v"), [(1.0,), (2.0,), (3.0,), (4.0,), (None,)], "v double")
    assert got == ["Business", "Pleasure", "Student", None, None]


def test_code_label_string_map(spark):
    got = _one(spark, code_label("c", {"A": "Alpha"}), [("A",), ("B",)], "c string")
    assert got == ["Alpha", None]


def test_region_state(spark):
    got = _one(spark, region_state("r"), [("US-CA",), ("US-U-A",), (None,), ("XUS-NY-Q",)],
               "r string")
    assert got == ["CA", None, None, "NY"]


def test_char_cast_is_string_no_cut_by_default(spark):
    got = _one(spark, char_cast("s"), [("ABCDE",)], "s string")
    assert got == ["ABCDE"]
    assert _one(spark, char_cast("s", 3), [("ABCDE",)], "s string") == ["ABC"]


def test_sql_functions_match_dataframe_functions(spark):
    register_sql_functions(spark)
    df = spark.createDataFrame([(20574.5, 1.0, "US-WA"), (None, 4.0, "XX")],
                               "d double, v double, r string")
    df.createOrReplaceTempView("fn_probe")
    sql = spark.sql("SELECT sas_to_timestamp(d) a, visa_category(v) b, region_state(r) c "
                    "FROM fn_probe").collect()
    api = df.select(sas_day_to_timestamp("d"), code_label("v"), region_state("r")).collect()
    assert [tuple(r) for r in sql] == [tuple(r) for r in api]
    plan = spark.sql("SELECT visa_category(v) FROM fn_probe")._jdf.queryExecution() \
        .executedPlan().toString()
    assert "Python" not in plan


def test_sql_label_parsers_match_dataframe_functions(spark):
    from starloom.functions import text as tx
    from tests import fixtures as fx
    register_sql_functions(spark)
    lines = [(l,) for l in fx.DICTIONARY.splitlines()]
    df = spark.createDataFrame(lines, "line string")
    df.createOrReplaceTempView("dict_lines")
    sql = spark.sql("""SELECT label_code(line) c, label_text(line) t,
                              port_city(label_text(line)) pc, port_state(label_text(line)) ps
                       FROM dict_lines""").collect()
    lab = tx.entry_label(df.line)
    api = df.select(tx.entry_code(df.line), lab, tx.port_city_candidate(lab),
                    tx.port_state_candidate(lab)).collect()
    assert [tuple(r) for r in sql] == [tuple(r) for r in api]
    got = {r.c: (r.pc, r.ps) for r in sql if r.c == "OMA"}
    assert got == {"OMA": ("O'MALLEY POINT", "MN")}


def test_sas_day_does_not_depend_on_the_session_zone(spark):
    """02:30 on the day the clocks go forward in Los Angeles."""
    from pyspark.sql import functions as F

    from starloom.functions import (register_sql_functions, sas_day_to_timestamp,
                                    timestamp_to_sas_day)
    old = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/Los_Angeles")
        register_sql_functions(spark)
        for text in ("2016-03-13 02:30:00", "2016-11-06 01:30:00.000001", "1959-12-31 23:59:59.5",
                     "1883-11-18 12:05:00"):
            df = spark.sql(f"SELECT TIMESTAMP_NTZ'{text}' AS t")
            row = df.select("t", sas_day_to_timestamp(timestamp_to_sas_day("t")).alias("a"),
                            F.expr("sas_to_timestamp(timestamp_to_sas(t))").alias("b")).first()
            assert row.a == row.t == row.b
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
