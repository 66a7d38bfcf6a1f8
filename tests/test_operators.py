"""Operators against their plain SQL definitions, incl. NULLs and ties."""


import pytest
from hypothesis import given, settings, strategies as st

from starloom.operators import (bounded_broadcast, cast_key_join, conform, dq_fk_orphans,
                                dq_non_empty, dq_null_profile, dq_pk_unique, dq_schema,
                                first_by_key, group_count, raise_on_failure, require_columns,
                                role_lookup, rows_at_group_max, top_k)
from starloom import schemas

keys = st.one_of(st.none(), st.sampled_from(["a", "b", "c"]))
vals = st.one_of(st.none(), st.integers(min_value=0, max_value=4))


@settings(max_examples=25, deadline=None)
@given(st.lists(st.tuples(keys, vals, st.integers(0, 1000)), max_size=30))
def test_rows_at_group_max_equals_self_join(spark, rows):
    df = spark.createDataFrame(rows, "k string, m int, id int")
    df.createOrReplaceTempView("gm")
    want = spark.sql("""SELECT a.* FROM gm a JOIN (SELECT k, max(m) AS m FROM gm GROUP BY k) b
                        ON a.k = b.k AND a.m = b.m""").collect()
    got = rows_at_group_max(df, "k", "m").collect()
    assert sorted(map(tuple, got)) == sorted(map(tuple, want))


@settings(max_examples=25, deadline=None)
@given(st.lists(st.tuples(keys, vals, st.integers(0, 50)), max_size=30))
def test_first_by_key_equals_row_number(spark, rows):
    df = spark.createDataFrame(rows, "k string, m int, id int")
    df.createOrReplaceTempView("fk")
    want = spark.sql("""SELECT k, m, id FROM (SELECT *, row_number() OVER (PARTITION BY k
                        ORDER BY m DESC NULLS LAST, id DESC) rn FROM fk) WHERE rn = 1""").collect()
    got = first_by_key(df, "k", ["m", "id"], descending=True).collect()
    assert sorted(map(tuple, got), key=str) == sorted(map(tuple, want), key=str)


def test_require_columns_keeps_nan(spark):
    df = spark.createDataFrame([(1, float("nan")), (2, None), (3, 1.0)], "id int, x double")
    got = sorted(r.id for r in require_columns(df, ["x"]).collect())
    assert got == [1, 3]
    assert df.dropna().count() == 1  # why dropna is not used


def test_role_lookup_keeps_unknown_codes(spark):
    facts = spark.createDataFrame([(1, 10, 20), (2, 10, 99)], "id int, cit int, res int")
    lk = spark.createDataFrame([(10, "TEN"), (20, "TWENTY")], "code int, name string")
    got = {r.id: (r.cit_name, r.res_name) for r in
           role_lookup(facts, lk, "code", "name", {"cit": "cit_name", "res": "res_name"})
           .collect()}
    assert got == {1: ("TEN", "TWENTY"), 2: ("TEN", None)}


def test_conform_fans_out_on_shared_names(spark):
    left = spark.createDataFrame([("X", "AA"), ("Y", "BB")], "city string, st string")
    lk = spark.createDataFrame([("X", "AA", "c1"), ("X", "CC", "c2"), ("Z", "AA", "c3")],
                               "pcity string, pst string, code string")
    by_name = conform(left, lk, {"city": "pcity"}).collect()
    assert sorted(r.code for r in by_name) == ["c1", "c2"]
    by_both = conform(left, lk, {"city": "pcity", "st": "pst"}).collect()
    assert [r.code for r in by_both] == ["c1"]


def test_cast_key_join_ignores_text_codes(spark):
    left = spark.createDataFrame([(1,), (2,)], "k int")
    right = spark.createDataFrame([("1", "one"), ("two", "x"), ("2", "deux")], "c string, v string")
    got = sorted((r.k, r.v) for r in cast_key_join(left, right, "k", "c", "int").collect())
    assert got == [(1, "one"), (2, "deux")]


def test_top_k_ties_and_nulls(spark):
    df = spark.createDataFrame([(1, 5.0), (2, None), (3, 5.0), (4, 1.0)], "id int, m double")
    assert [r.id for r in top_k(df, 3, "m", ["id"]).collect()] == [1, 3, 4]


def test_group_count_counts_non_null(spark):
    df = spark.createDataFrame([("a", 1), ("a", None), ("b", 2)], "k string, v int")
    got = {r.k: r.n for r in group_count(df, "k", "v").collect()}
    assert got == {"a": 1, "b": 1}


def test_bounded_broadcast(spark):
    small = spark.range(5)
    big = spark.range(50)
    assert "broadcast" in str(bounded_broadcast(small, 10)._jdf.queryExecution().logical()).lower()
    assert "broadcast" not in str(bounded_broadcast(big, 10)._jdf.queryExecution().logical()).lower()


def test_bounded_broadcast_checks_bytes(spark):
    def hinted(df):
        return "broadcast" in str(df._jdf.queryExecution().logical()).lower()
    wide = spark.createDataFrame([(i, "x" * 1000) for i in range(5)], "k int, v string")
    assert hinted(bounded_broadcast(wide, 10, max_bytes=100_000))
    assert not hinted(bounded_broadcast(wide, 10, max_bytes=4_000))  # few rows, too many bytes
    nested = spark.createDataFrame([(1, [1, 2])], "k int, a array<int>")
    assert not hinted(bounded_broadcast(nested, 10))


# --- quality -----------------------------------------------------------------

def test_dq_pk_unique(spark):
    df = spark.createDataFrame([(1,), (1,), (2,), (None,)], "k int")
    r = dq_pk_unique(df, "k", "t").first()
    assert (r.n_rows, r.n_null_keys, r.n_keys, r.n_duplicate_keys, r.ok) == (4, 1, 3, 1, False)


def test_dq_fk_orphans(spark):
    child = spark.createDataFrame([(1,), (1,), (5,), (5,), (None,), (6,)], "fk int")
    parent = spark.createDataFrame([(1,), (2,)], "pk int")
    r = dq_fk_orphans(child, "fk", parent, "pk", "c->p").first()
    assert (r.n_rows, r.n_null_fk, r.n_orphan_rows, r.n_orphan_keys, r.ok) == (6, 1, 3, 2, False)


def test_dq_non_empty_and_raise(spark):
    res = dq_non_empty({"full": spark.range(3), "empty": spark.range(0)})
    got = {r.table_name: (r.n_rows, r.ok) for r in res.collect()}
    assert got == {"full": (3, True), "empty": (0, False)}
    with pytest.raises(ValueError, match="empty"):
        raise_on_failure(res)


def test_dq_schema(spark):
    df = spark.createDataFrame([(1, "x")], "a bigint, b string")
    want = schemas._s(("a", schemas.L), ("c", schemas.S))
    got = {r.column_name: (r.expected_type, r.actual_type, r.ok)
           for r in dq_schema(spark, {"t": (df, want)}).collect()}
    assert got == {"a": ("bigint", "bigint", True), "c": ("string", None, False),
                   "b": (None, "string", False)}


def test_dq_null_profile(spark):
    df = spark.createDataFrame([(1, None), (2, "x"), (None, None), (4, "y")], "a int, `b c` string")
    got = {r.column_name: (r.n_rows, r.n_null, r.null_fraction)
           for r in dq_null_profile(df, "t").collect()}
    assert got == {"a": (4, 1, 0.25), "b c": (4, 2, 0.5)}


def test_conform_with_same_key_names_keeps_one_column(spark):
    left = spark.createDataFrame([("X", 1)], "city string, n int")
    lk = spark.createDataFrame([("X", "c1")], "city string, code string")
    out = conform(left, lk, {"city": "city"})
    assert out.columns == ["city", "n", "code"]
    assert [tuple(r) for r in out.select("city", "code").collect()] == [("X", "c1")]


def test_sorted_distinct_returns_rows_in_order(spark):
    from starloom.operators import sorted_distinct
    df = spark.createDataFrame([(3, "b"), (1, "a"), (3, "b"), (2, None), (None, "z")],
                               "k int, v string")
    got = [tuple(r) for r in sorted_distinct(df, ["k", "v"], ["k"]).collect()]
    assert got == [(None, "z"), (1, "a"), (2, None), (3, "b")]


def test_clustered_for_write_ranges_are_disjoint_and_sorted(spark):
    from pyspark.sql import functions as F
    from starloom.operators import clustered_for_write
    df = spark.range(1000).select((F.col("id") * 7919 % 1000).alias("k"))
    parts = clustered_for_write(df, ["k"], 4).rdd.glom().map(
        lambda rows: [r.k for r in rows]).collect()
    flat = [k for p in parts for k in p]
    assert flat == sorted(flat) and len(flat) == 1000
    assert sum(1 for p in parts if p) > 1
