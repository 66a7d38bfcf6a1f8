"""Readers, writers and the scratch location."""

from starloom import schemas
from starloom.session import scratch_dir, scratch_path
from starloom.sources.files import read_csv, write_csv
from tests import fixtures as fx


def test_scratch_dir_uses_session_checkpoint_dir(spark):
    d = scratch_dir(spark)
    assert d == (spark.conf.get("spark.checkpoint.dir", None)
                 or spark.sparkContext.getCheckpointDir()).rstrip("/")
    a, b = scratch_path(spark, "x"), scratch_path(spark, "x")
    assert a != b and a.startswith(d)


def test_scratch_dir_refuses_machine_local_folder_on_a_cluster():
    import pytest

    class Conf:
        def get(self, key, default=None):
            return {"spark.master": "yarn"}.get(key, default)

    class ClusterSession:  # cluster master, no checkpoint folder, no local context
        conf = Conf()

        @property
        def sparkContext(self):
            raise RuntimeError("no SparkContext")

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        scratch_dir(ClusterSession())


def test_csv_declared_schema_vs_inference(spark, tmp_dir):
    path = f"{tmp_dir}/demog.csv"
    with open(path, "w") as fh:
        fh.write(fx.DEMOGRAPHICS)
    declared = read_csv(spark, path, sep=";", schema=schemas.DEMOGRAPHICS_RAW)
    inferred = read_csv(spark, path, sep=";", infer=True)
    assert declared.schema == schemas.DEMOGRAPHICS_RAW
    assert declared.count() == inferred.count() == 12
    assert {f.name for f in inferred.schema.fields} == set(schemas.DEMOGRAPHICS_RAW.fieldNames())


def test_csv_roundtrip_quoted_comma(spark, tmp_dir):
    df = spark.createDataFrame([(1, "-74.93, 40.07"), (2, None)], "id int, coordinates string")
    back = read_csv(spark, write_csv(df, f"{tmp_dir}/c", sep=","), sep=",",
                    schema=df.schema).collect()
    assert sorted(map(tuple, back), key=str) == sorted(map(tuple, df.collect()), key=str)


def test_csv_latin1(spark, tmp_dir):
    path = f"{tmp_dir}/latin1.csv"
    with open(path, "w", encoding="latin-1") as fh:
        fh.write("City;Count\nSão Paulo;3\n")
    got = read_csv(spark, path, sep=";", schema="City string, Count int",
                   encoding="ISO-8859-1").collect()
    assert [tuple(r) for r in got] == [("São Paulo", 3)]


def _csv(tmp_dir, **files):
    import os
    os.makedirs(f"{tmp_dir}/csv", exist_ok=True)
    for name, text in files.items():
        with open(f"{tmp_dir}/csv/{name}.csv", "w", encoding="utf-8", newline="") as f:
            f.write(text)
    return f"{tmp_dir}/csv"


CSV_SCHEMA = "id int, name string, size double"


def test_csv_columns_are_found_by_name(spark, tmp_dir):
    from pyspark.sql.types import StructType

    from starloom.sources.files import read_csv_by_name
    path = _csv(tmp_dir, a="id,name,size\n1,x,1.5\n", b="﻿size, more ,name,id\n2.5,-,\"y, z\",2\n,,,3\n",
                c="name,id,size\n", d="")
    got = read_csv_by_name(spark, path, StructType.fromDDL(CSV_SCHEMA))
    assert sorted(map(tuple, got.rows.collect())) == [(1, "x", 1.5), (2, "y, z", 2.5), (3, None, None)]
    assert got.rejected.collect() == []
    assert got.rows.select("name").count() == 3


def test_csv_malformed_records_are_kept_apart(spark, tmp_dir):
    from pyspark.sql.types import StructType

    from starloom.sources.files import read_csv_by_name
    path = _csv(tmp_dir, a='id,name,size\n1,a,1\n2,b\n3,c,3,extra\n4x,d,4\n5.5,e,5\n99999999999,f,x\n6,"two\nlines",6\n')
    schema = StructType.fromDDL(CSV_SCHEMA)
    got = read_csv_by_name(spark, path, schema, multiline=True)
    assert sorted(map(tuple, got.rows.collect())) == [(1, "a", 1.0), (6, "two\nlines", 6.0)]
    bad = {r.record.split(",")[0]: r for r in got.rejected.collect()}
    assert {k: r.reason for k, r in bad.items()} == {
        "2": "number of fields", "3": "number of fields", "4x": "id: not int", "5.5": "id: not int",
        "99999999999": "id: not int; size: not double"}
    assert all(r.file.endswith("/a.csv") and r.block == 0 for r in bad.values())
    # line by line, a quoted line break is two torn records, not two false rows
    torn = read_csv_by_name(spark, path, schema)
    assert [tuple(r) for r in torn.rows.collect()] == [(1, "a", 1.0)] and torn.rejected.count() == 7
    # whatever columns are asked for
    assert torn.rows.select("name").count() == torn.rows.count() == 1


def test_csv_header_must_fit(spark, tmp_dir):
    import pytest
    from pyspark.sql.types import StructType

    from starloom.sources.files import read_csv_by_name
    schema = StructType.fromDDL(CSV_SCHEMA)
    for text in ("id,name\n1,x\n", "id,name,size,id\n1,x,2,3\n"):
        with pytest.raises(ValueError, match="header of"):
            read_csv_by_name(spark, _csv(tmp_dir, a=text), schema)
    assert read_csv_by_name(spark, _csv(tmp_dir, a=""), schema).rows.collect() == []


def test_build_reports_records_it_cannot_read(spark, tmp_dir):
    """Reordered airports columns change nothing; a torn and an ill-typed record are kept apart."""
    from starloom.plans import star
    from tests import fixtures as fx
    p = fx.write_inputs(spark, f"{tmp_dir}/in")
    want = star.build_star(spark, p["arrivals"], p["dictionary"], p["demographics"], p["airports"],
                           f"{tmp_dir}/plain")
    text = "".join(r.value + "\n" for r in spark.read.text(p["airports"]).collect())
    import csv
    import io
    rows = list(csv.reader(io.StringIO(text)))
    out = io.StringIO()
    csv.writer(out, lineterminator="\n").writerows([r[::-1] for r in rows])
    path = _csv(tmp_dir, airports=out.getvalue() + "only,three,fields\n"
                + ",".join(["x"] * rows[0][::-1].index("elevation_ft") + ["high"]
                           + ["x"] * rows[0].index("elevation_ft")) + "\n")
    got = star.build_star(spark, p["arrivals"], p["dictionary"], p["demographics"], path, f"{tmp_dir}/out")
    a, b = (sorted(map(tuple, spark.read.parquet(x["dim_airports"]).collect()), key=str) for x in (want, got))
    assert a == b and a
    bad = spark.read.parquet(star.rejected_path(f"{tmp_dir}/out")).collect()
    assert sorted(r.reason for r in bad) == ["elevation_ft: not int", "number of fields"]
    assert spark.read.parquet(star.rejected_path(f"{tmp_dir}/plain")).count() == 0
