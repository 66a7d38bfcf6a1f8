"""What a refresh reads, and how many files and tasks there are, as tables grow."""

import glob

import pyarrow.parquet as pq
from pyspark.sql import functions as F

from starloom import schemas
from starloom.plans import driver_tables as dt
from starloom.plans import star
from starloom.sources.files import read_parquet, with_place
from starloom.streaming import refresh, refresh_star
from tests import fixtures as fx
from tests.conftest import SF_SMALL


def _persons(spark, rows):
    return spark.createDataFrame(rows, "year int, month int, cicid long")


def test_months_of_a_batch_bound_the_read(spark, tmp_dir):
    stored = _persons(spark, [(y, m, y * 100 + m) for y in range(1990, 2000) for m in range(1, 13)]
                      + [(None, 1, 1), (1996, None, 2)])
    stored.write.partitionBy("year", "month").parquet(f"{tmp_dir}/stored")
    batch = _persons(spark, [(1996, 11, 1), (1997, 2, 2), (None, 5, 3), (1996, None, 4)])
    read = spark.read.parquet(f"{tmp_dir}/stored").where(refresh._months(batch))
    assert sorted((r.year, r.month) for r in read.collect()) == [(1996, 11), (1996, 12), (1997, 1),
                                                                 (1997, 2)]
    files = read.inputFiles()  # planned files; pruned folders are not scanned
    assert files and read._jdf.queryExecution().executedPlan().toString().count("PartitionFilters: [isnotnull")


def test_a_batch_without_known_months_reads_nothing(spark):
    assert refresh._months(_persons(spark, [])) is None
    assert refresh._months(_persons(spark, [(None, 5, 3), (None, None, 4)])) is None


def test_landed_files_do_not_grow_with_partitions(spark):
    rows = spark.range(4000).withColumn("ym", F.col("id") % 5)
    many = rows.repartition(40, "id")
    limit = spark.sparkContext.defaultParallelism
    assert 0 < len(glob.glob(f"{dt._landed(many, 'flat')}/*.parquet".replace("file:", ""))) <= limit
    path = dt._landed(many, "months", ["ym"]).replace("file:", "")
    assert [len(glob.glob(f"{path}/ym={k}/*.parquet")) for k in range(5)] == [1] * 5


def test_role_playing_tasks_follow_the_rows(spark, monkeypatch):
    want = dt.q_role_playing_lookup(spark, SF_SMALL).count()
    monkeypatch.setattr(dt, "LINES_PER_TASK", 300)
    df = dt.q_role_playing_lookup(spark, SF_SMALL)
    n = 1 + dt.table(spark, SF_SMALL, "lineitem").count() // 300
    assert df.rdd.getNumPartitions() == n and df.count() == want


def _arrivals(spark, path, **changed):
    cols = schemas.ARRIVALS_RAW.fieldNames()
    rows = [dict(r, **changed) for r in fx.arrival_rows()]
    spark.createDataFrame([tuple(r[c] for c in cols) for r in rows],
                          schemas.ARRIVALS_RAW).coalesce(1).write.parquet(path)
    return path


def test_a_batch_is_read_once(spark, tmp_dir):
    p = fx.write_inputs(spark, f"{tmp_dir}/in")
    star.build_star(spark, p["arrivals"], p["dictionary"], p["demographics"], p["airports"],
                    f"{tmp_dir}/out", refreshable=True)
    landed = with_place(read_parquet(spark, _arrivals(spark, f"{tmp_dir}/later", i94mon=6.0),
                                     schemas.ARRIVALS_RAW))
    read = spark.sparkContext.accumulator(0)

    def counted(row):
        read.add(1)
        return row
    # like a micro-batch: rows of an RDD, which every use computes again
    batch = spark.createDataFrame(landed.rdd.map(counted), landed.schema)
    refresh.write_arrivals(spark, batch, f"{tmp_dir}/out",
                           star.load_lookups(spark, p["dictionary"])["countries"])
    assert read.value == len(fx.arrival_rows())


def test_a_file_without_clean_rows_is_known_afterwards(spark, tmp_dir):
    p = fx.write_inputs(spark, f"{tmp_dir}/in")
    out = f"{tmp_dir}/out"
    star.build_star(spark, p["arrivals"], p["dictionary"], p["demographics"], p["airports"], out,
                    refreshable=True)
    before = star.read_star(spark, out)["fact_immigration"].count()
    _arrivals(spark, f"{tmp_dir}/later", i94mode=None, arrdate=float("inf"))
    refresh_star(spark, f"{tmp_dir}/later", out, p["dictionary"]).awaitTermination()
    files = spark.read.parquet(star.ledger_path(f"{out}/fact_immigration"))
    assert files.where(F.col("path").contains("/later/")).count() == 1
    assert star.read_star(spark, out)["fact_immigration"].count() == before


def test_a_build_and_its_refreshes_share_the_parsed_dictionary(spark, tmp_dir, monkeypatch):
    p = fx.write_inputs(spark, f"{tmp_dir}/in")
    lookups = star.load_lookups(spark, p["dictionary"])
    later = _arrivals(spark, f"{tmp_dir}/later", i94mon=6.0)

    def persons(dictionary, out):
        star.build_star(spark, p["arrivals"], dictionary, p["demographics"], p["airports"], out,
                        refreshable=True)
        refresh_star(spark, later, out, dictionary).awaitTermination()
        return sorted(map(str, star.read_star(spark, out)["dim_personal"].collect()))
    want = persons(p["dictionary"], f"{tmp_dir}/parsed")

    def again(*_):
        raise AssertionError("parsed again")
    monkeypatch.setattr(star.lb, "code_labels", again)
    assert persons(lookups, f"{tmp_dir}/shared") == want


def test_landed_files_can_be_split(spark, monkeypatch):
    monkeypatch.setattr(dt, "LANDED_ROW_GROUP", 1024 * 1024)
    rows = spark.range(600_000).select(F.lit(0).alias("ym"), F.xxhash64("id").alias("x"))
    [file] = glob.glob(f"{dt._landed(rows, 'split', ['ym'])}/ym=0/*.parquet".replace("file:", ""))
    assert pq.ParquetFile(file).num_row_groups > 1
