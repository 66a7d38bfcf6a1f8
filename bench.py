"""Benchmark: headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS].

Prints one JSON line: {"metric", "value", "unit", "queries", "sf", ...}.
Each query is executed in full with the ``noop`` sink (no driver collect),
best of $BENCH_RUNS (default 3) warm runs. ``comparisons`` holds the
window vs semi-join group maximum), timed the same way.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "flagship_top_market", "rows_at_group_max", "role_playing_lookup", "star_left_join",
    "conform_by_name_state", "label_sections", "parse_port_label", "dedup_by_key",
    "dq_fk_orphans", "dq_pk_unique", "dq_null_profile", "sas_date_to_timestamp",
    "sql_function_surface", "distinct_sorted", "top_k_desc", "group_count",
    "star_top_female_port_city",
]


def _run(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def _best(fn, runs: int) -> float:
    best = float("inf")
    for _ in range(runs):
        t0 = time.perf_counter()
        fn()
        best = min(best, time.perf_counter() - t0)
    return round(best, 3)


def comparisons(spark, sf_dir: str, runs: int) -> dict:
    from pyspark.sql import Window
    from pyspark.sql import functions as F
    from pyspark.sql import types as T

    from starloom.functions import code_label, region_state, sas_day_to_timestamp
    from starloom.functions import timestamp_to_sas_day
    from starloom.operators import rows_at_group_max

    li = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    ev = spark.read.parquet(f"{sf_dir}/events.parquet").select(
        timestamp_to_sas_day("ts").alias("d"))
    part = spark.read.parquet(f"{sf_dir}/part.parquet")

    import datetime as dt

    @F.udf(T.TimestampNTZType())
    def py_sas(d):
        return None if d is None else dt.datetime(1960, 1, 1) + dt.timedelta(days=d)

    @F.udf(T.StringType())
    def py_visa(v):
        return {1: "Business", 2: "Pleasure", 3: "Student"}.get(v)

    @F.udf(T.StringType())
    def py_region(r):
        m = re.search(r"\w{2}-(\w{2})", r or "")
        return m.group(1) if m else None

    region = F.concat_ws("-", "l_returnflag", "l_linestatus", "l_returnflag")
    w = Window.partitionBy("p_brand")
    maxima = part.groupBy("p_brand").agg(F.max("p_retailprice").alias("_m"))

    from starloom.plans import arrivals_fixture as afx
    from starloom.plans import star
    from starloom.session import scratch_path
    from starloom.sources.files import write_parquet

    def three_tables(clean):
        _run(star.fact_immigration(clean))
        _run(star.dim_flight(clean, one_row_per_key=False))
        _run(clean.select("cicid", "age", "gender").distinct())

    def staged_once():
        raw = afx.raw_arrivals(spark, sf_dir)
        three_tables(spark.read.parquet(write_parquet(star.clean_arrivals(raw),
                                                      scratch_path(spark, "bench_stage"))))

    def recomputed():
        three_tables(star.clean_arrivals(afx.raw_arrivals(spark, sf_dir)))
    cases = {
        "sas_date_native": lambda: _run(ev.select(sas_day_to_timestamp("d"))),
        "sas_date_python_udf": lambda: _run(ev.select(py_sas("d"))),
        "code_label_native": lambda: _run(li.select(code_label("l_linenumber"))),
        "code_label_python_udf": lambda: _run(li.select(py_visa("l_linenumber"))),
        "region_native": lambda: _run(li.select(region_state(region))),
        "region_python_udf": lambda: _run(li.select(py_region(region))),
        "group_max_semijoin": lambda: _run(rows_at_group_max(part, ["p_brand"],
                                                             "p_retailprice")),
        "group_max_window": lambda: _run(
            part.withColumn("_m", F.max("p_retailprice").over(w))
            .where(F.col("p_retailprice") == F.col("_m")).drop("_m")),
        "group_max_self_join": lambda: _run(
            part.join(maxima, (part.p_brand == maxima.p_brand)
                      & (part.p_retailprice == maxima._m)).drop(maxima.p_brand).drop("_m")),
        "three_tables_staged_once": staged_once,
        "three_tables_recomputed": recomputed,
    }
    return {k: _best(f, runs) for k, f in cases.items()}


def star_build_timing(spark, p: dict, runs: int) -> dict:
    """The whole star build (staging + six tables written) on inputs derived
    from the driver tables; inputs are prepared once, outside the timing."""
    from starloom.plans import star
    from starloom.session import scratch_path

    def build():
        star.build_star(spark, p["arrivals"], p["dictionary"], p["demographics"],
                        p["airports"], scratch_path(spark, "bench_star"))
    return {"build_star": _best(build, runs)}


def bucketed_vs_shuffled(spark, p: dict, runs: int) -> dict:
    """OLAP question on a plain star vs one with fact and person bucketed by
    cicid, both with sort-merge joins (size-based broadcast off, as when
    the tables are large)."""
    from starloom.plans import star
    from starloom.plans.olap import top_female_port_city
    from starloom.session import scratch_path

    plain_dir, bucket_dir = scratch_path(spark, "bench_plain"), scratch_path(spark, "bench_bkt")
    star.build_star(spark, p["arrivals"], p["dictionary"], p["demographics"], p["airports"],
                    plain_dir)
    spark.sql("CREATE DATABASE IF NOT EXISTS bench_star")
    star.build_star(spark, p["arrivals"], p["dictionary"], p["demographics"], p["airports"],
                    bucket_dir, person_buckets=int(spark.conf.get("spark.sql.shuffle.partitions")),
                    database="bench_star")
    city = spark.read.parquet(f"{plain_dir}/dim_city_population")
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.requireAllClusterKeysForCoPartition", "false")
    try:
        plain = lambda: _run(top_female_port_city(
            spark.read.parquet(f"{plain_dir}/fact_immigration"), city,
            spark.read.parquet(f"{plain_dir}/dim_personal")))
        bucketed = lambda: _run(top_female_port_city(
            spark.table("bench_star.fact_immigration"), city,
            spark.table("bench_star.dim_personal")))
        return {"olap_star_shuffled": _best(plain, runs),
                "olap_star_bucketed": _best(bucketed, runs)}
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
        spark.conf.unset("spark.sql.requireAllClusterKeysForCoPartition")


def event_log_summary(log_dir: str, runs: int) -> dict:
    """Per job group (query): shuffle MB written, input MB read and stages,
    averaged per run, from Spark's event log."""
    import glob
    stage_group, stats = {}, {}
    for path in glob.glob(os.path.join(log_dir, "**", "*"), recursive=True):
        if os.path.isdir(path) or path.endswith(".crc"):
            continue
        with open(path) as fh:
            for line in fh:
                ev = json.loads(line)
                kind = ev.get("Event")
                if kind == "SparkListenerJobStart":
                    group = (ev.get("Properties") or {}).get("spark.jobGroup.id")
                    for sid in ev.get("Stage IDs", []):
                        stage_group[sid] = group
                elif kind == "SparkListenerTaskEnd":
                    group = stage_group.get(ev.get("Stage ID"))
                    if not group:
                        continue
                    m = ev.get("Task Metrics") or {}
                    st = stats.setdefault(group, {"shuffle": 0, "input": 0, "stages": set()})
                    st["shuffle"] += (m.get("Shuffle Write Metrics") or {}).get(
                        "Shuffle Bytes Written", 0)
                    st["input"] += (m.get("Input Metrics") or {}).get("Bytes Read", 0)
                    st["stages"].add(ev.get("Stage ID"))
    mb = 1024 * 1024
    return {g: {"shuffle_mb": round(v["shuffle"] / runs / mb, 3),
                "input_mb": round(v["input"] / runs / mb, 3),
                "stages": round(len(v["stages"]) / runs, 1)} for g, v in sorted(stats.items())}


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    os.environ.setdefault("BENCH_CPUS", cpus)
    from starloom.plans.driver_tables import QUERIES
    from starloom.session import build_session

    import tempfile
    log_dir = tempfile.mkdtemp(prefix="starloom-bench-events-")
    spark = build_session(master=f"local[{cpus}]", shuffle_partitions=int(cpus), extra={
        "spark.eventLog.enabled": "true", "spark.eventLog.dir": log_dir,
        "spark.eventLog.compress": "false", "spark.eventLog.rolling.enabled": "false",
        "spark.sql.warehouse.dir": tempfile.mkdtemp(prefix="starloom-bench-wh-")})
    times = {}
    for key in HEADLINE:
        fn = QUERIES[key]
        spark.sparkContext.setJobGroup(key, key)
        times[key] = _best(lambda: _run(fn(spark, sf_dir)), runs)
    spark.sparkContext.setJobGroup("build_star", "build_star")
    out = {
        "metric": "headline_queries_total_sec",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "flagship_sec": times["flagship_top_market"],
        "queries": times,
        "sf": (re.search(r"sf([0-9.]+)", sf_dir) or [None, sf_dir])[1],
        "cpus": int(cpus),
        "runs": runs,
        "note": "sum over queries of the best of `runs` timings; full execution via noop sink",
    }
    from starloom.plans.driver_tables import star_inputs
    inputs = star_inputs(spark, sf_dir)
    out["build"] = star_build_timing(spark, inputs, runs)
    spark.sparkContext.setJobGroup("comparisons", "comparisons")
    if os.environ.get("BENCH_COMPARE", "1") == "1":
        out["comparisons"] = comparisons(spark, sf_dir, runs)
        out["comparisons"].update(bucketed_vs_shuffled(spark, inputs, runs))
    spark.stop()  # flushes the event log
    try:
        out["shuffle"] = {k: v for k, v in event_log_summary(log_dir, runs).items()
                          if k in times or k == "build_star"}
    except Exception as e:  # the timing result stands without it
        out["shuffle_error"] = f"{type(e).__name__}: {e}"
    print(json.dumps(out))


if __name__ == "__main__":
    main()
