"""Full star build on invented fixtures, with hand-derived expectations."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from starloom import schemas
from starloom.operators import dq_pk_unique, dq_schema, raise_on_failure
from starloom.plans import star
from starloom.plans.olap import top_female_port_city
from tests import fixtures as fx


@pytest.fixture(scope="module")
def built(spark, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("star"))
    p = fx.write_inputs(spark, f"{root}/in")
    out = star.build_star(spark, p["arrivals"], p["dictionary"], p["demographics"],
                          p["airports"], f"{root}/out")
    return {k: spark.read.parquet(v) for k, v in out.items()}, p, root


def test_schemas_match_model(spark, built):
    tables, _, _ = built
    res = dq_schema(spark, {k: (df, schemas.STAR_SCHEMAS[k]) for k, df in tables.items()})
    raise_on_failure(res, "schema")


def test_fact(built):
    fact = built[0]["fact_immigration"]
    rows = fact.collect()
    assert sorted(r.cicid for r in rows) == sorted(fx.KEPT_CICIDS)
    assert fact.select("id").distinct().count() == len(rows)
    by = {(r.cicid, r.month): r for r in rows}
    assert by[(1, 4)].arrival_date == dt.datetime(2016, 4, 30, 12)
    assert by[(1, 4)].visa == "Business"
    assert by[(4, 4)].visa is None and by[(21, 4)].visa is None
    assert by[(17, 4)].arrival_date is None
    assert by[(1, 5)].port == "PRT"


def test_fact_partitioned_by_month(built):
    _, _, root = built
    import os
    parts = sorted(os.listdir(f"{root}/out/fact_immigration/year=2016"))
    assert parts == ["month=4", "month=5"]


def test_dim_personal(built):
    d = built[0]["dim_personal"]
    got = {r.cicid: (r.citizen_country, r.residence_country, r.gender, r.age, r.birth_year)
           for r in d.collect()}
    # number 1 stands for one person in April and for one in May
    assert len(got) == 7 and d.count() == 8
    assert sorted(r.month for r in d.where("cicid = 1").collect()) == [4, 5]
    assert got[3] == (None, "NORTH ELBONIA", "F", 30, 1986)
    assert got[2][2] == "M"
    assert dq_pk_unique(d, list(star.PERSON_KEY), "p").first().ok


def test_dim_flight(built):
    d = built[0]["dim_flight"]
    assert d.count() == 7
    assert dq_pk_unique(d, "adm_num", "f").first().ok


def test_dim_airports(built):
    got = {r.airport_id: (r.region, r.elevation_ft, r.municipality, r.coordinates)
           for r in built[0]["dim_airports"].collect()}
    assert got == {"00A": ("AK", 11, "Alpha City", "-74.93, 40.07"),
                   "00B": ("CA", None, None, "-1.5, 2.5"),
                   "00C": (None, 5, "Somewhere", "3.0, 4.0")}


def test_dim_city_population(built):
    rows = built[0]["dim_city_population"].collect()
    got = sorted((r.city, r.state_code, r.city_code, r.race) for r in rows)
    assert got == sorted([
        ("ALPHA CITY", "AK", "ABC", "White"), ("ALPHA CITY", "AK", "ALC", "White"),
        ("CAPITOL", "DC", "WDC", "Black"),
        ("PORTVILLE", "ME", "PRT", "White"), ("PORTVILLE", "OR", "PRO", "White"),
        ("BROOK", "NY", "BRK", "White"), ("HASHTON", "WA", "HSH", "White"),
        ("SPRINGS", "CO", "SPX", "White")])
    springs = [r for r in rows if r.city == "SPRINGS"][0]
    assert springs.total_population is None


def test_dim_city_stats(built):
    got = {(r.city, r.city_code): r.median_age for r in built[0]["dim_city_stats"].collect()}
    assert got[("PORTVILLE", "PRO")] == 36.3 and got[("PORTVILLE", "PRT")] == 40.2


def test_flagship_on_star(built):
    t = built[0]
    res = top_female_port_city(t["fact_immigration"], t["dim_city_population"],
                               t["dim_personal"]).collect()
    assert [tuple(r) for r in res] == [("CAPITOL", 2, 2000)]


def test_flagship_matches_sql_form(spark, built):
    t = star.register_views(spark, built[0])
    per_port = spark.sql("""SELECT port, count(*) AS n FROM fact_immigration
        LEFT SEMI JOIN (SELECT * FROM dim_personal WHERE gender = 'F') USING (year, month, cicid)
        GROUP BY port""")
    per_port.createOrReplaceTempView("women_per_port")
    want = spark.sql("""SELECT city, total, foreign_population FROM (
            SELECT city, foreign_population, sum(n) AS total,
                   row_number() OVER (ORDER BY foreign_population DESC NULLS LAST, city) AS place
            FROM women_per_port LEFT JOIN dim_city_population ON city_code = port
            GROUP BY city, foreign_population)
        WHERE place = 1""").collect()
    got = top_female_port_city(t["fact_immigration"], t["dim_city_population"],
                               t["dim_personal"]).collect()
    assert [tuple(r) for r in got] == [tuple(r) for r in want]


def test_bucketed_fact_and_person_join_without_shuffle(spark, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("bucketed"))
    p = fx.write_inputs(spark, f"{root}/in")
    spark.sql("CREATE DATABASE IF NOT EXISTS star_bucketed")
    star.build_star(spark, p["arrivals"], p["dictionary"], p["demographics"], p["airports"],
                    f"{root}/out", person_buckets=4, database="star_bucketed")
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    # the buckets hold one of the three key columns
    spark.conf.set("spark.sql.requireAllClusterKeysForCoPartition", "false")
    try:
        fact = spark.table("star_bucketed.fact_immigration")
        person = spark.table("star_bucketed.dim_personal")
        joined = fact.join(person.where(F.col("gender") == "F"), list(star.PERSON_KEY))
        plan = joined._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan and "Exchange" not in plan, plan
        city = spark.read.parquet(f"{root}/out/dim_city_population")
        res = top_female_port_city(fact, city, person).collect()
        assert [tuple(r) for r in res] == [("CAPITOL", 2, 2000)]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
        spark.conf.unset("spark.sql.requireAllClusterKeysForCoPartition")


def test_check_star_passes_on_default_build(spark, built):
    from starloom.plans.checks import check_star
    _, _, root = built
    findings = check_star(spark, f"{root}/out", raise_errors=True)
    assert findings.where(~F.col("ok")).count() == 0
    assert findings.count() > 20


def test_check_star_flags_duplicates_and_orphans(spark, tmp_path_factory):
    from starloom.plans.checks import check_star
    root = str(tmp_path_factory.mktemp("broken"))
    p = fx.write_inputs(spark, f"{root}/in")
    out = star.build_star(spark, p["arrivals"], p["dictionary"], p["demographics"], p["airports"],
                          f"{root}/out")
    spark.read.parquet(out["dim_flight"]).limit(1).write.mode("append").parquet(out["dim_flight"])
    spark.read.parquet(out["dim_city_stats"]).limit(1).write.mode("append").parquet(out["dim_city_stats"])
    kept = [tuple(r) for r in spark.read.parquet(out["dim_personal"]).where("cicid <> 3").collect()]
    (spark.createDataFrame(kept, schemas.DIM_PERSONAL).write.mode("overwrite")
     .parquet(out["dim_personal"]))
    rows = check_star(spark, f"{root}/out", raise_errors=False).collect()
    bad = {r.subject for r in rows if not r.ok}
    assert bad == {"dim_flight.adm_num", "dim_city_stats.city_code",
                   "fact_immigration.year,month,cicid->dim_personal.year,month,cicid"}
    covered = {r.subject: r.detail for r in rows if r.check == "coverage"}
    assert covered["fact_immigration.port->dim_city_population.city_code"] == "orphan_rows=1"
    with pytest.raises(ValueError, match="3 findings"):
        check_star(spark, f"{root}/out")


def test_refreshable_and_buckets_exclude_each_other(spark, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("both"))
    p = fx.write_inputs(spark, f"{root}/in")
    with pytest.raises(ValueError):
        star.build_star(spark, p["arrivals"], p["dictionary"], p["demographics"], p["airports"],
                        f"{root}/out", person_buckets=2, refreshable=True)


def test_cli_build_check_ask(spark, tmp_path_factory, capsys):
    from starloom.__main__ import main
    root = str(tmp_path_factory.mktemp("cli"))
    p = fx.write_inputs(spark, f"{root}/in")
    main(["build", "--arrivals", p["arrivals"], "--dictionary", p["dictionary"],
          "--demographics", p["demographics"], "--airports", p["airports"],
          "--out", f"{root}/out"])
    main(["check", "--star", f"{root}/out"])
    main(["ask", "--star", f"{root}/out"])
    main(["sql", "--star", f"{root}/out",
          "SELECT count(*) AS n_fact_rows_cli FROM fact_immigration"])
    out = capsys.readouterr().out
    assert "fact_immigration" in out and "CAPITOL" in out
    assert "n_fact_rows_cli" in out and f"|{len(fx.KEPT_CICIDS)}" in out.replace(" ", "")


def test_majority_tie_break_keeps_one_row(spark, built):
    _, p, _ = built
    from starloom.sources.files import read_csv
    demog = read_csv(spark, p["demographics"], sep=";", schema=schemas.DEMOGRAPHICS_RAW)
    kept = star.majority_rows(demog).where("city = 'CAPITOL'").collect()
    assert sorted(r.race for r in kept) == ["Black", "White"]
    one = star.majority_rows(demog, tie_break="Race")
    assert [r.race for r in one.where("city = 'CAPITOL'").collect()] == ["Black"]
    assert one.count() == one.select("city", "state").distinct().count() == 8
    brook = one.where("city = 'BROOK'").first()
    assert brook.race == "White"  # NULL count never wins


def test_month_filter_prunes_fact_partitions(spark, built):
    import contextlib
    import io
    _, _, root = built
    fact = spark.read.parquet(f"{root}/out/fact_immigration")
    may = fact.where((F.col("year") == 2016) & (F.col("month") == 5))
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        may.explain("formatted")
    plan = buf.getvalue()
    part_filters = [l for l in plan.splitlines() if l.startswith("PartitionFilters")][0]
    assert "(month" in part_filters and "= 5)" in part_filters
    assert may.count() == 1


def test_padded_port_code_matches_trimmed_dictionary_code(spark):
    cols = schemas.ARRIVALS_RAW.fieldNames()
    row = dict(fx.BASE, cicid=99.0, admnum=1.0, i94port="CP ", i94addr=" CA")
    raw = spark.createDataFrame([tuple(row[c] for c in cols)], schemas.ARRIVALS_RAW)
    r = star.clean_arrivals(raw).first()
    assert (r.port, r.state_code) == ("CP", "CA")
