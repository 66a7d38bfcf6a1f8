"""Monthly refresh: incremental, unique ids across batches, re-run safe."""

import glob
import os
import shutil
import tempfile

import pytest

from starloom import schemas
from starloom.plans.star import clean_arrivals, fact_immigration
from starloom.streaming import read_refreshed, refresh_fact_immigration
from tests import fixtures as fx


def _raw(spark, month):
    cols = schemas.ARRIVALS_RAW.fieldNames()
    rows = [r for r in fx.arrival_rows() if r["i94mon"] == month]
    return spark.createDataFrame([tuple(r[c] for c in cols) for r in rows], schemas.ARRIVALS_RAW)


def test_refresh_is_incremental_and_idempotent(spark, tmp_dir):
    landing, fact, ckpt = f"{tmp_dir}/landing", f"{tmp_dir}/fact", f"{tmp_dir}/ckpt"
    _raw(spark, 4.0).repartition(2).write.parquet(f"{landing}/m=201604")
    refresh_fact_immigration(spark, f"{landing}/m=*", fact, ckpt).awaitTermination()
    first = read_refreshed(spark, fact)
    want4 = fact_immigration(clean_arrivals(_raw(spark, 4.0))).drop("id")
    assert sorted(map(tuple, first.drop("id").select(*want4.columns).collect()), key=str) == \
        sorted(map(tuple, want4.collect()), key=str)

    # a new month arrives: only its rows are added
    _raw(spark, 5.0).write.parquet(f"{landing}/m=201605")
    refresh_fact_immigration(spark, f"{landing}/m=*", fact, ckpt).awaitTermination()
    second = read_refreshed(spark, fact)
    assert second.count() == len(fx.KEPT_CICIDS)
    assert second.select("id").distinct().count() == second.count()
    assert sorted(r.month for r in second.select("month").distinct().collect()) == [4, 5]

    # nothing new: nothing changes
    refresh_fact_immigration(spark, f"{landing}/m=*", fact, ckpt).awaitTermination()
    assert read_refreshed(spark, fact).count() == second.count()


def test_stream_extends_a_refreshable_build(spark, tmp_dir):
    from starloom.plans import star
    p = fx.write_inputs(spark, f"{tmp_dir}/in")
    april = _raw(spark, 4.0)
    april.write.parquet(f"{tmp_dir}/april")
    out = star.build_star(spark, f"{tmp_dir}/april", p["dictionary"], p["demographics"],
                          p["airports"], f"{tmp_dir}/out", refreshable=True)
    fact_dir = out["fact_immigration"]
    first = read_refreshed(spark, fact_dir).count()
    _raw(spark, 5.0).write.parquet(f"{tmp_dir}/landing/m=201605")
    refresh_fact_immigration(spark, f"{tmp_dir}/landing/m=*", fact_dir,
                             f"{tmp_dir}/ckpt").awaitTermination()
    both = read_refreshed(spark, fact_dir)
    assert first == len(fx.KEPT_CICIDS) - 1 and both.count() == len(fx.KEPT_CICIDS)
    assert both.select("id").distinct().count() == both.count()
    assert "batch" not in both.columns


def test_cli_refreshable_build_then_refresh(spark, tmp_dir, capsys):
    from starloom.__main__ import main
    p = fx.write_inputs(spark, f"{tmp_dir}/in")
    _raw(spark, 4.0).write.parquet(f"{tmp_dir}/april")
    main(["build", "--arrivals", f"{tmp_dir}/april", "--dictionary", p["dictionary"],
          "--demographics", p["demographics"], "--airports", p["airports"],
          "--out", f"{tmp_dir}/out", "--refreshable"])
    _raw(spark, 5.0).write.parquet(f"{tmp_dir}/landing/m=201605")
    main(["refresh", "--landing", f"{tmp_dir}/landing/m=*", "--star", f"{tmp_dir}/out",
          "--dictionary", p["dictionary"], "--checkpoint", f"{tmp_dir}/ckpt"])
    main(["check", "--star", f"{tmp_dir}/out"])
    main(["sql", "--star", f"{tmp_dir}/out",
          "SELECT count(*) AS n_after_refresh FROM fact_immigration"])
    out = capsys.readouterr().out.replace(" ", "")
    assert f"|{len(fx.KEPT_CICIDS)}|" in out


def test_refresh_star_keeps_references_and_keys(spark, tmp_dir):
    from starloom.plans import star
    from starloom.plans.checks import check_star
    from starloom.streaming import refresh_star
    p = fx.write_inputs(spark, f"{tmp_dir}/in")
    _raw(spark, 4.0).write.parquet(f"{tmp_dir}/april")
    star.build_star(spark, f"{tmp_dir}/april", p["dictionary"], p["demographics"],
                    p["airports"], f"{tmp_dir}/out", refreshable=True)
    _raw(spark, 5.0).write.parquet(f"{tmp_dir}/landing/m=201605")
    for _ in range(2):  # a second run finds nothing new and changes nothing
        refresh_star(spark, f"{tmp_dir}/landing/m=*", f"{tmp_dir}/out", p["dictionary"],
                     f"{tmp_dir}/ckpt").awaitTermination()
    check_star(spark, f"{tmp_dir}/out")  # raises on orphans or duplicate keys
    t = star.read_star(spark, f"{tmp_dir}/out")
    assert t["fact_immigration"].count() == len(fx.KEPT_CICIDS)
    assert t["dim_personal"].count() == len(set(fx.KEPT_CICIDS)) + 1  # number 1 in two months
    # same results as building the star from both months at once
    whole = star.build_star(spark, fx_arrivals(spark, tmp_dir), p["dictionary"],
                            p["demographics"], p["airports"], f"{tmp_dir}/whole")
    want = spark.read.parquet(whole["dim_flight"])
    assert sorted(map(tuple, t["dim_flight"].collect()), key=str) == \
        sorted(map(tuple, want.collect()), key=str)


def fx_arrivals(spark, tmp_dir):
    path = f"{tmp_dir}/both"
    _raw(spark, 4.0).unionByName(_raw(spark, 5.0)).write.parquet(path)
    return path


def _star(spark, tmp_dir, arrivals, name):
    from starloom.plans import star
    p = fx.write_inputs(spark, f"{tmp_dir}/in-{name}")
    arrivals.write.parquet(f"{tmp_dir}/raw-{name}")
    star.build_star(spark, f"{tmp_dir}/raw-{name}", p["dictionary"], p["demographics"],
                    p["airports"], f"{tmp_dir}/{name}", refreshable=True)
    return f"{tmp_dir}/{name}", p["dictionary"]


def _person(spark, rows):
    cols = schemas.ARRIVALS_RAW.fieldNames()
    rows = [dict(fx.BASE, **r) for r in rows]
    return spark.createDataFrame([tuple(r[c] for c in cols) for r in rows], schemas.ARRIVALS_RAW)


def test_runs_from_different_folders_lose_nothing(spark, tmp_dir):
    """Three loads without a checkpoint argument, the last one an older month."""
    from starloom.plans import star
    from starloom.streaming import refresh_star

    def arrivals(month, *people):
        return _person(spark, [dict(cicid=float(c), admnum=float(a), i94mon=month, gender=g, fltno=f)
                               for c, a, g, f in people])
    may = arrivals(5.0, (50, 100, "M", "00009"), (1, 101, "F", "00001"))
    june = arrivals(6.0, (50, 102, "F", "00001"), (2, 103, "F", "00001"))
    april = arrivals(4.0, (50, 104, "F", "00001"), (3, 100, "F", "00002"))
    out, labels = _star(spark, tmp_dir, may, "late")
    for name, rows in (("june", june), ("april", april)):
        rows.write.parquet(f"{tmp_dir}/{name}")
        for _ in range(2):  # the second run of a folder finds nothing new
            refresh_star(spark, f"{tmp_dir}/{name}", out, labels).awaitTermination()
    whole, _ = _star(spark, tmp_dir, may.unionByName(june).unionByName(april), "whole")

    def content(root):
        t = star.read_star(spark, root)
        return {n: sorted((tuple(r) for r in t[n].drop("id").collect()), key=str)
                for n in star.REFRESHED_TABLES}
    assert content(out) == content(whole)
    ids = [r.id for r in star.read_star(spark, out)["fact_immigration"].select("id").collect()]
    assert len(ids) == len(set(ids)) == 6
    before = content(out)
    star.compact_star(spark, out)
    assert content(out) == before
    assert spark.read.parquet(f"{out}/dim_personal").select("batch").distinct().count() == 1
    people = {(r.month, r.cicid): r.gender for r in star.read_star(spark, out)["dim_personal"].collect()}
    assert people[(5, 50)] == "M" and people[(6, 50)] == people[(4, 50)] == "F"
    flight = [r for r in star.read_star(spark, out)["dim_flight"].collect() if r.adm_num == 100]
    assert [r.flight_no for r in flight] == ["00009"]  # the latest month's


def test_rebuild_forgets_refreshed_months(spark, tmp_dir):
    """A rebuild under a dynamic session replaces the star and its refresh state."""
    from starloom.plans import star
    from starloom.streaming import refresh_star
    p = fx.write_inputs(spark, f"{tmp_dir}/in")
    _raw(spark, 4.0).write.parquet(f"{tmp_dir}/april")
    _raw(spark, 5.0).write.parquet(f"{tmp_dir}/may")
    key = "spark.sql.sources.partitionOverwriteMode"
    old = spark.conf.get(key)
    spark.conf.set(key, "dynamic")
    try:
        for _ in range(2):
            star.build_star(spark, f"{tmp_dir}/april", p["dictionary"], p["demographics"],
                            p["airports"], f"{tmp_dir}/out", refreshable=True)
            fact = star.read_star(spark, f"{tmp_dir}/out")["fact_immigration"]
            assert [r.month for r in fact.select("month").distinct().collect()] == [4]
            refresh_star(spark, f"{tmp_dir}/may", f"{tmp_dir}/out", p["dictionary"]).awaitTermination()
            fact = star.read_star(spark, f"{tmp_dir}/out")["fact_immigration"]
            assert fact.count() == len(fx.KEPT_CICIDS)
    finally:
        spark.conf.set(key, old)


def test_claims_and_commits(spark, tmp_dir):
    """Numbers are given out once; a commit that another one overtook is made again on it."""
    from starloom.sources import commits
    assert [commits.claim(spark, tmp_dir, n) for n in (3, 2, 0)] == [(0, 0), (1, 3), (2, 5)]
    assert commits.latest(spark, tmp_dir) is None
    assert commits.commit(spark, tmp_dir, commits.added(0, ["a", "b"]))["live"] == {"a": [0], "b": [0]}
    calls = []

    def overtaken(state):
        if not calls:
            calls.append(commits.commit(spark, tmp_dir, commits.added(7, ["a"])))
        return commits.added(1, ["b"])(state)
    commits.commit(spark, tmp_dir, overtaken)
    assert commits.latest(spark, tmp_dir)["live"] == {"a": [0, 7], "b": [0, 1]}
    commits.commit(spark, tmp_dir, commits.swapped(8, "a", [0]))
    state = commits.latest(spark, tmp_dir)
    assert state["live"]["a"] == [7, 8] and state["dead"] == {"a": [0]}
    assert not commits._append(spark, f"{commits.state_dir(tmp_dir)}/commits", 0, {})


@pytest.fixture(scope="module")
def april(spark):
    """A star of April and the content of one of both months, built once."""
    root = tempfile.mkdtemp(prefix="starloom-april-")
    out, labels = _star(spark, root, _raw(spark, 4.0), "star")
    whole, _ = _star(spark, root, _raw(spark, 4.0).unionByName(_raw(spark, 5.0)), "whole")
    return out, labels, f"{root}/raw-star", _content(spark, whole)


def _months(spark, tmp_dir, april):
    """A copy of the star of April, and May in a landing folder."""
    out, labels, _, want = april
    shutil.copytree(out, f"{tmp_dir}/star")
    _raw(spark, 5.0).write.parquet(f"{tmp_dir}/landing/m=201605")
    return f"{tmp_dir}/star", labels, f"{tmp_dir}/landing", want


def _content(spark, root):
    from starloom.plans import star
    t = star.read_star(spark, root)
    rows = {n: sorted((tuple(r) for r in t[n].drop("id").collect()), key=str)
            for n in star.REFRESHED_TABLES}
    rows["summary"] = sorted((tuple(r) for r in star.read_summary(spark, root).collect()), key=str)
    return rows


def test_failed_load_then_compaction_then_rerun(spark, tmp_dir, april):
    """A load that fails after its writes is not seen, survives a compaction, and its re-run
    neither loses nor doubles a row."""
    from starloom.plans import star
    from starloom.sources.files import with_place
    from starloom.streaming import refresh, refresh_star
    out, labels, landing, want = _months(spark, tmp_dir, april)
    before = _content(spark, out)
    countries = star.load_lookups(spark, labels)["countries"]
    df = with_place(spark.read.schema(schemas.ARRIVALS_RAW).parquet(landing))
    assert refresh.write_arrivals(spark, df, out, countries).batch == 0
    assert _content(spark, out) == before
    star.compact_star(spark, out)
    assert _content(spark, out) == before
    for _ in range(2):
        refresh_star(spark, f"{landing}/m=*", out, labels).awaitTermination()
        assert _content(spark, out) == want
        star.compact_star(spark, out)
    assert _content(spark, out) == want


def test_compaction_that_fails_changes_nothing(spark, tmp_dir, april, monkeypatch):
    from starloom.plans import star
    from starloom.sources import commits
    from starloom.streaming import refresh_star
    out, labels, landing, want = _months(spark, tmp_dir, april)
    refresh_star(spark, landing + "/m=*", out, labels).awaitTermination()
    with monkeypatch.context() as m:
        def stop(*_):
            raise OSError("stopped before the commit")
        m.setattr(commits, "commit", stop)
        with pytest.raises(OSError):
            star.compact_star(spark, out)
    assert _content(spark, out) == want
    star.compact_star(spark, out)
    assert _content(spark, out) == want


def test_one_file_is_loaded_once(spark, tmp_dir, april):
    """However its folder is spelled, also the folder of the build and with a new checkpoint."""
    from starloom.streaming import refresh_star
    out, labels, landing, want = _months(spark, tmp_dir, april)
    for i, spelled in enumerate((f"{landing}/m=*", f"{landing}/*", f"{landing}/../landing/m=*",
                                 f"file://{landing}/m=201605", april[2])):
        refresh_star(spark, spelled, out, labels, f"{tmp_dir}/ckpt-{i}").awaitTermination()
        assert _content(spark, out) == want


def test_changed_file_is_an_error(spark, tmp_dir, april):
    from starloom.streaming import refresh_star
    out, labels, landing, want = _months(spark, tmp_dir, april)
    refresh_star(spark, f"{landing}/m=*", out, labels).awaitTermination()
    part = max(glob.glob(f"{landing}/m=201605/*.parquet"), key=os.path.getsize)  # others are empty
    _raw(spark, 4.0).unionByName(_raw(spark, 4.0)).coalesce(1).write.parquet(f"{tmp_dir}/other")
    [other] = glob.glob(f"{tmp_dir}/other/*.parquet")
    for name in ("{}/{}", "{}/.{}.crc"):  # the file and its checksum
        shutil.copy(*[name.format(*f.rsplit("/", 1)) for f in (other, part)])
    with pytest.raises(Exception, match="changed since"):
        refresh_star(spark, f"{landing}/m=*", out, labels, f"{tmp_dir}/again").awaitTermination()
    assert _content(spark, out) == want


def test_two_loads_of_one_file_at_a_time(spark, tmp_dir, april):
    """Both write; the second to commit is refused."""
    from starloom.plans import star
    from starloom.sources.files import with_place
    from starloom.streaming import refresh
    out, labels, landing, want = _months(spark, tmp_dir, april)
    countries = star.load_lookups(spark, labels)["countries"]
    df = with_place(spark.read.schema(schemas.ARRIVALS_RAW).parquet(landing))
    fact = f"{out}/fact_immigration"
    loads = [refresh.write_arrivals(spark, df, out, countries) for _ in range(2)]
    assert [x.batch for x in loads] == [0, 1]
    refresh.commit_batch(spark, fact, loads[1], star.COMMITTED_TABLES)
    with pytest.raises(RuntimeError, match="meanwhile"):
        refresh.commit_batch(spark, fact, loads[0], star.COMMITTED_TABLES)
    assert _content(spark, out) == want


def test_ids_do_not_depend_on_the_run(spark, tmp_dir):
    from starloom.plans import star
    _raw(spark, 4.0).repartition(3).write.parquet(f"{tmp_dir}/in/m=4")
    _raw(spark, 5.0).write.parquet(f"{tmp_dir}/in/m=5")
    paths = [f"{tmp_dir}/in/m=5", f"{tmp_dir}/in/m=4"]
    runs = [{r.id: (r.cicid, r.month, r.adm_num) for r in star.stage_arrivals(spark, p)[0].collect()}
            for p in (paths, paths[::-1])]
    assert runs[0] == runs[1] and len(runs[0]) == len(fx.KEPT_CICIDS)


def test_counts_follow_a_changed_person(spark, tmp_dir):
    """A later batch decides another gender for a person of an earlier one."""
    from starloom.plans import star
    from starloom.plans.olap import top_female_port_city, top_female_port_city_by_counts
    from starloom.streaming import refresh_star

    def load(*rows):
        return _person(spark, [dict(cicid=float(c), admnum=float(a), gender=g, i94bir=float(age))
                               for c, a, g, age in rows])
    out, labels = _star(spark, tmp_dir, load((1, 1, "M", 40), (1, 2, "M", 41), (2, 3, "F", 30)), "base")
    load((1, 4, "F", 20), (3, 5, "F", 20), (2, 6, "F", 50)).write.parquet(f"{tmp_dir}/later")
    refresh_star(spark, f"{tmp_dir}/later", out, labels).awaitTermination()
    counts = star.read_summary(spark, out)
    assert sorted((r.gender, r.n) for r in counts.groupBy("gender").sum("n").toDF("gender", "n").collect()) \
        == [("F", 6)]
    t = star.read_star(spark, out)
    full = top_female_port_city(t["fact_immigration"], t["dim_city_population"], t["dim_personal"])
    assert top_female_port_city_by_counts(counts, t["dim_city_population"]).collect() == full.collect()
