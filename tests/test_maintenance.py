"""Work in proportion to the change: gold by site-day, the gate from the summary, pruned skip, history and empty tables."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from airshed.operators import quality
from airshed.plans import lakehouse as L
from airshed.sources import fs

from .conftest import START, response, sample_responses
from .test_lakehouse import broken, gold_is_current, land, rows

WIDE = dict(zip(("BLR", "DEL"), sample_responses()))


@pytest.fixture
def root(tmp_path):
    return str(tmp_path / "lake")


@pytest.fixture
def first(spark, root, dim):
    return L.run(spark, root, dim, landing_files=land(root, "first", WIDE, 3), run_id="first")


def summary_is_current(spark, root) -> bool:
    from airshed.operators.summary import COLUMNS, day_summary

    have, want = L.stored(spark, root, "summary"), day_summary(L.stored(spark, root, "silver"))
    return rows(have, *COLUMNS) == rows(want, *COLUMNS)


def test_a_late_hour_leaves_other_sites_rows_alone(spark, root, dim, first):
    times = {(r.city_id, r.obs_date_ist): r.computed_at for r in L.stored(spark, root, "gold").collect()}
    late = {"BLR": response(0, 1, START + dt.timedelta(hours=30), scale_pm25=2.0)}
    with broken("publish"), pytest.raises(ConnectionError):
        L.run(spark, root, dim, landing_files=land(root, "late", late, 7), run_id="late")
    L.run(spark, root, dim, run_id="next")
    now = {(r.city_id, r.obs_date_ist): r.computed_at for r in L.stored(spark, root, "gold").collect()}
    assert sorted((c, d.day) for c, d in now if now[c, d] != times[c, d]) == [("BLR", 2), ("BLR", 3)]
    assert gold_is_current(spark, root) and summary_is_current(spark, root)
    assert not fs.names(spark, L.at(root, "publish_keys"))  # what is published is forgotten


def test_the_gate_reads_no_silver_and_agrees_with_full_checks(spark, root, dim, first):
    L.run(spark, root, dim, landing_files=land(root, "more", {"BOM": response(1, 30, START + dt.timedelta(days=5))}, 8), run_id="more")
    at = dt.datetime(2026, 9, 8)
    by_summary = L.full_checks(spark, root, dim, at)
    assert rows(by_summary, *by_summary.columns) == rows(quality.run_checks(L.stored(spark, root, "silver"), dim, at), *by_summary.columns)
    plan = by_summary._jdf.queryExecution().optimizedPlan().toString() + "".join(by_summary.inputFiles())
    assert L.TABLES["summary"] in plan and L.TABLES["silver"] not in plan


def test_faults_are_counted_by_site_and_day(spark):
    from airshed.operators import summary

    one = (1.0, 1.0, 1.0, 1.0, 1.0, 1.0)
    day, ts = dt.date(2026, 9, 1), dt.datetime(2026, 9, 1, 3)
    table = spark.createDataFrame(
        [("A", ts, day, *one), ("A", ts, day, *one), ("B", ts, day, -1.0, *one[1:]), ("B", None, day, *one), (None, ts, day, 9999.0, *one[1:])],
        "city_id string, ts_utc timestamp_ntz, obs_date_ist date, pm2_5 double, pm10 double, no2 double, so2 double, o3 double, co_mg_m3 double")
    got = {r.city_id: tuple(r)[1:7] for r in summary.day_summary(table).collect()}
    assert got == {"A": (2, ts, 0, 0, 0, 1), "B": (2, ts, 1, 1, 0, 0), None: (1, ts, 1, 0, 1, 0)}
    days = summary.day_summary(table)
    dim = spark.createDataFrame([("A",), ("C",)], "city_id string")
    names = ["check_name", "severity", "passed", "observed"]
    assert rows(summary.checks(days, days, dim, ts), *names) == rows(quality.run_checks(table, dim, ts), *names)


def test_the_skip_reads_only_the_ingest_dates_of_the_load(spark, root, dim):
    import shutil

    def dated(name, day):
        folder = land(root, name, {"BLR": response(0, 5, START)}, day)[0]
        to = f"{L.at(root, 'landing')}/ingest_date=2027-09-{day:02}"
        shutil.copytree(folder, to)
        return [to]

    loads = [dated(f"r{d}", d) for d in (1, 2, 3)]
    assert [L.load_bronze(spark, f, root) for f in loads] == [1, 1, 1]
    again = L.fresh_lines(spark, loads[1], root)
    plan = again._jdf.queryExecution().executedPlan().toString()
    filters = next(part for part in plan.split("FileScan parquet")[1:] if "ingest_date" in part)
    assert "PartitionFilters" in filters and "2027-09-02" in filters and "2027-09-01" not in filters
    assert "from_json" not in plan and again.count() == 0  # an old file offered again is skipped, unparsed
    assert L.load_bronze(spark, loads[0] + loads[2], root) == 0


def test_silver_as_of_each_run(spark, root, dim, first):
    states = {"first": rows(L.stored(spark, root, "silver"), "city_id", "ts_utc", "pm2_5", "run_id")}
    for i, day in enumerate((7, 9)):
        late = {"BLR": response(0, 6, START + dt.timedelta(hours=20 + 3 * i), scale_pm25=2.0 + i)}
        files = land(root, f"late{i}", late, day)
        if i:  # merged, but not published: the next run merges the same rows again, which changes nothing
            with broken("publish"), pytest.raises(ConnectionError):
                L.run(spark, root, dim, landing_files=files, run_id="late1")
        L.run(spark, root, dim, landing_files=[] if i else files, run_id=f"late{i}" if not i else "again")
        states["again" if i else "late0"] = rows(L.stored(spark, root, "silver"), "city_id", "ts_utc", "pm2_5", "run_id")
    read = L.silver_as_of(spark, root, {n: t for n, t in L.run_times(spark, root).items() if n in states})
    for name, want in states.items():
        assert rows(read.where(F.col("as_of") == name), "city_id", "ts_utc", "pm2_5", "run_id") == want


def test_before_images_of_a_broken_commit_are_not_history(spark, root, dim, first, monkeypatch):
    files = land(root, "late", {"BLR": response(0, 4, START, scale_pm25=2.0)}, 7)
    from airshed.operators.upsert import StagedMerge

    real = StagedMerge.candidate
    with monkeypatch.context() as m:
        m.setattr(StagedMerge, "candidate", property(lambda self: (_ for _ in ()).throw(ConnectionError("commit"))))
        with pytest.raises(ConnectionError):
            L.run(spark, root, dim, landing_files=files, run_id="late")
    assert StagedMerge.candidate is real and L.stored(spark, root, "revisions").count() == 4
    now = {"now": dt.datetime.now()}
    assert L.silver_as_of(spark, root, now).count() == L.stored(spark, root, "silver").count() == 144
    L.run(spark, root, dim, run_id="next")
    assert L.stored(spark, root, "revisions").count() == 8
    both = L.silver_as_of(spark, root, {"first": L.run_times(spark, root)["first"], "now": dt.datetime.now()})
    assert both.groupBy("as_of").count().collect()[0]["count"] == 144 and both.count() == 288


def test_rebuild_to_nothing_and_on(spark, root, dim, first):
    future = {"BLR": response(0, 5, dt.datetime(2030, 1, 1))}
    assert L.run(spark, root, dim, landing_files=land(root, "forecast", future, 9), run_id="forecast")["silver_inserted"] == 0
    bronze = L.stored(spark, root, "bronze").where("run_id = 'forecast'")
    kept = spark.createDataFrame(bronze.collect(), bronze.schema)
    fs.delete(spark, L.at(root, "bronze"))
    L.append_bronze(spark, kept, root)
    assert L.rebuild(spark, root, dim) == 0
    assert [L.stored(spark, root, t).count() for t in ("silver", "gold", "summary")] == [0, 0, 0]
    assert L.latest_aqi(spark, root).count() == 0
    done = L.run(spark, root, dim, landing_files=land(root, "second", WIDE, 11), run_id="second", mode="incremental", today=dt.date(2026, 9, 9))
    assert done["silver_inserted"] == 144 and done["window_start"] == dt.date(2026, 8, 10)
    assert gold_is_current(spark, root) and summary_is_current(spark, root)
