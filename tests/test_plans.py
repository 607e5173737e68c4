"""Plan shape: the properties the design relies on at scale, read from the executed plans."""

from __future__ import annotations

import os
import re

import pytest
from pyspark.sql import functions as F

from airshed.operators import upsert
from airshed.plans import registry as R

SF = os.environ.get("AIRSHED_TEST_SF", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.exists(f"{SF}/lineitem.parquet"), reason="driver tables not present")


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def _hash_exchanges(plan: str) -> int:
    return len(re.findall(r"(?<!Reused)Exchange hashpartitioning", plan))


def test_daily_job_is_two_shuffles_and_window_feeds_aggregate_directly(spark):
    plan = _plan(R.q_daily_aqi(spark, SF))
    assert _hash_exchanges(plan) == 2
    assert "SinglePartition" not in plan
    # no exchange between the rolling window and the daily aggregate above it
    lines = [ln.strip(" :+-*()0123456789") for ln in plan.splitlines()]
    window_at = next(i for i, ln in enumerate(lines) if ln.startswith("Window"))
    agg_at = max(i for i, ln in enumerate(lines[:window_at]) if "HashAggregate" in ln)
    assert not any("Exchange" in ln for ln in lines[agg_at:window_at])


def test_dedupe_reduces_before_the_shuffle(spark):
    plan = _plan(R.q_dedupe_latest(spark, SF))
    assert "partial_max" in plan
    partial_at = plan.index("partial_max")
    exchange_at = plan.index("Exchange hashpartitioning")
    assert exchange_at < partial_at  # printed top-down: the partial aggregate sits below the exchange


def test_scan_reads_only_needed_columns(spark):
    schema = re.search(r"ReadSchema: struct<([^>]*)>", _explain(R.q_daily_aqi(spark, SF)))
    cols = {c.split(":")[0] for c in schema.group(1).split(",")}
    assert cols <= {"l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice",
                    "l_discount", "l_tax"}
    assert "l_returnflag" not in cols and "l_shipdate" not in cols


def _explain(df) -> str:
    return df._jdf.queryExecution().explainString(
        df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))


def test_merge_reads_only_touched_partitions(spark, tmp_path):
    silver = R.silver_from_readings(spark, SF)
    path = str(tmp_path / "silver")
    silver.write.partitionBy("obs_date_ist").parquet(path)
    batch = R.silver_of(R.hourly_readings(spark, SF).where("l_linenumber > 5 AND l_quantity > 45"))
    target = spark.read.parquet(path)
    touched = target.join(F.broadcast(batch.select("obs_date_ist").distinct()), "obs_date_ist", "left_semi")
    text = _explain(upsert.merge_plan(touched, batch, columns=silver.columns))
    assert "dynamicpruningexpression(obs_date_ist" in text


def test_dimension_join_has_no_hint(spark):
    df = R.q_latest_aqi_ranked(spark, SF)
    assert "ResolvedHint" not in df._jdf.queryExecution().analyzed().toString()  # AQE decides from measured bytes


def test_the_report_computes_the_daily_index_once(spark):
    """Ranks come from a written table in range partitions: what is left to run reads that table, not the readings."""
    report = R.q_ranked_report_rows(spark, SF)
    assert not any("lineitem" in f for f in report.inputFiles())
    assert "Window" in _plan(report) and "_part" in _plan(report)


def test_partitioned_writes_are_rebalanced(spark, tmp_path):
    import datetime as dt

    from airshed.operators.publish import write_days

    days = [dt.date(2026, 1, 1) + dt.timedelta(days=k) for k in range(5)]
    rows = spark.range(5000).repartition(16).selectExpr("id", "date_add(DATE '2026-01-01', CAST(id % 5 AS INT)) AS obs_date_ist")
    assert write_days(spark, rows, str(tmp_path / "t"), days) == 5000
    assert len(list((tmp_path / "t").glob("*/part-*"))) == 5  # and not 16 x 5


def test_cluster_sizing_follows_the_input(spark):
    from airshed.session import cluster_conf

    parts = lambda size: int(cluster_conf(size, 8000)["spark.sql.shuffle.partitions"])
    assert parts(1 << 30) == 24000 and parts(1 << 50) == 1 << 20
