"""Data-quality gate on silver (Q1..Q8, P12, P13, A5..A7).

All checks come out as one long DataFrame (check_name, severity, passed, observed). The
row-level checks share one scan (`count_if` per check), the duplicate-key check is one
partial/final aggregate, and the missing-site check is an anti join against the dimension;
nothing but the final handful of result rows reaches the driver.
"""

from __future__ import annotations

import datetime as _dt
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..config import FRESHNESS_HOURS, MAX_PLAUSIBLE, SILVER_KEY, VALUE_COLS
from ..schemas import CHECK_DDL

CRITICAL, WARNING = "critical", "warning"


class GateBlocked(RuntimeError):
    """Critical checks failed; `checks` has their names. Their results are on record."""

    def __init__(self, checks: list[str]):
        super().__init__(f"{len(checks)} critical checks failed: {', '.join(checks)}")
        self.checks = checks


def any_negative(cols: list[str] = VALUE_COLS) -> Column:
    """Some value below zero; nulls are no values."""
    return reduce(or_, [F.coalesce(F.col(c) < 0, F.lit(False)) for c in cols])


def any_implausible(limits: dict[str, float] = MAX_PLAUSIBLE) -> Column:
    """Some value above its column's limit; nulls are no values."""
    return reduce(or_, [F.coalesce(F.col(c) > F.lit(float(top)), F.lit(False)) for c, top in limits.items()])


def _check(name: str, severity: str, passed: Column, observed: Column) -> list[Column]:
    return [F.lit(name).alias("check_name"), F.lit(severity).alias("severity"),
            passed.alias("passed"), observed.alias("observed")]


def _unpivot(one_row: DataFrame, checks: list[list[Column]]) -> DataFrame:
    """Several checks computed from one aggregate row -> one output row each (no re-evaluation)."""
    rows = F.explode(F.array(*[F.struct(*c) for c in checks])).alias("_c")
    return one_row.select(rows).select("_c.*")


def duplicate_keys(silver: DataFrame, keys: list[str] = SILVER_KEY) -> DataFrame:
    """Q1/A5: number of keys that occur more than once (one row)."""
    return _duplicates(silver.groupBy(*keys).count().where(F.col("count") > 1).agg(F.count("*").alias("n")))


def _duplicates(counted: DataFrame) -> DataFrame:
    return counted.select(*_check("unique_city_hour", CRITICAL, F.col("n") == 0,
                                F.concat(F.col("n").cast("string"), F.lit(" duplicate keys"))))


def row_checks(silver: DataFrame) -> DataFrame:
    """Q2, Q3, Q4 from one scan of silver: A6 filtered counts as `count_if`."""
    return _row_results(silver.agg(
        F.count_if(F.col("city_id").isNull() | F.col("ts_utc").isNull()).alias("null_keys"),
        F.count_if(any_negative()).alias("negative"),
        F.count_if(any_implausible()).alias("implausible"),
    ))


def _row_results(stats: DataFrame) -> DataFrame:
    rows = lambda c: F.concat(F.col(c).cast("string"), F.lit(" rows"))
    return _unpivot(stats, [
        _check("not_null_keys", CRITICAL, F.col("null_keys") == 0, rows("null_keys")),
        _check("no_negative_concentrations", CRITICAL, F.col("negative") == 0, rows("negative")),
        _check("plausible_concentrations", WARNING, F.col("implausible") == 0, rows("implausible")),
    ])


def freshness(silver: DataFrame, as_of: _dt.datetime) -> DataFrame:
    """The latest stored hour lies within FRESHNESS_HOURS before `as_of` (one row)."""
    return fresh_enough(silver.agg(F.max("ts_utc").alias("latest")), as_of)


def fresh_enough(newest: DataFrame, as_of: _dt.datetime) -> DataFrame:
    """Q6 from one row with the `latest` hour."""
    # a string cast keeps the clock value exact whatever the session or process time zone
    limit = F.lit(as_of.isoformat(sep=" ")).cast("timestamp_ntz") - F.make_dt_interval(F.lit(0), F.lit(FRESHNESS_HOURS))
    shown = F.coalesce(F.date_format("latest", "yyyy-MM-dd HH:mm"), F.lit("NULL"))
    return newest.select(*_check(
        f"fresh_within_{FRESHNESS_HOURS}h", WARNING, F.coalesce(F.col("latest") >= limit, F.lit(False)),
        F.concat(F.lit("latest hour "), shown, F.lit(" UTC"))))


def missing_sites(silver: DataFrame, expected: DataFrame) -> DataFrame:
    """Number of expected sites without any silver row (one row); the sites are `missing_site_rows`."""
    missing = missing_site_rows(silver, expected).agg(F.count(F.lit(1)).alias("n"))
    observed = F.concat(F.lit("missing: "), F.col("n").cast("string"), F.lit(" sites"))
    return missing.select(*_check("all_cities_present", WARNING, F.col("n") == 0, observed))


def missing_site_rows(silver: DataFrame, expected: DataFrame) -> DataFrame:
    """J5 as rows: one row per expected site with no silver data (no list building)."""
    present = silver.select("city_id").distinct()
    return expected.select("city_id").distinct().join(present, "city_id", "left_anti")


def run_checks(silver: DataFrame, expected: DataFrame, as_of: _dt.datetime | None = None) -> DataFrame:
    """Q7: all checks of a table as one long DataFrame; freshness only when `as_of` (live runs) is given."""
    out = row_checks(silver).unionByName(duplicate_keys(silver)).unionByName(missing_sites(silver, expected))
    return out if as_of is None else out.unionByName(freshness(silver, as_of))


def results(row_counts: DataFrame, duplicates: DataFrame, missing: DataFrame, fresh: DataFrame | None) -> DataFrame:
    """Q7 from counts taken elsewhere: one row of row counts, one of repeated keys (`n`), and finished site and freshness checks."""
    out = _row_results(row_counts).unionByName(_duplicates(duplicates)).unionByName(missing)
    return out if fresh is None else out.unionByName(fresh)


def gate_decision(results: DataFrame) -> DataFrame:
    """Q8 as a DataFrame: one row saying whether the run may publish and which checks block it."""
    failed = F.col("severity") == CRITICAL
    blocking = F.when(failed & ~F.col("passed"), F.col("check_name"))
    return results.agg(
        (F.count_if(failed & ~F.col("passed")) == 0).alias("may_publish"),
        F.sort_array(F.collect_list(blocking)).alias("blocking_checks"),
        F.count_if(~F.col("passed")).alias("failed_checks"),
    )


def record_and_enforce(spark: SparkSession, results: DataFrame, run_id: str, checks_path: str) -> None:
    """Q8: append the results with run id and time; raise if a critical check failed.

    What is recorded is read back for the decision, so both come from one evaluation: one row a check.
    """
    stamped = results.select(F.lit(run_id).alias("run_id"), *[f.split()[0] for f in CHECK_DDL.split(", ")][1:],
                             F.current_timestamp().alias("checked_at"))
    decided = Observation("gate")
    blocking = F.when((F.col("severity") == CRITICAL) & ~F.col("passed"), F.col("check_name"))
    stamped.coalesce(1).observe(decided, F.collect_list(blocking).alias("blocking")).write.mode("append").parquet(checks_path)
    if failed := sorted(decided.get["blocking"]):
        raise GateBlocked(failed)
