"""Adapter views that express the driver's TPC-H-style tables as air-quality inputs.

`readings` turns every `lineitem` row into one hourly observation (bronze-level, before
dedupe): one site per supplier, 240 UTC hours from 2024-01-01, seven ingestion runs
(one per line number), and six pollutant values derived from the row. The same view is
defined as SQL text for the DuckDB check, with the same operation order so that doubles
agree bit for bit. Sites grow with the data (one per supplier), so the hourly grid and
every downstream stage grow linearly with the scale factor.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

HOURS_SPAN = 240
GRID_START = _dt.datetime(2024, 1, 1)
INGEST_BASE = _dt.datetime(2024, 2, 1)
# Ingestion time base for the forecast-hour query: inside the span, so later hours are "future".
EARLY_INGEST_BASE = _dt.datetime(2024, 1, 4)

# Tie-breakers that make the latest-version order total (the pair orderkey/linenumber repeats).
TIEBREAK_COLS = ["l_orderkey", "l_partkey", "l_suppkey", "l_extendedprice", "l_quantity", "l_discount", "l_tax"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def readings_exprs(*, early_ingest: bool = False) -> list[str]:
    """The adapter's columns as Spark SQL expressions (one projection, one JVM call)."""
    k = "(l_suppkey % 5)"
    if early_ingest:
        ingested = "timestampadd(DAY, l_linenumber, TIMESTAMP_NTZ '2024-01-04 00:00:00')"
    else:
        ingested = "timestampadd(HOUR, l_linenumber, TIMESTAMP_NTZ '2024-02-01 00:00:00')"
    return [
        "concat('C', CAST(l_suppkey AS STRING)) AS city_id",
        f"timestampadd(HOUR, (l_orderkey * 7 + l_linenumber) % {HOURS_SPAN}, TIMESTAMP_NTZ '2024-01-01 00:00:00') "
        "AS ts_utc",
        "concat('run-', CAST(l_linenumber AS STRING)) AS run_id",
        f"{ingested} AS ingested_at",
        f"l_quantity * (CAST(0.3 AS DOUBLE) + CAST(1.5 AS DOUBLE) * {k}) AS pm2_5",
        f"l_extendedprice / CAST(1000.0 AS DOUBLE) * (CAST(0.5 AS DOUBLE) + CAST(1.5 AS DOUBLE) * {k}) AS pm10",
        f"l_discount * CAST(400.0 AS DOUBLE) * (CAST(1.0 AS DOUBLE) + {k}) AS no2",
        f"CASE WHEN l_partkey % 10 >= 3 THEN l_tax * CAST(300.0 AS DOUBLE) * (CAST(1.0 AS DOUBLE) + {k}) END AS so2",
        f"(l_partkey % 200) * (CAST(0.2 AS DOUBLE) + CAST(0.2 AS DOUBLE) * {k}) AS o3",
        f"(l_orderkey % 50) * CAST(20.0 AS DOUBLE) * (CAST(1.0 AS DOUBLE) + {k}) AS co",
        "CAST(8.0 AS DOUBLE) + (l_suppkey % 29) AS latitude",
        "CAST(68.0 AS DOUBLE) + (l_suppkey % 23) AS longitude",
    ]


def readings(spark: SparkSession, sf_dir: str, *, early_ingest: bool = False, keep_source: bool = False) -> DataFrame:
    """Hourly observations in source units (co in ug/m3), one per lineitem row."""
    extra = TIEBREAK_COLS + ["l_linenumber"] if keep_source else []
    return table(spark, sf_dir, "lineitem").selectExpr(*readings_exprs(early_ingest=early_ingest), *extra)


def dim_city(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One site per supplier: name = supplier name, state = its nation."""
    s = table(spark, sf_dir, "supplier")
    n = table(spark, sf_dir, "nation")
    return s.join(n, s.s_nationkey == n.n_nationkey, "left").select(
        F.concat(F.lit("C"), F.col("s_suppkey").cast("string")).alias("city_id"),
        F.col("s_name").alias("name"),
        F.col("n_name").alias("state"),
        (F.lit(8.0) + (F.col("s_suppkey") % 29)).alias("latitude"),
        (F.lit(68.0) + (F.col("s_suppkey") % 23)).alias("longitude"),
    )


# Faults put into the readings by column values, so that every check and drop rule has rows to find.
FAULT_EXPRS = [
    "CASE WHEN l_partkey % 97 <> 0 THEN city_id END AS city_id",
    "CASE WHEN l_partkey % 31 <> 0 THEN date_format(ts_utc, \"yyyy-MM-dd'T'HH:mm\") WHEN l_partkey % 2 = 0 THEN '2024-13-45T99:99' END AS hour_text",
    "run_id", "ingested_at",
    "CASE WHEN l_partkey % 37 = 0 THEN NULL WHEN l_partkey % 41 = 0 THEN -1 - pm2_5 WHEN l_partkey % 43 = 0 THEN pm2_5 + 2000 ELSE pm2_5 END AS pm2_5",
    *[f"CASE WHEN l_partkey % 37 <> 0 THEN {c} END AS {c}" for c in ("pm10", "no2", "so2")],
    "CASE WHEN l_partkey % 37 = 0 AND l_partkey % 2 = 0 THEN CAST('NaN' AS DOUBLE) WHEN l_partkey % 37 <> 0 THEN o3 END AS o3",
    "CASE WHEN l_partkey % 37 <> 0 THEN co END AS co",
    "latitude AS grid_latitude", "longitude AS grid_longitude",
]


def faulty_readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All readings, some with null site, unparsable hour text, a negative or too high PM2.5, or no value at all."""
    return readings(spark, sf_dir, keep_source=True).selectExpr(*FAULT_EXPRS)


def sites_with_gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The sites and one more for each region, which has no readings."""
    extra = table(spark, sf_dir, "region").select(F.concat(F.lit("R"), F.col("r_regionkey").cast("string")).alias("city_id"))
    return dim_city(spark, sf_dir).select("city_id").unionByName(extra)


def repeated_sites(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The sites and one more for each nation, whose ids some sites already have."""
    extra = table(spark, sf_dir, "nation").select(F.concat(F.lit("C"), F.col("n_nationkey").cast("string")).alias("city_id"))
    return dim_city(spark, sf_dir).select("city_id").unionByName(extra)


# ------------------------------------------------------------------------- SQL text (DuckDB)


def readings_sql(*, early_ingest: bool = False, keep_source: bool = False) -> str:
    ingested = ("TIMESTAMP '2024-01-04 00:00:00' + to_days(l_linenumber)" if early_ingest
                else "TIMESTAMP '2024-02-01 00:00:00' + to_hours(l_linenumber)")
    extra = (", " + ", ".join(TIEBREAK_COLS + ["l_linenumber"])) if keep_source else ""
    return f"""SELECT
  'C' || CAST(l_suppkey AS VARCHAR) AS city_id,
  TIMESTAMP '2024-01-01 00:00:00' + to_hours(CAST((l_orderkey * 7 + l_linenumber) % {HOURS_SPAN} AS BIGINT)) AS ts_utc,
  'run-' || CAST(l_linenumber AS VARCHAR) AS run_id,
  {ingested} AS ingested_at,
  l_quantity * (0.3::DOUBLE + 1.5::DOUBLE * (l_suppkey % 5)) AS pm2_5,
  l_extendedprice / 1000.0::DOUBLE * (0.5::DOUBLE + 1.5::DOUBLE * (l_suppkey % 5)) AS pm10,
  l_discount * 400.0::DOUBLE * (1.0::DOUBLE + (l_suppkey % 5)) AS no2,
  CASE WHEN l_partkey % 10 >= 3 THEN l_tax * 300.0::DOUBLE * (1.0::DOUBLE + (l_suppkey % 5)) END AS so2,
  (l_partkey % 200) * (0.2::DOUBLE + 0.2::DOUBLE * (l_suppkey % 5)) AS o3,
  (l_orderkey % 50) * 20.0::DOUBLE * (1.0::DOUBLE + (l_suppkey % 5)) AS co,
  8.0::DOUBLE + (l_suppkey % 29) AS latitude,
  68.0::DOUBLE + (l_suppkey % 23) AS longitude{extra}
FROM lineitem"""


DIM_CITY_SQL = """SELECT 'C' || CAST(s_suppkey AS VARCHAR) AS city_id, s_name AS name, n_name AS state,
  8.0::DOUBLE + (s_suppkey % 29) AS latitude, 68.0::DOUBLE + (s_suppkey % 23) AS longitude
FROM supplier LEFT JOIN nation ON s_nationkey = n_nationkey"""


def faulty_sql() -> str:
    """The faulty readings; hour_text as a timestamp that is null where it can't be parsed."""
    values = ", ".join(f"CASE WHEN l_partkey % 37 <> 0 THEN {c} END AS {c}" for c in ("pm10", "no2", "so2"))
    return f"""SELECT CASE WHEN l_partkey % 97 <> 0 THEN city_id END AS city_id,
  CASE WHEN l_partkey % 31 <> 0 THEN ts_utc END AS ts_utc, run_id, ingested_at,
  CASE WHEN l_partkey % 37 = 0 THEN NULL WHEN l_partkey % 41 = 0 THEN -1 - pm2_5 WHEN l_partkey % 43 = 0 THEN pm2_5 + 2000 ELSE pm2_5 END AS pm2_5,
  {values}, CASE WHEN l_partkey % 37 = 0 AND l_partkey % 2 = 0 THEN 'NaN'::DOUBLE WHEN l_partkey % 37 <> 0 THEN o3 END AS o3,
  CASE WHEN l_partkey % 37 <> 0 THEN co END AS co
FROM ({readings_sql(keep_source=True)})"""
