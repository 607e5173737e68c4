"""Declared schemas of every layer (no inference anywhere)."""

from __future__ import annotations

from pyspark.sql import types as T

from .config import POLLUTANTS, VALUE_COLS

# Landing line: every field a string, as written by the envelope writer.
LANDING_SCHEMA = T.StructType([
    T.StructField(name, T.StringType())
    for name in ["run_id", "ingested_at", "source", "city_id", "window_start", "window_end", "payload"]
])
# A writer that lands an hour more than once in a run numbers the versions in a further field; a line without it is version 0.
VERSIONED_LANDING = T.StructType([*LANDING_SCHEMA.fields, T.StructField("version", T.LongType())])

# Source response, as far as we read it; other fields are ignored. Its field names.
_HOURLY_DDL = ", ".join(["time: array<string>", *(f"{api}: array<double>" for api in POLLUTANTS)])
_RESPONSE_DDL = f"struct<latitude: double, longitude: double, hourly: struct<{_HOURLY_DDL}>>"
PAYLOAD_SCHEMA = _RESPONSE_DDL
# A saved response file holds a JSON array of responses (or a lone response).
RESPONSES_SCHEMA = f"array<{_RESPONSE_DDL}>"

BRONZE_COLUMNS = ["run_id", "ingested_at", "source", "city_id", "window_start", "window_end", "payload",
                  "source_file", "source_path", "ingest_date", "version"]

SILVER_COLUMNS = [
    "city_id", "ts_utc", "obs_date_ist", "obs_hour_ist", "pm2_5", "pm10", "no2", "so2", "o3", "co_mg_m3",
    "grid_latitude", "grid_longitude", "run_id", "ingested_at", "updated_at",
]

# Field names of the check and audit tables.
CHECK_DDL = "run_id string, check_name string, severity string, passed boolean, observed string"
AUDIT_DDL = ("run_id string, mode string, window_start date, window_end date, status string, bronze_rows bigint, "
             "silver_inserted bigint, silver_updated bigint, gold_rows bigint, error string")
# End of fixed values.
PUBLISH_LOG_DDL = "merge_id string, obs_date_ist date, event string"
SUMMARY_DDL = ("city_id string, rows bigint, newest timestamp_ntz, null_keys bigint, negative bigint, implausible bigint, "
               "duplicate_keys bigint, obs_date_ist date")

_VALUES = ", ".join(f"{c} double" for c in VALUE_COLS)
_SILVER_DDL = (f"city_id string, ts_utc timestamp_ntz, obs_hour_ist int, {_VALUES}, grid_latitude double, grid_longitude double, "
               "run_id string, ingested_at timestamp_ntz, updated_at timestamp")
_GOLD_DDL = ("city_id string, aqi int, aqi_category string, prominent_pollutant string, pollutants_reported int, pm2_5_24h double, pm10_24h double, "
             "no2_24h double, so2_24h double, o3_8h_max double, co_8h_max_mg_m3 double, si_pm2_5 int, si_pm10 int, si_no2 int, si_so2 int, si_o3 int, "
             "si_co int, pm2_5_hours bigint, pm10_hours bigint, no2_hours bigint, so2_hours bigint, o3_hours bigint, co_hours bigint, computed_at timestamp")

# Every table of the lakehouse is read with its declared columns, so that one without rows (or without a single file) is a table.
# The dimension has none: its columns may change between versions.
TABLE_DDL = {
    "bronze": "run_id string, ingested_at timestamp_ntz, source string, city_id string, window_start date, window_end date, payload string, "
              "source_file string, source_path string, ingest_date string, version bigint",
    "silver": f"{_SILVER_DDL}, obs_date_ist date",
    "revisions": f"{_SILVER_DDL}, obs_date_ist date, superseded_by_run string, superseded_at timestamp, revised_at timestamp",
    "gold": f"{_GOLD_DDL}, obs_date_ist date",
    "summary": SUMMARY_DDL,
    "audit": f"{AUDIT_DDL}, finished_at timestamp",
    "checks": f"{CHECK_DDL}, checked_at timestamp",
    "publish_log": f"{PUBLISH_LOG_DDL}, logged_at timestamp",
    "publish_keys": "city_id string, obs_date_ist date, merge string",
}
