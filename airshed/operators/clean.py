"""Bronze -> silver: parse, explode, type, clean and dedupe hourly readings (P1..P9, W1, X10)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import POLLUTANTS, VALUE_COLS
from ..functions.localtime import local_date, local_hour, parse_utc_hour
from ..schemas import PAYLOAD_SCHEMA, SILVER_COLUMNS
from .dedupe import latest_per_key


def parse_payload(bronze: DataFrame) -> DataFrame:
    """Payload JSON string -> struct `p` with the declared schema (bad JSON -> null fields)."""
    return bronze.withColumn("p", F.from_json("payload", PAYLOAD_SCHEMA))


def explode_hours(parsed: DataFrame, carry: list[str]) -> DataFrame:
    """P2 (posexplode), P3 (positional pick), P4 (nested fields): one row per element of
    `p.hourly.time`, taking the same position of each value array.

    `get` returns null past the end of a shorter (ragged) or missing array instead of failing.
    Columns in `carry` are kept; `pos` is the element position.
    """
    rows = parsed.select(*carry, "p", F.posexplode("p.hourly.time").alias("pos", "time_str"))
    values = [F.get(F.col(f"p.hourly.{api}"), F.col("pos")).alias(col) for api, col in POLLUTANTS.items()]
    return rows.select(
        *carry,
        "pos",
        parse_utc_hour(F.col("time_str")).alias("ts_utc"),
        *values,
        F.col("p.latitude").alias("grid_latitude"),
        F.col("p.longitude").alias("grid_longitude"),
    )


def _no_nan(c: Column) -> Column:
    return F.when(~F.isnan(c), c)


def clean_hours(hourly: DataFrame) -> DataFrame:
    """P5..P9 on typed hourly rows (value columns named as in POLLUTANTS, `co` in ug/m3).

    NaN becomes null (it would otherwise sort above every band and score 500); CO moves to
    mg/m3 (P5); local date/hour are derived (P6); rows with no parseable hour (P7), future
    (forecast) hours (P8) and hours with no value at all (P9) are dropped. One projection, one
    filter.
    """
    value_of = {col: _no_nan(F.col(col).cast("double")) for col in POLLUTANTS.values()}
    value_of["co_mg_m3"] = value_of.pop("co") / F.lit(1000.0)
    keep = [c for c in hourly.columns if c not in POLLUTANTS.values()]
    out = hourly.select(
        *keep,
        *[value_of[c].alias(c) for c in VALUE_COLS],
        local_date(F.col("ts_utc")).alias("obs_date_ist"),
        local_hour(F.col("ts_utc")).alias("obs_hour_ist"),
    )
    return out.where(
        F.col("ts_utc").isNotNull()
        & (F.col("ts_utc") <= F.col("ingested_at"))
        & F.coalesce(*[F.col(c) for c in VALUE_COLS]).isNotNull()
    )


def newest_first(tiebreak: list[str] | None = None) -> list[str]:
    """Version order, largest wins: latest ingestion, then highest run id, then caller tie-breakers."""
    return ["ingested_at", "run_id", *(tiebreak or [])]


def to_silver(hourly: DataFrame, tiebreak: list[str] | None = None, *, audit: bool = True) -> DataFrame:
    """Clean + keep the latest version per (city_id, ts_utc) + fixed silver columns (P17), with
    the audit time `updated_at` (P16) unless `audit=False`."""
    latest = latest_per_key(clean_hours(hourly), ["city_id", "ts_utc"], newest_first(tiebreak))
    cols = [c for c in SILVER_COLUMNS if c != "updated_at"]
    if audit:
        return latest.withColumn("updated_at", F.current_timestamp()).select(*SILVER_COLUMNS)
    return latest.select(*cols)


def silver_transform(bronze: DataFrame, *, audit: bool = True) -> DataFrame:
    """Bronze envelopes (payload JSON) -> one silver row per (city_id, ts_utc).

    Among versions with equal ingestion time and run id, the higher `version` (without such a column: the version number in
    the landing path), then the later path (`source_path`, else `source_file`) and then the later array position win, so
    the result does not depend on task order.
    """
    origin = "source_path" if "source_path" in bronze.columns else "source_file"
    in_path = F.regexp_extract(origin, r"(?:/version=|_v)([0-9]+)(?:/|_landing)", 1).try_cast("long")
    numbered = bronze.withColumn("version_no", F.coalesce(F.col("version") if "version" in bronze.columns else in_path, F.lit(0).cast("long")))
    carry = ["city_id", "run_id", "ingested_at", "version_no", origin]
    hourly = explode_hours(parse_payload(numbered), carry)
    return to_silver(hourly, ["version_no", origin, "pos"], audit=audit)
