"""UTC <-> local reporting time as exact interval arithmetic on TIMESTAMP_NTZ.

The reporting zone has a fixed offset (no daylight saving), so local time is UTC plus the
offset; no session time zone is involved, and the same expression runs in any SQL engine.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..config import LOCAL_OFFSET_MINUTES

def local_ts(ts_utc: Column, offset_minutes: int = LOCAL_OFFSET_MINUTES) -> Column:
    return ts_utc + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(offset_minutes))


def local_date(ts_utc: Column, offset_minutes: int = LOCAL_OFFSET_MINUTES) -> Column:
    return F.to_date(local_ts(ts_utc, offset_minutes))


def local_hour(ts_utc: Column, offset_minutes: int = LOCAL_OFFSET_MINUTES) -> Column:
    return F.hour(local_ts(ts_utc, offset_minutes))


def local_day_start_utc(day: Column, offset_minutes: int = LOCAL_OFFSET_MINUTES) -> Column:
    """UTC instant (NTZ) at which local calendar day `day` begins."""
    return day.cast("timestamp_ntz") - F.make_dt_interval(F.lit(0), F.lit(0), F.lit(offset_minutes))


def epoch_micros(ts_ntz: Column) -> Column:
    """Microseconds since 1970-01-01 of an NTZ timestamp, read as UTC wall clock (exact, no zone)."""
    frac = (F.date_part(F.lit("SECOND"), ts_ntz) * F.lit(1_000_000)).cast("long") % F.lit(1_000_000)
    return F.unix_timestamp(ts_ntz) * F.lit(1_000_000) + frac


def to_utc_ntz(ts_ltz: Column) -> Column:
    """Instant (TIMESTAMP) -> its UTC wall clock as TIMESTAMP_NTZ, whatever the session zone."""
    return F.convert_timezone(None, F.lit("UTC"), ts_ltz)


def parse_utc_hour(text: Column) -> Column:
    """'yyyy-MM-ddTHH:mm' (UTC wall clock) -> TIMESTAMP_NTZ; anything else -> null, never an error."""
    shape = text.rlike(r"^\d{4}-\d{2}-\d{2}T\d{2}:\d{2}$")
    part = lambda pos, n: F.substring(text, pos, n).try_cast("int")
    ts = F.try_make_timestamp_ntz(part(1, 4), part(6, 2), part(9, 2), part(12, 2), part(15, 2), F.lit(0))
    return F.when(shape, ts)
