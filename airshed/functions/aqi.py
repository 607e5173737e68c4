"""Index scoring as plain Catalyst expressions (no UDF): sub-index, category, overall index.

Each rule is generated once, from the band table in `breakpoints`, as SQL expression text; the
Spark Column is that text parsed by Spark (`F.expr`), so building a query costs one JVM call per
expression. The SQL check has the rules written out on its own.
Arguments are SQL expressions over column names (e.g. "pm2_5_24h").
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .breakpoints import (
    BANDS,
    INDEX_MAX,
    MIN_POLLUTANTS_FOR_AQI,
    PARTICULATES,
    POLLUTANT_ORDER,
    interpolation_segments,
)
from .numeric import round_half_up_sql


def _dbl(x: float) -> str:
    return f"CAST({float(x)!r} AS DOUBLE)"


def _bands(pollutant: str) -> list[tuple[float | None, float, float, float, float]]:
    """(upper bound or None, i_lo, index span, c_lo, concentration span) per band, in order.

    Spans are computed once here (IEEE double subtraction, as in any engine), so every engine
    evaluates exactly i_lo + i_span * (c - c_lo) / c_span.
    """
    return [(upper, float(i_lo), float(i_hi) - float(i_lo), c_lo, c_top - c_lo)
            for upper, i_lo, i_hi, c_lo, c_top in interpolation_segments(pollutant)]


def sub_index_sql(pollutant: str, conc: str, tolerance: float = 0.0) -> str:
    """Sub-index (INT) of one pollutant concentration; null concentration gives null.

    Linear inside the first band whose upper concentration is >= conc; bands have gaps, so a
    value between two bands extrapolates the next band below its floor. Clamped to 0..500,
    rounded half up. greatest/least skip nulls, so the null test is explicit.
    """
    arms = []
    for upper, i_lo, i_span, c_lo, c_span in _bands(pollutant):
        cond = f"({conc}) IS NOT NULL" if upper is None else f"({conc}) <= {_dbl(upper)}"
        arms.append(f"WHEN {cond} THEN {_dbl(i_lo)} + {_dbl(i_span)} * (({conc}) - {_dbl(c_lo)}) / {_dbl(c_span)}")
    raw = "(CASE " + " ".join(arms) + " END)"
    bounded = f"least(greatest({raw}, {_dbl(0)}), {_dbl(INDEX_MAX)})"
    return f"(CASE WHEN ({conc}) IS NOT NULL THEN CAST({round_half_up_sql(bounded, 0, tolerance)} AS INTEGER) END)"


def category_sql(aqi: str) -> str:
    """Category name, first band whose top is >= aqi; null stays null."""
    arms = " ".join(f"WHEN ({aqi}) <= {i_hi} THEN '{name}'" for _, i_hi, name in BANDS)
    return f"(CASE {arms} END)"


def pollutants_reported_sql(si: dict[str, str]) -> str:
    """Number of pollutants with a sub-index (INT)."""
    return "(" + " + ".join(f"(CASE WHEN {si[p]} IS NOT NULL THEN 1 ELSE 0 END)" for p in POLLUTANT_ORDER) + ")"


def overall_index_sql(si: dict[str, str]) -> str:
    """Highest sub-index, only with >= 3 sub-indices of which one is a particulate."""
    has_pm = " OR ".join(f"{si[p]} IS NOT NULL" for p in PARTICULATES)
    top = "greatest(" + ", ".join(si[p] for p in POLLUTANT_ORDER) + ")"
    return (f"(CASE WHEN {pollutants_reported_sql(si)} >= {MIN_POLLUTANTS_FOR_AQI} AND ({has_pm}) "
            f"THEN {top} END)")


def main_pollutant_sql(si: dict[str, str], aqi: str) -> str:
    """First pollutant, in fixed order, whose sub-index equals the index."""
    arms = " ".join(f"WHEN {si[p]} = {aqi} THEN '{p}'" for p in POLLUTANT_ORDER)
    return f"(CASE {arms} END)"


# ------------------------------------------------------------------ Spark Columns (same text)


def sub_index(pollutant: str, conc: str, tolerance: float = 0.0) -> Column:
    return F.expr(sub_index_sql(pollutant, conc, tolerance))


def category(aqi: str) -> Column:
    return F.expr(category_sql(aqi))


def pollutants_reported(si: dict[str, str]) -> Column:
    return F.expr(pollutants_reported_sql(si))


def overall_index(si: dict[str, str]) -> Column:
    return F.expr(overall_index_sql(si))


def main_pollutant(si: dict[str, str], aqi: str) -> Column:
    return F.expr(main_pollutant_sql(si, aqi))
