"""Rounding that gives the same answer in every engine and for every summation order."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# For comparing engines only: values within this distance below a .5 boundary count as the tie and
# round up. Float sums of the same numbers in a different order (other partitioning, other engine)
# differ only in the last bits. The operators themselves round half up without it.
TIE_TOLERANCE = 1e-7


def round_half_up(c: Column | str, digits: int = 0, tolerance: float = 0.0) -> Column:
    """floor(x * 10^d + 0.5 + tol) / 10^d as DOUBLE; null stays null. A str is a SQL expression."""
    if isinstance(c, str):
        return F.expr(round_half_up_sql(c, digits, tolerance))
    scale = float(10**digits)
    shifted = F.floor(c * F.lit(scale) + F.lit(0.5 + tolerance))
    return shifted.cast("double") / F.lit(scale) if digits else shifted.cast("double")


def round_half_up_sql(expr: str, digits: int = 0, tolerance: float = 0.0) -> str:
    """The same rule as SQL text (DuckDB / Spark SQL)."""
    scale = float(10**digits)
    inner = f"CAST(floor(({expr}) * {scale!r} + {0.5 + tolerance!r}) AS DOUBLE)"
    return f"({inner} / {scale!r})" if digits else f"({inner})"
