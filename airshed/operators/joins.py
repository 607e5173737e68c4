"""Dimension joins."""

from __future__ import annotations

from pyspark.sql import DataFrame


def join_dimension(fact: DataFrame, dim: DataFrame, on: str | list[str], how: str = "inner") -> DataFrame:
    """Fact-dimension equi join without a hint: AQE broadcasts a side whose measured bytes are below the
    session's threshold, and otherwise shuffles both and splits skewed keys."""
    return fact.join(dim, on, how)
