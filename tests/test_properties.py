"""Property tests: the Spark sub-index equals the independent rule statement on random inputs."""

from __future__ import annotations

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from airshed.functions import aqi
from airshed.functions.breakpoints import BREAKPOINTS, POLLUTANT_ORDER

from . import brute

# values near every band edge (where gaps and rounding bite) plus anything in range
EDGES = sorted({float(x) for bands in BREAKPOINTS.values() for lo, hi in bands for x in (lo, hi or 2 * lo)})
conc = st.one_of(
    st.floats(min_value=0, max_value=5000, allow_nan=False, allow_infinity=False),
    st.sampled_from(EDGES).flatmap(lambda e: st.floats(min_value=max(0.0, e - 1.5), max_value=e + 1.5)),
)


@settings(max_examples=25, deadline=None)
@given(st.lists(st.tuples(st.sampled_from(POLLUTANT_ORDER), conc), min_size=1, max_size=60))
def test_sub_index_matches_rule(spark, rows):
    expr = None
    for p in POLLUTANT_ORDER:
        branch = aqi.sub_index(p, "conc")
        expr = F.when(F.col("p") == p, branch) if expr is None else expr.when(F.col("p") == p, branch)
    got = spark.createDataFrame(rows, "p string, conc double").withColumn("si", expr).collect()
    for r in got:
        assert r.si == brute.sub_index(r.p, r.conc), (r.p, r.conc)
        assert 0 <= r.si <= 500
