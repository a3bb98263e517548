"""Properties of the group transforms on generated panels."""

import math

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from panelwright.operators import impute, outlier
from panelwright.spec import PanelSpec

SPEC = PanelSpec(("g",), ("o",))

values = st.one_of(st.none(), st.integers(min_value=-5, max_value=5).map(float))
panels = st.lists(st.tuples(st.integers(min_value=0, max_value=3), values), min_size=1, max_size=30)
SETTINGS = settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))


def frame(spark, rows, parts=3):
    data = [(g, i, v) for i, (g, v) in enumerate(rows)]
    return spark.createDataFrame(data, "g int, o int, v double").repartition(parts)


def by_order(df, col="v"):
    return [r[col] for r in df.orderBy("o").collect()]


@SETTINGS
@given(panels)
def test_ffill_idempotent_and_keeps_values(spark, rows):
    df = frame(spark, rows)
    once = impute.ffill_bfill(df, SPEC, "v")
    twice = impute.ffill_bfill(once, SPEC, "v")
    a, b = by_order(once), by_order(twice)
    assert a == b
    for (g, v), filled in zip(rows, a):
        if v is not None:
            assert filled == v
        # a NULL stays NULL only when its whole group is NULL
        if filled is None:
            assert all(x is None for gg, x in rows if gg == g)


@SETTINGS
@given(panels)
def test_group_fills_keep_rows_and_observed_values(spark, rows):
    df = frame(spark, rows)
    for f in (impute.fill_median, impute.fill_mode, impute.fill_mode_mean, impute.fill_mode_median_int):
        out = by_order(f(df, SPEC, "v"))
        assert len(out) == len(rows)
        for (g, v), x in zip(rows, out):
            if v is not None:
                assert x == v


@SETTINGS
@given(panels)
def test_rules_only_add_nulls(spark, rows):
    df = frame(spark, rows)
    out = by_order(outlier.robust_null(df, SPEC, "v", 1.0))
    for (g, v), x in zip(rows, out):
        assert x is None or x == v


@SETTINGS
@given(panels, st.integers(min_value=1, max_value=7))
def test_independent_of_partitioning(spark, rows, parts):
    a = by_order(outlier.robust_z(frame(spark, rows, 1), SPEC, "v", "z"), "z")
    b = by_order(outlier.robust_z(frame(spark, list(rows), parts).orderBy(F.rand(7)), SPEC, "v", "z"), "z")
    assert len(a) == len(b)
    for x, y in zip(a, b):
        assert (x is None and y is None) or (x == y) or (math.isinf(x) and x == y)
