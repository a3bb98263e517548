"""Hot-group plans give exactly the fast-path results.

Tiny skew thresholds force every group through the split plans (chunked
ordered scans, radix-selected quantiles, aggregate + join statistics).
"""

import pytest
from pyspark.sql import functions as F

from panelwright.operators import groupstats, impute, ordered, outlier, stats
from panelwright.plans.queries import orders_value
from panelwright.sources import derived as dv
from panelwright.spec import PanelSpec, SkewPolicy

from .conftest import SF_SMALL

TINY = SkewPolicy(hot_rows=4, chunk_rows=3, broadcast_keys=1_000_000)


def spec_pair(base):
    return base, PanelSpec(base.group, base.order, base.id, TINY)


def same(a, b, key, cols, ndigits=9):
    def norm(df):
        out = []
        for r in df.select(*key, *cols).collect():
            out.append(tuple(round(x, ndigits) if isinstance(x, float) else x for x in r))
        return sorted(out, key=lambda t: tuple((x is None, x) for x in t))
    ra, rb = norm(a), norm(b)
    assert len(ra) == len(rb)
    assert ra == rb


@pytest.fixture(scope="module")
def to_value(spark):
    return orders_value(spark, SF_SMALL).cache()


def test_hot_detection(spark, to_value):
    fast, hot = spec_pair(dv.ORDERS_SPEC)
    assert not fast.hot_keys(to_value).any
    assert hot.hot_keys(to_value).any


def test_ffill_bfill_hot(spark, to_value):
    fast, hot = spec_pair(dv.ORDERS_SPEC)
    for how in ("ffill", "bfill", "ffill_bfill"):
        a = ordered.fill_ordered(to_value, fast, ["value"], how)
        b = ordered.fill_ordered(to_value, hot, ["value"], how)
        same(a, b, ["o_orderkey"], ["value"])


def test_lag_and_row_index_hot(spark, to_value):
    fast, hot = spec_pair(dv.ORDERS_SPEC)
    same(ordered.lag_diff(to_value, fast, "value", "d"), ordered.lag_diff(to_value, hot, "value", "d"),
         ["o_orderkey"], ["d"])
    same(ordered.row_index(to_value, fast, "r", with_count="n"), ordered.row_index(to_value, hot, "r", with_count="n"),
         ["o_orderkey"], ["r", "n"])


def test_group_percentiles_hot(spark):
    ev = dv.events(spark, "/root/testdata/sf0.01", ["user_id", "ts", "event_id", "value"])
    fast, hot = spec_pair(dv.EVENTS_SPEC)
    probs = [0.0, 0.1, 0.25, 0.5, 0.75, 0.9, 1.0]
    a = groupstats.group_percentiles(ev, fast, "value", probs)
    b = groupstats.group_percentiles(ev, hot, "value", probs)
    same(a, b, ["user_id"], [c for c in a.columns if c != "user_id"])


def test_global_percentiles_split(spark):
    ev = dv.events(spark, "/root/testdata/sf0.01", ["value"])
    exact = ev.agg(F.percentile("value", [0.25, 0.5, 0.75]).alias("p")).first()["p"]
    spec = PanelSpec(("_",), skew=TINY)
    # the global path reads the policy of the spec passed as None -> use a tiny-policy group of one key
    one = ev.withColumn("_", F.lit(1))
    got = groupstats.group_percentiles(one, spec, "value", [0.25, 0.5, 0.75], ["a", "b", "c"]).first()
    assert [round(got[c], 9) for c in "abc"] == [round(x, 9) for x in exact]


@pytest.mark.parametrize("op", ["median", "set_median", "mode_median", "mode_mean", "mode_or_fill", "counter",
                                "robust_z", "rel_dev"])
def test_group_stat_operators_hot(spark, to_value, op):
    fast, hot = spec_pair(dv.ORDERS_SPEC)
    df = to_value.withColumn("b", (F.col("value") / 100000).cast("int"))
    f = {"median": lambda d, s: impute.fill_median(d, s, "value"),
         "set_median": lambda d, s: impute.set_median(d, s, "value"),
         "mode_median": lambda d, s: impute.fill_mode_median_int(d, s, "b"),
         "mode_mean": lambda d, s: impute.fill_mode_mean(d, s, "b"),
         "mode_or_fill": lambda d, s: impute.mode_or_fill(d, s, "b"),
         "counter": lambda d, s: impute.counter_rebuild(d, s, "b"),
         "robust_z": lambda d, s: outlier.robust_z(d, s, "value", "value"),
         "rel_dev": lambda d, s: outlier.rel_dev(d, s, "value", "value")}[op]
    col = "b" if op in ("mode_median", "mode_mean", "mode_or_fill", "counter") else "value"
    same(f(df, fast), f(df, hot), ["o_orderkey"], [col])


def test_step_rule_hot(spark, to_value):
    fast, hot = spec_pair(dv.ORDERS_SPEC)
    df = to_value.withColumn("b", (F.col("value") / 100000).cast("int"))
    same(stats.step_rule(df, fast, "b"), stats.step_rule(df, hot, "b"), ["o_custkey"], ["valid"])
