"""Plan shape: no Python in the hot path, one exchange per panel recipe."""

import re

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from panelwright.operators import impute, ordered, outlier
from panelwright.operators.groupstats import group_modes
from panelwright.plans.queries import orders_value
from panelwright.sources import derived as dv
from panelwright.spec import PanelSpec

from .conftest import SF_SMALL

PY_NODES = ("BatchEvalPython", "ArrowEvalPython", "FlatMapGroupsIn", "FlatMapCoGroupsIn", "MapInPandas", "MapInArrow", "PythonUDF")
# the mini-batch trainer's products are matrix products over Arrow blocks
SQL_QUERIES = sorted(k for k in entry.oracle_sql() if k.startswith("q_") and k != "q_credit_minibatch")


def plan_text(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", SQL_QUERIES)
def test_no_python_nodes(spark, name):
    text = plan_text(entry.queries()[name](spark, SF_SMALL))
    assert not any(n in text for n in PY_NODES)


def test_group_fill_is_one_exchange(spark):
    out = impute.ffill_bfill(orders_value(spark, SF_SMALL), dv.ORDERS_SPEC, ["value"])
    assert len(re.findall(r"Exchange hashpartitioning", plan_text(out))) == 1


def test_mode_fill_shares_the_exchange(spark):
    v = orders_value(spark, SF_SMALL)
    out = impute.fill_mode_mean(impute.fill_median(v, dv.ORDERS_SPEC, "value"), dv.ORDERS_SPEC, "value")
    assert len(re.findall(r"Exchange hashpartitioning", plan_text(out))) == 1


def test_scan_prunes_columns(spark):
    text = entry.queries()["q_value_counts"](spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
    m = re.search(r"ReadSchema: struct<([^>]*)>", text)
    assert m and m.group(1) == "event_type:string"


def test_recipe_windows_reuse_checkpoint_partitioning(spark):
    from panelwright.plans import credit_panel
    out = credit_panel.clean(dv.credit_panel_raw(spark, SF_SMALL))
    # the checkpoint is hash-partitioned by customer; no window adds a shuffle
    assert "Exchange" not in plan_text(out)


@pytest.mark.parametrize("name", ["q_robust_z", "q_robust_null", "q_robust_extremes", "q_z_distribution", "q_column_summary"])
def test_median_standardisation_scans_and_shuffles_rows_once(spark, monkeypatch, name):
    written, real = [], outlier.bucketed

    def watched(df, *args):
        written.append(plan_text(df))
        return real(df, *args)
    monkeypatch.setattr(outlier, "bucketed", watched)
    text = plan_text(entry.queries()[name](spark, SF_SMALL))
    # the one table: one scan of the source, one exchange by the group
    assert len(written) == 1 and written[0].count("Exchange hashpartitioning") == 1
    assert written[0].count("Scan parquet") == 1
    # all else reads it; no row is dealt by the group again, only small aggregates move
    assert "orders.parquet" not in text and "events.parquet" not in text
    assert not re.search(r"Exchange hashpartitioning\((o_custkey|user_id)", text)


def test_all_modes_take_two_exchanges_and_one_scan(spark):
    text = plan_text(entry.queries()["q_modes"](spark, SF_SMALL))
    # the first copy of an adaptive plan is the initial one
    assert text.count("Exchange hashpartitioning") == 2 and text.count("Scan parquet") == 1 and "Join" not in text
    assert text.count("WindowGroupLimit") == 2      # ahead of the second exchange, and after it


def test_modes_of_a_group_with_many_values(spark):
    rows = spark.range(300_000).selectExpr("1 as g", "if(id >= 299997, 7, id) as v").unionByName(
        spark.range(1000).selectExpr("2 as g", "id % 500 as v")).unionByName(spark.range(3).selectExpr("3 as g", "cast(null as bigint) as v"))
    spec = PanelSpec(("g",))
    for groups in (None, 3):
        got = group_modes(rows, spec, "v", groups).collect()
        assert [(r.v, r["_c"]) for r in got if r.g == 1] == [(7, 4)]
        assert sorted(r.v for r in got if r.g == 2) == list(range(500)) and {r.g for r in got} == {1, 2}


def test_columns_of_the_same_names_survive(spark):
    df = orders_value(spark, SF_SMALL).withColumns({c: F.lit(i) for i, c in enumerate(("_med", "_mad", "_alleq", "_z", "_lag", "_first"))})
    spec = dv.ORDERS_SPEC
    for out in (impute.fill_median(df, spec, "value"), impute.set_median(df, spec, "value"), outlier.robust_z(df, spec, "value", "z"),
                outlier.robust_null(df, spec, "value", 2.0), outlier.rel_dev(df, spec, "value"), outlier.abs_dev(df, spec, "value"),
                ordered.lag_diff(df, spec, "value")):
        assert out.select("_med", "_mad", "_alleq", "_z", "_lag", "_first").distinct().collect() == [(0, 1, 2, 3, 4, 5)]
