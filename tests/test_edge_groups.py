"""Hand-made edge groups (FIXTURES.md section 3) with expected outputs."""

import math

import pytest
from pyspark.sql import functions as F

from panelwright.functions import text as tx
from panelwright.operators import impute, lists, outlier, stats
from panelwright.spec import PanelSpec

SPEC = PanelSpec(("g",), ("o",))


def panel(spark, values, dtype="double", g=1):
    if dtype == "double":
        values = [None if v is None else float(v) for v in values]
    data = [(g, i, v) for i, v in enumerate(values)]
    return spark.createDataFrame(data, f"g int, o int, v {dtype}")


def col_values(df, c="v"):
    return [r[c] for r in df.orderBy("g", "o").collect()]


def test_ffill_bfill_leading_trailing_gap(spark):
    out = impute.ffill_bfill(panel(spark, [None, 17, None, 18, None]), SPEC, "v")
    assert col_values(out) == [17, 17, 17, 18, 18]


@pytest.mark.parametrize("op", ["ffill", "median", "mode_median", "mode_mean", "mode", "mode_or_fill",
                                "counter"])
def test_all_null_group_stays_null(spark, op):
    df = panel(spark, [None, None, None])
    f = {"ffill": lambda d: impute.ffill_bfill(d, SPEC, "v"),
         "median": lambda d: impute.fill_median(d, SPEC, "v"),
         "mode_median": lambda d: impute.fill_mode_median_int(d, SPEC, "v"),
         "mode_mean": lambda d: impute.fill_mode_mean(d, SPEC, "v"),
         "mode": lambda d: impute.fill_mode(d, SPEC, "v"),
         "mode_or_fill": lambda d: impute.mode_or_fill(d, SPEC, "v"),
         "counter": lambda d: impute.counter_rebuild(d, SPEC, "v")}[op]
    assert col_values(f(df)) == [None, None, None]


def test_single_mode_fill(spark):
    assert col_values(impute.fill_mode_median_int(panel(spark, [3, 3, None, 5]), SPEC, "v")) == [3, 3, 3, 5]


def test_two_modes_int_median(spark):
    out = impute.fill_mode_median_int(panel(spark, [2, 2, 5, 5, None]), SPEC, "v")
    assert col_values(out) == [2, 2, 5, 5, 3]


def test_two_modes_mean(spark):
    out = impute.fill_mode_mean(panel(spark, [2.0, 2.0, 5.0, 5.0, None]), SPEC, "v")
    assert col_values(out) == [2, 2, 5, 5, 3.5]


def test_mode_or_fill_overwrites(spark):
    out = impute.mode_or_fill(panel(spark, ["x", "x", "y", None], "string"), SPEC, "v")
    assert col_values(out) == ["x", "x", "x", "x"]


def test_mode_or_fill_no_single_mode(spark):
    out = impute.mode_or_fill(panel(spark, ["x", "y", None], "string"), SPEC, "v")
    assert col_values(out) == ["x", "y", "y"]


def _z(spark, groups):
    data = [(g, i, None if v is None else float(v)) for g, vals in groups.items() for i, v in enumerate(vals)]
    df = spark.createDataFrame(data, "g int, o int, v double")
    out = outlier.robust_z(df, SPEC, "v", "z")
    return {g: [r["z"] for r in out.where(F.col("g") == g).orderBy("o").collect()] for g in groups}


def test_robust_z_constant_group(spark):
    assert _z(spark, {1: [4, 4, None], 2: [1, 2, 4]})[1] == [0, 0, None]


def test_robust_z_mad_zero_uses_max_mad(spark):
    # group 2: med 2, |dev| 1, 0, 2 -> MAD 1
    z = _z(spark, {1: [4, 4, 4, 10], 2: [1, 2, 4], 3: [0, 2, 4]})
    # group 3: med 2, |dev| 2,0,2 -> MAD 2 = max MAD
    assert z[1] == [0, 0, 0, 3]
    assert z[2] == [-1, 0, 2]


def test_robust_z_max_mad_zero_gives_infinity(spark):
    z = _z(spark, {1: [4, 4, 4, 10]})
    assert z[1][:3] == [0, 0, 0] and math.isinf(z[1][3]) and z[1][3] > 0


def test_counter_rebuild(spark):
    assert col_values(impute.counter_rebuild(panel(spark, [None, 100, None, 102]), SPEC, "v")) == [99, 100, 101, 102]


def test_counter_rebuild_anchor_is_minimum(spark):
    assert col_values(impute.counter_rebuild(panel(spark, [100, 7, 102]), SPEC, "v")) == [6, 7, 8]


@pytest.mark.parametrize("vals,ok", [([20] * 4 + [21] * 4, True), ([20] * 4 + [22] * 4, False),
                                     ([30] * 8, True), ([20, 21, 22, 22], False)])
def test_step_rule(spark, vals, ok):
    out = stats.step_rule(panel(spark, vals, "int"), SPEC, "v")
    assert out.first()["valid"] is ok


def test_list_expand_right_aligned(spark):
    df = spark.createDataFrame([(1, "Auto Loan, Home Loan, and Auto Loan"), (2, None)], "id int, t string")
    out = lists.expand(df, "t", 4, prefix="L")
    got = {r["id"]: [r[f"L_{i}"] for i in (4, 3, 2, 1)] for r in out.collect()}
    assert got[1] == ["No Loan", "Auto Loan", "Home Loan", "Auto Loan"]
    assert got[2] == ["No Loan"] * 4
    n = df.select(lists.count_items("t").alias("n")).collect()
    assert [r["n"] for r in n] == [3, 0]


def test_lstrip_is_a_character_set(spark):
    df = spark.createDataFrame([("and dad Loan",)], "s string")
    assert df.select(tx.lstrip_set("s", "and ").alias("x")).first()["x"] == "Loan"


def test_null_key_rows_untouched(spark):
    df = spark.createDataFrame([(1, 0, None, 1.0), (1, 1, None, None), (1, 2, 5.0, None), (1, 3, 5.0, 7.0)],
                               "g int, o int, k double, v double")
    filled = impute.fill_two_keys(df, SPEC, "v", "k")
    assert col_values(filled) == [1.0, None, 7.0, 7.0]
    moded = impute.cond_mode(df, SPEC, "v", "k")
    assert col_values(moded) == [1.0, None, 7.0, 7.0]


def test_iqr_fences(spark):
    df = spark.createDataFrame([(float(x),) for x in [1, 1, 3, 4, 5, 9]], "v double")
    f = outlier.iqr_fences(df, "v").first()
    assert (f["q1"], f["q3"], f["lower"], f["upper"]) == (1.5, 4.75, -3.375, 9.625)


def test_malformed_flags(spark):
    vals = ["12", "12_", "-5", "+.5", "1.", "12\n"]
    df = spark.createDataFrame([(v,) for v in vals], "s string")
    bad = {r["s"] for r in df.where(~tx.fullmatch("s", tx.UNSIGNED_FLOAT)).collect()}
    assert bad == set(vals) - {"12"}


def test_div_inf_policy(spark):
    from panelwright.functions.numeric import div_inf
    df = spark.createDataFrame([(1.0, 0.0), (-1.0, 0.0), (0.0, 0.0), (3.0, 2.0)], "a double, b double")
    got = [r["x"] for r in df.select(div_inf("a", "b").alias("x")).collect()]
    assert got[0] == float("inf") and got[1] == float("-inf") and got[2] == 0.0 and got[3] == 1.5


def test_onehot_unknown_is_all_zeros(spark):
    from pyspark.ml import Pipeline
    from pyspark.ml.functions import vector_to_array

    from panelwright.operators import ml
    train = spark.createDataFrame([("a",), ("b",), ("c",)], "c string")
    test = spark.createDataFrame([("b",), ("z",), (None,)], "c string")
    model = Pipeline(stages=ml.onehot_stages(["c"])).fit(train)
    got = [r["v"] for r in model.transform(test).select(vector_to_array("c_oh").alias("v")).collect()]
    assert got == [[0.0, 1.0, 0.0], [0.0, 0.0, 0.0], [0.0, 0.0, 0.0]]


def test_missing_panel_raises_typed_error(spark):
    from panelwright.plans.credit_panel import CREDIT_SCHEMA
    from panelwright.sources.csv import PanelLoadError, read_panel_csv
    with pytest.raises(PanelLoadError):
        read_panel_csv(spark, "/nonexistent/panel/dir", CREDIT_SCHEMA)


def test_prediction_sink_keeps_ids(spark, tmp_path):
    from panelwright.sources.csv import write_predictions
    scored = spark.createDataFrame([("0x1", "Good"), ("0x2", "Poor")], "ID string, predicted_label string")
    write_predictions(scored, str(tmp_path / "pred"))
    back = spark.read.option("header", True).csv(str(tmp_path / "pred"))
    assert sorted(map(tuple, back.collect())) == [("0x1", "Good"), ("0x2", "Poor")]
    assert back.columns == ["ID", "Credit_Score"]
