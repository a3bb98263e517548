"""Recipes as data: every rule equals its operator, for bounded and hot groups."""

import pytest
from pyspark.sql import functions as F

from panelwright.operators import impute, outlier
from panelwright.plans import credit_panel, recipe
from panelwright.plans.recipe import Step
from panelwright.sources import derived as dv
from panelwright.spec import PanelSpec, SkewPolicy

from .conftest import SF_SMALL


def bag(df):
    return sorted((tuple(round(v, 9) if isinstance(v, float) else v for v in r) for r in df.collect()), key=repr)


@pytest.fixture(scope="module")
def panel(spark):
    i = F.col("id")
    h = F.pmod(F.xxhash64("id"), F.lit(11))
    g = F.when(i < 90, F.lit(1)).when(i % 17 == 0, F.lit(None).cast("int")).otherwise((i % 9).cast("int") + 2)

    def some(v, k):
        return F.when(i % k == 0, F.lit(None)).otherwise(v)
    return spark.range(300).select(g.alias("g"), (i * 7 % 300).alias("o"), some(h.cast("double"), 3).alias("a"), some(h % 3, 4).alias("b"),
                                   some((h % 4).cast("double"), 5).alias("c"), some(F.concat(F.lit("t"), h % 2), 3).alias("t"),
                                   some(i * 2 + 5, 6).alias("n"), some((h % 3).cast("double"), 4).alias("e"), some(h, 5).alias("f")).cache()


@pytest.mark.parametrize("hot_rows", [2_000_000, 40])
def test_rules_equal_the_operators(spark, panel, hot_rows):
    spec = PanelSpec(("g",), ("o",), skew=SkewPolicy(hot_rows=hot_rows, chunk_rows=7))
    steps = [Step("a", "a > 8", recipe.FILL), Step("b", None, recipe.SMALLEST_MODE), Step("c", None, recipe.MODE_MEAN),
             Step("t", None, recipe.MODE_OR_FILL), Step("n", None, recipe.COUNTER), Step("e", None, recipe.MODE_MEDIAN_INT),
             Step("f", "f = 0", recipe.MEDIAN, "double")]
    got = recipe.run(panel, steps, spec, {"ratio": "a / (c + 1)"})
    plain = PanelSpec(("g",), ("o",))
    want = outlier.null_where(outlier.null_where(panel, "a", F.col("a") > 8), "f", F.col("f") == 0)
    want = impute.ffill_bfill(want, plain, "a")
    want = impute.fill_mode(want, plain, "b")
    want = impute.fill_mode_mean(want, plain, "c")
    want = impute.mode_or_fill(want, plain, "t")
    want = impute.counter_rebuild(want, plain, "n")
    want = impute.fill_mode_median_int(want, plain, "e")
    want = impute.fill_median(want, plain, "f").withColumn("ratio", F.expr("a / (c + 1)"))
    assert got.columns == want.columns and bag(got) == bag(want)


def test_rows_of_the_window_passes_do_not_grow_with_the_columns(spark, panel):
    wide = panel.select("g", "o", *[F.col("a").alias(f"x{i}") for i in range(12)])
    out = recipe.run(wide, [Step(f"x{i}", None, recipe.FILL) for i in range(12)], PanelSpec(("g",), ("o",)))
    text = out._jdf.queryExecution().executedPlan().toString()
    # forward (with the rows' position) and backward: two sort orders
    assert text.count("Window [") == 2 and "Exchange" not in text


def test_wrong_recipes_are_errors(spark, panel):
    spec = PanelSpec(("g",), ("o",))
    for steps in ([Step("a", None, "nearest")], [Step("o", None, recipe.FILL)], [Step("a"), Step("a", None, recipe.FILL)]):
        with pytest.raises(ValueError):
            recipe.run(panel, steps, spec)
    assert recipe.run(panel.limit(0), [Step("a", None, recipe.FILL)], spec).count() == 0
    assert bag(recipe.run(panel, [], spec)) == bag(panel)


def test_modelling_variant_with_hot_customers(spark):
    raw = dv.credit_panel_raw(spark, SF_SMALL)
    hot = PanelSpec(("Customer_ID",), ("Month", "ID"), id="ID", skew=SkewPolicy(hot_rows=12, chunk_rows=5))
    a, b = recipe.modelling_panel(raw, credit_panel.SPEC), recipe.modelling_panel(raw, hot)
    assert a.columns == recipe.MODELLING_COLUMNS and bag(a) == bag(b)
    assert a.where("EMI_Salary_Ratio is null and Monthly_Inhand_Salary is not null").count() == 0
