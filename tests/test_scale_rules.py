"""The split plans at sizes where their rounds and chunks really cut, and
rows without a key, values or a numeric order."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from panelwright.operators import groupstats, impute, lists, ordered, outlier, quality, sampling, stats
from panelwright.sources.csv import PanelLoadError, read_panel_csv, write_table
from panelwright.spec import PanelSpec, SkewPolicy

REAL = SkewPolicy(hot_rows=10_000, chunk_rows=5_000)
PROBS = [0.0, 0.25, 0.5, 0.9, 1.0]


def sparse(spark, n=120_000):
    """Groups of ``n`` rows with all, 7 and no values, and a small one."""
    i = F.col("id")
    v = (F.when(i % 4 == 0, F.pmod(F.xxhash64("id"), F.lit(1_000_003)).cast("double"))
         .when((i % 4 == 1) & (i < 28), i.cast("double")).when(i % 4 == 3, F.when(i < 40, F.lit(1.5))))
    g = F.when((i % 4 == 3) & (i >= 40), F.lit(2)).otherwise(i % 4)
    return spark.range(4 * n).select(g.alias("g"), i.alias("o"), v.alias("v"))


@pytest.fixture(scope="module")
def table(spark):
    return sparse(spark).cache()


def test_sparse_and_empty_groups_beside_a_large_one(spark, table):
    spec = PanelSpec(("g",), ("o",), skew=REAL)
    got = {r["g"]: tuple(r)[1:] for r in groupstats.group_percentiles(table, spec, "v", PROBS).collect()}
    assert set(got) == {0, 1, 2, 3}
    for g in got:
        v = np.array([r.v for r in table.where((F.col("g") == g) & F.col("v").isNotNull()).select("v").collect()])
        want = tuple(np.quantile(v, PROBS)) if len(v) else (None,) * len(PROBS)
        assert got[g] == pytest.approx(want) if len(v) else got[g] == want


def test_global_quantiles_follow_the_policy_given(spark, table):
    v = np.array([r.v for r in table.where("v is not null").select("v").collect()])
    got = groupstats.group_percentiles(table, None, "v", PROBS, skew=REAL).first()
    assert tuple(got) == pytest.approx(tuple(np.quantile(v, PROBS)))


def test_bits_order_doubles_as_spark_does(spark):
    rng = np.random.default_rng(3)
    v = np.frombuffer(rng.bytes(8 * 20_000), np.float64)
    edge = [0.0, -0.0, 5e-324, -5e-324, 2.0 ** -1022, 2.0 ** -1023, 1.7976931348623157e308, float("inf"), float("-inf"), float("nan")]
    powers = [s * 2.0 ** e * (1 + d * 2.0 ** -52) for e in range(-1021, 1024, 7) for d in (0, 1) for s in (1, -1)]
    near = [float(np.nextafter(2.0 ** e, 0)) for e in range(-1021, 1024, 5)]
    df = spark.createDataFrame([(float(x),) for x in [*v, *edge, *powers, *near]], "v double")
    got = df.select("v", groupstats.ordered_bits(F.col("v")).alias("k")).collect()
    x, k = np.array([r.v for r in got]), np.array([r.k for r in got], np.int64)
    ok = ~np.isnan(x)
    raw = np.abs(x).view(np.int64)
    assert (k[ok] == np.where(x[ok] < 0, -raw[ok], raw[ok])).all()
    assert (k[~ok] > k[ok].max()).all()


@pytest.mark.parametrize("kind", ["spread", "mostly equal", "tiny steps", "mixed signs"])
def test_radix_selection_is_exact_on_long_columns(spark, kind):
    h = F.pmod(F.xxhash64("id"), F.lit(10_000_019))
    v = {"spread": h.cast("double") / 7, "mostly equal": F.when(F.col("id") % 100 == 0, h / 3.0).otherwise(42.5),
         "tiny steps": 1.0 + h * 2.0 ** -50, "mixed signs": F.pow(F.lit(-1.5), (h % 300).cast("double"))}[kind]
    df = spark.range(1_000_000).select(F.lit(1).alias("g"), v.cast("double").alias("v")).cache()
    want = tuple(np.quantile(np.array(df.select("v").toPandas()["v"]), PROBS))
    got = tuple(groupstats.group_percentiles(df, None, "v", PROBS, skew=REAL).first())
    assert got == pytest.approx(want, rel=1e-14)
    df.unpersist()


def test_radix_rounds_hold_few_bins(spark, monkeypatch):
    """No aggregate of a round has more rows than bins times different prefixes."""
    seen = []
    real = groupstats.stored

    def watched(df, name):
        seen.append((name, df._jdf.queryExecution().optimizedPlan().toString()))
        return real(df, name)
    monkeypatch.setattr(groupstats, "stored", watched)
    df = spark.range(200_000).select(F.xxhash64("id").cast("double").alias("v"))
    groupstats.group_percentiles(df, None, "v", [0.5], skew=REAL).collect()
    rounds = [plan for name, plan in seen if name == "radix-ranks"]
    assert 2 <= len(rounds) <= 6 and [n for n, _ in seen].count("radix-values") == 1
    assert not any("percentile" in plan for _, plan in seen)


def test_box_stats_and_describe_keep_groups_without_values(spark, table):
    spec = PanelSpec(("g",), ("o",), skew=REAL)
    box = {r["g"]: r for r in stats.box_stats(table, spec, "v").collect()}
    assert set(box) == {0, 1, 2, 3} and box[2]["median"] is None and box[2]["outliers"] == 0
    wide = table.select(F.col("v").alias("a"), F.lit(None).cast("double").alias("b"))
    d = {r["column"]: r for r in stats.describe_numeric(wide, ["a", "b"]).collect()}
    assert d["b"]["count"] == 0 and d["b"]["p50"] is None


def test_one_customer_ordered_by_month_text_is_cut_to_the_target_size(spark):
    months = F.element_at(F.array(*[F.lit(m) for m in ("April", "August", "June", "March")]), (F.col("id") % 4 + 1).cast("int"))
    df = spark.range(200_000).select(F.lit(1).alias("c"), months.alias("m"), F.col("id").alias("o"),
                                     F.when(F.col("id") % 9 == 0, F.col("id")).alias("v"))
    spec = PanelSpec(("c",), ("m", "o"), id="o", skew=SkewPolicy(hot_rows=1_000, chunk_rows=2_000))
    hot = spec.hot_keys(df)
    chunks = ordered._with_chunks(df, spec, 200_000, hot.count).groupBy("_chunk").count().collect()
    assert len(chunks) > 60 and max(r["count"] for r in chunks) < 8_000
    fast = PanelSpec(("c",), ("m", "o"), id="o")
    a = impute.ffill_bfill(df, fast, "v").agg(F.sum(F.col("v") * F.col("o"))).first()
    b = impute.ffill_bfill(df, spec, "v").agg(F.sum(F.col("v") * F.col("o"))).first()
    assert a == b


def null_panel(spark):
    return spark.createDataFrame([(None, i, None if i % 3 else float(i)) for i in range(30)]
                                 + [(1, i, None if i % 2 else float(i)) for i in range(6)], "c int, o int, v double")


@pytest.mark.parametrize("hot_rows", [2_000_000, 4])
def test_rows_without_a_key_keep_their_value(spark, hot_rows):
    df = null_panel(spark)
    spec = PanelSpec(("c",), ("o",), skew=SkewPolicy(hot_rows=hot_rows, chunk_rows=3))
    want = {(r.o): r.v for r in df.where("c is null").collect()}
    for op in (impute.ffill_bfill, impute.fill_median, impute.set_median, impute.fill_mode_mean, impute.fill_mode,
               impute.fill_mode_median_int, impute.mode_or_fill, impute.counter_rebuild):
        out = op(df, spec, "v")
        assert out.count() == 36
        assert {r.o: r.v for r in out.where("c is null").collect()} == want, op.__name__
    assert {r.o: r.v for r in outlier.robust_null(df, spec, "v", 0.1).where("c is null").collect()} == want
    assert ordered.lag_diff(df, spec, "v", "d").where("c is null and d is not null").count() == 0
    assert stats.net_change(df, spec, "v").count() == 1 and stats.num_modes(df, spec, "v").count() == 1


def test_a_list_longer_than_the_given_width_is_an_error(spark):
    df = spark.createDataFrame([(1, "w, x, y, and z"), (2, "w")], "i int, t string")
    with pytest.raises(Exception, match="more than 2 items"):
        lists.expand(df, "t", 2).collect()
    assert lists.expand(df, "t", 4).count() == 2
    items = {r.item for r in lists.vocabulary(df, "t").collect()}
    assert items == {"w", "x", "y", "z", lists.FILLER} and len(lists.vocabulary(df.where("i = 2"), "t").collect()) == 1


def test_user_columns_survive(spark):
    df = null_panel(spark).withColumns({"_ff_keep": F.lit(1), "_cin_mine": F.lit(2), "_bf_x": F.lit(3)})
    out = impute.ffill_bfill(df, PanelSpec(("c",), ("o",)), "v")
    assert {"_ff_keep", "_cin_mine", "_bf_x"} <= set(out.columns)
    assert {"_ff_keep", "_cin_mine"} <= set(ordered.lag_diff(df, PanelSpec(("c",), ("o",)), "v", "d").columns)


def test_shuffle_is_a_permutation_in_its_order(spark):
    df = spark.range(5_000).select(F.col("id").alias("k"))
    out = sampling.shuffle(df, ["k"], 7, bucket_rows=500)
    rows = [tuple(r) for r in out.collect()]
    assert [p for _, p in rows] == list(range(5_000)) and sorted(k for k, _ in rows) == list(range(5_000))
    assert [k for k, _ in rows] != list(range(5_000))


def test_duplicate_columns_compare_only_equal_fingerprints(spark):
    df = spark.range(100).select(*[(F.col("id") * (i % 7)).alias(f"c{i}") for i in range(40)])
    pairs = {tuple(r) for r in quality.duplicate_columns(df).collect()}
    assert pairs == {(f"c{i}", f"c{j}") for i in range(40) for j in range(i + 1, 40) if i % 7 == j % 7}


def test_first_file_and_unparsed_cells(spark, tmp_path):
    write_table(spark.createDataFrame([(1, "3_"), (2, "4")], "a int, b string").coalesce(1), str(tmp_path / "x"), "csv")
    write_table(spark.createDataFrame([(9, "9")], "a int, b string").coalesce(1), str(tmp_path / "y"), "csv")
    from pyspark.sql import types as T
    schema = T.StructType.fromDDL("a int, b int")
    first = read_panel_csv(spark, str(tmp_path), schema, glob="*.csv", first_only=True, corrupt="bad")
    rows = sorted((r.a, r.b, r.bad) for r in first.collect())
    assert rows == [(1, None, "1,3_"), (2, 4, None)]
    with pytest.raises(PanelLoadError):
        read_panel_csv(spark, str(tmp_path / "none"), schema)


def test_chunk_of_a_row_by_binary_search(spark):
    rows = [(n, x) for n in (None, 0, 1, 2, 3, 7, 8, 100, 127, 128) for x in (None, -1, 0, 1, 5, 6, 7, 50, 199, 200, 400)]
    df = spark.createDataFrame(rows, "n int, x int").withColumn(
        "b", F.when(F.col("n") == 0, F.array().cast("array<struct<x:int,s:string>>"))
        .when(F.col("n") > 0, F.transform(F.sequence(F.lit(1), "n"), lambda i: F.struct(
            F.when(i > 1, F.floor(i / 2) * 2).cast("int").alias("x"), F.when(i % 3 > 0, "k").alias("s")))))
    df = df.withColumn("b", F.array_sort("b"))
    at = F.struct(F.col("x"), F.lit("k").alias("s"))
    got = df.select(F.coalesce(ordered._below("b", at), F.lit(0)).alias("got"),
                    F.greatest(F.size(F.filter("b", lambda e: e < at)), F.lit(0)).alias("want")).collect()
    assert len(got) == len(rows) and all(r.got == r.want for r in got)
