"""The block-wise fit meets Spark ML's own; one job an evaluation."""

import numpy as np
import pytest
from pyspark.ml.classification import MultilayerPerceptronClassifier
from pyspark.ml import PipelineModel
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import functions as F

from panelwright.operators import ml, perceptron
from panelwright.plans import scoring


def rows(spark, n=3000):
    rng = np.random.default_rng(0)
    x = rng.normal(size=(n, 4))
    y = (x[:, 0] * x[:, 1] > 0).astype(int) + (x[:, 2] > 1)
    made = spark.createDataFrame([([float(v) for v in a], float(c)) for a, c in zip(x, y)], "a array<double>, label double")
    return made.repartition(3).select(array_to_vector("a").alias("features"), "label")


@pytest.mark.parametrize("steps", [0, 1, 12])
def test_weights_are_those_of_spark_ml(spark, steps):
    feats = rows(spark)
    mlp = MultilayerPerceptronClassifier(layers=[4, 8, 5, 3], maxIter=steps, seed=3, blockSize=256)
    want, got = mlp.fit(feats), perceptron.fit(mlp, feats)
    assert np.allclose(want.weights.toArray(), got.weights.toArray(), rtol=0, atol=1e-7)
    assert [r.prediction for r in got.transform(feats).collect()] == [r.prediction for r in want.transform(feats).collect()]


def test_gradient_matches_differences():
    rng = np.random.default_rng(1)
    widths, h = [3, 5, 4, 3], 1e-6
    flat = rng.normal(size=sum(a * b + b for a, b in zip(widths, widths[1:])))
    x, y = rng.normal(size=(7, 3)), rng.integers(0, 3, 7)
    got = perceptron.gradient(flat, widths, x, y)[1]
    for i in range(len(flat)):
        e = np.eye(len(flat))[i] * h
        up, down = perceptron.gradient(flat + e, widths, x, y)[0], perceptron.gradient(flat - e, widths, x, y)[0]
        assert abs((up - down) / (2 * h) - got[i]) < 1e-6


def test_blocks_keep_every_row_across_batches(spark):
    feats = rows(spark, 1000).repartition(2)
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "70")
    try:
        made = [(len(r.y) // 8, len(r.x) // 32) for r in perceptron.blocks(feats, 128, "features", "label").collect()]
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)
    assert sum(a for a, _ in made) == 1000 and all(a == b <= 128 for a, b in made)
    assert sum(a < 128 for a, _ in made) <= 2


def test_scoring_fits_over_blocks(spark, monkeypatch):
    seen = []
    monkeypatch.setattr(perceptron, "fit", lambda mlp, feats: seen.append(mlp.getMaxIter()) or mlp.copy().setMaxIter(0).fit(feats))
    n = 60
    made = spark.range(n).selectExpr("id", *[f"double(id * {i + 3} % 17) AS {c}" for i, c in enumerate(scoring.NUMERIC_FEATURES)],
                                     *[f"string(id % 3) AS {c}" for c in scoring.CATEGORICAL_FEATURES],
                                     "array('Good', 'Poor', 'Standard')[int(id % 3)] AS Credit_Score")
    assert scoring.fit(made, 7).transform(made).count() == n and seen == [7]
    assert ml.layers_for(2, 3)[0] == 2


def test_long_tables_are_fitted_in_single_precision(spark, monkeypatch):
    feats = rows(spark)
    mlp = MultilayerPerceptronClassifier(layers=[4, 8, 5, 3], maxIter=12, seed=3, blockSize=256)
    want, kinds, made = perceptron.fit(mlp, feats), [], perceptron.blocks
    monkeypatch.setattr(perceptron, "DOUBLE_ROWS", 2999)
    monkeypatch.setattr(perceptron, "blocks", lambda *a: kinds.append(a[-1]) or made(*a))
    got = perceptron.fit(mlp, feats)
    assert kinds == ["f4"] and perceptron.precision(2999) == "f8"
    assert 0 < np.abs(want.weights.toArray() - got.weights.toArray()).max() < 1e-3
    assert [r.prediction for r in got.transform(feats).collect()] == [r.prediction for r in want.transform(feats).collect()]


def test_a_pass_uses_its_arrays_again_without_mixing_blocks():
    rng, widths = np.random.default_rng(2), [3, 5, 4, 3]
    flat = rng.normal(size=sum(a * b + b for a, b in zip(widths, widths[1:])))
    parts = [(rng.normal(size=(n, 3)), rng.integers(0, 3, n)) for n in (9, 4, 12, 1)]
    over = perceptron.Pass(flat, widths)
    for x, y in parts:
        loss, grad = over.gradient(x, y)
        alone = perceptron.gradient(flat, widths, x, y)
        assert loss == alone[0] and (grad == alone[1]).all()


def test_few_blocks_go_to_a_task_and_to_python_at_once(spark, monkeypatch):
    """Blocks of 1 MB: the file has short row groups, and a batch in Python a few blocks, however many there are."""
    n, seen = 24, []
    feats = spark.range(0, n * 1024, 1, 1).select(
        array_to_vector(F.transform(F.sequence(F.lit(1), F.lit(128)), lambda i: F.rand(3) + i)).alias("features"), (F.col("id") % 3).cast("double").alias("label"))
    table = perceptron.blocks(feats, 1024, "features", "label")
    widths = [128, 2, 3]
    summed = perceptron._summed
    monkeypatch.setattr(perceptron, "_summed", lambda parts, tasks: seen.append((
        tasks, table.mapInArrow(lambda batches: (b.select(["y"]).slice(0, 1) if b.num_rows <= 9 else 1 / 0 for b in batches), "y binary").count())) or summed(parts, tasks))
    perceptron.objective(table, widths)(np.zeros(128 * 2 + 2 + 2 * 3 + 3))
    tasks, batches = seen[0]
    assert tasks > 1 and batches >= 3
    assert spark.conf.get("spark.sql.execution.arrow.maxBytesPerBatch") != "8m"


def customers(spark, n, shift=0):
    return spark.range(shift, shift + n).selectExpr(
        "string(id) AS ID", "string(id % 50) AS Customer_ID", "array('Good', 'Poor', 'Standard')[int(id % 3)] AS Credit_Score",
        *[f"IF(id % {i + 11} = 0, NULL, {'int' if c == 'Age' else 'double'}(id * {i + 3} % 17)) AS {c}" for i, c in enumerate(scoring.NUMERIC_FEATURES)],
        *[f"IF(id % {i + 5} = 1, NULL, string(id * {i + 2} % {7 + i + shift % 3})) AS {c}" for i, c in enumerate(scoring.CATEGORICAL_FEATURES)])


def test_features_and_scores_without_a_call_a_row_are_those_of_the_stages(spark, monkeypatch):
    """NULLs, an integer column, a constant one, and categories that the fit has not seen."""
    train, test = (d.withColumn("Interest_Rate", F.lit(4.0)) for d in (customers(spark, 600), customers(spark, 200, 1001)))
    model = scoring.fit(train, 3, on_incomplete="impute")
    feats = PipelineModel(stages=model.stages[:-1])
    plain = ml.dense_features(feats, test)
    assert "UDF" not in plain.select("features")._jdf.queryExecution().optimizedPlan().toString()
    as_list = (lambda d, c: [getattr(r, c) for r in d.orderBy("ID").select(c).collect()])
    want = feats.transform(test).withColumn("features", vector_to_array("features"))
    assert as_list(plain, "features") == as_list(want, "features") and as_list(plain, "label") == as_list(want, "label")
    got, want = scoring.score(model, test), model.transform(test).withColumn("probability", vector_to_array("probability"))
    assert as_list(got, "prediction") == as_list(want, "prediction")
    assert np.allclose(as_list(got.withColumn("probability", vector_to_array("probability")), "probability"), as_list(want, "probability"), rtol=0, atol=1e-12)
    assert set(as_list(got, "predicted_label")) <= set(ml.CLASSES)
    monkeypatch.setattr(ml, "EXPRESSION_WIDTH", 0)
    assert as_list(ml.dense_features(feats, test), "features") == as_list(plain, "features")


def test_blocks_hold_rows_of_one_partition_however_files_are_read(spark):
    feats = rows(spark, 1000).repartition(1).withColumn(perceptron.PART, F.floor(F.monotonically_increasing_id() / 230).cast("int"))
    made = [len(r.y) // 8 for r in perceptron.blocks(feats, 128, "features", "label").collect()]
    assert sorted(made) == sorted([128, 102] * 4 + [80])


def test_the_cleaning_plan_runs_once_for_a_fit(spark, monkeypatch):
    runs = spark.sparkContext.accumulator(0)

    def counted(batches):
        for b in batches:
            runs.add(b.num_rows)
            yield b
    made = customers(spark, 300)
    monkeypatch.setattr(perceptron, "fit", lambda mlp, feats: mlp.copy().setMaxIter(0).fit(feats))
    assert scoring.split_and_score(made.mapInArrow(counted, made.schema), 1, on_incomplete="impute").count() > 0
    assert runs.value == 300
