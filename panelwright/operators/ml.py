"""Feature preparation and the classifier (L1-L10, L15, P4, P6) on Spark ML.

Fitting is distributed: indexers are distinct-value aggregates, the scaler a
one-row moment aggregate, and the perceptron's L-BFGS gradients are summed
over partitions. Encoders and the scaler are fitted on the training split
only (no leakage), and feature/target encoders are separate stages.
"""

from __future__ import annotations

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import MultilayerPerceptronClassifier
from pyspark.ml.feature import (Imputer, ImputerModel, IndexToString, OneHotEncoder, OneHotEncoderModel, StandardScaler,
                                StandardScalerModel, StringIndexer, StringIndexerModel, VectorAssembler, VectorSizeHint)
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import materialize
from .sampling import seeded_hash

# Target classes in alphabetical order (index 0, 1, 2).
CLASSES = ["Good", "Poor", "Standard"]


def index_to_name(labels: list[str]):
    """Class index -> name as an expression (NULL outside the range)."""
    arr = F.array(*[F.lit(x) for x in labels])

    def f(idx: Column) -> Column:
        return F.try_element_at(arr, idx.cast("int") + 1)
    return f


def indexer(col: str, out: str | None = None) -> StringIndexer:
    """L1/L4: alphabetical indices; unseen and NULL values map to an extra
    index (dropped by the one-hot encoder, so they encode as all zeros)."""
    return StringIndexer(inputCol=col, outputCol=out or f"{col}_idx", stringOrderType="alphabetAsc",
                         handleInvalid="keep")


def onehot_stages(cols: list[str]) -> list:
    """L1: one-hot of categorical columns, unknown -> all zeros."""
    stages = [indexer(c) for c in cols]
    # the indexer's extra "unknown" index is the encoder's last category, which
    # dropLast removes: unseen and NULL values encode as all zeros
    stages.append(OneHotEncoder(inputCols=[f"{c}_idx" for c in cols], outputCols=[f"{c}_oh" for c in cols],
                                dropLast=True))
    return stages


def standardize(df: DataFrame, cols: list[str], suffix: str = "_std") -> DataFrame:
    """L2 with sklearn's population standard deviation (ddof=0); the moments
    are one row joined as a broadcast side."""
    mom = df.agg(*[F.avg(c).alias(f"_m_{c}") for c in cols], *[F.stddev_pop(c).alias(f"_s_{c}") for c in cols])
    out = df.crossJoin(F.broadcast(mom))
    exprs = {f"{c}{suffix}": F.when(F.col(f"_s_{c}") == 0, F.lit(0.0))
             .otherwise((F.col(c) - F.col(f"_m_{c}")) / F.col(f"_s_{c}")) for c in cols}
    return out.withColumns(exprs).drop(*[f"_m_{c}" for c in cols], *[f"_s_{c}" for c in cols])


def layers_for(n_features: int, n_classes: int) -> list[int]:
    """Hidden widths n, 2n, 4n, 2n."""
    return [n_features, n_features, 2 * n_features, 4 * n_features, 2 * n_features, n_classes]


def classifier_pipeline(numeric: list[str], categorical: list[str], label: str, n_features: int,
                        n_classes: int, max_iter: int = 50, seed: int = 42,
                        vector_col: str | None = None, vector_size: int | None = None,
                        impute: bool = False) -> Pipeline:
    """L1-L4 + L7: encode, scale, assemble, perceptron (sigmoid hidden units,
    softmax output, L-BFGS)."""
    stages = [StringIndexer(inputCol=label, outputCol="label", stringOrderType="alphabetAsc")]
    inputs = []
    if vector_col:
        # an array-derived vector carries no size metadata; declare it
        stages.append(VectorSizeHint(inputCol=vector_col, size=vector_size, handleInvalid="error"))
        inputs.append(vector_col)
    if numeric:
        if impute:
            # fitted on train: the column means fill NULLs in train and test alike
            stages.append(Imputer(inputCols=numeric, outputCols=[f"{c}_imp" for c in numeric], strategy="mean"))
            numeric = [f"{c}_imp" for c in numeric]
        stages.append(VectorAssembler(inputCols=numeric, outputCol="_num", handleInvalid="keep"))
        stages.append(StandardScaler(inputCol="_num", outputCol="_num_std", withMean=True, withStd=True))
        inputs.append("_num_std")
    if categorical:
        stages += onehot_stages(categorical)
        inputs += [f"{c}_oh" for c in categorical]
    stages.append(VectorAssembler(inputCols=inputs, outputCol="features", handleInvalid="keep"))
    # blockSize only stacks rows into matrices for the BLAS calls (speed, not results)
    stages.append(MultilayerPerceptronClassifier(layers=layers_for(n_features, n_classes), maxIter=max_iter,
                                                 seed=seed, solver="l-bfgs", blockSize=1024))
    return Pipeline(stages=stages)


# Fixed value: width up to which features are columns of one expression.
EXPRESSION_WIDTH = 1000


def dense_features(model: PipelineModel, df: DataFrame) -> DataFrame:
    """``df`` with ``label`` and ``features`` (array of doubles) as the fitted
    feature stages of :func:`classifier_pipeline` give them, but as one
    expression of the input columns instead of a function call a row and
    stage. Other stages, and features too wide for one expression, take the
    stages' own transform."""
    label, *rest = model.stages
    imputer = rest.pop(0) if rest and isinstance(rest[0], ImputerModel) else None
    kinds = [VectorAssembler, StandardScalerModel, *[StringIndexerModel] * (len(rest) - 4), OneHotEncoderModel, VectorAssembler]
    known = len(rest) > 4 and all(isinstance(s, k) for s, k in zip(rest, kinds))
    if not known or sum(rest[-2].categorySizes) > EXPRESSION_WIDTH:
        keep = [c for c in df.columns if c not in ("label", "features")]
        return model.transform(df).select(*keep, "label", vector_to_array("features").alias("features"))
    numeric, scaler, *indexers, onehot, _ = rest
    out = label.transform(df)
    names = numeric.getInputCols()
    if imputer is not None:
        out = imputer.transform(out)
    # as the scaler does it: a shift, then a factor, which is 0 for a constant column
    cols = [(F.coalesce(F.col(c).cast("double"), F.lit(float("nan"))) - F.lit(float(m))) * F.lit(1 / float(s) if s else 0.0)
            for c, m, s in zip(names, scaler.mean.toArray(), scaler.std.toArray())]
    for stage, size in zip(indexers, onehot.categorySizes):
        text = F.col(stage.getInputCol()).cast("string")
        # the last category stands for unknown values and is dropped
        cols += [F.when(text == F.lit(v), 1.0).otherwise(0.0) for v in stage.labels[:size - 1]]
    return out.select(*[c for c in df.columns if c not in ("label", "features")], "label", F.array(*cols).alias("features"))


def decode(model: PipelineModel, df: DataFrame, out: str = "predicted_label") -> DataFrame:
    """Prediction index -> original class name."""
    labels = model.stages[0].labels
    return IndexToString(inputCol="prediction", outputCol=out, labels=labels).transform(df)


def evaluate(scored: DataFrame) -> dict:
    """L11/L12/L14/L15 from one aggregate of (label, prediction) counts, with
    the log loss summed beside them."""
    p = vector_to_array(F.col("probability"))[F.col("label").cast("int")]
    rows = (scored.groupBy(F.col("label").cast("int").alias("y"), F.col("prediction").cast("int").alias("h"))
            .agg(F.count(F.lit(1)).alias("n"), F.sum(-F.log(F.greatest(p, F.lit(1e-15)))).alias("loss"))
            .collect())  # at most classes x classes rows
    n = sum(r["n"] for r in rows)
    out = {"accuracy": 0.0, "weightedPrecision": 0.0, "weightedRecall": 0.0, "f1": 0.0}
    for c in {r["y"] for r in rows}:
        hit = sum(r["n"] for r in rows if r["y"] == c == r["h"])
        true, said = sum(r["n"] for r in rows if r["y"] == c), sum(r["n"] for r in rows if r["h"] == c)
        prec, rec = (hit / said if said else 0.0), hit / true
        out["accuracy"] += hit / n
        out["weightedPrecision"] += prec * true / n
        out["weightedRecall"] += rec * true / n
        out["f1"] += (2 * prec * rec / (prec + rec) if prec + rec else 0.0) * true / n
    out["n"] = n
    # what always answering the largest class would reach
    out["majority"] = max((sum(r["n"] for r in rows if r["y"] == c) for c in {r["y"] for r in rows}), default=0) / max(1, n)
    out["logLoss"] = sum(r["loss"] for r in rows) / n if n else float("nan")
    out["rmse"] = (sum(r["n"] * (r["y"] - r["h"]) ** 2 for r in rows) / n) ** 0.5 if n else float("nan")
    return out


def select_model(pipeline: Pipeline, train: DataFrame, grid: list[dict], key: list[str], folds: int | None = None,
                 seed: int = 42):
    """Of the given parameter sets of the classifier the one with the
    smallest RMSE over class indices, by an 80/20 validation split or
    ``folds``-fold cross validation; members are drawn by a hash of ``key``.
    Returns (model refitted on all of ``train``, its parameters, RMSEs)."""
    b = F.pmod(seeded_hash(key, seed), F.lit(folds or 5)).alias("_fold")
    feats = Pipeline(stages=pipeline.getStages()[:-1]).fit(train)
    ready = materialize(feats.transform(train).select("features", "label", b))
    mlp, scores = pipeline.getStages()[-1], []
    width = len(ready.select("features").first()[0]) if mlp.getLayers()[0] <= 1 else None
    for params in grid:
        own = mlp.copy({getattr(mlp, k): v for k, v in params.items()})
        if width:
            own.setLayers(layers_for(width, mlp.getLayers()[-1]))
        errs = [evaluate(own.fit(ready.where(F.col("_fold") != i)).transform(ready.where(F.col("_fold") == i)))["rmse"]
                for i in range(folds or 1)]
        scores.append((sum(errs) / len(errs), own))
    best = min(range(len(grid)), key=lambda i: scores[i][0])
    model = PipelineModel(stages=[*feats.stages, scores[best][1].fit(ready)])
    return model, grid[best], [s for s, _ in scores]


def embedding_vector(col: str = "embedding", out: str = "emb_vec") -> Column:
    return array_to_vector(F.col(col)).alias(out)
