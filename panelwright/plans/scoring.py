"""Train and score the classifier on a cleaned credit panel (E1 stages 3-5).

The split is by customer (a customer's months never straddle train and
test); encoders and scaler are fitted on train only; predictions keep the
row id, so a prediction file pairs every id with its own score.
"""

from __future__ import annotations

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import minibatch, ml, perceptron, sampling
from ..operators.quality import completeness, require_columns
from ..session import stored

# Model inputs of the credit panel.
NUMERIC_FEATURES = ["Age", "Annual_Income", "Monthly_Inhand_Salary", "Num_Credit_Card", "Interest_Rate",
                    "Num_of_Loan", "Delay_from_due_date", "Num_of_Delayed_Payment", "Changed_Credit_Limit",
                    "Outstanding_Debt", "Credit_Utilization_Ratio", "Credit_History_Age", "Total_EMI_per_month",
                    "Amount_invested_monthly", "Monthly_Balance", "Num_Bank_Accounts", "Num_Credit_Inquiries"]
CATEGORICAL_FEATURES = ["Occupation", "Credit_Mix", "Payment_Behaviour", "Payment_of_Min_Amount", "Last_Loan_1",
                        "Last_Loan_2", "Last_Loan_3", "Last_Loan_4", "Last_Loan_5"]
TARGET = "Credit_Score"


class IncompleteInputError(ValueError):
    pass


def fit(train: DataFrame, max_iter: int = 50, seed: int = 42, on_incomplete: str = "raise") -> PipelineModel:
    """B7 + B8 checks, then fit encoders, scaler and perceptron on ``train``.

    Unequal non-NULL counts raise unless
    ``on_incomplete='impute'``, which adds a mean imputer fitted on train."""
    require_columns(train, NUMERIC_FEATURES + CATEGORICAL_FEATURES + [TARGET])
    train = train.na.drop(subset=[TARGET])  # P1
    comp = completeness(train, NUMERIC_FEATURES + CATEGORICAL_FEATURES + [TARGET]).first()
    if not comp["complete"] and on_incomplete == "raise":
        raise IncompleteInputError(f"unequal non-NULL counts: {comp['min_non_null']} .. {comp['max_non_null']}")
    # fit the feature stages, read the assembled width from the vector's
    # ML metadata, then fit the perceptron on that width
    n_classes = int(train.agg(F.count_distinct(TARGET)).first()[0])
    pipe = ml.classifier_pipeline(NUMERIC_FEATURES, CATEGORICAL_FEATURES, TARGET, 1, n_classes,
                                  max_iter=max_iter, seed=seed, impute=not comp["complete"])
    stages = pipe.getStages()
    feat_model = Pipeline(stages=stages[:-1]).fit(train)
    width = feat_model.transform(train).schema["features"].metadata["ml_attr"]["num_attrs"]
    feats = ml.dense_features(feat_model, train).select(array_to_vector("features").alias("features"), "label",
                                                              *[c for c in train.columns if c == perceptron.PART])
    mlp = stages[-1].copy().setLayers(ml.layers_for(int(width), n_classes))
    # L-BFGS passes over the features many times: they are written once, as matrices
    fitted = perceptron.fit(mlp, feats)
    return PipelineModel(stages=[*feat_model.stages, fitted])


def fit_features(train: DataFrame, seed: int = 42) -> tuple[PipelineModel, int, int]:
    """The fitted feature stages (mean imputer included), the width of their
    vector and the number of classes."""
    n_classes = int(train.agg(F.count_distinct(TARGET)).first()[0])
    stages = ml.classifier_pipeline(NUMERIC_FEATURES, CATEGORICAL_FEATURES, TARGET, 1, n_classes, seed=seed, impute=True).getStages()
    model = Pipeline(stages=stages[:-1]).fit(train)
    width = int(model.transform(train).schema["features"].metadata["ml_attr"]["num_attrs"])
    return model, width, n_classes


def minibatch_score(cleaned: DataFrame, epochs: int = 80, seed: int = 42, by: str = "Customer_ID", id_col: str = "ID",
                    rate: float = 1e-3) -> DataFrame:
    """As :func:`split_and_score`, by the mini-batch trainer: (id, actual,
    label, prediction, probability, predicted) of the test side. The validation
    share is drawn by ``by`` too, so no customer is on both sides."""
    need = list(dict.fromkeys([id_col, by, *NUMERIC_FEATURES, *CATEGORICAL_FEATURES, TARGET]))
    s = sampling.split(stored(cleaned.select(*need).na.drop(subset=[TARGET]), "cleaned"), [by], 80, seed)
    train = s.where(F.col("split") == "train")
    feats, width, n_classes = fit_features(train, seed)

    def arrays(d: DataFrame) -> DataFrame:
        return ml.dense_features(feats, d).select(id_col, by, F.col(TARGET).alias("actual"), F.col("label").cast("int").alias("label"), "features")
    made = minibatch.fit(arrays(train), [by], ml.layers_for(width, n_classes), epochs=epochs, rate=rate, seed=seed)
    scored = made.score(arrays(s.where(F.col("split") == "test"))).drop("features", by)
    return scored.withColumn("predicted", ml.index_to_name(feats.stages[0].labels)(F.col("prediction")))


def score(model: PipelineModel, df: DataFrame, id_col: str = "ID") -> DataFrame:
    """Scored rows with ``predicted_label``; the id travels along."""
    feats, fitted = PipelineModel(stages=model.stages[:-1]), model.stages[-1]
    return ml.decode(model, perceptron.predict(fitted, ml.dense_features(feats, df)).drop("features"))


def split_and_score(cleaned: DataFrame, max_iter: int = 50, seed: int = 42, by: str = "Customer_ID",
                    on_incomplete: str = "raise", id_col: str = "ID") -> DataFrame:
    """Split by ``by`` (80/20, seeded hash), fit on one side and return the
    scored rows of the other, the row id among them."""
    # the cleaning plan runs once, and only the model's columns are kept
    need = list(dict.fromkeys([id_col, by, *NUMERIC_FEATURES, *CATEGORICAL_FEATURES, TARGET]))
    # the fit's blocks are those of the plan's partitions, not of the files
    kept = stored(cleaned.select(*need, F.spark_partition_id().alias(perceptron.PART)), "cleaned")
    s = sampling.split(kept, [by], 80, seed)
    model = fit(s.where(F.col("split") == "train"), max_iter, seed, on_incomplete)
    return score(model, s.where(F.col("split") == "test").drop(perceptron.PART), id_col)


METRICS = ("accuracy", "weightedPrecision", "weightedRecall", "f1", "logLoss", "rmse", "majority")


def train_and_score(cleaned: DataFrame, max_iter: int = 50, seed: int = 42, by: str = "Customer_ID",
                    on_incomplete: str = "raise") -> DataFrame:
    """The test metrics of :func:`split_and_score` as one row, with the share
    of the largest class."""
    scored = split_and_score(cleaned, max_iter, seed, by, on_incomplete).select("label", "prediction", "probability")
    m = ml.evaluate(scored)
    return cleaned.sparkSession.createDataFrame(
        [(m["n"], *[float(m[k]) for k in METRICS])],
        "n_test long, accuracy double, precision double, recall double, f1 double, log_loss double, rmse double, majority double")


def score_file(model: PipelineModel, raw: DataFrame, scalars: dict, path: str, opts=None) -> DataFrame:
    """Clean a reserved panel with the training panel's
    scalars, score it and write ``(ID, Credit_Score)`` as CSV to ``path``.
    Returns the written rows."""
    from ..sources.csv import write_predictions
    from . import credit_panel
    opts = opts or credit_panel.CreditOptions()
    opts.scalars = scalars
    scored = score(model, credit_panel.clean(raw, opts))
    write_predictions(scored, path)
    return (raw.sparkSession.read.schema("ID string, Credit_Score string").option("header", True).csv(path))
