"""Classification metrics from a (label, prediction) frame.

Everything is one small aggregate over ``(y, yhat)`` counts; the confusion
counts are at most classes^2 rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def confusion_counts(df: DataFrame, y: str, p: str) -> DataFrame:
    return df.groupBy(F.col(y).alias("y"), F.col(p).alias("p")).agg(F.count(F.lit(1)).alias("n"))


def confusion_matrix(df: DataFrame, y: str, p: str, labels: list) -> DataFrame:
    """rows = true class, one column per predicted class, zeros filled."""
    cc = confusion_counts(df, y, p)
    allc = df.sparkSession.createDataFrame([(lbl,) for lbl in labels], "y " + _ddl(labels))
    wide = cc.groupBy("y").pivot("p", labels).agg(F.sum("n"))
    out = allc.join(wide, "y", "left")
    return out.select(F.col("y").alias("true_class"),
                      *[F.coalesce(F.col(f"`{lbl}`"), F.lit(0)).cast("long").alias(f"pred_{lbl}")
                        for lbl in labels])


def _ddl(labels):
    return "string" if labels and isinstance(labels[0], str) else "int"


def class_metrics(df: DataFrame, y: str, p: str) -> DataFrame:
    """Accuracy and support-weighted precision, recall, F1 (a class
    never predicted has precision 0, as sklearn's zero_division default)."""
    cc = confusion_counts(df, y, p)
    tp = cc.where(F.col("y") == F.col("p")).select(F.col("y").alias("c"), F.col("n").alias("tp"))
    sup = cc.groupBy(F.col("y").alias("c")).agg(F.sum("n").alias("support"))
    pred = cc.groupBy(F.col("p").alias("c")).agg(F.sum("n").alias("predicted"))
    per = (sup.join(pred, "c", "full").join(tp, "c", "left")
           .select("c", *[F.coalesce(F.col(x), F.lit(0)).alias(x) for x in ("support", "predicted", "tp")]))
    prec = F.when(F.col("predicted") > 0, F.col("tp") / F.col("predicted")).otherwise(0.0)
    rec = F.when(F.col("support") > 0, F.col("tp") / F.col("support")).otherwise(0.0)
    per = per.withColumns({"precision": prec, "recall": rec})
    f1 = F.when(F.col("precision") + F.col("recall") > 0,
                2 * F.col("precision") * F.col("recall") / (F.col("precision") + F.col("recall"))).otherwise(0.0)
    per = per.withColumn("f1", f1)
    n = F.sum("support")
    return per.agg(
        (F.sum("tp") / n).alias("accuracy"),
        (F.sum(F.col("precision") * F.col("support")) / n).alias("precision"),
        (F.sum(F.col("recall") * F.col("support")) / n).alias("recall"),
        (F.sum(F.col("f1") * F.col("support")) / n).alias("f1"))


def rmse(df: DataFrame, y: str, p: str) -> DataFrame:
    """sqrt(mean((y - p)^2)) over class indices."""
    return df.agg(F.sqrt(F.avg(F.pow(F.col(y).cast("double") - F.col(p).cast("double"), 2))).alias("rmse"))
