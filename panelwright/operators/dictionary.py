"""Categories of any number (L1, L4, L5, F20): a distributed dictionary.

The distinct values of a column are dealt into ranges and sorted; a value's
index is its place in its range plus the sizes of the ranges before it, so
indices follow the order of the values and no list of them reaches the driver.
Rows meet their index by a join (broadcast where the counted dictionary is
within the bound), one-hot vectors are sparse.

Unknown and NULL values have no index and encode as all zeros.
"""

from __future__ import annotations

import re

from pyspark.ml.feature import OneHotEncoder
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import fresh, stored

BROADCAST_VALUES = 200_000
# Most indicator columns that :func:`onehot_columns` makes of one column.
MOST_COLUMNS = 10_000


def dictionary(df: DataFrame, col: str) -> DataFrame:
    """(value, idx): every non-NULL value of ``col`` with its 0-based rank."""
    values = df.select(F.col(col).cast("string").alias("value")).where("value is not null").distinct()
    placed = (values.repartitionByRange("value").sortWithinPartitions("value")
              .select("value", F.spark_partition_id().alias("part"), F.monotonically_increasing_id().alias("at")))
    placed = stored(placed.withColumn("at", F.col("at").bitwiseAND((1 << 33) - 1)), "dictionary")
    # one row per range, in their order
    sizes = placed.groupBy("part").agg(F.count(F.lit(1)).alias("n"))
    before = sizes.select("part", F.coalesce(F.sum("n").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)),
                                             F.lit(0)).alias("base"))
    return placed.join(F.broadcast(before), "part").select("value", (F.col("base") + F.col("at")).alias("idx"))


def label_index(df: DataFrame, col: str, out: str, words: DataFrame | None = None) -> DataFrame:
    """L4: ``out`` is the index of each row's value in ``words`` (by default
    the values of ``df`` itself)."""
    words = stored(words if words is not None else dictionary(df, col), "labels")
    value, idx = fresh(df, "_value", "_idx")
    side = words.select(F.col("value").alias(value), F.col("idx").alias(idx))
    side = F.broadcast(side) if words.count() <= BROADCAST_VALUES else side
    found = df.join(side, F.col(col).cast("string") == F.col(value), "left")
    return found.withColumn(out, F.col(idx)).drop(*[c for c in (value, idx) if c != out])


def onehot_vector(df: DataFrame, col: str, out: str, words: DataFrame | None = None) -> DataFrame:
    """L1: a sparse indicator vector with one slot per value of the dictionary."""
    words = stored(words if words is not None else dictionary(df, col), "onehot")
    n = words.count()
    (at,) = fresh(df, "_slot")
    rows = label_index(df, col, at, words).withColumn(at, F.coalesce(F.col(at), F.lit(n)).cast("double"))
    # the last slot stands for "no index" and is dropped; the fit reads the
    # largest index, so a row with it is always there
    size = df.sparkSession.range(1).select(F.lit(float(n)).alias(at))
    return OneHotEncoder(inputCols=[at], outputCols=[out], dropLast=True).fit(size).transform(rows).drop(at)


def onehot_columns(df: DataFrame, col: str, prefix: str | None = None) -> DataFrame:
    """L1 as indicator columns ``<prefix>_<label>``, in the order of the labels."""
    prefix = prefix or col
    words = stored(dictionary(df, col), "onehot")
    if words.count() > MOST_COLUMNS:
        raise ValueError(f"{col} has more than {MOST_COLUMNS} values; use onehot_vector")
    labels = [r["value"] for r in words.orderBy("idx").collect()]      # at most MOST_COLUMNS
    text = F.col(col).cast("string")
    return df.withColumns({f"{prefix}_{re.sub(r'\W', '_', x)}": F.coalesce((text == x).cast("double"), F.lit(0.0)) for x in labels})


def feature_names(df: DataFrame, numeric: list[str], categorical: list[str]) -> DataFrame:
    """``(position, name)`` of an assembled vector: the numeric columns,
    then a slot for each value of each categorical column."""
    spark = df.sparkSession
    out = spark.createDataFrame(list(enumerate(numeric)), "position long, name string")
    at = len(numeric)
    for c in categorical:
        words = stored(dictionary(df, c), "names")
        out = out.unionByName(words.select((F.col("idx") + at).alias("position"), F.concat(F.lit(f"{c}_oh_"), "value").alias("name")))
        at += words.count()
    return out.select(F.col("position").cast("int").alias("position"), "name")
