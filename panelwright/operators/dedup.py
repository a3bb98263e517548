"""Near-duplicate rows.

Rows are near duplicates when they share the group, a tolerance bucket of a
numeric column and some exact columns; the first row in panel order is kept.
Keeping "the first row per key" is an aggregate (``min_by`` over the order),
so a key holding a third of all rows is combined map-side instead of being
sorted in one task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..spec import PanelSpec


def tolerance_bucket(df: DataFrame, col: str, rel_tol: float = 0.05, out: str = "_bucket") -> DataFrame:
    """``floor(x / (mean(x) * rel_tol))``; the mean is a one-row broadcast side."""
    m = df.agg(F.avg(F.col(col).cast("double")).alias("_mean"))
    return (df.crossJoin(F.broadcast(m))
            .withColumn(out, F.floor(F.col(col) / (F.col("_mean") * rel_tol)))
            .drop("_mean"))


def keep_first(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """One row per key: the first in ``order`` (a total order)."""
    rest = [c for c in df.columns]
    packed = F.struct(*[F.col(c) for c in rest])
    ordv = F.struct(*[F.col(c) for c in order])
    return (df.groupBy(*keys).agg(F.min_by(packed, ordv).alias("_row"))
            .select(*[F.col("_row")[c].alias(c) for c in rest]))


def near_duplicates(df: DataFrame, spec: PanelSpec, col: str, exact: list[str],
                    rel_tol: float = 0.05) -> DataFrame:
    """Drop rows that repeat (group, bucket(col), exact...) and keep the
    first in panel order. A row without a value or without a full key is no
    one's duplicate and stays (pandas cannot bucket a missing value)."""
    b = tolerance_bucket(df, col, rel_tol, "_bucket")
    lone = F.col("_bucket").isNull() | spec.null_key()
    kept = keep_first(b.where(~lone), [*spec.group, "_bucket", *exact], list(spec.order))
    return kept.unionByName(b.where(lone)).drop("_bucket")
