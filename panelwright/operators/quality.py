"""Data-quality audits and schema checks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as tx
from ..spec import PanelSpec
from .groupstats import group_window, with_group_stats


class MissingColumnsError(ValueError):
    pass


def require_columns(df: DataFrame, cols: list[str]) -> DataFrame:
    """Fail at plan time (no job) when columns are missing."""
    missing = [c for c in cols if c not in df.columns]
    if missing:
        raise MissingColumnsError(f"missing columns: {missing}")
    return df


def malformed(df: DataFrame, col: str, pattern: str) -> DataFrame:
    """Distinct non-NULL values that do not fully match ``pattern``,
    with their frequency."""
    bad = df.where(F.col(col).isNotNull() & ~tx.fullmatch(col, pattern))
    return bad.groupBy(col).agg(F.count(F.lit(1)).alias("count"))


def failed_casts(df: DataFrame, pairs: dict[str, Column]) -> DataFrame:
    """``(column, failed)``: how many non-NULL texts of each column its
    repaired and typed expression turns into NULL. One aggregate."""
    agg = df.agg(*[F.count_if(F.col(c).isNotNull() & e.isNull()).alias(c) for c, e in pairs.items()])
    return agg.unpivot([], list(pairs), "column", "failed")


def pattern_counts(df: DataFrame, col: str, needle: str) -> DataFrame:
    """C4: how many values contain ``needle`` (and how many do not)."""
    return df.groupBy(F.col(col).contains(needle).alias("matches")).agg(F.count(F.lit(1)).alias("count"))


def completeness(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """Non-NULL count per column in one aggregate, and whether all are equal."""
    cols = cols or df.columns
    agg = df.agg(*[F.count(c).alias(c) for c in cols], F.count(F.lit(1)).alias("_rows"))
    arr = F.array(*[F.col(c) for c in cols])
    return agg.select("_rows", F.array_min(arr).alias("min_non_null"), F.array_max(arr).alias("max_non_null"),
                      (F.array_min(arr) == F.array_max(arr)).alias("complete"))


def drop_missing_target(df: DataFrame, target: str) -> DataFrame:
    """Drop rows whose target is NULL."""
    return df.na.drop(subset=[target])


def empty_groups(df: DataFrame, spec: PanelSpec, col: str, hot=None) -> DataFrame:
    """C14: rows of groups that have no value at all in ``col``."""
    out = with_group_stats(
        df, spec,
        lambda r: r.withColumn("_cnt", F.count(col).over(group_window(spec))),
        lambda r: r.groupBy(*spec.group).agg(F.count(col).alias("_cnt")), hot)
    return out.where(F.col("_cnt") == 0).drop("_cnt")


def duplicate_columns(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """Pairs of same-typed columns equal on every row (NULL-safe).
    Returns ``(left, right)`` rows.

    One aggregate takes a fingerprint of every column (value and row mixed, so
    equal columns have equal ones); only pairs with equal fingerprints are
    compared value by value, in a second aggregate."""
    cols = cols or df.columns
    types = {f.name: f.dataType for f in df.schema.fields}
    spark = df.sparkSession
    row = df.select(*[F.col(f"`{c}`") for c in cols], F.monotonically_increasing_id().alias("_row"))
    prints = row.agg(*[F.bit_xor(F.xxhash64("_row", F.col(f"`{c}`").isNull(), F.col(f"`{c}`"))).alias(f"_f{i}")
                       for i, c in enumerate(cols)]).first()  # one number per column
    alike: dict = {}
    for i, c in enumerate(cols):
        alike.setdefault((types[c], prints[f"_f{i}"]), []).append(c)
    # equality is transitive: comparing with the first of a class is enough
    tests = [(g[0], b) for g in alike.values() for b in g[1:]]
    if not tests:
        return spark.createDataFrame([], "left string, right string")
    found = df.agg(*[F.count_if(~F.col(f"`{a}`").eqNullSafe(F.col(f"`{b}`"))).alias(f"_p{i}")
                     for i, (a, b) in enumerate(tests)]).first()
    same: dict = {}
    for i, (a, b) in enumerate(tests):
        if found[f"_p{i}"] == 0:
            same.setdefault(a, [a]).append(b)
    pairs = [(a, b) for g in same.values() for i, a in enumerate(g) for b in g[i + 1:]]
    return spark.createDataFrame(pairs, "left string, right string")
