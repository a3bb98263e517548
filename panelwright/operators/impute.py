"""Group-aware imputation.

Every function is ``DataFrame -> DataFrame``, keeps the row count and
replaces the named column in place. An all-NULL group yields NULL, never an
error (pandas raises on ``mode()[0]`` / ``int(NaN)`` there).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import fresh
from ..spec import PanelSpec
from .groupstats import group_window, with_group_stats, with_mode_columns, with_percentile_column
from .ordered import fill_ordered, row_index


def ffill_bfill(df: DataFrame, spec: PanelSpec, cols, hot=None) -> DataFrame:
    """G1: forward then backward fill inside each group, in group order."""
    cols = [cols] if isinstance(cols, str) else list(cols)
    return fill_ordered(df, spec, cols, "ffill_bfill", hot=hot)


def fill_two_keys(df: DataFrame, spec: PanelSpec, col: str, key2: str, hot=None) -> DataFrame:
    """G1 within (group, key2). A row whose key2 is NULL belongs to no
    group and keeps its value."""
    spec2 = spec.with_group(*spec.group, key2)
    hot2 = hot.refine(spec2) if hot is not None else None
    filled = fill_ordered(df, spec2, [col], "ffill_bfill", hot=hot2)
    return filled


def fill_median(df: DataFrame, spec: PanelSpec, col: str, hot=None) -> DataFrame:
    """NULL <- group median."""
    (med,) = fresh(df, "_med")
    out = with_percentile_column(df, spec, col, 0.5, med, hot)
    return out.withColumn(col, F.coalesce(F.col(col).cast("double"), F.col(med))).drop(med)


def set_median(df: DataFrame, spec: PanelSpec, col: str, hot=None) -> DataFrame:
    """Every row <- its group median."""
    (med,) = fresh(df, "_med")
    out = with_percentile_column(df, spec, col, 0.5, med, hot)
    return out.withColumn(col, F.when(spec.null_key(), F.col(col)).otherwise(F.col(med))).drop(med)


def fill_mode_median_int(df: DataFrame, spec: PanelSpec, col: str, hot=None) -> DataFrame:
    """NULL <- the mode if single, else int(median of the modes)."""
    out = with_mode_columns(df, spec, col, "_m", median=True, hot=hot)
    fill = F.when(F.col("_m_n") == 1, F.col("_m_min").cast("double")).otherwise(
        F.col("_m_median").cast("long").cast("double"))
    return (out.withColumn(col, F.coalesce(F.col(col).cast("double"), fill))
            .drop("_m_n", "_m_min", "_m_mean", "_m_freq", "_m_median"))


def fill_mode_mean(df: DataFrame, spec: PanelSpec, col: str, hot=None) -> DataFrame:
    """NULL <- the mode if single, else the mean of the modes."""
    out = with_mode_columns(df, spec, col, "_m", hot=hot)
    fill = F.when(F.col("_m_n") == 1, F.col("_m_min").cast("double")).otherwise(F.col("_m_mean"))
    return (out.withColumn(col, F.coalesce(F.col(col).cast("double"), fill))
            .drop("_m_n", "_m_min", "_m_mean", "_m_freq"))


def fill_mode(df: DataFrame, spec: PanelSpec, col: str, hot=None) -> DataFrame:
    """NULL <- the smallest mode."""
    out = with_mode_columns(df, spec, col, "_m", hot=hot)
    return (out.withColumn(col, F.coalesce(F.col(col), F.col("_m_min")))
            .drop("_m_n", "_m_min", "_m_mean", "_m_freq"))


def mode_or_fill(df: DataFrame, spec: PanelSpec, col: str, hot=None) -> DataFrame:
    """A group with exactly one mode is overwritten with it (observed
    values too); any other group gets G1."""
    hot = hot if hot is not None else spec.hot_keys(df)
    out = with_mode_columns(df, spec, col, "_m", hot=hot)
    out = fill_ordered(out, spec, [col], "ffill_bfill", hot=hot)
    return (out.withColumn(col, F.when(F.col("_m_n") == 1, F.col("_m_min")).otherwise(F.col(col)))
            .drop("_m_n", "_m_min", "_m_mean", "_m_freq"))


def cond_mode(df: DataFrame, spec: PanelSpec, col: str, key2: str, hot=None) -> DataFrame:
    """Where ``key2`` is present, the value becomes the smallest mode of
    ``col`` within (group, key2) (NULL if that sub-group has no value);
    rows without ``key2`` keep their value."""
    spec2 = spec.with_group(*spec.group, key2)
    hot2 = hot.refine(spec2) if hot is not None else None
    out = with_mode_columns(df, spec2, col, "_m", hot=hot2)
    present = ~spec2.null_key()
    return (out.withColumn(col, F.when(present, F.col("_m_min")).otherwise(F.col(col)))
            .drop("_m_n", "_m_min", "_m_mean", "_m_freq"))


def counter_rebuild(df: DataFrame, spec: PanelSpec, col: str, hot=None) -> DataFrame:
    """Rebuild a +1-per-row counter. The anchor is the row holding the
    group's smallest value (first such row on ties); every row, observed
    or not, becomes ``anchor + (position - anchor position)``."""
    hot = hot if hot is not None else spec.hot_keys(df)
    out = row_index(df, spec, "_pos", hot=hot)
    anchor = F.when(F.col(col).isNotNull(), F.struct(F.col(col).alias("v"), F.col("_pos").alias("p")))
    out = with_group_stats(
        out, spec,
        lambda r: r.withColumn("_anc", F.min(anchor).over(group_window(spec))),
        lambda r: r.groupBy(*spec.group).agg(F.min(anchor).alias("_anc")), hot)
    rebuilt = F.col("_anc.v") + (F.col("_pos") - F.col("_anc.p"))
    return (out.withColumn(col, F.when(spec.null_key(), F.col(col)).otherwise(rebuilt))
            .drop("_anc", "_pos"))


def global_mean(df: DataFrame, col: str) -> DataFrame:
    """One-row frame with the column mean (a bounded broadcast side)."""
    return df.agg(F.avg(F.col(col).cast("double")).alias("_gmean"))


def fill_global_mean(df: DataFrame, col: str) -> DataFrame:
    """NULL <- mean of the whole column."""
    return (df.crossJoin(F.broadcast(global_mean(df, col)))
            .withColumn(col, F.coalesce(F.col(col).cast("double"), F.col("_gmean"))).drop("_gmean"))
