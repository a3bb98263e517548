"""Outlier rules: fixed ranges, IQR fences, median standardisation.

G10 ``robust_z``: per group, ``med`` = median, ``mad`` = median of
``|x - med|``.
* mad != 0: ``(x - med) / mad``
* mad == 0 and every present value equals med: 0
* otherwise: ``(x - med) / max_mad`` where ``max_mad`` is the largest group
  MAD of the column (F5); with ``max_mad == 0`` the result is +-Infinity
  (zero deviation stays 0).
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.numeric import div_inf
from ..spec import PanelSpec, SkewPolicy
from ..session import bucketed, fresh, materialize, stored
from .groupstats import attach, group_percentiles, group_window, with_group_stats


# ---------------------------------------------------------------------------
# C6 fixed ranges, C7 fences

def null_where(df: DataFrame, col: str, cond: Column) -> DataFrame:
    """NULL the value where ``cond`` holds (rules only ever add NULLs)."""
    return df.withColumn(col, F.when(cond, F.lit(None)).otherwise(F.col(col)))


def drop_where(df: DataFrame, cond: Column) -> DataFrame:
    """The filter variant of a rule (drop the row instead of nulling)."""
    return df.where(~F.coalesce(cond, F.lit(False)))


def iqr_fences(df: DataFrame, col: str | Column, spec: PanelSpec | None = None,
               skew: SkewPolicy | None = None) -> DataFrame:
    """``min_value, q1, q3, lower, upper, max_value`` (lower/upper =
    q1 -/+ 1.5 IQR), one row (or one per group). Exact, skew-safe quantiles."""
    v = F.col(col) if isinstance(col, str) else col
    keys = list(spec.group) if spec is not None else []
    ends = [F.min(v.cast("double")).alias("min_value"), F.max(v.cast("double")).alias("max_value")]
    if keys:
        q = group_percentiles(df, spec, v, [0.25, 0.75], ["q1", "q3"], skew=skew)
        base = q.join(df.groupBy(*keys).agg(*ends), keys)
    else:
        # the size check of the quantiles tells the ends in the same pass
        r = df.agg(*ends, F.count(v).alias("n")).first()
        q = group_percentiles(df, None, v, [0.25, 0.75], ["q1", "q3"], n_rows=r["n"], skew=skew)
        base = q.withColumns({c: F.lit(r[c]).cast("double") for c in ("min_value", "max_value")})
    iqr = F.col("q3") - F.col("q1")
    return base.select(*keys, "min_value", "q1", "q3",
                       (F.col("q1") - 1.5 * iqr).alias("lower"),
                       (F.col("q3") + 1.5 * iqr).alias("upper"), "max_value")


def fence_rule(df: DataFrame, col: str, upper: bool = True, lower_zero: bool = True,
               lower_fence: bool = False) -> DataFrame:
    """NULL values above the upper fence (and below 0 / the lower fence).

    The fences are one row computed from the whole column; it joins as a
    broadcast cross join (a proven one-row side)."""
    f = iqr_fences(df, col).select("lower", "upper")
    out = df.crossJoin(F.broadcast(f))
    cond = F.lit(False)
    if upper:
        cond = cond | (F.col(col) > F.col("upper"))
    if lower_fence:
        cond = cond | (F.col(col) < F.col("lower"))
    if lower_zero:
        cond = cond | (F.col(col) < 0)
    return null_where(out, col, cond).drop("lower", "upper")


# ---------------------------------------------------------------------------
# G10-G12 deviations

DEV = ("_med", "_mad", "_alleq")


def _dev_fast(rows: DataFrame, spec: PanelSpec, col: str, names=DEV) -> DataFrame:
    wg = group_window(spec)
    med, mad, same = names
    x = F.col(col).cast("double")
    rows = rows.withColumn(med, F.percentile(x, 0.5).over(wg))
    absdev = F.abs(x - F.col(med))
    return rows.withColumns({
        mad: F.percentile(absdev, 0.5).over(wg),
        same: F.sum(F.when(absdev == 0, 1).otherwise(0)).over(wg) == F.count(x).over(wg),
    })


def _dev_slow(rows: DataFrame, spec: PanelSpec, col: str, names=DEV) -> DataFrame:
    keys = list(spec.group)
    name, mad_name, same = names
    x = F.col(col).cast("double")
    # hot rows only: one median per hot group
    med = materialize(group_percentiles(rows, spec, x, [0.5], [name]))
    if med.count() <= spec.skew.broadcast_keys:
        med = F.broadcast(med)
    with_med = attach(rows.select(*keys, x.alias("_x")), med, keys)
    absdev = F.abs(F.col("_x") - F.col(name))
    mad = group_percentiles(with_med, spec, absdev, [0.5], [mad_name])
    eq = with_med.groupBy(*keys).agg(
        (F.sum(F.when(absdev == 0, 1).otherwise(0)) == F.count("_x")).alias(same))
    return med.join(mad, keys, "left").join(eq, keys, "left")


def with_deviation_stats(df: DataFrame, spec: PanelSpec, col: str, hot=None) -> DataFrame:
    """Add ``_med``, ``_mad``, ``_alleq`` of ``col`` per group to every row."""
    return with_group_stats(df, spec, lambda r: _dev_fast(r, spec, col),
                            lambda r: _dev_slow(r, spec, col), hot)


def group_mad(df: DataFrame, spec: PanelSpec, col: str, hot=None) -> DataFrame:
    """one row per group with its median and MAD."""
    keys = list(spec.group)
    x = F.col(col).cast("double")
    hot = hot if hot is not None else spec.hot_keys(df.where(~spec.null_key()))
    med = group_percentiles(df, spec, x, [0.5], ["median"], hot=hot)
    if hot.any:
        # rows of a hot group are not dealt out by it to meet one number
        med = materialize(med)
        if med.count() <= spec.skew.broadcast_keys:
            med = F.broadcast(med)
    with_med = attach(df.where(~spec.null_key()).select(*keys, x.alias("_x")), med, keys)
    mad = group_percentiles(with_med, spec, F.abs(F.col("_x") - F.col("median")), [0.5], ["mad"], hot=hot)
    return med.join(mad, keys, "left")


@dataclass
class Deviations:
    """Rows of a panel with their group's median, MAD and whether all present
    values equal the median, written once: G10, F4, F5 and C8 all read it.

    Without hot groups the table is bucketed by the group, so one scan and one
    exchange of rows serve the statistics, the column's largest MAD and every
    later step on the same groups."""
    rows: DataFrame
    spec: PanelSpec
    x: Column
    med: str
    mad: str
    same: str

    @classmethod
    def of(cls, df: DataFrame, spec: PanelSpec, col: str, hot=None) -> "Deviations":
        hot = hot if hot is not None else spec.hot_keys(df)
        names = fresh(df, "_med", "_mad", "_alleq")
        st = with_group_stats(df, spec, lambda r: _dev_fast(r, spec, col, names), lambda r: _dev_slow(r, spec, col, names), hot)
        if hot.any or hot.null_hot:
            st = stored(st, "deviations")
        else:
            st = bucketed(st, "deviations", [*spec.group, *([spec.iso] if spec.iso else [])], list(spec.order))
        return cls(st, spec, F.col(col).cast("double"), *names)

    def max_mad(self, name: str = "max_mad") -> DataFrame:
        """the largest group MAD of the column, one row."""
        return self.rows.where(~self.spec.null_key()).agg(F.max(self.mad).alias(name))

    def groups(self) -> DataFrame:
        """(group, median, mad, n) of every group."""
        return (self.rows.where(~self.spec.null_key()).groupBy(*self.spec.group)
                .agg(F.first(self.med).alias("median"), F.first(self.mad).alias("mad"), F.count(self.x).alias("n")))

    def with_z(self, out: str, keep_max: str | None = None) -> DataFrame:
        """The rows with their robust z, without the statistics."""
        kept = [c for c in self.rows.columns if c not in (self.med, self.mad, self.same, out)]
        # H3: one row, never one value per row
        (most,) = fresh(self.rows, "_maxmad")
        st = self.rows.crossJoin(F.broadcast(self.max_mad(most)))
        dev = self.x - F.col(self.med)
        z = (F.when(self.x.isNull(), F.lit(None).cast("double"))
             .when(F.col(self.mad) != 0, dev / F.col(self.mad))
             .when(F.col(self.same), self.x * 0)
             .otherwise(div_inf(dev, F.col(most))))
        own = [F.col(c) for c in kept] + [z.alias(out)]
        return st.select(*own, *([F.col(most).alias(keep_max)] if keep_max else []))


def robust_z(df: DataFrame, spec: PanelSpec, col: str, out: str | None = None, hot=None) -> DataFrame:
    """G10 (see module doc). Adds ``out`` (default ``<col>_z``) or replaces a
    column of that name."""
    return Deviations.of(df, spec, col, hot).with_z(out or f"{col}_z")


def rel_dev(df: DataFrame, spec: PanelSpec, col: str, out: str | None = None, hot=None) -> DataFrame:
    """(x - med) / med, +-Infinity when med is 0."""
    out = out or f"{col}_reldev"
    from .groupstats import with_percentile_column
    (med,) = fresh(df, "_med")
    st = with_percentile_column(df, spec, col, 0.5, med, hot)
    dev = F.col(col).cast("double") - F.col(med)
    return st.withColumn(out, div_inf(dev, F.col(med))).drop(med)


def abs_dev(df: DataFrame, spec: PanelSpec, col: str, out: str | None = None, hot=None) -> DataFrame:
    """X - med."""
    out = out or f"{col}_absdev"
    from .groupstats import with_percentile_column
    (med,) = fresh(df, "_med")
    st = with_percentile_column(df, spec, col, 0.5, med, hot)
    return st.withColumn(out, F.col(col).cast("double") - F.col(med)).drop(med)


def robust_null(df: DataFrame, spec: PanelSpec, col: str, threshold: float, two_sided: bool = True,
                hot=None) -> DataFrame:
    """NULL values whose robust z exceeds ``threshold`` (``|z|`` when
    two-sided, ``z`` when one-sided, as the age rule)."""
    (name,) = fresh(df, "_z")
    z = robust_z(df, spec, col, name, hot)
    cond = (F.abs(F.col(name)) > threshold) if two_sided else (F.col(name) > threshold)
    return null_where(z, col, cond).drop(name)
