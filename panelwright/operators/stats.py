"""Column and group statistics.

Frequencies and distinct counts are aggregates with map-side combine; exact
quantiles go through :func:`group_percentiles` (skew-safe). Per-column
summaries unpivot the columns into ``(column, value)`` rows and treat each
column as a group, so several columns cost one scan.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..spec import PanelSpec
from ..session import materialize
from .groupstats import group_percentiles, group_window, with_group_stats
from .ordered import lag_diff


def unpivot(df: DataFrame, cols: list[str], keys: list[str] | None = None,
            name: str = "column", value: str = "value", dtype: str = "double") -> DataFrame:
    """Tall ``(keys..., column, value)`` form of several columns (one scan)."""
    keys = keys or []
    return df.select(*keys, *[F.col(c).cast(dtype).alias(c) for c in cols]).unpivot(
        keys, cols, name, value)


def describe_numeric(df: DataFrame, cols: list[str]) -> DataFrame:
    """pandas ``describe()`` per numeric column: count, mean, std
    (ddof=1), min, 25/50/75 % (linear), max."""
    tall = unpivot(df, cols)
    spec = PanelSpec(("column",))
    base = tall.groupBy("column").agg(
        F.count("value").alias("count"), F.avg("value").alias("mean"),
        F.stddev_samp("value").alias("std"), F.min("value").alias("min"), F.max("value").alias("max"))
    q = group_percentiles(tall, spec, "value", [0.25, 0.5, 0.75], ["p25", "p50", "p75"])
    return base.join(q, "column", "left").select("column", "count", "mean", "std", "min", "p25", "p50",
                                                 "p75", "max")


def distinct_counts(df: DataFrame, cols: list[str]) -> DataFrame:
    """``(column, n_distinct)``, NULL not counted (pandas ``nunique``);
    Spark plans the distinct aggregates as one expanded, partial aggregation."""
    agg = df.agg(*[F.count_distinct(c).alias(c) for c in cols])
    return agg.unpivot([], cols, "column", "n_distinct")


def describe_categorical(df: DataFrame, cols: list[str]) -> DataFrame:
    """count, unique, top (most frequent; smallest on ties), freq."""
    tall = unpivot(df, cols, dtype="string")
    vc = tall.where(F.col("value").isNotNull()).groupBy("column", "value").agg(F.count(F.lit(1)).alias("_c"))
    return vc.groupBy("column").agg(
        F.sum("_c").alias("count"), F.count(F.lit(1)).alias("unique"),
        F.min_by("value", F.struct((-F.col("_c")).alias("c"), F.col("value").alias("v"))).alias("top"),
        F.max("_c").alias("freq"))


def value_counts(df: DataFrame, col: str, normalize: bool = False, name: str = "count") -> DataFrame:
    """Frequency of each non-NULL value (share when ``normalize``)."""
    vc = df.where(F.col(col).isNotNull()).groupBy(col).agg(F.count(F.lit(1)).alias(name))
    if normalize:
        # the total is one number: a one-row broadcast side
        tot = df.agg(F.count(col).alias("_tot"))
        vc = vc.crossJoin(F.broadcast(tot)).withColumn(name, F.col(name) / F.col("_tot")).drop("_tot")
    return vc


def per_group_hist(df: DataFrame, spec: PanelSpec, col: str, kind: str = "nunique") -> DataFrame:
    """distribution over groups of distinct (``nunique``) or
    non-NULL (``count``) values per group: ``(n, groups)``."""
    keys = list(spec.group)
    rows = df.where(~spec.null_key())
    if kind == "nunique":
        # (group, value) first spreads a hot group over many tasks; a group
        # without values keeps its (group, NULL) row and counts 0
        rows = rows.select(*keys, col).distinct()
    per = rows.groupBy(*keys).agg(F.count(col).alias("n"))
    return per.groupBy("n").agg(F.count(F.lit(1)).alias("groups"))


def _by_count(df: DataFrame, spec: PanelSpec, col: str) -> DataFrame:
    """(group, _c, _vals, _rows, _nulls): how many values of a group occur
    ``_c`` times. One scan; both shuffles are of aggregated rows keyed beyond
    the group, so a hot group spreads."""
    keys = list(spec.group)
    per = df.where(~spec.null_key()).groupBy(*keys, col).agg(F.count(F.lit(1)).alias("_n"))
    c = F.when(F.col(col).isNotNull(), F.col("_n")).otherwise(0)
    return per.groupBy(*keys, c.alias("_c")).agg(F.count(col).alias("_vals"), F.sum("_n").alias("_rows"))


def num_modes(df: DataFrame, spec: PanelSpec, col: str) -> DataFrame:
    """F13 per group: number of modes (0 for an all-NULL group)."""
    keys = list(spec.group)
    return _by_count(df, spec, col).groupBy(*keys).agg(F.max_by("_vals", "_c").alias("n_modes"))


def mode_share(df: DataFrame, spec: PanelSpec, col: str) -> DataFrame:
    """F15 per group: frequency of the (smallest) mode over the non-NULL
    count; NULL for a group without values. Also the group's row count."""
    keys = list(spec.group)
    g = _by_count(df, spec, col).groupBy(*keys).agg(
        F.sum("_rows").alias("n_rows"), F.sum(F.when(F.col("_c") > 0, F.col("_rows")).otherwise(0)).alias("non_null"),
        F.max(F.when(F.col("_c") > 0, F.col("_c"))).alias("mode_freq"))
    return g.select(*keys, "n_rows", "non_null", "mode_freq",
                    F.when(F.col("non_null") > 0, F.col("mode_freq") / F.col("non_null")).alias("mode_share"))


def mode_dominance(df: DataFrame, spec: PanelSpec, col: str, threshold: float = 0.5) -> DataFrame:
    """F15 tally: share of rows (weighted as a per-row transform would be)
    whose group's mode share exceeds ``threshold``; rows of groups without
    values are left out."""
    ms = mode_share(df, spec, col)
    return ms.where(F.col("mode_share").isNotNull()).agg(
        (F.sum(F.when(F.col("mode_share") > threshold, F.col("n_rows")).otherwise(0))
         / F.sum("n_rows")).alias("share_over"))


def step_rule(df: DataFrame, spec: PanelSpec, col: str) -> DataFrame:
    """F16 per group: valid when every step is 0, or all steps are 0/+1
    with exactly one +1 (the eight-month rule, for any length)."""
    keys = list(spec.group)
    d = lag_diff(df.where(~spec.null_key()), spec, col, "_d")
    per = d.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("_n"),
        F.count_if(F.col("_d") == 0).alias("_z"),
        F.count_if(F.col("_d").isin(0, 1)).alias("_zo"),
        F.count_if(F.col("_d") == 1).alias("_o"))
    valid = (F.col("_z") == F.col("_n") - 1) | ((F.col("_zo") == F.col("_n") - 1) & (F.col("_o") == 1))
    return per.select(*keys, valid.alias("valid"))


def net_change(df: DataFrame, spec: PanelSpec, col: str) -> DataFrame:
    """sum of first differences per group (NULL steps skipped; 0 when
    there is none, as pandas' sum)."""
    keys = list(spec.group)
    d = lag_diff(df.where(~spec.null_key()), spec, col, "_d")
    return d.groupBy(*keys).agg(F.coalesce(F.sum("_d"), F.lit(0)).alias("net_change"))


def diff_values(df: DataFrame, spec: PanelSpec, col: str) -> DataFrame:
    """frequency of each first difference (NULL counted apart)."""
    d = lag_diff(df, spec, col, "diff")
    return d.groupBy("diff").agg(F.count(F.lit(1)).alias("count"))


def null_counts(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """``(column, nulls, non_null)`` for every column, one scan."""
    cols = cols or df.columns
    agg = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in cols],
                 F.count(F.lit(1)).alias("_rows"))
    tall = agg.unpivot(["_rows"], cols, "column", "nulls")
    return tall.select("column", "nulls", (F.col("_rows") - F.col("nulls")).alias("non_null"))


def info(df: DataFrame) -> DataFrame:
    """``(position, column, type, non_null)``; types come from the schema.
    One aggregate over the table, spread into rows."""
    fields = df.schema.fields
    agg = df.agg(*[F.count(f"`{f.name}`").alias(f"c{i}") for i, f in enumerate(fields)])
    rows = F.array(*[F.struct(F.lit(i).alias("position"), F.lit(f.name).alias("column"),
                              F.lit(f.dataType.simpleString()).alias("type"), F.col(f"c{i}").alias("non_null"))
                     for i, f in enumerate(fields)])
    return agg.select(F.inline(rows))


def box_stats(df: DataFrame, spec: PanelSpec, col: str) -> DataFrame:
    """M2 per group: q1, median, q3, whiskers (most extreme values inside
    1.5 IQR), number of points outside."""
    keys = list(spec.group)
    q = group_percentiles(df, spec, col, [0.25, 0.5, 0.75], ["q1", "median", "q3"])
    iqr = F.col("q3") - F.col("q1")
    # the fences are one row per group: broadcast within the policy's bound,
    # so the rows of a hot group are not dealt out by it
    q = materialize(q)
    side = q.select(*keys, "q1", "q3")
    j = df.select(*keys, F.col(col).cast("double").alias("_v")).join(
        F.broadcast(side) if q.count() <= spec.skew.broadcast_keys else side, keys)
    lo = F.col("q1") - 1.5 * iqr
    hi = F.col("q3") + 1.5 * iqr
    inside = (F.col("_v") >= lo) & (F.col("_v") <= hi)
    w = j.groupBy(*keys).agg(
        F.min(F.when(inside, F.col("_v"))).alias("whisker_lo"),
        F.max(F.when(inside, F.col("_v"))).alias("whisker_hi"),
        F.count_if(~inside).alias("outliers"))
    return q.join(w, keys, "left").withColumn("outliers", F.coalesce("outliers", F.lit(0)))


def density_by_class(df: DataFrame, cls: str, col: str, bins: int = 20) -> DataFrame:
    """Per class, share of the class's values in each of ``bins``
    equal-width bins over the whole column's range."""
    rng = df.agg(F.min(col).alias("_lo"), F.max(col).alias("_hi"))
    j = df.select(cls, F.col(col).cast("double").alias("_v")).where(F.col("_v").isNotNull()) \
        .crossJoin(F.broadcast(rng))
    width = (F.col("_hi") - F.col("_lo")) / bins
    b = F.when(width == 0, F.lit(0)).otherwise(
        F.least(F.floor((F.col("_v") - F.col("_lo")) / width), F.lit(bins - 1))).cast("int")
    counts = j.groupBy(cls, b.alias("bin")).agg(F.count(F.lit(1)).alias("_c"))
    tot = counts.groupBy(cls).agg(F.sum("_c").alias("_t"))
    return counts.join(tot, cls).select(cls, "bin", (F.col("_c") / F.col("_t")).alias("density"))


def duplicate_rows(df: DataFrame) -> DataFrame:
    """number of rows that repeat an earlier identical row."""
    rows = df.agg(F.count(F.lit(1)).alias("_n"))
    distinct = df.distinct().agg(F.count(F.lit(1)).alias("_d"))
    return rows.crossJoin(distinct).select((F.col("_n") - F.col("_d")).alias("duplicates"))


def with_group_nunique(df: DataFrame, spec: PanelSpec, col: str, out: str, hot=None) -> DataFrame:
    """The number of distinct non-NULL values of its group on every row."""
    keys = list(spec.group)

    def fast(rows):
        w = group_window(spec)
        peers = F.dense_rank().over(w.orderBy(F.col(col).asc_nulls_last()))
        return (rows.withColumn("_dr", F.when(F.col(col).isNotNull(), peers))
                .withColumn(out, F.coalesce(F.max("_dr").over(w), F.lit(0)).cast("long")).drop("_dr"))

    def slow(rows):
        return rows.select(*keys, col).distinct().groupBy(*keys).agg(F.count(col).alias(out))
    return with_group_stats(df, spec, fast, slow, hot)
