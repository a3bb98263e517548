"""Skew-safe per-group statistics: exact quantiles and modes.

Exact quantiles (pandas' linear interpolation, DuckDB ``quantile_cont``,
Spark ``percentile``) need order statistics. Spark's ``percentile`` aggregate
keeps a value->count map per group; that is fine for a bounded group but one
hot group (or a global quantile over a huge column) would merge a map of all
its distinct values in one task. Large groups are therefore read digit by
digit (:func:`ordered_bits`): a round counts the next ``RADIX_BITS`` bits of
the values that share the leading bits found so far, for all wanted ranks of
all groups together, and each rank keeps the one bin it falls into. A round's
aggregate has at most ``2 ** RADIX_BITS`` bins for each distinct prefix, whatever
the number of values, ties or groups; after at most six rounds a bin is one
double, and rounds end as soon as every bin is one value. Large means many
non-NULL values, not many rows.

Modes come from a ``(group, value) -> count`` aggregate, which shuffles on
(group, value) and therefore spreads a hot group over many tasks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import fresh, stored
from ..spec import PanelSpec, SkewPolicy


def _pname(p: float) -> str:
    return "p" + format(p, "g").replace(".", "_").replace("-", "m")


def group_percentiles(df: DataFrame, spec: PanelSpec | None, value: str | Column,
                      probs: list[float], names: list[str] | None = None, hot=None,
                      n_rows: int | None = None, skew: SkewPolicy | None = None) -> DataFrame:
    """Exact linear-interpolated percentiles of ``value`` per group.

    ``spec=None`` (or an empty group) computes global percentiles over the
    whole column under ``skew``. Returns one row per group: the group keys and
    one column per probability (named by ``names`` or ``p0_25`` style). NULLs
    are ignored; a group with no value gives NULL.

    A group counts as large by its non-NULL values: a long but sparse column
    goes through the plain aggregate.
    """
    names = names or [_pname(p) for p in probs]
    keys = list(spec.group) if spec is not None else []
    v = F.col(value) if isinstance(value, str) else value
    base = df.select(*keys, v.cast("double").alias("_v"))
    for k in keys:  # NULL keys are ignored by group statistics (pandas drops them)
        base = base.where(F.col(k).isNotNull())
    policy = skew or (spec.skew if spec is not None else SkewPolicy())
    plain = [F.percentile("_v", p).alias(nm) for p, nm in zip(probs, names)]

    if not keys:
        if n_rows is not None and n_rows <= policy.hot_rows:
            return base.agg(*plain)
        n = base.where(F.col("_v").isNotNull()).count()
        if n <= policy.hot_rows:
            return base.agg(*plain)
        return _radix(base.withColumn("_g", F.lit(0)), ["_g"], probs, names, policy, 1).drop("_g")

    gspec = PanelSpec(tuple(keys), skew=policy)
    hot = hot if hot is not None else gspec.hot_keys(base)
    if not hot.any:
        return base.groupBy(*keys).agg(*plain)
    _, hot_rows = hot.split(base)
    large = hot_rows.groupBy(*keys).agg(F.count("_v").alias("_n")).where(F.col("_n") > policy.hot_rows)
    r = large.agg(F.count(F.lit(1)).alias("k")).first()
    if not r["k"]:
        return base.groupBy(*keys).agg(*plain)
    side = F.broadcast(large.select(*keys)) if r["k"] <= policy.broadcast_keys else large.select(*keys)
    cold = base.join(side, keys, "left_anti").groupBy(*keys).agg(*plain)
    warm = _radix(base.join(side, keys, "left_semi"), keys, probs, names, policy, r["k"])
    return cold.unionByName(warm)


RADIX_BITS = 12
MANTISSA = 52


def ordered_bits(v: Column) -> Column:
    """A long that orders doubles as Spark does (-0.0 equals 0.0, NaN is
    largest): the bits of |v| by arithmetic, negative for negative values."""
    a = F.abs(v)
    least = 2.0 ** -1022
    # a logarithm may miss the exponent by one near a power of two
    e0 = F.floor(F.log2(a))
    m0 = a / F.pow(F.lit(2.0), e0)
    e = e0 + F.when(m0 >= 2, 1).when(m0 < 1, -1).otherwise(0)
    normal = (e.cast("long") + 1023) * (1 << MANTISSA) + ((a / F.pow(F.lit(2.0), e) - 1) * float(1 << MANTISSA)).cast("long")
    small = (a * 2.0 ** 537 * 2.0 ** 537).cast("long")
    top = 2047 << MANTISSA
    bits = (F.when(F.isnan(v), F.lit(top + 1)).when(a == float("inf"), F.lit(top))
            .when(a < least, small).otherwise(normal))
    return F.when(v < 0, -bits).otherwise(bits)


def _radix(rows: DataFrame, keys: list[str], probs: list[float], names: list[str], policy, n_groups: int) -> DataFrame:
    """Exact percentiles of large groups by radix selection (see module doc).

    The values are written once as (keys, bits, value) in the shared folder;
    every round reads that narrow table alone."""
    values = rows.where(F.col("_v").isNotNull()).select(*keys, ordered_bits(F.col("_v")).alias("_k"), F.col("_v"))
    values = stored(values, "radix-values")
    small = n_groups * 2 * len(probs) <= policy.broadcast_keys     # rows of the table of wanted ranks

    def side(d: DataFrame) -> DataFrame:
        return F.broadcast(d) if small else d
    wanted, before = None, 64
    while before > 0:
        shift = max(0, before - RADIX_BITS)
        digit = F.shiftright("_k", shift)
        if wanted is None:
            part = values.withColumn("_p", F.lit(0).cast("long"))
        else:
            part = (values.withColumn("_p", F.shiftright("_k", before))
                    .join(side(wanted.where("_lo < _hi").select(*keys, "_p").distinct()), [*keys, "_p"], "left_semi"))
        bins = part.groupBy(*keys, "_p", digit.alias("_d")).agg(
            F.count(F.lit(1)).alias("_c"), F.min("_v").alias("_min"), F.max("_v").alias("_max"))
        w = Window.partitionBy(*keys, "_p").orderBy("_d")       # at most 2 ** RADIX_BITS rows
        bins = bins.withColumn("_upto", F.sum("_c").over(w))
        if wanted is None:
            total = bins.groupBy(*keys).agg(F.max("_upto").alias("_n"))
            ranks = F.explode(F.array(*[F.struct(F.lit(i).alias("_i"), f(((F.col("_n") - 1) * F.lit(p))).cast("long").alias("_r"),
                                                 F.lit(h).alias("_h")) for i, p in enumerate(probs) for h, f in enumerate((F.floor, F.ceil))]))
            wanted = (total.select(*keys, "_n", ranks.alias("_w")).select(*keys, "_n", "_w.*")
                      .withColumns({"_p": F.lit(0).cast("long"), "_below": F.lit(0).cast("long")}))
            done = None
        else:
            done = wanted.where("_lo = _hi")
            wanted = wanted.where("_lo < _hi").drop("_lo", "_hi")
        found = (wanted.join(bins, [*keys, "_p"])
                 .where((F.col("_r") - F.col("_below") < F.col("_upto")) & (F.col("_r") - F.col("_below") >= F.col("_upto") - F.col("_c")))
                 .select(*keys, "_n", "_i", "_r", "_h", F.col("_d").alias("_p"),
                         (F.col("_below") + F.col("_upto") - F.col("_c")).alias("_below"), F.col("_min").alias("_lo"), F.col("_max").alias("_hi")))
        wanted = stored(found if done is None else found.unionByName(done), "radix-ranks")
        before = shift
        if wanted.where("_lo < _hi").isEmpty():
            break
    out = wanted.groupBy(*keys).agg(*[x for i, p in enumerate(probs) for x in (
        F.max(F.when((F.col("_i") == i) & (F.col("_h") == 0), F.col("_lo"))).alias(f"_lo{i}"),
        F.max(F.when((F.col("_i") == i) & (F.col("_h") == 1), F.col("_lo"))).alias(f"_hi{i}"))], F.first("_n").alias("_n"))
    h = {i: (F.col("_n") - 1) * F.lit(p) for i, p in enumerate(probs)}
    return out.select(*keys, *[F.when(F.col(f"_lo{i}") == F.col(f"_hi{i}"), F.col(f"_lo{i}"))
                               .otherwise(F.col(f"_lo{i}") + (h[i] - F.floor(h[i])) * (F.col(f"_hi{i}") - F.col(f"_lo{i}"))).alias(nm)
                               for i, nm in enumerate(names)])


# ---------------------------------------------------------------------------
# modes

def value_counts(df: DataFrame, keys: list[str], value: str) -> DataFrame:
    """(keys, value, _c): non-NULL value frequencies per group (partial agg)."""
    rows = df.where(F.col(value).isNotNull())
    for k in keys:
        rows = rows.where(F.col(k).isNotNull())
    return rows.groupBy(*keys, value).agg(F.count(F.lit(1)).alias("_c"))


def group_modes(df: DataFrame, spec: PanelSpec, value: str, groups: int | None = None) -> DataFrame:
    """All modes of every group as rows ``(keys, value, _c)``.

    Equivalent to pandas ``Series.mode()`` (NULLs excluded); a group whose
    values are all NULL has no rows. Counts are dealt by (group, value), and
    every task passes on only the values that lead (with all ties) among its
    own of a group: a rank limit ahead of the second exchange. A group of many
    values meets in one task only as far as they tie there.

    Where a known number of ``groups`` within the policy's broadcast bound is
    asked for (hot groups), their largest counts are broadcast instead and no
    group's values meet at all.
    """
    keys = list(spec.group)
    vc = value_counts(df, keys, value)
    if groups is not None and groups <= spec.skew.broadcast_keys:
        mx, = fresh(vc, "_mx")
        top = vc.groupBy(*keys).agg(F.max("_c").alias(mx))
        return vc.join(F.broadcast(top), keys).where(F.col("_c") == F.col(mx)).drop(mx)
    lead, = fresh(vc, "_lead")
    w = Window.partitionBy(*keys).orderBy(F.col("_c").desc())
    return vc.withColumn(lead, F.rank().over(w)).where(F.col(lead) == 1).drop(lead)


def mode_summary(df: DataFrame, spec: PanelSpec, value: str, median: bool = False, groups: int | None = None) -> DataFrame:
    """Per group: ``_n_modes``, ``_mode_min``, ``_mode_mean`` (and
    ``_mode_median`` on request), computed from the mode rows without
    collecting them; ``groups`` as in :func:`group_modes`."""
    keys = list(spec.group)
    modes = group_modes(df, spec, value, groups)
    summ = modes.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("_n_modes"),
        F.min(value).alias("_mode_min"),
        F.avg(F.col(value).cast("double")).alias("_mode_mean"),
        F.first("_c").alias("_mode_freq"))
    if median:
        med = group_percentiles(modes, spec, value, [0.5], ["_mode_median"])
        summ = summ.join(med, keys, "left")
    return summ


def attach(df: DataFrame, stats: DataFrame, keys: list[str]) -> DataFrame:
    """Join per-group statistics back to their rows (left join on the keys).

    The statistics side has one row per group. Its size is not bounded by
    construction (one row per customer), so no broadcast is forced: AQE turns
    it into a broadcast when it measures small and splits skewed partitions
    of the row side otherwise.
    """
    return df.join(stats, keys, "left")


# ---------------------------------------------------------------------------
# dispatch: window fast path for bounded groups, aggregates for hot groups

def with_group_stats(df: DataFrame, spec: PanelSpec, fast, slow, hot=None) -> DataFrame:
    """Add per-group statistic columns to every row.

    ``fast(rows) -> rows`` adds the columns with window functions over the
    group (one exchange on the group key, no join). ``slow(rows) ->
    per_group`` computes the same columns as one row per group with
    skew-safe aggregates; they are joined back to the hot rows. Bounded
    groups never pay for the hot path: without hot keys it is not planned.
    """
    hot = hot if hot is not None else spec.hot_keys(df)
    if hot.null_hot:
        rest = with_group_stats(df.where(~spec.null_key()), spec, fast, slow, hot.without_nulls())
        return rest.unionByName(df.where(spec.null_key()), allowMissingColumns=True)

    def apply(rows: DataFrame) -> DataFrame:
        # a row of no group has no statistics
        out = fast(rows)
        new = [c for c in out.columns if c not in rows.columns]
        return out.withColumns({c: F.when(~spec.null_key(), F.col(c)) for c in new})
    if not hot.any:
        return apply(df)
    cold_rows, hot_rows = hot.split(df)
    keys = list(spec.group)
    stats = slow(hot_rows)
    # one row per hot group; the hot-key count was checked against the
    # broadcast bound, so the hot rows are never shuffled to meet their stats
    if hot.count <= spec.skew.broadcast_keys:
        stats = F.broadcast(stats)
    warm = attach(hot_rows, stats, keys)
    return apply(cold_rows).unionByName(warm)


def group_window(spec: PanelSpec) -> Window:
    return Window.partitionBy(*spec.window_cols())


def mode_columns_fast(rows: DataFrame, spec: PanelSpec, value: str, prefix: str = "_mode",
                      median: bool = False) -> DataFrame:
    """Window form of :func:`mode_summary`: all windows share the group
    partitioning, so a single exchange serves them.

    ``count over (order by v range current row)`` counts the peers of a value
    inside its group without partitioning by the value.
    """
    wg = group_window(spec)
    peers = wg.orderBy(value).rangeBetween(0, 0)
    v = F.col(value)
    rows = rows.withColumn("_mc", F.when(v.isNotNull(), F.count(v).over(peers)).otherwise(F.lit(0)))
    rows = rows.withColumn("_mx", F.max("_mc").over(wg))
    is_mode = v.isNotNull() & (F.col("_mc") == F.col("_mx"))
    mv = F.when(is_mode, v)
    cols = {
        f"{prefix}_n": (F.sum(F.when(is_mode, 1)).over(wg) / F.col("_mx")).cast("long"),
        f"{prefix}_min": F.min(mv).over(wg),
        f"{prefix}_mean": F.avg(mv.cast("double")).over(wg),
        f"{prefix}_freq": F.when(F.col("_mx") > 0, F.col("_mx")),
    }
    if median:
        # each mode appears _mx times; the median of that multiset is the
        # median of the distinct modes
        cols[f"{prefix}_median"] = F.percentile(mv.cast("double"), 0.5).over(wg)
    return rows.withColumns(cols).drop("_mc", "_mx")


def mode_columns_slow(rows: DataFrame, spec: PanelSpec, value: str, prefix: str = "_mode",
                      median: bool = False, groups: int | None = None) -> DataFrame:
    s = mode_summary(rows, spec, value, median, groups)
    ren = {"_n_modes": f"{prefix}_n", "_mode_min": f"{prefix}_min", "_mode_mean": f"{prefix}_mean",
           "_mode_freq": f"{prefix}_freq", "_mode_median": f"{prefix}_median"}
    return s.withColumnsRenamed({k: v for k, v in ren.items() if k in s.columns})


def with_mode_columns(df: DataFrame, spec: PanelSpec, value: str, prefix: str = "_mode",
                      median: bool = False, hot=None) -> DataFrame:
    """Add ``{prefix}_n`` (number of modes), ``_min``, ``_mean``, ``_freq``
    (and ``_median``) of ``value`` within each group to every row."""
    hot = hot if hot is not None else spec.hot_keys(df)
    return with_group_stats(
        df, spec,
        lambda r: mode_columns_fast(r, spec, value, prefix, median),
        lambda r: mode_columns_slow(r, spec, value, prefix, median, hot.count), hot)


def with_percentile_column(df: DataFrame, spec: PanelSpec, value: str | Column, p: float, name: str,
                           hot=None) -> DataFrame:
    """Add the exact group percentile of ``value`` to every row."""
    v = F.col(value) if isinstance(value, str) else value
    return with_group_stats(
        df, spec,
        lambda r: r.withColumn(name, F.percentile(v.cast("double"), p).over(group_window(spec))),
        lambda r: group_percentiles(r, spec, v, [p], [name]), hot)  # hot rows only reach here
