"""The group steps of a panel recipe for bounded and for hot groups.

A recipe is written once over *levels*: each adds named columns that need a
whole group. :class:`WindowLevels` evaluates a level as window expressions
over rows that are already dealt by the group. :class:`SplitLevels` does the
same for groups too large for one task: their rows lie in a table bucketed by
(group, chunk) and sorted in panel order, statistics are one row per group,
and what a chunk needs from the others is one row per chunk. Both add the same
columns, so a panel of both kinds is cleaned by one recipe without a write
per step.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..operators.groupstats import group_percentiles, mode_summary
from ..operators.ordered import _with_chunks
from ..session import bucketed, materialize, stored
from ..spec import HotKeys, PanelSpec

UNB_P, UNB_F = Window.unboundedPreceding, Window.unboundedFollowing


def _x(name: str) -> Column:
    return F.col(name).cast("double")


# What stands for a missing key of a type; rows of no group are told apart by a column of their own.
NO_KEY = {"string": "", "boolean": False, "date": "1970-01-01", "timestamp": "1970-01-01", "timestamp_ntz": "1970-01-01"}


class WindowLevels:
    """Groups that fit a task: one exchange before, none here.

    Rows lie in a table bucketed by :attr:`keys`, the group's columns without
    NULLs, so that statistics of one row per group meet the rows in place."""

    def __init__(self, spec: PanelSpec):
        self.spec = spec
        self.keys = [*(f"_key{i}" for i in range(len(spec.group))), "_lone"]
        self.g = [F.col(k) for k in self.keys]
        self.group = Window.partitionBy(*self.g)

    def _keyed(self, rows: DataFrame) -> DataFrame:
        """The rows with their keys; ``_lone`` keeps rows of no group from meeting."""
        types = dict(rows.dtypes)
        own = [F.col(c).isNull() for c in self.spec.group] + ([F.col(self.spec.iso)] if self.spec.iso else [])
        return rows.withColumns({
            **{k: F.coalesce(F.col(c), F.lit(NO_KEY.get(types[c], 0)).cast(types[c])) for k, c in zip(self.keys, self.spec.group)},
            "_lone": F.coalesce(F.when(self.spec.null_key(), F.xxhash64(*own)), F.lit(0).cast("long"))})

    def place(self, rows: DataFrame, checkpoint: bool = True, ahead=None, reads: list[str] = ()) -> DataFrame:
        """The rows' own table, in columns. ``ahead(levels, rows)`` adds what
        can be told from the group alone before the write, once for all that
        read the table; it sees the columns ``reads`` and the row's position,
        the others pass its windows as one value."""
        rows = self._keyed(rows)
        if ahead is not None:
            seen = list(dict.fromkeys([*self.keys, *reads]))
            rows = rows.select(*seen, F.struct(*[c for c in rows.columns if c not in seen]).alias("_row"))
        if checkpoint:
            rows = rows.repartition(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), *self.keys)
        if ahead is not None:
            rows = ahead(self, self._positioned(rows))
            rows = rows.select(*[c for c in rows.columns if c != "_row"], "_row.*")
        return materialize(rows, self.keys, order=["_pos"]) if checkpoint else rows

    def _positioned(self, df: DataFrame) -> DataFrame:
        if "_pos" in df.columns:
            return df
        return df.withColumn("_pos", F.row_number().over(self.group.orderBy(*self.spec.order_cols())))

    def _filled(self, name: str, part: list[Column]) -> Column:
        # only leading NULLs are left to fill backward, with the first value there is
        at = Window.partitionBy(*part).orderBy("_pos")
        return F.coalesce(F.last(name, True).over(at.rowsBetween(UNB_P, 0)), F.first(name, True).over(at.rowsBetween(UNB_P, UNB_F)))

    def deviations(self, df: DataFrame, medians: list[str], dev: list[str]) -> DataFrame:
        df = df.withColumns({f"_med_{n}": F.percentile(_x(n), 0.5).over(self.group) for n in medians})
        level = {}
        for n in dev:
            ad = F.abs(_x(n) - F.col(f"_med_{n}"))
            level[f"_mad_{n}"] = F.percentile(ad, 0.5).over(self.group)
            level[f"_eq_{n}"] = F.sum(F.when(ad == 0, 1).otherwise(0)).over(self.group) == F.count(_x(n)).over(self.group)
        return df.withColumns(level) if level else df

    def max_mads(self, df: DataFrame, dev: list[str], by: list[str]) -> DataFrame:
        """Of rows that have their deviations."""
        return df.where(~self.spec.null_key()).groupBy(*by).agg(*[F.max(f"_mad_{n}").alias(f"maxmad:{n}") for n in dev])

    def smallest_mode_within(self, df: DataFrame, value: str, key2: str, out: str) -> DataFrame:
        w = Window.partitionBy(*self.g, key2)
        df = df.withColumn("_mc", F.when(F.col(value).isNotNull(), F.count(value).over(w.orderBy(value).rangeBetween(0, 0))).otherwise(0))
        # smallest mode in one pass: the minimum of (-count, value)
        first = F.min(F.when(F.col(value).isNotNull(), F.struct((-F.col("_mc")).alias("k"), F.col(value).alias("v")))).over(w)
        return df.withColumn(out, first["v"]).drop("_mc")

    def fill_within(self, df: DataFrame, col: str, key2: str) -> DataFrame:
        whole = F.col(key2).isNotNull() & ~self.spec.null_key()
        return self._positioned(df).withColumn(col, F.when(whole, self._filled(col, [*self.g, F.col(key2)])).otherwise(F.col(col)))

    def fills(self, df: DataFrame, cols: dict[str, str]) -> DataFrame:
        return self._positioned(df).withColumns({out: self._filled(c, self.g) for out, c in cols.items()})

    def modes(self, df: DataFrame, cols: list[str], median: set[str], source: DataFrame) -> DataFrame:
        """Counts of a group's values take its key and one column of
        ``source``; one row per group meets the rows where they lie."""
        found, types = source.select(*self.keys).distinct(), dict(source.dtypes)
        for n in cols:
            counts = source.where(F.col(n).isNotNull()).groupBy(*self.keys, n).agg(F.count(F.lit(1)).alias("_c"))
            lead = counts.withColumn("_mx", F.max("_c").over(self.group)).where(F.col("_c") == F.col("_mx"))
            aggs = [F.count(F.lit(1)).alias(f"_n_{n}"), F.min(n).alias(f"_min_{n}")]
            if types[n] != "string":
                aggs.append(F.avg(_x(n)).alias(f"_mean_{n}"))
            if n in median:
                aggs.append(F.percentile(_x(n), 0.5).alias(f"_median_{n}"))
            found = found.join(lead.groupBy(*self.keys).agg(*aggs).hint("merge"), self.keys, "left")
        return df.join(found.hint("merge"), self.keys, "left")

    def anchor(self, df: DataFrame, col: str, source: DataFrame, out: str = "_anc") -> DataFrame:
        whole = self.group.orderBy("_pos").rowsBetween(UNB_P, UNB_F)
        return df.withColumn(out, F.min(F.when(F.col(col).isNotNull(), F.struct(F.col(col).alias("v"), F.col("_pos").alias("p")))).over(whole))


class SplitLevels:
    """Hot groups, cut into chunks once (:meth:`place`). Tables of a row per
    group or chunk are broadcast where their counted rows are within the
    policy's bound, and joined otherwise."""

    def __init__(self, spec: PanelSpec, hot: HotKeys):
        self.spec, self.hot = spec, hot
        self.keys = list(spec.group)
        self.chunk = [*self.keys, "_chunk"]
        self.offsets: DataFrame | None = None
        self.stats: DataFrame | None = None

    def place(self, rows: DataFrame) -> DataFrame:
        """The hot rows' own table, read by every level."""
        most = self.hot.table.agg(F.max("_n")).first()[0]
        return bucketed(_with_chunks(rows, self.spec, most, self.hot.count), "hot_rows", self.chunk, list(self.spec.order))

    def _join(self, df: DataFrame, table: DataFrame, on: list[str]) -> DataFrame:
        table = stored(table, "hot-level")
        if table.count() <= self.spec.skew.broadcast_keys:
            table = F.broadcast(table)
        return df.join(table, on, "left")

    def _wide(self, rows: DataFrame, values: dict[str, Column], prefix: str) -> DataFrame:
        """Median of each value per group, one row per group."""
        tall = rows.select(*self.keys, *[v.alias(n) for n, v in values.items()]).unpivot(self.keys, list(values), "_column", "_value")
        q = group_percentiles(tall, PanelSpec((*self.keys, "_column"), skew=self.spec.skew), "_value", [0.5], ["_m"])
        return q.groupBy(*self.keys).agg(*[F.max(F.when(F.col("_column") == n, F.col("_m"))).alias(f"{prefix}{n}") for n in values])

    def deviations(self, df: DataFrame, medians: list[str], dev: list[str]) -> DataFrame:
        if self.stats is None:
            med = self._wide(df, {n: _x(n) for n in medians}, "_med_")
            near = self._join(df, med, self.keys)
            off = {n: F.abs(_x(n) - F.col(f"_med_{n}")) for n in dev}
            eq = near.groupBy(*self.keys).agg(*[F.first(f"_med_{n}").alias(f"_med_{n}") for n in medians], *[
                (F.sum(F.when(off[n] == 0, 1).otherwise(0)) == F.count(_x(n))).alias(f"_eq_{n}") for n in dev])
            self.stats = stored(eq.join(self._wide(near, off, "_mad_"), self.keys, "left") if dev else eq, "hot-deviations")
        return self._join(df, self.stats, self.keys)

    def max_mads(self, df: DataFrame, dev: list[str], by: list[str]) -> DataFrame:
        return self.stats.groupBy(*by).agg(*[F.max(f"_mad_{n}").alias(f"maxmad:{n}") for n in dev])

    def smallest_mode_within(self, df: DataFrame, value: str, key2: str, out: str) -> DataFrame:
        n = df.where(F.col(value).isNotNull() & F.col(key2).isNotNull()).groupBy(*self.keys, key2, value).agg(F.count(F.lit(1)).alias("_c"))
        first = n.groupBy(*self.keys, key2).agg(F.min(F.struct((-F.col("_c")).alias("k"), F.col(value).alias("v"))).alias("_f"))
        return self._join(df, first.select(*self.keys, key2, F.col("_f.v").alias(out)), [*self.keys, key2])

    def _carried(self, df: DataFrame, cols: dict[str, str], part: list[str]) -> DataFrame:
        """Values carried over chunk borders: a segmented scan of one row per
        (part, chunk); the columns ``_ci_``/``_cb_`` and the chunk's first position."""
        at = self.spec.order_struct()
        per = df.groupBy(*part, "_chunk").agg(F.count(F.lit(1)).alias("_rows"), *[x for out, c in cols.items() for x in (
            F.max_by(c, F.when(F.col(c).isNotNull(), at)).alias(f"_l_{out}"), F.min_by(c, F.when(F.col(c).isNotNull(), at)).alias(f"_f_{out}"))])
        ahead = Window.partitionBy(*part).orderBy("_chunk").rowsBetween(UNB_P, -1)
        back = Window.partitionBy(*part).orderBy(F.col("_chunk").desc()).rowsBetween(UNB_P, -1)
        return per.select(*part, "_chunk", F.coalesce(F.sum("_rows").over(ahead), F.lit(0)).alias("_offset"), *[x for out in cols for x in (
            F.last(f"_l_{out}", True).over(ahead).alias(f"_ci_{out}"), F.last(f"_f_{out}", True).over(back).alias(f"_cb_{out}"))])

    def _filled(self, out: str, col: str, part: list[Column]) -> Column:
        ahead = Window.partitionBy(*part).orderBy(*self.spec.order_cols()).rowsBetween(UNB_P, 0)
        back = Window.partitionBy(*part).orderBy(*self.spec.reverse_order_cols()).rowsBetween(UNB_P, 0)
        return F.coalesce(F.last(col, True).over(ahead), F.col(f"_ci_{out}"), F.last(col, True).over(back), F.col(f"_cb_{out}"))

    def fill_within(self, df: DataFrame, col: str, key2: str) -> DataFrame:
        part = [*self.keys, key2]
        carried = self._carried(df.where(F.col(key2).isNotNull()), {col: col}, part).drop("_offset")
        out = self._join(df, carried, [*part, "_chunk"])
        filled = self._filled(col, col, [F.col(c) for c in (*self.chunk, key2)])
        return (out.withColumn("_new", F.when(F.col(key2).isNotNull(), filled).otherwise(F.col(col)))
                .withColumn(col, F.col("_new")).drop("_new", f"_ci_{col}", f"_cb_{col}"))

    def fills(self, df: DataFrame, cols: dict[str, str]) -> DataFrame:
        carried = stored(self._carried(df, cols, self.keys), "hot-carried")
        self.offsets = carried.select(*self.chunk, "_offset")
        out = self._join(df, carried, self.chunk)
        part = [F.col(c) for c in self.chunk]
        level = {f: self._filled(f, c, part) for f, c in cols.items()}
        level["_pos"] = F.row_number().over(Window.partitionBy(*part).orderBy(*self.spec.order_cols())) + F.col("_offset")
        return out.withColumns(level).drop("_offset", *[f"{p}{f}" for f in cols for p in ("_ci_", "_cb_")])

    def modes(self, df: DataFrame, cols: list[str], median: set[str], source: DataFrame) -> DataFrame:
        for n in cols:
            s = mode_summary(source, PanelSpec(tuple(self.keys), skew=self.spec.skew), n, median=n in median, groups=self.hot.count)
            kept = {"_n_modes": f"_n_{n}", "_mode_min": f"_min_{n}", "_mode_mean": f"_mean_{n}", "_mode_median": f"_median_{n}"}
            text = dict(source.dtypes)[n] == "string"
            s = s.select(*self.keys, *[F.col(a).alias(b) for a, b in kept.items() if a in s.columns and not (text and a == "_mode_mean")])
            df = self._join(df, s, self.keys)
        return df

    def anchor(self, df: DataFrame, col: str, source: DataFrame, out: str = "_anc") -> DataFrame:
        at = F.row_number().over(Window.partitionBy(*self.chunk).orderBy(*self.spec.order_cols()))
        rows = self._join(source.select(*self.chunk, col, at.alias("_at")), self.offsets, self.chunk)
        first = rows.where(F.col(col).isNotNull()).groupBy(*self.keys).agg(
            F.min(F.struct(F.col(col).alias("v"), (F.col("_at") + F.col("_offset")).alias("p"))).alias(out))
        return self._join(df, first, self.keys)


def placed(df: DataFrame, spec: PanelSpec, any_hot: bool, checkpoint: bool = True, ahead=None, reads: list[str] = ()) -> list:
    """A panel written once: (levels, rows) of its bounded and its hot groups.
    ``ahead`` is applied to the bounded ones before the write (see
    :meth:`WindowLevels.place`)."""
    if not any_hot:
        lv = WindowLevels(spec)
        return [(lv, lv.place(df, checkpoint, ahead, reads))]
    hot = spec.hot_keys(df)
    hot = HotKeys(stored(hot.table, "hot-groups"), hot.count, hot.spec, hot.null_hot)
    bounded, rest = hot.split(df)
    lv, split = WindowLevels(spec), SplitLevels(spec, hot)
    return [(lv, lv.place(bounded, ahead=ahead, reads=reads)), (split, split.place(rest))]


def union(frames: list[DataFrame]) -> DataFrame:
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out


class Scalars:
    """Scalars of whole columns: literals, or with ``by`` (the sample a row
    came from) columns of a small table with one row per sample."""

    def __init__(self, by: str | None, values: dict | None = None):
        self.by, self.values = by, values if values is not None else {}
        self.table: DataFrame | None = None
        self.names: list[str] = []

    def add(self, found: DataFrame) -> None:
        """Scalars of ``found``: one row, or one row per sample."""
        names = [c for c in found.columns if c != self.by]
        if not self.by:
            r = found.first()
            self.values.update({n: r[n] for n in names})
            return
        self.table = stored(found if self.table is None else self.table.join(found, self.by, "full"), "scalars")
        self.names += names

    def attach(self, df: DataFrame, bound: int) -> DataFrame:
        if not self.by:
            return df
        side = self.table.select(self.by, *[F.col(f"`{n}`").alias(f"_s_{n}") for n in self.names])
        return df.join(F.broadcast(side) if self.table.count() <= bound else side, self.by, "left")

    def detach(self, df: DataFrame) -> DataFrame:
        return df.drop(*[f"_s_{n}" for n in self.names]) if self.by else df

    def col(self, name: str) -> Column:
        return F.col(f"`_s_{name}`") if self.by else F.lit(self.values[name]).cast("double")
