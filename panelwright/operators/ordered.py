"""Order-dependent transforms inside a group: fills, lag/diff, row index.

Bounded groups use window functions over ``partitionBy(group).orderBy(order)``
(one exchange on the group key, streaming frames).

Hot groups (see :class:`~panelwright.spec.SkewPolicy`) are cut into chunks
along the whole order tuple; chunk bounds come from a per-group sample of it,
so chunks hold ~``chunk_rows`` rows whatever the types and the distribution. Each chunk is scanned by the same windows, and what a chunk
needs from its predecessors (last non-NULL value, last row, rows before it)
comes from a one-row-per-chunk aggregate scanned across chunks: a segmented
scan. No task ever holds more than one chunk.
"""

from __future__ import annotations

import math
from typing import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import fresh
from ..spec import PanelSpec

UNB_P = Window.unboundedPreceding


# Broadcast the per-group chunk bounds only below this many bytes.
BOUNDS_BROADCAST_BYTES = 64 << 20
# Sampled rows per chunk from which the bounds are taken.
SAMPLES_PER_CHUNK = 20


def _with_chunks(rows: DataFrame, spec: PanelSpec, n_max: int, n_hot: int) -> DataFrame:
    """Add ``_chunk`` to rows of hot groups, monotone in the whole order tuple.

    Bounds are taken from a sample of the group's rows (by a hash of the row,
    stable under retries), as a range partitioning does: any type orders, and
    rows tied on the leading column are cut by the next one.
    """
    keys = list(spec.group)
    every = max(1, spec.skew.chunk_rows // SAMPLES_PER_CHUNK)
    own = [*spec.order, *([spec.id] if spec.id else [])]
    picked = rows.where(F.pmod(F.xxhash64(*[F.col(c) for c in own]), F.lit(every)) == 0)
    # about SAMPLES_PER_CHUNK order tuples per chunk: far below the group's rows
    sorted_ = F.array_sort(F.collect_list(spec.order_struct()))
    step = max(1, spec.skew.chunk_rows // every)
    bounds = picked.groupBy(*keys).agg(sorted_.alias("_s")).select(*keys, F.filter(
        "_s", lambda x, k: ((k + 1) % step) == 0).alias("_bounds"))
    # one row per hot group holding its bounds: broadcast when that is small
    # (checked from the hot-key count), else a join left to AQE
    small = n_hot * math.ceil(n_max / spec.skew.chunk_rows) * 64 <= BOUNDS_BROADCAST_BYTES
    out = rows.join(F.broadcast(bounds) if small else bounds, keys, "left")
    return out.withColumn("_chunk", F.coalesce(_below("_bounds", spec.order_struct()), F.lit(0))).drop("_bounds")


def _below(sorted_: str, at: Column) -> Column:
    """How many elements of a sorted array are less than ``at``, by binary
    search: a row's cost grows with the logarithm of its group's chunks."""
    def halve(acc: Column, _: Column) -> Column:
        mid = F.shiftright(acc["lo"] + acc["hi"], 1)
        less = F.get(sorted_, mid) < at
        return F.struct(F.when(less, mid + 1).otherwise(acc["lo"]).alias("lo"), F.when(less, acc["hi"]).otherwise(mid).alias("hi"))
    size = F.size(sorted_)
    steps = F.sequence(F.lit(0), F.ceil(F.log2(size + 1)).cast("int"))
    return F.when(size > 0, F.aggregate(steps, F.struct(F.lit(0).alias("lo"), size.alias("hi")), halve)["lo"])


def ordered_apply(df: DataFrame, spec: PanelSpec,
                  local: Callable[[DataFrame, Window, Column], DataFrame],
                  carry: Callable[[DataFrame, list[str]], DataFrame] | None,
                  finish: Callable[[DataFrame], DataFrame] | None, hot=None) -> DataFrame:
    """Run an ordered transform on bounded groups and chunked hot groups.

    ``local(df, w, first_in_chunk)`` adds columns computed with window ``w``
    (partitioned by group [and chunk], ordered by ``spec.order``).
    ``carry(hot_rows_with_chunk, keys)`` returns a one-row-per-chunk frame
    with carry-in columns (prefixed ``_cin_``); ``finish`` merges them.
    For bounded groups the carry columns are NULL/0 and ``finish`` still runs.
    """
    hot = hot if hot is not None else spec.hot_keys(df)
    if hot.null_hot:
        rest = ordered_apply(df.where(~spec.null_key()), spec, local, carry, finish, hot.without_nulls())
        return rest.unionByName(df.where(spec.null_key()), allowMissingColumns=True)
    order = spec.order_cols()

    def run(rows: DataFrame, part: list[Column], with_carry: DataFrame | None, chunk_keys):
        w = Window.partitionBy(*part).orderBy(*order)
        first = F.row_number().over(w) == 1
        res = local(rows, w, first)
        if with_carry is not None:
            res = res.join(with_carry, chunk_keys, "left")
        if finish is not None:
            res = finish(res)
        return res

    part = spec.window_cols()
    if not hot.any:
        return run(df, part, None, None)

    keys = list(spec.group)
    cold_rows, hot_rows = hot.split(df)
    cold = run(cold_rows, part, None, None)
    n_max = hot.table.agg(F.max("_n")).first()[0]
    chunked = _with_chunks(hot_rows, spec, n_max, hot.count)
    ck = keys + ["_chunk"]
    carry_df = carry(chunked, keys) if carry is not None else None
    warm = run(chunked, [F.col(c) for c in ck], carry_df, ck).drop("_chunk")
    return cold.unionByName(warm, allowMissingColumns=True)


def _chunk_window(keys: list[str]):
    return Window.partitionBy(*keys).orderBy("_chunk")


# ---------------------------------------------------------------------------
# G1 and variants

def fill_ordered(df: DataFrame, spec: PanelSpec, cols: list[str], how: str = "ffill_bfill", hot=None) -> DataFrame:
    """Forward fill, backward fill, or forward-then-backward fill per group.

    ``ffill_bfill`` equals pandas ``x.ffill().bfill()`` inside each group: a
    NULL takes the last earlier non-NULL value, leading NULLs the first
    non-NULL value; an all-NULL group stays NULL.
    """
    cols = list(cols)
    keys = list(spec.group)
    ostruct = spec.order_struct()

    def local(rows, w, first):
        # backward is forward in the reverse order: a frame that reaches to the
        # end of the group is scanned anew for every row, a growing one once
        part = [F.col(k) for k in (*keys, "_chunk")] if "_chunk" in rows.columns else spec.window_cols()
        back = Window.partitionBy(*part).orderBy(*spec.reverse_order_cols())
        rows = rows.withColumns({f"_ff_{c}": F.last(c, True).over(w.rowsBetween(UNB_P, 0)) for c in cols})
        return rows.withColumns({f"_bf_{c}": F.last(c, True).over(back.rowsBetween(UNB_P, 0)) for c in cols})

    def carry(rows, keys_):
        aggs = []
        for c in cols:
            aggs.append(F.max_by(c, F.when(F.col(c).isNotNull(), ostruct)).alias(f"_last_{c}"))
            aggs.append(F.min_by(c, F.when(F.col(c).isNotNull(), ostruct)).alias(f"_first_{c}"))
        per = rows.groupBy(*keys_, "_chunk").agg(*aggs)
        cw = _chunk_window(keys_)
        back = Window.partitionBy(*keys_).orderBy(F.col("_chunk").desc())
        sel = [*keys_, "_chunk"]
        for c in cols:
            sel.append(F.last(f"_last_{c}", True).over(cw.rowsBetween(UNB_P, -1)).alias(f"_cin_ff_{c}"))
            sel.append(F.last(f"_first_{c}", True).over(back.rowsBetween(UNB_P, -1)).alias(f"_cin_bf_{c}"))
        return per.select(*sel)

    def finish(res):
        out = {}
        for c in cols:
            ff = F.col(f"_ff_{c}")
            bf = F.col(f"_bf_{c}")
            if f"_cin_ff_{c}" in res.columns:
                ff = F.coalesce(ff, F.col(f"_cin_ff_{c}"))
                bf = F.coalesce(bf, F.col(f"_cin_bf_{c}"))
            x = ff if how == "ffill" else bf if how == "bfill" else F.coalesce(ff, bf)
            out[c] = F.when(spec.null_key(), F.col(c)).otherwise(x)  # a row of no group keeps its value
        return res.withColumns(out).drop(*[f"{x}{c}" for c in cols for x in ("_ff_", "_bf_", "_cin_ff_", "_cin_bf_")])

    return ordered_apply(df, spec, local, carry, finish, hot)


def lag_diff(df: DataFrame, spec: PanelSpec, col: str, out: str | None = None,
             lag_out: str | None = None, hot=None) -> DataFrame:
    """First difference ``x - lag(x)`` in group order (pandas ``diff``)."""
    out = out or f"{col}_diff"
    ostruct = spec.order_struct()
    lag_name, first_name = fresh(df, "_lag", "_first")

    def local(rows, w, first):
        return rows.withColumns({lag_name: F.lag(col).over(w), first_name: first})

    def carry(rows, keys_):
        per = rows.groupBy(*keys_, "_chunk").agg(F.max_by(col, ostruct).alias("_lastrow"))
        return per.select(*keys_, "_chunk",
                          F.lag("_lastrow").over(_chunk_window(keys_)).alias("_cin_prev"))

    def finish(res):
        lag = F.col(lag_name)
        if "_cin_prev" in res.columns:
            lag = F.when(F.col(first_name), F.col("_cin_prev")).otherwise(lag)
        lag = F.when(~spec.null_key(), lag)
        res = res.withColumn(out, F.col(col) - lag)
        if lag_out:
            res = res.withColumn(lag_out, lag)
        return res.drop(lag_name, first_name, "_cin_prev")

    return ordered_apply(df, spec, local, carry, finish, hot=hot)


def row_index(df: DataFrame, spec: PanelSpec, out: str = "_rn", with_count: str | None = None,
              hot=None) -> DataFrame:
    """1-based position of each row in its group order (and the group size)."""

    def local(rows, w, first):
        r = rows.withColumn("_rnl", F.row_number().over(w))
        if with_count:
            r = r.withColumn("_cntl", F.count(F.lit(1)).over(Window.partitionBy(*w_part(rows))))
        return r

    keys = list(spec.group)

    def w_part(rows):
        return [*[F.col(k) for k in keys], F.col("_chunk")] if "_chunk" in rows.columns else spec.window_cols()

    def carry(rows, keys_):
        per = rows.groupBy(*keys_, "_chunk").agg(F.count(F.lit(1)).alias("_cn"))
        cw = _chunk_window(keys_)
        return per.select(*keys_, "_chunk",
                          F.coalesce(F.sum("_cn").over(cw.rowsBetween(UNB_P, -1)), F.lit(0)).alias("_cin_off"),
                          F.sum("_cn").over(Window.partitionBy(*keys_)).alias("_cin_total"))

    def finish(res):
        if "_cin_off" in res.columns:
            res = res.withColumn(out, F.col("_rnl") + F.col("_cin_off"))
            if with_count:
                res = res.withColumn(with_count, F.col("_cin_total"))
        else:
            res = res.withColumn(out, F.col("_rnl"))
            if with_count:
                res = res.withColumn(with_count, F.col("_cntl"))
        res = res.withColumns({c: F.when(~spec.null_key(), F.col(c)) for c in (out, with_count) if c})
        return res.drop("_rnl", "_cntl", "_cin_off", "_cin_total")

    return ordered_apply(df, spec, local, carry, finish, hot=hot)
