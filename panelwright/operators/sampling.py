"""Ordering, top-k, seeded sampling and splits.

Randomness is a hash of the row key and a seed, so results are stable under
re-execution, repartitioning and executor loss (``rand()`` and
``randomSplit`` are not).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import fresh, stored


def seeded_hash(cols: list[str], seed: int) -> Column:
    """The first 15 hex digits of md5('seed|key|...') as a number: any engine
    can state the same sample. A NULL key hashes as an empty text."""
    text = F.concat_ws("|", F.lit(str(seed)), *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in cols])
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, 15), 16, 10).cast("long")


def top_k_distinct(df: DataFrame, col: str, k: int) -> DataFrame:
    """The k smallest distinct values (TakeOrdered, no global sort)."""
    return df.select(col).where(F.col(col).isNotNull()).distinct().orderBy(col).limit(k)


def preview(df: DataFrame, key: list[str], n: int) -> DataFrame:
    """First n rows by key."""
    return df.orderBy(*key).limit(n)


def shuffle(df: DataFrame, key: list[str], seed: int = 42, out: str = "position", bucket_rows: int = 500_000) -> DataFrame:
    """A deterministic permutation: the rows in it, with their 0-based
    position in ``out``. Positions are ranks of the seeded hash, counted in
    equal slices of its range, so no task sees more than a slice."""
    n = df.count()
    slices = max(1, -(-n // bucket_rows))
    h = df.withColumn("_h", seeded_hash(key, seed))
    h = h.withColumn("_slice", F.floor(F.col("_h") / F.lit((16 ** 15) / slices)).cast("long"))
    per = h.groupBy("_slice").agg(F.count(F.lit(1)).alias("_n"))  # one row per slice
    base = per.select("_slice", F.coalesce(F.sum("_n").over(
        Window.orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_base"))
    w = Window.partitionBy("_slice").orderBy("_h", *key)
    placed = h.withColumn("_at", F.row_number().over(w) - 1).join(base, "_slice")
    placed = placed.withColumn(out, F.col("_at") + F.col("_base")).drop("_slice", "_base", "_at", "_h")
    return placed.repartitionByRange(slices, out).sortWithinPartitions(out)


HASH_BITS = 60          # of :func:`seeded_hash`
RANGE_BITS = 12
FINISHED_KEYS = 100_000


def bottom_k(keys: DataFrame, k: int, seed: int, finish: int = FINISHED_KEYS) -> DataFrame:
    """The k keys (distinct rows of all columns) with the smallest seeded hash.

    Counts over equal ranges of the hash find the range the cut falls into
    and narrow it until it holds at most ``finish`` keys; keys below it are
    taken by a filter, and only those inside it are ordered."""
    names = keys.columns
    (h,) = fresh(keys, "_h")
    keys = stored(keys.withColumn(h, seeded_hash(names, seed)), "sample-keys")
    low, bits, left = 0, HASH_BITS, k
    while True:
        shift = max(0, bits - RANGE_BITS)
        inside = keys.where((F.col(h) >= low) & (F.col(h) < low + (1 << bits)))
        # at most 2 ** RANGE_BITS rows
        counts = sorted((r[0], r[1]) for r in inside.groupBy(F.shiftright(h, shift)).agg(F.count(F.lit(1))).collect())
        if left <= 0 or sum(n for _, n in counts) <= left:
            return keys.where(F.col(h) < (low if left <= 0 else low + (1 << bits))).drop(h)
        for at, n in counts:
            if n >= left:
                break
            left -= n
        low, bits = at << shift, shift
        if n <= finish or not shift:
            break
    cut = (F.col(h) >= low) & (F.col(h) < low + (1 << bits))
    last = keys.where(cut).orderBy(h, *names).limit(left)
    return keys.where(F.col(h) < low).unionByName(last).drop(h)


def sample_groups(df: DataFrame, group: list[str], k: int, seed: int = 41, broadcast_keys: int = 200_000) -> DataFrame:
    """All rows of k groups picked by a seeded hash (semi join; the
    k keys are broadcast up to ``broadcast_keys`` of them)."""
    keys = bottom_k(df.select(*group).distinct(), k, seed)
    return df.join(F.broadcast(keys) if k <= broadcast_keys else keys, group, "left_semi")


def split(df: DataFrame, key: list[str], train_pct: int = 80, seed: int = 42,
          col: str = "split") -> DataFrame:
    """``train``/``test`` by ``pmod(hash(key, seed), 100)``. Pass the
    group column as ``key`` to keep a customer's rows together (Q10)."""
    b = F.pmod(seeded_hash(key, seed), F.lit(100))
    return df.withColumn(col, F.when(b < train_pct, F.lit("train")).otherwise(F.lit("test")))
