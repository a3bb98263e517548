"""Best-fit packing by exact complements.

Which documents share a sequence depends only on their lengths, and there are
at most ``size`` different lengths however large the corpus is. The plan is
made from that histogram: single lengths, pair sums and triple sums are
indexed by value, and combinations that fill a sequence exactly are consumed
in bulk under the availability counts, longest pieces first; what is left is
placed best-fit, again in bulk, over bins grouped by their free space. Fills
are given up where best fit alone needs fewer sequences (``plan``). The
plan has a few thousand patterns at most and is broadcast; a document then
finds its pattern, sequence and offset from its rank within its length, and
ranks are counted over hash buckets, so a length that holds most of the
corpus is no hot group.

Rows: null and empty texts are one end id long; documents longer than a
sequence are cut into pieces, the last one shorter; repeated rows and null
ids are packed like any other; an empty table gives an empty result.
"""

from __future__ import annotations

import bisect
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import BATCH_ROWS, bounded_batches, columns, text_of, written
from .wordbpe import default_vocabulary, encoder

PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"


def token_pieces(docs: DataFrame, vocabulary: str | None = None, end_id: int = 0, size: int = 2048,
                 with_ids: bool = False) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32[, ids]): the ids of each text
    and ``end_id``, cut into pieces of at most ``size`` ids."""
    vocabulary = vocabulary or default_vocabulary()

    def make(batches):
        enc, end = encoder(vocabulary), np.array([end_id], "<u4").tobytes()
        for b in columns(batches):
            rows, raw = [], []
            for doc, ids in zip(b["doc_id"].to_pylist(), enc.ids_batch(b["text"].to_pylist())):
                ids += end
                for k, lo in enumerate(range(0, len(ids), 4 * size)):
                    part = ids[lo:lo + 4 * size]
                    rows.append((doc, k, lo // 4, len(part) // 4, zlib.crc32(part)))
                    if with_ids:
                        raw.append(part)
            kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()]
            cols = [pa.array(c, t) for c, t in zip(zip(*rows), kinds)]
            names = ["doc_id", "piece", "start", "length", "ids_crc32"]
            if with_ids:
                cols, names = [*cols, pa.array(raw, pa.binary())], [*names, "ids"]
            yield pa.RecordBatch.from_arrays(cols, names=names)
    bounded_batches(docs.sparkSession, 2 * BATCH_ROWS)
    src = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("text"))
    return src.mapInArrow(make, PIECES + (", ids binary" if with_ids else ""))


class Sums:
    """Pairs of lengths by their sum, longer length first and longest first;
    a triple is a length and the pairs of what it leaves."""

    def __init__(self, lengths: list[int], size: int):
        have = np.array(sorted(lengths), np.int32)
        i, j = np.tril_indices(len(have))
        i, j = have[i], have[j]
        fits = i + j < size
        i, j = i[fits], j[fits]
        order = np.lexsort((-i, i + j))
        self.long, self.short = i[order], j[order]
        self.first = np.searchsorted(self.long + self.short, np.arange(size + 2))
        self.have = have[::-1]

    def pairs(self, total: int, most: int, left: np.ndarray) -> list[tuple[int, ...]]:
        """Pairs of available lengths, none above ``most``, that sum to ``total``."""
        at = slice(self.first[total], self.first[total + 1])
        a, b = self.long[at], self.short[at]
        good = (a <= most) & (left[a] > 0) & (left[b] > 0) & ((a != b) | (left[a] > 1))
        return list(zip(a[good].tolist(), b[good].tolist()))

    def triples(self, total: int, most: int, left: np.ndarray):
        for a in self.have[(self.have <= min(total - 2, most)) & (left[self.have] > 0)].tolist():
            if 3 * a < total:
                break
            for b, c in self.pairs(total - a, a, left):
                yield (a, b, c)


def plan(counts: dict[int, int], size: int) -> list[tuple[tuple[int, ...], int]]:
    """(lengths of a sequence, number of such sequences) that use up the
    counts of each length.

    Exact fills take short pieces that best fit may need more, so the plan is
    made with fills of up to three, two, one and no further piece, and the one
    with the fewest sequences is kept: never more than best fit alone."""
    counts = {k: v for k, v in counts.items() if v > 0}
    sums = Sums(list(counts), size)
    plans = [_plan(counts, size, depth, sums) for depth in (3, 2, 1, 0)]
    return min(plans, key=lambda p: sum(n for _, n in p))


def _plan(counts: dict[int, int], size: int, depth: int, sums: Sums) -> list[tuple[tuple[int, ...], int]]:
    left = np.zeros(size + 1, np.int64)
    left[list(counts)] = list(counts.values())
    out: list[tuple[tuple[int, ...], int]] = []

    def take(pattern: tuple[int, ...]) -> None:
        need = Counter(pattern)
        n = min(int(left[k]) // m for k, m in need.items())
        if n > 0:
            for k, m in need.items():
                left[k] -= n * m
            out.append((pattern, n))

    for big in sorted(counts, reverse=True) if depth else ():
        gap = size - big
        if not gap:
            take((big,))
            continue
        # singles, then pairs, then triples that fill the gap exactly
        take((big, gap))
        for fill in (sums.pairs, sums.triples)[:depth - 1]:
            for rest in fill(gap, big, left) if left[big] else ():
                take((big, *rest))
                if not left[big]:
                    break
    # best fit of the rest, longest first, in bulk over bins of equal space
    bins: dict[int, list[list]] = {}      # free space -> [pattern, number]
    spaces: list[int] = []

    def put(space: int, pattern: tuple[int, ...], n: int) -> None:
        if space not in bins:
            bins[space] = []
            bisect.insort(spaces, space)
        bins[space].append([pattern, n])

    for length in np.flatnonzero(left)[::-1].tolist():
        n = int(left[length])
        while n:
            i = bisect.bisect_left(spaces, length)
            if i < len(spaces):
                space = spaces[i]
                pattern, m = bins[space].pop()
                if not bins[space]:
                    del bins[space]
                    spaces.pop(i)
                used = min(n, m)
                if m > used:
                    put(space, pattern, m - used)
                put(space - length, (*pattern, length), used)
                n -= used
            else:
                per = size // length
                full, some = divmod(n, per)
                if full:
                    put(size - per * length, (length,) * per, full)
                if some:
                    put(size - some * length, (length,) * some, 1)
                n = 0
    out += [(tuple(p), n) for group in bins.values() for p, n in group]
    return out


def pack(pieces: DataFrame, size: int = 2048, bucket_rows: int = 50_000) -> DataFrame:
    """``pieces`` (any columns, one of them ``length`` from 1 to ``size``) with
    ``sequence_id`` and ``offset``."""
    spark = pieces.sparkSession
    pieces = written(pieces, "pieces")
    names = pieces.columns
    per = pieces.groupBy("length").agg(F.count(F.lit(1)).alias("n"))
    counts = {r["length"]: r["n"] for r in per.collect()}  # at most ``size`` rows
    if any(not 0 < k <= size for k in counts):
        raise ValueError(f"piece lengths must be from 1 to {size}")
    slots, seq = [], 0
    used: Counter = Counter()
    for pattern, n in plan(counts, size):
        at = 0
        for length in pattern:
            # the pieces of this length ranked used .. used+n-1 fill this place
            slots.append((length, used[length], used[length] + n, seq, at))
            used[length] += n
            at += length
        seq += n
    by_length: dict[int, list] = {}
    for s in slots:
        by_length.setdefault(s[0], []).append(s[1:])
    table = {k: tuple(np.array(c, np.int64) for c in zip(*sorted(v))) for k, v in by_length.items()}

    buckets = max(1, -(-max(counts.values(), default=0) // bucket_rows))
    order = [F.col(c) for c in names if c in ("doc_id", "piece", "start", "ids_crc32")] or [F.col("length")]
    keyed = pieces.withColumn("bucket", F.pmod(F.xxhash64(*[c for c in names if c in ("doc_id", "piece")] or ["length"]), F.lit(buckets)))
    cells = keyed.groupBy("length", "bucket").agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("length").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    cells = cells.select("length", "bucket", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    within = Window.partitionBy("length", "bucket").orderBy(*order)
    ranked = (keyed.withColumn("rank", F.row_number().over(within) - 1)
              .join(cells, ["length", "bucket"]).withColumn("rank", F.col("rank") + F.col("base"))
              .select(*names, "rank"))
    plan_side = spark.sparkContext.broadcast(table)

    def place(batches):
        found = plan_side.value
        for b in batches:
            if not b.num_rows:
                continue
            length = b.column(b.schema.get_field_index("length")).to_numpy()
            rank = b.column(b.schema.get_field_index("rank")).to_numpy().astype(np.int64)
            sid, off = np.empty(len(length), np.int64), np.empty(len(length), np.int64)
            order = np.argsort(length, kind="stable")
            cuts = np.flatnonzero(np.diff(length[order])) + 1
            for rows in np.split(order, cuts):
                lo, _, seq, at = found[int(length[rows[0]])]
                i = np.searchsorted(lo, rank[rows], side="right") - 1
                sid[rows] = seq[i] + rank[rows] - lo[i]
                off[rows] = at[i]
            cols = [c for c, n in zip(b.columns, b.schema.names) if n != "rank"]
            yield pa.RecordBatch.from_arrays([*cols, pa.array(sid), pa.array(off)], names=[*names, "sequence_id", "offset"])
    schema = pieces.schema.add("sequence_id", "long").add("offset", "long")
    return ranked.mapInArrow(place, schema)
