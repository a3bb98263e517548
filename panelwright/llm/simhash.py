"""SimHash near-duplicates by tiled exact comparison.

Every document gets a 64-bit fingerprint of its word shingles. Only distinct
fingerprints are compared: numpy exclusive-or and bit counts over tiles that
are sorted by population count, skipping tile pairs whose population counts
differ by more than the radius. To keep the number of tiles from growing with
the square of the corpus, fingerprints meet only where they share one of
``radius + 1`` bit blocks: two that differ in at most ``radius`` bits agree on
at least one whole block, so no link is lost. A block value shared by more
fingerprints than a task should hold is split once more by the same rule: the
bits outside the block form ``radius + 1`` parts, of which two linked
fingerprints share one, so each fingerprint is copied as many times, whatever
the size of the block. Only where both values are shared by too many is the
set cut into tiles, as many as each population count needs, and each pair of
tiles within the radius becomes a unit of its own.

Links inside one unit are reduced to a spanning forest before they leave the
task, so a cluster of many near copies costs rows in proportion to its size.

Rows: null and empty texts have fingerprint zero, linked like any other;
a text with fewer words than a shingle is one shingle of all its words;
repeated rows and ties share a fingerprint; a null ``doc_id`` belongs to its
component but never names it (a component of null ids has a null id). An
empty table gives an empty result. Texts are hashed whole, of any length.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import bounded_batches, columns, forest, keep_rows, runs, small_side, text_of, written
from .graph import components

SEED = 42
TILE = 2048


def fingerprint(text: str | None, words: int = 4) -> int:
    """64-bit SimHash: a bit is set if it is in over half of the shingles'
    XXH64 values. A-Z is lower-cased; words are split at ASCII white space."""
    w = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not w:
        return 0
    joined = b" ".join(w)
    if len(w) <= words:
        return xxhash.xxh64_intdigest(joined, SEED)
    ends = np.cumsum(np.fromiter(map(len, w), np.int64, len(w)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    digest = xxhash.xxh64_intdigest
    h = np.array([digest(joined[a:b], SEED) for a, b in zip(starts[:len(w) - words + 1].tolist(), ends[words - 1:].tolist())],
                 dtype=np.uint64)
    n = np.zeros(64, np.int64)
    for lo in range(0, len(h), 65536):
        part = np.ascontiguousarray(h[lo:lo + 65536]).view(np.uint8).reshape(-1, 8)
        n += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * n > len(h), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, words: int = 4) -> DataFrame:
    """(doc_id, fp) per row; ``fp`` is the fingerprint as a signed long."""
    def make(batches):
        for b in columns(batches):
            fp = np.array([fingerprint(t, words) for t in b["text"].to_pylist()], dtype=np.uint64)
            yield pa.RecordBatch.from_arrays([b["doc_id"], pa.array(fp.view(np.int64))], names=["doc_id", "fp"])
    bounded_batches(docs.sparkSession)
    src = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("text"))
    return src.mapInArrow(make, "doc_id long, fp long")


def blocks(radius: int, bits: list[int] | None = None) -> list[list[int]]:
    """``radius + 1`` blocks (lists of bits) of the 64 bits, or of ``bits``."""
    bits = list(range(64)) if bits is None else bits
    cuts = [round(len(bits) * i / (radius + 1)) for i in range(radius + 2)]
    return [bits[a:b] for a, b in zip(cuts, cuts[1:])]


def _mask(bits: list[int]) -> int:
    """The bits as a signed long."""
    m = sum(1 << b for b in bits)
    return m - (1 << 64) if m >> 63 else m


def _links(a: np.ndarray, b: np.ndarray | None, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Spanning links (fp, fp) among the fingerprints of one unit: all of
    ``a``, or those between ``a`` and ``b``."""
    all_ = a if b is None else np.concatenate([a, b])
    count = np.bitwise_count(all_)
    if b is None:
        order = np.argsort(count, kind="stable")
        all_, count = all_[order], count[order]
        pairs = [(i, j) for i in range(0, len(all_), TILE) for j in range(i, len(all_), TILE)
                 if int(count[j]) - int(count[min(i + TILE, len(all_)) - 1]) <= radius]
        end = len(all_)
    else:
        pairs = [(i, j) for i in range(0, len(a), TILE) for j in range(len(a), len(all_), TILE)]
        end = len(all_)
    stop = lambda i: min(i + TILE, len(a) if b is not None and i < len(a) else end)
    u = v = np.zeros(0, np.int64)
    for i, j in pairs:
        x, y = np.nonzero(np.bitwise_count(all_[i:stop(i), None] ^ all_[None, j:stop(j)]) <= radius)
        keep = (x + i) < (y + j)
        u, v = np.concatenate([u, x[keep] + i]), np.concatenate([v, y[keep] + j])
        if len(u) > 4 * len(all_):
            u, v = forest(u, v, len(all_))
    if len(u):
        u, v = forest(u, v, len(all_))
    return all_[u], all_[v]


def _edges(batches_of_units, radius):
    out_u, out_v = [], []
    for a, b in batches_of_units:
        u, v = _links(a, b, radius)
        if len(u):
            out_u.append(u.view(np.int64))
            out_v.append(v.view(np.int64))
        if sum(map(len, out_u)) > 50_000:
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(out_u)), pa.array(np.concatenate(out_v))], names=["u", "v"])
            out_u, out_v = [], []
    if out_u:
        yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(out_u)), pa.array(np.concatenate(out_v))], names=["u", "v"])


def links(fps: DataFrame, radius: int, unit_rows: int = 20_000) -> DataFrame:
    """Spanning links (u, v) between distinct fingerprints ``fp`` that differ
    in at most ``radius`` bits; their components are those of all links."""
    def by_unit(batches):
        def units():
            for _, t in runs(batches, "unit"):
                fp = t["fp"].to_numpy().view(np.uint64)
                side = t["side"].to_numpy()
                yield (fp, None) if not side.any() else (fp[side < 2], fp[side == 2])
        yield from _edges(units(), radius)

    def units_of(keyed, name):
        """(units of the values that a task holds, rows of the others)."""
        sizes = written(keyed.groupBy("block", "value").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1), name)
        small, large = sizes.where(F.col("n") <= unit_rows), sizes.where(F.col("n") > unit_rows)
        n_small, n_large = small.count(), large.count()
        plain = (keyed.join(small_side(small, n_small), ["block", "value"])
                 .select("fp", F.concat_ws("/", "block", "value").alias("unit"), F.lit(0).alias("side")))
        return plain, keyed.join(small_side(large, n_large), ["block", "value"]) if n_large else None

    def keys(masks):
        return F.explode(F.array(*[F.struct(F.lit(i).alias("block"), F.col("fp").bitwiseAND(F.lit(m)).alias("value")) for i, m in masks]))

    parts = blocks(radius)
    keyed = fps.select("fp", keys([(str(i), _mask(p)) for i, p in enumerate(parts)]).alias("k")).select("fp", "k.block", "k.value")
    todo, hot = units_of(keyed, "block-sizes")
    if hot is not None:
        # the bits outside the shared block, in parts of their own
        inner = F.array(*[F.array(*[
            F.struct(F.concat(F.lit(f"{i}."), F.lit(str(j))).alias("block"), F.col("fp").bitwiseAND(F.lit(_mask(p + q))).alias("value"))
            for j, q in enumerate(blocks(radius, [b for b in range(64) if b not in p]))]) for i, p in enumerate(parts)])
        deep = hot.select("fp", F.explode(F.element_at(inner, F.col("block").cast("int") + 1)).alias("k")).select("fp", "k.block", "k.value")
        plain, hot = units_of(written(deep, "split-blocks"), "split-block-sizes")
        todo = todo.unionByName(plain)
    if hot is not None:
        # tiles: fingerprints of one population count, cut by a hash; a unit
        # is a pair of tiles within the radius
        hot = hot.withColumn("pop", F.bit_count("fp"))
        counts = written(hot.groupBy("block", "value", "pop").agg(F.ceil(F.count(F.lit(1)) / unit_rows).cast("int").alias("cuts")), "tile-counts")
        n_counts = counts.count()
        near = (counts.select("block", "value", F.col("pop").alias("pop2"), F.col("cuts").alias("cuts2"),
                              F.explode(F.sequence(F.col("pop") - radius, F.col("pop") + radius)).alias("pop"))
                .join(counts, ["block", "value", "pop"])
                .groupBy("block", "value", "pop", "cuts").agg(F.collect_list(F.struct("pop2", "cuts2")).alias("near")))
        mine, theirs = F.struct("pop", "cut"), F.struct(F.col("t.pop2").alias("pop"), F.col("cut2").alias("cut"))
        lo, hi = F.least(mine, theirs), F.greatest(mine, theirs)
        pairs = (hot.join(small_side(near, n_counts), ["block", "value", "pop"])
                 .withColumn("cut", F.pmod(F.xxhash64("fp"), F.col("cuts")).cast("int"))
                 .select("fp", "block", "value", "pop", "cut", F.explode("near").alias("t"))
                 .select("*", F.explode(F.sequence(F.lit(0), F.col("t.cuts2") - 1)).alias("cut2")))
        todo = todo.unionByName(pairs.select(
            "fp", F.concat_ws("/", "block", "value", lo["pop"], lo["cut"], hi["pop"], hi["cut"]).alias("unit"),
            F.when(mine == theirs, 0).when(mine == lo, 1).otherwise(2).alias("side")))
    return (todo.repartition("unit").sortWithinPartitions("unit").mapInArrow(by_unit, "u long, v long")).distinct()


def near_duplicates(docs: DataFrame, words: int = 4, radius: int = 4, unit_rows: int = 20_000,
                    root: bool = False) -> DataFrame:
    """(doc_id, fp, component_id, first) per row of ``docs``: its fingerprint,
    the smallest ``doc_id`` reachable over links of at most ``radius`` bits,
    and the smallest ``doc_id`` with the same fingerprint; with ``root`` also
    the fingerprint that names its component."""
    fps = written(fingerprints(docs, words), "fingerprints")
    first = written(fps.groupBy("fp").agg(F.min("doc_id").alias("first")), "distinct-fingerprints")
    stars = components(links(first.select("fp"), radius, unit_rows))
    rooted = (first.join(stars.withColumnRenamed("node", "fp"), "fp", "left")
              .withColumn("root", F.coalesce("root", "fp")))
    ids = rooted.groupBy("root").agg(F.min("first").alias("component_id"))
    by_fp = written(rooted.join(ids, "root").select("fp", "first", "component_id", "root"), "fingerprint-components")
    return fps.join(by_fp, "fp").select("doc_id", "fp", "component_id", "first", *(["root"] if root else []))


def deduplicate(docs: DataFrame, words: int = 4, radius: int = 4) -> DataFrame:
    """One row of ``docs`` of each component: of its rows with the smallest
    ``doc_id`` (a null one if it has no other) one with the smallest
    fingerprint. Rows equal in both are one and the same to this order, so
    any one of them stays."""
    @F.pandas_udf("long")
    def key(text: pd.Series) -> pd.Series:
        return pd.Series(np.array([fingerprint(t, words) for t in text], dtype=np.uint64).view(np.int64))

    found = written(near_duplicates(docs, words, radius, root=True).withColumn("n", F.monotonically_increasing_id()), "simhash-rows")
    best = (found.where(F.col("doc_id").eqNullSafe(F.col("component_id"))).groupBy("root")
            .agg(F.min(F.struct("fp", "n")).alias("lead")).select(F.col("lead.n").alias("n"), F.lit(True).alias("stay")))
    marked = found.join(best, "n", "left").select("doc_id", F.col("fp").alias("key"), F.coalesce("stay", F.lit(False)).alias("stay"))
    return keep_rows(docs, marked, lambda df: df.withColumn("key", key(text_of())))
