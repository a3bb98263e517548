"""Embedding near-duplicates by collision counting over 1-D projections.

Unit vectors whose cosine is the threshold lie ``d = sqrt(2 - 2 cos)`` apart,
and a Gaussian projection sets them apart by a normal deviate of that scale.
Every vector gets ``PROJECTIONS`` projections; each one is sorted, and a
query's collisions are the vectors within a window centred on it. A pair is
verified by its exact cosine in double precision if it misses at most
``MISSES`` windows; the window's width is calibrated so that a pair at the
threshold does so with the wanted recall (pairs above it do so more often).

Equal vectors are taken once. The distinct ones are written as tiles, ordered
by projections, and a task takes pairs of tiles; pairs too far apart in a
projection are skipped. Within a pair, windows are ranges of the sorted
ranks, held as bit sets, so a miss is counted for 64 pairs at once. Links
leave a task as counts per vector and a spanning forest, never as all pairs.

Rows: null, zero, empty vectors and those with a null or non-finite component
link with nothing; vectors of different lengths do not link; repeated rows
link with each other; a null ``vec_id`` links but never names a component.
An empty table gives an empty result.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import bounded_batches, columns, forest, shared_path, store, written
from .graph import components

PROJECTIONS = 24
MISSES = 2
RECALL = 0.998
TILE = 4096
SEED = 20240229
RANKS = 64                  # ranks that share a bit-set row
FAR = 4.0                   # tiles further apart than so many deviations are skipped


def directions(dim: int, n: int = PROJECTIONS) -> np.ndarray:
    return np.random.default_rng([SEED, dim]).standard_normal((dim, n))


def window(threshold: float, n: int = PROJECTIONS, misses: int = MISSES, recall: float = RECALL) -> float:
    """Half-width at which a pair at the threshold misses at most ``misses``
    of ``n`` windows with probability ``recall``."""
    d = math.sqrt(max(0.0, 2 - 2 * threshold))
    lo, hi = 0.0, 10.0
    for _ in range(60):
        z = (lo + hi) / 2
        q = math.erfc(z / math.sqrt(2))
        got = sum(math.comb(n, i) * q ** i * (1 - q) ** (n - i) for i in range(misses + 1))
        lo, hi = (z, hi) if got < recall else (lo, z)
    return hi * d


class Tile:
    """Unit vectors, projections and, for each projection, the bit sets of the
    first ``RANKS * i`` vectors in its order."""

    def __init__(self, nodes: np.ndarray, weights: np.ndarray, x: np.ndarray, p: np.ndarray):
        self.nodes, self.weights, self.x, self.p = nodes, weights, x, p
        self._sets = None

    def sets(self):
        if self._sets is None:
            n = len(self.nodes)
            wide = -(-n // 64) * 64
            rows = -(-n // RANKS) + 1
            self._sets = []
            for j in range(self.p.shape[1]):
                order = np.argsort(self.p[:, j], kind="stable")
                bits = np.zeros((rows, wide), bool)
                bits[np.arange(n) // RANKS + 1, order] = True
                bits = np.logical_or.accumulate(bits, axis=0)
                self._sets.append((self.p[order, j], np.packbits(bits, axis=1, bitorder="little").view(np.uint64)))
        return self._sets


def candidates(q: np.ndarray, tile: Tile, w: float, misses: int) -> np.ndarray:
    """(len(q), n) bool: vectors of the tile that miss at most ``misses``
    windows centred on the queries' projections ``q``."""
    n = len(tile.nodes)
    missed: list[np.ndarray] = []
    for j, (values, sets) in enumerate(tile.sets()):
        lo = np.searchsorted(values, q[:, j] - w, "left") // RANKS
        hi = -(-np.searchsorted(values, q[:, j] + w, "right") // RANKS)
        out = ~(sets[hi] & ~sets[lo])
        if not missed:
            missed = [np.zeros_like(out) for _ in range(misses + 1)]
        for i in range(misses, 0, -1):
            missed[i] |= missed[i - 1] & out
        missed[0] |= out
    kept = ~missed[misses]
    return np.unpackbits(kept.view(np.uint8), axis=1, bitorder="little")[:, :n].astype(bool)


def match(a: Tile, b: Tile, same: bool, threshold: float, w: float, misses: int):
    """(x, y) of the linked pairs between two tiles, block by block."""
    for lo in range(0, len(a.nodes), 1024):
        q = a.p[lo:lo + 1024]
        maybe = candidates(q, b, w, misses)
        if same:
            maybe &= np.arange(lo, lo + len(q))[:, None] < np.arange(len(b.nodes))[None, :]
        x, y = np.nonzero(maybe)
        if len(x) > maybe.size // 16:
            cos = a.x[lo:lo + 1024] @ b.x.T
            x, y = np.nonzero(maybe & (cos >= threshold))
        else:
            ok = [np.zeros(0, bool)]
            for s in range(0, len(x), 16384):
                ok.append(np.einsum("ij,ij->i", a.x[lo + x[s:s + 16384]], b.x[y[s:s + 16384]]) >= threshold)
            ok = np.concatenate(ok)
            x, y = x[ok], y[ok]
        if len(x):
            yield x + lo, y


def _load(file: str) -> Tile:
    files, path = store(file)
    with files.open_input_file(path) as f:
        t = pq.ParquetFile(f).read()
    dim = len(t["vec"][0])
    x = np.asarray(t["vec"].combine_chunks().flatten(), np.float64).reshape(-1, dim)
    return Tile(t["node"].to_numpy(), t["n"].to_numpy(), x, x @ directions(dim))


def _pairs(threshold: float, w: float, misses: int):
    def make(batches):
        held: dict[str, Tile] = {}

        def tile(name):
            if name not in held:
                while len(held) >= 6:
                    held.pop(next(iter(held)))
                held[name] = _load(name)
            return held[name]
        for b in columns(batches):
            for fa, fb in zip(b["file_a"].to_pylist(), b["file_b"].to_pylist()):
                s, t = tile(fa), tile(fb)
                same = fa == fb
                ca, cb = np.zeros(len(s.nodes), np.int64), np.zeros(len(t.nodes), np.int64)
                u = v = np.zeros(0, np.int64)
                shift = 0 if same else len(s.nodes)
                nodes = s.nodes if same else np.concatenate([s.nodes, t.nodes])
                for x, y in match(s, t, same, threshold, w, misses):
                    ca += np.bincount(x, weights=t.weights[y], minlength=len(ca)).astype(np.int64)
                    cb += np.bincount(y, weights=s.weights[x], minlength=len(cb)).astype(np.int64)
                    u, v = forest(np.concatenate([u, x]), np.concatenate([v, y + shift]), len(nodes))
                for n, c in ((s.nodes, ca), (t.nodes, cb)):
                    if (hit := np.flatnonzero(c)).size:
                        yield _rows(n[hit], None, c[hit])
                if len(u):
                    yield _rows(nodes[u], nodes[v], None)
    return make


def _rows(u, v, n):
    none = pa.nulls(len(u), pa.int64())
    return pa.RecordBatch.from_arrays([pa.array(u, pa.int64()), none if v is None else pa.array(v, pa.int64()),
                                       none if n is None else pa.array(n, pa.int64())], names=["u", "v", "n"])


def near_duplicates(vectors: DataFrame, threshold: float = 0.95, tile_rows: int = TILE, misses: int = MISSES) -> DataFrame:
    """(vec_id, n_links, component_id) per row of ``vectors`` (vec_id, embedding)."""
    spark = vectors.sparkSession
    bounded_batches(spark, 4096)
    w = window(threshold, misses=misses)
    far = FAR * math.sqrt(max(0.0, 2 - 2 * threshold))
    src = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("vec"))
    finite = F.forall("vec", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < F.lit(float("inf"))))
    some = F.exists("vec", lambda c: c != 0)
    src = src.withColumn("vec", F.when(F.coalesce(finite & some, F.lit(False)), F.col("vec")))
    rows = written(src, "vectors")
    same = rows.where("vec is not null").groupBy("vec").agg(F.count(F.lit(1)).alias("n"), F.min("vec_id").alias("lead"))

    def unit(batches):
        for b in columns(batches):
            vec, key = b["vec"].to_pylist(), []
            out = []
            for x in vec:
                x = np.array(x)
                x = x / np.abs(x).max()              # no overflow of the norm
                x = x / np.linalg.norm(x)
                out.append(x)
                p = x @ directions_of(len(x))
                key.append([float(len(x)), *p[:3].tolist()])
            yield pa.RecordBatch.from_arrays([pa.array([x.tolist() for x in out], pa.list_(pa.float64())), b["vec"], b["n"], b["lead"],
                                              pa.array(key, pa.list_(pa.float64()))], names=["unit", "raw", "n", "lead", "key"])
    known: dict[int, np.ndarray] = {}

    def directions_of(dim):
        if dim not in known:
            known[dim] = directions(dim)
        return known[dim]
    points = written(same.mapInArrow(unit, "unit array<double>, raw array<double>, n long, lead long, key array<double>"), "distinct-vectors")
    total = points.count()
    tiles = max(1, -(-total // tile_rows))
    # order of the tiles: the first projection, within bins of two others once
    # there are many tiles; lengths never share a tile by more than its edge
    bins = min(8, max(1, int((tiles / 16) ** 0.5)))
    binned = [F.floor(F.least(F.lit(bins - 1), F.greatest(F.lit(0.0), (F.col("key")[i] + 2) * bins / 4))) for i in (2, 3)]
    ordered = points.select(F.col("key")[0].alias("dim"), *[b.alias(f"bin{i}") for i, b in enumerate(binned)],
                            F.col("key")[1].alias("p"), F.col("unit").alias("vec"), "raw", "n", "lead",
                            F.struct(F.col("key")[1].alias("a"), F.col("key")[2].alias("b"), F.col("key")[3].alias("c")).alias("k"))
    ordered = (ordered.repartitionByRange(tiles, "dim", "bin0", "bin1", "p").withColumn("node", F.monotonically_increasing_id()))
    path = shared_path(spark, "vector-tiles")
    ordered.write.partitionBy("dim").option("compression", "zstd").parquet(path)
    tiled = spark.read.schema(ordered.schema).parquet(path).withColumn("file", F.input_file_name())
    box = [f(F.col(f"k.{c}")).alias(f"{n}_{c}") for c in "abc" for f, n in ((F.min, "lo"), (F.max, "hi"))]
    meta = written(tiled.groupBy("dim", "file").agg(*box), "tile-boxes")
    # pairs of tiles that meet in a slab of the first projection, once each
    slab = lambda lo, hi: F.explode(F.sequence(F.floor(lo / F.lit(far)), F.floor(hi / F.lit(far))))
    a = meta.select("dim", F.col("file").alias("file_a"), *[F.col(c).alias(f"a_{c}") for c in meta.columns[2:]],
                    slab(F.col("lo_a"), F.col("hi_a")).alias("slab"))
    b = meta.select("dim", F.col("file").alias("file_b"), *[F.col(c).alias(f"b_{c}") for c in meta.columns[2:]],
                    slab(F.col("lo_a") - far, F.col("hi_a") + far).alias("slab"))
    near = F.lit(True)
    for c in "abc":
        near = near & (F.col(f"a_lo_{c}") - F.col(f"b_hi_{c}") <= far) & (F.col(f"b_lo_{c}") - F.col(f"a_hi_{c}") <= far)
    pairs = a.join(b, ["dim", "slab"]).where("file_a <= file_b").where(near).select("file_a", "file_b").distinct()
    units = max(1, min(4 * tiles, 10_000))
    dealt = pairs.repartitionByRange(units, "file_a", "file_b").sortWithinPartitions("file_a", "file_b")
    found = written(dealt.mapInArrow(_pairs(threshold, w, misses), "u long, v long, n long"), "vector-links")

    counts = found.where("n is not null").groupBy(F.col("u").alias("node")).agg(F.sum("n").alias("links"))
    stars = components(found.where("v is not null").select("u", "v"))
    rooted = (tiled.select("node", "raw", "n", "lead").join(counts, "node", "left").join(stars, "node", "left")
              .withColumn("root", F.coalesce("root", "node")))
    rooted = written(rooted, "rooted-vectors")
    ids = rooted.groupBy("root").agg(F.min("lead").alias("component_id"))
    per = rooted.join(ids, "root").select(F.col("raw").alias("vec"), (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("n_links"), "component_id")
    out = rows.where("vec is not null").join(per, "vec").select("vec_id", "n_links", "component_id")
    alone = rows.where("vec is null").select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return out.unionByName(alone)
