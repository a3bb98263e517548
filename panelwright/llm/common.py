"""Helpers shared by the text operators: tables in the shared folder, files of
an operator's own format, bounded Arrow batches, grouped streams.

Intermediate tables go to the folder that ``spark.checkpoint.dir`` names, so
a lost executor loses nothing that a later stage reads. Files are written
under a task-private name and renamed, so a retried or speculative task
leaves the same bytes under the same name.
"""

from __future__ import annotations

import ctypes
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyarrow import fs as pafs
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import scratch_path

# Documents per Arrow batch: a batch of average documents is a few MB, and a
# worker holds one batch at a time.
BATCH_ROWS = 1000
# Largest side (rows) that an operator broadcasts after counting it.
BROADCAST_ROWS = 200_000


def bounded_batches(spark: SparkSession, rows: int = BATCH_ROWS) -> None:
    """Bound the Arrow batches handed to Python workers by rows and bytes."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(16 << 20))


def shared_path(spark: SparkSession, name: str) -> str:
    """A new path below the shared checkpoint folder."""
    return scratch_path(spark, f"{name}-{uuid.uuid4().hex}")


def written(df: DataFrame, name: str) -> DataFrame:
    """Write a frame as Parquet in the shared folder and read it again: cuts
    the lineage where a result is used more than once."""
    spark = df.sparkSession
    path = shared_path(spark, name)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def small_side(df: DataFrame, rows: int, bound: int = BROADCAST_ROWS) -> DataFrame:
    """Broadcast a join side whose counted ``rows`` are within the bound; a
    larger one is left to a shuffle join."""
    return F.broadcast(df) if rows <= bound else df


def having(rows: DataFrame, counted: DataFrame, keys: list[str], hot_rows: int = 10_000) -> DataFrame:
    """Rows of ``rows`` whose keys are in ``counted`` (the keys and ``n``, the
    rows that have them). Keys of more than ``hot_rows`` rows and of more than
    a 100,000th of all, of which there are less than 100,000, are broadcast,
    so their rows stay where they are; the others meet in a shuffle join."""
    total = counted.agg(F.sum("n")).first()[0] or 0
    bound = max(hot_rows, total // 100_000)
    hot = counted.where(F.col("n") > bound).select(*keys)
    if hot.isEmpty():
        return rows.join(counted.select(*keys), keys, "left_semi")
    hot = F.broadcast(hot)
    rest = rows.join(hot, keys, "left_anti").join(counted.where(F.col("n") <= bound).select(*keys), keys, "left_semi")
    return rows.join(hot, keys, "left_semi").unionByName(rest)


def packed(docs: DataFrame) -> DataFrame:
    """(row, doc_id, text): every column of ``docs`` kept in ``row``, out of
    the way of an operator's own column names."""
    return docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"),
                       F.col("doc_id").cast("long").alias("doc_id"), F.col("text").alias("text"))


def keep_rows(docs: DataFrame, found: DataFrame, with_key) -> DataFrame:
    """Rows of ``docs``, all columns, that ``found`` (doc_id, key, stay) marks
    to stay. Ids none of whose rows stay go by id; where an id repeats and
    some of its rows stay, ``with_key`` adds their ``key`` and as many rows of
    each (doc_id, key) stay as are marked."""
    per = (found.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("stay").cast("long")).alias("s"))
           .where("s < n"))
    per = written(per, "rows-to-drop")
    n_gone, n_mixed = per.count(), per.where("s > 0").count()
    rows = packed(docs)
    gone = small_side(per.select(F.col("doc_id").alias("gone")), n_gone)
    out = rows.join(gone, rows["doc_id"].eqNullSafe(gone["gone"]), "left_anti").select("row")
    if n_mixed:
        some = small_side(per.where("s > 0").select(F.col("doc_id").alias("gone")), n_mixed)
        w = Window.partitionBy("doc_id", "key").orderBy("doc_id")
        stay = written(found.where("stay").groupBy("doc_id", "key").agg(F.count(F.lit(1)).alias("n"))
                       .select(F.col("doc_id").alias("d"), F.col("key").alias("k"), "n"), "rows-that-stay")
        most = stay.agg(F.max("n")).first()[0] or 0
        # a limit known in advance: every task passes on no more rows of a key
        mixed = (with_key(rows.join(some, rows["doc_id"].eqNullSafe(some["gone"]), "left_semi"))
                 .withColumn("at", F.row_number().over(w)).where(F.col("at") <= most))
        mixed = mixed.join(stay, mixed["doc_id"].eqNullSafe(stay["d"]) & (mixed["key"] == stay["k"])).where("at <= n")
        out = out.unionByName(mixed.select("row"))
    return out.select("row.*")


def text_of(col: str = "text") -> Column:
    return F.coalesce(F.col(col).cast("string"), F.lit(""))


def store(uri: str) -> tuple[pafs.FileSystem, str]:
    """File system and path of a URI in the shared folder."""
    if uri.startswith("file:"):
        return pafs.LocalFileSystem(), "/" + uri[5:].lstrip("/")
    if "://" not in uri:
        return pafs.LocalFileSystem(), uri
    return pafs.FileSystem.from_uri(uri)


def commit(files: pafs.FileSystem, tmp: str, path: str) -> None:
    files.move(tmp, path)


def tmp_name(path: str) -> str:
    return f"{path}.{uuid.uuid4().hex}.tmp"


_HOLDER: list[tuple] = []     # (owner, how to release what it holds)


def claim(owner: object, release) -> None:
    """Let one operator at a time hold tables in a worker, which outlives its
    tasks: ``release`` is called when another one claims it."""
    if _HOLDER and _HOLDER[0][0] is owner:
        return
    if _HOLDER:
        _HOLDER.pop()[1]()
    _HOLDER.append((owner, release))
    lean()


def lean() -> None:
    """Give freed memory back to the system: a Python worker lives as long as
    its executor and shares its memory with the JVM."""
    if pa.default_memory_pool().backend_name != "system":
        pa.set_memory_pool(pa.system_memory_pool())
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):
        pass  # not glibc


def columns(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    """Each non-empty batch as a dict of Arrow columns."""
    lean()
    for i, b in enumerate(batches):
        if b.num_rows:
            yield dict(zip(b.schema.names, b.columns))
        if i % 8 == 7:
            lean()
    lean()


def runs(batches: Iterator[pa.RecordBatch], key: str) -> Iterator[tuple[object, pa.Table]]:
    """(key, rows) for each run of equal, non-null ``key`` in sorted batches.

    The caller bounds the size of a run before shuffling by its key.
    """
    lean()
    held: list[pa.RecordBatch] = []
    at = None
    for b in batches:
        if not b.num_rows:
            continue
        k = b.column(b.schema.get_field_index(key)).to_numpy(zero_copy_only=False)
        cuts = np.flatnonzero(k[1:] != k[:-1]) + 1
        lo = 0
        for hi in [*cuts.tolist(), len(k)]:
            if held and k[lo] != at:
                yield at, pa.Table.from_batches(held)
                held = []
            at = k[lo]
            held.append(b.slice(lo, hi - lo))
            lo = hi
    if held:
        yield at, pa.Table.from_batches(held)
    held = []
    lean()


def forest(a: np.ndarray, b: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """A spanning set of the local links (a[i], b[i]) among nodes 0..n-1:
    (node, smallest node of its local component) where they differ."""
    label = np.arange(n)
    while True:
        low = np.minimum(label[a], label[b])
        new = label.copy()
        np.minimum.at(new, label[a], low)
        np.minimum.at(new, label[b], low)
        new = new[new]
        while (again := new[new]).tobytes() != new.tobytes():
            new = again
        if (new[a] == new[b]).all():
            break
        label = new
    moved = np.flatnonzero(new != np.arange(n))
    return moved, new[moved]
