"""Session helpers: a configured SparkSession and lineage cuts.

Nothing here starts a job at import time.
"""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

# Settings that matter at scale. AQE re-plans joins from runtime sizes (a
# small side becomes a broadcast only when it measures small) and splits
# skewed shuffle partitions of a join; coalescing keeps tiny stages cheap.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}

# Runtime SQL settings applied to any session the library runs in. Wide
# row-local projections (28 repaired columns) fuse into one generated method
# that can exceed the JIT's huge-method limit and then runs interpreted (4x
# slower here); with this limit Spark falls back to per-operator code instead.
RUNTIME_CONF = {
    "spark.sql.codegen.hugeMethodLimit": "8000",
}


def tune(spark: SparkSession) -> SparkSession:
    """Apply :data:`RUNTIME_CONF` to a session (no-op when already set)."""
    for k, v in RUNTIME_CONF.items():
        if spark.conf.get(k, None) != v:
            spark.conf.set(k, v)
    return spark


@contextmanager
def settings(spark: SparkSession, values: dict[str, str]) -> Iterator[None]:
    """SQL settings that hold for the jobs run inside, and no longer."""
    before = {k: spark.conf.get(k, None) for k in values}
    for k, v in values.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def get_session(master: str | None = None, shuffle_partitions: int | None = None,
                app_name: str = "panelwright", extra: dict | None = None) -> SparkSession:
    """Build (or reuse) a session with the library's defaults.

    On a cluster pass ``master=None`` and let spark-submit decide; the shuffle
    partition count should then be sized so one partition is ~128-256 MB.
    """
    b = SparkSession.builder.appName(app_name)
    if master:
        b = b.master(master)
    for k, v in {**DEFAULT_CONF, **RUNTIME_CONF}.items():
        b = b.config(k, v)
    if shuffle_partitions:
        b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in (extra or {}).items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by the cluster.

    The folder comes from ``spark.checkpoint.dir`` (or one already set on the
    context). Only a local-mode session without either gets a scratch folder
    (tests); a cluster session without a shared folder is an error, never a
    machine-local directory.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    conf_dir = spark.conf.get("spark.checkpoint.dir", None)
    if not conf_dir:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
        conf_dir = tempfile.mkdtemp(prefix="panelwright-ckpt-")
    sc.setCheckpointDir(conf_dir)
    return sc.getCheckpointDir() or conf_dir


_SCOPE: ContextVar["Snapshots | None"] = ContextVar("snapshots", default=None)


class Snapshots:
    """A scope that owns what is written below the shared folder while it
    is open, and removes it at its end, also after an error.

        with Snapshots(spark) as snaps:
            before = snaps.keep(panel)          # a snapshot for later reuse
            clean = credit_panel.clean(panel)   # its own tables belong to the scope too
            clean.write.parquet(target)         # results are read inside the scope

    Owned are snapshots, the operators' intermediate tables (with the catalog
    names of bucketed ones) and checkpoints. Scopes nest; a table belongs to
    the innermost one. Without a scope everything stays until the cluster
    cleans the folder.
    """

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self.paths: list[str] = []
        self.tables: list[str] = []

    def __enter__(self) -> "Snapshots":
        self._token = _SCOPE.set(self)
        return self

    def __exit__(self, *failure) -> None:
        _SCOPE.reset(self._token)
        self.close()

    def keep(self, df: DataFrame, name: str = "snapshot") -> DataFrame:
        """``df`` as it is now, written once in columns."""
        outer = _SCOPE.set(self)
        try:
            return stored(df, name)
        finally:
            _SCOPE.reset(outer)

    def close(self) -> None:
        """Remove all that the scope owns; what is gone already is no error."""
        while self.tables:
            self.spark.sql(f"DROP TABLE IF EXISTS `{self.tables.pop()}`")
        sc = self.spark.sparkContext
        conf = sc._jsc.hadoopConfiguration()
        while self.paths:
            path = sc._jvm.org.apache.hadoop.fs.Path(self.paths.pop())
            path.getFileSystem(conf).delete(path, True)


def materialize(df: DataFrame, partition_by: list[str] | None = None,
                num_partitions: int | None = None, order: list[str] | None = None) -> DataFrame:
    """Cut lineage with a reliable checkpoint in the shared checkpoint folder.

    Used where a DataFrame feeds several dependent global scalars, so the
    upstream plan is neither recomputed nor re-planned per scalar. Survives
    executor loss (unlike a local checkpoint, which is never used here). No
    frame is persisted on the executors' disks.

    With ``partition_by`` the rows are hash-partitioned first and the
    checkpoint keeps that partitioning, so later windows, aggregates and
    joins on those keys need no exchange. The partitioning is only recorded
    when the plan is final at checkpoint time, so adaptive execution is
    paused for this one step. A checkpoint runs its plan twice; the second run
    starts at the exchange, whose files are there. Where the plan ahead of an
    unpartitioned frame is costly, use :func:`stored`, which runs it once.

    With ``order`` too the frame, already dealt by the keys, is kept in
    columns instead (:func:`bucketed`): its plan runs once, and later jobs
    read only the columns they need.
    """
    spark = df.sparkSession
    if order is not None:
        return bucketed(df, "panel", partition_by, order)
    ensure_checkpoint_dir(spark)
    aqe = spark.conf.get("spark.sql.adaptive.enabled")
    if partition_by:
        n = num_partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
        df = df.repartition(n, *partition_by)
        spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        out = df.checkpoint(eager=True)
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", aqe)
    if scope := _SCOPE.get():
        path = out._jdf.queryExecution().logical().rdd().getCheckpointFile()
        if path.isDefined():
            scope.paths.append(path.get())
    return out


def scratch_path(spark: SparkSession, name: str) -> str:
    """A folder under the shared checkpoint location for intermediate tables."""
    path = os.path.join(ensure_checkpoint_dir(spark), "tables", name)
    if scope := _SCOPE.get():
        scope.paths.append(path)
    return path


def stored(df: DataFrame, name: str, **options: str) -> DataFrame:
    """Write a frame as Parquet below the shared checkpoint folder and read it
    again: a columnar lineage cut, of which later jobs read only the columns
    they need. ``options`` are the writer's."""
    path = scratch_path(df.sparkSession, f"{name}-{uuid.uuid4().hex}")
    df.write.options(compression="zstd", **options).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def bucketed(df: DataFrame, name: str, keys: list[str], order: list[str] = ()) -> DataFrame:
    """Write a frame below the shared checkpoint folder as a table bucketed by
    ``keys`` and sorted by ``keys`` and ``order``, and read it again.

    Windows, aggregates and joins on the keys need no exchange on what is
    read, and a later job reads only the columns it needs. A frame that is
    already dealt by the keys is written as it lies; every bucket is then one
    file."""
    spark = df.sparkSession
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    own = f"{name}_{uuid.uuid4().hex}".replace("-", "_")
    (df.write.format("parquet").option("compression", "zstd").option("path", scratch_path(spark, own))
     .bucketBy(n, *keys).sortBy(*keys, *[c for c in order if c in df.columns and c not in keys]).saveAsTable(own))
    if scope := _SCOPE.get():
        scope.tables.append(own)
    return spark.table(own)


def fresh(df: DataFrame, *names: str) -> list[str]:
    """Column names made of ``names`` that the frame does not have yet."""
    have = {c.lower() for c in df.columns}
    out = []
    for n in names:
        while n.lower() in have:
            n += "_"
        have.add(n.lower())
        out.append(n)
    return out
