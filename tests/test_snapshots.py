"""A scope removes what was written in it, and nothing else."""

import os

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from panelwright.session import Snapshots, bucketed, ensure_checkpoint_dir, materialize, stored

from .conftest import SF_SMALL


def files(spark):
    base = ensure_checkpoint_dir(spark).removeprefix("file:")
    return {os.path.join(at, n) for at, _, names in os.walk(base) for n in names}


def tables(spark):
    return {t.name for t in spark.catalog.listTables()}


def test_scope_owns_tables_checkpoints_and_catalog_names(spark):
    before, names = files(spark), tables(spark)
    df = spark.range(100).withColumn("k", F.col("id") % 7)
    outside = stored(df, "outside")
    kept = files(spark) - before
    with Snapshots(spark) as snaps:
        snap = snaps.keep(df.withColumn("r", F.rand(3)))
        assert snap.collect() == snap.collect()         # as it was when it was taken
        spread = materialize(df, ["k"])
        assert "Exchange" not in spread.groupBy("k").count()._jdf.queryExecution().executedPlan().toString()
        assert bucketed(df, "b", ["k"], ["id"]).count() == materialize(df).count() == 100
        with Snapshots(spark) as inner:
            stored(df, "inner")
            assert len(inner.paths) == 1
        assert len(snaps.paths) == 4 and len(snaps.tables) == 1 and len(files(spark)) > len(before | kept)
    assert files(spark) == before | kept and tables(spark) == names
    assert outside.count() == 100


def test_scope_removes_after_an_error(spark):
    before = files(spark)
    with pytest.raises(RuntimeError), Snapshots(spark) as snaps:
        snaps.keep(spark.range(10))
        raise RuntimeError
    assert files(spark) == before


@pytest.mark.parametrize("name", ["q_robust_null", "q_fences", "q_credit_panel", "q_sample_groups"])
def test_nothing_is_left_of_a_query(spark, name):
    for _ in range(2):      # a later scope does not meet tables of an earlier one
        before, names = files(spark), tables(spark)
        with Snapshots(spark):
            assert entry.queries()[name](spark, SF_SMALL).count() > 0
        assert files(spark) == before and tables(spark) == names
    assert not spark.sparkContext._jsc.getPersistentRDDs()
