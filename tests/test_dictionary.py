"""Distributed dictionary and bottom-k samples at sizes where they are dealt out."""

import re

import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from panelwright.operators import dictionary, sampling


def test_indices_follow_the_order_of_many_values(spark):
    df = spark.range(300_000).select(F.md5(F.pmod("id", F.lit(120_000)).cast("string").cast("binary")).alias("c"))
    words = dictionary.dictionary(df, "c")
    got = words.orderBy("value").collect()
    assert [r.idx for r in got] == list(range(120_000))
    out = dictionary.label_index(df, "c", "i").select("c", "i")
    assert out.count() == 300_000 and out.where("i is null").count() == 0 and out.distinct().count() == 120_000


def test_unknown_and_null_values_are_all_zeros(spark):
    known = spark.createDataFrame([("b",), ("a",), (None,), ("a",), ("é",)], "c string")
    words = dictionary.dictionary(known, "c")
    df = spark.createDataFrame([(1, "a"), (2, "b"), (3, None), (4, "z"), (5, "é")], "_slot int, c string")
    rows = dictionary.onehot_vector(df, "c", "v", words).withColumn("v", vector_to_array("v")).collect()
    assert {r["_slot"]: r["v"] for r in rows} == {1: [1, 0, 0], 2: [0, 1, 0], 3: [0, 0, 0], 4: [0, 0, 0], 5: [0, 0, 1]}
    assert {r["_slot"]: r["_value"] for r in dictionary.label_index(df, "c", "_value", words).collect()} == {1: 0, 2: 1, 3: None, 4: None, 5: 2}
    cols = dictionary.onehot_columns(known, "c", "p")
    assert cols.columns == ["c", "p_a", "p_b", "p_é"] and cols.where("p_a = 1").count() == 2
    empty = known.limit(0)
    assert dictionary.dictionary(empty, "c").count() == 0 and dictionary.label_index(empty, "c", "i").count() == 0


def test_sparse_vectors_of_many_values(spark):
    df = spark.range(50_000).select(F.col("id").cast("string").alias("c"))
    one = dictionary.onehot_vector(df, "c", "v").select("v").first()["v"]
    assert one.size == 50_000 and len(one.indices) == 1


def test_too_many_indicator_columns_is_an_error(spark):
    with pytest.raises(ValueError, match="onehot_vector"):
        dictionary.onehot_columns(spark.range(20_000).select(F.col("id").cast("string").alias("c")), "c")


@pytest.mark.parametrize("k, finish", [(0, 10), (1, 1), (5, 1), (777, 3), (19_999, 50), (20_000, 50), (50_000, 50)])
def test_bottom_k_equals_the_ordered_list(spark, k, finish):
    keys = spark.range(20_000).select((F.col("id") * 7).alias("g"), F.lit("x").alias("_h"))
    got = {r.g for r in sampling.bottom_k(keys, k, 41, finish).collect()}
    order = keys.withColumn("w", sampling.seeded_hash(["g", "_h"], 41)).orderBy("w", "g").limit(k).collect()
    assert got == {r.g for r in order} and len(got) == min(k, 20_000)


def test_no_large_limit_in_the_plan(spark):
    keys = spark.range(200_000).select(F.col("id").alias("g"))
    plan = sampling.bottom_k(keys, 150_000, 41, finish=1000)._jdf.queryExecution().optimizedPlan().toString()
    taken = [int(x) for x in re.findall(r"LocalLimit (\d+)", plan)]
    assert taken and all(n <= 1000 for n in taken)
