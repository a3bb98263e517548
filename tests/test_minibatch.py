"""Gradients, sums in a tree, early stopping, accuracy held out."""

import numpy as np
from pyspark.sql import functions as F

from panelwright.operators import minibatch
from panelwright.operators.minibatch import Network


def table(spark, n=6000):
    rng = np.random.default_rng(0)
    x = rng.normal(size=(n, 4))
    y = (x[:, 0] * x[:, 1] > 0).astype(int) + (x[:, 2] > 1)
    return spark.createDataFrame([(i, [float(v) for v in a], int(c)) for i, (a, c) in enumerate(zip(x, y))],
                                 "id long, features array<double>, label int").repartition(4)


def test_gradient_matches_differences():
    rng = np.random.default_rng(1)
    net = Network.start([3, 5, 4, 3], 2)
    x, y = rng.normal(size=(7, 3)), rng.integers(0, 3, 7)
    got = np.concatenate([g.ravel() for g in net.gradient(x, y)[1]])
    flat, h = net.flat(), 1e-6
    for i in range(0, len(flat), 3):
        up, down = flat.copy(), flat.copy()
        up[i] += h
        down[i] -= h
        assert abs((net.filled(up).loss(x, y) - net.filled(down).loss(x, y)) / (2 * h) - got[i]) < 1e-4


def test_sums_do_not_depend_on_the_tree(spark, monkeypatch):
    net = Network.start([4, 6, 3], 3)
    d = table(spark, 500).select(F.col("features").alias("x"), F.col("label").alias("y"), (F.col("id") % 5 == 0).alias("held")).repartition(9)
    flat = minibatch._summed(d.mapInArrow(minibatch._gradients(net), minibatch.PARTIAL), 9)
    monkeypatch.setattr(minibatch, "FAN", 2)
    tree = minibatch._summed(d.mapInArrow(minibatch._gradients(net), minibatch.PARTIAL), 9)
    assert flat[1] == tree[1] == 400 and flat[3] == tree[3] == 100
    assert np.allclose(np.frombuffer(flat[5]), np.frombuffer(tree[5])) and np.isclose(flat[4], tree[4])
    rows = [r for r in d.where("not held").collect()]
    loss, grads = net.gradient(np.array([r.x for r in rows]), np.array([r.y for r in rows]))
    assert np.allclose(np.frombuffer(flat[5]), np.concatenate([g.ravel() for g in grads])) and np.isclose(flat[2], loss)


def test_fit_beats_the_majority_and_repeats(spark):
    d = table(spark)
    train, test = d.where("id % 4 > 0"), d.where("id % 4 = 0")
    made = minibatch.fit(train, ["id"], [4, 16, 16, 3], epochs=12, rate=0.02, batch_rows=1500)
    again = minibatch.fit(train, ["id"], [4, 16, 16, 3], epochs=12, rate=0.02, batch_rows=1500)
    assert np.allclose(made.network.flat(), again.network.flat()) and made.losses == again.losses
    assert min(made.losses) < 0.8 * made.losses[0]
    scored = made.score(test)
    assert scored.columns == [*test.columns, "prediction", "probability"]
    right, n = scored.agg(F.count_if(F.col("prediction") == F.col("label")), F.count(F.lit(1))).first()
    most = test.groupBy("label").count().agg(F.max("count")).first()[0]
    assert n == test.count() and right / n > most / n + 0.2


def test_empty_and_unlabelled_rows(spark):
    d = table(spark, 20).withColumn("label", F.lit(None).cast("int"))
    made = minibatch.fit(d, ["id"], [4, 5, 3])
    assert made.losses == [] and made.score(d).count() == 20
    assert made.score(d.where("false")).count() == 0
    gaps = d.withColumn("features", F.when(F.col("id") % 2 == 0, F.col("features")))
    assert {(r.id % 2, r.prediction is None, r.probability is None) for r in made.score(gaps).collect()} == {(0, False, False), (1, True, True)}
    assert minibatch.fit(gaps.withColumn("label", F.lit(1)), ["id"], [4, 5, 3], epochs=2).losses


def test_training_ends_without_improvement(spark):
    made = minibatch.fit(table(spark, 300), ["id"], [4, 5, 3], epochs=40, rate=1e-30, patience=2)
    assert len(made.losses) <= 40


def test_long_epochs_are_one_job_each(spark, monkeypatch):
    calls, summed = [], minibatch._summed
    monkeypatch.setattr(minibatch, "_summed", lambda *a: calls.append(1) or summed(*a))
    d = table(spark)
    train, test = d.where("id % 4 > 0"), d.where("id % 4 = 0")
    made = minibatch.fit(train, ["id"], [4, 16, 16, 3], epochs=10, rate=0.02, batch_rows=200)
    assert len(calls) == len(made.losses) <= 11
    again = minibatch.fit(train, ["id"], [4, 16, 16, 3], epochs=10, rate=0.02, batch_rows=200)
    assert np.allclose(made.network.flat(), again.network.flat()) and min(made.losses) < 0.8 * made.losses[0]
    right, n = made.score(test).agg(F.count_if(F.col("prediction") == F.col("label")), F.count(F.lit(1))).first()
    most = test.groupBy("label").count().agg(F.max("count")).first()[0]
    assert right / n > most / n + 0.2


def test_packed_blocks_hold_each_row_once(spark):
    rows = [(b, [float(b), float(i)], i) for b, size in ((-1, 5000), (0, 2048), (1, 1), (2, 3000)) for i in range(size)]
    d = spark.createDataFrame(rows, "batch int, x array<double>, y int").repartition(1).sortWithinPartitions("batch", "y")
    got = []
    for r in d.mapInArrow(minibatch._packed, "batch int, x binary, y binary").collect():
        x, y = np.frombuffer(r.x).reshape(-1, 2), np.frombuffer(r.y, "i4")
        assert len(x) == len(y) <= minibatch.BLOCK_ROWS and (x[:, 0] == r.batch).all() and (x[:, 1] == y).all()
        got += [(r.batch, int(i)) for i in y]
    assert got == [(b, i) for b, _, i in rows]


def test_long_epochs_keep_matrices_in_single_precision(spark, monkeypatch):
    """Half the bytes a block, and few of them at once; the losses stay close to those in double precision."""
    sizes, made = [], minibatch.materialize
    monkeypatch.setattr(minibatch, "materialize", lambda d: sizes.append(made(d)) or sizes[-1])
    d = table(spark, 3000)
    fitted = minibatch.fit(d, ["id"], [4, 16, 3], epochs=1, rate=0.02, batch_rows=200)
    blocks = sizes[0].selectExpr("length(x) AS x", "length(y) AS y").collect()
    assert sum(r.y for r in blocks) == 3000 * 4 and all(r.x == r.y * 4 for r in blocks)
    start = Network.start([4, 16, 3], 42)
    held = [r for r in d.where(F.pmod(minibatch.seeded_hash(["id"], 42), F.lit(5)) == 0).collect()]
    want = start.loss(np.array([r.features for r in held]), np.array([r.label for r in held])) / len(held)
    assert abs(fitted.losses[0] - want) < 1e-6


def test_a_network_uses_its_arrays_again_without_mixing_blocks():
    rng, net = np.random.default_rng(3), Network.start([3, 5, 4, 3], 1)
    for n in (9, 4, 12, 1):
        x, y = rng.normal(size=(n, 3)), rng.integers(0, 3, n)
        got, alone = net.gradient(x, y), Network.start([3, 5, 4, 3], 1).gradient(x, y)
        assert got[0] == alone[0] and all((a == b).all() for a, b in zip(got[1], alone[1]))
        assert net.single().gradient(x.astype("f4"), y)[1][1].dtype == np.dtype("f4")
