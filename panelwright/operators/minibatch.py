"""L7, L8 by mini-batches: the classifier trained with Adam, a validation
share and early stopping, which Spark ML's L-BFGS perceptron does not have.

The rows are written once below the shared folder, dealt to batches by a hash
of their key, and a validation share apart. A step is one job over one
batch: tasks go through Arrow blocks and give the sum of their rows'
gradients, the sums are added in a tree of at most ``FAN`` a node, and the
driver, which holds the weights (bounded by the layers, not by the data),
takes the Adam step. The first job of an epoch also measures the validation
loss of the weights so far; without an improvement the rate is halved, then
training ends, and the best weights are kept.

An epoch of more than ``STEPWISE`` batches is one job instead, so that the
number of jobs does not grow with the rows: every batch is dealt over
``WORKERS`` partitions, each goes through its shares of all batches by its own
Adam steps, and the weights and moments reached are averaged by rows at the
end of the epoch (local steps, averaged). Steps, batches, epochs, validation
and stopping are the same. Its matrices are kept and multiplied in single
precision; losses, sums, weights, moments and steps stay in double precision.

Hidden units are rectified linear, the output is a softmax. Rows without a
label or without features teach nothing, the latter have no prediction; an empty
table gives the starting weights. Sums are
added in a fixed order, so two runs over the same rows agree.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import materialize, scratch_path, settings
from .sampling import seeded_hash

BATCH_ROWS = 32_768     # rows of a step
BLOCK_ROWS = 2_048      # rows of one matrix product
SLICES = 8              # files, and so tasks, of a batch at least
STEPWISE = 8            # batches of an epoch up to which a step is a job
WORKERS = 24            # partitions, and so tasks, of an epoch that is one job
FAN = 64                # partial sums added by one task, or by the driver
# Bytes of matrices that go to Python at once.
PIECES = {"spark.sql.execution.arrow.maxBytesPerBatch": "8m"}
PARTIAL = "part int, n long, loss double, held_n long, held_loss double, grad binary"


@dataclass
class Network:
    """Weights and biases of each layer."""
    weights: list[np.ndarray]
    held: dict = field(default_factory=dict, repr=False, compare=False)     # arrays used again from block to block

    @classmethod
    def start(cls, layers: list[int], seed: int) -> "Network":
        rng = np.random.default_rng(seed)
        out = []
        for a, b in zip(layers, layers[1:]):
            out += [rng.normal(0, (2 / max(1, a)) ** 0.5, (a, b)), np.zeros(b)]
        return cls(out)

    def _room(self, name: tuple, rows: int, like: np.ndarray) -> np.ndarray:
        if len(self.held.get(name, ())) < rows:
            self.held[name] = np.empty((rows, like.shape[-1]), like.dtype)
        return self.held[name][:rows]

    def forward(self, x: np.ndarray) -> list[np.ndarray]:
        """The input, each hidden layer's output, the class probabilities."""
        out = [x]
        for i in range(0, len(self.weights) - 2, 2):
            z = np.matmul(out[-1], self.weights[i], out=self._room(("out", i), len(x), self.weights[i + 1]))
            z += self.weights[i + 1]
            out.append(np.maximum(z, 0, out=z))
        z = (out[-1] @ self.weights[-2] + self.weights[-1]).astype(float, copy=False)
        e = np.exp(z - z.max(axis=1, keepdims=True))
        return [*out, e / e.sum(axis=1, keepdims=True)]

    def loss(self, x: np.ndarray, y: np.ndarray) -> float:
        return float(-np.log(np.maximum(self.forward(x)[-1][np.arange(len(y)), y], 1e-15)).sum())

    def gradient(self, x: np.ndarray, y: np.ndarray) -> tuple[float, list[np.ndarray]]:
        """Summed loss and its gradient, in the order of ``weights``."""
        out = self.forward(x)
        at = np.arange(len(y))
        loss = float(-np.log(np.maximum(out[-1][at, y], 1e-15)).sum())
        delta = out[-1].copy()
        delta[at, y] -= 1
        delta = delta.astype(x.dtype, copy=False)
        grads: list[np.ndarray] = []
        for i in range(len(self.weights) - 2, -1, -2):
            grads += [delta.sum(axis=0), out[i // 2].T @ delta]
            if i:
                delta = np.matmul(delta, self.weights[i].T, out=self._room(("delta", i), len(x), self.weights[i - 1]))
                delta *= out[i // 2] > 0
        return loss, grads[::-1]

    def single(self) -> "Network":
        """The same weights in single precision."""
        return Network([w.astype("f4") for w in self.weights])

    def flat(self) -> np.ndarray:
        return np.concatenate([w.ravel() for w in self.weights])

    def filled(self, flat: np.ndarray) -> "Network":
        cuts = np.cumsum([w.size for w in self.weights])[:-1]
        return Network([p.reshape(w.shape) for p, w in zip(np.split(flat, cuts), self.weights)])


def _matrix(lists: pa.Array, rows: int) -> np.ndarray:
    return lists.flatten().to_numpy(zero_copy_only=False).reshape(rows, -1)


def _blocks(batches: Iterator[pa.RecordBatch], *names: str) -> Iterator[tuple]:
    for b in batches:
        for lo in range(0, b.num_rows, BLOCK_ROWS):
            part = b.slice(lo, BLOCK_ROWS)
            yield _matrix(part.column("x"), part.num_rows), *[part.column(n).to_numpy(zero_copy_only=False) for n in names]


def _gradients(net: Network):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        n = held_n = 0
        loss = held_loss = 0.0
        total = np.zeros(sum(w.size for w in net.weights))
        for x, y, held in _blocks(batches, "y", "held"):
            held = held.astype(bool)
            if held.any():
                held_n += int(held.sum())
                held_loss += net.loss(x[held], y[held])
            if not held.all():
                part, grads = net.gradient(x[~held], y[~held])
                n, loss = n + int((~held).sum()), loss + part
                total += np.concatenate([g.ravel() for g in grads])
        yield _partial([(TaskContext.get().partitionId(), n, loss, held_n, held_loss, total.tobytes())])
    return run


def _partial(rows: list[tuple]) -> pa.RecordBatch:
    types = [pa.int32(), pa.int64(), pa.float64(), pa.int64(), pa.float64(), pa.binary()]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)],
                                      names=["part", "n", "loss", "held_n", "held_loss", "grad"])


def _added(rows: list) -> tuple:
    """Partial sums added in the order of their parts."""
    rows = sorted(rows, key=lambda r: r[0])
    return (rows[0][0], *[sum(r[i] for r in rows) for i in (1, 2, 3, 4)],
            np.sum([np.frombuffer(r[5]) for r in rows], axis=0).tobytes())


def _summed(parts: DataFrame, n: int) -> tuple | None:
    """Partial sums of ``n`` tasks added level by level, ``FAN`` at a time."""
    while n > FAN:
        n = -(-n // FAN)

        def add(key, table):
            rows = list(zip(*[c.to_pylist() for c in table.columns]))
            return pa.Table.from_batches([_partial([(key[0].as_py(), *_added(rows)[1:])])])
        # the parts of a node differ, so a node adds at most FAN of them
        parts = parts.groupBy(F.floor(F.col("part") / FAN).cast("int").alias("node")).applyInArrow(add, PARTIAL)
    rows = list(zip(*[c.to_pylist() for c in parts.toArrow().columns]))      # at most FAN
    return _added(rows) if rows else None


@dataclass
class Fitted:
    network: Network
    losses: list[float]         # validation loss after each epoch, the start first

    def score(self, df: DataFrame, features: str = "features") -> DataFrame:
        """``df`` with ``prediction`` (class index) and ``probability`` (an
        array); ``features`` is an array of doubles."""
        net, names = self.network, df.columns
        schema = T.StructType([*df.schema.fields, T.StructField("prediction", T.DoubleType()),
                               T.StructField("probability", T.ArrayType(T.DoubleType()))])

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                for lo in range(0, b.num_rows, BLOCK_ROWS):
                    part = b.slice(lo, BLOCK_ROWS)
                    x = part.column(features)
                    there = np.flatnonzero(x.is_valid().to_numpy(zero_copy_only=False))
                    found: list = [None] * part.num_rows
                    if len(there):
                        for i, p in zip(there.tolist(), net.forward(_matrix(x, len(there)))[-1].tolist()):
                            found[i] = p
                    top = [None if p is None else float(np.argmax(p)) for p in found]
                    yield pa.RecordBatch.from_arrays([*part.columns, pa.array(top, pa.float64()), pa.array(found, pa.list_(pa.float64()))],
                                                     names=[*names, "prediction", "probability"])
        return df.mapInArrow(run, schema)


def _packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows in the order of their batch as matrices: at most ``BLOCK_ROWS``
    rows of one batch each."""
    at, held = None, []

    def block() -> pa.RecordBatch:
        x, y = (np.concatenate(c) for c in zip(*held))
        return pa.RecordBatch.from_arrays([pa.array([at], pa.int32()), pa.array([x.tobytes()], pa.binary()),
                                           pa.array([y.astype("i4").tobytes()], pa.binary())], names=["batch", "x", "y"])
    for b in batches:
        ids, y = (b.column(c).to_numpy(zero_copy_only=False) for c in ("batch", "y"))
        x = _matrix(b.column("x"), b.num_rows) if b.num_rows else None
        lo = 0
        while lo < b.num_rows:
            if held and (at != ids[lo] or sum(len(p) for _, p in held) == BLOCK_ROWS):
                yield block()
                held = []
            at = int(ids[lo])
            hi = min(int(np.searchsorted(ids, at, "right")), lo + BLOCK_ROWS - sum(len(p) for _, p in held))
            held.append((x[lo:hi], y[lo:hi]))
            lo = hi
    if held:
        yield block()


def _adam(flat: np.ndarray, m: np.ndarray, v: np.ndarray, t: int, g: np.ndarray, rate: float) -> tuple:
    m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
    return flat - rate * (m / (1 - 0.9 ** t)) / (np.sqrt(v / (1 - 0.999 ** t)) + 1e-8), m, v


def _local_steps(start: Network, m: np.ndarray, v: np.ndarray, t: int, rate: float):
    """A worker's epoch: the validation loss of the weights so far, then a step
    for its share of each batch; the state reached, weighted by its rows."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        first = net = start.single()
        state, step = (start.flat(), m, v), t
        n = held_n = 0
        loss = held_loss = 0.0
        at, share, grad = None, 0, 0.0
        for b in batches:
            for batch, xs, ys in zip(b.column("batch").to_pylist(), b.column("x"), b.column("y")):
                y = np.frombuffer(ys.as_buffer(), "i4")
                x = np.frombuffer(xs.as_buffer(), "f4").reshape(len(y), -1)
                if batch < 0:       # first of all, so the weights are those so far
                    held_n, held_loss = held_n + len(y), held_loss + first.loss(x, y)
                    continue
                if share and batch != at:
                    step += 1
                    state = _adam(*state, step, grad / share, rate)
                    net, share, grad = Network(net.filled(state[0]).single().weights, net.held), 0, 0.0
                part, grads = net.gradient(x, y)
                at, share, n, loss = batch, share + len(y), n + len(y), loss + part
                grad = grad + np.concatenate([g.ravel() for g in grads]).astype(float)
        if share:
            state = _adam(*state, step + 1, grad / share, rate)
        yield _partial([(TaskContext.get().partitionId(), n, loss, held_n, held_loss, (np.concatenate(state) * n).tobytes())])
    return run


def _fit_by_epochs(rows: DataFrame, net: Network, batches: int, epochs: int, rate: float, patience: int) -> Fitted:
    dealt = (rows.withColumn("x", F.col("x").cast("array<float>"))
             .withColumn("batch", F.when(F.col("held"), -1).otherwise(F.pmod("h", F.lit(batches))).cast("int"))
             .repartition(WORKERS, F.shiftright("h", 32)).sortWithinPartitions("batch", "h", "y").select("batch", "x", "y"))
    # a checkpoint keeps a worker's rows in one task and in their order
    table = materialize(dealt.mapInArrow(_packed, "batch int, x binary, y binary"))
    flat = net.flat()
    m, v, t, losses, best, since = np.zeros_like(flat), np.zeros_like(flat), 0, [], flat, 0
    while True:
        with settings(rows.sparkSession, PIECES):
            got = _summed(table.mapInArrow(_local_steps(net, m, v, t, rate), PARTIAL), WORKERS)
        loss = got[4] / got[3] if got[3] else got[2] / got[1]
        losses.append(loss)
        if loss < min(losses[:-1], default=float("inf")):
            best, since = flat, 0
        else:
            since += 1
            if since % 3 == 0:
                rate = min(rate, max(rate / 2, 1e-6))
        if since >= patience or len(losses) > epochs:
            return Fitted(net.filled(best), losses)
        flat, m, v = np.split(np.frombuffer(got[5]) / got[1], 3)
        net, t = net.filled(flat), t + batches


def fit(df: DataFrame, key: list[str], layers: list[int], features: str = "features", label: str = "label",
        epochs: int = 80, rate: float = 1e-3, patience: int = 5, seed: int = 42, batch_rows: int = BATCH_ROWS) -> Fitted:
    """Train on ``features`` (array of doubles) and ``label`` (class index).

    A fifth of the keys is the validation share; rows of one key are on one
    side. ``layers`` are the widths from the features to the classes."""
    spark = df.sparkSession
    drawn = seeded_hash(key, seed)
    rows = df.where(F.col(label).isNotNull() & F.col(features).isNotNull()).select(
        F.col(features).alias("x"), F.col(label).cast("int").alias("y"), (F.pmod(drawn, F.lit(5)) == 0).alias("held"),
        F.xxhash64(F.lit(seed), *[F.col(k) for k in key], F.col(features)).alias("h"))
    n = rows.where("not held").count()
    batches = max(1, -(-n // batch_rows))
    if batches > STEPWISE:
        return _fit_by_epochs(rows, Network.start(layers, seed), batches, epochs, rate, patience)
    path = scratch_path(spark, f"batches-{uuid.uuid4().hex}")
    (rows.withColumn("batch", F.when(F.col("held"), -1).otherwise(F.pmod("h", F.lit(batches))).cast("int"))
     .withColumn("slice", F.pmod(F.shiftright("h", 32), F.lit(SLICES)))
     .repartition("batch", "slice").sortWithinPartitions("batch", "h").drop("h", "slice")
     .write.option("compression", "zstd").partitionBy("batch").parquet(path))
    net = Network.start(layers, seed)
    if not n:
        return Fitted(net, [])
    schema = T.StructType([rows.schema["x"], rows.schema["y"], rows.schema["held"]])
    table = spark.read.schema(T.StructType([*schema.fields, T.StructField("batch", T.IntegerType())])).parquet(path)
    steps = [table.where(F.col("batch").isin([b] if b else [0, -1])).drop("batch") for b in range(batches)]
    tasks = [s.rdd.getNumPartitions() for s in steps]
    flat = net.flat()
    m, v, t, losses, best, since = np.zeros_like(flat), np.zeros_like(flat), 0, [], flat, 0
    for _ in range(epochs + 1):
        for b in range(batches):
            got = _summed(steps[b].mapInArrow(_gradients(net), PARTIAL), tasks[b])
            if b == 0:
                loss = got[4] / got[3] if got[3] else got[2] / max(1, got[1])
                losses.append(loss)
                if loss < min(losses[:-1], default=float("inf")):
                    best, since = flat.copy(), 0
                else:
                    since += 1
                    if since % 3 == 0:
                        rate = min(rate, max(rate / 2, 1e-6))
                if since >= patience or len(losses) > epochs:
                    return Fitted(net.filled(best), losses)
            if not got[1]:
                continue
            t += 1
            g = np.frombuffer(got[5]) / got[1]
            flat, m, v = _adam(flat, m, v, t, g, rate)
            net = net.filled(flat)
    return Fitted(net.filled(best), losses)
