"""Spark ML's perceptron fitted over stacked blocks.

The layers, starting weights, loss, solver and fitted model are those of
``MultilayerPerceptronClassifier`` (sigmoid hidden units, softmax output,
L-BFGS); only the gradient is taken elsewhere. The rows of a partition are
stacked once into blocks of the estimator's block size and written below the
shared folder; an evaluation is one job whose tasks take matrix products over
whole blocks and give one sum each. The driver holds the weights (bounded by
the layers) and the last ``MEMORY`` steps of the solver. As there, the loss is
the mean over blocks of each block's mean.

Beyond ``DOUBLE_ROWS`` rows the blocks are kept and multiplied in single
precision; their losses, the sums of their gradients, the weights and the
solver stay in double precision. Rounding then moves a loss or a gradient by
some ten-millionths, far less than a step does.

A block is a large record, so the table is written in short row groups and read
in short tasks, and few records go to Python at once: a task's memory does not
depend on how many blocks it reads.
"""

from __future__ import annotations

from collections import deque
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import MultilayerPerceptronClassificationModel, MultilayerPerceptronClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.linalg import Vectors
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import settings, stored
from .minibatch import BLOCK_ROWS, PARTIAL, PIECES, _matrix, _partial, _summed

MEMORY = 10             # steps the solver remembers
DOUBLE_ROWS = 500_000   # rows whose blocks are in double precision
BLOCK = "x binary, y binary"
PART = "_part"          # column with the partition a row was written from
# Some ten blocks in a row group of the file, some megabytes of the file in a task.
WRITE = {"parquet.block.size": str(8 << 20), "parquet.page.size.row.check.min": "1", "parquet.block.size.row.check.min": "1"}
READ = PIECES | {"spark.sql.files.maxPartitionBytes": "8m"}


def precision(rows: int) -> str:
    """The type of the blocks' features for a table of so many rows."""
    return "f8" if rows <= DOUBLE_ROWS else "f4"


def blocks(df: DataFrame, size: int, features: str, label: str, kind: str = "f8") -> DataFrame:
    """The rows of each partition as matrices of at most ``size`` rows, as
    written. Where the rows tell by a column ``PART`` which partition they were
    written from, a matrix holds rows of one only, however the files are read."""
    def packed(x: np.ndarray, y: np.ndarray) -> pa.RecordBatch:
        x = x.astype(kind)
        return pa.RecordBatch.from_arrays([pa.array([x.tobytes()], pa.binary()), pa.array([y.tobytes()], pa.binary())], names=["x", "y"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        x, y, at = None, np.zeros(0), None
        for b in batches:
            if not b.num_rows:
                continue
            part, xs, ys = (b.column(c).to_numpy(zero_copy_only=False) if c != "x" else _matrix(b.column(c), b.num_rows) for c in ("part", "x", "y"))
            cuts = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), b.num_rows]
            for lo, hi in zip(cuts, cuts[1:]):
                if at != part[lo]:
                    if len(y):
                        yield packed(x, y)
                    x, y, at = None, np.zeros(0), part[lo]
                x = xs[lo:hi] if x is None else np.concatenate([x, xs[lo:hi]])
                y = np.concatenate([y, ys[lo:hi]])
                while len(y) >= size:
                    yield packed(x[:size], y[:size])
                    x, y = x[size:], y[size:]
        if len(y):
            yield packed(x, y)
    part = F.col(PART) if PART in df.columns else F.lit(0)
    rows = df.select(vector_to_array(features).alias("x"), F.col(label).cast("double").alias("y"), part.alias("part"))
    return stored(rows.mapInArrow(run, BLOCK), "blocks", **WRITE)


def _layers(flat: np.ndarray, widths: list[int]) -> list[tuple[np.ndarray, np.ndarray]]:
    """(weights, bias) of each layer in Spark ML's order: weights by column, then the bias."""
    out, at = [], 0
    for a, b in zip(widths, widths[1:]):
        out.append((flat[at:at + a * b].reshape(a, b), flat[at + a * b:at + a * b + b]))
        at += a * b + b
    return out


class Pass:
    """Weights laid out for the blocks of a task, whose arrays are used again from block to block."""

    def __init__(self, flat: np.ndarray, widths: list[int], kind: str = "f8"):
        self.kind, self.held = np.dtype(kind), {}
        self.net = _layers(flat.astype(kind), widths)
        self.back = [w.T.copy() for w, _ in self.net]
        for w, b in self.net[:-1]:      # the sigmoid asks for the negative sum
            np.negative(w, out=w)
            np.negative(b, out=b)
        self.sums = np.empty(len(flat), kind)

    def _room(self, name: tuple, rows: int, width: int) -> np.ndarray:
        if len(self.held.get(name, ())) < rows:
            self.held[name] = np.empty((rows, width), self.kind)
        return self.held[name][:rows]

    def forward(self, x: np.ndarray) -> tuple[list[np.ndarray], np.ndarray, np.ndarray, np.ndarray]:
        """The input with each hidden layer's output, then the last sums less their largest, their exponentials and the total of these."""
        n, out = len(x), [x]
        for i, (w, b) in enumerate(self.net[:-1]):
            z = np.matmul(out[-1], w, out=self._room(("out", i), n, len(b)))
            z += b
            with np.errstate(over="ignore"):
                np.exp(z, out=z)
            z += 1
            out.append(np.reciprocal(z, out=z))
        z = (out[-1] @ self.net[-1][0] + self.net[-1][1]).astype(float, copy=False)
        z -= z.max(axis=1, keepdims=True)
        e = np.exp(z)
        return out, z, e, e.sum(axis=1, keepdims=True)

    def gradient(self, x: np.ndarray, y: np.ndarray) -> tuple[float, np.ndarray]:
        """Mean loss of a block and its gradient, which holds until the next block."""
        out, z, e, total = self.forward(x)
        n, at = len(y), np.arange(len(y))
        loss = float((np.log(total[:, 0]) - z[at, y]).mean())
        delta = e / total
        delta[at, y] -= 1
        delta = (delta / n).astype(self.kind, copy=False)
        grads = _layers(self.sums, [len(self.net[0][0]), *(len(b) for _, b in self.net)])
        for i in range(len(self.net) - 1, -1, -1):
            np.matmul(out[i].T, delta, out=grads[i][0])
            np.sum(delta, axis=0, out=grads[i][1])
            if i:
                delta = np.matmul(delta, self.back[i], out=self._room(("delta", i), n, len(self.back[i][0])))
                delta *= out[i]
                delta *= np.subtract(1, out[i], out=out[i])
        return loss, self.sums


def gradient(flat: np.ndarray, widths: list[int], x: np.ndarray, y: np.ndarray) -> tuple[float, np.ndarray]:
    """Mean loss of a block and its gradient."""
    return Pass(flat, widths, x.dtype).gradient(x, y)


def objective(table: DataFrame, widths: list[int], kind: str = "f8") -> Callable[[np.ndarray], tuple[float, np.ndarray]]:
    """Weights -> (loss, gradient) over all blocks, one job a call."""
    spark = table.sparkSession
    with settings(spark, READ):
        tasks = table.rdd.getNumPartitions()

    def at(flat: np.ndarray) -> tuple[float, np.ndarray]:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            from pyspark import TaskContext
            n, loss, total, over = 0, 0.0, np.zeros(len(flat)), Pass(flat, widths, kind)
            for b in batches:
                for xs, ys in zip(b.column("x"), b.column("y")):
                    y = np.frombuffer(ys.as_buffer()).astype(int)
                    part, grad = over.gradient(np.frombuffer(xs.as_buffer(), kind).reshape(len(y), -1), y)
                    n, loss = n + 1, loss + part
                    total += grad
            yield _partial([(TaskContext.get().partitionId(), n, loss, 0, 0.0, total.tobytes())])
        with settings(spark, READ):
            got = _summed(table.mapInArrow(run, PARTIAL), tasks)
        return got[2] / got[1], np.frombuffer(got[5]) / got[1]
    return at


class LineSearchError(ArithmeticError):
    pass


def _step(at: Callable, x: np.ndarray, way: np.ndarray, first: tuple, init: float) -> tuple:
    """A step along ``way`` within the strong Wolfe conditions (bracketing,
    then cubic interpolation): (step, loss, gradient there)."""
    def phi(t: float) -> tuple:
        f, g = at(x + way * t)
        return t, f, float(g @ way), g
    f0, d0 = first[0], float(first[1] @ way)
    if d0 > 0:
        raise LineSearchError("not a descent direction")

    def between(lo: tuple, hi: tuple) -> float:
        d1 = lo[2] + hi[2] - 3 * (lo[1] - hi[1]) / (lo[0] - hi[0])
        d2 = np.sqrt(d1 * d1 - lo[2] * hi[2]) if d1 * d1 >= lo[2] * hi[2] else float("nan")
        wide = hi[0] - lo[0]
        t = hi[0] - wide * (hi[2] + d2 - d1) / (hi[2] - lo[2] + 2 * d2)
        return max(min(t, lo[0] + 0.9 * wide), lo[0] + 0.1 * wide) if t == t else lo[0] + 0.5 * wide

    def zoom(lo: tuple, hi: tuple) -> tuple:
        for _ in range(10):
            c = phi(between(hi, lo) if lo[0] > hi[0] else between(lo, hi))
            if c[1] > f0 + 1e-4 * c[0] * d0 or c[1] >= lo[1]:
                hi = c
                continue
            if abs(c[2]) <= 0.9 * abs(d0):
                return c
            if c[2] * (hi[0] - lo[0]) >= 0:
                hi = lo
            lo = c
        raise LineSearchError("no step between the bounds")
    low, t = (0.0, f0, d0, first[1]), init
    for i in range(10):
        c = phi(t)
        if not np.isfinite(c[1]):
            t /= 2
        elif c[1] > f0 + 1e-4 * t * d0 or (c[1] >= low[1] and i):
            return zoom(low, c)
        elif abs(c[2]) <= 0.9 * abs(d0):
            return c
        elif c[2] >= 0:
            return zoom(c, low)
        else:
            low, t = c, t * 1.5
    raise LineSearchError("no step found")


def _direction(grad: np.ndarray, seen: deque) -> np.ndarray:
    out, kept = grad.copy(), []
    for s, g in seen:
        a = (s @ out) / (s @ g)
        out -= a * g
        kept.append(a)
    if seen:
        s, g = seen[0]
        if not s @ g >= 0:
            raise LineSearchError("curvature lost")
        out *= (s @ g) / (g @ g)
    for (s, g), a in zip(reversed(seen), reversed(kept)):
        out += (a - (g @ out) / (s @ g)) * s
    return -out


def minimise(at: Callable, x: np.ndarray, steps: int, tol: float) -> tuple[np.ndarray, list[float]]:
    """L-BFGS from ``x``: the weights reached and the loss after each step."""
    f, g = at(x)
    losses, seen, failed = [f], deque(maxlen=MEMORY), False
    while len(losses) <= steps and np.linalg.norm(g) > max(tol * f, 1e-8):
        try:
            way = _direction(g, seen)
            t, f_new, _, g_new = _step(at, x, way, (f, g), 1 / np.linalg.norm(way) if len(losses) == 1 else 1.0)
            if t * np.linalg.norm(g) < 1e-10:
                raise LineSearchError("step too small")
        except LineSearchError:
            if failed:
                break
            failed = True
            seen.clear()
            continue
        failed = False
        x_new = x + way * t
        seen.appendleft((x_new - x, g_new - g))
        x, f, g = x_new, f_new, g_new
        losses.append(f)
        # the largest of the last twenty losses is hardly above this one
        if abs(f - max(losses[-20:])) <= tol * losses[0]:
            break
    return x, losses


def fit(mlp: MultilayerPerceptronClassifier, feats: DataFrame) -> MultilayerPerceptronClassificationModel:
    """``mlp.fit(feats)`` with its gradients taken over blocks."""
    features, label = mlp.getFeaturesCol(), mlp.getLabelCol()
    widths = mlp.getLayers()
    kind = precision(feats.count())
    table = blocks(feats, mlp.getBlockSize(), features, label, kind)
    # no step over one row: Spark ML's starting weights, and a model that carries given ones
    still = mlp.copy().setMaxIter(0)
    row = feats.limit(1)
    start = still.fit(row).weights.toArray()
    found, _ = minimise(objective(table, widths, kind), start, mlp.getMaxIter(), mlp.getTol())
    return still.setInitialWeights(Vectors.dense(found)).fit(row)


def predict(model: MultilayerPerceptronClassificationModel, df: DataFrame, features: str = "features") -> DataFrame:
    """``df`` with ``prediction`` and ``probability`` (a vector) as ``model``
    gives them, by matrix products; ``features`` is an array of doubles."""
    flat, widths, names = model.weights.toArray(), model.getLayers(), df.columns
    schema = T.StructType([*df.schema.fields, T.StructField("prediction", T.DoubleType()), T.StructField("probability", T.ArrayType(T.DoubleType()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        over = Pass(flat, widths)
        for b in batches:
            for lo in range(0, b.num_rows, BLOCK_ROWS):
                part = b.slice(lo, BLOCK_ROWS)
                _, _, e, total = over.forward(_matrix(part.column(features), part.num_rows))
                p = e / total
                cuts = pa.array(np.arange(0, p.size + 1, p.shape[1], dtype="i4"))
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(p.argmax(axis=1).astype(float)), pa.ListArray.from_arrays(cuts, p.ravel())],
                                                 names=[*names, "prediction", "probability"])
    return df.mapInArrow(run, schema).withColumn("probability", array_to_vector("probability"))
