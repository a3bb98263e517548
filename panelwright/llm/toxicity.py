"""Toxicity by multiple-instance learning.

Only documents are labelled, yet it is a sentence that offends. A sentence's
score is a logistic model over its words, each with its stems and ending, all
hashed; a document's is the noisy-or of its sentences, ``1 - prod(1 - p)``.
The model is trained through the noisy-or on document labels (full-batch Adam
on the log loss), so the weight of a label flows to the sentences that explain
it; scoring then names them.

Training takes at most ``sample`` labelled documents, those with the smallest
hash of their id, one row each and as word numbers, into one task; of its features those are kept whose share of
toxic documents differs most from chance. Scoring covers every text. Sentences
end at ``. ! ?`` or a line break. Words are lower-cased runs of letters and digits.

Rows: null and empty texts score 0; rows that repeat an id are scored each;
labels with a null id or value are left out, and of contradicting labels of
one id the toxic one counts; without labels, or with one class only, every
score is that class (0 without any). An empty table gives an empty result.
"""

from __future__ import annotations

import re
import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import bounded_batches, claim, columns, packed, text_of

BITS = 20
SAMPLE = 12_000
STEPS = 200
RATE = 0.15
DECAY = 2e-5
MIN_DOCS = 3            # documents a feature is in at least
MIN_Z = 3.0             # deviations from the expected number of toxic ones
FEATURES = 50_000       # features kept at most
START = -5.0
CELLS = 500_000         # (sentence, word) cells worked on at a time

SENTENCE = re.compile(r"[^.!?\n]+")
WORD = re.compile(r"\w+")
KEPT_WORDS = 300_000


def bucket(feature: str) -> int:
    return zlib.crc32(feature.encode("utf-8", "surrogatepass")) & ((1 << BITS) - 1)


def features(word: str) -> list[int]:
    """Buckets of a word, of its first four and five letters and last four."""
    out = [bucket(word)]
    if len(word) > 4:
        out += [bucket(f"{word[:4]}-"), bucket(f"-{word[-4:]}")]
    if len(word) > 5:
        out.append(bucket(f"{word[:5]}-"))
    return out


def sentences(text: str | None) -> list[tuple[int, int, list[str]]]:
    """(start, end, words) of each sentence that has words."""
    out = []
    for m in SENTENCE.finditer(text or ""):
        w = WORD.findall(m.group().lower())
        if w:
            out.append((m.start(), m.end(), w))
    return out


@dataclass
class Model:
    weights: np.ndarray         # of the 2**BITS feature buckets
    bias: float
    constant: float | None = None   # score of every text with a sentence, if nothing could be learned

    def score(self, text: str | None) -> tuple[float, list[tuple[int, int, float]]]:
        """Score of a text, and its sentences (start, end, score) of 0.5 or more."""
        found = sentences(text)
        if self.constant is not None:
            return (self.constant if found else 0.0), []
        if not found:
            return 0.0, []
        look = _lookup(self)
        z = np.array([sum(map(look.__getitem__, set(w))) for _, _, w in found]) + self.bias
        p = 1.0 / (1.0 + np.exp(-z))
        score = float(-np.expm1(-np.logaddexp(0.0, z).sum()))
        return min(1.0, max(0.0, score)), [(s, e, float(q)) for (s, e, _), q in zip(found, p) if q >= 0.5]


class _Weights(dict):
    def __init__(self, model):
        self.model = model

    def __missing__(self, word: str) -> float:
        if len(self) >= KEPT_WORDS:
            self.clear()
        self[word] = w = float(self.model.weights[features(word)].sum())
        return w


def _lookup(model: Model) -> _Weights:
    if "_words" not in model.__dict__:
        model.__dict__["_words"] = _Weights(model)
    words = model.__dict__["_words"]
    claim(words, words.clear)
    return words


def numbered(text: str | None) -> tuple[list[str], list[int], list[int]]:
    """The different words of a text, each sentence's different words as places
    among them, one sentence after the other, and how many each sentence has."""
    number: dict[str, int] = {}
    cells, sizes = [], []
    for _, _, w in sentences(text):
        ids = dict.fromkeys(number.setdefault(x, len(number)) for x in w)
        cells += ids
        sizes.append(len(ids))
    return list(number), cells, sizes


def fit_texts(texts: list[str], labels: list[int], steps: int = STEPS) -> Model:
    """Train on labelled texts (in one process: the caller bounds them)."""
    return fit_numbered(((*numbered(t), lab) for t, lab in zip(texts, labels)), steps)


def fit_numbered(rows, steps: int = STEPS) -> Model:
    """Train on (words, cells, sizes, label) of documents, see ``numbered``."""
    number: dict[str, int] = {}
    word, sizes, per_doc, of, labels = [], [], [], [], []
    for words, cells, size, lab in rows:
        labels.append(lab)
        if len(size):
            of.append(float(lab))
            per_doc.append(len(size))
            sizes.append(np.asarray(size, np.int32))
            word.append(np.fromiter((number.setdefault(x, len(number)) for x in words), np.int32, len(words))[np.asarray(cells, np.int32)])
    y = np.array(of)
    if not len(y) or y.min() == y.max():
        base = float(np.mean(labels)) if len(labels) else 0.0
        return Model(np.zeros(1 << BITS, np.float32), 0.0, float(base >= 0.5))
    word, sizes = np.concatenate(word), np.concatenate(sizes)
    n_sent = len(sizes)
    sent = np.repeat(np.arange(n_sent, dtype=np.int32), sizes)
    doc_of = np.repeat(np.arange(len(y), dtype=np.int32), per_doc)
    per_word = [features(w) for w in number]
    feat = np.concatenate([np.array(f, np.int64) for f in per_word])
    owner = np.repeat(np.arange(len(per_word)), [len(f) for f in per_word])
    first = np.searchsorted(owner, np.arange(len(per_word) + 1))
    # in how many documents, and toxic ones, a feature is
    n, toxic = np.zeros(1 << BITS), np.zeros(1 << BITS)
    cuts = np.searchsorted(doc_of[sent], np.arange(0, len(y) + 1000, 1000))
    for lo, hi in zip(cuts, cuts[1:]):
        pair = np.unique(word[lo:hi].astype(np.int64) << 32 | doc_of[sent[lo:hi]])
        size = np.diff(first)[pair >> 32]
        at = np.repeat(first[pair >> 32], size) + np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
        pair = np.unique(feat[at] << 32 | np.repeat(pair & 0xFFFFFFFF, size))
        n += np.bincount(pair >> 32, minlength=1 << BITS)
        toxic += np.bincount(pair >> 32, weights=y[pair & 0xFFFFFFFF], minlength=1 << BITS)
    share = y.mean()
    z = np.abs(toxic - n * share) / np.sqrt(np.maximum(n, 1) * share * (1 - share))
    z[n < MIN_DOCS] = 0
    names = np.sort(np.argsort(-z, kind="stable")[:FEATURES])
    names = names[z[names] >= MIN_Z]
    if not len(names):
        return Model(np.zeros(1 << BITS, np.float32), 0.0, float(share >= 0.5))
    place = np.full(1 << BITS, -1)
    place[names] = np.arange(len(names))
    hold = place[feat] >= 0
    feat, owner = place[feat[hold]], owner[hold]
    told = np.zeros(len(per_word), bool)
    told[owner] = True
    hold = told[word]
    sent, word = sent[hold], word[hold]
    parts = [slice(lo, lo + CELLS) for lo in range(0, len(word), CELLS)]
    w, b = np.zeros(len(names)), START
    m1, m2 = np.zeros(len(names) + 1), np.zeros(len(names) + 1)
    for step in range(1, steps + 1):
        value = np.bincount(owner, weights=w[feat], minlength=len(per_word))
        x = np.full(n_sent, b)
        for c in parts:
            lo = sent[c.start]
            some = np.bincount(sent[c] - lo, weights=value[word[c]])
            x[lo:lo + len(some)] += some
        none = np.bincount(doc_of, weights=np.logaddexp(0.0, x), minlength=len(y))     # -log P(no sentence offends)
        pull = np.where(y > 0, -np.exp(-none) / np.maximum(-np.expm1(-none), 1e-9), 1.0)
        g = pull[doc_of] / (1.0 + np.exp(-x)) / len(y)
        by_word = np.zeros(len(per_word))
        for c in parts:
            by_word += np.bincount(word[c], weights=g[sent[c]], minlength=len(per_word))
        grad = np.append(np.bincount(feat, weights=by_word[owner], minlength=len(names)) + DECAY * w, g.sum())
        m1 = 0.9 * m1 + 0.1 * grad
        m2 = 0.99 * m2 + 0.01 * grad * grad
        move = RATE * (m1 / (1 - 0.9 ** step)) / (np.sqrt(m2 / (1 - 0.99 ** step)) + 1e-9)
        w -= move[:-1]
        b -= 0.2 * move[-1]
    weights = np.zeros(1 << BITS, np.float32)
    weights[names] = w
    return Model(weights, float(b))


def labelled(labels: DataFrame) -> DataFrame:
    """One (doc_id, toxic) per labelled id."""
    return (labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("toxic"))
            .where("doc_id is not null and toxic is not null")
            .groupBy("doc_id").agg(F.max("toxic").alias("toxic")))


def held_out(doc_id="doc_id"):
    """Rows never learned from: crc32 of the id as text, modulo 5, is 0."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 5 == 0, F.lit(False))


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Model:
    """Train on at most ``sample`` labelled documents that are not held out."""
    bounded_batches(docs.sparkSession)
    ids = labelled(labels).where(~held_out()).orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)
    rows = (docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("text"))
            .join(F.broadcast(ids), "doc_id")       # at most ``sample`` rows of two numbers
            .groupBy("doc_id", "toxic").agg(F.min("text").alias("text")))     # a repeated row teaches once

    def number(batches):
        for b in columns(batches):
            words, cells, sizes = zip(*map(numbered, b["text"].to_pylist()))
            yield pa.RecordBatch.from_arrays(
                [b["doc_id"], b["toxic"], pa.array(words, pa.list_(pa.string())), pa.array(cells, pa.list_(pa.int32())),
                 pa.array(sizes, pa.list_(pa.int32()))], names=["doc_id", "toxic", "words", "cells", "sizes"])

    def train(batches):
        claim("training", lambda: None)

        def each():
            for b in columns(batches):
                for i, lab in enumerate(b["toxic"].to_pylist()):
                    yield b["words"][i].as_py(), b["cells"][i].values.to_numpy(), b["sizes"][i].values.to_numpy(), lab
        m = fit_numbered(each())
        yield pa.RecordBatch.from_pydict({
            "weights": pa.array([m.weights.astype("<f4").tobytes()], pa.binary()), "bias": pa.array([m.bias], pa.float64()),
            "constant": pa.array([m.constant], pa.float64())})
    sample_rows = rows.mapInArrow(number, "doc_id long, toxic int, words array<string>, cells array<int>, sizes array<int>")
    got = (sample_rows.repartition(1).sortWithinPartitions("doc_id")
           .mapInArrow(train, "weights binary, bias double, constant double").first())
    if got is None:
        return Model(np.zeros(1 << BITS, np.float32), 0.0, 0.0)
    return Model(np.frombuffer(bytes(got["weights"]), "<f4"), got["bias"], got["constant"])


def score(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, score, offending): ``offending`` holds (start, end, score) of
    each sentence scored 0.5 or more, in code points, end exclusive."""
    side = docs.sparkSession.sparkContext.broadcast(model)     # 2**BITS floats

    def make(batches):
        m = side.value
        for b in columns(batches):
            got = [m.score(t) for t in b["text"].to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [b["doc_id"], pa.array([s for s, _ in got], pa.float64()),
                 pa.array([[{"start": a, "end": e, "score": p} for a, e, p in o] for _, o in got],
                          pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("score", pa.float64())])))],
                names=["doc_id", "score", "offending"])
    bounded_batches(docs.sparkSession)
    src = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("text"))
    return src.mapInArrow(make, "doc_id long, score double, offending array<struct<start:long,end:long,score:double>>")


def drop_toxic(docs: DataFrame, model: Model, threshold: float = 0.5) -> DataFrame:
    """Rows of ``docs``, all columns, whose text scores below the threshold."""
    side = docs.sparkSession.sparkContext.broadcast(model)

    def flag(batches):
        m = side.value
        for b in batches:
            if b.num_rows:
                t = b.column(b.schema.get_field_index("text")).to_pylist()
                yield b.filter(pa.array([m.score(x)[0] < threshold for x in t], pa.bool_()))
    bounded_batches(docs.sparkSession)
    rows = packed(docs)
    return rows.mapInArrow(flag, rows.schema).select("row.*")
