import zlib

import numpy as np
from pyspark.sql import functions as F

from panelwright.llm import queries, toxicity
from panelwright.sources.tables import read_table

from . import helpers as H

SF = "/root/testdata/sf0.01"


def test_held_out_accuracy(spark):
    got = queries.op7_toxicity(spark, SF).join(toxicity.labelled(read_table(spark, SF, "labels")), "doc_id").collect()
    held = [r for r in got if r.held_out]
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in got)
    y, p = np.array([r.toxic for r in held]), np.array([r.predicted for r in held])
    base = max(y.mean(), 1 - y.mean())
    assert (y == p).mean() > base
    s = np.array([r.score for r in held])
    auc = (s[y == 1][:, None] > s[y == 0][None, :]).mean() + 0.5 * (s[y == 1][:, None] == s[y == 0][None, :]).mean()
    assert auc > 0.9
    assert ((s >= 0) & (s <= 1)).all()


def test_every_row_is_scored_once(spark):
    d = read_table(spark, SF, "documents")
    assert queries.op7_toxicity(spark, SF).count() == d.count()


def test_offending_sentences_are_found():
    rng = np.random.default_rng(0)
    words = ["alpha", "beta", "gamma", "delta", "epsilon", "zeta"]
    texts, y = [], []
    for i in range(300):
        s = [" ".join(rng.choice(words, 6)) for _ in range(5)]
        if i % 4 == 0:
            s[2] += " scoundrel"
        texts.append(". ".join(s))
        y.append(int(i % 4 == 0))
    m = toxicity.fit_texts(texts, y)
    score, spans = m.score("alpha beta. gamma scoundrel zeta. delta")
    assert score > 0.5 and [("alpha beta. gamma scoundrel zeta. delta"[a:b]).strip() for a, b, _ in spans] == ["gamma scoundrel zeta"]
    assert m.score("alpha beta. gamma zeta")[0] < 0.5
    none = 1 - np.prod([1 - 1 / (1 + np.exp(-(m.bias + sum(m.weights[b] for w in set(s.split()) for b in toxicity.features(w)))))
                        for s in ("alpha beta", "gamma zeta")])
    assert abs(m.score("alpha beta. gamma zeta")[0] - none) < 1e-6


def test_edge_rows(spark):
    d = H.docs(spark, H.EDGE)
    labels = spark.createDataFrame([(1, 1), (1, 0), (5, 0), (None, 1), (7, None)], "doc_id long, toxic int")
    m = toxicity.fit(d, labels, sample=10)
    got = toxicity.score(d, m)
    assert got.count() == len(H.EDGE)
    assert all(r.score == 0 for r in got.collect() if r.doc_id in (2, 3, 4))
    assert toxicity.drop_toxic(d, m).columns == d.columns
    none = labels.where(F.lit(False))
    assert {r.score for r in toxicity.score(d, toxicity.fit(d, none)).collect()} == {0.0}
    assert toxicity.score(H.docs(spark, []), m).count() == 0
    assert toxicity.drop_toxic(d, toxicity.fit(d, none)).count() == len(H.EDGE)


def test_sample_is_a_bound(spark):
    d = H.docs(spark, [(i, "good words here" if i % 2 else "bad words here") for i in range(100)])
    labels = spark.createDataFrame([(i, 1 - i % 2) for i in range(100)], "doc_id long, toxic int")
    m = toxicity.fit(d, labels, sample=40)
    assert m.score("bad")[0] > m.score("good")[0]


def test_sample_reaches_its_bound_with_one_row_an_id(spark):
    # more labels that may teach than the old bound of 8,000; every row is there three times
    docs = spark.range(11_000).select(F.col("id").alias("doc_id"), F.expr("concat('plain words here. ', if(id % 4 = 0, 'scoundrel', 'friend'), ' w', id)").alias("text"))
    labels = docs.select("doc_id", (F.col("doc_id") % 4 == 0).cast("int").alias("toxic"))
    ids = sorted(r.doc_id for r in toxicity.labelled(labels).where(~toxicity.held_out()).orderBy(F.xxhash64("doc_id"), "doc_id").limit(12_000).collect())
    assert toxicity.SAMPLE == 12_000 and len(ids) > 8_000
    text = {r.doc_id: r.text for r in docs.collect()}
    want = toxicity.fit_texts([text[i] for i in ids], [int(i % 4 == 0) for i in ids])
    got = toxicity.fit(docs.unionByName(docs).unionByName(docs), labels)
    assert np.array_equal(got.weights, want.weights) and got.bias == want.bias
    assert got.score("a scoundrel")[0] > 0.5 > got.score("a friend")[0]


def test_blocks_of_cells_give_one_model(monkeypatch):
    rng = np.random.default_rng(1)
    texts = [". ".join(" ".join(rng.choice(["one", "two", "three", "scoundrel" if i % 3 == 0 else "four"], 5)) for _ in range(4)) for i in range(200)]
    y = [int(i % 3 == 0) for i in range(200)]
    whole = toxicity.fit_texts(texts, y)
    monkeypatch.setattr(toxicity, "CELLS", 97)
    parts = toxicity.fit_texts(texts, y)
    assert np.allclose(parts.weights, whole.weights, atol=1e-4) and abs(parts.bias - whole.bias) < 1e-6
