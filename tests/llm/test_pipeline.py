"""The pipeline against each stage's brute-force counterpart."""

import corpus_pipeline
from panelwright.llm import toxicity
from panelwright.llm.common import written
from panelwright.sources.tables import read_table

from . import helpers as H
from .test_packing import check
from .test_secrets import base
from .test_simhash import expected as components

SF = "/root/testdata/sf0.001"


def test_stages_follow_each_other(spark):
    docs = read_table(spark, SF, "documents")
    names = docs.columns
    kept = [docs]
    for name, stage in corpus_pipeline.STAGES[:-1]:
        kept.append(written(stage(spark, kept[-1], SF), f"test-{name}"))
        assert kept[-1].columns == names
    rows = [[(r.doc_id, r.text) for r in df.collect()] for df in kept]
    m = toxicity.fit(docs, read_table(spark, SF, "labels"))
    assert sorted(rows[1]) == sorted(r for r in rows[0] if m.score(r[1])[0] < 0.5)
    first = {}
    for d, t in sorted(rows[1]):
        first.setdefault(H.norm(t), (d, t))
    assert sorted(rows[2]) == sorted(first.values())
    lead = {d for d, _, c in components(rows[2]) if d == c}
    assert sorted(rows[3]) == sorted(r for r in rows[2] if r[0] in lead)
    assert [d for d, _ in sorted(rows[4])] == [d for d, _ in sorted(rows[3])]
    before = dict(rows[3])
    for d, t in rows[4]:
        assert (t == before[d]) if not base(before[d]) else not base(t)
    packed = corpus_pipeline.STAGES[-1][1](spark, kept[-1], SF).collect()
    check(rows[4], packed, 2048)


def test_run_is_the_chain(spark):
    got = corpus_pipeline.run(spark, SF)
    assert {"doc_id", "piece", "sequence_id", "offset"} <= set(got.columns) and got.count() > 0


def test_empty_and_edge_documents(spark):
    for rows in ([], H.EDGE):
        docs = H.docs(spark, rows)
        for name, stage in corpus_pipeline.STAGES[:-1]:
            docs = written(stage(spark, docs, SF), f"edge-{name}")
        corpus_pipeline.STAGES[-1][1](spark, docs, SF).count()
