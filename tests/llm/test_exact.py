from pyspark.sql import functions as F

from panelwright.llm import exact
from . import helpers as H


def expected(rows):
    groups = {}
    for d, t in rows:
        groups.setdefault(H.norm(t), []).append(d)
    out = []
    for n, ids in groups.items():
        lead = min((i for i in ids if i is not None), default=None)
        for i, d in enumerate(ids):
            out.append((d, lead, len(ids), d == lead and ids.index(d) == i, H.sha(n.encode())))
    return sorted(out, key=repr)


def test_edge_rows(spark):
    assert H.bag(exact.exact_groups(H.docs(spark, H.EDGE))) == expected(H.EDGE)
    assert exact.exact_groups(H.docs(spark, [])).count() == 0


def many(n=4000):
    return [(None if i % 5 == 0 else i, "hot" if i % 3 == 0 else f"t {i // 2 % 700}" if i % 7 else f"own {i}") for i in range(n)] + H.EDGE


def test_beyond_the_broadcast_bound(spark, monkeypatch):
    plans, real = [], exact.written

    def watched(df, name):
        if name == "winners":
            plans.append(df._jdf.queryExecution().optimizedPlan().toString())
        return real(df, name)
    monkeypatch.setattr(exact, "written", watched)
    rows = many()
    d = H.docs(spark, rows).repartition(8)
    want = sorted(((*r[:3], r[4]) for r in expected(rows)), key=repr)
    for bound, hot in ((10**6, 10**4), (0, 100), (0, 0), (0, 10**6)):
        got = exact.exact_groups(d, bound=bound, hot_rows=hot).collect()
        assert sorted(((*r[:3], r[4]) for r in got), key=repr) == want
        kept = [r.digest for r in got if r.kept]
        assert len(kept) == len(set(kept)) == len({r.digest for r in got})
        assert all(r.doc_id == r.keep_id for r in got if r.kept)
    # rows of hot digests take the broadcast side, the others go without them
    assert "Union" not in plans[0] and all("Union" in p and "LeftAnti" in p for p in plans[1:])


def test_hot_digest_is_not_dealt_by_digest(spark):
    d = H.docs(spark, many()).repartition(8)
    got = exact.exact_groups(d, bound=0, hot_rows=100)
    text = got._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in text and "CartesianProduct" not in text and "Window" not in text


def test_content_decides_when_digests_clash(spark):
    rows = [(i, f"text  {i % 7}") for i in range(60)] + [(100, "alone"), (None, "text 3")]
    weak = lambda c: (F.length(c) % 2).cast("string")
    got = sorted((tuple(r)[:4] for r in exact.exact_groups(H.docs(spark, rows), salts=4, digest=weak).collect()), key=repr)
    assert got == sorted((r[:4] for r in expected(rows)), key=repr)


def test_deduplicate_keeps_columns_and_one_row_of_each_text(spark):
    d = H.docs(spark, H.EDGE)
    kept = exact.deduplicate(d)
    assert kept.columns == d.columns
    texts = sorted(H.norm(r.text) for r in kept.collect())
    assert texts == sorted({H.norm(t) for _, t in H.EDGE})
