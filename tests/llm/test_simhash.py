import numpy as np
import xxhash
from pyspark.sql import functions as F

from panelwright.llm import queries, simhash
from panelwright.llm.graph import components
from panelwright.sources.tables import read_table

from ..conftest import SF_SMALL
from . import helpers as H


def slow_fingerprint(text):
    w = (text or "").encode().lower().split()
    if not w:
        return 0
    sh = [b" ".join(w[i:i + 4]) for i in range(max(1, len(w) - 3))]
    h = [xxhash.xxh64_intdigest(s, 42) for s in sh]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def expected(rows):
    fp = [slow_fingerprint(t) for _, t in rows]
    links = [(i, j) for i in range(len(rows)) for j in range(i) if (fp[i] ^ fp[j]).bit_count() <= 4]
    label = H.reachable(range(len(rows)), links)
    first = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            first[label[i]] = min(d, first.get(label[i], d))
    return sorted(((d, f"{fp[i]:016x}", first.get(label[i])) for i, (d, _) in enumerate(rows)), key=repr)


def test_query_matches_brute_force(spark):
    rows = [(r.doc_id, r.text) for r in read_table(spark, SF_SMALL, "documents").collect()]
    assert H.bag(queries.op2_simhash(spark, SF_SMALL)) == expected(rows)


def test_edge_rows(spark):
    got = simhash.near_duplicates(H.docs(spark, H.EDGE)).select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0"), "component_id")
    assert H.bag(got) == expected(H.EDGE)


def test_empty_table(spark):
    assert simhash.near_duplicates(H.docs(spark, [])).count() == 0
    assert simhash.deduplicate(H.docs(spark, [])).count() == 0


def test_large_blocks_are_cut_and_lose_no_link(spark):
    rng = np.random.default_rng(5)
    base = rng.integers(0, 1 << 63, 60, dtype=np.uint64)
    fps = {0}
    for b in base.tolist():
        for _ in range(6):
            x = b & ~0x1FFF  # one block is equal for all: a hot block value
            for bit in rng.integers(13, 64, rng.integers(0, 6)):
                x ^= 1 << int(bit)
            fps.add(x)
    fps = sorted(fps)
    links = [(i, j) for i in range(len(fps)) for j in range(i) if (fps[i] ^ fps[j]).bit_count() <= 4]
    want = H.reachable(range(len(fps)), links)
    df = spark.createDataFrame([(int(np.uint64(f).view(np.int64)),) for f in fps], "fp long")
    for unit in (3, 20, 100_000):
        got = {(r.u & (1 << 64) - 1, r.v & (1 << 64) - 1) for r in simhash.links(df, 4, unit_rows=unit).collect()}
        at = {f: i for i, f in enumerate(fps)}
        assert all((a ^ b).bit_count() <= 64 for a, b in got)
        assert H.reachable(range(len(fps)), [(at[a], at[b]) for a, b in got]) == want


def test_copies_of_a_fingerprint_do_not_grow_with_its_block(spark, monkeypatch):
    rng = np.random.default_rng(7)
    seen = []
    inner = simhash.written
    monkeypatch.setattr(simhash, "written", lambda df, name: seen.append((name, inner(df, name))) or seen[-1][1])
    for n in (2000, 16_000):
        # one block is equal for all, the other bits are random
        fps = np.unique(rng.integers(0, 1 << 63, n, dtype=np.uint64) & ~np.uint64(0x1FFF))
        df = spark.createDataFrame([(int(f),) for f in fps.tolist()], "fp long")
        seen.clear()
        simhash.links(df, 4, unit_rows=200).count()
        tables = dict(seen)
        assert tables["split-blocks"].groupBy("fp").count().agg({"count": "max"}).first()[0] <= 25
        assert "tile-counts" not in tables


def test_deduplicate_keeps_one_of_a_group_and_all_columns(spark):
    rows = [(3, "a b c d e f g"), (2, "A b c  d e f g"), (5, "quite another text of words"), (None, "a b c d e f g"), (5, "a b c d e f g")]
    d = H.docs(spark, rows)
    kept = simhash.deduplicate(d)
    assert kept.columns == d.columns
    assert sorted((r.doc_id, r.text) for r in kept.collect()) == [(2, "A b c  d e f g"), (5, "quite another text of words")]


def test_deduplicate_keeps_one_of_null_and_repeated_ids(spark):
    rng = np.random.default_rng(8)
    base = [f"w{i}" for i in rng.integers(0, 9999, 600)]
    near = [" ".join(base[:k] + base[k + 1:]) for k in (0, 599)]
    rows = [(None, "a b c d e f g"), (None, "A b c d  e f g"), (None, "a b c d e f g"), (None, "another text of some words"),
            (7, near[0]), (7, near[1]), (7, near[1]), (8, near[0]), (7, "one text of its own here")]
    fp = [simhash.fingerprint(t) for t in near]
    assert fp[0] != fp[1] and (fp[0] ^ fp[1]).bit_count() <= 4
    kept = sorted(((r.doc_id, r.text.lower().split()) for r in simhash.deduplicate(H.docs(spark, rows)).collect()), key=repr)
    assert [d for d, _ in kept] == [7, 7, None, None]
    assert kept[2:] == [(None, "a b c d e f g".split()), (None, "another text of some words".split())]
    lead = " ".join(next(t for d, t in kept if d == 7 and len(t) > 9))
    assert lead in near and (7, "one text of its own here".split()) in kept


def test_components(spark):
    rng = np.random.default_rng(3)
    edges = [(int(a), int(b)) for a, b in rng.integers(0, 300, (220, 2))] + [(i, i + 1) for i in range(400, 460)]
    want = H.reachable(range(500), edges)
    got = {r.node: r.root for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {n: r for n, r in want.items() if n != r}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0
