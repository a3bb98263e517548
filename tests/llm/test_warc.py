import hashlib
import random

from panelwright.llm import queries, warc
from panelwright.sources.tables import read_table

from ..conftest import SF_SMALL
from . import helpers as H


def expected(rows):
    lead = {}
    for p, _, h in rows:
        b = (h or "").encode()
        if len(b) >= 1000 and p is not None:
            lead[b] = max(p, lead.get(b, p))
    out = []
    for p, _, h in rows:
        b = (h or "").encode()
        to = lead.get(b)
        to = None if to == p else to
        out.append((p, len(b), hashlib.sha1(b).hexdigest(), "response" if to is None else "revisit", to))
    return sorted(out, key=repr)


def pages(spark, rows):
    return spark.createDataFrame([(*r, "x", 1) for r in rows], "page_id long, url string, html string, digest string, lead int")


def test_query_matches_brute_force(spark):
    rows = [(r.page_id, r.url, r.html) for r in read_table(spark, SF_SMALL, "pages").collect()]
    assert H.bag(queries.op4_warc(spark, SF_SMALL)) == expected(rows)


EDGE = [(1, "http://a.b/x", "y" * 1000), (2, "http://A.b/x", "y" * 1000), (3, None, None), (4, "", ""), (5, "bad [url", "z\r\n\r\nq" * 400),
        (None, "http://a.b/x", "y" * 1000), (None, "u", "n" * 2000), (None, "u", "n" * 2000), (6, "u\r\nX: y", "s" * 999), (7, "u", "s" * 999),
        (8, "u", "é" * 500), (9, "u", "é" * 500), (9, "u", "é" * 500), (10, "u", "big" * 400_000)]


def test_edge_rows_and_payloads(spark):
    a = warc.write_archives(pages(spark, EDGE))
    got = a.read().collect()
    assert sorted((tuple(r)[:5] for r in got), key=repr) == expected(EDGE)
    full = {(r.page_id, hashlib.sha1(bytes(r.payload)).hexdigest()) for r in got if r.record_type == "response"}
    assert all(r.payload is None or hashlib.sha1(bytes(r.payload)).hexdigest() == r.payload_digest for r in got)
    assert {(r.page_id, r.payload_digest) for r in got if r.record_type == "response"} == full
    assert warc.write_archives(pages(spark, [])).read().count() == 0


def test_index_is_globally_ordered_over_ranges(spark):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        a = warc.write_archives(read_table(spark, SF_SMALL, "pages").repartition(7))
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert a.index.select("range").distinct().count() == 8 and a.index.select("run").distinct().count() == 7
    rows = [warc._order(tuple(r)[:5]) for r in a.ordered().collect()]
    assert len(rows) == a.index.count() and rows == sorted(rows)
    assert sorted(rows) == sorted(warc._order(tuple(r)[:5]) for r in a.index.collect())


def test_loser_tree():
    rng = random.Random(1)
    for k in (0, 1, 2, 3, 5, 8, 13):
        runs = [sorted((rng.randrange(50), i) for _ in range(rng.randrange(20))) for i in range(k)]
        want = sorted((x for r in runs for x in r), key=lambda x: x[0])
        got = list(warc.LoserTree([((key, v) for key, v in r) for r in runs]))
        assert [x[0] for x in got] == [x[0] for x in want] and sorted(got) == sorted(want)
