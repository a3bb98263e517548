import random
from collections import Counter

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from panelwright.llm import packing, queries
from panelwright.llm.wordbpe import Encoder, default_vocabulary
from panelwright.sources.tables import read_table

from ..conftest import SF_SMALL
from . import helpers as H


def check(rows, packed, size):
    t = Encoder(default_vocabulary()).tokenizer
    want = []
    for d, text in rows:
        ids = t.encode(text or "", add_special_tokens=False).ids + [0]
        want += [(d, k, lo, len(ids[lo:lo + size]), H.crc(ids[lo:lo + size])) for k, lo in enumerate(range(0, len(ids), size))]
    assert sorted((tuple(r)[:5] for r in packed), key=repr) == sorted(want, key=repr)
    seqs = {}
    for r in packed:
        seqs.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for s in seqs.values():
        at = 0
        for off, n in sorted(s):
            assert off == at
            at += n
        assert at <= size
    return len(seqs), -(-sum(w[3] for w in want) // size)


def test_query_matches_brute_force(spark):
    rows = [(r.doc_id, r.text) for r in read_table(spark, SF_SMALL, "documents").collect()]
    n, least = check(rows, queries.op5_packing(spark, SF_SMALL).collect(), 2048)
    assert n <= least * 1.02 + 1


def test_edge_rows_and_small_buckets(spark):
    d = H.docs(spark, H.EDGE)
    check(H.EDGE, packing.pack(packing.token_pieces(d, size=64), size=64, bucket_rows=2).collect(), 64)
    assert packing.pack(packing.token_pieces(H.docs(spark, []))).count() == 0


@settings(max_examples=80, deadline=None)
@given(st.dictionaries(st.integers(1, 30), st.integers(1, 50), max_size=30))
def test_plan_uses_every_piece_once(counts):
    used = Counter()
    for pattern, n in packing.plan(counts, 30):
        assert sum(pattern) <= 30 and n > 0
        for x in pattern:
            used[x] += n
    assert used == Counter(counts)


def test_complements_are_exact():
    # 1000 + 500 + 300 + 248 fills 2048; so do 2000 + 48 and 1024 + 1024
    plan = packing.plan({1000: 7, 500: 7, 300: 7, 248: 7, 2000: 3, 48: 3, 1024: 4}, 2048)
    assert sum(n for _, n in plan) == 7 + 3 + 2 and all(sum(p) == 2048 for p, _ in plan)


@pytest.mark.parametrize("seed", range(3))
def test_plan_is_close_to_the_bound(seed):
    rng = random.Random(seed)
    counts = Counter(min(2048, int(rng.lognormvariate(6, 1)) + 1) for _ in range(20_000))
    least = -(-sum(k * v for k, v in counts.items()) // 2048)
    assert sum(n for _, n in packing.plan(counts, 2048)) <= least * 1.005 + 1


@settings(max_examples=60, deadline=None)
@given(st.dictionaries(st.integers(1, 40), st.integers(1, 30), min_size=1, max_size=40))
def test_plan_is_never_worse_than_best_fit(counts):
    def best_fit():
        bins = []
        for x in sorted((k for k, n in counts.items() for _ in range(n)), reverse=True):
            fits = [i for i, space in enumerate(bins) if space >= x]
            if fits:
                bins[min(fits, key=lambda i: bins[i])] -= x
            else:
                bins.append(40 - x)
        return len(bins)
    assert sum(n for _, n in packing.plan(counts, 40)) <= best_fit()
