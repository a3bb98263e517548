import random

import numpy as np
import pytest

from panelwright.llm import queries, repeats
from panelwright.llm.common import having
from panelwright.sources.tables import read_table

from ..conftest import SF_SMALL
from . import helpers as H


def expected(rows, length):
    texts = [(t or "").encode() for _, t in rows]
    out = []
    for (d, _), t, gone in zip(rows, texts, H.removed(texts, length)):
        n = int((np.diff(gone.astype(int), prepend=0) == 1).sum())
        out.append((d, len(t), int(gone.sum()), n, H.sha(bytes(np.frombuffer(t, np.uint8)[~gone]))))
    return sorted(out, key=repr)


def test_query_matches_brute_force(spark):
    rows = [(r.doc_id, r.text) for r in read_table(spark, SF_SMALL, "documents").collect()]
    assert H.bag(queries.op8_suffix_array(spark, SF_SMALL)) == expected(rows, 200)


def planted(seed):
    rng = random.Random(seed)
    base = ["".join(rng.choice("ab cd") for _ in range(rng.randrange(30, 90))) for _ in range(8)]
    rows = []
    for i in range(60):
        t = "".join(rng.choice("abcdefgh \n") for _ in range(rng.randrange(0, 60)))
        for _ in range(rng.randrange(4)):
            s = rng.choice(base)
            a = rng.randrange(len(s) // 2)
            t += s[a:a + rng.randrange(20, 90)] + "".join(rng.choice("xyz\0é") for _ in range(rng.randrange(0, 9)))
        rows.append((i, t))
    return rows + [(70, "a" * 150), (71, "ab" * 70), (72, rows[0][1]), (72, rows[0][1]), (73, rows[5][1]), (None, rows[6][1]), *H.EDGE[1:9]]


@pytest.mark.parametrize("seed,unit", [(1, 50_000), (2, 50_000), (3, 2)])
def test_short_strings_match_brute_force(spark, seed, unit):
    rows = planted(seed)
    got = repeats.remove_repeats(H.docs(spark, rows), length=24, k=8, unit_rows=unit, with_kept=True)
    full = got.collect()
    assert sorted((tuple(r)[:5] for r in full), key=repr) == expected(rows, 24)
    for r in full:
        assert H.sha(bytes(r.kept)) == r.kept_sha256 and sum(s.end - s.start for s in r.spans) == r.n_removed


def test_empty_table(spark):
    assert repeats.remove_repeats(H.docs(spark, [])).count() == 0
    assert H.bag(repeats.remove_repeats(H.docs(spark, [(1, "x")]))) == [(1, 1, 0, 0, H.sha(b"x"))]


def test_repeated_rows_stay_one_row_each(spark):
    rng = random.Random(4)
    a, b, c, d = ("".join(rng.choice("abcdefgh ") for _ in range(n)) for n in (300, 260, 240, 400))
    rows = [(1, a), (1, a), (1, a), (2, a), (None, b), (None, b), (None, b), (None, c), (3, c), (3, c), (4, d + a[20:250]), (5, b[:230] + d)]
    assert H.bag(repeats.remove_repeats(H.docs(spark, rows))) == expected(rows, 200)
    assert H.bag(repeats.remove_repeats(H.docs(spark, rows), length=24, k=8, unit_rows=2)) == expected(rows, 24)


def test_rows_of_frequent_keys_are_not_shuffled(spark):
    rows = spark.range(3000).selectExpr("id % 7 * (id % 2) as a", "id")
    counted = rows.groupBy("a").count().withColumnRenamed("count", "n").where("a <> 3")
    want = sorted(r.id for r in rows.where("a <> 3").collect())
    for hot in (100, 1000, 10_000):
        got = having(rows, counted, ["a"], hot_rows=hot)
        assert sorted(r.id for r in got.collect()) == want
        plan = got._jdf.queryExecution().optimizedPlan().toString()
        assert ("LeftAnti" in plan) == (hot < 10_000)
    assert having(rows.limit(0), counted.limit(0), ["a"]).count() == 0


def test_intervals():
    words = sorted([b"banana", b"band", b"ban", b"bandit", b"can", b"cane"])
    lcp = np.array([len(next((a[:i] for i in range(min(len(a), len(b)), -1, -1) if a[:i] == b[:i]))) for a, b in zip(words, words[1:])])
    got = {(d, tuple(words[i:j + 1])) for d, i, j in repeats.intervals(lcp, 1)}
    assert (3, (b"ban", b"banana", b"band", b"bandit")) in got and (4, (b"band", b"bandit")) in got and (3, (b"can", b"cane")) in got


def test_anchors_depend_on_the_string_alone():
    rng = np.random.default_rng(0)
    s = rng.integers(0, 4, 400).astype(np.uint8)
    a = np.concatenate([rng.integers(0, 255, 77).astype(np.uint8), s, rng.integers(0, 255, 33).astype(np.uint8)])
    pa, _ = repeats.anchors(s, 200)
    pb, _ = repeats.anchors(a, 200)
    inner = {p for p in pb.tolist() if 77 <= p <= 77 + 350}
    assert {p + 77 for p in pa.tolist()} <= inner


def maximal_repeats(texts, length):
    """{string: {(text number, start)}} of every maximal repeat, by all pairs
    of positions: two occurrences that differ, or end, on both sides."""
    found = set()
    for i, a in enumerate(texts):
        x = np.frombuffer(a, np.uint8)
        for j in range(i, len(texts)):
            y = np.frombuffer(texts[j], np.uint8)
            for shift in range(1 if i == j else 1 - len(x), len(y)):
                lo = max(0, -shift)
                n = min(len(x) - lo, len(y) - lo - shift)
                if n < length:
                    continue
                same = np.concatenate(([0], x[lo:lo + n] == y[lo + shift:lo + shift + n], [0])).astype(int)
                step = np.diff(same)
                for s, e in zip(np.flatnonzero(step == 1), np.flatnonzero(step == -1)):
                    if e - s >= length:
                        found.add(a[lo + s:lo + e])
    return {w: {(i, p) for i, t in enumerate(texts) for p in range(len(t) - len(w) + 1) if t.startswith(w, p)} for w in found}


@pytest.mark.parametrize("seed", [1, 6])
def test_groups_are_the_maximal_repeats_with_all_occurrences(spark, seed):
    rows = planted(seed)[:40] + [(70, "a" * 60), (71, "ab" * 40), (72, "q" + "ab" * 20), (None, None), (74, "")]
    rows += [(80, rows[0][1] + "tail of it, with words"), (81, rows[3][1]), (82, rows[3][1]), (None, rows[4][1])]
    at = {}
    for d, t in rows:
        at.setdefault((t or "").encode(), []).append(d)
    texts = [t for t in at if len(t) >= 24]
    want = {}
    for w, places in maximal_repeats(texts, 24).items():
        want[w] = {(min((d for d in at[texts[i]] if d is not None), default=None), len(at[texts[i]]), p) for i, p in places}
    for t in texts:
        if len(at[t]) > 1:
            want.setdefault(t, {(min((d for d in at[t] if d is not None), default=None), len(at[t]), 0)})
    reach = 96
    got, cut = {}, set()
    for r in repeats.repeat_groups(H.docs(spark, rows), length=24, k=8, reach=reach).collect():
        got.setdefault(r.group_id, []).append((r.doc_id, r.copies, r.start))
        if r.cut:
            cut.add(r.group_id)
    ids = {repeats.xxhash.xxh3_128_hexdigest(w): w for w in want}
    assert len(want) > 20
    assert {ids[g] for g in got if g not in cut} >= {w for w in want if len(w) < reach}
    for g, places in got.items():
        assert len(places) == len(set(places))
        if g not in cut:
            assert set(places) == want[ids[g]]


def test_groups_of_hot_anchors_come_in_parts(spark):
    rows = planted(3)
    got = repeats.repeat_groups(H.docs(spark, rows), length=24, k=8, reach=96, unit_rows=2).collect()
    # the rows' bytes in a group are the bytes that remove_repeats takes
    gone = {}
    for r in got:
        gone.setdefault((r.doc_id, r.copies), set()).update(range(r.start, r.start + r.n_bytes))
    by_text = {}
    for d, t in rows:
        by_text.setdefault((t or "").encode(), []).append(d)
    taken = H.removed([t.encode() if t else b"" for _, t in rows], 24)
    for (_, t), g in zip(rows, taken):
        ids = by_text[(t or "").encode()]
        key = (min((d for d in ids if d is not None), default=None), len(ids))
        assert set(np.flatnonzero(g).tolist()) <= gone.get(key, set())
    assert repeats.repeat_groups(H.docs(spark, [])).count() == 0
