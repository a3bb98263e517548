import numpy as np
import pytest

from panelwright.llm import projections
from . import helpers as H


def expected(rows, threshold=0.95):
    unit = []
    for _, v in rows:
        ok = v is not None and len(v) and all(x is not None and np.isfinite(x) for x in v) and any(x != 0 for x in v)
        unit.append(np.array(v, float) / np.linalg.norm(np.array(v, float)) if ok else None)
    links = [(i, j) for i in range(len(rows)) for j in range(i) if unit[i] is not None and unit[j] is not None
             and len(unit[i]) == len(unit[j]) and float(unit[i] @ unit[j]) >= threshold]
    n = np.bincount([x for p in links for x in p], minlength=len(rows))
    label = H.reachable(range(len(rows)), links)
    first = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            first[label[i]] = min(d, first.get(label[i], d))
    return [(d, int(n[i]), first.get(label[i])) for i, (d, _) in enumerate(rows)]


def clustered(seed, n=400, dim=64):
    rng = np.random.default_rng(seed)
    rows = []
    for i in range(n):
        if i and rng.random() < 0.5:
            c = np.array(rows[rng.integers(len(rows))][1])
            rows.append((i, (c + rng.standard_normal(dim) * rng.choice([0, 0.02, 0.04]) * np.linalg.norm(c) / 1).tolist()))
        else:
            rows.append((i, rng.standard_normal(dim).tolist()))
    return rows


@pytest.mark.parametrize("tile", [4096, 60])
def test_matches_brute_force(spark, tile):
    rows = clustered(1)
    want = expected(rows)
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    rows = [(r.vec_id, [float(x) for x in r.embedding]) for r in df.collect()]
    want = expected(rows)
    assert sum(w[1] for w in want) > 100
    got = sorted(tuple(r) for r in projections.near_duplicates(df, tile_rows=tile).collect())
    found, links = sum(g[1] for g in got), sum(w[1] for w in want)
    assert found >= 0.98 * links and all(g[1] <= w[1] for g, w in zip(got, sorted(want)))
    if found == links:
        assert got == sorted(want)


def test_edge_rows(spark):
    rows = [(1, [1.0, 2.0, 3.0]), (2, [2.0, 4.0, 6.0]), (3, None), (4, [0.0, 0.0, 0.0]), (5, [1.0, None, 2.0]), (6, [float("nan"), 1.0, 1.0]),
            (7, [float("inf"), 1.0, 1.0]), (8, []), (9, [1.0, 2.0]), (10, [-1.0, -2.0, -3.0]), (2, [2.0, 4.0, 6.0]), (None, [1.0, 2.0, 3.001]),
            (None, None), (11, [1e200, 0.0, 0.0]), (12, [1e-200, 0.0, 0.0]), (13, [3.0, 6.0])]
    df = spark.createDataFrame([(*r, 1, "x") for r in rows], "vec_id long, embedding array<double>, label int, vec string")
    got = H.bag(projections.near_duplicates(df))
    want = expected([r if r[0] not in (11, 12) else (r[0], [1.0, 0.0, 0.0]) for r in rows])
    assert got == sorted(want, key=repr)
    assert projections.near_duplicates(df.where("vec_id = 99")).count() == 0


def test_window_has_the_wanted_recall():
    rng = np.random.default_rng(0)
    w = projections.window(0.95)
    d = np.sqrt(0.1)
    z = np.abs(rng.standard_normal((20_000, projections.PROJECTIONS)) * d)
    assert ((z > w).sum(axis=1) <= projections.MISSES).mean() > 0.996
