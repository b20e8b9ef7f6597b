"""Embedding links and components against all pairs."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from caldim.llm import embeddings as E


def plain(rows, limit=0.93):
    ok = [
        lab is not None and v is not None and len(v) > 0 and all(x is not None and np.isfinite(x) for x in v) and any(v)
        for _, v, lab in rows
    ]
    n, links, par = len(rows), [0] * len(rows), list(range(len(rows)))

    def find(x):
        while par[x] != x:
            x = par[x]
        return x

    for i in range(n):
        for j in range(i + 1, n):
            if ok[i] and ok[j] and rows[i][2] == rows[j][2] and len(rows[i][1]) == len(rows[j][1]):
                a, b = np.array(rows[i][1], float), np.array(rows[j][1], float)
                if a @ b / np.linalg.norm(a) / np.linalg.norm(b) >= limit:
                    links[i] += 1
                    links[j] += 1
                    par[find(i)] = find(j)
    ids = {}
    for k, r in enumerate(rows):
        if r[0] is not None:
            ids[find(k)] = min(ids.get(find(k), r[0]), r[0])
    return sorted((r[0] if r[0] is not None else -1, links[k], c if (c := ids.get(find(k))) is not None else -1) for k, r in enumerate(rows))


def made(seed=1):
    rng = np.random.default_rng(seed)
    rows = []
    for g in range(25):
        c = rng.standard_normal(64)
        c /= np.linalg.norm(c)
        for _ in range(12):  # about the limit: a step of the length that it allows
            d = rng.standard_normal(64)
            rows.append((len(rows), (c + d / np.linalg.norm(d) * rng.uniform(0, 0.45)).tolist(), g % 3))
    same = rows[0][1]
    rows += [(1000 + k, same, 0) for k in range(20)] + [(1100, [3 * x for x in same], 0), (1101, same, 1), (1101, same, 1)]
    rows += [(1200, None, 0), (1201, [0.0] * 64, 0), (1202, [float("nan")] + same[1:], 0), (1203, [None] + same[1:], 0)]
    rows += [(1204, same, None), (1205, [float("inf")] * 64, 0), (1206, [], 0), (1207, [1.0, 0.0], 0), (1208, [1.0, 0.001], 0), (None, same, 0)]
    return rows


@pytest.mark.parametrize("block", [2048, 8])
def test_matches_all_pairs(spark, monkeypatch, block):
    """Also with cells cut into many blocks."""
    monkeypatch.setattr(E, "BLOCK", block)
    rows = made()
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int").withColumn("links", F.lit("clash"))
    got = E.near_duplicates(df).collect()
    assert sorted((-1 if r.vec_id is None else r.vec_id, r.n_links, -1 if r.component_id is None else r.component_id) for r in got) == plain(rows)
    assert all(r.kept == (r.vec_id == r.component_id) for r in got if r.vec_id is not None)
    assert E.near_duplicates(df.limit(0)).count() == 0


def test_least_count_is_calibrated():
    """Pairs at the limit pass as often as asked for, others rarely."""
    rng = np.random.default_rng(2)
    u = rng.standard_normal((4000, 64))
    u /= np.linalg.norm(u, axis=1, keepdims=True)
    d = rng.standard_normal(u.shape)
    d -= (d * u).sum(1, keepdims=True) * u
    d /= np.linalg.norm(d, axis=1, keepdims=True)
    v = 0.931 * u + np.sqrt(1 - 0.931**2) * d
    i, j = E.block_links(u, v, 0.93, E.PROJECTIONS, E.least_count(E.PROJECTIONS, E.RECALL))
    assert (i == j).sum() >= 3999 and (i == j).all()


def test_forest():
    assert E.forest(6, np.array([5, 3, 1]), np.array([3, 4, 0])).tolist() == [0, 0, 2, 3, 3, 3]
