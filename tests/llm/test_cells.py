"""Near-duplicate vectors against all pairs."""

from __future__ import annotations

from collections import defaultdict

import numpy as np
import pytest

from hourline.llm import cells
from hourline.llm.common import ready


@pytest.fixture(scope="module", autouse=True)
def shipped(spark):
    ready(spark)


def plain(rows, threshold):
    sound = defaultdict(list)
    for at, (_, v, label) in enumerate(rows):
        if label is not None and v and None not in v and np.isfinite(v).all() and any(v):
            sound[label, len(v)].append(at)
    links, root = [0] * len(rows), list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for group in sound.values():
        x = np.array([rows[i][1] for i in group], float)
        x /= np.abs(x).max(axis=1)[:, None]
        x /= np.linalg.norm(x, axis=1)[:, None]
        for i, j in zip(*np.nonzero(x @ x.T >= threshold), strict=True):
            if i != j:
                links[group[i]] += 1
                root[find(group[i])] = find(group[j])
    least = {}
    for i, (key, _, _) in enumerate(rows):
        r = find(i)
        least[r] = min((k for k in (least.get(r), key) if k is not None), default=None)
    return sorted(((k, links[i], least[find(i)], k == least[find(i)]) for i, (k, _, _) in enumerate(rows)), key=str)


def vectors(n, dims, seed):
    """Loose vectors, chains of near ones, a tight group and copies."""
    draw = np.random.default_rng(seed)
    rows, key = [], 0
    while len(rows) < n:
        v = draw.normal(size=dims)
        for _ in range(draw.choice([1, 1, 1, 2, 12])):
            rows.append((key, v.tolist(), int(draw.integers(0, 2))))
            key += 1
            v = v + draw.normal(size=dims) * draw.choice([0.05, 0.12, 0.2])
    v = draw.normal(size=dims)
    for i in range(n // 3):
        rows.append((key + i, (v + draw.normal(size=dims) * 0.03).tolist(), 1))
    rows += [(key + n + i, v.tolist(), 1) for i in range(20)] + [(key + 2 * n, (v * 1e200).tolist(), 1)]
    return rows


@pytest.mark.parametrize("dims", [3, 16])
def test_equals_all_pairs(spark, monkeypatch, dims):
    for name, value in dict(CELL=40, PER_CENTRE=10, SAMPLE=200, PER_TASK=50, BLOCK=16, SLICE=64).items():
        monkeypatch.setattr(cells, name, value)
    rows = vectors(600, dims, dims)
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], "vec_id long, embedding array<double>, label int, node string, home int")
    out = cells.near_vectors(df)
    assert out.columns == ["vec_id", "n_links", "component_id", "kept"]
    assert sorted(map(tuple, out.collect()), key=str) == plain(rows, 0.98)


def test_division_happens_and_keeps_every_home(spark, monkeypatch):
    for name, value in dict(CELL=40, PER_CENTRE=10, SAMPLE=200, PER_TASK=50).items():
        monkeypatch.setattr(cells, name, value)
    draw = np.random.default_rng(5)
    rows = [(i, (x / np.linalg.norm(x)).astype("<f8").tobytes()) for i, x in enumerate(draw.normal(size=(500, 4)))]
    start = spark.createDataFrame(rows, "node long, unit binary").selectExpr(
        "1 AS label", "4 AS dim", "'' AS path", "node", "true AS home", "false AS final", "1L AS weight", "unit")
    members = cells._divided(start, 0.199)[0].toPandas()
    assert sorted(members[members.home].node) == list(range(500)) and members.path.nunique() > 10
    assert len(members) < 500 * members.path.nunique() * 0.6


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (1, None, 1), (2, [], 1), (3, [0.0, 0.0], 1), (4, [1.0, None], 1), (5, [nan, 1.0], 1), (6, [inf, 1.0], 1), (7, [1.0, 0.0], None),
        (8, [1.0, 0.0], None), (9, [1.0, 0.0], 2), (9, [1.0, 0.0], 2), (10, [5.0, 0.1], 2), (11, [1.0, 0.0, 0.0], 2), (12, [1.0, 0.0], 3),
        (None, [2.0, 0.0], 3), (None, [0.0, 7.0], 3), (13, [1e-300, 1e-301], 4), (14, [1e300, 1e299], 4), (15, [-1.0, 0.0], 2),
    ]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    expected = plain(rows, 0.98)
    out = sorted(((*tuple(r)[:3], bool(r["kept"]) if r["vec_id"] is not None else None) for r in cells.near_vectors(df).collect()), key=str)
    assert out == sorted(((k, n, c, kept if k is not None else None) for k, n, c, kept in expected), key=str)
    assert cells.near_vectors(df.where("false")).count() == 0
