"""Operators on vectors against all pairs in numpy."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallyward.llm import vectors

NAN, INF = float("nan"), float("inf")
ODD = [None, [], [0.0] * 16, [NAN] + [1.0] * 15, [INF] + [1.0] * 15, [None] + [1.0] * 15, [1.0, 2.0], [2.0, 4.0]]


def points(seed=1):
    rng = np.random.default_rng(seed)
    centres = rng.standard_normal((12, 16))
    near = np.concatenate([c + 0.25 * rng.standard_normal((25, 16)) for c in centres])
    return np.concatenate((near, rng.standard_normal((200, 16)), near[:5], 3 * near[:3])).astype(np.float32).astype(float)


@pytest.fixture(scope="module")
def table(spark):
    data = [(i, x, "clash") for i, x in enumerate([*points().tolist(), *ODD])]
    df = spark.createDataFrame(data, "vec_id long, embedding array<float>, label string")
    return df.withColumns({c: F.lit("clash") for c in ("id", "n", "v", "t", "bucket", "block")}).repartition(3)


def check_links(table, got):
    x = points()
    unit = x / np.linalg.norm(x, axis=1, keepdims=True)
    near = unit @ unit.T >= 0.9
    np.fill_diagonal(near, False)
    label = np.arange(len(x))
    while True:
        new = np.minimum(label, np.where(near, label[None, :], 1 << 60).min(axis=1))
        if (new == label).all():
            break
        label = new
    want = {i: (int(near[i].sum()), int(label[i])) for i in range(len(x))}
    n = len(x)
    want |= {n + i: (0, n + i) for i in range(len(ODD) - 2)} | {n + 6: (1, n + 6), n + 7: (1, n + 6)}
    assert {r.vec_id: (r.n_links, r.component_id) for r in got} == want
    assert all(r.kept == (r.vec_id == r.component_id) for r in got)
    assert near.sum() > 500


def test_near_duplicates(table):
    check_links(table, vectors.near_duplicates(table).collect())


def test_near_duplicates_in_blocks(table, monkeypatch):
    monkeypatch.setattr(vectors, "BLOCK", 7)
    check_links(table, vectors.near_duplicates(table).collect())


def test_repeated_and_empty(spark):
    df = spark.createDataFrame([(1, [1.0, 0.0]), (1, [1.0, 0.0]), (None, [1.0, 0.0]), (0, [2.0, 0.0])], "vec_id long, embedding array<double>")
    got = sorted((tuple(r) for r in vectors.near_duplicates(df).collect()), key=str)
    assert got == [(0, 2, 0, True), (1, 2, 0, False), (1, 2, 0, False), (None, 0, None, True)]
    assert vectors.near_duplicates(df.limit(0)).collect() == []
    assert vectors.nearest(df.limit(0), F.lit(True)).collect() == []


def test_nearest(table, monkeypatch):
    monkeypatch.setattr(vectors, "ROWS", 150)
    monkeypatch.setattr(vectors, "QUERIES", 4)
    x = points()
    got = vectors.nearest(table, F.col("vec_id") % 10 == 0).collect()
    found = total = 0
    for q in range(0, len(x), 10):
        away = np.sqrt(((x - x[q]) ** 2).sum(axis=1))
        away[q] = np.inf
        best = np.lexsort((np.arange(len(x)), away))[:10].tolist()
        own = sorted((r for r in got if r.query_id == q), key=lambda r: r["rank"])
        assert [r["rank"] for r in own] == list(range(1, 11))
        assert [(r.score, r.vec_id) for r in own] == sorted((r.score, r.vec_id) for r in own)
        assert all(abs(r.score - away[r.vec_id]) < 1e-12 for r in own)
        found += len({r.vec_id for r in own} & set(best))
        total += 10
    assert found >= 0.9 * total


def test_nearest_with_few_rows_and_ties(spark):
    df = spark.createDataFrame([(0, [0.5, 1.0]), (5, [1.0, 1.0]), (3, [1.0, 1.0]), (9, None)], "vec_id long, embedding array<double>")
    got = [tuple(r) for r in vectors.nearest(df, F.col("vec_id") == 0).orderBy("rank").collect()]
    assert got == [(0, 1, 3, 0.5), (0, 2, 5, 0.5)]


def test_chi_square_and_cells():
    assert vectors.chi_square(0.95, 8) == pytest.approx(15.507, abs=1e-3)
    rng = np.random.default_rng(0)
    lines = rng.standard_normal(200_000)
    shift = rng.uniform(0, 2, 200_000)
    same = (np.floor(shift / 2) == np.floor((shift + 0.7 * lines) / 2)).mean()
    assert vectors.same_cell(0.7, 2.0) == pytest.approx(same, abs=5e-3)
