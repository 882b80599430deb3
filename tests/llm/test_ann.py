import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from waypost.llm import ann


def exact(ids, vecs, query, k=10):
    at = ids.index(query)
    dist = np.sqrt(((vecs - vecs[at]) ** 2).sum(1))
    order = [i for i in np.lexsort((ids, dist)) if ids[i] != query]
    return [(ids[i], dist[i]) for i in order[:k]]


def test_chi_square():
    assert ann.chi_square_cdf(np.array(0.0)) == 0
    for p in (0.5, 0.9, 0.99):
        assert float(ann.chi_square_cdf(np.array(ann.chi_square_quantile(p)))) == pytest.approx(p, abs=1e-9)
    draws = (np.random.default_rng(1).normal(size=(200_000, ann.M)) ** 2).sum(1)
    assert (draws < ann.chi_square_quantile(0.9)).mean() == pytest.approx(0.9, abs=0.005)


def test_tree_visits_every_leaf_in_reach():
    rng = np.random.default_rng(5)
    points = rng.normal(size=(3_000, ann.M))
    tree = ann.grow(points, 40)
    leaf = ann.leaf_of(tree, points)
    assert leaf.min() == 0 and leaf.max() == len(tree.low) - 1 and np.bincount(leaf).max() < 300
    for q in points[:30]:
        for reach in (0.0, 0.5, 2.0, math.inf):
            near = np.sqrt(((points - q) ** 2).sum(1)) <= reach
            assert set(leaf[near]) <= set(ann.leaves_within(tree, q, reach).tolist())


def test_tree_of_equal_points():
    tree = ann.grow(np.ones((100, ann.M)), 8)
    assert len(tree.low) == 1 and (ann.leaf_of(tree, np.ones((3, ann.M))) == 0).all()
    assert len(ann.grow(np.empty((0, ann.M)), 4).low) == 1


@pytest.mark.parametrize("confidence", [0.98, 0.9999999])
def test_recall(spark, monkeypatch, confidence):
    monkeypatch.setattr(ann, "CROWD", 7)
    rng = np.random.default_rng(9)
    centres = rng.normal(size=(12, 24)) * 3
    vecs = centres[rng.integers(0, 12, 1_500)] + rng.normal(size=(1_500, 24))
    vecs[40:400] = vecs[40]  # a third of the rows alike
    ids = list(range(1_500))
    df = spark.createDataFrame([(i, v.tolist()) for i, v in zip(ids, vecs)], "vec_id bigint, embedding array<double>").repartition(4)
    got = {}
    for r in ann.nearest(df, F.col("vec_id") % 50 == 0, confidence=confidence, leaf_rows=100).collect():
        got.setdefault(r.query_id, []).append((r.rank, r.vec_id, r.score))
    hit = total = 0
    for q in range(0, 1_500, 50):
        rows = sorted(got[q])
        assert [r for r, _, _ in rows] == list(range(1, 11))
        assert [(s, v) for _, v, s in rows] == sorted((s, v) for _, v, s in rows)
        want = exact(ids, vecs, q)
        hit += len({v for _, v, _ in rows} & {v for v, _ in want})
        total += 10
    assert hit / total >= (0.9 if confidence < 0.99 else 1.0)


def test_edges(spark):
    schema = "vec_id bigint, embedding array<float>, id string, leaf string, p string, q string"
    rows = [(0, [1.0, 0.0]), (1, [0.0, 1.0]), (2, None), (3, [0.0, 0.0]), (4, [1.0, None]), (5, [float("nan"), 1.0]), (6, [float("inf"), 1.0]), (7, [1.0]), (None, [1.0, 1.0]), (8, [0.0, 1.0]), (8, [0.0, 1.0]), (100, None), (200, [1.0, 0.0])]
    df = spark.createDataFrame([(i, v, "a", "b", "c", "d") for i, v in rows], schema)
    got = sorted(tuple(r) for r in ann.nearest(df, F.col("vec_id") % 100 == 0).collect())
    two = math.sqrt(2.0)
    assert got == [(0, 1, 200, 0.0), (0, 2, 1, two), (0, 3, 8, two), (0, 4, 8, two), (200, 1, 0, 0.0), (200, 2, 1, two), (200, 3, 8, two), (200, 4, 8, two)]
    assert ann.nearest(df.where("false"), F.col("vec_id") % 100 == 0).count() == 0
    assert ann.nearest(df.where("vec_id = 0"), F.col("vec_id") % 100 == 0).count() == 0
