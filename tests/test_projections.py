import numpy as np
import pytest
from test_neighbors import frame, pairwise, points

from waypost.operators import neighbors as N
from waypost.operators.projections import leaves, table_lists


def recall(got, x, keys, k):
    d = pairwise(x)
    np.fill_diagonal(d, np.inf)
    far = np.sort(d, axis=1)[:, k - 1]
    return np.mean([sum(v <= far[i] + 1e-9 for v in got[key]) / k for i, key in enumerate(keys)])


def lists_of(df):
    got: dict[str, list] = {}
    for r in df.collect():
        got.setdefault(r["key"], []).append(r["dist"])
    return got


def test_recall_of_small_leaves(spark):
    rng = np.random.default_rng(4)
    x = np.concatenate([rng.normal(size=(1500, 10)), 6 + rng.normal(size=(1500, 10)) * 0.2, np.repeat(rng.normal(size=(1, 10)), 300, 0)])
    df, keys = frame(spark, x).repartition(4).cache(), [f"k{i:04d}" for i in range(len(x))]
    method = table_lists(leaf=128, cell=600)
    got = lists_of(N.knn(df, "key", "x", 10, lists=method))
    assert recall(got, x, keys, 10) >= 0.9
    assert got == lists_of(N.knn(df.repartition(3), "key", "x", 10, lists=method))
    for r in N.knn(df.limit(0), "key", "x", 10, lists=method).collect():
        raise AssertionError(r)


def test_one_leaf_is_exact(spark):
    x = points(400, copies=True)
    want = [tuple(r) for r in N.knn(frame(spark, x), "key", "x", 5).collect()]
    got = [tuple(r) for r in N.knn(frame(spark, x), "key", "x", 5, lists=table_lists(tables=2)).collect()]
    assert sorted(got) == sorted(want)


def test_scopes_stay_apart(spark):
    x = points(700, copies=False)
    groups = np.array(["a"] * 500 + ["b"] * 150 + ["c"] * 50)
    out = N.knn(frame(spark, x, groups), "key", "x", 5, by=["g"], lists=table_lists(leaf=64, cell=200)).collect()
    scope = {f"k{i:04d}": g for i, g in enumerate(groups)}
    assert all(scope[r["key"]] == scope[r["neighbor"]] == r["g"] for r in out) and len(out) == 700 * 5


@pytest.mark.parametrize("n", [0, 1, 7, 64, 65, 1000])
def test_leaves_part_the_rows(n):
    x = np.zeros((n, 3))  # all equal
    cut = list(leaves(x, 64, np.random.default_rng(1)))
    assert sorted(i for c in cut for i in c) == list(range(n)) and all(len(c) <= 64 for c in cut)


def test_lof_by_tables_is_near_the_exact_one(spark):
    x = points(1200, d=3, seed=7, copies=False)
    exact = {r["key"]: r["lof_score"] for r in N.lof(frame(spark, x), "key", "x").collect()}
    nb = N.neighborhood(frame(spark, x), "key", "x", lists=table_lists(leaf=256, cell=500))
    near = {r["key"]: r["lof_score"] for r in N.point_scores(nb, "key", N.lof_points(nb)).collect()}
    assert near.keys() == exact.keys()
    assert np.mean([abs(near[k] / exact[k] - 1) < 0.02 for k in exact]) > 0.9
