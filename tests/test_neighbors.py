import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from waypost.operators import neighbors as N


def frame(spark, x, groups=None):
    rows = [(f"k{i:04d}", groups[i] if groups is not None else "g", v.tolist()) for i, v in enumerate(x)]
    return spark.createDataFrame(rows, "key string, g string, x array<double>")


def points(n=600, d=4, seed=0, copies=True):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, d))
    x[: n // 4] += 4
    if copies:
        x[n // 2 : n // 2 + n // 3] = x[0]  # a third of all rows are copies
    return x


def pairwise(x):
    return np.sqrt(((x[:, None, :] - x[None, :, :]) ** 2).sum(-1))


def brute_lof(x, k):
    d = pairwise(x)
    np.fill_diagonal(d, np.inf)
    order = np.argsort(d, axis=1, kind="stable")[:, :k]
    dist = np.take_along_axis(d, order, axis=1)
    reach = np.maximum(dist[:, -1][order], dist)
    lrd = 1 / (reach.mean(1) + 1e-10)
    return lrd[order].mean(1) / lrd


def brute_dbscan(x, m, eps):
    d = pairwise(x)
    near = d <= eps
    core = near.sum(1) >= m
    label = np.full(len(x), -1)
    for i in range(len(x)):
        if core[i] and label[i] < 0:
            todo, label[i] = [i], i
            while todo:
                for b in np.flatnonzero(near[todo.pop()] & core):
                    if label[b] < 0:
                        label[b] = i
                        todo.append(b)
    for i in np.flatnonzero(~core):
        hit = np.flatnonzero(near[i] & core)
        label[i] = label[hit].min() if len(hit) else -1
    return core, label, d


@pytest.mark.parametrize("block_rows", [64, 2048])
def test_knn_is_exact_with_copies_and_blocks(spark, block_rows):
    x = points()
    d = pairwise(x)
    np.fill_diagonal(d, np.inf)
    want = {f"k{i:04d}": [f"k{j:04d}" for j in np.argsort(d[i], kind="stable")[:6]] for i in range(len(x))}
    got: dict[str, dict] = {}
    for r in N.knn(frame(spark, x), "key", "x", 6, block_rows=block_rows).collect():
        got.setdefault(r["key"], {})[r["place"]] = r["neighbor"]
    assert {k: [v[p] for p in sorted(v)] for k, v in got.items()} == want


def test_knn_by_scope(spark):
    x = points(300, copies=False)
    groups = np.array(["a"] * 200 + ["b"] * 60 + ["c"] * 40)
    got: dict[str, set] = {}
    for r in N.knn(frame(spark, x, groups), "key", "x", 3, by=["g"], block_rows=50).collect():
        got.setdefault(r["key"], set()).add(r["neighbor"])
    for g in "abc":
        rows = np.flatnonzero(groups == g)
        d = pairwise(x[rows])
        np.fill_diagonal(d, np.inf)
        for i, row in enumerate(rows):
            assert got[f"k{row:04d}"] == {f"k{rows[j]:04d}" for j in np.argsort(d[i], kind="stable")[:3]}


@pytest.mark.parametrize("block_rows", [50, 2048])
def test_within_radius(spark, block_rows):
    x = points()
    want = (pairwise(x) <= 1.1).sum(1)
    got = {r["key"]: r["n_within"] for r in N.within_radius_count(frame(spark, x), "key", "x", 1.1, block_rows=block_rows).collect()}
    assert [got[f"k{i:04d}"] for i in range(len(x))] == want.tolist()


@pytest.mark.parametrize("block_rows", [50, 2048])
def test_lof(spark, block_rows):
    x = points(copies=False)
    got = {r["key"]: r["lof_score"] for r in N.lof(frame(spark, x), "key", "x", block_rows=block_rows).collect()}
    np.testing.assert_allclose([got[f"k{i:04d}"] for i in range(len(x))], brute_lof(x, 20), rtol=1e-9)


def test_lof_of_copies(spark):
    x = points()
    got = {r["key"]: r["lof_score"] for r in N.lof(frame(spark, x), "key", "x").collect()}
    np.testing.assert_allclose([got[f"k{i:04d}"] for i in range(len(x))], brute_lof(x, 20), rtol=1e-6)


@pytest.mark.parametrize("block_rows", [60, 2048])
def test_dbscan(spark, block_rows):
    x = points(500)
    n = len(x)
    m = max(5, math.ceil(math.log(n)) + 1)
    eps = np.quantile(np.sort(pairwise(x), axis=1)[:, m - 1], 0.95)
    core, label, d = brute_dbscan(x, m, eps)
    df = frame(spark, x)
    nb = N.neighborhood(df, "key", "x", block_rows=block_rows)
    params = N.dbscan_params(nb).first()
    assert params["min_samples"] == m and params["eps"] == pytest.approx(eps, rel=1e-12)
    keys = [f"k{i:04d}" for i in range(n)]
    noise = {r["key"]: (r["core"], r["dbscan_anomaly"]) for r in N.dbscan_noise(df, "key", "x", block_rows=block_rows).collect()}
    assert [noise[k] for k in keys] == [(int(c), int(v < 0)) for c, v in zip(core, label)]
    joint, _ = N.density_points(nb)
    both = {r["key"]: r["dbscan_anomaly"] for r in N.point_scores(nb, "key", joint).collect()}
    assert [both[k] for k in keys] == [int(v < 0) for v in label]
    cluster = {r["key"]: r["cluster"] for r in N.dbscan_clusters(df, "key", "x", block_rows=block_rows).collect()}
    assert [cluster[k] for k in keys] == [None if v < 0 else f"k{v:04d}" for v in label]
    sev = {r["key"]: r["dbscan_severity"] for r in N.core_distance(df, "key", "x", block_rows=block_rows).collect()}
    np.testing.assert_allclose([sev[k] for k in keys], d[:, core].min(1), atol=1e-12)


def test_visits_reach_every_box_that_counts():
    """Several hundred small boxes: the same pairs as testing all boxes, and few of them for the nearest point."""
    rng = np.random.default_rng(12)
    corner = np.sort(rng.uniform(0, 100, (500, 3)), axis=0)
    lo, hi = corner, corner + rng.uniform(0, 2, (500, 3))
    x, reach = rng.uniform(0, 100, (200, 3)), rng.uniform(0, 30, 200)
    gaps = np.sqrt((np.maximum(np.maximum(lo[None] - x[:, None], x[:, None] - hi[None]), 0) ** 2).sum(2))
    want = {tuple(p) for p in np.argwhere(gaps <= reach[:, None])}
    assert set(zip(*N._visits(x, reach.copy(), lo, hi))) == want
    qi, bi = N._visits(x, np.full(200, np.inf), lo, hi, nearest=True)
    assert {(i, int(gaps[i].argmin())) for i in range(200)} <= set(zip(qi.tolist(), bi.tolist()))
    far = np.sqrt((np.maximum(np.abs(lo[None] - x[:, None]), np.abs(hi[None] - x[:, None])) ** 2).sum(2))
    needed = (gaps <= far.min(1)[:, None]).sum()  # with the best reach that boxes alone can give
    assert needed <= len(qi) < 3 * needed


def test_connected_components(spark):
    # One long chain, one hub with a third of all links, one pair.
    links = [(f"c{i:03d}", f"c{i + 1:03d}") for i in range(60)] + [("h000", f"h{i:03d}") for i in range(1, 40)] + [("z1", "z2")]
    df = spark.createDataFrame(links, "a string, b string")
    got = {r["a"]: r["label"] for r in N.connected_components(df).collect()}
    assert {got[k] for k in got if k.startswith("c")} == {"c000"}
    assert {got[k] for k in got if k.startswith("h")} == {"h000"}
    assert got["z2"] == "z1"


def test_nearest_kernel_handles_ties():
    x = np.array([[0.0], [1.0], [1.0], [-1.0], [2.0], [1.0]] + [[50.0 + i] for i in range(40)])
    idx, dist = N._nearest(x[:1], x, 4)
    assert idx[0].tolist() == [0, 1, 2, 3] and dist[0].tolist() == [0.0, 1.0, 1.0, 1.0]

def test_hubs_are_spread(spark):
    """A star of a third of all nodes: no task of the joins gets much more than the others, and labels are right."""
    from pyspark.sql import functions as F

    from waypost.operators.joins import join_hot
    from waypost.session import materialize

    n = 30_000
    star = spark.range(1, n).select(F.lit(0).cast("bigint").alias("a"), F.col("id").alias("b"))
    chains = spark.range(n, 3 * n).select(F.col("id").alias("a"), (F.col("id") + F.when(F.col("id") % 10 == 9, 0).otherwise(1)).alias("b")).where("a <> b")
    edges = materialize(star.unionAll(chains).repartition(16))
    labels = {r["a"]: r["label"] for r in N.connected_components(edges).collect()}
    assert all(labels[i] == 0 for i in range(1, n, 997)) and all(labels[i] == i - i % 10 for i in range(n + 1, 3 * n, 991) if i % 10)
    degree = materialize(edges.groupBy("a").agg(F.min("b").alias("m"), F.count(F.lit(1)).alias("n")))
    sizes = [r["count"] for r in join_hot(edges, degree, ["a"], "n").groupBy(F.spark_partition_id()).count().collect()]
    assert sum(sizes) == edges.count() and max(sizes) <= 2 * np.median(sizes)
