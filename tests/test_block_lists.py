import numpy as np
import pytest
from pyspark.sql import functions as F

from waypost.operators import block_lists as B
from waypost.operators import neighbors as N


def grid(n=700, d=3, seed=3):
    """Whole places, so that many distances are equal."""
    x = np.unique(np.random.default_rng(seed).integers(0, 12, size=(n, d)).astype(float), axis=0)
    return np.random.default_rng(seed).permutation(x)


def brute(x, keys, k):
    d = np.sqrt(((x[:, None, :] - x[None, :, :]) ** 2).sum(-1))
    return {keys[i]: [keys[j] for j in np.lexsort((keys, d[i])) if j != i][:k] for i in range(len(x))}


def held(x, keys):
    rows, starts = B.leaves_of(x)
    return B.Points(x[rows], keys[rows], np.ones(len(x), np.int64), starts)


@pytest.mark.parametrize("kind", [np.float64, np.float32])
@pytest.mark.parametrize("far", [0.0, 1e6])
def test_best_is_exact_with_ties(kind, far):
    x = (grid() + far).astype(kind)
    keys = np.random.default_rng(0).permutation(len(x)).astype(np.int64)
    points = held(x, keys)
    best = B.Best(points, 8, B.first_reach(points, 8))
    for part in np.array_split(np.arange(len(x)), 5):
        best.look(held(x[part], keys[part]))
    want = brute(x.astype(float), keys, 7)
    assert {int(p): [int(o) for o in row if o != p] for p, row in zip(points.key, best.key)} == want


@pytest.mark.filterwarnings("ignore::RuntimeWarning")
def test_outliers_and_missing_numbers_hide_no_neighbour():
    x = np.random.default_rng(1).normal(size=(900, 5))
    x[7], x[8, 2], x[9, 0] = 1e150, np.nan, np.inf
    points = held(x, np.arange(900))
    best = B.Best(points, 6, B.first_reach(points, 6))
    best.look(points)
    plain = np.setdiff1d(np.arange(900), [7, 8, 9])
    want = brute(x[plain], plain, 5)
    got = {int(p): [int(o) for o in row if o != p] for p, row in zip(points.key, best.key)}
    assert all(got[int(p)] == want[p] for p in plain)


def test_places_and_boxes():
    rng = np.random.default_rng(2)
    for shape in [(3, 5), (64, 64), (7, 1)]:
        mask = rng.random(shape) < 0.2
        assert B.places(mask).tolist() == np.flatnonzero(mask).tolist()
    lo, other = rng.normal(size=(40, 3)), rng.normal(size=(50, 3))
    gaps = np.sqrt((np.maximum(np.maximum(other[None] - lo[:, None] - 0.1, lo[:, None] - other[None] - 0.1), 0) ** 2).sum(-1))
    far = gaps[:, 0].copy()
    near = B.boxes_near(lo, lo + 0.1, other, other + 0.1, far)
    assert near[gaps <= far[:, None]].all() and not near[gaps > far[:, None] * 1.001 + 1e-5].any()


@pytest.mark.parametrize("d", [3, 24])
def test_exact_lists_send_a_block_to_a_task_once(spark, monkeypatch, d):
    """no query is sent to a block, and no found pair leaves its task before the list is done."""
    monkeypatch.setattr(N, "_search", None)
    monkeypatch.setattr(N, "_local", None)
    x = grid() if d == 3 else np.random.default_rng(5).normal(size=(500, d))
    df = spark.createDataFrame([(f"k{i:04d}", v.tolist()) for i, v in enumerate(x)], "key string, x array<double>")
    nb = N.neighborhood(df, "key", "x", block_rows=60)
    names = {r["p"]: r["name"] for r in nb.points.collect()}
    got = {}
    for r in nb.edges.orderBy("p", "dist", "o").collect():
        assert r["before"] == len(got.setdefault(names[r["p"]], []))
        got[names[r["p"]]].append(names[r["o"]])
    assert got == brute(x, np.array([f"k{i:04d}" for i in range(len(x))]), 20)


def test_copies_are_counted_in_the_lists(spark):
    x = np.repeat(grid(300), 3, axis=0)
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "key long, x array<double>")
    one = N.neighborhood(df, "key", "x", block_rows=40).edges
    other = N.neighborhood(df, "key", "x", block_rows=5000).edges
    assert one.count() > 0 and one.exceptAll(other.select(one.columns)).count() == other.select(one.columns).exceptAll(one).count() == 0


def written_vectors(monkeypatch, run):
    """Tables written while ``run`` builds and writes its result, with their columns that hold vectors."""
    seen = []

    def materialize(df):
        seen.append([c for c, kind in df.dtypes if kind.startswith("array<") or c == "x"])
        return write(df)

    write = N.materialize
    monkeypatch.setattr(N, "materialize", materialize)
    monkeypatch.setattr(B, "materialize", materialize)
    monkeypatch.setattr(N, "_search", None)
    run().collect()
    return [s for s in seen if s]


def vectors(folder, spark, n=600):
    """A table of vectors with copies, read from its files."""
    x = np.random.default_rng(8).normal(size=(n, 6)).astype(np.float32)
    x[n - 60 :] = x[:60]
    spark.createDataFrame([(i, v.tolist(), i % 3) for i, v in enumerate(x)], "vec_id long, embedding array<float>, label int").write.parquet(f"{folder}/embeddings.parquet")
    return str(folder)


def test_blocked_vectors_are_written_once_and_packed(spark, tmp_path, monkeypatch):
    """no copy of the vectors but the distinct ones and their packed blocks."""
    from waypost.plans import registry

    registry.load_all()
    sf = vectors(tmp_path, spark)
    found = written_vectors(monkeypatch, lambda: registry.QUERIES["knn_vectors_blocked"](spark, sf))
    assert found == [["x"], ["x"]]


def test_copies_of_vectors_are_not_written(spark, tmp_path, monkeypatch):
    """of the rows with copies only the distinct vectors are written."""
    from waypost.plans import registry

    registry.load_all()
    sf = vectors(tmp_path, spark)
    found = written_vectors(monkeypatch, lambda: registry.QUERIES["knn_with_copies"](spark, sf))
    assert found == [["x"]]


def test_vectors_of_a_table_are_not_written_again(spark, tmp_path, monkeypatch):
    """only the distinct vectors are written."""
    from waypost.plans import registry

    registry.load_all()
    sf = vectors(tmp_path, spark)
    found = written_vectors(monkeypatch, lambda: registry.QUERIES["knn_vectors"](spark, sf))
    assert found == [["x"]]
