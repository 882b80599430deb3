import numpy as np
from pyspark.sql import functions as F

from waypost.operators.ordering import global_rank, sample_n
from waypost.operators.stats import quantiles


def test_quantiles_match_numpy(spark):
    rng = np.random.default_rng(1)
    # A third of the rows share one value; another column is heavily skewed.
    a = np.where(np.arange(3000) % 3 == 0, 5.0, rng.normal(size=3000))
    b = rng.exponential(size=3000) ** 3
    g = np.where(np.arange(3000) % 10 < 7, "x", "y")
    df = spark.createDataFrame([(str(k), float(u), float(v)) for k, u, v in zip(g, a, b)], "g string, a double, b double")
    qs = [0.0, 0.05, 0.5, 0.95, 1.0]
    got = {r["g"]: r for r in quantiles(df, ["a", "b"], qs, ["g"]).collect()}
    for k in "xy":
        for name, values in (("a", a), ("b", b)):
            np.testing.assert_allclose(got[k][name], np.quantile(values[g == k], qs), rtol=1e-12)
    whole = quantiles(df, ["a"], qs).first()["a"]
    np.testing.assert_allclose(whole, np.quantile(a, qs), rtol=1e-12)


def test_weighted_quantiles_agree(spark):
    rows = [(float(v), w) for v, w in zip([1, 2, 5, 9], [3, 1, 4, 2])]
    df = spark.createDataFrame(rows, "v double, w bigint")
    want = np.quantile(np.repeat([1, 2, 5, 9], [3, 1, 4, 2]), [0.1, 0.5, 0.9])
    got = quantiles(df, ["v"], [0.1, 0.5, 0.9], weight="w").first()["v"]
    np.testing.assert_allclose(got, want)


def test_quantiles_beyond_the_sketch(spark):
    """Groups of many times the sketch's size, skewed weights far from the cuts, missing groups and columns."""
    rng = np.random.default_rng(2)
    v = rng.lognormal(size=40_000)
    w = np.where(v > np.quantile(v, 0.99), 5_000, 1)
    g = np.where(np.arange(40_000) % 3 == 0, None, "x")
    df = spark.createDataFrame([(k, float(a), int(b), None) for k, a, b in zip(g, v, w)] + [("empty", None, 3, None)], "g string, v double, w bigint, none double")
    qs = [0.01, 0.25, 0.5, 0.95]
    got = {r["g"]: r for r in quantiles(df, ["v", "none"], qs, ["g"]).collect()}
    assert set(got) == {None, "x", "empty"} and got["empty"]["v"] is None and all(r["none"] is None or r["none"] == [None] * 4 for r in got.values())
    for k in (None, "x"):
        np.testing.assert_allclose(got[k]["v"], np.quantile(v[g == k], qs), rtol=1e-12)
    heavy = quantiles(df, ["v"], qs, weight="w").first()["v"]
    np.testing.assert_allclose(heavy, np.quantile(np.repeat(v, w), qs), rtol=1e-12)
    assert quantiles(df.limit(0), ["v"], qs).first()["v"] in (None, [None] * 4)


def test_global_rank_by_ranges(spark):
    df = spark.range(1000).select("id", (F.col("id") % 7).alias("v"), (F.col("id") % 2).alias("g"))
    for by in ([], ["g"]):
        order = [F.desc("v"), F.asc("id")]
        small = {r["id"]: r["rank"] for r in global_rank(df, order, by=by).collect()}
        large = {r["id"]: r["rank"] for r in global_rank(df, order, by=by, max_rows=90).collect()}
        assert small == large


def test_sample_ignores_partitioning(spark):
    df = spark.range(500)
    picks = [{r["id"] for r in sample_n(df.repartition(p), ["id"], 20).collect()} for p in (1, 7)]
    assert picks[0] == picks[1] and len(picks[0]) == 20
