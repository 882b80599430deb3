from pyspark.sql import functions as F

from waypost.operators.cleaning import impute
from waypost.operators.detectors import fit_detectors
from waypost.operators.joins import attach_group_stat, merge_with_loss
from waypost.operators.routes import build_route_master, uncoded
from waypost.plans.fixtures import CATEGORIES, view
from waypost.session import materialize


def test_missing_codes_make_no_routes(spark, sf):
    """Both sides lack codes; the route master has each route once and every detector keeps the rows."""
    alarms, travelers = view(spark, sf, "alarms"), view(spark, sf, "travelers")
    for side in (alarms, travelers):
        counts = uncoded(side).first()
        assert 0 < counts["n_uncoded"] < counts["n_rows"] == side.count()
    routes = materialize(build_route_master(alarms, travelers, CATEGORIES))
    n = routes.count()
    assert n == routes.select("route").distinct().count() and routes.filter(F.col("departure_airport_iata").isNull() | F.col("arrival_airport_iata").isNull()).isEmpty()
    assert {r[0] for r in routes.select("data_coverage").distinct().collect()} == {"both", "left_only", "right_only"}
    assert fit_detectors(routes, trees=10).count() == n


def test_merge_loss_counts_the_smaller_table(spark):
    a = spark.createDataFrame([(1,), (1,), (2,), (3,), (None,)], "k int")
    b = spark.createDataFrame([(1,), (4,), (None,)], "k int")
    merged, loss = merge_with_loss(a, b, ["k"])
    assert merged.count() == 2
    r = loss.first()
    assert (r["n_left"], r["n_right"], r["n_merged"], round(r["loss_pct"], 6), r["warn"]) == (5, 3, 2, 33.333333, 1)


def test_group_statistics_keep_missing_groups(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", 3.0), (None, 5.0)], "g string, v double")
    got = {(r["g"], r["v"]): r["m"] for r in attach_group_stat(df, ["g"], m=F.avg("v")).collect()}
    assert got == {("a", 1.0): 2.0, ("a", 3.0): 2.0, (None, 5.0): 5.0}


def test_impute(spark):
    rows = [(1, 4, "b", None, None), (2, None, "b", None, None), (3, 7, "a", "x", None), (4, 5, None, "x", None), (5, 6, "a", "y", None)]
    df = spark.createDataFrame(rows, "k int, n int, m string, c string, empty double")
    out = {r["k"]: r for r in impute(df, {"n": "median", "m": "mode", "c": "constant", "empty": "median"}).collect()}
    assert out[2]["n"] == 5.5 and out[4]["m"] == "a" and out[1]["c"] == "UNKNOWN" and out[3]["empty"] is None
