import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry_points
from waypost.operators import perimeters as H
from waypost.operators.detectors import fit_detectors
from waypost.operators.ranking import apply_post_processing
from waypost.operators.routes import alarm_routes, combine_sides, reduce_alarms, reduce_travelers
from waypost.plans.fixtures import CATEGORIES, TOKEN, view
from waypost.plans.perimeter_queries import request_dims
from waypost.plans.runs import SCOPE, run_perimeters
from waypost.session import materialize


def test_entry(spark):
    df = entry_points.entry(spark)
    rows = df.collect()
    assert rows and [r["rank"] for r in rows] == sorted(r["rank"] for r in rows)


def test_request_resolution(spark):
    requests = spark.createDataFrame(
        [
            (1, "anomalies from IST"), (2, "flights to tirana"), (3, "Voli da Albania"), (4, "flights from ZZZ"), (5, "  "),
            (6, "Voli per Istanbul"), (7, "the cost d'avorio"), (8, "costa d'avorio, arriving"), (9, "romania and Roma"),
        ],
        "request_id int, user_request string",
    )
    airports = spark.createDataFrame([("IST",), ("ISL",), ("TIA",), ("PER",), ("FCO",), ("ABJ",)], "iata string")
    cities = spark.createDataFrame([("ISTANBUL", "ISL", 1), ("TIRANA", "TIA", 2), ("ROMA", "FCO", 3)], "city string, iata string, ord int")
    countries = spark.createDataFrame([("Albania", 1), ("Costa d'Avorio", 2), ("Romania", 3)], "country string, ord int")
    traffic = spark.createDataFrame([("ALBANIA", "TIA"), ("COSTA D'AVORIO", "ABJ")], "country string, iata string")
    got = H.resolve_requests(requests, H.RequestDims(airports, cities, countries), traffic)
    found = {r["request_id"]: (r["perimeter_id"], r["matched_by"]) for r in got.collect()}
    assert found == {
        1: ("departure:IST", "code"), 2: ("arrival:TIA", "city"), 3: ("departure:TIA", "country"), 4: (None, None), 5: ("global", "global"),
        6: ("departure:PER", "code"), 7: (None, None), 8: ("arrival:ABJ", "country"), 9: ("departure:FCO", "city"),
    }


def test_one_perimeter_alone_equals_the_batch(spark, sf):
    """Baselines, scores and ranks of a perimeter are its own."""
    alarms, travelers = view(spark, sf, "alarms"), view(spark, sf, "travelers")
    requests = spark.createDataFrame([(1, "from S03"), (2, "to C05"), (3, ""), (4, "via S99"), (5, "from S03 again")], "request_id bigint, user_request string")
    batch = run_perimeters(requests, alarms, travelers, request_dims(spark, sf), token=TOKEN, occurrences=CATEGORIES.occurrences)
    status = {r["request_id"]: r["status"] for r in batch.requests.collect()}
    assert status == {1: "ready", 2: "ready", 3: "ready", 4: "invalid_input", 5: "ready"}
    reports = {r["request_id"]: r["report_md"] for r in batch.reports.collect()}
    assert "could not produce" in reports[4] and reports[1] == reports[5] and '{"departure_iata": "S03"}' in reports[1]

    t = reduce_travelers(travelers.filter("departure_airport_iata = 'S03'")).withColumn(SCOPE, F.lit("departure:S03"))
    a = reduce_alarms(alarms.filter("departure_airport_iata = 'S03'"))
    side = H.traveler_routes_by_perimeter(materialize(t)).drop(SCOPE)
    routes = materialize(combine_sides(alarm_routes(a, CATEGORIES.occurrences), side))
    alone = materialize(fit_detectors(routes))
    cols = ["if_anomaly", "lof_anomaly", "dbscan_anomaly", "z_anomaly", "if_score", "lof_score", "alert_rate"]
    want = {r["route"]: r for r in alone.collect()}
    got = {r["route"]: r for r in batch.scored.filter(F.col(SCOPE) == "departure:S03").collect()}
    assert set(want) == set(got) and len(want) >= 10
    for route, row in want.items():
        for c in cols:
            assert got[route][c] == pytest.approx(row[c], rel=1e-9, abs=1e-12), (route, c)
    ranks = {r["route"]: r["rank"] for r in apply_post_processing(alone)[0].collect()}
    assert ranks == {r["route"]: r["rank"] for r in batch.post.filter(F.col(SCOPE) == "departure:S03").collect()}


def test_empty_consensus(spark):
    schema = "route string, departure_airport_iata string, arrival_airport_iata string, alert_rate double, tot_investigated bigint, anomaly_votes int, anomaly_consensus int"
    scored = spark.createDataFrame([("a→b", "a", "b", 0.1, 5, 1, 0)], schema)
    post, clean = apply_post_processing(scored)
    assert post.count() == 0 and clean.count() == 0


def test_temporary_tables_are_deleted(spark, tmp_path):
    from pathlib import Path

    from pyspark.sql import functions as F

    from waypost.session import materialize, scratch_dir, temporary_tables

    kept = materialize(spark.range(3))
    folder = Path(scratch_dir(spark).removeprefix("file:"))
    before = set(folder.iterdir())
    with temporary_tables(spark):
        inside = materialize(spark.range(5))
        with temporary_tables(spark):
            assert materialize(inside.where("id > 1")).count() == 3
        assert inside.agg(F.sum("id")).first()[0] == 10 and len(set(folder.iterdir()) - before) == 1
    assert set(folder.iterdir()) == before and kept.count() == 3
