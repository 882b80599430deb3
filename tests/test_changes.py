import numpy as np
import pytest

from waypost.operators import changes as X
from waypost.operators import profiling as C


def test_charts_are_the_recursion(spark):
    rng = np.random.default_rng(3)
    rows = [(k, f"2024-01-{d + 1:02d}", float(rng.normal() + (3 if k == "b" and d > 20 else 0))) for k in ("a", "b", None) for d in range(31)]
    rows += [("flat", f"2024-01-{d + 1:02d}", 2.0) for d in range(5)] + [("one", "2024-01-01", 7.0), ("gap", "2024-01-01", None), ("gap", "2024-01-02", 1.0), ("gap", "2024-01-03", 3.0)]
    df = spark.createDataFrame(rows, "k string, day string, rate double")
    got = {(r["k"], r["day"]): r for r in X.cusum(df, ["k"], "day").collect()}
    assert len(got) == len(rows)
    for key in {k for k, _, _ in rows}:
        own = [(d, v) for k, d, v in rows if k == key]
        known = [v for _, v in own if v is not None]
        sd = np.std(known, ddof=1) if len(known) > 1 else 0
        rise = fall = 0.0
        for d, v in sorted(own):
            z = (v - np.mean(known)) / sd if sd > 0 and v is not None else 0.0
            rise, fall = max(0.0, rise + z - 0.5), max(0.0, fall - z - 0.5)
            assert got[key, d]["rise"] == pytest.approx(rise, abs=1e-9) and got[key, d]["fall"] == pytest.approx(fall, abs=1e-9)
            assert got[key, d]["change_flag"] == int(max(rise, fall) > 5)
    assert any(r["change_flag"] for r in got.values())


def test_rolling_rates_span_calendar_days(spark):
    rows = [("a", "2024-01-01", 1, 10), ("a", "2024-01-05", 2, 10), ("a", "2024-01-08", 0, 0), ("a", "2024-02-20", 1, 4), ("b", "2024-01-01", 5, 0)]
    daily = X.daily_rates(spark.createDataFrame(rows, "k string, day string, n bigint, of bigint").selectExpr("k", "CAST(day AS DATE) AS day", "n", "of"), ["k"], "day", "n", "of")
    got = {(r["k"], str(r["day"])): (r["rate_7d"], r["rate_28d"]) for r in X.rolling_rates(daily, ["k"], "day", "n", "of").collect()}
    assert got["a", "2024-01-05"] == (0.15, 0.15) and got["a", "2024-01-08"] == (0.2, 0.15) and got["a", "2024-02-20"] == (0.25, 0.25) and got["b", "2024-01-01"] == (0.0, 0.0)


def test_states_of_halves_unite(spark, tmp_path):
    df = spark.range(20_000).selectExpr("id % 7 AS g", "CAST(id AS STRING) AS many", "IF(id % 3 = 0, NULL, id % 50) AS few", "CAST(NULL AS STRING) AS none")
    whole = {r["column_name"]: r for r in C.profile_of_states(C.profile_states(df)).collect()}
    path = str(tmp_path / "states")
    C.profile_states(df.where("id < 9000"), by=[]).write.parquet(path)
    C.profile_states(df.where("id >= 9000")).write.mode("append").parquet(path)
    halves = {r["column_name"]: r for r in C.profile_of_states(spark.read.parquet(path)).collect()}
    assert whole.keys() == halves.keys() == {"g", "many", "few", "none"}
    for c, r in whole.items():
        assert (r["missing"], r["missing_pct"]) == (halves[c]["missing"], halves[c]["missing_pct"])
        assert abs(r["cardinality"] - halves[c]["cardinality"]) <= 0.03 * r["cardinality"]
    assert (halves["none"]["cardinality"], halves["few"]["cardinality"], halves["g"]["cardinality"]) == (0, 50, 7) and abs(halves["many"]["cardinality"] - 20_000) < 1_000
    by_group = C.profile_states(df, by=["g"])
    assert by_group.where("column_name = 'many'").count() == 7 and "g" not in {r["column_name"] for r in by_group.collect()}
