import numpy as np
import pandas as pd
import pytest

from waypost.operators.panel import past_window_features


@pytest.mark.parametrize("parts", [1, 5, 100, None])
def test_windows_equal_row_windows(spark, parts):
    rng = np.random.default_rng(5)
    rows = []
    for a, n in (("HOT", 300), ("B", 3), ("C", 40)):
        for i in range(n):
            day = pd.Timestamp("2024-01-01") + pd.Timedelta(days=int(i // 30 if a == "HOT" else i))
            rows.append((a, day.date(), f"s{i % 4}", f"t{i:04d}", float(rng.normal())))
    pdf = pd.DataFrame(rows, columns=["departure_airport_iata", "departure_date", "s", "t", "v"])
    df = spark.createDataFrame(pdf, "departure_airport_iata string, departure_date date, s string, t string, v double")
    out = past_window_features(df, "v", ["departure_date", "s", "t"], 7, "lag", "past", "incl", parts).toPandas()
    want = pdf.sort_values(["departure_airport_iata", "departure_date", "s", "t"])
    grouped = want.groupby("departure_airport_iata")["v"]
    want = want.assign(
        lag=grouped.shift(1),
        past=grouped.transform(lambda x: x.shift(1).rolling(7, min_periods=1).mean()),
        incl=grouped.transform(lambda x: x.rolling(7, min_periods=1).mean()),
    )
    both = want.merge(out, on=["departure_airport_iata", "t", "s", "departure_date"], suffixes=("_w", "_g"))
    assert len(both) == len(pdf)
    for c in ("lag", "past", "incl"):
        np.testing.assert_allclose(both[f"{c}_w"], both[f"{c}_g"], atol=1e-12)


def test_missing_values_and_airports(spark):
    """Rows without a value have a place in the window but no part in the mean; a missing airport is a group."""
    rng = np.random.default_rng(8)
    rows = [(a, pd.Timestamp("2024-01-01").date() + pd.Timedelta(days=i // 4), f"t{i:03d}", None if rng.random() < 0.4 else float(rng.integers(1, 9))) for a in ("A", None) for i in range(40)]
    rows += [("Z", pd.Timestamp("2024-01-01").date(), f"t{i}", v) for i, v in enumerate([1.0, None, 3.0, 5.0])]
    df = spark.createDataFrame(rows, "departure_airport_iata string, departure_date date, t string, v double")
    out = past_window_features(df, "v", ["departure_date", "t"], 7, "lag", "past", "incl", 5).toPandas()
    assert len(out) == len(rows)
    want = pd.DataFrame(rows, columns=["a", "departure_date", "t", "v"]).fillna({"a": "-"}).sort_values(["a", "departure_date", "t"])
    grouped = want.groupby("a")["v"]
    want = want.assign(past_w=grouped.transform(lambda x: x.shift(1).rolling(7, min_periods=1).mean()), incl_w=grouped.transform(lambda x: x.rolling(7, min_periods=1).mean()))
    both = want.merge(out.rename(columns={"departure_airport_iata": "a"}).fillna({"a": "-"}), on=["a", "departure_date", "t"])
    assert len(both) == len(rows)
    for c in ("past", "incl"):
        np.testing.assert_allclose(both[f"{c}_w"], both[c], atol=1e-12)
    assert both[both.a == "Z"].sort_values("t")["past"].tolist()[1:] == [1.0, 1.0, 2.0]
