import pytest
from pyspark.sql import functions as F

from waypost.functions import numbers, scoring, text
from waypost.functions.dates import parse_dates
from waypost.sources import vocab


def one(spark, col, **values):
    df = spark.range(1)
    for name, value in values.items():
        df = df.withColumn(name, F.lit(value))
    return df.select(col.alias("v")).first()["v"]


@pytest.mark.parametrize(
    "raw, want",
    [("12 pax", 12.0), ("1 PAX", 1.0), (" 7 ", 7.0), ("~5", None), ("N.D.", None), ("0,0", None), ("-500", -500.0), ("nan", None), ("1d", None), (None, None)],
)
def test_parse_count(spark, raw, want):
    assert one(spark, numbers.parse_count(F.col("x").cast("string")), x=raw) == want


@pytest.mark.parametrize("raw, want", [("0,5", 0.5), ("~12", 12.0), ("-500", None), ("1001", None), ("3 pax", 3.0), ("", None)])
def test_parse_count_locale(spark, raw, want):
    assert one(spark, numbers.parse_count_locale(F.col("x")), x=raw) == want


@pytest.mark.parametrize("raw, want", [("1 voli", 1), ("~5", 5), ("1001", 0), ("??", 0), ("2.5", 2), ("3.5", 4), ("-1", 0)])
def test_parse_bounded_count(spark, raw, want):
    assert one(spark, numbers.parse_bounded_count(F.col("x")), x=raw) == want


@pytest.mark.parametrize(
    "raw, want",
    [
        ("05/02/2024 10:20:30", "2024-02-05 10:20:30"), ("2024-02-0508:00:00", "2024-02-05 08:00:00"), ("2024/02/05", "2024-02-05 00:00:00"),
        ("05.02.2024", "2024-02-05 00:00:00"), ("05-02-24", "2024-02-05 00:00:00"), ("Feb 05 2024", "2024-02-05 00:00:00"),
        ("GEN 11 2024", None), ("n.d.", None), ("2024", None), ("31/02/2024", None), (" 2024-02-05 ", "2024-02-05 00:00:00"),
    ],
)
def test_parse_dates(spark, raw, want):
    got = one(spark, parse_dates(F.col("x")), x=raw)
    assert (None if got is None else str(got)) == want


def test_parse_dates_options(spark):
    assert str(one(spark, parse_dates(F.col("x"), italian_months=True), x="GEN 11 2024")) == "2024-01-11 00:00:00"
    assert str(one(spark, parse_dates(F.col("x"), day_first=False), x="02/05/2024")) == "2024-02-05 00:00:00"


def test_text(spark):
    assert one(spark, text.null_placeholders(F.col("x"), vocab.PLACEHOLDERS), x=" N.D. ") is None
    assert one(spark, text.null_placeholders(F.col("x"), vocab.PLACEHOLDERS), x="\tEU ") is None
    assert one(spark, text.title_text(F.col("x")), x="  st. john's   o-hare ") == "St. John's O-hare"
    assert one(spark, text.title_text(F.col("x"), after_punctuation=True), x="st. john's o-hare") == "St. John'S O-Hare"
    assert one(spark, text.fingerprint(F.col("x")), x="2024-Ab") == "AAAA-AA"
    assert one(spark, text.fingerprint(F.col("x"), keep_digits=True), x="2024-Ab") == "NNNN-AA"
    assert one(spark, numbers.clean_zone(F.col("x"), vocab.ZONE_SENTINELS, F.col("y")), x="99", y="4") == 4
    assert one(spark, numbers.clean_zone(F.col("x"), vocab.ZONE_SENTINELS), x="11") is None


@pytest.mark.parametrize(
    "rate, n, low, high, shown",
    [
        (13 / 34, 34, 0.2389996, 0.5495930, "[23.9%, 55.0%]"), (1.0, 8, 0.676, 1.0, "[67.6%, 100.0%]"),
        (0.188378, 24403, 0.184, 0.193, "[18.4%, 19.3%]"), (0.5, 0, None, None, "n/a"),
    ],
)
def test_wilson(spark, rate, n, low, high, shown):
    lo, hi = scoring.wilson_ci(F.lit(rate), F.lit(n))
    got = spark.range(1).select(lo.alias("lo"), hi.alias("hi")).withColumn("s", scoring.ci_text(F.col("lo"), F.col("hi"))).first()
    assert got["s"] == shown
    if low is None:
        assert got["lo"] is None and got["hi"] is None
    else:
        assert got["lo"] == pytest.approx(low, abs=6e-4) and got["hi"] == pytest.approx(high, abs=6e-4)


def test_wilson_rounds_half_to_even(spark):
    # 0.25 * 10 = 2.5 -> 2 hits, as for a rate of 0.2.
    a, b = scoring.wilson_ci(F.lit(0.25), F.lit(10)), scoring.wilson_ci(F.lit(0.2), F.lit(10))
    row = spark.range(1).select(a[0].alias("a"), b[0].alias("b")).first()
    assert row["a"] == row["b"]


@pytest.mark.parametrize(
    "rate, vol, note",
    [(0.1, 0, vocab.NOTE_INCOMPLETE), (0.0, 2, vocab.NOTE_FALSE_POSITIVE), (0.3, 3, vocab.NOTE_TINY_VOLUME), (0.3, 4, "ok"), (0.0, 3, "ok"), (0.0, 0, vocab.NOTE_FALSE_POSITIVE)],
)
def test_quality_note(spark, rate, vol, note):
    assert one(spark, scoring.quality_note(F.col("r"), F.col("v")), r=rate, v=vol) == note


@pytest.mark.parametrize(
    "rate, vol, votes, level",
    [(0.0, 0, 4, "CRITICAL"), (0.9, 10, 2, "HIGH"), (0.9, 1, 2, "MEDIUM"), (0.2, 1, 3, "HIGH"), (0.05, 1, 3, "MEDIUM"), (0.4, 50, 2, "MEDIUM"), (0.1, 50, 2, "LOW")],
)
def test_risk_level(spark, rate, vol, votes, level):
    col = scoring.risk_level(F.col("r"), F.col("v"), F.col("n"), F.lit(0.1), F.lit(0.5), F.lit(0.3), F.lit(2.0))
    assert one(spark, col, r=rate, v=vol, n=votes) == level


def test_published_priority(spark):
    from waypost.operators.ranking import priority_score

    row = spark.createDataFrame([(0.382353, 1.0, 0.689407)], "rate_n double, alarms_n double, ci_tightness double")
    assert priority_score(row).first()["priority_score"] == 0.4339


@pytest.mark.parametrize(
    "raw,want",
    [
        ("5/1/2024 10:00", "2024-01-05 10:00:00"), ("2024-01-05 10:20", "2024-01-05 10:20:00"), ("5 Jan 2024", "2024-01-05 00:00:00"), ("Jan 5, 2024", "2024-01-05 00:00:00"),
        ("January 5 2024", "2024-01-05 00:00:00"), ("2024-01-05T10:20:30.500", "2024-01-05 10:20:30.500000"), ("20240105", "2024-01-05 00:00:00"),
        ("05/13/2024", "2024-05-13 00:00:00"), ("13/05/2024", "2024-05-13 00:00:00"), ("05-13-24", "2024-05-13 00:00:00"), ("Marble 5 2024", "None"), ("31/02/2024", "None"), ("13/13/2024", "None"),
    ],
)
def test_more_date_layouts(spark, raw, want):
    assert str(one(spark, parse_dates(F.col("x")), x=raw)) == want
