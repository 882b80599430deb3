import datetime as dt
import random

from pyspark.sql import functions as F

from waypost.streaming import daily as D

SCHEMA = "k string, ts timestamp, hit boolean"


def write(spark, rows, path):
    spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(str(path))


def test_replayed_files_give_the_batch_panel(spark, tmp_path):
    """Rows of later files, a second start and days without events; what comes too late is left out."""
    rng = random.Random(2)
    start = dt.datetime(2024, 1, 1)
    rows = [(rng.choice("abc"), start + dt.timedelta(minutes=17 * i), rng.random() < 0.3) for i in range(2_000) if not 400 < i < 600]
    rows += [(None, start, True), ("a", None, True)]
    cuts, source, out = [0, 500, 1_200, len(rows)], tmp_path / "in", str(tmp_path / "out")
    limits = spark.createDataFrame([("a", 0.3), ("b", 0.0)], "k string, threshold double")

    def play():
        stream = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(str(source))
        D.stream_panel(D.closed_days(stream, "k", "ts", F.col("hit")), "k", limits, out).awaitTermination()
        return {(r["k"], r["day"]): r for r in spark.read.parquet(f"{out}/rows").collect()}

    write(spark, rows[cuts[0] : cuts[1]], source)
    write(spark, rows[cuts[1] : cuts[2]], source)
    half = play()
    write(spark, rows[cuts[2] :], source)
    write(spark, [("a", start, True)], source)  # weeks too late
    got = play()
    assert set(half) < set(got) and all(got[k] == v for k, v in half.items())

    days: dict = {}
    for k, ts, hit in rows:
        if k is not None and ts is not None:
            days.setdefault((k, ts.date()), []).append(hit)
    last = max(ts for _, ts, _ in rows if ts is not None)
    closed = {key: v for key, v in days.items() if dt.datetime.combine(key[1], dt.time()) + dt.timedelta(days=2) <= last}
    assert set(got) == set(closed)
    for (k, day), hits in closed.items():
        before = [sum(v) / len(v) for key, v in sorted(closed.items()) if key[0] == k and key[1] < day][-7:]
        r = got[k, day]
        assert (r["part"], r["whole"]) == (sum(hits), len(hits)) and r["lag_1"] == (before[-1] if before else None)
        assert (r["past_mean"] is None) == (not before) and (not before or abs(r["past_mean"] - sum(before) / len(before)) < 1e-12)
        assert r["flag"] == int({"a": r["rate"] >= 0.3, "b": True}.get(k, False))
