"""The daily panel replayed as a stream of files."""

from __future__ import annotations

from pyspark.sql import functions as F

from waypost.plans.fixtures import table
from waypost.plans.registry import R, query, r6
from waypost.session import scratch_path
from waypost.streaming import daily as D

FILES = 4


@query(
    "streamed_daily_panel",
    f"""WITH e AS (SELECT user_id, CAST(ts AS DATE) AS day, event_type = 'error' AS hit, ts FROM events),
daily AS (SELECT user_id, day, CAST(count_if(hit) AS BIGINT) AS part, count(*) AS whole, count_if(hit) / count(*) AS rate FROM e GROUP BY 1, 2),
closed AS (SELECT * FROM daily WHERE day + INTERVAL 1 DAY <= (SELECT max(ts) FROM events) - INTERVAL 1 DAY),
base AS (SELECT user_id, 3.0 * count_if(hit) / count(*) AS threshold FROM e GROUP BY 1)
SELECT user_id, day, part, whole, {R('rate')} AS rate, {R('lag(rate) OVER (PARTITION BY user_id ORDER BY day)')} AS lag_1,
  {R('avg(rate) OVER (PARTITION BY user_id ORDER BY day ROWS BETWEEN 7 PRECEDING AND 1 PRECEDING)')} AS past_mean, CAST(rate >= threshold AS INT) AS flag
FROM closed JOIN base USING (user_id)""",
)
def _(spark, sf):
    """Events written as files in the order of time and read back one file at a time; thresholds are three times a user's own rate."""
    events, folder = table(spark, sf, "events").select("user_id", F.col("ts").cast("timestamp").alias("ts"), "event_type"), scratch_path(spark, "stream")
    edges = events.agg(F.min("ts").cast("long").alias("lo"), F.max("ts").cast("long").alias("hi")).first()
    place = F.least(F.floor((F.col("ts").cast("long") - edges.lo) * FILES / (edges.hi - edges.lo + 1)), F.lit(FILES - 1))
    for i in range(FILES):
        events.where(place == i).coalesce(1).write.mode("append").parquet(f"{folder}/in")
    hit = F.col("event_type") == "error"
    base = events.groupBy("user_id").agg((3.0 * F.count_if(hit) / F.count(F.lit(1))).alias("threshold"))
    stream = spark.readStream.schema(events.schema).option("maxFilesPerTrigger", 1).parquet(f"{folder}/in")
    D.stream_panel(D.closed_days(stream, "user_id", "ts", hit), "user_id", base, f"{folder}/out").awaitTermination()
    found = spark.read.parquet(f"{folder}/out/rows")
    return found.select("user_id", "day", "part", "whole", r6("rate"), r6("lag_1"), r6("past_mean"), "flag")
