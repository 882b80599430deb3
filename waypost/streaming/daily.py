"""The daily panel as a stream: closed days with lag, trailing mean and frozen thresholds.

Events are summed per key and day under a watermark; a day comes out once it is
closed and never again. Each micro-batch of closed days meets the last rows of
its keys, which the batch before left in the shared folder, gets its features,
and is scored against thresholds that a batch run has fixed. A micro-batch
writes to folders of its own number, so that one that is repeated after a
failure replaces what it wrote; its work grows with its own days and the number
of keys, not with the history.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

DEPTH = 7


def closed_days(events: DataFrame, key: str, time: str, part: Column, delay: str = "1 day") -> DataFrame:
    """key, day, part, whole, rate of every closed day; events later than ``delay`` are left out, those without key or time too."""
    known = events.where(F.col(key).isNotNull() & F.col(time).isNotNull()).withWatermark(time, delay)
    daily = known.groupBy(F.window(time, "1 day").alias("_day"), F.col(key)).agg(F.count_if(part).alias("part"), F.count(F.lit(1)).alias("whole"))
    return daily.select(key, F.to_date("_day.start").alias("day"), "part", "whole", (F.col("part") / F.col("whole")).alias("rate"))


def add_past(days: DataFrame, key: str, depth: int = DEPTH) -> DataFrame:
    """The rate of the row before and the mean of up to ``depth`` rows before; a key has one row per day."""
    order = W.partitionBy(key).orderBy("day")
    return days.withColumns({"lag_1": F.lag("rate").over(order), "past_mean": F.avg("rate").over(order.rowsBetween(-depth, -1))})


def score(days: DataFrame, thresholds: DataFrame, key: str) -> DataFrame:
    """Flag of days at or above the key's frozen threshold (key, threshold); keys without one are not flagged."""
    flagged = days.join(thresholds.select(key, "threshold"), key, "left")
    return flagged.withColumn("flag", F.coalesce(F.col("rate") >= F.col("threshold"), F.lit(False)).cast("int")).drop("threshold")


def stream_panel(days: DataFrame, key: str, thresholds: DataFrame, folder: str, depth: int = DEPTH, columns: Sequence[str] = ("part", "whole", "rate")) -> StreamingQuery:
    """Start the stream of closed days; rows go to ``folder``/rows, checkpoints and the keys' last rows beside them.

    ``days`` is the stream of ``closed_days``. The query ends when all that is there has been read.
    """

    def batch(new: DataFrame, number: int) -> None:
        spark = new.sparkSession
        kept = [key, "day", "rate"]
        schema = new.select(*kept).schema
        before = spark.read.schema(schema).parquet(f"{folder}/tail/{number - 1}") if number else spark.createDataFrame([], schema)
        rows = new.select(key, "day", *columns, F.lit(True).alias("_new")).unionByName(before.withColumn("_new", F.lit(False)), allowMissingColumns=True)
        featured = add_past(rows, key, depth).persist()
        try:
            score(featured.where("_new").drop("_new"), thresholds, key).write.mode("overwrite").parquet(f"{folder}/rows/batch={number}")
            last = F.row_number().over(W.partitionBy(key).orderBy(F.desc("day")))
            featured.select(*kept, last.alias("_r")).where(F.col("_r") <= depth).drop("_r").write.mode("overwrite").parquet(f"{folder}/tail/{number}")
        finally:
            featured.unpersist()

    writer = days.writeStream.outputMode("append").foreachBatch(batch).option("checkpointLocation", f"{folder}/checkpoint")
    return writer.trigger(availableNow=True).start()
