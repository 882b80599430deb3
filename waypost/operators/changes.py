"""Change of behaviour of routes over their days: rolling rates and CUSUM flags."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

# Fixed values of the usual chart: slack and decision limit in standard deviations.
SLACK, LIMIT = 0.5, 5.0


def daily_rates(df: DataFrame, key: Sequence[str], day: str, part: str, whole: str) -> DataFrame:
    """One row per (key, day): both sums and their ratio, 0 where nobody came. Combined map-side; all later steps see days, not rows."""
    daily = df.groupBy(*key, day).agg(F.sum(part).alias(part), F.sum(whole).alias(whole))
    return daily.withColumn("rate", F.when(F.col(whole) > 0, F.col(part) / F.col(whole)).otherwise(0.0))


def rolling_rates(daily: DataFrame, key: Sequence[str], day: str, part: str, whole: str, days: Sequence[int] = (7, 28)) -> DataFrame:
    """Rate over the last ``days`` calendar days, today included, for every row of a daily table."""
    number = F.datediff(F.col(day), F.lit("1970-01-01").cast("date"))
    new = {}
    for n in days:
        w = W.partitionBy(*key).orderBy(number).rangeBetween(-(n - 1), 0)
        total = F.sum(whole).over(w)
        new[f"rate_{n}d"] = F.when(total > 0, F.sum(part).over(w) / total).otherwise(0.0)
    return daily.withColumns(new)


def cusum(daily: DataFrame, key: Sequence[str], day: str, value: str = "rate", slack: float = SLACK, limit: float = LIMIT) -> DataFrame:
    """Rising and falling CUSUM of the standardised value per key, and the flag that one is above the limit.

    The chart S(t) = max(0, S(t - 1) + x(t)) is a max-plus recursion. It unrolls
    to C(t) - min(0, min of C up to t) with the running sum C, so that two
    windows over a key's days give all charts at once. A key without spread
    has charts of zero. Missing values count as the key's mean.
    """
    every = W.partitionBy(*key)
    run = every.orderBy(day).rowsBetween(W.unboundedPreceding, W.currentRow)
    mean, sd = F.avg(value).over(every), F.stddev_samp(value).over(every)
    scored = daily.withColumn("_z", F.coalesce(F.when(sd > 0, (F.col(value) - mean) / sd), F.lit(0.0)))
    summed = scored.withColumns({"_up": F.sum(F.col("_z") - slack).over(run), "_down": F.sum(-F.col("_z") - slack).over(run)})

    def chart(c: str) -> Column:
        return F.col(c) - F.least(F.lit(0.0), F.min(c).over(run))

    charts = summed.withColumns({"rise": chart("_up"), "fall": chart("_down")}).drop("_z", "_up", "_down")
    return charts.withColumn("change_flag", (F.greatest("rise", "fall") > limit).cast("int"))
