"""Daily airport panel: alarm vectors, rates, baselines, lag and rolling features.

The panel is ordered per airport by date and then by the rest of its grain. A
busy airport may hold a third of all rows, so no window is partitioned by
airport: rows are cut into ranges of (airport, order), and each range receives
the few values that precede it.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from waypost.functions.dates import calendar_columns
from waypost.functions.numbers import finite_or_zero, ratio_or
from waypost.operators.joins import attach_group_stat, join_groups, left_join_fill0
from waypost.session import materialize

AIRPORT = "departure_airport_iata"
DAY = "departure_date"


def vector_columns(values: Mapping[str, Sequence[str]]) -> dict[str, tuple[str, str]]:
    """Column name -> (source column, value) of the one-hot counts."""
    return {f"{c}_{v}".lower().replace(" ", "_").replace("-", "_"): (c, v) for c, vs in values.items() for v in vs}


def daily_alarm_vector(alarms: DataFrame, values: Mapping[str, Sequence[str]]) -> DataFrame:
    """Alarms per (day, airport): one count per category value and the total."""
    counts = [F.count_if(F.col(c) == v).alias(name) for name, (c, v) in vector_columns(values).items()]
    return alarms.groupBy(F.to_date(DAY).alias(DAY), AIRPORT).agg(*counts, F.count(F.lit(1)).alias("total_alarms_day"))


def daily_master(travelers: DataFrame, alarms: DataFrame, values: Mapping[str, Sequence[str]]) -> DataFrame:
    """Traveller rows with the alarm vector of their airport and day, else 0."""
    vector = daily_alarm_vector(alarms, values)
    dated = travelers.withColumn(DAY, F.to_date(DAY))
    return left_join_fill0(dated, vector, [DAY, AIRPORT], [*vector_columns(values), "total_alarms_day"])


def panel_rates(df: DataFrame) -> DataFrame:
    """Alarm and investigation rate; 0 where nobody entered."""
    return df.withColumns(
        {
            "alarm_rate": ratio_or(F.col("total_alarms_day"), F.col("entries"), 0.0),
            "investigation_rate": ratio_or(F.coalesce("investigated", F.lit(0)), F.col("entries"), 0.0),
        }
    )


def with_calendar(df: DataFrame) -> DataFrame:
    cal = calendar_columns(F.col(DAY))
    return df.withColumns({c: cal[c] for c in ("day_of_week", "is_weekend", "month")})


def baseline_deviation(df: DataFrame) -> DataFrame:
    """Mean alarm rate of the airport and the signed deviation from it."""
    based = attach_group_stat(df, [AIRPORT], airport_historical_avg_rate=F.avg("alarm_rate"))
    return based.withColumn("rate_deviation", F.col("alarm_rate") - F.col("airport_historical_avg_rate"))


def _multiplier(default: float) -> Column:
    return ratio_or(F.coalesce("entries", F.lit(0)), F.col("airport_historical_avg_entries"), default)


def traffic_multiplier(df: DataFrame, default: float = 1.0) -> DataFrame:
    """Entries over the airport's mean entries; ``default`` without a baseline."""
    based = attach_group_stat(df, [AIRPORT], airport_historical_avg_entries=F.avg("entries"))
    return based.withColumn("traffic_multiplier", _multiplier(default))


def zone_weight(df: DataFrame, col: str = "zone") -> DataFrame:
    return df.withColumn("zone_risk_weight", F.coalesce(F.col(col).cast("double"), F.lit(0.0)))


def finite_or_zero_columns(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    return df.withColumns({c: finite_or_zero(F.col(c)) for c in cols})


def _runs(schema: T.StructType, value: str, depth: int):
    """Task function over rows sorted by airport: adds what a row's own partition
    knows of the ``depth`` rows before it.

    ``_part``, ``_r`` (rows of the airport before it in the partition, up to
    ``depth``), ``_lag``, ``_sum`` and ``_n`` of the rows before (``_in``: of one less),
    ``_head`` (of the partition's first airport), and ``_tail``: place from the end among the last ``depth`` rows of the partition, if they
    are of its last airport. Carries ``depth`` values from batch to batch.
    """
    fields = T.StructType(
        [*schema.fields, T.StructField("_part", T.IntegerType()), T.StructField("_r", T.IntegerType()), T.StructField("_lag", T.DoubleType()),
         T.StructField("_sum", T.DoubleType()), T.StructField("_n", T.IntegerType()), T.StructField("_sum_in", T.DoubleType()), T.StructField("_n_in", T.IntegerType()), T.StructField("_head", T.BooleanType()), T.StructField("_tail", T.IntegerType())]
    )
    arrow = to_arrow_schema(fields)
    at, of = schema.names.index(AIRPORT), schema.names.index(value)

    def finish(batch: pa.RecordBatch, own: list, tail: np.ndarray) -> pa.RecordBatch:
        columns = [pa.array(c, f.type, mask=m) for (c, m), f in zip([*own, (tail, tail < 0)], list(arrow)[len(schema) :])]
        return pa.RecordBatch.from_arrays([*batch.columns, *columns], schema=arrow)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        last, carry, seen, head = None, np.empty(0), 0, True  # the airport of the last row, its last values, its rows so far, whether it is the first
        held: list[tuple] = []  # batches that may hold rows of the tail
        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            codes = batch.column(at).dictionary_encode(null_encoding="encode")
            index, names = codes.indices.to_numpy(zero_copy_only=False), codes.dictionary.to_pylist()
            values = batch.column(of).cast(pa.float64()).to_numpy(zero_copy_only=False)
            known = ~np.asarray(batch.column(of).is_null())
            if held and names[index[0]] != last:
                carry, seen, head = np.empty(0), 0, False
            # Rows of the airport of the first row before each row, the carried ones included.
            first = np.concatenate([[True], index[1:] != index[:-1]])
            start = np.maximum.accumulate(np.where(first, np.arange(n), 0))
            before = np.arange(n) - start + np.where(start == 0, seen, 0)
            padded = np.concatenate([np.full(depth - len(carry), np.nan), carry, np.where(known, values, np.nan)])
            total, count, lag = np.zeros(n), np.zeros(n, np.int32), np.full(n, np.nan)
            total_in, count_in = np.zeros(n), np.zeros(n, np.int32)
            for back in range(depth, 0, -1):
                earlier = padded[depth - back : depth - back + n]
                there = (before >= back) & ~np.isnan(earlier)
                total += np.where(there, earlier, 0.0)
                count += there
                if back < depth:
                    total_in, count_in = total_in + np.where(there, earlier, 0.0), count_in + there
                if back == 1:
                    lag = np.where(there, earlier, np.nan)
            heads = np.zeros(n, bool) if not head else start == 0
            own = [(np.full(n, part, np.int32), None), (np.minimum(before, depth).astype(np.int32), None), (lag, np.isnan(lag)), (total, None), (count, None), (total_in, None), (count_in, None), (heads, None)]
            head = head and not first[1:].any()
            seen = int(before[-1]) + 1
            carry = padded[len(padded) - min(seen, depth) :]
            last = names[index[-1]]
            held.append((batch, own, index == index[-1], names[index[0]], last))
            while sum(b.num_rows for b, *_ in held[1:]) >= depth:
                first_batch, first_own, *_ = held.pop(0)
                yield finish(first_batch, first_own, np.full(first_batch.num_rows, -1, np.int32))
        back, out = 0, []
        for batch, own, same, low, high in reversed(held):
            tail = np.full(batch.num_rows, -1, np.int32)
            if high == last and 0 <= back < depth:
                run_of = np.flatnonzero(~same)
                rows = np.arange(batch.num_rows - 1, run_of[-1] if len(run_of) else -1, -1)[: depth - back]
                tail[rows] = back + 1 + np.arange(len(rows))
                back = back + len(rows) if not len(run_of) else depth
            out.append(finish(batch, own, tail))
        yield from reversed(out)

    return run, fields


def past_window_features(
    df: DataFrame, value: str, order: Sequence[str], depth: int = 7, lag_name: str = "lag_1", mean_name: str = "past_mean",
    inclusive_name: str | None = None, parts: int | None = None,
) -> DataFrame:
    """Previous value, mean of the ``depth`` rows before, optionally of the last
    ``depth`` rows including this one, per airport.

    Equal to ``ROWS`` windows over (airport, order), as a segmented prefix scan:
    rows are range-partitioned by airport and ``order`` (any column types; it
    should be total), each range works out what it knows alone and leaves the
    last ``depth`` values of its last airport, and a range that begins inside an
    airport takes over the values that the ranges before it left. One airport
    may fill any number of ranges. ``parts`` sets their number.
    """
    by = [F.col(c).asc_nulls_first() for c in [AIRPORT, *order]]
    ranged = df.repartitionByRange(parts, *by) if parts else df.repartitionByRange(*by)
    run, schema = _runs(df.schema, value, depth)
    local = materialize(ranged.sortWithinPartitions(*by).mapInArrow(run, schema))
    # One row per range: what it leaves, and what those before it left for its first airport. A range holds a row
    # at least, so that the ``depth`` ranges before are enough.
    left = F.array_sort(F.collect_list(F.when(F.col("_tail").isNotNull(), F.struct(F.col("_tail").alias("i"), F.col(AIRPORT).alias("a"), F.col(value).cast("double").alias("v")))))
    ends = local.filter(F.col("_tail").isNotNull() | F.col("_head")).groupBy("_part").agg(left.alias("_left"))
    earlier = W.orderBy("_part").rowsBetween(-depth, -1)
    nearest_first = F.flatten(F.reverse(F.collect_list("_left").over(earlier)))
    halo = ends.select("_part", nearest_first.alias("_halo"))

    # There are as many ranges as shuffle partitions, with ``depth`` values each; only rows that lack some look them up.
    near = F.col("_head") & (F.col("_r") < depth)
    joined = local.withColumn("_from", F.when(near, F.col("_part"))).join(F.broadcast(halo.withColumnRenamed("_part", "_from")), "_from", "left")
    same = F.filter("_halo", lambda s: s["a"].eqNullSafe(F.col(AIRPORT)))
    joined = joined.withColumn("_halo", F.transform(F.when(near, same), lambda s: s["v"]))

    def borrowed(missing: Column) -> Column:
        return F.coalesce(F.slice("_halo", 1, F.greatest(missing, F.lit(0))), F.array().cast("array<double>"))

    def total(values: Column) -> Column:
        return F.aggregate(values, F.lit(0.0), lambda acc, v: acc + F.coalesce(v, F.lit(0.0)))

    def known(values: Column) -> Column:
        return F.size(F.filter(values, lambda v: v.isNotNull()))

    # Rows without a value take a place in the window but no part in the mean.
    before = borrowed(depth - F.col("_r"))
    n_before = F.col("_n") + known(before)
    new: dict[str, Column] = {
        lag_name: F.when(F.col("_r") > 0, F.col("_lag")).otherwise(F.try_element_at("_halo", F.lit(1))),
        mean_name: F.when(n_before > 0, (F.col("_sum") + total(before)) / n_before),
    }
    if inclusive_name:
        # The last row of the window before falls out where the window is full.
        own = F.col(value).cast("double")
        n_around = F.col("_n_in") + known(borrowed(depth - 1 - F.col("_r"))) + own.isNotNull().cast("int")
        new[inclusive_name] = F.when(n_around > 0, (F.col("_sum_in") + total(borrowed(depth - 1 - F.col("_r"))) + F.coalesce(own, F.lit(0.0))) / n_around)
    return joined.withColumns(new).select(*df.columns, *new)


def lag_with_fallback(df: DataFrame, order: Sequence[str], parts: int | None = None) -> DataFrame:
    """Previous alarm rate of the airport, or its baseline for the first row."""
    out = past_window_features(df, "alarm_rate", order, lag_name="alarm_rate_yesterday", mean_name="_m", parts=parts)
    return out.drop("_m").withColumn("alarm_rate_yesterday", F.coalesce("alarm_rate_yesterday", "airport_historical_avg_rate"))


def rolling_past(df: DataFrame, order: Sequence[str], n: int = 7, parts: int | None = None) -> DataFrame:
    """Mean of the ``n`` previous rows (at least one), or the baseline."""
    out = past_window_features(df, "alarm_rate", order, n, lag_name="_l", mean_name="rolling_7d_avg_rate", parts=parts)
    return out.drop("_l").withColumn("rolling_7d_avg_rate", F.coalesce("rolling_7d_avg_rate", "airport_historical_avg_rate"))


def rolling_inclusive(df: DataFrame, order: Sequence[str], n: int = 7, parts: int | None = None) -> DataFrame:
    """Mean of the last ``n`` rows, the current one included."""
    out = past_window_features(df, "alarm_rate", order, n, "_l", "_m", "rolling_inclusive", parts)
    return out.drop("_l", "_m")


def by_day_features(df: DataFrame, days: int = 7) -> DataFrame:
    """Calendar variant: the previous day's rate and the mean of the ``days`` days before.

    Works on one row per (airport, day), so the window sees days, not rows.
    """
    daily = df.groupBy(AIRPORT, DAY).agg(F.avg("alarm_rate").alias("_rate"))
    number = F.datediff(F.col(DAY), F.lit("1970-01-01").cast("date"))
    w = W.partitionBy(AIRPORT).orderBy(number)
    past = daily.withColumns(
        {
            "rate_previous_day": F.avg("_rate").over(w.rangeBetween(-1, -1)),
            "rate_previous_days": F.avg("_rate").over(w.rangeBetween(-days, -1)),
        }
    ).drop("_rate")
    return join_groups(df, past, [AIRPORT, DAY])


def target_encode(df: DataFrame, col: str, value: str = "alarm_rate") -> DataFrame:
    """Category -> its mean alarm rate, on every row."""
    return attach_group_stat(df, [col], **{f"{col}_avg_rate": F.avg(value)})


def engineer_features(
    travelers: DataFrame, alarms: DataFrame, values: Mapping[str, Sequence[str]], order: Sequence[str], parts: int | None = None
) -> DataFrame:
    """The whole panel.

    The joined panel is written once. Both airport baselines come from one
    aggregate over it; the lag and rolling features from one window pass.
    """
    base = materialize(with_calendar(panel_rates(daily_master(travelers, alarms, values))))
    baselines = materialize(
        base.groupBy(AIRPORT).agg(F.avg("alarm_rate").alias("airport_historical_avg_rate"), F.avg("entries").alias("airport_historical_avg_entries"))
    )
    past = past_window_features(base, "alarm_rate", order, 7, "alarm_rate_yesterday", "rolling_7d_avg_rate", parts=parts)
    wide = join_groups(past, baselines, [AIRPORT]).withColumns(
        {
            "rate_deviation": F.col("alarm_rate") - F.col("airport_historical_avg_rate"),
            "alarm_rate_yesterday": F.coalesce("alarm_rate_yesterday", "airport_historical_avg_rate"),
            "rolling_7d_avg_rate": F.coalesce("rolling_7d_avg_rate", "airport_historical_avg_rate"),
            "traffic_multiplier": _multiplier(1.0),
        }
    )
    if "zone" in travelers.columns:
        wide = zone_weight(wide)
    filled = ["entries", "alarm_rate", "investigation_rate", "airport_historical_avg_rate", "rate_deviation",
              "alarm_rate_yesterday", "rolling_7d_avg_rate", "traffic_multiplier", "airport_historical_avg_entries"]
    return wide.na.fill(0, filled)


def baseline_summary(panel: DataFrame) -> DataFrame:
    return panel.agg(
        F.count_distinct(AIRPORT).alias("n_airports"), F.min(DAY).alias("first_day"), F.max(DAY).alias("last_day"),
        F.avg("alarm_rate").alias("avg_alarm_rate"), F.max("alarm_rate").alias("max_alarm_rate"),
        F.avg("traffic_multiplier").alias("avg_traffic_multiplier"), F.count_if(F.col("rate_deviation") > 0).alias("n_above_baseline"),
    )
