"""Feature selection, compression and scaling."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from waypost.operators.stats import attach
from waypost.sources.files import q

# The daily panel's feature list and its optional members.
PANEL_FEATURES = [
    "entries", "total_alarms_day", "traffic_multiplier", "rate_deviation",
    "alarm_rate_yesterday", "rolling_7d_avg_rate", "investigation_rate", "is_weekend", "month",
]
PANEL_OPTIONAL = ["risk_flag_high", "zone_risk_weight"]


# The kinds of route features in their order, by prefix or by name.
ROUTE_FEATURES = [
    ("counts", ("tot_",), ()),
    ("rates", ("alert_rate", "pct_"), ()),
    ("risk counts", (), ("n_high_risk", "n_medium_risk")),
    ("ratios", (), ("alarm_intensity", "investigation_rate")),
]


def select_features(columns: Sequence[str]) -> list[str]:
    """Columns of each kind: those with its prefixes as they come, then its names."""
    chosen: list[str] = []
    for _, prefixes, names in ROUTE_FEATURES:
        chosen.extend(filter(lambda c: c.startswith(prefixes), columns) if prefixes else ())
        chosen.extend(n for n in names if n in columns)
    return chosen


def select_panel_features(columns: Sequence[str]) -> list[str]:
    return [c for c in PANEL_FEATURES + PANEL_OPTIONAL if c in columns]


def feature_list(spark, columns: Sequence[str]) -> DataFrame:
    """The selected features with their position."""
    rows = [(i, c) for i, c in enumerate(select_features(columns), 1)]
    return spark.createDataFrame(rows, "position bigint, feature string")


def _log1p(col: str) -> Column:
    return F.log1p(F.coalesce(F.col(q(col)).cast("double"), F.lit(0.0)))


def log1p_features(df: DataFrame, cols: Sequence[str], keep: Sequence[str] = ()) -> DataFrame:
    return df.select(*keep, *[_log1p(c).alias(c) for c in cols])


def standard_scale(df: DataFrame, cols: Sequence[str], keep: Sequence[str] = (), by: Sequence[str] = ()) -> DataFrame:
    """(x - mean) / population deviation; a constant column becomes 0."""
    aggs: list[Column] = []
    for i, c in enumerate(cols):
        x = F.col(q(c)).cast("double")
        aggs += [F.avg(x).alias(f"_mu{i}"), F.stddev_pop(x).alias(f"_sd{i}")]
    stats = df.groupBy(*by).agg(*aggs) if by else df.agg(*aggs)
    kept = list(dict.fromkeys([*by, *keep]))
    wide = attach(df.select(*kept, *[F.col(q(c)) for c in cols]), stats, by)
    scaled = [
        F.when(F.col(f"_sd{i}") > 0, (F.col(q(c)).cast("double") - F.col(f"_mu{i}")) / F.col(f"_sd{i}")).otherwise(0.0).alias(c)
        for i, c in enumerate(cols)
    ]
    return wide.select(*kept, *scaled)


def feature_matrix(df: DataFrame, cols: Sequence[str], key: str, by: Sequence[str] = ()) -> DataFrame:
    """Key and one array column ``x`` of scaled log features, in ``cols`` order."""
    return scale_vectors(df.select(*by, key, F.array(*[_log1p(c) for c in cols]).alias("x")), key, by)


def scaled_vectors(df: DataFrame, cols: Sequence[str], key: str, by: Sequence[str] = ()) -> DataFrame:
    """As ``feature_matrix`` without the logarithm."""
    raw = [F.coalesce(F.col(q(c)).cast("double"), F.lit(0.0)) for c in cols]
    return scale_vectors(df.select(*by, key, F.array(*raw).alias("x")), key, by)


def scale_vectors(df: DataFrame, key: str, by: Sequence[str] = ()) -> DataFrame:
    """Standardise an array column ``x`` position by position.

    Moments are aggregated per position, which keeps the generated code small
    for any number of features and still combines map-side.
    """
    cells = df.select(*by, F.posexplode("x").alias("_i", "_v"))
    moments = cells.groupBy(*by, "_i").agg(F.avg("_v").alias("mu"), F.stddev_pop("_v").alias("sd"))
    packed = F.array_sort(F.collect_list(F.struct("_i", "mu", "sd"))).alias("_m")
    stats = moments.groupBy(*by).agg(packed) if by else moments.agg(packed)
    wide = attach(df.select(*by, key, "x"), stats, by)
    scaled = F.zip_with("x", "_m", lambda v, m: F.when(m["sd"] > 0, (v - m["mu"]) / m["sd"]).otherwise(0.0))
    return wide.select(*by, key, scaled.alias("x"))


def scaler_check(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Mean and population deviation over the whole scaled matrix."""
    n = len(cols)
    total = sum((F.sum(F.col(q(c))) for c in cols[1:]), F.sum(F.col(q(cols[0]))))
    squares = sum((F.sum(F.col(q(c)) ** 2) for c in cols[1:]), F.sum(F.col(q(cols[0])) ** 2))
    cells = F.count(F.lit(1)) * n
    mean = total / cells
    return df.agg(cells.alias("n_cells"), mean.alias("mean"), F.sqrt(squares / cells - mean * mean).alias("std"))


def minmax(df: DataFrame, col: str, out: str | None = None, by: Sequence[str] = ()) -> DataFrame:
    """Scale to [0, 1]; a constant column becomes 0."""
    x = F.col(q(col))
    stats = (df.groupBy(*by) if by else df.groupBy()).agg(F.min(x).alias("_lo"), F.max(x).alias("_hi"))
    wide = attach(df, stats, by)
    span = F.col("_hi") - F.col("_lo")
    return wide.withColumn(out or col, F.when(span > 0, (x - F.col("_lo")) / span).otherwise(0.0)).drop("_lo", "_hi")
