"""Global order: rank, top rows and sampling without a one-task sort."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from waypost.session import materialize

MAX_SORTED_IN_ONE_TASK = 500_000


def top_n(df: DataFrame, by: Sequence[Column], n: int) -> DataFrame:
    """First ``n`` rows of the order; each task keeps only its own ``n``."""
    return df.orderBy(*by).limit(n)


def global_rank(
    df: DataFrame,
    order: Sequence[Column],
    name: str = "rank",
    by: Sequence[str] = (),
    rows: int | None = None,
    max_rows: int = MAX_SORTED_IN_ONE_TASK,
) -> DataFrame:
    """Dense row number over a total order.

    A small input (the size is measured) is numbered by a window. A large one
    is range-partitioned on the whole order, written once so that partition
    numbers are stable, numbered inside each partition, and shifted by the row
    counts of the partitions before it. No task sees more than one range.
    """
    n = df.count() if rows is None else rows
    if n <= max_rows:
        scope = list(by) or [F.lit(0)]
        return df.withColumn(name, F.row_number().over(W.partitionBy(*scope).orderBy(*order)).cast("bigint"))
    keys = [F.col(c) for c in by]
    parts = max(2, -(-n // max_rows))
    ranged = materialize(df.repartitionByRange(parts, *keys, *order).withColumn("_part", F.spark_partition_id()))
    sizes = ranged.groupBy(*by, "_part").agg(F.count(F.lit(1)).alias("_n"))
    scope = list(by) or [F.lit(0)]
    before = W.partitionBy(*scope).orderBy("_part").rowsBetween(W.unboundedPreceding, -1)
    starts = sizes.select(*by, "_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    local = F.row_number().over(W.partitionBy(*by, "_part").orderBy(*order))
    return (
        ranged.withColumn("_local", local)
        .join(starts, [*by, "_part"])
        .withColumn(name, (F.col("_start") + F.col("_local")).cast("bigint"))
        .drop("_part", "_local", "_start")
    )


def sample_n(df: DataFrame, key: Sequence[str], n: int, seed: int = 42) -> DataFrame:
    """``n`` rows chosen by a hash of the key: same rows for any partitioning."""
    return df.orderBy(F.md5(F.concat_ws("|", F.lit(str(seed)), *[F.col(k).cast("string") for k in key])), *key).limit(n)


def distinct_rows(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    return df.select(*cols).distinct()


def most_frequent(df: DataFrame, group: Sequence[str], col: str, name: str | None = None) -> DataFrame:
    """Most frequent non-null value per group; ties go to the smallest value.

    Counting (group, value) first combines hot groups map-side; the second
    aggregate then sees one row per distinct value.
    """
    counts = df.filter(F.col(col).isNotNull()).groupBy(*group, col).agg(F.count(F.lit(1)).alias("_n"))
    return counts.groupBy(*group).agg(F.min_by(col, F.struct(-F.col("_n"), F.col(col))).alias(name or col))
