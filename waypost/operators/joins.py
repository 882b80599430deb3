"""Joins and key-set operators."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from waypost.functions.text import upper_trim
from waypost.sources.files import q

#: A key that more than one row in so many has is hot.
HOT_SHARE = 4096


def outer_join_with_coverage(a: DataFrame, b: DataFrame, keys: Sequence[str], name: str = "data_coverage") -> DataFrame:
    """Full outer join that says which side each row came from."""
    left = a.withColumn("_in_a", F.lit(True))
    right = b.withColumn("_in_b", F.lit(True))
    side = (
        F.when(F.col("_in_a").isNull(), "right_only").when(F.col("_in_b").isNull(), "left_only").otherwise("both")
    )
    return left.join(right, list(keys), "full").withColumn(name, side).drop("_in_a", "_in_b")


def join_groups(df: DataFrame, table: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """Join a table of groups to rows; a missing key is a group like any other, as it is in ``groupBy``."""
    own = {k: f"_group_{i}" for i, k in enumerate(keys)}
    renamed = table.withColumnsRenamed(own)
    same = [F.col(k).eqNullSafe(F.col(g)) for k, g in own.items()]
    return df.join(renamed, same, how).drop(*own.values())


def join_hot(rows: DataFrame, table: DataFrame, keys: Sequence[str], count: str, share: int = HOT_SHARE) -> DataFrame:
    """Inner join of rows with a table of unique, known keys that says in ``count`` how many rows have each.

    Keys that more than one row in ``share`` has are fewer than ``share``; their
    lines of ``table`` go to all tasks, and their rows are not dealt by key. No
    task gets more than one row in ``share`` for a single key. ``rows`` and
    ``table`` are read twice and should be written tables.
    """
    total = table.agg(F.sum(count)).first()[0] or 0
    hot = F.col(count) * share > total
    many, few = table.filter(hot).drop(count), table.filter(~hot).drop(count)
    on = list(keys)
    alone = rows.join(F.broadcast(many.select(*on)), on, "left_anti").join(few, on)
    return alone.unionByName(rows.join(F.broadcast(many), on).select(*alone.columns))


def left_join_fill0(a: DataFrame, b: DataFrame, keys: Sequence[str], cols: Sequence[str]) -> DataFrame:
    return a.join(b, list(keys), "left").na.fill(0, list(cols))


def attach_group_stat(df: DataFrame, key: Sequence[str], **stats: Column) -> DataFrame:
    """Group statistics on every row.

    Aggregate and join back instead of a window: the aggregate combines
    map-side, so a group holding a third of all rows is not sorted in one task.
    Adaptive execution knows the statistics' size once they are there, and
    ships them to the rows only while they are under its own threshold.
    """
    return join_groups(df, df.groupBy(*key).agg(*[c.alias(n) for n, c in stats.items()]), key)


def merge_with_loss(a: DataFrame, b: DataFrame, keys: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """Inner join on the shared keys, and one row telling how much it dropped.

    The loss is 1 - merged rows / rows of the smaller table, in per cent; keys
    that repeat on both sides can make it negative. It needs no join: both
    tables are counted by key, and the counts of shared keys are multiplied.
    """
    used = [k for k in keys if k in a.columns and k in b.columns]
    merged = a.join(b, used, "inner")
    one, none = F.lit(1).cast("bigint"), F.lit(0).cast("bigint")
    tagged = a.select(*used, one.alias("_a"), none.alias("_b")).unionByName(b.select(*used, none.alias("_a"), one.alias("_b")))
    whole = F.lit(True)
    for k in used:
        whole = whole & F.col(q(k)).isNotNull()
    per_key = tagged.groupBy(*used).agg(F.sum("_a").alias("_a"), F.sum("_b").alias("_b")).withColumn("_m", F.when(whole, F.col("_a") * F.col("_b")).otherwise(0))
    sums = per_key.agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(n) for c, n in (("_a", "n_left"), ("_b", "n_right"), ("_m", "n_merged"))])
    smaller = F.least("n_left", "n_right")
    loss = sums.withColumn("loss_pct", F.when(smaller > 0, 100.0 * (1 - F.col("n_merged") / smaller)))
    return merged, loss.withColumn("warn", F.coalesce((F.col("loss_pct") > 20).cast("int"), F.lit(0)))


def semi(df: DataFrame, keys_df: DataFrame, on: Sequence[str]) -> DataFrame:
    return df.join(keys_df.select(*on), list(on), "left_semi")


def anti(df: DataFrame, keys_df: DataFrame, on: Sequence[str]) -> DataFrame:
    return df.join(keys_df.select(*on), list(on), "left_anti")


def attach_scores(df: DataFrame, scores: DataFrame, key: Sequence[str]) -> DataFrame:
    """Score columns by key; there is no row position to rely on."""
    return df.join(scores, list(key))


def filter_in(df: DataFrame, col: str, values: Sequence) -> DataFrame:
    return df.filter(F.col(col).isin(list(values)))


def conflict(a: Column, b: Column) -> Column:
    """Both present and different after trimming and upper-casing."""
    return a.isNotNull() & b.isNotNull() & (upper_trim(a.cast("string")) != upper_trim(b.cast("string")))


def key_coverage(a: DataFrame, b: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Sizes of two key sets, their overlap and Jaccard index.

    Both sides are tagged and grouped once, so the set comparison costs one
    exchange of distinct keys and no join.
    """
    tagged = a.select(*keys, F.lit(1).alias("_a"), F.lit(0).alias("_b")).unionByName(
        b.select(*keys, F.lit(0).alias("_a"), F.lit(1).alias("_b"))
    )
    present = tagged.dropna(subset=list(keys)).groupBy(*keys).agg(F.max("_a").alias("_a"), F.max("_b").alias("_b"))
    both = (F.col("_a") == 1) & (F.col("_b") == 1)
    counted = present.agg(
        F.count_if(F.col("_a") == 1).alias("n_left"),
        F.count_if(F.col("_b") == 1).alias("n_right"),
        F.count_if(both).alias("n_shared"),
        F.count_if(F.col("_b") == 0).alias("n_left_only"),
        F.count_if(F.col("_a") == 0).alias("n_right_only"),
        F.count(F.lit(1)).alias("n_union"),
    )
    jaccard = F.when(F.col("n_union") > 0, F.col("n_shared") / F.col("n_union")).otherwise(0.0)
    return counted.withColumn("jaccard", jaccard).drop("n_union")


def compare_runs(a: DataFrame, b: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Two result sets of the same chain, compared by key."""
    return key_coverage(a, b, keys)


def set_ops(a: DataFrame, b: DataFrame, keys: Sequence[str]) -> dict[str, DataFrame]:
    left, right = a.select(*keys), b.select(*keys)
    return {
        "intersection": left.intersect(right),
        "union": left.union(right).distinct(),
        "difference": left.subtract(right),
    }
