"""Statistics of a column set: attaching them to rows, and exact quantiles.

Two rules hold for every caller:

* One-row statistics reach the rows as a scalar subquery, never as a join.
  Per-group statistics reach them through an equi-join on the group key.
* Quantiles are exact and never hold a group in one buffer. A mergeable sketch
  of each group gives cut points that lie close around the wanted ranks; the
  rows between two cuts are counted, and only the values between the two cuts
  that enclose a wanted rank are put in order.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from waypost.operators.joins import join_groups
from waypost.session import materialize
from waypost.sources.files import q

#: Size of a sketch, the share of ranks that it is surely right to, and the cuts that are there for weighted rows.
SKETCH, SKETCH_ERROR, COARSE = 1024, 0.01, 16


def attach(df: DataFrame, stats: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Add the statistic columns to every row; adaptive execution decides how grouped ones travel."""
    if by:
        return df.join(stats, list(by))
    packed = stats.select(F.struct(*[F.col(q(c)) for c in stats.columns]).alias("s")).scalar()
    wide = df.withColumn("_stats", packed)
    return wide.select(*[F.col(q(c)) for c in df.columns], *[F.col("_stats")[c].alias(c) for c in stats.columns])


def quantiles(
    df: DataFrame,
    cols: Sequence[str],
    qs: Sequence[float],
    by: Sequence[str] = (),
    weight: str | None = None,
    written: bool = False,
) -> DataFrame:
    """Exact linearly interpolated quantiles, one row per group.

    Result columns: ``by``, then one array per column in the order of ``qs``
    (null for a column without values). Three passes over ``df`` find them, so
    it is written first unless it is ``written`` already or a source table.
    """
    by = list(by)
    fixed = df.select(*by, *[F.col(q(c)).cast("double").alias(f"_v{i}") for i, c in enumerate(cols)], *([F.col(weight).cast("bigint").alias("_w")] if weight else []))
    fixed = fixed if written else materialize(fixed)
    key = [*by, "_c"]
    # Cuts on both sides of every wanted rank; of weighted rows ranks are not known yet, so some lie all over.
    ranks = {min(max(x + d, 0.0), 1.0) for x in qs for d in (-SKETCH_ERROR, SKETCH_ERROR)} | {i / COARSE for i in range(1, COARSE)}
    wanted_ranks = F.array(*[F.lit(float(r)) for r in sorted(ranks)])
    sketches = (fixed.groupBy(*by) if by else fixed.groupBy()).agg(*[F.kll_sketch_agg_double(f"_v{i}", F.lit(SKETCH)).alias(f"_s{i}") for i in range(len(cols))])
    # A sketch without values has no quantiles.
    cut = [
        F.struct(F.lit(i).alias("_c"), F.when(F.kll_sketch_get_n_double(f"_s{i}") > 0, F.array_distinct(F.kll_sketch_get_quantile_double(f"_s{i}", wanted_ranks))).alias("_cuts"))
        for i in range(len(cols))
    ]
    # Sketches draw at random: written once, so that counting and selecting see the same cuts.
    cuts = materialize(sketches.select(*by, F.inline(F.array(*cut))))
    weight_col = F.col("_w") if weight else F.lit(1).cast("bigint").alias("_w")
    cells = F.inline(F.array(*[F.struct(F.lit(i).alias("_c"), F.col(f"_v{i}").alias("_v")) for i in range(len(cols))]))
    values = fixed.select(*by, weight_col, cells).filter(F.col("_v").isNotNull())
    # Without groups there is one row of cuts per column.
    wide = join_groups(values, cuts, key) if by else values.join(F.broadcast(cuts), "_c")
    placed = wide.select(*key, "_v", "_w", F.size(F.filter("_cuts", lambda s: s < F.col("_v"))).alias("_b"))

    totals = placed.groupBy(*key, "_b").agg(F.sum("_w").alias("_n")).filter(F.col("_n") > 0)
    in_order = W.partitionBy(*key).orderBy("_b")
    ranked = totals.select(
        *key,
        "_b",
        (F.sum("_n").over(in_order) - F.col("_n")).alias("_start"),
        F.sum("_n").over(in_order).alias("_end"),
        F.sum("_n").over(W.partitionBy(*key)).alias("_total"),
    )
    wanted = F.array(*[F.struct(F.lit(i).alias("_i"), F.lit(float(x)).alias("_q")) for i, x in enumerate(qs)])
    rank = F.col("_q") * (F.col("_total") - 1)
    targets = (
        ranked.select(*key, "_b", "_start", "_end", "_total", F.inline(wanted))
        .select(*key, "_b", "_start", "_end", "_i", rank.alias("_rank"), F.floor(rank).alias("_lo"), F.ceil(rank).alias("_hi"))
        .filter(
            ((F.col("_lo") >= F.col("_start")) & (F.col("_lo") < F.col("_end")))
            | ((F.col("_hi") >= F.col("_start")) & (F.col("_hi") < F.col("_end")))
        )
    )
    within = W.partitionBy(*key, "_b", "_i").orderBy("_v").rowsBetween(W.unboundedPreceding, 0)
    values = join_groups(placed, targets, [*key, "_b"]).groupBy(*key, "_b", "_i", "_v").agg(
        F.sum("_w").alias("_w"), *[F.first(c).alias(c) for c in ("_start", "_rank", "_lo", "_hi")]
    )
    run = values.withColumn("_run", F.col("_start") + F.sum("_w").over(within))
    found = run.groupBy(*key, "_i").agg(
        F.min(F.when(F.col("_run") > F.col("_lo"), F.col("_v"))).alias("_vlo"),
        F.min(F.when(F.col("_run") > F.col("_hi"), F.col("_v"))).alias("_vhi"),
        F.first("_rank").alias("_rank"),
    )
    share = F.col("_rank") - F.floor("_rank")
    value = F.col("_vlo") * (1 - share) + F.col("_vhi") * share
    solved = found.withColumn("_value", F.when(F.col("_vlo") == F.col("_vhi"), F.col("_vlo")).otherwise(value))

    def one(i: int, j: int) -> Column:
        return F.max(F.when((F.col("_c") == i) & (F.col("_i") == j), F.col("_value")))

    aggs = [F.array(*[one(i, j) for j in range(len(qs))]).alias(c) for i, c in enumerate(cols)]
    if not by:
        return solved.agg(*aggs)
    return join_groups(cuts.select(*by).distinct(), solved.groupBy(*by).agg(*aggs), by, "left")


def melt(df: DataFrame, cols: Sequence[str], name: str = "column_name", value: str = "value", keep: Sequence[str] = ()) -> DataFrame:
    """One row per (row, column), values as text."""
    cells = F.array(*[F.struct(F.lit(c).alias(name), F.col(q(c)).cast("string").alias(value)) for c in cols])
    return df.select(*keep, F.inline(cells))


def rows_from(aggregated: DataFrame, records: Sequence[dict[str, Column]]) -> DataFrame:
    """Turn one aggregate row into one row per record of column expressions."""
    items = F.array(*[F.struct(*[c.alias(n) for n, c in rec.items()]) for rec in records])
    return aggregated.select(F.inline(items))
