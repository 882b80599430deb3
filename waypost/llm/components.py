"""Connected components of an edge table, by alternating star contractions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from waypost.operators.joins import join_hot
from waypost.session import materialize


def _star(edges: DataFrame, small: bool) -> DataFrame:
    """Large star: link every greater neighbour to the least of a node's neighbourhood; small star: the others."""
    both = edges if small else edges.unionAll(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = materialize(both.groupBy("u").agg(F.min("v").alias("m"), F.count("*").alias("degree")))
    near = join_hot(both, least, ["u"], "degree")
    if not small:
        near = near.where("v > u")
        return near.select(F.col("v").alias("u"), F.least("u", "m").alias("v")).distinct()
    # An edge to the least itself stays, the others go to the least.
    return near.select(F.when(F.col("v") == F.col("m"), F.col("u")).otherwise(F.col("v")).alias("u"), F.col("m").alias("v")).distinct()


def components(edges: DataFrame) -> DataFrame:
    """node, component (the least node) for every node of ``edges`` (u, v: orderable, not null).

    Each step is written to the shared folder, and no join key gets more than
    its share of the edges. The rounds end when a round changes no edge; the
    edges are then stars around the least nodes.
    """
    now = materialize(edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct())
    state = None
    while True:
        after = now.agg(F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("s")).first()
        if (after.n, after.s) == state:
            break
        state = (after.n, after.s)
        if not after.n:
            break
        now = materialize(_star(materialize(_star(now, False)), True))
    return now.select(F.col("u").alias("node"), F.col("v").alias("component")).unionAll(now.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
