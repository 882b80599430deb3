"""Approximate neighbour lists from random-projection tables.

For each of several tables all points are turned by a matrix of random
directions and cut into cells by medians along them; a cell is cut further, in
its task, into leaves by medians along fresh random directions. The points of a
leaf are compared with each other, and a point's lists of all tables are merged
to its ``k`` best. Near points share a leaf in most tables; one table finds about
half of the true neighbours, eight find nearly all. Work grows with the number
of points times the leaf size, not with its square, and each point is sent once
per table, whatever its surroundings.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from waypost.operators.neighbors import _TILE, MAX_BLOCKS, Lists, _by_scope, _leaf, _median_cuts, _nearest, _scope_samples, _vectors
from waypost.session import materialize, one_blas_thread

#: Tables, points in a leaf, points in a cell (about), directions per table, seed.
TABLES, LEAF, CELL, DIRECTIONS, SEED = 8, 512, 8192, 16, 11


def leaves(x: np.ndarray, size: int, rng: np.random.Generator) -> Iterator[np.ndarray]:
    """Row numbers of at most ``size`` points each, cut by medians along random directions."""
    todo = [np.arange(len(x))]
    while todo:
        rows = todo.pop()
        if len(rows) <= size:
            yield rows
            continue
        along = x[rows] @ rng.normal(size=x.shape[1])
        order = np.argsort(along, kind="stable")  # halves by rank, so that equal values end too
        half = len(rows) // 2
        todo += [rows[order[:half]], rows[order[half:]]]


def table_lists(tables: int = TABLES, leaf: int = LEAF, cell: int = CELL, seed: int = SEED) -> Lists:
    """A method for ``knn``, ``neighborhood`` and the detectors: approximate, repeatable for the same points."""

    def lists(points: DataFrame, by: list[str], k: int) -> DataFrame:
        sizes = points.groupBy(*by).agg(F.count(F.lit(1)).alias("n"))
        total = points.count()
        size = max(cell, math.ceil(total / MAX_BLOCKS))
        large = sizes.filter(F.col("n") > size).collect()
        samples, cut = _scope_samples(points, by, total, size, large) if large else ({}, {})
        turns: dict[int, np.ndarray] = {}
        trees = {}
        for t in range(tables):
            for scope, sample in samples.items():
                d = sample.shape[1]
                turn = turns.setdefault((t, d), np.random.default_rng([seed, t]).normal(size=(d, DIRECTIONS)))
                trees[t, scope] = _median_cuts(sample @ turn, cut[scope])
        packed = points.sparkSession.sparkContext.broadcast((turns, trees, {s: s for s in samples}))
        fields = [points.schema[c] for c in by]
        dealt_schema = T.StructType([*fields, *[points.schema[c] for c in ("p", "w", "x")], T.StructField("t", T.IntegerType()), T.StructField("cell", T.IntegerType())])

        def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            turns, trees, scopes = packed.value
            for batch in batches:
                table = pa.Table.from_batches([batch])
                x = _vectors(table)
                cells = np.zeros((tables, len(x)), np.int32)
                for scope, rows in _by_scope(table, by, scopes):
                    for t in range(tables):
                        cells[t, rows] = _leaf(x[rows] @ turns[t, x.shape[1]], *trees[t, scope])
                for t in range(tables):
                    yield from table.append_column("t", pa.array(np.full(len(x), t, np.int32))).append_column("cell", pa.array(cells[t])).to_batches()

        dealt = points.select(*by, "p", "w", "x").mapInArrow(deal, dealt_schema)
        # Cells are about equal by the sample; one that is not is shared out by key.
        crowd = points.select(*by, "p", "w", "x").mapInArrow(deal, dealt_schema).groupBy(*by, "t", "cell").agg(F.ceil(F.count(F.lit(1)) / (4 * size)).cast("int").alias("shares"))
        dealt = dealt.join(crowd.filter(F.col("shares") > 1), [*by, "t", "cell"], "left").withColumn("share", F.coalesce(F.pmod(F.xxhash64("p", "t"), F.col("shares")).cast("int"), F.lit(0)))
        key = points.schema["p"].dataType
        near = T.ArrayType(T.StructType([T.StructField("dist", T.DoubleType()), T.StructField("o", key), T.StructField("w", T.LongType())]))
        found_schema = T.StructType([*fields, T.StructField("p", key), T.StructField("near", near)])
        arrow = to_arrow_schema(found_schema)

        def search(table: pa.Table) -> pa.Table:
            one_blas_thread()
            table = table.sort_by("p")  # ties go by key
            x, t, c = _vectors(table), table.column("t")[0].as_py(), table.column("cell")[0].as_py()
            rng = np.random.default_rng([seed, t, c])
            rows, others, dist = [], [], []
            for own in leaves(x, leaf, rng):
                own = np.sort(own)
                for start in range(0, len(own), _TILE):
                    tile = own[start : start + _TILE]
                    take, d = _nearest(x[tile], x[own], k + 1)
                    rows.append(np.repeat(tile, take.shape[1]))
                    others.append(own[take.ravel()])
                    dist.append(d.ravel())
            rows, others, dist = (np.concatenate(c) for c in (rows, others, dist))
            apart = rows != others
            rows, others, dist = rows[apart], others[apart], dist[apart]
            order = np.argsort(rows, kind="stable")
            rows, others, dist = rows[order], others[order], dist[order]
            offsets = np.searchsorted(rows, np.arange(table.num_rows + 1)).astype(np.int32)
            items = pa.StructArray.from_arrays(
                [pa.array(dist), table.column("p").combine_chunks().take(pa.array(others)), table.column("w").combine_chunks().take(pa.array(others))],
                names=["dist", "o", "w"],
            )
            columns = {name: table.column(name) for name in [*by, "p"]}
            return pa.table(columns | {"near": pa.ListArray.from_arrays(pa.array(offsets), items)}).cast(arrow)

        per_table = dealt.select(*by, "t", "cell", "share", "p", "w", "x").groupBy(*by, "t", "cell", "share").applyInArrow(search, found_schema)
        best = F.slice(F.array_sort(F.array_distinct(F.flatten(F.collect_list("near")))), 1, k)
        merged = materialize(per_table.groupBy(*by, "p").agg(best.alias("near")))
        return merged.select(*by, "p", F.explode("near").alias("e")).select(*by, "p", "e.o", "e.dist", "e.w")

    return lists
