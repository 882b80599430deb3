"""Exact neighbour search and the density detectors built on it.

Points with equal vectors are collapsed into one point with a multiplicity
before anything is compared, so a group of copies costs one row however large
it is. The remaining points are split into blocks of bounded size by median
cuts learned from a sample. A block is searched by a small NumPy kernel that
returns only the ``k`` best rows (or a count, or a spanning forest) per query,
never the pairs it looked at. Other blocks are visited only if their bounding
box is near enough, and the queries sent to one block are cut into bounded
chunks. The result is exact.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from waypost.operators.block_lists import stream_lists
from waypost.operators.joins import join_hot
from waypost.operators.stats import attach, quantiles
from waypost.session import materialize, one_blas_thread

BLOCK_ROWS = 2048
QUERY_CHUNK = 8192
MAX_BLOCKS = 50_000
MAX_SAMPLE = 200_000
_TILE, _WIDE = 256, 2048
BOX_RUN = 64  # blocks whose common box is looked at first
DENSE = 8  # a block is sent to a block of queries if one in so many of them visit it
MET = 8  # blocks sent to a block of queries at a time
_SLACK = 1 + 1e-9


# ---------------------------------------------------------------- kernels


def _vectors(table: pa.Table, name: str = "x") -> np.ndarray:
    column = table.column(name).combine_chunks()
    if isinstance(column, pa.ChunkedArray):
        column = pa.concat_arrays(column.chunks) if column.num_chunks else pa.array([], column.type)
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(len(column), -1) if len(column) else flat.reshape(0, 1)


def _distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Euclidean distances, summed in column order."""
    out = np.zeros((len(a), len(b)))
    for j in range(a.shape[1]):
        diff = a[:, j, None] - b[None, :, j]
        out += diff * diff
    return np.sqrt(out)


def _rough(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Squared distances by one matrix product, and their error bound per row.

    Cancellation makes them inexact, so they only preselect; whatever they
    cannot decide is computed again from the differences.
    """
    aa, bb = (a * a).sum(axis=1), (b * b).sum(axis=1)
    rough = aa[:, None] - 2 * (a @ b.T) + bb[None, :]
    bound = (aa + bb.max(initial=0.0)) * (8 * (a.shape[1] + 4) * np.finfo(float).eps)
    return rough, bound


def _nearest(a: np.ndarray, b: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Indexes into ``b`` and distances of the ``k`` nearest per row of ``a``, ties by index."""
    n = len(b)
    k = min(k, n)
    spare = min(k + 8, n)
    if spare == n:
        dist = _distances(a, b)
        chosen = np.argsort(dist, axis=1, kind="stable")[:, :k]
        return chosen, np.take_along_axis(dist, chosen, axis=1)
    rough, bound = _rough(a, b)
    chosen = np.argpartition(rough, (k - 1, spare - 1), axis=1)[:, :spare]
    picked = np.take_along_axis(rough, chosen, axis=1)
    unsafe = picked[:, spare - 1] <= picked[:, k - 1] + 4 * bound
    near = np.zeros(chosen.shape)
    for j in range(a.shape[1]):
        diff = a[:, j, None] - b[chosen, j]
        near += diff * diff
    near = np.sqrt(near)
    order = np.lexsort((chosen, near), axis=1)[:, :k]
    chosen, near = np.take_along_axis(chosen, order, axis=1), np.take_along_axis(near, order, axis=1)
    again = np.flatnonzero(unsafe)
    if len(again):
        dist = _distances(a[again], b)
        full = np.argsort(dist, axis=1, kind="stable")[:, :k]
        chosen[again], near[again] = full, np.take_along_axis(dist, full, axis=1)
    return chosen, near


def _nearest_within(a: np.ndarray, b: np.ndarray, k: int, reach: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row of ``a``, row of ``b`` and distance of up to ``k`` nearest per row of ``a``, none beyond its reach, ties by index."""
    aa, bb = (a * a).sum(axis=1), (b * b).sum(axis=1)
    bound = (aa + bb.max(initial=0.0)) * (8 * (a.shape[1] + 4) * np.finfo(float).eps)
    limit = reach * reach
    most = limit * (1 + 1e-12) + 4 * bound - aa
    left, right = np.column_stack([-2 * a, np.ones(len(a))]), np.vstack([b.T, bb])
    room = 8 * k + _TILE
    # With an infinite reach or many points inside it the k best are chosen, not listed.
    many = ~np.isfinite(reach) if len(b) > room else np.zeros(len(a), bool)
    count, found = np.zeros(len(a), np.int64), []
    for start in range(0, len(b), _WIDE):
        part = min(_WIDE, len(b) - start)
        flat = np.flatnonzero(left @ right[:, start : start + part] <= np.where(many, -np.inf, most)[:, None])
        qi, bi = flat // part, flat % part + start
        count += np.bincount(qi, minlength=len(a))
        many |= count > room
        found.append((qi, bi))
    qi, bi = (np.concatenate(column) for column in zip(*found)) if found else (np.zeros(0, np.int64), np.zeros(0, np.int64))
    listed = ~many[qi]
    qi, bi = qi[listed], bi[listed]
    near = np.zeros(len(qi))
    for j in range(a.shape[1]):
        diff = a[qi, j] - b[bi, j]
        near += diff * diff
    near = np.sqrt(near)
    whole = np.flatnonzero(many)
    if len(whole):
        take, far = _nearest(a[whole], b, k)
        qi, bi, near = np.concatenate([qi, np.repeat(whole, take.shape[1])]), np.concatenate([bi, take.ravel()]), np.concatenate([near, far.ravel()])
    inside = near <= reach[qi]
    qi, bi, near = qi[inside], bi[inside], near[inside]
    order = np.lexsort((bi, near, qi))
    qi, bi, near = qi[order], bi[order], near[order]
    first = np.searchsorted(qi, np.arange(len(a)))
    keep = np.arange(len(qi)) - first[qi] < k
    return qi[keep], bi[keep], near[keep]


def _within(a: np.ndarray, b: np.ndarray, radius: np.ndarray) -> np.ndarray:
    """Whether each point of ``b`` is within its row's radius."""
    rough, bound = _rough(a, b)
    limit = (radius * radius)[:, None]
    slack = (4 * bound + 1e-12 * radius * radius)[:, None]
    near = rough <= limit - slack
    qi, bi = np.nonzero(~near & (rough <= limit + slack))
    for start in range(0, len(qi), 1 << 16):
        q, p = qi[start : start + (1 << 16)], bi[start : start + (1 << 16)]
        exact = np.zeros(len(q))
        for j in range(a.shape[1]):
            diff = a[q, j] - b[p, j]
            exact += diff * diff
        near[q, p] = np.sqrt(exact) <= radius[q]
    return near


@dataclass(frozen=True)
class _TopK:
    """Kernel: the ``k`` nearest base points of each query, itself excluded."""

    k: int
    key_type: T.DataType

    def schema(self, by: list[T.StructField]) -> T.StructType:
        return T.StructType(
            [
                *by,
                T.StructField("p", self.key_type),
                T.StructField("o", self.key_type),
                T.StructField("dist", T.DoubleType()),
                T.StructField("w", T.LongType()),
            ]
        )

    def run(self, queries: pa.Table, base: pa.Table, by: list[str]) -> pa.Table:
        base = base.take(pc.sort_indices(base, sort_keys=[("p", "ascending")]))
        qx, bx = _vectors(queries), _vectors(base)
        reach = queries.column("reach").to_numpy()
        found = []
        for start in range(0, len(qx), _TILE):
            # The extra entry makes room for the query itself, dropped below.
            qi, bi, d = _nearest_within(qx[start : start + _TILE], bx, self.k + 1, reach[start : start + _TILE])
            found.append((qi + start, bi, d))
        qi, bi, d = (np.concatenate(column) for column in zip(*found)) if found else (np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0))
        out = {name: queries.column(name).take(pa.array(qi)) for name in by}
        out["p"] = queries.column("p").take(pa.array(qi))
        out["o"] = base.column("p").take(pa.array(bi))
        out["dist"] = pa.array(d)
        out["w"] = base.column("w").take(pa.array(bi))
        table = pa.table(out)
        return table.filter(pc.not_equal(table.column("p"), table.column("o")))


@dataclass(frozen=True)
class _CountWithin:
    """Kernel: number of rows within the query's radius, the query included."""

    key_type: T.DataType

    def schema(self, by: list[T.StructField]) -> T.StructType:
        return T.StructType([*by, T.StructField("p", self.key_type), T.StructField("n", T.LongType())])

    def run(self, queries: pa.Table, base: pa.Table, by: list[str]) -> pa.Table:
        qx, bx = _vectors(queries), _vectors(base)
        radius = queries.column("reach").to_numpy()
        weight = base.column("w").to_numpy()
        parts = []
        for start in range(0, len(qx), _TILE):
            near = _within(qx[start : start + _TILE], bx, radius[start : start + _TILE])
            parts.append(near @ weight)
        out = {name: queries.column(name) for name in [*by, "p"]}
        out["n"] = pa.array(np.concatenate(parts).astype(np.int64) if parts else np.zeros(0, dtype=np.int64))
        return pa.table(out)


@dataclass(frozen=True)
class _Forest:
    """Kernel: spanning forest of the within-radius graph of two point sets.

    The graph may hold every pair; the forest has fewer edges than points.
    """

    key_type: T.DataType

    def schema(self, by: list[T.StructField]) -> T.StructType:
        return T.StructType([*by, T.StructField("a", self.key_type), T.StructField("b", self.key_type)])

    def run(self, queries: pa.Table, base: pa.Table, by: list[str]) -> pa.Table:
        qx, bx = _vectors(queries), _vectors(base)
        radius = queries.column("reach").to_numpy()
        keys = pa.concat_arrays(
            [a for t in (queries, base) for a in t.column("p").chunks] or [pa.array([], pa.string())]
        )
        order = pc.rank(keys, tiebreaker="dense").to_numpy().astype(np.int64)
        near = np.zeros((len(qx), len(bx)), dtype=bool)
        for start in range(0, len(qx), _TILE):
            near[start : start + _TILE] = _within(qx[start : start + _TILE], bx, radius[start : start + _TILE])
        left, right = order[: len(qx)].copy(), order[len(qx) :].copy()
        top = order.max(initial=0) + 1
        changed = True
        while changed:
            changed = False
            for start in range(0, len(qx), _TILE):
                tile = slice(start, start + _TILE)
                low = np.minimum(left[tile], np.where(near[tile], right[None, :], top).min(axis=1, initial=top))
                new_right = np.minimum(right, np.where(near[tile], low[:, None], top).min(axis=0, initial=top))
                changed |= not (np.array_equal(low, left[tile]) and np.array_equal(new_right, right))
                left[tile], right = low, new_right
        label = np.concatenate([left, right])
        by_rank = np.zeros(top + 1, dtype=np.int64)
        by_rank[order] = np.arange(len(order))
        moved = np.flatnonzero(label != order)
        first_scope = queries if len(qx) else base
        out = {name: pa.array([first_scope.column(name)[0].as_py()] * len(moved), first_scope.column(name).type) for name in by}
        out["a"] = keys.take(pa.array(moved))
        out["b"] = keys.take(pa.array(by_rank[label[moved]]))
        return pa.table(out)


# ---------------------------------------------------------------- blocking


def fixed_rows(df: DataFrame, key: str, vec: str, by: Sequence[str] = (), written: bool = False) -> DataFrame:
    """``by, key, x`` written once, unless ``df`` is a written table already.

    Vectors are later matched by value. Were they recomputed, a sum in another
    order could change a last digit and lose the match.
    """
    rows = df.select(*by, F.col(key).alias("key"), F.col(vec).cast("array<double>").alias("x"))
    return rows if written else materialize(rows)


def distinct_points(rows: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Collapse equal vectors: representative key ``p``, copies ``w``, vector ``x``."""
    return rows.groupBy(*by, "x").agg(F.min("key").alias("p"), F.count(F.lit(1)).alias("w"))


@dataclass(frozen=True)
class Blocks:
    """Base points with a block number, and one descriptor per block."""

    points: DataFrame  # by, p, w, x, blk
    boxes: list[tuple]  # (by values, lower corner, upper corner, block number)
    by: list[str]
    key_type: T.DataType
    by_fields: list[T.StructField]
    solo: dict = field(default_factory=dict)  # by values -> block number of a one-block scope

    @property
    def single(self) -> bool:
        """True when every scope fits one block, so no other block exists."""
        return not self.boxes


def _median_cuts(sample: np.ndarray, leaves: int) -> tuple[np.ndarray, np.ndarray]:
    """Cut dimension and value of every inner node of a complete binary tree.

    Each node cuts its widest dimension at the median of its sample.
    """
    depth = max(1, math.ceil(math.log2(max(leaves, 2))))
    inner = 2**depth - 1
    dims, cuts = np.zeros(inner, dtype=np.int64), np.zeros(inner)
    held = {0: sample}
    for node in range(inner):
        part = held.pop(node)
        if len(part):
            dims[node] = int(part.std(axis=0).argmax())
            column = part[:, dims[node]]
            cuts[node] = float(np.median(column))
            if cuts[node] >= column.max():  # many equal values at the top
                lower = column[column < cuts[node]]
                cuts[node] = float(lower.max()) if len(lower) else cuts[node]
        left = part[:, dims[node]] <= cuts[node]
        if 2 * node + 2 < inner:
            held[2 * node + 1], held[2 * node + 2] = part[left], part[~left]
    return dims, cuts


def _leaf(x: np.ndarray, dims: np.ndarray, cuts: np.ndarray) -> np.ndarray:
    node = np.zeros(len(x), dtype=np.int64)
    rows = np.arange(len(x))
    while len(node) and node[0] < len(dims):
        node = 2 * node + 1 + (x[rows, dims[node]] > cuts[node])
    return (node - len(dims)).astype(np.int32)


def _scope_samples(points: DataFrame, by: list[str], n: int, size: int, sizes: list) -> tuple[dict[tuple, np.ndarray], dict[tuple, int]]:
    """A sample by key hash of every scope in ``sizes``, shared out by scope size and bounded in total, and its number of blocks."""
    fields = [points.schema[c] for c in by]
    per_leaf = max(2, min(32, MAX_SAMPLE // math.ceil(n / size)))
    if by:
        large = points.sparkSession.createDataFrame(
            [(*[r[c] for c in by], r["n"]) for r in sizes], T.StructType([*fields, T.StructField("_n", T.LongType())])
        )
        inside = points.join(large, by)
    else:
        inside = points.withColumn("_n", F.lit(n))
    wanted = F.ceil(F.col("_n") / size) * per_leaf
    draw = F.pmod(F.xxhash64("p"), F.lit(1 << 40)) / float(1 << 40)
    samples: dict[tuple, list] = {}
    for r in inside.filter(draw <= wanted / F.col("_n")).select(*by, "p", "x").orderBy("p").collect():
        samples.setdefault(tuple(r[c] for c in by), []).append(r["x"])
    return {s: np.array(x) for s, x in samples.items()}, {tuple(r[c] for c in by): math.ceil(r["n"] / size) for r in sizes}


def make_blocks(points: DataFrame, by: Sequence[str] = (), block_rows: int = BLOCK_ROWS, rows: int | None = None) -> Blocks:
    """Split points into blocks of about ``block_rows``.

    ``points`` has ``by``, ``p``, ``w`` and ``x`` and should be materialized.
    Scopes that fit one block are one block. For larger ones the driver sees a
    bounded sample and keeps one bounding box per block; blocks grow with the
    data, so there are never more than about ``MAX_BLOCKS`` of them.
    """
    by = list(by)
    n = points.count() if rows is None else rows
    fields = [points.schema[c] for c in by]
    key_type = points.schema["p"].dataType
    whole = Blocks(points.withColumn("blk", F.lit(0)), [], by, key_type, fields)
    if n <= block_rows:
        return whole
    size = max(block_rows, math.ceil(n / MAX_BLOCKS))
    sizes = points.groupBy(*by).agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > size).collect()
    if not sizes:
        return whole

    samples, cut = _scope_samples(points, by, n, size, sizes)
    trees = {s: _median_cuts(samples[s], leaves) for s, leaves in cut.items() if s in samples}
    packed = points.sparkSession.sparkContext.broadcast(trees)
    out_schema = T.StructType([*fields, *[points.schema[c] for c in ("p", "w", "x")], T.StructField("cell", T.IntegerType())])

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            table = pa.Table.from_batches([batch])
            x = _vectors(table)
            cell = np.zeros(len(x), dtype=np.int32)
            for s, rows in _by_scope(table, by, packed.value):
                cell[rows] = _leaf(x[rows], *packed.value[s])
            yield from table.select([*by, "p", "w", "x"]).append_column("cell", pa.array(cell)).to_batches()

    placed = materialize(points.select(*by, "p", "w", "x").mapInArrow(assign, out_schema))
    # A crowded cell is cut into chunks by key hash.
    crowd = placed.groupBy(*by, "cell").agg(F.count(F.lit(1)).alias("n"))
    chunks = crowd.select(*by, "cell", F.greatest(F.lit(1), F.ceil(F.col("n") / (2 * size))).alias("_chunks"))
    chunked = placed.join(chunks, [*by, "cell"]).withColumn("chunk", F.pmod(F.xxhash64("p"), F.col("_chunks")))
    edges = (
        chunked.select(*by, "cell", "chunk", F.posexplode("x").alias("_i", "_v"))
        .groupBy(*by, "cell", "chunk", "_i")
        .agg(F.min("_v").alias("lo"), F.max("_v").alias("hi"))
        .groupBy(*by, "cell", "chunk")
        .agg(F.array_sort(F.collect_list(F.struct("_i", "lo", "hi"))).alias("box"))
    )
    numbered = sorted(edges.collect(), key=lambda r: (*[str(r[c]) for c in by], r["cell"], r["chunk"]))
    rows_out, boxes, solo = [], [], {}
    for i, r in enumerate(numbered):
        s = tuple(r[c] for c in by)
        rows_out.append((*s, r["cell"], r["chunk"], i))
        if s in trees:
            boxes.append((s, np.array([e["lo"] for e in r["box"]]), np.array([e["hi"] for e in r["box"]]), i))
        else:
            solo[s] = i
    names = points.sparkSession.createDataFrame(
        rows_out,
        T.StructType([*fields, T.StructField("cell", T.IntegerType()), T.StructField("chunk", T.LongType()), T.StructField("blk", T.IntegerType())]),
    )
    blocked = chunked.join(names, [*by, "cell", "chunk"]).select(*by, "p", "w", "x", "blk")
    return Blocks(materialize(blocked), boxes, by, key_type, fields, solo)


def numbered_blocks(points: DataFrame, by: Sequence[str], block_rows: int = BLOCK_ROWS) -> tuple[DataFrame, list[tuple], np.ndarray] | None:
    """Points with the number of their block (``blk, p, w, x``), not written; the scopes in order and the first number of each.

    Blocks as ``make_blocks`` cuts them, of about ``block_rows``; None if every scope fits one.
    """
    by = list(by)
    n = points.count()
    size = max(block_rows, math.ceil(n / MAX_BLOCKS))
    sizes = points.groupBy(*by).agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > size).collect() if n > block_rows else []
    if not sizes:
        return None
    samples, cut = _scope_samples(points, by, n, size, sizes)
    trees = {s: _median_cuts(samples[s], leaves) for s, leaves in cut.items() if s in samples}
    context = points.sparkSession.sparkContext
    packed = context.broadcast(trees)
    fields = [points.schema[c] for c in by]

    def cells(table: pa.Table) -> np.ndarray:
        cell = np.zeros(table.num_rows, np.int32)
        for s, rows in _by_scope(table, by, packed.value):
            cell[rows] = _leaf(_vectors(table)[rows], *packed.value[s])
        return cell

    def tally(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            table = pa.Table.from_batches([batch])
            yield from table.select(by).append_column("cell", pa.array(cells(table))).to_batches()

    counts = points.select(*by, "x").mapInArrow(tally, T.StructType([*fields, T.StructField("cell", T.IntegerType())])).groupBy(*by, "cell").count().collect()
    counts = sorted((r for r in counts if None not in [r[c] for c in by]), key=lambda r: (*[str(r[c]) for c in by], r["cell"]))
    # A crowded cell is cut into chunks by key.
    place, scopes, first, total = {}, [], [], 0
    for r in counts:
        s, chunks = tuple(r[c] for c in by), math.ceil(r["count"] / (2 * size))
        if not scopes or scopes[-1] != s:
            scopes.append(s)
            first.append(total)
        place.setdefault(s, {})[r["cell"]] = (total, chunks)
        total += chunks
    for s, known in place.items():
        begin, chunks = np.zeros(max(known) + 1, np.int32), np.ones(max(known) + 1, np.int64)
        for cell, (a, b) in known.items():
            begin[cell], chunks[cell] = a, b
        place[s] = begin, chunks
    numbers = context.broadcast(place)
    schema = T.StructType([T.StructField("blk", T.IntegerType()), *[points.schema[c] for c in ("p", "w", "x")]])

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            table = pa.Table.from_batches([batch])
            cell, blk = cells(table), np.full(batch.num_rows, -1, np.int32)
            mixed = (table.column("p").cast(pa.int64()).fill_null(0).to_numpy().astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(33)
            for s, rows in _by_scope(table, by, numbers.value):
                begin, chunks = numbers.value[s]
                blk[rows] = begin[cell[rows]] + (mixed[rows].astype(np.int64) % chunks[cell[rows]]).astype(np.int32)
            kept = table.select(["p", "w", "x"]).add_column(0, "blk", pa.array(blk))
            yield from (kept.filter(pa.array(blk >= 0)) if (blk < 0).any() else kept).to_batches()

    return points.select(*by, "p", "w", "x").mapInArrow(assign, schema), scopes, np.array(first)


def _by_scope(table: pa.Table, by: list[str], known) -> Iterator[tuple[tuple, np.ndarray]]:
    """Row numbers of each scope that occurs in ``known``."""
    if not by:
        if () in known:
            yield (), np.arange(table.num_rows)
        return
    scopes = list(zip(*[table.column(c).to_pylist() for c in by]))
    for s in set(scopes):
        if s in known:
            yield s, np.flatnonzero([t == s for t in scopes])


def _search(queries: DataFrame, blocks: Blocks, kernel, own_block: bool, nearest: bool = False) -> DataFrame:
    """Run a kernel for every query against each block it may have to visit.

    ``queries`` has ``by``, ``p``, ``x`` and ``reach`` (how far a useful point
    may be). With ``own_block=False`` blocks equal to the query's ``blk`` are
    left out. ``nearest`` says that only the nearest point counts. Where many
    queries of a block have to visit another block, that block is sent to them
    as one; single queries are sent to the block.
    """
    if blocks.single:
        return _asked(queries.withColumn("blk", F.lit(0)), blocks, kernel)
    routed = materialize(_route(queries, blocks, own_block, nearest))
    found = _asked(routed.filter(F.col("home").isNull()).drop("home"), blocks, kernel)
    if "blk" not in queries.columns:
        return found
    return found.unionByName(_met(queries, routed.filter(F.col("home").isNotNull()).select("home", "blk"), blocks, kernel))


def _kernel_task(kernel, by: list[str], schema: T.StructType):
    arrow = pa.schema(list(zip(schema.names, _arrow_types(schema))))

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        one_blas_thread()
        if not left.num_rows or not right.num_rows:
            return arrow.empty_table()
        return kernel.run(left, right, by).cast(arrow)

    return run


def _asked(routed: DataFrame, blocks: Blocks, kernel) -> DataFrame:
    """Queries sent to the block ``blk`` each has to visit, in bounded chunks."""
    by = blocks.by
    # With one block per scope the scope alone is the key; without scopes there
    # is one count, which needs no join.
    on = list(by) if blocks.single else [*by, "blk"]
    salts = F.ceil(F.count(F.lit(1)) / QUERY_CHUNK).cast("int").alias("_salts")
    load = routed.groupBy(*on).agg(salts) if on else routed.agg(F.greatest(salts, F.lit(1)).alias("_salts"))

    def with_load(df: DataFrame) -> DataFrame:
        return df.join(load, on) if on else df.withColumn("_salts", load.scalar())

    base = with_load(blocks.points).withColumn("salt", F.explode(F.sequence(F.lit(0), F.col("_salts") - 1)))
    salted = with_load(routed).withColumn("salt", F.pmod(F.xxhash64("p"), F.col("_salts")).cast("int"))
    group = [*by, "blk", "salt"]
    schema = kernel.schema(blocks.by_fields)
    return (
        salted.select(*group, "p", "x", "reach")
        .groupBy(*group)
        .cogroup(base.select(*group, "p", "w", "x").groupBy(*group))
        .applyInArrow(_kernel_task(kernel, by, schema), schema)
    )


def _met(queries: DataFrame, pairs: DataFrame, blocks: Blocks, kernel) -> DataFrame:
    """Blocks of queries (``home``) with the blocks they visit, ``MET`` of these at a time."""
    by, group = blocks.by, [*blocks.by, "home", "run"]
    place = F.row_number().over(W.partitionBy("home").orderBy("blk"))
    runs = pairs.withColumn("run", F.floor((place - 1) / MET).cast("int"))
    left = queries.select(*by, "p", "x", "reach", F.col("blk").alias("home")).join(runs.select("home", "run").distinct(), "home")
    right = blocks.points.select(*by, "p", "w", "x", "blk").join(runs, "blk")
    schema = kernel.schema(blocks.by_fields)
    return (
        left.select(*[F.col(c).alias(c) for c in [*group, "p", "x", "reach"]])
        .groupBy(*group)
        .cogroup(right.select(*[F.col(c).alias(c) for c in [*group, "p", "w", "x"]]).groupBy(*group))
        .applyInArrow(_kernel_task(kernel, by, schema), schema)
    )


def _arrow_types(schema: T.StructType) -> list[pa.DataType]:
    known = {T.StringType(): pa.string(), T.LongType(): pa.int64(), T.IntegerType(): pa.int32(), T.DoubleType(): pa.float64()}
    return [known[f.dataType] for f in schema.fields]


def _gaps(x: np.ndarray, lo: np.ndarray, hi: np.ndarray, far: bool = False) -> np.ndarray:
    """Distance of every point to the nearest (or farthest) place in every box."""
    total = np.zeros((len(x), len(lo)))
    for j in range(lo.shape[1]):
        v = x[:, j, None]
        below, above = lo[None, :, j] - v, v - hi[None, :, j]
        out = np.maximum(np.abs(below), np.abs(above)) if far else np.maximum(np.maximum(below, above), 0.0)
        total += out * out
    return np.sqrt(total)


def _visits(x: np.ndarray, reach: np.ndarray, lo: np.ndarray, hi: np.ndarray, nearest: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of point and box no farther than the point's reach.

    Boxes are numbered along the cut tree, so runs of them lie together: the
    boxes of a run are looked at only by the points that reach the run's own
    box. With ``nearest`` the reach shrinks first to the farthest place of the
    box where that is least, as every box holds a point.
    """
    runs = [slice(a, a + BOX_RUN) for a in range(0, len(lo), BOX_RUN)]
    run_lo, run_hi = np.array([lo[r].min(0) for r in runs]), np.array([hi[r].max(0) for r in runs])
    near = _gaps(x, run_lo, run_hi)
    if nearest:
        reach = np.minimum(reach, _gaps(x, run_lo, run_hi, far=True).min(1))
        closest = near.argmin(1)
        for k in np.unique(closest):
            rows = np.flatnonzero(closest == k)
            reach[rows] = np.minimum(reach[rows], _gaps(x[rows], lo[runs[k]], hi[runs[k]], far=True).min(1))
    limit = reach * _SLACK + 1e-12
    points, boxes = [], []
    for k, r in enumerate(runs):
        rows = np.flatnonzero(near[:, k] <= limit)
        if len(rows):
            hit, box = np.nonzero(_gaps(x[rows], lo[r], hi[r]) <= limit[rows, None])
            points.append(rows[hit])
            boxes.append(box + r.start)
    return (np.concatenate(points), np.concatenate(boxes)) if points else (np.empty(0, np.int64), np.empty(0, np.int64))


def _route(queries: DataFrame, blocks: Blocks, own_block: bool, nearest: bool = False) -> DataFrame:
    """The blocks to visit: a row per query and block, or a row without query
    (``home``, ``blk``) where at least one in ``DENSE`` queries of a block visit it."""
    by = blocks.by
    by_scope: dict[tuple, list] = {}
    for s, lo, hi, i in blocks.boxes:
        by_scope.setdefault(s, []).append((lo, hi, i))
    packed = queries.sparkSession.sparkContext.broadcast(
        {s: tuple(np.array(v) for v in zip(*items)) for s, items in by_scope.items()}
    )
    # A scope that fits one block has nowhere else to look.
    solo = queries.sparkSession.sparkContext.broadcast(blocks.solo if own_block else {})
    cols = [*by, "p", "x", "reach"]
    schema = T.StructType([*[T.StructField(c, queries.schema[c].dataType) for c in cols], T.StructField("blk", T.IntegerType()), T.StructField("home", T.IntegerType())])
    arrow = to_arrow_schema(schema)

    def single(bare: pa.Table, rows: np.ndarray, blk: np.ndarray) -> pa.Table:
        found = bare.take(pa.array(rows)).append_column("blk", pa.array(blk.astype(np.int32)))
        return found.append_column("home", pa.nulls(len(rows), pa.int32())).cast(arrow)

    def tiles(table: pa.Table, rows: np.ndarray, home: np.ndarray | None) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        x, reach = _vectors(table), table.column("reach").to_numpy()
        lo, hi, number = packed.value[tuple(table.column(c)[int(rows[0])].as_py() for c in by)]
        for start in range(0, len(rows), _TILE):
            part = rows[start : start + _TILE]
            qi, bi = _visits(x[part], reach[part].copy(), lo, hi, nearest)
            qi, blk = part[qi], number[bi]
            if home is not None and not own_block:
                other = blk != home[qi]
                qi, blk = qi[other], blk[other]
            yield qi, blk

    def visit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            table = pa.Table.from_batches([batch])
            for s, rows in _by_scope(table, by, solo.value):
                yield from single(table, rows, np.full(len(rows), solo.value[s])).to_batches()
            for _, rows in _by_scope(table, by, packed.value):
                for qi, blk in tiles(table, rows, None):
                    yield from single(table, qi, blk).to_batches()

    def visit_block(table: pa.Table) -> pa.Table:
        scope, rows = tuple(table.column(c)[0].as_py() for c in by), np.arange(table.num_rows)
        bare, home = table.select(cols), table.column("blk").to_numpy()
        if scope in solo.value:
            return single(bare, rows, np.full(len(rows), solo.value[scope]))
        if scope not in packed.value:
            return arrow.empty_table()
        count: dict[int, int] = {}
        for _, blk in tiles(table, rows, home):
            for b, n in zip(*np.unique(blk, return_counts=True)):
                count[int(b)] = count.get(int(b), 0) + int(n)
        dense = np.array(sorted(b for b, n in count.items() if n * DENSE >= len(rows)), np.int32)
        out = []
        for qi, blk in tiles(table, rows, home):
            alone = ~np.isin(blk, dense)
            out.append(single(bare, qi[alone], blk[alone]))
        first = bare.slice(0, 1).take(pa.array(np.zeros(len(dense), np.int64)))
        together = pa.table({f.name: first.column(f.name) if f.name in by else pa.nulls(len(dense), f.type) for f in list(arrow)[: len(cols)]} | {"blk": pa.array(dense), "home": pa.array(np.full(len(dense), home[0], np.int32))})
        return pa.concat_tables([*out, together.cast(arrow)])

    if "blk" in queries.columns:
        return queries.select(*cols, "blk").groupBy(*by, "blk").applyInArrow(visit_block, schema)
    return queries.select(*cols).mapInArrow(visit, schema)


def _best(edges: DataFrame, by: list[str], k: int) -> DataFrame:
    """``k`` nearest per query; the bounded lists of the visited blocks meet here."""
    place = F.row_number().over(W.partitionBy(*by, "p").orderBy("dist", "o"))
    return edges.withColumn("place", place).filter(F.col("place") <= k)


def nearest_points(blocks: Blocks, k: int) -> DataFrame:
    """``k`` nearest other distinct points: ``by, p, o, dist, w, place``."""
    kernel = _TopK(k, blocks.key_type)
    own = blocks.points.withColumn("reach", F.lit(float("inf")))
    local = materialize(_local(own, blocks, kernel))  # one block per point: no more than k each
    if blocks.single:
        return _best(local, blocks.by, k)
    # A query that already has k neighbours never needs to look further than the k-th.
    bound = local.groupBy(*blocks.by, "p").agg(F.max("dist").alias("_far"), F.count(F.lit(1)).alias("_n"))
    reach = F.when(F.col("_n") >= k, F.col("_far")).otherwise(float("inf"))
    asked = blocks.points.join(bound, [*blocks.by, "p"], "left").withColumn("reach", F.coalesce(reach, F.lit(float("inf"))))
    remote = _search(asked, blocks, kernel, own_block=False)
    return _best(local.unionByName(remote), blocks.by, k)


def _local(points: DataFrame, blocks: Blocks, kernel) -> DataFrame:
    """Each block searched with its own points as queries."""
    schema = kernel.schema(blocks.by_fields)
    by = blocks.by

    def run(table: pa.Table) -> pa.Table:
        one_blas_thread()
        return kernel.run(table, table, by).cast(pa.schema(list(zip(schema.names, _arrow_types(schema)))))

    return points.select(*by, "blk", "p", "w", "x", "reach").groupBy(*by, "blk").applyInArrow(run, schema)


# ---------------------------------------------------------------- operators


#: Lists of the k nearest other distinct points (``by, p, o, dist, w``) of materialized points (``by, p, w, x``).
Lists = Callable[[DataFrame, list[str], int], DataFrame]


def exact_lists(block_rows: int = BLOCK_ROWS) -> Lists:
    """The method of all operators here unless another one is given."""

    def lists(points: DataFrame, by: list[str], k: int) -> DataFrame:
        kind = points.schema["p"].dataType
        if not isinstance(kind, (T.LongType, T.IntegerType)):  # other keys go by their places in order
            ordered = points.repartitionByRange(F.col("p").asc_nulls_last()).sortWithinPartitions(F.col("p").asc_nulls_last())
            points = materialize(ordered.withColumnRenamed("p", "_name").withColumn("p", F.monotonically_increasing_id()))
        blocks = numbered_blocks(points, by, block_rows)
        if blocks is None:
            whole = points.withColumn("p", F.col("_name")).drop("_name") if "_name" in points.columns else points
            return nearest_points(make_blocks(whole, by, block_rows), k).drop("place")
        found = stream_lists(points, by, k, blocks, _vectors)
        if "_name" in points.columns:
            names = points.select(*by, "p", "_name")
            found = found.join(names, [*by, "p"]).drop("p").withColumnRenamed("_name", "p")
            found = found.join(names.withColumnsRenamed({"p": "o", "_name": "_o"}), [*by, "o"]).drop("o").withColumnRenamed("_o", "o")
            found = found.filter(F.col("p") != F.col("o"))
        found = found.select(*by, F.col("p").cast(kind).alias("p"), F.col("o").cast(kind).alias("o"), "dist", "w")
        if points.groupBy(*by, "_name" if "_name" in points.columns else "p").count().filter("count > 1").limit(1).count():
            found = _best(found, by, k).drop("place")  # one list a key
        return found

    return lists


def _digest(x: Column) -> Column:
    """Equal for vectors that a group takes for equal: zeros have no sign there."""
    return F.unhex(F.sha2(F.transform(x, lambda v: v + F.lit(0).cast("float")).cast("string").cast("binary"), 256))


def knn(df: DataFrame, key: str, vec: str, k: int, by: Sequence[str] = (), block_rows: int = BLOCK_ROWS, lists: Lists | None = None, written: bool = False) -> DataFrame:
    """``k`` nearest other rows: ``by, key, neighbor, dist, place``; ties by key. Exact unless ``lists`` is another method.

    ``written`` says that ``df`` only reads written tables, so that its vectors are the same each time.
    """
    by = list(by)
    kind = df.select(vec).schema[0].dataType
    narrow = isinstance(kind, T.ArrayType) and isinstance(kind.elementType, T.FloatType)
    source = df.select(*by, F.col(key).alias("key"), F.col(vec).alias("x")) if narrow else df.select(*by, F.col(key).alias("key"), F.col(vec).cast("array<double>").alias("x"))
    fixed = source if written else materialize(source)
    points = materialize(distinct_points(fixed, by))
    edges = (lists or exact_lists(block_rows))(points, by, k).drop("w")
    itself = points.select(*by, "p", F.col("p").alias("o"), F.lit(0.0).alias("dist"))
    groups = edges.unionByName(itself)
    # The first k + 1 rows of every group of copies are enough for any list.
    # Rows meet their point by a digest of the vector, which is shorter.
    rows = fixed.select(*by, F.col("key").alias("_key"), _digest(F.col("x")).alias("_x"))
    rows = materialize(rows.join(points.select(*by, _digest(F.col("x")).alias("_x"), "p"), [*by, "_x"]).drop("_x"))
    copy_no = F.row_number().over(W.partitionBy(*by, "p").orderBy("_key"))
    members = rows.withColumn("_r", copy_no).filter(F.col("_r") <= k + 1).select(*by, F.col("p").alias("o"), F.col("_key").alias("neighbor"))
    # Members are attached to the k nearest groups of each distinct vector, then
    # cut back to k + 1 before they meet the rows.
    order = W.partitionBy(*by, "p").orderBy("dist", "neighbor")
    lists = groups.join(members, [*by, "o"]).withColumn("_r", F.row_number().over(order)).filter(F.col("_r") <= k + 1)
    mine = W.partitionBy(*by, "_key").orderBy("dist", "neighbor")
    pairs = rows.join(lists.select(*by, "p", "neighbor", "dist"), [*by, "p"]).filter(F.col("neighbor") != F.col("_key"))
    ranked = pairs.withColumn("place", F.row_number().over(mine)).filter(F.col("place") <= k)
    return ranked.select(*by, F.col("_key").alias(key), "neighbor", "dist", F.col("place").cast("bigint").alias("place"))


def within_radius_count(df: DataFrame, key: str, vec: str, eps: float, by: Sequence[str] = (), block_rows: int = BLOCK_ROWS) -> DataFrame:
    """Number of rows within ``eps`` of each row, itself included."""
    by = list(by)
    rows = fixed_rows(df, key, vec, by)
    points = materialize(distinct_points(rows, by))
    blocks = make_blocks(points, by, block_rows)
    asked = blocks.points.withColumn("reach", F.lit(float(eps)))
    kernel = _CountWithin(blocks.key_type)
    found = _local(asked, blocks, kernel) if blocks.single else _search(asked, blocks, kernel, own_block=True)
    counts = found.groupBy(*by, "p").agg(F.sum("n").alias("n_within"))
    return _to_rows(rows, key, by, points, counts)


def _to_rows(rows: DataFrame, key: str, by: list[str], points: DataFrame, scores: DataFrame) -> DataFrame:
    """Scores of distinct points handed to every row with that vector."""
    per_vector = points.select(*by, "x", "p").join(scores, [*by, "p"]).drop("p")
    return rows.join(per_vector, [*by, "x"]).drop("x").withColumnRenamed("key", key)


@dataclass(frozen=True)
class Neighborhood:
    """Neighbour lists of the distinct points, shared by LOF and DBSCAN.

    ``edges`` lists, per point, its own copies at distance 0 first and then the
    nearest other points; ``before`` is the number of rows listed earlier.
    """

    source: DataFrame  # by, key, x
    points: DataFrame  # by, name (least key), p (number in the order of names), w, x
    edges: DataFrame  # by, p, o, dist, w, before
    sizes: DataFrame  # by, n
    by: list[str]


def dbscan_min_samples(n: Column) -> Column:
    """max(5, ceil(ln n) + 1)."""
    return F.greatest(F.lit(5), F.ceil(F.ln(n.cast("double"))).cast("int") + 1)


def lof_neighbors(n: Column, k: int = 20) -> Column:
    """max(2, min(k, n - 1))."""
    return F.greatest(F.lit(2), F.least(F.lit(k), n.cast("int") - 1))


def neighborhood(df: DataFrame, key: str, vec: str, by: Sequence[str] = (), k: int = 20, min_k: int = 0, block_rows: int = BLOCK_ROWS, written: bool = False, lists: Lists | None = None) -> Neighborhood:
    """Lists long enough for LOF with ``k`` and DBSCAN's k-distance. ``written`` says that ``df`` is a written table."""
    by = list(by)
    source = fixed_rows(df, key, vec, by, written)
    # Points go by numbers in the order of their keys, which are shorter than most keys.
    named = distinct_points(source, by).withColumnRenamed("p", "name")
    points = materialize(named.repartitionByRange("name").sortWithinPartitions("name").withColumn("p", F.monotonically_increasing_id()))
    sizes = points.groupBy(*by).agg(F.sum("w").alias("n"))
    n_max = sizes.agg(F.max("n")).first()[0] or 1
    depth = max(k, min_k, max(5, math.ceil(math.log(max(n_max, 1))) + 1) - 1)
    blocks = numbered_blocks(points, by, block_rows) if lists is None else None
    if blocks is not None:
        return Neighborhood(source, points, materialize(stream_lists(points, by, depth, blocks, _vectors, counted=True)), sizes, by)
    others = (lists or exact_lists(block_rows))(points, by, depth)
    copies = points.filter(F.col("w") > 1).select(
        *by, "p", F.col("p").alias("o"), F.lit(0.0).alias("dist"), (F.col("w") - 1).alias("w")
    )
    ahead = W.partitionBy(*by, "p").orderBy("dist", "o").rowsBetween(W.unboundedPreceding, -1)
    listed = others.unionByName(copies).withColumn("before", F.coalesce(F.sum("w").over(ahead), F.lit(0)))
    edges = materialize(listed.filter(F.col("before") < depth))
    return Neighborhood(source, points, edges, sizes, by)


def _with_size(df: DataFrame, nb: Neighborhood) -> DataFrame:
    if nb.by:
        return df.join(nb.sizes, nb.by)
    return df.withColumn("n", nb.sizes.select("n").scalar())


def lof_points(nb: Neighborhood, k: int = 20) -> DataFrame:
    """Local outlier factor of every distinct point: ``by, p, lof_score``."""
    by = nb.by
    sized = _with_size(nb.edges, nb).withColumn("k", lof_neighbors(F.col("n"), k)).filter(F.col("before") < F.col("k"))
    # The last listed point may stand for more rows than are still needed.
    used = sized.withColumn("w", F.least(F.col("w"), F.col("k") - F.col("before")))
    kdist = used.groupBy(*by, F.col("p").alias("o")).agg(F.max("dist").alias("kdist"))
    reach = used.join(kdist, [*by, "o"]).withColumn("reach", F.greatest("kdist", "dist"))
    lrd = reach.groupBy(*by, "p").agg((1.0 / (F.sum(F.col("w") * F.col("reach")) / F.sum("w") + 1e-10)).alias("lrd"))
    around = used.join(lrd.withColumnsRenamed({"p": "o", "lrd": "lrd_o"}), [*by, "o"])
    mean = around.groupBy(*by, "p").agg((F.sum(F.col("w") * F.col("lrd_o")) / F.sum("w")).alias("_around"))
    return mean.join(lrd, [*by, "p"]).select(*by, "p", (F.col("_around") / F.col("lrd")).alias("lof_score"))


def k_distance(nb: Neighborhood, min_samples: Column | None = None) -> DataFrame:
    """Distance to the (min_samples - 1)-th other row: ``by, p, w, n, m, kdist``."""
    m = min_samples if min_samples is not None else dbscan_min_samples(F.col("n"))
    sized = _with_size(nb.edges, nb).withColumn("m", m).filter(F.col("before") < F.col("m") - 1)
    far = sized.groupBy(*nb.by, "p").agg(F.max("dist").alias("kdist"), F.first("n").alias("n"), F.first("m").alias("m"))
    return nb.points.select(*nb.by, "p", "w").join(far, [*nb.by, "p"])


def dbscan_params(nb: Neighborhood, min_samples: Column | None = None, share: float = 0.95) -> DataFrame:
    """Per scope: row count ``n``, ``min_samples`` and ``eps``."""
    kd = k_distance(nb, min_samples)
    # Every row of a group of copies counts in the percentile.
    eps = quantiles(kd, ["kdist"], [share], nb.by, weight="w")
    eps = eps.select(*nb.by, F.col("kdist")[0].alias("eps"))
    m = min_samples if min_samples is not None else dbscan_min_samples(F.col("n"))
    sized = nb.sizes.withColumn("min_samples", m.cast("bigint"))
    if nb.by:
        return sized.join(eps, nb.by)
    return sized.withColumn("eps", eps.scalar())


def dbscan_points(nb: Neighborhood, min_samples: Column | None = None, params: DataFrame | None = None) -> DataFrame:
    """Core and noise flags of every distinct point.

    A point is core iff its k-distance is at most eps. A point that is not core
    has fewer than ``min_samples - 1`` others within eps, so all of them are in
    its neighbour list and no second range search is needed.
    """
    by = nb.by
    params = dbscan_params(nb, min_samples) if params is None else params
    limits = params.select(*by, "eps", "min_samples")
    kd = k_distance(nb, min_samples)
    if by:
        marked = kd.join(limits, by)
    else:
        packed = limits.select(F.struct("eps", "min_samples").alias("s")).scalar()
        marked = kd.withColumn("_s", packed).withColumns({"eps": F.col("_s.eps"), "min_samples": F.col("_s.min_samples")}).drop("_s")
    enough = F.col("n") >= F.col("min_samples") + 1
    core = marked.select(*by, "p", "eps", enough.alias("_enough"), (enough & (F.col("kdist") <= F.col("eps"))).alias("core"))
    core = materialize(core)
    cores = core.filter("core").select(*by, F.col("p").alias("o"))
    touched = (
        nb.edges.filter(F.col("p") != F.col("o"))
        .join(core.filter(~F.col("core")).select(*by, "p", "eps"), [*by, "p"])
        .filter(F.col("dist") <= F.col("eps"))
        .join(cores, [*by, "o"], "left_semi")
        .select(*by, "p")
        .distinct()
        .withColumn("_border", F.lit(True))
    )
    noise = (F.col("_enough") & ~F.col("core") & F.col("_border").isNull()).cast("int")
    joined = core.join(touched, [*by, "p"], "left")
    return joined.select(*by, "p", F.col("core").cast("int").alias("core"), noise.alias("dbscan_anomaly"), "eps")


def density_points(nb: Neighborhood, k: int = 20) -> tuple[DataFrame, DataFrame]:
    """LOF and DBSCAN noise together: ``by, p, lof_score, dbscan_anomaly``, and the
    DBSCAN parameters per scope.

    Both look the same neighbours up, so they share the two joins.
    """
    by = nb.by
    sized = _with_size(nb.edges, nb).withColumns({"k": lof_neighbors(F.col("n"), k), "m": dbscan_min_samples(F.col("n"))})
    used = sized.withColumn("lw", F.greatest(F.lit(0), F.least(F.col("w"), F.col("k") - F.col("before"))))
    reach = used.groupBy(*by, "p").agg(
        F.max(F.when(F.col("lw") > 0, F.col("dist"))).alias("kdist"),
        F.max(F.when(F.col("before") < F.col("m") - 1, F.col("dist"))).alias("ddist"),
        F.first("n").alias("n"),
        F.first("m").cast("bigint").alias("min_samples"),
    )
    reach = materialize(nb.points.select(*by, "p", F.col("w").alias("copies")).join(reach, [*by, "p"]))
    eps = quantiles(reach, ["ddist"], [0.95], by, weight="copies", written=True)
    sizes = reach.groupBy(*by).agg(F.first("n").alias("n"), F.first("min_samples").alias("min_samples"))
    params = materialize(attach(sizes, eps.select(*by, F.col("ddist")[0].alias("eps")), by))

    own = attach(reach, params.select(*by, "eps"), by).withColumn("core", F.col("ddist") <= F.col("eps"))
    other = own.select(*by, F.col("p").alias("o"), "kdist", F.col("core").alias("core_o"), "eps")
    looked = used.join(other, [*by, "o"])
    reachable = F.greatest("kdist", "dist")
    lrd = looked.groupBy(*by, "p").agg(
        (1.0 / (F.sum(F.col("lw") * reachable) / F.sum("lw") + 1e-10)).alias("lrd"),
        F.max(F.when((F.col("p") != F.col("o")) & (F.col("dist") <= F.col("eps")), F.col("core_o").cast("int"))).alias("touches"),
    )
    lrd = materialize(lrd)
    around = used.filter(F.col("lw") > 0).join(lrd.select(*by, F.col("p").alias("o"), F.col("lrd").alias("lrd_o")), [*by, "o"])
    mean = around.groupBy(*by, "p").agg((F.sum(F.col("lw") * F.col("lrd_o")) / F.sum("lw")).alias("_around"))
    joined = own.join(lrd, [*by, "p"]).join(mean, [*by, "p"], "left")
    enough = F.col("n") >= F.col("min_samples") + 1
    noise = enough & ~F.col("core") & (F.coalesce("touches", F.lit(0)) == 0)
    return joined.select(*by, "p", (F.col("_around") / F.col("lrd")).alias("lof_score"), noise.cast("int").alias("dbscan_anomaly")), params


def point_scores(nb: Neighborhood, key: str, scores: DataFrame) -> DataFrame:
    return _to_rows(nb.source, key, nb.by, nb.points, scores)


def dbscan_noise(df: DataFrame, key: str, vec: str, by: Sequence[str] = (), block_rows: int = BLOCK_ROWS) -> DataFrame:
    nb = neighborhood(df, key, vec, by, block_rows=block_rows)
    scores = dbscan_points(nb).select(*nb.by, "p", "core", "dbscan_anomaly")
    return point_scores(nb, key, scores)


def lof(df: DataFrame, key: str, vec: str, k: int = 20, by: Sequence[str] = (), block_rows: int = BLOCK_ROWS) -> DataFrame:
    nb = neighborhood(df, key, vec, by, k=k, block_rows=block_rows)
    return point_scores(nb, key, lof_points(nb, k))


def dbscan_clusters(df: DataFrame, key: str, vec: str, by: Sequence[str] = (), min_samples: int | None = None, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """Cluster label per row: smallest core key of its component, NULL for noise.

    A border row takes the smallest label among the cores within eps.
    """
    by = list(by)
    depth = 0 if min_samples is None else min_samples - 1
    nb = neighborhood(df, key, vec, by, min_k=depth, block_rows=block_rows)
    m = None if min_samples is None else F.lit(min_samples)
    state = materialize(dbscan_points(nb, m))
    cores = materialize(nb.points.join(state.filter("core = 1").select(*by, "p", "eps"), [*by, "p"]))
    blocks = make_blocks(cores.select(*by, "p", "w", "x"), by, block_rows)
    asked = blocks.points.join(cores.select(*by, "p", "eps"), [*by, "p"]).withColumnRenamed("eps", "reach")
    kernel = _Forest(blocks.key_type)
    local = _local(asked, blocks, kernel)
    links = local if blocks.single else local.unionByName(_search(asked, blocks, kernel, own_block=False))
    labels = connected_components(links.select(*by, "a", "b"), by, done=blocks.single)
    named = cores.select(*by, "p").join(labels.withColumnRenamed("a", "p"), [*by, "p"], "left")
    named = materialize(named.select(*by, "p", F.coalesce("label", "p").alias("cluster")))
    border = (
        nb.edges.filter(F.col("p") != F.col("o"))
        .join(state.filter("core = 0").select(*by, "p", "eps"), [*by, "p"])
        .filter(F.col("dist") <= F.col("eps"))
        .join(named.withColumnRenamed("p", "o"), [*by, "o"])
        .groupBy(*by, "p")
        .agg(F.min("cluster").alias("cluster"))
    )
    scores = nb.points.select(*by, "p").join(named.unionByName(border), [*by, "p"], "left")
    names = nb.points.select(*by, F.col("p").alias("cluster"), F.col("name").alias("_name"))
    scores = scores.join(names, [*by, "cluster"], "left").select(*by, "p", F.col("_name").alias("cluster"))
    return point_scores(nb, key, scores)


def connected_components(links: DataFrame, by: Sequence[str] = (), done: bool = False) -> DataFrame:
    """Component label (smallest member) of every linked node: ``by, a, label``.

    Alternates the two star steps of Kiveris et al. (2014): every node's larger
    neighbours, then its smaller ones, are linked to its smallest neighbour.
    Each step is an aggregate and a join, written out so that lineage stays
    short; no join key gets more than its share of the edges. ``done`` says the links are already stars.
    """
    by = list(by)
    star = links.filter(F.col("a") != F.col("b")).select(*by, F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    if done:
        return star.groupBy(*by, "a").agg(F.min("b").alias("label"))
    edges = materialize(star)
    before = None
    while True:  # every round but the last changes an edge
        edges = materialize(_small_star(materialize(_large_star(edges, by)), by))
        now = tuple(edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())
        if now == before:
            break
        before = now
    return edges.groupBy(*by, "a").agg(F.min("b").alias("label"))


def _large_star(edges: DataFrame, by: list[str]) -> DataFrame:
    both = edges.select(*by, "a", "b").unionByName(edges.select(*by, F.col("b").alias("a"), F.col("a").alias("b")))
    linked = _to_smallest(both, by).filter(F.col("b") > F.col("a"))
    return linked.select(*by, F.col("b").alias("a"), F.least("a", "m").alias("b")).distinct()


def _small_star(edges: DataFrame, by: list[str]) -> DataFrame:
    linked = _to_smallest(edges, by)
    low = linked.filter(F.col("b") != F.col("m")).select(*by, F.col("b").alias("a"), F.col("m").alias("b"))
    top = linked.select(*by, "a", F.col("m").alias("b"))
    return low.unionByName(top).distinct()


def _to_smallest(edges: DataFrame, by: list[str]) -> DataFrame:
    """Edges with the smallest neighbour ``m`` of their first node; hubs are spread over the tasks."""
    key = [*by, "a"]
    smallest = materialize(edges.groupBy(*key).agg(F.min("b").alias("m"), F.count(F.lit(1)).alias("_degree")))
    return join_hot(edges, smallest, key, "_degree")


def core_distance(df: DataFrame, key: str, vec: str, by: Sequence[str] = (), min_samples: int | None = None, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """Distance to the nearest core row; 0 for a core, or where no row is core."""
    by = list(by)
    depth = 0 if min_samples is None else min_samples - 1
    nb = neighborhood(df, key, vec, by, min_k=depth, block_rows=block_rows)
    state = materialize(dbscan_points(nb, None if min_samples is None else F.lit(min_samples)))
    cores = state.filter("core = 1").select(*by, F.col("p").alias("o"))
    outside = state.filter("core = 0").select(*by, "p")
    near = nb.edges.join(outside, [*by, "p"]).join(cores, [*by, "o"], "left_semi").groupBy(*by, "p").agg(F.min("dist").alias("d"))
    near = materialize(near)
    # Points with no core in their list search the cores only.
    lost = nb.points.join(outside, [*by, "p"], "left_semi").join(near, [*by, "p"], "left_anti").select(*by, "p", "x")
    base = materialize(nb.points.join(cores.withColumnRenamed("o", "p"), [*by, "p"], "left_semi"))
    blocks = make_blocks(base, by, block_rows)
    reach = lost.withColumn("reach", F.lit(float("inf")))
    far = _search(reach, blocks, _TopK(1, blocks.key_type), own_block=True, nearest=True).groupBy(*by, "p").agg(F.min("dist").alias("d"))
    scores = nb.points.select(*by, "p").join(near.unionByName(far), [*by, "p"], "left")
    scores = scores.select(*by, "p", F.coalesce("d", F.lit(0.0)).alias("dbscan_severity"))
    return point_scores(nb, key, scores)
