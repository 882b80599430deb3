"""Lists of the nearest points, exact, by a stream of blocks past held queries.

Points lie in blocks by median cuts, a block in leaves of few points with a
bounding box each. A task holds the queries of a run of blocks and the best
``k`` found for each of them so far; the blocks that any of them may have to
visit pass by, each once. A leaf of queries looks only at leaves nearer than
the worst of its lists, which get shorter as blocks pass. A list is finished in
its task, so nothing but finished lists is shuffled, and a block is sent to a
task once, whatever the number of queries that visit it.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from waypost.session import materialize, one_blas_thread

LEAF = 64  # points with a box of their own
TILE = 256  # queries compared at a time
PART = 16384  # base points compared at a time
FIRST = 256  # points looked at before there is a reach
PASS, PASS_BYTES = 65536, 32 << 20  # base points, and bytes of them, that pass at a time
HELD_BYTES = 96 << 20  # of queries and their lists in a task
LEAST = 8192  # queries in a task, if there are so many
NO_KEY = np.iinfo(np.int64).max  # stands for a missing key, which is last among equals
_SLACK = 1 + 1e-9
_SINGLE, _DOUBLE = float(np.finfo(np.float32).eps), float(np.finfo(np.float64).eps)
_WILD = 1e15  # the square of more is too large for single precision


def leaves_of(x: np.ndarray, size: int = LEAF) -> tuple[np.ndarray, np.ndarray]:
    """Row numbers, those of a leaf together, and the first place of each leaf: cuts of the widest dimension near its median.

    A cut lies between different values, so that boxes beside it do not meet.
    """
    todo, out = [np.arange(len(x))], []
    while todo:
        rows = todo.pop()
        if len(rows) <= size:
            out.append(rows)
            continue
        part = x[rows]
        column = part[:, int(part.std(axis=0).argmax())]
        middle = np.partition(column, len(rows) // 2)[len(rows) // 2]
        below, upto = column < middle, column <= middle
        left = below if abs(2 * int(below.sum()) - len(rows)) < abs(2 * int(upto.sum()) - len(rows)) else upto
        if left.all() or not left.any():
            left = np.arange(len(rows)) < len(rows) // 2
        todo += [rows[~left], rows[left]]
    starts = np.cumsum([0, *[len(r) for r in out]])[:-1]
    return np.concatenate(out) if out else np.zeros(0, np.int64), starts.astype(np.int64)


class Points:
    """Points in leaves: ``starts`` has the first row of each leaf, ``lo`` and ``hi`` its box."""

    def __init__(self, x: np.ndarray, key: np.ndarray, w: np.ndarray, starts: np.ndarray) -> None:
        self.x, self.key, self.w, self.starts = x, key, w, starts
        self.sizes = np.diff(np.append(starts, len(x)))
        self.lo, self.hi = (f.reduceat(x, starts).astype(np.float64) for f in (np.fmin, np.fmax))
        # In single precision about a place amid them, to preselect by; the last column is the square. Not a
        # number where single precision is no help.
        tame = (np.abs(x) < _WILD).all(axis=1)
        self.centre = x[tame].mean(axis=0, dtype=np.float64) if tame.any() else np.zeros(x.shape[1])
        self.size = float(np.abs(x[tame]).max(initial=0))
        self.near = np.full((len(x), x.shape[1] + 1), np.nan, np.float32)
        self.near[tame, :-1] = x[tame] - self.centre
        self.near[tame, -1] = np.einsum("ij,ij->i", self.near[tame, :-1], self.near[tame, :-1])

    def rows_of(self, leaves: np.ndarray) -> np.ndarray:
        sizes = self.sizes[leaves]
        before = np.cumsum(sizes) - sizes
        return np.repeat(self.starts[leaves] - before, sizes) + np.arange(int(sizes.sum()))


def boxes_near(lo: np.ndarray, hi: np.ndarray, other_lo: np.ndarray, other_hi: np.ndarray, far: np.ndarray) -> np.ndarray:
    """Which other boxes are no farther from each box than ``far``, or a trifle farther."""
    with np.errstate(over="ignore"):
        limit = np.square(far * _SLACK + 1e-12).astype(np.float32) * np.float32(1 + 1e-5)
    total = np.zeros((len(lo), len(other_lo)), np.float32)
    above, below = np.empty_like(total), np.empty_like(total)
    with np.errstate(over="ignore", invalid="ignore"):
        for j in range(lo.shape[1]):
            # Boxes are a little larger in single precision, never smaller.
            centre = float(np.median(lo[:, j]))
            a, b, c, d = ((v[:, j] - centre).astype(np.float32) for v in (lo, hi, other_lo, other_hi))
            a, c = (v - np.abs(v) * np.float32(2 * _SINGLE) for v in (a, c))
            b, d = (v + np.abs(v) * np.float32(2 * _SINGLE) for v in (b, d))
            np.subtract(c[None, :], b[:, None], out=above)
            np.subtract(a[:, None], d[None, :], out=below)
            np.maximum(above, below, out=above)
            np.maximum(above, 0, out=above)
            np.multiply(above, above, out=above)
            total += above
    return ~(total > limit[:, None])  # what cannot be said counts as near


def places(mask: np.ndarray) -> np.ndarray:
    """``flatnonzero`` of a table of few true cells: eight cells are looked at together."""
    flat = mask.ravel()
    whole = len(flat) // 8 * 8
    words = np.flatnonzero(flat[:whole].view(np.uint64))
    at, cell = np.nonzero(flat[:whole].reshape(-1, 8)[words])
    return np.concatenate([words[at] * 8 + cell, np.flatnonzero(flat[whole:]) + whole])


def _exact(a: np.ndarray, b: np.ndarray, qi: np.ndarray, bi: np.ndarray) -> np.ndarray:
    """Distances of pairs of rows, summed in column order."""
    out = np.zeros(len(qi))
    for start in range(0, len(qi), 1 << 16):
        part = slice(start, start + (1 << 16))
        left, right = a[qi[part]].astype(np.float64), b[bi[part]].astype(np.float64)
        left -= right
        left *= left
        total = np.zeros(len(left))
        for j in range(left.shape[1]):
            total += left[:, j]
        out[part] = np.sqrt(total)
    return out


class Best:
    """The ``k`` nearest points found so far for each query, nearest first, ties by key."""

    def __init__(self, queries: Points, k: int, reach: np.ndarray) -> None:
        n = len(queries.x)
        self.queries, self.k, self.reach = queries, k, reach.copy()
        self.dist, self.key, self.w = np.full((n, k), np.inf), np.zeros((n, k), np.int64), np.zeros((n, k), np.int64)

    def look(self, base: Points) -> None:
        q = self.queries
        far = np.maximum.reduceat(self.reach, q.starts)
        todo = boxes_near(q.lo, q.hi, base.lo, base.hi, far)
        asked = np.flatnonzero(todo.any(axis=1))
        if not len(asked):
            return
        if todo[asked].mean() > 0.5:  # boxes say little: all of the points, more queries at a time
            rows = q.rows_of(asked)
            for start in range(0, len(rows), TILE):
                self._compare(rows[start : start + TILE], base, None)
            return
        for i in asked:
            self._compare(np.arange(q.starts[i], q.starts[i] + q.sizes[i]), base, base.rows_of(np.flatnonzero(todo[i])))

    def _compare(self, rows: np.ndarray, base: Points, take: np.ndarray | None) -> None:
        n = len(base.x) if take is None else len(take)
        for start in range(0, n, PART):
            part = slice(start, start + PART) if take is None else take[start : start + PART]
            qi, bi, near = _within_reach(self.queries.x[rows], base, part, self.k, self.reach[rows])
            if len(qi):
                bi = bi + start if take is None else part[bi]
                self._add(rows, qi, base.key[bi], base.w[bi], near)

    def _add(self, rows: np.ndarray, qi: np.ndarray, key: np.ndarray, w: np.ndarray, near: np.ndarray) -> None:
        hit, qi = np.unique(qi, return_inverse=True)
        at, k = rows[hit], self.k
        row = np.concatenate([np.repeat(np.arange(len(hit)), k), qi])
        near = np.concatenate([self.dist[at].ravel(), near])
        key, w = np.concatenate([self.key[at].ravel(), key]), np.concatenate([self.w[at].ravel(), w])
        order = np.lexsort((key, near, row))
        first = np.searchsorted(row[order], np.arange(len(hit)))
        best = order[first[:, None] + np.arange(k)]
        self.dist[at], self.key[at], self.w[at] = near[best], key[best], w[best]
        self.reach[at] = np.minimum(self.reach[at], self.dist[at, -1])


def _within_reach(a: np.ndarray, base: Points, part: slice | np.ndarray, k: int, reach: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Pairs of a query and a row of a part no farther apart than the query's reach, with their distances.

    Of a query's many pairs those that are certainly not among its ``k`` nearest are left out. A matrix
    product in single precision preselects within its error bound; what it lets through is computed again.
    """
    right = base.near[part]
    large = np.abs(a).max(axis=1)
    left = np.where((large < _WILD)[:, None], a - base.centre, np.nan).astype(np.float32)
    aa = np.einsum("ij,ij->i", left, left)
    norm = np.sqrt(aa.astype(np.float64)) + math.sqrt(float(np.fmax.reduce(right[:, -1], initial=0)))
    # Rounding of the product and its sum, of the vectors to single precision, and of their shift to the centre.
    bound = norm * norm * (2 * (a.shape[1] + 4) * _SINGLE) + norm * ((base.size + large) * 8 * math.sqrt(a.shape[1]) * _DOUBLE)
    with np.errstate(over="ignore"):
        most = np.nextafter((reach * reach * (1 + 1e-12) + bound - aa).astype(np.float32), np.float32(np.inf))
    # |b|^2 - 2 a.b <= reach^2 - |a|^2, or it cannot be said
    rough = np.column_stack([-2 * left, np.ones(len(a), np.float32)]) @ right.T
    flat = places(~(rough > most[:, None]))
    qi, bi = flat // len(right), flat % len(right)
    room = 4 * k + FIRST
    if len(qi) > room:
        count = np.bincount(qi, minlength=len(a))
        many = np.flatnonzero(count > room)
        if len(many):
            listed = count[qi] <= room
            # What lies beyond the k-th of the rough distances by both their errors is not among the k nearest.
            kth = np.partition(rough[many], k - 1, axis=1)[:, k - 1].astype(np.float64)
            mi, mb = np.nonzero(~(rough[many] > (kth + 2 * bound[many])[:, None]))
            qi, bi = np.concatenate([qi[listed], many[mi]]), np.concatenate([bi[listed], mb])
    near = _exact(a, base.x[part], qi, bi)
    inside = near <= reach[qi]
    return qi[inside], bi[inside], near[inside]


def first_reach(points: Points, k: int) -> np.ndarray:
    """A distance within which each point has ``k`` points, itself included, as the leaves around its own show."""
    n, out = len(points.x), np.full(len(points.x), np.inf)
    for start, size in zip(points.starts.tolist(), points.sizes.tolist()):
        begin = max(0, min(start - FIRST // 2, n - 2 * FIRST))
        around = points.near[begin : begin + 2 * FIRST]
        if len(around) < k:
            continue
        rows = np.arange(start, start + size)
        left = points.near[rows]
        rough = (left[:, -1:] - 2 * left[:, :-1] @ around[:, :-1].T) + around[:, -1]
        take = np.argpartition(rough, k - 1, axis=1)[:, :k] + begin
        # The farthest of any k points is far enough.
        near = _exact(points.x, points.x, np.repeat(rows, k), take.ravel()).reshape(size, k)
        out[rows] = near.max(axis=1)
    out[np.isnan(out)] = np.inf
    return out


# ---------------------------------------------------------------- distributed

PACKED = "blk int, n int, single boolean, p binary, w binary, x binary, starts binary, reach binary, lo binary, hi binary, far binary, box binary"
SENT = "part int, kind int, blk int, single boolean, p binary, w binary, x binary, starts binary, reach binary"


def _pack(vectors: Callable, k: int) -> Callable[[pa.Table], pa.Table]:
    """Task function: a block as one row, its points in leaves, in single precision where that loses nothing."""

    def run(table: pa.Table) -> pa.Table:
        one_blas_thread()
        x = vectors(table)
        p = table.column("p").cast(pa.int64()).fill_null(NO_KEY).to_numpy()
        by_key = np.lexsort((*x.T[::-1], p)) if len(np.unique(p)) < len(p) else np.argsort(p)
        x, p, w = x[by_key], p[by_key], table.column("w").to_numpy()[by_key]
        with np.errstate(over="ignore"):
            single = bool(np.array_equal(x.astype(np.float32), x, equal_nan=True))
        x = x.astype(np.float32) if single else x
        rows, starts = leaves_of(x)
        points = Points(x[rows], p[rows], w[rows], starts)
        reach = first_reach(points, k)
        far = np.maximum.reduceat(reach, starts)
        cells = {"p": points.key, "w": points.w.astype(np.int64), "x": points.x, "starts": starts, "reach": reach, "lo": points.lo, "hi": points.hi, "far": far, "box": np.array([np.fmin.reduce(points.lo), np.fmax.reduce(points.hi)])}
        row = {"blk": pa.array([table.column("blk")[0].as_py()], pa.int32()), "n": pa.array([len(x)], pa.int32()), "single": pa.array([single])}
        return pa.table(row | {c: pa.array([np.ascontiguousarray(v).tobytes()], pa.binary()) for c, v in cells.items()})

    return run


def _unpack(row: dict, wide: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    x = np.frombuffer(row["x"], np.float32 if row["single"] else np.float64).reshape(-1, wide)
    return x, np.frombuffer(row["p"], np.int64), np.frombuffer(row["w"], np.int64), np.frombuffer(row["starts"], np.int64)


def _together(blocks: list[tuple]) -> Points:
    """Points of several blocks, whose leaves stay as they are."""
    x, p, w, starts = zip(*blocks)
    wider = np.result_type(*x)
    before = np.cumsum([0, *[len(a) for a in x]])[:-1]
    return Points(np.concatenate([a.astype(wider, copy=False) for a in x]), np.concatenate(p), np.concatenate(w), np.concatenate([s + b for s, b in zip(starts, before)]))


def _lists(best: Best, counted: bool) -> Iterator[dict[str, np.ndarray]]:
    """Rows of finished lists. ``counted``: the copies of a point head its list at distance 0, and ``before`` counts the rows listed earlier."""
    mine = best.queries.key
    for start in range(0, len(mine), LEAST):
        rows = slice(start, start + LEAST)
        p, dist, key, w = mine[rows], best.dist[rows], best.key[rows], best.w[rows]
        own = key == p[:, None]
        there = np.isfinite(dist) & (p != NO_KEY)[:, None] & (key != NO_KEY)
        out = {}
        if counted:
            w = np.where(there, w - own, 0)
            there &= w > 0
            before = np.cumsum(w, axis=1) - w
            there &= before < best.k - 1
            out["before"] = before[there]
        else:
            there &= ~own
        yield {"p": np.repeat(p, there.sum(axis=1)), "o": key[there], "dist": dist[there], "w": w[there]} | out


def stream_lists(points: DataFrame, by: list[str], k: int, blocks: tuple, vectors: Callable, counted: bool = False) -> DataFrame:
    """The ``k`` nearest other points of each of ``points`` (``by, p, w, x``; ``p`` a whole number): ``by, p, o, dist, w``.

    ``blocks`` is what ``numbered_blocks`` returns. With ``counted``, for numbers that occur once: as ``Neighborhood.edges``.
    """
    spark = points.sparkSession
    placed, scopes, first = blocks
    k += 1  # a point is one of its own list
    packed = materialize(placed.groupBy("blk").applyInArrow(_pack(vectors, k), PACKED))
    heads = sorted(packed.select("blk", "n", "box").collect())
    fields = [points.schema[c] for c in by]
    found = T.StructType([*fields, *[T.StructField(c, T.DoubleType() if c == "dist" else T.LongType()) for c in ["p", "o", "dist", "w", *["before"] * counted]]])
    if not heads:
        return spark.createDataFrame([], found)
    number, sizes = np.array([h["blk"] for h in heads]), np.array([h["n"] for h in heads], np.int64)
    lo, hi = np.array([np.frombuffer(h["box"]).reshape(2, -1) for h in heads]).transpose(1, 0, 2).copy()
    wide = lo.shape[1]
    place = np.full(int(number.max()) + 1, -1)
    place[number] = np.arange(len(number))
    scope = np.searchsorted(first, number, side="right") - 1
    last = np.searchsorted(scope, scope, side="right")
    begin = np.searchsorted(scope, scope, side="left")

    # Runs of blocks whose queries a task holds.
    cores = spark.sparkContext.defaultParallelism
    held = max(LEAST, HELD_BYTES // (24 * k + 12 * wide))
    rows = int(sizes.sum())
    run = min(held, max(LEAST, math.ceil(rows / (4 * cores))))
    part = ((np.cumsum(sizes) - sizes) // run).astype(np.int64)
    _, part = np.unique(part, return_inverse=True)
    boxes = spark.sparkContext.broadcast((lo, hi, place, begin, last, part))

    route_schema = "part int, scope int, visits binary"

    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lo, hi, place, begin, last, part = boxes.value
        for batch in batches:
            out: dict[tuple[int, int], np.ndarray] = {}
            for r in batch.to_pylist():
                at = place[r["blk"]]
                a, b = int(begin[at]), int(last[at])
                if b - a < 2:
                    continue
                own_lo, own_hi = (np.frombuffer(r[c]).reshape(-1, wide) for c in ("lo", "hi"))
                far = np.frombuffer(r["far"])
                near = np.zeros(b - a, bool)
                for start in range(a, b, 4096):
                    these = slice(start, min(b, start + 4096))
                    near[these.start - a : these.stop - a] = boxes_near(own_lo, own_hi, lo[these], hi[these], far).any(axis=0)
                key = (int(part[at]), a)
                out[key] = out[key] | near if key in out else near
            yield _visits(out)

    def either(table: pa.Table) -> pa.Table:
        out: dict[tuple[int, int], np.ndarray] = {}
        for r in table.to_pylist():
            key, bits = (r["part"], r["scope"]), np.frombuffer(r["visits"], np.uint8)
            out[key] = out[key] | bits if key in out else bits
        return pa.Table.from_batches([_visits({key: np.unpackbits(bits) for key, bits in out.items()})])

    routed = packed.select("blk", "lo", "hi", "far").mapInArrow(route, route_schema).groupBy("part", "scope").applyInArrow(either, route_schema).collect()
    parts = int(part.max()) + 1
    visited = [[] for _ in range(parts)]
    for r in routed:
        a = r["scope"]
        near = np.unpackbits(np.frombuffer(r["visits"], np.uint8))[: int(last[a]) - a]
        visited[r["part"]].append(np.flatnonzero(near) + a)
    visited = [np.concatenate(v) if v else np.zeros(0, np.int64) for v in visited]
    # Where nearly all blocks pass by all tasks, fewer tasks hold more each.
    copies = sum(int(sizes[v].sum()) for v in visited) / rows
    merge = max(1, min(held // run, parts // cores)) if copies > parts / 2 else 1
    part, parts = part // merge, -(-parts // merge)
    goes: list[list[int]] = [[] for _ in number]
    for i in range(parts):
        for at in np.unique(np.concatenate(visited[i * merge : (i + 1) * merge])):
            if part[at] != i:
                goes[at].append(i)
    ways = spark.sparkContext.broadcast((place, part, [np.array(g, np.int32) for g in goes]))
    known = spark.sparkContext.broadcast((place, begin, [scopes[s] for s in scope]))

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place, part, goes = ways.value
        for batch in batches:
            at = place[batch.column("blk").to_numpy()]
            to: dict[tuple[int, int], list[int]] = {}
            for i, a in enumerate(at):
                to.setdefault((0, int(part[a])), []).append(i)
                for other in goes[a]:
                    to.setdefault((1, int(other)), []).append(i)
            for (kind, whither), rows in to.items():
                some = batch.take(pa.array(rows))
                reach = some.column("reach") if kind == 0 else pa.array([b""] * len(rows), pa.binary())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(rows), whither, np.int32)), pa.array(np.full(len(rows), kind, np.int32)), *[some.column(c) for c in ("blk", "single", "p", "w", "x", "starts")], reach],
                    names=["part", "kind", "blk", "single", "p", "w", "x", "starts", "reach"],
                )

    arrow = to_arrow_schema(found)
    most = max(1, min(PASS, PASS_BYTES // (8 * wide)))

    def hold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        one_blas_thread()
        place, begin, names = known.value
        state = _Held(k, most)
        now = None

        def finished() -> Iterator[pa.RecordBatch]:
            for at, best in state.finish():
                for rows in _lists(best, counted):
                    named = {f.name: pa.array([v] * len(rows["p"]), f.type) for f, v in zip(list(arrow)[: len(by)], names[at])}
                    yield from pa.table(named | {c: pa.array(v) for c, v in rows.items()}).select(arrow.names).cast(arrow).to_batches()

        for batch in batches:
            for i in range(batch.num_rows):
                row = {c: batch.column(c)[i].as_py() for c in batch.schema.names}
                if row["part"] != now:
                    yield from finished()
                    now = row["part"]
                at = int(begin[place[row["blk"]]])
                if row["kind"] == 0:
                    state.query(at, _unpack(row, wide), np.frombuffer(row["reach"]))
                else:
                    state.base(at, _unpack(row, wide))
        yield from finished()

    sent = packed.select("blk", "single", "p", "w", "x", "starts", "reach").mapInArrow(send, SENT)
    return sent.repartitionById(parts, F.col("part")).sortWithinPartitions("part", "kind", "blk").mapInArrow(hold, found)


class _Held:
    """The queries of a task by scope, which come first, and the blocks that pass them."""

    def __init__(self, k: int, most: int) -> None:
        self.k, self.most = k, most
        self.queries: dict[int, list] = {}
        self.best: dict[int, Best] = {}
        self.waiting: dict[int, list] = {}

    def query(self, scope: int, block: tuple, reach: np.ndarray) -> None:
        self.queries.setdefault(scope, []).append((block, reach))

    def _begin(self, scope: int) -> Best | None:
        if scope in self.queries:
            blocks, reach = zip(*self.queries.pop(scope))
            best = Best(_together(list(blocks)), self.k, np.concatenate(reach))
            best.look(best.queries)
            self.best[scope] = best
        return self.best.get(scope)

    def base(self, scope: int, block: tuple) -> None:
        some = self.waiting.setdefault(scope, [])
        some.append(block)
        if sum(len(b[0]) for b in some) >= self.most:
            self._pass(scope)

    def _pass(self, scope: int) -> None:
        some, best = self.waiting.pop(scope, None), self._begin(scope)
        if some and best is not None:
            best.look(_together(some))

    def finish(self) -> Iterator[tuple[int, Best]]:
        for scope in [*dict.fromkeys([*self.best, *self.queries])]:
            self._pass(scope)
            yield scope, self.best.pop(scope)
        self.queries, self.waiting = {}, {}


def _visits(near: dict[tuple[int, int], np.ndarray]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array([key[0] for key in near], pa.int32()), pa.array([key[1] for key in near], pa.int32()), pa.array([np.packbits(v).tobytes() for v in near.values()], pa.binary())],
        names=["part", "scope", "visits"],
    )
