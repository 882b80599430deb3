"""Nearest neighbours through stable projections and a kd-tree.

Vectors are projected to M Gaussian directions. A squared projected distance
over the squared distance is chi-square with M degrees of freedom, so a
neighbour nearer than the k-th found so far is still to come, past a projected
distance r, with probability at most 1 - CDF(r^2 / d_k^2). Candidates are
visited by growing projected distance and verified by their exact distance,
until that CDF reaches CONFIDENCE.

The projections are indexed by a kd-tree, grown on a bounded sample of them;
its leaves split all rows, and each leaf is one bounded group (a leaf with more
rows than twice what was aimed at is dealt over several tasks). A query first searches its
own leaf. The k-th distance found there bounds the projected radius that the
test can ever need, and the query goes only to the leaves that this ball
touches. Each visit runs the test with the radius known so far and returns at
most k rows, which are merged.

Vectors that are null, zero, or hold a null or a number that is not finite take
no part, neither as rows nor as queries. Rows that repeat stay, ties go to the
smaller key, a query is not its own neighbour by key. With fewer than k
candidates all are returned. An empty table gives an empty result. Vectors
must have the same number of components; the commonest number counts, and others
take no part. Of rows that repeat a query's key, the least vector asks.
"""

from __future__ import annotations

import math
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from waypost.session import materialize

#: Projected dimensions (even), chi-square level at which a query stops, neighbours.
M, CONFIDENCE, K = 8, 0.98, 10
#: Rows of the sample that places the cuts, rows aimed at in a leaf, queries that meet a leaf in one task.
SAMPLE_ROWS, LEAF_ROWS, CROWD = 20_000, 4_096, 16_384
#: Least rows aimed at in a leaf, and leaves aimed at for each core.
SMALL_LEAF, LEAVES_PER_CORE = 128, 4
SEED = 17


def chi_square_cdf(x: np.ndarray, m: int = M) -> np.ndarray:
    """For an even number of degrees of freedom, where it is a finite sum."""
    half, term, total = x / 2, np.ones_like(x), np.ones_like(x)
    for j in range(1, m // 2):
        term = term * half / j
        total = total + term
    return 1 - np.exp(-half) * total


def chi_square_quantile(p: float, m: int = M) -> float:
    low, high = 0.0, 1e4
    for _ in range(200):
        mid = (low + high) / 2
        low, high = (mid, high) if chi_square_cdf(np.array(mid), m) < p else (low, mid)
    return high


class Tree(NamedTuple):
    """A kd-tree over projections: per inner node its dimension and cut, and the leaves' boxes."""

    dims: list[int]
    cuts: list[float]
    kids: list[tuple[int, int]]
    low: np.ndarray
    high: np.ndarray


def grow(points: np.ndarray, leaves: int) -> Tree:
    """Median cuts of the widest dimension until there are about ``leaves`` leaves; boxes cover the whole space.

    Inner nodes are numbered from 0, leaf i is the child -1 - i.
    """
    dims, cuts, kids, low, high = [], [], [], [], []
    width = points.shape[1] if points.ndim == 2 and points.shape[1] else M

    def node(part: np.ndarray, many: int, lo: np.ndarray, hi: np.ndarray) -> int:
        spread = part.max(0) - part.min(0) if len(part) else np.zeros(width)
        dim = int(np.argmax(spread))
        cut = float(np.median(part[:, dim])) if many > 1 and len(part) > 1 else 0.0
        right = part[:, dim] > cut if many > 1 and len(part) > 1 else None
        if right is None or not right.any() or right.all():
            low.append(lo)
            high.append(hi)
            return -len(low)
        me = len(dims)
        dims.append(dim)
        cuts.append(cut)
        kids.append((0, 0))
        edge = hi.copy(), lo.copy()
        edge[0][dim] = edge[1][dim] = cut
        kids[me] = node(part[~right], many // 2, lo, edge[0]), node(part[right], many - many // 2, edge[1], hi)
        return me

    node(points, leaves, np.full(width, -np.inf), np.full(width, np.inf))
    return Tree(dims, cuts, kids, np.array(low), np.array(high))


def leaf_of(tree: Tree, points: np.ndarray) -> np.ndarray:
    """Leaf number of each point."""
    at = np.zeros(len(points), np.int64) if tree.dims else np.full(len(points), -1)
    dims, cuts, kids = np.array(tree.dims, np.int64), np.array(tree.cuts), np.array(tree.kids).reshape(-1, 2)
    while len(inner := np.flatnonzero(at >= 0)):
        node = at[inner]
        at[inner] = kids[node, (points[inner, dims[node]] > cuts[node]).astype(np.int64)]
    return -1 - at


def leaves_within(tree: Tree, point: np.ndarray, reach: float) -> np.ndarray:
    """Leaves whose box is no farther than ``reach``, found by walking the tree."""
    out, todo = [], [(0 if tree.dims else -1, np.zeros(len(point)))]
    while todo:
        at, gap = todo.pop()
        if at < 0:
            out.append(-1 - at)
            continue
        dim, cut = tree.dims[at], tree.cuts[at]
        over = point[dim] - cut
        for side, kid in enumerate(tree.kids[at]):
            far = gap
            if (over > 0) != bool(side):
                far = gap.copy()
                far[dim] = max(far[dim], abs(over))
            if float((far**2).sum()) <= reach * reach:
                todo.append((kid, far))
    return np.array(sorted(out), np.int64)


def search(query: np.ndarray, query_proj: np.ndarray, query_key: int, keys: np.ndarray, vecs: np.ndarray, projs: np.ndarray, k: int, level: float, bound: float) -> tuple[np.ndarray, np.ndarray]:
    """Keys and distances of the k nearest verified rows of one group, by the stopping test.

    ``bound`` is a distance within which k rows are known already (infinite if not).
    """
    gap = ((projs - query_proj) ** 2).sum(1)
    order = np.argsort(gap, kind="stable")
    best_key, best = np.empty(0, np.int64), np.empty(0)
    at, step = 0, max(32, 4 * k)
    while at < len(order):
        kth = min(bound, best[k - 1] if len(best) >= k else math.inf)
        if kth < math.inf and gap[order[at]] > level * kth * kth:
            break
        part = order[at : at + step]
        part = part[keys[part] != query_key]
        dist = np.sqrt(((vecs[part] - query) ** 2).sum(1))
        best_key, best = np.concatenate([best_key, keys[part]]), np.concatenate([best, dist])
        keep = np.lexsort((best_key, best))[:k]
        best_key, best = best_key[keep], best[keep]
        at, step = at + step, step * 2
    return best_key, best


def usable(vector: Column, dims: int) -> Column:
    """Vectors of the right length, all components finite, not all zero."""
    good = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(math.inf)))
    return vector.isNotNull() & (F.size(vector) == dims) & good & F.exists(vector, lambda x: x != 0)


def nearest(rows: DataFrame, is_query: Column, key: str = "vec_id", vector: str = "embedding", k: int = K, confidence: float = CONFIDENCE, seed: int = SEED, leaf_rows: int = LEAF_ROWS) -> DataFrame:
    """query_id, rank, vec_id, score (Euclidean distance) of each query's k nearest rows found."""
    whole = rows.select(F.col(key).cast("bigint").alias("id"), F.col(vector).cast("array<double>").alias("v"), F.coalesce(is_query, F.lit(False)).alias("q"))
    lengths = whole.where(F.size("v") > 0).groupBy(F.size("v").alias("d")).count().orderBy(F.desc("count"), "d").first()
    dims = lengths.d if lengths else 1
    axes = np.random.default_rng(seed).normal(size=(dims, M))

    def project(batches):
        for frame in batches:
            vecs = np.array(frame["v"].tolist(), float).reshape(-1, dims)
            frame["p"] = list(vecs @ axes)
            yield frame

    flat = whole.where(usable(F.col("v"), dims) & F.col("id").isNotNull())
    data = materialize(flat.mapInPandas(project, "id bigint, v array<double>, q boolean, p array<double>"))
    n = data.count()
    # Few rows are cut finer, so that every core has leaves.
    leaf_rows = min(leaf_rows, max(SMALL_LEAF, n // (LEAVES_PER_CORE * data.sparkSession.sparkContext.defaultParallelism)))
    sample = data.select("p").sample(min(1.0, SAMPLE_ROWS / max(1, n)), seed=seed).limit(2 * SAMPLE_ROWS) if n > SAMPLE_ROWS else data.select("p")
    tree = grow(np.array([r.p for r in sample.collect()], float).reshape(-1, M), max(1, -(-n // leaf_rows)))
    level = chi_square_quantile(confidence)

    def place(batches):
        for frame in batches:
            frame["leaf"] = leaf_of(tree, np.array(frame["p"].tolist(), float).reshape(-1, M))
            yield frame

    placed = data.mapInPandas(place, "id bigint, v array<double>, q boolean, p array<double>, leaf bigint")
    # A leaf that the sample has underrated is dealt in shares; a query goes to every share of a leaf.
    sizes = data.mapInPandas(lambda batches: (f[["leaf"]] for f in place(batches)), "leaf bigint").groupBy("leaf").count()
    shares = sizes.select("leaf", F.ceil(F.col("count") / (2 * leaf_rows)).cast("bigint").alias("shares"))
    points = placed.join(shares, "leaf").withColumn("share", F.pmod(F.xxhash64("id"), F.col("shares"))).select("leaf", "share", "id", "v", "p")
    found_schema = "query_id bigint, vec_id bigint, score double"

    def visit(queries: pd.DataFrame, part: pd.DataFrame) -> pd.DataFrame:
        out: tuple[list, list, list] = ([], [], [])
        if len(queries) and len(part):
            keys, vecs, projs = part["id"].to_numpy(), np.array(part["v"].tolist(), float), np.array(part["p"].tolist(), float)
            for q, v, p, bound in zip(queries["id"], queries["v"], queries["p"], queries["bound"]):
                near, score = search(np.array(v, float), np.array(p, float), q, keys, vecs, projs, k, level, bound)
                out[0].extend([q] * len(near))
                out[1].extend(near.tolist())
                out[2].extend(score.tolist())
        return pd.DataFrame({"query_id": out[0], "vec_id": out[1], "score": out[2]}).astype({"query_id": "int64", "vec_id": "int64", "score": "float64"})

    def visits(to: DataFrame) -> DataFrame:
        """Search the leaves in ``to`` (leaf, id, v, p, bound). A leaf that many queries visit meets them in crowds."""
        crowds = to.groupBy("leaf").agg(F.ceil(F.count("*") / CROWD).cast("bigint").alias("crowds"))
        every = lambda n: F.explode(F.sequence(F.lit(0).cast("bigint"), F.col(n) - 1))
        asked = to.join(shares.join(crowds, "leaf"), "leaf").withColumn("crowd", F.pmod(F.xxhash64("id"), F.col("crowds"))).withColumn("share", every("shares"))
        met = points.join(crowds, "leaf").withColumn("crowd", every("crowds"))
        columns = ["leaf", "share", "crowd"]
        own = met.select(*(F.col(c).alias(c) for c in [*columns, "id", "v", "p"]))  # both sides come from one table
        return asked.select(*columns, "id", "v", "p", "bound").groupBy(*columns).cogroup(own.groupBy(*columns)).applyInPandas(visit, found_schema)

    def best(found: DataFrame) -> DataFrame:
        return found.groupBy("query_id").agg(F.slice(F.array_sort(F.collect_list(F.struct("score", "vec_id"))), 1, k).alias("near"))

    asked = placed.where("q").groupBy("id").agg(F.min(F.struct("v", "p", "leaf")).alias("one")).select("one.leaf", "id", "one.v", "one.p")
    first = materialize(best(visits(asked.withColumn("bound", F.lit(math.inf)))))
    kth = first.select(F.col("query_id").alias("id"), F.when(F.size("near") >= k, F.get("near", F.lit(k - 1))["score"]).alias("kth"))

    def reach(batches):
        for frame in batches:
            to = [leaves_within(tree, np.array(p, float), math.sqrt(level) * b * (1 + 1e-9)) for p, b in zip(frame["p"], frame["bound"])]
            frame["leaf"] = [[int(x) for x in leaves if x != own] for leaves, own in zip(to, frame["leaf"])]
            yield frame.rename(columns={"leaf": "leaves"})[["leaves", "id", "v", "p", "bound"]]

    bounded = asked.join(kth, "id", "left").select("leaf", "id", "v", "p", F.coalesce("kth", F.lit(math.inf)).alias("bound"))
    onward = bounded.mapInPandas(reach, "leaves array<bigint>, id bigint, v array<double>, p array<double>, bound double")
    second = visits(onward.select(F.explode("leaves").alias("leaf"), "id", "v", "p", "bound"))
    every = first.select("query_id", F.explode("near").alias("n")).select("query_id", "n.vec_id", "n.score").unionByName(second)
    ranked = best(every).select("query_id", F.posexplode("near").alias("r", "n"))
    return ranked.select("query_id", (F.col("r") + 1).cast("int").alias("rank"), F.col("n.vec_id").alias("vec_id"), F.col("n.score").alias("score"))
