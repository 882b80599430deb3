"""Merkle manifest of a table with octopus multiproofs.

Each row is a leaf. The leaves of a group (null first, then bytewise) stand in
key order; while several nodes remain, every FANOUT consecutive ones become
their hash, the last run may be shorter, even one. What remains is the group's
root; the groups' roots in order give the table's root in the same way. A
group of one leaf has that leaf as its root.

Leaves are range-partitioned by group and key, so that a group of any size is
spread over tasks. Interiors are hashed in blocks of FANOUT ** HEIGHT
consecutive nodes, HEIGHT levels at a time. Proofs come by partitions of at
most ROWS neighbouring leaves: a partition works out the least set of node
coordinates that its leaves' proofs need and that do not follow from the leaves
themselves (the octopus), all partitions fetch theirs in one join, and each
partition derives the interiors that its leaves share and expands the proof of
every leaf from them. No task holds more than a partition or a block.

Rows with a null key come first; rows that repeat a key are ordered by their
leaf. Nulls in any column are hashed apart from empty values. An empty table
gives no rows. Columns that are neither key, group nor leaf content are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Mapping, Sequence

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from waypost.session import materialize

#: Nodes in a run; levels hashed at a time; leaves in a partition.
FANOUT, HEIGHT, ROWS = 3, 8, 1 << 13
#: Tree number of the groups' roots.
TOP = -1

# ---- hashes ------------------------------------------------------------------------------------------


def sized(value: Column) -> Column:
    """A value after its length in UTF-8 bytes; ``-`` if null."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_hash(values: Iterable[Column]) -> Column:
    """Hex digest of a row's values."""
    return F.sha2(F.concat(*map(sized, values)), 256)


def digest(parts: Iterable[bytes]) -> bytes:
    """Digest of digests as hex text."""
    return hashlib.sha256(b"".join([p.hex().encode() for p in parts])).digest()


# ---- coordinates -------------------------------------------------------------------------------------


def sizes_of(n: int) -> list[int]:
    """Nodes of each level of a tree of n leaves, leaves first, root last."""
    out = [n]
    while out[-1] > 1:
        out.append(-(-out[-1] // FANOUT))
    return out


def run_of(node: int, size: int) -> range:
    """The places of a node's run on a level of ``size`` nodes."""
    first = node - node % FANOUT
    return range(first, min(first + FANOUT, size))


def missing(known: Iterable[int], n: int) -> list[tuple[int, int]]:
    """The least coordinates (level, place) that must be fetched to prove the leaves ``known`` of a tree of n."""
    out, have = [], set(known)
    for level, size in enumerate(sizes_of(n)[:-1]):
        runs = {k // FANOUT for k in have}
        out += [(level, i) for r in sorted(runs) for i in run_of(r * FANOUT, size) if i not in have]
        have = runs
    return out


def derive(known: Mapping[int, bytes], n: int, fetched: Mapping[tuple[int, int], bytes]) -> list[dict[int, bytes]]:
    """All nodes, level by level, that follow from the leaves ``known`` and the fetched ones; the last level holds the root."""
    levels = [dict(known)]
    for level, size in enumerate(sizes_of(n)[:-1]):
        now, above = levels[-1], {}
        for r in sorted({k // FANOUT for k in now}):
            for i in run_of(r * FANOUT, size):
                if i not in now:
                    now[i] = fetched[level, i]
            above[r] = digest([now[i] for i in run_of(r * FANOUT, size)])
        levels.append(above)
    return levels


class Proofs:
    """Proofs of leaves: from the leaf up, the hex digests on the left and on the right in each run."""

    def __init__(self, levels: list[dict[int, bytes]], n: int):
        self.levels, self.sizes, self.known = levels, sizes_of(n), {}

    def steps(self, node: int, level: int = 0) -> list[dict]:
        if level == len(self.levels) - 1:
            return []
        # The way above is the same for all leaves of a run.
        above = self.known.get((level + 1, node // FANOUT))
        if above is None:
            above = self.known[level + 1, node // FANOUT] = self.steps(node // FANOUT, level + 1)
        now, run = self.levels[level], run_of(node, self.sizes[level])
        left, right = ("".join(now[i].hex() for i in run if (i < node) == side and i != node) for side in (True, False))
        return [{"left": left, "right": right}, *above]


def folded(leaf: Column, proof: Column) -> Column:
    """The root that a leaf (hex) and a proof lead to."""
    return F.aggregate(proof, leaf, lambda now, step: F.sha2(F.concat(step["left"], now, step["right"]), 256))


# ---- places of the leaves ----------------------------------------------------------------------------


def placed(leaves: DataFrame) -> DataFrame:
    """Number sorted leaves: ``grp``, ``key``, ``leaf`` and others, with part, row, tree (place of the group), place (in it) and n (leaves of it).

    Written once, so that the range partitions are the same ever after.
    """
    schema = T.StructType([T.StructField("part", T.IntegerType()), T.StructField("row", T.LongType()), T.StructField("own", T.LongType()), *leaves.schema.fields])
    arrow = to_arrow_schema(schema)
    at = leaves.columns.index("grp")

    def number(batches):
        part, row, own, last = TaskContext.get().partitionId(), 0, -1, None
        for batch in batches:
            if not batch.num_rows:
                continue
            codes = batch.column(at).dictionary_encode(null_encoding="encode")
            index = codes.indices.to_numpy(zero_copy_only=False)
            new = np.concatenate([[own < 0 or codes.dictionary[int(index[0])].as_py() != last], index[1:] != index[:-1]])
            groups = own + np.cumsum(new)
            columns = [np.full(batch.num_rows, part, np.int32), np.arange(row, row + batch.num_rows), groups]
            yield pa.RecordBatch.from_arrays([*(pa.array(c, f.type) for c, f in zip(columns, arrow)), *batch.columns], schema=arrow)
            row, own, last = row + batch.num_rows, int(groups[-1]), codes.dictionary[int(index[-1])].as_py()

    order = ["grp", "key", "leaf"]
    rows = materialize(leaves.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(number, schema))
    # A group lies in one part or in parts that follow each other: one row per part finds its place.
    runs = rows.groupBy("part", "own").agg(F.first("grp").alias("grp"), F.count("*").alias("rows"), F.min("row").alias("from"))
    ends = runs.groupBy("part").agg(F.max("own").alias("last"), F.min_by("grp", "own").alias("low"), F.max_by("grp", "own").alias("high"))
    by_part = Window.orderBy("part")
    goes_on = F.lag("part").over(by_part).isNotNull() & F.lag("high").over(by_part).eqNullSafe(F.col("low"))
    ends = ends.withColumn("joined", goes_on.cast("bigint")).select("part", (F.sum(F.col("last") + 1 - F.col("joined")).over(by_part) - F.col("last") - 1).alias("base"))
    same = Window.partitionBy("tree")
    known = runs.join(ends, "part").withColumn("tree", F.col("base") + F.col("own"))
    known = known.select("part", "own", "tree", (F.sum("rows").over(same.orderBy("part")) - F.col("rows") - F.col("from")).alias("before"), F.sum("rows").over(same).alias("n"))
    return rows.join(known, ["part", "own"]).withColumn("place", F.col("row") + F.col("before")).drop("own", "before")


# ---- tree --------------------------------------------------------------------------------------------

NODES = "tree bigint, level int, place bigint, n bigint, hash binary"


def _blocks(rows: DataFrame) -> DataFrame:
    """The nodes up to HEIGHT levels above ``rows`` (NODES; all of one level of a tree)."""
    block = FANOUT**HEIGHT
    arrow = to_arrow_schema(T.StructType.fromDDL(NODES))
    dealt = rows.select("tree", "level", "place", "n", "hash").withColumn("block", F.expr(f"place div {block}"))
    dealt = dealt.repartition("tree", "block").sortWithinPartitions("tree", "place").drop("block")

    def above(tree: int, level: int, first: int, n: int, nodes: list[bytes]) -> list[tuple]:
        out = []
        for up in range(level + 1, min(level + HEIGHT, len(sizes_of(n)) - 1) + 1):
            nodes = [digest(nodes[i : i + FANOUT]) for i in range(0, len(nodes), FANOUT)]
            first //= FANOUT
            out += [(tree, up, first + i, n, node) for i, node in enumerate(nodes)]
        return out

    def run(batches):
        at, held = None, []
        for batch in batches:
            out = []
            for tree, level, place, n, node in zip(*(c.to_pylist() for c in batch.columns)):
                if at is None or at[0] != tree or at[2] // block != place // block:
                    out += above(*at, held) if at else []
                    at, held = (tree, level, place, n), []
                held.append(node)
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), arrow)], schema=arrow)
        out = above(*at, held) if at else []
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), arrow)], schema=arrow)

    return dealt.mapInArrow(run, NODES)


def tree_nodes(leaves: DataFrame) -> DataFrame:
    """All nodes (NODES) of the trees whose leaves are ``leaves`` (tree, place, n, hash), these included."""
    found = now = leaves.select("tree", F.lit(0).alias("level"), "place", "n", "hash")
    tallest = len(sizes_of(now.agg(F.max("n")).first()[0] or 1)) - 1
    for level in range(HEIGHT, tallest + HEIGHT, HEIGHT):
        made = materialize(_blocks(now.where(F.col("n") > FANOUT ** (level - HEIGHT))))
        found, now = found.unionByName(made), made.where(F.col("level") == level)
    return found


def roots(nodes: DataFrame) -> DataFrame:
    """tree, hash of the root of each tree."""
    return nodes.where((F.col("place") == 0) & (F.pow(F.lit(float(FANOUT)), "level") >= F.col("n"))).groupBy("tree").agg(F.min_by("hash", "level").alias("hash"))


# ---- operator ----------------------------------------------------------------------------------------

STEP = "array<struct<left string, right string>>".replace(" string", ": string")


def manifest(docs: DataFrame, columns: Sequence[str], key: str = "doc_id", group: str = "source", claims: Mapping[str, Column] | None = None) -> DataFrame:
    """key, leaf, subroot, root (hex) and proof of each row of ``docs``, and further ``claims`` about it.

    The leaf is the hash of ``columns``. ``proof`` has, from the leaf over the
    group's root to the table's, the digests on the left and right of each run;
    ``folded(leaf, proof)`` is the root. ``claims`` are expressions over the
    rows of ``docs``, such as the leaf of a copy that is to be checked.
    """
    claims = dict(claims or {})
    leaf = leaf_hash([F.col(f"`{c}`") for c in columns])
    claimed = F.struct(*(c.alias(name) for name, c in claims.items())) if claims else F.lit(None).cast("int")
    leaves = materialize(placed(docs.select(F.col(f"`{group}`").alias("grp"), F.col(f"`{key}`").alias("key"), F.unhex(leaf).alias("leaf"), claimed.alias("claims"))))
    low = tree_nodes(leaves.select("tree", "place", "n", F.col("leaf").alias("hash")))
    subroots = roots(low)
    groups = materialize(subroots.select(F.lit(TOP).cast("bigint").alias("tree"), F.col("tree").alias("place"), "hash")).withColumn("n", F.lit(None).cast("bigint"))
    n_groups = groups.count()
    top = tree_nodes(groups.withColumn("n", F.lit(n_groups).cast("bigint")))
    nodes = low.unionByName(top).select("tree", "level", "place", "hash")

    chunked = leaves.withColumn("chunk", F.expr(f"row div {ROWS}"))
    wanted_schema = "part int, chunk bigint, tree bigint, level int, place bigint"
    wanted_arrow = to_arrow_schema(T.StructType.fromDDL(wanted_schema))

    def of_chunk(trees: np.ndarray, places: np.ndarray, n: np.ndarray) -> list[tuple[int, int, int]]:
        """Coordinates (tree, level, place) that a partition lacks."""
        cuts = np.flatnonzero(np.concatenate([[True], trees[1:] != trees[:-1], [True]]))
        out = [(TOP, *c) for c in missing(trees[cuts[:-1]].tolist(), n_groups)]
        for a, b in zip(cuts[:-1], cuts[1:]):
            if b - a < n[a]:
                out += [(int(trees[a]), *c) for c in missing(places[a:b].tolist(), int(n[a]))]
        return out

    def lacking(table: pa.Table) -> pa.Table:
        part, chunk = table["part"][0].as_py(), table["chunk"][0].as_py()
        table = table.sort_by("row")
        found = of_chunk(*(table[c].to_numpy() for c in ("tree", "place", "n")))
        trees, levels, places = zip(*found) if found else ((), (), ())
        columns = [[part] * len(found), [chunk] * len(found), trees, levels, places]
        return pa.table([pa.array(c, f.type) for c, f in zip(columns, wanted_arrow)], schema=wanted_arrow)

    wanted = chunked.select("part", "chunk", "row", "tree", "place", "n").groupBy("part", "chunk").applyInArrow(lacking, wanted_schema)
    fetched = wanted.join(nodes, ["tree", "level", "place"])

    out_fields = f"`{key}` {docs.schema[key].dataType.simpleString()}, leaf string, subroot string, root string, proof {STEP}, claims {leaves.schema['claims'].dataType.simpleString()}"
    out_arrow = to_arrow_schema(T.StructType.fromDDL(out_fields))

    def expand(rows: pa.Table, others: pa.Table) -> pa.Table:
        rows = rows.sort_by("row")
        trees, places, n = (rows[c].to_numpy() for c in ("tree", "place", "n"))
        leaf = rows["leaf"].to_pylist()
        have: dict[int, dict[tuple[int, int], bytes]] = {}
        for tree, level, place, node in zip(*(others[c].to_pylist() for c in ("tree", "level", "place", "hash"))):
            have.setdefault(tree, {})[level, place] = node
        cuts = np.flatnonzero(np.concatenate([[True], trees[1:] != trees[:-1], [True]])).tolist()
        proofs, tops = [], {}
        for a, b in zip(cuts[:-1], cuts[1:]):
            levels = derive(dict(zip(places[a:b].tolist(), leaf[a:b])), int(n[a]), have.get(int(trees[a]), {}))
            tops[int(trees[a])] = levels[-1][0]
            proofs.append(Proofs(levels, int(n[a])))
        above = derive(tops, n_groups, have.get(TOP, {}))
        root, upper = above[-1][0].hex(), Proofs(above, n_groups)
        steps, subroot = [], []
        for a, b, own in zip(cuts[:-1], cuts[1:], proofs):
            rest = upper.steps(int(trees[a]))
            steps += [own.steps(p) + rest for p in places[a:b].tolist()]
            subroot += [tops[int(trees[a])].hex()] * (b - a)
        columns = [rows["key"], [x.hex() for x in leaf], subroot, [root] * len(leaf), steps, rows["claims"]]
        return pa.table([c if isinstance(c, pa.ChunkedArray) else pa.array(c, f.type) for c, f in zip(columns, out_arrow)], schema=out_arrow)

    left = chunked.select("part", "chunk", "row", "key", "tree", "place", "n", "leaf", "claims").groupBy("part", "chunk")
    out = left.cogroup(fetched.groupBy("part", "chunk")).applyInArrow(expand, out_fields)
    return out.select(f"`{key}`", "leaf", "subroot", "root", "proof", *(F.col(f"claims.`{name}`") for name in claims))
