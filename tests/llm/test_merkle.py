import hashlib
import random

import pytest
from pyspark.sql import functions as F

from waypost.llm import merkle

COLUMNS = ["doc_id", "source", "lang", "n_chars", "text"]


def h(*parts):
    return hashlib.sha256("".join(parts).encode("utf-8", "surrogatepass")).hexdigest()


def leaf_of(row):
    return h(*("-" if v is None else f"{len(str(v).encode())}:{v}" for v in row))


def tree_of(nodes):
    levels = [nodes]
    while len(nodes) > 1:
        nodes = [h(*nodes[i : i + 3]) for i in range(0, len(nodes), 3)]
        levels.append(nodes)
    return levels


def siblings(levels, i):
    out = []
    for level in levels[:-1]:
        first = i // 3 * 3
        out.append(("".join(level[first:i]), "".join(level[i + 1 : first + 3])))
        i //= 3
    return out


def brute(rows):
    """(key, leaf, subroot, root, proof) of rows (doc_id, source, lang, n_chars, text)."""
    groups = {}
    for row in rows:
        groups.setdefault(row[1], []).append((row[0] is not None, row[0] or 0, leaf_of(row), row))
    names = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    trees = [tree_of([m[2] for m in sorted(groups[s], key=lambda m: m[:3])]) for s in names]
    top = tree_of([t[-1][0] for t in trees])
    out = []
    for g, s in enumerate(names):
        for i, (_, _, leaf, row) in enumerate(sorted(groups[s], key=lambda m: m[:3])):
            out.append((row[0], leaf, trees[g][-1][0], top[-1][0], siblings(trees[g], i) + siblings(top, g)))
    return out


def plain(df):
    return [(r.doc_id, r.leaf, r.subroot, r.root, [(s.left, s.right) for s in r.proof]) for r in df.collect()]


def order(rows):
    return sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2], r[4]))


def table_of(sizes, seed=1):
    rng = random.Random(seed)
    rows, names = [], [None, "", "a", "B", "é", "\U0001f600", "zz", "z", "b", "-"]
    keys = rng.sample(range(100_000), sum(sizes))
    for g, n in enumerate(sizes):
        rows += [(keys.pop(), names[g], rng.choice(["en", None]), rng.choice([1, None]), rng.choice(["x\ny", "", None, "日\n"])) for _ in range(n)]
    rng.shuffle(rows)
    return rows


SCHEMA = "doc_id bigint, source string, lang string, n_chars bigint, text string"


@pytest.mark.parametrize("sizes", [[1], [2], [1, 1], [3, 1, 4], [28, 1, 2, 9, 10, 27, 3, 4, 82, 5], [200]])
@pytest.mark.parametrize(("rows_in_part", "height"), [(5, 1), (7, 2), (1 << 13, 8)])
def test_matches_brute_force(spark, monkeypatch, sizes, rows_in_part, height):
    """Whatever the partitions and blocks, also where one group holds nearly all rows."""
    monkeypatch.setattr(merkle, "ROWS", rows_in_part)
    monkeypatch.setattr(merkle, "HEIGHT", height)
    rows = table_of(sizes)
    got = plain(merkle.manifest(spark.createDataFrame(rows, SCHEMA).repartition(4), COLUMNS))
    assert order(got) == order(brute(rows))


def test_coordinates_are_the_least():
    rng = random.Random(5)
    for _ in range(200):
        n = rng.randint(1, 90)
        levels = tree_of([h(str(i)) for i in range(n)])
        known = rng.sample(range(n), rng.randint(1, min(n, 12)))
        want = merkle.missing(known, n)
        assert len(set(want)) == len(want)
        nodes = {c: bytes.fromhex(levels[c[0]][c[1]]) for c in want}
        mine = {i: bytes.fromhex(levels[0][i]) for i in known}
        found = merkle.derive(mine, n, nodes)
        assert found[-1] == {0: bytes.fromhex(levels[-1][0])}
        proofs = merkle.Proofs(found, n)
        for i in known:
            assert [(s["left"], s["right"]) for s in proofs.steps(i)] == siblings(levels, i)
        for level, place in want:  # no known leaf lies below a fetched node, and without it nothing is proven
            assert not any(i // 3**level == place for i in known)
            with pytest.raises(KeyError):
                merkle.derive(mine, n, {c: v for c, v in nodes.items() if c != (level, place)})


def test_tampering_is_found(spark):
    rows = table_of([28, 1, 2, 9, 10])
    docs = spark.createDataFrame(rows, SCHEMA)
    other = merkle.leaf_hash([F.replace("text", F.lit("\n"), F.lit("")) if c == "text" else F.col(c) for c in COLUMNS])
    proven = merkle.manifest(docs, COLUMNS, claims={"claimed": other})
    got = proven.select("doc_id", "leaf", "claimed", "root", merkle.folded(F.col("claimed"), F.col("proof")).alias("there"), merkle.folded(F.col("leaf"), F.col("proof")).alias("own")).collect()
    text = {r[0]: r[4] for r in rows}
    for r in got:
        assert r.own == r.root
        assert (r.there == r.root) == ("\n" not in (text[r.doc_id] or "")) == (r.leaf == r.claimed)


def test_edges(spark, edge_docs, edge_rows, no_docs):
    rows = [(d, s, lang, n, t) for d, t, lang, s, n, *_ in edge_rows]
    assert order(plain(merkle.manifest(edge_docs, COLUMNS))) == order(brute(rows))
    assert merkle.manifest(no_docs, COLUMNS).collect() == []
