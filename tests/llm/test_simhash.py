import itertools
import random

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from waypost.llm import components, simhash


def plain(text, n=3):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    shingles = [b" ".join(words[i : i + n]) for i in range(len(words) - n + 1)] or [b" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << i for i in range(64) if 2 * sum(h >> i & 1 for h in hashes) > len(hashes))


def grouped(fps, radius=3):
    parent = list(range(len(fps)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, j in itertools.combinations(range(len(fps)), 2):
        if (fps[i] ^ fps[j]).bit_count() <= radius:
            a, b = find(i), find(j)
            parent[max(a, b)] = min(a, b)
    return [find(i) for i in range(len(fps))]


@pytest.mark.parametrize("radius", [1, 2, 3, 4])
def test_masks_cover(radius):
    masks = simhash.covering_masks(radius)
    assert len(masks) == 2 ** (radius + 1) - 1 and all(20 <= m.bit_count() <= 44 for m in masks)
    rng = random.Random(radius)
    for _ in range(3_000):
        flips = sum(1 << b for b in rng.sample(range(64), rng.randint(1, radius)))
        assert any(not m & flips for m in masks)


def test_fingerprint(edge_rows, monkeypatch):
    for _, text, *_ in edge_rows:
        assert simhash.fingerprint(text or "") == plain(text)
    monkeypatch.setattr(simhash, "PIECE", 50)
    for _, text, *_ in edge_rows:
        if len(text or "") < 2_000:
            assert simhash.fingerprint(text or "") == plain(text)


@pytest.mark.parametrize(("tile", "common"), [(4, 50), (8_192, 50), (2, 3)])
def test_links_find_every_group(spark, monkeypatch, tile, common):
    """Also where buckets are too large for a task, and where a sample shows that beforehand."""
    monkeypatch.setattr(simhash, "TILE", tile)
    monkeypatch.setattr(simhash, "COMMON", common)
    rng = random.Random(7)
    fps = [rng.getrandbits(64) for _ in range(60)]
    for base in fps[:25]:
        at = base
        for _ in range(rng.randint(0, 12)):
            at ^= sum(1 << b for b in rng.sample([63, 62, *range(62)], rng.randint(1, 4)))
            fps.append(at)
    # A third of all in a few buckets, far from each other in the rest of their bits.
    fps += [fps[0] & simhash.covering_masks(3)[0] | (rng.getrandbits(64) & ~simhash.covering_masks(3)[0]) for _ in range(60)]
    fps = list(dict.fromkeys(fps + [0, 1, 1 << 63, (1 << 64) - 1]))
    df = spark.createDataFrame([(simhash.signed(f),) for f in fps], "fp bigint").repartition(5)
    edges = simhash.links(df)
    for e in edges.collect():
        assert ((e.u ^ e.v) & (2**64 - 1)).bit_count() <= 3
    node = {r.node: r.component for r in components.components(edges).collect()}
    mine = [node.get(simhash.signed(f), simhash.signed(f)) for f in fps]
    want = grouped(fps)
    assert len(set(zip(mine, want))) == len(set(mine)) == len(set(want))


def test_groups_of_any_size_are_screened_alike():
    rng = np.random.default_rng(6)
    sizes = [1, 2, 3, 16, 17, 40, 2]
    fps = rng.integers(0, 1 << 63, sum(sizes)).astype(np.uint64)
    for i in range(1, len(fps), 3):
        fps[i] = fps[i - 1] ^ np.uint64(5)
    cuts = np.concatenate([[0], np.cumsum(sizes)])
    found = {frozenset(p) for p in simhash.forests(fps, cuts, 4)}
    want = {frozenset((a + i, a + j)) for a, b in zip(cuts[:-1], cuts[1:]) for i, j in simhash.forest(fps[a:b], 4)}
    assert found == want and found


def test_components_of_long_chains(spark):
    n = 300
    order = list(range(n))
    random.Random(3).shuffle(order)
    edges = [(order[i], order[i + 1]) for i in range(n - 1)] + [(1_000, 1_001), (1_001, 1_000), (5_000, 5_000)]
    got = {r.node: r.component for r in components.components(spark.createDataFrame(edges, "u bigint, v bigint")).collect()}
    assert got == {**{i: 0 for i in range(n)}, 1_000: 1_000, 1_001: 1_000}


def test_no_edges(spark):
    assert components.components(spark.createDataFrame([], "u bigint, v bigint")).count() == 0


def test_edges(edge_docs, no_docs, edge_rows):
    got = simhash.near_duplicates(edge_docs).collect()
    fps = [plain(t) for _, t, *_ in edge_rows]
    roots = grouped(fps)
    least = {r: min((d for (d, *_), x in zip(edge_rows, roots) if x == r and d is not None), default=None) for r in roots}
    want = [(d, f"{f:016x}", least[r]) for (d, *_), f, r in zip(edge_rows, fps, roots)]
    key = lambda row: tuple((v is None, v) for v in row)
    assert sorted((tuple(r) for r in got), key=key) == sorted(want, key=key)
    kept = simhash.deduplicate(edge_docs)
    assert kept.columns == edge_docs.columns
    rows = kept.collect()
    least = {r: min((d for (d, *_), x in zip(edge_rows, roots) if x == r and d is not None), default=None) for r in roots}
    assert len(rows) == len(set(roots)) and {r.doc_id for r in rows} == {least[r] for r in roots}
    assert simhash.near_duplicates(no_docs).count() == 0 and simhash.deduplicate(no_docs).count() == 0


def test_query_matches_brute_force(spark, sf):
    from waypost.llm.queries import covering_simhash

    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").orderBy("doc_id").collect()
    fps = [plain(d.text) for d in docs]
    want = {(d.doc_id, f"{f:016x}", docs[r].doc_id) for d, f, r in zip(docs, fps, grouped(fps))}
    assert {tuple(r) for r in covering_simhash(spark, sf).collect()} == want


def test_spark_hash_is_the_same(spark):
    text = "ab cd ef"
    assert spark.range(1).select(F.xxhash64(F.lit(text))).first()[0] == simhash.signed(xxhash.xxh64_intdigest(text.encode(), 42))
    assert np.bitwise_count(np.uint64(1 << 63 | 1)) == 2


def test_second_tables_cover(spark):
    """What a bucket's fingerprints share is fixed; the second masks cover the other places, so that a bucket is small."""
    masks = simhash.covering_masks(3)
    rng = random.Random(11)
    for m in masks:
        free = [i for i in range(64) if not m >> i & 1]
        second = simhash.covering_masks(3, free)
        assert all(not own & m and len(free) - own.bit_count() <= 16 for own in second)
        for _ in range(500):
            flips = sum(1 << b for b in rng.sample(free, rng.randint(1, 3)))
            assert any(not own & flips for own in second)


def test_one_text_in_a_third_of_the_rows(spark):
    """Copies of one text and a chain of near texts; of rows with one key and text one stays, whatever their order."""
    same = "one two three four five six seven eight nine ten"
    rows = [(i, same, str(i % 4)) for i in range(300)] + [(0, same, "9")] * 2 + [(1_000 + i, f"text {i} of its own kind and {i * i} words", "0") for i in range(300)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, source string")
    kept = [sorted(map(tuple, simhash.deduplicate(docs.repartition(n)).collect())) for n in (2, 7)]
    roots = grouped([plain(t) for _, t, _ in rows])
    assert kept[0] == kept[1] and [k[0] for k in kept[0]] == sorted({rows[r][0] for r in set(roots)})
