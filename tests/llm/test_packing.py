import itertools

import numpy as np
from pyspark.sql import functions as F

from waypost.llm import packing
from waypost.llm.common import text_of


def test_boundaries_are_optimal():
    rng = np.random.default_rng(2)
    for _ in range(30):
        n, k = int(rng.integers(1, 9)), int(rng.integers(1, 5))
        longest = np.sort(rng.choice(100, n, replace=False)) + 1
        rows = rng.integers(1, 20, n)
        tokens = longest * rows

        def cost(ends):
            start, total = 0, 0
            for e in ends:
                total += int((longest[e] * rows[start : e + 1]).sum() - tokens[start : e + 1].sum())
                start = e + 1
            return total

        best = min(cost([*cut, n - 1]) for m in range(min(k, n)) for cut in itertools.combinations(range(n - 1), m))
        ends = packing.best_boundaries(longest, rows, tokens, k)
        assert ends[-1] == n - 1 and len(ends) <= k and cost(ends) == best
    assert packing.best_boundaries(np.array([], int), np.array([], int), np.array([], int), 3) == []


def test_bins_keep_order(spark):
    lengths = [0, 1, 255, 256, 257, 259, 260, 511, 512, 1023, 1024, 10**6, 2**40, 2**40 + 2**34]
    df = spark.createDataFrame([(n,) for n in lengths], "n bigint")
    bins = [r.b for r in df.select("n", packing.bin_of(F.col("n")).alias("b")).orderBy("n").collect()]
    assert bins == sorted(bins) and len(set(bins[:4])) == 4 and bins[-1] < 4_200


def test_edges(edge_docs, no_docs):
    packed = packing.pack(edge_docs, F.octet_length(text_of("text")) + 1, buckets=3, token_budget=2_000).collect()
    assert len(packed) == edge_docs.count()
    seats = [(r.bucket, r.batch, r.slot) for r in packed]
    assert len(set(seats)) == len(seats)
    for r in packed:
        assert r.n_tokens <= r.boundary and r.padding == r.boundary - r.n_tokens and r.slot < r.capacity
        assert r.capacity * r.boundary <= 2_000 or r.capacity == 1
    for b in {r.bucket for r in packed}:
        own = sorted((r.batch, r.slot) for r in packed if r.bucket == b)
        room = next(r.capacity for r in packed if r.bucket == b)
        assert own == [(i // room, i % room) for i in range(len(own))]
    assert packing.pack(no_docs, F.lit(3)).count() == 0


def test_places_do_not_depend_on_shards(spark, monkeypatch):
    df = spark.range(500).select(F.col("id").alias("doc_id"), (F.col("id") % 37).alias("n"))
    one = {tuple(r) for r in packing.pack(df, F.col("n"), token_budget=100).collect()}
    monkeypatch.setattr(packing, "SHARD_ROWS", 2)
    assert one == {tuple(r) for r in packing.pack(df, F.col("n"), token_budget=100).collect()}
