import math
import random
import re
from collections import Counter

import numpy as np
import pytest
from conftest import prose

from waypost.llm import lexical

TERM = re.compile("[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+")


def terms(text):
    return TERM.findall("".join(c.lower() if c.isascii() else c for c in text or ""))


def brute(docs, items, most=10):
    """(item, rank, key, score) by whole numbers alone."""
    counts = [Counter(terms(t)) for _, t in docs]
    n_docs, n_terms = sum(bool(c) for c in counts), sum(c.total() for c in counts)
    df = Counter(t for c in counts for t in c)
    wanted = {}
    for i, t in items:
        wanted.setdefault(i, set()).update(terms(t))
    out = []
    for item, own in wanted.items():
        rows = []
        for (key, _), c in zip(docs, counts):
            m = 100 - 90 + 90 * c.total() * n_docs // max(n_terms, 1)
            score = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (1_000_000_000 * c[t] // (1000 * c[t] + 8 * m)) for t in own if c[t])
            if score > 0:
                rows.append((-score, key is None, key or 0))
        out += [(item, r, None if none else key, -score) for r, (score, none, key) in enumerate(sorted(rows)[:most], 1)]
    return out


def order(rows):
    return sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1]))


def found(df):
    return order([tuple(r) for r in df.collect()])


@pytest.mark.parametrize(("docs_in_tile", "items", "width", "block"), [(7, 3, 5, 200), (16, 256, 4096, 4 << 20), (1024, 2, 1, 1000)])
def test_matches_brute_force(spark, monkeypatch, docs_in_tile, items, width, block):
    """Whatever the tiles: many copies tie, across tiles, tasks and the last place."""
    for name, value in (("DOCS", docs_in_tile), ("ITEMS", items), ("TERMS", width), ("SALTS", 3)):
        monkeypatch.setattr(lexical, name, value)
    rng = random.Random(docs_in_tile)
    texts = [prose(rng, rng.randint(1, 60)) for _ in range(60)]
    docs = [(i, t) for i, t in enumerate(texts + texts[:20] * 3 + [texts[0]] * 60)]
    rng.shuffle(docs)
    asked = [(i, prose(rng, 8) + " " + texts[i % 5]) for i in range(12)] + [(3, "etaoin one MORE"), (50, ""), (51, None), (52, "?!"), (53, "unknownterm")]
    got = lexical.search(spark.createDataFrame(docs, "doc_id bigint, text string").repartition(6), spark.createDataFrame(asked, "item_id bigint, text string"), block_bytes=block)
    assert found(got) == order(brute(docs, asked))


def test_sums_are_exact():
    """Vocabulary tiles keep every partial sum below 2^53, however large the weights."""
    rng = np.random.default_rng(3)
    for widest in (30, 30_000, 10**9):
        weights = rng.integers(0, widest + 1, 500)
        weights[0] = widest
        items = [np.unique(rng.integers(0, 500, 300)).tolist() for _ in range(5)]
        tile = lexical.ItemTile(items, weights)
        assert int(weights.max()) * lexical.IMPACT * tile.width < 1 << 53
        dense = rng.integers(0, lexical.IMPACT + 1, (8, 500))
        doc, term = np.nonzero(dense)
        got = tile.scores(doc, term, dense[doc, term], 8)
        want = [[sum(int(weights[t]) * int(row[t]) for t in own) for row in dense] for own in items]
        assert got.tolist() == want


def test_terms():
    text = "A-b É_é 12x\x00Ünï日本ß ~K\x7fz"
    assert [t.decode() for ts in lexical.terms_of(text) for t in ts] == terms(text)
    long = prose(random.Random(1), 3000)
    lexical_piece, lexical.PIECE = lexical.PIECE, 100
    try:
        assert [t.decode() for ts in lexical.terms_of(long) for t in ts] == terms(long)
    finally:
        lexical.PIECE = lexical_piece


def test_edges(spark, edge_docs, edge_rows, no_docs):
    docs = [(d, t) for d, t, *_ in edge_rows]
    asked = [(1, docs[4][1]), (2, "naïve end LEAD"), (None, "one two"), (4, None), (2, "lead"), (9, docs[3][1])]
    items = spark.createDataFrame([(*a, "x", "y") for a in asked], "item_id bigint, text string, key string, score string")
    assert found(lexical.search(edge_docs, items)) == order(brute(docs, asked))
    assert lexical.search(no_docs, items).collect() == []
    assert lexical.search(edge_docs, items.limit(0)).collect() == []
