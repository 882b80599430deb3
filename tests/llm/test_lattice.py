import hashlib
import math
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import sentencepiece

from waypost.llm import lattice

MODEL = public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def pieces():
    return lattice.Pieces(MODEL)


def brute(pieces, text):
    """Every segmentation with its log-probability."""
    spelled = "".join(map(pieces.spell, lattice.words_of(text)))
    number = {t: i for i, t in pieces.text.items()}
    logp = {int(i): float(p) for _, ids, ps in pieces.tables for i, p in zip(ids, ps) if i >= 0}
    out = []

    def go(at, ids, total):
        if at == len(spelled):
            out.append((tuple(ids), total))
        for end in range(at + 1, min(len(spelled), at + 16) + 1):
            i = number.get(spelled[at:end])
            if i is not None:
                go(end, [*ids, i], total + logp[i])

    go(0, [], 0.0)
    z = math.log(sum(math.exp(p) for _, p in out))
    return {i: p - z for i, p in out}


@pytest.mark.parametrize("text", ["ab", "the cat", "é\nx", "a  b ", "日本語", "!!", "  ", "𝕏"])
def test_samples_follow_the_distribution(pieces, text):
    want, n = brute(pieces, text), 6_000
    got = lattice.sample_texts(pieces, [text] * n, list(range(n)), 3)
    first = Counter(tuple(s[0].ids.tolist()) for s in got)
    assert sum(abs(first[i] / n - math.exp(p)) for i, p in want.items()) / 2 < 0.03
    second = Counter((tuple(s[0].ids.tolist()), tuple(s[1].ids.tolist())) for s in got if len(s) > 1)
    if len(want) > 1:
        gap = sum(abs(second[i, j] / n - math.exp(want[i] + want[j]) / (1 - math.exp(want[i]))) for i in want for j in want if i != j) / 2
        assert gap < 0.05
    for samples in got[:500]:
        ids = [tuple(s.ids.tolist()) for s in samples]
        assert len(set(ids)) == len(ids) == min(3, len(want))
        assert all(s.logp == pytest.approx(want[i], abs=1e-9) for s, i in zip(samples, ids))
        assert all(a.value >= b.value for a, b in zip(samples, samples[1:]))
        assert all(pieces.decode(s.ids).decode() == text for s in samples)
    # Each path's probability over its inclusion probability adds up to one on average.
    assert np.mean([sum(math.exp(s.logp - s.inclusion) for s in x) for x in got]) == pytest.approx(1, abs=0.03)


def test_all_segmentations_come_out(pieces):
    want = brute(pieces, "the cat")
    got = lattice.sample_texts(pieces, ["the cat"], [5], len(want) + 9)[0]
    assert {tuple(s.ids.tolist()) for s in got} == set(want) and all(s.inclusion == 0 for s in got)


def test_shared_sets_are_split(pieces, monkeypatch):
    monkeypatch.setattr(lattice, "NEAR", 1)
    want, n = brute(pieces, "a the b"), 4_000
    got = lattice.sample_texts(pieces, ["a the b"] * n, list(range(n)), 4)
    second = Counter((tuple(s[0].ids.tolist()), tuple(s[1].ids.tolist())) for s in got)
    gap = sum(abs(second[i, j] / n - math.exp(want[i] + want[j]) / (1 - math.exp(want[i]))) for i in want for j in want if i != j) / 2
    assert gap < 0.08 and all(len({tuple(s.ids.tolist()) for s in x}) == 4 for x in got)


def test_batches_and_forgetting_change_nothing(pieces, monkeypatch):
    texts = ["some of the words", "of the same kind of words", "", "x" * 400, "one\ntwo  three"]
    whole = lattice.sample_texts(pieces, texts, [1, 2, 3, 4, 5], 3)
    monkeypatch.setattr(lattice, "MOST_WORDS", 2)
    words = lattice.Words(pieces)
    for text, seed, want in zip(texts, [1, 2, 3, 4, 5], whole):
        alone = lattice.sample_texts(words, [text], [seed], 3)[0]
        assert [s.ids.tolist() for s in alone] == [s.ids.tolist() for s in want]


def test_spelling_matches_library(pieces):
    library = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    for text in ["plain words", " lead", "two  spaces", "tab\tline\n", "日本語 😀", "é ﬁ Ａ", "▁mark"]:
        ids = library.encode(text)
        spelled = "".join(map(pieces.spell, lattice.words_of(text)))
        assert "".join(pieces.text[i] for i in ids) == spelled
        assert pieces.decode(ids).decode() == library.decode(ids)


def test_edges(spark, edge_docs, no_docs, pieces):
    got = lattice.sample_segmentations(edge_docs, MODEL, k=2)
    rows = got.collect()
    count = Counter(r.doc_id for r in rows)
    assert count[1] == count[2] == 1 and count[4] == 2 and count[5] == 4
    assert all(r.log_inclusion <= 1e-12 and r.log_prob <= 1e-9 for r in rows)
    assert {tuple(r.ids) for r in rows if r.doc_id in (1, 2)} == {()}
    texts = {(r.doc_id, r.text) for r in edge_docs.select("doc_id", "text").collect()}
    back = {(r.doc_id, r.text) for r in lattice.decode(got, MODEL).collect()}
    assert back == {(d, t or "") for d, t in texts}
    again = {(r.doc_id, r["rank"], tuple(r.ids)) for r in lattice.sample_segmentations(edge_docs.repartition(1), MODEL, k=2).collect()}
    assert again == {(r.doc_id, r["rank"], tuple(r.ids)) for r in rows}
    assert lattice.sample_digests(no_docs, MODEL).count() == 0
    digests = lattice.sample_digests(edge_docs, MODEL, k=2).collect()
    texts = {(d, hashlib.sha256((t or "").encode()).hexdigest()) for d, t in texts}
    assert {(r.doc_id, r.text_sha256) for r in digests} == texts and len(digests) == len(rows)
    with pytest.raises(ValueError, match="between"):
        lattice.sample_digests(edge_docs, MODEL, k=1_000)


def test_forgetting_keeps_words_in_use(pieces, monkeypatch):
    """Words that come in every call are built once, though the table of words overflows again and again."""
    built, build = Counter(), lattice.build
    monkeypatch.setattr(lattice, "build", lambda p, own: built.update(own) or build(p, own))
    monkeypatch.setattr(lattice, "MOST_WORDS", 12)
    words = lattice.Words(pieces)
    for i in range(30):
        text = f"the cat {'abcdefghij'[i % 10] * (2 + i // 10)} once{i}"
        got = lattice.sample_texts(words, [text], [i], 3)[0]
        want = lattice.sample_texts(lattice.Words(pieces), [text], [i], 3)[0]
        built.subtract(lattice.words_of(text))  # those of the fresh table
        assert [s.ids.tolist() for s in got] == [s.ids.tolist() for s in want]
    assert built["the"] == built["cat"] == 1 and len(words.number) <= 16


def test_words_of_all_texts(pieces):
    texts = ["a b", "", " lead", "c", "d  e ", "\u2581f g", "é\n x", " "]
    words, counts = lattice.words_of_all(texts)
    assert words.to_pylist() == [w.encode() for t in texts for w in lattice.words_of(t)]
    assert counts == [len(lattice.words_of(t)) for t in texts]


def test_far_sets_wait_together(pieces, monkeypatch):
    """With FAR at zero only the first word's set is split off singly; second samples keep their distribution."""
    monkeypatch.setattr(lattice, "FAR", 0.0)
    want, n = brute(pieces, "a the b"), 4_000
    got = lattice.sample_texts(pieces, ["a the b"] * n, list(range(n)), 4)
    second = Counter((tuple(s[0].ids.tolist()), tuple(s[1].ids.tolist())) for s in got)
    gap = sum(abs(second[i, j] / n - math.exp(want[i] + want[j]) / (1 - math.exp(want[i]))) for i in want for j in want if i != j) / 2
    assert gap < 0.08 and all(len({tuple(s.ids.tolist()) for s in x}) == 4 for x in got)
