import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from waypost.llm import bitplanes, token_counts

BYTES, WORDS = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("word_bpe_49k.json")
PARTS = ["a", "b", " ", "  ", "\n", "\t", " \n", "'s", "'", "don't", "I'LL", "<|endoftext|>", "<|endof", "é", "日本", "1", "23", ".", "!!", "the", " the", "ing", "X", "😀", "_", "aaaaaaaaa", "http://", "\x85", "\xa0", " ", "\x1c", "é", "<|startoftext|>", "Σ", "İ"]


@pytest.fixture(scope="module")
def counter():
    return token_counts.Counter(BYTES)


@pytest.mark.parametrize("size", [3, 7, 1 << 16])
def test_counts_match_library(counter, monkeypatch, size):
    monkeypatch.setattr(token_counts, "CHUNK_CHARS", size)
    library, rng = Tokenizer.from_file(BYTES), random.Random(size)
    texts = ["".join(rng.choice(PARTS) for _ in range(rng.randint(0, 16))) for _ in range(3_000)]
    assert counter.counts(texts) == [len(e.ids) for e in library.encode_batch(texts, add_special_tokens=False)]


def test_transducer_is_exact_on_any_bytes(counter):
    rng = random.Random(8)
    tokens = sorted(counter.vocabulary.tokens)
    for _ in range(1_500):
        raw = b"".join(rng.choice(tokens) for _ in range(rng.randint(1, 5)))
        assert counter.transducer.count(raw) == len(counter.vocabulary.merged(raw))


def test_chunk_maps_compose_in_any_grouping(counter):
    text = "An  odd text, with\n lines <|endoftext|> and   spaces " * 4
    chunks = [counter.chunk(text[i : i + 5]) for i in range(0, len(text), 5)]
    left = chunks[0]
    for c in chunks[1:]:
        left = counter.compose(left, c)
    whole = lambda m: sum(map(counter.segment, (m[0], m[2]))) + m[1] if len(m) == 3 else counter.segment(m[0])
    assert whole(left) == whole(counter.scan(chunks)) == counter.count(text)


def test_counts_survive_small_caches(monkeypatch):
    monkeypatch.setattr(token_counts, "MOST_STATES", 50)
    monkeypatch.setattr(token_counts, "MOST_SEGMENTS", 20)
    monkeypatch.setattr(token_counts, "MOST_PRETOKENS", 20)
    library, rng = Tokenizer.from_file(BYTES), random.Random(5)
    texts = [" ".join("".join(rng.choice("abcdething") for _ in range(rng.randint(1, 9))) for _ in range(60)) for _ in range(40)]
    assert token_counts.Counter(BYTES).counts(texts) == [len(e.ids) for e in library.encode_batch(texts)]


def test_count_edges(edge_docs, no_docs):
    library = Tokenizer.from_file(BYTES)
    got = sorted(tuple((-1 if v is None else v) for v in r) for r in token_counts.count_tokens(edge_docs, BYTES).collect())
    want = []
    for r in edge_docs.select("doc_id", "text").collect():
        n = len(library.encode(r.text or "").ids)
        want.append((-1 if r.doc_id is None else r.doc_id, len((r.text or "").encode()), n, n > 512))
    assert got == sorted(want)
    assert token_counts.count_tokens(no_docs, BYTES).count() == 0


@given(st.lists(st.integers(0, 2**32 - 1), max_size=300), st.sampled_from(["bit", "byte"]), st.sampled_from([8, 64, 1 << 16]))
@settings(max_examples=150, deadline=None)
def test_planes_round_trip(ids, kind, block):
    ids = np.array(ids, np.uint32)
    assert (bitplanes.unpack_ids(bitplanes.pack_ids(ids, kind, block)) == ids).all()


def test_word_ids_match_library(monkeypatch):
    monkeypatch.setattr(bitplanes, "MOST_WORDS", 30)
    library, rng, encoder = Tokenizer.from_file(WORDS), random.Random(1), bitplanes.WordEncoder(WORDS)
    for _ in range(60):
        texts = ["".join(rng.choice([*PARTS, " ", "\n"]) for _ in range(rng.randint(0, 16))) for _ in range(20)]
        got = [np.frombuffer(b, "<u4").tolist() for b in encoder.encode(texts)]
        assert got == [e.ids for e in library.encode_batch(texts, add_special_tokens=False)]


def test_every_plain_character_matches_library():
    library, encoder, rng = Tokenizer.from_file(WORDS), bitplanes.WordEncoder(WORDS), random.Random(3)
    plain = [chr(c) for c in range(1, 0x180) if bitplanes.PLAIN.fullmatch(chr(c))]
    texts = ["".join(rng.choice([*plain, "'S", "'re", "<|", "|>"]) for _ in range(rng.randint(0, 25))) for _ in range(4_000)] + plain
    got = [np.frombuffer(b, "<u4").tolist() for b in encoder.encode(texts)]
    assert got == [e.ids for e in library.encode_batch(texts, add_special_tokens=False)]


def test_plain_texts_look_up_each_distinct_word_once():
    class Counted(dict):
        lookups = 0

        def __getitem__(self, key):
            Counted.lookups += 1
            return dict.__getitem__(self, key) if key in self else self.setdefault(key, encoder.merge(key))

    library, encoder = Tokenizer.from_file(WORDS), bitplanes.WordEncoder(WORDS)
    encoder.pretokens = Counted()
    texts = ["The same few words, they're said 7 times.\n" * 200, "", "the SAME été", "日本 words", " ", "the"]
    got = [np.frombuffer(b, "<u4").tolist() for b in encoder.encode(texts)]
    assert got == [e.ids for e in library.encode_batch(texts, add_special_tokens=False)]
    assert Counted.lookups == len(encoder.pretokens) < 15


@pytest.mark.parametrize("kind", ["bit", "byte"])
def test_file_edges(spark, edge_docs, no_docs, monkeypatch, kind):
    library = Tokenizer.from_file(WORDS)
    monkeypatch.setattr(bitplanes, "CHUNK_IDS", 64)
    file = bitplanes.write_ids(edge_docs, WORDS, end_id=2, planes=kind)
    got = sorted(bitplanes.read_documents(file).collect(), key=lambda r: r.start)
    assert [r.doc_id for r in got] == sorted((r.doc_id for r in got), key=lambda k: (k is not None, k or 0))
    want = sorted((r.doc_id or -1, library.encode(r.text or "", add_special_tokens=False).ids + [2]) for r in edge_docs.select("doc_id", "text").collect())
    assert sorted((r.doc_id or -1, r.ids) for r in got) == want
    at = 0
    for r in got:
        assert (r.start, r.n_tokens) == (at, len(r.ids))
        at += len(r.ids)
    digests = {(r.start, r.ids_crc32) for r in bitplanes.read_digests(file).collect()}
    assert digests == {(r.start, zlib.crc32(np.array(r.ids, "<u4").tobytes())) for r in got}
    assert bitplanes.read_digests(bitplanes.write_ids(no_docs, WORDS, end_id=2)).count() == 0


def test_queries_match_library(spark, sf):
    from waypost.llm.queries import bit_planes, token_count

    docs = spark.read.parquet(f"{sf}/documents.parquet").orderBy("doc_id").select("doc_id", "text").collect()
    byte, word = Tokenizer.from_file(BYTES), Tokenizer.from_file(WORDS)
    counts = {r.doc_id: r.n_tokens for r in token_count(spark, sf).collect()}
    assert counts == {d.doc_id: len(e.ids) for d, e in zip(docs, byte.encode_batch([d.text or "" for d in docs], add_special_tokens=False))}
    planes, at = {r.doc_id: r for r in bit_planes(spark, sf).collect()}, 0
    for d, e in zip(docs, word.encode_batch([d.text or "" for d in docs], add_special_tokens=False)):
        ids = np.array([*e.ids, 2], "<u4")
        r = planes[d.doc_id]
        assert (r.start, r.n_tokens, r.ids_crc32) == (at, len(ids), zlib.crc32(ids.tobytes()))
        at += len(ids)
