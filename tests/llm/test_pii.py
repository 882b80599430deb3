import hashlib
import re
import time

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from waypost.llm import pii

EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def plain(text):
    """The four patterns as they are written."""
    out = [pii.Span("email", *m.span()) for m in EMAIL.finditer(text)]
    out += [pii.Span("ip", *m.span()) for m in IP.finditer(text) if all(int(p) <= 255 for p in m[0].split("."))]
    out += [pii.Span("card", *m.span()) for m in CARD.finditer(text) if 16 <= len(d := re.sub(r"[ -]", "", m[0])) <= 19 and pii.luhn(d)]
    out += [pii.Span("phone", *m.span()) for m in PHONE.finditer(text) if 8 <= len(pii.digits_of(m[0])) <= 15]
    return out


@given(st.text(alphabet="a.@-+1 2(9)0é%", max_size=40))
@settings(max_examples=1500, deadline=None)
def test_scanners_match_patterns(text):
    assert pii.base_spans(text) == plain(text)


@given(st.lists(st.sampled_from(["1.2.3.4", "256.1.1.1", ".", "@", "a@b.c", "x", " ", "4111111111111111", "4111 1111-1111 1111", "+1 (234) 555-1234", "+", "0", "..", "b.c@d"]), max_size=8))
@settings(max_examples=800, deadline=None)
def test_scanners_match_patterns_on_items(parts):
    text = "".join(parts)
    assert pii.base_spans(text) == plain(text)


def test_scanners_are_linear():
    start = time.process_time()
    for text in ("a" * 10**6 + "@", "1" * 10**6, "1." * 500_000, "+1" + "-" * 10**6, "@" * 10**5, "a@b" * 10**5):
        pii.base_spans(text)
    assert time.process_time() - start < 30


def test_gradients():
    rng = np.random.default_rng(0)
    model = pii.Tagger(1)
    x, y = rng.integers(0, pii.CLASSES, (3, 7)), np.array([[0, 1, 2, 2, 0, 0, 3], [0] * 7, [5, 6, 6, 0, 7, 8, 0]])
    _, grads = model.loss_and_grads(x, y)
    for name, p in model.p.items():
        for _ in range(4):
            at = tuple(rng.integers(0, n) for n in p.shape)
            if name == "move" and model.stop[at] < 0:
                continue
            old, h = p[at], 1e-5
            p[at] = old + h
            up = model.loss_and_grads(x, y)[0]
            p[at] = old - h
            down = model.loss_and_grads(x, y)[0]
            p[at] = old
            assert grads[name][at] == pytest.approx((up - down) / (2 * h), abs=1e-5)


def test_viterbi_is_best_path():
    import itertools

    rng = np.random.default_rng(3)
    model = pii.Tagger(2)
    model.p["move"] = rng.normal(size=model.p["move"].shape)
    e = rng.normal(size=(4, len(pii.TAGS)))
    move = model.p["move"] + model.stop

    def value(path):
        return e[0, path[0]] + move[-1, path[0]] + sum(e[t, path[t]] + move[path[t - 1], path[t]] for t in range(1, len(path)))

    best = max(itertools.product(range(len(pii.TAGS)), repeat=4), key=value)
    assert tuple(model.viterbi(e)) == best


@pytest.fixture(scope="module")
def model():
    examples = [("the rest of it and " + t, [pii.Span(k, 19, 19 + len(t))]) for k, t in (("email", "abc.12@mail3.example.com"), ("ip", "42.1.3.200"), ("card", "4041894974608795"), ("phone", "+1 (269) 555-3296"))]
    return pii.fit(examples, made=1_000)


def test_held_out_accuracy(model):
    rng = np.random.default_rng(99)
    hit = want = extra = 0
    for _ in range(300):
        text, spans = pii.made_example(rng, "le la un entre quatre mots de plus que le reste du texte")
        found = {tuple(s) for s in pii.all_spans(model, [text])[0][1]}
        want += len(spans)
        hit += sum(tuple(s) in found for s in spans)
        extra += len(found - {tuple(s) for s in spans})
    assert hit / want > 0.85 and extra / want < 0.08


def test_adds_a_phone_that_runs_into_a_card(model):
    text = "erntou +1 (269) 555-3296 4524132264652876 and"
    base, every = pii.all_spans(model, [text])[0]
    assert not [s for s in base if s.kind == "phone"]
    assert set(base) <= set(every)


def test_clean_text_stays(model):
    clean = "Token 12, chapter 3.4 and the year 1999; \"24be64439e3e49cf46b2d7c90f3602a3d0b907ff\" v1.2.3 10:45 100% a-1"
    assert pii.all_spans(model, [clean])[0][1] == []


def test_windows_cover_every_hint():
    text = "x" * 500 + "7" + "y" * 500
    starts = pii.active_windows(text)
    assert starts and all(s <= 500 < s + pii.WINDOW for s in starts) and len(starts) == 2
    assert pii.active_windows("no hints here" * 50) == [] and pii.active_windows("1") == [0]


def test_mask():
    spans = [pii.Span("email", 2, 5), pii.Span("phone", 4, 8)]
    assert pii.mask("01234567xx", spans) == "01[EMAIL]xx"


def test_edges(spark, model, edge_docs, no_docs):
    got = pii.digest(edge_docs, model).collect()
    assert len(got) == edge_docs.count()
    by = {r.doc_id: r for r in got}
    assert by[8].n_email == by[8].n_card == 1 and by[1].spans == by[2].spans == ""
    masked = pii.redact(edge_docs, model)
    assert masked.columns == edge_docs.columns
    texts = {r.doc_id: r.text for r in masked.collect()}
    assert "[EMAIL]" in texts[8] and "[CARD]" in texts[8] and texts[1] is None and texts[7] == "x" * 50_000
    assert pii.find(edge_docs, model).where("size(spans) > 0").count() == sum(r.spans != "" for r in got)
    assert pii.digest(no_docs, model).count() == 0 and pii.redact(no_docs, model).count() == 0
    assert pii.labelled_windows(no_docs) == []


def test_addresses_without_digits_are_found(model):
    """Held out: addresses with signs in words and no digit, at any place of a text without other hints."""
    rng = np.random.default_rng(77)
    word = lambda lo, hi: "".join(chr(97 + c) for c in rng.integers(0, 26, rng.integers(lo, hi)))
    hit = n = 0
    while n < 200:
        at, dot = [(" (at) ", " (dot) "), (" [at] ", " [dot] "), ("(at)", "(dot)"), (" (at) ", ".")][n % 4]
        address = f"{word(2, 9)}{'._'[n % 2]}{word(2, 9)}{at}{word(3, 8)}{dot}org"
        before = "le la un entre quatre mots de plus " * int(rng.integers(0, 6))
        text = f"{before}{address}, que le reste du texte de plus en plus"
        assert pii.base_spans(text) == [] and pii.legal("email", address)
        hit += pii.Span("email", len(before), len(before) + len(address)) in pii.all_spans(model, [text])[0][1]
        n += 1
    assert hit / n > 0.8


def test_windows_cover_words_around_signs_in_words():
    text = "x" * 500 + "(at)" + "y" * 500
    held = {i for s in pii.active_windows(text) for i in range(s, s + pii.WINDOW)}
    assert held >= set(range(500 - 64, 504 + 64)) and pii.legal("email", "jane.doe (at) mail (dot) org")


def test_redact_masks_addresses_without_digits(spark, model):
    docs = spark.createDataFrame([(1, "please write to jane.doe (at) mail (dot) org, que le reste du texte")], "doc_id bigint, text string")
    assert "[EMAIL]" in pii.redact(docs, model).first().text


def test_sampled_excerpts_have_every_kind_and_no_repeats(spark):
    full = " ".join(f"text {i} of it a{i}@b.example.com and so on, which is long enough for one excerpt to end" for i in range(5))
    full += " then 10.20.30.40 and 4111111111111111 with +1 (234) 555-1234 at last"
    rows = [(i, full) for i in range(50)] + [(100, "x@y.org")]
    got = pii.labelled_windows(spark.createDataFrame(rows, "doc_id bigint, text string"))
    assert len({t for t, _ in got}) == len(got) and {s.kind for _, spans in got for s in spans} == set(pii.KINDS)
    assert any(t == "x@y.org" for t, _ in got)


def test_counts_are_of_base_spans(spark, model):
    """Spans that the model adds are in ``spans`` and ``n_added`` only."""
    texts = ["mail abc.12@mail3.example.com or jane.doe (at) mail (dot) org, que le reste", "erntou +1 (269) 555-3296 and 42.1.3.200, a@b.c", None, "x 1.2.3.256 (212) 555-0123 1.2.3.4.5.6.7.8"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    rows = {r.doc_id: r for r in pii.digest(docs, model).collect()}
    for i, t in enumerate(texts):
        want = plain(t or "")
        assert [rows[i][f"n_{k}"] for k in pii.KINDS] == [sum(s.kind == k for s in want) for k in pii.KINDS]
        assert rows[i].base_sha256 == hashlib.sha256(pii.joined(want).encode()).hexdigest()
        assert rows[i].n_added == len(rows[i].spans.split(",")) * (rows[i].spans != "") - len(want)
    assert rows[0].n_added > 0
