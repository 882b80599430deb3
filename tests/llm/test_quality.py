from collections import Counter

from hypothesis import given, settings
from hypothesis import strategies as st

from waypost.llm import quality


def repeat_words(words):
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    counts = Counter(windows)
    return len({i + k for i, w in enumerate(windows) if counts[w] > 1 for k in range(3)})


@given(st.lists(st.sampled_from(["a", "b", "é", "c|", "#"]), max_size=30), st.sampled_from([" ", "\n", "\t ", " \x0b"]))
@settings(max_examples=200, deadline=None)
def test_measures(words, gap):
    text = gap.join(words)
    seen = quality.Text(text)
    assert seen.n_words == len(words) and seen.word_chars == sum(map(len, words))
    assert seen.n_symbols == sum(w.count("|") + w.count("#") for w in words)
    assert seen.n_repeat_words == repeat_words(words)
    lines = [x for x in text.split("\n") if x.strip(" \t\n\r\x0b\x0c")]
    assert seen.n_dup_lines == len(lines) - len(set(lines))


def test_unicode_space_is_no_space():
    assert quality.Text("a b\x85c\x1cd").n_words == 1


def test_greedy_order_takes_rejections_per_second():
    rows = [([1.0, 0.1, 0.1], [True, i % 2 == 0, i < 2]) for i in range(10)]
    order = [e.rule for e in quality.greedy_order(["dear", "half", "few"], rows)]
    assert order == ["half", "few", "dear"]
    assert [e.rule for e in quality.greedy_order(["a", "b"], [])] == ["a", "b"]


def test_order_does_not_change_verdicts(edge_rows):
    for _, text, *_ in edge_rows:
        t = quality.Text(text)
        forward, backward = quality.first_rejection(t, quality.RULES), quality.first_rejection(t, quality.RULES[::-1])
        assert (forward is None) == (backward is None)


def test_short_circuit():
    calls = []
    rules = [quality.Rule("first", lambda t: True), quality.Rule("second", lambda t: calls.append(1) or False)]
    assert quality.first_rejection(quality.Text("x"), rules) == "first" and not calls


def test_edges(edge_docs, no_docs):
    judged = quality.cascade(edge_docs, measures=True).collect()
    assert len(judged) == edge_docs.count()
    for r in judged:
        assert r.kept == (r.rejected_by is None)
    kept = quality.keep(edge_docs)
    assert kept.columns == edge_docs.columns
    assert sorted(r.doc_id or -1 for r in kept.collect()) == sorted(r.doc_id or -1 for r in judged if r.kept)
    assert quality.cascade(no_docs).count() == 0 and quality.keep(no_docs).count() == 0
