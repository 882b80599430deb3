"""Quality rules as a short-circuit cascade.

Each rule rejects or passes a text. The cost of a rule and the share of texts
that it rejects are measured on a bounded sample; rules then run in the order
of rejections per second, each measured on the texts that the rules before it
let through, and a text stops at its first rejection. The order changes the
time only: a text is kept exactly if no rule rejects it.

A null text counts as empty (no words, so ``short`` rejects it). Rows with a
null or repeated key are rows like any other. An empty table gives an empty
result; columns beyond key and text are not read, whatever their names.
"""

from __future__ import annotations

import time
from collections import Counter
from collections.abc import Callable, Sequence
from functools import cached_property
from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from waypost.llm.common import map_texts, text_of

#: Rows on which costs and rejections are estimated (expected size of the sample).
SAMPLE_ROWS = 2_000
SYMBOLS = b"#*$%&|<>"
SPACES = str.maketrans("", "", "\t\n\x0b\x0c\r ")


class Text:
    """A text and its measures, each computed when a rule first asks for it."""

    def __init__(self, text: str | None):
        self.text = text or ""

    @cached_property
    def raw(self) -> bytes:
        return self.text.encode("utf-8", "surrogatepass")

    @cached_property
    def words(self) -> list[bytes]:
        return self.raw.split()  # of bytes: at the six ASCII space characters only

    @property
    def n_words(self) -> int:
        return len(self.words)

    @cached_property
    def word_chars(self) -> int:
        return len(self.text.translate(SPACES)) if not self.text.isascii() else sum(map(len, self.words))

    @cached_property
    def n_symbols(self) -> int:
        return len(self.raw) - len(self.raw.translate(None, SYMBOLS))

    @cached_property
    def lines(self) -> list[bytes]:
        return [line for line in self.raw.split(b"\n") if line and not line.isspace()]

    @cached_property
    def n_dup_lines(self) -> int:
        return len(self.lines) - len(set(self.lines))

    @cached_property
    def n_repeat_words(self) -> int:
        words = self.words
        windows = list(zip(words, words[1:], words[2:]))
        if len(seen := set(windows)) == len(windows):
            return 0
        del seen
        counts = Counter(windows)
        covered, upto = 0, 0
        for i, window in enumerate(windows):
            if counts[window] > 1:
                covered += i + 3 - max(i, upto)
                upto = i + 3
        return covered


class Rule(NamedTuple):
    name: str
    rejects: Callable[[Text], bool]


BASE_RULES = [
    Rule("short", lambda t: t.n_words < 50),
    Rule("repetitive", lambda t: 100 * t.n_repeat_words > 50 * t.n_words),
]
RULES = [
    *BASE_RULES,
    Rule("symbols", lambda t: 10 * t.n_symbols > t.n_words),
    Rule("duplicate_lines", lambda t: 2 * t.n_dup_lines > len(t.lines)),
    Rule("word_length", lambda t: not 2 * t.n_words <= t.word_chars <= 20 * t.n_words),
]


class Estimate(NamedTuple):
    """Per rule, over the texts that reached it: mean seconds and share rejected."""

    rule: str
    cost: float
    rejected: float


def greedy_order(names: Sequence[str], rows: list[tuple[list[float], list[bool]]]) -> list[Estimate]:
    """Repeatedly the rule that rejects most per second among the sampled texts still left.

    ``rows`` has each text's seconds and verdicts by rule. Ties go to the rule named first.
    """
    left, todo, out = rows, list(range(len(names))), []
    while todo:
        n = max(1, len(left))
        cost = {k: max(1e-9, sum(r[0][k] for r in left) / n) for k in todo}
        share = {k: sum(r[1][k] for r in left) / n for k in todo}
        best = max(todo, key=lambda k: (share[k] / cost[k], -k))
        out.append(Estimate(names[best], cost[best], share[best]))
        left = [r for r in left if not r[1][best]]
        todo.remove(best)
    return out


def plan(docs: DataFrame, text: str = "text", rules: Sequence[Rule] = RULES, sample_rows: int = SAMPLE_ROWS) -> list[Estimate]:
    """Order the rules by rejections per second on about ``sample_rows`` rows."""
    rules = list(rules)
    n = docs.count()
    part = docs.select(text_of(text).alias("text"))
    if n > sample_rows:
        part = part.sample(sample_rows / n, seed=11)

    def measure(texts):
        costs, verdicts = [], []
        for text in texts:
            row = [], []
            for rule in rules:
                fresh = Text(text)  # what rules share counts for each
                start = time.perf_counter()
                verdict = bool(rule.rejects(fresh))
                row[0].append(time.perf_counter() - start)
                row[1].append(verdict)
            costs.append(row[0])
            verdicts.append(row[1])
        return {"costs": costs, "verdicts": verdicts}

    rows = map_texts(part, "costs array<double>, verdicts array<boolean>", measure, text=0).collect()
    return greedy_order([r.name for r in rules], [(r.costs, r.verdicts) for r in rows])


def ordered(rules: Sequence[Rule], estimates: Sequence[Estimate]) -> list[Rule]:
    by_name = {r.name: r for r in rules}
    return [by_name[e.rule] for e in estimates]


def first_rejection(text: Text, rules: Sequence[Rule]) -> str | None:
    """Name of the first rule that rejects; later rules are not evaluated."""
    return next((r.name for r in rules if r.rejects(text)), None)


def cascade(docs: DataFrame, key: str = "doc_id", text: str = "text", rules: Sequence[Rule] = RULES, sample_rows: int = SAMPLE_ROWS, measures: bool = False) -> DataFrame:
    """key, kept, rejected_by; with ``measures`` also every base measure of every text."""
    chain = ordered(rules, plan(docs, text, rules, sample_rows))
    kind = docs.schema[key].dataType.simpleString()
    schema = f"`{key}` {kind}, kept boolean, rejected_by string"
    named = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"] if measures else []
    schema += "".join(f", {m} bigint" for m in named)

    def judge(keys, texts):
        seen = [Text(t) for t in texts]
        by = [first_rejection(t, chain) for t in seen]
        out = {key: keys, "kept": [b is None for b in by], "rejected_by": by}
        columns: dict[str, list[int]] = {m: [] for m in named}
        for i, t in enumerate(seen):
            for m in named:
                columns[m].append(getattr(t, m))
            seen[i] = None
        return out | columns

    return map_texts(docs.select(F.col(key), text_of(text).alias("_text")), schema, judge)


def keep(docs: DataFrame, text: str = "text", rules: Sequence[Rule] = RULES, sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """The rows of ``docs``, all columns as they are, that no rule rejects."""
    import pyarrow as pa

    chain = ordered(rules, plan(docs, text, rules, sample_rows))
    at = docs.columns.index(text)

    def run(batches):
        for batch in batches:
            kept = [first_rejection(Text(t.as_py()), chain) is None for t in batch.column(at)]
            yield batch.filter(pa.array(kept, pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
