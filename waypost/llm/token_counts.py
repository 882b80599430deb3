"""Exact token counts by compiled finite-state transducers.

Byte-level BPE is compiled into a deterministic transducer over bytes. While a
pretoken is read, several token boundaries are still possible; a state holds
the pending bytes from the earliest of them, and for each boundary still alive
its last token and its count relative to the least. A transition on a byte is
annotated with the number of tokens that it makes certain; the end of the
pretoken emits the rest. The transducer rests on the property that the
encoding of a prefix is the encoding of a shorter prefix plus one token, which
is unique among the tokens ending there that the merges leave apart from the
token before. States and transitions are compiled when first needed, from the
vocabulary and merges alone, and dropped together when there are too many.

A text is cut into chunks. Between a character that is surely not white space
and a space the pretokenizer always cuts, so that a chunk maps any incoming
state to: what it adds before its first such place, a count between first and
last, and what is pending after the last. These maps form a monoid, and a
text's maps are composed by a balanced prefix scan. Special strings in a text
count as the library's default has it: one token each, and the pieces between
them are pretokenized alone.

A null text is empty: no bytes, no tokens. Rows are judged one by one, so that
null, repeated or clashing keys need nothing special.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from waypost.llm.common import Recent, map_texts, per_process, text_of

#: Characters in a chunk; compiled states, and remembered counts of pretokens and segments, at most.
CHUNK_CHARS, MOST_STATES, MOST_PRETOKENS, MOST_SEGMENTS = 1 << 16, 250_000, 250_000, 250_000
#: The most tokens that a row may have before it is marked.
LIMIT = 512

#: Published pattern that splits text before byte-level merges (a fixed value).
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


def byte_letters() -> dict[str, int]:
    """The printable letters that stand for bytes in byte-level vocabularies."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class Vocabulary:
    """Token bytes, merge ranks and special strings of a tokenizer file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        letters = byte_letters()
        raw = lambda piece: bytes(letters[c] for c in piece)
        self.ranks: dict[tuple[bytes, bytes], int] = {}
        for i, merge in enumerate(spec["model"]["merges"]):
            a, b = merge.split(" ") if isinstance(merge, str) else merge
            self.ranks[raw(a), raw(b)] = i
        self.tokens = {raw(piece) for piece in spec["model"]["vocab"]}
        self.tokens = {t for t in self.tokens if self.merged(t) == [t]}  # those that merging can make
        self.halves = {a + b: (a, b) for a, b in self.ranks}
        self.age = {a + b: rank for (a, b), rank in self.ranks.items()}
        self.prefixes = {t[:k] for t in self.tokens for k in range(1, len(t))}
        self.special = [a["content"] for a in spec.get("added_tokens", [])]

    def merged(self, raw: bytes) -> list[bytes]:
        """Plain merging by rank; only used on single tokens, when the file is read."""
        parts = [raw[i : i + 1] for i in range(len(raw))]
        while len(parts) > 1:
            rank, at = min((self.ranks.get((parts[i], parts[i + 1]), 1 << 60), i) for i in range(len(parts) - 1))
            if rank == 1 << 60:
                break
            pair, out, i = (parts[at], parts[at + 1]), [], 0
            while i < len(parts):
                if i + 1 < len(parts) and (parts[i], parts[i + 1]) == pair:
                    out.append(pair[0] + pair[1])
                    i += 2
                else:
                    out.append(parts[i])
                    i += 1
            parts = out
        return parts


class Transducer:
    """The merges as a lazily compiled subsequential transducer.

    A state is (pending bytes, alive): ``alive`` has for each boundary still
    possible its distance from the end, its last token (empty at the start) and
    its count above the least. The newest boundary, the end itself, comes last.
    """

    def __init__(self, vocabulary: Vocabulary):
        self.v = vocabulary
        self.reset()

    def reset(self) -> None:
        self.number: dict[tuple, int] = {}
        self.states: list[tuple] = []
        self.rest: list[int] = []
        self.next: dict[int, tuple[int, int]] = {}
        self.start = self.state(b"", ((0, b"", 0),))

    def state(self, pending: bytes, alive: tuple) -> int:
        key = (pending, alive)
        n = self.number.get(key)
        if n is None:
            n = self.number[key] = len(self.states)
            self.states.append(key)
            self.rest.append(alive[-1][2])
        return n

    def stay_apart(self, a: bytes, b: bytes) -> bool:
        """True if the merges leave token b after token a as it is.

        Undoes the merges of both tokens, latest first, and asks at each step
        whether the parts that then meet would have merged earlier.
        """
        age, halves, pairs = self.v.age, self.v.halves, self.v.ranks
        until = 1 << 60
        while a:
            if pairs.get((a, b), 1 << 60) < until:
                return False
            if len(b) == 1 or len(a) > 1 and age[a] > age[b]:
                if len(a) == 1:
                    return True
                until, a = age[a], halves[a][1]
            else:
                until, b = age[b] + 1, halves[b][0]
        return True

    def compile(self, state: int, byte: int) -> tuple[int, int]:
        """Transition: next state and the tokens that became certain."""
        pending, alive = self.states[state]
        grown = pending + bytes([byte])
        size = len(grown)
        tokens, prefixes, last, count, kept = self.v.tokens, self.v.prefixes, None, 0, []
        for back, token, n in alive:  # back: distance of the boundary from the old end
            new = grown[size - 1 - back :]
            if last is None and new in tokens and self.stay_apart(token, new):
                last, count = new, n + 1
            if new in prefixes:
                kept.append((back + 1, token, n))
        if last is None:
            raise ValueError("no token ends here: the merges do not cover single bytes")
        least = min([count, *(n for _, _, n in kept)])
        kept.append((0, last, count))
        to = self.state(grown[size - kept[0][0] :], tuple((b, t, n - least) for b, t, n in kept))
        edge = self.next[state << 8 | byte] = (to, least)
        return edge

    def count(self, pretoken: bytes) -> int:
        if len(self.states) > MOST_STATES:
            self.reset()
        state, total, edges = self.start, 0, self.next
        for byte in pretoken:
            edge = edges.get(state << 8 | byte)
            if edge is None:
                edge = self.compile(state, byte)
                edges = self.next
            state = edge[0]
            total += edge[1]
        return total + self.rest[state]


#: Characters after which a space surely starts a new pretoken (not white space in any reading), and a space after others.
_SURE = re.compile(r"[!-~¡-ɏͰ-ϿЀ-ӿ]\Z")
_UNSURE = re.compile(r"[^!-~¡-ɏͰ-ϿЀ-ӿ] ")


class Counter:
    """Counts tokens of texts; remembers pretokens and segments that it has seen."""

    def __init__(self, path: str):
        import regex

        self.vocabulary = Vocabulary(path)
        self.transducer = Transducer(self.vocabulary)
        self.split = regex.compile(PATTERN).findall
        self.special = re.compile("|".join(map(re.escape, self.vocabulary.special))) if self.vocabulary.special else None
        self.pretokens = Recent(lambda p: self.transducer.count(p.encode("utf-8", "surrogatepass")), MOST_PRETOKENS)
        self.spaced = Recent(lambda part: self.segment(" " + part), MOST_SEGMENTS)

    def segment(self, text: str) -> int:
        """Tokens of a stretch that starts and ends where the pretokenizer cuts."""
        if self.special is not None and self.special.search(text):
            pieces = self.special.split(text)
            return len(pieces) - 1 + sum(map(self.segment, pieces))
        return sum(map(self.pretokens.__getitem__, self.split(text)))

    def between(self, parts: list[str]) -> int:
        """Tokens of segments that each start with a space, given without it."""
        return sum(map(self.spaced.__getitem__, parts))

    def chunk(self, text: str) -> tuple:
        """The chunk's state map: (whole,) without a sure cut, else (before, count, after)."""
        parts = text.split(" ")
        if not parts[0] or _UNSURE.search(text):
            held, parts = parts, []
            for part in held:
                if parts and (not parts[-1] or not _SURE.search(parts[-1])):
                    parts[-1] += " " + part
                else:
                    parts.append(part)
        if len(parts) == 1:
            return (text,)
        return (parts[0], self.between(parts[1:-1]), " " + parts[-1])

    def compose(self, a: tuple, b: tuple) -> tuple:
        """Map of two neighbouring chunks; a sure cut may also lie exactly between them."""
        cut = b[0][:1] == " " and bool(_SURE.search(a[-1]))
        if len(a) == 1 and len(b) == 1:
            return (a[0], 0, b[0]) if cut else (a[0] + b[0],)
        if len(a) == 1:
            return (a[0], self.segment(b[0]) + b[1], b[2]) if cut else (a[0] + b[0], b[1], b[2])
        if len(b) == 1:
            return (a[0], a[1] + self.segment(a[2]), b[0]) if cut else (a[0], a[1], a[2] + b[0])
        middle = self.segment(a[2]) + self.segment(b[0]) if cut else self.segment(a[2] + b[0])
        return (a[0], a[1] + middle + b[1], b[2])

    def scan(self, maps: Sequence[tuple]) -> tuple:
        """Compose neighbouring maps pairwise, in rounds, until one is left."""
        while len(maps) > 1:
            maps = [self.compose(*maps[i : i + 2]) if i + 1 < len(maps) else maps[i] for i in range(0, len(maps), 2)]
        return maps[0]

    def count(self, text: str) -> int:
        if not text:
            return 0
        whole = self.scan([self.chunk(text[i : i + CHUNK_CHARS]) for i in range(0, len(text), CHUNK_CHARS)])
        if len(whole) == 1:
            return self.segment(whole[0])
        return self.segment(whole[0]) + whole[1] + self.segment(whole[2])

    def counts(self, texts: Iterable[str]) -> list[int]:
        return [self.count(t) for t in texts]


def counter(path: str) -> Counter:
    """One compiled counter per tokenizer file and worker process."""
    return per_process(("token_counts", path), lambda: Counter(path))


def count_tokens(docs: DataFrame, path: str, key: str = "doc_id", text: str = "text", limit: int = LIMIT) -> DataFrame:
    """key, n_bytes, n_tokens, over_limit for every row. ``path`` names the tokenizer file on the executors."""
    kind = docs.schema[key].dataType.simpleString()

    def run(keys, texts, sizes):
        tokens = counter(path).counts(texts)
        return {key: keys, "n_bytes": sizes, "n_tokens": tokens, "over_limit": [n > limit for n in tokens]}

    whole = text_of(text)
    return map_texts(docs.select(F.col(key), whole.alias("_text"), F.octet_length(whole).cast("bigint").alias("_bytes")), f"`{key}` {kind}, n_bytes bigint, n_tokens bigint, over_limit boolean", run)
