"""Segmentation sampling without replacement for SentencePiece vocabularies.

A text's lattice has an edge for each vocabulary piece at each place; every
path is a segmentation, its probability in proportion to the product of its
pieces' probabilities. Gumbel top-k draws K different paths without
replacement: each path gets its log-probability plus Gumbel noise and the K
greatest win. A perturbed A-star search finds them without listing paths. The
bound of a set of paths is the greatest perturbed value in it, drawn from the
set's exact mass (backward sums over the lattice), given the bound of the set
that it was split from. The best set is taken from the queue; its winner is
drawn, and the rest is split into the sets that leave the winner at each of its
words. Values come out in falling order.

Pieces never reach over the start of a space, so that a lattice is a chain of
independent word lattices; these are built once for each distinct word and
remembered for a while. Sets that leave a winner far behind its start wait as
one set and are split only when it is their turn. The inclusion score of a path is the log-probability that it
is among the winners given the next value kappa: log(1 - exp(-exp(phi - kappa))).
All noise comes from a hash of the row key, so that a row's samples do not
depend on the tasks.

The vocabulary's pieces get Zipf-Mandelbrot probabilities by rank, since merge
vocabularies score a piece by rank alone. Characters without a piece become
byte pieces, as in the library.

A null or empty text has one segmentation, without pieces. Texts with fewer
than K segmentations (K is below 1 000) give all of them, with inclusion score 0 (certain). Rows
that repeat a key and a text give the same samples; a null key is a key. An
empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import heapq
import itertools
import math
import random
import re
import zlib
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from waypost.llm.common import map_texts, per_process, text_of

#: Samples per row, sharpness of the distribution (1 takes piece probabilities as they are), seed.
K, ALPHA, SEED = 3, 1.0, 2024
#: Shift of the Zipf-Mandelbrot law; bytes of text sampled at once; word lattices remembered; words split off singly.
SHIFT, SLICE, MOST_WORDS, NEAR = 2.7, 2 << 20, 400_000, 10
#: Words behind the one where a path's log-probability has fallen by this are not split off singly.
FAR = 2.5
#: Ids decoded at once, about.
DECODED = 1 << 17
#: Paths of a word are counted up to this; k is smaller.
MOST_PATHS = 1_000
#: Letters from a word's end up to which masses are added without logarithms; a letter has a probability above 1e-12.
NO_UNDERFLOW = 25
MARK, BYTE_BASE = "▁", 0xF0000
U = np.uint64
GOLDEN = 0x9E3779B97F4A7C15


class Pieces:
    """Vocabulary pieces by the hash of their code points, one table per prefix length."""

    BASE = U(1_000_003)

    def __init__(self, path: str, alpha: float = ALPHA):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        normal = [i for i in range(model.get_piece_size()) if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i))]
        self.text = {i: model.id_to_piece(i) for i in normal}
        if any(MARK in p.lstrip(MARK) for p in self.text.values()):
            raise ValueError("a piece reaches over the start of a word")
        weight = 1.0 / (np.arange(len(normal)) + 1 + SHIFT)
        logp = alpha * np.log(weight / weight.sum())
        self.bytes = {model.piece_to_id(f"<0x{b:02X}>"): b for b in range(256)}
        for i, b in self.bytes.items():
            self.text[i] = chr(BYTE_BASE + b)
        scored = [*zip(normal, logp), *((i, float(logp.min())) for i in self.bytes)]
        single = {self.text[i] for i in normal if len(self.text[i]) == 1}
        self.plain = single.issuperset(map(chr, range(0x21, 0x7F)))  # signs of printable ASCII; a space is a mark by then
        self.unknown = re.compile("[^" + "".join(map(re.escape, sorted(single))) + "]")
        tables: list[dict[int, list]] = [{} for _ in range(max(map(len, self.text.values())))]
        for i, p in scored:
            h = 0
            for n, c in enumerate(self.text[i]):
                h = (h * 1_000_003 + ord(c)) % (1 << 64)
                entry = tables[n].setdefault(h, [-1, 0.0])
            entry[0], entry[1] = i, p
        plain = [bytes([self.bytes[i]]) if i in self.bytes else self.text.get(i, "").replace(MARK, " ").encode() for i in range(model.get_piece_size())]
        self.size = np.array([len(p) for p in plain], np.int32)
        self.start, self.raw = (np.cumsum(self.size) - self.size).astype(np.int32), np.frombuffer(b"".join(plain), np.uint8)
        self.tables = []
        for table in tables:
            keys = np.array(sorted(table), np.uint64)
            self.tables.append((keys, np.array([table[int(k)][0] for k in keys]), np.array([table[int(k)][1] for k in keys])))

    def spell(self, word: str) -> str:
        """The word after its space mark, characters without a piece as byte signs."""
        if self.plain and word.isascii() and word.isprintable() and " " not in word:
            return MARK + word
        word = MARK + word.replace(" ", MARK)
        return self.unknown.sub(lambda m: "".join(chr(BYTE_BASE + b) for b in m[0].encode("utf-8", "surrogatepass")), word)

    def decode(self, ids) -> bytes:
        """UTF-8 text of a sequence of ids."""
        return self.decode_all([np.asarray(ids, np.int32)])[0]

    def decode_all(self, sequences: list[np.ndarray]) -> list[bytes]:
        """UTF-8 texts of sequences of ids."""
        out, lo = [], 0
        while lo < len(sequences):
            hi, held = lo, 0
            while hi < len(sequences) and (hi == lo or held + len(sequences[hi]) <= DECODED):
                held += len(sequences[hi])
                hi += 1
            own = sequences[lo:hi]
            ids = np.concatenate(own)
            size = self.size[ids]
            end = np.concatenate([[0], np.cumsum(size, dtype=np.int64)])
            kind = np.int32 if end[-1] < 1 << 31 else np.int64
            raw = self.raw[np.arange(end[-1], dtype=kind) + np.repeat((self.start[ids] - end[:-1]).astype(kind), size)].tobytes()
            cuts = end[np.cumsum([0, *map(len, own)])].tolist()
            out += [raw[a + (raw[a : a + 1] == b" ") : b] if b > a else b"" for a, b in zip(cuts[:-1], cuts[1:])]
            lo = hi
        return out


def words_of(text: str) -> list[str]:
    """Stretches that start at a space (the first at the mark put before a text), without that space."""
    if not text:
        return []
    if spaced(text):
        return re.findall(r" ( *[^ ]*)", " " + text.replace(MARK, " "))
    return text.split(" ")


def spaced(text: str) -> bool:
    """True where words may hold spaces themselves."""
    return "  " in text or text[0] == " " or text[-1] == " " or MARK in text


def words_of_all(texts: list[str]) -> tuple[pa.Array, list[int]]:
    """The words of all texts in a row, in UTF-8, and how many each text has."""
    parts, counts, plain = [pa.array([], pa.binary())], [], []

    def split() -> None:
        if plain:
            data = np.frombuffer(" ".join(plain).encode("utf-8", "surrogatepass"), np.uint8)
            gaps = np.flatnonzero(data == ord(" "))
            starts = np.concatenate([[0], gaps - np.arange(len(gaps)), [len(data) - len(gaps)]]).astype(np.int32)
            parts.append(pa.Array.from_buffers(pa.binary(), len(starts) - 1, [None, pa.py_buffer(starts), pa.py_buffer(data[data != ord(" ")])]))
            plain.clear()

    for text in texts:
        if text and not spaced(text):
            plain.append(text)
            counts.append(text.count(" ") + 1)
        else:
            split()
            own = words_of(text)
            parts.append(pa.array([w.encode("utf-8", "surrogatepass") for w in own], pa.binary()))
            counts.append(len(own))
    split()
    return pa.concat_arrays(parts), counts


#: An edge: running sum of cond inside its node (the last above 1) and before the edge, its probability given its node,
#: the node behind it, its piece. What a draw needs of an edge lies together.
EDGE = np.dtype([("cum", "f8"), ("low", "f8"), ("cond", "f8"), ("to", "i4"), ("piece", "i4")])


class Lattice(NamedTuple):
    """Word lattices side by side. Edges are sorted by the node that they leave."""

    root: np.ndarray  # node where each word starts
    first: np.ndarray  # first edge of each node; one more at the end
    edge: np.ndarray
    paths: np.ndarray  # paths from each node to its word's end, up to MOST_PATHS
    final: np.ndarray  # True for nodes at a word's end

    @property
    def cond(self) -> np.ndarray:
        return self.edge["cond"]


def build(pieces: Pieces, words: list[str]) -> Lattice:
    """All lattices of some distinct words at once."""
    spelled = [pieces.spell(w) for w in words]
    length = np.array([len(s) for s in spelled], np.int64)
    stop = np.cumsum(length + 1)
    root = stop - length - 1
    total = int(stop[-1]) if len(words) else 0
    code = np.zeros(total, np.uint64)
    letters = np.ones(total, bool)
    letters[stop - 1] = False
    code[letters] = np.frombuffer("".join(spelled).encode("utf-32-le", "surrogatepass"), np.uint32)
    left = np.repeat(stop - 1, length + 1) - np.arange(total)  # letters from a node to its word's end
    at = np.flatnonzero(letters)
    h, degree = np.zeros(len(at), np.uint64), np.zeros(total, np.int64)
    rows = []
    for n, (keys, ids, _) in enumerate(pieces.tables):
        if not len(at):
            break
        inside = left[at] > n
        at, h = at[inside], h[inside]
        h = h * Pieces.BASE + code[at + n]
        slot = np.minimum(np.searchsorted(keys, h), len(keys) - 1)
        found = keys[slot] == h
        at, h, slot = at[found], h[found], slot[found]
        whole = ids[slot] >= 0
        own = at[whole]
        rows.append((own, degree[own], n + 1, slot[whole]))
        degree[own] += 1
    first = np.concatenate([[0], np.cumsum(degree)])
    start = np.repeat(np.arange(total), degree)
    to, piece, weight = (np.empty(len(start), kind) for kind in (np.int64, np.int32, float))
    for own, rank, n, slot in rows:
        place = first[own + 1] - 1 - rank  # longest first: the most probable, as a rule, so that draws find theirs soon
        to[place], piece[place], weight[place] = own + n, pieces.tables[n - 1][1][slot], pieces.tables[n - 1][2][slot]
    del rows
    back, paths = np.zeros(total), np.ones(total, np.int64)
    # Nodes by their distance from the word's end, nearest first (a radix sort while words are short).
    far = left[start]
    by_left = np.argsort(far.astype(np.uint16) if len(far) and far.max() < 1 << 16 else far, kind="stable")
    edge_left = left[start[by_left]]
    cuts = np.flatnonzero(np.concatenate([[True], edge_left[1:] != edge_left[:-1], [True]])) if len(start) else np.array([0])
    prob, mass = np.exp(weight), np.ones(total)
    for a, b in zip(cuts[:-1], cuts[1:]):
        edges = by_left[a:b]
        owner = start[edges]
        heads = np.flatnonzero(np.concatenate([[True], owner[1:] != owner[:-1]]))
        owner = owner[heads]
        if edge_left[a] <= NO_UNDERFLOW:
            mass[owner] = np.add.reduceat(prob[edges] * mass[to[edges]], heads)
            back[owner] = np.log(mass[owner])
        else:
            value = weight[edges] + back[to[edges]]
            top = np.maximum.reduceat(value, heads)
            back[owner] = top + np.log(np.add.reduceat(np.exp(value - np.repeat(top, np.diff(np.append(heads, len(value))))), heads))
        paths[owner] = np.minimum(np.add.reduceat(paths[to[edges]], heads), MOST_PATHS)
    cond = np.exp(weight + back[to] - back[start])
    run = np.cumsum(cond)
    cum = run - np.where(first[start] > 0, run[first[start] - 1], 0.0) if len(start) else run
    low = cum - cond
    if len(start):
        cum[np.append(np.flatnonzero(start[1:] != start[:-1]), len(start) - 1)] = 2.0
    edge = np.empty(len(start), EDGE)
    edge["cum"], edge["low"], edge["cond"], edge["to"], edge["piece"] = cum, low, cond, to, piece
    return Lattice(root, first.astype(np.int32), edge, paths.astype(np.int16), ~letters)


class Numbers(dict):
    """Numbers words as they come; ``new`` has those numbered since it was last emptied."""

    def __init__(self):
        self.new: list[bytes] = []

    def __missing__(self, word: bytes) -> int:
        self.new.append(word)
        self[word] = number = len(self)
        return number


def copy(to: np.ndarray, at: int, part: np.ndarray) -> None:
    """``to[at:]`` begins with ``part``; numpy copies records field by field, their bytes are copied at once."""
    size = part.dtype.itemsize
    to.view(np.uint8)[at * size : (at + len(part)) * size] = part.view(np.uint8)


class Words:
    """Lattices of the words seen lately, in arrays with room to grow."""

    def __init__(self, pieces: Pieces):
        self.pieces = pieces
        self.number, self.arrays, self.size = Numbers(), {}, {"words": 0, "nodes": 0, "edges": 0}
        self.uses = np.zeros(0, np.int32)  # calls that asked for each word
        self.add(build(pieces, []))

    @property
    def lattice(self) -> Lattice:
        return Lattice(*(self.arrays[name][: self.size[COUNTED[name]] + (name == "first")] for name in Lattice._fields))

    def add(self, more: Lattice) -> None:
        """Append lattices; node and edge numbers move behind those that are there."""
        shift = {"root": self.size["nodes"], "first": self.size["edges"]}
        for name, new in zip(Lattice._fields, more):
            at = self.size[COUNTED[name]]
            held = self.arrays.get(name)
            if held is None or len(held) < at + len(new):
                grown = np.empty(2 * (at + len(new)) + 1, new.dtype)
                if held is not None:
                    copy(grown, 0, held[:at])
                self.arrays[name] = held = grown
            copy(held, at, new + new.dtype.type(shift[name]) if name in shift else new)
            if name == "edge":
                held["to"][at : at + len(new)] += self.size["nodes"]
        for kind, n in (("words", len(more.root)), ("nodes", len(more.final)), ("edges", len(more.edge))):
            self.size[kind] += n

    def find(self, words: pa.Array) -> np.ndarray:
        """Root of each word's lattice; builds those that are missing."""
        if len(self.number) > MOST_WORDS:
            self.forget(MOST_WORDS // 4)
        distinct = words.dictionary_encode()
        own = distinct.dictionary.to_numpy(zero_copy_only=False).tolist()
        which = np.fromiter(map(self.number.__getitem__, own), np.int64, len(own))
        if self.number.new:
            new, self.number.new = self.number.new, []
            self.add(build(self.pieces, [w.decode("utf-8", "surrogatepass") for w in new]))
            self.uses = np.append(self.uses, np.zeros(len(new), np.int32))
        self.uses[which] += 1
        return self.lattice.root[which][distinct.indices.to_numpy()]

    def forget(self, most: int) -> None:
        """Keep the lattices of about ``most`` words, those that were asked for most often."""
        lat = self.lattice
        kept = np.sort(np.argsort(-self.uses, kind="stable")[:most])
        node = np.append(lat.root, len(lat.final))
        nodes = node[kept + 1] - node[kept]
        at = ranges(node[kept], nodes)
        edge = lat.first.astype(np.int64)[node]
        edges = edge[kept + 1] - edge[kept]
        own = lat.edge.take(ranges(edge[kept], edges))
        root, start = np.cumsum(nodes) - nodes, np.cumsum(edges) - edges
        own["to"] += np.repeat(root - node[kept], edges).astype(np.int32)
        first = lat.first[at] + np.repeat(start - edge[kept], nodes)
        less = Lattice(root, np.append(first, len(own)).astype(np.int32), own, lat.paths[at], lat.final[at])
        old, self.number = list(self.number), Numbers()
        self.number.update((old[k], i) for i, k in enumerate(kept.tolist()))
        self.uses, self.size = self.uses[kept] // 2, dict.fromkeys(self.size, 0)
        self.add(less)


def ranges(start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """start, start + 1, ... of each range, one range after another."""
    return np.arange(size.sum()) + np.repeat(start - (np.cumsum(size) - size), size)


#: What the entries of a lattice's arrays count.
COUNTED = {"root": "words", "first": "nodes", "edge": "edges", "paths": "nodes", "final": "nodes"}


def mix(x: np.ndarray) -> np.ndarray:
    """Finaliser of a 64-bit counter hash."""
    x = (x ^ (x >> U(30))) * U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U(27))) * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


def uniform(x: np.ndarray) -> np.ndarray:
    """In (0, 1)."""
    return ((mix(x) >> U(11)).astype(float) + 0.5) / (1 << 53)


class Draw(NamedTuple):
    """A drawn path of every word: edges, where each word's edges start (one more at the end), log-probabilities."""

    edges: np.ndarray
    offset: np.ndarray
    logp: np.ndarray


def draw(lat: Lattice, roots: np.ndarray, counter: np.ndarray) -> Draw:
    """One path from each root, by forward sampling with the noise of ``counter``."""
    node, who = roots, np.arange(len(roots))
    count = np.zeros(len(roots), np.int64)
    u, steps, step, cum = uniform(counter), [], 0, lat.edge["cum"]
    while True:
        ends = lat.final[node]
        if ends.any():
            count[who[ends]] = step
            go = np.flatnonzero(~ends)
            node, who, u = node[go], who[go], u[go]
        if not len(node):
            break
        if step and step % 6 == 0:
            u = uniform(counter[who] + U(step * GOLDEN % (1 << 64)))
        edge = lat.first[node].astype(np.intp)
        late = np.flatnonzero(u > cum[edge])
        while len(late):
            edge[late] += 1
            late = late[u[late] > cum[edge[late]]]
        taken = lat.edge.take(edge)
        p = np.ascontiguousarray(taken["cond"])
        u = np.clip((u - taken["low"]) / p, 1e-16, 1 - 1e-16)
        steps.append((who, edge, p))
        node, step = taken["to"].astype(np.intp), step + 1
    offset = np.concatenate([[0], np.cumsum(count)])
    out, probs = np.empty(offset[-1], np.int64), np.empty(offset[-1])
    for n, (who, edge, p) in enumerate(steps):
        place = offset[who] + n
        out[place], probs[place] = edge, p
    logs = np.add.reduceat(np.log(probs), offset[:-1]) if len(roots) else probs  # a word has an edge at least
    return Draw(out, offset, logs)


def mass(lat: Lattice, path: tuple) -> float:
    return math.prod(lat.cond[e] for e in path)


def draw_other(lat: Lattice, node: int, taken: list[tuple], rng: random.Random) -> tuple:
    """A path from ``node`` that is none of ``taken``, by the lattice's distribution without them."""
    out: list[int] = []
    while not lat.final[node]:
        low, high = int(lat.first[node]), int(lat.first[node + 1])
        edges, weights = range(low, high), lat.cond[low:high].tolist()
        for e in {t[0] for t in taken}:
            through = [t[1:] for t in taken if t[0] == e]
            free = lat.paths[lat.edge["to"][e]] > len(through)
            weights[e - low] = max(weights[e - low] * (1 - sum(mass(lat, t) for t in through)), 1e-300) if free else 0.0
        pick, total = 0, sum(weights)
        u = rng.random() * total
        while pick < len(weights) - 1 and u >= weights[pick]:
            u -= weights[pick]
            pick += 1
        while weights[pick] == 0.0:
            pick -= 1
        e = edges[pick]
        taken = [t[1:] for t in taken if t[0] == e]
        out.append(e)
        node = int(lat.edge["to"][e])
    return tuple(out)


def truncated(phi: float, bound: float, noise: float) -> float:
    """A Gumbel value at phi given that it lies below ``bound``; noise is Exp(1)."""
    x, y = -bound, math.log(noise) - phi
    top = max(x, y)
    return -(top + math.log(math.exp(x - top) + math.exp(y - top)))


class Sample(NamedTuple):
    value: float  # perturbed log-probability
    logp: float
    inclusion: float  # log-probability of being among the winners, given kappa
    ids: np.ndarray


class _Path(NamedTuple):
    """A winner: edges, word offsets, log-probability of each word."""

    edges: np.ndarray
    offset: np.ndarray
    logs: np.ndarray


def log_inclusion(phi: float, kappa: float) -> float:
    if kappa == -math.inf:
        return 0.0
    x = phi - kappa
    if x < -30:
        return x
    return math.log(-math.expm1(-math.exp(min(x, 700.0))))


def sample_texts(pieces: Pieces | Words, texts: list[str], seeds: list[int], k: int = K) -> list[list[Sample]]:
    """Up to k different segmentations of each text, in falling order of their perturbed values."""
    known = pieces if isinstance(pieces, Words) else Words(pieces)
    words, counts = words_of_all(texts)
    bounds = [0, *itertools.accumulate(counts)]
    roots = known.find(words)
    lat = known.lattice
    del words
    several = lat.paths[roots] > 1
    size = np.diff(bounds)
    seed = np.array([s % (1 << 64) for s in seeds], np.uint64)
    base = mix(np.repeat(seed, size)) + (np.arange(len(roots)) - np.repeat(bounds[:-1], size)).astype(np.uint64) * U(GOLDEN)
    value = -np.log(-np.log(uniform(seed ^ U(0x5851F42D4C957F2D)))) if len(texts) else np.empty(0)
    rngs = [random.Random(int(x)) for x in seed]
    tops: list[list[tuple[float, _Path]]] = [[] for _ in texts]
    # Queues of sets: (-bound, order, parent's place among the winners, word, taken paths of that word or None).
    # With None the set leaves the parent at that word or a later one.
    queues: list[list] = [[(-float(v), 0, -1, 0, None)] for v in value]
    for s in range(k):
        jobs = [pop(queue, tops[n], several[bounds[n] : bounds[n + 1]], rngs[n]) for n, queue in enumerate(queues)]
        # Words behind the one where a winner leaves its parent are drawn anew; those before it stay.
        behind = [bounds[n + 1] if job is None else bounds[n] if job[1] < 0 else bounds[n] + job[2] + 1 for n, job in enumerate(jobs)]
        place = np.concatenate([[0], np.cumsum(np.array(bounds[1:], np.int64) - behind)]) if texts else np.zeros(1, np.int64)
        which = np.arange(place[-1]) + np.repeat(np.array(behind, np.int64) - place[:-1], np.diff(place))
        fresh = draw(lat, roots[which], base[which] + U((s + 1) * 0xD1342543DE82EF95 % (1 << 64)))
        for n, (queue, job) in enumerate(zip(queues, jobs)):
            if job is None:
                continue
            a, b = bounds[n], bounds[n + 1]
            rng = rngs[n]
            top, parent, word, taken = job
            at, end = int(place[n]), int(place[n + 1])
            cut = fresh.offset[at]
            edges, offset, logs = fresh.edges[cut : fresh.offset[end]], fresh.offset[at : end + 1] - cut, fresh.logp[at:end]
            lo = 0
            if parent >= 0:
                before = tops[n][parent][1]
                other = draw_other(lat, int(roots[a + word]), taken, rng)
                head = before.edges[: before.offset[word]]
                edges = np.concatenate([head, np.array(other, np.int64), edges])
                offset = np.concatenate([before.offset[: word + 1], offset + len(head) + len(other)])
                logs = np.concatenate([before.logs[:word], [math.log(max(mass(lat, other), 1e-300))], logs])
                lo = word + 1
                if lat.paths[roots[a + word]] > len(taken) + 1:
                    left = max(1 - sum(mass(lat, t) for t in [*taken, other]), 1e-300)
                    again = truncated(logs[:word].sum() + math.log(left), top, rng.expovariate(1.0))
                    push(queue, again, parent, word, [*taken, other])
            tops[n].append((top, _Path(edges, offset, logs)))
            # Behind the last winner only the greatest bound counts: all its sets wait as one.
            leave(queue, tops[n], len(tops[n]) - 1, lo, top, several[a:b], rng, near=NEAR if s < k - 1 else 0)
    out, piece = [], lat.edge["piece"]
    for queue, winners in zip(queues, tops):
        kappa = -queue[0][0] if queue and len(winners) == k else -math.inf
        row = []
        for top, path in winners:
            phi = float(path.logs.sum())
            row.append(Sample(top, phi, log_inclusion(phi, kappa), piece[path.edges]))
        out.append(row)
    return out


def push(queue: list, bound: float, parent: int, word: int, taken: list | None) -> None:
    heapq.heappush(queue, (-float(bound), len(queue), parent, word, taken))


def leave(queue: list, winners: list, me: int, lo: int, top: float, several: np.ndarray, rng: random.Random, best: bool = False, near: int = NEAR) -> None:
    """Queue the sets that leave winner ``me`` at word ``lo`` or later, all bounded by ``top``.

    A set's mass is the path's probability before the word, times that of any
    other path there. The nearest words get a set each, the others share one,
    from where the path's probability has fallen by exp(-FAR) at the latest.
    With ``best`` one set, drawn by mass, has exactly ``top``, as a set that is
    split hands its bound on.
    """
    path = winners[me][1]
    near = min(len(path.logs) - lo, near)
    prefix, sets = float(path.logs[:lo].sum()), []
    far = prefix - FAR
    for word, (log, many) in enumerate(zip(path.logs[lo : lo + near].tolist(), several[lo : lo + near].tolist()), lo):
        if many:
            sets.append((prefix + math.log(max(-math.expm1(log), 1e-300)), word))
        prefix += log
        if prefix < far:
            near = word + 1 - lo
            break
    if len(path.logs) > lo + near and several[lo + near :].any():
        sets.append((prefix + math.log(max(-math.expm1(float(path.logs[lo + near :].sum())), 1e-300)), -1))
    pick = rng.choices(range(len(sets)), [math.exp(max(phi - sets[0][0], -700.0)) for phi, _ in sets])[0] if best and sets else -1
    for i, (phi, word) in enumerate(sets):
        bound = top if i == pick else truncated(phi, top, rng.expovariate(1.0))
        if word < 0:
            push(queue, bound, me, lo + near, None)
        else:
            push(queue, bound, me, word, [tuple(path.edges[path.offset[word] : path.offset[word + 1]].tolist())])


def pop(queue: list, winners: list, several: np.ndarray, rng: random.Random) -> tuple | None:
    """The next set to draw a winner from: bound, parent, word, taken paths. Shared sets are split on the way."""
    while queue:
        negative, _, parent, word, taken = heapq.heappop(queue)
        if parent < 0 or taken is not None:
            return -negative, parent, word, taken
        leave(queue, winners, parent, word, -negative, several, rng, best=True)
    return None


# ---- operators ---------------------------------------------------------------------------------------


def _rows(docs: DataFrame, key: str, text: str, seed: int) -> DataFrame:
    return docs.select(F.col(key), text_of(text).alias("_text"), F.xxhash64(F.col(key), F.lit(seed)).alias("_seed"))


def sample_segmentations(docs: DataFrame, model: str, key: str = "doc_id", text: str = "text", k: int = K, alpha: float = ALPHA, seed: int = SEED) -> DataFrame:
    """key, rank, ids (array), log_prob, perturbed, log_inclusion: up to k rows for each row.

    ``model`` names the vocabulary file on the executors.
    """
    return _sampled(docs, model, key, text, k, alpha, seed, "ids array<int>", lambda _, ids: {"ids": [i.tolist() for i in ids]})


def sample_digests(docs: DataFrame, model: str, key: str = "doc_id", text: str = "text", k: int = K, alpha: float = ALPHA, seed: int = SEED) -> DataFrame:
    """As ``sample_segmentations`` with the number and unsigned crc32 of the ids (little-endian, 32 bits) and the hex
    SHA-256 of the text that they decode to instead of them."""
    return _sampled(docs, model, key, text, k, alpha, seed, "n_ids bigint, ids_crc32 bigint, text_sha256 string", digests)


def digests(pieces: Pieces, ids: list[np.ndarray]) -> dict[str, list]:
    return {"n_ids": [len(i) for i in ids], "ids_crc32": [zlib.crc32(i) for i in ids], "text_sha256": [hashlib.sha256(t).hexdigest() for t in pieces.decode_all(ids)]}


def _sampled(docs, model, key, text, k, alpha, seed, fields, view) -> DataFrame:
    if not 0 < k < MOST_PATHS:
        raise ValueError(f"k is between 1 and {MOST_PATHS - 1}")
    kind = docs.schema[key].dataType.simpleString()

    def run(keys, texts, seeds):
        pieces = per_process(("lattice_words", model, alpha), lambda: Words(Pieces(model, alpha)))
        rows = [(own, rank, s) for own, samples in zip(keys, sample_texts(pieces, texts, seeds, k)) for rank, s in enumerate(samples, 1)]
        own, ranks, samples = zip(*rows) if rows else ((), (), ())
        scores = {"log_prob": [s.logp for s in samples], "perturbed": [s.value for s in samples], "log_inclusion": [s.inclusion for s in samples]}
        return {key: own, "rank": ranks, **view(pieces.pieces, [s.ids for s in samples]), **scores}

    schema = f"`{key}` {kind}, rank int, {fields}, log_prob double, perturbed double, log_inclusion double"
    return map_texts(_rows(docs, key, text, seed), schema, run, most=SLICE)


def decode(rows: DataFrame, model: str, key: str = "doc_id", ids: str = "ids") -> DataFrame:
    """key, text of each row's ids."""
    kind = rows.schema[key].dataType.simpleString()

    def run(keys, sequences):
        pieces = per_process(("pieces", model), lambda: Pieces(model))
        return {key: keys, "text": [None if s is None else pieces.decode(s).decode("utf-8", "replace") for s in sequences]}

    from pyspark.sql import types as T
    from pyspark.sql.pandas.types import to_arrow_schema

    arrow = to_arrow_schema(T.StructType.fromDDL(f"`{key}` {kind}, text string"))

    def each(batches):
        for batch in batches:
            out = run(batch.column(0).to_pylist(), batch.column(1).to_pylist())
            yield pa.RecordBatch.from_arrays([pa.array(out[f.name], type=f.type) for f in arrow], schema=arrow)

    return rows.select(key, ids).mapInArrow(each, f"`{key}` {kind}, text string")
