"""Personal data: base patterns plus a character BiLSTM with CRF transitions.

Base spans come from four linear-time scanners (email, ip, card, phone). A
bidirectional LSTM over characters, trained here in numpy from labelled spans,
scores a tag for each character; CRF transitions tie the tags together. The
model adds spans that the patterns miss, such as a phone number that runs into
another number or an address with spaced signs; base spans always stay.

Windows of WINDOW characters overlap by half. Every character's emission is
the mean over its windows, weighted by how central it lies, and one Viterbi
pass over all touching windows of a text reconciles them. A legal span holds a
digit, an at sign or a sign in words like ``(at)``; windows without any cannot
hold one, so they have only the outside path and are not run. Each model span must then pass the check of
its kind (length, Luhn, number ranges) and may not overlap a base span.

A null text is empty and has no spans. Keys may be null or repeat; each row is
judged by itself. Texts may be of any length: all scanners are linear.
Offsets are code points, ends exclusive.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Sequence
from typing import NamedTuple

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from waypost.llm.common import map_texts, text_of

KINDS = ["email", "ip", "card", "phone"]
WINDOW, STRIDE = 64, 32
#: Labelled windows from the corpus and generated windows that the model is fitted on, at most.
TRAIN_WINDOWS, MADE_WINDOWS = 400, 1_200
#: Spans of each kind in a text that give excerpts, at most.
PER_KIND = 4

# ---- base patterns -----------------------------------------------------------------------------

_LOCAL = re.compile(r"[A-Za-z0-9._%+-]")
_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
_DOTTED = re.compile(r"[0-9]++(?:\.[0-9]++)*+")
_CARD = re.compile(r"[0-9](?:[\x20-]?+[0-9])++")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
#: What every legal span holds one of; an address may write its signs in words.
_HINT = re.compile(r"[0-9@]|[(\[](?:at|dot)[)\]]")


#: An address whose signs may be spaced or in words; it starts where its local part does, so that a search is linear.
_ADDRESS = re.compile(r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]+ ?(?:@|[(\[]at[)\]]) ?[A-Za-z0-9-]+(?: ?(?:\.|[(\[]dot[)\]]) ?[A-Za-z0-9-]+)+")


class Span(NamedTuple):
    kind: str
    start: int
    end: int


def digits_of(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        if i % 2:
            d = d * 2 - 9 if d > 4 else d * 2
        total += d
    return total % 10 == 0


def small(part: str) -> bool:
    return len(part.lstrip("0")) <= 3 and int(part.lstrip("0") or "0") <= 255


def base_spans(text: str) -> list[Span]:
    """Leftmost non-overlapping matches per kind that pass the kind's check; linear in the text."""
    if not _HINT.search(text):
        return []
    out: list[Span] = []
    done, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and _LOCAL.match(text[start - 1]):
            start -= 1
        found = _DOMAIN.match(text, at + 1) if start < at else None
        if found:
            out.append(Span("email", start, found.end()))
        done = found.end() if found else at + 1
        at = text.find("@", done)
    for m in _DOTTED.finditer(text):
        if "." not in m[0]:
            continue
        parts, at = m[0].split("."), m.start()
        for k in range(0, len(parts) - 3, 4):
            four = parts[k : k + 4]
            size = sum(map(len, four)) + 3
            if all(map(small, four)):
                out.append(Span("ip", at, at + size))
            at += size + 1
    for m in _CARD.finditer(text):
        if 16 <= m.end() - m.start() <= 40 and 16 <= len(d := digits_of(m[0])) <= 19 and luhn(d):
            out.append(Span("card", *m.span()))
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 8 <= len(digits_of(m[0])) <= 15:
                out.append(Span("phone", *m.span()))
    return out


def legal(kind: str, piece: str) -> bool:
    """The check that a model's span must pass."""
    digits = digits_of(piece)
    if kind == "card":
        return 16 <= len(digits) <= 19 and luhn(digits) and not re.search(r"[^0-9 .-]", piece)
    if kind == "phone":
        return 8 <= len(digits) <= 15 and not re.search(r"[^0-9 ().+-]", piece) and ("(" in piece or "+" in piece) and piece[0] in "+("
    if kind == "ip":
        parts = re.findall(r"[0-9]+", piece)
        return len(parts) == 4 and all(map(small, parts)) and not re.search(r"[^0-9.\[\]]", piece) and piece[0].isdigit() and piece[-1].isdigit()
    return bool(_ADDRESS.fullmatch(piece))


# ---- model ---------------------------------------------------------------------------------------

TAGS = ["O"] + [f"{p}-{k}" for k in KINDS for p in "BI"]
#: Character classes: 0 other letter, 1 other sign, then space characters and the printable ASCII range.
CLASSES, HIDDEN = 98, 12


def classes(text: str) -> np.ndarray:
    code = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    out = np.where(code >= 160, 0, 1).astype(np.int64)
    out[(code == 10) | (code == 9) | (code == 13)] = 2
    ascii_ = (code >= 32) & (code < 127)
    out[ascii_] = code[ascii_] - 29
    return out


def forbidden() -> np.ndarray:
    """True where tag b may not follow tag a; the last row is for the start."""
    n = len(TAGS)
    out = np.zeros((n + 1, n), bool)
    for b in range(2, n, 2):  # I-x follows B-x or I-x only
        out[:, b] = True
        out[b - 1, b] = out[b, b] = False
    return out


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * (1 + np.tanh(0.5 * x))


def logsumexp(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis=axis, keepdims=True)
    return (top + np.log(np.exp(x - top).sum(axis=axis, keepdims=True))).squeeze(axis)


class Tagger:
    """Parameters: per direction input rows (class to 4 gates) and recurrence, output layer, transitions."""

    def __init__(self, seed: int = 5):
        rng = np.random.default_rng(seed)
        h, n = HIDDEN, len(TAGS)
        self.p = {
            "xf": rng.normal(0, 0.3, (CLASSES, 4 * h)), "xb": rng.normal(0, 0.3, (CLASSES, 4 * h)),
            "hf": rng.normal(0, 0.3, (h, 4 * h)), "hb": rng.normal(0, 0.3, (h, 4 * h)),
            "out": rng.normal(0, 0.3, (2 * h, n)), "bias": np.zeros(n), "move": np.zeros((n + 1, n)),
        }
        for k in ("xf", "xb"):
            self.p[k][:, h : 2 * h] += 1.0  # forget gates open at first
        self.stop = np.where(forbidden(), -1e4, 0.0)

    def lstm(self, x: np.ndarray, way: str, keep: bool = False):
        """x: (windows, steps) of classes. Hidden states (steps, windows, h) in text order."""
        h, (n, steps) = HIDDEN, x.shape
        order = range(steps) if way == "f" else range(steps - 1, -1, -1)
        state, cell = np.zeros((n, h)), np.zeros((n, h))
        out, kept = np.zeros((steps, n, h)), {}
        for t in order:
            gates = self.p["x" + way][x[:, t]] + state @ self.p["h" + way]
            i, f, o = sigmoid(gates[:, :h]), sigmoid(gates[:, h : 2 * h]), sigmoid(gates[:, 2 * h : 3 * h])
            g = np.tanh(gates[:, 3 * h :])
            before, last = cell, state
            cell = f * before + i * g
            squashed = np.tanh(cell)
            state = o * squashed
            out[t] = state
            if keep:
                kept[t] = (i, f, o, g, before, last, squashed)
        return out, kept

    def emissions(self, x: np.ndarray) -> np.ndarray:
        """(steps, windows, tags)"""
        both = np.concatenate([self.lstm(x, "f")[0], self.lstm(x, "b")[0]], axis=2)
        return both @ self.p["out"] + self.p["bias"]

    def lstm_back(self, x: np.ndarray, way: str, kept: dict, dout: np.ndarray, grads: dict) -> None:
        h, (n, steps) = HIDDEN, x.shape
        order = range(steps - 1, -1, -1) if way == "f" else range(steps)
        dstate, dcell = np.zeros((n, h)), np.zeros((n, h))
        for t in order:
            i, f, o, g, before, last, squashed = kept[t]
            ds = dout[t] + dstate
            dc = dcell + ds * o * (1 - squashed**2)
            dg = np.concatenate([dc * g * i * (1 - i), dc * before * f * (1 - f), ds * squashed * o * (1 - o), dc * i * (1 - g**2)], axis=1)
            np.add.at(grads["x" + way], x[:, t], dg)
            grads["h" + way] += last.T @ dg
            dstate, dcell = dg @ self.p["h" + way].T, dc * f

    def loss_and_grads(self, x: np.ndarray, y: np.ndarray) -> tuple[float, dict]:
        """Mean negative log-likelihood of the tag paths y under the CRF, and its gradients."""
        n, steps = x.shape
        hf, kf = self.lstm(x, "f", True)
        hb, kb = self.lstm(x, "b", True)
        both = np.concatenate([hf, hb], axis=2)
        e = both @ self.p["out"] + self.p["bias"]
        move = self.p["move"] + self.stop
        alpha = np.empty_like(e)
        alpha[0] = e[0] + move[-1]
        for t in range(1, steps):
            alpha[t] = e[t] + logsumexp(alpha[t - 1][:, :, None] + move[None, :-1], 1)
        beta = np.zeros_like(e)
        for t in range(steps - 2, -1, -1):
            beta[t] = logsumexp(move[None, :-1] + (e[t + 1] + beta[t + 1])[:, None, :], 2)
        total = logsumexp(alpha[-1], 1)
        rows = np.arange(n)
        gold = e[0, rows, y[:, 0]] + move[-1][y[:, 0]]
        de = np.exp(alpha + beta - total[None, :, None])
        dmove = np.zeros_like(move)
        dmove[-1] = de[0].sum(0)
        np.add.at(dmove[-1], y[:, 0], -1)
        for t in range(1, steps):
            gold += e[t, rows, y[:, t]] + move[y[:, t - 1], y[:, t]]
            pair = np.exp(alpha[t - 1][:, :, None] + move[None, :-1] + (e[t] + beta[t])[:, None, :] - total[:, None, None])
            dmove[:-1] += pair.sum(0)
            np.add.at(dmove, (y[:, t - 1], y[:, t]), -1)
        for t in range(steps):
            de[t, rows, y[:, t]] -= 1
        de /= n
        grads = {k: np.zeros_like(v) for k, v in self.p.items()}
        grads["move"] = np.where(self.stop < 0, 0.0, dmove / n)
        grads["bias"] = de.sum((0, 1))
        grads["out"] = np.tensordot(both, de, ([0, 1], [0, 1]))
        dboth = de @ self.p["out"].T
        self.lstm_back(x, "f", kf, dboth[:, :, :HIDDEN], grads)
        self.lstm_back(x, "b", kb, dboth[:, :, HIDDEN:], grads)
        return float((total - gold).mean()), grads

    def fit(self, x: np.ndarray, y: np.ndarray, steps: int = 260, batch: int = 48, rate: float = 0.02, seed: int = 9) -> float:
        """Adam; the mean loss of the last 20 batches."""
        rng = np.random.default_rng(seed)
        m, v = ({k: np.zeros_like(p) for k, p in self.p.items()} for _ in range(2))
        losses = []
        for step in range(1, steps + 1):
            pick = rng.integers(0, len(x), batch)
            loss, grads = self.loss_and_grads(x[pick], y[pick])
            losses.append(loss)
            norm = np.sqrt(sum(float((g**2).sum()) for g in grads.values()))
            for k, g in grads.items():
                g = g * min(1.0, 5.0 / max(norm, 1e-9))
                m[k] = 0.9 * m[k] + 0.1 * g
                v[k] = 0.99 * v[k] + 0.01 * g * g
                self.p[k] -= rate * (1 - 0.9 * step / steps) * (m[k] / (1 - 0.9**step)) / (np.sqrt(v[k] / (1 - 0.99**step)) + 1e-8)
        return float(np.mean(losses[-20:]))

    def viterbi(self, e: np.ndarray) -> np.ndarray:
        """Best legal tag path of one sequence of emissions (steps, tags)."""
        move = self.p["move"] + self.stop
        score, back = e[0] + move[-1], np.empty(e.shape, np.int64)
        for t in range(1, len(e)):
            step = score[:, None] + move[:-1]
            back[t] = step.argmax(0)
            score = step.max(0) + e[t]
        path = np.empty(len(e), np.int64)
        path[-1] = score.argmax()
        for t in range(len(e) - 1, 0, -1):
            path[t - 1] = back[t, path[t]]
        return path


#: How much a window's emission counts by the place of the character in the window.
WEIGHT = 1.0 + np.minimum(np.arange(WINDOW), np.arange(WINDOW)[::-1])


def active_windows(text: str) -> list[int]:
    """Starts of the windows that hold a digit, an at sign or a sign in words, of the latter with a stride more to both sides; windows overlap by half."""
    last = max(0, -(-(len(text) - WINDOW) // STRIDE))
    out: list[int] = []
    for m in _HINT.finditer(text):
        more = STRIDE if len(m[0]) > 1 else 0  # the words around it need not hold a hint
        for k in range(max(0, (m.start() - more - WINDOW) // STRIDE + 1), min(last, (m.end() - 1 + more) // STRIDE) + 1):
            if not out or k > out[-1]:
                out.append(k)
    return [k * STRIDE for k in out]


def paths(model: Tagger, texts: Sequence[str]) -> list[list[Span]]:
    """The model's legal spans of each text."""
    at = [(n, s) for n, text in enumerate(texts) for s in active_windows(text)]
    found: list[list[Span]] = [[] for _ in texts]
    group: list[tuple[int, int, np.ndarray]] = []

    def settle() -> None:
        """Reconcile the touching windows in ``group`` by one Viterbi pass."""
        if not group:
            return
        n, first, end = group[0][0], group[0][1], group[-1][1] + WINDOW
        text = texts[n][first:end]
        total, weight = np.zeros((end - first, len(TAGS))), np.zeros((end - first, 1))
        for _, s, e in group:
            total[s - first : s - first + WINDOW] += e * WEIGHT[:, None]
            weight[s - first : s - first + WINDOW] += WEIGHT[:, None]
        tags = model.viterbi((total / weight)[: len(text)])
        t = 0
        while t < len(tags):
            if tags[t] % 2 == 1:
                k = t + 1
                while k < len(tags) and tags[k] == tags[t] + 1:
                    k += 1
                kind = KINDS[(tags[t] - 1) // 2]
                while k > t and text[k - 1] in " .\n":
                    k -= 1
                if k > t and legal(kind, text[t:k]):
                    found[n].append(Span(kind, first + t, first + k))
                elif kind == "email":  # a word before or after the address came along
                    found[n] += [Span(kind, first + m.start(), first + m.end()) for m in _ADDRESS.finditer(text, t, k)]
                t = max(k, t + 1)
            else:
                t += 1
        group.clear()

    for cut in range(0, len(at), 512):
        part = at[cut : cut + 512]
        x = np.full((len(part), WINDOW), 2)
        for i, (n, s) in enumerate(part):
            codes = classes(texts[n][s : s + WINDOW])
            x[i, : len(codes)] = codes
        e = model.emissions(x)
        for i, (n, s) in enumerate(part):
            if group and (group[-1][0] != n or s - group[-1][1] >= WINDOW):
                settle()
            group.append((n, s, e[:, i]))
    settle()
    return found


def all_spans(model: Tagger, texts: Sequence[str]) -> list[tuple[list[Span], list[Span]]]:
    """For each text its base spans and all spans, by kind and start."""
    rank = {k: i for i, k in enumerate(KINDS)}
    out = []
    for text, extra in zip(texts, paths(model, texts)):
        base = base_spans(text)
        more = [s for s in extra if not any(s.start < b.end and b.start < s.end for b in base)] if extra else []
        out.append((base, sorted(base + more, key=lambda s: (rank[s.kind], s.start))))
    return out


# ---- training ------------------------------------------------------------------------------------


def made_example(rng: np.random.Generator, context: str) -> tuple[str, list[Span]]:
    """A text with one or two drawn items, some in forms that the patterns miss, and its labels."""
    pick, number = (lambda *x: x[rng.integers(len(x))]), (lambda lo, hi: str(rng.integers(lo, hi)))
    letters = lambda lo, hi: "".join(chr(97 + c) for c in rng.integers(0, 26, rng.integers(lo, hi)))

    def item() -> tuple[str | None, str]:
        kind = pick("email", "ip", "card", "phone", "phone", None)
        if kind == "email":
            at, dot = pick(("@", "."), ("@", "."), ("@", "."), (" @ ", "."), (" (at) ", "."), (" (at) ", " (dot) "), (" [at] ", " [dot] "), ("(at)", "(dot)"), ("[at]", "."))
            local = f"{letters(2, 9)}{pick('.', '', '_')}{pick(number(1, 99), letters(2, 9))}"
            return kind, local + at + dot.join([letters(3, 8) + pick("", "", number(1, 9)), *pick((), ("example",), (letters(3, 8),)), pick("com", "org", "net")])
        if kind == "ip":
            dot = pick(".", ".", "[.]")
            return kind, dot.join(number(0, 256) for _ in range(4))
        if kind == "card":
            body = "4" + "".join(number(0, 10) for _ in range(14))
            full = next(body + str(c) for c in range(10) if luhn(body + str(c)))
            sep = pick("", "", " ", "-", ".")
            return kind, sep.join(full[i : i + 4] for i in range(0, 16, 4))
        if kind == "phone":
            return kind, pick(f"+1 ({number(200, 999)}) 555-{number(1000, 9999)}", f"+1 ({number(200, 999)}) 555-{number(1000, 9999)}", f"({number(200, 999)}) 555-{number(1000, 9999)}", f"+{number(20, 99)} {number(100, 999)} {number(1000, 9999)} {number(10, 99)}")
        return None, pick(number(1, 2100), "".join(pick(*"0123456789abcdef") for _ in range(32)), f"{number(0, 30)}.{number(0, 99)}", f"v{number(1, 9)}.{number(0, 9)}.{number(0, 9)}", f"\"{letters(3, 9)}{number(0, 999)}\"")

    text, spans = context[: rng.integers(0, 24)], []
    for _ in range(rng.integers(1, 3)):
        kind, piece = item()
        text += pick(" ", "\n", " ", ", ") if text else ""
        if kind:
            spans.append(Span(kind, len(text), len(text) + len(piece)))
        text += piece
    return text + pick(" ", ".", ",", "###", "\n", " ") + context[24:], spans


def window_of(text: str, spans: Sequence[Span], start: int) -> tuple[np.ndarray, np.ndarray]:
    """Classes and tags of one window; spans cut by its edges keep their tags inside."""
    x, y = np.full(WINDOW, 2), np.zeros(WINDOW, np.int64)
    codes = classes(text[start : start + WINDOW])
    x[: len(codes)] = codes
    for s in spans:
        b = 1 + 2 * KINDS.index(s.kind)
        lo, hi = max(s.start - start, 0), min(s.end - start, WINDOW)
        if lo < hi:
            y[lo:hi] = b + 1
            y[lo] = b
    return x, y


def fit(examples: Sequence[tuple[str, Sequence[Span]]], made: int = MADE_WINDOWS, seed: int = 3) -> Tagger:
    """Train on labelled texts plus ``made`` generated ones that borrow their contexts."""
    rng = np.random.default_rng(seed)
    contexts = [_HINT.sub(" ", text) for text, _ in examples] or ["and the line of it with on to "]
    pairs = []
    for text, spans in examples:
        pairs += [window_of(text, spans, max(0, s.start - int(rng.integers(0, WINDOW - 8)))) for s in spans] or [window_of(text, spans, 0)]
    for _ in range(made):
        text, spans = made_example(rng, contexts[rng.integers(len(contexts))][:80])
        pairs.append(window_of(text, spans, int(rng.integers(0, max(1, min(24, len(text) - 40))))))
    model = Tagger()
    model.fit(np.array([x for x, _ in pairs]), np.array([y for _, y in pairs]))
    return model


def labelled_windows(docs: DataFrame, text: str = "text", most: int = TRAIN_WINDOWS) -> list[tuple[str, list[Span]]]:
    """At most ``most`` different excerpts around base spans, chosen by hash over all rows, with their spans.

    A text gives at most PER_KIND excerpts of each kind, around its first spans of that kind."""

    def cut(texts):
        rows: list[str] = []
        for t in texts:
            spans = base_spans(t)
            for kind in KINDS:
                for s in [s for s in spans if s.kind == kind][:PER_KIND]:
                    rows.append(t[max(0, s.start - 40) : s.end + 40])
        return {"excerpt": rows}

    part = docs.select(text_of(text).alias("text")).where(F.col("text").rlike("[0-9@]"))
    rows = map_texts(part, "excerpt string", cut, text=0).distinct().orderBy(F.xxhash64("excerpt"), "excerpt").limit(most).collect()
    return [(r.excerpt, base_spans(r.excerpt)) for r in rows]


# ---- operators -------------------------------------------------------------------------------------


def joined(spans: Sequence[Span]) -> str:
    return ",".join(f"{s.kind}:{s.start}:{s.end}" for s in spans)


def find(docs: DataFrame, model: Tagger, key: str = "doc_id", text: str = "text") -> DataFrame:
    """key, spans (array of kind, start, end, base) per row, by kind and start."""
    kind = docs.schema[key].dataType.simpleString()

    def run(keys, texts):
        rows = []
        for base, every in all_spans(model, texts):
            own = set(base)
            rows.append([{"kind": s.kind, "start": s.start, "end": s.end, "base": s in own} for s in every])
        return {key: keys, "spans": rows}

    schema = f"`{key}` {kind}, spans array<struct<kind:string,start:bigint,end:bigint,base:boolean>>"
    return map_texts(docs.select(F.col(key), text_of(text).alias("_text")), schema, run)


def digest(docs: DataFrame, model: Tagger, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Counts of the base spans by kind, their hash, all spans as text, and the number that the model added."""
    kind = docs.schema[key].dataType.simpleString()

    def run(keys, texts):
        out: dict[str, list] = {key: keys, **{f"n_{k}": [] for k in KINDS}, "base_sha256": [], "spans": [], "n_added": []}
        for base, every in all_spans(model, texts):
            for k in KINDS:
                out[f"n_{k}"].append(sum(s.kind == k for s in base))
            rank = sorted(base, key=lambda s: (KINDS.index(s.kind), s.start))
            out["base_sha256"].append(hashlib.sha256(joined(rank).encode()).hexdigest())
            out["spans"].append(joined(every))
            out["n_added"].append(len(every) - len(base))
        return out

    schema = f"`{key}` {kind}, " + ", ".join(f"n_{k} bigint" for k in KINDS) + ", base_sha256 string, spans string, n_added bigint"
    return map_texts(docs.select(F.col(key), text_of(text).alias("_text")), schema, run)


def mask(text: str, spans: Sequence[Span]) -> str:
    """Each span replaced by its kind in brackets; overlapping spans merge under the first one's kind."""
    out, at = [], 0
    for s in sorted(spans, key=lambda s: (s.start, -s.end)):
        if s.start >= at:
            out += [text[at : s.start], f"[{s.kind.upper()}]"]
        at = max(at, s.end)
    return "".join(out) + text[at:]


def redact(docs: DataFrame, model: Tagger, text: str = "text") -> DataFrame:
    """``docs`` with every span of its text masked; rows and other columns stay. A null text stays null."""
    import pyarrow as pa

    at = docs.columns.index(text)

    def run(batches):
        for batch in batches:
            texts = batch.column(at).to_pylist()
            hit = [i for i, t in enumerate(texts) if t and _HINT.search(t)]
            for lo in range(0, len(hit), 256):
                part = hit[lo : lo + 256]
                for i, (_, every) in zip(part, all_spans(model, [texts[i] for i in part])):
                    if every:
                        texts[i] = mask(texts[i], every)
            yield batch.set_column(at, batch.schema.field(at), pa.array(texts, batch.schema.field(at).type))

    return docs.mapInArrow(run, docs.schema)
