"""Cross-entropy difference of matched n-gram models.

Two character n-gram models, one of a target corpus and one of the background
(all documents), share one vocabulary: the characters of the background and an
unknown. Both are interpolated alike: at each order the estimate is
(count + STRENGTH * shorter estimate) / (context count + STRENGTH), down to a
uniform one over the vocabulary. A token's loss difference is its target loss
minus its background loss, in nats; a document's score is the mean over its
characters, so that lower means closer to the target.

All counts cover all rows. Documents are dealt to parts of about PART_BYTES of
text by a hash; a part sends each of its distinct n-grams once, with its
counts. From the totals every n-gram gets its loss difference, and each part
gets back the n-grams that it sent, never the whole model, so that a model of
any size can be used and no task holds more than one part.

N-grams are ORDER characters, with start marks before a text, packed into two
64-bit numbers at 21 bits a character. A null or
empty text has no tokens: its score is null and its losses 0. Rows that repeat
or lack a key are scored each; a row without a key is never a target. An empty
table gives an empty result; without target rows the target model is uniform.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from waypost.llm.common import text_of
from waypost.session import materialize

#: Characters in an n-gram, weight of the shorter estimate, bytes of text in a part.
ORDER, STRENGTH, PART_BYTES = 5, 8.0, 16 << 20
#: Characters that are counted or scored at once, distinct n-grams of such pieces held before they are merged.
PIECE, MERGE_ROWS = 1 << 20, 4 << 20
START = 0x110000  # one above the last code point


def codes(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)


def joined(texts: list[str], order: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Code points of some texts, each after order - 1 start marks, and the text number of each; cut in pieces."""
    mark = np.full(order - 1, START, np.uint64)
    held, owner, size = [], [], 0
    for n, text in enumerate(texts):
        whole = codes(text)
        for at in range(0, len(whole), PIECE):
            before = mark if at == 0 else whole[at - order + 1 : at] if at >= order - 1 else np.concatenate([mark, whole[:at]])[-(order - 1) :]
            part = np.concatenate([before, whole[at : at + PIECE]])
            held.append(part)
            owner.append(np.full(len(part), n))
            owner[-1][: order - 1] = -1
            size += len(part)
            if size >= PIECE:
                yield np.concatenate(held), np.concatenate(owner)
                held, owner, size = [], [], 0
    if held:
        yield np.concatenate(held), np.concatenate(owner)


def grams(points: np.ndarray, owner: np.ndarray, order: int) -> tuple[np.ndarray, np.ndarray]:
    """(rows, order) packed as one 128-bit key split in two 64-bit words, and the owner of each token."""
    n = len(points) - order + 1
    if n <= 0:
        return np.empty((0, 2), np.uint64), np.empty(0, np.int64)
    keep = np.flatnonzero(owner[order - 1 :] >= 0)
    high, low = np.zeros(len(keep), np.uint64), np.zeros(len(keep), np.uint64)
    for k in range(order):
        value = points[keep + k]
        if k < order - 3:
            high = (high << np.uint64(21)) | value
        else:
            low = (low << np.uint64(21)) | value
    return np.stack([high, low], axis=1), owner[order - 1 :][keep]


def dense(pairs: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each packed n-gram."""
    x = pairs[:, 0] * np.uint64(0x9E3779B97F4A7C15)
    x ^= x >> np.uint64(29)
    x = (x + pairs[:, 1]) * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(32)
    x *= np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(29))


COUNT_SCHEMA = "part bigint, hi bigint, lo bigint, target bigint, every bigint"


def merged(tables: list[tuple]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Tables of packed n-grams and two counts, added up by n-gram."""
    if not tables:
        return np.empty((0, 2), np.uint64), np.empty(0, np.int64), np.empty(0, np.int64)
    pairs, target, every = (np.concatenate([t[k] for t in tables]) for k in range(3))
    order = np.lexsort((pairs[:, 1], pairs[:, 0]))
    pairs = pairs[order]
    first = np.flatnonzero(np.concatenate([[True], (pairs[1:] != pairs[:-1]).any(axis=1)])) if len(pairs) else np.empty(0, np.int64)
    if not len(first):
        return pairs, target, every
    return pairs[first], np.add.reduceat(target[order], first), np.add.reduceat(every[order], first)


def count_parts(docs: DataFrame, targets: DataFrame, order: int) -> DataFrame:
    """part, n-gram (hi, lo), target count, count: one row per part and distinct n-gram."""

    def run(key, rows: pd.DataFrame, wanted: pd.DataFrame) -> pd.DataFrame:
        chosen = set(wanted["key"].tolist())
        is_target = np.array([k is not None and k == k and k in chosen for k in rows["key"]], bool)
        held: list[tuple] = []
        for points, owner in joined(rows["text"].tolist(), order):
            pairs, own = grams(points, owner, order)
            if not len(pairs):
                continue
            hashed, index, inverse = np.unique(dense(pairs), return_index=True, return_inverse=True)
            every = np.bincount(inverse, minlength=len(hashed))
            target = np.bincount(inverse, weights=is_target[own], minlength=len(hashed)).astype(np.int64)
            held.append((pairs[index], target, every.astype(np.int64)))
            if sum(len(h[1]) for h in held) > MERGE_ROWS:
                held = [merged(held)]
        pairs, target, every = merged(held)
        return pd.DataFrame({"part": np.full(len(target), key[0], np.int64), "hi": pairs[:, 0].astype(np.int64), "lo": pairs[:, 1].astype(np.int64), "target": target, "every": every})

    return docs.groupBy("part").cogroup(targets.groupBy("part")).applyInPandas(run, COUNT_SCHEMA)


def loss_differences(counts: DataFrame, order: int = ORDER, strength: float = STRENGTH) -> DataFrame:
    """hi, lo, d: target loss minus background loss of each n-gram's last character, given the others.

    ``counts`` has one row per n-gram with its counts (target, every).
    """
    base = counts.select("hi", "lo", *(_letter(k, order).alias(f"c{k}") for k in range(order)), "target", "every")
    letters = base.select(F.col(f"c{order - 1}").alias("c")).distinct().count()
    uniform = 1.0 / (letters + 1)
    shorter: DataFrame | None = None
    for n in range(1, order + 1):
        names = [f"c{k}" for k in range(order - n, order)]
        own = base.select("hi", "lo", *names, "target", "every") if n == order else base.groupBy(*names).agg(F.sum("target").alias("target"), F.sum("every").alias("every"))
        if n == 1:
            sums = own.agg(F.sum("target").alias("st"), F.sum("every").alias("se")).first()
            joined_ = own.withColumns({"st": F.lit(float(sums.st or 0)), "se": F.lit(float(sums.se or 0)), "qt": F.lit(uniform), "qe": F.lit(uniform)})
        else:
            context = own.groupBy(*names[:-1]).agg(F.sum("target").alias("st"), F.sum("every").alias("se"))
            joined_ = own.join(context, names[:-1]).join(shorter, names[1:])
        estimate = lambda count, total, less: (F.col(count) + F.lit(strength) * F.col(less)) / (F.col(total) + F.lit(strength))
        keep = ["hi", "lo"] if n == order else []
        shorter = joined_.select(*keep, *names, estimate("target", "st", "qt").alias("qt"), estimate("every", "se", "qe").alias("qe"))
    return shorter.select("hi", "lo", (F.log("qe") - F.log("qt")).alias("d"))


def _letter(k: int, order: int):
    word, place = ("hi", order - 4 - k) if k < order - 3 else ("lo", order - 1 - k)
    return F.shiftrightunsigned(F.col(word), 21 * place).bitwiseAND(F.lit((1 << 21) - 1))


def score(docs: DataFrame, target_keys: DataFrame, key: str = "doc_id", text: str = "text", order: int = ORDER, strength: float = STRENGTH, part_bytes: int = PART_BYTES) -> DataFrame:
    """key, tokens, loss_difference (summed), score (mean per token) of each row.

    ``target_keys`` has a column ``key``: the rows whose texts are the target corpus.
    """
    if not 4 <= order <= 6:
        raise ValueError("an n-gram of 4 to 6 characters fits its key")
    kind = docs.schema[key].dataType.simpleString()
    whole = docs.select(F.col(key).alias("key"), text_of(text).alias("text"))
    size = whole.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    parts = max(1, -(-size // part_bytes))
    place = F.pmod(F.xxhash64("key"), F.lit(parts))
    # Rows without a key are dealt by their text.
    dealt = whole.select(F.when(F.col("key").isNull(), F.pmod(F.xxhash64("text"), F.lit(parts))).otherwise(place).alias("part"), "key", "text")
    targets = target_keys.select(F.col(target_keys.columns[0]).cast(kind).alias("key")).where("key IS NOT NULL").distinct().select(place.alias("part"), "key")
    counted = materialize(count_parts(dealt, targets, order))
    model = materialize(counted.groupBy("hi", "lo").agg(F.sum("target").alias("target"), F.sum("every").alias("every")))
    differences = materialize(loss_differences(model, order, strength))
    answers = counted.select("part", "hi", "lo").join(differences, ["hi", "lo"]).select("part", "hi", "lo", "d")

    def run(rows: pd.DataFrame, known: pd.DataFrame) -> pd.DataFrame:
        hashed = dense(np.stack([known["hi"].to_numpy().astype(np.uint64), known["lo"].to_numpy().astype(np.uint64)], axis=1))
        order_ = np.argsort(hashed)
        hashed, d = hashed[order_], known["d"].to_numpy()[order_]
        tokens, total = np.zeros(len(rows), np.int64), np.zeros(len(rows))
        for points, owner in joined(rows["text"].tolist(), order):
            pairs, own = grams(points, owner, order)
            distinct, inverse = np.unique(dense(pairs), return_inverse=True)
            loss = d[np.searchsorted(hashed, distinct)][inverse] if len(distinct) else np.empty(0)
            tokens += np.bincount(own, minlength=len(rows))
            total += np.bincount(own, weights=loss, minlength=len(rows))
        mean = [float(t / n) if n else None for t, n in zip(total, tokens)]
        return pd.DataFrame({"key": rows["key"], "tokens": tokens, "loss_difference": total, "score": pd.Series(mean, dtype=object)})

    scored = dealt.groupBy("part").cogroup(answers.groupBy("part")).applyInPandas(run, f"key {kind}, tokens bigint, loss_difference double, score double")
    return scored.withColumnRenamed("key", key)
