"""SimHash near-duplicates through covering locality-sensitive hashing.

A text's fingerprint has a bit set if more than half of its word shingles have
it set in their 64-bit hashes. Fingerprints within ``radius`` differing bits
link. Every bit position gets a non-zero vector of radius + 1 bits; for every
non-zero such vector v one table keys fingerprints by the positions whose
vector has odd overlap with v. The vectors of at most ``radius`` differing
positions leave some v without odd overlap, so that every linked pair shares
its whole key in that v's table: nothing within the radius is missed.

Equal fingerprints collapse before the tables. Buckets are read one after the
other, and a bucket gives a spanning forest of its links, never all pairs. The
few buckets of more than TILE fingerprints are covered once more: what their
fingerprints share is fixed, so that linked ones differ in the other places
only, and the masks over these part a bucket again. A second bucket has so
many fixed places that it cannot hold more than some ten thousand different
fingerprints. Keys that a sample shows to be very common go to the second
tables at once, so that no task reads a large bucket. Components of the forest
edges are the groups.

A text without words has fingerprint zero, linked like any other; a null text
is empty; fewer words than a shingle make one shingle. Rows may repeat a key or
lack one: each row gets its fingerprint, and a group's name is the least key in
it (null if it has none). Of rows with one key and one text ``deduplicate``
keeps the one whose columns have the least hash. An empty table gives an empty
result.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from waypost.llm.common import map_texts, text_of
from waypost.llm.components import components
from waypost.operators.joins import join_hot
from waypost.session import materialize

WORDS, RADIUS, SEED = 3, 3, 42
#: Fingerprints in a bucket that is searched at once; bytes of a text that are shingled at once.
TILE, PIECE = 8_192, 1 << 22
#: Groups of up to so many fingerprints are screened together.
SMALL = 16
#: Fingerprints sampled to find common keys, and how often a common key is in the sample.
SAMPLE, COMMON = 200_000, 50

# ---- fingerprints ------------------------------------------------------------------------------------


def words_of(raw: bytes) -> Iterator[list[bytes]]:
    """The words of a text, some megabytes at a time."""
    at = 0
    while at < len(raw):
        end = at + PIECE
        while end < len(raw) and not raw[end : end + 1].isspace():
            end += 1
        yield raw[at:end].split()
        at = end


def majority(text: str, size: int, width: int, digests) -> bytes:
    """The bits that over half of the shingles' digests (of ``width`` bytes) have; zero without words."""
    raw = text.encode("utf-8", "surrogatepass").lower()  # of bytes: A to Z only
    counts, n, held = np.zeros(8 * width, np.int64), 0, []
    for words in words_of(raw):
        held = held + words if held else words
        if len(held) < size:
            continue
        joined = b"".join(digests(map(b" ".join, zip(*(held[i:] for i in range(size))))))
        bits = np.unpackbits(np.frombuffer(joined, np.uint8).reshape(-1, width), axis=1)
        n += len(bits)
        counts += bits.sum(0, dtype=np.int64)
        held = held[len(held) - size + 1 :]
    if not n:
        return b"".join(digests([b" ".join(held)])) if held else bytes(width)
    return np.packbits(2 * counts > n).tobytes()


def fingerprint(text: str, size: int = WORDS, seed: int = SEED) -> int:
    return int.from_bytes(majority(text, size, 8, lambda shingles: [xxhash.xxh64_digest(s, seed) for s in shingles]), "big")


def signed(value: int) -> int:
    return value - (1 << 64) if value >> 63 else value


def fingerprints(docs: DataFrame, key: str = "doc_id", text: str = "text", words: int = WORDS) -> DataFrame:
    """key, h (hash of the text) and fp (the fingerprint as a signed 64-bit number) of each row."""
    kind = docs.schema[key].dataType.simpleString()

    def run(keys, texts, hashes):
        return {"key": keys, "h": hashes, "fp": [signed(fingerprint(t, words)) for t in texts]}

    whole = text_of(text)
    return map_texts(docs.select(F.col(key), whole.alias("_text"), F.xxhash64(whole).alias("_h")), f"key {kind}, h bigint, fp bigint", run)


# ---- covering tables ---------------------------------------------------------------------------------


def covering_masks(radius: int, places: Sequence[int] = range(64)) -> list[int]:
    """One mask per non-zero vector of radius + 1 bits over the bit ``places``, whose vectors go round."""
    n = (1 << (radius + 1)) - 1
    return [sum(1 << place for i, place in enumerate(places) if ((1 + i % n) & v).bit_count() % 2) for v in range(1, n + 1)]


def different(fps: np.ndarray, other: np.ndarray) -> np.ndarray:
    """Different bits of unsigned 64-bit fingerprints."""
    return np.bitwise_count(fps ^ other)


def forest(fps: np.ndarray, radius: int) -> list[tuple[int, int]]:
    """A spanning forest of the links among fingerprints, as index pairs."""
    left = np.arange(len(fps))
    out: list[tuple[int, int]] = []
    while len(left) > 1:
        todo, left = [int(left[0])], left[1:]
        while todo and len(left):
            at = todo.pop()
            near = different(fps[left], fps[at]) <= radius
            if near.any():
                found = left[near].tolist()
                out += [(at, i) for i in found]
                todo += found
                left = left[~near]
    return out


def forests(fps: np.ndarray, cuts: np.ndarray, radius: int) -> list[tuple[int, int]]:
    """Forests of consecutive groups; groups of up to SMALL are first screened for any link together."""
    sizes, hit = np.diff(cuts), np.zeros(len(cuts) - 1, bool)
    hit[sizes > SMALL] = True
    owner, end = np.repeat(np.arange(len(sizes)), sizes), np.repeat(cuts[1:], sizes)
    at = np.flatnonzero(sizes[owner] <= SMALL)
    for shift in range(1, SMALL):
        at = at[at + shift < end[at]]
        if not len(at):
            break
        hit[owner[at[different(fps[at], fps[at + shift]) <= radius]]] = True
    return [(int(cuts[g]) + i, int(cuts[g]) + j) for g in np.flatnonzero(hit) for i, j in forest(fps[cuts[g] : cuts[g + 1]], radius)]


def links(fps: DataFrame, radius: int = RADIUS) -> DataFrame:
    """u, v: edges among the distinct ``fp`` (a written table) that join exactly those within the radius, directly or over others."""
    masks = covering_masks(radius)
    keyed = fps.select("fp", F.posexplode(F.array(*(F.col("fp").bitwiseAND(F.lit(signed(m))) for m in masks))).alias("t", "k"))
    rate = max(fps.count() // SAMPLE, 1)
    sample = keyed.where(F.pmod(F.xxhash64("fp"), F.lit(rate)) == 0)
    # Of at most some SAMPLE fingerprints: a bounded number of keys is common. They are searched like all others, by the second tables.
    common = materialize(sample.groupBy("t", "k").agg(F.count("*").alias("n")).where((F.col("n") >= COMMON) & (F.col("n") * rate > TILE)).select("t", "k"))
    rare = keyed.join(F.broadcast(common), ["t", "k"], "left_anti")
    found = materialize(forest_edges(rare, ["t", "k"], radius, TILE))
    again = keyed.join(F.broadcast(common), ["t", "k"], "left_semi").unionByName(found.where("v IS NULL").select(F.col("u").alias("fp"), "t", "k"))
    # The second masks of a table go over the places that its first mask leaves free.
    second = [covering_masks(radius, [i for i in range(64) if not m >> i & 1]) for m in masks]
    parts = F.array(*(F.array(*(F.col("fp").bitwiseAND(F.lit(signed(m))) for m in own)) for own in second))
    parted = again.select("fp", "t", "k", F.posexplode(F.get(parts, F.col("t"))).alias("t2", "k2"))
    inside = forest_edges(parted, ["t", "k", "t2", "k2"], radius)
    return found.where("v IS NOT NULL").unionByName(inside).select("u", "v").distinct()


def forest_edges(rows: DataFrame, keys: list[str], radius: int, most: int | None = None) -> DataFrame:
    """u, v, t, k: spanning edges among the ``fp`` of each bucket. The rows of a bucket of over ``most`` come back as they are, without v."""
    dealt = rows.select(*keys, "fp").repartition(*keys).sortWithinPartitions(*keys, "fp")
    schema = "u bigint, v bigint, t int, k bigint"
    arrow = to_arrow_schema(T.StructType.fromDDL(schema))
    width = len(keys)

    def batch_of(u, v, bucket: np.ndarray) -> pa.RecordBatch:
        columns = [u, v, bucket[:, 0], bucket[:, 1]]
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) if c is not None else pa.nulls(len(u), f.type) for c, f in zip(columns, arrow)], schema=arrow)

    def edges(held: np.ndarray) -> Iterator[pa.RecordBatch]:
        """Of whole buckets; a row has its keys and fingerprint."""
        cuts = np.flatnonzero(np.concatenate([[True], (held[1:, :width] != held[:-1, :width]).any(axis=1), [True]]))
        # Counting the bits of signed numbers would take their absolute values.
        found = forests(np.ascontiguousarray(held[:, width]).view(np.uint64), cuts, radius)
        if found:
            u, v = (list(side) for side in zip(*found))
            yield batch_of(held[u, width], held[v, width], held[u, :2])

    def run(batches):
        held, over = np.empty((0, width + 1), np.int64), None
        for batch in batches:
            new = np.stack([c.to_numpy(zero_copy_only=False).astype(np.int64) for c in batch.columns], axis=1)
            if over is not None:  # the rest of a large bucket
                rest = (new[:, :width] == over).all(axis=1)
                if rest.any():
                    yield batch_of(new[rest, width], None, new[rest, :2])
                new, over = new[~rest], over if rest.all() else None
            held = np.concatenate([held, new])
            if not len(held):
                continue
            other = (held[:, :width] != held[-1, :width]).any(axis=1)
            whole = int(np.flatnonzero(other)[-1]) + 1 if other.any() else 0
            if most is not None and len(held) - whole > most:
                yield batch_of(held[whole:, width], None, held[whole:, :2])
                over, held = held[-1, :width].copy(), held[:whole]
            if whole:
                yield from edges(held[:whole])
                held = held[whole:]
        if len(held):
            yield from edges(held)

    return dealt.mapInArrow(run, schema)


# ---- operators ---------------------------------------------------------------------------------------


def order_of(key: Column, h: Column) -> Column:
    """Rows by key, those without one last, ties by the hash of the text."""
    return F.struct(key.isNull().alias("none"), key.alias("key"), h.alias("h"))


def groups(docs: DataFrame, key: str = "doc_id", text: str = "text", words: int = WORDS, radius: int = RADIUS) -> DataFrame:
    """key, h, fp and first (struct none, key, h: the first row of the group) of each row."""
    rows = materialize(fingerprints(docs, key, text, words))
    distinct = materialize(rows.groupBy("fp").agg(F.min(order_of(F.col("key"), F.col("h"))).alias("own"), F.count("*").alias("n")))
    node = components(links(distinct.select("fp"), radius)).select(F.col("node").alias("fp"), F.col("component").alias("root"))
    known = materialize(distinct.join(node, "fp", "left").select("fp", "own", "n", F.coalesce("root", "fp").alias("root")))
    first = materialize(known.groupBy("root").agg(F.min("own").alias("first"), F.count("*").alias("fps")))
    # Neither the rows of a common fingerprint nor the fingerprints of a large group meet in one task.
    found = materialize(join_hot(known, first, ["root"], "fps").select("fp", "n", "first"))
    return join_hot(rows, found, ["fp"], "n")


def hex16(fp: Column) -> Column:
    return F.lpad(F.lower(F.hex(fp)), 16, "0")


def near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text", words: int = WORDS, radius: int = RADIUS) -> DataFrame:
    """key, fingerprint (16 hex digits), component_id (least key of the group) of each row."""
    found = groups(docs, key, text, words, radius)
    return found.select(F.col("key").alias(key), hex16(F.col("fp")).alias("fingerprint"), F.col("first.key").alias("component_id"))


def deduplicate(docs: DataFrame, key: str = "doc_id", text: str = "text", words: int = WORDS, radius: int = RADIUS) -> DataFrame:
    """``docs``, all columns as they are, with the first row of each group of linked texts."""
    found = groups(docs, key, text, words, radius)
    name = lambda k: F.coalesce(k.cast("string"), F.lit("\x00"))  # noqa: E731  a null key is a key
    firsts = found.select(name(F.col("first.key")).alias("k"), F.col("first.h").alias("h")).distinct()
    row = F.struct(*(F.col(f"`{c}`") for c in docs.columns))
    rows = docs.select(row.alias("row"), name(F.col(f"`{key}`")).alias("k"), F.xxhash64(text_of(f"`{text}`")).alias("h"))
    kept = rows.join(firsts, ["k", "h"], "left_semi")
    # Rows of one key and text are alike for the groups; one of them stays. The aggregate combines before the exchange.
    return kept.groupBy("k", "h").agg(F.min_by("row", F.xxhash64("row")).alias("row")).select("row.*")
