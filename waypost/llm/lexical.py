"""Ranked lexical search by dense blocked matrix products.

A document scores, for each term that it shares with an item, the term's weight
times an impact of at most IMPACT that grows with the term's frequency and
falls with the document's length. Documents are cut into tiles of DOCS rows,
items into tiles of ITEMS, and the items' terms, numbered without gaps inside
an item tile, into tiles of vocabulary. The weights of an item tile times the
impacts of a document tile are one float64 matrix product per tile of
vocabulary. A vocabulary tile is so small that the greatest weight times IMPACT
times its terms stays below 2^53: every partial sum is a whole number that a
double holds exactly, in whatever order it is added. Tiles add up in 64-bit
integers.

Of each document tile only the best per item go on, ties by ascending key; all
documents that tie with the last place take part in the choice. A task keeps
one list per item. The tasks' lists meet in two rounds, first in salted groups.

Documents are read once per item block. Item blocks hold about BLOCK bytes of
terms, or one item, so that what a task is sent does not grow with the number of
items. Statistics (documents, terms, document frequencies) are over all documents.

A null or empty document has no terms and is not counted; an item without known
terms has no rows. Rows that repeat a document key are documents of their own;
a null key ranks behind all others at equal scores. Rows that repeat an item's
key are one item with the terms of all. Empty tables give an empty result.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from waypost.llm.common import one_blas_thread, slices, text_of
from waypost.session import materialize

#: Best documents per item; documents, items and terms in a tile; bytes of terms in an item block; bytes of a text looked at at once.
BEST, DOCS, ITEMS, TERMS, BLOCK, PIECE = 10, 1024, 256, 4096, 4 << 20, 1 << 22
#: Salted groups in which the lists of the tasks meet first.
SALTS = 64
#: Fixed values of the score: scale of an impact, weight of the frequency and of the length, scale of a term's weight.
IMPACT, FREQUENCY, LENGTH, WEIGHT = 1_000_000, 1_000, 8, 1_000
SCALE = IMPACT * FREQUENCY
#: Fixed values of the length factor: a base of 100 of which 90 go by the length.
BASE, BY_LENGTH = 100, 90
EXACT = 1 << 53
#: A term is made of ASCII letters and digits and everything beyond ASCII; only A to Z are lower-cased. All else parts terms.
LETTERS = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or chr(b).isalnum() else 32 for b in range(256))

# ---- terms -------------------------------------------------------------------------------------------


def terms_of(text: str | None) -> Iterator[list[bytes]]:
    """The terms of a text as UTF-8, some megabytes at a time."""
    raw, at = (text or "").encode("utf-8", "surrogatepass").translate(LETTERS), 0
    while at < len(raw):
        end = raw.find(b" ", at + PIECE)
        end = len(raw) if end < 0 else end
        yield raw[at:end].split()
        at = end


def item_terms(items: DataFrame, key: str, text: str) -> DataFrame:
    """item, terms (distinct, sorted) and their bytes."""

    def run(batches):
        for batch in batches:
            keys, found = [], []
            for i, one in enumerate(batch.column(1).to_pylist()):
                own = {t for terms in terms_of(one) for t in terms}
                keys += [i] * len(own)
                found += [t.decode("utf-8", "surrogatepass") for t in own]
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(keys, pa.int64())), pa.array(found, pa.string())], names=["item", "term"])

    kind = items.schema[key].dataType.simpleString()
    found = items.select(F.col(f"`{key}`").alias("item"), text_of(f"`{text}`").alias("_text")).mapInArrow(run, f"item {kind}, term string").distinct()
    return found.groupBy("item").agg(F.sort_array(F.collect_list("term")).alias("terms"), F.sum(F.octet_length("term")).alias("bytes"))


# ---- postings and weights ----------------------------------------------------------------------------


def postings(docs: DataFrame, number: dict[bytes, int], key: str, text: str) -> DataFrame:
    """key, n (terms with repeats) and, of the numbered terms in each document, number and frequency. Written."""
    schema = f"key {docs.schema[key].dataType.simpleString()}, n bigint, ids array<int>, tf array<int>"
    arrow = to_arrow_schema(T.StructType.fromDDL(schema))

    def run(batches):
        for batch in batches:
            for cut in slices(batch, 1):
                total, ids, tf = [], [], []
                for one in cut.column(1).to_pylist():
                    counts: Counter = Counter()
                    for terms in terms_of(one):
                        counts.update(terms)
                    own = [(number[t], c) for t, c in counts.items() if t in number]
                    total.append(counts.total())
                    ids.append([i for i, _ in own])
                    tf.append([c for _, c in own])
                columns = [cut.column(0), total, ids, tf]
                yield pa.RecordBatch.from_arrays([c if isinstance(c, pa.Array) else pa.array(c, f.type) for c, f in zip(columns, arrow)], schema=arrow)

    return materialize(docs.select(F.col(f"`{key}`"), text_of(f"`{text}`").alias("_text")).mapInArrow(run, schema).where("n > 0"))


def weight(n_docs: int, df: int) -> int:
    return math.floor(WEIGHT * math.log((2 * n_docs + 2) / (2 * df + 1)))


def impacts(tf: np.ndarray, sizes: np.ndarray, n: np.ndarray, n_docs: int, n_terms: int) -> np.ndarray:
    """Whole impacts of terms that occur ``tf`` times; documents of ``n`` terms have ``sizes`` of them each."""
    longer = np.array([BASE - BY_LENGTH + BY_LENGTH * own * n_docs // n_terms for own in n.tolist()], np.int64)
    return SCALE * tf // (FREQUENCY * tf + LENGTH * np.repeat(longer, sizes))


# ---- tiles -------------------------------------------------------------------------------------------


class ItemTile:
    """Some items: their terms numbered without gaps, and the weights as (item, term, weight) by tiles of terms."""

    def __init__(self, terms: list[list[int]], weights: np.ndarray):
        self.n = len(terms)
        item = np.repeat(np.arange(self.n), [len(t) for t in terms])
        self.vocabulary, self.local = np.unique(np.concatenate([*terms, []]).astype(np.int64), return_inverse=True)
        value = weights[self.vocabulary[self.local]]
        widest = int(value.max(initial=1))
        self.width = max(min(TERMS, (EXACT - 1) // (max(widest, 1) * IMPACT)), 1)
        if widest * IMPACT >= EXACT:
            raise ValueError("one term's product is beyond what a double holds")
        order = np.argsort(self.local // self.width, kind="stable")
        self.item, self.term, self.value = item[order], self.local[order], value[order].astype(float)
        self.cuts = np.searchsorted(self.term // self.width, np.arange(len(self.vocabulary) // self.width + 2))

    def scores(self, doc: np.ndarray, term: np.ndarray, impact: np.ndarray, docs: int) -> np.ndarray:
        """Whole scores, items by documents; the impacts are given as (document, term, impact)."""
        out = np.zeros((self.n, docs), np.int64)
        if not len(self.vocabulary):
            return out
        slot = np.minimum(np.searchsorted(self.vocabulary, term), len(self.vocabulary) - 1)
        inside = self.vocabulary[slot] == term
        slot, doc, impact = slot[inside], doc[inside], impact[inside]
        for tile, (a, b) in enumerate(zip(self.cuts[:-1], self.cuts[1:])):
            here = slot // self.width == tile
            if a == b or not here.any():
                continue
            width = min(self.width, len(self.vocabulary) - tile * self.width)
            left, right = np.zeros((self.n, width)), np.zeros((width, docs))
            left[self.item[a:b], self.term[a:b] - tile * self.width] = self.value[a:b]
            right[slot[here] - tile * self.width, doc[here]] = impact[here]
            out += (left @ right).astype(np.int64)
        return out


def best_of(scores: np.ndarray, least: int, most: int) -> np.ndarray:
    """Places of the ``most`` greatest positive scores of at least ``least``, and of all that tie with the last of them."""
    found = np.flatnonzero(scores >= max(least, 1))
    if len(found) > most:
        found = found[scores[found] >= np.partition(scores[found], -most)[-most]]
    return found


class Best:
    """The best (score, key) of an item so far, in order."""

    def __init__(self, most: int):
        self.most, self.rows = most, []

    def add(self, scores: np.ndarray, keys: list) -> None:
        places = best_of(scores, self.rows[-1][0] if len(self.rows) == self.most else 1, self.most)
        if len(places):
            self.rows += [(int(scores[p]), keys[p]) for p in places]
            self.rows.sort(key=lambda row: (-row[0], row[1] is None, 0 if row[1] is None else row[1]))
            del self.rows[self.most :]


# ---- operator ----------------------------------------------------------------------------------------


def ranked(rows: DataFrame, most: int, *by: str) -> DataFrame:
    order = Window.partitionBy("item", *by).orderBy(F.desc("score"), F.col("key").isNull(), "key")
    return rows.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= most)


def search_block(docs: DataFrame, block: list, item_kind: T.DataType, key: str, text: str, most: int) -> DataFrame:
    """item, key, score: each task's best documents for the items of a block (rows of item and terms)."""
    number = {t.encode(): i for i, t in enumerate(sorted({t for row in block for t in row.terms}))}
    found = postings(docs, number, key, text)
    totals = found.agg(F.count("*").alias("docs"), F.sum("n").alias("terms")).first()
    n_docs, n_terms = totals.docs, totals.terms
    weights = np.zeros(len(number), np.int64)
    for row in found.select(F.explode("ids").alias("id")).groupBy("id").agg(F.count("*").alias("df")).collect():  # at most the block's terms
        weights[row.id] = weight(n_docs, row.df)
    tiles = []
    for lo in range(0, len(block), ITEMS):
        own = block[lo : lo + ITEMS]
        tiles.append(([row.item for row in own], ItemTile([[number[t.encode()] for t in row.terms] for row in own], weights)))
    schema = T.StructType([T.StructField("item", item_kind), T.StructField("key", found.schema["key"].dataType), T.StructField("score", T.LongType())])
    arrow = to_arrow_schema(schema)

    def run(batches):
        one_blas_thread()
        kept = [[Best(most) for _ in names] for names, _ in tiles]
        for batch in batches:
            for lo in range(0, batch.num_rows, DOCS):
                cut = batch.slice(lo, DOCS)
                keys, n = cut.column(0).to_pylist(), cut.column(1).to_numpy(zero_copy_only=False)
                sizes = cut.column(2).value_lengths().to_numpy(zero_copy_only=False)
                doc = np.repeat(np.arange(len(keys)), sizes)
                term, tf = (cut.column(c).flatten().to_numpy(zero_copy_only=False).astype(np.int64) for c in (2, 3))
                impact = impacts(tf, sizes, n, n_docs, n_terms)
                for best, (_, tile) in zip(kept, tiles):
                    for one, scores in zip(best, tile.scores(doc, term, impact, len(keys))):
                        one.add(scores, keys)
        rows = [(item, one, score) for best, (names, _) in zip(kept, tiles) for item, own in zip(names, best) for score, one in own.rows]
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), arrow)], schema=arrow)

    return found.mapInArrow(run, schema)


def search(docs: DataFrame, items: DataFrame, key: str = "doc_id", item: str = "item_id", text: str = "text", most: int = BEST, block_bytes: int = BLOCK) -> DataFrame:
    """item, rank (from 1), key and score of each item's ``most`` best documents with a score above 0."""
    wanted = materialize(item_terms(items, item, text))
    blocks = -(-(wanted.agg(F.sum("bytes")).first()[0] or 0) // block_bytes)
    kind = wanted.schema["item"].dataType
    number = F.pmod(F.xxhash64("item"), F.lit(max(blocks, 1)))
    found = [search_block(docs, block, kind, key, text, most) for b in range(blocks) if (block := wanted.where(number == b).orderBy("item").collect())]
    schema = T.StructType([T.StructField("item", kind), T.StructField("key", docs.schema[key].dataType), T.StructField("score", T.LongType())])
    rows = reduce(DataFrame.unionAll, found, docs.sparkSession.createDataFrame([], schema))
    first = ranked(rows.withColumn("salt", F.spark_partition_id() % SALTS), most, "salt")
    best = ranked(first.drop("rank", "salt"), most)
    return best.select(F.col("item").alias(item), "rank", F.col("key").alias(key), "score")
