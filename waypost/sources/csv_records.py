"""Records of CSV files whose cells may hold line breaks, read by many tasks.

Spark splits a text file at line ends. Whether a split begins inside a quoted
cell depends on the quotes before it: each split's count is odd or even, and the
running parity over the splits of a file (a prefix scan over one row per split)
is the state in which each begins. A task then cuts its lines into records by
the parity of the quotes alone. What lies before the first end of a record in a
split that begins inside one, and the unfinished record at a split's end, are
fragments; they are put together by the split in which their record begins.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

WHOLE, HEAD, TAIL = 0, 1, 2
_FIELDS = "file string, start bigint, kind int, first boolean, text string"
_ARROW = pa.schema([("file", pa.string()), ("start", pa.int64()), ("kind", pa.int32()), ("first", pa.bool_()), ("text", pa.string())])


def _lines(spark: SparkSession, path: str) -> DataFrame:
    lines = spark.read.option("lineSep", "\n").text(path)
    return lines.select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"), F.col("value").alias("text"))


def _inside(lines: DataFrame) -> DataFrame:
    """file, start of the splits that begin inside a quoted cell."""
    quotes = F.length("text") - F.length(F.replace("text", F.lit('"'), F.lit("")))
    odd = lines.groupBy("file", "start").agg((F.sum(quotes) % 2).alias("odd"))
    before = F.sum("odd").over(W.partitionBy("file").orderBy("start").rowsBetween(W.unboundedPreceding, -1))
    return odd.withColumn("before", before).filter(F.col("before") % 2 == 1).select("file", "start")


class _Split:
    """Lines of a split so far: whether they end inside a cell, and what is not yet a record."""

    def __init__(self, file: str, start: int, inside: bool):
        self.file, self.start, self.inside = file, start, inside
        self.headless, self.first, self.held = inside, start == 0, []

    def take(self, lines: pa.Array) -> Iterator[pa.RecordBatch]:
        """The records that end in these lines."""
        parity = (np.cumsum(pc.count_substring(lines, '"').to_numpy(zero_copy_only=False)) + self.inside) % 2
        ends = np.flatnonzero(parity == 0)
        if len(ends):
            offsets = np.concatenate([[0], ends + 1]).astype(np.int32)
            whole = pc.binary_join(pa.ListArray.from_arrays(pa.array(offsets), lines.slice(0, int(ends[-1]) + 1)), "\n")
            if self.held:
                texts = ["\n".join([*self.held, whole[0].as_py()]), *whole.slice(1).to_pylist()] if len(self.held) else whole
                whole, self.held = pa.array(texts, pa.string()), []
            kinds, firsts = np.zeros(len(whole), np.int32), np.zeros(len(whole), bool)
            if self.headless:
                kinds[0], self.headless = HEAD, False
            elif self.first:
                firsts[0] = True
            self.first = False
            yield self.rows(kinds, firsts, whole)
        self.held += lines.slice(int(ends[-1]) + 1 if len(ends) else 0).to_pylist()
        self.inside = bool(parity[-1])

    def rest(self) -> Iterator[pa.RecordBatch]:
        """What the last line leaves open: of a record that began here, or of one that fills the whole split."""
        if self.held:
            kind = HEAD if self.headless else TAIL
            yield self.rows(np.array([kind], np.int32), np.array([self.first]), pa.array(["\n".join(self.held)]))

    def rows(self, kinds: np.ndarray, firsts: np.ndarray, texts: pa.Array) -> pa.RecordBatch:
        n = len(texts)
        return pa.RecordBatch.from_arrays([pa.array([self.file] * n, pa.string()), pa.array(np.full(n, self.start)), pa.array(kinds), pa.array(firsts), texts.cast(pa.string())], schema=_ARROW)


def csv_records(spark: SparkSession, path: str) -> DataFrame:
    """text of every record of the files under ``path``, but for each file's header; records end at line feeds.

    Only the splits that begin inside a cell are sent to the tasks: a file name
    and a number for each, so some bytes per split of input.
    """
    lines = _lines(spark, path)
    states: dict[str, set[int]] = {}
    for r in _inside(lines).collect():
        states.setdefault(r["file"], set()).add(r["start"])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        split = None
        for batch in batches:
            if not batch.num_rows:
                continue
            start = batch.column(1).to_numpy()
            names = batch.column(0).dictionary_encode().indices.to_numpy()
            cuts = np.flatnonzero(np.concatenate([[True], (start[1:] != start[:-1]) | (names[1:] != names[:-1]), [True]]))
            for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist()):
                at = (batch.column(0)[a].as_py(), int(start[a]))
                if split is None or (split.file, split.start) != at:
                    if split is not None:
                        yield from split.rest()
                    split = _Split(*at, at[1] in states.get(at[0], ()))
                yield from split.take(batch.column(2).slice(a, b - a))
        if split is not None:
            yield from split.rest()

    found = lines.mapInArrow(cut, _FIELDS)
    whole = found.filter((F.col("kind") == WHOLE) & ~F.col("first")).select("text")
    # Fragments: a tail begins a record, the heads that follow it go on with it.
    begun = F.max(F.when(F.col("kind") == TAIL, F.col("start"))).over(W.partitionBy("file").orderBy("start", "kind"))
    parts = found.filter(F.col("kind") != WHOLE).withColumn("begun", F.coalesce(begun, F.lit(-1)))
    joined = parts.groupBy("file", "begun").agg(
        F.max("first").alias("first"),
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("start", "kind", "text"))), lambda s: s["text"]), "\n").alias("text"),
    )
    records = whole.unionByName(joined.filter(~F.col("first")).select("text"))
    return records.select(F.rtrim("text", F.lit("\r")).alias("text")).filter(F.col("text") != "")
