"""Helpers shared by the text operators."""

from __future__ import annotations

import ctypes
import glob
import os
import sys
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

#: UTF-8 bytes of text that one call of a task function sees; a longer text comes alone.
SLICE_BYTES = 4 << 20


def per_process(key: tuple, make: Callable[[], object]):
    """Made once per worker process. Task functions travel by value, so their own globals are new in each task."""
    held = sys.__dict__.setdefault("_waypost_llm", {})
    if key not in held:
        held[key] = make()
    return held[key]


def one_blas_thread() -> None:
    """Keep numpy's bundled matrix library to one thread in this process; tasks already use all cores."""
    folder = os.path.join(os.path.dirname(np.__file__), os.pardir, "numpy.libs")
    for path in glob.glob(os.path.join(folder, "*openblas*")):
        library = ctypes.CDLL(path)
        for name in ("scipy_openblas_set_num_threads64_", "scipy_openblas_set_num_threads", "openblas_set_num_threads64_", "openblas_set_num_threads"):
            if hasattr(library, name):
                getattr(library, name)(1)
                break


class Recent(dict):
    """Remembers what ``make`` gave for a key; keeps the keys used lately, about twice ``most`` at most."""

    def __init__(self, make: Callable, most: int):
        self.make, self.most, self.older = make, most, {}

    def __missing__(self, key):
        value = self.older.pop(key, None)
        if value is None:
            value = self.make(key)
        if len(self) >= self.most:
            self.older = dict(self)
            self.clear()
        self[key] = value
        return value


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def text_of(column: str | Column) -> Column:
    """The text, empty where it is null."""
    return F.coalesce(F.col(column) if isinstance(column, str) else column, F.lit(""))


def slices(batch: pa.RecordBatch, text: int, most: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut a batch so that each cut holds about ``most`` bytes of its text column, or one row."""
    sizes = pc.binary_length(batch.column(text)).fill_null(0).to_pylist()
    start = held = 0
    for i, size in enumerate(sizes):
        if held and held + size > most:
            yield batch.slice(start, i - start)
            start, held = i, 0
        held += size
    if len(sizes) > start:
        yield batch.slice(start)


def map_texts(df: DataFrame, schema: str, fn: Callable[..., dict], text: int = 1, most: int = SLICE_BYTES) -> DataFrame:
    """``fn`` gets the columns of ``df`` as lists, some megabytes of text at a time, and returns columns.

    Rows are independent, so that lost tasks can run again anywhere.
    """
    arrow = to_arrow_schema(T.StructType.fromDDL(schema))

    def run(batches):
        for batch in batches:
            for cut in slices(batch, text, most):
                out = fn(*[c.to_pylist() for c in cut.columns])
                yield pa.RecordBatch.from_arrays([pa.array(out[f.name], type=f.type) for f in arrow], schema=arrow)

    return df.mapInArrow(run, schema)
