"""Session helpers: a local builder for tests and benchmarks, and plan cutting.

``materialize`` is the only place where the library writes intermediate data.
It writes a Parquet table into the shared folder the cluster names in
``spark.checkpoint.dir``; the read-back frame has a short lineage, exact size
statistics for the optimizer, and survives the loss of any executor.
"""

from __future__ import annotations

import ctypes
import glob
import os
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F


def local_session(cores: str = "*", app: str = "waypost", **conf: str) -> SparkSession:
    """Small local session for tests and the benchmark."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def one_blas_thread() -> None:
    """Keep numpy's bundled matrix library to one thread in this process; tasks already use all cores."""
    folder = os.path.join(os.path.dirname(np.__file__), os.pardir, "numpy.libs")
    for path in glob.glob(os.path.join(folder, "*openblas*")):
        library = ctypes.CDLL(path)
        for name in ("scipy_openblas_set_num_threads64_", "scipy_openblas_set_num_threads", "openblas_set_num_threads64_", "openblas_set_num_threads"):
            if hasattr(library, name):
                getattr(library, name)(1)
                break


def scratch_dir(spark: SparkSession) -> str:
    """Shared folder for intermediate tables.

    The cluster's own setting wins. A machine-local folder is only ever used in
    local mode, where driver and executors share one machine.
    """
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
    made = tempfile.mkdtemp(prefix="waypost-")
    spark.sparkContext.setCheckpointDir(made)
    return made


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder."""
    path = f"{scratch_dir(spark)}/{name}-{uuid.uuid4().hex}"
    for paths in _SCOPES:
        paths.append(path)
    return path


#: Paths made in the scopes that are open now, the outermost first.
_SCOPES: list[list[str]] = []


@contextmanager
def temporary_tables(spark: SparkSession) -> Iterator[None]:
    """Delete, at the end, the intermediate tables that were written inside.

    Frames are lazy: write or collect what is wanted before the scope ends.
    """
    paths: list[str] = []
    _SCOPES.append(paths)
    try:
        yield
    finally:
        _SCOPES.remove(paths)
        hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs
        for path in paths:
            place = hadoop.Path(path)
            place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(place, True)


def materialize(df: DataFrame, watch: Observation | None = None, **metrics: Column) -> DataFrame:
    """Write ``df`` once and return a frame that scans the written table.

    The schema is passed to the reader, so reading back starts no
    schema-inference job. ``watch`` gets the number of rows and the ``metrics``
    from the write itself.
    """
    spark = df.sparkSession
    path = scratch_path(spark, "table")
    seen = df if watch is None else df.observe(watch, F.count(F.lit(1)).alias("n_rows"), *[c.alias(n) for n, c in metrics.items()])
    seen.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
