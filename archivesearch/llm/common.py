"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import ctypes
import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: The ASCII white space that separates words, as a character class of Java's and Python's regexes.
ASCII_SPACE = r"[\x20\x09-\x0D]+"


def shared_dir(spark: SparkSession, purpose: str) -> str:
    """A new folder path below the one that ``spark.checkpoint.dir`` names.

    Where the setting is absent (a local session of a test) one is set on this
    session; a cluster must name a folder that driver and executors share.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        root = "file://" + tempfile.mkdtemp(prefix="llm-shared-")
        spark.conf.set("spark.checkpoint.dir", root)
    return f"{root.rstrip('/')}/llm-{purpose}-{uuid.uuid4().hex}"


def stage(df: DataFrame, purpose: str) -> DataFrame:
    """Write ``df`` into the shared folder and read it back.

    Cuts the lineage in a way that survives lost executors, and gives the
    planner the exact size of the table, so that it broadcasts it only under
    its own threshold.
    """
    spark = df.sparkSession
    path = shared_dir(spark, purpose)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def settings(spark: SparkSession, **conf: str):
    """Session settings (dots written as ``__``) for the time of the block."""
    keys = {k.replace("__", "."): v for k, v in conf.items()}
    before = {k: spark.conf.get(k, None) for k in keys}
    try:
        for k, v in keys.items():
            spark.conf.set(k, v)
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


ARROW_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"


def small_batches(spark: SparkSession, rows: int = 1000) -> None:
    """Arrow batches of at most ``rows`` rows, unless the session has a setting of its own.

    A batch is held by the executor and by its Python worker, with what the worker returns; 10,000 rows, the
    usual setting, are about 35 MB of documents each time."""
    if spark.conf.get(ARROW_ROWS) == "10000":
        spark.conf.set(ARROW_ROWS, str(rows))


_KEPT: dict[str, object] = {}


def kept_in_worker(key: str, make: Callable[[], object]) -> object:
    """An object that a Python worker keeps from task to task. Only the last operator's is kept: another key drops it."""
    if key not in _KEPT:
        forget_kept()
        _KEPT[key] = make()
    return _KEPT[key]


def forget_kept() -> None:
    """Free what an earlier operator kept in this Python worker."""
    _KEPT.clear()
    give_back()


def give_back() -> None:
    """Return memory that this Python worker has freed to the system; the C library and Arrow would keep it
    for later, about 150 MB a worker after a few operators."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc has it
    if trim:
        trim(0)


def lean(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The batches; what the work on one has freed is given back before the next comes."""
    for batch in batches:
        yield batch
        del batch
        give_back()


def text_or_empty(text: str = "text") -> Column:
    return F.coalesce(F.col(text).cast("string"), F.lit(""))


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")
