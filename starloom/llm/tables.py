"""Intermediate tables that are removed when the operator that wrote them is done."""

from __future__ import annotations

import gc
import time
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

from starloom.session import scratch

JOINED = 4
_scopes: ContextVar[tuple[list[str], ...]] = ContextVar("scopes", default=())
_parts: ContextVar[int | None] = ContextVar("parts", default=None)


def materialise(df: DataFrame, name: str, lasting: bool = False) -> DataFrame:
    """Write ``df`` once as Parquet in the shared folder and read it back.

    Inside :func:`temporary` the table goes when that ends, a ``lasting`` one when the next outer one ends. Outside,
    nothing is removed, as a result may still be read from the table. Inside :func:`in_parts` it has few files.
    """
    spark = df.sparkSession
    path = scratch(spark, name)
    joined(df).write.parquet(path)
    scopes = _scopes.get()[: -1 if lasting else None]
    if scopes:
        scopes[-1].append(path)
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def in_parts(parts: int) -> Iterator[None]:
    """Tables written inside have so many files at most: for rows that need fewer than there are shuffle partitions.

    ``parts`` has to grow with the rows. What is shuffled keeps its partitions, and one task writes several of them, for the
    reason that :func:`few_files` tells.
    """
    token = _parts.set(parts)
    try:
        yield
    finally:
        _parts.reset(token)


def joined(df: DataFrame) -> DataFrame:
    """``df`` in the partitions of :func:`in_parts`, for a step in Python: one call for several partitions, not one for each."""
    parts = _parts.get()
    return df.coalesce(parts) if parts else df


def few_files(df: DataFrame) -> DataFrame:
    """``df``, made by a shuffle, for writing: up to ``JOINED`` of its partitions in one file where there are many more than cores.

    For every file on a local path Hadoop starts two processes (``chmod``), each of which shares the executor's whole memory
    until it has started. Tasks do not grow with the input beyond that many partitions.
    """
    spark = df.sparkSession
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    joined = min(JOINED, partitions // (8 * spark.sparkContext.defaultParallelism))
    return df.coalesce(-(-partitions // joined)) if joined > 1 else df


def release(spark: SparkSession) -> None:
    """Lets Spark remove the shuffle files of jobs that are done.

    It does so when the driver's garbage collector finds that nothing refers to them, which can be long after, as these jobs
    leave little garbage on the driver. The first round lets go what Python's objects held, the second finds the files.
    """
    for _ in range(2):
        gc.collect()
        spark._jvm.System.gc()
        time.sleep(0.3)


# Rows hold whole texts, or sets as large, so fewer of them than Spark's default go to Python at once.
_BATCH, _ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch", "1000"


@contextmanager
def temporary(spark: SparkSession) -> Iterator[None]:
    """Removes the tables written inside. What is read from them has to be written, or to be a lasting table, by the end.

    Until then Arrow batches are small; afterwards the session is set as it was.
    """
    paths: list[str] = []
    token = _scopes.set((*_scopes.get(), paths))
    rows = spark.conf.get(_BATCH)
    spark.conf.set(_BATCH, _ROWS)
    try:
        yield
    finally:
        spark.conf.set(_BATCH, rows)
        _scopes.reset(token)
        for path in paths:
            folder = spark._jvm.org.apache.hadoop.fs.Path(path)
            folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)
        release(spark)
