"""Shared-folder helpers used by the operators."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterable
from multiprocessing.pool import ThreadPool
from typing import TypeVar

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession

T = TypeVar("T")

BROADCAST_ROWS = 100_000  # fixed value: a side table of more rows is not sent to every task


def shared_folder(spark: SparkSession) -> str:
    """Folder all executors can reach, taken from ``spark.checkpoint.dir``.

    Only a local session may fall back to a folder of its own; a cluster must name one.
    """
    sc = spark.sparkContext
    if sc.getCheckpointDir() is None:
        folder = spark.conf.get("spark.checkpoint.dir", None)
        if folder is None:
            if not sc.master.startswith("local"):
                raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
            folder = tempfile.mkdtemp(prefix="venueflow-")
        sc.setCheckpointDir(folder)
    return sc.getCheckpointDir()


def new_shared_path(spark: SparkSession, label: str) -> str:
    return f"{shared_folder(spark)}/{label}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, label: str, by: str | None = None, file_rows: int = 0) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back.

    Used where a value must not change between two reads (row positions), or where several
    later steps reuse a reduced table. The files outlive any executor. ``by`` writes a folder per
    value of a few-valued column, so that reads of some of its values skip the rest. ``file_rows``
    bounds the rows of a file, for rows so long that a reader cannot hold thousands at once.
    """
    path = new_shared_path(df.sparkSession, label)
    writer = df.write.option("maxRecordsPerFile", file_rows)
    (writer.partitionBy(by) if by else writer).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def bounded_side(df: DataFrame, counted: DataFrame | None = None) -> DataFrame:
    """``df`` as the side of a join that is broadcast only while it is small in memory.

    Spark compares a threshold with the size of files, or with an estimate that takes no account of
    exploded rows; either may be a small part of what the driver then holds. A table of more than
    BROADCAST_ROWS rows is joined by sort. ``counted`` is a cheaper table with at least as many rows.
    """
    rows = (df if counted is None else counted).limit(BROADCAST_ROWS + 1).count()
    return df.hint("merge") if rows > BROADCAST_ROWS else df


def in_parallel(spark: SparkSession, jobs: Iterable[Callable[[], T]], at_once: int) -> list[T]:
    """Results of small driver functions that each run Spark jobs, ``at_once`` of them side by side."""
    jobs = [inheritable_thread_target(spark)(job) for job in jobs]
    with ThreadPool(max(1, min(at_once, len(jobs)))) as pool:
        return pool.map(lambda job: job(), jobs)
