"""Intermediate tables in the shared folder, which outlive any executor."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager
from itertools import count

from pyspark.sql import DataFrame, SparkSession

from tallywork.session import drop_at_exit, shared_dir

BATCH_ROWS = 1_000
_BATCH = "spark.sql.execution.arrow.maxRecordsPerBatch"
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

Keep = Callable[[DataFrame, str], DataFrame]


@contextmanager
def _tidy_shuffles(spark: SparkSession):
    """Free the shuffle files of the jobs inside as soon as each has ended: their result is a table."""
    before = spark.conf.get(_CLEANUP, None)
    if before is None:
        yield
        return
    spark.conf.set(_CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.set(_CLEANUP, before)


def batches_of(spark: SparkSession, rows: int) -> None:
    """From now on at most so many rows of this session go between Spark and Python at a time."""
    now = int(spark.conf.get(_BATCH))
    spark.conf.set(_BATCH, str(min(now, rows) if now > 0 else rows))


@contextmanager
def _small_batches(spark: SparkSession):
    """Fewer rows at a time between Spark and Python: texts are long, and both sides hold a batch several times."""
    before = spark.conf.get(_BATCH)
    batches_of(spark, BATCH_ROWS)
    try:
        yield
    finally:
        spark.conf.set(_BATCH, before)


def _store(df: DataFrame, path: str) -> DataFrame:
    with _tidy_shuffles(df.sparkSession), _small_batches(df.sparkSession):
        df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def written(df: DataFrame, purpose: str) -> DataFrame:
    """Write a table once and read it back, so that later jobs neither repeat nor depend on its lineage.

    It is deleted when the driver ends: the caller's result may read it until then.
    """
    path = shared_dir(df.sparkSession, purpose)
    made = _store(df, path)
    drop_at_exit(df.sparkSession, path)
    return made


@contextmanager
def scratch(spark: SparkSession, purpose: str) -> Iterator[Keep]:
    """Gives a function like ``written`` whose tables are deleted at the end of the block.

    What leaves the block must have been written elsewhere by then.
    """
    base, number = shared_dir(spark, purpose), count()
    try:
        yield lambda df, name: _store(df, f"{base}/{next(number)}-{name}")
    finally:
        path = spark._jvm.org.apache.hadoop.fs.Path(base)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
