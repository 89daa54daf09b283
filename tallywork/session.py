"""Session settings and the shared folder used for materialised results."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession


def get_session(app: str = "tallywork", master: str | None = None, **conf: str) -> SparkSession:
    """A session with adaptive execution, skew-join splitting and UTC time."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        # recording the call site of every column expression doubles the time to build a plan
        "spark.python.sql.dataFrameDebugging.enabled": "false",
        **conf,
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession, purpose: str) -> str:
    """A fresh folder under ``spark.checkpoint.dir``, else under the warehouse.

    Every executor must be able to reach either of them; the rule is the same for every master.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.sql.warehouse.dir")
    return f"{root.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"


def drop_at_exit(spark: SparkSession, folder: str) -> None:
    """Delete a written folder when the driver ends, on whatever file system it is."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(path)


def materialise(df: DataFrame, purpose: str) -> DataFrame:
    """Write a base that several results start from, and read it back.

    The table sits in the shared folder, so it outlives any executor and is computed once. It goes with the driver.
    """
    path = shared_dir(df.sparkSession, purpose)
    df.write.parquet(path)
    drop_at_exit(df.sparkSession, path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def range_count(spark: SparkSession) -> int:
    """How many value ranges to split an ordered computation into.

    A power of two at or above the shuffle width, so a wider cluster gets more,
    smaller ranges without any change in the queries.
    """
    width = int(spark.conf.get("spark.sql.shuffle.partitions", "200"))
    return 1 << max(3, (width - 1).bit_length())
