"""Event analyses on a stream.

Each run reads what is there (``availableNow``) in bounded micro-batches. State holds aggregates
only, never events. Results and checkpoints go to the shared folder, so a restarted run goes on
where the lost one stopped.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from threading import Event

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.streaming import StreamingQueryListener

from ..functions.columns import double
from ..operators.inference import looks_from_counts
from ..operators.outliers import SIGMAS
from ..session import drop_at_exit, shared_dir
from ..sources.activity import arms, readings, shape_events
from ..sources.files import inline, read_parquet

FILES_PER_BATCH = 1_000
_LAST_EVENT = 120.0  # seconds that the account of an ended stream may take to arrive


def event_stream(spark: SparkSession, folder: str, late: str | None = None) -> DataFrame:
    """The event table as a stream with event time ``at``; ``late`` is the watermark delay."""
    # the bracket makes the path a pattern, which fits one file as well as a folder of files
    raw = (
        spark.readStream.schema(read_parquet(spark, folder, "events").schema)
        .option("maxFilesPerTrigger", FILES_PER_BATCH)
        .parquet(f"{folder.rstrip('/')}/events.parque[t]")
    )
    stream = shape_events(raw).withColumn("at", as_utc("ts"))
    return stream.withWatermark("at", late) if late else stream


def as_utc(ts: str) -> Column:
    """The instant at which a clock in UTC shows a time without zone, whatever the session's zone is."""
    seconds = F.unix_date(F.col(ts).cast("date")).cast("bigint") * 86_400 + F.hour(ts) * 3_600 + F.minute(ts) * 60
    rest = (F.extract(F.lit("SECOND"), F.col(ts)) * 1_000_000).cast("bigint")
    return F.timestamp_micros(seconds * 1_000_000 + rest)


def utc_day(instant: Column) -> Column:
    """The date of an instant in UTC."""
    return F.date_from_unix_date(F.floor(F.unix_seconds(instant) / 86_400).cast("int"))


def daily_counts(stream: DataFrame) -> DataFrame:
    """Events and value per UTC day and kind. With a watermark, a closed day can be appended and forgotten."""
    return (
        stream.groupBy(F.window("at", "1 day").alias("w"), "kind")
        .agg(F.count("*").alias("n"), F.sum(F.col("value").cast("decimal(15,2)")).alias("amount"))
        .select(utc_day(F.col("w.start")).alias("day"), "kind", "n", "amount")
    )


def sliding_week(days: DataFrame) -> DataFrame:
    """Events and mean value per kind over seven days from each day, from daily counts.

    The stream keeps one row per day and kind; only these are copied into the seven weeks they lie in.
    """
    return (
        days.withColumn("first_day", F.explode(F.transform(F.sequence(F.lit(0), F.lit(6)), lambda k: F.date_sub("day", k))))
        .groupBy("first_day", "kind")
        .agg(F.sum("n").alias("n"), F.sum("amount").alias("_s"))
        .select("first_day", "kind", "n", (double("_s") / F.col("n")).alias("mean_value"))
    )


def sensor_baseline(history: DataFrame) -> DataFrame:
    """Mean and standard deviation per machine; one row per machine."""
    return readings(history).groupBy("machine_id").agg(
        F.avg("reading").alias("mean"), F.stddev_samp("reading").alias("sd")
    )


def flag_readings(stream: DataFrame, baseline: DataFrame) -> DataFrame:
    """Readings more than three standard deviations from their machine's baseline. Stateless.

    The baseline should be a written table: a plan over the history would read it again in every batch.
    """
    x = double("reading")
    return (
        readings(stream)
        .join(baseline, "machine_id")
        .where(F.abs(x - F.col("mean")) > SIGMAS * F.col("sd"))
        .select("machine_id", "event_id", "ts", "reading", *(["at"] if "at" in stream.columns else []))
    )


def hourly_flags(flagged: DataFrame) -> DataFrame:
    """Flagged readings per machine and hour, of readings that carry their event time ``at``."""
    return (
        flagged.groupBy(F.window("at", "1 hour").alias("w"), "machine_id")
        .agg(F.count("*").alias("flags"), F.max("reading").alias("highest"))
        .select("machine_id", F.floor(F.unix_seconds("w.start") / 3_600).alias("epoch_hour"), "flags", "highest")
    )


def arm_counts(stream: DataFrame) -> DataFrame:
    """Size and conversions per day and arm."""
    return arms(stream).groupBy("day", "arm").agg(
        F.count("*").alias("n"), F.sum("converted").alias("x")
    )


def arm_looks(counts: DataFrame) -> DataFrame:
    """Cumulative chi-square per day from day-by-arm counts."""
    return looks_from_counts(counts, "day", "arm", "A", "B")


def settle(stream: DataFrame, name: str, finish: Callable[[DataFrame], DataFrame] = lambda d: d) -> DataFrame:
    """Run an aggregate stream over what is there; return its complete result.

    Every batch replaces the result as a whole, so a replayed batch does no harm.
    """
    spark = stream.sparkSession
    base = shared_dir(spark, name)

    def replace(batch: DataFrame, _epoch: int) -> None:
        finish(batch).write.mode("overwrite").parquet(f"{base}/result")

    replace(spark.createDataFrame([], stream.schema), -1)  # what a stream without events leaves
    drop_at_exit(spark, base)
    run = (
        stream.writeStream.outputMode("complete")
        .option("checkpointLocation", f"{base}/state")
        .foreachBatch(replace)
        .trigger(availableNow=True)
        .start()
    )
    run.awaitTermination()
    return spark.read.parquet(f"{base}/result")


def upkeep(stream: DataFrame, base: str, by: Sequence[str], sums: Mapping[str, Column], part: str) -> DataFrame:
    """Bring a table of sums per key up to date with what the stream has, rewriting only what a batch touches.

    No state is kept: each batch writes its own sums to ``base/parts/batch=N`` and then adds up anew, from the parts
    of all batches, the partitions of ``base/table`` (one per value of the column ``part``, which is one of ``by``)
    that it has rows of. Both are overwritten as a whole, so a batch that is replayed changes nothing, and a row
    counts however late it comes. The next run with the same ``base`` goes on where this one stopped.
    """
    spark = stream.sparkSession
    own = stream.groupBy(*by).agg(*[e.alias(n) for n, e in sums.items()]).schema

    def fold(batch: DataFrame, number: int) -> None:
        mine = batch.groupBy(*by).agg(*[e.alias(n) for n, e in sums.items()])
        mine.write.mode("overwrite").partitionBy(part).parquet(f"{base}/parts/batch={number}")
        session = batch.sparkSession
        parts = session.read.schema(T.StructType([*own.fields, T.StructField("batch", T.LongType())])).parquet(f"{base}/parts")
        touched = parts.where(F.col("batch") == number).select(F.col(part).alias("_touched")).distinct()
        whole = parts.join(touched, F.col(part).eqNullSafe(F.col("_touched")), "left_semi").groupBy(*by).agg(*[F.sum(n).alias(n) for n in sums])
        writer = whole.select(*own.names).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        writer.partitionBy(part).parquet(f"{base}/table")

    run = stream.writeStream.option("checkpointLocation", f"{base}/state").foreachBatch(fold).trigger(availableNow=True).start()
    run.awaitTermination()
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{base}/table")
    if not path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path):
        return inline(spark, [], own)
    widened = [T.StructField(f.name, T.DecimalType(38, f.dataType.scale) if isinstance(f.dataType, T.DecimalType) else f.dataType) for f in own.fields]
    return spark.read.schema(T.StructType(widened)).parquet(f"{base}/table")


class _Dropped(StreamingQueryListener):
    """Rows that one query drops behind its watermark, added up as its batches end."""

    def __init__(self, name: str):
        self.name, self.run, self.rows, self.ended = name, None, 0, Event()

    def onQueryStarted(self, event) -> None:
        if event.name == self.name:
            self.run = event.runId

    def onQueryProgress(self, event) -> None:
        if event.progress.name == self.name:
            self.rows += sum(op.numRowsDroppedByWatermark for op in event.progress.stateOperators)

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        if event.runId == self.run:
            self.ended.set()


def drain(stream: DataFrame, name: str, whole: bool = False) -> DataFrame:
    """Run an append-only stream over what is there into Parquet; return the rows written.

    ``whole`` is for the replay of a whole table, of which no row may be lost: it fails when rows came behind the
    watermark and were dropped.
    """
    spark = stream.sparkSession
    base = shared_dir(spark, name)
    dropped = _Dropped(base.rpartition("/")[2])
    if whole:
        spark.streams.addListener(dropped)
    try:
        run = (
            stream.writeStream.outputMode("append")
            .queryName(dropped.name)
            .format("parquet")
            .option("path", f"{base}/rows")
            .option("checkpointLocation", f"{base}/state")
            .trigger(availableNow=True)
            .start()
        )
        run.awaitTermination()
        drop_at_exit(spark, base)
        if whole and not dropped.ended.wait(_LAST_EVENT):
            raise TimeoutError("Spark did not tell the end of a stream")
    finally:
        if whole:
            spark.streams.removeListener(dropped)
    if dropped.rows:
        raise ValueError(f"{dropped.rows} rows or partial sums came behind the watermark; files must be in time order within the delay")
    return spark.read.schema(stream.schema).parquet(f"{base}/rows")
