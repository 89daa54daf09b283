"""Event tables read as the daily-traffic, A/B, advertising and sensor shapes."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from .files import read_parquet


def events(spark: SparkSession, folder: str) -> DataFrame:
    """``event_id, ts, day, user_id, kind, value``."""
    return shape_events(read_parquet(spark, folder, "events"))


def shape_events(raw: DataFrame) -> DataFrame:
    return raw.select(
        "event_id",
        "ts",
        F.col("ts").cast("date").alias("day"),
        "user_id",
        F.col("event_type").alias("kind"),
        "value",
    )


def arms(ev: DataFrame) -> DataFrame:
    """A/B view: one row per event with its arm and whether it is a conversion."""
    return ev.withColumn("arm", F.when(F.col("user_id") % 2 == 0, "A").otherwise("B")).withColumn(
        "converted", (F.col("kind") == "purchase").cast("int")
    )


def readings(ev: DataFrame) -> DataFrame:
    """Sensor view: value per machine and time, missing and faulty where the event is an error."""
    fault = F.col("kind") == "error"
    return ev.select(
        F.concat(F.lit("M-0"), (F.col("user_id") % 4 + 1).cast("string")).alias("machine_id"),
        "ts",
        "day",
        "event_id",
        F.when(~fault, F.col("value")).alias("reading"),
        F.col("value").alias("raw_reading"),
        fault.cast("int").alias("defect"),
        *(["at"] if "at" in ev.columns else []),
    )


def campaigns(ev: DataFrame) -> DataFrame:
    """Advertising view, one row per day and channel.

    Views are impressions; clicks cost their value; purchases earn theirs.
    """

    def of(kind: str, x):
        return F.sum(F.when(F.col("kind") == kind, x).otherwise(F.lit(0)))

    money = F.col("value").cast("decimal(15,2)")
    zero = F.lit(0).cast("decimal(15,2)")
    pay = lambda kind: F.sum(F.when(F.col("kind") == kind, money).otherwise(zero))
    return (
        ev.withColumn("channel", F.concat(F.lit("ch"), (F.col("user_id") % 5).cast("string")))
        .groupBy("day", "channel")
        .agg(
            of("view", F.lit(1)).alias("impressions"),
            of("click", F.lit(1)).alias("clicks"),
            of("purchase", F.lit(1)).alias("conversions"),
            pay("click").alias("cost"),
            pay("purchase").alias("revenue"),
        )
    )
