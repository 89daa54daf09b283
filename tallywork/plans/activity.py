"""Traffic, advertising and sensor metrics on event tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions.columns import double, ratio
from ..operators.series import moving_mean
from ..operators.tables import share_of_all


def daily_traffic(ev: DataFrame) -> DataFrame:
    """Events, users and value per day. Users are counted in two steps, day and user first."""
    per_user = ev.groupBy("day", "user_id").agg(
        F.count("*").alias("n"), F.sum(F.col("value").cast("decimal(15,2)")).alias("v")
    )
    return per_user.groupBy("day").agg(
        F.sum("n").alias("sessions"), F.count("*").alias("users"), F.sum("v").alias("revenue")
    )


def weekday_means(daily: DataFrame, value: str) -> DataFrame:
    """Mean per weekday, 0 for Monday to 6 for Sunday."""
    return (
        daily.groupBy(F.weekday("day").cast("bigint").alias("weekday"))
        .agg(F.count("*").alias("days"), F.avg(double(value)).alias("mean"))
        .orderBy("weekday")
    )


def funnel(campaigns: DataFrame, by: str = "channel") -> DataFrame:
    """Click, conversion and cost ratios per channel. Totals are divided, ratios never averaged."""
    sums = campaigns.groupBy(by).agg(
        *[F.sum(c).alias(c) for c in ("impressions", "clicks", "conversions", "cost", "revenue")]
    )
    return sums.withColumns(
        {
            "ctr": ratio("clicks", "impressions"),
            "cvr": ratio("conversions", "clicks"),
            "cpc": ratio("cost", "clicks"),
            "cpa": ratio("cost", "conversions"),
            "roas": ratio("revenue", "cost"),
        }
    )


def funnel_advice(table: DataFrame, by: str = "channel") -> DataFrame:
    """Weakest channel after the click, dearest conversion, and where budget should move from and to."""
    pick = lambda f, measure: f(by, F.struct(measure, by))
    return table.agg(
        pick(F.min_by, "cvr").alias("lowest_cvr"),
        pick(F.max_by, "cpa").alias("highest_cpa"),
        pick(F.min_by, "roas").alias("move_from"),
        pick(F.max_by, "roas").alias("move_to"),
    )


def daily_roas(campaigns: DataFrame, days: int = 7) -> DataFrame:
    """Daily cost, revenue and return per channel, smoothed, with each channel's worst day marked."""
    daily = campaigns.select("day", "channel", "cost", "revenue", ratio("revenue", "cost").alias("roas"))
    smooth = moving_mean(daily, ["channel"], "day", "roas", days, "roas_mean")
    # one row per day and channel, so a channel is no longer than the calendar
    lowest = F.min(F.when(F.col("roas").isNotNull(), F.struct("roas", "day")))
    return smooth.withColumn("worst_day", lowest.over(Window.partitionBy("channel"))["day"]).withColumn(
        "is_worst", F.coalesce(F.col("day") == F.col("worst_day"), F.lit(False)).cast("int")
    )


def tally(df: DataFrame, label: Column, out: str = "label") -> DataFrame:
    """Counts and shares of a label computed per row."""
    counts = df.groupBy(label.alias(out)).agg(F.count("*").alias("n"))
    return share_of_all(counts, "n")
