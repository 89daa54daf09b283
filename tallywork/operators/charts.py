"""The small frames behind charts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.columns import double, equal_width_bin
from .ordered import value_groups
from .outliers import fences
from .profile import with_scalars
from .tables import spread_join


def histogram(df: DataFrame, value: str, bins: int) -> DataFrame:
    """Equal-width bins from minimum to maximum, empty bins included."""
    x = double(value)
    edges = df.agg(F.min(x).alias("low"), F.max(x).alias("high"))
    counts = (
        with_scalars(df.select(value).where(x.isNotNull()), edges)
        .groupBy(equal_width_bin(value, F.col("low"), F.col("high"), bins).alias("bin"))
        .agg(F.count("*").alias("n"))
    )
    width = (F.col("high") - F.col("low")) / bins
    frame = with_scalars(df.sparkSession.range(1, bins + 1).toDF("bin"), edges)
    return (
        frame.join(counts, "bin", "left")
        .select(
            "bin",
            (F.col("low") + (F.col("bin") - 1) * width).alias("left_edge"),
            (F.col("low") + F.col("bin") * width).alias("right_edge"),
            F.coalesce("n", F.lit(0)).alias("n"),
        )
    )


def box_stats(df: DataFrame, value: str, by: Sequence[str]) -> DataFrame:
    """Quartiles, whisker ends (last datum inside the fences) and outlier count per group."""
    counts = value_groups(df, value, by)
    lines = fences(df, value, by).drop("n").withColumnRenamed("q1", "_q1").withColumnRenamed("q3", "_q3")
    x = double(value)
    inside = (x >= F.col("lower")) & (x <= F.col("upper"))
    return (
        spread_join(counts, lines, by, counts.withColumn("_one", F.lit(1)), "_one")
        .groupBy(*by)
        .agg(
            F.max("_q1").alias("q1"),
            F.max("_q3").alias("q3"),
            F.min(F.when(inside, x)).alias("whisker_low"),
            F.max(F.when(inside, x)).alias("whisker_high"),
            F.sum(F.when(inside, F.lit(0)).otherwise(F.col("n"))).alias("outliers"),
            F.sum("n").alias("n"),
        )
    )


def grid_counts(df: DataFrame, x: str, y: str, bins: int) -> DataFrame:
    """Scatter plot reduced to counts on a bins-by-bins grid; empty cells are left out."""
    a, b = double(x), double(y)
    both = df.select(x, y).where(a.isNotNull() & b.isNotNull())
    edges = both.agg(
        F.min(a).alias("x_low"), F.max(a).alias("x_high"), F.min(b).alias("y_low"), F.max(b).alias("y_high")
    )
    return (
        with_scalars(both, edges)
        .groupBy(
            equal_width_bin(x, F.col("x_low"), F.col("x_high"), bins).alias("x_bin"),
            equal_width_bin(y, F.col("y_low"), F.col("y_high"), bins).alias("y_bin"),
        )
        .agg(F.count("*").alias("n"))
    )


def mix(df: DataFrame, row: str, part: str, measure: Column) -> DataFrame:
    """Stacked composition in long form, with each row's total for ordering the bars."""
    cells = (
        df.where(F.col(row).isNotNull() & F.col(part).isNotNull())
        .groupBy(row, part)
        .agg(measure.alias("amount"))
    )
    totals = cells.groupBy(row).agg(F.sum("amount").alias("row_total"))
    return cells.join(totals, row).orderBy(F.col("row_total").desc(), row, part)
