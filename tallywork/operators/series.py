"""Time series: calendar totals, period change, indices, returns."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions.columns import ratio


def change(df: DataFrame, by: Sequence[str], order: str, value: str, out: str, lag: int = 1) -> DataFrame:
    """Relative change against the row ``lag`` periods back. For period-level rows."""
    w = Window.partitionBy(*(list(by) or [F.lit(0)])).orderBy(order)
    return df.withColumn(out, ratio(F.col(value), F.lag(value, lag).over(w)) - 1)


def running_total(df: DataFrame, by: Sequence[str], order: str, value: str, out: str) -> DataFrame:
    """Cumulative sum over period-level rows (months or days, so bounded by the calendar)."""
    w = (
        Window.partitionBy(*(list(by) or [F.lit(0)]))
        .orderBy(order)
        .rowsBetween(Window.unboundedPreceding, 0)
    )
    return df.withColumn(out, F.sum(value).over(w))


def moving_mean(df: DataFrame, by: Sequence[str], order: str, value: str, rows: int, out: str) -> DataFrame:
    """Mean of the last ``rows`` period rows, fewer at the start; NULLs are skipped."""
    w = Window.partitionBy(*(list(by) or [F.lit(0)])).orderBy(order).rowsBetween(-(rows - 1), 0)
    return df.withColumn(out, F.avg(value).over(w))


def calendar(df: DataFrame, column: str, step: str) -> DataFrame:
    """All periods from the first to the last date of ``column``: ``step`` is ``day`` or ``month``."""
    low, high = F.min(column).cast("date"), F.max(column).cast("date")
    if step == "month":
        low, high = F.trunc(low, "month"), F.trunc(high, "month")
    gap = F.expr(f"interval 1 {step}")
    return df.agg(F.sequence(low, high, gap).alias("_all")).select(F.explode("_all").alias("period"))


def month_totals(df: DataFrame, date: str, measures: dict[str, Column]) -> DataFrame:
    """Totals per calendar month, including months without any row (as zero)."""
    sums = (
        df.where(F.col(date).isNotNull())
        .groupBy(F.trunc(date, "month").alias("period"))
        .agg(*[F.sum(e).alias(k) for k, e in measures.items()])
    )
    return calendar(df, date, "month").join(sums, "period", "left").na.fill(0, subset=list(measures))


def returns(df: DataFrame, series: str, order: str, price: str) -> DataFrame:
    """Period returns per series; the first period of each series has none."""
    return change(df, [series], order, price, "r").where(F.col("r").isNotNull())


def complete_periods(rets: DataFrame, series: str, order: str) -> DataFrame:
    """Keep the periods in which every series has a return."""
    width = rets.agg(F.count_distinct(series)).scalar()
    full = rets.groupBy(order).agg(F.count_distinct(series).alias("_w")).where(F.col("_w") == width)
    return rets.join(full.select(order), order)


def risk(rets: DataFrame, series: str) -> DataFrame:
    return rets.groupBy(series).agg(
        F.count("r").alias("periods"), F.avg("r").alias("mean_return"), F.stddev_samp("r").alias("volatility")
    )


def growth_index(rets: DataFrame, series: str, order: str, out: str = "growth") -> DataFrame:
    """Compounded growth of one unit since the first period."""
    w = Window.partitionBy(series).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    return rets.withColumn(out, F.product(1 + F.col("r")).over(w))


def pair_correlations(rets: DataFrame, series: str, order: str, names: Sequence[str]) -> DataFrame:
    """Correlation of returns for every pair of named series, from one pass over the wide rows."""
    wide = rets.groupBy(order).pivot(series, list(names)).agg(F.max("r"))
    pairs = [(a, b) for i, a in enumerate(names) for b in names[i + 1 :]]
    cells = F.array(
        *[
            F.struct(F.lit(a).alias("a"), F.lit(b).alias("b"), F.corr(f"`{a}`", f"`{b}`").alias("r"))
            for a, b in pairs
        ]
    )
    return wide.na.drop().agg(cells.alias("c")).select(F.explode("c").alias("c")).select("c.*")
