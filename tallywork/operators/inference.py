"""A/B comparison and other tests, from one aggregation each.

The data-heavy part of every test is a grouped aggregate of counts, means and variances; the
statistic is a column expression on that row and the p-value a small UDF on it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions.columns import double, ratio
from ..functions.stats import (
    ALPHA,
    CHI2_1_95,
    Z_95,
    chi2_2x2,
    mean_se,
    pooled_z,
    proportion_se,
    share_where,
    welch_df,
    welch_t,
)
from ..functions.tails import chi2_p, normal_p, student_p
from .ordered import running, with_ranges

PROMOTER_FROM = 9  # fixed values: recommendation scores that make a promoter / a detractor
DETRACTOR_TO = 6


def arm_table(df: DataFrame, arm: str, flag: str) -> DataFrame:
    """Size, conversions, rate and its 95 % interval per arm."""
    base = df.where(F.col(arm).isNotNull()).groupBy(arm).agg(
        F.count(flag).alias("n"), F.coalesce(F.sum(flag), F.lit(0)).alias("conversions")
    )
    rate = base.withColumn("rate", ratio("conversions", "n"))
    reach = Z_95 * proportion_se(F.col("rate"), F.col("n"))
    return rate.withColumns({"low": F.col("rate") - reach, "high": F.col("rate") + reach})


def mean_interval(df: DataFrame, value: str, by: Sequence[str] = ()) -> DataFrame:
    """Mean with standard error and 95 % interval per group."""
    x = double(value)
    kept = df
    for c in by:
        kept = kept.where(F.col(c).isNotNull())
    base = kept.groupBy(*by).agg(
        F.count(x).alias("n"), F.avg(x).alias("mean"), F.stddev_samp(x).alias("sd")
    ).withColumn("se", mean_se(F.col("sd"), F.col("n")))
    reach = Z_95 * F.col("se")
    return base.withColumns({"low": F.col("mean") - reach, "high": F.col("mean") + reach})


def _arm_counts(arm: str, flag: str, a: object, b: object) -> list[Column]:
    out = []
    for name, level in (("a", a), ("b", b)):
        here = F.col(arm) == level
        out.append(F.count(F.when(here, F.col(flag))).alias(f"n_{name}"))
        out.append(F.coalesce(F.sum(F.when(here, F.col(flag))), F.lit(0)).alias(f"x_{name}"))
    return out


def lift(
    df: DataFrame, arm: str, flag: str, a: object, b: object, visits: int, order_value: float
) -> DataFrame:
    """Rate difference, relative lift, and what it means in conversions and money."""
    one = df.agg(*_arm_counts(arm, flag, a, b))
    rates = one.withColumns({"rate_a": ratio("x_a", "n_a"), "rate_b": ratio("x_b", "n_b")})
    diff = F.col("rate_b") - F.col("rate_a")
    return rates.withColumns(
        {
            "difference": diff,
            "lift": ratio(diff, F.col("rate_a")),
            "extra_conversions": diff * visits,
            "extra_revenue": diff * visits * order_value,
        }
    )


def welch_test(
    df: DataFrame, arm: str, value: str, a: object, b: object, by: Sequence[str] = ()
) -> DataFrame:
    """Two-sample t test with unequal variances: a against b."""
    x = double(value)
    parts = []
    for name, level in (("a", a), ("b", b)):
        v = F.when(F.col(arm) == level, x)
        parts += [
            F.count(v).alias(f"n_{name}"),
            F.avg(v).alias(f"mean_{name}"),
            F.var_samp(v).alias(f"var_{name}"),
        ]
    one = df.groupBy(*by).agg(*parts)
    c = F.col
    return (
        one.withColumn("t", welch_t(c("mean_a"), c("var_a"), c("n_a"), c("mean_b"), c("var_b"), c("n_b")))
        .withColumn("df", welch_df(c("var_a"), c("n_a"), c("var_b"), c("n_b")))
        .withColumn("p", student_p("t", "df"))
        .withColumn("significant", (c("p") < ALPHA).cast("int"))
    )


def two_proportion_test(df: DataFrame, arm: str, flag: str, a: object, b: object) -> DataFrame:
    """Pooled two-proportion z test of b against a."""
    one = df.agg(*_arm_counts(arm, flag, a, b))
    return (
        one.withColumn("z", pooled_z(F.col("x_a"), F.col("n_a"), F.col("x_b"), F.col("n_b")))
        .withColumn("p", normal_p("z"))
        .withColumn("significant", (F.col("p") < ALPHA).cast("int"))
    )


def arm_chi2(df: DataFrame, arm: str, flag: str, a: object, b: object, by: Sequence[str] = ()) -> DataFrame:
    """Chi-square of arm against a 0/1 flag, with and without the 2x2 correction."""
    one = df.groupBy(*by).agg(*_arm_counts(arm, flag, a, b))
    cells = (F.col("n_a") - F.col("x_a"), F.col("x_a"), F.col("n_b") - F.col("x_b"), F.col("x_b"))
    return (
        one.withColumn("chi2_plain", chi2_2x2(*cells, yates=False))
        .withColumn("chi2", chi2_2x2(*cells))
        .withColumn("dof", F.lit(1).cast("bigint"))
        .withColumn("p", chi2_p(F.col("chi2"), double("dof")))
        .withColumn("significant", (F.col("p") < ALPHA).cast("int"))
    )


def contingency(df: DataFrame, a: str, b: str) -> DataFrame:
    """Observed and expected count of every cell that occurs, in long form."""
    cells = (
        df.where(F.col(a).isNotNull() & F.col(b).isNotNull())
        .groupBy(a, b)
        .agg(F.count("*").alias("observed"))
    )
    rows = cells.groupBy(a).agg(F.sum("observed").alias("row_total"))
    cols = cells.groupBy(b).agg(F.sum("observed").alias("column_total"))
    whole = cells.agg(F.sum("observed")).scalar()
    return (
        cells.join(rows, a)
        .join(cols, b)
        .withColumn("all_rows", whole)
        .withColumn(
            "expected", double("row_total") * double("column_total") / double("all_rows")
        )
    )


def chi2_test(df: DataFrame, a: str, b: str) -> DataFrame:
    """Independence of two categories with any number of levels.

    Uses sum(observed^2 / expected) - n, in which cells that never occur add nothing, so the full
    grid of level pairs is not needed. Two levels by two get the usual continuity correction, for
    which the common distance |ad - bc| follows from any one cell.
    """
    cells = contingency(df, a, b)
    summed = cells.agg(
        F.count_distinct(a).alias("row_levels"),
        F.count_distinct(b).alias("column_levels"),
        F.max("all_rows").alias("n"),
        F.sum(double("observed") * double("observed") / F.col("expected")).alias("_s"),
        F.max(F.abs(double("observed") - F.col("expected"))).alias("_gap"),
        F.max(double("row_total")).alias("_row"),
        F.max(double("column_total")).alias("_col"),
    )
    n = double("n")
    two = (F.col("row_levels") == 2) & (F.col("column_levels") == 2)
    gap = F.col("_gap") - F.least(F.lit(0.5), F.col("_gap"))
    spread = F.col("_row") * (n - F.col("_row")) * F.col("_col") * (n - F.col("_col"))
    corrected = F.try_divide(gap * gap * n * n * n, spread)
    return (
        summed.withColumn("chi2_plain", F.col("_s") - n)
        .withColumn("chi2", F.when(two, corrected).otherwise(F.col("chi2_plain")))
        .withColumn("dof", (F.col("row_levels") - 1) * (F.col("column_levels") - 1))
        .withColumn("p", chi2_p(F.col("chi2"), double("dof")))
        .withColumn("significant", (F.col("p") < ALPHA).cast("int"))
        .select("row_levels", "column_levels", "n", "chi2_plain", "chi2", "dof", "p", "significant")
    )


def bonferroni(
    df: DataFrame, segment: str, arm: str, flag: str, a: object, b: object
) -> DataFrame:
    """Arm test per segment, judged at alpha divided by the number of segments tested."""
    tests = arm_chi2(df.where(F.col(segment).isNotNull()), arm, flag, a, b, [segment])
    # the sums keep the counted frame equal to the tested one, so that they share a shuffle
    sizes = tests.agg(F.struct(F.count("*").alias("k"), *[F.sum(c).alias(c) for c in ("n_a", "x_a", "n_b", "x_b")]))
    return tests.withColumn("limit", F.lit(ALPHA) / sizes.scalar()["k"]).withColumn(
        "significant", (F.col("p") < F.col("limit")).cast("int")
    )


def sequential_looks(
    df: DataFrame, look: str, arm: str, flag: str, a: object, b: object
) -> DataFrame:
    """Chi-square on everything seen up to each look, marking the first one past the 5 % limit.

    Looks are periods, so the ordered part runs on one row per period.
    """
    counts = df.groupBy(look, arm).agg(F.count(flag).alias("n"), F.sum(flag).alias("x"))
    return looks_from_counts(counts, look, arm, a, b)


def looks_from_counts(counts: DataFrame, look: str, arm: str, a: object, b: object) -> DataFrame:
    """The same from counts per look and arm: ``look, arm, n, x``."""

    def of(level: object, what: str) -> Column:
        return F.coalesce(F.sum(F.when(F.col(arm) == level, F.col(what))), F.lit(0))

    daily = counts.groupBy(look).agg(
        of(a, "n").alias("n_a"), of(a, "x").alias("x_a"), of(b, "n").alias("n_b"), of(b, "x").alias("x_b")
    )
    w = Window.partitionBy(F.lit(0)).orderBy(look).rowsBetween(Window.unboundedPreceding, 0)
    cum = daily.select(look, *[F.sum(c).over(w).alias(c) for c in ("n_a", "x_a", "n_b", "x_b")])
    cells = (F.col("n_a") - F.col("x_a"), F.col("x_a"), F.col("n_b") - F.col("x_b"), F.col("x_b"))
    tested = cum.withColumn("chi2", chi2_2x2(*cells))
    past = F.coalesce(F.col("chi2") > CHI2_1_95, F.lit(False))
    first = tested.where(past).agg(F.min(look)).scalar()
    return tested.withColumn("crossed", past.cast("int")).withColumn(
        "first_crossing", F.coalesce(F.col(look) == first, F.lit(False)).cast("int")
    )


def chunk_means(df: DataFrame, order: Sequence[str], value: str, size: int) -> DataFrame:
    """Spread of the means of consecutive chunks against sd / sqrt(size).

    Only full chunks enter. The row position is computed range by range, never in one task.
    """
    numbered = running(with_ranges(df.select(*order, value), order), [], order, "bucket")
    means = (
        numbered.groupBy(F.floor((F.col("position") - 1) / size).alias("chunk"))
        .agg(F.count(value).alias("k"), F.avg(value).alias("m"))
        .where(F.col("k") == size)
    )
    spread = means.agg(
        F.count("*").alias("chunks"), F.avg("m").alias("mean_of_means"), F.stddev_samp("m").alias("sd_of_means")
    )
    theory = df.agg(F.stddev_samp(value) / F.sqrt(F.lit(float(size)))).scalar()
    return spread.withColumn("theory", theory).withColumn("ratio", ratio("sd_of_means", "theory"))


def nps(df: DataFrame, score: str, by: str | None = None, total: str | None = None) -> DataFrame:
    """Share of promoters minus share of detractors, times 100; missing scores leave the base.

    With ``total`` the segments and the whole, under that label, come from one pass.
    """
    s = F.col(score)
    measures = [
        F.count(score).alias("n"),
        share_where(s >= PROMOTER_FROM).alias("promoters"),
        share_where(s <= DETRACTOR_TO).alias("detractors"),
    ]
    if by is None:
        out = df.agg(*measures)
    elif total is None:
        out = df.where(F.col(by).isNotNull()).groupBy(by).agg(*measures)
    else:
        rolled = df.rollup(by).agg(F.grouping(by).alias("_all"), *measures)
        label = F.when(F.col("_all") == 1, F.lit(total)).otherwise(F.col(by))
        out = rolled.withColumn(by, label).where(F.col(by).isNotNull()).drop("_all")
    return out.withColumn("nps", (F.col("promoters") - F.col("detractors")) * 100)


def stratified_gap(
    df: DataFrame, stratum: str, group: str, value: str, a: object, b: object
) -> DataFrame:
    """Difference of group means overall and inside each stratum, flagging reversed signs."""
    x = double(value)
    sums = []
    for name, level in (("a", a), ("b", b)):
        here = F.when(F.col(group) == level, x)
        sums += [F.sum(here).alias(f"s_{name}"), F.count(here).alias(f"k_{name}")]
    cells = df.groupBy(stratum).agg(*sums)

    def gap(total=lambda c: F.col(c)) -> Column:
        return ratio(total("s_b"), total("k_b")) - ratio(total("s_a"), total("k_a"))

    return (
        cells.where(F.col(stratum).isNotNull())
        .select(stratum, gap().alias("gap"), cells.agg(gap(F.sum)).scalar().alias("overall_gap"))
        .withColumn(
            "reversed",
            F.coalesce(F.signum("gap") * F.signum("overall_gap") < 0, F.lit(False)).cast("int"),
        )
    )
