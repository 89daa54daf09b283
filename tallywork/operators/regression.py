"""Correlation, simple and multiple least squares.

Every fit is one aggregation of means and covariances. The multiple fit then solves a small system
per aggregate row in a pandas UDF; the data itself never leaves the JVM.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence
from functools import reduce
from itertools import combinations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F, types as T

from ..functions.columns import double
from ..functions.tails import student_p
from .ordered import quantiles
from .profile import with_scalars
from .tables import known_level


WIDE = 24  # columns; beyond them one aggregate per pair makes more code than a JVM compiles
BATCH_CELLS = 1 << 22  # numbers of a batch that are multiplied at a time


def correlations(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Full correlation matrix in long form (a, b, r); NULLs are skipped pair by pair.

    Narrow tables take one aggregate per pair, wide ones products of whole batches; both read the table's
    columns alike and leave out the same rows.
    """
    if len(columns) > WIDE:
        return _wide_correlations(df, columns)
    pairs = list(combinations(columns, 2))
    one = df.agg(*[F.corr(double(a), double(b)).alias(f"r{i}") for i, (a, b) in enumerate(pairs)])

    def cell(a: str, b: str, r: Column) -> Column:
        return F.struct(F.lit(a).alias("a"), F.lit(b).alias("b"), r.alias("r"))

    cells = [cell(c, c, F.lit(1.0)) for c in columns]
    for i, (a, b) in enumerate(pairs):
        cells += [cell(a, b, F.col(f"r{i}")), cell(b, a, F.col(f"r{i}"))]
    return one.select(F.explode(F.array(*cells)).alias("c")).select("c.*")


def _wide_correlations(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Counts, sums and products of all pairs as matrix products, batch by batch, added up in Spark.

    Values are taken less their column's mean, known from a first pass, so the sums of squares keep their digits.
    A NULL is a zero with a mask; products of values and masks give each pair the sums over its common rows.
    """
    k = len(columns)
    plain = df.select(F.array(*[double(c) for c in columns]).alias("x"))
    means = df.agg(F.array(*[F.avg(double(c)) for c in columns]).alias("m")).scalar()
    shifted = plain.withColumn("m", means).select(F.zip_with("x", "m", lambda x, m: x - m).alias("x"))
    upper = np.triu_indices(k, 1)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros((6, k, k))
        for batch in batches:
            step = max(1, BATCH_CELLS // k)
            for at in range(0, len(batch), step):
                x = np.array(batch["x"].iloc[at : at + step].tolist(), float).reshape(-1, k)
                known = np.isfinite(x)
                x, one = np.where(known, x, 0.0), known.astype(float)
                by_x, by_square = x.T @ one, (x * x).T @ one
                total += np.stack([one.T @ one, by_x, by_x.T, by_square, by_square.T, x.T @ x])
        yield pd.DataFrame({"i": upper[0], "j": upper[1], **{f"s{q}": total[q][upper] for q in range(6)}})

    sums = ", ".join(f"s{q} double" for q in range(6))
    made = shifted.mapInPandas(run, f"i int, j int, {sums}")
    made = made.groupBy("i", "j").agg(*[F.sum(f"s{q}").alias(f"s{q}") for q in range(6)])
    n, x, y, xx, yy, xy = (F.col(f"s{q}") for q in range(6))
    over = F.sqrt(F.greatest(n * xx - x * x, F.lit(0.0))) * F.sqrt(F.greatest(n * yy - y * y, F.lit(0.0)))
    r = F.when(n > 1, F.try_divide(n * xy - x * y, over))
    names = F.array(*[F.lit(c) for c in columns])
    pair = made.select(F.get(names, F.col("i")).alias("a"), F.get(names, F.col("j")).alias("b"), r.alias("r"))
    same = df.sparkSession.range(1).select(F.explode(names).alias("a")).select("a", F.col("a").alias("b"), F.lit(1.0).alias("r"))
    return pair.unionByName(pair.select(F.col("b").alias("a"), F.col("a").alias("b"), "r")).unionByName(same)


def strongest_pair(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The off-diagonal pair with the largest absolute correlation."""
    return (
        correlations(df, columns)
        .where(F.col("a") < F.col("b"))
        .orderBy(F.abs("r").desc_nulls_last(), "a", "b")
        .limit(1)
    )


def drivers(df: DataFrame, target: str, columns: Sequence[str]) -> DataFrame:
    """Correlation of each column with the target, strongest first."""
    return (
        correlations(df, [target, *columns])
        .where((F.col("a") == target) & (F.col("b") != target))
        .select(F.col("b").alias("driver"), "r")
        .orderBy(F.col("r").desc_nulls_last(), "driver")
    )


def simple_fit(df: DataFrame, x: str, y: str, by: Sequence[str] = ()) -> DataFrame:
    """y on x: slope, intercept, r, r2, standard error of the slope, t and p."""
    one = df.groupBy(*by).agg(
        F.regr_count(double(y), double(x)).alias("n"),
        F.regr_slope(double(y), double(x)).alias("slope"),
        F.regr_intercept(double(y), double(x)).alias("intercept"),
        F.corr(double(y), double(x)).alias("r"),
        F.regr_sxx(double(y), double(x)).alias("_sxx"),
        F.regr_syy(double(y), double(x)).alias("_syy"),
    )
    r2 = F.col("r") * F.col("r")
    dof = double(F.col("n") - 2)
    return (
        one.withColumn("r2", r2)
        .withColumn("stderr", F.sqrt(F.try_divide((1 - r2) * F.col("_syy"), F.col("_sxx") * dof)))
        .withColumn("t", F.try_divide(F.col("slope"), F.col("stderr")))
        .withColumn("p", student_p(F.col("t"), dof))
        .drop("_sxx", "_syy")
    )


def with_residuals(df: DataFrame, x: str, y: str) -> DataFrame:
    """Fitted value and residual of the simple fit beside every row."""
    line = simple_fit(df, x, y).select("slope", "intercept")
    marked = with_scalars(df, line)
    fitted = F.col("intercept") + F.col("slope") * double(x)
    return (
        marked.withColumn("fitted", fitted)
        .withColumn("residual", double(y) - F.col("fitted"))
        .drop("slope", "intercept")
    )


def residual_spread(df: DataFrame, fitted: str, residual: str, bands: int = 10) -> DataFrame:
    """Spread of residuals per band of fitted values, the bands cut at exact quantiles."""
    cuts = {f"c{i}": i / bands for i in range(1, bands)}
    marked = with_scalars(df, quantiles(df, fitted, cuts).drop("n"))
    passed = [(F.col(c) < F.col(fitted)).cast("bigint") for c in cuts]
    return (
        marked.groupBy((reduce(Column.__add__, passed) + 1).alias("band"))
        .agg(F.count("*").alias("n"), F.avg(fitted).alias("mean_fitted"), F.stddev_samp(residual).alias("sd"))
    )


def dummy_columns(column: str, levels: Sequence[str], prefix: str) -> dict[str, Column]:
    """0/1 columns for every level but the alphabetically first, which is the baseline.

    A value that is not among the levels is an error; it would count as the baseline otherwise.
    """
    value = known_level(column, levels, T.StringType())
    return {f"{prefix}_{v}": F.when(value == v, 1.0).otherwise(0.0) for v in sorted(levels)[1:]}


_SOLVED = (
    T.StructType()
    .add("coef", T.ArrayType(T.DoubleType()))
    .add("stderr", T.ArrayType(T.DoubleType()))
    .add("r2", T.DoubleType())
    .add("rank", T.LongType())
)
#: a direction in which the scaled predictors vary by less than this part of their largest spread is no direction
RANK_TOLERANCE = 1e-11


@F.pandas_udf(_SOLVED)
def _solve(
    n: pd.Series, means: pd.Series, cov: pd.Series, y_mean: pd.Series, cov_y: pd.Series, y_var: pd.Series
) -> pd.DataFrame:
    """Intercept and slopes of each aggregate row from its means and covariances."""
    rows = [least_squares(*row) for row in zip(n, means, cov, y_mean, cov_y, y_var)]
    return pd.DataFrame(rows, columns=["coef", "stderr", "r2", "rank"])


def least_squares(n, means, cov, y_mean, cov_y, y_var) -> tuple[list | None, list | None, float | None, int | None]:
    """Coefficients (intercept first), their standard errors, r2 and the rank of the predictors.

    Covariances are taken around the means and scaled, so the size and the level of a predictor do not cost
    digits. Where predictors are constant or depend on one another, many coefficients fit equally well: the ones
    of least norm in the original scale, the intercept among them, are given. Only as many degrees of freedom are
    used as there are independent predictors.
    """
    m, cy = np.asarray(means, float), np.asarray(cov_y, float)
    c = np.asarray(cov, float).reshape(len(m), len(m))
    if n < 2 or not np.isfinite(c).all() or not np.isfinite(cy).all():
        return None, None, None, None
    scale = np.sqrt(np.diag(c))
    # rounding leaves a constant column with a spread of some last digits of its mean
    flat = scale <= 1e-13 * np.abs(m)
    scale[flat] = 1.0
    scaled = c / np.outer(scale, scale)
    scaled[flat, :] = scaled[:, flat] = 0.0
    size, along = np.linalg.eigh(scaled)
    real = size > RANK_TOLERANCE * len(m) * max(size.max(initial=0.0), 0.0)
    rank = int(real.sum())
    inverse = (along[:, real] / size[real]) @ along[:, real].T / np.outer(scale, scale)
    slopes = inverse @ cy
    coef = np.r_[y_mean - slopes @ m, slopes]
    r2 = float(slopes @ cy / y_var) if y_var > 0 else None
    # what may be added to the coefficients without any change to the fit
    idle = along[:, ~real] / scale[:, None]
    idle = np.vstack([-m @ idle, idle])
    away = np.eye(len(m) + 1) - idle @ np.linalg.pinv(idle)
    errors = None
    if (dof := n - rank - 1) > 0:
        noise = max(y_var - float(slopes @ cy), 0.0) * (n - 1) / dof
        spread = inverse / (n - 1)
        whole = np.block([[np.array([[1.0 / n + m @ spread @ m]]), -(m @ spread)[None, :]], [-(spread @ m)[:, None], spread]])
        errors = np.sqrt(noise * np.maximum(np.diag(away @ whole @ away), 0.0)).tolist()
    return (away @ coef).tolist(), errors, r2, rank


def ols(
    df: DataFrame,
    y: str,
    models: Mapping[str, Sequence[str]],
    by: Sequence[str] = (),
) -> DataFrame:
    """Least squares with an intercept for one or more sets of predictors, in one pass.

    Rows with a NULL in any used column are left out of all models, so their fits are comparable.
    Constant and dependent predictors are allowed (see ``least_squares``).
    Returns ``by..., model, term, coef, stderr, t, p, r2, n``.
    """
    xs = list(dict.fromkeys(x for cols in models.values() for x in cols))
    data = df.select(*by, double(y).alias(y), *[double(x).alias(x) for x in xs]).na.drop(subset=[y, *xs])
    name = {frozenset(p): f"_c{i}" for i, p in enumerate(combinations([y, *xs], 2))}
    moments = data.groupBy(*by).agg(
        F.count("*").alias("n"),
        *[F.avg(c).alias(f"_m_{c}") for c in [y, *xs]],
        *[F.var_samp(c).alias(f"_v_{c}") for c in [y, *xs]],
        *[F.covar_samp(*sorted(p)).alias(alias) for p, alias in name.items()],
    )

    def cov(a: str, b: str) -> Column:
        return F.col(f"_v_{a}") if a == b else F.col(name[frozenset((a, b))])

    fits = F.array(
        *[
            F.struct(
                F.lit(label).alias("model"),
                F.array(F.lit("intercept"), *[F.lit(c) for c in cols]).alias("terms"),
                F.array(*[F.col(f"_m_{c}") for c in cols]).alias("means"),
                F.array(*[cov(a, b) for a in cols for b in cols]).alias("cov"),
                F.array(*[cov(y, c) for c in cols]).alias("cov_y"),
            )
            for label, cols in models.items()
        ]
    )
    rows = moments.select(
        *by, "n", F.col(f"_m_{y}").alias("_ym"), F.col(f"_v_{y}").alias("_yv"), F.explode(fits).alias("f")
    )
    solved = rows.withColumn(
        "s", _solve(F.col("n"), F.col("f.means"), F.col("f.cov"), F.col("_ym"), F.col("f.cov_y"), F.col("_yv"))
    )
    terms = solved.select(
        *by,
        F.col("f.model").alias("model"),
        "n",
        F.col("s.r2").alias("r2"),
        F.col("s.rank").alias("_rank"),
        F.explode(F.arrays_zip(F.col("f.terms").alias("term"), F.col("s.coef").alias("coef"), F.col("s.stderr").alias("stderr"))).alias("t"),
    )
    return (
        terms.select(*by, "model", "t.*", "r2", "n", "_rank")
        .withColumn("t", F.try_divide(F.col("coef"), F.col("stderr")))
        .withColumn("p", student_p(F.col("t"), double(F.col("n") - F.col("_rank") - 1)))
        .select(*by, "model", "term", "coef", "stderr", "t", "p", "r2", "n")
    )
