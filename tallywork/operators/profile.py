"""Looking at a table: shape, types, missing values, duplicates, distributions."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F, types as T

from ..functions.columns import double, ratio
from ..functions.stats import adjusted_kurtosis, adjusted_skewness
from .ordered import quantiles
from .sketches import distinct_sketches, merged_distinct

# The quartiles of a numeric summary.
QUARTILES = {"q1": 0.25, "median": 0.5, "q3": 0.75}


def with_scalars(df: DataFrame, one_row: DataFrame) -> DataFrame:
    """Put the columns of a one-row frame beside every row, as scalar subqueries."""
    row = one_row.select(F.struct(*one_row.columns)).scalar()
    return (
        df.withColumn("_row", row)
        .select("*", *[F.col(f"_row.{c}").alias(c) for c in one_row.columns])
        .drop("_row")
    )


def head_rows(df: DataFrame, n: int, *order: Column | str) -> DataFrame:
    return df.orderBy(*order).limit(n)


def tail_rows(df: DataFrame, n: int, key: Sequence[str]) -> DataFrame:
    """The last rows by ``key``, shown in rising order."""
    return df.orderBy(*[F.col(k).desc() for k in key]).limit(n).orderBy(*key)


def shape(df: DataFrame) -> DataFrame:
    return df.agg(F.count("*").alias("rows")).withColumn(
        "columns", F.lit(len(df.columns)).cast("bigint")
    )


def types(df: DataFrame) -> DataFrame:
    """Column names, types and non-null counts in one pass."""
    counted = df.agg(F.count("*").alias("_rows"), *[F.count(c).alias(c) for c in df.columns])
    cells = F.explode(
        F.array(
            *[
                F.struct(
                    F.lit(name).alias("column"),
                    F.lit(dtype).alias("dtype"),
                    F.col(name).alias("non_null"),
                    (F.col("_rows") - F.col(name)).alias("nulls"),
                )
                for name, dtype in df.dtypes
            ]
        )
    )
    return counted.select(cells.alias("c")).select("c.*")


def _comparable(df: DataFrame, column: str, digest: bool) -> tuple[str, Column]:
    """A column in the type it is grouped by: numbers and times are not spelled out, ``digest`` columns and
    nested ones travel as a SHA-256 or as text."""
    kind, value = df.schema[column].dataType, F.col(f"`{column}`")
    if digest:
        return "string", F.sha2(value.cast("string"), 256)
    if isinstance(kind, (T.IntegralType, T.BooleanType)):
        return "bigint", value.cast("bigint")
    if isinstance(kind, (T.DoubleType, T.FloatType)):
        return "double", value.cast("double")
    if isinstance(kind, (T.DateType, T.TimestampType, T.TimestampNTZType, T.DecimalType, T.BinaryType)):
        return kind.simpleString(), value
    return "string", value.cast("string")


def value_sizes(df: DataFrame, columns: Sequence[str], digest: Sequence[str] = ()) -> DataFrame:
    """(column, is_null, n): the size of every group of equal values of each column, from one read.

    A value is a row with one field per type, of which its own is set. Repeated values collapse before the
    shuffle, so a value that fills a third of a column is cheap.
    """
    values = [_comparable(df, c, c in digest) for c in columns]
    fields = {kind: f"f{i}" for i, kind in enumerate(dict.fromkeys(kind for kind, _ in values))}
    cells = [
        F.struct(F.lit(i).alias("number"), *[(v if k == kind else F.lit(None)).cast(k).alias(f) for k, f in fields.items()])
        for i, (kind, v) in enumerate(values)
    ]
    groups = df.select(F.explode(F.array(*cells)).alias("c")).select("c.*").groupBy("number", *fields.values()).agg(F.count("*").alias("n"))
    is_null = F.lit(True)
    for f in fields.values():
        is_null = is_null & F.col(f).isNull()
    names = F.array(*[F.lit(c) for c in columns])
    return groups.select(F.get(names, F.col("number")).alias("column"), is_null.alias("is_null"), "n")


def audit(df: DataFrame, digest: Sequence[str] = ()) -> DataFrame:
    """Per column: rows, nulls, distinct values and the size of its largest value group."""
    is_null, n = F.col("is_null"), F.col("n")
    return value_sizes(df, df.columns, digest).groupBy("column").agg(
        F.sum("n").alias("rows"),
        F.sum(F.when(is_null, n).otherwise(F.lit(0))).alias("nulls"),
        F.count_if(~is_null).alias("distinct_values"),
        F.max(F.when(~is_null, n)).alias("top_count"),
    )


def distinct_counts(df: DataFrame, columns: Sequence[str], approx: bool = False) -> DataFrame:
    """``column, distinct_values`` (NULL is no value).

    With ``approx`` the counts come from one HyperLogLog sketch per column and task, without any shuffle of
    values; they are within ``sketches.distinct_error()`` of the exact ones.
    """
    if not approx:
        return value_sizes(df, columns).groupBy("column").agg(F.count_if(~F.col("is_null")).alias("distinct_values"))
    one = merged_distinct(distinct_sketches(df, columns), columns)
    return one.unpivot([], list(columns), "column", "distinct_values")


def duplicate_rows(df: DataFrame, digest: Sequence[str] = ()) -> DataFrame:
    """Rows, distinct rows and surplus copies over all columns of ``df``."""
    keys = [F.sha2(F.col(c), 256).alias(c) if c in digest else F.col(c) for c in df.columns]
    groups = df.select(*keys).groupBy(*df.columns).agg(F.count("*").alias("_n"))
    return groups.agg(
        F.coalesce(F.sum("_n"), F.lit(0)).alias("rows"), F.count("*").alias("distinct_rows")
    ).withColumn("surplus", F.col("rows") - F.col("distinct_rows"))


def value_counts(df: DataFrame, column: str, dropna: bool = True) -> DataFrame:
    """``column, n, share``; NULL counts as a value only with ``dropna=False``."""
    source = df.where(F.col(column).isNotNull()) if dropna else df
    counts = source.groupBy(column).agg(F.count("*").alias("n"))
    return counts.withColumn("share", ratio(F.col("n"), counts.agg(F.sum("n")).scalar()))


def modes(df: DataFrame, value: str, by: Sequence[str] = ()) -> DataFrame:
    """All values tied for the highest count, per group."""
    clean = df.where(F.col(value).isNotNull())
    for c in by:
        clean = clean.where(F.col(c).isNotNull())
    counts = clean.groupBy(*by, value).agg(F.count("*").alias("n"))
    if not by:
        return counts.where(F.col("n") == counts.agg(F.max("n")).scalar())
    best = counts.groupBy(*by).agg(F.max("n").alias("_best"))
    return counts.join(best, list(by)).where(F.col("n") == F.col("_best")).select(*by, value, "n")


def describe(df: DataFrame, value: str, by: Sequence[str] = ()) -> DataFrame:
    """Count, mean, spread, extremes, exact quartiles and adjusted shape of a numeric column."""
    x = double(value)
    kept = df
    for c in by:
        kept = kept.where(F.col(c).isNotNull())
    moments = kept.groupBy(*by).agg(
        F.count(x).alias("n"),
        F.avg(x).alias("mean"),
        F.stddev_samp(x).alias("sd"),
        F.var_samp(x).alias("variance"),
        F.min(x).alias("minimum"),
        F.max(x).alias("maximum"),
        adjusted_skewness(value).alias("skew"),
        adjusted_kurtosis(value).alias("kurtosis"),
    )
    cuts = quantiles(df, value, QUARTILES, by).drop("n")
    joined = moments.join(cuts, list(by), "left") if by else with_scalars(moments, cuts)
    return joined.withColumn("value_range", F.col("maximum") - F.col("minimum"))


def spelling_groups(df: DataFrame, column: str, canonical: Column) -> DataFrame:
    """Raw spellings that share a canonical form: ``canonical, spellings, rows``."""
    raw = df.groupBy(F.col(column).alias("raw")).agg(F.count("*").alias("n"))
    named = raw.withColumn("canonical", canonical)
    return named.groupBy("canonical").agg(
        F.count("*").alias("spellings"), F.sum("n").alias("rows")
    )


def span(df: DataFrame, column: str) -> DataFrame:
    return df.agg(F.min(column).alias("first"), F.max(column).alias("last"))


def changed_rows(df: DataFrame, rules: Mapping[str, tuple[str, Column]]) -> DataFrame:
    """How many rows each rule changes: name -> (column, new value). One pass for all rules."""
    counts = df.agg(
        *[
            F.count_if(~F.col(column).eqNullSafe(new)).alias(name)
            for name, (column, new) in rules.items()
        ]
    )
    return counts.unpivot([], list(rules), "rule", "rows_changed")
