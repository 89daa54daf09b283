"""Cleaning: whole-row and keyed de-duplication, imputation and the customer pipeline."""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Observation, functions as F

from ..functions.columns import null_outside, parse_date, recode, trim_all
from ..session import materialise
from .ordered import quantiles
from .profile import changed_rows

# Accepted spellings of the gender column, its fallback, and the age range.
GENDERS = {
    "女性": "女性",
    "F": "女性",
    "男性": "男性",
    "M": "男性",
    "回答なし": "回答なし",
    "": "回答なし",
}
NO_ANSWER = "回答なし"
AGE_RANGE = (0, 120)


def drop_duplicate_rows(df: DataFrame) -> DataFrame:
    """One copy of every distinct row. Copies meet map-side first."""
    return df.dropDuplicates()


def keep_first(df: DataFrame, key: Sequence[str], order: Sequence[str | Column]) -> DataFrame:
    """One row per key: the first by ``order``, which must be unique within a key.

    An aggregate rather than a window, so a key with very many rows is reduced on the map side.
    """
    cols = [F.col(o) if isinstance(o, str) else o for o in order]
    rest = [c for c in df.columns if c not in key]
    best = F.min_by(F.struct(*rest), F.struct(*[c.alias(f"o{i}") for i, c in enumerate(cols)]))
    return df.groupBy(*key).agg(best.alias("_row")).select(*key, "_row.*").select(*df.columns)


def drop_null_rows(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.na.drop(subset=list(columns))


def drop_null_report(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows before and after dropping NULLs in ``columns``, from one pass."""
    complete = F.lit(True)
    for c in columns:
        complete = complete & F.col(c).isNotNull()
    return df.agg(
        F.count("*").alias("rows_before"), F.count_if(complete).alias("rows_after")
    ).withColumn("rows_dropped", F.col("rows_before") - F.col("rows_after"))


def fill_median(df: DataFrame, column: str, kind: str = "double") -> DataFrame:
    """Fill NULLs with the exact median of the column."""
    median = quantiles(df, column, {"m": 0.5}).select("m").scalar()
    return df.withColumn(column, F.coalesce(F.col(column).cast(kind), median.cast(kind)))


def fill_mean(df: DataFrame, column: str) -> DataFrame:
    mean = df.agg(F.avg(column)).scalar()
    return df.withColumn(column, F.coalesce(F.col(column).cast("double"), mean))


def _tidy_columns() -> dict[str, Column]:
    return {
        "name": trim_all("name"),
        "prefecture": trim_all("prefecture"),
        "gender": recode(trim_all("gender"), GENDERS, NO_ANSWER),
        "age": null_outside("age", *AGE_RANGE),
        "registration_date": parse_date("registration_date"),
    }


def clean_customers(raw: DataFrame) -> DataFrame:
    """Dirty customer rows to one clean row per customer.

    Whole-row duplicates go first; then text is trimmed, gender recoded, impossible ages replaced
    by the median of the remaining ones, dates parsed; rows made equal by that go last.
    """
    tidy = drop_duplicate_rows(raw).withColumns(_tidy_columns())
    return drop_duplicate_rows(fill_median(tidy, "age"))


def customer_rules() -> dict[str, tuple[str, Column]]:
    """What each cleaning rule does: name -> (column, new value)."""
    done = _tidy_columns()
    return {
        "trim name": ("name", done["name"]),
        "trim prefecture": ("prefecture", done["prefecture"]),
        "recode gender": ("gender", done["gender"]),
        "age out of range": ("age", done["age"]),
        "date spelling": ("registration_date", F.date_format(done["registration_date"], "yyyy-MM-dd")),
    }


def customer_change_log(raw: DataFrame) -> DataFrame:
    """Rows each cleaning rule touches in the raw table."""
    return changed_rows(raw, customer_rules())


class Cleaned(NamedTuple):
    """A cleaned table as written, what was counted on the way, and how many rows each rule touched."""

    rows: DataFrame
    counts: dict[str, object]
    changes: dict[str, int]


def clean_customers_observed(raw: DataFrame) -> Cleaned:
    """``clean_customers``, written, with all its reports from the same passes: the raw table is read once.

    Equal raw rows meet in an aggregate that keeps how many there were, so the counts are taken behind the
    shuffle, in the tasks that write. Spark counts each such task once, also when it ran twice; counts taken before
    a shuffle would be added again for a stage that a lost executor makes run anew.
    """
    rules = customer_rules()
    copies = raw.groupBy(*raw.columns).agg(F.count("*").alias("_copies"))
    touched = {
        f"rule {i}": F.sum(F.when(~F.col(c).eqNullSafe(new), F.col("_copies")).otherwise(F.lit(0)))
        for i, (c, new) in enumerate(rules.values())
    }
    first, last = Observation(), Observation()
    seen = copies.observe(
        first, F.sum("_copies").alias("rows_before"), F.count("*").alias("rows_unique"), *[e.alias(n) for n, e in touched.items()]
    )
    tidy = materialise(seen.drop("_copies").withColumns(_tidy_columns()), "tidy")
    done = drop_duplicate_rows(fill_median(tidy, "age")).observe(
        last,
        F.count("*").alias("rows_after"),
        F.count_if(F.col("registration_date").isNull()).alias("undated"),
        F.count_if(F.col("age").isNull()).alias("ageless"),
        F.min("age").alias("youngest"),
        F.max("age").alias("oldest"),
        F.count_if(~F.col("gender").isin(*GENDERS.values())).alias("odd_genders"),
    )
    rows = materialise(done, "cleaned")
    told = first.get
    counts = {"rows_before": told["rows_before"] or 0, "rows_unique": told["rows_unique"], **last.get}
    return Cleaned(rows, counts, {name: told[f"rule {i}"] or 0 for i, name in enumerate(rules)})


def key_duplicates(df: DataFrame, key: Sequence[str]) -> DataFrame:
    """Keys that occur more than once, with how many different rows they carry."""
    rows = df.groupBy(*df.columns).agg(F.count("*").alias("_n"))
    return (
        rows.groupBy(*key)
        .agg(F.sum("_n").alias("rows"), F.count("*").alias("distinct_rows"))
        .where(F.col("rows") > 1)
    )


def outside_domain(df: DataFrame, column: str, allowed: Sequence[str]) -> DataFrame:
    """Values of a column that are not in the allowed set; empty when the column is clean."""
    return (
        df.where(F.col(column).isNull() | ~F.col(column).isin(*allowed))
        .groupBy(column)
        .agg(F.count("*").alias("n"))
    )
