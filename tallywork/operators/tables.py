"""Crosstabs, pivots, shares, top-n and join checks."""

from __future__ import annotations

from collections.abc import Collection, Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from ..functions.columns import ratio

SLOTS = 1 << 16  # counters of the sketch that finds crowded keys; more than any sensible number of tasks


def levels(df: DataFrame, column: str, most: int) -> list:
    """Sorted distinct values of a category column, for naming pivot or dummy columns.

    Only the names come to the driver. ``most`` is how many columns the caller is ready to make of
    them; a column with more levels is an error and belongs in long form.
    """
    rows = df.where(F.col(column).isNotNull()).select(column).distinct().limit(most + 1).collect()
    if len(rows) > most:
        raise ValueError(f"{column} has more than {most} levels; keep it in long form")
    return sorted(r[0] for r in rows)


def wide(
    df: DataFrame, rows: Sequence[str], column: str, names: Mapping[object, str], agg: Column | str,
    fill: float | None = None, value: str | None = None,
) -> DataFrame:
    """Pivot to one column per named level. Rows with a NULL key are left out.

    A level without a name is an error, so none can vanish. ``agg`` is ``"count"`` or a function name applied to ``value``.
    """
    clean = df
    for c in [*rows, column]:
        clean = clean.where(F.col(c).isNotNull())
    clean = clean.withColumn(column, known_level(column, names, df.schema[column].dataType))
    grouped = clean.groupBy(*rows).pivot(column, list(names))
    made = grouped.count() if agg == "count" else grouped.agg({value: agg})
    out = made.select(*rows, *[F.col(f"`{level}`").alias(label) for level, label in names.items()])
    return out if fill is None else out.na.fill(fill, subset=list(names.values()))


def known_level(column: str, names: Collection, kind: T.DataType) -> Column:
    """The column, or an error where it has a value that is not among ``names``."""
    told = F.concat(F.lit(f"{column} has a level without a name: "), F.col(column).cast("string"))
    fits = F.col(column).isNull() | F.col(column).isin(*names)
    return F.when(fits, F.col(column)).otherwise(F.raise_error(told).cast(kind))


def to_wide(
    df: DataFrame, row: str, column: str, names: Mapping[object, str], value: str
) -> DataFrame:
    """Long to wide where each cell has one row; a repeated cell is an error, not an aggregate."""
    cells = df.groupBy(row, column).agg(F.max(value).alias("_v"), F.count("*").alias("_n"))
    checked = cells.withColumn(
        "_v",
        F.when(F.col("_n") == 1, F.col("_v")).otherwise(
            F.raise_error(F.lit(f"repeated ({row}, {column}) cell")).cast(df.schema[value].dataType)
        ),
    )
    return wide(checked, [row], column, names, "max", value="_v")


def with_margins(df: DataFrame, a: str, b: str, measures: Sequence[Column], label: str = "total") -> DataFrame:
    """Two-way totals with row, column and grand totals, in long form."""
    cubed = df.where(F.col(a).isNotNull() & F.col(b).isNotNull()).cube(a, b).agg(
        F.grouping(a).alias("_ga"), F.grouping(b).alias("_gb"), *measures
    )
    name = lambda c, g: F.when(F.col(g) == 1, F.lit(label)).otherwise(F.col(c))
    return cubed.withColumns({a: name(a, "_ga"), b: name(b, "_gb")}).drop("_ga", "_gb")


def share_within(df: DataFrame, group: Sequence[str], measure: str, out: str = "share") -> DataFrame:
    """Each row's part of its group total, for aggregated rows (a group is one bounded report row)."""
    return df.withColumn(out, ratio(F.col(measure), F.sum(measure).over(Window.partitionBy(*group))))


def share_of_all(df: DataFrame, measure: str, out: str = "share") -> DataFrame:
    """Each row's part of the grand total. The total is a scalar subquery, not a global window."""
    return df.withColumn(out, ratio(F.col(measure), df.agg(F.sum(measure)).scalar()))


def top_per_group(
    df: DataFrame, group: Sequence[str], order: Sequence[Column], n: int, rank: str = "rank"
) -> DataFrame:
    """First rows of each group. Spark cuts every task to ``n`` rows per group before the shuffle."""
    w = Window.partitionBy(*group).orderBy(*order)
    return df.withColumn(rank, F.row_number().over(w)).where(F.col(rank) <= n)


def with_group_stats(df: DataFrame, by: Sequence[str], **stats: Column) -> DataFrame:
    """Group statistics beside every row, by aggregate and join instead of a whole-group window.

    The rows of a group are counted with its statistics, and a crowded group is spread by that count.
    """
    kept = df
    for c in by:
        kept = kept.where(F.col(c).isNotNull())
    per_group = kept.groupBy(*by).agg(*[e.alias(k) for k, e in stats.items()], F.count("*").alias("_n"))
    return spread_join(kept, per_group, by, per_group, "_n").drop("_n")


def salts(sizes: DataFrame, by: Sequence[str], n: str) -> Column:
    """How many tasks the rows of a key need, as a column of any frame with the columns ``by``.

    ``sizes`` counts rows (column ``n``) by key or finer. Its sums by hash slot are a count-min sketch of one row:
    bounded, the same on every run, and never too low. A key whose slot holds more than one task's fair share of
    all rows gets as many salts as it holds shares; every other key has one. At most as many slots as there are
    shuffle partitions can be that full, so what every task gets to know is small whatever the data.
    """
    tasks = int(sizes.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    slot = F.pmod(F.xxhash64(*by), F.lit(max(SLOTS, 16 * tasks)))
    # the digest keeps every column of ``sizes`` in the plan, so that it shares the shuffle of its other uses
    slots = sizes.groupBy(slot.alias("slot")).agg(
        F.sum(n).alias("n"), F.max(F.xxhash64(*sizes.columns)).alias("digest")
    )
    told = slots.where(F.col("digest").isNotNull()).agg(
        F.collect_list(F.struct("slot", "n")).alias("slots"), F.sum("n").alias("rows")
    )
    full = told.select(
        F.expr(
            f"map_from_entries(transform(filter(slots, s -> s.n * {tasks} > rows),"
            f" s -> struct(s.slot, cast(ceil(s.n * {tasks} / rows) AS int))))"
        ).alias("full")
    )
    return F.coalesce(F.try_element_at(full.scalar(), slot), F.lit(1))


def spread_join(
    rows: DataFrame, few: DataFrame, by: Sequence[str], sizes: DataFrame | None = None, n: str = "n"
) -> DataFrame:
    """Join with one row per key, a crowded key being spread over as many tasks as its rows need (see ``salts``).

    ``sizes`` counts ``rows`` by key or finer, if that is at hand. The row of a crowded key is copied once per
    salt. The salt of a row comes from its content, so a task that runs again deals its rows the same way; rows
    equal in all columns stay together (adaptive execution can still split them).
    """
    if sizes is None:
        sizes, n = rows.groupBy(*by).agg(F.count("*").alias("n")), "n"
    need = salts(sizes, by, n)
    salted = rows.withColumn("_salts", need).withColumn("_salt", F.pmod(F.xxhash64(*rows.columns), F.col("_salts")).cast("int"))
    copies = few.withColumn("_salt", F.explode(F.sequence(F.lit(0), need - 1)))
    return salted.drop("_salts").join(copies, [*by, "_salt"]).drop("_salt")


def fan_out(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """Row counts either side of an inner and a left join, from per-key counts alone.

    The join itself is never made, so checking a join that would explode stays cheap.
    """
    a = left.groupBy(key).agg(F.count("*").alias("l"))
    b = right.groupBy(key).agg(F.count("*").alias("r"))
    both = a.join(b, key, "full")
    n_l, n_r = F.coalesce("l", F.lit(0)), F.coalesce("r", F.lit(0))
    return both.agg(
        F.sum(n_l).alias("left_rows"),
        F.sum(n_r).alias("right_rows"),
        F.sum(n_l * n_r).alias("inner_rows"),
        F.sum(n_l * F.greatest(n_r, F.lit(1))).alias("left_join_rows"),
        F.sum(n_r * F.greatest(n_l, F.lit(1))).alias("right_join_rows"),
        F.sum(F.greatest(n_l, F.lit(1)) * F.greatest(n_r, F.lit(1))).alias("full_join_rows"),
        F.count_if(n_r == 0).alias("left_only_keys"),
        F.count_if(n_l == 0).alias("right_only_keys"),
        F.count_if(n_r > 1).alias("repeated_right_keys"),
    )
