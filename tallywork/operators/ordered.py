"""Ordered computations that never put a whole group into one task.

A plain window keeps every row of a group (or, without a partition key, of the
whole table) in a single task. The operators here cut each group into ranges,
work inside the ranges in parallel, and carry a small per-range summary across.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, WindowSpec, functions as F

from ..functions.columns import double
from ..session import range_count
from .sketches import merged_quantiles, quantile_sketches

ROWS_PER_BLOCK = 100_000
MERGE_TASKS = 64  # first level of merging the sketches of all input tasks


def with_value_range(df: DataFrame, value: str, bounds: str, ranges: int, out: str) -> DataFrame:
    """Add the number of ``bounds`` (a sorted array column) below ``value``, by bisection.

    One projection per halving, all in generated code. A lambda over the array would be shorter,
    but joins on a key made by a lambda can pick up a wrong filter from constraint inference.
    """
    found = df.withColumn(out, F.lit(0))
    stride = ranges // 2
    while stride:
        above = F.get(F.col(bounds), F.col(out) + (stride - 1)) < F.col(value)
        found = found.withColumn(out, F.col(out) + F.when(above, stride).otherwise(0))
        stride //= 2
    return found


def sketch(column: str, ranges: int) -> Column:
    """Bounds that cut a column into about equally filled ranges."""
    return F.percentile_approx(column, [i / ranges for i in range(1, ranges)], max(1_000, 4 * ranges))


def value_groups(df: DataFrame, value: str, by: Sequence[str] = ()) -> DataFrame:
    """Distinct values with their count, without NULL values and NULL keys.

    Equal values collapse before the shuffle, so a value held by a third of all rows is one row.
    Operators that start from this frame in one query share its shuffle.
    """
    clean = df.select(*by, F.col(value))
    for c in [*by, value]:
        clean = clean.where(F.col(c).isNotNull())
    return clean.groupBy(*by, value).agg(F.count("*").alias("n"))


def value_ladder(
    df: DataFrame,
    value: str,
    by: Sequence[str] = (),
    wanted: Callable[[Column], Sequence[Column]] | None = None,
) -> DataFrame:
    """Distinct values with their count and the exact count and sum below them.

    Returns ``by..., value, n, n_below, sum_below, n_total, sum_total``.
    ``wanted`` maps the group size to zero-based ranks: only ranges that hold one of them are then
    ordered.
    """
    by = list(by)
    ranges = range_count(df.sparkSession)
    counts = value_groups(df, value, by)
    cuts = counts.agg(
        F.struct(
            sketch(value, ranges).alias("bounds"),
            F.sum("n").alias("rows"),  # keeps the input equal to ``counts``, so its shuffle is shared
        )
    ).scalar()
    bounded = counts.withColumn("_bounds", cuts["bounds"])
    ranged = with_value_range(bounded, value, "_bounds", ranges, "_range").drop("_bounds")
    group = [F.col(c) for c in by] or [F.lit(0)]
    below = Window.partitionBy(*group).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy(*group)
    per_range = (
        ranged.groupBy(*by, "_range")
        .agg(F.sum("n").alias("_n"), F.sum(F.col("n") * F.col(value)).alias("_sum"))
        .withColumn("_n_before", F.coalesce(F.sum("_n").over(below), F.lit(0)))
        .withColumn("_sum_before", F.coalesce(F.sum("_sum").over(below), F.lit(0)))
        .withColumn("n_total", F.sum("_n").over(whole))
        .withColumn("sum_total", F.sum("_sum").over(whole))
    )
    if wanted is not None:
        here = [
            (r >= F.col("_n_before")) & (r < F.col("_n_before") + F.col("_n"))
            for r in wanted(F.col("n_total"))
        ]
        per_range = per_range.where(reduce(Column.__or__, here))
    inside = (
        Window.partitionBy(*group, "_range").orderBy(value).rowsBetween(Window.unboundedPreceding, -1)
    )
    return (
        ranged.join(per_range.drop("_n", "_sum"), [*by, "_range"])
        .withColumn("n_below", F.col("_n_before") + F.coalesce(F.sum("n").over(inside), F.lit(0)))
        .withColumn(
            "sum_below",
            F.col("_sum_before") + F.coalesce(F.sum(F.col("n") * F.col(value)).over(inside), F.lit(0)),
        )
        .select(*by, value, "n", "n_below", "sum_below", "n_total", "sum_total")
    )


def quantiles(
    df: DataFrame, value: str, probs: Mapping[str, float], by: Sequence[str] = (), approx: bool = False
) -> DataFrame:
    """Exact linearly interpolated quantiles, one output column per named probability.

    Also returns ``n`` (non-null rows). One row per group, or a single row. With ``approx`` one KLL sketch per
    group and task stands for the values: the results are values that occur, with ranks within
    ``sketches.rank_error()`` of the wanted ones.
    """
    if approx:
        kept = df
        for c in by:
            kept = kept.where(F.col(c).isNotNull())
        return merged_quantiles(quantile_sketches(kept, value, by), probs, by)

    def position(p: float, n: Column) -> Column:
        return F.lit(float(p)) * (n - 1)

    def ranks(n: Column) -> list[Column]:
        return [f(position(p, n)) for p in probs.values() for f in (F.floor, F.ceil)]

    ladder = value_ladder(df, value, by, ranks)
    at = lambda r: F.max(
        F.when((F.col("n_below") <= r) & (r < F.col("n_below") + F.col("n")), double(value))
    )
    aggs = []
    for name, p in probs.items():
        pos = position(p, F.col("n_total"))
        low, high = at(F.floor(pos)), at(F.ceil(pos))
        frac = F.max(pos - F.floor(pos))
        aggs.append((low + (high - low) * frac).alias(name))
    return ladder.groupBy(*by).agg(F.max("n_total").alias("n"), *aggs)


def top_share(df: DataFrame, value: str, fractions: Sequence[float]) -> DataFrame:
    """Share of the total held by the top rows: one row per fraction.

    The head is ``max(1, floor(n * fraction))`` rows. Rows tied at the cut count only as
    far as the head reaches into the tie, so the result does not depend on their order.
    """

    # the first row outside the head, counted from the bottom
    ladder = value_ladder(
        df, value, wanted=lambda n: [n - head_rows(n, F.lit(float(p))) for p in fractions]
    )
    rows = F.explode(F.array(*[F.lit(float(p)) for p in fractions])).alias("fraction")
    cut = ladder.select("*", rows).withColumn("head_rows", head_rows(F.col("n_total"), F.col("fraction")))
    start = F.col("n_total") - F.col("head_rows")
    return cut.where((F.col("n_below") <= start) & (start < F.col("n_below") + F.col("n"))).select(
        "fraction",
        "head_rows",
        double(
            F.col("sum_total") - F.col("sum_below") - F.col(value) * (start - F.col("n_below"))
        ).alias("head_sum"),
        double("sum_total").alias("total_sum"),
    )


def head_rows(n: Column, fraction: Column) -> Column:
    return F.greatest(F.lit(1), F.floor(n * fraction)).cast("bigint")


def with_ranges(
    df: DataFrame, order: Sequence[str], out: str = "bucket", like: DataFrame | None = None
) -> DataFrame:
    """Add an evenly filled range number that rises with the order columns (NULL sorts first).

    A value of the first column that fills whole ranges by itself is cut further by the second
    column, if there is one. The bounds come from one sketch pass and are the same however often
    the plan runs. They only balance the work, so they may come from ``like``, a frame that is
    cheaper to read and has similar values.
    """
    first, *rest = order[:2]
    ranges = range_count(df.sparkSession)
    cuts = _bounds(df if like is None else like, order[:2], ranges).scalar()
    marked = df.withColumn("_cuts", cuts).withColumn("_b0", F.col("_cuts.b0"))
    marked = with_value_range(marked, first, "_b0", ranges, "_r0")
    number = F.col("_r0")
    if rest:
        marked = with_value_range(marked.withColumn("_b1", F.col("_cuts.b1")), rest[0], "_b1", ranges, "_r1")
        fills = (F.get("_b0", F.col("_r0")) == F.col(first)) & (F.get("_b0", F.col("_r0") + 1) == F.col(first))
        number = (F.col("_r0") + 1) * 2 * ranges + F.when(fills, ranges + F.col("_r1")).otherwise(0)
        # rows without a first value come first and are cut by the second one alone
        number = F.when(F.col(first).isNull(), F.col("_r1")).otherwise(number)
    return marked.withColumn(out, number).drop("_cuts", "_b0", "_b1", "_r0", "_r1")


def _bounds(df: DataFrame, columns: Sequence[str], ranges: int) -> DataFrame:
    """One struct of bounds b0, b1, ... per column.

    Sketches are merged in two levels: those of the input tasks in MERGE_TASKS tasks, whose bounds are then
    ranked once more. No task takes in a sketch from every input task.
    """
    names = [f"b{i}" for i in range(len(columns))]
    level = lambda cols: [sketch(c, ranges).alias(b) for c, b in zip(cols, names)]
    dealt = df.select(*columns).withColumn("_task", F.spark_partition_id() % MERGE_TASKS)
    parts = dealt.groupBy("_task").agg(*level(columns))
    # a task whose column is all NULL has no bounds for it, but it keeps those of the other column
    known = [F.coalesce(b, F.array().cast(parts.schema[b].dataType)).alias(b) for b in names]
    spread = parts.select(F.explode(F.arrays_zip(*known)).alias("z")).select("z.*")
    return spread.agg(F.struct(*level(names)))


def running(
    df: DataFrame,
    by: Sequence[str],
    order: Sequence[str],
    bucket: str,
    sums: Mapping[str, str] | None = None,
    position: str = "position",
) -> DataFrame:
    """Row position (from 1) and running sums inside each group.

    ``bucket`` must be non-null and rise with ``order`` (see ``with_ranges``): a group is worked on
    per bucket and only the bucket totals are ordered as a whole.
    """
    return _running(df, by, order, bucket, sums or {}, position).drop(_CELL)


# Group and bucket as one struct. Structs with NULL fields are equal to each other, so NULL groups
# join, and the join and the windows need the same partitioning: the rows are shuffled once.
_CELL = "_cell"


def _running(
    df: DataFrame,
    by: Sequence[str],
    order: Sequence[str],
    bucket: str,
    sums: Mapping[str, str],
    position: str,
) -> DataFrame:
    group = [F.col(c) for c in by] or [F.lit(0)]
    local = Window.partitionBy(_CELL).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    before = Window.partitionBy(*group).orderBy(bucket).rowsBetween(Window.unboundedPreceding, -1)
    totals = df.groupBy(*by, bucket).agg(
        F.count("*").alias("_n"), *[F.sum(src).alias(f"_t_{out}") for out, src in sums.items()]
    )
    carried = totals.select(
        F.struct(*by, bucket).alias(_CELL),
        F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"),
        *[F.coalesce(F.sum(f"_t_{out}").over(before), F.lit(0)).alias(f"_b_{out}") for out in sums],
    )
    return (
        df.withColumn(_CELL, F.struct(*by, bucket))
        .join(carried, _CELL)
        .select(
            _CELL,
            *_from_cell(df.columns, [*by, bucket]),
            (F.col("_before") + F.count("*").over(local)).alias(position),
            *[
                (F.col(f"_b_{out}") + F.coalesce(F.sum(src).over(local), F.lit(0))).alias(out)
                for out, src in sums.items()
            ],
        )
    )


def _from_cell(columns: Sequence[str], keys: Sequence[str]) -> list[Column]:
    """Columns of the input, the keys taken from the cell so that they need not travel twice."""
    return [F.col(f"{_CELL}.{c}").alias(c) if c in keys else F.col(c) for c in columns]


def neighbours(
    df: DataFrame, by: Sequence[str], order: Sequence[str], bucket: str, value: str
) -> DataFrame:
    """Row position and the nearest non-null values at or before and at or after each row.

    Adds ``position, prev_position, prev_value, next_position, next_value``.
    """
    known = F.when(F.col(value).isNotNull(), F.struct(F.col("position").alias("p"), F.col(value).alias("v")))
    numbered = _running(df, by, order, bucket, {}, "position").withColumn("_known", known)
    # both directions look back over a growing frame; a frame that ends at the last row of the
    # partition would be worked out again for every row
    inside = Window.partitionBy(_CELL)
    so_far = lambda w: w.rowsBetween(Window.unboundedPreceding, 0)
    rows = numbered.withColumn(
        "_prev", F.last("_known", True).over(so_far(inside.orderBy("position")))
    ).withColumn("_next", F.last("_known", True).over(so_far(inside.orderBy(F.desc("position")))))
    across = Window.partitionBy(*([F.col(c) for c in by] or [F.lit(0)]))
    earlier = lambda w: w.rowsBetween(Window.unboundedPreceding, -1)
    edges = (
        numbered.groupBy(_CELL)
        .agg(F.max("_known").alias("_last"), F.min("_known").alias("_first"))
        .select("*", f"{_CELL}.*")
        .select(
            _CELL,
            F.last("_last", True).over(earlier(across.orderBy(bucket))).alias("_back"),
            F.last("_first", True).over(earlier(across.orderBy(F.desc(bucket)))).alias("_ahead"),
        )
    )
    prev, nxt = F.coalesce("_prev", "_back"), F.coalesce("_next", "_ahead")
    return rows.join(edges, _CELL).select(
        *df.columns,
        "position",
        prev["p"].alias("prev_position"),
        prev["v"].alias("prev_value"),
        nxt["p"].alias("next_position"),
        nxt["v"].alias("next_value"),
    )


def interpolate(
    df: DataFrame, by: Sequence[str], order: Sequence[str], bucket: str, value: str, out: str
) -> DataFrame:
    """Linear interpolation by row position: leading NULLs stay, trailing ones repeat the last value."""
    near = neighbours(df, by, order, bucket, value)
    step = F.try_divide(
        double(F.col("position") - F.col("prev_position")),
        double(F.col("next_position") - F.col("prev_position")),
    )
    filled = F.when(F.col(value).isNotNull(), F.col(value)).otherwise(
        F.when(F.col("next_value").isNull(), F.col("prev_value")).otherwise(
            F.col("prev_value") + (F.col("next_value") - F.col("prev_value")) * step
        )
    )
    return near.select(*df.columns, "position", filled.alias(out))


def forward_fill(
    df: DataFrame, by: Sequence[str], order: Sequence[str], bucket: str, value: str, out: str
) -> DataFrame:
    """Last known value at or before each row."""
    near = neighbours(df, by, order, bucket, value)
    return near.select(*df.columns, "position", F.col("prev_value").alias(out))


def trailing(
    df: DataFrame,
    by: Sequence[str],
    position: str,
    rows: int,
    outputs: Mapping[str, Callable[[WindowSpec], Column]],
    block_rows: int = ROWS_PER_BLOCK,
) -> DataFrame:
    """Window results that look back at most ``rows - 1`` rows, for groups numbered by ``position``.

    A group is cut into blocks of rows; the tail of each block is also sent to the next block,
    so every row finds what it looks back at. ``outputs`` maps a name to a function of the ordered
    window, which sets its own frame.
    """
    size = max(block_rows, rows)
    index = F.col(position) - 1
    home = F.floor(index / size)
    in_tail = index % size >= size - (rows - 1)
    copies = df.withColumn("_home", home).withColumn(
        "_block", F.explode(F.when(in_tail, F.array(home, home + 1)).otherwise(F.array(home)))
    )
    window = Window.partitionBy(*by, "_block").orderBy(position)
    return (
        copies.select("*", *[fn(window).alias(name) for name, fn in outputs.items()])
        .where(F.col("_home") == F.col("_block"))
        .drop("_home", "_block")
    )
