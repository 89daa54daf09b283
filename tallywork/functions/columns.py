"""Scalar column helpers. Everything here is a built-in expression."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, functions as F

# The full-width space, and the date spellings the cleaning rules accept.
FULL_WIDTH_SPACE = "　"
DATE_FORMATS = ("yyyy-MM-dd", "yyyy/MM/dd")


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def double(c: Column | str) -> Column:
    return _col(c).cast("double")


def ratio(a: Column | str, b: Column | str) -> Column:
    """a / b as a double; NULL where b is zero."""
    return F.try_divide(double(a), double(b))


def trim_all(c: Column | str) -> Column:
    """Strip outer white space of any width, then drop inner full-width spaces."""
    edges = F.regexp_replace(_col(c), rf"^[\s{FULL_WIDTH_SPACE}]+|[\s{FULL_WIDTH_SPACE}]+$", "")
    return F.replace(edges, F.lit(FULL_WIDTH_SPACE), F.lit(""))


def recode(c: Column | str, mapping: Mapping[str, str], default: Column | str | None = None) -> Column:
    """Dictionary lookup; values outside the dictionary become ``default``."""
    pairs = [F.lit(x) for kv in mapping.items() for x in kv]
    found = F.try_element_at(F.create_map(*pairs), _col(c))
    if default is None:
        return found
    return F.coalesce(found, default if isinstance(default, Column) else F.lit(default))


def bands_below(c: Column | str, edges: Sequence[float], labels: Sequence[str]) -> Column:
    """Left-closed bands: the first label whose edge lies above the value, else the last label."""
    if len(labels) != len(edges) + 1:
        raise ValueError("need one more label than edges")
    x = _col(c)
    whens = reduce(
        lambda acc, el: acc.when(x < el[0], el[1]),
        list(zip(edges, labels))[1:],
        F.when(x < edges[0], labels[0]),
    )
    return whens.otherwise(labels[-1])


def bands_upto(c: Column | str, edges: Sequence[float], labels: Sequence[str]) -> Column:
    """Right-closed bins ``(edge, next edge]``; a value outside all bins is NULL."""
    if len(edges) != len(labels) + 1:
        raise ValueError("need one more edge than labels")
    x = _col(c)
    out = None
    for lo, hi, label in zip(edges, edges[1:], labels):
        inside = (x > lo) & (x <= hi)
        out = F.when(inside, label) if out is None else out.when(inside, label)
    return out


def null_outside(c: Column | str, low: float, high: float) -> Column:
    """Keep values in [low, high]; anything else becomes NULL."""
    x = _col(c)
    return F.when((x >= low) & (x <= high), x)


def parse_date(c: Column | str, formats: Sequence[str] = DATE_FORMATS) -> Column:
    """First format that fits; text that fits none becomes NULL."""
    return F.coalesce(*[F.try_to_timestamp(_col(c), F.lit(f)).cast("date") for f in formats])


def year_month(c: Column | str) -> Column:
    return F.date_format(_col(c), "yyyy-MM")


def month_start(c: Column | str) -> Column:
    return F.trunc(_col(c), "month")


def day_text(c: Column | str) -> Column:
    return F.date_format(_col(c), "yyyy-MM-dd")


def equal_width_bin(c: Column | str, low: Column, high: Column, bins: int) -> Column:
    """1-based bin of an equal-width histogram; the top edge belongs to the last bin."""
    x = double(c)
    return F.when(
        high > low, F.least(F.width_bucket(x, low, high, F.lit(bins)), F.lit(bins).cast("bigint"))
    ).otherwise(F.when(x.isNotNull(), F.lit(1).cast("bigint")))


def thousands(c: Column | str, places: int = 0) -> Column:
    """Number with thousands separators, for display columns."""
    return F.format_number(_col(c), places)
