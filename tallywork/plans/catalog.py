"""Registry of named queries, each with the SQL that must give the same rows."""

from __future__ import annotations

from collections.abc import Callable
from importlib import import_module

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

Runner = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Runner] = {}
ORACLES: dict[str, str] = {}

MODULES = ("sales", "tables", "profile", "series", "stats", "streams")


def query(sql: str | None = None) -> Callable[[Runner], Runner]:
    """Register a function under its own name."""

    def keep(fn: Runner) -> Runner:
        if fn.__name__ in QUERIES:
            raise ValueError(f"query {fn.__name__} is registered twice")
        QUERIES[fn.__name__] = fn
        if sql:
            ORACLES[fn.__name__] = sql
        return fn

    return keep


def load() -> tuple[dict[str, Runner], dict[str, str]]:
    for m in MODULES:
        import_module(f"{__package__}.queries_{m}")
    return dict(QUERIES), dict(ORACLES)


def tidy(df: DataFrame, digits: int = 6, /, **places: int) -> DataFrame:
    """Plain result types: bigint, double, text. Doubles are rounded, exact money is not."""
    out = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, T.DecimalType):
            c = c.cast("double")
            if f.name in places:
                c = F.round(c, places[f.name])
        elif isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            c = F.round(c.cast("double"), places.get(f.name, digits))
        elif isinstance(f.dataType, (T.IntegerType, T.ShortType, T.ByteType, T.BooleanType)):
            c = c.cast("bigint") if not isinstance(f.dataType, T.BooleanType) else c.cast("int").cast("bigint")
        elif isinstance(f.dataType, T.DateType):
            c = F.date_format(c, "yyyy-MM-dd")
        elif isinstance(f.dataType, (T.TimestampType, T.TimestampNTZType)):
            c = F.date_format(c, "yyyy-MM-dd HH:mm:ss.SSSSSS")
        out.append(c.alias(f.name))
    return df.select(*out)


# SQL building blocks: completed lines, completed order amounts, buyers.
LINES = """lines AS (
  SELECT l.l_orderkey AS order_id, l.l_partkey AS product_id, o.o_custkey AS customer_id,
         CAST(o.o_orderdate AS DATE) AS order_date, l.l_quantity AS quantity,
         CAST(l.l_extendedprice AS DECIMAL(15,2)) AS amount
  FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
  WHERE o.o_orderstatus = 'F')"""
AMOUNTS = (
    LINES
    + """, oa AS (
  SELECT order_id, customer_id, order_date, sum(amount) AS amount, count(*) AS lines
  FROM lines GROUP BY order_id, customer_id, order_date)"""
)
BUYERS = (
    AMOUNTS
    + """, pc AS (
  SELECT customer_id, sum(amount) AS total_spend, count(*) AS n_orders
  FROM oa GROUP BY customer_id)"""
)
EVENTS = """ev AS (
  SELECT event_id, ts, CAST(ts AS DATE) AS day, user_id, event_type AS kind, value,
         CASE WHEN user_id % 2 = 0 THEN 'A' ELSE 'B' END AS arm,
         CASE WHEN event_type = 'purchase' THEN 1 ELSE 0 END AS converted,
         'M-0' || CAST(user_id % 4 + 1 AS VARCHAR) AS machine_id,
         CASE WHEN event_type <> 'error' THEN value END AS reading,
         CASE WHEN event_type = 'error' THEN 1 ELSE 0 END AS defect
  FROM events)"""
CAMPAIGNS = """cg AS (
  SELECT CAST(ts AS DATE) AS day, 'ch' || CAST(user_id % 5 AS VARCHAR) AS channel,
         count(*) FILTER (event_type = 'view') AS impressions,
         count(*) FILTER (event_type = 'click') AS clicks,
         count(*) FILTER (event_type = 'purchase') AS conversions,
         coalesce(sum(CAST(value AS DECIMAL(15,2))) FILTER (event_type = 'click'), 0) AS cost,
         coalesce(sum(CAST(value AS DECIMAL(15,2))) FILTER (event_type = 'purchase'), 0) AS revenue
  FROM events GROUP BY 1, 2)"""


def sql_normal_p(z: str) -> str:
    """Two-sided normal tail of the SQL expression ``z`` by Simpson's rule."""
    return f"""(SELECT greatest(0, 1 - 2 * sum(CASE WHEN i IN (0, 2000) THEN 1 WHEN i % 2 = 1 THEN 4 ELSE 2 END
        * exp(-0.5 * pow(abs({z}) * i / 2000, 2))) * abs({z}) / 6000 / sqrt(2 * pi())) FROM range(0, 2001) s(i))"""


def sql_student_p(t: str, df: str) -> str:
    """Two-sided Student tail by Simpson's rule."""
    return f"""(SELECT greatest(0, 1 - 2 * sum(CASE WHEN i IN (0, 2000) THEN 1 WHEN i % 2 = 1 THEN 4 ELSE 2 END
        * pow(1 + pow(abs({t}) * i / 2000, 2) / ({df}), -(({df}) + 1) / 2)) * abs({t}) / 6000
        * exp(lgamma((({df}) + 1) / 2) - lgamma(({df}) / 2)) / sqrt(({df}) * pi())) FROM range(0, 2001) s(i))"""
