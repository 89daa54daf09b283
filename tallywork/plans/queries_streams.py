"""Registered streaming queries: each runs the event stream to its end and reads the result."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..session import drop_at_exit, materialise, shared_dir
from ..sources.activity import events
from ..streaming import live
from .catalog import EVENTS, query, tidy
from .queries_stats import _AB, _chi


def _baseline(spark, sf):
    """One row per machine, written once: every batch of the stream joins it."""
    return materialise(live.sensor_baseline(events(spark, sf)), "baseline")


@query("""SELECT strftime(CAST(ts AS DATE), '%Y-%m-%d') AS day, event_type AS kind, count(*) AS n,
  CAST(sum(CAST(value AS DECIMAL(15,2))) AS DOUBLE) AS amount FROM events GROUP BY 1, 2""")
def stream_daily_counts(spark, sf):
    return tidy(live.settle(live.daily_counts(live.event_stream(spark, sf)), "daily-counts"))


@query("""SELECT strftime(CAST(ts AS DATE), '%Y-%m-%d') AS day, event_type AS kind, count(*) AS n,
  CAST(sum(CAST(value AS DECIMAL(15,2))) AS DOUBLE) AS amount FROM events GROUP BY 1, 2""")
def stream_folded_days(spark, sf):
    """Daily counts without state: a batch rewrites the days it has rows of, and late rows count."""
    base = shared_dir(spark, "folded-days")
    sums = {"n": F.count("*"), "amount": F.sum(F.col("value").cast("decimal(15,2)"))}
    days = live.upkeep(live.event_stream(spark, sf), base, ["day", "kind"], sums, "day")
    drop_at_exit(spark, base)
    return tidy(days)


@query("""WITH w AS (SELECT CAST(ts AS DATE) - CAST(k AS INTEGER) AS first_day, event_type AS kind, CAST(value AS DECIMAL(15,2)) AS value
  FROM events, range(0, 7) r(k))
SELECT strftime(first_day, '%Y-%m-%d') AS first_day, kind, count(*) AS n, round(CAST(sum(value) AS DOUBLE) / count(*), 6) AS mean_value FROM w GROUP BY 1, 2""")
def stream_sliding(spark, sf):
    return tidy(live.settle(live.daily_counts(live.event_stream(spark, sf)), "sliding-week", live.sliding_week))


@query(f"""WITH {EVENTS}, s AS (SELECT machine_id, avg(reading) AS m, stddev_samp(reading) AS sd FROM ev GROUP BY 1)
SELECT machine_id, event_id, strftime(ts, '%Y-%m-%d %H:%M:%S.%f') AS ts, reading FROM ev JOIN s USING (machine_id) WHERE abs(reading - m) > 3 * sd""")
def stream_flags(spark, sf):
    flagged = live.flag_readings(live.event_stream(spark, sf), _baseline(spark, sf))
    return tidy(live.drain(flagged.drop("at"), "flags"))


@query(f"""WITH {EVENTS}, s AS (SELECT machine_id, avg(reading) AS m, stddev_samp(reading) AS sd FROM ev GROUP BY 1)
SELECT machine_id, CAST(floor(epoch(ts) / 3600) AS BIGINT) AS epoch_hour, count(*) AS flags, max(reading) AS highest
FROM ev JOIN s USING (machine_id) WHERE abs(reading - m) > 3 * sd GROUP BY 1, 2""")
def stream_hourly_flags(spark, sf):
    """Flagged readings per machine and hour; the hours are kept as state."""
    flagged = live.flag_readings(live.event_stream(spark, sf), _baseline(spark, sf))
    return tidy(live.settle(live.hourly_flags(flagged), "hourly-flags"))


@query("""WITH d AS (SELECT CAST(ts AS DATE) AS d, event_type AS kind, count(*) AS n,
    CAST(sum(CAST(value AS DECIMAL(15,2))) AS DOUBLE) AS amount FROM events GROUP BY 1, 2)
SELECT strftime(d, '%Y-%m-%d') AS day, kind, n, amount FROM d
WHERE CAST(d AS TIMESTAMP) + INTERVAL 2 DAY <= (SELECT date_trunc('millisecond', max(ts)) FROM events)""")
def stream_closed_days(spark, sf):
    """Append mode: a day is written once, when the watermark of one day has passed its end.

    Beyond one batch of files these must be in time order within a day; it fails if any row comes too late.
    """
    return tidy(live.drain(live.daily_counts(live.event_stream(spark, sf, late="1 day")), "closed-days", whole=True))


@query(f"""WITH {EVENTS}, d AS ({_AB.format('day,', 'GROUP BY 1')}),
  k AS (SELECT day, (sum(n_a) OVER w)::BIGINT AS n_a, (sum(x_a) OVER w)::BIGINT AS x_a, (sum(n_b) OVER w)::BIGINT AS n_b, (sum(x_b) OVER w)::BIGINT AS x_b FROM d
    WINDOW w AS (ORDER BY day)),
  t AS (SELECT *, {_chi(True)} AS chi2 FROM k)
SELECT strftime(day, '%Y-%m-%d') AS day, n_a, x_a, n_b, x_b, round(chi2, 6) AS chi2, CAST(CASE WHEN chi2 > 3.841 THEN 1 ELSE 0 END AS BIGINT) AS crossed,
  CAST(CASE WHEN day = (SELECT min(day) FROM t WHERE chi2 > 3.841) THEN 1 ELSE 0 END AS BIGINT) AS first_crossing FROM t""")
def stream_ab(spark, sf):
    return tidy(live.settle(live.arm_counts(live.event_stream(spark, sf)), "arm-looks", live.arm_looks))
