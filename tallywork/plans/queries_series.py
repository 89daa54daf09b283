"""Registered time-series, traffic and advertising queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.columns import year_month
from ..operators import ordered, outliers, series, tables
from ..sources.activity import campaigns, events, readings
from ..sources.shop import from_star
from . import activity, sales
from .catalog import CAMPAIGNS, EVENTS, LINES, query, tidy


_DAILY = """d AS (SELECT CAST(ts AS DATE) AS day, count(*) AS sessions, count(DISTINCT user_id) AS users,
  sum(CAST(value AS DECIMAL(15,2))) AS revenue FROM events GROUP BY 1)"""


@query(f"""WITH {_DAILY} SELECT strftime(day, '%Y-%m-%d') AS day, sessions, users, CAST(revenue AS DOUBLE) AS revenue,
  round(avg(sessions) OVER (ORDER BY day ROWS BETWEEN 6 PRECEDING AND CURRENT ROW), 6) AS mean_7d FROM d""")
def rolling_7d(spark, sf):
    daily = activity.daily_traffic(events(spark, sf))
    return tidy(series.moving_mean(daily, [], "day", "sessions", 7, "mean_7d").orderBy("day"))


@query(f"""WITH {EVENTS}, p AS (SELECT machine_id, ts, event_id, reading,
  row_number() OVER w AS rn FROM ev WINDOW w AS (PARTITION BY machine_id ORDER BY ts, event_id))
SELECT event_id, machine_id, rn AS position, round(avg(reading) OVER (PARTITION BY machine_id ORDER BY rn
  ROWS BETWEEN 23 PRECEDING AND CURRENT ROW), 6) AS mean_24,
  round(reading - lag(reading) OVER (PARTITION BY machine_id ORDER BY rn), 6) AS step FROM p""")
def rolling_rows(spark, sf):
    """Moving mean over raw readings, cut into blocks so that no machine fills one task."""
    r = ordered.with_ranges(readings(events(spark, sf)), ["ts", "event_id"])
    numbered = ordered.running(r, ["machine_id"], ["ts", "event_id"], "bucket")
    seen = ordered.trailing(
        numbered, ["machine_id"], "position", 24,
        {
            "mean_24": lambda w: F.avg("reading").over(w.rowsBetween(-23, 0)),
            "step": lambda w: F.col("reading") - F.lag("reading").over(w),
        },
    )
    return tidy(seen.select("event_id", "machine_id", "position", "mean_24", "step"))


@query(f"""WITH {EVENTS}, p AS (SELECT machine_id, event_id, reading, row_number() OVER w AS rn FROM ev
    WINDOW w AS (PARTITION BY machine_id ORDER BY ts, event_id)),
  n AS (SELECT *, last_value(CASE WHEN reading IS NOT NULL THEN rn END IGNORE NULLS) OVER b AS pp,
    last_value(reading IGNORE NULLS) OVER b AS pv,
    first_value(CASE WHEN reading IS NOT NULL THEN rn END IGNORE NULLS) OVER a AS np,
    first_value(reading IGNORE NULLS) OVER a AS nv FROM p
    WINDOW b AS (PARTITION BY machine_id ORDER BY rn ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
      a AS (PARTITION BY machine_id ORDER BY rn ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))
SELECT event_id, machine_id, rn AS position, reading, round(CASE WHEN reading IS NOT NULL THEN reading WHEN nv IS NULL THEN pv
  ELSE pv + (nv - pv) * (CAST(rn - pp AS DOUBLE) / (np - pp)) END, 6) AS filled FROM n""")
def interpolate_gaps(spark, sf):
    r = ordered.with_ranges(readings(events(spark, sf)), ["ts", "event_id"])
    filled = ordered.interpolate(r, ["machine_id"], ["ts", "event_id"], "bucket", "reading", "filled")
    return tidy(filled.select("event_id", "machine_id", "position", "reading", "filled"))


@query(f"""WITH {EVENTS} SELECT event_id, machine_id, last_value(reading IGNORE NULLS) OVER (PARTITION BY machine_id
  ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS filled FROM ev""")
def forward_filled(spark, sf):
    r = ordered.with_ranges(readings(events(spark, sf)), ["ts", "event_id"])
    filled = ordered.forward_fill(r, ["machine_id"], ["ts", "event_id"], "bucket", "reading", "filled")
    return filled.select("event_id", "machine_id", "filled")


@query(f"""WITH {EVENTS} SELECT event_id, user_id, CAST(sum(CAST(value AS DECIMAL(15,2))) OVER (PARTITION BY user_id
  ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS DOUBLE) AS running_value FROM ev""")
def running_value(spark, sf):
    """Running total over raw rows per user."""
    ev = ordered.with_ranges(events(spark, sf).withColumn("money", F.col("value").cast("decimal(15,2)")), ["ts", "event_id"])
    out = ordered.running(ev, ["user_id"], ["ts", "event_id"], "bucket", {"running_value": "money"})
    return tidy(out.select("event_id", "user_id", "running_value"))


@query(f"""WITH {_DAILY} SELECT CAST(isodow(day) - 1 AS BIGINT) AS weekday, count(*) AS days, round(avg(sessions), 6) AS mean FROM d GROUP BY 1""")
def weekday_traffic(spark, sf):
    return tidy(activity.weekday_means(activity.daily_traffic(events(spark, sf)), "sessions"))


@query("""WITH s AS (SELECT date_trunc('month', o_orderdate) AS m, count(*) AS orders, sum(CAST(o_totalprice AS DECIMAL(15,2))) AS total
    FROM orders GROUP BY 1),
  c AS (SELECT unnest(generate_series((SELECT min(m) FROM s), (SELECT max(m) FROM s), INTERVAL 1 MONTH)) AS m)
SELECT strftime(c.m, '%Y-%m-%d') AS period, coalesce(orders, 0) AS orders, CAST(coalesce(total, 0) AS DOUBLE) AS total
FROM c LEFT JOIN s ON s.m = c.m""")
def calendar_month_totals(spark, sf):
    """All orders by calendar month; a month without a row would still be listed."""
    o = from_star(spark, sf).orders
    totals = series.month_totals(o, "order_date", {"orders": F.lit(1), "total": F.col("order_total")})
    return tidy(totals.orderBy("period"))


@query(f"""WITH {_DAILY} SELECT strftime(day, '%Y-%m-%d') AS day, round(CAST(sessions AS DOUBLE) / lag(sessions) OVER (ORDER BY day) - 1, 6) AS day_change,
  round(CAST(sessions AS DOUBLE) / lag(sessions, 7) OVER (ORDER BY day) - 1, 6) AS week_change FROM d""")
def period_change(spark, sf):
    daily = activity.daily_traffic(events(spark, sf))
    both = series.change(
        series.change(daily, [], "day", "sessions", "day_change"), [], "day", "sessions", "week_change", 7
    )
    return tidy(both.select("day", "day_change", "week_change"))


_PRICES = f"""{LINES}, px AS (SELECT p.p_type AS series, strftime(order_date, '%Y-%m') AS ym,
    CAST(sum(amount) AS DOUBLE) / count(*) AS price FROM lines JOIN part p ON p.p_partkey = product_id GROUP BY 1, 2),
  rt AS (SELECT series, ym, r FROM (SELECT series, ym, price / lag(price) OVER (PARTITION BY series ORDER BY ym) - 1 AS r FROM px) WHERE r IS NOT NULL),
  full_months AS (SELECT ym FROM rt GROUP BY 1 HAVING count(DISTINCT series) = (SELECT count(DISTINCT series) FROM rt)),
  rf AS (SELECT rt.* FROM rt JOIN full_months USING (ym))"""


def _returns(spark, sf):
    """Monthly returns of the mean line amount per category, months complete in all of them."""
    shop = from_star(spark, sf)
    prices = (
        sales.product_totals(shop, year_month("order_date"))
        .join(shop.products.select("product_id", F.col("category").alias("series")), "product_id")
        .groupBy("series", F.col("period").alias("ym"))
        .agg((F.sum("revenue").cast("double") / F.sum("lines")).alias("price"))
    )
    return series.complete_periods(series.returns(prices, "series", "ym", "price"), "series", "ym")


@query(f"""WITH {_PRICES} SELECT series, count(*) AS periods, round(avg(r), 6) AS mean_return, round(stddev_samp(r), 6) AS volatility FROM rf GROUP BY 1""")
def returns_vol(spark, sf):
    return tidy(series.risk(_returns(spark, sf), "series").orderBy("volatility"))


@query(f"""WITH {_PRICES} SELECT series, ym, round(exp(sum(ln(1 + r)) OVER (PARTITION BY series ORDER BY ym)), 6) AS growth FROM rf""")
def cumulative_index(spark, sf):
    return tidy(series.growth_index(_returns(spark, sf), "series", "ym").select("series", "ym", "growth"))


@query(f"""WITH {_PRICES} SELECT x.series AS a, y.series AS b, round(corr(x.r, y.r), 6) AS r
FROM rf x JOIN rf y ON x.ym = y.ym AND x.series < y.series GROUP BY 1, 2""")
def return_corr(spark, sf):
    names = tables.levels(from_star(spark, sf).products, "category", 200)
    return tidy(series.pair_correlations(_returns(spark, sf), "series", "ym", names))


_FUNNEL = f"""WITH {CAMPAIGNS}, f AS (SELECT channel, CAST(sum(impressions) AS BIGINT) AS impressions, CAST(sum(clicks) AS BIGINT) AS clicks,
    CAST(sum(conversions) AS BIGINT) AS conversions, CAST(sum(cost) AS DOUBLE) AS cost, CAST(sum(revenue) AS DOUBLE) AS revenue FROM cg GROUP BY 1),
  r AS (SELECT *, clicks::DOUBLE / impressions AS ctr, conversions::DOUBLE / clicks AS cvr, cost / clicks AS cpc, cost / conversions AS cpa, revenue / cost AS roas FROM f)"""


@query(f"""{_FUNNEL} SELECT channel, impressions, clicks, conversions, cost, revenue, round(ctr, 6) AS ctr, round(cvr, 6) AS cvr,
  round(cpc, 6) AS cpc, round(cpa, 6) AS cpa, round(roas, 6) AS roas FROM r""")
def ad_funnel(spark, sf):
    return tidy(activity.funnel(campaigns(events(spark, sf))).orderBy(F.desc_nulls_last("roas"), "channel"))


@query(f"""{_FUNNEL} SELECT arg_min(channel, (cvr, channel)) AS lowest_cvr, arg_max(channel, (cpa, channel)) AS highest_cpa,
  arg_min(channel, (roas, channel)) AS move_from, arg_max(channel, (roas, channel)) AS move_to FROM r""")
def ad_advice(spark, sf):
    return activity.funnel_advice(activity.funnel(campaigns(events(spark, sf))))


@query(f"""WITH {CAMPAIGNS}, r AS (SELECT day, channel, cost, revenue, CAST(revenue AS DOUBLE) / nullif(CAST(cost AS DOUBLE), 0) AS roas FROM cg),
  w AS (SELECT channel, arg_min(day, (roas, day)) AS worst_day FROM r WHERE roas IS NOT NULL GROUP BY 1)
SELECT strftime(day, '%Y-%m-%d') AS day, channel, CAST(cost AS DOUBLE) AS cost, CAST(revenue AS DOUBLE) AS revenue, round(roas, 6) AS roas,
  round(avg(roas) OVER (PARTITION BY channel ORDER BY day ROWS BETWEEN 6 PRECEDING AND CURRENT ROW), 6) AS roas_mean,
  strftime(worst_day, '%Y-%m-%d') AS worst_day, CAST(CASE WHEN day = worst_day THEN 1 ELSE 0 END AS BIGINT) AS is_worst FROM r LEFT JOIN w USING (channel)""")
def daily_roas(spark, sf):
    return tidy(activity.daily_roas(campaigns(events(spark, sf))))


@query(f"""WITH {EVENTS}, s AS (SELECT kind, avg(value) AS mean, stddev_samp(value) AS sd FROM ev GROUP BY 1)
SELECT event_id, kind, round(value / mean, 6) AS relative, round((value - mean) / sd, 6) AS z FROM ev JOIN s USING (kind)""")
def group_stat_broadcast(spark, sf):
    ev = tables.with_group_stats(
        events(spark, sf), ["kind"], mean=F.avg("value"), sd=F.stddev_samp("value")
    )
    return tidy(
        ev.select(
            "event_id", "kind", (F.col("value") / F.col("mean")).alias("relative"),
            ((F.col("value") - F.col("mean")) / F.col("sd")).alias("z"),
        )
    )


@query(f"""WITH {EVENTS}, s AS (SELECT avg(value) AS m, stddev_samp(value) AS sd FROM ev)
SELECT kind, count(*) AS outliers, round(max(value), 6) AS largest FROM ev, s WHERE abs(value - m) > 3 * sd GROUP BY 1""")
def sigma_global(spark, sf):
    flagged = outliers.sigma_flags(events(spark, sf), "value").where("is_outlier")
    return tidy(flagged.groupBy("kind").agg(F.count("*").alias("outliers"), F.max("value").alias("largest")))


@query(f"""WITH {EVENTS}, s AS (SELECT machine_id, avg(reading) AS m, stddev_samp(reading) AS sd FROM ev GROUP BY 1)
SELECT machine_id, count(*) AS rows, count(*) FILTER (abs(reading - m) > 3 * sd) AS outliers FROM ev JOIN s USING (machine_id) GROUP BY 1""")
def sigma_by_group(spark, sf):
    flagged = outliers.sigma_flags(readings(events(spark, sf)), "reading", ["machine_id"])
    return flagged.groupBy("machine_id").agg(
        F.count("*").alias("rows"), F.count_if(F.col("is_outlier")).alias("outliers")
    )


@query(f"""WITH {EVENTS}, h AS (SELECT machine_id, date_trunc('hour', ts) AS hour, sum(CAST(value AS DECIMAL(15,2)))::DOUBLE / count(*) AS level,
    count(*) AS load, CASE WHEN sum(defect) > 0 THEN 1 ELSE 0 END AS defect FROM ev GROUP BY 1, 2),
  c AS (SELECT median(level) AS cl, median(load) AS ck FROM h WHERE defect = 1),
  t AS (SELECT *, level > cl AND load > ck AS rule FROM h, c)
SELECT round(max(cl), 6) AS cut_level, CAST(max(ck) AS DOUBLE) AS cut_load, count(*) FILTER (rule) AS hits, count(*) FILTER (rule AND defect = 1) AS true_hits,
  count(*) FILTER (defect = 1) AS positives, round(count(*) FILTER (rule AND defect = 1)::DOUBLE / nullif(count(*) FILTER (rule), 0), 6) AS precision,
  round(count(*) FILTER (rule AND defect = 1)::DOUBLE / count(*) FILTER (defect = 1), 6) AS recall FROM t""")
def threshold_rule(spark, sf):
    hourly = (
        readings(events(spark, sf))
        .groupBy("machine_id", F.date_trunc("hour", "ts").alias("hour"))
        .agg(
            (F.sum(F.col("raw_reading").cast("decimal(15,2)")).cast("double") / F.count("*")).alias("level"),
            F.count("*").alias("load"),
            F.max("defect").alias("defect"),
        )
    )
    return tidy(outliers.threshold_rule(hourly, "defect", ["level", "load"]))
