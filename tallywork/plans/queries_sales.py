"""Registered sales queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..sources.shop import areas, from_star
from . import sales
from .catalog import AMOUNTS, BUYERS, LINES, query, tidy


@query(f"""WITH {LINES}
SELECT p.p_type AS category, CAST(sum(amount) AS DOUBLE) AS revenue, count(*) AS lines
FROM lines JOIN part p ON p.p_partkey = product_id GROUP BY 1""")
def sales_by_category(spark, sf):
    return tidy(sales.by_product(from_star(spark, sf), "category"))


@query(f"""WITH {BUYERS}
SELECT c.c_mktsegment AS acquisition_channel, CAST(sum(total_spend) AS DOUBLE) AS revenue,
       CAST(sum(n_orders) AS BIGINT) AS orders, count(*) AS buyers,
       round(CAST(sum(total_spend) AS DOUBLE) / sum(n_orders), 6) AS aov
FROM pc JOIN customer c ON c.c_custkey = customer_id GROUP BY 1""")
def sales_by_channel(spark, sf):
    return tidy(sales.by_customer(from_star(spark, sf), "acquisition_channel"))


@query(f"""WITH {BUYERS}
SELECT n.n_name AS prefecture, CAST(sum(total_spend) AS DOUBLE) AS revenue, count(*) AS buyers
FROM pc JOIN customer c ON c.c_custkey = customer_id JOIN nation n ON n.n_nationkey = c.c_nationkey
GROUP BY 1""")
def sales_by_prefecture(spark, sf):
    table = sales.by_customer(from_star(spark, sf), "area_id")
    named = table.join(areas(spark, sf), "area_id")
    return tidy(named.select("prefecture", "revenue", "buyers").orderBy(F.desc("revenue"), "prefecture"))


@query(f"""WITH {AMOUNTS}, m AS (SELECT strftime(order_date, '%Y-%m') AS ym, sum(amount) AS revenue,
  count(*) AS orders FROM oa GROUP BY 1)
SELECT ym, CAST(revenue AS DOUBLE) AS revenue, orders,
       CAST(sum(revenue) OVER (ORDER BY ym) AS DOUBLE) AS running_revenue,
       CAST(CASE WHEN row_number() OVER (ORDER BY revenue DESC, ym DESC) = 1 THEN 1 ELSE 0 END AS BIGINT) AS is_peak
FROM m""")
def monthly_sales_running(spark, sf):
    return tidy(sales.monthly_running(from_star(spark, sf)))


@query(f"""WITH {AMOUNTS}, m AS (SELECT strftime(order_date, '%Y-%m') AS period, sum(amount) AS revenue
  FROM oa GROUP BY 1), y AS (SELECT substr(period, 1, 4) AS period, sum(revenue) AS revenue FROM m GROUP BY 1)
SELECT 'month' AS level, period, CAST(revenue AS DOUBLE) AS revenue,
       round(CAST(revenue AS DOUBLE) / lag(CAST(revenue AS DOUBLE)) OVER (ORDER BY period) - 1, 6) AS change_rate FROM m
UNION ALL
SELECT 'year', period, CAST(revenue AS DOUBLE),
       round(CAST(revenue AS DOUBLE) / lag(CAST(revenue AS DOUBLE)) OVER (ORDER BY period) - 1, 6) FROM y""")
def mom_yoy(spark, sf):
    return tidy(sales.growth(from_star(spark, sf)))


@query(f"""WITH {AMOUNTS}
SELECT CAST(year(order_date) AS BIGINT) AS year, CAST(sum(amount) AS DOUBLE) AS revenue,
       count(*) AS orders, count(DISTINCT customer_id) AS buyers,
       round(CAST(sum(amount) AS DOUBLE) / count(*), 6) AS aov,
       round(CAST(count(*) AS DOUBLE) / count(DISTINCT customer_id), 6) AS frequency
FROM oa GROUP BY 1""")
def yearly_decomposition(spark, sf):
    return tidy(sales.yearly(from_star(spark, sf)))


@query(f"""WITH {LINES}
SELECT CAST(month(order_date) AS BIGINT) AS month,
       round(CAST(sum(amount) AS DOUBLE) / count(*), 6) AS mean_line, count(*) AS lines
FROM lines GROUP BY 1""")
def seasonality(spark, sf):
    return tidy(sales.seasonality(from_star(spark, sf)))


@query(f"""WITH {BUYERS}
SELECT customer_id, CAST(total_spend AS DOUBLE) AS total_spend, n_orders, c.c_name AS name,
       c.c_mktsegment AS acquisition_channel
FROM pc JOIN customer c ON c.c_custkey = customer_id
QUALIFY row_number() OVER (ORDER BY total_spend DESC, customer_id) <= 10""")
def top_customers(spark, sf):
    best = sales.top_customers(from_star(spark, sf), 10, ("name", "acquisition_channel"))
    return tidy(best.drop("avg_order"))


@query(f"""WITH {LINES}, s AS (SELECT p.p_type AS category, product_id, p.p_name AS product_name,
  sum(amount) AS revenue FROM lines JOIN part p ON p.p_partkey = product_id GROUP BY 1, 2, 3)
SELECT category, product_id, product_name, CAST(revenue AS DOUBLE) AS revenue FROM s
QUALIFY row_number() OVER (PARTITION BY category ORDER BY revenue DESC, product_id) = 1""")
def top_product_per_category(spark, sf):
    best = sales.top_products(from_star(spark, sf), 1)
    return tidy(best.select("category", "product_id", "product_name", "revenue"))


@query(f"""WITH {AMOUNTS}
SELECT c.c_mktsegment AS acquisition_channel, count(*) AS orders,
       round(CAST(sum(amount) AS DOUBLE) / count(*), 6) AS mean_order,
       round(quantile_cont(CAST(amount AS DOUBLE), 0.5), 6) AS median_order
FROM oa JOIN customer c ON c.c_custkey = customer_id GROUP BY 1""")
def aov_by_segment(spark, sf):
    return tidy(sales.aov_by(from_star(spark, sf), "acquisition_channel"))


@query(f"""WITH {BUYERS}, f AS (SELECT unnest([0.1::DOUBLE, 0.2::DOUBLE]) AS fraction),
r AS (SELECT total_spend, row_number() OVER (ORDER BY total_spend DESC) AS rn, count(*) OVER () AS n FROM pc)
SELECT fraction, CAST(max(greatest(1, floor(n * fraction))) AS BIGINT) AS head_rows,
       CAST(sum(total_spend) FILTER (rn <= greatest(1, floor(n * fraction))) AS DOUBLE) AS head_sum,
       CAST(sum(total_spend) AS DOUBLE) AS total_sum,
       round(CAST(sum(total_spend) FILTER (rn <= greatest(1, floor(n * fraction))) AS DOUBLE)
             / CAST(sum(total_spend) AS DOUBLE), 6) AS revenue_share
FROM r, f GROUP BY fraction""")
def pareto_share(spark, sf):
    return tidy(sales.pareto(from_star(spark, sf)), head_sum=2, total_sum=2)


@query(f"""WITH {AMOUNTS}, t AS (SELECT year(order_date) AS year, amount,
  CASE WHEN row_number() OVER (PARTITION BY customer_id ORDER BY order_date, order_id) = 1
       THEN 'new' ELSE 'repeat' END AS buyer_type FROM oa),
g AS (SELECT year, sum(amount) FILTER (buyer_type = 'new') AS a, sum(amount) FILTER (buyer_type = 'repeat') AS b
  FROM t GROUP BY 1),
u AS (SELECT year, 'new' AS buyer_type, coalesce(a, 0) AS revenue FROM g UNION ALL
  SELECT year, 'repeat', coalesce(b, 0) FROM g)
SELECT CAST(year AS BIGINT) AS year, buyer_type, CAST(revenue AS DOUBLE) AS revenue,
       round(CAST(revenue AS DOUBLE) / CAST(sum(revenue) OVER (PARTITION BY year) AS DOUBLE), 6) AS share FROM u""")
def new_vs_repeat(spark, sf):
    return tidy(sales.new_vs_repeat(from_star(spark, sf)))


@query(f"""WITH {BUYERS} SELECT n_orders, count(*) AS buyers FROM pc GROUP BY 1""")
def order_count_dist(spark, sf):
    return tidy(sales.order_count_distribution(from_star(spark, sf)))


@query(f"""WITH {LINES}, s AS (SELECT p.p_type AS category, sum(amount) AS revenue, count(*) AS lines
  FROM lines JOIN part p ON p.p_partkey = product_id GROUP BY 1)
SELECT category, CAST(revenue AS DOUBLE) AS revenue, lines,
       round(CAST(revenue AS DOUBLE) / CAST(sum(revenue) OVER () AS DOUBLE), 6) AS revenue_share FROM s""")
def category_share(spark, sf):
    return tidy(sales.category_share(from_star(spark, sf)))


@query(f"""WITH {LINES}, s AS (SELECT p.p_type AS category,
  coalesce(sum(amount) FILTER (year(order_date) = 1999), 0) AS before,
  coalesce(sum(amount) FILTER (year(order_date) = 2000), 0) AS after
  FROM lines JOIN part p ON p.p_partkey = product_id GROUP BY 1)
SELECT category, CAST(before AS DOUBLE) AS before, CAST(after AS DOUBLE) AS after,
       round(CAST(after AS DOUBLE) / nullif(CAST(before AS DOUBLE), 0), 6) AS growth,
       round(CAST(after AS DOUBLE) / CAST(sum(after) OVER () AS DOUBLE), 6) AS after_share FROM s""")
def category_year_growth(spark, sf):
    return tidy(sales.category_growth(from_star(spark, sf), 1999, 2000))


@query(f"""WITH {BUYERS}, k AS (SELECT sum(total_spend) AS gmv, sum(n_orders) AS orders, count(*) AS buyers,
  count(*) FILTER (n_orders >= 2) AS again FROM pc),
c AS (SELECT sum(u * CAST(CAST(p.p_retailprice AS DECIMAL(15,2)) AS DOUBLE)) AS a,
  sum(u * CAST(CAST(CAST(p.p_retailprice AS DECIMAL(15,2)) * CAST(0.6 AS DECIMAL(3,1)) AS DECIMAL(15,2)) AS DOUBLE)) AS b
  FROM (SELECT product_id, sum(quantity) AS u FROM lines GROUP BY 1) JOIN part p ON p.p_partkey = product_id)
SELECT CAST(gmv AS DOUBLE) AS gmv, CAST(orders AS BIGINT) AS orders, buyers,
  round(CAST(gmv AS DOUBLE) / orders, 6) AS aov, round(CAST(orders AS DOUBLE) / buyers, 6) AS frequency,
  round(CAST(again AS DOUBLE) / buyers, 6) AS repeat_rate, round(1 - b / a, 6) AS margin_rate FROM k, c""")
def kpi_summary(spark, sf):
    return tidy(sales.kpis(from_star(spark, sf)))


@query(f"""WITH {BUYERS} SELECT count(*) AS buyers,
  round(CAST(sum(total_spend) AS DOUBLE) / count(*), 4) AS mean_spend FROM pc""")
def avg_customer_revenue(spark, sf):
    return tidy(sales.mean_customer_revenue(from_star(spark, sf)), 4)


@query(f"""WITH {AMOUNTS}
SELECT order_id, customer_id, strftime(order_date, '%Y-%m-%d') AS order_date, CAST(amount AS DOUBLE) AS amount,
       row_number() OVER w - 1 AS nth, CAST(sum(amount) OVER w AS DOUBLE) AS spend_so_far FROM oa
WINDOW w AS (PARTITION BY customer_id ORDER BY order_date, order_id)""")
def nth_event(spark, sf):
    return tidy(sales.order_ordinals(from_star(spark, sf)))


@query(f"""WITH {BUYERS}
SELECT CASE WHEN n_orders >= 2 THEN 'repeat' ELSE 'one-time' END AS buyer_type, count(*) AS buyers,
       round(CAST(sum(total_spend) AS DOUBLE) / count(*), 4) AS mean_spend FROM pc GROUP BY 1""")
def spend_by_loyalty(spark, sf):
    return tidy(sales.spend_by_loyalty(from_star(spark, sf)), 4)


@query("""WITH p AS (SELECT CAST(p_retailprice AS DECIMAL(15,2)) AS price,
  CAST(CAST(p_retailprice AS DECIMAL(15,2)) * CAST(0.6 AS DECIMAL(3,1)) AS DECIMAL(15,2)) AS cost FROM part)
SELECT CASE WHEN price < 930 THEN 'low' WHEN price < 970 THEN 'mid' ELSE 'high' END AS band,
       count(*) AS products, round(CAST(sum(price - cost) AS DOUBLE) / count(*), 6) AS mean_profit,
       round(CAST(sum(price - cost) AS DOUBLE) / CAST(sum(price) AS DOUBLE), 6) AS margin FROM p GROUP BY 1""")
def price_bands_margin(spark, sf):
    return tidy(sales.price_bands(from_star(spark, sf), (930, 970)))


@query("""WITH s AS (SELECT l_partkey, sum(CAST(l_extendedprice AS DECIMAL(15,2))) AS a FROM lineitem
  WHERE l_shipdate >= DATE '1998-03-01' AND l_shipdate < DATE '1998-04-01' GROUP BY 1)
SELECT p_type AS category, count(*) AS products, count(*) FILTER (a IS NULL) AS unsold,
       CAST(sum(coalesce(a, 0)) AS DOUBLE) AS revenue
FROM part LEFT JOIN s ON l_partkey = p_partkey GROUP BY 1""")
def unsold_parts(spark, sf):
    """Parts without a sale in one month, the period being what is asked for."""
    shop = from_star(spark, sf)
    march = shop.order_items.where(
        (F.col("ship_date") >= F.lit("1998-03-01").cast("date"))
        & (F.col("ship_date") < F.lit("1998-04-01").cast("date"))
    )
    rows = sales.unsold_products(shop, march.select("product_id", "amount"))
    return tidy(
        rows.groupBy("category").agg(
            F.count("*").alias("products"),
            F.count_if(~F.col("sold")).alias("unsold"),
            F.sum("revenue").alias("revenue"),
        )
    )


@query(f"""WITH {LINES}
SELECT p.p_type AS category, p.p_brand AS brand, c.c_mktsegment AS acquisition_channel,
       CAST(year(order_date) AS BIGINT) AS year, count(*) AS lines, CAST(sum(amount) AS DOUBLE) AS revenue,
       round(min(CAST(amount AS DOUBLE) / quantity), 8) AS lowest_unit_price
FROM lines JOIN part p ON p.p_partkey = product_id JOIN customer c ON c.c_custkey = customer_id
GROUP BY 1, 2, 3, 4""")
def star_base(spark, sf):
    wide = sales.wide_lines(from_star(spark, sf))
    unit = F.col("amount").cast("double") / F.col("quantity")
    return tidy(
        wide.groupBy("category", "brand", "acquisition_channel", F.year("order_date").alias("year")).agg(
            F.count("*").alias("lines"), F.sum("amount").alias("revenue"), F.min(unit).alias("lowest_unit_price")
        ),
        lowest_unit_price=8,  # cents over a quantity of 32 need seven places
    )
