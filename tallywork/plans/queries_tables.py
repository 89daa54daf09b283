"""Registered relational queries: predicates, joins, grouping, pivots, shares, sorting, set work."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.columns import bands_below, bands_upto, day_text, parse_date, ratio, recode, thousands, trim_all, year_month
from ..functions.stats import share_where
from ..operators import clean, profile, tables
from ..operators.ordered import value_ladder
from ..sources.activity import campaigns, events
from ..sources.files import inline, read_parquet, run_sql
from ..sources.shop import areas, from_star
from . import sales
from .activity import tally
from .catalog import AMOUNTS, BUYERS, CAMPAIGNS, EVENTS, LINES, query, tidy

LEVELS = 50  # most columns that a pivot of this file should make


@query("""SELECT count(*) FILTER (p_size >= 30 AND p_brand = 'Brand#13') AS both_hold,
  count(*) FILTER (p_size < 5 OR p_size > 45) AS either_holds,
  count(*) FILTER (p_brand IN ('Brand#1', 'Brand#2', 'Brand#3')) AS in_list,
  count(*) FILTER (p_size BETWEEN 20 AND 29) AS in_range,
  count(*) FILTER (p_name LIKE 'small%') AS starts_with,
  count(*) FILTER (p_name ILIKE 'SMALL%') AS starts_any_case,
  count(*) FILTER (p_name LIKE '_ed %') AS one_wildcard,
  count(*) FILTER (p_type <> 'PROMO') AS differs,
  count(*) FILTER (p_brand IS NULL) AS is_null,
  count(*) FILTER (p_size > 10 AND p_type = 'LARGE') AS by_text FROM part""")
def predicate_mix(spark, sf):
    p = from_star(spark, sf).products
    c = F.col
    tests = {
        "both_hold": (c("size") >= 30) & (c("brand") == "Brand#13"),
        "either_holds": (c("size") < 5) | (c("size") > 45),
        "in_list": c("brand").isin("Brand#1", "Brand#2", "Brand#3"),
        "in_range": c("size").between(20, 29),
        "starts_with": c("product_name").like("small%"),
        "starts_any_case": c("product_name").ilike("SMALL%"),
        "one_wildcard": c("product_name").like("_ed %"),
        "differs": c("category") != "PROMO",
        "is_null": c("brand").isNull(),
        "by_text": F.expr("size > 10 AND category = 'LARGE'"),
    }
    return tidy(p.agg(*[F.count_if(t).alias(n) for n, t in tests.items()]))


@query("""SELECT p_partkey AS product_id, p_name AS product_name, p_size AS size FROM part
  WHERE p_size >= 30 AND p_brand IN ('Brand#13', 'Brand#14') AND p_type = 'LARGE'""")
def filtered_products(spark, sf):
    p = from_star(spark, sf).products
    kept = p.where("size >= 30 AND brand IN ('Brand#13', 'Brand#14')").where(F.col("category") == "LARGE")
    return kept.select("product_id", "product_name", "size")


@query("""WITH b AS (SELECT CASE WHEN p_size < 10 THEN 'under 10' WHEN p_size < 20 THEN '10s'
  WHEN p_size < 30 THEN '20s' WHEN p_size < 40 THEN '30s' ELSE '40 and over' END AS left_closed,
  CASE WHEN p_size > 9 AND p_size <= 19 THEN '10-19' WHEN p_size > 19 AND p_size <= 29 THEN '20-29'
  WHEN p_size > 29 AND p_size <= 39 THEN '30-39' END AS right_closed FROM part)
SELECT left_closed, right_closed, count(*) AS products FROM b GROUP BY 1, 2""")
def case_bands(spark, sf):
    p = from_star(spark, sf).products
    left = bands_below("size", (10, 20, 30, 40), ("under 10", "10s", "20s", "30s", "40 and over"))
    right = bands_upto("size", (9, 19, 29, 39), ("10-19", "20-29", "30-39"))
    return p.groupBy(left.alias("left_closed"), right.alias("right_closed")).agg(
        F.count("*").alias("products")
    )


@query("""SELECT p_type AS category, count(*) AS products FROM part
  WHERE CAST(p_retailprice AS DECIMAL(15,2)) > (SELECT sum(CAST(p_retailprice AS DECIMAL(15,2)))::DOUBLE / count(*) FROM part)
  GROUP BY 1""")
def above_average(spark, sf):
    p = from_star(spark, sf).products
    mean = p.agg(F.sum("price").cast("double") / F.count("*")).scalar()
    return p.where(F.col("price").cast("double") > mean).groupBy("category").agg(F.count("*").alias("products"))


@query(f"""WITH {BUYERS}, s AS (SELECT c.c_nationkey AS area_id, count(*) AS buyers,
  CAST(sum(total_spend) AS DOUBLE) AS revenue FROM pc JOIN customer c ON c.c_custkey = customer_id GROUP BY 1)
SELECT CAST(area_id AS BIGINT) AS area_id, buyers, revenue FROM s WHERE buyers >= 50""")
def having_big_groups(spark, sf):
    groups = sales.by_customer(from_star(spark, sf), "area_id").select("area_id", "buyers", "revenue")
    return tidy(groups.where(F.col("buyers") >= 50))


@query("""WITH l AS (SELECT l_partkey AS k, count(*) AS l FROM lineitem GROUP BY 1),
  r AS (SELECT p_partkey AS k, count(*) AS r FROM part GROUP BY 1),
  b AS (SELECT coalesce(l, 0) AS l, coalesce(r, 0) AS r FROM l FULL JOIN r USING (k))
SELECT CAST(sum(l) AS BIGINT) AS left_rows, CAST(sum(r) AS BIGINT) AS right_rows,
  (SELECT count(*) FROM lineitem JOIN part ON p_partkey = l_partkey) AS inner_rows,
  (SELECT count(*) FROM lineitem LEFT JOIN part ON p_partkey = l_partkey) AS left_join_rows,
  (SELECT count(*) FROM lineitem RIGHT JOIN part ON p_partkey = l_partkey) AS right_join_rows,
  (SELECT count(*) FROM lineitem FULL JOIN part ON p_partkey = l_partkey) AS full_join_rows,
  count(*) FILTER (r = 0) AS left_only_keys, count(*) FILTER (l = 0) AS right_only_keys,
  count(*) FILTER (r > 1) AS repeated_right_keys FROM b""")
def outer_join_audit(spark, sf):
    shop = from_star(spark, sf)
    return tidy(tables.fan_out(shop.order_items.select("product_id"), shop.products.select("product_id"), "product_id"))


@query("""WITH l AS (SELECT l_partkey AS product_id, sum(CAST(l_extendedprice AS DECIMAL(15,2))) AS sold FROM lineitem
    GROUP BY 1),
  r AS (SELECT p_partkey AS product_id, p_type AS category FROM part)
SELECT product_id, category, CAST(sold AS DOUBLE) AS sold,
  CASE WHEN category IS NULL THEN 'left only' WHEN sold IS NULL THEN 'right only' ELSE 'both' END AS side
FROM l FULL JOIN r USING (product_id)""")
def full_join_sides(spark, sf):
    shop = from_star(spark, sf)
    sold = shop.order_items.groupBy("product_id").agg(F.sum("amount").alias("sold"))
    listed = shop.products.select("product_id", "category")
    side = F.when(F.col("category").isNull(), "left only").when(F.col("sold").isNull(), "right only").otherwise("both")
    return tidy(sold.join(listed, "product_id", "full").withColumn("side", side))


@query(f"""WITH {LINES}, s AS (SELECT product_id, sum(amount) AS a FROM lines GROUP BY 1)
SELECT p_type AS category, count(*) AS listed, count(a) AS sold, CAST(coalesce(sum(a), 0) AS DOUBLE) AS revenue
FROM s RIGHT JOIN part ON p_partkey = product_id GROUP BY 1""")
def right_join_products(spark, sf):
    shop = from_star(spark, sf)
    sold = sales.product_totals(shop)
    return tidy(
        sold.join(shop.products.select("product_id", "category"), "product_id", "right")
        .groupBy("category")
        .agg(
            F.count("*").alias("listed"),
            F.count("revenue").alias("sold"),
            F.coalesce(F.sum("revenue"), F.lit(0).cast("decimal(25,2)")).alias("revenue"),
        )
    )


@query("""SELECT c_mktsegment AS acquisition_channel, count(*) AS customers FROM customer
  WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_orderstatus = 'F'
    AND o_orderdate >= DATE '1999-01-01' AND o_orderdate < DATE '1999-04-01') GROUP BY 1""")
def inactive_customers(spark, sf):
    shop = from_star(spark, sf)
    recent = shop.completed_orders().where("order_date >= DATE '1999-01-01' AND order_date < DATE '1999-04-01'")
    quiet = shop.customers.join(recent.select("customer_id"), "customer_id", "left_anti")
    return quiet.groupBy("acquisition_channel").agg(F.count("*").alias("customers"))


@query(f"""WITH {BUYERS}
SELECT strftime(order_date, '%Y') AS year, count(*) AS orders, CAST(sum(amount) AS DOUBLE) AS revenue
FROM oa WHERE customer_id IN (SELECT customer_id FROM pc WHERE n_orders >= 2) GROUP BY 1""")
def semi_segments(spark, sf):
    shop = from_star(spark, sf)
    # asking for a known spend keeps both sides on the same columns, so lines are read once
    repeat = sales.customer_totals(shop).where("n_orders >= 2 AND total_spend IS NOT NULL")
    kept = sales.order_amounts(shop).join(repeat, "customer_id", "left_semi")
    return tidy(
        kept.groupBy(F.date_format("order_date", "yyyy").alias("year")).agg(
            F.count("*").alias("orders"), F.sum("amount").alias("revenue")
        )
    )


@query("""SELECT count(*) AS rows, count(l_shipdate) AS dated, count(DISTINCT l_orderkey) AS orders,
  CAST(sum(CAST(l_extendedprice AS DECIMAL(15,2))) AS DOUBLE) AS total,
  round(CAST(sum(CAST(l_extendedprice AS DECIMAL(15,2))) AS DOUBLE) / count(*), 6) AS mean,
  min(l_extendedprice) AS smallest, max(l_extendedprice) AS largest FROM lineitem""")
def global_aggs(spark, sf):
    items = from_star(spark, sf).order_items
    # distinct orders are counted over pre-summed orders, which stay one row each
    per_order = items.groupBy("order_id").agg(
        F.count("*").alias("n"),
        F.count("ship_date").alias("d"),
        F.sum("amount").alias("s"),
        F.min("amount").alias("lo"),
        F.max("amount").alias("hi"),
    )
    return tidy(
        per_order.agg(
            F.sum("n").alias("rows"),
            F.sum("d").alias("dated"),
            F.count("order_id").alias("orders"),
            F.sum("s").alias("total"),
            ratio(F.sum("s"), F.sum("n")).alias("mean"),
            F.min("lo").alias("smallest"),
            F.max("hi").alias("largest"),
        )
    )


@query("""SELECT p_brand AS brand, p_type AS category, count(*) AS products,
  round(CAST(sum(CAST(p_retailprice AS DECIMAL(15,2))) AS DOUBLE) / count(*), 6) AS mean_price,
  CAST(min(p_size) AS BIGINT) AS smallest, CAST(max(p_size) AS BIGINT) AS largest FROM part GROUP BY 1, 2""")
def group_multi(spark, sf):
    p = from_star(spark, sf).products
    return tidy(
        p.groupBy("brand", "category")
        .agg(
            F.count("*").alias("products"),
            ratio(F.sum("price"), F.count("*")).alias("mean_price"),
            F.min("size").alias("smallest"),
            F.max("size").alias("largest"),
        )
        .orderBy("brand", "category")
    )


@query(f"""WITH {BUYERS}
SELECT customer_id, c.c_nationkey::BIGINT AS area_id, n_orders, CAST(total_spend AS DOUBLE) AS total_spend,
  round(CAST(total_spend AS DOUBLE) / n_orders, 8) AS avg_order
FROM pc JOIN customer c ON c.c_custkey = customer_id""")
def two_level(spark, sf):
    return tidy(sales.buyer_features(from_star(spark, sf), "area_id"), avg_order=8)


@query(f"""WITH {CAMPAIGNS}
SELECT channel, round(CAST(sum(clicks) AS DOUBLE) / sum(impressions), 6) AS ratio_of_sums,
  round(CAST(sum(revenue) AS DOUBLE) / sum(conversions), 6) AS revenue_per_conversion,
  round(avg(CASE WHEN clicks >= conversions THEN 1.0 ELSE 0.0 END), 6) AS days_clicks_lead FROM cg GROUP BY 1""")
def ratio_of_sums(spark, sf):
    daily = campaigns(events(spark, sf))
    return tidy(
        daily.groupBy("channel").agg(
            ratio(F.sum("clicks"), F.sum("impressions")).alias("ratio_of_sums"),
            ratio(F.sum("revenue"), F.sum("conversions")).alias("revenue_per_conversion"),
            share_where(F.col("clicks") >= F.col("conversions")).alias("days_clicks_lead"),
        )
    )


@query("""WITH o AS (SELECT c_mktsegment AS acquisition_channel, o_orderpriority AS payment_method, count(*) AS orders
  FROM orders JOIN customer ON c_custkey = o_custkey GROUP BY 1, 2)
SELECT acquisition_channel, payment_method, orders,
  round(CAST(orders AS DOUBLE) / sum(orders) OVER (PARTITION BY acquisition_channel), 6) AS share FROM o""")
def segment_crosstab_share(spark, sf):
    return tidy(tables.share_within(_channel_priority(from_star(spark, sf)), ["acquisition_channel"], "orders"))


def _channel_priority(shop):
    """Orders per channel and payment method; counted per customer before the join."""
    per_customer = shop.orders.groupBy("customer_id", "payment_method").agg(F.count("*").alias("k"))
    return (
        per_customer.join(shop.customers.select("customer_id", "acquisition_channel"), "customer_id")
        .groupBy("acquisition_channel", "payment_method")
        .agg(F.sum("k").alias("orders"))
    )


# the levels of the test tables, for SQL that has to name its columns; the queries find theirs in the data
_PRIORITIES = ("1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW")
_KINDS = ("click", "error", "purchase", "signup", "view")


def _counted(column, levels):
    return ", ".join(f"count(*) FILTER ({column} = '{v}') AS \"{v}\"" for v in levels)


@query(f"""SELECT c_mktsegment AS acquisition_channel, {_counted('o_orderpriority', _PRIORITIES)}
  FROM orders JOIN customer ON c_custkey = o_custkey GROUP BY 1""")
def crosstab_counts(spark, sf):
    """One column per priority that the orders have."""
    shop = from_star(spark, sf)
    names = {p: p for p in tables.levels(shop.orders, "payment_method", LEVELS)}
    long = _channel_priority(shop)
    return tables.wide(long, ["acquisition_channel"], "payment_method", names, "sum", fill=0, value="orders")


@query(f"""WITH {LINES}, c AS (SELECT p.p_type AS category, CAST(year(order_date) AS VARCHAR) AS year,
  sum(amount) AS revenue, count(*) AS lines FROM lines JOIN part p ON p.p_partkey = product_id GROUP BY CUBE (1, 2))
SELECT coalesce(category, 'total') AS category, coalesce(year, 'total') AS year,
  CAST(revenue AS DOUBLE) AS revenue, lines FROM c""")
def pivot_margins(spark, sf):
    shop = from_star(spark, sf)
    cells = sales.product_totals(shop, F.year("order_date").cast("string")).join(
        shop.products.select("product_id", "category"), "product_id"
    ).withColumnRenamed("period", "year")
    both = tables.with_margins(
        cells, "category", "year", [F.sum("revenue").alias("revenue"), F.sum("lines").alias("lines")]
    )
    return tidy(both)


@query(f"""SELECT strftime(ts, '%Y-%m-%d') AS day, {_counted('event_type', _KINDS)} FROM events GROUP BY 1""")
def long_to_wide(spark, sf):
    """One column per kind of event that the data has."""
    cells = events(spark, sf).groupBy("day", "kind").agg(F.count("*").alias("n"))
    kinds = tables.levels(cells, "kind", LEVELS)
    wide = tables.to_wide(cells, "day", "kind", {k: k for k in kinds}, "n")
    return tidy(wide.na.fill(0, subset=kinds))


@query(f"""WITH {AMOUNTS}, s AS (SELECT customer_id, sum(amount) AS spend FROM oa GROUP BY 1)
SELECT customer_id, CAST(spend AS DOUBLE) AS spend,
  round(CAST(spend AS DOUBLE) / CAST(sum(spend) OVER () AS DOUBLE), 9) AS share FROM s""")
def column_share(spark, sf):
    spend = sales.customer_totals(from_star(spark, sf)).select("customer_id", F.col("total_spend").alias("spend"))
    return tidy(tables.share_of_all(spend, "spend"), share=9)


@query(f"""WITH {AMOUNTS}, m AS (SELECT strftime(order_date, '%Y-%m') AS ym, c.c_mktsegment AS acquisition_channel,
  sum(amount) AS revenue FROM oa JOIN customer c ON c.c_custkey = customer_id GROUP BY 1, 2)
SELECT acquisition_channel, arg_max(ym, (revenue, ym)) AS best_month, CAST(max(revenue) AS DOUBLE) AS best,
  arg_min(ym, (revenue, ym)) AS worst_month, CAST(min(revenue) AS DOUBLE) AS worst FROM m GROUP BY 1""")
def argmax_rows(spark, sf):
    shop = from_star(spark, sf)
    per_customer = sales.order_amounts(shop).groupBy("customer_id", year_month("order_date").alias("ym")).agg(
        F.sum("amount").alias("a")
    )
    months = (
        per_customer.join(shop.customers.select("customer_id", "acquisition_channel"), "customer_id")
        .groupBy("acquisition_channel", "ym")
        .agg(F.sum("a").alias("revenue"))
    )
    key = F.struct("revenue", "ym")
    return tidy(
        months.groupBy("acquisition_channel").agg(
            F.max_by("ym", key).alias("best_month"),
            F.max("revenue").alias("best"),
            F.min_by("ym", key).alias("worst_month"),
            F.min("revenue").alias("worst"),
        )
    )


@query("""SELECT lines, count(*) AS orders FROM (SELECT l_orderkey, count(*) AS lines FROM lineitem GROUP BY 1) GROUP BY 1""")
def group_size_hist(spark, sf):
    sizes = from_star(spark, sf).order_items.groupBy("order_id").agg(F.count("*").alias("lines"))
    return sizes.groupBy("lines").agg(F.count("*").alias("orders")).orderBy("lines")


@query("""SELECT * FROM (SELECT 'dearest' AS list, p_partkey AS product_id, p_retailprice AS price FROM part
    QUALIFY row_number() OVER (ORDER BY p_retailprice DESC, p_partkey) <= 5)
  UNION ALL SELECT * FROM (SELECT 'cheapest', p_partkey, p_retailprice FROM part
    QUALIFY row_number() OVER (ORDER BY p_retailprice, p_partkey) <= 5)
  UNION ALL SELECT * FROM (SELECT 'by brand, dearest first', p_partkey, p_retailprice FROM part
    QUALIFY row_number() OVER (ORDER BY p_brand, p_retailprice DESC, p_partkey) <= 5)""")
def sort_topk(spark, sf):
    p = from_star(spark, sf).products
    take = lambda label, *order: p.orderBy(*order, "product_id").limit(5).select(
        F.lit(label).alias("list"), "product_id", "price"
    )
    price = F.col("price")
    lists = take("dearest", price.desc()).unionByName(take("cheapest", price.asc()))
    return tidy(lists.unionByName(take("by brand, dearest first", F.col("brand").asc(), price.desc())))


@query(f"""WITH {AMOUNTS}
SELECT c.c_mktsegment AS acquisition_channel, order_id, CAST(amount AS DOUBLE) AS amount,
  row_number() OVER (PARTITION BY c.c_mktsegment ORDER BY amount DESC, order_id) AS rank
FROM oa JOIN customer c ON c.c_custkey = customer_id
QUALIFY row_number() OVER (PARTITION BY c.c_mktsegment ORDER BY amount DESC, order_id) <= 3""")
def top_n_per_group(spark, sf):
    shop = from_star(spark, sf)
    rows = sales.order_amounts(shop).join(
        shop.customers.select("customer_id", "acquisition_channel"), "customer_id"
    )
    top = tables.top_per_group(
        rows.select("acquisition_channel", "order_id", "amount"),
        ["acquisition_channel"], [F.desc("amount"), F.asc("order_id")], 3,
    )
    return tidy(top)


@query(f"""WITH {BUYERS}, v AS (SELECT total_spend AS spend, count(*) AS n FROM pc GROUP BY 1)
SELECT CAST(spend AS DOUBLE) AS spend, n,
  CAST(sum(n) OVER (ORDER BY spend DESC) AS BIGINT) AS buyers_at_or_above,
  round(CAST(sum(n * spend) OVER (ORDER BY spend DESC) AS DOUBLE)
    / CAST(sum(n * spend) OVER () AS DOUBLE), 9) AS share_at_or_above FROM v""")
def cumulative_share(spark, sf):
    buyers = sales.customer_totals(from_star(spark, sf)).select(F.col("total_spend").alias("spend"))
    ladder = value_ladder(buyers, "spend")
    return tidy(
        ladder.select(
            "spend",
            "n",
            (F.col("n_total") - F.col("n_below")).alias("buyers_at_or_above"),
            ratio(F.col("sum_total") - F.col("sum_below"), "sum_total").alias("share_at_or_above"),
        ),
        share_at_or_above=9,
    )


@query("""SELECT 'parts' AS source, count(DISTINCT name) AS names, count(*) AS rows FROM (
    SELECT p_name AS name FROM part UNION ALL SELECT s_name FROM supplier)
  UNION ALL SELECT 'outside domain', count(DISTINCT o_orderstatus), count(*) FROM orders WHERE o_orderstatus NOT IN ('F', 'O')""")
def union_domain_check(spark, sf):
    shop = from_star(spark, sf)
    names = shop.products.select(F.col("product_name").alias("name")).unionByName(
        read_parquet(spark, sf, "supplier").select(F.col("s_name").alias("name"))
    )
    stacked = names.groupBy("name").agg(F.count("*").alias("n")).agg(
        F.lit("parts").alias("source"), F.count("name").alias("names"), F.coalesce(F.sum("n"), F.lit(0)).alias("rows")
    )
    outside = clean.outside_domain(shop.orders, "status", ["F", "O"]).agg(
        F.lit("outside domain").alias("source"), F.count("status").alias("names"),
        F.coalesce(F.sum("n"), F.lit(0)).alias("rows"),
    )
    return stacked.unionByName(outside)


@query("""WITH e AS (SELECT CASE event_type WHEN 'view' THEN 'look' WHEN 'click' THEN 'look' WHEN 'purchase' THEN 'buy'
    ELSE 'other' END AS label, CASE WHEN value >= 100 THEN 'high' WHEN value >= 20 THEN 'mid' ELSE 'low' END AS band,
    CASE WHEN value > 0 AND value <= 10 THEN '0-10' WHEN value > 10 AND value <= 100 THEN '10-100' END AS bin,
    CASE WHEN event_type = 'error' THEN NULL ELSE value END AS kept FROM events)
SELECT label, band, bin, count(*) AS n, count(kept) AS kept FROM e GROUP BY 1, 2, 3""")
def recode_bands(spark, sf):
    ev = events(spark, sf)
    label = recode("kind", {"view": "look", "click": "look", "purchase": "buy"}, "other")
    return (
        ev.withColumn("kept", F.when(F.col("kind") != "error", F.col("value")))
        .groupBy(
            label.alias("label"),
            bands_below("value", (20, 100), ("low", "mid", "high")).alias("band"),
            bands_upto("value", (0, 10, 100), ("0-10", "10-100")).alias("bin"),
        )
        .agg(F.count("*").alias("n"), F.count("kept").alias("kept"))
    )


@query("""SELECT count(*) AS documents, CAST(sum(length(text)) AS BIGINT) AS characters,
  CAST(sum(length(trim(text, ' ' || chr(9) || chr(10) || chr(13) || chr(12288)))) AS BIGINT) AS trimmed_characters,
  count(*) FILTER (text <> replace(text, chr(10), ' ')) AS with_line_breaks,
  CAST(sum(length(replace(text, chr(10), ' '))) AS BIGINT) AS replaced_characters,
  CAST(sum(length(lang || ' ' || source)) AS BIGINT) AS joined_characters FROM documents""")
def string_ops(spark, sf):
    d = read_parquet(spark, sf, "documents")
    flat = F.replace(F.col("text"), F.lit("\n"), F.lit(" "))
    return d.agg(
        F.count("*").alias("documents"),
        F.sum(F.length("text")).alias("characters"),
        F.sum(F.length(trim_all("text"))).alias("trimmed_characters"),
        F.count_if(F.col("text") != flat).alias("with_line_breaks"),
        F.sum(F.length(flat)).alias("replaced_characters"),
        F.sum(F.length(F.concat("lang", F.lit(" "), "source"))).alias("joined_characters"),
    )


@query("""WITH o AS (SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' THEN strftime(o_orderdate, '%Y/%m/%d')
    WHEN o_orderstatus = 'O' THEN strftime(o_orderdate, '%Y-%m-%d') ELSE 'unknown' END AS written FROM orders),
  d AS (SELECT coalesce(try_strptime(written, '%Y-%m-%d'), try_strptime(written, '%Y/%m/%d')) AS d FROM o)
SELECT strftime(d, '%Y-%m') AS ym, strftime(date_trunc('month', d), '%Y-%m-%d') AS month_start, CAST(year(d) AS BIGINT) AS year,
  CAST(month(d) AS BIGINT) AS month, CAST(isodow(d) - 1 AS BIGINT) AS weekday, count(*) AS orders,
  CAST(min(day(d)) AS BIGINT) AS first_day FROM d GROUP BY 1, 2, 3, 4, 5""")
def date_parts(spark, sf):
    o = from_star(spark, sf).orders
    written = (
        F.when(F.col("status") == "F", F.date_format("order_date", "yyyy/MM/dd"))
        .when(F.col("status") == "O", F.date_format("order_date", "yyyy-MM-dd"))
        .otherwise("unknown")
    )
    d = o.select(parse_date(written).alias("d"))
    return tidy(
        d.groupBy(
            year_month("d").alias("ym"),
            day_text(F.trunc("d", "month")).alias("month_start"),
            F.year("d").alias("year"),
            F.month("d").alias("month"),
            F.weekday("d").alias("weekday"),
        ).agg(F.count("*").alias("orders"), F.min(F.dayofmonth("d")).alias("first_day"))
    )


@query("""SELECT count(*) AS rows_before, count(*) FILTER (l_discount <> 0 AND l_tax <> 0) AS rows_after,
  count(*) - count(*) FILTER (l_discount <> 0 AND l_tax <> 0) AS rows_dropped FROM lineitem""")
def drop_nulls(spark, sf):
    l = read_parquet(spark, sf, "lineitem").select(
        F.nullif("l_discount", F.lit(0.0)).alias("discount"), F.nullif("l_tax", F.lit(0.0)).alias("tax")
    )
    return clean.drop_null_report(l, ["discount", "tax"])


@query("""WITH c AS (SELECT CASE WHEN c_acctbal >= 0 AND c_acctbal <= 9000 THEN c_acctbal END AS b FROM customer)
SELECT count(*) AS customers, count(b) AS in_range, round(sum(CAST(coalesce(b, (SELECT median(b) FROM c)) AS DECIMAL(18,4)))::DOUBLE / count(*), 4) AS filled_mean,
  count(*) FILTER (CAST(trunc(b) AS BIGINT) % 2 = 1) AS odd, CAST(sum(coalesce(b, 0)) AS DECIMAL(18,2))::DOUBLE AS with_zero FROM c""")
def null_ops(spark, sf):
    from ..functions.columns import null_outside

    c = from_star(spark, sf).customers.select(null_outside("balance", 0, 9000).alias("b"))
    filled = clean.fill_median(c.withColumn("raw", F.col("b")), "b")
    return tidy(
        filled.agg(
            F.count("*").alias("customers"),
            F.count("raw").alias("in_range"),
            (F.sum(F.col("b").cast("decimal(18,4)")).cast("double") / F.count("*")).alias("filled_mean"),
            F.count_if(F.col("raw").cast("bigint") % 2 == 1).alias("odd"),
            F.sum(F.coalesce(F.col("raw"), F.lit(0.0))).cast("decimal(18,2)").alias("with_zero"),
        ),
        4,
    )


@query("""WITH q AS (SELECT quantile_cont(l_extendedprice, 0.99) AS cap FROM lineitem)
SELECT l_returnflag AS return_flag, count(*) AS n,
  CAST(sum(CAST(least(l_extendedprice, cap) AS DECIMAL(18,4))) AS DOUBLE) AS clipped_sum,
  round(sum(sqrt(abs(l_quantity - 25))), 3) AS root_sum,
  round(sum(round(l_extendedprice / l_quantity)), 2) AS rounded_sum FROM lineitem, q GROUP BY 1""")
def numeric_ops(spark, sf):
    from ..operators.ordered import quantiles

    items = from_star(spark, sf).order_items.withColumn("x", F.col("amount").cast("double"))
    cap = quantiles(items, "x", {"cap": 0.99}).select("cap").scalar()
    wide = items.withColumns(
        {
            "clipped": F.least("x", cap).cast("decimal(18,4)"),
            "root": F.sqrt(F.abs(F.col("quantity") - 25)),
            "rounded": F.round(F.col("x") / F.col("quantity")),
        }
    )
    return tidy(
        wide.groupBy("return_flag").agg(
            F.count("*").alias("n"),
            F.sum("clipped").alias("clipped_sum"),
            F.sum("root").alias("root_sum"),
            F.sum("rounded").alias("rounded_sum"),
        ),
        root_sum=3,
        rounded_sum=2,
    )


@query("""WITH e AS (SELECT event_type AS label, count(*) AS n FROM events GROUP BY 1)
SELECT label, n, round(CAST(n AS DOUBLE) / sum(n) OVER (), 6) AS share FROM e""")
def comment_tally(spark, sf):
    return tidy(tally(events(spark, sf), F.lower(trim_all("kind"))))


@query("""SELECT l_returnflag AS return_flag, o_orderpriority AS payment_method, count(*) AS n,
  CAST(sum(CAST(l_extendedprice AS DECIMAL(15,2))) AS DOUBLE) AS revenue
FROM lineitem JOIN orders ON o_orderkey = l_orderkey
WHERE o_orderstatus = 'F' AND o_orderdate >= DATE '1999-01-01' GROUP BY ALL""")
def sql_text(spark, sf):
    """SQL over named tables."""
    text = """
        SELECT l.l_returnflag AS return_flag, o.o_orderpriority AS payment_method, count(*) AS n,
               CAST(sum(CAST(l.l_extendedprice AS DECIMAL(15,2))) AS DOUBLE) AS revenue
        FROM {lineitem} l JOIN {orders} o ON o.o_orderkey = l.l_orderkey
        WHERE o.o_orderstatus = 'F' AND o.o_orderdate >= DATE '1999-01-01'
        GROUP BY ALL"""
    return run_sql(spark, text, {t: read_parquet(spark, sf, t) for t in ("lineitem", "orders")})


@query("""WITH o AS (SELECT o_orderkey AS order_id, o_custkey AS customer_id, o_orderdate FROM orders)
SELECT 'first' AS part, order_id, customer_id FROM o QUALIFY row_number() OVER (ORDER BY o_orderdate, order_id) <= 5
UNION ALL SELECT 'last', order_id, customer_id FROM o QUALIFY row_number() OVER (ORDER BY o_orderdate DESC, order_id DESC) <= 5
UNION ALL SELECT 'latest of ' || p, order_id, customer_id FROM (SELECT o_orderpriority AS p, o_orderkey AS order_id,
  o_custkey AS customer_id FROM orders WHERE o_orderstatus = 'F'
  QUALIFY row_number() OVER (PARTITION BY o_orderpriority ORDER BY o_orderdate DESC, o_orderkey DESC) = 1)
UNION ALL SELECT 'distinct ' || o_orderpriority, NULL, NULL FROM orders GROUP BY o_orderpriority
UNION ALL SELECT 'from ' || strftime(min(o_orderdate), '%Y-%m-%d') || ' to ' || strftime(max(o_orderdate), '%Y-%m-%d'), NULL, NULL FROM o""")
def head_tail_distinct(spark, sf):
    o = from_star(spark, sf).orders
    ids = ["order_id", "customer_id"]
    first = profile.head_rows(o, 5, "order_date", "order_id").select(F.lit("first").alias("part"), *ids)
    last = profile.tail_rows(o, 5, ["order_date", "order_id"]).select(F.lit("last").alias("part"), *ids)
    # rows by condition, columns by name, last row of each label
    latest = F.max_by(F.struct(*ids), F.struct("order_date", "order_id")).alias("r")
    label = (
        o.where(F.col("status") == "F")
        .groupBy("payment_method")
        .agg(latest)
        .select(F.concat(F.lit("latest of "), "payment_method").alias("part"), "r.*")
    )
    none = [F.lit(None).cast("bigint").alias(c) for c in ids]
    kinds = o.select("payment_method").distinct().select(F.concat(F.lit("distinct "), "payment_method").alias("part"), *none)
    dates = profile.span(o, "order_date").select(
        F.concat(F.lit("from "), day_text("first"), F.lit(" to "), day_text("last")).alias("part"), *none
    )
    out = first
    for more in (last, label, kinds, dates):
        out = out.unionByName(more)
    return out


@query("""SELECT n_name AS prefecture, count(*) AS customers FROM customer JOIN nation ON n_nationkey = c_nationkey
GROUP BY 1 QUALIFY row_number() OVER (ORDER BY count(*) DESC, n_name) <= 5""")
def customers_by_prefecture(spark, sf):
    """The five areas with most customers, counted before the join."""
    counts = from_star(spark, sf).customers.groupBy("area_id").agg(F.count("*").alias("customers"))
    named = counts.join(areas(spark, sf), "area_id").select("prefecture", "customers")
    return named.orderBy(F.desc("customers"), "prefecture").limit(5)


@query("""SELECT CASE WHEN c_acctbal < 0 THEN 'below 0' WHEN c_acctbal < 2500 THEN '0-2499' WHEN c_acctbal < 5000 THEN '2500-4999'
    WHEN c_acctbal < 7500 THEN '5000-7499' ELSE '7500 and over' END AS band, c_mktsegment AS acquisition_channel, count(*) AS customers,
  round(count(*)::DOUBLE / sum(count(*)) OVER (PARTITION BY c_mktsegment), 6) AS share FROM customer GROUP BY 1, 2""")
def customer_bands(spark, sf):
    """Customers per band and channel, with each channel's mix."""
    band = bands_below(
        "balance", (0, 2500, 5000, 7500), ("below 0", "0-2499", "2500-4999", "5000-7499", "7500 and over")
    )
    counts = (
        from_star(spark, sf)
        .customers.groupBy(band.alias("band"), "acquisition_channel")
        .agg(F.count("*").alias("customers"))
    )
    return tidy(tables.share_within(counts, ["acquisition_channel"], "customers"))


@query("""WITH w(payment_method, days) AS (VALUES ('1-URGENT', 1), ('2-HIGH', 2), ('3-MEDIUM', 5), ('4-NOT SPECIFIED', NULL), ('6-NEVER', 90))
SELECT w.payment_method, days, count(o_orderkey) AS orders, CAST(count(o_orderkey) * days AS BIGINT) AS order_days
FROM w LEFT JOIN orders ON o_orderpriority = w.payment_method GROUP BY 1, 2""")
def literal_targets(spark, sf):
    """A small frame of literals beside the orders of a table."""
    targets = inline(
        spark,
        [("1-URGENT", 1), ("2-HIGH", 2), ("3-MEDIUM", 5), ("4-NOT SPECIFIED", None), ("6-NEVER", 90)],
        "payment_method string, days bigint",
    )
    counts = from_star(spark, sf).orders.groupBy("payment_method").agg(F.count("*").alias("k"))
    orders = F.coalesce("k", F.lit(0)).alias("orders")
    joined = targets.join(counts, "payment_method", "left").select("payment_method", "days", orders)
    return joined.withColumn("order_days", F.col("orders") * F.col("days"))


@query(f"""WITH {LINES}, c AS (SELECT p.p_type AS category, sum(amount) AS revenue, count(*) AS lines FROM lines JOIN part p ON p.p_partkey = product_id GROUP BY 1)
SELECT category, format('{{:,}}', CAST(floor(revenue) AS BIGINT)) AS revenue, format('{{:,}}', lines) AS lines FROM c""")
def revenue_for_display(spark, sf):
    """Whole amounts with thousands separators, formatted once per category after the sums."""
    by = sales.by_product(from_star(spark, sf), "category")
    return by.select("category", thousands(F.floor("revenue")).alias("revenue"), thousands("lines").alias("lines"))
