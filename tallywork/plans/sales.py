"""Sales metrics on the shop model.

Revenue is always the sum of line amounts of completed orders. What needs no column of another table
is summed per order before anything is joined. Where lines are joined to their orders as raw rows, the
sums after the join have a partial step of their own, so adaptive execution can split a crowded order.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import replace

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.columns import bands_below, ratio, year_month
from ..operators.ordered import quantiles, running, top_share, with_ranges
from ..operators.series import change, running_total
from ..operators.tables import share_of_all, share_within, top_per_group
from ..sources.shop import Shop, cents_to_money

# Price bands.
PRICE_EDGES = (2000, 5000)
PRICE_BANDS = ("low", "mid", "high")


def sales_lines(shop: Shop, *order_columns: str) -> DataFrame:
    """Completed lines: the line columns plus the named order columns."""
    orders = shop.completed_orders().select("order_id", *order_columns)
    return shop.order_items.join(orders, "order_id")


def order_amounts(shop: Shop) -> DataFrame:
    """One row per completed order with lines: ``order_id, customer_id, order_date, amount, lines``."""
    sums = shop.order_items.groupBy("order_id").agg(
        F.sum("cents").alias("_cents"), F.count("*").alias("lines")
    )
    orders = shop.completed_orders().select("order_id", "customer_id", "order_date")
    return orders.join(sums, "order_id").select(
        *orders.columns, cents_to_money(F.col("_cents")).alias("amount"), "lines"
    )


def customer_totals(shop: Shop) -> DataFrame:
    """One row per buyer: ``customer_id, total_spend, n_orders, avg_order``."""
    return (
        order_amounts(shop)
        .groupBy("customer_id")
        .agg(F.sum("amount").alias("total_spend"), F.count("*").alias("n_orders"))
        .withColumn("avg_order", ratio("total_spend", "n_orders"))
    )


def product_totals(shop: Shop, period: Column | None = None) -> DataFrame:
    """One row per sold product (and period): ``product_id, revenue, lines``."""
    by = [] if period is None else [period.alias("period")]
    lines = sales_lines(shop, *([] if period is None else ["order_date"]))
    return (
        lines.groupBy("product_id", *by)
        .agg(F.sum("cents").alias("_cents"), F.count("*").alias("lines"))
        .withColumn("revenue", cents_to_money(F.col("_cents")))
        .drop("_cents")
    )


def wide_lines(shop: Shop) -> DataFrame:
    """Completed lines with their order, product and customer columns."""
    orders = shop.orders.select("order_id", "customer_id", "order_date", "status")
    # customers meet orders first, so that lines are not shuffled once more for them
    told = orders.join(shop.customers, "customer_id", "left")
    return (
        shop.order_items.join(told, "order_id", "left")
        .join(shop.products, "product_id", "left")
        .where(F.col("status") == shop.done)
    )


def by_product(shop: Shop, attribute: str) -> DataFrame:
    """Revenue and line count per product attribute, largest first."""
    return (
        product_totals(shop)
        .join(shop.products.select("product_id", attribute), "product_id")
        .where(F.col(attribute).isNotNull())
        .groupBy(attribute)
        .agg(F.sum("revenue").alias("revenue"), F.sum("lines").alias("lines"))
        .orderBy(F.desc("revenue"), attribute)
    )


def by_customer(shop: Shop, attribute: str) -> DataFrame:
    """Revenue, orders, buyers and order value per customer attribute, largest first."""
    return (
        customer_totals(shop)
        .join(shop.customers.select("customer_id", attribute), "customer_id")
        .where(F.col(attribute).isNotNull())
        .groupBy(attribute)
        .agg(
            F.sum("total_spend").alias("revenue"),
            F.sum("n_orders").alias("orders"),
            F.count("*").alias("buyers"),
        )
        .withColumn("aov", ratio("revenue", "orders"))
        .orderBy(F.desc("revenue"), attribute)
    )


def kpis(shop: Shop) -> DataFrame:
    """Revenue, orders, buyers, order value, frequency, repeat share and gross margin in one row."""
    # both halves start from one frame, so lines and orders are read and shuffled once
    sums = shop.order_items.groupBy("order_id", "product_id").agg(
        F.sum("cents").alias("cents"), F.sum("quantity").alias("units")
    )
    base = sums.join(shop.completed_orders().select("order_id", "customer_id"), "order_id")
    buyers = (
        base.groupBy("order_id", "customer_id")
        .agg(F.sum("cents").alias("cents"))
        .groupBy("customer_id")
        .agg(cents_to_money(F.sum("cents")).alias("total_spend"), F.count("*").alias("n_orders"))
    )
    head = buyers.agg(
        F.sum("total_spend").alias("gmv"),
        F.sum("n_orders").alias("orders"),
        F.count("*").alias("buyers"),
        F.count_if(F.col("n_orders") >= 2).alias("repeat_buyers"),
    )
    sold = base.groupBy("product_id").agg(F.sum("units").alias("units"))
    costs = sold.join(shop.products.select("product_id", "price", "cost"), "product_id").agg(
        F.sum(F.col("units") * F.col("price").cast("double")).alias("at_price"),
        F.sum(F.col("units") * F.col("cost").cast("double")).alias("at_cost"),
    )
    margin = costs.select(1 - ratio("at_cost", "at_price")).scalar()
    return head.select(
        "gmv",
        "orders",
        "buyers",
        ratio("gmv", "orders").alias("aov"),
        ratio("orders", "buyers").alias("frequency"),
        ratio("repeat_buyers", "buyers").alias("repeat_rate"),
        margin.alias("margin_rate"),
    )


def monthly(shop: Shop) -> DataFrame:
    """Revenue per month: ``ym, revenue, orders``."""
    return (
        order_amounts(shop)
        .groupBy(year_month("order_date").alias("ym"))
        .agg(F.sum("amount").alias("revenue"), F.count("*").alias("orders"))
    )


def monthly_running(shop: Shop) -> DataFrame:
    """Monthly revenue with its running total and whether the month is the peak."""
    months = monthly(shop)
    peak = months.agg(F.max_by("ym", F.struct("revenue", "ym"))).scalar()
    return (
        running_total(months, [], "ym", "revenue", "running_revenue")
        .withColumn("is_peak", (F.col("ym") == peak).cast("int"))
        .orderBy("ym")
    )


def yearly(shop: Shop) -> DataFrame:
    """Revenue split into buyers, orders per buyer and order value, per year."""
    by_buyer = (
        order_amounts(shop)
        .groupBy(F.year("order_date").cast("bigint").alias("year"), "customer_id")
        .agg(F.sum("amount").alias("revenue"), F.count("*").alias("orders"))
    )
    return (
        by_buyer.groupBy("year")
        .agg(
            F.sum("revenue").alias("revenue"),
            F.sum("orders").alias("orders"),
            F.count("*").alias("buyers"),
        )
        .withColumns({"aov": ratio("revenue", "orders"), "frequency": ratio("orders", "buyers")})
        .orderBy("year")
    )


def growth(shop: Shop) -> DataFrame:
    """Month-over-month and year-over-year change: ``level, period, revenue, change_rate``."""
    months = monthly(shop)
    mom = change(months, [], "ym", "revenue", "change_rate").select(
        F.lit("month").alias("level"), F.col("ym").alias("period"), "revenue", "change_rate"
    )
    years = months.groupBy(F.substring("ym", 1, 4).alias("period")).agg(F.sum("revenue").alias("revenue"))
    yoy = change(years, [], "period", "revenue", "change_rate").select(
        F.lit("year").alias("level"), "period", "revenue", "change_rate"
    )
    return mom.unionByName(yoy)


def seasonality(shop: Shop) -> DataFrame:
    """Mean line amount per calendar month over all years."""
    return (
        order_amounts(shop)
        .groupBy(F.month("order_date").cast("bigint").alias("month"))
        .agg(F.sum("amount").alias("_sum"), F.sum("lines").alias("lines"))
        .select("month", ratio("_sum", "lines").alias("mean_line"), "lines")
        .orderBy("month")
    )


def top_customers(shop: Shop, n: int = 10, attributes: Sequence[str] = ("name",)) -> DataFrame:
    """The highest spenders with their attributes, joined only after the cut."""
    best = customer_totals(shop).orderBy(F.desc("total_spend"), "customer_id").limit(n)
    return best.join(
        shop.customers.select("customer_id", *attributes), "customer_id", "left"
    ).orderBy(F.desc("total_spend"), "customer_id")


def top_products(shop: Shop, n: int = 1) -> DataFrame:
    """Best-selling products of each category."""
    named = product_totals(shop).join(
        shop.products.select("product_id", "product_name", "category"), "product_id"
    )
    return top_per_group(
        named, ["category"], [F.desc("revenue"), F.col("product_id").asc()], n
    ).orderBy("category", "rank")


def aov_by(shop: Shop, attribute: str) -> DataFrame:
    """Orders, mean and exact median order amount per customer attribute."""
    joined = order_amounts(shop).join(
        shop.customers.select("customer_id", attribute), "customer_id"
    )
    means = joined.where(F.col(attribute).isNotNull()).groupBy(attribute).agg(
        F.count("*").alias("orders"), F.sum("amount").alias("revenue")
    )
    medians = quantiles(joined, "amount", {"median_order": 0.5}, [attribute]).drop("n")
    return (
        means.withColumn("mean_order", ratio("revenue", "orders"))
        .join(medians, attribute)
        .select(attribute, "orders", "mean_order", "median_order")
        .orderBy(F.desc("mean_order"), attribute)
    )


def pareto(shop: Shop, fractions: Sequence[float] = (0.1, 0.2)) -> DataFrame:
    """Share of revenue from the top buyers."""
    heads = top_share(customer_totals(shop), "total_spend", fractions)
    return heads.withColumn("revenue_share", ratio("head_sum", "total_sum"))


def new_vs_repeat(shop: Shop) -> DataFrame:
    """Revenue of first orders and of later orders per year.

    A buyer's first order is an aggregate (the smallest date and order id), so no buyer's orders
    are ever sorted in one task; repeat revenue is what remains of the year.
    """
    first = (
        order_amounts(shop)
        .groupBy("customer_id")
        .agg(F.min_by(F.struct("order_date", "amount"), F.struct("order_date", "order_id")).alias("f"))
        .groupBy(F.year("f.order_date").cast("bigint").alias("year"))
        .agg(F.sum("f.amount").alias("new"))
    )
    whole = yearly(shop).select("year", "revenue")
    split = whole.join(first, "year", "left").withColumn(
        "new", F.coalesce("new", F.lit(0).cast("decimal(15,2)"))
    )
    long = split.select(
        "year", "new", (F.col("revenue") - F.col("new")).alias("repeat")
    ).unpivot(["year"], ["new", "repeat"], "buyer_type", "revenue")
    return share_within(long, ["year"], "revenue").orderBy("year", "buyer_type")


def order_ordinals(shop: Shop) -> DataFrame:
    """Each completed order with how many the buyer placed before it and the spend so far."""
    order = ["order_date", "order_id"]
    ranged = with_ranges(order_amounts(shop), order, like=shop.completed_orders())
    numbered = running(ranged, ["customer_id"], order, "bucket", {"spend_so_far": "amount"})
    return numbered.select(
        "order_id", "customer_id", "order_date", "amount", (F.col("position") - 1).alias("nth"), "spend_so_far"
    )


def spend_by_loyalty(shop: Shop) -> DataFrame:
    """Average total spend of one-time and of repeat buyers."""
    kind = F.when(F.col("n_orders") >= 2, "repeat").otherwise("one-time")
    return (
        customer_totals(shop)
        .groupBy(kind.alias("buyer_type"))
        .agg(F.count("*").alias("buyers"), F.sum("total_spend").alias("_s"))
        .select("buyer_type", "buyers", ratio("_s", "buyers").alias("mean_spend"))
    )


def order_count_distribution(shop: Shop) -> DataFrame:
    return customer_totals(shop).groupBy("n_orders").agg(F.count("*").alias("buyers")).orderBy("n_orders")


def category_share(shop: Shop) -> DataFrame:
    """Revenue, line count and share per category."""
    return share_of_all(by_product(shop, "category"), "revenue", "revenue_share")


def category_growth(shop: Shop, before: int, after: int) -> DataFrame:
    """Category revenue in two years, the growth between them and the later year's share."""
    in_year = lambda y: F.sum(F.when(F.col("period") == y, F.col("revenue")).otherwise(F.lit(0).cast("decimal(15,2)")))
    within = F.col("order_date").between(F.make_date(F.lit(before), F.lit(1), F.lit(1)), F.make_date(F.lit(before), F.lit(12), F.lit(31)))
    within |= F.col("order_date").between(F.make_date(F.lit(after), F.lit(1), F.lit(1)), F.make_date(F.lit(after), F.lit(12), F.lit(31)))
    shop = replace(shop, orders=shop.orders.where(within))
    cells = (
        product_totals(shop, F.year("order_date"))
        .join(shop.products.select("product_id", "category"), "product_id")
        .where(F.col("category").isNotNull())
        .groupBy("category")
        .agg(in_year(before).alias("before"), in_year(after).alias("after"))
    )
    return share_of_all(
        cells.withColumn("growth", ratio("after", "before")), "after", "after_share"
    ).orderBy(F.desc("after_share"), "category")


def price_bands(shop: Shop, edges: Sequence[float] = PRICE_EDGES, labels: Sequence[str] = PRICE_BANDS) -> DataFrame:
    """Products per price band with mean profit and margin."""
    profit = F.col("price") - F.col("cost")
    return (
        shop.products.withColumn("band", bands_below("price", edges, labels))
        .groupBy("band")
        .agg(
            F.count("*").alias("products"),
            F.sum(profit).alias("_p"),
            F.sum("price").alias("_r"),
        )
        .select(
            "band",
            "products",
            ratio("_p", "products").alias("mean_profit"),
            ratio("_p", "_r").alias("margin"),
        )
    )


def unsold_products(shop: Shop, sold: DataFrame) -> DataFrame:
    """Every product with its revenue in ``sold`` (product_id, amount) and whether it sold at all.

    A product that was given away has sold, with a revenue of zero.
    """
    sums = sold.groupBy("product_id").agg(F.sum("amount").alias("_a"), F.lit(True).alias("_sold"))
    return shop.products.select("product_id", "category").join(sums, "product_id", "left").select(
        "product_id",
        "category",
        F.coalesce("_a", F.lit(0).cast("decimal(15,2)")).alias("revenue"),
        F.coalesce("_sold", F.lit(False)).alias("sold"),
    )


def mean_customer_revenue(shop: Shop) -> DataFrame:
    """Average, over buyers, of what each has spent in total."""
    return customer_totals(shop).agg(
        F.count("*").alias("buyers"), (F.sum("total_spend").cast("double") / F.count("*")).alias("mean_spend")
    )


def buyer_features(shop: Shop, *attributes: str) -> DataFrame:
    """Buyer grain with customer attributes, for correlation and regression."""
    return customer_totals(shop).join(
        shop.customers.select("customer_id", *attributes), "customer_id"
    )

