"""Monthly sales and customer segments."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from feira.functions import dates, values
from feira.operators.aggregates import TOTAL, total
from feira.operators.joins import ORDER_KEYS, sales_facts
from feira.schemas import SALE_STATUSES


def sales_by_category_month(
    orders: DataFrame, items: DataFrame, products: DataFrame, categories: DataFrame, category_key: str = "category_id",
) -> DataFrame:
    """Orders, items, revenue, sellers and buyers per category and month of sold orders.

    The lines are read and joined once and meet only the id of their category; its names join the finished
    groups. A line counts for its order and for its seller: these two rows collapse, first to one per order or
    seller, then to one per buyer or seller, so that the distinct counts of a group are plain counts of rows.
    """
    month = dates.month_start(F.col("order_purchase_timestamp")).alias("sales_month")
    keys = [k for k in ORDER_KEYS if k in items.columns]
    sold = orders.where(F.col("order_status").isin(SALE_STATUSES)).select(*keys, "customer_unique_id", month)
    columns = [*keys, "product_id", "seller_id", "price", "freight_value"]
    ids = categories.select(*{category_key, "category_id"})
    facts = sales_facts(sold, items.select(*columns), products, ids, category_key)
    group, price, freight = ["category_id", "sales_month"], F.col("price"), F.col("freight_value")
    sums = ["n_items", "revenue", "freight", "both", "n_prices"]

    order = F.struct(F.lit(True).alias("buys"), F.col("customer_unique_id").alias("who"), F.col("order_id").alias("bought"))
    offer = F.struct(F.lit(False).alias("buys"), F.col("seller_id").alias("who"), F.lit(None).cast("string").alias("bought"))
    lines = facts.select(*group, "price", "freight_value", F.explode(F.array(order, offer)).alias("party")).select(
        *group, "party.*", "price", "freight_value")
    per_order = lines.groupBy(*group, "buys", "who", "bought").agg(
        F.count("*").alias("n_items"), F.sum(price).alias("revenue"), F.sum(freight).alias("freight"),
        F.sum(price + freight).alias("both"), F.count(price).alias("n_prices"))
    per_party = per_order.groupBy(*group, "buys", "who").agg(F.count("*").alias("n_orders"), *[F.sum(c).alias(c) for c in sums])
    own = {c: F.sum(F.when(F.col("buys"), F.col(c))) for c in ("n_orders", *sums)}
    counted = per_party.groupBy(*group).agg(
        own["n_orders"].alias("n_orders"), own["n_items"].alias("n_items"), own["revenue"].cast(TOTAL).alias("gross_revenue"),
        own["freight"].cast(TOTAL).alias("total_freight"), own["both"].cast(TOTAL).alias("total_with_freight"), own["n_prices"].alias("n_prices"),
        F.count(F.when(~F.col("buys"), F.col("who"))).alias("n_sellers"), F.count(F.when(F.col("buys"), F.col("who"))).alias("n_unique_customers"))
    names = categories.select("category_id", "category_name", "category_name_english")
    return counted.join(names, "category_id").select(
        "category_id", "category_name", "category_name_english", "sales_month", "n_orders", "n_items",
        "gross_revenue", "total_freight", "total_with_freight",
        values.mean_money(F.col("gross_revenue"), F.col("n_prices")).alias("avg_item_price"),
        "n_sellers", "n_unique_customers")


def top_categories(sales: DataFrame, as_of: Column, months: int = 12, k: int = 5) -> DataFrame:
    """Categories with most revenue in the last months."""
    start = dates.shift(F.date_trunc("month", as_of).cast("timestamp_ntz"), -months, "month").cast("date")
    recent = sales.where(F.col("sales_month") >= start)
    return (recent.groupBy("category_name_english")
            .agg(F.sum("gross_revenue").cast("decimal(14,2)").alias("revenue_12m"),
                 F.sum("n_orders").alias("orders_12m"))
            .orderBy(F.desc_nulls_first("revenue_12m"), F.asc("category_name_english")).limit(k))


def customer_orders(orders: DataFrame) -> DataFrame:
    """Delivered orders per customer: count, first, last and mean delivery days."""
    delivered = orders.where(F.col("order_status") == "delivered")
    bought, received = F.col("order_purchase_timestamp"), F.col("order_delivered_customer_date")
    return delivered.groupBy("customer_unique_id").agg(
        F.count_distinct("order_id").alias("n_orders"), F.min(bought).alias("first_order_at"),
        F.max(bought).alias("last_order_at"), dates.mean_days(bought, received).alias("avg_delivery_days"))


def revenue_by_month(orders: DataFrame, items: DataFrame) -> DataFrame:
    """Sums per customer and purchase month of delivered orders, which :func:`merge_revenue` adds up over months."""
    totals = _order_totals(items)
    keys = [k for k in ORDER_KEYS if k in totals.columns]
    month = dates.month_start(F.col("order_purchase_timestamp")).alias("sales_month")
    delivered = orders.where(F.col("order_status") == "delivered").select(*keys, "customer_unique_id", month)
    return delivered.join(totals, keys).groupBy("customer_unique_id", "sales_month").agg(
        F.sum("value").alias("value"), F.sum("gmv").alias("gmv"), F.sum("n_items").alias("n_items"))


def merge_revenue(parts: DataFrame) -> DataFrame:
    """What :func:`customer_revenue` gives for all months together."""
    return parts.groupBy("customer_unique_id").agg(
        total(F.col("value")).alias("lifetime_value"), total(F.col("gmv")).alias("lifetime_gmv"), F.sum("n_items").alias("lifetime_items"))


def _order_totals(items: DataFrame) -> DataFrame:
    keys = [k for k in ORDER_KEYS if k in items.columns]
    return items.groupBy(*keys).agg(
        F.sum(F.col("price") + F.col("freight_value")).alias("value"), F.sum("price").alias("gmv"),
        F.count("*").alias("n_items"))


def customer_revenue(orders: DataFrame, items: DataFrame) -> DataFrame:
    """Lifetime value, merchandise value and items of delivered orders per customer."""
    totals = _order_totals(items)
    keys = [k for k in ORDER_KEYS if k in totals.columns]
    delivered = orders.where(F.col("order_status") == "delivered").select(*keys, "customer_unique_id")
    return delivered.join(totals, keys).groupBy("customer_unique_id").agg(
        total(F.col("value")).alias("lifetime_value"), total(F.col("gmv")).alias("lifetime_gmv"),
        F.sum("n_items").alias("lifetime_items"))


def customer_segments(
    orders: DataFrame, items: DataFrame, customers: DataFrame, as_of: Column,
    vip_orders: int = 5, vip_value: float = 1000, repeat_orders: int = 2, idle_days: int = 365,
) -> DataFrame:
    """Customers with delivered items, their totals and segment.

    One pass over the delivered orders: item totals per order are left-joined, rows collapse per
    order while still partitioned by order, and one further shuffle groups them by customer.
    """
    totals = _order_totals(items)
    keys = [k for k in ORDER_KEYS if k in totals.columns]
    bought, received = F.col("order_purchase_timestamp"), F.col("order_delivered_customer_date")
    span = F.timestamp_diff("SECOND", bought, received)
    per_order = (
        orders.where(F.col("order_status") == "delivered").join(totals, keys, "left")
        .groupBy("order_id", "customer_unique_id").agg(
            F.min(bought).alias("first_at"), F.max(bought).alias("last_at"),
            F.sum(span).alias("seconds"), F.count(span).alias("n_spans"),
            F.sum("value").alias("value"), F.sum("gmv").alias("gmv"), F.sum("n_items").alias("n_items")))
    per_customer = per_order.groupBy("customer_unique_id").agg(
        F.count("*").alias("n_orders"), F.min("first_at").alias("first_order_at"),
        F.max("last_at").alias("last_order_at"),
        dates.mean_days_of(F.sum("seconds"), F.sum("n_spans")).alias("avg_delivery_days"),
        total(F.col("value")).alias("lifetime_value"), total(F.col("gmv")).alias("lifetime_gmv"),
        F.sum("n_items").alias("lifetime_items"))
    idle = dates.whole_days(F.col("last_order_at"), as_of)
    segment = (
        F.when((F.col("n_orders") >= vip_orders) & (F.col("lifetime_value") > vip_value), "VIP")
        .when(F.col("n_orders") >= repeat_orders, "Recurrente")
        .when(idle > idle_days, "Inactivo").otherwise("Nuevo"))
    with_items = per_customer.where(F.col("lifetime_items").isNotNull())
    return with_items.join(customers.select("customer_unique_id", "customer_state"), "customer_unique_id").select(
        "customer_unique_id", "customer_state", "n_orders", "first_order_at", "last_order_at",
        idle.alias("days_since_last_order"), "avg_delivery_days", "lifetime_value", "lifetime_gmv",
        "lifetime_items", segment.alias("segment"))


def vip_by_state(segments: DataFrame) -> DataFrame:
    return (segments.where(F.col("segment") == "VIP").groupBy("customer_state")
            .agg(F.count("*").alias("n_vip"), F.sum("lifetime_value").cast("decimal(14,2)").alias("total_ltv")))


def segment_sizes(segments: DataFrame) -> DataFrame:
    return segments.groupBy("segment").agg(F.count("*").alias("n_customers"))
