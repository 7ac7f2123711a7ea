"""Places, distances and deadlines of deliveries."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from feira.functions import dates, geo
from feira.operators.joins import ORDER_KEYS, lookup_geo, order_lines


def enrich_geo(customers: DataFrame, sellers: DataFrame, geolocation: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Customers and sellers with missing points filled from their zip prefix."""
    return (lookup_geo(customers, geolocation, "customer_zip_code_prefix", "customer_geo"),
            lookup_geo(sellers, geolocation, "seller_zip_code_prefix", "seller_geo"))


def shipping_distance(orders: DataFrame, items: DataFrame, customers: DataFrame, sellers: DataFrame) -> DataFrame:
    """Distance between seller and buyer of every item; orders meet their customer before the items."""
    keys = [k for k in ORDER_KEYS if k in items.columns]
    buyers = orders.select(*keys, "customer_unique_id").join(
        customers.select("customer_unique_id", "customer_geo"), "customer_unique_id")
    placed = order_lines(buyers, items).join(sellers.select("seller_id", "seller_geo"), "seller_id")
    return placed.withColumn("distance_km", geo.distance_km(F.col("customer_geo"), F.col("seller_geo")))


def freight_by_distance(routes: DataFrame, step_km: int) -> DataFrame:
    """Items and mean freight per distance band."""
    band = F.floor(F.round("distance_km", 6) / step_km).cast("int") * step_km
    mean = F.sum("freight_value").cast("double") / F.count("*").cast("double")
    return routes.groupBy(band.alias("band_km")).agg(
        F.count("*").alias("n_items"), mean.cast("decimal(12,2)").alias("mean_freight"))


def late_flags(orders: DataFrame, items: DataFrame) -> DataFrame:
    """Per item: handed over after its shipping limit; received after the estimate. NULL while open."""
    lines = order_lines(orders, items)
    return lines.select(
        "order_id", "order_item_id", "seller_id", "order_purchase_timestamp",
        (F.col("order_delivered_carrier_date") > F.col("shipping_limit_date")).alias("late_shipment"),
        (F.col("order_delivered_customer_date") > F.col("order_estimated_delivery_date")).alias("late_delivery"))


def delivery_audit(orders: DataFrame, items: DataFrame) -> DataFrame:
    """Late shipments and deliveries per seller and month, with their share of the known ones."""
    flags = late_flags(orders, items)

    def rate(flag: str):
        known = F.nullif(F.count(flag).cast("double"), F.lit(0.0))
        return F.round(F.count_if(F.col(flag)).cast("double") / known, 4)

    return flags.groupBy("seller_id", dates.month_start(F.col("order_purchase_timestamp")).alias("month")).agg(
        F.count("*").alias("n_items"), F.count_if("late_shipment").alias("n_late_shipments"),
        rate("late_shipment").alias("late_shipment_rate"), F.count_if("late_delivery").alias("n_late_deliveries"),
        rate("late_delivery").alias("late_delivery_rate"))


def late_orders(orders: DataFrame) -> DataFrame:
    return orders.where(F.col("order_delivered_customer_date") > F.col("order_estimated_delivery_date"))
