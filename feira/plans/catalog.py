"""The product catalogue for readers: products with everything they need embedded."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from feira.functions import dates
from feira.operators.aggregates import ratings, total
from feira.operators.sets import pick_per_key
from feira.operators.sorting import top_k_per_group
from feira.plans.promotions import with_price


def sold_by_seller(items: DataFrame) -> DataFrame:
    """Items per product and seller."""
    return items.groupBy("product_id", "seller_id").agg(F.count("*").alias("n_items"))


def main_sellers(sold: DataFrame) -> DataFrame:
    """Per product the seller with most items, ties by seller id."""
    ranked = top_k_per_group(sold, ["product_id"], [F.desc("n_items"), F.asc("seller_id")], 1)
    return ranked.select("product_id", "seller_id")


def product_catalog(
    products: DataFrame, categories: DataFrame, sellers: DataFrame, items: DataFrame, promotions: DataFrame,
    reviews: DataFrame, as_of: Column,
) -> DataFrame:
    """One document per product with category, seller, price, promotion and rating."""
    return catalog_documents(
        products, categories, sellers, main_sellers(sold_by_seller(items)), promotions,
        ratings(reviews.where(F.col("review_type") == "product"), "product_id"),
        ratings(reviews.where(F.col("review_type") == "seller"), "seller_id"), as_of)


def catalog_documents(
    products: DataFrame, categories: DataFrame, sellers: DataFrame, mains: DataFrame, promotions: DataFrame,
    by_product: DataFrame, by_seller: DataFrame, as_of: Column,
) -> DataFrame:
    """The catalogue from what is known per key: the main seller of a product, ratings per product and per seller.

    Every side is reduced to one row per product (or is a dimension) before it is joined, so
    no join multiplies rows.
    """
    priced = with_price(products.drop("category_name"), promotions, as_of)
    scores = by_seller.select(
        "seller_id", F.col("rating_avg").alias("seller_rating"), F.col("n_reviews").alias("seller_reviews"))
    shops = sellers.join(scores, "seller_id", "left").select(
        "seller_id", F.struct(
            F.col("seller_id").alias("id"), F.col("seller_city").alias("city"), F.col("seller_state").alias("state"),
            F.col("seller_rating").alias("rating_avg"), F.coalesce("seller_reviews", F.lit(0)).alias("n_reviews"),
            F.col("seller_geo").alias("geo")).alias("seller"))
    kinds = categories.select(
        "category_id", F.struct(
            F.col("category_id").alias("id"), F.col("category_name").alias("name"),
            F.col("category_name_english").alias("name_english")).alias("category"))
    placed = mains.join(shops, "seller_id").drop("seller_id")
    stars = F.create_map(*[x for s in range(1, 6) for x in (F.lit(str(s)), F.coalesce(f"score_{s}", F.lit(0)))])
    rating = F.struct(
        F.col("rating_avg").alias("avg"), F.coalesce("n_reviews", F.lit(0)).alias("count"), stars.alias("distribution"))
    promotion = F.when(F.col("has_active_promotion"), F.struct(
        "promotion_id", F.col("promotion_name").alias("name"), "valid_until"))
    return (
        priced.join(kinds, "category_id").join(placed, "product_id", "left").join(by_product, "product_id", "left")
        .select(
            "product_id", F.col("product_id").alias("sku"), "name", "description", "category", "seller",
            F.col("product_specifications").alias("specifications"), F.col("product_photos").alias("images"),
            F.col("product_tags").alias("tags"), "dimensions", "base_price", "price_current",
            "has_active_promotion", "discount_percentage", promotion.alias("active_promotion"),
            rating.alias("rating"), as_of.alias("source_updated_at"), as_of.alias("synced_at")))


def seller_performance(orders: DataFrame, items: DataFrame, reviews: DataFrame) -> DataFrame:
    """Per seller: items and revenue, mean score, mean delivery time of its orders.

    Items are summed up by seller and order once; this one frame gives the volume and, with the
    instants of the orders, the delivery times.
    """
    scores = ratings(reviews, "seller_id").select("seller_id", "rating_avg", "n_reviews")
    bought, received = F.col("order_purchase_timestamp"), F.col("order_delivered_customer_date")
    sold = items.groupBy("order_id", "seller_id").agg(F.count("*").alias("n_items"), F.sum("price").alias("revenue"))
    known = orders.select("order_id", bought, received, F.lit(1).alias("known"))
    sellers = sold.join(known, "order_id", "left").groupBy("seller_id").agg(
        F.sum("n_items").alias("n_items"), total(F.col("revenue")).alias("revenue"),
        F.nullif(F.count("known"), F.lit(0)).alias("n_orders"), dates.mean_days(bought, received).alias("avg_delivery_days"))
    return sellers.join(scores, "seller_id", "left")


def catalog_changes(old: DataFrame, new: DataFrame) -> DataFrame:
    """Newest document per product of two catalogues, by source instant."""
    return pick_per_key(old.unionByName(new), ["product_id"], F.col("source_updated_at"), latest=True)
