"""Grouped reports over the domain tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from feira.functions import dates, geo

TOTAL = "decimal(18,2)"


def total(amount: Column) -> Column:
    return F.sum(amount).cast(TOTAL)


def value_counts(df: DataFrame, column: str) -> DataFrame:
    return df.groupBy(column).agg(F.count("*").alias("n"))


def value_shares(df: DataFrame, column: str) -> DataFrame:
    """Non-NULL values with their count and share in per cent, rounded half to even.

    The total is a scalar subquery over the counts, so no row is moved to one task for it.
    """
    counts = value_counts(df.where(F.col(column).isNotNull()), column)
    everything = counts.agg(F.sum("n").cast("double")).scalar()
    return counts.withColumn("pct", F.bround(F.col("n").cast("double") / everything * 100, 2))


def time_counts(orders: DataFrame, unit: str, ts: str = "order_purchase_timestamp") -> DataFrame:
    """Orders per ``month``, ``weekday`` or ``hour``."""
    label = {
        "month": dates.month_label(F.col(ts)),
        "weekday": dates.weekday_name(F.col(ts)),
        "hour": F.hour(ts),
    }[unit]
    return orders.where(F.col(ts).isNotNull()).groupBy(label.alias(unit)).agg(F.count("*").alias("n_orders"))


def time_span(orders: DataFrame, ts: str = "order_purchase_timestamp") -> DataFrame:
    return orders.agg(F.min(ts).alias("first_at"), F.max(ts).alias("last_at"), F.count(ts).alias("n_orders"))


def sales_by(items: DataFrame, key: str) -> DataFrame:
    return items.groupBy(key).agg(
        F.count("*").alias("n_items"), total(F.col("price")).alias("revenue"),
        total(F.col("freight_value")).alias("freight"))


def payments_by_type(payments: DataFrame) -> DataFrame:
    return payments.groupBy("payment_type").agg(
        F.count("*").alias("n_payments"), total(F.col("payment_value")).alias("paid"),
        F.max("payment_installments").alias("max_installments"))


def payments_per_order(payments: DataFrame) -> DataFrame:
    """Number of orders by how many payments they have."""
    sizes = payments.groupBy("order_id").agg(F.count("*").alias("n_payments"))
    return sizes.groupBy("n_payments").agg(F.count("*").alias("n_orders"))


def state_centroids(customers: DataFrame) -> DataFrame:
    """Customers per state and their mean position as text."""
    placed = customers.where(F.col("customer_geo").isNotNull())
    grouped = placed.groupBy("customer_state").agg(
        F.count("*").alias("n_customers"),
        geo.centroid(F.col("customer_geo.lng"), F.col("customer_geo.lat")).alias("center"))
    return grouped.select("customer_state", "n_customers", geo.point_text(F.col("center"), 4).alias("centroid"))


def ratings(reviews: DataFrame, key: str) -> DataFrame:
    """Mean score to two places, count and how often each score occurs."""
    scored = reviews.where(F.col(key).isNotNull())
    stars = [F.count_if(F.col("score") == s).alias(f"score_{s}") for s in range(1, 6)]
    mean = dates.mean_hundredths(
        100 * F.sum("score").cast("decimal(28,0)"), F.count("score").cast("decimal(28,0)")).cast("decimal(4,2)")
    return scored.groupBy(key).agg(mean.alias("rating_avg"), F.count("*").alias("n_reviews"), *stars)


PART_NAMES = ["score_sum", "n_scores", "n_reviews", *[f"score_{s}" for s in range(1, 6)]]


def rating_parts(reviews: DataFrame, key: str) -> DataFrame:
    """Sums and counts of scores per key that can be added up over batches."""
    stars = [F.count_if(F.col("score") == s).alias(f"score_{s}") for s in range(1, 6)]
    return reviews.where(F.col(key).isNotNull()).groupBy(key).agg(
        F.sum(F.col("score").cast("long")).alias("score_sum"), F.count("score").alias("n_scores"),
        F.count("*").alias("n_reviews"), *stars)


def add_rating_parts(parts: DataFrame, key: str) -> DataFrame:
    """The parts of several batches as one row per key."""
    return parts.groupBy(key).agg(*[F.sum(n).alias(n) for n in PART_NAMES])


def merge_ratings(parts: DataFrame, key: str) -> DataFrame:
    """The ratings of all batches together, as ``ratings`` gives them for all reviews."""
    names = ["n_reviews", *[f"score_{s}" for s in range(1, 6)]]
    mean = dates.mean_hundredths(
        100 * F.sum("score_sum").cast("decimal(28,0)"), F.sum("n_scores").cast("decimal(28,0)")).cast("decimal(4,2)")
    return parts.groupBy(key).agg(mean.alias("rating_avg"), *[F.sum(n).alias(n) for n in names])


def user_behavior_daily(events: DataFrame) -> DataFrame:
    """Per day: events, distinct users, events of each main type and the share of users who buy.

    Events collapse to one row per day and user before the day is counted, so distinct users
    are plain rows and no event is multiplied for a distinct count.
    """
    kinds = ["page_view", "search", "add_to_cart", "order_completed"]
    per_user = events.groupBy(F.col("ts").cast("date").alias("day"), "customer_unique_id").agg(
        F.count("*").alias("n_events"), *[F.count_if(F.col("type") == k).alias(f"n_{k}") for k in kinds])
    users = F.count("customer_unique_id")
    buyers = F.count_if(F.col("customer_unique_id").isNotNull() & (F.col("n_order_completed") > 0))
    return per_user.groupBy("day").agg(
        F.sum("n_events").alias("n_events"), users.alias("n_users"), buyers.alias("n_buyers"),
        *[F.sum(f"n_{k}").alias(f"n_{k}") for k in kinds],
        F.round(buyers.cast("double") / F.nullif(users, F.lit(0)).cast("double"), 4).alias("conversion"))


def distinct_ratio(df: DataFrame, many: str, few: str) -> DataFrame:
    """Distinct values of two columns and their ratio."""
    other = df.agg(F.count_distinct(few)).scalar()
    counted = df.agg(F.count_distinct(many).alias("n_many")).withColumn("n_few", other)
    return counted.withColumn("ratio", F.round(F.col("n_many").cast("double") / F.col("n_few").cast("double"), 3))


def category_coverage(products: DataFrame, column: str = "category_name") -> DataFrame:
    return products.agg(
        F.count_distinct(column).alias("n_categories"), F.count_if(F.col(column).isNull()).alias("n_uncategorized"))
