"""Data-quality rules as reports: which rows break a declared constraint."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from feira.functions import collections as C
from feira.operators.joins import foreign_key_violations
from feira.schemas import ORDER_STATUSES, PAYMENT_TYPES, REVIEW_TYPES

Rules = dict[str, Column]


def check_rules(df: DataFrame, rules: Rules, key: str) -> DataFrame:
    """(rule, violations, sample_key) for all rules in one pass; a NULL outcome passes, as in SQL checks."""
    measures = []
    for k, rule in enumerate(rules.values()):
        measures += [F.count_if(~rule).alias(f"n_{k}"), F.min(F.when(~rule, F.col(key))).alias(f"k_{k}")]
    wide = df.agg(*measures)
    lines = F.array(*[F.struct(
        F.lit(name).alias("rule"), F.col(f"n_{k}").alias("violations"),
        F.col(f"k_{k}").cast("string").alias("sample_key")) for k, name in enumerate(rules)])
    return wide.select(F.explode(lines).alias("line")).select("line.*")


def mark_broken(df: DataFrame, rules: Rules) -> DataFrame:
    """Adds the names of the rules each row breaks."""
    return df.withColumn(
        "broken_rules", F.array_compact(F.array(*[F.when(~rule, F.lit(name)) for name, rule in rules.items()])))


def split_valid(df: DataFrame, rules: Rules) -> tuple[DataFrame, DataFrame]:
    """Rows that break no rule, and the others with the names of the rules."""
    marked = mark_broken(df, rules)
    return (marked.where(F.size("broken_rules") == 0).drop("broken_rules"),
            marked.where(F.size("broken_rules") > 0))


def not_null(*columns: str) -> Rules:
    return {f"not_null_{c}": F.col(c).isNotNull() for c in columns}


def _before(first: str, second: str) -> Column:
    return F.col(second) >= F.col(first)


def order_rules() -> Rules:
    return {
        "estimated_after_purchase": F.col("order_estimated_delivery_date") > F.col("order_purchase_timestamp"),
        "approved_after_purchase": _before("order_purchase_timestamp", "order_approved_at"),
        "carrier_after_approved": _before("order_approved_at", "order_delivered_carrier_date"),
        "customer_after_carrier": _before("order_delivered_carrier_date", "order_delivered_customer_date"),
        "status_in_domain": F.col("order_status").isin(ORDER_STATUSES),
        **not_null("order_id", "customer_unique_id", "order_status", "order_purchase_timestamp",
                   "order_estimated_delivery_date"),
    }


def item_rules() -> Rules:
    """Rules of items that carry the purchase instant of their order."""
    return {
        "shipping_after_purchase": _before("order_purchase_timestamp", "shipping_limit_date"),
        "price_not_negative": F.col("price") >= 0,
        "freight_not_negative": F.col("freight_value") >= 0,
    }


def product_rules() -> Rules:
    sizes = [F.col(f"dimensions.{c}") >= 0 for c in ("length_cm", "height_cm", "width_cm", "weight_g")]
    return {
        "dimensions_not_negative": F.col("dimensions").isNull() | reduce(Column.__and__, sizes),
        "base_price_not_negative": F.col("base_price") >= 0,
        **not_null("product_id", "name", "base_price"),
    }


def promotion_rules() -> Rules:
    period, pct, amount = F.col("promotion_period"), F.col("discount_percentage"), F.col("discount_amount")
    return {
        "period_not_empty": ~C.period_is_empty(period),
        "period_bounded": period["lower"].isNotNull() & period["upper"].isNotNull(),
        "percentage_in_range": pct.between(0, 100),
        "amount_not_negative": amount >= 0,
        "one_kind_of_discount": pct.isNull() != amount.isNull(),
    }


def history_rules() -> Rules:
    return {"status_changes": F.col("from_status").isNull() | (F.col("from_status") != F.col("to_status"))}


def address_rules(prefix: str) -> Rules:
    """Rules of customers (``customer``) and sellers (``seller``)."""
    state = F.col(f"{prefix}_state")
    return {
        "state_code": (state == F.upper(state)) & (F.length(state) == 2),
        "zip_in_range": F.col(f"{prefix}_zip_code_prefix").between(1000, 99999),
        **not_null(f"{prefix}_zip_code_prefix", f"{prefix}_city", f"{prefix}_state"),
    }


def payment_rules() -> Rules:
    return {
        "value_positive": F.col("payment_value") > 0,
        "installments_at_least_one": F.col("payment_installments") >= 1,
        "type_in_domain": F.col("payment_type").isin(PAYMENT_TYPES),
    }


def review_document_rules() -> Rules:
    return {
        **not_null("review_id", "order_id", "customer_unique_id", "created_at"),
        "score_in_range": F.col("score").isNotNull() & F.col("score").between(1, 5),
        "type_in_domain": F.coalesce(F.col("review_type").isin(REVIEW_TYPES), F.lit(False)),
        # The discriminator decides which reference a review must have.
        "subject_named": F.when(F.col("review_type") == "product", F.col("product_id").isNotNull())
                          .when(F.col("review_type") == "seller", F.col("seller_id").isNotNull()),
    }


def catalog_document_rules() -> Rules:
    return {
        **not_null("product_id", "sku", "name", "base_price", "price_current", "synced_at", "source_updated_at"),
        "category_named": F.col("category.id").isNotNull() & F.col("category.name").isNotNull(),
        "seller_located": F.col("seller.id").isNotNull() & F.col("seller.city").isNotNull()
                          & F.col("seller.state").isNotNull(),
        "rating_in_range": F.col("seller.rating_avg").between(0, 5),
        "price_not_negative": (F.col("base_price") >= 0) & (F.col("price_current") >= 0),
        "discount_in_range": F.col("discount_percentage").between(0, 100),
    }


def bucket_document_rules() -> Rules:
    return {
        **not_null("session_id", "bucket_hour", "event_count", "events", "expires_at"),
        "count_not_negative": F.col("event_count") >= 0,
        "events_typed": ~F.exists("events", lambda e: e["type"].isNull() | e["ts"].isNull()),
    }


def session_document_rules() -> Rules:
    return {
        **not_null("session_id", "started_at", "last_activity_at", "expires_at"),
        "activity_in_order": _before("started_at", "last_activity_at"),
    }


def duplicate_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    """Key values that occur more than once, with how often."""
    return df.groupBy(*keys).agg(F.count("*").alias("n")).where(F.col("n") > 1)


def unique_report(df: DataFrame, rule: str, keys: list[str]) -> DataFrame:
    """(rule, violations, sample_key): how many key values repeat."""
    repeated = duplicate_keys(df, keys)
    return repeated.agg(
        F.count("*").alias("violations"),
        F.min(F.concat_ws("|", *[F.col(k).cast("string") for k in keys])).alias("sample_key")).select(
            F.lit(rule).alias("rule"), "violations", "sample_key")


def reference_report(rule: str, child: DataFrame, parent: DataFrame, keys: list[str], sample: str) -> DataFrame:
    """(rule, violations, sample_key): how many child rows have no parent."""
    lost = foreign_key_violations(child, parent, keys)
    return lost.agg(F.count("*").alias("violations"), F.min(sample).alias("sample_key")).select(
        F.lit(rule).alias("rule"), "violations", "sample_key")


def union_reports(*reports: DataFrame) -> DataFrame:
    return reduce(DataFrame.unionByName, reports)
