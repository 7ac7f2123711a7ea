"""Equality joins between the domain tables.

No join carries a broadcast hint: the optimizer broadcasts a side only where its statistics,
or its size measured at run time, stay below the threshold, and splits hot keys otherwise.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F

from feira.functions import geo
from feira.session import stored

ORDER_KEYS = ["order_id", "order_purchase_timestamp"]


def with_category(products: DataFrame, categories: DataFrame, key: str = "category_id") -> DataFrame:
    return products.join(categories, key)


def order_lines(orders: DataFrame, items: DataFrame) -> DataFrame:
    """Orders with their items, on id and purchase instant where the items store the instant."""
    keys = [k for k in ORDER_KEYS if k in items.columns]
    return orders.join(items, keys)


def sales_facts(
    orders: DataFrame, items: DataFrame, products: DataFrame, categories: DataFrame, category_key: str = "category_id",
) -> DataFrame:
    """Order lines with product and category."""
    # Products meet their category first: both are dimensions, and the items then join once.
    described = with_category(products.select("product_id", category_key), categories, category_key)
    return order_lines(orders, items).join(described, "product_id")


def pair_distance(pairs: DataFrame, customers: DataFrame, sellers: DataFrame, method: str = "sphere") -> DataFrame:
    """Distance of each requested (customer, seller) pair by two key joins."""
    placed = (pairs.join(customers.select("customer_unique_id", "customer_geo"), "customer_unique_id")
              .join(sellers.select("seller_id", "seller_geo"), "seller_id"))
    distance = geo.distance_km(F.col("customer_geo"), F.col("seller_geo"), method)
    return placed.select("customer_unique_id", "seller_id", distance.alias("distance_km"))


def lookup_geo(df: DataFrame, geolocation: DataFrame, zip_column: str, geo_column: str) -> DataFrame:
    """Fill missing points from the zip table; the entry with the smallest id decides."""
    place = geo.point(F.col("geolocation_lng"), F.col("geolocation_lat"))
    by_zip = geolocation.groupBy(F.col("geolocation_zip_code_prefix").alias(zip_column)).agg(
        F.min_by(place, F.col("geolocation_id")).alias("looked_up"))
    return df.join(by_zip, zip_column, "left").withColumn(
        geo_column, F.coalesce(F.col(geo_column), F.col("looked_up"))).drop("looked_up")


def accept_reviews(reviews: DataFrame, orders: DataFrame) -> DataFrame:
    """Reviews whose order exists."""
    return reviews.join(orders, "order_id", "left_semi")


def orphan_reviews(reviews: DataFrame, orders: DataFrame, products: DataFrame) -> DataFrame:
    """Reviews that point to a missing order or product, with what is missing."""
    known_orders = orders.select("order_id").distinct().withColumn("order_found", F.lit(True))
    known_products = products.select("product_id").distinct().withColumn("product_found", F.lit(True))
    no_order = F.col("order_found").isNull()
    no_product = F.col("product_found").isNull() & F.col("product_id").isNotNull()
    checked = reviews.join(known_orders, "order_id", "left").join(known_products, "product_id", "left")
    return checked.where(no_order | no_product).select(
        "review_id", "order_id", "product_id", no_order.alias("order_missing"), no_product.alias("product_missing"))


def category_paths(categories: DataFrame) -> DataFrame:
    """Each category with its root, depth and path, by pointer doubling.

    Every category points to its parent; in each round it takes over the pointer of the one it points to, so a
    tree of depth d is done after log2(d) rounds, each written to the shared folder. Once the roots are known, paths
    are put together in the same way, from stretches that double. A parent with very many children is a hot key of
    the joins, which adaptive execution splits.

    Categories of a cycle, or below one, have no root: ``complete`` is false and the rest NULL. They are those that
    still point somewhere after as many rounds as a chain of all categories would take. A parent that does not
    exist makes its child a root. Ids are unique.
    """
    ids = categories.select(F.col("category_id").alias("parent_category_id"))
    named = categories.select("category_id", "parent_category_id")
    tree = stored(named.join(ids, "parent_category_id", "left_semi").select("category_id", F.col("parent_category_id").alias("up"))
                  .unionByName(named.join(ids, "parent_category_id", "left_anti").select(
                      "category_id", F.lit(None).cast(named.schema["category_id"].dataType).alias("up"))), "tree")
    start = tree.select("category_id", "up", F.when(F.col("up").isNull(), F.col("category_id")).alias("root"),
                        F.when(F.col("up").isNotNull(), 1).otherwise(0).alias("depth"))
    rounds = tree.count().bit_length() + 1
    found = _doubled(start, rounds, lambda own, above: {
        "root": above["root"], "depth": own["depth"] + above["depth"]})
    whole = found.where("root IS NOT NULL").select("category_id", "root", "depth")
    steps = tree.join(whole.select("category_id"), "category_id", "left_semi").withColumn("path", F.array("category_id"))
    paths = _doubled(steps, rounds, lambda own, above: {"path": F.concat(above["path"], own["path"])})
    placed = paths.join(whole, "category_id").select("category_id", F.col("root").alias("root_id"), "depth", "path")
    return categories.select("category_id").join(placed, "category_id", "left").withColumn("complete", F.col("root_id").isNotNull())


def _doubled(steps: DataFrame, rounds: int, merge: Callable[[_Side, _Side], dict[str, Column]]) -> DataFrame:
    """Rows (category_id, up, …) that have taken over, round by round, from where they point, until none points anywhere."""
    steps = stored(steps, "steps")
    for _ in range(rounds):
        if steps.where("up IS NOT NULL").isEmpty():
            break
        own, above = steps.where("up IS NOT NULL").alias("own"), steps.alias("above")
        both = own.join(above, F.col("own.up") == F.col("above.category_id"))
        merged = merge(_Side("own"), _Side("above"))
        columns = [c for c in steps.columns if c not in ("category_id", "up", *merged)]
        moved = both.select("own.category_id", "above.up", *[F.col(f"own.{c}") for c in columns], *[c.alias(n) for n, c in merged.items()])
        steps = stored(steps.where("up IS NULL").unionByName(moved.select(*steps.columns)), "steps")
    return steps


class _Side:
    """Columns of one side of a self-join."""

    def __init__(self, name: str):
        self.name = name

    def __getitem__(self, column: str) -> Column:
        return F.col(f"{self.name}.{column}")


def orders_with_customer(orders: DataFrame, customers: DataFrame) -> DataFrame:
    return orders.join(customers, "customer_unique_id")


def delivered_with_review(orders: DataFrame, reviews: DataFrame) -> DataFrame:
    """Delivered orders with each of their reviews."""
    delivered = orders.where(F.col("order_delivered_customer_date").isNotNull())
    return delivered.join(reviews.select("order_id", "review_id", "score"), "order_id")


def item_flows(items: DataFrame, orders: DataFrame, customers: DataFrame, sellers: DataFrame) -> DataFrame:
    """Seller state and customer state of every item."""
    buyers = (orders.select("order_id", "customer_unique_id")
              .join(customers.select("customer_unique_id", "customer_state"), "customer_unique_id"))
    return (items.select("order_id", "seller_id").join(buyers, "order_id")
            .join(sellers.select("seller_id", "seller_state"), "seller_id")
            .select("order_id", "seller_state", "customer_state"))


def foreign_key_violations(child: DataFrame, parent: DataFrame, keys: list[str]) -> DataFrame:
    """Child rows whose (complete) key has no parent."""
    present = [F.col(k).isNotNull() for k in keys]
    wanted = child
    for condition in present:
        wanted = wanted.where(condition)
    return wanted.join(parent, keys, "left_anti")
