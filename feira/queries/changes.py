"""The catalogue kept up by changes, beside the catalogue projected from the tables."""

from functools import reduce

from pyspark.sql import DataFrame, functions as F

from feira.functions import dates
from feira.queries.catalog import CATALOG, flat_documents
from feira.queries.registry import query
from feira.session import scratch_path, stored, tasks
from feira.sources.domain import AS_OF
from feira.streaming import propagation
from feira.streaming.propagation import as_changes


def _every(column: str, n: int, start: int = 6):
    """True for one row of ``n``, by the number in an id."""
    return F.pmod(F.substring(column, F.lit(start), F.lit(20)).cast("long"), F.lit(n)) == 0


def change_turns(m) -> list[DataFrame]:
    """Changes in five turns that end in the tables as they are.

    First come old states and some products that will go; then new, missing, late and removed ones; at last
    only the time moves on, to an instant at which promotions begin and end. Tables that several turns are made
    of are worked out once.
    """
    def at(day):
        return dates.instant(f"{day} 00:00:00")

    def some(source, rows, day, removed=False):
        return as_changes(rows, source, at(day), removed)

    categories = m.category.select("category_id", "category_name", "category_name_english")
    products = stored(m.categorized_product.select(
        "product_id", "category_id", "name", "description", F.to_json("product_specifications").alias("product_specifications"),
        "product_photos", "product_tags", "dimensions", "base_price").repartition(tasks(m.spark), "product_id"), "products")
    sellers = m.seller_geo.select("seller_id", "seller_city", "seller_state", "seller_geo")
    items = stored(m.order_item.select("order_id", "order_item_id", "product_id", "seller_id"), "items")
    reviews = stored(m.reviews_of(items).select("review_id", "review_type", "product_id", "seller_id", "score", "order_id"), "reviews")
    early_items, early_reviews = ~_every("order_id", 4, 1), ~_every("order_id", 5, 1)
    dearer = (F.col("base_price") + 1).cast("decimal(12,2)")
    gone = products.where(_every("product_id", 11)).withColumn("product_id", F.concat(F.lit("GONE_"), "product_id"))
    old_promotions = m.promotion.withColumns({
        "discount_percentage": F.lit(1).cast("decimal(5,2)"),
        "target_product_ids": F.transform("target_product_ids", lambda p: F.concat(p, F.lit("1"))),
        "target_category_ids": F.transform("target_category_ids", lambda c: c + 1)})
    first = [
        some("category", categories.withColumn("category_name_english", F.lit("old")), "2001-06-15"),
        some("product", products.where(~_every("product_id", 7)).withColumns({
            "name": F.lit("old"), "base_price": F.when(_every("product_id", 3), dearer).otherwise(F.col("base_price"))}), "2001-06-15"),
        some("product", gone, "2001-06-15"),
        some("seller", sellers.where(~_every("seller_id", 5)).withColumn("seller_city", F.lit("old")), "2001-06-15"),
        some("promotion", old_promotions, "2001-06-15"),
        some("item", items.where(early_items), "2001-06-15"), some("review", reviews.where(early_reviews).drop("order_id"), "2001-06-15")]
    second = [some("product", products, "2001-06-20"), some("product", gone, "2001-06-20", removed=True)]
    third = [some("seller", sellers, "2001-07-05"), some("category", categories, "2001-07-05")]
    fourth = [
        some("promotion", m.promotion, "2001-07-20"), some("product", products.withColumn("name", F.lit("late")), "2001-06-18"),
        some("item", items.where(~early_items), "2001-07-20"), some("review", reviews.where(~early_reviews).drop("order_id"), "2001-07-20")]
    turns = [reduce(DataFrame.unionByName, rows) for rows in (first, second, third, fourth)]
    return [*turns, propagation.clock(m.spark, AS_OF)]


def maintained(m) -> str:
    """Applies the turns, each as one batch of a stream, merges all logs on the way, and returns the path of the catalogue."""
    path = scratch_path(m.spark, "feed")
    for k, turn in enumerate(change_turns(m)):
        turn.write.mode("append").parquet(f"{path}/in")
        stream = m.spark.readStream.schema(propagation.CHANGES).parquet(f"{path}/in")
        propagation.maintain_catalog(stream, f"{path}/out", f"{path}/checkpoint").awaitTermination()
        if k == 2:
            propagation.compact_feed(m.spark, f"{path}/out")
    return f"{path}/out"


@query("i5_propagated_catalog", f"SELECT * EXCLUDE (lng, lat) FROM ({CATALOG}) t")
def i5_propagated(m):
    """The catalogue after changes of all tables it depends on; equal to the one projected from scratch."""
    return flat_documents(propagation.read_maintained(m.spark, maintained(m)))
