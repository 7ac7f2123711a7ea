"""The product catalogue kept up to date by changes of the tables it is projected from.

A change is a row (source, removed, changed_at, after): the table's name, whether the row is gone, when it
changed, and its new state as JSON. A micro-batch leaves its changes in one log per source: versions of
products, categories, sellers and promotions, and sums for what only grows, items and reviews. From the keys
that changed follow the products whose documents may be different now, by joins in the direction opposite to
the projection, and only these are projected again. The main seller is decided anew for products with new
items only and kept in a log of its own, so no other batch goes through what was sold:

* products themselves, with new items or new reviews;
* products of changed categories, and products whose main seller has changed or has new reviews;
* targets of changed promotions, and products whose document shows one of them;
* targets of promotions that began or ended since the last batch. A row of source ``clock`` moves the time
  forward where nothing else has changed.

Rows may come late, repeated or in any order: the newest ``changed_at`` of a key counts. Items and reviews are
facts of their own and are sent once. A batch that runs again replaces its rows in every log.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from feira.functions import collections as C, dates, semistructured
from feira.operators.aggregates import add_rating_parts, merge_ratings, rating_parts
from feira.operators.sets import latest_per_key, pick_per_key
from feira.plans.catalog import catalog_documents, main_sellers, sold_by_seller
from feira.plans.promotions import promotion_targets
from feira.session import stored
from feira.sources.tables import append_batch, has_batches, merge_log, read_log
from feira.streaming.sync import run_available

CHANGES = "source string, removed boolean, changed_at timestamp_ntz, after string"
POINT = "struct<lng double, lat double>"
SIZES = "struct<length_cm decimal(8,2), height_cm decimal(8,2), width_cm decimal(8,2), weight_g decimal(10,2)>"
PERIOD = "struct<lower timestamp_ntz, upper timestamp_ntz, lower_inc boolean, upper_inc boolean>"
# Key and state of each versioned source.
VERSIONED = {
    "category": ("category_id", "category_id int, category_name string, category_name_english string"),
    "product": ("product_id", "product_id string, category_id int, name string, description string, product_specifications string,"
                "product_photos array<string>, product_tags array<string>, dimensions " + SIZES + ", base_price decimal(12,2)"),
    "seller": ("seller_id", "seller_id string, seller_city string, seller_state string, seller_geo " + POINT),
    "promotion": ("promotion_id", "promotion_id string, name string, discount_percentage decimal(5,2), discount_amount decimal(12,2),"
                  "promotion_period " + PERIOD + ", target_category_ids array<int>, target_product_ids array<string>"),
}
ITEM = "order_id string, order_item_id int, product_id string, seller_id string"
REVIEW = "review_id string, review_type string, product_id string, seller_id string, score int"
INSTANTS = {"timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"}


def as_changes(rows: DataFrame, source: str, changed_at: Column, removed: Column | bool = False) -> DataFrame:
    """Rows of a table as changes."""
    state = F.to_json(F.struct(*rows.columns), INSTANTS)
    return rows.select(F.lit(source).alias("source"), (F.lit(removed) if isinstance(removed, bool) else removed).alias("removed"),
                       changed_at.alias("changed_at"), state.alias("after"))


def clock(spark: SparkSession, at: str) -> DataFrame:
    """The change that only says what time it is."""
    return spark.range(1).select(F.lit("clock").alias("source"), F.lit(False).alias("removed"),
                                 dates.instant(at).alias("changed_at"), F.lit(None).cast("string").alias("after"))


def _states(batch: DataFrame, source: str, schema: str) -> DataFrame:
    state = F.from_json("after", schema, {**INSTANTS, "mode": "FAILFAST"})
    return batch.where(F.col("source") == source).select(state.alias("s"), "changed_at", "removed").select("s.*", "changed_at", "removed")


class CatalogFeed:
    """Logs below one path, as far as a batch."""

    def __init__(self, spark: SparkSession, path: str, batch_id: int, checkpoint: str = ""):
        self.spark, self.path, self.batch_id, self.checkpoint = spark, path.rstrip("/"), batch_id, checkpoint
        self._logs: dict[str, DataFrame] = {}

    def log(self, name: str) -> DataFrame:
        if name not in self._logs:
            self._logs[name] = read_log(self.spark, f"{self.path}/{name}").where(F.col("batch_id") <= self.batch_id)
        return self._logs[name]

    def touched(self, name: str) -> DataFrame:
        """What this batch has left in a log."""
        return self.log(name).where(F.col("batch_id") == self.batch_id)

    def add(self, name: str, rows: DataFrame) -> None:
        append_batch(rows, f"{self.path}/{name}", self.batch_id, self.checkpoint)
        self._logs.pop(name, None)

    def newest(self, source: str, keys: DataFrame | None = None) -> DataFrame:
        """Current rows of a versioned source, of some keys only where given."""
        key, _ = VERSIONED[source]
        versions = self.log(source).drop("batch_id")
        versions = versions if keys is None else versions.join(keys, key, "left_semi")
        return latest_per_key(versions, [key], ["changed_at"]).where("NOT removed").drop("changed_at", "removed")

    def documents(self, *columns: str) -> DataFrame:
        """Some columns of the documents as they were before this batch."""
        before = self.log("catalog").where(F.col("batch_id") < self.batch_id)
        return _newest_documents(before.select("product_id", *columns, "removed", "batch_id"))

    def take_in(self, batch: DataFrame) -> set[str]:
        """Leaves the changes of the batch in the logs of the sources it has changes of, and returns these.

        The batch is read once and dealt to a folder per source.
        """
        batch = stored(batch, "changes", by="source")
        found = {r["source"] for r in batch.select("source").distinct().collect()}  # names of tables
        new = not has_batches(self.spark, f"{self.path}/time")
        for source, (_, schema) in VERSIONED.items():
            if new or source in found:
                self.add(source, _states(batch, source, schema))
        if new or "item" in found:
            self.add("sold", sold_by_seller(_states(batch, "item", ITEM)))
            self.add("main", main_sellers(self._sold_anew()).where("product_id IS NOT NULL"))
        if new or "review" in found:
            reviews = _states(batch, "review", REVIEW)
            for kind in ("product", "seller"):
                self.add(f"{kind}_rating", rating_parts(reviews.where(F.col("review_type") == kind), f"{kind}_id"))
        self.add("time", batch.agg(F.max("changed_at").alias("at")))
        return found

    def times(self) -> tuple[Column, Column]:
        """The latest instant before this batch and as far as it; NULL before the first."""
        at = self.log("time")
        return at.where(F.col("batch_id") < self.batch_id).agg(F.max("at")).scalar(), at.agg(F.max("at")).scalar()

    def _of_categories(self, categories: DataFrame) -> DataFrame:
        """Products of some categories (category_id)."""
        return self.newest("product").join(categories, "category_id", "left_semi").select("product_id")

    def _targets(self, promotions: DataFrame) -> DataFrame:
        """Products that some promotions name, by themselves or by their category."""
        targets = promotion_targets(promotions)
        kinds = targets.where("target_kind = 'category'").select(F.col("target_id").cast("int").alias("category_id"))
        return targets.where("target_kind = 'product'").select(F.col("target_id").alias("product_id")).unionByName(self._of_categories(kinds))

    def _sold_anew(self) -> DataFrame:
        """Items per product and seller, of products with items in this batch; of all where no main seller is known yet."""
        parts = self.log("sold")
        if has_batches(self.spark, f"{self.path}/main"):
            parts = parts.join(self.touched("sold").select("product_id").distinct(), "product_id", "left_semi")
        return parts.groupBy("product_id", "seller_id").agg(F.sum("n_items").alias("n_items"))

    def mains(self, products: DataFrame | None = None) -> DataFrame:
        """The main seller of products with items (product_id, seller_id), of some products only where given."""
        known = self.log("main")
        known = known if products is None else known.join(products, "product_id", "left_semi")
        return pick_per_key(known, ["product_id"], F.col("batch_id"), latest=True).drop("batch_id")

    def _of_sellers(self, sellers: DataFrame) -> DataFrame:
        """Products whose main seller is one of some (seller_id), whether the seller is known already or not."""
        return self.mains().join(sellers, "seller_id", "left_semi").select("product_id")

    def affected(self, sources: set[str]) -> DataFrame:
        """product_id of every product whose document this batch, with changes of some sources, may change."""
        before, now = self.times()
        passed = reduce(Column.__or__, [(before < F.col(f"promotion_period.{end}")) & (F.col(f"promotion_period.{end}") <= now)
                                        for end in ("lower", "upper")])
        named = [self._targets(self.newest("promotion").where(passed))]
        own = {"product": ["product"], "item": ["sold"], "review": ["product_rating"]}
        named += [self.touched(log).select("product_id") for source in sorted(sources & set(own)) for log in own[source]]
        if "category" in sources:
            named.append(self._of_categories(self.touched("category").select("category_id")))
        if changed := [self.touched(log).select("seller_id") for source, log in (("seller", "seller"), ("review", "seller_rating")) if source in sources]:
            named.append(self._of_sellers(reduce(DataFrame.unionByName, changed)))
        if "promotion" in sources:
            offers = self.touched("promotion").select("promotion_id")
            shown = self.documents("active_promotion").select("product_id", "active_promotion.promotion_id")
            named += [self._targets(self.newest("promotion", offers)), shown.join(offers, "promotion_id", "left_semi").select("product_id")]
        return reduce(DataFrame.unionByName, named).where("product_id IS NOT NULL").distinct()

    def project(self, products: DataFrame) -> DataFrame:
        """Documents of some products (product_id) as of now; products that are gone have only their id and ``removed``."""
        _, now = self.times()
        mains = self.mains(products)
        rows = self.newest("product", products).withColumn("product_specifications", semistructured.parse(F.col("product_specifications")))
        current = self.newest("promotion").where(C.period_contains(F.col("promotion_period"), now))
        made = catalog_documents(
            rows, self.newest("category"), self.newest("seller"), mains, current,
            merge_ratings(self.log("product_rating").join(products, "product_id", "left_semi"), "product_id"),
            merge_ratings(self.log("seller_rating").join(mains, "seller_id", "left_semi"), "seller_id"), now)
        return products.join(made, "product_id", "left").withColumn("removed", F.col("sku").isNull())


def _newest_documents(log: DataFrame) -> DataFrame:
    newest = pick_per_key(log, ["product_id"], F.col("batch_id"), latest=True)
    return newest.where("NOT removed").drop("removed", "batch_id")


def apply_changes(batch: DataFrame, path: str, batch_id: int, checkpoint: str = "") -> None:
    """Takes in one batch of changes and projects the products that it affects."""
    feed = CatalogFeed(batch.sparkSession, path, batch_id, checkpoint)
    sources = feed.take_in(batch)
    if not has_batches(feed.spark, f"{feed.path}/catalog"):  # no document yet: only the columns
        append_batch(feed.project(feed.touched("product").select("product_id").limit(0)), f"{feed.path}/catalog", -1, checkpoint)
    feed.add("affected", feed.affected(sources))
    feed.add("catalog", feed.project(feed.touched("affected").select("product_id")))


def maintain_catalog(changes: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Applies a stream of changes to the catalogue below ``path``."""
    return run_available(changes, lambda batch, batch_id: apply_changes(batch, path, batch_id, checkpoint), checkpoint)


def read_maintained(spark: SparkSession, path: str) -> DataFrame:
    """The current documents."""
    return _newest_documents(read_log(spark, f"{path}/catalog"))


def compact_feed(spark: SparkSession, path: str) -> None:
    """Merges every log to one batch: newest versions, sums, newest documents. A stream may go on meanwhile."""
    for source, (key, _) in VERSIONED.items():
        merge_log(spark, f"{path}/{source}", lambda rows, key=key: latest_per_key(rows.drop("batch_id"), [key], ["changed_at"]))
    merge_log(spark, f"{path}/sold", lambda rows: rows.groupBy("product_id", "seller_id").agg(F.sum("n_items").alias("n_items")))
    merge_log(spark, f"{path}/main", lambda rows: pick_per_key(rows, ["product_id"], F.col("batch_id"), latest=True).drop("batch_id"))
    for kind in ("product", "seller"):
        merge_log(spark, f"{path}/{kind}_rating", lambda rows, kind=kind: add_rating_parts(rows, f"{kind}_id"))
    merge_log(spark, f"{path}/time", lambda rows: rows.agg(F.max("at").alias("at")))
    merge_log(spark, f"{path}/affected", lambda rows: rows.select("product_id").limit(0))
    merge_log(spark, f"{path}/catalog", lambda rows: pick_per_key(rows, ["product_id"], F.col("batch_id"), latest=True).drop("batch_id"))
