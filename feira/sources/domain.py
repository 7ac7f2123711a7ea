"""Domain tables of the marketplace, derived by fixed arithmetic from a star schema in Parquet."""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from feira.functions import collections as C, dates, geo, semistructured
from feira.session import tune

AS_OF = "2001-08-02 00:00:00"

# The four promotions. P2 starts and P3 ends exactly at AS_OF.
PROMOTIONS = [
    ("P1", "spring", "20.00", None, "2001-07-01 00:00:00", "2001-09-01 00:00:00", 1),
    ("P2", "flat", None, "50.00", "2001-08-02 00:00:00", "2001-08-03 00:00:00", 1),
    ("P3", "expired", "15.00", None, "1998-01-01 00:00:00", "2001-08-02 00:00:00", 2),
    ("P4", "history", "10.00", None, "1996-01-01 00:00:00", "1999-01-01 00:00:00", 3),
]

ITEM = [
    "CAST(l_orderkey AS STRING) AS order_id", "order_item_id",
    "concat('PROD_', l_partkey) AS product_id", "concat('SELL_', l_suppkey) AS seller_id",
    "l_shipdate AS shipping_limit_date", "CAST(l_extendedprice AS DECIMAL(12,2)) AS price",
    "CAST(l_quantity AS DECIMAL(12,2)) AS freight_value"]


class Marketplace:
    """Lazy frames over one folder; a query reads only the columns it uses."""

    def __init__(self, spark: SparkSession, folder: str, as_of: str = AS_OF):
        self.spark, self.folder, self.as_of = tune(spark), folder.rstrip("/"), as_of
        self._raw: dict[str, DataFrame] = {}

    @property
    def now(self):
        return dates.instant(self.as_of)

    def raw(self, name: str) -> DataFrame:
        if name not in self._raw:
            self._raw[name] = self.spark.read.parquet(f"{self.folder}/{name}.parquet")
        return self._raw[name]

    def stream(self, name: str) -> DataFrame:
        """The same table as a stream of its files."""
        reader = self.spark.readStream.schema(self.raw(name).schema).option("pathGlobFilter", f"{name}.parquet")
        return reader.parquet(self.folder)

    @cached_property
    def category(self) -> DataFrame:
        # One row per category name: a dimension, so one ordered window is enough.
        names = self.raw("part").select("p_type").distinct()
        return names.select(
            F.row_number().over(Window.orderBy("p_type")).alias("category_id"),
            F.col("p_type").alias("category_name"),
            F.lower("p_type").alias("category_name_english"),
            F.lit(None).cast("int").alias("parent_category_id"))

    @cached_property
    def taxonomy(self) -> DataFrame:
        """Three-level hierarchy: type, type/brand, type/brand/name; ids are the paths."""
        part = self.raw("part")
        kind = F.col("p_type")
        brand = F.concat_ws("/", "p_type", "p_brand")
        leaf = F.concat_ws("/", "p_type", "p_brand", "p_name")
        none = F.lit(None).cast("string")
        levels = F.array(
            F.struct(kind.alias("category_id"), none.alias("parent_category_id")),
            F.struct(brand.alias("category_id"), kind.alias("parent_category_id")),
            F.struct(leaf.alias("category_id"), brand.alias("parent_category_id")))
        return part.select(F.explode(levels).alias("c")).select("c.*").distinct()

    @cached_property
    def customer(self) -> DataFrame:
        return self.raw("customer").selectExpr(
            "concat('CUST_', c_custkey) AS customer_unique_id",
            "CAST(1000 + (c_custkey * 37) % 99000 AS INT) AS customer_zip_code_prefix",
            "concat('City_', c_nationkey) AS customer_city",
            "concat('N', chr(65 + c_nationkey)) AS customer_state",
            "CAST((c_custkey * 7919) % 3800 - 7300 AS DOUBLE) / CAST(100 AS DOUBLE) AS lng",
            "CAST((c_custkey * 10007) % 3800 - 3300 AS DOUBLE) / CAST(100 AS DOUBLE) AS lat")

    @cached_property
    def seller(self) -> DataFrame:
        return self.raw("supplier").selectExpr(
            "concat('SELL_', s_suppkey) AS seller_id",
            "CAST(1000 + (s_suppkey * 41) % 99000 AS INT) AS seller_zip_code_prefix",
            "concat('City_', s_nationkey) AS seller_city",
            "concat('N', chr(65 + s_nationkey)) AS seller_state",
            "CAST((s_suppkey * 7907) % 3800 - 7300 AS DOUBLE) / CAST(100 AS DOUBLE) AS lng",
            "CAST((s_suppkey * 10009) % 3800 - 3300 AS DOUBLE) / CAST(100 AS DOUBLE) AS lat")

    @cached_property
    def customer_geo(self) -> DataFrame:
        return self.customer.withColumn("customer_geo", geo.point(F.col("lng"), F.col("lat"))).drop("lng", "lat")

    @cached_property
    def seller_geo(self) -> DataFrame:
        return self.seller.withColumn("seller_geo", geo.point(F.col("lng"), F.col("lat"))).drop("lng", "lat")

    @cached_property
    def geolocation(self) -> DataFrame:
        """Zip lookup with repeated zips; ids order the repeats."""
        def rows(frame: DataFrame, key: str, zip_code: str, prefix: str) -> DataFrame:
            return frame.selectExpr(
                f"{key} AS geolocation_id", f"{zip_code} AS geolocation_zip_code_prefix",
                "lat AS geolocation_lat", "lng AS geolocation_lng",
                f"{prefix}_city AS geolocation_city", f"{prefix}_state AS geolocation_state")

        buyers = rows(self.customer, "2 * CAST(substring(customer_unique_id, 6) AS BIGINT)",
                      "customer_zip_code_prefix", "customer")
        shops = rows(self.seller, "2 * CAST(substring(seller_id, 6) AS BIGINT) + 1",
                     "seller_zip_code_prefix", "seller")
        return buyers.unionByName(shops)

    @cached_property
    def product(self) -> DataFrame:
        return self.raw("part").selectExpr(
            "concat('PROD_', p_partkey) AS product_id", "p_type AS category_name", "p_name AS name",
            "concat(p_name, ' ', lower(p_type), ' by ', p_brand) AS description",
            """concat('{"color":"', split_part(p_name, ' ', 1), '","size":', p_size,
                      ',"brand":"', p_brand, '"}') AS product_specifications""",
            "CASE WHEN p_partkey % 17 = 0 THEN NULL ELSE p_partkey % 4 END AS n_photos",
            "split_part(p_name, ' ', 1) AS tag_1", "split_part(p_name, ' ', 2) AS tag_2",
            "CASE WHEN p_partkey % 5 = 0 THEN 'oferta' ELSE 'normal' END AS tag_3",
            "CAST(p_size AS DECIMAL(8,2)) AS length_cm", "CAST(p_size % 7 + 1 AS DECIMAL(8,2)) AS height_cm",
            "CAST(p_size % 11 + 1 AS DECIMAL(8,2)) AS width_cm", "CAST(p_size * 137 AS DECIMAL(10,2)) AS weight_g",
            "CAST(p_retailprice AS DECIMAL(12,2)) AS base_price")

    @cached_property
    def rich_product(self) -> DataFrame:
        """Products with the nested columns: variant, arrays and one dimensions struct."""
        photos = F.transform(
            F.when(F.col("n_photos") > 0, F.sequence(F.lit(1), F.col("n_photos").cast("int")))
             .when(F.col("n_photos") == 0, F.array().cast("array<int>")),
            lambda i: F.concat(F.lit("img/"), F.col("product_id"), F.lit("_"), i.cast("string"), F.lit(".jpg")))
        return self.product.select(
            "product_id", "category_name", "name", "description", "base_price",
            semistructured.parse(F.col("product_specifications")).alias("product_specifications"),
            photos.alias("product_photos"),
            F.array("tag_1", "tag_2", "tag_3").alias("product_tags"),
            F.struct("length_cm", "height_cm", "width_cm", "weight_g").alias("dimensions"))

    @cached_property
    def categorized_product(self) -> DataFrame:
        """Rich products with the surrogate key of their category."""
        keys = self.category.select("category_id", "category_name")
        return self.rich_product.join(keys, "category_name")

    @cached_property
    def order(self) -> DataFrame:
        return order_rows(self.raw("orders"))

    @cached_property
    def _numbered_line(self) -> DataFrame:
        line = Window.partitionBy("l_orderkey").orderBy(
            "l_linenumber", "l_partkey", "l_suppkey", "l_shipdate", "l_extendedprice",
            "l_quantity", "l_discount", "l_tax", "l_returnflag", "l_linestatus")
        return self.raw("lineitem").withColumn("order_item_id", F.row_number().over(line))

    @cached_property
    def order_item(self) -> DataFrame:
        """Items; the number within the order stands for a stored column and is computed only where it is used."""
        return self._numbered_line.selectExpr(*ITEM)

    @cached_property
    def stamped_item(self) -> DataFrame:
        """Items with the purchase instant of their order, as the item table stores it; joined by the key they are numbered by."""
        stamps = self.order.select(F.col("order_id").cast("long").alias("l_orderkey"), "order_purchase_timestamp")
        return self._numbered_line.join(stamps, "l_orderkey").selectExpr(*ITEM, "order_purchase_timestamp")

    @cached_property
    def payment(self) -> DataFrame:
        return self.raw("orders").selectExpr(
            "CAST(o_orderkey AS STRING) AS order_id", "CAST(1 AS INT) AS payment_sequential",
            """CASE substring(o_orderpriority, 1, 1) WHEN '1' THEN 'credit_card' WHEN '2' THEN 'boleto'
               WHEN '3' THEN 'voucher' WHEN '4' THEN 'debit_card' ELSE 'pix' END AS payment_type""",
            "CAST(1 + o_orderkey % 10 AS INT) AS payment_installments",
            "CAST(o_totalprice AS DECIMAL(12,2)) AS payment_value")

    @cached_property
    def review(self) -> DataFrame:
        return self.raw("orders").where("o_orderstatus = 'F'").selectExpr(
            "concat('REV_', o_orderkey) AS review_id",
            "CASE WHEN o_orderkey % 3 = 0 THEN 'seller' ELSE 'product' END AS review_type",
            "CAST(CASE WHEN o_orderkey % 50 = 7 THEN -o_orderkey ELSE o_orderkey END AS STRING) AS order_id",
            "CAST(1 + (o_orderkey * 7) % 5 AS INT) AS score",
            "o_orderdate + INTERVAL '25' DAY AS created_at")

    @cached_property
    def review_doc(self) -> DataFrame:
        return self.reviews_of(self.order_item)

    def reviews_of(self, items: DataFrame) -> DataFrame:
        """Reviews with the product, seller and customer of the first item of their order."""
        first = items.where("order_item_id = 1").select("order_id", "product_id", "seller_id")
        buyers = self.order.select("order_id", "customer_unique_id")
        return self.review.join(first, "order_id", "left").join(buyers, "order_id", "left")

    @cached_property
    def promotion(self) -> DataFrame:
        """Four promotions of categories and one campaign per supplier on two products."""
        schema = ("promotion_id string, name string, percentage string, amount string,"
                  "lower string, upper string, target int")
        fixed = self.spark.createDataFrame(PROMOTIONS, schema).select(
            "promotion_id", "name", F.col("percentage").cast("decimal(5,2)").alias("discount_percentage"),
            F.col("amount").cast("decimal(12,2)").alias("discount_amount"),
            F.col("lower").cast("timestamp_ntz").alias("lower"), F.col("upper").cast("timestamp_ntz").alias("upper"),
            F.array("target").alias("target_category_ids"),
            F.array().cast("array<string>").alias("target_product_ids"))
        campaigns = self.raw("supplier").selectExpr(
            "concat('SP_', s_suppkey) AS promotion_id", "concat('campaign ', s_suppkey) AS name",
            "CASE WHEN s_suppkey % 3 <> 0 THEN CAST(5 + s_suppkey % 40 AS DECIMAL(5,2)) END AS discount_percentage",
            "CASE WHEN s_suppkey % 3 = 0 THEN CAST(10 + s_suppkey % 200 AS DECIMAL(12,2)) END AS discount_amount",
            "TIMESTAMP_NTZ '1996-01-01 00:00:00' + ((s_suppkey * 37) % 2100) * INTERVAL '1' DAY AS lower",
            """TIMESTAMP_NTZ '1996-01-01 00:00:00' + ((s_suppkey * 37) % 2100 + s_suppkey % 200 + 1) * INTERVAL '1' DAY
               AS upper""",
            "CAST(array() AS ARRAY<INT>) AS target_category_ids",
            "array(concat('PROD_', s_suppkey * 13), concat('PROD_', s_suppkey * 17)) AS target_product_ids")
        both = fixed.unionByName(campaigns)
        return both.withColumn("promotion_period", C.period(F.col("lower"), F.col("upper"))).drop("lower", "upper")

    @cached_property
    def session_event(self) -> DataFrame:
        return session_events(self.raw("events"))

    @cached_property
    def order_history(self) -> DataFrame:
        return order_versions(self.order)


def order_versions(orders: DataFrame) -> DataFrame:
    """Status versions of each order: one row per lifecycle instant that is set, with repeats."""
    steps = F.array(
        F.struct(F.lit("created").alias("status"), F.col("order_purchase_timestamp").alias("at")),
        F.struct(F.lit("approved").alias("status"), F.col("order_approved_at").alias("at")),
        F.struct(F.when(F.col("order_status") == "invoiced", "invoiced").otherwise("shipped").alias("status"),
                 F.col("order_delivered_carrier_date").alias("at")),
        F.struct(F.col("order_status").alias("status"),
                 F.col("order_delivered_customer_date").alias("at")),
        F.struct(F.when(F.col("order_approved_at").isNotNull(), "approved").otherwise("created").alias("status"),
                 (F.col("order_purchase_timestamp") + F.expr("INTERVAL '3' HOUR")).alias("at")))
    exploded = orders.select(
        "order_id", "order_purchase_timestamp", F.posexplode(steps).alias("step", "s"))
    return exploded.where("s.at IS NOT NULL").select(
        "order_id", "order_purchase_timestamp", "step", F.col("s.status").alias("order_status"),
        F.col("s.at").alias("changed_at"))


def session_events(events: DataFrame) -> DataFrame:
    """Click events with session and customer names; works on a batch or a stream."""
    return events.selectExpr(
        "event_id", "concat('sess_', user_id) AS session_id", "concat('CUST_', user_id) AS customer_unique_id",
        """CASE event_type WHEN 'view' THEN 'page_view' WHEN 'click' THEN 'search'
           WHEN 'purchase' THEN 'order_completed' WHEN 'signup' THEN 'add_to_cart' ELSE 'error' END AS type""",
        "ts", "value", "props")


def order_rows(raw: DataFrame) -> DataFrame:
    """Orders with their lifecycle; works on a batch or a stream."""
    return raw.selectExpr(
        "CAST(o_orderkey AS STRING) AS order_id", "concat('CUST_', o_custkey) AS customer_unique_id",
        """CASE WHEN o_orderstatus = 'F' AND o_orderkey % 20 = 0 THEN 'canceled'
                WHEN o_orderstatus = 'F' THEN 'delivered'
                WHEN o_orderstatus = 'O' AND o_orderkey % 2 = 0 THEN 'shipped'
                WHEN o_orderstatus = 'O' THEN 'invoiced'
                WHEN o_orderkey % 2 = 0 THEN 'created' ELSE 'approved' END AS order_status""",
        "o_orderdate + (o_orderkey % 24) * INTERVAL '1' HOUR AS order_purchase_timestamp",
        """CASE WHEN o_orderkey % 13 <> 0
                THEN o_orderdate + (o_orderkey % 24 + 2) * INTERVAL '1' HOUR END AS order_approved_at""",
        """CASE WHEN o_orderstatus <> 'P' THEN o_orderdate + (o_orderkey % 5 + 2) * INTERVAL '1' DAY
           END AS order_delivered_carrier_date""",
        """CASE WHEN o_orderstatus = 'F' THEN o_orderdate + (o_orderkey % 30 + 1) * INTERVAL '1' DAY
           END AS order_delivered_customer_date""",
        "o_orderdate + INTERVAL '20' DAY AS order_estimated_delivery_date")
