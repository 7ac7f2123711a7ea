"""Queries over promotions, reviews and the product catalogue."""

from pyspark.sql import functions as F

from feira.functions import collections as C
from feira.operators import aggregates, joins, search
from feira.operators.sorting import top_k_per_group
from feira.plans import catalog, delivery, promotions
from feira.queries.registry import query
from feira.queries.turns import run_turns
from feira.queries.views import AS_OF
from feira.session import stored
from feira.streaming import sync


@query("c7_active_promotions", f"""
SELECT p.product_id, t.promotion_id FROM d_product p JOIN d_category c ON p.category_name = c.category_name
JOIN d_target t ON (t.target_kind = 'category' AND t.target_id = CAST(c.category_id AS VARCHAR))
                OR (t.target_kind = 'product' AND t.target_id = p.product_id)
WHERE t.period_lower <= {AS_OF} AND {AS_OF} < t.period_upper""")
def c7(m):
    return promotions.active_promotions(m.categorized_product, m.promotion, m.now).select("product_id", "promotion_id")


@query("c8_promotion_targets", "SELECT promotion_id, target_kind, target_id FROM d_target")
def c8(m):
    return promotions.promotion_targets(m.promotion).select("promotion_id", "target_kind", "target_id")


PRICE = """greatest(coalesce(CAST(i.price * (100 - t.discount_percentage) * CAST(0.01 AS DECIMAL(3,2)) AS DECIMAL(14,2)),
                    CAST(i.price - t.discount_amount AS DECIMAL(14,2))), CAST(0 AS DECIMAL(14,2)))"""


@query("c9_promotion_at_order", f"""
SELECT order_id, order_item_id, promotion_id, promotion_price FROM (
  SELECT i.order_id, i.order_item_id, t.promotion_id, {PRICE} AS promotion_price,
         row_number() OVER (PARTITION BY i.order_id, i.order_item_id ORDER BY {PRICE}, t.promotion_id) AS best
  FROM d_order_item i JOIN d_order o ON i.order_id = o.order_id JOIN d_product p ON i.product_id = p.product_id
  JOIN d_category c ON p.category_name = c.category_name
  JOIN d_target t ON ((t.target_kind = 'category' AND t.target_id = CAST(c.category_id AS VARCHAR))
                  OR (t.target_kind = 'product' AND t.target_id = i.product_id))
       AND t.period_lower <= o.order_purchase_timestamp AND o.order_purchase_timestamp < t.period_upper) x
WHERE best = 1""")
def c9(m):
    keys = m.product.select("product_id", "category_name").join(m.category, "category_name")
    items = m.stamped_item.join(keys.select("product_id", "category_id"), "product_id").select(
        "order_id", "order_item_id", "order_purchase_timestamp", "product_id", "category_id", "price")
    found = promotions.promotion_at_order(items, m.promotion)
    return found.select("order_id", "order_item_id", "promotion_id", "promotion_price")


@query("c10_orphan_reviews", """
SELECT r.review_id, r.order_id, o.order_id IS NULL AS order_missing
FROM d_review r LEFT JOIN d_order o ON r.order_id = o.order_id WHERE o.order_id IS NULL""")
def c10(m):
    found = joins.orphan_reviews(m.review_doc, m.order, m.product)
    return found.select("review_id", "order_id", "order_missing")


@query("c11_accepted_reviews", """
SELECT review_id, order_id, score FROM d_review r WHERE EXISTS (SELECT 1 FROM d_order o WHERE o.order_id = r.order_id)""")
def c11(m):
    return joins.accept_reviews(m.review, m.order).select("review_id", "order_id", "score")


@query("c12_category_paths", """
WITH RECURSIVE walk AS (
  SELECT category_id, category_id AS root_id, 0 AS depth, category_id AS path FROM d_taxonomy WHERE parent_category_id IS NULL
  UNION ALL SELECT t.category_id, w.root_id, w.depth + 1, w.path || ' > ' || t.category_id
  FROM d_taxonomy t JOIN walk w ON t.parent_category_id = w.category_id)
SELECT category_id, root_id, CAST(depth AS INT) AS depth, path, TRUE AS complete FROM walk""")
def c12(m):
    walked = joins.category_paths(m.taxonomy)
    return walked.withColumn("path", F.array_join("path", " > "))


@query("c13_orders_with_customer", """
SELECT o.order_id, c.customer_unique_id, c.customer_state FROM d_order o
JOIN d_customer c ON o.customer_unique_id = c.customer_unique_id""")
def c13(m):
    joined = joins.orders_with_customer(m.order, m.customer)
    return joined.select("order_id", "customer_unique_id", "customer_state")


@query("c13_delivered_with_review", """
SELECT o.order_id, r.review_id, r.score, o.order_delivered_customer_date FROM d_order o
JOIN d_review r ON o.order_id = r.order_id WHERE o.order_delivered_customer_date IS NOT NULL""")
def c13_reviews(m):
    return joins.delivered_with_review(m.order, m.review).select(
        "order_id", "review_id", "score", "order_delivered_customer_date")


@query("c13_item_flows", """
SELECT i.order_id, s.seller_state, c.customer_state FROM d_order_item i JOIN d_order o ON i.order_id = o.order_id
JOIN d_customer c ON o.customer_unique_id = c.customer_unique_id JOIN d_seller s ON i.seller_id = s.seller_id""")
def c13_flows(m):
    return joins.item_flows(m.order_item, m.order, m.customer, m.seller)


STARS = ", ".join(f"count(*) FILTER (score = {s}) AS score_{s}" for s in range(1, 6))
MEAN = "CAST(CAST(200 * sum(score) + count(*) AS BIGINT) // (2 * count(*)) AS DECIMAL(18,0))"


def rating_sql(key: str, where: str = "TRUE") -> str:
    return f"""
SELECT {key}, CAST({MEAN} / 100 AS DECIMAL(4,2)) AS rating_avg, count(*) AS n_reviews, {STARS}
FROM d_review_doc WHERE {key} IS NOT NULL AND {where} GROUP BY 1"""


@query("d9_product_ratings", rating_sql("product_id"))
def d9_product(m):
    return aggregates.ratings(m.review_doc, "product_id")


@query("d9_seller_ratings", rating_sql("seller_id"))
def d9_seller(m):
    return aggregates.ratings(m.review_doc, "seller_id")


@query("d9_incremental_ratings", rating_sql("product_id"))
def d9_incremental(m):
    """Reviews in three batches, each added up for itself and merged when read."""
    reviews = stored(m.review_doc.select("product_id", "score", F.pmod(F.xxhash64("review_id"), F.lit(3)).alias("turn")), "reviews")
    turns = (reviews.where(F.col("turn") == turn).drop("turn") for turn in range(3))
    path = run_turns(m.spark, turns, "ratings", lambda stream, log, checkpoint: sync.stream_ratings(stream, "product_id", log, checkpoint))
    return sync.read_ratings(m.spark, path, "product_id")


@query("d10_seller_performance", """
WITH perf_volume AS (SELECT seller_id, count(*) AS n_items, CAST(sum(price) AS DECIMAL(18,2)) AS revenue FROM d_order_item GROUP BY 1),
perf_times AS (
  SELECT seller_id, n_orders, CAST(CAST(sign(s) * ((200 * abs(s) + 86400 * n) // (2 * 86400 * n)) AS DECIMAL(18,0)) / 100
         AS DECIMAL(10,2)) AS avg_delivery_days
  FROM (SELECT i.seller_id, count(*) AS n_orders, count(o.order_delivered_customer_date) AS n,
               CAST(sum(date_diff('second', o.order_purchase_timestamp, o.order_delivered_customer_date)) AS BIGINT) AS s
        FROM (SELECT DISTINCT order_id, seller_id FROM d_order_item) i JOIN d_order o ON i.order_id = o.order_id
        GROUP BY 1) t),
perf_scores AS (""" + rating_sql("seller_id") + """)
SELECT v.seller_id, n_items, revenue, n_orders, avg_delivery_days, rating_avg, n_reviews
FROM perf_volume v LEFT JOIN perf_times t ON v.seller_id = t.seller_id LEFT JOIN perf_scores r ON v.seller_id = r.seller_id""")
def d10(m):
    return catalog.seller_performance(m.order, m.order_item, m.review_doc)


def catalogue(m):
    return catalog.product_catalog(
        m.categorized_product, m.category, m.seller_geo, m.order_item, m.promotion, m.review_doc, m.now)


MAIN = """(SELECT product_id, seller_id FROM (
  SELECT product_id, seller_id, row_number() OVER (PARTITION BY product_id ORDER BY count(*) DESC, seller_id) AS r
  FROM d_order_item GROUP BY product_id, seller_id) q WHERE r = 1)"""
CATALOG = f"""
SELECT p.product_id, p.name, c.category_id, c.category_name, c.category_name_english, s.seller_id, s.seller_city,
       s.seller_state, sr.rating_avg AS seller_rating, coalesce(sr.n_reviews, 0) AS seller_reviews,
       json_extract_string(p.product_specifications, '$.brand') AS brand,
       concat_ws(',', p.tag_1, p.tag_2, p.tag_3) AS tags, p.weight_g, p.base_price, x.price_current, x.has_active_promotion,
       x.discount_percentage, x.promotion_id, x.valid_until, pr.rating_avg, coalesce(pr.n_reviews, 0) AS n_reviews,
       coalesce(pr.score_5, 0) AS five_stars, s.lng, s.lat
FROM d_product p JOIN d_category c ON p.category_name = c.category_name JOIN d_priced x ON p.product_id = x.product_id
LEFT JOIN {MAIN} main ON p.product_id = main.product_id LEFT JOIN d_seller s ON main.seller_id = s.seller_id
LEFT JOIN ({rating_sql('product_id', "review_type = 'product'")}) pr ON p.product_id = pr.product_id
LEFT JOIN ({rating_sql('seller_id', "review_type = 'seller'")}) sr ON s.seller_id = sr.seller_id"""


@query("k1_product_catalog", f"SELECT * EXCLUDE (lng, lat) FROM ({CATALOG}) t")
def k1(m):
    return flat_documents(catalogue(m))


def flat_documents(documents):
    """Documents with the columns of ``CATALOG``, without the place of the seller."""
    return documents.select(
        "product_id", "name", F.col("category.id").alias("category_id"), F.col("category.name").alias("category_name"),
        F.col("category.name_english").alias("category_name_english"), F.col("seller.id").alias("seller_id"),
        F.col("seller.city").alias("seller_city"), F.col("seller.state").alias("seller_state"),
        F.col("seller.rating_avg").alias("seller_rating"),
        F.coalesce("seller.n_reviews", F.lit(0)).alias("seller_reviews"),
        F.try_variant_get("specifications", "$.brand", "string").alias("brand"),
        F.array_join("tags", ",").alias("tags"), "dimensions.weight_g", "base_price", "price_current",
        "has_active_promotion", "discount_percentage", "active_promotion.promotion_id", "active_promotion.valid_until",
        F.col("rating.avg").alias("rating_avg"), F.col("rating.count").alias("n_reviews"),
        F.element_at("rating.distribution", "5").alias("five_stars"))


@query("k2_effective_price", "SELECT * FROM d_priced")
def k2(m):
    return promotions.effective_price(m.categorized_product, m.promotion, m.now).drop("promotion_name")


@query("b21_catalog_filter", f"""
SELECT product_id, price_current FROM ({CATALOG}) t
WHERE category_name = 'ECONOMY' AND price_current >= 700 AND price_current <= 1000 AND list_contains(string_split(tags, ','), 'normal')
  AND 2 * 6371.0 * asin(sqrt(pow(sin((radians(-15.0) - radians(lat)) / 2), 2)
      + cos(radians(lat)) * cos(radians(-15.0)) * pow(sin(radians(-50.0 - lng) / 2), 2))) <= 1500""")
def b21(m):
    found = search.catalog_filter(
        catalogue(m), category="ECONOMY", price=(700, 1000), tag="normal", near=(-50.0, -15.0, 1500))
    return found.select("product_id", "price_current")


@query("b22_promoted", f"""
SELECT product_id, name, price_current, discount_percentage FROM ({CATALOG}) t WHERE has_active_promotion""")
def b22(m):
    return search.promoted(catalogue(m))


@query("b23_reviews_of_product", """
SELECT review_id, score, created_at FROM d_review_doc WHERE product_id = 'PROD_101'""")
def b23(m):
    return search.reviews_for(m.review_doc, "PROD_101").select("review_id", "score", "created_at")


@query("b23_best_reviews_per_product", """
SELECT product_id, review_id, score, CAST(r AS INT) AS rank FROM (
  SELECT *, row_number() OVER (PARTITION BY product_id ORDER BY score DESC, review_id) AS r
  FROM d_review_doc WHERE product_id IS NOT NULL) t WHERE r <= 3""")
def b23_best(m):
    named = m.review_doc.where(F.col("product_id").isNotNull())
    best = top_k_per_group(named, ["product_id"], [F.desc("score"), F.asc("review_id")], 3)
    return best.select("product_id", "review_id", "score", "rank")


AUDIT = """SELECT i.seller_id, date_trunc('month', o.order_purchase_timestamp) AS m,
  o.order_delivered_carrier_date > i.shipping_limit_date AS ship, o.order_delivered_customer_date > o.order_estimated_delivery_date AS recv
FROM d_order_item i JOIN d_order o ON i.order_id = o.order_id"""


@query("k6_delivery_audit", f"""
SELECT seller_id, CAST(m AS DATE) AS month, count(*) AS n_items, count(*) FILTER (ship) AS n_late_shipments,
       round(count(*) FILTER (ship) / CAST(nullif(count(ship), 0) AS DOUBLE), 4) AS late_shipment_rate,
       count(*) FILTER (recv) AS n_late_deliveries,
       round(count(*) FILTER (recv) / CAST(nullif(count(recv), 0) AS DOUBLE), 4) AS late_delivery_rate
FROM ({AUDIT}) t GROUP BY 1, 2""")
def k6(m):
    return delivery.delivery_audit(m.order, m.order_item)


@query("k6_late_orders", """
SELECT order_id, order_delivered_customer_date FROM d_order
WHERE order_delivered_customer_date > order_estimated_delivery_date""")
def k6_orders(m):
    return delivery.late_orders(m.order).select("order_id", "order_delivered_customer_date")


@query("h17_period_bounds", """
SELECT promotion_id, period_lower, period_upper, period_lower >= period_upper AS is_empty FROM d_promotion""")
def h17(m):
    period = F.col("promotion_period")
    return m.promotion.select(
        "promotion_id", period["lower"].alias("period_lower"), period["upper"].alias("period_upper"),
        C.period_is_empty(period).alias("is_empty"))
