"""Queries A1 to A14, B19, G, K4 and K7: sources, sinks, keyed writes and reports."""

from datetime import datetime
from pyspark.sql import functions as F

from feira.functions import dates
from feira.operators import search, sets
from feira.plans import report
from feira.queries.catalog import catalogue
from feira.queries.events import LATEST, product_changes
from feira.queries.registry import query
from feira.queries.sales import monthly_sales
from feira.queries.views import AS_OF
from feira.session import scratch_path, stored
from feira.sources import files, rejects, tables

MOMENT = datetime(2001, 8, 2)
K = "CAST(order_id AS BIGINT)"


def source_orders(m):
    """Orders as the source files have them: a customer id per order and dates as text, some unreadable."""
    text = "CAST({} AS STRING)"
    return m.order.selectExpr(
        "order_id", "concat('OC_', order_id) AS customer_id", "order_status",
        text.format("order_purchase_timestamp") + " AS order_purchase_timestamp",
        f"CASE WHEN {K} % 7 = 0 THEN 'not a date' WHEN {K} % 11 = 0 THEN '2001-13-45 10:00:00' ELSE "
        + text.format("order_approved_at") + " END AS order_approved_at",
        text.format("order_delivered_carrier_date") + " AS order_delivered_carrier_date",
        text.format("order_delivered_customer_date") + " AS order_delivered_customer_date",
        text.format("order_estimated_delivery_date") + " AS order_estimated_delivery_date")


@query("a1_read_csv", f"""
SELECT order_id, concat('OC_', order_id) AS customer_id, order_status, order_purchase_timestamp,
       CASE WHEN {K} % 7 <> 0 AND {K} % 11 <> 0 THEN order_approved_at END AS order_approved_at,
       order_delivered_carrier_date, order_delivered_customer_date, order_estimated_delivery_date FROM d_order""")
def a1(m):
    folder = scratch_path(m.spark, "csv")
    files.write_source(source_orders(m), folder, "orders")
    return files.read_source(m.spark, folder, "orders")


@query("a1_read_reviews", """
SELECT review_id, order_id, score AS review_score, CASE WHEN score > 2 THEN 'a "title", with ' || chr(10) || ' a break' END AS review_comment_title,
       review_id || chr(13) || chr(10) || '"",' || chr(10) || chr(10) || ' end' AS review_comment_message,
       created_at AS review_creation_date, CAST(NULL AS TIMESTAMP) AS review_answer_timestamp FROM d_review""")
def a1_reviews(m):
    """Reviews with quotes, commas and line breaks come back as they were written."""
    folder = scratch_path(m.spark, "csv")
    title = F.when(F.col("score") > 2, F.lit('a "title", with \n a break'))
    rows = m.review.select(
        "review_id", "order_id", F.col("score").alias("review_score"), title.alias("review_comment_title"),
        F.concat("review_id", F.lit('\r\n"",\n\n end')).alias("review_comment_message"),
        F.col("created_at").alias("review_creation_date"), F.lit(None).cast("timestamp_ntz").alias("review_answer_timestamp"))
    files.write_source(rows, folder, "order_reviews")
    return files.read_source(m.spark, folder, "order_reviews")


@query("a1_rejected_lines", f"""
SELECT order_id, CASE {K} % 50 WHEN 9 THEN 'wrong number of fields' WHEN 11 THEN 'not of its type: payment_sequential, payment_value' ELSE 'loaded' END AS outcome,
       CASE WHEN {K} % 50 NOT IN (9, 11) THEN payment_value END AS payment_value, CASE WHEN {K} % 50 IN (9, 11) THEN CAST(2 AS INT) END AS tries FROM d_payment""")
def a1_rejected(m):
    """Payments with lines that do not fit: one kind is mended and loaded after all, the others wait."""
    path, kind = scratch_path(m.spark, "rejects"), F.expr(f"{K} % 50")
    rows = m.payment.select(
        "order_id", F.when(kind == 11, "one").otherwise(F.col("payment_sequential").cast("string")).alias("payment_sequential"), "payment_type",
        F.when(kind == 7, "x").otherwise(F.col("payment_installments").cast("string")).alias("payment_installments"),
        F.when(kind == 9, "1.00,surplus").when(kind == 11, "much").otherwise(F.col("payment_value").cast("string")).alias("payment_value"))
    rows.write.option("header", True).option("quote", "").csv(f"{path}/files/order_payments")
    rejects.load_source(m.spark, f"{path}/files", "order_payments", path)
    rejects.replay_rejected(m.spark, "order_payments", path, lambda line: F.regexp_replace(line, ",x,", ",1,"))
    loaded, waiting = rejects.read_loaded(m.spark, path), rejects.read_rejected(m.spark, path)
    return loaded.select("order_id", F.lit("loaded").alias("outcome"), "payment_value", F.lit(None).cast("int").alias("tries")).unionByName(
        waiting.select(F.split_part("line", F.lit(","), F.lit(1)).alias("order_id"), F.col("reason").alias("outcome"),
                       F.lit(None).cast("decimal(12,2)").alias("payment_value"), "tries"))


@query("a2_geolocation_points", """
SELECT geolocation_id, geolocation_lng AS lng, geolocation_lat AS lat FROM d_geolocation""")
def a2(m):
    placed = files.with_point(m.geolocation, "geolocation_lng", "geolocation_lat", "geolocation_point")
    return placed.select("geolocation_id", "geolocation_point.*")


VISITS = f"""SELECT concat('OC_', order_id) AS customer_id, customer_unique_id,
  CAST(1000 + ({K} * 37) % 99000 AS INT) AS customer_zip_code_prefix FROM d_order"""


def source_customers(m):
    """One customer row per order, with the zip of that order."""
    return m.order.selectExpr("concat('OC_', order_id) AS customer_id", "customer_unique_id",
                              f"CAST(1000 + ({K} * 37) % 99000 AS INT) AS customer_zip_code_prefix")


@query("a3_conformed_orders", f"""
SELECT 'order' AS kind, order_id AS id, customer_unique_id, CAST(NULL AS INT) AS zip FROM d_order
UNION ALL SELECT 'customer', customer_unique_id, customer_unique_id, arg_min(customer_zip_code_prefix, customer_id)
FROM ({VISITS}) v GROUP BY customer_unique_id""")
def a3(m):
    orders = m.order.select("order_id", F.concat(F.lit("OC_"), "order_id").alias("customer_id"))
    conformed, real = files.conform_orders(orders, source_customers(m))
    return conformed.select(
        F.lit("order").alias("kind"), F.col("order_id").alias("id"), "customer_unique_id",
        F.lit(None).cast("int").alias("zip")).unionByName(real.select(
            F.lit("customer").alias("kind"), F.col("customer_unique_id").alias("id"), "customer_unique_id",
            F.col("customer_zip_code_prefix").alias("zip")))


SOURCE_PRODUCTS = """SELECT concat('PROD_', CAST(p_partkey AS VARCHAR)) AS product_id,
  CASE WHEN p_partkey % 19 <> 0 THEN concat_ws('/', p_type, p_brand) END AS product_category_name, p_brand FROM part"""


@query("a4_category_dimension", f"""
SELECT p.product_id, d.category_id, d.category_name, CASE WHEN d.category_name NOT LIKE '%#1%' THEN lower(d.category_name) END AS english
FROM ({SOURCE_PRODUCTS}) p LEFT JOIN (
  SELECT product_category_name AS category_name, CAST(dense_rank() OVER (ORDER BY product_category_name) AS INT) AS category_id
  FROM (SELECT DISTINCT product_category_name FROM ({SOURCE_PRODUCTS}) s WHERE product_category_name IS NOT NULL) n) d
ON p.product_category_name = d.category_name""")
def a4(m):
    name = F.concat_ws("/", "p_type", "p_brand")
    products = m.raw("part").select(
        F.concat(F.lit("PROD_"), "p_partkey").alias("product_id"),
        F.when(F.col("p_partkey") % 19 != 0, name).alias("product_category_name"))
    translation = m.raw("part").where(~name.like("%#1%")).select(
        name.alias("product_category_name"), F.lower(name).alias("product_category_name_english")).distinct()
    dim, keyed = files.build_category_dim(products, translation)
    return keyed.join(dim, "category_id", "left").select(
        "product_id", "category_id", "category_name", F.col("category_name_english").alias("english"))


@query("a5_dimensions", "SELECT product_id, length_cm, height_cm, width_cm, weight_g FROM d_product")
def a5(m):
    return files.with_dimensions(m.product).select("product_id", "dimensions.*")


@query("a6_documents", """
SELECT review_id, review_type, order_id, score, created_at, CASE WHEN score < 3 THEN created_at + INTERVAL '1' DAY END AS responded_at,
       md5(review_id) AS _id FROM d_review""")
def a6(m):
    """Reviews written as extended JSON and read back."""
    def date(ts):
        iso = F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss'Z'")
        return F.when(ts.isNotNull(), F.create_map(F.lit("$date"), iso))

    response = F.when(F.col("score") < 3, F.struct(
        F.lit("thanks").alias("text"), date(F.col("created_at") + F.expr("INTERVAL '1' DAY")).alias("responded_at")))
    document = F.struct(
        F.create_map(F.lit("$oid"), F.md5("review_id")).alias("_id"), "review_id", "review_type", "order_id", "score",
        date(F.col("created_at")).alias("created_at"), response.alias("seller_response"))
    path = scratch_path(m.spark, "documents")
    m.review.select(F.to_json(document).alias("value")).write.text(path)
    read = files.read_documents(m.spark, path, "reviews")
    return read.select("review_id", "review_type", "order_id", "score", "created_at", "seller_response.responded_at", "_id")


@query("a7_insert_ignore", f"""
SELECT order_id, order_status FROM d_order WHERE {K} % 3 <> 0
UNION ALL SELECT order_id, 'a_first' FROM d_order WHERE {K} % 3 = 0""")
def a7(m):
    """Two thirds of the orders are stored; the batch holds every order twice."""
    slim = m.order.select("order_id", "order_status")
    batch = slim.withColumn("order_status", F.explode(F.array(F.lit("b_second"), F.lit("a_first"))))
    return sets.insert_ignore(slim.where(f"{K} % 3 <> 0"), batch, ["order_id"], ["order_status"])


@query("a8_upsert_latest", LATEST)
def a8(m):
    changes = product_changes(m.raw("part"))
    first = F.dayofmonth("source_updated_at") % 2 == 0
    target, batch = changes.where(first), changes.where(~first)
    once = sets.upsert_latest(target, batch, ["product_id"], ["source_updated_at"])
    return sets.upsert_latest(once, batch, ["product_id"], ["source_updated_at"])


BUCKET = f"""CASE WHEN order_purchase_timestamp >= TIMESTAMP '2001-09-01 00:00:00' THEN 'order_default'
  WHEN order_purchase_timestamp >= TIMESTAMP '2000-08-01 00:00:00' THEN strftime(order_purchase_timestamp, 'order_%Y_%m')
  ELSE strftime(order_purchase_timestamp, 'order_%Y') END"""


def stored_orders(m):
    path = scratch_path(m.spark, "orders")
    tables.write_orders(m.order, f"{path}/live", m.now)
    return path


@query("a9_partitioned_orders", f"SELECT order_id, order_status, {BUCKET} AS order_bucket FROM d_order")
def a9(m):
    return tables.read_orders(m.spark, f"{stored_orders(m)}/live").select("order_id", "order_status", "order_bucket")


@query("a10_order_buckets", f"""
SELECT {BUCKET} AS order_bucket, count(*) AS n, min(strftime(order_purchase_timestamp, 'order_%Y_%m')) AS first_month,
       max(date_trunc('month', order_purchase_timestamp) + INTERVAL '1' MONTH) AS last_end FROM d_order GROUP BY 1""")
def a10(m):
    ts = F.col("order_purchase_timestamp")
    _, end = dates.month_partition_bounds(F.year(ts), F.month(ts))
    return m.order.groupBy(tables.order_bucket(ts, m.now).alias("order_bucket")).agg(
        F.count("*").alias("n"), F.min(dates.month_partition_name(F.year(ts), F.month(ts))).alias("first_month"),
        F.max(end).alias("last_end"))


@query("a11_archived_orders", f"""
SELECT {BUCKET} AS order_bucket, order_purchase_timestamp < TIMESTAMP '1999-01-01 00:00:00' AS archived, count(*) AS n
FROM d_order GROUP BY 1, 2""")
def a11(m):
    path = stored_orders(m)
    moved = tables.archive_orders(m.spark, f"{path}/live", f"{path}/archive", MOMENT)
    both = tables.read_with_archive(m.spark, f"{path}/live", f"{path}/archive")
    return both.groupBy("order_bucket", F.col("order_bucket").isin(moved).alias("archived")).agg(F.count("*").alias("n"))


@query("a12_refreshed_summary", "SELECT * FROM d_sales")
def a12(m):
    path, key = scratch_path(m.spark, "summary"), ["category_id", "sales_month"]
    sales = stored(monthly_sales(m), "sales")
    tables.refresh_summary(sales.limit(1), path, key)
    tables.refresh_summary(sales, path, key)
    return tables.read_summary(m.spark, path)


@query("a13_extract_since", """
SELECT order_id, order_purchase_timestamp FROM d_order WHERE order_purchase_timestamp >= TIMESTAMP '2001-01-01 00:00:00'""")
def a13(m):
    changed = sets.extract_since(m.order, "order_purchase_timestamp", dates.instant("2001-01-01 00:00:00"))
    return changed.select("order_id", "order_purchase_timestamp")


# Base volumes to compare row counts with.
EXPECTED = {"customer": 96_000, "order": 99_000, "order_item": 113_000, "product": 33_000, "seller": 3_000,
            "payment": 104_000, "category": 71}


def count_sql(names):
    return " UNION ALL ".join(f"SELECT '{n}' AS tbl, count(*) AS n FROM d_{n}" for n in names)


@query("a14_table_counts", f"""
SELECT tbl, n, expected, n - expected AS difference FROM ({count_sql([*EXPECTED, 'review'])}) c LEFT JOIN (
  SELECT unnest({list(EXPECTED)}) AS name, CAST(unnest({list(EXPECTED.values())}) AS BIGINT) AS expected) e ON c.tbl = e.name""")
def a14(m):
    return sets.table_counts({n: getattr(m, n) for n in (*EXPECTED, "review")}, EXPECTED)


@query("b19_orders_in_month", """
SELECT order_id, order_status, customer_unique_id FROM d_order
WHERE order_purchase_timestamp >= TIMESTAMP '2001-07-01 00:00:00' AND order_purchase_timestamp < TIMESTAMP '2001-08-01 00:00:00'""")
def b19(m):
    """One month of the partitioned orders; other partitions are not read."""
    path = f"{stored_orders(m)}/live"
    found = tables.scan_orders(m.spark, path, datetime(2001, 7, 1), datetime(2001, 8, 1))
    return found.select("order_id", "order_status", "customer_unique_id")


@query("b19_orders_this_month", """
SELECT order_id FROM d_order WHERE order_purchase_timestamp >= TIMESTAMP '2001-08-01 00:00:00'
  AND order_purchase_timestamp < TIMESTAMP '2001-09-01 00:00:00'""")
def b19_now(m):
    return search.orders_in_month(m.order, m.now).select("order_id")


@query("g1_union_counts", count_sql(["order", "payment", "review", "event"]))
def g1(m):
    return sets.union_counts({"order": m.order, "payment": m.payment, "review": m.review, "event": m.session_event})


@query("g2_deduped_items", """
SELECT order_id, product_id, price FROM (
  SELECT *, row_number() OVER (PARTITION BY product_id ORDER BY price, order_id, order_item_id) AS r FROM d_order_item) t WHERE r = 1""")
def g2(m):
    return sets.dedupe(m.order_item, ["product_id"], ["price", "order_id", "order_item_id"]).select(
        "order_id", "product_id", "price")


@query("a8_catalog_documents", "SELECT product_id, CAST(1 AS BIGINT) AS n, TRUE AS agree FROM d_product")
def a8_documents(m):
    """Whole catalogue documents of one instant, applied in two orders: the same document stays."""
    from feira.queries.catalog import catalogue

    first = catalogue(m)
    second = first.withColumn("price_current", (F.col("price_current") + 1).cast(first.schema["price_current"].dataType))
    fold = [sets.upsert_latest(a, b, ["product_id"], ["source_updated_at"]).select("product_id", "price_current") for a, b in (
        (first, second), (second, first))]
    both = fold[0].unionByName(fold[1])
    return both.groupBy("product_id").agg(
        F.count_distinct("price_current").alias("n"), (F.min("price_current") == F.max("price_current")).alias("agree"))


@query("e3_latest_per_key", LATEST)
def e3(m):
    return sets.latest_per_key(product_changes(m.raw("part")), ["product_id"], ["source_updated_at"])


@query("k4_change_stamps", f"""
SELECT product_id, CASE WHEN p % 3 = 0 THEN base_price + 1 ELSE base_price END AS base_price,
       CASE WHEN p % 3 = 0 OR p % 5 = 0 THEN {AS_OF} ELSE TIMESTAMP '2000-01-01 00:00:00' END AS updated_at
FROM (SELECT *, CAST(substring(product_id, 6) AS BIGINT) AS p FROM d_product) t""".replace(
    "THEN base_price + 1 ELSE base_price END", "THEN CAST(base_price + 1 AS DECIMAL(12,2)) ELSE base_price END"))
def k4(m):
    """Every third product has a new price and every fifth is new."""
    number = F.substring("product_id", F.lit(6), F.lit(20)).cast("long")
    old = m.product.select("product_id", "name", "base_price", dates.instant("2000-01-01 00:00:00").alias("updated_at"))
    price = F.when(number % 3 == 0, (F.col("base_price") + 1).cast("decimal(12,2)")).otherwise(F.col("base_price"))
    stamped = sets.stamp_changes(old.where(number % 5 != 0), old.withColumn("base_price", price), ["product_id"], m.now)
    return stamped.select("product_id", "base_price", "updated_at")


FINDINGS = {
    "nulls_orders": "SELECT 1 FROM (SELECT count(order_approved_at) AS a, count(order_delivered_carrier_date) AS b, "
                    "count(order_delivered_customer_date) AS c, count(*) AS n FROM d_order) t, "
                    "LATERAL (SELECT unnest([a, b, c]) AS x) u WHERE x < n",
    "nulls_products": "SELECT 1 FROM (SELECT count(n_photos) AS a, count(*) AS n FROM d_product) t WHERE a < n",
    "out_of_range": "SELECT unnest(range(5))",
    "review_scores": "SELECT DISTINCT score FROM d_review",
    "payment_types": "SELECT DISTINCT payment_type FROM d_payment",
    "histogram_price": "SELECT unnest(range(80)) FROM (SELECT count(*) FROM d_order_item) t",
    "top_categories": "SELECT DISTINCT category_name FROM d_product LIMIT 10",
    "score_vs_delivery": "SELECT DISTINCT r.score FROM d_review r JOIN d_order o ON r.order_id = o.order_id "
                         "WHERE order_delivered_customer_date IS NOT NULL",
    "orders_by_month": "SELECT DISTINCT date_trunc('month', order_purchase_timestamp) FROM d_order",
    "orders_by_weekday": "SELECT DISTINCT dayname(order_purchase_timestamp) FROM d_order",
    "orders_by_hour": "SELECT DISTINCT hour(order_purchase_timestamp) FROM d_order",
    "cumulative_orders": "SELECT DISTINCT date_trunc('month', order_purchase_timestamp) FROM d_order LIMIT 10",
    "top_customer_states": "SELECT DISTINCT customer_state FROM d_customer LIMIT 15",
    "top_seller_states": "SELECT DISTINCT seller_state FROM d_seller LIMIT 15",
    "time_span": "SELECT count(*) FROM d_order",
    "outliers_price": "SELECT count(*) FROM d_order_item",
    "items_per_order": "SELECT count(*) FROM d_order_item",
}


@query("k7_eda_report", " UNION ALL ".join(
    f"SELECT '{name}' AS tbl, count(*) AS n FROM ({text}) t" for name, text in FINDINGS.items()))
def k7(m):
    """Number of lines of findings of the report."""
    found = report.eda_report({
        "customers": m.customer, "orders": m.order, "items": m.order_item, "payments": m.payment, "reviews": m.review,
        "products": m.product, "sellers": m.seller})
    return sets.union_counts({name: found[name] for name in FINDINGS})


@query("a12_published_catalog", """
SELECT product_id, price_current FROM d_priced""")
def a12_catalog(m):
    """The whole catalogue published as a summary table and read back."""
    path = scratch_path(m.spark, "published")
    tables.refresh_summary(catalogue(m).select("product_id", "price_current"), path, ["product_id"])
    return tables.read_summary(m.spark, path)
