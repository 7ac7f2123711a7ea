"""Queries J1 to J19: integrity rules over tables with seeded violations."""

from functools import partial

from pyspark.sql import functions as F

from feira.functions import collections as C
from feira.operators import quality as Q
from feira.queries.catalog import catalogue
from feira.queries.registry import query
from feira.queries.views import VIEWS
from feira.streaming import buckets

# The seeded tables: the same expressions feed both engines. Each sets a few rows wrong or NULL.
K = "CAST(order_id AS BIGINT)"
BAD_ORDER = {
    "order_id": "order_id",
    "customer_unique_id": f"CASE WHEN {K} % 79 = 0 THEN concat('CUST_X', order_id) ELSE customer_unique_id END",
    "order_status": f"CASE WHEN {K} % 101 = 0 THEN 'lost' WHEN {K} % 103 = 0 THEN NULL ELSE order_status END",
    "order_purchase_timestamp": "order_purchase_timestamp",
    "order_approved_at": f"CASE WHEN {K} % 97 = 0 THEN order_purchase_timestamp - INTERVAL '1' HOUR ELSE order_approved_at END",
    "order_delivered_carrier_date":
        f"CASE WHEN {K} % 89 = 0 THEN order_purchase_timestamp - INTERVAL '30' DAY ELSE order_delivered_carrier_date END",
    "order_delivered_customer_date": "order_delivered_customer_date",
    "order_estimated_delivery_date":
        f"CASE WHEN {K} % 83 = 0 THEN order_purchase_timestamp ELSE order_estimated_delivery_date END",
}
BAD_ITEM = {
    "order_id": f"CASE WHEN {K} % 211 = 0 THEN concat('X', order_id) ELSE order_id END",
    "order_item_id": f"CASE WHEN {K} % 223 = 0 THEN 1 ELSE order_item_id END",
    "product_id": f"CASE WHEN {K} % 227 = 0 THEN 'PROD_X' WHEN {K} % 229 = 0 THEN NULL ELSE product_id END",
    "seller_id": f"CASE WHEN {K} % 233 = 0 THEN 'SELL_X' ELSE seller_id END",
    "shipping_limit_date": "shipping_limit_date",
    "order_purchase_timestamp": "order_purchase_timestamp",
    "price": f"CASE WHEN {K} % 239 = 0 THEN -price ELSE price END",
    "freight_value": f"CASE WHEN {K} % 241 = 0 THEN -freight_value WHEN {K} % 251 = 0 THEN NULL ELSE freight_value END",
}
P = "CAST(substring(product_id, 6) AS BIGINT)"
BAD_PRODUCT = {
    "product_id": "product_id",
    "category_name": f"CASE WHEN {P} % 41 = 0 THEN 'GONE' ELSE category_name END",
    "name": f"CASE WHEN {P} % 43 = 0 THEN NULL ELSE name END",
    "length_cm": f"CASE WHEN {P} % 47 = 0 THEN -length_cm ELSE length_cm END",
    "height_cm": "height_cm",
    "width_cm": f"CASE WHEN {P} % 53 = 0 THEN NULL ELSE width_cm END",
    "weight_g": f"CASE WHEN {P} % 59 = 0 THEN -weight_g ELSE weight_g END",
    "base_price": f"CASE WHEN {P} % 61 = 0 THEN -base_price ELSE base_price END",
}
S = "CASE WHEN promotion_id LIKE 'SP%' THEN CAST(substring(promotion_id, 4) AS BIGINT) ELSE CAST(length(promotion_id) AS BIGINT) END"
BAD_PROMOTION = {
    "promotion_id": "promotion_id",
    "discount_percentage": f"CASE WHEN {S} % 7 = 0 THEN CAST(120 AS DECIMAL(5,2)) ELSE discount_percentage END",
    "discount_amount": f"CASE WHEN {S} % 11 = 0 THEN CAST(-1 AS DECIMAL(12,2)) ELSE discount_amount END",
    "period_lower": f"CASE WHEN {S} % 13 = 0 THEN NULL ELSE period_lower END",
    "period_upper": f"CASE WHEN {S} % 17 = 0 THEN period_lower ELSE period_upper END",
}
CU = "CAST(substring(customer_unique_id, 6) AS BIGINT)"
BAD_CUSTOMER = {
    "customer_unique_id": f"CASE WHEN {CU} % 67 = 0 THEN 'CUST_0' ELSE customer_unique_id END",
    "customer_zip_code_prefix": f"CASE WHEN {CU} % 29 = 0 THEN 99 ELSE customer_zip_code_prefix END",
    "customer_city": f"CASE WHEN {CU} % 31 = 0 THEN NULL ELSE customer_city END",
    "customer_state": f"CASE WHEN {CU} % 37 = 0 THEN lower(customer_state) WHEN {CU} % 41 = 0 THEN 'NAN' ELSE customer_state END",
}
BAD_PAYMENT = {
    "order_id": "order_id", "payment_sequential": "payment_sequential",
    "payment_type": f"CASE WHEN {K} % 71 = 0 THEN 'gold' ELSE payment_type END",
    "payment_installments": f"CASE WHEN {K} % 73 = 0 THEN 0 ELSE payment_installments END",
    "payment_value": f"CASE WHEN {K} % 107 = 0 THEN CAST(0 AS DECIMAL(12,2)) ELSE payment_value END",
}
R = "CAST(substring(review_id, 5) AS BIGINT)"
BAD_REVIEW = {
    "review_id": f"CASE WHEN {R} % 109 = 0 THEN 'REV_0' ELSE review_id END",
    "review_type": f"CASE WHEN {R} % 113 = 0 THEN 'shop' ELSE review_type END",
    "order_id": "order_id", "product_id": "product_id", "seller_id": "seller_id",
    "customer_unique_id": "customer_unique_id", "created_at": "created_at",
    "score": f"CASE WHEN {R} % 127 = 0 THEN 6 WHEN {R} % 131 = 0 THEN NULL ELSE score END",
}


def _seed(name: str, columns: dict[str, str], source: str) -> None:
    VIEWS[name] = "SELECT " + ", ".join(f"{text} AS {column}" for column, text in columns.items()) + f" FROM {source}"


VIEWS["d_stamped_item"] = ("SELECT i.*, o.order_purchase_timestamp FROM d_order_item i "
                           "JOIN d_order o ON i.order_id = o.order_id")
for _name, _columns, _source in (
        ("d_bad_order", BAD_ORDER, "d_order"), ("d_bad_item", BAD_ITEM, "d_stamped_item"),
        ("d_bad_product", BAD_PRODUCT, "d_product"), ("d_bad_promotion", BAD_PROMOTION, "d_promotion"),
        ("d_bad_customer", BAD_CUSTOMER, "d_customer"), ("d_bad_payment", BAD_PAYMENT, "d_payment"),
        ("d_bad_review", BAD_REVIEW, "d_review_doc")):
    _seed(_name, _columns, _source)


def seeded(df, columns):
    return df.selectExpr(*[f"{text} AS {name}" for name, text in columns.items()])


def bad_order(m):
    return seeded(m.order, BAD_ORDER)


def bad_item(m):
    return seeded(m.stamped_item, BAD_ITEM)


def bad_product(m):
    sizes = ["length_cm", "height_cm", "width_cm", "weight_g"]
    return seeded(m.product, BAD_PRODUCT).withColumn("dimensions", F.struct(*sizes)).drop(*sizes)


def bad_promotion(m):
    flat = m.promotion.select(
        "promotion_id", "discount_percentage", "discount_amount",
        F.col("promotion_period.lower").alias("period_lower"), F.col("promotion_period.upper").alias("period_upper"))
    return seeded(flat, BAD_PROMOTION).withColumn(
        "promotion_period", C.period(F.col("period_lower"), F.col("period_upper")))


def bad_customer(m):
    return seeded(m.customer, BAD_CUSTOMER)


def bad_payment(m):
    return seeded(m.payment, BAD_PAYMENT)


def bad_review(m):
    return seeded(m.review_doc, BAD_REVIEW)


def bad_history(m):
    """Status versions without the removal of repeats, so some lines repeat a status."""
    from feira.operators.timelines import with_previous

    linked = with_previous(m.order_history, ["order_id"], ["changed_at", "step"], ["order_status"],
                           F.col("changed_at").cast("date"))
    return linked.select("order_id", F.col("previous.order_status").alias("from_status"),
                         F.col("order_status").alias("to_status"))


VIEWS["d_bad_history"] = """SELECT order_id, order_status AS to_status,
  lag(order_status) OVER (PARTITION BY order_id ORDER BY changed_at, step) AS from_status FROM d_history"""


def checks(view: str, key: str, rules: dict[str, str]) -> str:
    return " UNION ALL ".join(
        f"SELECT '{name}' AS rule, count(*) FILTER (NOT ({test})) AS violations,"
        f" min(CASE WHEN NOT ({test}) THEN {key} END) AS sample_key FROM {view}" for name, test in rules.items())


def nulls(*columns: str) -> dict[str, str]:
    return {f"not_null_{c}": f"{c} IS NOT NULL" for c in columns}


def register(name, table, rules, key, view, sql_rules):
    """One query for the named rules of a table."""
    def run(m):
        chosen = rules()
        return Q.check_rules(table(m), {r: chosen[r] for r in sql_rules}, key)

    query(name, checks(view, key, sql_rules))(run)


for _query, _sql in (
        ("j1_estimated_after_purchase", {"estimated_after_purchase": "order_estimated_delivery_date > order_purchase_timestamp"}),
        ("j2_approved_after_purchase", {"approved_after_purchase": "order_approved_at IS NULL OR order_approved_at >= order_purchase_timestamp"}),
        ("j3_carrier_after_approved", {"carrier_after_approved": "order_delivered_carrier_date IS NULL OR order_approved_at IS NULL OR order_delivered_carrier_date >= order_approved_at"}),
        ("j4_customer_after_carrier", {"customer_after_carrier": "order_delivered_customer_date IS NULL OR order_delivered_carrier_date IS NULL OR order_delivered_customer_date >= order_delivered_carrier_date"}),
        ("j13_order_status", {"status_in_domain": "order_status IN ('created', 'approved', 'invoiced', 'shipped', 'delivered', 'canceled', 'returned', 'unavailable')"}),
        ("j14_order_not_null", nulls("order_id", "customer_unique_id", "order_status", "order_purchase_timestamp", "order_estimated_delivery_date"))):
    register(_query, bad_order, Q.order_rules, "order_id", "d_bad_order", _sql)

register("j5_shipping_after_purchase", bad_item, Q.item_rules, "order_id", "d_bad_item",
         {"shipping_after_purchase": "shipping_limit_date >= order_purchase_timestamp"})
register("j6_dimensions", bad_product, Q.product_rules, "product_id", "d_bad_product",
         {"dimensions_not_negative": "length_cm >= 0 AND height_cm >= 0 AND width_cm >= 0 AND weight_g >= 0"})
register("j7_promotion_period", bad_promotion, Q.promotion_rules, "promotion_id", "d_bad_promotion",
         {"period_not_empty": "NOT coalesce(period_lower >= period_upper, FALSE)",
          "period_bounded": "period_lower IS NOT NULL AND period_upper IS NOT NULL"})
register("j8_status_changes", bad_history, Q.history_rules, "order_id", "d_bad_history",
         {"status_changes": "from_status IS NULL OR from_status <> to_status"})
register("j9_state_code", bad_customer, partial(Q.address_rules, "customer"), "customer_unique_id", "d_bad_customer",
         {"state_code": "customer_state = upper(customer_state) AND length(customer_state) = 2"})
register("j10_zip_range", bad_customer, partial(Q.address_rules, "customer"), "customer_unique_id", "d_bad_customer",
         {"zip_in_range": "customer_zip_code_prefix BETWEEN 1000 AND 99999"})
register("j11_item_amounts", bad_item, Q.item_rules, "order_id", "d_bad_item",
         {"price_not_negative": "price >= 0", "freight_not_negative": "freight_value >= 0"})
register("j11_product_price", bad_product, Q.product_rules, "product_id", "d_bad_product",
         {"base_price_not_negative": "base_price >= 0"})
register("j11_payment_amounts", bad_payment, Q.payment_rules, "order_id", "d_bad_payment",
         {"value_positive": "payment_value > 0", "installments_at_least_one": "payment_installments >= 1"})
register("j12_discount_terms", bad_promotion, Q.promotion_rules, "promotion_id", "d_bad_promotion",
         {"percentage_in_range": "discount_percentage BETWEEN 0 AND 100", "amount_not_negative": "discount_amount >= 0",
          "one_kind_of_discount": "(discount_percentage IS NULL) <> (discount_amount IS NULL)"})
register("j13_payment_type", bad_payment, Q.payment_rules, "order_id", "d_bad_payment",
         {"type_in_domain": "payment_type IN ('credit_card', 'debit_card', 'boleto', 'voucher', 'pix', 'not_defined')"})
register("j14_address_not_null", bad_customer, partial(Q.address_rules, "customer"), "customer_unique_id", "d_bad_customer",
         nulls("customer_zip_code_prefix", "customer_city", "customer_state"))
register("j14_product_not_null", bad_product, Q.product_rules, "product_id", "d_bad_product",
         nulls("product_id", "name", "base_price"))
register("j18_review_documents", bad_review, Q.review_document_rules, "review_id", "d_bad_review",
         {**nulls("review_id", "order_id", "customer_unique_id", "created_at"),
          "score_in_range": "score IS NOT NULL AND score BETWEEN 1 AND 5",
          "type_in_domain": "coalesce(review_type IN ('product', 'seller'), FALSE)",
          "subject_named": "CASE review_type WHEN 'product' THEN product_id IS NOT NULL WHEN 'seller' THEN seller_id IS NOT NULL END"})


def repeats(rule: str, view: str, keys: list[str]) -> str:
    sample = "concat_ws('|', " + ", ".join(f"CAST({k} AS VARCHAR)" for k in keys) + ")"
    names = ", ".join(keys)
    return (f"SELECT '{rule}' AS rule, count(*) AS violations, min({sample}) AS sample_key FROM "
            f"(SELECT {names} FROM {view} GROUP BY {names} HAVING count(*) > 1) t")


@query("j15_unique_keys", " UNION ALL ".join([
    repeats("order_key", "d_bad_order", ["order_id"]),
    repeats("item_key", "d_bad_item", ["order_id", "order_item_id"]),
    repeats("payment_key", "d_bad_payment", ["order_id", "payment_sequential"]),
    repeats("customer_key", "d_bad_customer", ["customer_unique_id"])]))
def j15(m):
    return Q.union_reports(
        Q.unique_report(bad_order(m), "order_key", ["order_id"]),
        Q.unique_report(bad_item(m), "item_key", ["order_id", "order_item_id"]),
        Q.unique_report(bad_payment(m), "payment_key", ["order_id", "payment_sequential"]),
        Q.unique_report(bad_customer(m), "customer_key", ["customer_unique_id"]))


@query("j16_unique_category", repeats("category_name", "(SELECT DISTINCT p_type || '/' || p_brand AS path, p_type AS category_name FROM part) x", ["category_name"]))
def j16(m):
    """Names taken over from type/brand paths, so every type repeats."""
    paths = m.raw("part").select(F.concat_ws("/", "p_type", "p_brand").alias("path"),
                                 F.col("p_type").alias("category_name")).distinct()
    return Q.unique_report(paths, "category_name", ["category_name"])


def lost(rule: str, child: str, parent: str, on: str, sample: str, present: str) -> str:
    return (f"SELECT '{rule}' AS rule, count(*) AS violations, min({sample}) AS sample_key FROM {child} c "
            f"WHERE {present} AND NOT EXISTS (SELECT 1 FROM {parent} p WHERE {on})")


REFERENCES = " UNION ALL ".join([
    lost("order_customer", "d_bad_order", "d_customer", "p.customer_unique_id = c.customer_unique_id", "order_id",
         "c.customer_unique_id IS NOT NULL"),
    lost("item_order", "d_bad_item", "d_order",
         "p.order_id = c.order_id AND p.order_purchase_timestamp = c.order_purchase_timestamp", "order_id", "TRUE"),
    lost("item_product", "d_bad_item", "d_product", "p.product_id = c.product_id", "order_id", "c.product_id IS NOT NULL"),
    lost("item_seller", "d_bad_item", "d_seller", "p.seller_id = c.seller_id", "order_id", "TRUE"),
    lost("product_category", "d_bad_product", "d_category", "p.category_name = c.category_name", "product_id", "TRUE"),
    lost("payment_order", "d_bad_payment", "d_order", "p.order_id = c.order_id", "order_id", "TRUE")])


@query("j17_foreign_keys", REFERENCES)
def j17(m):
    items = bad_item(m)
    return Q.union_reports(
        Q.reference_report("order_customer", bad_order(m), m.customer, ["customer_unique_id"], "order_id"),
        Q.reference_report("item_order", items, m.order, ["order_id", "order_purchase_timestamp"], "order_id"),
        Q.reference_report("item_product", items, m.product, ["product_id"], "order_id"),
        Q.reference_report("item_seller", items, m.seller, ["seller_id"], "order_id"),
        Q.reference_report("product_category", bad_product(m), m.category, ["category_name"], "product_id"),
        Q.reference_report("payment_order", bad_payment(m), m.order, ["order_id"], "order_id"))


@query("c14_lost_items", """
SELECT order_id, order_item_id, product_id FROM d_bad_item c
WHERE product_id IS NOT NULL AND NOT EXISTS (SELECT 1 FROM d_product p WHERE p.product_id = c.product_id)""")
def c14(m):
    found = Q.foreign_key_violations(bad_item(m), m.product, ["product_id"])
    return found.select("order_id", "order_item_id", "product_id")


def broken_counts(counts: dict[str, str], rows: str, key: str) -> str:
    """Report of rules with the condition of the rows that break each."""
    return " UNION ALL ".join(
        f"SELECT '{rule}' AS rule, count(*) FILTER (WHERE {broken}) AS violations, min({key}) FILTER (WHERE {broken}) AS sample_key FROM {rows}"
        for rule, broken in counts.items())


SOLD = "product_id IN (SELECT product_id FROM d_order_item)"


@query("j18_catalog_documents", broken_counts({
    "not_null_product_id": "FALSE", "not_null_sku": "k % 7 = 0", "not_null_name": "k % 11 = 0", "not_null_base_price": "FALSE",
    "not_null_price_current": "FALSE", "not_null_synced_at": "k % 29 = 0", "not_null_source_updated_at": "FALSE", "category_named": "k % 13 = 0",
    "seller_located": "NOT sold", "rating_in_range": "k % 17 = 0 AND sold", "price_not_negative": "k % 19 = 0", "discount_in_range": "k % 23 = 0"},
    f"(SELECT product_id, CAST(substring(product_id, 6) AS BIGINT) AS k, {SOLD} AS sold FROM d_product)", "product_id"))
def j18_catalog(m):
    """Catalogue documents, some of them broken."""
    number = F.substring("product_id", F.lit(6), F.lit(20)).cast("long")

    def broken(name: str, divisor: int, value):
        return F.when(number % divisor == 0, value).otherwise(F.col(name))

    documents = catalogue(m)
    kinds = documents.schema
    rated = F.col("seller").withField("rating_avg", F.lit(9).cast(kinds["seller"].dataType["rating_avg"].dataType))
    return Q.check_rules(documents.withColumns({
        "sku": broken("sku", 7, None), "name": broken("name", 11, None), "synced_at": broken("synced_at", 29, None),
        "category": broken("category", 13, F.col("category").withField("name", F.lit(None).cast("string"))),
        "seller": F.when((number % 17 == 0) & F.col("seller").isNotNull(), rated).otherwise(F.col("seller")),
        "price_current": broken("price_current", 19, F.lit(-1).cast(kinds["price_current"].dataType)),
        "discount_percentage": broken("discount_percentage", 23, F.lit(150).cast("decimal(5,2)"))}), Q.catalog_document_rules(), "product_id")


@query("j18_event_documents", """
SELECT * FROM (VALUES ('not_null_session_id'), ('not_null_bucket_hour'), ('not_null_event_count'), ('not_null_events'),
  ('not_null_expires_at'), ('count_not_negative')) v(rule), (SELECT CAST(0 AS BIGINT) AS violations, CAST(NULL AS VARCHAR) AS sample_key) z
UNION ALL SELECT 'events_typed', count(DISTINCT session_id || CAST(date_trunc('hour', ts) AS VARCHAR)), min(session_id)
FROM d_event WHERE event_id % 97 = 0""")
def j18_events(m):
    untyped = m.session_event.withColumn("type", F.when(F.col("event_id") % 97 != 0, F.col("type")))
    return Q.check_rules(buckets.bucket_events(untyped), Q.bucket_document_rules(), "session_id")


@query("j18_session_documents", broken_counts({
    "not_null_session_id": "FALSE", "not_null_started_at": "k % 7 = 0", "not_null_last_activity_at": "k % 11 = 0", "not_null_expires_at": "k % 13 = 0",
    "activity_in_order": "k % 5 = 0 AND k % 7 <> 0 AND k % 11 <> 0"},
    "(SELECT DISTINCT session_id, CAST(substring(session_id, 6) AS BIGINT) AS k FROM d_event)", "session_id"))
def j18_sessions(m):
    """Session documents, some of them broken."""
    number = F.substring("session_id", F.lit(6), F.lit(20)).cast("long")
    late = F.col("last_activity_at") + F.expr("INTERVAL '1' SECOND")
    documents = buckets.user_sessions(m.session_event).withColumns({
        "started_at": F.when(number % 7 == 0, None).when(number % 5 == 0, late).otherwise(F.col("started_at")),
        "last_activity_at": F.when(number % 11 != 0, F.col("last_activity_at")), "expires_at": F.when(number % 13 != 0, F.col("expires_at"))})
    return Q.check_rules(documents, Q.session_document_rules(), "session_id")


@query("j19_unique_documents", " UNION ALL ".join([
    repeats("review_id", "d_bad_review", ["review_id"]), repeats("bucket", "d_bucket", ["session_id", "bucket_hour"]),
    repeats("catalog_product", "d_product", ["product_id"])]))
def j19(m):
    return Q.union_reports(
        Q.unique_report(bad_review(m), "review_id", ["review_id"]),
        Q.unique_report(buckets.bucket_events(m.session_event), "bucket", ["session_id", "bucket_hour"]),
        Q.unique_report(catalogue(m), "catalog_product", ["product_id"]))


@query("j_split_orders", """
SELECT order_id, CASE WHEN order_estimated_delivery_date <= order_purchase_timestamp
    OR order_approved_at < order_purchase_timestamp OR order_delivered_carrier_date < order_approved_at
    OR order_delivered_customer_date < order_delivered_carrier_date OR order_status IS NULL OR customer_unique_id IS NULL
    OR order_status NOT IN ('created', 'approved', 'invoiced', 'shipped', 'delivered', 'canceled', 'returned', 'unavailable')
  THEN 'rejected' ELSE 'valid' END AS outcome FROM d_bad_order""")
def j_split(m):
    valid, rejected = Q.split_valid(bad_order(m), Q.order_rules())
    return valid.select("order_id", F.lit("valid").alias("outcome")).unionByName(
        rejected.select("order_id", F.lit("rejected").alias("outcome")))
