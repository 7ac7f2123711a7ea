"""Queries D11 to D28, E and F: exploratory statistics, windows and heads."""

from pyspark.sql import functions as F

from feira.operators import aggregates, sorting, statistics, timelines
from feira.queries.registry import query

DAILY = ", ".join(f"count(*) FILTER (type = '{k}') AS n_{k}" for k in ("page_view", "search", "add_to_cart", "order_completed"))


@query("d11_user_behavior_daily", f"""
SELECT CAST(ts AS DATE) AS day, count(*) AS n_events, count(DISTINCT customer_unique_id) AS n_users,
       count(DISTINCT CASE WHEN type = 'order_completed' THEN customer_unique_id END) AS n_buyers, {DAILY},
       round(count(DISTINCT CASE WHEN type = 'order_completed' THEN customer_unique_id END)
             / CAST(count(DISTINCT customer_unique_id) AS DOUBLE), 4) AS conversion
FROM d_event GROUP BY 1""")
def d11(m):
    return aggregates.user_behavior_daily(m.session_event)


@query("d13_payments_by_type", """
SELECT payment_type, count(*) AS n_payments, CAST(sum(payment_value) AS DECIMAL(18,2)) AS paid,
       max(payment_installments) AS max_installments FROM d_payment GROUP BY 1""")
def d13(m):
    return aggregates.payments_by_type(m.payment)


def split_payments(m):
    """Payments with a second part for every fourth order, so orders differ in their number of payments."""
    second = m.payment.where("CAST(order_id AS BIGINT) % 4 = 0").withColumn("payment_sequential", F.lit(2))
    return m.payment.unionByName(second)


@query("d13_payments_per_order", """
SELECT n_payments, count(*) AS n_orders FROM (SELECT order_id, count(*) AS n_payments FROM (
  SELECT order_id FROM d_payment UNION ALL SELECT order_id FROM d_payment WHERE CAST(order_id AS BIGINT) % 4 = 0) p
  GROUP BY 1) t GROUP BY 1""")
def d13_split(m):
    return aggregates.payments_per_order(split_payments(m))


@query("d14_sales_by_product", """
SELECT product_id, count(*) AS n_items, CAST(sum(price) AS DECIMAL(18,2)) AS revenue,
       CAST(sum(freight_value) AS DECIMAL(18,2)) AS freight FROM d_order_item GROUP BY 1""")
def d14_product(m):
    return aggregates.sales_by(m.order_item, "product_id")


@query("d14_sales_by_seller", """
SELECT seller_id, count(*) AS n_items, CAST(sum(price) AS DECIMAL(18,2)) AS revenue,
       CAST(sum(freight_value) AS DECIMAL(18,2)) AS freight FROM d_order_item GROUP BY 1""")
def d14_seller(m):
    return aggregates.sales_by(m.order_item, "seller_id")


def sizes(table: str, key: str) -> str:
    return f"""
SELECT count(*) AS n_groups, round_even(avg(size), 2) AS mean, round_even(stddev_samp(size), 2) AS std, min(size) AS min,
       quantile_cont(CAST(size AS DOUBLE), 0.25) AS q1, quantile_cont(CAST(size AS DOUBLE), 0.5) AS median,
       quantile_cont(CAST(size AS DOUBLE), 0.75) AS q3, max(size) AS max, count(*) FILTER (size = 1) AS n_single,
       round_even(count(*) FILTER (size = 1) / CAST(count(*) AS DOUBLE) * 100, 1) AS pct_single,
       count(*) FILTER (size >= 2) AS n_2_or_more, count(*) FILTER (size >= 5) AS n_5_or_more,
       count(*) FILTER (size > 5) AS n_over_5, count(*) FILTER (size > 10) AS n_over_10
FROM (SELECT {key}, count(*) AS size FROM {table} GROUP BY 1) t"""


@query("d15_items_per_order", sizes("d_order_item", "order_id"))
def d15_items(m):
    return statistics.group_size_summary(m.order_item, "order_id")


@query("d15_orders_per_customer", sizes("d_order", "customer_unique_id"))
def d15_orders(m):
    return statistics.group_size_summary(m.order, "customer_unique_id")


@query("d15_reviews_per_order", sizes("d_review", "order_id"))
def d15_reviews(m):
    return statistics.group_size_summary(m.review, "order_id")


@query("d15_size_counts", """
SELECT size, count(*) AS n_groups FROM (SELECT order_id, count(*) AS size FROM d_order_item GROUP BY 1) t GROUP BY 1""")
def d15_counts(m):
    return statistics.size_counts(m.order_item, "order_id")


@query("d16_payment_type_share", """
SELECT payment_type, count(*) AS n, round_even(count(*) / CAST(sum(count(*)) OVER () AS DOUBLE) * 100, 2) AS pct
FROM d_payment GROUP BY 1""")
def d16(m):
    return aggregates.value_shares(m.payment, "payment_type")


@query("d16_score_counts", "SELECT score, count(*) AS n FROM d_review GROUP BY 1")
def d16_scores(m):
    return aggregates.value_counts(m.review, "score")


ORDER_COLUMNS = ["order_id", "customer_unique_id", "order_status", "order_purchase_timestamp", "order_approved_at",
                 "order_delivered_carrier_date", "order_delivered_customer_date", "order_estimated_delivery_date"]


def nulls(table: str, columns: list[str]) -> str:
    parts = " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", round_even(count(*) FILTER ({c} IS NULL) / CAST(count(*) AS DOUBLE) * 100, 2) AS null_pct"
        f" FROM {table}" for c in columns)
    return f"SELECT * FROM ({parts}) t WHERE null_pct > 0"


@query("d17_order_nulls", nulls("d_order", ORDER_COLUMNS))
def d17(m):
    return statistics.null_report(m.order)


@query("d17_product_nulls", nulls("d_product", ["product_id", "n_photos", "base_price"]))
def d17_product(m):
    return statistics.null_report(m.product)


@query("d18_key_report", """
SELECT CAST(sum(n) AS BIGINT) AS n_rows, count(*) AS n_unique, CAST(sum(n - 1) AS BIGINT) AS n_duplicate
FROM (SELECT order_id, product_id, count(*) AS n FROM d_order_item GROUP BY 1, 2) t""")
def d18(m):
    return statistics.key_report(m.order_item, ["order_id", "product_id"])


@query("d19_orders_per_real_customer", """
SELECT count(DISTINCT order_id) AS n_many, count(DISTINCT customer_unique_id) AS n_few,
       round(count(DISTINCT order_id) / CAST(count(DISTINCT customer_unique_id) AS DOUBLE), 3) AS ratio FROM d_order""")
def d19(m):
    return aggregates.distinct_ratio(m.order, "order_id", "customer_unique_id")


@query("d20_range_report", """
SELECT 'negative_price' AS "check", count(*) FILTER (price < 0) AS n FROM d_order_item
UNION ALL SELECT 'negative_freight', count(*) FILTER (freight_value < 0) FROM d_order_item
UNION ALL SELECT 'negative_payment', count(*) FILTER (payment_value < 0) FROM d_payment
UNION ALL SELECT 'score_out_of_range', count(*) FILTER (NOT score BETWEEN 1 AND 5) FROM d_review
UNION ALL SELECT 'delivered_before_purchase',
  count(*) FILTER (order_delivered_customer_date < order_purchase_timestamp) FROM d_order""")
def d20(m):
    return statistics.range_report(m.order_item, m.payment, m.review, m.order)


def iqr(table: str, column: str) -> str:
    v = f"CAST({column} AS DOUBLE)"
    return f"""
SELECT '{column}' AS variable, round(q1, 6) AS q1, round(median, 6) AS median, round(q3, 6) AS q3, round(q3 - q1, 6) AS iqr,
       round(q1 - 1.5 * (q3 - q1), 6) AS lower_bound, round(q3 + 1.5 * (q3 - q1), 6) AS upper_bound,
       count(*) FILTER ({v} < q1 - 1.5 * (q3 - q1) OR {v} > q3 + 1.5 * (q3 - q1)) AS outliers,
       round(count(*) FILTER ({v} < q1 - 1.5 * (q3 - q1) OR {v} > q3 + 1.5 * (q3 - q1)) / CAST(count(*) AS DOUBLE) * 100, 4)
           AS outliers_pct
FROM {table}, (SELECT quantile_cont({v}, 0.25) AS q1, quantile_cont({v}, 0.5) AS median, quantile_cont({v}, 0.75) AS q3
               FROM {table}) q GROUP BY q1, median, q3"""


for _table, _column in (("order_item", "price"), ("order_item", "freight_value"), ("payment", "payment_value"),
                        ("payment", "payment_installments")):
    query(f"d21_iqr_{_column}", iqr(f"d_{_table}", _column))(
        lambda m, table=_table, column=_column: statistics.iqr_outliers(getattr(m, table), column))


@query("d21_iqr_event_value", iqr("d_event", "value"))
def d21_events(m):
    return statistics.iqr_outliers(m.session_event, "value")


def bins(table: str, column: str, n: int) -> str:
    v = f"CAST({column} AS DOUBLE)"
    return f"""
SELECT CAST(b.bin AS INT) AS bin, round(lo + (b.bin - 1) * ((hi - lo) / {n}.0), 6) AS bin_start, coalesce(n, 0) AS n
FROM (SELECT unnest(range(1, {n + 1})) AS bin) b
CROSS JOIN (SELECT min({v}) AS lo, max({v}) AS hi FROM {table}) s
LEFT JOIN (SELECT least(floor(({v} - lo) / ((hi - lo) / CAST({n} AS DOUBLE))) + 1, {n}) AS bin, count(*) AS n
           FROM {table}, (SELECT min({v}) AS lo, max({v}) AS hi FROM {table}) s GROUP BY 1) c ON b.bin = c.bin"""


for _table, _column, _bins in (("order_item", "price", 80), ("order_item", "freight_value", 60),
                               ("payment", "payment_installments", 24)):
    query(f"d22_histogram_{_column}", bins(f"d_{_table}", _column, _bins))(
        lambda m, table=_table, column=_column, n=_bins: statistics.histogram(getattr(m, table), column, n))


@query("d23_category_coverage", """
SELECT count(DISTINCT kind) AS n_categories, count(*) FILTER (kind IS NULL) AS n_uncategorized
FROM (SELECT CASE WHEN n_photos IS NOT NULL THEN category_name END AS kind FROM d_product) t""")
def d23(m):
    known = F.when(F.col("n_photos").isNotNull(), F.col("category_name"))
    return aggregates.category_coverage(m.product.select(known.alias("kind")), "kind")


@query("d23_top_categories", "SELECT category_name, count(*) AS n FROM d_product GROUP BY 1 ORDER BY n DESC, 1 LIMIT 10")
def d23_top(m):
    return statistics.top_value_counts(m.product, "category_name", 10)


@query("d24_score_vs_delivery", """
SELECT score, round_even(CAST(sum(days) AS DOUBLE) / count(*), 2) AS mean_days,
       round_even(quantile_cont(CAST(days AS DOUBLE), 0.5), 2) AS median_days, count(*) AS n_reviews
FROM (SELECT r.score, CAST(floor(date_diff('second', o.order_purchase_timestamp, o.order_delivered_customer_date) / 86400.0) AS BIGINT) AS days
      FROM d_order o JOIN d_review r ON o.order_id = r.order_id WHERE o.order_delivered_customer_date IS NOT NULL) t GROUP BY 1""")
def d24(m):
    return statistics.score_vs_delivery(m.order, m.review)


@query("d25_orders_by_month", """
SELECT strftime(order_purchase_timestamp, '%Y-%m') AS month, count(*) AS n_orders FROM d_order GROUP BY 1""")
def d25_month(m):
    return aggregates.time_counts(m.order, "month")


@query("d25_orders_by_weekday", "SELECT dayname(order_purchase_timestamp) AS weekday, count(*) AS n_orders FROM d_order GROUP BY 1")
def d25_weekday(m):
    return aggregates.time_counts(m.order, "weekday")


@query("d25_orders_by_hour", "SELECT CAST(hour(order_purchase_timestamp) AS INT) AS hour, count(*) AS n_orders FROM d_order GROUP BY 1")
def d25_hour(m):
    return aggregates.time_counts(m.order, "hour")


@query("d26_customer_state_share", """
SELECT count(*) FILTER (customer_state = 'NC') AS n,
       round_even(count(*) FILTER (customer_state = 'NC') / CAST(count(*) AS DOUBLE) * 100, 1) AS pct FROM d_customer""")
def d26(m):
    return statistics.state_share(m.customer, "customer_state", "NC")


@query("d26_top_seller_states", "SELECT seller_state, count(*) AS n FROM d_seller GROUP BY 1 ORDER BY n DESC, 1 LIMIT 15")
def d26_top(m):
    return statistics.top_value_counts(m.seller, "seller_state", 15)


FLOWS = """WITH flow AS (SELECT s.seller_state, c.customer_state, count(*) AS n_items
  FROM d_order_item i JOIN d_order o ON i.order_id = o.order_id JOIN d_customer c ON o.customer_unique_id = c.customer_unique_id
  JOIN d_seller s ON i.seller_id = s.seller_id GROUP BY 1, 2),
origin AS (SELECT seller_state, sum(n_items) AS total FROM flow GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 8),
target AS (SELECT customer_state, sum(n_items) AS total FROM flow GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 8)
"""


@query("d27_origin_destination", FLOWS + """
SELECT g.seller_state, g.customer_state, coalesce(f.n_items, 0) AS n_items
FROM (SELECT seller_state, customer_state FROM origin CROSS JOIN target) g
LEFT JOIN flow f ON f.seller_state = g.seller_state AND f.customer_state = g.customer_state""")
def d27(m):
    return statistics.origin_destination(m.order, m.order_item, m.customer, m.seller)


@query("d28_time_span", """
SELECT min(order_purchase_timestamp) AS first_at, max(order_purchase_timestamp) AS last_at, count(*) AS n_orders FROM d_order""")
def d28(m):
    return aggregates.time_span(m.order)


@query("e1_cumulative_orders", """
SELECT month, n_orders, CAST(sum(n_orders) OVER (ORDER BY month) AS BIGINT) AS n_cumulative FROM (
  SELECT CAST(date_trunc('month', order_purchase_timestamp) AS DATE) AS month, count(*) AS n_orders FROM d_order GROUP BY 1) t
ORDER BY month DESC LIMIT 10""")
def e1(m):
    return timelines.cumulative_orders(m.order)


TRANSITIONS = """
WITH log AS (SELECT order_id, order_purchase_timestamp, from_status, order_status AS to_status, changed_at, step FROM (
  SELECT *, lag(order_status) OVER (PARTITION BY order_id ORDER BY changed_at, step) AS from_status FROM d_history) t
  WHERE from_status IS DISTINCT FROM order_status)
"""


@query("e4_status_transitions", TRANSITIONS + "SELECT * FROM log")
def e4(m):
    return timelines.status_transitions(m.order_history)


@query("e2_time_in_status", TRANSITIONS + """
SELECT status, count(*) AS n, count(s) AS n_left, round(CAST(sum(s) AS DOUBLE) / count(s) / 3600, 3) AS mean_hours FROM (
  SELECT to_status AS status, date_diff('second', changed_at, lead(changed_at) OVER (PARTITION BY order_id ORDER BY changed_at, step)) AS s
  FROM log) t GROUP BY 1""")
def e2(m):
    return timelines.mean_time_in_status(timelines.status_transitions(m.order_history))


@query("f1_top_orders", """
SELECT order_id, payment_value FROM d_payment ORDER BY payment_value DESC NULLS LAST, order_id LIMIT 10""")
def f1(m):
    return sorting.top_k(m.payment, [F.desc_nulls_last("payment_value")], "order_id", 10).select("order_id", "payment_value")


@query("f1_top_items_per_seller", """
SELECT seller_id, order_id, order_item_id, price, CAST(r AS INT) AS rank FROM (
  SELECT *, row_number() OVER (PARTITION BY seller_id ORDER BY price DESC, order_id, order_item_id) AS r FROM d_order_item) t
WHERE r <= 3""")
def f1_groups(m):
    ranked = sorting.top_k_per_group(
        m.order_item, ["seller_id"], [F.desc("price"), F.asc("order_id"), F.asc("order_item_id")], 3)
    return ranked.select("seller_id", "order_id", "order_item_id", "price", "rank")


@query("f3_largest_seller_states", FLOWS + "SELECT seller_state, CAST(total AS BIGINT) AS total FROM origin")
def f3(m):
    from feira.operators.joins import item_flows

    flows = item_flows(m.order_item, m.order, m.customer, m.seller).groupBy("seller_state", "customer_state").agg(
        F.count("*").alias("n_items"))
    return sorting.largest_margins(flows, "seller_state", "n_items", 8)
