"""Queries D1 to D7: monthly sales and customer segments."""

from feira.operators import joins
from feira.plans import sales
from feira.queries.registry import query
from feira.queries.views import AS_OF


def monthly_sales(m):
    return sales.sales_by_category_month(m.order, m.order_item, m.product, m.category, "category_name")


def segments(m, **thresholds):
    return sales.customer_segments(m.order, m.order_item, m.customer, m.now, **thresholds)


@query("d1_sales_by_category_month", "SELECT * FROM d_sales")
def d1(m):
    return monthly_sales(m)


@query("d2_customer_orders", "SELECT * FROM d_customer_orders")
def d2(m):
    return sales.customer_orders(m.order)


@query("d3_customer_revenue", "SELECT * FROM d_customer_revenue")
def d3(m):
    return sales.customer_revenue(m.order, m.order_item)


@query("d4_customer_segments", "SELECT * FROM d_segments")
def d4(m):
    return segments(m)


@query("d4_segments_high_value", """
SELECT customer_unique_id, lifetime_value,
       CASE WHEN n_orders >= 5 AND lifetime_value > 1200000 THEN 'VIP' WHEN n_orders >= 2 THEN 'Recurrente'
            WHEN days_since_last_order > 365 THEN 'Inactivo' ELSE 'Nuevo' END AS segment
FROM d_segments""")
def d4_high(m):
    return segments(m, vip_value=1_200_000).select("customer_unique_id", "lifetime_value", "segment")


@query("d5_top_categories", f"""
SELECT category_name_english, CAST(sum(gross_revenue) AS DECIMAL(14,2)) AS revenue_12m,
       CAST(sum(n_orders) AS BIGINT) AS orders_12m
FROM d_sales WHERE sales_month >= date_trunc('month', {AS_OF}) - INTERVAL '12' MONTH
GROUP BY 1 ORDER BY revenue_12m DESC NULLS FIRST, 1 LIMIT 5""")
def d5(m):
    return sales.top_categories(monthly_sales(m), m.now)


@query("d6_vip_by_state", """
SELECT customer_state, count(*) AS n_vip, CAST(sum(lifetime_value) AS DECIMAL(14,2)) AS total_ltv
FROM d_segments WHERE segment = 'VIP' GROUP BY 1""")
def d6(m):
    return sales.vip_by_state(segments(m))


@query("d7_segment_sizes", "SELECT segment, count(*) AS n_customers FROM d_segments GROUP BY 1")
def d7(m):
    return sales.segment_sizes(segments(m))


@query("c1_product_category", """
SELECT p.product_id, p.category_name, c.category_id, c.category_name_english
FROM d_product p JOIN d_category c ON p.category_name = c.category_name""")
def c1(m):
    joined = joins.with_category(m.product, m.category, "category_name")
    return joined.select("product_id", "category_name", "category_id", "category_name_english")


@query("c2_order_lines", """
SELECT o.order_id, i.order_item_id, o.order_purchase_timestamp, o.order_status, i.product_id, i.price
FROM d_order o JOIN (SELECT x.*, y.order_purchase_timestamp FROM d_order_item x JOIN d_order y ON x.order_id = y.order_id) i
  ON o.order_id = i.order_id AND o.order_purchase_timestamp = i.order_purchase_timestamp""")
def c2(m):
    lines = joins.order_lines(m.order, m.stamped_item)
    return lines.select("order_id", "order_item_id", "order_purchase_timestamp", "order_status", "product_id", "price")


@query("c3_sales_facts", """
SELECT o.order_id, i.order_item_id, c.category_id, i.seller_id, o.customer_unique_id, i.price
FROM d_order o JOIN d_order_item i ON o.order_id = i.order_id JOIN d_product p ON i.product_id = p.product_id
JOIN d_category c ON p.category_name = c.category_name""")
def c3(m):
    facts = joins.sales_facts(m.order, m.order_item, m.product, m.category, "category_name")
    return facts.select("order_id", "order_item_id", "category_id", "seller_id", "customer_unique_id", "price")
