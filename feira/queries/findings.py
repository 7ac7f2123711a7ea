"""K7: all values of the exploratory report, with SQL of its own for every finding."""

from feira.plans import report
from feira.queries import exploration as X
from feira.queries.registry import query, raw_sql

TABLES = {"customers": "d_customer", "orders": "d_order", "items": "d_order_item", "payments": "d_payment", "reviews": "d_review",
          "products": "d_product", "sellers": "d_seller"}
PLACE = ["zip_code_prefix", "city", "state"]
COLUMNS = {
    "customers": ["customer_unique_id", *[f"customer_{c}" for c in PLACE], "lng", "lat"], "orders": X.ORDER_COLUMNS,
    "items": ["order_id", "order_item_id", "product_id", "seller_id", "shipping_limit_date", "price", "freight_value"],
    "payments": ["order_id", "payment_sequential", "payment_type", "payment_installments", "payment_value"],
    "reviews": ["review_id", "review_type", "order_id", "score", "created_at"],
    "products": ["product_id", "category_name", "name", "description", "product_specifications", "n_photos", "tag_1", "tag_2", "tag_3", "length_cm",
                 "height_cm", "width_cm", "weight_g", "base_price"],
    "sellers": ["seller_id", *[f"seller_{c}" for c in PLACE], "lng", "lat"]}
KEYS = {"customers": ["customer_unique_id"], "orders": ["order_id"], "items": ["order_id", "order_item_id"], "payments": ["order_id", "payment_sequential"],
        "reviews": ["review_id"], "products": ["product_id"], "sellers": ["seller_id"]}
SIZES = ["n_groups", "mean", "std", "min", "q1", "median", "q3", "max", "n_single", "pct_single", "n_2_or_more", "n_5_or_more", "n_over_5", "n_over_10"]
IQR = ["q1", "median", "q3", "iqr", "lower_bound", "upper_bound", "outliers", "outliers_pct"]


def key_sql(table: str, keys: list[str]) -> str:
    names = ", ".join(keys)
    return (f"SELECT CAST(sum(n) AS BIGINT) AS n_rows, count(*) AS n_unique, CAST(sum(n - 1) AS BIGINT) AS n_duplicate "
            f"FROM (SELECT {names}, count(*) AS n FROM {table} GROUP BY {names}) t")


def top(table: str, column: str, k: int) -> str:
    return f"SELECT {column}, count(*) AS n FROM {table} WHERE {column} IS NOT NULL GROUP BY 1 ORDER BY n DESC, 1 LIMIT {k}"


# Finding: its SQL and its values.
FINDINGS = {
    **{f"nulls_{n}": (X.nulls(t, COLUMNS[n]), ["null_pct"]) for n, t in TABLES.items()},
    **{f"key_{n}": (key_sql(t, KEYS[n]), ["n_rows", "n_unique", "n_duplicate"]) for n, t in TABLES.items()},
    "orders_per_real_customer": (raw_sql("d19_orders_per_real_customer"), ["n_many", "n_few", "ratio"]),
    "out_of_range": (raw_sql("d20_range_report"), ["n"]),
    **{f"outliers_{c}": (X.iqr(t, c), IQR) for t, c in (
        ("d_order_item", "price"), ("d_order_item", "freight_value"), ("d_payment", "payment_value"), ("d_payment", "payment_installments"))},
    **{f"histogram_{c}": (X.bins(t, c, n), ["bin_start", "n"]) for t, c, n in (
        ("d_order_item", "price", 80), ("d_order_item", "freight_value", 60), ("d_payment", "payment_installments", 24))},
    "review_scores": (raw_sql("d16_score_counts"), ["n"]), "payment_types": (raw_sql("d16_payment_type_share"), ["n", "pct"]),
    **{name: (X.sizes(t, k), SIZES) for name, t, k in (
        ("items_per_order", "d_order_item", "order_id"), ("orders_per_customer", "d_order", "customer_unique_id"),
        ("reviews_per_order", "d_review", "order_id"), ("payments_per_order", "d_payment", "order_id"))},
    "categories": ("SELECT count(DISTINCT category_name) AS n_categories, count(*) FILTER (category_name IS NULL) AS n_uncategorized FROM d_product",
                   ["n_categories", "n_uncategorized"]),
    "top_categories": (top("d_product", "category_name", 10), ["n"]),
    "score_vs_delivery": (raw_sql("d24_score_vs_delivery"), ["mean_days", "median_days", "n_reviews"]),
    **{f"orders_by_{u}": (raw_sql(f"d25_orders_by_{u}"), ["n_orders"]) for u in ("month", "weekday", "hour")},
    "cumulative_orders": (raw_sql("e1_cumulative_orders"), ["n_orders", "n_cumulative"]),
    "time_span": (raw_sql("d28_time_span"), ["first_at", "last_at", "n_orders"]),
    "top_customer_states": (top("d_customer", "customer_state", 15), ["n"]), "top_seller_states": (top("d_seller", "seller_state", 15), ["n"]),
    "origin_destination": (raw_sql("d27_origin_destination"), ["n_items"]),
}


def values_sql(name: str) -> str:
    sql, items = FINDINGS[name]
    line = " || '>' || ".join(f'CAST("{k}" AS VARCHAR)' for k in report.line_keys(name)) or "''"

    def value(item: str) -> str:
        return f"CAST({item} AS VARCHAR)" if item.endswith("_at") else f"CAST(CAST({item} AS DECIMAL(24,6)) AS VARCHAR)"

    rows = " UNION ALL ".join(f"SELECT '{name}' AS finding, {line} AS line, '{item}' AS item, {value(item)} AS value FROM f" for item in items)
    return f"SELECT * FROM (WITH f AS ({sql}) {rows}) x"


def all_findings(m):
    return report.eda_report({"customers": m.customer, "orders": m.order, "items": m.order_item, "payments": m.payment, "reviews": m.review,
                              "products": m.product, "sellers": m.seller})


@query("k7_eda_values", " UNION ALL ".join(values_sql(name) for name in FINDINGS))
def k7_values(m):
    """Every value of every finding of the report."""
    return report.report_values(all_findings(m))
