"""The exploratory report: one named frame per finding."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F, types as T

from feira.operators import aggregates as A, statistics as S, timelines
from feira.session import stored

Tables = dict[str, DataFrame]


def quality_findings(t: Tables) -> Tables:
    """Missing values, key candidates, logical ranges and the orders-per-customer ratio."""
    keys = {"customers": ["customer_unique_id"], "orders": ["order_id"], "items": ["order_id", "order_item_id"],
            "payments": ["order_id", "payment_sequential"], "reviews": ["review_id"], "products": ["product_id"],
            "sellers": ["seller_id"]}
    found = {f"nulls_{name}": S.null_report(t[name]) for name in keys}
    found.update({f"key_{name}": S.key_report(t[name], key) for name, key in keys.items()})
    found["orders_per_real_customer"] = A.distinct_ratio(t["orders"], "order_id", "customer_unique_id")
    found["out_of_range"] = S.range_report(t["items"], t["payments"], t["reviews"], t["orders"])
    return found


def distribution_findings(t: Tables) -> Tables:
    """Outliers and distributions of single variables, from narrow copies of the tables, as they take many passes."""
    variables = {"price": "items", "freight_value": "items", "payment_value": "payments",
                 "payment_installments": "payments"}
    bins = {"price": 80, "freight_value": 60, "payment_installments": 24}
    narrow = {name: stored(t[name].select(*[v for v, n in variables.items() if n == name]), "variables") for name in dict.fromkeys(variables.values())}
    found = {f"outliers_{v}": S.iqr_outliers(narrow[name], v) for v, name in variables.items()}
    found.update({f"histogram_{v}": S.histogram(narrow[variables[v]], v, n) for v, n in bins.items()})
    found["review_scores"] = A.value_counts(t["reviews"], "score")
    found["payment_types"] = A.value_shares(t["payments"], "payment_type")
    return found


def relation_findings(t: Tables) -> Tables:
    """Cardinalities between tables and how delivery time goes with the score."""
    return {
        "items_per_order": S.group_size_summary(t["items"], "order_id"),
        "orders_per_customer": S.group_size_summary(t["orders"], "customer_unique_id"),
        "reviews_per_order": S.group_size_summary(t["reviews"], "order_id"),
        "payments_per_order": S.group_size_summary(t["payments"], "order_id"),
        "categories": A.category_coverage(t["products"]),
        "top_categories": S.top_value_counts(t["products"], "category_name", 10),
        "score_vs_delivery": S.score_vs_delivery(t["orders"], t["reviews"]),
    }


def time_and_place_findings(t: Tables) -> Tables:
    """Volume over time and between states."""
    found = {f"orders_by_{unit}": A.time_counts(t["orders"], unit) for unit in ("month", "weekday", "hour")}
    found["cumulative_orders"] = timelines.cumulative_orders(t["orders"])
    found["time_span"] = A.time_span(t["orders"])
    found["top_customer_states"] = S.top_value_counts(t["customers"], "customer_state", 15)
    found["top_seller_states"] = S.top_value_counts(t["sellers"], "seller_state", 15)
    found["origin_destination"] = S.origin_destination(t["orders"], t["items"], t["customers"], t["sellers"])
    return found


def eda_report(tables: Tables) -> Tables:
    """All findings by name; each is a small lazy frame."""
    return {**quality_findings(tables), **distribution_findings(tables), **relation_findings(tables),
            **time_and_place_findings(tables)}


# What tells the lines of a finding apart; the others have one line.
LINES = {
    "out_of_range": ["check"], "review_scores": ["score"], "payment_types": ["payment_type"], "top_categories": ["category_name"],
    "score_vs_delivery": ["score"], "orders_by_month": ["month"], "orders_by_weekday": ["weekday"], "orders_by_hour": ["hour"],
    "cumulative_orders": ["month"], "top_customer_states": ["customer_state"], "top_seller_states": ["seller_state"],
    "origin_destination": ["seller_state", "customer_state"]}
KINDS = {"nulls_": ["column"], "histogram_": ["bin"], "outliers_": ["variable"]}


def line_keys(finding: str) -> list[str]:
    return LINES.get(finding) or next((k for start, k in KINDS.items() if finding.startswith(start)), [])


def report_values(found: Tables) -> DataFrame:
    """(finding, line, item, value): every value of every finding as text, numbers with six decimals."""
    def text(field: T.StructField) -> Column:
        value = F.col(f"`{field.name}`")
        return (value.cast("decimal(24,6)") if isinstance(field.dataType, T.NumericType) else value).cast("string")

    def flat(name: str) -> DataFrame:
        frame, keys = found[name], line_keys(name)
        items = F.array(*[F.struct(F.lit(f.name).alias("item"), text(f).alias("value")) for f in frame.schema.fields if f.name not in keys])
        line = F.concat_ws(">", *[F.col(f"`{k}`").cast("string") for k in keys])
        return frame.select(F.lit(name).alias("finding"), line.alias("line"), F.explode(items).alias("v")).select("finding", "line", "v.*")

    return reduce(DataFrame.unionByName, [flat(name) for name in found])
