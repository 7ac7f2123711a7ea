"""J18: raw documents, some broken in every way a validator knows, against the compiled validators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from feira.functions import semistructured
from feira.operators import quality
from feira.operators.validators import compile_validator, rule_names
from feira.queries.registry import query
from feira.schemas import VALIDATORS
from feira.session import tasks
from feira.streaming import buckets

DAY = '{"$date":"2024-03-01T10:00:00Z"}'

# Broken documents by validator: rule, member at the top that breaks it, what stands there (none: it is missing), and
# the divisor of the row's number where it does. Every divisor is used once per member, so that rules stay apart.
BROKEN = {
    "product_catalog": [
        ("required product_id", "product_id", None, 29), ("required sku", "sku", None, 11), ("type sku", "sku", "7", 7),
        ("required name", "name", None, 13), ("type name", "name", "null", 17), ("type description", "description", "[]", 19),
        ("required category", "category", None, 23), ("type category", "category", '"office"', 11),
        ("required category.id", "category", '{"name":"n"}', 13), ("required category.name", "category", '{"id":1,"name_english":null}', 17),
        ("type category.id", "category", '{"id":3000000000,"name":"n"}', 19), ("type category.name", "category", '{"id":1,"name":2}', 29),
        ("type category.name_english", "category", '{"id":1,"name":"n","name_english":{}}', 31),
        ("required seller.city", "seller", '{"id":"s","state":"ST"}', 7), ("type seller.rating", "seller", '{"id":"s","city":"c","state":"ST","rating":"4"}', 11),
        ("maximum seller.rating", "seller", '{"id":"s","city":"c","state":"ST","rating":5.1}', 13),
        ("minimum seller.rating", "seller", '{"id":"s","city":"c","state":"ST","rating":-1}', 17),
        ("type specifications", "specifications", "[1]", 7), ("type images", "images", "{}", 7), ("type images[]", "images", '["a",2]', 11),
        ("type tags[]", "tags", '[null,"b"]', 13), ("type dimensions", "dimensions", '"1x1"', 11), ("type base_price", "base_price", '"9"', 11),
        ("minimum base_price", "base_price", "-0.01", 13), ("required price_current", "price_current", None, 17),
        ("type has_active_promotion", "has_active_promotion", '"yes"', 7), ("maximum discount_percentage", "discount_percentage", "100.5", 11),
        ("minimum discount_percentage", "discount_percentage", "-3", 13), ("enum stock_status", "stock_status", '"sold"', 7),
        ("type synced_at", "synced_at", '"2024-03-01T10:00:00Z"', 11), ("type source_updated_at", "source_updated_at", '{"$date":"soon"}', 13),
    ],
    "reviews": [
        ("required review_id", "review_id", None, 7), ("type order_id", "order_id", "12", 11), ("enum review_type", "review_type", '"shop"', 13),
        ("type score", "score", "4.5", 7), ("minimum score", "score", "0", 11), ("maximum score", "score", "6", 13), ("required score", "score", None, 17),
        ("type tags_auto[]", "tags_auto", '["x",["y"]]', 11), ("type answered_at", "answered_at", "true", 7), ("type seller_response", "seller_response", '"thanks"', 7),
        ("required created_at", "created_at", None, 19), ("type customer_unique_id", "customer_unique_id", "{}", 11),
    ],
    "analytics_events": [
        ("type session_id", "session_id", "1", 7), ("type event_count", "event_count", "1.5", 11), ("minimum event_count", "event_count", "-1", 13),
        ("required events", "events", None, 7), ("type events", "events", "{}", 11), ("type events[]", "events", '["view"]', 13),
        ("required events[].type", "events", '[{"ts":' + DAY + "}]", 17), ("required events[].ts", "events", '[{"type":"view"},{"type":"view","ts":' + DAY + "}]", 19),
        ("type events[].ts", "events", '[{"type":"view","ts":"now"}]', 23), ("type events[].type", "events", '[{"type":null,"ts":' + DAY + "}]", 29),
        ("type bucket_hour", "bucket_hour", "null", 7), ("required expires_at", "expires_at", None, 7),
    ],
    "user_sessions": [
        ("required _id", "_id", None, 7), ("type _id", "_id", "9", 11), ("required started_at", "started_at", None, 13),
        ("type last_activity_at", "last_activity_at", '"today"', 7), ("type expires_at", "expires_at", '{"$date":7}', 11),
        ("type device", "device", '"phone"', 7), ("type cart", "cart", "{}", 7), ("type ip_hash", "ip_hash", "false", 11),
    ],
}
TEXTLESS = 97  # one document of so many is no JSON at all


def _conditions(kind: str) -> dict[str, str]:
    """SQL condition of each broken rule, by row number ``k``: of several faults of one member the first one stands there."""
    earlier: dict[str, list[int]] = {}
    found = {}
    for rule, member, _, divisor in BROKEN[kind]:
        before = earlier.setdefault(member, [])
        found[rule] = " AND ".join([f"k % {divisor} = 0", *[f"k % {d} <> 0" for d in before], f"k % {TEXTLESS} <> 0"])
        before.append(divisor)
    return found | {"type": f"k % {TEXTLESS} = 0"}


def raw_documents(rows: DataFrame, kind: str, members: dict[str, Column]) -> DataFrame:
    """(key, document): documents with these members, which are given as JSON texts, but for the broken ones."""
    def text(name: str, good: Column) -> Column:
        stands = F.concat(F.lit(f'"{name}":'), good)
        for _, member, bad, divisor in reversed(BROKEN[kind]):
            if member == name:
                stands = F.when(F.col("k") % divisor == 0, F.lit(None if bad is None else f'"{name}":{bad}')).otherwise(stands)
        return stands

    whole = F.concat(F.lit("{"), F.concat_ws(",", *[text(n, c) for n, c in members.items()]), F.lit("}"))
    broken = F.when(F.col("k") % TEXTLESS == 0, F.lit("{")).otherwise(whole)
    return rows.select("key", semistructured.parse(broken).alias("document"))


def report(rows: DataFrame, kind: str, members: dict[str, Column]) -> DataFrame:
    documents = raw_documents(rows.repartition(tasks(rows.sparkSession)), kind, members)
    return quality.check_rules(documents, compile_validator(VALIDATORS[kind], F.col("document")), "key")


def expected(kind: str, rows: str) -> str:
    """SQL that counts the documents seeded for each rule; all other rules are kept."""
    found = _conditions(kind)
    names = rule_names(VALIDATORS[kind])
    lines = [f"SELECT '{n}' AS rule, count(*) FILTER (WHERE {found.get(n, 'FALSE')}) AS violations, "
             f"min(key) FILTER (WHERE {found.get(n, 'FALSE')}) AS sample_key FROM ({rows}) r" for n in names]
    return " UNION ALL ".join(lines)


def _text(column: str) -> Column:
    """A column as JSON text, NULL as null."""
    listed = F.to_json(F.array(column))
    return listed.substr(F.lit(2), F.length(listed) - 2)


def _date(column: str) -> Column:
    return F.concat(F.lit('{"$date":"'), F.date_format(column, "yyyy-MM-dd'T'HH:mm:ss'Z'"), F.lit('"}'))


NUMBER = "CAST(substring(product_id, 6) AS BIGINT)"


@query("j18_catalog_validator", expected("product_catalog", f"SELECT product_id AS key, {NUMBER} AS k FROM d_product"))
def j18_catalog(m):
    rows = m.product.selectExpr("*", "product_id AS key", f"{NUMBER} AS k")
    stamp = F.lit(DAY)
    return report(rows, "product_catalog", {
        "product_id": _text("product_id"), "sku": _text("product_id"), "name": _text("name"), "description": _text("description"),
        "category": F.concat(F.lit('{"id":4,"name":'), _text("category_name"), F.lit(',"name_english":null}')),
        "seller": F.lit('{"id":"s","city":"c","state":"ST","rating":4.5}'), "specifications": F.col("product_specifications"),
        "images": F.lit("null"), "tags": F.to_json(F.array("tag_1", "tag_2")), "dimensions": F.lit('{"weight_g":1}'),
        "base_price": F.col("base_price").cast("string"), "price_current": F.lit("12"), "has_active_promotion": F.lit("true"),
        "discount_percentage": F.lit("null"), "stock_status": F.lit('"in_stock"'), "synced_at": stamp, "source_updated_at": stamp})


@query("j18_review_validator", expected("reviews", "SELECT review_id AS key, CAST(substring(review_id, 5) AS BIGINT) AS k FROM d_review"))
def j18_review(m):
    rows = m.review.selectExpr("*", "review_id AS key", "CAST(substring(review_id, 5) AS BIGINT) AS k")
    return report(rows, "reviews", {
        "review_id": _text("review_id"), "review_type": _text("review_type"), "order_id": _text("order_id"), "product_id": F.lit("null"),
        "customer_unique_id": F.lit('"c"'), "score": F.col("score").cast("string"), "tags_auto": F.lit('["fast"]'), "answered_at": F.lit("null"),
        "seller_response": F.lit("{}"), "created_at": _date("created_at")})


@query("j18_event_validator", expected("analytics_events", """
SELECT session_id || '/' || CAST(bucket_hour AS VARCHAR) AS key, event_count * 1000 + hour(bucket_hour) * 7 + CAST(substring(session_id, 6) AS BIGINT) AS k
FROM d_bucket"""))
def j18_event(m):
    documents = buckets.bucket_events(m.session_event)
    hour = F.date_format("bucket_hour", "yyyy-MM-dd HH:mm:ss")
    rows = documents.withColumn("key", F.concat("session_id", F.lit("/"), hour)).withColumn("k", F.expr(
        "event_count * 1000 + hour(bucket_hour) * 7 + CAST(substring(session_id, 6) AS BIGINT)"))
    entries = F.transform("events", lambda e: F.concat(
        F.lit('{"type":"'), e["type"], F.lit('","ts":{"$date":"'), F.date_format(e["ts"], "yyyy-MM-dd'T'HH:mm:ss'Z'"), F.lit('"}}')))
    return report(rows, "analytics_events", {
        "session_id": _text("session_id"), "customer_unique_id": _text("customer_unique_id"), "bucket_hour": _date("bucket_hour"),
        "event_count": F.col("event_count").cast("string"), "events": F.concat(F.lit("["), F.array_join(entries, ","), F.lit("]")),
        "expires_at": _date("expires_at")})


@query("j18_session_validator", expected("user_sessions", """
SELECT DISTINCT session_id AS key, CAST(substring(session_id, 6) AS BIGINT) AS k FROM d_event"""))
def j18_session(m):
    rows = buckets.user_sessions(m.session_event).withColumn("key", F.col("session_id")).withColumn(
        "k", F.substring("session_id", F.lit(6), F.lit(20)).cast("long"))
    return report(rows, "user_sessions", {
        "_id": _text("session_id"), "customer_unique_id": _text("customer_unique_id"), "started_at": _date("started_at"),
        "last_activity_at": _date("last_activity_at"), "expires_at": _date("expires_at"), "ip_hash": F.lit("null"), "device": F.lit('{"os":"x"}'),
        "cart": F.coalesce(F.to_json("cart"), F.lit("null"))})
