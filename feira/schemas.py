"""Schemas of the source files and documents, and the closed value domains."""

from __future__ import annotations

# Closed domains of the data model.
ORDER_STATUSES = [
    "created", "approved", "invoiced", "shipped", "delivered", "canceled", "returned", "unavailable",
]
OPEN_STATUSES = ["created", "approved", "invoiced", "shipped"]
SALE_STATUSES = ["delivered", "shipped", "invoiced"]
PAYMENT_TYPES = ["credit_card", "debit_card", "boleto", "voucher", "pix", "not_defined"]
STOCK_STATUSES = ["in_stock", "out_of_stock", "preorder", "discontinued"]
REVIEW_TYPES = ["product", "seller"]
WEEKDAYS = ["Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday", "Sunday"]


def _fields(text: str) -> list[tuple[str, str]]:
    return [tuple(part.split()) for part in text.split(",")]


# Source CSV files: column and final type. Dates are read as text and parsed leniently.
SOURCE_COLUMNS = {
    "customers": _fields(
        "customer_id string, customer_unique_id string, customer_zip_code_prefix int,"
        "customer_city string, customer_state string"),
    "orders": _fields(
        "order_id string, customer_id string, order_status string, order_purchase_timestamp timestamp_ntz,"
        "order_approved_at timestamp_ntz, order_delivered_carrier_date timestamp_ntz,"
        "order_delivered_customer_date timestamp_ntz, order_estimated_delivery_date timestamp_ntz"),
    "order_items": _fields(
        "order_id string, order_item_id int, product_id string, seller_id string,"
        "shipping_limit_date timestamp_ntz, price decimal(12;2), freight_value decimal(12;2)"),
    "order_payments": _fields(
        "order_id string, payment_sequential int, payment_type string, payment_installments int,"
        "payment_value decimal(12;2)"),
    "order_reviews": _fields(
        "review_id string, order_id string, review_score int, review_comment_title string,"
        "review_comment_message string, review_creation_date timestamp_ntz,"
        "review_answer_timestamp timestamp_ntz"),
    "products": _fields(
        "product_id string, product_category_name string, product_name_lenght int,"
        "product_description_lenght int, product_photos_qty int, product_weight_g decimal(10;2),"
        "product_length_cm decimal(8;2), product_height_cm decimal(8;2), product_width_cm decimal(8;2)"),
    "sellers": _fields(
        "seller_id string, seller_zip_code_prefix int, seller_city string, seller_state string"),
    "geolocation": _fields(
        "geolocation_zip_code_prefix int, geolocation_lat decimal(9;6), geolocation_lng decimal(9;6),"
        "geolocation_city string, geolocation_state string"),
    "category_translation": _fields(
        "product_category_name string, product_category_name_english string"),
}
SOURCE_COLUMNS = {
    table: [(name, kind.replace(";", ",")) for name, kind in columns]
    for table, columns in SOURCE_COLUMNS.items()
}

_DATE = "struct<`$date`:string>"
_OID = "struct<`$oid`:string>"

# Documents as stored in extended JSON; dates and ids are still wrapped.
DOCUMENT_SCHEMAS = {
    "product_catalog":
        f"_id {_OID}, product_id string, sku string, name string, description string,"
        "category struct<id:int,name:string,name_english:string>,"
        "seller struct<id:string,name:string,city:string,state:string,rating_avg:double,n_reviews:bigint>,"
        "specifications variant, images array<string>, tags array<string>,"
        "dimensions struct<length_cm:double,height_cm:double,width_cm:double,weight_g:double>,"
        "base_price double, currency string, price_current double, has_active_promotion boolean,"
        "discount_percentage double,"
        f"active_promotion struct<promotion_id:string,name:string,valid_until:{_DATE}>,"
        "stock_status string, stock_count_bucket string,"
        "rating struct<avg:double,count:bigint,distribution:map<string,bigint>>,"
        "search_vector struct<boost_terms:array<string>,language:string>,"
        f"source_updated_at {_DATE}, synced_at {_DATE}, schema_version int",
    "reviews":
        f"_id {_OID}, review_id string, review_type string, order_id string, product_id string,"
        "customer_unique_id string, seller_id string, score int, title string, message string,"
        "language string, tags_auto array<string>, sentiment struct<label:string,score:double>,"
        "metadata struct<verified_purchase:boolean,helpful_votes:int,report_count:int,source_channel:string>,"
        f"seller_response struct<text:string,responded_at:{_DATE},responded_by:string>,"
        f"media array<struct<type:string,url:string,uploaded_at:{_DATE}>>,"
        f"created_at {_DATE}, answered_at {_DATE}, updated_at {_DATE}, schema_version int",
    "analytics_events":
        f"_id {_OID}, session_id string, customer_unique_id string, bucket_hour {_DATE}, bucket_date string,"
        "device struct<type:string,os:string,os_version:string,browser:string,screen_size:string>,"
        "geo struct<country:string,state:string,city:string,ip_hash:string>, event_count int,"
        "events array<struct<seq:int,type:string,path:string,referrer:string,query:string,"
        "results_count:int,product_id:string,position:int,image_index:int,qty:int,price_snapshot:double,"
        f"items_count:int,total_snapshot:double,payment_type:string,order_id:string,total:double,ts:{_DATE}>>,"
        f"bucket_metadata struct<first_event_at:{_DATE},last_event_at:{_DATE},duration_seconds:bigint,"
        f"converted:boolean,schema_version:int>, expires_at {_DATE}",
    "user_sessions":
        "_id string, session_id string, customer_unique_id string, started_at string,"
        "last_activity_at string, expires_at string, ip_hash string, user_agent string,"
        "device struct<type:string,os:string,browser:string>,"
        "cart array<struct<product_id:string,qty:int,price_snapshot:double>>",
}

# The validators of the four document collections.
VALIDATORS = {
    "product_catalog": {
        "bsonType": "object",
        "required": ["product_id", "sku", "name", "category", "seller", "base_price", "price_current", "synced_at", "source_updated_at"],
        "properties": {
            "product_id": {"bsonType": "string"},
            "sku": {"bsonType": "string"},
            "name": {"bsonType": "string"},
            "description": {"bsonType": ["string", "null"]},
            "category": {
                "bsonType": "object",
                "required": ["id", "name"],
                "properties": {"id": {"bsonType": "int"}, "name": {"bsonType": "string"}, "name_english": {"bsonType": ["string", "null"]}}},
            "seller": {
                "bsonType": "object",
                "required": ["id", "city", "state"],
                "properties": {
                    "id": {"bsonType": "string"}, "name": {"bsonType": ["string", "null"]}, "city": {"bsonType": "string"},
                    "state": {"bsonType": "string"}, "rating": {"bsonType": ["double", "int", "null"], "minimum": 0, "maximum": 5}}},
            "specifications": {"bsonType": ["object", "null"]},
            "images": {"bsonType": ["array", "null"], "items": {"bsonType": "string"}},
            "tags": {"bsonType": ["array", "null"], "items": {"bsonType": "string"}},
            "dimensions": {"bsonType": ["object", "null"]},
            "base_price": {"bsonType": ["double", "int", "decimal"], "minimum": 0},
            "price_current": {"bsonType": ["double", "int", "decimal"], "minimum": 0},
            "has_active_promotion": {"bsonType": "bool"},
            "discount_percentage": {"bsonType": ["double", "int", "null"], "minimum": 0, "maximum": 100},
            "stock_status": {"enum": STOCK_STATUSES},
            "synced_at": {"bsonType": "date"},
            "source_updated_at": {"bsonType": "date"}}},
    "reviews": {
        "bsonType": "object",
        "required": ["review_id", "review_type", "order_id", "customer_unique_id", "score", "created_at"],
        "properties": {
            "review_id": {"bsonType": "string"},
            "review_type": {"enum": REVIEW_TYPES},
            "order_id": {"bsonType": "string"},
            "product_id": {"bsonType": ["string", "null"]},
            "seller_id": {"bsonType": ["string", "null"]},
            "customer_unique_id": {"bsonType": "string"},
            "score": {"bsonType": "int", "minimum": 1, "maximum": 5},
            "title": {"bsonType": ["string", "null"]},
            "message": {"bsonType": ["string", "null"]},
            "tags_auto": {"bsonType": ["array", "null"], "items": {"bsonType": "string"}},
            "language": {"bsonType": ["string", "null"]},
            "created_at": {"bsonType": "date"},
            "answered_at": {"bsonType": ["date", "null"]},
            "seller_response": {"bsonType": ["object", "null"]}}},
    "analytics_events": {
        "bsonType": "object",
        "required": ["session_id", "bucket_hour", "event_count", "events", "expires_at"],
        "properties": {
            "session_id": {"bsonType": "string"},
            "customer_unique_id": {"bsonType": ["string", "null"]},
            "bucket_hour": {"bsonType": "date"},
            "event_count": {"bsonType": "int", "minimum": 0},
            "events": {
                "bsonType": "array",
                "items": {"bsonType": "object", "required": ["type", "ts"],
                          "properties": {"type": {"bsonType": "string"}, "ts": {"bsonType": "date"}}}},
            "expires_at": {"bsonType": "date"}}},
    "user_sessions": {
        "bsonType": "object",
        "required": ["_id", "started_at", "last_activity_at", "expires_at"],
        "properties": {
            "_id": {"bsonType": "string"},
            "customer_unique_id": {"bsonType": ["string", "null"]},
            "started_at": {"bsonType": "date"},
            "last_activity_at": {"bsonType": "date"},
            "expires_at": {"bsonType": "date"},
            "ip_hash": {"bsonType": ["string", "null"]},
            "user_agent": {"bsonType": ["string", "null"]},
            "device": {"bsonType": ["object", "null"]},
            "cart": {"bsonType": ["array", "null"]}}},
}
