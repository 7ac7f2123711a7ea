"""Queries H1 to H25: scalar functions over whole tables."""

from pyspark.sql import functions as F

from feira.functions import collections as C, dates, semistructured as J, text, values
from feira.queries.filters import grams
from feira.queries.registry import query
from feira.queries.views import AS_OF


def bought():
    return F.col("order_purchase_timestamp")


def received():
    return F.col("order_delivered_customer_date")


US = "(epoch_us(order_delivered_customer_date) - epoch_us(order_purchase_timestamp))"


@query("h1_age_at", f"SELECT order_id, {AS_OF} AS as_of, order_purchase_timestamp <= {AS_OF} AS known FROM d_order")
def h1(m):
    return m.order.select("order_id", m.now.alias("as_of"), (bought() <= m.now).alias("known"))


@query("h2_date_trunc", """
SELECT order_id, CAST(date_trunc('month', order_purchase_timestamp) AS DATE) AS month,
       date_trunc('hour', order_approved_at) AS hour FROM d_order""")
def h2(m):
    return m.order.select("order_id", dates.month_start(bought()).alias("month"),
                          dates.hour_start(F.col("order_approved_at")).alias("hour"))


@query("h3_intervals", """
SELECT order_id, order_purchase_timestamp + INTERVAL '1' MONTH AS next_month, order_purchase_timestamp - INTERVAL '12' MONTH AS last_year,
       order_purchase_timestamp - INTERVAL '7' DAY AS week_before FROM d_order""")
def h3(m):
    return m.order.select(
        "order_id", dates.shift(bought(), 1, "month").alias("next_month"), dates.shift(bought(), -12, "month").alias("last_year"),
        dates.shift(bought(), -7, "day").alias("week_before"))


@query("h4_days_between", f"SELECT order_id, round({US} / CAST(86400000000 AS DOUBLE), 6) AS days FROM d_order")
def h4(m):
    return m.order.select("order_id", F.round(dates.days_between(bought(), received()), 6).alias("days"))


@query("h5_whole_days", f"""
SELECT order_id, CAST(trunc({US} / CAST(86400000000 AS DOUBLE)) AS INT) AS days,
       CAST(trunc(-{US} / CAST(86400000000 AS DOUBLE)) AS INT) AS reversed FROM d_order""")
def h5(m):
    return m.order.select("order_id", dates.whole_days(bought(), received()).alias("days"),
                          dates.whole_days(received(), bought()).alias("reversed"))


@query("h6_floor_days", f"""
SELECT order_id, CAST(floor({US} / CAST(86400000000 AS DOUBLE)) AS BIGINT) AS days,
       CAST(floor(-{US} / CAST(86400000000 AS DOUBLE)) AS BIGINT) AS reversed FROM d_order""")
def h6(m):
    return m.order.select("order_id", dates.floor_days(bought(), received()).alias("days"),
                          dates.floor_days(received(), bought()).alias("reversed"))


@query("h7_calendar_names", """
SELECT order_id, strftime(order_purchase_timestamp, '%Y-%m') AS month, dayname(order_purchase_timestamp) AS weekday,
       CAST(hour(order_purchase_timestamp) AS INT) AS hour FROM d_order""")
def h7(m):
    return m.order.select("order_id", dates.month_label(bought()).alias("month"),
                          dates.weekday_name(bought()).alias("weekday"), F.hour(bought()).alias("hour"))


@query("h8_partition_names", """
SELECT order_id, strftime(order_purchase_timestamp, 'order_%Y_%m') AS name, date_trunc('month', order_purchase_timestamp) AS lower,
       date_trunc('month', order_purchase_timestamp) + INTERVAL '1' MONTH AS upper FROM d_order""")
def h8(m):
    year, month = F.year(bought()), F.month(bought())
    lower, upper = dates.month_partition_bounds(year, month)
    return m.order.select("order_id", dates.month_partition_name(year, month).alias("name"),
                          lower.alias("lower"), upper.alias("upper"))


@query("h9_lenient_dates", """
SELECT event_id, CASE WHEN event_id % 5 > 1 THEN date_trunc('second', ts) END AS parsed FROM d_event""")
def h9(m):
    written = F.date_format("ts", "yyyy-MM-dd HH:mm:ss")
    spoiled = F.when(F.col("event_id") % 5 == 0, "soon").when(
        F.col("event_id") % 5 == 1, F.concat(F.lit("2024-02-31"), F.substring(written, 11, 9))).otherwise(written)
    return m.session_event.select("event_id", dates.lenient_timestamp(spoiled).alias("parsed"))


@query("h10_upper_length", "SELECT product_id, upper(description) AS loud, CAST(length(name) AS INT) AS n FROM d_product")
def h10(m):
    return m.product.select("product_id", F.upper("description").alias("loud"), F.length("name").alias("n"))


@query("h11_greatest", "SELECT product_id, greatest(n_photos, 2) AS photos, least(n_photos, 2) AS few FROM d_product")
def h11(m):
    two = F.lit(2).cast("long")
    return m.product.select("product_id", F.greatest("n_photos", two).alias("photos"), F.least("n_photos", two).alias("few"))


@query("h12_case", """
SELECT product_id, CASE WHEN base_price > 1000 THEN 'high' WHEN base_price > 920 THEN 'middle' ELSE 'low' END AS band FROM d_product""")
def h12(m):
    band = F.when(F.col("base_price") > 1000, "high").when(F.col("base_price") > 920, "middle").otherwise("low")
    return m.product.select("product_id", band.alias("band"))


@query("h13_distinct_from", "SELECT product_id, n_photos IS DISTINCT FROM nullif(n_photos, 3) AS changed FROM d_product")
def h13(m):
    return m.product.select("product_id", values.distinct_from(
        F.col("n_photos"), F.nullif("n_photos", F.lit(3).cast("long"))).alias("changed"))


@query("h14_json_values", """
SELECT product_id, json_extract_string(product_specifications, '$.color') AS color,
       TRY_CAST(json_extract_string(product_specifications, '$.size') AS INT) AS size,
       TRY_CAST(json_extract_string(product_specifications, '$.color') AS INT) AS no_number FROM d_product""")
def h14(m):
    spec = F.col("product_specifications")
    return m.rich_product.select("product_id", J.text_at(spec, "$.color").alias("color"),
                                 J.int_at(spec, "$.size").alias("size"), J.int_at(spec, "$.color").alias("no_number"))


@query("h15_array_length", "SELECT product_id, CAST(nullif(n_photos, 0) AS INT) AS n FROM d_product")
def h15(m):
    return m.rich_product.select("product_id", C.element_count(F.col("product_photos")).alias("n"))


@query("h16_constructors", """
SELECT product_id, concat_ws(',', tag_1, tag_2, tag_3) AS tags, weight_g, length_cm FROM d_product""")
def h16(m):
    built = m.product.select("product_id", F.array("tag_1", "tag_2", "tag_3").alias("tags"),
                             F.struct("weight_g", "length_cm").alias("size"))
    return built.select("product_id", F.array_join("tags", ",").alias("tags"), "size.*")


@query("h20_similarity", f"""
SELECT product_id, round(len(list_intersect(a, b)) / CAST(len(list_distinct(list_concat(a, b))) AS DOUBLE), 6) AS sim
FROM (SELECT product_id, {grams('name')} AS a, {grams('description')} AS b FROM d_product) t""")
def h20(m):
    return m.product.select("product_id", F.round(text.similarity(F.col("name"), F.col("description")), 6).alias("sim"))


@query("h20_document_trigrams", f"SELECT doc_id, CAST(len({grams('text')}) AS INT) AS n FROM documents")
def h20_documents(m):
    return m.raw("documents").select("doc_id", F.size(text.trigrams(F.col("text"))).alias("n"))


@query("h21_derived_uuid", """
SELECT product_id, concat_ws('-', substring(h, 1, 8), substring(h, 9, 4), substring(h, 13, 4), substring(h, 17, 4), substring(h, 21, 12)) AS uuid
FROM (SELECT product_id, sha256('+' || product_id || chr(1) || coalesce('+' || name, '-')) AS h FROM d_product) t""")
def h21(m):
    return m.product.select("product_id", values.derived_uuid(F.col("product_id"), F.col("name")).alias("uuid"))


@query("h22_protection", """
SELECT customer_unique_id, sha256(customer_unique_id) AS hashed, customer_city AS restored, TRUE AS hidden FROM d_customer""")
def h22(m):
    key = F.lit("0123456789abcdef")
    locked = m.customer.withColumn("locked", values.encrypt(F.col("customer_city"), key))
    return locked.select("customer_unique_id", values.fingerprint(F.col("customer_unique_id")).alias("hashed"),
                         values.decrypt(F.col("locked"), key).alias("restored"),
                         (F.col("locked") != F.col("customer_city")).alias("hidden"))


@query("h23_map_values", """
SELECT product_id, tag_1 AS first, CAST(NULL AS VARCHAR) AS missing, TRUE AS has_first FROM d_product""")
def h23(m):
    entries = F.create_map(F.lit("first"), F.col("tag_1"), F.lit("second"), F.col("tag_2"))
    return m.product.select("product_id", C.map_value(entries, "first").alias("first"),
                            C.map_value(entries, "third").alias("missing"),
                            F.map_contains_key(entries, "first").alias("has_first"))


@query("h24_rounding", """
SELECT order_id, order_item_id, CAST(price * CAST(0.125 AS DECIMAL(4,3)) AS DECIMAL(14,2)) AS half_up,
       round_even(freight_value * CAST(0.125 AS DOUBLE), 2) AS half_even FROM d_order_item""")
def h24(m):
    eighth = (F.col("price") * F.lit("0.125").cast("decimal(4,3)"))
    return m.order_item.select(
        "order_id", "order_item_id", values.money(eighth).alias("half_up"),
        values.round_half_even(F.col("freight_value").cast("double") * 0.125).alias("half_even"))


@query("h25_discounts", """
SELECT product_id, CAST(base_price * CAST(0.80 AS DECIMAL(3,2)) AS DECIMAL(14,2)) AS by_share,
       CAST(greatest(base_price - 950, 0) AS DECIMAL(14,2)) AS by_amount, CAST(base_price AS DECIMAL(14,2)) AS unchanged FROM d_product""")
def h25(m):
    price, none = F.col("base_price"), F.lit(None).cast("decimal(12,2)")
    share, amount = F.lit(20).cast("decimal(5,2)"), F.lit(950).cast("decimal(12,2)")
    return m.product.select(
        "product_id", values.discounted(price, share, none).alias("by_share"),
        values.discounted(price, none.cast("decimal(5,2)"), amount).alias("by_amount"),
        values.discounted(price, none.cast("decimal(5,2)"), none).alias("unchanged"))
