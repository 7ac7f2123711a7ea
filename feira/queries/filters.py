"""Queries B1 to B22: projections, predicates and searches."""

from pyspark.sql import functions as F

from feira.functions import collections as C, dates, semistructured as J
from feira.operators import search
from feira.operators.sorting import top_k
from feira.queries.registry import query
from feira.queries.views import AS_OF


@query("b1_projection", """
SELECT product_id, name AS title, CAST(base_price * 2 AS DECIMAL(18,2)) AS doubled, upper(category_name) AS kind FROM d_product""")
def b1(m):
    return m.product.select(
        "product_id", F.col("name").alias("title"), (F.col("base_price") * 2).alias("doubled"),
        F.upper("category_name").alias("kind")).withColumn("doubled", F.col("doubled").cast("decimal(18,2)"))


@query("b3_predicates", """
SELECT order_id, order_status FROM d_order
WHERE order_status IN ('shipped', 'invoiced', 'created') AND order_approved_at IS NOT NULL
  AND order_purchase_timestamp BETWEEN TIMESTAMP '1996-01-01 00:00:00' AND TIMESTAMP '2000-12-31 23:59:59'
  AND NOT (customer_unique_id = 'CUST_1' OR order_delivered_carrier_date IS NULL)""")
def b3(m):
    bought = F.col("order_purchase_timestamp")
    wanted = (F.col("order_status").isin("shipped", "invoiced", "created") & F.col("order_approved_at").isNotNull()
              & bought.between(dates.instant("1996-01-01 00:00:00"), dates.instant("2000-12-31 23:59:59"))
              & ~((F.col("customer_unique_id") == "CUST_1") | F.col("order_delivered_carrier_date").isNull()))
    return m.order.where(wanted).select("order_id", "order_status")


@query("b4_json_contains", """
SELECT product_id, name FROM d_product
WHERE json_extract_string(product_specifications, '$.color') = 'red'
  AND CAST(json_extract_string(product_specifications, '$.size') AS INT) = 7""")
def b4(m):
    return search.products_with(m.rich_product, {"color": "red", "size": 7.0}).select("product_id", "name")


@query("b5_json_path", """
SELECT product_id, name, CAST(json_extract_string(product_specifications, '$.size') AS INT) AS size
FROM d_product WHERE CAST(json_extract_string(product_specifications, '$.size') AS DOUBLE) >= 40""")
def b5(m):
    return search.products_by_number(m.rich_product, "size", ">=", 40).select("product_id", "name", "size")


@query("b6_json_and_category", """
SELECT product_id, name, json_extract_string(product_specifications, '$.brand') AS brand
FROM d_product p JOIN d_category c ON p.category_name = c.category_name
WHERE c.category_name_english = 'economy' AND json_extract_string(product_specifications, '$.brand') = 'Brand#3'""")
def b6(m):
    found = search.products_by_spec(m.rich_product, m.category, "economy", {"brand": "Brand#3"}, "category_name")
    return found.select("product_id", "name", J.text_at(F.col("product_specifications"), "$.brand").alias("brand"))


TAGS = "concat_ws(',', tag_1, tag_2, tag_3) AS tags"


@query("b7_has_tag", f"""
SELECT product_id, name, {TAGS} FROM d_product WHERE list_contains([tag_1, tag_2, tag_3], 'oferta')""")
def b7(m):
    found = m.rich_product.where(C.has_tag(F.col("product_tags"), "oferta"))
    return found.select("product_id", "name", F.array_join("product_tags", ",").alias("tags"))


@query("b8_any_tag", f"""
SELECT product_id, name, {TAGS} FROM d_product WHERE list_has_any([tag_1, tag_2, tag_3], ['red', 'ring', 'gear'])""")
def b8(m):
    found = m.rich_product.where(C.any_tag(F.col("product_tags"), ["red", "ring", "gear"]))
    return found.select("product_id", "name", F.array_join("product_tags", ",").alias("tags"))


@query("b9_all_tags", f"""
SELECT product_id, name, {TAGS} FROM d_product WHERE list_has_all([tag_1, tag_2, tag_3], ['red', 'oferta'])""")
def b9(m):
    found = m.rich_product.where(C.all_tags(F.col("product_tags"), ["red", "oferta"]))
    return found.select("product_id", "name", F.array_join("product_tags", ",").alias("tags"))


@query("b10_no_photos", "SELECT product_id, name FROM d_product WHERE n_photos IS NULL OR n_photos = 0")
def b10(m):
    return m.rich_product.where(C.no_elements(F.col("product_photos"))).select("product_id", "name")


@query("b11_active_promotions", f"""
SELECT promotion_id, name, period_lower, period_upper FROM d_promotion
WHERE period_lower <= {AS_OF} AND {AS_OF} < period_upper""")
def b11(m):
    return search.active_promotions_at(m.promotion, m.now).select(
        "promotion_id", "name", F.col("promotion_period.lower").alias("period_lower"),
        F.col("promotion_period.upper").alias("period_upper"))


@query("b12_overlapping_promotions", """
SELECT promotion_id, name FROM d_promotion
WHERE period_lower < TIMESTAMP '2001-07-01 00:00:00' AND TIMESTAMP '1998-06-01 00:00:00' < period_upper""")
def b12(m):
    window = dates.instant("1998-06-01 00:00:00"), dates.instant("2001-07-01 00:00:00")
    return search.overlapping_promotions(m.promotion, *window).select("promotion_id", "name")


@query("b13_active_for_category", f"""
SELECT promotion_id, name, discount_percentage, discount_amount FROM d_promotion
WHERE period_lower <= {AS_OF} AND {AS_OF} < period_upper AND target_category_id = 1""")
def b13(m):
    return search.active_for_category(m.promotion, 1, m.now).select(
        "promotion_id", "name", "discount_percentage", "discount_amount")


@query("b14_name_like", """
SELECT product_id, name FROM d_product WHERE name ILIKE '%RING%' ORDER BY product_id LIMIT 50""")
def b14(m):
    return search.name_like(m.product, "name", "%RING%", "product_id").select("product_id", "name")


@query("b14_documents_like", "SELECT doc_id, n_chars FROM documents WHERE text ILIKE '%tion the%'")
def b14_documents(m):
    return search.name_like(m.raw("documents"), "text", "%tion the%", "doc_id", None).select("doc_id", "n_chars")


def grams(text: str) -> str:
    """SQL for the distinct trigrams of a text, word by word."""
    words = f"list_filter(regexp_split_to_array(lower({text}), '[^\\p{{L}}\\p{{N}}]+'), lambda w: w <> '')"
    cut = "list_transform(range(1, length(w) + 2), lambda i: substring('  ' || w || ' ', CAST(i AS BIGINT), 3))"
    return f"list_distinct(flatten(list_transform({words}, lambda w: {cut})))"


def sim(text: str, wanted: str) -> str:
    a, b = grams(text), grams(f"'{wanted}'")
    return f"(len(list_intersect({a}, {b})) / CAST(len(list_distinct(list_concat({a}, {b}))) AS DOUBLE))"


@query("b15_fuzzy_name", f"""
SELECT product_id, name, round(s, 6) AS sim FROM (SELECT product_id, name, {sim('name', 'redd widgit')} AS s FROM d_product) t
WHERE s > 0.3 ORDER BY s DESC, product_id LIMIT 20""")
def b15(m):
    found = search.fuzzy_search(m.product, ["name"], "redd widgit", "product_id")
    return found.select("product_id", "name", F.round("sim", 6).alias("sim"))


@query("b15_fuzzy_documents", f"""
SELECT doc_id, round(s, 6) AS sim FROM (SELECT doc_id, {sim('text', 'the retitioning of ndernt and whst thorreou')} AS s
FROM documents) t WHERE s > 0.1""")
def b15_documents(m):
    wanted = "the retitioning of ndernt and whst thorreou"
    found = search.fuzzy_matches(m.raw("documents"), ["text"], wanted, 0.1)
    return found.select("doc_id", F.round("sim", 6).alias("sim"))


@query("b16_fuzzy_two_columns", f"""
SELECT product_id, name, round(s, 6) AS best_sim FROM (SELECT product_id, name,
       greatest({sim('name', 'small ring brand')}, {sim('description', 'small ring brand')}) AS s FROM d_product) t
WHERE s > 0.3 ORDER BY s DESC, product_id LIMIT 20""")
def b16(m):
    found = search.fuzzy_search(m.product, ["name", "description"], "small ring brand", "product_id")
    return found.select("product_id", "name", F.round("sim", 6).alias("best_sim"))


@query("b17_heavy_products", "SELECT product_id, name, weight_g FROM d_product WHERE weight_g > 5000")
def b17(m):
    return search.heavy_products(m.rich_product, 5000).select("product_id", "name", "weight_g")


@query("b18_largest_products", """
SELECT product_id, name, CAST(length_cm * height_cm * width_cm AS DECIMAL(26,6)) AS volume_cm3
FROM d_product ORDER BY volume_cm3 DESC NULLS LAST, product_id LIMIT 20""")
def b18(m):
    found = search.largest_products(m.rich_product)
    return found.select("product_id", "name", F.col("volume_cm3").cast("decimal(26,6)").alias("volume_cm3"))


@query("b20_open_orders", f"""
SELECT order_id, order_status, customer_unique_id, order_purchase_timestamp FROM d_order
WHERE order_purchase_timestamp >= {AS_OF} - INTERVAL '7' DAY
  AND order_status IN ('created', 'approved', 'invoiced', 'shipped')
ORDER BY order_purchase_timestamp DESC NULLS LAST, order_id LIMIT 100""")
def b20(m):
    return search.open_orders(m.order, m.now).select(
        "order_id", "order_status", "customer_unique_id", "order_purchase_timestamp")


TOKENS = "list_filter(regexp_split_to_array(lower({0}), '[^\\p{{L}}\\p{{N}}]+'), lambda w: w <> '')"


def share(text: str, terms: str) -> str:
    words = TOKENS.format(text)
    return f"(len(list_filter({words}, lambda w: w IN ({terms}))) / CAST(len({words}) AS DOUBLE))"


@query("b26_text_search", f"""
SELECT doc_id, round(s, 6) AS score FROM (SELECT doc_id, {share('text', "'the', 'ndernt'")} AS s FROM documents) t
WHERE s > 0""")
def b26(m):
    found = search.text_search(m.raw("documents"), {"text": 1.0}, "ndernt the", "doc_id")
    return found.select("doc_id", F.round("score", 6).alias("score"))


@query("b26_product_search", f"""
SELECT product_id, round(s, 6) AS score FROM (SELECT product_id,
  {share('name', "'red', 'promo'")} * 10.0 + {share('description', "'red', 'promo'")} AS s FROM d_product) t WHERE s > 0""")
def b26_products(m):
    found = search.text_search(m.product, {"name": 10.0, "description": 1.0}, "red PROMO", "product_id")
    return found.select("product_id", F.round("score", 6).alias("score"))


@query("f4_by_relevance", f"""
SELECT doc_id, round(s, 6) AS score FROM (SELECT doc_id, {share('text', "'les', 'eaux'")} AS s FROM documents) t
WHERE s > 0 ORDER BY s DESC, doc_id LIMIT 20""")
def f4(m):
    found = top_k(search.text_matches(m.raw("documents"), {"text": 1.0}, "les eaux"), [F.desc("score")], "doc_id", 20)
    return found.select("doc_id", F.round("score", 6).alias("score"))


def bm25(source: str, key: str, fields: dict[str, float], terms: list[str]) -> str:
    """SQL of the relevance with corpus statistics, from lists of words without accents."""
    places = [(f, k, t) for f in fields for k, t in enumerate(terms)]
    words = ", ".join(f"regexp_extract_all(strip_accents(lower(coalesce({f}, ''))), '[\\p{{L}}\\p{{M}}\\p{{N}}]+') AS w_{f}" for f in fields)
    counts = ", ".join([*(f"CAST(len(w_{f}) AS DOUBLE) AS size_{f}" for f in fields),
                        *(f"CAST(len(list_filter(w_{f}, lambda w: w = '{t}')) AS DOUBLE) AS tf_{f}{k}" for f, k, t in places)])
    stats = ", ".join(["CAST(count(*) AS DOUBLE) AS n", *(f"avg(size_{f}) AS avg_{f}" for f in fields),
                       *(f"CAST(count(*) FILTER (tf_{f}{k} > 0) AS DOUBLE) AS df_{f}{k}" for f, k, _ in places)])
    score = " + ".join(
        f"CASE WHEN tf_{f}{k} > 0 THEN ln(1 + (n - df_{f}{k} + 0.5) / (df_{f}{k} + 0.5)) * tf_{f}{k} * 2.2 "
        f"/ (tf_{f}{k} + 1.2 * (0.25 + 0.75 * size_{f} / avg_{f})) * {fields[f]} ELSE 0.0 END" for f, k, _ in places)
    any_word = " OR ".join(f"tf_{f}{k} > 0" for f, k, _ in places)
    return f"""WITH words AS (SELECT {key}, {words} FROM {source}), counts AS (SELECT {key}, {counts} FROM words),
corpus AS (SELECT {stats} FROM counts) SELECT {key}, round(CAST({score} AS DOUBLE), 6) AS score FROM counts, corpus WHERE {any_word}"""


@query("b26_ranked_search", bm25("documents", "doc_id", {"text": 1.0}, ["etre", "fur", "the"]))
def b26_ranked(m):
    """Words in any accents: the texts have several spellings of one of them."""
    found = search.ranked_search(m.raw("documents"), {"text": 1.0}, "Être für the", "doc_id")
    return found.select("doc_id", F.round("score", 6).alias("score"))


@query("b26_ranked_products", bm25("d_product", "product_id", {"name": 10.0, "description": 1.0}, ["red", "promo"]))
def b26_ranked_products(m):
    found = search.ranked_search(m.product, {"name": 10.0, "description": 1.0}, "réd PROMO", "product_id")
    return found.select("product_id", F.round("score", 6).alias("score"))


@query("b26_inverted_index", f"""
SELECT token, doc_id, 'text' AS field, count(*) AS tf
FROM (SELECT doc_id, unnest({TOKENS.format('text')}) AS token FROM documents) t GROUP BY 1, 2""")
def b26_index(m):
    return search.inverted_index(m.raw("documents"), "doc_id", ["text"])


@query("f2_nulls_last", """
SELECT order_id, order_delivered_customer_date AS received FROM d_order
ORDER BY order_delivered_customer_date DESC NULLS LAST, order_id LIMIT 100""")
def f2(m):
    ordered = m.order.orderBy(F.desc_nulls_last("order_delivered_customer_date"), F.asc("order_id"))
    return ordered.limit(100).select("order_id", F.col("order_delivered_customer_date").alias("received"))
