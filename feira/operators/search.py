"""Filters and searches over products, promotions, orders and documents."""

from __future__ import annotations

import re
from functools import reduce
from typing import Any

from pyspark.sql import Column, DataFrame, functions as F

from feira.functions import collections as C, dates, geo, semistructured as J, text
from feira.operators.sorting import top_k
from feira.schemas import OPEN_STATUSES
from feira.session import stored


def products_with(products: DataFrame, spec: dict[str, Any]) -> DataFrame:
    """Products whose specifications contain the given keys and values."""
    return products.where(J.contains(F.col("product_specifications"), spec))


def products_by_number(products: DataFrame, key: str, op: str, value: float) -> DataFrame:
    """Products with a numeric specification in range, and that number."""
    spec, path = F.col("product_specifications"), f"$.{key}"
    return products.where(J.path_compare(spec, path, op, value)).withColumn(key, J.int_at(spec, path))


def products_by_spec(products: DataFrame, categories: DataFrame, category: str, spec: dict[str, Any],
                     key: str = "category_id") -> DataFrame:
    """Products of a category (English name) with the given specifications."""
    wanted = categories.where(F.col("category_name_english") == category).select(key)
    return products_with(products, spec).join(wanted, key, "left_semi")


def active_promotions_at(promotions: DataFrame, at: Column) -> DataFrame:
    return promotions.where(C.period_contains(F.col("promotion_period"), at))


def overlapping_promotions(promotions: DataFrame, start: Column, end: Column) -> DataFrame:
    return promotions.where(C.periods_overlap(F.col("promotion_period"), C.period(start, end)))


def active_for_category(promotions: DataFrame, category_id: int, at: Column) -> DataFrame:
    return active_promotions_at(promotions, at).where(F.array_contains("target_category_ids", category_id))


def name_like(df: DataFrame, column: str, pattern: str, key: str, k: int | None = 50) -> DataFrame:
    """Case-insensitive pattern match; the first ``k`` by key, all of them for ``k=None``."""
    found = df.where(F.col(column).ilike(pattern))
    return found if k is None else top_k(found, [], key, k)


def fuzzy_matches(df: DataFrame, columns: list[str], wanted: str, threshold: float = 0.3,
                  inclusive: bool = False) -> DataFrame:
    """Rows where a column is similar enough to ``wanted``, with the best similarity."""
    passing = [F.coalesce(text.similar_enough(F.col(c), wanted, threshold, inclusive), F.array().cast("array<double>"))
               for c in columns]
    scores = F.concat(*passing) if len(passing) > 1 else passing[0]
    best = F.when(F.size(scores) > 0, F.array(F.array_max(scores))) if len(passing) > 1 else scores
    return df.select("*", F.explode(best).alias("sim"))


def fuzzy_search(df: DataFrame, columns: list[str], wanted: str, key: str, k: int = 20,
                 threshold: float = 0.3, inclusive: bool = False) -> DataFrame:
    return top_k(fuzzy_matches(df, columns, wanted, threshold, inclusive), [F.desc_nulls_last("sim")], key, k)


def text_matches(df: DataFrame, weights: dict[str, float], wanted: str) -> DataFrame:
    """Rows with any of the wanted words and their relevance.

    The score adds, per field, weight times the share of the field's words that match.
    """
    terms = sorted({t for t in re.split(r"[\W_]+", wanted.lower()) if t})
    # A plain match test first: scores are then computed once, and for matching rows only.
    tests = [F.lower(F.col(c)).rlike(text.word_pattern(terms)) for c in weights]
    matching = df.where(reduce(Column.__or__, [F.coalesce(t, F.lit(False)) for t in tests]))
    score = F.lit(0.0)
    for column, weight in weights.items():
        score = score + text.term_share(F.coalesce(F.col(column), F.lit("")), terms) * float(weight)
    return matching.withColumn("score", score)


def text_search(df: DataFrame, weights: dict[str, float], wanted: str, key: str) -> DataFrame:
    """Matches by descending relevance, ties by key.

    A sort samples its input first; the exchange before it keeps the scores, so that the texts
    are not scored a second time for the sample.
    """
    scored = text_matches(df, weights, wanted).hint("rebalance")
    return scored.orderBy(F.desc("score"), F.asc(key))


def ranked_search(df: DataFrame, weights: dict[str, float], wanted: str, key: str, saturation: float = 1.2, by_length: float = 0.75) -> DataFrame:
    """(key, score) of rows with any of the wanted words in any accents, by descending relevance, ties by key.

    The relevance adds, per field and word, weight times BM25: rare words count more, repeats less and less, and
    long fields less than short ones. How often each word occurs and how long each field is is counted in one pass
    over the texts and written as a few numbers per row; the statistics of the corpus and the scores come from these.
    """
    terms, columns = sorted(set(text.folded_words(wanted))), list(weights)
    places = [(i, j) for i in range(len(columns)) for j in range(len(terms))]

    def counted(column: str, pattern: str) -> Column:
        return F.coalesce(F.regexp_count(F.lower(column), F.lit(pattern)), F.lit(0)).cast("double")

    counts = stored(df.select(
        key, *[counted(c, f"{text.WORD}+").alias(f"size{i}") for i, c in enumerate(columns)],
        *[counted(columns[i], text.folded_pattern(terms[j])).alias(f"tf{i}_{j}") for i, j in places]), "counts")
    corpus = counts.agg(F.struct(
        F.count("*").cast("double").alias("n"), *[F.avg(f"size{i}").alias(f"size{i}") for i in range(len(columns))],
        *[F.count_if(F.col(f"tf{i}_{j}") > 0).cast("double").alias(f"df{i}_{j}") for i, j in places])).scalar()
    matching = counts.where(reduce(Column.__or__, [F.col(f"tf{i}_{j}") > 0 for i, j in places], F.lit(False))).withColumn("corpus", corpus)
    score = F.lit(0.0)
    for i, j in places:
        tf, held = F.col(f"tf{i}_{j}"), F.col(f"corpus.df{i}_{j}")
        rare = F.ln(1 + (F.col("corpus.n") - held + 0.5) / (held + 0.5))
        long = 1 - by_length + by_length * F.col(f"size{i}") / F.col(f"corpus.size{i}")
        score = score + F.when(tf > 0, rare * tf * (saturation + 1) / (tf + saturation * long) * float(weights[columns[i]])).otherwise(0.0)
    return matching.select(key, score.alias("score")).orderBy(F.desc("score"), F.asc(key))


def inverted_index(df: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """(token, key, field, tf): how often each word occurs in each field."""
    fields = F.array(*[
        F.struct(F.lit(c).alias("field"), text.tokens(F.coalesce(F.col(c), F.lit(""))).alias("words"))
        for c in columns])
    words = df.select(key, F.explode(fields).alias("f")).select(
        key, F.col("f.field").alias("field"), F.explode("f.words").alias("token"))
    return words.groupBy("token", key, "field").agg(F.count("*").alias("tf"))


def heavy_products(products: DataFrame, grams: float) -> DataFrame:
    heavy = products.where(F.col("dimensions.weight_g") > F.lit(grams).cast("decimal(10,2)"))
    return heavy.withColumn("weight_g", F.col("dimensions.weight_g"))


def volume(dimensions: Column) -> Column:
    return dimensions["length_cm"] * dimensions["height_cm"] * dimensions["width_cm"]


def largest_products(products: DataFrame, k: int = 20) -> DataFrame:
    sized = products.where(F.col("dimensions").isNotNull()).withColumn("volume_cm3", volume(F.col("dimensions")))
    return top_k(sized, [F.desc_nulls_last("volume_cm3")], "product_id", k)


def open_orders(orders: DataFrame, as_of: Column, days: int = 7, k: int | None = 100) -> DataFrame:
    """Orders of the last days that are still under way, newest first."""
    bought = F.col("order_purchase_timestamp")
    recent = orders.where((bought >= dates.shift(as_of, -days, "day")) & F.col("order_status").isin(OPEN_STATUSES))
    return recent if k is None else top_k(recent, [F.desc_nulls_last("order_purchase_timestamp")], "order_id", k)


def orders_in_month(orders: DataFrame, as_of: Column) -> DataFrame:
    """Orders bought in the calendar month of ``as_of``."""
    start = F.date_trunc("month", as_of).cast("timestamp_ntz")
    bought = F.col("order_purchase_timestamp")
    return orders.where((bought >= start) & (bought < dates.shift(start, 1, "month")))


def catalog_filter(
    catalog: DataFrame, category: str | None = None, price: tuple[float | None, float | None] = (None, None),
    seller_id: str | None = None, tag: str | None = None, near: tuple[float, float, float] | None = None,
) -> DataFrame:
    """Faceted catalogue search; ``near`` is (lng, lat, km) around the buyer."""
    found = catalog
    if category is not None:
        found = found.where(F.col("category.name") == category)
    for bound, compare in zip(price, (Column.__ge__, Column.__le__)):
        if bound is not None:
            found = found.where(compare(F.col("price_current"), F.lit(bound).cast("decimal(14,2)")))
    if seller_id is not None:
        found = found.where(F.col("seller.id") == seller_id)
    if tag is not None:
        found = found.where(C.has_tag(F.col("tags"), tag))
    if near is not None:
        lng, lat, km = near
        found = found.where(geo.within_km(F.col("seller.geo"), geo.point(F.lit(lng), F.lit(lat)), km))
    return found


def promoted(catalog: DataFrame) -> DataFrame:
    return catalog.where("has_active_promotion").select(
        "product_id", "name", "price_current", "discount_percentage")


def reviews_for(reviews: DataFrame, product_id: str) -> DataFrame:
    """Reviews of one product, best score first."""
    mine = reviews.where(F.col("product_id") == product_id)
    return mine.orderBy(F.desc("score"), F.asc("review_id"))


def events_for(buckets: DataFrame, session_id: str) -> DataFrame:
    """Buckets of one session with the types of their events."""
    return buckets.where(F.col("session_id") == session_id).select(
        "bucket_hour", "event_count", F.col("events.type").alias("types"))


def session(sessions: DataFrame, session_id: str) -> DataFrame:
    return sessions.where(F.col("session_id") == session_id)
