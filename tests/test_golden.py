"""Operators over the small shop give the answers worked out by hand."""

import math
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from feira.functions import collections as C, dates, text
from feira.operators import aggregates, joins, search, spatial
from feira.plans import catalog, promotions, sales
from feira.streaming import buckets
from tests import mock


def ids(df, column="product_id"):
    return sorted(r[column] for r in df.collect())


def test_json_searches(spark):
    p, c = mock.products(spark), mock.categories(spark)
    assert ids(search.products_with(p, {"frame": "titanio"})) == [] and ids(search.products_with(p, {"frame": "inox"})) == ["T-5"]
    assert [(r.product_id, r.gears) for r in search.products_by_number(p, "gears", ">=", 8).collect()] == [("B-7", 8)]
    assert ids(search.products_by_spec(p, c, "lighting", {"fold": "bra"})) == []
    assert ids(search.products_by_spec(p, c, "lighting", {"fold": "brazo"})) == ["L-3"]


def test_array_searches(spark):
    p = mock.products(spark)
    tags = F.col("product_tags")
    assert ids(p.where(C.has_tag(tags, "ciudad"))) == ["B-7", "L-3"]
    assert ids(p.where(C.any_tag(tags, ["mesa", "aire libre", "nieve"]))) == ["L-3", "T-5"]
    assert ids(p.where(C.all_tags(tags, ["luz", "movilidad"]))) == []
    assert ids(p.where(C.no_elements(F.col("product_photos")))) == ["L-3"]


def test_promotions(spark):
    p, now = mock.promotions(spark), dates.instant(mock.NOW)
    assert ids(search.active_promotions_at(p, now), "promotion_id") == ["W"]
    december = dates.instant("2025-12-01 00:00:00"), dates.instant("2025-12-24 00:00:00")
    assert ids(search.overlapping_promotions(p, *december), "promotion_id") == []
    week = dates.instant("2025-11-27 00:00:00"), dates.instant("2025-11-30 00:00:00")
    assert ids(search.overlapping_promotions(p, *week), "promotion_id") == ["W"]
    assert ids(search.active_for_category(p, 10, now), "promotion_id") == []
    assert ids(search.active_for_category(p, 30, now), "promotion_id") == ["W"]


def test_prices(spark):
    def prices(at):
        frame = promotions.effective_price(mock.products(spark), mock.promotions(spark), dates.instant(at))
        return {r.product_id: (r.price_current, r.promotion_id) for r in frame.collect()}

    # 12.5 % off in winter, 40 % off in spring
    assert prices(mock.NOW) == {"B-7": (Decimal("1128.75"), "W"), "L-3": (Decimal("77.35"), "W"), "T-5": (Decimal("61.25"), None)}
    assert prices("2025-03-20 00:00:00")["T-5"] == (Decimal("36.75"), "S")


def test_places(spark):
    customers, sellers = mock.placed(spark)
    pairs = customers.select("customer_unique_id", F.lit("VD-9").alias("seller_id"))
    a, b, c, d = map(math.radians, (-19.9167, -43.9345, -25.4284, -49.2733))
    arc = 2 * math.asin(math.sqrt(math.sin((c - a) / 2) ** 2 + math.cos(a) * math.cos(c) * math.sin((d - b) / 2) ** 2))
    km = joins.pair_distance(pairs, customers, sellers).first().distance_km
    assert km == pytest.approx(arc * 6371, rel=1e-3) and 800 < km < 840
    assert joins.pair_distance(pairs, customers, sellers, "spheroid").first().distance_km == pytest.approx(km, rel=0.006)
    for radius, found in ((500, 0), (900, 1)):
        assert spatial.nearest_within(customers, "customer_geo", sellers, "seller_id", "seller_geo", radius).count() == found
    assert tuple(aggregates.state_centroids(customers).first()) == ("MG", 1, "POINT(-43.9345 -19.9167)")


def test_fuzzy(spark):
    p = mock.products(spark)
    found = search.fuzzy_search(p, ["name"], "bicicleta", "product_id").collect()
    # 10 trigrams of the word among 26 of the name
    assert [(r.product_id, round(r.sim, 4)) for r in found] == [("B-7", 0.3846)]
    assert ids(search.name_like(p, "name", "%montaña%", "product_id")) == ["T-5"]
    assert ids(search.fuzzy_search(p, ["name", "description"], "luz", "product_id")) == []
    one = spark.range(1).select(text.similarity(F.lit("red"), F.lit("red fox")).alias("s")).first()
    assert one.s == pytest.approx(4 / 8)


def test_dimensions(spark):
    p = mock.products(spark)
    assert [tuple(r) for r in search.heavy_products(p, 5000).select("product_id", "weight_g").collect()] == [("B-7", Decimal("13500.00"))]
    volumes = [(r.product_id, int(r.volume_cm3)) for r in search.largest_products(p).collect()]
    assert volumes == [("B-7", 140 * 95 * 25), ("L-3", 12 * 40 * 12), ("T-5", 9 * 31 * 9)]


def test_orders_and_summaries(spark):
    o, now = mock.orders(spark), dates.instant(mock.NOW)
    assert ids(search.orders_in_month(o, now), "order_id") == ["PED-1"]
    assert ids(search.open_orders(o, now), "order_id") == ["PED-1"]
    customers, _ = mock.placed(spark)
    assert sales.sales_by_category_month(o, mock.items(spark), mock.products(spark), mock.categories(spark)).count() == 0
    assert sales.customer_segments(o, mock.items(spark), customers, now).count() == 0


def test_documents(spark):
    _, sellers = mock.placed(spark)
    p, spring = mock.products(spark), "2025-03-20 00:00:00"
    sold = spark.createDataFrame([("PED-1", 1, "L-3", "VD-9")], "order_id string, order_item_id int, product_id string, seller_id string")
    full = catalog.product_catalog(
        p, mock.categories(spark), sellers, sold, mock.promotions(spark, spring), mock.reviews(spark), dates.instant(spring))
    doc = full.where("product_id = 'L-3'").first()
    assert doc.seller.id == "VD-9" and doc.category.name_english == "lighting"
    assert doc.rating.distribution["4"] == 1 and doc.rating["count"] == 1
    assert doc.active_promotion.name == "winter"
    assert set(ids(search.promoted(full))) == {"B-7", "L-3", "T-5"}
    assert ids(search.text_search(p, {"name": 10.0, "description": 1.0}, "lámpara lectura", "product_id")) == ["L-3"]
    assert [(r.review_id, r.score) for r in search.reviews_for(mock.reviews(spark), "L-3").collect()] == [("OPI-1", 4)]


def test_events(spark):
    bucket = search.events_for(buckets.bucket_events(mock.events(spark)), "visita_3").first()
    assert bucket.event_count == 4 and bucket.types == ["page_view", "add_to_cart", "add_to_cart", "order_completed"]
    session = search.session(buckets.user_sessions(mock.events(spark)), "visita_3").first()
    assert [(c.product_id, c.qty) for c in session.cart] == [("PROD_5", 2)]
