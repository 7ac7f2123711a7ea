"""Queries over places: distances, radius joins, centroids and zip lookup."""

from pyspark.sql import functions as F

from feira.functions import geo
from feira.operators import aggregates, joins, spatial
from feira.plans import delivery
from feira.queries.registry import query


def km(a: str, b: str) -> str:
    """SQL for the haversine distance between two aliases with lng and lat."""
    return (f"2 * 6371.0 * asin(sqrt(least(1.0, pow(sin((radians({b}.lat) - radians({a}.lat)) / 2), 2)"
            f" + cos(radians({a}.lat)) * cos(radians({b}.lat)) * pow(sin(radians({b}.lng - {a}.lng) / 2), 2))))")


@query("c4_pair_distance", f"""
SELECT customer_unique_id, seller_id, round({km('c', 's')}, 3) AS distance_km
FROM (SELECT DISTINCT o.customer_unique_id AS cid, i.seller_id AS sid FROM d_order o JOIN d_order_item i ON o.order_id = i.order_id) p
JOIN d_customer c ON c.customer_unique_id = p.cid JOIN d_seller s ON s.seller_id = p.sid""")
def c4(m):
    pairs = joins.order_lines(m.order, m.order_item).select("customer_unique_id", "seller_id").distinct()
    placed = joins.pair_distance(pairs, m.customer_geo, m.seller_geo)
    return placed.withColumn("distance_km", F.round("distance_km", 3))


def nearest(radius: int) -> str:
    return f"""
SELECT customer_unique_id, seller_id, round(d, 3) AS distance_km, CAST(r AS INT) AS rank FROM (
  SELECT customer_unique_id, seller_id, d,
         row_number() OVER (PARTITION BY customer_unique_id ORDER BY round(d, 6), seller_id) AS r
  FROM (SELECT c.customer_unique_id, s.seller_id, {km('c', 's')} AS d FROM d_customer c CROSS JOIN d_seller s) t
  WHERE d <= {radius}) u WHERE r <= 10"""


def _nearest(m, radius):
    found = spatial.nearest_within(m.customer_geo, "customer_geo", m.seller_geo, "seller_id", "seller_geo", radius)
    return found.select("customer_unique_id", "seller_id", F.round("distance_km", 3).alias("distance_km"), "rank")


@query("c5_sellers_within_50km", nearest(50))
def c5(m):
    return _nearest(m, 50)


@query("c5_sellers_within_800km", nearest(800))
def c5_wide(m):
    return _nearest(m, 800)


@query("c5_pairs_within_200km", f"""
SELECT customer_unique_id, seller_id, round(d, 3) AS distance_km
FROM (SELECT c.customer_unique_id, s.seller_id, {km('c', 's')} AS d FROM d_customer c CROSS JOIN d_seller s) t
WHERE d <= 200""")
def c5_pairs(m):
    customers, sellers = m.customer_geo.select("customer_unique_id", "customer_geo"), m.seller_geo.select("seller_id", "seller_geo")
    pairs = spatial.pairs_within(customers, "customer_geo", sellers, "seller_geo", 200, digits=3)
    return pairs.select("customer_unique_id", "seller_id", "distance_km")


LOOKED_UP = """(SELECT geolocation_zip_code_prefix AS zip, arg_min(geolocation_lng, geolocation_id) AS lng,
        arg_min(geolocation_lat, geolocation_id) AS lat FROM d_geolocation GROUP BY 1)"""


@query("c6_zip_lookup", f"""
SELECT c.customer_unique_id, CASE WHEN c.customer_state < 'NM' THEN c.lng ELSE g.lng END AS lng,
       CASE WHEN c.customer_state < 'NM' THEN c.lat ELSE g.lat END AS lat
FROM d_customer c LEFT JOIN {LOOKED_UP} g ON c.customer_zip_code_prefix = g.zip""")
def c6(m):
    known = F.when(F.col("customer_state") < "NM", F.col("customer_geo"))
    partly = m.customer_geo.withColumn("customer_geo", known)
    filled = joins.lookup_geo(partly, m.geolocation, "customer_zip_code_prefix", "customer_geo")
    return filled.select("customer_unique_id", "customer_geo.lng", "customer_geo.lat")


@query("k3_geo_enrichment", f"""
SELECT 'customer' AS kind, customer_unique_id AS id, g.lng, g.lat
FROM d_customer c LEFT JOIN {LOOKED_UP} g ON c.customer_zip_code_prefix = g.zip
UNION ALL SELECT 'seller', seller_id, g.lng, g.lat
FROM d_seller s LEFT JOIN {LOOKED_UP} g ON s.seller_zip_code_prefix = g.zip""")
def k3(m):
    blank = F.lit(None).cast("struct<lng:double,lat:double>")
    customers, sellers = delivery.enrich_geo(
        m.customer_geo.withColumn("customer_geo", blank), m.seller_geo.withColumn("seller_geo", blank), m.geolocation)
    buyers = customers.select(F.lit("customer").alias("kind"), F.col("customer_unique_id").alias("id"), "customer_geo.*")
    shops = sellers.select(F.lit("seller").alias("kind"), F.col("seller_id").alias("id"), "seller_geo.*")
    return buyers.unionByName(shops)


@query("d8_state_centroids", """
SELECT customer_state, count(*) AS n_customers,
       'POINT(' || CAST(CAST(CAST(sum(CAST(lng AS DECIMAL(9,6))) AS DOUBLE) / count(*) AS DECIMAL(12,4)) AS VARCHAR) || ' '
       || CAST(CAST(CAST(sum(CAST(lat AS DECIMAL(9,6))) AS DOUBLE) / count(*) AS DECIMAL(12,4)) AS VARCHAR) || ')' AS centroid
FROM d_customer GROUP BY 1""")
def d8(m):
    return aggregates.state_centroids(m.customer_geo)


ROUTES = """SELECT i.order_id, i.order_item_id, i.freight_value, """ + km("c", "s") + """ AS d
FROM d_order_item i JOIN d_order o ON i.order_id = o.order_id
JOIN d_customer c ON o.customer_unique_id = c.customer_unique_id JOIN d_seller s ON i.seller_id = s.seller_id"""


@query("k5_shipping_distance", f"""
SELECT order_id, order_item_id, freight_value, round(d, 3) AS distance_km FROM ({ROUTES}) t""")
def k5(m):
    routes = delivery.shipping_distance(m.order, m.order_item, m.customer_geo, m.seller_geo)
    return routes.select("order_id", "order_item_id", "freight_value", F.round("distance_km", 3).alias("distance_km"))


@query("k5_freight_by_distance", f"""
SELECT CAST(floor(round(d, 6) / 500) AS INT) * 500 AS band_km, count(*) AS n_items,
       CAST(CAST(sum(freight_value) AS DOUBLE) / count(*) AS DECIMAL(12,2)) AS mean_freight
FROM ({ROUTES}) t GROUP BY 1""")
def k5_bands(m):
    return delivery.freight_by_distance(
        delivery.shipping_distance(m.order, m.order_item, m.customer_geo, m.seller_geo), 500)


@query("h18_points", "SELECT seller_id, lng, lat FROM d_seller")
def h18(m):
    return m.seller.select("seller_id", geo.point(F.col("lng"), F.col("lat")).alias("p")).select("seller_id", "p.*")


@query("h19_sphere_distance", f"""
SELECT c.customer_unique_id, round({km('c', 's')}, 3) AS km_to_capital
FROM d_customer c, (SELECT -46.6388 AS lng, -23.5489 AS lat) s""")
def h19(m):
    capital = geo.point(F.lit(-46.6388), F.lit(-23.5489))
    distance = geo.distance_km(F.col("customer_geo"), capital)
    return m.customer_geo.select("customer_unique_id", F.round(distance, 3).alias("km_to_capital"))


A1, B1 = "atan(tan(radians(lat)) * (1 - 1/298.257223563))", "atan(tan(radians(-23.5489)) * (1 - 1/298.257223563))"


@query("h19_spheroid_distance", f"""
SELECT customer_unique_id, round(6378.137 * (g - (x + y) / (2 * 298.257223563)), 3) AS km_to_capital FROM (
  SELECT customer_unique_id, g,
    (g - sin(g)) * pow(sin((p + q) / 2), 2) * pow(cos((q - p) / 2), 2) / pow(cos(g / 2), 2) AS x,
    (g + sin(g)) * pow(cos((p + q) / 2), 2) * pow(sin((q - p) / 2), 2) / pow(sin(g / 2), 2) AS y
  FROM (SELECT customer_unique_id, p, q, 2 * asin(sqrt(pow(sin((q - p) / 2), 2)
               + cos(p) * cos(q) * pow(sin(radians(-46.6388 - lng) / 2), 2))) AS g
        FROM (SELECT customer_unique_id, lng, {A1} AS p, {B1} AS q FROM d_customer) t) u) v""")
def h19_spheroid(m):
    capital = geo.point(F.lit(-46.6388), F.lit(-23.5489))
    distance = geo.distance_km(F.col("customer_geo"), capital, "spheroid")
    return m.customer_geo.select("customer_unique_id", F.round(distance, 3).alias("km_to_capital"))
