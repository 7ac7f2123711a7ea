"""Points and distances on the globe as plain expressions over ``struct(lng, lat)``."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

MEAN_RADIUS_KM = 6371.0
# WGS 84 ellipsoid
EQUATOR_RADIUS_KM = 6378.137
FLATTENING = 1 / 298.257223563


def point(lng: Column, lat: Column) -> Column:
    """Point, or NULL if a coordinate is missing."""
    lng, lat = lng.cast("double"), lat.cast("double")
    return F.when(lng.isNotNull() & lat.isNotNull(), F.struct(lng.alias("lng"), lat.alias("lat")))


def sphere_km(a: Column, b: Column) -> Column:
    """Great-circle distance by the haversine formula."""
    lat1, lat2 = F.radians(a["lat"]), F.radians(b["lat"])
    half_lat = F.sin((lat2 - lat1) / 2)
    half_lng = F.sin(F.radians(b["lng"] - a["lng"]) / 2)
    h = half_lat * half_lat + F.cos(lat1) * F.cos(lat2) * half_lng * half_lng
    return F.asin(F.sqrt(F.least(h, F.lit(1.0)))) * (2 * MEAN_RADIUS_KM)


def spheroid_km(a: Column, b: Column) -> Column:
    """Ellipsoid distance with the first-order flattening correction of Andoyer and Lambert."""
    p = F.atan(F.tan(F.radians(a["lat"])) * (1 - FLATTENING))
    q = F.atan(F.tan(F.radians(b["lat"])) * (1 - FLATTENING))
    half_lat = F.sin((q - p) / 2)
    half_lng = F.sin(F.radians(b["lng"] - a["lng"]) / 2)
    h = half_lat * half_lat + F.cos(p) * F.cos(q) * half_lng * half_lng
    sigma = F.asin(F.sqrt(F.least(h, F.lit(1.0)))) * 2
    mean, half = (p + q) / 2, (q - p) / 2
    x = (sigma - F.sin(sigma)) * F.pow(F.sin(mean) * F.cos(half) / F.cos(sigma / 2), F.lit(2))
    y = (sigma + F.sin(sigma)) * F.pow(F.cos(mean) * F.sin(half) / F.sin(sigma / 2), F.lit(2))
    corrected = (sigma - (x + y) * (FLATTENING / 2)) * EQUATOR_RADIUS_KM
    return F.when(sigma == 0, F.lit(0.0)).otherwise(corrected)


def distance_km(a: Column, b: Column, method: str = "sphere") -> Column:
    return {"sphere": sphere_km, "spheroid": spheroid_km}[method](a, b)


def within_km(a: Column, b: Column, km: float) -> Column:
    return distance_km(a, b) <= km


def centroid(lng: Column, lat: Column) -> Column:
    """Aggregate: mean position, summed as exact decimals so the result has no order effects."""
    def mean(c: Column) -> Column:
        return F.sum(c.cast("decimal(9,6)")).cast("double") / F.count(c).cast("double")

    return F.struct(mean(lng).alias("lng"), mean(lat).alias("lat"))


def point_text(p: Column, scale: int = 6) -> Column:
    """``POINT(lng lat)`` with a fixed number of decimals."""
    kind = f"decimal(12,{scale})"
    return F.format_string("POINT(%s %s)", p["lng"].cast(kind).cast("string"), p["lat"].cast(kind).cast("string"))
