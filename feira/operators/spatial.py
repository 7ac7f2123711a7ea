"""Radius joins over grid cells: an equality join on cells, refined by exact distance."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, functions as F

from feira.functions import geo
from feira.operators.sorting import top_k_per_group
from feira.session import tasks

# Each level halves the cell size: 13 levels reach from 50 km down to about 12 m.
LEVELS = 13
SLACK = 1 + 1e-9
# Rows of one point that go together, and pairs of rows that one share of a cell tries.
BUNDLE = 500
MOST_PAIRS = 20_000_000


def _reach(km: float, level: Column) -> Column:
    """Search radius of a level as an angle in radians."""
    return F.lit(km / geo.MEAN_RADIUS_KM * SLACK) / F.pow(F.lit(2.0), level)


def _band_edge(band: Column, reach: Column) -> Column:
    """Latitude in radians of the southern edge of a band."""
    return band * reach - math.pi / 2


def _cells_around(band: Column, reach: Column) -> Column:
    """Number of cells in a band; none is narrower than the longitude span of the radius there."""
    farthest = F.greatest(F.abs(_band_edge(band - 1, reach)), F.abs(_band_edge(band + 2, reach)))
    cosine = F.cos(F.least(farthest, F.lit(math.pi / 2)))
    sine = F.sin(F.least(reach, F.lit(math.pi / 2)))
    span = F.asin(F.least(sine / F.greatest(cosine, F.lit(1e-12)), F.lit(1.0))) * SLACK
    reaches_pole = cosine <= sine
    return F.when(reaches_pole, F.lit(1)).otherwise(
        F.greatest(F.floor(2 * math.pi / span), F.lit(1))).cast("long")


def _band(lat: Column, reach: Column) -> Column:
    return F.floor((F.radians(lat) + math.pi / 2) / reach).cast("long")


def _cell(lng: Column, cells: Column) -> Column:
    return F.pmod(F.floor((lng + 180) / 360 * cells).cast("long"), cells)


def _with_own_cell(df: DataFrame, place: str, km: float) -> DataFrame:
    """Adds the band and cell of a point at the row's level."""
    reach = _reach(km, F.col("level"))
    banded = df.withColumn("band", _band(F.col(place)["lat"], reach))
    return banded.withColumn("cell", _cell(F.col(place)["lng"], _cells_around(F.col("band"), reach)))


def _with_near_cells(df: DataFrame, place: str, km: float) -> DataFrame:
    """One row per cell that may hold points within the radius of the row's level, nine at most."""
    reach = _reach(km, F.col("level"))
    bands = df.withColumn("own", _band(F.col(place)["lat"], reach)).withColumn(
        "band", F.explode(F.array(F.col("own") - 1, F.col("own"), F.col("own") + 1)))
    counted = bands.withColumn("cells", _cells_around(F.col("band"), reach))
    here = _cell(F.col(place)["lng"], F.col("cells"))
    around = F.array_distinct(F.array(*[F.pmod(here + step, F.col("cells")) for step in (-1, 0, 1)]))
    return counted.withColumn("cell", F.explode(around)).drop("own", "cells")


def _safe_level(km: float) -> Column:
    """Finest level whose radius covers the whole own cell of the row, 0 if none does."""
    reach = _reach(km, F.col("level"))
    south, north = _band_edge(F.col("band"), reach), _band_edge(F.col("band") + 1, reach)
    nearest = F.when((south <= 0) & (north >= 0), F.lit(0.0)).otherwise(F.least(F.abs(south), F.abs(north)))
    width = F.lit(2 * math.pi) / _cells_around(F.col("band"), reach) * F.cos(nearest)
    extent = (reach + width) * geo.MEAN_RADIUS_KM * SLACK
    level = F.floor(F.log2(F.lit(km) / extent)).cast("int")
    return F.greatest(F.least(level, F.lit(LEVELS - 1)), F.lit(0))


def _bundles(df: DataFrame, place: str, rows: str) -> DataFrame:
    """One row per point, or per slice of a crowded one, that holds its rows, some ``BUNDLE`` at most, as an array."""
    placed = df.where(F.col(place).isNotNull()).select(F.col(place), F.struct("*").alias("row"))
    sizes = placed.groupBy(place).agg(F.ceil(F.count("*") / BUNDLE).alias("slices"))
    sliced = placed.join(sizes, place).withColumn("slice", F.pmod(F.xxhash64("row"), F.col("slices")))
    # Input that is already partitioned by point alone would keep all slices of a point in one task.
    return (sliced.repartition(place, "slice").groupBy(place, "slice").agg(F.collect_list("row").alias(rows))
            .select(F.col(place).alias(f"{rows}_at"), "slice", rows))


def pairs_within(left: DataFrame, left_geo: str, right: DataFrame, right_geo: str, km: float,
                 digits: int | None = None) -> DataFrame:
    """All pairs of rows at most ``km`` apart, with ``distance_km``, rounded to ``digits`` where given.

    Rows at one point share their distances: points meet on the grid, and only pairs of points that are near are
    opened to pairs of rows, in the same task, so no pair is shuffled. The right side, taken to be the smaller, is
    repeated for the neighbouring cells. A cell is cut into shares by its pairs of rows, and left points are dealt
    to the shares, since its bytes say little about the pairs that it lists.
    """
    cell, base = ["level", "band", "cell"], F.lit(0).alias("level")
    near = _with_own_cell(_bundles(left, left_geo, "_left").select("*", base), "_left_at", km)
    around = _with_near_cells(_bundles(right, right_geo, "_right").drop("slice").select("*", base), "_right_at", km)
    sizes = near.groupBy(*cell).agg(F.sum(F.size("_left")).alias("n")).join(
        around.groupBy(*cell).agg(F.sum(F.size("_right")).alias("m")), cell)
    shares = sizes.select(*cell, F.least(F.ceil(F.col("n") * F.col("m") / MOST_PAIRS), F.col("n")).cast("int").alias("shares"))
    dealt = near.join(shares, cell).withColumn("share", F.pmod(F.xxhash64("_left_at", "slice"), F.col("shares")).cast("int")).drop("shares")
    spread = around.join(shares, cell).withColumn("share", F.explode(F.sequence(F.lit(0), F.col("shares") - 1))).drop("shares")
    keys = [*cell, "share"]
    joined = dealt.repartition(tasks(left.sparkSession), *keys).join(spread.repartition(tasks(left.sparkSession), *keys), keys)
    found = joined.withColumn("distance_km", geo.distance_km(F.col("_left_at"), F.col("_right_at"))).where(F.col("distance_km") <= km)
    if digits is not None:
        found = found.withColumn("distance_km", F.round("distance_km", digits))
    opened = found.select(F.explode("_left").alias("_l"), "_right", "distance_km")
    return opened.select("_l", F.explode("_right").alias("_r"), "distance_km").select("_l.*", "_r.*", "distance_km")


def nearest_within(
    left: DataFrame, left_geo: str, right: DataFrame, right_key: str, right_geo: str, km: float, k: int = 10,
) -> DataFrame:
    """For each left row its ``k`` nearest right rows at most ``km`` away, ranked by distance and key.

    Crowded places are searched in smaller cells, so they do not pair everything with everything:

    * left rows at one point share one search, and of right rows at one point only the ``k``
      smallest keys can be among the nearest;
    * if the own cell of a left point at some level holds ``k`` right rows, the ``k`` nearest
      lie within that cell's extent, so the finest level whose radius covers it is searched.
    """
    places = left.where(F.col(left_geo).isNotNull()).select(F.col(left_geo).alias("from_geo")).distinct()
    targets = right.where(F.col(right_geo).isNotNull()).select(
        F.col(right_key), F.col(right_geo).alias("to_geo"), F.col(right_geo)["lng"].alias("x"),
        F.col(right_geo)["lat"].alias("y"))
    targets = top_k_per_group(targets, ["x", "y"], [F.asc(right_key)], k).drop("x", "y", "rank")

    levels = F.explode(F.sequence(F.lit(0), F.lit(LEVELS - 1))).alias("level")
    gridded = _with_own_cell(targets.select("*", levels), "to_geo", km)
    crowded = (gridded.groupBy("level", "band", "cell").agg(F.count("*").alias("n")).where(F.col("n") >= k)
               .select("level", "band", "cell", _safe_level(km).alias("search")))
    own = _with_own_cell(places.select("*", levels), "from_geo", km)
    searched = (own.join(crowded, ["level", "band", "cell"], "left")
                .groupBy("from_geo").agg(F.max(F.coalesce(F.col("search"), F.lit(0))).alias("level")))

    probes = _with_near_cells(searched, "from_geo", km)
    distance = geo.distance_km(F.col("from_geo"), F.col("to_geo"))
    found = (probes.join(gridded, ["level", "band", "cell"]).withColumn("distance_km", distance)
             .where(F.col("distance_km") <= km)
             .select("from_geo", F.col("from_geo.lng").alias("x"), F.col("from_geo.lat").alias("y"),
                     right_key, "distance_km"))
    ranked = top_k_per_group(found, ["x", "y"], [F.round("distance_km", 6), F.asc(right_key)], k)
    ranked = ranked.select("x", "y", right_key, "distance_km", "rank")
    keyed = left.withColumn("x", F.col(left_geo)["lng"]).withColumn("y", F.col(left_geo)["lat"])
    return keyed.join(ranked, ["x", "y"]).drop("x", "y")
