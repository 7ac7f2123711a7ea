"""Radius joins of crowded places."""

from pyspark.sql import functions as F

from feira.operators import spatial


def test_a_crowded_cell_is_dealt_to_shares(spark, monkeypatch):
    monkeypatch.setattr(spatial, "BUNDLE", 4)
    monkeypatch.setattr(spatial, "MOST_PAIRS", 50)

    def frame(key, n):
        return spark.range(n).select(F.col("id").alias(key), F.struct(F.lit(-46.6).alias("lng"), F.lit(-23.5).alias("lat")).alias(f"{key}_geo"))

    pairs = spatial.pairs_within(frame("l", 40), "l_geo", frame("r", 10), "r_geo", 50, digits=3)
    assert pairs.columns == ["l", "l_geo", "r", "r_geo", "distance_km"]
    found = pairs.select("l", "r", "distance_km", F.spark_partition_id().alias("task")).collect()
    assert {(r.l, r.r) for r in found} == {(l, r) for l in range(40) for r in range(10)} and len(found) == 400
    assert {r.distance_km for r in found} == {0.0} and len({r.task for r in found}) > 1
