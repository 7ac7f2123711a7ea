"""Connected components of links between 64-bit keys, by alternating star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feira.session import scratch_path


def written(frame: DataFrame, purpose: str, compression: str | None = None) -> DataFrame:
    """The rows as a table in the shared folder: later steps read it, and lost executors don't undo it."""
    path = scratch_path(frame.sparkSession, purpose)
    frame.write.parquet(path, compression=compression)
    return frame.sparkSession.read.parquet(path)


def _star(links: DataFrame, large: bool) -> DataFrame:
    """Moves each link to the smallest neighbour: of larger ends (large star) or of smaller ends (small star)."""
    both = links.select("a", "b").union(links.select(F.col("b").alias("a"), F.col("a").alias("b"))) if large else \
        links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    joined = both.join(least, "a")
    if large:
        moved = joined.where(F.col("b") > F.col("a")).select(F.col("b").alias("a"), F.col("m").alias("b"))
    else:
        moved = joined.select(F.col("b").alias("a"), F.col("m").alias("b")).union(least.select("a", F.col("m").alias("b")))
    return moved.where("a <> b").distinct()


def components(links: DataFrame) -> DataFrame:
    """(key, root) for every key that occurs in links (a, b); root is the smallest key of its component."""
    links = written(links.where("a <> b").select("a", "b").distinct(), "links")
    before = None
    while True:
        links = written(_star(_star(links, True), False), "stars")
        state = links.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if state == before:
            return links.select(F.col("a").alias("key"), F.col("b").alias("root"))
        before = state
