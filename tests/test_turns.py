"""Turns of a stream: many files each, one batch each, and histories that come together."""

from pathlib import Path

from pyspark.sql import functions as F

from feira.functions import dates
from feira.queries.turns import run_turns
from feira.sources import tables
from feira.streaming import sync


def test_a_turn_is_one_batch_of_many_files(spark):
    turns = [spark.range(k, k + 8, 1, 4).select(F.lit("p").alias("product_id"), F.lit(5).alias("score")) for k in (0, 8)]
    path = run_turns(spark, turns, "turns", lambda stream, log, checkpoint: sync.stream_ratings(stream, "product_id", log, checkpoint))
    assert len(list(Path(path).parent.glob("in/*.parquet"))) == 8
    assert sorted(r[0] for r in tables.read_log(spark, path).select("batch_id").distinct().collect()) == [0, 1]
    assert sync.read_ratings(spark, path, "product_id").first()["n_reviews"] == 16


def test_status_history_comes_together_in_one_shuffle(spark):
    at = dates.instant("2024-01-01 00:00:00")
    first = spark.createDataFrame([("o1", "created", 0), ("o2", "created", 0), (None, "created", 0)], "order_id string, order_status string, step int")
    second = spark.createDataFrame([("o1", "shipped", 1), (None, "shipped", 1)], first.schema)
    turns = [t.select("order_id", at.alias("order_purchase_timestamp"), "order_status", at.alias("changed_at"), "step") for t in (first, second)]
    log = sync.read_status_log(spark, run_turns(spark, turns, "status", sync.log_status_changes))
    assert sorted((r.order_id, r.from_status or "", r.to_status) for r in log.collect()) == [
        ("o1", "", "created"), ("o1", "created", "shipped"), ("o2", "", "created")]
    assert "Join" not in log._jdf.queryExecution().optimizedPlan().toString()
