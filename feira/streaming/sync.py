"""Synchronisation of the catalogue and status logs by micro-batches."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F
from pyspark.sql.streaming import StreamingQuery

from feira.functions import dates
from feira.operators.aggregates import add_rating_parts, merge_ratings, rating_parts
from feira.operators.sets import latest_per_key
from feira.operators.timelines import with_previous_status
from feira.sources.tables import append_batch, has_batches, merge_log, read_latest, read_log

CATALOG_KEYS, CATALOG_ORDER = ["product_id"], ["source_updated_at"]
LOG_SCHEMA = ("order_id string, order_purchase_timestamp timestamp_ntz, from_status string, to_status string,"
              "changed_at timestamp_ntz, step int, batch_id long, order_month date")


def run_available(stream: DataFrame, sink: Callable[[DataFrame, int], None], checkpoint: str) -> StreamingQuery:
    """Processes what has arrived since the last run, then stops; call it on a schedule."""
    return (stream.writeStream.foreachBatch(sink).option("checkpointLocation", checkpoint)
            .trigger(availableNow=True).start())


def append_events(stream: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Append-only event log as Parquet, one folder per day."""
    dated = stream.withColumn("day", F.col("ts").cast("date"))
    return (dated.writeStream.format("parquet").partitionBy("day").option("path", path)
            .option("checkpointLocation", checkpoint).outputMode("append").trigger(availableNow=True).start())


def stream_ratings(reviews: DataFrame, key: str, path: str, checkpoint: str) -> StreamingQuery:
    """Adds what the reviews since the last run mean for each key; a batch run again replaces its part."""
    return run_available(
        reviews, lambda batch, batch_id: append_batch(rating_parts(batch, key), path, batch_id, checkpoint), checkpoint)


def read_ratings(spark: SparkSession, path: str, key: str) -> DataFrame:
    """Ratings over all batches."""
    return merge_ratings(read_log(spark, path), key)


def compact_ratings(spark: SparkSession, path: str, key: str) -> int:
    """Adds up the batches of a rating log to one."""
    return merge_log(spark, path, lambda rows: add_rating_parts(rows, key))


def newer_only(batch: DataFrame, target: DataFrame, keys: list[str], order: str) -> DataFrame:
    """Newest row per key of the batch, without those that are not newer than the target's."""
    newest = latest_per_key(batch, keys, [order])
    stored = target.groupBy(*keys).agg(F.max(order).alias("stored_at"))
    joined = newest.join(stored, keys, "left")
    return joined.where(F.col("stored_at").isNull() | (F.col(order) > F.col("stored_at"))).drop("stored_at")


def sync_catalog(changes: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Applies product changes to the catalogue kept at ``path``.

    Each batch is reduced to its newest document per product and added under its batch id.
    Reading takes the newest document over all batches, so late or repeated batches and
    retries never put an older document over a newer one.
    """
    def apply(batch: DataFrame, batch_id: int) -> None:
        append_batch(latest_per_key(batch, CATALOG_KEYS, CATALOG_ORDER), path, batch_id, checkpoint)

    return run_available(changes, apply, checkpoint)


def read_catalog(spark: SparkSession, path: str) -> DataFrame:
    return read_latest(spark, path, CATALOG_KEYS, CATALOG_ORDER)


def compact_catalog(spark: SparkSession, path: str) -> int:
    """Merges the batches of the catalogue to the newest document per product; a stream may go on meanwhile."""
    return merge_log(spark, path, lambda rows: latest_per_key(rows.drop("batch_id"), CATALOG_KEYS, CATALOG_ORDER))


def with_dead_letter(batch: DataFrame, rules: dict[str, Column], max_retries: int = 3) -> DataFrame:
    """Adds ``route``: valid, retry or alert, with the broken rules and the number of attempts.

    A rule that gives NULL passes. A record that still fails after ``max_retries`` retries alerts.
    """
    broken = F.array_compact(F.array(*[F.when(~rule, F.lit(name)) for name, rule in rules.items()]))
    attempts = F.col("attempts") if "attempts" in batch.columns else F.lit(0)
    tried = batch.withColumn("broken_rules", broken).withColumn("attempts", attempts + 1)
    route = (F.when(F.size("broken_rules") == 0, "valid")
             .when(F.col("attempts") > max_retries, "alert").otherwise("retry"))
    return tried.withColumn("route", route)


def _write_routed(routed: DataFrame, folder: str) -> None:
    routed.hint("rebalance", "route").write.mode("overwrite").partitionBy("route").parquet(folder)


def route_records(stream: DataFrame, rules: dict[str, Column], path: str, checkpoint: str,
                  max_retries: int = 3) -> StreamingQuery:
    """Writes each micro-batch below ``path`` by route: valid records, retries and alerts."""
    def split(batch: DataFrame, batch_id: int) -> None:
        _write_routed(with_dead_letter(batch, rules, max_retries), f"{path}/turn=0/batch_id={batch_id}")

    return run_available(stream, split, checkpoint)


def replay_retries(spark: SparkSession, path: str, rules: dict[str, Column], max_retries: int = 3) -> bool:
    """Tries the waiting records again, in a turn of their own; false if none were waiting.

    Records of a turn count as done once the next turn exists, so a turn that is run again after a
    failure replaces its own result.
    """
    routed = spark.read.parquet(path)
    turn = routed.agg(F.max("turn")).first()[0]
    waiting = routed.where((F.col("turn") == turn) & (F.col("route") == "retry"))
    if waiting.isEmpty():
        return False
    again = with_dead_letter(waiting.drop("turn", "batch_id", "route", "broken_rules"), rules, max_retries)
    _write_routed(again, f"{path}/turn={turn + 1}/batch_id=0")
    return True


def read_routed(spark: SparkSession, path: str) -> DataFrame:
    """Where every record is now: retries only of the last turn."""
    routed = spark.read.parquet(path)
    last = routed.agg(F.max("turn")).scalar()
    return routed.where((F.col("route") != "retry") | (F.col("turn") == last)).drop("turn", "batch_id")


def log_status_changes(versions: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Status log of a stream of order versions; late versions are logged like all others.

    A batch leaves the whole history of the orders it touches, which is a handful of versions each:
    those logged before and its own, brought together by one shuffle. Only the purchase months present in the batch are read, whose
    number is bounded by the calendar. Reading takes the newest history of an order. A batch that is
    run again replaces its lines and ignores lines of later batches.
    """
    def add(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        month = dates.month_start(F.col("order_purchase_timestamp"))
        columns = ["order_id", "order_purchase_timestamp", "order_status", "changed_at", "step"]
        batch = batch.select(*columns, month.alias("order_month"))
        months = [r[0] for r in batch.select("order_month").distinct().collect()]
        before = _log(spark, path, {str(month) for month in months}).where(
            F.col("order_id").isNotNull() & (F.col("batch_id") < batch_id)).withColumnRenamed("to_status", "order_status")
        rows = before.select(*columns, "batch_id").unionByName(batch.select(*columns, F.lit(batch_id).cast("long").alias("batch_id")))
        by_order, number = Window.partitionBy("order_id"), F.col("batch_id")
        marked = rows.withColumns({"last": F.max(F.when(number < batch_id, number)).over(by_order), "newest": F.max(number).over(by_order)})
        history = marked.where((F.col("newest") == batch_id) & ((number == batch_id) | (number == F.col("last"))))
        linked = with_previous_status(history.select(*columns).distinct())
        log = linked.select("order_id", "order_purchase_timestamp", "from_status", F.col("order_status").alias("to_status"),
                            "changed_at", "step", month.alias("order_month"))
        append_batch(log, path, batch_id, checkpoint, "order_month")

    return run_available(versions, add, checkpoint)


def compact_status_log(spark: SparkSession, path: str) -> int:
    """Keeps the newest history of each order in one batch, by purchase month."""
    return merge_log(spark, path, lambda rows: _newest(rows).drop("batch_id"), "order_month")


def _log(spark: SparkSession, path: str, months: set[str] | None = None) -> DataFrame:
    if not has_batches(spark, path):
        return spark.createDataFrame([], LOG_SCHEMA)
    return read_log(spark, path, months)


def _newest(log: DataFrame) -> DataFrame:
    """The lines of the last batch that touched each order."""
    last = F.max("batch_id").over(Window.partitionBy("order_id"))
    return log.where(F.col("order_id").isNotNull()).withColumn("last", last).where(F.col("batch_id") == F.col("last")).drop("last")


def read_status_log(spark: SparkSession, path: str) -> DataFrame:
    """The initial status and every real change of all orders."""
    lines = _newest(_log(spark, path)).where(~F.col("from_status").eqNullSafe(F.col("to_status")))
    return lines.drop("batch_id", "order_month")
