"""Event buckets per session and hour, session windows, retention."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F
from pyspark.sql.streaming import StreamingQuery

from feira.functions import dates
from feira.sources.tables import append_batch, merge_log, read_log

EVENT_DAYS = 180
SESSION_DAYS = 30
GAP_MINUTES = 30
BUCKET_KEYS = ["session_id", "bucket_hour"]


def hour_of(ts: Column) -> Column:
    return dates.hour_start(ts)


def bucket_events(events: DataFrame, slot_minutes: int = 60) -> DataFrame:
    """One document per session, hour and slot of the hour, with its events in time order.

    The layout depends on the time of the events alone, never on how many there are. With the
    default a document holds a whole hour; where one session may fill an hour with very many
    events, shorter slots bound what a document, and the task that builds it, gathers.
    """
    slot = F.floor(F.minute("ts") / slot_minutes).cast("int")
    keyed = events.withColumn("bucket_hour", hour_of(F.col("ts"))).withColumn("slot", slot)
    entry = F.struct("ts", "event_id", "type", "value", "props")
    end = F.col("bucket_hour") + F.make_dt_interval(F.lit(EVENT_DAYS))
    return keyed.groupBy(*BUCKET_KEYS, "slot").agg(
        F.min("customer_unique_id").alias("customer_unique_id"), F.count("*").alias("event_count"),
        F.sort_array(F.collect_list(entry)).alias("events")).withColumn("expires_at", end)


def bucket_facts(events: DataFrame) -> DataFrame:
    """Per session and hour: events, first and last instant, seconds between, whether it ended in an order."""
    return events.groupBy("session_id", hour_of(F.col("ts")).alias("bucket_hour")).agg(
        F.count("*").alias("event_count"), F.min("ts").alias("first_event_at"), F.max("ts").alias("last_event_at"),
        F.timestamp_diff("SECOND", F.min("ts"), F.max("ts")).alias("duration_seconds"),
        F.bool_or(F.col("type") == "order_completed").alias("converted"))


def stream_bucket_facts(stream: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Adds the facts of every micro-batch to a log. However late an event is, its bucket gets it.

    No state is kept: a batch leaves one row per bucket it touches, and running it again replaces
    its own rows.
    """
    return _add_batches(stream, bucket_facts, path, checkpoint)


def read_bucket_facts(spark: SparkSession, path: str) -> DataFrame:
    """Facts of every bucket over all batches of the log."""
    return _merged_facts(read_log(spark, path))


def compact_bucket_facts(spark: SparkSession, path: str) -> int:
    """Adds up the batches of a log of facts to one; a stream may go on meanwhile."""
    return merge_log(spark, path, _merged_facts)


def _merged_facts(parts: DataFrame) -> DataFrame:
    return parts.groupBy(*BUCKET_KEYS).agg(
        F.sum("event_count").alias("event_count"), F.min("first_event_at").alias("first_event_at"),
        F.max("last_event_at").alias("last_event_at"),
        F.timestamp_diff("SECOND", F.min("first_event_at"), F.max("last_event_at")).alias("duration_seconds"),
        F.bool_or("converted").alias("converted"))


def _add_batches(stream: DataFrame, work, path: str, checkpoint: str) -> StreamingQuery:
    def add(batch: DataFrame, batch_id: int) -> None:
        append_batch(work(batch), path, batch_id, checkpoint)

    return stream.writeStream.foreachBatch(add).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def stream_buckets(stream: DataFrame, path: str, checkpoint: str, slot_minutes: int = 60) -> StreamingQuery:
    """Appends the bucket documents of every micro-batch to a log; late events simply add a document."""
    return _add_batches(stream, lambda batch: bucket_events(batch, slot_minutes), path, checkpoint)


def read_buckets(spark: SparkSession, path: str) -> DataFrame:
    """Documents of a bucket log: one row per session, hour, slot and batch."""
    return read_log(spark, path).drop("batch_id")


def compact_buckets(spark: SparkSession, path: str, slot_minutes: int = 60) -> int:
    """Merges the batches of a bucket log to one document per session, hour and slot."""
    return merge_log(spark, path, lambda rows: merge_buckets(rows, slot_minutes))


def merge_buckets(documents: DataFrame, slot_minutes: int = 60) -> DataFrame:
    """Documents of several batches as one per session, hour and slot; repeated events count once."""
    events = documents.select("session_id", "customer_unique_id", F.explode("events").alias("e")).select(
        "session_id", "customer_unique_id", "e.*").dropDuplicates(["session_id", "event_id"])
    return bucket_events(events, slot_minutes)


def session_slots(events: DataFrame, gap_minutes: int = GAP_MINUTES) -> DataFrame:
    """Counts per session name and slot of time as long as the gap; events of a slot share a session."""
    gap = gap_minutes * 60 * 1_000_000
    micros = F.unix_micros(F.col("ts").cast("timestamp"))
    slot = F.call_function("div", micros - F.pmod(micros, F.lit(gap)), F.lit(gap))
    return events.groupBy("session_id", slot.alias("slot")).agg(
        F.min("customer_unique_id").alias("customer_unique_id"), F.min("ts").alias("first_at"),
        F.max("ts").alias("last_at"), F.count("*").alias("n_events"), *[
            F.count_if(F.col("type") == kind).alias(name) for kind, name in KINDS.items()])


def _sessions_of(slots: DataFrame, gap_minutes: int) -> DataFrame:
    gap = gap_minutes * 60 * 1_000_000
    by_time = Window.partitionBy("session_id").orderBy("slot")
    quiet = dates.micros_between(F.lag("last_at").over(by_time), F.col("first_at"))
    starts = F.coalesce((quiet > gap).cast("int"), F.lit(1))
    numbered = slots.withColumn("starts", starts).withColumn("session_no", F.sum("starts").over(by_time).cast("int"))
    return numbered.groupBy("session_id", "session_no").agg(
        F.min("customer_unique_id").alias("customer_unique_id"), F.min("first_at").alias("started_at"),
        F.max("last_at").alias("last_activity_at"),
        dates.shift(F.max("last_at"), gap_minutes, "minute").alias("active_until"),
        dates.shift(F.max("last_at"), SESSION_DAYS, "day").alias("expires_at"),
        F.sum("n_events").alias("n_events"), *[F.sum(name).alias(name) for name in KINDS.values()])


def sessions(events: DataFrame, gap_minutes: int = GAP_MINUTES) -> DataFrame:
    """Sessions that end after ``gap_minutes`` without activity, with counts by kind of event.

    An event exactly at the end still belongs to the session, as in Spark's session windows.

    Events in one slot as long as the gap always share a session, so they are merged before the
    shuffle; what is ordered per visitor is at most one row per slot, also for a hot one.
    """
    return _sessions_of(session_slots(events, gap_minutes), gap_minutes)


KINDS = {"page_view": "pages_viewed", "search": "searches", "add_to_cart": "cart_additions", "order_completed": "orders"}


def stream_sessions(stream: DataFrame, path: str, checkpoint: str, gap_minutes: int = GAP_MINUTES) -> StreamingQuery:
    """Adds the session slots of every micro-batch to a log; late events may still join two sessions."""
    return _add_batches(stream, lambda batch: session_slots(batch, gap_minutes), path, checkpoint)


def read_sessions(spark: SparkSession, path: str, gap_minutes: int = GAP_MINUTES) -> DataFrame:
    """Sessions over all batches of a slot log."""
    return _sessions_of(_merged_slots(read_log(spark, path)), gap_minutes)


def compact_sessions(spark: SparkSession, path: str) -> int:
    """Adds up the batches of a slot log to one; a stream may go on meanwhile."""
    return merge_log(spark, path, _merged_slots)


def _merged_slots(parts: DataFrame) -> DataFrame:
    return parts.groupBy("session_id", "slot").agg(
        F.min("customer_unique_id").alias("customer_unique_id"), F.min("first_at").alias("first_at"),
        F.max("last_at").alias("last_at"), F.sum("n_events").alias("n_events"),
        *[F.sum(name).alias(name) for name in KINDS.values()])


def cart_lines(events: DataFrame) -> DataFrame:
    """Products put into the cart per session with quantities; the product is named in the event's properties."""
    added = events.where(F.col("type") == "add_to_cart")
    product = F.concat(F.lit("PROD_"), F.get_json_object("props", "$.k"))
    return added.groupBy("session_id", product.alias("product_id")).agg(F.count("*").alias("qty"))


def user_sessions(events: DataFrame) -> DataFrame:
    """One document per session name: activity, expiry and cart (one entry per product)."""
    activity = events.groupBy("session_id").agg(
        F.min("customer_unique_id").alias("customer_unique_id"), F.min("ts").alias("started_at"),
        F.max("ts").alias("last_activity_at"), dates.shift(F.max("ts"), SESSION_DAYS, "day").alias("expires_at"))
    cart = cart_lines(events).groupBy("session_id").agg(
        F.sort_array(F.collect_list(F.struct("product_id", "qty"))).alias("cart"))
    return activity.join(cart, "session_id", "left")


def expire(df: DataFrame, as_of: Column, column: str = "expires_at") -> DataFrame:
    """Rows whose time of expiry is still ahead."""
    return df.where(F.col(column) > as_of)
