"""Streams: late, repeated and failing records, restarts, and agreement with the batch forms."""

import pytest
from pyspark.sql import functions as F

from feira.functions import dates
from feira.operators.timelines import status_transitions
from feira.sources import tables
from feira.streaming import buckets, sync


class Feed:
    """A folder of JSON files read as a stream, one file per micro-batch."""

    def __init__(self, spark, folder, schema):
        self.spark, self.folder, self.schema, self.n = spark, folder, schema, 0
        folder.mkdir()

    def add(self, *rows):
        import json
        import os

        names = [c.split()[0] for c in self.schema.split(",")]
        path = self.folder / f"{self.n:04d}.json"
        path.write_text("\n".join(json.dumps(dict(zip(names, r))) for r in rows))
        os.utime(path, (1_700_000_000 + self.n * 10,) * 2)
        self.n += 1

    def stream(self):
        return self.spark.readStream.schema(self.schema).option("maxFilesPerTrigger", 1).json(str(self.folder))


def rows(df, *columns):
    return sorted(tuple(r[c] for c in columns) for r in df.collect())


def test_catalog_keeps_the_newest_whatever_the_order(spark, tmp_path):
    feed = Feed(spark, tmp_path / "in", "product_id string, price double, source_updated_at timestamp_ntz")
    feed.add(("p1", 5.0, "2024-01-05T00:00:00"), ("p2", 1.0, "2024-01-01T00:00:00"))
    feed.add(("p1", 3.0, "2024-01-03T00:00:00"), ("p2", 2.0, "2024-01-02T00:00:00"), ("p2", 1.5, "2024-01-01T12:00:00"))
    path, checkpoint = str(tmp_path / "log"), str(tmp_path / "checkpoint")
    sync.sync_catalog(feed.stream(), path, checkpoint).awaitTermination()
    assert rows(sync.read_catalog(spark, path), "product_id", "price") == [("p1", 5.0), ("p2", 2.0)]
    feed.add(("p1", 6.0, "2024-01-06T00:00:00"))
    sync.sync_catalog(feed.stream(), path, checkpoint).awaitTermination()
    assert rows(sync.read_catalog(spark, path), "product_id", "price") == [("p1", 6.0), ("p2", 2.0)]
    assert sync.compact_catalog(spark, path) == 3 and sync.compact_catalog(spark, path) == 0
    tables.vacuum(spark, path, keep=1)
    assert len(list((tmp_path / "log" / "data").iterdir())) == 1
    assert rows(sync.read_catalog(spark, path), "product_id", "price") == [("p1", 6.0), ("p2", 2.0)]
    # The same changes once more, as a restarted job without its checkpoint would send them.
    sync.sync_catalog(feed.stream(), path, str(tmp_path / "again")).awaitTermination()
    assert rows(sync.read_catalog(spark, path), "product_id", "price") == [("p1", 6.0), ("p2", 2.0)]


def test_failed_records_are_retried_then_alert(spark):
    batch = spark.createDataFrame([(1, 5.0, 0), (2, -1.0, 0), (3, -1.0, 2), (4, None, 1), (5, -1.0, 3)], "id int, price double, attempts int")
    routed = sync.with_dead_letter(batch, {"price_ok": F.col("price") >= 0})
    assert rows(routed, "id", "route", "attempts") == [(1, "valid", 1), (2, "retry", 1), (3, "retry", 3), (4, "valid", 2), (5, "alert", 4)]
    again = sync.with_dead_letter(routed.where("route = 'retry'").drop("route"), {"price_ok": F.col("price") >= 0})
    assert rows(again, "id", "route", "attempts") == [(2, "retry", 2), (3, "alert", 4)]


def test_newer_only(spark):
    target = spark.createDataFrame([("a", 5), ("b", 5)], "k string, at int")
    batch = spark.createDataFrame([("a", 4, 1), ("a", 5, 2), ("b", 6, 3), ("b", 7, 4), ("c", 1, 5)], "k string, at int, v int")
    assert rows(sync.newer_only(batch, target, ["k"], "at"), "k", "v") == [("b", 4), ("c", 5)]


SCHEMA = "order_id string, order_purchase_timestamp timestamp_ntz, step int, order_status string, changed_at timestamp_ntz"


def version(order, status, day, step=0):
    return order, "2024-01-01T00:00:00", step, status, f"2024-01-{day:02d}T00:00:00"


def test_status_log_over_several_batches(spark, tmp_path):
    feed = Feed(spark, tmp_path / "in", SCHEMA)
    feed.add(version("o1", "created", 1), version("o2", "created", 1), version("o1", "approved", 2))
    feed.add(version("o1", "approved", 3), version("o2", "approved", 3), version("o1", "created", 1))
    feed.add(version("o1", "shipped", 4), version("o3", "created", 4), version("o2", "approved", 5))
    path = str(tmp_path / "log")
    sync.log_status_changes(feed.stream(), path, str(tmp_path / "checkpoint")).awaitTermination()
    got = rows(sync.read_status_log(spark, path), "order_id", "to_status", "from_status")
    batch = spark.read.schema(SCHEMA).json(str(tmp_path / "in")).dropDuplicates()
    assert got == rows(status_transitions(batch), "order_id", "to_status", "from_status")
    assert ("o1", "shipped", "approved") in got and len(got) == 6
    assert sync.compact_status_log(spark, path) == 3
    assert rows(sync.read_status_log(spark, path), "order_id", "to_status", "from_status") == got
    feed.add(version("o2", "delivered", 9))
    sync.log_status_changes(feed.stream(), path, str(tmp_path / "checkpoint")).awaitTermination()
    assert ("o2", "delivered", "approved") in rows(sync.read_status_log(spark, path), "order_id", "to_status", "from_status")


EVENTS = "event_id long, session_id string, customer_unique_id string, type string, ts timestamp_ntz, value double, props string"


def event(i, minute, session="s", hour=10):
    return i, session, "c", "search", f"2024-01-01T{hour:02d}:{minute:02d}:00", 0.0, "{}"


def test_late_events_still_land_in_their_bucket(spark, tmp_path):
    feed = Feed(spark, tmp_path / "in", EVENTS)
    feed.add(event(1, 1), event(2, 2))
    feed.add(event(3, 5, hour=23))
    feed.add(event(4, 3), event(2, 2))
    path = str(tmp_path / "log")
    buckets.stream_buckets(feed.stream(), path, str(tmp_path / "checkpoint")).awaitTermination()
    merged = buckets.merge_buckets(buckets.read_buckets(spark, path))
    want = [(1, [3]), (3, [1, 2, 4])]
    assert sorted((d.event_count, [e.event_id for e in d.events]) for d in merged.collect()) == want
    assert buckets.compact_buckets(spark, path) == 3
    assert sorted((d.event_count, [e.event_id for e in d.events]) for d in buckets.read_buckets(spark, path).collect()) == want


@pytest.mark.parametrize("kind", ["facts", "sessions"])
def test_streams_equal_the_batch_however_late_events_are(spark, tmp_path, kind):
    feed = Feed(spark, tmp_path / "in", EVENTS)
    data = [event(i, (i * 7) % 60, f"s{i % 3}", 1 + i // 12) for i in range(120)]
    feed.add(event(999, 0, "end", 23))
    for at in (80, 0, 40):
        feed.add(*data[at:at + 40][::2])
    for at in (0, 80, 40):
        feed.add(*data[at:at + 40][1::2])
    add, read, batch, merge, columns = {
        "facts": (buckets.stream_bucket_facts, buckets.read_bucket_facts, buckets.bucket_facts, buckets.compact_bucket_facts,
                  ("session_id", "bucket_hour", "event_count", "duration_seconds")),
        "sessions": (buckets.stream_sessions, buckets.read_sessions, buckets.sessions, buckets.compact_sessions,
                     ("session_id", "started_at", "last_activity_at", "n_events", "searches")),
    }[kind]
    out = str(tmp_path / "out")

    def agrees():
        whole = spark.read.schema(EVENTS).json(str(tmp_path / "in"))
        assert rows(read(spark, out), *columns) == rows(batch(whole), *columns)

    add(feed.stream(), out, str(tmp_path / "checkpoint")).awaitTermination()
    agrees()
    assert merge(spark, out) == 7
    agrees()
    feed.add(event(1000, 59, "s1", 4), event(1001, 1, "new", 5))
    add(feed.stream(), out, str(tmp_path / "checkpoint")).awaitTermination()
    agrees()
    assert merge(spark, out) == 1
    agrees()


def test_late_versions_change_the_log(spark, tmp_path):
    feed = Feed(spark, tmp_path / "in", SCHEMA)
    feed.add(version("o1", "created", 1), version("o1", "shipped", 4))
    feed.add(version("o1", "approved", 2))
    feed.add(version("o1", "shipped", 3), version("o2", "created", 1))
    path = str(tmp_path / "log")
    sync.log_status_changes(feed.stream(), path, str(tmp_path / "checkpoint")).awaitTermination()
    got = [(r.to_status, r.changed_at.day) for r in sync.read_status_log(spark, path).where("order_id = 'o1'").orderBy("changed_at").collect()]
    assert got == [("created", 1), ("approved", 2), ("shipped", 3)]


def test_retries_are_replayed_until_they_alert(spark, tmp_path):
    feed = Feed(spark, tmp_path / "in", "id int, price double")
    feed.add((1, 5.0), (2, -1.0))
    path, rules = str(tmp_path / "out"), {"price_ok": F.col("price") >= 0}
    sync.route_records(feed.stream(), rules, path, str(tmp_path / "checkpoint")).awaitTermination()
    turns = 0
    while sync.replay_retries(spark, path, rules):
        turns += 1
    assert turns == 3 and rows(sync.read_routed(spark, path), "id", "route", "attempts") == [(1, "valid", 1), (2, "alert", 4)]


def test_expiry(spark):
    df = spark.createDataFrame([(1, "2024-01-01 00:00:00"), (2, "2024-01-02 00:00:00")], "id int, at string").withColumn(
        "expires_at", F.col("at").cast("timestamp_ntz"))
    assert rows(buckets.expire(df, dates.instant("2024-01-01 00:00:00")), "id") == [(2,)]
