"""Queries over click events: buckets, sessions, retention, and the streams that fill them."""

from pyspark.sql import functions as F

from feira.functions import dates
from feira.operators import search
from feira.queries.registry import query
from feira.session import scratch_path
from feira.sources import tables
from feira.sources.domain import order_rows, order_versions, session_events
from feira.streaming import buckets, sync
from feira.queries.exploration import TRANSITIONS
from feira.queries.turns import run_turns

NOW = "2024-07-10 00:00:00"


def flat_buckets(documents):
    return documents.select(
        "session_id", "bucket_hour", "customer_unique_id", "event_count",
        F.array_join(F.col("events.type"), ",").alias("types"))


BUCKET_SQL = "SELECT session_id, bucket_hour, customer_unique_id, event_count, types FROM d_bucket"


@query("i1_event_buckets", BUCKET_SQL)
def i1(m):
    return flat_buckets(buckets.bucket_events(m.session_event))


@query("i1_crowded_buckets", """
WITH crowd AS (SELECT date_trunc('hour', ts) + (event_id % 3600) * INTERVAL '1' SECOND AS moment, event_id, type FROM d_event)
SELECT 'everyone' AS session_id, date_trunc('hour', moment) AS bucket_hour, CAST(minute(moment) // 5 AS INT) AS slot, count(*) AS event_count,
       string_agg(CAST(event_id AS VARCHAR), ',' ORDER BY moment, event_id) AS ids, CAST(1 AS BIGINT) AS n_documents
FROM crowd GROUP BY 2, 3""")
def i1_crowded(m):
    """All events in one session: slots of five minutes keep the key unique and the events in time order."""
    at = F.timestamp_add("SECOND", (F.col("event_id") % 3600).cast("int"), buckets.hour_of(F.col("ts")))
    crowd = m.session_event.withColumn("session_id", F.lit("everyone")).withColumn("ts", at)
    documents = buckets.bucket_events(crowd, slot_minutes=5)
    keys = documents.groupBy("session_id", "bucket_hour", "slot").agg(F.count("*").alias("n_documents"))
    ids = F.array_join(F.transform("events", lambda e: e["event_id"].cast("string")), ",")
    return documents.select("session_id", "bucket_hour", "slot", "event_count", ids.alias("ids")).join(
        keys, ["session_id", "bucket_hour", "slot"])


def late_turns(m):
    """The events in three turns; a third of the rows comes last, whatever their time."""
    parts = m.session_event.withColumn("turn", F.pmod(F.col("event_id") * 7, F.lit(3)))
    return [parts.where(F.col("turn") == turn).drop("turn") for turn in (2, 0, 1)]


@query("i1_stream_buckets", BUCKET_SQL)
def i1_stream(m):
    """Buckets filled by a stream, read back and merged."""
    path = scratch_path(m.spark, "buckets")
    stream = session_events(m.stream("events"))
    buckets.stream_buckets(stream, f"{path}/log", f"{path}/checkpoint").awaitTermination()
    return flat_buckets(buckets.merge_buckets(buckets.read_buckets(m.spark, f"{path}/log")))


FACTS = """SELECT session_id, bucket_hour, event_count, first_event_at, last_event_at,
       (epoch_us(last_event_at) - epoch_us(first_event_at)) // 1000000 AS duration_seconds, converted FROM d_bucket"""


@query("d12_bucket_facts", FACTS)
def d12(m):
    return buckets.bucket_facts(m.session_event)


@query("d12_stream_bucket_facts", FACTS)
def d12_stream(m):
    """Buckets filled by a stream with late events; all of them land."""
    return buckets.read_bucket_facts(m.spark, run_turns(m.spark, late_turns(m), "facts", buckets.stream_bucket_facts))


@query("b2_event_types", "SELECT session_id, bucket_hour, types FROM d_bucket")
def b2(m):
    return flat_buckets(buckets.bucket_events(m.session_event)).select("session_id", "bucket_hour", "types")


@query("b24_events_of_session", """
SELECT bucket_hour, event_count, types FROM d_bucket WHERE session_id = 'sess_7'""")
def b24(m):
    found = search.events_for(buckets.bucket_events(m.session_event), "sess_7")
    return found.withColumn("types", F.array_join("types", ","))


CARTS = """SELECT session_id, string_agg(product_id || ':' || CAST(qty AS VARCHAR), ',' ORDER BY product_id) AS cart FROM (
  SELECT session_id, 'PROD_' || json_extract_string(props, '$.k') AS product_id, count(*) AS qty FROM d_event
  WHERE type = 'add_to_cart' GROUP BY 1, 2) c GROUP BY 1"""
DOCUMENTS = f"""
SELECT a.session_id, customer_unique_id, last_activity_at, expires_at, cart FROM (
  SELECT session_id, min(customer_unique_id) AS customer_unique_id, max(ts) AS last_activity_at,
         max(ts) + INTERVAL '30' DAY AS expires_at FROM d_event GROUP BY 1) a
LEFT JOIN ({CARTS}) c ON a.session_id = c.session_id"""


def flat_sessions(documents):
    line = F.transform("cart", lambda c: F.concat_ws(":", c["product_id"], c["qty"].cast("string")))
    return documents.select(
        "session_id", "customer_unique_id", "last_activity_at", "expires_at", F.array_join(line, ",").alias("cart"))


@query("b25_session_lookup", f"SELECT * FROM ({DOCUMENTS}) d WHERE session_id = 'sess_7'")
def b25(m):
    return flat_sessions(search.session(buckets.user_sessions(m.session_event), "sess_7"))


@query("i3_session_documents", DOCUMENTS)
def i3_documents(m):
    return flat_sessions(buckets.user_sessions(m.session_event))


@query("i2_hour_of", "SELECT date_trunc('hour', ts) AS hour, count(*) AS n FROM d_event GROUP BY 1")
def i2(m):
    return m.session_event.groupBy(buckets.hour_of(F.col("ts")).alias("hour")).agg(F.count("*").alias("n"))


SESSIONS = """WITH marked AS (
  SELECT *, CASE WHEN ts - lag(ts) OVER w <= INTERVAL '30' MINUTE THEN 0 ELSE 1 END AS starts FROM d_event
  WINDOW w AS (PARTITION BY session_id ORDER BY ts, event_id)),
numbered AS (SELECT *, sum(starts) OVER (PARTITION BY session_id ORDER BY ts, event_id) AS session_no FROM marked),
visit AS (SELECT session_id, CAST(session_no AS INT) AS session_no, min(ts) AS started_at, max(ts) AS last_activity_at,
  count(*) AS n_events, count(*) FILTER (type = 'page_view') AS pages_viewed, count(*) FILTER (type = 'search') AS searches,
  count(*) FILTER (type = 'add_to_cart') AS cart_additions, count(*) FILTER (type = 'order_completed') AS orders
  FROM numbered GROUP BY 1, 2)
"""
VISIT = ["session_id", "session_no", "started_at", "last_activity_at", "n_events", "pages_viewed", "searches",
         "cart_additions", "orders"]


@query("i3_sessions", SESSIONS + "SELECT * FROM visit")
def i3(m):
    return buckets.sessions(m.session_event).select(*VISIT)


@query("i3_stream_sessions", SESSIONS + "SELECT * FROM visit")
def i3_stream(m):
    """Sessions of a stream with late events, which may extend or join earlier sessions."""
    path = run_turns(m.spark, late_turns(m), "sessions", buckets.stream_sessions)
    return buckets.read_sessions(m.spark, path).select(*VISIT)


@query("i4_retained_events", f"""
SELECT event_id, ts FROM d_event WHERE ts + INTERVAL '180' DAY > TIMESTAMP '{NOW}'""")
def i4(m):
    dated = m.session_event.withColumn("expires_at", dates.shift(F.col("ts"), buckets.EVENT_DAYS, "day"))
    return buckets.expire(dated, dates.instant(NOW)).select("event_id", "ts")


@query("i4_retained_sessions", """
SELECT session_id, max(ts) + INTERVAL '30' DAY AS expires_at FROM d_event GROUP BY 1
HAVING max(ts) + INTERVAL '30' DAY > TIMESTAMP '2024-02-29 12:00:00'""")
def i4_sessions(m):
    alive = buckets.expire(buckets.user_sessions(m.session_event), dates.instant("2024-02-29 12:00:00"))
    return alive.select("session_id", "expires_at")


def product_changes(parts):
    """Three versions of every product, not in the order of their instants."""
    versions = F.explode(F.array(*[F.struct(
        F.lit(day).alias("day"), F.lit(rise).cast("decimal(12,2)").alias("rise")) for day, rise in ((2, 5), (3, 9), (1, 1))]))
    return parts.select("p_partkey", "p_name", "p_retailprice", versions.alias("v")).select(
        F.concat(F.lit("PROD_"), F.col("p_partkey")).alias("product_id"), F.col("p_name").alias("name"),
        (F.col("p_retailprice").cast("decimal(12,2)") + F.col("v.rise")).cast("decimal(12,2)").alias("price_current"),
        (dates.instant("2001-07-01 00:00:00") + F.make_dt_interval(
            (F.col("p_partkey") % 20).cast("int") * 3 + F.col("v.day"))).alias("source_updated_at"))


CHANGES = """(SELECT concat('PROD_', CAST(p_partkey AS VARCHAR)) AS product_id, p_name AS name,
  CAST(CAST(p_retailprice AS DECIMAL(12,2)) + rise AS DECIMAL(12,2)) AS price_current,
  TIMESTAMP '2001-07-01 00:00:00' + (p_partkey % 20 * 3 + day) * INTERVAL '1' DAY AS source_updated_at
  FROM part CROSS JOIN (VALUES (2, 5), (3, 9), (1, 1)) v(day, rise))"""
LATEST = f"""SELECT product_id, name, price_current, source_updated_at FROM (
  SELECT *, row_number() OVER (PARTITION BY product_id ORDER BY source_updated_at DESC) AS r FROM {CHANGES} c) t WHERE r = 1"""


@query("i5_synced_catalog", LATEST)
def i5(m):
    """The catalogue after all changes have come through the stream."""
    path = scratch_path(m.spark, "catalog")
    sync.sync_catalog(product_changes(m.stream("part")), f"{path}/log", f"{path}/checkpoint").awaitTermination()
    return sync.read_catalog(m.spark, f"{path}/log")


RULES = ("""CASE WHEN source_updated_at IS NULL THEN 'dated' END, CASE WHEN NOT price_current >= 910 THEN 'priced' END,
  CASE WHEN NOT length(name) > 8 THEN 'named' END""")


def record_rules():
    return {"dated": F.col("source_updated_at").isNotNull(), "priced": F.col("price_current") >= 910,
            "named": F.length("name") > 8}


ROUTED = f"""
SELECT product_id, source_updated_at, attempts, broken, CASE WHEN broken = '' THEN 'valid' WHEN attempts > 3 THEN 'alert' ELSE 'retry' END AS route
FROM (SELECT *, concat_ws(',', {RULES}) AS broken,
             CAST(CAST(substring(product_id, 6) AS BIGINT) % 4 + 1 AS INT) AS attempts FROM {CHANGES} c) t"""


def tried(changes):
    """Changes with the number of earlier attempts."""
    return changes.withColumn("attempts", (F.substring("product_id", F.lit(6), F.lit(20)).cast("long") % 4).cast("int"))


def flat_routes(routed):
    return routed.select("product_id", "source_updated_at", "attempts", "route",
                         F.array_join("broken_rules", ",").alias("broken"))


@query("i6_dead_letter", ROUTED)
def i6(m):
    return flat_routes(sync.with_dead_letter(tried(product_changes(m.raw("part"))), record_rules()))


@query("i6_stream_dead_letter", ROUTED)
def i6_stream(m):
    path = scratch_path(m.spark, "routes")
    changes = tried(product_changes(m.stream("part")))
    sync.route_records(changes, record_rules(), f"{path}/out", f"{path}/checkpoint").awaitTermination()
    return flat_routes(m.spark.read.parquet(f"{path}/out"))


@query("i6_replayed", f"""
SELECT product_id, source_updated_at, CAST(CASE WHEN broken = '' THEN 1 ELSE 4 END AS INT) AS attempts, broken,
       CASE WHEN broken = '' THEN 'valid' ELSE 'alert' END AS route
FROM (SELECT *, concat_ws(',', {RULES}) AS broken FROM {CHANGES} c) t""")
def i6_replayed(m):
    """Records that stay broken are tried again three times, then alert."""
    path = scratch_path(m.spark, "replay")
    sync.route_records(product_changes(m.stream("part")), record_rules(), f"{path}/out", f"{path}/checkpoint").awaitTermination()
    while sync.replay_retries(m.spark, f"{path}/out", record_rules()):
        pass
    return flat_routes(sync.read_routed(m.spark, f"{path}/out"))


@query("i7_newer_only", f"""
SELECT b.product_id, b.price_current, b.source_updated_at FROM ({LATEST}) b
WHERE b.source_updated_at > TIMESTAMP '2001-08-01 00:00:00' OR CAST(substring(b.product_id, 6) AS BIGINT) % 3 = 0""")
def i7(m):
    """Changes against a target that holds two thirds of the products as of a fixed instant."""
    stored = m.product.select("product_id", dates.instant("2001-08-01 00:00:00").alias("source_updated_at")).where(
        "CAST(substring(product_id, 6) AS BIGINT) % 3 <> 0")
    found = sync.newer_only(product_changes(m.raw("part")), stored, ["product_id"], "source_updated_at")
    return found.select("product_id", "price_current", "source_updated_at")


@query("i8_status_log", TRANSITIONS + "SELECT * FROM log")
def i8(m):
    """The status log filled by a stream of order versions."""
    path = scratch_path(m.spark, "status")
    versions = order_versions(order_rows(m.stream("orders")))
    sync.log_status_changes(versions, f"{path}/log", f"{path}/checkpoint").awaitTermination()
    return sync.read_status_log(m.spark, f"{path}/log")


@query("i8_late_versions", TRANSITIONS + "SELECT * FROM log")
def i8_late(m):
    """Versions in reverse order of their steps, one batch each: late ones are logged like all others."""
    rows = order_versions(m.order)
    steps = sorted((r[0] for r in rows.select("step").distinct().collect()), reverse=True)  # a handful of statuses
    turns = (rows.where(F.col("step") == step) for step in steps)
    return sync.read_status_log(m.spark, run_turns(m.spark, turns, "status", sync.log_status_changes))


@query("i9_incremental_batches", "SELECT count(*) AS n_rows, count(DISTINCT event_id) AS n_events FROM d_event")
def i9(m):
    """Two scheduled runs over one checkpoint: the second finds nothing new and adds nothing."""
    path = scratch_path(m.spark, "runs")
    for _ in range(2):
        sync.run_available(session_events(m.stream("events")),
                           lambda batch, n: tables.append_batch(batch, f"{path}/log", n), f"{path}/checkpoint").awaitTermination()
    return tables.read_log(m.spark, f"{path}/log").agg(
        F.count("*").alias("n_rows"), F.count_distinct("event_id").alias("n_events"))


@query("i10_event_log", "SELECT CAST(ts AS DATE) AS day, count(*) AS n, CAST(sum(event_id) AS BIGINT) AS ids FROM d_event GROUP BY 1")
def i10(m):
    path = scratch_path(m.spark, "events")
    sync.append_events(session_events(m.stream("events")), f"{path}/log", f"{path}/checkpoint").awaitTermination()
    return m.spark.read.parquet(f"{path}/log").groupBy("day").agg(F.count("*").alias("n"), F.sum("event_id").alias("ids"))
