"""Operators against straightforward Python on random inputs."""

import json
import math
import random
import re

import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from feira.functions import collections as C, dates, semistructured as J, text
from feira.operators import joins, sets, spatial, statistics, timelines
from feira.streaming import buckets

LIGHT = settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
scalars = st.none() | st.booleans() | st.integers(-3, 3) | st.sampled_from(["a", "b", "1"]) | st.sampled_from([0.5, 1.0])
documents = st.recursive(scalars, lambda inner: st.lists(inner, max_size=3) | st.dictionaries(
    st.sampled_from(["a", "b", "c d", "e'f"]), inner, max_size=3), max_leaves=6)
objects = st.dictionaries(st.sampled_from(["a", "b", "c d", "e'f"]), documents, max_size=3)


def contained(doc, wanted):
    if isinstance(wanted, dict):
        return isinstance(doc, dict) and all(k in doc and contained(doc[k], v) for k, v in wanted.items())
    if isinstance(wanted, list):
        return isinstance(doc, list) and all(any(contained(d, w) for d in doc) for w in wanted)
    if isinstance(wanted, bool) or isinstance(doc, bool):
        return isinstance(wanted, bool) and isinstance(doc, bool) and doc == wanted
    if isinstance(wanted, (int, float)):
        return isinstance(doc, (int, float)) and doc == wanted
    return type(doc) is type(wanted) and doc == wanted


@LIGHT
@given(st.lists(objects, min_size=1, max_size=8), objects)
def test_json_containment(spark, docs, wanted):
    df = spark.createDataFrame([(i, json.dumps(d)) for i, d in enumerate(docs)], "id int, doc string")
    found = df.where(J.contains(J.parse(F.col("doc")), wanted)).collect()
    assert {r.id for r in found} == {i for i, d in enumerate(docs) if contained(d, wanted)}


def test_json_path_edge_cases(spark):
    docs = ['{"n": 6}', '{"n": "6"}', '{"n": [1, 7]}', '{"n": null}', '{}', '{"n": 5.9}', "broken"]
    df = spark.createDataFrame([(i, d) for i, d in enumerate(docs)], "id int, doc string")
    found = df.where(J.path_compare(J.parse(F.col("doc")), "$.n", ">=", 6)).collect()
    assert {r.id for r in found} == {0, 2}


def python_trigrams(value):
    words = [w for w in re.split(r"[\W_]+", value.lower()) if w]
    return {f"  {w} "[i:i + 3] for w in words for i in range(len(w) + 1)}


@LIGHT
@given(st.lists(st.text(alphabet="abcé 1-_.", max_size=12), min_size=1, max_size=10), st.text(alphabet="abcé 1-", max_size=10))
def test_similarity(spark, values, wanted):
    df = spark.createDataFrame([(v,) for v in values], "v string")
    rows = df.select("v", text.similarity(F.col("v"), F.lit(wanted)).alias("s"),
                     text.similarity(F.lit(wanted), F.col("v")).alias("r")).collect()
    for row in rows:
        a, b = python_trigrams(row.v), python_trigrams(wanted)
        assert row.s == pytest.approx(len(a & b) / len(a | b) if a | b else 0.0)
        assert row.s == row.r and 0 <= row.s <= 1


def km(a, b):
    p, q = math.radians(a[1]), math.radians(b[1])
    h = math.sin((q - p) / 2) ** 2 + math.cos(p) * math.cos(q) * math.sin(math.radians(b[0] - a[0]) / 2) ** 2
    return 2 * 6371.0 * math.asin(min(1.0, math.sqrt(h)))


def places(kind, seed, n):
    r = random.Random(seed)
    if kind == "world":
        return [(r.uniform(-180, 180), r.uniform(-90, 90)) for _ in range(n)]
    if kind == "antimeridian":
        return [(((r.gauss(180, 0.5) + 180) % 360) - 180, r.gauss(0, 0.5)) for _ in range(n)]
    if kind == "pole":
        return [(r.uniform(-180, 180), 90 - abs(r.gauss(0, 0.6))) for _ in range(n)]
    # Most points crowd into one street, many share one exact spot.
    return [(r.gauss(-46.6, 0.002), r.gauss(-23.5, 0.002)) if r.random() < 0.6
            else (-46.6, -23.5) if r.random() < 0.5 else (r.gauss(-46.6, 0.4), r.gauss(-23.5, 0.4)) for _ in range(n)]


@pytest.mark.parametrize("kind,radius", [("world", 900), ("antimeridian", 60), ("pole", 80), ("crowd", 50)])
def test_radius_joins(spark, kind, radius):
    left, right = places(kind, 1, 60), places(kind, 2, 150)

    def frame(points, key, name):
        df = spark.createDataFrame([(f"{key}{i:03d}", *p) for i, p in enumerate(points)], f"{key} string, lng double, lat double")
        return df.select(key, F.struct("lng", "lat").alias(name))

    a, b = frame(left, "l", "a_geo"), frame(right, "r", "b_geo")
    near = {(f"l{i:03d}", f"r{j:03d}"): km(p, q) for i, p in enumerate(left) for j, q in enumerate(right) if km(p, q) <= radius}
    pairs = {(r.l, r.r) for r in spatial.pairs_within(a, "a_geo", b, "b_geo", radius).collect()}
    assert pairs == set(near) and pairs
    got = {(r.l, r.r): r["rank"] for r in spatial.nearest_within(a, "a_geo", b, "r", "b_geo", radius, 5).collect()}
    expected = {}
    for l in {k[0] for k in near}:
        mine = sorted((round(d, 6), k[1]) for k, d in near.items() if k[0] == l)[:5]
        expected.update({(l, r): i + 1 for i, (_, r) in enumerate(mine)})
    assert got == expected


@LIGHT
@given(st.lists(st.integers(0, 40), min_size=1, max_size=60))
def test_quantiles(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "v int")
    got = {r.probability: r.value for r in statistics.exact_quantiles(df, "v", [0.0, 0.25, 0.5, 0.75, 1.0]).collect()}
    for p, value in got.items():
        assert value == pytest.approx(np.quantile(values, p))
    assert len(got) == 5


def test_quantiles_with_a_hot_value(spark):
    df = spark.range(200_000).select(F.when(F.col("id") % 3 == 0, F.lit(7.0)).otherwise(F.sqrt("id")).alias("v"))
    values = np.array([r.v for r in df.collect()])
    for r in statistics.exact_quantiles(df, "v", [0.1, 0.25, 0.5, 0.9]).collect():
        assert r.value == pytest.approx(np.quantile(values, r.probability))


def test_histogram_puts_the_maximum_into_the_last_bin(spark):
    values = [0.0, 1.0, 2.5, 9.99, 10.0, 10.0]
    got = statistics.histogram(spark.createDataFrame([(v,) for v in values], "v double"), "v", 4)
    assert [r.n for r in got.orderBy("bin").collect()] == list(np.histogram(values, 4)[0])


@LIGHT
@given(st.lists(st.tuples(st.integers(0, 4), st.integers(0, 6), st.integers(0, 3)), max_size=25), st.randoms())
def test_upsert_ignores_order_and_repetition(spark, rows, rng):
    schema = "k int, at int, v int"
    half = len(rows) // 2
    first, second = rows[:half], rows[half:]

    def apply(*batches):
        table = spark.createDataFrame([], schema)
        for batch in batches:
            table = sets.upsert_latest(table, spark.createDataFrame(batch, schema), ["k"], ["at"])
        return sorted(map(tuple, table.collect()))

    once = apply(first, second)
    assert once == apply(second, first) == apply(first, second, second, first)
    assert {(k, at) for k, at, _ in once} == {(k, max(a for x, a, _ in rows if x == k)) for k, _, _ in rows}


@pytest.mark.parametrize("back", [True, False])
def test_neighbours_across_slices(spark, back):
    r = random.Random(5)
    rows = [("hot" if r.random() < 0.5 else f"k{r.randint(0, 5)}", r.randint(0, 400), i) for i in range(600)]
    df = spark.createDataFrame(rows, "k string, at int, i int")
    step = timelines.with_previous if back else timelines.with_next
    linked = step(df, ["k"], ["at", "i"], ["i"], F.floor(F.col("at") / 7), "other").collect()
    for key in {row[0] for row in rows}:
        line = sorted((at, i) for k, at, i in rows if k == key)
        links = {i: (line[n - 1][1] if n else None) if back else (line[n + 1][1] if n + 1 < len(line) else None)
                 for n, (_, i) in enumerate(line)}
        assert {x.i: (x.other.i if x.other else None) for x in linked if x.k == key} == links


def events(spark, rows):
    df = spark.createDataFrame(rows, "event_id long, session_id string, at string, type string")
    return df.select("event_id", "session_id", F.lit("c").alias("customer_unique_id"), "type",
                     F.col("at").cast("timestamp_ntz").alias("ts"), F.lit(0.0).alias("value"), F.lit("{}").alias("props"))


def test_crowded_buckets_split_and_keep_every_event(spark):
    rows = [(i, "hot" if i % 3 else "calm", f"2024-01-01 10:{i % 60:02d}:{i // 60:02d}", "search") for i in range(300)]
    documents = buckets.bucket_events(events(spark, rows), slot_minutes=5)
    got = documents.collect()
    assert sum(d.event_count for d in got) == 300
    assert len([d for d in got if d.session_id == "hot"]) > 1
    assert {e.event_id for d in got for e in d.events} == set(range(300))
    assert all(list(d.events) == sorted(d.events, key=lambda e: (e.ts, e.event_id)) for d in got)
    assert len({(d.session_id, d.bucket_hour, d.slot) for d in got}) == len(got)
    merged = buckets.merge_buckets(documents.unionByName(documents)).collect()
    assert sorted(d.event_count for d in merged) == [100, 200]


def test_session_gap_is_that_of_session_windows(spark):
    rows = [(1, "a", "2024-01-01 10:00:00", "search"), (2, "a", "2024-01-01 10:29:59", "search"),
            (3, "a", "2024-01-01 10:59:59", "page_view"), (4, "a", "2024-01-01 11:30:00", "order_completed")]
    got = buckets.sessions(events(spark, rows)).orderBy("session_no").collect()
    assert [(s.n_events, s.searches, s.orders) for s in got] == [(3, 2, 0), (1, 0, 1)]
    built_in = events(spark, rows).groupBy("session_id", F.session_window("ts", "30 minutes")).count()
    assert sorted(r["count"] for r in built_in.collect()) == [1, 3]


@LIGHT
@given(st.integers(-5, 5), st.integers(0, 5), st.sampled_from(["[)", "[]", "()", "(]"]),
       st.integers(-5, 5), st.integers(0, 5), st.sampled_from(["[)", "[]", "()", "(]"]))
def test_periods(spark, lo, length, bounds, lo2, length2, bounds2):
    def points(start, n, b):
        first, last = 2 * start + (0 if b[0] == "[" else 1), 2 * (start + n) - (0 if b[1] == "]" else 1)
        return set(range(first, last + 1))

    a = C.period(F.lit(lo), F.lit(lo + length), bounds)
    b = C.period(F.lit(lo2), F.lit(lo2 + length2), bounds2)
    row = spark.range(1).select(
        C.periods_overlap(a, b).alias("o"), C.period_is_empty(a).alias("e"),
        C.period_contains(a, F.lit(lo2)).alias("c")).first()
    # On half steps every open interval between two integers has a point of its own.
    p, q = points(lo, length, bounds), points(lo2, length2, bounds2)
    assert (row.o, row.e, row.c) == (bool(p & q), not p, 2 * lo2 in p)


def test_day_arithmetic(spark):
    df = spark.createDataFrame([("2024-01-02 00:00:00", "2024-01-01 23:00:00")], "a string, b string").select(
        F.col("a").cast("timestamp_ntz").alias("a"), F.col("b").cast("timestamp_ntz").alias("b"))
    row = df.select(dates.whole_days(F.col("a"), F.col("b")).alias("w"), dates.floor_days(F.col("a"), F.col("b")).alias("f")).first()
    assert (row.w, row.f) == (0, -1)
    mean = spark.createDataFrame([(1449360, 1), (-1449360, 1), (0, 0)], "s long, n long").select(
        dates.mean_days_of(F.col("s"), F.col("n")).alias("m")).collect()
    assert [str(r.m) for r in mean] == ["16.78", "-16.78", "None"]


def test_paths_stop_at_cycles(spark):
    deep = [(k, k - 1) for k in range(21, 50)]
    df = spark.createDataFrame([(1, None), (2, 1), (3, 2), (7, 8), (8, 7), (20, 99), *deep], "category_id int, parent_category_id int")
    got = {r.category_id: r for r in joins.category_paths(df).collect()}
    assert got[3].path == [1, 2, 3] and got[3].root_id == 1 and got[3].complete
    assert not got[7].complete and got[7].root_id is None and got[1].depth == 0
    assert got[49].root_id == 20 and got[49].depth == 29 and got[49].path == list(range(20, 50))


def test_ties_do_not_depend_on_the_order_of_rows(spark):
    rows = [("k", 1, {"a": 1, "b": 2}, "x"), ("k", 1, {"a": 3}, "y"), ("k", 1, {"b": 2, "a": 4}, "z"), ("k", 0, None, "w")]
    schema = "k string, at int, m map<string,int>, v string"
    found = set()
    for turn in range(3):
        df = spark.createDataFrame(rows[turn:] + rows[:turn], schema).selectExpr("*", "parse_json('{\"q\": 1}') AS j").coalesce(1)
        found.add(sets.latest_per_key(df, ["k"], ["at"]).first().v)
        found.add(sets.upsert_latest(df.limit(2), df, ["k"], ["at"]).first().v)
    assert len(found) == 1 and found != {"w"}


def test_matrix_has_a_column_per_customer_state(market):
    long = statistics.origin_destination(market.order, market.order_item, market.customer, market.seller, 3)
    wide = statistics.origin_destination_matrix(long)
    assert len(wide.columns) == 4 and wide.count() == 3
    assert sum(sum(r[1:]) for r in wide.collect()) == sum(r.n_items for r in long.collect())


def test_approximate_outliers_are_close(market):
    exact = statistics.iqr_outliers(market.order_item, "price").first()
    near = statistics.iqr_outliers(market.order_item, "price", approx=True).first()
    assert near.median == pytest.approx(exact.median, rel=0.01) and near.q3 == pytest.approx(exact.q3, rel=0.01)
