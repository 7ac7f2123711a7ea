"""Files, documents, partitions, archives and published summaries."""

from datetime import datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from feira.operators import quality, sets
from feira.plans import report
from feira.schemas import SOURCE_COLUMNS
from feira.session import scratch_path
from feira.sources import files, rejects, tables


def test_all_source_files(spark, tmp_path):
    samples = {"string": "x", "int": "7", "timestamp_ntz": "2018-01-02 03:04:05"}
    for name, columns in SOURCE_COLUMNS.items():
        folder = tmp_path / name
        folder.mkdir()
        good = [samples.get(kind, "1.25") for _, kind in columns]
        bad = ["never" if kind == "timestamp_ntz" else value for (_, kind), value in zip(columns, good)]
        lines = [",".join(c for c, _ in columns), ",".join(good), ",".join(bad), ",".join("" for _ in columns)]
        (folder / "part.csv").write_text("\n".join(lines) + "\n")
        df = files.read_source(spark, str(tmp_path), name)
        assert [(f.name, f.dataType.simpleString()) for f in df.schema.fields] == columns
        first, second = df.collect()[:2]
        for column, kind in columns:
            if kind == "timestamp_ntz":
                assert first[column] == datetime(2018, 1, 2, 3, 4, 5) and second[column] is None
            elif kind.startswith("decimal"):
                assert first[column] == Decimal("1.25")


def test_nested_documents(spark, tmp_path):
    path = tmp_path / "events.json"
    path.write_text("""{
      "_id": {"$oid": "0b1c"}, "session_id": "v", "bucket_hour": {"$date": "2025-03-09T07:00:00Z"}, "event_count": 2,
      "events": [{"seq": 1, "type": "page_view", "query": "lamp", "ts": {"$date": "2025-03-09T07:31:40Z"}},
                 {"seq": 2, "type": "order_completed", "total": 8840, "ts": {"$date": "2025-03-09T07:44:01Z"}}],
      "bucket_metadata": {"first_event_at": {"$date": "2025-03-09T07:31:40Z"}, "converted": true}}""")
    doc = files.read_documents(spark, str(path), "analytics_events", multi_line=True).first()
    assert doc["_id"] == "0b1c" and doc.bucket_hour == datetime(2025, 3, 9, 7)
    assert [e.ts for e in doc.events] == [datetime(2025, 3, 9, 7, 31, 40), datetime(2025, 3, 9, 7, 44, 1)]
    assert doc.bucket_metadata.first_event_at == datetime(2025, 3, 9, 7, 31, 40) and doc.expires_at is None

    path = tmp_path / "catalog.json"
    path.write_text('{"product_id": "p", "specifications": {"gears": 8, "fold": null},'
                    ' "rating": {"avg": 3.0, "count": 3, "distribution": {"3": 3}},'
                    ' "active_promotion": {"promotion_id": "x", "valid_until": {"$date": "2025-11-27T09:00:00Z"}}}')
    df = files.read_documents(spark, str(path), "product_catalog")
    doc = df.select(F.try_variant_get("specifications", "$.gears", "int").alias("gears"), "rating", "active_promotion").first()
    assert doc.gears == 8 and doc.rating.distribution == {"3": 3}
    assert doc.active_promotion.valid_until == datetime(2025, 11, 27, 9)


def test_broken_lines_of_a_source_fail(spark, tmp_path):
    folder = tmp_path / "order_payments"
    folder.mkdir()
    (folder / "part.csv").write_text("order_id,payment_sequential,payment_type,payment_installments,payment_value\no,one,pix,1,2.00\n")
    with pytest.raises(Exception, match="FAILFAST|MALFORMED"):
        files.read_source(spark, str(tmp_path), "order_payments").collect()


def test_archive_keeps_every_order_readable(spark, market, tmp_path):
    live, archive = str(tmp_path / "live"), str(tmp_path / "archive")
    tables.write_orders(market.order, live, market.now)
    total = market.order.count()
    moved = tables.archive_orders(spark, live, archive, datetime(2001, 8, 2))
    assert moved == ["order_1995", "order_1996", "order_1997", "order_1998"]
    assert tables.read_orders(spark, live).count() < total
    both = tables.read_with_archive(spark, live, archive)
    assert both.count() == total == both.select("order_id").distinct().count()
    assert tables.archive_orders(spark, live, archive, datetime(2001, 8, 2)) == []


def test_monthly_partitions_are_archived(spark, market, tmp_path):
    live, archive = str(tmp_path / "live"), str(tmp_path / "archive")
    tables.write_orders(market.order, live, market.now)
    moved = tables.archive_orders(spark, live, archive, datetime(2003, 2, 2))
    assert "order_2000_12" in moved and "order_2001_01" in moved and "order_2001_02" not in moved and "order_default" not in moved
    assert tables.read_with_archive(spark, live, archive).count() == market.order.count()


def test_refresh_switches_only_to_a_sound_version(spark, tmp_path):
    path = str(tmp_path / "summary")

    def table(*values):
        return spark.createDataFrame(list(values), "k int, v int")

    tables.refresh_summary(table((1, 1), (2, 1)), path, ["k"])
    before = tables.read_summary(spark, path)
    tables.refresh_summary(table((1, 2)), path, ["k"])
    assert [tuple(r) for r in tables.read_summary(spark, path).collect()] == [(1, 2)]
    assert before.count() == 2  # readers of the old version are not disturbed
    with pytest.raises(ValueError):
        tables.refresh_summary(table((1, 3), (1, 4)), path, ["k"])
    assert [tuple(r) for r in tables.read_summary(spark, path).collect()] == [(1, 2)]


def test_repeated_batch_replaces_itself(spark, tmp_path):
    path = str(tmp_path / "log")
    for _ in range(2):
        tables.append_batch(spark.range(5), path, 7)
    assert tables.read_log(spark, path).count() == 5


def test_three_broken_lines_load_all_others(spark, tmp_path):
    folder, path = tmp_path / "order_payments", str(tmp_path / "out")
    folder.mkdir()
    header = "order_id,payment_sequential,payment_type,payment_installments,payment_value"
    (folder / "a.csv").write_text("\n".join([header, "o1,1,pix,1,2.00", "o2,1,pix,many,2.00", "o3,1,\"a, b\",1,3.00", "o4,1,pix"]) + "\n")
    (folder / "b.csv").write_text("\n".join([header, "o5,x,pix,1,y", "o6,1,,,"]) + "\n")
    for _ in range(2):  # a load that runs again replaces itself
        rejects.load_source(spark, str(tmp_path), "order_payments", path)

    def state():
        loaded = sorted(r.order_id for r in rejects.read_loaded(spark, path).collect())
        return loaded, sorted((r.line, r.file[-5:], r.reason, r.tries) for r in rejects.read_rejected(spark, path).collect())

    number = "wrong number of fields"
    first = [("o2,1,pix,many,2.00", "a.csv", "not of its type: payment_installments", 1), ("o4,1,pix", "a.csv", number, 1),
             ("o5,x,pix,1,y", "b.csv", "not of its type: payment_sequential, payment_value", 1)]
    assert state() == (["o1", "o3", "o6"], first)
    assert rejects.replay_rejected(spark, "order_payments", path, lambda line: F.replace(line, F.lit("many"), F.lit("12"))) == 1
    assert state() == (["o1", "o2", "o3", "o6"], [(*r[:3], 2) for r in first[1:]])
    for tries in (3, 4):
        assert rejects.replay_rejected(spark, "order_payments", path, lambda line: line) == 0
    assert all(r.given_up and r.tries == 4 for r in rejects.read_rejected(spark, path).collect())
    assert rejects.replay_rejected(spark, "order_payments", path, lambda line: F.lit("o4,1,pix,1,1.00")) == 0  # nobody tries them any more
    assert state() == (["o1", "o2", "o3", "o6"], [(*r[:3], 4) for r in first[1:]])


def test_load_transformations(spark):
    orders = spark.createDataFrame([("o1", "c1"), ("o2", "c2")], "order_id string, customer_id string")
    customers = spark.createDataFrame([("c2", "u", 20), ("c1", "u", 10)], "customer_id string, customer_unique_id string, zip int")
    conformed, real = files.conform_orders(orders, customers)
    assert sorted(map(tuple, conformed.collect())) == [("o1", "u"), ("o2", "u")]
    assert [tuple(r) for r in real.collect()] == [("u", 10)]
    products = spark.createDataFrame([("p1", "b"), ("p2", "a"), ("p3", None)], "product_id string, product_category_name string")
    names = spark.createDataFrame([("a", "A")], "product_category_name string, product_category_name_english string")
    dim, keyed = files.build_category_dim(products, names)
    assert sorted(map(tuple, dim.collect())) == [(1, "a", "A"), (2, "b", None)]
    assert sorted((r.product_id, r.category_id) for r in keyed.collect()) == [("p1", 2), ("p2", 1), ("p3", None)]


def test_rules_pass_on_null_and_split(spark):
    df = spark.createDataFrame([("a", 1), ("b", -1), ("c", None)], "k string, v int")
    rules = {"positive": F.col("v") > 0, **quality.not_null("v")}
    report_rows = {r.rule: (r.violations, r.sample_key) for r in quality.check_rules(df, rules, "k").collect()}
    assert report_rows == {"positive": (1, "b"), "not_null_v": (1, "c")}
    valid, rejected = quality.split_valid(df, rules)
    assert [r.k for r in valid.collect()] == ["a"]
    assert sorted((r.k, r.broken_rules) for r in rejected.collect()) == [("b", ["positive"]), ("c", ["not_null_v"])]


def test_insert_ignore_and_dedupe(spark):
    target = spark.createDataFrame([(1, "old")], "k int, v string")
    batch = spark.createDataFrame([(1, "new"), (2, "b"), (2, "a")], "k int, v string")
    got = sets.insert_ignore(target, batch, ["k"], ["v"])
    assert sorted(map(tuple, got.collect())) == [(1, "old"), (2, "a")]


def test_report_has_every_finding(market):
    found = report.eda_report({
        "customers": market.customer, "orders": market.order, "items": market.order_item, "payments": market.payment,
        "reviews": market.review, "products": market.product, "sellers": market.seller})
    assert len(found) >= 35 and found["key_orders"].first().n_duplicate == 0
    assert {r.column for r in found["nulls_products"].collect()} == {"n_photos"}


def test_scratch_is_below_the_shared_folder(spark):
    assert scratch_path(spark, "x").startswith(spark.conf.get("spark.checkpoint.dir"))
