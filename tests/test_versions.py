"""Versions: readers keep theirs, writers don't lose each other's work, repeated runs change nothing."""

from dataclasses import replace
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from feira.functions import dates
from feira.sources import tables
from feira.sources.versions import VersionedTable

SCHEMA = "order_id int, order_purchase_timestamp timestamp_ntz"


def orders(spark, *rows):
    return spark.createDataFrame([(k, str(at) if at else None) for k, at in rows], "order_id int, at string").select(
        "order_id", F.col("at").cast("timestamp_ntz").alias("order_purchase_timestamp"))


def ids(df):
    return sorted(r.order_id for r in df.select("order_id").collect())


def parts(spark, path):
    return sorted(VersionedTable(spark, path).current().parts)


def test_later_writer_sees_the_earlier_one(spark, tmp_path):
    table = VersionedTable(spark, str(tmp_path))
    staged = [table.stage(spark.range(k, k + 1))["all"] for k in (1, 2)]
    tries = []

    def slow(held):
        tries.append(held.number)
        if len(tries) == 1:  # meanwhile another writer publishes
            table.publish(lambda now: replace(now, schema=spark.range(1).schema, parts={**now.parts, "b": staged[1]}))
        return replace(held, schema=spark.range(1).schema, parts={**held.parts, "a": staged[0]})

    assert table.publish(slow).number == 2 and tries == [0, 1]
    assert sorted(r.id for r in table.read().collect()) == [1, 2]
    assert table.publish(lambda held: None).number == 2 and table.numbers() == [1, 2]
    with pytest.raises(ValueError, match="nothing is published"):
        VersionedTable(spark, str(tmp_path / "none")).read()


def test_vacuum_keeps_what_kept_versions_name(spark, tmp_path):
    table = VersionedTable(spark, str(tmp_path))
    for k in range(4):
        staged = table.stage(spark.range(k + 1))["all"]
        table.publish(lambda held: replace(held, schema=spark.range(1).schema, parts={"all": staged}))
    waiting = table.stage(spark.range(9))  # not published yet
    reader = table.read(table.version(3))
    assert len(table.vacuum(2)) == 2 and table.numbers() == [3, 4]
    assert reader.count() == 3 and table.read().count() == 4 and len(list((tmp_path / "data").iterdir())) == 3
    table.publish(lambda held: replace(held, parts=waiting))
    assert table.read().count() == 9


def stored(spark, path):
    rows = [(1, "1999-05-01"), (2, "2000-01-10"), (3, "2000-01-20 05:00:00"), (4, "2000-02-01"), (5, "2000-12-31 23:59:59"), (6, "2001-03-03"),
            (7, "2001-08-31"), (8, "2001-09-01"), (9, "2030-01-01"), (10, None)]
    tables.write_orders(orders(spark, *rows), path, dates.instant("2001-01-15 00:00:00"))
    assert parts(spark, path) == ["order_1999", "order_2000_01", "order_2000_02", "order_2000_12", "order_default"]
    return list(range(1, 11))


def test_months_roll_up_into_years(spark, tmp_path):
    path = str(tmp_path / "orders")
    everyone = stored(spark, path)
    before = tables.read_orders(spark, path)
    now = datetime(2001, 9, 2)
    assert tables.roll_up_orders(spark, path, now) == ["order_2000_01", "order_2000_02", "order_default"]
    assert parts(spark, path) == ["order_1999", "order_2000", "order_2000_12", "order_2001_03", "order_2001_08", "order_2001_09", "order_default"]
    assert ids(tables.read_orders(spark, path)) == everyone == ids(before)  # planned before, read after
    after = tables.read_orders(spark, path)
    wanted = after.withColumn("wanted", tables.order_bucket(F.col("order_purchase_timestamp"), dates.instant(str(now))))
    assert wanted.where("wanted <> order_bucket").isEmpty()
    number = VersionedTable(spark, path).current().number
    assert tables.roll_up_orders(spark, path, now) == [] and VersionedTable(spark, path).current().number == number
    assert ids(tables.scan_orders(spark, path, datetime(2000, 1, 15), datetime(2000, 12, 1))) == [3, 4]
    assert tables.roll_up_orders(spark, path, datetime(2002, 2, 1)) == ["order_2000_12"]
    assert len(VersionedTable(spark, path).current().parts["order_2000"]) == 2 and ids(tables.read_orders(spark, path)) == everyone


def test_archiving_is_published(spark, tmp_path):
    path, archive = str(tmp_path / "live"), str(tmp_path / "archive")
    everyone = stored(spark, path)
    both_before, live_before = tables.read_with_archive(spark, path, archive), tables.read_orders(spark, path)
    tables.roll_up_orders(spark, path, datetime(2003, 1, 15))
    between = tables.read_with_archive(spark, path, archive)
    moved = tables.archive_orders(spark, path, archive, datetime(2003, 1, 15))
    assert moved == ["order_1999", "order_2000"]
    for frame in (both_before, live_before, between, tables.read_with_archive(spark, path, archive)):
        assert ids(frame) == everyone
    assert ids(tables.read_orders(spark, path)) == [6, 7, 8, 9, 10]
    numbers = [VersionedTable(spark, p).current().number for p in (path, archive)]
    assert tables.archive_orders(spark, path, archive, datetime(2003, 1, 15)) == []
    assert numbers == [VersionedTable(spark, p).current().number for p in (path, archive)]
    # A late order of an archived year stays live until the next move, and counts once.
    tables.add_orders(orders(spark, (11, "2000-06-01")), path, dates.instant("2003-01-15 00:00:00"))
    assert ids(tables.read_with_archive(spark, path, archive)) == [*everyone, 11]
    assert tables.archive_orders(spark, path, archive, datetime(2003, 1, 15)) == ["order_2000"]
    assert ids(tables.read_with_archive(spark, path, archive)) == [*everyone, 11] and 11 not in ids(tables.read_orders(spark, path))


def test_interrupted_archiving_counts_orders_once(spark, tmp_path, monkeypatch):
    path, archive = str(tmp_path / "live"), str(tmp_path / "archive")
    everyone = stored(spark, path)
    publish = VersionedTable.publish

    def stops_at_the_live_table(table, change):
        if table.path == path:
            raise OSError("lost")
        return publish(table, change)

    monkeypatch.setattr(VersionedTable, "publish", stops_at_the_live_table)
    with pytest.raises(OSError):
        tables.archive_orders(spark, path, archive, datetime(2003, 1, 15))
    monkeypatch.undo()
    assert ids(tables.read_with_archive(spark, path, archive)) == everyone == ids(tables.read_orders(spark, path))
    copied = VersionedTable(spark, archive).current().number
    assert "order_1999" in tables.archive_orders(spark, path, archive, datetime(2003, 1, 15))
    assert ids(tables.read_with_archive(spark, path, archive)) == everyone
    assert VersionedTable(spark, archive).current().number == copied and "order_1999" not in parts(spark, path)


def total(rows):
    return rows.groupBy("k").agg(F.sum("n").alias("n"))


def counts(spark, path):
    return sorted((r.k, r.n) for r in total(tables.read_log(spark, path)).collect())


def test_many_batches_merge_to_few_folders(spark, tmp_path):
    path = str(tmp_path / "log")

    def add(number, writer="w", n=1):
        tables.append_batch(spark.createDataFrame([(number % 3, n)], "k int, n long"), path, number, writer)

    for number in range(30):
        add(number)
        if number % 10 == 9:
            assert tables.merge_log(spark, path, total) == 10
            tables.vacuum(spark, path, keep=1)
    want = [(k, 10) for k in range(3)]
    assert counts(spark, path) == want
    assert len(list((tmp_path / "log" / "data").iterdir())) == 1 and len(parts(spark, path)) == 1
    add(7)  # batches that run again after the merge count once
    add(29)
    assert counts(spark, path) == want
    add(30)
    add(30)
    add(0, "another checkpoint")
    assert counts(spark, path) == [(0, 12), (1, 10), (2, 10)]


def test_a_batch_replaced_during_the_merge_counts_as_replaced(spark, tmp_path):
    path, turns = str(tmp_path / "log"), []

    def add(number, n):
        tables.append_batch(spark.createDataFrame([(0, n)], "k int, n long"), path, number)

    def slow(rows):
        turns.append(1)
        if len(turns) == 1:
            add(1, 100)  # the batch runs again
            add(2, 1000)  # and the stream goes on
        return total(rows)

    add(0, 1)
    add(1, 10)
    assert tables.merge_log(spark, path, slow) == 3 and len(turns) == 2
    assert counts(spark, path) == [(0, 1101)]


def test_logs_can_have_folders_by_a_column(spark, tmp_path):
    path = str(tmp_path / "log")
    frame = spark.createDataFrame([(0, "a"), (1, "b")], "n int, place string")
    for number in range(2):
        tables.append_batch(frame, path, number, by="place")
    tables.append_batch(frame.where("place = 'a'"), path, 1, by="place")  # again, with less
    assert sorted(r.n for r in tables.read_log(spark, path).collect()) == [0, 0, 1]
    chosen = tables.read_log(spark, path, {"a"})
    assert len(chosen.inputFiles()) == 2 and all("place=a" in f for f in chosen.inputFiles())
    tables.append_batch(frame.limit(0), path, 2, by="place")
    assert tables.merge_log(spark, path, lambda rows: rows.drop("batch_id"), "place") == 2
    assert sorted(r.n for r in tables.read_log(spark, path).collect()) == [0, 0, 1]
    assert tables.read_log(spark, path, {"c"}).collect() == []
