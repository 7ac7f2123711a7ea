"""Refreshes write what has changed, and compute it once."""

from datetime import datetime
from pathlib import Path

from pyspark.sql import functions as F

from feira.functions import dates
from feira.queries import loads
from feira.sources import tables


def test_late_months_replace_their_partitions_only(spark, tmp_path):
    def orders(*found):
        return spark.createDataFrame([(k, f"{day} 00:00:00" if day else None) for k, day in found], "order_id int, at string").select(
            "order_id", F.col("at").cast("timestamp_ntz").alias("order_purchase_timestamp"))

    path, now = str(tmp_path / "t"), dates.instant("2001-08-02 00:00:00")
    tables.write_orders(orders((1, "1999-05-05"), (2, "2001-04-30"), (3, "2001-05-01"), (4, None), (5, "2002-01-01")), path, now)
    before = tables.VersionedTable(spark, path).current().parts
    late = orders((3, "2001-05-01"), (6, "2001-05-31"), (7, "2001-06-01"), (8, None))
    tables.replace_orders(late, path, now, datetime(2001, 5, 1), datetime(2001, 6, 1))
    after = tables.VersionedTable(spark, path).current().parts
    assert sorted(r.order_id for r in tables.read_orders(spark, path).collect()) == [1, 2, 3, 4, 5, 6]
    assert {p for p in before if before[p] == after.get(p)} == {"order_1999", "order_2001_04"}
    assert set(after) == {"order_1999", "order_2001_04", "order_2001_05", "order_default"}


def test_the_summary_is_computed_once(market, monkeypatch):
    rows = market.order.select("order_id", F.col("order_id").alias("category_id"), F.lit(1).alias("sales_month"))
    monkeypatch.setattr(loads, "monthly_sales", lambda m: rows)
    shared = Path(market.spark.conf.get("spark.checkpoint.dir"))
    before = set(shared.glob("sales-*"))
    assert loads.a12(market).count() == rows.count()
    assert len(set(shared.glob("sales-*")) - before) == 1
