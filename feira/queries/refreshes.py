"""Summaries refreshed for the months that have changed, beside the whole computation."""

from datetime import date, datetime

from pyspark.sql import functions as F

from feira.plans import sales
from feira.queries.registry import query
from feira.session import scratch_path, stored
from feira.sources import tables

# Orders and items of these months come late; everything else is there from the start.
CHANGED = [(2001, 5), (2001, 6)]
START, END = datetime(1900, 1, 1), datetime(2100, 1, 1)


def _bounds(year: int, month: int) -> tuple[datetime, datetime]:
    return datetime(year, month, 1), datetime(year + month // 12, month % 12 + 1, 1)


def _late(ts: str = "order_purchase_timestamp"):
    first, last = _bounds(*CHANGED[0])[0], _bounds(*CHANGED[-1])[1]
    return (F.col(ts) >= F.lit(str(first)).cast("timestamp_ntz")) & (F.col(ts) < F.lit(str(last)).cast("timestamp_ntz"))


class Store:
    """Orders and items by bucket: at first without half of the late ones, of which some have another status.

    What comes late replaces the partitions of its months; the others stay as they are. Items are numbered and
    stamped once.
    """

    def __init__(self, m):
        self.m, self.path, self.items = m, scratch_path(m.spark, "store"), stored(m.stamped_item, "items")
        half = F.pmod(F.col("order_id").cast("long"), F.lit(2)) == 0
        early = F.coalesce(~_late(), F.lit(True)) | half
        stale = F.when(_late(), F.lit("created")).otherwise(F.col("order_status"))
        tables.write_orders(m.order.where(early).withColumn("order_status", stale), f"{self.path}/orders", m.now)
        tables.write_orders(self.items.where(early), f"{self.path}/items", m.now)

    def complete(self):
        first, last = _bounds(*CHANGED[0])[0], _bounds(*CHANGED[-1])[1]
        for name, rows in (("orders", self.m.order), ("items", self.items)):
            tables.replace_orders(rows, f"{self.path}/{name}", self.m.now, first, last)

    def scan(self, start=START, end=END):
        return [tables.scan_orders(self.m.spark, f"{self.path}/{name}", start, end).drop("order_bucket") for name in ("orders", "items")]


def _refreshed(m, work, key: list[str]):
    """The summary from the first store, then refreshed month by month from the complete one."""
    store, path = Store(m), scratch_path(m.spark, "summary")
    tables.refresh_parts(work(*store.scan()), path, key, "sales_month")
    store.complete()
    for year, month in CHANGED:
        tables.refresh_parts(work(*store.scan(*_bounds(year, month))), path, key, "sales_month", [date(year, month, 1)])
    return tables.read_summary(m.spark, path)


@query("d1_refreshed_by_month", "SELECT * FROM d_sales")
def d1_refreshed(m):
    def work(orders, items):
        return sales.sales_by_category_month(orders, items, m.product, m.category, "category_name")

    return _refreshed(m, work, ["category_id", "sales_month"])


@query("d3_refreshed_by_month", "SELECT * FROM d_customer_revenue")
def d3_refreshed(m):
    return sales.merge_revenue(_refreshed(m, sales.revenue_by_month, ["customer_unique_id", "sales_month"]))
