"""The maintained catalogue: only affected products are projected again, and the result is that of a projection from scratch."""

from datetime import datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from feira.functions import dates, semistructured
from feira.plans.catalog import product_catalog
from feira.queries import changes
from feira.session import stored
from feira.sources.tables import read_log
from feira.streaming import propagation
from feira.streaming.propagation import ITEM, REVIEW, VERSIONED, as_changes

STAMPS = ("source_updated_at", "synced_at", "removed")


class Shop:
    """The tables as they are, and the changes that led there."""

    def __init__(self, spark, path):
        self.spark, self.path, self.turn = spark, path, 0
        self.rows = {name: {} for name in (*VERSIONED, "item", "review")}
        self.now = "2024-01-01 00:00:00"

    def schema(self, name):
        return {"item": ITEM, "review": REVIEW}[name] if name in ("item", "review") else VERSIONED[name][1]

    def frame(self, name, keys=None):
        rows = self.rows[name]
        return self.spark.createDataFrame([rows[k] for k in (rows if keys is None else keys)], self.schema(name))

    def change(self, at, removed=(), **tables):
        """One batch: new states by table; ``removed`` names (table, key). Returns the ids that were projected again."""
        changes = [propagation.clock(self.spark, at)]
        for name, states in tables.items():
            for state in states:
                self.rows[name][state[0] if name not in ("item",) else state[:2]] = state
            changes.append(as_changes(self.spark.createDataFrame(states, self.schema(name)), name, dates.instant(at)))
        for name, key in removed:
            changes.append(as_changes(self.frame(name, [key]), name, dates.instant(at), removed=True))
            del self.rows[name][key]
        self.now = max(self.now, at)
        return self.apply(changes)

    def apply(self, changes):
        for frame in changes:
            frame.coalesce(1).write.mode("append").parquet(f"{self.path}/in/{self.turn}")
        propagation.apply_changes(self.spark.read.parquet(f"{self.path}/in/{self.turn}"), f"{self.path}/out", self.turn)
        touched = read_log(self.spark, f"{self.path}/out/catalog").where(F.col("batch_id") == self.turn)
        self.turn += 1
        return sorted(r.product_id for r in touched.collect())

    def from_scratch(self):
        products = self.frame("product").withColumn("product_specifications", semistructured.parse(F.col("product_specifications")))
        return product_catalog(products, self.frame("category"), self.frame("seller"), self.frame("item"), self.frame("promotion"),
                               self.frame("review"), dates.instant(self.now))

    def agrees(self):
        def flat(df):
            return sorted(str(r) for r in df.drop(*STAMPS).withColumn("specifications", F.to_json("specifications")).withColumn(
                "rating", F.to_json("rating")).collect())

        assert flat(propagation.read_maintained(self.spark, f"{self.path}/out").select(*self.from_scratch().columns)) == flat(self.from_scratch())


def product(k, category, price="10.00"):
    return (f"p{k}", category, f"name {k}", "text", '{"brand":"b"}', ["img"], ["tag"], (Decimal("1.00"),) * 4, Decimal(price))


def seller(k, city="here"):
    return (f"s{k}", city, "ST", (1.0, 2.0))


def promotion(k, lower, upper, pct="10.00", categories=(), products=()):
    at = [datetime.fromisoformat(x) for x in (lower, upper)]
    return (f"o{k}", f"offer {k}", Decimal(pct), None, (*at, True, False), list(categories), list(products))


@pytest.fixture
def shop(spark, tmp_path):
    made = Shop(spark, str(tmp_path))
    first = made.change(
        "2024-01-01 00:00:00",
        category=[(1, "one", "uno"), (2, "two", "dos")], product=[product(k, 1 + k % 2) for k in range(8)],
        seller=[seller(k) for k in range(3)],
        promotion=[promotion(0, "2024-02-01", "2024-03-01", categories=[1]), promotion(1, "2024-01-01", "2024-02-15", pct="50.00", products=["p2", "p3"])],
        item=[("a", 1, "p0", "s0"), ("a", 2, "p1", "s0"), ("b", 1, "p2", "s1"), ("c", 1, "p3", "s1"), ("d", 1, "p3", "s0"), ("e", 1, "p3", "s1"), ("f", 1, "p5", "s9")],
        review=[("r0", "product", "p0", "s0", 5), ("r1", "seller", "p2", "s1", 2)])
    assert first == [f"p{k}" for k in range(8)]
    made.agrees()
    return made


def test_each_kind_of_change_reaches_its_products(shop):
    at = iter(f"2024-01-{day:02d} 00:00:00" for day in range(2, 30))
    steps = [
        (["p4"], {"product": [product(4, 1, "99.00")]}),
        (["p2", "p3"], {"seller": [seller(1, "there")]}),  # p3 has more items of s1 than of s0
        (["p0", "p1"], {"review": [("r2", "seller", "p3", "s0", 1)]}),
        (["p3"], {"review": [("r3", "product", "p3", "s0", 1)]}),
        (["p1", "p3", "p5", "p7"], {"category": [(2, "two", "deux")]}),
        (["p6"], {"item": [("g", 1, "p6", "s2")]}),
        (["p5"], {"seller": [seller(9)]}),  # the seller comes after the item
        (["p2", "p3", "p7"], {"promotion": [promotion(1, "2024-01-01", "2024-02-15", pct="60.00", products=["p2", "p7"])]}),
        (["p9"], {"product": [product(9, 2)]}),
        ([], {"item": [("h", 1, "unknown", "s2")]}),
    ]
    for k, (want, tables) in enumerate(steps):
        got = [p for p in shop.change(next(at), **tables) if p != "unknown"]
        assert got == want, tables
        if k % 3 == 0:
            shop.agrees()


def test_time_alone_starts_and_ends_promotions(shop):
    assert shop.change("2024-01-31 23:59:59") == []
    assert shop.change("2024-02-01 00:00:00") == ["p0", "p2", "p4", "p6"]  # offer 0 begins on category 1
    shop.agrees()
    assert shop.change("2024-02-15 00:00:00") == ["p2", "p3"]  # offer 1 ends
    shop.agrees()
    assert shop.change("2024-02-10 00:00:00") == []  # the clock does not go back
    assert shop.change("2024-03-05 00:00:00") == ["p0", "p2", "p4", "p6"]
    shop.agrees()


def test_removed_rows(shop):
    assert shop.change("2024-01-05 00:00:00", removed=[("promotion", "o1")]) == ["p2", "p3"]
    shop.agrees()
    assert shop.change("2024-01-06 00:00:00", removed=[("product", "p1"), ("seller", "s1")]) == ["p1", "p2", "p3"]
    shop.agrees()
    assert shop.change("2024-01-07 00:00:00", removed=[("category", 2)]) == ["p3", "p5", "p7"]
    shop.agrees()
    assert shop.change("2024-01-08 00:00:00", category=[(2, "two", "again")], product=[product(1, 2)]) == ["p1", "p3", "p5", "p7"]
    shop.agrees()


def test_late_and_repeated_batches(shop, spark):
    shop.change("2024-01-10 00:00:00", product=[product(0, 1, "77.00")])
    late = as_changes(spark.createDataFrame([product(0, 2, "1.00")], VERSIONED["product"][1]), "product", dates.instant("2024-01-03 00:00:00"))
    assert shop.apply([late]) == ["p0"]  # projected again, with the newer state
    shop.agrees()
    shop.turn -= 1
    assert shop.apply([]) == ["p0"]  # the same batch again
    shop.agrees()
    propagation.compact_feed(spark, f"{shop.path}/out")
    shop.agrees()
    shop.turn -= 1
    shop.apply([])  # and once more, after its rows were merged
    shop.agrees()
    shop.change("2024-02-20 00:00:00", item=[("z", 1, "p0", "s2"), ("z", 2, "p0", "s2")])
    shop.agrees()


def test_only_touched_products_are_projected(shop, spark):
    """The plan of a projection reads the logs through semi joins with the affected products."""
    feed = propagation.CatalogFeed(spark, f"{shop.path}/out", shop.turn - 1)
    text = feed.project(feed.touched("affected").select("product_id"))._jdf.queryExecution().optimizedPlan().toString()
    assert text.count("LeftSemi") >= 4


def test_main_sellers_are_decided_anew_for_products_with_new_items_only(shop, spark):
    def mains():
        rows = read_log(spark, f"{shop.path}/out/main").where(F.col("batch_id") == shop.turn - 1).collect()
        return sorted((r.product_id, r.seller_id) for r in rows)

    assert mains() == [("p0", "s0"), ("p1", "s0"), ("p2", "s1"), ("p3", "s1"), ("p5", "s9")]
    shop.change("2024-01-03 00:00:00", item=[("g", 1, "p3", "s0"), ("g", 2, "p3", "s0"), ("g", 3, None, "s0"), ("h", 1, "p6", "s2")])
    assert mains() == [("p3", "s0"), ("p6", "s2")]  # p3 has three items of s0 by now, two of s1
    shop.change("2024-01-04 00:00:00", seller=[seller(0, "moved")], product=[product(1, 1)])
    assert mains() == []
    shop.agrees()
    feed = propagation.CatalogFeed(spark, f"{shop.path}/out", shop.turn - 1)
    plan = feed.project(feed.touched("affected").select("product_id"))._jdf.queryExecution().optimizedPlan().toString()
    assert "n_items" not in plan  # what was sold is not gone through


def test_a_batch_is_dealt_to_folders_by_source(shop, spark):
    rows = stored(propagation.clock(spark, shop.now).unionByName(as_changes(shop.frame("seller"), "seller", dates.instant(shop.now))), "test", by="source")
    assert rows.columns == ["source", "removed", "changed_at", "after"]
    assert sorted(r.source for r in rows.collect()) == ["clock", "seller", "seller", "seller"]
    plan = rows.where("source = 'seller'")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(source" in plan


def test_items_are_numbered_once_for_all_turns(market, monkeypatch):
    plans = {}

    def keep(frame, purpose, by=None):
        plans[purpose] = frame._jdf.queryExecution().optimizedPlan().toString()
        return stored(frame, purpose, by)

    monkeypatch.setattr(changes, "stored", keep)
    turns = changes.change_turns(market)
    assert sum("row_number" in p and "l_linenumber" in p for p in plans.values()) == 1
    assert not any("l_linenumber" in t._jdf.queryExecution().optimizedPlan().toString() for t in turns)
