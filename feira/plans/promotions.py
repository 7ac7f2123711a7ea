"""Promotions: targets, validity and effective prices."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from feira.functions import dates, values
from feira.operators.search import active_promotions_at
from feira.session import stored

TERMS = ["promotion_id", "discount_percentage", "discount_amount", "promotion_period"]


def promotion_targets(promotions: DataFrame, *also: str) -> DataFrame:
    """One row per promotion and target, a category or a product."""
    by_category = promotions.select(
        *TERMS, *also, F.lit("category").alias("target_kind"),
        F.explode(F.col("target_category_ids").cast("array<string>")).alias("target_id"))
    by_product = promotions.select(
        *TERMS, *also, F.lit("product").alias("target_kind"), F.explode("target_product_ids").alias("target_id"))
    return by_category.unionByName(by_product)


def _matched(rows: DataFrame, promotions: DataFrame) -> DataFrame:
    """Rows (with product_id and category_id) paired with the promotions that name them."""
    def join(kind: str, key: str) -> DataFrame:
        targets = promotion_targets(promotions).where(F.col("target_kind") == kind)
        return rows.join(targets, rows[key].cast("string") == targets["target_id"])

    pairs = join("category", "category_id").unionByName(join("product", "product_id"))
    return pairs.drop("target_kind", "target_id")


def active_promotions(products: DataFrame, promotions: DataFrame, as_of: Column) -> DataFrame:
    """Each product with the promotions valid at an instant."""
    return _matched(products, active_promotions_at(promotions, as_of)).dropDuplicates(["product_id", "promotion_id"])


# What an offer needs for a price, what the catalogue shows of it beside that, and whom it is for.
PRICED = ["promotion_id", "discount_percentage", "discount_amount"]
SHOWN = [*PRICED, "promotion_name", "valid_until"]
TARGET = ["target_kind", "target_id"]
# Stand for open ends of a period.
FIRST, LAST = "0001-01-01 00:00:00", "9999-12-31 23:59:59.999999"


def _unbeaten(offers: DataFrame, keys: list[str]) -> DataFrame:
    """Offers per key that can be the best at some price: none with as much discount has a smaller id."""
    by_share = F.col("discount_percentage").isNotNull()
    worth = F.coalesce("discount_percentage", "discount_amount", F.lit(0))
    better = Window.partitionBy(*keys, by_share).orderBy(F.desc(worth), "promotion_id").rowsBetween(Window.unboundedPreceding, -1)
    least = F.min("promotion_id").over(better)
    return offers.withColumn("least", least).where(F.col("least").isNull() | (F.col("promotion_id") < F.col("least"))).drop("least")


def _best(price: Column, *offers: Column) -> Column:
    """The lowest price that some arrays of offers give, ties by promotion id: (price, promotion_id, …)."""
    both = F.concat(*[F.coalesce(o, F.array()) for o in offers])
    return F.array_min(F.transform(both, lambda o: F.struct(
        values.discounted(price, o["discount_percentage"], o["discount_amount"]).alias("price"), o.alias("offer"))))


def offer_intervals(promotions: DataFrame) -> DataFrame:
    """(target_kind, target_id, start, end, offers): disjoint stretches of time with the offers that can be best there.

    The bounds of a target's promotions cut time into elementary intervals. A promotion is stored at the nodes of
    the binary tree over these whose stretches together are its own, two per level at most, and beaten offers
    are dropped at each node. An interval takes what is left at the nodes above it. So many promotions at one
    time, on one target, make neither the tree nor the intervals grow with their square.
    """
    period, micro = F.col("promotion_period"), F.expr("INTERVAL '0.000001' SECOND")
    lower = F.when(period["lower_inc"], period["lower"]).otherwise(period["lower"] + micro)
    upper = F.when(period["upper_inc"], period["upper"] + micro).otherwise(period["upper"])
    spans = promotion_targets(promotions).withColumns({
        "start": F.coalesce(lower, dates.instant(FIRST)), "end": F.coalesce(upper, dates.instant(LAST))}).where("start < end")
    ranked = spans.select(*TARGET, *PRICED, "start", "end", F.explode(F.array("start", "end")).alias("at")).withColumn(
        "rank", F.dense_rank().over(Window.partitionBy(*TARGET).orderBy("at")) - 1).withColumn(
        "top", F.length(F.bin(F.max("rank").over(Window.partitionBy(*TARGET)))))
    placed = ranked.groupBy(*TARGET, *PRICED, "start", "end", "top").agg(F.min("rank").alias("l"), F.max("rank").alias("r")).drop("start", "end")
    level = F.explode(F.sequence(F.lit(0), F.col("top")))
    sides = placed.withColumn("level", level).withColumns({
        "l": F.expr("shiftright(l + shiftleft(1L, level) - 1, level)"), "r": F.expr("shiftright(CAST(r AS BIGINT), level)")}).where("l < r")
    node = F.explode(F.array_compact(F.array(F.when(F.col("l") % 2 == 1, F.col("l")), F.when(F.col("r") % 2 == 1, F.col("r") - 1))))
    nodes = _unbeaten(sides.withColumn("node", node).drop("l", "r", "top"), [*TARGET, "level", "node"])

    by_rank = Window.partitionBy(*TARGET).orderBy("rank")
    leaves = ranked.groupBy(*TARGET, "rank", "top").agg(F.min("at").alias("start")).withColumn("end", F.lead("start").over(by_rank)).where("end IS NOT NULL")
    above = leaves.withColumn("level", level).withColumn("node", F.expr("shiftright(CAST(rank AS BIGINT), level)"))
    held = _unbeaten(above.join(nodes, [*TARGET, "level", "node"]), [*TARGET, "start"])
    return held.groupBy(*TARGET, "start", "end").agg(F.collect_list(F.struct(*PRICED)).alias("offers"))


def _month(ts: Column) -> Column:
    return F.year(ts) * 12 + F.month(ts)


def promotion_at_order(items: DataFrame, promotions: DataFrame) -> DataFrame:
    """Items with the best promotion valid when they were bought; others are left out.

    ``items`` carry product_id, category_id, price and order_purchase_timestamp. The intervals of a target that
    touch a month are one row, so an item meets at most one row of its category and one of its product, by
    equality, however many promotions are valid; items are neither multiplied nor grouped. Before the first and
    after the last bound nothing changes, so months out there share one row.
    """
    intervals = stored(offer_intervals(promotions), "intervals")  # read for each kind of target, and for its bounds
    at = intervals.select(F.explode(F.array("start", "end")).alias("at")).where(
        (F.col("at") > dates.instant(FIRST)) & (F.col("at") < dates.instant(LAST))).agg(F.min("at").alias("first"), F.max("at").alias("last")).first()
    first, last = (x.year * 12 + x.month if x else 0 for x in at)

    def clipped(ts: str) -> Column:
        return F.least(F.greatest(_month(F.col(ts)), F.lit(first - 1)), F.lit(last + 1))

    months = intervals.withColumn("month", F.explode(F.sequence(clipped("start"), clipped("end"))))
    by_month = months.groupBy(*TARGET, "month").agg(F.collect_list(F.struct("start", "end", "offers")).alias("spans"))
    bought = F.col("order_purchase_timestamp")
    rows = items.withColumn("month", clipped("order_purchase_timestamp"))

    def met(kind: str, key: str) -> Column:
        nonlocal rows
        own = by_month.where(F.col("target_kind") == kind).select(
            F.col("target_id").alias(f"{kind}_target"), F.col("month").alias(f"{kind}_month"), F.col("spans").alias(f"{kind}_spans"))
        rows = rows.join(own, (rows[key].cast("string") == own[f"{kind}_target"]) & (rows["month"] == own[f"{kind}_month"]), "left")
        inside = F.filter(f"{kind}_spans", lambda s: (s["start"] <= bought) & (bought < s["end"]))
        return F.get(F.transform(inside, lambda s: s["offers"]), F.lit(0))

    offers = [met("category", "category_id"), met("product", "product_id")]
    best = rows.withColumn("best", _best(F.col("price"), *offers)).where("best IS NOT NULL")
    return best.select(*items.columns, F.col("best.offer.promotion_id").alias("promotion_id"), F.col("best.price").alias("promotion_price"))


def with_price(products: DataFrame, promotions: DataFrame, as_of: Column) -> DataFrame:
    """Products with their current price: the lowest of their active promotions, ties by promotion id.

    The offers that can be best are one row per target, so a product meets at most one row of its category
    and one of its own.
    """
    active = active_promotions_at(promotions, as_of).withColumnsRenamed({"name": "promotion_name"})
    terms = promotion_targets(active, "promotion_name").withColumn("valid_until", F.col("promotion_period.upper"))
    offers = _unbeaten(terms, TARGET).groupBy(*TARGET).agg(F.collect_list(F.struct(*SHOWN)).alias("offers"))
    rows = products

    def met(kind: str, key: str) -> Column:
        nonlocal rows
        own = offers.where(F.col("target_kind") == kind).select(F.col("target_id").alias(f"{kind}_target"), F.col("offers").alias(f"{kind}_offers"))
        rows = rows.join(own, rows[key].cast("string") == own[f"{kind}_target"], "left")
        return F.col(f"{kind}_offers")

    best = _best(F.col("base_price"), met("category", "category_id"), met("product", "product_id"))
    base = values.money(F.col("base_price"))
    return rows.withColumn("best", best).select(
        *products.columns, F.coalesce(F.col("best.price"), base).alias("price_current"),
        F.col("best").isNotNull().alias("has_active_promotion"),
        "best.offer.promotion_id", "best.offer.promotion_name", "best.offer.discount_percentage", "best.offer.valid_until")


def effective_price(products: DataFrame, promotions: DataFrame, as_of: Column) -> DataFrame:
    """Current price of every product by id, with the promotion that gives it."""
    rows = products.select("product_id", "category_id", values.money(F.col("base_price")).alias("base_price"))
    return with_price(rows, promotions, as_of).drop("category_id")
