"""Best promotions by elementary intervals beside trying every promotion."""

import random
from datetime import datetime, timedelta
from decimal import ROUND_HALF_UP, Decimal

import pytest
from pyspark.sql import functions as F

from feira.functions import dates
from feira.plans import promotions as P

START = datetime(2001, 1, 1)
TERMS = ("promotion_id string, name string, discount_percentage decimal(5,2), discount_amount decimal(12,2), lower timestamp_ntz, upper timestamp_ntz,"
         "lower_inc boolean, upper_inc boolean, target_category_ids array<int>, target_product_ids array<string>")
ITEMS = "order_id string, order_item_id int, product_id string, category_id int, price decimal(12,2), order_purchase_timestamp timestamp_ntz"


def promotion(k, lower, upper, pct=None, amount=None, categories=(), products=(), inc=(True, False)):
    return (f"P{k}", f"name {k}", None if pct is None else Decimal(pct), None if amount is None else Decimal(amount), lower, upper, *inc,
            list(categories), list(products))


def frames(spark, offers, items):
    made = spark.createDataFrame(offers, TERMS)
    period = F.struct("lower", "upper", "lower_inc", "upper_inc").alias("promotion_period")
    return spark.createDataFrame(items, ITEMS), made.select("*", period).drop("lower", "upper", "lower_inc", "upper_inc")


def price_of(price, offer):
    cents = lambda x: x.quantize(Decimal("0.01"), ROUND_HALF_UP)
    pct, amount = offer[2:4]
    made = cents(price * (100 - pct) / 100) if pct is not None else price - (amount or 0)
    return max(made, Decimal("0.00"))


def valid(offer, at):
    lower, upper, lower_inc, upper_inc = offer[4:8]
    return ((lower is None or lower < at or (lower_inc and lower == at)) and (upper is None or at < upper or (upper_inc and upper == at)))


def brute(offers, items):
    out = []
    for order, line, product, category, price, at in items:
        found = [(price_of(price, o), o[0]) for o in offers if valid(o, at) and (category in o[8] or product in o[9])]
        if found:
            out.append((order, line, *min(found)[::-1]))
    return sorted(out)


def best(items, offers):
    return sorted((r.order_id, r.order_item_id, r.promotion_id, r.promotion_price) for r in P.promotion_at_order(items, offers).collect())


def crowd(n, seed=1):
    """Many overlapping promotions of one category, some open-ended, some of single products."""
    rng = random.Random(seed)
    offers = []
    for k in range(n):
        lower = START + timedelta(hours=rng.randrange(24 * 90))
        upper = lower + timedelta(hours=rng.randrange(24 * 60))
        terms = rng.choice([{"pct": rng.randrange(0, 10_000) / 100}, {"pct": rng.randrange(0, 101)}, {"amount": rng.randrange(0, 3000) / 100}, {}])
        offers.append(promotion(rng.randrange(10**6) * n + k, lower if rng.random() > 0.03 else None, upper if rng.random() > 0.03 else None,
                                **{a: str(b) for a, b in terms.items()}, categories=[1] if rng.random() > 0.1 else [2, 1],
                                products=[f"p{rng.randrange(4)}"] if rng.random() > 0.7 else [], inc=(rng.random() > 0.3, rng.random() > 0.7)))
    edges = [b for o in offers for b in o[4:6] if b]
    items = [(f"o{k}", k % 3, f"p{rng.randrange(6)}", rng.randrange(4), Decimal(rng.randrange(1, 4000)) / 100,
              rng.choice([START + timedelta(seconds=rng.randrange(-10**7, 2 * 10**7)), rng.choice(edges)])) for k in range(300)]
    return offers, items


@pytest.mark.parametrize("n", [1, 2, 7, 60])
def test_best_promotion_is_exact(spark, n):
    offers, items = crowd(n, n)
    assert best(*frames(spark, offers, items)) == brute(offers, items)


def test_a_thousand_overlapping_promotions(spark):
    offers, items = crowd(1000)
    rows, terms = frames(spark, offers, items)
    assert best(rows, terms) == brute(offers, items)
    # No row of an item is made more than once: what meets an item is one row per target and month.
    intervals = P.offer_intervals(terms)
    assert intervals.groupBy("target_kind", "target_id", "start").count().where("count > 1").isEmpty()
    sizes = intervals.agg(F.max(F.size("offers")).alias("most"), F.count("*").alias("n")).first()
    assert sizes["n"] <= 2 * 1100 + 1500 and sizes["most"] < 60
    text = P.promotion_at_order(rows, terms)._jdf.queryExecution().optimizedPlan().toString()
    assert "order_item_id" not in "".join(line for line in text.split("\n") if "Aggregate" in line or "Window" in line)


def test_odd_periods(spark):
    at = START
    offers = [promotion(1, at, at, pct="50", categories=[1]), promotion(2, at, at, pct="10", categories=[1], inc=(True, True)),
              promotion(3, at + timedelta(days=1), at, pct="90", categories=[1]), promotion(4, None, None, amount="1.00", categories=[1]),
              promotion(5, at, at + timedelta(seconds=1), amount="1.00", products=["p"], inc=(False, True)),
              promotion(6, None, at, pct="100", products=["p", "p"]), promotion(0, None, at, amount="50", products=["p"])]
    times = [at + timedelta(microseconds=m) for m in (-1, 0, 1, 1_000_000, 1_000_001)]
    items = [(str(k), j, "p" if j else "q", 1, Decimal("20.00"), t) for k, t in enumerate(times) for j in (0, 1)]
    items += [("x", 0, None, None, Decimal("1.00"), at), ("y", 0, "z", 9, Decimal("1.00"), at)]
    rows, terms = frames(spark, offers, items)
    assert best(rows, terms) == brute(offers, items)
    assert best(rows, terms.limit(0)) == [] and best(rows.limit(0), terms) == []
    assert best(rows, terms.where("promotion_id = 'P4'")) == brute(offers[3:4], items)


def test_current_prices(spark):
    offers, _ = crowd(80, 3)
    products = [(f"p{k}", k % 3, Decimal(500 + 37 * k) / 100) for k in range(40)]
    frame = spark.createDataFrame(products, "product_id string, category_id int, base_price decimal(12,2)")
    at = START + timedelta(days=30)
    found = P.effective_price(frame, frames(spark, offers, [("o", 1, "p", 1, Decimal(1), at)])[1], dates.instant(str(at))).collect()
    want = {p: brute(offers, [("o", 0, p, c, price, at)]) for p, c, price in products}
    by = {o[0]: o for o in offers}
    assert len(found) == len(products) and any(want.values()) and not all(want.values())
    for r in found:
        _, _, offer, price = want[r.product_id][0] if want[r.product_id] else (None, None, None, r.base_price)
        assert (r.promotion_id, r.price_current, r.has_active_promotion) == (offer, price, offer is not None)
        assert offer is None or (r.promotion_name, r.discount_percentage, r.valid_until) == (by[offer][1], by[offer][2], by[offer][5])
