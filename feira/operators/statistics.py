"""Exploratory statistics: quantiles, outliers, histograms, group sizes and matrices."""

from __future__ import annotations

from dataclasses import dataclass, replace
from functools import reduce
from math import ceil, floor

from pyspark.sql import Column, DataFrame, Window, functions as F

from feira.functions import dates
from feira.operators.aggregates import value_counts
from feira.operators.joins import delivered_with_review, item_flows
from feira.operators.sorting import largest_margins
from feira.session import stored


MOST_SORTED = 100_000


@dataclass(frozen=True)
class _Bracket:
    """The values between low and high, both excluded, that hold a rank, with exact counts below and inside."""

    rank: int
    before: int
    inside: int
    low: float | None = None
    high: float | None = None
    margin: float = 0.0

    def holds(self, v: Column) -> Column:
        above = v.isNotNull() if self.low is None else v > F.lit(self.low)
        return above if self.high is None else above & (v < F.lit(self.high))

    def edges(self) -> tuple[float, float]:
        """Shares of the values inside a little below and above the rank; coarse, so that neighbours have the same."""
        at = round((self.rank - self.before) / self.inside, 4)
        return max(0.0, at - self.margin), min(1.0, at + self.margin)


def _narrowed(values: DataFrame, brackets: list[_Bracket], accuracy: int) -> list[_Bracket | float]:
    """Each bracket between two values from a sketch of what is inside; the value itself where one of the two has the rank.

    Brackets that are alike share their sketch and their counts. A bracket that turns out to miss its rank is tried
    again with a wider margin.
    """
    v = F.col("v")
    shares: dict[tuple, list[float]] = {}
    for b in brackets:
        own = shares.setdefault((b.low, b.high), [])
        own.extend(e for e in b.edges() if e not in own)
    alike = {(b.low, b.high): b for b in brackets}
    sketch = values.agg(*[F.percentile_approx(F.when(alike[k].holds(v), v), own, accuracy).alias(str(n)) for n, (k, own) in enumerate(shares.items())]).first()
    value = {(k, e): x for n, (k, own) in enumerate(shares.items()) for e, x in zip(own, sketch[n])}
    cut = [tuple(value[(b.low, b.high), e] for e in b.edges()) for b in brackets]
    places = list(dict.fromkeys((b.low, b.high, *c) for b, c in zip(brackets, cut)))
    counts = values.agg(*[n.alias(f"{name}{k}") for k, (*outer, low, high) in enumerate(places) for name, n in (
        ("under", F.count_if(alike[tuple(outer)].holds(v) & (v < F.lit(low)))), ("low", F.count_if(v == F.lit(low))),
        ("upto", F.count_if(alike[tuple(outer)].holds(v) & (v <= F.lit(high)))), ("high", F.count_if(v == F.lit(high))))]).first()
    found: list[_Bracket | float] = []
    for b, (low, high) in zip(brackets, cut):
        at = 4 * places.index((b.low, b.high, low, high))
        under, n_low, upto, n_high = (b.before * (i % 2 == 0) + counts[at + i] for i in range(4))
        if not under <= b.rank < upto:
            found.append(replace(b, margin=b.margin * 4))
        elif b.rank < under + n_low:
            found.append(low)
        elif b.rank >= upto - n_high:
            found.append(high)
        else:
            found.append(replace(b, before=under + n_low, inside=upto - n_high - under - n_low, low=low, high=high))
    return found


def _values_at(values: DataFrame, ranks: list[int], total: int, accuracy: int, most: int) -> dict[int, float]:
    """The values with some ranks, counted from 0, of a column ``v``."""
    state: dict[int, _Bracket | float] = {r: _Bracket(r, 0, total, margin=20 / accuracy) for r in ranks}

    def open_brackets(more_than: int) -> list[_Bracket]:
        return [b for b in state.values() if isinstance(b, _Bracket) and b.inside > more_than]

    while wide := open_brackets(most):
        state |= {b.rank: new for b, new in zip(wide, _narrowed(values, wide, accuracy))}
    if held := open_brackets(0):
        v = F.col("v")
        held = sorted(held, key=lambda b: b.rank)
        places = F.array_compact(F.array(*[F.when(b.holds(v), F.lit(k)) for k, b in enumerate(held)]))
        inside = values.where(reduce(Column.__or__, [b.holds(v) for b in held]))
        counts = inside.select("v", F.explode(places).alias("bracket")).groupBy("bracket", "v").agg(F.count("*").alias("n"))
        upto = F.sum("n").over(Window.partitionBy("bracket").orderBy("v"))
        inner = F.get(F.array(*[F.lit(b.rank - b.before) for b in held]), F.col("bracket"))
        found = counts.withColumn("upto", upto).where(F.col("upto") > inner).groupBy("bracket").agg(F.min("v").alias("v")).collect()
        state |= {held[r["bracket"]].rank: r["v"] for r in found}
    return state


def exact_quantiles(df: DataFrame, column: str, probabilities: list[float], accuracy: int = 10_000,
                    most: int = MOST_SORTED) -> DataFrame:
    """(probability, value) by linear interpolation, exact for any number of distinct values.

    Every rank that is needed has a bracket of values. While one holds more than ``most`` rows, a sketch of these
    finds two values close around the rank, and a pass counts exactly what lies below, at and between them: either
    one of them has the rank, however often it occurs, or what lies between is the next bracket, a two hundred and
    fiftieth of the last. Then one pass ranks the distinct values inside the brackets, so no task sorts more than
    ``most``. Values are never shuffled otherwise. The table is read once, for a narrow copy that all passes go
    over. All of it runs here; the result is a row per probability.
    """
    return _quantiles(stored(_values(df, column), "values"), probabilities, accuracy, most)


def _values(df: DataFrame, column: str) -> DataFrame:
    return df.where(F.col(column).isNotNull()).select(F.col(column).cast("double").alias("v"))


def _quantiles(values: DataFrame, probabilities: list[float], accuracy: int = 10_000, most: int = MOST_SORTED) -> DataFrame:
    total = values.count()
    positions = {float(p): float(p) * (total - 1) for p in probabilities if total}
    at = _values_at(values, sorted({r for x in positions.values() for r in (floor(x), ceil(x))}), total, accuracy, most)
    rows = [(p, at[floor(x)] + (at[ceil(x)] - at[floor(x)]) * (x - floor(x))) for p, x in positions.items()]
    return values.sparkSession.createDataFrame(rows, "probability double, value double")


def iqr_outliers(df: DataFrame, column: str, approx: bool = False) -> DataFrame:
    """Quartiles, the bounds 1.5 interquartile ranges outside them, and what lies beyond."""
    values = _values(df, column) if approx else stored(_values(df, column), "values")
    if approx:
        at = df.agg(F.percentile_approx(F.col(column).cast("double"), [0.25, 0.5, 0.75], 10_000).alias("q"))
        quartiles = at.select(*[F.col("q")[i].alias(n) for i, n in enumerate(("q1", "median", "q3"))])
    else:
        rows = _quantiles(values, [0.25, 0.5, 0.75])
        quartiles = rows.agg(*[
            F.max(F.when(F.col("probability") == p, F.col("value"))).alias(n)
            for p, n in ((0.25, "q1"), (0.5, "median"), (0.75, "q3"))])
    iqr = F.col("q3") - F.col("q1")
    bounds = quartiles.select(F.struct(
        "q1", "median", "q3", iqr.alias("iqr"), (F.col("q1") - 1.5 * iqr).alias("lower_bound"),
        (F.col("q3") + 1.5 * iqr).alias("upper_bound")))
    marked = values.withColumn("b", bounds.scalar())
    beyond = F.count_if((F.col("v") < F.col("b.lower_bound")) | (F.col("v") > F.col("b.upper_bound")))
    summary = marked.agg(F.first("b").alias("b"), beyond.alias("outliers"), F.count("*").alias("n"))
    pct = F.col("outliers").cast("double") / F.col("n").cast("double") * 100
    return summary.select(
        F.lit(column).alias("variable"),
        *[F.round(f"b.{c}", 6).alias(c) for c in ("q1", "median", "q3", "iqr", "lower_bound", "upper_bound")],
        "outliers", F.round(pct, 4).alias("outliers_pct"))


def histogram(df: DataFrame, column: str, bins: int) -> DataFrame:
    """Counts in equal bins between minimum and maximum; the maximum belongs to the last bin."""
    values = _values(df, column)
    span = values.agg(F.struct(F.min("v").alias("lo"), F.max("v").alias("hi"))).scalar()
    placed = values.withColumn("s", span)
    width = (F.col("s.hi") - F.col("s.lo")) / F.lit(float(bins))
    slot = F.when(width == 0, F.lit(1)).otherwise(
        F.least(F.floor((F.col("v") - F.col("s.lo")) / width).cast("int") + 1, F.lit(bins)))
    counts = placed.groupBy(slot.alias("bin")).agg(F.count("*").alias("n"))
    spark = df.sparkSession
    edges = (spark.range(1, bins + 1).select(F.col("id").cast("int").alias("bin")).withColumn("s", span)
             .select("bin", F.round(F.col("s.lo") + (F.col("bin") - 1) * width, 6).alias("bin_start")))
    return edges.join(counts, "bin", "left").select("bin", "bin_start", F.coalesce("n", F.lit(0)).alias("n"))


def size_counts(df: DataFrame, key: str) -> DataFrame:
    """How many groups have each size."""
    sizes = df.where(F.col(key).isNotNull()).groupBy(key).agg(F.count("*").alias("size"))
    return sizes.groupBy("size").agg(F.count("*").alias("n_groups"))


def group_size_summary(df: DataFrame, key: str) -> DataFrame:
    """Count, mean, deviation and quartiles of group sizes, and how many are small or large.

    Works on the counts of sizes, so the percentile sees each size once with its frequency.
    """
    sizes = size_counts(df, key)
    size, freq = F.col("size").cast("double"), F.col("n_groups").cast("double")
    n, s, ss = F.sum(freq), F.sum(size * freq), F.sum(size * size * freq)
    quartiles = F.percentile(F.col("size"), [0.25, 0.5, 0.75], F.col("n_groups"))
    summary = sizes.agg(
        F.sum("n_groups").alias("n_groups"), F.bround(s / n, 2).alias("mean"),
        F.bround(F.sqrt((ss - s * s / n) / F.nullif(n - 1, F.lit(0.0))), 2).alias("std"),
        F.min("size").alias("min"), quartiles.alias("q"), F.max("size").alias("max"),
        *[F.coalesce(F.sum(F.when(test, F.col("n_groups"))), F.lit(0)).alias(name) for name, test in (
            ("n_single", F.col("size") == 1), ("n_2_or_more", F.col("size") >= 2),
            ("n_5_or_more", F.col("size") >= 5), ("n_over_5", F.col("size") > 5),
            ("n_over_10", F.col("size") > 10))])
    share = F.bround(F.col("n_single").cast("double") / F.col("n_groups").cast("double") * 100, 1)
    return summary.select(
        "n_groups", "mean", "std", "min", *[F.col("q")[i].alias(n) for i, n in enumerate(("q1", "median", "q3"))],
        "max", "n_single", share.alias("pct_single"), "n_2_or_more", "n_5_or_more", "n_over_5", "n_over_10")


def null_report(df: DataFrame) -> DataFrame:
    """Columns with NULLs and their share in per cent, from one pass over the table."""
    total = F.count("*").cast("double")
    shares = [F.bround(F.count_if(F.col(c).isNull()).cast("double") / total * 100, 2).alias(c) for c in df.columns]
    wide = df.agg(*shares)
    pairs = F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).alias("null_pct")) for c in df.columns])
    long = wide.select(F.explode(pairs).alias("p")).select("p.*")
    return long.where("null_pct > 0").orderBy(F.desc("null_pct"), F.asc("column"))


def key_report(df: DataFrame, key: list[str]) -> DataFrame:
    """Rows, distinct keys and surplus rows of a candidate key."""
    groups = df.groupBy(*key).agg(F.count("*").alias("n"))
    return groups.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("n_rows"), F.count("*").alias("n_unique"),
        F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("n_duplicate"))


def range_report(items: DataFrame, payments: DataFrame, reviews: DataFrame, orders: DataFrame) -> DataFrame:
    """Counts of values outside their logical range, one pass per table."""
    def counted(df: DataFrame, **tests: Column) -> DataFrame:
        wide = df.agg(*[F.count_if(test).alias(name) for name, test in tests.items()])
        pairs = F.array(*[F.struct(F.lit(n).alias("check"), F.col(n).alias("n")) for n in tests])
        return wide.select(F.explode(pairs).alias("p")).select("p.*")

    early = dates.floor_days(F.col("order_purchase_timestamp"), F.col("order_delivered_customer_date")) < 0
    return (counted(items, negative_price=F.col("price") < 0, negative_freight=F.col("freight_value") < 0)
            .unionByName(counted(payments, negative_payment=F.col("payment_value") < 0))
            .unionByName(counted(reviews, score_out_of_range=~F.col("score").between(1, 5)))
            .unionByName(counted(orders, delivered_before_purchase=early)))


def score_vs_delivery(orders: DataFrame, reviews: DataFrame) -> DataFrame:
    """Mean, median and number of whole delivery days by review score.

    Days are counted per score first; the exact median then sees each day once with its frequency.
    """
    bought, received = F.col("order_purchase_timestamp"), F.col("order_delivered_customer_date")
    slim = orders.select("order_id", received, dates.floor_days(bought, received).alias("days"))
    pairs = delivered_with_review(slim, reviews)
    per_day = pairs.groupBy("score", "days").agg(F.count("*").alias("n"))
    n = F.sum("n").cast("double")
    return per_day.groupBy("score").agg(
        F.bround(F.sum(F.col("days") * F.col("n")).cast("double") / n, 2).alias("mean_days"),
        F.bround(F.percentile(F.col("days"), F.lit(0.5), F.col("n")), 2).alias("median_days"),
        F.sum("n").alias("n_reviews"))


def state_share(df: DataFrame, column: str, state: str) -> DataFrame:
    """Rows of one state and their share in per cent."""
    n = F.count_if(F.col(column) == state)
    total = F.count(column)
    return df.agg(n.alias("n"), F.bround(n.cast("double") / total.cast("double") * 100, 1).alias("pct"))


def origin_destination(
    orders: DataFrame, items: DataFrame, customers: DataFrame, sellers: DataFrame, k: int = 8,
) -> DataFrame:
    """Items between the ``k`` largest seller states and customer states, zero where there are none.

    The flow of states is aggregated here, once; margins, the target grid and the fill work on that.
    """
    flows = stored(item_flows(items, orders, customers, sellers).groupBy("seller_state", "customer_state").agg(
        F.count("*").alias("n_items")), "flows")
    origins = largest_margins(flows, "seller_state", "n_items", k).select("seller_state")
    targets = largest_margins(flows, "customer_state", "n_items", k)
    names = targets.agg(F.collect_list("customer_state")).scalar()
    grid = origins.withColumn("names", names).select("seller_state", F.explode("names").alias("customer_state"))
    return grid.join(flows, ["seller_state", "customer_state"], "left").withColumn(
        "n_items", F.coalesce("n_items", F.lit(0)))


def origin_destination_matrix(long: DataFrame) -> DataFrame:
    """Wide form with one column per customer state; reads the few state names first."""
    names = sorted(r[0] for r in long.select("customer_state").distinct().collect())
    return long.groupBy("seller_state").pivot("customer_state", names).sum("n_items").na.fill(0)


def top_value_counts(df: DataFrame, column: str, k: int) -> DataFrame:
    counts = value_counts(df.where(F.col(column).isNotNull()), column)
    return counts.orderBy(F.desc("n"), F.asc(column)).limit(k)
