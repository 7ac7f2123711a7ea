"""Ordered calculations per key: running totals, previous and next rows, sessions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from feira.functions import dates


def cumulative_orders(orders: DataFrame, k: int | None = 10) -> DataFrame:
    """Orders per month and their running total; the last ``k`` months.

    The window runs over one row per month.
    """
    monthly = orders.groupBy(dates.month_start(F.col("order_purchase_timestamp")).alias("month")).agg(
        F.count("*").alias("n_orders")).where(F.col("month").isNotNull())
    running = F.sum("n_orders").over(Window.orderBy("month").rowsBetween(Window.unboundedPreceding, 0))
    summed = monthly.withColumn("n_cumulative", running)
    return summed if k is None else summed.orderBy(F.desc("month")).limit(k)


def _neighbour(df: DataFrame, keys: list[str], order: list[str], values: list[str], at: Column, back: bool,
               name: str) -> DataFrame:
    """Adds ``name``, a struct of ``values`` of the previous or next row of the same key.

    Keys are cut into slices of time, so the rows of a hot key spread over many tasks. Inside a
    slice a window finds the neighbour; only the rows at a slice's edge take it from the
    nearest slice with rows, through one summary row per key and slice.
    """
    position = F.struct(*order)
    content = F.struct(*values)
    sliced = df.withColumn("_slice", at)
    inside = Window.partitionBy(*keys, "_slice").orderBy(*order)
    shift = F.lag if back else F.lead
    # Input that is already partitioned by key alone would keep all slices of a key in one task.
    spread = sliced.repartition(*keys, "_slice")
    near = spread.withColumn("_near", shift(content).over(inside))
    pick = F.max_by if back else F.min_by
    edges = sliced.groupBy(*keys, "_slice").agg(pick(content, position).alias("_edge"))
    across = Window.partitionBy(*keys).orderBy("_slice")
    linked = edges.select(*keys, "_slice", shift("_edge").over(across).alias("_far"))
    joined = near.join(linked, [*keys, "_slice"])
    return joined.withColumn(name, F.coalesce("_near", "_far")).drop("_slice", "_near", "_far")


def with_previous(df: DataFrame, keys: list[str], order: list[str], values: list[str], at: Column,
                  name: str = "previous") -> DataFrame:
    return _neighbour(df, keys, order, values, at, True, name)


def with_next(df: DataFrame, keys: list[str], order: list[str], values: list[str], at: Column,
              name: str = "following") -> DataFrame:
    return _neighbour(df, keys, order, values, at, False, name)


def with_previous_status(versions: DataFrame) -> DataFrame:
    """Adds ``from_status``. An order has a handful of versions, so one window by order does."""
    by_time = Window.partitionBy("order_id").orderBy("changed_at", "step")
    return versions.withColumn("from_status", F.lag("order_status").over(by_time))


def status_transitions(versions: DataFrame) -> DataFrame:
    """Status log of orders: the initial status and every real change.

    ``versions`` hold order_id, order_purchase_timestamp, step, order_status and changed_at;
    step orders versions of the same instant.
    """
    linked = with_previous_status(versions)
    rest = [c for c in versions.columns if c != "order_status"]
    return linked.where(~F.col("from_status").eqNullSafe(F.col("order_status"))).select(
        *rest, "from_status", F.col("order_status").alias("to_status"))


def time_in_status(history: DataFrame) -> DataFrame:
    """Hours each order spent in each status until the next change; the last status is open."""
    by_time = Window.partitionBy("order_id").orderBy("changed_at", "step")
    seconds = F.timestamp_diff("SECOND", F.col("changed_at"), F.lead("changed_at").over(by_time))
    return history.select("order_id", F.col("to_status").alias("status"), "changed_at", seconds.alias("seconds"))


def mean_time_in_status(history: DataFrame) -> DataFrame:
    spent = time_in_status(history)
    hours = F.sum("seconds").cast("double") / F.count("seconds").cast("double") / 3600
    return spent.groupBy("status").agg(
        F.count("*").alias("n"), F.count("seconds").alias("n_left"), F.round(hours, 3).alias("mean_hours"))
