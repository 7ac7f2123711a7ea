"""Sorted heads of a frame, overall and per group."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F


def top_k(df: DataFrame, order: list[Column], key: str, k: int) -> DataFrame:
    """First ``k`` rows; the unique key breaks ties, so the result is repeatable."""
    return df.orderBy(*order, F.asc(key)).limit(k)


def top_k_per_group(df: DataFrame, group: list[str], order: list[Column], k: int, rank: str = "rank") -> DataFrame:
    """First ``k`` rows of each group.

    The filter on the row number lets Spark cut every group to ``k`` rows before the shuffle,
    so a hot group never arrives whole in one task.
    """
    numbered = df.withColumn(rank, F.row_number().over(Window.partitionBy(*group).orderBy(*order)))
    return numbered.where(F.col(rank) <= k)


def largest_margins(df: DataFrame, group: str, amount: str, k: int) -> DataFrame:
    """Groups with the greatest sums."""
    sums = df.groupBy(group).agg(F.sum(amount).alias("total"))
    return top_k(sums, [F.desc_nulls_last("total")], group, k)
