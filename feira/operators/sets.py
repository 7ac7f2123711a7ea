"""Unions, duplicate removal, inserts and versions by key."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from feira.functions.values import comparable


def union_counts(frames: dict[str, DataFrame]) -> DataFrame:
    """One row per named frame with its number of rows."""
    counts = [df.agg(F.count("*").alias("n")).select(F.lit(name).alias("tbl"), "n") for name, df in frames.items()]
    return reduce(DataFrame.unionByName, counts)


def table_counts(frames: dict[str, DataFrame], expected: dict[str, int]) -> DataFrame:
    """Row counts beside the expected volumes; tables without an expectation keep NULL."""
    counts = union_counts(frames)
    wanted = F.create_map(*[F.lit(x) for pair in expected.items() for x in pair]).cast("map<string,bigint>")
    return counts.withColumn("expected", F.try_element_at(wanted, F.col("tbl"))).withColumn(
        "difference", F.col("n") - F.col("expected"))


def pick_per_key(df: DataFrame, keys: list[str], rank: Column, latest: bool) -> DataFrame:
    """One row per key, the one with the greatest or smallest rank.

    An aggregate rather than a window: rows of a hot key are reduced before the shuffle.
    """
    rest = [c for c in df.columns if c not in keys]
    choose = F.max_by if latest else F.min_by
    return df.groupBy(*keys).agg(choose(F.struct(*rest), rank).alias("row")).select(*keys, "row.*").select(*df.columns)


def dedupe(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """First row of each key in the given order."""
    return pick_per_key(df, keys, F.struct(*order), latest=False)


def latest_per_key(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """Newest version of each key; later columns of ``order`` break ties, then the fingerprint of the row."""
    return pick_per_key(df, keys, F.struct(*[F.col(c) for c in order], _tie(df, keys + order).alias("tie")), latest=True)


def _tie(df: DataFrame, without: list[str]) -> Column:
    """Fingerprint of all other columns, so that a choice among equal instants can be repeated."""
    rest = [f for f in df.schema.fields if f.name not in without]
    return F.xxhash64(*[comparable(F.col(f.name), f.dataType) for f in rest]) if rest else F.lit(0)


def insert_ignore(target: DataFrame, batch: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """Target plus the batch rows whose key is new; repeats inside the batch keep the first."""
    fresh = dedupe(batch, keys, order).join(target.select(*keys), keys, "left_anti")
    return target.unionByName(fresh)


def upsert_latest(target: DataFrame, batch: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """Newest version per key of target and batch.

    Applying a batch twice, or batches in another order, gives the same result. On equal
    ``order`` values the row with the greater fingerprint stays, whichever side it is on.
    """
    both = target.unionByName(batch.select(*target.columns))
    return latest_per_key(both, keys, order)


def stamp_changes(old: DataFrame, new: DataFrame, keys: list[str], as_of: Column,
                  stamp: str = "updated_at") -> DataFrame:
    """New rows; ``stamp`` becomes ``as_of`` where a row is new or differs from the old one."""
    values = [c for c in new.columns if c not in keys and c != stamp]

    def digest(df: DataFrame, name: str) -> DataFrame:
        return df.select("*", F.sha2(F.to_json(F.struct(*values), {"ignoreNullFields": "false"}), 256).alias(name))

    before = digest(old, "old_digest").select(*keys, "old_digest", F.col(stamp).alias("old_stamp"))
    joined = digest(new, "new_digest").drop(stamp).join(before, keys, "left")
    same = F.col("old_digest").isNotNull() & (F.col("old_digest") == F.col("new_digest"))
    return joined.select(*keys, *values, F.when(same, F.col("old_stamp")).otherwise(as_of).alias(stamp))


def extract_since(df: DataFrame, column: str, watermark: Column) -> DataFrame:
    """Rows changed at or after the watermark; the filter reaches the Parquet scan."""
    return df.where(F.col(column) >= watermark)
