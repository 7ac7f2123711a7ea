"""Parquet tables: orders partitioned by time, archives, published summaries, logs of batches."""

from __future__ import annotations

import hashlib
from collections.abc import Callable
from dataclasses import replace
from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from feira.functions import dates
from feira.operators.sets import latest_per_key
from feira.operators.statistics import key_report
from feira.sources.versions import Version, VersionedTable

BUCKET = "order_bucket"
DEFAULT_BUCKET = "order_default"
BOUGHT = "order_purchase_timestamp"


def order_bucket(ts: Column, as_of: Column, hot_months: int = 12) -> Column:
    """Partition of an order: its month while recent, else its year; ``order_default`` outside time."""
    month = F.date_trunc("month", as_of).cast("timestamp_ntz")
    hot = dates.shift(month, -hot_months, "month")
    end = dates.shift(month, 1, "month")
    monthly = dates.month_partition_name(F.year(ts), F.month(ts))
    return (F.when(ts.isNull() | (ts >= end), DEFAULT_BUCKET).when(ts >= hot, monthly)
            .otherwise(F.format_string("order_%s", F.year(ts).cast("string"))))


def _joined(*parts: dict[str, list[str]]) -> dict[str, list[str]]:
    """The folders of each part, of all mappings."""
    names = {name for p in parts for name in p}
    return {name: [f for p in parts for f in p.get(name, [])] for name in sorted(names)}


def _without(parts: dict[str, list[str]], folders: set[str]) -> dict[str, list[str]]:
    """The mapping without some folders and without parts that then have none."""
    left = {name: [f for f in held if f not in folders] for name, held in parts.items()}
    return {name: held for name, held in left.items() if held}


def _stage_orders(table: VersionedTable, orders: DataFrame, as_of: Column, hot_months: int) -> tuple[dict, DataFrame]:
    """Writes orders by bucket; the rebalance keeps files even where one bucket holds most rows."""
    bucketed = orders.withColumn(BUCKET, order_bucket(F.col(BOUGHT), as_of, hot_months))
    return table.stage(bucketed, BUCKET), bucketed


def write_orders(orders: DataFrame, path: str, as_of: Column, hot_months: int = 12) -> None:
    """Publishes a version of the table that holds these orders, by bucket."""
    table = VersionedTable(orders.sparkSession, path)
    staged, rows = _stage_orders(table, orders, as_of, hot_months)
    table.publish(lambda held: replace(held, schema=rows.schema, parts=staged))


def add_orders(orders: DataFrame, path: str, as_of: Column, hot_months: int = 12) -> None:
    """Publishes a version with these orders beside those that are there."""
    table = VersionedTable(orders.sparkSession, path)
    staged, rows = _stage_orders(table, orders, as_of, hot_months)
    table.publish(lambda held: replace(held, schema=held.schema or rows.schema, parts=_joined(held.parts, staged)))


def replace_orders(orders: DataFrame, path: str, as_of: Column, start: datetime, end: datetime, hot_months: int = 12) -> None:
    """Publishes a version in which these orders stand for all that were bought in [start, end).

    Only the partitions that can hold such orders are read and written; orders bought at other times are ignored.
    """
    table, bought, buckets = VersionedTable(orders.sparkSession, path), F.col(BOUGHT), _buckets_between(start, end)
    inside = F.coalesce((bought >= dates.instant(str(start))) & (bought < dates.instant(str(end))), F.lit(False))
    while True:
        held = table.current()
        moved = sorted(buckets & set(held.parts))
        rest = table.read(held, parts=set(moved).__contains__).drop(BUCKET).where(~inside)
        staged, _ = _stage_orders(table, rest.unionByName(orders.where(inside)), as_of, hot_months)
        if _exchange(table, held, moved, staged):
            return


def read_orders(spark: SparkSession, path: str) -> DataFrame:
    """All orders of the current version."""
    return VersionedTable(spark, path).read()


def _buckets_between(start: datetime, end: datetime) -> set[str]:
    """Every bucket that may hold an instant in [start, end), whenever the table was written."""
    last = end - timedelta(microseconds=1)
    monthly = {f"order_{m // 12}_{m % 12 + 1:02d}" for m in range(_month_number(start), _month_number(last) + 1)}
    return monthly | {f"order_{y}" for y in range(start.year, last.year + 1)} | {DEFAULT_BUCKET}


def scan_orders(spark: SparkSession, path: str, start: datetime, end: datetime) -> DataFrame:
    """Orders bought in [start, end), reading only the partitions that can hold them."""
    bought, buckets = F.col(BOUGHT), _buckets_between(start, end)
    inside = (bought >= dates.instant(str(start))) & (bought < dates.instant(str(end)))
    return VersionedTable(spark, path).read(parts=buckets.__contains__).where(inside)


def _month_of(bucket: str) -> tuple[int, int] | None:
    """Numbers of the first month of a yearly or monthly partition and of the one behind it; none for the default."""
    names = bucket.removeprefix("order_").split("_")
    if not all(p.isdigit() for p in names):
        return None
    first = int(names[0]) * 12 + (int(names[1]) - 1 if len(names) > 1 else 0)
    return first, first + (1 if len(names) > 1 else 12)


def _month_number(at: datetime) -> int:
    return at.year * 12 + at.month - 1


def roll_up_orders(spark: SparkSession, path: str, as_of: datetime, hot_months: int = 12) -> list[str]:
    """Moves months that are no longer recent into their years, and orders whose time has come out of the default.

    Only these partitions are read. Their rows are written under the buckets they belong to now, beside the
    folders that are there, and one version exchanges them, so readers see each order once before and after.
    A run with nothing to move publishes nothing. Returns the partitions that were moved.
    """
    table, now = VersionedTable(spark, path), dates.instant(str(as_of))
    recent = _month_number(as_of) - hot_months
    while True:
        held = table.current()
        cold = [b for b in held.parts if b.count("_") == 2 and (span := _month_of(b)) and span[0] < recent]
        waiting = table.read(held, parts=DEFAULT_BUCKET.__eq__)
        due = waiting.where(order_bucket(F.col(BOUGHT), now, hot_months) != DEFAULT_BUCKET)
        moved = sorted(cold + ([] if due.isEmpty() else [DEFAULT_BUCKET]))
        if not moved:
            return []
        staged, _ = _stage_orders(table, table.read(held, parts=set(moved).__contains__).drop(BUCKET), now, hot_months)
        if _exchange(table, held, moved, staged):
            return moved


def _exchange(table: VersionedTable, held: Version, moved: list[str], staged: dict[str, list[str]]) -> bool:
    """Publishes the staged folders in place of those that ``moved`` had in ``held``; false if one of these is gone."""
    old = {f for part in moved for f in held.parts[part]}
    seen = []

    def change(now: Version) -> Version | None:
        seen[:] = [old <= now.folders()]
        return replace(now, parts=_joined(_without(now.parts, old), staged)) if seen[0] else None

    table.publish(change)
    return seen[0]


def archive_orders(spark: SparkSession, path: str, archive_path: str, as_of: datetime, months: int = 24) -> list[str]:
    """Moves yearly and monthly partitions that ended ``months`` ago to the archive and returns their names.

    The default partition holds what has no partition of its own yet and stays live. The archive's version
    notes which live folders it has copied, so orders count once between its publication and that of the
    live table, and an interrupted move can be run again. Late orders of an archived year have folders of
    their own and stay live until the next move.
    """
    live, archive = VersionedTable(spark, path), VersionedTable(spark, archive_path)
    held, last = live.current(), _month_number(as_of) - months
    old = {b: f for b, f in held.parts.items() if (span := _month_of(b)) and span[1] <= last}
    if not old:
        return []
    wanted, copied = {f for folders in old.values() for f in folders}, set(archive.current().notes.get("copied", []))
    if fresh := wanted - copied:
        rows = live.read(held, parts=old.__contains__, without=copied)
        staged = archive.stage(rows, BUCKET)

        def add(now: Version) -> Version | None:
            if fresh & set(now.notes.get("copied", [])):  # another move was faster
                return None
            return replace(now, schema=now.schema or rows.schema, parts=_joined(now.parts, staged),
                           notes={**now.notes, "copied": sorted({*now.notes.get("copied", []), *fresh})})

        archive.publish(add)
    done = wanted & set(archive.current().notes["copied"])
    live.publish(lambda now: replace(now, parts=_without(now.parts, done)) if done & now.folders() else None)
    return sorted(old)


def read_with_archive(spark: SparkSession, path: str, archive_path: str) -> DataFrame:
    """Live and archived orders, each once. The live version is settled first: what leaves it later is still read there."""
    live, archive = VersionedTable(spark, path), VersionedTable(spark, archive_path)
    held, stored = live.current(), archive.current()
    rows = live.read(held, without=set(stored.notes.get("copied", [])))
    return rows.unionByName(archive.read(stored)) if stored.parts else rows


def refresh_summary(df: DataFrame, path: str, key: list[str]) -> int:
    """Publishes a new version of a summary table while readers stay on the old one; returns its number.

    The rows go to a folder of their own and become current once the key has proved unique.
    """
    table = VersionedTable(df.sparkSession, path)
    staged = table.stage(df)
    report = key_report(table.read(Version(schema=df.schema, parts=staged)), key).first()
    if report["n_duplicate"]:
        raise ValueError(f"{report['n_duplicate']} surplus rows for key {key}; the old version stays current")
    return table.publish(lambda held: replace(held, schema=df.schema, parts=staged)).number


def refresh_parts(df: DataFrame, path: str, key: list[str], by: str, values: list | None = None) -> int:
    """Publishes a version of a summary in which ``df`` stands for some values of its column ``by``; returns its number.

    The other values keep their folders, which are neither read nor written. ``df`` holds rows of these values only;
    without ``values`` it stands for those that it has rows of.
    """
    table = VersionedTable(df.sparkSession, path)
    staged = table.stage(df, by)
    wanted = set(staged) if values is None else {str(v) for v in values}
    if stray := sorted(set(staged) - wanted):
        raise ValueError(f"rows of other values of {by}: {stray}")
    report = key_report(table.read(Version(schema=df.schema, parts=staged)), key).first()
    if report["n_duplicate"]:
        raise ValueError(f"{report['n_duplicate']} surplus rows for key {key}; the old version stays current")
    return table.publish(lambda held: replace(
        held, schema=df.schema, parts={v: f for v, f in held.parts.items() if v not in wanted} | staged)).number


def read_summary(spark: SparkSession, path: str) -> DataFrame:
    """Rows of the current version."""
    return VersionedTable(spark, path).read()


def vacuum(spark: SparkSession, path: str, keep: int = 2) -> list[str]:
    """Deletes what only versions before the newest ``keep`` named, of any table here. Readers older than these fail."""
    return VersionedTable(spark, path).vacuum(keep)


def _writer(name: str) -> str:
    """A batch is known by its writer's checkpoint and its number: another checkpoint counts from zero again."""
    return hashlib.sha1(name.encode()).hexdigest()[:12]


MERGED = "merged"


def append_batch(batch: DataFrame, path: str, batch_id: int, writer: str = "", by: str | None = None) -> None:
    """Adds a batch to a log; running the same batch again replaces it instead of adding it twice.

    A batch that :func:`merge_log` has taken in already is left as it is there. With ``by`` the batch has a
    folder per value of that column, which :func:`read_log` can choose from.
    """
    rows = batch.withColumn("batch_id", F.lit(batch_id).cast("long"))
    table, who = VersionedTable(batch.sparkSession, path), _writer(writer)
    part = f"{who}#{batch_id}"

    def done(held: Version) -> bool:
        return who in held.notes.get(MERGED, {}) and batch_id <= held.notes[MERGED][who]

    def change(held: Version) -> Version | None:
        left = {p: f for p, f in held.parts.items() if p.split("/")[0] != part}
        return None if done(held) else replace(held, schema=held.schema or rows.schema, parts=left | added)

    if not done(table.current()):
        added = {f"{part}/{value}": folders for value, folders in table.stage(rows, by).items()}
        table.publish(change)


def has_batches(spark: SparkSession, path: str) -> bool:
    return VersionedTable(spark, path).current().schema is not None


def read_log(spark: SparkSession, path: str, values: set[str] | None = None) -> DataFrame:
    """Rows of all batches, with ``batch_id``; of a log with folders by a column, those with some of its values."""
    return VersionedTable(spark, path).read(parts=lambda part: values is None or part.split("/")[1] in values)


def read_latest(spark: SparkSession, path: str, keys: list[str], order: list[str]) -> DataFrame:
    """Newest version per key over all batches of a log."""
    return latest_per_key(read_log(spark, path).drop("batch_id"), keys, order)


def merge_log(spark: SparkSession, path: str, merge: Callable[[DataFrame], DataFrame], by: str | None = None) -> int:
    """Replaces the finished batches of a log by one, which ``merge`` makes of their rows; returns how many it took in.

    ``merge`` gets the rows with ``batch_id`` and returns the other columns; the merged rows carry the last number.
    A stream may go on meanwhile: batches that come in later stay beside the merged one, and if one that was read
    is replaced, the merge starts anew. With ``by`` the merged rows have a folder per value of that column.
    """
    table = VersionedTable(spark, path)
    while True:
        held = table.current()
        taken = sorted({p.split("/")[0] for p in held.parts} - {MERGED})
        if not taken:
            return 0
        last: dict[str, int] = dict(held.notes.get(MERGED, {}))
        for who, number in (p.split("#") for p in taken):
            last[who] = max(last.get(who, -1), int(number))
        merged = merge(table.read(held)).withColumn("batch_id", F.lit(max(last.values())).cast("long"))
        staged = {f"{MERGED}/{value}": f for value, f in table.stage(merged.select(*held.schema.names), by).items()}
        seen = []

        def change(now: Version) -> Version | None:
            seen[:] = [all(now.parts.get(p) == f for p, f in held.parts.items())]
            left = {p: f for p, f in now.parts.items() if p not in held.parts}
            return replace(now, parts=left | staged, notes={**now.notes, MERGED: last}) if seen[0] else None

        table.publish(change)
        if seen[0]:
            return len(taken)
