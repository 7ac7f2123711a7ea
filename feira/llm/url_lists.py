"""URL lists over time: dated list entries become validity intervals, captures join those of their fetch day.

Only DataFrame functions. An entry says that a list (``allow`` or ``block``) takes up (``add``) or drops
(``remove``) a domain on a day; it also holds for all subdomains. Entries of a domain and day are summed up
first (a removal outweighs an addition of the same day), so a domain has one state per day at most, however
many entries it has. A capture is judged by host and day, and only distinct pairs of these are judged: a
hot host costs as many rows as there are days. Intervals are dealt to spans of ``BUCKET_DAYS`` days, which
makes the as-of join an equality join.

The most specific active domain decides, an ``allow`` before a ``block``. Null or unparsable URLs have an
empty host, null days match nothing, both are ``none``. Entries with a null list, domain, action or day are
ignored. Repeated captures are judged each; repeated entries change nothing.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BUCKET_DAYS = 32


def host_of(url: str | Column) -> Column:
    """Lower-case host of a URL, without user, port and final dot; empty if there is none."""
    found = F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.\-]*://(?:[^/?#@]*@)?([^/?#:]+)", 1)
    return F.coalesce(F.lower(F.rtrim(found, F.lit("."))), F.lit(""))


def domains_of(host: Column) -> Column:
    """The host and all domains above it."""
    labels = F.split(host, r"\.")
    return F.transform(F.sequence(F.lit(1), F.size(labels)), lambda k: F.array_join(F.slice(labels, k, F.size(labels)), "."))


def _bucket(day: Column) -> Column:
    return F.floor(F.unix_date(day) / BUCKET_DAYS).cast("int")


def intervals(entries: DataFrame) -> DataFrame:
    """(list, domain, since, until): when each list held each domain; until (null: open) is not part of it."""
    states = entries.where("list IS NOT NULL AND domain IS NOT NULL AND action IN ('add', 'remove') AND day IS NOT NULL").groupBy(
        "list", F.lower("domain").alias("domain"), "day").agg(F.max("action").alias("action"))
    order = Window.partitionBy("list", "domain").orderBy("day")
    changes = states.withColumn("before", F.lag("action").over(order)).where(
        (F.col("before").isNull() & (F.col("action") == "add")) | (F.col("before") != F.col("action")))
    return changes.withColumn("until", F.lead("day").over(order)).where("action = 'add'").select(
        "list", "domain", F.col("day").alias("since"), "until")


def judge(captures: DataFrame, entries: DataFrame, url: str = "url", day: str = "day") -> DataFrame:
    """All rows of ``captures`` with host, n_active, verdict, decided_by and listed_since."""
    made = ("host", "n_active", "verdict", "decided_by", "listed_since")
    rows = captures.select(*(c for c in captures.columns if c not in made), host_of(F.col(url)).alias("host"))
    pairs = rows.select("host", F.col(day).cast("date").alias("on")).where("host <> '' AND on IS NOT NULL").distinct()
    last = pairs.agg(_bucket(F.max("on")).alias("final"))
    held = intervals(entries).withColumn("final", last.scalar()).withColumn("bucket", F.explode(F.sequence(
        _bucket(F.col("since")), F.greatest(_bucket(F.col("since")), F.least(
            F.coalesce(_bucket(F.date_sub("until", 1)), F.col("final")), F.col("final"))))))
    asked = pairs.withColumn("domain", F.explode(domains_of(F.col("host")))).withColumn("bucket", _bucket(F.col("on")))
    active = asked.join(held, ["domain", "bucket"]).where("since <= on AND (until IS NULL OR on < until)")
    best = F.max(F.struct(
        F.length("domain").alias("size"), (F.col("list") == "allow").alias("allows"), "list", "domain", "since")).alias("best")
    judged = active.groupBy("host", "on").agg(F.count("*").alias("n_active"), best).select(
        F.col("host").alias("h"), "on", "n_active", F.col("best.list").alias("verdict"), F.col("best.domain").alias("decided_by"),
        F.col("best.since").alias("listed_since"))
    return rows.join(judged, (rows["host"] == judged["h"]) & (rows[day].cast("date") == judged["on"]), "left").select(
        *rows.columns, F.coalesce("n_active", F.lit(0)).cast("long").alias("n_active"), F.coalesce("verdict", F.lit("none")).alias("verdict"),
        "decided_by", "listed_since")


def captures_and_entries(pages: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The pages have no dates: fetch days and list entries follow from the ids and lengths of the URLs.

    Every page is a capture, and every page with a host also stands for one dated entry about its host, or
    about the domain above it.
    """
    def dated(step):
        return F.date_add(F.lit("2020-01-01").cast("date"), F.pmod(F.col("page_id") * step, F.lit(730)).cast("int"))

    captures = pages.select("page_id", "url", dated(37).alias("day"))
    size, host = F.length("url"), host_of(F.col("url"))
    entries = pages.select(
        F.when(size % 2 == 0, "block").otherwise("allow").alias("list"),
        F.when(size % 7 == 0, F.substring_index(host, ".", -2)).otherwise(host).alias("domain"),
        F.when(size % 3 == 0, "remove").otherwise("add").alias("action"), dated(53).alias("day")).where("domain <> ''")
    return captures, entries
