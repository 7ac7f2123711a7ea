"""Loads of source files that keep going: rows that do not fit are set aside with their reason, mended and replayed.

Below a path, ``rows`` is the log of what was loaded and ``rejected`` the log of lines that were not, with the
file, the text of the line, what is wrong and how often it was tried. A line is a row of one of the two after
each load and each replay; both logs replace a batch that runs again.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from feira.functions import dates
from feira.schemas import SOURCE_COLUMNS
from feira.session import stored
from feira.sources.tables import append_batch, read_log
from feira.sources.versions import Version, VersionedTable

TEXT = "line"
CSV = {"escape": '"', "mode": "PERMISSIVE"}
MOST_TRIES = 3


def _raw(name: str, also: str = "") -> str:
    """Fields as the file has them: dates stay text."""
    return ", ".join(f"{c} {'string' if kind == 'timestamp_ntz' else kind}" for c, kind in SOURCE_COLUMNS[name]) + also


def _typed(rows: DataFrame, name: str) -> list[Column]:
    return [dates.lenient_timestamp(F.col(c)).alias(c) if kind == "timestamp_ntz" else F.col(c) for c, kind in SOURCE_COLUMNS[name]]


def _reason(name: str) -> Column:
    """The columns whose text is no value of their type; without any, the number of fields is wrong."""
    fields = F.from_csv(F.col(TEXT), F.lit(", ".join(f"`{c}` string" for c, _ in SOURCE_COLUMNS[name])), CSV)
    wrong = F.array_compact(F.array(*[
        F.when(fields[c].isNotNull() & fields[c].try_cast(kind).isNull(), F.lit(c)) for c, kind in SOURCE_COLUMNS[name] if kind not in ("string", "timestamp_ntz")]))
    return F.when(F.size(wrong) > 0, F.concat(F.lit("not of its type: "), F.array_join(wrong, ", "))).otherwise("wrong number of fields")


def load_source(spark: SparkSession, folder: str, name: str, path: str, batch_id: int = 0) -> None:
    """Loads the files of a source table; dates that cannot be parsed become NULL, lines that do not fit are set aside.

    Lines are read one by one, so tables with line breaks in their texts need :func:`feira.sources.files.read_source`.
    """
    reader = spark.read.schema(_raw(name, f", {TEXT} string")).options(**CSV, header=True, columnNameOfCorruptRecord=TEXT)
    rows = reader.csv(f"{folder}/{name}").select("*", F.col("_metadata.file_path").alias("file"))
    # Written once: Spark may otherwise parse only the columns that each use needs, and a fault outside them goes unseen.
    parsed = stored(rows.select(*_typed(rows, name), TEXT, "file"), "parsed")
    append_batch(parsed.where(F.col(TEXT).isNull()).drop(TEXT, "file"), f"{path}/rows", batch_id)
    bad = parsed.where(F.col(TEXT).isNotNull())
    append_batch(bad.select("file", TEXT, _reason(name).alias("reason"), F.lit(1).alias("tries")), f"{path}/rejected", batch_id)


def read_loaded(spark: SparkSession, path: str) -> DataFrame:
    """The rows that were loaded, at once or after mending."""
    return read_log(spark, f"{path}/rows").drop("batch_id")


def read_rejected(spark: SparkSession, path: str) -> DataFrame:
    """(file, line, reason, tries, given_up) of the lines that are set aside."""
    return read_log(spark, f"{path}/rejected").drop("batch_id").withColumn("given_up", F.col("tries") > MOST_TRIES)


def replay_rejected(spark: SparkSession, name: str, path: str, mend: Callable[[Column], Column]) -> int:
    """Tries the waiting lines again after ``mend`` and returns how many fit now; the others wait on with one try more.

    Lines tried more than ``MOST_TRIES`` times are left as they are, for somebody to look at. The turn is numbered by
    the version of the rejected lines it starts from, so a turn that failed half-way replaces its own rows.
    """
    table = VersionedTable(spark, f"{path}/rejected")
    while True:
        held = table.current()
        lines = table.read(held)
        again = lines.where(F.col("tries") <= MOST_TRIES).select("file", mend(F.col(TEXT)).alias(TEXT), "tries")
        parsed = F.from_csv(F.col(TEXT), F.lit(_raw(name, ", bad string")), {**CSV, "columnNameOfCorruptRecord": "bad"})
        tried = stored(again.withColumn("row", parsed), "replayed")
        good = tried.where(F.col("row.bad").isNull()).select("row.*")
        append_batch(good.select(*_typed(good, name)), f"{path}/rows", held.number, "replay")
        waiting = tried.where(F.col("row.bad").isNotNull()).select("file", TEXT, _reason(name).alias("reason"), (F.col("tries") + 1).alias("tries"))
        left = waiting.unionByName(lines.where(F.col("tries") > MOST_TRIES).drop("batch_id")).withColumn("batch_id", F.lit(held.number).cast("long"))
        staged, seen = table.stage(left.select(*held.schema.names)), []

        def change(now: Version) -> Version | None:
            seen[:] = [now.parts == held.parts]
            return replace(now, parts={f"replay#{held.number}/all": staged["all"]}) if seen[0] else None

        table.publish(change)
        if seen[0]:
            return good.count()
