"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid
from functools import cache

from pyspark.sql import DataFrame, SparkSession

# Settings that may change while a session runs.
RUNTIME_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split hot join keys even where the grouping above then needs one more (combined) shuffle.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # Merge the rows of one session before the shuffle of a streaming session window.
    "spark.sql.streaming.sessionWindow.merge.sessions.in.local.partition": "true",
}
SETTINGS = {
    **RUNTIME_SETTINGS,
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
}


def build_session(app: str = "feira", master: str | None = None, **extra: str) -> SparkSession:
    """Session with the settings the operators expect; ``extra`` overrides them."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def tune(spark: SparkSession) -> SparkSession:
    """Applies the settings to a session that somebody else has built."""
    for key, value in RUNTIME_SETTINGS.items():
        spark.conf.set(key, value)
    return spark


@cache
def _local_root() -> str:
    return tempfile.mkdtemp(prefix="feira-")


def scratch_path(spark: SparkSession, purpose: str) -> str:
    """New folder name below the cluster's shared ``spark.checkpoint.dir``.

    A machine-local folder is used only where the setting is absent and the session is local.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        root = _local_root()
    return f"{root.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"


def tasks(spark: SparkSession) -> int:
    """Tasks to deal work to that costs much more time than its bytes say, by which partitions are merged otherwise."""
    return 4 * spark.sparkContext.defaultParallelism


def stored(frame: DataFrame, purpose: str, by: str | None = None) -> DataFrame:
    """The rows as a table in the shared folder: what follows reads it, and a lost executor doesn't undo it.

    With ``by`` it has a folder per value of that column, so that what needs one value reads that folder only.
    """
    path = scratch_path(frame.sparkSession, purpose)
    if by is None:
        frame.write.parquet(path)
        return frame.sparkSession.read.parquet(path)
    frame.write.partitionBy(by).parquet(path)
    return frame.sparkSession.read.schema(frame.schema).parquet(path).select(*frame.columns)
