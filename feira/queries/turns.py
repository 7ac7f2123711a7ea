"""Rows that come to a stream in turns."""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from feira.session import scratch_path


def run_turns(spark, turns: Iterable[DataFrame], purpose: str, run: Callable[[DataFrame, str, str], StreamingQuery]) -> str:
    """Brings each turn, in as many files as it has tasks, and has the stream take it in as one batch; returns the log's path."""
    path = scratch_path(spark, purpose)
    for rows in turns:
        rows.write.mode("append").parquet(f"{path}/in")
        stream = spark.readStream.schema(rows.schema).parquet(f"{path}/in")
        run(stream, f"{path}/log", f"{path}/checkpoint").awaitTermination()
    return f"{path}/log"
