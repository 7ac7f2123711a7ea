"""Shards of near equal bytes by histogram sort: probes refined by exact counts, then one exchange.

Rows are ordered by a key: the hash of the text, then the hash of the whole row, so equal texts lie side by
side and the order has nothing to do with source or length. Only (key, size) is read to find the cuts:

1. Every wanted cut, a number of bytes below it, starts with the whole key range as its bracket.
2. Probes are spread over each open bracket. A pass counts the exact bytes and the first and last key between
   neighbouring probes, summed per task before the shuffle.
3. A cut's bracket becomes the stretch that holds its number, from its first to its last key. It closes when a
   probe lies within the tolerance, or when one key is left. A key that many equal rows share is cut inside, by
   a share of its rows; a single row goes to the nearer side.

Shards are cut with ``TOLERANCE`` of a shard. Between them lie looser cuts, so that a task sorts and writes a
piece of about ``PIECE_BYTES``, however large a shard is. Whole rows are exchanged once, by piece, sorted and
written as files of one shard each, with their position in the piece; reading adds the rows of the pieces before.
A row's slot in its shard is gapless from 0.

Null texts have size ``OVERHEAD`` and count as empty. Repeated rows are rows of their own and may go to several
shards, as may equal texts where a cut falls between them. No shard can be closer to the others than the largest
row. An empty table has no rows. Rows are told apart by all their columns; other columns travel along, but for
those called like the new ones (``NEW``), which are replaced.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from feira.functions.values import comparable
from feira.llm.components import written
from feira.llm.shared import bounded_batches, tidy, utf8
from feira.session import scratch_path

SHARDS = 24
OVERHEAD = 8  # bytes of a row beside its text
TOLERANCE = 0.0005
PIECE_BYTES = 64 << 20
MOST_PIECES = 4096  # for each shard
PROBES = 64  # for each open cut, while few are open
MOST_PROBES = 200_000
NEW = ("shard", "slot", "size", "piece", "place", "key_a", "key_b")
END = 1 << 128


def _whole(key: bytes) -> int:
    return int.from_bytes(key, "big")


def _bytes(keys: list[int]) -> np.ndarray:
    """Keys as fixed-width bytes that sort as the numbers do."""
    return np.frombuffer(b"".join(k.to_bytes(16, "big") for k in keys), "S16")


def _joined(*parts: np.ndarray) -> np.ndarray:
    """Signed 64-bit columns as one column of bytes in the same order."""
    shifted = [p.astype(np.int64).view(np.uint64) ^ np.uint64(1 << 63) for p in parts]
    return np.ascontiguousarray(np.stack(shifted, axis=1).astype(">u8")).view(f"S{8 * len(parts)}").ravel()


def _padded(found: np.ndarray, width: int) -> list[bytes]:
    """numpy drops zero bytes at the end of such values; they belong to the key."""
    return [bytes(k).ljust(width, b"\0") for k in found]


def _histogram(probes: np.ndarray):
    """(stretch, bytes, rows, first, last) of the keys between probes, per task."""
    def each(batches):
        for batch in batches:
            keys = _joined(batch.column(0).to_numpy(), batch.column(1).to_numpy())
            order = np.argsort(keys)
            keys, sizes = keys[order], batch.column(2).to_numpy()[order]
            stretch = np.searchsorted(probes, keys, side="right")
            heads = np.flatnonzero(np.concatenate(([True], stretch[1:] != stretch[:-1]))) if len(keys) else np.zeros(0, np.int64)
            tails = np.append(heads[1:], len(keys))[:len(heads)]
            yield pa.RecordBatch.from_arrays([
                pa.array(stretch[heads].astype(np.int32)), pa.array(np.add.reduceat(sizes, heads) if len(heads) else sizes[:0]),
                pa.array((tails - heads).astype(np.int64)), pa.array(_padded(keys[heads], 16), pa.binary()),
                pa.array(_padded(keys[tails - 1], 16), pa.binary())], names=["stretch", "bytes", "n", "first", "last"])

    return each


def histogram(keyed: DataFrame, probes: list[int]) -> list[tuple[int, int, int, int, int]]:
    """(stretch, bytes, rows, first key, last key) between sorted probes, for stretches that hold rows."""
    parts = keyed.mapInArrow(tidy(_histogram(_bytes(probes))), "stretch int, bytes long, n long, first binary, last binary")
    sums = parts.groupBy("stretch").agg(F.sum("bytes"), F.sum("n"), F.min("first"), F.max("last")).collect()  # one row per probe at most
    return sorted((r[0], r[1], r[2], _whole(bytes(r[3])), _whole(bytes(r[4]))) for r in sums)


def cuts(keyed: DataFrame, wanted: list[tuple[float, float]]) -> list[int]:
    """Keys of 24 bytes, the last eight a share of equal rows, for each (bytes below, tolerance), by exact counts."""
    found: dict[int, int] = {}
    open_at = {k: (0, 0, END - 1) for k in range(len(wanted))}  # bytes below the bracket, its first and last key
    while open_at:
        each = max(2, min(PROBES, MOST_PROBES // len(open_at)))
        probes = {first for _, first, _ in open_at.values()} | {last + 1 for _, _, last in open_at.values() if last + 1 < END}
        for _, first, last in set(open_at.values()):
            probes |= {last} | {first + (last - first) * j // each for j in range(1, each)}
        ordered = sorted(probes)
        rows = histogram(keyed, ordered)
        ends = np.cumsum([r[1] for r in rows])
        for k in list(open_at):
            below, tolerance = wanted[k]
            at = int(np.searchsorted(ends, below, side="left"))
            if at >= len(rows):  # all rows lie below
                found[k] = END << 64
                del open_at[k]
                continue
            _, n_bytes, n, first, last = rows[at]
            before = int(ends[at]) - n_bytes
            if below - before <= tolerance:
                found[k] = first << 64
            elif ends[at] - below <= tolerance:
                found[k] = (last + 1) << 64
            elif first == last:
                share = (below - before) / n_bytes
                share = round(share) if n == 1 else share
                found[k] = (first << 64) + min(int(share * 2**64), 2**64) if share < 1 else (first + 1) << 64
            else:
                open_at[k] = (before, first, last)
                continue
            del open_at[k]
    return [found[k] for k in range(len(wanted))]


def _keyed(docs: DataFrame, text: str) -> dict[str, Column]:
    return {
        "key_a": F.xxhash64(utf8(text)),
        "key_b": F.xxhash64(*[comparable(F.col(f"`{f.name}`"), f.dataType) for f in docs.schema.fields]),
        "size": F.octet_length(utf8(text)).cast("long") + F.lit(OVERHEAD).cast("long")}


def write_shards(docs: DataFrame, path: str, shards: int = SHARDS, text: str = "text") -> StructType:
    """All columns of ``docs`` below ``path`` as ``shard=…`` folders, each file in the order of its shard; the schema of them."""
    spark = docs.sparkSession
    bounded_batches(spark)
    docs = docs.drop(*NEW)
    columns = _keyed(docs, text)
    keyed = written(docs.select(*[c.alias(n) for n, c in columns.items()]), "keys")
    total = keyed.agg(F.coalesce(F.sum("size"), F.lit(0))).first()[0]
    pieces = int(min(MOST_PIECES, max(1, -(-total // (shards * PIECE_BYTES)))))
    step = total / (shards * pieces)
    limits = cuts(keyed, [(step * k, total / shards * TOLERANCE if k % pieces == 0 else step / 4) for k in range(1, shards * pieces)])
    splitters = spark.sparkContext.broadcast(sorted(limits))  # at most shards * MOST_PIECES

    @F.arrow_udf("int")
    def piece(key_a: pa.Array, key_b: pa.Array, number: pa.Array) -> pa.Array:
        spread = number.to_numpy().astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)  # even over [0, 2^64)
        rows = _joined(key_a.to_numpy(), key_b.to_numpy(), (spread ^ np.uint64(1 << 63)).view(np.int64))
        limit = np.frombuffer(b"".join(min(c, 2**192 - 1).to_bytes(24, "big") for c in splitters.value), "S24")
        return pa.array(np.searchsorted(limit, rows, side="right").astype(np.int32))

    placed = docs.withColumns(columns).withColumn("piece", piece("key_a", "key_b", F.monotonically_increasing_id()))
    placed = placed.withColumn("shard", F.floor(F.col("piece") / pieces).cast("int"))
    order = Window.partitionBy("shard", "piece").orderBy("key_a", "key_b")
    placed = placed.withColumn("place", F.row_number().over(order) - 1).drop("key_a", "key_b")
    placed.write.option("compression", "zstd").partitionBy("shard").parquet(path)
    return placed.schema


def read_shards(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """The rows that :func:`write_shards` has written, with shard and slot."""
    rows = spark.read.schema(schema).parquet(path)
    counts = rows.groupBy("shard", "piece").agg(F.max("place").alias("last"))
    before = Window.partitionBy("shard").orderBy("piece").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select("shard", "piece", F.coalesce(F.sum(F.col("last") + 1).over(before), F.lit(0)).alias("start"))
    # One row per piece, shards * MOST_PIECES at most: the rows themselves are not shuffled again.
    return rows.join(F.broadcast(starts), ["shard", "piece"]).withColumn("slot", F.col("start") + F.col("place")).drop("start", "piece", "place")


def shard_documents(docs: DataFrame, shards: int = SHARDS) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot, grown_shard of all documents, read back from their shards."""
    path = scratch_path(docs.sparkSession, "shards")
    schema = write_shards(docs, path, shards)
    return read_shards(docs.sparkSession, path, schema).select(
        "doc_id", "size", F.crc32(utf8("text")).alias("text_crc32"), F.lit("bytes").alias("law"), "shard",
        F.col("slot").cast("long").alias("slot"), F.lit(None).cast("int").alias("grown_shard"))
