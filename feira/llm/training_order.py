"""Token files in training order: a keyed permutation gives every sequence its place, shards hold the places.

Texts become token ids and are cut to sequences of ``SEQUENCE`` tokens. The sequences are written once;
their number follows from the file and the row they stand in, without a shuffle. A keyed Feistel network
over the next power of four permutes the numbers; results outside the range go through it again until they
fall inside (cycle walking), which keeps it a permutation of exactly the sequences there are. Places are
dealt to shards by range, each shard is one file of records of equal length, so the record of any place is
found by multiplication and reading resumes anywhere.

The table of sequences, their shuffle and the files each hold all tokens. So the table is compressed by zstd,
and the shards are written in ``PASSES`` passes over it: each shuffles the sequences of its shards only, and
Spark removes the files of this shuffle when the pass ends.

A record is the document id and the part (signed 64 and 32 bits), the number of tokens (32 bits) and the
token ids (16 bits each), little-endian, filled up with ``FILL``. A null id is stored as the smallest
number. Null and empty texts make no sequence. Repeated rows have sequences of their own. The files of an
empty table are none.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from feira.llm.byte_bpe import encode_text, encoding
from feira.llm.components import written
from feira.llm.shared import bounded_batches, parts_for, tidy, tidy_group, utf8
from feira.session import scratch_path

SEQUENCE = 256
SHARD_RECORDS = 16_384
PASSES = 4
FILL = 50_256
ROUNDS = 6
BROADCAST_FILES = 50_000
REMOVES_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
NO_ID = np.iinfo(np.int64).min


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def places(numbers: np.ndarray, total: int, key: str) -> np.ndarray:
    """Permutation of range(total): the place of each number."""
    half = np.uint64(max(1, -(-max(1, total - 1).bit_length() // 2)))
    mask = (np.uint64(1) << half) - np.uint64(1)
    keys = [np.uint64(int.from_bytes(hashlib.sha256(f"{key}/{k}".encode()).digest()[:8], "little")) for k in range(ROUNDS)]

    def network(x):
        left, right = x >> half, x & mask
        for k in keys:
            left, right = right, left ^ (_mix(right ^ k) & mask)
        return (left << half) | right

    x = network(numbers.astype(np.uint64))
    while (outside := np.flatnonzero(x >= np.uint64(total))).size:
        x[outside] = network(x[outside])
    return x.astype(np.int64)


def record_type(sequence: int) -> np.dtype:
    return np.dtype([("doc", "<i8"), ("part", "<i4"), ("n", "<i4"), ("tokens", "<u2", (sequence,))])


def sequences(docs: DataFrame, ranks_path: str, pattern: str, key: str = "doc_id", text: str = "text", sequence: int = SEQUENCE) -> DataFrame:
    """(doc, part, tokens): the sequences of all texts, in a table of the shared folder."""
    bounded_batches(docs.sparkSession)

    def each(batches):
        by = encoding(ranks_path, pattern)
        for batch in batches:
            owner, parts, tokens = [], [], []
            for doc, data in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                ids = encode_text(data.decode("utf-8", "replace"), by).astype("<u2")
                for k in range(0, len(ids), sequence):
                    owner.append(doc)
                    parts.append(k // sequence)
                    tokens.append(ids[k:k + sequence].tobytes())
            yield pa.RecordBatch.from_arrays(
                [pa.array(owner, pa.int64()), pa.array(parts, pa.int32()), pa.array(tokens, pa.binary())], names=["doc", "part", "tokens"])

    return written(docs.select(F.col(key).cast("long").alias("doc"), utf8(text).alias("b")).mapInArrow(
        tidy(each), "doc long, part int, tokens binary"), "sequences", compression="zstd")


def numbered(rows: DataFrame, key: str) -> tuple[DataFrame, int]:
    """Rows of a written table with their place, and how many there are."""
    located = rows.select("*", F.col("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("at"))
    files = located.groupBy("file").agg(F.count("*").alias("n"))  # a row per file
    begins = files.withColumn("begin", F.sum("n").over(Window.orderBy("file").rowsBetween(Window.unboundedPreceding, -1)))
    total, count = files.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count("*")).first()
    begins = begins.select("file", F.coalesce("begin", F.lit(0)).alias("begin"))
    if count <= BROADCAST_FILES:  # a few megabytes; with more files the rows are shuffled
        begins = F.broadcast(begins)
    counted = located.join(begins, "file").select(
        *rows.columns, (F.col("begin") + F.col("at")).alias("number"))

    @F.arrow_udf("long")
    def place(numbers: pa.Array) -> pa.Array:
        return pa.array(places(numbers.to_numpy(), total, key))

    # Only numbers go through Python; not deterministic, or a filter by place would compute them twice.
    return counted.select(*rows.columns, place.asNondeterministic()("number").alias("place")), total


@contextmanager
def shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """Actions inside remove the files of their shuffles when they end, not at some garbage collection later."""
    before = spark.conf.get(REMOVES_SHUFFLES, "false")
    spark.conf.set(REMOVES_SHUFFLES, "true")
    try:
        yield
    finally:
        spark.conf.set(REMOVES_SHUFFLES, before)


def write_shards(rows: DataFrame, folder: str, sequence: int = SEQUENCE, shard_records: int = SHARD_RECORDS, passes: int = 1) -> DataFrame:
    """One file of fixed-length records per shard; (shard, path, records) of all files.

    Every pass reads all rows and shuffles those of every ``passes``-th shard. A file gets its name only when it
    is complete, so a task that runs again replaces it by the same bytes.
    """
    kind = record_type(sequence)

    def shard(table: pa.Table) -> pa.Table:
        number = table.column("shard")[0].as_py()
        order = np.argsort(table.column("place").to_numpy())
        out = np.zeros(len(order), kind)
        out["tokens"] = FILL
        out["doc"] = table.column("doc").fill_null(int(NO_ID)).to_numpy()[order]
        out["part"] = table.column("part").to_numpy()[order]
        tokens = table.column("tokens").to_pylist()
        for k, at in enumerate(order.tolist()):
            ids = np.frombuffer(tokens[at], "<u2")
            out["n"][k] = len(ids)
            out["tokens"][k, :len(ids)] = ids
        system, path = fs.FileSystem.from_uri(folder)
        system.create_dir(path, recursive=True)
        name, draft = f"{path}/shard-{number:08d}.bin", f"{path}/.{uuid.uuid4().hex}"
        with system.open_output_stream(draft) as sink:
            sink.write(out.tobytes())
        system.move(draft, name)
        return pa.table({"shard": pa.array([number], pa.int64()), "path": [f"{folder}/shard-{number:08d}.bin"], "records": pa.array([len(order)], pa.int64())})

    spark, manifest = rows.sparkSession, scratch_path(rows.sparkSession, "manifest")
    dealt = rows.withColumn("shard", F.floor(F.col("place") / shard_records))
    with shuffles_removed(spark):
        for k in range(passes):
            dealt.where(F.col("shard") % passes == k).groupBy("shard").applyInArrow(
                tidy_group(shard), "shard long, path string, records long").write.mode("append").parquet(manifest)
    return spark.read.parquet(manifest)


def read_shards(manifest: DataFrame, first: int = 0, sequence: int = SEQUENCE, shard_records: int = SHARD_RECORDS) -> DataFrame:
    """(place, doc, part, tokens) of all records from place ``first`` on; each task reads its files in order."""
    kind = record_type(sequence)

    def each(batches):
        for batch in batches:
            for row in batch.to_pylist():
                skip = max(0, first - row["shard"] * shard_records)
                system, path = fs.FileSystem.from_uri(row["path"])
                with system.open_input_file(path) as source:
                    data = np.frombuffer(source.read_at((row["records"] - skip) * kind.itemsize, skip * kind.itemsize), kind)
                doc = pa.array(data["doc"], mask=data["doc"] == NO_ID)
                tokens = [t[:n].tobytes() for t, n in zip(data["tokens"], data["n"].tolist())]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(row["shard"] * shard_records + skip + np.arange(len(data))), doc, pa.array(data["part"]), pa.array(tokens, pa.binary())],
                    names=["place", "doc", "part", "tokens"])

    wanted = manifest.where((F.col("shard") + 1) * shard_records > first).repartitionByRange("shard")
    return wanted.mapInArrow(tidy(each), "place long, doc long, part int, tokens binary")


def materialise(docs: DataFrame, ranks_path: str, pattern: str, key: str, sequence: int = SEQUENCE, shard_records: int = SHARD_RECORDS) -> DataFrame:
    """Writes the shards of all documents and returns their manifest."""
    rows, total = numbered(sequences(docs, ranks_path, pattern, sequence=sequence), key)
    passes = min(PASSES, parts_for(total, shard_records))
    return write_shards(rows, scratch_path(docs.sparkSession, "shards"), sequence, shard_records, passes)


def in_training_order(docs: DataFrame, ranks_path: str, pattern: str, key: str = "order-1") -> DataFrame:
    """Every sequence with its place, as read back from the shards."""
    found = read_shards(materialise(docs, ranks_path, pattern, key))
    return found.select(
        "place", F.col("doc").alias("doc_id"), "part", (F.octet_length("tokens") / 2).cast("int").alias("n_tokens"),
        F.sha2("tokens", 256).alias("ids_sha256"))
