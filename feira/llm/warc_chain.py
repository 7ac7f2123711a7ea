"""WARC archives: writing with revisit records, and reading with verified record boundaries.

Writing goes through Spark's own text writer: a record is one row, the blank lines behind it are the line
separator, so the files are committed like any other output and lie in any store that Spark knows.

Reading takes byte ranges of the files. The magic that starts a record may also stand inside a payload, so
each task only proposes candidates: for every magic with a header, the offset of its successor. Inside a
range the successors are followed to the first offset beyond it. Pointer jumping from offset 0 of each
file, doubling the distance in each round, then finds the one reachable record in every range. Only from
there are records read, one behind the other; all other candidates were payload.

Two payloads are equal if their SHA-1 and length are; equal ones of at least ``REVISIT_BYTES`` are stored
once, in the record of the largest page id, and the others refer to it. Null payloads are empty. Rows
without id are records without id and refer to the largest id, if there is one. Rows that repeat an id are
records of their own; those with the largest id all hold the payload. Urls, and so headers, may be of any
length. A chain that breaks (a damaged file) ends the records of its file there, or raises an error if the
file has to be whole, as those that were just written. An empty table makes no records.
"""

from __future__ import annotations

import re
from datetime import datetime, timezone

import pyarrow as pa
import zstandard
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from feira.llm.components import written
from feira.llm.shared import bounded_batches, packed_bytes, tidy, utf8
from feira.session import scratch_path

REVISIT_BYTES = 1000
RANGE_BYTES = 8_000_000
AHEAD_BYTES = 16_384  # read beyond a range at first; doubled as long as a header goes on
RECORDS_PER_FILE = 20_000
MAGIC = b"WARC/1.1\r\n"
_END = b"\r\n\r\n"
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_FIELDS = re.compile(rb"^([^:\r\n]+):[ \t]*([^\r\n]*)", re.M)


def plan_records(pages: DataFrame, key: str = "page_id", payload: str = "html", url: str | None = "url",
                 least: int = REVISIT_BYTES) -> DataFrame:
    """(key, url, payload, digest, size, refers_to): which rows hold their payload and which refer to another."""
    body = utf8(payload)
    rows = pages.select(
        F.col(key).alias("key"), F.coalesce(F.col(url) if url else F.lit(None).cast("string"), F.lit("")).alias("url"),
        body.alias("payload"))
    named = rows.select("key", F.sha1("payload").alias("digest"), F.octet_length("payload").cast("long").alias("size"))
    holders = named.where(F.col("size") >= least).groupBy("digest", "size").agg(
        F.max("key").alias("holder"), F.count("*").alias("copies")).where("copies > 1 AND holder IS NOT NULL").drop("copies")
    revisits = named.join(holders, ["digest", "size"]).where(~F.col("key").eqNullSafe(F.col("holder"))).select(
        F.col("key").alias("of"), F.col("digest").alias("same"), "holder").distinct()
    bounded_batches(pages.sparkSession)
    named_rows = rows.select("key", "url", F.sha1("payload").alias("digest"), F.octet_length("payload").cast("long").alias("size"), "payload")
    full = named_rows.mapInArrow(tidy(packed_bytes), named_rows.drop("payload").schema.add("packed", "binary"))
    told = full.join(revisits, full["key"].eqNullSafe(revisits["of"]) & (full["digest"] == revisits["same"]), "left").select(
        "key", "url", "digest", "size", F.col("holder").alias("refers_to"), "packed")
    return told.mapInArrow(tidy(_unpacked), told.drop("packed").schema.add("payload", "binary"))


def _unpacked(batches):
    unpacker = zstandard.ZstdDecompressor()
    for batch in batches:
        payload = pa.array([unpacker.decompress(x) for x in batch.column(batch.num_columns - 1).to_pylist()], pa.binary())
        columns = [batch.column(i) for i in range(batch.num_columns - 1)]
        yield pa.RecordBatch.from_arrays([*columns, payload], names=[*batch.schema.names[:-1], "payload"])


def write_archives(records: DataFrame, path: str, at: datetime | None = None) -> None:
    """One WARC record per row of ``plan_records``, in files of bounded size, dated ``at``, by default now."""
    date = (at or datetime.now(timezone.utc)).astimezone(timezone.utc).strftime("%Y-%m-%dT%H:%M:%SZ")
    revisit = F.col("refers_to").isNotNull()

    def urn(column):
        return F.concat(F.lit("<urn:page:"), F.coalesce(column.cast("string"), F.lit("none")), F.lit(">"))

    header = F.concat(
        F.lit(MAGIC.decode()), F.lit("WARC-Type: "), F.when(revisit, "revisit").otherwise("response"),
        F.lit("\r\nWARC-Record-ID: "), urn(F.col("key")),
        F.lit(f"\r\nWARC-Date: {date}\r\nWARC-Target-URI: "), F.regexp_replace("url", r"[\r\n]", ""),
        F.lit("\r\nWARC-Payload-Digest: sha1:"), F.col("digest"),
        F.lit("\r\nWARC-Payload-Length: "), F.col("size").cast("string"),
        F.when(revisit, F.concat(F.lit(f"\r\nWARC-Profile: {_PROFILE}\r\nWARC-Refers-To: "), urn(F.col("refers_to")))).otherwise(""),
        F.lit("\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "),
        F.when(revisit, F.lit("0")).otherwise(F.col("size").cast("string")), F.lit("\r\n\r\n"))
    record = F.concat(header, F.when(revisit, "").otherwise(F.col("payload").cast("string")))
    records.select(record.alias("value")).write.option("lineSep", _END.decode()).option(
        "maxRecordsPerFile", RECORDS_PER_FILE).text(path)


def parse_header(head: bytes) -> dict[str, str]:
    return {k.decode().strip().lower(): v.decode("utf-8", "replace").strip() for k, v in _FIELDS.findall(head)}


def _size(header: dict[str, str]) -> int | None:
    """The length of the payload that a header tells, if it is a number that a file can have."""
    size = header.get("content-length", "")
    return int(size) if re.fullmatch("[0-9]{1,18}", size) else None


def _record_at(data: bytes, at: int) -> tuple[dict[str, str], int, int] | None:
    """Header, offset of the payload and offset of the next record, or None if no record starts here."""
    if not data.startswith(MAGIC, at):
        return None
    end = data.find(_END, at)
    if end < 0:
        return None
    header = parse_header(data[at + len(MAGIC):end])
    size = _size(header)
    if size is None:
        return None
    return header, end + len(_END), end + len(_END) + size + len(_END)


def _goes_on(data: bytes, at: int) -> bool:
    """Whether a header may start here that ends behind ``data``."""
    return MAGIC.startswith(data[at:at + len(MAGIC)]) and data.find(_END, at) < 0


def candidates_of_range(data: bytes, start: int, size: int) -> list[tuple[int, int]]:
    """(offset, exit) of each candidate that starts in the first ``size`` bytes; exit is the first offset
    beyond them that its chain of successors leads to (-1: the chain breaks inside)."""
    found, at, end, told, length = {}, data.find(MAGIC), -1, -1, None
    while 0 <= at < size:
        if end < at:  # all candidates before the same blank line share the last length told there
            end, told, length = data.find(_END, at), -1, None
            if end < 0:
                break
            for field in _FIELDS.finditer(data, at + len(MAGIC), end):
                named = parse_header(field[0])
                if "content-length" in named:
                    told, length = field.start(), _size(named)
        if told >= at + len(MAGIC) and length is not None:
            found[at] = end + len(_END) + length + len(_END)
        at = data.find(MAGIC, at + 1)
    exits: dict[int, int] = {}
    for at in sorted(found, reverse=True):
        after = found[at]
        exits[at] = start + after if after >= size else exits.get(after, -1)
    return [(start + at, out) for at, out in exits.items()]


def _read(where: str, start: int, size: int) -> bytes:
    system, path = fs.FileSystem.from_uri(where)
    with system.open_input_file(path) as source:
        return source.read_at(size, start)


def _read_range(where: str, start: int, size: int, length: int) -> bytes:
    """A range of a file of ``length`` bytes, and what lies behind it to the end of the last header in it."""
    data, ahead = _read(where, start, min(size + AHEAD_BYTES, length - start)), AHEAD_BYTES
    last = data.rfind(MAGIC, 0, size + len(MAGIC) - 1)
    seen = last
    while last >= 0 and data.find(_END, seen) < 0 and start + len(data) < length:
        seen, ahead = max(last, len(data) - len(_END)), 2 * ahead
        data += _read(where, start + len(data), min(ahead, length - start - len(data)))
    return data


def ranges(spark: SparkSession, path: str, range_bytes: int = RANGE_BYTES) -> DataFrame:
    """(path, length, part, start) of all byte ranges of the files."""
    files = spark.read.format("binaryFile").load(path).select("path", "length").where("length > 0")
    cut = files.withColumn("part", F.explode(F.sequence(F.lit(0), F.floor((F.col("length") - 1) / range_bytes).cast("int"))))
    return cut.withColumn("start", F.col("part").cast("long") * range_bytes).repartition("path", "part")


def entries(parts: DataFrame, range_bytes: int = RANGE_BYTES) -> DataFrame:
    """(path, at): the first reachable record of each range that has one."""
    def propose(batches):
        for batch in batches:
            for row in batch.to_pylist():
                size = min(range_bytes, row["length"] - row["start"])
                found = candidates_of_range(_read_range(row["path"], row["start"], size, row["length"]), row["start"], size)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([row["path"]] * len(found), pa.string()), pa.array([a for a, _ in found], pa.int64()),
                     pa.array([b for _, b in found], pa.int64())], names=["path", "at", "out"])

    jumps = written(parts.mapInArrow(tidy(propose), "path string, at long, out long"), "candidates").where("out >= 0")
    reached = parts.where("part = 0").select("path", F.lit(0).cast("long").alias("at"))
    most = parts.agg(F.max("part")).first()[0] or 0
    for _ in range(int(most).bit_length()):
        reached = written(reached.union(
            reached.join(jumps, ["path", "at"]).select("path", F.col("out").alias("at"))).distinct(), "reached")
        further = jumps.select("path", F.col("at").alias("out"), F.col("out").alias("beyond"))
        jumps = written(jumps.join(further, ["path", "out"]).select("path", "at", F.col("beyond").alias("out")), "jumps")
    return reached


def read_archives(spark: SparkSession, path: str, range_bytes: int = RANGE_BYTES, whole_files: bool = False) -> DataFrame:
    """(header fields as map, payload) of every record that is reachable from the start of its file.

    With ``whole_files`` a file whose chain breaks before its end is an error.
    """
    parts = written(ranges(spark, path, range_bytes), "ranges")
    starts = entries(parts, range_bytes).withColumn("part", F.floor(F.col("at") / range_bytes).cast("int"))
    todo = parts.join(starts, ["path", "part"]).select("path", "length", "start", "at").repartition("path", "start")

    def records(batches):
        for batch in batches:
            for row in batch.to_pylist():
                where, at, end = row["path"], row["at"], min(row["start"] + range_bytes, row["length"])
                data, base = _read(where, at, end - at), at
                heads, bodies, held = [], [], 0
                while at < end:
                    ahead = AHEAD_BYTES
                    while _goes_on(data, at - base) and base + len(data) < row["length"]:  # the header goes on beyond the range
                        data, base, ahead = _read(where, at, min(ahead, row["length"] - at)), at, 2 * ahead
                    record = _record_at(data, at - base)
                    if whole_files and (record is None or base + record[2] > row["length"]):
                        raise ValueError(f"{where}: no whole record at byte {at} of {row['length']}")
                    if record is None:
                        break
                    header, body, after = record
                    size = after - len(_END) - body
                    whole = data[body:body + size]
                    if len(whole) < size:
                        whole = _read(where, base + body, size)
                    heads.append(list(header.items()))
                    bodies.append(whole)
                    held += body + size - (at - base)
                    at = base + after
                    if held > 4_000_000:
                        yield _records(heads, bodies)
                        heads, bodies, held = [], [], 0
                if heads:
                    yield _records(heads, bodies)

    return todo.mapInArrow(tidy(records), "header map<string,string>, payload binary")


def _records(heads, bodies):
    return pa.RecordBatch.from_arrays(
        [pa.array(heads, pa.map_(pa.string(), pa.string())), pa.array(bodies, pa.binary())], names=["header", "payload"])


def archive_and_read(pages: DataFrame) -> DataFrame:
    """Writes every page as a record, reads the archives back and tells what each record says."""
    spark = pages.sparkSession
    path = scratch_path(spark, "warc")
    write_archives(plan_records(pages), path)
    back = read_archives(spark, path, whole_files=True)
    field = lambda name: F.col("header")[name]
    page = lambda name: F.regexp_extract(field(name), r"^<urn:page:(-?\d+)>$", 1)
    kind = pages.schema["page_id"].dataType
    held = field("warc-type") == "response"
    return back.select(
        F.nullif(page("warc-record-id"), F.lit("")).cast(kind).alias("page_id"),
        F.when(held, F.octet_length("payload").cast("long")).otherwise(field("warc-payload-length").cast("long")).alias("payload_bytes"),
        F.when(held, F.sha1("payload")).otherwise(F.substring(field("warc-payload-digest"), 6, 40)).alias("payload_digest"),
        field("warc-type").alias("record_type"),
        F.when(~held, page("warc-refers-to")).cast(kind).alias("refers_to"))
