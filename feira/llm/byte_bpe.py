"""Byte-level BPE encoding and decoding by a local rank file.

A text is first cut into parts of bounded length at places where the pre-splitting pattern always
starts a new match: the first white space after something else. Both sides then give the same matches
as the whole text, so a very long text costs no more memory or time per byte than a short one. Token
ids travel as little-endian unsigned 32-bit integers in one binary value.

Null and empty texts have no tokens. Repeated rows are encoded each for itself. Strings that look like
special tokens are ordinary text.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import regex
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feira.llm.shared import bounded_batches, tidy, utf8

PART_CHARS = 65_536
_SAFE = regex.compile(r"(?<=\S)\s")


@cache
def encoding(ranks_path: str, pattern: str) -> tiktoken.Encoding:
    """The encoding of a rank file, one per Python worker."""
    with open(ranks_path, "rb") as lines:
        ranks = {base64.b64decode(word): int(rank) for word, rank in (line.split() for line in lines if line.strip())}
    return tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})


def safe_parts(text: str, limit: int = PART_CHARS) -> Iterator[str]:
    """Parts of about ``limit`` characters whose matches together are the matches of the text."""
    at = 0
    while len(text) - at > limit:
        cut = _SAFE.search(text, at + limit)
        if not cut:
            break
        yield text[at:cut.start()]
        at = cut.start()
    yield text[at:]


def encode_text(text: str, by: tiktoken.Encoding, limit: int = PART_CHARS) -> np.ndarray:
    if len(text) <= limit:
        return np.array(by.encode_ordinary(text), dtype="<u4")
    return np.concatenate([np.array(by.encode_ordinary(part), dtype="<u4") for part in safe_parts(text, limit)])


def _with_column(frame: DataFrame, source: str, made: str, convert) -> DataFrame:
    """``frame`` with the binary column ``made`` = convert(bytes of ``source``)."""
    bounded_batches(frame.sparkSession)
    kept = [c for c in frame.columns if c != made]
    schema = frame.select(*kept).schema.add(made, "binary")

    def each(batches):
        for batch in batches:
            made_of = pa.array((convert(x) for x in batch.column(batch.num_columns - 1).to_pylist()), pa.binary())
            yield pa.RecordBatch.from_arrays([*(batch.column(i) for i in range(len(kept))), made_of], names=schema.names)

    return frame.select(*(F.col(f"`{c}`") for c in kept), utf8(source).alias("__bytes")).mapInArrow(tidy(each), schema)


def encode(frame: DataFrame, ranks_path: str, pattern: str, text: str = "text", ids: str = "ids") -> DataFrame:
    """Adds the token ids of every whole text as binary column ``ids``."""
    def convert(data: bytes) -> bytes:
        return encode_text(data.decode("utf-8", "replace"), encoding(ranks_path, pattern)).tobytes()

    return _with_column(frame, text, ids, convert)


def decode(frame: DataFrame, ranks_path: str, pattern: str, ids: str = "ids", decoded: str = "decoded") -> DataFrame:
    """Adds the raw bytes that the token ids stand for as binary column ``decoded``."""
    def convert(data: bytes) -> bytes:
        return encoding(ranks_path, pattern).decode_bytes(np.frombuffer(data, "<u4").tolist())

    return _with_column(frame, ids, decoded, convert)


def digests(frame: DataFrame, ranks_path: str, pattern: str) -> DataFrame:
    """Per document: number of tokens, digest of the ids and of the bytes they decode to."""
    coded = encode(frame.select("doc_id", "text"), ranks_path, pattern).select("doc_id", "ids")
    return decode(coded, ranks_path, pattern).select(
        "doc_id", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"), F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"))
