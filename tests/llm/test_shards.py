"""Shards by histogram sort beside cuts found by sorting everything."""

import random
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from feira.llm import histogram_shards as H
from feira.session import scratch_path
from tests.conftest import SMALL
from tests.llm import cases


def checked(rows, docs, shards=24):
    """Every row once, sizes and checksums right, slots gapless; returns the bytes of each shard."""
    want = Counter((d, len((t or "").encode()) + 8, zlib.crc32((t or "").encode())) for d, t in docs)
    assert Counter((r.doc_id, r.size, r.text_crc32) for r in rows) == want
    assert all(r.law == "bytes" and r.grown_shard is None and 0 <= r.shard < shards for r in rows)
    for k in range(shards):
        slots = sorted(r.slot for r in rows if r.shard == k)
        assert slots == list(range(len(slots)))
    total = Counter()
    for r in rows:
        total[r.shard] += r.size
    return [total[k] for k in range(shards)]


def test_query_deals_all_documents(spark):
    from feira.llm.queries import queries

    docs = [tuple(r) for r in spark.read.parquet(SMALL + "/documents.parquet").select("doc_id", "text").collect()]
    sizes = checked(queries()["op12_histogram_shards"](spark, SMALL).collect(), docs)
    largest = max(len((t or "").encode()) for _, t in docs) + 8
    assert max(abs(s - sum(sizes) / 24) for s in sizes) <= largest * 1.01 + sum(sizes) / 24 * 2 * H.TOLERANCE


HOT = "the same row in many copies, with a few words more"


def many(n, hot):
    rng = random.Random(n)
    rows = [(k, cases.sentence(rng, rng.randint(0, 12)), "x", 1) for k in range(n)]
    rows += [(hot, HOT, "x", 1)] * (n // 2) + [(k, "one text", "x", 1) for k in range(n // 4)]
    return [*rows, (None, None, None, None), (None, "", "x", 2), (7, "é" * 3000, "x", 2)]


@pytest.mark.parametrize("pieces", [1, 3])
def test_cuts_are_exact_and_hot_rows_are_split(spark, pieces, monkeypatch):
    """A third of the rows are one repeated row, and many share a text: shards still have near equal bytes."""
    rows = many(3000, 5)
    total = sum(len((t or "").encode()) + 8 for _, t, _, _ in rows)
    monkeypatch.setattr(H, "PIECE_BYTES", total // (8 * pieces) + 1)
    docs = spark.createDataFrame(rows, "doc_id long, text string, shard string, slot int").repartition(5)
    docs = H.written(docs.withColumn("tags", F.array(F.lit(1))), "docs")
    path = scratch_path(spark, "shards")
    schema = H.write_shards(docs, path, 8)
    found = H.read_shards(spark, path, schema).withColumns({"law": F.lit("bytes"), "grown_shard": F.lit(None), "text_crc32": F.crc32(H.utf8("text"))})
    assert set(found.columns) >= {"doc_id", "text", "tags", "size", "shard", "slot"}
    sizes = checked(found.collect(), [r[:2] for r in rows], 8)
    assert sum(sizes) == total and max(abs(s - total / 8) for s in sizes) < total / 8 * 0.02 + 200
    same = found.where(F.col("text") == HOT).groupBy("shard").count().collect()
    assert len(same) > 2


def test_cuts_equal_a_full_sort(spark, monkeypatch):
    monkeypatch.setattr(H, "PROBES", 4)
    rng = random.Random(3)
    keys = sorted({(rng.choice([-5, 0, 7, rng.randrange(-2**63, 2**63)]), rng.randrange(-2**63, 2**63)) for _ in range(400)})
    rows = [(a, b, rng.randint(8, 60)) for a, b in keys]
    keyed = spark.createDataFrame(rows, "key_a long, key_b long, size long").repartition(3)
    total = sum(r[2] for r in rows)
    wanted = [(total * k / 16, 0.0) for k in range(1, 16)]
    got, whole = H.cuts(keyed, wanted), [((a + 2**63) << 64) + b + 2**63 for a, b, _ in rows]
    for (below, _), cut in zip(wanted, got):
        left = sum(r[2] for r, k in zip(rows, whole) if k << 64 < cut)
        at = next(k for k in range(len(rows)) if sum(r[2] for r in rows[:k + 1]) >= below)
        assert abs(left - below) == min(abs(sum(r[2] for r in rows[:k]) - below) for k in (at, at + 1))
    assert H.cuts(keyed.limit(0), wanted[:2]) == [H.END << 64] * 2


@pytest.mark.parametrize("rows", [[], [(1, None)], [(1, "a"), (1, "a")]])
def test_few_rows(spark, rows):
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    checked(H.shard_documents(docs).collect(), rows)
