"""Hard negatives by exact scores: matrix products in residues, Chinese remainders, windows of scores.

Vectors become integers, floor(256 x), and a score is their inner product. Anchors are the rows whose id is
divisible by ``every``. Blocks of anchors meet chunks of all rows, dealt evenly whatever the ids, labels or
repeats are, in two rounds:

1. an anchor's best rows of its own label, its positives; only rows of equal labels are multiplied;
2. for each positive the best rows of other labels whose score lies in the window from ``low`` to ``high``
   per cent of the positive's score. The window is cut in each chunk, and the chunks' best are merged by rank.

Scores come from float32 products only. For each of several primes below 256 both matrices are reduced to
centred residues; over ``SLICE`` components a sum of products stays below 2^24, where float32 is exact. Garner's
mixed-radix digits, centred too, then give the signed score; as many primes are taken as the largest possible
score of the block needs.

Rows with a null id, a null label, a null or empty vector, or a null or non-finite component take no part.
Vectors meet only those with as many components. Rows with the anchor's own id are not candidates. Repeated
rows are rows of their own as candidates; anchors that are equal in id, label and vector are asked once, others
of the same id each for itself. Ties go to the smaller id. With fewer candidates than wanted all are returned,
and anchors without a positive or without a negative have no rows; so has an empty table. Components beyond
2^53 / 256 or scores beyond 64 bits raise an error. Other columns are ignored, whatever their names.
"""

from __future__ import annotations

from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from feira.llm.components import written
from feira.llm.shared import bounded_batches, parts_for, tidy_group

POSITIVES = 5
NEGATIVES = 5
ANCHORS_AT_ONCE = 16_384
VECTORS_AT_ONCE = 16_384
SCORES_AT_ONCE = 1 << 21
SLICE = 128
NONE = np.iinfo(np.int64).min  # the score of rows that are no candidates


@cache
def primes() -> tuple[int, ...]:
    """Primes below 256 from the largest on; their products of ``SLICE`` centred residues fit into float32."""
    return tuple(p for p in range(255, 2, -1) if all(p % q for q in range(2, int(p**0.5) + 1)))


def _centred(x: np.ndarray, p: int) -> np.ndarray:
    """Residues of float32 integers between -(p - 1) / 2 and (p - 1) / 2."""
    return x - np.float32(p) * np.rint(x * np.float32(1 / p))


def _residues(v: np.ndarray, p: int) -> np.ndarray:
    r = np.mod(v, p)
    return np.where(r > p // 2, r - p, r).astype(np.float32)


def _needed(bound: int) -> list[int]:
    """Primes whose product exceeds the signed range of scores up to ``bound``."""
    if bound >= 2**63:
        raise ValueError("scores beyond 64 bits")
    chosen, product = [], 1
    for p in primes():
        if product > 2 * bound + 1:
            break
        chosen.append(p)
        product *= p
    return chosen


def _bound(a: np.ndarray, b: np.ndarray) -> int:
    """No inner product of a row of each exceeds this: the product of the largest lengths, rounded up."""
    largest = [float(np.sqrt((x.astype(np.float64) ** 2).sum(axis=1)).max(initial=0.0)) for x in (a, b)]
    return int(largest[0] * largest[1] * (1 + 1e-9)) + 1


class Products:
    """Exact signed inner products of rows of two integer matrices."""

    def __init__(self, a: np.ndarray, b: np.ndarray):
        self.primes = _needed(_bound(a, b))
        self.a = [_residues(a, p) for p in self.primes]
        self.b = [np.ascontiguousarray(_residues(b, p).T) for p in self.primes]

    def of(self, start: int, end: int) -> np.ndarray:
        """Scores of rows start to end of the first matrix with all rows of the second."""
        digits: list[np.ndarray] = []
        for p, a, b in zip(self.primes, self.a, self.b):
            x = np.zeros((end - start, b.shape[1]), np.float32)
            for at in range(0, a.shape[1], SLICE):
                x += _centred(a[start:end, at:at + SLICE] @ b[at:at + SLICE], p)
            x = _centred(x, p)
            for q, d in zip(self.primes, digits):
                inverse = pow(q, -1, p)
                x = _centred((x - d) * np.float32(inverse if inverse <= p // 2 else inverse - p), p)
            digits.append(x)
        # Wrapped sums are right: the score itself fits into 64 bits.
        score, place = np.zeros((end - start, self.b[0].shape[1]), np.int64), 1
        for p, d in zip(self.primes, digits):
            weight = place % 2**64
            score += d.astype(np.int64) * np.int64(weight - 2**64 if weight >= 2**63 else weight)
            place *= p
        return score


def _matrix(column: pa.ChunkedArray) -> np.ndarray:
    """floor(256 x) of a list column with equally long values."""
    column = column.combine_chunks()
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    whole = np.floor(256.0 * flat)
    if len(whole) and np.abs(whole).max() >= 2.0**53:
        raise ValueError("a component is too large for an exact integer")
    return whole.astype(np.int64).reshape(len(column), -1) if len(column) else np.zeros((0, 0), np.int64)


def _best(score: np.ndarray, at: np.ndarray, top: int) -> np.ndarray:
    """Of the rows ``at``, which are sorted by id, the first ``top`` by score."""
    s = score[at]
    if len(s) > top:
        keep = np.flatnonzero(s >= np.partition(s, len(s) - top)[len(s) - top])
        at, s = at[keep], s[keep]
    return at[np.argsort(-s, kind="stable")[:top]]


def _sides(table: pa.Table) -> tuple[pa.Table, pa.Table]:
    """The anchors of a group, and its rows sorted by id."""
    asks = table.column("asks").combine_chunks()
    rows = table.filter(pc.invert(asks))
    return table.filter(asks), rows.sort_by("id")


def _blocks(anchors: np.ndarray, rows: np.ndarray):
    """(first anchor, scores) in blocks of bounded size."""
    if len(anchors) and len(rows):
        products = Products(anchors, rows)
        step = max(1, SCORES_AT_ONCE // len(rows))
        for start in range(0, len(anchors), step):
            yield start, products.of(start, min(start + step, len(anchors)))


def _column(table: pa.Table, name: str) -> np.ndarray:
    return table.column(name).to_numpy()


def _same_label(top: int):
    """The best rows of an anchor's own label in one chunk."""
    def solve(table: pa.Table) -> pa.Table:
        asked, rows = _sides(table)
        x, y = _matrix(asked.column("raw")), _matrix(rows.column("raw"))
        mine, ask, theirs, ids = _column(asked, "label"), _column(asked, "id"), _column(rows, "label"), _column(rows, "id")
        keys, out = _column(asked, "ask"), ([], [], [], [])
        for label in np.intersect1d(mine, theirs):
            a, d = np.flatnonzero(mine == label), np.flatnonzero(theirs == label)
            for start, block in _blocks(x[a], y[d]):
                for k, score in enumerate(block):
                    anchor = a[start + k]
                    best = _best(score, np.flatnonzero(ids[d] != ask[anchor]), top)
                    out[0].extend([ask[anchor]] * len(best))
                    out[1].extend([keys[anchor]] * len(best))
                    out[2].extend(ids[d][best])
                    out[3].extend(score[best])
        return pa.table([pa.array(np.array(c, np.int64)) for c in out], names=["id", "ask", "positive_id", "positive_score"])

    return solve


def _in_windows(top: int, low: int, high: int):
    """The best rows of other labels in one chunk, within the window of each positive."""
    def solve(table: pa.Table) -> pa.Table:
        asked, rows = _sides(table)
        x, y = _matrix(asked.column("raw")), _matrix(rows.column("raw"))
        mine, ask, theirs, ids = _column(asked, "label"), _column(asked, "id"), _column(rows, "label"), _column(rows, "id")
        keys, windows, out = _column(asked, "ask"), asked.column("positives").to_pylist(), ([], [], [], [], [], [], [])
        for start, block in _blocks(x, y):
            for k, score in enumerate(block):
                anchor = start + k
                score[(theirs == mine[anchor]) | (ids == ask[anchor])] = NONE
                for w in windows[anchor]:
                    # 100 s >= low * p and 100 s <= high * p, in exact Python integers
                    floor, ceiling = -(-low * w["score"] // 100), high * w["score"] // 100
                    found = np.flatnonzero((score >= max(floor, NONE + 1)) & (score <= ceiling)) if floor <= ceiling else []
                    if len(found):
                        best = _best(score, found, top)
                        for column, value in zip(out, (ask[anchor], keys[anchor], w["place"], w["id"], w["score"])):
                            column.extend([value] * len(best))
                        out[5].extend(ids[best])
                        out[6].extend(score[best])
        return pa.table([pa.array(np.array(c, np.int64)) for c in out], names=[
            "anchor_id", "ask", "place", "positive_id", "positive_score", "negative_id", "negative_score"])

    return solve


def _usable(rows: DataFrame, key: str, vector: str, label: str) -> DataFrame:
    """(dim, id, label, raw) of the rows that take part."""
    raw = F.col(vector)
    kind = rows.schema[vector].dataType.elementType.simpleString()
    raw = raw if kind in ("float", "double") else raw.cast("array<double>")
    chosen = rows.select(F.size(raw).alias("dim"), F.col(key).cast("long").alias("id"), F.col(label).cast("long").alias("label"), raw.alias("raw"))
    return chosen.where("id IS NOT NULL AND label IS NOT NULL AND raw IS NOT NULL AND dim > 0 AND "
                        "forall(raw, x -> x IS NOT NULL AND NOT isnan(x) AND abs(double(x)) < double('infinity'))")


def _dealt(count: int) -> Column:
    """A number below ``count``, the same for as many rows each: hot ids, labels or equal rows are spread too."""
    return F.pmod(F.monotonically_increasing_id(), F.lit(count)).cast("int")


def _copies(count: int) -> Column:
    return F.explode(F.sequence(F.lit(0), F.lit(count - 1)))


def mine(rows: DataFrame, every: int, key: str = "vec_id", vector: str = "embedding", label: str = "label",
         positives: int = POSITIVES, negatives: int = NEGATIVES, low: int = 80, high: int = 100) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score."""
    spark = rows.sparkSession
    bounded_batches(spark)
    # Written once, so that dealing rows by their place is repeatable.
    data = written(_usable(rows, key, vector, label), "vectors")
    anchors = data.where(F.pmod("id", F.lit(every)) == 0).dropDuplicates().withColumn("ask", F.xxhash64("id", "label", "raw"))
    anchors = written(anchors, "anchors")
    parts = parts_for(anchors.count(), ANCHORS_AT_ONCE)
    chunks = max(parts_for(data.count(), VECTORS_AT_ONCE), spark.sparkContext.defaultParallelism)
    windows = "array<struct<place int, id long, score long>>"

    def meet(asked: DataFrame, solve, schema: str) -> DataFrame:
        columns = ["dim", "part", "chunk", "asks", "id", "label", "raw", "ask", "positives"]
        left = asked.withColumn("part", _dealt(parts)).withColumn("chunk", _copies(chunks)).withColumn("asks", F.lit(True))
        right = data.withColumn("chunk", _dealt(chunks)).withColumn("part", _copies(parts)).withColumns(
            {"asks": F.lit(False), "ask": F.lit(0).cast("long"), "positives": F.lit(None).cast(windows)})
        return left.select(columns).union(right.select(columns)).groupBy("dim", "part", "chunk").applyInArrow(tidy_group(solve), schema)

    near = meet(anchors.withColumn("positives", F.lit(None).cast(windows)), _same_label(positives),
                "id long, ask long, positive_id long, positive_score long")
    order = Window.partitionBy("id", "ask").orderBy(F.desc("positive_score"), "positive_id")
    first = near.withColumn("place", F.row_number().over(order)).where(F.col("place") <= positives)
    held = first.groupBy("id", "ask").agg(F.collect_list(F.struct(
        "place", F.col("positive_id").alias("id"), F.col("positive_score").alias("score"))).alias("positives"))
    asked = written(anchors.join(held, ["id", "ask"]), "asked")
    found = meet(asked, _in_windows(negatives, low, high), "anchor_id long, ask long, place long, positive_id long,"
                 "positive_score long, negative_id long, negative_score long")
    order = Window.partitionBy("anchor_id", "ask", "place").orderBy(F.desc("negative_score"), "negative_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= negatives).select(
        "anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
