"""Exact top-k search by inner product: a kNN join over Voronoi groups.

Vectors become integers, floor(256 x). Pivots are a bounded sample of them; each vector belongs to the cell
of its nearest pivot, and so do the queries. Summaries of the cells (number of vectors, less the most that
one query id has there, and largest distance to the pivot) bound the score of any query of a group with any vector of a cell. From the lower bounds follows
a score that the group's queries reach with k vectors at least; only cells whose upper bound is not below
it are needed. Neighbouring query cells are joined to groups as large as a task can take, and each group
gets the cells that any of its own needs. Hot cells and groups are dealt to tasks of bounded size, each of which
solves its part by one matrix product; the parts' best are merged by rank.

Vectors that are null or hold null or non-finite components take no part. Vectors meet only those of the
same number of components. Rows with the query's own id are not candidates. Ties go to the smaller id; a query id that
is repeated is asked once. An empty table has no results; with fewer candidates than k, all are returned.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from feira.llm.components import written
from feira.llm.shared import bounded_batches, tidy, tidy_group

TOP = 5
PIVOTS = 64  # for each number of components
GROUPS = 256  # numbers of components that get pivots of their own; others are one cell each
QUERIES_AT_ONCE = 512
VECTORS_AT_ONCE = 16_384


def as_integers(rows: DataFrame, key: str, vector: str) -> DataFrame:
    """(id, dim, v): v = floor(256 x) as array of longs, for vectors that can take part."""
    chosen = rows.select(F.col(key).cast("long").alias("id"), F.col(vector).alias("raw")).where(
        "id IS NOT NULL AND raw IS NOT NULL AND size(raw) > 0 AND "
        "forall(raw, x -> x IS NOT NULL AND NOT isnan(x) AND abs(double(x)) < double('infinity'))")
    return chosen.select("id", F.size("raw").alias("dim"), F.transform(
        "raw", lambda x: F.floor(F.lit(256.0) * x.cast("double")).cast("long")).alias("v"))


def _matrix(column) -> np.ndarray:
    """The vectors of a list column with equally long values."""
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1) if len(column) else np.zeros((0, 0), np.int64)


def _products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact integer products: by floats where every sum stays below 2^53."""
    largest = float(np.abs(a).max(initial=0)) * float(np.abs(b).max(initial=0)) * a.shape[1]
    return (a.astype(np.float64) @ b.astype(np.float64).T).astype(np.int64) if largest < 2.0**53 else a @ b.T


def _assign(pivots: dict[int, np.ndarray]):
    """Adds the cell (nearest pivot) of each vector and its distance to the pivot."""
    def each(batches):
        for batch in batches:
            dims = batch.column(1).to_numpy()
            for dim in np.unique(dims).tolist():
                own = batch.filter(pa.array(dims == dim))
                x = _matrix(own.column(2)).astype(np.float64)
                p = pivots.get(dim)
                if p is None:
                    p = np.zeros((1, dim))
                square = (x**2).sum(axis=1)[:, None] - 2 * (x @ p.T) + (p**2).sum(axis=1)[None, :]
                cell = square.argmin(axis=1)
                away = np.sqrt(((x - p[cell])**2).sum(axis=1))
                yield pa.RecordBatch.from_arrays(
                    [*own.columns, pa.array(cell.astype(np.int32)), pa.array(away)], names=["id", "dim", "v", "cell", "away"])

    return each


def reachable(summary: list, asked: list, pivots: dict[int, np.ndarray], top: int) -> list[tuple[int, int, int]]:
    """(dim, query cell, data cell) whose vectors can be among the best of the group, from summaries only.

    A summary counts the vectors of its cell that are candidates of any query: without the query's own rows.
    """
    data: dict[int, list] = {}
    for dim, cell, count, radius in summary:
        data.setdefault(dim, []).append((cell, count, radius))
    pairs = []
    for dim, group, spread in asked:
        p = pivots.get(dim, np.zeros((1, dim)))
        cells = data[dim]
        centre = p[[c for c, _, _ in cells]]
        radius = np.array([r for _, _, r in cells])
        near = centre @ p[group]
        slack = np.linalg.norm(p[group]) * radius + np.linalg.norm(centre, axis=1) * spread + spread * radius
        slack = slack * (1 + 1e-9) + 1e-6  # rounding of the bounds themselves
        low, high = near - slack, near + slack
        sure, left = -np.inf, top
        for k in np.argsort(-low):
            left -= cells[k][1]
            if left <= 0:
                sure = low[k]
                break
        pairs += [(dim, group, cells[k][0]) for k in np.flatnonzero(high >= sure)]
    return pairs


def merged_groups(asked: list, pivots: dict[int, np.ndarray], size: int) -> dict[tuple[int, int], int]:
    """Joins query cells of neighbouring pivots to groups of about ``size`` queries: (dim, cell) to group."""
    group_of: dict[tuple[int, int], int] = {}
    for dim in sorted({a[0] for a in asked}):
        left = {cell: n for d, cell, n in asked if d == dim}
        p, group = pivots.get(dim, np.zeros((1, dim))), 0
        while left:
            start = max(left, key=lambda c: (left[c], -c))
            room = size
            for cell in sorted(left, key=lambda c: (float(((p[c] - p[start]) ** 2).sum()), c)):
                if cell != start and left[cell] > room:
                    break
                room -= left.pop(cell)
                group_of[dim, cell] = group
            group += 1
    return group_of


def nearest(rows: DataFrame, every: int, key: str = "vec_id", vector: str = "embedding", top: int = TOP) -> DataFrame:
    """The ``top`` best of each vector whose id is divisible by ``every``: query_id, rank, vec_id, score."""
    spark = rows.sparkSession
    bounded_batches(spark)
    vectors = as_integers(rows, key, vector)
    dims = [r[0] for r in vectors.groupBy("dim").count().orderBy(F.desc("count"), "dim").limit(GROUPS).collect()]
    pivots: dict[int, np.ndarray] = {}
    for dim in dims:
        sample = vectors.where(F.col("dim") == dim).groupBy("v").agg(F.min("id").alias("id")).orderBy(
            F.xxhash64("id"), "id").limit(PIVOTS).select("v").collect()
        pivots[dim] = np.array([r[0] for r in sample], np.float64)
    placed = written(vectors.mapInArrow(tidy(_assign(pivots)), "id long, dim int, v array<long>, cell int, away double"), "cells")
    is_query = F.pmod("id", F.lit(every)) == 0
    summary = placed.groupBy("dim", "cell").agg(F.count("*").alias("n"), F.max("away").alias("r"))
    asked = placed.where(is_query).groupBy("dim", "cell").agg(F.max("away").alias("r"), F.count("*").alias("n"))
    # A row per pivot at most; cells without pivots of their own are replicated to all queries of their dim.
    known = F.col("dim").isin(dims) if dims else F.lit(False)
    own_rows = placed.where(is_query).groupBy("dim", "cell", "id").count().groupBy("dim", "cell").agg(F.max("count").alias("own"))
    found = [tuple(r) for r in summary.where(known).join(own_rows, ["dim", "cell"], "left").select(
        "dim", "cell", F.col("n") - F.coalesce("own", F.lit(0)), "r").collect()]
    groups = [tuple(r) for r in asked.where(known).select("dim", "cell", "r", "n").collect()]
    group_of = merged_groups([(d, c, n) for d, c, _, n in groups], pivots, QUERIES_AT_ONCE)
    needed = {(d, group_of[d, g], c) for d, g, c in reachable(found, [g[:3] for g in groups], pivots, top)}
    pairs = spark.createDataFrame(sorted(needed), "dim int, grp int, cell int").union(
        summary.where(~known).select("dim", F.lit(0).alias("grp"), "cell"))
    merged = spark.createDataFrame([(d, c, g) for (d, c), g in group_of.items()], "dim int, cell int, grp int").union(
        asked.where(~known).select("dim", "cell", F.lit(0).alias("grp")))
    sizes = summary.select("dim", "cell", F.ceil(F.col("n") / VECTORS_AT_ONCE).cast("int").alias("chunks"))
    loads = asked.join(merged, ["dim", "cell"]).groupBy("dim", "grp").agg(
        F.ceil(F.sum("n") / QUERIES_AT_ONCE).cast("int").alias("parts"))
    plan = pairs.join(sizes, ["dim", "cell"]).join(loads, ["dim", "grp"])
    own = ["dim", "grp", "cell", "chunk", "part", "asks", "id", "v"]
    data = placed.join(plan, ["dim", "cell"]).withColumn("chunk", F.pmod(F.xxhash64("id"), "chunks").cast("int")).withColumn(
        "part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1))).withColumn("asks", F.lit(False)).select(own)
    queries = placed.where(is_query).join(merged, ["dim", "cell"]).drop("cell").join(plan, ["dim", "grp"]).withColumn(
        "part", F.pmod(F.xxhash64("id"), "parts").cast("int")).withColumn(
        "chunk", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1))).withColumn("asks", F.lit(True)).select(own)

    def solve(table: pa.Table) -> pa.Table:
        table = table.combine_chunks()
        asks = table.column("asks").to_numpy()
        q, d = table.filter(pa.array(asks)), table.filter(pa.array(~asks))
        out = ([], [], [])
        if q.num_rows and d.num_rows:
            x, y = (_matrix(t.column("v").combine_chunks()) for t in (q, d))
            ids, mine = d.column("id").to_numpy(), q.column("id").to_numpy()
            score = _products(x, y)
            for k in np.unique(mine, return_index=True)[1]:
                others = np.flatnonzero(ids != mine[k])
                s = score[k, others]
                if len(s) > top:
                    keep = np.flatnonzero(s >= np.partition(s, len(s) - top)[len(s) - top])
                    others, s = others[keep], s[keep]
                best = np.lexsort((ids[others], -s))[:top]
                out[0].extend([int(mine[k])] * len(best))
                out[1].extend(ids[others[best]].tolist())
                out[2].extend(s[best].tolist())
        return pa.Table.from_arrays([pa.array(c, pa.int64()) for c in out], names=["query_id", "vec_id", "score"])

    local = data.union(queries).groupBy("dim", "grp", "cell", "chunk", "part").applyInArrow(tidy_group(solve), "query_id long, vec_id long, score long")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return local.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top).select("query_id", "rank", "vec_id", "score")
