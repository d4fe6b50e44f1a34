"""Nearest neighbours through low-dimensional stable projections.

Vectors are scaled to unit length and projected with a fixed Gaussian (that
is, 2-stable) matrix to DIMS dimensions; the squared projected distance of two
vectors over their squared distance then follows a chi-square law with DIMS
degrees of freedom.  A kd-tree over the projections deals the rows to cells,
split further into blocks of bounded size, and every block has a kd-tree of
its own.  A query takes the leaves of a block in order of projected distance,
verifies their vectors exactly, and stops when a vector as near as its k-th
best so far would, with probability STOP, have come earlier.  The same test
decides which other cells a query must visit after its own.  Vectors of
different lengths have trees and cells of their own.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from civgraph.llm.common import stored

DIMS = 8
STOP = 0.97
SAMPLE = 20_000  # rows that the top of the tree is fitted on, at most
CELL_ROWS = 4096
MAX_CELLS = 2048
LEAF_ROWS = 32


def chi_square(x):
    """Distribution function for the even number DIMS of degrees of freedom."""
    half = np.asarray(x, dtype=float) / 2
    return 1 - np.exp(-half) * sum(half**i / math.factorial(i) for i in range(DIMS // 2))


@dataclass
class Tree:
    """Cells of the projected space: boxes, and the splits that lead to them."""

    splits: list  # (dimension, value, low child, high child); child < 0: cell -child - 1
    low: np.ndarray
    high: np.ndarray

    def cells(self, points: np.ndarray) -> np.ndarray:
        out = np.zeros(len(points), dtype=np.int64)
        todo = [(0 if self.splits else -1, np.arange(len(points)))]
        while todo:
            node, rows = todo.pop()
            if node < 0:
                out[rows] = -node - 1
                continue
            dim, value, below, above = self.splits[node]
            up = points[rows, dim] > value
            todo += [(below, rows[~up]), (above, rows[up])]
        return out


def kd_tree(points: np.ndarray, leaf_rows: int) -> tuple[Tree, list[np.ndarray]]:
    """Median splits along the widest dimension, and the rows of each cell.
    Equal points cannot be split and stay in one cell."""
    splits, low, high, members = [], [], [], []

    def grow(rows, lo, hi):
        spread = np.ptp(points[rows], axis=0) if len(rows) else np.zeros(points.shape[1])
        dim = int(spread.argmax())
        if len(rows) <= leaf_rows or spread[dim] == 0:
            low.append(lo)
            high.append(hi)
            members.append(rows)
            return -len(low)
        values = points[rows, dim]
        value = float(np.median(values))
        if value == values.max():
            value = float(values[values < value].max())
        at = len(splits)
        splits.append(None)
        up, hi_low, lo_up = values > value, hi.copy(), lo.copy()
        hi_low[dim] = lo_up[dim] = value
        splits[at] = (dim, value, grow(rows[~up], lo, hi_low), grow(rows[up], lo_up, hi))
        return at

    dims = points.shape[1]
    grow(np.arange(len(points)), np.full(dims, -np.inf), np.full(dims, np.inf))
    return Tree(splits, np.array(low), np.array(high)), members


def _gaps(point: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """Squared distances from a point to boxes."""
    off = np.maximum(np.maximum(low - point, point - high), 0)
    return (off * off).sum(axis=1)


def _search(block: pd.DataFrame, queries: pd.DataFrame, k: int, stop: float) -> pd.DataFrame:
    """The k best rows of a block for each query, within its bound."""
    block = block.drop_duplicates(["vec_id", "raw"])
    columns = ["query_id", "vec_id", "score"]
    if not len(block) or not len(queries):
        return pd.DataFrame({c: [] for c in columns})
    raw = np.frombuffer(b"".join(block.raw), dtype="<f8").reshape(len(block), -1)
    points = np.frombuffer(b"".join(block.point), dtype="<f8").reshape(-1, DIMS)
    ids, norms = block.vec_id.to_numpy(), np.sqrt((raw * raw).sum(axis=1))
    units = raw / norms[:, None]
    _, members = kd_tree(points, LEAF_ROWS)
    low = np.array([points[m].min(axis=0) for m in members])
    high = np.array([points[m].max(axis=0) for m in members])
    out = []
    for q in queries.itertuples():
        vector, point = np.frombuffer(q.raw, "<f8"), np.frombuffer(q.point, "<f8")
        norm = np.sqrt((vector * vector).sum())
        gaps = _gaps(point, low, high)
        kth, best_ids, best = q.bound, np.zeros(0, dtype=np.int64), np.zeros(0)
        order = np.argsort(gaps, kind="stable")
        unit, at, step = vector / norm, 0, 2
        while at < len(order):
            # the next leaves in order, as long as the test does not hold
            # (squared distance of unit vectors from the cosine; equal vectors are all looked at)
            near = max(0.0, 2 - 2 * kth)
            some = order[at:at + step]
            some = some[gaps[some] == 0 if near == 0 else chi_square(gaps[some] / near) < stop]
            if not len(some):
                break
            rows = np.concatenate([members[leaf] for leaf in some])
            at, step = at + step, 4 * step
            # exact sums for those that a rounding error could still bring in
            rows = rows[(units[rows] @ unit >= kth - 1e-9) & (ids[rows] != q.query_id)]
            score = (raw[rows] * vector).sum(axis=1) / (norms[rows] * norm)
            best_ids, best = np.append(best_ids, ids[rows]), np.append(best, score)
            top = np.lexsort((best_ids, -best))
            _, once = np.unique(best_ids[top], return_index=True)
            top = top[np.sort(once)][:k]
            best_ids, best = best_ids[top], best[top]
            if len(best) == k:
                kth = max(kth, best[-1])
        out.append(pd.DataFrame({"query_id": q.query_id, "vec_id": best_ids, "score": best}))
    return pd.concat(out)[columns]


@dataclass
class Part:
    """The vectors of one length: their projection, tree and first cell."""

    number: int
    matrix: np.ndarray
    tree: Tree
    first: int = 0


def _indexed(vectors: DataFrame, parts: dict[int, Part]) -> DataFrame:
    """vec_id, raw (the vector, doubles), point (its projection), part and cell."""

    def run(batches):
        for batch in batches:
            lists = batch.column(1).cast(pa.list_(pa.float64()))
            sizes = lists.value_lengths().to_numpy(zero_copy_only=False)
            for dim in np.unique(sizes).tolist():
                rows, part = pa.array(np.flatnonzero(sizes == dim)), parts[dim]
                raw = lists.take(rows).flatten().to_numpy(zero_copy_only=False).reshape(-1, dim)
                # scaled first, so that squares neither overflow nor vanish
                unit = raw / np.abs(raw).max(axis=1, keepdims=True)
                unit = unit / np.sqrt((unit * unit).sum(axis=1, keepdims=True))
                points = unit @ part.matrix
                yield pa.RecordBatch.from_arrays([
                    batch.column(0).take(rows), pa.array([r.tobytes() for r in raw], pa.binary()),
                    pa.array([p.tobytes() for p in points], pa.binary()),
                    pa.array(np.full(len(raw), part.number), pa.int32()),
                    pa.array(part.first + part.tree.cells(points), pa.int64())],
                    ["vec_id", "raw", "point", "part", "cell"])

    return vectors.mapInArrow(run, "vec_id long, raw binary, point binary, part int, cell long")


def _parts(vectors: DataFrame) -> dict[int, Part]:
    """The lengths of the vectors (column e), most frequent first.  A length
    of fewer rows than two cells hold needs no tree and is one cell."""
    counted = vectors.groupBy(F.size("e").alias("n")).count().orderBy(F.desc("count"), "n").collect()
    one, _ = kd_tree(np.zeros((0, DIMS)), 1)
    parts, first = {}, 0
    for number, (dim, rows) in enumerate(counted):
        part = Part(number, np.random.default_rng(11).standard_normal((dim, DIMS)), one)
        if (cells := min(MAX_CELLS, rows // CELL_ROWS)) > 1:
            some = vectors.where(F.size("e") == dim).orderBy(F.xxhash64("vec_id"), "vec_id").limit(SAMPLE)
            points = [bytes(r.point) for r in _indexed(some, {dim: part}).select("point").collect()]
            seen = np.frombuffer(b"".join(points), "<f8").reshape(-1, DIMS)
            part.tree, _ = kd_tree(seen, max(1, len(seen) // cells))
        part.first = first
        first += len(part.tree.low)
        parts[dim] = part
    return parts


def nearest(vectors: DataFrame, is_query, k: int = 5) -> DataFrame:
    """query_id, rank, vec_id and score (cosine in double precision) of the k
    nearest other rows of every row for which ``is_query`` holds.

    ``vectors`` has vec_id and embedding.  Vectors that are null, zero, hold a
    null or a non-finite number, or have no id take no part.  A row is answered
    among the vectors of its own length; an id with vectors of several lengths
    asks with one of the most frequent.  Rows of one id are not neighbours of each other and appear
    once; ties go to the smaller id.
    """
    doubles = F.col("embedding").cast("array<double>")
    usable = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), doubles.alias("e")).where(
        F.col("vec_id").isNotNull() & F.col("e").isNotNull()
        & ~F.exists("e", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))) & F.exists("e", lambda x: x != 0))
    spark = vectors.sparkSession
    result = "query_id long, rank int, vec_id long, score double"
    parts = _parts(usable)
    if not parts:
        return spark.createDataFrame([], result)
    index = stored(_indexed(usable, parts), "index")
    # a cell is as many blocks as its rows need; equal vectors spread by id
    sizes = stored(index.groupBy("cell").agg(F.ceil(F.count("*") / CELL_ROWS).cast("int").alias("blocks")), "cells")
    blocks = index.join(F.broadcast(sizes), "cell").withColumn(
        "block", F.pmod(F.xxhash64("vec_id"), F.col("blocks").cast("long"))).select("cell", "block", "vec_id", "raw", "point")
    queries = index.where(is_query(F.col("vec_id"))).groupBy("vec_id").agg(
        F.min(F.struct("part", "raw", "point", "cell")).alias("q")).select(
            F.col("vec_id").alias("query_id"), "q.raw", "q.point", "q.cell")

    def visit(asked: DataFrame) -> DataFrame:
        sent = asked.join(F.broadcast(sizes), "cell").withColumn(
            "block", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks").cast("long") - 1))).select(
                "cell", "block", "query_id", "raw", "point", "bound")
        return blocks.groupBy("cell", "block").cogroup(sent.groupBy("cell", "block")).applyInPandas(
            lambda b, q: _search(b, q, k, STOP), "query_id long, vec_id long, score double")

    home = stored(visit(queries.withColumn("bound", F.lit(-1.0))), "home")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")

    def ranked(found: DataFrame) -> DataFrame:
        # rows of one id can lie in several cells and blocks
        best = found.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
        return best.withColumn("rank", F.row_number().over(order).cast("int"))

    kth = ranked(home).where(F.col("rank") == k).select(
        "query_id", F.col("score").alias("bound"))
    bounded = queries.join(kth, "query_id", "left").withColumn("bound", F.coalesce("bound", F.lit(-1.0)))

    def others(batches):
        for q in batches:
            points = q.point.map(lambda p: np.frombuffer(p, "<f8"))
            for row, point in zip(q.itertuples(), points):
                near, part = max(0.0, 2 - 2 * row.bound), parts[len(row.raw) // 8]
                gaps = _gaps(point, part.tree.low, part.tree.high)
                go = (gaps == 0) if near == 0 else (chi_square(gaps / near) < STOP)
                go[row.cell - part.first] = False
                to = part.first + np.flatnonzero(go)
                if len(to):
                    yield pd.DataFrame({"cell": to, "query_id": row.query_id, "raw": row.raw, "point": row.point,
                                        "bound": row.bound})

    asked = bounded.select("cell", "query_id", "raw", "point", "bound").mapInPandas(
        others, "cell long, query_id long, raw binary, point binary, bound double")
    return ranked(home.unionAll(visit(asked))).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
