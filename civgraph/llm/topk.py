"""Exact top-k search by inner product, a score at a time.

Components become whole numbers, so scores are exact.  Vectors are dealt to
blocks, and each block keeps an index: per dimension the postings of its
vectors by descending value, cut into segments of one quantised value.  A
query meets the segments of a block in the order of their impact, that is, of
the most that a member can add to the score.  A member's bound is the impact of
the segments it was seen in and, for each dimension where it was not,
that of the next segment there.  The query goes on until so few members have
bounds that reach its k-th best score that they are scored exactly; nothing
else ends it.

Queries first search the block they lie in, which gives a k-th best score to
start from, and then all other blocks.  They meet a block in groups of
bounded size; a block never meets more than ``GROUP`` blocks' queries in one task.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from civgraph.llm.common import stored

SCALE = 256  # fixed value
LEVELS = 32  # quantised values of a dimension in a block
BLOCK = 4096  # vectors of one block
GROUP = 64  # blocks whose queries meet a block in one task
#: Shares of the postings after which members are counted.
STOPS = (0.6, 0.8, 1.0)
#: Share of a block that may be left to score: that costs less than going on from there.
LEFT = 1 / 4
HUGE = 2.0 ** 500  # components further from zero count as this
TOP = 2 ** 63 - 1  # scores further from zero count as this


def whole(vectors: np.ndarray) -> np.ndarray:
    """floor(256 x) as doubles, which hold these whole numbers exactly."""
    return np.floor(np.clip(vectors, -HUGE, HUGE) * SCALE)


def exact_scores(rows: np.ndarray, w: np.ndarray) -> np.ndarray:
    """Exact inner products, at most ``TOP`` from zero."""
    if np.abs(rows).max(initial=0) * np.abs(w).max(initial=0) * max(1, len(w)) < 2.0 ** 53:
        return (rows @ w).astype(np.int64)
    weights = [int(x) for x in w]
    sums = (sum(int(a) * b for a, b in zip(row, weights)) for row in rows)
    return np.array([max(-TOP, min(TOP, x)) for x in sums], dtype=np.int64)


class Block:
    """Vectors of one length with their impact-ordered postings."""

    def __init__(self, ids: np.ndarray, rows: np.ndarray):
        self.ids, self.rows = ids, rows
        n, dims = rows.shape
        if not dims:
            return
        order = np.argsort(-rows, axis=0, kind="stable").T  # per dimension, largest first
        values = np.take_along_axis(rows.T, order, axis=1)
        spread = values[:, :1] - values[:, -1:]
        level = np.minimum(LEVELS - 1, (values[:, :1] - values) / np.where(spread > 0, spread, 1) * LEVELS).astype(np.int64)
        key = level + np.arange(dims)[:, None] * LEVELS
        first = np.ones(n * dims, bool)
        first[1:] = key.ravel()[1:] != key.ravel()[:-1]
        self.postings = order.ravel()
        self.start = np.flatnonzero(first)
        self.stop = np.append(self.start[1:], n * dims)
        self.dim = self.start // n
        flat = values.ravel()
        self.high, self.low = flat[self.start], flat[self.stop - 1]
        self.largest = np.abs(rows).max(initial=0)

    def bounds(self, w: np.ndarray):
        """After each of the ``STOPS``: a bound on the score of every member."""
        n, dims = self.rows.shape
        impact = np.where(w[self.dim] >= 0, w[self.dim] * self.high, w[self.dim] * self.low)
        order = np.argsort(-impact, kind="stable")
        done = np.cumsum((self.stop - self.start)[order])
        # doubles are exact here unless values are huge, where the bounds get room
        room = self.largest * np.abs(w).sum()
        room = room * 1e-9 if room > 2.0 ** 52 else 0.0
        for share in STOPS:
            seen = np.zeros(len(order), bool)
            seen[order[:np.searchsorted(done, share * n * dims)]] = True
            if share == 1:
                seen[:] = True
            ahead = np.full(dims, -np.inf)
            np.maximum.at(ahead, self.dim[~seen], impact[~seen])
            ahead[np.isneginf(ahead)] = 0  # all of it was seen
            at = np.flatnonzero(seen)
            if not len(at):
                yield np.full(n, ahead.sum() + room), share
                continue
            add = np.repeat(impact[at] - ahead[self.dim[at]], (self.stop - self.start)[at])
            cuts = np.flatnonzero(self.start[at[1:]] != self.stop[at[:-1]]) + 1
            parts = zip(self.start[at[np.append(0, cuts)]], self.stop[at[np.append(cuts - 1, len(at) - 1)]])
            members = np.concatenate([self.postings[a:b] for a, b in parts])
            yield np.bincount(members, add, n) + ahead.sum() + room, share

    def scored(self, members: np.ndarray, w: np.ndarray) -> list[tuple]:
        return list(zip((-exact_scores(self.rows[members], w)).tolist(), self.ids[members].tolist()))

    def search(self, own: int, w: np.ndarray, k: int, best: list[tuple]) -> list[tuple]:
        """The k best (-score, id) of ``best`` and the members, without ``own``."""
        if not self.rows.size:  # vectors without components
            return merged(best + [(0, i) for i in self.ids.tolist() if i != own], k)
        for bound, share in self.bounds(w):
            bound = np.maximum(bound, -float(TOP))
            bound[self.ids == own] = -np.inf
            if len(best) < k:  # any members give a score to start from
                ahead = np.argpartition(-bound, min(4 * k, len(bound) - 1))[:4 * k + 1]
                best = merged(best + self.scored(ahead[bound[ahead] > -np.inf], w), k)
            if len(best) < k:
                live = bound > -np.inf
            else:
                least, last = -float(best[-1][0]), best[-1][1]
                live = (bound > least) | ((bound == least) & (self.ids < last))
            if share == 1 or live.sum() <= max(4 * k, LEFT * len(bound)):
                return merged(best + self.scored(np.flatnonzero(live), w), k)
        raise AssertionError("the last stop sees all postings")


def merged(found: list[tuple], k: int) -> list[tuple]:
    """The k best (-score, id), each id once with its best score."""
    out, ids = [], set()
    for one in sorted(found):
        if one[1] not in ids:
            out.append(one)
            ids.add(one[1])
            if len(out) == k:
                break
    return out


def _blocks(usable: DataFrame) -> DataFrame:
    """Written blocks (piece, number, dim, ids, rows) of at most ``BLOCK``
    vectors of one length.  Vectors with the same leading dimension come together."""
    size = F.transform("e", lambda x: F.abs(x))
    lead = F.array_position(size, F.array_max(size))
    up = F.get("e", (lead - 1).cast("int")) > 0
    pieces = max(1, -(-usable.count() // BLOCK))
    dealt = usable.withColumn("dim", F.size("e")).withColumn("lead", lead).withColumn("up", up).repartitionByRange(
        pieces, "dim", "lead", "up", "vec_id", "e").sortWithinPartitions("dim", "lead", "up", "vec_id", "e").select(
            F.spark_partition_id().alias("piece"), "vec_id", "e", "dim")

    def run(batches):
        piece, number, dim, ids, rows = 0, 0, -1, [], []

        def block():
            return pa.RecordBatch.from_pydict({
                "piece": pa.array([piece], pa.int32()), "number": pa.array([number], pa.int32()), "dim": pa.array([dim], pa.int32()),
                "ids": pa.array([np.array(ids, "<i8").tobytes()]), "rows": pa.array([b"".join(rows)])})

        for batch in batches:
            for p, i, e, d in zip(*(batch.column(c).to_pylist() for c in ("piece", "vec_id", "e", "dim"))):
                if ids and (d != dim or len(ids) == BLOCK):
                    yield block()
                    number, ids, rows = number + 1, [], []
                piece, dim = p, d
                ids.append(i)
                rows.append(whole(np.array(e, "<f8")).tobytes())
        if ids:
            yield block()

    return stored(dealt.mapInArrow(run, "piece int, number int, dim int, ids binary, rows binary"), "blocks")


def _read(block) -> Block:
    ids = np.frombuffer(block.ids, "<i8")
    return Block(ids, np.frombuffer(block.rows, "<f8").reshape(len(ids), block.dim))


def top(vectors: DataFrame, every: int, k: int = 5) -> DataFrame:
    """query_id, rank, vec_id and score (integer inner product of the vectors
    floor(256 x)) of the k highest scores of other rows, for every row whose
    vec_id is divisible by ``every``.

    ``vectors`` has vec_id and embedding.  Vectors that are null, hold a null
    or a non-finite number, or have no id take no part; zero vectors do.  A row is
    answered among the vectors of its own length.  Rows of one id are not
    candidates of each other and appear once, with their best score; an id of
    several vectors asks with the first one (shortest, then smallest).  Ties go to the
    smaller id; scores beyond a long are given as its limit.  Other columns are not
    read; no rows give no rows.
    """
    doubles = F.col("embedding").cast("array<double>")
    usable = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), doubles.alias("e")).where(
        F.col("vec_id").isNotNull() & F.col("e").isNotNull()
        & ~F.exists("e", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))))
    few = {"spark.sql.execution.arrow.maxRecordsPerBatch": "8"}  # a row is a whole block
    blocks = _blocks(usable.distinct())
    last = blocks.agg(F.max("piece")).first()[0]

    def home(batches):
        for batch in batches:
            for b in batch.itertuples():
                block, out, first = _read(b), [], {}
                for at in np.flatnonzero(block.ids % every == 0).tolist():
                    w = block.rows[at].tobytes()
                    first[block.ids[at]] = min(first.get(block.ids[at], (w, at)), (w, at))
                for own, (w, at) in first.items():
                    best = block.search(own, block.rows[at], k, [])
                    out.append((own, b.dim, w, b.piece, b.number, [i for _, i in best], [-s for s, _ in best]))
                yield pd.DataFrame(out, columns=["query_id", "dim", "w", "piece", "number", "ids", "scores"])

    asked = stored(blocks.mapInPandas(
        home, "query_id long, dim int, w binary, piece int, number int, ids array<long>, scores array<long>"), "home", few)
    asked = asked.groupBy("query_id").agg(F.min(F.struct("dim", "w", "piece", "number", "ids", "scores")).alias("q")).select(
        "query_id", "q.*")

    def others(_, members: pd.DataFrame, queries: pd.DataFrame) -> pd.DataFrame:
        out = []
        for b in members.itertuples():
            block = _read(b)
            for q in queries.itertuples():
                if (q.home, q.number) != (b.piece, b.number):
                    known = [(-s, i) for s, i in zip(q.scores.tolist(), q.ids.tolist())]
                    best = block.search(q.query_id, np.frombuffer(q.w, "<f8"), k, known)
                    out += [(q.query_id, i, -s) for s, i in best if (s, i) not in known]
        return pd.DataFrame(out, columns=["query_id", "vec_id", "score"])

    found = asked.select("query_id", F.explode(F.arrays_zip("ids", "scores")).alias("x")).select(
        "query_id", F.col("x.ids").alias("vec_id"), F.col("x.scores").alias("score"))
    if last is not None:
        to = F.sequence(F.lit(0), F.lit(last))
        met = blocks.withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(last // GROUP))))
        sent = asked.withColumn("part", F.floor(F.col("piece") / GROUP).cast("int")).withColumnRenamed(
            "piece", "home").withColumn("piece", F.explode(to))
        more = met.groupBy("piece", "dim", "part").cogroup(sent.groupBy("piece", "dim", "part")).applyInPandas(
            others, "query_id long, vec_id long, score long")
        found = stored(found.unionAll(more), "found", few)
    best = found.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return best.withColumn("rank", F.row_number().over(order).cast("int")).where(F.col("rank") <= k).select(
        "query_id", "rank", "vec_id", "score")
