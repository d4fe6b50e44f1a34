"""Similarity join on word n-gram sets (Jaccard) with rare-first prefixes.

1. Every whole text becomes the set of its word n-gram hashes, written once.
   Texts with equal sets form a class; from here on a class is one vertex.
2. Document frequencies are counted over all documents in a fixed number of
   hashed counters; they order the n-grams of a set, rare ones first.
3. Two sets that reach the threshold share an n-gram among the first
   n - ceil(t * n) + 1 of each (prefix filter).  Vertices meet on these.
4. In the group of a prefix n-gram every vertex is compared with a pivot of
   the group, the member with the fewest rarer n-grams.  Links found that way contract most of a large group; the
   pairs left, those between different components, are all compared.  No pair
   in one component needs comparing, and no other pair is left out.
5. Pairs pass length, positional and suffix filters and are verified once, on
   the whole sets.

Step 4 is enough for components.  ``all_links`` leaves it out: every pair of a
prefix group meets, large groups in blocks, so that no link is missing.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from civgraph.llm.common import forget, give_back, stored
from civgraph.llm.graph import components

COUNTER_BITS = 21
SLICES = 64
MARK_BITS = 20
SUFFIX_PARTS = 32
PIVOTS = 4
BLOCK_ROWS = 1024  # members of a prefix group that meet as many others in one key
_MIX = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93,
        0xA0761D6478BD642F, 0xE7037ED1A0B428DB, 0x8EBC6AF09C88C6E3, 0x589965CC75374CC3)


class ShingleSets:
    """Sorted distinct n-gram hashes of whole texts.

    A-Z are lower-cased; words part at ASCII white space.  A text of fewer
    words than ``n`` is one n-gram; one without words has an empty set.  Words
    are hashed anew each time: a cache of them is slower and holds memory.
    """

    def __init__(self, n: int):
        self.n = n

    def __call__(self, text: str | None) -> np.ndarray:
        words = (text or "").encode("utf-8", "surrogatepass").lower().split()
        ids = np.fromiter(map(xxhash.xxh3_64_intdigest, words), dtype=np.uint64, count=len(words))
        n = min(self.n, len(ids))
        if not n:
            return ids
        h = np.full(len(ids) - n + 1, n, dtype=np.uint64)
        for i in range(n):
            h = (h ^ ids[i:len(ids) - n + 1 + i]) * np.uint64(_MIX[i % len(_MIX)])
            h ^= h >> np.uint64(29)
        h.sort()
        return h[np.append(True, h[1:] != h[:-1])]


def _set_id(shingles: np.ndarray) -> int | None:
    return int(np.uint64(xxhash.xxh3_64_intdigest(shingles.tobytes())).astype(np.int64)) if len(shingles) else None


def _sets(documents: DataFrame, n: int, counters: int = COUNTER_BITS) -> DataFrame:
    """One row per document (doc_id, text_hash, size, v, parts: n-grams in each
    part of the hash space, shingles: the set itself, once for equal sets of a
    task) and, with a slice number, the counters of each task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingles, seen, counts = ShingleSets(n), set(), np.zeros(1 << counters, dtype=np.int32)
        names = ["doc_id", "text_hash", "size", "v", "parts", "shingles", "slice", "counts"]
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                some = batch.slice(at, 512)
                found = [shingles(text) for text in some.column(1).to_pylist()]
                ids = [_set_id(s) for s in found]
                raw = []
                for v, s in zip(ids, found):
                    raw.append(None if v is None or v in seen else s.tobytes())
                    seen.add(v)
                hit, times = np.unique(np.concatenate(found) >> np.uint64(64 - counters), return_counts=True)
                counts[hit.astype(np.int64)] += times.astype(np.int32)
                parts = [np.bincount((s & np.uint64(SUFFIX_PARTS - 1)).astype(np.int64), minlength=SUFFIX_PARTS)
                         for s in found]
                none = pa.nulls(len(ids), pa.int32()), pa.nulls(len(ids), pa.binary())
                yield pa.RecordBatch.from_arrays([
                    some.column(0), some.column(2), pa.array(map(len, found), pa.int64()), pa.array(ids, pa.int64()),
                    pa.array(parts, pa.list_(pa.int32())), pa.array(raw, pa.binary()), *none], names)
        if counts.any():
            part = np.array_split(counts, SLICES)
            none = [*[pa.nulls(SLICES, pa.int64())] * 4, pa.nulls(SLICES, pa.list_(pa.int32())),
                    pa.nulls(SLICES, pa.binary())]
            yield pa.RecordBatch.from_arrays([*none, pa.array(range(SLICES), pa.int32()),
                                              pa.array([p.tobytes() for p in part], pa.binary())], names)
        give_back()

    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.xxhash64("text").alias("h"))
    return rows.mapInArrow(run, "doc_id long, text_hash long, size long, v long, parts array<int>, "
                                "shingles binary, slice int, counts binary")


def _frequencies(sets: DataFrame) -> np.ndarray:
    """The counters of all tasks added up, slice by slice."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, np.ndarray] = {}
        for batch in batches:
            for k, raw in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                c = np.frombuffer(raw, dtype=np.int32)
                total[k] = total[k] + c if k in total else c.astype(np.int64)
        yield pa.RecordBatch.from_arrays([pa.array(list(total), pa.int32()), pa.array(
            [v.tobytes() for v in total.values()], pa.binary())], ["slice", "counts"])

    found = sets.where("slice IS NOT NULL").select("slice", "counts").repartition(SLICES, "slice").mapInArrow(
        add, "slice int, counts binary").collect()
    if not found:
        return np.zeros(1 << COUNTER_BITS, dtype=np.int64)
    return np.concatenate([np.frombuffer(r.counts, dtype=np.int64) for r in sorted(found, key=lambda r: r.slice)])


def _prefixes(sets: DataFrame, percent: int, frequency: np.ndarray) -> DataFrame:
    """(token, v, size, pos) of the prefix of every set; equal sets of a task once."""
    most = np.iinfo(np.int32).max  # n-grams beyond are equally frequent: still one order
    shared = sets.sparkSession.sparkContext.broadcast(np.minimum(frequency, most).astype(np.int32))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        freq, shift = shared.value, np.uint64(64 - COUNTER_BITS)

        def flush(out):
            cols = [np.concatenate(c) for c in zip(*out)]
            return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in cols], ["token", "v", "size", "pos"])

        for batch in batches:
            out, rows = [], 0
            for v, raw in zip(batch.column(0).to_pylist(), batch.column(1)):
                s = np.frombuffer(raw.as_buffer(), dtype=np.uint64)
                length = len(s) - (percent * len(s) + 99) // 100 + 1
                # sets are sorted, so that a stable sort settles ties by n-gram
                order = np.argsort(freq[(s >> shift).astype(np.int64)], kind="stable")[:length]
                out.append((s[order].astype(np.int64), np.full(length, v), np.full(length, len(s)), np.arange(length)))
                rows += length
                if rows > 100_000:
                    yield flush(out)
                    out, rows = [], 0
            if out:
                yield flush(out)
        give_back()

    return sets.where("shingles IS NOT NULL").select("v", "shingles").mapInArrow(
        run, "token long, v long, size long, pos long")


def _whole_sets(sets: DataFrame, vertices: DataFrame) -> DataFrame:
    """(v, shingles) of the given vertices.

    A bitmap of 2**MARK_BITS hashed vertices, whatever their number, spares
    most other sets the way out of the task; the join that follows is exact."""
    low = (1 << MARK_BITS) - 1
    marked = np.zeros(1 << MARK_BITS, dtype=bool)
    marked[[r[0] for r in vertices.select(F.col("v").bitwiseAND(F.lit(low))).distinct().collect()]] = True
    shared = sets.sparkSession.sparkContext.broadcast(np.packbits(marked))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        marks = np.unpackbits(shared.value).astype(bool)
        for batch in batches:
            yield batch.filter(pa.array(marks[batch.column(0).to_numpy() & low]))
        give_back()

    found = sets.where("shingles IS NOT NULL").select("v", "shingles").mapInArrow(run, "v long, shingles binary")
    return found.join(vertices, "v", "left_semi").dropDuplicates(["v"])


def _vertices(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.explode(F.array("a", "b")).alias("v")).distinct()


def _verified(sets: DataFrame, percent: int, pairs: DataFrame) -> DataFrame:
    """The pairs (a, b) that reach the threshold: suffix filter (the n-grams
    in each of SUFFIX_PARTS parts of the hash space can differ no more than
    the sets may), then the sets themselves."""
    facts = sets.where("shingles IS NOT NULL").select("v", "size", "parts").join(_vertices(pairs), "v", "left_semi").dropDuplicates(["v"])
    with_parts = pairs.join(facts.toDF("a", "size_a", "parts_a"), "a").join(facts.toDF("b", "size_b", "parts_b"), "b")
    left = stored(with_parts.where(_suffix_fits(percent)).select("a", "b"), "close")
    whole = stored(_whole_sets(sets, _vertices(left)), "whole")  # goes once the links are written
    both = left.join(whole.toDF("b", "set_b"), "b").join(whole.toDF("a", "set_a"), "a")

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for at in range(0, batch.num_rows, 256):
                some = batch.slice(at, 256)
                for x, y in zip(some.column(2).to_pylist(), some.column(3).to_pylist()):
                    x, y = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
                    common = len(np.intersect1d(x, y, assume_unique=True))
                    keep.append(100 * common >= percent * (len(x) + len(y) - common))
            yield pa.RecordBatch.from_arrays(list(batch.columns[:2]), ["a", "b"]).filter(pa.array(keep, pa.bool_()))
        give_back()

    links_ = stored(both.select("a", "b", "set_a", "set_b").mapInArrow(verify, "a long, b long"), "links")
    forget(left)
    forget(whole)
    return links_


def _suffix_fits(percent: int) -> F.Column:
    apart = F.aggregate(F.zip_with("parts_a", "parts_b", lambda x, y: F.abs(x - y)), F.lit(0), lambda s, x: s + x)
    return apart * (100 + percent) <= (100 - percent) * (F.col("size_a") + F.col("size_b"))


def _possible(pairs: DataFrame, percent: int) -> DataFrame:
    """Length and positional filters on (size_a, pos_a, size_b, pos_b), and
    where the parts are there the suffix filter; then each pair once, smaller
    vertex first.

    At the first n-gram that two sets share, in the one order of all n-grams,
    none before it is common: a pair that reaches the threshold passes there,
    whether or not it passes at its other shared n-grams."""
    shorter, longer = F.least("size_a", "size_b"), F.greatest("size_a", "size_b")
    most = F.least(F.col("size_a") - F.col("pos_a"), F.col("size_b") - F.col("pos_b"))
    fits = (percent * longer <= 100 * shorter) & (
        (100 + percent) * most >= percent * (F.col("size_a") + F.col("size_b")))
    if "parts_a" in pairs.columns:
        fits &= _suffix_fits(percent)
    return pairs.where(fits).select(
        F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).where("a <> b").distinct()


def _grouped(documents: DataFrame, n: int, percent: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(sets, rows, groups): the sets of ``_sets``; per document doc_id,
    text_hash, size and class v; and (token, v, size, pos) of the prefix
    n-grams that more than one class has."""
    sets = stored(_sets(documents, n), "sets")
    rows = stored(sets.where("slice IS NULL").select("doc_id", "text_hash", "size", "v"), "rows")
    prefixes = stored(_prefixes(sets, percent, _frequencies(sets)), "prefixes")
    # written first: a side that is still being grouped by the key forbids Spark to split a hot key
    shared = stored(prefixes.groupBy("token").agg(F.min("v").alias("lo"), F.max("v").alias("hi")).where("lo <> hi").select(
        "token"), "shared")
    groups = stored(prefixes.join(shared, "token").dropDuplicates(["token", "v"]), "groups")
    forget(prefixes)
    forget(shared)
    return sets, rows, groups


def all_links(documents: DataFrame, n: int, percent: int) -> tuple[DataFrame, DataFrame]:
    """(rows, found): per document doc_id, text_hash, size and class v; and
    every link (a, b), a < b, between classes.

    A group is dealt to blocks of about BLOCK_ROWS members, and each two
    blocks of it meet under a key of their own."""
    sets, rows, groups = _grouped(documents, n, percent)
    facts = sets.where("shingles IS NOT NULL").select("v", "parts").dropDuplicates(["v"])
    counted = groups.groupBy("token").agg(F.ceil(F.count("*") / BLOCK_ROWS).cast("long").alias("blocks"))
    dealt = stored(groups.join(counted, "token").join(facts, "v").withColumn(
        "block", F.pmod(F.xxhash64("v"), F.col("blocks"))), "dealt")
    each = F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1))
    columns = ["token", "v", "size", "pos", "parts", "block"]
    x = dealt.select(*columns, each.alias("other")).toDF("t", "a", "size_a", "pos_a", "parts_a", "i", "j")
    y = dealt.select(*columns, each.alias("other")).toDF("u", "b", "size_b", "pos_b", "parts_b", "l", "k")
    pairs = x.join(y, (F.col("t") == F.col("u")) & (F.col("i") == F.col("k")) & (F.col("j") == F.col("l"))
                   & (F.col("a") < F.col("b")))
    found = _verified(sets, percent, stored(_possible(pairs, percent), "pairs"))
    for used in (sets, groups, dealt):
        forget(used)
    return rows, found


def link_counts(documents: DataFrame, n: int = 4, percent: int = 85) -> DataFrame:
    """doc_id, text_hash and n_links of every row: the number of other rows
    whose set is equal or reaches the threshold.  Rows without words have none."""
    rows, found = all_links(documents, n, percent)
    of_class = stored(rows.where("v IS NOT NULL").groupBy("v").count(), "classes")
    ends = found.unionAll(found.select(F.col("b").alias("a"), F.col("a").alias("b")))
    linked = ends.join(of_class.toDF("b", "n"), "b").groupBy(F.col("a").alias("v")).agg(F.sum("n").alias("n"))
    per_class = of_class.join(linked, "v", "left").select(
        "v", (F.col("count") - 1 + F.coalesce("n", F.lit(0))).alias("n_links"))
    return rows.join(per_class, "v", "left").select(
        "doc_id", "text_hash", F.coalesce("n_links", F.lit(0)).alias("n_links"))


def links(documents: DataFrame, n: int, percent: int) -> tuple[DataFrame, DataFrame]:
    """(rows, found): per document doc_id, text_hash, size and class v; and
    links (a, b) between classes that connect all that are connected, not all
    links (those: ``all_links``)."""
    sets, rows, groups = _grouped(documents, n, percent)

    # one pivot in each group: the member with the fewest rarer n-grams, as it
    # differs least from its near copies; among equals the same one for groups
    # of one residue, so that groups with the same members ask for the same pairs
    rank = F.xxhash64("v", F.pmod("token", F.lit(PIVOTS)))
    pivots = groups.groupBy("token").agg(F.min(F.struct("pos", rank.alias("r"), "v", "size")).alias("p")).select(
        "token", F.col("p.v").alias("a"), F.col("p.size").alias("size_a"), F.col("p.pos").alias("pos_a"))
    members = groups.toDF("token", "b", "size_b", "pos_b")
    first = stored(_possible(members.join(pivots, "token"), percent), "pairs")
    found = _verified(sets, percent, first)

    # what is left: pairs of one group in different components
    roots = stored(components(found), "roots")
    rooted = groups.join(roots, "v", "left").withColumn("root", F.coalesce("root", "v"))
    apart = rooted.groupBy("token").agg(F.min("root").alias("lo"), F.max("root").alias("hi")).where("lo <> hi")
    open_groups = rooted.join(apart.select("token"), "token")
    facts = sets.where("shingles IS NOT NULL").select("v", "parts").join(open_groups.select("v"), "v", "left_semi").dropDuplicates(["v"])
    open_groups = stored(open_groups.join(facts, "v"), "open")
    x = open_groups.toDF("a", "token", "size_a", "pos_a", "root_a", "parts_a").alias("x")
    y = open_groups.toDF("b", "token", "size_b", "pos_b", "root_b", "parts_b").alias("y")
    pairs = x.join(y, (F.col("x.token") == F.col("y.token")) & (F.col("a") < F.col("b"))
                   & (F.col("root_a") != F.col("root_b")))
    second = stored(_possible(pairs, percent).join(first, ["a", "b"], "left_anti"), "pairs")
    found = found.unionAll(_verified(sets, percent, second))
    for used in (sets, groups, open_groups, first, second):
        forget(used)
    return rows, found


def near_groups(documents: DataFrame, n: int = 5, percent: int = 80) -> DataFrame:
    """doc_id, text_hash, size (of the set), component_id and chosen.

    component_id is the smallest doc_id of the texts reachable by links
    (Jaccard of the n-gram sets at least percent / 100); null ids count only
    where a group has no other.  Documents without words are linked with
    nothing.  ``chosen`` marks the rows of one (doc_id, text) of each group,
    and every document without words.  Repeated rows keep their number.
    """
    rows, found = links(documents, n, percent)
    roots = components(found)
    key = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_hash")
    classes = rows.where("v IS NOT NULL").groupBy("v").agg(F.min(key).alias("least"))
    rooted = stored(classes.join(roots, "v", "left").withColumn("root", F.coalesce("root", "v")), "classes")
    least = rooted.groupBy("root").agg(F.min("least").alias("first"))
    of_class = rooted.select("v", "root").join(least, "root").select("v", "first")
    chosen = F.col("doc_id").eqNullSafe(F.col("first.doc_id")) & (F.col("text_hash") == F.col("first.text_hash"))
    return rows.join(of_class, "v", "left").select(
        "doc_id", "text_hash", "size",
        F.when(F.col("v").isNull(), F.col("doc_id")).otherwise(F.col("first.doc_id")).alias("component_id"),
        F.when(F.col("v").isNull(), True).otherwise(chosen).alias("chosen"))


def join_digest(documents: DataFrame) -> DataFrame:
    return near_groups(documents.select("doc_id", "text"), 4, 85).select(
        "doc_id", F.col("size").alias("n_shingles"), "component_id")


def one_of_each_group(documents: DataFrame, n: int = 5, percent: int = 80) -> DataFrame:
    """Documents, one of each group of near copies, whole rows; those without
    words stay.  Of rows equal in id and text the least by all columns stays, so
    reruns agree.  No rows give no rows."""
    decided = near_groups(documents.select("doc_id", "text"), n, percent).where("chosen AND size > 0")
    keep = decided.select(F.col("doc_id").isNull().alias("__none"), F.coalesce("doc_id", F.lit(0)).alias("__id"),
                          F.col("text_hash").alias("__hash")).distinct()
    # rows equal in id and text are merged before the one shuffle of whole rows, which the join shares
    number = F.col("doc_id").cast("long")
    row = F.struct(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(documents.columns)])
    texts = documents.select(number.isNull().alias("__none"), F.coalesce(number, F.lit(0)).alias("__id"),
                             F.xxhash64("text").alias("__hash"), row.alias("__row")).groupBy("__none", "__id", "__hash").agg(
        F.min("__row").alias("__row")).join(keep, ["__none", "__id", "__hash"], "left_semi").select(
        *[F.col(f"__row.c{i}").alias(c) for i, c in enumerate(documents.columns)])
    wordless = documents.where(~F.coalesce(F.col("text").rlike(r"[^\x20\x09-\x0D]"), F.lit(False)))
    return texts.unionAll(wordless)
