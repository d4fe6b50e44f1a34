"""Removal of repeated word spans by compaction of a de Bruijn graph.

A word k-mer is an edge from its first k - 1 words to its last k - 1.  Only
edges that occur more than once matter.  An occurrence can only repeat if its
minimizer does (the least hash of the shorter m-mers inside it: equal k-mers
have equal minimizers), so minimizers are counted first and edges are made for
the rest only; that leaves out no repeated edge.

A repeated edge branches on a side where its occurrences have different
neighbour words, the start and end of a document counting as neighbours.
Maximal runs without a branch are the compacted paths: every document that
has one edge of a path has all of it, so a path is known by its first edge.
The occurrences of a path are compared by their source coordinates (document,
start), length and the hashes of all their edges; all but the first go.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import chain, compress

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from civgraph.llm.common import forget, stored

K, M = 20, 8
CACHE_WORDS = 150_000
POSITION_BITS = 24
_ODD = 0x9E3779B97F4A7C15


class _Known(dict):
    """64-bit hashes of words, each computed when first asked for."""

    def __missing__(self, word: bytes) -> int:
        found = self[word] = xxhash.xxh3_64_intdigest(word)
        return found


class WordHashes:
    """64-bit hashes of the words of whole texts, one text after the other, and
    where each text starts; the cache is bounded."""

    def __init__(self) -> None:
        self.known = _Known()

    def __call__(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        if len(self.known) > CACHE_WORDS:
            self.known.clear()
        words = [(text or "").encode("utf-8", "surrogatepass").split() for text in texts]
        starts = np.append(0, np.cumsum([len(w) for w in words]))
        return np.fromiter(map(self.known.__getitem__, chain.from_iterable(words)), dtype=np.uint64,
                           count=int(starts[-1])), starts


def _grams(words: np.ndarray, n: int, seed: int) -> np.ndarray:
    """Hashes of all runs of n words."""
    count = len(words) - n + 1
    h = np.full(max(0, count), seed, dtype=np.uint64)
    for i in range(n if count > 0 else 0):
        h ^= words[i:count + i]
        h *= np.uint64(_ODD)
        h ^= h >> np.uint64(29)
    return h


def _minimizers(words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The hashes of all m-mers, and for every k-mer the position of its
    minimizer: the leftmost of those whose hash is least in its upper bits."""
    grams, width = _grams(words, M, 1), K - M + 1
    if len(words) < K:
        return grams, np.zeros(0, dtype=np.int64)
    low = np.uint64((1 << POSITION_BITS) - 1)
    if len(grams) > int(low):
        views = np.lib.stride_tricks.sliding_window_view(grams & ~low, width)
        return grams, views.argmin(axis=1) + np.arange(len(views))
    least = (grams & ~low) | np.arange(len(grams), dtype=np.uint64)  # so the least one tells its position
    span = 1
    while 2 * span <= width:
        least, span = np.minimum(least[:-span], least[span:]), 2 * span
    if span < width:
        least = np.minimum(least[:span - width], least[width - span:])
    return grams, (least & low).astype(np.int64)


def _text_minimizers(words: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, ...]:
    """For texts joined: the hashes of all m-mers, the positions of the k-mers
    that lie in one text, their minimizers', and where the minimizer is a new
    one (neighbours share minimizers, whose places only grow)."""
    grams, places = _minimizers(words)
    inside = np.ones(len(places), dtype=bool)
    for end in np.unique(starts[1:-1]).tolist():  # k-mers that go over the end of a text
        inside[max(0, end - K + 1):end] = False
    at = np.flatnonzero(inside)
    places = places[at]
    return grams, at, places, np.append(True, places[1:] != places[:-1])[:len(places)]


def _slices(batch: pa.RecordBatch, rows: int = 64, size: int = 1 << 20) -> Iterator[pa.RecordBatch]:
    """Rows that are worked on together: a few, and no more than about ``size`` bytes of text."""
    ends = np.cumsum(pc.fill_null(pc.binary_length(batch.column(0)), 0).to_numpy(zero_copy_only=False))
    at = 0
    while at < batch.num_rows:
        before = ends[at - 1] if at else 0
        n = max(1, min(rows, int(np.searchsorted(ends, before + size, side="right")) - at))
        yield batch.slice(at, n)
        at += n


def _minimizer_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    hashes = WordHashes()
    for batch in batches:
        for some in _slices(batch):
            words, starts = hashes(some.column(0).to_pylist())
            grams, at, places, new = _text_minimizers(words, starts)
            text, m = np.searchsorted(starts, at[new], side="right") - 1, grams[places[new]]
            order = np.lexsort((m, text))
            text, m = text[order], m[order]
            first = np.flatnonzero(np.append(True, (m[1:] != m[:-1]) | (text[1:] != text[:-1]))[:len(m)])
            yield pa.RecordBatch.from_arrays([
                pa.array(m[first].view(np.int64)), pa.array(some.column(1).to_numpy()[text[first]]),
                pa.array(np.diff(np.append(first, len(m))))], ["m", "k", "c"])


def _edge_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    hashes = WordHashes()
    for batch in batches:
        for some in _slices(batch):
            words, starts = hashes(some.column(0).to_pylist())
            grams, at, places, new = _text_minimizers(words, starts)
            # a text's minimizer that repeats is listed with each text that has it
            repeated = some.column(3).flatten().to_numpy().view(np.uint64)
            pos = at[np.isin(grams[places[new]], repeated)[np.cumsum(new) - 1]]
            text = np.searchsorted(starts, pos, side="right") - 1
            # a word next to each text's own, -1 for none
            near = np.full(len(words) + 2, -1, dtype=np.int32)
            near[1:-1] = words >> np.uint64(33)
            left, right = near[pos], near[pos + K + 1]
            left[pos == starts[text]] = -1
            right[pos + K == starts[text + 1]] = -1
            yield pa.RecordBatch.from_arrays([
                pa.array(_grams(words, K, 2)[pos].view(np.int64)), pa.array(left), pa.array(right),
                pa.array(some.column(2).to_numpy()[text]), pa.array((pos - starts[text]).astype(np.int32)),
                some.column(1).take(pa.array(text))], ["h", "left", "right", "k", "pos", "doc_id"])


def repeated_spans(documents: DataFrame) -> DataFrame:
    """(k, spans): per document with later occurrences the word ranges that
    repeat earlier ones (0-based, end exclusive, not merged).

    ``documents`` has doc_id, text and k, a hash of both.  Rows equal in id
    and text are one document.  Null ids come last in the order of documents.
    """
    unique = documents.dropDuplicates(["k"])
    minimizers = stored(documents.select("text", "k").mapInArrow(_minimizer_rows, "m long, k long, c long"), "minimizers")
    # written first, so that the join's hot keys are split: a side that is still being grouped by the key forbids it
    again = stored(minimizers.groupBy("m").agg(F.min("k").alias("lo"), F.max("k").alias("hi"), F.max("c").alias("c")).where(
        "lo <> hi OR c > 1").select("m"), "again")
    marks = stored(minimizers.join(again, "m").groupBy("k").agg(F.collect_set("m").alias("ms")), "marks")
    forget(minimizers)

    edges = stored(unique.join(marks, "k").select("text", "doc_id", "k", "ms").mapInArrow(
        _edge_rows, "h long, left int, right int, k long, pos int, doc_id long"), "edges")
    graph = stored(edges.groupBy("h").agg(
        F.count("*").alias("n"), (F.min("left") != F.max("left")).alias("forks"),
        (F.min("right") != F.max("right")).alias("splits")).where("n > 1"), "graph")
    walks = stored(edges.select("h", "k", "pos", "doc_id").join(graph.drop("n"), "h"), "walks")
    forget(edges)
    # a path starts where the document's edge before is no repeated one, has
    # another successor elsewhere, or this edge has another predecessor
    along = Window.partitionBy("k").orderBy("pos")
    before = F.lag(F.struct("pos", "splits")).over(along)
    starts = before.isNull() | (before["pos"] != F.col("pos") - 1) | before["splits"] | F.col("forks")
    numbered = walks.withColumn("starts", starts.cast("int")).withColumn("path", F.sum("starts").over(
        along.rowsBetween(Window.unboundedPreceding, 0)))
    paths = stored(numbered.groupBy("k", "path").agg(
        F.min(F.struct("pos", "h")).alias("head"), F.count("*").alias("edges"),
        F.bit_xor("h").alias("check"),
        F.first("doc_id").alias("doc_id")).select(
            "k", F.col("head.pos").alias("pos"), F.col("head.h").alias("h"), "edges", "check", "doc_id"), "paths")
    forget(walks)
    place = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "k", "pos")
    first = stored(paths.groupBy("h", "edges", "check").agg(F.min(place).alias("first")), "first")
    later = paths.join(first, ["h", "edges", "check"]).where(place != F.col("first"))
    return stored(later.groupBy("k").agg(F.collect_list(F.struct(
        F.col("pos").alias("from"), (F.col("pos") + F.col("edges") + K - 1).alias("to"))).alias("spans")), "spans")


def with_spans(documents: DataFrame) -> DataFrame:
    """doc_id, text and spans (null: none) of every row."""
    keyed = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text").withColumn(
        "k", F.xxhash64("doc_id", F.coalesce("text", F.lit(""))))
    return keyed.join(repeated_spans(keyed), "k", "left").select("doc_id", "text", "spans")


def _kept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, 256):
            some, out = batch.slice(at, 256), []
            for text, spans in zip(some.column(1).to_pylist(), some.column(2).to_pylist()):
                words = (text or "").encode("utf-8", "surrogatepass").split()
                kept = words
                if spans:
                    keep = bytearray(b"\x01") * len(words)
                    for s in spans:
                        keep[s["from"]:s["to"]] = bytes(s["to"] - s["from"])
                    kept = list(compress(words, keep))
                out.append((len(words), len(words) - len(kept), b" ".join(kept)))
            n, removed, kept = zip(*out)
            yield pa.RecordBatch.from_arrays([
                some.column(0), pa.array(n, pa.int64()), pa.array(removed, pa.int64()),
                pa.array([k.decode("utf-8", "surrogatepass") for k in kept], pa.string())],
                ["doc_id", "n_words", "n_removed", "kept"])


def without_repeats(documents: DataFrame) -> DataFrame:
    """doc_id, n_words, n_removed and kept, the words that stay joined by one
    space.  Null, empty and short texts lose nothing."""
    return with_spans(documents).mapInArrow(_kept, "doc_id long, n_words long, n_removed long, kept string")


def repeat_digest(documents: DataFrame) -> DataFrame:
    return without_repeats(documents).select(
        "doc_id", "n_words", "n_removed", F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"))
