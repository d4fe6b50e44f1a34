"""Quality classifier: similarity-weighted votes of the nearest labelled
documents in a latent semantic space.

Terms of a text are its words, the shapes of its words (letters, digits and
marks, runs collapsed), both hashed to a fixed number of buckets, and how much
of it repeats (the share of words equal to the one before, that of distinct
words, the order of its length).  The latent
space comes from a truncated SVD of the weighted terms of a bounded sample of
labelled rows.  The sample's latent vectors and the projection are broadcast
(their size is fixed by the parameters below); every whole document is
projected and compared with every labelled vector in exact blocks.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from civgraph.llm.common import give_back

FIT_PER_CLASS = 2000  # bound of the labelled rows that are fitted, for each label
WORD_BUCKETS = 1 << 14
SHAPE_BUCKETS = 1 << 10
SIGNALS = 64
TERMS = WORD_BUCKETS + SHAPE_BUCKETS + SIGNALS
RANK = 48
NEIGHBOURS = 15
SHARPNESS = 8  # votes weigh similarity to this power
BLOCK = 256  # documents compared at a time
CACHE_WORDS = 100_000
CACHE_CHARS = 8_000_000  # of the words in the cache
_LOWER, _UPPER = re.compile("[a-zß-ÿ]+"), re.compile("[A-ZÀ-Þ]+")
_DIGITS, _MARKS = re.compile("[0-9]+"), re.compile(r"([^\w])\1+")


def _term_ids(word: str) -> tuple[int, int]:
    shape = _MARKS.sub(r"\1\1", _DIGITS.sub("9", _LOWER.sub("a", _UPPER.sub("A", word))))
    return (zlib.crc32(word.lower().encode()) % WORD_BUCKETS,
            WORD_BUCKETS + zlib.crc32(shape.encode()) % SHAPE_BUCKETS)


class _Terms(dict):
    """Both terms of a word in one number, found when first asked for."""

    chars = 0

    def __missing__(self, word: str) -> int:
        of_word, of_shape = _term_ids(word)
        self.chars += len(word)
        found = self[word] = of_word << 32 | of_shape
        return found


class TermCounter:
    """Hashed term counts of whole texts; the word cache is bounded."""

    def __init__(self) -> None:
        self.known = _Terms()

    def __call__(self, text: str | None) -> tuple[np.ndarray, np.ndarray]:
        words = (text or "").split()
        if len(self.known) > CACHE_WORDS or self.known.chars > CACHE_CHARS:
            self.known = _Terms()
        both = np.fromiter(map(self.known.__getitem__, words), dtype=np.int64, count=len(words))
        first, distinct = both >> 32, len(set(words))
        ids, counts = np.unique(np.concatenate([first, both & 0xFFFFFFFF]), return_counts=True)
        if not words:
            return ids, counts
        repeats = int((first[1:] == first[:-1]).sum())
        signals = np.array([20 * repeats // len(words), 21 + 20 * distinct // len(words),
                            42 + min(21, len(words).bit_length())]) + WORD_BUCKETS + SHAPE_BUCKETS
        return np.append(ids, signals), np.append(counts, [1, 1, 1])


def _weighted(ids: np.ndarray, counts: np.ndarray, idf: np.ndarray) -> np.ndarray:
    """Log counts times idf; words, shapes and signals have the same total weight."""
    w = np.log1p(counts) * idf[ids]
    first, second = np.searchsorted(ids, [WORD_BUCKETS, WORD_BUCKETS + SHAPE_BUCKETS])
    for part in (w[:first], w[first:second], w[second:]):
        norm = np.sqrt((part * part).sum())
        if norm > 0:
            part /= norm
    return w


@dataclass
class Model:
    idf: np.ndarray
    projection: np.ndarray  # terms x RANK
    vectors: np.ndarray  # labelled rows x RANK, unit length
    labels: np.ndarray
    weights: np.ndarray  # of a row's vote: how many labelled rows it stands for
    prior: float

    def latent(self, ids: np.ndarray, counts: np.ndarray) -> np.ndarray:
        v = _weighted(ids, counts, self.idf) @ self.projection[ids]
        norm = np.sqrt(v @ v)
        return v / norm if norm > 0 else v

    def scores(self, latent: np.ndarray) -> np.ndarray:
        """Vote of the nearest labelled rows; the prior where none is similar."""
        if not len(self.labels):
            return np.full(len(latent), self.prior)
        k = min(NEIGHBOURS, len(self.labels))
        sim = latent @ self.vectors.T
        near = np.argpartition(-sim, k - 1, axis=1)[:, :k]
        w = np.clip(np.take_along_axis(sim, near, axis=1), 0, 1) ** SHARPNESS * self.weights[near]
        total = w.sum(axis=1)
        vote = (w * self.labels[near]).sum(axis=1)
        return np.where(total > 1e-12, vote / np.maximum(total, 1e-12), self.prior)


def _latent_space(rows: list[tuple[np.ndarray, np.ndarray]], rank: int) -> np.ndarray:
    """Right singular vectors of sparse rows by randomised subspace iteration."""
    rng = np.random.default_rng(7)
    basis = rng.standard_normal((TERMS, rank + 8)).astype(np.float32)
    for _ in range(4):
        basis, _ = np.linalg.qr(basis)
        image = np.zeros_like(basis)
        for ids, w in rows:
            image[ids] += np.outer(w, w @ basis[ids])
        basis = image
    left, _, _ = np.linalg.svd(basis, full_matrices=False)
    return np.ascontiguousarray(left[:, :rank], dtype=np.float32)


def fit_rows(documents: DataFrame, labels: DataFrame, per_class: int = FIT_PER_CLASS) -> DataFrame:
    """At most ``per_class`` labelled documents of each label, those of the
    lowest id hashes; a document labelled both ways has the rounded mean."""
    clean = labels.where("quality IS NOT NULL AND doc_id IS NOT NULL").groupBy(
        F.col("doc_id").alias("__id")).agg(F.round(F.avg("quality")).cast("int").alias("label"))
    order = [F.xxhash64("__id"), "__id"]
    picked = clean.where("label = 0").orderBy(*order).limit(per_class).unionAll(
        clean.where("label = 1").orderBy(*order).limit(per_class))
    return documents.join(F.broadcast(picked), F.col("doc_id") == F.col("__id")).select("doc_id", "text", "label")


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    count = TermCounter()
    for batch in batches:
        terms = [count(t) for t in batch.column(1).to_pylist()]
        yield pa.RecordBatch.from_arrays([
            batch.column(0), batch.column(2).cast(pa.int32()),
            pa.array([i.astype("<i4").tobytes() for i, _ in terms], pa.binary()),
            pa.array([c.astype("<i4").tobytes() for _, c in terms], pa.binary())],
            ["doc_id", "label", "ids", "counts"])


def fit(documents: DataFrame, labels: DataFrame, per_class: int = FIT_PER_CLASS) -> Model:
    """Learn from the given label rows only; the driver gets the term counts
    of the bounded sample."""
    prior = labels.agg(F.avg("quality")).first()[0]
    prior = 0.5 if prior is None else float(prior)
    sample = fit_rows(documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), labels, per_class)
    # repeated ids in the documents: as many rows are kept as were picked
    found = sample.mapInArrow(_counted, "doc_id long, label int, ids binary, counts binary")
    rows = sorted(found.orderBy(F.xxhash64("doc_id"), "doc_id", F.md5("ids")).limit(2 * per_class).collect(),
                  key=lambda r: (r.doc_id, r.ids))
    terms = [(np.frombuffer(r.ids, "<i4"), np.frombuffer(r.counts, "<i4")) for r in rows]
    df = np.zeros(TERMS)
    for ids, _ in terms:
        df[ids] += 1
    idf = np.log((len(rows) + 1) / (df + 1)).astype(np.float32) + 0.1
    weighted = [(ids, _weighted(ids, c, idf).astype(np.float32)) for ids, c in terms]
    projection = _latent_space(weighted, RANK) if rows else np.zeros((TERMS, RANK), np.float32)
    marks = np.array([r.label for r in rows], dtype=float)
    good = marks.mean() if rows else 0.5
    weights = np.where(marks == 1, prior / max(good, 1e-9), (1 - prior) / max(1 - good, 1e-9))
    model = Model(idf, projection, np.zeros((0, RANK), np.float32), marks, weights, prior)
    if rows:
        model.vectors = np.array([model.latent(i, c) for i, c in terms], dtype=np.float32)
    return model


def scorer(spark: SparkSession, model: Model) -> Callable[[Column], Column]:
    """The score of a text column.  The model is broadcast as plain arrays
    (its size is fixed by the parameters above), so that executors need no
    copy of this package; only the texts pass Python."""
    shared = spark.sparkContext.broadcast(vars(model))

    def scored(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        count, m = TermCounter(), Model(**shared.value)
        for texts in batches:
            out = [np.zeros(0)]
            for at in range(0, len(texts), BLOCK):  # so that few texts are Python strings at a time
                latent = [m.latent(*count(t)) for t in texts.slice(at, BLOCK).to_pylist()]
                out.append(m.scores(np.array(latent, dtype=np.float32)))
            yield pa.array(np.round(np.concatenate(out), 6), pa.float64())
        give_back()

    return F.arrow_udf(scored, "double")


def score(documents: DataFrame, model: Model) -> DataFrame:
    """doc_id and score of every document.

    Null and empty texts have no term and get the prior, the mean of the
    training labels.  Rows with null or repeated ids are scored like others;
    other columns are not read; no rows give no rows.
    """
    score_of = scorer(documents.sparkSession, model)
    return documents.select(F.col("doc_id").cast("long").alias("doc_id"), score_of(F.col("text")).alias("score"))


def held_out(doc_id) -> F.Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def quality_digest(documents: DataFrame, labels: DataFrame) -> DataFrame:
    model = fit(documents, labels.where(~held_out(F.col("doc_id"))))
    return score(documents, model).select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"))


def good_documents(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """Documents that the classifier does not reject, whole rows, whatever
    their other columns are called; no rows give no rows."""
    model = fit(documents, labels.where(~held_out(F.col("doc_id"))))
    score_of = scorer(documents.sparkSession, model)
    return documents.where(score_of(F.col("text")) >= 0.5)
