"""Benchmark decontamination with a hash set of normalised n-grams.

Words are runs of ASCII letters (lower-cased), digits and all characters
beyond ASCII.  A window is ``n`` consecutive words of a benchmark item; an
item of fewer words, but not none, is one window.  The window hashes of the
items are broadcast while their size is proven small, else joined by shuffle;
every document window looks itself up and a hit is verified word by word.

Words are hashed once and windows by the hashes of their words.  A table of
marks for the first and last word of the items' windows rules most document
windows out inside their row; only those left become rows, each with its own words.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from civgraph.llm.common import ascii_lower, set_apart, stored

# Fixed value: characters between words, after lower-casing
GAP = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]++"
N = 13
BROADCAST_WINDOWS = 500_000  # rows of (hash, length, words, items): some 100 MB
MARK_SLOTS = 1 << 20  # at least; 16 for a window, so at most 1 MB of bits
RESULTS = ("n_words", "n_hit", "spans", "items", "contaminated")


def words(text: Column) -> Column:
    """Array of words; null and wordless texts give an empty array."""
    text = F.coalesce(text, F.lit(""))
    # in a text of ASCII only, all letters are A-Z
    low = F.when(F.octet_length(text) == F.length(text), F.lower(text)).otherwise(ascii_lower(text))
    parts = F.split(low, GAP)
    return F.filter(parts, lambda w: w != "")


def item_windows(benchmark: DataFrame, n: int = N) -> DataFrame:
    """Distinct windows of all items: length, hash, words and the items."""
    items = benchmark.select("item_id", words(F.col("text")).alias("w")).where(F.size("w") > 0)
    length = F.least(F.size("w"), F.lit(n))
    starts = F.sequence(F.lit(1), F.size("w") - length + 1)
    windows = items.select("item_id", "w", length.alias("len"), F.explode(starts).alias("at")).select(
        "item_id", "len", F.slice("w", F.col("at"), F.col("len")).alias("window"))
    return windows.groupBy("len", "window").agg(F.collect_set("item_id").alias("items")).select(
        "len", F.xxhash64(word_hashes("window")).alias("hash"), "window", "items")


def word_hashes(words_: Column | str) -> Column:
    return F.transform(words_, lambda w: F.xxhash64(w))


def ends_hash(first: Column, last: Column) -> Column:
    """Of the hashes of a window's first and last word."""
    return first.bitwiseXOR(F.shiftrightunsigned(last, 1))


def marks(windows: DataFrame, rows: int) -> tuple[int, Column]:
    """Slots, a power of two, and a bit for each: 1 if a window's ends fall on
    it.  The bits are an array of 64 each, got by a subquery: a literal's value
    would stand in every text that the driver makes of the plan."""
    slots = max(MARK_SLOTS, 1 << (16 * rows).bit_length())
    bits = np.zeros(slots >> 6, dtype=np.uint64)
    ends = ends_hash(F.xxhash64(F.get("window", F.lit(0))), F.xxhash64(F.element_at("window", -1)))
    for r in windows.select(ends.bitwiseAND(F.lit(slots - 1)).alias("slot")).distinct().collect():
        bits[r.slot >> 6] |= np.uint64(1 << (r.slot & 63))
    made = pa.table({"marked": pa.array([bits.view(np.int64)], pa.list_(pa.int64()))})
    return slots, windows.sparkSession.createDataFrame(made).scalar()


def is_marked(marked: Column, slot: Column) -> Column:
    some = F.get(marked, F.shiftright(slot, 6).cast("int"))
    return F.call_function("shiftright", some, slot.bitwiseAND(F.lit(63)).cast("int")).bitwiseAND(F.lit(1)) == 1


def _keyed(documents: DataFrame) -> DataFrame:
    return documents.withColumn("__id", F.col("doc_id")).withColumn("__text_hash", F.xxhash64(F.coalesce("text", F.lit(""))))


def scanned(documents: DataFrame, windows: DataFrame) -> DataFrame:
    """Written: per row of ``documents`` (__id, __text_hash, text) its number
    of words and ``left``, the windows that the marks do not rule out, with their words.

    A document is scanned once per window length that occurs among the items
    (at most ``n`` lengths)."""
    lengths = sorted(r[0] for r in windows.select("len").distinct().collect())
    rows, passes = windows.count(), lambda h: F.lit(True)
    if rows <= BROADCAST_WINDOWS:
        slots, marked = marks(windows, rows)
        # a column of its own, as functions of lambdas take no subquery
        documents = documents.withColumn("__marks", marked)
        passes = lambda h: is_marked(F.col("__marks"), h.bitwiseAND(F.lit(slots - 1)))
    empty = F.array().cast("array<struct<len:int,at:int,h:bigint,mine:array<string>>>")

    def left(w: Column, wh: Column) -> Column:
        def of(length):
            starts = F.sequence(F.lit(0), F.size(w) - length)
            possible = F.filter(starts, lambda at: passes(ends_hash(F.get(wh, at), F.get(wh, at + (length - 1)))))
            return F.when(F.size(w) >= length, F.transform(possible, lambda at: F.struct(
                F.lit(length).alias("len"), (at + 1).alias("at"), F.xxhash64(F.slice(wh, at + 1, length)).alias("h"),
                F.slice(w, at + 1, length).alias("mine")))).otherwise(empty)

        return F.concat(empty, *map(of, lengths))

    # words and their hashes as lambda variables: made once per text, not per window
    found = _let(words(F.col("text")), lambda w: F.struct(
        F.size(w).cast("long").alias("n_words"), _let(word_hashes(w), lambda wh: left(w, wh)).alias("left")))
    rows_ = documents.select("__id", "__text_hash", found.alias("found"))
    return stored(rows_.select("__id", "__text_hash", "found.n_words", "found.left"), "scanned")


def _let(value: Column, body) -> Column:
    return F.get(F.transform(F.array(value), body), F.lit(0))


def hits(scan: DataFrame, windows: DataFrame) -> DataFrame:
    """Verified occurrences: row key, n_words, start (1-based word), len, items."""
    table = windows.withColumnRenamed("hash", "h")
    if windows.count() <= BROADCAST_WINDOWS:
        table = F.broadcast(table)
    looked = scan.select("__id", "__text_hash", "n_words", F.explode("left").alias("k")).select(
        "__id", "__text_hash", "n_words", "k.*")
    found = looked.join(table, ["len", "h"])
    return found.where(F.col("mine") == F.col("window")).select("__id", "__text_hash", "n_words", "at", "len", "items")


_NO_SPANS = "array<struct<from:int,to:int>>"


def hit_documents(found: DataFrame) -> DataFrame:
    """Written: per document with a hit its key, n_words, n_hit, spans and items."""
    # one row per document: its hit starts, at most one per word and length
    by_doc = found.groupBy("__id", "__text_hash").agg(
        F.max("n_words").alias("n_words"), F.array_sort(F.collect_set(F.struct("at", "len"))).alias("at"),
        F.collect_set("items").alias("item_sets"))
    empty = F.array().cast(_NO_SPANS)

    # spans are gathered through a running (open span, closed spans) pair, the
    # number of closed ones staying small as neighbours merge
    def merge(acc, h):
        to = h["at"] - 1 + h["len"]
        grows = (acc["to"] >= h["at"] - 1) & (acc["to"] > 0)
        return F.when(grows, F.struct(
            acc["from"].alias("from"), F.greatest(acc["to"], to).alias("to"), acc["done"].alias("done"))).otherwise(
            F.struct((h["at"] - 1).alias("from"), to.alias("to"),
                     F.when(acc["to"] > 0, F.concat(acc["done"], F.array(F.struct(
                         acc["from"].alias("from"), acc["to"].alias("to"))))).otherwise(
                             acc["done"]).alias("done")))

    start = F.struct(F.lit(0).alias("from"), F.lit(0).alias("to"), empty.alias("done"))
    spans = F.aggregate("at", start, merge, lambda a: F.concat(
        a["done"], F.array(F.struct(a["from"].alias("from"), a["to"].alias("to")))))
    n_hit = F.aggregate("spans", F.lit(0).cast("long"), lambda a, s: a + s["to"] - s["from"])
    items = F.array_sort(F.array_distinct(F.transform(F.flatten("item_sets"), lambda i: i.cast("string"))))
    # written, so that a document that is there very often can be split in the join
    return stored(by_doc.select(
        F.col("__id").alias("__hit_id"), F.col("__text_hash").alias("__hit_text"), F.col("n_words").alias("__n_words"),
        spans.alias("spans"), items.alias("items")).withColumn("__n_hit", n_hit), "hits")


def with_hits(rows: DataFrame, found: DataFrame, n_words: Column, percent: int) -> DataFrame:
    """``rows`` (with __id and __text_hash, which go) plus the results."""
    joined = rows.join(found, F.col("__id").eqNullSafe(F.col("__hit_id"))
                       & (F.col("__text_hash") == F.col("__hit_text")), "left")
    n_hit = F.coalesce("__n_hit", F.lit(0).cast("long"))
    contaminated = F.coalesce((F.col("__n_hit") > 0) & (100 * F.col("__n_hit") >= percent * F.col("__n_words")), F.lit(False))
    return (joined.withColumn("n_words", F.coalesce("__n_words", n_words))
            .withColumn("spans", F.coalesce("spans", F.array().cast(_NO_SPANS)))
            .withColumn("items", F.coalesce("items", F.array().cast("array<string>")))
            .withColumn("n_hit", n_hit).withColumn("contaminated", contaminated)
            .drop("__id", "__text_hash", "__hit_id", "__hit_text", "__n_words", "__n_hit"))


def contamination(documents: DataFrame, benchmark: DataFrame, n: int = N, percent: int = 5) -> DataFrame:
    """All rows and columns of ``documents`` plus n_words, n_hit, spans
    (merged hit word ranges, 0-based, end exclusive), items (ids of the items
    with occurring windows, as sorted strings) and contaminated
    (n_hit > 0 and 100 * n_hit >= percent * n_words).

    Null texts and ids are ordinary values; rows with one id are told apart by
    their text.  Result names that clash with input columns replace them
    (``clean_documents`` and ``without_spans`` keep those).  An item without an id
    is hit like others but is in no list.  An empty benchmark hits nothing.
    """
    keyed = _keyed(documents.drop(*RESULTS))
    windows = stored(item_windows(benchmark, n), "windows")
    found = hit_documents(hits(scanned(keyed, windows), windows))
    return with_hits(keyed, found, F.size(words(F.col("text"))).cast("long"), percent)


def contamination_digest(documents: DataFrame, benchmark: DataFrame) -> DataFrame:
    windows = stored(item_windows(benchmark), "windows")
    scan = scanned(_keyed(documents.select("doc_id", "text")), windows)
    rows = scan.select("__id", "__text_hash", F.col("__id").alias("doc_id"), F.col("n_words").alias("__words"))
    found = with_hits(rows, hit_documents(hits(scan, windows)), F.col("__words"), 5)
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", "items").cast("binary"), 256).alias("items_sha256"), "contaminated")


def clean_documents(documents: DataFrame, benchmark: DataFrame) -> DataFrame:
    """Documents without the contaminated ones, their columns as they were."""
    inner, back = set_apart(documents, RESULTS)
    return contamination(inner, benchmark).where(~F.col("contaminated")).select(*back)


def without_spans(documents: DataFrame, benchmark: DataFrame) -> DataFrame:
    """Every document, its hit words blanked out: the normalised text that is
    left, words joined by one space.  Documents without a hit and all other
    columns stay untouched."""
    inner, back = set_apart(documents, RESULTS)
    found = contamination(inner, benchmark)
    left = F.filter(words(F.col("text")), lambda w, i: ~F.exists("spans", lambda s: (i >= s["from"]) & (i < s["to"])))
    return found.withColumn("text", F.when(F.col("n_hit") > 0, F.concat_ws(" ", left)).otherwise(
        F.col("text"))).select(*back)
