"""Histogram sort: exact byte-balanced shards with one exchange.

Rows get a 63-bit order key whose high half is a hash of the text, so equal
texts are neighbours, and whose low half is a hash of id and text, so a large
group of copies can still be cut.  The cut keys come from rounds of exact
byte histograms: each round counts the bytes below candidate boundaries in
the key ranges that still hold an unsettled cut, until every cut is within
the tolerance of its target or falls on a single key.  Only then do the rows
move, once, to their piece of a shard.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from civgraph.llm.common import BROADCAST_HASHES, stored, with_copy_numbers

KEY_BITS = 63
HIGH_BITS = 31  # of the key: the hash of the text
ROUND_BITS = 11  # 2,048 candidate boundaries per open range and round


@dataclass
class _Cut:
    target: int
    low: int = 0  # the cut lies at a key in [low, low + 2**bits]
    bits: int = KEY_BITS
    below: int = 0  # exact bytes below ``low``
    key: int | None = None  # settled: rows with a smaller key are below the cut
    bytes: int = 0


def order_key(text: Column, row_id: Column, *more: Column) -> Column:
    """``more`` tells rows apart that are equal in text and id."""
    body = F.coalesce(text, F.lit(""))
    high = F.shiftright(F.xxhash64(body), 33).bitwiseAND(F.lit(0x7FFFFFFF))
    low = F.xxhash64(row_id, body, *more).bitwiseAND(F.lit(0xFFFFFFFF))
    return F.shiftleft(high, 32).bitwiseOR(low)


def _table(spark: SparkSession, rows: list[tuple[int, ...]], names: tuple[str, ...]) -> DataFrame:
    """A few rows of longs, as literals: no Python worker reads them."""
    cells = [F.struct(*[F.lit(v).cast("long").alias(n) for v, n in zip(row, names)]) for row in rows]
    return spark.range(1).select(F.inline(F.array(*cells)))


def byte_cuts(rows: DataFrame, targets: list[int], tolerance: int) -> list[_Cut]:
    """Keys at which the exact bytes below come within ``tolerance`` of each
    target.  ``rows`` has ``__key`` and ``__size``.  Bytes are summed up within
    the open ranges by Spark; the driver sees one boundary per open cut."""
    spark, cuts = rows.sparkSession, [_Cut(t) for t in targets]
    upto = Window.partitionBy("range").orderBy("p").rowsBetween(Window.unboundedPreceding, 0)
    # downwards, so that a target comes after the first boundary that reaches it
    down = Window.partitionBy("range").orderBy(F.desc("value"), F.col("cut").isNotNull()).rowsBetween(
        Window.unboundedPreceding, 0)
    while open_cuts := [c for c in cuts if c.key is None]:
        step = min(ROUND_BITS, max(c.bits for c in open_cuts))
        bits = max(c.bits for c in open_cuts) - step
        wanted = rows
        if bits + step < KEY_BITS:
            ranges = _table(spark, [(r,) for r in {c.low >> (bits + step) for c in open_cuts}], ("r",))
            wanted = rows.join(F.broadcast(ranges), F.shiftright("__key", bits + step) == F.col("r"), "left_semi")
        bins = wanted.groupBy(F.shiftright("__key", bits).alias("p")).agg(F.sum("__size").alias("b")).withColumn(
            "range", F.shiftright("p", step)).withColumn("value", F.sum("b").over(upto))
        asked = _table(spark, [(c.low >> (bits + step), c.target - c.below, i) for i, c in enumerate(open_cuts)],
                       ("range", "value", "cut"))
        line = bins.select("range", "value", F.struct("p", "b", "value").alias("bin")).unionByName(
            asked, allowMissingColumns=True)
        found = {r.cut: r.bin for r in line.withColumn("bin", F.last("bin", ignorenulls=True).over(down)).where(
            "cut IS NOT NULL").select("cut", "bin").collect()}
        for i, c in enumerate(open_cuts):
            if found[i]:
                p, b, below = found[i].p, found[i].b, c.below + found[i].value - found[i].b
            else:
                p, b, below = ((c.low >> (bits + step)) + 1 << step) - 1, 0, c.below
            c.low, c.bits, c.below = p << bits, bits, below
            left, right = c.target - below, below + b - c.target
            if min(abs(left), abs(right)) <= tolerance or bits == 0:
                near_low = abs(left) <= abs(right)
                c.key = c.low if near_low else c.low + (1 << bits)
                c.bytes = below if near_low else below + b
    return cuts


def with_pieces(rows: DataFrame, narrow: DataFrame, total: int, piece_bytes: int) -> DataFrame:
    """``rows`` with ``__piece``: the lowest key of the piece that their key
    lies in.  Pieces are ranges of keys of about ``piece_bytes``.

    Keys spread evenly over buckets of their upper bits but for texts that are
    there very often.  Buckets of more than four pieces, which are counted
    exactly, are told apart by as many further bits as cut their copies up."""
    bits = max(0, min(HIGH_BITS, (total // piece_bytes).bit_length()))
    bucket = F.shiftright("__key", KEY_BITS - bits)
    heavy = stored(narrow.groupBy(bucket.alias("__bucket")).agg(F.sum("__size").alias("b")).where(
        F.col("b") > 4 * piece_bytes).select("__bucket", F.least(F.lit(KEY_BITS - bits), F.lit(HIGH_BITS - bits) + F.ceil(
            F.log2(F.col("b") / piece_bytes))).cast("int").alias("__more")), "heavy")
    # at most one row per four pieces of input
    heavy = F.broadcast(heavy) if heavy.count() <= BROADCAST_HASHES else heavy
    shift = F.lit(KEY_BITS - bits) - F.coalesce("__more", F.lit(0))
    low = F.expr("shiftleft(shiftright(__key, __shift), __shift)")
    return rows.withColumn("__bucket", bucket).join(heavy, "__bucket", "left").withColumn("__shift", shift).withColumn(
        "__piece", low).drop("__bucket", "__more", "__shift")


def with_shards(df: DataFrame, shards: int, text: str = "text", row_id: str = "doc_id",
                tolerance: float = 0.001, piece_bytes: int = 4 << 20) -> DataFrame:
    """All rows and columns of ``df`` plus ``shard`` (0 to shards - 1, near
    equal bytes) and ``slot`` (gapless from 0 in each shard, in key order).

    A row weighs the UTF-8 bytes of its text (null: none) plus 8.  The cuts
    between shards are all that the driver holds.  A shard is sorted in pieces of
    about ``piece_bytes``, counted and summed up by Spark, so that no task sorts a
    whole shard.  Null ids and texts are ordinary values.  Repeated rows have keys
    of their own, by their number among their copies, so they too are cut and
    spread.  An empty input gives no rows.  Input columns named ``shard`` or
    ``slot`` are replaced.
    """
    kept = with_copy_numbers(df.drop("shard", "slot"), [text, row_id])
    size = (F.coalesce(F.octet_length(F.col(text)), F.lit(0)) + 8).cast("long")
    others = [F.col(f"`{c}`") for c in kept.columns if c not in (text, row_id, "__copy")]
    key = F.when(F.col("__copy") == 0, order_key(F.col(text), F.col(row_id))).otherwise(
        order_key(F.col(text), F.col(row_id), F.col("__copy"), *others))
    narrow = stored(kept.select(key.alias("__key"), size.alias("__size")), "keys")
    total = narrow.agg(F.sum("__size")).first()[0] or 0
    cuts = byte_cuts(narrow, [total * i // shards for i in range(1, shards)], int(tolerance * total / shards))
    shard = sum([(F.col("__key") >= c.key).cast("int") for c in cuts], F.lit(0))

    def placed(rows: DataFrame) -> DataFrame:
        return with_pieces(rows, narrow, total, piece_bytes).withColumn("__shard", shard)

    before = Window.partitionBy("__shard").orderBy("__piece").rowsBetween(Window.unboundedPreceding, -1)
    starts = stored(placed(narrow).groupBy("__shard", "__piece").agg(F.count(F.lit(1)).alias("n")).select(
        "__shard", "__piece", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("__start")), "starts")
    starts = F.broadcast(starts) if starts.count() <= BROADCAST_HASHES else starts
    rank = F.row_number().over(Window.partitionBy("__shard", "__piece").orderBy("__key", F.col(row_id)))
    return (placed(kept.withColumn("__key", key)).withColumn("__rank", rank).join(starts, ["__shard", "__piece"])
            .withColumn("shard", F.col("__shard").cast("int"))
            .withColumn("slot", F.col("__start") + F.col("__rank") - 1)
            .drop("__piece", "__key", "__rank", "__start", "__copy", "__shard"))


def shard_digest(documents: DataFrame, shards: int = 24) -> DataFrame:
    rows = with_shards(documents.select("doc_id", "text"), shards)
    body = F.coalesce("text", F.lit(""))
    return rows.select(
        "doc_id", (F.octet_length(body) + 8).cast("long").alias("size"),
        F.crc32(body.cast("binary")).alias("text_crc32"), F.lit("bytes").alias("law"),
        "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))
