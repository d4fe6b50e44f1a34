"""Mixing sources to target weights.

Every row has a hash-random key.  Within a source the rows are taken in key
order; a source's budget is a number of whole epochs and a rest, and the rest
is cut where the prefix sum of sizes meets it.  The prefix sums come in two
levels (sums of key buckets, then rows of the one bucket that holds the cut),
so that a source with a third of all rows is never sorted in one task.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from civgraph.llm.common import set_apart, stored, with_copy_numbers, word_count

KEY_DIGITS = 15  # hexadecimal digits of the random key
MAX_EPOCHS = 3


def random_key(row_id: Column, text: Column, seed: str, *more: Column) -> Column:
    """60 random bits of id and text: the same row gets the same key in any
    run and partitioning.  ``more`` tells rows apart that are equal in both."""
    digest = F.md5(F.concat(
        F.lit(seed), F.coalesce(row_id.cast("string"), F.lit("null")), F.lit(":"),
        F.md5(F.coalesce(text, F.lit("")).cast("binary")), *[F.concat(F.lit(":"), m) for m in more]).cast("binary"))
    return F.conv(F.substring(digest, 1, KEY_DIGITS), 16, 10).cast("long")


def targets(sources: DataFrame) -> DataFrame:
    """``sources`` (source, source_size) plus ``target``.

    Sources in code point order, null last, weigh 1, 2, 3, repeating, and
    share all words; no target passes ``MAX_EPOCHS`` times its source.  The
    excess is reshared by weight: one level L with target = min(L * weight,
    limit), found with running sums over the sources in order of limit per
    weight.  One row per source, never per document.
    """
    order = Window.orderBy(F.col("source").asc_nulls_last())
    ranked = sources.withColumn("w", (F.row_number().over(order) - 1) % 3 + 1).withColumn(
        "c", F.col("source_size") * MAX_EPOCHS)
    by_ratio = Window.orderBy(F.col("c") / F.col("w"), F.col("source").asc_nulls_last())
    before = by_ratio.rowsBetween(Window.unboundedPreceding, -1)
    after = by_ratio.rowsBetween(0, Window.unboundedFollowing)
    every = Window.partitionBy()
    level = (F.sum("source_size").over(every) - F.coalesce(F.sum("c").over(before), F.lit(0))) / F.sum(
        "w").over(after)
    stepped = ranked.withColumn("level", level).withColumn(
        "fits", F.col("level") * F.col("w") <= F.col("c"))
    chosen = stepped.withColumn("level", F.max(F.when(F.col("fits"), F.struct(
        -F.col("c") / F.col("w"), "level"))).over(every)["level"])
    return chosen.select("source", "source_size", F.least(
        F.col("level") * F.col("w"), F.col("c").cast("double")).alias("target"))


def cuts(narrow: DataFrame) -> DataFrame:
    """Per source: source_size, target, whole ``epochs`` and ``cut_key``: rows
    with a key up to it are taken once more (null: none).

    ``narrow`` has source, size and key and should be stored.  A row belongs
    to the rest if the middle of its words lies within the budget; rows with
    equal keys are taken together.
    """
    rows = narrow.count()
    bits = min(4 * KEY_DIGITS, max(1, math.ceil(math.log2(max(2, math.sqrt(rows))))))
    bucket = F.shiftright("key", 4 * KEY_DIGITS - bits)
    by_bucket = narrow.groupBy("source", bucket.alias("bucket")).agg(F.sum("size").alias("bucket_size"))
    sizes = by_bucket.groupBy("source").agg(F.sum("bucket_size").alias("source_size"))
    budget = stored(targets(sizes).withColumn(
        "epochs", F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(
            0)).withColumn("rest", F.col("target") - F.col("epochs") * F.col("source_size")), "budget")

    running = Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    placed = by_bucket.withColumn("before", F.coalesce(F.sum("bucket_size").over(running), F.lit(0)))
    b = budget.alias("b")
    same = lambda other: F.col("b.source").eqNullSafe(F.col(f"{other}.source"))
    # buckets that the rest reaches into: of these only the last can hold the cut
    reached = (placed.alias("p").join(b, same("p"))
               .where((F.col("p.before") < F.col("b.rest")) & (F.col("p.bucket_size") > 0))
               .groupBy("p.source").agg(F.max(F.struct("p.bucket", "p.before", "b.rest")).alias("last")))
    inside = (narrow.withColumn("bucket", bucket).alias("n")
              .join(reached.alias("r"), F.col("n.source").eqNullSafe(F.col("r.source"))
                    & (F.col("n.bucket") == F.col("r.last.bucket")))
              .groupBy("n.source", "n.key").agg(F.sum("n.size").alias("size"),
                                               F.first("r.last").alias("last")))
    run = Window.partitionBy("source").orderBy("key").rowsBetween(Window.unboundedPreceding, 0)
    taken = (inside.withColumn("upto", F.col("last.before") + F.sum("size").over(run))
             .groupBy("source").agg(
                 F.max(F.when(F.col("upto") - F.col("size") / 2 <= F.col("last.rest"), F.col("key"))).alias("hit"),
                 F.first("last.bucket").alias("bucket")))
    cut = F.coalesce(F.col("t.hit"), F.shiftleft(F.col("t.bucket"), 4 * KEY_DIGITS - bits) - 1)
    return b.join(taken.alias("t"), same("t"), "left").select(
        "b.source", "b.source_size", "b.target", F.col("b.epochs").cast("int").alias("epochs"),
        cut.alias("cut_key"))


def mix(df: DataFrame, seed: str = "mix:") -> DataFrame:
    """All rows and columns of ``df`` plus size, source_size, target and
    ``copies``, the number of times the mix takes the row (0 to 3).

    Null text: size 0.  A null source is a source of its own.  Sources without
    words have target 0 and give nothing.  Repeated rows have keys of their own
    (by their number among their copies), so a cut may lie between them.  Input
    columns with the names of results are replaced (``mixed_documents`` keeps them).
    """
    kept = with_copy_numbers(df.drop("size", "source_size", "target", "copies"), ["doc_id", "text", "source"])
    others = [F.col(f"`{c}`") for c in kept.columns if c not in ("doc_id", "text", "source", "__copy")]
    rest = F.xxhash64(*others).cast("string") if others else F.lit("")
    size, plain = word_count(F.col("text")), random_key(F.col("doc_id"), F.col("text"), seed)
    key = F.when(F.col("__copy") == 0, plain).otherwise(
        random_key(F.col("doc_id"), F.col("text"), seed, F.col("__copy").cast("string"), rest))
    narrow = stored(kept.select("source", size.alias("size"), key.alias("key")), "sizes")
    plan = stored(cuts(narrow), "cuts").select(
        F.col("source").alias("__source"), "source_size", "target", "epochs", "cut_key")
    once_more = F.coalesce(key <= F.col("cut_key"), F.lit(False)).cast("int")
    return (kept.join(plan, F.col("source").eqNullSafe(F.col("__source")))
            .withColumn("size", size)
            .withColumn("copies", F.col("epochs") + once_more)
            .drop("__source", "epochs", "cut_key", "__copy"))


def mix_digest(documents: DataFrame) -> DataFrame:
    return mix(documents.select("doc_id", "text", "source")).select(
        "doc_id", "size", "source_size", "target",
        (F.col("copies") * F.col("size")).cast("long").alias("taken"))


def mixed_documents(documents: DataFrame) -> DataFrame:
    """The mix as documents, their columns as they were: a row taken n times
    is there n times."""
    inner, back = set_apart(documents, ("size", "source_size", "target", "copies", "epochs", "cut_key"))
    mixed = mix(inner).where("copies > 0")
    return mixed.withColumn("__taken", F.explode(F.sequence(F.lit(1), F.col("copies")))).select(*back)
