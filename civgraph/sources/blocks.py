"""Records that may span lines, cut out of file blocks by many tasks.

A text scan gives the pieces of a file (between two separators) block by
block.  Whether a block starts inside a quoted value depends on all blocks
before it, so files are read in two passes:

1. ``scan`` sums up every block by itself: how it ends if it starts outside a
   value, and how if inside.  ``with_start`` composes these sums per file (one
   row per block) into the state in which each block starts.
2. The pieces are read again with that state, and records are cut.  What is
   open at a block's end, and what ends it in later blocks, comes out as
   fragments, at most two per block, which ``joined`` puts together.

The state of a block travels to its rows by a broadcast of one row per block,
that is, per ``spark.sql.files.maxPartitionBytes`` of input.  Both passes scan
the same files, hence the same blocks; a block without a state is an error.

Functions that run inside tasks travel by value: executors need no copy of
this package.
"""

from __future__ import annotations

import os
import sys
import tempfile
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

cloudpickle.register_pickle_by_value(sys.modules[__name__])

BLOCK = ["file_path", "block_start"]


def shared_table(df: DataFrame, partition_by: str | None = None) -> DataFrame:
    """``df`` written to the shared folder of the session
    (``spark.checkpoint.dir``) and read back: computed once.  A local session
    without that setting gets a private folder."""
    spark = df.sparkSession
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        root = tempfile.mkdtemp(prefix="civgraph-shared-", dir=os.environ.get("TMPDIR"))
        spark.conf.set("spark.checkpoint.dir", root)
    path = f"{root.rstrip('/')}/civgraph-{uuid.uuid4().hex}"
    df.write.parquet(path, partitionBy=partition_by)
    return spark.read.schema(df.schema).parquet(path)


def pieces(spark: SparkSession, files: list[str], separator: str) -> DataFrame:
    """value (bytes), file_path and block_start of every piece, in file order within a block."""
    return spark.read.option("lineSep", separator).text(files).select(
        F.col("value").cast("binary").alias("value"), F.col("_metadata.file_path").alias("file_path"),
        F.col("_metadata.file_block_start").alias("block_start"))


def block_runs(batch: pa.RecordBatch) -> Iterator[tuple[tuple[str, int], int, int]]:
    """((file_path, block_start), from, to) of the stretches of a batch."""
    starts = batch.column("block_start").to_numpy(zero_copy_only=False)
    paths = batch.column("file_path").dictionary_encode().indices.to_numpy(zero_copy_only=False)
    cuts = np.flatnonzero((starts[1:] != starts[:-1]) | (paths[1:] != paths[:-1])) + 1
    for low, high in zip([0, *cuts.tolist()], [*cuts.tolist(), len(starts)]):
        if high > low:
            yield (batch.column("file_path")[low].as_py(), int(starts[low])), low, high


def with_start(blocks: DataFrame) -> DataFrame:
    """``blocks`` (file_path, block_start, after_out, after_in) with
    ``starts_in``: whether the block starts inside a value.

    A block fixes the state, keeps it or turns it; so the state is that of
    the last block before that fixes it, turned as often as blocks turn it since."""
    before = Window.partitionBy("file_path").orderBy("block_start").rowsBetween(Window.unboundedPreceding, -1)
    upto = before.rowsBetween(Window.unboundedPreceding, 0)
    fixes = F.col("after_out") == F.col("after_in")
    turns = (~fixes & F.col("after_out")).cast("int")
    out = blocks.withColumn("__turns", F.sum(turns).over(upto))
    last = F.last(F.when(fixes, F.struct(F.col("after_out").alias("state"), F.col("__turns").alias("turns"))),
                  ignorenulls=True).over(before)
    out = out.withColumn("__last", last).withColumn("__before", F.coalesce(F.sum(turns).over(before), F.lit(0)))
    turned = (F.col("__before") - F.coalesce(F.col("__last.turns"), F.lit(0))) % 2 == 1
    state = F.coalesce(F.col("__last.state"), F.lit(False))
    return out.withColumn("starts_in", state != turned).drop("__turns", "__last", "__before")


def with_blocks(rows: DataFrame, blocks: DataFrame) -> DataFrame:
    """``rows`` in their order, each with the columns of its block."""
    return rows.join(F.broadcast(blocks), BLOCK, "left")


def joined(fragments: DataFrame, separator: str, keep: list[str]) -> DataFrame:
    """Records from their fragments (file_path, block_start, ``opens``, text).

    A fragment that does not open a record continues the one opened last in
    its file."""
    order = Window.partitionBy("file_path").orderBy("block_start", "opens")
    opened = F.last(F.when(F.col("opens"), F.col("block_start")), ignorenulls=True)
    owned = fragments.withColumn("__owner", opened.over(order))
    part = F.struct("block_start", "opens", "text", *keep)
    parts = owned.groupBy("file_path", "__owner").agg(F.array_sort(F.collect_list(part)).alias("p"))
    return parts.select("file_path", F.col("__owner").alias("block_start"),
                        F.concat_ws(separator, F.transform("p", lambda x: x["text"])).alias("text"),
                        *[F.get("p", F.lit(0))[k].alias(k) for k in keep])
