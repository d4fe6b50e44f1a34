"""Helpers shared by the training-data operators."""

from __future__ import annotations

import os
import tempfile
import uuid
from contextlib import contextmanager

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from civgraph.operators.relational import numbered_copies

#: A word is a maximal run of characters other than ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = "abcdefghijklmnopqrstuvwxyz"


#: Parquet's vectored reads keep buffers of whole column chunks outside the
#: heap, some for every thread that ever read, until the executor ends.
READING = {"parquet.hadoop.vectored.io.enabled": "false"}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.options(**READING).parquet(f"{sf_dir}/{name}.parquet")


def steady_reads(spark: SparkSession) -> None:
    """READING for the session, for tables that the caller reads and results
    that it writes; what the session sets itself stays."""
    for k, v in READING.items():
        if spark.conf.get(k, None) is None:
            spark.conf.set(k, v)


def shared_folder(spark: SparkSession) -> str:
    """A new folder under the shared ``spark.checkpoint.dir``.

    Only a local session without that setting (tests) gets a private folder.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        root = tempfile.mkdtemp(prefix="civgraph-shared-", dir=os.environ.get("TMPDIR"))
        spark.conf.set("spark.checkpoint.dir", root)
    return f"{root.rstrip('/')}/llm-{uuid.uuid4().hex}"


WRITING = {
    # a written table replaces the shuffle files that made it: these go then
    "spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true",
    # whole texts are long: small batches bound the memory of Python tasks
    "spark.sql.execution.arrow.maxRecordsPerBatch": "1024",
} | READING


@contextmanager
def writing(spark: SparkSession, more: dict[str, str] | None = None):
    """Session settings, ``more`` among them, for the time of a write."""
    settings = WRITING | (more or {})
    before = {k: spark.conf.get(k, None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.set(k, v) if v is not None else spark.conf.unset(k)


def stored(df: DataFrame, name: str = "table", settings: dict[str, str] | None = None) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: cuts the lineage
    and is computed once, however often it is used.  ``settings`` hold for the
    time of the write."""
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/{name}"
    with writing(spark, settings):
        df.write.parquet(path)
    return spark.read.options(**READING).schema(df.schema).parquet(path)


def forget(df: DataFrame) -> None:
    """Delete the files of a stored table that no later step reads."""
    for file in df.inputFiles()[:1]:
        path = df.sparkSession._jvm.org.apache.hadoop.fs.Path(file).getParent()
        path.getFileSystem(df.sparkSession._jsparkSession.sessionState().newHadoopConf()).delete(path, True)


def give_back() -> None:
    """At the end of a Python task: Arrow's freed memory returns to the system,
    as the worker lives on, beside steps that need the executor's memory."""
    pa.default_memory_pool().release_unused()


def ascii_lower(c: Column) -> Column:
    """A-Z only; other letters stay as they are."""
    return F.translate(c, UPPER, LOWER)


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def set_apart(df: DataFrame, names: tuple[str, ...]) -> tuple[DataFrame, list[Column]]:
    """``df`` with columns that are called like results (``names``) renamed,
    and the columns that give back the input as it was."""
    taken = {n.lower() for n in names}
    inner = [f"__in{i}" if c.lower() in taken else c for i, c in enumerate(df.columns)]
    renamed = df.select(*[F.col(f"`{c}`").alias(n) for c, n in zip(df.columns, inner)])
    return renamed, [F.col(f"`{n}`").alias(c) for c, n in zip(df.columns, inner)]


#: Most row hashes that are broadcast (8 bytes each); beyond, they join by shuffle.
BROADCAST_HASHES = 1_000_000


def with_copy_numbers(df: DataFrame, by: list[str]) -> DataFrame:
    """``df`` with ``__copy``: 0 for a row that no other equals in the columns
    ``by``; else the row's number (1, 2, ...) among the rows that equal it in
    all columns, between which it does not matter.

    Only hashes are shuffled to find the repeated rows; just these are counted
    and numbered from their counts, so that no task gathers a group."""
    hashed = df.withColumn("__group", F.xxhash64(*[F.col(f"`{c}`").isNull() for c in by], *[F.col(f"`{c}`") for c in by]))
    repeated = stored(hashed.groupBy("__group").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("__group"), "repeated")
    many = repeated.limit(BROADCAST_HASHES + 1).count()
    none = F.lit(0).cast("long").alias("__copy")
    if not many:
        return df.select("*", none)
    repeated = F.broadcast(repeated) if many <= BROADCAST_HASHES else repeated
    alone = hashed.join(repeated, "__group", "left_anti").drop("__group").select("*", none)
    copies = numbered_copies(hashed.join(repeated, "__group", "left_semi").drop("__group"))
    return alone.unionByName(copies.withColumnRenamed("__n", "__copy"))
