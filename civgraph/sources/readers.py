"""Readers for the raw contracts.

* R01 glob over releases, R02 ``source_file_path`` from the scan metadata.
* R03 drifting headers: the files of a source are read in one scan, grouped by
  their headers, and every record is parsed with the columns of its file's
  header, then bound BY NAME (one Spark read of several CSVs binds later files by
  position and would swap columns).  Where a contract has one header, a file
  that does not match fails instead of binding by position.
* R04/R07 delimiter, header, every value as text (no inference: leading zeros
  in codes survive).  R05 encodings.  R08 quoted multi-line fields, see
  ``csv_records``: a large file is read by many tasks.
* R06 preamble lines and the P02 line repair: every line gets its number within
  the file (a per-block counter in ``mapInArrow``; block 0 is the start of the
  file), lines are dropped or repaired by it, and records are cut after that, so
  quoted line breaks may follow a preamble.
"""

from __future__ import annotations

import fnmatch
import os
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from civgraph.operators.relational import union_by_name
from civgraph.sources.blocks import pieces
from civgraph.sources.contracts import CONTRACT_ARRAYS, CONTRACTS, SEEDS, Contract
from civgraph.sources.csv_records import read_records, text_of
from civgraph.sources.files import list_files, newest_files
from civgraph.sources.json_elements import read_elements
from civgraph.sources.prep import prepare

PATH_COL = "source_file_path"


def _with_path(df: DataFrame) -> DataFrame:
    return df.select("*", F.col("_metadata.file_path").alias(PATH_COL))


def _csv_reader(spark: SparkSession, c: Contract):
    r = (spark.read.option("header", True).option("inferSchema", False)
         .option("sep", c.sep).option("encoding", c.encoding)
         .option("quote", '"').option("escape", '"')
         .option("multiLine", c.multiline).option("mode", "FAILFAST"))
    for k, v in c.options.items():
        r = r.option(k, v)
    return r


def prep_step(c: Contract, path: str) -> str | None:
    """The preparation step a contract attaches to this file, if any."""
    name = path.rstrip("/").rsplit("/", 1)[-1]
    return next((step for pattern, step in c.prep.items() if fnmatch.fnmatch(name, pattern)), None)


def read_csv(spark: SparkSession, c: Contract, files: list[str]) -> DataFrame:
    if not c.multiline:
        return _with_path(_csv_reader(spark, c).option("enforceSchema", False).csv(files))
    by_step: dict[str | None, list[str]] = {}
    for f in files:
        by_step.setdefault(prep_step(c, f), []).append(f)
    return union_by_name([read_csv_lines(spark, c, group, step) for step, group in by_step.items()])


# --- R06 / P02: lines by position -------------------------------------------------------
def numbered_lines(spark: SparkSession, path: str, encoding: str = "UTF-8") -> DataFrame:
    """Text lines of a file with their numbers, see ``with_line_numbers``."""
    return with_line_numbers(pieces(spark, [path], "\n").withColumn("value", text_of(F.col("value"), encoding)))


def with_line_numbers(lines: DataFrame) -> DataFrame:
    """``lines`` (value, file_path, block_start) with ``line_no``, the number
    of a line in its file; null in the blocks that do not begin a file.

    Rows of a block arrive in file order and contiguously inside a partition,
    so a running counter is exact: no shuffle, no sort.  The counter is
    defined in here, so that Spark ships it by value and executors need not
    have the package."""
    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import numpy as np
        key, last = None, 0
        for b in batches:
            if not b.num_rows:
                continue
            starts = b.column("block_start").to_numpy(zero_copy_only=False)
            paths = b.column("file_path").dictionary_encode().indices.to_numpy(zero_copy_only=False)
            cut = np.append(True, (starts[1:] != starts[:-1]) | (paths[1:] != paths[:-1]))
            index = np.arange(b.num_rows)
            numbers = index - np.maximum.accumulate(np.where(cut, index, 0)) + 1
            if (b.column("file_path")[0].as_py(), starts[0]) == key:  # goes on from the batch before
                numbers[np.cumsum(cut) == 1] += last
            key, last = (b.column("file_path")[-1].as_py(), starts[-1]), int(numbers[-1])
            yield pa.RecordBatch.from_arrays(
                [*(b.column(c) for c in ("value", "file_path", "block_start")), pa.array(numbers, pa.int64(), mask=starts > 0)],
                ["value", "file_path", "block_start", "line_no"])

    return lines.select("value", "file_path", "block_start").mapInArrow(
        number, "value string, file_path string, block_start long, line_no long")


def read_csv_lines(spark: SparkSession, c: Contract, files: list[str] | str, step: str | None = None) -> DataFrame:
    """CSV files whose records are cut by many tasks (R08), after preamble
    lines are dropped by position (R06) and lines are prepared (P02)."""
    def lines(found: DataFrame) -> DataFrame:
        found = with_line_numbers(found)
        if step:
            found = prepare(step, found)
        # null beyond the first block of a file
        return found.where(F.coalesce(F.col("line_no") > c.skip_lines, F.lit(True)))

    return read_records(spark, [files] if isinstance(files, str) else files, c.sep, c.encoding, one_header=not c.drifting_header,
                        lines=lines if c.skip_lines or step else None, path_col=PATH_COL)


def schema_groups(spark: SparkSession, files: list[str]) -> list[tuple[list[str], T.StructType]]:
    """Files whose schemas merge, with the merged schema.

    Spark merges all footers of a list in one job.  Where types disagree the
    list is halved, so neighbours (the parts of one release) stay together, and
    lists that agree are joined again: as many groups as there are types to
    tell apart, not files."""
    try:
        return [(files, spark.read.option("mergeSchema", True).parquet(*files).schema)]
    except Exception as exc:  # CANNOT_MERGE_INCOMPATIBLE_DATA_TYPE
        if "MERGE" not in str(exc).upper() or len(files) == 1:
            raise
    half = len(files) // 2
    out: list[tuple[list[str], T.StructType]] = []
    for group, schema in schema_groups(spark, files[:half]) + schema_groups(spark, files[half:]):
        for k, (have, known) in enumerate(out):
            types = {f.name.lower(): f.dataType for f in known.fields}
            if all(types.get(f.name.lower(), f.dataType) == f.dataType for f in schema.fields):
                new = [f for f in schema.fields if f.name.lower() not in types]
                out[k] = (have + group, T.StructType(known.fields + new))
                break
        else:
            out.append((group, schema))
    return out


def read_parquet_releases(spark: SparkSession, files: list[str]) -> DataFrame:
    """All files of a Parquet source by column name: one scan per group of
    files whose schemas merge.  Columns whose types differ between groups (e.g.
    integer one year, text the next) are cast to text; silver casts them again."""
    groups = schema_groups(spark, files)
    types: dict[str, set] = {}
    for _, schema in groups:
        for field in schema.fields:
            types.setdefault(field.name.lower(), set()).add(field.dataType.simpleString())
    frames = [_with_path(spark.read.schema(schema).parquet(*group)).select(
        *[F.col(f"`{f.name}`").cast("string").alias(f.name) if len(types[f.name.lower()]) > 1 else F.col(f"`{f.name}`")
          for f in schema.fields], PATH_COL) for group, schema in groups]
    return union_by_name(frames)


# --- entry points ---------------------------------------------------------------------------------
def read_raw(spark: SparkSession, raw_dir: str, name: str, newest: bool = False) -> DataFrame:
    """Read one raw source by its contract name, with ``source_file_path``;
    with ``newest`` only the files of the newest release, chosen by name
    before anything is read."""
    c = CONTRACTS[name]
    files = list_files(spark, os.path.join(raw_dir, c.pattern))
    if not files:
        raise FileNotFoundError(f"no file for source {name}: {os.path.join(raw_dir, c.pattern)}")
    if newest:
        files = newest_files(files)
    return read_parquet_releases(spark, files) if c.format == "parquet" else read_csv(spark, c, files)


def read_seed(spark: SparkSession, seeds_dir: str, name: str) -> DataFrame:
    """Seed CSV with its explicit schema; empty fields read as NULL."""
    return (spark.read.schema(SEEDS[name]).option("header", True).option("enforceSchema", False)
            .option("escape", '"').option("mode", "FAILFAST")
            .csv(os.path.join(seeds_dir, f"{name}.csv")))


def read_contract_document(spark: SparkSession, path: str) -> DataFrame:
    """The nested procurement document (one JSON document per file) as
    ``kind`` and ``element``, one row per contract; read by many tasks, once
    for both kinds (see ``json_elements``)."""
    return read_elements(spark, path, CONTRACT_ARRAYS)
