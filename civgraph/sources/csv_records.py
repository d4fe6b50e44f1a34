"""CSV records with quoted line breaks, read by many tasks per file.

Same records as ``multiLine`` with ``escape='"'``, whose files Spark reads in
one task each (see ``blocks`` for the method).  A quote opens a value only at
the start of a field; doubled quotes stand for one; what follows a closing
quote belongs to the field up to the delimiter.  Line breaks inside quotes
keep their bytes, but for a file whose lines end with ``\\r\\n``, where they become
``\\n``; lines end with ``\\n`` or ``\\r\\n``; empty lines between records are skipped.

All files of one source are read in one scan, however many headers they have:
the first pass takes the header of each file along, files with equal headers
are one group, and every record is parsed with the columns of its group.
"""

from __future__ import annotations

import csv
import io
import re
import sys
from collections.abc import Callable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from civgraph.sources.blocks import block_runs, joined, pieces, shared_table, with_blocks, with_start

cloudpickle.register_pickle_by_value(sys.modules[__name__])

BOM = b"\xef\xbb\xbf"
SCAN = "file_path string, block_start long, after_out boolean, after_in boolean, head binary, whole boolean, crlf boolean"


def text_of(value: Column, encoding: str) -> Column:
    """Bytes of a file as text."""
    return value.cast("string") if encoding.upper() in ("UTF-8", "UTF8") else F.decode(value, encoding)


class Lines:
    """Ends of lines: does a line leave a quoted value open?"""

    def __init__(self, sep: str):
        s = re.escape(sep).encode()
        quoted = rb'"(?:[^"]++|"")*+"[^' + s + rb"]*+"
        field = rb"(?:" + quoted + rb'|[^"' + s + rb"][^" + s + rb"]*+|)"
        more = rb"(?:" + s + field + rb")*+"
        self.closed = re.compile(field + more)
        self.closes = re.compile(quoted[1:] + more)

    def open_after(self, line: bytes, inside: bool) -> bool:
        if b'"' not in line:
            return inside
        text = line[:-1] if line.endswith(b"\r") else line
        return not (self.closes if inside else self.closed).fullmatch(text)


def _clean(line: bytes) -> bytes:
    return line[:-1] if line.endswith(b"\r") else line


def scan_of(sep: str) -> Callable:
    """The first pass: how each block ends, and the first record of block 0."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lines = Lines(sep)
        key, out, ins, head, whole, crlf = None, False, True, None, False, False

        def row():
            return pa.RecordBatch.from_pydict({
                "file_path": [key[0]], "block_start": pa.array([key[1]], pa.int64()), "after_out": [out], "after_in": [ins],
                "head": pa.array([head], pa.binary()), "whole": [whole], "crlf": [crlf]})

        for batch in batches:
            quotes = pc.match_substring(batch.column("value"), '"').to_numpy(zero_copy_only=False)
            for block, low, high in block_runs(batch):
                fresh = block != key
                if fresh:
                    if key is not None:
                        yield row()
                    key, out, ins, head, whole, crlf = block, False, True, None, False, False
                values = batch.column("value")
                at = low
                while key[1] == 0 and not whole and at < high:  # the first record that is not an empty line
                    line = values[at].as_py()
                    at += 1
                    if head is None:
                        line, crlf = line.removeprefix(BOM), line.endswith(b"\r")
                    if head is None and not _clean(line):
                        continue
                    opened = lines.open_after(line, head is not None and opened)
                    head = line if head is None else head + b"\n" + line
                    whole = not opened
                for i in (quotes[low:high].nonzero()[0] + low).tolist():
                    line = values[i].as_py()
                    if key[1] == 0 and i == low and fresh:
                        line = line.removeprefix(BOM)
                    same = out == ins
                    out = lines.open_after(line, out)
                    ins = out if same else lines.open_after(line, ins)
        if key is not None:
            yield row()
    return run


CUT = "file_path string, block_start long, header int, first boolean, opens boolean, value binary"


def cut_of(sep: str, fragments: bool) -> Callable:
    """The second pass: records (``opens`` is null), or else the fragments of
    records that lie in several blocks.  ``first`` marks the first of a file."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lines = Lines(sep)
        key, inside, header, parts, opens, first = None, False, None, [], None, False

        def frame(rows):
            n = len(rows)
            return pa.RecordBatch.from_pydict({
                "file_path": pa.array([r[0] for r in rows], pa.string()), "block_start": pa.array([r[1] for r in rows], pa.int64()),
                "header": pa.array([r[2] for r in rows], pa.int32()), "first": pa.array([r[3] for r in rows], pa.bool_()),
                "opens": pa.array([r[4] for r in rows], pa.bool_()), "value": pa.array([r[5] for r in rows], pa.binary())}) if n else None

        def left():  # what is open at the end of a block
            return [(*key, header, first, opens, b"\n".join(parts))] if parts and fragments else []

        for batch in batches:
            rows = []
            for block, low, high in block_runs(batch):
                if block != key:
                    rows += left() if key else []
                    key, parts = block, []
                    inside = batch.column("starts_in")[low].as_py()
                    if inside is None:
                        raise ValueError(f"block {block} was not there in the first pass")
                    header = batch.column("header")[low].as_py()
                    opens, first = not inside, block[1] == 0
                for line in batch.column("value").slice(low, high - low).to_pylist():
                    if not inside and not parts:
                        if block[1] == 0 and first:
                            line = line.removeprefix(BOM)
                        if not _clean(line):
                            continue
                    inside = lines.open_after(line, inside)
                    parts.append(line)
                    if not inside:
                        if opens and not fragments:
                            rows.append((*key, header, first, None, _clean(b"\n".join(parts))))
                        elif not opens and fragments:
                            rows.append((*key, header, False, False, _clean(b"\n".join(parts))))
                        first = first and not opens
                        opens, parts = True, []
            if (out := frame(rows)) is not None:
                yield out
        if key and (out := frame(left())) is not None:
            yield out
    return run


def columns_of(head: str, sep: str) -> tuple[str, ...]:
    """Column names of a header; unnamed columns are named by place, and
    repeated names get their place appended, as Spark does."""
    names = next(csv.reader(io.StringIO(head), delimiter=sep))
    low = [n.lower() for n in names]
    return tuple(f"_c{i}" if not n else f"{n}{i}" if low.count(n.lower()) > 1 else n for i, n in enumerate(names))


def read_records(spark: SparkSession, files: list[str], sep: str, encoding: str = "UTF-8", one_header: bool = False,
                 lines: Callable[[DataFrame], DataFrame] | None = None, path_col: str = "source_file_path") -> DataFrame:
    """All records of ``files`` with every value as text, by column name, and
    the path of the file.  A column that a file lacks is null in its rows;
    with ``one_header`` files whose headers differ are an error.

    ``lines`` may drop or change lines before records are cut (value as text,
    file_path, block_start; in order within a block).  A record that does not
    fit its header fails the query.
    """
    def source() -> DataFrame:
        found = pieces(spark, files, "\n").withColumn("value", text_of(F.col("value"), encoding))
        found = lines(found) if lines else found
        return found.select(F.col("value").cast("binary").alias("value"), "file_path", "block_start")

    scanned = shared_table(source().mapInArrow(scan_of(sep), SCAN))
    blocks = with_start(scanned)
    across = scanned.where("after_out").limit(1).count() > 0  # else no record leaves its block
    heads = [(r.file_path, r.head) for r in scanned.where("head IS NOT NULL AND whole").select(
        "file_path", F.col("head").cast("string").alias("head")).collect()]  # one row per file
    ends = scanned.where("block_start = 0").select("file_path", "crlf")
    if scanned.where("head IS NOT NULL AND NOT whole").limit(1).count():
        plain = blocks.withColumn("header", F.lit(0))
        heads += [(r.file_path, r.text) for r in _records(source, plain, sep, True).where(
            "first").join(F.broadcast(scanned.where("head IS NOT NULL AND NOT whole").select("file_path")), "file_path").collect()]
    bare = {r.file_path for r in scanned.select("file_path").distinct().collect()} - {path for path, _ in heads}
    if bare or not heads:  # a file without any line has no rows and needs no header
        raise ValueError(f"no header in the first block of {sorted(bare) or files}")
    groups: dict[tuple[str, ...], int] = {}
    header_of = [(path, groups.setdefault(columns_of(head.removesuffix("\r"), sep), len(groups))) for path, head in heads]
    if one_header and len(groups) > 1:
        raise ValueError(f"headers differ: {sorted(groups)}")
    blocks = blocks.join(F.broadcast(spark.createDataFrame(header_of, "file_path string, header int")), "file_path", "left")
    records = _records(source, blocks, sep, across).join(F.broadcast(ends), "file_path", "left").withColumn(
        "text", F.when(F.col("crlf"), F.replace(F.col("text"), F.lit("\r\n"), F.lit("\n"))).otherwise(F.col("text")))
    return _parsed(records.where("NOT first"), list(groups), sep, path_col)


def _records(source: Callable[[], DataFrame], blocks: DataFrame, sep: str, across: bool) -> DataFrame:
    """file_path, header, first and text of every record."""
    def cut(fragments: bool) -> DataFrame:
        rows = with_blocks(source(), blocks.select("file_path", "block_start", "starts_in", "header"))
        return rows.mapInArrow(cut_of(sep, fragments), CUT).withColumn("text", F.col("value").cast("string"))

    wanted = ["file_path", "header", "first", "text"]
    records = cut(False).select(*wanted)
    if across:
        records = records.unionByName(joined(cut(True), "\n", ["header", "first"]).select(*wanted))
    return records


def _parsed(records: DataFrame, headers: list[tuple[str, ...]], sep: str, path_col: str) -> DataFrame:
    options = {"sep": sep, "quote": '"', "escape": '"', "mode": "FAILFAST", "multiLine": "true", "lineSep": "\n"}
    parsed = [F.col("file_path").alias(path_col), "header"]
    for i, names in enumerate(headers):
        schema = T.StructType([T.StructField(f"_c{k}", T.StringType()) for k in range(len(names))])
        parsed.append(F.when(F.col("header") == i, F.from_csv("text", schema.simpleString(), options)).alias(f"r{i}"))
    rows = records.select(*parsed)
    if len(headers) == 1:
        return rows.select(*[F.col(f"r0._c{k}").alias(n) for k, n in enumerate(headers[0])], path_col)
    # by name, whatever the case; the first spelling stays
    where: dict[str, list[tuple[int, int]]] = {}
    spelt: dict[str, str] = {}
    for i, names in enumerate(headers):
        for k, name in enumerate(names):
            where.setdefault(name.lower(), []).append((i, k))
            spelt.setdefault(name.lower(), name)
    out = []
    for low, places in where.items():
        value = F.lit(None).cast("string")
        for i, k in reversed(places):
            value = F.when(F.col("header") == i, F.col(f"r{i}._c{k}")).otherwise(value)
        out.append(value.alias(spelt[low]))
    return rows.select(*out, path_col)
