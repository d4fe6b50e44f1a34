"""Elements of arrays in one JSON document, cut out by many tasks.

A consolidated document is a single JSON value, which Spark parses in one
task.  Here its file is read in pieces that start at an opening brace, so that
it splits wherever there is an object, on one line or on many.  The first pass
(see ``blocks``) sums up every block: whether it turns the string state, and,
for either state at its start, by how much it deepens and which containers it
opens at which depth, relative to its own.  Composed per file this gives the
depth and the open containers at the start of every block; then the elements
of the wanted arrays are cut and can be parsed by ``from_json``.
"""

from __future__ import annotations

import re
import sys
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from civgraph.sources.blocks import block_runs, joined, pieces, shared_table, with_blocks, with_start

cloudpickle.register_pickle_by_value(sys.modules[__name__])

KEY_BYTES = 256  # a key that opens a container lies within so many bytes before it
OPENING = re.compile(rb'"((?:[^"\\]|\\.)*)"\s*:\s*\Z')

MARKS = "array<struct<depth: int, mark: string, last: boolean>>"
SCAN = (f"file_path string, block_start long, after_out boolean, after_in boolean, deeper_out int, deeper_in int, "
        f"marks_out {MARKS}, marks_in {MARKS}, dangling string")
MARKS_ARROW = pa.list_(pa.struct([("depth", pa.int32()), ("mark", pa.string()), ("last", pa.bool_())]))


def brackets(text: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
    """Places of all brackets, +1 or -1 for each, whether an odd number of
    quotes precedes it, and the number of quotes.  Escaped quotes do not count."""
    data = np.frombuffer(text, np.uint8)
    quotes = np.flatnonzero(data == 34)
    behind = quotes[(quotes > 0) & (data[np.maximum(quotes - 1, 0)] == 92)]
    if len(behind):
        escaped = [q for q in behind.tolist() if _odd(text, q)]
        quotes = np.setdiff1d(quotes, np.array(escaped, np.int64), assume_unique=True)
    at = np.flatnonzero(np.isin(data, np.frombuffer(b"{}[]", np.uint8)))
    step = np.where(np.isin(data[at], np.frombuffer(b"{[", np.uint8)), 1, -1)
    return at, step, np.searchsorted(quotes, at) % 2 == 1, len(quotes)


def _odd(text: bytes, q: int) -> bool:
    """Whether an odd number of backslashes comes right before q."""
    n = q
    while n and text[n - 1] == 92:
        n -= 1
    return (q - n) % 2 == 1


def mark_at(text: bytes, at: int, before: bytes) -> str:
    """What opens at a place: its bracket and the key before it, if any;
    ``?`` for the key if that may lie in the block before."""
    low = max(0, at - KEY_BYTES)
    head = text[low:at] if low else before[-KEY_BYTES:] + text[:at]
    key = OPENING.search(head)
    if key:
        return chr(text[at]) + key.group(1).decode()
    return chr(text[at]) + ("?" if not head.strip() else "")


def _texts(batch: pa.RecordBatch, low: int, high: int, first: bool) -> bytes:
    """The bytes of a stretch of pieces; only a file's first has no brace before it."""
    values = batch.column("value").slice(low, high - low).to_pylist()
    return (b"" if first else b"{") + b"{".join(values)


def scan() -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, odd, deeper, marks, tail = None, False, [0, 0], [{}, {}], b""

        def row():
            out = [[{"depth": d, "mark": m, "last": m == last} for d, (seen, last) in found.items() for m in seen]
                   for found in marks]
            dangling = OPENING.search(tail[-KEY_BYTES:])
            return pa.RecordBatch.from_pydict({
                "file_path": [key[0]], "block_start": pa.array([key[1]], pa.int64()), "after_out": [odd], "after_in": [not odd],
                "deeper_out": pa.array([deeper[0]], pa.int32()), "deeper_in": pa.array([deeper[1]], pa.int32()),
                "marks_out": pa.array([out[0]], MARKS_ARROW), "marks_in": pa.array([out[1]], MARKS_ARROW),
                "dangling": pa.array([dangling.group(1).decode() if dangling else None], pa.string())})

        for batch in batches:
            for block, low, high in block_runs(batch):
                first = False
                if block != key:
                    if key is not None:
                        yield row()
                    key, odd, deeper, marks, tail = block, False, [0, 0], [{}, {}], b""
                    first = block[1] == 0
                text = _texts(batch, low, high, first)
                at, step, inside, quotes = brackets(text)
                for state in (0, 1):  # outside, inside a string at the start of the block
                    plain = inside == (odd != bool(state))
                    depth = deeper[state] + np.cumsum(step[plain])
                    opens = step[plain] > 0
                    for place, d in zip(at[plain][opens].tolist(), (depth[opens] - 1).tolist()):
                        mark = mark_at(text, place, tail)
                        seen, _ = marks[state].setdefault(d, (set(), None))
                        seen.add(mark)
                        marks[state][d] = (seen, mark)
                    if len(depth):
                        deeper[state] = int(depth[-1])
                odd ^= quotes % 2 == 1
                tail = (tail + text)[-KEY_BYTES:]
        if key is not None:
            yield row()
    return run


CUT = "file_path string, block_start long, kind string, opens boolean, value binary"


def cut(arrays: dict[str, tuple[str, ...]], fragments: bool) -> Callable:
    """Elements of the arrays at the given paths (``opens`` is null), or else
    the fragments of elements that lie in several blocks."""
    length = len(next(iter(arrays.values())))
    kinds = {tuple("{" + k for k in path[:-1]) + ("[" + path[-1],): kind for kind, path in arrays.items()}
    level = length + 1  # of the elements

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, inside, depth, path, tail = None, False, 0, [], b""
        parts, kind, opens = [], None, None  # of the element that is open

        def frame(rows):
            return pa.RecordBatch.from_pydict({
                "file_path": pa.array([r[0] for r in rows], pa.string()), "block_start": pa.array([r[1] for r in rows], pa.int64()),
                "kind": pa.array([r[2] for r in rows], pa.string()), "opens": pa.array([r[3] for r in rows], pa.bool_()),
                "value": pa.array([r[4] for r in rows], pa.binary())})

        def left():  # an element that is open at the end of a block
            return [(*key, kind, opens, b"".join(parts))] if parts and fragments and kind else []

        for batch in batches:
            rows = []
            for block, low, high in block_runs(batch):
                first = False
                if block != key:
                    rows += left() if key else []
                    key, tail, parts = block, b"", []
                    inside, depth = batch.column("starts_in")[low].as_py(), batch.column("depth")[low].as_py()
                    if inside is None:
                        raise ValueError(f"block {block} was not there in the first pass")
                    path = batch.column("path")[low].as_py()
                    if batch.column("dangling")[low].as_py() is not None:
                        tail = b'"' + batch.column("dangling")[low].as_py().encode() + b'":'
                    first = block[1] == 0
                    kind = kinds.get(tuple(path)) if depth > level else None
                    opens = False
                    parts = [b""] if kind else []
                text = _texts(batch, low, high, first)
                at, step, odd, quotes = brackets(text)
                plain = odd == inside
                at, step = at[plain], step[plain]
                after = depth + np.cumsum(step)
                before = after - step
                begin = 0  # where the open element goes on
                wanted = (before <= level) & (step > 0) | (after == level) & (step < 0)
                for place, up, low_depth in zip(at[wanted].tolist(), step[wanted].tolist(), np.minimum(before, after)[wanted].tolist()):
                    if up > 0 and low_depth < level:
                        if 1 <= low_depth <= length:
                            path[low_depth - 1] = mark_at(text, place, tail)
                    elif up > 0:
                        kind = kinds.get(tuple(path)) if text[place] == 123 else None
                        parts, opens, begin = ([b""] if kind else []), True, place
                    elif parts:
                        parts.append(text[begin:place + 1])
                        if fragments != opens:
                            rows.append((*key, kind, None if opens else False, b"".join(parts)))
                        parts = []
                if parts:
                    parts.append(text[begin:])
                depth = int(after[-1]) if len(after) else depth
                inside ^= quotes % 2 == 1
                tail = (tail + text)[-KEY_BYTES:]
            yield frame(rows)
        if key:
            yield frame(left())
    return run


def _states(scanned: DataFrame, length: int) -> DataFrame:
    """Depth, open containers (``path``) and a key at the very end of the
    block before, for the start of every block; ``opened`` are the containers of
    every block by absolute depth."""
    before = Window.partitionBy("file_path").orderBy("block_start").rowsBetween(Window.unboundedPreceding, -1)
    row = Window.partitionBy("file_path").orderBy("block_start")
    pick = lambda name: F.when(F.col("starts_in"), F.col(f"{name}_in")).otherwise(F.col(f"{name}_out"))
    out = with_start(scanned).withColumn("deeper", pick("deeper")).withColumn("marks", pick("marks"))
    out = out.withColumn("depth", F.coalesce(F.sum("deeper").over(before), F.lit(0)).cast("int"))
    out = out.withColumn("dangling", F.lag("dangling").over(row))
    named = F.transform("marks", lambda m: F.struct(
        (m["depth"] + F.col("depth")).alias("depth"), m["last"].alias("last"),
        F.when(F.substring(m["mark"], 2, 2) == "?", F.concat(F.substring(m["mark"], 1, 1), F.coalesce("dangling", F.lit(""))))
        .otherwise(m["mark"]).alias("mark")))
    out = out.withColumn("opened", named)
    def last_at(d: int) -> Column:
        return F.get(F.filter("opened", lambda m: (m["depth"] == d) & m["last"]), F.lit(0))["mark"]

    for d in range(1, length + 1):
        out = out.withColumn(f"p{d}", F.last(last_at(d), ignorenulls=True).over(before))
    return out.withColumn("path", F.array(*[f"p{d}" for d in range(1, length + 1)]))


def read_elements(spark: SparkSession, file: str, arrays: dict[str, tuple[str, ...]]) -> DataFrame:
    """kind and text (``element``) of every object in the arrays of a JSON
    document; ``arrays`` gives the path of keys to the array of each kind, all
    of one length.  Written to the shared folder by kind, so that the file is
    read once for all kinds.

    A path that the document lacks is a ``KeyError``, an unbalanced document a
    ``ValueError``.  Elements that are not objects are left out.
    """
    length = len(next(iter(arrays.values())))
    scanned = shared_table(pieces(spark, [file], "{").mapInArrow(scan(), SCAN))
    states = shared_table(_states(scanned, length))
    end = states.agg(F.sum("deeper").alias("d"), (F.sum(F.col("after_out").cast("int")) % 2).alias("odd")).first()
    if end.d != 0 or end.odd:
        raise ValueError(f"not a complete JSON document: {file}")
    have = {(r.depth, r.mark) for r in states.select(F.explode("opened").alias("m")).select("m.depth", "m.mark").where(
        F.col("depth") <= length).distinct().collect()}  # keys of the outermost levels
    for path in arrays.values():
        for d, name in enumerate(path, 1):
            if (d, ("[" if d == length else "{") + name) not in have:
                raise KeyError(".".join(path))
    blocks = states.select("file_path", "block_start", "starts_in", "depth", "path", "dangling")

    def cut_rows(fragments: bool) -> DataFrame:
        rows = with_blocks(pieces(spark, [file], "{"), blocks)
        return rows.mapInArrow(cut(arrays, fragments), CUT).withColumn("text", F.col("value").cast("string"))

    found = cut_rows(False).select("kind", F.col("text").alias("element"))
    if states.where(F.col("depth") > length + 1).limit(1).count():  # an element crosses blocks
        found = found.unionByName(joined(cut_rows(True), "", ["kind"]).select("kind", F.col("text").alias("element")))
    return shared_table(found, "kind")
