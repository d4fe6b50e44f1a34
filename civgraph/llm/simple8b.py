"""Token ids of documents in a Simple-8b file format.

Format.  A dataset is a folder of Parquet files, used as containers that
Spark commits per task.  A row is a block of whole documents::

    part, start   order of the block: parts ascending; ids before it in its part
    doc_ids       ids of its documents, ascending
    doc_starts    index of each document's first id within the block
    n_ids         number of token ids
    words         little-endian 64-bit words: 4 selector bits, 60 data bits
    word_starts   index of the first id of every 128th word, so that readers
                  can decode any stretch of a block without the words before
    escapes       little-endian 64-bit ids too large for 60 bits

A selector says how many ids a word holds and their width; the first id has
the lowest bits.  Selector 0 is the escape: the data bits index ``escapes``.
"""

from __future__ import annotations

import re
import struct
import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from civgraph.llm.common import writing

# Ids per word and bits per id of selectors 1 to 14
COUNTS = (60, 30, 20, 15, 12, 10, 8, 7, 6, 5, 4, 3, 2, 1)
WIDTHS = (1, 2, 3, 4, 5, 6, 7, 8, 10, 12, 15, 20, 30, 60)
WORD_STEP = 128
BLOCK_IDS = 1 << 16
CACHE_PIECES = 300_000
LONG_PIECE = 256
GROUP = 512  # texts encoded together
LONE_MARKS = "([a-z\u00df-\u00f6\u00f8-\u00ff])([.,!?;:#$%&*]+) "
LATIN = re.compile("[\x00-\u012f\u0131-\u017f]*")  # letters with a lower case of one letter in any context

SCHEMA = ("part int, start long, doc_ids array<long>, doc_starts array<long>, n_ids long, "
          "words binary, word_starts array<long>, escapes binary")


def pack(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Words, index of the first id of each word, and escaped ids.

    At each id the word takes as many ids as fit; which counts fit is known
    for all positions at once from the places of the ids that are narrow enough.
    """
    ids = np.ascontiguousarray(ids, dtype=np.uint64)
    n = len(ids)
    choice = np.zeros(n, dtype=np.uint8)  # 0: escape
    needs = np.searchsorted(np.array([1 << w for w in WIDTHS], dtype=np.uint64), ids, side="right").astype(np.uint8)
    for s in range(len(COUNTS), 0, -1):
        count = COUNTS[s - 1]
        narrow = np.flatnonzero(needs < s)
        # past the end: zeros, cut off by n_ids
        last = np.append(narrow, np.arange(n, n + count - 1))[count - 1:count - 1 + len(narrow)]
        choice[narrow[last - narrow == count - 1]] = s
    step = np.array((1, *COUNTS))[choice].tolist()
    at, starts = 0, []
    while at < n:
        starts.append(at)
        at += step[at]
    starts = np.array(starts, dtype=np.int64)
    used = choice[starts] if n else choice
    words = used.astype(np.uint64) << np.uint64(60)
    padded = np.concatenate([ids, np.zeros(COUNTS[0], dtype=np.uint64)])
    for s, (count, width) in enumerate(zip(COUNTS, WIDTHS), 1):
        mine = np.flatnonzero(used == s)
        if len(mine):
            first = starts[mine]
            data = np.zeros(len(mine), dtype=np.uint64)
            for j in range(count):
                data |= padded[first + j] << np.uint64(j * width)
            words[mine] |= data
    escaped = np.flatnonzero(used == 0)
    words[escaped] = np.arange(len(escaped), dtype=np.uint64)
    return words, starts, ids[starts[escaped]] if n else ids


def unpack(words: np.ndarray, n_ids: int, escapes: np.ndarray) -> np.ndarray:
    """The ids, decoded selector by selector."""
    selector = (words >> np.uint64(60)).astype(np.int64)
    counts = np.array((1, *COUNTS))[selector]
    first = np.cumsum(counts) - counts
    out = np.zeros(int(counts.sum()), dtype=np.uint64)
    for s, (count, width) in enumerate(zip(COUNTS, WIDTHS), 1):
        mine = np.flatnonzero(selector == s)
        if len(mine):
            mask = np.uint64((1 << width) - 1)
            for j in range(count):
                out[first[mine] + j] = words[mine] >> np.uint64(j * width) & mask
    mine = np.flatnonzero(selector == 0)
    out[first[mine]] = escapes[words[mine].astype(np.int64)]
    return out[:n_ids]


class _PieceEncoder:
    """Whole texts to token ids, each distinct piece encoded once per task.

    Only for tokenizers whose pre-tokenizer drops white space, as pieces
    between blanks and line breaks are then encoded independently; others
    encode whole texts.  The pieces kept are bounded in number and length: once
    half of the bound is new, what was not used since the last such time goes.
    """

    def __init__(self, path: str, end_id: int):
        import json

        from tokenizers import Tokenizer, pre_tokenizers

        self.tokenizer = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        steps = (spec.get("pre_tokenizer") or {}).get("pretokenizers", [])
        lowers = "Lowercase" in json.dumps(spec.get("normalizer"))
        first = steps[0] if steps else {}
        drops_space = first.get("behavior") == "Removed" and r"[^\s" in first["pattern"].get("Regex", "")
        self.by_piece = lowers and drops_space
        # a run of small Latin letters is no longer changed, but for its bytes
        self.by_model = self.by_piece and [x["type"] for x in spec["normalizer"].get("normalizers", [])] == [
            "NFC", "Replace", "Lowercase"] and [x["type"] for x in steps[1:]] == ["ByteLevel"]
        if self.by_model:
            as_bytes = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False).pre_tokenize_str
            self.spelled = {c: as_bytes(chr(c))[0][0] for c in range(0x80, 0x180)}
        self.end = end_id
        self.known: dict[str, bytes] = {"": b""}
        self.older: dict[str, bytes] = {}

    def _ids(self, texts: list[str]) -> list[bytes]:
        return [np.array(e.ids, dtype="<u4").tobytes()
                for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _letters(self, pieces: list[str]) -> list[bytes]:
        """Runs of small Latin letters, for which only the model is left to do."""
        tokenize, pack_ = self.tokenizer.model.tokenize, struct.Struct
        out = []
        for p in pieces:
            ids = [t.id for t in tokenize(p if p.isascii() else p.translate(self.spelled))]
            out.append(pack_(f"<{len(ids)}I").pack(*ids))
        return out

    def _learn(self, new: list[str]) -> None:
        plain = [p for p in new if self.by_model and p.isalpha() and p.islower() and len(p) <= LONG_PIECE
                 and LATIN.fullmatch(p)]
        rest = list(set(new).difference(plain))
        self.known.update(zip(plain, self._letters(plain)))
        self.known.update(zip(rest, self._ids(rest)))

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """The ids of every text and the end id."""
        if not self.by_piece or not texts:
            return [np.append(np.frombuffer(b, dtype="<u4"), np.uint32(self.end)) for b in self._ids(texts)]
        # the tokenizer lower-cases each letter of a text, but not its special
        # strings; marks between a letter and a blank are a run of their own
        lower = pa.array([(t.lower() if LATIN.fullmatch(t) and "<|" not in t else t).replace("\n", " ") for t in texts],
                         pa.large_string())
        split = pc.split_pattern(pc.replace_substring_regex(lower, LONE_MARKS, r"\1 \2 "), " ")
        coded = split.values.dictionary_encode()
        pieces, places = coded.dictionary.to_numpy(zero_copy_only=False).tolist(), coded.indices.to_numpy()
        if len(self.known) > CACHE_PIECES // 2:
            self.older, self.known = self.known, {"": b""}
        new = [p for p in pieces if p not in self.known]
        self.known.update((p, self.older[p]) for p in new if p in self.older)
        self._learn([p for p in new if p not in self.older])
        ids = [self.known[p] for p in pieces]
        for p in new:
            if len(p) > LONG_PIECE:
                del self.known[p]
        lengths = np.fromiter(map(len, ids), dtype=np.int64, count=len(ids)) // 4
        firsts, each = (np.cumsum(lengths) - lengths)[places], lengths[places]
        upto = np.append(0, np.cumsum(each))
        flat = np.frombuffer(b"".join(ids), dtype="<u4")[
            np.repeat(firsts - upto[:-1], each) + np.arange(upto[-1])]
        ends = upto[split.offsets.to_numpy()]
        return np.split(np.insert(flat, ends[1:], self.end), (ends[1:] + np.arange(1, len(ends)))[:-1])


def _encoder(path: str, end_id: int) -> _PieceEncoder:
    """The encoder of this Python worker; Spark reuses workers for many tasks."""
    held = vars(sys).setdefault("_piece_encoders", {})
    if (path, end_id) not in held:
        held.clear()
        held[path, end_id] = _PieceEncoder(path, end_id)
    return held[path, end_id]


def _blocks(batches: Iterator[pa.RecordBatch], path: str, end_id: int) -> Iterator[pa.RecordBatch]:
    from pyspark import TaskContext

    encoder, part = _encoder(path, end_id), TaskContext.get().partitionId()
    fields = pa.schema([("part", pa.int32()), ("start", pa.int64()), ("doc_ids", pa.list_(pa.int64())),
                        ("doc_starts", pa.list_(pa.int64())), ("n_ids", pa.int64()), ("words", pa.binary()),
                        ("word_starts", pa.list_(pa.int64())), ("escapes", pa.binary())])
    start, held, docs, starts, n = 0, [], [], [], 0

    def flush():
        words, firsts, escapes = pack(np.concatenate(held))
        return pa.RecordBatch.from_pylist([{
            "part": part, "start": start, "doc_ids": docs, "doc_starts": starts, "n_ids": n,
            "words": words.astype("<u8").tobytes(), "word_starts": firsts[::WORD_STEP].tolist(),
            "escapes": escapes.astype("<u8").tobytes()}], schema=fields)

    for batch in batches:
        ids, texts = batch.column(0).to_pylist(), batch.column(1)
        for at in range(0, len(ids), GROUP):
            some = [t or "" for t in texts.slice(at, GROUP).to_pylist()]
            for doc, tokens in zip(ids[at:at + GROUP], encoder.encode(some)):
                docs.append(doc)
                starts.append(n)
                held.append(tokens)
                n += len(tokens)
                if n >= BLOCK_IDS:
                    yield flush()
                    start, held, docs, starts, n = start + n, [], [], [], 0
    if docs:
        yield flush()


def write_tokens(documents: DataFrame, path: str, tokenizer: str, end_id: int) -> None:
    """Encode every whole text (null: empty) plus the end id and write the
    dataset at ``path`` in ascending doc_id order.

    Null ids come first; rows with one id are ordered by a hash of their text,
    so a much-repeated id spreads over parts.  An empty table writes no block.
    """
    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    order = [F.col("doc_id").asc_nulls_first(), F.xxhash64(F.coalesce("text", F.lit(""))).asc()]
    ranged = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    with writing(documents.sparkSession):
        ranged.mapInArrow(lambda b: _blocks(b, tokenizer, end_id), SCHEMA).write.parquet(path)


def _documents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for i in range(batch.num_rows):
            row = batch.slice(i, 1).to_pylist()[0]
            ids = unpack(np.frombuffer(row["words"], dtype="<u8"), row["n_ids"],
                         np.frombuffer(row["escapes"], dtype="<u8"))
            raw, starts = ids.astype("<u4").tobytes(), row["doc_starts"]
            ends = [*starts[1:], row["n_ids"]]
            yield pa.RecordBatch.from_pydict({
                "doc_id": pa.array(row["doc_ids"], pa.int64()),
                "start": pa.array([row["__base"] + row["start"] + s for s in starts], pa.int64()),
                "n_tokens": pa.array([e - s for s, e in zip(starts, ends)], pa.int64()),
                "ids": pa.array([raw[4 * s:4 * e] for s, e in zip(starts, ends)], pa.binary())})


def read_tokens(spark: SparkSession, path: str) -> DataFrame:
    """Documents of a dataset: doc_id, start (ids before it in the dataset),
    n_tokens and ids (little-endian 32-bit)."""
    blocks = spark.read.schema(SCHEMA).parquet(path)
    parts = blocks.groupBy("part").agg(F.sum("n_ids").alias("part_ids"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    # one row per part: as many as the writing job had tasks
    parts = parts.select("part", F.coalesce(F.sum("part_ids").over(before), F.lit(0)).alias("__base"))
    return blocks.join(F.broadcast(parts), "part").mapInArrow(
        _documents, "doc_id long, start long, n_tokens long, ids binary")


def token_digest(documents: DataFrame, path: str, tokenizer: str, end_id: int = 2) -> DataFrame:
    write_tokens(documents, path, tokenizer, end_id)
    return read_tokens(documents.sparkSession, path).select(
        "doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))
