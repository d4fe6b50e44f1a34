"""Chat formatting as a prefix tree of turns.

Template (fixed values): a turn is ``<|role|>\\n`` text ``<|end|>\\n``.  Control
strings inside roles and texts are escaped with a backslash, and so are
backslashes, so that the original text comes back.

Conversations that share their first turns share the tree nodes of these
turns.  Every node is emitted once, in depth-first order.  It carries its
position (code points of its ancestors, where its own position ids start), its
offset in the depth-first layout, and the layout intervals of its ancestors,
which are all that its code points may attend to besides themselves.

With a tokenizer a node also has its token ids and the same places counted in
tokens.  Head, text and end of a turn are encoded one by one, so that no token
crosses their borders and a node has the same ids in every conversation.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from civgraph.llm.common import stored
from civgraph.llm.simple8b import _encoder

# Control strings that a text must not bring along
# (the first character, which a backslash follows, and the rest)
CONTROL = r"(<(?=\||/s>)|\|(?=>)|\[(?=/?INST\]))"
END = "<|end|>\n"
TRAINED = "assistant"


def escape(c: Column) -> Column:
    """Backslashes are doubled; one goes after the first character of a control string."""
    doubled = F.replace(c, F.lit("\\"), F.lit("\\\\"))
    return F.regexp_replace(doubled, CONTROL, "$1\\\\")


def unescape(c: Column) -> Column:
    return F.regexp_replace(c, r"(?s)\\(.)", "$1")


def conversation_paths(turns: DataFrame) -> DataFrame:
    """One row per conversation: conv_id and its turns in order, each with
    its formatted text and the identity of its tree node.

    Rows of one turn are ordered by role and text; null roles and texts are
    empty.  A node's identity is a hash chain over the formatted turns.
    """
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    row = F.struct(F.col("turn").isNotNull().alias("known"), F.col("turn"), role.alias("role"), text.alias("text"))
    conversations = turns.groupBy("conv_id").agg(F.array_sort(F.collect_list(row)).alias("rows"))

    def formatted(t):
        head = F.concat(F.lit("<|"), escape(t["role"]), F.lit("|>\n"))
        body = escape(t["text"])
        return F.struct(F.concat(head, body, F.lit(END)).alias("segment"),
                        F.when(t["role"] == TRAINED, F.length(head)).alias("loss_from"),
                        F.when(t["role"] == TRAINED, F.length(head) + F.length(body)).alias("loss_to"))

    def chain(acc, t):
        node = F.md5(F.concat(acc["node"], t["segment"]).cast("binary"))
        at = acc["at"] + F.length(t["segment"])
        step = F.struct(node.alias("node"), acc["node"].alias("parent"), acc["at"].cast("long").alias("position"),
                        t["segment"].alias("segment"), t["loss_from"].alias("loss_from"), t["loss_to"].alias("loss_to"))
        return F.struct(node.alias("node"), at.alias("at"), F.concat(acc["path"], F.array(step)).alias("path"))

    step_type = ("array<struct<node:string,parent:string,position:bigint,segment:string,"
                 "loss_from:int,loss_to:int>>")
    start = F.struct(F.lit("").alias("node"), F.lit(0).cast("long").alias("at"),
                     F.array().cast(step_type).alias("path"))
    return conversations.select("conv_id", F.transform("rows", formatted).alias("rows")).select(
        "conv_id", F.aggregate("rows", start, chain, lambda a: a["path"]).alias("path"))


def _tokenized(nodes: DataFrame, tokenizer: str) -> DataFrame:
    """Adds token_ids, and the loss interval of the node in tokens."""
    added = "token_ids array<int>, token_loss_from int, token_loss_to int"
    names = [*nodes.columns, "token_ids", "token_loss_from", "token_loss_to"]
    at, trained = nodes.columns.index("segment"), nodes.columns.index("loss_from")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(tokenizer, 0)

        def ids(texts: list[str]) -> list[np.ndarray]:
            return [x[:-1] for x in encoder.encode(texts)]  # without the end id

        end, = ids([END])
        for batch in batches:
            for begin in range(0, batch.num_rows, 128):
                some = batch.slice(begin, 128)
                texts = some.column(at).to_pylist()
                split = [s.index("|>\n", 2) + 3 for s in texts]  # a role cannot hold it: it is escaped
                heads = ids([s[:k] for s, k in zip(texts, split)])
                bodies = ids([s[k:-len(END)] for s, k in zip(texts, split)])
                sizes = np.array([len(h) + len(b) + len(end) for h, b in zip(heads, bodies)])
                found = pa.ListArray.from_arrays(
                    pa.array(np.append(0, sizes.cumsum()), pa.int32()),
                    pa.array(np.concatenate([x for h, b in zip(heads, bodies) for x in (h, b, end)]).astype(np.int32)))
                other = np.array([x is None for x in some.column(trained).to_pylist()])
                first = np.array([len(h) for h in heads])
                yield pa.RecordBatch.from_arrays([
                    *some.columns, found, pa.array(first, pa.int32(), mask=other),
                    pa.array(sizes - len(end), pa.int32(), mask=other)], names)

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in nodes.schema)
    return nodes.mapInArrow(run, f"{fields}, {added}")


def write_tree(turns: DataFrame, path: str, tokenizer: str | None = None) -> None:
    """Write ``path``/nodes (the tree, every node once, files and rows in
    depth-first order) and ``path``/conversations (conv_id and its nodes).

    With the file of a tokenizer, nodes also have token_ids, token_position,
    token_offset, token_loss_from, token_loss_to and token_attend.

    Conversations are ordered by their chains of node identities; a node
    belongs to the first conversation that has it, and the order of
    (conversation, depth) is depth-first.  Layout offsets are prefix sums of
    lengths over range partitions, so no tree or hot root is in one task.
    """
    none = F.array().cast("array<struct<from:bigint,to:bigint>>")
    chain = F.concat_ws("", F.transform("path", lambda s: F.substring(s["node"], 1, 16)))
    ordered = conversation_paths(turns).withColumn("chain", chain).repartitionByRange("chain", "conv_id")
    paths = stored(ordered.sortWithinPartitions("chain", "conv_id").withColumn(
        "rank", F.monotonically_increasing_id()).drop("chain"), "paths")
    conversations = paths.select("conv_id", F.transform("path", lambda s: s["node"]).alias("nodes"))
    conversations.write.parquet(f"{path}/conversations")

    # equal nodes are merged before they are shuffled
    nodes = paths.select("rank", F.posexplode("path").alias("depth", "s")).groupBy(F.col("s.node").alias("node")).agg(
        F.min(F.struct("rank", "depth", "s.parent", "s.position", "s.segment", "s.loss_from", "s.loss_to")).alias(
            "n")).select("node", "n.*")
    in_order = nodes.repartitionByRange("rank", "depth").sortWithinPartitions("rank", "depth")
    if tokenizer:
        in_order = _tokenized(in_order, tokenizer)
    # (offset, size) of a node by code points and by tokens
    units = [("offset", "size"), ("token_offset", "token_size")][:2 if tokenizer else 1]
    if tokenizer:
        in_order = in_order.withColumn("token_size", F.size("token_ids").cast("long"))
    placed = stored(in_order.withColumn("part", F.spark_partition_id()).withColumn(
        "size", F.length("segment").cast("long")), "ordered")
    parts = placed.groupBy("part").agg(*[F.sum(size).alias(f"{at}_total") for at, size in units])
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = parts.select("part", *[F.coalesce(F.sum(f"{at}_total").over(before), F.lit(0)).alias(f"{at}_start")
                                    for at, _ in units])
    running = Window.partitionBy("part").orderBy("rank", "depth").rowsBetween(Window.unboundedPreceding, -1)
    laid = placed.withColumns({at: F.coalesce(F.sum(size).over(running), F.lit(0)) for at, size in units}).join(
        F.broadcast(starts), "part").withColumns({at: F.col(at) + F.col(f"{at}_start") for at, _ in units})
    laid = stored(laid.drop("part", *[f"{at}_start" for at, _ in units]), "laid")

    # ancestors that follow each other in the layout are one interval: a node
    # has as many as its way from the root leaves the first child
    steps = paths.select("rank", F.posexplode(F.transform("path", lambda s: s["node"])).alias("at", "node")).join(
        laid.select("node", *sum(units, ())), "node").groupBy("rank").agg(F.array_sort(F.collect_list(
            F.struct("at", "node", *sum(units, ())))).alias("steps"))

    def follow(acc, s, at, size):
        end = s[at] + s[size]
        opened = F.when(acc["to"] > acc["from"], F.array(F.struct(acc["from"].alias("from"), acc["to"].alias("to")))
                        ).otherwise(none)
        attend = F.concat(acc["closed"], opened)
        goes_on = s[at] == acc["to"]
        return F.struct(
            F.when(goes_on, acc["closed"]).otherwise(attend).alias("closed"),
            F.when(goes_on, acc["from"]).otherwise(s[at]).alias("from"), end.alias("to"),
            F.concat(acc["out"], F.array(F.struct(s["node"].alias("node"), attend.alias("attend")))).alias("out"))

    out = F.array().cast("array<struct<node:string,attend:array<struct<from:bigint,to:bigint>>>>")
    nothing = F.lit(-1).cast("long")
    begin = F.struct(none.alias("closed"), nothing.alias("from"), nothing.alias("to"), out.alias("out"))
    def way(unit):
        return F.aggregate("steps", begin, lambda acc, s: follow(acc, s, *unit), lambda a: a["out"])

    attended = steps.select(F.explode(F.arrays_zip(*[way(u).alias(u[0]) for u in units])).alias("o"))
    attended = attended.groupBy(F.col("o.offset.node").alias("node")).agg(
        *[F.max(f"o.{at}.attend").alias(f"{at}_attend") for at, _ in units]).withColumnRenamed("offset_attend", "attend")
    columns = ["node", "parent", "depth", "position", "offset", "segment", "loss_from", "loss_to", "attend"]
    out = laid.join(attended, "node")
    if tokenizer:  # the ancestors are what comes before a node in its conversation
        out = out.withColumnRenamed("token_offset_attend", "token_attend").withColumn("token_position", F.aggregate(
            "token_attend", F.lit(0).cast("long"), lambda n, x: n + x["to"] - x["from"]))
        columns += ["token_ids", "token_position", "token_offset", "token_loss_from", "token_loss_to", "token_attend"]
    out.select(columns).repartitionByRange("offset").sortWithinPartitions("offset").write.parquet(f"{path}/nodes")


def read_conversations(spark, path: str) -> DataFrame:
    """conv_id, formatted and loss (code point intervals), put together from
    the tree: every conversation asks for its nodes, and a node that many ask
    for is the small side of a join that Spark can split."""
    wanted = spark.read.parquet(f"{path}/conversations").select("conv_id", F.posexplode("nodes").alias("at", "node"))
    nodes = spark.read.parquet(f"{path}/nodes").select("node", "position", "segment", "loss_from", "loss_to")
    whole = wanted.join(nodes, "node").groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct(
        "at", "position", "segment", "loss_from", "loss_to"))).alias("steps"))
    trained = F.filter("steps", lambda s: s["loss_from"].isNotNull())
    return whole.select(
        "conv_id", F.concat_ws("", F.transform("steps", lambda s: s["segment"])).alias("formatted"),
        F.transform(trained, lambda s: F.struct((s["position"] + s["loss_from"]).alias("from"),
                                                (s["position"] + s["loss_to"]).alias("to"))).alias("loss"))


def formatted_turns(formatted: Column) -> Column:
    """Array of (role, text), parsed back from a formatted conversation."""
    segments = F.filter(F.split(formatted, r"<\|end\|>\n"), lambda s: s != "")
    return F.transform(segments, lambda s: F.struct(
        unescape(F.regexp_extract(s, r"(?s)^<\|(.*?)\|>\n", 1)).alias("role"),
        unescape(F.regexp_replace(s, r"(?s)^<\|.*?\|>\n", "")).alias("text")))


def chat_digest(conversations: DataFrame, path: str, tokenizer: str | None = None) -> DataFrame:
    spark = conversations.sparkSession
    write_tree(conversations.select(F.col("conv_id").cast("long").alias("conv_id"), "turn", "role", "text"), path, tokenizer)
    back = read_conversations(spark, path).withColumn("turns", formatted_turns(F.col("formatted")))
    plain = F.concat_ws("", F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))))
    learnt = F.concat_ws("", F.transform("loss", lambda s: unescape(F.substring(
        F.col("formatted"), (s["from"] + 1).cast("int"), (s["to"] - s["from"]).cast("int")))))
    return back.select(
        "conv_id", F.size("turns").cast("long").alias("n_turns"),
        F.sha2(plain.cast("binary"), 256).alias("turns_sha256"),
        F.length(learnt).cast("long").alias("loss_chars"), F.sha2(learnt.cast("binary"), 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"))


def with_probe(conversations: DataFrame) -> DataFrame:
    """Conversation -1: a user and an assistant row that hold control strings."""
    text = "</s>[INST] ok [/INST]"
    probe = conversations.sparkSession.range(2).select(
        F.lit(-1).cast("long").alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(text).alias("text"))
    return conversations.select("conv_id", "turn", "role", "text").unionByName(probe)
