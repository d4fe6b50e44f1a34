"""Merkle dataset manifest: stored parent-linked nodes and a recursive climb.

Every row is a leaf.  Per source, and then over the sources, each run of 16
consecutive nodes becomes its hash, level by level, until one node is left.
A run is stored as one row that holds the hashes of its members, its own hash
and a link to the run that its own hash is a member of.  To prove or check a
leaf, Spark's recursive query ascends from run to run: it appends the
siblings it meets and folds the hash of each leaf, as it is now, into the
next one.  The leaves of one run meet the same siblings above their run, so
they climb in one row that carries one folded hash for each of them.

Rows are numbered by range-sorted pieces and the sums of the pieces' counts,
so a source of any size is spread over many tasks; no group that is
collected holds more than 16 members.
"""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from civgraph.llm.common import ascii_lower, stored

#: Members of a run, length of a hash as hex text, leaf columns.
FAN = 16
HEX = 64
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def digest(*parts: Column) -> Column:
    return F.sha2(F.concat(*parts), 256)


def field(value: Column) -> Column:
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def row_hash(**instead: Column) -> Column:
    """The leaf of a row; ``instead`` replaces columns."""
    return digest(*[field(instead.get(c, F.col(c))) for c in FIELDS])


def numbered(rows: DataFrame, *order: str) -> DataFrame:
    """``rows`` with ``at``, the place within its ``tree`` by ``order`` (from
    0), and ``n``, the rows of the tree.  Rows that are equal in ``order`` must
    be equal throughout."""
    place = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    placed = stored(rows.repartitionByRange("tree", *order).sortWithinPartitions("tree", *order).select(
        "*", F.spark_partition_id().alias("piece"), place.alias("place")), "placed")
    whole = Window.partitionBy("tree")
    before = whole.orderBy("piece").rowsBetween(Window.unboundedPreceding, -1)
    pieces = placed.groupBy("tree", "piece").agg(F.count("*").alias("rows"), F.min("place").alias("first")).select(
        "tree", "piece", "first", F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("start"),
        F.sum("rows").over(whole).alias("n"))
    return placed.join(pieces, ["tree", "piece"]).withColumn("at", F.expr("start + place - first")).drop(
        "piece", "place", "first", "start")


def run_id(level, run, tree) -> Column:
    return F.concat_ws(":", level, run, tree)


def runs_of(members: DataFrame, level: int, kept: list[str]) -> DataFrame:
    """One row per run of ``members`` (tree, at, n, hash): its members in
    order with the columns ``kept``, their hashes as one text, its own hash
    and, unless it is the last of its tree, its parent and place there."""
    grouped = members.where("n > 1").groupBy("tree", "n", F.expr(f"at div {FAN}").alias("run")).agg(
        F.array_sort(F.collect_list(F.struct("at", "hash", *kept))).alias("members"))
    texts = F.concat_ws("", F.transform("members", lambda m: m["hash"]))
    last = F.col("n") <= FAN
    return grouped.withColumn("hashes", texts).select(
        run_id(F.lit(level), F.col("run"), F.col("tree")).alias("id"), "tree", "run", "n", "members", "hashes",
        F.sha2("hashes", 256).alias("hash"), last.alias("last"),
        F.when(~last, run_id(F.lit(level + 1), F.expr(f"run div {FAN}"), F.col("tree"))).alias("parent"),
        F.when(~last, F.expr(f"cast(run % {FAN} as int)")).alias("slot"))


def levels(leaves: DataFrame, kept: list[str]) -> list[DataFrame]:
    """The written runs of every level above ``leaves``, lowest first."""
    most = leaves.agg(F.max("n")).first()[0] or 0
    out, members, level = [], leaves, 0
    while most > 1:
        out.append(stored(runs_of(members, level, kept), f"level{level}"))
        members = out[-1].select("tree", F.col("run").alias("at"), F.ceil(F.col("n") / FAN).alias("n"), "hash")
        most, level, kept = -(-most // FAN), level + 1, []
    return out


CLIMB = """
WITH RECURSIVE climb(run, parent, slot, hash, subroot, folded, siblings) AS (
  SELECT run, parent, slot, hash, subroot, folded, CAST('' AS STRING) FROM {start}
  UNION ALL
  SELECT c.run, n.parent, n.slot, n.hash, coalesce(c.subroot, n.subroot),
         transform(c.folded, f -> sha2(concat(left(n.hashes, {hex} * c.slot), f, substring(n.hashes, {hex} * (c.slot + 1) + 1)), 256)),
         concat(c.siblings, left(n.hashes, {hex} * c.slot), substring(n.hashes, {hex} * (c.slot + 1) + 1))
  FROM climb c JOIN {nodes} n ON c.parent = n.id)
SELECT run, hash AS root, subroot, folded, siblings FROM climb WHERE parent IS NULL"""


def climbed(start: DataFrame, nodes: DataFrame) -> DataFrame:
    """Ascends from every row of ``start`` to the root by the recursive query."""
    spark, tag = start.sparkSession, uuid.uuid4().hex
    names = {"start": f"merkle_start_{tag}", "nodes": f"merkle_nodes_{tag}"}
    start.createOrReplaceTempView(names["start"])
    nodes.createOrReplaceTempView(names["nodes"])
    try:
        # the recursion is as deep as the trees; its rows are those of the input
        return stored(spark.sql(CLIMB.format(**names, hex=HEX)), "climbed", {"spark.sql.cteRecursionRowLimit": "-1"})
    finally:
        for name in names.values():
            spark.catalog.dropTempView(name)


def manifest(docs: DataFrame, now: Column) -> DataFrame:
    """doc_id, leaf, subroot, root, proof_sha256, folded_root and verified of
    every row of ``docs``.

    ``now`` is the hash that a row has when it is checked (see ``row_hash``);
    null where it is the leaf itself.  Leaves of a source ascend by doc_id,
    null first, then by hash; equal rows are leaves of their own.  Null and
    empty values hash differently, texts are hashed whole, other columns are
    not read.  A lone leaf is its subroot; a lone subroot is the root and the
    proof of a lone row is the hash of nothing.  No rows give no rows.
    """
    tree = F.coalesce(F.concat(F.lit("="), F.col("source")), F.lit("-"))  # null before all texts
    leaves = stored(docs.select(tree.alias("tree"), F.col("doc_id").cast("long").alias("doc_id"), row_hash().alias("hash"),
                                now.alias("now")), "leaves")
    leaves = stored(numbered(leaves, "doc_id", "hash", "now"), "numbered")
    built = levels(leaves, ["doc_id", "now"])
    alone = leaves.where("n = 1")
    lasts = [b.where("last") for b in built]
    subroots = alone.select("tree", "hash")
    for b in lasts:
        subroots = subroots.unionAll(b.select("tree", "hash"))
    tops = stored(numbered(subroots.select(F.lit("").alias("tree"), F.col("tree").alias("of"), "hash"), "of", "hash"), "tops")
    above = levels(tops, [])
    # a source's last run, or lone leaf, is a member of a run of subroots, if there are several
    links = tops.select(F.col("of").alias("tree"), F.when(F.col("n") > 1, run_id(
        F.lit(0), F.expr(f"at div {FAN}"), F.lit(""))).alias("up"), F.expr(f"cast(at % {FAN} as int)").alias("up_slot"))
    linked = [b.where("NOT last").select("id", "parent", "slot", "hash", "hashes", F.lit(None).cast("string").alias("subroot"))
              .unionAll(b.where("last").join(links, "tree").select(
                  "id", F.col("up").alias("parent"), F.col("up_slot").alias("slot"), "hash", "hashes",
                  F.col("hash").alias("subroot"))) for b in built]
    linked += [b.select("id", "parent", "slot", "hash", "hashes", F.lit(None).cast("string").alias("subroot")) for b in above]

    def fold(m: Column, i: Column) -> Column:
        return digest(F.left("hashes", i * HEX), F.coalesce(m["now"], m["hash"]),
                      F.substring(F.col("hashes"), (i + 1) * HEX + 1, F.length("hashes")))

    members = "array<struct<at:bigint,hash:string,doc_id:bigint,now:string>>"
    lone = alone.join(links, "tree").select(
        F.concat(F.lit("leaf:"), "tree").alias("run"), F.col("up").alias("parent"), F.col("up_slot").alias("slot"), "hash",
        F.col("hash").alias("subroot"), F.array(F.coalesce("now", "hash")).alias("folded"),
        F.array(F.struct("at", "hash", "doc_id", "now")).cast(members).alias("members"), F.col("hash").alias("hashes"))
    nodes = stored(reduce(DataFrame.unionAll, linked), "nodes") if linked else None
    start = lone
    if built:
        first = built[0].select("id", F.col("members").cast(members).alias("members")).join(nodes, "id").select(
            F.col("id").alias("run"), "parent", "slot", "hash", "subroot", F.transform("members", fold).alias("folded"),
            "members", "hashes")
        start = start.unionAll(first)
    start = stored(start, "start")
    if nodes is None:  # one leaf or none
        found = start.select("run", F.col("hash").alias("root"), "subroot", "folded", F.lit("").alias("siblings"))
    else:
        found = climbed(start.drop("members", "hashes"), nodes)
    one = start.select("run", "members", "hashes").join(found, "run").select(
        "hashes", "siblings", "root", "subroot", "folded", F.posexplode("members").alias("i", "m"))
    others = [F.left("hashes", F.col("i") * HEX), F.substring(F.col("hashes"), (F.col("i") + 1) * HEX + 1, F.length("hashes"))]
    folded = F.element_at("folded", F.col("i") + 1)
    return one.select(
        F.col("m.doc_id").alias("doc_id"), F.col("m.hash").alias("leaf"), "subroot", "root",
        digest(*others, F.col("siblings")).alias("proof_sha256"), folded.alias("folded_root"),
        (folded == F.col("root")).alias("verified"))


def manifest_digest(docs: DataFrame) -> DataFrame:
    """The manifest checked against rows whose text was lower-cased (A-Z)
    where 5 divides the crc32 of the doc_id."""
    changed = F.crc32(F.col("doc_id").cast("string")) % 5 == 0
    return manifest(docs, F.when(changed, row_hash(text=ascii_lower(F.col("text")))))
