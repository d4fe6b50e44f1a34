"""Graph export operators: typed node / relationship frames (N*, E*), the
endpoint-integrity check (J08), the import manifest (K05) and CSV writing (K02).

Node and relationship frames use the bulk-import header convention:
``name:ID(Label)`` for node ids, ``:START_ID(A)`` / ``:END_ID(B)`` for
relationship endpoints and ``name:type`` for typed properties.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from civgraph.functions.columns import col_
from civgraph.functions.names import graph_end, graph_id, graph_start, typed
from civgraph.sources.files import list_files


def node(df: DataFrame, id_col: str | Column, label: str, id_name: str | None = None,
         props: Mapping[str, str | Column] | None = None,
         types: Mapping[str, str] | None = None) -> DataFrame:
    """Node frame: ``<id_name>:ID(<label>)`` then properties.

    ``props`` maps output name -> source column/expression; ``types`` maps an
    output name to a graph type suffix (``double``, ``date`` ...), producing a
    header such as ``montant:double``.
    """
    id_name = id_name or (id_col if isinstance(id_col, str) else "id")
    types = dict(types or {})
    cols = [col_(id_col).alias(graph_id(id_name, label))]
    for name, src in (props or {}).items():
        header = typed(name, types[name]) if name in types else name
        cols.append(col_(src).alias(header))
    return df.select(*cols)


def edge(df: DataFrame, start: str | Column, start_label: str,
         end: str | Column, end_label: str) -> DataFrame:
    """Relationship frame with the endpoint columns only; no existence check
    (E01, E11-E14 keep NULL or dangling endpoints, as the reference does)."""
    return df.select(col_(start).alias(graph_start(start_label)),
                     col_(end).alias(graph_end(end_label)))


def keep_existing(df: DataFrame, key: str, nodes: DataFrame, node_key: str) -> DataFrame:
    """Rows of ``df`` whose ``key`` exists in ``nodes``.

    The reference writes ``LEFT JOIN … WHERE right.key IS NOT NULL``; with a
    unique node key that is exactly a LEFT SEMI join, which never duplicates
    rows and ships only the key column of the node side.  NULL keys are
    filtered first so they never reach the shuffle (a NULL-key hot spot is
    the classic skew in this data).
    """
    keys = nodes.select(F.col(node_key).alias("__nk")).filter(F.col("__nk").isNotNull())
    return (df.filter(F.col(key).isNotNull())
              .join(keys, F.col(key) == F.col("__nk"), "left_semi"))


def edge_existing(df: DataFrame, start: str, start_label: str, end: str, end_label: str,
                  nodes: DataFrame, node_key: str, check: str = "start") -> DataFrame:
    """Relationship whose ``check`` endpoint must exist among ``nodes``."""
    side = start if check == "start" else end
    return edge(keep_existing(df, side, nodes, node_key), start, start_label, end, end_label)


def edge_typed(df: DataFrame, key: str, dim: DataFrame, dim_key: str, type_col: str,
               types: Sequence[str], start: str, start_label: str, end_label: str,
               end: str | None = None, bounded: bool = False) -> DataFrame:
    """Relationship to the dimension rows of the given ``types``.

    Reference form: ``LEFT JOIN dim … WHERE dim.type IN (…) AND key IS NOT
    NULL`` — null-rejecting, so an inner join on the pre-filtered dimension.
    A key present under two types (e.g. COM and COMD) yields one edge per
    matching dimension row; edges are not deduplicated.
    """
    end = end or dim_key
    right = dim.filter(F.col(type_col).isin(list(types))).select(
        F.col(dim_key).alias("__dk"), F.col(end).alias("__end"))
    if bounded:
        right = F.broadcast(right)
    joined = df.filter(F.col(key).isNotNull()).join(right, F.col(key) == F.col("__dk"), "inner")
    return edge(joined, start, start_label, "__end", end_label)


# --- J08 -------------------------------------------------------------------
def dangling(df: DataFrame, key: str, nodes: DataFrame, node_key: str) -> DataFrame:
    """Rows of ``df`` whose ``key`` has no node (NULL keys count as dangling).
    NULL keys are spread over many reducers (they can never match)."""
    from civgraph.operators.relational import spread_null_key
    keys = nodes.select(F.col(node_key).alias("__nk")).filter(F.col("__nk").isNotNull())
    left = spread_null_key(df, key, "__dk")
    return left.join(keys, F.col("__dk") == F.col("__nk"), "left_anti").drop("__dk")


def dangling_counts(df: DataFrame, key: str, nodes: DataFrame, node_key: str, out: str = "n") -> DataFrame:
    """(key, n): rows per key that has no node.  Rows are counted per key
    first (partial aggregation), so a hot key is one row per task before any
    join."""
    keys = nodes.select(F.col(node_key).alias("__nk")).filter(F.col("__nk").isNotNull())
    counted = df.groupBy(key).agg(F.count(F.lit(1)).alias(out))
    return counted.join(keys, F.col(key) == F.col("__nk"), "left_anti")


def integrity_report(relationships: Mapping[str, DataFrame],
                     nodes: Mapping[str, DataFrame]) -> DataFrame:
    """Dangling endpoint count per relationship and side.

    ``nodes`` maps an id space (label) to its node frame; the label of each
    endpoint is read from the relationship header.  Node ids and endpoints of
    all spaces whose ids have one type are stacked and aggregated once per id:
    whether there is a node, and a count per endpoint.  Ids keep their type and
    meet in the aggregate, so there is no join; it is partial first, so a hot id
    or NULL (which has no node) is one row per task.  Each relationship is
    scanned once, unless its two ends have ids of different types.
    """
    def id_column(frame: DataFrame) -> str:
        return next(c for c in frame.columns if ":ID(" in c)

    ends: list[tuple[str, str, str, str]] = []  # relationship, side, id space, column
    for name, rel in relationships.items():
        for c in rel.columns:
            if c.startswith((":START_ID(", ":END_ID(")):
                ends.append((name, "start" if c.startswith(":START") else "end", c[c.index("(") + 1:-1], c))
    spaces = sorted({label for _, _, label, _ in ends})
    place = {label: i for i, label in enumerate(spaces)}
    slot, used = {}, dict.fromkeys(spaces, 0)  # a number for every endpoint within its space
    for end in ends:
        slot[end] = used[end[2]]
        used[end[2]] += 1
    id_types = {label: nodes[label].schema[id_column(nodes[label])].dataType for label in spaces}
    by_type: dict[str, list[str]] = {}
    for label in spaces:
        met = [relationships[r].schema[c].dataType for r, _, space, c in ends if space == label]
        same = all(t == id_types[label] for t in met)
        by_type.setdefault(id_types[label].simpleString() if same else "string", []).append(label)

    def item(label: str, number: int, ident: Column, id_type: str) -> Column:
        return F.struct(F.lit(place[label]).alias("space"), F.lit(number).alias("slot"), ident.cast(id_type).alias("id"))

    counted = []
    for id_type, labels in by_type.items():
        parts = [nodes[label].select(item(label, -1, F.col(f"`{id_column(nodes[label])}`"), id_type).alias("x")).where(
            "x.id IS NOT NULL") for label in labels]
        for name, rel in relationships.items():
            own = [e for e in ends if e[0] == name and e[2] in labels]
            if own:
                points = [item(e[2], slot[e], F.col(f"`{e[3]}`"), id_type) for e in own]
                parts.append(rel.select(F.explode(F.array(*points)).alias("x")))
        width = max(used[label] for label in labels)
        per_id = reduce(lambda a, b: a.unionAll(b), parts).select("x.*").groupBy("space", "id").agg(
            F.max(F.col("slot") < 0).alias("node"), *[F.count_if(F.col("slot") == k).alias(f"n{k}") for k in range(width)])
        sums = per_id.where("NOT node").groupBy("space").agg(*[F.sum(f"n{k}").alias(f"n{k}") for k in range(width)])
        counted.append(sums.select("space", F.posexplode(F.array(*[f"n{k}" for k in range(width)])).alias("slot", "dangling")))
    found = reduce(lambda a, b: a.unionAll(b), counted)
    every = found.sparkSession.createDataFrame(  # one row per endpoint: those without a miss are listed too
        [(*e[:3], place[e[2]], slot[e]) for e in ends], "relationship string, side string, id_space string, space int, slot int")
    return F.broadcast(every).join(found, ["space", "slot"], "left").groupBy("relationship", "side", "id_space").agg(
        F.coalesce(F.sum("dangling"), F.lit(0)).alias("dangling"))


# --- K05 -------------------------------------------------------------------
MANIFEST_SCHEMA = T.StructType([
    T.StructField("kind", T.StringType(), False),
    T.StructField("label", T.StringType(), False),
    T.StructField("path", T.StringType(), False),
    T.StructField("argument", T.StringType(), False),
])


def manifest(spark: SparkSession, nodes: Mapping[str, str], relationships: Mapping[str, str]) -> DataFrame:
    """Import manifest: ``--nodes=<label>=<file>`` for every node file and
    ``--relationships=<type>=<file>`` for every relationship file; label and
    type are the base name.  The parts of a written folder are listed after its
    commit, one argument each: every part carries the header, so each is a
    file that the importer takes by itself."""
    rows = []
    for kind, paths, option in (("node", nodes, "--nodes"), ("relationship", relationships, "--relationships")):
        for label, path in paths.items():
            for file in list_files(spark, path):
                rows.append((kind, label, file, f"{option}={label}={file}"))
    return spark.createDataFrame(rows, MANIFEST_SCHEMA)


# --- K02 -------------------------------------------------------------------
def write_csv(df: DataFrame, path: str, single_file: bool = False) -> None:
    """CSV with header; NULL -> empty field, ``""`` for empty strings and
    doubled quotes inside quoted values (the bulk-import dialect).
    ``single_file`` coalesces to one part — only for node files of bounded size."""
    out = df.coalesce(1) if single_file else df
    (out.write.mode("overwrite")
        .option("header", True).option("escape", '"').option("quoteAll", False)
        .option("emptyValue", '""').option("nullValue", "")
        .csv(path))


def write_graph(nodes: Mapping[str, DataFrame], relationships: Mapping[str, DataFrame],
                out_dir: str, single_file: Sequence[str] = (), max_workers: int = 4) -> dict[str, dict[str, str]]:
    """Write every node and relationship file; independent writes are
    submitted concurrently from a few driver threads."""
    from concurrent.futures import ThreadPoolExecutor
    base = out_dir.rstrip("/")
    paths = {"node": {k: f"{base}/node/{k}.csv" for k in nodes},
             "relationship": {k: f"{base}/relationship/{k}.csv" for k in relationships}}
    jobs = [(df, paths["node"][k], k in single_file) for k, df in nodes.items()]
    jobs += [(df, paths["relationship"][k], False) for k, df in relationships.items()]
    with ThreadPoolExecutor(max_workers=max_workers) as pool:
        for f in [pool.submit(write_csv, df, p, single) for df, p, single in jobs]:
            f.result()
    return paths
