"""Relational operators of the silver layer.

All are declarative DataFrame plans; Catalyst and AQE choose the physical
join strategy.  An explicit broadcast hint is only given for a side whose size
is bounded by construction (reference code lists, the nation/region style
dimensions) — everything that grows with the data is left to AQE, which
broadcasts at run time only below ``spark.sql.autoBroadcastJoinThreshold``.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from civgraph.functions.columns import code_prefix, col_, surrogate_key
from civgraph.sources.blocks import shared_table


def _maybe_broadcast(df: DataFrame, bounded: bool) -> DataFrame:
    return F.broadcast(df) if bounded else df


# Salt buckets for NULL join keys (see ``spread_null_key``).
NULL_KEY_BUCKETS = 4096


def spread_null_key(df: DataFrame, key: str, out: str) -> DataFrame:
    """Copy ``key`` to ``out`` with NULLs replaced by a value that can never
    match, spread over ``NULL_KEY_BUCKETS`` distinct values.

    A NULL key never matches in an outer or anti join, but a hash shuffle
    still sends every NULL to one reducer — in this data (unknown SIRET,
    missing commune) NULL is the hottest key.  String keys get a marker
    starting with U+0000 (no identifier starts with it); numeric keys have no
    value that cannot match and are left as they are.  The bucket comes
    from a hash of the row, so it is deterministic under task retries.
    """
    if not isinstance(df.schema[key].dataType, T.StringType):
        return df.withColumn(out, F.col(key))
    hashable = [F.col(f"`{f.name}`") for f in df.schema.fields if not isinstance(f.dataType, T.MapType)]
    bucket = F.pmod(F.xxhash64(*hashable), F.lit(NULL_KEY_BUCKETS))
    marker = F.concat(F.lit("\u0000null:"), bucket.cast("string"))
    return df.withColumn(out, F.coalesce(F.col(key), marker))


# --- A01 / F11 ---------------------------------------------------------------
def latest_release(df: DataFrame, release_col: str = "release_year",
                   by: Sequence[str] | None = None, prune_files: bool | None = False) -> DataFrame:
    """Keep rows of the newest release.

    Without ``by``: ``release = (SELECT max(release) FROM df)`` — an
    uncorrelated scalar subquery computed once with partial + final
    aggregation and pushed into the scan as a data filter.

    ``prune_files=True`` (release derived from the file name): the newest
    release is fetched first as one value — for Parquet answered from file
    metadata without reading any column — and applied as a literal, which
    Spark evaluates while listing files, so older releases are never read.
    Same result as the subquery form; never more I/O.

    ``prune_files=None``: the frame holds one release already (files chosen by
    name, see ``readers.newest_files``); nothing is added to the plan.

    With ``by``: newest release per group (e.g. per source file stem), done as
    a grouped max joined back on the group key; the grouped side holds one
    row per group, so a hot group only needs AQE's skew-join split of the big
    side, never a whole group in one task.
    """
    if not by:
        if prune_files is None:
            return df
        if prune_files:
            newest = df.agg(F.max(release_col)).first()[0]
            return df.filter(F.col(release_col) == F.lit(newest))
        newest = df.agg(F.max(release_col)).scalar()
        return df.filter(F.col(release_col) == newest)
    newest = df.groupBy(*by).agg(F.max(release_col).alias("__newest"))
    return (df.join(newest, list(by), "inner")
              .filter(F.col(release_col) == F.col("__newest"))
              .drop("__newest"))


# --- J02 / V04 -------------------------------------------------------------
def prefix_hierarchy(codes: DataFrame, code: str, label: str, level: str,
                     names: Sequence[tuple[str, str]] = (("code_iii", "libelle_iii"),
                                                         ("code_ii", "libelle_ii"),
                                                         ("code_i", "libelle_i")),
                     bounded: bool = False, widths: Sequence[int] = (3, 2, 1)) -> DataFrame:
    """Flatten a coded hierarchy whose parent code is a prefix of the child code.

    ``codes`` holds one row per code with its ``level`` (1 = top).  The leaves
    are the rows of the deepest level; each parent is found by a LEFT join on
    ``parent.code = left(child.code, width of the parent level)`` (``widths``,
    deepest first) — an equi-join after projection, so it hashes instead of
    comparing pairs.  Leaves without a
    parent are kept with NULL parent columns.  Output columns follow ``names``
    (deepest first).
    """
    depth = len(names)
    levels = []
    for i, (c_name, l_name) in enumerate(names):
        lvl = depth - i
        levels.append(codes.filter(F.col(level) == lvl)
                           .select(F.col(code).cast("string").alias(c_name),
                                   F.col(label).alias(l_name)))
    out = levels[0]
    for i in range(1, depth):
        parent_code = names[i][0]
        child_code = names[i - 1][0]
        child = out.withColumn("__pk", code_prefix(child_code, widths[i]))
        parent = _maybe_broadcast(levels[i], bounded)
        out = (child.join(parent, child["__pk"] == parent[parent_code], "left")
                    .drop("__pk"))
    cols = [c for pair in names for c in pair]
    return out.select(*cols)


# --- J01 / J03 -------------------------------------------------------------------
def lookup_label(df: DataFrame, dim: DataFrame, on: Mapping[str, str],
                 labels: Mapping[str, str], bounded: bool = False) -> DataFrame:
    """LEFT join a label table on one or more key pairs ``{df_col: dim_col}``
    and add ``labels`` ``{dim_col: output_name}``.  ``bounded=True`` marks a
    code list whose size is fixed (a seed), which is broadcast."""
    keys = list(on.items())
    right = dim.select(*[F.col(r).alias(f"__k{i}") for i, (_, r) in enumerate(keys)],
                       *[F.col(src).alias(dst) for src, dst in labels.items()])
    right = _maybe_broadcast(right, bounded)
    left, lkeys = df, []
    for i, (l, _) in enumerate(keys):
        if bounded:  # broadcast: no shuffle, NULL keys cost nothing
            lkeys.append(F.col(l))
        else:
            left = spread_null_key(left, l, f"__l{i}")
            lkeys.append(F.col(f"__l{i}"))
    cond = reduce(lambda a, b: a & b, [lk == right[f"__k{i}"] for i, lk in enumerate(lkeys)])
    out = left.join(right, cond, "left")
    return out.drop(*[f"__k{i}" for i in range(len(keys))], *[f"__l{i}" for i in range(len(keys))])


# --- J04 / V16 / V20 ---------------------------------------------------------
def fill_from_primary(df: DataFrame, sites: DataFrame, df_key: str, site_key: str,
                      site_value: str, out: str, own_value: Column | str | None = None,
                      primary: Column | str | None = None) -> DataFrame:
    """Fill ``out`` from the primary site (head office) of the same parent key.

    ``sites`` is filtered by ``primary`` before a LEFT join on the parent key;
    ``out = coalesce(own_value, site.site_value)`` (both as text).  If a parent
    had two primary sites the row fans out, exactly as the reference join
    does.  The sites side grows with the registry, so no broadcast hint is
    given: AQE picks broadcast or a skew-aware shuffle join at run time.
    """
    s = sites
    if primary is not None:
        s = s.filter(col_(primary))
    s = s.select(F.col(site_key).alias("__pkey"), F.col(site_value).alias("__pval")) \
         .filter(F.col("__pkey").isNotNull())
    left = spread_null_key(df, df_key, "__lkey")
    joined = left.join(s, F.col("__lkey") == F.col("__pkey"), "left").drop("__lkey")
    filled = (F.coalesce(col_(own_value).cast("string"), F.col("__pval").cast("string"))
              if own_value is not None else F.col("__pval").cast("string"))
    return joined.withColumn(out, filled).drop("__pkey", "__pval")


# --- U01 / F12 / F13 -----------------------------------------------------------
def conform(df: DataFrame, schema: T.StructType, mapping: Mapping[str, Column | str | None]) -> DataFrame:
    """Project ``df`` onto a target ``schema``: each target column comes from
    ``mapping`` (a column name, an expression, or a literal via ``F.lit``);
    unmapped targets become typed NULLs.  Every value is cast to its target
    type so a positional union cannot silently widen or reorder."""
    cols = []
    for field in schema.fields:
        src = mapping.get(field.name)
        expr = F.lit(None) if src is None else col_(src)
        cols.append(expr.cast(field.dataType).alias(field.name))
    return df.select(*cols)


def conform_union(branches: Sequence[DataFrame]) -> DataFrame:
    """UNION ALL of branches already conformed to one schema (by name)."""
    return reduce(lambda a, b: a.unionByName(b), branches)


# --- U02 / R03 -----------------------------------------------------------------
def union_by_name(frames: Sequence[DataFrame]) -> DataFrame:
    """Union by column name; columns missing from a frame become NULL.
    Types are widened by Spark's usual rules."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


# --- T01 / X13 / F17 ------------------------------------------------------------
def _leaf_paths(dt: T.DataType, prefix: str) -> list[tuple[str, str]]:
    if isinstance(dt, T.StructType):
        out = []
        for f in dt.fields:
            out.extend(_leaf_paths(f.dataType, f"{prefix}.`{f.name}`") if isinstance(f.dataType, T.StructType)
                       else [(f"{prefix}.`{f.name}`", f.name)])
        return out
    return [(prefix, prefix.split(".")[-1].strip("`"))]


def explode_parties(df: DataFrame, list_col: str, keep: Sequence[str] | None = None,
                    rename: Mapping[str, str] | None = None,
                    count_as: str | None = None) -> DataFrame:
    """Recursive unnest of a ``list<struct<…>>`` column.

    One row per list element; every leaf field of the (possibly nested) element
    struct becomes a top-level column named after the leaf (``rename`` maps
    leaf -> output name, case-insensitively).  NULL and empty lists drop the row; a NULL element
    yields a row of NULL leaves.  ``count_as`` adds the number of non-NULL
    elements of the original list.  Runs per row (``explode`` is a generator
    inside the same stage): no shuffle.
    """
    rename = {k.lower(): v for k, v in (rename or {}).items()}
    keep = list(keep) if keep is not None else [c for c in df.columns if c != list_col]
    elem_type = df.schema[list_col].dataType.elementType
    pre = [F.col(c) for c in keep]
    if count_as:
        from civgraph.functions.columns import list_count
        pre.append(list_count(list_col).alias(count_as))
    exploded = df.select(*pre, F.explode(list_col).alias("__el"))
    leaves = _leaf_paths(elem_type, "__el")
    passthrough = keep + ([count_as] if count_as else [])
    return exploded.select(*[F.col(c) for c in passthrough],
                           *[F.col(path).alias(rename.get(name.lower(), name)) for path, name in leaves])


# --- X14 ---------------------------------------------------------------------------
# Rows numbered by one generated list: bounds the list of a much-repeated row.
OCCURRENCES_PER_LIST = 100_000


# Most hashes that are broadcast (8 bytes each); beyond, rows meet them in a shuffle.
BROADCAST_HASHES = 1_000_000


def with_surrogate_key(df: DataFrame, out: str, by_hash: bool = False) -> DataFrame:
    """Add an md5 key over all columns and, for exact duplicates, their
    occurrence number (1, 2, ...), so every row has its own key and the set of
    keys depends on nothing but the rows.

    By default rows meet their copies in one aggregation over all columns.
    With ``by_hash`` a first job counts 64-bit hashes of the rows, and only
    these are shuffled: a row whose hash occurs once is unlike all others and
    gets number 1 where it is; just the rows of repeated hashes are compared and
    numbered, so rows that merely share a hash are told apart.  ``df`` is then
    evaluated once per step: for frames that read stored tables.  The keys are
    the same either way.
    """
    def keyed(rows: DataFrame, number: Column) -> DataFrame:
        return rows.withColumn("__i", number).select(surrogate_key(*df.columns, "__i").alias(out), *df.columns)

    if not by_hash:
        return keyed(numbered_copies(df), F.col("__n"))
    hashed = df.withColumn("__hash", F.xxhash64(*[F.col(f"`{c}`") for c in df.columns]))
    repeated = shared_table(hashed.groupBy("__hash").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("__hash"))
    many = repeated.limit(BROADCAST_HASHES + 1).count()
    one = F.lit(1).cast("long")
    if not many:
        return keyed(df, one)
    copied = F.broadcast(repeated) if many <= BROADCAST_HASHES else repeated
    singles = hashed.join(copied, "__hash", "left_anti")
    copies = numbered_copies(hashed.join(copied, "__hash", "left_semi").drop("__hash"))
    return keyed(singles, one).unionAll(keyed(copies, F.col("__n")))


def numbered_copies(df: DataFrame) -> DataFrame:
    """``df`` with ``__n``, the occurrence number of a row among its copies.

    Identical rows are counted (partial aggregation: a much-repeated row
    crosses the shuffle once per task) and numbered from the count, in lists
    of bounded length; no window gathers a group.
    """
    per_list = F.lit(OCCURRENCES_PER_LIST).cast("long")
    counted = df.groupBy(*df.columns).agg(F.count(F.lit(1)).alias("__n"))
    lists = counted.select("*", F.explode(F.sequence(F.lit(0).cast("long"), F.expr(
        f"(__n - 1) div {OCCURRENCES_PER_LIST}"))).alias("__list"))
    first = F.col("__list") * per_list + 1
    return lists.select(*df.columns, F.explode(F.sequence(
        first, F.least(F.col("__n"), first + per_list - 1))).alias("__n"))
