"""Driver queries: each operator family of the pipeline run over the benchmark
tables (TPC-H style star schema + events/documents/conversations).

Every query reads whole tables and calls the library operators — the same
functions the open-data pipeline uses — so correctness here is correctness of
the operators.  Column names match the DuckDB oracle in ``__spark_entry__``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from civgraph.functions import columns as X
from civgraph.operators import catalog as C
from civgraph.operators import graph as G
from civgraph.operators import quality as Q
from civgraph.operators import relational as R

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem",
          "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _year_text(c: str):
    return F.year(c).cast("string")


# --- bronze / silver column work ---------------------------------------------
def ingest_metadata(spark, sf_dir):
    """B01-B15 shape: a raw file name per row and its release year."""
    o = table(spark, sf_dir, "orders")
    src = C.raw_file_name(F.lit("orders"), _year_text("o_orderdate"), F.lit("parquet"))
    return (o.select("o_orderkey", src.alias("source_file"))
             .withColumn("release_year", X.release_year("source_file")))


def latest_release(spark, sf_dir):
    """Keep the newest release only."""
    o = table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", _year_text("o_orderdate").alias("release_year"))
    return R.latest_release(o, "release_year")


def sentinel_to_null(spark, sf_dir):
    p = table(spark, sf_dir, "part")
    return p.select("p_partkey", X.null_if("p_type", "ECONOMY").alias("p_type_clean"))


def decimal_comma(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem")
    as_text = F.replace(F.col("l_extendedprice").cast("string"), F.lit("."), F.lit(","))
    return li.select("l_orderkey", "l_linenumber", X.decimal_comma(as_text).alias("amount"))


def thousands_amount(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    raw = F.concat(F.lit("1 000,"), (F.col("o_orderkey") % 1000 + 100).cast("string"))
    return o.select("o_orderkey", X.thousands_amount(raw).alias("amount"))


def multi_format_date(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    d = F.when(F.col("o_orderkey") % 2 == 0, F.date_format("o_orderdate", "yyyy/MM/dd")) \
         .otherwise(F.date_format("o_orderdate", "dd/MM/yyyy"))
    return o.select("o_orderkey", X.parse_date_any(d, ("yyyy/M/d", "d/M/yyyy")).alias("dt"))


def year_to_date(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    return o.select("o_orderkey", X.year_start(F.year("o_orderdate")).alias("d"))


def month_to_date(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    return o.select("o_orderkey", X.month_start(F.date_format("o_orderdate", "yyyy-MM")).alias("d"))


def strict_cast(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    return o.select(
        "o_orderkey",
        F.col("o_custkey").cast("string").cast("int").alias("cust_int"),
        F.col("o_orderdate").cast("date").alias("order_date"),
        F.when(F.col("o_orderstatus") == "F", "true").otherwise("false").cast("boolean").alias("closed"))


def label_normalize(spark, sf_dir):
    """X07 over whole document texts (cut to the label length inside the operator)."""
    d = table(spark, sf_dir, "documents")
    return d.select("doc_id", X.normalize_label("text").alias("objet"))


def line_repair(spark, sf_dir):
    """P02 line rules applied to every document text as one line."""
    from civgraph.sources.prep import repair_line, is_separator_only
    d = table(spark, sf_dir, "documents")
    quoted = F.concat(F.lit('"""'), F.col("text"), F.lit('"""'))
    return (d.filter(~is_separator_only("text", strip=False))
             .select("doc_id", repair_line(quoted).alias("line")))


def display_name(spark, sf_dir):
    """X06 with J01: name from a company field, else person name parts."""
    c = table(spark, sf_dir, "customer")
    n = table(spark, sf_dir, "nation")
    joined = R.lookup_label(c, n, {"c_nationkey": "n_nationkey"}, {"n_name": "n_name"}, bounded=True)
    person = X.display_name(F.lit(None).cast("string"), "c_name", "n_name")
    return joined.select("c_custkey", F.coalesce(X.null_if("c_mktsegment", "HOUSEHOLD"), person)
                         .alias("display_name"))


def null_skipping_concat(spark, sf_dir):
    p = table(spark, sf_dir, "part")
    return p.select("p_partkey", X.concat_skip_null(X.null_if("p_type", "ECONOMY"), F.lit(" - "), "p_brand")
                    .alias("label"))


def list_to_text(spark, sf_dir):
    """A list column of the row rendered as text: NULL items, a NULL list
    (line 4) and an empty list (line 5) among them."""
    line = F.col("l_linenumber")
    items = F.array(line.cast("string"), F.when(line % 3 != 0, F.col("l_returnflag")), F.col("l_linestatus"))
    lists = F.when(line == 5, F.slice(items, 1, 0)).when((line != 4) | line.isNull(), items)
    return table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", X.list_to_text(lists).alias("flags"))


def unnest_parties(spark, sf_dir):
    """Recursive unnest of ``list<struct<party: struct<role, turn>>>``
    with the count of its parties.  Each turn has a list of its own: NULL,
    empty, or of three elements, one of them NULL in every other turn."""
    def party(role, turn):
        return F.struct(F.struct(role.alias("role"), turn.alias("turn")).alias("party"))

    turn = F.col("turn")
    items = F.array(party(F.col("role"), turn), party(F.lit("reply"), turn + 1),
                    F.when(turn % 2 == 0, party(F.lit("note"), F.lit(0).cast("long"))))
    parties = F.when(turn % 4 == 2, F.slice(items, 1, 0)).when((turn % 4 != 1) | turn.isNull(), items)
    nested = table(spark, sf_dir, "conversations").select("conv_id", parties.alias("parties"))
    return R.explode_parties(nested, "parties", keep=["conv_id"], count_as="nb_parties")


CODE_WIDTHS = (19, 18, 17)


def part_codes(spark, sf_dir):
    """A three-level code list of all parts: the padded key is a leaf code;
    keys divisible by 10 and 100 also name the parents, whose codes are
    prefixes."""
    key, name = F.col("p_partkey"), F.col("p_name").alias("libelle")
    levels = [F.when(key % 10 ** up == 0, F.struct(
        F.left(F.lpad(key.cast("string"), CODE_WIDTHS[0], "0"), F.lit(width)).alias("code"), name,
        F.lit(3 - up).alias("type"))) for up, width in enumerate(CODE_WIDTHS)]
    return table(spark, sf_dir, "part").select(F.inline(F.array_compact(F.array(*levels))))


def prefix_hierarchy(spark, sf_dir):
    """Three-level code hierarchy, parents found by code prefix."""
    return R.prefix_hierarchy(part_codes(spark, sf_dir), "code", "libelle", "type", widths=CODE_WIDTHS)


def lookup_label(spark, sf_dir):
    s = table(spark, sf_dir, "supplier")
    n = table(spark, sf_dir, "nation").filter(F.col("n_regionkey") < 3)
    return R.lookup_label(s, n, {"s_nationkey": "n_nationkey"}, {"n_name": "nation_libelle"},
                          bounded=True).select("s_suppkey", "s_name", "nation_libelle")


def composite_lookup(spark, sf_dir):
    """LEFT lookup on two keys; the part side grows with the data, so AQE
    decides between broadcast and a shuffled join at run time."""
    li = table(spark, sf_dir, "lineitem")
    p = table(spark, sf_dir, "part").withColumn("size_mod", F.col("p_size") % 7)
    return R.lookup_label(li, p, {"l_partkey": "p_partkey", "l_linenumber": "size_mod"},
                          {"p_name": "p_name"}).select("l_orderkey", "l_linenumber", "p_name")


def primary_site_fill(spark, sf_dir):
    """Fill a missing site from the parent's primary site."""
    o = table(spark, sf_dir, "orders")
    li = table(spark, sf_dir, "lineitem")
    own = F.when(F.col("o_orderkey") % 3 == 0, F.col("o_custkey").cast("string"))
    out = R.fill_from_primary(o, li, "o_orderkey", "l_orderkey", "l_suppkey", "site",
                              own_value=own, primary=F.col("l_linenumber") == 1)
    return out.select("o_orderkey", "site")


CONFORMED = T.StructType([
    T.StructField("kind", T.StringType()), T.StructField("ref", T.LongType()),
    T.StructField("name", T.StringType()), T.StructField("montant", T.DoubleType()),
    T.StructField("d", T.DateType())])


def conformed_union(spark, sf_dir):
    """Three sources conformed to one typed shape."""
    c = R.conform(table(spark, sf_dir, "customer"), CONFORMED,
                  {"kind": F.lit("customer"), "ref": "c_custkey", "name": "c_name", "montant": "c_acctbal"})
    s = R.conform(table(spark, sf_dir, "supplier"), CONFORMED,
                  {"kind": F.lit("supplier"), "ref": "s_suppkey", "name": "s_name", "montant": "s_acctbal"})
    o = R.conform(table(spark, sf_dir, "orders"), CONFORMED,
                  {"kind": F.lit("order"), "ref": "o_orderkey", "montant": "o_totalprice", "d": "o_orderdate"})
    return R.conform_union([c, s, o])


def union_by_name(spark, sf_dir):
    c = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("k"), F.col("c_acctbal").alias("bal"), F.col("c_mktsegment").alias("seg"))
    s = table(spark, sf_dir, "supplier").select(
        F.col("s_suppkey").alias("k"), F.col("s_acctbal").alias("bal"), "s_name")
    return R.union_by_name([c, s])


def surrogate_key(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    return o.select(X.surrogate_key(F.lit("order"), "o_orderkey").alias("id"), "o_orderkey")


def surrogate_key_duplicates(spark, sf_dir):
    """X14 over rows with many exact duplicates: each keeps a key of its own."""
    return R.with_surrogate_key(table(spark, sf_dir, "lineitem").select(
        "l_linenumber", "l_returnflag", "l_linestatus"), "id")


def rounded_cast(spark, sf_dir):
    """Text with decimals to a whole number, halves away from zero."""
    li = table(spark, sf_dir, "lineitem")
    text = F.concat((F.col("l_linenumber") - 4).cast("string"), F.lit("."), (F.col("l_orderkey") % 10).cast("string"))
    return li.select("l_orderkey", "l_linenumber", X.int_rounding(text).alias("whole"))


def not_like_filter(spark, sf_dir):
    """NOT LIKE on a cleaned column (NULLs drop out, three-valued logic)."""
    p = table(spark, sf_dir, "part")
    return p.filter(~X.null_if("p_type", "ECONOMY").like("STAN%")).select("p_partkey", "p_name")


# --- gold graph ------------------------------------------------------------------
def graph_nodes(spark, sf_dir):
    c = table(spark, sf_dir, "customer")
    return G.node(c, "c_custkey", "Customer", id_name="custkey", props={"name": "c_name"})


def graph_edges_own(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    return G.edge(o, "o_custkey", "Customer", "o_orderkey", "Order")


def graph_edges_existing(spark, sf_dir):
    o = table(spark, sf_dir, "orders").filter(F.col("o_orderstatus") == "F")
    c = table(spark, sf_dir, "customer")
    return G.edge_existing(o, "o_custkey", "Customer", "o_orderkey", "Order", c, "c_custkey")


def graph_edges_typed(spark, sf_dir):
    c = table(spark, sf_dir, "customer")
    n = table(spark, sf_dir, "nation")
    return G.edge_typed(c, "c_nationkey", n, "n_nationkey", "n_regionkey", [0, 1],
                        "c_custkey", "Customer", "Nation", bounded=True)


def graph_dangling(spark, sf_dir):
    """Line items whose order is not among the finished orders, per order key."""
    li = table(spark, sf_dir, "lineitem")
    o = table(spark, sf_dir, "orders").filter(F.col("o_orderstatus") == "F")
    return G.dangling_counts(li, "l_orderkey", o, "o_orderkey")


def graph_summary(spark, sf_dir):
    """Row count per node and relationship file of a small customer/order graph."""
    c = table(spark, sf_dir, "customer")
    o = table(spark, sf_dir, "orders")
    n = table(spark, sf_dir, "nation")
    s = table(spark, sf_dir, "supplier")
    nodes = {"Customer": G.node(c, "c_custkey", "Customer", props={"name": "c_name"}),
             "Order": G.node(o, "o_orderkey", "Order", props={"montant": "o_totalprice"},
                             types={"montant": "double"}),
             "Nation": G.node(n, "n_nationkey", "Nation", props={"name": "n_name"}),
             "Supplier": G.node(s, "s_suppkey", "Supplier", props={"name": "s_name"})}
    rels = {"places": G.edge_existing(o, "o_custkey", "Customer", "o_orderkey", "Order", c, "c_custkey"),
            "customer_in": G.edge_typed(c, "c_nationkey", n, "n_nationkey", "n_regionkey", [0, 1, 2, 3, 4],
                                        "c_custkey", "Customer", "Nation", bounded=True),
            "supplier_in": G.edge_typed(s, "s_nationkey", n, "n_nationkey", "n_regionkey", [0, 1, 2, 3, 4],
                                        "s_suppkey", "Supplier", "Nation", bounded=True)}
    parts = [df.agg(F.count(F.lit(1)).alias("rows")).select(F.lit(k).alias("label"), F.lit("node").alias("kind"), "rows")
             for k, df in nodes.items()]
    parts += [df.agg(F.count(F.lit(1)).alias("rows")).select(F.lit(k).alias("label"), F.lit("relationship").alias("kind"), "rows")
              for k, df in rels.items()]
    from functools import reduce
    return reduce(lambda a, b: a.unionByName(b), parts)


# --- quality and catalog -------------------------------------------------------------
def dq_not_null(spark, sf_dir):
    p = table(spark, sf_dir, "part").select(X.null_if("p_type", "ECONOMY").alias("p_type_clean"))
    return Q.not_null_failures(p, ["p_type_clean"])


def dq_unique(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem")
    key = X.concat_strict(F.col("l_orderkey").cast("string"), F.lit("-"), F.col("l_linenumber").cast("string"))
    return Q.duplicate_keys(li, key, "k", "n", group_by=["l_orderkey", "l_linenumber"])


def catalog_validate(spark, sf_dir):
    """C01-C03 verdict per catalog record; records derived from ``part``."""
    p = table(spark, sf_dir, "part")
    cat = p.select(
        "p_partkey",
        F.when(F.col("p_size") % 5 == 0, "CSV").otherwise("csv").alias("fmt"),
        F.when(F.col("p_size") % 4 == 0, F.lit(None)).when(F.col("p_size") % 4 == 1, "2024")
         .when(F.col("p_size") % 4 == 2, "2024-2026").otherwise("24").alias("yr"),
        F.when(F.col("p_size") % 3 == 0, F.lit(15)).alias("refresh_days"))
    return cat.select("p_partkey", C.catalog_verdict("yr", "fmt", "refresh_days").alias("verdict"))


def refresh_plan(spark, sf_dir):
    """Due sources (one per customer) against the event history."""
    cat = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("user_id"), (5 + F.col("c_custkey") % 30).alias("refresh_days"))
    hist = table(spark, sf_dir, "events").select("user_id", F.col("ts").alias("download_timestamp"))
    now = F.lit("2024-01-20 00:00:00").cast("timestamp_ntz")
    return C.refresh_plan(cat, hist, now, keys=["user_id"], year=None).select("user_id", "status")


def latest_release_by(spark, sf_dir):
    """A01 per group: each customer's orders of its newest order year."""
    o = table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", _year_text("o_orderdate").alias("release_year"))
    return R.latest_release(o, "release_year", by=["o_custkey"])


def catalog_duplicates(spark, sf_dir):
    """Duplicate (name, year) catalog keys, NULL year counted as a value."""
    p = table(spark, sf_dir, "part")
    cat = p.select(F.col("p_brand").alias("name"),
                   F.when(F.col("p_size") % 3 == 0, F.lit(None))
                    .otherwise((2020 + F.col("p_size") % 4).cast("string")).alias("year"))
    return C.duplicate_sources(cat)


def catalog_problems(spark, sf_dir):
    """C01-C05 through ``validate_catalog``: every problem of catalog records
    derived from ``part``."""
    p, size = table(spark, sf_dir, "part"), F.col("p_size")
    text = {"description": F.col("p_type"), "category": F.when(size % 7 != 0, F.col("p_brand")),
            "provider": F.lit("p"), "page_url": F.lit("u"), "download_url": F.when(size % 11 != 0, F.lit("u"))}
    cat = p.select(
        F.col("p_name").alias("name"), *[v.alias(k) for k, v in text.items()],
        F.when(size % 4 == 1, "2024").when(size % 4 == 2, "2024-2026").when(size % 4 == 3, "24").alias("year"),
        F.when(size % 5 == 0, "CSV").otherwise("csv").alias("format"),
        F.when(size % 3 == 0, F.lit(15)).alias("refresh_days"))
    return C.validate_catalog(cat)


def dq_checks(spark, sf_dir):
    """Q01-Q03: several not_null and unique checks of one model in one report."""
    li = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", X.null_if("l_returnflag", "R").alias("flag"),
        X.null_if("l_linestatus", "O").alias("status"))
    checks = [Q.not_null("flag"), Q.not_null("status"), Q.unique("l_orderkey"),
              Q.unique("order_line", "cast(l_orderkey as string) || '-' || cast(l_linenumber as string)",
                       group_by=("l_orderkey", "l_linenumber"))]
    return Q.run_checks(li, checks, "lineitem")


def graph_integrity(spark, sf_dir):
    """Dangling endpoints per relationship and side against the node files."""
    c = table(spark, sf_dir, "customer")
    o = table(spark, sf_dir, "orders")
    p = table(spark, sf_dir, "part")
    li = table(spark, sf_dir, "lineitem")
    nodes = {"Customer": G.node(c.filter(F.col("c_nationkey") < 20), "c_custkey", "Customer"),
             "Order": G.node(o.filter(F.col("o_orderstatus") == "F"), "o_orderkey", "Order"),
             "Part": G.node(p.filter(F.col("p_size") > 5), "p_partkey", "Part")}
    rels = {"places": G.edge(o, "o_custkey", "Customer", "o_orderkey", "Order"),
            "contains": G.edge(li, "l_orderkey", "Order", "l_partkey", "Part")}
    return G.integrity_report(rels, nodes)


QUERIES = {
    "ingest_metadata": ingest_metadata,
    "latest_release": latest_release,
    "sentinel_to_null": sentinel_to_null,
    "decimal_comma": decimal_comma,
    "thousands_amount": thousands_amount,
    "multi_format_date": multi_format_date,
    "year_to_date": year_to_date,
    "month_to_date": month_to_date,
    "strict_cast": strict_cast,
    "label_normalize": label_normalize,
    "line_repair": line_repair,
    "display_name": display_name,
    "null_skipping_concat": null_skipping_concat,
    "list_to_text": list_to_text,
    "unnest_parties": unnest_parties,
    "prefix_hierarchy": prefix_hierarchy,
    "lookup_label": lookup_label,
    "composite_lookup": composite_lookup,
    "primary_site_fill": primary_site_fill,
    "conformed_union": conformed_union,
    "union_by_name": union_by_name,
    "surrogate_key": surrogate_key,
    "surrogate_key_duplicates": surrogate_key_duplicates,
    "rounded_cast": rounded_cast,
    "catalog_problems": catalog_problems,
    "not_like_filter": not_like_filter,
    "graph_nodes": graph_nodes,
    "graph_edges_own": graph_edges_own,
    "graph_edges_existing": graph_edges_existing,
    "graph_edges_typed": graph_edges_typed,
    "graph_dangling": graph_dangling,
    "graph_summary": graph_summary,
    "dq_not_null": dq_not_null,
    "dq_unique": dq_unique,
    "catalog_validate": catalog_validate,
    "refresh_plan": refresh_plan,
    "latest_release_by": latest_release_by,
    "catalog_duplicates": catalog_duplicates,
    "dq_checks": dq_checks,
    "graph_integrity": graph_integrity,
}
