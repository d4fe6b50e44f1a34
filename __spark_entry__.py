"""

``entry(spark)`` runs the flagship query on sf0.001; ``queries()`` maps each
driver query to a callable (spark, sf_dir) -> DataFrame built from the
library operators; ``oracle_sql()`` gives the equivalent DuckDB SQL over the
same parquet tables (identical column names).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from civgraph.plans import driver_models
from civgraph.plans.driver import QUERIES, graph_summary

# the training-data operators are a part that can be left out; a package that
# they need and that is not there is an error
_LEFT_OUT = ("civgraph.llm", "corpus_pipeline")
try:
    from civgraph.llm import queries as llm
except ModuleNotFoundError as exc:
    if exc.name not in _LEFT_OUT:
        raise
    llm = None
try:
    import corpus_pipeline
except ModuleNotFoundError as exc:
    if exc.name not in _LEFT_OUT:
        raise
    corpus_pipeline = None

SMOKE_DIR = "/root/testdata/sf0.001"


def entry(spark: SparkSession) -> DataFrame:
    """Flagship: node and relationship counts of the customer/order graph."""
    return graph_summary(spark, SMOKE_DIR)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    found = {**QUERIES, **driver_models.QUERIES}
    if llm:
        found |= llm.QUERIES
    if corpus_pipeline:
        found["pipeline"] = corpus_pipeline.run
    return found


def oracle_sql() -> dict[str, str]:
    found = {**_ORACLE, **driver_models.ORACLE}
    if llm:
        found |= llm.ORACLE
    if corpus_pipeline and corpus_pipeline.ORACLE_SQL:
        found["pipeline"] = corpus_pipeline.ORACLE_SQL
    return found


_ORACLE = {
    "ingest_metadata": r"""SELECT o_orderkey, 'orders_'||CAST(year(o_orderdate) AS VARCHAR)||'.parquet' AS source_file, regexp_extract('orders_'||CAST(year(o_orderdate) AS VARCHAR)||'.parquet','_(\d{4})',1) AS release_year FROM orders""",
    "latest_release": r"""WITH b AS (SELECT o_orderkey, o_custkey, CAST(year(o_orderdate) AS VARCHAR(4)) AS release_year FROM orders) SELECT * FROM b WHERE release_year=(SELECT max(release_year) FROM b)""",
    "sentinel_to_null": r"""SELECT p_partkey, nullif(p_type,'ECONOMY') AS p_type_clean FROM part""",
    "decimal_comma": r"""SELECT l_orderkey, l_linenumber, CAST(replace(replace(CAST(l_extendedprice AS VARCHAR),'.',','),',','.') AS DOUBLE) AS amount FROM lineitem""",
    "thousands_amount": r"""SELECT o_orderkey, CAST(replace(replace(concat('1 000,',CAST(o_orderkey%1000+100 AS VARCHAR)),' ',''),',','') AS DOUBLE) AS amount FROM orders""",
    "multi_format_date": r"""WITH r AS (SELECT o_orderkey, CASE WHEN o_orderkey%2=0 THEN strftime(o_orderdate,'%Y/%m/%d') ELSE strftime(o_orderdate,'%d/%m/%Y') END AS d FROM orders) SELECT o_orderkey, CAST(coalesce(try_strptime(d,'%Y/%m/%d'),try_strptime(d,'%d/%m/%Y')) AS DATE) AS dt FROM r""",
    "year_to_date": r"""SELECT o_orderkey, make_date(year(o_orderdate),1,1) AS d FROM orders""",
    "month_to_date": r"""SELECT o_orderkey, CAST(strptime(strftime(o_orderdate,'%Y-%m'),'%Y-%m') AS DATE) AS d FROM orders""",
    "strict_cast": r"""SELECT o_orderkey, CAST(CAST(o_custkey AS VARCHAR) AS INTEGER) AS cust_int, CAST(o_orderdate AS DATE) AS order_date, CAST(CASE WHEN o_orderstatus='F' THEN 'true' ELSE 'false' END AS BOOLEAN) AS closed FROM orders""",
    "label_normalize": r"""SELECT doc_id, trim(regexp_replace(left(replace(replace(text,chr(13),' '),chr(10),' '),200),'\s+',' ','g')) AS objet FROM documents""",
    "line_repair": r'''SELECT doc_id, replace(concat('"""',text,'"""'),'"""','"') AS line FROM documents WHERE NOT regexp_matches(text,'^;+$')''',
    "display_name": r"""SELECT c_custkey, coalesce(nullif(c_mktsegment,'HOUSEHOLD'), nullif(trim(concat(coalesce(nullif(c_name,'[ND]'),''),' ',coalesce(n_name,''))),'')) AS display_name FROM customer LEFT JOIN nation ON c_nationkey=n_nationkey""",
    "null_skipping_concat": r"""SELECT p_partkey, concat(nullif(p_type,'ECONOMY'),' - ',p_brand) AS label FROM part""",
    "list_to_text": r"""SELECT l_orderkey, l_linenumber, CASE WHEN l_linenumber=4 THEN NULL WHEN l_linenumber=5 THEN '' ELSE array_to_string([CAST(l_linenumber AS VARCHAR), CASE WHEN l_linenumber%3<>0 THEN l_returnflag END, l_linestatus], ', ') END AS flags FROM lineitem""",
    "unnest_parties": r"""WITH n AS (SELECT conv_id, CASE WHEN turn%4=1 THEN NULL WHEN turn%4=2 THEN [] ELSE [{'party':{'role':role,'turn':turn}}, {'party':{'role':'reply','turn':turn+1}}, CASE WHEN turn%2=0 THEN {'party':{'role':'note','turn':CAST(0 AS BIGINT)}} END] END AS parties FROM conversations) SELECT conv_id, u.p.party.role AS role, u.p.party.turn AS turn, list_count(parties) AS nb_parties FROM n, unnest(n.parties) AS u(p)""",
    "prefix_hierarchy": r"""WITH p AS (SELECT lpad(CAST(p_partkey AS VARCHAR),19,'0') AS code, p_name AS libelle, p_partkey FROM part) SELECT a.code AS code_iii, a.libelle AS libelle_iii, b.code AS code_ii, b.libelle AS libelle_ii, c.code AS code_i, c.libelle AS libelle_i FROM p a LEFT JOIN (SELECT left(code,18) AS code, libelle FROM p WHERE p_partkey%10=0) b ON b.code=left(a.code,18) LEFT JOIN (SELECT left(code,17) AS code, libelle FROM p WHERE p_partkey%100=0) c ON c.code=left(b.code,17)""",
    "lookup_label": r"""SELECT s_suppkey, s_name, n_name AS nation_libelle FROM supplier LEFT JOIN (SELECT n_nationkey,n_name FROM nation WHERE n_regionkey<3) n ON s_nationkey=n_nationkey""",
    "composite_lookup": r"""SELECT l_orderkey,l_linenumber,p_name FROM lineitem LEFT JOIN part ON l_partkey=p_partkey AND l_linenumber=p_size%7""",
    "primary_site_fill": r"""WITH s AS (SELECT l_orderkey, l_suppkey FROM lineitem WHERE l_linenumber=1) SELECT o_orderkey, coalesce(CASE WHEN o_orderkey%3=0 THEN CAST(o_custkey AS VARCHAR) END, CAST(s.l_suppkey AS VARCHAR)) AS site FROM orders LEFT JOIN s ON o_orderkey=s.l_orderkey""",
    "conformed_union": r"""SELECT 'customer' AS kind, c_custkey AS ref, c_name AS name, c_acctbal AS montant, CAST(NULL AS DATE) AS d FROM customer UNION ALL SELECT 'supplier', s_suppkey, s_name, s_acctbal, CAST(NULL AS DATE) FROM supplier UNION ALL SELECT 'order', o_orderkey, NULL, o_totalprice, CAST(o_orderdate AS DATE) FROM orders""",
    "union_by_name": r"""SELECT c_custkey AS k, c_acctbal AS bal, c_mktsegment AS seg, CAST(NULL AS VARCHAR) AS s_name FROM customer UNION ALL SELECT s_suppkey, s_acctbal, NULL, s_name FROM supplier""",
    "surrogate_key": r"""SELECT md5(concat('5:order', length(CAST(o_orderkey AS VARCHAR)), ':', CAST(o_orderkey AS VARCHAR))) AS id, o_orderkey FROM orders""",
    "surrogate_key_duplicates": r"""WITH n AS (SELECT l_linenumber, l_returnflag, l_linestatus, CAST(l_linenumber AS VARCHAR) AS a, CAST(row_number() OVER (PARTITION BY l_linenumber, l_returnflag, l_linestatus) AS VARCHAR) AS i FROM lineitem) SELECT md5(concat(coalesce(length(a)||':'||a,'N'), coalesce(length(l_returnflag)||':'||l_returnflag,'N'), coalesce(length(l_linestatus)||':'||l_linestatus,'N'), length(i)||':'||i)) AS id, l_linenumber, l_returnflag, l_linestatus FROM n""",
    "rounded_cast": r"""SELECT l_orderkey, l_linenumber, CAST(CAST(l_linenumber-4 AS VARCHAR)||'.'||CAST(l_orderkey%10 AS VARCHAR) AS INTEGER) AS whole FROM lineitem""",
    "catalog_problems": r"""WITH c AS (SELECT p_name AS name, p_type, CASE WHEN p_size%7<>0 THEN p_brand END AS category, CASE WHEN p_size%11<>0 THEN 'u' END AS url, CASE p_size%4 WHEN 1 THEN '2024' WHEN 2 THEN '2024-2026' WHEN 3 THEN '24' END AS year, CASE WHEN p_size%5=0 THEN 'CSV' ELSE 'csv' END AS format, CASE WHEN p_size%3=0 THEN 15 END AS refresh FROM part) SELECT name, year, 'missing_name' AS problem FROM c WHERE name IS NULL UNION ALL SELECT name, year, 'missing_description' FROM c WHERE p_type IS NULL UNION ALL SELECT name, year, 'missing_category' FROM c WHERE category IS NULL UNION ALL SELECT name, year, 'missing_download_url' FROM c WHERE url IS NULL UNION ALL SELECT name, year, v FROM (SELECT name, year, CASE WHEN year='24' THEN 'bad_year' WHEN format='CSV' THEN 'bad_format' WHEN year IS NULL AND refresh IS NULL THEN 'missing_refresh' WHEN year IS NOT NULL AND refresh IS NOT NULL THEN 'conflicting_refresh' END AS v FROM c) WHERE v IS NOT NULL UNION ALL SELECT name, year, 'duplicate' FROM c GROUP BY name, year HAVING count(*)>1""",
    "not_like_filter": r"""SELECT p_partkey, p_name FROM part WHERE nullif(p_type,'ECONOMY') NOT LIKE 'STAN%'""",
    "graph_nodes": r"""SELECT c_custkey AS "custkey:ID(Customer)", c_name AS name FROM customer""",
    "graph_edges_own": r"""SELECT o_custkey AS ":START_ID(Customer)", o_orderkey AS ":END_ID(Order)" FROM orders""",
    "graph_edges_existing": r"""SELECT o_custkey AS ":START_ID(Customer)", o_orderkey AS ":END_ID(Order)" FROM orders LEFT JOIN customer ON o_custkey=c_custkey WHERE c_custkey IS NOT NULL AND o_orderstatus='F'""",
    "graph_edges_typed": r"""SELECT c_custkey AS ":START_ID(Customer)", n_nationkey AS ":END_ID(Nation)" FROM customer LEFT JOIN nation ON c_nationkey=n_nationkey WHERE n_regionkey IN (0,1) AND c_nationkey IS NOT NULL""",
    "graph_dangling": r"""SELECT l_orderkey, count(*) AS n FROM lineitem WHERE NOT EXISTS (SELECT 1 FROM (SELECT * FROM orders WHERE o_orderstatus='F') o WHERE o.o_orderkey=l_orderkey) GROUP BY l_orderkey""",
    "graph_summary": r"""SELECT 'Customer' AS label, 'node' AS kind, count(*) AS rows FROM customer UNION ALL SELECT 'Order', 'node', count(*) FROM orders UNION ALL SELECT 'Nation', 'node', count(*) FROM nation UNION ALL SELECT 'Supplier', 'node', count(*) FROM supplier UNION ALL SELECT 'places', 'relationship', count(*) FROM orders o WHERE EXISTS (SELECT 1 FROM customer c WHERE c.c_custkey=o.o_custkey) UNION ALL SELECT 'customer_in', 'relationship', count(*) FROM customer JOIN nation ON c_nationkey=n_nationkey WHERE n_regionkey IN (0,1,2,3,4) UNION ALL SELECT 'supplier_in', 'relationship', count(*) FROM supplier JOIN nation ON s_nationkey=n_nationkey WHERE n_regionkey IN (0,1,2,3,4)""",
    "dq_not_null": r"""SELECT 'not_null' AS test,'p_type_clean' AS col, count(*) AS failures FROM (SELECT nullif(p_type,'ECONOMY') v FROM part) WHERE v IS NULL""",
    "dq_unique": r"""SELECT k, count(*) AS n FROM (SELECT CAST(l_orderkey AS VARCHAR)||'-'||CAST(l_linenumber AS VARCHAR) AS k FROM lineitem) t WHERE k IS NOT NULL GROUP BY k HAVING count(*)>1""",
    "catalog_validate": r"""WITH c AS (SELECT p_partkey, CASE WHEN p_size%5=0 THEN 'CSV' ELSE 'csv' END AS fmt, CASE WHEN p_size%4=0 THEN NULL WHEN p_size%4=1 THEN '2024' WHEN p_size%4=2 THEN '2024-2026' ELSE '24' END AS yr, CASE WHEN p_size%3=0 THEN 15 END AS refresh_days FROM part) SELECT p_partkey, CASE WHEN yr IS NOT NULL AND NOT regexp_matches(yr,'^\d{4}(-\d{4})?$') THEN 'bad_year' WHEN fmt NOT IN ('parquet','json','xlsx','csv','zip') THEN 'bad_format' WHEN yr IS NULL AND refresh_days IS NULL THEN 'missing_refresh' WHEN yr IS NOT NULL AND refresh_days IS NOT NULL THEN 'conflicting_refresh' ELSE 'ok' END AS verdict FROM c""",
    "refresh_plan": r"""WITH cat AS (SELECT c_custkey AS user_id, 5+c_custkey%30 AS refresh_days FROM customer), h AS (SELECT user_id, max(ts) AS last_ts FROM events GROUP BY user_id) SELECT cat.user_id, CASE WHEN h.last_ts IS NULL THEN 'NEW' ELSE 'UPDATE' END AS status FROM cat LEFT JOIN h USING (user_id) WHERE h.last_ts IS NULL OR h.last_ts + to_days(CAST(refresh_days AS INTEGER)) < TIMESTAMP '2024-01-20'""",
    "latest_release_by": r"""WITH b AS (SELECT o_orderkey, o_custkey, CAST(year(o_orderdate) AS VARCHAR) AS release_year FROM orders), m AS (SELECT o_custkey, max(release_year) AS newest FROM b GROUP BY o_custkey) SELECT b.o_orderkey, b.o_custkey, b.release_year FROM b JOIN m ON b.o_custkey=m.o_custkey AND b.release_year=m.newest""",
    "catalog_duplicates": r"""WITH c AS (SELECT p_brand AS name, CASE WHEN p_size%3=0 THEN NULL ELSE CAST(2020+p_size%4 AS VARCHAR) END AS year FROM part) SELECT name, year, 'duplicate' AS problem FROM c GROUP BY name, year HAVING count(*)>1""",
    "dq_checks": r"""WITH t AS (SELECT l_orderkey, l_linenumber, nullif(l_returnflag,'R') AS flag, nullif(l_linestatus,'O') AS status FROM lineitem) SELECT 'lineitem' AS model, 'not_null' AS test, 'flag' AS col, count(*) FILTER (WHERE flag IS NULL) AS failures FROM t UNION ALL SELECT 'lineitem', 'not_null', 'status', count(*) FILTER (WHERE status IS NULL) FROM t UNION ALL SELECT 'lineitem', 'unique', 'l_orderkey', count(*) FROM (SELECT l_orderkey FROM t WHERE l_orderkey IS NOT NULL GROUP BY l_orderkey HAVING count(*)>1) d UNION ALL SELECT 'lineitem', 'unique', 'order_line', count(*) FROM (SELECT k FROM (SELECT CAST(l_orderkey AS VARCHAR)||'-'||CAST(l_linenumber AS VARCHAR) AS k FROM t) WHERE k IS NOT NULL GROUP BY k HAVING count(*)>1) e""",
    "graph_integrity": r"""WITH cn AS (SELECT c_custkey AS id FROM customer WHERE c_nationkey<20), onode AS (SELECT o_orderkey AS id FROM orders WHERE o_orderstatus='F'), pn AS (SELECT p_partkey AS id FROM part WHERE p_size>5) SELECT 'places' AS relationship, 'start' AS side, 'Customer' AS id_space, count(*) AS dangling FROM orders WHERE NOT EXISTS (SELECT 1 FROM cn WHERE cn.id=o_custkey) UNION ALL SELECT 'places', 'end', 'Order', count(*) FROM orders WHERE NOT EXISTS (SELECT 1 FROM onode WHERE onode.id=o_orderkey) UNION ALL SELECT 'contains', 'start', 'Order', count(*) FROM lineitem WHERE NOT EXISTS (SELECT 1 FROM onode WHERE onode.id=l_orderkey) UNION ALL SELECT 'contains', 'end', 'Part', count(*) FROM lineitem WHERE NOT EXISTS (SELECT 1 FROM pn WHERE pn.id=l_partkey)""",
}
