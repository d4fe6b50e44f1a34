"""Driver queries against their DuckDB oracle on the smallest tables, plus
the contract of ``__spark_entry__``."""

import math
import os

import duckdb
import pytest

import __spark_entry__ as E
from civgraph.plans import driver_models
from civgraph.plans.driver import QUERIES, TABLES

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables not present")


def _norm(v):
    if isinstance(v, float):
        return round(v, 9) if not math.isnan(v) else "nan"
    if hasattr(v, "isoformat"):
        return v.isoformat()
    return v


def _canon(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted((tuple(_norm(r[i]) for i in order) for r in rows), key=repr)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in {*TABLES, "benchmark"}:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return con


def test_entry(spark):
    df = E.entry(spark)
    assert df.columns == ["label", "kind", "rows"] and df.count() == 7


def test_every_query_has_an_oracle():
    own = set(QUERIES) | set(driver_models.QUERIES)
    assert own <= set(E.oracle_sql()) <= set(E.queries())


@pytest.mark.parametrize("name", sorted(E.oracle_sql()))
def test_query_matches_oracle(spark, duck, name):
    df = E.queries()[name](spark, SF)
    res = duck.execute(E.oracle_sql()[name])
    ocols = [d[0] for d in res.description]
    assert sorted(df.columns) == sorted(ocols)
    assert _canon(df.columns, [tuple(r) for r in df.collect()]) == _canon(ocols, res.fetchall())


def test_contract_and_subsidy_unions_shuffle_no_whole_rows(spark):
    for name in ("model_contract_union", "model_subsidy_union"):
        plan = E.queries()[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
        assert "Scan parquet" in plan and "Exchange" not in plan and "Aggregate" not in plan, name


def test_relationships_of_one_frame_are_joined_once(spark):
    plan = E.queries()["model_graph_relationships"](spark, SF)._jdf.queryExecution().optimizedPlan().toString()
    assert "Union" in plan and "LeftSemi" not in plan
