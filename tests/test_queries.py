import glob
import os

import duckdb
import pytest

from tidegrain.plans import queries_levels, queries_reports, queries_tables  # noqa: F401
from tidegrain.plans.queries import ORACLES, QUERIES

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for p in glob.glob(f"{SF}/*.parquet"):
        con.execute(f"create view {os.path.basename(p)[:-8]} as select * from '{p}'")
    return con


def rows(values, cols):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted(tuple(str(r[i]) for i in order) for r in values)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_its_sql(spark, duck, name):
    df = QUERIES[name](spark, SF)
    r = duck.execute(ORACLES[name])
    cols = [c[0] for c in r.description]
    assert sorted(cols) == sorted(df.columns)
    assert rows(df.collect(), df.columns) == rows(r.fetchall(), cols)


def test_entry(spark):
    import __spark_entry__ as e

    assert e.entry(spark).count() > 0
    assert set(e.oracle_sql()) <= set(e.queries())


def test_core_queries_stay_without_what_llm_needs(monkeypatch):
    import sys

    import __spark_entry__ as e

    for name in [n for n in sys.modules if n.startswith("tidegrain.llm") or n == "corpus_pipeline"]:
        monkeypatch.delitem(sys.modules, name)
    monkeypatch.setitem(sys.modules, "xxhash", None)  # importing it fails
    monkeypatch.setitem(sys.modules, "tidegrain.llm", None)
    assert set(e.queries()) == set(QUERIES) and set(e.oracle_sql()) == set(ORACLES)
