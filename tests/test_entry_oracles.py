"""Driver contract and every registered query against its DuckDB oracle (sf0.001)."""

import importlib.util
import os

import duckdb
import pytest

from tests.conftest import SF_SMALL
from tributary.plans.registry import load_all
from tributary.sources.tables import TABLES, table_path

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def _module(path, name):
    spec = importlib.util.spec_from_file_location(name, path)
    mod = importlib.util.module_from_spec(spec)
    spec.loader.exec_module(mod)
    return mod


entry_mod = _module(os.path.join(ROOT, "__spark_entry__.py"), "spark_entry")
checker = _module(os.path.join(ROOT, "scripts", "check_oracles.py"), "check_oracles")


def test_entry_runs(spark):
    df = entry_mod.entry(spark)
    assert df.count() > 0
    assert "status" in df.columns


def test_contract_keys():
    q = entry_mod.queries()
    sql = entry_mod.oracle_sql()
    assert set(sql) <= set(q)
    assert len(q) >= 40
    own = load_all()
    assert set(own) <= set(q)
    assert {name for name, x in own.items() if not x.sql} == {"workflow_pending"}


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{table_path(SF_SMALL, t)}')")
    return con


@pytest.mark.parametrize("name", sorted(n for n, q in load_all().items() if q.sql))
def test_query_matches_oracle(spark, duck, name):
    q = load_all()[name]
    df = q.build(spark, SF_SMALL)
    got = checker.digest(df.columns, [tuple(r) for r in df.collect()])
    rel = duck.sql(q.sql)
    want = checker.digest(rel.columns, rel.fetchall())
    assert got[:3] == want[:3]
