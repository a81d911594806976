"""Every registered query equals its DuckDB oracle (row count, columns, values)."""

import duckdb
import pytest

import __spark_entry__ as E
from canvass.plans.registry import QUERIES
from canvass.plans.oracle import FIXTURE_CTES
from canvass.sources.fixtures import FixtureWarehouse
from canvass.sources.warehouse import DOMAIN_TABLES
from tests.conftest import SF_SMALL
from tools.oracle_check import RAW, digest

KEYS = sorted(QUERIES)


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in RAW:
        c.execute(f"create view {t} as select * from read_parquet('{SF_SMALL}/{t}.parquet')")
    return c


def test_every_query_has_an_oracle():
    assert set(KEYS) <= set(E.oracle_sql()) and set(KEYS) <= set(E.queries())
    assert [k.split("_")[0] for k in KEYS] == [f"q{n:02d}" for n in range(1, 59)]


@pytest.mark.parametrize("key", KEYS)
def test_query_matches_oracle(spark, con, key):
    df = E.queries()[key](spark, SF_SMALL)
    got = [tuple(r) for r in df.collect()]
    cur = con.execute(E.oracle_sql()[key])
    ocols = [d[0].lower() for d in cur.description]
    want = cur.fetchall()
    assert sorted(df.columns) == sorted(ocols)
    assert len(got) == len(want)
    assert digest(df.columns, got) == digest(ocols, want)


@pytest.mark.parametrize("name", DOMAIN_TABLES + ["policy_term_base", "claim_line"])
def test_fixture_views_match_sql_definitions(spark, con, name):
    df = FixtureWarehouse(spark, SF_SMALL)[name]
    cur = con.execute(f"WITH {FIXTURE_CTES} select * from {name}")
    ocols = [d[0].lower() for d in cur.description]
    want = cur.fetchall()
    got = [tuple(r) for r in df.collect()]
    assert sorted(df.columns) == sorted(ocols), name
    assert digest(df.columns, got) == digest(ocols, want), name


def test_entry_runs(spark):
    out = E.entry(spark)
    assert out.columns == ["multi_pet", "ph"]
    assert out.count() > 0


SPARK_TO_DUCKDB = {"int": "INTEGER", "bigint": "BIGINT", "string": "VARCHAR", "date": "DATE", "boolean": "BOOLEAN",
                   "double": "DOUBLE"}


@pytest.mark.parametrize("key", KEYS)
def test_query_types_match_oracle(spark, con, key):
    spark_types = {f.name: f.dataType.simpleString() for f in E.queries()[key](spark, SF_SMALL).schema.fields}
    rel = con.sql(E.oracle_sql()[key])
    oracle_types = dict(zip(rel.columns, [str(t) for t in rel.types]))
    assert {c: SPARK_TO_DUCKDB.get(t, t.upper()) for c, t in spark_types.items()} == oracle_types


@pytest.mark.parametrize("name", ["policy_term_base", "claim_line"])
def test_fixture_numbering_exact_when_every_key_is_hot(spark, con, name):
    # hot_key_rows=1: every household / line with several rows takes the split path
    df = FixtureWarehouse(spark, SF_SMALL, hot_key_rows=1)[name]
    cur = con.execute(f"WITH {FIXTURE_CTES} select * from {name}")
    ocols = [d[0].lower() for d in cur.description]
    got = [tuple(r) for r in df.collect()]
    assert digest(df.columns, got) == digest(ocols, cur.fetchall())
