"""Registered queries of the training-data operators: SQL oracles, brute force, entry module."""

from __future__ import annotations

import duckdb
import pytest

import __spark_entry__ as E
from canvass.llm import registry
from canvass.llm import simhash as H
from tests.conftest import SF_MID, SF_SMALL
from tools.oracle_check import digest

from .test_pair_operators import groups


@pytest.mark.parametrize("key", sorted(registry.ORACLE_SQL))
def test_query_matches_its_sql(spark, key):
    con = duckdb.connect()
    for t in ("documents", "conversations", "embeddings"):
        con.execute(f"create view {t} as select * from read_parquet('{SF_MID}/{t}.parquet')")
    df = E.queries()[key](spark, SF_MID)
    cur = con.execute(E.oracle_sql()[key])
    names = [d[0] for d in cur.description]
    assert sorted(df.columns) == sorted(names)
    assert digest(df.columns, [tuple(r) for r in df.collect()]) == digest(names, cur.fetchall())


def test_entry_registers_every_operator_and_the_pipeline():
    names = E.queries()
    assert {f"op{n}" for n in range(1, 14)} <= {k.split("_")[0] for k in names} and "pipeline" in names
    assert set(registry.ORACLE_SQL) <= set(E.oracle_sql()) <= set(names)


def test_simhash_query_equals_brute_force(spark):
    got = E.queries()["op10_simhash_near_dedup"](spark, SF_MID).collect()
    fps = {r.doc_id: int(r.fingerprint, 16) for r in got}
    nodes = sorted(set(fps.values()))
    root = groups([(a, b) for k, a in enumerate(nodes) for b in nodes[k + 1:] if (a ^ b).bit_count() <= H.MAX_BITS], nodes)
    name = {}
    for i, f in fps.items():
        name[root[f]] = min(i, name.get(root[f], i))
    assert len(got) == spark.read.parquet(f"{SF_MID}/documents.parquet").count()
    assert all(r.component_id == name[root[fps[r.doc_id]]] for r in got)


def test_pipeline_query_runs_whole(spark):
    out = E.queries()["pipeline"](spark, SF_SMALL)
    assert out.count() > 0 and "token_ids" in out.columns
