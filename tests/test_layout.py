"""Claim tables in buckets by policy: the same rollups, without a shuffle of claim lines."""

import tempfile
import uuid

import pytest
from pyspark.sql import functions as F

from canvass.operators.claims import claim_rollups
from canvass.plans.registry import pull_for
from canvass.sources.layout import MIN_BUCKETS, buckets_for, cluster_claims, largest_share, with_policy
from canvass.sources.warehouse import Warehouse
from tests.conftest import SF_SMALL, rows
from tests.test_plans import plan

NAMES = ["dw_policy_header", "dw_claim_header", "dw_claim_revision", "dw_claim_diagnosis", "dw_claim_details"]


def database(spark):
    name = f"layout_{uuid.uuid4().hex[:8]}"
    spark.sql(f"CREATE DATABASE {name} LOCATION '{tempfile.mkdtemp(prefix='layout-', dir='/tmp')}'")
    return name


def rollups(t, coverage):
    return claim_rollups(*[t[n] for n in NAMES], coverage)


@pytest.fixture(scope="module")
def pull(spark):
    return pull_for(spark, SF_SMALL)


@pytest.fixture(autouse=True)
def no_broadcast(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_the_chain_is_joined_in_its_buckets(spark, pull):
    t = cluster_claims(spark, pull.t, database(spark), 4)
    got = rollups(t, pull.dim("dw_dim_coverage"))
    tree = plan(got)
    exchanges = [line for line in tree.splitlines() if "Exchange hashpartitioning" in line]
    assert exchanges and all("policy_no" in line and "claim_id" not in line and "policyid" not in line for line in exchanges)
    assert tree.count("Bucketed: true") == 5
    want = pull.claim_rollups
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0


def test_orphans_and_shared_claims_give_the_same_rollups(spark, pull):
    cov = spark.createDataFrame([(1, "Wellcare"), (2, "Base")], "coverage_id int, coverage_product_type string")
    tables = {
        "dw_policy_header": spark.createDataFrame([(1, "P1"), (2, "P2"), (3, "P2"), (None, "P9")], "policyid long, policy_no string"),
        # c1 belongs to two policies, c2 stands twice, c4's policy is unknown
        "dw_claim_header": spark.createDataFrame([(1, "c1", "n1"), (2, "c1", "n1"), (2, "c2", "n2"), (2, "c2", None), (9, "c4", "n4")],
                                                 "policyid long, claim_id string, claim_no string"),
        "dw_claim_revision": spark.createDataFrame([("c1", 1, "Complete"), ("c1", 2, "Reopened"), ("c2", 1, "Complete"), ("c4", 1, "Complete"),
                                                    ("cX", 1, "Complete"), (None, 1, "Complete")],
                                                   "claim_id string, claim_revision_no int, claim_revision_status string"),
        "dw_claim_diagnosis": spark.createDataFrame([("c1", 1, "d1", 1), ("c1", 2, "d2", 1), ("c1", 1, "d3", 2), ("c2", 1, "d4", 2), ("c2", 1, "d4", 2),
                                                     ("c4", 1, "d5", 1), ("cX", 1, "d6", 1), (None, 1, None, 1)],
                                                    "claim_id string, claim_revision_no int, claim_diagnosis_id string, claim_coverage_id int"),
        "dw_claim_details": spark.createDataFrame([("d1", 1), ("d1", 2), ("d2", 4), ("d3", 8), ("d4", 16), ("d5", 32), ("d6", 64), ("dX", 128), (None, 256)],
                                                  "claim_diagnosis_id string, a int").select(
            "claim_diagnosis_id", *[F.col("a").cast("decimal(12,2)").alias(c) for c in ("claimedamount", "paidamount", "eligibleamount")]),
    }
    t = Warehouse(spark, {n: (lambda df=df: df) for n, df in tables.items()})
    want = rows(rollups(t, cov))
    assert [r[0] for r in want] == ["P1", "P2"]
    assert rows(rollups(with_policy(t), cov)) == want
    assert rows(rollups(cluster_claims(spark, t, database(spark), 3), cov)) == want


def test_tables_with_an_uneven_bucket_are_read_without_buckets(spark, pull):
    t = cluster_claims(spark, pull.t, database(spark), 4, uneven=0.5, small=1)
    tree = plan(rollups(t, pull.dim("dw_dim_coverage")))
    assert "Bucketed: true" not in tree and "hashpartitioning(policyid" in tree
    got, want = rollups(t, pull.dim("dw_dim_coverage")), pull.claim_rollups
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0
    hot = spark.range(900).select(F.when(F.col("id") < 300, 7).otherwise(F.col("id")).alias("policyid"))
    assert largest_share(hot, 16, small=10) > 5 and largest_share(hot, 16) == 0


def test_buckets_grow_with_the_details(spark, pull):
    few, many = buckets_for(pull.t), buckets_for(pull.t, bucket_bytes=1000)
    assert few == MIN_BUCKETS and many > 4 * MIN_BUCKETS
    twice = pull.t.with_table("dw_claim_details", pull.t["dw_claim_details"].unionAll(pull.t["dw_claim_details"]))
    assert buckets_for(twice, bucket_bytes=1000) in (2 * many - 1, 2 * many)


def test_policies_come_from_copies_that_lie_by_policy(spark, pull):
    name, seen = database(spark), {}

    def keep(table, df):
        seen[table] = plan(df)
        df.write.bucketBy(4, "policyid").saveAsTable(f"{name}.{table}")
        return spark.table(f"{name}.{table}")

    got = with_policy(pull.t, keep)
    # two sides a join, and no shuffle to tell the different claims and policies
    assert [seen[n].count("Exchange hashpartitioning") for n in ("dw_claim_revision", "dw_claim_diagnosis", "dw_claim_details")] == [2, 2, 2]
    want = with_policy(pull.t)
    for table in NAMES:
        assert got[table].columns == want[table].columns and rows(got[table]) == rows(want[table])
