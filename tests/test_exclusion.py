"""Exclusions behind a filter: equal to the plain anti join, and only probable matches move."""

import tempfile

import pytest
from pyspark.sql import functions as F

from canvass.operators.exclusion import IN_MEMORY, bloom_filter, blocks_for, exclude, probed
from canvass.plans.registry import pull_for
from tests.conftest import SF_SMALL
from tests.test_plans import plan

BOUND = 80_000


def stored(spark, df):
    path = tempfile.mkdtemp(prefix="exclusion-", dir="/tmp") + "/t"
    df.write.parquet(path)
    return spark.read.parquet(path)


@pytest.fixture(scope="module")
def tables(spark):
    code = F.concat(F.lit("C"), F.col("id").cast("string"))
    rows = spark.range(20_000).select(F.when(F.col("id") % 10 != 0, code).alias("k"),
                                      F.when(F.col("id") % 9 != 0, (F.col("id") % 500).cast("string")).alias("mail"), "id")
    # duplicates and a NULL in the lists
    k = spark.range(0, 20_000, 7).select(code.alias("k")).unionByName(spark.range(0, 300, 7).select(code.alias("k"))).unionByName(
        spark.range(1).select(F.lit(None).cast("string").alias("k")))
    mail = spark.range(40).select((F.col("id") * 11).cast("string").alias("mail"))
    return stored(spark, rows), stored(spark, k), stored(spark, mail)


@pytest.mark.parametrize("bound", [None, 10**9, BOUND, 4_000, 96, 0])
def test_result_is_that_of_the_plain_anti_joins(tables, bound):
    rows, k, mail = tables
    want = sorted(r["id"] for r in rows.join(k, "k", "left_anti").join(mail, "mail", "left_anti").collect())
    got = exclude(rows, {"k": k, "mail": mail}, bound, 0 if bound == BOUND else None)
    assert got.columns == rows.columns
    assert sorted(r["id"] for r in got.collect()) == want


def test_filter_passes_every_listed_key_few_others_and_no_null(tables):
    rows, k, _ = tables
    blocks = blocks_for(k.count(), BOUND)
    flagged = probed(rows, "k", bloom_filter(k, "k", blocks), blocks, "may")
    listed = rows.join(k, "k", "left_semi").count()
    assert flagged.filter("may").join(k, "k", "left_semi").count() == listed
    assert listed <= flagged.filter("may").count() < 1.03 * listed
    assert flagged.filter("may and k is null").count() == 0
    assert flagged.count() == rows.count()


def test_a_false_positive_stays_in(spark, tables):
    _, k, _ = tables
    blocks = blocks_for(k.count(), 9_000)
    assert 0 < blocks < blocks_for(k.count(), BOUND)  # few bits a key: false positives are certain
    others = stored(spark, spark.range(50_000).select(F.concat(F.lit("X"), F.col("id").cast("string")).alias("k")))
    false = probed(others, "k", bloom_filter(k, "k", blocks), blocks, "may").filter("may").count()
    assert false > 0
    assert exclude(others, {"k": k}, 9_000 // IN_MEMORY).count() == 50_000


def test_only_rows_that_may_be_listed_are_shuffled(spark, tables):
    rows, k, _ = tables
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        tree = plan(exclude(rows, {"k": k}, BOUND, 0))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    stay, checked = tree.split("SortMergeJoin")
    # unlisted rows: scanned, flagged by the broadcast filter, never exchanged by key
    assert stay.startswith("Union") and "BroadcastHashJoin" in stay and "hashpartitioning(k" not in stay
    # the others: the flag is tested before the exchange, so it alone decides what moves
    rows_side = checked[checked.index("hashpartitioning(k"):]
    assert rows_side.index("Filter") < rows_side.index("Scan") and rows_side.index("BroadcastHashJoin") < rows_side.index("Scan")


def test_size_of_the_filter_is_bounded():
    assert blocks_for(10**6, 64 << 20) == 62_500
    assert blocks_for(10**7, 64 << 20) * 96 <= 64 << 20
    assert blocks_for(10**10, 64 << 20) == 0  # too few bits a key: the plain join
    assert blocks_for(0, 1_000) == 1 and blocks_for(5, 0) == 0


def test_eligible_population_is_the_same(spark):
    p = pull_for(spark, SF_SMALL)
    assert "bit_or" in plan(p.nps_f2_plan(max_list_bytes=0)) and "bit_or" not in plan(p.nps_f2_plan())
    a, b = p.nps_f2_plan(max_list_bytes=0), p.nps_f2
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0
