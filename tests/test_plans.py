"""Physical-plan properties the design relies on at scale."""

import pytest

from canvass.operators.joins import dimension
from canvass.operators.sampling import random_sample
from canvass.plans.registry import pull_for
from tests.conftest import SF_SMALL


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def pull(spark):
    return pull_for(spark, SF_SMALL)


def test_report_date_prunes_inforce_partitions(pull):
    # the landed in-force fact is partitioned by report period
    scan = [line for line in plan(pull.ah_inforce_plan()).splitlines() if "reportperiod" in line and "FileScan" in line]
    assert scan and "PartitionFilters: [isnotnull(reportperiod" in scan[0] and "= 2013-02-28)" in scan[0]


def test_reopened_filter_reaches_revision_scan(pull):
    assert "Not(EqualTo(claim_revision_status,Reopened))" in plan(pull.claim_rollups_plan())


def test_header_scan_is_pruned(pull):
    # the enrichment reads the header's dimension keys, not its other columns
    p = plan(pull._inforce_quarterly())
    schemas = [line.split("ReadSchema: ")[1] for line in p.splitlines() if "ReadSchema: " in line]
    # file order is policyid, policy_no, policy_renew_no, insured_code, zipcode_id,
    # effective_date, ...: pruned columns would show before effective_date
    header = [s for s in schemas if "effective_date" in s and "insured_code" in s]
    assert header
    assert all("zipcode_id" not in s and "policy_renew_no" not in s and "policy_no" not in s for s in header)


def test_household_columns_use_aggregation_not_windows(pull):
    from canvass.operators.household import household_stats
    p = plan(household_stats(pull.inforce_quarterly, pull.dim("dw_dim_group"), pull.referrals))
    assert "Window" not in p
    assert "partial_min" in p and "partial_count" in p


def test_exclusions_are_anti_joins(pull):
    p = plan(pull.nps_f2_plan())
    assert p.count("LeftAnti") >= 2
    assert "LeftOuter" not in p


def test_minus_is_null_safe_anti_join(pull):
    p = pull.nps_f4_plan()._jdf.queryExecution().optimizedPlan().toString()
    assert "Join LeftAnti" in p and "<=>" in p


def test_dimension_broadcast_only_below_bound(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        big = spark.range(10_000).withColumnRenamed("id", "k")
        small = spark.range(5).withColumnRenamed("id", "k")
        assert "BroadcastHashJoin" in plan(big.join(dimension(small, 100), "k"))
        assert "BroadcastHashJoin" not in plan(big.join(dimension(big.select("k"), 100), "k"))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_sample_ranks_only_the_straddling_bucket(spark):
    pop = spark.range(50_000).withColumnRenamed("id", "policyid")
    p = plan(random_sample(pop, 1000, 42))
    # every row below the cut is taken by a filter; only one bucket is ranked
    assert "TakeOrderedAndProject" in p
    assert "substring(md5" in p


def test_size_check_goes_by_bytes_and_runs_no_job(spark):
    import tempfile

    from canvass.operators.joins import bytes_at_most, size_in_bytes
    path = tempfile.mkdtemp(prefix="files-", dir="/tmp") + "/t"
    spark.range(3000).repartition(150).write.parquet(path)
    t = spark.read.parquet(path)
    assert t.rdd.getNumPartitions() > 1
    assert bytes_at_most(t, 1 << 20) and not bytes_at_most(t, 1000)     # many small files are still small
    assert size_in_bytes(t.crossJoin(t.limit(5))) > size_in_bytes(t)    # an unstored join counts as large


def test_sample_of_a_many_file_population_is_stored_in_few_files_and_broadcast(spark):
    import tempfile

    from canvass.config import FIXTURE_CONFIG
    from canvass.plans.pull import SurveyPull
    from canvass.plans.registry import pull_for
    from tests.conftest import SF_SMALL
    base = pull_for(spark, SF_SMALL)
    path = tempfile.mkdtemp(prefix="f2a-", dir="/tmp") + "/t"
    base.nps_f2a.repartition(300).write.parquet(path)
    p = SurveyPull(spark, base.t, FIXTURE_CONFIG)
    p.__dict__["nps_f2a"] = spark.read.parquet(path)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert len(p.nps_f3.inputFiles()) == 1
        f4 = plan(p.nps_f4_plan())
        assert "BroadcastHashJoin" in f4 and "SortMergeJoin" not in f4
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_claim_details_meet_only_kept_diagnoses(spark):
    p = pull_for(spark, SF_SMALL)
    text = p.claim_rollups_plan()._jdf.queryExecution().optimizedPlan().toString()
    # no aggregate lies below the join with the details: coverage and revisions are applied first
    top = text.splitlines()
    details = next(i for i, l in enumerate(top) if "eligibleamount" in l and "Relation" in l)
    depth = len(top[details]) - len(top[details].lstrip(" :+-|"))
    below = [l for l in top[details:] if len(l) - len(l.lstrip(" :+-|")) >= depth]
    assert not any("Aggregate" in l for l in below)
    assert any("Reopened" in l for l in top) and any("coverage_product_type" in l for l in top)


def test_each_stage_is_built_once(spark, monkeypatch):
    from canvass.config import FIXTURE_CONFIG
    from canvass.plans.pull import SurveyPull
    built = []
    plain = SurveyPull._materialise
    monkeypatch.setattr(SurveyPull, "_materialise", lambda self, df, name, **kw: (built.append(name), plain(self, df, name, **kw))[1])
    p = SurveyPull(spark, pull_for(spark, SF_SMALL).t, FIXTURE_CONFIG).prepare()
    p.funnel().collect()
    assert len(built) == len(set(built)) and {"households", "cancellations", "nps_f1", "nps_f1a", "nps_f4a"} <= set(built)
