"""Cross-stage invariants of the pull (the source's manual tie-outs)."""

from pyspark.sql import functions as F

from canvass.config import FIXTURE_CONFIG
from canvass.plans import reports as R
from canvass.plans.pull import SurveyPull
from canvass.plans.registry import pull_for
from canvass.sources.fixtures import FixtureWarehouse
from tests.conftest import SF_SMALL, rows


def _pull(spark):
    return pull_for(spark, SF_SMALL)


def test_funnel_never_grows(spark):
    f = dict(rows(_pull(spark).funnel(), "stage", "row_count"))
    assert f["nps_f1"] >= f["nps_f1a"] >= f["nps_f2a"] >= f["nps_f3"]
    assert f["nps_f2"] >= f["nps_f2a"]
    assert f["nps_f3"] == min(FIXTURE_CONFIG.n_main, f["nps_f2a"])
    assert f["nps_f4a"] == min(FIXTURE_CONFIG.n_new, f["nps_f4"])


def test_samples_are_disjoint(spark):
    p = _pull(spark)
    assert p.nps_f3.join(p.nps_f4, "policyid", "left_semi").count() == 0
    assert p.nps_f4a.join(p.nps_f3, "policyid", "left_semi").count() == 0


def test_mix_report_ties_to_term_cross_tabs(spark):
    p = _pull(spark)
    for pop in (p.nps_f1a, p.nps_f3):
        mix = R.species_mix_report(pop).agg(F.sum("ph")).first()[0]
        by_min = R.mix_by_term(pop, "min_term").agg(F.sum("ph")).first()[0]
        by_max = R.mix_by_term(pop, "max_term").agg(F.sum("ph")).first()[0]
        assert mix == by_min == by_max


def test_pet_count_report_totals_population(spark):
    p = _pull(spark)
    assert R.pets_topcoded_report(p.nps_f1a).agg(F.sum("ph_count")).first()[0] == p.nps_f1a.count()


def test_household_species_counts_within_total(spark):
    bad = _pull(spark).nps_f1.filter(
        F.col("dogs") + F.col("cats") + F.col("avian") + F.col("exoticothers") > F.col("total_pets"))
    assert bad.count() == 0


def test_sample_independent_of_partitioning(spark):
    a = rows(_pull(spark).nps_f3, "policyid")
    old = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "3")
    try:
        p = SurveyPull(spark, FixtureWarehouse(spark, SF_SMALL), FIXTURE_CONFIG)
        assert rows(p.nps_f3, "policyid") == a
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)


def test_reports_come_back_in_source_order(spark):
    p = _pull(spark)
    bands = [r[0] for r in R.amount_band_report(p.nps_f1a, "medicalclaimamount", "g", "medicalclaimcount").collect()]
    assert bands == sorted(bands, key=lambda b: (b is None, b))
    terms = [r[0] for r in R.term_by_stage(p.nps_f1a, p.nps_f2a, p.nps_f3).collect()]
    assert terms == sorted(terms) and terms[-1] == 18


def test_shuffle_join_plans_give_the_same_pull(spark):
    # automatic broadcast off: the plan shapes of tables too large to broadcast
    base = _pull(spark)
    keys = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")
    for k in keys:
        spark.conf.set(k, "-1")
    try:
        p = SurveyPull(spark, base.t, FIXTURE_CONFIG)
        assert sorted(p.nps_f1.collect()) == sorted(base.nps_f1.collect())
        assert rows(p.nps_f3, "policyid") == rows(base.nps_f3, "policyid")
        assert p.nps_f4.count() == base.nps_f4.count()
    finally:
        for k in keys:
            spark.conf.unset(k)


def test_stages_live_in_the_checkpoint_folder(spark):
    p = _pull(spark)
    from urllib.parse import urlparse
    root = urlparse(spark.sparkContext.getCheckpointDir()).path
    for stage in (p.ah_inforce, p.inforce_quarterly, p.nps_f1_full, p.nps_f2a, p.nps_f3):
        files = stage.inputFiles()
        assert files and all(urlparse(f).path.startswith(root) for f in files)
    again = p.prepare()                       # idempotent: the same stage objects
    assert again is p and again.nps_f3 is p.nps_f3
