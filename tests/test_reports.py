"""Reports on literal rows, and the pull under every materialisation mode."""

from dataclasses import replace
from decimal import Decimal

import pytest

from canvass.config import FIXTURE_CONFIG
from canvass.plans import reports as R
from canvass.plans.pull import SurveyPull
from canvass.plans.registry import pull_for
from canvass.sources.warehouse import Warehouse
from tests.conftest import SF_SMALL, rows


def test_species_by_stage_drops_null_species(spark):
    a = spark.createDataFrame([("C",), ("C",), (None,), ("F",)], "speciescode string")
    b = spark.createDataFrame([("C",), (None,), ("F",)], "speciescode string")
    c = spark.createDataFrame([("C",), (None,)], "speciescode string")
    assert rows(R.species_by_stage(a, b, c)) == [("C", 2, 1, 1)]


def test_multipet_counts_distinct_holders(spark):
    pop = spark.createDataFrame([("H1", 2), ("H1", 2), ("H2", 9), ("H3", None), ("H4", 1)],
                                "insured_code string, total_pets bigint")
    assert rows(R.multipet_households(pop)) == [(1, 1), (2, 1), (7, 2)]


def test_top_states_paid_in_full(spark):
    pop = spark.createDataFrame([(i, s) for i, s in enumerate(["B", "B", "A", "A", "C", None, None])],
                                "policyid bigint, insured_state string")
    header = spark.createDataFrame([(i, 0 if i != 4 else 1) for i in range(7)], "policyid bigint, paymentplan_id int")
    plan = spark.createDataFrame([(0, 0), (1, 1)], "paymentplan_id int, paymentplantypeid int")
    ptype = spark.createDataFrame([(0, "PIF"), (1, "MONTHLY")], "paymentplantype_id int, paymentplantype string")
    got = [tuple(r) for r in R.top_states_paid_in_full(pop, header, plan, ptype, k=2).collect()]
    assert got == [("A", 2), ("B", 2)]          # C is monthly; ties broken by state, NULL last
    got3 = [tuple(r) for r in R.top_states_paid_in_full(pop, header, plan, ptype, k=3).collect()]
    assert got3 == [("A", 2), ("B", 2), (None, 2)]


def test_band_report_counts_distinct_policies(spark):
    d = Decimal
    pop = spark.createDataFrame([("P1", d("50.00"), 1), ("P1", d("50.00"), 1), ("P2", d("150.00"), 0),
                                 ("P3", d("-1.00"), 0), ("P4", None, 2)],
                                "policy_no string, amt decimal(18,2), cnt bigint")
    assert rows(R.amount_band_report(pop, "amt", "band", "cnt")) == [(None, 2), ("a0 to 100", 1), ("b101 to 200", 1)]
    assert rows(R.amount_band_report(pop, "amt", "band", "cnt", strictly_positive=True)) == [(None, 1), ("a0 to 100", 1)]


def test_product_and_state_reports(spark):
    pop = spark.createDataFrame([("I250", "X"), ("I250G", "X"), ("M10", None)], "baseproduct string, insured_state string")
    assert [tuple(r) for r in R.product_report(pop).collect()] == [("I250 (Reg/I250G)", 2), ("M10", 1)]
    assert [tuple(r) for r in R.state_report(pop).collect()] == [("X", 2), (None, 1)]


@pytest.mark.parametrize("mode", ["persist", "checkpoint", "none"])
def test_materialisation_modes_agree(spark, mode):
    base = pull_for(spark, SF_SMALL)
    p = SurveyPull(spark, base.t, replace(FIXTURE_CONFIG, materialize=mode))
    assert p.nps_f2a.count() == base.nps_f2a.count()
    assert rows(p.nps_f3, "policyid") == rows(base.nps_f3, "policyid")
    p.release()


def test_warehouse_from_catalog(spark):
    spark.range(4).createOrReplaceTempView("canvass_test_t")
    wh = Warehouse.from_catalog(spark, names=["canvass_test_t"])
    assert wh["canvass_test_t"].count() == 4
