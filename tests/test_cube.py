"""The report cube against the single reports, and what it reads."""

import dataclasses
import random
import tempfile
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from canvass.config import FIXTURE_CONFIG
from canvass.operators.claims import AMOUNTS
from canvass.operators.enrich import PROFILE_COLUMNS
from canvass.operators.household import ROLLUP_COLUMNS, household_profile
from canvass.plans import cube as C
from canvass.plans import reports as R
from canvass.plans.pull import NarrowPull, SurveyPull
from canvass.plans.registry import QUERIES, pull_for
from canvass.sources.fixtures import FixtureWarehouse
from canvass.sources.warehouse import Warehouse
from tests.conftest import SF_SMALL
from tests.test_plans import plan


@pytest.fixture(scope="module")
def pull(spark):
    return pull_for(spark, SF_SMALL)


def listed(df):
    return [tuple(r) for r in df.collect()]


def test_cube_names_the_same_reports():
    assert list(C.REPORTS) == list(R.REPORTS)


@pytest.mark.parametrize("name", list(R.REPORTS))
def test_every_report_over_every_population(pull, name):
    alone = R.REPORTS[name][0]
    tagged = []
    for population, df in pull.populations.items():
        want = alone(df)
        got = pull.report(name, population)
        assert got.dtypes == want.dtypes
        # those that the source orders come back in its order
        assert (listed(got) == listed(want)) if name != "multipet_households" else (sorted(listed(got)) == sorted(listed(want)))
        tagged += [(population, *r) for r in listed(want)]
    assert sorted(map(str, listed(pull.report_by_population(name)))) == sorted(map(str, tagged))


def test_nulls_repeated_rows_and_empty_populations(spark):
    rng = random.Random(2)
    pick = lambda *x: rng.choice(x)

    def row(i):
        amount = lambda: pick(None, Decimal("-5.00"), Decimal("0.00"), Decimal("100.00"), Decimal("100.01"), Decimal("9999.99"))
        return (pick(None, f"H{i % 5}"), pick(None, f"P{i % 7}"), pick(None, 0, 1, 2, 7, 9), pick(0, 1, 2), pick(0, 1), pick(0, 1), pick(0, 2),
                pick(None, 0, 3, 5, 9), pick(None, 1, 4, 6), pick(None, "I250", "I250G", "M10", ""), pick(None, "", "OHIO"),
                pick(0, 1, 3), amount(), amount(), amount(), pick(0, 2), amount(), amount(), amount())

    money, n = "decimal(18,2)", "bigint"
    kinds = ["string", "string", n, n, n, n, n, "int", "int", "string", "string", n, money, money, money, n, money, money, money]
    schema = ", ".join(f"{c} {k}" for c, k in zip(C.COLUMNS, kinds, strict=True))
    rows = [row(i) for i in range(120)]
    populations = {"F1A": spark.createDataFrame(rows + rows[:40], schema), "F2": spark.createDataFrame(rows[20:60] * 2, schema),
                   "F2A": spark.createDataFrame(rows[30:31], schema), "F3": spark.createDataFrame([], schema)}
    cube = C.report_cube(populations).cache()
    for name, (alone, _) in R.REPORTS.items():
        for population, df in populations.items():
            got = C.report(cube, name, population, populations["F1A"])
            assert sorted(map(str, listed(got))) == sorted(map(str, listed(alone(df)))), (name, population)
    cube.unpersist()


def test_each_population_is_read_once_for_all_reports(pull):
    tree = plan(C.report_cube(pull.populations))
    assert tree.count("FileScan") == len(pull.populations) == 4
    for key, query in QUERIES.items():
        if "q18" <= key < "q32" and "q24" not in key or "q36" <= key < "q49":
            tree = plan(query(pull.spark, SF_SMALL))
            assert tree.count("FileScan") == 1 and "label_1" in tree.split("FileScan")[1], key


def narrow_pull(spark, tables):
    """A pull of its own: nothing is stored yet."""
    return SurveyPull(spark, tables, FIXTURE_CONFIG)


@pytest.fixture(scope="module")
def landed(spark):
    root = tempfile.mkdtemp(prefix="cube-wh-", dir="/tmp")
    FixtureWarehouse(spark, SF_SMALL).land(root)
    return Warehouse.from_parquet(spark, root)


def test_a_report_alone_makes_no_wide_stage(spark, landed, pull):
    alone = narrow_pull(spark, landed)
    for name in ("pets_topcoded", "product"):
        assert listed(alone.report(name)) == listed(R.REPORTS[name][0](pull.populations[R.REPORTS[name][1]]))
    made = set(alone.store.built)
    assert not made & {"claim_rollups", "nps_f1", "nps_f1a", "nps_f2", "nps_f2a", "nps_f3", "report_cube"}, made
    assert {"report_cube_pets_topcoded_F1A", "report_cube_product_F3"} <= made
    assert set(alone.nps_f3.columns) > set(alone._narrow[False].nps_f3.columns)
    alone.release()


def test_narrow_populations_have_the_rows_of_the_wide_ones(spark, landed, pull):
    for claims in (False, True):
        narrow = NarrowPull(narrow_pull(spark, landed), claims)
        for stage in R.POPULATIONS.values():
            got, want = getattr(narrow, stage), getattr(pull, stage).select(*narrow.columns)
            assert got.dtypes == want.dtypes and got.exceptAll(want).count() == want.exceptAll(got).count() == 0, (stage, claims)
    alone = narrow_pull(spark, landed)
    for name in ("product", "band_med_paid"):
        assert sorted(map(str, listed(alone.report_by_population(name)))) == sorted(map(str, listed(pull.report_by_population(name))))
    assert not {"report_cube", "nps_f1"} & set(alone.store.built)


def test_every_report_alone_says_what_it_reads(pull):
    for name, report in C.REPORTS.items():
        rows = pull.populations["F3"]
        few = rows.select(*C.columns_of({name: report}))
        got, want = (C.report(C.report_cube({"F3": df}, {name: report}), name, "F3", df) for df in (few, rows))
        assert sorted(map(str, listed(got))) == sorted(map(str, listed(want))), name


def test_a_tie_at_the_end_of_the_sample_is_decided_by_the_whole_rows(spark, landed, pull):
    f2a = pull.nps_f2a.select(*NarrowPull(pull, False).columns).limit(1)
    tied = f2a.withColumn("baseproduct", F.lit("M10")).unionByName(f2a.withColumn("baseproduct", F.lit("A1")))
    one = dataclasses.replace(FIXTURE_CONFIG, n_main=1)
    whole = SurveyPull(spark, landed, one)
    whole.__dict__["nps_f3"] = f2a.withColumn("baseproduct", F.lit("of the whole rows"))
    narrow = NarrowPull(whole, False)
    narrow.__dict__["nps_f2a"] = tied
    assert [r["baseproduct"] for r in narrow.nps_f3.collect()] == ["of the whole rows"]
    same = NarrowPull(SurveyPull(spark, landed, one), False)
    same.__dict__["nps_f2a"] = f2a.unionByName(f2a)                     # copies of one row: any of them
    assert listed(same.nps_f3) == listed(f2a)


def test_without_rollups_the_profile_has_the_same_rows(spark):
    profile = spark.createDataFrame([(i, p, "C1", "G1", "9") for i, p in enumerate(["P1", "P1", None, "P2"])],
                                    "policyid int, policy_no string, insured_code string, group_code string, insured_zipcode string")
    for c in PROFILE_COLUMNS:
        if c not in profile.columns:
            profile = profile.withColumn(c, F.lit(1 if c == "policy_renew_no" else None).cast("int" if c == "policy_renew_no" else "string"))
    profile = profile.select(*PROFILE_COLUMNS)
    money = [f"{k}_{a}" for k in ("med", "well") for a in AMOUNTS]
    rollups = spark.createDataFrame([("P1", 1, 2, *[Decimal("1.00")] * 6), (None, 3, 4, *[Decimal("2.00")] * 6)],
                                    "policy_no string, medcount long, vrcccount long, " + ", ".join(f"{m} decimal(18,2)" for m in money))
    zips = spark.createDataFrame([("9", 5), ("9", 6)], "zipcode string, incomeperhousehold int")        # repeated keys repeat rows
    group = spark.createDataFrame([("G1", "a"), ("G1", "b")], "group_code string, group_name string")
    with_, without = (household_profile(profile, r, zips, group) for r in (rollups, None))
    assert not set(ROLLUP_COLUMNS) & set(without.columns)
    assert sorted(map(str, listed(with_.drop(*ROLLUP_COLUMNS)))) == sorted(map(str, listed(without)))
