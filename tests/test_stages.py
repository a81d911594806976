"""Stages are written once, believed only when whole, taken up by the next pull, and gone after release."""

import json
import os
import tempfile
import time

import pytest
from pyspark.sql import functions as F

from canvass.config import FIXTURE_CONFIG, Config
from canvass.plans import pull as P
from canvass.plans.pull import SurveyPull
from canvass.plans.registry import pull_for
from canvass.plans.stages import StageStore, input_digest, run_key
from canvass.sources import files
from canvass.sources.fixtures import FixtureWarehouse
from canvass.sources.warehouse import Warehouse
from tests.conftest import SF_SMALL, rows
from tests.test_plans import plan

ALL = ["ah_inforce", "cancellations", "claim_rollups", "households", "inforce_quarterly", "nps_f1", "nps_f1a", "nps_f2", "nps_f2a",
       "nps_f3", "nps_f4", "nps_f4a", "nps_scrubber", "referrals", "report_cube"]


@pytest.fixture(scope="module")
def warehouse(spark):
    root = tempfile.mkdtemp(prefix="stages-wh-", dir="/tmp")
    FixtureWarehouse(spark, SF_SMALL).land(root)
    return root


def folder():
    return tempfile.mkdtemp(prefix="stages-", dir="/tmp") + "/run"


def new_pull(spark, warehouse, run_dir, config=FIXTURE_CONFIG):
    return SurveyPull(spark, Warehouse.from_parquet(spark, warehouse), config, run_dir=run_dir)


def test_a_killed_pull_is_taken_up_where_it_ended(spark, warehouse, monkeypatch):
    run = folder()
    first = new_pull(spark, warehouse, run)
    with monkeypatch.context() as m:
        m.setattr(P, "first_policy_per_holder", lambda f1: 1 / 0)      # ends after F1
        with pytest.raises(ZeroDivisionError):
            first.prepare()
    before = set(first.store.built)
    assert "nps_f1" in before and "nps_f1a" not in before
    times = {n: os.path.getmtime(f"{run}/{n}/_SUCCESS") for n in before}
    spark.range(3).write.parquet(f"{run}/nps_f1a")                     # a folder without an entry: nobody believes it
    second = new_pull(spark, warehouse, run).prepare()
    assert set(second.store.built) == set(ALL) - before
    assert {n: os.path.getmtime(f"{run}/{n}/_SUCCESS") for n in before} == times
    whole = pull_for(spark, SF_SMALL)
    for name in ("nps_f1a", "nps_f2a", "nps_f3", "nps_f4a"):
        a, b = getattr(second, name), getattr(whole, name)
        assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0
    assert rows(second.funnel()) == rows(whole.funnel())               # counts of both parts of the run
    third = new_pull(spark, warehouse, run).prepare()
    assert third.store.built == [] and rows(third.funnel()) == rows(whole.funnel())


def test_a_stage_that_fails_while_it_is_written_is_not_entered(spark):
    store = StageStore(spark, folder(), "k")
    store.publish("a", spark.range(5))
    assert store.entry("a") and store.counts("a") == {"rows": 5}
    broken = spark.range(5).withColumn("x", F.raise_error(F.lit("lost")))
    with pytest.raises(Exception, match="lost"):
        store.publish("a", broken)                                     # withdrawn before it is written anew
    assert store.entry("a") is None
    with pytest.raises(LookupError):
        store.read("a")
    store.publish("a", spark.range(7), {"even": F.count(F.when(F.col("id") % 2 == 0, 1))})
    assert store.counts("a") == {"rows": 7, "even": 4} and store.read("a").count() == 7
    files.delete(spark, store.path("a"))                               # the folder is gone, the entry still there
    assert store.entry("a") is None


def test_other_parameters_or_inputs_build_anew(spark, warehouse):
    run = folder()
    store = lambda key: StageStore(spark, run, key)
    store("one").publish("a", spark.range(2))
    assert store("one").entry("a") and store("two").entry("a") is None
    key = run_key(FIXTURE_CONFIG, "x")
    assert key != run_key(FIXTURE_CONFIG, "y") and key != run_key(Config(n_main=201, n_new=100), "x")
    assert key == run_key(Config(n_main=200, n_new=100, hot_key_rows=7, broadcast_max_bytes=9), "x")   # these change no row
    root = tempfile.mkdtemp(prefix="digest-", dir="/tmp")
    path = f"{root}/list.csv"
    open(path, "w").write("insured_code\nC1\n")
    tables = {"l": spark.read.csv(path), "p": Warehouse.from_parquet(spark, warehouse)["dw_cancel"]}
    before = input_digest(spark, tables)
    assert before == input_digest(spark, tables)
    time.sleep(0.02)
    open(path, "w").write("insured_code\nC2\n")                        # same name, same length
    assert input_digest(spark, {"l": spark.read.csv(path), "p": tables["p"]}) != before
    assert input_digest(spark, {"l": spark.range(3)}) == input_digest(spark, {"l": spark.range(4)})    # no files: cannot be seen


def test_release_deletes_the_run(spark, warehouse):
    run = folder()
    p = new_pull(spark, warehouse, run)
    p.referrals
    assert os.path.isdir(f"{run}/referrals") and json.load(open(f"{run}/_manifest/referrals.json"))["counts"]["rows"] == p.referrals.count()
    p.release()
    assert not os.path.exists(run)
    q = SurveyPull(spark, Warehouse.from_parquet(spark, warehouse), FIXTURE_CONFIG)
    q.referrals
    at = q.store.root.removeprefix("file:")
    assert os.path.isdir(at)
    q.release()
    assert not os.path.exists(at)


def test_run_dir_needs_stored_stages(spark, warehouse):
    with pytest.raises(ValueError, match="run_dir"):
        new_pull(spark, warehouse, folder(), Config(materialize="persist"))


def test_funnel_reads_no_stage(spark):
    p = pull_for(spark, SF_SMALL)
    tree = plan(p.funnel())
    assert tree.count("FileScan") == 2 == tree.count("ReadSchema: struct<>")     # the two hand-loaded lists
    counts = dict(map(tuple, p.funnel().collect()))
    for stage in ("ah_inforce", "inforce_well_dw", "inforce_med_dw", "nps_f1", "nps_f1a", "nps_f2", "nps_f3", "nps_f4a"):
        assert counts[stage] == getattr(p, stage).count()


def test_the_command_line_writes_no_stage_twice(spark, warehouse, monkeypatch):
    from canvass.__main__ import run
    written = []
    publish = StageStore.publish
    monkeypatch.setattr(StageStore, "publish", lambda self, name, *a, **k: (written.append(name), publish(self, name, *a, **k))[1])
    out = folder()
    tables = Warehouse.from_parquet(spark, warehouse)
    funnel = run(spark, tables, FIXTURE_CONFIG, out)
    assert sorted(written) == ALL and sorted(os.listdir(f"{out}/stages")) == sorted([*ALL, "_manifest"])
    assert run(spark, Warehouse.from_parquet(spark, warehouse), FIXTURE_CONFIG, out) == funnel
    assert sorted(written) == ALL                                          # the second run found them all
