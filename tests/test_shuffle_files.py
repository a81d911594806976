"""Shuffle files go when the rows they were made for are stored: a pull's stages do not add up on the disks."""

import os
import threading
import time

from pyspark.sql import functions as F

from canvass.config import FIXTURE_CONFIG, Config
from canvass.operators.positions import with_position
from canvass.plans.pull import SurveyPull
from canvass.plans.stages import StageStore
from canvass.session import CLEANUP_CONF, ensure_checkpoint_dir, shuffles_removed
from canvass.sources.fixtures import FixtureWarehouse
from tests.conftest import SF_SMALL
from tests.test_stages import folder


def shuffle_files(spark):
    blocks = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllBlocks()
    names = [blocks.apply(i).name() for i in range(blocks.size())]
    return {n for n in names if n.startswith("shuffle_")}


def left_by(spark, do):
    """The shuffle files that ``do`` leaves (the cleaning is asynchronous: half a minute is given)."""
    before = shuffle_files(spark)
    do()
    for _ in range(60):
        left = shuffle_files(spark) - before
        if not left:
            break
        time.sleep(0.5)
    return left


def shuffled(spark):
    return spark.range(5000).groupBy((F.col("id") % 100).alias("k")).agg(F.sum("id").alias("s")).join(
        spark.range(3000).select((F.col("id") % 70).alias("k")).hint("merge"), "k")


def test_a_stored_stage_leaves_no_shuffle_files(spark):
    store = StageStore(spark, folder(), "k")
    assert not left_by(spark, lambda: store.publish("a", shuffled(spark)))
    assert store.counts("a") == {"rows": store.read("a").count()} and store.read("a").count() > 0


def test_positions_leave_no_shuffle_files_of_their_input(spark):
    kept = []
    assert not left_by(spark, lambda: kept.append(with_position(shuffled(spark), [F.col("s")])))
    assert sorted(r.position for r in kept[0].collect()) == list(range(1, kept[0].count() + 1))


def test_tables_on_demand_and_claim_rollups_leave_no_shuffle_files(spark):
    pull = SurveyPull(spark, FixtureWarehouse(spark, SF_SMALL).on_demand(folder()), FIXTURE_CONFIG)
    pull.dim("dw_dim_coverage")
    assert not left_by(spark, lambda: pull.claim_rollups)
    plain = SurveyPull(spark, pull.t, Config(n_main=200, n_new=100, materialize="none")).claim_rollups
    assert pull.claim_rollups.exceptAll(plain).count() == 0 == plain.exceptAll(pull.claim_rollups).count() and plain.count() > 0
    at = ensure_checkpoint_dir(spark).removeprefix("file:")
    assert not [f for f in os.listdir(at) if "claim-sums" in f]           # stored for the time of the stage only


def test_overlapping_writes_put_the_setting_back(spark):
    before = spark.conf.get(CLEANUP_CONF, None)
    inside, leave = threading.Event(), threading.Event()

    def other():
        with shuffles_removed(spark):
            inside.set()
            leave.wait(30)

    with shuffles_removed(spark):
        thread = threading.Thread(target=other)
        thread.start()
        inside.wait(30)
    assert spark.conf.get(CLEANUP_CONF) == "true"                         # the other one still writes
    leave.set()
    thread.join()
    assert spark.conf.get(CLEANUP_CONF, None) == before


def test_the_profile_and_the_claim_rollups_are_not_built_together(spark, monkeypatch):
    pull = SurveyPull(spark, FixtureWarehouse(spark, SF_SMALL).on_demand(folder()), FIXTURE_CONFIG)
    at_work, together = set(), []
    publish = StageStore.publish

    def watched(self, name, *args, **more):
        at_work.add(name)
        together.append({"claim_rollups", "inforce_quarterly"} <= at_work)
        try:
            return publish(self, name, *args, **more)
        finally:
            at_work.discard(name)

    monkeypatch.setattr(StageStore, "publish", watched)
    pull.prepare()
    assert together and not any(together)
