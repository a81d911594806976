"""The survey pull as a graph of memoised Spark stages.

Each stage is a lazily built DataFrame.  Stages read by several later stages
or reports (AH_INFORCE, the enriched profile, the claim rollups, the referral
counts, the household columns, the suppression list, the cancellations, F1,
F1A, F2, F2A, F3, F4, F4A) are materialised once per pull, like the source's
CREATE TABLE AS SELECT chain.

By default each materialised stage is written as a parquet table under the
session's ``spark.checkpoint.dir`` (the cluster's shared folder) and read
back.  The lineage is cut, so a lost executor costs no recomputation of
earlier stages; later plans stay small (a persisted 40-join lineage costs
seconds of re-planning per query); readers get column pruning and filter
pushdown on the stage.  ``persist`` and reliable ``checkpoint`` are the
alternatives; never a local checkpoint.

With ``run_dir`` the stages go to that folder and stay there: a pull that was
ended half-way is taken up by the next one with the same folder, parameters
and input files (:mod:`canvass.plans.stages`).
"""
from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from functools import cached_property, reduce

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from canvass.config import Config
from canvass.operators.claims import claim_rollups, medical_rollup, wellness_rollup
from canvass.operators.dedupe import contactable, first_policy_per_holder
from canvass.operators.enrich import enrich
from canvass.operators.household import MIN_POLICY, NPS_COLUMNS, ROLLUP_COLUMNS, household_profile, household_stats
from canvass.operators.joins import dimension
from canvass.operators.referrals import referral_counts
from canvass.operators.sampling import identity_hash, new_policy_pool, random_sample
from canvass.operators.snapshot import inforce_snapshot
from canvass.operators.suppression import eligible, future_cancellations, list_validation, suppression_list
from canvass.plans.cube import REPORTS as CUBE_REPORTS
from canvass.plans.cube import by_population, columns_of, report, report_cube
from canvass.plans.reports import POPULATIONS, REPORTS
from canvass.plans.stages import StageStore, input_digest, run_key
from canvass.session import configure, ensure_checkpoint_dir, shuffles_removed
from canvass.sources import files
from canvass.sources.warehouse import Warehouse

# Rows per file of a stage whose size the sample sizes bound.
SAMPLE_ROWS_PER_FILE = 50_000


class SurveyPull:
    """All stages of one pull over one warehouse and one :class:`Config`."""

    def __init__(self, spark: SparkSession, tables: Warehouse, config: Config = Config(), run_dir: str | None = None):
        self.spark = configure(spark)
        self.t = tables
        self.config = config
        self._dims: dict[str, DataFrame] = {}
        self._materialised: list[DataFrame] = []
        self._narrow: dict[bool, NarrowPull] = {}
        self._parts: dict[tuple[str, ...], tuple[DataFrame, DataFrame]] = {}
        self._run_dir = run_dir
        if run_dir is not None and config.materialize != "table":
            raise ValueError("a pull with run_dir stores its stages as tables")

    @cached_property
    def store(self) -> StageStore:
        """Where this pull's stages lie: in ``run_dir``, or in a folder of its own that nothing takes up."""
        if self._run_dir is None:
            run = uuid.uuid4().hex[:12]
            return StageStore(self.spark, f"{ensure_checkpoint_dir(self.spark).rstrip('/')}/canvass-{run}", run)
        inputs = input_digest(self.spark, self.t)
        return StageStore(self.spark, self._run_dir, run_key(self.config, inputs), {"config": str(self.config), "inputs": inputs})

    @property
    def build_sec(self) -> dict[str, float]:
        """Seconds each stored stage took to build (concurrent stages overlap)."""
        return {name: self.store.entry(name)["seconds"] for name in list(self.store.built)}

    # -- helpers -------------------------------------------------------------
    def dim(self, name: str) -> DataFrame:
        """A code table, hinted for broadcast when its size check passes."""
        if name not in self._dims:
            self._dims[name] = dimension(self.t[name], self.config.broadcast_max_bytes)
        return self._dims[name]

    def _materialise(self, build: Callable[[], DataFrame], name: str, max_rows: int | None = None,
                     counts: dict[str, Column] | None = None) -> DataFrame:
        """The stage ``name``, stored: ``build`` is called only if the store does not hold it.
        A stage known to hold at most ``max_rows`` goes to a few files instead of one per
        input split; ``counts`` are observed while it is written, besides its rows."""
        how = self.config.materialize
        if how == "table" and self.store.entry(name):
            return self.store.read(name)
        df = build()
        if max_rows is not None:
            df = df.repartition(1 + max_rows // SAMPLE_ROWS_PER_FILE)
        if how == "none":
            return df
        if how == "table":
            return self.store.publish(name, df, counts)
        if how == "checkpoint":
            ensure_checkpoint_dir(self.spark)
            out = df.checkpoint(eager=True)
        elif how == "persist":
            out = df.persist(StorageLevel.MEMORY_AND_DISK)
        else:
            raise ValueError(f"unknown materialize mode {how!r}")
        self._materialised.append(out)
        return out

    @contextmanager
    def _between(self, name: str) -> Iterator[Callable[[DataFrame], DataFrame]]:
        """What stores the rows inside a stage, where stages are stored: the shuffles before them are
        removed while the stage goes on, and they themselves when it is done."""
        path = f"{ensure_checkpoint_dir(self.spark).rstrip('/')}/canvass-{name}-{uuid.uuid4().hex[:12]}"

        def keep(df: DataFrame) -> DataFrame:
            with shuffles_removed(self.spark):
                df.write.option("compression", "zstd").parquet(path)
            return self.spark.read.schema(df.schema).parquet(path)

        try:
            yield keep if self.config.materialize == "table" else lambda df: df
        finally:
            if self.config.materialize == "table":
                files.delete(self.spark, path)

    def prepare(self) -> "SurveyPull":
        """Build every shared stage, independent ones as concurrent Spark jobs.

        The referral counts and the suppression list are built beside the
        enriched profile, and the household columns as soon as the first and
        the last are there; the reports' cube is built beside the second pool.
        The claim rollups, which do not depend on them, come after them: these
        two and the profile shuffle the most, and their files would lie on the
        disks at the same time.
        Idempotent.
        """
        from concurrent.futures import ThreadPoolExecutor

        def build(*stages: str, after=None) -> None:
            if after is not None:
                after.result()
            for stage in stages:
                getattr(self, stage)

        def finish(jobs: list) -> None:
            for job in jobs:
                job.result()

        with ThreadPoolExecutor(max_workers=4) as pool:
            referrals = pool.submit(build, "referrals")
            finish([referrals, pool.submit(build, "nps_scrubber"),
                    pool.submit(lambda: (build("inforce_quarterly"), build("households", after=referrals)))])
            build("claim_rollups", "nps_f1_full", "nps_f1a", "nps_f2", "nps_f2a", "nps_f3")
            finish([pool.submit(build, "report_cube"), pool.submit(build, "nps_f4", "nps_f4a")])
        return self

    def release(self) -> None:
        """Drop every stage of this pull: persisted ones from memory, stored ones with their folder."""
        for df in self._materialised:
            df.unpersist()
        self._materialised.clear()
        if "store" in self.__dict__:
            self.store.release()

    # -- population build (F1A) ------------------------------------------------
    def ah_inforce_plan(self) -> DataFrame:
        """The snapshot query itself (not the materialised copy)."""
        return inforce_snapshot(self.t["dw_policy_header"], self.t["dw_data_inforce"], self.config.report_date)

    @cached_property
    def ah_inforce(self) -> DataFrame:
        return self._materialise(self.ah_inforce_plan, "ah_inforce")

    @cached_property
    def inforce_quarterly(self) -> DataFrame:
        return self._materialise(self._inforce_quarterly, "inforce_quarterly")

    def _inforce_quarterly(self) -> DataFrame:
        return enrich(self.ah_inforce, self.t["policy_pets"], self.t["dw_policy_header"], self.t["dw_dim_insured"],
                      self.dim("dw_dim_breed"), self.t["dw_wp"], self.dim("dw_dim_source"), self.dim("dw_dim_origin"),
                      self.dim("dw_dim_paymentplan"), self.dim("dw_dim_provider"), self.dim("dw_dim_group"))

    @cached_property
    def claim_rollups(self) -> DataFrame:
        with self._between("claim-sums") as keep:
            return self._materialise(lambda: self.claim_rollups_plan(keep), "claim_rollups", counts={
                "well_rows": F.count(F.when(F.col("well_groups") > 0, 1)), "med_rows": F.count(F.when(F.col("medcount") > 0, 1))})

    def claim_rollups_plan(self, keep: Callable[[DataFrame], DataFrame] = lambda df: df) -> DataFrame:
        """The claim rollup query itself (not the materialised copy); ``keep`` may store the sums of the claims."""
        return claim_rollups(self.t["dw_policy_header"], self.t["dw_claim_header"], self.t["dw_claim_revision"],
                             self.t["dw_claim_diagnosis"], self.t["dw_claim_details"], self.dim("dw_dim_coverage"), keep)

    @property
    def inforce_well_dw(self) -> DataFrame:
        return wellness_rollup(self.claim_rollups)

    @property
    def inforce_med_dw(self) -> DataFrame:
        return medical_rollup(self.claim_rollups)

    @cached_property
    def households(self) -> DataFrame:
        """One narrow row per household, read by the salt decision and by F1."""
        return self._materialise(lambda: household_stats(self.inforce_quarterly, self.dim("dw_dim_group"), self.referrals),
                                 "households")

    @property
    def ah_inforce_nps(self) -> DataFrame:
        # Read from the materialised F1: the same rows without the referral count.
        return self.nps_f1_full.drop(MIN_POLICY, "policy_referred_count")

    @cached_property
    def referrals(self) -> DataFrame:
        return self._materialise(lambda: referral_counts(self.t["vouchers_issued"], self.t["dw_policy_header"]), "referrals")

    @cached_property
    def nps_f1_full(self) -> DataFrame:
        return self._materialise(lambda: household_profile(
            self.inforce_quarterly, self.claim_rollups, self.dim("dw_dim_zipcode"), self.dim("dw_dim_group"),
            stats=self.households, hot_key_rows=self.config.hot_key_rows), "nps_f1")

    @property
    def nps_f1(self) -> DataFrame:
        return self.nps_f1_full.drop(MIN_POLICY)

    @cached_property
    def nps_f1a(self) -> DataFrame:
        return self._materialise(lambda: first_policy_per_holder(self.nps_f1_full), "nps_f1a")

    # -- suppression and sampling ------------------------------------------------
    @cached_property
    def nps_scrubber(self) -> DataFrame:
        """The warehouse's ``nps_scrubber``, if it keeps one (``sources.lists.SuppressionStore``);
        else made of the three lists."""
        def build() -> DataFrame:
            if "nps_scrubber" in self.t:
                return self.t["nps_scrubber"].select("insured_code", "source")
            return suppression_list(self.t["nps_scrubber0"], self.t["nps_scrubber_policy"], self.t["nps_scrubber_dnc"],
                                    self.t["dw_policy_header"], self.t["dw_dim_insured"],
                                    max_broadcast_bytes=self.config.broadcast_max_bytes)

        # small, but resolving it scans the header and policyholder tables:
        # stored once instead of re-resolved by every reader
        return self._materialise(build, "nps_scrubber")

    @property
    def list_validation(self) -> DataFrame:
        return list_validation(self.nps_scrubber)

    @cached_property
    def cancellations(self) -> DataFrame:
        return self._materialise(lambda: future_cancellations(
            self.nps_f1a, self.t["dw_policy_term"], self.t["dw_cancel"], self.config.as_of), "cancellations")

    def nps_f2_plan(self, max_list_bytes: int | None = None) -> DataFrame:
        """The eligible population's query itself (not the materialised copy).
        ``max_list_bytes``: another bound for the exclusion sets that are broadcast whole."""
        return eligible(self.nps_f1a, self.nps_scrubber, self.t["bad_email"], self.t["dw_policy_pet"],
                        self.dim("dw_dim_policy_status"), self.cancellations, max_broadcast_bytes=self.config.broadcast_max_bytes,
                        max_list_bytes=max_list_bytes)

    @cached_property
    def nps_f2(self) -> DataFrame:
        return self._materialise(self.nps_f2_plan, "nps_f2")

    @cached_property
    def nps_f2a(self) -> DataFrame:
        return self._materialise(lambda: contactable(self.nps_f2), "nps_f2a")

    @cached_property
    def nps_f3(self) -> DataFrame:
        return self._materialise(lambda: random_sample(self.nps_f2a, self.config.n_main, self.config.seed), "nps_f3",
                                 max_rows=self.config.n_main)

    def nps_f4_plan(self) -> DataFrame:
        return new_policy_pool(self.nps_f2a, self.nps_f3, max_broadcast_bytes=self.config.broadcast_max_bytes)

    @cached_property
    def nps_f4(self) -> DataFrame:
        return self._materialise(self.nps_f4_plan, "nps_f4")

    @cached_property
    def nps_f4a(self) -> DataFrame:
        return self._materialise(lambda: random_sample(self.nps_f4, self.config.n_new, self.config.seed + 1), "nps_f4a",
                                 max_rows=self.config.n_new)

    # -- reports ---------------------------------------------------------------------
    @property
    def populations(self) -> dict[str, DataFrame]:
        """The stages a report can be run on, by name."""
        return {name: getattr(self, stage) for name, stage in POPULATIONS.items()}

    @cached_property
    def report_cube(self) -> DataFrame:
        return self._materialise(lambda: report_cube(self.populations), "report_cube")

    def _has(self, attribute: str, stage: str) -> bool:
        return attribute in self.__dict__ or self.config.materialize == "table" and self.store.entry(stage) is not None

    def _cube_of(self, name: str, populations: list[str]) -> tuple[DataFrame, DataFrame]:
        """A cube with a report over some populations, and a frame with the types of its columns.

        The cube of all reports, if the pull has it or the wide rows for it;
        else one of this report alone, over the populations reduced to the
        columns that its steps read (:class:`NarrowPull`)."""
        if self._has("report_cube", "report_cube") or self._has("nps_f1_full", "nps_f1"):
            return self.report_cube, self.nps_f1a
        claims = bool(set(CUBE_REPORTS[name].reads) & set(ROLLUP_COLUMNS))
        narrow = self._narrow.setdefault(claims, NarrowPull(self, claims))
        key = (name, *populations)
        if key not in self._parts:
            rows = {p: narrow.nps_f1a_plan() if populations == ["F1A"] else getattr(narrow, POPULATIONS[p]) for p in populations}
            self._parts[key] = self._materialise(lambda: report_cube(rows, {name: CUBE_REPORTS[name]}),
                                                 f"report_cube_{'_'.join(key)}"), next(iter(rows.values()))
        return self._parts[key]

    def report(self, name: str, population: str | None = None) -> DataFrame:
        """A report of :data:`canvass.plans.reports.REPORTS` over a population (None: the one the source names)."""
        population = population or REPORTS[name][1]
        cube, like = self._cube_of(name, [population])
        return report(cube, name, population, like)

    def report_by_population(self, name: str) -> DataFrame:
        cube, like = self._cube_of(name, list(POPULATIONS))
        return by_population(cube, name, list(POPULATIONS), like)

    # -- funnel ------------------------------------------------------------------
    def funnel(self) -> DataFrame:
        """Row count of every stage, one row per stage.

        Stored stages were counted while they were written, so only the two
        hand-loaded lists are counted here."""
        stages = [("ah_inforce", "ah_inforce", "rows"), ("inforce_quarterly", "inforce_quarterly", "rows"),
                  ("inforce_well_dw", "claim_rollups", "well_rows"), ("inforce_med_dw", "claim_rollups", "med_rows"),
                  ("nps_f1", "nps_f1", "rows"), ("nps_f1a", "nps_f1a", "rows"), ("nps_scrubber", "nps_scrubber", "rows"),
                  ("nps_f2", "nps_f2", "rows"), ("nps_f2a", "nps_f2a", "rows"), ("nps_f3", "nps_f3", "rows"),
                  ("nps_f4", "nps_f4", "rows"), ("nps_f4a", "nps_f4a", "rows")]
        counted = [(name, self.t[name]) for name in ("nps_scrubber_policy", "nps_scrubber_dnc")]
        self.prepare()
        if self.config.materialize == "table":
            known = [F.struct(F.lit(stage).alias("stage"), F.lit(self.store.counts(table)[column]).cast("long").alias("row_count"))
                     for stage, table, column in stages]
            parts = [self.spark.range(1).select(F.inline(F.array(*known)))]
        else:
            parts, counted = [], counted + [(stage, getattr(self, stage)) for stage, _, _ in stages]
        parts += [df.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(name).alias("stage"), "row_count")
                  for name, df in counted]
        return reduce(DataFrame.unionByName, parts)


#: What the stages after F1A read of a row, besides the reports' columns: its identity, and what it is excluded by.
STEP_COLUMNS = {"policyid", "policy_no", "policy_renew_no", "insured_code", "insured_email", "origin_code",
                "pp_petname", "pp_pet_sex", "pp_date_of_birth"}


class NarrowPull(SurveyPull):
    """The populations of another pull, the same rows with the columns that reports and later steps read.

    Every step is the one of :class:`SurveyPull`; the snapshot, the profile, the
    households and the lists are the stages of the other pull.  F1 is not stored, and
    without ``claims`` the claim columns are left out, and so the rollups they are from.
    """

    def __init__(self, whole: SurveyPull, claims: bool):
        super().__init__(whole.spark, whole.t, whole.config)
        self.whole, self.claims = whole, claims
        self._dims, self._materialised = whole._dims, whole._materialised
        wanted = STEP_COLUMNS | {c for c in columns_of(CUBE_REPORTS) if claims or c not in ROLLUP_COLUMNS}
        self.columns = [c for c in NPS_COLUMNS if c in wanted]

    @property
    def store(self) -> StageStore:
        return self.whole.store

    def _materialise(self, build: Callable[[], DataFrame], name: str, max_rows: int | None = None,
                     counts: dict[str, Column] | None = None) -> DataFrame:
        return super()._materialise(build, f"{name}_{'claims' if self.claims else 'narrow'}", max_rows, counts)

    @property
    def inforce_quarterly(self) -> DataFrame:
        return self.whole.inforce_quarterly

    @property
    def households(self) -> DataFrame:
        return self.whole.households

    @property
    def nps_scrubber(self) -> DataFrame:
        return self.whole.nps_scrubber

    def nps_f1a_plan(self) -> DataFrame:
        f1 = household_profile(self.inforce_quarterly, self.whole.claim_rollups if self.claims else None, self.dim("dw_dim_zipcode"),
                               self.dim("dw_dim_group"), stats=self.households, hot_key_rows=self.config.hot_key_rows)
        return first_policy_per_holder(f1).select(*self.columns)

    @cached_property
    def nps_f1a(self) -> DataFrame:
        return self._materialise(self.nps_f1a_plan, "nps_f1a")

    @cached_property
    def nps_f3(self) -> DataFrame:
        """The rows of the whole pull's F3.

        Rows of one identity are drawn in the order of all their columns.  Where the last
        ones drawn leave some of their identity out, and they differ, the whole rows decide."""
        drawn = super().nps_f3
        named = lambda df: df.withColumn("_id", identity_hash("policyid", ("pp_petname", "pp_pet_sex", "pp_date_of_birth"), self.config.seed))
        last = named(drawn).agg(F.max("_id")).first()[0]
        if last is not None:
            tied = named(self.nps_f2a).filter(F.col("_id") == last)
            if tied.count() > named(drawn).filter(F.col("_id") == last).count() and tied.distinct().limit(2).count() > 1:
                return self.whole.nps_f3.select(*self.columns)
        return drawn
