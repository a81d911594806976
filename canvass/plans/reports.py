"""Validation reports: each compares a population stage with its sample.

Every report is ``report(population)`` (the source edits the table name by
hand); the defaults in :mod:`canvass.plans.registry` are the stages the
source names.  Reports aggregate with partial (map-side) aggregation, so a
population of any size is reduced to a few rows per task before shuffling.
Reports come back in the source's order (NULLs last, as in its engine).
Where the rows are bounded by a fixed label domain (19 bands, 8 mixes x 5
term groups, 19 term rows, 8 pet counts) the order is a single-partition
sort of the aggregated rows: no range-partitioning pass, and the
aggregation before it keeps its full parallelism.  Reports keyed by a
data value (state, product) use a distributed ``orderBy``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from canvass.functions.rules import (
    TERM_OVERFLOW,
    amount_band,
    multipet_group,
    pets_topcoded,
    product_group,
    species_mix,
    term_group,
)
from canvass.operators.joins import dimension


def _n(alias: str):
    return F.count(F.lit(1)).alias(alias)


def ordered(df: DataFrame, *cols: str, bounded: bool = True) -> DataFrame:
    """Sort a report.  ``bounded``: its rows are bounded by a fixed label
    domain, so one task sorts them; otherwise a distributed ``orderBy``."""
    keys = [F.col(c).asc_nulls_last() for c in cols]
    return df.coalesce(1).sortWithinPartitions(*keys) if bounded else df.orderBy(*keys)


def species_by_stage(f1a: DataFrame, f2a: DataFrame, f3: DataFrame) -> DataFrame:
    """Pets per species in three stages; inner joins, so a NULL species drops."""
    a = f1a.groupBy("speciescode").agg(_n("tot_pet_f1"))
    b = f2a.groupBy("speciescode").agg(_n("tot_pet_f2"))
    c = f3.groupBy("speciescode").agg(_n("tot_pet_f3"))
    return (a.join(b, "speciescode").join(c, "speciescode")
            .select("speciescode", "tot_pet_f1", "tot_pet_f2", "tot_pet_f3"))


def _term_counts(stage: DataFrame, alias: str) -> DataFrame:
    term = F.col("policy_renew_no")
    below = stage.filter(term < TERM_OVERFLOW).groupBy(term.cast("int").alias("policy_renew_no")).agg(_n(alias))
    # A global aggregate: the overflow row exists even when no term reaches it.
    over = stage.filter(term >= TERM_OVERFLOW).agg(_n(alias)).select(
        F.lit(TERM_OVERFLOW).cast("int").alias("policy_renew_no"), alias)
    return below.union(over).distinct()


def term_by_stage(f1a: DataFrame, f2a: DataFrame, f3: DataFrame) -> DataFrame:
    """R2: rows per term number (18 and above on one row) in three stages.

    As in the source, the third stage is joined on the *second* stage's key,
    so a term missing from the second stage shows no third-stage count.
    """
    a = _term_counts(f1a, "tot_pet_1")
    b = _term_counts(f2a, "tot_pet_2").withColumnRenamed("policy_renew_no", "_b_term")
    c = _term_counts(f3, "tot_pet_3").withColumnRenamed("policy_renew_no", "_c_term")
    return ordered(a.join(b, a.policy_renew_no == b._b_term, "left")
                   .join(c, F.col("_b_term") == F.col("_c_term"), "left")
                   .select("policy_renew_no", "tot_pet_1", "tot_pet_2", "tot_pet_3"), "policy_renew_no")


def multipet_households(population: DataFrame) -> DataFrame:
    """Distinct policyholders by pet count, 7 for everything outside 1 to 6."""
    return (population.groupBy(multipet_group("total_pets").alias("multipet"))
            .agg(F.countDistinct("insured_code").alias("tot_ph")))


def species_mix_report(population: DataFrame) -> DataFrame:
    """Multi-pet rows by household species mix."""
    return ordered(population.filter(F.col("total_pets") > 1)
                   .groupBy(species_mix().alias("multi_pet")).agg(_n("ph")), "multi_pet")


def mix_by_term(population: DataFrame, term_col: str) -> DataFrame:
    """Multi-pet rows by species mix and min- or max-term group."""
    return ordered(population.filter(F.col("total_pets") > 1)
                   .groupBy(species_mix().alias("multi_pet"), term_group(term_col).alias("term_group")).agg(_n("ph")),
                   "multi_pet", "term_group")


def product_report(population: DataFrame) -> DataFrame:
    """Rows per product, the I250 family on one row."""
    return ordered(population.groupBy(product_group("baseproduct").alias("baseproduct")).agg(_n("tot_pet")),
                   "baseproduct", bounded=False)


def state_report(population: DataFrame) -> DataFrame:
    """Rows per state."""
    return ordered(population.groupBy("insured_state").agg(_n("tot_rows")), "insured_state", bounded=False)


def top_states_paid_in_full(population: DataFrame, header: DataFrame, paymentplan: DataFrame,
                            payment_type: DataFrame, k: int = 10, max_broadcast_bytes: int | None = None) -> DataFrame:
    """The ``k`` states with most paid-in-full rows (ties by state name).

    The payment type is found through the policy header, as in the source.
    With ``max_broadcast_bytes``, a population that passes that size check (a
    sample has at most n rows) is broadcast, so the header is scanned, not
    shuffled.  The top-k is a per-partition bounded heap plus one small merge.
    """
    plan = paymentplan.select("paymentplan_id", F.col("paymentplantypeid").alias("paymentplantype_id"))
    pif = payment_type.filter(F.col("paymentplantype") == "PIF").select("paymentplantype_id")
    pop = population.select("policyid", "insured_state")
    if max_broadcast_bytes is not None:
        pop = dimension(pop, max_broadcast_bytes)
    # each small side joins the rows directly, so each broadcast hint applies
    rows = (header.select("policyid", "paymentplan_id").join(pop, "policyid")
            .join(plan, "paymentplan_id")
            .join(pif, "paymentplantype_id"))
    return (rows.groupBy("insured_state").agg(_n("pif_count"))
            .orderBy(F.col("pif_count").desc(), F.col("insured_state").asc_nulls_last()).limit(k))


def amount_band_report(population: DataFrame, amount_col: str, label: str, count_col: str,
                       strictly_positive: bool = False) -> DataFrame:
    """Distinct policies per amount band.

    The source filters ``count >= 0`` (always true once counts are
    zero-filled) except for wellness paid, which uses ``> 0``.
    """
    cnt = F.col(count_col)
    keep = cnt > 0 if strictly_positive else cnt >= 0
    return ordered(population.filter(keep).groupBy(amount_band(amount_col).alias(label))
                   .agg(F.countDistinct("policy_no").alias("policy_count")), label)


def pets_topcoded_report(population: DataFrame) -> DataFrame:
    """Rows per household pet count, 7 and above on one row, NULL kept."""
    return ordered(population.groupBy(pets_topcoded("total_pets").alias("total_pets")).agg(_n("ph_count")),
                   "total_pets")


#: Reports over one population: name -> (report, the population the source names).
REPORTS = {
    "multipet_households": (multipet_households, "F3"),
    "species_mix": (species_mix_report, "F3"),
    "mix_min_term": (lambda pop: mix_by_term(pop, "min_term"), "F1A"),
    "mix_max_term": (lambda pop: mix_by_term(pop, "max_term"), "F3"),
    "product": (product_report, "F3"),
    "state": (state_report, "F3"),
    "band_med_submitted": (lambda pop: amount_band_report(
        pop, "medicalclaimamount", "submitted_group", "medicalclaimcount"), "F1A"),
    "band_med_eligible": (lambda pop: amount_band_report(
        pop, "medicaleligibleamount", "eligible_group", "medicalclaimcount"), "F1A"),
    "band_med_paid": (lambda pop: amount_band_report(
        pop, "medicalpaidamount", "reimbursement_grp", "medicalclaimcount"), "F3"),
    "band_well_submitted": (lambda pop: amount_band_report(
        pop, "welcareclaimamount", "well_submitted_group", "welcareclaimcount"), "F3"),
    "band_well_eligible": (lambda pop: amount_band_report(
        pop, "welcareeligibleamount", "well_eligible_group", "welcareclaimcount"), "F3"),
    "band_well_paid": (lambda pop: amount_band_report(
        pop, "welcarepaidamount", "well_reimbursement_grp", "welcareclaimcount", strictly_positive=True), "F1A"),
    "pets_topcoded": (pets_topcoded_report, "F1A"),
}
#: The stages a report can be run on.
POPULATIONS = {"F1A": "nps_f1a", "F2": "nps_f2", "F2A": "nps_f2a", "F3": "nps_f3"}
