"""Lifetime claim rollups per policy number, wellness and medical.

The source runs the same six-table claim join twice, once per coverage
class.  Here one pass tags each diagnosis as wellness or medical and both
rollups come out of it.  Diagnoses of unknown coverage and of reopened
revisions drop out before the details are joined; amounts are then summed
per claim, so every later shuffle carries one row per claim rather than one
per detail line.  Every aggregate is partial (map-side), so a policy with a
huge number of claims is pre-combined before it is shuffled.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType

from canvass.functions.rules import REOPENED_STATUS, WELLNESS_COVERAGE

MONEY = "decimal(18,2)"
AMOUNTS = ["claimedamount", "paidamount", "eligibleamount"]


def claim_rollups(header: DataFrame, claim_header: DataFrame, revision: DataFrame, diagnosis: DataFrame,
                  details: DataFrame, coverage: DataFrame, keep: Callable[[DataFrame], DataFrame] = lambda df: df) -> DataFrame:
    """One row per ``policy_no`` with claims of either class.

    Columns: ``policy_no``, ``well_groups`` (number of wellness claim groups),
    ``vrcccount`` (their non-NULL claim numbers), three wellness sums,
    ``medcount`` (medical claim groups) and three medical sums.  A class with
    no claim groups has count 0 and NULL sums.

    Rules kept from the source: reopened revisions are dropped, and so are
    revisions with a NULL status and diagnoses with a NULL coverage type
    (``<>`` and ``=`` both reject NULL); claims are grouped by
    ``(policy_no, claim_no)`` over all terms of the policy number.

    Claim tables that carry the policy's id in every row, the details the
    claim's id too (:func:`canvass.sources.layout.cluster_claims`), are joined
    by these as well: stored in buckets by policy, they need no shuffle up to
    the grouping by policy number.

    ``keep`` is given the sums of the claims and returns the copy that the
    grouping by policy reads: a stored one lets the shuffles before it go.
    """
    # By what the tables are joined besides their own keys: nothing, or the policy (and claim).
    placed = all("policyid" in t.columns for t in (revision, diagnosis, details)) and "claim_id" in details.columns
    policy = ["policyid"] if placed else []
    claim = [*policy, "claim_id"]
    detail = [*claim, "claim_diagnosis_id"] if placed else ["claim_diagnosis_id"]
    # Sum money as exact integers in the amount's minor unit (cents for
    # scale 2): long arithmetic stays on Spark's fast path, while decimal
    # sums widen past 18 digits at every level and fall back to BigDecimal.
    # Values are converted back to decimal(18,2) once, at the end.
    scale = _money_scale(details)
    cov = (coverage.filter(F.col("coverage_product_type").isNotNull())
           .select(F.col("coverage_id").alias("claim_coverage_id"),
                   (F.col("coverage_product_type") == WELLNESS_COVERAGE).alias("is_well")))
    live = (revision.filter(F.col("claim_revision_status") != REOPENED_STATUS)
            .select(*claim, "claim_revision_no"))
    kept = (diagnosis.select(*claim, "claim_revision_no", "claim_diagnosis_id", "claim_coverage_id")
            .join(cov, "claim_coverage_id")
            .join(live, [*claim, "claim_revision_no"])
            .select("claim_diagnosis_id", *claim, "is_well"))
    lines = details.select(*detail, *[_to_minor(F.col(a), scale).alias(a) for a in AMOUNTS]).join(kept, detail)

    def split(a: str) -> list:
        return [F.sum(F.when(F.col("is_well"), F.col(a))).alias(f"w_{a}"),
                F.sum(F.when(~F.col("is_well"), F.col(a))).alias(f"m_{a}")]

    per_claim = lines.groupBy(*claim).agg(
        F.max(F.col("is_well").cast("int")).alias("has_well"),
        F.max((~F.col("is_well")).cast("int")).alias("has_med"),
        *[c for a in AMOUNTS for c in split(a)])
    with_no = per_claim.join(claim_header.select("claim_id", "policyid", "claim_no"), claim)
    with_no = keep(with_no.select("policyid", "claim_no", *[c for c in per_claim.columns if c not in claim]))
    with_policy = with_no.join(header.select("policyid", "policy_no"), "policyid")

    sums = [F.sum(f"{p}_{a}").alias(f"{p}_{a}") for p in ("w", "m") for a in AMOUNTS]
    per_group = with_policy.groupBy("policy_no", "claim_no").agg(
        F.max("has_well").alias("has_well"), F.max("has_med").alias("has_med"), *sums)

    well = F.col("has_well") == 1
    med = F.col("has_med") == 1
    out = per_group.groupBy("policy_no").agg(
        F.count(F.when(well, F.lit(1))).alias("well_groups"),
        F.count(F.when(well, F.col("claim_no"))).alias("vrcccount"),
        *[_from_minor(F.sum(F.when(well, F.col(f"w_{a}"))), scale).alias(f"well_{a}") for a in AMOUNTS],
        F.count(F.when(med, F.lit(1))).alias("medcount"),
        *[_from_minor(F.sum(F.when(med, F.col(f"m_{a}"))), scale).alias(f"med_{a}") for a in AMOUNTS],
    )
    return out


def _money_scale(details: DataFrame) -> int:
    """Decimal scale shared by the amount columns (2 for currency)."""
    scales = {details.schema[a].dataType.scale for a in AMOUNTS if isinstance(details.schema[a].dataType, DecimalType)}
    if len(scales) != 1 or len([a for a in AMOUNTS if isinstance(details.schema[a].dataType, DecimalType)]) != 3:
        raise TypeError("claim amounts must be decimals of one scale")
    scale = scales.pop()
    if scale > 2:  # the rollups carry two decimals; a finer amount would be rounded
        raise TypeError(f"claim amounts of scale {scale}: the rollups hold two decimals")
    return scale


def _to_minor(amount: Column, scale: int) -> Column:
    """An amount as an exact integer count of its minor unit."""
    factor = 10 ** scale
    # a narrow decimal literal keeps the product within 18 digits (long-backed)
    return (amount * F.lit(factor).cast(f"decimal({len(str(factor))},0)")).cast("bigint")


def _from_minor(units: Column, scale: int) -> Column:
    """An integer count of minor units back to ``MONEY`` (exact)."""
    return (units.cast("decimal(20,0)") / F.lit(10 ** scale).cast("decimal(20,0)")).cast(MONEY)


def wellness_rollup(rollups: DataFrame) -> DataFrame:
    """INFORCE_WELL_DW: policies with wellness claims."""
    return rollups.filter(F.col("well_groups") > 0).select(
        "policy_no", "vrcccount", F.col("well_claimedamount").alias("claimamount"),
        F.col("well_paidamount").alias("paidamount"), F.col("well_eligibleamount").alias("eligibleamount"))


def medical_rollup(rollups: DataFrame) -> DataFrame:
    """INFORCE_MED_DW: policies with medical (base and cancer) claims."""
    return rollups.filter(F.col("medcount") > 0).select(
        "policy_no", "medcount", F.col("med_claimedamount").alias("claimamount"),
        F.col("med_paidamount").alias("paidamount"), F.col("med_eligibleamount").alias("eligibleamount"))
