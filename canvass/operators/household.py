"""Claim rollups, income and household profile on every profile row.

The source computes six household columns with window functions partitioned
by policyholder.  A window needs every row of a household in one task, so a
single very large household (a shared or placeholder policyholder code)
would sit in one task.  Here the household columns come from one
``groupBy`` with partial aggregation, joined back on the policyholder code:
the same values, and a hot household is pre-combined on every map task and
salted on the way back (see :mod:`canvass.operators.skew`).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from canvass.functions.rules import SPECIES_AVIAN, SPECIES_CAT, SPECIES_DOG, SPECIES_EXOTIC
from canvass.operators.claims import AMOUNTS, MONEY
from canvass.operators.enrich import PROFILE_COLUMNS
from canvass.operators.skew import join_per_key

ROLLUP_COLUMNS = ["medicalclaimcount", "welcareclaimcount", "medicalclaimamount", "medicalpaidamount",
                  "medicaleligibleamount", "welcareclaimamount", "welcarepaidamount", "welcareeligibleamount"]
HOUSEHOLD_COLUMNS = ["min_term", "max_term", "dogs", "cats", "avian", "exoticothers"]
NPS_COLUMNS = PROFILE_COLUMNS + ROLLUP_COLUMNS + ["incomeperhousehold", "total_pets", "group_name"] + HOUSEHOLD_COLUMNS
# Kept on the stage so the first-policy filter (D7) needs no second pass.
MIN_POLICY = "_min_policy_no"


def _zero(c: str, typ: str) -> F.Column:
    return F.coalesce(F.col(c), F.lit(0).cast(typ))


def household_stats(profile: DataFrame, group: DataFrame, referrals: DataFrame | None = None) -> DataFrame:
    """The household columns, one narrow row per policyholder.

    ``total_pets`` counts profile rows with a policy number.  Min and max
    term, the first policy number and the species counts follow; the counts
    weigh each row by the number of group rows that its group code matches.
    With ``referrals`` (D6's ``vi_insured, policy_referred_count``) the
    referral count rides along.  ``_rows`` is the household's profile rows.
    """
    group_mult = group.groupBy("group_code").agg(F.count(F.lit(1)).alias("_mult"))
    species = F.col("speciescode")
    mult = F.coalesce(F.col("_mult"), F.lit(1))

    def weighted(cond) -> F.Column:
        return F.sum(F.when(cond, mult).otherwise(F.lit(0))).cast("bigint")

    stats = (profile.select("insured_code", "policy_no", "policy_renew_no", "speciescode", "group_code")
             .join(group_mult, "group_code", "left")
             .groupBy("insured_code")
             .agg(F.count("policy_no").alias("total_pets"),
                  F.min("policy_renew_no").alias("min_term"),
                  F.max("policy_renew_no").alias("max_term"),
                  weighted(species == SPECIES_DOG).alias("dogs"),
                  weighted(species == SPECIES_CAT).alias("cats"),
                  weighted(species == SPECIES_AVIAN).alias("avian"),
                  weighted(species.isin(*SPECIES_EXOTIC)).alias("exoticothers"),
                  F.min("policy_no").alias(MIN_POLICY),
                  F.count(F.lit(1)).alias("_rows")))
    if referrals is not None:
        r = referrals.select(F.col("vi_insured").alias("insured_code"), "policy_referred_count")
        stats = stats.join(r, "insured_code", "left")
    return stats


def _with_claims(profile: DataFrame, rollups: DataFrame | None) -> DataFrame:
    if rollups is None:
        return profile
    r = rollups.select(
        "policy_no",
        F.col("medcount").alias("medicalclaimcount"), F.col("vrcccount").alias("welcareclaimcount"),
        *[F.col(f"med_{a}").alias(n) for a, n in zip(AMOUNTS, ["medicalclaimamount", "medicalpaidamount",
                                                                  "medicaleligibleamount"])],
        *[F.col(f"well_{a}").alias(n) for a, n in zip(AMOUNTS, ["welcareclaimamount", "welcarepaidamount",
                                                                   "welcareeligibleamount"])])
    return profile.join(r, "policy_no", "left")


def household_profile(profile: DataFrame, rollups: DataFrame | None, zipcode: DataFrame, group: DataFrame,
                      stats: DataFrame | None = None, hot_key_rows: int = 1_000_000) -> DataFrame:
    """AH_INFORCE_NPS plus the hidden column ``_min_policy_no``.

    ``rollups`` None: the same rows without the claim columns (the rollups have
    one row a policy number, so their left join neither adds nor drops a row).

    ``stats`` is :func:`household_stats` of the same profile and groups, best
    a stored copy, as the salted join reads it more than once (default: built
    here).  With the referral count in it the result is NPS_F1: the count is
    per policyholder and comes with the narrow row, without a second join of
    the wide ones.

    * claim counts and amounts by ``policy_no``, zero when there are none;
    * income of the 5-digit zip code (``substr(trim(zip), 1, 5)``);
    * ``total_pets``: profile rows of the household with a policy number;
    * group name by ``group_code``;
    * per household: min and max term, and dogs, cats, avian, exotic counts.

    The group join may repeat a row when a group code is not unique, and the
    source's household counts are taken after it.  To keep that exactly, the
    counts weigh each row by the number of group rows it matches.

    The household columns are joined back with :func:`join_per_key`: a
    household with more than ``hot_key_rows`` rows is split over several
    tasks instead of one.
    """
    # The medical and wellness rollups are separate left joins in the source;
    # a class a policy has no claims of is zero-filled, as is a NULL sum.
    z = zipcode.select(F.col("zipcode").alias("_zip5"), "incomeperhousehold")
    t = (_with_claims(profile, rollups)
         .withColumn("_zip5", F.substring(F.trim(F.col("insured_zipcode")), 1, 5))
         .join(z, "_zip5", "left"))
    t = t.select(
        *PROFILE_COLUMNS,
        *([_zero(c, "bigint").alias(c) for c in ROLLUP_COLUMNS[:2]] if rollups is not None else []),
        *([_zero(c, MONEY).alias(c) for c in ROLLUP_COLUMNS[2:]] if rollups is not None else []),
        "incomeperhousehold",
    )

    if stats is None:
        stats = household_stats(profile, group)
    extra = ["policy_referred_count"] if "policy_referred_count" in stats.columns else []
    g = group.select("group_code", "group_name")
    joined = join_per_key(t, stats, "insured_code", rows_per_key="_rows", hot_rows=hot_key_rows,
                          salt_by=PROFILE_COLUMNS)
    return (joined.join(g, "group_code", "left")
            .select(*[c for c in NPS_COLUMNS if rollups is not None or c not in ROLLUP_COLUMNS], *extra, MIN_POLICY))
