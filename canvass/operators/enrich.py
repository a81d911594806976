"""One profile row per in-force policy term and pet."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from canvass.functions.rules import cancer_flag, term_number, wellcare_type

INSURED_COLUMNS = ["insured_fname", "insured_lname", "insured_address1", "insured_address2", "insured_city",
                   "insured_state", "insured_zipcode", "insured_hometel", "insured_bustel", "insured_email",
                   "policy_inforce_cnt", "portal_user_flag"]

PROFILE_COLUMNS = (["policyid", "policy_no", "policy_renew_no", "insured_code",
                    "pp_petname", "pp_pet_sex", "pp_date_of_birth"] + INSURED_COLUMNS +
                   ["effective_date", "breed_code", "breed_desc", "speciescode", "baseproduct",
                    "wellcare_type", "canceryn", "vrcc", "cancer", "source_desc", "origin_type", "origin_code",
                    "paymentplandesc", "provider_name", "group_id", "group_code"])


def enrich(snapshot: DataFrame, pets: DataFrame, header: DataFrame, insured: DataFrame, breed: DataFrame,
           written_premium: DataFrame, source: DataFrame, origin: DataFrame, paymentplan: DataFrame,
           provider: DataFrame, group: DataFrame) -> DataFrame:
    """The 35-column profile of every in-force term (INFORCE_QUARTERLY).

    Inner joins to pets, header, policyholder, breed, premium, source,
    origin and payment plan; outer joins to group and provider.  Large
    inputs join on their keys first (term keys, then the policyholder), the
    small dimensions last, so each dimension can be broadcast when its size
    check allows it.  The final ``distinct`` removes rows made equal by the
    projection.
    """
    s = snapshot.select("policyid", "policy_no", "policy_renew_no")
    h = header.select("policyid", "insured_code", "effective_date", "group_id", "breed_id", "source_id",
                      "origin_id", "paymentplan_id", "provider_id")
    wp = written_premium.select("policyid", "baseproduct", "vrcc", "cancer")
    p = pets.select(F.col("pp_policy_no").alias("policy_no"), term_number("pp_policy_renew_no").alias("policy_renew_no"),
                    "pp_petname", "pp_pet_sex", "pp_date_of_birth")
    em = insured.select("insured_code", *INSURED_COLUMNS)
    br = breed.select("breed_id", "breed_code", "breed_desc", "speciescode")
    src = source.select("source_id", "source_desc")
    org = origin.select("origin_id", "origin_type", "origin_code")
    pl = paymentplan.select("paymentplan_id", "paymentplandesc")
    pr = provider.select("provider_id", "provider_name")
    g = group.select("group_id", "group_code")

    joined = (s.join(h, "policyid")
              .join(wp, "policyid")
              .join(p, ["policy_no", "policy_renew_no"])
              .join(em, "insured_code")
              .join(br, "breed_id")
              .join(src, "source_id")
              .join(org, "origin_id")
              .join(pl, "paymentplan_id")
              .join(g, "group_id", "left")
              .join(pr, "provider_id", "left"))
    return (joined
            .withColumn("wellcare_type", wellcare_type("vrcc"))
            .withColumn("canceryn", cancer_flag("cancer"))
            .select(*PROFILE_COLUMNS)
            .distinct())
