"""Number of policies each policyholder referred."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from canvass.functions.rules import term_number


def referral_counts(vouchers: DataFrame, header: DataFrame) -> DataFrame:
    """Distinct referred policy numbers per referrer, redeemed vouchers only.

    A voucher counts when its referred term exists and belongs to someone
    else than the referrer (equi-join on the term with a ``<>`` residual).
    The distinct count is planned in two phases, so a referrer with very many
    vouchers is pre-combined per (referrer, policy) before the final shuffle.
    """
    vi = (vouchers.filter(F.col("vi_redeemed_yn") == "Y")
          .select("vi_insured", "vi_ref_policy_no", term_number("vi_ref_policy_renew_no").alias("vi_ref_policy_renew_no")))
    ph = header.select("policy_no", term_number("policy_renew_no").alias("policy_renew_no"), "insured_code")
    cond = ((vi.vi_ref_policy_no == ph.policy_no) & (vi.vi_ref_policy_renew_no == ph.policy_renew_no)
            & (vi.vi_insured != ph.insured_code))
    return (vi.join(ph, cond)
            .groupBy("vi_insured")
            .agg(F.countDistinct("vi_ref_policy_no").alias("policy_referred_count")))
