"""Keep one policy per policyholder, then one per e-mail."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from canvass.functions.rules import email_shape_ok
from canvass.operators.household import MIN_POLICY


def first_policy_per_holder(f1: DataFrame) -> DataFrame:
    """NPS_F1A: rows of each policyholder's smallest policy number.

    Ties are kept: all terms and pets of that policy number stay.  The
    minimum was computed with the household aggregate (D5), so this is a
    filter with no shuffle.  A NULL policyholder never matches, as in the
    source's join.
    """
    keep = F.col("insured_code").isNotNull() & (F.col("policy_no") == F.col(MIN_POLICY))
    return f1.filter(keep).drop(MIN_POLICY)


def contactable(f2: DataFrame, strict_email: bool = False) -> DataFrame:
    """NPS_F2A: one policy number per lower-cased e-mail, e-mail shape checked.

    The minimum policy number is taken per lower-cased e-mail (NULL e-mails
    form one group) *before* the shape test, and rows are joined back on the
    policy number alone: a policy that is the minimum of two e-mail groups
    appears twice, as in the source.  The group-by is partially aggregated,
    so one very common e-mail does not land in one task.
    """
    mins = f2.groupBy(F.lower(F.col("insured_email")).alias("_email")).agg(F.min("policy_no").alias("policy_no"))
    return (f2.join(mins.select("policy_no"), "policy_no")
            .filter(email_shape_ok(F.col("insured_email"), strict=strict_email))
            .select(*f2.columns))
