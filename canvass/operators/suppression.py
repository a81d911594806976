"""The do-not-survey list and the eligible population."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from canvass.functions.rules import INFORCE_STATUSES, STAFF_ORIGIN_CODES, term_number
from canvass.operators.exclusion import exclude
from canvass.operators.joins import dimension


def base_list(base: DataFrame) -> DataFrame:
    """The imported list as loaded (codes may be padded)."""
    return base.select("insured_code", "source")


def holders_of_policies(by_policy: DataFrame, header: DataFrame, max_broadcast_bytes: int | None = None) -> DataFrame:
    """Policy numbers (padded) mapped to their holders via the header, distinct."""
    listed = by_policy.select(F.trim(F.col("policy_no")).alias("policy_no"), "source")
    return (header.select("policy_no", "insured_code").join(_small(listed, max_broadcast_bytes), "policy_no")
            .select("insured_code", "source").distinct())


def holders_of_emails(by_email: DataFrame, insured: DataFrame, max_broadcast_bytes: int | None = None) -> DataFrame:
    """E-mails matched case-insensitively to policyholders, not distinct (one row per match)."""
    listed = by_email.select(F.lower(F.col("email")).alias("_email"), "source")
    return (insured.select(F.lower(F.col("insured_email")).alias("_email"), "insured_code")
            .join(_small(listed, max_broadcast_bytes), "_email").select("insured_code", "source"))


def _small(df: DataFrame, max_broadcast_bytes: int | None) -> DataFrame:
    return dimension(df, max_broadcast_bytes) if max_broadcast_bytes is not None else df


def suppression_list(base: DataFrame, by_policy: DataFrame, by_email: DataFrame,
                     header: DataFrame, insured: DataFrame, max_broadcast_bytes: int | None = None) -> DataFrame:
    """NPS_SCRUBBER after both appends: ``(insured_code, source)``.

    The lists are hand-loaded and usually small: with ``max_broadcast_bytes``
    a list that passes the size check is broadcast, so the header and the
    policyholder table are scanned once instead of shuffled.
    """
    return (base_list(base).unionByName(holders_of_policies(by_policy, header, max_broadcast_bytes))
            .unionByName(holders_of_emails(by_email, insured, max_broadcast_bytes)))


def list_validation(scrubber: DataFrame) -> DataFrame:
    """Rows per source of the suppression list, by source."""
    return (scrubber.groupBy("source").agg(F.count(F.lit(1)).alias("row_count"))
            .orderBy(F.col("source").asc_nulls_last()))


def future_cancellations(f1a: DataFrame, policy_term: DataFrame, cancel: DataFrame, as_of: dt.date) -> DataFrame:
    """Policyholders with a term of F1A cancelling on or after ``as_of``.

    Joined from the selective side: the future cancellations first find
    their terms, and only those terms meet F1A.
    """
    c = cancel.filter(F.col("effective_date") >= F.lit(as_of)).select("policy_term_dwid")
    pt = policy_term.select("policy_term_dwid", "policy_no", term_number("policy_renew_no").alias("policy_renew_no"))
    return (c.join(pt, "policy_term_dwid")
            .join(f1a.select("insured_code", "policy_no", "policy_renew_no"), ["policy_no", "policy_renew_no"])
            .select("insured_code"))


def eligible(f1a: DataFrame, scrubber: DataFrame, bad_email: DataFrame, policy_pet: DataFrame,
             policy_status: DataFrame, cancellations: DataFrame, max_broadcast_bytes: int | None = None,
             max_list_bytes: int | None = None) -> DataFrame:
    """NPS_F2: F1A without suppressed, bad-e-mail, staff and cancelling holders.

    The source writes its three exclusions as ``LEFT JOIN ... WHERE key IS
    NULL``; Catalyst keeps that form as an outer join plus a filter, so they
    are written as anti joins here.  Keys are normalised on both sides first
    (trimmed codes, upper-cased e-mails).  A NULL e-mail matches nothing and
    stays.  The status join is an inner join on the policy number: a policy
    with two kept status rows appears twice.  NULL origin codes fail
    ``NOT IN`` and drop, as in SQL.

    The suppressed and the cancelling policyholders are one exclusion set,
    so a single anti join on the policyholder code removes both.  With
    ``max_broadcast_bytes``, an exclusion set of at most that size (stored
    tables, so known without a job) is broadcast; of a larger one a filter
    within that size is, and only rows that it lets through are shuffled
    (:mod:`canvass.operators.exclusion`).
    """
    # No distinct on the exclusion sets: duplicates do not change an anti
    # join, and a plain shuffle on each side lets AQE split a skewed key
    # (e.g. the NULL e-mails, which never match but hash to one partition).
    excluded = (scrubber.select(F.trim(F.col("insured_code")).alias("insured_code"))
                .unionByName(cancellations.select("insured_code")))
    bad = bad_email.select(F.upper(F.col("bad_email")).alias("_email"))
    status = (policy_pet.select("policy_no", "policy_status_dwid")
              .join(policy_status.filter(F.col("policy_status_desc").isin(*INFORCE_STATUSES))
                    .select("policy_status_dwid"), "policy_status_dwid")
              .select("policy_no"))
    cols = f1a.columns
    named = f1a.filter(~F.col("origin_code").isin(*STAFF_ORIGIN_CODES)).withColumn("_email", F.upper(F.col("insured_email")))
    kept = exclude(named, {"insured_code": excluded, "_email": bad}, max_broadcast_bytes, max_list_bytes)
    return kept.join(status, "policy_no").select(*cols)
