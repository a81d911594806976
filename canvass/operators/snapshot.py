"""Policy terms in force at the report date."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from canvass.functions.rules import term_number

SNAPSHOT_COLUMNS = ["policyid", "policy_no", "policy_renew_no", "insured_code", "zipcode_id"]


def inforce_snapshot(header: DataFrame, inforce: DataFrame, report_date: dt.date) -> DataFrame:
    """Distinct policy terms with at least one in-force row for ``report_date``.

    The source groups the header-inforce join by all header columns, which
    only keeps one row per term; a semi join followed by ``distinct`` is the
    same result without carrying the in-force fact's fan-out through a join.
    The date predicate is pushed into the in-force scan, and the fact's
    repeated rows per term are collapsed map-side (``distinct`` before the
    shuffle, whose hash partitioning the semi join then reuses).

    The term number is cast to ``int`` here: a warehouse that stores it as
    text would otherwise order '10' before '2' in the household min/max.
    """
    period = inforce.filter(F.col("reportperiod") == F.lit(report_date)).select("policyid").distinct()
    h = header.withColumn("policy_renew_no", term_number("policy_renew_no"))
    return h.join(period, "policyid", "left_semi").select(*SNAPSHOT_COLUMNS).distinct()
