"""Operators on literal micro-fixtures, one per hazard of FIXTURES.md section 4."""

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from canvass.operators.claims import claim_rollups, medical_rollup, wellness_rollup
from canvass.operators.dedupe import contactable, first_policy_per_holder
from canvass.operators.enrich import PROFILE_COLUMNS
from canvass.operators.household import MIN_POLICY, household_profile
from canvass.operators.referrals import referral_counts
from canvass.operators.sampling import new_policy_pool, random_sample
from canvass.operators.snapshot import inforce_snapshot
from canvass.operators.suppression import eligible, future_cancellations, suppression_list
from canvass.plans.reports import term_by_stage
from tests.conftest import rows

PROFILE_TYPES = {
    "policyid": "bigint", "policy_renew_no": "int", "pp_date_of_birth": "date", "policy_inforce_cnt": "int",
    "effective_date": "date", "vrcc": "int", "cancer": "int", "group_id": "bigint",
}
ROLLUP_SCHEMA = ("policy_no string, well_groups bigint, vrcccount bigint, well_claimedamount decimal(18,2), "
                 "well_paidamount decimal(18,2), well_eligibleamount decimal(18,2), medcount bigint, "
                 "med_claimedamount decimal(18,2), med_paidamount decimal(18,2), med_eligibleamount decimal(18,2)")


def first_policy_by_join(f1, nps):
    """The first policies of any F1, by aggregate and join."""
    mins = nps.groupBy("insured_code").agg(F.min("policy_no").alias(MIN_POLICY)).filter(F.col("insured_code").isNotNull())
    return f1.join(mins, "insured_code").filter(F.col("policy_no") == F.col(MIN_POLICY)).drop(MIN_POLICY)


def with_referrals(nps, referrals):
    """The household profile with its referral count (NULL when none)."""
    return nps.join(referrals.select(F.col("vi_insured").alias("insured_code"), "policy_referred_count"), "insured_code", "left")


def profile(spark, records):
    schema = ", ".join(f"{c} {PROFILE_TYPES.get(c, 'string')}" for c in PROFILE_COLUMNS)
    data = [tuple(r.get(c) for c in PROFILE_COLUMNS) for r in records]
    return spark.createDataFrame(data, schema)


def no_rollups(spark):
    return spark.createDataFrame([], ROLLUP_SCHEMA)


def groups(spark, data=(("G1", "Group one"),)):
    return spark.createDataFrame([(i, c, n) for i, (c, n) in enumerate(data)], "group_id bigint, group_code string, group_name string")


def zips(spark, data=(("92801", 50000),)):
    return spark.createDataFrame(list(data), "zipcode string, incomeperhousehold int")


# -- D1 ----------------------------------------------------------------------
def test_snapshot_distinct_terms_at_date(spark):
    header = spark.createDataFrame([(1, "P1", 0, "C1", 5), (2, "P1", 1, "C1", 5), (3, "P2", 0, "C2", 6)],
                                   "policyid bigint, policy_no string, policy_renew_no int, insured_code string, zipcode_id int")
    inforce = spark.createDataFrame([(1, dt.date(2013, 2, 28)), (1, dt.date(2013, 2, 28)), (2, dt.date(2013, 1, 31)),
                                     (3, dt.date(2013, 2, 28))], "policyid bigint, reportperiod date")
    got = rows(inforce_snapshot(header, inforce, dt.date(2013, 2, 28)), "policyid")
    assert got == [(1,), (3,)]


# -- D3 / D4 -------------------------------------------------------------------
def _claims(spark):
    header = spark.createDataFrame([(1, "P1"), (2, "P1"), (3, "P3")], "policyid bigint, policy_no string")
    claim_header = spark.createDataFrame(
        [(1, 10, None), (1, 11, "CL11"), (2, 12, "CL12"), (3, 13, "CL13"), (3, 14, "CL14")],
        "policyid bigint, claim_id bigint, claim_no string")
    revision = spark.createDataFrame(
        [(10, 1, "Complete"), (11, 1, "Complete"), (11, 2, "Reopened"), (12, 1, None), (13, 1, "Complete"),
         (14, 1, "Complete")], "claim_id bigint, claim_revision_no int, claim_revision_status string")
    # coverage 1 Wellcare, 2 Base, 3 NULL type
    diagnosis = spark.createDataFrame(
        [(10, 1, 1001, 1), (10, 1, 1002, 2), (11, 1, 1101, 1), (11, 2, 1102, 1), (12, 1, 1201, 1),
         (13, 1, 1301, 3), (14, 1, 1401, 2)],
        "claim_id bigint, claim_revision_no int, claim_diagnosis_id bigint, claim_coverage_id int")
    d = Decimal
    details = spark.createDataFrame(
        [(1001, d("10.00"), d("8.00"), d("5.00")), (1001, d("1.00"), d("1.00"), d("1.00")),
         (1002, d("20.00"), d("10.00"), d("7.00")), (1101, d("30.00"), d("30.00"), d("30.00")),
         (1102, d("99.00"), d("99.00"), d("99.00")), (1201, d("5.00"), d("5.00"), d("5.00")),
         (1301, d("7.00"), d("7.00"), d("7.00")), (1401, d("40.00"), d("20.00"), d("10.00"))],
        "claim_diagnosis_id bigint, claimedamount decimal(12,2), eligibleamount decimal(12,2), paidamount decimal(12,2)")
    coverage = spark.createDataFrame([(1, "Wellcare"), (2, "Base"), (3, None)], "coverage_id int, coverage_product_type string")
    return claim_rollups(header, claim_header, revision, diagnosis, details, coverage)


def test_claim_rollups_counts_and_filters(spark):
    r = _claims(spark)
    well = {x[0]: x[1:] for x in rows(wellness_rollup(r), "policy_no", "vrcccount", "claimamount", "paidamount")}
    med = {x[0]: x[1:] for x in rows(medical_rollup(r), "policy_no", "medcount", "claimamount", "paidamount")}
    # P1 wellness: claim 10 (NULL claim_no: a group, not counted) + claim 11 revision 1 only (2 is reopened);
    # claim 12's revision has a NULL status and is dropped.
    assert well == {"P1": (1, Decimal("41.00"), Decimal("36.00"))}
    # P1 medical: claim 10's Base diagnosis in the NULL claim_no group, counted by count(*);
    # Claim 14 Base; claim 13's NULL coverage type is neither class.
    assert med == {"P1": (1, Decimal("20.00"), Decimal("7.00")), "P3": (1, Decimal("40.00"), Decimal("10.00"))}


# -- D5 ------------------------------------------------------------------------------
def test_household_counts_terms_zip_and_group_fanout(spark):
    base = {"insured_code": "H1", "policy_no": "P1", "insured_zipcode": "  92801-1234", "group_code": "G1"}
    species = ["C", "C", "F", "A", "E", "R", None]
    recs = [dict(base, policyid=i, policy_renew_no=t, speciescode=s)
            for i, (s, t) in enumerate(zip(species, [2, 10, 3, 4, 5, 6, 7]))]
    out = household_profile(profile(spark, recs), no_rollups(spark), zips(spark), groups(spark))
    got = rows(out, "dogs", "cats", "avian", "exoticothers", "total_pets", "min_term", "max_term",
               "incomeperhousehold", "medicalclaimcount", "welcareclaimamount")
    assert set(got) == {(2, 1, 1, 2, 7, 2, 10, 50000, 0, Decimal("0.00"))}
    assert len(got) == 7


def test_household_duplicate_group_code_fans_out(spark):
    recs = [{"policyid": 1, "policy_no": "P1", "insured_code": "H1", "speciescode": "C", "group_code": "G1",
             "policy_renew_no": 0}]
    g = groups(spark, [("G1", "first"), ("G1", "second")])
    got = rows(household_profile(profile(spark, recs), no_rollups(spark), zips(spark), g),
               "group_name", "dogs", "total_pets")
    assert got == [("first", 2, 1), ("second", 2, 1)]


def test_household_rollups_zero_filled(spark):
    recs = [{"policyid": 1, "policy_no": "P1", "insured_code": "H1", "policy_renew_no": 0},
            {"policyid": 2, "policy_no": "P2", "insured_code": "H2", "policy_renew_no": 0}]
    r = spark.createDataFrame([("P1", 1, 0, Decimal("5.00"), None, None, 0, None, None, None)], ROLLUP_SCHEMA)
    got = rows(household_profile(profile(spark, recs), r, zips(spark), groups(spark)),
               "policy_no", "welcareclaimcount", "welcareclaimamount", "welcarepaidamount", "medicalclaimcount")
    assert got == [("P1", 0, Decimal("5.00"), Decimal("0.00"), 0), ("P2", 0, Decimal("0.00"), Decimal("0.00"), 0)]


# -- D6 ------------------------------------------------------------------------------
def test_referrals(spark):
    header = spark.createDataFrame([("P1", 0, "H1"), ("P2", 0, "H2"), ("P3", 0, "H3")],
                                   "policy_no string, policy_renew_no int, insured_code string")
    vouchers = spark.createDataFrame(
        [("H1", "P1", 0, "Y"),   # own policy
         ("H1", "P2", 0, "Y"), ("H1", "P2", 0, "Y"),   # someone else's, twice
         ("H1", "P3", 0, "N")],  # not redeemed
        "vi_insured string, vi_ref_policy_no string, vi_ref_policy_renew_no int, vi_redeemed_yn string")
    r = referral_counts(vouchers, header)
    assert rows(r) == [("H1", 1)]
    nps = spark.createDataFrame([("H1",), ("H2",)], "insured_code string")
    assert rows(with_referrals(nps, r), "insured_code", "policy_referred_count") == [("H1", 1), ("H2", None)]


# -- D7 ------------------------------------------------------------------------------
def test_first_policy_keeps_ties_and_drops_null_holder(spark):
    recs = [{"policyid": 1, "policy_no": "P1", "insured_code": "H1", "policy_renew_no": 0},
            {"policyid": 2, "policy_no": "P1", "insured_code": "H1", "policy_renew_no": 1},
            {"policyid": 3, "policy_no": "P2", "insured_code": "H1", "policy_renew_no": 0},
            {"policyid": 4, "policy_no": "P9", "insured_code": None, "policy_renew_no": 0}]
    nps = household_profile(profile(spark, recs), no_rollups(spark), zips(spark), groups(spark))
    got = rows(first_policy_per_holder(nps), "policyid")
    assert got == [(1,), (2,)]
    assert rows(first_policy_by_join(nps.drop(MIN_POLICY), nps), "policyid") == got


# -- D8 / D10 ------------------------------------------------------------------------------
def _f1a(spark, recs):
    return spark.createDataFrame(recs, "insured_code string, policy_no string, policy_renew_no int, "
                                       "insured_email string, origin_code string")


def _status(spark, pets=(("P1", 1), ("P2", 1), ("P3", 1), ("P4", 1), ("P5", 1), ("P6", 1))):
    pet = spark.createDataFrame(list(pets), "policy_no string, policy_status_dwid int")
    st = spark.createDataFrame([(1, "Inforce"), (2, "Inforce (Undernotice)"), (3, "Cancelled")],
                               "policy_status_dwid int, policy_status_desc string")
    return pet, st


def _no_cancel(spark):
    return spark.createDataFrame([], "insured_code string")


def test_eligible_suppression_trim_and_origin_codes(spark):
    f1a = _f1a(spark, [("C1", "P1", 0, "a@x", "GD9999"), ("C2", "P2", 0, "b@x", "GD9999"),
                       ("C3", "P3", 0, "c@x", "GD0082"), ("C4", "P4", 0, "d@x", None),
                       ("C5", "P5", 0, "BAD@x", "GD9999"), ("C6", "P6", 0, None, "GD9999")])
    scrub = spark.createDataFrame([("C1 ", "A1"), ("C1", "H")], "insured_code string, source string")
    bad = spark.createDataFrame([("bad@X",), (None,)], "bad_email string")
    pet, st = _status(spark)
    got = rows(eligible(f1a, scrub, bad, pet, st, _no_cancel(spark)), "insured_code")
    assert got == [("C2",), ("C6",)]


def test_eligible_status_fanout_is_inner_join(spark):
    f1a = _f1a(spark, [("C1", "P1", 0, "a@x", "GD9999")])
    pet, st = _status(spark, [("P1", 1), ("P1", 2), ("P1", 3)])
    empty = spark.createDataFrame([], "insured_code string, source string")
    got = eligible(f1a, empty, spark.createDataFrame([], "bad_email string"), pet, st, _no_cancel(spark))
    assert got.count() == 2


def test_future_cancellations(spark):
    f1a = _f1a(spark, [("C1", "P1", 0, None, "X"), ("C2", "P2", 0, None, "X"), ("C3", "P3", 0, None, "X")])
    term = spark.createDataFrame([(1, "P1", 0), (2, "P2", 0), (3, "P3", 0)],
                                 "policy_term_dwid bigint, policy_no string, policy_renew_no int")
    as_of = dt.date(2013, 3, 1)
    cancel = spark.createDataFrame([(1, dt.date(2013, 2, 28)), (2, as_of), (3, dt.date(2013, 6, 30))],
                                   "policy_term_dwid bigint, effective_date date")
    canc = future_cancellations(f1a, term, cancel, as_of)
    assert rows(canc) == [("C2",), ("C3",)]
    pet, st = _status(spark)
    empty = spark.createDataFrame([], "insured_code string, source string")
    got = eligible(f1a, empty, spark.createDataFrame([], "bad_email string"), pet, st, canc)
    assert rows(got, "insured_code") == [("C1",)]


def test_suppression_list_appends(spark):
    base = spark.createDataFrame([("C9 ", "A1")], "insured_code string, source string")
    by_policy = spark.createDataFrame([(" P1 ", "G1"), ("P1", "G1")], "policy_no string, source string")
    by_email = spark.createDataFrame([("A@X.COM", "H"), ("nobody@x", "H")], "email string, source string")
    header = spark.createDataFrame([("P1", "C1"), ("P1", "C1")], "policy_no string, insured_code string")
    insured = spark.createDataFrame([("C2", "a@x.com"), ("C3", "A@x.com")], "insured_code string, insured_email string")
    got = rows(suppression_list(base, by_policy, by_email, header, insured))
    assert got == [("C1", "G1"), ("C2", "H"), ("C3", "H"), ("C9 ", "A1")]


# -- D11 ------------------------------------------------------------------------------
def test_contactable_dedupes_by_lowercase_email(spark):
    f2 = _f1a(spark, [("C1", "P2", 0, "A@x.com", "X"), ("C2", "P1", 0, "a@X.com", "X"),
                      ("C3", "P3", 0, "ab", "X"), ("C4", "P4", 0, None, "X")])
    assert rows(contactable(f2), "policy_no") == [("P1",)]


def test_contactable_policy_minimum_of_two_groups_repeats(spark):
    # P1 is the minimum of both e-mail groups: its rows come back once per group
    f2 = _f1a(spark, [("C1", "P1", 0, "a@x.com", "X"), ("C1", "P1", 0, "b@x.com", "X"),
                      ("C2", "P2", 0, "b@x.com", "X")])
    assert rows(contactable(f2), "policy_no", "insured_email") == [
        ("P1", "a@x.com"), ("P1", "a@x.com"), ("P1", "b@x.com"), ("P1", "b@x.com")]


# -- D12 to D14 ------------------------------------------------------------------------------
def _population(spark, n):
    return spark.range(n).select(F.col("id").alias("policyid"), (F.col("id") % 7).cast("string").alias("pp_petname"))


def _row_hash(pop, seed):
    names = [c for c in ("policyid", "pp_petname", "pp_pet_sex", "pp_date_of_birth") if c in pop.columns]
    return F.md5(F.concat_ws("|", *[F.col(c).cast("string") for c in names], F.lit(str(seed))))


def test_sample_exact_size_and_deterministic(spark):
    pop = _population(spark, 5000)
    a = rows(random_sample(pop, 300, 42), "policyid")
    b = rows(random_sample(pop.repartition(13), 300, 42), "policyid")
    assert len(a) == 300 and a == b
    expected = rows(pop.orderBy(_row_hash(pop, 42)).limit(300), "policyid")
    assert a == expected
    assert rows(random_sample(pop, 300, 7), "policyid") != a


def test_sample_refines_large_buckets(spark):
    pop = _population(spark, 20000)
    expected = rows(pop.orderBy(_row_hash(pop, 5)).limit(777), "policyid")
    assert rows(random_sample(pop, 777, 5, rank_limit=3), "policyid") == expected


def test_sample_larger_than_population(spark):
    pop = _population(spark, 50)
    assert random_sample(pop, 80_000, 42).count() == 50
    assert random_sample(pop, 0, 42).count() == 0


def test_new_policy_pool_minus_is_distinct_and_null_safe(spark):
    schema = "policyid bigint, total_pets bigint, policy_renew_no int, baseproduct string, note string"
    f2a = spark.createDataFrame([(1, 1, 0, "M1", None), (1, 1, 0, "M1", None), (2, 1, 1, "FS", "x"),
                                 (2, 1, 1, "FS", "x"), (3, 1, 0, "X1", None), (4, 2, 0, "M1", None),
                                 (5, 1, 2, "M1", None)], schema)
    f3 = spark.createDataFrame([(1, 1, 0, "M1", None)], schema)
    assert rows(new_policy_pool(f2a, f3), "policyid") == [(2,)]


# -- R2 ------------------------------------------------------------------------------
def test_term_overflow_row_always_present(spark):
    stage = spark.createDataFrame([(3,), (17,), (17,)], "policy_renew_no int")
    got = rows(term_by_stage(stage, stage, stage))
    assert got == [(3, 1, 1, 1), (17, 2, 2, 2), (18, 0, 0, 0)]


def test_term_report_chains_on_second_stage(spark):
    a = spark.createDataFrame([(3,), (5,)], "policy_renew_no int")
    b = spark.createDataFrame([(3,)], "policy_renew_no int")
    got = rows(term_by_stage(a, b, a))
    assert got == [(3, 1, 1, 1), (5, 1, None, None), (18, 0, 0, 0)]


@pytest.mark.parametrize("n", [1, 2])
def test_snapshot_semi_join_keeps_header_bag(spark, n):
    header = spark.createDataFrame([(1, "P1", 0, "C1", 5)] * n,
                                   "policyid bigint, policy_no string, policy_renew_no int, insured_code string, zipcode_id int")
    inforce = spark.createDataFrame([(1, dt.date(2013, 2, 28))] * 3, "policyid bigint, reportperiod date")
    assert inforce_snapshot(header, inforce, dt.date(2013, 2, 28)).count() == 1


def test_snapshot_casts_text_term_numbers(spark):
    header = spark.createDataFrame([(1, "P1", "10", "C1", 5), (2, "P1", "2", "C1", 5)],
                                   "policyid bigint, policy_no string, policy_renew_no string, insured_code string, zipcode_id int")
    inforce = spark.createDataFrame([(1, dt.date(2013, 2, 28)), (2, dt.date(2013, 2, 28))], "policyid bigint, reportperiod date")
    out = inforce_snapshot(header, inforce, dt.date(2013, 2, 28))
    assert dict(out.dtypes)["policy_renew_no"] == "int"
    assert out.agg(F.min("policy_renew_no")).first()[0] == 2


def test_sample_splits_a_key_holding_a_third_of_the_rows(spark):
    # one policy holds a third of the population: the second hash keeps it splittable
    pop = spark.range(6000).select(
        F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.col("id")).alias("policyid"),
        F.col("id").cast("string").alias("pp_petname"))
    h2 = F.md5(F.concat_ws("|", F.col("policyid").cast("string"), F.col("pp_petname"), F.lit("42")))
    for n in (100, 1500, 2500):
        expected = rows(pop.orderBy(h2).limit(n), "policyid", "pp_petname")
        got = rows(random_sample(pop, n, 42, rank_limit=50), "policyid", "pp_petname")
        assert got == expected


def test_sample_draws_rows_not_whole_policies(spark):
    pop = spark.range(10_000).select((F.col("id") / 10).cast("long").alias("policyid"), F.col("id").cast("string").alias("pp_petname"))
    assert random_sample(pop, 100, 42).select("policyid").distinct().count() > 85


def test_household_codes_keep_every_digit(spark):
    from canvass.sources.fixtures import _code, _hh_of_code
    n = [5, 1234567, 12345678, 123456789, 12345678901]
    got = spark.createDataFrame([(x,) for x in n], "n long").select(_code("C", F.col("n")).alias("c")).select("c", _hh_of_code(F.col("c")).alias("n"))
    assert sorted(r.n for r in got.collect()) == n and got.select("c").distinct().count() == len(n)


def test_sample_with_null_keys(spark):
    pop = spark.range(300).select(F.when(F.col("id") % 10 == 0, F.lit(None)).otherwise(F.col("id")).alias("policyid"),
                                  F.col("id").cast("string").alias("pp_petname"))
    h2 = F.md5(F.concat_ws("|", F.col("policyid").cast("string"), F.col("pp_petname"), F.lit("42")))
    expected = rows(pop.orderBy(h2).limit(120), "policyid", "pp_petname")
    assert rows(random_sample(pop, 120, 42, rank_limit=5), "policyid", "pp_petname") == expected


def test_sample_many_copies_of_one_identity(spark):
    # a third of the rows are copies of one identity, differing only in another column
    pop = spark.range(3000).select(
        F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.col("id")).alias("policyid"),
        F.when(F.col("id") % 3 == 0, F.lit("same")).otherwise(F.col("id").cast("string")).alias("pp_petname"),
        (F.col("id") % 17).alias("v"))
    h2 = F.md5(F.concat_ws("|", F.col("policyid").cast("string"), F.col("pp_petname"), F.lit("42")))
    key = h2
    copies = pop.filter(F.col("policyid") == 7).select(key.alias("k")).first()["k"]
    before = pop.filter(key < F.lit(copies)).count()
    for n in (50, before + 500):        # the second cut falls inside the copies
        expected = rows(pop.orderBy(h2, "policyid", "pp_petname", "v").limit(n), "policyid", "pp_petname", "v")
        got = rows(random_sample(pop, n, 42, rank_limit=40), "policyid", "pp_petname", "v")
        assert got == expected


def test_text_term_numbers_meet_ints_and_dirty_ones_meet_nothing(spark):
    from canvass.operators.referrals import referral_counts
    from canvass.operators.suppression import future_cancellations
    vouchers = spark.createDataFrame([("C1", "P1", "01", "Y"), ("C1", "P2", "x", "Y")],
                                     "vi_insured string, vi_ref_policy_no string, vi_ref_policy_renew_no string, vi_redeemed_yn string")
    header = spark.createDataFrame([("P1", 1, "C2"), ("P2", 2, "C2")], "policy_no string, policy_renew_no int, insured_code string")
    assert rows(referral_counts(vouchers, header)) == [("C1", 1)]
    f1a = spark.createDataFrame([("C2", "P1", 1)], "insured_code string, policy_no string, policy_renew_no int")
    terms = spark.createDataFrame([(7, "P1", " 1"), (8, "P1", "?")], "policy_term_dwid bigint, policy_no string, policy_renew_no string")
    cancel = spark.createDataFrame([(7, dt.date(2013, 4, 1)), (8, dt.date(2013, 4, 1))], "policy_term_dwid bigint, effective_date date")
    assert rows(future_cancellations(f1a, terms, cancel, dt.date(2013, 3, 1))) == [("C2",)]
