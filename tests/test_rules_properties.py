"""Property tests: the Column rules against plain-Python models of the CASE chains."""

from decimal import Decimal

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from canvass.functions.rules import AMOUNT_BAND_EDGES, AMOUNT_BAND_LABELS, amount_band, species_mix, term_group

SETTINGS = settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])


def band_model(x):
    if x is None:
        return None
    if 0 <= x <= 100:
        return AMOUNT_BAND_LABELS[0]
    for lo, hi, label in zip(AMOUNT_BAND_EDGES[1:-1], AMOUNT_BAND_EDGES[2:], AMOUNT_BAND_LABELS[1:-1]):
        if lo < x <= hi:
            return label
    return AMOUNT_BAND_LABELS[-1] if x > 5000 else None


def term_model(t):
    if t is None:
        return None
    if t == 0:
        return "0"
    if 1 <= t <= 3:
        return "1 to 3"
    if 4 <= t <= 5:
        return "4 to 5"
    return "5 Higher" if t > 5 else None


def mix_model(d, c, a, e):
    # SQL: a comparison with NULL is not a match, and CASE falls through to the next arm
    def ge1(v): return v is not None and v >= 1
    def eq0(v): return v is not None and v == 0
    other = ge1(e) or ge1(a)
    if eq0(e) and ge1(c) and eq0(d) and eq0(a):
        return "A_AllFeline"
    if eq0(e) and eq0(c) and ge1(d) and eq0(a):
        return "B_AllCanine"
    if eq0(c) and eq0(d) and other:
        return "C_AllAvianExotic"
    if eq0(e) and ge1(c) and ge1(d) and eq0(a):
        return "D_CanineFelineMix"
    if ge1(d) and eq0(c) and other:
        return "E_CanineOthersMix"
    if ge1(c) and eq0(d) and other:
        return "F_FelineOthersMix"
    if ge1(d) and ge1(c) and other:
        return "G_CanineFelineorOthersMix"
    return "Unknown"


cents = st.one_of(st.none(), st.integers(min_value=-10_000, max_value=900_000).map(lambda c: Decimal(c).scaleb(-2)),
                  st.sampled_from([Decimal(e) for e in AMOUNT_BAND_EDGES]))


@SETTINGS
@given(st.lists(cents, min_size=1, max_size=40))
def test_amount_band_matches_model(spark, values):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, x decimal(18,2)")
    got = [r["b"] for r in df.select("i", amount_band("x").alias("b")).orderBy("i").collect()]
    assert got == [band_model(v) for v in values]


@SETTINGS
@given(st.lists(st.one_of(st.none(), st.integers(min_value=-3, max_value=30)), min_size=1, max_size=40))
def test_term_group_matches_model(spark, values):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, t int")
    got = [r["g"] for r in df.select("i", term_group("t").alias("g")).orderBy("i").collect()]
    assert got == [term_model(v) for v in values]


count = st.one_of(st.none(), st.integers(min_value=0, max_value=3))


@SETTINGS
@given(st.lists(st.tuples(count, count, count, count), min_size=1, max_size=40))
def test_species_mix_matches_model(spark, values):
    df = spark.createDataFrame([(i, *v) for i, v in enumerate(values)],
                               "i int, dogs bigint, cats bigint, avian bigint, exoticothers bigint")
    got = [r["m"] for r in df.select("i", species_mix().alias("m")).orderBy("i").collect()]
    assert got == [mix_model(*v) for v in values]


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.integers(min_value=0, max_value=400), st.integers(min_value=1, max_value=12),
       st.integers(min_value=2, max_value=30), st.integers(min_value=0, max_value=450),
       st.integers(min_value=1, max_value=99))
def test_random_sample_matches_brute_force(spark, rows, keys, names, n, seed):
    from canvass.operators.sampling import random_sample
    # duplicate keys and duplicate identities on purpose
    pop = spark.range(rows).select((F.col("id") % keys).alias("policyid"),
                                   (F.col("id") % names).cast("string").alias("pp_petname"),
                                   F.col("id").alias("v"))
    h2 = F.md5(F.concat_ws("|", F.col("policyid").cast("string"), F.col("pp_petname"), F.lit(str(seed))))
    want = sorted(tuple(r) for r in pop.orderBy(h2, "policyid", "pp_petname", "v").limit(n).collect())
    got = sorted(tuple(r) for r in random_sample(pop, n, seed, rank_limit=7).collect())
    assert got == want


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.integers(min_value=1, max_value=3000), st.integers(min_value=1, max_value=40),
       st.integers(min_value=1, max_value=600))
def test_skew_operators_equal_plain_forms(spark, n, keys, hot_rows):
    import tempfile

    from pyspark.sql import Window

    from canvass.operators.skew import join_per_key, row_number_per_key
    # key 0 takes about half of the rows
    df = spark.range(n).select(F.when(F.col("id") % 2 == 0, F.lit(0)).otherwise(F.col("id") % keys).alias("k"),
                               F.col("id"))
    per_key = df.groupBy("k").agg(F.count(F.lit(1)).alias("n"), F.min("id").alias("first"))
    salted = join_per_key(df, per_key, "k", rows_per_key="n", hot_rows=hot_rows, salt_by=["id"])
    assert sorted(salted.collect()) == sorted(df.join(per_key, "k", "left").select(*salted.columns).collect())
    ranked = row_number_per_key(df, ["k"], ["id"], "rn", hot_rows=hot_rows, partitions=5,
                                scratch=tempfile.mkdtemp(prefix="rank-", dir="/tmp") + "/r")
    want = df.withColumn("rn", F.row_number().over(Window.partitionBy("k").orderBy("id")))
    assert sorted(ranked.collect()) == sorted(want.select(*ranked.columns).collect())
