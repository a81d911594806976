"""A hot key holding a third of the rows: results stay exact, AQE splits the join."""

import pytest
from pyspark.sql import functions as F

from canvass.operators.dedupe import contactable
from canvass.operators.enrich import PROFILE_COLUMNS
from canvass.operators.household import household_profile
from tests.test_operators import PROFILE_TYPES, ROLLUP_SCHEMA

N = 30_000


@pytest.fixture()
def skew_conf(spark):
    conf = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16k",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
    }
    old = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    yield
    for k, v in old.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def _skewed_profile(spark):
    i = F.col("id")
    hot = i % 3 == 0          # a third of all rows belong to household H0
    cols = {
        "policyid": i,
        "policy_no": F.concat(F.lit("P"), F.lpad((i % 5000).cast("string"), 6, "0")),
        "policy_renew_no": (i % 7).cast("int"),
        "insured_code": F.when(hot, F.lit("H0")).otherwise(F.concat(F.lit("H"), (i % 2000 + 1).cast("string"))),
        "speciescode": F.element_at(F.array(*[F.lit(s) for s in ["C", "F", "A", "E", "R"]]), (i % 5 + 1).cast("int")),
        "insured_email": F.when(hot, F.lit(None)).otherwise(F.concat(F.lit("u"), (i % 2000).cast("string"), F.lit("@x.com"))),
    }
    return spark.range(N).select(*[
        (cols[c] if c in cols else F.lit(None)).cast(PROFILE_TYPES.get(c, "string")).alias(c) for c in PROFILE_COLUMNS])


def test_hot_household_profile_exact_and_split(spark, skew_conf):
    prof = _skewed_profile(spark)
    rollups = spark.createDataFrame([], ROLLUP_SCHEMA)
    zips = spark.createDataFrame([], "zipcode string, incomeperhousehold int")
    groups = spark.createDataFrame([], "group_id bigint, group_code string, group_name string")
    out = household_profile(prof, rollups, zips, groups, hot_key_rows=1000).select(
        "insured_code", "total_pets", "dogs", "cats", "min_term", "max_term")
    result = out.collect()            # runs the query; its AQE plan is final afterwards
    assert len(result) == N
    got = {tuple(r)[1:] for r in result if r["insured_code"] == "H0"}
    hot = prof.filter(F.col("insured_code") == "H0")
    expect = hot.agg(F.count("*"), F.sum((F.col("speciescode") == "C").cast("int")),
                     F.sum((F.col("speciescode") == "F").cast("int")), F.min("policy_renew_no"), F.max("policy_renew_no")).first()
    assert got == {tuple(expect)}
    final = out._jdf.queryExecution().executedPlan().toString()
    assert "_salt" in final          # the hot household was split by salt
    assert "Window" not in final


def test_salted_join_spreads_the_hot_key(spark):
    from canvass.operators.skew import join_per_key
    rows = spark.range(9000).select(F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(
        (F.col("id") % 100).cast("string")).alias("k"), F.col("id"))
    per_key = rows.groupBy("k").agg(F.count(F.lit(1)).alias("n"), F.max("id").alias("mx"))
    salted = join_per_key(rows, per_key, "k", rows_per_key="n", hot_rows=500, salt_by=["id"])
    plain = rows.join(per_key, "k", "left")
    assert sorted(salted.collect()) == sorted(plain.select(*salted.columns).collect())
    # the hot key's rows now spread over several salts
    spread = (rows.filter(F.col("k") == "hot").select(F.pmod(F.xxhash64("id"), F.lit(6)).alias("s"))
              .distinct().count())
    assert spread == 6


def test_null_email_group_is_preaggregated(spark, skew_conf):
    f2 = _skewed_profile(spark).select("insured_code", "policy_no", "insured_email")
    out = contactable(f2)
    mins = f2.groupBy(F.lower("insured_email").alias("e")).agg(F.min("policy_no").alias("policy_no"))
    expect = f2.join(mins.select("policy_no"), "policy_no").filter(
        F.col("insured_email").contains("@") | F.col("insured_email").contains("."))
    assert out.count() == expect.count()
    assert "partial_min" in out._jdf.queryExecution().executedPlan().toString()


def test_row_number_per_key_with_a_hot_key(spark):
    import tempfile

    from pyspark.sql import Window

    from canvass.operators.skew import row_number_per_key
    df = spark.range(12_000).select(
        F.when(F.col("id") % 3 == 0, F.lit(-1)).otherwise(F.col("id") % 50).alias("k"),
        (F.col("id") * 7919 % 12_000).alias("o"), F.col("id"))
    want = df.withColumn("rn", F.row_number().over(Window.partitionBy("k").orderBy("o", "id")))
    got = row_number_per_key(df, ["k"], ["o", "id"], "rn", hot_rows=500, partitions=7,
                             scratch=tempfile.mkdtemp(prefix="rank-", dir="/tmp") + "/r")
    assert sorted(got.collect()) == sorted(want.select(*got.columns).collect())
    plain = row_number_per_key(df, ["k"], ["o", "id"], "rn", hot_rows=1_000_000)
    assert sorted(plain.collect()) == sorted(want.select(*plain.columns).collect())
