"""Positions equal a plain sort, whatever the ties, and no range holds a hot key whole."""

import random

import pytest
from pyspark.sql import functions as F

from canvass.operators import positions as P
from canvass.operators.positions import with_position
from tests.test_plans import plan


def nulls_last(x, down=False):
    return (x is None, (-x if down else x) if x is not None else 0)


@pytest.mark.parametrize("partitions", [1, 3, 16])
def test_positions_equal_a_plain_sort(spark, partitions):
    rng = random.Random(partitions)
    data = [(rng.choice([None, 1, 2, 3]), rng.choice([None, "a", "b", "é", ""]), rng.randrange(4)) for _ in range(400)]
    df = spark.createDataFrame(data, "n int, s string, k int").repartition(5)
    got = with_position(df, [F.col("n").desc_nulls_last(), F.col("s").asc_nulls_last()], partitions=partitions).collect()
    key = lambda r: (nulls_last(r[0], True), (r[1] is None, (r[1] or "").encode()), r[2])
    assert [tuple(r)[:3] for r in sorted(got, key=lambda r: r.position)] == sorted(data, key=key)
    assert sorted(r.position for r in got) == list(range(1, 401))
    per = with_position(df, [F.col("s").asc_nulls_last()], per=("k",), partitions=partitions).collect()
    for k in range(4):
        mine = sorted((r for r in per if r.k == k), key=lambda r: r.position)
        assert [r.position for r in mine] == list(range(1, len(mine) + 1))
        want = sorted((d for d in data if d[2] == k), key=lambda r: ((r[1] is None, (r[1] or "").encode()), (r[0] is not None, r[0] or 0)))
        assert [tuple(r)[:3] for r in mine] == want


def test_null_keys_and_empty_tables(spark):
    df = spark.createDataFrame([(None, 2), (None, 1), ("x", 1)], "k string, v int")
    got = sorted(map(str, map(tuple, with_position(df, [F.col("v")], per=("k",)).collect())))
    assert got == sorted(map(str, [(None, 1, 1), (None, 2, 2), ("x", 1, 1)]))
    assert with_position(df.limit(0), [F.col("v")]).count() == 0


def test_neither_a_key_nor_a_tie_nor_a_repeated_row_lies_in_one_range(spark, monkeypatch):
    seen = []
    union = F.spark_partition_id
    monkeypatch.setattr(P.F, "spark_partition_id", lambda: (seen.append(1), union())[1])
    hot = spark.range(30_000).select(F.lit("same").alias("k"), F.lit(1).alias("v")).unionByName(
        spark.range(100).select(F.col("id").cast("string").alias("k"), F.col("id").cast("int").alias("v")))
    got = with_position(hot, [F.col("v")], per=("k",), partitions=16)
    assert seen and got.filter("k = 'same'").agg(F.max("position"), F.countDistinct("position")).first() == (30_000, 30_000)
    tree = plan(got)
    assert "Window [row_number()" in tree and "hashpartitioning(k" in tree and "SinglePartition" not in tree
    at = next(f for f in got.inputFiles()).rsplit("/", 1)[0]
    ranges = spark.read.parquet(at).filter("k = 'same'").groupBy("_range").count().collect()
    assert len(ranges) >= 8 and max(r["count"] for r in ranges) < 10_000
