"""Joins that stay balanced when one key holds a large share of the rows.

AQE splits a skewed sort-merge join only when both inputs come straight from
a shuffle.  A per-key aggregate joined back to its own rows does not qualify
(the aggregate is already partitioned by the key), so a household holding a
third of all rows would be joined in one task.  :func:`join_per_key` salts
such hot keys explicitly.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SALT = "_salt"
_SALTS = "_salts"
#: Fewer keys than this are ever hot, whatever the input's size, so the hot-key table can be broadcast.
MAX_HOT_KEYS = 10_000
#: Keys are counted together by a hash of so many values first: only a cell above the limit can hold a hot key.
CELLS = 4096


def hot_limit(total_rows: int, hot_rows: int) -> int:
    """Rows above which a key is hot: ``hot_rows``, or a ten-thousandth of all
    rows if that is more, so fewer than :data:`MAX_HOT_KEYS` keys can be hot."""
    return max(hot_rows, -(-total_rows // MAX_HOT_KEYS))


def join_per_key(rows: DataFrame, per_key: DataFrame, key: str, *, rows_per_key: str, hot_rows: int,
                 salt_by: list[str], how: str = "left") -> DataFrame:
    """Join ``per_key`` (one row per key) onto ``rows``, splitting hot keys.

    ``per_key[rows_per_key]`` is the number of ``rows`` with that key.  A key
    with more rows than :func:`hot_limit` is hot: its rows get a salt
    ``pmod(xxhash64(salt_by), n)`` with ``n = ceil(count / limit)``, and its
    ``per_key`` row is repeated once per salt, so the join on ``(key, salt)``
    spreads it over ``n`` tasks of about ``limit`` rows each (``salt_by``
    should tell the key's rows apart).  Other keys join unchanged (salt 0).
    The hot-key table is broadcast: it holds fewer than :data:`MAX_HOT_KEYS`
    rows at every size, and the repeated ``per_key`` rows fewer than twice that.
    ``per_key`` is read more than once: pass a stored copy.  The result
    equals the plain join on ``key``, which is what runs when no key is hot.
    """
    sums = per_key.agg(F.sum(rows_per_key).alias("t"), F.max(rows_per_key).alias("m")).first()
    limit = hot_limit(sums["t"] or 0, hot_rows)
    if (sums["m"] or 0) <= limit:                      # the usual case: a plain join
        return rows.join(per_key, key, how)
    hot_keys = per_key.filter(F.col(rows_per_key) > limit)
    n = F.ceil(F.col(rows_per_key) / F.lit(limit)).cast("int")
    hot = F.broadcast(hot_keys.select(key, n.alias(_SALTS)))

    salt_rows: Column = F.when(F.col(_SALTS).isNull(), F.lit(0)).otherwise(
        F.pmod(F.xxhash64(*salt_by), F.col(_SALTS)).cast("int"))
    r = rows.join(hot, key, "left").withColumn(SALT, salt_rows).drop(_SALTS)

    salts: Column = F.when(F.col(_SALTS).isNull(), F.array(F.lit(0))).otherwise(
        F.sequence(F.lit(0), F.col(_SALTS) - 1))
    k = per_key.join(hot, key, "left").withColumn(SALT, F.explode(salts)).drop(_SALTS)
    return r.join(k, [key, SALT], how).drop(SALT)


def row_number_per_key(df: DataFrame, key: list[str], order: list[str], out: str, *, hot_rows: int,
                       scratch: str | None = None, partitions: int | None = None) -> DataFrame:
    """``row_number() over (partition by key order by order)`` (1-based), safe
    for a key holding a large share of the rows.

    A window holds each key's rows in one task.  Keys with at most
    ``hot_rows`` rows keep that plain window.  Keys are counted only where a
    count of hash cells leaves room for a hot one, so the usual case shuffles
    the rows once, for the window.  The rows of hotter keys (above
    :func:`hot_limit`, a broadcast set of bounded size) are
    range-partitioned on ``key + order`` and written once under ``scratch``
    (so the range assignment cannot change on recomputation).  They are then
    numbered within each (key, partition), about that limit of rows per
    partition however large the key, and each partition is offset by
    the rows of that key in earlier partitions (a running sum over a small
    per-partition count table).  Rows that tie on all ``order`` columns are
    numbered in an arbitrary order, as with the plain window.
    """
    from pyspark.sql import Window

    spark = df.sparkSession
    w = Window.partitionBy(*key).orderBy(*order)
    cell = F.pmod(F.xxhash64(*key), F.lit(CELLS))
    cells = df.groupBy(cell.alias("_cell")).agg(F.count(F.lit(1)).alias("_n")).collect()      # at most CELLS small rows
    limit = hot_limit(sum(c["_n"] for c in cells), hot_rows)
    full = [c["_cell"] for c in cells if c["_n"] > limit]
    counts = df.filter(cell.isin(full)).groupBy(*key).agg(F.count(F.lit(1)).alias("_n"))
    if not full or counts.agg(F.max("_n").alias("m")).first()["m"] <= limit:      # the usual case: no hot key
        return df.withColumn(out, F.row_number().over(w))

    hot_total = counts.filter(F.col("_n") > limit).agg(F.sum("_n").alias("t")).first()["t"]
    hot_b = F.broadcast(counts.filter(F.col("_n") > limit).select(*key))
    normal = df.join(hot_b, key, "left_anti").withColumn(out, F.row_number().over(w))
    if scratch is None:
        from canvass.session import ensure_checkpoint_dir
        scratch = f"{ensure_checkpoint_dir(spark).rstrip('/')}/canvass-rank-{uuid.uuid4().hex[:12]}"
    # about limit rows per range partition, however large the hot keys are
    n_parts = partitions or max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-hot_total // limit))
    (df.join(hot_b, key, "left_semi").repartitionByRange(n_parts, *key, *order)
     .withColumn("_pid", F.spark_partition_id())
     .write.mode("overwrite").parquet(scratch))
    ranged = spark.read.parquet(scratch)
    local = ranged.withColumn("_lrn", F.row_number().over(Window.partitionBy(*key, "_pid").orderBy(*order)))
    per_part = ranged.groupBy(*key, "_pid").agg(F.count(F.lit(1)).alias("_c"))
    offsets = per_part.withColumn(
        "_off", F.coalesce(F.sum("_c").over(Window.partitionBy(*key).orderBy("_pid")
                                            .rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    # ranges follow the key order, so there are at most partitions + hot keys rows: broadcast
    hot_ranked = (local.join(F.broadcast(offsets.select(*key, "_pid", "_off")), [*key, "_pid"])
                  .withColumn(out, (F.col("_lrn") + F.col("_off")).cast("int"))
                  .select(*df.columns, out))
    return normal.unionByName(hot_ranked)
