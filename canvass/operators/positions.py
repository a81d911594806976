"""Row positions in a sort order, without a task that sees all rows.

``row_number() over (order by ...)`` has one partition: every row goes to one
task.  :func:`with_position` cuts the rows into ranges of the order, numbers
each range by itself and adds the rows of the ranges before it.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from canvass.session import ensure_checkpoint_dir, shuffles_removed

_RANGE, _LOCAL, _BEFORE, _ROWS, _APART = "_range", "_local", "_before", "_rows", "_apart"


def with_position(df: DataFrame, order: list[Column], per: tuple[str, ...] = (), out: str = "position",
                  partitions: int | None = None) -> DataFrame:
    """``df`` with each row's place (from 1) in ``order``, within the rows that agree in ``per``.

    The rows are range-partitioned and stored, so that the ranges cannot
    change when a task runs again.  Numbering a range is one partition of a
    window; the rows before it are a running sum over one row for each range
    (and key of ``per`` in it).  Rows that tie in ``order`` are numbered in
    the order of their other columns, so the result does not depend on how
    the input is partitioned.  The ranges go by those columns too, and by a
    random number after them: neither a key of ``per``, nor a tie, nor one row
    that repeats a million times has to lie in one range.
    """
    spark = df.sparkSession
    n = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/canvass-positions-{uuid.uuid4().hex[:12]}"
    place = [*order, *[F.col(c).asc_nulls_first() for c in df.columns], F.col(_APART)]
    ranges = (df.withColumn(_APART, F.rand(17)).repartitionByRange(n, *[F.col(p).asc_nulls_first() for p in per], *place)
              .withColumn(_RANGE, F.spark_partition_id()))
    with shuffles_removed(spark):
        ranges.write.parquet(path)
    ranged = spark.read.parquet(path)
    local = F.row_number().over(Window.partitionBy(*per, _RANGE).orderBy(*place))
    sizes = ranged.groupBy(*per, _RANGE).agg(F.count(F.lit(1)).alias(_ROWS))
    # At most ranges + keys rows in all, and of one key at most one for each range.
    earlier = Window.partitionBy(*per).orderBy(_RANGE).rowsBetween(Window.unboundedPreceding, -1)
    before = sizes.select(*[F.col(p).alias(f"_{p}") for p in per], F.col(_RANGE).alias("_at"),
                          F.coalesce(F.sum(_ROWS).over(earlier), F.lit(0)).alias(_BEFORE))
    same = F.col(_RANGE) == F.col("_at")
    for p in per:
        same = same & F.col(p).eqNullSafe(F.col(f"_{p}"))
    return (ranged.withColumn(_LOCAL, local).join(before, same)
            .select(*df.columns, (F.col(_LOCAL) + F.col(_BEFORE)).alias(out)))
