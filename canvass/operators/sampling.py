"""Exact-size, reproducible simple random samples.

The source orders rows by a random value and keeps the first n.  Here the
order is a pair of hashes: ``md5(key || '|' || seed)``, then
``md5(key|tiebreak...|seed)`` over the row's identity (term and pet).  Both
are uniform, independent of how the input is partitioned and the same in any
SQL engine, so a sample can be redrawn and checked.

``orderBy(h).limit(n)`` would be one top-n merge in a single task over n rows
from every partition, which is too much for n in the tens of thousands on
thousands of partitions.  Instead the hash digits cut the rows into buckets:
one aggregation counts rows per bucket (at most 65,536 small rows come back
to the driver), every bucket wholly below the cut is taken by a filter, and
only the one bucket that straddles the cut is ranked.  That bucket is refined
digit group by digit group until it holds at most ``rank_limit`` rows; when
it must be refined, it is stored once so the next levels read only its rows.  The
second hash keeps refining when one key has very many rows (a policy with a
third of the population stays splittable); only rows with the same identity
can share all 64 digits.
"""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from canvass.functions.rules import NEW_POLICY_PRODUCT_PREFIXES, new_policy_product
from canvass.operators.joins import dimension
from canvass.operators.skew import row_number_per_key
from canvass.session import ensure_checkpoint_dir

HASH = "_sample_hash"
DIGITS_PER_LEVEL = 4  # 16 bits: at most 65,536 bucket counts per level


def sample_hash(key: Column | str, seed: int) -> Column:
    """md5 of ``key || '|' || seed``; a NULL key counts as '' (as SQL ``concat`` does in DuckDB)."""
    k = F.col(key) if isinstance(key, str) else key
    return F.md5(F.concat(F.coalesce(k.cast("string"), F.lit("")), F.lit(f"|{seed}")))


def identity_hash(key: str, tiebreak: tuple[str, ...], seed: int) -> Column:
    """md5 of the row identity: key and tiebreak columns, '|'-joined, NULLs skipped."""
    parts = [F.col(c).cast("string") for c in (key, *tiebreak)]
    return F.md5(F.concat_ws("|", *parts, F.lit(str(seed))))


def random_sample(df: DataFrame, n: int, seed: int, key: str = "policyid",
                  tiebreak: tuple[str, ...] = ("pp_petname", "pp_pet_sex", "pp_date_of_birth"),
                  rank_limit: int = 250_000) -> DataFrame:
    """The ``n`` rows first in ``md5(identity|seed)`` order: rows are drawn one by one,
    so several pets of a policy are taken independently.

    The result has exactly ``min(n, rows)`` rows and does not depend on
    partitioning.  Rows that tie on the hash have the same identity; among
    them the order falls to the remaining columns (ascending, NULLs first),
    ranked without a single-task merge even when they are very many.
    """
    if n <= 0:
        return df.limit(0)
    cols = df.columns
    present = tuple(c for c in tiebreak if c in cols)
    scored = df.withColumn(HASH, identity_hash(key, present, seed))
    order = [F.col(HASH).asc()] + [F.col(c).asc() for c in cols]
    full = 32

    taken: list[DataFrame] = []
    scratch: str | None = None
    need = n
    prefix = ""          # hash prefix of the straddling bucket so far
    pool = scored        # rows inside that bucket
    while True:
        start = len(prefix) + 1
        bucket = F.substring(F.col(HASH), start, DIGITS_PER_LEVEL)
        counts = sorted((r["b"], r["n"]) for r in
                        pool.groupBy(bucket.alias("b")).agg(F.count(F.lit(1)).alias("n")).collect())
        before = 0
        cut = None
        for b, c in counts:
            if before + c >= need:
                cut = (b, c)
                break
            before += c
        if cut is None:            # fewer rows than needed: take them all
            taken.append(pool)
            break
        b, c = cut
        if before:
            taken.append(pool.filter(bucket < F.lit(b)))
        need -= before
        prefix = prefix + b
        pool = pool.filter(F.substring(F.col(HASH), 1, len(prefix)) == F.lit(prefix))
        if c > rank_limit and len(prefix) < full:
            # More levels follow: store the straddling bucket once, so they
            # read only its rows instead of rescanning the whole input.
            if scratch is None:
                scratch = f"{ensure_checkpoint_dir(df.sparkSession).rstrip('/')}/canvass-sample-{uuid.uuid4().hex[:12]}"
            pool.write.mode("overwrite").parquet(f"{scratch}/{prefix}")
            pool = df.sparkSession.read.parquet(f"{scratch}/{prefix}")
        if c <= rank_limit:
            taken.append(pool.orderBy(*order).limit(need))
            break
        if len(prefix) >= full:
            # Still large with the hash used up: copies of one identity.
            # Rank them with the split-safe row number (range partitions on
            # the full order) instead of a single top-n merge.
            ranked = row_number_per_key(pool.withColumn("_bucket", F.lit(0)), ["_bucket"], [HASH, *cols],
                                        "_rank", hot_rows=rank_limit)
            taken.append(ranked.filter(F.col("_rank") <= need).drop("_bucket", "_rank"))
            break
    out = taken[0]
    for part in taken[1:]:
        out = out.unionByName(part)
    return out.select(*cols)


def new_policy_pool(f2a: DataFrame, exclude: DataFrame, max_broadcast_bytes: int | None = None) -> DataFrame:
    """NPS_F4: single-pet holders on term 0 or 1 with a new-business product,
    minus the rows already drawn (set difference: distinct, NULL-safe).

    The drawn sample has at most n rows; with ``max_broadcast_bytes`` it is
    broadcast behind a size check, so the pool is not shuffled for the
    anti join (only once, for the distinct).
    """
    pool = f2a.filter((F.col("total_pets") == 1) & F.col("policy_renew_no").isin(0, 1)
                      & new_policy_product("baseproduct"))
    drawn = exclude.select(*f2a.columns)
    if max_broadcast_bytes is None:
        return pool.subtract(drawn)
    # EXCEPT DISTINCT written out (Catalyst's own rewrite: a null-safe anti
    # join plus distinct) so the broadcast hint lands on the join; Catalyst
    # drops hints under a set operation before rewriting it.
    drawn = dimension(drawn, max_broadcast_bytes)
    same = reduce(lambda a, b: a & b, [pool[c].eqNullSafe(drawn[c]) for c in f2a.columns])
    return pool.join(drawn, same, "left_anti").distinct()


__all__ = ["NEW_POLICY_PRODUCT_PREFIXES", "new_policy_pool", "random_sample", "sample_hash"]
