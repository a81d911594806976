"""A stored layout of the claim tables that needs no shuffle to join them.

The claim chain joins four tables of revision and detail grain and the policy
header, by claim, by diagnosis and by policy, on every pull.  They all belong
to a policy.  :func:`cluster_claims` stores them once with the policy's id in
every row, bucketed by it, so each join of the chain finds both sides in the
same bucket; a pull then moves one row a policy and claim, not the claim lines.

The layout is worth it when a warehouse is pulled more than once, and only as
long as no policy holds a large share of the claims: a bucket is one task, and
a join that reads buckets is not split at run time.  So the buckets are
counted after they are written, and tables with a bucket above
:data:`UNEVEN` times the average are read as plain files, which a pull joins
by shuffles that split.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.errors import PySparkAttributeError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from canvass.operators.joins import size_in_bytes
from canvass.session import sibling_session
from canvass.sources.warehouse import Warehouse

POLICY, CLAIM, DIAGNOSIS = "policyid", "claim_id", "claim_diagnosis_id"
#: Largest bucket, in averages, that is still read as a bucket.
UNEVEN = 4.0
#: Fewer rows than this in a bucket are no burden, however uneven.
SMALL = 1_000_000
#: Joins by (policy, claim, revision) may use the buckets, which are by policy alone.
BUCKET_CONF = "spark.sql.requireAllClusterKeysForCoPartition"
#: Size of the details in a bucket, by the optimizer's figures, and the fewest buckets.
BUCKET_BYTES, MIN_BUCKETS = 4 << 20, 8


def buckets_for(tables: Mapping[str, DataFrame], bucket_bytes: int = BUCKET_BYTES) -> int:
    """Buckets for the claim tables: their number grows with the details, so that the rows of one do
    not (a bucket is sorted and joined by one task).  From metadata alone, no job runs."""
    details = tables["dw_claim_details"]
    try:
        return max(MIN_BUCKETS, -(-size_in_bytes(details) // bucket_bytes))
    except (AttributeError, PySparkAttributeError):   # Spark Connect: the optimizer cannot be asked
        return max(MIN_BUCKETS, int(details.sparkSession.conf.get("spark.sql.shuffle.partitions")))


def with_policy(tables: Mapping[str, DataFrame], keep: Callable[[str, DataFrame], DataFrame] = lambda name, df: df) -> dict[str, DataFrame]:
    """The header and the claim tables, each with ``policyid`` (the details with ``claim_id`` too).

    ``keep`` is given every table as soon as it is made and returns the copy
    that the later ones are made from.  The revisions' and diagnoses' policies
    come from the claim header, the details' from the diagnoses: of copies that
    lie by policy, the different (claim, policy) pairs are found without a shuffle.

    A row whose claim or diagnosis is unknown is kept, with NULL; a claim that
    the claim header gives to several policies is there once for each, as the
    chain's joins would have it.
    """
    out = {name: keep(name, tables[name]) for name in ("dw_policy_header", "dw_claim_header")}
    owner = out["dw_claim_header"].select(POLICY, CLAIM).distinct()
    for name in ("dw_claim_revision", "dw_claim_diagnosis"):
        out[name] = keep(name, tables[name].join(owner, CLAIM, "left"))
    claim_of = out["dw_claim_diagnosis"].select(DIAGNOSIS, CLAIM, POLICY).distinct()
    out["dw_claim_details"] = keep("dw_claim_details", tables["dw_claim_details"].join(claim_of, DIAGNOSIS, "left"))
    return out


def cluster_claims(spark: SparkSession, tables: Warehouse, database: str, buckets: int, *, uneven: float = UNEVEN,
                   small: int = SMALL) -> Warehouse:
    """Store the header and the claim tables in ``database``, bucketed and sorted by policy;
    ``tables`` with these in their place.

    They are read in a session of their own, the only one that joins by a part
    of the keys: elsewhere that could bring a hot key into one task.
    """
    own = sibling_session(spark, {BUCKET_CONF: "false"})
    out = tables

    def keep(name: str, df: DataFrame) -> DataFrame:
        nonlocal out
        order = [c for c in (POLICY, CLAIM, DIAGNOSIS) if c in df.columns]
        full = f"{database}.{name}"
        spark.sql(f"DROP TABLE IF EXISTS {full}")
        # Dealt as the buckets are: each task writes one file of one bucket.
        (df.repartition(buckets, POLICY).write.option("compression", "zstd").bucketBy(buckets, POLICY).sortBy(*order).saveAsTable(full))
        even = largest_share(spark.table(full), buckets, small) <= uneven
        out = out.with_table(name, own.table(full) if even else plain(spark, full))
        return spark.table(full) if even else plain(spark, full)

    with_policy(tables, keep)
    return out


def largest_share(df: DataFrame, buckets: int, small: int = SMALL) -> float:
    """Rows of the largest bucket, in averages; 0 where no bucket holds more than ``small`` rows."""
    bucket = F.pmod(F.hash(POLICY), F.lit(buckets))
    rows = [r["count"] for r in df.groupBy(bucket.alias("b")).count().collect()]      # one row per bucket
    return max(rows) * buckets / sum(rows) if rows and max(rows) > small else 0.0


def plain(spark: SparkSession, table: str) -> DataFrame:
    """A stored table read as files, without its buckets."""
    stored = spark.table(table)
    return spark.read.schema(stored.schema).parquet(sorted({f.rsplit("/", 1)[0] for f in stored.inputFiles()})[0])
