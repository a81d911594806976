"""Named warehouse tables as DataFrames.

A :class:`Warehouse` maps the table names the pull uses to DataFrames.
Tables can come from parquet directories, the session catalog or a JDBC
source (the remote pet and voucher tables); each is loaded lazily, once.
"""

from __future__ import annotations

import datetime as dt
from collections import Counter
from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, DecimalType, IntegralType

# Tables the pull reads, by role.
DOMAIN_TABLES = [
    # policy terms and the monthly in-force fact
    "dw_policy_header", "dw_data_inforce",
    # pets (remote in production), policyholders and policy dimensions
    "policy_pets", "dw_dim_insured", "dw_dim_breed", "dw_wp", "dw_dim_group",
    "dw_dim_provider", "dw_dim_origin", "dw_dim_paymentplan", "dw_dim_payment_type",
    "dw_dim_source", "dw_dim_zipcode",
    # claims
    "dw_claim_header", "dw_claim_revision", "dw_claim_diagnosis", "dw_claim_details",
    "dw_dim_coverage",
    # referral vouchers (remote in production)
    "vouchers_issued",
    # hand-loaded lists: base suppression list, by policy number, by e-mail, bad e-mails
    "nps_scrubber0", "nps_scrubber_policy", "nps_scrubber_dnc", "bad_email",
    # status and cancellations
    "dw_policy_pet", "dw_dim_policy_status", "dw_policy_term", "dw_cancel",
]


class Warehouse(Mapping):
    """Lazy, memoised mapping ``name -> DataFrame``."""

    def __init__(self, spark: SparkSession, loaders: dict[str, Callable[[], DataFrame]]):
        self.spark = spark
        self._loaders = dict(loaders)
        self._frames: dict[str, DataFrame] = {}

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._frames:
            if name not in self._loaders:
                raise KeyError(f"warehouse has no table {name!r}")
            self._frames[name] = self._loaders[name]()
        return self._frames[name]

    def __iter__(self):
        return iter(self._loaders)

    def __len__(self) -> int:
        return len(self._loaders)

    def with_table(self, name: str, df: DataFrame) -> "Warehouse":
        """A copy with one table replaced (e.g. a JDBC or CSV source)."""
        loaders = dict(self._loaders)
        loaders[name] = lambda: df
        return Warehouse(self.spark, loaders)

    @classmethod
    def from_parquet(cls, spark: SparkSession, root: str, names=DOMAIN_TABLES) -> "Warehouse":
        """One parquet dataset per table under ``root`` (``root/name``)."""
        return cls(spark, {n: (lambda n=n: spark.read.parquet(f"{root.rstrip('/')}/{n}")) for n in names})

    @classmethod
    def from_catalog(cls, spark: SparkSession, database: str | None = None, names=DOMAIN_TABLES) -> "Warehouse":
        """Catalog tables, optionally qualified by a database."""
        prefix = f"{database}." if database else ""
        return cls(spark, {n: (lambda n=n: spark.table(prefix + n)) for n in names})


def key_slices(keys: DataFrame, column: str, slices: int, accuracy: int = 10_000) -> list[str]:
    """SQL conditions on ``column`` that cut its rows into at most ``slices`` parts of about equal size.

    The cuts are quantiles of the values as they occur, from a mergeable
    sketch (``percentile_approx``: one aggregation, its state bounded by
    ``accuracy``), so a key that is dense in one place is cut there more
    often.  A value that alone holds more than a part is a slice of its own.
    Each row meets exactly one condition; NULL keys belong to the first.
    Whole numbers, decimals and dates can be cut.
    """
    kind = keys.schema[column].dataType
    number = F.col(column)
    if isinstance(kind, DateType):
        number = F.datediff(F.col(column), F.lit("1970-01-01").cast("date"))
    elif not isinstance(kind, (IntegralType, DecimalType)):
        raise TypeError(f"cannot cut {column}: {kind.simpleString()}")
    shares = [k / slices for k in range(1, slices)]
    found = keys.filter(F.col(column).isNotNull()).agg(
        F.percentile_approx(number, F.array(*[F.lit(s) for s in shares]), accuracy).alias("q")).first()["q"] if shares else None
    if not found:
        return ["1 = 1"]
    times = Counter(found)
    # Rows up to a cut lie below it; a value that fills whole parts is cut off on both sides.
    uppers: list[tuple] = []
    for value in sorted(times):
        if times[value] > 1:
            uppers.append((value, "<"))
        uppers.append((value, "<="))
    text = lambda v: f"DATE '{dt.date(1970, 1, 1) + dt.timedelta(days=int(v))}'" if isinstance(kind, DateType) else str(v)
    other = {"<": ">=", "<=": ">"}
    out = [f"{column} {uppers[0][1]} {text(uppers[0][0])} OR {column} IS NULL"]
    for (low, below), (high, upto) in zip(uppers, uppers[1:], strict=False):
        out.append(f"{column} {other[below]} {text(low)} AND {column} {upto} {text(high)}")
    return [*out, f"{column} {other[uppers[-1][1]]} {text(uppers[-1][0])}"]


def read_jdbc(spark: SparkSession, url: str, table: str, *, partition_column: str | None = None,
              lower_bound: int | None = None, upper_bound: int | None = None,
              num_partitions: int = 64, properties: dict | None = None, predicates: list[str] | None = None) -> DataFrame:
    """Read a remote table in parallel slices.

    With ``partition_column`` and bounds, Spark issues ``num_partitions``
    range queries of equal width at once instead of one serial scan; with
    ``predicates`` (:func:`key_slices`) one query for each, of about equal
    numbers of rows.  Filters and the column projection applied to the result
    are pushed into each query.
    """
    if predicates is not None:
        if partition_column is not None:
            raise ValueError("give predicates or a partition column, not both")
        return spark.read.jdbc(url, table, predicates=predicates, properties=properties or {})
    reader = spark.read.format("jdbc").option("url", url).option("dbtable", table)
    for key, value in (properties or {}).items():
        reader = reader.option(key, value)
    if partition_column is not None:
        if lower_bound is None or upper_bound is None:
            raise ValueError("a partitioned JDBC read needs lower_bound and upper_bound")
        reader = (reader.option("partitionColumn", partition_column)
                  .option("lowerBound", str(lower_bound)).option("upperBound", str(upper_bound))
                  .option("numPartitions", str(num_partitions)))
    return reader.load()
