"""Hand-loaded lists in, sample files out.

Suppression lists arrive as delimited files (one per source: A1 ... D2,
G1, H).  :func:`read_list` reads any number of them in one distributed scan
with an explicit schema and tags each row with its source, taken from a
column, a constant, or the file name.  A line that does not fit the schema
ends the read, or with ``skip_bad`` is left out; :func:`rejected_lines` then
tells which lines those were, by file and line number.
:class:`SuppressionStore` keeps the loaded list by source, so that a list can
be loaded again.  :func:`export_sample` writes a drawn sample as delimited
files with a header.
"""

from __future__ import annotations

import os
import uuid

from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from canvass.sources import files

INSURED_LIST = StructType([StructField("insured_code", StringType())])
POLICY_LIST = StructType([StructField("policy_no", StringType())])
EMAIL_LIST = StructType([StructField("email", StringType())])
BAD_EMAIL_LIST = StructType([StructField("bad_email", StringType())])


#: The column that holds a line which does not fit.
BAD_LINE = "_bad_line"


def read_list(spark: SparkSession, paths: str | list[str], schema: StructType, *, source: str | None = None,
              header: bool = True, sep: str = ",", skip_bad: bool = False) -> DataFrame:
    """Read delimited list files into ``schema`` plus a ``source`` column.

    ``source`` given: every row gets it.  Otherwise, when the schema has no
    ``source`` column, the source is the file's base name without extension
    (``A1.csv`` -> ``A1``); for a list of several part files, the folder's.  Text fields are trimmed and empty strings become
    NULL, as the warehouse's importer stores them.

    A line with too few or too many fields, or with a field that is no value
    of its type, fails the read; with ``skip_bad`` the other lines are
    returned, and :func:`rejected_lines` returns these.
    """
    reader = spark.read.option("header", header).option("sep", sep)
    paths = paths if isinstance(paths, list) else [paths]
    names = [f.name for f in schema.fields]
    if skip_bad:
        df = _permissive(reader, schema).csv(paths)
        # The second condition is always true and names every field: fields that the scan
        # leaves out are not parsed, and a line that is bad there would pass for a good one.
        every = F.concat(*[F.coalesce(F.col(n).cast("string"), F.lit("")) for n in names])
        df = df.filter(F.col(BAD_LINE).isNull() & (F.length(every) >= 0))
    else:
        df = reader.schema(schema).option("mode", "FAILFAST").csv(paths)
    cleaned = [F.nullif(F.trim(F.col(n)), F.lit("")).alias(n) if isinstance(schema[n].dataType, StringType)
               else F.col(n) for n in names]
    if source is not None:
        return df.select(*cleaned, F.lit(source).alias("source"))
    if "source" in names:
        return df.select(*cleaned)
    return df.select(*cleaned, _source_of(F.col("_metadata.file_path")).alias("source"))


def _source_of(file: Column) -> Column:
    return F.regexp_extract(file, r"([^/]+?)(\.[^/]*)?(/part-[^/]*)?$", 1)


def _permissive(reader, schema: StructType):
    whole = StructType([*schema.fields, StructField(BAD_LINE, StringType())])
    return reader.schema(whole).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", BAD_LINE)


def rejected_lines(spark: SparkSession, paths: str | list[str], schema: StructType, *, header: bool = True,
                   sep: str = ",") -> DataFrame:
    """The lines that ``read_list(skip_bad=True)`` leaves out: ``file, line_no, line, source``.

    Line numbers count from 1 and include the header and blank lines.  A file
    is read in splits by many tasks: a line's number is its place in its split
    plus the lines of the file's earlier splits, which one aggregation counts.
    """
    lines = spark.read.text(paths).select(
        F.col("value").alias("line"), F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("_split"), F.monotonically_increasing_id().alias("_at"))
    splits = lines.groupBy("file", "_split").agg(F.min("_at").alias("_first"), F.count(F.lit(1)).alias("_n"))
    before = F.sum("_n").over(Window.partitionBy("file").orderBy("_split").rowsBetween(Window.unboundedPreceding, -1))
    splits = splits.select("file", "_split", "_first", F.coalesce(before, F.lit(0)).alias("_before"))
    parsed = F.from_csv("line", f"{schema.toDDL()}, `{BAD_LINE}` STRING",
                        {"sep": sep, "mode": "PERMISSIVE", "columnNameOfCorruptRecord": BAD_LINE})
    # Blank lines are no rows to the list reader.  The header is dropped by its number, after the join.
    bad = lines.filter((F.trim("line") != "") & parsed[BAD_LINE].isNotNull())
    number = (F.col("_before") + F.col("_at") - F.col("_first") + 1).alias("line_no")
    numbered = bad.join(splits, ["file", "_split"]).select("file", number, "line", _source_of(F.col("file")).alias("source"))
    return numbered.filter(F.col("line_no") > 1) if header else numbered


class SuppressionStore:
    """The suppression list as a stored table under ``root``, one folder per source.

    Loading a source replaces what was loaded under that name and leaves the
    others as they are, so a list can be loaded again, after a failure or with
    corrections, and lists can come in over many sessions.  (An append would
    hold its rows twice.)  Only a finished load replaces anything.  A NULL or
    empty source is one source of its own, the NULL one.
    """

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def load(self, rows: DataFrame, sources: list[str] | None = None) -> list[str]:
        """Replace the sources in ``rows (insured_code, source)``.

        ``sources`` names the lists that were loaded: one of them without any
        row is emptied.  Returns the sources that now hold rows, sorted.
        """
        seen = Observation(f"load-{uuid.uuid4().hex[:12]}")
        watched = rows.select("insured_code", "source").observe(
            seen, F.count(F.lit(1)).alias("rows"), F.collect_set("source").alias("sources"))     # one entry per list
        (watched.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("source").parquet(self.root))
        found = set(seen.get["sources"])
        for gone in set(sources or ()) - found:
            files.delete(self.spark, f"{self.root}/{self._folder(gone)}")
        return sorted(found)

    def _folder(self, source: str) -> str:
        """The folder name of a source, special characters escaped as Spark does."""
        return self.spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.getPartitionPathString("source", source)

    def read(self) -> DataFrame:
        """All lists as loaded last: ``insured_code, source``."""
        schema = "insured_code string, source string"
        if not files.exists(self.spark, self.root):
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(self.root)


def export_sample(df: DataFrame, path: str, *, single_file: bool = False, sep: str = ",") -> str:
    """Write a sample as delimited files with a header (overwrite).

    The write is distributed; ``single_file=True`` first merges to one
    partition, which only suits a sample of bounded size (it is n rows).
    """
    out = df.repartition(1) if single_file else df
    (out.write.mode("overwrite").option("header", True).option("sep", sep)
     .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(path))
    return path if ":" in path else os.path.abspath(path)   # a URI stays as it is
