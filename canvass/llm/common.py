"""Helpers shared by the operators: tables, words, stored stages."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from canvass.session import ensure_checkpoint_dir

#: The white space that separates words, U+0020 and U+0009 to U+000D.
SPACES = " \t\n\x0b\x0c\r"
WORD = r"[^\x20\x09-\x0D]+"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def spaced(text: Column) -> Column:
    """``text`` with every word separator turned into a plain space (null: empty)."""
    out = F.coalesce(text, F.lit(""))
    for ch in SPACES[1:]:
        out = F.replace(out, F.lit(ch), F.lit(" "))
    return out


def words_of_spaced(flat: Column) -> Column:
    """The words of a text that went through :func:`spaced`."""
    return F.array_remove(F.split(flat, " "), "")


def word_count(text: Column) -> Column:
    """Number of words of a whole text (null: 0)."""
    return F.size(words_of_spaced(spaced(text))).cast("long")


#: A row's identity as plain equality keys (a null id is a value of its own), so that joins
#: and windows on it share one shuffle.
ROW_KEY = ["__id", "__no_id", "__text"]


def row_key(doc_id: str, text_hash: Column) -> list[Column]:
    return [F.coalesce(F.col(doc_id), F.lit(0)).alias("__id"), F.col(doc_id).isNull().alias("__no_id"), text_hash.alias("__text")]


#: Whole texts that reach Python in one Arrow batch, at most.
TEXTS_PER_BATCH = 1024


def text_batches(df: DataFrame) -> DataFrame:
    """``df``, with its session's Arrow batches kept small: texts take kilobytes each,
    and a batch is held several times over (Arrow, Python, results)."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    now = int(df.sparkSession.conf.get(key, "10000"))
    if now <= 0 or now > TEXTS_PER_BATCH:
        df.sparkSession.conf.set(key, str(TEXTS_PER_BATCH))
    return df


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new folder name under the shared checkpoint folder."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/llm-{label}-{uuid.uuid4().hex[:12]}"


def stored(df: DataFrame, label: str, path: str | None = None) -> DataFrame:
    """Write ``df`` as parquet to the shared folder and read it back.

    Cuts the lineage the way ``checkpoint()`` does, but columnar and with file
    sizes that let Spark pick join sides; survives lost executors.
    """
    spark = df.sparkSession
    path = path or scratch_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def discard(spark: SparkSession, path: str) -> None:
    """Remove a stage folder made by :func:`stored` that nothing reads any more."""
    jpath = spark._jvm.org.apache.hadoop.fs.Path(path)
    jpath.getFileSystem(spark._jsc.hadoopConfiguration()).delete(jpath, True)
