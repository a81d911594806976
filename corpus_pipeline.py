"""The corpus pipeline: five stages over ``documents``.

Each stage function takes (spark, docs, sf_dir) and returns a DataFrame; ``run``
writes every stage's result as parquet into the shared checkpoint folder and
reads it back as the next one's documents.  All stages but the last return the
columns of ``documents``.

An empty table passes through all stages; null texts are handled as the
operators' docstrings say.  The classifier keeps every document that it does not
reject; line dedup keeps a line's first document; one document of each SimHash
group stays; the mix repeats or drops documents to meet the sources' targets.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from canvass.llm.common import read_table, stored
from canvass.llm.line_dedup import line_dedup
from canvass.llm.mixing import take_mix
from canvass.llm.quality_classifier import quality_filter
from canvass.llm.sentencepiece_codec import MODEL, encode_documents
from canvass.llm.simhash import drop_near_duplicates


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality_filter(docs, read_table(spark, sf_dir, "labels"))


def line_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    out = line_dedup(docs)
    return out.withColumn("n_chars", F.coalesce(F.length("text").cast("long"), F.col("n_chars")))


def simhash_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return drop_near_duplicates(docs)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return take_mix(docs)


def encoding_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return encode_documents(docs, public_tokenizers.path(MODEL))


STAGES = [
    ("quality_classifier", quality_stage),
    ("line_dedup", line_stage),
    ("simhash_near_dedup", simhash_stage),
    ("mixing", mixing_stage),
    ("sentencepiece", encoding_stage),
]

#: The classifier and the mix cannot be said in SQL; the pipeline is tested stage by stage.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
