"""Cross-site boilerplate lines: sketches of distinct sites per line, exact near the limit.

A line (white space at its ends removed, at least ``min_words`` words) is
boilerplate if it stands on ``min_sites`` sites or more.  A line seen fewer
times than that cannot be, so a count by line hash picks the lines worth a
second look.  Each of these gets a HyperLogLog sketch of its sites; sketches
merge in the aggregation, partly on the map side, so a line on a third of all
documents costs no more than another.  Estimates far from the limit decide;
lines within ``margin`` of it get an exact count of distinct sites.  A
boilerplate line stays in the document with the smallest id that has it and
leaves all others; a document keeps the order of its other lines.

Lines are known by two 64-bit hashes together.  Defined cases: null texts stay
null; blank lines and lines of fewer words are never touched; a null site is a
site of its own; repeated rows (same id and text) come back once each, treated
alike; a line that only documents without an id have stays in all of them; an
empty table gives an empty result; other columns come back unchanged.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import read_table, stored

MIN_SITES = 8
MIN_WORDS = 3
#: log2 of the sketch's registers: a relative error of about 1.04 / sqrt(2^12) = 1.6 %.
SKETCH_K = 12
#: Estimates within this share of the limit are counted exactly (some ten standard errors).
MARGIN = 0.2


def _bare(line: Column) -> Column:
    return F.regexp_replace(line, r"^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$", "")


def _long_enough(min_words: int) -> str:
    return r"(?:[^\x20\x09-\x0D]+[\x20\x09-\x0D]+){%d}[^\x20\x09-\x0D]" % max(0, min_words - 1)


def line_rows(docs: DataFrame, doc_id: str, text: str, site: str, min_words: int) -> DataFrame:
    """One narrow row per line: its two hashes, its site's hash, the document and the place.

    Spark's hash of several columns takes each one's hash as the seed of the next: the line comes last in
    the second hash, so that its text is hashed from another seed.
    """
    d = docs.select(F.col(doc_id).alias("doc_id"), F.xxhash64(text).alias("th"), F.xxhash64(site).alias("site"),
                    F.posexplode(F.split(text, "\n")).alias("pos", "line"))
    bare = d.filter(F.col("line").rlike(_long_enough(min_words))).withColumn("line", _bare(F.col("line")))
    return bare.select("doc_id", "th", "site", "pos", F.xxhash64("line").alias("h1"), F.xxhash64(F.lit(1), "line").alias("h2"))


def boilerplate_lines(lines: DataFrame, min_sites: int = MIN_SITES, margin: float = MARGIN, sketch_k: int = SKETCH_K) -> DataFrame:
    """``h1, h2, keeper``: lines on at least ``min_sites`` sites and the first document with them."""
    merged = stored(lines.groupBy("h1", "h2").agg(
        F.hll_sketch_estimate(F.hll_sketch_agg("site", F.lit(sketch_k))).alias("about"), F.min("doc_id").alias("keeper")), "sketches")
    clear = merged.filter(F.col("about") > min_sites * (1 + margin))
    close = merged.filter((F.col("about") >= min_sites * (1 - margin)) & (F.col("about") <= min_sites * (1 + margin)))
    exact = lines.join(close.select("h1", "h2"), ["h1", "h2"], "left_semi").select("h1", "h2", "site").distinct()
    exact = exact.groupBy("h1", "h2").agg(F.count(F.lit(1)).alias("sites")).filter(F.col("sites") >= min_sites)
    return clear.select("h1", "h2", "keeper").unionByName(close.join(exact, ["h1", "h2"]).select("h1", "h2", "keeper"))


def removals(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", site: str = "source",
             min_sites: int = MIN_SITES, min_words: int = MIN_WORDS) -> DataFrame:
    """``doc_id, th, places``: places of the lines that leave a document, by id and text hash."""
    rows = line_rows(docs, doc_id, text, site, min_words)
    often = rows.groupBy("h1").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") >= min_sites).select("h1")
    often = stored(often, "often")  # its measured size decides how the lines meet it
    seen = stored(rows.join(often, "h1", "left_semi"), "lines")
    bad = stored(boilerplate_lines(seen, min_sites), "boilerplate")
    gone = seen.join(bad, ["h1", "h2"]).filter(~F.col("doc_id").eqNullSafe(F.col("keeper")))
    return stored(gone.groupBy("doc_id", "th").agg(F.collect_set("pos").alias("places")), "removals")


def line_dedup(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", site: str = "source",
               min_sites: int = MIN_SITES, min_words: int = MIN_WORDS) -> DataFrame:
    """``docs`` without its cross-site boilerplate lines (all columns, ``text`` rewritten)."""
    gone = removals(docs, doc_id, text, site, min_sites, min_words)
    gone = gone.select(F.col("doc_id").alias("__gone_id"), F.col("th").alias("__gone_th"), F.col("places").alias("__places"))
    names = docs.columns
    joined = docs.join(gone, docs[doc_id].eqNullSafe(gone["__gone_id"]) & (F.xxhash64(docs[text]) == gone["__gone_th"]), "left")
    # The lines are a column of their own: built once per document, and only where some leave.
    joined = joined.withColumn("__lines", F.when(F.col("__places").isNotNull(), F.split(docs[text], "\n")))
    left = F.array_except(F.sequence(F.lit(0), F.size("__lines") - 1), F.col("__places"))
    kept = F.array_join(F.transform(left, lambda k: F.get("__lines", k)), "\n")
    rewritten = F.when(F.col("__places").isNull(), docs[text]).otherwise(kept)
    return joined.select(*[rewritten.alias(c) if c == text else docs[c] for c in names])


def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = line_dedup(read_table(spark, sf_dir, "documents"))
    return out.select("doc_id", "text", "lang", "source", "n_chars")


OP2_SQL = rf"""
WITH d AS (
  SELECT row_number() OVER () AS rid, doc_id, text, lang, source, n_chars FROM documents
), l AS (
  SELECT rid, doc_id, source, unnest(range(0, len(ls)::BIGINT)) AS pos, unnest(ls) AS line
  FROM (SELECT *, string_split(text, chr(10)) AS ls FROM d WHERE text IS NOT NULL)
), b AS (
  SELECT *, CASE WHEN regexp_matches(line, '{_long_enough(MIN_WORDS)}')
                 THEN regexp_replace(line, '^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$', '', 'g') END AS bare FROM l
), s AS (
  SELECT bare, min(doc_id) AS keeper FROM b WHERE bare IS NOT NULL
  GROUP BY bare HAVING count(DISTINCT source) + max((source IS NULL)::INT) >= {MIN_SITES}
), k AS (
  SELECT b.rid, string_agg(b.line, chr(10) ORDER BY b.pos) AS text
  FROM b LEFT JOIN s ON s.bare = b.bare
  WHERE s.bare IS NULL OR b.doc_id IS NOT DISTINCT FROM s.keeper GROUP BY b.rid
)
SELECT d.doc_id, CASE WHEN d.text IS NOT NULL THEN coalesce(k.text, '') END AS text, d.lang, d.source, d.n_chars
FROM d LEFT JOIN k ON k.rid = d.rid
"""
