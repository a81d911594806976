"""Host-level quality rules, in DataFrame functions only.

Each text gets its counts (words, symbols, repeated lines, repeated 5-word
windows) and a base verdict.  Failures are aggregated by host; a host's rate
is shrunk towards the corpus rate with a beta prior fitted to all hosts by
moments, and hosts whose shrunk rate reaches ``host_limit`` are rejected as a
whole.  The host verdicts are joined back to the documents.

Defined cases: a null text is an empty one (and fails the base rules); null
hosts form a host of their own; repeated rows count once each and come back
once each; an empty table gives an empty result; columns other than the three
named ones are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import read_table, spaced, stored, words_of_spaced

WINDOW = 5
MIN_WORDS = 10
MAX_REPEAT_PERCENT = 20
HOST_LIMIT = 0.5
#: Bounds of the fitted intra-host correlation; the prior is worth 1/rho - 1 documents.
RHO_RANGE = (0.001, 0.5)


def document_counts(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", host: str = "source") -> DataFrame:
    """One narrow row per document: doc_id, host and the counts of its whole text.

    The projections are kept apart so that each array is built once; a text's
    window hashes are sorted only if some of them are equal.
    """
    d = docs.select(F.col(doc_id).alias("doc_id"), F.col(host).alias("host"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    d = d.select("doc_id", "host", "text", spaced(F.col("text")).alias("flat"))
    d = d.select(
        "doc_id", "host",
        words_of_spaced(F.col("flat")).alias("words"),
        F.length(F.replace(F.col("flat"), F.lit(" "), F.lit(""))).cast("long").alias("word_chars"),
        F.regexp_count(F.col("text"), F.lit("[#*$%&|<>]")).cast("long").alias("n_symbols"),
        F.filter(F.split("text", "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]")).alias("lines"),
    )
    n = F.size("words")
    window = lambda i: F.xxhash64(*[F.col("words")[i + k] for k in range(WINDOW)])
    d = d.select(
        "doc_id", "host", n.cast("long").alias("n_words"), "word_chars", "n_symbols",
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        F.when(n >= WINDOW, F.transform(F.sequence(F.lit(0), n - WINDOW), window)).alias("hashes"),
    )
    counts = ["doc_id", "host", "n_words", "word_chars", "n_symbols", "n_dup_lines"]
    repeats = F.size(F.array_distinct("hashes")) < F.size("hashes")
    ranked = F.sort_array(F.transform("hashes", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    d = d.select(*counts, F.when(repeats, ranked).alias("ranked"))
    return d.select(*counts, F.coalesce(_covered(F.col("ranked")), F.lit(0)).cast("long").alias("n_repeat_words"))


def _covered(ranked: Column) -> Column:
    """Words inside windows whose hash has an equal neighbour in sorted order."""
    twice = F.filter(ranked, lambda e, j: (F.get(ranked, j - 1)["h"] == e["h"]) | (F.get(ranked, j + 1)["h"] == e["h"]))
    starts = F.sort_array(F.transform(twice, lambda e: e["i"]))
    walk = lambda acc, s: F.struct(s.alias("at"), (acc["n"] + F.least(F.lit(WINDOW), s - acc["at"])).alias("n"))
    return F.aggregate(starts, F.struct(F.lit(-WINDOW).alias("at"), F.lit(0).alias("n")), walk, lambda acc: acc["n"])


def base_failed() -> Column:
    return (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))


def host_rates(counted: DataFrame) -> DataFrame:
    """Per host: documents, failures, and the failure rate shrunk by the beta prior.

    The prior is the beta-binomial fitted by moments: its mean is the corpus
    rate, its strength follows from how much hosts differ beyond chance.
    """
    hosts = counted.groupBy("host").agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("base_failed").cast("long")).alias("k"))
    total = hosts.agg(F.sum("n").alias("n"), F.sum("k").alias("k"), F.count(F.lit(1)).alias("hosts"),
                      F.sum(F.col("k") * F.col("k") / F.col("n")).alias("kk")).first()
    if not total["n"]:
        return hosts.withColumn("rate", F.lit(0.0))
    n, count = total["n"], total["hosts"]
    mean = total["k"] / n
    between = total["kk"] - n * mean * mean          # sum of n (rate - mean)^2
    chance = mean * (1 - mean)
    low, high = RHO_RANGE
    rho = low
    if chance > 0 and n > count:
        rho = min(high, max(low, (between / chance - count) / (n - count)))
    strength = (1 - rho) / rho
    return hosts.withColumn("rate", (F.col("k") + F.lit(mean * strength)) / (F.col("n") + F.lit(strength)))


def quality_rules(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", host: str = "source",
                  host_limit: float = HOST_LIMIT) -> DataFrame:
    """doc_id, host, the counts, base_failed, host_rejected and kept, one row per document."""
    counted = stored(document_counts(docs, doc_id, text, host).withColumn("base_failed", base_failed()), "rules")
    # Only rejected hosts travel to the join; Spark broadcasts them if their measured size allows.
    rejected = host_rates(counted).filter(F.col("rate") >= host_limit).select(
        F.col("host").alias("bad_host"), F.lit(True).alias("bad"))
    out = counted.join(rejected, counted["host"].eqNullSafe(rejected["bad_host"]), "left")
    host_bad = F.coalesce(F.col("bad"), F.lit(False))
    return out.select("doc_id", "host", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                      "base_failed", host_bad.alias("host_rejected"), (~F.col("base_failed") & ~host_bad).alias("kept"))


def op1_quality_rules(spark, sf_dir: str) -> DataFrame:
    out = quality_rules(read_table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


OP1_SQL = rf"""
WITH d AS (
  SELECT row_number() OVER () AS rid, doc_id, source AS host, coalesce(text, '') AS t FROM documents
), w AS (
  SELECT *, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS ws,
         [x FOR x IN string_split(t, chr(10)) IF regexp_matches(x, '[^\x20\x09-\x0D]')] AS ls
  FROM d
), win AS (
  SELECT rid, i, array_to_string(list_slice(ws, i, i + {WINDOW - 1}), ' ') AS g
  FROM (SELECT rid, ws, unnest(generate_series(1, len(ws) - {WINDOW - 1})) AS i FROM w WHERE len(ws) >= {WINDOW})
), twice AS (
  SELECT rid, i FROM (SELECT rid, i, count(*) OVER (PARTITION BY rid, g) AS c FROM win) WHERE c > 1
), rep AS (
  SELECT rid, count(DISTINCT p) AS n_repeat_words
  FROM (SELECT rid, unnest(generate_series(i, i + {WINDOW - 1})) AS p FROM twice) GROUP BY rid
), m AS (
  SELECT w.rid, doc_id, host, len(ws)::BIGINT AS n_words,
         length(regexp_replace(t, '[\x20\x09-\x0D]', '', 'g'))::BIGINT AS word_chars,
         (length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols,
         (len(ls) - len(list_distinct(ls)))::BIGINT AS n_dup_lines,
         coalesce(n_repeat_words, 0)::BIGINT AS n_repeat_words
  FROM w LEFT JOIN rep ON rep.rid = w.rid
), b AS (
  SELECT *, (n_words < {MIN_WORDS} OR 100 * n_repeat_words > {MAX_REPEAT_PERCENT} * n_words) AS base_failed FROM m
), h AS (
  SELECT host, count(*)::DOUBLE AS n, sum(base_failed::INT)::DOUBLE AS k FROM b GROUP BY host
), p AS (
  SELECT sum(n) AS n, count(*) AS c, sum(k) / sum(n) AS mean,
         sum(k * k / n) - sum(n) * (sum(k) / sum(n)) * (sum(k) / sum(n)) AS between_hosts FROM h
), s AS (
  SELECT mean, CASE WHEN mean * (1 - mean) > 0 AND n > c
                    THEN least({RHO_RANGE[1]}, greatest({RHO_RANGE[0]}, (between_hosts / (mean * (1 - mean)) - c) / (n - c)))
                    ELSE {RHO_RANGE[0]} END AS rho FROM p
), bad AS (
  SELECT host FROM h, s WHERE (k + mean * (1 - rho) / rho) / (n + (1 - rho) / rho) >= {HOST_LIMIT}
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       (NOT base_failed AND NOT EXISTS (SELECT 1 FROM bad WHERE bad.host IS NOT DISTINCT FROM b.host)) AS kept
FROM b
"""
