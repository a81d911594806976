"""SimHash near-duplicates: fingerprints, a binary trie self-join, components.

A text is lower-cased (A-Z), split into words, and its word shingles are hashed
with XXH64 (seed 42); a fingerprint bit is set if it is set in over half of the
hashes.  Documents with equal fingerprints are collapsed first.  The distinct
fingerprints form a binary trie, of which Spark holds the nodes of every fourth
level with their sizes.  The self-join walks pairs of nodes of one level
together, adds up the bits in which their paths differ, drops a pair whose sum
is over the budget, and descends only while a node of the pair holds more than
``leaf`` fingerprints, so a crowded part of the trie is split further and no
task meets more than ``leaf`` times ``leaf`` of them at once.  Inside a pair of
leaves numpy does the rest of the walk and hands on a spanning forest of the
links it found, which keeps every component whole.  A fingerprint or a
component with very many rows is salted where it is joined.

Defined cases: null and empty texts, and texts of white space only, have the
fingerprint zero and are linked like any other; repeated rows come back once
each; a null doc_id is kept and never names a component unless it has no other
(then the name is null); an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from canvass.operators.skew import join_per_key

from .common import ROW_KEY, read_table, row_key, stored, text_batches
from .graph import HOT_ROWS, components

SHINGLE = 3
MAX_BITS = 2
#: Levels of the trie that are materialised lie this many bits apart.
STEP = 4
#: A pair of nodes with at most this many fingerprints on either side is compared in a task.
LEAF = 256
#: Shingle hashes that are unpacked into bits at a time.
CHUNK = 8192


def fingerprint(text: bytes | None, shingle: int = SHINGLE) -> int:
    """The fingerprint of one text in UTF-8, as a signed 64-bit integer."""
    words = (text or b"").lower().split()  # bytes: A-Z only, and exactly the separators U+0020, U+0009 to U+000D
    if not words:
        return 0
    if len(words) < shingle:
        hashes = np.array([xxhash.xxh64_intdigest(b" ".join(words), 42)], np.uint64)
    else:
        grams = map(b" ".join, zip(*(words[k:] for k in range(shingle)), strict=False))
        hashes = np.fromiter(map(xxhash.xxh64_intdigest, grams, repeat(42)), np.uint64)
    ones = np.zeros(64, np.int64)
    for at in range(0, len(hashes), CHUNK):
        part = hashes[at : at + CHUNK].astype(">u8").view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1).sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(hashes)).view(">i8")[0])


def fingerprints(docs: DataFrame, shingle: int = SHINGLE, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, th, fp``: id, hash of the text and fingerprint (a long), one row per document."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            fps = np.fromiter((fingerprint(t, shingle) for t in b["text"]), np.int64, len(b))
            yield pd.DataFrame({"doc_id": b["doc_id"], "th": b["th"], "fp": fps})

    # doc_id goes through Python as text, so that nulls and large ids stay exact.
    named = text_batches(docs).select(F.col(doc_id).cast("string").alias("doc_id"), F.xxhash64(text).alias("th"), F.col(text).cast("binary").alias("text"))
    out = named.mapInPandas(run, "doc_id string, th long, fp long")
    return out.select(F.col("doc_id").cast("long"), "th", "fp")


def _path(fp, depth):
    """The first ``depth`` bits of a fingerprint."""
    return F.shiftrightunsigned(fp, 64 - depth)


def trie_nodes(fps: DataFrame) -> DataFrame:
    """``depth, path, n``: the nodes of every fourth level with the fingerprints below each."""
    depths = F.array(*[F.struct(F.lit(d).alias("depth"), _path(F.col("fp"), d).alias("path")) for d in range(STEP, 65, STEP)])
    return fps.select(F.inline(depths)).groupBy("depth", "path").agg(F.count(F.lit(1)).alias("n"))


def leaf_pairs(nodes: DataFrame, max_bits: int = MAX_BITS, leaf: int = LEAF) -> DataFrame:
    """``depth, a, b``: the node pairs, a <= b, that the descent ends at.

    The number of rounds is the depth of the deepest crowded node, one number
    that is read before the walk starts.
    """
    deepest = nodes.filter(F.col("n") > leaf).agg(F.max("depth")).first()[0] or 0
    done = []
    level = lambda d, side: nodes.filter(F.col("depth") == d).select(
        F.col("path").alias(side), F.col("n").alias(f"n{side}"), F.shiftrightunsigned("path", STEP).alias(f"up{side}"))
    # Root pair: all children of the root against each other (16 nodes at most).
    top, other = level(STEP, "a"), level(STEP, "b")
    pairs = top.join(other, top["upa"] == other["upb"])
    pairs = _near(pairs.filter("a <= b").withColumn("bits", F.bit_count(F.col("a").bitwiseXOR(F.col("b")))), max_bits)
    depth = STEP
    while True:
        if depth > STEP:
            pairs = stored(pairs, "pairs")
        crowded = (F.greatest("na", "nb") > leaf) if depth < 64 else F.lit(False)
        done.append(pairs.filter(~crowded).select(F.lit(depth).alias("depth"), "a", "b"))
        if depth > deepest or depth == 64:
            break
        depth += STEP
        open_pairs = pairs.filter(crowded).select(F.col("a").alias("pa"), F.col("b").alias("pb"), F.col("bits").alias("above"))
        one = open_pairs.join(level(depth, "a"), F.col("pa") == F.col("upa"))
        # Only children of b that can still be within budget of the child of a meet it.
        two = one.join(level(depth, "b"), (F.col("pb") == F.col("upb"))
                       & (F.col("above") + F.bit_count((F.col("a").bitwiseXOR(F.col("b"))).bitwiseAND(2**STEP - 1)) <= max_bits)
                       & ((F.col("pa") < F.col("pb")) | (F.col("a") <= F.col("b"))))
        pairs = two.withColumn("bits", F.col("above") + F.bit_count((F.col("a").bitwiseXOR(F.col("b"))).bitwiseAND(2**STEP - 1)))
        pairs = pairs.select("a", "b", "na", "nb", "bits")
    out = done[0]
    for d in done[1:]:
        out = out.unionByName(d)
    return out


def _near(pairs: DataFrame, max_bits: int) -> DataFrame:
    return pairs.filter(F.col("bits") <= max_bits).select("a", "b", "na", "nb", "bits")


def _forest(left: np.ndarray, right: np.ndarray, max_bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Links between two leaves, cut down to a spanning forest of their components."""
    i, j = np.nonzero(np.bitwise_count(left[:, None] ^ right[None, :]) <= max_bits)
    x, y = left[i], right[j]
    keep = x != y
    x, y = x[keep], y[keep]
    if not len(x):
        return x, y
    ends, where = np.unique(np.concatenate([x, y]), return_inverse=True)
    a, b = where[: len(x)], where[len(x):]
    label = np.arange(len(ends))
    while True:
        new = label.copy()
        np.minimum.at(new, a, label[b])
        np.minimum.at(new, b, label[a])
        new = new[new]
        if (new == label).all():
            break
        label = new
    moved = label != np.arange(len(ends))
    return ends[moved], ends[label[moved]]


def links(fps: DataFrame, max_bits: int = MAX_BITS, leaf: int = LEAF) -> DataFrame:
    """``a, b``: links of distinct fingerprints whose components are those of all
    pairs within ``max_bits``."""
    nodes = stored(trie_nodes(fps), "nodes")
    pairs = stored(leaf_pairs(nodes, max_bits, leaf), "leafpairs")
    ends = pairs.select("depth", F.col("a").alias("path")).unionByName(pairs.select("depth", F.col("b").alias("path"))).distinct()
    depths = F.array(*[F.struct(F.lit(d).alias("depth"), _path(F.col("fp"), d).alias("path")) for d in range(STEP, 65, STEP)])
    below = fps.select("fp", F.inline(depths)).join(ends, ["depth", "path"], "left_semi")
    # A leaf holds at most `leaf` fingerprints, so a list of them is small.
    members = stored(below.groupBy("depth", "path").agg(F.sort_array(F.collect_list("fp")).alias("fps")), "members")
    left = members.select("depth", F.col("path").alias("a"), F.col("fps").alias("left"))
    right = members.select("depth", F.col("path").alias("b"), F.col("fps").alias("right"))
    met = pairs.join(left, ["depth", "a"]).join(right, ["depth", "b"]).select("left", "right")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            found = [_forest(np.asarray(x, np.int64), np.asarray(y, np.int64), max_bits) for x, y in zip(b["left"], b["right"], strict=True)]
            yield pd.DataFrame({"a": np.concatenate([f[0] for f in found]), "b": np.concatenate([f[1] for f in found])}) if found \
                else pd.DataFrame({"a": np.empty(0, np.int64), "b": np.empty(0, np.int64)})

    return met.mapInPandas(run, "a long, b long")


def near_duplicate_groups(docs: DataFrame, shingle: int = SHINGLE, max_bits: int = MAX_BITS, leaf: int = LEAF,
                          doc_id: str = "doc_id", text: str = "text", hot_rows: int = HOT_ROWS) -> DataFrame:
    """``doc_id, th, fp, label, component_id`` per document; label is the component's smallest fingerprint."""
    prints = stored(fingerprints(docs, shingle, doc_id, text), "prints")
    fps = stored(prints.groupBy("fp").agg(F.min("doc_id").alias("first"), F.count(F.lit(1)).alias("copies")), "fps")
    # Fingerprints without a link are their own component and stay out of the walk over labels.
    labels = components(links(fps.select("fp"), max_bits, leaf), hot_rows=hot_rows)
    named = fps.join(labels, fps["fp"] == labels["node"], "left").select("fp", "first", "copies", F.coalesce("label", "fp").alias("label"))
    named = stored(named, "named")
    heads = stored(named.groupBy("label").agg(F.min("first").alias("component_id"), F.count(F.lit(1)).alias("n")), "heads")
    by_fp = join_per_key(named, heads, "label", rows_per_key="n", hot_rows=hot_rows, salt_by=["fp"], how="inner")
    by_fp = stored(by_fp.select("fp", "copies", "label", "component_id"), "byfp")
    out = join_per_key(prints, by_fp, "fp", rows_per_key="copies", hot_rows=hot_rows, salt_by=["doc_id", "th"], how="inner")
    return out.select("doc_id", "th", "fp", "label", "component_id")


def simhash_near_dedup(docs: DataFrame, shingle: int = SHINGLE, max_bits: int = MAX_BITS, leaf: int = LEAF,
                       doc_id: str = "doc_id", text: str = "text", hot_rows: int = HOT_ROWS) -> DataFrame:
    """``doc_id, fingerprint, component_id``, one row per document."""
    out = near_duplicate_groups(docs, shingle, max_bits, leaf, doc_id, text, hot_rows)
    return out.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def drop_near_duplicates(docs: DataFrame, shingle: int = SHINGLE, max_bits: int = MAX_BITS, leaf: int = LEAF,
                         doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` (all columns) with one document of each component: the smallest id, null last."""
    groups = near_duplicate_groups(docs, shingle, max_bits, leaf, doc_id, text)
    first = F.row_number().over(Window.partitionBy("label").orderBy(F.col("doc_id").asc_nulls_last(), "th"))
    keep = stored(groups.withColumn("r", first).filter("r = 1").select(*row_key("doc_id", F.col("th"))), "keep")
    rows = docs.select("*", *row_key(doc_id, F.xxhash64(text)))
    # Rows that repeat both id and text are one document; the window needs no other shuffle than the join's.
    once = F.row_number().over(Window.partitionBy(*ROW_KEY).orderBy(F.lit(0)))
    return rows.join(keep, ROW_KEY, "left_semi").withColumn("__once", once).filter(F.col("__once") == 1).select(*docs.columns)


def op10_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_near_dedup(read_table(spark, sf_dir, "documents"))
