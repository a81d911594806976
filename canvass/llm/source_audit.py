"""How far the sources of a language differ in their words.

Terms are runs of ASCII letters and of characters from U+0080 on, with A to Z
lower-cased; so a term is a run of bytes, and the texts are read as bytes.  A
lot of texts is counted at once: terms of at most 8 bytes become one big-endian
64-bit word, those of at most 16 bytes two (a term holds no zero byte, so the
padding is unambiguous); the words are radix-sorted, 16 bits a pass, and runs of
equal words give the counts.  Longer terms go to buckets of their own, sorted as
bytes.  The lot's texts lie in the order of their groups and the sorts are
stable, so each run of a term holds its groups and documents in order.  The
lots' counts are summed by Spark.

A language keeps the terms found in at least ``min_docs`` of its documents.  All
shares are whole billionths.  Distances of sources are sums over the kept terms:
a task takes the counts of a few thousand terms in two blocks of sources and
sums the differences of every pair of sources in numpy; terms that neither of
the two holds differ by the shares of a count of zero, and are added at the end
as a number of terms.

Defined cases: null texts, languages and sources are empty ones; every row is a
document of its own, repeated or not; a group without terms takes part with
counts of zero; a language without kept terms has distances of 0 and no terms; a
language with one source has no pairs; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import read_table, stored

MIN_DOCS, TOP, SMOOTH, UNIT = 30, 50, 5, 1_000_000_000
#: Bytes and texts counted at once, kept terms in one task of the distances, sources in a block of it.
LOT, LOT_TEXTS, TERMS, SOURCES = 16 << 20, 100_000, 4096, 256

_BYTES = np.arange(256)
_UPPER = (_BYTES >= 0x41) & (_BYTES <= 0x5A)
_IN_TERM = _UPPER | (_BYTES >= 0x61) & (_BYTES <= 0x7A) | (_BYTES >= 0x80)
#: A byte as it stands in a term (lower case), and zero outside of terms.
_LETTER = np.where(_IN_TERM, np.where(_UPPER, _BYTES + 0x20, _BYTES), 0).astype(np.uint8)
#: Keeps the first k bytes of a big-endian word.
_FIRST = np.array([(2**64 - 1) ^ (2 ** (64 - 8 * k) - 1) for k in range(9)], np.uint64)


def radix_order(words: list[np.ndarray]) -> np.ndarray:
    """Stable order of rows of 64-bit words (first word most significant), 16 bits a pass."""
    order = np.arange(len(words[0]))
    for word in reversed(words):
        for shift in (0, 16, 32, 48):
            digit = (word >> np.uint64(shift)).astype(np.uint16)
            if len(digit) and (digit != digit[0]).any():
                order = order[np.argsort(digit[order], kind="stable")]
    return order


def _packed(text: np.ndarray, at: np.ndarray, length: np.ndarray, words: int) -> list[np.ndarray]:
    """Terms as big-endian words; ``text`` ends in at least 16 zero bytes."""
    every = np.ndarray((len(text) - 7,), ">u8", text, strides=(1,))
    return [every[at + 8 * k].astype(np.uint64) & _FIRST[np.clip(length - 8 * k, 0, 8)] for k in range(words)]


def _runs(new: np.ndarray, group: np.ndarray, doc: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First places, lengths and numbers of documents of the (term, group) runs of sorted
    occurrences; ``new`` marks where the term changes."""
    head = new.copy()
    head[1:] |= group[1:] != group[:-1]
    first = np.nonzero(head)[0]
    fresh = new.copy()
    fresh[1:] |= doc[1:] != doc[:-1]
    return first, np.diff(np.append(first, len(new))), np.add.reduceat(fresh.astype(np.int64), first)


def count_lot(texts: list[bytes], groups: list[int]) -> Iterator[tuple[list[bytes], np.ndarray, np.ndarray, np.ndarray]]:
    """Terms, groups, occurrences and numbers of documents of some texts, one item for each length bucket."""
    places = sorted(range(len(texts)), key=groups.__getitem__)
    text = _LETTER[np.frombuffer(b"\0".join([b"", *(texts[k] for k in places), bytes(17)]), np.uint8)]
    ends = np.cumsum([1 + len(texts[k]) for k in places])
    edge = np.nonzero((text[1:] != 0) != (text[:-1] != 0))[0] + 1
    at, length = edge[0::2], edge[1::2] - edge[0::2]
    doc = np.searchsorted(ends, at, "right")
    group = np.array([groups[k] for k in places], np.int64)[doc] if len(at) else doc
    for words, low, high in ((1, 0, 8), (2, 8, 16), (0, 16, np.inf)):
        mine = np.nonzero((length > low) & (length <= high))[0]
        if not len(mine):
            continue
        if words:
            keys = _packed(text, at[mine], length[mine], words)
            order = radix_order(keys)
            new = np.ones(len(order), bool)
            new[1:] = np.logical_or.reduce([k[order][1:] != k[order][:-1] for k in keys])
        else:
            raw = [text[s : s + n].tobytes() for s, n in zip(at[mine].tolist(), length[mine].tolist(), strict=True)]
            order = np.array(sorted(range(len(raw)), key=raw.__getitem__))
            new = np.array([True, *(raw[a] != raw[b] for a, b in zip(order[1:], order[:-1], strict=True))])
        sorted_ = mine[order]
        first, counts, docs = _runs(new, group[sorted_], doc[sorted_])
        heads = sorted_[first]
        yield ([text[s : s + n].tobytes() for s, n in zip(at[heads].tolist(), length[heads].tolist(), strict=True)],
               group[heads], counts, docs)


def _count_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ["lang", "source", "term", "n", "docs"]
    pairs: list[tuple[str, str]] = []
    known: dict[tuple[str, str], int] = {}
    texts: list[bytes] = []
    groups: list[int] = []
    size = 0

    def counted() -> Iterator[pa.RecordBatch]:
        for terms, group, counts, docs in count_lot(texts, groups):
            of = pa.array(group)
            lang, source = (pa.array([p[k] for p in pairs], pa.string()).take(of) for k in (0, 1))
            term = pa.array(terms, pa.binary()).cast(pa.string())
            yield pa.RecordBatch.from_arrays([lang, source, term, pa.array(counts), pa.array(docs)], names)
        texts.clear(), groups.clear(), pairs.clear(), known.clear()

    for b in batches:
        for text, lang, source in zip(b.column(0).cast(pa.binary()), b.column(1).to_pylist(), b.column(2).to_pylist(), strict=True):
            key = (lang, source)
            if key not in known:
                known[key] = len(pairs)
                pairs.append(key)
            raw = text.as_py()
            texts.append(raw)
            groups.append(known[key])
            size += len(raw)
            if size >= LOT or len(texts) >= LOT_TEXTS:
                yield from counted()
                size = 0
    yield from counted()


def group_counts(docs: DataFrame, text: str = "text", lang: str = "lang", source: str = "source") -> DataFrame:
    """``lang, source, term, n, docs``: occurrences of each term in each group, and documents that hold it."""
    empty = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    rows = docs.select(empty(text).alias("text"), empty(lang).alias("lang"), empty(source).alias("source"))
    lots = rows.mapInArrow(_count_batches, "lang string, source string, term string, n long, docs long")
    return lots.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))


def _share(n: Column, total: Column, kept: Column) -> Column:
    """1 + floor(UNIT * (n + 5) / (total + 5 * kept)) in whole numbers, however large the counts."""
    d = lambda c: c.cast("decimal(19,0)")
    over, under = F.lit(UNIT).cast("decimal(10,0)") * d(n + SMOOTH), d(total + SMOOTH * kept)
    return F.lit(1) + F.call_function("div", over, under)


def _pair_sums(key, groups: pd.DataFrame, cells: pd.DataFrame) -> pd.DataFrame:
    """Sums of differences over the terms of one task, for each pair of its sources."""
    lang, _, left, right = key
    names = groups["source"].to_numpy()
    n, zero, block = len(names), groups["zero"].to_numpy(np.int64), groups["block"].to_numpy()
    term, terms = pd.factorize(cells["term"])
    share = np.repeat(zero[:, None], len(terms), axis=1)
    place = {s: k for k, s in enumerate(names)}
    of = np.fromiter((place[s] for s in cells["source"]), np.int64, len(cells))
    share[of, term] = cells["p"].to_numpy(np.int64)
    held = np.zeros(share.shape, bool)
    held[of, term] = True
    left_names, right_names, sums = [], [], []
    for i in range(n):
        # Each pair of sources once: inside one block by place, else from the left to the right block.
        other = np.arange(i + 1, n) if left == right else np.nonzero((block == right) & (block[i] == left))[0]
        either = held[i] | held[other]
        left_names += [names[i]] * len(other)
        right_names += names[other].tolist()
        sums.append(np.stack([(np.abs(share[i] - share[other]) * either).sum(axis=1), either.sum(axis=1), np.abs(zero[i] - zero[other])]))
    apart, seen, apart_zero = np.concatenate(sums, axis=1).astype(np.int64) if sums else np.zeros((3, 0), np.int64)
    text = lambda x: pd.Series(x, dtype=object)
    return pd.DataFrame({"lang": text([lang] * len(apart)), "source": text(left_names), "item": text(right_names), "apart": apart, "seen": seen, "zero": apart_zero})


def source_divergence(docs: DataFrame, min_docs: int = MIN_DOCS, top: int = TOP, text: str = "text", lang: str = "lang",
                      source: str = "source", terms_per_task: int = TERMS, sources_per_block: int = SOURCES) -> DataFrame:
    """``lang, source, part, item, value, rank``: part ``pair`` ranks the other sources of the
    language by distance, part ``term`` a group's ``top`` terms by their excess over the language."""
    empty = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    counts = stored(group_counts(docs, text, lang, source), "audit-counts")
    kept = stored(counts.groupBy("lang", "term").agg(F.sum("n").alias("lang_n"), F.sum("docs").alias("d"))
                  .filter(F.col("d") >= min_docs).select("lang", "term", "lang_n"), "audit-kept")
    cells = counts.select("lang", "source", "term", "n").join(kept, ["lang", "term"])
    totals = cells.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    by_lang = kept.groupBy("lang").agg(F.count(F.lit(1)).alias("kept"), F.sum("lang_n").alias("lang_total"))
    pairs = docs.select(empty(lang).alias("lang"), empty(source).alias("source")).distinct()
    sizes = pairs.groupBy("lang").agg(F.count(F.lit(1)).alias("sources"))
    groups = pairs.join(totals, ["lang", "source"], "left").join(by_lang, "lang", "left").join(sizes, "lang")
    whole = lambda c: F.coalesce(F.col(c), F.lit(0))
    groups = groups.select("lang", "source", whole("total").alias("total"), whole("kept").alias("kept"),
                           whole("lang_total").alias("lang_total"), "sources")
    # Without kept terms no share is ever asked for; 1 keeps the quotient defined.
    safe = F.greatest(F.col("kept"), F.lit(1))
    zero = F.when(F.col("kept") == 0, F.lit(0)).otherwise(_share(F.lit(0), F.col("total"), safe))
    groups = stored(groups.withColumn("zero", zero.cast("long")), "audit-groups")

    shares = cells.join(groups, ["lang", "source"]).select(
        "lang", "source", "term", _share(F.col("n"), F.col("total"), F.col("kept")).cast("long").alias("p"),
        _share(F.col("lang_n"), F.col("lang_total"), F.col("kept")).cast("long").alias("q"), "kept", "sources")
    shares = stored(shares, "audit-shares")

    # Terms of a language by hash into tasks, sources into blocks; a cell meets every block of its language.
    tasks = F.ceil(F.col("kept") / terms_per_task)
    blocks = F.ceil(F.col("sources") / sources_per_block)
    block = F.pmod(F.xxhash64("source"), blocks).cast("int").alias("block")
    others = F.explode(F.sequence(F.lit(0), blocks.cast("int") - 1)).alias("other")
    sides = [F.least("block", "other").alias("left"), F.greatest("block", "other").alias("right")]
    placed = (shares.select("lang", "source", "p", "term",
                            F.pmod(F.xxhash64("term"), tasks).cast("int").alias("task"), block, "sources")
              .select("*", others).select("*", *sides))
    listed = (groups.select("lang", "source", "zero", "sources", block,
                            F.explode(F.sequence(F.lit(0), F.greatest(tasks.cast("int"), F.lit(1)) - 1)).alias("task"))
              .select("*", others).select("*", *sides))
    key = ["lang", "task", "left", "right"]
    sums = listed.select(*key, "source", "zero", "block").groupBy(*key).cogroup(
        placed.select(*key, "source", "p", "term").groupBy(*key)).applyInPandas(
        _pair_sums, "lang string, source string, item string, apart long, seen long, zero long")
    once = (sums.groupBy("lang", "source", "item").agg(F.sum("apart").alias("apart"), F.sum("seen").alias("seen"), F.max("zero").alias("zero"))
            .join(groups.select("lang", "source", "kept"), ["lang", "source"])
            .withColumn("value", F.col("apart") + (F.col("kept") - F.col("seen")) * F.col("zero")))
    both = (once.select("lang", F.explode(F.array(F.struct("source", "item"), F.struct(F.col("item").alias("source"), F.col("source").alias("item")))).alias("e"), "value")
            .select("lang", "e.source", F.lit("pair").alias("part"), "e.item", "value"))
    terms = shares.filter(F.col("p") > F.col("q")).select(
        "lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), (F.col("p") - F.col("q")).alias("value"))
    by_value = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    ranked = terms.withColumn("rank", F.row_number().over(by_value)).filter(F.col("rank") <= top)
    return both.withColumn("rank", F.row_number().over(by_value)).unionByName(ranked)


def op12_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return source_divergence(read_table(spark, sf_dir, "documents"))


OP12_SQL = r"""
with docs as (
  select row_number() over () as d, coalesce(lang, '') as lang, coalesce(source, '') as source,
         regexp_extract_all(coalesce(text, ''), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') as found
  from documents),
hits as (
  select d, lang, source, translate(unnest(found), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as term from docs),
kept as (
  select lang, term, count(*) as lang_n from hits group by lang, term having count(distinct d) >= 30),
langs as (
  select lang, count(*) as v, sum(lang_n)::hugeint as n from kept group by lang),
grps as (select distinct lang, source from docs),
cells as (
  select h.lang, h.source, h.term, count(*) as c from hits h join kept using (lang, term) group by all),
totals as (select lang, source, sum(c)::hugeint as n from cells group by all),
dense as (
  select g.lang, g.source, k.term, coalesce(c.c, 0) as c,
         1 + (1000000000::hugeint * (coalesce(c.c, 0) + 5)) // (coalesce(t.n, 0) + 5 * l.v) as p,
         1 + (1000000000::hugeint * (k.lang_n + 5)) // (l.n + 5 * l.v) as q
  from grps g join kept k using (lang) join langs l using (lang)
  left join totals t on t.lang = g.lang and t.source = g.source
  left join cells c on c.lang = g.lang and c.source = g.source and c.term = k.term),
sums as (
  select a.lang, a.source, b.source as item, sum(abs(a.p - b.p)) as value
  from dense a join dense b on a.lang = b.lang and a.term = b.term and a.source <> b.source group by all),
pair as (
  select a.lang, a.source, 'pair' as part, b.source as item, coalesce(s.value, 0)::bigint as value
  from grps a join grps b on a.lang = b.lang and a.source <> b.source
  left join sums s on s.lang = a.lang and s.source = a.source and s.item = b.source),
term as (
  select lang, source, 'term' as part, term as item, (p - q)::bigint as value from dense where c > 0 and p > q),
ranked as (
  select *, row_number() over (partition by lang, source, part order by value desc, item)::integer as rank
  from (select * from pair union all select * from term))
select lang, source, part, item, value, rank from ranked where part = 'pair' or rank <= 50
"""
