"""Source divergence, BPE chunks and hard negatives on small tables with odd rows."""

from __future__ import annotations

import hashlib
import math
import random
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from canvass.llm import bpe_codec as B
from canvass.llm import hard_negatives as N
from canvass.llm import source_audit as A
from tests.conftest import SF_MID

BPE = public_tokenizers.path(B.VOCABULARY)


# -- source divergence ---------------------------------------------------------------
def plain_terms(text):
    out, now = [], ""
    for c in (text or "") + " ":
        if c.isascii() and not c.isalpha():
            out += [now] if now else []
            now = ""
        else:
            now += chr(ord(c) + 32) if "A" <= c <= "Z" else c
    return out


def plain_divergence(rows, min_docs, top):
    """Rows (text, lang, source) -> the operator's rows, from dense tables."""
    rows = [(t, g or "", s or "") for t, g, s in rows]
    out = []
    for lang in {g for _, g, _ in rows}:
        mine = [(Counter(plain_terms(t)), s) for t, g, s in rows if g == lang]
        spread = Counter(w for c, _ in mine for w in c)
        kept = sorted(w for w, n in spread.items() if n >= min_docs)
        share = lambda n, total: 1 + 10**9 * (n + 5) // (total + 5 * len(kept))
        counts = {s: Counter() for _, s in mine}
        for c, s in mine:
            counts[s].update({w: n for w, n in c.items() if w in kept})
        total = {s: sum(c.values()) for s, c in counts.items()}
        all_ = sum(counts.values(), Counter())
        p = {s: {w: share(counts[s][w], total[s]) for w in kept} for s in counts}
        q = {w: share(all_[w], sum(all_.values())) for w in kept}
        for s in counts:
            pair = [(o, sum(abs(p[s][w] - p[o][w]) for w in kept)) for o in counts if o != s]
            term = [(w, p[s][w] - q[w]) for w in kept if counts[s][w] and p[s][w] > q[w]]
            for part, items, most in (("pair", pair, len(pair)), ("term", term, top)):
                items.sort(key=lambda x: (-x[1], x[0].encode()))
                out += [(lang, s, part, i, v, k) for k, (i, v) in enumerate(items[:most], 1)]
    return sorted(out)


def audit_rows():
    rng = random.Random(4)
    words = ["a", "Ab", "eightchr", "ninechars", "sixteencharacter", "seventeencharact", "seventeencharactX", "é", "日本語", "Straße", "ÉCOLE", "x" * 40, "x" * 41, "mid'dle", "ﬁ"]
    rows = [(" ".join(rng.choices(words, k=rng.choice([0, 1, 8, 30]))), rng.choice(["en", "de", None]), rng.choice(["s1", "s2", "s3", None, "é"])) for _ in range(150)]
    rows += [(None, "en", "empty"), ("", "fr", "lonely"), ("1 2 3", "fr", "other"), (None, None, None), rows[0], rows[0]]
    rows += [("a b\0c\x7f" + "long " * 5000, "en", "s1"), ("One word", "it", "single")]
    return rows


@pytest.mark.parametrize("terms, sources", [(4096, 256), (3, 2)])
def test_divergence_equals_dense_tables(spark, terms, sources):
    rows = audit_rows()
    docs = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "doc_id long, text string, lang string, source string")
    docs = docs.select("*", *[F.lit(-1).alias(c) for c in ("term", "n", "docs", "kept", "value", "rank", "part", "item", "block", "p", "q")])
    got = A.source_divergence(docs.repartition(3), min_docs=5, top=4, terms_per_task=terms, sources_per_block=sources).collect()
    assert sorted(map(tuple, got)) == plain_divergence(rows, 5, 4)


def test_divergence_in_small_lots(spark, monkeypatch):
    rows = audit_rows()
    for lot in (1, 300, 1 << 20):
        monkeypatch.setattr(A, "LOT", lot)
        lots, groups = Counter(), Counter()
        import pyarrow as pa
        batch = pa.RecordBatch.from_arrays([pa.array([r[k] or "" for r in rows]) for k in range(3)], ["text", "lang", "source"])
        for b in A._count_batches(iter([batch, batch.slice(0, 0)])):
            for lang, source, term, n, docs in zip(*(c.to_pylist() for c in b.columns), strict=True):
                lots[lang, source, term] += n
                groups[lang, source, term] += docs
        want, spread = Counter(), Counter()
        for t, g, s in rows:
            for w, n in Counter(plain_terms(t)).items():
                want[g or "", s or "", w] += n
                spread[g or "", s or "", w] += 1
        assert lots == want and groups == spread


def test_radix_order_is_stable():
    rng = np.random.default_rng(0)
    keys = [rng.integers(0, 3, 500).astype(np.uint64) << np.uint64(40), rng.integers(0, 2**63, 500).astype(np.uint64)]
    keys[1][::2] = keys[1][0]
    want = sorted(range(500), key=lambda i: (int(keys[0][i]), int(keys[1][i]), i))
    assert A.radix_order(keys).tolist() == want
    assert A.radix_order([np.empty(0, np.uint64)]).tolist() == []


def test_shares_stay_exact_for_huge_counts(spark):
    n, total, kept = 9 * 10**17, 10**18, 7
    got = spark.range(1).select(A._share(F.lit(n), F.lit(total), F.lit(kept)).cast("long").alias("p")).first()["p"]
    assert got == 1 + 10**9 * (n + 5) // (total + 5 * kept)


def test_divergence_of_an_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string, lang string, source string")
    assert A.source_divergence(docs).count() == 0


# -- BPE -----------------------------------------------------------------------------
PARTS = ["a", "b", "the", " ", "  ", "\n", "\n\n", "'s", "'re", "'", "1", "23", ".", "..", "é", "ß", "中", "文", "<|endoftext|>", "<|endof", "text|>",
         "᠎", "́", "\r\n", "\t", "Ж", "x y z ", "of the ", "\x00", "\x1f", "​", "ﬀ", " ", "\u0085"]


@pytest.mark.parametrize("odd", ["", "😀"])
def test_chunks_give_the_librarys_ids(monkeypatch, odd):
    monkeypatch.setattr(B, "CUT_BITS", 4)
    rng, lib = random.Random(7), Tokenizer.from_file(BPE)
    texts = ["".join(rng.choices(PARTS + [odd], k=rng.choice([0, 1, 3, 10, 200, 2000]))) for _ in range(1200)]
    texts += [" ".join(rng.choices(["word", "other", "and", "some"], k=3000)), "x" * 50_000, " " * 50_000, "no blanks" * 9, texts[5], texts[5]]
    codec = B.ChunkCodec(BPE)
    assert codec.fast is not None and codec.ascii_plain
    got = [x for lot in B._lots(iter(texts)) for x in codec.encode_lot(lot)]
    want = [e.ids for e in lib.encode_batch(texts, add_special_tokens=False)]
    assert [np.frombuffer(x, "<u4").tolist() for x in got] == want
    assert [codec.decode(x).decode() for x in got] == [lib.decode(ids, skip_special_tokens=False) for ids in want]


def test_shared_chunks_are_encoded_once_and_the_memo_is_bounded(monkeypatch):
    monkeypatch.setattr(B, "CUT_BITS", 7)
    rng = random.Random(1)
    shared = " ".join(f"w{rng.randrange(900)}" for _ in range(4000))
    texts = [f"Document {k} begins. {shared} And ends {k}." for k in range(6)]
    codec = B.ChunkCodec(BPE)
    lib = Tokenizer.from_file(BPE)
    assert [np.frombuffer(x, "<u4").tolist() for x in codec.encode_lot(texts)] == [lib.encode(t).ids for t in texts]
    chunks = len(codec.memo.young)
    assert codec.memo.hits > 4.5 * (chunks - 12) > 100
    small = B.ChunkCodec(BPE, memo_bytes=20_000)
    assert [np.frombuffer(x, "<u4").tolist() for x in small.encode_lot(texts)] == [lib.encode(t).ids for t in texts]
    assert sum(len(k) + len(v) for m in (small.memo.young, small.memo.old) for k, v in m.items()) < 60_000


def test_part_of_a_character_decodes_as_the_library_has_it():
    codec, lib = B.ChunkCodec(BPE), Tokenizer.from_file(BPE)
    ids = lib.encode("中😀").ids[:-1]
    assert codec.decode(np.array(ids, "<u4").tobytes()).decode() == lib.decode(ids, skip_special_tokens=False)


def test_bpe_query_equals_the_library(spark):
    lib = Tokenizer.from_file(BPE)
    docs = spark.read.parquet(f"{SF_MID}/documents.parquet").select("doc_id", "text").collect()
    want = set()
    for d in docs:
        ids = lib.encode(d.text or "", add_special_tokens=False).ids
        back = lib.decode(ids, skip_special_tokens=False)
        want.add((d.doc_id, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256(back.encode()).hexdigest()))
    got = B.op13_bpe_codec(spark, SF_MID).collect()
    assert len(got) == len(docs) and set(map(tuple, got)) == want


def test_bpe_odd_tables(spark):
    rows = [(1, None), (None, "a b"), (2, ""), (2, ""), (3, "hi <|endoftext|> there")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").select("*", F.lit("x").alias("n_tokens"), F.lit("y").alias("token_ids"))
    got = sorted(((r.doc_id or -1, list(r.token_ids), r.n_tokens) for r in B.encoded(docs, BPE).collect()))
    assert got == [(-1, [64, 275], 2), (1, [], 0), (2, [], 0), (2, [], 0), (3, [5303, 220, 50256, 612], 4)]
    assert B.encoding_digest(docs.limit(0), BPE).count() == 0
    none = hashlib.sha256(b"").hexdigest()
    assert {(r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in B.encoding_digest(docs, BPE).filter("doc_id < 3").collect()} == {(0, none, none)}


# -- hard negatives ------------------------------------------------------------------
def plain_negatives(rows, every, k=5, m=5, low=80, high=100):
    """Rows (id, label, vector) -> the operator's rows by comparing all."""
    fine = [(i, g, tuple(math.floor(256 * x) for x in v)) for i, g, v in rows
            if i is not None and g is not None and v and all(x is not None and math.isfinite(x) for x in v)]
    dims = Counter(len(v) for _, _, v in set(fine))
    dim = max(dims, key=lambda d: (dims[d], d))
    fine = sorted({r for r in fine if len(r[2]) == dim})
    out = []
    for a in fine:
        if a[0] % every:
            continue
        scored = sorted(((-sum(x * y for x, y in zip(a[2], r[2], strict=True)), r[0], r[1]) for r in fine if r != a))
        for ps, pid, _ in [s for s in scored if s[2] == a[1]][:k]:
            near = [s for s in scored if s[2] != a[1] and low * -ps <= 100 * -s[0] <= high * -ps][:m]
            out += [(a[0], pid, n, nid, -ps, -ns) for n, (ns, nid, _) in enumerate(near, 1)]
    return sorted(out)


@pytest.mark.parametrize("dim, shard_rows, codes, lane", [(8, 65_536, None, 10**6), (8, 40, 4, 10), (1, 30, 3, 7), (5, 1, 6, 10**6)])
def test_negatives_equal_brute_force(spark, dim, shard_rows, codes, lane):
    rng = np.random.default_rng(dim)
    centres = rng.normal(size=(6, dim))
    rows = [(i, int(rng.integers(0, 4)), [float(x) for x in centres[i % 6] + 0.3 * rng.normal(size=dim)]) for i in range(300)]
    rows += [(1000 + i, 9, rows[7][2]) for i in range(120)]  # one vector many times: ties by id
    rows += [(2000, 5, [0.0] * dim), (2010, 5, [0.0] * dim), (2020, 6, [0.0] * dim), (2030, 77, [1.0] * dim)]  # zero scores; a label of one row
    rows += [(2040, None, [1.0] * dim), (2050, 1, None), (2060, 1, []), (2070, 1, [float("nan")] * dim), (2080, 1, [math.inf] * dim),
             (2090, 1, [None] * dim), (None, 1, [1.0] * dim), (2100, 1, [1.0] * (dim + 1)), rows[20], rows[20], (2110, 2, [-0.001] * dim)]
    table = spark.createDataFrame(rows, "vec_id long, label int, embedding array<double>").repartition(5)
    table = table.select("*", *[F.lit(-1).alias(c) for c in ("key", "v", "x", "i", "shard", "rank", "anchor_id", "id")])
    got = N.hard_negatives(table, F.col("vec_id") % 10 == 0, shard_rows=shard_rows, codes=codes, lane=lane).collect()
    assert sorted(map(tuple, got)) == plain_negatives(rows, 10)


def test_different_rows_of_one_id_are_rows_of_their_own(spark):
    rows = [(0, 1, [1.0, 0.0]), (0, 1, [0.5, 0.5]), (0, 2, [0.9, 0.1]), (3, 1, [0.7, 0.7]), (4, 2, [0.6, 0.6]), (4, 2, [0.6, 0.6])]
    table = spark.createDataFrame(rows, "vec_id long, label int, embedding array<double>")
    got = N.hard_negatives(table, F.col("vec_id") == 0).collect()
    assert sorted(map(tuple, got)) == plain_negatives(rows, 10**9)


def test_negatives_stop_early_on_clustered_vectors(spark, monkeypatch):
    rng = np.random.default_rng(5)
    centres = 10 * rng.normal(size=(12, 8))
    x = np.floor(np.repeat(centres, 50, axis=0) + 0.01 * rng.normal(size=(600, 8)))
    index = N.MultiIndex([N.codebook(x[:, :4], 12, 1), N.codebook(x[:, 4:], 12, 2)], 8, "<i2", False)
    codes = [N.nearest_code(h, c) for h, c in zip(index.halves(x), index.centres, strict=True)]
    radii = [np.array([d[c == k].max() if (c == k).any() else 0.0 for k in range(12)]) for c, d in codes]
    import pandas as pd
    frame = pd.DataFrame({"id": range(600), "key": range(600), "label": 0, "x": [r.astype("<i2").tobytes() for r in x], "i": codes[0][0], "j": codes[1][0]})
    index.pack(radii, {k: len(v) for k, v in frame.groupby(["i", "j"]).groups.items()}, 10**6)
    shard = N.Shard(index, frame)
    seen = []
    monkeypatch.setattr(N, "WAVE", 1)
    offer = N.Top.offer
    monkeypatch.setattr(N.Top, "offer", lambda self, at, s: (seen.append(len(at)), offer(self, at, s)))
    upper, lower = index.bounds(x[:1])
    top = N.Top(shard, np.arange(600) > 0, 5)
    shard.search(x[0], [u[0] for u in upper], [w[0] for w in lower], [top])
    assert sorted(top.score.tolist()) == sorted((x[1:] @ x[0]).tolist())[-5:] and sum(seen) < 300


def test_negatives_odd_tables(spark):
    schema = "vec_id long, label int, embedding array<float>"
    assert N.hard_negatives(spark.createDataFrame([], schema), F.col("vec_id") == 0).count() == 0
    assert N.hard_negatives(spark.createDataFrame([(0, 1, [1.0])], schema), F.col("vec_id") == 0).count() == 0
    with pytest.raises(ValueError, match="too large"):
        N.hard_negatives(spark.createDataFrame([(0, 1, [1e30])], schema), F.col("vec_id") == 0)
