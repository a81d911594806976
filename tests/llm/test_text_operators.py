"""Rules, line dedup, codec, token counts, chat format and classifier on small tables."""

from __future__ import annotations

import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
import xxhash
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from canvass.llm import chat_format as C
from canvass.llm import line_dedup as L
from canvass.llm import quality_classifier as Q
from canvass.llm import quality_rules as R
from canvass.llm import sentencepiece_codec as S
from canvass.llm import token_counts as T

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
#: Extra columns whose names the operators use inside.
CLASH = ["words", "lines", "th", "h", "n", "site", "pos", "label", "fp", "size", "copies", "score", "ids"]


def documents(spark, rows):
    return spark.createDataFrame([(i, t, "en", s, len(t or "")) for i, t, s in rows], DOCS)


def clashing(df):
    return df.select("*", *[F.lit(-1).alias(c) for c in CLASH])


def plain_counts(text):
    words = "".join(c if c not in "\t\n\x0b\x0c\r" else " " for c in text or "").split(" ")
    words = [w for w in words if w]
    grams = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    hit = {p for i, g in enumerate(grams) if grams.count(g) > 1 for p in range(i, i + 5)}
    lines = [x for x in (text or "").split("\n") if x.strip(" \t\n\x0b\x0c\r")]
    return (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text or ""), len(lines) - len(set(lines)), len(hit))


TEXTS = [None, "", " \n\t ", "one", "a b c d e", "a b c d e a b c d e", "x x x x x x x x x x x x", "é x # | <b>\nl\nl\n \n \nl",
         " ".join(f"w{i}" for i in range(40)), "q r s t u v " * 7 + "end", " ".join("long" + str(i % 997) for i in range(20000))]


def test_rules_equal_plain_counts(spark):
    docs = clashing(documents(spark, [(i, t, "s") for i, t in enumerate(TEXTS)] + [(3, "one", None)]))
    got = R.quality_rules(docs).collect()
    assert len(got) == len(TEXTS) + 1
    for r in got:
        if r.doc_id == len(TEXTS) - 1:
            continue  # the long text: too slow for the plain count
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == plain_counts(TEXTS[r.doc_id])
        assert r.base_failed == (r.n_words < 10 or 100 * r.n_repeat_words > 20 * r.n_words)
        assert not (r.base_failed and r.kept)
    assert R.quality_rules(docs.limit(0)).count() == 0


def test_rules_reject_a_bad_host_only(spark):
    good = " ".join(f"w{i}" for i in range(30))
    rows = [(i, good, "good") for i in range(200)] + [(1000 + i, good if i % 10 == 0 else "short", "bad") for i in range(200)]
    got = {r.doc_id: r for r in R.quality_rules(documents(spark, rows)).collect()}
    assert got[0].kept and not got[1000].base_failed and not got[1000].kept


def test_rules_do_not_condemn_a_host_for_one_document(spark):
    good = " ".join(f"w{i}" for i in range(30))
    rows = [(i, "short" if i % 20 == 0 else good, f"host{i // 100}") for i in range(2000)] + [(5000, "short", "tiny"), (5001, good, "tiny")]
    got = {r.doc_id: r for r in R.quality_rules(documents(spark, rows)).collect()}
    assert not got[5000].kept and got[5001].kept and not got[5000].host_rejected


def test_line_hashes_are_of_the_text_from_two_seeds(spark):
    line = "one line of words"
    row = L.line_rows(documents(spark, [(1, line, "s")]), "doc_id", "text", "source", 3).first()
    signed = lambda data, seed: int(np.uint64(xxhash.xxh64_intdigest(data, seed % 2**64)).astype(np.int64))
    one = (1).to_bytes(4, "little")
    assert row.h1 == signed(line, 42) and row.h2 == signed(line, signed(one, 42))
    assert row.h2 != signed(one, row.h1)  # a function of the first hash tells nothing more


def test_line_dedup_equals_exact_counts(spark):
    random.seed(5)
    lines = [f"this is the common line number {i} indeed" for i in range(14)]
    rows = []
    for i in range(400):
        pick = [x for k, x in enumerate(lines) if random.random() < (k + 1) / 15]
        rows.append((i, "\n".join([f"own words of {i} here", *pick, "", "ok"]), f"s{random.randrange(2 + i % 14)}" if i % 17 else None))
    rows += [(7, rows[7][1], rows[7][2]), (500, None, "s1"), (501, "", "s1"), (None, "\n".join(lines), "s2")]
    docs = clashing(documents(spark, rows))
    sites, keeper = {}, {}
    for i, t, s in rows:
        for x in (t or "").split("\n"):
            if len(x.split()) >= L.MIN_WORDS:
                sites.setdefault(x, set()).add(s)
                if i is not None:
                    keeper[x] = min(i, keeper.get(x, i))
    bad = {x for x, v in sites.items() if len(v) >= L.MIN_SITES}
    assert bad and len(bad) < len(sites)
    want = sorted((i is None, i or 0, None if t is None else "\n".join(x for x in t.split("\n") if x not in bad or keeper[x] == i)) for i, t, _ in rows if t is not None)
    out = L.line_dedup(docs)
    assert out.columns == docs.columns
    got = sorted((r.doc_id is None, r.doc_id or 0, r.text) for r in out.collect() if r.text is not None)
    assert got == want and out.filter("text is null").count() == 1
    assert L.line_dedup(docs.limit(0)).count() == 0


@pytest.fixture(scope="module")
def piece_model():
    return public_tokenizers.path(S.MODEL)


ODD = ["a", "b", " ", "  ", "\n", "\t", "é", S.MARK, "the ", "ing", "\U0001f600", "​", "ﬁ", "<0x41>", "<s>", "</s>", "<unk>", "中",
       "\x00", "1", "　", "é", "xx" * 40, "'re", "'s", "<|endoftext|>", "\x1c", "\x85", "½", "ⅷ", "|", "===="]


def odd_texts(seed, n, longest=14):
    rng = random.Random(seed)
    return ["".join(rng.choice(ODD) for _ in range(rng.randint(0, longest))) for _ in range(n)]


def test_codec_equals_the_library(spark, piece_model):
    lib = sentencepiece.SentencePieceProcessor(model_file=piece_model)
    texts = odd_texts(1, 3000) + ["nospace" * 400, "the cat " * 3000]
    c = S.PieceCodec(piece_model)
    assert [i for i, _ in c.encode_many(texts)] == lib.encode(texts)
    assert [c.merge(p) for p in list(c.memo)[:500]] == c.merge_many(list(c.memo)[:500])
    rows = [*enumerate(texts[-300:]), (900, None), (901, ""), (0, texts[-300])]
    docs = clashing(documents(spark, [(i, t, "s") for i, t in rows]))
    got = sorted(map(tuple, S.encoding_digest(docs, piece_model).collect()))
    sha = lambda x: hashlib.sha256(x.encode()).hexdigest()
    want = sorted((i, len(e), sha(",".join(map(str, e))), sha(lib.decode(e))) for i, e in ((i, lib.encode(t or "")) for i, t in rows))
    assert got == want
    out = S.encode_documents(docs, piece_model)
    assert out.columns == [*docs.columns, "token_ids", "n_tokens", "decodes_back"]
    assert {r.doc_id: r.token_ids for r in out.collect()}[5] == lib.encode(rows[5][1])
    again = S.encode_documents(out.withColumn("N_tokens", F.lit(-1)), piece_model)
    assert again.columns == out.columns and {r.doc_id: r.n_tokens for r in again.collect()}[900] == 0
    c.rank = {p: -r for p, r in c.rank.items()}  # a broken agenda is not passed over
    c.memo.clear()
    with pytest.raises(RuntimeError, match="differ"):
        list(c.encode_many(["the whole sentence " + "nospace" * 900]))
    assert S.encoding_digest(docs.limit(0), piece_model).count() == 0


def test_token_counts_equal_the_library(spark):
    path = public_tokenizers.path(T.VOCABULARY)
    lib = Tokenizer.from_file(path)
    size = lambda t: len(lib.encode(t, add_special_tokens=False).ids)
    texts = odd_texts(2, 2000) + ["word " * 3000, "x" * 5000, " " * 700]
    c = T.PrefixCounter(path)
    assert [T.PrefixTable(c, t).total() for t in texts] == [size(t) for t in texts]
    for p in [p for p in c.memo if len(p) > 3][:300]:  # every prefix of a piece
        for k in range(1, len(p) + 1):
            if [p[:k]] == c.split(p[:k]):
                assert c.memo[p][len(p[:k].encode()) - 1] == size(p[:k])
    more = [*odd_texts(12, 400), "the\n\n12", " \n  \n\na 12", "a  \n\n\n b\u3000\u3000 c", "!<|endoftext|> \n <|endoftext|>x", "it's we're I'll  'd \n's", "\x1c\x1c \x85\x85 ½"]
    for x in more:  # every prefix, as a text of its own
        t = T.PrefixTable(c, x)
        sizes = [size(x[:k]) for k in range(len(x) + 1)]
        ends = [len(x[:k].encode()) for k in range(len(x) + 1)]
        assert [t.at(n) for n in ends] == sizes, x
        for budget in range(0, max(sizes) + 1):
            assert t.cut(budget) == max(n for n, s in zip(ends, sizes, strict=True) if s <= budget), (x, budget)
    t = T.PrefixTable(c, "some words in a text, cut anywhere")
    for budget in range(t.total() + 2):
        cut = t.cut(budget)
        assert t.at(cut) <= budget and (cut == t.bytes[-1] or t.at(cut + 1) > budget)
    rows = [*enumerate(texts), (7, texts[7]), (9000, None)]
    docs = clashing(documents(spark, [(i, x, "s") for i, x in rows]))
    got = sorted((r.doc_id, r.n_bytes, r.n_tokens, r.over_limit) for r in T.token_counts(docs, path).collect())
    assert got == sorted((i, len((x or "").encode()), size(x or ""), size(x or "") > 1024) for i, x in rows)
    assert T.token_counts(docs.limit(0), path).count() == 0


@pytest.mark.parametrize("batch", ["3", "10000"])
def test_chat_round_trip(spark, batch):
    rng = random.Random(3)
    bits = ["a", "\\", "#", "<", ":", "### ", "</turn>", "\n", "é", "\U0001f600", "\\### Assistant: </turn> ok"]
    texts = [None, "", "y" * 50000] + ["".join(rng.choice(bits) for _ in range(rng.randint(0, 9))) for _ in range(6)]
    rows = [(rng.choice([None, 1, 2, 3, 5, 8]), rng.choice([None, 0, 1, 2]), rng.choice(["assistant", "user", None, "a:b\\"]), rng.choice(texts)) for _ in range(300)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("formatted", F.lit(1))
    old = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", batch)
    try:
        got = {r.conv_id: r for r in C.format_chat(df).collect()}
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", old)
    want = {}
    for r in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or 0, (r[2] or "").encode(), (r[3] or "").encode())):
        want.setdefault(r[0], []).append((r[2] or "", r[3] or ""))
    assert got.keys() == want.keys()
    for k, turns in want.items():
        text = got[k].formatted
        assert C.read_turns(text) == turns
        assert [C.unescape(text[s.start : s.end]) for s in got[k].loss_spans] == [t for r, t in turns if r == "assistant"]
    assert C.format_chat(df.limit(0)).count() == 0


def test_classifier_on_held_out_labels(spark):
    sf = "/root/testdata/sf0.1"
    docs, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    out = Q.quality_scores(clashing(docs), labels)
    got = out.join(labels, "doc_id").filter("held_out").select("predicted", "quality").toPandas()
    assert len(got) > 500 and (got.predicted == got.quality).mean() > 0.98
    assert out.count() == docs.count()


def test_classifier_sample_keeps_its_bound(spark, monkeypatch):
    rows = [(i, f"text {i} " + ("| # " * 9 if i % 2 else "plain words here"), "s") for i in range(3000)] + [(4, "hot id", "s")] * 500
    labels = spark.createDataFrame([(i, i % 2) for i in range(3000)], "doc_id long, quality int")
    seen = []
    fit = Q.fit
    monkeypatch.setattr(Q, "fit", lambda x, y: seen.append(len(y)) or fit(x, y))
    got = Q.quality_scores(documents(spark, rows), labels, max_rows=400).collect()
    assert 150 < seen[0] <= 400 and len(got) == len(rows)
    held = [r for r in got if r.held_out and r.doc_id != 4]
    assert sum(r.predicted == r.doc_id % 2 for r in held) > 0.95 * len(held)


def test_classifier_fit_equals_plain_boosting():
    rng = np.random.default_rng(2)
    x = rng.standard_normal((400, len(Q.FEATURES)))
    y = (x[:, 0] + x[:, 1] * x[:, 2] + 0.3 * rng.standard_normal(400) > 0).astype(float)
    model = Q.fit(x, y)
    plain = []
    for row in x:  # the model's tables, looked up one by one
        s = model.intercept
        for e, t, v in zip(model.edges, model.tables, row, strict=True):
            s += t[sum(v >= c for c in e)]
        for i, j, ei, ej, t in model.pairs:
            s += t[sum(row[i] >= c for c in ei)][sum(row[j] >= c for c in ej)]
        plain.append(1 / (1 + np.exp(-s)))
    assert np.allclose(model.score(x), plain, atol=1e-12)
    assert ((model.score(x) >= 0.5) == y).mean() > 0.9
    assert any({i, j} == {1, 2} for i, j, *_ in model.pairs)


def test_classifier_learns_nothing_from_held_out_labels(spark):
    sf = "/root/testdata/sf0.01"
    docs, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    turned = labels.withColumn("quality", F.when(Q.held_out(), 1 - F.col("quality")).otherwise(F.col("quality")))
    one, two = (Q.quality_scores(docs, x).orderBy("doc_id").toPandas() for x in (labels, turned))
    assert (one.score == two.score).all()


def test_classifier_without_labels_and_odd_texts(spark):
    docs = documents(spark, [(0, None, "s"), (1, "", "s"), (2, " \n", "s"), (2, " \n", "s"), (None, "text | of # marks", None)])
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    got = Q.quality_scores(docs, none).collect()
    assert len(got) == 5 and all(r.score == 0.5 and r.predicted == 1 for r in got)
    ones = spark.createDataFrame([(0, 1, 0), (0, 1, 0), (2, None, 0), (77, 0, 0)], "doc_id long, quality int, toxic int")
    assert all(0.5 < r.score < 1 for r in Q.quality_scores(docs, ones).collect())
    assert Q.quality_scores(docs.limit(0), ones).count() == 0
    assert np.isfinite([Q.text_features(t) for t in (None, b"", b" ", b"\xff\x00", b"a" * 100000)]).all()
