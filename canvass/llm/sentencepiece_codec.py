"""SentencePiece encoding and decoding for merge-type vocabularies.

The library's own normaliser runs first.  A normalised text is cut where a
word mark follows another character: no piece of such a vocabulary spans that
place (checked when the model is loaded; else the text stays in one part), so
merges on either side never meet; the same holds on both sides of a plain
character outside the vocabulary.  In each part an agenda of adjacent symbol
pairs, best score first and leftmost among equals, drives the merges; characters
that end up outside the vocabulary become byte pieces.  Parts seen before come
from a bounded memo; the new ones of many texts run their agendas side by side
in numpy, long ones run alone with a heap.  In every Arrow batch the library
encodes all parts that are new to it as well; a difference ends the job.

Defined cases: a null text is an empty one; an empty text has no ids, the
digest of an empty string and decodes to an empty string; repeated rows come
back once each; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import re
from array import array
from collections.abc import Iterator
from heapq import heapify, heappop, heappush
from itertools import chain, islice

import numpy as np
import pandas as pd
import public_tokenizers
import sentencepiece
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import read_table, text_batches

MODEL = "piece_bpe_32k.model"
MARK = "▁"
#: Parts remembered per worker, and the longest part that is remembered.
MEMO_PARTS = 500_000
MEMO_LENGTH = 64
#: Characters of the texts whose new parts are learnt together.
LOT = 1_000_000
NONE = np.int64(2**62)
#: Symbols from here on stand for characters outside the vocabulary.
OUTSIDE = 2**24


class PieceCodec:
    """Encoder over one model file; ``encode`` gives ids, ``decode`` the library's text."""

    def __init__(self, model: str):
        self.lib = sentencepiece.SentencePieceProcessor(model_file=model)
        lib, n = self.lib, self.lib.get_piece_size()
        if any(lib.is_unused(i) for i in range(n)):
            raise ValueError("models with unused pieces are not supported")
        own = [i for i in range(n) if not (lib.is_control(i) or lib.is_unknown(i) or lib.is_byte(i))]
        self.ids = {lib.id_to_piece(i): i for i in own}
        place = {s: k for k, s in enumerate(sorted({lib.get_score(i) for i in own}, reverse=True))}
        self.rank = {lib.id_to_piece(i): place[lib.get_score(i)] for i in own}
        self.bytes = {int(lib.id_to_piece(i)[3:5], 16): i for i in range(n) if lib.is_byte(i)}
        self.unknown = lib.unk_id()
        self.cut, self.before = None, None
        if not any(MARK in p.lstrip(MARK) for p in self.ids) and lib.normalize("a  b") == f"{MARK}a{MARK}{MARK}b":
            # Plain characters outside the vocabulary never merge: each is a part.
            solo = "".join(re.escape(chr(c)) for c in range(128) if chr(c) not in self.ids)
            self.cut = re.compile(f"{MARK}*[^{MARK}{solo}]+|{MARK}+" + (f"|[{solo}]" if solo else ""))
            if "\n" in solo:  # put before a part without a mark, it keeps the library's own mark off
                self.before = self.lib.encode("\n", num_threads=1)
        self.memo: dict[str, bytes] = {}
        self._tables()

    def _tables(self) -> None:
        """The vocabulary as arrays: character to piece, and adjacent pieces to their merge."""
        self.char = np.full(0x110000, -1, np.int32)
        pairs = {}
        for p, i in self.ids.items():
            if len(p) == 1:
                self.char[ord(p)] = i
            for k in range(1, len(p)):
                if p[:k] in self.ids and p[k:] in self.ids:
                    pairs[self.ids[p[:k]] << 32 | self.ids[p[k:]]] = self.rank[p] << 32 | i
        self.pair_keys = np.array(sorted(pairs), np.int64)
        self.pair_values = np.array([pairs[k] for k in self.pair_keys.tolist()], np.int64)
        self.decimal = [str(i) for i in range(self.lib.get_piece_size())]

    def _pair(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank and merged piece (high and low half) of adjacent pieces; ``NONE`` if they do not merge."""
        key = left << 32 | right
        at = np.minimum(np.searchsorted(self.pair_keys, key), len(self.pair_keys) - 1)
        return np.where(self.pair_keys[at] == key, self.pair_values[at], NONE)

    def merge_many(self, parts: list[str]) -> list[list[int]]:
        """:meth:`merge` for many parts.

        The agendas of all parts advance together: in a round each part takes
        its best pair, the leftmost among equals, and merges it; a part without
        a pair is done.
        """
        seg = np.repeat(np.arange(len(parts)), np.fromiter(map(len, parts), np.int64, len(parts)))
        points = np.frombuffer("".join(parts).encode("utf-32-le"), np.uint32)
        sym = self.char[points].astype(np.int64)
        sym[sym < 0] = OUTSIDE + points[sym < 0]
        pair = np.full(len(sym), NONE, np.int64)
        inner = np.nonzero(seg[1:] == seg[:-1])[0]
        pair[inner] = self._pair(sym[inner], sym[inner + 1])
        done_seg, done_sym = [], []
        while len(seg):
            starts = np.nonzero(np.concatenate([[True], seg[1:] != seg[:-1]]))[0]
            counts = np.diff(np.append(starts, len(seg)))
            best = np.minimum.reduceat(pair, starts)
            open_ = np.repeat(best != NONE, counts)
            if not open_.all():
                done_seg.append(seg[~open_])
                done_sym.append(sym[~open_])
                seg, sym, pair = seg[open_], sym[open_], pair[open_]
                counts, best = counts[best != NONE], best[best != NONE]
                if not len(seg):
                    break
            hit = np.nonzero(pair == np.repeat(best, counts))[0]
            hit = hit[np.concatenate([[True], seg[hit][1:] != seg[hit][:-1]])]
            sym[hit] = pair[hit] & 0xFFFFFFFF
            keep = np.ones(len(seg), bool)
            keep[hit + 1] = False
            hit -= np.arange(len(hit))  # one symbol has left in each part before
            seg, sym, pair = seg[keep], sym[keep], pair[keep]
            for left in (hit, hit[(hit > 0) & (seg[hit - 1] == seg[hit])] - 1):
                last = left + 1 >= len(seg)
                right = np.minimum(left + 1, len(seg) - 1)
                pair[left] = np.where(~last & (seg[right] == seg[left]), self._pair(sym[left], sym[right]), NONE)
        seg, sym = np.concatenate(done_seg), np.concatenate(done_sym)
        order = np.argsort(seg, kind="stable")
        flat, ends = sym[order].tolist(), np.cumsum(np.bincount(seg, minlength=len(parts))).tolist()
        out = [flat[s:e] for s, e in zip([0, *ends], ends, strict=False)]
        for k in np.unique(seg[sym >= OUTSIDE]).tolist():
            out[k] = [x for i in out[k] for x in (self.outside(chr(i - OUTSIDE)) if i >= OUTSIDE else (i,))]
        return out

    def outside(self, char: str) -> list[int]:
        """Ids of a character that is not in the vocabulary."""
        return [self.bytes[b] for b in char.encode()] if self.bytes else [self.unknown]

    def merge(self, part: str) -> list[int]:
        """Ids of one normalised part, by the agenda."""
        rank, n = self.rank.get, len(part)
        text, nxt, prev = list(part), list(range(1, n + 1)), list(range(-1, n - 1))
        # An entry is rank * n + place: best score first, leftmost among equals.
        agenda = [r * n + i for i in range(n - 1) if (r := rank(part[i : i + 2])) is not None]
        heapify(agenda)
        while agenda:
            r, i = divmod(heappop(agenda), n)
            j = nxt[i]
            if j >= n or text[i] is None:
                continue
            pair = text[i] + text[j]
            if rank(pair) != r:
                continue  # one of the two has been merged meanwhile
            text[i], text[j] = pair, None
            nxt[i] = k = nxt[j]
            if k < n:
                prev[k] = i
                if (r := rank(pair + text[k])) is not None:
                    heappush(agenda, r * n + i)
            h = prev[i]
            if h >= 0 and (r := rank(text[h] + pair)) is not None:
                heappush(agenda, r * n + h)
        out: list[int] = []
        for piece in text:
            if piece is None:
                continue
            out += [self.ids[piece]] if piece in self.ids else self.outside(piece)
        return out

    def learn(self, parts: list[str]) -> dict[str, bytes]:
        """Encode parts by the agenda and check each against the library; ids as packed 32-bit numbers."""
        short = [p for p in parts if len(p) <= MEMO_LENGTH]
        found = dict(zip(short, self.merge_many(short), strict=True)) if short else {}
        checks = self.lib.encode([self._probe(p) for p in parts], num_threads=1) if self.cut else ()
        out = {}
        for k, p in enumerate(parts):
            ids = found[p] if p in found else self.merge(p)
            if self.cut:
                right = checks[k]
                if p[0] != MARK:
                    right = right[len(self.before):] if self.before else ids
                if ids != right and p != MARK:
                    raise RuntimeError(f"the agenda and the library differ on {p[:200]!r}")
            out[p] = array("i", ids).tobytes()
        return out

    def _probe(self, part: str) -> str:
        """A text that the library encodes to a part's ids: it puts a first mark itself."""
        return part[1:].replace(MARK, " ") if part[0] == MARK else "\n" + part

    def encode(self, text: str) -> tuple[list[int], str]:
        """The ids of a whole text, and the same in decimal, joined by commas."""
        return next(self.encode_many([text]))

    def encode_many(self, texts: list[str]) -> Iterator[tuple[list[int], str]]:
        """:meth:`encode` for each text, learning the new parts of many texts at once."""
        lot, size = [], 0
        for t in texts:
            lot.append(t)
            size += len(t)
            if size >= LOT:
                yield from self._lot(lot)
                lot, size = [], 0
        yield from self._lot(lot)

    def _lot(self, texts: list[str]) -> Iterator[tuple[list[int], str]]:
        known, cut = self.memo, self.cut
        norms = [self.lib.normalize(t) if t else "" for t in texts]
        parts = [cut.findall(x) if cut else [x] if x else [] for x in norms]
        new = set(chain.from_iterable(parts)).difference(known)
        fresh = self.learn(list(new)) if new else {}
        if len(known) > MEMO_PARTS:  # the older half goes, after this lot
            old = list(islice(known, MEMO_PARTS // 2))
        else:
            old = []
        known.update(fresh)
        for t, x in zip(texts, parts, strict=True):
            ids = np.frombuffer(b"".join(map(known.__getitem__, x)), np.int32).tolist()
            if not cut and ids != self.lib.encode(t, num_threads=1):
                raise RuntimeError(f"the agenda and the library differ on {t[:200]!r}")
            yield ids, ",".join(map(self.decimal.__getitem__, ids))
        for p in old:
            del known[p]
        for p in fresh:
            if len(p) > MEMO_LENGTH:
                del known[p]

    def decode(self, ids: list[int]) -> str:
        return self.lib.decode(ids)


_CODECS: dict[str, PieceCodec] = {}


def codec(model: str) -> PieceCodec:
    """One codec per worker process and model."""
    if model not in _CODECS:
        _CODECS[model] = PieceCodec(model)
    return _CODECS[model]


def encode_documents(docs: DataFrame, model: str, text: str = "text") -> DataFrame:
    """``docs`` (all columns) with ``token_ids``, ``n_tokens`` and ``decodes_back``: whether
    the library's decoding of the ids gives the text again.  Columns of ``docs`` with these
    names give way to the new ones."""
    @F.pandas_udf("token_ids array<int>, n_tokens long, decodes_back boolean")
    def run(texts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        c = codec(model)
        for s in texts:
            texts = [t or "" for t in s]
            rows = [(np.array(ids, np.int32), len(ids), c.decode(ids) == t) for t, (ids, _) in zip(texts, c.encode_many(texts), strict=True)]
            yield pd.DataFrame(rows, columns=["token_ids", "n_tokens", "decodes_back"])

    return text_batches(docs).withColumn("__encoded", run(F.col(text))).select(
        *[c for c in docs.columns if c.lower() not in ("token_ids", "n_tokens", "decodes_back")], "__encoded.*")


def encoding_digest(docs: DataFrame, model: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, n_tokens, ids_sha256, decoded_sha256`` per document."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        c = codec(model)
        for b in batches:
            rows = [(len(ids), _sha(joined), _sha(c.decode(ids))) for ids, joined in c.encode_many([t or "" for t in b["text"]])]
            out = pd.DataFrame(rows, columns=["n_tokens", "ids_sha256", "decoded_sha256"])
            out.insert(0, "doc_id", b["doc_id"].to_numpy())
            yield out

    named = text_batches(docs).select(F.col(doc_id).cast("string").alias("doc_id"), F.col(text).alias("text"))
    out = named.mapInPandas(run, "doc_id string, n_tokens long, ids_sha256 string, decoded_sha256 string")
    return out.withColumn("doc_id", F.col("doc_id").cast("long"))


def _sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def op3_sentencepiece(spark: SparkSession, sf_dir: str, model: str | None = None) -> DataFrame:
    out = encoding_digest(read_table(spark, sf_dir, "documents"), model or public_tokenizers.path(MODEL))
    return out.select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256")
