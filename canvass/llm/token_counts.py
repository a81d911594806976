"""Exact token counts of every prefix by dynamic programming, for byte-level BPE.

The vocabulary's own pre-tokenizer cuts a text into pieces that are encoded
apart.  Inside a piece the encoding of every prefix ends in exactly one token
that fits behind the encoding of the prefix before it (two tokens fit if the
merges, run on their joined bytes, give just these two).  So one pass over the
bytes finds, for each prefix, its last token and its count: one more than the
count of the prefix before that token.  Counts of whole texts, of cut texts
and of token budgets are then read from these numbers; nothing is encoded.

Pieces seen before come from a bounded memo.  The pieces are found with the
pre-tokenizer's pattern; a text with a character for which the library's own
pre-tokenizer cuts differently (each character is probed once) takes the
library's cuts.  Special tokens inside a text count one each, as the library
has it by default.

Defined cases: a null
text is an empty one and has no tokens; repeated rows come back once each; an
empty table gives an empty result.
"""

from __future__ import annotations

import json
from bisect import bisect_left, bisect_right
from collections.abc import Iterator
from itertools import accumulate, islice

import ahocorasick
import pandas as pd
import public_tokenizers
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from .common import read_table, text_batches

VOCABULARY = "byte_bpe_50k.json"
LIMIT = 1024
#: Fixed value: the pattern of the byte-level pre-tokenizer.
PIECES = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: The contractions that the pattern takes as pieces.
CONTRACTIONS = frozenset((b"'s", b"'t", b"'re", b"'ve", b"'m", b"'ll", b"'d"))
#: Pieces and token pairs remembered per worker, and the longest remembered piece in bytes.
MEMO = 300_000
MEMO_BYTES = 64


def _byte_letters() -> dict[str, int]:
    """The letters by which byte-level vocabularies write bytes: printable Latin-1
    bytes stand for themselves, the others are numbered from U+0100."""
    shown = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + k): b for k, b in enumerate(hidden)}


def _trim(memo: dict) -> None:
    if len(memo) > MEMO:
        for key in list(islice(memo, MEMO // 2)):
            del memo[key]


class PrefixCounter:
    """Counts of one ``tokenizers`` file with a byte-level BPE model."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model, pre = spec["model"], spec["pre_tokenizer"]
        if model["type"] != "BPE" or pre["type"] != "ByteLevel" or pre["add_prefix_space"] or not pre["use_regex"] or spec["normalizer"]:
            raise ValueError("a byte-level BPE vocabulary without normaliser is needed")
        if model.get("ignore_merges") or model.get("dropout"):
            raise ValueError("ignore_merges and dropout are not supported")
        letters = _byte_letters()
        raw = lambda token: "".join(chr(letters[c]) for c in token)  # noqa: E731  bytes as Latin-1 letters
        merges = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        self.rank = {(raw(a), raw(b)): k for k, (a, b) in enumerate(merges)}
        special = {t["content"] for t in spec["added_tokens"]}
        self.ends = ahocorasick.Automaton()
        for t in model["vocab"]:
            if t not in special:
                self.ends.add_word(raw(t), raw(t))
        self.ends.make_automaton()
        self.special = regex.compile("(" + "|".join(map(regex.escape, sorted(special, key=len, reverse=True))) + ")") if special else None
        self.lib = Tokenizer.from_file(path).pre_tokenizer
        self.pieces = regex.compile(PIECES)
        self.fits_memo: dict[tuple[str, str], bool] = {}
        self.memo: dict[str, tuple[int, ...]] = {}
        self.plain: set[str] = set()
        self.odd: set[str] = set()
        self.blanks: dict[str, bool] = {"": False}

    def merged(self, data: str) -> list[str]:
        """Tokens of a few bytes by running the merges in rank order."""
        parts = list(data)
        while len(parts) > 1:
            best = min(zip(parts, parts[1:], strict=False), key=lambda p: self.rank.get(p, len(self.rank)))
            if best not in self.rank:
                break
            out, i = [], 0
            while i < len(parts):
                if i + 1 < len(parts) and (parts[i], parts[i + 1]) == best:
                    out.append(parts[i] + parts[i + 1])
                    i += 2
                else:
                    out.append(parts[i])
                    i += 1
            parts = out
        return parts

    def fits(self, a: str, b: str) -> bool:
        """Whether token ``b`` can follow token ``a`` (empty: can start a piece)."""
        _trim(self.fits_memo)
        known = self.fits_memo[a, b] = self.merged(a + b) == ([a, b] if a else [b])
        return known

    def prefix_counts(self, piece: bytes) -> tuple[int, ...]:
        """Token counts of the prefixes of 1, 2, ... bytes of one piece.

        The automaton lists the tokens that end at each byte, byte by byte.
        """
        last, count, known = [""], [0], self.fits_memo.get
        done = 0
        for end, token in self.ends.iter(piece.decode("latin-1")):
            if end < done:
                continue  # the one token that fits here is found
            at = end + 1 - len(token)
            before = last[at]
            fit = known((before, token))
            if self.fits(before, token) if fit is None else fit:
                last.append(token)
                count.append(count[at] + 1)
                done = end + 1
        if done < len(piece):
            raise ValueError("a byte is missing from the vocabulary")
        return tuple(count[1:])

    def _probe(self, chars: set[str]) -> None:
        for c in chars:
            tests = (f"a{c}b{c}", f"1{c}2", f" {c} {c}x", f".{c}.{c}{c}", f"{c}'s {c}  {c}")
            same = all([t[s:e] for _, (s, e) in self.lib.pre_tokenize_str(t)] == self.pieces.findall(t) for t in tests)
            (self.plain if same else self.odd).add(c)

    def blank(self, char: str) -> bool:
        """Whether a character joins a blank after it: white space, as the pre-tokenizer sees it."""
        known = self.blanks.get(char)
        if known is None:
            known = self.blanks[char] = len(self.lib.pre_tokenize_str(char + " ")) == 1
        return known

    def split(self, text: str) -> list[str]:
        chars = set(text)
        if not chars <= self.plain:
            self._probe(chars - self.plain - self.odd)
            if not chars.isdisjoint(self.odd):
                return [text[s:e] for _, (s, e) in self.lib.pre_tokenize_str(text)]
        return self.pieces.findall(text)

    def counts(self, text: str) -> list[tuple[int, ...]]:
        """Prefix counts of the pieces of a whole text, in order; a special token is
        one piece that counts from its last byte on."""
        out, memo = [], self.memo
        _trim(memo)
        for k, span in enumerate(self.special.split(text) if self.special else [text]):
            if k % 2:
                out.append((0,) * (len(span.encode()) - 1) + (1,))
                continue
            for p in self.split(span) if span else ():
                c = memo.get(p)
                if c is None:
                    raw = p.encode()
                    c = self.prefix_counts(raw)
                    if len(raw) <= MEMO_BYTES:
                        memo[p] = c
                out.append(c)
        return out


class PrefixTable:
    """The counts of one text at every prefix, for any number of questions.

    A prefix is cut into pieces as a text of its own.  That differs from the
    whole text's pieces only at its end: a run of white space that the prefix
    ends in is one piece, and a contraction or a special token may be cut short.
    Those ends are counted anew, a run of white space once for all its prefixes.
    A prefix that ends inside a character is counted under the whole text's pieces.
    """

    def __init__(self, counter: PrefixCounter, text: str):
        self.counter, self.raw = counter, text.encode()
        self.pieces = counter.counts(text)
        self.tokens = [0, *accumulate(c[-1] for c in self.pieces)]
        self.bytes = [0, *accumulate(len(c) for c in self.pieces)]
        self.runs: dict[int, tuple[int, ...]] = {}

    def total(self) -> int:
        return self.tokens[-1]

    def _special(self, k: int) -> bool:
        return self.pieces[k][0] == 0

    def _blank(self, k: int) -> bool:
        """Whether piece ``k`` is white space only."""
        return not self._special(k) and all(map(self.counter.blank, self.raw[self.bytes[k] : self.bytes[k + 1]].decode()))

    def _run_start(self, k: int) -> int:
        """The first piece of the run of white space that ends just before piece ``k``."""
        while k and self._blank(k - 1):
            k -= 1
        return k

    def _run(self, p: int) -> tuple[int, ...]:
        """Prefix counts of the run of white space that starts with piece ``p``, taken as one piece."""
        if p not in self.runs:
            k = p
            while k < len(self.pieces) and self._blank(k):
                k += 1
            end = self.bytes[k]
            if k < len(self.pieces) and not self._special(k):  # a word's own blank
                first = self.raw[end : end + 4].decode(errors="ignore")[:1]
                end += len(first.encode()) if self.counter.blank(first) else 0
            self.runs[p] = self.counter.prefix_counts(self.raw[self.bytes[p] : end])
        return self.runs[p]

    def at(self, n_bytes: int) -> int:
        """Tokens of the first ``n_bytes`` bytes."""
        if n_bytes == 0 or n_bytes == self.bytes[-1]:
            return self.tokens[-1] if n_bytes else 0
        k = bisect_left(self.bytes, n_bytes) - 1
        start, end = self.bytes[k], self.bytes[k + 1]
        table = self.tokens[k] + self.pieces[k][n_bytes - start - 1]
        if self.raw[n_bytes] & 0xC0 == 0x80:
            return table
        if n_bytes < end and self._special(k):
            j = self._run_start(k)
            j = k - 1 if j == k and k and not self._special(k - 1) else j
            return self.tokens[j] + sum(c[-1] for c in self.counter.counts(self.raw[self.bytes[j] : n_bytes].decode()))
        if n_bytes < end and self.raw[start:end] in CONTRACTIONS:
            return self.tokens[k] + sum(c[-1] for c in self.counter.counts(self.raw[start:n_bytes].decode()))
        if not self._special(k) and self.counter.blank(self._last(n_bytes)):
            p = self._run_start(k)
            return self.tokens[p] + self._run(p)[n_bytes - self.bytes[p] - 1]
        return table

    def _last(self, n_bytes: int) -> str:
        return self.raw[max(0, n_bytes - 4) : n_bytes].decode(errors="ignore")[-1:]

    def cut(self, budget: int) -> int:
        """Bytes of the longest prefix of whole characters of at most ``budget`` tokens."""
        if self.tokens[-1] <= budget:
            return self.bytes[-1]
        # An end that is counted anew starts two pieces back at most, so two pieces further none fits.
        k = min(bisect_right(self.tokens, budget - 1) + 1, len(self.pieces) - 1) if budget > 0 else -1
        while k >= 0:
            for n in range(self.bytes[k + 1], self.bytes[k], -1):
                if (n == len(self.raw) or self.raw[n] & 0xC0 != 0x80) and self.at(n) <= budget:
                    return n
            k -= 1
        return 0


_COUNTERS: dict[str, PrefixCounter] = {}


def counter(path: str) -> PrefixCounter:
    """One counter per worker process and vocabulary."""
    if path not in _COUNTERS:
        _COUNTERS[path] = PrefixCounter(path)
    return _COUNTERS[path]


def token_counts(docs: DataFrame, path: str, limit: int = LIMIT, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, n_bytes, n_tokens, over_limit, cut_bytes``: cut_bytes is the length of
    the longest prefix of whole characters of at most ``limit`` tokens."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        c = counter(path)
        for b in batches:
            rows = [(t.bytes[-1], t.total(), t.cut(limit)) for t in (PrefixTable(c, x or "") for x in b["text"])]
            out = pd.DataFrame(rows, columns=["n_bytes", "n_tokens", "cut_bytes"])
            out.insert(0, "doc_id", b["doc_id"].to_numpy())
            yield out

    named = text_batches(docs).select(F.col(doc_id).cast("string").alias("doc_id"), F.col(text).alias("text"))
    out = named.mapInPandas(run, "doc_id string, n_bytes long, n_tokens long, cut_bytes long")
    return out.select(F.col("doc_id").cast("long"), "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"), "cut_bytes")


def op4_token_counts(spark: SparkSession, sf_dir: str, path: str | None = None) -> DataFrame:
    return token_counts(read_table(spark, sf_dir, "documents"), path or public_tokenizers.path(VOCABULARY))
