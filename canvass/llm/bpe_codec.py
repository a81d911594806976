"""Byte-level BPE encoding and decoding with reuse of content-defined chunks.

A rolling hash over the last 16 bytes cuts every text into chunks, so passages
that documents share fall into the same chunks wherever they stand.  A chunk is
encoded once and kept in a memo of bounded size; the same bytes, in whatever
document, take their ids from there.  Where two chunks meet, their ids may not
be those of the whole text.  So the text around each join is encoded again, from
a word before it to a word after it, and the window is widened word by word
until its ids agree at both ends, for a whole word, with the ids of the chunks;
the ids between are replaced.  A word's start here is white space after another
ASCII character: the pre-tokenizer always cuts there and looks at nothing
before, so ids on the two sides of an agreed place do not depend on each other.
Joins without enough such places on either side are not made: the chunks stay
together, at worst as one whole text.

Chunks are encoded by ``tiktoken`` over the ranks of the same vocabulary file,
faster by half than ``tokenizers``.  Both give the same ids if every token of
the vocabulary is reached by the file's merges from its own bytes, which is
checked once per worker, and if both split the text alike: texts with a
character that is younger than Unicode 3.2, or for which probes differ, and
chunks with a special token's string, are encoded by ``tokenizers`` itself.
Decoding joins the tokens' bytes; bytes that are no UTF-8 are decoded by the
library.

Defined cases: a null text is an empty one; an empty text has no ids and decodes
to an empty string; repeated rows come back once each; an empty table gives an
empty result; texts of any length are encoded whole.
"""

from __future__ import annotations

import hashlib
import json
import os
import unicodedata
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import public_tokenizers
import tiktoken
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from .common import read_table

VOCABULARY = "byte_bpe_50k.json"
#: A chunk ends where these bits of the rolling hash are zero (2 KB on average) ...
CUT_BITS = 11
#: ... and where at least so many word starts lie in it.
WORDS = 16
#: Bytes of chunks and ids in one of the memo's two generations; the longest remembered chunk; bytes of texts cut at once.
MEMO_BYTES, MEMO_CHUNK, LOT = 24 << 20, 16 << 10, 4 << 20
#: Fixed value: the pattern of the byte-level pre-tokenizer.
PIECES = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
_GEAR = np.random.default_rng(13).integers(0, 2**32, 256, dtype=np.uint32)


def _byte_letters() -> dict[str, int]:
    """The letters by which byte-level vocabularies write bytes: printable Latin-1
    bytes stand for themselves, the others are numbered from U+0100."""
    shown = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + k): b for k, b in enumerate(hidden)}


def rolling_cuts(data: np.ndarray) -> np.ndarray:
    """Places after which the hash of the last 16 bytes has ``CUT_BITS`` zero bits, between characters."""
    h = _GEAR[data]
    for k in (1, 2, 4, 8):
        wider = h.copy()
        wider[k:] += h[:-k] << np.uint32(k)
        h = wider
    at = np.nonzero(h >> np.uint32(32 - CUT_BITS) == 0)[0] + 1
    at = at[at < len(data)]
    return at[data[at] & 0xC0 != 0x80]


def word_starts(data: np.ndarray) -> np.ndarray:
    """Places of a space or line feed behind another ASCII character."""
    blank = (data[1:] == 0x20) | (data[1:] == 0x0A)
    return np.nonzero(blank & (data[:-1] > 0x20) & (data[:-1] < 0x7F))[0] + 1


class Memo:
    """Ids of chunks, in two generations: what the older one holds and nobody asks for goes."""

    def __init__(self, limit: int = MEMO_BYTES):
        self.limit, self.size = limit, 0
        self.young: dict[bytes, bytes] = {}
        self.old: dict[bytes, bytes] = {}
        self.hits = 0

    def get(self, chunk: bytes) -> bytes | None:
        found = self.young.get(chunk)
        if found is None and (found := self.old.get(chunk)) is not None:
            self.put(chunk, found)
        self.hits += found is not None
        return found

    def put(self, chunk: bytes, ids: bytes) -> None:
        if len(chunk) > MEMO_CHUNK:
            return
        self.young[chunk] = ids
        self.size += len(chunk) + len(ids) + 200
        if self.size > self.limit:
            self.old, self.young, self.size = self.young, {}, 0


class ChunkCodec:
    """Encoder and decoder over one ``tokenizers`` file; ids are little-endian 32-bit numbers."""

    def __init__(self, path: str, memo_bytes: int = MEMO_BYTES):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark's tasks are the parallelism
        self.lib = Tokenizer.from_file(path)
        self.lib.no_padding()
        self.lib.no_truncation()
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model, pre = spec["model"], spec["pre_tokenizer"]
        if model["type"] != "BPE" or pre["type"] != "ByteLevel" or pre["add_prefix_space"] or not pre["use_regex"] or spec["normalizer"]:
            raise ValueError("a byte-level BPE vocabulary without normaliser is needed")
        special = {t["content"]: t for t in spec["added_tokens"]}
        if any(t["lstrip"] or t["rstrip"] or t["single_word"] or set(t["content"]) & set(" \n") for t in special.values()):
            raise ValueError("special tokens that reach into the text around them are not supported")
        letters = _byte_letters()
        raw = {bytes(letters[c] for c in t): i for t, i in model["vocab"].items() if t not in special}
        rank = {m.replace(" ", "") if isinstance(m, str) else "".join(m): k for k, m in enumerate(model["merges"])}
        own = sorted((i for t, i in model["vocab"].items() if t in rank))
        by_rank = sorted((t for t in model["vocab"] if t in rank), key=rank.__getitem__)
        # tiktoken merges by id where the library merges by rank, and any two tokens that make a third.
        self.fast = None
        if [model["vocab"][t] for t in by_rank] == own and not model.get("ignore_merges") and not model.get("dropout") \
                and all(len(self.lib.model.tokenize(t)) == 1 for t in model["vocab"] if t not in special):
            self.fast = tiktoken.Encoding("chunks", pat_str=PIECES, mergeable_ranks=raw, special_tokens={})
        self.special = [t.encode() for t in special]
        self.bytes = [b""] * (max([*raw.values(), *(t["id"] for t in special.values())]) + 1)
        for t, i in raw.items():
            self.bytes[i] = t
        for t in special.values():
            self.bytes[t["id"]] = t["content"].encode()
        self.lengths = np.array([len(t) for t in self.bytes], np.int64)
        self.memo = Memo(memo_bytes)
        self.plain, self.odd = {chr(c) for c in range(128) if self._same(chr(c))}, set()
        self.ascii_plain = len(self.plain) == 128

    def _same(self, c: str) -> bool:
        """Whether both libraries surely treat a character alike."""
        probe = f"a{c}b{c}1{c}2 {c} {c}x  {c}.{c}.{c}{c}'s {c}"
        return unicodedata.ucd_3_2_0.category(c) != "Cn" and self.fast is not None and self.fast.encode_ordinary(probe) == self.lib.encode(probe, add_special_tokens=False).ids

    def usual(self, text: str) -> bool:
        """Whether ``tiktoken`` may encode the parts of this text."""
        if text.isascii():
            return self.ascii_plain
        chars = set(text)
        for c in chars - self.plain - self.odd:
            (self.plain if self._same(c) else self.odd).add(c)
        return self.odd.isdisjoint(chars)

    def ids_of(self, data: bytes, usual: bool) -> bytes:
        """Ids of some bytes alone."""
        text = data.decode()
        if usual and not any(s in data for s in self.special):
            ids = self.fast.encode_ordinary(text)
        else:
            ids = self.lib.encode(text, add_special_tokens=False).ids
        return array("I", ids).tobytes()

    def chunk_ids(self, chunk: bytes, usual: bool) -> bytes:
        ids = self.memo.get(chunk)
        if ids is None:
            ids = self.ids_of(chunk, usual)
            self.memo.put(chunk, ids)
        return ids

    def encode_lot(self, texts: list[str]) -> Iterator[bytes]:
        """Ids of whole texts; the rolling hash runs over all of them at once."""
        raws = [t.encode() for t in texts]
        data = np.frombuffer(b"".join(raws), np.uint8)
        cuts, starts = rolling_cuts(data), word_starts(data)
        ends = np.cumsum([len(r) for r in raws])
        cut_at, start_at = np.searchsorted(cuts, ends, "left"), np.searchsorted(starts, ends, "left")
        rank = np.searchsorted(starts, cuts, "left")  # word starts before each cut
        c = s = first = 0
        for k, raw in enumerate(raws):
            c2, s2, end = int(cut_at[k]), int(start_at[k]), int(ends[k])
            own, last, before = [], s, rank[c:c2].tolist()
            for at, n in zip(cuts[c:c2].tolist(), before, strict=True):
                if n - last >= WORDS and s2 - n >= WORDS:
                    own.append((at - first, n))
                    last = n
            yield self._encode(texts[k], raw, own, starts, first)
            c, s, first = c2 + (c2 < len(cuts) and cuts[c2] == end), s2 + (s2 < len(starts) and starts[s2] == end), end

    def _encode(self, text: str, raw: bytes, cuts: list[tuple[int, int]], starts: np.ndarray, first: int) -> bytes:
        """Ids of one text from its chunks; ``cuts`` holds places and the word starts before them."""
        usual = self.usual(text)
        if not cuts:
            return self.chunk_ids(raw, usual) if raw else b""
        edges = [0, *(at for at, _ in cuts), len(raw)]
        naive = b"".join([self.chunk_ids(raw[a:b], usual) for a, b in zip(edges, edges[1:], strict=False)])
        places = np.concatenate([[0], np.cumsum(self.lengths[np.frombuffer(naive, "<u4")])])  # first byte of each token
        out, done = [], 0
        for k, (at, n) in enumerate(cuts):
            low = cuts[k - 1][1] if k else None
            high = cuts[k + 1][1] if k + 1 < len(cuts) else None
            found = self._join(raw, usual, naive, places, starts, first, n, low, high)
            if found is None:  # the chunks never agree with what stands between them
                return self.ids_of(raw, usual)
            left, right, ids = found
            out += [naive[4 * done : 4 * left], ids]
            done = right
        return b"".join([*out, naive[4 * done :]])

    def _join(self, raw: bytes, usual: bool, naive: bytes, places: np.ndarray, starts: np.ndarray, first: int, n: int,
              low: int | None, high: int | None) -> tuple[int, int, bytes] | None:
        """Tokens ``left`` to ``right`` of the chunks' ids, and the ids that take their place.

        The window holds ``wide`` words on both sides, of which the outermost
        have to keep their ids.  It stays in the near half of a chunk.
        """
        for wide in range(2, WORDS // 2 + 1):
            around = starts[n - wide : n + wide] - first
            if (low is not None and n - wide < low) or (high is not None and n + wide > high):
                break
            outer, inner, inner2, outer2 = (int(around[i]) for i in (0, 1, -2, -1))
            a, a2, b, b2 = np.searchsorted(places, [outer, inner, inner2, outer2]).tolist()
            if (places[[a, a2, b, b2]] != (outer, inner, inner2, outer2)).any():
                continue
            ids = self.ids_of(raw[outer:outer2], usual)
            if ids.startswith(naive[4 * a : 4 * a2]) and ids.endswith(naive[4 * b : 4 * b2]):
                return a, b2, ids
        return None

    def decode(self, ids: bytes) -> bytes:
        """The library's decoding of ids, in UTF-8."""
        numbers = np.frombuffer(ids, "<u4").tolist()
        data = b"".join(map(self.bytes.__getitem__, numbers))
        try:
            data.decode()
        except UnicodeDecodeError:
            return self.lib.decode(numbers, skip_special_tokens=False).encode()
        return data


_CODECS: dict[str, ChunkCodec] = {}


def codec(path: str) -> ChunkCodec:
    """One codec per worker process and vocabulary."""
    if path not in _CODECS:
        _CODECS[path] = ChunkCodec(path)
    return _CODECS[path]


def _lots(texts: Iterator[str | None]) -> Iterator[list[str]]:
    lot, size = [], 0
    for t in texts:
        lot.append(t or "")
        size += len(lot[-1])
        if size >= LOT or len(lot) >= 4096:
            yield lot
            lot, size = [], 0
    if lot:
        yield lot


def encoded(docs: DataFrame, path: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, token_ids, n_tokens``: the ids of every whole text."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = codec(path)
        for b in batches:
            at = 0
            for lot in _lots(x.as_py() for x in b.column(1)):
                ids = [np.frombuffer(x, "<u4").astype(np.int32) for x in c.encode_lot(lot)]
                yield pa.RecordBatch.from_arrays([b.column(0).slice(at, len(lot)), pa.array(ids, pa.list_(pa.int32())),
                                                  pa.array([len(x) for x in ids], pa.int64())], ["doc_id", "token_ids", "n_tokens"])
                at += len(lot)

    named = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    return named.mapInArrow(run, "doc_id long, token_ids array<int>, n_tokens long")


def encoding_digest(docs: DataFrame, path: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, n_tokens, ids_sha256, decoded_sha256`` per document: encoded, then decoded from the ids."""
    names = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = codec(path)
        sha = lambda x: hashlib.sha256(x).hexdigest()
        for b in batches:
            rows = [(len(ids) // 4, sha(ids), sha(c.decode(ids))) for lot in _lots(x.as_py() for x in b.column(1)) for ids in c.encode_lot(lot)]
            n, a, d = zip(*rows, strict=True) if rows else ((), (), ())
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(n, pa.int64()), pa.array(a, pa.string()), pa.array(d, pa.string())], names)

    named = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    return named.mapInArrow(run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")


def op13_bpe_codec(spark: SparkSession, sf_dir: str, path: str | None = None) -> DataFrame:
    return encoding_digest(read_table(spark, sf_dir, "documents"), path or public_tokenizers.path(VOCABULARY))
