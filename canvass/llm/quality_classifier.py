"""Quality classifier: a generalised additive model with pairwise interactions.

Every whole text is turned into a few shape numbers (:data:`FEATURES`); ids,
labels, language and source are never among them.  On at most ``max_rows``
labelled documents (all, or a share of the ids by hash, so the sample is the
same in every run) cyclic boosting visits one feature after the other
and adds a shallow tree on that feature alone to its lookup table; then the
pairs with the largest remaining gain get tables of their own, also boosted in
turn.  A score is the sum of the looked-up values through a sigmoid, for all
documents by vectorised bin additions.

Defined cases: null texts are empty ones and get a score like any other; label
rows without a label or a matching document are not used, repeated labels of a
document are averaged (a tie counts as 1), of the texts of a repeated id the
one with the smallest numbers is learned from; without labels the score is 0.5,
with one class only it is that class's smoothed share; repeated rows come back
once each; a null doc_id is not held out; an empty table gives an empty result.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import pairwise

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import read_table, stored, text_batches

#: The classifier is fitted on at most so many labelled documents.
MAX_ROWS = 20_000
#: Standard deviations between the expected size of the sample and its bound.
SPREAD = 6
BINS, PAIR_BINS = 32, 8
ROUNDS, PAIR_ROUNDS, PAIRS = 150, 60, 4
RATE, RIDGE = 0.15, 2.0

FEATURES = ("log_words", "word_bytes", "symbols", "exclamations", "capitals", "digits", "spaces", "line_words",
            "vocabulary", "echoes", "distinct_lines", "bare_marks", "wide_bytes", "stops", "top_word", "entropy", "short_words")

_SYMBOLS = np.frombuffer(b"#*$%&|<>=~^_{}[]\\/@+", np.uint8)
_STOPS = np.frombuffer(b".,;:", np.uint8)


def text_features(text: bytes | None) -> tuple[float, ...]:
    """The numbers of one whole text, in the order of :data:`FEATURES`."""
    text = text or b""
    if not text:
        return (0.0,) * len(FEATURES)
    counts = np.bincount(np.frombuffer(text, np.uint8), minlength=256)
    size = len(text)
    words = text.split()
    n = len(words)
    lines = [x for x in text.split(b"\n") if x.strip()]
    small, big = int(counts[97:123].sum()), int(counts[65:91].sum())
    p = counts[counts > 0] / size
    seen = Counter(words)
    lengths = np.fromiter(map(len, words), np.int64, n)
    return (
        float(np.log1p(n)), float(lengths.mean()) if n else 0.0,
        float(counts[_SYMBOLS].sum()) / size, float(counts[33]) / size, big / (big + small) if big + small else 0.0,
        float(counts[48:58].sum()) / size, float(counts[32] + counts[9:14].sum()) / size, n / len(lines) if lines else 0.0,
        float(np.log1p(len(seen)) / np.log1p(n)) if n else 0.0,
        sum(a == b for a, b in pairwise(words)) / n if n else 0.0,
        len(set(lines)) / len(lines) if lines else 0.0,
        sum(v for w, v in seen.items() if not w.isalnum() and w.isascii() and not any(map(bytes.isalnum, (w[:1], w[-1:])))) / n if n else 0.0,
        float(counts[128:].sum()) / size, float(counts[_STOPS].sum()) / size, max(seen.values()) / n if n else 0.0,
        float(-(p * np.log2(p)).sum()), float((lengths <= 3).sum()) / n if n else 0.0,
    )


def held_out(doc_id: str = "doc_id") -> Column:
    """The third of the ids whose labels are never learnt from."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 3 == 1, F.lit(False))


def _cut(g: np.ndarray, h: np.ndarray) -> tuple[float, int]:
    """Best place to split a row of bins in two, and its gain (0: none)."""
    if len(g) < 2:
        return 0.0, 0
    gl, hl = np.cumsum(g)[:-1], np.cumsum(h)[:-1]
    gr, hr = g.sum() - gl, h.sum() - hl
    gain = gl**2 / (hl + RIDGE) + gr**2 / (hr + RIDGE) - g.sum() ** 2 / (h.sum() + RIDGE)
    k = int(np.argmax(gain))
    return (float(gain[k]), k + 1) if gain[k] > 1e-9 else (0.0, 0)


def _tree(g: np.ndarray, h: np.ndarray, depth: int = 2) -> np.ndarray:
    """A shallow tree over ordered bins: its value in every bin."""
    gain, at = _cut(g, h) if depth else (0.0, 0)
    if not at:
        return np.full(len(g), g.sum() / (h.sum() + RIDGE))
    return np.concatenate([_tree(g[:at], h[:at], depth - 1), _tree(g[at:], h[at:], depth - 1)])


def _tree2(g: np.ndarray, h: np.ndarray, depth: int = 2) -> np.ndarray:
    """The same over a grid of two features' bins: each cut takes the better axis."""
    rows, columns = (_cut(g.sum(1 - a), h.sum(1 - a)) for a in (0, 1)) if depth else ((0.0, 0), (0.0, 0))
    if not (rows[1] or columns[1]):
        return np.full(g.shape, g.sum() / (h.sum() + RIDGE))
    axis, at = (0, rows[1]) if rows[0] >= columns[0] else (1, columns[1])
    parts = zip(np.split(g, [at], axis), np.split(h, [at], axis), strict=True)
    return np.concatenate([_tree2(x, y, depth - 1) for x, y in parts], axis)


def _edges(x: np.ndarray, bins: int) -> np.ndarray:
    return np.unique(np.quantile(x, np.linspace(0, 1, bins + 1)[1:-1]))


@dataclass
class AdditiveModel:
    """Lookup tables of single features and of pairs."""

    intercept: float = 0.0
    edges: list[np.ndarray] = field(default_factory=list)
    tables: list[np.ndarray] = field(default_factory=list)
    pairs: list[tuple[int, int, np.ndarray, np.ndarray, np.ndarray]] = field(default_factory=list)

    def score(self, x: np.ndarray) -> np.ndarray:
        """Probabilities of label 1 for rows of features."""
        s = np.full(len(x), self.intercept)
        for j, (e, t) in enumerate(zip(self.edges, self.tables, strict=True)):
            s += t[np.searchsorted(e, x[:, j], "right")]
        for i, j, ei, ej, t in self.pairs:
            s += t[np.searchsorted(ei, x[:, i], "right"), np.searchsorted(ej, x[:, j], "right")]
        return 1 / (1 + np.exp(-s))


def fit(x: np.ndarray, y: np.ndarray) -> AdditiveModel:
    """Cyclic boosting of single-feature tables, then of the best pairs' tables."""
    share = (y.sum() + 1) / (len(y) + 2)
    model = AdditiveModel(float(np.log(share / (1 - share))))
    if not len(y) or y.min() == y.max():
        return model
    model.edges = [_edges(x[:, j], BINS) for j in range(x.shape[1])]
    bins = [np.searchsorted(e, x[:, j], "right") for j, e in enumerate(model.edges)]
    model.tables = [np.zeros(len(e) + 1) for e in model.edges]
    s = np.full(len(y), model.intercept)

    def residual() -> tuple[np.ndarray, np.ndarray]:
        p = 1 / (1 + np.exp(-s))
        return y - p, p * (1 - p)

    for _ in range(ROUNDS):
        for j, b in enumerate(bins):
            r, w = residual()
            step = RATE * _tree(np.bincount(b, r, len(model.tables[j])), np.bincount(b, w, len(model.tables[j])))
            model.tables[j] += step
            s += step[b]
    coarse = [_edges(x[:, j], PAIR_BINS) for j in range(x.shape[1])]
    cells = [np.searchsorted(e, x[:, j], "right") for j, e in enumerate(coarse)]
    r, w = residual()
    found = []
    for i in range(x.shape[1]):
        for j in range(i + 1, x.shape[1]):
            shape = (len(coarse[i]) + 1, len(coarse[j]) + 1)
            flat = cells[i] * shape[1] + cells[j]
            g, h = (np.bincount(flat, v, shape[0] * shape[1]).reshape(shape) for v in (r, w))
            t = _tree2(g, h)
            found.append((float((t * g).sum()), i, j, flat, shape))
    found.sort(key=lambda f: (-f[0], f[1], f[2]))
    best = [[i, j, flat, np.zeros(shape)] for _, i, j, flat, shape in found[:PAIRS]]
    for _ in range(PAIR_ROUNDS):
        for b in best:
            r, w = residual()
            g, h = (np.bincount(b[2], v, b[3].size).reshape(b[3].shape) for v in (r, w))
            step = RATE * _tree2(g, h)
            b[3] += step
            s += step.ravel()[b[2]]
    model.pairs = [(i, j, coarse[i], coarse[j], t) for i, j, _, t in best]
    return model


def train(docs: DataFrame, labels: DataFrame, max_rows: int = MAX_ROWS, doc_id: str = "doc_id", text: str = "text",
          label: str = "quality") -> AdditiveModel:
    """Fit on the bounded sample of labelled documents that are not held out."""
    known = labels.filter(F.col(label).isNotNull() & F.col(doc_id).isNotNull() & ~held_out(doc_id)).groupBy(
        F.col(doc_id).cast("long").alias("lid")).agg((F.avg(label) >= 0.5).cast("int").alias("y"))
    known = stored(known, "known")
    # A share of the labelled ids by hash, far enough below the bound that chance does not reach it.
    n = known.count()
    if n > max_rows:
        share = max(0.0, max_rows - SPREAD * max_rows**0.5) / n
        known = known.filter(F.pmod(F.xxhash64("lid"), F.lit(2**40)) < int(share * 2**40))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            out = pd.DataFrame([text_features(t) for t in b["text"]], columns=list(FEATURES), dtype=np.float64)
            yield pd.concat([b[["lid", "y"]].reset_index(drop=True), out], axis=1)

    texts = text_batches(docs).select(F.col(doc_id).cast("long").alias("id"), F.col(text).cast("binary").alias("text"))
    rows = texts.join(F.broadcast(known), F.col("id") == F.col("lid")).select("lid", "y", "text").mapInPandas(
        run, "lid long, y int, " + ", ".join(f"{f} double" for f in FEATURES))
    # One row per labelled id, however often the id repeats.
    rows = rows.groupBy("lid", "y").agg(F.min(F.struct(*FEATURES)).alias("f")).select("lid", "y", "f.*").toPandas().sort_values("lid")
    return fit(rows[list(FEATURES)].to_numpy(np.float64), rows["y"].to_numpy(np.float64))


def scorer(model: AdditiveModel):
    """The model as a function of a text column (UTF-8 bytes)."""
    @F.pandas_udf("double")
    def score(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for s in texts:
            yield pd.Series(model.score(np.array([text_features(t) for t in s], np.float64).reshape(-1, len(FEATURES))))

    return lambda text: score(text.cast("binary"))


def quality_scores(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", label: str = "quality",
                   max_rows: int = MAX_ROWS) -> DataFrame:
    """``doc_id, held_out, score, predicted``, one row per document."""
    score = scorer(train(docs, labels, max_rows, doc_id, text, label))
    out = docs.select(F.col(doc_id).alias("doc_id"), score(F.col(text)).alias("score"))
    return out.select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def quality_filter(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", label: str = "quality",
                   least: float = 0.5) -> DataFrame:
    """``docs`` (all columns) without the documents that score below ``least``."""
    score = scorer(train(docs, labels, doc_id=doc_id, text=text, label=label))
    return docs.filter(score(F.col(text)) >= least)


def op8_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_scores(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))
