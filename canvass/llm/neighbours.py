"""Approximate nearest neighbours by inner product: stable projections and kd-trees.

Largest inner product is turned into smallest distance: a candidate gets one
more component that lifts all candidates to the same length, a query gets a
zero there.  Vectors are projected to ``dims`` dimensions by a Gaussian
(2-stable) matrix, so a projected squared distance over the true one follows a
chi-square law with ``dims`` degrees of freedom.

The top of a kd-tree, fitted on a bounded sample of projected vectors, deals
every vector to a cell; large cells are cut into blocks of ``BLOCK`` rows by
hash.  A query goes to those cells whose box could hold a neighbour: its
distance to the box, against the distance of its ``k``-th neighbour in the
sample (an upper bound), must not pass the stopping test.  Queries of nearby
cells travel together, ``QUERIES`` at most, and a cell's vectors are sent only
to the groups that hold a query asking for it.  In a block the
vectors get a kd-tree of their own; its leaves are taken in order of projected
distance, their vectors verified in double precision, until the test holds:
the chance that a vector as near as the present ``k``-th lies beyond the last
leaf's distance is below ``1 - confidence``.  The blocks' lists are merged by
rank.

Defined cases: vectors that are null, empty, zero, or hold null or non-finite
components take no part, nor do rows without an id; the dimension is the
commonest length (the larger of equally common ones), other lengths take no
part; rows that repeat both id and vector count once, and a row never is a
neighbour of its own id; rows of one query id with different vectors are
queries of their own, told apart by ``query_hash``; ties go to the smaller id;
an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from canvass.operators.skew import join_per_key

from .common import read_table, stored

K = 20
EVERY = 20
#: Projected dimensions, and the chance with which each true neighbour is seen.
DIMS, CONFIDENCE = 8, 0.98
#: The index's cells are fitted on about so many vectors, chosen by hash; there are at most so many cells.
SAMPLE, CELLS = 4096, 256
#: Vectors in a block, queries in a group, vectors in a leaf of a block's tree.
BLOCK, QUERIES, LEAF = 4096, 16384, 64
#: A cell of more vectors than this is salted where it meets its groups of queries.
HOT_ROWS = 100_000
SEED = 7


def chi_square_quantile(p: float, dof: int) -> float:
    """Quantile for an even number of degrees of freedom, by bisection on the closed form."""
    def cdf(x: float) -> float:
        term = total = 1.0
        for i in range(1, dof // 2):
            term *= x / 2 / i
            total += term
        return 1 - np.exp(-x / 2) * total

    lo, hi = 0.0, 1000.0
    for _ in range(200):
        mid = (lo + hi) / 2
        lo, hi = (mid, hi) if cdf(mid) < p else (lo, mid)
    return hi


def valid_vectors(table: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding") -> DataFrame:
    """``vec_id, v`` (doubles) of the rows that take part, before the choice of a dimension."""
    v = table.select(F.col(vec_id).cast("long").alias("vec_id"), F.col(embedding).cast("array<double>").alias("v"))
    finite = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    fine = F.coalesce(F.forall("v", finite) & F.exists("v", lambda x: x != 0), F.lit(False))
    return v.filter(F.col("vec_id").isNotNull() & F.col("v").isNotNull()).filter(fine).distinct()


def packed(v: np.ndarray) -> list[bytes]:
    return [row.tobytes() for row in np.ascontiguousarray(v, np.float64)]


def unpacked(rows: pd.Series, dim: int) -> np.ndarray:
    return np.frombuffer(b"".join(rows), np.float64).reshape(-1, dim)


def inner(x: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Inner products summed from the first component on: equal vectors, equal sums."""
    total = np.zeros(len(x))
    for j in range(x.shape[1]):
        total += x[:, j] * q[..., j]
    return total


class Index:
    """Projection and the cells of the top tree; small, so it travels with the tasks."""

    def __init__(self, sample: np.ndarray, top: float, dim: int, rows: int):
        rng = np.random.default_rng(SEED)
        self.dim, self.top = dim, top
        self.matrix = rng.standard_normal((dim + 1, DIMS))
        self.sample = sample
        self.cuts: list[tuple[int, float]] = []  # heap order: node i has children 2 i + 1 and 2 i + 2
        depth = 0
        while 2 ** (depth + 1) <= CELLS and rows / 2**depth > BLOCK and len(sample) / 2**depth >= 16:
            depth += 1
        self.depth = depth
        parts = [self.project(self.lift(sample))]
        for _ in range(depth):
            below = []
            for p in parts:
                axis = int(np.argmax(np.var(p, axis=0))) if len(p) else 0
                at = float(np.median(p[:, axis])) if len(p) else 0.0
                self.cuts.append((axis, at))
                below += [p[p[:, axis] < at], p[p[:, axis] >= at]]
            parts = below

    def lift(self, x: np.ndarray) -> np.ndarray:
        """Candidates with the component that gives all of them the largest length."""
        rest = np.maximum(self.top**2 - (x * x).sum(1), 0.0)
        return np.concatenate([x, np.sqrt(rest)[:, None]], axis=1)

    def project(self, x: np.ndarray) -> np.ndarray:
        if x.shape[1] == self.dim:  # a query: zero in the added place
            return x @ self.matrix[:-1]
        return x @ self.matrix

    def cell(self, p: np.ndarray) -> np.ndarray:
        node = np.zeros(len(p), np.int64)
        for _ in range(self.depth):
            axis = np.array([c[0] for c in self.cuts])[node]
            at = np.array([c[1] for c in self.cuts])[node]
            node = 2 * node + 1 + (p[np.arange(len(p)), axis] >= at)
        return node - (2**self.depth - 1)

    def boxes(self) -> tuple[np.ndarray, np.ndarray]:
        """Lower and upper corners of the cells."""
        lo, hi = [np.full(DIMS, -np.inf)], [np.full(DIMS, np.inf)]
        cuts = iter(self.cuts)
        for _ in range(self.depth):
            nlo, nhi = [], []
            for a, b in zip(lo, hi, strict=True):
                axis, at = next(cuts)
                left, right = b.copy(), a.copy()
                left[axis], right[axis] = min(b[axis], at), max(a[axis], at)
                nlo += [a, right]
                nhi += [left, b]
            lo, hi = nlo, nhi
        return np.array(lo), np.array(hi)


def box_distance(p: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
    """Squared distances of one point to boxes."""
    return (np.maximum(np.maximum(lo - p, p - hi), 0.0) ** 2).sum(-1)


class BlockTree:
    """A kd-tree over one block's projected vectors: leaves of ``LEAF`` rows and their boxes."""

    def __init__(self, p: np.ndarray):
        leaves, todo = [], [np.arange(len(p))]
        while todo:
            rows = todo.pop()
            if len(rows) <= LEAF:
                leaves.append(rows)
                continue
            axis = int(np.argmax(np.ptp(p[rows], axis=0)))
            rows = rows[np.argsort(p[rows, axis], kind="stable")]
            todo += [rows[: len(rows) // 2], rows[len(rows) // 2:]]
        self.rows = np.concatenate(leaves)
        self.ends = np.cumsum([len(x) for x in leaves])
        self.lo = np.array([p[x].min(0) for x in leaves])
        self.hi = np.array([p[x].max(0) for x in leaves])


def _best(n: np.ndarray, i: np.ndarray, v: np.ndarray, k: int) -> np.ndarray:
    """Places of the first ``k`` by score, then id, of every query number in ``n``; in order."""
    order = np.lexsort((i, -v, n))
    first = np.searchsorted(n[order], n[order], "left")
    return order[np.arange(len(order)) - first < k]


def query_groups(counts: dict[int, int], cells: int, most: int) -> tuple[list[int], list[int]]:
    """First group and number of groups for the queries of every home cell: consecutive cells,
    which are neighbours in the tree, share a group of ``most`` queries; larger ones take several."""
    first, lanes, at, held = [], [], 0, 0
    for c in range(cells):
        n = counts.get(c, 0)
        if held and held + n > most:
            at, held = at + 1, 0
        first.append(at)
        lanes.append(max(1, -(-n // most)))
        held += n
        if n > most:
            at, held = at + lanes[-1], 0
    return first, lanes


def search_block(ids: np.ndarray, x: np.ndarray, qids: np.ndarray, q: np.ndarray, bounds: np.ndarray, index: Index,
                 k: int = K, confidence: float = CONFIDENCE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The ``k`` nearest found in one block for each query: places of the queries, ids, scores.

    All queries advance together: in a round each takes its next few leaves,
    and a leaf is multiplied once with all queries that take it.
    """
    limit = chi_square_quantile(confidence, DIMS)
    tree = BlockTree(index.project(index.lift(x)))
    ids, x = ids[tree.rows], x[tree.rows]
    starts = np.concatenate([[0], tree.ends[:-1]])
    pq = index.project(q)
    away = np.stack([box_distance(pq, lo, hi) for lo, hi in zip(tree.lo, tree.hi, strict=True)], axis=1)
    order = np.argsort(away, axis=1, kind="stable")
    length = index.top**2 + (q * q).sum(1)
    worst = bounds.astype(np.float64)
    n, i, v = np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0)
    at, stride = 0, 4
    while at < len(starts):
        take = order[:, at : at + stride]
        # Stop for a query: its next leaf is farther than the test allows for its k-th distance.
        reach = limit * np.maximum(length - 2 * worst, 0.0)
        due = np.zeros(away.shape, bool)
        np.put_along_axis(due, take, np.take_along_axis(away, take, 1) <= reach[:, None], 1)
        if not due.any():
            break
        hit_q, hit_x = [], []
        for leaf in np.nonzero(due.any(0))[0]:
            who = np.nonzero(due[:, leaf])[0]
            rough = q[who] @ x[starts[leaf] : tree.ends[leaf]].T
            floor = worst[who] - 1e-9 * (1 + np.abs(np.where(np.isfinite(worst[who]), worst[who], 0.0)))
            a, b = np.nonzero(rough >= floor[:, None])
            hit_q.append(who[a])
            hit_x.append(starts[leaf] + b)
        hq, hx = np.concatenate(hit_q), np.concatenate(hit_x)
        other = ids[hx] != qids[hq]
        hq, hx = hq[other], hx[other]
        n, i, v = np.concatenate([n, hq]), np.concatenate([i, ids[hx]]), np.concatenate([v, inner(x[hx], q[hq])])
        keep = _best(n, i, v, k)
        n, i, v = n[keep], i[keep], v[keep]
        count = np.bincount(n, minlength=len(q))
        full = count == k
        lowest = np.full(len(q), np.inf)
        np.minimum.at(lowest, n, v)
        worst = np.where(full, np.maximum(worst, lowest), worst)
        at, stride = at + stride, 2 * stride
    return n, i, v


def nearest(table: DataFrame, is_query: Column, k: int = K, confidence: float = CONFIDENCE, vec_id: str = "vec_id",
            embedding: str = "embedding") -> DataFrame:
    """``query_id, rank, vec_id, score, query_hash`` of the ``k`` nearest found for every query row.

    ``is_query`` is a condition on the column ``vec_id``.
    """
    spark = table.sparkSession
    schema = "query_id long, rank int, vec_id long, score double, query_hash long"
    vectors = stored(valid_vectors(table, vec_id, embedding), "vectors")
    lengths = vectors.groupBy(F.size("v").alias("d")).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), F.desc("d")).first()
    if lengths is None:
        return spark.createDataFrame([], schema)
    dim, rows = lengths["d"], lengths["n"]
    vectors = vectors.filter(F.size("v") == dim)
    square = lambda x: F.aggregate(x, F.lit(0.0), lambda a, c: a + c * c)
    top = float(vectors.agg(F.max(square(F.col("v")))).first()[0]) ** 0.5
    # A share of the rows by hash: nothing is sorted for it, and no partition sends more than its share.
    share = F.pmod(F.xxhash64("vec_id", "v", F.lit(SEED)), F.lit(2**40)) < int(min(1.0, SAMPLE / rows) * 2**40)
    sample = np.array([v for _, v in sorted(map(tuple, vectors.filter(share).collect()))], np.float64).reshape(-1, dim)
    index = Index(sample, top, dim, rows)

    def deal(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            x = np.stack(b["v"].to_numpy()) if len(b) else np.empty((0, dim))
            yield pd.DataFrame({"cell": index.cell(index.project(index.lift(x))), "vec_id": b["vec_id"], "x": packed(x)})

    dealt = stored(vectors.mapInPandas(deal, "cell long, vec_id long, x binary"), "cells")
    sizes = {r["cell"]: r["count"] for r in dealt.groupBy("cell").count().collect()}  # one row per cell
    blocks = [max(1, -(-sizes.get(c, 0) // BLOCK)) for c in range(2**index.depth)]
    by_cell = lambda numbers, cell: F.element_at(F.array(*map(F.lit, numbers)), (F.col(cell) + 1).cast("int")).cast("long")
    lo, hi = index.boxes()
    limit = chi_square_quantile(confidence, DIMS)

    def ask(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            q = np.stack(b["v"].to_numpy()) if len(b) else np.empty((0, dim))
            pq = index.project(q)
            # One of the sample's rows may be the query itself: the k + 1-th bounds the k-th.
            scores = np.sort(q @ index.sample.T, axis=1)
            bound = scores[:, -(k + 1)] if scores.shape[1] > k else np.full(len(q), -np.inf)
            reach = np.maximum(index.top**2 + (q * q).sum(1) - 2 * bound, 0.0)
            asked = [[c for c in np.nonzero(box_distance(pq[n], lo, hi) <= limit * reach[n])[0].tolist() if c in sizes] for n in range(len(q))]
            yield pd.DataFrame({"query_id": b["vec_id"], "query_hash": b["query_hash"], "q": packed(q), "bound": bound,
                                "home": index.cell(pq), "cells": asked})

    asking = vectors.filter(is_query).withColumn("query_hash", F.xxhash64("v"))
    asking = stored(asking.mapInPandas(ask, "query_id long, query_hash long, q binary, bound double, home long, cells array<long>"), "queries")
    homes = {r["home"]: r["count"] for r in asking.groupBy("home").count().collect()}  # one row per cell
    first, lanes = query_groups(homes, 2**index.depth, QUERIES)
    grp = by_cell(first, "home") + F.pmod(F.xxhash64("query_id", "query_hash"), by_cell(lanes, "home"))
    asking = asking.select("query_id", "query_hash", "q", "bound", grp.alias("grp"), F.explode("cells").alias("cell"))
    routes = asking.select("cell", "grp").distinct().groupBy("cell").agg(F.collect_list("grp").alias("grps"))
    routes = stored(routes.withColumn("n", by_cell([sizes.get(c, 0) for c in range(2**index.depth)], "cell")), "routes")
    queries = asking.withColumn("block", F.explode(F.sequence(F.lit(0).cast("long"), by_cell(blocks, "cell") - 1)))
    # A cell's rows are dealt to its blocks by hash, and go to the groups that ask for the cell.
    rows_of = join_per_key(dealt, routes, "cell", rows_per_key="n", hot_rows=HOT_ROWS, salt_by=["vec_id", "x"], how="inner")
    rows_of = rows_of.select("cell", F.pmod(F.xxhash64("vec_id", "x"), by_cell(blocks, "cell")).alias("block"), F.explode("grps").alias("grp"), "vec_id", "x")

    def search(key, left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        if not len(left) or not len(right):
            return pd.DataFrame({"query_id": [], "query_hash": [], "vec_id": [], "score": []}).astype(
                {"query_id": "int64", "query_hash": "int64", "vec_id": "int64", "score": "float64"})
        n, i, s = search_block(left["vec_id"].to_numpy(), unpacked(left["x"], dim), right["query_id"].to_numpy(),
                               unpacked(right["q"], dim), right["bound"].to_numpy(), index, k, confidence)
        return pd.DataFrame({"query_id": right["query_id"].to_numpy()[n], "query_hash": right["query_hash"].to_numpy()[n], "vec_id": i, "score": s})

    keys = ["cell", "block", "grp"]
    found = rows_of.groupBy(*keys).cogroup(queries.groupBy(*keys)).applyInPandas(search, "query_id long, query_hash long, vec_id long, score double")
    rank = F.row_number().over(Window.partitionBy("query_id", "query_hash").orderBy(F.desc("score"), "vec_id"))
    return found.withColumn("rank", rank).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score", "query_hash")


def op9_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest(read_table(spark, sf_dir, "embeddings"), F.col("vec_id") % EVERY == 0)
