"""Hard negatives by an inverted multi-index with certified windows.

Vectors of whole numbers are cut into two halves.  Each half has a codebook, and
the pairs of codes form the cells of the index; each code knows the radius of
the rows that carry it.  For an anchor, a half's score in a code is at most the
score of the centre plus radius times the anchor's length, and at least the same
with minus; a cell's bounds are the sums of its halves' bounds.

Neighbouring cells are packed into shards of bounded size; a cell above that
size is spread over several shards by hash.  An anchor goes to those shards
whose bounds can hold one of its results, given what a sample of all rows holds
already.  In a shard a heap visits pairs of codes in order of their summed upper
bounds (the multi-sequence walk) and stops when the next bound certifies that
nothing later can enter: it lies below the last result kept, or below the
window.  Cells that lie wholly above a window are passed over.  So the lists are
exact.  They are merged over the shards by rank; first the positives, then, with
windows that the positives' scores set, the negatives.

Rows reach a task sorted, a shard's vectors before its anchors, and are read as
a stream: a task holds one shard and one Arrow batch of anchors.

Defined cases: rows with a null id, a null label, a null or empty vector, or a
null or non-finite component take no part; the dimension is the commonest length
(the larger of equally common ones), other lengths take no part; rows that repeat
id, label and vector count once; different rows of one id are rows of their own,
each an anchor if the id is one, and may be each other's positives or negatives;
ties go to the smaller id (then to a hash of the row); an anchor without
positives, or a positive without negatives in its window, gives no rows; an empty
table gives an empty result.  Components so large that an inner product could
leave 63 bits raise a ``ValueError``.
"""

from __future__ import annotations

from collections.abc import Iterator
from heapq import heappop, heappush

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import read_table, stored

POSITIVES, NEGATIVES = 5, 5
#: A negative's score lies between these percentages of its positive's score.
LOW, HIGH = 80, 100
#: Rows on which the codebooks are fitted (about; chosen by hash), codes of a half at most, rows in a shard, anchors in a lane.
SAMPLE, CODES, SHARD, LANE = 4096, 64, 16_384, 262_144
#: Rows of several cells that are scored together.
WAVE = 512
SEED = 11


def taking_part(table: DataFrame, scale: float, vec_id: str, embedding: str, label: Column) -> DataFrame:
    """``vec_id, label, v, key``: the rows that take part, components as whole numbers."""
    rows = table.select(F.col(vec_id).cast("long").alias("vec_id"), label.cast("long").alias("label"),
                        F.col(embedding).cast("array<double>").alias("v"))
    finite = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    fine = F.col("vec_id").isNotNull() & F.col("label").isNotNull() & (F.size("v") > 0) & F.forall("v", finite)
    whole = rows.filter(F.coalesce(fine, F.lit(False))).withColumn("v", F.transform("v", lambda x: F.floor(x * scale).cast("double")))
    return whole.distinct().withColumn("key", F.xxhash64("vec_id", "label", "v"))


def codebook(x: np.ndarray, codes: int, seed: int) -> np.ndarray:
    """Centres of one half by a few rounds of k-means."""
    rng = np.random.default_rng(seed)
    centres = x[rng.choice(len(x), min(codes, len(x)), replace=False)]
    for _ in range(8):
        code = nearest_code(x, centres)[0]
        for c in range(len(centres)):
            if (code == c).any():
                centres[c] = x[code == c].mean(axis=0)
    return centres


def nearest_code(x: np.ndarray, centres: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The nearest centre of each row, and the distance to it."""
    rough = (centres * centres).sum(1) - 2 * (x @ centres.T)
    code = np.argmin(rough, axis=1)
    return code, np.sqrt(((x - centres[code]) ** 2).sum(axis=1))


class MultiIndex:
    """Codebooks, radii and the packing of cells into shards; small, so it travels with the tasks."""

    def __init__(self, centres: list[np.ndarray], dim: int, kind: str, wide: bool):
        self.centres, self.dim, self.half = centres, dim, dim // 2
        self.kind, self.wide = kind, wide

    def vectors(self, packed: pd.Series) -> np.ndarray:
        x = np.frombuffer(b"".join(packed), self.kind).reshape(-1, self.dim)
        return x.astype(np.int64 if self.wide else np.float64)

    def halves(self, x: np.ndarray) -> list[np.ndarray]:
        return [x[:, : self.half].astype(np.float64), x[:, self.half :].astype(np.float64)]

    def pack(self, radii: list[np.ndarray], sizes: dict[tuple[int, int], int], shard: int) -> None:
        """Deal the cells in order to shards of at most ``shard`` rows."""
        self.radii = radii
        self.cells = np.array(sorted(sizes), np.int64).reshape(-1, 2)
        self.first, self.parts = np.zeros(len(self.cells), np.int64), np.ones(len(self.cells), np.int64)
        at, held = 0, 0
        for k, cell in enumerate(map(tuple, self.cells.tolist())):
            n = sizes[cell]
            if held and held + n > shard:
                at, held = at + 1, 0
            self.first[k] = at
            held += n
            if n > shard:
                self.parts[k] = -(-n // shard)
                at, held = at + int(self.parts[k]), 0
        self.shards = at + (held > 0)
        self.place = {c: k for k, c in enumerate(map(tuple, self.cells.tolist()))}

    def bounds(self, a: np.ndarray) -> tuple[list[np.ndarray], list[np.ndarray]]:
        """Upper and lower bounds of each half's score in each code, for rows of anchors."""
        upper, lower = [], []
        for x, centres, radius in zip(self.halves(a), self.centres, self.radii, strict=True):
            middle, away = x @ centres.T, np.sqrt((x * x).sum(axis=1))[:, None] * radius
            slack = 1e-9 * (np.abs(middle) + away) + 1e-6  # rounding of floating point
            upper.append(middle + away + slack)
            lower.append(middle - away - slack)
        return upper, lower

    def cell_bounds(self, a: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        upper, lower = self.bounds(a)
        i, j = self.cells.T
        return upper[0][:, i] + upper[1][:, j], lower[0][:, i] + lower[1][:, j]

    def shards_of(self, wanted: np.ndarray) -> Iterator[np.ndarray]:
        """Shards that hold a wanted cell, for each row of a table of flags."""
        for row in wanted:
            yield np.unique(np.concatenate([np.arange(f, f + p) for f, p in zip(self.first[row], self.parts[row], strict=True)])
                            if row.any() else np.arange(0))


class Shard:
    """The vectors of one shard, in order of their cells."""

    def __init__(self, index: MultiIndex, rows: pd.DataFrame):
        rows = rows.sort_values(["i", "j", "id", "key"], kind="stable")
        self.index, self.x = index, index.vectors(rows["x"])
        self.ids, self.keys, self.labels = (rows[c].to_numpy(np.int64) for c in ("id", "key", "label"))
        pair = rows[["i", "j"]].to_numpy(np.int64)
        self.codes = [np.unique(pair[:, h]) for h in (0, 1)]
        head = np.nonzero(np.concatenate([[True], (pair[1:] != pair[:-1]).any(axis=1)]))[0]
        end = np.append(head[1:], len(pair))
        self.cells = {tuple(pair[s].tolist()): (int(s), int(e)) for s, e in zip(head, end, strict=True)}

    def walk(self, upper: list[np.ndarray]) -> Iterator[tuple[float, tuple[int, int]]]:
        """Cells by falling upper bound: the multi-sequence walk over both halves' sorted codes."""
        u = [b[c] for b, c in zip(upper, self.codes, strict=True)]
        order = [np.argsort(-b, kind="stable") for b in u]
        u, code = [b[o] for b, o in zip(u, order, strict=True)], [c[o].tolist() for c, o in zip(self.codes, order, strict=True)]
        left, right = u[0].tolist(), u[1].tolist()
        heap, seen = [(-(left[0] + right[0]), 0, 0)], {(0, 0)}
        while heap:
            bound, p, q = heappop(heap)
            yield -bound, (code[0][p], code[1][q])
            for nxt in ((p + 1, q), (p, q + 1)):
                if nxt[0] < len(left) and nxt[1] < len(right) and nxt not in seen:
                    seen.add(nxt)
                    heappush(heap, (-(left[nxt[0]] + right[nxt[1]]), *nxt))

    def search(self, a: np.ndarray, upper: list[np.ndarray], lower: list[np.ndarray], tops: list["Top"]) -> None:
        """Fill the lists of one anchor; each says which rows and scores it takes."""
        rows: list[np.ndarray] = []
        held = 0

        def score() -> None:
            nonlocal held
            at = np.concatenate(rows)
            s = self.x[at] @ a
            for t in tops:
                t.offer(at, s)
            rows.clear()
            held = 0

        ceiling = max(t.high for t in tops)
        for bound, (i, j) in self.walk(upper):
            if all(t.closed(bound) for t in tops):
                break
            cell = self.cells.get((i, j))
            if cell is None or lower[0][i] + lower[1][j] > ceiling:
                continue
            rows.append(np.arange(*cell))
            held += cell[1] - cell[0]
            if held >= WAVE:
                score()
        if rows:
            score()


class Top:
    """The first ``k`` rows of a shard that ``takes`` allows, with scores from ``low`` to ``high``."""

    def __init__(self, shard: Shard, takes: np.ndarray, k: int, low: float = -np.inf, high: float = np.inf):
        self.shard, self.takes, self.k, self.low, self.high = shard, takes, k, low, high
        self.at, self.score = np.empty(0, np.int64), np.empty(0, shard.x.dtype)

    def closed(self, bound: float) -> bool:
        """Whether no score up to ``bound`` can enter any more."""
        return bound < self.low or (len(self.at) == self.k and bound < self.score[-1])

    def offer(self, at: np.ndarray, score: np.ndarray) -> None:
        keep = self.takes[at] & (score >= self.low) & (score <= self.high)
        at, score = np.concatenate([self.at, at[keep]]), np.concatenate([self.score, score[keep]])
        first = np.lexsort((self.shard.keys[at], self.shard.ids[at], -score))[: self.k]
        self.at, self.score = at[first], score[first]


FOUND = ("anchor_id long, anchor_key long, positive_id long, positive_key long, positive_score long, "
         "vec_id long, key long, score long")


def _searcher(index: MultiIndex, positives: int, negatives: int, low: int, high: int):
    """Stream over sorted rows: the vectors of a shard, then the anchors that ask it."""
    def answers(shard: Shard, anchors: pd.DataFrame) -> pd.DataFrame:
        out = []
        a = index.vectors(anchors["x"])
        upper, lower = index.bounds(a)
        takes = {}
        for n, (aid, akey, label, wins) in enumerate(zip(anchors["id"], anchors["key"], anchors["label"], anchors["windows"], strict=True)):
            u, w = [b[n] for b in upper], [b[n] for b in lower]
            if wins is None or not len(wins):
                same = (shard.labels == label) & ((shard.keys != akey) | (shard.ids != aid))
                tops, of = [Top(shard, same, positives)], [(0, 0, 0)]
            else:
                if label not in takes:
                    takes[label] = shard.labels != label
                of = [(p["positive_id"], p["positive_key"], p["positive_score"]) for p in wins]
                # ceil and floor of the percentages, in whole numbers
                tops = [Top(shard, takes[label], negatives, -(-low * s // 100), high * s // 100) for _, _, s in of]
            shard.search(a[n], u, w, tops)
            for t, (pid, pkey, ps) in zip(tops, of, strict=True):
                out += [(aid, akey, pid, pkey, ps, i, k, s) for i, k, s in zip(
                    shard.ids[t.at].tolist(), shard.keys[t.at].tolist(), t.score.astype(np.int64).tolist(), strict=True)]
        return pd.DataFrame(out, columns=[c.split()[0] for c in FOUND.split(", ")])

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        now, rows, shard = None, [], None
        for b in batches:
            place = b[["shard", "lane", "asks"]].to_numpy(np.int64)
            head = np.nonzero(np.concatenate([[True], (place[1:] != place[:-1]).any(axis=1)]))[0] if len(b) else []
            for s, e in zip(head, [*head[1:], len(b)], strict=False):
                part, key = b.iloc[s:e], (int(place[s][0]), int(place[s][1]))
                if key != now:
                    now, rows, shard = key, [], None
                if not place[s][2]:
                    rows.append(part)
                elif rows or shard:
                    if shard is None:
                        shard, rows = Shard(index, pd.concat(rows)), []
                    yield answers(shard, part)

    return run


def hard_negatives(table: DataFrame, is_anchor: Column, *, scale: float = 256.0, label: Column | None = None, positives: int = POSITIVES,
                   negatives: int = NEGATIVES, low: int = LOW, high: int = HIGH, vec_id: str = "vec_id", embedding: str = "embedding",
                   shard_rows: int = SHARD, lane: int = LANE, codes: int | None = None) -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score, negative_score``.

    ``is_anchor`` is a condition on the column ``vec_id``; components become
    ``floor(scale * x)``.  An anchor's positives are its first ``positives``
    other rows of the same label by inner product; each gets its first
    ``negatives`` rows of another label that score between ``low`` and ``high``
    percent of the positive's score.
    """
    spark = table.sparkSession
    out_schema = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
    rows = stored(taking_part(table, scale, vec_id, embedding, F.col("label") if label is None else label), "negatives-rows")
    biggest = F.max(F.greatest(F.array_max("v"), -F.array_min("v"))).alias("m")
    length = rows.groupBy(F.size("v").alias("d")).agg(F.count(F.lit(1)).alias("n"), biggest).orderBy(F.desc("n"), F.desc("d")).first()
    if length is None:
        return spark.createDataFrame([], out_schema)
    dim, n, biggest = length["d"], length["n"], length["m"]
    if dim * biggest * biggest >= 2**63:
        raise ValueError("components too large: an inner product could leave 63 bits")
    kind = next(k for k, most in (("<i2", 2**15), ("<i4", 2**31), ("<i8", 2**63)) if biggest < most)
    rows = rows.filter(F.size("v") == dim)
    # A share of the rows by hash: nothing is sorted for it, and no partition sends more than its share.
    share = min(1.0, SAMPLE / n)
    sample = rows.filter(F.pmod(F.xxhash64("key", F.lit(SEED)), F.lit(1_000_000)) < round(share * 1_000_000)).collect()
    sample = sample or rows.limit(1).collect()
    sx = np.array([r["v"] for r in sample], np.float64)
    s_labels, s_keys = (np.array([r[c] for r in sample], np.int64) for c in ("label", "key"))
    k = codes or int(np.clip(round((n / 256) ** 0.5), 2, CODES))
    half = dim // 2
    index = MultiIndex([codebook(sx[:, :half], k, SEED), codebook(sx[:, half:], k, SEED + 1)], dim, kind, dim * biggest * biggest >= 2**53)

    def deal(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            x = np.stack(b["v"].to_numpy()) if len(b) else np.empty((0, dim))
            (i, di), (j, dj) = (nearest_code(h, c) for h, c in zip(index.halves(x), index.centres, strict=True))
            packed = [r.tobytes() for r in x.astype(kind)]
            yield pd.DataFrame({"id": b["vec_id"], "key": b["key"], "label": b["label"], "x": packed, "i": i, "j": j, "di": di, "dj": dj})

    cells = stored(rows.mapInPandas(deal, "id long, key long, label long, x binary, i long, j long, di double, dj double"), "negatives-cells")
    radii = []
    for code, away, centres in (("i", "di", index.centres[0]), ("j", "dj", index.centres[1])):
        radius = np.zeros(len(centres))
        for r in cells.groupBy(code).agg(F.max(away).alias("r")).collect():  # one row per code
            radius[r[code]] = r["r"] * (1 + 1e-9) + 1e-6
        radii.append(radius)
    index.pack(radii, {(r["i"], r["j"]): r["count"] for r in cells.groupBy("i", "j").count().collect()}, shard_rows)  # at most CODES ** 2 rows

    asks = "shard long, id long, key long, label long, x binary, windows array<struct<positive_id: long, positive_key: long, positive_score: long>>"

    def place(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            cell = [index.place[c] for c in zip(b["i"], b["j"], strict=True)]
            part = b["key"].to_numpy(np.int64) % index.parts[cell]
            yield pd.DataFrame({"shard": index.first[cell] + part, "id": b["id"], "key": b["key"], "label": b["label"], "x": b["x"], "i": b["i"], "j": b["j"]})

    def ask(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """An anchor once for each shard that can hold one of its results."""
        for whole in batches:
            for at in range(0, len(whole), 256):
                b = whole.iloc[at : at + 256]
                a = index.vectors(b["x"])
                upper, lower = index.cell_bounds(a)
                known = a.astype(np.float64) @ sx.T
                label, key = b["label"].to_numpy(np.int64), b["key"].to_numpy(np.int64)
                wanted = np.zeros(upper.shape, bool)
                for m, wins in enumerate(b["windows"]):
                    if wins is None or not len(wins):
                        wanted[m] = upper[m] >= _kth(known[m][(s_labels == label[m]) & (s_keys != key[m])], positives)
                        continue
                    for p in wins:
                        lo, hi = -(-low * p["positive_score"] // 100), high * p["positive_score"] // 100
                        rest = known[m][(s_labels != label[m]) & (known[m] >= lo) & (known[m] <= hi)]
                        if lo <= hi:
                            wanted[m] |= (upper[m] >= max(lo, _kth(rest, negatives))) & (lower[m] <= hi)
                shards = list(index.shards_of(wanted))
                again = np.repeat(np.arange(len(b)), [len(s) for s in shards])
                yield b.iloc[again].assign(shard=np.concatenate(shards))[["shard", "id", "key", "label", "x", "windows"]]

    placed = cells.mapInPandas(place, "shard long, id long, key long, label long, x binary, i long, j long")
    anchors = cells.withColumnRenamed("id", "vec_id").filter(is_anchor).withColumnRenamed("vec_id", "id")
    none = F.lit(None).cast("array<struct<positive_id: long, positive_key: long, positive_score: long>>").alias("windows")
    lanes = max(1, -(-anchors.count() // lane))

    def search(asking: DataFrame) -> DataFrame:
        anchor_rows = asking.mapInPandas(ask, asks).select(
            "shard", F.pmod(F.xxhash64("key"), F.lit(lanes)).alias("lane"), F.lit(1).alias("asks"), "id", "key", "label", "x",
            F.lit(None).cast("long").alias("i"), F.lit(None).cast("long").alias("j"), "windows")
        vector_rows = placed.select("shard", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(lanes - 1).cast("long"))).alias("lane"), F.lit(0).alias("asks"),
                                    "id", "key", "label", "x", "i", "j", none)
        dealt = vector_rows.unionByName(anchor_rows).repartition(max(1, index.shards * lanes), "shard", "lane").sortWithinPartitions("shard", "lane", "asks")
        return dealt.mapInPandas(_searcher(index, positives, negatives, low, high), FOUND)

    first = Window.partitionBy("anchor_id", "anchor_key").orderBy(F.desc("score"), "vec_id", "key")
    found = search(anchors.select("id", "key", "label", "x", none))
    found = stored(found.withColumn("rank", F.row_number().over(first)).filter(F.col("rank") <= positives), "negatives-positives")
    window = F.struct(F.col("vec_id").alias("positive_id"), F.col("key").alias("positive_key"), F.col("score").alias("positive_score"))
    windows = (found.filter(F.col("score") >= 0).groupBy(F.col("anchor_id").alias("id"), F.col("anchor_key").alias("key"))
               .agg(F.collect_list(window).alias("windows")))  # at most ``positives`` of an anchor
    mined = search(anchors.select("id", "key", "label", "x").join(windows, ["id", "key"]))
    each = Window.partitionBy("anchor_id", "anchor_key", "positive_id", "positive_key").orderBy(F.desc("score"), "vec_id", "key")
    return (mined.withColumn("rank", F.row_number().over(each)).filter(F.col("rank") <= negatives)
            .select("anchor_id", "positive_id", "rank", F.col("vec_id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score")))


def _kth(scores: np.ndarray, k: int) -> float:
    """The ``k``-th largest score; minus infinity if there are fewer."""
    return float(np.partition(scores, -k)[-k]) if len(scores) >= k else -np.inf


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives(read_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0, label=label)


OP11_SQL = """
with whole as (
  select distinct vec_id, case when vec_id % 7 = 0 then (label + 1) % 10 else label end as label,
         list_transform(embedding, lambda x: floor(256 * x::double)::bigint) as v
  from embeddings
  where vec_id is not null and label is not null and embedding is not null and len(embedding) > 0
    and len(list_filter(embedding, lambda x: x is not null and isfinite(x))) = len(embedding)),
scored as (
  select a.vec_id as anchor_id, b.vec_id as vec_id, a.label = b.label as same, list_dot_product(a.v::double[], b.v::double[])::bigint as score
  from whole a, whole b where a.vec_id % 100 = 0 and a.vec_id <> b.vec_id),
positives as (
  select * from scored where same
  qualify row_number() over (partition by anchor_id order by score desc, vec_id) <= 5),
mined as (
  select p.anchor_id, p.vec_id as positive_id, n.vec_id as negative_id, p.score as positive_score, n.score as negative_score,
         row_number() over (partition by p.anchor_id, p.vec_id order by n.score desc, n.vec_id)::integer as rank
  from positives p join scored n on n.anchor_id = p.anchor_id and not n.same
   and 80 * p.score <= 100 * n.score and 100 * n.score <= 100 * p.score)
select anchor_id, positive_id, rank, negative_id, positive_score, negative_score from mined where rank <= 5
"""
