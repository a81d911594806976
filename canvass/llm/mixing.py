"""Mixing sources to target weights by entropy balancing.

Every document gets a rate between 0 and ``max_copies``.  Among all rates whose
expected tokens meet each source's target, the ones of largest entropy are
``max_copies * sigmoid(lambda_s * size / mean size of the source)``: the odds of
a copy are tilted exponentially in the document's size.  The multipliers solve
the convex dual, one per source, by Newton steps kept inside a shrinking
bracket; a step is one aggregation over the counts of equal sizes, and the
multipliers stay in a table, however many sources there are.  Rates are then
rounded to whole copies by systematic rounding along the documents in order of
size, so that the taken tokens of a source stay within a few documents of its
target; what is left is settled by moving single copies, largest first.

Defined cases: a null text has size 0; null sources are a source of their own,
last in order; documents of size 0 and all documents of an empty corpus take 0
tokens; repeated rows are documents of their own; with equal sizes the order is
by hashes of doc_id and text, so reruns agree; an empty table gives an empty
result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import ROW_KEY, discard, read_table, row_key, scratch_path, stored, word_count

WEIGHTS = (5.0, 2.0, 1.0)
SHARE = 1.5
MAX_COPIES = 2
STEPS = 60
#: A source is balanced when its expected tokens are this close to the target, relatively.
TOLERANCE = 1e-12
#: After the last step a source may be this far off (rounding of large sums); beyond it the dual is not solved.
LOOSE = 1e-6
#: Multipliers are rounded to so many decimals: sums in another order then give the same rates.
DECIMALS = 8
#: Documents of one source and size that are ranked together.
BUCKET = 50_000


def sized(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source") -> DataFrame:
    """``doc_id, source, size, h, th``: words and two hashes that break ties."""
    return docs.select(F.col(doc_id).alias("doc_id"), F.col(source).alias("source"), word_count(F.col(text)).alias("size"),
                       F.xxhash64(doc_id).alias("h"), F.xxhash64(text).alias("th"))


def targets(sizes: DataFrame, weights: tuple[float, ...] = WEIGHTS, share: float = SHARE,
            max_copies: int = MAX_COPIES) -> DataFrame:
    """``source, n, source_size, target`` per source.

    Weights repeat along the sources in code-point order, null last.  A target
    stops at ``max_copies`` times its source; the excess goes to the others by
    weight.  In order of size per weight the stopped sources are a prefix, so
    running sums over that order give the level at which the rest shares.
    """
    per = sizes.groupBy("source").agg(F.count(F.lit(1)).alias("n"), F.sum("size").alias("source_size"))
    per = stored(per, "sources")
    ranked = _numbered(per.orderBy(F.col("source").isNull(), "source"))
    weight = F.element_at(F.array(*map(F.lit, weights)), (F.pmod("place", F.lit(len(weights))) + 1).cast("int"))
    w = stored(ranked.withColumn("w", weight), "weights")
    total = (w.agg(F.sum("source_size")).first()[0] or 0) * share
    cap = F.col("source_size") * float(max_copies)
    # Fix the capped sources round by round: each round is one small aggregation.
    level, last = None, -1
    while True:
        capped = F.lit(False) if level is None else cap <= F.col("w") * F.lit(level)
        row = w.agg(F.sum(F.when(capped, cap).otherwise(0.0)).alias("fixed"), F.sum(F.when(capped, 0.0).otherwise(F.col("w"))).alias("w"),
                    F.sum(F.when(capped, 1).otherwise(0)).alias("n")).first()
        if row["n"] == last or not row["w"]:
            break
        last, level = row["n"], (total - row["fixed"]) / row["w"]
    share_of = F.lit(0.0) if level is None else F.least(cap, F.col("w") * F.lit(level))
    return w.select("source", "n", "source_size", share_of.alias("target"))


def _numbered(ordered: DataFrame) -> DataFrame:
    """Rows of a sorted table with their place: offsets of its partitions plus a rank inside each."""
    kept = stored(ordered.withColumn("part", F.spark_partition_id()), "ordered")
    counts = kept.groupBy("part").agg(F.count(F.lit(1)).alias("c"))
    before = counts.select("part", (F.sum("c").over(Window.orderBy("part")) - F.col("c")).alias("offset"))  # one row per partition
    inside = F.row_number().over(Window.partitionBy("part").orderBy(F.col("source").isNull(), "source")) - 1
    return kept.withColumn("i", inside).join(before, "part").withColumn("place", F.col("offset") + F.col("i")).drop("part", "i", "offset")


def _rate(lam: Column, z: Column, max_copies: int) -> Column:
    return float(max_copies) / (1.0 + F.exp(-lam * z))


def balance(hist: DataFrame, goal: DataFrame, max_copies: int = MAX_COPIES, steps: int = STEPS) -> DataFrame:
    """``source, lam, mean`` per source: the multipliers of the dual.

    ``hist`` has ``source, size, c`` (documents of that size); ``goal`` is
    :func:`targets`.  A null multiplier stands for plus infinity (the target
    takes all that is allowed).
    """
    spark = hist.sparkSession
    mean = F.col("source_size") / F.col("n")
    full = F.col("target") >= F.col("source_size") * float(max_copies) * (1 - 1e-12)
    state = goal.filter((F.col("source_size") > 0) & ~full).select(
        F.col("source").alias("s"), mean.alias("mean"), (F.col("target") / mean).alias("y"),
        F.lit(0.0).alias("lam"), F.lit(-1e6).alias("lo"), F.lit(1e6).alias("hi"), F.lit(1.0).alias("off"))
    path = scratch_path(spark, "dual")
    state = stored(state, "dual", path)
    for _ in range(steps):
        z = F.col("size") / F.col("mean")
        r = _rate(F.col("lam"), z, max_copies)
        sums = hist.filter("size > 0").join(state, hist["source"].eqNullSafe(state["s"])).groupBy("s", "mean", "y", "lam", "lo", "hi").agg(
            F.sum(F.col("c") * z * r).alias("g"), F.sum(F.col("c") * z * z * r * (1 - r / max_copies)).alias("slope"))
        gap = F.col("g") - F.col("y")
        lo, hi = F.when(gap < 0, F.col("lam")).otherwise(F.col("lo")), F.when(gap > 0, F.col("lam")).otherwise(F.col("hi"))
        moved = sums.select("s", "mean", "y", "lam", lo.alias("lo"), hi.alias("hi"), (F.abs(gap) / F.col("y")).alias("off"),
                            F.when(F.col("slope") > 0, F.col("lam") - gap / F.col("slope")).alias("newton"))
        inside = (F.col("newton") > F.col("lo")) & (F.col("newton") < F.col("hi"))
        step = F.when(F.coalesce(inside, F.lit(False)), F.col("newton")).otherwise((F.col("lo") + F.col("hi")) / 2)
        nxt_path = scratch_path(spark, "dual")
        nxt = stored(moved.select("s", "mean", "y", F.when(F.col("off") <= TOLERANCE, F.col("lam")).otherwise(step).alias("lam"),
                                  "lo", "hi", "off"), "dual", nxt_path)
        discard(spark, path)
        state, path = nxt, nxt_path
        off = state.agg(F.max("off")).first()[0] or 0.0
        if off <= TOLERANCE:
            break
    if off > LOOSE:
        raise RuntimeError(f"after {steps} steps a source is still {off:.1e} off its target")
    found = state.select(F.col("s"), F.round("lam", DECIMALS).alias("lam"))
    return goal.join(found, goal["source"].eqNullSafe(found["s"]), "left").select("source", mean.alias("mean"), "lam")


def mix(docs: DataFrame, weights: tuple[float, ...] = WEIGHTS, share: float = SHARE, max_copies: int = MAX_COPIES,
        doc_id: str = "doc_id", text: str = "text", source: str = "source") -> DataFrame:
    """``doc_id, source, size, source_size, target, rate, copies, taken, h, th`` per document."""
    spark = docs.sparkSession
    sizes = stored(sized(docs, doc_id, text, source), "sizes")
    goal = stored(targets(sizes, weights, share, max_copies), "targets")
    hist = stored(sizes.groupBy("source", "size").agg(F.count(F.lit(1)).alias("c")), "hist")
    lams = balance(hist, goal, max_copies).withColumnsRenamed({"source": "s2"})
    goal = goal.withColumnsRenamed({"source": "s1"})
    plan = goal.join(lams, goal["s1"].eqNullSafe(lams["s2"])).select("s1", "source_size", "target", "mean", "lam")
    z = F.col("size") / F.col("mean")
    rate = F.when(F.col("size") == 0, 0.0).when(F.col("lam").isNull(), float(max_copies)).otherwise(_rate(F.col("lam"), z, max_copies))
    rated = hist.join(plan, hist["source"].eqNullSafe(plan["s1"])).withColumn("rate", rate)
    # Classes of one source and size, in buckets of a bounded number of documents.
    rated = rated.withColumn("buckets", F.ceil(F.col("c") / BUCKET).cast("int"))
    rated = stored(rated.select("source", "size", "c", "source_size", "target", "rate", "buckets"), "rated")
    classes = rated.withColumnsRenamed({"source": "s", "size": "z"}).drop("c")
    placed = sizes.join(classes, sizes["source"].eqNullSafe(classes["s"]) & (sizes["size"] == classes["z"]))
    placed = stored(placed.withColumn("bucket", F.pmod(F.xxhash64("h", "th"), F.col("buckets"))).drop("s", "z", "buckets"), "placed")
    runs = placed.groupBy("source", "size", "bucket", "rate").agg(F.count(F.lit(1)).alias("k"))
    along = Window.partitionBy("source").orderBy("size", "bucket").rowsBetween(Window.unboundedPreceding, -1)
    # Expected copies before each bucket, from a start that is fixed for each source.
    start = F.pmod(F.xxhash64(F.col("source"), F.lit("start")), F.lit(1 << 20)) / float(1 << 20)
    before = runs.select(F.col("source").alias("s"), F.col("size").alias("z"), F.col("bucket").alias("b"),
                         (start + F.coalesce(F.sum(F.col("k") * F.col("rate")).over(along), F.lit(0.0))).alias("before"))
    rank = F.row_number().over(Window.partitionBy("source", "size", "bucket").orderBy("h", "th", "doc_id"))
    ranked = placed.withColumn("j", rank)
    out = ranked.join(before, ranked["source"].eqNullSafe(before["s"]) & (ranked["size"] == before["z"]) & (ranked["bucket"] == before["b"]))
    upto = lambda j: F.floor(F.col("before") + j * F.col("rate") + 1e-9)
    copies = F.least(F.lit(max_copies), upto(F.col("j")) - upto(F.col("j") - 1)).cast("int")
    drawn = stored(out.select("doc_id", "source", "size", "bucket", "source_size", "target", "rate", copies.alias("copies"), "h", "th"), "drawn")
    out = _settle(drawn, max_copies)
    return out.select("doc_id", "source", "size", "source_size", "target", "rate", "copies",
                      (F.col("copies") * F.col("size")).cast("long").alias("taken"), "h", "th")


def _settle(drawn: DataFrame, max_copies: int) -> DataFrame:
    """Move single copies until a source misses its target by less than any move could mend.

    A source's rest (a few documents' tokens) is paid off largest size first;
    the choice is made on counts of equal sizes, then applied by rank.
    """
    gap = drawn.groupBy("source").agg((F.round(F.first("target")) - F.sum(F.col("copies") * F.col("size"))).cast("long").alias("gap"))
    gap = gap.select(F.col("source").alias("s"), "gap")
    free = (F.col("size") > 0) & (F.col("size") <= F.abs("gap")) & F.when(F.col("gap") > 0, F.col("copies") < max_copies).otherwise(F.col("copies") > 0)
    pool = drawn.join(gap, drawn["source"].eqNullSafe(gap["s"])).filter(free).groupBy("source", "gap", "size", "bucket").agg(F.count(F.lit(1)).alias("c"))
    lists = pool.groupBy("source", "gap").agg(F.sort_array(F.collect_list(F.struct("size", "bucket", "c")), asc=False).alias("pool"))
    none = F.array().cast("array<struct<size:bigint,bucket:bigint,k:bigint>>")
    take = lambda acc, x: F.least(x["c"], F.floor(acc["rest"] / x["size"]).cast("long"))
    walk = lambda acc, x: F.when(acc["rest"] < x["size"], acc).otherwise(F.struct(
        (acc["rest"] - take(acc, x) * x["size"]).alias("rest"),
        F.concat(acc["picks"], F.array(F.struct(x["size"].alias("size"), x["bucket"].cast("long").alias("bucket"), take(acc, x).alias("k")))).alias("picks")))
    picks = F.aggregate("pool", F.struct(F.abs("gap").alias("rest"), none.alias("picks")), walk, lambda acc: acc["picks"])
    moves = lists.select(F.col("source").alias("s"), F.signum("gap").cast("int").alias("sign"), F.inline(picks))
    moves = moves.withColumnsRenamed({"size": "z", "bucket": "b"})
    able = F.when(F.col("sign") > 0, F.col("copies") < max_copies).otherwise(F.col("copies") > 0)
    m = drawn.join(moves, drawn["source"].eqNullSafe(moves["s"]) & (drawn["size"] == moves["z"]) & (drawn["bucket"] == moves["b"]), "left")
    m = m.withColumn("able", F.coalesce(able & F.col("k").isNotNull(), F.lit(False)))
    rank = F.row_number().over(Window.partitionBy("source", "size", "bucket").orderBy(F.desc("able"), "h", "th", "doc_id"))
    moved = F.when(F.col("able") & (rank <= F.col("k")), F.col("sign")).otherwise(0)
    return m.withColumn("copies", (F.col("copies") + moved).cast("int"))


def take_mix(docs: DataFrame, weights: tuple[float, ...] = WEIGHTS, share: float = SHARE, max_copies: int = MAX_COPIES,
             doc_id: str = "doc_id", text: str = "text", source: str = "source") -> DataFrame:
    """``docs`` (all columns), each row as many times as the mix takes it."""
    site = lambda c: [F.coalesce(c, F.lit("")).alias("__site"), c.isNull().alias("__no_site")]
    key = [*ROW_KEY, "__site", "__no_site"]
    taken = mix(docs, weights, share, max_copies, doc_id, text, source).select("copies", *row_key("doc_id", F.col("th")), *site(F.col("source")))
    taken = stored(taken.groupBy(*key).agg(F.sum("copies").cast("int").alias("__copies")).filter("__copies > 0"), "taken")
    rows = docs.select("*", *row_key(doc_id, F.xxhash64(text)), *site(F.col(source)))
    # Equal rows share their copies, so one of them carries all; the window needs no other shuffle than the join's.
    once = F.row_number().over(Window.partitionBy(*key).orderBy(F.lit(0)))
    met = rows.join(taken, key).withColumn("__once", once).filter(F.col("__once") == 1)
    return met.withColumn("__copy", F.explode(F.array_repeat(F.lit(1), F.col("__copies")))).select(*docs.columns)


def op5_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(read_table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")
