"""Mixing sources to target weights by hash-threshold histograms. Native.

Every source gets a target number of words. Documents are ordered by a fixed
hash of (doc_id, text) in [0, 2^60); a source with target ``c * source_size +
rest`` takes every document ``c`` times, and once more those whose hash lies
below a threshold, so that their sizes sum to about ``rest``. The thresholds
come from histograms: sizes are summed per (source, hash bucket), the bucket in
which the budget ends is found by a running sum over at most 2^12 buckets, and
only that boundary bucket is split into 2^12 finer ones, five times. The result
is a filter on the hash: no sort, and at most 4,096 x sources rows per level
leave the map side. Documents with one hash (repeats of a row) stand or fall
together. Nested budgets give nested thresholds: a larger budget only adds.

Edge cases: a NULL text has size 0 and takes 0; NULL ``source`` is a source of
its own, last in order; sources without words have target 0; an empty table
gives an empty result; columns beyond doc_id, text and source are ignored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import broadcast_below, n_words, packed, text_of, written

WEIGHTS = (5.0, 2.0, 1.0)      # repeating, by order of the source name
BUDGET = 1.5                   # all targets together, as a share of all sizes
MOST = 2.0                     # no source gives more than this times its size
MAX_BROADCAST_SOURCES = 100_000
LEVEL_BITS, LEVELS = 12, 5     # 5 levels of 12 bits cover the 60-bit hash


def place():
    """The hash that orders a source's documents."""
    h = F.xxhash64(F.col("doc_id"), F.crc32(text_of().cast("binary")))
    return F.shiftrightunsigned(h, 64 - LEVEL_BITS * LEVELS)


def sized(docs: DataFrame) -> DataFrame:
    """doc_id, source, size and the hash that orders a source's documents."""
    return docs.select(F.col("doc_id"), F.col("source").cast("string").alias("source"),
                       n_words(F.col("text").cast("string")).alias("size"),
                       place().alias("h"))


def targets(sizes: DataFrame, weights=WEIGHTS, budget: float = BUDGET, most: float = MOST) -> DataFrame:
    """source, source_size, target, from one row per source.

    Water filling: with a level L, a source holds min(most * size, L * weight).
    Sources fill up in the order of size / weight, so with running sums along
    that order the first source that stays open under the level of the sources
    before it fixes L. The table has one row per source."""
    by_name = Window.partitionBy("all").orderBy(F.col("source").isNull(), "source")
    s = (sizes.withColumn("all", F.lit(1)).withColumn("i", F.row_number().over(by_name) - 1)
         .withColumn("w", F.element_at(F.array(*[F.lit(float(x)) for x in weights]), (F.col("i") % len(weights) + 1).cast("int")))
         .withColumn("cap", F.col("source_size") * F.lit(float(most))))
    every = Window.partitionBy("all")
    filled = Window.partitionBy("all").orderBy(F.col("cap") / F.col("w"), "i").rowsBetween(Window.unboundedPreceding, -1)
    s = (s.withColumn("total", F.sum("source_size").over(every) * F.lit(float(budget)))
         .withColumn("cap_before", F.coalesce(F.sum("cap").over(filled), F.lit(0.0)))
         .withColumn("w_left", F.sum("w").over(every) - F.coalesce(F.sum("w").over(filled), F.lit(0.0)))
         .withColumn("level", (F.col("total") - F.col("cap_before")) / F.col("w_left"))
         # the first source that the level doesn't fill has the highest level of all such sources
         .withColumn("level", F.max(F.when(F.col("level") * F.col("w") <= F.col("cap"), F.col("level"))).over(every)))
    return s.select("source", "source_size",
                    F.least(F.col("cap"), F.coalesce(F.col("level") * F.col("w"), F.col("cap"))).alias("target"))


def thresholds(rows: DataFrame, goals: DataFrame, n_sources: int) -> DataFrame:
    """source -> ``copies`` every document gives and ``below``, the hash under
    which it gives one more. ``rows``: source, size, h."""
    whole = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0)
    state = goals.select("source", "source_size", "target", whole.cast("long").alias("copies"),
                         (F.col("target") - whole * F.col("source_size")).alias("rest"), F.lit(0).cast("long").alias("prefix"))
    for level in range(LEVELS):
        shift = LEVEL_BITS * (LEVELS - 1 - level)
        edges = broadcast_below(state.select(F.col("source").alias("s"), "prefix"), n_sources, MAX_BROADCAST_SOURCES)
        inside = rows.join(edges, F.col("source").eqNullSafe(F.col("s")))
        if level:
            inside = inside.where(F.shiftright("h", shift + LEVEL_BITS) == F.col("prefix"))
        hist = inside.groupBy("s", F.shiftright("h", shift).alias("b")).agg(F.sum("size").alias("size"))
        run = Window.partitionBy("source").orderBy("b")
        bounded = (state.join(hist, state["source"].eqNullSafe(hist["s"]), "left")
                   .withColumn("upto", F.coalesce(F.sum("size").over(run), F.lit(0)))
                   .groupBy("source", "source_size", "target", "copies", "rest", "prefix")
                   .agg(F.max(F.when(F.col("upto") <= F.col("rest"), F.col("upto"))).alias("taken"),
                        F.min(F.when(F.col("upto") > F.col("rest"), F.struct("b", F.col("size").alias("size")))).alias("edge")))
        # no edge: everything fits (first level), or the boundary is already past the last row
        past = F.col("prefix") * (1 << LEVEL_BITS) if level else F.lit(1 << LEVEL_BITS).cast("long")
        state = written(bounded.select(
            "source", "source_size", "target", "copies", (F.col("rest") - F.coalesce("taken", F.lit(0))).alias("rest"),
            F.coalesce(F.col("edge.b"), past).alias("prefix"),
            F.col("edge.size").alias("edge_size")), "mix-level")
    # the last bucket holds documents of one hash: in, if that comes nearer
    return state.select("source", "source_size", "target", "copies",
                        (F.col("prefix") + F.when(F.col("rest") * 2 > F.col("edge_size"), 1).otherwise(0)).alias("below"))


def _cuts(docs: DataFrame, weights, budget: float, most: float) -> tuple[DataFrame, DataFrame]:
    """The sized rows, and one row per source: s, copies, below, target, source_size."""
    rows = written(sized(docs), "mix-sizes")
    goals = written(targets(rows.groupBy("source").agg(F.sum("size").alias("source_size")), weights, budget, most), "mix-targets")
    n_sources = goals.count()
    cut = thresholds(rows, goals, n_sources).withColumnRenamed("source", "s")
    return rows, broadcast_below(cut, n_sources, MAX_BROADCAST_SOURCES)


def _copies(h, copies, below, most: float):
    return (copies + F.when((h < below) & (copies < F.lit(int(most))), 1).otherwise(0)).cast("long")


def mix(docs: DataFrame, weights=WEIGHTS, budget: float = BUDGET, most: float = MOST) -> DataFrame:
    """Per document: doc_id, size, source_size, target, taken, and ``copies``,
    how often the mix takes it (0, 1, ... most)."""
    rows, cut = _cuts(docs, weights, budget, most)
    return (rows.join(cut, F.col("source").eqNullSafe(F.col("s")))
            .withColumn("copies", _copies(F.col("h"), F.col("copies"), F.col("below"), most))
            .select("doc_id", "size", "source_size", F.col("target").cast("double").alias("target"),
                    (F.col("copies") * F.col("size")).alias("taken"), "copies", "source"))


def taken_rows(docs: DataFrame, weights=WEIGHTS, budget: float = BUDGET, most: float = MOST) -> DataFrame:
    """``docs`` with every row as often as the mix takes it: the thresholds (one
    row per source) filter the texts in place. Rows without words aren't taken."""
    _, cut = _cuts(docs, weights, budget, most)
    rows = packed(docs, F.col("source").cast("string").alias("source"), place().alias("h"), n_words(F.col("text").cast("string")).alias("size"))
    rows = rows.join(cut.select("s", "copies", "below"), F.col("source").eqNullSafe(F.col("s")))
    times = F.when(F.col("size") > 0, _copies(F.col("h"), F.col("copies"), F.col("below"), most)).otherwise(0).cast("int")
    return rows.withColumn("time", F.explode(F.array_repeat(F.lit(1), times))).select("row.*")
