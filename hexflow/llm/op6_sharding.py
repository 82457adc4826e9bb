"""Sharding by a consistent-hash ring with virtual nodes and bounded loads. Native.

Every shard owns VNODES points of a ring of 2^32 hash values; the arc that ends
at a point belongs to it. A row's place is a hash of its doc_id. Shards have
fixed capacities, floor(rows / shards) or one more (the first ``rows mod
shards`` shards), so counts are at most one apart: the law is ``rows``. Keys
walk clockwise: an arc's keys fill its shard up to the capacity, and those
above continue to the next point whose shard has room.

Only counts walk the ring: rows are counted per arc (at most shards x VNODES
counts), one fold over the arcs in ring order hands each arc's keys to shards
in clockwise order, and gives every arc at most ``shards`` runs (from rank, to
rank, shard, first slot). A row's rank within its arc comes from counts per
fine bucket of the ring plus its place within that bucket, so no task orders
more than about ROWS_PER_BUCKET rows: buckets that hold far more (many rows of one
doc_id, or without one) are split by place, a place that still does by a hash of the
row, and equal rows by where they were written. Adding a shard moves the keys of the
arcs it cuts and those that overflow differently, no others.

Edge cases: repeated rows get slots of their own, equal rows in no particular
order; a NULL doc_id hashes as a value of its own; NULL text has size 1 and the
crc32 of the empty text; an empty table gives an empty result. Columns beyond
doc_id and text are ignored. Equal texts needn't share a shard: that would
break the law wherever copies hold a third of the rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import broadcast_below, let, text_of, written

RING_BITS = 32
VNODES = 64
ROWS_PER_BUCKET = 20_000
CROWDED = 4                    # a cell of so many times ROWS_PER_BUCKET rows is split
MAX_BROADCAST_BUCKETS = 4_000_000
PLACE_SEED, POINT_SEED = 42, 7


def ring(spark, shards: int, vnodes: int = VNODES) -> list[tuple[int, int]]:
    """(point, shard) in ring order. A point depends on its shard and number
    alone, so another shard only adds points."""
    rows = (spark.range(shards * vnodes)
            .select((F.col("id") % shards).alias("shard"), F.floor(F.col("id") / shards).alias("v"))
            .select("shard", F.shiftrightunsigned(F.xxhash64(F.lit(POINT_SEED), "shard", "v"), 64 - RING_BITS).alias("point"))
            .orderBy("point", "shard").collect())     # shards x vnodes rows, whatever the data
    return [(r["point"], r["shard"]) for r in rows]


def _arc(place: Column, points: list[int], lo: int = 0, hi: int | None = None) -> Column:
    """Index of the arc that a place falls in: a binary search written out as
    nested comparisons. Places beyond the last point belong to arc 0."""
    hi = len(points) if hi is None else hi
    if lo >= hi:
        return F.lit(lo % len(points))
    mid = (lo + hi) // 2
    return F.when(place <= F.lit(points[mid]), _arc(place, points, lo, mid)).otherwise(_arc(place, points, mid + 1, hi))


def assign(arcs: DataFrame, points: list[tuple[int, int]], shards: int, n_rows: int) -> DataFrame:
    """arc, runs: array of (lo, hi, shard, base) per arc, ranks from lo to hi
    (exclusive) of the arc going to slots base, base + 1, ... of the shard.
    ``arcs``: (arc, n) with one row per non-empty arc."""
    # the shards met clockwise from each point, each once; the ring is a parameter, not data
    def clockwise(i: int) -> list[int]:
        seen: list[int] = []
        for k in range(len(points)):
            s = points[(i + k) % len(points)][1]
            if s not in seen:
                seen.append(s)
                if len(seen) == shards:
                    break
        return seen
    spark = arcs.sparkSession
    order = spark.createDataFrame([(i, clockwise(i)) for i in range(len(points))], "arc int, walk array<int>")
    capacity = F.array(*[F.lit(n_rows // shards + (1 if s < n_rows % shards else 0)).cast("long") for s in range(shards)])
    run_type = "array<struct<arc:int,lo:bigint,hi:bigint,shard:int,base:bigint>>"
    listed = (order.join(arcs, "arc").groupBy()
              .agg(F.array_sort(F.collect_list(F.struct("arc", F.col("n").cast("long").alias("n"), "walk"))).alias("arcs")))

    def step(state: Column, arc: Column) -> Column:
        def offer(s: Column, shard: Column) -> Column:
            used = F.element_at(s["used"], shard + 1)
            take = F.least(arc["n"] - s["done"], F.element_at(capacity, shard + 1) - used)
            return F.when(take <= 0, s).otherwise(F.struct(
                F.transform(s["used"], lambda u, i: F.when(i == shard, u + take).otherwise(u)).alias("used"),
                F.concat(s["runs"], F.array(F.struct(arc["arc"].alias("arc"), s["done"].alias("lo"), (s["done"] + take).alias("hi"),
                                                     shard.alias("shard"), used.alias("base")))).alias("runs"),
                (s["done"] + take).alias("done")))
        start = F.struct(state["used"].alias("used"), state["runs"].alias("runs"), F.lit(0).cast("long").alias("done"))
        return F.aggregate(arc["walk"], start, offer)

    zero = F.struct(F.array(*[F.lit(0).cast("long")] * shards).alias("used"),
                    F.array().cast(run_type).alias("runs"), F.lit(0).cast("long").alias("done"))
    runs = listed.select(F.explode(F.aggregate("arcs", zero, step)["runs"]).alias("r")).select("r.*")
    return runs.groupBy("arc").agg(F.collect_list(F.struct("lo", "hi", "shard", "base")).alias("runs"))


def _split(rows: DataFrame, cell: list[str], part: str, value, rows_per_bucket: int) -> DataFrame:
    """``rows`` with a column ``part``: 0, but ``value(n)`` in crowded cells, where
    n is the number of parts that hold about rows_per_bucket rows each. Only counts
    are shuffled; there are at most rows / (CROWDED x rows_per_bucket) crowded cells."""
    crowded = (rows.groupBy(*cell).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > CROWDED * rows_per_bucket)
               .select(*cell, F.ceil(F.col("n") / rows_per_bucket).alias("_parts")))
    crowded = written(crowded, "ring-crowded")
    n = crowded.count()
    if not n:
        return rows.withColumn(part, F.lit(0).cast("long"))
    return (rows.join(broadcast_below(crowded, n, MAX_BROADCAST_BUCKETS), cell, "left")
            .withColumn(part, F.when(F.col("_parts").isNull(), F.lit(0)).otherwise(value(F.col("_parts"))).cast("long")).drop("_parts"))


def shard(docs: DataFrame, shards: int = 8, vnodes: int = VNODES, rows_per_bucket: int = ROWS_PER_BUCKET) -> DataFrame:
    """doc_id, size, text_crc32, shard, slot for every row of ``docs``."""
    spark = docs.sparkSession
    points = ring(spark, shards, vnodes)
    text = F.col("text").cast("string")
    place = F.shiftrightunsigned(F.xxhash64(F.lit(PLACE_SEED), F.col("doc_id")), 64 - RING_BITS)
    rows = written(docs.select(
        "doc_id", (F.coalesce(F.octet_length(text), F.lit(0)) + 1).cast("long").alias("size"),
        F.crc32(text_of().cast("binary")).alias("text_crc32"), place.alias("place"),
        let(place, lambda p: _arc(p, [p for p, _ in points])).alias("arc"), F.monotonically_increasing_id().alias("rid")), "ring-rows")
    n_rows = rows.count()
    bits = max(0, min(RING_BITS, (max(1, n_rows) // rows_per_bucket).bit_length() + 1))
    rows = rows.withColumn("bucket", F.shiftright("place", RING_BITS - bits))
    # an arc may begin or end inside a bucket: ranks are kept per cell, an (arc, bucket) or a part of one
    cell = ["arc", "bucket"]
    for part, value in (("at", lambda n: F.col("place")), ("alike", lambda n: F.pmod(F.xxhash64("doc_id", "text_crc32", "size"), n)),
                        ("piece", lambda n: F.pmod(F.xxhash64("rid"), n))):
        rows = _split(rows, cell, part, value, rows_per_bucket)
        cell = [*cell, part]
    cells = written(rows.groupBy(*cell).agg(F.count(F.lit(1)).alias("n")), "ring-cells")
    n_cells = cells.count()
    # arc 0 spans the ring's start: its far end comes first
    along = Window.partitionBy("arc").orderBy("wrapped", *cell[1:]).rowsBetween(Window.unboundedPreceding, -1)
    end = points[0][0] >> (RING_BITS - bits) if bits else 0
    cells = (cells.withColumn("wrapped", (F.col("arc") == 0) & (F.col("bucket") <= F.lit(end)))
             .withColumn("before", F.coalesce(F.sum("n").over(along), F.lit(0))))
    runs = assign(cells.groupBy("arc").agg(F.sum("n").alias("n")), points, shards, n_rows)
    cells = cells.select(*cell, "before").join(F.broadcast(runs), "arc")               # at most shards x vnodes rows
    cells = broadcast_below(cells, n_cells, MAX_BROADCAST_BUCKETS)
    in_cell = Window.partitionBy(*cell).orderBy("place", "doc_id", "text_crc32", "size")
    ranked = rows.withColumn("rank", F.row_number().over(in_cell) - 1).join(cells, cell)
    rank = F.col("before") + F.col("rank")
    run = F.element_at(F.filter("runs", lambda r: (r["lo"] <= rank) & (rank < r["hi"])), 1)
    return (ranked.withColumn("run", run)
            .select("doc_id", "size", "text_crc32", F.col("run.shard").cast("int").alias("shard"),
                    (F.col("run.base") + rank - F.col("run.lo")).cast("long").alias("slot")))
