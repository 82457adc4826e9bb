"""Vector codes by product quantisation, its codebooks trained by ball k-means.

A vector is cut into PARTS equal parts; each part position has a codebook of
ENTRIES entries. Per round Spark assigns the parts of every vector to entries
(one task per partition, no shuffle), and sums the parts of each entry with a
map-side aggregate; only 16 x 64 sums, counts and radii come to the driver,
whatever the number of vectors.

Ball k-means makes assignments after the first cheaper without changing them:

* An entry's ball holds its parts; its radius after a round is at most the
  largest distance to the old entry plus the way the entry moved. Only entries
  whose centre lies within twice the radius can take a part from the ball: the
  *neighbour entries*, sorted by distance.
* A part nearer to its entry than half the way to the nearest neighbour is in
  the ball's *stable core* and keeps its entry without further work.
* Of the others, a part at distance d from its entry lies in the *annular ring*
  of the neighbours within 2 d: exactly those are compared, nearest first.

All of it is integer arithmetic on squares, so results equal the plain method;
at equal distances the lower index wins.

Edge cases: rows whose vector is NULL or holds a NULL, NaN or infinite component
are dropped; components become floor(256 x), kept within +-2^26 so that no sum
of squares overflows; vectors shorter than the longest one (rounded up to a
multiple of PARTS) are filled up with zeros, empty ones too; repeated rows and
vec_ids count as they come, a NULL vec_id is larger than any other, and rows of
one vec_id start the codebooks in the order of their components; fewer than
ENTRIES rows make fewer entries; an empty table gives an empty result; columns
beyond vec_id, embedding and label are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from math import isqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import broadcast_below, by_value, in_small_batches, trimmed, written

by_value(__name__)

PARTS, ENTRIES, ROUNDS = 16, 64, 2
MOST = 1 << 26                 # bound of a component's size
MAX_LABELS = 1_000_000         # summed labels that are broadcast


def integer_vectors(vectors: DataFrame, parts: int = PARTS) -> DataFrame:
    """vec_id, label and the integer components ``v`` of every row that stays,
    all of one length that ``parts`` divides."""
    x = F.transform("embedding", lambda c: c.cast("double"))
    fits = F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < F.lit(float("inf"))))
    whole = F.transform(x, lambda c: F.floor(F.greatest(F.least(c * 256, F.lit(float(MOST))), F.lit(-float(MOST)))).cast("int"))
    rows = written(vectors.where(F.col("embedding").isNotNull()).where(fits).select("vec_id", "label", whole.alias("v")), "codes-vectors")
    shortest, longest = rows.agg(F.min(F.size("v")), F.max(F.size("v"))).first()
    width = -(-max(longest or 0, 1) // parts) * parts
    if shortest == width:
        return rows
    return rows.withColumn("v", F.concat("v", F.array_repeat(F.lit(0), F.lit(width) - F.size("v"))))


class Codebooks:
    """Entries by part position, and the tables that ball k-means reads."""

    def __init__(self, entries: np.ndarray, far: np.ndarray | None = None, moved: np.ndarray | None = None):
        self.entries = entries                                  # part, entry, component
        k = entries.shape[1]
        between = np.stack([((e[:, None, :] - e[None, :, :]) ** 2).sum(axis=2) for e in entries])
        self.order = np.argsort(between, axis=2, kind="stable")          # an entry's neighbours, nearest first
        self.between = np.take_along_axis(between, self.order, axis=2)
        if far is None:
            self.last = np.full(entries.shape[:2], k)
            return
        # radius <= largest old distance + way moved, in whole numbers above; neighbours lie within twice the radius
        radius = np.array([[isqrt(int(f)) + 1 + isqrt(int(m)) + 1 for f, m in zip(fs, ms, strict=True)] for fs, ms in zip(far, moved, strict=True)], np.int64)
        self.last = (self.between <= 4 * (radius * radius)[:, :, None]).sum(axis=2)

    def distances(self, x: np.ndarray, part: np.ndarray, entry: np.ndarray) -> np.ndarray:
        return ((x - self.entries[part, entry]) ** 2).sum(axis=1)

    def first_assignment(self, v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(entries, squared distances) of parts that have no entry yet."""
        best = np.zeros(v.shape[:2], np.int64)
        least = np.full(v.shape[:2], np.iinfo(np.int64).max)
        for e in range(self.entries.shape[1]):
            d = ((v - self.entries[None, :, e, :]) ** 2).sum(axis=2)
            nearer = d < least
            best[nearer], least[nearer] = e, d[nearer]
        return best, least

    def assignment(self, v: np.ndarray, old: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(entries, squared distances) of parts (row, part, component) that had the entries ``old``."""
        n, parts, width = v.shape
        x, part, ball = v.reshape(-1, width), np.tile(np.arange(parts), n), old.reshape(-1)
        own = self.distances(x, part, ball)
        best, least = ball.copy(), own.copy()
        # place 0 of an entry's order may be another entry at distance 0, so the walk starts there
        live = np.arange(len(x))
        for step in range(self.entries.shape[1]):
            p, b = part[live], ball[live]
            ring = (step < self.last[p, b]) & (self.between[p, b, step] <= 4 * own[live])
            live, p, b = live[ring], p[ring], b[ring]           # a stable core ends at its nearest neighbour
            if not len(live):
                break
            e = self.order[p, b, step]
            d = self.distances(x[live], p, e)
            nearer = (d < least[live]) | ((d == least[live]) & (e < best[live]))
            at = live[nearer]
            best[at], least[at] = e[nearer], d[nearer]
        return best.reshape(n, parts), least.reshape(n, parts)

    def digest(self) -> str:
        return hashlib.sha256(",".join(map(str, self.entries.reshape(-1).tolist())).encode()).hexdigest()


def assigned(rows: DataFrame, books: Codebooks) -> DataFrame:
    """``rows`` with the entry (``code``) and the squared distance (``far``) of each
    part; codes that rows bring are where ball k-means starts."""
    shared = rows.sparkSession.sparkContext.broadcast(books)    # PARTS x ENTRIES entries and neighbour lists
    again = "code" in rows.columns

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        b = shared.value
        parts, _, width = b.entries.shape

        def lists(a: np.ndarray, kind) -> pa.ListArray:
            return pa.ListArray.from_arrays(pa.array(np.arange(len(a) + 1) * parts, pa.int32()), pa.array(a.reshape(-1), kind))
        for batch in batches:
            v = batch.column("v").flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(-1, parts, width)
            if again:
                code, far = b.assignment(v, batch.column("code").flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(-1, parts))
            else:
                code, far = b.first_assignment(v)
            yield pa.RecordBatch.from_arrays([batch.column("vec_id"), batch.column("label"), batch.column("v"), lists(code, pa.int32()), lists(far, pa.int64())],
                                             names=["vec_id", "label", "v", "code", "far"])
    types = dict(rows.dtypes)
    return in_small_batches(rows).mapInArrow(trimmed(work), f"vec_id {types['vec_id']}, label {types['label']}, v array<int>, code array<int>, far array<long>")


def moved(rows: DataFrame, books: Codebooks) -> Codebooks:
    """The codebooks after a round: each entry the floor of its parts' mean; unused entries stay."""
    parts, k, width = books.entries.shape
    each = rows.select(F.posexplode(F.arrays_zip("code", "far")).alias("part", "x"), "v").select(
        "part", "x.code", "x.far", *[F.element_at("v", F.col("part") * width + i + 1).cast("long").alias(f"c{i}") for i in range(width)])
    sums = each.groupBy("part", "code").agg(F.count(F.lit(1)).alias("n"), F.max("far").alias("far"), *[F.sum(f"c{i}").alias(f"c{i}") for i in range(width)])
    entries, far = books.entries.copy(), np.zeros((parts, k), np.int64)
    for r in sums.collect():                                    # at most PARTS x ENTRIES rows
        entries[r.part, r.code] = [r[f"c{i}"] // r.n for i in range(width)]
        far[r.part, r.code] = r.far
    return Codebooks(entries, far, ((entries - books.entries) ** 2).sum(axis=2))


def train(rows: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> tuple[DataFrame, Codebooks | None]:
    """(rows with code and far of the last assignment, final codebooks); no codebooks without rows."""
    first = rows.orderBy(F.col("vec_id").asc_nulls_last(), "v").limit(entries).collect()
    if not first:
        return rows.select("vec_id", "label", "v", F.array().cast("array<int>").alias("code"), F.array().cast("array<long>").alias("far")), None
    start = np.array([r.v for r in first], np.int64)
    books = Codebooks(start.reshape(len(start), parts, -1).swapaxes(0, 1).copy())
    for _ in range(rounds):
        rows = written(assigned(rows, books), "codes-round")
        books = moved(rows, books)
    return written(assigned(rows, books), "codes-final"), books


def compress(vectors: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> DataFrame:
    """vec_id, label, code array<int>, error, label_error and codebooks_sha256 per vector."""
    rows, books = train(integer_vectors(vectors, parts), parts, entries, rounds)
    rows = rows.select("vec_id", "label", "code", F.aggregate("far", F.lit(0).cast("long"), lambda a, x: a + x).alias("error"))
    sums = written(rows.groupBy("label").agg(F.sum("error").alias("label_error")), "codes-labels").withColumnRenamed("label", "of_label")
    return (rows.join(broadcast_below(sums, sums.count(), MAX_LABELS), F.col("label").eqNullSafe(F.col("of_label")))
            .select("vec_id", "label", "code", "error", "label_error", F.lit(books.digest() if books else hashlib.sha256(b"").hexdigest()).alias("codebooks_sha256")))


def hex_code(code) -> F.Column:
    """Entry indexes as two hex digits each."""
    return F.array_join(F.transform(code, lambda c: F.lower(F.lpad(F.hex(c.cast("long")), 2, "0"))), "")
