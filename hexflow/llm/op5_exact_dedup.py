"""Exact duplicates against immutable snapshots, screened by binary-fuse filters.

Digests (SHA-256 of the text with every run of blanks made one space) fall into
buckets by their first bits. A snapshot never changes once written, so each of
its buckets gets a static binary-fuse filter (three positions a key, 8-bit
fingerprints, about 9 bits a key). A new batch is first grouped by digest, with
map-side aggregation, so a text that holds a third of the rows is one key; the
batch's digests are screened bucket by bucket. Negatives are surely new and
never touch the snapshot; positives join the snapshot's exact bucket, and the
texts of the digests that match are compared byte by byte (smallest and largest
normalised text of the digest agree). Duplicates inside the batch are the
batch's own groups.

Edge cases: NULL counts as the empty text; rows repeat: of rows with one
doc_id and one text exactly one is kept; a NULL doc_id is larger than any
other; empty tables give empty results; columns beyond doc_id and text are
ignored.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import SPACE, broadcast_below, by_value, packed, text_of, written

by_value(__name__)

KEYS_PER_BUCKET = 200_000          # bounds a filter's size and a task's memory
MAX_BROADCAST_DIGESTS = 1_000_000
SLOT_FACTOR, SMALL_EXTRA = 1.18, 32


# --- binary-fuse filter over 64-bit keys ------------------------------------

def _mix(x: np.ndarray, seed: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        x = (x + np.uint64(seed)) * np.uint64(0x9E3779B97F4A7C15)
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


def _places(h: np.ndarray, seg: int, n_seg: int) -> np.ndarray:
    """Three positions in neighbouring segments, and (in the caller) the
    fingerprint from other bits of the hash."""
    first = ((h >> np.uint64(32)) * np.uint64(n_seg)) >> np.uint64(32)
    at = [((first + np.uint64(k)) * np.uint64(seg) + ((h >> np.uint64(s)) & np.uint64(seg - 1))) for k, s in ((0, 0), (1, 10), (2, 20))]
    return np.stack(at).astype(np.int64)


def _print(h: np.ndarray) -> np.ndarray:
    return ((h ^ (h >> np.uint64(32))) & np.uint64(0xFF)).astype(np.uint8)


def build_filter(keys: np.ndarray) -> tuple[int, int, int, bytes]:
    """(seed, segment length, first segments, fingerprints) of distinct uint64
    keys. Peels in rounds: every slot that one key is left in settles that key."""
    keys = np.unique(keys)
    n = len(keys)
    seg = 1 << int(min(10, max(2, np.ceil(np.log2(max(4, n)) / 2))))
    n_seg = max(1, int(np.ceil((n * SLOT_FACTOR + SMALL_EXTRA) / seg)))
    for seed in range(1, 200):
        if seed % 20 == 0:
            n_seg = int(n_seg * 1.15) + 1
        h = _mix(keys, seed)
        at = _places(h, seg, n_seg)
        size = (n_seg + 2) * seg
        count = np.zeros(size, np.int64)
        owner = np.zeros(size, np.int64)        # xor of the keys left in a slot
        idx = np.arange(n, dtype=np.int64)
        for row in at:
            np.add.at(count, row, 1)
            np.bitwise_xor.at(owner, row, idx)
        order: list[tuple[np.ndarray, np.ndarray]] = []
        left = n
        while left:
            slots = np.flatnonzero(count == 1)
            if not len(slots):
                break
            who, first = np.unique(owner[slots], return_index=True)
            order.append((who, slots[first]))
            for row in at[:, who]:
                np.subtract.at(count, row, 1)
                np.bitwise_xor.at(owner, row, who)
            left -= len(who)
        if left:
            continue
        table = np.zeros(size, np.uint8)
        want = _print(h)
        for who, slot in reversed(order):       # keys of one round don't read each other's own slot
            table[slot] = want[who] ^ np.bitwise_xor.reduce(np.where(at[:, who] == slot, 0, table[at[:, who]]), axis=0)
        return seed, seg, n_seg, table.tobytes()
    raise RuntimeError("no seed peels")


def may_contain(keys: np.ndarray, seed: int, seg: int, n_seg: int, prints: bytes) -> np.ndarray:
    h = _mix(keys, seed)
    table = np.frombuffer(prints, np.uint8)
    return np.bitwise_xor.reduce(table[_places(h, seg, n_seg)], axis=0) == _print(h)


def _keys(digests) -> np.ndarray:
    """The 64 bits behind a digest's bucket bits."""
    return np.array([int.from_bytes(d[4:12], "big") for d in digests], np.uint64)


# --- Spark side -----------------------------------------------------------------

def normalised() -> Column:
    return F.regexp_replace(text_of(), SPACE, " ")


def digest_of_text() -> Column:
    return F.unhex(F.sha2(normalised().cast("binary"), 256)).alias("digest")


def grouped(rows: DataFrame) -> DataFrame:
    """digest, first (smallest doc_id), n: one row per text."""
    return rows.groupBy("digest").agg(F.min("doc_id").alias("first"), F.count(F.lit(1)).alias("n"))


def bucket_of(n_buckets: int) -> Column:
    return F.pmod(F.conv(F.hex(F.substring("digest", 1, 4)), 16, 10).cast("long"), F.lit(n_buckets)).cast("int")


def filters(snapshot: DataFrame, n_buckets: int) -> DataFrame:
    """One binary-fuse filter per bucket of the snapshot's digests."""
    def build(pdf: pd.DataFrame) -> pd.DataFrame:
        seed, seg, n_seg, prints = build_filter(_keys(pdf["digest"]))
        return pd.DataFrame({"bucket": [pdf["bucket"].iloc[0]], "seed": [seed], "seg": [seg], "n_seg": [n_seg], "prints": [prints]})
    return (snapshot.select(bucket_of(n_buckets).alias("bucket"), "digest").groupBy("bucket")
            .applyInPandas(build, "bucket int, seed int, seg int, n_seg int, prints binary"))


def screen(batch: DataFrame, fuses: DataFrame, n_buckets: int) -> DataFrame:
    """``batch`` plus ``maybe``: false where the digest is surely new."""
    def probe(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        out = left.drop(columns=["bucket"])
        if not len(left):
            return out.assign(maybe=pd.Series([], dtype=bool))
        f = right.iloc[0] if len(right) else None
        out["maybe"] = False if f is None else may_contain(_keys(left["digest"]), int(f["seed"]), int(f["seg"]), int(f["n_seg"]), f["prints"])
        return out
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in batch.schema.fields) + ", maybe boolean"
    return (batch.withColumn("bucket", bucket_of(n_buckets)).groupBy("bucket")
            .cogroup(fuses.groupBy("bucket")).applyInPandas(probe, schema))


def differing(docs: DataFrame, matched: DataFrame, n: int) -> DataFrame:
    """Those of the ``n`` matched digests under which two texts differ in bytes.
    The smallest and largest text of a digest are found with map-side
    aggregation, so copies don't travel."""
    rows = docs.select(digest_of_text(), normalised().alias("norm"))
    rows = rows.join(broadcast_below(matched.select("digest"), n, MAX_BROADCAST_DIGESTS), "digest", "left_semi")
    return (rows.groupBy("digest").agg(F.min("norm").alias("low"), F.max("norm").alias("high"))
            .where(F.col("low") != F.col("high")).select("digest"))


def _decided(docs: DataFrame, in_batch: Column | None) -> DataFrame:
    """dedup() with the row ids of this reading of ``docs``."""
    split = F.pmod(F.xxhash64("doc_id"), F.lit(2)) == 1 if in_batch is None else in_batch
    split = F.coalesce(split, F.lit(True))              # a row whose side is unknown is new
    rows = written(docs.select("doc_id", split.alias("_new"), F.monotonically_increasing_id().alias("_rid"), digest_of_text()), "digests")
    snapshot = written(grouped(rows.where(~F.col("_new"))), "snapshot")
    batch = written(grouped(rows.where("_new")), "batch")
    n_buckets = max(1, -(-max(snapshot.count(), batch.count()) // KEYS_PER_BUCKET))
    screened = written(screen(batch, filters(snapshot, n_buckets), n_buckets), "screened")
    exact = snapshot.select("digest", F.col("first").alias("s_first"), F.col("n").alias("s_n"))
    matched = written(screened.where("maybe").join(exact, "digest"), "matched")
    if differing(docs, matched, matched.count()).limit(1).count():
        raise RuntimeError("two texts share a SHA-256 digest")
    met = matched.select("digest", F.least("first", "s_first").alias("keep_id"), (F.col("n") + F.col("s_n")).alias("group_size"), F.lit(True).alias("seen"))
    known = matched.select("digest")
    fresh = screened.join(known, "digest", "left_anti")
    old = exact.join(known, "digest", "left_anti")
    groups = (met.unionByName(fresh.select("digest", F.col("first").alias("keep_id"), F.col("n").alias("group_size"), F.lit(False).alias("seen")))
              .unionByName(old.select("digest", F.col("s_first").alias("keep_id"), F.col("s_n").alias("group_size"), F.lit(False).alias("seen"))))
    # of repeated rows with the kept doc_id, the first one read stays
    stays = rows.groupBy("digest").agg(F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "_rid"))["_rid"].alias("stay"))
    return (rows.join(groups.join(stays, "digest"), "digest")
            .withColumn("kept", F.col("_rid") == F.col("stay")).withColumn("seen", F.col("seen") & F.col("_new")))


def dedup(docs: DataFrame, in_batch: Column | None = None) -> DataFrame:
    """Per row: doc_id, keep_id, group_size, kept, text_sha256, and ``seen``:
    whether the row is of the batch and its text was in the snapshot.

    ``in_batch`` tells the new batch's rows from the snapshot's; by default a
    hash of doc_id deals the rows into the two."""
    return _decided(docs, in_batch).select("doc_id", "keep_id", "group_size", "kept", F.lower(F.hex("digest")).alias("text_sha256"), "seen")


def without_copies(docs: DataFrame) -> DataFrame:
    """``docs`` without superfluous copies. Only doc_id and digest of the rows
    that go meet the texts; where a row that stays repeats with its doc_id, one
    of the repeats is left."""
    each = written(_decided(docs, None).groupBy("digest", "doc_id", "keep_id").agg(F.count(F.lit(1)).alias("n")), "copies")
    stays = F.col("doc_id").eqNullSafe(F.col("keep_id"))
    gone = each.where(~stays).select(F.col("doc_id").alias("gone_id"), F.col("digest").alias("gone_digest"))
    twice = each.where(stays & (F.col("n") > 1)).select("digest")
    rows = packed(docs, F.col("doc_id").alias("id"), digest_of_text())
    rows = rows.join(broadcast_below(gone, gone.count(), MAX_BROADCAST_DIGESTS),
                     (F.col("digest") == F.col("gone_digest")) & F.col("id").eqNullSafe(F.col("gone_id")), "left_anti")
    n = twice.count()
    if n:
        twice = broadcast_below(twice, n, MAX_BROADCAST_DIGESTS)
        rows = rows.join(twice, "digest", "left_anti").select("row").unionByName(
            rows.join(twice, "digest", "left_semi").dropDuplicates(["digest"]).select("row"))
    return rows.select("row.*")
