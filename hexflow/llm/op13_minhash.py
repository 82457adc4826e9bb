"""Document fingerprints by MinHash, and near duplicates found through them.

A text's fingerprint is PERMUTATIONS minima: of the hashes x of its 5-word
shingles under x -> a x + b modulo 2^64 (a odd: a permutation), of which 16 bits
each are kept. Two fingerprints agree in a place with the probability of the
Jaccard similarity of the shingle sets, so the share of equal places estimates it.
Minima of many texts are taken together in numpy, permutation by permutation.

``edited`` compares every text with a version of itself whose last half is
replaced by the beginning of the next text. Texts are range partitioned by
doc_id and sorted once; a task walks through its rows and needs the row before
only. The first and last rows of the tasks meet in a second, small step, so
no task sees more than its own range, and one doc_id on many rows is split.

``near_duplicates`` cuts fingerprints into BANDS bands of ROWS places. Equal sets
are one node. Nodes that share a band are candidates. A bucket's members aren't
paired all at once: about one of them (by a hash) meets the others, then twice as
many a round, and only where classes still differ, until all have met; so a
group of copies costs a star, and no pair between two classes is left out. Pairs
are verified on the shingle sets; links give the classes.

Edge cases: NULL counts as the empty text; texts without words share one
fingerprint, which agrees with no other (0.0) but itself (1.0); fewer than five
words make one shingle; a table of one row is its own next text; rows with one
doc_id are ordered by text, equal rows in any order (it can't be seen), NULL
doc_ids come last; empty tables give empty results; columns beyond doc_id and
text are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import by_value, in_small_batches, text_of, trimmed, written
from .components import components
from .shingles import WordHashes, mix, shingle_set, signature, windows

by_value(__name__)

SHINGLE, PERCENT = 5, 80
PERMUTATIONS, BANDS, ROWS = 128, 21, 6
SEED = 0x452821E638D01377
CHUNK = 1 << 18                # shingles hashed at once
RUN_CHARS = 1_000_000


def permutations(n: int = PERMUTATIONS) -> tuple[np.ndarray, np.ndarray]:
    """n odd factors and n summands, from a fixed seed."""
    r = mix(np.arange(2 * n, dtype=np.uint64) + np.uint64(SEED))
    return r[:n] | np.uint64(1), r[n:]


class MinHash:
    def __init__(self):
        self.words = WordHashes(fold=True)
        self.a, self.b = permutations()

    def shingles(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(shingle hashes of all texts, repeats included; their number per text)."""
        words = list(self.words.texts(pa.array(texts, pa.large_string())))
        size = np.fromiter(map(len, words), np.int64, len(words))
        number = np.where(size > 0, np.maximum(size - SHINGLE + 1, 1), 0)
        all_ = np.concatenate(words) if words else np.empty(0, np.uint64)
        out = np.empty(int(number.sum()), np.uint64)
        ends = np.cumsum(size)
        many = size >= SHINGLE
        if many.any():
            of = np.repeat(np.arange(len(size)), size)[:max(len(all_) - SHINGLE + 1, 0)]
            inside = many[of] & (np.arange(len(of)) + SHINGLE <= ends[of])      # windows across texts are dropped
            place = np.repeat(many, number)
            out[place] = windows(all_, SHINGLE)[inside]
        starts = np.cumsum(number) - number
        for i in np.flatnonzero((size > 0) & ~many):
            out[starts[i]] = windows(words[i], int(size[i]))[0]
        return out, number

    def minima(self, x: np.ndarray, number: np.ndarray) -> np.ndarray:
        """16 bits of each minimum, (texts, PERMUTATIONS); 0 for texts without shingles."""
        out = np.full((len(number), len(self.a)), np.iinfo(np.uint64).max, np.uint64)
        ends = np.cumsum(number)
        starts = ends - number
        with np.errstate(over="ignore"):
            for lo in range(0, len(x), CHUNK):
                part = x[lo:lo + CHUNK]
                first = int(np.searchsorted(ends, lo, side="right"))
                last = int(np.searchsorted(starts, lo + len(part), side="left"))
                held = np.arange(first, last)[number[first:last] > 0]
                cuts = np.maximum(starts[held] - lo, 0)
                for k in range(len(self.a)):
                    out[held, k] = np.minimum(out[held, k], np.minimum.reduceat(part * self.a[k] + self.b[k], cuts))
        out = mix(out).astype(np.uint16)
        out[number == 0] = 0
        return out

    def of(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(minima, shingles per text)."""
        x, number = self.shingles(texts)
        return self.minima(x, number), number


def packed_places(minima: np.ndarray, number: np.ndarray) -> pa.Array:
    """Fingerprints, two bytes a place; without shingles none."""
    rows = minima.astype(">u2")
    return pa.array([r.tobytes() if n else b"" for r, n in zip(rows, number.tolist(), strict=True)], pa.binary())


def named(fingerprint: str) -> Column:
    """A fingerprint as lowercase hex, four digits a place."""
    return F.lower(F.hex(fingerprint)).alias(fingerprint)


def likeness(a: np.ndarray, na: np.ndarray, b: np.ndarray, nb: np.ndarray) -> np.ndarray:
    same = (a == b).mean(axis=1) if len(a) else np.empty(0)
    return np.where((na > 0) & (nb > 0), same, (na == nb).astype(float))


def edit(text: str, following: str) -> str:
    """``text`` with its last half (rounded down) replaced by as much of the beginning of ``following``."""
    half = len(text) // 2
    return text[:len(text) - half] + following[:half]


def fingerprints(docs: DataFrame) -> DataFrame:
    """doc_id and fingerprint of every row."""
    id_type = docs.schema["doc_id"].dataType.simpleString()

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        mh = MinHash()
        for ids, texts in _pieces(batches):
            yield pa.RecordBatch.from_arrays([ids, packed_places(*mh.of(texts))], names=["doc_id", "fingerprint"])
    return in_small_batches(docs.select("doc_id", text_of().alias("text"))).mapInArrow(trimmed(work), f"doc_id {id_type}, fingerprint binary").select("doc_id", named("fingerprint"))


DONE = "n_chars long, edited_sha256 string, fingerprint binary, edited_fingerprint binary, near_edited double, near_next double"


def _compared(mh: MinHash, texts: list[str], following: list[str], whole: tuple, after: tuple) -> list[pa.Array]:
    """The columns of DONE; ``whole`` and ``after``: minima and numbers of both sides."""
    changed = [edit(t, f) for t, f in zip(texts, following, strict=True)]
    other = mh.of(changed)
    return [pa.array([len(t) for t in texts], pa.int64()), pa.array([hashlib.sha256(t.encode()).hexdigest() for t in changed], pa.string()),
            packed_places(*whole), packed_places(*other),
            pa.array(likeness(*whole, *other), pa.float64()), pa.array(likeness(*whole, *after), pa.float64())]


def edited(docs: DataFrame) -> DataFrame:
    """Per row: doc_id and the columns of DONE, the next text being that of the
    next lower doc_id (of the highest one after the lowest)."""
    id_type = docs.schema["doc_id"].dataType.simpleString()
    names = ["doc_id", *[c.split()[0] for c in DONE.split(", ")]]

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows in order; a task's first text and last row come with their text for the second step."""
        mh, held, part = MinHash(), None, TaskContext.get().partitionId()

        def end(kind: str, ids: pa.Array, text: str) -> pa.RecordBatch:
            empty = [pa.nulls(1, t) for t in (pa.int64(), pa.string(), pa.binary(), pa.binary(), pa.float64(), pa.float64())]
            return pa.RecordBatch.from_arrays([ids, *empty, pa.array([kind]), pa.array([part], pa.int32()), pa.array([text], pa.string())], names=[*names, "kind", "part", "text"])

        for ids, texts in _pieces(batches):
            minima, number = mh.of(texts)
            if held is None:
                yield end("first", pa.nulls(1, ids.type), texts[0])
                before, whole = texts[:-1], (minima[:-1], number[:-1])
                who = ids.slice(0, len(texts) - 1)
                after, following = (minima[1:], number[1:]), texts[1:]
            else:
                who = pa.concat_arrays([held[0], ids.slice(0, len(texts) - 1)])
                before = [held[1], *texts[:-1]]
                whole = (np.concatenate([held[2], minima[:-1]]), np.concatenate([held[3], number[:-1]]))
                after, following = (minima, number), texts
            if before:
                n = len(before)
                yield pa.RecordBatch.from_arrays([who, *_compared(mh, before, following, whole, after), pa.nulls(n, pa.string()), pa.array([part] * n, pa.int32()), pa.nulls(n, pa.string())],
                                                 names=[*names, "kind", "part", "text"])
            held = ids.slice(len(texts) - 1), texts[-1], minima[-1:].copy(), number[-1:].copy()
        if held is not None:
            yield end("last", held[0], held[1])

    def join_ends(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        mh = MinHash()
        for batch in batches:
            for i in range(batch.num_rows):                     # texts may be long: one pair at a time
                text, following = batch.column(1)[i].as_py(), batch.column(2)[i].as_py()
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(i, 1), *_compared(mh, [text], [following], mh.of([text]), mh.of([following]))], names=names)

    rows = docs.select("doc_id", text_of().alias("text"))
    order = [F.col("doc_id").desc_nulls_last(), F.xxhash64("text")]
    # equal rows of a hot doc_id are dealt out by a running number
    dealt = rows.withColumn("at", F.monotonically_increasing_id()).repartitionByRange(*order, "at").sortWithinPartitions(*order, "at").select("doc_id", "text")
    out = written(in_small_batches(dealt).mapInArrow(trimmed(walk), f"doc_id {id_type}, {DONE}, kind string, part int, text string"), "minhash-edited")
    first = out.where("kind = 'first'").select("part", F.col("text").alias("following"))
    # two rows per task
    each = Window.orderBy("part")
    parts = first.select("part", F.lead("part").over(each).alias("then"), F.min("part").over(each).alias("least"))
    after = parts.select(F.col("part").alias("of"), F.coalesce("then", "least").alias("part")).join(first, "part").drop("part")
    last = out.where("kind = 'last'").join(after, F.col("part") == F.col("of")).select("doc_id", "text", "following")
    ends = in_small_batches(last).mapInArrow(trimmed(join_ends), f"doc_id {id_type}, {DONE}")
    return out.where("kind IS NULL").select(*names).unionByName(ends).withColumns({c: named(c) for c in ("fingerprint", "edited_fingerprint")})


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.Array, list[str]]]:
    """(ids, texts) of about RUN_CHARS."""
    for batch in batches:
        texts, lo, size = batch.column(1).to_pylist(), 0, 0
        for i, t in enumerate(texts):
            size += len(t)
            if size >= RUN_CHARS or i + 1 == len(texts):
                yield batch.column(0).slice(lo, i + 1 - lo), texts[lo:i + 1]
                lo, size = i + 1, 0


def sets_of(docs: DataFrame) -> DataFrame:
    """doc_id, sig (a name of the shingle set), n, the sorted shingles and the names of the bands of every row."""
    id_type = docs.schema["doc_id"].dataType.simpleString()

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        mh = MinHash()
        for ids, texts in _pieces(batches):
            sets = [shingle_set(w) for w in mh.words.texts(pa.array(texts, pa.large_string()))]
            number = np.fromiter(map(len, sets), np.int64, len(sets))
            places = mh.minima(np.concatenate(sets), number)[:, :BANDS * ROWS].astype(np.uint64).reshape(len(sets), BANDS, ROWS)
            names = [windows(mix(b.reshape(-1) + np.uint64(1)), ROWS)[::ROWS].view(np.int64) if n else np.empty(0, np.int64) for b, n in zip(places, number.tolist(), strict=True)]
            yield pa.RecordBatch.from_arrays([ids, pa.array([signature(x) for x in sets], pa.int64()), pa.array(number), pa.array([x.view(np.int64) for x in sets], pa.list_(pa.int64())),
                                              pa.array(names, pa.list_(pa.int64()))], names=["doc_id", "sig", "n", "shingles", "bands"])
    return in_small_batches(docs.select("doc_id", text_of().alias("text"))).mapInArrow(
        trimmed(work), f"doc_id {id_type}, sig long, n long, shingles array<long>, bands array<long>")


def verified(pairs: DataFrame, nodes: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose shingle sets have a Jaccard similarity of ``percent`` % or more."""
    def side(name: str) -> DataFrame:
        return nodes.select(F.col("sig").alias(name), F.col("shingles").alias(f"{name}_set"))
    shared = F.size(F.array_intersect("a_set", "b_set"))
    return (pairs.join(side("a"), "a").join(side("b"), "b")
            .where(shared * 100 >= (F.size("a_set") + F.size("b_set") - shared) * percent).select("a", "b"))


def near_duplicates(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """Per row: doc_id, n_shingles and class_id, the least doc_id of its class
    (that of a text without words: its own)."""
    rows = written(sets_of(docs), "minhash-sets")
    nodes = written(rows.where("n > 0").select("sig", "n", "shingles", "bands").dropDuplicates(["sig"]), "minhash-nodes")
    zeros = F.length(F.regexp_extract(F.bin(F.xxhash64(F.lit(13), "sig")), "(0*)$", 1))
    members = nodes.select("sig", "n", zeros.alias("level"), F.posexplode("bands").alias("band", "name"))
    sizes = members.groupBy("band", "name").agg(F.count(F.lit(1)).alias("held")).where("held > 1")
    left = written(members.join(sizes, ["band", "name"]), "minhash-buckets")
    level = int(left.agg(F.max("held")).first()[0] or 1).bit_length()
    links = label = tried = None
    # hubs of a bucket: about one member at first, then twice as many a round, until all have been
    while level >= 0 and not left.isEmpty():
        at = F.least(F.col("level"), F.lit(level))
        if label is None:
            known = left.withColumn("class", F.col("sig"))
        else:
            known = left.join(label, F.col("sig") == F.col("node"), "left").withColumn("class", F.coalesce("class", "sig")).drop("node")
        mixed = known.groupBy("band", "name").agg((F.min("class") != F.max("class")).alias("mixed")).where("mixed").drop("mixed")
        left = written(known.join(mixed, ["band", "name"]), "minhash-open")
        member = F.struct("sig", "n", "class", at.alias("at"))
        hubs = left.where(at == level).select("band", "name", member.alias("x"))
        met = hubs.join(left.select("band", "name", member.alias("y")), ["band", "name"])
        met = met.where((F.col("x.class") != F.col("y.class")) & ((F.col("y.at") < level) | (F.col("x.sig") < F.col("y.sig")))
                        & (F.least("x.n", "y.n") * 100 >= F.greatest("x.n", "y.n") * percent))
        pairs = met.select(F.least("x.sig", "y.sig").alias("a"), F.greatest("x.sig", "y.sig").alias("b")).distinct()
        pairs = written(pairs if tried is None else pairs.join(tried, ["a", "b"], "left_anti"), "minhash-pairs")
        tried = pairs if tried is None else tried.unionByName(pairs)
        if not pairs.isEmpty():
            new = verified(pairs, nodes, percent)
            links = written(new if links is None else links.unionByName(new), "minhash-links")
            label = written(components(links).withColumnRenamed("label", "class"), "minhash-classes")
        left = left.where(at < level).drop("class")
        level -= 1
    out = rows.select("doc_id", "sig", "n")
    if label is None:
        out = out.withColumn("class", F.col("sig"))
    else:
        out = out.join(label, F.col("sig") == F.col("node"), "left").withColumn("class", F.coalesce("class", "sig"))
    out = out.select("doc_id", "n", "class")
    least = written(out.where("n > 0").groupBy("class").agg(F.min("doc_id").alias("class_id")), "minhash-least")
    return out.join(least, "class", "left").select("doc_id", F.col("n").alias("n_shingles"),
                                                   F.when(F.col("n") > 0, F.col("class_id")).otherwise(F.col("doc_id")).alias("class_id"))
