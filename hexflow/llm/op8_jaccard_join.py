"""N-gram Jaccard join with several global token orders.

Two documents link when their sets of 5-word shingles have a Jaccard similarity
of at least 0.8. Under any global order of the shingles, the prefixes (the first
n - ceil(0.8 n) + 1 shingles) of two linked sets share a shingle, so a pair must
share one under every order. ORDERS orders are used:

1. Equal sets are one node, named by a signature of the set.
2. The first order puts shingles that many sets hold at the end (found by
   counts within tasks, summed over all; the order steers work, never results).
   Its prefixes are grouped by shingle; length and position filters apply, and
   a pair must share as many prefix shingles as its sizes ask for.
3. Candidates of a shingle's bucket aren't written out as all pairs. First
   every member is paired with the bucket's weightiest member, the one whose
   shingles most others share; verified links give components, and a group of
   thousands of near copies costs a star. Then, in buckets that still span two or
   more components, members of different components are paired. A shared shingle
   at place i of a set of n can be among the first q that two linked sets share only
   if the other set has at most (n + q - i) * 1.8 / 0.8 - n shingles; a pair must share q = EARLY such. So the join is on
   (shingle, size band): a set probes the bands of smaller sets that its place
   allows, and is indexed under its own band only with the places that larger sets
   allow. Hubs come first here, too: in the first round only members that a hash
   picks (one in HUB_STEP^k) meet the others, HUB_STEP times as many in the next, all in
   the last, and links of a round join components before the next one.
   Pairs within a component can't change it, so no link between
   components is lost.
4. A pair must share as many prefix shingles as its sizes ask for, and one
   under each further order as well, before its sets are joined, first as 16
   bits a shingle, then, where these leave it possible, whole and exactly.

Sets are written once, in place; only those of candidate pairs travel. Signatures and shingles are
64-bit hashes: results are exact but for collisions (odds about n^2 / 2^65).

Edge cases: NULL, empty and blank texts have empty sets, link with nothing and
are components of their own; fewer than five words make one shingle; rows
repeat as they come; component ids are the least doc_id, NULL ids are larger
than any other; an empty table gives an empty result; columns beyond doc_id and
text are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import broadcast_below, by_value, dropped, in_small_batches, packed, trimmed, written
from .components import components
from .shingles import WordHashes, mix, shingle_set, signature

by_value(__name__)

K, PERCENT = 5, 80
ORDERS = 3
SEEDS = (0x243F6A8885A308D3, 0x13198A2E03707344, 0xA4093822299F31D0)
CHUNK = 1_000_000              # shingles counted together in a task
LEAST_LOCAL, LEAST_HEAVY, MAX_HEAVY = 2, 24, 2_000_000
MAX_BROADCAST_NODES = 4_000_000
OUT_ROWS = 500
BAND = 1.12                    # ratio of the bounds of a size band
EARLY = 6                      # shingles that a pair must share early in both prefixes
HUB_BITS, HUB_STEP = 8, 256    # a round has 2^8 times as many hubs as the one before


def prefix_length(n: int, percent: int = PERCENT) -> int:
    return n - -(-percent * n // 100) + 1


def _order(sets: np.ndarray, k: int) -> np.ndarray:
    return mix(sets ^ np.uint64(SEEDS[k]))


def frequent(docs: DataFrame) -> np.ndarray:
    """Sorted hashes of shingles that many different sets hold. Tasks count all
    their shingles and report those seen LEAST_LOCAL times; the sums that reach
    a threshold are kept, raised until they fit MAX_HEAVY."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, held, size, seen = WordHashes(fold=True), [], 0, set()

        def report() -> pa.RecordBatch:
            h, n = np.unique(np.concatenate(held), return_counts=True)
            many = n >= LEAST_LOCAL
            return pa.RecordBatch.from_arrays([pa.array(h[many].view(np.int64)), pa.array(n[many].astype(np.int64))], names=["h", "n"])
        for batch in batches:
            for w in words.texts(batch.column(0)):
                s = shingle_set(w)
                name = signature(s)
                if len(s) and name not in seen:
                    seen.add(name)
                    held.append(s)
                    size += len(s)
                if size >= CHUNK:
                    yield report()
                    held, size, seen = [], 0, set()
        if held:
            yield report()
    sums = written(in_small_batches(docs.select(F.col("text").cast("string").alias("text"))).mapInArrow(trimmed(count), "h long, n long")
                   .groupBy("h").agg(F.sum("n").alias("n")).where(F.col("n") >= LEAST_HEAVY), "jaccard-heavy")
    least = LEAST_HEAVY
    while sums.where(F.col("n") >= least).count() > MAX_HEAVY:
        least *= 4
    rows = sums.where(F.col("n") >= least).select("h").toPandas()          # at most MAX_HEAVY hashes
    return np.sort(rows["h"].to_numpy(np.int64).view(np.uint64))


def sets_of(docs: DataFrame, heavy) -> DataFrame:
    """rid, doc_id, sig, n, the first order's prefix and the words as 32-bit hashes,
    from which the set can be made again; of equal sets in a task only the first
    one carries them. ``heavy``: a broadcast variable."""
    id_type = docs.schema["doc_id"].dataType.simpleString()

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, seen, often = WordHashes(fold=True), set(), heavy.value
        rid = TaskContext.get().partitionId() << 40
        none = np.empty(0, np.int64)
        for batch in batches:
            for lo in range(0, batch.num_rows, OUT_ROWS):
                part = batch.slice(lo, OUT_ROWS)
                sigs, sizes, firsts, whole = [], [], [], []
                for w in words.texts(part.column(1)):
                    s = shingle_set(w)
                    sig, n = signature(s), len(s)
                    first, all_ = none, none.astype(np.int32)
                    if n and sig not in seen:
                        if len(seen) > 1_000_000:
                            seen.clear()
                        seen.add(sig)
                        key = _order(s, 0) >> np.uint64(1)
                        if len(often):
                            late = often[np.minimum(np.searchsorted(often, s), len(often) - 1)] == s
                            key[late] |= np.uint64(1 << 63)
                        p = prefix_length(n)
                        at = np.argpartition(key, p - 1)[:p] if p < n else np.arange(n)
                        first, all_ = s[at[np.argsort(key[at])]].view(np.int64), w.astype(np.uint32).view(np.int32)
                    for column, v in zip((sigs, sizes, firsts, whole), (sig, n, first, all_), strict=True):
                        column.append(v)
                yield pa.RecordBatch.from_arrays([pa.array(np.arange(rid, rid + part.num_rows)), part.column(0), pa.array(sigs, pa.int64()), pa.array(sizes, pa.int64()),
                                                  pa.array(firsts, pa.list_(pa.int64())), pa.array(whole, pa.list_(pa.int32()))],
                                                 names=["rid", "doc_id", "sig", "n", "prefix", "words"])
                rid += part.num_rows
    return in_small_batches(docs.select("doc_id", F.col("text").cast("string").alias("text"))).mapInArrow(
        trimmed(work), f"rid long, doc_id {id_type}, sig long, n long, prefix array<long>, words array<int>")


def other_orders(rows: DataFrame, nodes: DataFrame, n_nodes: int) -> DataFrame:
    """sig, shingles and the other orders' prefixes of the named nodes."""
    names = [f"p{k}" for k in range(1, ORDERS)]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, batch.num_rows, OUT_ROWS):
                part = batch.slice(lo, OUT_ROWS)
                sets = [shingle_set(x.values.to_numpy(zero_copy_only=False).view(np.uint32).astype(np.uint64)) for x in part.column(1)]
                first = [[s[np.argsort(_order(s, k))[:prefix_length(len(s))]].view(np.int64) for s in sets] for k in range(1, ORDERS)]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array([x.view(np.int64) for x in sets], pa.list_(pa.int64())), *[pa.array(f, pa.list_(pa.int64())) for f in first]], names=["sig", "shingles", *names])
    held = (rows.where(F.size("words") > 0).select("sig", "words")
            .join(broadcast_below(nodes, n_nodes, MAX_BROADCAST_NODES), "sig", "left_semi").dropDuplicates(["sig"]))
    return in_small_batches(held).mapInArrow(trimmed(work), "sig long, shingles array<long>" + "".join(f", {c} array<long>" for c in names))


def _possible_sizes(a: str, b: str):
    na, nb = F.col(f"{a}.n"), F.col(f"{b}.n")
    return F.least(na, nb) * 100 >= F.greatest(na, nb) * PERCENT


def _possible(a: str, b: str, q: int = 1):
    """Position filter: true at the first ``q`` shingles that two linked sets share."""
    na, nb, ia, ib = F.col(f"{a}.n"), F.col(f"{b}.n"), F.col(f"{a}.i"), F.col(f"{b}.i")
    return (q + F.least(na - ia, nb - ib)) * (100 + PERCENT) >= (na + nb) * PERCENT


def _prefix_share(a: str, b: str):
    """How many prefix shingles two linked sets share at least, from their
    sizes: linked sets share o = ceil(0.8 (na + nb) / 1.8) shingles, and the q-th
    shared one in the order stands at place na - o + q at most."""
    na, nb = F.col(f"{a}.n"), F.col(f"{b}.n")
    o = F.ceil((na + nb) * PERCENT / (100 + PERCENT))
    prefix = lambda n: n - F.ceil(n * PERCENT / 100) + 1
    return F.greatest(F.lit(1), F.least(prefix(na) - na + o, prefix(nb) - nb + o))


def enough_shared(shared: DataFrame) -> DataFrame:
    """(a, b) of the pairs (x, y), one row per shared prefix shingle, that share as
    many as linked sets must."""
    return (shared.where(_possible_sizes("x", "y"))
            .select(F.least("x.sig", "y.sig").alias("a"), F.greatest("x.sig", "y.sig").alias("b"),
                    _prefix_share("x", "y").alias("least"), _possible("x", "y").cast("int").alias("first"))
            .groupBy("a", "b").agg(F.count(F.lit(1)).alias("shared"), F.max("least").alias("least"), F.max("first").alias("first"))
            .where((F.col("shared") >= F.col("least")) & (F.col("first") == 1)).select("a", "b"))


def _short(shingles):
    """Distinct last 16 bits of the shingles of an array column."""
    return F.array_distinct(F.transform(shingles, lambda x: (x.bitwiseAND(F.lit(0xFFFF)) - 0x8000).cast("smallint")))


def verified(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs (a, b) that share a prefix shingle under every further order
    and whose sets are similar enough. Before whole sets meet, 16 bits a shingle do:
    what falls together that way counts as shared, so no pair is lost."""
    orders = [c for c in sets.columns if c.startswith("p")]
    def side(sets: DataFrame, name: str, *columns) -> DataFrame:
        return sets.select(F.col("sig").alias(name), *[c.alias(f"{name}_{k}") for k, c in enumerate(columns)])
    prefixes = [_short(c) for c in orders]
    near = pairs.join(side(sets, "a", *prefixes), "a").join(side(sets, "b", *prefixes), "b")
    for k in range(len(orders)):
        near = near.where(F.arrays_overlap(f"a_{k}", f"b_{k}"))
    short = _short("shingles")
    size = F.size("shingles")
    near = written(near.select("a", "b"), "jaccard-near")
    both = near.join(side(sets, "a", short, size), "a").join(side(sets, "b", short, size), "b")
    # a shared shingle stands behind a shared value, or behind one that a's shingles share among themselves
    shared = F.size(F.array_intersect("a_0", "b_0")) + F.col("a_1") - F.size("a_0")
    close = written(both.where(shared * (100 + PERCENT) >= (F.col("a_1") + F.col("b_1")) * PERCENT).select("a", "b"), "jaccard-close")
    nodes = _nodes(close)
    sets = sets.join(broadcast_below(nodes, nodes.count(), MAX_BROADCAST_NODES), "sig", "left_semi")
    both = close.join(side(sets, "a", F.col("shingles")), "a").join(side(sets, "b", F.col("shingles")), "b")
    shared = F.size(F.array_intersect("a_0", "b_0"))
    union = F.size("a_0") + F.size("b_0") - shared
    return both.where(shared * 100 >= union * PERCENT).select("a", "b")


def _linked(pairs: DataFrame, rows: DataFrame) -> DataFrame:
    """The verified ones of ``pairs``; only their nodes' sets are read."""
    nodes = _nodes(pairs)
    sets = written(other_orders(rows, nodes, nodes.count()), "jaccard-sets")
    out = written(verified(pairs, sets), "jaccard-linked")
    dropped(sets, nodes)
    return out


def _open(rows: DataFrame, label: DataFrame) -> DataFrame:
    """The bucket rows (token, sig, n, i, level) of buckets that span components, with the row's label."""
    rows = rows.select("token", "sig", "n", "i", "level")
    label = broadcast_below(label.withColumnRenamed("node", "sig"), label.count(), MAX_BROADCAST_NODES)
    known = rows.join(label, "sig", "left").withColumn("label", F.coalesce("label", "sig"))
    spans = known.groupBy("token").agg((F.min("label") != F.max("label")).alias("spans")).where("spans").select("token")
    return written(known.join(spans, "token"), "jaccard-open")


def _band(n):
    return F.floor(F.log(n) / F.log(F.lit(BAND))).cast("int")


def banded(left: DataFrame, level: int, above: int) -> DataFrame:
    """The pairs (a, b) of different components that may link by their sizes and
    the places of EARLY shared shingles (fewer where the sizes ask for fewer), with a hub of at least ``level`` on one side and none of ``above``."""
    member = F.struct("sig", "n", "i", "label", "level")
    n, i, o = F.col("n"), F.col("i"), PERCENT / (100 + PERCENT)
    most = F.least(n.cast("double"), (n + EARLY - i) / o - n)                   # size of a smaller set that may link
    left = left.where(F.col("level") < above)
    probe = left.where(most >= n * (PERCENT / 100) - 1).select(
        "token", F.explode(F.sequence(_band(F.greatest(n * (PERCENT / 100) - 1, F.lit(1.0))), _band(F.greatest(most + 1, F.lit(1.0))))).alias("band"), member.alias("x"))
    index = left.where(i <= n + EARLY + 1 - 2 * o * n).select("token", _band(n).alias("band"), member.alias("y"))
    larger = (F.col("x.n") > F.col("y.n")) | (F.col("x.n") == F.col("y.n")) & (F.col("x.sig") < F.col("y.sig"))
    fits = larger & (F.col("x.label") != F.col("y.label")) & _possible_sizes("x", "y") & _possible("x", "y", EARLY)
    met = probe.where(F.col("x.level") >= level).join(index, ["token", "band"]).where(fits)
    if level:
        met = met.unionByName(probe.where(F.col("x.level") < level).join(index.where(F.col("y.level") >= level), ["token", "band"]).where(fits))
    asked = F.least(F.lit(EARLY), _prefix_share("x", "y"))
    return (met.select(F.col("x.sig").alias("a"), F.col("y.sig").alias("b"), F.col("x.n").alias("na"), F.col("y.n").alias("nb"), asked.alias("asked"))
            .groupBy("a", "b", "na", "nb", "asked").agg(F.count(F.lit(1)).alias("early")).where("early >= asked").select("a", "b", "na", "nb"))


def _nodes(pairs: DataFrame) -> DataFrame:
    each = pairs.select(F.col("a").alias("sig")).distinct().unionByName(pairs.select(F.col("b").alias("sig")).distinct())
    return written(each.distinct(), "jaccard-nodes")


def sharing(pairs: DataFrame, rows: DataFrame) -> DataFrame:
    """(a, b), a the lesser one, of the ``pairs`` that share as many prefix shingles
    as linked sets must. Only prefixes of their nodes travel, 16 bits a shingle:
    what falls together that way is added to the count, so no pair is lost."""
    nodes = _nodes(pairs)
    prefixes = rows.where(F.size("prefix") > 0).select("sig", "prefix").join(broadcast_below(nodes, nodes.count(), MAX_BROADCAST_NODES), "sig", "left_semi")
    short = _short("prefix")
    prefixes = written(prefixes.dropDuplicates(["sig"]).select("sig", short.alias("p"), (F.size("prefix") - F.size(short)).alias("lost")), "jaccard-prefixes")
    both = (pairs.join(prefixes.select(F.col("sig").alias("a"), "p", "lost"), "a")
            .join(prefixes.select(F.col("sig").alias("b"), F.col("p").alias("q")), "b"))
    x, y = F.struct(F.col("na").alias("n")), F.struct(F.col("nb").alias("n"))
    out = written(both.select("*", x.alias("x"), y.alias("y")).where(F.size(F.array_intersect("p", "q")) + F.col("lost") >= _prefix_share("x", "y"))
                  .select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")), "jaccard-sharing")
    dropped(nodes, prefixes)
    return out


def join(docs: DataFrame) -> DataFrame:
    """Per row: doc_id, n_shingles, component_id."""
    heavy = docs.sparkSession.sparkContext.broadcast(frequent(docs))
    rows = written(sets_of(docs, heavy), "jaccard-rows")
    heavy.destroy()
    # of the rows that carry a set in different tasks, the first one stands for it
    carried = rows.where(F.size("prefix") > 0)
    firsts = carried.groupBy("sig").agg(F.min("rid").alias("first"), F.count(F.lit(1)).alias("times")).where("times > 1")
    again = written(carried.select("sig", "rid").join(firsts, "sig").where("rid > first").select("rid"), "jaccard-again")
    tokens = (carried.join(broadcast_below(again, again.count(), MAX_BROADCAST_NODES), "rid", "left_anti")
              .select("sig", F.col("n").cast("int").alias("n"), F.posexplode("prefix").alias("i", "token")).withColumn("i", F.col("i") + 1))
    # counts and hubs per token are combined map-side and written, so that the joins back may be split at a hot token
    node = F.struct("sig", "n", "i")
    tokens = written(tokens, "jaccard-tokens")
    many = written(tokens.groupBy("token").agg(F.count(F.lit(1)).alias("held")).where("held > 1"), "jaccard-many")
    held = written(tokens.join(many, "token"), "jaccard-held")
    dropped(tokens)
    # a text that others were copied from shares all its shingles with many; its weight tells how many on average
    weight = held.groupBy("sig").agg(F.sum("held").alias("all_held"))
    weighed = written(held.drop("held").join(weight, "sig").withColumn(
        "w", F.floor(F.col("all_held") * 1000 / (F.col("n") - F.ceil(F.col("n") * PERCENT / 100) + 1))).drop("all_held"), "jaccard-weighed")
    largest = many.agg(F.max("held")).first()[0] or 0
    dropped(held, many)
    hubs = written(weighed.groupBy("token").agg(F.max(F.struct("w", "sig", "n", "i")).alias("hub")), "jaccard-hubs")

    # every member with its bucket's weightiest member
    buckets = weighed.join(hubs, "token")
    stars = written(enough_shared(buckets.select(node.alias("x"), F.col("hub").alias("y")).where("x.sig != y.sig")), "jaccard-stars")
    dropped(hubs)
    links = written(_linked(stars, rows), "jaccard-links")
    label = components(links)

    # then members of different components, in rounds of more and more hubs
    zeros = F.length(F.regexp_extract(F.bin(F.xxhash64(F.lit(8), "sig")), "(0*)$", 1))
    left = weighed.drop("w").withColumn("level", F.floor(zeros / HUB_BITS).cast("int"))
    level, above, old = 0, 1_000, weighed
    while HUB_STEP ** (level + 1) < largest:
        level += 1
    while level >= 0:
        left = _open(left, label)
        dropped(old)
        found = written(banded(left, level, above), "jaccard-found")
        tried = written(sharing(found, rows).join(stars, ["a", "b"], "left_anti"), "jaccard-tried")
        if not tried.isEmpty():
            more = _linked(tried, rows)
            if not more.isEmpty():
                links = written(links.unionByName(more), "jaccard-links")
                label = components(links)
        old, left, level, above = left, left.drop("label"), level - 1, level

    named = rows.where("n > 0").groupBy("sig").agg(F.min("doc_id").alias("first"))
    named = named.join(label.withColumnRenamed("node", "sig"), "sig", "left").withColumn("label", F.coalesce("label", "sig"))
    least = named.groupBy("label").agg(F.min("first").alias("component_id"))
    named = written(named.join(least, "label").select("sig", "component_id"), "jaccard-named")
    return (rows.select("doc_id", "sig", "n").join(named, "sig", "left")
            .select("doc_id", F.col("n").alias("n_shingles"),
                    F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id")))


def one_of_each(docs: DataFrame) -> DataFrame:
    """``docs`` with one document of each component, that of the least doc_id
    (and its repeats, if its row repeats). Only ids and text digests of the others
    meet the texts, so another text under the same doc_id stays; rows without a
    doc_id stay."""
    text = F.col("text").cast("string")
    digest = F.unhex(F.sha2(text.cast("binary"), 256)).alias("digest")
    each = docs.select(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", digest).alias("doc_id"), text.alias("text"))
    out = written(join(each).where(F.col("doc_id.doc_id") != F.col("component_id.doc_id"))
                  .select(F.col("doc_id.doc_id").alias("gone_id"), F.col("doc_id.digest").alias("gone_digest")).distinct(), "jaccard-gone")
    rows = packed(docs, F.col("doc_id").alias("id"), digest)
    return rows.join(broadcast_below(out, out.count(), MAX_BROADCAST_NODES),
                     (F.col("id") == F.col("gone_id")) & (F.col("digest") == F.col("gone_digest")), "left_anti").select("row.*")
