"""Ranked lexical search with the Best Position Algorithm.

Every task holds an inverted index of its own documents (an impact list per
query term: documents by falling impact) and answers all queries on it; the
best of each task are merged. No list passes through one task whole, so a term
that every document holds costs each task its own share.

1. Documents are read once: their number of terms and the frequencies of the
   query's terms are written; N, L and document frequencies are sums over that.
2. Within a task, documents go in runs of bounded size. For one query on a run,
   sorted access reads the lists from their best positions on, all at once;
   each document met is looked up directly in every other list, which gives its
   whole score and marks its positions there as seen.
3. A list's *best position* is the last one up to which all are seen. A document
   not met yet stands behind it in every list, so it scores at most the sum of
   the impacts that follow the best positions. Once that is strictly below the
   k-th score so far, the run can't change the result, nor a tie, and it ends.
   The k-th score carries over from run to run.

Weights are 64-bit integers as the formula says: exact sums, ties by doc_id.

Queries are a stated set; they are dealt into blocks of at most MAX_TERM_BYTES of
text by hash, and each block is searched against all documents.

Edge cases: NULL and empty texts have no terms, are not counted and rank
nowhere; a query without a known term has no rows; fewer than k documents with
a score above 0 are all returned; repeated documents rank one by one; at equal
scores the lower doc_id comes first, NULL last; repeated or NULL item_ids are
answered row by row; empty tables give an empty result; columns beyond doc_id,
item_id and text are ignored.
"""

from __future__ import annotations

import collections
import heapq
from collections.abc import Iterator
from math import floor, log

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from .common import by_value, in_small_batches, trimmed, written

by_value(__name__)

K = 20
MAX_TERM_BYTES = 4_000_000    # query text that is broadcast at once
RUN_POSTINGS = 1_500_000       # index entries per run
STEP = 64                      # positions read per list in a first sorted access
# Terms: maximal runs of letters and digits, any sign from 80 on included; only A-Z are lower-cased.
TABLE = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256))


def terms(text: bytes) -> list[bytes]:
    return text.translate(TABLE).split()


def binary(column: str = "text"):
    return F.col(column).cast("string").cast("binary").alias("text")


def weight(n_docs: int, df: int) -> int:
    return floor(1000 * log((2 * n_docs + 2) / (2 * df + 1)))


def postings(docs: DataFrame, numbers) -> DataFrame:
    """doc_id, n (terms of the document) and its query terms (by number) with
    their frequencies. ``numbers``: broadcast dictionary of the terms."""
    id_type = docs.schema["doc_id"].dataType.simpleString()

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = numbers.value
        for batch in batches:
            sizes, held, often = [], [], []
            for text in batch.column(1):
                found = terms(text.as_py() or b"")
                count = collections.Counter(filter(number.__contains__, found))
                sizes.append(len(found))
                held.append(np.fromiter((number[t] for t in count), np.int32, len(count)))
                often.append(np.fromiter(count.values(), np.int64, len(count)))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sizes, pa.int64()), pa.array(held, pa.list_(pa.int32())), pa.array(often, pa.list_(pa.int64()))],
                                             names=["doc_id", "n", "terms", "often"])
    return in_small_batches(docs.select("doc_id", binary())).mapInArrow(trimmed(work), f"doc_id {id_type}, n long, terms array<int>, often array<long>")


class ImpactLists:
    """The inverted index of a run of documents, numbered by rising doc_id."""

    def __init__(self, n: np.ndarray, size: np.ndarray, term: np.ndarray, tf: np.ndarray, weights: np.ndarray, n_docs: int, n_terms: int):
        m = 75 + (25 * n * n_docs) // max(n_terms, 1)
        doc = np.repeat(np.arange(len(n)), size)
        impact = weights[term] * ((1_000_000_000 * tf) // (1000 * tf + 12 * m[doc]))
        self.n_docs = len(n)
        by_impact = np.lexsort((doc, -impact, term))
        self.doc, self.impact = doc[by_impact], impact[by_impact]
        self.starts = np.searchsorted(term[by_impact], np.arange(len(weights) + 1))
        # for direct access: a term's documents in order, with their positions
        order = np.lexsort((self.doc, term[by_impact]))
        self.of_doc, self.position = self.doc[order], order

    def best(self, asked: list[tuple[int, int]], k: int, floor_score: int) -> tuple[np.ndarray, np.ndarray, int]:
        """(documents, scores, positions read) of those that may be among the k best,
        all with a score of ``floor_score`` at least and above 0. ``asked``: (term, times)."""
        lists = [(int(a), int(b), q) for t, q in asked for a, b in [self.starts[t:t + 2]] if b > a and self.impact[a] > 0]
        met = np.zeros(self.n_docs, bool)
        seen = [np.zeros(b - a + 1, bool) for a, b, _ in lists]         # the place behind the end stays unseen
        best = [0] * len(lists)                                         # positions all seen up to here
        docs, scores, kth, step, read = [np.empty(0, np.int64)], [np.empty(0, np.int64)], max(floor_score, 0), STEP, 0
        top = np.empty(0, np.int64)
        while lists:
            new = np.unique(np.concatenate([self.doc[a + at:min(a + at + step, b)] for (a, b, _), at in zip(lists, best, strict=True)]))
            new = new[~met[new]]
            met[new] = True
            score = np.zeros(len(new), np.int64)
            for j, (a, b, q) in enumerate(lists):                       # direct access
                at = np.searchsorted(self.of_doc[a:b], new)
                hit = at < b - a
                hit[hit] = self.of_doc[a:b][at[hit]] == new[hit]
                place = self.position[a:b][at[hit]] - a
                score[hit] += q * self.impact[a + place]
                seen[j][place] = True
                best[j] += int(np.argmin(seen[j][best[j]:]))
                read += len(place)
            docs.append(new)
            scores.append(score)
            top = np.concatenate([top, score])
            if len(top) > k:
                top = np.partition(top, len(top) - k)[-k:]
            if len(top) == k:
                kth = max(kth, int(top.min()))
            bound = sum(q * int(self.impact[a + at]) for (a, b, q), at in zip(lists, best, strict=True) if a + at < b)
            if bound < kth or bound == 0:
                break
            step *= 2
        doc, score = np.concatenate(docs), np.concatenate(scores)
        kept = (score >= kth) & (score > 0)
        return doc[kept], score[kept], read


def runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    held, size = [], 0
    for batch in batches:
        held.append(batch)
        size += len(batch.column("terms").flatten()) + batch.num_rows
        if size >= RUN_POSTINGS:
            yield pa.Table.from_batches(held).combine_chunks()
            held, size = [], 0
    if held:
        yield pa.Table.from_batches(held).combine_chunks()


def search_block(index: DataFrame, items, weights: np.ndarray, n_docs: int, n_terms: int, k: int) -> DataFrame:
    """(item, doc_id, score): the k best of each task. ``items``: broadcast list of (term, times) lists."""
    shared = index.sparkSession.sparkContext.broadcast((weights, n_docs, n_terms))
    id_type, arrow_id = index.schema["doc_id"].dataType.simpleString(), to_arrow_type(index.schema["doc_id"].dataType)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        w, n, total = shared.value
        kept: list[list] = [[] for _ in items.value]            # per item: (score, doc_id)
        for run in runs(batches):
            run = run.take(pc.sort_indices(run, [("doc_id", "ascending")], null_placement="at_end"))
            ids, held = run.column("doc_id").to_pylist(), run.column("terms").combine_chunks()
            lists = ImpactLists(run.column("n").to_numpy(), np.diff(held.offsets.to_numpy()), held.flatten().to_numpy(zero_copy_only=False),
                                run.column("often").combine_chunks().flatten().to_numpy(zero_copy_only=False), w, n, total)
            for mine, asked in zip(kept, items.value, strict=True):
                doc, score, _ = lists.best(asked, k, min(x[0] for x in mine) if len(mine) == k else 0)
                if len(doc):
                    mine += [(s, ids[d]) for d, s in zip(doc.tolist(), score.tolist(), strict=True)]
                    mine[:] = heapq.nsmallest(k, mine, key=lambda x: (-x[0], x[1] is None, x[1] if x[1] is not None else 0))
        out = [(i, d, s) for i, mine in enumerate(kept) for s, d in mine]
        if out:
            item, doc_id, score = zip(*out, strict=True)
            yield pa.RecordBatch.from_arrays([pa.array(item, pa.int32()), pa.array(doc_id, arrow_id), pa.array(score, pa.int64())], names=["item", "doc_id", "score"])

    return index.mapInArrow(trimmed(work), f"item int, doc_id {id_type}, score long")


def search(docs: DataFrame, items: DataFrame, k: int = K) -> DataFrame:
    """item_id, rank, doc_id, score: each item's k documents of the highest scores above 0."""
    spark = docs.sparkSession
    asked = written(items.select("item_id", F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")), "search-items")
    size = asked.agg(F.sum(F.octet_length("text") + 1)).first()[0] or 0
    blocks = -(-size // MAX_TERM_BYTES)
    out = spark.createDataFrame([], f"item_id {items.schema['item_id'].dataType.simpleString()}, rank int, doc_id {docs.schema['doc_id'].dataType.simpleString()}, score long")
    for block in range(blocks):
        mine = asked.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == block).collect()       # MAX_TERM_BYTES on average
        numbers: dict[bytes, int] = {}
        wanted = [[(numbers.setdefault(t, len(numbers)), q) for t, q in collections.Counter(terms(r.text.encode())).items()] for r in mine]
        if not numbers:
            continue
        sc = spark.sparkContext
        index = written(postings(docs, sc.broadcast(numbers)), "search-postings")
        n_docs, n_terms = index.where("n > 0").agg(F.count(F.lit(1)), F.sum("n")).first()
        if not n_docs:
            continue
        weights = np.zeros(len(numbers), np.int64)
        for r in index.select(F.explode("terms").alias("t")).groupBy("t").agg(F.count(F.lit(1)).alias("df")).collect():   # the block's terms
            weights[r.t] = weight(n_docs, r.df)
        found = search_block(index.where("n > 0"), sc.broadcast(wanted), weights, n_docs, n_terms, k)
        ranked = found.withColumn("rank", F.row_number().over(Window.partitionBy("item").orderBy(F.desc("score"), F.col("doc_id").asc_nulls_last()))).where(F.col("rank") <= k)
        names = spark.createDataFrame([(i, r.item_id) for i, r in enumerate(mine)], f"item int, item_id {items.schema['item_id'].dataType.simpleString()}")
        out = out.unionByName(ranked.join(F.broadcast(names), "item").select("item_id", "rank", "doc_id", "score"))
    return out
