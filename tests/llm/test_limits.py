"""What keeps operators within their limits, each beside brute force where results could change."""

import random

import numpy as np
import pyarrow as pa

from hexflow.llm import op4_bpe, op8_jaccard_join, op9_passages
from hexflow.llm.shingles import WordHashes, shingle_set


def test_an_alignment_is_laid_out_once(monkeypatch):
    """A chain's runs are followed once, whether or not its alignment reaches the end of the words given."""
    r, calls, real = np.random.default_rng(5), [], op9_passages._runs
    other = lambda n: r.integers(0, 2**62, n, dtype=np.uint64)
    a = other(3_000)
    x, y = np.concatenate([other(70), a, other(70)]), np.concatenate([other(40), a, other(90)])
    monkeypatch.setattr(op9_passages, "_runs", lambda *v: calls.append(1) or real(*v))
    got = op9_passages.followed(x, y, [(np.array([1_570]), np.array([1_540]))])
    assert got == [(70, 3_070, 40, 3_040, 3_000)]
    assert len(calls) == 2                  # 480 words around the chain, then 3,840
    assert op9_passages.align(x[:1_600], y[:1_570], np.array([1_570]), np.array([1_540]), after=True) is None


def test_straight_chains_equal_crossing_ones():
    r = random.Random(21)
    for _ in range(300):
        xs, ys = (sorted(r.sample(range(r.choice([40, 400, 4_000])), r.randint(1, 20))) for _ in range(2))
        n = min(len(xs), len(ys))
        assert op9_passages._straight(xs[:n], ys[:n]) == op9_passages._crossing(xs[:n], ys[:n])
    assert op9_passages._straight([1, 2], [5, 5]) is None and op9_passages._straight([1, 1], [5, 6]) is None


def test_shingles_that_many_tasks_hold_twice_are_frequent(spark):
    """Of a shingle that 16 tasks see twice each (once is not told) the order must know, or its bucket is met by all."""
    rows = [(i, " ".join(["one line that all hold"] + [f"w{i}x{j}" for j in range(20)])) for i in range(32)]
    docs = spark.createDataFrame(spark.sparkContext.parallelize(rows, 16), "doc_id long, text string")
    line = shingle_set(next(WordHashes(fold=True).texts(pa.array(["one line that all hold"]))))
    assert op8_jaccard_join.frequent(docs).tolist() == line.tolist()


def test_short_sets_lose_no_pair(spark):
    """verified() equals brute force where shingles fall together in their last 16 bits, within a set and across."""
    r = random.Random(3)
    pool = [(i << 16) | (i % 7) for i in range(1, 60)]
    sets = [sorted(r.sample(pool, r.randint(45, 58))) for _ in range(30)] + [[5], [5 | 1 << 20], [5, 9]]
    nodes = spark.createDataFrame([(i, s, s[:12], s[:12]) for i, s in enumerate(sets)], "sig long, shingles array<long>, p1 array<long>, p2 array<long>")
    pairs = [(a, b) for a in range(len(sets)) for b in range(a + 1, len(sets)) if set(sets[a][:12]) & set(sets[b][:12])]
    got = op8_jaccard_join.verified(spark.createDataFrame(pairs, "a long, b long"), nodes)
    want = {(a, b) for a, b in pairs if 100 * len(set(sets[a]) & set(sets[b])) >= 80 * len(set(sets[a]) | set(sets[b]))}
    assert want and {tuple(x) for x in got.collect()} == want


def test_bpe_encodes_a_megabyte_at_a_time():
    """The index of a run's new pre-tokens is what a worker needs most memory for."""
    texts = pa.record_batch([pa.array([f"{i} " * 400 for i in range(3_000)])], names=["text"])
    sizes = [run.nbytes for run in op4_bpe.runs(iter([texts]), 0, op4_bpe.RUN_BYTES)]
    assert sum(sizes) > 3_000_000 and max(sizes) < 1_100_000 and op4_bpe.OUT_ROWS <= 250
