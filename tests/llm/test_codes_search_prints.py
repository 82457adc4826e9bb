"""Vector codes, lexical search and fingerprints against brute force."""

import collections
import hashlib
import math
import random
import re

import numpy as np
import pytest
from tests.llm import brute
from tests.llm.test_operators import CLASH, LONG, ODD, SF, prose

from hexflow.llm import op11_codes, op12_search, op13_minhash, queries


@pytest.fixture(scope="module")
def odd(spark):
    from pyspark.sql import functions as F
    df = spark.createDataFrame(ODD, "doc_id long, text string, source string").repartition(3)
    return df.withColumns({k: F.lit(v) for k, v in CLASH.items()})


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


def plain_codes(rows, parts, entries, rounds):
    """(vec_id, label, components) -> ({row: (code, error)}, entries), one comparison at a time."""
    def distance(x, y):
        return sum((a - b) ** 2 for a, b in zip(x, y, strict=True))
    width = max(-(-max(len(v) for _, _, v in rows) // parts), 1) * parts
    vs = [list(v) + [0] * (width - len(v)) for _, _, v in rows]
    w = width // parts
    first = sorted(range(len(rows)), key=lambda i: (rows[i][0] is None, rows[i][0] or 0, vs[i]))[:entries]
    books = [[vs[i][p * w:(p + 1) * w] for i in first] for p in range(parts)]

    def assign():
        return [[min(range(len(books[p])), key=lambda e: (distance(v[p * w:(p + 1) * w], books[p][e]), e)) for p in range(parts)] for v in vs]
    for _ in range(rounds):
        codes = assign()
        for p in range(parts):
            for e in range(len(books[p])):
                mine = [v[p * w:(p + 1) * w] for v, c in zip(vs, codes, strict=True) if c[p] == e]
                if mine:
                    books[p][e] = [sum(x) // len(mine) for x in zip(*mine, strict=True)]
    codes = assign()
    return [(c, sum(distance(v[p * w:(p + 1) * w], books[p][c[p]]) for p in range(parts))) for v, c in zip(vs, codes, strict=True)], books


def test_codes_against_plain_method(spark):
    r = random.Random(3)
    nan, inf = float("nan"), float("inf")
    rows = [(i, [r.choice([-0.5, 0.0, 0.25, r.gauss(0, 1)]) for _ in range(8)], r.choice([None, 1, 2])) for i in range(60)]
    rows += [(7, [0.5] * 8, 1), (7, [0.5] * 8, 1), (None, [0.1] * 8, None), (200, [], 2), (201, [1.0], 3), (202, [-3.0] * 7, 3)]
    bad = [(300, None, 1), (301, [1.0, None], 1), (302, [nan] * 8, 1), (303, [inf] * 8, 1), (304, [-inf, 0.0], None)]
    df = spark.createDataFrame(rows + bad, "vec_id long, embedding array<float>, label int").selectExpr("*", "1 AS v", "2 AS code", "3 AS far").repartition(3)
    got = op11_codes.compress(df, parts=4, entries=5).collect()
    vectors = [(i, lab, [math.floor(256 * float(np.float32(x))) for x in v]) for i, v, lab in rows]
    codes, books = plain_codes(vectors, 4, 5, 2)
    sums = collections.Counter()
    for (_, lab, _), (_, error) in zip(vectors, codes, strict=True):
        sums[lab] += error
    want = collections.Counter((i, lab, tuple(c), error, sums[lab]) for (i, lab, _), (c, error) in zip(vectors, codes, strict=True))
    assert collections.Counter((x.vec_id, x.label, tuple(x.code), x.error, x.label_error) for x in got) == want
    sha = hashlib.sha256(",".join(str(x) for p in books for e in p for x in e).encode()).hexdigest()
    assert {x.codebooks_sha256 for x in got} == {sha}
    assert op11_codes.compress(df.where("vec_id >= 300")).count() == 0
    assert op11_codes.compress(df.where("1 = 0")).count() == 0
    assert op11_codes.compress(df.where("vec_id = 200")).first().error == 0
    huge = spark.createDataFrame([(1, [3e38, -3e38], 1), (2, [1.0, 1.0], 1)], "vec_id long, embedding array<float>, label int")
    assert [x.error for x in op11_codes.compress(huge).collect()] == [0, 0]


def test_balls_compare_less_and_assign_the_same():
    r = np.random.default_rng(1)
    centres = r.integers(-5000, 5000, (2, 20, 3))
    books = op11_codes.Codebooks(centres)
    v = (centres[:, r.integers(0, 20, 2000), :] + r.integers(-90, 90, (2, 2000, 3))).swapaxes(0, 1)
    old, far = books.first_assignment(v)
    shift = r.integers(-200, 200, centres.shape)
    far_of = np.zeros((2, 20), np.int64)
    for p in range(2):
        np.maximum.at(far_of[p], old[:, p], far[:, p])
    later = op11_codes.Codebooks(centres + shift, far_of, (shift ** 2).sum(axis=2))
    met = []
    plain = later.distances
    later.distances = lambda x, p, e: met.append(len(x)) or plain(x, p, e)
    code, d = later.assignment(v, old)
    want, least = later.first_assignment(v)
    assert (code == want).all() and (d == least).all()
    assert later.last.mean() < 10 and sum(met) < 0.3 * 20 * 2 * len(v)


def plain_search(docs, items, k=20):
    def terms(t):
        return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", brute.lower(t))
    each = [(i, terms(t)) for i, t in docs]
    big_n, big_l = sum(bool(t) for _, t in each), sum(len(t) for _, t in each)
    df = collections.Counter(t for _, ts in each for t in set(ts))
    counts = [(i, len(ts), collections.Counter(ts)) for i, ts in each if ts]
    out = []
    for item, text in items:
        scores = []
        for i, n, tf in counts:
            m = 75 + (25 * n * big_n) // big_l
            s = sum(math.floor(1000 * math.log((2 * big_n + 2) / (2 * df[t] + 1))) * ((1000000000 * tf[t]) // (1000 * tf[t] + 12 * m)) for t in terms(text) if t in tf)
            if s > 0:
                scores.append((-s, i is None, i or 0, i))
        out += [(item, rank, x[3], -x[0]) for rank, x in enumerate(sorted(scores)[:k], 1)]
    return collections.Counter(out)


def test_search_against_all_documents(spark, docs, odd):
    items = [(1, "one two three two"), (1, "one two three two"), (2, None), (3, ""), (None, "alpha3 ALPHA3 beta7"), (4, "unheard of"), (5, "ΣΑΣ é 'll"),
             (6, "w"), (7, "1 2 3 4"), (8, prose(1, 300))]
    benchmark = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    for df, asked in ((docs, benchmark), (odd, items)):
        table = spark.createDataFrame(asked, "item_id long, text string").selectExpr("*", "1 AS rank", "2 AS score", "3 AS item")
        got = collections.Counter(tuple(r) for r in op12_search.search(df.repartition(4), table).collect())
        assert got == plain_search([(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()], asked)
    assert op12_search.search(odd.where("1 = 0"), table).count() == 0
    assert op12_search.search(odd, table.where("1 = 0")).count() == 0
    assert op12_search.search(odd.where("text IS NULL"), table).count() == 0


def test_search_in_blocks_and_runs(spark, docs, monkeypatch):
    benchmark = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").limit(12).collect()]
    table = spark.createDataFrame(benchmark, "item_id long, text string")
    monkeypatch.setattr(op12_search, "MAX_TERM_BYTES", 900)
    monkeypatch.setattr(op12_search, "RUN_POSTINGS", 500)
    got = collections.Counter(tuple(r) for r in op12_search.search(docs.repartition(2), table, k=3).collect())
    assert got == plain_search([(r.doc_id, r.text) for r in docs.collect()], benchmark, k=3)


def test_best_positions_stop_early():
    r = np.random.default_rng(2)
    n, words = 20_000, 6
    common = [(d, t) for t in range(2, words) for d in r.choice(n, n // 2, replace=False)]
    rare = [(d, t) for t in (0, 1) for d in [*range(500, 540), *r.choice(n, 20, replace=False)]]
    pairs = np.unique(np.array(common + rare).T, axis=1)
    tf = r.integers(1, 9, pairs.shape[1])
    size = np.bincount(pairs[0], minlength=n)
    weights = np.array([7000, 6000, 700, 500, 300, 100])
    lists = op12_search.ImpactLists(np.full(n, 100), size, pairs[1], tf, weights, n, 100 * n)
    asked = [(t, 1 + t % 2) for t in range(words)]
    docs, scores, read = lists.best(asked, 5, 0)
    whole = np.zeros(n, np.int64)
    for t, q in asked:
        a, b = lists.starts[t:t + 2]
        whole[lists.doc[a:b]] += q * lists.impact[a:b]
    kth = np.sort(whole)[-5]
    assert sorted(docs.tolist()) == np.flatnonzero(whole >= kth).tolist()       # ties stay
    assert (whole[docs] == scores).all() and read < 0.25 * pairs.shape[1]
    assert len(lists.best(asked, 5, int(whole.max()) + 1)[0]) == 0


def test_edited_fingerprints(spark, docs, odd):
    for df in (docs, odd):
        rows = [(r.doc_id, r.text or "") for r in df.select("doc_id", "text").collect()]
        order = sorted(rows, key=lambda x: (x[0] is None, -(x[0] or 0)))
        want = collections.Counter()
        for i, (doc_id, text) in enumerate(order):
            following = order[(i + 1) % len(order)][1]
            changed = text[:len(text) - len(text) // 2] + following[:len(text) // 2]
            want[doc_id, len(text), brute.sha(changed)] += 1
        got = op13_minhash.edited(df.repartition(5)).collect()
        assert collections.Counter((r.doc_id, r.n_chars, r.edited_sha256) for r in got) == want
        prints = collections.defaultdict(set)
        for r in op13_minhash.fingerprints(df).collect():
            prints[r.doc_id].add(r.fingerprint)
        assert all(r.fingerprint in prints[r.doc_id] for r in got)
        assert all(0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1 for r in got)
    one = op13_minhash.edited(docs.where("doc_id = 3")).collect()
    assert len(one) == 1 and one[0].near_next == 1.0
    assert op13_minhash.edited(odd.where("1 = 0")).count() == 0


def test_next_text_of_a_doc_id_on_many_rows(spark):
    rows = [(5, "same old text")] * 400 + [(5, f"text number {i}") for i in range(200)] + [(i, prose(i, 30)) for i in range(100, 500)] + [(None, "none")] * 50
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(7)
    got = op13_minhash.edited(df).collect()
    assert collections.Counter(r.doc_id for r in got) == collections.Counter(i for i, _ in rows)
    order = sorted((i for i in range(100, 500)), reverse=True)
    by_id = {r.doc_id: r for r in got if r.doc_id and r.doc_id >= 100}
    texts = dict(rows[600:1000])
    for a, b in zip(order, order[1:], strict=False):
        t = texts[a]
        assert by_id[a].edited_sha256 == brute.sha(t[:len(t) - len(t) // 2] + texts[b][:len(t) // 2])


def test_minima_of_many_texts_at_once(monkeypatch):
    texts = ["", "one", " a b c d e f ", prose(3, 400), "one", "x " * 50, LONG[:30_000], "A b C"]
    mh = op13_minhash.MinHash()
    minima, number = mh.of(texts)
    for t, m, n in zip(texts, minima, number.tolist(), strict=True):
        w = brute.words(brute.lower(t))
        assert n == (max(len(w) - 4, 1) if w else 0)
        x, _ = mh.shingles([t])
        with np.errstate(over="ignore"):
            each = [op13_minhash.mix((x * a + b).min(keepdims=True)).astype(np.uint16)[0] if len(x) else 0 for a, b in zip(mh.a, mh.b, strict=True)]
        assert each == m.tolist()
    monkeypatch.setattr(op13_minhash, "CHUNK", 97)
    assert (mh.of(texts)[0] == minima).all()
    assert (minima[1] == minima[4]).all() and op13_minhash.packed_places(minima, number)[0].as_py() == b""


def test_likeness_estimates_jaccard():
    mh, error = op13_minhash.MinHash(), []
    base = prose(11, 300).split()
    for cut in range(20, 300, 20):
        a, b = " ".join(base), " ".join(base[:cut] + prose(cut, 300 - cut).split())
        x, y = brute.shingles(a), brute.shingles(b)
        m, n = mh.of([a, b])
        error.append(abs(op13_minhash.likeness(m[:1], n[:1], m[1:], n[1:])[0] - len(x & y) / len(x | y)))
    assert max(error) < 0.15 and sum(error) / len(error) < 0.05


def test_near_duplicates(spark, docs, odd):
    for df in (docs, odd.where("doc_id IS NOT NULL").dropDuplicates(["doc_id"])):
        rows = [(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()]
        want = brute.jaccard_components(rows)
        assert {r.doc_id: (r.n_shingles, r.class_id) for r in op13_minhash.near_duplicates(df).collect()} == want
    assert op13_minhash.near_duplicates(odd.where("1 = 0")).count() == 0


def test_near_duplicates_recall(spark):
    """Pairs at and above the threshold: bands find 99 % of them (21 bands of 6: 99.8 % at 0.8)."""
    r = random.Random(9)
    rows = []
    for i in range(300):
        base = prose(1000 + i, 120).split()
        other = list(base)
        for at in r.sample(range(5, 115, 6), 2):
            other[at] = "changed"
        rows += [(2 * i, " ".join(base)), (2 * i + 1, " ".join(other))]
    want = brute.jaccard_components(rows)
    got = {x.doc_id: x.class_id for x in op13_minhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    linked = [i for i in want if want[i][1] != i]
    assert len(linked) > 250 and sum(got[i] == want[i][1] for i in linked) >= 0.99 * len(linked)
    assert all(got[i] in (i, want[i][1]) for i in want)


def test_registered_rows(spark):
    assert queries.op11_codes_query(spark, SF).columns == ["vec_id", "code", "error", "label_error", "codebooks_sha256"]
    assert queries.op12_search_query(spark, SF).columns == ["item_id", "rank", "doc_id", "score"]
