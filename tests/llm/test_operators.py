"""The operators against brute force: on sf0.001 and on hand-made rows with
nulls, blanks, long texts, ties, repeats and columns with clashing names."""

import bisect
import collections
import random
import time
import zlib

import pytest
from tests.llm import brute

from hexflow.llm import (op1_token_counts, op2_quality, op3_toxicity, op4_bpe, op5_exact_dedup, op6_sharding, op7_pii,
                         op8_jaccard_join, op9_passages, op10_mixing, queries)
from hexflow.llm.common import tokenizer

SF = "/root/testdata/sf0.001"
WORDS = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho sigma tau upsilon".split()


def prose(seed, n):
    r = random.Random(seed)
    return " ".join(r.choice(WORDS) + str(r.randint(0, 40)) for _ in range(n))


LONG = prose(1, 30_000)
ODD = [
    (1, None, "a"), (2, "", "a"), (3, " \t\n\x0b\x0c\r ", None), (4, "one", "b"), (5, "one two  three", "b"), (5, "one two  three", "b"),
    (6, "one two three", "c"), (7, LONG, "c"), (8, LONG + " tail", None), (9, "Mail a.b+c@d-e.f.gh, 1.2.3.4 and 256.1.1.1 or 1.2.3.4.5.6.7.8", "a"),
    (10, "Card 4111 1111 1111 1111 or 4111-1111-1111-1112 call +1 (017) 555-7713", "a"), (11, "é ΣΑΣ <|endoftext|> 'll ſt ﬁ 😀😀 x\u0085y", "b"),
    (12, "same line\nsame line\n\nsame line\r\n" * 30, "b"), (13, "w " * 400, "b"), (None, "one two three", "z"), (14, "a@b@c.d@e.f", "z"),
    (18, "10.0.0.1, 127.0.0.1 192.168.0.7; 0.0.0.0 000.00.0.00 00025.0255.0256.1 1.2.3.00255 0.0.0.0256 256.0.0.0", "z"),
    (15, "1" * 5000 + "." + "2.3.4", "z"), (16, "x" * 100_000, "z"), (17, "x@" + "y." * 20_000 + "z", "z"),
]
CLASH = {"words": 1, "t": 2, "h": "x", "digest": "y", "_rid": 3, "label": 4, "row": 5, "n": 6, "size": 7, "bucket": 8, "score": 9.0, "token": "q", "sig": 1,
         "rank": 2, "node": 3, "copies": 4, "s": "s", "source_size": 1, "below": 2, "ids": 3, "lang": "en"}


@pytest.fixture(scope="module")
def odd(spark):
    from pyspark.sql import functions as F
    df = spark.createDataFrame(ODD, "doc_id long, text string, source string").repartition(3)
    return df.withColumns({k: F.lit(v) for k, v in CLASH.items()})


@pytest.fixture(scope="module")
def none(odd):
    return odd.where("1 = 0")


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


@pytest.fixture(scope="module")
def rows(docs):
    return [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]


def test_token_counts(spark, odd, none, docs):
    sentencepiece = pytest.importorskip("sentencepiece")
    from sentencepiece import sentencepiece_model_pb2
    file = tokenizer("piece_bpe_32k.model")
    model = sentencepiece_model_pb2.ModelProto()
    with open(file, "rb") as f:
        model.ParseFromString(f.read())
    model.trainer_spec.model_type = 1               # unigram, with the same pieces and our scores
    scores = op1_token_counts.zipf_pieces(file)
    for p in model.pieces:
        p.score = scores.get(p.piece, 0.0)
    sp = sentencepiece.SentencePieceProcessor(model_proto=model.SerializeToString())
    for df in (docs, odd):
        texts = collections.Counter()
        for r in df.select("doc_id", "text").collect():
            w = brute.words(r.text)
            texts[r.doc_id, len(w), sum(len(sp.encode(x)) for x in w)] += 1
        got = collections.Counter(tuple(r) for r in op1_token_counts.token_counts(df, file).collect())
        assert got == texts
    assert op1_token_counts.token_counts(none, file).count() == 0


def test_trie_forgets_without_changing_counts():
    pieces = op1_token_counts.zipf_pieces(tokenizer("piece_bpe_32k.model"))
    small = op1_token_counts.Counts(op1_token_counts.Trie(pieces), max_nodes=50)
    large = op1_token_counts.Counts(op1_token_counts.Trie(pieces))
    assert [small[w.encode()] for w in LONG.split()[:500]] == [large[w.encode()] for w in LONG.split()[:500]]


def test_quality(odd, none, docs):
    for df in (docs, odd):
        want = collections.Counter((r.doc_id, *brute.base_quality(r.text)) for r in df.select("doc_id", "text").collect())
        out = op2_quality.quality(df)
        got = collections.Counter(tuple(r) for r in out.select(
            "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed").collect())
        assert got == want
        assert out.where("kept and base_failed").count() == 0
    assert op2_quality.quality(none).count() == 0


def test_quality_rules_are_a_table(spark):
    texts = [(1, prose(2, 60)), (2, " | ".join(prose(3, 40).split())), (3, prose(4, 60).upper())]
    df = spark.createDataFrame(texts, "doc_id long, text string")
    rules = (("symbols_per_word", None, 0.2, 0), ("capital_share", None, 0.5, 20))
    got = {r.doc_id: (r.kept, r.failed) for r in op2_quality.quality(df, rules).collect()}
    assert got == {1: (True, []), 2: (False, ["symbols_per_word"]), 3: (False, ["capital_share"])}


def test_quality_agrees_with_labels(spark):
    out = queries.op2_quality_rules(spark, "/root/testdata/sf0.01")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet").select("doc_id", "quality")
    r = {(x.quality, x.kept): x["count"] for x in out.join(labels, "doc_id").groupBy("quality", "kept").count().collect()}
    assert r.get((0, True), 0) <= 0.05 * sum(n for (q, _), n in r.items() if q == 0)
    assert r.get((1, False), 0) <= 0.08 * sum(n for (q, _), n in r.items() if q == 1)


def test_toxicity_held_out(spark):
    out = queries.op3_toxicity_query(spark, "/root/testdata/sf0.1")
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet").select("doc_id", "toxic")
    r = out.join(labels, "doc_id").collect()
    assert out.count() == 10_000
    assert all(x.held_out == (zlib.crc32(str(x.doc_id).encode()) % 5 == 0) and 0 <= x.score <= 1 and x.predicted == (x.score >= 0.5) for x in r)
    held = [x for x in r if x.held_out]
    toxic = [x.predicted for x in held if x.toxic == 1]
    clean = [x.predicted for x in held if x.toxic == 0]
    assert sum(toxic) >= 0.8 * len(toxic) and sum(clean) <= 0.01 * len(clean)


def test_toxicity_edges(spark, odd, none):
    labels = spark.createDataFrame([(i, i % 2) for i in range(1, 15)], "doc_id long, toxic int")
    assert op3_toxicity.toxicity(odd, labels).count() == len(ODD)
    assert {r.score for r in op3_toxicity.toxicity(odd, labels.where("1 = 0")).collect()} == {0.0}
    assert op3_toxicity.toxicity(none, labels).count() == 0
    kept = op3_toxicity.without_toxic(odd, labels.where("1 = 0"))
    assert kept.columns == odd.columns and kept.count() == len(ODD)

def test_toxicity_against_counting_and_comparing(spark):
    """Lexicon and hits against plain counts of every word start, and the distance of every word to every term."""
    sf = "/root/testdata/sf0.01"
    text = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()}
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    marks = {r.doc_id: r.toxic for r in labels.select("doc_id", "toxic").collect() if r.toxic is not None and zlib.crc32(str(r.doc_id).encode()) % 5}
    sample = [(marks[i], text[i]) for i in marks if i in text]
    long = "unbelievablyverylong"
    sample += [(1, f"a{i} {long}{'ab'[i % 2]} b{i}") for i in range(12)] + [(0, f"x {long[:16]} y")] * 30
    want = brute.toxic_terms(sample, op3_toxicity.bare)
    got = op3_toxicity.lexicon(spark.createDataFrame(sample, "toxic int, text string").repartition(4))
    assert got == sorted(want, key=lambda t: (-want[t], t))
    assert any(t.startswith(long[:17]) for t in got) and long[:16] not in got      # starts of any length
    matcher = op3_toxicity.Matcher(got)
    words = {op3_toxicity.bare(w) for t in text.values() for w in (t or "").split()} - {""}
    assert {w: matcher.automaton.match(w) for w in words} == {w: brute.term_hit(w, got) for w in words}


def test_toxicity_of_one_id_on_many_rows_and_of_two_labels(spark):
    """One labelled doc_id on many rows teaches once; of two labels the toxic one counts."""
    docs = spark.createDataFrame([(1, "same text here")] * 500 + [(i, prose(i, 30)) for i in range(2, 60)], "doc_id long, text string").repartition(4)
    labels = spark.createDataFrame([(i, 0) for i in range(1, 60)] + [(2, 1), (3, 1)], "doc_id long, toxic int")
    first = op3_toxicity.train(docs, labels)
    assert first == op3_toxicity.train(docs.repartition(3), labels.repartition(2))
    assert op3_toxicity.train(docs, labels, max_rows=10)[0] == []
    assert op3_toxicity.toxicity(docs, labels).count() == 558


def test_levenshtein_automaton():
    a = op3_toxicity.Automaton(["idiot ", "scum ", "low"])

    def distance(x, y):
        row = list(range(len(y) + 1))
        for i, c in enumerate(x, 1):
            row = [i, *(0 for _ in y)] if not y else _next_row(row, i, c, y)
        return row[-1]

    def _next_row(row, i, c, y):
        new = [i]
        for j, d in enumerate(y, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (c != d)))
        return new
    r = random.Random(5)
    for _ in range(3000):
        w = list("idiot")
        for _ in range(r.randint(0, 3)):
            k = r.randrange(len(w) + 1)
            w[k:k + r.randint(0, 1)] = r.choice(["", "i", "d", "x", "o"])
        w = "".join(w)
        d = distance(w, "idiot")
        if w:
            before = w[1:] == "idiot" and w[0] != "i"         # an extra letter in front is another word
            assert a.match(w) == (2 if d == 0 else 1 if d == 1 and not before else 0), w
    assert [a.match(w) for w in ("scum", "scun", "scums", "lowly", "low", "lo")] == [2, 0, 0, 2, 2, 0]


def test_quoted_hits_weigh_apart():
    m = op3_toxicity.Matcher(["idiot "])
    name = dict(zip(op3_toxicity.FEATURES, m.features("he said \"idiot\" to them"), strict=True))
    assert name["quoted"] > 0 and name["exact"] == 0
    name = dict(zip(op3_toxicity.FEATURES, m.features("you are an id1ot and an idi0t"), strict=True))
    assert name["misspelt"] > 0 and name["quoted"] == 0


def test_bpe(odd, none, docs):
    tokenizers = pytest.importorskip("tokenizers")
    file = tokenizer("word_bpe_49k.json")
    tok = tokenizers.Tokenizer.from_file(file)
    for df in (docs, odd):
        want = collections.Counter()
        for r in df.select("doc_id", "text").collect():
            ids = tok.encode(r.text or "", add_special_tokens=False).ids
            want[r.doc_id, len(ids), brute.sha(" ".join(map(str, ids))), brute.sha(tok.decode(ids, skip_special_tokens=False))] += 1
        out = op4_bpe.encode(df, file)
        got = collections.Counter(tuple(r) for r in out.select("doc_id", *op4_bpe.digests(out["ids"], out["decoded"])).collect())
        assert got == want
    assert op4_bpe.encode(none, file).count() == 0


def test_bpe_random_and_round_trip():
    tokenizers = pytest.importorskip("tokenizers")
    file = tokenizer("word_bpe_49k.json")
    tok = tokenizers.Tokenizer.from_file(file)
    with open(file, "rb") as f:
        vocab = op4_bpe.Vocabulary(f.read())
    r = random.Random(7)
    texts = ["".join(r.choice("aaabcdeéßΣσ12 '\n\t.,!<|>") for _ in range(r.randint(0, 120))) for _ in range(2000)]
    texts += ["a" * n for n in range(40)] + ["<|startoftext|>Hi<|endoftext|>", "mississippi banana " * 3]
    enc = op4_bpe.Encoder(vocab)
    ids, size, decoded = enc.run(texts)
    lo = 0
    for t, n, d in zip(texts, size.tolist(), decoded, strict=True):
        mine = ids[lo:lo + n].tolist()
        lo += n
        assert mine == tok.encode(t, add_special_tokens=False).ids and d == vocab.decode(mine)
        assert vocab.words_of(mine).replace(" ", "") == "".join(x for x in vocab.pieces(t) if isinstance(x, str))


def test_bpe_of_long_words_and_of_all_signs():
    tokenizers = pytest.importorskip("tokenizers")
    file = tokenizer("word_bpe_49k.json")
    tok = tokenizers.Tokenizer.from_file(file)
    with open(file, "rb") as f:
        vocab = op4_bpe.Vocabulary(f.read(), op4_bpe.library_signs(file))
    r = random.Random(8)
    texts = ["x" * n for n in (127, 128, 129, 1000)] + ["".join(r.choice("abé") for _ in range(n)) for n in (100, 500, 3000)]
    texts += ["short " + "ab" * 300 + " words " + "é" * 200 + " <|endoftext|> " + "c" * 129, "9" * 300]
    step = 3000
    for lo in range(0, 0x110000, step):
        texts.append(" ".join(f"a{chr(c)}a!{chr(c)}!" for c in range(lo, min(lo + step, 0x110000)) if not 0xD800 <= c < 0xE000))
    ids, size, _ = op4_bpe.Encoder(vocab).run(texts)
    lo = 0
    for t, n in zip(texts, size.tolist(), strict=True):
        assert ids[lo:lo + n].tolist() == tok.encode(t, add_special_tokens=False).ids
        lo += n
    for word in ("x" * 100_000, "ab" * 50_000):
        began = time.process_time()
        assert vocab.encode_words([word])[0].tolist() == tok.encode(word, add_special_tokens=False).ids
        assert time.process_time() - began < 3


def test_exact_dedup(odd, none, docs):
    for df in (docs, odd):
        want = collections.Counter(brute.exact_groups([(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()]))
        out = op5_exact_dedup.dedup(df).collect()
        assert collections.Counter((r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in out) == want
        kept = collections.Counter(r.text_sha256 for r in out if r.kept)
        assert set(kept.values()) == {1} and set(kept) == {w[3] for w in want}
        assert all(r.doc_id == r.keep_id for r in out if r.kept)
        left = op5_exact_dedup.without_copies(df)
        assert left.columns == df.columns and left.count() == len(kept)
    assert op5_exact_dedup.dedup(none).count() == 0
    row = next(r for r in op5_exact_dedup.without_copies(odd).collect() if r.doc_id == 7)
    assert row["_rid"] == 3 and row["digest"] == "y"


def test_exact_dedup_keeps_rows_of_an_unknown_side(spark):
    from pyspark.sql import functions as F
    data = [(1, "x"), (2, "x"), (None, "y"), (None, "x"), (3, "z")]
    out = op5_exact_dedup.dedup(spark.createDataFrame(data, "doc_id long, text string"), in_batch=F.col("doc_id") >= 2).collect()
    assert collections.Counter((r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in out) == collections.Counter(brute.exact_groups(data))


@pytest.mark.parametrize("old", [0, 1])
def test_exact_dedup_of_a_first_load_has_buckets(spark, monkeypatch, old):
    """With an empty or tiny snapshot, the batch's size deals out the buckets."""
    from pyspark.sql import functions as F
    buckets, screen = [], op5_exact_dedup.screen
    monkeypatch.setattr(op5_exact_dedup, "KEYS_PER_BUCKET", 10)
    monkeypatch.setattr(op5_exact_dedup, "screen", lambda batch, fuses, n: buckets.append(n) or screen(batch, fuses, n))
    data = [(i, f"text {i % 90}") for i in range(180)]
    out = op5_exact_dedup.dedup(spark.createDataFrame(data, "doc_id long, text string"), in_batch=F.col("doc_id") >= old).collect()
    assert collections.Counter((r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in out) == collections.Counter(brute.exact_groups(data))
    assert buckets == [9]


@pytest.mark.parametrize("n", [1, 2, 3, 10, 1000, 50_000])
def test_fuse_filter(n):
    import numpy as np
    r = np.random.default_rng(n)
    keys = np.unique(r.integers(0, 2**63, n, dtype=np.uint64))
    f = op5_exact_dedup.build_filter(keys)
    assert op5_exact_dedup.may_contain(keys, *f).all()
    other = r.integers(2**63, 2**64 - 1, 20_000, dtype=np.uint64)
    assert op5_exact_dedup.may_contain(other, *f).mean() < 0.01


@pytest.mark.parametrize("shards", [1, 3, 8])
def test_sharding(odd, none, docs, shards):
    for df in (docs, odd):
        out = op6_sharding.shard(df, shards).collect()
        want = collections.Counter((r.doc_id, len((r.text or "").encode()) + 1, zlib.crc32((r.text or "").encode())) for r in df.select("doc_id", "text").collect())
        assert collections.Counter((r.doc_id, r["size"], r.text_crc32) for r in out) == want
        slots = collections.defaultdict(list)
        for r in out:
            slots[r.shard].append(r.slot)
        counts = [len(slots[s]) for s in range(shards)]
        assert max(counts) - min(counts) <= 1
        assert all(sorted(v) == list(range(len(v))) for v in slots.values())
    assert op6_sharding.shard(none, shards).count() == 0


def test_ring_moves_little(docs):
    a = {r.doc_id: r.shard for r in op6_sharding.shard(docs, 8).collect()}
    assert a == {r.doc_id: r.shard for r in op6_sharding.shard(docs, 8, rows_per_bucket=7).collect()}
    b = {r.doc_id: r.shard for r in op6_sharding.shard(docs, 9).collect()}
    assert sum(a[i] != b[i] for i in a) < 0.2 * len(a)


def test_personal_data_base_spans(odd, none, docs):
    for df in (docs, odd):
        want = collections.Counter()
        for r in df.select("doc_id", "text").collect():
            s = brute.base_spans(r.text)
            want[r.doc_id, *(s.count(k + ":") for k in ("email", "ip", "card", "phone")), brute.sha(s)] += 1
        out = op7_pii.digest(op7_pii.personal_data(df)).collect()
        assert collections.Counter((r.doc_id, r.n_email, r.n_ip, r.n_card, r.n_phone, r.base_sha256) for r in out) == want
    assert op7_pii.personal_data(none).count() == 0


def test_personal_data_finds_unseen_identifiers(spark):
    good = ["4111111111111111", "5500005555555559", "4012888888881881", "4222222222222220", "5105105105105100", "4917610000000000", "6011111111111117"]
    rows = [(i, f"please charge card number {c} today {prose(i, 20)}") for i, c in enumerate(good)]
    rows += [(100, f"please charge card number 4111111111111112 today {prose(100, 20)}"), (101, "order 12345678 left " + prose(101, 20))]
    out = {r.doc_id: r.spans for r in op7_pii.digest(op7_pii.personal_data(spark.createDataFrame(rows, "doc_id long, text string"))).collect()}
    assert out[100] == "id:26:42" and out[101] == ""
    assert all(out[i] == "card:26:42" for i in range(len(good)))


def test_personal_data_added_spans(spark, docs):
    """All added spans against brute force, chains of discoveries included."""
    r, rows = random.Random(5), [(x.doc_id, x.text) for x in docs.select("doc_id", "text").collect() if x.text and len(x.text) < 3000]
    # mail addresses teach "mail", codes seen with it teach "badge", codes seen with that "desk"
    rows += [(10_000 + i, f"his mail u{i}@x.org and " + prose(i, 5)) for i in range(120)]
    codes = [[f"{chr(97 + k) * 2}{r.randint(10_000, 99_999)}" for _ in range(n)] for k, n in enumerate((36, 12, 4))]
    for k, (a, b) in enumerate((("mail", "badge"), ("badge", "desk"), ("desk", "shelf"))):
        for i, code in enumerate(codes[k]):
            rows += [(20_000 + 100 * k + i, f"his {a} {code} there"), (30_000 + 100 * k + i, f"his {b} {code} here")]
    want = brute.found_identifiers(rows)
    out = op7_pii.personal_data(spark.createDataFrame(rows, "doc_id long, text string")).select("doc_id", "found").collect()
    got = {x.doc_id: sorted((s.start, s.end) for s in x.found) for x in out}
    assert got == {i: w for (i, _), w in zip(rows, want, strict=True)}
    assert all(got[30_000 + 100 * k] for k in range(3))


def test_personal_data_of_one_text_full_of_identifiers(spark):
    def took(n):
        text = " ".join(f"user{i}@host{i % 7}.org code{i:07d}" for i in range(n))
        began = time.time()
        out = op7_pii.personal_data(spark.createDataFrame([(1, text)], "doc_id long, text string")).selectExpr("size(seeds) AS n").first()
        assert out.n == n
        return time.time() - began
    took(100)
    assert took(16_000) < 15


def planted(seed=3):
    """Groups of near copies, chains, passages shared by many, and odd rows."""
    r = random.Random(seed)
    out = []
    shared = prose(900, 40)
    for g in range(12):
        base = prose(1000 + g, r.choice([6, 30, 120, 300])).split()
        for _ in range(r.randint(1, 9)):
            w = list(base)
            for _ in range(r.randint(0, max(1, len(w) // 40))):
                w[r.randrange(len(w))] = "edit" + str(r.randint(0, 9))
            out.append(" ".join(w))
            base = w if g % 3 == 0 else base          # chains drift away from their first text
    out += [shared + " " + prose(2000 + i, 160) for i in range(60)]
    out += ["Short one", "short ONE", "a b c d e", None, "", "  "]
    r.shuffle(out)
    return list(enumerate(out))


def test_jaccard_join(spark, docs, rows, none, monkeypatch):
    for data, heavy in ((rows, 4), (planted(), 4), (planted(4), 10**9)):
        monkeypatch.setattr(op8_jaccard_join, "LEAST_LOCAL", min(heavy, 4))
        monkeypatch.setattr(op8_jaccard_join, "LEAST_HEAVY", heavy)
        df = spark.createDataFrame(data, "doc_id long, text string").repartition(3)
        want = brute.jaccard_components(data)
        got = {r.doc_id: (r.n_shingles, r.component_id) for r in op8_jaccard_join.join(df).collect()}
        assert got == want
    left = op8_jaccard_join.one_of_each(df)
    assert sorted(r.doc_id for r in left.collect()) == sorted(i for i, (_, c) in want.items() if i == c)
    assert op8_jaccard_join.join(none).count() == 0


def test_jaccard_join_has_no_task_per_token(docs, monkeypatch):
    """No step sorts a token's bucket in one task: no window, no dealing by token alone before an aggregate."""
    plans, write = [], op8_jaccard_join.written
    def seen(df, name):
        plans.append(df._jdf.queryExecution().toString())
        return write(df, name)
    monkeypatch.setattr(op8_jaccard_join, "written", seen)
    op8_jaccard_join.join(docs)
    assert plans and not any("Window" in p or "RepartitionByExpression" in p for p in plans)


def test_one_of_each_keeps_other_texts_of_an_id(spark):
    """Only the near copy of a doc_id goes, its clean text stays; also beside NULL ids."""
    base = prose(800, 100)
    rows = [(1, base), (2, base + " tail"), (2, prose(801, 100)), (2, prose(801, 100)), (3, prose(802, 50)), (None, base), (2, None)]
    left = op8_jaccard_join.one_of_each(spark.createDataFrame(rows, "doc_id long, text string").repartition(2)).collect()
    assert collections.Counter(map(tuple, left)) == collections.Counter(r for r in rows if r != (2, base + " tail"))


def test_jaccard_join_odd_rows(odd):
    out = op8_jaccard_join.join(odd).collect()
    assert len(out) == len(ODD)
    by = collections.defaultdict(set)
    for r in out:
        by[r.doc_id].add((r.n_shingles, r.component_id))
    assert by[1] == {(0, 1)} and by[5] == {(1, 5)} and by[6] == {(1, 5)} and by[None] == {(1, 5)} and by[8] == {(by[8].copy().pop()[0], 7)}


def test_passages(spark, odd, none):
    passage = prose(50, 70).split()
    fuzzy = list(passage)
    fuzzy[30:31] = ["other", "words"]
    fuzzy[50] = "else"
    rows = [(1, prose(51, 100) + " " + " ".join(passage) + " " + prose(52, 30)), (2, " ".join(fuzzy) + " " + prose(53, 200)),
            (3, prose(54, 300)), (4, prose(55, 80) + " " + " ".join(passage[:35])), (5, prose(56, 40) + " " + " ".join(passage)),
            (6, prose(54, 300)), (7, None)]
    rows += [(100 + i, prose(300 + i, 20) + " " + " ".join(passage) + " " + prose(400 + i, 20)) for i in range(40)]
    out = op9_passages.passages(spark.createDataFrame(rows, "doc_id long, text string").repartition(4)).collect()
    text = {i: (t or "").split() for i, t in rows}
    assert {r.doc_id for r in out} | {r.other_id for r in out} == {1, 2, 3, 5, 6} | {100 + i for i in range(40)}
    assert [(r.doc_id, r.other_id, r.end) for r in out if r.kind == "copy"] == [(6, 3, 300)]
    for r in out:
        if r.kind == "passage" and 2 in (r.doc_id, r.other_id):
            assert r.end - r.start >= 60
        if r.kind == "passage":
            a, b = text[r.doc_id][r.start:r.end], text[r.other_id][r.other_start:r.other_end]
            assert min(len(a), len(b)) >= 50 and r.n_equal >= 0.8 * max(len(a), len(b))
    assert sum(r.kind == "passage" for r in out) <= 3 * len(rows)               # not all pairs
    assert op9_passages.passages(none).count() == 0
    members = {(r.doc_id, r.other_id) for r in op9_passages.passages(odd).collect()}
    assert (8, 7) in members or (7, 8) in members


def test_passages_of_a_repeated_line_have_their_whole_length(spark):
    """A line of up to 14 words over and over: the passage is the whole shared run,
    also where the run is longer in one text or other text goes before it."""
    cases = [(1, 300, 300), (3, 500, 200), (12, 60, 60), (14, 50, 40)]
    rows, want = [], {}
    for k, (n, a, b) in enumerate(cases):
        line = " ".join(f"case{k}w{i}" for i in range(n))
        rows += [(2 * k, " ".join([prose(700 + k, 90), *[line] * a, prose(720 + k, 30)])), (2 * k + 1, " ".join([prose(740 + k, 20), *[line] * b, prose(760 + k, 200)]))]
        want[k] = n * min(a, b)
    out = op9_passages.passages(spark.createDataFrame(rows, "doc_id long, text string").repartition(3)).collect()
    for k, n in want.items():
        found = [r for r in out if {r.doc_id, r.other_id} == {2 * k, 2 * k + 1}]
        assert max((r.end - r.start for r in found), default=0) >= n, (k, found)
        assert all(r.n_equal >= 0.8 * max(r.end - r.start, r.other_end - r.other_start) for r in found)


def test_chains_against_all_orders():
    """The best chain's score equals that of a quadratic program: a match goes on
    from the earlier one whose score less the gap is highest, or begins anew."""
    import numpy as np
    r = random.Random(11)
    K, GAP = op9_passages.K, op9_passages.GAP
    words = lambda a, b: min(K, b[0] - a[0], b[1] - a[1])
    gap = lambda a, b: GAP * (b[0] + b[1] - a[0] - a[1])
    for _ in range(200):
        n = r.randint(1, 25)
        pts = sorted({(r.randint(0, 60), r.randint(0, 60)) for _ in range(n)})
        xp, yp = np.array([p[0] for p in pts]), np.array([p[1] for p in pts])
        got = op9_passages.chains(xp, yp)
        assert sorted(i for c in got for i in c) == list(range(len(pts)))
        assert all(xp[a] < xp[b] and yp[a] < yp[b] for c in got for a, b in zip(c, c[1:], strict=False))
        score = []
        for p in pts:
            far, j = max(((score[j] + GAP * sum(q), j) for j, q in enumerate(pts[:len(score)]) if q[0] < p[0] and q[1] < p[1]), default=(-1e9, 0))
            gain = far - GAP * sum(p)
            score.append(gain + words(pts[j], p) if gain > 0 else K)
        first = [pts[i] for i in got[0]]
        assert abs(K + sum(words(a, b) - gap(a, b) for a, b in zip(first, first[1:], strict=False)) - max(score)) < 1e-6


@pytest.mark.parametrize("first,between", [(55, (10, 10)), (55, (30, 30)), (55, (60, 60)), (55, (100, 100)), (55, (200, 200)), (55, (400, 400)), (55, (100, 0)), (20, (20, 20)), (20, (40, 40))])
def test_passages_of_one_chain_stand_alone(first, between):
    """Two passages, or a stray line and a passage, with other text between."""
    import numpy as np
    r = np.random.default_rng(first + between[0])
    for turn in range(20):
        other = lambda n: r.integers(0, 2**62, n, dtype=np.uint64)
        a, b = other(first), other(55)
        x, y = (np.concatenate([other(70), a, other(n), b, other(70)]) for n in between)
        line_after = first == 20 and turn % 2
        if line_after:
            x, y = x[::-1].copy(), y[::-1].copy()
        (ax, sx), (ay, sy) = op9_passages.seeds_of(x), op9_passages.seeds_of(y)
        met = [(int(i), int(j)) for i, s in zip(ax, sx, strict=True) for j, t in zip(ay, sy, strict=True) if s == t]
        xp, yp = (np.array(v) for v in zip(*met, strict=True))
        got = [p for c in op9_passages.chains(xp, yp) for p in op9_passages.align(x, y, xp[c], yp[c])]
        covered = {k for p in got for k in range(p[0], p[1])}
        second = 70 if line_after else 70 + first + between[0]
        for a0, n in ((70, first), (second, 55)) if first >= 50 else ((second, 55),):
            assert covered >= set(range(a0, a0 + n))
        for p in got:
            assert min(p[1] - p[0], p[3] - p[2]) >= 50 and p[4] >= 0.8 * max(p[1] - p[0], p[3] - p[2])


@pytest.mark.parametrize("n,every,least", [(60, 5, 80), (60, 6, 90), (100, 6, 90), (60, 8, 95), (60, 10, 95), (60, 20, 100)])
def test_passages_with_many_edits_share_seeds(n, every, least):
    """Passages of 80 to 95 % equal words, one word edited in every few."""
    import numpy as np
    r, found = np.random.default_rng(every), 0
    other = lambda n: r.integers(0, 2**62, n, dtype=np.uint64)
    for _ in range(100):
        a = other(n)
        b = a.copy()
        b[every - 1::every] = other(len(b[every - 1::every]))
        x, y = np.concatenate([other(70), a, other(70)]), np.concatenate([other(40), b, other(90)])
        (ax, sx), (ay, sy) = op9_passages.seeds_of(x), op9_passages.seeds_of(y)
        met = [(int(i), int(j)) for i, s in zip(ax, sx, strict=True) for j, t in zip(ay, sy, strict=True) if s == t]
        if met:
            xp, yp = (np.array(v) for v in zip(*met, strict=True))
            got = [p for c in op9_passages.chains(xp, yp) for p in op9_passages.align(x, y, xp[c], yp[c])]
            found += any(min(p[1], 70 + n) - max(p[0], 70) >= 0.8 * n for p in got)
    assert found >= least


def test_gap_equal_is_the_longest_common_subsequence():
    import numpy as np
    r = random.Random(12)
    for _ in range(300):
        a, b = ([r.randint(0, 4) for _ in range(r.randint(0, 12))] for _ in range(2))
        row = [0] * (len(b) + 1)
        for v in a:
            new = [0]
            for j, w in enumerate(b):
                new.append(row[j] + 1 if v == w else max(new[-1], row[j + 1]))
            row = new
        assert op9_passages._gap_equal(np.array(a, np.int64), np.array(b, np.int64)) == row[-1]


@pytest.mark.parametrize("sizes", [{"a": 10, "b": 10, "c": 10}, {"a": 1, "b": 100, None: 50}, {"a": 0, "b": 0}, {"x": 7}])
def test_mixing_targets(spark, sizes):
    df = spark.createDataFrame([(s, n) for s, n in sizes.items()], "source string, source_size long")
    got = {r.source: r.target for r in op10_mixing.targets(df).collect()}
    assert got == pytest.approx(brute.targets(sizes))


def test_mixing(odd, none, docs):
    for df in (docs, odd):
        out = op10_mixing.mix(df).collect()
        have = df.select("doc_id", "text", "source").collect()
        sizes = collections.Counter({s: 0 for s in {r.source for r in have}})
        for r in have:
            sizes[r.source] += len(brute.words(r.text))
        want = brute.targets(sizes)
        assert collections.Counter((r.doc_id, r["size"]) for r in out) == collections.Counter((r.doc_id, len(brute.words(r.text))) for r in have)
        taken, largest = collections.Counter(), collections.Counter()
        for r in out:
            assert r.source_size == sizes[r.source] and r.target == pytest.approx(want[r.source]) and 0 <= r.taken <= 2 * r["size"]
            taken[r.source] += r.taken
            largest[r.source] = max(largest[r.source], r["size"])
        # repeats of a row stand or fall together
        assert all(abs(taken[s] - want[s]) <= 2 * largest[s] for s in sizes)
        rows = op10_mixing.taken_rows(df)
        assert rows.columns == df.columns
        assert sum(len(brute.words(r.text)) for r in rows.collect()) == sum(taken.values())
        assert sorted(map(str, op10_mixing.mix(df).collect())) == sorted(map(str, out))
    assert op10_mixing.mix(none).count() == 0


def test_pipeline(spark, tmp_path):
    import corpus_pipeline as P
    assert [n.split()[0] for n, _ in P.STAGES] == ["toxicity", "exact", "n-gram", "mixing", "BPE"]
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    texts = []
    for k, (_, stage) in enumerate(P.STAGES[:-1]):
        out = stage(spark, docs, SF)
        assert out.columns == docs.columns
        out.write.parquet(str(tmp_path / str(k)))
        before, docs = docs, spark.read.parquet(str(tmp_path / str(k)))
        texts.append((collections.Counter((r.doc_id, r.text) for r in before.collect()), collections.Counter((r.doc_id, r.text) for r in docs.collect())))
    scores = {r.doc_id: r.score for r in op3_toxicity.toxicity(spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet")).collect()}
    assert {i for i, _ in texts[0][1]} == {i for i, _ in texts[0][0] if scores[i] < 0.5}
    assert {i for i, _ in texts[1][1]} == {k for _, k, _, _ in brute.exact_groups(list(texts[1][0]))}
    assert {i for i, _ in texts[2][1]} == {i for i, (_, c) in brute.jaccard_components(list(texts[2][0])).items() if i == c}
    assert all(n <= 2 and key in texts[3][0] for key, n in texts[3][1].items())
    last = P.run(spark, SF).collect()
    assert collections.Counter(r.doc_id for r in last) == collections.Counter({i: n for (i, _), n in texts[3][1].items()})


def test_sharding_of_one_id_on_many_rows(spark):
    """A third of the rows have no doc_id, another third are equal: cells stay small, and the laws hold."""
    from pyspark.sql import functions as F
    n = 6_000
    df = spark.range(n).select(F.when(F.col("id") % 3 == 0, F.lit(None)).when(F.col("id") % 3 == 1, F.lit(7)).otherwise(F.col("id")).alias("doc_id"),
                               F.when(F.col("id") % 3 == 1, F.lit("same")).otherwise(F.concat(F.lit("text "), "id")).alias("text"))
    out = op6_sharding.shard(df, 8, rows_per_bucket=100)
    slots = collections.defaultdict(list)
    for r in out.collect():
        slots[r.shard].append(r.slot)
    assert [len(slots[s]) for s in range(8)] == [n // 8] * 8
    assert all(sorted(v) == list(range(len(v))) for v in slots.values())
    plain = op6_sharding.shard(df.where("id % 3 = 2"), 8, rows_per_bucket=100)
    assert {r.doc_id: (r.shard, r.slot) for r in plain.collect()} == {r.doc_id: (r.shard, r.slot) for r in op6_sharding.shard(df.where("id % 3 = 2"), 8).collect()}


def test_sharding_against_the_walk(docs):
    """The clockwise walk, key by key: a row fills the first shard from its arc on that has room."""
    shards = 8
    points = op6_sharding.ring(docs.sparkSession, shards)
    from pyspark.sql import functions as F
    place = F.shiftrightunsigned(F.xxhash64(F.lit(op6_sharding.PLACE_SEED), F.col("doc_id")), 64 - op6_sharding.RING_BITS)
    rows = sorted((r.place, r.doc_id) for r in docs.select(place.alias("place"), "doc_id").collect())
    at = [p for p, _ in points]
    arcs = collections.defaultdict(list)
    for p, i in rows:
        arcs[bisect.bisect_left(at, p) % len(at)].append(((p <= at[0]) if bisect.bisect_left(at, p) % len(at) == 0 else False, p, i))
    room = [len(rows) // shards + (s < len(rows) % shards) for s in range(shards)]
    want = {}
    for arc in range(len(points)):
        for _, _, i in sorted(arcs[arc]):
            k = arc
            while not room[points[k % len(points)][1]]:
                k += 1
            s = points[k % len(points)][1]
            room[s] -= 1
            want[i] = s
    assert {r.doc_id: r.shard for r in op6_sharding.shard(docs, shards).collect()} == want


@pytest.mark.parametrize("name", ["op2_quality_rules", "op8_jaccard_join"])
def test_twins(spark, name):
    """The queries against their SQL, all columns."""
    from tests import oracle_check
    out = oracle_check.compare(spark, oracle_check.duck(SF), name, queries.QUERIES[name], queries.ORACLE[name], SF)
    assert out.endswith("OK"), out
