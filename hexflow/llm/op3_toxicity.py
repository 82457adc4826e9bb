"""Toxicity: a learned lexicon, Levenshtein automata over its trie, and scores
of the windows around the hits.

Training reads only labelled documents outside the held-out fold, at most TRAIN_ROWS
of them (those with the smallest hash of doc_id), and no column but the text. A
doc_id with several labels counts as toxic if one says so; one that stands on several rows
teaches with the text of the least hash.
Spark counts, for every word and word start in toxic texts, the distinct
neighbourhoods (word before, word after) that it is seen in, and the clean
texts that have it: copies of one text add no neighbourhoods, so what is
particular to one often copied text is no term. Word starts stand for inflected
stems, whatever their length: they are counted as hashes that grow letter by letter,
and only those that become terms are spelt out. Terms that clean texts hardly use form
the lexicon. It is whole: a term takes LEAST_SEEN neighbourhoods of the sample, so its
size is bounded by the sample's, not by the corpus.

Matching: the terms form a trie; the Levenshtein automaton of a token (one edit
for terms of LONG_TERM letters or more; an extra letter before the first is
another word, not an edit) is intersected with it. The states, sets
of (trie node, edits), are made on demand and kept, so a token costs a table
look-up per letter until its state is empty. Letter-like digits and signs count
as the letters, and letters drawn out three times or more as one.

A hit's weight depends on its window of WINDOW words on either side: quotation
marks around the term and verbs of reporting mark a quotation, which weighs
less; words of address weigh more. The sums of the weights of exact, misspelt and
quoted hits, and their densities, enter a logistic regression fitted on the
same training rows.

Edge cases: NULL and empty texts score by the intercept alone (no hits); with
no toxic or no clean training rows every score is 0; rows repeat as they come;
an empty table gives an empty result; columns beyond doc_id and text are ignored.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import by_value, dropped, in_small_batches, trimmed, written

by_value(__name__)

FOLDS = 5
TRAIN_ROWS = 20_000            # bound of the labelled sample that the model is fitted on
SAMPLE_PARTS = 64
LEAST_START = 3
LEAST_SEEN = 8                 # neighbourhoods in toxic texts that make a term
MOST_CLEAN = 0.02              # clean texts with it, against those neighbourhoods
LONG_TERM = 5
WINDOW = 4
MAX_STATES = 200_000
START_BASE, START_PRIME = 1_000_003_579, 2**61 - 1      # hashes of word starts
# Signs read as letters, quotation marks, verbs of reporting, words of address.
LIKE_LETTERS = str.maketrans("013457@$!", "oieastasi")
QUOTES = "\"“”„«»‘’'"
REPORTING = frozenset("said says called calls wrote writes word term quote quoted sagte nannte schrieb wort dit appelé mot dijo llamó palabra".split())
ADDRESS = frozenset("you your you're u ur du dich dir ihr euch tu toi te vous tú ti usted ustedes".split())
FEATURES = ("any exact", "any misspelt", "exact", "misspelt", "quoted", "density")

_WORD = re.compile(r"[^\x20\x09-\x0D]+")
_EDGE = re.compile(r"^[\W_]+|[\W_]+$")
_DRAWN = re.compile(r"(.)\1{2,}")


def held_out(doc_id: Column) -> Column:
    """The fold that training never reads."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % FOLDS == 0


def bare(word: str) -> str:
    """Lower case without the signs around it."""
    return _EDGE.sub("", word.lower())


def folded(word: str) -> str:
    """``bare`` with letter-like signs and drawn-out letters undone."""
    w = _EDGE.sub("", word.lower().translate(LIKE_LETTERS)) if not word.isalpha() else word.lower()
    return _DRAWN.sub(r"\1", w)


# --- training -------------------------------------------------------------------

def starts(word: str) -> list[int]:
    """Hashes of the word's starts of LEAST_START letters or more, the last one that of
    the whole word (a start followed by a space)."""
    h, out = 0, []
    for sign in word:
        h = (h * START_BASE + ord(sign)) % START_PRIME
        out.append(h)
    return [*out[LEAST_START - 1:], (h * START_BASE + ord(" ")) % START_PRIME]


class Starts(dict):
    """``starts`` of the words met lately."""
    def __missing__(self, word: str) -> list[int]:
        if len(self) > 50_000:
            self.clear()
        out = starts(word)
        if len(word) < 80:
            self[word] = out
        return out


def lexicon(train: DataFrame) -> list[str]:
    """Terms learned from ``train`` (toxic int, text). A term that ends in a
    space is a whole word, the others are word starts."""
    def occurrences(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = Starts()
        for batch in batches:
            for toxic, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                words = [w for w in map(bare, (text or "").split()) if w]
                seen = set()
                for i, w in enumerate(words):
                    if len(w) >= LEAST_START:
                        near = hash_of(words[i - 1] if i else "") ^ (hash_of(words[i + 1] if i + 1 < len(words) else "") << 1) if toxic else 0
                        seen.add((w, near))
                rows = {(s, near) for w, near in seen for s in known[w]}
                if rows:
                    terms, near = zip(*rows, strict=True)
                    yield pa.RecordBatch.from_arrays([pa.array([toxic] * len(rows), pa.int32()), pa.array(terms, pa.int64()), pa.array(near, pa.int64())],
                                                     names=["toxic", "term", "near"])

    found = in_small_batches(train.select("toxic", "text")).mapInArrow(trimmed(occurrences), "toxic int, term long, near long")
    seen = (found.where("toxic = 1").groupBy("term", "near").agg(F.count(F.lit(1)).alias("n"))
            .groupBy("term").agg(F.count(F.lit(1)).alias("seen"))
            .where(F.col("seen") >= LEAST_SEEN))
    clean = found.where("toxic = 0").groupBy("term").agg(F.count(F.lit(1)).alias("clean"))
    terms = (seen.join(clean, "term", "left").where(F.coalesce("clean", F.lit(0)) <= F.col("seen") * MOST_CLEAN)
             .select("term", "seen").collect())         # of the sample: at most its words / LEAST_SEEN
    named = {r["term"]: r["seen"] for r in terms}

    def spelt(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, done = Starts(), set()
        for batch in batches:
            out = {}
            for text in batch.column(0).to_pylist():
                for w in {w for w in map(bare, (text or "").split()) if len(w) >= LEAST_START}:
                    for k, h in enumerate(known[w], LEAST_START):
                        if h in named and h not in done:
                            done.add(h)
                            out[h] = w[:k] if k <= len(w) else w + " "
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(list(out), pa.int64()), pa.array(list(out.values()), pa.string())], names=["term", "spelling"])
    if not named:
        return []
    spellings = (in_small_batches(train.where("toxic = 1").select("text")).mapInArrow(trimmed(spelt), "term long, spelling string")
                 .groupBy("term").agg(F.min("spelling").alias("spelling")).collect())
    return distil({r["spelling"]: named[r["term"]] for r in spellings})


def hash_of(word: str) -> int:
    """A 62-bit hash that is the same in every process."""
    import hashlib
    return int.from_bytes(hashlib.blake2b(word.encode(), digest_size=8).digest(), "big") >> 2


def distil(seen: dict[str, int]) -> list[str]:
    """One term per stem: the shortest start, lengthened while it keeps nine
    tenths of its sightings."""
    longer: dict[str, list[str]] = {}
    for term in seen:
        longer.setdefault(term[:-1], []).append(term)
    out: dict[str, int] = {}
    stems: set[str] = set()
    lengths: set[int] = set()
    for term in sorted(seen, key=lambda t: (len(t), t)):
        if any(term[:k] in stems for k in lengths if k <= len(term)):
            continue
        best = term
        while not best.endswith(" ") and best in longer:
            more = min(longer[best], key=lambda t: (-seen[t], t))
            if seen[more] < 0.9 * seen[term]:
                break
            best = more
        out[best] = seen[best]
        stems.add(best.rstrip())
        lengths.add(len(best.rstrip()))
    return sorted(out, key=lambda t: (-out[t], t))


# --- matching -------------------------------------------------------------------

class Automaton:
    """Levenshtein automata intersected with the lexicon's trie."""

    def __init__(self, terms: list[str]):
        self.child: list[dict[str, int]] = [{}]
        self.depth = [0]
        self.ends = [0]            # 1: a word start ends here, 2: a whole word
        self.longest = [0]         # letters of the longest term below
        for term in terms:
            node, word = 0, term.rstrip(" ")
            for sign in word:
                nxt = self.child[node].get(sign)
                if nxt is None:
                    nxt = len(self.child)
                    self.child[node][sign] = nxt
                    self.child.append({})
                    self.depth.append(self.depth[node] + 1)
                    self.ends.append(0)
                    self.longest.append(0)
                self.longest[node] = max(self.longest[node], len(word))
                node = nxt
            self.longest[node] = max(self.longest[node], len(word))
            self.ends[node] |= 2 if term.endswith(" ") else 1
        self.clear()

    def clear(self) -> None:
        first = self._closed({(0, 0)})
        self.state = {first: 0}
        self.sets = [first]
        self.step: list[dict[str, int]] = [{}]

    def _closed(self, pairs: set) -> frozenset:
        """With the pairs that skipping a letter of the term reaches."""
        todo, out = list(pairs), set(pairs)
        while todo:
            node, e = todo.pop()
            if e == 0:
                for nxt in self.child[node].values():
                    if self.longest[nxt] >= LONG_TERM and (nxt, 1) not in out:
                        out.add((nxt, 1))
                        todo.append((nxt, 1))
        return frozenset(p for p in out if p[1] == 0 or (p[0], 0) not in out)

    def _next(self, at: int, sign: str) -> int:
        reached = set()
        for node, e in self.sets[at]:
            same = self.child[node].get(sign)
            if same is not None:
                reached.add((same, e))
            if e == 0:
                if self.longest[node] >= LONG_TERM and node:
                    reached.add((node, 1))                              # a letter too many
                reached |= {(nxt, 1) for s, nxt in self.child[node].items() if s != sign and self.longest[nxt] >= LONG_TERM}
        closed = self._closed(reached)
        to = self.state.get(closed)
        if to is None:
            to = len(self.sets)
            self.state[closed] = to
            self.sets.append(closed)
            self.step.append({})
        self.step[at][sign] = to
        return to

    def _hit(self, at: int, whole: bool) -> int:
        """0: none, 1: misspelt, 2: exact."""
        best = 0
        for node, e in self.sets[at]:
            kind = self.ends[node]
            if kind and (e == 0 or self.depth[node] >= LONG_TERM):
                # a start counts wherever the word goes on, misspelt ones and words only at its end
                if e == 0 and (kind & 1 or (whole and kind & 2)):
                    return 2
                if e and whole:
                    best = 1
        return best

    def match(self, word: str) -> int:
        if len(self.sets) > MAX_STATES:
            self.clear()
        at, best = 0, 0
        step, sets = self.step, self.sets
        for i, sign in enumerate(word, 1):
            to = step[at].get(sign)
            at = self._next(at, sign) if to is None else to
            if not sets[at]:
                return best
            if (hit := self._hit(at, i == len(word))) > best:
                best = hit
                if best == 2:
                    return 2
        return best


class Matcher:
    """Features of a text: sums of window-weighted hits."""

    def __init__(self, terms: list[str]):
        self.automaton = Automaton(terms)
        self.known: dict[str, int] = {}

    def _match(self, word: str) -> int:
        hit = self.known.get(word)
        if hit is None:
            if len(self.known) > 150_000:
                self.known.clear()
            plain = bare(word)
            hit = self.automaton.match(plain) if plain else 0
            if hit < 2 and (other := folded(word)) != plain and other:
                hit = max(hit, min(1, self.automaton.match(other)))
            if len(word) < 80:
                self.known[word] = hit
        return hit

    def features(self, text: str | None) -> list[float]:
        words = _WORD.findall(text or "")
        exact = misspelt = quoted = 0.0
        match, known = self._match, self.known
        for i, w in enumerate(words):
            hit = known.get(w)
            if hit is None:
                hit = match(w)
            if hit:
                near = words[max(0, i - WINDOW):i + WINDOW + 1]
                marks = (w[0] in QUOTES and w.rstrip(".,;:!?")[-1:] in QUOTES) or (
                    any(x[0] in QUOTES for x in words[max(0, i - WINDOW):i]) and any(x.rstrip(".,;:!?")[-1:] in QUOTES for x in words[i + 1:i + WINDOW + 1]))
                quote = marks or any(bare(x) in REPORTING for x in words[max(0, i - WINDOW):i])
                weight = 1.5 if any(bare(x) in ADDRESS for x in near) else 1.0
                if quote:
                    quoted += weight
                elif hit == 2:
                    exact += weight
                else:
                    misspelt += weight
        return [float(exact > 0), float(misspelt > 0), math.log1p(exact), math.log1p(misspelt), math.log1p(quoted),
                min(1.0, 20.0 * (exact + 0.5 * misspelt) / max(20, len(words)))]


def fit(x: np.ndarray, y: np.ndarray, ridge: float = 0.05, rounds: int = 60) -> np.ndarray:
    """Logistic regression by Newton steps; the last weight is the intercept."""
    a = np.hstack([x, np.ones((len(x), 1))])
    w = np.zeros(a.shape[1])
    keep = ridge * np.eye(a.shape[1])
    keep[-1, -1] = 1e-6
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(a @ w, -30, 30)))
        grad = a.T @ (p - y) + keep @ w
        step = np.linalg.solve((a * (p * (1 - p))[:, None]).T @ a + keep + 1e-9 * np.eye(len(w)), grad)
        w -= np.clip(step, -5, 5)
        if np.abs(step).max() < 1e-8:
            break
    return w


def train(docs: DataFrame, labels: DataFrame, max_rows: int = TRAIN_ROWS) -> tuple[list[str], list[float] | None]:
    """(lexicon, weights) from labelled rows outside the held-out fold."""
    marks = (labels.where(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull() & ~held_out(F.col("doc_id")))
             .groupBy("doc_id").agg(F.max(F.col("toxic").cast("int")).alias("toxic")))
    # of the max_rows least hashes: what lies well above them is left out before they are ordered
    place = F.xxhash64("doc_id")
    share = (1.2 * max_rows + 1_000) / max(1, marks.count())
    if share < 1:
        marks = marks.where(place < int(-2**63 + 2**64 * share))
    marks = marks.orderBy(place, "doc_id").limit(max_rows)                                            # bounded sample
    text = F.col("text").cast("string")
    sample = (docs.select("doc_id", text.alias("text")).join(F.broadcast(marks), "doc_id")
              .groupBy("doc_id", "toxic").agg(F.min_by("text", F.xxhash64("text")).alias("text")))    # one row per label
    sample = written(sample.select("toxic", "text").repartition(SAMPLE_PARTS), "toxicity-sample")
    terms = lexicon(sample)

    def featured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        matcher = Matcher(terms)
        for batch in batches:
            toxic = batch.column(0)
            rows = [matcher.features(t.as_py()) for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays([toxic, pa.array(rows, pa.list_(pa.float64()))], names=["toxic", "x"])
    rows = in_small_batches(sample).mapInArrow(trimmed(featured), "toxic int, x array<double>").collect()          # at most max_rows short rows
    dropped(sample)
    rows.sort()                     # sums in one order: reruns agree
    y = np.array([r["toxic"] for r in rows], float)
    if not len(y) or y.min() == y.max():
        return terms, None
    return terms, [float(w) for w in fit(np.array([r["x"] for r in rows]), y)]


def score(docs: DataFrame, model: tuple[list[str], list[float] | None], *keep: str) -> DataFrame:
    """The columns ``keep`` (doc_id if none are named) and score in [0, 1]."""
    keep = keep or ("doc_id",)
    types = dict(docs.select(*keep).dtypes)
    terms, weights = model

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        matcher = Matcher(terms)
        for batch in batches:
            out = []
            for t in batch.column(len(keep)):
                z = sum(w * x for w, x in zip(weights, [*matcher.features(t.as_py()), 1.0], strict=True)) if weights else -math.inf
                out.append(0.0 if z == -math.inf else 1 / (1 + math.exp(-max(-30.0, min(30.0, z)))))
            yield pa.RecordBatch.from_arrays([*batch.columns[:len(keep)], pa.array(out, pa.float64())], names=[*keep, "score"])

    schema = ", ".join(f"`{c}` {types[c]}" for c in keep) + ", score double"
    return in_small_batches(docs.select(*keep, F.col("text").cast("string").alias("_text"))).mapInArrow(trimmed(work), schema)


def toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted for every row of ``docs``."""
    scored = score(docs, train(docs, labels))
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def without_toxic(docs: DataFrame, labels: DataFrame, at: float = 0.5) -> DataFrame:
    """``docs`` without the rows that score ``at`` or more."""
    names = [f"_c{i}" for i in range(len(docs.columns))]
    text = docs.columns.index("text")
    plain = docs.toDF(*names)
    scored = score(plain.withColumn("text", F.col(names[text])), train(docs, labels), *names)
    return scored.where(F.col("score") < at).select(*[F.col(n).alias(c) for n, c in zip(names, docs.columns, strict=True)])
