"""BPE encoding and decoding with a pair occurrence index.

Within a Spark task, the distinct pre-tokens that a run of rows brings are laid
out as one chain of symbols. An index maps every mergeable pair, named by its
rank, to all its positions; a heap holds the active ranks. The lowest rank is
taken, its positions are merged together, the leftmost of each word, and only
the lists of the two neighbouring pairs are updated; a word's further positions
stay in the list, since a merge may give rise to a lower rank, which then comes
first. So every word sees its merges in the order of one merge at a time.
Pre-tokens of more than LONG bytes have an index of their own, a heap of
(rank, place), so that a letter repeated n times costs O(n log n). Encodings are
kept per task in a table of bounded size.

The vocabulary file is read once on the driver (its path is a parameter; about
2 MB whatever the data) and sent to the tasks as a broadcast variable.

Pre-tokens follow the file: special tokens are cut out of the raw text; the
rest is put in NFC and lower case, and split by the file's pattern, in which
each single number sign, run of letters or run of other signs is a pre-token.
Python's Unicode tables are of another version than the tokenizers library's: the
few signs that differ in kind or lower case are found on the driver, by asking
the library about every code point, and sent along.
Decoding joins the vocabulary's strings with spaces, which is what a tokenizer
file without decoder asks for; ``words_of`` undoes the encoding up to the
normalisation.

Edge cases: NULL and empty texts have no tokens; rows repeat as they come; an
empty table gives an empty result; columns beyond doc_id and text are ignored.
"""

from __future__ import annotations

import functools
import heapq
import json
import re
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import by_value, in_small_batches, trimmed

by_value(__name__)

MAX_KEPT = 120_000             # pre-tokens kept per task
KEPT_BYTES = 64                # and signs of them, on average
RUN_BYTES = 1_000_000          # text gathered before its new pre-tokens are encoded: their index is most of a worker's memory
LONG = 128                     # bytes of a pre-token that is encoded by itself
OUT_ROWS = 250


def byte_signs() -> dict[int, str]:
    """The visible sign of each byte: printable Latin-1 signs stand for
    themselves, the others follow from 256 on in order."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    return {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(b for b in range(256) if b not in plain)}


@functools.cache
def library_signs(vocabulary: str) -> tuple[dict[int, str], list[int], list[int], list[int]]:
    """Where the tokenizers library's tables differ from Python's, over all code
    points: (lower-case forms, letters, numbers, other signs). Nothing where the
    library is not installed."""
    try:
        from tokenizers import Tokenizer
    except ModuleNotFoundError:
        return {}, [], [], []
    library = Tokenizer.from_file(vocabulary)
    lower, kinds = {}, {"letter": [], "number": [], "sign": []}

    def like(mate: str, signs: str) -> set[int]:
        """Places of the signs that make one piece with ``mate``."""
        pieces = library.pre_tokenizer.pre_tokenize_str("".join(mate + s for s in signs) + mate)
        return {i // 2 for _, (a, b) in pieces if b - a > 1 for i in range(a | 1, b, 2)}

    for lo in range(0x80, 0x110000, 8192):
        signs = regex.sub(r"\p{White_Space}", "", "".join(chr(c) for c in range(lo, min(lo + 8192, 0x110000)) if not 0xD800 <= c < 0xE000))
        if not signs:
            continue
        apart = "!".join(signs)
        theirs, ours = library.normalizer.normalize_str(apart), unicodedata.normalize("NFC", apart).replace("Σ", "σ").lower()
        if theirs != ours:
            lower |= {ord(s): x for s, x, y in zip(signs, theirs.split("!"), ours.split("!"), strict=True) if x != y}
        other = like("!", signs)
        rest = [i for i in range(len(signs)) if i not in other]
        letters = {rest[k] for k in like("a", "".join(signs[i] for i in rest))}
        numbers = set(rest) - letters
        for kind, found, pattern in (("letter", letters, r"\p{L}"), ("number", numbers, r"\p{N}"), ("sign", other, r"[^\p{L}\p{N}]")):
            kinds[kind] += [ord(signs[i]) for i in found - {m.start() for m in regex.finditer(pattern, signs)}]
    return lower, kinds["letter"], kinds["number"], kinds["sign"]


def _class(codes) -> str:
    """Code points as ranges of a character class."""
    codes = sorted(codes)
    starts = [c for i, c in enumerate(codes) if not i or codes[i - 1] != c - 1]
    ends = [c for i, c in enumerate(codes) if i + 1 == len(codes) or codes[i + 1] != c + 1]
    return "".join(f"\\U{a:08X}-\\U{b:08X}" for a, b in zip(starts, ends, strict=True))


class Vocabulary:
    """Tables of a tokenizer file, as far as encoding and decoding need them.
    ``apart``: see ``library_signs``."""

    def __init__(self, data: bytes, apart: tuple[dict[int, str], list[int], list[int], list[int]] = ({}, [], [], [])):
        spec = json.loads(data)
        model = spec["model"]
        ids = model["vocab"]
        self.end = model["end_of_word_suffix"] or ""
        pairs = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
        self.merges = [(ids[a], ids[b], ids[a + b]) for a, b in pairs]      # by rank
        self.width = max(ids.values()) + 1
        keys = np.array([x * self.width + y for x, y, _ in self.merges], np.int64)
        self.pair_ranks = np.argsort(keys)
        self.pair_keys = keys[self.pair_ranks]
        signs = byte_signs()
        self.first = np.array([ids[signs[b]] for b in range(256)])
        self.last = np.array([ids[signs[b] + self.end] for b in range(256)])
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.token = {i: t for t, i in ids.items()} | {i: t for t, i in self.special.items()}
        self.special_split = regex.compile("(" + "|".join(regex.escape(s) for s in self.special) + ")") if self.special else None
        split = next(p for p in spec["pre_tokenizer"]["pretokenizers"] if p["type"] == "Split")
        pattern = split["pattern"]["Regex"].replace(r"\s", r"\p{White_Space}")
        self.split = regex.compile(pattern)
        self.lower, letters, numbers, others = apart
        special = {*self.lower, *letters, *numbers, *others}
        self.beyond = re.compile(f"[\\U{min(special):08X}-\\U0010FFFF]") if special else None         # a cheap first test
        self.differing = re.compile(f"[{_class(special)}]") if special else None
        if special:
            # the same pattern, the three kinds as the library has them
            without = f"--[{_class([*letters, *numbers, *others])}]" if letters or numbers or others else ""
            kind = {k: f"[[{base}{without}]{_class(codes)}]" for k, base, codes in (("L", r"\p{L}", letters), ("N", r"\p{N}", numbers))}
            pattern = pattern.replace(r"[^\p{White_Space}\p{L}\p{N}]", "[^\\p{White_Space}" + kind["L"] + kind["N"] + "]")
            pattern = pattern.replace(r"[\p{L}]", kind["L"]).replace(r"[\p{N}]", kind["N"])
            self.exact_split = regex.compile(pattern, regex.V1)
        self.rank_by_key: dict[int, int] = {}
        self.from_sign = {s: b for b, s in signs.items()}

    def pieces(self, text: str) -> list:
        """The pre-tokens of a text; special tokens come as their ids."""
        out: list = []
        for part in self.special_split.split(text) if self.special_split and "<|" in text else (text,):
            if part in self.special:
                out.append(self.special[part])
            elif part:
                # lower case sign by sign: a sigma that ends a word is no special case
                part = unicodedata.normalize("NFC", part).replace("Σ", "σ")
                if self.beyond and self.beyond.search(part) and self.differing.search(part):
                    out += self.exact_split.findall(part.translate(self.lower).lower())
                else:
                    out += self.split.findall(part.lower())
        return out

    def rank_of(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of each pair, -1 where it has none."""
        key = left.astype(np.int64) * self.width + right
        at = np.minimum(np.searchsorted(self.pair_keys, key), len(self.pair_keys) - 1)
        return np.where(self.pair_keys[at] == key, self.pair_ranks[at], -1)

    def encode_long(self, word: str) -> list[int]:
        """The ids of one long word: its pair occurrence index is a heap of (rank, place)."""
        if not self.rank_by_key:
            self.rank_by_key = dict(zip(self.pair_keys.tolist(), self.pair_ranks.tolist(), strict=True))
        rank_of, width, merges = self.rank_by_key.get, self.width, self.merges
        raw = np.frombuffer(word.encode(), np.uint8)
        sym = self.first[raw].tolist()
        sym[-1] = int(self.last[raw[-1]])
        n = len(sym)
        nxt, prv = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = [(r, i) for i in range(n - 1) if (r := rank_of(sym[i] * width + sym[i + 1])) is not None]
        heapq.heapify(heap)
        while heap:
            r, p = heapq.heappop(heap)
            a, b, c = merges[r]
            q = nxt[p]
            if sym[p] != a or q >= n or sym[q] != b:            # taken by an earlier merge
                continue
            after = nxt[q]
            sym[p], sym[q], nxt[p] = c, -1, after
            if after < n:
                prv[after] = p
                if (s := rank_of(c * width + sym[after])) is not None:
                    heapq.heappush(heap, (s, p))
            if (before := prv[p]) >= 0 and (s := rank_of(sym[before] * width + c)) is not None:
                heapq.heappush(heap, (s, before))
        return [s for s in sym if s >= 0]

    def encode_words(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all words one after another, number of ids per word)."""
        long = [i for i, w in enumerate(words) if len(w) > LONG or len(w) * 4 > LONG and len(w.encode()) > LONG]
        if not long:
            return self.encode_short(words)
        alone = {i: np.array(self.encode_long(words[i]), np.int32) for i in long}
        ids, size = self.encode_short([w for i, w in enumerate(words) if i not in alone])
        parts, number, at, k = [], np.empty(len(words), np.int64), 0, 0
        ends = np.concatenate([[0], np.cumsum(size)])
        for i in [*long, len(words)]:
            parts.append(ids[ends[k]:ends[k + i - at]])
            number[at:i] = size[k:k + i - at]
            k += i - at
            at = i + 1
            if i in alone:
                parts.append(alone[i])
                number[i] = len(alone[i])
        return np.concatenate(parts), number

    def encode_short(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all words one after another, number of ids per word), through
        one pair occurrence index."""
        if not words:
            return np.empty(0, np.int32), np.empty(0, np.int64)
        raw = [w.encode() for w in words]
        size = np.fromiter(map(len, raw), np.int64, len(raw))
        data = np.frombuffer(b"".join(raw), np.uint8)
        ends = np.cumsum(size)
        sym = self.first[data]
        sym[ends - 1] = self.last[data[ends - 1]]
        of = np.repeat(np.arange(len(words)), size)
        nxt = np.arange(1, len(data) + 1)
        nxt[ends - 1] = -1
        prv = np.arange(-1, len(data) - 1)
        prv[ends - size] = -1
        # the index: rank of a pair -> places of its left symbols
        left = np.flatnonzero(nxt >= 0)
        rank = self.rank_of(sym[left], sym[left + 1])
        left, rank = left[rank >= 0], rank[rank >= 0]
        order = np.argsort(rank, kind="stable")
        left, rank = left[order], rank[order]
        cuts = np.flatnonzero(np.diff(rank)) + 1
        places: dict[int, list] = {int(r): p.tolist() for r, p in zip(rank[np.r_[0, cuts]], np.split(left, cuts), strict=True)} if len(rank) else {}
        active = sorted(places)                     # a sorted list is a heap
        while active:
            r = heapq.heappop(active)
            a, b, c = self.merges[r]
            p = np.array(places.pop(r))
            p = p[sym[p] == a]
            q = nxt[p]
            ok = (q >= 0) & (sym[q] == b)           # the others were taken by earlier merges
            p = np.unique(p[ok])
            if not len(p):
                continue
            # one place per word at a time: a merge may give rise to a lower rank, which then comes first
            later = np.zeros(len(p), bool)
            later[1:] = of[p[1:]] == of[p[:-1]]
            if later.any():
                places[r] = p[later].tolist()
                heapq.heappush(active, r)
                p = p[~later]
            q = nxt[p]
            after = nxt[q]
            sym[p], sym[q], nxt[p] = c, -1, after
            has = after >= 0
            prv[after[has]] = p[has]
            before = prv[p]
            start = before >= 0
            new = np.concatenate([p[has], before[start]])
            rank = self.rank_of(sym[new], sym[nxt[new]])
            for s, x in zip(rank.tolist(), new.tolist(), strict=True):
                if s >= 0:
                    if s in places:
                        places[s].append(x)
                    else:
                        places[s] = [x]
                        heapq.heappush(active, s)
        kept = sym >= 0
        return sym[kept].astype(np.int32), np.bincount(of[kept], minlength=len(words))

    def decode(self, ids) -> str:
        return " ".join(self.token[i] for i in ids)

    def words_of(self, ids) -> str:
        """The words behind ids, one space between them: the normalised text."""
        joined = "".join(self.token[i] for i in ids if i not in self.special.values())
        words = joined.split(self.end) if self.end else [joined]
        return " ".join(bytes(self.from_sign[s] for s in w).decode(errors="replace") for w in words if w)


class Encoder:
    """Encodes runs of texts, keeping the pre-tokens that it has encoded:
    their ids stand one after another in ``flat``."""

    def __init__(self, vocab: Vocabulary, max_kept: int = MAX_KEPT):
        self.vocab, self.max_kept = vocab, max_kept
        self.clear()

    def clear(self) -> None:
        self.number: dict = {}
        self.strings: list[str] = []
        self.flat = np.empty(0, np.int32)
        self.start = np.empty(0, np.int64)
        self.size = np.empty(0, np.int64)
        self.kept_bytes = 0

    def learn(self, new: list) -> None:
        """Encode pre-tokens that come next in ``number``; special ones are ids."""
        words = [w for w in new if isinstance(w, str)]
        ids, size = self.vocab.encode_words(words)
        if len(words) < len(new):
            at = [i for i, w in enumerate(new) if isinstance(w, int)]
            whole = np.ones(len(new), np.int64)
            whole[[i for i, w in enumerate(new) if isinstance(w, str)]] = size
            starts = np.cumsum(whole) - whole
            out = np.zeros(int(whole.sum()), np.int32)
            mask = np.ones(len(out), bool)
            mask[starts[at]] = False
            out[mask], out[starts[at]] = ids, [new[i] for i in at]
            ids, size = out, whole
        start = len(self.flat) + np.cumsum(size) - size
        names = list(map(self.vocab.token.__getitem__, ids.tolist()))
        lo = 0
        for n in size.tolist():
            self.strings.append(" ".join(names[lo:lo + n]))
            lo += n
        self.kept_bytes += sum(map(len, words))
        self.flat, self.start, self.size = np.append(self.flat, ids), np.append(self.start, start), np.append(self.size, size)

    def run(self, texts) -> tuple[np.ndarray, np.ndarray, list[str]]:
        """(ids of all texts one after another, number of ids per text, decoded texts)."""
        if len(self.number) > self.max_kept or self.kept_bytes > KEPT_BYTES * self.max_kept:
            self.clear()
        number, new, each = self.number, [], []
        for t in texts:
            row = []
            for w in self.vocab.pieces(t) if t else ():
                k = number.get(w)
                if k is None:
                    k = number[w] = len(number)
                    new.append(w)
                row.append(k)
            each.append(np.array(row, np.int32))
        self.learn(new)
        all_words = np.concatenate(each) if each else np.empty(0, np.int32)
        size = self.size[all_words]
        ends = np.cumsum(size)
        ids = self.flat[np.repeat(self.start[all_words] - (ends - size), size) + np.arange(ends[-1] if len(ends) else 0)]
        upto = np.concatenate([[0], ends])[np.cumsum([0, *map(len, each)])]
        strings = self.strings
        return ids, np.diff(upto), [" ".join([strings[k] for k in row.tolist()]) for row in each]


def runs(batches: Iterator[pa.RecordBatch], text: int, limit: int) -> Iterator[pa.RecordBatch]:
    """Consecutive rows whose texts hold about ``limit`` bytes, across batches."""
    held, size = [], 0
    for batch in batches:
        lo = 0
        for i, n in enumerate(pc.binary_length(batch.column(text)).to_pylist()):
            size += (n or 0) + 1
            if size >= limit:
                held.append(batch.slice(lo, i + 1 - lo))
                yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]
                held, size, lo = [], 0, i + 1
        if lo < batch.num_rows:
            held.append(batch.slice(lo))
    if held:
        yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]


def encode(docs: DataFrame, vocabulary: str, *keep: str) -> DataFrame:
    """The columns ``keep`` (doc_id if none are named), ids array<int> and the
    decoded text of every row. ``vocabulary``: path of the tokenizer file."""
    with open(vocabulary, "rb") as f:
        data = docs.sparkSession.sparkContext.broadcast((f.read(), library_signs(vocabulary)))
    keep = keep or ("doc_id",)
    types = dict(docs.select(*keep).dtypes)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(Vocabulary(*data.value))
        for run in runs(batches, len(keep), RUN_BYTES):
            ids, size, decoded = encoder.run(t.as_py() for t in run.column(len(keep)))
            for lo in range(0, run.num_rows, OUT_ROWS):             # smaller batches go out
                hi = min(lo + OUT_ROWS, run.num_rows)
                offsets = np.concatenate([[0], np.cumsum(size[lo:hi])])
                first = int(size[:lo].sum())
                listed = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(ids[first:first + offsets[-1]], pa.int32()))
                yield pa.RecordBatch.from_arrays([*run.slice(lo, hi - lo).columns[:len(keep)], listed, pa.array(decoded[lo:hi], pa.string())],
                                                 names=[*keep, "ids", "decoded"])

    schema = ", ".join(f"`{c}` {types[c]}" for c in keep) + ", ids array<int>, decoded string"
    return in_small_batches(docs.select(*keep, F.col("text").cast("string").alias("text"))).mapInArrow(trimmed(work), schema)


def digests(ids: Column, decoded: Column) -> list[Column]:
    """n_tokens, ids_sha256 and decoded_sha256 of an encoding."""
    return [F.size(ids).cast("long").alias("n_tokens"),
            F.sha2(F.array_join(ids.cast("array<string>"), " ").cast("binary"), 256).alias("ids_sha256"),
            F.sha2(decoded.cast("binary"), 256).alias("decoded_sha256")]
