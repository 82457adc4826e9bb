"""Token counts of a unigram model by trie-shared dynamic programming.

The pieces are those of a public vocabulary; their scores follow from their
place in it by Zipf's law, log p = -log(place + 2.7) (nothing is trained). The
best segmentation of a pre-token (a word with the word-start sign before it)
maximises the sum of its pieces' scores. Its forward scores depend on prefixes
alone, so the distinct pre-tokens of a task are inserted in a trie, every node
holds the best score and token count of its prefix, computed when the node is
made from the nodes above it, and the node at a pre-token's end holds its
count. Pre-tokens that share a prefix share its scores. A sign that no piece
covers counts one token for each of its UTF-8 bytes.

A task's trie is dropped and begun anew beyond MAX_NODES nodes; counts don't
depend on that. Nothing is shuffled.

Edge cases: NULL and empty texts have 0 words and 0 tokens; a word is scored
whole whatever its length; rows repeat as they come; an empty table gives an
empty result; columns beyond doc_id and text are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import by_value, in_small_batches, trimmed

by_value(__name__)

WORD_START = "▁"
MAX_NODES = 1_500_000
MAX_TRIE_WORD = 64        # longer words are scored by themselves, not kept in the trie
UNKNOWN_MARGIN = 10.0     # below the lowest score


def zipf_pieces(model_file: str) -> dict[str, float]:
    """piece -> score of the ordinary pieces of a vocabulary file."""
    import sentencepiece
    sp = sentencepiece.SentencePieceProcessor(model_file=model_file)
    plain = [sp.id_to_piece(i) for i in range(sp.get_piece_size())
             if not (sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i) or sp.is_unused(i))]
    return {p: -math.log(k + 2.7) for k, p in enumerate(plain)}


class Trie:
    """Pre-tokens with the forward score and token count of every prefix."""

    def __init__(self, pieces: dict[str, float]):
        self.pieces = pieces
        self.longest = max(map(len, pieces), default=1)
        self.unknown = min(pieces.values(), default=0.0) - UNKNOWN_MARGIN
        self.clear()

    def clear(self) -> None:
        self.child: list[dict[str, int]] = [{}]
        self.best = [0.0]
        self.tokens = [0]

    def _forward(self, word: str, d: int, best, tokens) -> tuple[float, int]:
        """Best score and count of word[:d], from those of its prefixes."""
        top, n = best(d - 1) + self.unknown, tokens(d - 1) + len(word[d - 1].encode())
        for s in range(max(0, d - self.longest), d):
            score = self.pieces.get(word[s:d])
            if score is not None and best(s) + score > top:
                top, n = best(s) + score, tokens(s) + 1
        return top, n

    def count(self, word: str) -> int:
        """Insert a pre-token; only the nodes that it adds are scored."""
        if len(word) > MAX_TRIE_WORD:
            best, tokens = [0.0], [0]
            for d in range(1, len(word) + 1):
                top, n = self._forward(word, d, best.__getitem__, tokens.__getitem__)
                best.append(top)
                tokens.append(n)
            return tokens[-1]
        node, path = 0, [0]
        child, best, tokens = self.child, self.best, self.tokens
        for d, sign in enumerate(word, 1):
            node = child[path[-1]].get(sign, -1)
            if node < 0:
                top, n = self._forward(word, d, lambda s: best[path[s]], lambda s: tokens[path[s]])
                node = len(best)
                child[path[-1]][sign] = node
                child.append({})
                best.append(top)
                tokens.append(n)
            path.append(node)
        return tokens[node]


class Counts(dict):
    """word -> tokens, filled from the trie on demand; bounded."""

    def __init__(self, trie: Trie, max_nodes: int = MAX_NODES):
        super().__init__()
        self.trie, self.max_nodes = trie, max_nodes

    def __missing__(self, word: bytes) -> int:
        if len(self.trie.best) > self.max_nodes:
            self.trie.clear()
            self.clear()
        n = self.trie.count(WORD_START + word.decode())
        if len(word) <= 4 * MAX_TRIE_WORD:
            self[word] = n
        return n


def token_counts(docs: DataFrame, model_file: str) -> DataFrame:
    """doc_id, n_words, n_tokens (long) of every row."""
    pieces = docs.sparkSession.sparkContext.broadcast(zipf_pieces(model_file))     # 32,000 pieces
    id_type = docs.schema["doc_id"].dataType.simpleString()

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = Counts(Trie(pieces.value))
        for batch in batches:
            n_words, n_tokens = [], []
            for t in batch.column(1):
                words = t.as_py().encode().split()      # bytes split at exactly 09-0D and 20
                n_words.append(len(words))
                n_tokens.append(sum(map(counts.__getitem__, words)))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n_words, pa.int64()), pa.array(n_tokens, pa.int64())],
                                             names=["doc_id", "n_words", "n_tokens"])

    rows = docs.select("doc_id", F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    return in_small_batches(rows).mapInArrow(trimmed(work), f"doc_id {id_type}, n_words long, n_tokens long")
