"""Token counts by a unigram vocabulary; pre-tokens share their prefixes in a trie."""

from __future__ import annotations

from collections.abc import Iterator
from math import log

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame

from entitylake.llm.batches import blocks_of_words, column, share_code, slices, texts

SPACE = "▁"
NODES = 300_000
WORDS = 200_000
PENALTY = 10.0


def vocabulary(path: str) -> dict[str, float]:
    """The pieces of a vocabulary file with log-probabilities by Zipf's law over their order.

    Control, unknown and byte pieces are left out; characters without a piece fall back to bytes.
    """
    file = sentencepiece.SentencePieceProcessor(model_file=path)
    plain = [i for i in range(len(file)) if not (file.is_control(i) or file.is_unknown(i) or file.is_byte(i))]
    total = log(sum(1 / (rank + 1) for rank in range(len(plain))))
    return {file.id_to_piece(i): -log(rank + 1) - total for rank, i in enumerate(plain)}


class Trie:
    """Pre-tokens character by character; a node holds the best score up to it and its token count.

    The best segmentation has the highest sum of scores, of those with equal sums the fewest
    tokens. A node's value depends on its path alone, so it is computed once for all pre-tokens
    that share the path, and each pre-token's count is read off where it ends. A character
    that no piece covers costs ``PENALTY`` more than the rarest piece and counts its bytes. The
    trie holds at most ``nodes`` nodes; pre-tokens that need more are computed without being kept.
    """

    def __init__(self, pieces: dict[str, float], nodes: int = NODES) -> None:
        self.pieces, self.most = pieces, nodes
        self.longest = max(map(len, pieces), default=0)
        self.unknown = min(pieces.values(), default=0.0) - PENALTY
        self.next: dict[tuple[int, str], int] = {}
        self.score, self.count = [0.0], [0]

    def _value(self, word: str, scores: list[float], counts: list[int]) -> tuple[float, int]:
        """Forward step: the value after ``word``, given those after its shorter prefixes."""
        end, last = len(scores), word[len(scores) - 1]
        best = (scores[-1] + self.unknown, -(counts[-1] + len(last.encode())))
        for start in range(max(end - self.longest, 0), end):
            piece = self.pieces.get(word[start:end])
            if piece is not None:
                best = max(best, (scores[start] + piece, -(counts[start] + 1)))
        return best[0], -best[1]

    def tokens(self, word: str) -> int:
        node: int | None = 0
        scores, counts = [0.0], [0]
        for letter in word:
            following = None if node is None else self.next.get((node, letter))
            if following is None:
                score, count = self._value(word, scores, counts)
                if node is not None and len(self.score) < self.most:
                    following = self.next[node, letter] = len(self.score)
                    self.score.append(score)
                    self.count.append(count)
            else:
                score, count = self.score[following], self.count[following]
            scores.append(score)
            counts.append(count)
            node = following
        return counts[-1]


class _Counts(dict):
    """Tokens of a word with the mark of a space before it."""

    def __init__(self, trie: Trie) -> None:
        super().__init__()
        self.trie = trie

    def __missing__(self, word: bytes) -> int:
        found = self.trie.tokens(SPACE + word.decode())
        if len(self) < WORDS and len(word) <= 48:
            self[word] = found
        return found


_loaded: dict[str, _Counts] = {}


def token_counts(docs: DataFrame, model: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``(key, n_words, n_tokens)`` per row: the words of the whole text and their tokens.

    Words are the runs between white space, with the mark of a space before each. A null or empty
    text has none. Each Python worker keeps one trie of bounded size.
    """
    share_code(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if model not in _loaded:
            _loaded[model] = _Counts(Trie(vocabulary(model)))
        counts = _loaded[model].__getitem__
        for batch in batches:
            for part in slices(batch, "text"):
                found = np.zeros((part.num_rows, 2), np.int64)
                for row, value in enumerate(texts(part, "text")):
                    for words in blocks_of_words(value):
                        found[row] += len(words), sum(map(counts, words))
                yield pa.RecordBatch.from_arrays(
                    [part.column("key"), pa.array(found[:, 0]), pa.array(found[:, 1])], ["key", "n_words", "n_tokens"]
                )

    chosen = docs.select(column(docs, key).alias("key"), column(docs, text).cast("string").alias("text"))
    kind = chosen.schema["key"].dataType.simpleString()
    return chosen.mapInArrow(run, f"key {kind}, n_words long, n_tokens long").withColumnRenamed("key", key)


