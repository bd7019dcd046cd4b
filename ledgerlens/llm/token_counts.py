"""Token counts under a unigram model by dynamic programming on a trie.

A pre-token is a word ``[^\\x20\\x09-\\x0D]+`` with the word mark in front.  Its
count is the number of pieces in its most probable segmentation; equal scores
take the fewer pieces, and a character outside the vocabulary costs one byte
piece for each of its UTF-8 bytes.

The distinct pre-tokens of a chunk are inserted into a trie.  The forward score
of a prefix depends on the prefix alone, so a node's best score and piece count
are computed once, when it is created, from its ancestors' and shared by all
pre-tokens below it.  A terminal's count is stored and looked up for
every further occurrence.  The trie is dropped when it reaches ``MAX_NODES``, which
bounds memory and changes no count.

The vocabulary file's piece scores are merge ranks; the log-probability of the
piece of rank r is taken as Zipf's ``-ln(r + 2)`` less the normaliser, a byte
piece's as that of the last rank.

A map over whole texts.  A null, empty or blank text has no tokens; rows are kept
one to one, null ids included.
"""

from __future__ import annotations

import math
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlens.llm import textkit as tk

MARK = "▁"
MAX_NODES = 1_200_000
CHUNK = 4 << 20


def vocabulary(model_file: str) -> dict[str, float]:
    """piece -> log-probability, without control and byte pieces."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=model_file)
    pieces = [model.id_to_piece(i) for i in range(model.get_piece_size())
              if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i))]
    norm = math.log(sum(1 / (r + 2) for r in range(len(pieces))))
    return {p: -math.log(r + 2) - norm for r, p in enumerate(pieces)}


class Trie:
    """Forward scores shared by prefix; a node's values never change."""

    def __init__(self, scores: dict[str, float]):
        self.scores = scores
        self.longest = max(map(len, scores), default=1)
        self.byte_score = min(scores.values(), default=-1.0)
        self.clear()

    def clear(self) -> None:
        self.child: dict[int, int] = {}
        self.best = array("d", [0.0])
        self.pieces = array("q", [0])
        self.terminal: dict[int, int] = {}

    def count(self, word: str) -> int:
        """Pieces of the best segmentation; inserts the word's new prefixes."""
        child, path, node = self.child, [0], 0
        for i, c in enumerate(word):
            key = node << 21 | ord(c)
            node = child.get(key, -1)
            if node < 0:
                node = child[key] = self._score(word, i, path)
            path.append(node)
        return self.pieces[node]

    def _score(self, word: str, i: int, path: list[int]) -> int:
        best, pieces, scores = self.best, self.pieces, self.scores
        size = len(word[i].encode("utf-8", "surrogatepass"))
        score, count = best[path[i]] + size * self.byte_score, pieces[path[i]] + size
        for j in range(max(0, i + 1 - self.longest), i + 1):
            p = scores.get(word[j:i + 1])
            if p is not None:
                s, n = best[path[j]] + p, pieces[path[j]] + 1
                if s > score or (s == score and n < count):
                    score, count = s, n
        best.append(score)
        pieces.append(count)
        return len(best) - 1


def _count_batches(scores: dict[str, float]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trie = Trie(scores)
        for batch in batches:
            data, offsets = tk.buffers(batch.column("text"))
            words, tokens = np.zeros(batch.num_rows, np.int64), np.zeros(batch.num_rows, np.int64)
            for i, j in tk.chunks(offsets, CHUNK):
                part = data[offsets[i]:offsets[j]]
                starts, ends, first = tk.words(part, offsets[i:j + 1] - offsets[i])
                if not len(starts):
                    continue
                if len(trie.best) > MAX_NODES:
                    trie.clear()
                distinct, at, back = np.unique(tk.hashes(part, starts, ends, fold=False), return_index=True, return_inverse=True)
                raw, counts, known = part.tobytes(), np.zeros(len(distinct), np.int64), trie.terminal
                for x, (h, s, e) in enumerate(zip(distinct.tolist(), starts[at].tolist(), ends[at].tolist())):
                    n = known.get(h)
                    if n is None:
                        n = known[h] = trie.count(MARK + raw[s:e].decode("utf-8", "replace"))
                    counts[x] = n
                total = np.concatenate([[0], np.cumsum(counts[back])])
                words[i:j], tokens[i:j] = np.diff(first), total[first[1:]] - total[first[:-1]]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(words), pa.array(tokens)],
                                             ["doc_id", "n_pretokens", "n_tokens"])
    return run


def token_counts(docs: DataFrame, scores: dict[str, float]) -> DataFrame:
    """One row per document: its pre-tokens and its unigram tokens."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(
        _count_batches(scores), "doc_id long, n_pretokens long, n_tokens long")
