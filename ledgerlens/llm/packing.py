"""Packing along a space-filling curve.

1. Tokenize (a map).  The vocabulary's pre-tokenizer never joins across white space,
   nor across the edges of runs of letters, digits and signs, and it lower-cases; so
   the ids of a text are those of such pieces in a row, and each distinct piece in a
   worker's cache is tokenized once.  Words for which that could fail (apostrophes,
   possible special tokens, letters beyond Latin-1) are pieces as they stand.
2. A document's ids are hashed with signs into a vector of ``DIMENSIONS``, normalised,
   projected to ``AXES`` dimensions and quantised; its place on the Hilbert
   curve through that grid is its key.
3. The documents are range-partitioned and sorted by (key, doc_id): neighbours on
   the curve become neighbours in a partition, and equal keys can be split.
4. Each partition streams through one task that fills sequences in curve order.
   A document that does not fit is cut where the sequence ends.  Only the
   partition's last tokens leave a short sequence; they are dealt to sequences
   whose sizes are powers of two, which need no padding.

``sequence_id`` is the partition's number shifted left by 33 bits plus a running number.
A null text is empty: its only id is the end mark.  Null doc_ids are packed too.
An empty table gives an empty result.
"""

from __future__ import annotations

import os
import zlib
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlens.llm import textkit as tk
from ledgerlens.llm.common import lean, stored

END_ID = 2
DIMENSIONS = 64
AXES = 3
BITS = 10
CACHE_PIECES = 700_000

# a fixed orthonormal projection of the hashed vectors
_PROJECTION = np.linalg.qr(np.random.default_rng(5).standard_normal((DIMENSIONS, AXES)))[0]


def hilbert_keys(cells: np.ndarray, bits: int = BITS) -> np.ndarray:
    """The Hilbert curve index of integer grid cells (rows of coordinates), by the
    transposed-axes bit method, all rows at once."""
    x = cells.astype(np.int64).T.copy()
    n, top = len(x), np.int64(1) << (bits - 1)
    q = top
    while q > 1:
        p = q - 1
        for i in range(n):
            high = (x[i] & q) != 0
            swap = np.where(high, 0, (x[0] ^ x[i]) & p)
            x[0] = np.where(high, x[0] ^ p, x[0] ^ swap)
            x[i] = x[i] ^ swap
        q >>= 1
    for i in range(1, n):
        x[i] ^= x[i - 1]
    turn = np.zeros_like(x[0])
    q = top
    while q > 1:
        turn = np.where((x[n - 1] & q) != 0, turn ^ (q - 1), turn)
        q >>= 1
    x ^= turn
    key = np.zeros_like(x[0])
    for b in range(bits - 1, -1, -1):
        for i in range(n):
            key = key << 1 | (x[i] >> b & 1)
    return key


_KIND = np.full(256, 2, np.uint8)  # 0 letters and bytes of longer codes, 1 digits, 2 signs
_KIND[65:91] = _KIND[97:123] = _KIND[128:] = 0
_KIND[48:58] = 1
_LATIN = np.zeros(256, bool)  # second bytes of the letters U+00C0 to U+00FF
_LATIN[0x80:0xC0] = True
_LATIN[[0x97, 0xB7]] = False  # the signs for times and divided by
_WHOLE = np.zeros(256, bool)
_WHOLE[[0x27, 0x3C]] = True  # ' opens contractions, < special tokens
_WHOLE[128:] = True


def pieces(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(starts, ends, whole, first): the pieces that are tokenized on their own, whether
    each is an uncut word, and the index of each text's first piece."""
    starts, ends, first = tk.words(data, offsets)
    if not len(starts):
        return starts, ends, np.zeros(0, bool), first
    odd = _WHOLE[data]
    lead = data == 0xC3
    odd[lead] = False
    odd[1:][lead[:-1] & _LATIN[data[1:]]] = False
    total = np.concatenate([[0], np.cumsum(odd)])
    whole_word = total[ends] > total[starts]
    kind = _KIND[data]
    cut = np.empty(len(data), bool)
    cut[0] = True
    cut[1:] = (kind[1:] != kind[:-1]) | (kind[1:] == 1)
    cut &= ~tk.SPACE[data]
    # no cuts inside whole words, and one at each word's start
    depth = np.zeros(len(data) + 1, np.int8)
    depth[starts[whole_word]] += 1
    depth[ends[whole_word]] -= 1
    cut &= np.cumsum(depth[:-1], dtype=np.int8) == 0
    cut[starts] = True
    at = np.flatnonzero(cut)
    word_first = np.searchsorted(at, starts)
    end = np.empty(len(at), np.int64)
    end[:-1] = at[1:]
    end[np.append(word_first[1:] - 1, len(at) - 1)] = ends
    whole = np.zeros(len(at), bool)
    whole[word_first[whole_word]] = True
    return at, end, whole, np.append(word_first, len(at))[first]


class PieceTokenizer:
    """Token ids of whole texts through a cache of distinct pieces."""

    def __init__(self, vocabulary: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(vocabulary)
        self.model = self.tokenizer.model
        self.clear()

    def clear(self) -> None:
        self.known = np.zeros(0, np.uint64)  # fingerprints in order, and each one's slot
        self.slot = np.zeros(0, np.int32)
        self.ids = np.zeros(1 << 16, np.uint32)
        self.first = np.zeros(1 << 16, np.int64)
        self.size = 0

    def _learn(self, new_hashes: np.ndarray, new_pieces: list[str]) -> None:
        encoded: list[list[int]] = [[]] * len(new_pieces)
        other = []
        for i, piece in enumerate(new_pieces):
            if piece.isascii() and piece.isalpha():  # one pre-token that only needs its case folded
                encoded[i] = [t.id for t in self.model.tokenize(piece.lower())]
            else:
                other.append(i)
        for i, e in zip(other, self.tokenizer.encode_batch_fast([new_pieces[i] for i in other], add_special_tokens=False)):
            encoded[i] = e.ids
        lengths = np.fromiter(map(len, encoded), np.int64, len(encoded))
        used, more, n = int(self.first[self.size]), int(lengths.sum()), len(encoded)
        if used + more > len(self.ids):
            self.ids = np.concatenate([self.ids[:used], np.zeros(used + 2 * more, np.uint32)])
        if self.size + n + 1 > len(self.first):
            self.first = np.concatenate([self.first[:self.size + 1], np.zeros(self.size + 2 * n, np.int64)])
        self.ids[used:used + more] = np.fromiter(chain.from_iterable(encoded), np.uint32, more)
        self.first[self.size + 1:self.size + 1 + n] = used + np.cumsum(lengths)
        at = np.searchsorted(self.known, new_hashes)
        self.known = np.insert(self.known, at, new_hashes)
        self.slot = np.insert(self.slot, at, np.arange(self.size, self.size + n, dtype=np.int32))
        self.size += n

    def chunk(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids, first): the ids of all texts in a row, and where each text's begin."""
        starts, ends, whole, first_piece = pieces(data, offsets)
        if not len(starts):
            return np.zeros(0, np.uint32), np.zeros(len(offsets), np.int64)
        if self.size > CACHE_PIECES:
            self.clear()
        keys = tk.hashes(data, starts, ends, fold=True)
        if whole.any():  # special tokens are told by their case
            keys[whole] = tk.mix(tk.hashes(data, starts[whole], ends[whole], fold=False) ^ np.uint64(1))
        distinct, at, back = np.unique(keys, return_index=True, return_inverse=True)
        place = np.searchsorted(self.known, distinct)
        found = place < self.size
        found[found] = self.known[place[found]] == distinct[found]
        new = np.flatnonzero(~found)
        if len(new):
            raw = data.tobytes()
            self._learn(distinct[new],
                        [raw[s:e].decode("utf-8", "replace") for s, e in zip(starts[at[new]].tolist(), ends[at[new]].tolist())])
        slots = self.slot[np.searchsorted(self.known, distinct)][back]
        begin = self.first[slots]
        lengths = self.first[slots + 1] - begin
        total = np.concatenate([[0], np.cumsum(lengths)])
        place = np.repeat(begin - total[:-1], lengths) + np.arange(total[-1])
        return self.ids[place], total[first_piece]


_tokenizers: dict[int, PieceTokenizer] = {}


def piece_tokenizer(vocabulary: str) -> PieceTokenizer:
    """This worker's tokenizer: a later task finds the pieces of earlier ones."""
    key = hash(vocabulary)
    if key not in _tokenizers:
        _tokenizers.clear()
        _tokenizers[key] = PieceTokenizer(vocabulary)
    return _tokenizers[key]


def _hashed_vectors(vocab_size: int) -> tuple[np.ndarray, np.ndarray]:
    h = tk.mix(np.arange(1, vocab_size + 1, dtype=np.uint64))
    return (h % np.uint64(DIMENSIONS)).astype(np.int64), np.where(h >> np.uint64(63), 1.0, -1.0)


def _tokenize_batches(vocabulary: str, end_id: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = piece_tokenizer(vocabulary)
        size = max(words.tokenizer.get_vocab_size(), end_id + 1)
        dimension, sign = _hashed_vectors(size)
        kind = np.uint16 if size <= 1 << 16 else np.uint32
        for batch in batches:
            data, offsets = tk.buffers(batch.column("text"))
            for i, j in tk.chunks(offsets):
                ids, first = words.chunk(data[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i])
                vectors, own = np.zeros((j - i, DIMENSIONS)), []
                for d in range(j - i):
                    mine = ids[first[d]:first[d + 1]]
                    vectors[d] = np.bincount(dimension[mine], weights=sign[mine], minlength=DIMENSIONS)
                    own.append(np.append(mine, end_id).astype(kind).tobytes())
                norm = np.linalg.norm(vectors, axis=1, keepdims=True)
                flat = np.tanh(vectors / np.maximum(norm, 1e-9) @ _PROJECTION * np.sqrt(DIMENSIONS) / 2)
                cells = np.minimum((flat + 1) / 2 * (1 << BITS), (1 << BITS) - 1)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").slice(i, j - i), pa.array(hilbert_keys(cells)), pa.array(own, pa.binary())],
                    ["doc_id", "curve", "ids"])
    return run


class _Packer:
    """Fills sequences in the order of the documents; holds one sequence at a time."""

    def __init__(self, partition: int, capacity: int, with_ids: bool):
        self.sequence, self.capacity, self.with_ids = partition << 33, capacity, with_ids
        self.rows: list[list] = []
        self.open: list[tuple[int | None, int, np.ndarray, int]] = []
        self.filled = 0

    def add(self, doc_id: int | None, ids: np.ndarray) -> None:
        start = 0
        while start < len(ids):
            piece = ids[start:start + self.capacity - self.filled]
            self.open.append((doc_id, start, piece, len(ids)))
            self.filled += len(piece)
            start += len(piece)
            if self.filled == self.capacity:
                self._close()

    def _close(self) -> None:
        offset = 0
        for doc_id, start, piece, total in self.open:
            row = [doc_id, start, len(piece), zlib.crc32(piece.astype("<u4").tobytes()), total, self.sequence, offset]
            self.rows.append(row + [piece] * self.with_ids)
            offset += len(piece)
        self.sequence, self.open, self.filled = self.sequence + 1, [], 0

    def finish(self) -> None:
        """The last tokens, in sequences of falling powers of two."""
        rest, left = self.open, self.filled
        self.open, self.filled, whole = [], 0, self.capacity
        while left:
            self.capacity = 1 << (left.bit_length() - 1)
            need = self.capacity
            while need:
                doc_id, start, piece, total = rest.pop(0)
                self.open.append((doc_id, start, piece[:need], total))
                if len(piece) > need:
                    rest.insert(0, (doc_id, start + need, piece[need:], total))
                need -= min(need, len(piece))
            left -= self.capacity
            self._close()
        self.capacity = whole

    def take(self, schema: pa.Schema) -> pa.RecordBatch:
        columns = list(zip(*self.rows)) if self.rows else [()] * len(schema)
        self.rows = []
        arrays = [pa.array(c, pa.int64()) for c in columns[:7]]
        if self.with_ids:
            ends = np.cumsum([0, *map(len, columns[7])])
            flat = np.concatenate([np.zeros(0, np.int32), *columns[7]]).astype(np.int32)
            arrays.append(pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat)))
        return pa.RecordBatch.from_arrays(arrays, schema=schema)


_SCHEMA = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"


def _pack_batches(capacity: int, wide: bool, with_ids: bool):
    names = [c.split()[0] for c in _SCHEMA.split(", ")]
    schema = pa.schema([(c, pa.int64()) for c in names] + [("ids", pa.list_(pa.int32()))] * with_ids)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer = _Packer(TaskContext.get().partitionId(), capacity, with_ids)
        for batch in batches:
            for doc_id, ids in zip(batch.column("doc_id").to_pylist(), batch.column("ids")):
                packer.add(doc_id, np.frombuffer(ids.as_buffer(), np.uint32 if wide else np.uint16))
            yield packer.take(schema)
        packer.finish()
        yield packer.take(schema)
    return run


def pack(docs: DataFrame, vocabulary_file: str, capacity: int = 4096, end_id: int = END_ID, with_ids: bool = True) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id,
    offset, and with ``with_ids`` the ids themselves."""
    with open(vocabulary_file, encoding="utf-8") as f:
        vocabulary = f.read()
    from tokenizers import Tokenizer

    wide = max(Tokenizer.from_str(vocabulary).get_vocab_size(), end_id + 1) > 1 << 16
    tokens = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(
        lean(_tokenize_batches(vocabulary, end_id)), "doc_id long, curve long, ids binary")
    ordered = stored(tokens, "tokens").repartitionByRange("curve", "doc_id").sortWithinPartitions("curve", "doc_id", F.xxhash64("ids"))
    return ordered.select("doc_id", "ids").mapInArrow(
        lean(_pack_batches(capacity, wide, with_ids)), _SCHEMA + (", ids array<int>" if with_ids else ""))
