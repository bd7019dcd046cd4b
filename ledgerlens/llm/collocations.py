"""Phrase collocations, counted with an FM-index per shard of word ids.

Texts are lower-cased (A-Z), cut into pieces at ``.,;:!?`` and line ends, and pieces
into words at spaces and tabs.  Counts are exact and per language.

1. ``shards``: one map pass turns each partition's texts into shards of about
   ``SHARD_WORDS`` words of one language at most (open ones twice that together): ids of the shard's own vocabulary, 0 between
   pieces, and the vocabulary with counts.  They are written once; all later passes
   read them and not the texts.  A piece that goes on in the next shard hands over its
   last three words, whose own phrases the next shard counts back.
2. Word counts are summed across shards.  A phrase is at most as frequent as its words,
   so words below ``least`` become gaps.  Each shard builds its index over the rest,
   extends the interval of each word to the left, and emits a fingerprint and the
   count of each pair.
3. Gaps come where the sum of a pair is below ``least``.  Each shard builds a
   bidirectional index of what remains: the interval of a phrase in the
   Burrows-Wheeler transform of the text and of the reversed text.  Phrases grow to
   the left and to the right in turn, from two words to four, and their fingerprints
   and counts are summed likewise.
4. The shards emit whole the phrases whose fingerprints are frequent.  Their sums are
   every candidate's count and those of its parts; cuts, containment and ranks are
   joins and aggregates over phrases.

Shards learn which words and phrases are frequent from Bloom filters of at most
``FILTER_BITS`` bits.  Fingerprints of phrases travel in blocks, a sorted array for each
block and task.  False positives, and phrases of equal fingerprint, cost rows and change no count, as only phrases whose own sum is ``least`` or more go on.  Words are
64-bit fingerprints (of language and word); only the words of phrases that may be among
the first are read again as strings.

Defined results: a null text is empty, a null language is ``und``.  Document ids and
other columns are not read, so repeated rows count again.  A word may be of any length.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerlens.llm import textkit as tk
from ledgerlens.llm.common import stored

LEAST = 30
DEPTH = 4
SHARD_WORDS = 1 << 19
FILTER_BITS = 1 << 29
BITS_EACH = 16
CONTAINED = (100, 80)
TOP = 2000
#: Rows that one task ranks before the last step.
RANKED = 100_000
#: Bytes of text that are cut into words at once (a longer text by itself).
READ_BYTES = 4 << 20
#: Fingerprints that a task holds to add up equal phrases of its shards.
HELD = 1 << 20
#: Words of the corpus for each block of fingerprints that one task adds up.
BLOCK_WORDS = 1 << 21

_U = np.uint64

#: What a byte is: 0 of a word, 1 between words, 2 between pieces.
_KIND = np.zeros(256, np.uint8)
_KIND[[0x20, 0x09]] = 1
_KIND[[*b".,;:!?", 0x0A, 0x0B, 0x0C, 0x0D]] = 2

SHARD = "lang string, n long, context int, ids binary, hashes array<long>, words array<string>, counts array<long>"


# --- shards -------------------------------------------------------------------------

class _Shard:
    """The words of one language gathered so far."""

    def __init__(self, lang: str) -> None:
        name = np.frombuffer(lang.encode(), np.uint8)
        # mixed once more, so that a language's salt is no word's fingerprint
        self.lang, self.salt = lang, tk.mix(~tk.hashes(name, np.array([0]), np.array([len(name)]), fold=False))[0]
        self.clear()

    def clear(self, context: list | None = None) -> None:
        self.hashes, self.breaks, self.seen, self.words = [], [], [], []
        self.size, self.context = 0, 0
        if context:
            hashes, words = context
            self.context = len(hashes)
            breaks = np.zeros(len(hashes), bool)
            breaks[0] = True
            self.add(hashes, breaks, hashes, words)

    def add(self, hashes: np.ndarray, breaks: np.ndarray, seen: np.ndarray, words: pa.Array) -> None:
        self.hashes.append(hashes)
        self.breaks.append(breaks)
        self.seen.append(seen)
        self.words.append(words)
        self.size += len(hashes)

    def tail(self) -> list | None:
        """The last words of the piece that is still open, three at most."""
        hashes, breaks, left = [], [], DEPTH - 1
        for h, b in zip(reversed(self.hashes), reversed(self.breaks), strict=True):
            hashes.insert(0, h[-left:])
            breaks.insert(0, b[-left:])
            left -= len(hashes[0])
            if not left:
                break
        hashes, breaks = np.concatenate(hashes), np.concatenate(breaks)
        hashes = hashes[max(np.flatnonzero(breaks), default=0):]
        seen, words = np.concatenate(self.seen), pa.concat_arrays(self.words)
        order = np.argsort(seen, kind="stable")
        return [hashes, words.take(pa.array(order[np.searchsorted(seen, hashes, sorter=order)]))]

    def row(self) -> dict:
        hashes, breaks = np.concatenate(self.hashes), np.concatenate(self.breaks)
        vocabulary, ids = np.unique(hashes, return_inverse=True)
        seen, first = np.unique(np.concatenate(self.seen), return_index=True)
        assert len(seen) == len(vocabulary)
        place = np.arange(len(ids)) + np.cumsum(breaks)
        text = np.zeros(len(ids) + int(breaks.sum()) + 1, "<i4")
        text[place] = ids + 1
        counts = np.bincount(ids[self.context:], minlength=len(vocabulary))
        return {"lang": self.lang, "n": len(ids) - self.context, "context": self.context, "ids": text.tobytes(),
                "hashes": vocabulary.view(np.int64), "words": pa.concat_arrays(self.words).take(pa.array(first)),
                "counts": counts.astype(np.int64)}


def _slices(kind: np.ndarray, limit: int) -> Iterator[tuple[int, int]]:
    """Runs of about ``limit`` bytes that end after a byte between words."""
    i = 0
    while i < len(kind):
        j = min(i + limit, len(kind))
        if j < len(kind):
            back = np.flatnonzero(kind[i:j][::-1])
            if len(back):
                j -= int(back[0])
            else:  # one long word
                ahead = np.flatnonzero(kind[j:])
                j = j + int(ahead[0]) + 1 if len(ahead) else len(kind)
        yield i, j
        i = j


def _strings(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> pa.Array:
    """Byte ranges, lower-cased, as strings; bytes that are no UTF-8 do not occur."""
    size = ends - starts
    offsets = np.append(0, np.cumsum(size))
    at = np.repeat(starts - offsets[:-1], size) + np.arange(offsets[-1])
    raw = tk.FOLD[data[at]]
    return pa.LargeStringArray.from_buffers(len(size), pa.py_buffer(offsets.astype(np.int64)), pa.py_buffer(raw))


def _gather(data: np.ndarray, offsets: np.ndarray, shard: _Shard, room) -> Iterator[dict]:
    """Adds the texts to the shard; yields rows of shards that ``room`` asks to close."""
    stream = np.insert(data, offsets[1:], 0x0A)  # every text ends its last piece
    kind = _KIND[stream]
    gap = True  # whether a piece ends between the word before and the next one
    for i, j in _slices(kind, tk.CHUNK_BYTES):
        part, own = stream[i:j], kind[i:j]
        inside = own == 0
        edge = np.diff(np.concatenate([[False], inside, [False]]).astype(np.int8))
        starts, ends = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
        closed = np.append(0, np.cumsum(own == 2))
        if len(starts):
            breaks = np.empty(len(starts), bool)
            breaks[0] = gap or closed[starts[0]] > 0
            breaks[1:] = closed[starts[1:]] > closed[ends[:-1]]
            gap = bool(closed[-1] > closed[ends[-1]])
            hashes = tk.mix(tk.hashes(part, starts, ends, fold=True) ^ shard.salt)
            seen, first = np.unique(hashes, return_index=True)
            shard.add(hashes, breaks, seen, _strings(part, starts[first], ends[first]))
            yield from room(None if gap else shard)
        else:
            gap = gap or bool(closed[-1])


def _shard_batches(shard_words: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        open_shards: dict[str, _Shard] = {}

        def room(current: _Shard | None) -> Iterator[dict]:
            """Closes the largest shard while it, or all together, hold too many words."""
            while True:
                largest = max(open_shards.values(), key=lambda s: s.size)
                full = largest.size >= shard_words or sum(s.size for s in open_shards.values()) >= 2 * shard_words
                if not full or largest.size <= largest.context:
                    return
                context = largest.tail() if largest is current else None
                yield largest.row()
                largest.clear(context)

        for batch in batches:
            for i, j in tk.chunks(tk.buffers(batch.column("text"))[1], READ_BYTES):
                langs = pc.fill_null(batch.column("lang")[i:j], "und").dictionary_encode()
                for code, lang in enumerate(langs.dictionary.to_pylist()):
                    texts = batch.column("text")[i:j].filter(pc.equal(langs.indices, code))
                    shard = open_shards.setdefault(lang, _Shard(lang))
                    for row in _gather(*tk.buffers(texts), shard, room):
                        yield _record(row)
        for shard in open_shards.values():
            if shard.size > shard.context:
                yield _record(shard.row())
    return run


def _record(row: dict) -> pa.RecordBatch:
    def one(values: pa.Array) -> pa.Array:
        return pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), values)

    return pa.RecordBatch.from_arrays(
        [pa.array([row["lang"]]), pa.array([row["n"]], pa.int64()), pa.array([row["context"]], pa.int32()),
         pa.array([row["ids"]], pa.binary()), one(pa.array(row["hashes"])), one(row["words"].cast(pa.string())),
         one(pa.array(row["counts"]))],
        names=["lang", "n", "context", "ids", "hashes", "words", "counts"])


def shards(docs: DataFrame, text: str = "text", lang: str = "lang", shard_words: int = SHARD_WORDS) -> DataFrame:
    """The written shards of all texts."""
    rows = docs.select(F.col(lang).cast("string").alias("lang"), F.col(text).cast("string").alias("text"))
    return stored(rows.mapInArrow(_shard_batches(shard_words), SHARD), "shards")


# --- the index of a shard -----------------------------------------------------------

class Index:
    """A depth-limited FM-index of ids (1 to ``size``, 0 a gap; gaps at both ends).

    Rows are the places of the text, sorted by their first ``depth`` ids.  ``bwt`` is the id
    before each place, ``step`` the row of the place before (the LF mapping).  The
    interval of a phrase of at most ``depth`` ids holds its occurrences.
    """

    def __init__(self, text: np.ndarray, size: int, depth: int) -> None:
        rank, reach, span = text.astype(np.int64), 1, size + 1
        while reach < depth:  # ranks by twice as many ids
            key = rank * span
            key[:-reach] += rank[reach:]
            reach *= 2
            rank = np.unique(key, return_inverse=True)[1] if reach < depth else key
            span = int(rank.max(initial=0)) + 1
        rows = np.argsort(rank).astype(np.int32)
        del rank, key
        row = np.empty_like(rows)
        row[rows] = np.arange(len(rows), dtype=np.int32)
        rows -= 1
        self.size = size
        self.bwt = text[rows]
        self.step = row[rows]
        self.first = np.append(0, np.cumsum(np.bincount(text, minlength=size + 1)))

    def extended(self, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, ...]:
        """Every id that precedes each interval: (interval, id, low, high of the longer
        phrase, number of rows of the interval with smaller ids or gaps)."""
        size = high - low
        rows = np.repeat((low - (np.cumsum(size) - size)).astype(np.int32), size)
        rows += np.arange(len(rows), dtype=np.int32)
        key = np.repeat(np.arange(len(low)) * (self.size + 1), size)
        key += self.bwt[rows]
        order = np.argsort(key)
        key = key[order]
        rows = rows[order]
        del order
        first = np.flatnonzero(np.diff(key, prepend=-1))
        if not len(first):
            none = np.zeros(0, np.int64)
            return none, none, none, none, none
        count = np.diff(first, append=len(key))
        own, ids = np.divmod(key[first], self.size + 1)
        begin = np.minimum.reduceat(self.step[rows], first).astype(np.int64)
        before = first - np.append(0, np.cumsum(size))[own]
        word = ids > 0
        return own[word], ids[word], begin[word], (begin + count)[word], before[word]


class Phrases:
    """Phrases of one length with their intervals in both indexes, kept in step."""

    def __init__(self, forward: Index, backward: Index | None) -> None:
        self.forward, self.backward = forward, backward
        ids = np.arange(1, forward.size + 1)
        self.words = ids[:, None]
        self.low, self.high = forward.first[ids], forward.first[ids + 1]
        self.mirror = self.low if backward is None else backward.first[ids]

    @property
    def counts(self) -> np.ndarray:
        return self.high - self.low

    def _grown(self, words, low, high, mirror) -> Phrases:
        out = object.__new__(Phrases)
        out.forward, out.backward, out.words, out.low, out.high, out.mirror = self.forward, self.backward, words, low, high, mirror
        return out

    def left(self) -> Phrases:
        """All phrases with one more word in front."""
        own, ids, low, high, before = self.forward.extended(self.low, self.high)
        return self._grown(np.column_stack([ids, self.words[own]]), low, high, self.mirror[own] + before)

    def right(self) -> Phrases:
        """All phrases with one more word behind: the backward index leads."""
        own, ids, low, high, before = self.backward.extended(self.mirror, self.mirror + self.counts)
        begin = self.low[own] + before
        return self._grown(np.column_stack([self.words[own], ids]), begin, begin + high - low, low)


def _compact(text: np.ndarray) -> np.ndarray:
    """One gap between pieces, one at each end; pieces as they are."""
    text = np.concatenate([[0], text, [0]]).astype(np.int32)
    keep = text > 0
    keep[1:] |= text[:-1] > 0
    keep[0] = True
    return text[keep]


def _dense(text: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(text over the ids that occur, those ids; 0 stays 0)."""
    used = np.bincount(text) > 0
    used[0] = True
    return (np.cumsum(used, dtype=np.int32) - 1)[text], np.flatnonzero(used)


# --- filters of frequent words and pairs ----------------------------------------------

def _pair(a, b):
    """One fingerprint of two words'."""
    return tk.mix(((a << _U(17)) | (a >> _U(47))) ^ b)


class Bloom:
    """Two bits for each fingerprint, in at most ``FILTER_BITS`` bits."""

    def __init__(self, bits: int, places: np.ndarray, values: np.ndarray) -> None:
        self.bits = bits
        self.table = np.zeros(max(1, bits >> 6), _U)
        self.table[places] = values

    def has(self, h: np.ndarray) -> np.ndarray:
        out = np.ones(len(h), bool)
        for place in (h & _U(self.bits - 1), (h >> _U(29)) & _U(self.bits - 1)):
            out &= (self.table[place >> _U(6)] >> (place & _U(63))) & _U(1) == 1
        return out


def bloom(frequent: DataFrame, column: str, most: int = FILTER_BITS) -> Bloom:
    """The filter of a column of fingerprints, put together in Spark: the driver gets its
    words, at most ``most`` bits."""
    bits = 64
    wanted = frequent.count() * BITS_EACH
    while bits < min(wanted, most):
        bits *= 2
    mask = F.lit(bits - 1).cast("long")
    h = F.col(column)
    place = F.explode(F.array(h.bitwiseAND(mask), F.shiftrightunsigned(h, 29).bitwiseAND(mask))).alias("place")
    words = (frequent.select(place)
             .select(F.shiftright("place", 6).alias("at"), F.expr("shiftleft(1L, cast(place & 63 as int))").alias("bit"))
             .groupBy("at").agg(F.bit_or("bit").alias("bits")).toPandas())
    return Bloom(bits, words["at"].to_numpy(np.int64), words["bits"].to_numpy(np.int64).view(_U))


# --- phrases of the shards --------------------------------------------------------------

def _read(batch: pa.RecordBatch) -> Iterator[tuple[np.ndarray, np.ndarray, int]]:
    """(ids with 0 between pieces, fingerprints of the ids from 1, words of context)."""
    hashes = batch.column("hashes")
    for i in range(len(batch)):
        own = hashes[i].values.to_numpy(zero_copy_only=False).view(_U)
        text = np.frombuffer(batch.column("ids")[i].as_buffer(), "<i4")
        yield text, np.append(_U(0), own), batch.column("context")[i].as_py()


def _fingerprint(words: np.ndarray) -> np.ndarray:
    """One fingerprint of the words of each row."""
    out = words[:, 0]
    for i in range(1, words.shape[1]):
        out = _pair(out, words[:, i])
    return out


class _Blocks:
    """Counts of fingerprints, added across the shards of a task and emitted by block:
    of each fingerprint the first ``bits`` bits, its block, and 32 more."""

    def __init__(self, bits: int) -> None:
        self.bits, self.held, self.counts, self.size = bits, [], [], 0

    def add(self, fingerprints: np.ndarray, counts: np.ndarray) -> Iterator[pa.RecordBatch]:
        self.held.append(fingerprints >> _U(32 - self.bits))
        self.counts.append(counts)
        self.size += len(counts)
        if self.size >= HELD:
            yield from self.rows()

    def rows(self) -> Iterator[pa.RecordBatch]:
        if not self.size:
            return
        held, counts = _added(np.concatenate(self.held), np.concatenate(self.counts))
        self.held, self.counts, self.size = [], [], 0
        edges = np.searchsorted(held, np.arange((1 << self.bits) + 1, dtype=_U) << _U(32)) if self.bits else np.array([0, len(held)])
        full = np.flatnonzero(np.diff(edges))
        rest, counts = held.astype("<u4"), counts.astype("<i4")
        yield pa.RecordBatch.from_arrays(
            [pa.array(full, pa.int64()),
             pa.array([rest[edges[b]:edges[b + 1]].tobytes() for b in full], pa.binary()),
             pa.array([counts[edges[b]:edges[b + 1]].tobytes() for b in full], pa.binary())], names=["block", "rest", "n"])


BLOCK = "block long, rest binary, n binary"


def _added(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys in order, and the sums of their counts."""
    order = np.argsort(keys)
    keys = keys[order]
    first = np.flatnonzero(np.append(True, keys[1:] != keys[:-1])[:len(keys)])
    return keys[first], np.add.reduceat(counts[order], first) if len(first) else counts


def _frequent(least: int):
    """The fingerprints of a block whose counts of all tasks reach ``least``, mixed for the filter."""
    def run(block: pa.Table) -> pa.Table:
        rest, counts = (np.concatenate([np.frombuffer(x.as_buffer(), kind) for x in block.column(name)])
                        for name, kind in (("rest", "<u4"), ("n", "<i4")))
        rest, counts = _added(rest, counts.astype(np.int64))
        whole = (_U(block.column("block")[0].as_py()) << _U(32)) | rest[counts >= least].astype(_U)
        return pa.table({"h": pa.array(tk.mix(whole).view(np.int64))})
    return run


class _Known:
    """Whether fingerprints are among the frequent ones, by the bits that their blocks keep."""

    def __init__(self, bloom_filter, bits: int) -> None:
        self.filter, self.bits = bloom_filter, bits

    def has(self, fingerprints: np.ndarray) -> np.ndarray:
        return self.filter.value.has(tk.mix(fingerprints >> _U(32 - self.bits)))


class _Phrases:
    """Counts of whole phrases, added across the shards of a task and emitted by block; a
    block's phrases are in the order of their words, of which neighbours share the first."""

    def __init__(self, bits: int) -> None:
        self.bits, self.held, self.counts, self.size = bits, [], [], 0

    def add(self, words: np.ndarray, counts: np.ndarray) -> Iterator[pa.RecordBatch]:
        wide = np.zeros((len(words), DEPTH), _U)
        wide[:, :words.shape[1]] = words
        self.held.append(wide)
        self.counts.append(counts)
        self.size += len(words)
        if self.size * DEPTH >= HELD:
            yield from self.rows()

    def rows(self) -> Iterator[pa.RecordBatch]:
        if not self.size:
            return
        words, counts = _added_rows(np.concatenate(self.held), np.concatenate(self.counts))
        self.held, self.counts, self.size = [], [], 0
        block = _fingerprint(words) >> _U(32) >> _U(32 - self.bits)
        order = np.argsort(block, kind="stable")
        block, words, counts = block[order], words[order], counts[order].astype("<i4")
        full, edges = np.unique(block, return_index=True)
        edges = np.append(edges, len(block))
        parts = list(zip(edges[:-1], edges[1:], strict=True))
        yield pa.RecordBatch.from_arrays(
            [pa.array(full.astype(np.int64)), pa.array([words[i:j].T.tobytes() for i, j in parts], pa.binary()),
             pa.array([counts[i:j].tobytes() for i, j in parts], pa.binary())], names=["block", "rest", "n"])


def _added_rows(words: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct rows in order, and the sums of their counts."""
    order = np.lexsort(words.T[::-1])
    words = words[order]
    new = np.ones(len(words), bool)
    new[1:] = (words[1:] != words[:-1]).any(1)
    first = np.flatnonzero(new)
    return words[first], np.add.reduceat(counts[order], first) if len(first) else counts


def _whole(least: int):
    """The phrases of a block whose counts of all tasks reach ``least``: null beyond the phrase."""
    def run(block: pa.Table) -> pa.Table:
        words = np.concatenate([np.frombuffer(x.as_buffer(), "<u8").reshape(DEPTH, -1).T for x in block.column("rest")])
        counts = np.concatenate([np.frombuffer(x.as_buffer(), "<i4") for x in block.column("n")]).astype(np.int64)
        words, counts = _added_rows(words, counts)
        words, counts = words[counts >= least], counts[counts >= least]
        columns = {f"h{i}": pa.array(words[:, i].view(np.int64), mask=words[:, i] == 0) for i in range(DEPTH)}
        return pa.table(columns | {"f": pa.array(counts)})
    return run


def _context(text: np.ndarray, context: int, length: int) -> np.ndarray:
    """The phrases that lie in the context words: the shard before has counted them.
    The text begins with a gap and the context words, of which some may be gaps now."""
    head = text[1:1 + context]
    found = [head[i:i + length] for i in range(context - length + 1)]
    return np.array([x for x in found if (x > 0).all()], np.int64).reshape(-1, length)


def _pairs(words_filter, bits: int):
    """Fingerprints and counts of the pairs of known words."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = _Blocks(bits)
        for batch in batches:
            for text, hashes, context in _read(batch):
                known = words_filter.value.has(hashes)
                known[0] = False
                text = text * known[text]
                back = _context(text, context, 2)
                yield from sums.add(_fingerprint(hashes[back]), np.full(len(back), -1))
                text, used = _dense(_compact(text))
                found = Phrases(Index(text, len(used) - 1, 2), None).left()
                yield from sums.add(_fingerprint(hashes[used][found.words]), found.counts)
        yield from sums.rows()
    return run


def _grown(batches: Iterator[pa.RecordBatch], pairs) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(words, counts) of the phrases of two, three and four words whose pairs are all frequent."""
    for batch in batches:
        for text, hashes, context in _read(batch):
            h = hashes[text]
            good = np.zeros(len(text) + 1, bool)  # whether the word at i follows i - 1 in a frequent pair
            good[1:-1] = (text[:-1] > 0) & (text[1:] > 0) & pairs.has(_pair(h[:-1], h[1:]))
            for length in range(2, DEPTH):
                for i in range(context - length + 1):
                    if good[2 + i:1 + i + length].all():
                        yield h[None, 1 + i:1 + i + length], np.array([-1])
            keep = good[:-1] | good[1:]  # words of some frequent pair
            text = text * keep
            text = np.insert(text, np.flatnonzero(~good[:-1]), 0)  # a gap before a word that follows in no pair
            text, used = _dense(_compact(text))
            size = len(used) - 1
            own, found = hashes[used], Phrases(Index(text, size, DEPTH), Index(text[::-1], size, DEPTH))
            for step in (Phrases.left, Phrases.right, Phrases.left):
                found = step(found)
                yield own[found.words], found.counts


def _longer(pairs, bits: int):
    """Fingerprints and counts of phrases of three and four words."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = _Blocks(bits)
        for words, counts in _grown(batches, pairs):
            if words.shape[1] > 2:
                yield from sums.add(_fingerprint(words), counts)
        yield from sums.rows()
    return run


def _phrases(pairs, longer, bits: int):
    """Words and counts of the phrases whose fingerprints are frequent."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = _Phrases(bits)
        for words, counts in _grown(batches, pairs):
            if words.shape[1] > 2:
                known = longer.has(_fingerprint(words))
                words, counts = words[known], counts[known]
            yield from sums.add(words, counts)
        yield from sums.rows()
    return run


# --- from counts to phrases ------------------------------------------------------------

def counted(parts: DataFrame, least: int = LEAST, filter_bits: int = FILTER_BITS) -> tuple[DataFrame, DataFrame]:
    """(words, phrases) that occur ``least`` times: ``h, lang, f``, and ``h0..h3, f`` of two
    to four words (null beyond the phrase)."""
    context = parts.sparkSession.sparkContext
    each = parts.select("lang", F.inline(F.arrays_zip("hashes", "counts")))
    words = each.groupBy(F.col("hashes").alias("h"), "lang").agg(F.sum("counts").alias("f"))
    words = stored(words.where(F.col("f") >= least), "words")
    index = parts.select("ids", "hashes", "context")
    known = context.broadcast(bloom(words, "h", filter_bits))
    total = parts.agg(F.sum("n")).first()[0] or 0
    bits = min(32, max(0, (total // BLOCK_WORDS).bit_length()))

    def frequent(rows: DataFrame, kind: str) -> _Known:
        rows = stored(rows.groupBy("block").applyInArrow(_frequent(least), "h long"), kind)
        return _Known(context.broadcast(bloom(rows, "h", filter_bits)), bits)

    pairs = frequent(index.mapInArrow(_pairs(known, bits), BLOCK), "pairs")
    longer = frequent(index.mapInArrow(_longer(pairs, bits), BLOCK), "longer")
    phrases = index.mapInArrow(_phrases(pairs, longer, bits), BLOCK).groupBy("block").applyInArrow(
        _whole(least), "h0 long, h1 long, h2 long, h3 long, f long")
    return words, stored(phrases, "phrases")


def _spelled(wanted):
    """(h, word) of the fingerprints in the filter."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        done = np.zeros(0, _U)
        for batch in batches:
            for i in range(len(batch)):
                hashes = batch.column("hashes")[i].values
                own = hashes.to_numpy(zero_copy_only=False).view(_U)
                new = wanted.value.has(own) & ~np.isin(own, done)
                done, mask = np.append(done, own[new]), pa.array(new)
                yield pa.RecordBatch.from_arrays(
                    [hashes.filter(mask), batch.column("words")[i].values.filter(mask)], names=["h", "word"])
    return run


def _parts(length: int) -> list[tuple[int, int]]:
    """(start, end) of the contiguous proper parts of two or more of ``length`` words."""
    return [(i, j) for i in range(length) for j in range(i + 2, length + 1) if j - i < length]


def collocations(docs: DataFrame, text: str = "text", lang: str = "lang", least: int = LEAST, top: int = TOP,
                 contained: tuple[int, int] = CONTAINED, shard_words: int = SHARD_WORDS,
                 filter_bits: int = FILTER_BITS) -> DataFrame:
    """Per language its ``top`` phrases by score: ``lang, rank, phrase, a, l, r, n, score``."""
    parts = shards(docs, text, lang, shard_words)
    words, phrases = counted(parts, least, filter_bits)
    key = F.array_compact(F.array(*(F.col(f"h{i}") for i in range(DEPTH))))
    phrases = stored(phrases.select(key.alias("key"), F.col("f").alias("a")), "counts")
    counts = stored(phrases.unionByName(words.select(F.array("h").alias("key"), F.col("f").alias("a"))), "parts")

    # phrases that a longer one holds often enough go
    many, share = contained
    inner = F.when(F.size("key") == 3, F.array(*(F.slice("key", i + 1, j - i) for i, j in _parts(3)))).otherwise(
        F.array(*(F.slice("key", i + 1, j - i) for i, j in _parts(4))))
    holders = phrases.where(F.size("key") > 2).select(F.explode(inner).alias("key"), F.col("a").alias("longer"))
    holders = stored(holders.groupBy("key").agg(F.max("longer").alias("longer")), "holders")
    held = F.col("longer").isNotNull() & (many * F.col("longer").cast("decimal(20,0)") >= share * F.col("a").cast("decimal(20,0)"))
    free = stored(phrases.join(holders, "key", "left").where(~held).select("key", "a"), "free")

    # the lowest-scoring cut
    cuts = free.select("key", "a", F.explode(F.sequence(F.lit(1), F.size("key") - 1)).alias("cut"))
    left = counts.select(F.col("key").alias("part"), F.col("a").alias("l"))
    right = counts.select(F.col("key").alias("part"), F.col("a").alias("r"))
    cuts = stored(cuts.withColumn("part", F.slice("key", F.lit(1), F.col("cut"))).join(left, "part").drop("part"), "cuts")
    behind = F.slice("key", F.col("cut") + 1, F.size("key") - F.col("cut"))
    cuts = cuts.withColumn("part", behind).join(right, "part").drop("part")
    score = F.expr("(cast(2000000 as decimal(7,0)) * cast(a as decimal(19,0))) div (cast(l as decimal(19,0)) + cast(r as decimal(19,0)))")
    cuts = stored(cuts.withColumn("score", score.cast("long")), "scored")
    best = cuts.groupBy("key", "a").agg(F.min(F.struct("score", "cut", "l", "r")).alias("best"))
    best = stored(best.select("key", F.col("key")[0].alias("h"), "a", "best.l", "best.r", "best.score"), "best")
    best = stored(best.join(words.select("h", "lang"), "h").drop("h"), "ranked")

    # those that may be among the first of their language, ties included, and their words
    slices = 1 + best.count() // RANKED
    order = [F.desc("score"), F.desc("a")]
    some = Window.partitionBy("lang", F.pmod(F.xxhash64("key"), F.lit(slices))).orderBy(*order)
    if slices > 1:
        best = stored(best.withColumn("place", F.rank().over(some)).where(F.col("place") <= top).drop("place"), "slices")
    whole = Window.partitionBy("lang").orderBy(*order)
    best = stored(best.withColumn("place", F.rank().over(whole)).where(F.col("place") <= top).drop("place"), "first")
    wanted = stored(best.select("key", F.posexplode("key").alias("place", "h")), "wanted")
    asked = docs.sparkSession.sparkContext.broadcast(bloom(wanted, "h", filter_bits))
    names = stored(parts.select("hashes", "words").mapInArrow(_spelled(asked), "h long, word string").distinct(), "names")
    spelled = stored(wanted.join(names, "h"), "spelled").groupBy("key").agg(
        F.concat_ws(" ", F.transform(F.sort_array(F.collect_list(F.struct("place", "word"))), lambda x: x["word"])).alias("phrase"))
    best = stored(best.join(spelled, "key"), "named")

    order.append(F.asc("phrase"))
    first = best.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long"))
    languages = parts.groupBy("lang").agg(F.sum("n").alias("n"))
    return first.where(F.col("rank") <= top).join(languages, "lang").select(
        "lang", "rank", "phrase", "a", "l", "r", "n", "score")


#: The same in DuckDB SQL: all phrases of up to four words as strings.
ORACLE_SQL = r"""
WITH d AS (
  SELECT coalesce(lang, 'und') AS lang,
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text FROM documents),
pieces AS (
  SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w
  FROM (SELECT lang, unnest(regexp_split_to_array(text, '[.,;:!?\x0A-\x0D]')) AS piece FROM d)),
totals AS (SELECT lang, CAST(sum(len(w)) AS BIGINT) AS n FROM pieces GROUP BY lang),
grams AS (
  SELECT lang, k, array_to_string(w[s:s + k - 1], ' ') AS phrase, count(*) AS a
  FROM (SELECT lang, w, k, unnest(generate_series(1, len(w) - k + 1)) AS s
        FROM pieces, (VALUES (1), (2), (3), (4)) AS lengths(k) WHERE len(w) >= k)
  GROUP BY ALL HAVING count(*) >= 30),
parts AS (SELECT lang, k, a, phrase, string_split(phrase, ' ') AS w FROM grams WHERE k > 1),
holders AS (
  SELECT lang, array_to_string(w[s:s + m - 1], ' ') AS phrase, max(a) AS longer
  FROM (SELECT lang, w, a, m, unnest(generate_series(1, k - m + 1)) AS s
        FROM parts, (VALUES (2), (3)) AS lengths(m) WHERE m < k)
  GROUP BY ALL),
free AS (
  SELECT p.* FROM parts p LEFT JOIN holders h USING (lang, phrase)
  WHERE h.longer IS NULL OR 100 * CAST(h.longer AS HUGEINT) < 80 * CAST(p.a AS HUGEINT)),
cuts AS (
  SELECT f.lang, f.phrase, f.a, c, x.a AS l, y.a AS r,
    (2000000 * CAST(f.a AS HUGEINT)) // (CAST(x.a AS HUGEINT) + y.a) AS score
  FROM (SELECT *, unnest(generate_series(1, k - 1)) AS c FROM free) f
  JOIN grams x ON x.lang = f.lang AND x.phrase = array_to_string(f.w[1:c], ' ')
  JOIN grams y ON y.lang = f.lang AND y.phrase = array_to_string(f.w[c + 1:], ' ')),
best AS (
  SELECT lang, phrase, a, l, r, score FROM cuts
  QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, c) = 1),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM best)
SELECT lang, CAST(rank AS BIGINT) AS rank, phrase, CAST(a AS BIGINT) AS a, CAST(l AS BIGINT) AS l, CAST(r AS BIGINT) AS r,
  n, CAST(score AS BIGINT) AS score
FROM ranked JOIN totals USING (lang) WHERE rank <= 2000
"""
