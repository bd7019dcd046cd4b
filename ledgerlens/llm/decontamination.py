"""Benchmark decontamination: Wu-Manber search for many test strings at once.

A window is ``k`` consecutive words of a benchmark item; an item of fewer words,
but not none, is one window.  A document word inside any occurrence of a window
is hit.  Words are runs of digits, letters a-z (A-Z lower-cased) and everything
beyond ASCII.

Texts and items are written alike, their words between single spaces, so that an
occurrence of a window is an occurrence of its bytes.  Windows of one word count
form a group.  Within a group of shortest length m:

* the shift table tells, for each hashed block of B bytes, how far its last place
  in the first m bytes of any window is from their end.  The search looks at the
  block that ends at its place and jumps ahead by the block's shift; a block that no
  window has skips m - B + 1 places at once;
* a shift of 0 leads to a bucket of windows by their bytes at both ends and their
  length;
* the windows of the bucket are compared with the text byte by byte.

The search keeps one place for each stretch of a text and moves all of them at
once, as numpy arrays.  Documents are read in one map pass with no shuffle.  The
benchmark is dealt in blocks of at most ``BLOCK_BYTES`` of text, each of which is
broadcast and searched in a pass of its own; results add up, so any benchmark is
searched whole.

Defined results: a null or wordless text has 0 words and no hit.  A benchmark row
without text or words has no window; one without an id marks words but names no
item.  Rows that repeat a document id are documents of their own; rows that repeat
an item id are one item.  Other columns of the tables are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlens.llm import textkit as tk
from ledgerlens.llm.common import stored

K = 10
BLOCK_BYTES = 8 << 20
STRETCH = 2048
PAIRS = 1 << 20

_U = np.uint64
_ODD = _U(0x9E3779B97F4A7C15)
_SPACE, _EDGE = 32, 10

_SYMBOL = np.full(256, _SPACE, np.uint8)
_SYMBOL[48:58] = np.arange(48, 58)
_SYMBOL[97:123] = np.arange(97, 123)
_SYMBOL[65:91] = np.arange(97, 123)
_SYMBOL[128:] = np.arange(128, 256)

#: The lowest 0 to 8 bytes of a word of 8.
_LOW = np.array([(1 << 8 * i) - 1 for i in range(8)] + [(1 << 64) - 1], _U)

RESULT = "n_words long, hits array<struct<start:long,end:long>>, items array<string>"


class Spaced:
    """Texts as bytes: an edge, and their words with a space before and after each."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray) -> None:
        n = len(offsets) - 1
        wide = np.insert(_SYMBOL[data], np.repeat(offsets[:-1], 2), np.tile(np.array([_EDGE, _SPACE], np.uint8), n))
        wide = np.insert(wide, offsets[1:] + 2 * np.arange(1, n + 1), _SPACE)
        space = wide == _SPACE
        space[1:] &= space[:-1]
        space[:1] = False
        self.bytes = wide[~space]
        word = self.bytes > _SPACE
        self.starts = np.flatnonzero(word[1:] & ~word[:-1]) + 1
        self.ends = np.flatnonzero(word[:-1] & ~word[1:]) + 1
        edges = np.flatnonzero(self.bytes == _EDGE)
        #: for each text the index of its first word, and one entry more
        self.first = np.append(np.searchsorted(self.starts, edges), len(self.starts))
        padded = np.append(self.bytes, np.zeros(8, np.uint8))
        self.eight = np.ndarray(len(self.bytes) + 1, "<u8", padded, strides=(1,))


class Group:
    """Distinct windows of one word count, with their shift table and buckets."""

    def __init__(self, k: int, at: np.ndarray, size: np.ndarray, source: Spaced) -> None:
        self.k, self.source = k, source
        self.m = int(size.min())
        self.block = min(8, self.m)
        self.bits = int(np.clip(np.ceil(np.log2(4.0 * len(at) * self.m)), 10, 22))
        self.shift = np.full(1 << self.bits, self.m - self.block + 1, np.uint8 if self.m < 250 else np.uint32)
        for j in range(self.m - self.block + 1):  # later blocks lie nearer to the end
            self.shift[self.slot(source.eight[at + j])] = self.m - self.block - j
        key = self.key(source.eight, at, size)
        order = np.argsort(key, kind="stable")
        self.bucket, self.order, self.at, self.size = key[order], order, at[order], size[order]

    def slot(self, eight: np.ndarray) -> np.ndarray:
        return ((eight & _LOW[self.block]) * _ODD) >> _U(64 - self.bits)

    def key(self, eight: np.ndarray, at: np.ndarray, size: np.ndarray) -> np.ndarray:
        """Of the first m bytes' last block, the first block, the last one and the length."""
        b = self.block
        suffix, first, last = (eight[at + d] & _LOW[b] for d in (self.m - b, 0, size - b))
        return tk.mix(suffix * _ODD + tk.mix(first * _ODD + tk.mix(last * _ODD + size.astype(_U))))

    def places(self, text: Spaced) -> np.ndarray:
        """Where the first m bytes of a window may begin: the search by shifts."""
        end = len(text.bytes) - self.m + 1
        at = np.arange(0, max(end, 0), STRETCH)
        stop = np.minimum(at + STRETCH, end)
        found = []
        while len(at):
            step = self.shift[self.slot(text.eight[at + (self.m - self.block)])]
            if not step.all():
                found.append(at[step == 0])
            at = at + np.maximum(step, 1)
            going = at < stop
            at, stop = at[going], stop[going]
        return np.sort(np.concatenate(found)) if found else np.zeros(0, np.int64)

    def search(self, text: Spaced) -> tuple[np.ndarray, np.ndarray]:
        """(first word, window) of every occurrence in the texts."""
        at = self.places(text)
        at = at[text.bytes[at] == _SPACE]
        word = np.searchsorted(text.starts, at + 1)
        inside = word + self.k <= len(text.starts)
        at, word = at[inside], word[inside]
        whole = np.searchsorted(text.first, word, side="right") == np.searchsorted(text.first, word + self.k - 1, side="right")
        at, word = at[whole], word[whole]
        size = text.ends[word + self.k - 1] - at + 1
        at, word, size = (x[size >= self.m] for x in (at, word, size))
        key = self.key(text.eight, at, size)
        low = np.searchsorted(self.bucket, key)
        many = np.searchsorted(self.bucket, key, side="right") - low
        words, windows = [], []
        for i, j in _runs(many):
            count = many[i:j]
            own = np.repeat(np.arange(i, j), count)
            window = np.arange(len(own)) - np.repeat(np.cumsum(count) - count, count) + np.repeat(low[i:j], count)
            same = self.size[window] == size[own]
            own, window = own[same], window[same]
            for d in range(0, int(size[own].max(initial=0)), 8):
                mask = _LOW[np.clip(size[own] - d, 0, 8)]
                reach = size[own] > d
                a = text.eight[np.where(reach, at[own] + d, 0)]
                b = self.source.eight[np.where(reach, self.at[window] + d, 0)]
                same = (a ^ b) & mask == 0
                own, window = own[same], window[same]
            words.append(word[own])
            windows.append(self.order[window])
        none = np.zeros(0, np.int64)
        return np.concatenate(words or [none]), np.concatenate(windows or [none])


def _runs(many: np.ndarray) -> Iterator[tuple[int, int]]:
    """Runs of places with at most ``PAIRS`` windows to compare, or of one place."""
    total = np.append(0, np.cumsum(many))
    i = 0
    while i < len(many):
        j = max(i + 1, int(np.searchsorted(total, total[i] + PAIRS, side="right")) - 1)
        if total[j] > total[i]:
            yield i, j
        i = j


class Windows:
    """The windows of one block of the benchmark, by word count."""

    def __init__(self, ids: list[str | None], texts: list[str | None], k: int) -> None:
        spaced = Spaced(*tk.buffers(pa.array(texts, pa.string())))
        raw = spaced.bytes.tobytes()
        self.ids, groups = ids, {}
        for item, (i, j) in enumerate(zip(spaced.first[:-1].tolist(), spaced.first[1:].tolist(), strict=True)):
            size = min(k, j - i)
            for w in range(i, j - size + 1 if size else i):
                at, end = int(spaced.starts[w]) - 1, int(spaced.ends[w + size - 1]) + 1
                _, items = groups.setdefault(size, {}).setdefault(raw[at:end], (at, set()))
                if ids[item] is not None:
                    items.add(item)
        self.groups = []
        for size, windows in sorted(groups.items()):
            at = np.array([at for at, _ in windows.values()], np.int64)
            length = np.array([len(x) for x in windows], np.int64)
            named = [sorted(items) for _, items in windows.values()]
            first = np.append(0, np.cumsum([len(x) for x in named]))
            self.groups.append((Group(size, at, length, spaced), first, np.array([i for x in named for i in x], np.int64)))

    def search(self, text: Spaced) -> tuple[np.ndarray, np.ndarray, list[set[str]]]:
        """(starts, ends) of the stretches of hit words, each within a text, and the items of each text."""
        n = len(text.first) - 1
        change = np.zeros(len(text.starts) + 1, np.int64)
        items: list[set[str]] = [set() for _ in range(n)]
        for group, first, named in self.groups:
            word, window = group.search(text)
            np.add.at(change, word, 1)
            np.add.at(change, word + group.k, -1)
            own = np.searchsorted(text.first, word, side="right") - 1
            for t, w in np.unique(np.stack([own, window], 1), axis=0).tolist():
                items[t].update(self.ids[i] for i in named[first[w]:first[w + 1]])
        hit = np.cumsum(change[:-1]) > 0
        new = hit.copy()
        begins = text.first[:-1][text.first[:-1] < len(hit)]
        joined = hit[1:] & hit[:-1]
        new[1:] = hit[1:] & ~joined
        new[begins] = hit[begins]
        last = hit.copy()
        last[:-1] = hit[:-1] & ~joined
        last[begins[begins > 0] - 1] = hit[begins[begins > 0] - 1]
        return np.flatnonzero(new), np.flatnonzero(last) + 1, items


def _merged(a: list, b: list) -> list:
    """The union of two lists of stretches."""
    out: list[dict] = []
    for x in sorted(a + b, key=lambda x: (x["start"], x["end"])):
        if out and x["start"] <= out[-1]["end"]:
            out[-1] = {"start": out[-1]["start"], "end": max(out[-1]["end"], x["end"])}
        else:
            out.append(x)
    return out


def _blocks(benchmark: DataFrame, item_id: str, text: str, limit: int) -> Iterator[tuple[list, list]]:
    """The benchmark's rows in blocks of at most ``limit`` bytes of text, or of one longer item."""
    ids, texts, total = [], [], 0
    rows = benchmark.select(F.col(item_id).cast("string"), F.col(text)).where(F.col(text).isNotNull())
    for row in rows.toLocalIterator():
        size = len(row[1].encode())
        if texts and total + size > limit:
            yield ids, texts
            ids, texts, total = [], [], 0
        ids.append(row[0])
        texts.append(row[1])
        total += size
    if texts:
        yield ids, texts


_cache: dict[int, Windows] = {}


def _search_batches(block, number: int, text: str, k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # one table per worker and block: block numbers are unique within a session
        if number not in _cache:
            _cache.clear()
            _cache[number] = Windows(*block.value, k)
        windows = _cache[number]
        for batch in batches:
            data, offsets = tk.buffers(batch.column(text))
            counts, hits, items = [], [], []
            for i, j in tk.chunks(offsets):
                spaced = Spaced(data[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i])
                counts.extend(np.diff(spaced.first).tolist())
                starts, ends, named = windows.search(spaced)
                own = np.searchsorted(spaced.first, starts, side="right") - 1
                base = spaced.first[own]
                found: list[list] = [[] for _ in range(j - i)]
                for t, a, b in zip(own.tolist(), (starts - base).tolist(), (ends - base).tolist(), strict=True):
                    found[t].append({"start": a, "end": b})
                hits.extend(found)
                items.extend(sorted(x) for x in named)
            if "hits" in batch.schema.names:  # of the blocks before
                hits = [_merged(a, b) for a, b in zip(batch.column("hits").to_pylist(), hits, strict=True)]
                items = [sorted({*a, *b}) for a, b in zip(batch.column("items").to_pylist(), items, strict=True)]
            spans = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column(text), pa.array(counts, pa.int64()),
                 pa.array(hits, spans), pa.array(items, pa.list_(pa.string()))],
                names=["doc_id", text, "n_words", "hits", "items"])
    return run


_numbers = iter(range(1 << 62))


def search(docs: DataFrame, benchmark: DataFrame, k: int = K, doc_id: str = "doc_id", text: str = "text",
           item_id: str = "item_id", item_text: str = "text", block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Per document: doc_id, text, n_words, ``hits`` (stretches [start, end) of word numbers)
    and ``items``, the ids of the items with windows that occur, as sorted strings."""
    spark = docs.sparkSession
    found = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    schema = f"doc_id {found.schema['doc_id'].dataType.simpleString()}, text string, {RESULT}"
    blocks = _blocks(benchmark, item_id, item_text, block_bytes)
    block, again = next(blocks, ([], [])), False
    while block is not None:
        if again:
            found = stored(found, "decontamination")
        sent, again = spark.sparkContext.broadcast(block), True
        found = found.mapInArrow(_search_batches(sent, next(_numbers), "text", k), schema)
        block = next(blocks, None)
    return found


def digest(found: DataFrame) -> DataFrame:
    """Per document of ``search``: counts, the items' digest and whether anything is hit."""
    n_hit = F.aggregate("hits", F.lit(0).cast("long"), lambda n, h: n + h["end"] - h["start"])
    return found.select(
        "doc_id", "n_words", n_hit.alias("n_hit"), F.size("items").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", F.sort_array("items")), 256).alias("items_sha256"),
        (F.size("hits") > 0).alias("contaminated"))


#: The same digest in DuckDB SQL, from the same words: windows joined by their words.
ORACLE_SQL = r"""
WITH d AS (
  SELECT row_number() OVER () AS row, doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM documents),
i AS (
  SELECT item_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM benchmark),
windows AS (
  SELECT DISTINCT item_id, least(10, len(w)) AS k, array_to_string(w[s:s + least(10, len(w)) - 1], ' ') AS phrase
  FROM (SELECT item_id, w, unnest(generate_series(1, greatest(1, len(w) - 9))) AS s FROM i WHERE len(w) > 0)),
places AS (
  SELECT row, s, k, array_to_string(w[s:s + k - 1], ' ') AS phrase
  FROM (SELECT row, w, k, unnest(generate_series(1, len(w) - k + 1)) AS s
        FROM d, (SELECT DISTINCT k FROM windows) WHERE len(w) >= k)),
found AS (SELECT row, s, k, item_id FROM places JOIN windows USING (k, phrase)),
hit AS (
  SELECT row, count(DISTINCT p) AS n FROM (SELECT row, unnest(generate_series(s, s + k - 1)) AS p FROM found) GROUP BY row),
named AS (
  SELECT row, list_sort(list(DISTINCT CAST(item_id AS VARCHAR))) AS items FROM found WHERE item_id IS NOT NULL GROUP BY row)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n, 0) AS BIGINT) AS n_hit,
  CAST(coalesce(len(items), 0) AS BIGINT) AS n_items,
  sha256(coalesce(array_to_string(items, ','), '')) AS items_sha256, coalesce(n, 0) > 0 AS contaminated
FROM d LEFT JOIN hit USING (row) LEFT JOIN named USING (row)
"""
