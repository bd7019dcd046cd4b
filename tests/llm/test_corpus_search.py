"""Whitening, decontamination and collocations against brute force."""

from __future__ import annotations

import random
import re
from collections import Counter
from fractions import Fraction
from hashlib import sha256

import numpy as np
import pyarrow as pa
import pytest

from ledgerlens.llm import collocations, decontamination, whitening
from ledgerlens.llm import textkit as tk


def lowered(text: str | None) -> str:
    return (text or "").translate({i: i + 32 for i in range(65, 91)})


# --- whitening -----------------------------------------------------------------------

def whole(vector) -> tuple[int, ...] | None:
    if not vector or any(c is None or not np.isfinite(c) for c in vector):
        return None
    return tuple(int(np.floor(64 * float(c))) + 1000000 for c in vector)


def check_whitening(spark, rows, components=16):
    """The operator's rows against exact sums and numpy's eigenvalues."""
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>, n int, x string")
    got = whitening.whiten(frame, components).collect()
    kept = [(r[0], whole(r[1])) for r in rows if whole(r[1])]
    lengths = Counter(len(x) for _, x in kept)
    size = max(lengths, key=lambda k: (lengths[k], k))
    kept = [(i, x) for i, x in kept if len(x) == size]
    distinct = sorted({x for _, x in kept})
    n, sums = len(distinct), [sum(c) for c in zip(*distinct, strict=True)]
    centred = np.array([[float(Fraction(n * a - s, n)) for a, s in zip(x, sums, strict=True)] for x in distinct])
    covariance = centred.T @ centred / n
    values = np.linalg.eigvalsh(covariance)[::-1]
    rank = min(components, int((values > 1e-12 * values.sum()).sum()))
    assert len(got) == len(kept) * rank
    deviation = {x: sum((n * a - s) ** 2 for a, s in zip(x, sums, strict=True)) for _, x in kept}
    assert Counter((r.vec_id, int(r.deviation)) for r in got) == Counter(
        {(i, d): m * rank for (i, d), m in Counter((i, deviation[x]) for i, x in kept).items()})
    assert {r.n for r in got} == {n}
    for r in got:
        assert r.explained == pytest.approx(values[r.component - 1] / values.sum(), rel=1e-9)
        assert r.identity_error < 1e-9
    return got, kept, centred, distinct


def test_whitening_is_the_eigenvectors_of_distinct_vectors(spark):
    rng = np.random.default_rng(7)
    base = rng.normal(size=(120, 20)) @ rng.normal(size=(20, 20))
    rows = [(i, v.tolist(), 1, "a") for i, v in enumerate(base)]
    rows += [(1000 + i, base[0].tolist(), 2, "b") for i in range(80)]  # a hot copy counts once
    got, kept, centred, distinct = check_whitening(spark, rows)
    table = {(r.vec_id, r.component): r.whitened for r in got}
    place = {x: i for i, x in enumerate(distinct)}
    values, vectors = np.linalg.eigh(centred.T @ centred / len(distinct))
    for component in range(1, 17):
        direction = vectors[:, -component] / np.sqrt(values[-component])
        expected = np.array([centred[place[x]] @ direction for _, x in kept])
        found = np.array([table[i, component] for i, _ in kept])
        assert min(np.abs(found - expected).max(), np.abs(found + expected).max()) < 1e-8


def test_whitening_odd_rows(spark):
    rows = [(1, [0.5, 1.0, 2.0], 1, "a"), (1, [0.5, 1.0, 2.0], 1, "a"), (None, [1.5, 0.25, 3.0], 1, "a"),
            (3, [0.25, 7.0, -2.0], 1, "a"), (4, None, 1, "a"), (5, [1.0, None, 2.0], 1, "a"), (6, [], 1, "a"),
            (7, [float("nan"), 1.0, 1.0], 1, "a"), (8, [float("inf"), 1.0, 1.0], 1, "a"), (9, [1.0, 2.0], 1, "a"),
            (10, [-3.0, 0.5, 0.0], 1, "a")]
    got, *_ = check_whitening(spark, rows)
    assert {r.vec_id for r in got} == {1, None, 3, 10}


def test_whitening_without_variance_or_rows(spark):
    schema = "vec_id long, embedding array<float>"
    assert whitening.whiten(spark.createDataFrame([], schema)).count() == 0
    same = spark.createDataFrame([(i, [1.0, 2.0]) for i in range(3)], schema)
    assert whitening.whiten(same).columns == [
        "vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    assert whitening.whiten(same).count() == 0


def test_deviations_stay_exact_beyond_64_bits():
    x = np.array([[1 << 50, 5], [-(1 << 50), 7], [3, 1 << 40]], np.int64)
    n, sums = 3, tuple(int(c) for c in x.sum(0))
    assert whitening.deviations(x, n, sums) == [
        sum((n * a - s) ** 2 for a, s in zip(row, sums, strict=True)) for row in x.tolist()]


@pytest.mark.parametrize("size, rank", [(1, 1), (2, 2), (7, 4), (33, 33)])
def test_cholesky_and_jacobi(size, rank):
    rng = np.random.default_rng(size)
    a = rng.normal(size=(200, rank)) @ rng.normal(size=(rank, size))
    covariance = a.T @ a
    factor = whitening.pivoted_cholesky(covariance)
    assert factor.shape == (size, rank)
    values, vectors = whitening.jacobi(factor)
    scale = values[0]
    assert np.abs(values - np.linalg.eigvalsh(covariance)[::-1][:rank]).max() < 1e-11 * scale
    assert np.abs(covariance @ vectors - vectors * values).max() < 1e-11 * scale
    assert np.abs(vectors.T @ vectors - np.eye(rank)).max() < 1e-13


# --- decontamination -----------------------------------------------------------------

_WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def brute_search(texts, items, k):
    """(n_words, hit words, items) of each text, by comparing words."""
    windows: dict[tuple, set] = {}
    for item, text in items:
        w = _WORD.findall(lowered(text))
        size = min(k, len(w))
        for s in range(len(w) - size + 1 if size else 0):
            windows.setdefault(tuple(w[s:s + size]), set()).add(item)
    out = []
    for text in texts:
        w, hit, found = _WORD.findall(lowered(text)), set(), set()
        for size in {len(x) for x in windows}:
            for s in range(len(w) - size + 1):
                if tuple(w[s:s + size]) in windows:
                    hit |= set(range(s, s + size))
                    found |= windows[tuple(w[s:s + size])] - {None}
        out.append((len(w), sorted(hit), sorted(found)))
    return out


def made(rng, words, n):
    return "".join(rng.choice(words) + rng.choice([" ", "  ", ". ", "-", "\n", "\t,"]) for _ in range(n))


def test_window_search_equals_brute_force(monkeypatch):
    rng = random.Random(11)
    for _ in range(120):
        words = rng.choice([["a", "b"], ["a", "bb", "CCC", "Ünï", "漢字", "x1"], [f"word{i}" for i in range(30)]])
        texts = [made(rng, words, rng.choice([0, 1, 5, 20, 60])) for _ in range(6)] + [None, "", "..."]
        items = [(rng.choice([None, "1", "2", "30"]), made(rng, words, rng.choice([0, 1, 2, 3, 4, 9, 12])))
                 for _ in range(rng.choice([0, 1, 4]))]
        k = rng.choice([2, 3, 10])
        monkeypatch.setattr(decontamination, "STRETCH", rng.choice([1, 7, 2048]))
        monkeypatch.setattr(decontamination, "PAIRS", rng.choice([1, 1 << 20]))
        spaced = decontamination.Spaced(*tk.buffers(pa.array(texts, pa.string())))
        windows = decontamination.Windows([i for i, _ in items], [t for _, t in items], k)
        starts, ends, named = windows.search(spaced)
        got = []
        for t in range(len(texts)):
            first, last = spaced.first[t], spaced.first[t + 1]
            hit = [int(w - first) for s, e in zip(starts, ends, strict=True) if first <= s < last for w in range(s, e)]
            got.append((int(last - first), hit, sorted(named[t])))
        assert got == brute_search(texts, items, k)


@pytest.mark.parametrize("block_bytes", [8 << 20, 1])
def test_decontamination_query(spark, block_bytes):
    """Odd rows, and blocks of one item each: their hits add up."""
    rng = random.Random(5)
    words = [f"w{i}" for i in range(40)]
    items = [(i, made(rng, words, 14)) for i in range(4)] + [(4, "Only Three words"), (5, None), (6, "  "), (None, made(rng, words, 11))]
    items += [items[0], (7, items[1][1])]
    texts = [None, "", "only three words", made(rng, words, 3) + items[0][1].upper() + items[1][1]]
    texts += [" ".join(_WORD.findall(items[-3][1])), made(rng, words, 300) + items[2][1] + made(rng, words, 300)]
    docs = spark.createDataFrame([(i % 4, t, "x", 1) for i, t in enumerate(texts)], "doc_id long, text string, hits string, n_words int")
    bench = spark.createDataFrame(items, "item_id long, text string")
    found = decontamination.search(docs, bench, block_bytes=block_bytes)
    got = sorted(tuple(r) for r in decontamination.digest(found).collect())
    brute = brute_search(texts, [(None if i is None else str(i), t) for i, t in items], 10)
    assert got == sorted((i % 4, n, len(hit), len(named), sha256(",".join(named).encode()).hexdigest(), bool(hit))
                         for i, (n, hit, named) in enumerate(brute))


def test_decontamination_of_empty_tables(spark):
    docs = spark.createDataFrame([(1, "a b c")], "doc_id long, text string")
    bench = spark.createDataFrame([], "item_id string, text string")
    rows = decontamination.digest(decontamination.search(docs, bench)).collect()
    assert [(r.n_words, r.n_hit, r.n_items, r.contaminated) for r in rows] == [(3, 0, 0, False)]
    assert decontamination.search(docs.limit(0), bench).count() == 0


# --- collocations ---------------------------------------------------------------------

def counts_of(texts, langs):
    out: Counter = Counter()
    for text, lang in zip(texts, langs, strict=True):
        for piece in re.split(r"[.,;:!?\x0a-\x0d]", lowered(text)):
            w = re.findall(r"[^ \t]+", piece)
            for k in (1, 2, 3, 4):
                for i in range(len(w) - k + 1):
                    out["und" if lang is None else lang, tuple(w[i:i + k])] += 1
    return out


def brute_collocations(texts, langs, least, top):
    f = counts_of(texts, langs)
    n = Counter()
    for (lang, w), a in f.items():
        n[lang] += a if len(w) == 1 else 0
    candidates = {x: a for x, a in f.items() if len(x[1]) > 1 and a >= least}
    holder: Counter = Counter()
    for (lang, w), a in candidates.items():
        for m in range(2, len(w)):
            for i in range(len(w) - m + 1):
                holder[lang, w[i:i + m]] = max(holder[lang, w[i:i + m]], a)
    rows = []
    for (lang, w), a in candidates.items():
        if holder[lang, w] and 100 * holder[lang, w] >= 80 * a:
            continue
        score, cut = min((2000000 * a // (f[lang, w[:c]] + f[lang, w[c:]]), c) for c in range(1, len(w)))
        rows.append((lang, " ".join(w), a, f[lang, w[:cut]], f[lang, w[cut:]], n[lang], score))
    out = []
    for lang in n:
        own = sorted((r for r in rows if r[0] == lang), key=lambda r: (-r[6], -r[2], r[1].encode()))
        out += [(r[0], i, *r[1:]) for i, r in enumerate(own[:top], 1)]
    return sorted(out)


def _unpacked(blocks):
    """(block and rest, count) of every fingerprint."""
    keys, counts = [], []
    for row in blocks.to_pylist():
        keys += [(row["block"], int(h)) for h in np.frombuffer(row["rest"], "<u4")]
        counts += np.frombuffer(row["n"], "<i4").tolist()
    return keys, counts


class Everything:
    """A filter that lets all pass."""
    value = property(lambda self: self)

    def has(self, h):
        return np.ones(len(h), bool)


def test_shards_and_indexes_count_every_phrase(monkeypatch):
    rng = random.Random(3)
    for _ in range(120):
        words = rng.choice([["a", "b"], ["A", "bb", "ccc", "Ünï", "漢字", "en", "de"]])
        texts = ["".join(rng.choice(words) + rng.choice([" "] * 8 + ["  ", ". ", ",", "\n", "\t"])
                         for _ in range(rng.choice([0, 1, 5, 20, 60]))) for _ in range(8)] + [None, "", "...", "a.b"]
        langs = [rng.choice(["en", "de", None, ""]) for _ in texts]
        monkeypatch.setattr(tk, "CHUNK_BYTES", rng.choice([5, 50, 1 << 20]))
        cut = rng.choice([0, 6, 12])
        batches = [pa.RecordBatch.from_pydict({"lang": pa.array(langs[i:j], pa.string()), "text": pa.array(texts[i:j], pa.string())})
                   for i, j in ((0, cut), (cut, len(texts)))]
        shards = list(collocations._shard_batches(rng.choice([4, 7, 20, 1 << 22]))(iter(batches)))
        names, got = {}, Counter()
        for row in (b.to_pylist()[0] for b in shards):
            for h, word, n in zip(row["hashes"], row["words"], row["counts"], strict=True):
                names[h] = row["lang"], word
                got[row["lang"], (word,)] += n
        whole_batch = pa.Table.from_batches(shards).combine_chunks().to_batches() if shards else []
        bits = rng.choice([0, 3])
        for blocks in collocations._phrases(Everything(), Everything(), bits)(iter(whole_batch)):
            for block in blocks.to_pylist():
                one = {k: pa.chunked_array([pa.array([v])]) for k, v in block.items()}
                for row in collocations._whole(-1 << 40)(pa.table(one)).to_pylist():
                    n = row.pop("f")
                    spelled = [names[h] for h in row.values() if h is not None]
                    got[spelled[0][0], tuple(w for _, w in spelled)] += n
        expected = counts_of(texts, langs)
        assert {k: v for k, v in got.items() if v} == expected
        for make, lengths in ((collocations._pairs, {2}), (collocations._longer, {3, 4})):
            sums: Counter = Counter()
            for blocks in make(Everything(), bits)(iter(whole_batch)):
                for key, n in zip(*_unpacked(blocks), strict=True):
                    sums[key] += n
            assert sorted(n for n in sums.values() if n) == sorted(n for (_, w), n in expected.items() if len(w) in lengths)


@pytest.mark.parametrize("shard_words, filter_bits, top", [(1 << 22, 1 << 29, 2000), (40, 64, 5)])
def test_collocations_equal_brute_force(spark, monkeypatch, shard_words, filter_bits, top):
    """Small shards, filters that pass nearly everything, and ranks within slices change nothing."""
    monkeypatch.setattr(collocations, "RANKED", 7)
    rng = random.Random(9)
    words = ["the", "New", "York", "en", "es", "de", "of", "été"]
    texts = ["".join(rng.choices(words, [5, 2, 2, 1, 1, 1, 3, 1])[0] + rng.choice([" "] * 9 + [". ", "\n"])
                     for _ in range(rng.choice([3, 40, 200]))) for _ in range(60)]
    texts += ["one fixed phrase of words"] * 35 + [None, "", " \t", "x" * 5000]
    langs = [rng.choice(["en", "es", None]) for _ in texts]
    docs = spark.createDataFrame([(t, lang, 1, "k") for t, lang in zip(texts, langs, strict=True)], "text string, lang string, n int, key string")
    got = collocations.collocations(docs.repartition(3), top=top, shard_words=shard_words, filter_bits=filter_bits)
    assert got.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    assert sorted(tuple(r) for r in got.collect()) == brute_collocations(texts, langs, 30, top)


def test_collocations_of_empty_tables(spark):
    docs = spark.createDataFrame([], "text string, lang string")
    assert collocations.collocations(docs).count() == 0
    assert collocations.collocations(spark.createDataFrame([("a b", "en")], "text string, lang string")).count() == 0
