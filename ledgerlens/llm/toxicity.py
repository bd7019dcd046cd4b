"""Toxicity by a bidirectional gated recurrent network with attention pooling.

A word's input is a hashed word vector beside the mean of its hashed character
n-gram vectors (bytes of the lower-cased word with end marks).  A forward and a
backward gated recurrent layer read a window of ``WINDOW`` words; attention weights
their states into one vector, which gives the window's logit.  All windows of a text
are scored, each overlapping the next by ``WINDOW - STRIDE`` words, and a logistic
layer over the highest logit, the mean of the three highest and the number of windows
gives the text's score.

Training is numpy on the driver, on at most about ``PER_CLASS`` labelled texts of
each class of at most ``TRAIN_CHARS`` characters (the bound of the fit): first on
random windows with their text's label, then on the windows that score highest
(multiple instances).  A quarter of the texts, unseen by the network, fits the
logistic layer at the labels' true shares.

Scoring is a map over whole texts; a chunk's distinct words get their inputs once.
A null or wordless text has no windows and scores the share of toxic labels, which
is below 0.5 or set so.  Without labels of both classes every score is that share.
Null labels are left out; repeated label ids count once, as the larger value.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlens.llm import textkit as tk
from ledgerlens.llm.common import hash_fraction, lean

WINDOW = 32
STRIDE = 24
WORD_ROWS = 1 << 14
CHAR_ROWS = 1 << 14
WORD_SIZE = 8
CHAR_SIZE = 16
HIDDEN = 8
PER_CLASS = 1500
TRAIN_CHARS = 12_000
FOLDS = 5
CHUNK = 2 << 20
WORD_BLOCK = 8192
BATCH = 4096
MINIBATCH = 128
EPOCH_WINDOWS = 6000


# --- inputs --------------------------------------------------------------------------

@dataclass
class Words:
    """A chunk's distinct words: hashed rows, and n-gram rows with each word's first."""
    word: np.ndarray
    gram: np.ndarray
    first: np.ndarray


def _grams(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashed 3- and 4-grams of ``<word>``, grouped by word."""
    size = ends - starts + 2
    first = np.concatenate([[0], np.cumsum(size)])
    place = np.arange(first[-1]) - np.repeat(first[:-1], size)
    source = np.repeat(starts, size) + place - 1
    padded = tk.FOLD[data[np.clip(source, 0, max(0, len(data) - 1))]].astype(np.uint64)
    padded[first[:-1]] = 1
    padded[first[1:] - 1] = 2
    left = np.repeat(size, size) - place  # bytes from here to the word's end
    code = padded.copy()
    rows, owners = [], []
    word = np.repeat(np.arange(len(size)), size)
    for n in range(2, 5):
        code[:len(code) - n + 1] = code[:len(code) - n + 1] * np.uint64(1 << 8) + padded[n - 1:]
        if n >= 3:
            ok = np.flatnonzero(left >= n)
            rows.append(tk.mix(code[ok] + np.uint64(n << 40)) % np.uint64(CHAR_ROWS))
            owners.append(word[ok])
    row, owner = np.concatenate(rows), np.concatenate(owners)
    order = np.argsort(owner, kind="stable")
    return row[order].astype(np.int32), np.searchsorted(owner[order], np.arange(len(size) + 1))


def split(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(starts, ends, hashes, first) of all words, walked in small chunks."""
    parts = [[], [], [], [np.zeros(1, np.int64)]]
    total = 0
    for i, j in tk.chunks(offsets):
        part = data[offsets[i]:offsets[j]]
        starts, ends, first = tk.words(part, offsets[i:j + 1] - offsets[i])
        for kept, new in zip(parts, (starts + offsets[i], ends + offsets[i], tk.hashes(part, starts, ends, fold=True), first[1:] + total)):
            kept.append(new)
        total += len(starts)
    return tuple(np.concatenate(kept) if kept else np.zeros(0, np.int64) for kept in parts)


def distinct_words(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, h: np.ndarray) -> tuple[Words, np.ndarray]:
    """The distinct lower-cased words, and each word's number."""
    distinct, at, back = np.unique(h, return_index=True, return_inverse=True)
    grams, firsts, total = [np.zeros(0, np.int32)], [np.zeros(1, np.int64)], 0
    for i in range(0, len(at), WORD_BLOCK):
        gram, first = _grams(data, starts[at[i:i + WORD_BLOCK]], ends[at[i:i + WORD_BLOCK]])
        grams.append(gram)
        firsts.append(first[1:] + total)
        total += len(gram)
    return Words((distinct % np.uint64(WORD_ROWS)).astype(np.int64), np.concatenate(grams), np.concatenate(firsts)), back


def windows(n_words: int) -> np.ndarray:
    """Starts of the windows that cover ``n_words`` words, each overlapping the next."""
    if n_words == 0:
        return np.zeros(0, np.int64)
    return np.arange(max(1, -(-(n_words - WINDOW) // STRIDE) + 1)) * STRIDE


def window_index(back: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(windows x WINDOW word numbers, -1 beyond the text; the window's text)."""
    starts, owners, limits = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    for d in range(len(first) - 1):
        w = windows(int(first[d + 1] - first[d]))
        starts.append(w + first[d])
        owners.append(np.full(len(w), d))
        limits.append(np.full(len(w), first[d + 1]))
    at = np.concatenate(starts).astype(np.int32)[:, None] + np.arange(WINDOW, dtype=np.int32)
    inside = at < np.concatenate(limits)[:, None]
    index = np.where(inside, back[np.minimum(at, max(0, len(back) - 1))] if len(back) else 0, -1)
    return index.astype(np.int32), np.concatenate(owners)


# --- the network -----------------------------------------------------------------------

def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * np.tanh(0.5 * x) + 0.5


class Network:
    """Parameters and passes; ``p`` maps names to float32 arrays."""

    def __init__(self, seed: int = 7):
        rng = np.random.default_rng(seed)
        size, h = WORD_SIZE + CHAR_SIZE, HIDDEN

        def normal(*shape, scale):
            return (rng.standard_normal(shape) * scale).astype(np.float32)

        self.p = {"word": normal(WORD_ROWS, WORD_SIZE, scale=0.1), "char": normal(CHAR_ROWS, CHAR_SIZE, scale=0.3),
                  "attend": normal(2 * h, scale=0.3), "out": normal(2 * h, scale=0.3), "bias": np.zeros(1, np.float32)}
        for side in "fb":
            self.p[f"wx{side}"] = normal(size, 3 * h, scale=size ** -0.5)
            self.p[f"wh{side}"] = normal(h, 3 * h, scale=h ** -0.5)
            self.p[f"b{side}"] = np.zeros(3 * h, np.float32)

    def inputs(self, words: Words, keep_word: np.ndarray | None = None) -> np.ndarray:
        """One row per distinct word, and a last row of zeros for padding."""
        x = np.zeros((len(words.word) + 1, WORD_SIZE + CHAR_SIZE), np.float32)
        x[:-1, :WORD_SIZE] = self.p["word"][words.word]
        if keep_word is not None:
            x[:-1, :WORD_SIZE] *= keep_word[:, None]
        for i in range(0, len(words.word), WORD_BLOCK):
            first = words.first[i:i + WORD_BLOCK + 1]
            total = np.add.reduceat(self.p["char"][words.gram[first[0]:first[-1]]], first[:-1] - first[0], axis=0)
            x[i:i + len(first) - 1, WORD_SIZE:] = total / np.diff(first)[:, None]
        return x

    def forward(self, x: np.ndarray, index: np.ndarray, keep: bool = False):
        """Window logits; with ``keep`` also what the backward pass needs."""
        b, t, h = len(index), index.shape[1], HIDDEN
        mask = (index >= 0).astype(np.float32)
        states = np.zeros((t, b, 2 * h), np.float32)
        tape = {}
        for s, side in enumerate("fb"):
            projected = x @ self.p[f"wx{side}"] + self.p[f"b{side}"]
            wh, state = self.p[f"wh{side}"], np.zeros((b, h), np.float32)
            steps = []
            for i in (range(t) if side == "f" else range(t - 1, -1, -1)):
                inp, rec = projected[index[:, i]], state @ wh
                zr = _sigmoid(inp[:, :2 * h] + rec[:, :2 * h])
                z, r = zr[:, :h], zr[:, h:]
                n = np.tanh(inp[:, 2 * h:] + r * rec[:, 2 * h:])
                new = (n + z * (state - n)) * mask[:, i:i + 1]
                if keep:
                    steps.append((i, state, z, r, n, rec[:, 2 * h:]))
                state = new
                states[i, :, s * h:(s + 1) * h] = new
            tape[side] = steps
        energy = states @ self.p["attend"] + (mask.T - 1) * 1e9
        a = np.exp(energy - energy.max(axis=0))
        a /= a.sum(axis=0)
        pooled = np.einsum("tb,tbh->bh", a, states)
        logit = pooled @ self.p["out"] + self.p["bias"][0]
        return (logit, (x, index, mask, states, a, pooled, tape)) if keep else logit

    def backward(self, kept, d_logit: np.ndarray) -> tuple[dict[str, np.ndarray], np.ndarray]:
        """Gradients of the dense parameters and of the input rows."""
        x, index, mask, states, a, pooled, tape = kept
        h, g = HIDDEN, {}
        g["out"], g["bias"] = pooled.T @ d_logit, d_logit.sum(keepdims=True)
        d_pooled = d_logit[:, None] * self.p["out"]
        d_a = np.einsum("bh,tbh->tb", d_pooled, states)
        d_energy = a * (d_a - (a * d_a).sum(axis=0))
        g["attend"] = np.einsum("tb,tbh->h", d_energy, states)
        d_states = a[:, :, None] * d_pooled + d_energy[:, :, None] * self.p["attend"]
        d_x = np.zeros_like(x)
        order = np.argsort(index.T.ravel(), kind="stable")  # every use of an input row, together
        used = index.T.ravel()[order]
        first = np.flatnonzero(np.concatenate([[True], used[1:] != used[:-1]]))
        for s, side in enumerate("fb"):
            wh = self.p[f"wh{side}"]
            d_in = np.zeros((index.shape[1], len(index), 3 * h), x.dtype)
            d_wh, carry = np.zeros_like(wh), np.zeros((len(index), h), np.float32)
            for i, state, z, r, n, rec_n in reversed(tape[side]):
                d = (carry + d_states[i, :, s * h:(s + 1) * h]) * mask[:, i:i + 1]
                d_n = d * (1 - z) * (1 - n * n)
                d_z = d * (state - n) * z * (1 - z)
                d_r = d_n * rec_n * r * (1 - r)
                d_rec = np.concatenate([d_z, d_r, d_n * r], axis=1)
                d_in[i, :, :h], d_in[i, :, h:2 * h], d_in[i, :, 2 * h:] = d_z, d_r, d_n
                d_wh += state.T @ d_rec
                carry = d * z + d_rec @ wh.T
            d_projected = np.zeros((len(x), 3 * h), x.dtype)
            d_projected[used[first]] = np.add.reduceat(d_in.reshape(-1, 3 * h)[order], first, axis=0)
            d_projected[-1] = 0
            g[f"wh{side}"], g[f"wx{side}"], g[f"b{side}"] = d_wh, x.T @ d_projected, d_projected.sum(axis=0)
            d_x += d_projected @ self.p[f"wx{side}"].T
        return g, d_x


class Adam:
    def __init__(self, p: dict[str, np.ndarray], rate: float):
        self.p, self.rate, self.t = p, rate, 0
        self.m = {k: np.zeros_like(v) for k, v in p.items()}
        self.v = {k: np.zeros_like(v) for k, v in p.items()}

    def step(self, grads: dict[str, np.ndarray | tuple[np.ndarray, np.ndarray]]) -> None:
        """Dense gradients, or (rows, gradients of those rows)."""
        self.t += 1
        scale = self.rate * np.sqrt(1 - 0.999 ** self.t) / (1 - 0.9 ** self.t)
        for k, g in grads.items():
            rows, g = g if isinstance(g, tuple) else (slice(None), g)
            m, v = 0.9 * self.m[k][rows] + 0.1 * g, 0.999 * self.v[k][rows] + 0.001 * g * g
            self.m[k][rows], self.v[k][rows] = m, v
            self.p[k][rows] -= (scale * m / (np.sqrt(v) + 1e-8)).astype(np.float32)


def _sum_rows(rows: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct rows and the sums of their values."""
    order = np.argsort(rows, kind="stable")
    ordered = rows[order]
    first = np.flatnonzero(np.concatenate([[True], ordered[1:] != ordered[:-1]]))
    return ordered[first], np.add.reduceat(values[order], first, axis=0).astype(np.float32)


def _train_windows(net: Network, adam: Adam, words: Words, index: np.ndarray, labels: np.ndarray, rng) -> None:
    order = rng.permutation(len(index))
    for at in range(0, len(order), MINIBATCH):
        part = order[at:at + MINIBATCH]
        used, back = np.unique(index[part], return_inverse=True)
        if used[0] == -1:
            used, shift = used[1:], 1
        else:
            shift = 0
        local = back.reshape(index[part].shape) - shift  # -1 is padding again
        counts = np.diff(words.first)[used]
        gram_at = np.repeat(words.first[used] - np.concatenate([[0], np.cumsum(counts)[:-1]]), counts) + np.arange(counts.sum())
        batch = Words(words.word[used], words.gram[gram_at], np.concatenate([[0], np.cumsum(counts)]))
        keep = (rng.random(len(used)) < 0.7).astype(np.float32)  # so that characters alone must do
        x = net.inputs(batch, keep)
        logit, kept = net.forward(x, local, keep=True)
        d = (_sigmoid(logit) - labels[part]).astype(np.float32) / len(part)
        grads, d_x = net.backward(kept, d)
        word_grad = _sum_rows(batch.word, d_x[:-1, :WORD_SIZE] * keep[:, None])
        gram_grad = _sum_rows(batch.gram, np.repeat(d_x[:-1, WORD_SIZE:] / counts[:, None], counts, axis=0))
        adam.step(grads | {"word": word_grad, "char": gram_grad})


def _logits(net: Network, words: Words, index: np.ndarray) -> np.ndarray:
    x = net.inputs(words)
    return np.concatenate([np.zeros(0, np.float32)] + [net.forward(x, index[i:i + BATCH]) for i in range(0, len(index), BATCH)])


def _text_features(logits: np.ndarray, owner: np.ndarray, n: int) -> np.ndarray:
    """Highest logit, mean of the three highest, log number of windows; NaN without windows."""
    out = np.full((n, 3), np.nan)
    order = np.lexsort((-logits, owner))
    bounds = np.searchsorted(owner[order], np.arange(n + 1))
    ranked = logits[order].astype(np.float64)
    for d in np.flatnonzero(np.diff(bounds)):
        mine = ranked[bounds[d]:bounds[d + 1]]
        out[d] = mine[0], mine[:3].mean(), np.log(len(mine))
    return out


@dataclass
class Model:
    network: Network | None
    weights: np.ndarray  # of the logistic layer: highest, top three, log windows, bias
    share: float         # of toxic labels

    def score(self, f: np.ndarray) -> np.ndarray:
        with np.errstate(over="ignore"):
            p = 1 / (1 + np.exp(-(f @ self.weights[:3] + self.weights[3])))
        return np.where(np.isnan(f[:, 0]), min(self.share, 0.49), p)


def _logistic(f: np.ndarray, y: np.ndarray, weight: np.ndarray) -> np.ndarray:
    x, w = np.column_stack([f, np.ones(len(f))]), np.zeros(4)
    ridge = np.diag([0.02, 0.02, 0.02, 1e-4]) * weight.sum() * 0.05
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        hessian = x.T @ (x * (weight * np.maximum(p * (1 - p), 1e-4))[:, None]) + ridge
        w = w - np.linalg.solve(hessian, x.T @ (weight * (p - y)) + ridge @ w)
    return w


def train(texts: list[str], labels: list[int], share: float | None = None, seed: int = 11) -> Model:
    """Fits the network and the logistic layer; ``share`` is the true share of label 1."""
    y = np.array(labels, float)
    share = float(y.mean() if len(y) else 0.0) if share is None else share
    if len(set(labels)) < 2:
        return Model(None, np.zeros(4), share)
    data, offsets = tk.buffers(pa.array(texts, pa.large_string()))
    starts, ends, h, first = split(data, offsets)
    words, back = distinct_words(data, starts, ends, h)
    index, owner = window_index(back, first)
    rng = np.random.default_rng(seed)
    held = rng.random(len(y)) < 0.25
    if len(set(y[~held])) < 2 or len(set(y[held])) < 2:
        held[:] = False
    fit = ~held[owner]
    net = Network(seed)
    adam = Adam(net.p, 0.01)
    window_label = y[owner]
    for epoch in range(8):
        draw = rng.random(len(index))
        if epoch >= 3:  # by score: the highest of each text, and of texts of label 0 one more at random
            draw = -_logits(net, words, index)
        order = np.lexsort((draw, owner))
        rank = np.empty(len(index), np.int64)
        bounds = np.searchsorted(owner[order], np.arange(len(y) + 1))
        rank[order] = np.arange(len(order)) - np.repeat(bounds[:-1], np.diff(bounds))
        take = fit & (rank < (4 if epoch < 3 else np.where(window_label > 0, 1, 2)))
        if epoch >= 3:
            take |= fit & (window_label == 0) & (rng.random(len(index)) < 0.08)
        if epoch == 5:
            adam.rate = 0.003
        for _ in range(-(-EPOCH_WINDOWS // max(1, int(take.sum())))):  # few texts: the same windows more often
            _train_windows(net, adam, words, index[take], window_label[take], rng)
    use = held if held.any() else ~held
    f = _text_features(_logits(net, words, index), owner, len(y))
    use &= ~np.isnan(f[:, 0])
    weight = np.where(y[use] > 0, share / max(1, y[use].sum()), (1 - share) / max(1, (1 - y[use]).sum())) * use.sum()
    return Model(net, _logistic(f[use], y[use], weight), share)


# --- the jobs ----------------------------------------------------------------------------

def _score_chunk(model: Model, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    starts, ends, h, first = split(data, offsets)
    n = len(offsets) - 1
    if model.network is None or not len(starts):
        return model.score(np.full((n, 3), np.nan))
    words, back = distinct_words(data, starts, ends, h)
    index, owner = window_index(back, first)
    return model.score(_text_features(_logits(model.network, words, index), owner, n))


def _score_batches(model: Model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = tk.buffers(batch.column("text"))
            scores = [_score_chunk(model, data[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i]) for i, j in tk.chunks(offsets, CHUNK)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(np.concatenate([np.zeros(0), *scores]))], ["doc_id", "score"])
    return run


def clean(docs: DataFrame, model: Model) -> DataFrame:
    """The rows of ``docs`` that score below 0.5, all columns as they were."""
    docs = docs.withColumn("text", F.col("text").cast("string"))
    at = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = tk.buffers(batch.column(at))
            scores = [_score_chunk(model, data[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i]) for i, j in tk.chunks(offsets, CHUNK)]
            yield batch.filter(pa.array(np.concatenate([np.zeros(0), *scores]) < 0.5))

    return docs.mapInArrow(lean(run), docs.schema)


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string")) % FOLDS == 0, F.lit(False))


def fit(docs: DataFrame, labels: DataFrame) -> Model:
    """Trains on a bounded sample of the labelled texts outside the held-out fold."""
    known = (labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("toxic"))
             .where("doc_id IS NOT NULL AND toxic IN (0, 1)").where(~held_out(F.col("doc_id")))
             .groupBy("doc_id").agg(F.max("toxic").alias("toxic")))
    counts = {r.toxic: r["count"] for r in known.groupBy("toxic").count().collect()}
    total = sum(counts.values())
    if not total:
        return Model(None, np.zeros(4), 0.0)
    share = F.when(F.col("toxic") == 1, min(1.0, PER_CLASS / max(1, counts.get(1, 0)))).otherwise(min(1.0, PER_CLASS / max(1, counts.get(0, 0))))
    chosen = F.broadcast(known.where(hash_fraction("doc_id", 6) < share))  # about 2 * PER_CLASS rows of two numbers
    rows = (docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
            .where(F.length("text") <= TRAIN_CHARS).join(chosen, "doc_id").collect())
    rows.sort(key=lambda r: (r.doc_id, r.text))
    return train([r.text for r in rows], [r.toxic for r in rows], counts.get(1, 0) / total)


def scores(docs: DataFrame, model: Model) -> DataFrame:
    """One row per document: doc_id, held_out, score, predicted."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(
        _score_batches(model), "doc_id long, score double").select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    return scores(docs, fit(docs, labels))
