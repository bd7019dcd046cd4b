"""Mixing to target weights with soft domain membership.

1. A classifier trained on the labelled table gives every text its posterior over the
   domains: naive Bayes scores of its words beside shape features, combined by a
   softmax layer.  It is fitted in numpy on about ``LABELLED`` texts at most, of at
   most ``TRAIN_CHARS`` characters (the bound of the fit).
2. Nonnegative rates r, one per document, are fitted so that the expected domain
   totals ``sum_d r_d * tokens_d * p_d`` match the targets, by projected-gradient
   least squares with residuals whitened by the domains' second moments.  A step is

       r_d <- clip(r_d - p_d . y_i, 0, max_rate),   y_i = (G + eps)^-1 (totals - targets) / T

   The driver holds only the steps ``y_i``, one short vector each.  A pass
   is one aggregation that replays the steps on each row, so nothing is rewritten
   between passes and a lost executor loses no state.  Rates are the replay's result.

Tokens are words ``[^\\x20\\x09-\\x0D]+``.  A null or wordless text has no tokens and
does not count towards the totals; its rate follows from its posterior like any
other.  Rows are kept one to one.  Labels of repeated ids count once, as the smallest
domain name.  A domain without labelled texts has posterior 0; without labels all
posteriors are equal.  Infeasible targets are met as nearly as possible.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlens.llm import textkit as tk
from ledgerlens.llm.common import hash_fraction, lean, stored

ROWS = 1 << 16
LABELLED = 4000
TRAIN_CHARS = 20_000
PASSES = 40
TOLERANCE = 1e-4

_SYMBOL = np.zeros(256, bool)
_SYMBOL[list(b"#*$%&|<>!@=_~^\\/")] = True
_UPPER = np.zeros(256, bool)
_UPPER[65:91] = True
_DIGIT = np.zeros(256, bool)
_DIGIT[48:58] = True
SHAPES = 8


@dataclass
class Classifier:
    domains: list[str]
    words: np.ndarray    # ROWS x domains, log-likelihoods
    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray  # features and bias x domains

    def posteriors(self, features: np.ndarray) -> np.ndarray:
        z = np.column_stack([(features - self.mean) / self.scale, np.ones(len(features))]) @ self.weights
        p = np.exp(z - z.max(axis=1, keepdims=True))
        return p / p.sum(axis=1, keepdims=True)


def _rows(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    return tk.hashes(data, starts, ends, fold=True)


def _features(data: np.ndarray, offsets: np.ndarray, words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(tokens, features) of each text: shape features and mean word scores."""
    starts, ends, first = tk.words(data, offsets)
    h = _rows(data, starts, ends)
    n = np.diff(first)
    some, size = np.maximum(n, 1), np.maximum(np.diff(offsets), 1)

    def share(table: np.ndarray) -> np.ndarray:
        total = np.concatenate([[0], np.cumsum(table[data])])
        return (total[offsets[1:]] - total[offsets[:-1]]) / size

    distinct = np.array([len(np.unique(h[a:b])) for a, b in zip(first[:-1], first[1:])])
    length = np.concatenate([[0], np.cumsum(ends - starts)])
    high = np.arange(256) >= 128
    columns = [np.log1p(n), distinct / some, np.log1p(length[first[1:]] - length[first[:-1]]) - np.log1p(n),
               share(_SYMBOL), share(_UPPER), share(_DIGIT), share(high), share(np.arange(256) == 10)]
    total = np.concatenate([np.zeros((1, words.shape[1])), np.cumsum(words[(h % np.uint64(ROWS)).astype(np.int64)], axis=0)])
    scores = (total[first[1:]] - total[first[:-1]]) / some[:, None]
    return n, np.column_stack(columns + [scores])


def train(texts: list[str], domains_of: list[str], domains: list[str]) -> Classifier:
    k = len(domains)
    number = {d: i for i, d in enumerate(domains)}
    y = np.array([number[d] for d in domains_of], int)
    data, offsets = tk.buffers(pa.array(texts, pa.large_string()))
    half = np.arange(len(y)) % 2 == 0  # word scores from one half, the layer from the other
    counts = np.full((ROWS, k), 0.5)
    parts = [(i, j, data[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i]) for i, j in tk.chunks(offsets)]
    for i, j, part, at in parts:
        starts, ends, first = tk.words(part, at)
        label = np.repeat(np.where(half[i:j], y[i:j], -1), np.diff(first))
        rows = (_rows(part, starts, ends) % np.uint64(ROWS)).astype(np.int64)[label >= 0]
        counts += np.bincount(rows * k + label[label >= 0], minlength=ROWS * k).reshape(ROWS, k)
    words = np.log(counts / counts.sum(axis=0))
    words -= words.mean(axis=1, keepdims=True)
    if len(y) == 0:
        return Classifier(domains, words * 0, np.zeros(SHAPES + k), np.ones(SHAPES + k), np.zeros((SHAPES + k + 1, k)))
    x = np.concatenate([_features(part, at, words)[1] for _, _, part, at in parts])
    use = ~half if len(set(y[~half])) == len(set(y)) else np.ones(len(y), bool)
    mean, scale = x[use].mean(axis=0), x[use].std(axis=0) + 1e-6
    design = np.column_stack([(x[use] - mean) / scale, np.ones(use.sum())])
    target, w, speed = np.eye(k)[y[use]], np.zeros((x.shape[1] + 1, k)), 0.0
    w[-1, ~target.any(axis=0)] = -30.0  # never seen
    seen = target.any(axis=0)
    for _ in range(600):
        z = design @ w
        p = np.exp(z - z.max(axis=1, keepdims=True))
        p /= p.sum(axis=1, keepdims=True)
        speed = 0.9 * speed - 0.3 * (design.T @ (p - target) / len(design) + 1e-4 * w) * seen
        w = w + speed
    return Classifier(domains, words, mean, scale, w)


def _posterior_batches(model: Classifier, carried: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = tk.buffers(batch.column("_text"))
            for i, j in tk.chunks(offsets):
                tokens, x = _features(data[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i], model.words)
                p = model.posteriors(x)
                lists = pa.ListArray.from_arrays(pa.array(np.arange(0, p.size + 1, p.shape[1]), pa.int32()), pa.array(p.ravel()))
                part = batch.slice(i, j - i)
                yield pa.RecordBatch.from_arrays([*(part.column(c) for c in carried), pa.array(tokens), lists],
                                                 [*carried, "tokens", "posterior"])
    return run


def fit(docs: DataFrame, labelled: DataFrame, domains: list[str]) -> Classifier:
    """``labelled`` is (doc_id, domain); rows of other domains are left out."""
    known = (labelled.select(F.col("doc_id").cast("long").alias("doc_id"), "domain").where(F.col("doc_id").isNotNull() & F.col("domain").isin(domains))
             .groupBy("doc_id").agg(F.min("domain").alias("domain")))
    n = known.count()
    chosen = F.broadcast(known.where(hash_fraction("doc_id", 2) < min(1.0, LABELLED / max(1, n))))  # about LABELLED short rows
    rows = (docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
            .where(F.length("text") <= TRAIN_CHARS).join(chosen, "doc_id")
            .groupBy("doc_id", "domain").agg(F.min("text").alias("text")).collect()) if n else []  # one text an id
    rows.sort(key=lambda r: (r.doc_id, r.text))
    return train([r.text for r in rows], [r.domain for r in rows], domains)


def _fraction(h: Column) -> Column:
    return F.pmod(h, F.lit(1 << 30)) / float(1 << 30)


def posteriors(docs: DataFrame, model: Classifier, carry: list[str]) -> DataFrame:
    """The columns ``carry`` of ``docs`` with tokens and posterior beside them."""
    carried = [c for c in carry if c not in ("tokens", "posterior", "rate", "copies", "_text", "_draw")]
    text = F.col("text").cast("string")
    draw = F.when(F.col("doc_id").isNull(), _fraction(F.xxhash64(text, F.lit(22)))).otherwise(hash_fraction("doc_id", 22))
    rows = docs.select(*carried, draw.alias("_draw"), text.alias("_text"))
    carried = [*carried, "_draw"]
    out = T.StructType([f for f in rows.schema if f.name in carried]
                       + [T.StructField("tokens", T.LongType()), T.StructField("posterior", T.ArrayType(T.DoubleType()))])
    return rows.mapInArrow(lean(_posterior_batches(model, carried)), out)


def rate_of(steps: list[list[float]], k: int, max_rate: float | None) -> Column:
    """The rate after the steps, replayed from rate 1 on the posterior."""
    if not steps:
        return F.lit(1.0)
    history = F.array(*(F.array(*map(F.lit, y)) for y in steps))

    def step(r: Column, y: Column) -> Column:
        move = sum((F.col("posterior")[i] * y[i] for i in range(1, k)), F.col("posterior")[0] * y[0])
        r = F.greatest(r - move, F.lit(0.0))
        return r if max_rate is None else F.least(r, F.lit(float(max_rate)))

    return F.aggregate(history, F.lit(1.0), step)


def fit_rates(members: DataFrame, targets: list[float], max_rate: float | None = None) -> list[list[float]]:
    """The steps of the projected gradient.  ``members`` (tokens, posterior) should be
    a written table; ``targets`` are token totals per domain."""
    k, b = len(targets), np.array(targets, float)
    p, t = [F.col("posterior")[i] for i in range(k)], F.col("tokens")
    moments = members.agg(F.coalesce(F.sum("tokens"), F.lit(0)).alias("t"), *(
        F.coalesce(F.sum(t * p[i] * p[j]), F.lit(0.0)).alias(f"g{i}_{j}") for i in range(k) for j in range(i, k))).first()
    total = float(moments["t"])
    if total == 0:
        return []
    g = np.array([[moments[f"g{min(i, j)}_{max(i, j)}"] for j in range(k)] for i in range(k)]) / total
    inverse = np.linalg.inv(g + 1e-6 * np.trace(g) * np.eye(k))
    steps: list[list[float]] = []
    for _ in range(PASSES):
        rate = rate_of(steps, k, max_rate)
        row = members.select(rate.alias("r"), "tokens", "posterior").agg(
            *(F.sum(F.col("r") * t * p[i]).alias(f"s{i}") for i in range(k))).first()
        residual = (np.array([row[f"s{i}"] for i in range(k)]) - b) / total
        y = inverse @ residual
        if np.abs(residual).max() < TOLERANCE or (steps and np.abs(y - np.array(steps[-1])).max() < 1e-7 and np.abs(y).max() < 1e-5):
            break
        steps.append([float(v) for v in y])
    return steps


def mix(docs: DataFrame, labelled: DataFrame, weights: dict[str, float], total: float | None = None,
        anchor: str | None = None, max_rate: float | None = None, carry: list[str] | None = None) -> DataFrame:
    """One row per document: doc_id (or the columns ``carry``), tokens, posterior, rate
    and copies; carried columns with these names give way.

    ``weights`` gives each domain's share of the tokens.  The totals are these
    shares of ``total`` (all tokens by default), or of the number that keeps the
    expected tokens of domain ``anchor`` as they are.  ``copies`` rounds the rate
    at random by a hash of doc_id, or of the text where that is null, so that its
    expectation is the rate; rows of one id share their draw.  An id that labels
    several texts gives the classifier the smallest.
    """
    domains = sorted(weights)
    members = stored(posteriors(docs, fit(docs, labelled, domains), carry or ["doc_id"]), "posteriors")
    share = np.array([weights[d] for d in domains]) / sum(weights.values())
    if total is None:
        at = domains.index(anchor) if anchor else None
        expected = F.sum("tokens") if at is None else F.sum(F.col("tokens") * F.col("posterior")[at]) / float(share[at])
        total = float(members.agg(F.coalesce(expected.cast("double"), F.lit(0.0)).alias("t")).first()["t"])
    steps = fit_rates(members, list(share * total), max_rate)
    rated = members.withColumn("rate", rate_of(steps, len(domains), max_rate))
    whole = F.floor("rate")
    extra = F.when(F.col("_draw") < F.col("rate") - whole, 1).otherwise(0)
    return rated.withColumn("copies", (whole + extra).cast("long")).drop("_draw")
