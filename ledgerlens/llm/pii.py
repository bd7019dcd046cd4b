"""Personal data by a skip-chain conditional random field.

Base patterns give ``email``, ``ip``, ``card`` and ``phone`` spans; they are
evidence that inference never overrules.  The nodes of a document's field are its
tokens with a digit or an ``@``; the labels are the four kinds and *other*.

* Each node has a potential from the token's shape (lengths, signs, separators).
* Neighbouring tokens share a chain potential.
* Tokens with the same last seven digits, or shorter ones of the same text, share a
  skip potential, however distant they are.  Where some of them lie in base spans, the
  others are linked to one hub with those labels, so every repeat is as near to the
  evidence as the first; else each is linked to the one before.  Edges are linear in
  the occurrences.

Loopy max-free sum-product message passing, until the messages settle, then spreads
labels over each document, so that a repeat of a confirmed entity is labelled like it although it
fails the pattern.  A node outside the base spans is reported where its kind is
likelier than ``REPORT``; neighbours of one kind are joined.

The potentials are fitted piecewise (each factor on its own) on the base labels of
at most about ``SAMPLE`` documents that hold candidates.  Everything else is a map
over whole texts.  A null or empty text has no spans; rows are kept one to one.
Without training documents the potentials are neutral and only base spans are given.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlens.llm import textkit as tk
from ledgerlens.llm.common import hash_fraction, lean

KINDS = ("email", "ip", "card", "phone")
LABELS = KINDS + ("other",)
OTHER = len(KINDS)
SAMPLE = 2000
SAMPLE_CHARS = 20_000
REPORT = 0.9
ROUNDS = 200  # at most; messages settle earlier
SETTLED = 1e-7

_MAIL_RIGHT = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_MAIL_LEFT = re.compile(r"[A-Za-z0-9._%+-]*\Z")
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_TOKEN = re.compile(r"[^\x20\x09-\x0D]+")
_EVIDENCE = re.compile(r"[0-9@]")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        v = ord(d) - 48
        total += v if i % 2 == 0 else (2 * v - 9 if v > 4 else 2 * v)
    return total % 10 == 0


def _digits(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def base_spans(text: str) -> list[tuple[int, str, int]]:
    found, done, at = [], 0, text.find("@")
    while at >= 0:  # from each @ outwards: linear, unlike a search from every start
        start = at
        while start > done and text[start - 1] in _LOCAL:
            start -= 1
        right = _MAIL_RIGHT.match(text, at + 1) if start < at else None
        if right:
            found.append((start, "email", right.end()))
            done = right.end()
        else:
            done = max(done, at + 1)
        at = text.find("@", max(at + 1, done))
    for m in _IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or "0") <= 255 for p in m[0].split(".")):
            found.append((m.start(), "ip", m.end()))
    for m in _CARD.finditer(text):
        d = _digits(m[0])
        if 14 <= len(d) <= 19 and luhn(d):
            found.append((m.start(), "card", m.end()))
    for m in _PHONE.finditer(text):
        if 10 <= len(_digits(m[0])) <= 15:
            found.append((m.start(), "phone", m.end()))
    return found


def joined(spans: list[tuple[int, str, int]]) -> str:
    ordered = sorted(spans, key=lambda s: (s[0], KINDS.index(s[1]), s[2]))
    return ",".join(f"{kind}:{start}:{end}" for start, kind, end in ordered)


# --- the field -----------------------------------------------------------------------

_STRIP = ".,;:!?\"'()[]{}<>|#*$%&"


@dataclass
class Field:
    """Nodes and edges of one document."""
    start: np.ndarray
    end: np.ndarray
    feature: np.ndarray  # nodes x features
    label: np.ndarray    # of the base spans; OTHER outside
    chain: np.ndarray    # edges x 2
    skip: np.ndarray     # edges x 2, each occurrence and the one before
    repeats: list[list[int]]  # the occurrences of every repeated key


def _shape(token: str) -> list[float]:
    digits = len(_digits(token))
    n = len(token)
    return [1.0, digits / 20, float(digits == 0), float(1 <= digits <= 3), float(digits == 4), float(5 <= digits <= 8),
            float(9 <= digits <= 13), float(14 <= digits <= 19), float(digits > 19), digits / n, float("@" in token),
            float(token.count(".") == 3), float("." in token), float("-" in token), float(token[0] == "+"),
            float("(" in token), float(token.isdigit()), float(any(c.isalpha() for c in token)), min(n, 40) / 40]


def field_of(text: str, base: list[tuple[int, str, int]]) -> Field | None:
    tokens = [(m.start(), m.end()) for m in _TOKEN.finditer(text) if _EVIDENCE.search(m[0])]
    if not tokens:
        return None
    start, end = np.array(tokens).T
    label = np.full(len(tokens), OTHER)
    for s, kind, e in base:
        label[(start < e) & (end > s)] = KINDS.index(kind)
    chain, skip, last, repeats = [], [], {}, {}
    for i, (s, e) in enumerate(tokens):
        if i and s - tokens[i - 1][1] == 1:
            chain.append((i - 1, i))
        token = text[s:e]
        digits = _digits(token)
        keys = [("text", token.strip(_STRIP).lower())] + ([("tail", digits[-7:])] if len(digits) >= 7 else [])
        for p in dict.fromkeys(last[k] for k in keys if k in last):
            skip.append((p, i))
        last.update((k, i) for k in keys)
        repeats.setdefault(keys[-1], []).append(i)  # equal texts have equal tails
    return Field(start, end, np.array([_shape(text[s:e]) for s, e in tokens]), label,
                 np.array(chain, int).reshape(-1, 2), np.array(skip, int).reshape(-1, 2),
                 [r for r in repeats.values() if len(r) > 1])


@dataclass
class Model:
    weights: np.ndarray  # features x labels
    chain: np.ndarray    # labels x labels, log potentials
    skip: np.ndarray


def train(texts: list[str], epochs: int = 200) -> Model:
    """Piecewise fit: a softmax over shapes, and pairwise log-odds over the edges."""
    k = len(LABELS)
    fields = [f for f in (field_of(t, base_spans(t)) for t in texts) if f is not None]
    if not fields:
        return Model(np.zeros((len(_shape("0")), k)), np.zeros((k, k)), np.zeros((k, k)))
    x = np.concatenate([f.feature for f in fields])
    y = np.eye(k)[np.concatenate([f.label for f in fields])]
    w, speed = np.zeros((x.shape[1], k)), np.zeros((x.shape[1], k))
    for _ in range(epochs):
        p = np.exp((z := x @ w) - z.max(axis=1, keepdims=True))
        p /= p.sum(axis=1, keepdims=True)
        speed = 0.9 * speed - 2.0 * (x.T @ (p - y) / len(x) + 1e-4 * w)
        w = w + speed
    pairs = []
    for name in ("chain", "skip"):
        counts = np.full((k, k), 0.1) + np.eye(k)
        for f in fields:
            np.add.at(counts, tuple(f.label[getattr(f, name)].T), 1)
        counts += counts.T
        share = counts / counts.sum()
        side = share.sum(axis=1)
        pairs.append(np.clip(np.log(share / np.outer(side, side)), -3, 3))
    return Model(w, *pairs)


def marginals(field: Field, model: Model) -> np.ndarray:
    """Label marginals by damped loopy sum-product; nodes in base spans are clamped."""
    k, n = len(LABELS), len(field.start)
    unary = field.feature @ model.weights
    unary -= unary.max(axis=1, keepdims=True)
    known = field.label != OTHER
    unary[known] = np.where(np.eye(k, dtype=bool)[field.label[known]], 0.0, -30.0)
    skip, hubs = [], []
    for members in field.repeats:
        labels = field.label[members]
        labels = labels[labels != OTHER]
        if len(members) == 2 or not len(labels):
            skip += zip(members, members[1:])
            continue
        skip += [(i, n + len(hubs)) for i in members if not known[i]]
        hubs.append(np.where(np.isin(np.arange(k), labels), 0.0, -30.0))
    unary = np.concatenate([unary, np.array(hubs).reshape(-1, k)])
    edges = np.concatenate([field.chain, np.array(skip, int).reshape(-1, 2)])
    if len(edges):
        potential = np.concatenate([np.repeat(model.chain[None], len(field.chain), 0), np.repeat(model.skip[None], len(skip), 0)])
        source, target = np.concatenate([edges[:, 0], edges[:, 1]]), np.concatenate([edges[:, 1], edges[:, 0]])
        potential = np.concatenate([potential, potential.transpose(0, 2, 1)])
        reverse = np.concatenate([np.arange(len(edges)) + len(edges), np.arange(len(edges))])
        message = np.zeros((len(source), k))
        for _ in range(ROUNDS):
            belief = unary.copy()
            np.add.at(belief, target, message)
            out = (belief[source] - message[reverse])[:, :, None] + potential
            top = out.max(axis=1, keepdims=True)
            new = np.log(np.exp(out - top).sum(axis=1)) + top[:, 0]
            step = 0.5 * (new - new.max(axis=1, keepdims=True) - message)
            message += step
            if np.abs(step).max() < SETTLED:
                break
        np.add.at(unary, target, message)
    unary = unary[:n]
    p = np.exp(unary - unary.max(axis=1, keepdims=True))
    return p / p.sum(axis=1, keepdims=True)


def field_spans(text: str, base: list[tuple[int, str, int]], model: Model) -> list[tuple[int, str, int]]:
    """The spans that inference adds to the base spans."""
    field = field_of(text, base)
    if field is None or (field.label != OTHER).all():
        return []
    p = marginals(field, model)
    best = p.argmax(axis=1)
    spans: list[tuple[int, str, int]] = []
    previous = -2
    for i in np.flatnonzero((best != OTHER) & (field.label == OTHER) & (p.max(axis=1) >= REPORT)).tolist():
        token = text[field.start[i]:field.end[i]]
        start = int(field.start[i]) + len(token) - len(token.lstrip(".,;:!?\"'[]{}<>|#*$%&"))
        end = int(field.start[i]) + len(token.rstrip(".,;:!?\"'[]{}<>|#*$%&"))
        kind = KINDS[best[i]]
        if start >= end:
            continue
        if spans and previous == i - 1 and spans[-1][1] == kind and field.start[i] - field.end[previous] == 1:
            spans[-1] = (spans[-1][0], kind, end)
        else:
            spans.append((start, kind, end))
        previous = i
    return spans


def _candidates(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    at = np.flatnonzero((data == 64) | ((data >= 48) & (data <= 57)))
    before = np.searchsorted(at, offsets)
    return before[1:] > before[:-1]


def _scan_batches(model: Model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        nothing = hashlib.sha256(b"").hexdigest()
        for batch in batches:
            texts = batch.column("text")
            n = batch.num_rows
            counts = np.zeros((len(KINDS), n), np.int64)
            digests, spans, added = [nothing] * n, [""] * n, [0] * n
            data, offsets = tk.buffers(texts)
            for i, j in tk.chunks(offsets):
                hit = _candidates(data[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i])
                for r in (np.flatnonzero(hit) + i).tolist():
                    text = texts[r].as_py()
                    base = base_spans(text)
                    more = field_spans(text, base, model)
                    for x, kind in enumerate(KINDS):
                        counts[x, r] = sum(s[1] == kind for s in base)
                    digests[r] = hashlib.sha256(joined(base).encode()).hexdigest()
                    spans[r], added[r] = joined(base + more), len(more)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), *map(pa.array, counts), pa.array(digests, pa.string()),
                 pa.array(spans, pa.string()), pa.array(added, pa.int64())],
                ["doc_id", *(f"n_{k}" for k in KINDS), "base_sha256", "spans", "n_linked"])
    return run


def fit(docs: DataFrame) -> Model:
    """Potentials from a bounded sample of the documents that hold candidates; the
    sampled fraction follows from their count, the size bound from ``SAMPLE_CHARS``."""
    held = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).where(
        F.col("text").rlike("[0-9@]") & (F.length("text") <= SAMPLE_CHARS))
    n = held.count()
    if n == 0:
        return train([])
    sample = held.where(hash_fraction("doc_id", 10) < min(1.0, SAMPLE / n)).orderBy("doc_id", "text").limit(2 * SAMPLE)
    return train([r.text for r in sample.select("text").collect()])


def scan(docs: DataFrame, model: Model | None = None) -> DataFrame:
    """One row per document: counts and digest of the base spans, and all spans."""
    model = model or fit(docs)
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(
        _scan_batches(model), "doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, "
        "spans string, n_linked long")


def mask(text: str, model: Model) -> str:
    """The text with every span replaced by its kind; overlapping spans are one."""
    base = base_spans(text)
    out, done = [], 0
    for start, kind, end in sorted(base + field_spans(text, base, model), key=lambda s: (s[0], -s[2])):
        if start >= done:
            out += [text[done:start], f"<{kind.upper()}>"]
        done = max(done, end)
    return "".join(out) + text[done:]


def masked(docs: DataFrame, model: Model | None = None) -> DataFrame:
    """``docs`` with the personal data of ``text`` replaced; other columns as they were."""
    model = model or fit(docs)
    schema = docs.withColumn("text", F.col("text").cast("string")).schema
    at = schema.names.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = tk.buffers(batch.column(at))
            for i, j in tk.chunks(offsets):
                part = batch.slice(i, j - i)
                hit = np.flatnonzero(_candidates(data[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i])).tolist()
                if hit:
                    new = part.column(at).to_pylist()
                    for r in hit:
                        new[r] = mask(new[r], model)
                    part = part.set_column(at, part.schema.field(at), pa.array(new, part.schema.field(at).type))
                yield part

    return docs.withColumn("text", F.col("text").cast("string")).mapInArrow(lean(run), schema)
