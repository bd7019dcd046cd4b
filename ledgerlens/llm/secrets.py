"""Secret scan with structural confirmation.

Base patterns give ``assign``, ``access`` and ``hex`` spans.  On top of them,
candidates are decoded and reported only if their structure holds:

* ``jwt``: dotted base64url parts whose header is a JSON object with ``alg``;
* ``pem``: an armoured block whose label names a private key and whose body
  decodes to a key encoding, or, under ``Proc-Type: 4,ENCRYPTED``, to whole blocks of the
  cipher whose initial vector ``DEK-Info`` gives; line ends may be escaped;
* ``key``: a bare base64, base64url or hex run, on one line or wrapped over several (line
  ends may be escaped, hex bytes parted by colons), that decodes to a key encoding, i.e. DER
  whose nested lengths close exactly and whose fields are those of a private key
  (PKCS#1, PKCS#8, SEC 1), or an ``openssh-key-v1`` container whose length-prefixed
  fields end where the data end.

A map over whole texts; byte tables pick the texts that can hold anything, so
the patterns run only on those.  Spans are in code points, end exclusive.  A
null or empty text has no spans; rows are kept one to one, null ids included.
"""

from __future__ import annotations

import base64
import binascii
import hashlib
import json
import math
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlens.llm import textkit as tk

BASE_KINDS = ("assign", "access", "hex")
KINDS = BASE_KINDS + ("jwt", "pem", "key")

_ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
_HEX = re.compile(r"[0-9a-f]+")
_JWT = re.compile(r"(?<![A-Za-z0-9_-])[A-Za-z0-9_-]++(?:\.[A-Za-z0-9_-]*+){2,4}")
_PEM = re.compile(r"-----BEGIN ([A-Z0-9 ]+)-----(?:\s|\\[nr])*+((?:[A-Za-z-]++: [^\n\\]*+(?:\s|\\[nr])++)*+)"
                  r"((?:[A-Za-z0-9+/=\s]++|\\[nr])++)-----END \1-----")
_ENCRYPTED = re.compile(r"Proc-Type: 4,ENCRYPTED\b")
_VECTOR = re.compile(r"DEK-Info: [A-Z0-9-]+,((?:[0-9A-Fa-f]{16}){1,2})(?![0-9A-Fa-f])")
_BASE64_RUN = re.compile(r"[A-Za-z0-9+/]{40,}={0,2}")
_HEX_RUN = re.compile(r"[0-9A-Fa-f]{64,}")
# heads of keys: an ASN.1 sequence (0x30) or the name of the container, and what may follow on other lines
_HEAD64 = re.compile(r"(?:(?<![A-Za-z0-9+/_-])|(?<=\\n))(?:M[A-Za-z0-9+/_-]{15}|b3BlbnNzaC1rZXktdjEA)")
_HEAD16 = re.compile(r"(?:(?<![0-9A-Fa-f:])|(?<=\\n))(?:30(?::?[0-9A-Fa-f]{2}){11}|6[Ff]:?70:?65:?6[Ee]:?73:?73:?68)")
_LINE64, _LINE16 = re.compile(r"[A-Za-z0-9+/_-]+"), re.compile(r"(?:[0-9A-Fa-f]{2})+")
_BREAK64 = re.compile(r"[ \t]*(?:\r?\n|\r|(?:\\r)?\\n)[ \t]*")
_BREAK16 = re.compile(r":?[ \t]*(?:\r?\n|\r|(?:\\r)?\\n)[ \t]*|:")
_PADDING, _FOLLOWS = re.compile(r"={0,2}"), re.compile(r"[A-Za-z0-9+/]")
_JWT_HEAD = re.compile(r"(?<![A-Za-z0-9_-])e[wy][A-Za-z0-9_-]{8}")
# the words of the base pattern; a hint leaves the byte that the next one may begin with
_ASSIGN_HINT = re.compile(rb"password|passwd|secre(?=t)|token|api_?key")
_OTHER_HINT = re.compile(rb"AKI(?=A)|-----BEGIN |eyJ|e[wy](?=[A-Za-z0-9_-]{8})|M(?=[A-Za-z0-9+/_-]{15})|b3BlbnNzaC1rZXk|"
                         rb"30:?8(?=[1-4])|6[Ff]:?70:?65(?=:?6[Ee])")

_HEX_BYTE = np.zeros(256, bool)
_HEX_BYTE[list(b"0123456789abcdef")] = True
_BASE64_BYTE = np.zeros(256, bool)
_BASE64_BYTE[list(b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/")] = True


# --- key encodings -------------------------------------------------------------------

def _der_fields(data: bytes, start: int, end: int) -> list[tuple[int, int, int]] | None:
    """(tag, content start, content end) of the fields that fill [start, end) exactly."""
    fields = []
    while start < end:
        if end - start < 2:
            return None
        tag, size, at = data[start], data[start + 1], start + 2
        if size & 0x80:
            width = size & 0x7F
            if not 1 <= width <= 4 or at + width > end:
                return None
            size, at = int.from_bytes(data[at:at + width], "big"), at + width
            if size < 0x80:  # not the shortest form
                return None
        if at + size > end:
            return None
        fields.append((tag, at, at + size))
        start = at + size
    return fields


def is_der_key(data: bytes) -> bool:
    """A DER private key: one SEQUENCE whose nested lengths close exactly."""
    top = _der_fields(data, 0, len(data))
    if not top or len(top) != 1 or top[0][0] != 0x30:
        return False
    fields = _der_fields(data, top[0][1], top[0][2])
    if not fields:
        return False
    tags = [f[0] for f in fields]

    def names_algorithm(field) -> bool:
        inner = _der_fields(data, field[1], field[2])
        return bool(inner) and inner[0][0] == 0x06

    if tags[:2] == [0x30, 0x04] and len(tags) == 2:  # encrypted PKCS#8
        return names_algorithm(fields[0])
    if tags[0] != 0x02 or fields[0][2] - fields[0][1] != 1:
        return False
    if tags[1:3] == [0x30, 0x04]:  # PKCS#8
        return names_algorithm(fields[1])
    if tags[1:2] == [0x04] and data[fields[0][1]] == 1:  # SEC 1
        return fields[1][2] - fields[1][1] >= 20
    return len(tags) in (6, 9) and all(t == 0x02 for t in tags)  # DSA, PKCS#1


def _openssh_end(data: bytes) -> int:
    """Where the length-prefixed fields of an ``openssh-key-v1`` container end; 0 if it is none."""
    magic = b"openssh-key-v1\0"
    if not data.startswith(magic):
        return 0
    at, read = len(magic), 0

    def field() -> bool:
        nonlocal at
        if at + 4 > len(data):
            return False
        at += 4 + int.from_bytes(data[at:at + 4], "big")
        return at <= len(data)

    if not (field() and field() and field()) or at + 4 > len(data):
        return 0
    keys = int.from_bytes(data[at:at + 4], "big")
    at += 4
    while read < keys + 1:  # the public keys and the private section
        if not field():
            return 0
        read += 1
    return at if keys >= 1 else 0


def is_openssh_key(data: bytes) -> bool:
    """A container whose fields close exactly where the data end."""
    return 0 < _openssh_end(data) == len(data)


def _der_size(head: bytes) -> int:
    """The length that the head of a key states; 0 if it does not begin as a key does: a
    sequence whose first field is a version number or, for encrypted keys, a sequence."""
    if head[0] != 0x30:
        return 0
    size, at = head[1], 2
    if size & 0x80:
        at += size & 0x7F
        size = int.from_bytes(head[2:at], "big")
    first = head[at:at + 2]
    return at + size if len(first) == 2 and 2 < at <= 6 and (first == b"\x02\x01" or first[0] == 0x30) else 0


def _is_key(data: bytes) -> bool:
    return is_der_key(data) or is_openssh_key(data)


def _base64(text: str) -> bytes | None:
    try:
        return base64.b64decode(text + "=" * (-len(text) % 4), validate=True)
    except (binascii.Error, ValueError):
        return None


def _is_encrypted(headers: str, body: bytes) -> bool:
    """Whole blocks of the cipher that the armour's headers name."""
    vector = _VECTOR.search(headers)
    return bool(_ENCRYPTED.search(headers) and vector) and len(body) % (len(vector[1]) // 2) == 0


def is_signed_token(text: str) -> bool:
    header = _base64(text.split(".")[0].replace("-", "+").replace("_", "/"))
    try:
        value = json.loads(header) if header else None
    except (ValueError, RecursionError):
        return False
    return isinstance(value, dict) and isinstance(value.get("alg"), str)


# --- keys on one line or several --------------------------------------------------------

def _gather(text: str, at: int, line: re.Pattern, line_end: re.Pattern, need: int | None) -> tuple[str, int]:
    """``need`` characters of the lines from ``at`` on (all of them, if None) and where they
    end; with fewer, what there is."""
    parts, have = [], 0
    while True:
        m = line.match(text, at)
        if not m:
            return "".join(parts), at
        part = m[0] if need is None else m[0][:need - have]
        parts.append(part)
        have += len(part)
        stop = at + len(part)
        end = line_end.match(text, m.end())
        if have == need or not end or not line.match(text, end.end()):
            return "".join(parts), stop
        at = end.end()


def _unhex(text: str) -> bytes:
    return bytes.fromhex(text[:len(text) // 2 * 2])


def _unbase64(text: str) -> bytes:
    text = text if len(text) % 4 != 1 else text[:-1]
    return _base64(text.replace("-", "+").replace("_", "/")) or b""


def wrapped_keys(text: str) -> list[tuple[int, int]]:
    """[start, end) of the keys whose own lengths say where they end.  A head that does not
    begin as a key does is left at once, so texts of many heads stay linear."""
    found = []
    for head, line, line_end, decode, per_byte in (
            (_HEAD64, _LINE64, _BREAK64, _unbase64, 4 / 3), (_HEAD16, _LINE16, _BREAK16, _unhex, 2)):
        done = 0
        for m in head.finditer(text):
            if m.start() < done:
                continue
            size = _der_size(decode(m[0].replace(":", ""))) if m[0][0] in "M3" else None
            if size == 0:
                continue
            need = None if size is None else math.ceil(size * per_byte)
            body, end = _gather(text, m.start(), line, line_end, need)
            data = decode(body)
            if size is None:  # the container's end follows from its fields
                size = _openssh_end(data)
                need = math.ceil(size * per_byte)
                body, end = _gather(text, m.start(), line, line_end, need) if size else ("", end)
            if not size or len(body) != need or not _is_key(data[:size]):
                continue
            if per_byte != 2:
                end += len(_PADDING.match(text, end)[0][:-size % 3])
            if _FOLLOWS.match(text, end):
                continue
            found.append((m.start(), end))
            done = end
    return found


# --- spans ----------------------------------------------------------------------------

def base_spans(text: str) -> list[tuple[int, str, int]]:
    found = [(m.start(), "assign", m.end()) for m in _ASSIGN.finditer(text) if len(m[2]) >= 6]
    found += [(m.start(), "access", m.end()) for m in _ACCESS.finditer(text) if m.end() - m.start() >= 20]
    found += [(m.start(), "hex", m.end()) for m in _HEX.finditer(text) if m.end() - m.start() >= 24]
    return found


def structural_spans(text: str) -> list[tuple[int, str, int]]:
    found = []
    if "eyJ" in text or _JWT_HEAD.search(text):
        found += [(m.start(), "jwt", m.end()) for m in _JWT.finditer(text)
                  if ("eyJ" in m[0] or m[0].startswith(("ew", "ey"))) and is_signed_token(m[0])]
    if "-----BEGIN " in text:
        for m in _PEM.finditer(text):
            body = _base64("".join(m[3].replace("\\n", "").replace("\\r", "").split()))
            if body and "PRIVATE KEY" in m[1] and (_is_key(body) or _is_encrypted(m[2], body)):
                found.append((m.start(), "pem", m.end()))
    inside = [(s, e) for s, _, e in found]
    for pattern, decode in ((_HEX_RUN, lambda x: bytes.fromhex(x) if len(x) % 2 == 0 else None), (_BASE64_RUN, _base64)):
        for m in pattern.finditer(text):
            body = decode(m[0])
            if body and _is_key(body) and not any(s <= m.start() and m.end() <= e for s, e in inside):
                found.append((m.start(), "key", m.end()))
                inside.append((m.start(), m.end()))
    found += [(start, "key", end) for start, end in wrapped_keys(text) if not any(s < end and start < e for s, e in inside)]
    return found


def joined(spans: list[tuple[int, str, int]], kinds: tuple[str, ...]) -> str:
    ordered = sorted(spans, key=lambda s: (s[0], kinds.index(s[1]), s[2]))
    return ",".join(f"{kind}:{start}:{end}" for start, kind, end in ordered)


def _long_runs(data: np.ndarray, table: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
    """[start, end) of the runs of at least ``least`` bytes of ``table``."""
    inside = np.concatenate([[False], table[data], [False]])
    edges = np.flatnonzero(inside[1:] != inside[:-1])
    long = edges[1::2] - edges[0::2] >= least
    return edges[0::2][long], edges[1::2][long]


def _candidates(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Which texts can hold a span at all.  Runs and hints may cross from one text
    into the next; every text that such a run touches is looked at."""
    raw = data.tobytes()
    marks = np.zeros(len(offsets), np.int64)
    at = np.array([m.start() for m in _ASSIGN_HINT.finditer(raw.lower())]
                  + [m.start() for m in _OTHER_HINT.finditer(raw)], np.int64)
    for start, end in ((at, at + 1), _long_runs(data, _HEX_BYTE, 24), _long_runs(data, _BASE64_BYTE, 40)):
        np.add.at(marks, np.searchsorted(offsets, start, side="right") - 1, 1)
        np.add.at(marks, np.searchsorted(offsets, end, side="left"), -1)
    return np.cumsum(marks)[:-1] > 0


def _scan_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    nothing = hashlib.sha256(b"").hexdigest()
    for batch in batches:
        texts = batch.column("text")
        n = batch.num_rows
        counts = np.zeros((3, n), np.int64)
        digests, spans, added = [nothing] * n, [""] * n, [0] * n
        data, offsets = tk.buffers(texts)
        for i, j in tk.chunks(offsets):
            hit = _candidates(data[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i])
            for r in (np.flatnonzero(hit) + i).tolist():
                text = texts[r].as_py() or ""
                base, more = base_spans(text), structural_spans(text)
                for x, kind in enumerate(BASE_KINDS):
                    counts[x, r] = sum(s[1] == kind for s in base)
                digests[r] = hashlib.sha256(joined(base, KINDS).encode()).hexdigest()
                spans[r], added[r] = joined(base + more, KINDS), len(more)
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), *map(pa.array, counts), pa.array(digests, pa.string()), pa.array(spans, pa.string()),
             pa.array(added, pa.int64())],
            ["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans", "n_structural"])


def scan(docs: DataFrame) -> DataFrame:
    """One row per document: counts and digest of the base spans, and all spans."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(
        _scan_batches, "doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, spans string, n_structural long")
