"""Near-duplicate classes by min-max hashing.

Each text is the set of its word shingles.  One permutation of the shingle
fingerprints yields two signature values, its minimum and its maximum, so a
signature of ``2 * PERMUTATIONS`` values costs ``PERMUTATIONS`` hash
evaluations.  Both extremes agree with probability equal to the Jaccard
similarity, so the agreement rate stays unbiased; being negatively correlated
within a permutation, the pair has a lower variance than two minima.

A band holds the extremes of two permutations (4 values).  With 32 bands a pair
of similarity 0.8 shares none with probability (1 - 0.8**4)**32 < 5e-8.

Plan, with no group gathered in one task and no cap on partners:

1. ``fingerprints``: one map pass gives (doc_id, n_shingles, set fingerprint,
   band keys).  Texts with equal sets form a class; only classes are banded.
2. Bands are counted with partial aggregation; each member of a shared band is
   compared with the band's smallest member (a star, linear in the band).
3. Candidates are confirmed on their full shingle sets.  Confirmed links
   are closed into components by min-label propagation with pointer jumping.
4. In bands whose members still lie in different components, all pairs that
   cross components are compared on samples of their sets, in pairs of blocks;
   those that may link are confirmed too, so a link that a star missed is kept.

Defined results: a null or wordless text is linked with nothing and is its own
component.  Rows that repeat a doc_id are one document.  A null doc_id takes no
part in links across texts; its component is that of the equal texts, if any,
else null, and it is kept only in the latter case.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlens.llm import textkit as tk
from ledgerlens.llm.common import lean, stored

PERMUTATIONS = 64
#: Bytes of text that a task turns into shingles at once (a longer text by itself).
READ_BYTES = 1 << 18
PER_BAND = 2
BANDS = PERMUTATIONS // PER_BAND
BLOCK = 1024
SKETCH = 512
_XOR = tk.mix(np.arange(1, PERMUTATIONS + 1, dtype=np.uint64) * np.uint64(0xC2B2AE3D27D4EB4F))
_MULTIPLY = tk.mix(_XOR) | np.uint64(1)
_BAND_PLACE = tk.mix(np.arange(1, 2 * PER_BAND + 1, dtype=np.uint64)) | np.uint64(1)
_BAND_SALT = tk.mix(np.arange(1, BANDS + 1, dtype=np.uint64))


def signature(shingle_set: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(minima, maxima) of the set under every permutation."""
    low = np.full(PERMUTATIONS, np.iinfo(np.uint64).max, np.uint64)
    high = np.zeros(PERMUTATIONS, np.uint64)
    for i in range(0, len(shingle_set), 4096):  # a long text in pieces: bounded memory
        x = (shingle_set[None, i:i + 4096] ^ _XOR[:, None]) * _MULTIPLY[:, None]
        np.minimum(low, x.min(axis=1), out=low)
        np.maximum(high, x.max(axis=1), out=high)
    return low, high


def band_keys(low: np.ndarray, high: np.ndarray) -> np.ndarray:
    values = np.stack([low, high], axis=-1).reshape(BANDS, 2 * PER_BAND)
    return tk.mix((values * _BAND_PLACE[None, :]).sum(axis=1, dtype=np.uint64) ^ _BAND_SALT).view(np.int64)


def _sets(texts, k: int) -> Iterator[np.ndarray]:
    """The sorted shingle fingerprints of every text."""
    data, offsets = tk.buffers(texts)
    for i, j in tk.chunks(offsets, READ_BYTES):
        part, at = data[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i]
        starts, ends, first = tk.words(part, at)
        h = tk.hashes(part, starts, ends, fold=True)
        for d in range(j - i):
            yield np.unique(tk.shingles(h[first[d]:first[d + 1]], k))


def _fingerprint_batches(k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, prints, bands = [], [], []
            for s in _sets(batch.column("text"), k):
                n.append(len(s))
                if len(s):
                    prints.append(hashlib.blake2b(s.tobytes(), digest_size=16).digest())
                    bands.append(band_keys(*signature(s)))
                else:
                    prints.append(None)
                    bands.append(None)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(n, pa.int64()), pa.array(prints, pa.binary()),
                 pa.array(bands, pa.list_(pa.int64()))],
                ["doc_id", "n_shingles", "print", "bands"])
    return run


def fingerprints(docs: DataFrame, k: int) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(
        lean(_fingerprint_batches(k)), "doc_id long, n_shingles long, print binary, bands array<bigint>")


def _confirm_batches(k: int, percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ok = np.zeros(batch.num_rows, bool)
            for r, (a, b) in enumerate(zip(_sets(batch.column("text_a"), k), _sets(batch.column("text_b"), k))):
                common = len(np.intersect1d(a, b, assume_unique=True))
                ok[r] = len(a) > 0 and 100 * common >= percent * (len(a) + len(b) - common)
            yield pa.RecordBatch.from_arrays(
                [batch.column("a").filter(pa.array(ok)), batch.column("b").filter(pa.array(ok))], ["a", "b"])
    return run


def confirm(pairs: DataFrame, texts: DataFrame, k: int, percent: int) -> DataFrame:
    """The pairs (a, b) whose full shingle sets reach the threshold."""
    left = texts.select(F.col("doc_id").alias("a"), F.col("text").alias("text_a"))
    right = texts.select(F.col("doc_id").alias("b"), F.col("text").alias("text_b"))
    return (pairs.join(left, "a").join(right, "b").select("a", "b", "text_a", "text_b")
            .mapInArrow(lean(_confirm_batches(k, percent)), "a long, b long"))


def components(links: DataFrame) -> DataFrame:
    """(node, label): the smallest node reachable over the links, for every node
    that has one.  Hook-and-jump: labels move along links, then each label is
    replaced by its own label, so the number of rounds grows with the logarithm
    of the diameter.  Every round is a written table."""
    both = stored(links.select("a", "b").union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
                  .where("a <> b").distinct(), "links")
    labels = stored(both.groupBy(F.col("a").alias("node"))
                    .agg(F.least(F.min("b"), F.first("a")).alias("label")), "labels")
    while True:
        near = (both.join(labels.withColumnRenamed("node", "b"), "b")
                .groupBy(F.col("a").alias("node")).agg(F.min("label").alias("near")))
        hooked = (labels.join(near, "node", "left")
                  .select("node", F.col("label").alias("old"), F.least("label", "near").alias("label")))
        # the smallest label offered to any member of a component moves its whole star
        root = hooked.groupBy(F.col("old").alias("root")).agg(F.min("label").alias("best"))
        moved = (hooked.join(root, F.col("old") == F.col("root"), "left")
                 .select("node", "old", F.least("label", "best").alias("label")))
        jump = moved.select(F.col("node").alias("label"), F.col("label").alias("next"))
        new = stored(moved.join(jump, "label", "left")
                     .select("node", F.least("label", F.coalesce("next", "label")).alias("label"),
                             (F.least("label", F.coalesce("next", "label")) != F.col("old")).alias("changed")), "labels")
        changed = new.where("changed").limit(1).count()
        labels = new.select("node", "label")
        if not changed:
            return labels


def _sketch_batches(k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            size, keys, sketch, lowest = [], [], [], []
            for s in _sets(batch.column("text"), k):
                size.append(len(s))
                low, high = signature(s)
                keys.append(band_keys(low, high).tobytes())
                sketch.append((np.stack([low, high], axis=-1) >> np.uint64(48)).astype(np.uint16).tobytes())
                lowest.append(np.sort(s >> np.uint64(32))[:SKETCH].astype(np.uint32).tobytes())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(size, pa.int64()), pa.array(keys, pa.binary()), pa.array(sketch, pa.binary()),
                 pa.array(lowest, pa.binary())],
                ["node", "size", "keys", "sketch", "lowest"])
    return run


def _may_link(a: np.ndarray, size_a: int, b: np.ndarray, size_b: int, percent: int) -> bool:
    """Whether two bottom-k samples allow the threshold: exact for sets that fit
    in the sample, else six standard deviations below it."""
    common = len(np.intersect1d(a, b))
    if max(size_a, size_b) <= SKETCH:
        return 100 * common >= percent * (size_a + size_b - common)
    both = np.union1d(a, b)[:SKETCH]
    share = len(np.intersect1d(np.intersect1d(a, b), both)) / len(both)
    return share >= percent / 100 - 6 * np.sqrt(percent / 100 * (1 - percent / 100) / len(both))


def _block_links(percent: int):
    """All pairs of one block pair of one band: those of different components whose
    first shared band is this one and whose samples allow the threshold.  Bands are
    compared by their full keys: the cut signature values of long texts, crowded at
    both ends, agree by chance and serve the similarity bound alone."""
    slack = percent / 100 - 6 * np.sqrt(percent / 100 * (1 - percent / 100) / (2 * PERMUTATIONS))

    def run(table: pa.Table) -> pa.Table:
        node, label, size, side, band = (table.column(c).to_numpy() for c in ("node", "label", "size", "side", "band"))
        sketch = np.frombuffer(b"".join(table.column("sketch").to_pylist()), np.uint16).reshape(len(node), 2 * PERMUTATIONS)
        keys = np.frombuffer(b"".join(table.column("keys").to_pylist()), np.int64).reshape(len(node), BANDS)
        lowest = [np.frombuffer(x, np.uint32) for x in table.column("lowest").to_pylist()]
        i, j = table.column("i")[0].as_py(), table.column("j")[0].as_py()
        position, left, right = int(band[0]), np.flatnonzero(side == i), np.flatnonzero(side == j)
        found_a, found_b = [], []
        for u in left:
            v = right[(node[right] > node[u]) if i == j else (node[right] != node[u])]
            v = v[(label[v] != label[u]) & (100 * np.minimum(size[v], size[u]) >= percent * np.maximum(size[v], size[u]))]
            if not len(v):
                continue
            shared = keys[v] == keys[u]
            v = v[shared[:, position] & (shared.argmax(axis=1) == position)]
            for w in v[(sketch[v] == sketch[u]).mean(axis=1) >= slack]:
                if _may_link(lowest[u], size[u], lowest[w], size[w], percent):
                    found_a.append(min(node[u], node[w]))
                    found_b.append(max(node[u], node[w]))
        return pa.table({"a": pa.array(found_a, pa.int64()), "b": pa.array(found_b, pa.int64())})
    return run


def cross_component_pairs(open_bands: DataFrame, texts: DataFrame, k: int, percent: int) -> DataFrame:
    """Pairs (a < b) of one band but of different components that may link.

    The members of a band are dealt to blocks of about ``BLOCK``; each pair of
    blocks is one small group, so no band, however large, meets in one task,
    and only pairs that pass the samples leave it."""
    nodes = open_bands.select(F.col("node").alias("doc_id")).distinct()
    sketches = texts.join(nodes, "doc_id", "left_semi").mapInArrow(
        lean(_sketch_batches(k)), "node long, size long, keys binary, sketch binary, lowest binary")
    sketches = stored(sketches.dropDuplicates(["node", "size", "keys", "lowest"]), "sketches")
    rows = open_bands.withColumn("side", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
    rows = rows.select("*", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other"))
    rows = rows.select("key", "band", "node", "label", "side", F.least("side", "other").alias("i"), F.greatest("side", "other").alias("j"))
    return rows.join(sketches, "node").groupBy("key", "i", "j").applyInArrow(_block_links(percent), "a long, b long")


def near_duplicates(docs: DataFrame, k: int = 5, percent: int = 80) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_shingles, component_id, kept."""
    base = stored(fingerprints(docs, k), "fingerprints")
    classes = (base.where("print IS NOT NULL AND doc_id IS NOT NULL").groupBy("print")
               .agg(F.min("doc_id").alias("node"), F.first("bands").alias("bands")))
    nodes = stored(classes, "classes")
    posted = nodes.select(F.posexplode("bands").alias("band", "key"), "node")
    shared = posted.groupBy("key").agg(F.min("node").alias("pivot"), F.max("node").alias("last")).where("pivot <> last")
    crowd = stored(posted.join(shared.select("key", "pivot"), "key").select("key", "band", "pivot", "node"), "bands")

    star = crowd.where("node <> pivot").select(F.col("pivot").alias("a"), F.col("node").alias("b")).distinct()
    star = stored(star, "pairs")
    members = crowd.select(F.col("node").alias("doc_id")).distinct()
    texts = stored(docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
                   .join(members, "doc_id", "left_semi"), "texts")
    # rows that repeat a doc_id with different texts are one document
    alias = (base.where("print IS NOT NULL AND doc_id IS NOT NULL").select("print", "doc_id").distinct()
             .join(nodes.select("print", "node"), "print").where("doc_id <> node")
             .groupBy("doc_id").agg(F.min("node").alias("a"), F.max("node").alias("z")))
    same = alias.where("a <> z").select("a", F.col("z").alias("b"))
    own = alias.join(nodes.select(F.col("node").alias("doc_id")).distinct(), "doc_id").select("a", F.col("doc_id").alias("b"))
    links = stored(confirm(star, texts, k, percent).union(same).union(own), "confirmed")
    labels = components(links)

    labelled = crowd.join(labels, "node", "left").select("key", "band", "node", F.coalesce("label", "node").alias("label"))
    mixed = (labelled.groupBy("key").agg(F.min("label").alias("lo"), F.max("label").alias("hi"), F.count("*").alias("members"))
             .where("lo <> hi").select("key", F.ceil(F.col("members") / BLOCK).cast("int").alias("blocks")))
    open_bands = stored(labelled.join(mixed, "key"), "open")
    rest = stored(cross_component_pairs(open_bands, texts, k, percent).distinct().join(star, ["a", "b"], "left_anti"), "pairs")
    late = stored(confirm(rest, texts, k, percent), "confirmed")
    # written first, so that the join below holds no aggregate and a hot class can be split
    of_class = stored(nodes.join(labels, "node", "left").select("print", F.coalesce("label", "node").alias("component")), "components")
    if late.limit(1).count():  # they join whole components: close them over the labels alone
        at_a, at_b = (labels.select(F.col("node").alias(c), F.col("label").alias(f"label_{c}")) for c in "ab")
        between = late.join(at_a, "a", "left").join(at_b, "b", "left").select(
            F.coalesce("label_a", "a").alias("a"), F.coalesce("label_b", "b").alias("b"))
        joined = components(between).select(F.col("node").alias("component"), F.col("label").alias("whole"))
        of_class = stored(of_class.join(joined, "component", "left").select(
            "print", F.coalesce("whole", "component").alias("component")), "components")
    return (base.select("doc_id", "n_shingles", "print").join(of_class, "print", "left")
            .select("doc_id", "n_shingles",
                    F.coalesce("component", "doc_id").alias("component_id"),
                    F.coalesce(F.col("doc_id") == F.coalesce("component", "doc_id"),
                               F.col("component").isNull()).alias("kept")))
