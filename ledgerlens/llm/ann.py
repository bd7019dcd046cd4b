"""Approximate nearest neighbours by a permutation index.

* Up to ``PIVOTS`` pivots are taken from the valid vectors, in the order of a hash
  of vec_id (the bounded part of the index).
* Every valid vector is indexed: it is represented by its ``PREFIX`` nearest pivots
  in order.
* Rows are walked in blocks.  A block posts its rows in pivot inverted files
  (pivot -> rows and the pivot's place in each).  A query reads the files of its own
  pivots and adds up, for each row met, what a shared pivot takes off the footrule
  distance; a pivot outside a prefix counts as at place ``PREFIX``.
* The share ``RERANK`` of the block with the smallest footrule distance, ties
  included, is ranked again by the exact cosine on the original vectors.  The
  number of candidates grows with the rows; it is no fixed cap.
* The best of all blocks are merged per query.

The queries are a stated set; they go to the tasks in chunks of bounded bytes.
Scores are cosines in double precision; ties go to the smaller vec_id.

Defined results: vectors that are null, empty, zero, of another than the most
frequent dimension, or that hold null or non-finite components take no part; rows
without a vec_id neither.  Rows that share a query's vec_id are its own and are no
candidates; among repeated query ids one vector is searched.  With fewer
candidates than ``k``, all are returned; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerlens.llm.common import stored

PIVOTS = 256
PREFIX = 64
RERANK = 0.2
QUERY_BYTES = 16 << 20
BLOCK = 8192


def _valid(vector: Column) -> Column:
    return (F.size(vector) > 0) & F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) \
        & F.exists(vector, lambda x: x != 0)


def _matrix(column: pa.Array | pa.ChunkedArray) -> np.ndarray:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1)


def unit(x: np.ndarray) -> np.ndarray:
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def products(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """All inner products, each added up in one fixed order: rows of equal numbers get equal
    products wherever they lie (a matrix product's rounding depends on the place)."""
    return np.einsum("ij,kj->ik", np.ascontiguousarray(x), np.ascontiguousarray(y), optimize=False)


def prefixes(x: np.ndarray, pivots: np.ndarray, length: int) -> np.ndarray:
    """The nearest pivots of each unit vector, nearest first."""
    near = -products(x, pivots)
    top = np.argpartition(near, length - 1, axis=1)[:, :length] if length < len(pivots) else np.broadcast_to(np.arange(len(pivots)), near.shape)
    order = np.take_along_axis(near, top, axis=1).argsort(axis=1, kind="stable")
    return np.take_along_axis(top, order, axis=1)


class InvertedFiles:
    """The postings of one block: pivot -> (rows, places)."""

    def __init__(self, prefix: np.ndarray, pivots: int):
        self.rows, self.length = prefix.shape
        order = np.argsort(prefix.ravel(), kind="stable")
        bounds = np.searchsorted(prefix.ravel()[order], np.arange(pivots + 1))
        row, place = order // self.length, order % self.length
        self.lists = [(row[a:b], place[a:b]) for a, b in zip(bounds[:-1], bounds[1:])]

    def saving(self, query: np.ndarray) -> np.ndarray:
        """What shared pivots take off the largest footrule distance, halved."""
        total = np.zeros(self.rows, np.int64)
        for i, pivot in enumerate(query.tolist()):
            rows, places = self.lists[pivot]
            total[rows] += self.length - np.maximum(places, i)
        return total


def _search_batches(pivots: np.ndarray, length: int, query_ids: np.ndarray, queries: np.ndarray, k: int, share: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        query_prefix = prefixes(queries, pivots, length)
        for batch in batches:
            for at in range(0, batch.num_rows, BLOCK):
                block = batch.slice(at, BLOCK)
                ids = block.column("vec_id").to_numpy()
                x = unit(_matrix(block.column("vector")))
                files = InvertedFiles(_matrix(block.column("prefix")).astype(np.int64), len(pivots))
                out: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
                keep = min(len(ids), max(k + 1, int(np.ceil(share * len(ids)))))
                for q in range(len(query_ids)):
                    saving = files.saving(query_prefix[q])
                    near = np.flatnonzero(saving >= np.partition(saving, len(ids) - keep)[len(ids) - keep])
                    near = near[ids[near] != query_ids[q]]
                    score = products(x[near], queries[q:q + 1])[:, 0]
                    best = np.lexsort((ids[near], -score))[:k]
                    out.append((np.full(len(best), query_ids[q]), ids[near][best], score[best]))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate([o[c] for o in out])) for c in range(3)], ["query_id", "vec_id", "score"])
    return run


def _index_batches(pivots: np.ndarray, length: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, BLOCK):
                block = batch.slice(at, BLOCK)
                prefix = prefixes(unit(_matrix(block.column("vector"))), pivots, length).astype(np.int16)
                lists = pa.ListArray.from_arrays(pa.array(np.arange(0, prefix.size + 1, length), pa.int32()), pa.array(prefix.ravel()))
                yield pa.RecordBatch.from_arrays([block.column("vec_id"), block.column("vector"), lists], ["vec_id", "vector", "prefix"])
    return run


class PermutationIndex:
    """All valid rows with their pivot prefixes, as a written table."""

    def __init__(self, vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding"):
        rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).cast("array<double>").alias("vector"))
        rows = rows.where(F.col("vec_id").isNotNull() & _valid(F.col("vector")))
        sizes = rows.groupBy(F.size("vector").alias("n")).count().orderBy(F.desc("count"), "n").limit(1).collect()
        self.dimension = sizes[0].n if sizes else 0
        rows = rows.where(F.size("vector") == self.dimension)
        picked = rows.orderBy(F.xxhash64("vec_id"), "vec_id").limit(PIVOTS).toArrow()
        self.pivots = unit(_matrix(picked.column("vector"))) if picked.num_rows else np.zeros((0, 0))
        self.length = min(PREFIX, len(self.pivots))
        self.rows = rows if not self.length else stored(
            rows.mapInArrow(_index_batches(self.pivots, self.length), "vec_id long, vector array<double>, prefix array<smallint>"), "index")

    def search(self, is_query: Column, k: int = 5, share: float = RERANK) -> DataFrame:
        """The ``k`` nearest rows found for every row that ``is_query``: query_id, rank, vec_id, score."""
        spark = self.rows.sparkSession
        if not self.length:
            return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
        queries = self.rows.where(is_query).groupBy("vec_id").agg(F.min("vector").alias("vector"))
        queries = stored(queries, "queries")
        parts = max(1, -(-queries.count() * self.dimension * 8 // QUERY_BYTES))
        found = []
        for part in range(parts):
            chunk = queries.where(F.pmod(F.xxhash64("vec_id"), F.lit(parts)) == part).toArrow()
            if chunk.num_rows:
                found.append(self.rows.mapInArrow(
                    _search_batches(self.pivots, self.length, chunk.column("vec_id").to_numpy(), unit(_matrix(chunk.column("vector"))), k, share),
                    "query_id long, vec_id long, score double"))
        if not found:
            return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
        order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
        return (reduce(DataFrame.union, found).withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
                .select("query_id", "rank", "vec_id", "score"))
