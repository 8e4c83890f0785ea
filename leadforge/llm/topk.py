"""Exact top-k search by Fagin's threshold algorithm.

Vectors are dealt into blocks; a cell holds one block of candidates and one
block of queries (the stated query set against all rows, in blocks).  In a
cell every dimension has a list of the candidates sorted by that component.
A query reads its lists in parallel, from the end that its component favours,
scores whatever it meets for the first time, and stops once the bound, its
product with the components last read, is below its kth best score: nothing
unread can beat or tie that.  The cells' answers merge to k rows a query.

Edge cases: vectors that are null, hold null or non-finite components, or
components beyond 64-bit integers take no part, nor do null ids; vectors meet
only vectors of their own length; equal rows count once; a candidate with the
query's own id is not an answer; equal scores rank by id; fewer candidates
than k give fewer rows; further columns of the input are ignored.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SCALE = 256
CANDIDATES, QUERIES = 8192, 4096  # rows of a block
FIRST_DEPTH = 8


def quantise(vectors: DataFrame, id_col: str, vector_col: str, scale: int = SCALE) -> DataFrame:
    """``vec_id, dim, vec``: floor(scale * x) as little-endian 64-bit integers."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ids, dims, vecs = [], [], []
            for i, v in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                if i is None or v is None or any(x is None for x in v):
                    continue
                x = np.floor(scale * np.array(v, dtype=np.float64))
                if np.isfinite(x).all() and (np.abs(x) < 2.0**62).all():
                    ids.append(i), dims.append(len(v)), vecs.append(x.astype("<i8").tobytes())
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(dims, pa.int32()), pa.array(vecs, pa.binary())],
                                             names=["vec_id", "dim", "vec"])

    return (vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).cast("array<double>").alias("vec"))
            .mapInArrow(run, "vec_id long, dim int, vec binary"))


class Lists:
    """The sorted per-dimension lists of one block of candidates."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray):
        self.ids, self.vectors = ids, vectors
        self.order = np.argsort(vectors, axis=0, kind="stable").astype(np.int32)  # ascending
        self.sorted = np.take_along_axis(vectors, self.order, axis=0)

    def search(self, query_id: int, query: np.ndarray, k: int) -> tuple[list[tuple[int, int]], int]:
        """([(id, score)] best first, rows scored)."""
        n = len(self.ids)
        unseen = self.ids != query_id
        dims = np.flatnonzero(query)
        q, up = query[dims], query[dims] < 0
        best_score, best_id = np.empty(0, self.vectors.dtype), np.empty(0, np.int64)
        depth, done, scored = FIRST_DEPTH, 0, 0
        while True:
            depth = min(depth, n)
            met = np.zeros(n, bool)
            if len(dims):
                met[self.order[done:depth, dims[up]]] = True
                met[self.order[n - depth:n - done, dims[~up]]] = True
            else:  # every score is 0: nothing to favour
                met[done:depth] = True
            met &= unseen
            unseen &= ~met
            new = np.flatnonzero(met)
            scored += len(new)
            # A product with the whole block is cheaper than picking many rows.
            fresh = self.vectors[new] @ query if 4 * len(new) < n else (self.vectors @ query)[new]
            score, ids = np.concatenate([best_score, fresh]), np.concatenate([best_id, self.ids[new]])
            if len(score) > 8 * k:  # the k best and all that tie with the last
                able = np.flatnonzero(score >= np.partition(score, len(score) - k)[len(score) - k])
                score, ids = score[able], ids[able]
            top = np.lexsort((ids, -score))[:k]
            best_score, best_id = score[top], ids[top]
            if depth == n or not unseen.any():
                break
            if len(dims) and len(top) == k:
                last = np.where(up, self.sorted[depth - 1, dims], self.sorted[n - depth, dims])
                if (q * last).sum() < best_score[-1]:
                    break
            done, depth = depth, depth * 2
        return list(zip(best_id.tolist(), map(int, best_score.tolist()))), scored


def exact_type(peak: int, dim: int) -> type:
    """The fastest type in which products of such vectors are exact."""
    most = peak * peak * max(dim, 1)
    return np.float32 if most < 1 << 24 else np.float64 if most < 1 << 53 else np.int64


def _cell(k: int):
    def run(group: pa.Table) -> pa.Table:
        ids, queries = group.column("vec_id").to_numpy(), np.array(group.column("is_query").to_pylist(), dtype=bool)
        dim = group.column("dim")[0].as_py()
        vectors = np.frombuffer(b"".join(group.column("vec").to_pylist()), "<i8").reshape(len(ids), dim)
        vectors = vectors.astype(exact_type(int(np.abs(vectors).max(initial=0)), dim))
        out: list[tuple] = []
        if (~queries).any():
            lists = Lists(ids[~queries], vectors[~queries])
            for i, q in zip(ids[queries].tolist(), vectors[queries]):
                out += [(i, *pair) for pair in lists.search(i, q, k)[0]]
        cols = list(zip(*out)) or [[]] * 3
        return pa.table([pa.array(c, pa.int64()) for c in cols], names=["query_id", "vec_id", "score"])

    return run


def top_k(vectors: DataFrame, is_query: Column, k: int, id_col: str = "vec_id", vector_col: str = "embedding", scale: int = SCALE) -> DataFrame:
    """``query_id, rank, vec_id, score``: the k best of each query."""
    base = quantise(vectors, id_col, vector_col, scale).dropDuplicates().withColumn("is_query", is_query)
    n, m = base.agg(F.count("*"), F.count_if("is_query")).first()
    n_blocks, m_blocks = max(1, -(-n // CANDIDATES)), max(1, -(-m // QUERIES))
    block = F.xxhash64("vec_id", "vec")
    every = lambda many: F.explode(F.array(*(F.lit(i) for i in range(many))))
    candidates = (base.withColumn("block", F.pmod(block, F.lit(n_blocks)).cast("int")).withColumn("q_block", every(m_blocks))
                  .withColumn("is_query", F.lit(False)))
    queries = (base.filter("is_query").withColumn("block", every(n_blocks))
               .withColumn("q_block", F.pmod(block, F.lit(m_blocks)).cast("int")))
    found = (candidates.unionByName(queries).groupBy("dim", "block", "q_block")
             .applyInArrow(_cell(k), "query_id long, vec_id long, score long"))
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (found.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))
