"""Hard negatives by cover trees over norm-augmented vectors.

A candidate x gets one more component, sqrt(M^2 - |x|^2), with M the largest
norm of its block, and a query q gets 0: then q.x = (|q|^2 + M^2 - d^2) / 2 for
the distance d of the two, and nearest means largest inner product.  A block's
cover tree halves the covering radius level by level: a node's children are
further from each other than half its radius, and cover its points within that.
The distance of a query to a node's centre and the node's radius bound the
inner products of all points below from both sides.

A query descends best first.  It has windows (least and largest score, same or
other label, how many rows): a node is skipped when its bounds lie outside all
of them, or below the last row of those that are full.  Points of the leaves
reached are scored exactly, in integers.

Candidates are dealt into blocks; a block's tree is built once, stored, and
meets the queries in blocks (the stated query set against all rows).  The
blocks' answers merge by rank.

Edge cases: rows of null label, id or vector, of null or non-finite components
or components beyond 64-bit integers take no part (inner products have to fit
64 bits); vectors meet only vectors of their own length; equal rows count once;
rows of one id and different contents are anchors each, none is the other's
positive or negative; equal scores rank by id; fewer rows than asked for give
fewer, windows of negative positives are empty; an empty table gives no rows;
further columns of the input are ignored.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import stored
from .topk import SCALE, exact_type

CANDIDATES, QUERIES = 4096, 4096  # rows of a block
#: A node of so many points at most is a leaf.
LEAF = 16
FIRST_POPS = 8
#: Of |q|^2 + M^2, for the rounding of bounds (they are held in floats).
SLACK = 1e-9

POSITIVES, NEGATIVES, LOW, HIGH = 5, 3, 50, 95


@dataclass
class Spec:
    """What a query looks for: scores from ``least`` to ``most`` (None: any)."""

    least: int | None
    most: int | None
    same: bool
    k: int


NODES = ("centre", "radius", "child", "children", "point", "points")


class CoverTree:
    """``vectors`` (integers), ``ids`` and ``labels`` in leaf order; nodes in
    level order: ``centre`` (a row), ``radius``, the first of its children and
    their number, and for leaves the first of its points and their number."""

    def __init__(self, ids: np.ndarray, labels: np.ndarray, vectors: np.ndarray, nodes: dict[str, np.ndarray]):
        self.ids, self.labels, self.nodes = ids, labels, nodes
        peak = max((abs(int(vectors.max(initial=0))), abs(int(vectors.min(initial=0)))))
        self.vectors, self.ints = vectors.astype(exact_type(peak, vectors.shape[1])), vectors
        self.peak = peak
        x = vectors.astype(np.float64)
        self.m2 = float((x * x).sum(axis=1).max(initial=0))

    @classmethod
    def build(cls, ids: np.ndarray, labels: np.ndarray, vectors: np.ndarray, leaf: int = LEAF) -> CoverTree:
        x = vectors.astype(np.float64)
        norms = (x * x).sum(axis=1)
        m2 = norms.max(initial=0)
        x = np.column_stack([x, np.sqrt(np.maximum(0, m2 - norms))])  # all of norm M
        tiny = 1e-6 * np.sqrt(m2)
        away = lambda rows, c: np.sqrt(np.maximum(0, 2 * (m2 - x[rows] @ x[c])))
        out, order, used = [], [], 0
        all_rows = np.arange(len(ids))
        level = [(0, all_rows, away(all_rows, 0))] if len(ids) else []
        made = len(level)
        while level:
            below = []
            for centre, rows, far in level:
                radius = float(far.max())
                if len(rows) <= leaf or radius <= tiny:
                    out.append((centre, radius, 0, 0, used, len(rows)))
                    order.append(rows)
                    used += len(rows)
                    continue
                near = far <= radius / 2
                kids = [(centre, rows[near], far[near])]
                rest = rows[~near]
                while len(rest):
                    c = rest[0]
                    d = away(rest, c)
                    d[0] = 0
                    near = d <= radius / 2
                    kids.append((c, rest[near], d[near]))
                    rest = rest[~near]
                out.append((centre, radius, made, len(kids), 0, 0))
                made += len(kids)
                below += kids
            level = below
        order = np.concatenate(order) if order else np.empty(0, np.int64)
        place = np.empty(len(ids), np.int64)
        place[order] = np.arange(len(ids))
        cols = list(zip(*out)) or [[]] * len(NODES)
        nodes = {k: np.array(c, np.float64 if k == "radius" else np.int64) for k, c in zip(NODES, cols)}
        nodes["centre"] = place[nodes["centre"]]
        return cls(ids[order], labels[order], vectors[order], nodes)

    def search(self, query_id: int, label: int, query: np.ndarray, specs: list[Spec]) -> tuple[list[list[tuple[int, int]]], int]:
        """For each spec its ``(id, score)``, best first; and rows scored."""
        n, most = self.nodes, max(abs(int(query.max(initial=0))), abs(int(query.min(initial=0))))
        kind = exact_type(max(most, self.peak), len(query))
        vectors = self.vectors if np.dtype(kind) == self.vectors.dtype else self.ints.astype(kind)
        q = query.astype(kind)
        q2 = float(query.astype(np.float64) @ query.astype(np.float64))
        both, length, slack = q2 + self.m2, np.sqrt(q2), SLACK * (q2 + self.m2)
        least = np.array([-np.inf if s.least is None else s.least for s in specs], np.float64)
        top = np.array([np.inf if s.most is None else s.most for s in specs], np.float64)
        found = [(np.empty(0, np.int64), np.empty(0, np.int64)) for _ in specs]
        last = np.full(len(specs), -np.inf)  # the last score of full ones

        def bounds(nodes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
            s, r = (vectors[n["centre"][nodes]] @ q).astype(np.float64), n["radius"][nodes]
            d = np.sqrt(np.maximum(0, both - 2 * s))
            upper = np.minimum(s + length * r, (both - np.maximum(0, d - r) ** 2) / 2)
            lower = np.maximum(s - length * r, (both - (d + r) ** 2) / 2)
            return upper + slack, lower - slack

        front = np.arange(min(1, len(n["centre"])))
        upper, lower = bounds(front)
        pops, scored = FIRST_POPS, 0
        while True:
            able = (upper[:, None] >= np.maximum(least, last)) & (lower[:, None] <= top)
            keep = able.any(axis=1)
            front, upper, lower, able = front[keep], upper[keep], lower[keep], able[keep]
            if not len(front):
                break
            if pops < len(front):
                reach = np.where(able, np.minimum(upper[:, None], top), -np.inf).max(axis=1)
                first = np.argpartition(-reach, pops)[:pops]
                rest = np.ones(len(front), bool)
                rest[first] = False
                now, front, upper, lower = front[first], front[rest], upper[rest], lower[rest]
            else:
                now, front, upper, lower = front, front[:0], upper[:0], lower[:0]
            pops *= 2
            rows = _ranges(n["point"][now], n["points"][now])
            if len(rows):
                scored += len(rows)
                scores, ids = (vectors[rows] @ q).astype(np.int64), self.ids[rows]
                same, other = self.labels[rows] == label, ids != query_id
                for i, s in enumerate(specs):
                    ok = other & (same == s.same)
                    if s.least is not None:
                        ok &= scores >= s.least
                    if s.most is not None:
                        ok &= scores <= s.most
                    if ok.any():
                        a, b = np.concatenate([found[i][0], scores[ok]]), np.concatenate([found[i][1], ids[ok]])
                        best = np.lexsort((b, -a))[:s.k]
                        found[i] = a[best], b[best]
                        if len(best) == s.k:
                            last[i] = a[best][-1]
            kids = _ranges(n["child"][now], n["children"][now])
            if len(kids):
                up, low = bounds(kids)
                front, upper, lower = np.concatenate([front, kids]), np.concatenate([upper, up]), np.concatenate([lower, low])
        return [list(zip(b.tolist(), a.tolist())) for a, b in found], scored


def _ranges(first: np.ndarray, many: np.ndarray) -> np.ndarray:
    """first[0], first[0] + 1, ... (many[0] numbers), first[1], ..."""
    ends = np.cumsum(many)
    return np.repeat(first - ends + many, many) + np.arange(ends[-1] if len(ends) else 0)


# ---- jobs

TREES = "dim int, block int, ids binary, labels binary, vectors binary, " + ", ".join(f"{c} binary" for c in NODES)
_TREES = pa.schema([("dim", pa.int32()), ("block", pa.int32()), *((c, pa.binary()) for c in ("ids", "labels", "vectors", *NODES))])
FOUND = "anchor_id long, key long, spec long, spec_score long, vec_id long, score long"
_FOUND = ["anchor_id", "key", "spec", "spec_score", "vec_id", "score"]


def _vectors(group: pa.Table) -> np.ndarray:
    return group.column("vec").combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(group.num_rows, group.column("dim")[0].as_py())


def _plant(group: pa.Table) -> pa.Table:
    order = np.argsort(group.column("vec_id").to_numpy(), kind="stable")
    tree = CoverTree.build(group.column("vec_id").to_numpy()[order], group.column("label").to_numpy()[order], _vectors(group)[order])
    row = {"dim": group.column("dim")[0].as_py(), "block": group.column("block")[0].as_py(), "ids": tree.ids.astype("<i8").tobytes(),
           "labels": tree.labels.astype("<i8").tobytes(), "vectors": tree.ints.astype("<i8").tobytes()}
    row |= {c: a.astype("<f8" if c == "radius" else "<i8").tobytes() for c, a in tree.nodes.items()}
    return pa.Table.from_pylist([row], schema=_TREES)


def _tree(row: dict) -> CoverTree:
    long = lambda c: np.frombuffer(row[c], "<i8")
    nodes = {c: np.frombuffer(row[c], "<f8") if c == "radius" else long(c) for c in NODES}
    return CoverTree(long("ids"), long("labels"), long("vectors").reshape(len(row["ids"]) // 8, -1), nodes)


def _descend(specs_of):
    """A cell: one tree, one block of queries.  ``specs_of(row)`` gives the
    query's ``(spec id, spec score, Spec)``."""

    def run(trees: pa.Table, queries: pa.Table) -> pa.Table:
        out: list[tuple] = []
        if trees.num_rows and queries.num_rows:
            tree = _tree(trees.to_pylist()[0])
            for row in queries.to_pylist():
                specs = specs_of(row)
                answers, _ = tree.search(row["vec_id"], row["label"], np.array(row["vec"], np.int64), [s for *_, s in specs])
                out += [(row["vec_id"], row["key"], spec, value, i, score) for (spec, value, _), rows in zip(specs, answers) for i, score in rows]
        cols = list(zip(*out)) or [[]] * len(_FOUND)
        return pa.table([pa.array(c, pa.int64()) for c in cols], names=_FOUND)

    return run


def _meet(trees: DataFrame, queries: DataFrame, n_blocks: int, q_blocks: int, specs_of) -> DataFrame:
    every = lambda many: F.explode(F.array(*(F.lit(i) for i in range(many))))
    at = ["dim", "block", "q_block"]
    left = trees.withColumn("q_block", every(q_blocks)).groupBy(*at)
    right = (queries.withColumn("block", every(n_blocks)).withColumn("q_block", F.pmod(F.col("key"), F.lit(q_blocks)).cast("int")).groupBy(*at))
    return left.cogroup(right).applyInArrow(_descend(specs_of), FOUND)


def window(score: int, low: int, high: int) -> tuple[int, int]:
    """Scores s with low * score <= 100 * s <= high * score."""
    return -(-low * score // 100), high * score // 100


def quantised(vectors: DataFrame, id_col: str, vector_col: str, label_col: str, scale: int) -> DataFrame:
    """``vec_id, label, dim, vec`` (floor(scale * x), x as double), ``key``."""
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(label_col).cast("long").alias("label"), F.col(vector_col).cast("array<double>").alias("vec"))
    rows = rows.filter("vec_id IS NOT NULL AND label IS NOT NULL AND vec IS NOT NULL")
    rows = rows.filter(F.forall("vec", lambda x: x.isNotNull() & (F.abs(x) * scale < 2.0**62)))
    rows = rows.select("vec_id", "label", F.size("vec").alias("dim"), F.transform("vec", lambda x: F.floor(x * scale)).alias("vec"))
    return rows.dropDuplicates().withColumn("key", F.xxhash64("vec_id", "label", "vec"))


def hard_negatives(vectors: DataFrame, is_anchor: Column, positives: int = POSITIVES, negatives: int = NEGATIVES, low: int = LOW, high: int = HIGH,
                   id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label", scale: int = SCALE) -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score,
    negative_score``: for each anchor (a condition on ``vec_id``) and each of
    its best rows of the same label, the best rows of other labels whose score
    is from ``low`` to ``high`` percent of the positive's."""
    base = stored(quantised(vectors, id_col, vector_col, label_col, scale), "hard-rows")
    n, m = base.agg(F.count("*"), F.count_if(is_anchor)).first()
    n_blocks, q_blocks = max(1, -(-n // CANDIDATES)), max(1, -(-m // QUERIES))
    trees = stored(base.withColumn("block", F.pmod("key", F.lit(n_blocks)).cast("int")).groupBy("dim", "block").applyInArrow(_plant, TREES), "hard-trees")
    anchors = base.filter(is_anchor)
    best = lambda *by: Window.partitionBy(*by).orderBy(F.desc("score"), "vec_id")

    found = _meet(trees, anchors, n_blocks, q_blocks, lambda row: [(0, 0, Spec(None, None, True, positives))])
    near = (found.withColumn("rank", F.row_number().over(best("anchor_id", "key"))).filter(F.col("rank") <= positives)
            .groupBy("anchor_id", "key").agg(F.collect_list(F.struct("vec_id", "score")).alias("positives")))
    queries = stored(anchors.join(near.withColumnRenamed("anchor_id", "vec_id"), ["vec_id", "key"]), "hard-queries")

    def windows(row: dict) -> list[tuple]:
        return [(p["vec_id"], p["score"], Spec(*window(p["score"], low, high), False, negatives)) for p in row["positives"]]

    found = _meet(trees, queries, n_blocks, q_blocks, windows)
    return (found.withColumn("rank", F.row_number().over(best("anchor_id", "key", "spec", "spec_score"))).filter(F.col("rank") <= negatives)
            .select("anchor_id", F.col("spec").alias("positive_id"), "rank", F.col("vec_id").alias("negative_id"),
                    F.col("spec_score").alias("positive_score"), F.col("score").alias("negative_score")))
