"""Best-fit packing by a plan over the length histogram.

Documents are encoded where they are scanned and cut into pieces of at most
``capacity`` ids; a task numbers its pieces within each length.  The plan is
best-fit decreasing over *counts* of lengths (at most ``capacity`` numbers,
whatever the corpus), and a piece takes the slot of its rank within its length.

Edge cases: null text is an empty document (its end id only); an empty table
gives no rows; repeated rows are packed as often as they occur; further
columns of the input are ignored.
"""

from __future__ import annotations

import bisect
import zlib
from collections import Counter, defaultdict
from collections.abc import Iterable, Iterator, Mapping

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import slices, stored
from .tokens import piece_encoder

CAPACITY = 2048
PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long, part int, local_rank long"


def cut(n: int, capacity: int = CAPACITY) -> list[tuple[int, int]]:
    """(start, length) of the pieces of n ids: all full but the first."""
    first = n % capacity or min(n, capacity)
    return [(0, first), *((at, capacity) for at in range(first, n, capacity))] if n else []


def plan(histogram: Mapping[int, int], capacity: int = CAPACITY) -> list[tuple[int, int, int, int, int]]:
    """Best-fit decreasing over counts: ``(length, rank0, sequence0, per, offset)``.

    The piece of rank r >= rank0 (up to the length's next entry) goes to the
    sequence ``sequence0 + (r - rank0) // per`` at ``offset + (r - rank0) % per * length``.
    Sequences with the same contents so far are one run of sequence numbers.
    """
    runs: dict[int, list[tuple[int, int]]] = defaultdict(list)  # room left -> (first sequence, how many)
    rooms: list[int] = []
    entries, opened = [], 0

    def put(room: int, first: int, many: int) -> None:
        if room and many:
            if not runs[room]:
                bisect.insort(rooms, room)
            runs[room].append((first, many))

    for length in sorted((k for k, c in histogram.items() if c), reverse=True):
        left, rank = histogram[length], 0
        while left:
            at = bisect.bisect_left(rooms, length)
            if at == len(rooms):  # no sequence has room: open as many as these need
                need = -(-left // (capacity // length))
                put(capacity, opened, need)
                opened += need
                continue
            room = rooms[at]
            first, many = runs[room].pop()
            if not runs[room]:
                rooms.pop(at)
            per = room // length
            full = min(many, left // per)
            if full:
                entries.append((length, rank, first, per, capacity - room))
                put(room - per * length, first, full)
                rank, left = rank + full * per, left - full * per
            if full < many and left:  # fewer than fill one sequence
                entries.append((length, rank, first + full, left, capacity - room))
                put(room - left * length, first + full, 1)
                put(room, first + full + 1, many - full - 1)
                left = 0
            elif full < many:
                put(room, first + full, many - full)
    return entries


def pieces(docs: DataFrame, vocab: str, end_id: int = 0, capacity: int = CAPACITY,
           text_col: str = "text", id_col: str = "doc_id") -> DataFrame:
    """The pieces of every document, numbered within (task, length)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc, end, part, seen = piece_encoder(vocab), end_id.to_bytes(4, "little"), TaskContext.get().partitionId(), Counter()
        for batch in slices(batches):
            rows = []
            for doc_id, ids in zip(batch.column(0).to_pylist(), enc.encode_column(batch.column(1))):
                ids += end
                for k, (start, length) in enumerate(cut(len(ids) // 4, capacity)):
                    rows.append((doc_id, k, start, length, zlib.crc32(ids[4 * start:4 * (start + length)]), part, seen[length]))
                    seen[length] += 1
            cols = list(zip(*rows)) if rows else [[]] * 7
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, PIECE_TYPES)], names=PIECE_NAMES)

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text")).mapInArrow(run, PIECES)


PIECE_NAMES = ["doc_id", "piece", "start", "length", "ids_crc32", "part", "local_rank"]
PIECE_TYPES = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int64()]


def place(ranked: DataFrame, entries: list[tuple[int, int, int, int, int]]) -> DataFrame:
    """Pieces with ``length, rank`` take their slots: a sorted lookup in the
    plan, whose size depends on the capacity alone."""
    plan_table = np.array(sorted(entries), dtype=np.int64).reshape(-1, 5)
    held = ranked.sparkSession.sparkContext.broadcast(plan_table)
    out = ranked.drop("rank").schema.add("sequence_id", "long").add("offset", "long")

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        length0, rank0, seq0, per, off0 = held.value.T
        keys = (length0 << 44) | rank0
        for b in batches:
            length, rank = b.column("length").to_numpy(), b.column("rank").to_numpy()
            e = np.searchsorted(keys, (length << 44) | rank, side="right") - 1
            j = rank - rank0[e]
            seq, off = seq0[e] + j // per[e], off0[e] + j % per[e] * length
            keep = [c for c in b.schema.names if c != "rank"]
            yield pa.RecordBatch.from_arrays([*(b.column(c) for c in keep), pa.array(seq, pa.int64()), pa.array(off, pa.int64())],
                                             names=[*keep, "sequence_id", "offset"])

    return ranked.mapInArrow(run, out)


def pack(docs: DataFrame, vocab: str, end_id: int = 0, capacity: int = CAPACITY,
         text_col: str = "text", id_col: str = "doc_id") -> DataFrame:
    """``doc_id, piece, start, length, ids_crc32, sequence_id, offset``."""
    cut_up = stored(pieces(docs, vocab, end_id, capacity, text_col, id_col), "pieces")
    counts = cut_up.groupBy("part", "length").agg(F.count("*").alias("n"))
    histogram = {r["length"]: r["n"] for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect()}  # <= capacity rows
    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    bases = counts.select("part", "length", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    ranked = (cut_up.join(bases, ["part", "length"])
              .select("doc_id", "piece", "start", "length", "ids_crc32", (F.col("base") + F.col("local_rank")).alias("rank")))
    return place(ranked, plan(histogram, capacity))
