"""Document fingerprints: invertible Bloom lookup sketches of paragraphs.

A text's paragraphs are its lines, long lines cut after sentence ends.  Each
(with its occurrence number, so repeats count) is hashed to 64 bits and added
to three cells of a small table; a cell keeps a count and the exclusive-or of
the digests and of their check sums.  Two tables of one size subtract cell by
cell, equal paragraphs cancel, and peeling cells that hold one digest recovers
the digests in which the texts differ.  If peeling gets stuck, both sketches
are made anew, larger.

The sketches of a slice of documents are made, subtracted and peeled together
as arrays; ``Sketch`` and ``differing`` do the same for two versions.

Edge cases: null text is empty text, whose sketch is empty; two empty texts
are alike (1.0); null ids sort first; equal ids are ordered by a hash of
their texts, and dealt over several ranges where they are many (equal rows
too); a single document is its own successor; an empty table has no rows; long
texts of many paragraphs take more memory in proportion; further columns of the
input are ignored.  ``docs`` has to be a table scan, or another DataFrame that
gives the same rows in the same order when a partition is computed again.
"""

from __future__ import annotations

import base64
import hashlib
import re
import struct
from collections import Counter
from collections.abc import Iterable, Iterator
from operator import sub, xor

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType

from .common import shuffle_partitions, slices

CELLS = 60
#: Documents that are compared at once, and sampled rows for each range bound.
STEP, SAMPLED = 250, 64
#: From so many paragraphs on (and four times as many cells) arrays are faster.
MANY = 100
_MASK = (1 << 64) - 1
_END = re.compile(r"(?<=[.!?])\s+|\n+")


def paragraphs(text: str) -> list[str]:
    return [p for p in map(str.strip, _END.split(text)) if p]


def _again(first: int, n: int) -> int:
    """The digest of a paragraph's nth occurrence, from that of the first (the
    hash's own seeds give short texts of different seeds equal digests)."""
    x = (first + n * 0x9E3779B97F4A7C15) & _MASK
    x = (x ^ (x >> 33)) * 0xFF51AFD7ED558CCD & _MASK
    x = (x ^ (x >> 33)) * 0xC4CEB9FE1A85EC53 & _MASK
    return x ^ (x >> 33)


def digests(text: str, known: dict[str, int] | None = None) -> list[int]:
    """64-bit digests of the paragraphs; the second "x" differs from the first.
    ``known`` keeps digests of paragraphs (first occurrence) between calls."""
    known = {} if known is None else known
    found = paragraphs(text)
    for p in found:
        if p not in known:
            known[p] = xxhash.xxh3_64_intdigest(p.encode())
    if len(set(found)) == len(found):
        return [known[p] for p in found]
    seen: Counter = Counter()
    out = []
    for p in found:
        seen[p] = n = seen[p] + 1
        out.append(known[p] if n == 1 else _again(known[p], n))
    return out


def _check(key: int) -> int:
    return (key * 0x9E3779B97F4A7C15 & _MASK) >> 32


def _places_many(keys: np.ndarray, cells: int) -> np.ndarray:
    part = np.uint64(cells // 3)
    return np.concatenate([((keys >> np.uint64(20 * i)) % part).astype(np.intp) + i * int(part) for i in range(3)])


def _check_many(keys: np.ndarray) -> np.ndarray:
    return (keys * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(32)


def _add_many(count: np.ndarray, cell: np.ndarray, check: np.ndarray, keys: np.ndarray, times: np.ndarray) -> None:
    at = _places_many(keys, len(count))
    np.add.at(count, at, np.tile(times, 3))
    np.bitwise_xor.at(cell, at, np.tile(keys, 3))
    np.bitwise_xor.at(check, at, np.tile(_check_many(keys), 3))


def _peel_many(count: np.ndarray, cell: np.ndarray, check: np.ndarray) -> tuple[set[int], set[int]] | None:
    """Takes all cells that hold one digest at once, until none is left."""
    here, there = set(), set()
    while True:
        pure = np.flatnonzero((np.abs(count) == 1) & (check == _check_many(cell)))
        pure = pure[(_places_many(cell[pure], len(count)).reshape(3, -1) == pure).any(axis=0)]
        if not len(pure):
            return None if cell.any() or count.any() else (here, there)
        keys, first = np.unique(cell[pure], return_index=True)
        sign = count[pure[first]]
        here.update(keys[sign == 1].tolist())
        there.update(keys[sign == -1].tolist())
        _add_many(count, cell, check, keys, -sign)


class Sketch:
    """``cells`` is a multiple of 3: each of the three hashes has its own part.
    Plain integers serve the usual tens of paragraphs, arrays many more."""

    def __init__(self, keys: Iterable[int] = (), cells: int = CELLS):
        self.cells, self.count, self.key, self.check = cells, [0] * cells, [0] * cells, [0] * cells
        self.add(keys, 1)

    def places(self, key: int) -> tuple[int, int, int]:
        part = self.cells // 3
        return key % part, part + (key >> 20) % part, 2 * part + (key >> 40) % part

    def add(self, keys: Iterable[int], times: int) -> None:
        part, count, cell, check = self.cells // 3, self.count, self.key, self.check
        if isinstance(keys, list) and len(keys) > MANY:
            k = np.array(keys, np.uint64)
            arrays = tuple(np.array(x, t) for x, t in zip((count, cell, check), (np.int64, np.uint64, np.uint64)))
            _add_many(*arrays, k, np.full(len(k), times))
            self.count, self.key, self.check = (x.tolist() for x in arrays)
            return
        for key in keys:
            c, i, j, k = (key * 0x9E3779B97F4A7C15 & _MASK) >> 32, key % part, part + (key >> 20) % part, 2 * part + (key >> 40) % part
            count[i] += times
            count[j] += times
            count[k] += times
            cell[i] ^= key
            cell[j] ^= key
            cell[k] ^= key
            check[i] ^= c
            check[j] ^= c
            check[k] ^= c

    def minus(self, other: Sketch) -> Sketch:
        out = Sketch(cells=self.cells)
        out.count = list(map(sub, self.count, other.count))
        out.key = list(map(xor, self.key, other.key))
        out.check = list(map(xor, self.check, other.check))
        return out

    def peel(self) -> tuple[set[int], set[int]] | None:
        """(digests only here, only there); None if it gets stuck."""
        if self.cells > 4 * MANY:
            return _peel_many(*(np.array(x, t) for x, t in zip((self.count, self.key, self.check), (np.int64, np.uint64, np.uint64))))
        here, there, work = set(), set(), [i for i, n in enumerate(self.count) if n in (1, -1)]
        while work:
            i = work.pop()
            n, key = self.count[i], self.key[i]
            if n not in (1, -1) or self.check[i] != _check(key):
                continue
            at = self.places(key)
            if i not in at:
                continue
            (here if n == 1 else there).add(key)
            self.add((key,), -n)
            work += at
        return None if any(self.key) or any(self.count) else (here, there)

    def text(self) -> str:
        return base64.b64encode(struct.pack(f"<{self.cells}i{self.cells}Q{self.cells}I", *self.count, *self.key, *self.check)).decode()


def _most(n, m):
    """Cells beyond which no sketch helps: only a digest that stands twice in a
    list still gets stuck there, and the lists are compared themselves."""
    return 64 * (n + m) + 4 * CELLS


def differing(a: list[int], b: list[int], sketch_a: Sketch, sketch_b: Sketch) -> tuple[set[int], set[int]]:
    """The digests in which two versions differ, from their sketches, retried
    larger until the peeling succeeds: at first with room for all digests of
    both, but four times as large at most, then twice as large each time."""
    cells = sketch_a.cells
    room = 3 * ((len(a) + len(b)) // 2 + 4)
    while cells <= _most(len(a), len(b)) and (found := sketch_a.minus(sketch_b).peel()) is None:
        cells = min(4 * cells, max(cells + 3, room)) if cells == CELLS else 2 * cells
        sketch_a, sketch_b = Sketch(a, cells), Sketch(b, cells)
    return found if found is not None else (set(a) - set(b), set(b) - set(a))


def likeness(a: list[int], b: list[int], sketch_a: Sketch, sketch_b: Sketch) -> float:
    """Shared paragraphs by all paragraphs of both (Jaccard)."""
    here, there = differing(a, b, sketch_a, sketch_b)
    union = len(a) + len(there)
    return (len(a) - len(here)) / union if union else 1.0


def edited(text: str, following: str) -> str:
    """The last quarter replaced by as many first code points of the next text."""
    q = len(text) // 4
    return text[:len(text) - q] + following[:q]


OUT = ("doc_id long, n_chars long, n_paragraphs long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
       "near_edited double, near_next double")
_OUT = pa.schema([("doc_id", pa.int64()), ("n_chars", pa.int64()), ("n_paragraphs", pa.int64()), ("edited_sha256", pa.string()),
                  ("fingerprint", pa.string()), ("edited_fingerprint", pa.string()), ("near_edited", pa.float64()), ("near_next", pa.float64())])


class Bulk:
    """The sketches of many key lists as one array: the cells of list ``i`` are
    ``start[i]`` to ``start[i + 1]``, a third of them for each hash."""

    def __init__(self, cells: np.ndarray):
        self.part = (cells // 3).astype(np.uint64)
        self.start = np.concatenate([[0], np.cumsum(cells)])
        self.owner = np.repeat(np.arange(len(cells)), cells)
        n = int(self.start[-1])
        self.count, self.key, self.check = np.zeros(n, np.int64), np.zeros(n, np.uint64), np.zeros(n, np.uint64)

    def places(self, keys: np.ndarray, owner: np.ndarray) -> np.ndarray:
        part = self.part[owner]
        return np.concatenate([((keys >> np.uint64(20 * i)) % part + np.uint64(i) * part).astype(np.int64) + self.start[owner] for i in range(3)])

    def add(self, keys: np.ndarray, owner: np.ndarray, times: np.ndarray) -> None:
        at = self.places(keys, owner)
        np.add.at(self.count, at, np.tile(times, 3))
        np.bitwise_xor.at(self.key, at, np.tile(keys, 3))
        np.bitwise_xor.at(self.check, at, np.tile(_check_many(keys), 3))

    def peel(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Takes all cells that hold one digest at once, until none is left:
        the number of digests only here, only there, and which got stuck."""
        here, there = np.zeros(len(self.part), np.int64), np.zeros(len(self.part), np.int64)
        while True:
            pure = np.flatnonzero((np.abs(self.count) == 1) & (self.check == _check_many(self.key)))
            keys, owner = self.key[pure], self.owner[pure]
            own = (self.places(keys, owner).reshape(3, -1) == pure).any(axis=0)
            keys, owner, sign = keys[own], owner[own], self.count[pure[own]]
            if not len(keys):
                break
            order = np.lexsort((keys, owner))
            keys, owner, sign = keys[order], owner[order], sign[order]
            first = np.concatenate([[True], (keys[1:] != keys[:-1]) | (owner[1:] != owner[:-1])])
            keys, owner, sign = keys[first], owner[first], sign[first]
            here += np.bincount(owner[sign == 1], minlength=len(here))
            there += np.bincount(owner[sign == -1], minlength=len(there))
            self.add(keys, owner, -sign)
        stuck = np.zeros(len(self.part), bool)
        stuck[self.owner[(self.key != 0) | (self.count != 0)]] = True
        return here, there, stuck

    def texts(self) -> list[str]:
        """As ``Sketch.text``."""
        ends = list(zip(self.start.tolist(), self.start[1:].tolist()))
        count, key, check = self.count.astype("<i4"), self.key.astype("<u8"), self.check.astype("<u4")
        return [base64.b64encode(count[a:b].tobytes() + key[a:b].tobytes() + check[a:b].tobytes()).decode() for a, b in ends]


def _together(lists: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """(all keys, the list that each is from)."""
    return (np.concatenate(lists) if lists else np.empty(0, np.uint64)), np.repeat(np.arange(len(lists)), [len(x) for x in lists])


def sketches(lists: list[np.ndarray], cells: int = CELLS) -> Bulk:
    out = Bulk(np.full(len(lists), cells))
    keys, owner = _together(lists)
    out.add(keys, owner, np.ones(len(keys), np.int64))
    return out


def likenesses(a: list[np.ndarray], b: list[np.ndarray], of_a: Bulk, of_b: Bulk) -> np.ndarray:
    """``likeness`` of each list of ``a`` to that of ``b`` with the same number."""
    n = np.array([len(x) for x in a], np.int64)
    m = np.array([len(x) for x in b], np.int64)
    minus = Bulk(np.full(len(a), CELLS))
    minus.count, minus.key, minus.check = of_a.count - of_b.count, of_a.key ^ of_b.key, of_a.check ^ of_b.check
    here, there, stuck = minus.peel()
    cells, todo = np.full(len(a), CELLS), np.flatnonzero(stuck)
    while len(todo):
        for i in todo[cells[todo] > _most(n[todo], m[todo])]:
            here[i], there[i] = (len(set(x[i].tolist()) - set(y[i].tolist())) for x, y in ((a, b), (b, a)))
        todo = todo[cells[todo] <= _most(n[todo], m[todo])]
        if not len(todo):
            break
        room = 3 * ((n[todo] + m[todo]) // 2 + 4)
        cells[todo] = np.where(cells[todo] == CELLS, np.minimum(4 * CELLS, np.maximum(CELLS + 3, room)), 2 * cells[todo])
        larger = Bulk(cells[todo])
        for lists, times in ((a, 1), (b, -1)):
            keys, owner = _together([lists[i] for i in todo])
            larger.add(keys, owner, np.full(len(keys), times))
        here[todo], there[todo], stuck = larger.peel()
        todo = todo[stuck]
    union = n + there
    return np.where(union > 0, (n - here) / np.maximum(union, 1), 1.0)


def _rows(docs: list[tuple], last: tuple) -> pa.RecordBatch:
    """``docs``: (id, text, keys, known) of documents in a row, ``last`` the
    one that follows them."""
    now, after = docs, [*docs[1:], last]
    new = [edited(a[1], b[1]) for a, b in zip(now, after)]
    new_keys = [np.array(digests(t, a[3] | b[3]), np.uint64) for t, a, b in zip(new, now, after)]
    keys, next_keys = [d[2] for d in now], [d[2] for d in after]
    every = sketches([*keys, last[2]])
    own, following = Bulk(np.full(len(now), CELLS)), Bulk(np.full(len(now), CELLS))
    for c in ("count", "key", "check"):
        setattr(own, c, getattr(every, c)[:-CELLS])
        setattr(following, c, getattr(every, c)[CELLS:])
    changed = sketches(new_keys)
    cols = [[d[0] for d in now], [len(d[1]) for d in now], [len(k) for k in keys], [hashlib.sha256(t.encode()).hexdigest() for t in new], own.texts(), changed.texts(),
            likenesses(keys, new_keys, own, changed), likenesses(keys, next_keys, own, following)]
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(cols, _OUT)], schema=_OUT)


def _pairs(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by bucket, the guest last: each with the one after it."""
    bucket, held = None, []
    for b in slices(batches, STEP):
        for part, doc_id, text in zip(*(b.column(c).to_pylist() for c in ("bucket", "doc_id", "text"))):
            if part != bucket:  # the guest that was last has no row here
                if len(held) > 1:
                    yield _rows(held[:-1], held[-1])
                bucket, held = part, []
            known: dict[str, int] = {}
            held.append((doc_id, text, np.array(digests(text, known), np.uint64), known))
        if len(held) > 1:
            yield _rows(held[:-1], held[-1])
            held = held[-1:]


def _sample(rows: DataFrame, ranges: int) -> np.ndarray:
    """Sorted ``(key, tie)`` of a hash sample of ``SAMPLED`` rows a range."""
    every = max(1, rows.count() // (SAMPLED * ranges))
    picked = rows.filter(F.pmod(F.xxhash64("salt"), F.lit(every)) == 0).select("key", "tie").collect()
    return np.array(sorted(map(tuple, picked)), np.int64).reshape(-1, 2)


def _range_of(sample: np.ndarray, ranges: int):
    """The range of a row: equal shares of the sample.  Equal rows that stand
    in the sample on both sides of a bound are dealt over its ranges, by salt,
    in the same proportions."""
    n = len(sample)
    cuts = np.array([n * i // ranges for i in range(1, ranges)] if n else [], np.int64)
    keys, ties = sample[cuts].T if n else (np.empty(0, np.int64),) * 2

    def inside(values: np.ndarray, key, tie, side: str) -> np.ndarray:
        a, z = np.searchsorted(values[:, 0], key, "left"), np.searchsorted(values[:, 0], key, "right")
        return a + np.searchsorted(values[a:z, 1], tie, side)

    @F.pandas_udf(IntegerType())
    def range_of(key: pd.Series, tie: pd.Series, salt: pd.Series) -> pd.Series:
        k, t, s = key.to_numpy(), tie.to_numpy(), salt.to_numpy()
        low, high = np.searchsorted(keys, k, "left"), np.searchsorted(keys, k, "right")
        out, bounds = low.copy(), np.column_stack([keys, ties])
        for i in np.unique(k[low < high]):
            own = np.flatnonzero(k == i)
            first, last = inside(bounds, i, t[own], "left"), inside(bounds, i, t[own], "right")
            a, z = inside(sample, i, t[own], "left"), inside(sample, i, t[own], "right")
            at = (a + s[own] / (1 << 30) * (z - a)) * ranges / n
            out[own] = np.where(first < last, np.clip(at.astype(np.int64), first, last), first)
        return pd.Series(out.astype(np.int32))

    return range_of


def fingerprints(docs: DataFrame, text_col: str = "text", id_col: str = "doc_id") -> DataFrame:
    """Each document's sketch, that of its edited text, and the likenesses to
    the edited text and to the next document (ascending id, cyclic).

    Documents are dealt into ranges of (id, hash of the text) once.  The first
    document of a range also visits the range before it as a guest, so that
    every document meets its successor; only the bounds' sample and the ranges'
    first keys pass through the driver.
    """
    spark = docs.sparkSession
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(id_col).cast("long"), F.lit(-(1 << 63))).alias("key"), F.xxhash64(text).alias("tie"),
                       F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(1 << 30)).alias("salt"), text.alias("text"))
    ranges = shuffle_partitions(spark)
    bucket = _range_of(_sample(rows.select("key", "tie", "salt"), ranges), ranges)("key", "tie", "salt").alias("bucket")
    firsts = sorted((r["bucket"], r["f"]["key"], r["f"]["tie"]) for r in
                    rows.select(bucket, "key", "tie").groupBy("bucket").agg(F.min(F.struct("key", "tie")).alias("f")).collect())
    if not firsts:
        return spark.createDataFrame([], OUT)
    hosts = spark.createDataFrame([(key, tie, firsts[i - 1][0]) for i, (_, key, tie) in enumerate(firsts)], "key long, tie long, bucket int")  # i - 1 = -1: the last range
    # A guest is one row of its key: a partial aggregate, however many there are.
    guests = (rows.filter(F.struct("key", "tie").isin([F.struct(F.lit(key).cast("long"), F.lit(tie).cast("long")) for _, key, tie in firsts]))
              .groupBy("key", "tie").agg(F.first("doc_id").alias("doc_id"), F.first("text").alias("text")).join(hosts, ["key", "tie"]))
    columns = ("bucket", "guest", "key", "tie", "doc_id", "text")
    dealt = rows.select("*", bucket).withColumn("guest", F.lit(False)).select(*columns).unionByName(guests.withColumn("guest", F.lit(True)).select(*columns))
    return (dealt.repartitionById(ranges, F.col("bucket")).sortWithinPartitions("bucket", "guest", "key", "tie")
            .select("bucket", "doc_id", "text").mapInArrow(_pairs, OUT))
