"""Bloom filters as plain Spark: built by an aggregate, applied in a scan.

``bloom(keys)`` is a one-row table with the filter's bits as an array of longs;
``maybe_in(filter, key)`` is a condition that holds for all keys that went in
and for few others.  The filter travels as a scalar subquery, so a large table
is thinned where it is scanned, before any shuffle, whatever the join behind it.
Its size is fixed by ``bits`` alone (``BITS``: 1 MB): with more keys than a
sixteenth of the bits it lets more rows pass, and never loses one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BITS = 1 << 23


def _places(h: Column, bits: int) -> list[Column]:
    """Two bit numbers from the halves of one 64-bit hash."""
    mask = F.lit(bits - 1)
    return [h.bitwiseAND(mask), F.shiftrightunsigned(h, 32).bitwiseAND(mask)]


def bloom(keys: DataFrame, key: str | Column, bits: int = BITS) -> DataFrame:
    """One row ``words``: ``bits`` (a power of two, 64 at least) over the keys;
    null keys are left out."""
    key = F.col(key) if isinstance(key, str) else key
    hashes = keys.select(F.explode(F.array(F.when(key.isNotNull(), F.xxhash64(key)))).alias("h")).filter("h IS NOT NULL")
    places = hashes.select(F.explode(F.array(*_places(F.col("h"), bits))).alias("p"))
    held = places.select(F.shiftright("p", 6).alias("word"), F.expr("shiftleft(1L, CAST(p & 63 AS INT))").alias("v"))
    every = keys.sparkSession.range(bits >> 6).select(F.col("id").alias("word"), F.lit(0).cast("long").alias("v"))
    filled = held.union(every).groupBy("word").agg(F.bit_or("v").alias("v"))
    return filled.agg(F.sort_array(F.collect_list(F.struct("word", "v")))["v"].alias("words"))


def maybe_in(words: DataFrame, key: str | Column, bits: int = BITS) -> Column:
    """Whether the key may be in the filter (false for null keys)."""
    key = F.col(key) if isinstance(key, str) else key
    held = words.scalar()
    tests = [F.getbit(F.get(held, F.shiftright(p, 6).cast("int")), p.bitwiseAND(F.lit(63)).cast("int")) == 1 for p in _places(F.xxhash64(key), bits)]
    return key.isNotNull() & tests[0] & tests[1]
