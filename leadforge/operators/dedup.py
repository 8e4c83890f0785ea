"""Keep-first deduplication, skew-safe.

"Keep the first row per key" is an aggregation, not a window: each key's
winner is ``min(struct(order..., payload...))``, which Spark computes with a
partial (map-side) aggregate before the shuffle.  A key that holds a third of
all rows therefore costs one small partial row per task instead of one huge
window partition.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def first_by(df: DataFrame, keys: list[str], order: list[str], payload: list[str]) -> DataFrame:
    """Per ``keys``, the row with the smallest ``order`` tuple; returns
    ``keys + payload`` (``order`` columns may be part of ``payload``)."""
    cols = list(dict.fromkeys(order + payload))
    packed = F.struct(*[F.col(c).alias(f"_o{i}") for i, c in enumerate(order)],
                      *[F.col(c).alias(f"_p_{c}") for c in cols])
    agg = df.groupBy(*keys).agg(F.min(packed).alias("_first"))
    return agg.select(*keys, *[F.col(f"_first._p_{c}").alias(c) for c in payload if c not in keys])


def drop_seen(df: DataFrame, history: DataFrame, key: str = "url") -> DataFrame:
    """D3 incremental form: rows whose key is not in an earlier run's history."""
    return df.join(history.select(key).distinct(), key, "left_anti")
