"""Helpers shared by the operators of this folder."""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Iterator
from contextlib import contextmanager

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from leadforge.session import ensure_checkpoint_dir

_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def shared_dir(spark: SparkSession) -> str:
    """The folder that the driver and all executors share: the session's
    ``spark.checkpoint.dir`` (an error on a cluster without one)."""
    return ensure_checkpoint_dir(spark).rstrip("/")


@contextmanager
def settings(spark: SparkSession, conf: dict[str, str]) -> Iterator[None]:
    """Settings of the session for what runs inside."""
    before = {k: spark.conf.get(k, None) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as a Parquet table in the shared folder and read it back.

    Cuts the lineage: a lost executor costs a re-read, never the work above.
    Nothing reads the write's shuffles again, so they go with its end and not
    when the driver collects garbage: the disk holds those of one write.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/llm-{name}-{uuid.uuid4().hex}"
    with settings(spark, {_CLEANUP: "true"}):
        df.write.option("compression", "zstd").parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out.stored_path = path
    return out


def discard(table: DataFrame) -> None:
    """Remove a table that ``stored`` wrote, once what was made of it is stored."""
    spark = table.sparkSession
    path = spark._jvm.org.apache.hadoop.fs.Path(table.stored_path)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


_KEPT: dict[str, dict] = {}


def worker_cache(operator: str) -> dict:
    """What this Python worker keeps for an operator from task to task.

    Workers outlive a query's stages and count to their executor's memory: what
    was kept for the operator before goes when the next one asks.
    """
    if operator not in _KEPT:
        _KEPT.clear()
        _KEPT[operator] = {}
    return _KEPT[operator]


def slices(batches: Iterable[pa.RecordBatch], rows: int = 1000) -> Iterator[pa.RecordBatch]:
    """Arrow batches in smaller steps: what a worker makes of whole texts of
    one step is all that it holds."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def hash_sample(df: DataFrame, key: Column, buckets: int, groups: list[str], columns: list[Column]) -> list:
    """A bounded sample for fitting: per combination of ``groups`` the row of
    smallest key hash in each of ``buckets`` hash buckets.

    First the hashes alone are found (a hash aggregate over narrow columns),
    then the rows that have them: the wide columns of no other row are moved.
    """
    h = F.xxhash64(key)
    least = (df.groupBy(*groups, F.pmod(h, F.lit(buckets)).alias("_bucket")).agg(F.min(h).alias("_h")).select("_h").distinct().collect())
    chosen = [r["_h"] for r in least]
    if not chosen:
        return []
    return df.filter(h.isin(chosen)).select(h.alias("_h"), *columns).dropDuplicates(["_h"]).collect()
