"""D3 across runs as a Structured Streaming job.

The reference keeps one seen-URL set for the lifetime of a pipeline object:
a company link already extracted (in any sector, in any earlier run) is
skipped.  Here listing pages arrive as files ``(sector, sector_ord, page_no,
url, html)``; every micro-batch

1. parses its pages and extracts company links (D1, D2),
2. keeps the first occurrence of each URL in a task (order ``sector_ord,
   sector, page_no, link_pos``; a partial aggregate), so that a URL which
   holds a third of all rows is shuffled as a few,
3. asks the state store, keyed by URL, whether the URL has been seen: the state
   has the times of the first and the last batch with it, and its first link.
   Where both times are the batch's own the URL is new, and its link is
   emitted, and
4. writes the new links as folder ``batch_id=<n>``.

Steps 2 and 3 are one streaming aggregation: a URL costs no Python, and a task
holds in memory what an aggregate of its rows holds.

A batch reads and writes the state of its own URLs alone: its time does not
grow with the number of batches or URLs before it.  The state lives in RocksDB
on the executors and, as changes, in the stream's checkpoint folder, from where
a lost executor's part is restored.  Step 4 overwrites its own folder, so a
retried batch is idempotent.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from leadforge.operators import directory as D
from leadforge.operators.dom import parse_pages

LISTING_SCHEMA = T.StructType([
    T.StructField("sector", T.StringType()),
    T.StructField("sector_ord", T.IntegerType()),
    T.StructField("page_no", T.IntegerType()),
    T.StructField("url", T.StringType()),
    T.StructField("html", T.StringType()),
])
#: The order in which links count as first.
ORDER = ["sector_ord", "sector", "page_no", "link_pos"]
_PROVIDER = "spark.sql.streaming.stateStore.providerClass"
_ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def new_links(pages: DataFrame) -> DataFrame:
    """Steps 1-3 on a stream of listing pages."""
    dom = parse_pages(pages, keep=["sector", "sector_ord", "page_no", "url"])
    links = D.company_links(dom, keep=["sector", "sector_ord", "page_no"])
    timed = links.withColumn("now", F.current_timestamp())  # the batch's own time, the same when it is repeated
    seen = timed.groupBy("company_url").agg(
        F.min("now").alias("since"), F.max("now").alias("last"), F.min(F.struct(*ORDER, "name")).alias("link"))
    return seen.filter("since = last").select("company_url", "link.sector", "link.page_no", "link.link_pos", "link.name")


def start(spark: SparkSession, source_dir: str, history_dir: str, checkpoint_dir: str,
          available_now: bool = True, files_per_batch: int | None = None):
    """Start the stream over ``source_dir``; returns the ``StreamingQuery``.

    The state belongs to ``checkpoint_dir``: runs that share it skip each
    other's links.  ``files_per_batch`` bounds a micro-batch.
    """
    if spark.conf.get(_PROVIDER, None) in (None, "org.apache.spark.sql.execution.streaming.state.HDFSBackedStateStoreProvider"):
        spark.conf.set(_PROVIDER, _ROCKSDB)  # the default keeps all keys on the heap

    def process(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{history_dir.rstrip('/')}/batch_id={batch_id}")

    stream = spark.readStream.schema(LISTING_SCHEMA)
    if files_per_batch:
        stream = stream.option("maxFilesPerTrigger", files_per_batch)
    writer = new_links(stream.parquet(source_dir)).writeStream.outputMode("update").foreachBatch(process).option("checkpointLocation", checkpoint_dir)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")
    return writer.start()
