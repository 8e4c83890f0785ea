"""Structured Streaming: cross-run seen-URL dedup (D3 across runs).

The query streams the whole synthesised listing crawl in two arrivals: the
first pages of every sector, then all later pages.  Each arrival is one
``availableNow`` run of ``streaming.seen_links``; the result is the seen-URL
history it wrote (``batch_id`` 0 and 1).  Source, history and stream
checkpoint live in a fresh folder under ``spark.checkpoint.dir``.
"""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from leadforge.plans.fixture_sql import with_base
from leadforge.session import ensure_checkpoint_dir
from leadforge.sources import fixtures as FX
from leadforge.streaming.seen_links import start


def stream_new_links(spark, sf_dir):
    """Company links emitted by each stream batch (each URL once overall)."""
    base = f"{ensure_checkpoint_dir(spark).rstrip('/')}/leadforge-stream-{uuid.uuid4().hex}"
    cfg = FX.fixture_sector_config(spark, sf_dir).select("sector", "sector_ord")
    pages = FX.crawl(spark, sf_dir)[0].join(cfg, "sector").select(
        "sector", F.col("sector_ord").cast("int"), F.col("page_no").cast("int"), "url", "html")
    src, hist, ckpt = f"{base}/src", f"{base}/hist", f"{base}/ckpt"
    pages.filter(F.col("page_no") == 1).write.mode("append").parquet(src)
    start(spark, src, hist, ckpt).awaitTermination()
    pages.filter(F.col("page_no") > 1).write.mode("append").parquet(src)
    start(spark, src, hist, ckpt).awaitTermination()
    return spark.read.parquet(hist).select(
        F.col("batch_id").cast("int").alias("batch_id"), "sector", "company_url",
        F.col("page_no").cast("int").alias("page_no"), F.col("link_pos").cast("int").alias("link_pos"), "name")


QUERIES = {"stream_new_links": stream_new_links}

_FIRST = """
  SELECT company_url, arg_min(sector, (sector_ord, page_no, link_pos)) AS sector,
         arg_min(page_no, (sector_ord, page_no, link_pos)) AS page_no,
         arg_min(link_pos, (sector_ord, page_no, link_pos)) AS link_pos,
         arg_min(name, (sector_ord, page_no, link_pos)) AS name
  FROM (SELECT l.*, s.sector_ord FROM links l JOIN sec s ON s.sector = l.sector WHERE {cond})
  GROUP BY company_url
"""

ORACLES = {
    "stream_new_links": with_base(f"""
        SELECT CAST(0 AS INTEGER) AS batch_id, sector, company_url, page_no, link_pos, name
        FROM ({_FIRST.format(cond="l.page_no = 1")})
        UNION ALL
        SELECT CAST(1 AS INTEGER), sector, company_url, page_no, link_pos, name
        FROM ({_FIRST.format(cond="l.page_no > 1")})
        WHERE company_url NOT IN (SELECT company_url FROM links WHERE page_no = 1)
    """),
}
