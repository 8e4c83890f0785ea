"""Cross-run seen-URL dedup as a stream: a link seen in an earlier batch is
not emitted again; within a batch the first occurrence wins."""

import os
import tempfile

from pyspark.sql import functions as F

from conftest import SF_SMALL
from leadforge.sources import fixtures as FX
from leadforge.streaming.seen_links import LISTING_SCHEMA, new_links, start


def test_stream_drops_links_seen_in_earlier_batches(spark):
    root = tempfile.mkdtemp(prefix="leadforge-stream-")
    src, hist, ckpt = (os.path.join(root, d) for d in ("src", "hist", "ckpt"))
    cfg = FX.fixture_sector_config(spark, SF_SMALL).select("sector", "sector_ord")
    pages = FX.listing_pages(spark, SF_SMALL).join(cfg, "sector").select(
        "sector", F.col("sector_ord").cast("int"), F.col("page_no").cast("int"), "url", "html")

    pages.filter("page_no = 1").write.mode("append").parquet(src)
    q = start(spark, src, hist, ckpt)
    q.awaitTermination()
    pages.filter("page_no = 2").write.mode("append").parquet(src)
    q = start(spark, src, hist, ckpt)
    q.awaitTermination()

    out = spark.read.parquet(hist)
    assert out.select("batch_id").distinct().count() == 2
    # each URL emitted once over both runs
    assert out.count() == out.select("company_url").distinct().count()
    # page 2 starts with page 1's last company: it must not be emitted again
    run2 = out.filter(F.col("batch_id") == 1)
    assert run2.filter(F.col("page_no") == 2).filter(F.col("link_pos") == 1).count() == 0
    assert run2.count() > 0


def _page(spark, rows):
    html = lambda urls: "<html><body>" + "".join(f'<a data-test="company-name" href="{u}">Co {u[-4:]}</a>' for u in urls) + "</body></html>"
    return spark.createDataFrame([(s, o, p, f"http://dir/{s}/{p}", html(urls)) for s, o, p, urls in rows], LISTING_SCHEMA).coalesce(1)


def test_first_occurrence_of_a_batch_wins_and_hot_urls_are_one(spark):
    root = tempfile.mkdtemp(prefix="leadforge-stream-")
    src, hist, ckpt = (os.path.join(root, d) for d in ("src", "hist", "ckpt"))
    hot = "http://c/hot0"
    rows = [("b", 2, p, [hot, f"http://c/b{p:03d}"]) for p in range(40)] + [("a", 1, p, [f"http://c/a{p:03d}", hot]) for p in range(40)]
    _page(spark, rows).write.parquet(src)
    start(spark, src, hist, ckpt).awaitTermination()
    _page(spark, [("a", 0, 0, [hot, "http://c/a000", "http://c/new0"])]).write.mode("append").parquet(src)
    start(spark, src, hist, ckpt).awaitTermination()
    got = spark.read.parquet(hist)
    first = got.filter(F.col("company_url") == hot).collect()
    assert [(r["batch_id"], r["sector"], r["page_no"], r["link_pos"]) for r in first] == [(0, "a", 0, 2)]
    assert got.filter("batch_id = 0").count() == 81
    assert [r["company_url"] for r in got.filter("batch_id = 1").collect()] == ["http://c/new0"]


def test_time_of_a_batch_does_not_grow(spark):
    """50 batches; a batch's own work (reading, state, writing) is constant."""
    root = tempfile.mkdtemp(prefix="leadforge-stream-")
    src, hist, ckpt = (os.path.join(root, d) for d in ("src", "hist", "ckpt"))
    old = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "1")
    for n in range(50):  # half of each batch's links are new
        urls = [f"http://c/{n // 2 * 40 + i:06d}" for i in range(80)]
        _page(spark, [("s", 1, n, urls)]).write.mode("append").parquet(src)
    q = start(spark, src, hist, ckpt, files_per_batch=1)
    q.awaitTermination()
    spark.conf.set("spark.sql.shuffle.partitions", old)
    took = [p["durationMs"]["addBatch"] for p in q.recentProgress if p["numInputRows"]]
    state = [p["stateOperators"][0]["numRowsTotal"] for p in q.recentProgress if p["numInputRows"]]
    assert len(took) == 50 and state[-1] > 10 * state[0]
    median = lambda x: sorted(x)[len(x) // 2]
    assert median(took[-15:]) <= 1.5 * median(took[5:20])
    out = spark.read.parquet(hist)
    assert out.count() == out.select("company_url").distinct().count() == 24 * 40 + 80


def test_a_url_costs_no_python(spark):
    """A call of Python per URL held gigabytes in an executor's workers."""
    root = tempfile.mkdtemp(prefix="leadforge-stream-")
    plan = new_links(spark.readStream.schema(LISTING_SCHEMA).parquet(root))._jdf.queryExecution().analyzed().toString()
    assert "MapInArrow" in plan and "Aggregate" in plan
    assert "FlatMapGroups" not in plan and "MapInPandas" not in plan


def test_null_and_repeated_links_count_once_across_batches(spark):
    root = tempfile.mkdtemp(prefix="leadforge-stream-")
    src, hist, ckpt = (os.path.join(root, d) for d in ("src", "hist", "ckpt"))
    for rows in ([("b", None, 2, ["http://c/1", "http://c/1"])], [("a", 1, 1, ["http://c/1", "http://c/2"])], [("a", 1, 1, ["http://c/2", "http://c/1"])]):
        _page(spark, rows).write.mode("append").parquet(src)
        start(spark, src, hist, ckpt).awaitTermination()
    got = spark.read.parquet(hist).select("batch_id", "company_url", "sector", "page_no", "link_pos").collect()
    assert sorted(map(tuple, got)) == [(0, "http://c/1", "b", 2, 1), (1, "http://c/2", "a", 1, 2)]
