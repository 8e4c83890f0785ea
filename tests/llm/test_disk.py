"""What the operators leave on the disk, and counts of several blocks as one."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from leadforge.llm import collocations, jaccard
from leadforge.llm.common import stored, worker_cache


def test_shuffles_of_a_stored_table_go_with_its_write(spark):
    kept = spark.sparkContext._jsc.sc().env().mapOutputTracker().shuffleStatuses()
    before = kept.size()
    table = stored(spark.range(1000).repartition(4, "id").groupBy((F.col("id") % 7).alias("k")).count(), "disk")
    assert table.count() == 7
    assert kept.size() <= before + 1  # the count's own at most
    assert spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled") == "false"


def test_pairs_without_a_common_prefix_shingle_go_before_the_rest_is_shipped(spark):
    nodes = spark.createDataFrame([(1, [1, 2]), (2, [2, 9]), (3, [5])], "node long, second array<int>")
    pairs = spark.createDataFrame([(1, 2), (1, 3), (2, 3)], "x long, y long")
    got = jaccard._sharing(pairs, nodes, "second")
    assert got.columns == ["x", "y"] and [tuple(r) for r in got.collect()] == [(1, 2)]


def test_counts_of_several_blocks_are_one_row_a_phrase():
    a = np.array([[1, 2], [3, 4]]), np.array([5, 6])
    b = np.array([[3, 4], [1, 3]]), np.array([10, 1])
    got = collocations._summed([a, b]).to_pylist()
    assert sorted((r["w1"], r["w2"], r["n"]) for r in got) == [(1, 2, 5), (1, 3, 1), (3, 4, 16)]
    assert collocations._summed([(np.empty((0, 3), np.int64), np.empty(0, np.int64))]).num_rows == 0


def test_blocks_of_a_language_are_counted_together(spark, monkeypatch):
    kept = {}
    monkeypatch.setattr(collocations, "stored", lambda df, name: kept.setdefault(name, stored(df, name)))
    monkeypatch.setattr(collocations, "discard", lambda table: None)
    rows = [(lang, f"{lang} a b c d e f g h {lang}. {lang} a b") for _ in range(10) for lang in ("de", "en", "fr", "it")]
    docs = spark.createDataFrame(rows, "lang string, text string").repartition(4)
    before = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        collocations.frequent_phrases(docs, least=10, longest=2)
        counted = kept["relation-1"].mapInArrow(collocations._counts(None), "w1 long, w2 long, n long").collect()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", before)
    assert len(counted) == 4 * 9 and sum(r["n"] for r in counted) == 40 * 11


def test_nodes_that_meet_a_pivot_in_different_shingles_are_no_pair(docs_of, monkeypatch):
    kept = {}
    monkeypatch.setattr(jaccard, "stored", lambda df, name: kept.setdefault(name, stored(df, name)) if name in ("rest", "star") else stored(df, name))
    monkeypatch.setattr(jaccard, "discard", lambda table: None)
    parts = [[f"w{i}x{k}" for k in range(20)] for i in range(40)]
    rows = [(0, " ".join(w for p in parts for w in p))] + [(1 + i, " ".join([*p, *(f"own{i}x{k}" for k in range(5))])) for i, p in enumerate(parts)]
    got = jaccard.near_duplicates(docs_of(rows), 4, 85).collect()
    assert all(r["component_id"] == r["doc_id"] for r in got)
    assert kept["star"].count() >= 5 and kept["rest"].count() == 0


def test_a_worker_keeps_the_tables_of_one_operator():
    worker_cache("tokens")["vocabulary"] = object()
    assert worker_cache("tokens")
    worker_cache("language_id")
    assert not worker_cache("tokens")


def test_blocks_are_read_and_sent_in_small_batches(spark, monkeypatch):
    seen = {}

    def kept(df, name):
        seen[name] = [int(spark.conf.get(k)) for k in ("spark.sql.execution.arrow.maxRecordsPerBatch", "spark.sql.parquet.columnarReaderBatchSize")]
        return stored(df, name)

    monkeypatch.setattr(collocations, "stored", kept)
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    collocations.mine(spark.createDataFrame([("en", "a b c d " * 40)], "lang string, text string"), least=3).collect()
    assert all(max(seen[f"{t}"]) <= 4 for t in ("phrase-known", "relation-1", "phrases-2", "relation-2", "phrases-4")) and max(seen["phrase-words"]) <= 500
    assert spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch") == before and spark.conf.get("parquet.page.size.row.check.min", None) is None


def test_counts_leave_a_task_in_small_batches(monkeypatch):
    monkeypatch.setattr(collocations, "SENT_ROWS", 100)
    monkeypatch.setattr(collocations, "_Relation", lambda b: type("R", (), {"counted": lambda self, held: (np.arange(500).reshape(250, 2), np.ones(250, np.int64))})())
    batches = list(collocations._counts(None)([pa.RecordBatch.from_pydict({"block": [1, 2]})]))
    assert [b.num_rows for b in batches] == [100, 100, 50] and batches[0].column("n")[0].as_py() == 2


def test_links_need_no_join_with_the_nodes(spark):
    compared = spark.createDataFrame([(1, 2, 10, 20, 100, 100, 95), (1, 3, 10, 30, 100, 50, 50)], "x long, y long, x_doc long, y_doc long, x_n long, y_n long, both long")
    linked = jaccard._linked(compared, 85)
    assert [tuple(r) for r in linked.collect()] == [(1, 2, 10, 20)]
    assert "Join" not in linked._jdf.queryExecution().optimizedPlan().toString()
