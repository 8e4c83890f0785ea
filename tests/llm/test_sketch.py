import hashlib

import numpy as np
from pyspark.sql import functions as F

from leadforge.llm import sketch


def jaccard(a, b):
    a, b = set(sketch.digests(a)), set(sketch.digests(b))
    return len(a & b) / len(a | b) if a | b else 1.0


def test_peeling_recovers_the_difference():
    common = list(range(1000, 9000, 7))
    keys = [k * 0x9E3779B97F4A7C15 % 2**64 for k in common]
    for n in (0, 1, 5, 60, 380):
        a, b = keys[:n] + keys[800:], keys[400:400 + n] + keys[800:]
        here, there = sketch.differing(a, b, sketch.Sketch(a), sketch.Sketch(b))
        assert here == set(a) - set(b) and there == set(b) - set(a)


def test_repeated_paragraphs_count():
    assert len(set(sketch.digests("x\nx\ny. x"))) == 4
    assert sketch.digests("a. b\n\nc") == sketch.digests("a.\nb\nc\n")


def test_fingerprints(spark, docs_of):
    texts = ["One. Two. Three. Four. Five. Six. Seven. Eight.", "", None, "One. Two. Three. Four. Five. Six. Seven. Eight.", "é😀" * 50, "a\n" * 4000, "z"]
    rows = [(3 * i - 4, t) for i, t in enumerate(texts)]
    old = spark.conf.get("spark.sql.shuffle.partitions")
    for parts in ("1", "3", "8", "30"):
        spark.conf.set("spark.sql.shuffle.partitions", parts)
        got = {r["doc_id"]: r for r in sketch.fingerprints(docs_of(rows)).collect()}
        assert len(got) == len(rows)
        for k, (i, t) in enumerate(rows):
            t, after = t or "", rows[(k + 1) % len(rows)][1] or ""
            q = len(t) // 4
            new = t[:len(t) - q] + after[:q]
            r = got[i]
            assert r["n_chars"] == len(t) and r["edited_sha256"] == hashlib.sha256(new.encode()).hexdigest()
            assert abs(r["near_edited"] - jaccard(t, new)) < 1e-9 and abs(r["near_next"] - jaccard(t, after)) < 1e-9
            assert r["fingerprint"] == sketch.Sketch(sketch.digests(t)).text()
            assert r["edited_fingerprint"] == sketch.Sketch(sketch.digests(new)).text()
    spark.conf.set("spark.sql.shuffle.partitions", old)
    assert got[-4]["fingerprint"] == got[5]["fingerprint"]


def test_edge_tables(docs_of):
    assert sketch.fingerprints(docs_of([])).count() == 0
    one = sketch.fingerprints(docs_of([(5, "a. b. c. d.")])).collect()
    assert len(one) == 1 and one[0]["near_next"] == 1.0
    odd = sketch.fingerprints(docs_of([(None, "no id"), (5, "same"), (5, "same"), (5, "other"), (None, None)])).collect()
    assert len(odd) == 5


def test_many_at_once_equal_one_by_one():
    rng = np.random.default_rng(7)
    pool = [int(x) for x in rng.integers(0, 2**63, 3000)]
    pairs = []
    for n in (0, 1, 10, 30, 70, 200, 900):
        for shared in (0, 0.5, 0.9, 1):
            k = int(n * shared)
            pairs.append((pool[:n], pool[:k] + pool[1500:1500 + n - k]))
    a, b = ([np.array(x, np.uint64) for x in side] for side in zip(*pairs))
    of_a, of_b = sketch.sketches(a), sketch.sketches(b)
    assert of_a.texts() == [sketch.Sketch(x).text() for x, _ in pairs]
    got = sketch.likenesses(a, b, of_a, of_b)
    assert got.tolist() == [sketch.likeness(x, y, sketch.Sketch(x), sketch.Sketch(y)) for x, y in pairs]
    assert got.tolist() == [len(set(x) & set(y)) / len(set(x) | set(y)) if x or y else 1.0 for x, y in pairs]


def test_hot_ids_are_dealt_over_ranges(spark):
    rows = spark.range(3000).selectExpr("IF(id < 1000, NULL, IF(id < 2000, 7, id)) AS doc_id", "IF(id < 1500, '', concat('p', id, '. q')) AS text")
    old = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "12")
    out = sketch.fingerprints(rows.coalesce(2))
    sizes = [r["count"] for r in out.groupBy(F.spark_partition_id().alias("p")).count().collect()]
    got = out.collect()
    spark.conf.set("spark.sql.shuffle.partitions", old)
    assert len(got) == 3000 and max(sizes) <= 1.5 * sorted(sizes)[len(sizes) // 2]
    assert sum(r["doc_id"] is None for r in got) == 1000 and sum(r["near_next"] == 1.0 for r in got) >= 1498


def test_long_text_of_many_paragraphs(docs_of):
    long = "\n".join(f"paragraph {i}" for i in range(30_000))
    got = {r["doc_id"]: r for r in sketch.fingerprints(docs_of([(1, long), (2, long + "\nmore"), (3, "short")])).collect()}
    assert got[1]["near_next"] == 30_000 / 30_001 and got[2]["near_next"] == 0.0 and got[3]["near_next"] == 0.0


def test_short_paragraphs_that_repeat_often_have_digests_of_their_own():
    words = [a + b + "!!" for a in ("", "A", "E", "S") for b in "ABCDEFGH"]
    text = " ".join(w for w in words for _ in range(90))
    assert len(set(sketch.digests(text))) == len(sketch.paragraphs(text)) == 90 * len(words)


def test_a_digest_that_stands_twice_ends_the_search():
    a, b = [5, 5, 7, 9], [7, 11]
    assert sketch.differing(a, b, sketch.Sketch(a), sketch.Sketch(b)) == ({5, 9}, {11})
    x, y = ([np.array(k, np.uint64)] for k in (a, b))
    assert sketch.likenesses(x, y, sketch.sketches(x), sketch.sketches(y)).tolist() == [(4 - 2) / (4 + 1)]
