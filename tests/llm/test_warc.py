import gzip
import hashlib
import zlib

import pytest

from leadforge.llm import warc

LONG = "<p>ééé </p>" * 200


def rows_of():
    rows = [(i, f"http://h/{i % 7} x\n", f"<html>{i}" + "é" * (i * 37 % 1500)) for i in range(300)]
    rows += [(1000 + i, "http://copy/", LONG) for i in range(40)] + [(2000 + i, None, "short") for i in range(5)]
    rows += [(50, "u", LONG), (1039, "again", LONG), (1039, "again", LONG), (None, None, None), (None, "n", LONG), (None, "n", "z" * 1200), (3000, "", None),
             (4000, "edge", "a" * 1000), (4001, "edge", "a" * 1000), (4002, "edge", "b" * 999), (4003, "edge", "b" * 999)]
    return rows


def brute(rows):
    best, first = {}, {}
    for n, (i, _, h) in enumerate(rows):
        p = (h or "").encode()
        if len(p) >= 1000 and (p not in best or (i if i is not None else -1) > (best[p] if best[p] is not None else -1)):
            best[p], first[p] = i, n
    out = []
    for n, (i, _, h) in enumerate(rows):
        p = (h or "").encode()
        same = sum(1 for _, _, g in rows if (g or "").encode() == p) > 1 and len(p) >= 1000
        kind = "revisit" if same and first[p] != n else "response"
        out.append((i, len(p), hashlib.sha1(p).hexdigest(), kind, best[p] if kind == "revisit" else None))
    return sorted(out, key=str)


@pytest.fixture(scope="module")
def written(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("warc"))
    pages = spark.createDataFrame(rows_of(), "page_id long, url string, html string").coalesce(1).selectExpr("*", "7 AS part", "7 AS ordinal", "'x' AS payload", "'y' AS key")
    manifest = warc.write_warc(pages, path, roll=20_000, range_bytes=50_000)
    return path, manifest


def test_equals_brute_force_read_back(spark, written):
    path, manifest = written
    got = warc.read_warc(spark, path).collect()
    assert sorted([(r["page_id"], r["payload_bytes"], r["payload_digest"], r["record_type"], r["refers_to"]) for r in got], key=str) == brute(rows_of())
    whole = {(r["page_id"], bytes(r["payload"])) for r in got if r["payload"] is not None}
    assert whole == {(i, (h or "").encode()) for i, _, h in rows_of() if not ((h or "") == LONG and i != 1039) and (i, h) != (4000, "a" * 1000)}
    # A revisit's record id is that of a response, and ids are unique.
    ids = [r["record_id"] for r in got]
    responses = {r["record_id"]: r["page_id"] for r in got if r["record_type"] == "response"}
    assert len(set(ids)) == len(ids)
    assert all(responses[r["refers_to_id"]] == r["refers_to"] for r in got if r["record_type"] == "revisit")
    assert {r["url"] for r in got if r["page_id"] == 3} == {"http://h/3%20x%0A"}


def test_archives_are_sorted_rolled_and_plain_gzip(written):
    path, manifest = written
    files = sorted(manifest.collect(), key=lambda r: r["file"])
    assert len(files) > 8 and all(r["bytes"] <= 20_000 or r["records"] == 1 for r in files)
    spans = [(r["first_id"], r["last_id"]) for r in files if r["first_id"] is not None]
    assert all(a <= b for a, b in spans) and all(x[1] <= y[0] for x, y in zip(spans, spans[1:]))
    data = gzip.open(f"{path}/data/{files[0]['file']}").read()
    assert data.startswith(b"WARC/1.1\r\nWARC-Type: warcinfo") and data.endswith(b"\r\n\r\n")


def test_two_runs_write_equal_bytes_and_commit_may_run_again(spark, written, tmp_path):
    path, manifest = written
    pages = spark.createDataFrame(rows_of(), "page_id long, url string, html string").coalesce(1)
    again = warc.write_warc(pages, str(tmp_path), roll=20_000, range_bytes=50_000)
    named = lambda m: sorted((r["file"], r["sha256"]) for r in m.collect())
    assert named(manifest) == named(again)
    assert named(warc.commit(spark, str(tmp_path))) == named(manifest)
    assert not (tmp_path / "_temporary").exists()


def test_damage_is_found(spark, tmp_path):
    pages = spark.createDataFrame(rows_of()[:20], "page_id long, url string, html string")
    name = warc.write_warc(pages, str(tmp_path)).first()["file"]
    f = tmp_path / "data" / name
    f.write_bytes(f.read_bytes()[:-40])
    with pytest.raises(Exception, match="ends inside a record|is not what the manifest says"):
        warc.read_warc(spark, str(tmp_path)).collect()
    record = warc.page_record(1, 0, "u", b"abc", None)
    with pytest.raises(ValueError, match="digest"):
        warc.parse(record.replace(b"abc", b"abd"))


def test_empty_table(spark, tmp_path):
    pages = spark.createDataFrame([], "page_id long, url string, html string")
    assert warc.write_warc(pages, str(tmp_path)).count() == 0
    assert warc.read_warc(spark, str(tmp_path)).count() == 0


def test_members_over_any_chunking():
    records = [b"a" * 1000, b"", b"bc" * 500]
    data = b"".join(map(warc.compress, records))
    for n in (1, 7, 10_000):
        assert list(warc.members(data[i:i + n] for i in range(0, len(data), n))) == records
    assert zlib.decompress(warc.compress(b"x"), 31) == b"x"


def test_hot_id_is_split_over_ranges(spark):
    facts = spark.range(3000).selectExpr("CAST(IF(id < 2000, 5, id) AS long) AS key", "id AS ordinal", "100L AS bytes")
    bounds = warc._bounds(facts, 50_000)
    sizes = [r["count"] for r in facts.select(warc._range_of(bounds)("key", "ordinal").alias("p")).groupBy("p").count().collect()]
    assert len(sizes) >= 20 and max(sizes) <= 3 * 3000 / len(sizes)
