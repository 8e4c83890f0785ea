"""WARC archives of pages: deterministic, range-sorted, rolled by compressed size.

``write_warc`` makes gzip archives (one member a record, WARC 1.1) below a folder:

``data/part-RRRRR-SSSSS.warc.gz``  the archives: ascending page ids over the
    files' names, a ``warcinfo`` record first in each.
``manifest``                       a Parquet table with a row per archive:
    ``file, part, seq, bytes, records, first_id, last_id, sha256``.

1. A narrow table holds each row's payload length and SHA-1 (JVM functions).
   Of the rows of equal payloads from ``MIN_REVISIT`` bytes on, a grouped
   maximum names the response; the others are revisits of it.
2. Range bounds are cut from a hash sample of that table, by bytes (``SAMPLED``
   rows a range, at most ``MAX_RANGES`` ranges).  Pages and the decisions on
   revisits travel to their range in one shuffle and are sorted there; a
   decision stands just ahead of its page, so no join moves a payload.
3. A task streams its range: it regenerates headers and digests, compresses
   each record and starts a new file once one would pass ``ROLL_BYTES``.  Files
   get names of their own attempt in ``_temporary``; a task's rows of the
   pending manifest count only if Spark commits the task.
4. ``commit`` moves the files that the pending manifest names to their final
   names and then writes the manifest.  It may be run again after a failure:
   a file that has moved already is left alone.  Readers see what the manifest
   names; files of lost or speculative attempts are never in it.

The folder must be one that the driver's and the executors' Python reach through
``pyarrow.fs`` (a mounted folder, ``hdfs:``, ``s3:``, ``gs:``).  ``pages`` has to
be a table scan, or another DataFrame that gives the same rows in the same order
when a partition is computed again.

Edge cases: null html is an empty payload; null ids come first, have no page id
header and are null in ``refers_to``; rows of one id stay in table order, and of
equal rows of the largest id the first is the response; null urls become
``urn:page:ID``, and white space and control characters of urls are
percent-encoded; an empty table gives no archive and an empty manifest; a page
is one record, whatever its length, and is held by one task as a whole; further
columns of the input are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType

from .common import shuffle_partitions, slices, stored

MIN_REVISIT = 1000
ROLL_BYTES = 64 << 20
#: Payload bytes of a range, ranges at most, sampled rows a range.
RANGE_BYTES, MAX_RANGES, SAMPLED = 256 << 20, 1 << 16, 16
LEVEL = 6
DATE = "1970-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

_LOW = -(1 << 63)
_PENDING = pa.schema([("file", pa.string()), ("temporary", pa.string()), ("part", pa.int32()), ("seq", pa.int32()), ("bytes", pa.int64()),
                      ("records", pa.int64()), ("first_id", pa.int64()), ("last_id", pa.int64()), ("sha256", pa.string())])
PENDING = "file string, temporary string, part int, seq int, bytes long, records long, first_id long, last_id long, sha256 string"
_READ = pa.schema([("file", pa.string()), ("record_id", pa.string()), ("record_type", pa.string()), ("page_id", pa.int64()), ("url", pa.string()),
                   ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("refers_to", pa.int64()), ("refers_to_id", pa.string()), ("payload", pa.binary())])
READ = ("file string, record_id string, record_type string, page_id long, url string, payload_bytes long, payload_digest string, "
        "refers_to long, refers_to_id string, payload binary")


# ---- records

def _sha1(data: bytes) -> str:
    return "sha1:" + base64.b32encode(hashlib.sha1(data).digest()).decode()


def _urn(*name: object) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, '/'.join(map(str, name)))}>"


def _uri(url: str | None, page_id: int | None) -> str:
    if not url:
        return f"urn:page:{'' if page_id is None else page_id}"
    return re.sub(r"[\x00-\x20\x7f-\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]", lambda m: "".join(f"%{b:02X}" for b in m[0].encode()), url)


def _record(headers: list[tuple[str, object]], block: bytes) -> bytes:
    lines = ["WARC/1.1", *(f"{k}: {v}" for k, v in headers if v is not None), f"Content-Length: {len(block)}", "", ""]
    return "\r\n".join(lines).encode() + block + b"\r\n\r\n"


def _http(n_bytes: int) -> bytes:
    return f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {n_bytes}\r\n\r\n".encode()


def info_record(name: str) -> bytes:
    block = b"format: WARC File Format 1.1\r\n"
    return _record([("WARC-Type", "warcinfo"), ("WARC-Record-ID", _urn("info", name)), ("WARC-Date", DATE), ("WARC-Filename", name),
                    ("Content-Type", "application/warc-fields")], block)


def page_record(page_id: int | None, ordinal: int, url: str | None, payload: bytes, target: tuple | None, least: int = MIN_REVISIT) -> bytes:
    """``target``: None for a response, else ``(page id of the response,)``.
    One payload of ``least`` bytes has one response, so its digest names it."""
    digest = _sha1(payload)
    head = _http(len(payload))
    of_payload = _urn("payload", digest)
    own = of_payload if target is None and len(payload) >= least else _urn("page", page_id, ordinal)
    block = head + payload if target is None else head
    return _record([
        ("WARC-Type", "response" if target is None else "revisit"), ("WARC-Record-ID", own), ("WARC-Date", DATE), ("WARC-Target-URI", _uri(url, page_id)),
        ("WARC-Profile", None if target is None else PROFILE), ("WARC-Refers-To", None if target is None else of_payload),
        ("WARC-Payload-Digest", digest), ("WARC-Block-Digest", _sha1(block)), ("X-Page-Id", page_id), ("X-Refers-To-Page-Id", target and target[0]),
        ("Content-Type", "application/http; msgtype=response")], block)


def compress(record: bytes, level: int = LEVEL) -> bytes:
    """A gzip member without time or name: equal records give equal bytes."""
    c = zlib.compressobj(level, zlib.DEFLATED, 31)
    return c.compress(record) + c.flush()


def parse(record: bytes) -> tuple[dict[str, str], bytes]:
    """(headers in lower case, block); raises where length or digest are off."""
    head, sep, rest = record.partition(b"\r\n\r\n")
    first, *lines = head.decode().split("\r\n")
    headers = {k.lower(): v for k, _, v in (x.partition(": ") for x in lines)}
    block, end = rest[:-4], rest[-4:]
    if not sep or not first.startswith("WARC/") or end != b"\r\n\r\n" or len(block) != int(headers["content-length"]):
        raise ValueError(f"broken WARC record {headers.get('warc-record-id')}")
    if headers.get("warc-block-digest", (own := _sha1(block))) != own:
        raise ValueError(f"block digest of {headers['warc-record-id']} is wrong")
    return headers, block


def members(chunks: Iterable[bytes]) -> Iterator[bytes]:
    """The uncompressed members of a gzip stream, one at a time."""
    d, out = zlib.decompressobj(31), []
    for chunk in chunks:
        while chunk:
            out.append(d.decompress(chunk))
            chunk = d.unused_data
            if d.eof:
                yield b"".join(out)
                d, out = zlib.decompressobj(31), []
    if out and any(out):
        raise ValueError("the archive ends inside a record")


# ---- files

def _filesystem(path: str) -> tuple[pafs.FileSystem, str]:
    local = re.match(r"(?:file:/*)?(/.*)|file:/+(.*)", path)
    return (pafs.LocalFileSystem(), "/" + (local[1] or local[2]).lstrip("/")) if local else pafs.FileSystem.from_uri(path)


class _Roll:
    """The files of one task: each is streamed out under a temporary name."""

    def __init__(self, path: str, part: int, roll: int, level: int):
        self.fs, self.root = _filesystem(path)
        self.part, self.roll, self.level, self.seq, self.attempt, self.out, self.done = part, roll, level, 0, uuid.uuid4().hex, None, []
        self.fs.create_dir(f"{self.root}/_temporary", recursive=True)

    def _open(self) -> None:
        self.row = {"file": (name := f"part-{self.part:05d}-{self.seq:05d}.warc.gz"), "temporary": f"{name}.{self.attempt}", "part": self.part, "seq": self.seq,
                    "bytes": 0, "records": 0, "first_id": None, "last_id": None}
        self.out, self.sum = self.fs.open_output_stream(f"{self.root}/_temporary/{self.row['temporary']}", compression=None), hashlib.sha256()
        self._put(compress(info_record(name), self.level))

    def _put(self, member: bytes) -> None:
        self.out.write(member)
        self.sum.update(member)
        self.row["bytes"] += len(member)

    def add(self, page_id: int | None, member: bytes) -> None:
        if self.out is not None and self.row["records"] and self.row["bytes"] + len(member) > self.roll:
            self.close()
        if self.out is None:
            self._open()
        self._put(member)
        self.row["records"] += 1
        if page_id is not None:
            self.row["first_id"] = page_id if self.row["first_id"] is None else self.row["first_id"]
            self.row["last_id"] = page_id

    def close(self) -> None:
        if self.out is not None:
            self.out.close()
            self.done.append(self.row | {"sha256": self.sum.hexdigest()})
            self.seq, self.out = self.seq + 1, None


def _writer(path: str, roll: int, level: int, least: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, target = _Roll(path, TaskContext.get().partitionId(), roll, level), None
        for b in slices(batches, 100):
            for page_id, ordinal, url, payload, refers_to in zip(*(b.column(c).to_pylist() for c in ("page_id", "ordinal", "url", "payload", "refers_to"))):
                if payload is None:  # the decision on the next row
                    target = (refers_to,)
                    continue
                files.add(page_id, compress(page_record(page_id, ordinal, url, payload, target, least), level))
                target = None
        files.close()
        yield pa.RecordBatch.from_pylist(files.done, schema=_PENDING)

    return run


# ---- jobs

def _bounds(facts: DataFrame, range_bytes: int) -> list[tuple[int, int]]:
    """The first ``(id, ordinal)`` of every range but the first."""
    weight = F.col("bytes") + 500
    n, total = facts.agg(F.count("*"), F.sum(weight)).first()
    ranges = min(MAX_RANGES, max(-(-(total or 0) // range_bytes), min(n, shuffle_partitions(facts.sparkSession))))
    every = max(1, n // (SAMPLED * max(1, ranges)))
    picked = facts.filter(F.pmod(F.xxhash64("key", "ordinal"), F.lit(every)) == 0).select("key", "ordinal", weight.alias("w")).collect()
    rows = sorted((r["key"], r["ordinal"], r["w"]) for r in picked)
    if not rows:
        return []
    share = np.cumsum([w for *_, w in rows])
    cuts = np.searchsorted(share, share[-1] * np.arange(1, ranges) / ranges, side="left")
    return sorted({rows[i][:2] for i in cuts if i > 0})


def _range_of(bounds: list[tuple[int, int]]):
    ids, ordinals = (np.array([b[i] for b in bounds], np.int64) for i in (0, 1))

    @F.pandas_udf(IntegerType())
    def range_of(key: pd.Series, ordinal: pd.Series) -> pd.Series:
        k, o = key.to_numpy(), ordinal.to_numpy()
        low, high = np.searchsorted(ids, k, "left"), np.searchsorted(ids, k, "right")
        for i in np.unique(k[low < high]):  # an id that stands in several ranges
            own = k == i
            a, z = np.searchsorted(ids, i, "left"), np.searchsorted(ids, i, "right")
            low[own] = a + np.searchsorted(ordinals[a:z], o[own], "right")
        return pd.Series(low.astype(np.int32))

    return range_of


def revisits(facts: DataFrame, least: int = MIN_REVISIT) -> DataFrame:
    """``key, page_id, ordinal, refers_to`` of the rows whose payload of
    ``least`` bytes another row has as its response."""
    long = facts.filter(F.col("bytes") >= least)
    # Largest id first, then the first row of it.
    groups = (long.groupBy("digest", "bytes").agg(F.count("*").alias("n"), F.max(F.struct("key", (-F.col("ordinal")).alias("back"), "page_id")).alias("best"))
              .filter("n > 1").select("digest", "bytes", "best"))
    return (long.join(groups, ["digest", "bytes"]).filter((F.col("key") != F.col("best.key")) | (F.col("ordinal") != -F.col("best.back")))
            .select("key", "page_id", "ordinal", F.col("best.page_id").alias("refers_to")))


def write_warc(pages: DataFrame, path: str, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", least: int = MIN_REVISIT,
               roll: int = ROLL_BYTES, range_bytes: int = RANGE_BYTES, level: int = LEVEL) -> DataFrame:
    """Writes the archives and returns the manifest."""
    spark = pages.sparkSession
    page_id = F.col(id_col).cast("long")
    rows = pages.select(page_id.alias("page_id"), F.coalesce(page_id, F.lit(_LOW)).alias("key"), F.monotonically_increasing_id().alias("ordinal"),
                        F.col(url_col).cast("string").alias("url"), F.encode(F.coalesce(F.col(html_col).cast("string"), F.lit("")), "UTF-8").alias("payload"))
    facts = stored(rows.select("page_id", "key", "ordinal", F.octet_length("payload").cast("long").alias("bytes"), F.sha1("payload").alias("digest")), "warc-facts")
    bounds = _bounds(facts, range_bytes)
    known = revisits(facts, least).select("page_id", "key", "ordinal", F.lit(None).cast("string").alias("url"), F.lit(None).cast("binary").alias("payload"), "refers_to")
    dealt = rows.withColumn("refers_to", F.lit(None).cast("long")).unionByName(known)
    (dealt.withColumn("part", _range_of(bounds)("key", "ordinal")).repartitionById(len(bounds) + 1, F.col("part"))
     .sortWithinPartitions("key", "ordinal", F.col("payload").isNotNull())
     .select("page_id", "ordinal", "url", "payload", "refers_to").mapInArrow(_writer(path, roll, level, least), PENDING)
     .write.mode("overwrite").parquet(f"{path}/_pending"))
    return commit(spark, path)


def commit(spark: SparkSession, path: str) -> DataFrame:
    """Moves the files of the pending manifest to their names, writes the
    manifest, and removes what other attempts left."""

    def move(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, root = _filesystem(path)
        fs.create_dir(f"{root}/data", recursive=True)
        for b in batches:
            for r in b.to_pylist():
                old, new = f"{root}/_temporary/{r['temporary']}", f"{root}/data/{r['file']}"
                here, there = fs.get_file_info([old, new])
                if here.type == pafs.FileType.File:
                    fs.move(old, new)
                elif there.type != pafs.FileType.File or there.size != r["bytes"]:
                    raise ValueError(f"{r['file']} of the pending manifest is gone")
            yield b.drop_columns(["temporary"])

    pending = spark.read.schema(PENDING).parquet(f"{path}/_pending")
    columns = [f for f in pending.schema.fieldNames() if f != "temporary"]
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in pending.schema if f.name in columns)
    pending.mapInArrow(move, schema).write.mode("overwrite").parquet(f"{path}/manifest")
    fs, root = _filesystem(path)
    if fs.get_file_info(f"{root}/_temporary").type == pafs.FileType.Directory:
        fs.delete_dir(f"{root}/_temporary")
    return spark.read.schema(schema).parquet(f"{path}/manifest")


def _page(file: str, headers: dict[str, str], block: bytes, payloads: bool) -> tuple:
    head, _, payload = block.partition(b"\r\n\r\n")
    kind, digest = headers["warc-type"], headers["warc-payload-digest"]
    if kind == "response" and _sha1(payload) != digest:
        raise ValueError(f"payload digest of {headers['warc-record-id']} is wrong")
    size = len(payload) if kind == "response" else int(re.search(rb"\r\nContent-Length: (\d+)", head)[1])
    number = lambda name: int(headers[name]) if name in headers else None
    return (file, headers["warc-record-id"], kind, number("x-page-id"), headers["warc-target-uri"], size, base64.b32decode(digest[5:]).hex(),
            number("x-refers-to-page-id"), headers.get("warc-refers-to"), payload if payloads and kind == "response" else None)


def read_warc(spark: SparkSession, path: str, payloads: bool = True) -> DataFrame:
    """A row for each page record of the archives that the manifest names:
    ``file, record_id, record_type, page_id, url, payload_bytes, payload_digest
    (hex), refers_to (page id), refers_to_id (record id), payload`` (null for
    revisits, and for all without ``payloads``).  Archives are streamed; their
    lengths and sums, and all records' digests, are verified."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, root = _filesystem(path)
        for b in batches:
            for r in b.to_pylist():
                check, seen, rows, held = hashlib.sha256(), 0, [], 0

                def chunks():
                    with fs.open_input_stream(f"{root}/data/{r['file']}", compression=None) as f:
                        while data := f.read(1 << 20):
                            check.update(data)
                            yield data

                for record in members(chunks()):
                    headers, block = parse(record)
                    if headers["warc-type"] == "warcinfo":
                        continue
                    rows.append(_page(r["file"], headers, block, payloads))
                    seen, held = seen + 1, held + len(rows[-1][-1] or b"")
                    if len(rows) >= 5000 or held > 8 << 20:
                        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), _READ)], schema=_READ)
                        rows, held = [], 0
                if (seen, check.hexdigest()) != (r["records"], r["sha256"]):
                    raise ValueError(f"{r['file']} is not what the manifest says")
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(list(zip(*rows)) or [[]] * len(_READ), _READ)], schema=_READ)

    manifest = spark.read.parquet(f"{path}/manifest").select("file", "records", "sha256")
    return manifest.repartition(shuffle_partitions(spark)).mapInArrow(run, READ)
