"""Token-ID files: separately compressed documents under one shared dictionary.

A token file set is two Parquet tables below one folder:

``dictionary``  ``dict_hash, dictionary``: one zstandard dictionary, trained
    on a bounded sample of serialised id arrays.
``blocks``      up to ``BLOCK_DOCS`` documents a row, in ascending id order:
    ``shard, block, shard_start, n_ids, first_id, last_id, width, dict_hash``,
    the index arrays ``doc_ids, counts, offsets`` and the ``body``, where the
    document ``i`` is the zstandard frame ``body[offsets[i]:offsets[i+1]]``.

Spark writes both, so the files go to any store that Spark writes to, task
retries and lost executors included.  A short document is read by fetching
its block (Parquet statistics on first_id/last_id) and one frame of it.

Edge cases: null text is an empty document (its end id only); null ids sort
first; equal ids keep one row each, ordered by their compressed bytes; an
empty table gives empty tables; further columns of the input are ignored.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import hash_sample, shuffle_partitions, slices, stored
from .tokens import piece_encoder

#: The dictionary is trained on at most so many documents, of each the first
#: so many code points (only the dictionary: every document is stored whole).
SAMPLE_DOCS, SAMPLE_CHARS, DICT_BYTES = 2048, 4096, 65_536
BLOCK_DOCS, BLOCK_BYTES = 512, 1 << 20
LEVEL = 3

FRAMES = "doc_id long, tie long, n_ids long, width int, frame binary"
BLOCKS = ("shard int, block int, shard_start long, n_ids long, first_id long, last_id long, width array<int>, "
          "dict_hash string, doc_ids array<long>, counts array<long>, offsets array<long>, body binary")


def serialise(ids: np.ndarray) -> tuple[int, bytes]:
    """(bytes an id takes, little-endian array): two bytes where all ids fit."""
    width = 2 if not len(ids) or int(ids.max()) < 1 << 16 else 4
    return width, ids.astype(f"<u{width}").tobytes()


def train_dictionary(samples: Sequence[bytes], size: int = DICT_BYTES) -> bytes:
    """A zstandard dictionary; b"" (none) when there is nothing to learn from."""
    samples = [s for s in samples if len(s) >= 8]
    while samples and size >= 1024:
        try:
            return zstandard.train_dictionary(size, samples).as_bytes()
        except zstandard.ZstdError:  # too few samples for this size
            size //= 2
    return b""


def sample_dictionary(docs: DataFrame, vocab: str, text_col: str = "text", id_col: str = "doc_id") -> bytes:
    """Trained on one document of each of ``SAMPLE_DOCS`` buckets of id hashes."""
    text = F.substring(F.coalesce(F.col(text_col).cast("string"), F.lit("")), 1, SAMPLE_CHARS).alias("_t")
    rows = sorted(hash_sample(docs, F.col(id_col).cast("string"), SAMPLE_DOCS, [], [text]), key=lambda r: r["_h"])
    return train_dictionary([serialise(np.frombuffer(b, "<u4"))[1] for b in piece_encoder(vocab).encode_batch([r["_t"] for r in rows])])


def _codec(dictionary: bytes, compress: bool):
    own = zstandard.ZstdCompressionDict(dictionary) if dictionary else None
    if compress:
        if own:
            own.precompute_compress(level=LEVEL)
            return zstandard.ZstdCompressor(dict_data=own, write_content_size=True)
        return zstandard.ZstdCompressor(level=LEVEL, write_content_size=True)
    return zstandard.ZstdDecompressor(dict_data=own) if own else zstandard.ZstdDecompressor()


def compressed_documents(docs: DataFrame, dictionary: bytes, vocab: str, end_id: int,
                         text_col: str = "text", id_col: str = "doc_id") -> DataFrame:
    """One frame per document: its ids and ``end_id``, compressed by itself."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc, pack = piece_encoder(vocab), _codec(dictionary, True)
        end = end_id.to_bytes(4, "little")
        for batch in slices(batches):
            n_ids, widths, frames, ties = [], [], [], []
            for raw in enc.encode_column(batch.column(1)):
                width, data = serialise(np.frombuffer(raw + end, "<u4"))
                frame = pack.compress(data)
                n_ids.append(len(raw) // 4 + 1)
                widths.append(width)
                frames.append(frame)
                ties.append(int.from_bytes(hashlib.blake2b(frame, digest_size=8).digest(), "little", signed=True))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).cast(pa.int64()), pa.array(ties, pa.int64()), pa.array(n_ids, pa.int64()),
                 pa.array(widths, pa.int32()), pa.array(frames, pa.binary())],
                names=["doc_id", "tie", "n_ids", "width", "frame"])

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text")).mapInArrow(run, FRAMES)


def _blocks(dict_hash: str):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, block, start = TaskContext.get().partitionId(), 0, 0
        ids, counts, widths, frames, size = [], [], [], [], 0

        def flush():
            nonlocal block, start, ids, counts, widths, frames, size
            known = [i for i in ids if i is not None]
            row = {"shard": shard, "block": block, "shard_start": start, "n_ids": sum(counts),
                   "first_id": min(known, default=None), "last_id": max(known, default=None), "width": widths,
                   "dict_hash": dict_hash, "doc_ids": ids, "counts": counts,
                   "offsets": np.concatenate([[0], np.cumsum([len(f) for f in frames])]).tolist(), "body": b"".join(frames)}
            block, start = block + 1, start + row["n_ids"]
            ids, counts, widths, frames, size = [], [], [], [], 0
            return pa.RecordBatch.from_pylist([row], schema=BLOCK_ARROW)

        for batch in batches:
            for i, n, w, f in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "n_ids", "width", "frame"))):
                ids.append(i), counts.append(n), widths.append(w), frames.append(f)
                size += len(f)
                if len(ids) >= BLOCK_DOCS or size >= BLOCK_BYTES:
                    yield flush()
        if ids:
            yield flush()

    return run


BLOCK_ARROW = pa.schema([
    ("shard", pa.int32()), ("block", pa.int32()), ("shard_start", pa.int64()), ("n_ids", pa.int64()),
    ("first_id", pa.int64()), ("last_id", pa.int64()), ("width", pa.list_(pa.int32())), ("dict_hash", pa.string()),
    ("doc_ids", pa.list_(pa.int64())), ("counts", pa.list_(pa.int64())), ("offsets", pa.list_(pa.int64())), ("body", pa.binary())])


def write_token_files(docs: DataFrame, path: str, vocab: str, end_id: int = 0,
                      text_col: str = "text", id_col: str = "doc_id") -> None:
    """Encode every whole text, order by id, write the two tables below ``path``.

    The texts are encoded once, where they are scanned; the compressed frames
    are stored, and only they are dealt by id range (the range bounds are
    sampled from the stored ids, not by encoding twice).
    """
    spark = docs.sparkSession
    dictionary = sample_dictionary(docs, vocab, text_col, id_col)
    dict_hash = hashlib.sha256(dictionary).hexdigest()
    spark.createDataFrame([(dict_hash, bytearray(dictionary))], "dict_hash string, dictionary binary").coalesce(1).write.parquet(f"{path}/dictionary")
    frames = stored(compressed_documents(docs, dictionary, vocab, end_id, text_col, id_col), "frames")
    (frames.repartitionByRange(shuffle_partitions(spark), "doc_id", "tie").sortWithinPartitions("doc_id", "tie")
     .mapInArrow(_blocks(dict_hash), BLOCKS).write.option("compression", "none").parquet(f"{path}/blocks"))


def _dictionary(spark: SparkSession, path: str) -> dict[str, bytes]:
    """The set's one dictionary (at most ``DICT_BYTES``)."""
    return {r["dict_hash"]: bytes(r["dictionary"]) for r in spark.read.parquet(f"{path}/dictionary").collect()}


def _decode(dictionaries: dict[str, bytes], wanted: set[int] | None = None, digest: bool = False):
    """Blocks -> documents; ``wanted``: decompress only these ids' frames;
    ``digest``: the ids' crc32 in their place."""
    last = pa.int64() if digest else pa.binary()

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codecs = {}
        for batch in batches:
            for row in range(batch.num_rows):  # one block in memory at a time
                b = batch.slice(row, 1).to_pylist()[0]
                h = b["dict_hash"]
                if h not in codecs:
                    if h not in dictionaries or hashlib.sha256(dictionaries[h]).hexdigest() != h:
                        raise ValueError(f"block {b['shard']}/{b['block']} needs dictionary {h}")
                    codecs[h] = _codec(dictionaries[h], False)
                unpack, start, body, out = codecs[h], b["start"], memoryview(b["body"]), ([], [], [], [])
                for i, n, w, at, to in zip(b["doc_ids"], b["counts"], b["width"], b["offsets"], b["offsets"][1:]):
                    if wanted is None or i in wanted:
                        ids = np.frombuffer(unpack.decompress(body[at:to]), f"<u{w}").astype("<u4")
                        if len(ids) != n:
                            raise ValueError(f"block {b['shard']}/{b['block']}: {len(ids)} ids, index says {n}")
                        for col, x in zip(out, (i, start, n, zlib.crc32(ids.tobytes()) if digest else ids.tobytes())):
                            col.append(x)
                    start += n
                yield pa.RecordBatch.from_arrays([pa.array(out[0], pa.int64()), pa.array(out[1], pa.int64()), pa.array(out[2], pa.int64()),
                                                  pa.array(out[3], last)], names=["doc_id", "start", "n_tokens", "ids_crc32" if digest else "ids"])

    return run


def _with_starts(spark: SparkSession, path: str) -> DataFrame:
    """The blocks with the number of ids before them in the whole set.

    One row per shard (at most the number of write partitions) goes through
    the window and the broadcast.
    """
    blocks = spark.read.schema(BLOCKS).parquet(f"{path}/blocks")
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    bases = blocks.groupBy("shard").agg(F.sum("n_ids").alias("_n")).select("shard", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_base"))
    return blocks.join(F.broadcast(bases), "shard").withColumn("start", F.col("_base") + F.col("shard_start")).drop("_base")


def read_token_files(spark: SparkSession, path: str) -> DataFrame:
    """``doc_id, start, n_tokens, ids`` (little-endian uint32) of every document."""
    return _with_starts(spark, path).mapInArrow(_decode(_dictionary(spark, path)), "doc_id long, start long, n_tokens long, ids binary")


def read_documents(spark: SparkSession, path: str, doc_ids: Sequence[int]) -> DataFrame:
    """Short-document access: only the blocks that can hold these ids (a list
    that the driver holds) are read, only their frames decompressed."""
    ids = sorted(set(doc_ids))
    near = F.exists(F.lit(ids).cast("array<long>"), lambda i: (F.col("first_id") <= i) & (F.col("last_id") >= i)) if ids else F.lit(False)
    if ids:
        near = near & (F.col("first_id") <= ids[-1]) & (F.col("last_id") >= ids[0])
    return _with_starts(spark, path).filter(near).mapInArrow(_decode(_dictionary(spark, path), set(ids)),
                                                             "doc_id long, start long, n_tokens long, ids binary")


def read_digests(spark: SparkSession, path: str) -> DataFrame:
    """``doc_id, start, n_tokens, ids_crc32`` of every document read back; the
    ids do not leave the worker that decodes them."""
    return _with_starts(spark, path).mapInArrow(_decode(_dictionary(spark, path), digest=True), "doc_id long, start long, n_tokens long, ids_crc32 long")
