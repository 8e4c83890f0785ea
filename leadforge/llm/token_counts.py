"""Token counts from flat token files that have no index.

A flat file is a sequence of ids; every document ends with the end-of-document
id.  Its blocks are scanned independently: one vectorised search finds the
separators of a block, and a prefix scan over the blocks' few numbers (ids
before, separators before, end of the last separator) stitches documents
that cross blocks, however many.

Edge cases: an empty block or file has no documents; ids after a file's last
separator are one unterminated document; a document without ids counts 0;
null texts are written as empty documents.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import slices
from .tokens import piece_encoder

BLOCK_IDS = 1 << 18
#: Blocks per group of the two-level prefix scan.
SPAN = 1024
FLAT = "file int, block long, width int, ids binary, first_ordinal long, doc_ids array<long>"


def flat_files(docs: DataFrame, vocab: str, end_id: int, block_ids: int = BLOCK_IDS,
               text_col: str = "text", id_col: str = "doc_id") -> DataFrame:
    """Each task's documents as one flat file of uint16 ids (uint32 above
    65,535: give ``end_id`` above it), in blocks of ``block_ids`` ids that
    ignore document boundaries.

    Rows with ``doc_ids`` are no part of the file: they only remember which
    ids were written, so that a caller can name the documents found.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc, part = piece_encoder(vocab, special=False), TaskContext.get().partitionId()
        width = 2 if enc.tokenizer.get_vocab_size() <= 1 << 16 and end_id < 1 << 16 else 4
        size, end = width * block_ids, end_id.to_bytes(width, "little")
        rest, block, ordinal = bytearray(), 0, 0

        def rows(blocks, names, first):
            n = len(blocks) + bool(names)
            return pa.RecordBatch.from_arrays([
                pa.array([part] * n, pa.int32()), pa.array([b for b, _ in blocks] + [None] * bool(names), pa.int64()), pa.array([width] * n, pa.int32()),
                pa.array([x for _, x in blocks] + [None] * bool(names), pa.binary()),
                pa.array([None] * len(blocks) + [first] * bool(names), pa.int64()),
                pa.array([None] * len(blocks) + [names] * bool(names), pa.list_(pa.int64()))],
                names=["file", "block", "width", "ids", "first_ordinal", "doc_ids"])

        for batch in slices(batches):
            names, blocks = batch.column(0).to_pylist(), []
            for ids in enc.encode_column(batch.column(1)):
                rest += np.frombuffer(ids, "<u4").astype(f"<u{width}").tobytes() + end
                while len(rest) >= size:
                    blocks.append((block, bytes(rest[:size])))
                    del rest[:size]
                    block += 1
            yield rows(blocks, names, ordinal)
            ordinal += len(names)
        if rest:
            yield rows([(block, bytes(rest))], [], 0)

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text")).mapInArrow(run, FLAT)


def scan_blocks(blocks: DataFrame, end_id: int, width: int = 2) -> DataFrame:
    """``file, block, n_ids, ends``: for each separator of the block, the
    number of the block's ids up to and with it.  Blocks say how many bytes an
    id takes in ``width``; files from elsewhere without that column have ``width``."""
    if "width" not in blocks.columns:
        blocks = blocks.withColumn("width", F.lit(width))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            n_ids, ends = [], []
            for raw, size in zip(b.column("ids"), b.column("width").to_pylist()):
                ids = np.frombuffer(raw.as_buffer(), f"<u{size}")
                n_ids.append(len(ids))
                ends.append(np.flatnonzero(ids == end_id) + 1)
            yield pa.RecordBatch.from_arrays([b.column("file"), b.column("block"), pa.array(n_ids, pa.int64()),
                                              pa.array(ends, pa.list_(pa.int64()))], names=["file", "block", "n_ids", "ends"])

    return blocks.select("file", "block", "ids", "width").mapInArrow(run, "file int, block long, n_ids long, ends array<long>")


def count_tokens(blocks: DataFrame, end_id: int, width: int = 2) -> DataFrame:
    """``file, ordinal, start, n_tokens, terminated`` for every document of
    every flat file; ``n_tokens`` leaves the separator out."""
    scanned = scan_blocks(blocks, end_id, width).withColumn("span", F.floor(F.col("block") / SPAN))
    # The prefix scan has two levels, within a span of blocks and over the
    # spans, so that no window holds all blocks of a huge file.
    prior = Window.partitionBy("file", "span").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    local = (scanned
             .withColumn("ids0", F.coalesce(F.sum("n_ids").over(prior), F.lit(0)))
             .withColumn("docs0", F.coalesce(F.sum(F.size("ends")).over(prior), F.lit(0)))
             .withColumn("last_end", F.col("ids0") + F.try_element_at("ends", F.lit(-1)))
             .withColumn("end0", F.max("last_end").over(prior)))
    earlier = Window.partitionBy("file").orderBy("span").rowsBetween(Window.unboundedPreceding, -1)
    spans = (local.groupBy("file", "span")
             .agg(F.sum("n_ids").alias("s_ids"), F.sum(F.size("ends")).alias("s_docs"), F.max("last_end").alias("s_end"))
             .withColumn("ids1", F.coalesce(F.sum("s_ids").over(earlier), F.lit(0)))
             .withColumn("docs1", F.coalesce(F.sum("s_docs").over(earlier), F.lit(0)))
             .withColumn("s_end", F.col("ids1") + F.col("s_end"))
             .withColumn("end1", F.max("s_end").over(earlier)))
    begin = F.col("ids1") + F.col("ids0")
    found = (local.join(spans.select("file", "span", "ids1", "docs1", "end1"), ["file", "span"])
             .withColumn("carried", F.coalesce(F.col("ids1") + F.col("end0"), F.col("end1"), F.lit(0)))
             .select("file", (F.col("docs1") + F.col("docs0")).alias("docs"), "carried", begin.alias("begin"), "ends",
                     F.posexplode("ends").alias("i", "end"))
             .withColumn("start", F.when(F.col("i") == 0, F.col("carried")).otherwise(F.col("begin") + F.try_element_at("ends", F.col("i"))))
             .select("file", (F.col("docs") + F.col("i")).alias("ordinal"), "start",
                     (F.col("begin") + F.col("end") - F.col("start") - 1).alias("n_tokens"), F.lit(True).alias("terminated")))
    rest = (spans.groupBy("file").agg(F.sum("s_docs").alias("ordinal"), F.coalesce(F.max("s_end"), F.lit(0)).alias("start"), F.sum("s_ids").alias("ids"))
            .filter("ids > start")
            .select("file", "ordinal", "start", (F.col("ids") - F.col("start")).alias("n_tokens"), F.lit(False).alias("terminated")))
    return found.unionByName(rest)


def name_documents(counts: DataFrame, flat: DataFrame) -> DataFrame:
    """The counts with the ids of the documents, by place in their file."""
    names = (flat.filter(F.col("doc_ids").isNotNull())
             .select("file", "first_ordinal", F.posexplode("doc_ids").alias("i", "doc_id"))
             .select("file", (F.col("first_ordinal") + F.col("i")).alias("ordinal"), "doc_id"))
    return counts.join(names, ["file", "ordinal"])
