"""The corpus pipeline: language ID, line dedup, near duplicates, packing.

Part of the ``leadforge.llm`` subpackage, whose operators it chains.  Each
stage takes the documents that its predecessor kept and returns documents of
the same columns; the last one returns the packed pieces.  Stages are written
as Parquet in between, so a lost executor costs a re-read.

Edge cases, beyond those of the operators: a null text is rejected by the
first stage (no language); rows of one id and different texts stay in the
near-duplicate stage or go together, of those of equal text one stays; empty
tables stay empty; input columns of any name pass through.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from leadforge.llm import jaccard, langid, linededup, packing
from leadforge.llm.common import stored
from leadforge.llm.tokens import default_vocab

#: A document is rejected if no language is read in it, or none with so much
#: of the probability (a guess among the learned languages stays below).
MIN_SCORE = 0.35

#: SQL has no neural network and no tokenizer: the pipeline is tested against
#: a brute-force version instead.
ORACLE_SQL = None


def _aside(docs: DataFrame, *own: str) -> dict[str, str]:
    """Other names for the columns that are called like an operator's own."""
    return {c: f"_input_{k}_{c}" for k, c in enumerate(docs.columns) if c.lower() in own}


def _restored(out: DataFrame, docs: DataFrame, aside: dict[str, str]) -> DataFrame:
    """The columns of ``docs`` alone, under their own names."""
    return out.select(*(F.col(f"`{aside.get(c, c)}`").alias(c) for c in docs.columns))


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which a language is recognised."""
    aside = _aside(docs, "lang_pred", "score")
    seen = langid.identify(docs.withColumnsRenamed(aside))
    return _restored(seen.filter((F.col("lang_pred") != "und") & (F.col("score") >= MIN_SCORE)), docs, aside)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Later repeats of runs of lines are cut out; a document of which nothing
    is left goes.  ``n_chars`` follows the text."""
    aside = _aside(docs, "n_removed", "words_removed")
    cut = linededup.dedup_lines(docs.withColumnsRenamed(aside))
    left = cut.filter((F.col("n_removed") == 0) | (F.btrim("text", F.lit(" \t\r\n")) != ""))
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        left = left.withColumn("n_chars", F.when(F.col("n_removed") > 0, F.char_length("text").cast(kind)).otherwise(F.col("n_chars")))
    return _restored(left, docs, aside)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates the document of smallest id stays, and
    of rows equal in id and text one.  A document of null id is known by its
    text, and comes after those that have an id."""
    text = F.xxhash64("text")
    late = text.bitwiseAND(F.lit((1 << 62) - 1)) + F.lit(1 << 62)
    keyed = docs.withColumns({"_doc_key": F.coalesce(F.col("doc_id").cast("long"), late), "_text_key": text})
    found = jaccard.near_duplicates(keyed, id_col="_doc_key")
    gone = (found.groupBy(F.col("doc_id").alias("_doc_key")).agg(F.bool_and(F.col("component_id") < F.col("doc_id")).alias("gone"))
            .filter("gone").select("_doc_key"))
    equal = Window.partitionBy("_doc_key", "_text_key").orderBy(F.xxhash64(*(F.col(f"`{c}`") for c in docs.columns)))
    one = keyed.join(gone, "_doc_key", "left_anti").withColumn("_row", F.row_number().over(equal)).filter("_row = 1")
    return one.select(*(F.col(f"`{c}`") for c in docs.columns))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The kept documents, packed into sequences."""
    return packing.pack(docs, default_vocab())


STAGES = [("language_id", language_id), ("line_dedup", line_dedup), ("near_duplicates", near_duplicates), ("packing", pack)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, applied to ``documents``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k + 1 < len(STAGES):
            docs = stored(docs, f"stage-{name}")
    return docs
