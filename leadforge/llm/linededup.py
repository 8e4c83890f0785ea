"""Line dedup by winnowing: later repeats of a run of words are deleted.

Native: DataFrame functions only.  A text's words are its runs of characters
that are not white space (``\\s`` of Java); texts are compared word by word,
whatever space or line feed stands between.  In scripts that put no spaces
between words each character counts as a word.

A word goes if it lies in ``MIN_WORDS`` words in a row that stand in the same
order at an earlier place: in a document of smaller id, or further ahead in
the same text.  Places may begin and end anywhere in a line.

1. Of every ``min_words - GRAM + 1`` words in a row the one of smallest hash
   is selected (winnowing); the hash of the ``GRAM`` words from it is a
   fingerprint.  Equal runs of ``min_words`` words select the same one.
2. Only runs of ``min_words`` words around a fingerprint that stands in
   several places are looked at: each is a row, its hash's first place in the
   corpus (id, then word) is a grouped minimum, and the others go.  A place is
   one number, the document's in their order and the word's: the minimum is a
   hash aggregate, and a row has two numbers.  No pairs of places are made, and
   no place stands for another.  Texts equal to one of smaller id go whole,
   before that.
3. Overlapping runs are merged and cut out, each word with the white space
   behind it.  A deleted word stands at an earlier place, so the first
   occurrence of everything stays.

Edge cases: null text stays null; empty texts and those under ``MIN_WORDS``
stay as they are; null ids come first; rows equal in id and text count as one
document and get the same result; overlapping repeats inside one text leave
the first; an empty table stays empty; all columns of the input stay.
"""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from leadforge.functions.bloom import bloom, maybe_in

from .common import stored

MIN_WORDS = 50

#: A word's place in its text takes so many low bits of its winnowing key.
_PLACE_BITS = 30
#: Scripts that put no spaces between words: Thai, Lao, Burmese, Khmer, kana, Han
#: (rarer ideographs beyond U+FFFF are cut off only from these).
_SOLID = r"[\u0e00-\u0eff\u1000-\u109f\u1780-\u17ff\u3005-\u3007\u3040-\u30ff\u3400-\u4dbf\u4e00-\u9fff\uf900-\ufaff\uff66-\uff9f\x{20000}-\x{3134f}]"
_AROUND = rf"(?<=\S)(?={_SOLID})|(?<={_SOLID})(?=\S)"
#: What a word that ends a line or a sentence holds, with the space behind it.
_ENDS = ("\n", ". ", "! ", "? ")


def _split(text: Column, cut: str) -> Column:
    """``text`` cut at the pattern and around the characters of ``_SOLID``
    (looked for only where there are characters from the first of them on)."""
    solid = (F.octet_length(text) > F.char_length(text)) & text.rlike(r"[\u0e00-\x{10ffff}]") & text.rlike(_SOLID)
    return F.when(solid, F.split(text, f"{cut}|{_AROUND}")).otherwise(F.split(text, cut))


def _words(text: Column) -> Column:
    return F.array_remove(_split(text, r"\s+"), "")


def _keyed(docs: DataFrame, text_col: str, id_col: str) -> DataFrame:
    """``row`` (all columns of the input) and ``k_id, k_tie`` (the order of the
    documents, never null)."""
    return docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row"), F.coalesce(F.col(id_col).cast("long"), F.lit(-(1 << 63))).alias("k_id"),
                       F.xxhash64(F.col(text_col)).alias("k_tie"))


def _document() -> Column:
    """A document's key as one number, for Bloom filters."""
    return F.xxhash64("k_id", "k_tie")


def _long(docs: DataFrame, text_col: str, id_col: str, min_words: int) -> DataFrame:
    """``k_id, k_tie, text`` of the documents that can hold a run (so many
    words take twice as many bytes, or three times in solid scripts)."""
    text = F.col("row")[text_col]
    return _keyed(docs, text_col, id_col).filter(F.octet_length(text) >= 2 * min_words - 1).select("k_id", "k_tie", text.alias("text"))


def word_arrays(docs: DataFrame, text_col: str, id_col: str, min_words: int = MIN_WORDS) -> DataFrame:
    """``k_id, k_tie, words`` of these documents."""
    return _long(docs, text_col, id_col, min_words).select("k_id", "k_tie", _words(F.col("text")).alias("words"))


def fingerprints(arrays: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """``gram, k_id, k_tie, at``: the selected places (from 0) and the hashes
    of the words from there.

    The places of words in their keys make the first of equals the smallest.
    A window's smallest is new if it is its last word, or if the word before
    the window was the smallest so far."""
    gram = min_words // 2
    wide = min_words - gram + 1
    keys = F.transform("words", lambda w, i: F.shiftleft(F.xxhash64(w), _PLACE_BITS) + i)
    # The outer form, as the optimizer would derive a filter from an inner
    # one, and cut the text once more for it.
    rows = arrays.withColumn("keys", keys).select("k_id", "k_tie", "words", "keys", F.posexplode_outer("keys").alias("i", "key"))
    least = F.array_min(F.slice("keys", F.col("i") + 1, F.lit(wide)))
    at = least.bitwiseAND(F.lit((1 << _PLACE_BITS) - 1)).cast("int")
    new = (F.col("i") == 0) | (at == F.col("i") + wide - 1) | (F.get("keys", F.col("i") - 1) < least)
    return (rows.filter((F.col("i") <= F.size("keys") - min_words) & new)
            .select("k_id", "k_tie", "words", at.alias("at")).select(F.xxhash64(F.slice("words", F.col("at") + 1, F.lit(gram))).alias("gram"), "k_id", "k_tie", "at"))


def _numbered(keys: DataFrame) -> DataFrame:
    """``k_id, k_tie, number`` of the documents, numbered in their order (with
    gaps: behind a number of the sort's part stands the place in it)."""
    rows = stored(keys.orderBy("k_id", "k_tie").withColumn("number", F.monotonically_increasing_id()), "line-numbers")
    part, place = F.shiftright("number", 33), F.col("number").bitwiseAND(F.lit((1 << 33) - 1))
    parts, places = rows.agg(F.max(part), F.max(place)).first()
    bits = (places or 0).bit_length()
    if (parts or 0).bit_length() + bits + _PLACE_BITS > 63:
        raise ValueError("too many documents for places of 64 bits")
    return rows.withColumn("number", F.shiftleft(part, bits) + place)


def repeated_runs(docs: DataFrame, text_col: str = "text", id_col: str = "doc_id", min_words: int = MIN_WORDS) -> DataFrame:
    """``k_id, k_tie, runs``: the words (from ``first`` to before ``end``, from
    0) that repeat earlier ones.  The end may lie behind the last word."""
    key = ["k_id", "k_tie"]
    places = stored(fingerprints(word_arrays(docs, text_col, id_col, min_words), min_words), "line-places")
    # Stored, so that the join reads plain shuffles and splits a frequent key.
    # Most places have no equal: a Bloom filter stops them before the shuffle.
    several = stored(places.groupBy("gram").agg(F.count("*").alias("n")).filter("n > 1").select("gram"), "line-several")
    hits = stored(places.filter(maybe_in(bloom(several, "gram"), "gram")).join(several, "gram", "left_semi")
                  .groupBy(*key).agg(F.collect_set("at").alias("at")), "line-hits")
    # Of equal texts the first one stands for all: the others go whole.
    originals = stored(hits.groupBy("k_tie").agg(F.min("k_id").alias("k_id")), "line-originals")
    copies = hits.join(originals, key, "left_anti").select(*key, F.array(F.struct(F.lit(0).alias("first"), F.lit((1 << 31) - 1).alias("end"))).alias("runs"))

    # All runs of min_words words that hold a fingerprint of several places.
    spare = min_words - min_words // 2
    starts = F.array_distinct(F.flatten(F.transform("at", lambda a: F.sequence(F.greatest(F.lit(0), a - spare), F.least(a, F.size("words") - min_words)))))
    numbers = _numbered(originals.select(*key))
    near = (_long(docs, text_col, id_col, min_words).filter(maybe_in(bloom(numbers, _document()), _document()))
            .join(hits.join(numbers, key).hint("merge"), key)
            .select("number", "at", _words(F.col("text")).alias("words")).select("number", starts.alias("starts"), F.transform("words", lambda w: F.xxhash64(w)).alias("hashes"))
            .select("number", "hashes", F.explode_outer("starts").alias("start")).filter("start IS NOT NULL"))
    windows = stored(near.select(F.xxhash64(F.slice("hashes", F.col("start") + 1, F.lit(min_words))).alias("run"),
                                 (F.shiftleft("number", _PLACE_BITS) + F.col("start")).alias("place")), "line-windows")
    first = stored(windows.groupBy("run").agg(F.min("place").alias("source"), F.count("*").alias("n")).filter("n > 1").select("run", "source"), "line-sources")
    # Equal rows give equal places; those merge like overlapping runs.
    start = F.col("place").bitwiseAND(F.lit((1 << _PLACE_BITS) - 1)).cast("int")
    later = (windows.join(first, "run").filter("place > source").groupBy(F.shiftright("place", _PLACE_BITS).alias("number"))
             .agg(F.sort_array(F.collect_list(start)).alias("starts")).join(numbers, "number"))
    # Runs that overlap or touch are one.
    far = lambda a, b: F.coalesce(F.get("starts", b) - F.get("starts", a) > min_words, F.lit(True))
    firsts = F.filter("starts", lambda s, i: far(i - 1, i))
    ends = F.transform(F.filter("starts", lambda s, i: far(i, i + 1)), lambda s: s + min_words)
    merged = later.select(*key, F.zip_with(firsts, ends, lambda a, b: F.struct(a.alias("first"), b.alias("end"))).alias("runs"))
    return merged.unionByName(copies)


def dedup_lines(docs: DataFrame, text_col: str = "text", id_col: str = "doc_id", min_words: int = MIN_WORDS) -> DataFrame:
    """``docs`` with the later repeats cut out of the text, and ``n_removed``
    (the lines and sentences that lost words, once for each run cut from
    them), ``words_removed`` (replaced where it has such columns)."""
    docs = docs.drop("n_removed", "words_removed")
    cuts = stored(repeated_runs(docs, text_col, id_col, min_words), "line-cuts")
    rows = _keyed(docs, text_col, id_col)
    able = maybe_in(bloom(cuts, _document()), _document())
    # Texts without cuts are not shuffled.
    whole = rows.filter(able).join(cuts, ["k_id", "k_tie"], "left")
    text = F.col("row")[text_col]
    # Each word with the white space behind it; what is ahead of the first
    # word goes with it.  The words, and then the results, are bound by a
    # generator of one row: the optimizer moves neither a caller's filter nor
    # another projection through it, which would cut the text anew for each
    # use of a word.
    words = F.when(F.col("runs").isNotNull(), _split(F.regexp_replace(text, r"^\s+", ""), r"(?<=\s)(?=\S)"))
    bound = whole.select("row", "runs", F.explode_outer(F.array(F.struct(words.alias("words")))).alias("_b")).select("row", "runs", F.col("_b.words").alias("_words"))
    runs = F.transform("runs", lambda r: F.struct(r["first"].alias("first"), F.least(r["end"], F.size("_words")).alias("end")))
    bound = bound.select("row", "_words", F.explode_outer(F.array(F.struct(runs.alias("runs")))).alias("_b")).select("row", "_words", F.col("_b.runs").alias("_runs"))
    cut = F.col("_runs").isNotNull()
    ahead = F.when(F.get("_runs", F.lit(0))["first"] > 0, F.regexp_extract(text, r"^\s*", 0)).otherwise("")
    between = F.zip_with(F.concat(F.array(F.lit(0)), F.col("_runs.end")), F.concat(F.col("_runs.first"), F.array(F.size("_words"))),
                         lambda a, b: F.struct(a.alias("first"), b.alias("end")))
    kept = F.concat(ahead, F.array_join(F.flatten(F.transform(between, lambda r: F.slice("_words", r["first"] + 1, r["end"] - r["first"]))), ""))
    broken = F.filter(F.flatten(F.transform("_runs", lambda r: F.slice("_words", r["first"] + 1, r["end"] - r["first"] - 1))), lambda w: reduce(or_, (w.contains(e) for e in _ENDS)))
    gone = F.aggregate("_runs", F.lit(0), lambda a, r: a + r["end"] - r["first"])
    result = F.struct(F.when(cut, kept).otherwise(text).alias("text"), F.when(cut, F.size("_runs") + F.size(broken)).otherwise(0).alias("n_removed"),
                      F.when(cut, gone).otherwise(0).alias("words_removed"))
    done = bound.select("row", F.explode_outer(F.array(result)).alias("_r"))
    column = lambda text: [text.alias(c) if c == text_col else F.col("row")[c].alias(c) for c in docs.columns]
    return (done.select(*column(F.col("_r.text")), "_r.n_removed", "_r.words_removed")
            .unionByName(rows.filter(~able).select(*column(text), F.lit(0).alias("n_removed"), F.lit(0).alias("words_removed"))))
