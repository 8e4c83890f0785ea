"""N-gram Jaccard join by prefix filters under several token orders.

A document is its set of distinct word n-grams (shingles).  Under any order
of all shingles, two sets with intersection >= t * union share a shingle among
the first ``n - ceil(t n) + 1`` of each.  Candidates come from the first order
and must share such a prefix shingle under the other orders too, before the
texts are compared exactly.

- Documents of equal sets are one node from the start.
- The first order puts frequent shingles last.  A bounded table (``HOT`` rows)
  of the most frequent ones comes from counts over all documents; a shingle
  outside it stands in few documents, or in at most 1 / ``HOT`` of all places.
  Any table gives right results, a good one gives few candidates.
- Groups of near copies never become pairs.  Nodes that share a prefix shingle
  are compared with one pivot, the node whose shingles stand in the largest
  groups; the links make components.  Then only nodes outside a pivot's
  largest component are held against the nodes of its other components that
  met it in the same shingle, and of those pairs only the ones are compared
  that the bits of the pivot's shingles which both hold leave possible.  Every
  pair that may link is compared, already connected, or excluded by a bound.

Edge cases: null, empty and blank texts have no shingles and no links; a text
of fewer than n words is one shingle; null ids get their count, but no
component; rows of equal id each get their own component; an empty table
stays empty; further columns of the input are ignored.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from leadforge.functions.bloom import bloom, maybe_in

from .common import discard, slices, stored
from .graph import components

WORDS, PERCENT = 5, 80  # shingle size, least similarity
#: Rows of the table of frequent shingles, and from which count on.
HOT, HOT_COUNT = 1 << 16, 8
#: Places counted at once by a task; a shingle counts from so many among them.
COUNTED, COUNTED_LEAST = 1 << 21, 4
_ORDERS = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0xD6E8FEB86659FD93], dtype=np.uint64)

SIGNATURES = "doc_id long, node long, check long, n int, n_cold int, hot array<long>, second array<int>, third array<int>"


def mix(x: np.ndarray) -> np.ndarray:
    """A permutation of 64-bit integers that scatters them."""
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


_LOWER = np.array([b + 32 if 65 <= b <= 90 else b for b in range(256)], np.uint8)
_WHITE = np.isin(np.arange(256), [32, *range(9, 14)])
#: Masks of the first n bytes of eight; longer words are hashed by xxhash.
_MASK = np.array([(1 << 8 * n) - 1 for n in range(9)], np.uint64)
_LONG_WORD = 256


def _word_hashes(low: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """64-bit hashes of the words, eight bytes of all of them at a time."""
    eights = np.ndarray((len(low) - 7,), "<u8", low, strides=(1,))  # low ends in eight zeros
    h = mix(lengths.astype(np.uint64) + np.uint64(1))
    at, todo = 0, np.flatnonzero(lengths <= _LONG_WORD)
    while len(todo):
        h[todo] = mix(h[todo] ^ (eights[starts[todo] + at] & _MASK[np.minimum(lengths[todo] - at, 8)])) + np.uint64(at)
        at += 8
        todo = todo[lengths[todo] > at]
    for i in np.flatnonzero(lengths > _LONG_WORD).tolist():
        h[i] = xxhash.xxh64_intdigest(low[starts[i]:starts[i] + lengths[i]].tobytes())
    return h


def shingle_sets(texts: pa.Array, words: int) -> tuple[np.ndarray, np.ndarray]:
    """The sorted distinct shingle hashes of each text, one text after the
    other, and where each begins (and the last ends).  Lower-casing and cutting
    the bytes touches A-Z and the six white-space bytes alone."""
    texts = (texts.fill_null("") if texts.null_count else texts).cast(pa.string())
    n = len(texts)
    if not n:
        return np.empty(0, np.uint64), np.zeros(1, np.int64)
    _, offsets, data = texts.buffers()
    bounds = np.frombuffer(offsets, np.int32)[texts.offset:texts.offset + n + 1].astype(np.int64)
    low = np.concatenate([_LOWER[np.frombuffer(data or b"", np.uint8)[bounds[0]:bounds[-1]]], np.zeros(8, np.uint8)])
    bounds -= bounds[0]
    size = int(bounds[-1])
    solid = ~_WHITE[low[:size]]
    first, last = solid.copy(), solid.copy()
    first[1:] &= ~solid[:-1]
    last[:-1] &= ~solid[1:]
    edges = bounds[:-1][(bounds[:-1] < size) & (np.diff(bounds) > 0)]  # texts begin words, and end them
    first[edges] = solid[edges]
    ends = bounds[1:][np.diff(bounds) > 0] - 1
    last[ends] = solid[ends]
    starts = np.flatnonzero(first)
    h = _word_hashes(low, starts, np.flatnonzero(last) + 1 - starts)
    at = np.searchsorted(starts, bounds)  # each text's first word
    many = np.diff(at)
    factors = mix(np.arange(1, words + 1, dtype=np.uint64)) | np.uint64(1)
    run = max(0, len(h) - words + 1)
    sums = np.zeros(run, np.uint64)
    for j in range(words):
        sums += h[j:run + j] * factors[j]
    sums = mix(sums)
    out, lengths = [], np.zeros(n, np.int64)
    for i, (a, k) in enumerate(zip(at.tolist(), many.tolist())):
        if k >= words:
            s = sums[a:a + k - words + 1]
            s.sort()
            s = s[np.append(True, s[1:] != s[:-1])]
        elif k:  # fewer words: the whole sequence
            s = mix((h[a:a + k] * factors[:k]).sum(keepdims=True) ^ np.uint64(0xA5A5A5A5 * (k + words)))
        else:
            continue
        out.append(s)
        lengths[i] = len(s)
    return (np.concatenate(out) if out else np.empty(0, np.uint64)), np.append(0, np.cumsum(lengths))


def shingles(text: str | None, words: int) -> np.ndarray:
    return shingle_sets(pa.array([text], pa.string()), words)[0]


def _each(column: pa.Array, words: int) -> Iterator[np.ndarray]:
    """The sets of the texts, in turn."""
    sets, at = shingle_sets(column, words)
    for a, b in zip(at.tolist(), at[1:].tolist()):
        yield sets[a:b]


def node_of(s: np.ndarray) -> tuple[int, int]:
    """128 bits of a set, as two signed integers."""
    d = xxhash.xxh3_128_digest(s.tobytes())
    return int.from_bytes(d[:8], "little", signed=True), int.from_bytes(d[8:], "little", signed=True)


class Orders:
    """``keys``: the frequent shingles, sorted; ``counts``: how often they occur."""

    def __init__(self, percent: int, keys: np.ndarray, counts: np.ndarray):
        self.percent, self.keys = percent, keys
        self.grade = np.minimum(63, np.ceil(np.log2(np.maximum(counts, 1)))).astype(np.uint64)
        self.able = np.zeros(1 << 22, bool)  # by low bits: most shingles need no search
        self.able[keys & np.uint64(len(self.able) - 1)] = True

    def _grades(self, s: np.ndarray) -> np.ndarray:
        out = np.zeros(len(s), np.uint64)
        some = np.flatnonzero(self.able[s & np.uint64(len(self.able) - 1)])
        if len(some):
            at = np.minimum(np.searchsorted(self.keys, s[some]), len(self.keys) - 1)
            out[some] = np.where(self.keys[at] == s[some], self.grade[at], np.uint64(0))
        return out

    def prefixes(self, s: np.ndarray, *orders: int) -> list[tuple[np.ndarray, np.ndarray]]:
        """(the set's prefix, which of it is in the table) under each order."""
        grades = self._grades(s)
        return [self._prefix(s, grades, k) for k in orders]

    def _prefix(self, s: np.ndarray, grades: np.ndarray, order: int) -> tuple[np.ndarray, np.ndarray]:
        size = len(s) - -(-self.percent * len(s) // 100) + 1
        rank = (grades << np.uint64(58)) | (mix(s ^ _ORDERS[order]) >> np.uint64(6))
        at = np.argpartition(rank, size - 1)[:size] if size < len(s) else np.arange(len(s))
        return s[at], grades[at] > 0


def _texts(docs: DataFrame, text_col: str, id_col: str) -> DataFrame:
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))


def frequent(docs: DataFrame, words: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``HOT`` most frequent shingles, counted over all documents.

    Tasks count blocks of ``COUNTED`` places and send what stands at least
    ``COUNTED_LEAST`` times in one (lossy counting: a count falls short by less
    than that for each block)."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0

        def flush():
            nonlocal held, size
            keys, counts = np.unique(np.concatenate(held), return_counts=True) if held else (np.empty(0, np.uint64), np.empty(0, np.int64))
            held, size = [], 0
            often = counts >= COUNTED_LEAST
            return pa.RecordBatch.from_arrays([pa.array(keys[often].view(np.int64)), pa.array(counts[often].astype(np.int64))], names=["shingle", "n"])

        for b in slices(batches, 500):
            held.append(shingle_sets(b.column("text"), words)[0])
            size += len(held[-1])
            if size >= COUNTED:
                yield flush()
        yield flush()

    rows = (docs.select("text").mapInArrow(run, "shingle long, n long").groupBy("shingle").agg(F.sum("n").alias("n"))
            .filter(F.col("n") >= HOT_COUNT).orderBy(F.desc("n"), "shingle").limit(HOT).toPandas())
    keys = rows["shingle"].to_numpy(np.int64).view(np.uint64)
    order = np.argsort(keys)
    return keys[order], rows["n"].to_numpy(np.int64)[order]


def _per_document(docs: DataFrame, words: int, orders, row: Callable, schema: str, arrow: pa.Schema) -> DataFrame:
    """Rows that ``row(doc_id, set, orders)`` makes of every document."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, 500):
            rows = [r for i, s in zip(b.column("doc_id").to_pylist(), _each(b.column("text"), words)) for r in row(i, s, orders.value)]
            cols = list(zip(*rows)) or [[]] * len(arrow)
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(cols, arrow)], schema=arrow)

    return docs.mapInArrow(run, schema)


def _signature(doc_id, s, orders):
    if not len(s):
        return [(doc_id, None, None, 0, 0, [], [], [])]
    (first, hot), *other = orders.prefixes(s, 0, 1, 2)
    return [(doc_id, *node_of(s), len(s), int((~hot).sum()), first[hot].view(np.int64), *(p.astype(np.uint32).view(np.int32) for p, _ in other))]


def _cold_postings(doc_id, s, orders):
    if doc_id is None or not len(s):
        return []
    [(first, hot)] = orders.prefixes(s, 0)
    return [(node_of(s)[0], first[~hot].view(np.int64))]


_SIGNATURES = pa.schema([("doc_id", pa.int64()), ("node", pa.int64()), ("check", pa.int64()), ("n", pa.int32()), ("n_cold", pa.int32()),
                         ("hot", pa.list_(pa.int64())), ("second", pa.list_(pa.int32())), ("third", pa.list_(pa.int32()))])
_POSTINGS = pa.schema([("node", pa.int64()), ("tokens", pa.list_(pa.int64()))])


def _sizes(percent: int):
    """The sizes of a pair (``x_n, y_n``) let it link."""
    return 100 * F.least("x_n", "y_n") >= percent * F.greatest("x_n", "y_n")


def _filtered(pairs: DataFrame, nodes: DataFrame) -> DataFrame:
    """``x, y, x_doc, y_doc, able`` of pairs (of possible sizes: most have
    others, and go before any prefix is shipped); ``able``: they share a prefix
    shingle under the other orders too."""
    side = lambda c: nodes.select(F.col("node").alias(c), F.col("rep").alias(f"{c}_doc"),
                                  F.col("second").alias(f"{c}_second"), F.col("third").alias(f"{c}_third"))
    return (pairs.join(side("x"), "x").join(side("y"), "y")
            .withColumn("able", F.arrays_overlap("x_second", "y_second") & F.arrays_overlap("x_third", "y_third"))
            .drop("x_second", "y_second", "x_third", "y_third"))


def _sharing(pairs: DataFrame, nodes: DataFrame, order: str) -> DataFrame:
    """The pairs that share a prefix shingle under one order: half of what
    ``_filtered`` ships for a pair, and few pairs are left for the rest."""
    side = lambda c: nodes.select(F.col("node").alias(c), F.col(order).alias(f"{c}_{order}"))
    return (pairs.join(side("x"), "x").join(side("y"), "y")
            .filter(F.arrays_overlap(f"x_{order}", f"y_{order}")).select(*pairs.columns))


def _compare(pairs: DataFrame, docs: DataFrame, words: int, bits: bool) -> DataFrame:
    """``x, y, x_doc, y_doc, x_n, y_n, both`` (shared shingles) by the texts of
    the nodes' first documents, with ``bits`` also which shingles of x are in y."""
    # Both joins read one exchange of the texts; a pivot's many pairs are
    # dealt over tasks by AQE's skew join.  Texts of no pair stay where they are.
    pairs = stored(pairs.select("x", "y", "x_doc", "y_doc"), "pairs")
    able = maybe_in(bloom(pairs.select(F.col("x_doc").alias("d")).union(pairs.select("y_doc")), "d"), "doc_id")
    text = docs.filter("doc_id IS NOT NULL").filter(able)
    full = (pairs
            .join(text.select(F.col("doc_id").alias("x_doc"), F.col("text").alias("x_text")), "x_doc")
            .join(text.select(F.col("doc_id").alias("y_doc"), F.col("text").alias("y_text")), "y_doc"))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[str, tuple[int, np.ndarray]] = {}

        def of(text):
            if text not in known:
                if len(known) >= 32:
                    known.clear()
                s = shingles(text, words)
                known[text] = node_of(s)[0], s
            return known[text]

        for whole in batches:
            for at in range(0, whole.num_rows, 500):
                b, out = whole.slice(at, 500), ([], [], [], [], [], [], [], [])
                for x, y, xd, yd, xt, yt in zip(*(b.column(c).to_pylist() for c in ("x", "y", "x_doc", "y_doc", "x_text", "y_text"))):
                    (xn, xs), (yn, ys) = of(xt), of(yt)
                    if (xn, yn) != (x, y):  # another document of that id
                        continue
                    at_y = np.minimum(np.searchsorted(ys, xs), len(ys) - 1)
                    inside = ys[at_y] == xs
                    packed = np.packbits(inside, bitorder="little").tobytes() if bits else b""
                    for col, v in zip(out, (x, y, xd, yd, len(xs), len(ys), int(inside.sum()), np.frombuffer(packed + b"\0" * (-len(packed) % 8), "<i8"))):
                        col.append(v)
                yield pa.RecordBatch.from_arrays([*(pa.array(c, pa.int64()) for c in out[:-1]), pa.array(out[-1], pa.list_(pa.int64()))],
                                                 names=["x", "y", "x_doc", "y_doc", "x_n", "y_n", "both", "bits"])

    rows = (full.select("x", "y", "x_doc", "y_doc", "x_text", "y_text")
            .mapInArrow(run, "x long, y long, x_doc long, y_doc long, x_n long, y_n long, both long, bits array<long>"))
    out = stored(rows.dropDuplicates(["x", "y"]), "compared")
    discard(pairs)
    return out


def _linked(compared: DataFrame, percent: int) -> DataFrame:
    """The links among them, of nodes and (``x_doc, y_doc``) of their smallest ids."""
    return (compared.filter(100 * F.col("both") >= percent * (F.col("x_n") + F.col("y_n") - F.col("both")))
            .select("x", "y", "x_doc", "y_doc"))


def near_duplicates(docs: DataFrame, words: int = WORDS, percent: int = PERCENT, text_col: str = "text", id_col: str = "doc_id") -> DataFrame:
    """``doc_id, n_shingles, n_links, component_id`` of every document;
    ``n_links``: verified links of its set (to pivots and across components)."""
    spark = docs.sparkSession
    docs = _texts(docs, text_col, id_col)
    orders = spark.sparkContext.broadcast(Orders(percent, *frequent(docs, words)))
    signatures = stored(_per_document(docs, words, orders, _signature, SIGNATURES, _SIGNATURES), "signatures")
    brief = stored(signatures.select("doc_id", "node", "n"), "documents")
    real = signatures.filter("doc_id IS NOT NULL AND n > 0")
    classes = stored(real.groupBy("node").agg(F.min("doc_id").alias("rep"), F.min("check").alias("check"), F.max("check").alias("check2")), "classes")
    if not classes.filter("check != check2").isEmpty():
        raise ValueError("two sets have one 64-bit hash")
    nodes = stored(real.join(classes.select("node", "rep"), "node").filter("doc_id = rep")
                   .select("node", "rep", "n", "n_cold", "second", "third").dropDuplicates(["node"]), "nodes")

    # Prefix shingles that two nodes share.  Frequent ones (the table's) go
    # through a partial aggregate and a join that AQE splits; any other one
    # stands in a bounded share of the rows, and a window takes one shuffle.
    hot = real.select("node", F.explode("hot").alias("token"))
    shared = stored(hot.groupBy("token").agg(F.count("*").alias("size"), F.min("node").alias("a"), F.max("node").alias("b"))
                    .filter("a != b").select("token", "size"), "shared")
    cold = (_per_document(docs, words, orders, _cold_postings, "node long, tokens array<long>", _POSTINGS)
            .select("node", F.explode("tokens").alias("token")))
    by_token = Window.partitionBy("token")
    cold = (cold.withColumns({"size": F.count("*").over(by_token), "a": F.min("node").over(by_token), "b": F.max("node").over(by_token)})
            .filter("a != b").select("token", "node", "size", F.lit(0).alias("hot")).distinct())
    members = stored(hot.join(shared, "token").select("token", "node", "size", F.lit(1).alias("hot")).distinct().unionByName(cold), "members")

    discard(signatures)
    orders.destroy()

    # The pivot of a shingle is its node of the largest groups in sum: in a
    # family of near copies the one with the fewest shingles of its own.
    weights = stored(members.groupBy("node").agg(F.sum("size").alias("weight"), F.sum(1 - F.col("hot")).alias("cold_shared"))
                     .join(nodes.select("node", "n"), "node"), "weights")
    pivots = stored(members.join(weights, "node").groupBy("token").agg(F.max(F.struct("weight", "node", "n")).alias("p"))
                    .select("token", F.col("p.node").alias("x"), F.col("p.n").alias("x_n")), "pivots")
    pairs = members.join(pivots, "token").filter("x != node").groupBy("x", "x_n", F.col("node").alias("y")).agg(F.max("hot").alias("hot"), F.collect_set(F.shiftright("token", 32).cast("int")).alias("tokens"))
    star = stored(pairs.join(weights.select(F.col("node").alias("y"), F.col("n").alias("y_n")), "y"), "star")
    discard(members), discard(pivots), discard(shared)
    compared = _compare(_filtered(star.filter(_sizes(percent)).select("x", "y", "hot"), nodes).filter("able OR hot = 1"), docs, words, bits=True)
    links = stored(_linked(compared, percent), "links")

    # Members of a pivot by component, then those outside its largest one
    # against all others.  With a frequent shingle in a node's prefix all its
    # rare ones are there, so a rare one that no other prefix holds is in no
    # other such node: of the shingles that x has beyond the pivot's, so many
    # are out of the question.
    parts = components(links).withColumnsRenamed({"id": "node", "component": "part"})
    facts = stored(nodes.select("node", "n", "n_cold").join(weights.select("node", "cold_shared"), "node").join(parts, "node", "left")
                   .select("node", "n", F.coalesce("part", "node").alias("part"), (F.col("n_cold") - F.col("cold_shared")).alias("own")), "facts")
    rows = (star.select("x", "y", "hot", "tokens").join(compared.select("x", "y", "both", "bits"), ["x", "y"], "left").join(facts.withColumnRenamed("node", "y"), "y")
            .select(F.col("x").alias("pivot"), F.col("y").alias("node"), "n", "part", "bits", "tokens",
                    (F.col("n") - F.col("both")).alias("extra"), F.col("own").cast("long").alias("own"), (F.col("hot") == 1).alias("hot")))
    own = (star.select(F.col("x").alias("node")).distinct().join(facts, "node")
           .select(F.col("node").alias("pivot"), "node", "n", "part", F.lit(None).cast("array<long>").alias("bits"), F.lit(None).cast("array<int>").alias("tokens"), F.lit(None).cast("long").alias("extra"), F.lit(0).cast("long").alias("own"), F.lit(False).alias("hot")))
    old, rows = (star, compared, facts, weights), stored(rows.unionByName(own), "rows")
    for table in old:
        discard(table)
    main = (rows.groupBy("pivot", "part").agg(F.count("*").alias("m")).groupBy("pivot")
            .agg(F.max(F.struct("m", "part")).alias("top"), F.count("*").alias("parts")).filter("parts > 1").select("pivot", F.col("top.part").alias("main")))
    open_rows = stored(rows.join(stored(main, "main"), "pivot").withColumn("stray", F.col("part") != F.col("main")).drop("main"), "open")
    discard(rows)
    a = open_rows.filter("stray").select("pivot", *(F.col(c).alias(f"a_{c}") for c in ("node", "n", "part", "bits", "tokens", "extra", "own", "hot")))
    b = open_rows.filter("node != pivot").select("pivot", "stray", *(F.col(c).alias(f"b_{c}") for c in ("node", "n", "part", "bits", "tokens", "extra", "own", "hot")))
    total = F.col("a_n") + F.col("b_n")
    common = F.aggregate(F.zip_with("a_bits", "b_bits", lambda v, w: F.bit_count(v.bitwiseAND(w))), F.lit(0), lambda acc, c: acc + c)
    beyond = lambda c: F.col(f"{c}_extra") - F.when(F.col("a_hot") & F.col("b_hot"), F.col(f"{c}_own")).otherwise(0)
    able = F.coalesce((100 + percent) * (common + F.least(beyond("a"), beyond("b"))) >= percent * total, F.lit(True))
    rest = (a.filter("a_node != pivot").join(b, (a["pivot"] == b["pivot"]) & (F.col("a_part") != F.col("b_part")) & (~F.col("stray") | (F.col("a_node") < F.col("b_node")))
                   & (100 * F.least("a_n", "b_n") >= percent * F.greatest("a_n", "b_n")) & F.arrays_overlap("a_tokens", "b_tokens") & able)
            .select(F.least("a_node", "b_node").alias("x"), F.greatest("a_node", "b_node").alias("y")).distinct())
    rest = stored(rest, "rest")  # by itself: its joins' shuffles are gone when prefixes are shipped
    few = stored(_sharing(rest, nodes, "second"), "few")
    discard(rest), discard(open_rows)
    again = _compare(_filtered(few, nodes).filter("able"), docs, words, bits=False)
    discard(few)
    links = links.unionByName(_linked(again, percent))

    named = stored(links.select(F.col("x_doc").alias("x"), F.col("y_doc").alias("y")), "named")
    final = components(named).withColumnsRenamed({"id": "rep"})
    degree = named.select("x").union(named.select("y")).groupBy(F.col("x").alias("rep")).agg(F.count("*").alias("n_links"))
    of_node = stored(classes.select("node", "rep").join(final, "rep", "left").join(degree, "rep", "left")
                     .select("node", F.coalesce("component", "rep").alias("component"), F.coalesce("n_links", F.lit(0)).alias("n_links")), "component")
    return (brief.join(of_node, "node", "left")
            .select("doc_id", F.col("n").cast("long").alias("n_shingles"), F.coalesce("n_links", F.lit(0)).alias("n_links"),
                    F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "doc_id")).alias("component_id")))
