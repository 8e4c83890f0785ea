"""Collocations by set-oriented mining (SETM) of occurrence relations.

An occurrence relation R_k holds ``(piece, position, group)`` for every place
of every frequent phrase ("group") of k words, sorted by piece and position.
R_k is merge-joined with R_1 on the same piece and the next position, which
gives the occurrences of phrases of k + 1 words; these are group-counted, and
a semi-join with the frequent groups leaves R_(k+1).

The relations are persisted as tables of blocks: a row holds the sorted columns
of up to ``BLOCK_WORDS`` words of one language, and pieces never span blocks (a
break takes a position of its own, so that words of two pieces never stand next
to each other).  A merge join is thus local to a block.  Blocks of one language
lie together, some ``TOGETHER`` in a file, and what is shuffled are the
*distinct* groups of a task's blocks with their counts, however often they occur
in them: a task of blocks of every language would send the groups of each, and
all tasks nearly the same ones.  Counts are exact: a word is known by the number that the table of frequent
words gave it, a longer phrase by its words' numbers.  The semi-join of words is
a join; that of phrases tests a Bloom filter of the frequent ones, of
``BLOOM_BITS`` bits whatever their number, so that R_k holds some infrequent
groups too: what they are extended to is counted, and dropped for its count.

A phrase of 2 to ``LONGEST`` words that occurs ``LEAST`` times is a candidate;
its score is floor(2000000 a / (l + r)) for its weakest cut into a first part
(l occurrences) and a rest (r).  Candidates inside a longer candidate with at
least 80 % of their occurrences are dropped.

Edge cases: null text is empty; null languages are ``und``; repeated rows and
equal ids count as often as they stand there; an empty table gives no rows;
long texts are cut between pieces (one piece has to fit a task's memory); ties
rank by occurrences, then phrase; further columns of the input are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from itertools import count

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from leadforge.functions.bloom import bloom, maybe_in

from .common import discard, settings, slices, stored

LEAST, LONGEST, FIRST = 30, 4, 2000
#: A part that holds this share (percent) of a phrase's occurrences absorbs it.
ABSORBED = 80
SCALE = 2_000_000
BLOCK_WORDS, STEP_BYTES = 1 << 20, 1 << 20
BLOOM_BITS = 1 << 26
#: Counts that a task sums over its blocks before they leave it.
COUNT_ROWS = 1 << 19
#: Blocks of a language are put together from so many tasks (as a power of two),
#: and of so many blocks in a row of each.
TOGETHER = 2, 6
#: Rows of counts that leave a task at once.
SENT_ROWS = 1 << 16
#: Blocks are rows of some MB: few are read and sent at once, and the writer
#: looks at its pages' sizes after each (by default after 100), so that an
#: executor holds some blocks and not a file's.  Texts are sent by hundreds.
_FEW = ({"spark.sql.execution.arrow.maxRecordsPerBatch": "2", "spark.sql.parquet.columnarReaderBatchSize": "4"}
        | {f"parquet.{of}.size.row.check.{end}": "1" for of in ("page", "block") for end in ("min", "max")})
_FEW_TEXTS = _FEW | {"spark.sql.execution.arrow.maxRecordsPerBatch": "500", "spark.sql.parquet.columnarReaderBatchSize": "500"}

_FOLD = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ.,;:!?\n\x0b\x0c\r\t", b"abcdefghijklmnopqrstuvwxyz" + b"\n" * 10 + b" ")
_BREAK = re.compile(rb"[.,;:!?\n\x0b\x0c\r]")

BLOCKS = "block long, lang string, n_words long, words array<string>, counts array<long>, pos binary, code binary"
_BLOCKS = pa.schema([("block", pa.int64()), ("lang", pa.string()), ("n_words", pa.int64()), ("words", pa.list_(pa.string())),
                     ("counts", pa.list_(pa.int64())), ("pos", pa.binary()), ("code", pa.binary())])
#: ``pos1, code1, ids1``: R_1 of the block and the numbers of its words; ``pos,
#: code``: the occurrences of R_k; ``groups``: the codes of each group's words.
RELATION = "block long, k int, pos1 binary, code1 binary, ids1 binary, pos binary, code binary, groups binary"
_RELATION = pa.schema([("block", pa.int64()), ("k", pa.int32()), *((c, pa.binary()) for c in ("pos1", "code1", "ids1", "pos", "code", "groups"))])


class _Codes(dict):
    """Words of a block in order of first sight; spaces are -2, breaks -1."""

    def __init__(self):
        super().__init__({b"": -2, b"\n": -1})
        self.next = count()

    def __missing__(self, word: bytes) -> int:
        self[word] = code = next(self.next)
        return code


class _Open:
    """The block of a language that a task is filling."""

    def __init__(self):
        self.codes, self.held, self.size = _Codes(), [], 0

    def add(self, data: bytes) -> int:
        tokens = data.translate(_FOLD).replace(b"\n", b" \n ").split(b" ")
        codes = np.fromiter(map(self.codes.__getitem__, tokens), np.int32, len(tokens))
        self.held += [codes[codes != -2], np.array([-1], np.int32)]
        self.size += len(self.held[-2]) + 1
        return len(self.held[-2]) + 1

    def row(self, block: int, lang: str) -> dict:
        codes = np.concatenate(self.held)
        pos = np.flatnonzero(codes >= 0)
        words = [w.decode() for w, c in self.codes.items() if c >= 0]
        return {"block": block, "lang": lang, "n_words": len(pos), "words": words, "counts": np.bincount(codes[pos], minlength=len(words)),
                "pos": _steps(pos), "code": _packed(codes[pos])}


def _packed(x: np.ndarray, kind: str = "<i4") -> bytes:
    """A column of a block, compressed: a block's row stays a few MB."""
    return zstandard.compress(x.astype(kind).tobytes(), 1)


def _unpacked(data: bytes, kind: str = "<i4") -> np.ndarray:
    return np.frombuffer(zstandard.decompress(data), kind)


def _steps(pos: np.ndarray) -> bytes:
    """Sorted positions as differences: nearly all 1, which compress well."""
    return _packed(np.diff(pos, prepend=0))


def _positions(data: bytes) -> np.ndarray:
    return np.cumsum(_unpacked(data), dtype=np.int64)


def parts(text: bytes, size: int = STEP_BYTES) -> Iterator[bytes]:
    """``text`` cut at breaks into parts of about ``size`` bytes."""
    at = 0
    while len(text) - at > size and (end := _BREAK.search(text, at + size)):
        yield text[at:end.end()]
        at = end.end()
    yield text[at:]


def _block_rows(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    opened: dict[str, _Open] = {}
    number, size = count(TaskContext.get().partitionId() << 32), 0

    def flush():
        nonlocal size
        for lang, block in opened.items():
            yield pa.RecordBatch.from_pylist([block.row(next(number), lang)], schema=_BLOCKS)
        opened.clear()
        size = 0

    for b in slices(batches, 500):
        texts: dict[str, list[bytes]] = {}
        for lang, text in zip(b.column("lang").to_pylist(), b.column("text").to_pylist()):
            if text:
                texts.setdefault(lang, []).append(text.encode())
        for lang, several in texts.items():
            for part in parts(b"\n".join(several)):
                size += opened.setdefault(lang, _Open()).add(part)
                if size >= BLOCK_WORDS:
                    yield from flush()
    yield from flush()


def _first(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Blocks, each behind the row of its frequent words ``known`` -> R_1."""
    owner = known = None
    for b in slices(batches, 1):
        if b.num_rows and not b.column("code")[0].is_valid:
            owner, known = b.column("block")[0].as_py(), b.column("known").flatten()
        elif b.num_rows and b.column("block")[0].as_py() == owner:  # others have no frequent word
            pos, code = _positions(b.column("pos")[0].as_py()), _unpacked(b.column("code")[0].as_py())
            codes, ids = known.field("code").to_numpy(), known.field("id").to_numpy()
            new = np.full(int(max(code.max(initial=-1), codes.max(initial=-1))) + 1, -1, np.int32)
            new[codes] = np.arange(len(codes), dtype=np.int32)
            code = new[code]
            row = {"block": owner, "k": 1, "pos1": _steps(pos[code >= 0]), "code1": _packed(code[code >= 0]),
                   "ids1": _packed(ids, "<i8")}
            yield pa.RecordBatch.from_pylist([row], schema=_RELATION)


def mix(words: np.ndarray) -> np.ndarray:
    """64-bit hashes of the rows (phrases, as numbers of words)."""
    x = np.zeros(len(words), np.uint64)
    for column in words.T:
        x = (x ^ column.astype(np.uint64)) * np.uint64(0x9E3779B97F4A7C15)
        x ^= x >> np.uint64(29)
        x = x * np.uint64(0xBF58476D1CE4E5B9)
        x ^= x >> np.uint64(32)
    return x


def _bits(words: np.ndarray, bits: int) -> np.ndarray:
    h = mix(words)
    return np.stack([h & np.uint64(bits - 1), (h >> np.uint64(32)) & np.uint64(bits - 1)])


def _passes(held: np.ndarray, words: np.ndarray) -> np.ndarray:
    """Which phrases the Bloom filter lets pass."""
    able = np.ones(len(words), bool)
    for p in _bits(words, len(held) * 64):
        able &= (held[p >> np.uint64(6)] >> (p & np.uint64(63))) & np.uint64(1) == 1
    return able


class _Relation:
    """R_k of a block's row, merge-joined with R_1 on the position behind."""

    def __init__(self, b: pa.RecordBatch):
        get = lambda c: b.column(c)[0].as_py()
        self.own = {c: get(c) for c in ("block", "pos1", "code1", "ids1")}
        self.k = get("k")
        pos1, code1, self.ids = _positions(self.own["pos1"]), _unpacked(self.own["code1"]), _unpacked(self.own["ids1"], "<i8")
        many = max(1, len(self.ids))
        if self.k == 1:
            pos, code, groups = pos1, code1, np.arange(len(self.ids), dtype=np.int32).reshape(-1, 1)
        else:
            pos, code, groups = _positions(get("pos")), _unpacked(get("code")), _unpacked(get("groups")).reshape(-1, self.k)
        at = np.searchsorted(pos1, pos + self.k)
        hit = at < len(pos1)
        hit[hit] = pos1[at[hit]] == pos[hit] + self.k
        self.pos = pos[hit]
        found, self.code = np.unique(code[hit].astype(np.int64) * many + code1[at[hit]], return_inverse=True)
        self.groups = np.column_stack([groups[found // many], (found % many).astype(np.int32)])

    def counted(self, held: np.ndarray | None) -> tuple[np.ndarray, np.ndarray]:
        """The distinct groups, by their words' numbers, and their counts; not
        those whose last k words are infrequent (``held``: the filter of the
        frequent phrases of k words), as they are themselves."""
        words = self.ids[self.groups]
        able = slice(None) if held is None else _passes(held, words[:, 1:])
        return words[able], np.bincount(self.code, minlength=len(words))[able]

    def semi_joined(self, held: np.ndarray) -> pa.RecordBatch:
        """R_(k+1): what the Bloom filter of the frequent groups lets pass."""
        able = _passes(held, self.ids[self.groups])
        new = np.cumsum(able, dtype=np.int32) - 1
        keep = able[self.code]
        row = {"k": self.k + 1, "pos": _steps(self.pos[keep]), "code": _packed(new[self.code[keep]]), "groups": _packed(self.groups[able])}
        return pa.RecordBatch.from_pylist([self.own | row], schema=_RELATION)


def _added(counts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """The counts of several blocks, equal phrases as one row (those that a
    collision of hashes keeps apart are added up later, like other tasks')."""
    words, n = (np.concatenate(c) for c in zip(*counts))
    if len(counts) > 1 and len(n):
        order = np.argsort(mix(words))
        words, n = words[order], n[order]
        new = np.flatnonzero(np.append(True, (words[1:] != words[:-1]).any(axis=1)))
        words, n = words[new], np.add.reduceat(n, new)
    return words, n


def _summed(counts: list[tuple[np.ndarray, np.ndarray]]) -> pa.RecordBatch:
    words, n = _added(counts)
    return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in [*words.T, n]], names=[*(f"w{i}" for i in range(1, words.shape[1] + 1)), "n"])


def _counts(held):
    """Relations -> counts of the phrases of one word more."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, size = [], 0
        for b in slices(batches, 1):
            if b.num_rows:
                counts.append(_Relation(b).counted(held.value if held else None))
                size += len(counts[-1][1])
                if size >= COUNT_ROWS:
                    counts = [_added(counts)]
                    size = len(counts[0][1])
                    if 2 * size >= COUNT_ROWS:
                        yield from slices([_summed(counts)], SENT_ROWS)
                        counts, size = [], 0
        if counts:
            yield from slices([_summed(counts)], SENT_ROWS)

    return run


def _filter(frequent: DataFrame, words: list[str]) -> np.ndarray:
    """The Bloom filter of the frequent groups, as 64-bit words."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            p = _bits(np.column_stack([b.column(c).to_numpy() for c in words]), BLOOM_BITS).ravel()
            yield pa.RecordBatch.from_arrays([pa.array((p >> np.uint64(6)).astype(np.int64)), pa.array((np.uint64(1) << (p & np.uint64(63))).view(np.int64))], names=["at", "v"])

    rows = frequent.select(*words).mapInArrow(run, "at long, v long").groupBy("at").agg(F.bit_or("v").alias("v")).toArrow()  # BLOOM_BITS / 64 rows at most
    held = np.zeros(BLOOM_BITS >> 6, np.uint64)
    held[rows.column("at").to_numpy()] = rows.column("v").to_numpy().view(np.uint64)
    return held


def _stored_blocks(df: DataFrame, name: str, few: dict[str, str] = _FEW) -> DataFrame:
    """``stored`` where blocks are read or written."""
    with settings(df.sparkSession, few):
        return stored(df, name)


def frequent_phrases(docs: DataFrame, least: int = LEAST, longest: int = LONGEST, text_col: str = "text", lang_col: str = "lang") -> tuple[DataFrame, DataFrame, DataFrame]:
    """``(phrases: ids, f)`` of 1 to ``longest`` words, ``(words: id, lang,
    word, f)`` and ``(totals: lang, n)``."""
    spark = docs.sparkSession
    texts = docs.select(F.coalesce(F.col(lang_col).cast("string"), F.lit("und")).alias("lang"), F.col(text_col).cast("string").alias("text"))
    blocks = _stored_blocks(texts.mapInArrow(_block_rows, BLOCKS), "phrase-words", _FEW_TEXTS)
    totals = stored(blocks.groupBy("lang").agg(F.sum("n_words").alias("n")), "phrase-totals")
    entries = (blocks.select("block", "lang", F.posexplode(F.arrays_zip("words", "counts")).alias("code", "e"))
               .select("block", "lang", "code", F.col("e.words").alias("word"), F.col("e.counts").alias("n")))
    words = _stored_blocks(entries.groupBy("lang", "word").agg(F.sum("n").alias("f")).filter(F.col("f") >= least)
                   .withColumn("id", F.monotonically_increasing_id()), "phrase-frequent")
    # The semi-join: most of a block's words are infrequent, and stop here.
    key = F.xxhash64("lang", "word")
    known = _stored_blocks(entries.filter(maybe_in(bloom(words, key), key)).join(words.select("lang", "word", "id"), ["lang", "word"])
                   .groupBy("lang", "block").agg(F.collect_list(F.struct("code", "id")).alias("known")), "phrase-known")
    # A block and its words meet where the blocks of its language do.
    tasks, row = TOGETHER
    rows = (blocks.select("lang", "block", "pos", "code").unionByName(known, allowMissingColumns=True)
            .withColumns({"task": F.shiftright("block", 32 + tasks), "row": F.shiftright(F.col("block").bitwiseAND(F.lit((1 << 32) - 1)), row)}))
    rows = rows.repartition("lang", "task", "row").sortWithinPartitions("lang", "block", F.col("code").isNotNull())
    relation = _stored_blocks(rows.select("block", "pos", "code", "known").mapInArrow(_first, RELATION), "relation-1")
    discard(blocks), discard(known)
    found = [words.select(F.array("id").alias("ids"), "f")]
    held = None
    for k in range(2, longest + 1):
        columns = [f"w{i}" for i in range(1, k + 1)]
        schema = ", ".join(f"{c} long" for c in [*columns, "n"])
        frequent = _stored_blocks(relation.mapInArrow(_counts(held), schema).groupBy(*columns).agg(F.sum("n").alias("f")).filter(F.col("f") >= least), f"phrases-{k}")
        found.append(frequent.select(F.array(*columns).alias("ids"), "f"))
        if k < longest:
            held = spark.sparkContext.broadcast(_filter(frequent, columns))

            def join(batches: Iterable[pa.RecordBatch], held=held) -> Iterator[pa.RecordBatch]:
                for b in slices(batches, 1):
                    if b.num_rows:
                        yield _Relation(b).semi_joined(held.value)

            old, relation = relation, _stored_blocks(relation.mapInArrow(join, RELATION), f"relation-{k}")
            discard(old)
    discard(relation)
    phrases = found[0]
    for p in found[1:]:
        phrases = phrases.unionByName(p)
    return stored(phrases, "phrases"), words, totals


def _inside(ids: Column) -> Column:
    """All phrases of two words and more inside a longer one."""
    size = F.size(ids)
    return F.flatten(F.transform(F.sequence(F.lit(2), size - 1), lambda m: F.transform(F.sequence(F.lit(1), size - m + 1), lambda s: F.slice(ids, s, m))))


def scored(phrases: DataFrame, absorbed: int = ABSORBED, scale: int = SCALE) -> DataFrame:
    """``ids, a, l, r, score`` of the candidates that no longer one absorbs.
    Products are decimals of 38 digits: exact whatever the counts."""
    candidates = phrases.filter(F.size("ids") >= 2).withColumnRenamed("f", "a")
    cuts = (candidates.withColumn("k", F.explode(F.sequence(F.lit(1), F.size("ids") - 1)))
            .select("ids", "a", "k", F.slice("ids", F.lit(1), F.col("k")).alias("first"), F.slice("ids", F.col("k") + 1, F.size("ids") - F.col("k")).alias("rest")))
    part = lambda c, f: phrases.select(F.col("ids").alias(c), F.col("f").alias(f))
    value = F.expr(f"(CAST({scale} AS DECIMAL(18, 0)) * CAST(a AS DECIMAL(20, 0))) DIV (CAST(l AS DECIMAL(20, 0)) + CAST(r AS DECIMAL(20, 0)))")
    least = (cuts.join(part("first", "l"), "first").join(part("rest", "r"), "rest")
             .groupBy("ids").agg(F.any_value("a").alias("a"), F.min(F.struct(value.alias("score"), "k", "l", "r")).alias("cut")))
    inside = (candidates.filter(F.size("ids") >= 3).select(F.explode(_inside(F.col("ids"))).alias("ids"), "a")
              .groupBy("ids").agg(F.max("a").alias("longer")))
    many = lambda c, x: F.col(c).cast("decimal(20, 0)") * F.lit(x).cast("decimal(5, 0)")
    return (least.join(inside, "ids", "left").filter(F.col("longer").isNull() | (many("longer", 100) < many("a", absorbed)))
            .select("ids", "a", "cut.l", "cut.r", "cut.score"))


def mine(docs: DataFrame, least: int = LEAST, longest: int = LONGEST, first: int = FIRST, text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """``lang, rank, phrase, a, l, r, n, score``: each language's first
    ``first`` collocations."""
    phrases, words, totals = frequent_phrases(docs, least, longest, text_col, lang_col)
    kept = scored(phrases)
    named = (kept.select("ids", "a", "l", "r", "score", F.posexplode("ids").alias("at", "id")).join(words.select("id", "lang", "word"), "id")
             .groupBy("ids").agg(*(F.any_value(c).alias(c) for c in ("lang", "a", "l", "r", "score")), F.sort_array(F.collect_list(F.struct("at", "word"))).alias("words"))
             .select("lang", F.array_join("words.word", " ").alias("phrase"), "a", "l", "r", "score"))
    best = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = named.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= first)
    return ranked.join(totals, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
