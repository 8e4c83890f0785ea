"""BPE encoding and decoding by forced boundaries.

If two neighbouring bytes never stand next to each other inside any token of
the vocabulary, no merge can span them: a cut between them is certain.  Texts
are cut where the tokenizer itself cuts (special tokens, white space,
pre-tokeniser) and at every such byte pair.  The fragments are encoded
independently of each other, each distinct one once per worker and cache
generation, and the ids are concatenated.  A fragment at the end of a word
gets the model's end-of-word suffix, one before it does not.

Edge cases: null text is empty text; empty text has no ids and decodes to "".
Ids and decoded text equal the library's (tested); further columns of the
input are ignored, repeated rows stay repeated.
"""

from __future__ import annotations

import gc
import hashlib
import json
import re
from collections.abc import Iterable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from .common import slices
from .tokens import Cache, byte_alphabet

#: Texts with other characters are normalised and cut by the library: below
#: U+0250 every character is in normal form C, and case and classes are stable.
_UNCOMMON = re.compile("[^\x00-\x1b\x20-ɏ]")


def inner_pairs(vocab: Iterable[str], suffix: str) -> set[str]:
    """All pairs of neighbours inside the tokens; every other pair is a cut."""
    pairs = set()
    for token in vocab:
        body = token[:-len(suffix)] if suffix and token.endswith(suffix) and token != suffix else token
        pairs.update(body[i:i + 2] for i in range(len(body) - 1))
    return pairs


class ForcedBoundaryBPE:
    def __init__(self, path: str, entries: int = 200_000):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        self.whole = Tokenizer.from_file(path)
        self.whole.no_truncation()
        self.whole.no_padding()
        self.specials = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.special_re = re.compile("(" + "|".join(map(re.escape, self.specials)) + ")") if self.specials else None
        self.word_re = regex.compile(spec["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"])
        suffix = spec["model"].get("end_of_word_suffix") or ""
        self.pairs = inner_pairs((t for t in spec["model"]["vocab"] if t not in self.specials), suffix)
        table = byte_alphabet()
        self.byte_map = {b: table[b] for b in range(256)}
        # Two encoders of bare fragments: with the suffix and without.
        bare = spec | {"normalizer": None, "pre_tokenizer": None, "post_processor": None, "added_tokens": []}
        self.last = Tokenizer.from_str(json.dumps(bare))
        self.inner = Tokenizer.from_str(json.dumps(bare | {"model": spec["model"] | {"end_of_word_suffix": None}}))
        size = self.whole.get_vocab_size()
        self.tokens = [(self.whole.id_to_token(i) or "").encode() for i in range(size)]
        self.chunks = Cache(entries)  # text without white space -> ids
        self.fragments = (Cache(entries // 2), Cache(entries // 2))  # inner, last

    def cuts(self, word: str) -> list[str]:
        """A pre-tokenised word (one character per byte) at its forced boundaries."""
        out, start, pairs = [], 0, self.pairs
        for i in range(1, len(word)):
            if word[i - 1:i + 1] not in pairs:
                out.append(word[start:i])
                start = i
        out.append(word[start:])
        return out

    def _learn_fragments(self, last: bool, fragments: set[str]) -> None:
        known = self.fragments[last]
        known.age()
        new = known.lacking(fragments)
        tokenize = (self.last if last else self.inner).model.tokenize
        for f in new:
            known.learn(f, b"".join([t.id.to_bytes(4, "little") for t in tokenize(f)]))

    def _encode_words(self, words: Iterable[Sequence[str]]) -> list[bytes]:
        """The ids of each list of pre-tokenised words, through their fragments."""
        split = [[self.cuts(w) for w in ws] for ws in words]
        self._learn_fragments(False, {f for ws in split for fs in ws for f in fs[:-1]})
        self._learn_fragments(True, {fs[-1] for ws in split for fs in ws})
        inner, last = (d.__getitem__ for d in self.fragments)
        return [b"".join(b"".join(map(inner, fs[:-1])) + last(fs[-1]) for fs in ws) for ws in split]

    def _learn_chunks(self, chunks: set[str]) -> None:
        self.chunks.age()
        new = self.chunks.lacking(chunks)
        words = ([w.encode().decode("latin-1").translate(self.byte_map) for w in self.word_re.findall(c)] for c in new)
        for c, ids in zip(new, self._encode_words(words)):
            self.chunks.learn(c, ids)

    def encode_batch(self, texts: Sequence[str], step: int = 512) -> list[bytes]:
        """The ids of each text as little-endian uint32 bytes."""
        gc.disable()  # hundreds of thousands of strings in lists, never a cycle
        try:
            return [ids for at in range(0, len(texts), step) for ids in self._encode_step(texts[at:at + step])]
        finally:
            gc.enable()

    def _encode_step(self, texts: Sequence[str]) -> list[bytes]:
        plans, need = [], set()
        for text in texts:
            plan: list = []
            for seg in self.special_re.split(text) if self.special_re else [text]:
                if seg in self.specials:
                    plan.append(self.specials[seg].to_bytes(4, "little"))
                elif _UNCOMMON.search(seg):
                    cut = self.whole.pre_tokenizer.pre_tokenize_str(self.whole.normalizer.normalize_str(seg))
                    plan.append(self._encode_words([[w for w, _ in cut]])[0])
                else:
                    chunks = seg.lower().split()
                    need.update(chunks)
                    plan.append(chunks)
            plans.append(plan)
        self._learn_chunks(need)
        get = self.chunks.__getitem__
        return [b"".join([p if isinstance(p, bytes) else b"".join(map(get, p)) for p in plan]) for plan in plans]

    def decode(self, ids: bytes) -> bytes:
        """UTF-8 of the decoded text: this kind of vocabulary has no decoder,
        so the tokens stand side by side with a space between."""
        return b" ".join(map(self.tokens.__getitem__, np.frombuffer(ids, "<u4").tolist()))


_CODECS: dict[str, ForcedBoundaryBPE] = {}


def codec(path: str) -> ForcedBoundaryBPE:
    """This worker's codec (a Python worker serves many tasks)."""
    if path not in _CODECS:
        _CODECS[path] = ForcedBoundaryBPE(path)
    return _CODECS[path]


def encode(docs: DataFrame, vocab: str, text_col: str = "text", id_col: str = "doc_id") -> DataFrame:
    """``doc_id, ids`` (little-endian uint32) of every whole text; no shuffle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches):
            ids = codec(vocab).encode_batch([t or "" for t in b.column(1).to_pylist()])
            yield pa.RecordBatch.from_arrays([b.column(0).cast(pa.int64()), pa.array(ids, pa.binary())], names=["doc_id", "ids"])

    return (docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
            .mapInArrow(run, "doc_id long, ids binary"))


def decode(encoded: DataFrame, vocab: str) -> DataFrame:
    """``doc_id, text`` from ``doc_id, ids``."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = [codec(vocab).decode(i or b"").decode() for i in b.column("ids").to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(texts, pa.string())], names=["doc_id", "text"])

    return encoded.select("doc_id", "ids").mapInArrow(run, "doc_id long, text string")


def digests(encoded: DataFrame, vocab: str) -> DataFrame:
    """``doc_id, n_tokens, ids_sha256, decoded_sha256`` from ``doc_id, ids``."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches):
            ids = [i or b"" for i in b.column("ids").to_pylist()]
            yield pa.RecordBatch.from_arrays([
                b.column("doc_id"), pa.array([len(i) // 4 for i in ids], pa.int64()),
                pa.array([hashlib.sha256(i).hexdigest() for i in ids], pa.string()),
                pa.array([hashlib.sha256(codec(vocab).decode(i)).hexdigest() for i in ids], pa.string())],
                names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return encoded.select("doc_id", "ids").mapInArrow(run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
