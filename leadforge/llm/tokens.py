"""Byte-level BPE ids of whole texts, by the tokenizers library.

The library spends its time on byte mapping, offsets and merges, again for
every occurrence of a word.  Its pre-tokeniser cuts a text into pieces whose
ids do not depend on what stands around them, so each worker lets the
library's model encode a piece once and keeps the ids in a bounded cache.  The
ids equal ``Tokenizer.encode(text, add_special_tokens=False).ids`` (tested).
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Sequence
from struct import pack

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from tokenizers import Tokenizer

from .common import worker_cache

#: Entries and characters of keys of the cache's young generation.
CACHE_ENTRIES, CACHE_CHARS = 250_000, 4_000_000
#: Texts and bytes that are encoded together.
CHUNK_TEXTS, CHUNK_BYTES = 1000, 4 << 20

# The pre-tokeniser's pattern (fixed value of the public byte-level BPE).
PIECE = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+")

# Kinds of bytes, to see whether a cut before each space, comma, stop and line
# feed is certain: not with white space in a row or at the end, nor with
# punctuation after anything but a letter or digit.  Letters beyond ASCII are
# known for U+00C0 to U+00FF (byte C3 and another) without the two signs there.
_SPACE, _LINE, _STOP, _WHITE, _LETTER, _OTHER, _UNKNOWN = range(7)
_KIND = np.array([_SPACE if c == " " else _LINE if c == "\n" else _STOP if c in ",." else _UNKNOWN if c == "\0" else _WHITE if c.isspace() else _LETTER if c.isalnum() else _OTHER
                  for c in map(chr, range(128))] + [_LETTER if b in (*range(0x80, 0xC0), 0xC3) and b not in (0x97, 0xB7) else _UNKNOWN for b in range(128, 256)], np.uint8)
_CUT = np.isin(_KIND, (_SPACE, _LINE, _STOP))
_UNSURE = np.zeros(64, bool)
for _a, _b in ((_SPACE, _SPACE), (_SPACE, _LINE), (_SPACE, _WHITE), (_LINE, _LINE), (_WHITE, _LINE), (_SPACE, _STOP), (_LINE, _STOP), (_WHITE, _STOP), (_OTHER, _STOP), (_STOP, _STOP)):
    _UNSURE[8 * _a + _b] = True
#: Code points whose classes may differ between Unicode versions of the
#: libraries: such texts go to the tokenizers library whole.
_UNCOMMON = re.compile("[^\x00-ɏͰ-ϿЀ-ӿ‐-‧€ぁ-ゖ一-龥가-힣]")


def byte_alphabet() -> list[str]:
    """The character that stands for each byte in byte-level vocabularies:
    printable Latin-1 stands for itself, the others follow from U+0100 on."""
    own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in own]
    return [chr(b) if b in own else chr(0x100 + rest.index(b)) for b in range(256)]


_FORMATS = [f"<{n}I" for n in range(40)]


class Cache(dict):
    """Two generations of bounded size: a full young one becomes the old one,
    whose entries return when they are used again."""

    def __init__(self, entries: int = CACHE_ENTRIES, chars: int = CACHE_CHARS):
        self.entries, self.chars, self.size, self.old = entries, chars, 0, {}

    def age(self) -> None:
        if len(self) > self.entries or self.size > self.chars:
            self.old = dict(self)
            self.clear()
            self.size = 0

    def lacking(self, keys: Iterable[str]) -> list[str]:
        """The (distinct) keys in neither generation; old ones come back."""
        new, old = [k for k in keys if k not in self], self.old
        back = {k: old[k] for k in new if k in old}
        self.update(back)
        self.size += sum(map(len, back))
        return [k for k in new if k not in back]

    def learn(self, key: str, value: bytes) -> None:
        self[key] = value
        self.size += len(key)

    def learn_all(self, keys: list[str], values: list[bytes]) -> None:
        self.update(zip(keys, values))
        self.size += sum(map(len, keys))


class PieceEncoder:
    """``special``: whether special tokens' strings inside a text become their
    ids (the library's default) or ordinary text."""

    def __init__(self, path: str, special: bool = True, entries: int = CACHE_ENTRIES):
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.specials: dict[str, int] = {}
        if special:
            self.specials = {t.content: i for i, t in self.tokenizer.get_added_tokens_decoder().items()}
        else:
            self.tokenizer.encode_special_tokens = True
        self.special_re = re.compile("(" + "|".join(map(re.escape, self.specials)) + ")") if self.specials else None
        self.tokenize = self.tokenizer.model.tokenize
        self.table = {b: c for b, c in enumerate(byte_alphabet())}
        self.parts = Cache(entries)  # part of a text -> ids as little-endian uint32

    def _piece_ids(self, pieces: list[str]) -> list[bytes]:
        """Of pieces without line feeds: their bytes are mapped together."""
        mapped = "\n".join(pieces).encode().decode("latin-1").translate(self.table).split(self.table[10])
        found = [[t.id for t in tokens] for tokens in map(self.tokenize, mapped)] if pieces else []
        return [pack(_FORMATS[len(ids)], *ids) if len(ids) < 40 else np.array(ids, "<u4").tobytes() for ids in found]

    def _learn(self, parts: Iterable[str]) -> None:
        new = self.parts.lacking(parts)
        # A word with the space before it is a piece; others are cut.
        words = [p for p in new if p[1:].isalpha() and (p[0] == " " or p[0].isalpha())]
        self.parts.learn_all(words, self._piece_ids(words))
        if len(words) < len(new):
            rest = [p for p in new if p not in self.parts]
            cut = [PIECE.findall(p) for p in rest]
            lines = {x: np.array([t.id for t in self.tokenize(x.encode().decode("latin-1").translate(self.table))], "<u4").tobytes() for c in cut for x in c if "\n" in x}
            plain = [x for c in cut for x in c if x not in lines]
            of = lines | dict(zip(plain, self._piece_ids(plain)))
            self.parts.learn_all(rest, [b"".join([of[x] for x in c]) for c in cut])

    def encode_batch(self, texts: Sequence[str]) -> list[bytes]:
        """The ids of each text as little-endian uint32 bytes."""
        return self.encode_column(pa.array(texts, pa.string()))

    def encode_column(self, texts: pa.Array, rows: int = CHUNK_TEXTS, size: int = CHUNK_BYTES) -> list[bytes]:
        """The same for an Arrow array; null is the empty text."""
        texts = texts.fill_null("") if texts.null_count else texts
        ends = np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False), dtype=np.int64)
        out: list[bytes] = []
        while len(out) < len(texts):
            at = len(out)
            stop = int(np.searchsorted(ends, (ends[at - 1] if at else 0) + size, "right"))
            out += self._encode_chunk(texts.slice(at, max(1, min(rows, stop - at))))
        return out

    def _sure(self, texts: pa.Array, data: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Which texts may be cut at each space, comma, stop and line feed."""
        sure = np.ones(len(texts), bool)
        kinds = _KIND[data]
        pairs = _UNSURE[(kinds[:-1] << np.uint8(3)) | kinds[1:]]
        if len(pairs):
            last = ends[:-1] - 1  # the last byte of a text and the first of the next are no pair
            pairs[last[(last >= 0) & (last < len(pairs))]] = False
        odd = np.concatenate([np.flatnonzero(pairs), np.flatnonzero(kinds == _UNKNOWN)])
        sure[np.searchsorted(ends, odd, "right")] = False
        full = np.diff(ends, prepend=0) > 0
        sure[full] &= data[ends[full] - 1] != 32
        for special in self.specials:
            sure &= ~pc.match_substring(texts, special).to_numpy(zero_copy_only=False)
        return sure

    def _encode_chunk(self, texts: pa.Array) -> list[bytes]:
        self.parts.age()
        _, offsets, data = texts.buffers()
        bounds = np.frombuffer(offsets, np.int32)[texts.offset:texts.offset + len(texts) + 1].astype(np.int64)
        data = np.frombuffer(data or b"", np.uint8)[bounds[0]:bounds[-1]]
        bounds -= bounds[0]
        sure = self._sure(texts, data, bounds[1:])
        first = _CUT[data]
        first[bounds[:-1][bounds[:-1] < len(data)]] = True
        starts = np.flatnonzero(first)
        parts = pa.Array.from_buffers(pa.binary(), len(starts), [None, pa.py_buffer(np.append(starts, len(data)).astype(np.int32)), pa.py_buffer(data)])
        if not sure.all():
            keep = sure[np.searchsorted(bounds[1:], starts, "right")]
            starts, parts = starts[keep], parts.filter(pa.array(keep))
        # Each distinct part once; then every part's ids are gathered.
        coded = parts.dictionary_encode()
        distinct = coded.dictionary.cast(pa.string()).to_numpy(zero_copy_only=False).tolist()
        self._learn(distinct)
        known = list(map(self.parts.__getitem__, distinct))
        many = np.fromiter(map(len, known), np.int64, len(known)) // 4
        ids, at = np.frombuffer(b"".join(known), "<u4"), coded.indices.to_numpy()
        ends = np.cumsum(many[at])
        ids = ids[np.repeat((np.cumsum(many) - many)[at] - ends + many[at], many[at]) + np.arange(ends[-1] if len(ends) else 0)]
        cuts = np.append(0, ends)[np.searchsorted(starts, bounds)].tolist()
        out = [ids[a:b].tobytes() for a, b in zip(cuts, cuts[1:])]
        for i in np.flatnonzero(~sure).tolist():
            out[i] = self._encode_text(texts[i].as_py())
        return out

    def _encode_text(self, text: str) -> bytes:
        """A text with special tokens or rare characters: cut by the pattern,
        or left to the library."""
        plan: list[bytes] = []
        for seg in self.special_re.split(text) if self.special_re else [text]:
            if seg in self.specials:
                plan.append(self.specials[seg].to_bytes(4, "little"))
            elif _UNCOMMON.search(seg):
                plan.append(np.array(self.tokenizer.encode(seg, add_special_tokens=False).ids, dtype="<u4").tobytes())
            else:
                pieces = PIECE.findall(seg)
                self._learn(set(pieces))
                plan += map(self.parts.__getitem__, pieces)
        return b"".join(plan)


def piece_encoder(path: str, special: bool = True) -> PieceEncoder:
    """This worker's encoder (a Python worker serves many tasks)."""
    encoders, key = worker_cache("tokens"), (path, special)
    if key not in encoders:
        encoders[key] = PieceEncoder(path, special)
    return encoders[key]


def default_vocab() -> str:
    """Where the public byte-level vocabulary lies (a parameter everywhere)."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def word_vocab() -> str:
    """The public vocabulary with word ends."""
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")
