import hashlib
import random

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

from leadforge.llm import bpe

VOCAB = public_tokenizers.path("word_bpe_49k.json")
LIB = Tokenizer.from_file(VOCAB)
ALPHABET = "ab'sé \n\t.,12ß漢 \x1cÉİΣςσ́e \x85Å<|endoftext|><|ENDOFTEXT|>😀"


def fuzz(n):
    rng = random.Random(1)
    fixed = ["<|startoftext|>a<|endoftext|> b", "</w> w</w>", "don't we'll", "x" * 3000, "", " ", "word " * 4000, "ΑΣ ΑΣ."]
    return fixed + ["".join(rng.choice(ALPHABET) for _ in range(rng.randrange(40))) for _ in range(n)]


def test_ids_and_text_equal_the_library():
    c = bpe.ForcedBoundaryBPE(VOCAB, entries=40)
    texts = fuzz(800)
    for t, ids in zip(texts, c.encode_batch(texts, step=9)):
        want = LIB.encode(t, add_special_tokens=False).ids
        assert np.frombuffer(ids, "<u4").tolist() == want
        assert c.decode(ids).decode() == LIB.decode(want, skip_special_tokens=False)


def test_forced_cuts_never_fall_inside_a_token():
    c = bpe.ForcedBoundaryBPE(VOCAB)
    for token in list(LIB.get_vocab())[::97]:
        body = token.removesuffix("</w>") or token
        if token not in c.specials:
            assert c.cuts(body) == [body]
    cut = [w for w in ("qzj", "xvqk", "zzxq", "thetion") if len(c.cuts(w)) > 1]
    assert cut, "some pair has to force a boundary"


def test_documents(docs_of):
    rows = list(enumerate(["", None, "The Same", "The Same", "A<|endoftext|>b", "long " * 5000])) + [(2, "again"), (None, "no id")]
    got = sorted(map(tuple, bpe.digests(bpe.encode(docs_of(rows), VOCAB), VOCAB).collect()), key=str)
    want = []
    for i, t in rows:
        ids = LIB.encode(t or "", add_special_tokens=False).ids
        want.append((i, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(),
                     hashlib.sha256(LIB.decode(ids, skip_special_tokens=False).encode()).hexdigest()))
    assert got == sorted(want, key=str)
    texts = dict(map(tuple, bpe.decode(bpe.encode(docs_of(rows[:5]), VOCAB), VOCAB).collect()))
    assert texts[1] == "" and texts[2] == "the</w> same</w>"
    assert bpe.encode(docs_of([]), VOCAB).count() == 0
