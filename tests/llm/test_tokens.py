import random
import uuid
import zlib

import numpy as np
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from leadforge.llm import packing, token_counts, token_files
from leadforge.llm.common import shared_dir, stored
from leadforge.llm.tokens import PieceEncoder, default_vocab

TEXTS = ["", None, "a", " lead", "two  spaces ", "tab\tand\nnew \n line", "it's we'll 'tis", "ünï ß é", "<|endoftext|>",
         "x<|endoftext|> y <|endoftext|>", "12 345,67", "\x1c odd \x85 space ", "漢字 かな", "́ combining", "word " * 3000,
         "a" * 5000, "😀 emoji", "the same", "the same", "Խ ֋", "\U00010d50 new"]


def library_ids(texts, special=True):
    t = Tokenizer.from_file(default_vocab())
    t.encode_special_tokens = not special
    return [t.encode(x or "", add_special_tokens=False).ids for x in texts]


@pytest.mark.parametrize("special", [True, False])
def test_ids_equal_the_library(special):
    rng = random.Random(3)
    alphabet = "ab'sé \n\t.,12ß漢 \x1cÉ" + "<|endoftext|>"
    texts = [t or "" for t in TEXTS] + ["".join(rng.choice(alphabet) for _ in range(rng.randrange(60))) for _ in range(400)]
    plain = ["Ab", "cdé", "ïx", "7", "'s", " ", " ", " ", ".", ",", "\n", "(", "\t", "×"]
    texts += ["".join(rng.choice(plain) for _ in range(rng.randrange(40))) for _ in range(1500)]
    enc = PieceEncoder(default_vocab(), special, entries=50)
    want = library_ids(texts, special)
    assert [np.frombuffer(b, "<u4").tolist() for b in enc.encode_batch(texts)] == want
    column = pa.array(["x. y", *(t or None for t in texts), "z"]).slice(1, len(texts))
    for rows, size in ((7, 1 << 20), (1000, 100), (1, 1)):
        assert [np.frombuffer(b, "<u4").tolist() for b in enc.encode_column(column, rows, size)] == want
    assert enc.encode_batch([]) == [] and enc.encode_batch(["", ""]) == [b"", b""]


def test_token_files(spark, docs_of):
    rows = [(10 * i, t) for i, t in enumerate(TEXTS)] + [(10, "again"), (None, "no id")]
    path = f"{shared_dir(spark)}/tf-{uuid.uuid4().hex}"
    token_files.write_token_files(docs_of(rows), path, default_vocab())
    got = {}
    for r in token_files.read_token_files(spark, path).collect():
        got.setdefault(r["doc_id"], []).append((r["start"], np.frombuffer(r["ids"], "<u4").tolist()))
    want = {}
    for (i, t), ids in zip(rows, library_ids([t for _, t in rows])):
        want.setdefault(i, []).append(ids + [0])
    assert {k: sorted(x for _, x in v) for k, v in got.items()} == {k: sorted(v) for k, v in want.items()}
    at = 0
    for i in sorted(got, key=lambda i: (i is not None, i)):
        for start, ids in sorted(got[i]):
            assert start == at
            at += len(ids)
    some = token_files.read_documents(spark, path, [20, 30]).collect()
    assert {r["doc_id"] for r in some} == {20, 30}
    one = token_files.read_digests(spark, path).filter("doc_id = 20").first()
    assert one["ids_crc32"] == zlib.crc32(np.array(want[20][0], "<u4").tobytes())


def test_token_files_empty_table(spark, docs_of):
    path = f"{shared_dir(spark)}/tf-{uuid.uuid4().hex}"
    token_files.write_token_files(docs_of([]), path, default_vocab())
    assert token_files.read_token_files(spark, path).count() == 0


def test_wrong_dictionary_is_an_error(spark):
    good = token_files.train_dictionary([bytes([i % 7, 3, 5, i % 3]) * 20 for i in range(200)])
    block = {"shard": 0, "block": 0, "start": 0, "dict_hash": "0" * 64, "doc_ids": [1], "counts": [1], "width": [2], "offsets": [0, 1], "body": b"x"}
    import pyarrow as pa
    with pytest.raises(ValueError):
        list(token_files._decode({"0" * 64: good})([pa.RecordBatch.from_pylist([block])]))


def test_packing(docs_of):
    rows = [(i, t) for i, t in enumerate(TEXTS)] + [(100 + i, "word " * (i * 37 % 2500)) for i in range(60)] + [(5, "again")]
    got = packing.pack(docs_of(rows), default_vocab()).collect()
    per_doc, seqs = {}, {}
    for r in got:
        per_doc.setdefault(r["doc_id"], []).append(r)
        seqs.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    ids = library_ids([t for _, t in rows])
    want = sorted((i, k, s, n, zlib.crc32(np.array((x + [0])[s:s + n], "<u4").tobytes()))
                  for (i, _), x in zip(rows, ids) for k, (s, n) in enumerate(packing.cut(len(x) + 1)))
    assert sorted((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in got) == want
    for slots in seqs.values():
        at = 0
        for off, n in sorted(slots):
            assert off == at
            at += n
        assert at <= 2048
    assert sorted(seqs) == list(range(len(seqs)))
    total = sum(r["length"] for r in got)
    assert len(seqs) <= 1.1 * total / 2048 + 1


def test_packing_empty_table(docs_of):
    assert packing.pack(docs_of([]), default_vocab()).count() == 0


def test_cut():
    assert packing.cut(2048) == [(0, 2048)]
    assert packing.cut(5000) == [(0, 904), (904, 2048), (2952, 2048)]
    assert packing.cut(1) == [(0, 1)]


def best_fit(lengths, capacity):
    """Plain best-fit decreasing, one item at a time."""
    rooms = []
    for n in sorted(lengths, reverse=True):
        fit = min((r for r in rooms if r >= n), default=None)
        if fit is None:
            rooms.append(capacity - n)
        else:
            rooms[rooms.index(fit)] -= n
    return len(rooms)


def test_plan_is_best_fit_decreasing():
    rng = random.Random(1)
    for _ in range(60):
        lengths = [rng.randint(1, 40) for _ in range(rng.randrange(200))]
        hist = {n: lengths.count(n) for n in set(lengths)}
        entries = sorted(packing.plan(hist, 40))
        used = {}
        for n, c in hist.items():
            mine = [e for e in entries if e[0] == n] + [(n, c, 0, 1, 0)]
            for e, after in zip(mine, mine[1:]):
                for j in range(after[1] - e[1]):
                    used.setdefault(e[2] + j // e[3], []).append((e[4] + j % e[3] * n, n))
        for slots in used.values():
            at = 0
            for off, n in sorted(slots):
                assert off == at
                at += n
            assert at <= 40
        assert sum(map(len, used.values())) == len(lengths)
        assert len(used) == best_fit(lengths, 40)


def test_separator_scan(spark):
    rng = random.Random(5)
    files = []
    for f in range(4):
        ids = [rng.choice([1, 2, 3, 9] if f != 2 else [1, 2]) for _ in range(rng.randrange(2000, 5000))]
        files.append(ids)
    files.append([9, 9, 9])
    rows = [(f, k, np.array(ids[k * 2:(k + 1) * 2], "<u2").tobytes()) for f, ids in enumerate(files) for k in range(-(-len(ids) // 2))]
    got = token_counts.count_tokens(spark.createDataFrame(rows, "file int, block long, ids binary"), 9).collect()
    want = []
    for f, ids in enumerate(files):
        at, k = 0, 0
        for i, x in enumerate(ids):
            if x == 9:
                want.append((f, k, at, i - at, True))
                at, k = i + 1, k + 1
        if at < len(ids):
            want.append((f, k, at, len(ids) - at, False))
    assert sorted(map(tuple, got)) == want


def test_token_counts(docs_of):
    rows = [(i, t) for i, t in enumerate(TEXTS)] + [(5, "again")]
    flat = stored(token_counts.flat_files(docs_of(rows), default_vocab(), 50256, block_ids=16), "flat")
    got = token_counts.name_documents(token_counts.count_tokens(flat.filter("ids IS NOT NULL"), 50256), flat).collect()
    want = sorted((i, len(x)) for (i, _), x in zip(rows, library_ids([t for _, t in rows], special=False)))
    assert sorted((r["doc_id"], r["n_tokens"]) for r in got) == want
    empty = stored(token_counts.flat_files(docs_of([]), default_vocab(), 50256), "flat")
    assert token_counts.count_tokens(empty.filter("ids IS NOT NULL"), 50256).count() == 0


def test_width_is_read_from_the_blocks(spark, docs_of):
    """Ids of four bytes, as an end id beyond 16 bits makes them."""
    flat = stored(token_counts.flat_files(docs_of([(1, "the same"), (2, None), (3, "a b c")], 1), default_vocab(), 70_000, block_ids=3), "flat")
    assert {r["width"] for r in flat.collect()} == {4}
    got = token_counts.name_documents(token_counts.count_tokens(flat.filter("ids IS NOT NULL"), 70_000), flat).collect()
    want = dict(zip((1, 2, 3), map(len, library_ids(["the same", "", "a b c"], special=False))))
    assert {r["doc_id"]: r["n_tokens"] for r in got} == want
