"""The registered queries themselves, over whole sf0.001 tables: against their
SQL, or against a restatement that shares no code with the operator."""

import hashlib
import re
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pytest
from tokenizers import Tokenizer

import __spark_entry__ as entry
from leadforge.llm import queries as llm
from leadforge.llm.tokens import default_vocab, word_vocab

from tests.llm.test_jaccard import brute as brute_jaccard
from tests.llm.test_linededup import brute_words

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def docs(spark):
    rows = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text", "lang").collect()
    return sorted((r["doc_id"], r["text"] or "", r["lang"]) for r in rows)


@pytest.fixture(scope="module")
def run(spark):
    return lambda name: sorted(llm.QUERIES[name](spark, SF).collect(), key=lambda r: tuple(r)[:2])


def encoded(path, texts):
    t = Tokenizer.from_file(path)
    t.no_truncation()
    t.no_padding()
    return t, [e.ids for e in t.encode_batch(list(texts), add_special_tokens=False)]


def little(ids):
    return np.array(ids, "<u4").tobytes()


def test_entry_has_all_of_them():
    assert set(llm.QUERIES) <= set(entry.queries()) and set(llm.ORACLES) <= set(entry.oracle_sql())
    assert sorted({int(n.split("_")[0][2:]) for n in llm.QUERIES}) == list(range(1, 14))


@pytest.mark.parametrize("name", sorted(llm.ORACLES))
def test_equals_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "embeddings", "pages", "conversations"):
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    got = llm.QUERIES[name](spark, SF)
    want = con.sql(llm.ORACLES[name])
    assert sorted(got.columns) == sorted(want.columns)
    columns = sorted(got.columns)
    picked = con.sql(f"SELECT {', '.join(columns)} FROM ({llm.ORACLES[name]})").fetchall()
    assert sorted(map(str, (tuple(r) for r in got.select(*columns).collect()))) == sorted(map(str, picked)) and picked


def test_token_files(run, docs):
    _, ids = encoded(default_vocab(), (t for _, t, _ in docs))
    start, want = 0, []
    for (i, _, _), own in zip(docs, ids):
        want.append((i, start, len(own) + 1, zlib.crc32(little([*own, 0]))))
        start += len(own) + 1
    assert [(r["doc_id"], r["start"], r["n_tokens"], r["ids_crc32"]) for r in run("op2_token_files")] == want


def test_packing(run, docs):
    _, ids = encoded(default_vocab(), (t for _, t, _ in docs))
    ids = {i: [*own, 0] for (i, _, _), own in zip(docs, ids)}
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for r in run("op3_best_fit_packing"):
        by_doc[r["doc_id"]].append(r)
        by_sequence[r["sequence_id"]].append((r["offset"], r["length"]))
    for i, own in ids.items():
        at = 0
        for k, r in enumerate(sorted(by_doc[i], key=lambda r: r["piece"])):
            assert (r["piece"], r["start"]) == (k, at) and (r["length"] == 2048 or k == 0)
            assert r["ids_crc32"] == zlib.crc32(little(own[at:at + r["length"]]))
            at += r["length"]
        assert at == len(own) and (len(by_doc[i]) == 1 or len(own) > 2048)
    for places in by_sequence.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= 2048
    # An independent best-fit decreasing over the single pieces opens as many.
    rooms: list[int] = []
    for n in sorted((r["length"] for rows in by_doc.values() for r in rows), reverse=True):
        fit = [r for r in rooms if r >= n]
        if fit:
            rooms[rooms.index(min(fit))] -= n
        else:
            rooms.append(2048 - n)
    assert len(by_sequence) <= len(rooms)


def test_jaccard(run, docs):
    got = sorted(((r["doc_id"], r["n_shingles"], r["component_id"]) for r in run("op4_ngram_jaccard")), key=str)
    assert got == brute_jaccard([(i, t) for i, t, _ in docs], 4, 85)


def test_forced_boundary_bpe(run, docs):
    t, ids = encoded(word_vocab(), (t for _, t, _ in docs))
    digest = lambda b: hashlib.sha256(b).hexdigest()
    want = [(i, len(own), digest(little(own)), digest(t.decode(own, skip_special_tokens=False).encode())) for (i, _, _), own in zip(docs, ids)]
    assert [(r["doc_id"], r["n_tokens"], r["ids_sha256"], r["decoded_sha256"]) for r in run("op5_forced_boundary_bpe")] == want


def test_language_id(run, docs):
    got = {r["doc_id"]: r for r in run("op6_language_id")}
    held = {i: zlib.crc32(str(i).encode()) % 5 == 0 for i, _, _ in docs}
    assert {i: r["held_out"] for i, r in got.items()} == held
    judged = [(lang, got[i]["lang_pred"]) for i, t, lang in docs if held[i] and lang and len(re.findall(r"\w+", t)) >= 20]
    assert judged and sum(a == b for a, b in judged) >= 0.95 * len(judged)
    assert all(0 <= r["score"] <= 1 for r in got.values())
    assert all(got[i]["lang_pred"] == "und" for i, t, _ in docs if not any(c.isalpha() for c in t))


def test_paragraph_sketch(run, docs):
    """Likeness is the Jaccard similarity of the multisets of paragraphs."""
    def bag(text):
        return Counter(p.strip() for p in re.split(r"\n+|(?<=[.!?])\s+", text) if p.strip())

    def like(a, b):
        union = sum((a | b).values())
        return sum((a & b).values()) / union if union else 1.0

    rows = {r["doc_id"]: r for r in run("op7_paragraph_sketch")}
    assert len(rows) == len(docs)
    for k, (i, t, _) in enumerate(docs):
        after = docs[(k + 1) % len(docs)][1]
        q = len(t) // 4
        new = t[:len(t) - q] + after[:q]
        r = rows[i]
        assert (r["n_chars"], r["edited_sha256"]) == (len(t), hashlib.sha256(new.encode()).hexdigest())
        assert r["near_edited"] == pytest.approx(like(bag(t), bag(new))) and r["near_next"] == pytest.approx(like(bag(t), bag(after)))
    prints = {(t, rows[i]["fingerprint"]) for i, t, _ in docs}
    assert len(prints) == len({t for _, t, _ in docs})


def test_line_dedup(run, docs):
    solid = re.compile("[฀-໿぀-ヿ㐀-鿿]")
    assert not any(solid.search(t) for _, t, _ in docs)
    got = {r["doc_id"]: (" ".join(r["text"].split()), r["words_removed"]) for r in run("op8_line_dedup")}
    assert got == brute_words([(i, t) for i, t, _ in docs])


def test_token_counts(run, docs):
    t = Tokenizer.from_file(default_vocab())
    t.no_truncation()
    t.encode_special_tokens = True
    want = {i: len(e.ids) for (i, _, _), e in zip(docs, t.encode_batch([x for _, x, _ in docs], add_special_tokens=False))}
    assert {r["doc_id"]: r["n_tokens"] for r in run("op10_token_counts")} == want


def test_pipeline(spark, docs):
    rows = entry.queries()["pipeline"](spark, SF).collect()
    kept = {r["doc_id"] for r in rows}
    assert kept <= {i for i, _, _ in docs} and len(kept) > len(docs) // 2
    filled = Counter()
    for r in rows:
        filled[r["sequence_id"]] += r["length"]
    assert max(filled.values()) <= 2048
