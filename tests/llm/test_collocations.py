import random
import re
from collections import Counter

from pyspark.sql import functions as F

from leadforge.llm import collocations


def brute(rows, least, first=2000):
    f, n = Counter(), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        t = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split("[.,;:!?\n-\r]", t):
            ws = tuple(w for w in re.split("[ \t]+", piece) if w)
            n[lang] += len(ws)
            for k in range(1, 5):
                f.update((lang, ws[i:i + k]) for i in range(len(ws) - k + 1))
    c = {key: a for key, a in f.items() if len(key[1]) >= 2 and a >= least}
    out = {}
    for (lang, ws), a in c.items():
        if any(x == lang and 100 * b >= 80 * a and any(y[i:i + len(ws)] == ws for i in range(len(y) - len(ws) + 1)) for (x, y), b in c.items() if len(y) > len(ws)):
            continue
        score, k = min((2_000_000 * a // (f[lang, ws[:k]] + f[lang, ws[k:]]), k) for k in range(1, len(ws)))
        out.setdefault(lang, []).append((-score, -a, " ".join(ws).encode(), f[lang, ws[:k]], f[lang, ws[k:]]))
    return sorted((lang, r + 1, p.decode(), -a, x, y, n[lang], -s) for lang, all_ in out.items() for r, (s, a, p, x, y) in enumerate(sorted(all_)[:first]))


def texts():
    rng = random.Random(5)
    words = ["New", "york", "été", "the", "of", "a\x00b", "x\x1cy", "naïve", "日本", " ", "𝒳", "zz"]
    rows = []
    for i in range(120):
        t = "".join(rng.choice(words) + rng.choice([" ", " ", " ", "  ", "\t", ", ", ".", "\n", "\r\n", "\x0b", "!?"]) for _ in range(rng.randrange(0, 60)))
        rows.append((rng.choice(["en", "fr", None, "und"]), t + rng.choice(["", "New York state of mind. ", "a a a a a"])))
    return rows + [("en", None), ("en", ""), (None, None), ("en", rows[0][1]), ("en", rows[0][1]), ("de", "one two " * 400), ("de", " \t ")]


def test_equals_brute_force(spark, monkeypatch):
    rows = texts()
    df = spark.createDataFrame(rows, "lang string, text string").selectExpr("*", "7 AS id", "7 AS n", "7 AS block", "'w' AS word").repartition(3)
    for words, step in ((collocations.BLOCK_WORDS, collocations.STEP_BYTES), (300, 50)):
        monkeypatch.setattr(collocations, "BLOCK_WORDS", words)
        monkeypatch.setattr(collocations, "STEP_BYTES", step)
        monkeypatch.setattr(collocations.parts, "__defaults__", (step,))
        got = [tuple(r) for r in collocations.mine(df, least=4).collect()]
        assert sorted(got) == brute(rows, 4)
    few = sorted(tuple(r) for r in collocations.mine(df, least=4, first=3).collect())
    assert few == brute(rows, 4, 3)
    assert collocations.mine(df.limit(0)).count() == 0


def test_products_beyond_64_bits(spark):
    big = 1 << 61
    rows = [([1], big), ([2], big + 1), ([1, 2], big - 3)]
    got = collocations.scored(spark.createDataFrame(rows, "ids array<long>, f long")).collect()
    assert [(r["a"], r["l"], r["r"], r["score"]) for r in got] == [(big - 3, big, big + 1, 2_000_000 * (big - 3) // (2 * big + 1))]


def test_absorption_is_inclusive(spark):
    rows = [([i], 200) for i in (1, 2, 3, 4)] + [([1, 2], 100), ([2, 3], 101), ([1, 2, 3], 80)]
    got = {tuple(r["ids"]) for r in collocations.scored(spark.createDataFrame(rows, "ids array<long>, f long")).collect()}
    assert got == {(2, 3), (1, 2, 3)}


def test_long_text_is_cut_at_breaks_only():
    text = b"aaa bbb. " * 50 + b"c" * 500 + b"; tail"
    cut = list(collocations.parts(text, 40))
    assert b"".join(cut) == text and len(cut) > 5 and all(p.endswith((b".", b";")) for p in cut[:-1])


def test_words_of_a_block_stay_in_their_language(spark):
    df = spark.createDataFrame([("en", "a b " * 5), ("fr", "a b " * 3)], "lang string, text string").coalesce(1)
    got = {(r["lang"], r["phrase"]): (r["a"], r["n"]) for r in collocations.mine(df, least=3, longest=2).select("lang", "phrase", "a", "n", F.lit(0)).collect()}
    assert got == {("en", "a b"): (5, 10), ("en", "b a"): (4, 10), ("fr", "a b"): (3, 6)}
