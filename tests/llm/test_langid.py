import random
import zlib

import numpy as np

from leadforge.llm import langid

SYLLABLES = {"aa": ["ka", "tu", "ri", "mo"], "bb": ["sch", "ein", "ung", "ber"], "cc": ["é", "eau", "oi", "tre"]}


def text_of(lang, rng, words=30):
    return " ".join("".join(rng.choice(SYLLABLES[lang]) for _ in range(rng.randint(1, 4))) for _ in range(words))


def test_gradients_match_finite_differences():
    rng = np.random.default_rng(0)
    f = lambda *s: (rng.standard_normal(s) * 0.3).astype(np.float64)
    model = langid.Model(["a", "b"], [f(256, 9), f(256, 9)], [f(3, 9), f(3, 9)], f(6, 2), f(2))
    rows, counts, label = rng.integers(0, 256, (5, 6)).astype(np.uint8), np.array([6, 6, 3, 1, 5]), np.array([0, 1, 1, 0, 1])
    _, grads = langid._gradients(model, rows, counts, label)
    for p, g in zip(model.weights(), grads):
        for at in [tuple(rng.integers(0, n) for n in p.shape) for _ in range(4)] + [(int(rows[0, 0]), 0)] * (p.shape[0] == 256):
            old = p[at]
            p[at] = old + 1e-2
            up, _ = langid._gradients(model, rows, counts, label)
            p[at] = old - 1e-2
            down, _ = langid._gradients(model, rows, counts, label)
            p[at] = old
            assert abs((up - down) / 2e-2 - g[at]) < 2e-3


def test_held_out_accuracy_and_edges(spark):
    rng = random.Random(0)
    rows = [(i, text_of(lang, rng), lang, "s") for i, lang in enumerate(rng.choices(list(SYLLABLES), k=400))]
    odd = [(1000, None, "aa", "x"), (1001, "", None, "x"), (1002, "12 .. 34", "bb", "x"), (1003, text_of("cc", rng, 9000), None, "x"), (None, text_of("bb", rng), "bb", "x")]
    docs = spark.createDataFrame(rows + odd, "doc_id long, text string, lang string, score string").repartition(3)
    got = {r["doc_id"]: r for r in langid.identify(docs).withColumn("held_out", langid.held_out()).collect()}
    assert len(got) == len(rows) + len(odd)
    held = [(got[i]["lang_pred"], lang) for i, _, lang, _ in rows if got[i]["held_out"]]
    assert all(got[i]["held_out"] == (zlib.crc32(str(i).encode()) % 5 == 0) for i, *_ in rows)
    assert len(held) > 40 and sum(a == b for a, b in held) / len(held) > 0.95
    assert all(0 <= r["score"] <= 1 for r in got.values())
    assert [got[i]["lang_pred"] for i in (1000, 1001, 1002)] == ["und"] * 3 and got[1003]["lang_pred"] == "cc"
    assert not got[None]["held_out"]


def test_nothing_to_learn_from(spark):
    docs = spark.createDataFrame([(1, "abc", None)], "doc_id long, text string, lang string")
    assert [r["lang_pred"] for r in langid.identify(docs).collect()] == ["und"]
    assert langid.identify(docs.limit(0)).count() == 0
