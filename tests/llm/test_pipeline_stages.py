import random

import corpus_pipeline as cp
from leadforge.llm import jaccard, langid, linededup
from tests.llm.test_jaccard import brute
from tests.llm.test_langid import SYLLABLES, text_of

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def corpus():
    rng = random.Random(8)
    docs = [(i, text_of(lang, rng, rng.randint(20, 90)), lang) for i, lang in enumerate(rng.choices(list(SYLLABLES), k=150))]
    for k in range(40):  # near copies: one word in the middle changed, too short a rest for the line dedup
        words = docs[k][1].split(" ")
        for at in range(15, len(words), 40):
            words[at] = "kakaka"
        docs.append((200 + k, " ".join(words), docs[k][2]))
    docs += [(300 + k, docs[k][1], docs[k][2]) for k in range(20)] + [(400, None, "aa"), (401, "", "aa"), (402, "12 ... !!", "bb"), (None, text_of("bb", rng, 70), "bb")]
    return docs


def test_stages_against_brute_force(spark, tmp_path):
    docs = corpus()
    df = spark.createDataFrame([(i, t, lang, "s", len(t or "")) for i, t, lang in docs], "doc_id long, text string, lang string, source string, n_chars long")
    df.repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    df = spark.read.parquet(f"{tmp_path}/documents.parquet")

    one = cp.language_id(spark, df, str(tmp_path))
    assert one.columns == COLUMNS
    kept = {r["doc_id"]: r["text"] for r in one.collect()}
    assert kept == {i: t for i, t, _ in docs if i not in (400, 401, 402)}

    two = cp.line_dedup(spark, one, str(tmp_path))
    assert two.columns == COLUMNS
    rows = two.collect()
    whole = {r["doc_id"]: r["text"] for r in linededup.dedup_lines(one).collect()}
    assert {r["doc_id"]: r["text"] for r in rows} == {i: t for i, t in whole.items() if t.strip()}
    assert all(r["n_chars"] == len(r["text"]) for r in rows)
    exact = [k for k in range(20) if len(docs[k][1].split()) >= 50]
    assert exact and not {300 + k for k in exact} & {r["doc_id"] for r in rows}

    three = cp.near_duplicates(spark, two, str(tmp_path))
    assert three.columns == COLUMNS
    want = {i for i, _, c in brute([(r["doc_id"], r["text"]) for r in rows], jaccard.WORDS, jaccard.PERCENT) if i is None or i == c}
    assert {r["doc_id"] for r in three.collect()} == want and len(want) < len(rows)

    packed = cp.run(spark, str(tmp_path)).collect()
    assert {r["doc_id"] for r in packed} == want
    assert cp.ORACLE_SQL is None and [n for n, _ in cp.STAGES] == ["language_id", "line_dedup", "near_duplicates", "packing"]


def test_empty_table(spark, tmp_path):
    spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    assert cp.run(spark, str(tmp_path)).count() == 0


def test_low_scores_are_rejected():
    assert 1 / len(SYLLABLES) < cp.MIN_SCORE and langid.score_texts(None, ["abc"]) == [("und", 0.0)]


def test_columns_named_like_the_operators_own_pass_through(spark, tmp_path):
    rng = random.Random(3)
    rows = [(i, text_of(lang, rng, 60), lang, f"p{i}", 7.5, i, "w") for i, lang in enumerate(rng.choices(list(SYLLABLES), k=60))]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, lang_pred string, Score double, n_removed long, words_removed string")
    for stage in (cp.language_id, cp.line_dedup):
        out = stage(spark, df, str(tmp_path))
        assert out.dtypes == df.dtypes
        got = [tuple(r) for r in out.collect()]
        assert got and set(got) <= set(rows)


def test_one_row_of_equal_documents_stays(spark, tmp_path):
    rng = random.Random(5)
    texts = [text_of("aa", rng, 80) for _ in range(4)]
    near = " ".join(w if k != 40 else "kakaka" for k, w in enumerate(texts[2].split(" ")))
    rows = [(1, texts[0])] * 3 + [(None, texts[1])] * 4 + [(5, texts[2]), (None, near), (6, texts[3]), (7, texts[3])]
    df = spark.createDataFrame([(i, t, f"s{k}") for k, (i, t) in enumerate(rows)], "doc_id long, text string, source string").repartition(3)
    got = [(r["doc_id"], r["text"]) for r in cp.near_duplicates(spark, df, str(tmp_path)).collect()]
    assert sorted(got, key=str) == sorted([(1, texts[0]), (None, texts[1]), (5, texts[2]), (6, texts[3])], key=str)
