import random
import re

from pyspark.sql import functions as F

from leadforge.llm import linededup


def units(text):
    return re.split(r"(?<=[.!?] )|(?<=\n)", text)


def line(rng, words=8):
    return " ".join("".join(rng.choice("abcdefghij") for _ in range(rng.randint(2, 7))) for _ in range(words)) + rng.choice([". ", "\n", "! "])


def brute(docs):
    """Unit places in runs of >= 50 words that stand earlier too."""
    docs = sorted(docs, key=lambda d: d[0])
    cut = {i: units(t or "") for i, t in docs}
    norm = {i: re.split(r"(?<=[.!?]) |\n", t or "") for i, t in docs}
    weight = {i: [u.count(" ") + 1 for u in us] for i, us in norm.items()}
    assert all(len(norm[i]) == len(cut[i]) for i in cut)
    gone = {i: set() for i, _ in docs}
    for a, (t, _) in enumerate(docs):
        for s, _ in docs[:a + 1]:
            for shift in range(-len(norm[s]), len(norm[t])):
                if s == t and shift <= 0:
                    continue
                run = []
                for k in range(len(norm[t]) + 1):
                    if k < len(norm[t]) and 0 <= k - shift < len(norm[s]) and norm[t][k] == norm[s][k - shift]:
                        run.append(k)
                    else:
                        if sum(weight[t][j] for j in run) >= linededup.MIN_WORDS:
                            gone[t].update(run)
                        run = []
    return {i: "".join(u for k, u in enumerate(cut[i]) if k not in gone[i]) for i, _ in docs}


def corpus(seed):
    rng = random.Random(seed)
    passages = ["".join(line(rng) for _ in range(n)) for n in (7, 8, 12)] + [line(rng, 60), "".join(line(rng, 2) for _ in range(40))]
    docs = [(0, ""), (1, None), (2, "short. text. "), (3, "x" * 200)]
    for i in range(4, 40):
        parts = ["".join(line(rng) for _ in range(rng.randint(0, 6))) for _ in range(3)]
        docs.append((i, parts[0] + rng.choice(passages) + parts[1] + rng.choice(passages + [""]) + parts[2]))
    docs += [(50, docs[10][1]), (51, docs[10][1]), (52, docs[10][1].replace(". ", ".\n"))]
    docs.append((60, "same words again and again. " * 400))
    return docs


def test_deletes_later_repeats(spark):
    docs = corpus(1)
    df = spark.createDataFrame([(i, t, "k", 5) for i, t in docs], "doc_id long, text string, k_id string, idx int").repartition(3)
    got = {r["doc_id"]: r for r in linededup.dedup_lines(df).collect()}
    want = brute(docs)
    assert len(got) == len(docs) and got[1]["text"] is None
    for i, t in docs:
        if t is not None:
            assert got[i]["text"] == want[i], i
            assert (got[i]["n_removed"] > 0) == (want[i] != t)
    assert got[51]["text"] == "" and got[2]["text"] == "short. text. " and got[3]["k_id"] == "k"


def test_edge_rows(spark):
    rng = random.Random(9)
    passage = "".join(line(rng) for _ in range(9))
    rows = [(None, "Odd start. " + passage), (7, passage), (7, passage), (7, passage + "Another end. "), (9, "Clean text stays. ")]
    alone = "".join(line(rng) for _ in range(12))
    rows += [(20, alone), (20, alone)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted(((r["doc_id"], r["text"]) for r in linededup.dedup_lines(df).collect()), key=str)
    assert got == sorted([(None, rows[0][1]), (7, ""), (7, ""), (7, "Another end. "), (9, rows[4][1]), (20, alone), (20, alone)], key=str)
    assert linededup.dedup_lines(df.limit(0)).count() == 0


def test_plan_is_native(spark):
    df = spark.createDataFrame([(1, "a")], "doc_id long, text string")
    plan = linededup.repeated_runs(df)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan


def brute_words(docs, size=linededup.MIN_WORDS):
    """Texts without the words in ``size`` words in a row that stand earlier too."""
    seen, out = set(), {}
    for i, text in sorted(docs):
        words, gone = text.split(), set()
        for at in range(len(words) - size + 1):
            run = tuple(words[at:at + size])
            if run in seen:
                gone.update(range(at, at + size))
            seen.add(run)
        out[i] = " ".join(w for k, w in enumerate(words) if k not in gone), len(gone)
    return out


def check_words(spark, docs):
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    got = {r["doc_id"]: (" ".join(r["text"].split()), r["words_removed"]) for r in linededup.dedup_lines(df).collect()}
    assert got == brute_words(docs)
    return got


def test_passages_inside_lines(spark):
    rng = random.Random(4)
    plain = lambda n: [line(rng, 1).strip(" .!\n") for _ in range(n)]
    ends = lambda words: [w + rng.choice(["", "", "", "", "", ".", "!", "\n"]) for w in words]
    passages = [ends(plain(n)) for n in (49, 50, 51, 55, 60, 130)] + [plain(n) for n in (50, 58, 200)]
    docs = []
    for i in range(60):
        words = (plain if i % 2 else lambda n: ends(plain(n)))(rng.randint(0, 150))
        for passage in rng.sample(passages, 2):
            at = rng.randint(0, len(words))
            words[at:at] = passage
        docs.append((i, rng.choice(["", " \n"]) + " ".join(words)))
    got = check_words(spark, docs)
    assert sum(n > 0 for _, n in got.values()) > 40


def test_lines_that_first_stand_alone(spark):
    rng = random.Random(6)
    one, two, three = (line(rng, 20) for _ in range(3))
    docs = [(k, line(rng, 30) + part + line(rng, 30)) for k, part in enumerate((one, two, three))]
    docs += [(k, line(rng, 9) + one + two + three + line(rng, 9)) for k in (10, 11)]
    edited = [line(rng, 30) for _ in range(4)]  # every part stands earlier, next to others
    docs += [(20 + k, " ".join(edited[:k] + [line(rng, 30)] + edited[k + 1:])) for k in range(4)] + [(30, " ".join(edited)), (31, "New. " + " ".join(edited))]
    docs += [(40, one + line(rng, 60) + one + two + line(rng, 60) + one + two + three)]
    got = check_words(spark, docs)
    assert got[10][1] == 0 and got[11][1] == 60 and got[31][1] == 120 and got[40][1] == 60


def test_words_are_no_white_space_and_solid_scripts_count_characters(spark):
    rng = random.Random(12)
    blank = "\n" * 60 + "a   b" + " " * 70 + "end.\n"
    tabs = "\t".join(line(rng, 1).strip() for _ in range(60))
    han = "".join(chr(rng.randint(0x4E00, 0x9FFF)) for _ in range(58)) + "\U00020000" + "".join(chr(rng.randint(0xE01, 0xE2E)) for _ in range(20))
    han = han[:30] + "。" + han[30:]
    docs = [(1, line(rng, 20) + blank), (2, blank + line(rng, 20)), (3, tabs + "\tx"), (4, "y " + tabs.replace("\t", " ")),
            (5, "甲乙 abc" + han + "丙丁"), (6, "戊" + han + "def. 己"), (7, han[:45])]
    got = {r["doc_id"]: (r["text"], r["words_removed"]) for r in linededup.dedup_lines(spark.createDataFrame(docs, "doc_id long, text string")).collect()}
    assert all(got[i] == (t, 0) for i, t in docs if i in (1, 2, 3, 5, 7))
    assert got[4] == ("y ", 60) and got[6] == ("戊def. 己", len(han))


def test_filter_on_the_output_cuts_no_text_again(spark):
    rng = random.Random(2)
    passage = "".join(line(rng) for _ in range(9))
    df = spark.createDataFrame([(i, line(rng, 30) + passage) for i in range(6)], "doc_id long, text string")
    out = linededup.dedup_lines(df)
    kept = out.filter((F.col("n_removed") == 0) | (F.btrim("text", F.lit(" \t\r\n")) != ""))
    splits = lambda d: d._jdf.queryExecution().optimizedPlan().toString().count("split(")
    assert splits(kept) <= splits(out) + 1 and splits(kept.filter("words_removed < 5").select("doc_id")) <= splits(out) + 1
    assert kept.filter("words_removed > 0").count() == 5


def test_places_are_one_number_in_the_order_of_id_and_word(spark, monkeypatch):
    kept = {}
    stored = linededup.stored
    monkeypatch.setattr(linededup, "stored", lambda df, name: kept.setdefault(name, stored(df, name)))
    rng = random.Random(5)
    passage = " ".join(line(rng) for _ in range(9))
    docs = [(i, line(rng, 30) + passage) for i in (None, -3, 0, 7, 1 << 40)] + [(7, passage + line(rng, 30))] * 2
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(5)
    got = {(r["doc_id"], r["text"]): r["words_removed"] for r in linededup.dedup_lines(df).collect()}
    assert sum(v == 0 for v in got.values()) == 1 and next(k for k, v in got.items() if v == 0)[0] is None
    assert kept["line-windows"].dtypes == [("run", "bigint"), ("place", "bigint")]
    numbers = [tuple(r) for r in linededup._numbered(kept["line-originals"].select("k_id", "k_tie")).orderBy("number").collect()]
    assert numbers == sorted(numbers) and len({r[2] for r in numbers}) == len(numbers) == 6
