import hashlib
import random

import pytest

from leadforge.llm import chat

PARTS = ["\\", "<", "s", ">", "/", "[", "INST", "]", "[INST]", "</s>", "<<SYS>>", "<</SYS>>", "[ROLE]", "[SAYS]", "x", "\n", "<<", "SYS>>"]


def test_format_is_reversible():
    rng = random.Random(2)
    for _ in range(5000):
        turns = [(rng.choice(["user", "assistant", "system", "tool", "", "[ROLE]\\"]), "".join(rng.choice(PARTS) for _ in range(rng.randrange(8))))
                 for _ in range(rng.randrange(4))]
        text, spans = chat.render(turns)
        assert chat.parse(text) == turns
        assert [chat.unescape(text[a:b]) for a, b in spans] == [t for r, t in turns if r == "assistant"]


@pytest.mark.parametrize("bad", ["x", "[INST]x", "[INST]x</s>", "</s>", "[ROLE]x[/ROLE]"])
def test_other_text_is_no_conversation(bad):
    with pytest.raises(ValueError):
        chat.parse(bad)


def events(spark, rows):
    return spark.createDataFrame([(c, s, 0, m, 0, k, r, t) for c, s, m, k, r, t in rows], chat.EVENTS)


def test_fold(spark):
    log = [(1, 0, 1, "start", "user", "he"), (1, 1, 1, "delta", None, "llo"), (1, 2, 2, "start", "assistant", None), (1, 3, 2, "delta", None, "bad"),
           (1, 4, 3, "start", "user", "dropped"), (1, 5, 2, "regenerate", None, None), (1, 6, 2, "delta", None, "go"), (1, 7, 2, "delta", None, "od"),
           (1, 8, 1, "edit", None, "hi"), (1, 9, 3, "delta", None, "lost"), (1, 10, 9, "what", None, None), (2, 0, 1, "edit", None, "x"),
           (None, 0, 1, "start", None, None)]
    random.Random(0).shuffle(log)
    got = {r["conv_id"]: r for r in chat.format_conversations(events(spark, log).repartition(4)).collect()}
    assert got[1]["formatted"] == "[INST]hi[/INST]<s>good</s>" and got[1]["n_ignored"] == 2
    assert got[1]["loss_spans"][0]["end"] - got[1]["loss_spans"][0]["start"] == 4
    assert got[2]["n_turns"] == 0 and got[2]["formatted"] == "" and got[2]["n_ignored"] == 1
    assert chat.parse(got[None]["formatted"]) == [("", "")]


def test_replayed_tables(spark):
    long = "ab[/INST]c\\" * 3000
    rows = [(1, 1, "assistant", long), (1, 0, "user", None), (2, 0, "user", "q"), (2, 0, "user", "q"), (3, 5, None, "x"), (3, None, "system", "first"), (4, 0, "tool", "é😀")]
    table = spark.createDataFrame(rows, "conv_id long, turn int, role string, text string").selectExpr("*", "1 AS seq", "2 AS sub", "'k' AS kind")
    got = {r["conv_id"]: r for r in chat.digests(chat.format_conversations(chat.replay(table, delta_chars=1000))).collect()}
    want = {1: [("user", ""), ("assistant", long)], 2: [("user", "q"), ("user", "q")], 3: [("system", "first"), ("", "x")], 4: [("tool", "é😀")]}
    for c, turns in want.items():
        loss = "".join(t for r, t in turns if r == "assistant")
        assert got[c]["n_turns"] == len(turns) and got[c]["loss_chars"] == len(loss)
        assert got[c]["turns_sha256"] == hashlib.sha256("".join(f"{r}\n{t}\n" for r, t in turns).encode()).hexdigest()
        assert got[c]["loss_sha256"] == hashlib.sha256(loss.encode()).hexdigest()
        assert got[c]["formatted_chars"] == len(chat.render(turns)[0])
    assert chat.format_conversations(chat.replay(table.limit(0))).count() == 0
