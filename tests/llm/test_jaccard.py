import random
import re

import pytest

from leadforge.llm import jaccard
from leadforge.llm.graph import components


def shingle_set(text, n):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub(r"[A-Z]", lambda m: m[0].lower(), text or ""))
    if len(words) < n:
        return {tuple(words)} if words else set()
    return {tuple(words[i:i + n]) for i in range(len(words) - n + 1)}


def brute(docs, n, percent):
    sets = [(i, shingle_set(t, n)) for i, t in docs]
    parent = {i: i for i, _ in docs if i is not None}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, (i, s) in enumerate(sets):
        for j, t in sets[:a]:
            if s and t and i is not None and j is not None and 100 * len(s & t) >= percent * len(s | t):
                x, y = sorted((find(i), find(j)))
                parent[y] = x
    return sorted(((i, len(s), find(i) if i is not None else None) for i, s in sets), key=str)


def corpus(seed):
    rng = random.Random(seed)
    vocab = ["".join(rng.choice("abcdefgh") for _ in range(4)) for _ in range(300)]
    text = lambda k: [rng.choice(vocab) for _ in range(k)]
    docs = [(0, ""), (1, None), (2, " \t\n"), (3, "one two"), (4, "One  TWO"), (5, "one"), (6, "É x y z"), (7, "é x y z")]
    base = [text(rng.randint(5, 120)) for _ in range(25)]
    common = text(40)
    for k in range(8, 330):
        words = list(rng.choice(base[:3] if k % 2 else base))
        for _ in range(rng.choice([0, 0, 1, 1, 2, 3, 8])):
            words[rng.randrange(len(words))] = rng.choice(vocab)
        if k % 7 == 0:
            words = text(6) + common + text(rng.randint(0, 5))
        docs.append((k, rng.choice([" ", "\n", "\t "]).join(words)))
    docs += [(400 + i, docs[20][1]) for i in range(12)] + [(500, "w " * 20000), (None, docs[20][1]), (None, None)]
    return docs


@pytest.mark.parametrize("words,percent", [(4, 85), (5, 80)])
def test_equals_brute_force(docs_of, words, percent, monkeypatch):
    if words == 5:
        monkeypatch.setattr(jaccard, "COUNTED", 5000)  # many counting blocks
        monkeypatch.setattr(jaccard, "HOT", 20)  # a table far too small
    docs = corpus(words)
    got = jaccard.near_duplicates(docs_of(docs), words, percent).collect()
    assert sorted(((r["doc_id"], r["n_shingles"], r["component_id"]) for r in got), key=str) == brute(docs, words, percent)


def test_edge_tables(docs_of):
    assert jaccard.near_duplicates(docs_of([])).count() == 0
    got = jaccard.near_duplicates(docs_of([(1, "a b c d e f"), (1, "z y x w v u"), (0, "z y x w v u")])).collect()
    assert sorted((r["doc_id"], r["component_id"]) for r in got) == [(0, 0), (1, 0), (1, 1)]


def test_components_of_chains_and_hubs(spark):
    rng = random.Random(0)
    ids = list(range(200))
    rng.shuffle(ids)
    links = list(zip(ids, ids[1:])) + [(1000, 1000 + i) for i in range(1, 300)] + [(5000, 5001)]
    got = dict(map(tuple, components(spark.createDataFrame(links, "x long, y long")).collect()))
    assert got == {**{i: 0 for i in range(200)}, **{1000 + i: 1000 for i in range(300)}, 5000: 5000, 5001: 5000}
