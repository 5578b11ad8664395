"""The FM-index and contamination against brute force."""

import random
import re

import numpy as np
import pytest

from weblode.llm import op05_decontaminate as op


@pytest.mark.parametrize("seed", range(6))
def test_index(seed):
    rng = np.random.default_rng(seed)
    text = rng.integers(1, 2 + seed, int(rng.integers(1, 300)))
    if seed == 3:
        text[:] = 1
    order = op.suffix_array(text)
    assert order.tolist() == sorted(range(len(text)), key=lambda k: text[k:].tolist())
    index = op.FMIndex(text, int(text.max()) + 3)
    phrases = [text[k : k + n] for k in (0, len(text) // 2) for n in (1, 3, 7) if k + n <= len(text)]
    phrases.append(np.array([text[0], int(text.max()) + 1]))
    grid = np.zeros((7, len(phrases)), np.int32)
    for k, p in enumerate(phrases):
        grid[: len(p), k] = p[::-1]
    low, high = index.search(grid, np.array([len(p) for p in phrases]))
    for p, a, b in zip(phrases, low, high):
        expected = [k for k in range(len(text) - len(p) + 1) if (text[k : k + len(p)] == p).all()]
        assert sorted(index.locate(np.arange(a, b)).tolist()) == expected


def words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def brute(documents, items):
    out = []
    for key, text in documents:
        own, hit, names = words(text), set(), set()
        for name, phrase in items:
            w = words(phrase)
            n = min(13, len(w))
            for k in range(len(w) - n + 1 if n and name is not None else 0):
                for i in range(len(own) - n + 1):
                    if own[i : i + n] == w[k : k + n]:
                        hit.update(range(i, i + n))
                        names.add(str(name))
        out.append((key, len(own), len(hit), sorted(names), bool(hit) and 20 * len(hit) >= len(own)))
    return sorted(out, key=repr)


def run(spark, documents, items, **more):
    d = spark.createDataFrame([(*r, 1) for r in documents], "doc_id long, text string, spans int").repartition(3)
    b = spark.createDataFrame(items, "item_id long, text string")
    return op.find_contamination(d, b, **more).collect()


def test_against_brute_force(spark, monkeypatch):
    rng = random.Random(3)
    vocabulary = [f"w{k}" for k in range(30)] + ["É", "naïve"]
    items = [(k, " ".join(rng.choices(vocabulary, k=rng.choice((3, 9, 13, 20, 40))))) for k in range(25)]
    items += [(100, None), (101, " .. "), (None, items[0][1]), (3, "another w1 w2"), (102, "w1, W1; w1")]
    documents = []
    for k in range(80):
        text = rng.choices(vocabulary, k=rng.randrange(200))
        if k % 2:
            w = rng.choice(items[:25])[1].split()
            at = rng.randrange(len(w))
            text[rng.randrange(len(text) + 1) : 0] = w[at : at + rng.randrange(5, 30)]
        documents.append((k, rng.choice((" ", ", ", "\n")).join(text)))
    documents += [(None, None), (200, ""), (200, ""), (201, items[3][1].upper()), (202, "w1 " * 9000)]
    expected = brute(documents, items)
    pick = lambda got: sorted(((r["doc_id"], r["n_words"], r["n_hit"], r["items"], r["contaminated"]) for r in got), key=repr)
    got = run(spark, documents, items)
    assert pick(got) == expected
    texts = {r[0]: r[1] for r in documents}
    for r in got:
        assert r["n_hit"] == sum(len(words(texts[r["doc_id"]][s["start"] : s["end"]])) for s in r["spans"])
    # several passes, and several small shards, give the same
    monkeypatch.setattr(op, "SHARD_WORDS", 64)
    again = run(spark, documents, items, pass_words=150)
    assert sorted(map(repr, again)) == sorted(map(repr, got))


def test_items_without_a_name(spark):
    items = [(None, " ".join(f"n{k}" for k in range(9))), (None, "x y z"), (None, None), (7, "p q r")]
    documents = [(1, f"a {items[0][1]} b"), (2, "x y z p q r"), (3, "a b c"), (4, "p q r")]
    for pass_words in (1000, 4):
        got = {r["doc_id"]: r for r in run(spark, documents, items, pass_words=pass_words)}
        assert {k: (r["n_hit"], r["items"], r["contaminated"]) for k, r in got.items()} == {
            1: (9, [], True), 2: (6, ["7"], True), 3: (0, [], False), 4: (3, ["7"], True)}
        assert [tuple(s) for s in got[1]["spans"]] == [(2, 28)]


def test_empty(spark):
    assert run(spark, [], [(1, "a b")]) == []
    assert [(r["n_words"], r["n_hit"], r["contaminated"]) for r in run(spark, [(1, "a b c")], [])] == [(3, 0, False)]
