"""The Jaccard join against brute force."""

import random
import re

import numpy as np
import pyarrow as pa

from weblode.llm import op02_jaccard as op
from weblode.llm.common import text_buffer


def shingles(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not words:
        return set()
    return {tuple(words[k : k + 5]) for k in range(max(len(words) - 4, 1))}


def brute(rows):
    sets = [shingles(t) for _, t in rows]
    label = list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            common = len(sets[i] & sets[j])
            if sets[i] and sets[j] and 100 * common >= 75 * len(sets[i] | sets[j]):
                a, b = label[i], label[j]
                label = [min(a, b) if x in (a, b) else x for x in label]
    least = {}
    for (key, _), x in zip(rows, label):
        if key is not None and (x not in least or key < least[x]):
            least[x] = key
    return sorted(((k, len(s), least.get(x)) for (k, _), s, x in zip(rows, sets, label)), key=repr)


def corpus(rng, n):
    vocabulary = [f"w{k}" for k in range(400)]
    passage = rng.choices(vocabulary, k=60)
    rows = []
    for k in range(n):
        kind = rng.random()
        words = rng.choices(vocabulary, k=rng.randrange(1, 120))
        if kind < 0.4 and rows:
            words = (rng.choice(rows)[1] or "x").split()
            for _ in range(rng.randrange(4)):
                words[rng.randrange(len(words))] = rng.choice(vocabulary)
        elif kind < 0.6:
            words += passage
        rows.append((k, " ".join(words)))
    return rows


def run(spark, rows):
    df = spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, text string, group int").repartition(5)
    got = op.jaccard_groups(df).collect()
    return sorted(((r["doc_id"], r["n_shingles"], r["component_id"]) for r in got), key=repr)


def test_against_brute_force(spark):
    rows = corpus(random.Random(5), 150)
    rows += [(200, None), (201, ""), (202, " \n"), (203, "One two"), (204, "ONE  two"), (None, "one two"), (None, None), (205, rows[3][1]), (3, rows[3][1])]
    rows.append((206, "x y z " * 5000))
    assert run(spark, rows) == brute(rows)


def test_small_blocks_and_frequent_shingles(spark, monkeypatch):
    monkeypatch.setattr(op, "FREQUENT", 3)
    monkeypatch.setattr(op, "TILE", 4)
    monkeypatch.setattr(op, "SMALL", 3)
    rows = corpus(random.Random(6), 120)
    assert run(spark, rows) == brute(rows)


def test_many_altered_copies(spark):
    rng = random.Random(8)
    base = [f"v{k}" for k in range(200)]
    rows = [(0, " ".join(base))]
    for k in range(1, 60):
        own = list(base)
        for _ in range(5):
            own[rng.randrange(200)] = f"n{rng.randrange(9999)}"
        rows.append((k, " ".join(own)))
    assert run(spark, rows) == brute(rows)


def test_empty(spark):
    assert run(spark, []) == []


def test_signatures_bound_the_difference():
    rng = np.random.default_rng(2)
    for _ in range(200):
        one = np.unique(rng.integers(0, 1 << 63, rng.integers(1, 300)).astype(np.uint64))
        two = np.unique(np.concatenate([one[: rng.integers(0, len(one)) + 1], rng.integers(0, 1 << 63, rng.integers(0, 200)).astype(np.uint64)]))
        x, y = op.signature(one), op.signature(two)
        size = min(len(x), len(y))
        apart = np.bitwise_count(op._folded(x, size) ^ op._folded(y, size)).sum()
        assert apart <= len(np.setxor1d(one, two))


def test_shared_rows_across_batches():
    rng = random.Random(4)
    rows = sorted((rng.randrange(30), rng.randrange(6)) for _ in range(150))
    table = pa.table({"shingle": [a for a, _ in rows], "set": [b for _, b in rows], "n": [1] * 150, "reach": [1] * 150})
    expected = [r for r in sorted(set(rows)) if len({b for a, b in rows if a == r[0]}) > 1]
    for size in (1, 2, 7, 150):
        got = [(r["shingle"], r["set"]) for b in op._shared(iter(table.to_batches(size))) for r in b.to_pylist()]
        assert got == expected


def test_sets_of_short_texts():
    raw, at = text_buffer(pa.array(["a b c d e f", "a b", "", "a b c d e f"]))
    hashes, first = op.shingle_sets(raw, at)
    assert np.diff(first).tolist() == [2, 1, 0, 2]
    assert op.set_ids(hashes, first)[0] == op.set_ids(hashes, first)[3]
