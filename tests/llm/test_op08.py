"""Toxicity: n-grams, probabilities, separation of planted words."""

import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from weblode.llm import op08_toxicity as op
from weblode.llm.common import text_buffer


def test_grams():
    texts = ["Ab c", "", "é"]
    raw, at = text_buffer(pa.array(texts))
    values, first = op.grams(raw, at)
    got = [int(v).to_bytes(5, "big") for v in values]
    expected = []
    for t in texts:
        padded = b"    " + t.lower().encode() + b" "
        expected += [padded[k : k + 5] for k in range(len(padded) - 4)]
    assert got == expected and np.diff(first).tolist() == [5, 1, 3]


def test_shared_probabilities_sum_to_one(spark):
    rng = np.random.default_rng(0)
    letters = rng.integers(97, 101, (500, op.ORDER))
    gram = np.unique((letters << (8 * np.arange(op.ORDER)[::-1])).sum(axis=1))
    df = spark.createDataFrame([(0, int(g)) for g in gram], "m int, gram long")
    p = {r["suffix"]: r["shared"] for r in op.shared_probabilities(df).collect()}
    assert set(p) == {int(g) & 0xFFFFFFFF for g in gram}
    totals, followed = {}, {}
    for s, v in p.items():
        totals[s >> 8] = totals.get(s >> 8, 0) + v
        followed[s >> 8] = followed.get(s >> 8, 0) + 1
    assert all(0 < v <= 1 + 1e-9 for v in totals.values())
    full = [v for c, v in totals.items() if followed[c] == 4]
    assert full and min(full) > 0.95  # the rest is left for other bytes


class BruteForce:
    """The models by their definition, one n-gram at a time."""

    def __init__(self, rows):
        self.n = {0: {}, 1: {}}
        for text, toxic in rows:
            for g in self.grams(text):
                self.n[toxic][g] = self.n[toxic].get(g, 0) + 1
        self.sets, longer = {}, set(self.n[0]) | set(self.n[1])
        for k in range(op.ORDER - 1, 0, -1):
            self.sets[k] = {}
            for g in longer:
                self.sets[k][g[-k:]] = self.sets[k].get(g[-k:], 0) + 1
            longer = set(self.sets[k])

    @staticmethod
    def grams(text):
        low = bytes(c + 32 if 65 <= c <= 90 else c if c >= 97 and c < 123 or c >= 128 else 32 for c in (text or "").encode())
        padded = b" " * (op.ORDER - 1) + low + b" "
        return [padded[k : k + op.ORDER] for k in range(len(padded) - op.ORDER + 1)]

    def shared(self, g):
        k = len(g)
        if k == 1:
            return (self.sets[1][g] + 0.5) / (sum(self.sets[1].values()) + 128)
        own = [n for h, n in self.sets[k].items() if h[:-1] == g[:-1]]
        return (max(self.sets[k][g] - op.DISCOUNT, 0) + op.DISCOUNT * len(own) * self.shared(g[1:])) / sum(own)

    def ratio(self, g):
        logs = []
        known = g in self.n[0] or g in self.n[1]
        for toxic in (1, 0):
            own = [n for h, n in self.n[toxic].items() if h[:-1] == g[:-1]]
            left = op.DISCOUNT * len(own) / sum(own) if own else 1
            if known:
                logs.append(np.log((max(self.n[toxic].get(g, 0) - op.DISCOUNT, 0) / sum(own) if own else 0) + left * self.shared(g[1:])))
            else:
                logs.append(np.log(left))
        return logs[0] - logs[1]

    def words(self, text):
        out, fresh = [], True
        for g in self.grams(text):
            if fresh:
                out.append(0.0)
            out[-1] += self.ratio(g)
            fresh = g[-1:] == b" "
        return out


def brute_score(words, weights):
    n = len(words)
    above = [sum(max(w - step, 0) for w in words) / n for step in op.ABOVE]
    found = [sum(words) / n, *above, sum(w > op.ABOVE[-1] for w in words) / n, n**-0.5]
    z = weights[0] + sum(a * b for a, b in zip(found, weights[1:], strict=True))
    return 1 / (1 + np.exp(-np.clip(z, -40, 40)))


def test_models_and_scores_against_brute_force(spark, monkeypatch):
    rows = corpus(60, 3)
    df = spark.createDataFrame([(a, b) for a, b, _ in rows], "doc_id long, text string")
    labels = spark.createDataFrame([(a, c) for a, _, c in rows], "doc_id long, toxic int")
    from zlib import crc32

    brute = BruteForce([(b, c) for a, b, c in rows if crc32(str(a).encode()) % 5])
    texts = [b for _, b, _ in rows[:12]] + ["grobzik vexquam", "Unseen wörds; here", "", None, "x" * 40]
    asked = spark.createDataFrame(list(enumerate(texts)), "id int, text string")
    scores = []
    for entries in (10**9, 700):
        monkeypatch.setattr(op, "PART_ENTRIES", entries)
        model = op.learn(df, labels)
        got = {r["id"]: r["score"] for r in op.score(asked, model, {"id": F.col("id")}).collect()}
        assert [got[k] for k in range(len(texts))] == pytest.approx(
            [brute_score(brute.words(t), model.weights) for t in texts], abs=1e-6)
        scores.append([got[k] for k in range(len(texts))])
    assert model.parts >= 7 and scores[0] == pytest.approx(scores[1], abs=1e-6)


def test_every_fitted_entry_is_found(spark):
    rows = corpus(150, 4)
    df = spark.createDataFrame([(a, b) for a, b, _ in rows], "doc_id long, text string")
    model = op.learn(df, spark.createDataFrame([(a, c) for a, _, c in rows], "doc_id long, toxic int"))
    part = model.part(0)
    entries = {r["key"]: r["value"] for r in model.table.collect()}
    keys = np.array(list(entries))
    assert np.array_equal(part.look_up(keys), np.array(list(entries.values())))
    from zlib import crc32

    fitted = {int.from_bytes(g, "big") for a, b, _ in rows if crc32(str(a).encode()) % 5 for g in BruteForce.grams(b)}
    assert fitted | {g >> 8 | 1 << 62 for g in fitted} == set(entries)
    assert np.isnan(part.look_up(np.array([-5, 1 << 61]))).all()


def test_kept_names_that_clash_are_refused(spark):
    with pytest.raises(ValueError, match="words"):
        op.score(spark.range(1).withColumn("text", F.lit("")), None, {"words": F.col("id")})


def corpus(n, seed):
    rng = random.Random(seed)
    plain = ["".join(rng.choices("aeiounrtsl", k=rng.randrange(2, 8))) for _ in range(300)]
    out = []
    for k in range(n):
        words = rng.choices(plain, k=rng.randrange(10, 120))
        toxic = int(k % 6 == 0)
        for _ in range(2 + len(words) // 30 if toxic else 0):
            words.insert(rng.randrange(len(words)), rng.choice(("grobzik", "grobzak", "vexquam")))
        out.append((k, " ".join(words), toxic))
    return out


def test_held_out_rows(spark):
    rows = corpus(900, 1)
    df = spark.createDataFrame([(a, b, "c") for a, b, _ in rows], "doc_id long, text string, score string").repartition(4)
    labels = spark.createDataFrame([(a, c) for a, _, c in rows] + [(None, 1), (3, None), (999_999, 1)], "doc_id long, toxic int")
    model = op.learn(df, labels)
    more = spark.createDataFrame([(None, None), (-1, ""), (-2, "vexquam " * 20_000), (-3, "un rat"), (-3, "un rat")], "doc_id long, text string")
    both = df.select("doc_id", "text").unionByName(more)
    got = op.score(both, model, {"doc_id": F.col("doc_id"), "held": op.held_out(F.col("doc_id"))}).collect()
    assert len(got) == len(rows) + 5 and all(0 <= r["score"] <= 1 for r in got)
    toxic = {a: c for a, _, c in rows}
    held = [r for r in got if r["held"] and r["doc_id"] in toxic]
    right = [(r["score"] >= 0.5) == bool(toxic[r["doc_id"]]) for r in held]
    assert len(held) > 100 and np.mean(right) > 0.95
    by = {r["doc_id"]: r["score"] for r in got}
    assert by[-2] > 0.5 and by[None] == by[-1] < 0.5


def test_labels_beyond_the_broadcast_and_small_tables(spark, monkeypatch):
    rows = corpus(200, 2)
    df = spark.createDataFrame([(a, b) for a, b, _ in rows], "doc_id long, text string")
    labels = spark.createDataFrame([(a, c) for a, _, c in rows], "doc_id long, toxic int")
    one = op.learn(df, labels)
    monkeypatch.setattr(op, "MAX_LABELS", 0)
    two = op.learn(df, labels)
    assert (one.part(0).keys == two.part(0).keys).all() and np.allclose(one.part(0).values, two.part(0).values)
    assert np.allclose(one.weights, two.weights)


def test_nothing_to_learn(spark):
    df = spark.createDataFrame([(1, "a"), (2, None)], "doc_id long, text string")
    model = op.learn(df, spark.createDataFrame([], "doc_id long, toxic int"))
    assert {r["score"] < 0.01 for r in op.score(df, model, {"doc_id": F.col("doc_id")}).collect()} == {True}
    assert op.score(df.limit(0), model, {"doc_id": F.col("doc_id")}).count() == 0


def test_counting_holds_few_ngrams_at_a_time(monkeypatch):
    """What a worker holds is bounded also inside a batch, and nothing is lost."""
    rng = np.random.default_rng(5)
    texts = ["".join(rng.choice(list("abcdefghij "), 300)) for _ in range(60)]
    batch = pa.RecordBatch.from_arrays(
        [pa.array(texts), pa.array([k % 2 for k in range(60)], pa.int32()), pa.array([k % 3 % 2 for k in range(60)], pa.int32())],
        names=["text", "toxic", "half"])
    whole = list(op._counted(iter([batch])))
    monkeypatch.setattr(op, "TEXT_STEP", 1000)
    monkeypatch.setattr(op, "HELD_GRAMS", 2000)
    pieces = list(op._counted(iter([batch])))
    assert len(pieces) > 1 and max(p.num_rows for p in pieces) < 3000
    sums = [pa.Table.from_batches(x).group_by("gram").aggregate([(c, "sum") for c in ("t0", "o0", "t1", "o1")]).sort_by("gram") for x in (whole, pieces)]
    assert sums[0].equals(sums[1]) and sums[0].num_rows > 3000
