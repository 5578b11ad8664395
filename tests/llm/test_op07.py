"""Language ID: filters, accuracy on rows not learned from."""

import random

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from conftest import MEDIUM
from weblode.llm import op07_language as op
from weblode.llm.common import read_table, text_buffer


def test_grams():
    raw, at = text_buffer(pa.array(["The, x", "", "ab"]))
    values, first = op.grams(raw, at)
    assert [int(v).to_bytes(4, "little") for v in values] == [b" the", b"the "]
    assert first.tolist() == [0, 2, 2, 2]


def test_counts_against_sets():
    rng = np.random.default_rng(1)
    own = [set(rng.integers(0, 1 << 32, 300).tolist()) for _ in range(3)]
    slots = np.zeros(op.SLOTS, np.uint64)
    for k, s in enumerate(own):
        for place in op._slots(np.array(list(s))):
            slots[place] |= np.uint64(1 << k)
    filters = op.Filters(["a", "b", "c"], slots, np.ones(3), np.zeros(3))
    values = np.array([*list(own[0])[:50], *list(own[2])[:20]])
    got = filters.counts(values, np.array([0, 50, 70]))
    assert got[0, 0] == 50 and got[1, 2] == 20 and got[0, 1] <= 2


def test_held_out_accuracy(spark):
    documents = read_table(spark, MEDIUM, "documents")
    got = op.query(spark, MEDIUM).join(documents.select("doc_id", "lang"), "doc_id").collect()
    held = [r for r in got if r["held_out"]]
    assert len(got) == 1000 and 150 < len(held) < 350
    assert np.mean([r["lang"] == r["lang_pred"] for r in held]) > 0.97
    assert all(0 <= r["score"] <= 1 for r in got)


def test_edges(spark):
    rng = random.Random(2)
    rows = [(k, " ".join(rng.choices(("aba", "bab", "abba") if k % 2 else ("xyx", "yxy", "xyyx"), k=20)), "ab" if k % 2 else "xy") for k in range(40)]
    rows += [(None, "abba aba", None), (100, None, "ab"), (101, "", "xy"), (102, "12 34 !", "ab"), (103, "日本", None), (104, "aba " * 50_000, None), (104, "aba", None)]
    df = spark.createDataFrame([(*r, "c") for r in rows], "doc_id long, text string, lang string, letters string")
    filters = op.learn(df)
    got = op.predict(df, filters, {"doc_id": F.col("doc_id")}).collect()
    assert len(got) == len(rows)
    by = {r["doc_id"]: r for r in got}
    assert by[None]["lang_pred"] == "ab" and by[104]["lang_pred"] == "ab" and by[2]["lang_pred"] == "xy"
    assert all(by[k]["lang_pred"] == "und" and by[k]["score"] == 0 for k in (100, 101, 102))
    assert by[103]["lang_pred"] in ("ab", "xy")
    nothing = op.learn(df.limit(0))
    assert {r["lang_pred"] for r in op.predict(df, nothing, {"doc_id": F.col("doc_id")}).collect()} == {"und"}
    assert op.predict(df.limit(0), filters, {"doc_id": F.col("doc_id")}).count() == 0


def test_seventy_languages(spark):
    """More than a word of a slot has bits."""
    letters = [chr(0x4E00 + 7 * k) for k in range(70)]
    rows = [(f"l{k:02}", " ".join(a + letters[k] * j + a for j in range(1, 9))) for k, a in enumerate(letters) for _ in range(2)]
    filters = op.learn(spark.createDataFrame(rows, "lang string, text string"))
    assert len(filters.languages) == 70 and filters.slots.shape[1] == 2
    got = op.predict(spark.createDataFrame(rows, "lang string, text string"), filters, {"lang": F.col("lang")}).collect()
    assert all(r["lang"] == r["lang_pred"] for r in got) and len(got) == 140


def test_all_ngrams_of_a_language_are_kept(spark, monkeypatch):
    """100,000 n-grams, more than the smallest filter has room for."""
    monkeypatch.setattr(op, "SLOTS", 1 << 10)
    rng = random.Random(5)
    words = ["".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=8)) for _ in range(25_000)]
    rows = [("a", " ".join(words[k::40])) for k in range(40)] + [("b", "ж" * 9)]
    filters = op.learn(spark.createDataFrame(rows, "lang string, text string"))
    raw, at = text_buffer(pa.array([text for lang, text in rows if lang == "a"]))
    values = np.unique(op.grams(raw, at)[0])
    assert len(values) > 100_000 and len(filters.slots) >= op.SLOTS_PER_GRAM * len(values)
    assert filters.counts(values, np.array([0, len(values)]))[0, 0] == len(values)
    assert filters.false_rate.max() < 0.07


def test_the_sample_is_bounded_by_keys(spark, monkeypatch):
    monkeypatch.setattr(op, "SAMPLE_ROWS", 10)
    df = spark.range(440).select(F.lit("a").alias("lang"), F.concat(F.lit("text"), F.col("id") % 400).alias("text"))
    df = df.withColumn("h", F.xxhash64("text"))
    got = [r["h"] for r in op._sample(df, {"a": 440}).collect()]
    assert sorted(got) == sorted({r["h"] for r in df.collect()})[:10]


def test_kept_names_that_clash_are_refused(spark):
    import pytest

    with pytest.raises(ValueError, match="letters"):
        op.predict(spark.range(1).withColumn("text", F.lit("")), None, {"letters": F.col("id")})
