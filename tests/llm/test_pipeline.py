"""The pipeline, stage by stage, against what each should keep."""

import random
from collections import Counter

import pytest

import corpus_pipeline as pipeline
from conftest import SMALL
from weblode.llm.common import stage

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="module")
def docs(spark):
    rng = random.Random(4)
    vocabulary = ["".join(rng.choices("aeiounrtsl", k=rng.randrange(3, 8))) for _ in range(400)]
    rows = []
    for k in range(60):
        text = " ".join(rng.choices(vocabulary, k=rng.randrange(30, 90)))
        rows.append((k, text, "aa", f"s{k % 3}", len(text)))
    altered = rows[5][1].split()
    altered[10] = "changed"
    rows += [(100, " ".join(altered), "aa", "s0", 1), (101, rows[5][1], None, None, None), (5, rows[5][1], "aa", "s1", 1)]
    rows += [(102, None, "aa", "s1", None), (103, "", "aa", "s1", 0), (104, "12 34", "aa", "s1", 5), (None, "one two three four nine", None, None, None)]
    return stage(spark.createDataFrame(rows, SCHEMA).repartition(4))


def test_stages_have_the_order_asked_for():
    assert [f.__name__ for _, f in pipeline.STAGES] == ["language", "near_duplicates", "decontaminate", "mix_sources", "write_tokens"]
    assert pipeline.ORACLE_SQL is None


def test_language(spark, docs):
    got = pipeline.language(spark, docs, SMALL)
    assert got.columns == COLUMNS
    ids = Counter(r["doc_id"] for r in got.collect())
    assert not {102, 103, 104} & set(ids) and set(range(60)) <= set(ids) and ids[5] == 2 and ids[None] == 1


def test_near_duplicates(spark, docs):
    got = pipeline.near_duplicates(spark, docs, SMALL)
    assert got.columns == COLUMNS
    ids = Counter(r["doc_id"] for r in got.collect())
    assert ids[5] == 1 and not {100, 101} & set(ids) and set(range(60)) <= set(ids)
    assert ids[102] == ids[103] == ids[None] == 1


def test_decontaminate(spark, docs):
    item = spark.read.parquet(f"{SMALL}/benchmark.parquet").first()["text"]
    bad = spark.createDataFrame([(900, "before " + item, "aa", "s", 1), (901, item, "aa", "s", 1), (None, item, "aa", "s", 1)], SCHEMA)
    got = pipeline.decontaminate(spark, stage(docs.unionByName(bad)), SMALL)
    assert got.columns == COLUMNS
    assert Counter(map(repr, got.collect())) == Counter(map(repr, docs.collect()))


def test_mixing(spark, docs):
    one = pipeline.near_duplicates(spark, docs, SMALL)
    got = pipeline.mix_sources(spark, stage(one), SMALL)
    assert got.columns == COLUMNS
    taken = Counter(r["doc_id"] for r in got.collect())
    assert max(taken.values()) == 2 and 0 < len(taken) <= one.count()


def test_run(spark):
    rows = pipeline.run(spark, SMALL).orderBy("start").collect()
    assert [r["start"] for r in rows] == [sum(x["n_tokens"] for x in rows[:k]) for k in range(len(rows))]
    assert [r["doc_id"] for r in rows] == sorted(r["doc_id"] for r in rows)


@pytest.mark.parametrize("name,function", pipeline.STAGES)
def test_empty_table(spark, name, function):
    empty = stage(spark.createDataFrame([], SCHEMA))
    assert function(spark, empty, SMALL).count() == 0
