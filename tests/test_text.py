import re
from collections import Counter

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from conftest import MEDIUM
from weblode.functions.text import (
    extract_words,
    has_word,
    is_store_word,
    is_word,
    split_tokens,
    trim_token,
)
from weblode.operators.index import counts_of, term_counts, words
from weblode.sources.tables import read_documents

TEXT = "Don't re-read v2.0, it's naïve! C++ a:b x&y 100% [ok] foo_bar; El ¿Qué? OK"


def words_of(spark, text):
    df = spark.createDataFrame([("u", text)], "url string, text string")
    return [row["word"] for row in words(df).collect()]


def test_golden_tokens(spark):
    assert words_of(spark, TEXT) == "dont re read v2 0 its c 100 ok foo bar el ok".split()


@pytest.mark.parametrize(
    ("text", "expected"),
    [
        ("\ta\n b\x01 \x1fc", ["a", "b", "c"]),
        ("a\tb", []),  # white space other than a space does not separate
        (" a", []),
        ("K k", ["k"]),  # the Kelvin sign is no ASCII letter
        ("...", []),
        ("", []),
        (None, []),
    ],
)
def test_edge_tokens(spark, text, expected):
    assert words_of(spark, text) == expected


def brute_force(text):
    for token in re.split(r"[ ,.\-_;]", text or ""):
        token = re.sub(r"""["'\[\]()$#?!*¿¡%+]""", "", token)
        token = token.strip("".join(map(chr, range(33))))
        if re.fullmatch("[a-zA-Z0-9]+", token):
            yield token.lower()


def test_counts_of_all_documents(spark):
    path = f"{MEDIUM}/documents.parquet"
    rows = pq.read_table(path, columns=["doc_id", "text"]).to_pylist()
    expected = Counter(
        (word, str(row["doc_id"])) for row in rows for word in brute_force(row["text"])
    )
    counts = term_counts(read_documents(spark, path, "doc_id", "text"))
    got = {(r["word"], r["url"]): r["count"] for r in counts.collect()}
    assert got == expected


def test_one_pass_equals_token_by_token(spark):
    ends = ["", " ", "\x01", ".", "\t ", " \n", "-\x02-", "¿"]
    cores = ["a", "B9", "é", "a:b", "x\ty", "", "don't"]
    texts = [a + core + b + more for a in ends for core in cores for b in ends for more in cores]
    df = spark.createDataFrame([(t,) for t in texts], "text string")
    by_token = F.filter(F.transform(split_tokens(F.col("text")), trim_token), is_word)
    differ = df.where(by_token != extract_words(F.col("text")))
    assert differ.collect() == []
    assert df.where(F.size(by_token) > 1).count() > 100


def test_has_word_agrees_with_words(spark, values):
    texts = ["...", "é a", "é", "", "\ta\x01", "a:b", "x-é", "¡a!", "a\tb", TEXT]
    expected = [bool(list(brute_force(text))) for text in texts]
    assert values(has_word, texts) == expected


def test_store_words(values):
    words_in = ["a", "a-b", "-a", "", "a_b", "é", "A9-", "a\n"]
    assert values(is_store_word, words_in) == [
        True, True, False, False, False, False, True, False,
    ]


@pytest.mark.parametrize("word", ["The", "ok", "b2", "x-y", "K", "a|b"])
def test_counts_of_one_word_are_those_of_all(spark, word):
    rows = [
        ("a", "The the THE, other-the_the;the"), ("a", "the"), ("b", "them athe the\u00e9 \u00e9the the."), ("c", None), (None, "the ok"),
        ("d", "\x01the\x02 the\x00x \"the\" (the) t'he the:the OK ok k"), ("e", "b2 B2-b2 b 2 x-y a|b"), ("f", ""), ("b", TEXT),
    ]
    texts = spark.createDataFrame(rows, "url string, text string")
    of_all = term_counts(texts).where(F.col("word") == word.lower())
    got = counts_of(texts, word)
    assert got.dtypes == of_all.dtypes
    assert sorted(map(str, got.collect())) == sorted(map(str, of_all.collect()))


def test_one_word_is_counted_once_and_without_the_others(spark):
    texts = spark.createDataFrame([("a", "the")], "url string, text string")
    plan = counts_of(texts, "the")._jdf.queryExecution().optimizedPlan().toString()
    assert "Generate" not in plan and plan.count("regexp_extract_all") + plan.count("regexp_count") <= 1, plan
