"""Shared helpers: words over bytes, components of links."""

import random
import re

import numpy as np
import pyarrow as pa
import pytest

from weblode.llm.common import slices, text_buffer
from weblode.llm.components import components
from weblode.llm.words import ALNUM, SPACED, chars_before, find_words, hash_words

TEXTS = ["", "One  two", None, "naïve x\n\ty ", "A" * 300, " ", "x", "日本 語", "a\x0bb\x1cc"]


@pytest.mark.parametrize("table,pattern", [(SPACED, r"[^\x20\x09-\x0D]+"), (ALNUM, r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")])
def test_words_match_the_pattern(table, pattern):
    raw, at = text_buffer(pa.array(TEXTS))
    words = find_words(raw, at, table)
    lowered = [re.sub("[A-Z]", lambda m: m[0].lower(), t or "") for t in TEXTS]
    source = lowered if table is ALNUM else [t or "" for t in TEXTS]
    got = [bytes(raw[s:e]).decode() for s, e in zip(words.start, words.end)]
    if table is ALNUM:
        got = [re.sub("[A-Z]", lambda m: m[0].lower(), g) for g in got]
    assert got == [w for t in source for w in re.findall(pattern, t)]
    assert np.diff(words.first).tolist() == [len(re.findall(pattern, t)) for t in source]


def test_hashes_ignore_case_and_place():
    raw, at = text_buffer(pa.array(["Same word SAME", "same"]))
    words = find_words(raw, at, SPACED)
    h = hash_words(raw, words.start, words.end)
    assert h[0] == h[2] == h[3] != h[1]


def test_chars_and_slices():
    raw, at = text_buffer(pa.array(["é1", "x"]).slice(0))
    assert chars_before(raw).tolist() == [0, 1, 1, 2, 3]
    assert list(slices(np.array([0, 5, 6, 7, 20]), 6)) == [(0, 2), (2, 3), (3, 4)]


def test_components(spark):
    rng = random.Random(3)
    links = [(rng.randrange(80), rng.randrange(80)) for _ in range(60)] + [(None, 1), (5, 5)]
    parent = {}

    def root(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in links:
        if a is not None and a != b:
            x, y = root(a), root(b)
            parent[max(x, y)] = min(x, y)
    got = components(spark.createDataFrame(links, "a long, b long"))
    assert {(r["node"], r["component"]) for r in got.collect()} == {(x, root(x)) for x in list(parent)}
    chain = spark.createDataFrame([(k, k + 1) for k in range(50)], "a long, b long")
    assert {r["component"] for r in components(chain).collect()} == {0}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0
