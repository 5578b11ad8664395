import json
import random

import pytest
from pyspark.errors import PySparkException

from weblode.functions.limits import resolve_limit, resolve_limits
from weblode.plans import search
from weblode.plans.store import Store, read_store, write_store

LIMITS = {
    None: 10, "abc": 10, "nan": 10, "inf": 10, "1_0": 10, "10d": 10,
    "-1": None, "-1.0": None, "Infinity": None,
    "0": 0, "": 0, " ": 0, "-0.5": 0,
    "5": 5, " 5 ": 5, "2.7": 2, "1e2": 100, "+3": 3, ".5": 0,
    "1e300": None, "1" + "0" * 19: None, "0x1F": 31, "0o17": 15, "0b101": 5, "0x": 10, "0x0": 0,
    "0x7fffffffffffffff": 2**63 - 1, "0x8000000000000000": None, "0o1" + "0" * 21: None, "0x" + "f" * 40: None,
}


def test_limits(values):
    assert {k: resolve_limit(k) for k in LIMITS} == LIMITS
    assert dict(zip(LIMITS, values(resolve_limits, LIMITS))) == LIMITS
    assert [resolve_limit(n) for n in (-1, 0, 7, 2.7, float("nan"), float("inf"))] == [
        None, 0, 7, 2, 10, None,
    ]


def test_other_negative_limits_are_an_error(values):
    for limit in ("-2", "-1.5", "-Infinity"):
        with pytest.raises(ValueError):
            resolve_limit(limit)
        with pytest.raises(PySparkException, match="limit must be"):
            values(resolve_limits, [limit])


def make_store(spark, websites, postings, ranks):
    return Store(
        spark.createDataFrame(websites, "website_id string, url string"),
        spark.createDataFrame(postings, "word string, website_id string, count long"),
        spark.createDataFrame(ranks, "website_id string, value double"),
    )


@pytest.fixture(scope="module")
def small(spark):
    return make_store(
        spark,
        [("1", "u1"), ("2", "u2"), ("3", "u3"), ("4", "u4"), ("5", "u5")],
        [("ok", "1", 7), ("ok", "2", 20), ("ok", "3", 55), ("ok", "4", 9), ("dont", "5", 1)],
        [("1", 0.15), ("2", 0.15), ("3", 0.15), ("5", 2.0)],
    )


def found(df):
    """Rows without their positions, which have to count from 1."""
    rows = df.collect()
    if df.columns[0] == "position":
        start = 0 if "json" in df.columns else 1
        assert [row[0] for row in rows] == list(range(start, start + len(rows)))
        rows = [row[1:] for row in rows]
    return [tuple(row) for row in rows]


def document(df):
    return json.loads("".join(line for (line,) in found(df)))


def test_score_and_order(small):
    every = [("u2", 0.15), ("u3", 0.15), ("u1", 0.15), ("u4", None)]
    assert found(search.search(small, "OK", -1)) == every
    assert found(search.search(small, "ok")) == every
    assert found(search.search(small, "ok", "2")) == every[:2]
    scored = search._scored(small.inv_index, small.page_rank).collect()
    by_id = {row["website_id"]: row["score"] for row in scored}
    assert by_id == {"1": 0.5, "2": 1.15, "3": 1.15, "4": None, "5": pytest.approx(2.05)}


def test_nothing_found(small):
    for word, limit in (("missing", 10), (None, 10), ("ok", 0), ("ok", ""), ("don't", 10)):
        df = search.search(small, word, limit)
        assert df.columns == ["position", "url", "pagerank"]
        assert found(df) == []
    assert document(search.search_json(small, None)) == {"results": []}


def test_json(small):
    expected = {
        "results": [
            {"url": "u2", "pagerank": 0.15},
            {"url": "u3", "pagerank": 0.15},
            {"url": "u1", "pagerank": 0.15},
            {"url": "u4"},
        ]
    }
    for limit in (10, -1, 1_000_000):
        assert document(search.search_json(small, "ok", limit)) == expected


def test_a_page_without_a_website_stays(small):
    store = small._replace(websites=small.websites.where("website_id <> '2'"))
    assert found(search.search(store, "ok", 2)) == [(None, 0.15), ("u3", 0.15)]
    assert len(found(search.search(store, "ok", -1))) == 4


def brute_force(websites, postings, ranks, word, limit):
    url, rank = dict(websites), dict(ranks)
    hits = []
    for posted, page, count in postings:
        if posted == word.lower():
            value = rank.get(page)
            score = None if value is None else value + min(count, 20) / 20
            hits.append((score is None, -(score or 0), page, url[page], value))
    hits.sort()
    return [hit[3:] for hit in (hits if limit == -1 else hits[:limit])]


@pytest.fixture(scope="module", params=["in memory", "on disk"])
def random_store(request, spark, tmp_path_factory):
    rng = random.Random(7)
    websites = [(f"id{i:03}", f"url{i}") for i in range(400)]
    postings = [("hot", page, rng.randint(1, 40)) for page, _ in websites]
    for word in ("a", "b", "c"):
        postings += [(word, page, rng.randint(1, 40)) for page, _ in rng.sample(websites, 30)]
    ranks = [(page, rng.choice([0.15, 0.3, 1.0])) for page, _ in websites if rng.random() < 0.8]
    store = make_store(spark, websites, postings, ranks)
    if request.param == "on disk":
        path = str(tmp_path_factory.mktemp("store") / "s")
        write_store(store, path)
        store = read_store(spark, path)
    return store, (websites, postings, ranks)


def test_search_against_brute_force(random_store):
    store, tables = random_store
    for word, limit in (("hot", 25), ("A", -1), ("zzz", 5)):
        assert found(search.search(store, word, limit)) == brute_force(*tables, word, limit)


def test_batch_against_brute_force(spark, random_store):
    store, tables = random_store
    asked = [
        ("q1", "Hot", "10"), ("q2", "hot", "3"), ("q3", "hot", "-1"), ("q4", "a", None),
        ("q5", "b", "0"), ("q6", "zzz", "10"), ("q7", "c", "1000"), ("q8", None, "10"),
        ("q9", "hot", "0x1F"),
    ]
    queries = spark.createDataFrame(asked, "query_id string, word string, limit string")
    got = {}
    for row in search.search_batch(store, queries).collect():
        got.setdefault(row["query_id"], []).append((row["position"], row["url"], row["pagerank"]))
    for query_id, word, limit in asked:
        expected = brute_force(*tables, word, resolve_limit(limit) if limit != "-1" else -1) if word else []
        ordered = sorted(got.get(query_id, []))
        assert [row[1:] for row in ordered] == expected, query_id
        assert [row[0] for row in ordered] == list(range(1, len(ordered) + 1)), query_id


def test_batch_counts(spark, random_store):
    store, _ = random_store
    queries = spark.createDataFrame(
        [("q1", "HOT"), ("q2", "a"), ("q3", "zzz"), ("q4", None)], "query_id string, word string")
    assert dict(found(search.batch_counts(store, queries))) == {"q1": 400, "q2": 30, "q3": 0, "q4": 0}


def test_more_rows_than_are_broadcast(random_store, monkeypatch):
    monkeypatch.setattr(search, "MAX_BROADCAST_ROWS", 3)
    monkeypatch.setattr(search, "MAX_PICKED_ROWS", 4)
    store, tables = random_store
    for limit in (3, 5, 150, 1000):
        assert found(search.search(store, "hot", limit)) == brute_force(*tables, "hot", limit)
    pages = document(search.search_json(store, "hot", 5))["results"]
    assert [page["url"] for page in pages] == [url for url, _ in brute_force(*tables, "hot", 5)]


def test_row_numbers_of_a_group_that_spans_ranges(spark, request):
    # Keeps the ranges of this small table from being joined.
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    request.addfinalizer(
        lambda: spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    )
    from pyspark.sql import Window
    from pyspark.sql import functions as F

    from weblode.operators.ranking import row_numbers

    values = [("hot" if i % 4 else f"k{i % 12}", i, i % 5 or None) for i in range(1000)]
    df = spark.createDataFrame(values, "key string, id int, score int")
    order = [F.col("score").desc_nulls_last(), F.col("id")]
    ranges = df.repartitionByRange(8, "key", *order).select("key", F.spark_partition_id())
    assert ranges.where("key = 'hot'").distinct().count() > 3
    for keys in (["key"], []):
        expected = df.withColumn(
            "n", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
        )
        columns = ["key", "id", "score", "n"]
        got = row_numbers(df, keys, order).select(columns)
        assert sorted(found(got), key=str) == sorted(found(expected.select(columns)), key=str)


def test_numbering_shuffles_no_row_after_its_ranges_are_written(spark):
    from weblode.operators.ranking import row_numbers

    df = spark.range(500).selectExpr("concat('k', id % 3) AS key", "id")
    numbered = row_numbers(df, ["key"], [df["id"].desc()])
    plan = numbered._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning" not in plan and "Window" not in plan, plan
    assert {(r["id"], r["n"]) for r in numbered.where("key = 'k1'").collect()} == {(499 - 3 * k, k + 1) for k in range(167)}
