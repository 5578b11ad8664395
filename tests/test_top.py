"""The best pages of heavy words, stored in order, and early cuts."""

import random

import pytest
from pyspark.sql import functions as F

from test_search import brute_force, found, make_store
from weblode.functions.limits import resolve_limit
from weblode.operators.ranking import first_rows
from weblode.operators.scoring import best_first
from weblode.plans import pipeline, search, store as stores
from weblode.plans.store import read_store, write_index, write_ranks, write_store

HEAVY = 25


def tables(n=300, seed=3):
    """Two heavy words, one on every page, and light ones; many equal scores."""
    rng = random.Random(seed)
    websites = [(f"id{i:04}", f"url{i}") for i in range(n)]
    postings = [("hot", page, rng.randint(1, 40)) for page, _ in websites]
    postings += [("warm", page, 5) for page, _ in rng.sample(websites, n // 3)]
    for word in ("a", "b", "c"):
        postings += [(word, page, rng.randint(1, 40)) for page, _ in rng.sample(websites, 20)]
    ranks = [(page, rng.choice([0.15, 0.3, 1.0, 7.5])) for page, _ in websites if rng.random() < 0.8]
    return websites, postings, ranks


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    path, made = str(tmp_path_factory.mktemp("top") / "s"), tables()
    write_store(make_store(spark, *made), path, heavy_postings=HEAVY)
    return read_store(spark, path), made


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def written_by_shuffles(df):
    """Rows that each shuffle of an executed plan wrote."""
    out = []

    def walk(node):
        name = node.nodeName()
        if name == "AdaptiveSparkPlan":
            return walk(node.executedPlan())
        if name in ("ShuffleQueryStage", "BroadcastQueryStage", "ResultQueryStage"):
            return walk(node.plan())
        if name == "Exchange":
            out.append(node.metrics().get("shuffleRecordsWritten").get().value())
        children = node.children()
        for i in range(children.length()):
            walk(children.apply(i))

    walk(df._jdf.queryExecution().executedPlan())
    return out


def test_best_rows_are_stored_in_order(stored, monkeypatch):
    store, made = stored
    words = {r["word"]: r["count"] for r in store.best.groupBy("word").count().collect()}
    assert words == {"hot": 300, "warm": 100}
    for word in words:
        rows = store.best.where(F.col("word") == word).orderBy("n").collect()
        url = dict(made[0])
        assert [(url[r["website_id"]], r["pagerank"]) for r in rows] == brute_force(*made, word, -1)
        assert [r["n"] for r in rows] == list(range(1, len(rows) + 1))


@pytest.mark.parametrize("word", ["hot", "WARM", "a", "zzz"])
def test_search_against_brute_force(stored, word):
    store, made = stored
    for limit in (1, 10, 99, 100, 101, 300, 1000, 1001, -1):
        assert found(search.search(store, word, limit)) == brute_force(*made, word, limit), limit


def test_a_heavy_word_is_searched_without_its_postings_and_ranks(stored):
    store, _ = stored
    plan = plan_of(search.search(store, "hot", 10))
    assert "/inv_index]" not in plan and "/page_rank]" not in plan and "/best]" in plan
    assert "LessThanOrEqual(n,10)" in plan and "EqualTo(word,hot)" in plan and "PartitionFilters: [isnotnull(bucket" in plan
    assert "/inv_index]" in plan_of(search.search(store, "a", 10))


def asked(spark):
    rows = [
        ("q1", "Hot", "10"), ("q2", "hot", "3"), ("q3", "warm", "-1"), ("q4", "a", None), ("q5", "b", "0"),
        ("q6", "zzz", "10"), ("q7", "c", "1000"), ("q8", None, "10"), ("q9", "hot", "0x1F"), ("q10", "a", "1e4"),
        ("q11", "warm", "7"), ("q12", "b", "2"),
    ]
    return rows, spark.createDataFrame(rows, "query_id string, word string, limit string")


@pytest.mark.parametrize("best_rows", [1000, 5])
@pytest.mark.parametrize("with_best", [True, False])
def test_batch_against_brute_force(spark, stored, monkeypatch, best_rows, with_best):
    monkeypatch.setattr(search, "BEST_ROWS", best_rows)
    store, made = stored
    rows, queries = asked(spark)
    store = store if with_best else store._replace(best=None)
    got = {}
    for row in search.search_batch(store, queries, HEAVY).collect():
        got.setdefault(row["query_id"], []).append((row["position"], row["url"], row["pagerank"]))
    for query_id, word, limit in rows:
        n = -1 if limit == "-1" else resolve_limit(limit)
        expected = brute_force(*made, word, n) if word else []
        assert sorted(got.get(query_id, [])) == [(k + 1, *r) for k, r in enumerate(expected)], query_id


def test_only_the_first_rows_of_every_task_are_shuffled(spark):
    """A word on 40,000 pages, for a limit of 3."""
    word = F.substring(F.concat(F.lit("hot"), "id"), 1, 3)  # not a constant, which would be a plain limit
    hits = spark.range(0, 40_000, 1, 8).select(
        word.alias("word"), F.col("id").cast("string").alias("website_id"), (F.col("id") % 977 / 7).alias("score"))
    for spread_by in (None, "website_id"):
        top = first_rows(hits, ["word"], best_first(), 3, spread_by, parts=4)
        assert "WindowGroupLimit" in plan_of(top)
        rows = top.orderBy("n").collect()
        expected = sorted((-(k % 977 / 7), str(k)) for k in range(40_000))[:3]
        assert [(-r["score"], r["website_id"]) for r in rows] == expected and [r["n"] for r in rows] == [1, 2, 3]
        noop = first_rows(hits, ["word"], best_first(), 3, spread_by, parts=4)
        noop.collect()
        counts = written_by_shuffles(noop)
        assert counts and max(counts) <= 3 * 8 * 4, counts


def test_batch_of_limited_queries_shuffles_limit_times_tasks(spark, tmp_path):
    made = tables(2000, 8)
    write_store(make_store(spark, *made), str(tmp_path / "s"))
    store = read_store(spark, str(tmp_path / "s"))
    words = spark.createDataFrame([("hot", 4), ("warm", 2)], "word string, most long")
    words = search._bucketed_words(words, store)
    (rows,) = search._numbered_words(store, words, 10**6)
    rows.collect()
    last = written_by_shuffles(rows)
    assert rows.count() == 6
    assert min(last) <= 2 * 4 * 8, last


def test_best_rows_follow_every_change(spark, tmp_path):
    path, (websites, postings, ranks) = str(tmp_path / "s"), tables(60, 5)
    whole = make_store(spark, websites, postings, ranks)
    first = whole.inv_index.where("word <> 'hot' or website_id < 'id0030'")
    write_index(whole.websites, first, path, heavy_postings=HEAVY)
    assert read_store(spark, path).best is None  # no ranks yet
    write_ranks(whole.page_rank.where("website_id < 'id0040'"), path, heavy_postings=HEAVY)
    kept = [r for r in ranks if r[0] < "id0040"]
    part = [p for p in postings if p[0] != "hot" or p[1] < "id0030"]
    store = read_store(spark, path)
    assert {r["word"] for r in store.best.collect()} == {"hot"}
    assert found(search.search(store, "hot", 50)) == brute_force(websites, part, kept, "hot", 50)
    write_index(whole.websites, whole.inv_index.where("word = 'hot' and website_id >= 'id0030'"), path, "append", heavy_postings=HEAVY)
    assert found(search.search(read_store(spark, path), "hot", 50)) == brute_force(websites, postings, kept, "hot", 50)
    write_ranks(whole.page_rank.where("website_id >= 'id0040'"), path, "append", heavy_postings=HEAVY)
    assert found(search.search(read_store(spark, path), "hot", 50)) == brute_force(websites, postings, ranks, "hot", 50)
    write_index(whole.websites, whole.inv_index, path, "overwrite", heavy_postings=1000)
    assert read_store(spark, path).best.isEmpty()
    assert found(search.search(read_store(spark, path), "hot", 50)) == brute_force(websites, postings, ranks, "hot", 50)


def test_loading_with_best_rows(spark, tmp_path):
    n = 80
    postings = spark.range(n).select(F.lit("w").alias("word"), F.concat(F.lit("u"), "id").alias("url"), F.lit(2).alias("count"))
    ranks = spark.range(n).select(F.concat(F.lit("u"), "id").alias("url"), (F.col("id") / 4).alias("rank"))
    pipeline.load(str(tmp_path / "s"), postings, ranks, heavy_postings=10)
    store = read_store(spark, str(tmp_path / "s"))
    assert store.best.count() == n
    assert [r["url"] for r in search.search(store, "w", 3).collect()] == ["u79", "u78", "u77"]


def test_words_that_no_task_could_hold_are_still_told_apart(stored, monkeypatch):
    store, _ = stored
    assert {r["word"] for r in stores.heavy_words(store.inv_index, HEAVY).collect()} == {"hot", "warm"}
    assert stores.heavy_words(store.inv_index, 300).count() == 0


@pytest.mark.parametrize("most", [0, 30, 10**9])
def test_best_rows_of_words_on_few_and_on_many_pages(spark, monkeypatch, most):
    """Only words on very many pages are picked from in parts; rows are the same."""
    postings = [(f"w{k}", f"{p:03d}", (p * 7 + k) % 25 + 1) for k in range(6) for p in range(12 * k)]
    ranks = {f"{p:03d}": p % 5 / 4 for p in range(0, 60, 2)}
    spread, first = [], stores.first_rows
    monkeypatch.setattr(stores, "first_rows", lambda *a: spread.append(a[4]) or first(*a))
    monkeypatch.setattr(stores, "SPREAD_POSTINGS", most)
    monkeypatch.setattr(stores, "BEST_ROWS", 9)
    index = spark.createDataFrame(postings, "word string, website_id string, count bigint")
    found = stores.best_rows(index, spark.createDataFrame(list(ranks.items()), "website_id string, value double"), 20)
    expected = []
    for word in ("w2", "w3", "w4", "w5"):
        own = [(s, ranks[s] + min(c, 20) / 20 if s in ranks else None) for w, s, c in postings if w == word]
        own.sort(key=lambda r: (r[1] is None, -(r[1] or 0), r[0]))
        expected += [(word, n, s) for n, (s, _) in enumerate(own[:9], 1)]
    assert sorted((r["word"], r["n"], r["website_id"]) for r in found.collect()) == expected
    assert spread == {0: ["website_id"], 30: [None, "website_id"], 10**9: [None]}[most]
