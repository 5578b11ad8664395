"""Changes of several tables: all or nothing, wherever a run breaks off."""

import os

import pytest
from pyspark.sql import functions as F

from weblode import scratch
from weblode.operators.index import posting_lists
from weblode.operators.pagerank import page_rank
from weblode.plans import pipeline, search
from weblode.plans.store import read_store
from weblode.sources import publish
from weblode.sources.publish import JOURNAL, Files, TableExists, as_new, publishing, settle


class Broken(RuntimeError):
    pass


@pytest.fixture(autouse=True)
def no_grace(monkeypatch):
    monkeypatch.setattr(publish, "GRACE_SECONDS", 0.0)


def break_at(monkeypatch, k):
    """The k-th move from now on, and all after it, fail. Returns the moves asked for."""
    calls, rename = [], Files.rename

    def limited(self, source, target):
        if pipeline.STATE in target:  # a note of a step
            return rename(self, source, target)
        calls.append(target)
        if len(calls) > k:
            raise Broken(target)
        return rename(self, source, target)

    monkeypatch.setattr(Files, "rename", limited)
    return calls


def number(spark, value, name="v"):
    return spark.createDataFrame([(value,)], f"{name} int")


def values(spark, root, *names):
    settle(spark, root)
    return [sorted(r[0] for r in spark.read.parquet(f"{root}/{name}").collect()) for name in names]


def change(spark, root, value):
    """Replaces a, adds to b, creates a new table."""
    with publishing(spark, root) as p:
        as_new(number(spark, value), p, "a", "overwrite")
        number(spark, value).write.parquet(p.place("b", "append"))
        as_new(number(spark, value), p, f"c{value}", "errorifexists")


def test_every_break_leaves_the_old_or_the_new(spark, tmp_path, monkeypatch):
    outcomes = []
    for k in range(20):
        root = str(tmp_path / str(k))
        change(spark, root, 1)
        with monkeypatch.context() as m:
            calls = break_at(m, k)
            try:
                change(spark, root, 2)
                whole = True
            except Broken:
                whole = False
        got = values(spark, root, "a", "b")
        assert got in ([[1], [1]], [[2], [1, 2]]), k
        new = got[0] == [2]
        assert sorted(os.listdir(root)) == (["a", "b", "c1", "c2"] if new else ["a", "b", "c1"])
        outcomes.append(new)
        if whole:
            assert len(calls) <= k
            break
    assert outcomes[0] is False and outcomes[1] is True and all(outcomes[1:]) and len(outcomes) > 4


def test_an_error_while_writing_changes_nothing(spark, tmp_path):
    root = str(tmp_path / "r")
    change(spark, root, 1)
    with pytest.raises(Broken), publishing(spark, root) as p:
        as_new(number(spark, 9), p, "a", "overwrite")
        raise Broken
    assert sorted(os.listdir(root)) == ["a", "b", "c1"] and values(spark, root, "a") == [[1]]


def test_the_second_of_two_writers_is_refused(spark, tmp_path):
    root = str(tmp_path / "r")
    with pytest.raises(TableExists), publishing(spark, root) as slow:
        as_new(number(spark, 1), slow, "a", "errorifexists")
        with publishing(spark, root) as fast:
            as_new(number(spark, 2), fast, "a", "errorifexists")
    assert values(spark, root, "a") == [[2]] and os.listdir(root) == ["a"]


def test_a_journal_in_use_is_waited_for(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(publish, "GRACE_SECONDS", 1.5)
    root = str(tmp_path / "r")
    with monkeypatch.context() as m:
        break_at(m, 1)
        with pytest.raises(Broken):
            change(spark, root, 1)
    assert os.path.exists(f"{root}/{JOURNAL}")
    assert values(spark, root, "a", "b") == [[1], [1]] and not os.path.exists(f"{root}/{JOURNAL}")


PAGES = [("a.org/1", "<a href='/2'>go</a> word"), ("a.org/2", "<a href='/1'>back</a> word word")]


def pages(spark, more=""):
    return spark.createDataFrame([(url, html + more) for url, html in PAGES], "url string, html string")


@pytest.mark.parametrize("k", [0, 1, 4])
def test_a_forced_run_that_breaks_off(spark, tmp_path, monkeypatch, k):
    out = str(tmp_path / "out")
    pipeline.run(pages(spark), out, 1)
    with monkeypatch.context() as m:
        break_at(m, k)
        with pytest.raises(Broken):
            pipeline.run(pages(spark, " more <a href='/3'>x</a>"), out, 1, force=True)
    settle(spark, out)
    words = {r["word"] for r in spark.read.parquet(f"{out}/postings").collect()}
    urls = {r["url"] for r in spark.read.parquet(f"{out}/ranks").collect()}
    assert ("more" in words) == ("a.org/3" in urls) == (k > 0)
    assert sorted(n for n in os.listdir(out) if n != pipeline.STATE) == ["edges", "postings", "ranks", "urls"]


def test_a_load_that_breaks_off_can_be_repeated(spark, tmp_path, monkeypatch):
    out, path = str(tmp_path / "out"), str(tmp_path / "store")
    pipeline.run(pages(spark), out, 1)
    with monkeypatch.context() as m:
        m.setattr("weblode.plans.store._Changes.put_ranks", lambda *_: (_ for _ in ()).throw(Broken()))
        with pytest.raises(Broken):
            pipeline.load_run(spark, out, path)
    assert os.listdir(path) == []
    pipeline.load_run(spark, out, path)
    before = read_store(spark, path).inv_index.count()
    more = spark.createDataFrame([("new", "a.org/1", 1), ("new", "z.org/", 1)], "word string, url string, count long")
    with monkeypatch.context() as m:
        break_at(m, 0)
        with pytest.raises(Broken):
            pipeline.load(path, more, mode="append")
    assert read_store(spark, path).inv_index.count() == before
    with monkeypatch.context() as m:
        break_at(m, 1)
        with pytest.raises(Broken):
            pipeline.load(path, more, mode="append")
    assert read_store(spark, path).inv_index.count() == before + 2
    assert [r["url"] for r in search.search(read_store(spark, path), "new").collect()] == ["a.org/1", "z.org/"]


def test_appends_look_up_ids_in_their_buckets(spark, tmp_path):
    from weblode.functions.urls import website_id
    from weblode.plans.store import _Changes

    path = str(tmp_path / "store")
    n = 400
    urls = spark.range(n).select(F.concat(F.lit("u"), "id").alias("url"))
    postings = urls.select(F.lit("w").alias("word"), "url", F.lit(1).alias("count"))
    from weblode.plans.store import store_postings, website_ids, write_index

    write_index(website_ids(urls), store_postings(postings), path, id_buckets=8)
    few = spark.createDataFrame([("u1",), ("new",)], "url string").select(website_id(F.col("url")).alias("website_id"))
    found = _Changes(spark, path, None, "append")._stored(few)
    plan = found._jdf.queryExecution().executedPlan().toString()
    read = plan[plan.index("PartitionFilters: ["):].split("]")[0]
    assert " IN (" in read or "bucket#" in read and " = " in read, plan
    assert found.count() == 1


def test_ids_of_other_stores_are_found_without_all_websites(spark, tmp_path):
    from weblode.plans.store import build_store, stored_own_ids, write_store

    path = str(tmp_path / "store")
    rows = [("w", "u1", 1), ("w", "u2", 1)]
    postings = spark.createDataFrame(rows, "word string, url string, count long")
    no_ranks = spark.createDataFrame([], "url string, rank double")
    known = spark.createDataFrame([("own", "u1")], "website_id string, url string")
    write_store(build_store(postings, no_ranks, known=known), path)
    assert [tuple(r) for r in stored_own_ids(spark, path).collect()] == [("own", "u1")]
    more = spark.createDataFrame([("x", "u1", 1), ("x", "u3", 1)], "word string, url string, count long")
    ranks = spark.createDataFrame([("u1", 0.5), ("u2", 0.25), ("else", 9.0)], "url string, rank double")
    pipeline.load(path, more, ranks, mode="append")
    store = read_store(spark, path)
    assert [tuple(r) for r in search.search(store, "x").collect()] == [(1, "u1", 0.5), (2, "u3", None)]
    assert store.page_rank.count() == 2 and store.websites.count() == 3


def scratch_names(spark):
    root = spark.conf.get("spark.checkpoint.dir").removeprefix("file:")
    return set(os.listdir(root))


def test_scopes_leave_no_scratch_tables(spark, tmp_path):
    out, path = str(tmp_path / "out"), str(tmp_path / "store")
    before = scratch_names(spark)
    pipeline.run(pages(spark), out, 2)
    pipeline.load_run(spark, out, path)
    assert scratch_names(spark) == before
    store = read_store(spark, path)
    queries = spark.createDataFrame([("q", "word", "-1"), ("r", "go", "1")], "query_id string, word string, limit string")
    edges = spark.read.parquet(f"{out}/edges")
    for call in (
        lambda: search.search(store, "word", -1), lambda: search.search_json(store, "word"),
        lambda: search.search_batch(store, queries, 1), lambda: search.search_batch(store, queries),
        lambda: page_rank(edges, 1), lambda: posting_lists(spark.read.parquet(f"{out}/postings"), 1),
    ):
        with scratch.scope(spark):
            assert call().count() > 0
        assert scratch_names(spark) == before
    with pytest.raises(Broken), scratch.scope(spark):
        scratch.stage(spark.range(3))
        with scratch.scope(spark):
            scratch.stage(spark.range(3))
        assert len(scratch_names(spark) - before) == 1
        raise Broken
    assert scratch_names(spark) == before


def test_a_local_warehouse_is_no_shared_folder_on_a_cluster():
    from types import SimpleNamespace

    def session(master, warehouse):
        values = {"spark.sql.warehouse.dir": warehouse, "spark.master": master}
        return SimpleNamespace(conf=SimpleNamespace(get=lambda key, default=None: values.get(key, default)))

    with pytest.raises(ValueError, match="checkpoint"):
        scratch.scratch_dir(session("yarn", "file:/home/me/spark-warehouse"))
    assert scratch.scratch_dir(session("yarn", "hdfs://n/w")).startswith("hdfs://n/w")
    assert scratch.scratch_dir(session("local[4]", "file:/tmp/w")).startswith("file:/tmp/w")
