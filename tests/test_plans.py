import hashlib
import os

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from conftest import SMALL
from weblode.plans import pipeline, search
from weblode.plans.store import (
    build_store,
    read_store,
    store_postings,
    website_ids,
    write_index,
    write_ranks,
    write_store,
)
from weblode.scratch import scratch_dir
from weblode.sources.keyed import KeyCollision


def rows(df):
    return sorted(map(tuple, df.collect()))


def page_id(url):
    return hashlib.sha256(url.encode()).hexdigest()[:32]


@pytest.fixture
def pages(spark):
    return spark.createDataFrame(
        [
            ("a.org/1", "<a href='/2'>go</a> word"),
            ("a.org/2", "<a href='/1'>back</a> word word"),
            ("a.org/3", "word, no link"),
            ("a.org/4", "<a href='/1'>é</a>"),  # a link, but no word
        ],
        "url string, html string",
    )


@pytest.fixture
def postings(spark):
    return spark.createDataFrame(
        [("word", "a.org/1", 1), ("a-b", "a.org/2", 2), ("a_b", "a.org/3", 3)],
        "word string, url string, count long",
    )


@pytest.fixture
def ranks(spark):
    return spark.createDataFrame([("a.org/1", 0.5), ("else.org/", 0.9)], "url string, rank double")


def test_run_load_search(spark, pages, tmp_path):
    out, store_path = str(tmp_path / "out"), str(tmp_path / "store")
    pipeline.run(pages, out, iterations=2)
    assert rows(spark.read.parquet(f"{out}/urls")) == [("a.org/1",), ("a.org/2",), ("a.org/3",)]
    pipeline.load_run(spark, out, store_path)
    store = read_store(spark, store_path)
    assert [r["url"] for r in search.search(store, "word").collect()] == [
        "a.org/2", "a.org/1", "a.org/3",
    ]
    ranked = {row["website_id"] for row in store.page_rank.collect()}
    assert ranked == {page_id("a.org/1"), page_id("a.org/2")}
    with pytest.raises(PySparkException):
        pipeline.load_run(spark, out, store_path)
    before = rows(store.websites)
    pipeline.load_run(spark, out, store_path, mode="overwrite")
    assert rows(read_store(spark, store_path).websites) == before


def test_output_is_kept_unless_forced(spark, pages, tmp_path):
    out = str(tmp_path / "out")
    pipeline.run(pages, out, skip=["page-rank"])
    assert sorted(os.listdir(out)) == ["postings", "urls"]
    with pytest.raises(pipeline.OutputExists):
        pipeline.run(pages, out, iterations=1)
    assert sorted(os.listdir(out)) == ["postings", "urls"]
    pipeline.run(pages, out, iterations=1, skip=["inv-index"])
    assert sorted(os.listdir(out)) == ["edges", "postings", "ranks", "urls"]
    pipeline.run(pages.limit(0), out, iterations=1, force=True)
    assert spark.read.parquet(f"{out}/postings").isEmpty()
    with pytest.raises(ValueError):
        pipeline.run(pages, out, skip=["pagerank"])


def test_each_half_can_be_loaded_alone(spark, postings, ranks, tmp_path):
    path = str(tmp_path / "store")
    pipeline.load(path, postings)
    assert sorted(os.listdir(path)) == ["inv_index", "layout", "websites"]
    pipeline.load(path, ranks=ranks)
    store = read_store(spark, path)
    assert rows(store.page_rank.drop("bucket")) == [(page_id("a.org/1"), 0.5)]
    assert rows(store.inv_index.drop("bucket")) == [
        ("a-b", page_id("a.org/2"), 2),
        ("word", page_id("a.org/1"), 1),
    ]


def test_appending(spark, postings, ranks, tmp_path):
    path = str(tmp_path / "store")
    pipeline.load(path, postings, ranks)
    with pytest.raises(KeyCollision):
        pipeline.load(path, postings, mode="append")
    with pytest.raises(KeyCollision):
        pipeline.load(path, ranks=ranks, mode="append")
    more = spark.createDataFrame(
        [("new", "a.org/1", 4), ("word", "b.org/", 5)], "word string, url string, count long"
    )
    pipeline.load(path, more, mode="append")
    store = read_store(spark, path)
    assert rows(store.websites.select("url")) == [("a.org/1",), ("a.org/2",), ("b.org/",)]
    assert store.inv_index.count() == 4
    assert rows(search.search(store, "new")) == [(1, "a.org/1", 0.5)]


def test_a_failed_append_changes_nothing(spark, postings, ranks, tmp_path):
    path = str(tmp_path / "store")
    pipeline.load(path, postings, ranks)
    before = [rows(table) for table in read_store(spark, path)[:3]]
    more = spark.createDataFrame([("new", "b.org/", 4)], "word string, url string, count long")
    better = spark.createDataFrame([("a.org/2", 0.7), ("b.org/", 0.8)], "url string, rank double")
    with pytest.raises(KeyCollision):
        pipeline.load(path, more, ranks, mode="append")
    with pytest.raises(KeyCollision):
        pipeline.load(path, postings, better, mode="append")
    assert [rows(table) for table in read_store(spark, path)[:3]] == before
    pipeline.load(path, more, better, mode="append")
    assert rows(search.search(read_store(spark, path), "new")) == [(1, "b.org/", 0.8)]
    assert rows(search.search(read_store(spark, path), "a-b")) == [(1, "a.org/2", 0.7)]


def test_a_store_without_ranks_is_searchable(spark, postings, tmp_path):
    path = str(tmp_path / "store")
    pipeline.load(path, postings)
    assert rows(search.search(read_store(spark, path), "word")) == [(1, "a.org/1", None)]


def test_a_run_reads_the_pages_once(spark, pages, tmp_path):
    calls = spark.sparkContext.accumulator(0)

    def count(batches):
        for batch in batches:
            calls.add(batch.num_rows)
            yield batch

    counted = pages.mapInArrow(count, pages.schema)
    pipeline.run(counted, str(tmp_path / "out"), iterations=1)
    assert calls.value == pages.count()


def test_files_of_a_store_are_bounded_and_sorted(spark, tmp_path, monkeypatch):
    from weblode.plans import store as module

    monkeypatch.setattr(module, "MAX_RECORDS_PER_FILE", 50)
    path = str(tmp_path / "store")
    urls = spark.range(300).select(F.concat(F.lit("u"), "id").alias("url"))
    postings = urls.select(F.lit("word").alias("word"), "url", F.lit(1).alias("count"))
    write_index(website_ids(urls), store_postings(postings), path, id_buckets=2)
    files = spark.read.parquet(f"{path}/websites").select(
        "website_id", F.col("_metadata.file_path").alias("f"), F.col("_metadata.row_index").alias("i"))
    by_file = {}
    for row in files.orderBy("f", "i").collect():
        by_file.setdefault(row["f"], []).append(row["website_id"])
    assert max(map(len, by_file.values())) <= 50
    assert all(ids == sorted(ids) for ids in by_file.values())


def test_known_websites_keep_their_ids(spark, postings, ranks):
    known = spark.createDataFrame([("Xy9", "a.org/1")], "website_id string, url string")
    store = build_store(postings, ranks, known=known)
    assert rows(store.websites) == sorted([("Xy9", "a.org/1"), (page_id("a.org/2"), "a.org/2")])
    assert rows(store.inv_index) == sorted([("a-b", page_id("a.org/2"), 2), ("word", "Xy9", 1)])
    assert rows(store.page_rank) == [("Xy9", 0.5)]


def test_appending_to_a_store_with_ids_of_its_own(spark, postings, ranks, tmp_path):
    path = str(tmp_path / "store")
    known = spark.createDataFrame([("Xy9", "a.org/1")], "website_id string, url string")
    write_store(build_store(postings, ranks, known=known), path)
    more = spark.createDataFrame(
        [("new", "a.org/1", 4), ("new", "a.org/2", 9)], "word string, url string, count long"
    )
    pipeline.load(path, more, mode="append")
    store = read_store(spark, path)
    found = rows(store.inv_index.where("word = 'new'").select("website_id", "count"))
    assert found == sorted([("Xy9", 4), (page_id("a.org/2"), 9)])
    assert store.websites.count() == 2
    assert rows(search.search(store, "new")) == [(1, "a.org/1", 0.5), (2, "a.org/2", None)]


def test_computed_ids_need_no_join(postings):
    plan = store_postings(postings)._jdf.queryExecution().optimizedPlan().toString()
    assert "Join" not in plan
    assert "Join" not in website_ids(postings)._jdf.queryExecution().optimizedPlan().toString()


def test_lookup_reads_one_bucket_and_pushes_the_word_down(spark, tmp_path):
    from weblode.operators.index import inverted_index
    from weblode.sources.tables import read_pages

    path = str(tmp_path / "store")
    index = store_postings(inverted_index(read_pages(spark, f"{SMALL}/pages.parquet")))
    sites = spark.createDataFrame([], "website_id string, url string")
    write_index(sites, index, path, word_buckets=16, id_buckets=4)
    write_ranks(spark.createDataFrame([], "website_id string, value double"), path)
    hits = search.word_postings(read_store(spark, path), F.lower(F.lit("THE")))
    plan = hits._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(word), EqualTo(word,the)]" in plan
    assert "PartitionFilters: [isnotnull(bucket" in plan
    assert len(os.listdir(f"{path}/inv_index")) > 10
    expected = index.where("word = 'the'").select("website_id", "count")
    assert rows(hits) == rows(expected) != []


def test_scratch_folder_comes_from_the_session(spark):
    assert scratch_dir(spark).startswith(spark.conf.get("spark.checkpoint.dir"))
    assert scratch_dir(spark) != scratch_dir(spark)


def test_scratch_folder_without_a_setting_is_in_the_warehouse():
    from types import SimpleNamespace

    values = {"spark.sql.warehouse.dir": "hdfs://n/warehouse"}
    session = SimpleNamespace(conf=SimpleNamespace(get=lambda key, default=None: values.get(key, default)))
    assert scratch_dir(session).startswith("hdfs://n/warehouse/_scratch/weblode-")


def test_ranks_leave_no_state_behind(spark):
    root = spark.conf.get("spark.checkpoint.dir").removeprefix("file:")
    edges = spark.createDataFrame([("a", "b"), ("b", "a")], "src string, dst string")
    from weblode.operators.pagerank import page_rank

    before = set(os.listdir(root))
    assert page_rank(edges, 3).count() == 2
    assert len(set(os.listdir(root)) - before) == 1


def test_command_line(spark, tmp_path, capsys):
    import json

    from weblode.__main__ import main

    crawl = tmp_path / "crawl" / "a.org"
    crawl.mkdir(parents=True)
    (crawl / "1.html").write_text("<a href='/2'>go</a> word")
    (crawl / "2.html").write_text("word word")
    out, store_path = str(tmp_path / "out"), str(tmp_path / "store")
    main(["run", "--crawl", str(tmp_path / "crawl"), "--out", out, "-i", "1"])
    main(["load", "--source", out, "--store", store_path, "--inv-index"])
    main(["load", "--source", out, "--store", store_path, "--page-rank"])
    capsys.readouterr()
    with pytest.raises(SystemExit):
        main(["search", "--store", store_path, "--word", "WORD", "--limit", "-1"])
    main(["pack", "--crawl", str(tmp_path / "crawl"), "--out", str(tmp_path / "packed")])
    assert spark.read.parquet(str(tmp_path / "packed")).count() == 2
    capsys.readouterr()
    main(["search", "--store", store_path, "--word", "WORD", "--limit", "1"])
    assert json.loads(capsys.readouterr().out) == {
        "results": [{"url": "a.org/2", "pagerank": pytest.approx(1.0)}]
    }
    with pytest.raises(SystemExit):
        main(["load", "--store", store_path, "--page-rank"])


def test_loading_packed_files(spark, tmp_path):
    from weblode.__main__ import main

    def put(name, line):
        (tmp_path / name).mkdir()
        (tmp_path / name / "part-r-00000").write_text(line)
        return str(tmp_path / name)

    main([
        "load", "--store", str(tmp_path / "store"), "--inv-index", "--page-rank",
        "--packed-postings", put("index", "word\ta.org/1|3|a.org/2|30\nin-ner\ta.org/1|1\n_\tx.org|1\n"),
        "--packed-ranks", put("ranks", "a.org/1|0.7\ta.org/2|b.org\na.org/2|0.1\t\nb.org|0.3\t\n"),
    ])
    store = read_store(spark, str(tmp_path / "store"))
    assert rows(search.search(store, "word"))[0] in ((1, "a.org/1", 0.7), (1, "a.org/2", 0.1))
    assert sorted(r[1:] for r in rows(search.search(store, "word"))) == [("a.org/1", 0.7), ("a.org/2", 0.1)]
    assert rows(search.search(store, "IN-NER")) == [(1, "a.org/1", 0.7)]
    assert store.page_rank.count() == 2
    assert store.websites.count() == 2


def test_repeated_keys_in_the_input_are_an_error(spark, postings, ranks, tmp_path):
    path = str(tmp_path / "store")
    with pytest.raises(KeyCollision):
        pipeline.load(path, postings.unionByName(postings), check_keys=True)
    pipeline.load(path, postings, check_keys=True)
    with pytest.raises(KeyCollision):
        pipeline.load(path, ranks=ranks.unionByName(ranks), check_keys=True)
    pipeline.load(path, ranks=ranks, check_keys=True)


def test_top_pages_open_only_their_website_buckets(spark, tmp_path):
    path = str(tmp_path / "store")
    urls = spark.range(400).select(F.concat(F.lit("u"), "id").alias("url"))
    postings = urls.select(F.lit("word").alias("word"), "url", F.lit(1).alias("count"))
    write_index(website_ids(urls), store_postings(postings), path, id_buckets=8)
    write_ranks(spark.createDataFrame([], "website_id string, value double"), path)
    found = search.search(read_store(spark, path), "word", 2)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert plan.count("dynamicpruning") >= 2, plan  # websites, and ranks
    assert len(found.collect()) == 2


def test_loads_compress_ids_and_compute_them_as_before(spark, tmp_path):
    path = tmp_path / "store"
    postings = spark.range(300).selectExpr("concat('w', id % 7) AS word", "concat('a.org/', id) AS url", "id AS count")
    pipeline.load(str(path), postings, spark.createDataFrame([("a.org/1", 2.0)], "url string, rank double"))
    for table in ("inv_index", "websites", "page_rank"):
        names = [f.name for f in (path / table).glob("bucket=*/*.parquet")]
        assert names and all(name.endswith(".zstd.parquet") for name in names), names
    index = read_store(spark, str(path)).inv_index.drop("bucket")
    expected = store_postings(postings)
    assert index.schema.simpleString() == expected.schema.simpleString()
    assert sorted(map(tuple, index.collect())) == sorted(map(tuple, expected.collect()))
