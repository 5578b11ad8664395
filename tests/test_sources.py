import gzip
import os

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from weblode.operators.index import indexed_urls, inverted_index, posting_lists
from weblode.sources import keyed, packed, tables
from weblode.sources.crawl import pack_crawl, read_crawl, skipped_files
from weblode.sources.tables import read_documents, read_pages, spread
from conftest import SMALL


def rows(df):
    return sorted(map(tuple, df.collect()))


def put(root, path, content):
    target = root / path
    target.parent.mkdir(parents=True, exist_ok=True)
    target.write_bytes(content if isinstance(content, bytes) else content.encode())


@pytest.fixture
def crawl(tmp_path):
    root = tmp_path / "v1.0 crawl+x"  # a dotted folder above the pages
    put(root, "a.org/index.html", "<body>one</body>")
    put(root, "a.org/sub dir/50%.html", "<body>two</body>")
    put(root, "a.org/c++.htm", "line 1\nline 2\r\n")
    put(root, "b.org/latin.html", b"caf\xe9 ol\xc3\xa9")
    put(root, "b.org/empty.html", "")
    put(root, "nohost/page", "dropped")
    put(root, "index.html", "boilerplate")
    put(root, "fade.gif", "boilerplate")
    put(root, "backblue.gif", "boilerplate")
    return root


def test_crawl_directory(spark, crawl):
    found = dict(rows(read_crawl(spark, str(crawl))))
    found.pop("b.org/empty", None)  # an empty file has neither words nor links
    assert found == {
        "a.org/index": "<body>one</body>",
        "a.org/sub dir/50%": "<body>two</body>",
        "a.org/c++.htm": "line 1\nline 2\r\n",
        "b.org/latin": "caf� olé",
    }
    assert rows(read_crawl(spark, f"file://{crawl}/")) == rows(read_crawl(spark, str(crawl)))


def test_relative_root_is_an_error(spark):
    with pytest.raises(ValueError):
        read_crawl(spark, "crawl")


def test_pattern_as_root_is_an_error(spark, crawl):
    with pytest.raises(ValueError, match="pattern"):
        read_crawl(spark, str(crawl)[:-3] + "*")


def test_packing_by_folders_gives_the_same_pages(spark, crawl, tmp_path):
    pack_crawl(spark, str(crawl), str(tmp_path / "pages"), folders=1)
    packed_pages = dict(rows(spark.read.parquet(str(tmp_path / "pages"))))
    assert packed_pages == dict(rows(read_crawl(spark, str(crawl))))


def test_packing_takes_pages_that_lie_in_the_root(spark, crawl, tmp_path):
    for name in ("about.html", "new?a.html", "newxa.html", "index.html", "_own.html", ".own.html", "_a=b.html"):
        put(crawl, name, f"<body>{name}".encode())
    pack_crawl(spark, str(crawl), str(tmp_path / "pages"), folders=2)
    packed = rows(spark.read.parquet(str(tmp_path / "pages")))
    assert sorted(packed) == sorted(rows(read_crawl(spark, str(crawl))))
    assert "<body>about.html" in [html for _, html in packed]


def test_unreadable_file_is_skipped(spark, crawl):
    put(crawl, "b.org/broken.html.gz", gzip.compress(os.urandom(5000))[:3000])
    assert [f.rsplit("/", 1)[1] for (f,) in rows(skipped_files(spark, str(crawl)))] == ["broken.html.gz"]
    urls = {url for url, _ in rows(read_crawl(spark, str(crawl)))}
    assert "a.org/index" in urls
    assert not any("broken" in url for url in urls)


def test_index_of_a_crawl(spark, crawl):
    assert ("one", "a.org/index", 1) in rows(inverted_index(read_crawl(spark, str(crawl))))


def test_texts_are_cut_into_pieces_whatever_their_files_are(spark, tmp_path, monkeypatch):
    """One file with one row group, many times as large as a piece."""
    path, rows = str(tmp_path / "texts"), 400
    texts = spark.range(0, rows, 1, 1).select(
        F.col("id").alias("doc_id"), F.col("id").cast("string").alias("url"), F.repeat(F.sha2(F.col("id").cast("string"), 512), 20).alias("text"))
    texts.withColumn("html", F.col("text")).write.parquet(path)
    monkeypatch.setattr("weblode.sources.tables.SPREAD_BYTES", 1)
    monkeypatch.setattr("weblode.sources.tables.TEXT_BYTES", 1000)
    for read in (read_pages(spark, path), read_documents(spark, path, "doc_id", "text")):
        sizes = [r["count"] for r in read.groupBy(F.spark_partition_id()).count().collect()]
        assert sum(sizes) == rows and len(sizes) >= 20 and max(sizes) <= rows / 10


def test_small_scans_are_spread_and_large_ones_left_alone(spark, monkeypatch):
    scan = spark.read.parquet(f"{SMALL}/pages.parquet")
    plan = spread(scan)._jdf.queryExecution().optimizedPlan().toString()
    assert f"Repartition {spark.sparkContext.defaultParallelism}" in plan
    monkeypatch.setattr(tables, "SPREAD_BYTES", 1)
    assert spread(scan) is scan
    made = spark.range(100)
    assert spread(made) is made


@pytest.fixture(scope="module")
def postings(spark):
    return inverted_index(read_pages(spark, f"{SMALL}/pages.parquet")).persist()


def test_indexed_urls_are_those_of_the_postings(spark, postings):
    pages = read_pages(spark, f"{SMALL}/pages.parquet")
    assert rows(indexed_urls(pages)) == rows(postings.select("url").distinct())


@pytest.mark.parametrize("per_list", [100_000, 5])
def test_packed_postings_round_trip(spark, postings, tmp_path, per_list):
    path = str(tmp_path / "packed")
    packed.write_packed_postings(postings, path, per_list=per_list)
    assert rows(packed.read_packed_postings(spark, path)) == rows(postings)
    with pytest.raises(PySparkException):
        packed.write_packed_postings(postings, path)
    packed.write_packed_postings(postings.limit(3), path, mode="overwrite")
    assert packed.read_packed_postings(spark, path).count() == 3


def test_long_posting_lists_are_split(spark, postings):
    lists = posting_lists(postings, per_list=5)
    longest = postings.groupBy("word").count().orderBy(F.desc("count")).first()
    assert longest["count"] > 15
    split = lists.where(F.col("word") == longest["word"])
    parts = {row["part"] for row in split.collect()}
    assert len(parts) == split.count() > 1
    assert {row["parts"] for row in split.collect()} == {-(-longest["count"] // 5)} and max(parts) < -(-longest["count"] // 5)
    sizes = lists.select(F.size(F.split("postings", r"\|")) / 2)
    assert sum(size for (size,) in sizes.collect()) == postings.count()


def test_reducer_files_are_read_and_others_left_out(spark, tmp_path):
    put(tmp_path, "out/part-r-00000", "word\ta.org/x|2|b.org/|1\n")
    put(tmp_path, "out/sub/part-r-00001", "other\ta.org/x|1\n\nlonely\n")
    put(tmp_path, "out/part-m-00000", "no\ta.org/x|1\n")
    put(tmp_path, "out/notes.txt", "no\ta.org/x|1\n")
    put(tmp_path, "out/_SUCCESS", "")
    assert rows(packed.read_packed_postings(spark, str(tmp_path / "out"))) == [
        ("other", "a.org/x", 1),
        ("word", "a.org/x", 2),
        ("word", "b.org/", 1),
    ]


def test_packed_nodes(spark, tmp_path):
    put(tmp_path, "part-r-00000", "A|0.5\tB|C\nB|1.25E-4\t\nC|2\n")
    ranks, edges = packed.read_packed_nodes(spark, str(tmp_path))
    assert rows(ranks) == [("A", 0.5), ("B", 1.25e-4), ("C", 2.0)]
    assert rows(edges) == [("A", "B"), ("A", "C")]
    assert rows(packed.read_packed_ranks(spark, str(tmp_path))) == rows(ranks)


@pytest.mark.parametrize("per_list", [100_000, 1])
def test_packed_nodes_round_trip(spark, tmp_path, per_list):
    edges = spark.createDataFrame([("A", "B"), ("A", "C"), ("B", "C")], "src string, dst string")
    ranks = spark.createDataFrame([("A", 1 / 3), ("B", 0.1), ("C", 7e-9)], "url string, rank double")
    path = str(tmp_path / "nodes")
    packed.write_packed_nodes(edges, path, ranks, per_list=per_list)
    got_ranks, got_edges = packed.read_packed_nodes(spark, path)
    assert rows(got_ranks) == rows(ranks)
    assert rows(got_edges) == rows(edges)
    packed.write_packed_nodes(edges, path, mode="overwrite", per_list=per_list)
    got_ranks, got_edges = packed.read_packed_nodes(spark, path)
    assert rows(got_ranks) == [("A", 1.0), ("B", 1.0)]
    assert rows(got_edges) == rows(edges)


def test_url_that_breaks_the_format_is_an_error(spark, tmp_path):
    bad = spark.createDataFrame([("w", "a.org/x|y", 1)], "word string, url string, count long")
    with pytest.raises(PySparkException, match="cannot pack"):
        packed.write_packed_postings(bad, str(tmp_path / "bad"))


def test_keyed_tables(spark, tmp_path):
    path, merged = str(tmp_path / "table"), str(tmp_path / "merged")

    def table(*values):
        return spark.createDataFrame(values, "k string, v int")

    with pytest.raises(keyed.KeyCollision):
        keyed.create_table(table(("a", 1), ("a", 2)), path, ["k"])
    keyed.create_table(table(("a", 1), ("b", 2)).coalesce(1), path, ["k"], max_records_per_file=1)
    assert len([f for f in os.listdir(path) if f.endswith(".parquet")]) == 2
    with pytest.raises(PySparkException):
        keyed.create_table(table(("c", 1)), path, ["k"])
    with pytest.raises(keyed.KeyCollision):
        keyed.append_rows(table(("b", 5), ("c", 3)), path, ["k"])
    keyed.append_rows(table(("c", 3)), path, ["k"])
    assert rows(spark.read.parquet(path)) == [("a", 1), ("b", 2), ("c", 3)]

    keyed.merge_rows(table(("c", 9), ("d", 4)), path, ["k"], merged)
    assert rows(spark.read.parquet(merged)) == [("a", 1), ("b", 2), ("c", 9), ("d", 4)]
    other = spark.createDataFrame([("a", "x"), ("e", "y")], "k string, w string")
    keyed.merge_rows(other, path, ["k"], str(tmp_path / "merged2"))
    got = spark.read.parquet(str(tmp_path / "merged2")).select("k", "v", "w")
    assert set(map(tuple, got.collect())) == {
        ("a", 1, "x"), ("b", 2, None), ("c", 3, None), ("e", None, "y"),
    }
