"""Merges that leave other buckets alone, and packing that goes on."""

import gzip
import os

import pytest
from pyspark.sql import functions as F

from test_sources import crawl, put, rows  # noqa: F401
from test_top import HEAVY, tables
from test_search import brute_force, found, make_store
from weblode.files import Files
from weblode.plans import search
from weblode.plans.store import merge_ranks, read_store, write_store
from weblode.sources import crawl as crawls
from weblode.sources import keyed, publish
from weblode.sources.crawl import pack_crawl, read_crawl, skipped_files, skipped_in
from weblode.sources.publish import TableExists


class Broken(RuntimeError):
    pass


def files_by_bucket(path):
    return {d: sorted(f for f in os.listdir(f"{path}/{d}") if f.endswith(".parquet"))
            for d in os.listdir(path) if d.startswith("bucket=")}


def table(spark, *values, schema="k string, v int, w string"):
    return spark.createDataFrame(values, schema)


def test_merging_in_place_keeps_the_files_of_other_buckets(spark, tmp_path):
    root = str(tmp_path)
    keyed.create_bucketed(table(spark, *[(f"k{i}", i, f"w{i}") for i in range(200)]), root, "t", ["k"], 16)
    before = files_by_bucket(f"{root}/t")
    change = spark.createDataFrame([("k3", -3), ("new", 7)], "k string, v int")
    keyed.merge_bucketed(change, root, "t", ["k"], 16)
    expected = {f"k{i}": (-3 if i == 3 else i, f"w{i}") for i in range(200)} | {"new": (7, None)}
    assert {r["k"]: (r["v"], r["w"]) for r in keyed.read_bucketed(spark, root, "t").collect()} == expected
    after = files_by_bucket(f"{root}/t")
    changed = {d for d in after if after[d] != before.get(d)}
    assert 1 <= len(changed) <= 2 and len(after) == len(before)
    assert sorted(os.listdir(root)) == ["t"]


def test_merging_nothing_repeated_keys_and_new_columns(spark, tmp_path):
    root = str(tmp_path)
    keyed.create_bucketed(table(spark, ("a", 1, "x"), (None, 2, "y")), root, "t", ["k"], 4)
    keyed.merge_bucketed(table(spark), root, "t", ["k"], 4)
    assert keyed.read_bucketed(spark, root, "t").count() == 2
    with pytest.raises(keyed.KeyCollision):
        keyed.merge_bucketed(table(spark, ("b", 1, "x"), ("b", 2, "x")), root, "t", ["k"], 4)
    with pytest.raises(ValueError, match="z"):
        keyed.merge_bucketed(table(spark, ("b", 1), schema="k string, z int"), root, "t", ["k"], 4)
    with pytest.raises(TableExists):
        keyed.create_bucketed(table(spark), root, "t", ["k"], 4)


def test_a_merge_that_breaks_off_is_finished_or_undone(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(publish, "GRACE_SECONDS", 0.0)
    for k in range(4):
        root = str(tmp_path / str(k))
        keyed.create_bucketed(table(spark, *[(f"k{i}", i, "old") for i in range(40)]), root, "t", ["k"], 4)
        rename, calls = Files.rename, []

        def limited(self, source, target, rename=rename, calls=calls, k=k):
            calls.append(target)
            if len(calls) > k:
                raise Broken
            return rename(self, source, target)

        with monkeypatch.context() as m:
            m.setattr(Files, "rename", limited)
            with pytest.raises(Broken):
                keyed.merge_bucketed(table(spark, *[(f"k{i}", i, "new") for i in range(40)]), root, "t", ["k"], 4)
        kinds = [r["w"] for r in keyed.read_bucketed(spark, root, "t").collect()]
        assert kinds == ["old" if k == 0 else "new"] * 40


def test_ranks_are_merged_into_a_store(spark, tmp_path):
    path, (websites, postings, ranks) = str(tmp_path / "s"), tables(120, 6)
    write_store(make_store(spark, websites, postings, ranks), path, heavy_postings=HEAVY)
    old = dict(ranks)
    new = {page: 3.25 for page, _ in websites[::17]}
    merge_ranks(spark.createDataFrame(list(new.items()), "website_id string, value double"), path, heavy_postings=HEAVY)
    store, merged = read_store(spark, path), list((old | new).items())
    assert sorted((r["website_id"], r["value"]) for r in store.page_rank.collect()) == sorted(merged)
    for word in ("hot", "a"):
        assert found(search.search(store, word, 30)) == brute_force(websites, postings, merged, word, 30)


def big_crawl(root):
    for host in ("a.org", "b.org", "c.org"):
        for k in range(5):
            put(root, f"{host}/sub{k % 2}/{k}.html", f"<body>{host} {k}</body>")
    put(root, "loose.html", "<body>loose</body>")
    put(root, "index.html", "boilerplate")


@pytest.mark.parametrize("how", [{}, {"folders": 1}, {"files": 3}, {"files": 1}])
def test_huge_hosts_are_cut(spark, tmp_path, how, monkeypatch):
    root, out = tmp_path / "crawl", str(tmp_path / "pages")
    big_crawl(root)
    slices, pack = [], crawls._pack_slice
    monkeypatch.setattr(crawls, "_pack_slice", lambda *a: slices.append(a[2]) or pack(*a))
    pack_crawl(spark, str(root), out, **how)
    assert rows(spark.read.parquet(out)) == rows(read_crawl(spark, str(root)))
    if "files" in how:
        system = Files(spark, str(root))
        assert all(sum(system.count(p) for p in paths) <= how["files"] for paths in slices)
    with pytest.raises(TableExists):
        pack_crawl(spark, str(root), out, **how)


def test_loose_files_of_a_huge_host_fill_slices(spark, tmp_path):
    """They are bounded by the number of files, not by that of folders."""
    for k in range(50):
        put(tmp_path / "crawl", f"hot.org/{k}.html", f"<body>{k}</body>")
    for host in ("a.org", "b.org", "c.org"):
        put(tmp_path / "crawl", f"{host}/1.html", "<body>one</body>")
    slices = list(crawls._Slices(spark, 2, 20).of(str(tmp_path / "crawl"), set()))
    assert [len(paths) for paths in slices] == [2, 20, 20, 11]
    assert len({path for paths in slices for path in paths}) == 53


@pytest.mark.parametrize("at", [0, 1, 2])
def test_packing_goes_on_after_a_failure(spark, tmp_path, monkeypatch, at):
    root, out = tmp_path / "crawl", str(tmp_path / "pages")
    big_crawl(root)
    pack, calls = crawls._pack_slice, []

    def broken(*args):
        calls.append(args[2])
        pack(*args)  # written, but not yet in place
        if len(calls) > at:
            raise Broken

    with monkeypatch.context() as m:
        m.setattr(crawls, "_pack_slice", broken)
        with pytest.raises(Broken):
            pack_crawl(spark, str(root), out, folders=1)
    assert spark.read.parquet(out).count() == 5 * at
    done, calls = calls[:at], []
    with monkeypatch.context() as m:
        m.setattr(crawls, "_pack_slice", lambda *a: calls.append(a[2]) or pack(*a))
        pack_crawl(spark, str(root), out, folders=1)
    assert not [paths for paths in calls if paths in done]
    assert rows(spark.read.parquet(out)) == rows(read_crawl(spark, str(root)))


def test_skipped_files_are_noted_while_packing(spark, crawl, tmp_path):  # noqa: F811
    put(crawl, "b.org/broken.html.gz", gzip.compress(os.urandom(5000))[:3000])
    out = str(tmp_path / "pages")
    pack_crawl(spark, str(crawl), out, folders=1)
    assert rows(skipped_in(spark, out)) == rows(skipped_files(spark, str(crawl))) != []
    packed = dict(rows(spark.read.parquet(out)))
    assert packed == dict(rows(read_crawl(spark, str(crawl))))
    plan = skipped_in(spark, out)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and "text" not in plan.lower()


def test_an_empty_crawl(spark, tmp_path):
    (tmp_path / "crawl").mkdir()
    pack_crawl(spark, str(tmp_path / "crawl"), str(tmp_path / "pages"))
    assert spark.read.parquet(str(tmp_path / "pages")).select("url", F.length("html")).count() == 0


def test_loose_files_are_listed_by_few_tasks(spark, tmp_path):
    """And not by one task each, which took most of the time of a slice."""
    names = [f"hot.org/{k}.html" for k in range(60)]
    for name in names:
        put(tmp_path, name, f"<body>{name}</body>")
    context = spark.sparkContext
    context.setJobGroup("listing", "listing")
    before = spark.conf.get(crawls.LISTERS, None)
    files = crawls._files(spark, [str(tmp_path / name) for name in names])
    context.setJobGroup("other", "other")
    tracker = context.statusTracker()
    stages = [s for job in tracker.getJobIdsForGroup("listing") for s in tracker.getJobInfo(job).stageIds]
    assert stages and all(tracker.getStageInfo(s).numTasks <= context.defaultParallelism for s in stages)
    assert files.count() == 60 and spark.conf.get(crawls.LISTERS, None) == before
