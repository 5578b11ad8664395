"""Ranking that goes on after a failure, and links that stay in place."""

import os

import pytest
from pyspark.sql import functions as F

from test_graph import TOY, graph, hub_edges, ranks
from weblode.operators import pagerank
from weblode.operators.pagerank import page_rank, pagerank_step, rank_nodes, read_links, write_links
from weblode.plans import pipeline
from weblode.scratch import stage


class Broken(RuntimeError):
    pass


def break_after(monkeypatch, steps):
    """The step after ``steps`` fails while it is written. Returns the steps begun."""
    begun, step = [], pagerank.pagerank_step

    def limited(*args):
        begun.append(1)
        out = step(*args)
        if len(begun) > steps:
            return out.withColumn("rank", F.raise_error(F.lit("no more")).cast("double"))
        return out

    monkeypatch.setattr(pagerank, "pagerank_step", limited)
    return begun


def count_steps(monkeypatch):
    return break_after(monkeypatch, 10**6)


@pytest.mark.parametrize("per_slot", [1_000_000, 7])
@pytest.mark.parametrize("broken_after", [0, 1, 4])
def test_a_broken_run_goes_on_after_its_last_step(spark, tmp_path, monkeypatch, broken_after, per_slot):
    edges, state = stage(hub_edges(spark)), str(tmp_path / "state")
    expected = ranks(page_rank(edges, 6, links_per_slot=per_slot))
    with monkeypatch.context() as m:
        break_after(m, broken_after)
        with pytest.raises(Exception, match="no more"):
            page_rank(edges, 6, links_per_slot=per_slot, state=state)
    spark.catalog.clearCache()
    with monkeypatch.context() as m:
        begun = count_steps(m)
        # another session knows no table of the first one
        again = spark.newSession().read.parquet(*edges.inputFiles())
        got = ranks(page_rank(again, 6, links_per_slot=per_slot, state=state))
    assert len(begun) == 6 - broken_after
    assert got == pytest.approx(expected, abs=1e-12)
    assert not [t.name for t in spark.catalog.listTables() if t.name.startswith("weblode_links")]


def test_more_steps_go_on_and_fewer_begin_anew(spark, tmp_path, monkeypatch):
    edges, state = stage(graph(spark)), str(tmp_path / "state")
    page_rank(edges, 2, state=state)
    for steps, made in ((3, 1), (3, 0), (1, 1), (3, 2)):
        with monkeypatch.context() as m:
            begun = count_steps(m)
            got = ranks(page_rank(edges, steps, state=state))
        assert len(begun) == made
        assert got == pytest.approx(ranks(page_rank(edges, steps)))
    assert sum(name.startswith("state-") for name in os.listdir(state)) <= 2
    assert sum(name.endswith(".json") and name.startswith("step-") for name in os.listdir(state)) <= 2


def test_other_links_ranks_or_settings_begin_anew(spark, tmp_path, monkeypatch):
    state, edges = str(tmp_path / "state"), stage(graph(spark))
    page_rank(edges, 2, state=state)
    others = [
        (stage(graph(spark, TOY[1:])), {}), (edges, {"damping": 0.5}),
        (edges, {"initial": spark.createDataFrame([("A", 2.0)], "url string, rank double")}),
    ]
    for other, settings in others:
        with monkeypatch.context() as m:
            begun = count_steps(m)
            got = ranks(page_rank(other, 2, state=state, **settings))
        assert len(begun) == 2
        assert got == pytest.approx(ranks(page_rank(other, 2, **settings)))


@pytest.mark.parametrize("per_slot", [1_000_000, 7])
def test_links_are_not_shuffled_when_nothing_is_cached(spark, tmp_path, per_slot):
    edges = stage(hub_edges(spark))
    nodes = stage(rank_nodes(edges, links_per_slot=per_slot))
    path = str(tmp_path / "links")
    links, table = read_links(spark, path, write_links(edges, nodes, path))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = pagerank_step(links, nodes.drop("url"))._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.sql(f"DROP TABLE {table}")
    assert "Bucketed: true" in plan
    joined = plan[plan.index("SortMergeJoin") : plan.index("Bucketed: true")]
    assert "Exchange" not in joined, plan
    assert os.path.isdir(path)


def test_a_run_that_breaks_off_keeps_its_steps(spark, tmp_path, monkeypatch):
    out = str(tmp_path / "out")
    pages = spark.createDataFrame(
        [("a.org/1", "<a href='/2'>go</a> word"), ("a.org/2", "<a href='/1'>back</a> <a href='/3'>on</a>")], "url string, html string")
    with monkeypatch.context() as m:
        break_after(m, 3)
        with pytest.raises(Exception, match="no more"):
            pipeline.run(pages, out, 5)
    assert os.listdir(out) == [pipeline.STATE]
    with monkeypatch.context() as m:
        begun = count_steps(m)
        pipeline.run(pages, out, 5)
    assert len(begun) == 2 and sorted(os.listdir(out)) == ["edges", "postings", "ranks", "urls"]
    pipeline.run(pages, str(tmp_path / "whole"), 5)
    whole = ranks(spark.read.parquet(f"{tmp_path}/whole/ranks"))
    assert ranks(spark.read.parquet(f"{out}/ranks")) == pytest.approx(whole)
