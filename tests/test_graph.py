import re

import pytest

from pyspark.sql import functions as F

from weblode.operators import links
from weblode.operators.pagerank import page_rank

TOY = [("A", "B"), ("A", "C"), ("B", "C"), ("C", "A"), ("C", "E"), ("D", "C")]
TOY_RANKS = {
    0: {"A": 1, "B": 1, "C": 1, "D": 1},
    1: {"A": 0.575, "B": 0.575, "C": 2.275, "D": 0.15, "E": 0.575},
    2: {"A": 1.116875, "B": 0.394375, "C": 1.010625, "D": 0.15, "E": 1.116875},
    3: {"A": 0.579516, "B": 0.624672, "C": 1.087391, "D": 0.15, "E": 0.579516},
}


def graph(spark, edges=TOY):
    return spark.createDataFrame(edges, "src string, dst string")


def ranks(df):
    rows = df.collect()
    found = {row["url"]: row["rank"] for row in rows}
    assert len(found) == len(rows)
    return found


def pages(spark, rows):
    return spark.createDataFrame(rows, "url string, html string")


@pytest.mark.parametrize("steps", TOY_RANKS)
def test_toy_ranks(spark, steps):
    got = ranks(page_rank(graph(spark), steps))
    assert got == pytest.approx(TOY_RANKS[steps], abs=5e-7)


def test_resumed_steps_equal_steps_in_one_go(spark):
    half = page_rank(graph(spark), 1)
    assert ranks(page_rank(graph(spark), 2, initial=half)) == pytest.approx(
        TOY_RANKS[3], abs=5e-7
    )


def test_nodes_known_only_from_initial_ranks_keep_a_rank(spark):
    initial = spark.createDataFrame([("A", 2.0), ("Z", 9.0)], "url string, rank double")
    got = ranks(page_rank(graph(spark, [("A", "B")]), 1, initial=initial))
    assert got == pytest.approx({"A": 0.15, "B": 0.15 + 0.85 * 2, "Z": 0.15})


def test_damping(spark):
    got = ranks(page_rank(graph(spark, [("A", "B"), ("B", "A")]), 3, damping=0.5))
    assert got == pytest.approx({"A": 1.0, "B": 1.0})


def test_negative_steps_are_an_error(spark):
    with pytest.raises(ValueError):
        page_rank(graph(spark), -1)


def hub_edges(spark):
    """A hub with a third of all links, both ways, in a ring of 300 nodes."""
    n = F.col("id")
    ring = spark.range(300).select(
        F.concat(F.lit("n"), n).alias("src"), F.concat(F.lit("n"), (n + 1) % 300).alias("dst")
    )
    out = ring.select(F.lit("hub").alias("src"), "dst")
    back = ring.select("src", F.lit("hub").alias("dst"))
    return ring.unionByName(out).unionByName(back)


def test_splitting_heavy_sources_changes_nothing(spark, monkeypatch):
    from weblode.operators import skew

    edges = hub_edges(spark)
    whole = ranks(page_rank(edges, 4))
    assert sum(whole.values()) == pytest.approx(301)
    assert min(whole.values()) >= 0.15
    assert ranks(page_rank(edges, 4, links_per_slot=7)) == pytest.approx(whole)
    monkeypatch.setattr(skew, "MAX_BROADCAST_KEYS", 0)
    assert ranks(page_rank(edges, 4, links_per_slot=7)) == pytest.approx(whole)


def test_ranks_do_not_depend_on_partitions_or_join_strategy(spark):
    edges = hub_edges(spark)
    expected = ranks(page_rank(edges, 3))
    for key, value in (
        ("spark.sql.shuffle.partitions", "3"),
        ("spark.sql.autoBroadcastJoinThreshold", "-1"),
    ):
        before = spark.conf.get(key)
        spark.conf.set(key, value)
        try:
            assert ranks(page_rank(edges, 3)) == pytest.approx(expected)
        finally:
            spark.conf.set(key, before)


def test_steps_do_not_shuffle_the_links(spark):
    from weblode.operators.pagerank import lay_out, pagerank_step, rank_nodes
    from weblode.scratch import stage

    edges = stage(graph(spark))
    for per_slot in (1_000_000, 1):
        nodes = stage(rank_nodes(edges, links_per_slot=per_slot))
        laid_out = lay_out(edges, nodes)
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        try:
            step = pagerank_step(laid_out, nodes.drop("url"))
            plan = step._jdf.queryExecution().executedPlan().toString()
        finally:
            spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
            laid_out.unpersist()
        above_cache = plan[: plan.index("InMemoryTableScan")]
        joined = above_cache[above_cache.index("SortMergeJoin") :]
        assert "Exchange" not in joined, plan


def test_laid_out_links_leave_no_table(spark):
    from weblode.operators.pagerank import lay_out, rank_links, rank_nodes
    from weblode.scratch import stage

    edges, before = stage(graph(spark)), {t.name for t in spark.catalog.listTables()}
    for per_slot in (1_000_000, 1):
        nodes = stage(rank_nodes(edges, links_per_slot=per_slot))
        laid_out = lay_out(edges, nodes)
        try:
            assert {t.name for t in spark.catalog.listTables()} == before
            heavy = nodes.where("slots > 1").count()
            assert ("slot" in laid_out.columns) == (heavy > 0)
            got = sorted(map(tuple, laid_out.select("src", "dst").collect()))
            assert got == sorted(map(tuple, rank_links(edges, nodes, heavy).select("src", "dst").collect()))
        finally:
            laid_out.unpersist()


def test_link_graph(spark):
    found = pages(
        spark,
        [
            ("a.org/x", "<a href='/y.html'>1</a><a href='/y.html'>2</a><a href='z?q'>3</a>"),
            ("a.org/x", "<a href='/y.html'>again</a><a href='http://b.org/'>4</a>"),
            ("a.org/none", "<a href='#top'>5</a><p>no link"),
            ("a.org/null", None),
        ],
    )
    edges = links.link_graph(found)
    expected = {("a.org/x", dst) for dst in ("a.org/y.html", "a.org/z", "b.org/")}
    assert sorted(map(tuple, edges.collect())) == sorted(expected)
    stripped = {row["dst"] for row in links.link_graph(found, strip_targets=True).collect()}
    assert stripped == {"a.org/y", "a.org/z", "b.org/"}


def test_nodes_degrees_and_lists(spark):
    edges = graph(spark)
    assert sorted(r["url"] for r in links.graph_nodes(edges).collect()) == list("ABCDE")
    degrees = {r["src"]: r["out_degree"] for r in links.out_degrees(edges).collect()}
    assert degrees == {"A": 2, "B": 1, "C": 2, "D": 1}
    lists = {r["src"]: r["links"] for r in links.adjacency_lists(edges).collect()}
    assert lists == {"A": "B|C", "B": "C", "C": "A|E", "D": "C"}


def test_long_lists_are_split(spark):
    lists = links.adjacency_lists(hub_edges(spark), per_list=50).collect()
    hub = [row["links"].split("|") for row in lists if row["src"] == "hub"]
    assert len(hub) > 1
    assert max(map(len, hub)) < 300
    assert sorted(sum(hub, [])) == sorted(f"n{i}" for i in range(300))
    assert sum(len(row["links"].split("|")) for row in lists) == 900


def test_pairs_of_parts_are_told_apart_as_numbers(spark):
    from weblode.registered import _part_graph

    graph = _part_graph(spark, "/root/testdata/sf0.001")
    assert graph.dtypes == [("src", "string"), ("dst", "string")]
    plan = graph._jdf.queryExecution().optimizedPlan().toString()
    assert re.match(r"Aggregate \[src#\d+L, dst#\d+L\]", plan), plan
