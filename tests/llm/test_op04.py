"""Mixing: targets, flow and choice."""

import itertools
import random

import pytest
from pyspark.sql import functions as F

from weblode.llm import op04_mixing as op


def filled(sizes, weights=(5, 2, 1), share=1.5, cap=2):
    """Targets by the rule's own rounds."""
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    w = {s: weights[k % 3] for k, s in enumerate(names)}
    target, open_, left = {}, list(names), share * sum(sizes.values())
    while open_:
        level = left / sum(w[s] for s in open_)
        over = [s for s in open_ if level * w[s] > cap * sizes[s]]
        if not over:
            target |= {s: level * w[s] for s in open_}
            break
        for s in over:
            target[s] = cap * sizes[s]
            left -= target[s]
            open_.remove(s)
    return target


@pytest.mark.parametrize("sizes", [
    {"a": 10, "b": 1000, "c": 5, None: 40}, {"b": 0, "a": 7}, {"x": 3}, {"a": 0}, {"é": 5, "z": 5, "a": 5, "": 1}, {},
])
def test_targets(spark, sizes):
    df = spark.createDataFrame(list(sizes.items()), "source string, source_size long")
    got = {r["source"]: r["target"] for r in op.weighted_targets(df).collect()}
    assert got == pytest.approx(filled(sizes))


def cheapest(patterns, quotas, repeats):
    """Most words, then least cost, by trying all flows of small cases."""
    ways = [(p, s) for p in patterns for s in patterns[p][1] if s in quotas]
    best = (-1, 0)
    for flow in itertools.product(*[range(quotas[s] + 1) for _, s in ways]):
        out = {p: sum(f for f, w in zip(flow, ways) if w[0] == p) for p in patterns}
        if any(out[p] > repeats * patterns[p][0] for p in out):
            continue
        if any(sum(f for f, w in zip(flow, ways) if w[1] == s) > quotas[s] for s in quotas):
            continue
        cost = sum(max(0, out[p] - k * patterns[p][0]) for p in out for k in range(1, repeats))
        best = max(best, (sum(flow), -cost))
    return best


def test_route_is_a_cheapest_largest_flow():
    rng = random.Random(2)
    for _ in range(40):
        quotas = {s: rng.randrange(5) for s in "ab"}
        patterns = {p: (rng.randrange(4), list(p)) for p in ("a", "b", "ab")}
        flow = op.route(patterns, quotas, 2)
        out = {p: sum(n for (q, _), n in flow.items() if q == p) for p in patterns}
        cost = sum(max(0, out[p] - patterns[p][0]) for p in patterns)
        assert all(out[p] <= 2 * patterns[p][0] for p in patterns)
        assert all(sum(n for (_, t), n in flow.items() if t == s) <= quotas[s] for s in quotas)
        assert (sum(flow.values()), -cost) == cheapest(patterns, quotas, 2)


def test_overlapping_sources(spark):
    rows = [(k, 10, ["x"] if k % 3 else ["x", "y"]) for k in range(90)] + [(900, 10, []), (901, 10, None), (902, None, ["x"])]
    df = spark.createDataFrame(rows, "id long, size long, sources array<string>").withColumn("taken", F.lit("clash"))
    targets = spark.createDataFrame([("x", 600.0), ("y", 200.0)], "source string, target double")
    got = op.mix(df, targets, "sources", "size", "id").collect()
    assert len(got) == len(rows)
    words = {s: sum(10 * r["taken_for"].count(s) for r in got if r["size"]) for s in "xy"}
    assert abs(words["x"] - 600) <= 10 and abs(words["y"] - 200) <= 10
    assert all(r["copies"] <= 2 and r["taken"] == (r["size"] or 0) * r["copies"] for r in got)
    assert sum(r["copies"] for r in got if r["id"] in (900, 901)) == 0


def test_sources_and_reruns(spark):
    rng = random.Random(1)
    rows = [(k, "w " * rng.randrange(60), rng.choice(["a", "b", "c", None]), "z") for k in range(300)]
    rows += [(None, None, "a", "z"), (5, "w w", "a", "z"), (5, "w w", "a", "z"), (7, "", "empty", "z"), (8, "w " * 3000, "c", "z")]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string, size string")
    got = op.mix_by_source(df.repartition(4)).collect()
    again = op.mix_by_source(df.repartition(2)).collect()
    key = lambda r: repr((r["doc_id"], r["text"], r["taken"]))
    assert sorted(map(key, got)) == sorted(map(key, again)) and len(got) == len(rows)
    sizes = {s: sum(len((t or "").split()) for _, t, x, _ in rows if x == s) for s in {r[2] for r in rows}}
    for s, target in filled(sizes).items():
        own = [r for r in got if r["source"] == s]
        assert all(r["target"] == pytest.approx(target) for r in own)
        assert abs(sum(r["taken"] for r in own) - target) <= max(r["size"] for r in own) / 2 + 1
        assert all(r["taken"] <= 2 * r["size"] for r in own)


def test_empty(spark):
    assert op.mix_by_source(spark.createDataFrame([], "doc_id long, text string, source string")).count() == 0


def test_the_query_goes_through_the_flow(spark, monkeypatch):
    from conftest import SMALL

    calls, own = [], op.route
    monkeypatch.setattr(op, "route", lambda *a: calls.append(a) or own(*a))
    op.query(spark, SMALL).collect()
    sources = spark.read.parquet(f"{SMALL}/documents.parquet").select("source").distinct().count()
    assert len(calls) == 1 and len(calls[0][0]) == len(calls[0][1]) == sources


def test_documents_are_not_shuffled_by_pattern_alone(spark):
    df = spark.range(5000).select("id", F.lit(3).alias("size"), F.array(F.concat(F.lit("s"), F.col("id") % 2)).alias("m"))
    targets = spark.createDataFrame([("s0", 900.0), ("s1", 20000.0)], "source string, target double")
    plan = op.mix(df, targets, "m", "size", "id")._jdf.queryExecution().executedPlan().toString()
    keys = [line.split("hashpartitioning(")[1] for line in plan.splitlines() if "hashpartitioning(" in line]
    # one window of documents by pattern and range; by pattern alone only what is known of ranges
    by_pattern = [k for k in keys if k.startswith("pattern#") and "range#" not in k.split(")")[0]]
    assert plan.count("hashpartitioning(pattern") >= 1 and "row#" not in "".join(by_pattern)
    above = plan[: plan.index("Window")]
    assert "hashpartitioning(pattern#" not in above.replace("range#", "") or "range#" in above


def test_input_columns_of_any_name_are_carried_through(spark):
    names = ("pattern", "size", "place", "range", "words", "within", "before", "row", "parts", "_range", "name", "membership")
    df = spark.range(40).select(
        F.col("id").alias("doc_id"), F.concat(F.lit("s"), F.col("id") % 3).alias("source"), F.lit("a b c").alias("text"),
        *[F.lit(f"keep {n}").alias(n) for n in names if n != "size"])
    rows = op.mix_by_source(df).collect()
    assert len(rows) == 40 and all(r[n] == f"keep {n}" for r in rows for n in names if n != "size")
    other = df.withColumnRenamed("name", "size").withColumn("n", F.lit(2)).withColumn("m", F.array("source"))
    targets = spark.createDataFrame([("s0", 9.0)], "source string, target double")
    assert {r["size"] for r in op.mix(other, targets, "m", "n", "doc_id").collect()} == {"keep name"}


def test_more_patterns_than_the_driver_routes(spark, monkeypatch):
    """Patterns that share nothing are left out of the flow; the mix is the same."""
    rows = [(k, 7, [f"s{k % 9}"]) for k in range(90)] + [(k, 5, ["x"] if k % 2 else ["x", "y"]) for k in range(90, 130)]
    df = spark.createDataFrame(rows, "id long, size long, m array<string>")
    targets = spark.createDataFrame([(f"s{k}", 20.0 * k) for k in range(9)] + [("x", 150.0), ("y", 70.5)], "source string, target double")
    run = lambda: sorted((r["id"], r["taken"], *r["taken_for"]) for r in op.mix(df, targets, "m", "size", "id").collect())
    whole = run()
    monkeypatch.setattr(op, "MAX_PATTERNS", 3)
    assert run() == whole
    monkeypatch.setattr(op, "MAX_PATTERNS", 1)
    with pytest.raises(ValueError, match="overlapping"):
        run()
