"""Mixing sources to target weights: a min-cost flow from membership patterns
to source quotas, then a seeded choice of documents."""

from __future__ import annotations

from collections import defaultdict, deque

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from weblode.llm.common import blank, read_table, stage

NAME = "op4_mixing"

WORD = r"[^\x20\x09-\x0D]+"
#: Fixed values of the contract: weights in turn, share of all words, repeats.
WEIGHTS, SHARE, REPEATS = (5, 2, 1), 1.5, 2
SEED = "mix-1"
#: Membership patterns that the driver routes. If there are more, those are left
#: out that share no source with another, for which the flow is a formula; more
#: overlapping ones are an error, never cut.
MAX_PATTERNS = 200_000


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def weighted_targets(sizes: DataFrame, weights: tuple = WEIGHTS, share: float = SHARE, cap: int = REPEATS) -> DataFrame:
    """``(source, source_size, target)`` from ``(source, source_size)``.

    Sources in code point order, null last, get ``weights`` in turn and part
    ``share`` times all words; none gets more than ``cap`` times its size, and
    what is over goes to the others by weight. That end is a common level:
    sources in order of size per weight are capped as long as the level of the
    rest lies above them. The table has one row per source, and so has the
    only task that sees all of them.
    """
    # null last, and every window over the one row per source
    turn = F.row_number().over(W.orderBy(F.col("source").isNull(), "source")) - 1
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), (turn % len(weights) + 1).cast("int"))
    sized = sizes.select("source", F.col("source_size").cast("long").alias("source_size")).withColumn("w", weight)
    by_level = W.orderBy((F.col("source_size") * cap / F.col("w")), "w", F.col("source").isNull(), "source")
    whole = W.partitionBy()
    before = by_level.rowsBetween(W.unboundedPreceding, -1)
    left = sized.withColumn("full", F.coalesce(F.sum(F.col("source_size") * cap).over(before), F.lit(0))).withColumn(
        "rest", F.sum("w").over(whole) - F.coalesce(F.sum("w").over(before), F.lit(0))
    ).withColumn("level", (F.lit(float(share)) * F.sum("source_size").over(whole) - F.col("full")) / F.col("rest"))
    # the level of the first source that isn't capped holds for all after it
    free = F.col("level") * F.col("w") <= F.col("source_size") * cap
    level = F.first(F.when(free, F.col("level")), ignorenulls=True).over(
        by_level.rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    )
    return left.withColumn("common", level).select(
        "source", "source_size",
        F.when(F.col("common").isNull(), (F.col("source_size") * cap).cast("double"))
        .otherwise(F.least((F.col("source_size") * cap).cast("double"), F.col("common") * F.col("w")))
        .alias("target"),
    )


def route(
    patterns: dict[str, tuple[int, list[str]]], quotas: dict[str, float], repeats: int
) -> dict[tuple[str, str], float]:
    """Min-cost flow of words from patterns to sources. ``patterns`` gives a
    pattern's words and sources. The k-th repetition of a pattern's words costs
    k - 1 a word, which is convex, so the cheapest flow of each amount first
    exhausts the paths through all first copies, then those through second
    ones, and so on; each round is a maximum flow on what the last one left."""
    names = [("in", ""), *(("p", p) for p in patterns), *(("s", s) for s in quotas), ("out", "")]
    index = {name: k for k, name in enumerate(names)}
    ends, room, graph = [], [], defaultdict(list)

    def edge(a: int, b: int, capacity: int) -> int:
        for x, y, c in ((a, b, capacity), (b, a, 0)):
            graph[x].append(len(ends))
            ends.append(y)
            room.append(c)
        return len(ends) - 2

    supply = {p: edge(0, index["p", p], 0) for p in sorted(patterns)}
    ways = {(p, s): edge(index["p", p], index["s", s], sum(quotas.values()))
            for p in sorted(patterns) for s in sorted(patterns[p][1]) if s in quotas}
    for s in sorted(quotas):
        edge(index["s", s], len(names) - 1, quotas[s])
    for _ in range(repeats):
        for p, e in supply.items():
            room[e] += patterns[p][0]
        _fill(graph, ends, room, 0, len(names) - 1)
    return {way: room[e ^ 1] for way, e in ways.items() if room[e ^ 1]}


def _fill(graph: dict, ends: list, room: list, begin: int, goal: int) -> None:
    """Augments along shortest paths, level by level, until no path is left."""
    while True:
        level, queue = {begin: 0}, deque([begin])
        while queue:
            at = queue.popleft()
            for e in graph[at]:
                if room[e] and ends[e] not in level:
                    level[ends[e]] = level[at] + 1
                    queue.append(ends[e])
        if goal not in level:
            return
        nexts = defaultdict(int)
        path: list[int] = []
        at = begin
        while True:
            if at == goal:
                least = min(room[e] for e in path)
                for e in path:
                    room[e] -= least
                    room[e ^ 1] += least
                path, at = [], begin
                continue
            while nexts[at] < len(graph[at]):
                e = graph[at][nexts[at]]
                if room[e] and level.get(ends[e]) == level[at] + 1:
                    path.append(e)
                    at = ends[e]
                    break
                nexts[at] += 1
            else:
                if not path:
                    break
                at = ends[path.pop() ^ 1]
                nexts[at] += 1


def _name(source: Column) -> Column:
    """A key for a source that tells null from every text."""
    return F.when(source.isNull(), F.lit("~")).otherwise(F.concat(F.lit("="), source))


def mix(
    documents: DataFrame, targets: DataFrame, membership: str, size: str, key: str,
    repeats: int = REPEATS, seed: str = SEED,
) -> DataFrame:
    """``documents`` with ``copies`` (how often the mix takes the row), ``taken``
    (copies times size) and ``taken_for`` (the source each copy counts for).

    ``membership`` is an array of the sources a document belongs to, ``targets``
    has ``(source, target)`` in words. Documents are summed up by membership
    pattern, and what each pattern gives to its sources is routed by
    min-cost flow. Within a pattern, documents lie on a line in seeded order,
    once per repetition, and a copy is taken if its middle lies in what the
    pattern gives; so a source misses its target by half a document at most.
    Prefix sums go over 4,096 hash ranges per pattern first, and then within a
    range, so no task sees a whole pattern.

    A row without membership, without size or of a source without a target is
    not taken. Rows with equal keys are placed one after another by size; equal
    rows are alike, so reruns agree. Null keys are placed as one key.
    Columns named copies, taken or taken_for are replaced, all others are carried
    through whatever their names. An empty table gives an empty table.
    """
    own = [c for c in documents.columns if c not in ("copies", "taken", "taken_for")]
    names = F.array_sort(F.array_distinct(F.transform(F.col(membership), _name)))
    digest = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(f"`{key}`").cast("string"), F.lit(""))))
    rows = documents.select(
        F.struct(*[F.col(f"`{c}`") for c in own]).alias("row"),
        F.array_join(F.coalesce(names, F.array()), "\u0001").alias("pattern"),
        F.coalesce(F.col(f"`{size}`").cast("long"), F.lit(0)).alias("size"), digest.alias("place"),
    ).withColumn("range", F.substring("place", 1, 3))
    sums = stage(rows.groupBy("pattern", "range").agg(F.sum("size").alias("words")))
    # what is known of a pattern goes to its ranges, and with them to documents
    before = F.sum("words").over(W.partitionBy("pattern").orderBy("range")) - F.col("words")
    offsets = sums.withColumn("before", before).drop("words").join(_given(sums, targets, repeats), "pattern", "left")
    within = W.partitionBy("pattern", "range").orderBy("place", "size").rowsBetween(W.unboundedPreceding, 0)
    placed = rows.withColumn("within", F.sum("size").over(within) - F.col("size")).join(offsets, ["pattern", "range"])
    turns = F.sequence(F.lit(0), F.lit(repeats - 1))

    def source_of(turn: Column) -> Column:
        middle = turn * F.col("pattern_words") + F.col("before") + F.col("within") + F.col("size") / 2
        return F.filter("parts", lambda p: (p["low"] <= middle) & (middle < p["high"]))

    taken_for = F.flatten(F.transform(turns, lambda t: F.transform(source_of(t), lambda p: p["source"])))
    taken_for = F.when(F.col("parts").isNull(), F.expr("cast(array() as array<string>)")).otherwise(taken_for)
    return placed.select("row", "size", taken_for.alias("sources")).select(
        *[F.col("row")[c].alias(c) for c in own], F.col("sources").alias("taken_for"), F.size("sources").alias("copies"),
        (F.size("sources") * F.col("size")).cast("long").alias("taken"),
    )


def _given(sums: DataFrame, targets: DataFrame, repeats: int) -> DataFrame:
    """``(pattern, pattern_words, parts)``: the piece of a pattern's line
    that goes to each of its sources."""
    spark = sums.sparkSession
    patterns = sums.groupBy("pattern").agg(F.sum("words").alias("pattern_words")).where("pattern <> ''")
    patterns = patterns.withColumn("names", F.split("pattern", "\u0001"))
    quotas = targets.select(_name(F.col("source")).alias("name"), "source", F.col("target").cast("double").alias("target"))
    part_type = "array<struct<source:string,low:double,high:double>>"
    routed, single = patterns, None
    if patterns.limit(MAX_PATTERNS + 1).count() > MAX_PATTERNS:
        routed, single = _apart(patterns, quotas, repeats, part_type)
    found = routed.limit(MAX_PATTERNS + 1).collect()
    if len(found) > MAX_PATTERNS:
        raise ValueError(f"more than {MAX_PATTERNS} overlapping membership patterns")
    # as Arrow, tables of the driver need no Python workers of their own
    names = spark.createDataFrame(pa.table({"name": pa.array(sorted({n for r in found for n in r["names"]}), pa.string())}))
    wanted = {r["name"]: r for r in quotas.join(names, "name").collect()}
    flow = route({r["pattern"]: (r["pattern_words"], list(r["names"])) for r in found},
                 {n: r["target"] for n, r in wanted.items()}, repeats)
    parts: dict[str, list] = defaultdict(list)
    for (pattern, name), words in sorted(flow.items()):
        low = parts[pattern][-1][2] if parts[pattern] else 0.0
        parts[pattern].append((wanted[name]["source"], low, float(low + words)))
    part = pa.struct([("source", pa.string()), ("low", pa.float64()), ("high", pa.float64())])
    own = [[dict(zip(part.names, p, strict=True)) for p in parts[r["pattern"]]] for r in found]
    given = spark.createDataFrame(pa.table({
        "pattern": pa.array([r["pattern"] for r in found], pa.string()),
        "pattern_words": pa.array([r["pattern_words"] for r in found], pa.int64()),
        "parts": pa.array(own, pa.list_(part))}))
    return given if single is None else given.unionByName(single)


def _apart(patterns: DataFrame, quotas: DataFrame, repeats: int, part_type: str) -> tuple[DataFrame, DataFrame]:
    """The patterns that share a source with another, and what the others give:
    with one way for its words, a pattern's cheapest flow is the lesser of target
    and repeated words."""
    per_source = patterns.select(F.explode("names").alias("name"), "pattern").groupBy("name").agg(
        F.count(F.lit(1)).alias("n"))
    alone = patterns.where("size(names) = 1").withColumn("name", F.col("names")[0]).join(
        per_source.where("n = 1").select("name"), "name")
    single = alone.join(quotas, "name").select("pattern", "pattern_words", F.array(F.struct(
        "source", F.lit(0.0).alias("low"), F.least(F.col("target"), F.col("pattern_words") * float(repeats)).alias("high"),
    )).cast(part_type).alias("parts"))
    return patterns.join(alone.select("pattern"), "pattern", "left_anti"), single


def mix_by_source(documents: DataFrame) -> DataFrame:
    """``documents`` with size, source_size, target, copies, taken and taken_for,
    each document a member of its own source (null is a source too). Columns of
    these names are replaced."""
    return mix_sized(documents.withColumn("size", word_count(blank(F.col("text")))))


def mix_sized(documents: DataFrame) -> DataFrame:
    """The same for documents whose ``size`` is known."""
    own = [c for c in documents.columns if c not in ("source_size", "target")]
    row = F.struct(*[F.col(f"`{c}`") for c in own]).alias("row")
    sized = documents.select(row, "doc_id", "source", "size")
    targets = stage(weighted_targets(sized.groupBy("source").agg(F.sum("size").alias("source_size"))))
    mixed = mix(sized.withColumn("membership", F.array("source")), targets, "membership", "size", "doc_id")
    named = targets.select(_name(F.col("source")).alias("name"), "source_size", "target")
    mixed = mixed.withColumn("name", _name(F.col("source"))).join(named, "name")
    return mixed.select(
        *[F.col("row")[c].alias(c) for c in own if c not in ("copies", "taken", "taken_for")],
        "source_size", "target", "copies", "taken", "taken_for")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = read_table(spark, sf_dir, "documents")
    sized = stage(documents.select("doc_id", "source", word_count(blank(F.col("text"))).alias("size")))
    return mix_sized(sized).select("doc_id", "size", "source_size", "target", "taken")


SQL = f"""with docs as (select doc_id, source,
    length(regexp_replace(regexp_replace(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+', 'x', 'g'), '[^x]', '', 'g'))::bigint size,
    md5('{SEED}:' || coalesce(doc_id::varchar, '')) place from documents),
sources as (select source, sum(size)::bigint source_size from docs group by source),
weighted as (select *, [5, 2, 1][(row_number() over (order by source is null, source) - 1) % 3 + 1] w from sources),
levels as (select *, (1.5::double * sum(source_size) over () - coalesce(sum(source_size * 2) over b, 0)::bigint)
    / (sum(w) over () - coalesce(sum(w) over b, 0)) as level,
    row_number() over (order by (source_size * 2) / w::double, w, source is null, source) k from weighted
  window b as (order by (source_size * 2) / w::double, w, source is null, source rows between unbounded preceding and 1 preceding)),
common as (select arg_min(level, k) filter (level * w <= source_size * 2) level from levels),
targets as (select l.source, l.source_size, coalesce(least((source_size * 2)::double, c.level * w), (source_size * 2)::double) target
  from levels l, common c),
placed as (select d.*, t.source_size, t.target, (sum(size) over (partition by d.source order by place, size, doc_id
    rows unbounded preceding) - size) start from docs d join targets t on d.source is not distinct from t.source)
select doc_id, size, source_size, target, (size * ((start + size / 2 < target)::int
  + (source_size + start + size / 2 < target)::int))::bigint taken from placed"""
