"""A Merkle manifest of a dataset, with a proof for every row.

Rows of a group, in order, are the leaves of a tree; the roots of the groups, in
order of the group, are the leaves of the upper tree. While there are several
nodes, every ``fanout`` consecutive ones become the hash of their digests.

Trees are cut into aligned blocks of ``fanout ** levels`` leaves. A block hashes
its own leaves up to one root. Then blocks take part in a butterfly exchange: in
round r the ``fanout`` neighbouring subtrees of ``fanout ** r`` blocks swap their
roots, block by block, and every block hashes the parent for itself. After each
round a block knows the root of a larger subtree, and the digests beside its
way up; nothing is ever sent down. A round is one shuffle of at most ``fanout``
short messages to each block. Where the last subtree has fewer blocks than its
neighbours, its blocks serve several of theirs.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from weblode.llm.common import read_table, remove, scratch_dir, share_code, stage

NAME = "op12_merkle"

FANOUT = 3
#: Levels of a block: 6,561 leaves, about a megabyte of digests.
LEVELS = 8

_STEP = "struct<left string, right string>"


def leaf_digest(*columns: Column) -> Column:
    """Hash of the values: ``-`` for null, else the UTF-8 bytes and ``:`` before
    the value as text."""
    texts = [c.cast("string") for c in columns]
    fields = [F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in texts]
    return F.sha2(F.concat(*fields), 256)


def fold(leaf: Column, path: Column) -> Column:
    """The root to which a leaf leads with the digests beside its way."""
    return F.aggregate(path, leaf, lambda h, step: F.sha2(F.concat(step["left"], h, step["right"]), 256))


def proof_digest(path: Column) -> Column:
    """Hash of all digests beside the way, level by level, left to right."""
    return F.sha2(F.array_join(F.transform(path, lambda step: F.concat(step["left"], step["right"])), ""), 256)


def _hash(digests: list[str]) -> str:
    return hashlib.sha256("".join(digests).encode()).hexdigest()


def _levels_of(leaves: int, fanout: int, levels: int) -> int:
    """Levels that a block climbs: until one node remains if it is all of its
    tree, else as many as any block."""
    if leaves > fanout**levels:
        return levels
    k = 0
    while leaves > 1:
        leaves, k = -(-leaves // fanout), k + 1
    return k


def _ordered(rows: pa.Table) -> pa.Table:
    return rows.combine_chunks().take(pa.array(np.argsort(rows["at"].to_numpy(), kind="stable")))


def _block_root(fanout: int, levels: int) -> Callable[[pa.Table], pa.Table]:
    def run(rows: pa.Table) -> pa.Table:
        rows = _ordered(rows)
        nodes, leaves = rows["digest"].to_pylist(), rows["leaves"][0].as_py()
        for _ in range(_levels_of(leaves, fanout, levels)):
            nodes = [_hash(nodes[j : j + fanout]) for j in range(0, len(nodes), fanout)]
        return pa.table({
            "tree": rows["tree"].slice(0, 1), "block": rows["block"].slice(0, 1),
            "blocks": pa.array([-(-leaves // fanout**levels)], pa.int64()), "root": pa.array(nodes, pa.string()),
        })

    return run


def _block_paths(fanout: int, levels: int) -> Callable[[pa.Table, pa.Table], pa.Table]:
    def run(rows: pa.Table, state: pa.Table) -> pa.Table:
        rows, n = _ordered(rows), len(rows)
        nodes, node = rows["digest"].to_pylist(), np.arange(n)
        lefts, rights = [pa.array([], pa.string())], [pa.array([], pa.string())]
        for _ in range(_levels_of(rows["leaves"][0].as_py(), fanout, levels)):
            first = [j - j % fanout for j in range(len(nodes))]
            left = pa.array(["".join(nodes[f:j]) for j, f in enumerate(first)], pa.string())
            right = pa.array(["".join(nodes[j + 1 : f + fanout]) for j, f in enumerate(first)], pa.string())
            lefts.append(left.take(pa.array(node)))
            rights.append(right.take(pa.array(node)))
            nodes = [_hash(nodes[j : j + fanout]) for j in range(0, len(nodes), fanout)]
            node //= fanout
        for step in state["upper"][0].as_py():
            lefts.append(pa.array([step["left"]] * n, pa.string()))
            rights.append(pa.array([step["right"]] * n, pa.string()))
        depth = len(lefts) - 1
        by_leaf = pa.array(np.arange(depth * n).reshape(depth, n).T.ravel())
        steps = pa.StructArray.from_arrays(
            [pa.concat_arrays(lefts).take(by_leaf), pa.concat_arrays(rights).take(by_leaf)], names=["left", "right"])
        path = pa.ListArray.from_arrays(pa.array(np.arange(n + 1) * depth, pa.int32()), steps)
        same = {c: pa.array([state[c][0].as_py()] * n, pa.string()) for c in ("subroot", "root")}
        return pa.table({"carry": rows["carry"], "leaf": rows["digest"], **same, "path": path})

    return run


def _numbered(leaves: DataFrame, fanout: int, levels: int) -> tuple[DataFrame, str]:
    """Leaves ``(tree, rank, digest, carry)`` as ``(tree, block, at, leaves,
    digest, carry)``: their block, the place in it, and the leaves of the tree.

    A tree may hold most of all rows: leaves are sorted into ranges, counted
    range by range, and numbered within each."""
    spark, places = leaves.sparkSession, [scratch_dir(leaves.sparkSession) for _ in range(3)]
    rows = stage(leaves, places[0])
    ranges = rows.repartitionByRange("tree", "rank", "digest").withColumn("range", F.spark_partition_id())
    placed = stage(ranges, places[1])
    sizes = placed.groupBy("tree", "range").agg(F.count(F.lit(1)).alias("size"))
    tree = Window.partitionBy("tree")
    earlier = tree.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    sizes = sizes.select(
        "tree", "range", F.coalesce(F.sum("size").over(earlier), F.lit(0)).alias("before"),
        F.sum("size").over(tree).alias("leaves"),
    )
    within = Window.partitionBy("tree", "range").orderBy("rank", "digest")
    number = F.row_number().over(within) - 1
    per = fanout**levels
    numbered = placed.withColumn("number", number).join(sizes, ["tree", "range"]).withColumn(
        "number", F.col("number") + F.col("before"))
    out = stage(numbered.select(
        "tree", F.expr(f"number div {per}").alias("block"), F.expr(f"CAST(number % {per} AS int)").alias("at"),
        "leaves", "digest", "carry",
    ), places[2])
    remove(spark, *places[:2])
    return out, places[2]


def _exchange(state: DataFrame, fanout: int, width: int) -> DataFrame:
    """One round of the butterfly among subtrees of ``width`` blocks. Trees that
    have come down to one node are handed on as they are."""
    size = f"least({width}, blocks - {{0}} * {width})"
    state = state.selectExpr("*", f"block div {width} AS node", f"block % {width} AS offset").selectExpr(
        "*", f"node - node % {fanout} AS first", f"(blocks + {width - 1}) div {width} AS nodes")
    targets = F.expr(f"""flatten(transform(sequence(first, least(first + {fanout - 1}, nodes - 1)), i -> CASE
        WHEN i = node THEN array(block)
        WHEN offset < {size.format('i')}
        THEN sequence(i * {width} + offset, i * {width} + {size.format('i')} - 1, {size.format('node')})
        ELSE CAST(array() AS array<bigint>) END))""")
    sent = state.select("tree", "block", "blocks", "node", "root", "upper", F.explode(targets).alias("to"))
    own = F.when(F.col("to") == F.col("block"), F.struct("blocks", "node", "upper"))
    got = sent.groupBy("tree", F.col("to").alias("block")).agg(
        F.array_sort(F.collect_list(F.struct("node", "root"))).alias("got"), F.first(own, ignorenulls=True).alias("own"))
    got = got.select("tree", "block", "got", "own.*")
    digests = "array_join(transform(filter(got, g -> {0}), g -> g.root), '')"
    several = f"blocks > {width}"
    return got.selectExpr(
        "tree", "block", "blocks",
        f"CASE WHEN {several} THEN sha2({digests.format('true')}, 256) ELSE got[0].root END AS root",
        f"""CASE WHEN {several} THEN concat(upper, array(named_struct(
            'left', {digests.format('g.node < node')}, 'right', {digests.format('g.node > node')}))) ELSE upper END AS upper""",
    )


def _butterfly(numbered: DataFrame, fanout: int, levels: int) -> DataFrame:
    """``(tree, block, subroot, upper)``: the root of its tree for every block,
    and the digests beside the block's way up to it."""
    schema = "tree string, block long, blocks long, root string"
    state = numbered.groupBy("tree", "block").applyInArrow(_block_root(fanout, levels), schema)
    state = stage(state.withColumn("upper", F.expr(f"CAST(array() AS array<{_STEP}>)")))
    most, width = state.agg(F.max("blocks")).first()[0] or 0, 1
    while width < most:
        state, width = _exchange(state, fanout, width), width * fanout
    return state.select("tree", "block", F.col("root").alias("subroot"), "upper")


def _proved(numbered: DataFrame, state: DataFrame, fanout: int, levels: int) -> DataFrame:
    """``(carry, leaf, subroot, root, path)`` from the leaves and their blocks' state."""
    schema = StructType([
        StructField("carry", numbered.schema["carry"].dataType),
        *StructType.fromDDL(f"leaf string, subroot string, root string, path array<{_STEP}>"),
    ])
    keys = ["tree", "block"]
    return numbered.groupBy(*keys).cogroup(state.groupBy(*keys)).applyInArrow(_block_paths(fanout, levels), schema)


def manifest(
    rows: DataFrame, leaf: Column, group: Column, order: list[Column], carry: dict[str, Column],
    fanout: int = FANOUT, levels: int = LEVELS,
) -> DataFrame:
    """``(carry…, leaf, subroot, root, path)`` for every row.

    ``leaf`` is the digest of a row, ``group`` (text) names its tree, ``order``
    its place in it, ``carry`` columns to hand on under names of the caller's
    choice, which must not be one of the four. ``path`` has a step per level,
    the lowest first: the digests to the left and to the right of the node, in
    one text each. ``fold(leaf, path)`` is ``root`` again.

    Null groups are a tree of their own, the first one; nulls in ``order`` come
    first. Rows that are equal in ``order`` follow each other by digest, and
    equal rows are leaves of their own. Only the digests are shuffled, so the
    length of texts does not matter. Other columns of ``rows``, whatever their
    names, are not read; an empty table gives an empty result.
    """
    taken = {"leaf", "subroot", "root", "path"} & set(carry)
    if taken:
        raise ValueError(f"carried columns need other names: {sorted(taken)}")
    share_code(rows.sparkSession)
    leaves = rows.select(
        F.coalesce(F.concat(F.lit("="), group), F.lit("")).alias("tree"), F.struct(*order).alias("rank"),
        leaf.alias("digest"), F.struct(*[c.alias(name) for name, c in carry.items()]).alias("carry"),
    )
    numbered, _ = _numbered(leaves, fanout, levels)
    state = stage(_butterfly(numbered, fanout, levels))
    # the roots of the groups are the leaves of the upper tree
    top, _ = _numbered(state.where("block = 0").select(
        F.lit("").alias("tree"), F.struct("tree").alias("rank"), F.col("subroot").alias("digest"),
        F.struct("tree").alias("carry"),
    ), fanout, levels)
    top_state = _butterfly(top, fanout, levels).withColumn("root", F.col("subroot"))
    above = _proved(top, top_state, fanout, levels).select("carry.tree", "root", F.col("path").alias("above"))
    state = state.join(above, "tree").withColumn("upper", F.concat("upper", "above")).drop("above")
    return _proved(numbered, state, fanout, levels).select("carry.*", "leaf", "subroot", "root", "path")


def document_leaf(text: Column) -> Column:
    return leaf_digest(F.col("doc_id"), F.col("source"), F.col("lang"), F.col("n_chars"), text)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with its proof, and what folding a tampered leaf gives."""
    documents = read_table(spark, sf_dir, "documents")
    even = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 2 == 0, F.lit(False))
    tampered = F.when(even, document_leaf(F.replace(F.col("text"), F.lit("\n"), F.lit(""))))
    proved = manifest(
        documents, document_leaf(F.col("text")), F.col("source"), [F.col("doc_id")],
        {"doc_id": F.col("doc_id"), "tampered": tampered},
    )
    folded = proved.select(
        "doc_id", "leaf", "subroot", "root", proof_digest(F.col("path")).alias("proof_sha256"),
        fold(F.coalesce("tampered", "leaf"), F.col("path")).alias("folded_root"),
    )
    return folded.withColumn("verified", F.col("folded_root") == F.col("root"))


_CRC32 = """
    list_reduce(
        list_prepend(4294967295::BIGINT, flatten(list_transform(
            string_split({0}, ''), lambda x: [ascii(x)::BIGINT, -1, -1, -1, -1, -1, -1, -1, -1]))),
        lambda c, e: CASE WHEN e >= 0 THEN xor(c, e) ELSE xor(c >> 1, 3988292384 * (c & 1)) END)"""


def crc32_sql(text: str) -> str:
    """SQL for the unsigned crc32 of an ASCII text that is not empty."""
    return f"xor(({_CRC32.format(text)}), 4294967295)"


def _field(value: str) -> str:
    return f"coalesce(strlen({value}::VARCHAR) || ':' || {value}, '-')"


def _leaf_sql(text: str) -> str:
    return "sha256(" + " || ".join(map(_field, ["doc_id", "source", "lang", "n_chars", text])) + ")"


SQL = f"""
WITH RECURSIVE docs AS (
    SELECT doc_id, {_leaf_sql('text')} AS leaf,
        CASE WHEN {crc32_sql('doc_id::VARCHAR')} % 2 = 0
            THEN {_leaf_sql("replace(text, chr(10), '')")} ELSE {_leaf_sql('text')} END AS tampered,
        coalesce('=' || source, '') AS tree
    FROM documents),
leaves AS (
    SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos,
        count(*) OVER (PARTITION BY tree) AS n
    FROM docs),
low AS (
    SELECT tree, 0 AS level, pos, n, leaf AS h FROM leaves
    UNION ALL
    SELECT tree, level + 1, pos // 3, (n + 2) // 3, sha256(string_agg(h, '' ORDER BY pos))
    FROM low WHERE n > 1 GROUP BY tree, level, pos // 3, n),
subroots AS (
    SELECT tree, h AS subroot, row_number() OVER (ORDER BY tree) - 1 AS place, count(*) OVER () AS trees
    FROM low WHERE n = 1),
high AS (
    SELECT 0 AS level, place AS pos, trees AS n, subroot AS h FROM subroots
    UNION ALL
    SELECT level + 1, pos // 3, (n + 2) // 3, sha256(string_agg(h, '' ORDER BY pos))
    FROM high WHERE n > 1 GROUP BY level, pos // 3, n),
root AS (SELECT h AS root FROM high WHERE n = 1),
low_steps AS (
    SELECT a.tree, a.level, a.pos,
        coalesce(string_agg(b.h, '' ORDER BY b.pos) FILTER (WHERE b.pos < a.pos), '') AS l,
        coalesce(string_agg(b.h, '' ORDER BY b.pos) FILTER (WHERE b.pos > a.pos), '') AS r
    FROM low a JOIN low b ON a.tree = b.tree AND a.level = b.level AND a.pos // 3 = b.pos // 3
    WHERE a.n > 1 GROUP BY a.tree, a.level, a.pos),
high_steps AS (
    SELECT a.level, a.pos,
        coalesce(string_agg(b.h, '' ORDER BY b.pos) FILTER (WHERE b.pos < a.pos), '') AS l,
        coalesce(string_agg(b.h, '' ORDER BY b.pos) FILTER (WHERE b.pos > a.pos), '') AS r
    FROM high a JOIN high b ON a.level = b.level AND a.pos // 3 = b.pos // 3
    WHERE a.n > 1 GROUP BY a.level, a.pos),
climb AS (
    SELECT tree, pos AS id, 0 AS level, pos, tampered AS h, '' AS proof FROM leaves
    UNION ALL
    SELECT c.tree, c.id, c.level + 1, c.pos // 3, sha256(s.l || c.h || s.r), c.proof || s.l || s.r
    FROM climb c JOIN low_steps s ON s.tree = c.tree AND s.level = c.level AND s.pos = c.pos),
ends AS (
    SELECT c.* FROM climb c WHERE NOT EXISTS (
        SELECT 1 FROM low_steps s WHERE s.tree = c.tree AND s.level = c.level AND s.pos = c.pos)),
rise AS (
    SELECT e.tree, e.id, 0 AS level, s.place AS pos, e.h, e.proof FROM ends e JOIN subroots s ON s.tree = e.tree
    UNION ALL
    SELECT c.tree, c.id, c.level + 1, c.pos // 3, sha256(s.l || c.h || s.r), c.proof || s.l || s.r
    FROM rise c JOIN high_steps s ON s.level = c.level AND s.pos = c.pos),
tops AS (
    SELECT c.* FROM rise c WHERE NOT EXISTS (
        SELECT 1 FROM high_steps s WHERE s.level = c.level AND s.pos = c.pos))
SELECT l.doc_id, l.leaf, s.subroot, r.root, sha256(t.proof) AS proof_sha256, t.h AS folded_root, t.h = r.root AS verified
FROM leaves l JOIN subroots s ON s.tree = l.tree JOIN tops t ON t.tree = l.tree AND t.id = l.pos CROSS JOIN root r
"""
