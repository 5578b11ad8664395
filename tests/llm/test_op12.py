"""Merkle manifest: trees and proofs against a plain recursion."""

import hashlib

import pytest
from pyspark.sql import functions as F

from weblode.llm import op12_merkle as op


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def climb(digests, fanout):
    """The root, and the steps of every leaf, lowest first."""
    paths, at, nodes = [[] for _ in digests], list(range(len(digests))), list(digests)
    while len(nodes) > 1:
        for k, j in enumerate(at):
            first = j - j % fanout
            paths[k].append(("".join(nodes[first:j]), "".join(nodes[j + 1 : first + fanout])))
            at[k] = j // fanout
        nodes = [sha("".join(nodes[j : j + fanout])) for j in range(0, len(nodes), fanout)]
    return nodes[0], paths


def expected(rows, fanout):
    """``rows`` are (group, order, digest): the same with subroot, root, path."""
    groups = sorted({g for g, _, _ in rows}, key=lambda g: (g is not None, (g or "").encode()))
    trees = []
    for group in groups:
        own = sorted(((o is not None, o or 0, d) for g, o, d in rows if g == group))
        trees.append((own, *climb([d for _, _, d in own], fanout)))
    root, above = climb([t[1] for t in trees], fanout)
    return sorted(
        repr((group, o if known else None, d, subroot, root, [*path, *up]))
        for group, (own, subroot, paths), up in zip(groups, trees, above, strict=True)
        for (known, o, d), path in zip(own, paths, strict=True)
    )


def proved(df, **how):
    out = op.manifest(df, F.col("digest"), F.col("source"), [F.col("number")],
                      {"source": F.col("source"), "number": F.col("number")}, **how)
    return [(r["source"], r["number"], r["leaf"], r["subroot"], r["root"], [(s["left"], s["right"]) for s in r["path"]])
            for r in out.collect()]


@pytest.mark.parametrize("fanout, levels", [(3, 1), (2, 1), (3, 2), (3, 8)])
def test_blocks_of_all_sizes(spark, fanout, levels):
    """Small blocks, so that trees have many, and the last ones are ragged."""
    rows = [(f"s{size}", k, sha(f"{size} {k}")) for size in (1, 2, 3, 4, 7, 9, 10, 26, 28, 64, 83) for k in range(size)]
    df = spark.createDataFrame(rows, "source string, number long, digest string")
    assert sorted(map(repr, proved(df, fanout=fanout, levels=levels))) == expected(rows, fanout)


def test_nulls_ties_and_repeated_rows(spark):
    rows = [(None, 1, sha("a")), (None, None, sha("b")), ("", 1, sha("c")), ("é", 1, sha("d")), ("z", 1, sha("e")),
            ("z", 1, sha("f")), ("z", 1, sha("f")), ("z", 1, sha("f")), ("z", None, sha("f"))]
    df = spark.createDataFrame(rows, "source string, number long, digest string")
    for name in ("tree", "block", "rank", "carry", "path", "leaf", "root", "at", "range"):
        df = df.withColumn(name, F.lit("clash"))
    assert sorted(map(repr, proved(df, levels=1))) == expected(rows, 3)


def test_empty_table_and_one_row(spark):
    schema = "source string, number long, digest string"
    assert proved(spark.createDataFrame([], schema)) == []
    assert proved(spark.createDataFrame([("x", 1, "00")], schema)) == [("x", 1, "00", "00", "00", [])]


def test_carried_names_that_clash_are_refused(spark):
    with pytest.raises(ValueError, match="root"):
        op.manifest(spark.range(1), F.lit(""), F.lit(""), [F.col("id")], {"root": F.col("id")})


def test_a_changed_leaf_does_not_fold_to_the_root(spark):
    rows = [("a", k, sha(str(k))) for k in range(30)]
    df = spark.createDataFrame(rows, "source string, number long, digest string")
    out = op.manifest(df, F.col("digest"), F.col("source"), [F.col("number")], {"number": F.col("number")}, levels=1)
    got = out.select(
        (op.fold(F.col("leaf"), F.col("path")) == F.col("root")).alias("right"),
        (op.fold(F.sha2("leaf", 256), F.col("path")) == F.col("root")).alias("wrong"),
    ).collect()
    assert all(r["right"] and not r["wrong"] for r in got) and len(got) == 30


def test_leaf_of_nulls_empty_and_long_texts(spark):
    long = "é\n" * 2_000_000
    df = spark.createDataFrame([(1, None), (2, ""), (None, "é"), (3, long)], "id long, text string")
    got = [r[0] for r in df.select(op.leaf_digest(F.col("id"), F.col("text"))).collect()]
    assert got == [sha("1:1-"), sha("1:20:"), sha("-2:é"), sha(f"1:3{3 * 2_000_000}:{long}")]


def test_query_finds_texts_that_were_changed(spark, tmp_path):
    rows = [(k, "t\nu" if k % 3 else "tu", "en", "s" if k % 2 else None, 3) for k in range(40)] + [(None, "a\nb", None, None, None)]
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    spark.createDataFrame(rows, schema).write.parquet(f"{tmp_path}/documents.parquet")
    from zlib import crc32

    for r in op.query(spark, str(tmp_path)).collect():
        k = r["doc_id"]
        changed = k is not None and crc32(str(k).encode()) % 2 == 0 and k % 3
        assert r["verified"] == (not changed) and (r["folded_root"] == r["root"]) == r["verified"]
