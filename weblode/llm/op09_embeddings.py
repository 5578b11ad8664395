"""Near-duplicate embeddings: int8 tile products with error bounds, full
precision only for pairs that may reach the threshold."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weblode.llm.common import mix64, read_table, share_code, stage
from weblode.llm.components import components

NAME = "op9_embeddings"

THRESHOLD = 0.9
#: Vectors of a tile, and rows of it that one product takes.
TILE, STRIP = 4096, 512
#: Vectors that order the others into tiles and bound the angles between tiles.
PIVOTS = 32

_VECTORS = "row long, ok boolean, dim int, f1 long, f2 long, vector binary"


def _unit(vectors: np.ndarray) -> np.ndarray:
    """Rows of length 1 in double precision; scaled first so that squares stay finite."""
    top = np.abs(vectors).max(axis=1, keepdims=True)
    scaled = vectors / top
    return scaled / np.sqrt((scaled * scaled).sum(axis=1, keepdims=True))


def _fingerprints(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        out = {"row": batch["row"], "ok": [], "dim": [], "f1": [], "f2": [], "vector": []}
        for value in batch["embedding"]:
            vector = np.array([], np.float64)
            if value.is_valid and value.values.null_count == 0:
                vector = value.values.to_numpy(zero_copy_only=False).astype(np.float64)
            ok = bool(len(vector)) and bool(np.isfinite(vector).all()) and bool(vector.any())
            bits = (vector + 0.0).view(np.uint64)
            place = np.arange(1, len(bits) + 1, dtype=np.uint64)
            f1 = mix64(bits ^ mix64(place)).sum(dtype=np.uint64)
            f2 = mix64(bits + mix64(place * np.uint64(3))).sum(dtype=np.uint64)
            out["ok"].append(ok)
            out["dim"].append(len(vector))
            out["f1"].append(int(f1.view(np.int64)))
            out["f2"].append(int(f2.view(np.int64)))
            out["vector"].append(vector.tobytes() if ok else None)
        yield pa.RecordBatch.from_arrays(
            [out["row"], pa.array(out["ok"], pa.bool_()), pa.array(out["dim"], pa.int32()),
             pa.array(out["f1"], pa.int64()), pa.array(out["f2"], pa.int64()),
             pa.array(out["vector"], pa.binary())],
            names=list(out),
        )


def _matrix(column: pa.Array, dim: int, kind: type = np.float64) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), kind).reshape(len(column), dim)


def _order(pivots: np.ndarray, dim: int):
    """Adds each vector's nearest pivot and the angle to it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if len(batch):
                cosines = _unit(_matrix(batch["vector"], dim)) @ pivots.T
                nearest = cosines.argmax(axis=1)
                angle = np.arccos(np.clip(cosines.max(axis=1), -1, 1))
                yield pa.RecordBatch.from_arrays(
                    [batch["row"], batch["weight"], batch["vector"],
                     pa.array(nearest.astype(np.int32)), pa.array(angle)],
                    names=["row", "weight", "vector", "pivot", "angle"],
                )

    return run


def _tiles(pivots: np.ndarray, dim: int):
    """One row per tile of at most ``TILE`` vectors, in the order they come in."""

    def row(ids: list, weights: list, vectors: list) -> pa.RecordBatch:
        exact = np.frombuffer(b"".join(vectors), np.float64).reshape(len(ids), dim)
        unit = _unit(exact)
        scale = np.abs(unit).max(axis=1) / 127
        codes = np.rint(unit / scale[:, None]).astype(np.int8)
        # the length of what the codes leave out, rounded up
        error = np.sqrt(((unit - codes * scale[:, None]) ** 2).sum(axis=1)) * (1 + 1e-9) + 1e-12
        angles = np.arccos(np.clip(unit @ pivots.T, -1, 1))
        return pa.RecordBatch.from_arrays(
            [pa.array([len(ids)], pa.int32()), *(
                pa.array([x.tobytes()], pa.binary()) for x in (
                    np.array(ids, np.int64), np.array(weights, np.int64), codes, scale, error, unit)),
             pa.array([angles.min(axis=0).tolist()], pa.list_(pa.float64())),
             pa.array([angles.max(axis=0).tolist()], pa.list_(pa.float64()))],
            names=["n", "ids", "weights", "codes", "scale", "error", "unit", "low", "high"],
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, weights, vectors = [], [], []
        for batch in batches:
            ids += batch["row"].to_pylist()
            weights += batch["weight"].to_pylist()
            vectors += batch["vector"].to_pylist()
            while len(ids) >= 2 * TILE:
                yield row(ids[:TILE], weights[:TILE], vectors[:TILE])
                ids, weights, vectors = ids[TILE:], weights[TILE:], vectors[TILE:]
        half = len(ids) // 2 if len(ids) > TILE else len(ids)
        for part in (slice(0, half), slice(half, None)):
            if ids[part]:
                yield row(ids[part], weights[part], vectors[part])

    return run


def _linked(one: dict, two: dict, same: bool, dim: int, threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """Positions of linked pairs of two tiles. For unit x = s·q + e the product
    of two vectors differs from s·s'·q·q' by at most |e| + |e'| + 3·|e|·|e'|,
    so only pairs within that bound of the threshold are computed in full."""
    first, second = [], []
    codes = two["codes"].astype(np.float32 if dim <= 1000 else np.float64)
    worst = two["error"].max()
    for low in range(0, one["n"], STRIP):
        part = slice(low, min(low + STRIP, one["n"]))
        start = low if same else 0
        products = one["codes"][part].astype(codes.dtype) @ codes[start:].T
        products *= two["scale"][start:].astype(codes.dtype)
        error, scale = one["error"][part], one["scale"][part]
        bound = (threshold - error - worst - 3 * error * worst - 1e-6) / scale
        bound -= np.abs(bound) * 1e-6
        a, b = np.nonzero(products >= bound[:, None].astype(codes.dtype))
        a, b = a + low, b + start
        if same:
            a, b = a[a < b], b[a < b]
        for k in range(0, len(a), 1 << 16):
            x, y = a[k : k + (1 << 16)], b[k : k + (1 << 16)]
            yes = np.einsum("ij,ij->i", one["unit"][x], two["unit"][y]) >= threshold
            first.append(x[yes])
            second.append(y[yes])
    nothing = np.zeros(0, np.int64)
    return np.concatenate([nothing, *first]), np.concatenate([nothing, *second])


def _forest(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The least position reachable from each of ``n`` positions."""
    label = np.arange(n)
    while True:
        new = label.copy()
        np.minimum.at(new, a, label[b])
        np.minimum.at(new, b, new[a])
        new = new[new]
        if (new == label).all():
            return label
        label = new


def _compare(dim: int, threshold: float):
    kinds = {"ids": np.int64, "weights": np.int64, "codes": np.int8, "scale": np.float64,
             "error": np.float64, "unit": np.float64}

    def tile(batch: pa.RecordBatch, k: int, side: str) -> dict:
        out = {c: np.frombuffer(batch[f"{c}_{side}"][k].as_py(), kind) for c, kind in kinds.items()}
        out["n"] = len(out["ids"])
        out["codes"], out["unit"] = out["codes"].reshape(-1, dim), out["unit"].reshape(-1, dim)
        return out

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(len(batch)):
                same = batch["i"][k].as_py() == batch["j"][k].as_py()
                one, two = tile(batch, k, "i"), tile(batch, k, "j")
                a, b = _linked(one, two, same, dim, threshold)
                if not same:
                    b = b + one["n"]
                    both = {c: np.concatenate([one[c], two[c]]) for c in ("ids", "weights")}
                else:
                    both = one
                n = len(both["ids"])
                links = np.bincount(a, both["weights"][b], n) + np.bincount(b, both["weights"][a], n)
                root = _forest(n, a, b)
                some = np.flatnonzero(links)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(both["ids"][some]), pa.array(links[some].astype(np.int64)),
                     pa.array(both["ids"][root[some]])],
                    names=["row", "links", "near"],
                )

    return run


def link_embeddings(
    vectors: DataFrame, embedding: str = "embedding", key: str = "vec_id", threshold: float = THRESHOLD
) -> DataFrame:
    """``(key, n_links, component_id)``, one row per row of ``vectors``.

    Vectors with a cosine of at least ``threshold`` (above 0) are linked; the component is the
    smallest key reachable. Equal vectors become one with a weight, so a hot
    vector costs one row. The others are ordered by their nearest pivot, cut
    into tiles, and every pair of tiles that the angles to the pivots don't
    exclude is multiplied; what a tile pair returns is a count and one link per
    vector, never all pairs. The work is quadratic in the number of tiles that
    lie within the angle of each other.

    Null, empty, zero or non-finite vectors, and vectors with null components,
    link with nothing; vectors of unlike length don't link. Rows with equal or
    null keys are vectors of their own. Other columns are not read. An empty
    table gives an empty table.
    """
    spark = vectors.sparkSession
    share_code(spark)
    rows = stage(
        vectors.select(F.col(f"`{key}`").alias("key"), F.col(f"`{embedding}`").cast("array<double>").alias("embedding"))
        .withColumn("row", F.monotonically_increasing_id())
    )
    prints = stage(rows.select("row", "embedding").mapInArrow(_fingerprints, _VECTORS))
    groups = prints.where("ok").groupBy("dim", "f1", "f2").agg(
        F.min("row").alias("rep"), F.count(F.lit(1)).alias("weight")
    )
    reps = stage(
        prints.join(groups.select(F.col("rep").alias("row"), "weight"), "row").select("row", "dim", "weight", "vector")
    )
    found = None
    sizes = reps.groupBy("dim").count().collect()  # one row per vector length
    for dim, count in ((r["dim"], r["count"]) for r in sizes):
        part = _link_length(spark, reps.where(F.col("dim") == dim), dim, count, threshold)
        found = part if found is None else found.unionByName(part)
    if found is None:
        found = spark.createDataFrame([], "row long, links long, near long")
    links = found.groupBy("row").agg(F.sum("links").alias("links"))
    nodes = components(found.select(F.col("row").alias("a"), F.col("near").alias("b")))
    of_rep = (
        groups.withColumnRenamed("rep", "row").join(links, "row", "left")
        .join(nodes.withColumnRenamed("node", "row"), "row", "left")
        .select("dim", "f1", "f2", (F.coalesce("links", F.lit(0)) + F.col("weight") - 1).alias("n_links"),
                F.coalesce("component", "row").alias("component"))
    )
    keyed = stage(
        rows.select("row", "key").join(prints.select("row", "ok", "dim", "f1", "f2"), "row")
        .join(of_rep.withColumn("ok", F.lit(True)), ["ok", "dim", "f1", "f2"], "left")
        .select("key", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), "component")
    )
    least = keyed.where("component is not null").groupBy("component").agg(F.min("key").alias("least"))
    return keyed.join(least, "component", "left").select(
        F.col("key").alias(key), "n_links", F.coalesce("least", "key").alias("component_id")
    )


def _link_length(spark: SparkSession, reps: DataFrame, dim: int, count: int, threshold: float) -> DataFrame:
    sample = reps.orderBy(F.xxhash64("row")).limit(PIVOTS).select("vector").collect()
    pivots = _unit(np.frombuffer(b"".join(bytes(r["vector"]) for r in sample), np.float64).reshape(-1, dim))
    n_tiles = max(1, math.ceil(count / TILE))
    ordered = reps.select("row", "weight", "vector").mapInArrow(
        _order(pivots, dim), "row long, weight long, vector binary, pivot int, angle double"
    )
    tiles = stage(
        ordered.repartitionByRange(n_tiles, "pivot", "angle", "row").sortWithinPartitions("pivot", "angle", "row")
        .mapInArrow(_tiles(pivots, dim), "n int, ids binary, weights binary, codes binary, scale binary, "
                    "error binary, unit binary, low array<double>, high array<double>")
        .withColumn("tile", F.monotonically_increasing_id())
    )
    # tiles are numbered in turn; the table of numbers has one row per tile
    numbers = [r["tile"] for r in tiles.select("tile").orderBy("tile").collect()]
    order = spark.createDataFrame([(t, k) for k, t in enumerate(numbers)], "tile long, at int")
    meta = stage(tiles.select("tile", "low", "high").join(order, "tile"))
    reach = math.acos(threshold) + 1e-9
    apart = (
        f"exists(arrays_zip(low_i, high_i, low_j, high_j), "
        f"x -> x.low_i - x.high_j > {reach!r} or x.low_j - x.high_i > {reach!r})"
    )
    one = meta.select(F.col("at").alias("i"), F.col("low").alias("low_i"), F.col("high").alias("high_i"))
    two = meta.select(F.col("at").alias("j"), F.col("low").alias("low_j"), F.col("high").alias("high_j"))
    pairs = (
        one.withColumn("j", F.explode(F.sequence("i", F.lit(len(numbers) - 1)))).join(two, "j")
        .where(f"not {apart}").select("i", "j")
    )
    columns = ("ids", "weights", "codes", "scale", "error", "unit")
    side = lambda s: tiles.join(order, "tile").select(
        F.col("at").alias(s), *[F.col(c).alias(f"{c}_{s}") for c in columns])
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "4")  # a row is two tiles
    try:
        return stage(
            pairs.join(side("i"), "i").join(side("j"), "j")
            .mapInArrow(_compare(dim, threshold), "row long, links long, near long")
        )
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = link_embeddings(read_table(spark, sf_dir, "embeddings"))
    return found.withColumn("kept", F.col("vec_id") == F.col("component_id"))


SQL = """with recursive good as (
  select vec_id, embedding::double[] as v from embeddings
  where embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
    and len(list_filter(embedding, lambda x: x <> 0)) > 0),
unit as (select vec_id, list_transform(v, lambda x: x / sqrt(list_dot_product(v, v))) v from good),
links as (select a.vec_id a, b.vec_id b from unit a join unit b
  on a.vec_id <> b.vec_id and len(a.v) = len(b.v) where list_dot_product(a.v, b.v) >= 0.9),
reach as (select vec_id node, vec_id other from embeddings
  union select r.node, l.b from reach r join links l on r.other = l.a),
component as (select node, min(other) component_id from reach group by node)
select e.vec_id, (select count(*) from links l where l.a = e.vec_id) n_links, c.component_id,
  e.vec_id = c.component_id kept
from embeddings e join component c on e.vec_id = c.node"""
