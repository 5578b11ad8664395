"""N-gram Jaccard join: size-banded tiles of documents that share a rare
shingle, bitmap signatures that bound the overlap, then exact intersections."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from weblode.llm.common import (
    arrow_batches, blank, mix64, read_table, remove, scratch_dir, slices, stage, text_buffer,
)
from weblode.llm.components import components
from weblode.llm.words import SPACED, find_words, hash_words

NAME = "op2_jaccard"

#: Words of a shingle. Two sets link if 100 * common >= 75 * all.
SHINGLE = 5
#: A shingle of so many sets counts as frequent. Frequent ones come last in the
#: order, so tiles are made of rare ones. They are told by a filter of a fixed
#: size; a shingle that it takes for frequent by mistake only changes the order.
FREQUENT = 24
#: Rows of a tile that one task compares at a time; larger tiles are dealt out.
TILE = 2048
#: Of up to so many sets with a shingle, pairs come first, bands and signatures
#: later, once for each pair: sets with a passage in common share many shingles.
SMALL = 8
#: Shingles of one local count of frequent ones.
COUNT_BLOCK = 4 << 20

_TOP = np.uint64(1 << 63)


# --- shingle sets ------------------------------------------------------------


def shingle_sets(raw: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct 63-bit shingle hashes of each text, ascending, and where each
    text's begin. Fewer words than a shingle are one shingle; none are none."""
    words = find_words(raw, at, SPACED)
    h = hash_words(raw, words.start, words.end)
    count = np.diff(words.first)
    n_shingles = np.where(count == 0, 0, np.maximum(count - SHINGLE + 1, 1))
    first = np.zeros(len(count) + 1, np.int64)
    np.cumsum(n_shingles, out=first[1:])
    start = np.arange(first[-1]) + np.repeat(words.first[:-1] - first[:-1], n_shingles)
    size = np.repeat(np.minimum(count, SHINGLE), n_shingles)
    out = np.zeros(len(start), np.uint64)
    for k in range(SHINGLE):
        part = h[np.minimum(start + k, len(h) - 1)] if len(h) else h
        out = np.where(k < size, mix64(out + part + np.uint64(k + 1)), out)
    out >>= np.uint64(1)
    for r in np.flatnonzero(n_shingles > 1).tolist():
        out[first[r] : first[r + 1]].sort()
    new = np.ones(len(out), bool)
    new[1:] = out[1:] != out[:-1]
    heads = first[:-1][n_shingles > 0]
    new[heads] = True
    kept = np.zeros(len(out) + 1, np.int64)
    np.cumsum(new, out=kept[1:])
    return out[new], kept[first]


def set_ids(hashes: np.ndarray, first: np.ndarray) -> np.ndarray:
    """One number for each set: equal sets have equal numbers, and unlike ones
    share one with a chance of one in 2^64."""
    sums = np.zeros(len(hashes) + 1, np.uint64)
    np.cumsum(mix64(hashes), out=sums[1:])
    return mix64(sums[first[1:]] - sums[first[:-1]] + np.diff(first).astype(np.uint64)).view(np.int64)


def _parts(batches: Iterator[pa.RecordBatch], column: str = "text"):
    for batch in batches:
        raw, at = text_buffer(batch[column])
        for low, high in slices(at):
            hashes, first = shingle_sets(raw[at[low] : at[high]], at[low : high + 1] - at[low])
            yield batch.slice(low, high - low), hashes, first


def _profile(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row per document with its set, the first with its signature, and a row
    with the count of each shingle that several sets of a block have."""
    seen: set[int] = set()
    block: list[np.ndarray] = []
    size = 0

    def frequent() -> pa.RecordBatch:
        values, counts = np.unique(np.concatenate([np.zeros(0, np.uint64), *block]), return_counts=True)
        often = counts >= 2
        k = int(often.sum())
        nothing = [None] * k
        return _rows(nothing, nothing, nothing, values[often].view(np.int64), counts[often], nothing)

    for part, hashes, first in _parts(batches):
        ids = set_ids(hashes, first)
        n = np.diff(first)
        bits: list = [None] * len(part)
        for r in np.flatnonzero(n).tolist():
            if (own := int(ids[r])) not in seen:
                seen.add(own)
                block.append(hashes[first[r] : first[r + 1]])
                bits[r] = signature(block[-1])
                size += int(n[r])
        yield _rows(part["key"], part["print"], n, ids, [None] * len(part), bits)
        if size >= COUNT_BLOCK:
            yield frequent()
            block, size = [], 0
    yield frequent()


def _rows(key, prints, n, value, count, bits) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(key, pa.int64()), pa.array(prints, pa.int64()), pa.array(n, pa.int64()),
         pa.array(value, pa.int64()), pa.array(count, pa.int64()), pa.array(bits, pa.binary())],
        names=["key", "print", "n", "value", "count", "bits"],
    )


# --- tiles -------------------------------------------------------------------


def prefix(n: np.ndarray) -> np.ndarray:
    """How many of the first shingles of a set of ``n`` hold one that is common
    with any linked set: of at least 3/4 of its size, so 3/4 are common."""
    return n - -(-n * 3 // 4) + 1


def reach(n: np.ndarray, place: np.ndarray) -> np.ndarray:
    """The largest linked set for which the shingle at ``place`` (from 0) may be
    the first common one: with a set of m, ceil(3 (n + m) / 7) are common, so
    one of them is among the first n - ceil(3 (n + m) / 7) + 1."""
    return (7 * (n - place) - 3 * n) // 3


def _postings(frequent):
    """The prefix shingles of each set, rare ones first: (shingle, set, size,
    size of the largest partner)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        often = frequent.value
        seen: set[int] = set()
        for _, hashes, first in _parts(batches):
            ids, n = set_ids(hashes, first), np.diff(first)
            key = _ranked(hashes, often)
            new = np.zeros(len(n), bool)
            for r in np.flatnonzero(n).tolist():
                if (own := int(ids[r])) not in seen:
                    seen.add(own)
                    new[r] = True
                    key[first[r] : first[r + 1]].sort()
            rows = np.flatnonzero(new)
            long_ = prefix(n[rows])
            within = np.arange(long_.sum()) - np.repeat(np.cumsum(long_) - long_, long_)
            at = np.repeat(first[rows], long_) + within
            yield pa.RecordBatch.from_arrays(
                [pa.array((key[at] & ~_TOP).view(np.int64)), pa.array(np.repeat(ids[rows], long_)),
                 pa.array(np.repeat(n[rows], long_)), pa.array(reach(np.repeat(n[rows], long_), within))],
                names=["shingle", "set", "n", "reach"],
            )

    return run


def _ranked(hashes: np.ndarray, often: np.ndarray) -> np.ndarray:
    return np.where(_may_hold(often, hashes), hashes | _TOP, hashes)


def _shared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of rows sorted by shingle and set, those whose shingle more than one set
    has, each once. One row is carried from batch to batch."""
    carry, given = None, False
    for batch in batches:
        if not len(batch):
            continue
        if carry is not None:
            batch = pa.Table.from_batches([carry, batch]).combine_chunks().to_batches()[0]
        shingle, of = batch["shingle"].to_numpy(), batch["set"].to_numpy()
        fresh = np.r_[True, (shingle[1:] != shingle[:-1]) | (of[1:] != of[:-1])]
        batch, shingle = batch.filter(pa.array(fresh)), shingle[fresh]
        same = shingle[1:] == shingle[:-1]
        shared = np.r_[same, False] | np.r_[False, same]
        give = shared.copy()
        if given:
            give[0] = False
        yield batch.filter(pa.array(give))
        given = bool(shared[-1]) or (len(batch) == 1 and given)
        carry = batch.slice(len(batch) - 1, 1)


def _band(n: Column) -> Column:
    """Sizes of linked sets are in the same band or in the next."""
    return F.floor(F.log(n) / F.lit(math.log(1.34))).cast("int")


def _members(tiles: DataFrame) -> DataFrame:
    """Rows by tile: a shingle and the band of the smaller set of a pair. A set
    is in the tile of its band, and in the one below as a larger partner."""
    own = tiles.withColumn("own", _band(F.col("n")))
    return own.withColumn("band", F.explode(F.array(F.col("own"), F.col("own") - 1))).withColumn(
        "home", F.col("own") == F.col("band")).drop("own")


def _fits() -> Column:
    """Whether the sizes of two sets allow a link at all."""
    return F.least("n_a", "n_b") * 4 >= F.greatest("n_a", "n_b") * 3


def _stars(tiles: DataFrame) -> DataFrame:
    """A pair for each set: with the hub that it shares most tiles with. A
    tile's hub is the set of which most of the first shingles are shared, as
    of an original with many altered copies."""
    shared = tiles.groupBy("set").agg((F.count(F.lit(1)) / F.first("n")).alias("shared"))
    rated = tiles.select("shingle", "set", "n").join(shared, "set")
    hubs = rated.groupBy("shingle").agg(F.max(F.struct("shared", "set", "n")).alias("hub"))
    pairs = rated.join(hubs, "shingle").select(
        "set", F.col("n").alias("n_a"), F.col("hub.set").alias("hub"), F.col("hub.n").alias("n_b")
    ).where("set <> hub").where(_fits())
    best = pairs.groupBy("set", "hub").count().groupBy("set").agg(F.max_by("hub", F.struct("count", "hub")).alias("hub"))
    return best.select(F.greatest("set", "hub").alias("a"), F.least("set", "hub").alias("b")).distinct()


def _whole_groups(
    batches: Iterator[pa.RecordBatch], columns: list[str], apart: bool = True
) -> Iterator[list[pa.Table]]:
    """Groups of equal ``columns`` of sorted rows, whole; each by itself, or
    not ``apart``, all that are at hand in one table."""
    rest: pa.Table | None = None
    for batch in batches:
        table = pa.Table.from_batches([batch])
        table = table if rest is None else pa.concat_tables([rest, table]).combine_chunks()
        if not len(table):
            continue
        keys = [table[c].to_numpy() for c in columns]
        new = np.zeros(len(table), bool)
        new[0] = True
        for key in keys:
            new[1:] |= key[1:] != key[:-1]
        starts = np.flatnonzero(new)
        if apart:
            yield [table.slice(a, b - a) for a, b in zip(starts[:-1].tolist(), starts[1:].tolist(), strict=True)]
        elif starts[-1]:
            yield [table.slice(0, int(starts[-1]))]
        rest = table.slice(int(starts[-1]))
    if rest is not None and len(rest):
        yield [rest]


# --- signatures and exact sets -----------------------------------------------


def signature(hashes: np.ndarray) -> bytes:
    """Parities of the hashes by their low bits, at least twice as many bits as
    hashes. Two signatures differ in no more bits than their sets in elements."""
    width = max(64, 2 << int(len(hashes) - 1).bit_length())
    odd = np.bincount((hashes & np.uint64(width - 1)).astype(np.int64), minlength=width) & 1
    return np.packbits(odd.astype(bool), bitorder="little").tobytes()


def _folded(bits: bytes, size: int) -> np.ndarray:
    out = np.frombuffer(bits, np.uint8)
    while len(out) > size:
        out = out[: len(out) // 2] ^ out[len(out) // 2 :]
    return out.view(np.uint64)


def _sets(bloom):
    """The hashes of the sets that the filter may hold."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = bloom.value
        seen: set[int] = set()
        for _, hashes, first in _parts(batches):
            ids, n = set_ids(hashes, first), np.diff(first)
            maybe = (n > 0) & _may_hold(words, ids.view(np.uint64))
            kept, values = [], []
            for r in np.flatnonzero(maybe).tolist():
                if (own := int(ids[r])) not in seen:
                    seen.add(own)
                    kept.append(own)
                    values.append(hashes[first[r] : first[r + 1]].tobytes())
            yield pa.RecordBatch.from_arrays(
                [pa.array(kept, pa.int64()), pa.array(values, pa.binary())], names=["set", "hashes"])

    return run


#: Bits of a filter that goes to the executors, whatever the input.
BLOOM = 1 << 26


def _may_hold(words: np.ndarray, numbers: np.ndarray) -> np.ndarray:
    """Whether the filter has both places of a number set, from its low and its
    high part."""
    out = np.ones(len(numbers), bool)
    for shift in (0, 32):
        place = (numbers >> np.uint64(shift)) & np.uint64(BLOOM - 1)
        out &= (words[(place >> np.uint64(6)).astype(np.int64)] >> (place & np.uint64(63))) & np.uint64(1) == 1
    return out


def _bloom(numbers: DataFrame) -> np.ndarray:
    """The filter of a column of distinct numbers; the driver gets its words,
    at most BLOOM / 64 of them."""
    low, high = (F.shiftright(numbers.columns[0], k).bitwiseAND(F.lit(BLOOM - 1)) for k in (0, 32))
    words = numbers.select(F.explode(F.array(low, high)).alias("p")).groupBy(
        F.shiftright("p", 6).alias("w")).agg(F.bit_or(F.expr("shiftleft(1L, int(p & 63))")).alias("bits"))
    found = words.toArrow()
    out = np.zeros(BLOOM >> 6, np.int64)
    out[found["w"].to_numpy()] = found["bits"].to_numpy()
    return out.view(np.uint64)


def _bounded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        keep = []
        for x, y, n_a, n_b in zip(*(batch[c].to_pylist() for c in ("bits_a", "bits_b", "n_a", "n_b")), strict=True):
            size = min(len(x), len(y))
            apart = int(np.bitwise_count(_folded(x, size) ^ _folded(y, size)).sum())
            keep.append(7 * apart <= n_a + n_b)
        yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))


def _exact(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        keep = []
        for x, y in zip(batch["hashes_a"].to_pylist(), batch["hashes_b"].to_pylist(), strict=True):
            one, two = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
            common = len(np.intersect1d(one, two, assume_unique=True))
            keep.append(100 * common >= 75 * (len(one) + len(two) - common))
        yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))


def _with_sets(pairs: DataFrame, sets: DataFrame, columns: tuple[str, ...]) -> DataFrame:
    for side in ("a", "b"):
        pairs = pairs.join(
            sets.select(F.col("set").alias(side), *[F.col(c).alias(f"{c}_{side}") for c in columns]), side)
    return pairs


def _exact_links(words: DataFrame, pairs: DataFrame) -> DataFrame:
    """The pairs that link, by the exact sets; these are made from the texts
    once more, only for documents that occur in a pair."""
    candidates = pairs.select(F.explode(F.array("a", "b")).alias("set")).distinct()
    sent = words.sparkSession.sparkContext.broadcast(_bloom(candidates))
    sets = words.select("text").mapInArrow(_sets(sent), "set long, hashes binary")
    place = scratch_dir(words.sparkSession)
    sets = stage(sets.join(candidates, "set", "left_semi").dropDuplicates(["set"]), place)
    links = stage(_with_sets(pairs, sets, ("hashes",)).mapInArrow(_exact, "a long, b long"))
    remove(words.sparkSession, place)
    return links


def _compared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pairs of a tile (or of two parts of one) that belong to different
    components so far and that sizes and signatures allow."""
    for groups in _whole_groups(batches, ["shingle", "band", "one", "two"]):
        first, second = [], []
        for group in groups:
            a, b = _pairs_of(group)
            first.append(a)
            second.append(b)
        nothing = np.zeros(0, np.int64)
        a, b = np.concatenate([nothing, *first]), np.concatenate([nothing, *second])
        both = np.unique(np.stack([np.maximum(a, b), np.minimum(a, b)]), axis=1)
        yield pa.RecordBatch.from_arrays([pa.array(both[0]), pa.array(both[1])], names=["a", "b"])


def _paired(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pairs of sets of a few that share a shingle, by sizes alone. Rows are
    sorted by shingle, so a partner is at most ``SMALL`` - 1 rows further on."""
    for groups in _whole_groups(batches, ["shingle"], apart=False):
        shingle, of, n, most, component = (
            groups[0][c].to_numpy() for c in ("shingle", "set", "n", "reach", "component"))
        first, second = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        for by in range(1, min(SMALL, len(of))):
            i, j = slice(None, -by), slice(by, None)
            fit = (shingle[i] == shingle[j]) & (component[i] != component[j])
            fit &= (n[j] <= most[i]) & (n[i] <= most[j])
            first.append(of[i][fit])
            second.append(of[j][fit])
        a, b = np.concatenate(first), np.concatenate(second)
        both = np.unique(np.stack([np.maximum(a, b), np.minimum(a, b)]), axis=1)
        yield pa.RecordBatch.from_arrays([pa.array(both[0]), pa.array(both[1])], names=["a", "b"])


def _pairs_of(group: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    of, n, component, most, home, part = (
        group[c].to_numpy() for c in ("set", "n", "component", "reach", "home", "part"))
    signatures = group["bits"].to_pylist()
    size = min(map(len, signatures))
    bits = np.stack([_folded(x, size) for x in signatures])
    across = group["one"][0] != group["two"][0]
    first, second = [], []
    for low in range(0, len(of), 256):
        rows = slice(low, low + 256)
        i, j = n[rows, None], n[None, :]
        fit = (j <= most[rows, None]) & (i <= most[None, :]) & (component[rows, None] != component[None, :])
        fit &= (of[rows, None] < of[None, :]) & (home[rows, None] | home[None, :])
        if across:
            fit &= part[rows, None] != part[None, :]
        x, y = np.nonzero(fit)
        for k in range(0, len(x), 1 << 16):
            p, q = x[k : k + (1 << 16)] + low, y[k : k + (1 << 16)]
            apart = np.bitwise_count(bits[p] ^ bits[q]).sum(axis=1, dtype=np.int64)
            near = 7 * apart <= n[p] + n[q]
            first.append(of[p[near]])
            second.append(of[q[near]])
    nothing = np.zeros(0, np.int64)
    return np.concatenate([nothing, *first]), np.concatenate([nothing, *second])


def _open(rows: DataFrame, keys: list[str]) -> DataFrame:
    """Rows of groups that hold more than one component, with their number;
    only such that reach the smallest set of the group."""
    groups = rows.groupBy(*keys).agg(
        F.min("component").alias("least"), F.max("component").alias("most"), F.count(F.lit(1)).alias("rows"),
        F.min("n").alias("smallest"))
    found = rows.join(groups.where("least <> most").select(*keys, "rows", "smallest"), keys)
    return found.where("reach >= smallest").drop("smallest")


def _residual(apart: DataFrame, signs: DataFrame) -> DataFrame:
    """Pairs across components that signatures allow. A tile of many rows is
    dealt out by pairs of its parts, so a task holds two parts at most."""
    small = (
        apart.where(F.col("rows") <= SMALL).drop("rows").repartition("shingle").sortWithinPartitions("shingle")
        .mapInArrow(_paired, "a long, b long").distinct()
    )
    small = _with_sets(small, signs, ("bits", "n")).mapInArrow(_bounded, "a long, b long")
    members = _open(_members(apart.where(F.col("rows") > SMALL).drop("rows")), ["shingle", "band"])
    parts = F.greatest(F.ceil(F.col("rows") / TILE), F.lit(1)).cast("int")
    part = F.pmod(F.xxhash64("set"), parts).cast("int")
    dealt = (
        members.withColumn("parts", parts).withColumn("part", part)
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
        .withColumn("one", F.least("part", "other")).withColumn("two", F.greatest("part", "other"))
    )
    keys = ["shingle", "band", "one", "two"]
    large = (
        dealt.join(signs.select("set", "bits"), "set")
        .select(*keys, "set", "n", "reach", "home", "component", "part", "bits")
        .repartition(*keys).sortWithinPartitions(*keys)
        .mapInArrow(_compared, "a long, b long").distinct()
    )
    return small.unionByName(large)


# --- the operator ------------------------------------------------------------


def jaccard_groups(documents: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``(key, print, n_shingles, component_id, group)``, one row per document.

    Sets are the distinct 5-word shingles of a whole text, as 63-bit hashes;
    two documents link if 100 times the common shingles are at least 75 times
    all of theirs. Equal sets become one. A linked pair shares one of the first
    shingles of both, rare ones first, so the sets with a common one, and of
    sizes of one band, form a tile. First each set is compared with one hub,
    an original if there is one; then, in each tile, all that is still apart
    with each other; both by signatures before exact sets. Whatever order or partitions, the links' components come out alike.

    Texts without words (null, empty) have no shingles and stand alone. Rows
    with equal or null keys are documents of their own; the component is the
    smallest key reachable, null only if all keys there are null. ``print`` is
    a hash of the text, ``group`` a number of the component that does not depend
    on keys, null without shingles. Other columns are not read; an empty table gives an
    empty table.
    """
    spark = documents.sparkSession
    arrow_batches(spark)
    words = documents.select(
        F.col(f"`{key}`").cast("long").alias("key"), F.xxhash64(F.col(f"`{text}`")).alias("print"),
        blank(F.col(f"`{text}`")).alias("text"))
    profile = stage(words.mapInArrow(_profile, "key long, print long, n long, value long, count long, "
        "bits binary"))
    own = profile.where("n is not null").withColumnRenamed("value", "set")
    links = _links(spark, words, profile)
    roots = components(links).withColumnRenamed("node", "set")
    rooted = own.join(roots, "set", "left").select(
        "key", "print", "n", F.when(F.col("n") > 0, F.coalesce("component", "set")).alias("root"))
    least = rooted.where("root is not null").groupBy("root").agg(F.min("key").alias("least"))
    return rooted.join(least, "root", "left").select(
        F.col("key").alias(key), "print", F.col("n").alias("n_shingles"),
        F.coalesce("least", "key").alias("component_id"), F.col("root").alias("group"))


def _links(spark: SparkSession, words: DataFrame, profile: DataFrame) -> DataFrame:
    often = profile.where("n is null").groupBy("value").agg(F.sum("count").alias("n")).where(
        F.col("n") >= FREQUENT).select("value")
    frequent = spark.sparkContext.broadcast(_bloom(often))
    schema = "shingle long, set long, n long, reach long"
    postings = words.select("text").mapInArrow(_postings(frequent), schema)
    tiles_place = scratch_dir(spark)
    tiles = stage(
        postings.repartition("shingle").sortWithinPartitions("shingle", "set")
        .mapInArrow(_shared, schema), tiles_place)
    signs = stage(profile.where("bits is not null").select(
        F.col("value").alias("set"), "n", "bits").dropDuplicates(["set"]))
    near = stage(_with_sets(_stars(tiles), signs, ("bits", "n")).mapInArrow(_bounded, "a long, b long"))
    links = _exact_links(words, near)
    labels = components(links).withColumnRenamed("node", "set")
    labelled = tiles.join(labels, "set", "left").withColumn("component", F.coalesce("component", "set"))
    place = scratch_dir(spark)
    apart = stage(_open(labelled, ["shingle"]), place)
    remove(spark, tiles_place)
    rest = stage(_residual(apart, signs).join(near, ["a", "b"], "left_anti"))
    remove(spark, place)
    return links.unionByName(_exact_links(words, rest)) if rest.head(1) else links


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_groups(read_table(spark, sf_dir, "documents")).drop("print", "group")


SQL = r"""with recursive docs as (select doc_id,
    list_filter(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[^ 	-
]+'), lambda w: w <> '') w from documents),
shingles as (select distinct doc_id, array_to_string(w[i : i + least(5, len(w)) - 1], ' ') s
  from docs, unnest(range(1, greatest(len(w) - 3, 2))) as r(i) where len(w) > 0),
sizes as (select doc_id, count(*) n from shingles group by doc_id),
common as (select a.doc_id a, b.doc_id b, count(*) c from shingles a join shingles b using (s)
  where a.doc_id <> b.doc_id group by all),
links as (select a, b from common join sizes x on x.doc_id = a join sizes y on y.doc_id = b
  where 100 * c >= 75 * (x.n + y.n - c)),
reach as (select doc_id node, doc_id other from docs union select r.node, l.b from reach r join links l on r.other = l.a)
select d.doc_id, coalesce(s.n, 0) n_shingles, (select min(other) from reach where node = d.doc_id) component_id
from docs d left join sizes s using (doc_id)"""
