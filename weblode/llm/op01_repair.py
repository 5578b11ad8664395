"""Token ids as grammar-compressed shards: frequent pairs of ids are replaced by
nonterminals, rules and expansion lengths are stored for random access."""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weblode.llm.common import blank, read_table, scratch_dir, share_code
from weblode.llm.pretokens import encoder, texts_of

NAME = "op1_repair"

END = 2
#: Ids of a shard (or one longer document), rounds of replacement, pairs that a
#: round replaces, and how often a pair must occur in the shard.
SHARD_IDS, ROUNDS, ROUND_PAIRS, LEAST_COUNT = 1 << 20, 16, 4096, 12
#: Characters that are encoded at a time.
STEP_CHARS = 512 << 10

_SHARDS = (
    "base long, n_docs long, n_ids long, rules binary, lengths binary, symbols binary, "
    "keys array<long>, doc_symbols array<long>"
)


# --- the grammar -------------------------------------------------------------


class Grammar(NamedTuple):
    """``symbols`` of a shard; a symbol from ``base`` on is a rule, a pair of
    earlier symbols, that stands for ``lengths`` ids. ``bounds`` are the
    places in ``symbols`` where documents begin, and the end."""

    base: int
    rules: np.ndarray
    lengths: np.ndarray
    symbols: np.ndarray
    bounds: np.ndarray


def compress(ids: np.ndarray, sizes: np.ndarray, base: int, end: int = END) -> Grammar:
    """Re-Pair by rounds: count all pairs, take the most frequent that can't
    overlap (the first symbols of the pairs of a round and the second ones are
    disjoint; a pair of equal symbols is the only one with its symbol), replace
    them everywhere, until no pair is frequent. The end id is in no pair, so a
    symbol never reaches from one document into the next."""
    last = np.cumsum(sizes) - 1
    symbols = ids.astype(np.int64)
    doc_end = np.zeros(len(symbols), bool)
    doc_end[last] = True
    rules: list[np.ndarray] = []
    lengths = [np.zeros(0, np.int64)]
    top = base
    for _ in range(ROUNDS):
        if len(symbols) < 2:
            break
        key = symbols[:-1] << 32 | symbols[1:]
        often, counts = _frequent(key)
        usable = (often >> 32 != end) & (often & 0xFFFFFFFF != end)
        often, counts = often[usable], counts[usable]
        if not len(often):
            break
        often = often[np.lexsort((often, -counts))][: 4 * ROUND_PAIRS]
        chosen = _disjoint(often)
        pairs = np.stack([chosen >> 32, chosen & 0xFFFFFFFF], axis=1)
        at, rule = _places(symbols, key, chosen, pairs, top)
        symbols[at] = top + rule
        keep = np.ones(len(symbols), bool)
        keep[at + 1] = False
        symbols, doc_end = symbols[keep], doc_end[keep]
        known = np.concatenate(lengths)
        lengths.append(sum(np.where(p < base, 1, known[np.maximum(p - base, 0)] if len(known) else 1) for p in pairs.T))
        rules.append(pairs)
        top += len(chosen)
    bounds = np.append(0, np.flatnonzero(doc_end) + 1)
    none = np.zeros((0, 2), np.int64)
    return Grammar(base, np.concatenate([none, *rules]), np.concatenate(lengths), symbols, bounds)


def _frequent(key: np.ndarray, least: int = LEAST_COUNT) -> tuple[np.ndarray, np.ndarray]:
    """Keys that occur at least ``least`` times, ascending, and how often."""
    key = np.sort(key)
    if len(key) < least:
        return key[:0], key[:0]
    again = key[least - 1 :] == key[: len(key) - least + 1]
    heads = np.flatnonzero(again & np.r_[True, key[1 : len(again)] != key[: len(again) - 1]])
    often = key[heads]
    return often, np.searchsorted(key, often, side="right") - heads


def _disjoint(keys: np.ndarray) -> np.ndarray:
    """The pairs of a round, in ascending order, from candidates in order of
    their counts."""
    left: set[int] = set()
    right: set[int] = set()
    chosen = []
    for key, a, b in zip(keys.tolist(), (keys >> 32).tolist(), (keys & 0xFFFFFFFF).tolist(), strict=True):
        if a in right or b in left or a == b and (a in left or b in right):
            continue
        left.add(a)
        right.add(b)
        chosen.append(key)
        if len(chosen) == ROUND_PAIRS:
            break
    return np.sort(np.array(chosen, np.int64))


def _places(
    symbols: np.ndarray, key: np.ndarray, chosen: np.ndarray, pairs: np.ndarray, top: int
) -> tuple[np.ndarray, np.ndarray]:
    """Where chosen pairs stand, and which one stands there. Only pairs of equal
    symbols can overlap: of those in a run, every other one is taken."""
    first, second = np.zeros(top, bool), np.zeros(top, bool)
    first[pairs[:, 0]] = True
    second[pairs[:, 1]] = True
    at = np.flatnonzero(first[symbols[:-1]] & second[symbols[1:]])
    key = key[at]
    place = np.searchsorted(chosen, key)
    place[place == len(chosen)] = 0
    right = chosen[place] == key
    at, place = at[right], place[right]
    twins = symbols[at] == symbols[at + 1]
    if twins.any():
        new = np.ones(len(at), bool)
        new[1:] = (np.diff(at) > 1) | ~twins[1:] | ~twins[:-1]
        run = np.arange(len(at)) - np.flatnonzero(new)[np.cumsum(new) - 1]
        taken = ~twins | (run % 2 == 0)
        at, place = at[taken], place[taken]
    return at, place


def expansions(base: int, rules: np.ndarray) -> np.ndarray:
    """The ids of all rules, one rule after another."""
    flat = rules.reshape(-1)
    while (again := flat >= base).any():
        size = np.where(again, 2, 1)
        start = np.cumsum(size) - size
        out = np.repeat(flat, size)
        out[start[again]] = rules[flat[again] - base, 0]
        out[start[again] + 1] = rules[flat[again] - base, 1]
        flat = out
    return flat


def expand(symbols: np.ndarray, base: int, rules: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The ids that symbols stand for: one lookup in the rules' expansions."""
    table = np.concatenate([np.arange(base), expansions(base, rules)])
    size = np.where(symbols < base, 1, np.append(lengths, 1)[np.maximum(symbols - base, 0)])
    begin = np.append(np.arange(base), base + np.cumsum(lengths) - lengths)[symbols]
    ends = np.cumsum(size)
    return table[np.arange(ends[-1] if len(ends) else 0) + np.repeat(begin - (ends - size), size)]


# --- the files ---------------------------------------------------------------


def _packed(symbols: np.ndarray) -> bytes:
    """Symbols as 24-bit little-endian numbers."""
    if len(symbols) and int(symbols.max()) >= 1 << 24:
        raise ValueError("a shard has more than 2^24 symbols")
    return np.ascontiguousarray(symbols.astype("<u4").view(np.uint8).reshape(-1, 4)[:, :3]).tobytes()


def _unpacked(packed: bytes) -> np.ndarray:
    out = np.zeros((len(packed) // 3, 4), np.uint8)
    out[:, :3] = np.frombuffer(packed, np.uint8).reshape(-1, 3)
    return out.view("<u4").ravel().astype(np.int64)


def _shards(path: str, end: int):
    """Rows of (key, text), in order, to shards."""

    def shard(keys: list, parts: list[np.ndarray], sizes: list[np.ndarray], base: int) -> pa.RecordBatch:
        ids, size = np.concatenate(parts), np.concatenate(sizes)
        grammar = compress(ids, size, base, end)
        values = (base, len(size), len(ids), grammar.rules.astype("<u4").tobytes(),
                  grammar.lengths.astype("<u4").tobytes(), _packed(grammar.symbols), keys, grammar.bounds.tolist())
        return pa.RecordBatch.from_arrays(
            [pa.array([v], t) for v, t in zip(values, (
                pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.binary(), pa.binary(),
                pa.list_(pa.int64()), pa.list_(pa.int64())), strict=True)],
            names=["base", "n_docs", "n_ids", "rules", "lengths", "symbols", "keys", "doc_symbols"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = encoder(path)
        keys: list = []
        parts: list[np.ndarray] = []
        sizes: list[np.ndarray] = []
        held = 0
        for batch in batches:
            texts, own = texts_of(batch["text"]), batch["key"].to_pylist()
            low = 0
            while low < len(texts):
                high, chars = low, 0
                while high < len(texts) and (high == low or chars + len(texts[high]) <= STEP_CHARS):
                    chars += len(texts[high])
                    high += 1
                ids, counts = coder.encode(texts[low:high])
                parts.append(np.insert(ids, np.cumsum(counts), end))
                sizes.append(counts + 1)
                keys += own[low:high]
                held += len(parts[-1])
                low = high
                if held >= SHARD_IDS:
                    yield shard(keys, parts, sizes, coder.size)
                    keys, parts, sizes, held = [], [], [], 0
        if keys:
            yield shard(keys, parts, sizes, coder.size)

    return run


def write_tokens(
    documents: DataFrame, out: str, tokenizer: str, key: str = "doc_id", text: str = "text", end: int = END
) -> None:
    """Writes the ids of all documents in ascending order of ``key``.

    ``out/shards`` is a table of shards: rules (pairs of symbols) and their
    expansion lengths as little-endian 32-bit numbers, symbols as 24-bit ones,
    the keys of the shard's documents and where each begins among the symbols.
    ``out/index`` has one small row per shard: its number, and the ids and
    documents before it. Spark writes both, so a lost executor's files are
    written again or not at all.

    Null and empty texts are the end id alone. Null keys come first; rows with
    equal keys follow each other by text. Other columns are not read. An empty
    table gives empty files.
    """
    spark = documents.sparkSession
    share_code(spark)
    rows = documents.select(F.col(f"`{key}`").cast("long").alias("key"), blank(F.col(f"`{text}`")).alias("text"))
    shards = (
        rows.repartitionByRange("key").sortWithinPartitions("key", "text")
        .mapInArrow(_shards(tokenizer, end), _SHARDS).withColumn("shard", F.monotonically_increasing_id())
    )
    shards.write.mode("errorifexists").parquet(f"{out}/shards")
    sizes = spark.read.parquet(f"{out}/shards").select("shard", "n_ids", "n_docs")
    # shards count up within a partition, partitions in key order: one sum per
    # partition of the write, then sums within each
    part = F.shiftright("shard", 33)
    totals = sizes.groupBy(part.alias("part")).agg(F.sum("n_ids").alias("ids"), F.sum("n_docs").alias("docs"))
    rows = totals.orderBy("part").collect()
    ids, docs = (np.cumsum([0, *(row[c] for row in rows)])[:-1] for c in ("ids", "docs"))
    # as Arrow it needs no Python workers of its own, which would keep their memory
    before = pa.table({
        "part": pa.array([row["part"] for row in rows], pa.int64()),
        "part_ids": pa.array(ids, pa.int64()), "part_docs": pa.array(docs, pa.int64())})
    from pyspark.sql import Window as W

    own = W.partitionBy("part").orderBy("shard")
    index = sizes.withColumn("part", part).join(
        spark.createDataFrame(before), "part"
    ).select(
        "shard",
        (F.col("part_ids") + F.sum("n_ids").over(own) - F.col("n_ids")).alias("ids_before"),
        (F.col("part_docs") + F.sum("n_docs").over(own) - F.col("n_docs")).alias("docs_before"),
        "n_ids", "n_docs",
    )
    index.write.mode("errorifexists").parquet(f"{out}/index")


def _decoded(batch: pa.RecordBatch, k: int) -> tuple[np.ndarray, np.ndarray]:
    """All ids of a shard, and where each of its documents begins among them."""
    base = batch["base"][k].as_py()
    rules = np.frombuffer(batch["rules"][k].as_py(), "<u4").astype(np.int64).reshape(-1, 2)
    lengths = np.frombuffer(batch["lengths"][k].as_py(), "<u4").astype(np.int64)
    symbols = _unpacked(batch["symbols"][k].as_py())
    size = np.where(symbols < base, 1, np.append(lengths, 1)[np.maximum(symbols - base, 0)])
    bounds = np.append(0, np.cumsum(size))[batch["doc_symbols"][k].values.to_numpy()]
    return expand(symbols, base, rules, lengths), bounds


def _read(digest: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(len(batch)):
                ids, bounds = _decoded(batch, k)
                starts = bounds[:-1] + batch["ids_before"][k].as_py()
                own = [pa.array(batch["keys"][k].values), pa.array(starts), pa.array(np.diff(bounds))]
                little = ids.astype("<u4")
                if digest:
                    crc = [zlib.crc32(little[a:b]) for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True)]
                    yield pa.RecordBatch.from_arrays(
                        [*own, pa.array(crc, pa.int64())], names=["key", "start", "n_tokens", "ids_crc32"])
                else:
                    lists = pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(ids.astype(np.int32)))
                    yield pa.RecordBatch.from_arrays([*own, lists], names=["key", "start", "n_tokens", "ids"])

    return run


def _scan(spark: SparkSession, path: str) -> DataFrame:
    share_code(spark)
    index = spark.read.parquet(f"{path}/index").select("shard", "ids_before")
    return spark.read.parquet(f"{path}/shards").join(index, "shard")


def read_tokens(spark: SparkSession, path: str) -> DataFrame:
    """``(key, start, n_tokens, ids)`` of all documents of ``write_tokens``."""
    return _scan(spark, path).mapInArrow(_read(False), "key long, start long, n_tokens long, ids array<int>")


def read_digests(spark: SparkSession, path: str) -> DataFrame:
    """``(key, start, n_tokens, ids_crc32)``: the ids are decoded and summed up."""
    return _scan(spark, path).mapInArrow(_read(True), "key long, start long, n_tokens long, ids_crc32 long")


def read_ids(spark: SparkSession, path: str, start: int, n: int) -> np.ndarray:
    """``n`` ids from position ``start`` on, from the shards that hold them:
    sums of the expansion lengths tell which symbols to expand. The caller
    bounds ``n``; the ids come to the driver."""
    index = spark.read.parquet(f"{path}/index").where(
        (F.col("ids_before") < start + n) & (F.col("ids_before") + F.col("n_ids") > start))
    rows = spark.read.parquet(f"{path}/shards").join(index.select("shard", "ids_before"), "shard").select(
        "base", "rules", "lengths", "symbols", "ids_before").orderBy("ids_before").collect()
    out = [np.zeros(0, np.int64)]
    for row in rows:
        base, rules = row["base"], np.frombuffer(row["rules"], "<u4").astype(np.int64).reshape(-1, 2)
        lengths = np.frombuffer(row["lengths"], "<u4").astype(np.int64)
        symbols = _unpacked(bytes(row["symbols"]))
        ends = np.cumsum(np.where(symbols < base, 1, np.append(lengths, 1)[np.maximum(symbols - base, 0)]))
        low, high = max(0, start - row["ids_before"]), min(int(ends[-1]), start + n - row["ids_before"])
        a, b = np.searchsorted(ends, low, side="right"), np.searchsorted(ends, high)
        ids = expand(symbols[a : b + 1], base, rules, lengths)
        skip = low - (int(ends[a - 1]) if a else 0)
        out.append(ids[skip : skip + high - low])
    return np.concatenate(out)


def tokenizer_path(name: str = "byte_bpe_50k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def write_and_read(spark: SparkSession, documents: DataFrame, tokenizer: str) -> DataFrame:
    out = scratch_dir(spark)
    write_tokens(documents, out, tokenizer)
    return read_digests(spark, out).withColumnRenamed("key", "doc_id")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return write_and_read(spark, read_table(spark, sf_dir, "documents").select("doc_id", "text"), tokenizer_path())


SQL = None
