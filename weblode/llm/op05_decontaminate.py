"""Benchmark decontamination: an FM-index per shard of training text, searched
backward for the benchmark's phrases."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weblode.llm.common import arrow_batches, read_table, slices, text_buffer
from weblode.llm.words import ALNUM, chars_before, find_words, hash_words

NAME = "op5_decontaminate"

#: Words of a window, and a document is contaminated from one word in 20 on.
WINDOW, SHARE = 13, 20
#: Words of one index, suffix positions kept (one in SAMPLE), and words of
#: benchmark text that one pass over the documents searches for.
SHARD_WORDS, SAMPLE, PASS_WORDS = 1 << 19, 8, 200_000

_CARRY = "row long, text string, ranges array<long>, items array<string>"
_OUT = "row long, n_words long, n_hit long, items array<string>, spans array<struct<start:int,end:int>>"


# --- the index ---------------------------------------------------------------


def suffix_array(text: np.ndarray) -> np.ndarray:
    """Start positions of the sorted suffixes of ``text`` (numbers of at least
    0) by doubling: ranks of suffixes by 2^k symbols are made from ranks by
    2^(k-1), and only suffixes whose rank is still shared are sorted again."""
    n = len(text)
    order = np.argsort(text, kind="stable")
    rank = np.zeros(n, np.int64)
    heads = np.r_[True, text[order][1:] != text[order][:-1]]
    rank[order] = np.flatnonzero(heads)[np.cumsum(heads) - 1]
    step = 1
    while True:
        # slots of the order whose rank is shared with a neighbour
        same = rank[order][1:] == rank[order][:-1]
        open_ = np.r_[same, False] | np.r_[False, same]
        slots = np.flatnonzero(open_)
        if not len(slots):
            return order
        at = order[slots]
        behind = at + step
        second = np.where(behind < n, rank[np.minimum(behind, n - 1)] + 1, 0)
        key = rank[at] * (n + 1) + second
        by = np.argsort(key, kind="stable")
        key, at = key[by], at[by]
        order[slots] = at
        first = np.r_[True, key[1:] != key[:-1]]
        rank[at] = slots[np.flatnonzero(first)[np.cumsum(first) - 1]]
        step *= 2


class WaveletTree:
    """Rank and access on a sequence of numbers below ``sigma``: a level per
    bit, from the highest, each with the counts of zeros before every position
    after the sequence was stably parted by the bits above (wavelet matrix)."""

    def __init__(self, sequence: np.ndarray, sigma: int) -> None:
        self.bits = max(1, int(sigma - 1).bit_length())
        self.zeros: list[np.ndarray] = []
        for level in range(self.bits - 1, -1, -1):
            one = (sequence >> level) & 1
            before = np.zeros(len(sequence) + 1, np.int32)
            np.cumsum(one == 0, out=before[1:])
            self.zeros.append(before)
            sequence = np.concatenate([sequence[one == 0], sequence[one == 1]])

    def rank(self, symbol: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Occurrences of each symbol before ``low`` and before ``high``."""
        base = np.zeros(len(symbol), np.int64)
        for k, before in enumerate(self.zeros):
            one = (symbol >> (self.bits - 1 - k)) & 1 == 1
            skip = before[-1]
            base, low, high = (
                np.where(one, skip + x - before[x], before[x]) for x in (base, low, high)
            )
        return low - base, high - base

    def access(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Symbols at positions, and how often each occurs before its position."""
        symbol, base = np.zeros(len(at), np.int64), np.zeros(len(at), np.int64)
        for before in self.zeros:
            one = before[at + 1] == before[at]
            skip = before[-1]
            at = np.where(one, skip + at - before[at], before[at])
            base = np.where(one, skip + base - before[base], before[base])
            symbol = symbol * 2 + one
        return symbol, at - base


class FMIndex:
    """Full-text index of a sequence of numbers from 1 to ``sigma - 1``; the
    end of the sequence counts as 0."""

    def __init__(self, sequence: np.ndarray, sigma: int) -> None:
        text = np.append(sequence.astype(np.int64), 0)
        order = suffix_array(text)
        self.tree = WaveletTree(text[order - 1], sigma)
        self.less = np.zeros(sigma + 1, np.int64)
        np.cumsum(np.bincount(text, minlength=sigma), out=self.less[1:])
        kept = order % SAMPLE == 0
        self.marked = kept
        self.before = np.zeros(len(text) + 1, np.int64)
        np.cumsum(kept, out=self.before[1:])
        self.samples = order[kept]

    def search(self, grid: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ranges of the sorted suffixes that begin with each phrase. Column k
        of ``grid`` holds ``size[k]`` symbols, the last one first; all phrases
        take their steps together."""
        low = np.zeros(len(size), np.int64)
        high = np.full(len(size), self.less[-1])
        for step in range(len(grid)):
            go = np.flatnonzero((size > step) & (low < high))
            symbol = grid[step, go].astype(np.int64)
            a, b = self.tree.rank(symbol, low[go], high[go])
            low[go], high[go] = self.less[symbol] + a, self.less[symbol] + b
        return low, high

    def locate(self, slots: np.ndarray) -> np.ndarray:
        """Text positions of suffixes, by steps back to the next kept one."""
        slots, steps = slots.copy(), np.zeros(len(slots), np.int64)
        open_ = np.flatnonzero(~self.marked[slots])
        while len(open_):
            symbol, before = self.tree.access(slots[open_])
            slots[open_] = self.less[symbol] + before
            steps[open_] += 1
            open_ = open_[~self.marked[slots[open_]]]
        return self.samples[self.before[slots]] + steps


# --- phrases of the benchmark ------------------------------------------------


class Phrases:
    """The distinct windows of some items, as word hashes, and their items."""

    def __init__(self, items: list[tuple[str | None, str | None]]) -> None:
        raw, at = text_buffer(pa.array([t for _, t in items], pa.string()))
        words = find_words(raw, at, ALNUM)
        hashes = hash_words(raw, words.start, words.end)
        self.names = [name for name, _ in items]
        self.vocabulary = np.unique(hashes)
        ids = np.searchsorted(self.vocabulary, hashes) + 2
        of: dict[tuple, set[int]] = {}
        for k in range(len(items)):
            own = ids[words.first[k] : words.first[k + 1]]
            width = min(WINDOW, len(own))
            if width:
                for window in np.lib.stride_tricks.sliding_window_view(own, width).tolist():
                    of.setdefault(tuple(window), set()).add(k)
        self.items = [sorted(v) for v in of.values()]
        self.size = np.array([len(w) for w in of], np.int64)
        self.shortest = int(self.size.min(initial=WINDOW))
        self.grid = np.zeros((WINDOW, len(of)), np.int32)
        for k, window in enumerate(of):
            self.grid[: len(window), k] = window[::-1]


def _keep(ids: np.ndarray, row: np.ndarray, shortest: int) -> np.ndarray:
    """Words in runs that can hold a phrase: a run of a document's words that
    all occur in the benchmark, at least as long as the shortest phrase. One
    word after each run is kept too, as its end."""
    known = ids > 1
    n = len(ids)
    edge = np.r_[True, (known[1:] != known[:-1]) | (row[1:] != row[:-1])] if n else np.zeros(0, bool)
    starts = np.flatnonzero(edge)
    size = np.diff(np.r_[starts, n])
    good = known[starts] & (size >= shortest) if n else np.zeros(0, bool)
    return np.repeat(good, size)


def _search(sent, last: bool):
    """Adds what the phrases of one pass hit to (row, text, ranges of hit
    words, items); the last pass gives the report instead of the text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw, at = text_buffer(batch["text"])
            for low, high in slices(at):
                change, found, words = _shard(
                    raw[at[low] : at[high]], at[low : high + 1] - at[low], sent.value,
                    batch["ranges"][low:high], batch["items"][low:high],
                )
                rows = batch.slice(low, high - low)
                if last:
                    yield _report(raw[at[low] : at[high]], at[low : high + 1] - at[low], rows["row"], words, change, found)
                else:
                    yield _carried(rows, words, change, found)

    return run


def _shard(raw: np.ndarray, at: np.ndarray, phrases: Phrases, ranges: pa.Array, items: pa.Array):
    words = find_words(raw, at, ALNUM)
    hashes = hash_words(raw, words.start, words.end)
    place = np.searchsorted(phrases.vocabulary, hashes)
    place[place == len(phrases.vocabulary)] = 0
    ids = np.ones(len(hashes), np.int64)
    if len(phrases.vocabulary):
        ids = np.where(phrases.vocabulary[place] == hashes, place + 2, 1)
    kept = np.flatnonzero(_keep(ids, words.row, phrases.shortest)) if phrases.items else np.zeros(0, np.int64)
    change = np.zeros(len(ids) + 1, np.int32)
    found: dict[int, set[str]] = {}
    for r in range(len(at) - 1):
        if len(items[r]):
            found[r] = set(items[r].as_py())
        if len(ranges[r]):
            pairs = words.first[r] + np.array(ranges[r].as_py())
            np.add.at(change, pairs[::2], 1)
            np.add.at(change, pairs[1::2], -1)
    if len(kept):
        # between two runs stands a 1, which occurs in no phrase
        gap = np.r_[False, (np.diff(kept) > 1) | (np.diff(words.row[kept]) > 0)]
        at_text = np.arange(len(kept)) + np.cumsum(gap)
        sequence = np.ones(at_text[-1] + 1, np.int64)
        sequence[at_text] = ids[kept]
        origin = np.zeros(len(sequence), np.int64)
        origin[at_text] = kept
        # an index takes whole runs, SHARD_WORDS of them or one longer run
        ends = np.r_[np.flatnonzero(sequence == 1), len(sequence)]
        low = 0
        while low < len(sequence):
            k = np.searchsorted(ends, low + SHARD_WORDS)
            high = int(ends[min(k, len(ends) - 1)])
            _mark(sequence[low:high], origin[low:high], words.row, phrases, change, found)
            low = high + 1
    return change, found, words


def _mark(sequence, origin, row, phrases: Phrases, change: np.ndarray, found: dict) -> None:
    index = FMIndex(sequence, len(phrases.vocabulary) + 2)
    low, high = index.search(phrases.grid, phrases.size)
    some = np.flatnonzero(low < high)
    counts = (high - low)[some]
    if not len(some):
        return
    window = np.repeat(some, counts)
    slot = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts) + np.repeat(low[some], counts)
    position = origin[index.locate(slot)]
    size = phrases.size[some]
    np.add.at(change, position, 1)
    np.add.at(change, position + np.repeat(size, counts), -1)
    pairs = np.unique(np.stack([row[position], window]), axis=1)
    for text, k in pairs.T.tolist():
        found.setdefault(text, set()).update(
            phrases.names[i] for i in phrases.items[k] if phrases.names[i] is not None)


def _runs(hit: np.ndarray, row: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and last words of runs of hit words of one text."""
    where = np.flatnonzero(hit)
    if not len(where):
        return where, where
    new = np.r_[True, (np.diff(where) > 1) | (np.diff(row[where]) > 0)]
    return where[new], where[np.r_[np.flatnonzero(new)[1:] - 1, len(where) - 1]]


def _lists(found: dict, n: int) -> pa.Array:
    return pa.array([sorted(found.get(r, ())) for r in range(n)], pa.list_(pa.string()))


def _carried(rows: pa.RecordBatch, words, change: np.ndarray, found: dict) -> pa.RecordBatch:
    ranges: list[list[int]] = [[] for _ in range(len(rows))]
    for a, b in zip(*map(np.ndarray.tolist, _runs(np.cumsum(change[:-1]) > 0, words.row)), strict=True):
        r = int(words.row[a])
        ranges[r] += [a - int(words.first[r]), b + 1 - int(words.first[r])]
    return pa.RecordBatch.from_arrays(
        [rows["row"], rows["text"], pa.array(ranges, pa.list_(pa.int64())), _lists(found, len(rows))],
        names=["row", "text", "ranges", "items"],
    )


def _report(raw, at, numbers: pa.Array, words, change: np.ndarray, found: dict) -> pa.RecordBatch:
    n = len(at) - 1
    hit = np.cumsum(change[:-1]) > 0
    spans: list[list[dict]] = [[] for _ in range(n)]
    if hit.any():
        chars = chars_before(raw)
        for a, b in zip(*map(np.ndarray.tolist, _runs(hit, words.row)), strict=True):
            r = int(words.row[a])
            zero = chars[at[r]]
            spans[r].append({"start": int(chars[words.start[a]] - zero), "end": int(chars[words.end[b]] - zero)})
    return pa.RecordBatch.from_arrays(
        [numbers, pa.array(np.diff(words.first)), pa.array(np.bincount(words.row[hit], minlength=n)), _lists(found, n),
         pa.array(spans, pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())])))],
        names=["row", "n_words", "n_hit", "items", "spans"],
    )


# --- the operator ------------------------------------------------------------


def find_contamination(
    documents: DataFrame, benchmark: DataFrame, key: str = "doc_id", text: str = "text",
    item: str = "item_id", item_text: str = "text", pass_words: int = PASS_WORDS,
) -> DataFrame:
    """``(key, n_words, n_hit, items, spans, contaminated)``, a row per document.

    Words are runs of ASCII letters and digits and of everything beyond ASCII,
    with A-Z lower-cased. Phrases are the windows of 13 words of an item, or a
    shorter item as a whole. ``items`` are the names (as text, sorted) of items
    with a phrase in the document, ``spans`` the merged code point ranges to
    remove, ``contaminated`` tells whether one word in 20 or more is hit.

    Documents stay in their partitions: a task indexes about 2 MB of text at a
    time (a longer document by itself), leaving out runs of words that can't
    hold a phrase, and searches all phrases together. Benchmarks of more than
    ``pass_words`` words are searched in several passes, each with a share of
    the items by hash, so what is sent to the executors has a bound.

    Null and empty texts have no words and no hits; items without words have
    no phrases; rows with equal or null keys are documents of their own, items
    with equal names count as one; items without a name count for hits and
    spans and are left out of ``items`` only. Other columns are not read. An
    empty table gives an empty table.
    """
    spark = documents.sparkSession
    arrow_batches(spark)
    items = benchmark.select(F.col(f"`{item}`").cast("string").alias("name"), F.col(f"`{item_text}`").alias("text"))
    words = items.agg(F.sum(F.size(F.split("text", "[^A-Za-z0-9\\x{80}-\\x{10FFFF}]+")))).first()[0] or 0
    passes = -(-words // pass_words) or 1
    rows = documents.select(F.col(f"`{key}`").alias("row"), F.col(f"`{text}`").alias("text"))
    found = rows.select("row", "text", F.expr("cast(array() as array<long>)").alias("ranges"),
                        F.expr("cast(array() as array<string>)").alias("items"))
    for k in range(passes):
        own = items.where(F.pmod(F.xxhash64(F.coalesce("name", "text")), F.lit(passes)) == k).orderBy("name", "text").collect()
        sent = spark.sparkContext.broadcast(Phrases([(r["name"], r["text"]) for r in own]))
        last = k == passes - 1
        found = found.mapInArrow(_search(sent, last), _OUT if last else _CARRY)
    return found.select(
        F.col("row").alias(key), "n_words", "n_hit", "items", "spans",
        ((F.col("n_hit") > 0) & (F.col("n_hit") * SHARE >= F.col("n_words"))).alias("contaminated"),
    )


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find_contamination(
        read_table(spark, sf_dir, "documents").select("doc_id", "text"), read_table(spark, sf_dir, "benchmark")
    )
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), "contaminated",
    )


_WORDS = r"list_filter(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda w: w <> '')"
SQL = f"""with docs as (select doc_id, {_WORDS} w from documents),
items as (select item_id::varchar item, {_WORDS} w from benchmark where item_id is not null),
windows as (select distinct item, array_to_string(w[i : i + least(13, len(w)) - 1], ' ') p, least(13, len(w)) n
  from items, unnest(range(1, greatest(len(w) - 11, 2))) as r(i) where len(w) > 0),
lengths as (select distinct n from windows),
places as (select d.doc_id, i, l.n, array_to_string(w[i : i + l.n - 1], ' ') p
  from docs d, lengths l, unnest(range(1, len(w) - l.n + 2)) as r(i)),
hits as (select doc_id, i, w.n, item from places join windows w using (p, n)),
hit_words as (select distinct doc_id, unnest(range(i, i + n)) k from hits),
n_hits as (select doc_id, count(*) n_hit from hit_words group by doc_id),
found as (select doc_id, string_agg(item, ',' order by item) items, count(*) n from (select distinct doc_id, item from hits) group by doc_id)
select d.doc_id, len(d.w)::bigint n_words, coalesce(n_hit, 0) n_hit, coalesce(f.n, 0) n_items,
  sha256(coalesce(items, '')) items_sha256, coalesce(n_hit, 0) > 0 and 20 * coalesce(n_hit, 0) >= len(d.w) contaminated
from docs d left join n_hits using (doc_id) left join found f using (doc_id)"""
