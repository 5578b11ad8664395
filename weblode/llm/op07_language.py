"""Language ID by bit-sliced Bloom filters: one lookup of an n-gram gives all
languages that contain it; counts per language, less the expected false
positives, decide."""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from weblode.llm.common import blank, fold, mix64, read_table, share_code, slices, text_buffer

NAME = "op7_language"

#: Training rows per language at most, chosen by a hash of the text; languages
#: at most, whose numbers of rows the driver gets (64 to a word of a slot).
SAMPLE_ROWS, LANGUAGES = 4000, 4096
#: Bytes of an n-gram, slots of the filter at least and per n-gram of the largest
#: language, and lookups of an n-gram: a bit is set in at most 2 of 8 slots.
GRAM, SLOTS, SLOTS_PER_GRAM, HASHES = 4, 1 << 18, 8, 2
#: A language contains an n-gram if its share there is at least this part of
#: its largest share in any language; less is quotations and stray words.
STRAY = 0.05

#: Folds the bytes of a text for n-grams: A-Z to lower case; ASCII that is no
#: letter ends a word.
_FOLDED = np.arange(256, dtype=np.uint8)
_FOLDED[65:91] += 32
_FOLDED[: 65] = 32
_FOLDED[91:97] = 32
_FOLDED[123:128] = 32


def grams(raw: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The byte n-grams of each text, words padded by a blank, as numbers; and
    where each text's begin. N-grams hold at most one end of a word."""
    if not len(raw):
        return np.zeros(0, np.uint32), np.zeros(len(at), np.int64)
    # a blank before each text, and three at the end
    n = len(at) - 1
    text = np.full(len(raw) + n + GRAM, 32, np.uint8)
    starts = at[:-1] + np.arange(n) + 1
    where = np.arange(len(raw)) + np.repeat(np.arange(n) + 1, np.diff(at))
    text[where] = _FOLDED[raw]
    wide = text.astype(np.uint32)
    value = wide[:-3] | wide[1:-2] << 8 | wide[2:-1] << 16 | wide[3:] << 24
    blanks = (text == 32).astype(np.uint8)
    inside = blanks[1:-2] + blanks[2:-1]
    good = (inside == 0) & (blanks[:-3] + blanks[3:] < 2)
    position = np.flatnonzero(good)
    return value[position], np.searchsorted(position, np.append(starts - 1, len(raw) + n))


def _slots(values: np.ndarray, slots: int = SLOTS) -> list[np.ndarray]:
    h = mix64(values.astype(np.uint64) + np.uint64(1))
    return [((h >> np.uint64(32 * k)) & np.uint64(slots - 1)).astype(np.int64) for k in range(HASHES)]


class Filters(NamedTuple):
    """``slots``: bit l is set where an n-gram of language l falls, 64 languages
    to a word, one column of words or several. ``known``:
    the share of n-grams of a language's own text that its filter holds,
    ``false_rate``: the share of all n-grams it holds by chance."""

    languages: list[str]
    slots: np.ndarray
    known: np.ndarray
    false_rate: np.ndarray

    def counts(self, values: np.ndarray, first: np.ndarray) -> np.ndarray:
        """N-grams of each text that each language seems to contain."""
        out = np.zeros((len(first) - 1, len(self.languages)))
        places = _slots(values, len(self.slots))
        for word, slots in enumerate(self.slots.reshape(len(self.slots), -1).T):
            masks = np.full(len(values), ~np.uint64(0))
            for place in places:
                masks &= slots[place]
            for k in range(64 * word, min(64 * word + 64, len(self.languages))):
                total = np.zeros(len(values) + 1, np.int64)
                np.cumsum(((masks >> np.uint64(k % 64)) & np.uint64(1)).astype(np.int8), out=total[1:])
                out[:, k] = total[first[1:]] - total[first[:-1]]
        return out

    def scores(self, values: np.ndarray, first: np.ndarray) -> np.ndarray:
        """Shares per language that sum to 1, from counts less the expected
        false positives, over what a text of the language itself would have."""
        n = np.diff(first)[:, None]
        false = self.false_rate[None, :]
        true = np.clip((self.counts(values, first) - n * false) / np.maximum(1 - false, 1e-9), 0, None)
        rate = true / np.maximum(n, 1) / np.maximum(self.known[None, :], 1e-9)
        # rates of close languages differ little over many n-grams, so they
        # are set apart by a power
        power = np.clip(rate, 1e-9, None) ** 8
        return power / power.sum(axis=1, keepdims=True)


def _gram_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        raw, at = text_buffer(batch["text"])
        languages = batch["lang"].to_numpy(zero_copy_only=False)
        for low, high in slices(at):
            values, first = grams(raw[at[low] : at[high]], at[low : high + 1] - at[low])
            row = np.repeat(languages[low:high], np.diff(first))
            for lang in sorted(set(row)):
                gram, n = np.unique(values[row == lang], return_counts=True)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang] * len(gram), pa.string()), pa.array(gram.astype(np.int64)), pa.array(n)],
                    names=["lang", "gram", "n"])


def _sample(rows: DataFrame, sizes: dict[str, int]) -> DataFrame:
    """At most ``SAMPLE_ROWS`` distinct texts of each language, those with the
    least hashes. Only keys are ordered, and few more of them than are kept."""
    from pyspark.sql import Window as W

    spark = rows.sparkSession
    limits = [(name, min(2**64 * 2 * SAMPLE_ROWS // n - 2**63, 2**63 - 1)) for name, n in sizes.items()]
    rows = rows.join(F.broadcast(spark.createDataFrame(limits, "lang string, most long")), "lang").where("h <= most")
    rank = F.row_number().over(W.partitionBy("lang").orderBy("h"))
    last = rows.select("lang", "h").distinct().withColumn("rank", rank).where(F.col("rank") <= SAMPLE_ROWS)
    last = last.groupBy("lang").agg(F.max("h").alias("last")).collect()  # a row per language
    last = spark.createDataFrame([(r["lang"], r["last"]) for r in last], "lang string, last long")
    return rows.join(F.broadcast(last), "lang").where("h <= last").dropDuplicates(["lang", "h"])


def learn(labelled: DataFrame, text: str = "text", lang: str = "lang") -> Filters:
    """Filters from rows with a language, at most ``SAMPLE_ROWS`` distinct whole
    texts of each (those with the least hashes). A language's n-grams are all
    of the sample that aren't stray; the filter has as many slots as they need.
    Rows without language or text are left out, repeated ones count once; more
    than ``LANGUAGES`` languages are an error; no rows at all give no filters."""
    from pyspark.sql import Window as W

    spark = labelled.sparkSession
    share_code(spark)
    rows = labelled.select(F.col(f"`{text}`").alias("text"), F.col(f"`{lang}`").alias("lang")).where(
        "text is not null and lang is not null").withColumn("h", F.xxhash64("text"))
    sizes = {r["lang"]: r["count"] for r in rows.groupBy("lang").count().limit(LANGUAGES + 1).collect()}
    if len(sizes) > LANGUAGES:
        raise ValueError(f"more than {LANGUAGES} languages")
    if not sizes:
        return Filters([], np.zeros(SLOTS, np.uint64), np.zeros(0), np.zeros(0))
    counts = _sample(rows, sizes).select("text", "lang").mapInArrow(_gram_counts, "lang string, gram long, n long")
    counts = counts.groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    counts = counts.withColumn("all", F.sum("n").over(W.partitionBy("lang")))
    share = F.col("n") / F.col("all")
    found = (
        counts.withColumn("share", share).withColumn("top", F.max("share").over(W.partitionBy("gram")))
        .where(F.col("share") >= STRAY * F.col("top")).select("lang", "gram", "n", "all").toArrow()
    )
    languages = sorted(sizes)
    names, gram = np.array(found["lang"].to_pylist()), found["gram"].to_numpy()
    n, total = found["n"].to_numpy(), found["all"].to_numpy()
    order = np.argsort(names, kind="stable")
    edges = np.append(np.searchsorted(names[order], languages), len(order))
    size = max(SLOTS, 1 << int(SLOTS_PER_GRAM * np.diff(edges).max() - 1).bit_length())
    slots, known, density = np.zeros((size, -(-len(languages) // 64)), np.uint64), np.zeros(len(languages)), np.zeros(len(languages))
    for k in range(len(languages)):
        own, bit = order[edges[k] : edges[k + 1]], np.uint64(1 << k % 64)
        for place in _slots(gram[own], size):
            slots[place, k // 64] |= bit
        known[k] = n[own].sum() / total[own][0] if len(own) else 0
        density[k] = ((slots[:, k // 64] & bit) > 0).mean()
    return Filters(languages, slots, known, density**HASHES)


def _predict(sent):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        filters = sent.value
        for batch in batches:
            raw, at = text_buffer(batch["text"])
            for low, high in slices(at):
                values, first = grams(raw[at[low] : at[high]], at[low : high + 1] - at[low])
                rows = batch.slice(low, high - low)
                letters = rows["letters"].to_numpy(zero_copy_only=False)
                best, score = np.zeros(high - low, np.int64), np.zeros(high - low)
                names = np.array([*filters.languages, "und"], object)
                if filters.languages:
                    scores = filters.scores(values, first)
                    best, score = scores.argmax(axis=1), scores.max(axis=1)
                best = np.where(letters, best, len(filters.languages))
                yield pa.RecordBatch.from_arrays(
                    [*(rows[c] for c in batch.schema.names if c not in ("text", "letters")),
                     pa.array(names[best].tolist(), pa.string()), pa.array(np.where(letters, score, 0.0))],
                    names=[*(c for c in batch.schema.names if c not in ("text", "letters")), "lang_pred", "score"])

    return run


def has_letter(text: Column) -> Column:
    return blank(text).rlike(r"\p{L}")


def predict(documents: DataFrame, filters: Filters, keep: dict[str, Column], text: str = "text") -> DataFrame:
    """The columns of ``keep`` with lang_pred and score (0 to 1), a row per
    document. Only the text is read for them. ``keep`` must not use the names
    ``text``, ``letters``, ``lang_pred`` or ``score``.

    Null texts and texts without a letter are ``und`` with score 0, and so are
    all if nothing was learned. Texts with letters but without a known n-gram
    have equal scores and the first language. Rows are independent of each
    other and stay where they are, so repeated ones come back as often; a long
    text is worked on by itself, whole; an empty table gives an empty table.
    """
    taken = {"text", "letters", "lang_pred", "score"} & set(keep)
    if taken:
        raise ValueError(f"kept columns need other names: {sorted(taken)}")
    spark = documents.sparkSession
    share_code(spark)
    rows = documents.select(
        *[c.alias(name) for name, c in keep.items()], blank(F.col(f"`{text}`")).alias("text"),
        has_letter(F.col(f"`{text}`")).alias("letters"))
    schema = ", ".join(f"`{n}` {t}" for n, t in rows.dtypes if n not in ("text", "letters"))
    sent = spark.sparkContext.broadcast(filters)
    return rows.mapInArrow(_predict(sent), f"{schema}, lang_pred string, score double")


def held_out(doc_id: Column) -> Column:
    """Rows whose language is not learned from."""
    return F.coalesce(fold(doc_id, 4) == 2, F.lit(False))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = read_table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    filters = learn(documents.where(~held_out(F.col("doc_id"))))
    return predict(documents, filters, {"doc_id": F.col("doc_id"), "held_out": held_out(F.col("doc_id"))})


SQL = None
