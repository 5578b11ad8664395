"""Toxicity by class-conditional Kneser-Ney models of letters: the length-
normalised log-likelihoods of toxic and of ordinary text are compared.

Spark counts the n-grams of all labelled rows and makes the models of them, all
of them: what follows a context, how many different bytes precede, and the log-
likelihood ratios are sums and joins over tables of n-grams. Texts are scored
against a table of ratios in parts of bounded size, one pass for each: a part
has all n-grams of its contexts, and what the words of a text have come to so
far goes from pass to pass. A model that fits into one part takes one pass.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from weblode.llm.common import blank, fold, read_table, share_code, slices, stage, text_buffer

NAME = "op8_toxicity"

#: Bytes of an n-gram, and what is taken off each count for the rarer ones.
ORDER, DISCOUNT = 5, 0.75
#: Entries of a part of a model (24 MB, sent to all executors), labelled rows that
#: the score is calibrated on at most, and labels that are sent to all executors
#: at most (more are joined by a shuffle).
PART_ENTRIES, CALIBRATION_ROWS, MAX_LABELS = 2_000_000, 20_000, 2_000_000
#: Bytes of text that one step works on, each of which takes some 100 bytes of a
#: worker's memory for a while, and distinct n-grams that a worker holds at about.
TEXT_STEP, HELD_GRAMS = 256 << 10, 500_000

#: Folds the bytes of a text: A-Z to lower case, other ASCII that is no letter
#: to a blank.
_FOLDED = np.arange(256, dtype=np.uint8)
_FOLDED[65:91] += 32
_FOLDED[: 65] = 32
_FOLDED[91:97] = 32
_FOLDED[123:128] = 32


def grams(raw: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The n-gram that ends at each byte of each text, and at one blank after
    it, texts led by blanks; and where each text's begin."""
    n, pad = len(at) - 1, ORDER - 1
    text = np.full(len(raw) + n * (pad + 1), 32, np.uint64)
    starts = at[:-1] + np.arange(n) * (pad + 1)
    text[np.arange(len(raw)) + np.repeat((np.arange(n) + 1) * (pad + 1) - 1, np.diff(at))] = _FOLDED[raw]
    value = np.zeros(max(len(text) - pad, 0), np.uint64)
    for k in range(ORDER):
        value = value << np.uint64(8) | text[k : k + len(value)]
    own = np.ones(len(value), bool)
    for k in range(pad):
        skip = starts[1:] - 1 - k
        own[skip[skip >= 0]] = False
    first = at + np.arange(n + 1)
    return value[own].astype(np.int64), first


_CONTEXT = 1 << 62


class Part(NamedTuple):
    """Log-likelihood ratios of n-grams, and of contexts for n-grams that
    neither class has, by ascending key; part ``number`` of ``parts``."""

    keys: np.ndarray
    values: np.ndarray
    number: int
    parts: int

    def look_up(self, keys: np.ndarray) -> np.ndarray:
        """The values of keys, nan for those that are not there."""
        if not len(self.keys):
            return np.full(len(keys), np.nan)
        place = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        return np.where(self.keys[place] == keys, self.values[place], np.nan)

    def ratios(self, value: np.ndarray) -> np.ndarray:
        """Those of n-grams whose context is of this part, 0 for all others."""
        ratio = np.zeros(len(value))
        own = np.flatnonzero((value >> 8) % self.parts == self.number) if self.parts > 1 else np.arange(len(value))
        found = self.look_up(value[own])
        missing = np.flatnonzero(np.isnan(found))
        # a context is kept under its own number, marked by a high bit
        found[missing] = np.nan_to_num(self.look_up(value[own][missing] >> 8 | _CONTEXT))
        ratio[own] = found
        return ratio


def word_ratios(part: Part, raw: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """What the n-grams of each word come to, and where each text's words begin."""
    value, first = grams(raw, at)
    begins = np.ones(len(value), bool)
    begins[1:] = value[:-1] & 255 == 32
    begins[first[:-1]] = True
    heads = np.flatnonzero(begins)
    word = np.add.reduceat(part.ratios(value), heads) if len(heads) else np.zeros(0)
    return word, np.searchsorted(heads, first)


#: Ratios of a word above which it stands out, more and more.
ABOVE = (1, 3)
FEATURES = len(ABOVE) + 3


def features(word: np.ndarray, edges: np.ndarray) -> np.ndarray:
    """For each text, what its words' log-likelihood ratios come to per
    word: their mean, what lies above the steps of ``ABOVE``, and the share above
    the last, for few strong words among many that say nothing; and how far a
    mean of so many words may be trusted."""
    n = np.diff(edges)

    def per_word(values: np.ndarray) -> np.ndarray:
        total = np.append(0, np.cumsum(values))
        return (total[edges[1:]] - total[edges[:-1]]) / n

    above = [per_word(np.clip(word - step, 0, None)) for step in ABOVE]
    return np.stack([per_word(word), *above, per_word(word > ABOVE[-1]), 1 / np.sqrt(n)], axis=1)


class Model(NamedTuple):
    """``table(part, key, value)`` on shared storage, and the ``weights`` that turn
    a text's features into a score."""

    table: DataFrame
    parts: int
    weights: np.ndarray

    def part(self, number: int) -> Part:
        """One part: about ``PART_ENTRIES`` rows come to the driver."""
        rows = self.table.where(F.col("part") == number).select("key", "value").toArrow()
        order = np.argsort(rows["key"].to_numpy())
        return Part(rows["key"].to_numpy()[order], rows["value"].to_numpy()[order], number, self.parts)


def shared_probabilities(grams: DataFrame) -> DataFrame:
    """``(m, suffix, shared)`` for the distinct n-grams ``(m, gram)`` of models m:
    the Kneser-Ney probability of the last byte after all but the first of the
    others, by how many different bytes precede, not how often, smoothed by
    ever shorter contexts."""
    counts, longer = {}, grams.select("m", F.col("gram").alias("g"))
    for k in range(ORDER - 1, 0, -1):
        counts[k] = stage(longer.groupBy("m", _suffix("g", k).alias("g")).agg(F.count(F.lit(1)).alias("n")))
        longer = counts[k]
    total = F.sum("n").over(Window.partitionBy("m"))
    lower = counts[1].select("m", "g", ((F.col("n") + 0.5) / (total + 128)).alias("p"))
    for k in range(2, ORDER):
        context = Window.partitionBy("m", F.shiftright("g", 8))  # 256 rows at most
        level = counts[k].select(
            "m", "g", "n", F.sum("n").over(context).alias("total"), F.count(F.lit(1)).over(context).alias("kinds"),
            _suffix("g", k - 1).alias("shorter"))
        shorter = lower.select("m", F.col("g").alias("shorter"), F.col("p").alias("lower"))
        p = (F.greatest(F.col("n") - DISCOUNT, F.lit(0.0)) + DISCOUNT * F.col("kinds") * F.col("lower")) / F.col("total")
        lower = level.join(shorter, ["m", "shorter"]).select("m", "g", p.alias("p"))
    return lower.select("m", F.col("g").alias("suffix"), F.col("p").alias("shared"))


def _suffix(column: str, size: int) -> Column:
    return F.col(column).bitwiseAND(F.lit((1 << 8 * size) - 1).cast("long"))


def ratios(counts: DataFrame) -> DataFrame:
    """``(m, context, key, value)``: log-likelihood ratios for ``counts(m, gram,
    toxic, ordinary)``, of every n-gram and of every context by itself."""
    rows = counts.withColumns({"context": F.shiftright("gram", 8), "suffix": _suffix("gram", ORDER - 1)})
    rows = rows.join(shared_probabilities(counts), ["m", "suffix"])
    of_context = Window.partitionBy("m", "context")  # 256 rows at most
    sums = {}
    for c in ("toxic", "ordinary"):
        sums |= {f"{c}_total": F.sum(c).over(of_context), f"{c}_kinds": F.count_if(F.col(c) > 0).over(of_context)}
    sums["first"] = F.row_number().over(of_context.orderBy("gram")) == 1
    rows = rows.withColumns(sums)
    logs, left = [], []
    for c in ("toxic", "ordinary"):
        total, back = F.col(f"{c}_total"), DISCOUNT * F.col(f"{c}_kinds") / F.col(f"{c}_total")
        seen = F.greatest(F.col(c) - DISCOUNT, F.lit(0.0)) / total + back * F.col("shared")
        logs.append(F.log(F.when(total > 0, seen).otherwise(F.col("shared"))))
        left.append(F.log(F.when(total > 0, back).otherwise(1.0)))
    own = F.struct(F.col("gram").alias("key"), (logs[0] - logs[1]).alias("value"))
    alone = F.struct(
        F.col("context").bitwiseOR(F.lit(_CONTEXT)).alias("key"), (left[0] - left[1]).alias("value"))
    entries = F.explode(F.when(F.col("first"), F.array(own, alone)).otherwise(F.array(own)))
    return rows.select("m", "context", entries.alias("entry")).select("m", "context", "entry.*")


# --- counts and calibration ---------------------------------------------------


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """N-grams with their counts by class and half, summed up as they come."""
    held: list[tuple[np.ndarray, np.ndarray]] = []
    size = 0

    def merged() -> tuple[np.ndarray, np.ndarray]:
        gram = np.concatenate([g for g, _ in held])
        gram, back = np.unique(gram, return_inverse=True)
        out = np.zeros((4, len(gram)), np.int64)
        np.add.at(out, (slice(None), back), np.concatenate([c for _, c in held], axis=1))
        return gram, out

    def rows(gram: np.ndarray, counts: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(gram), *map(pa.array, counts)], names=["gram", "t0", "o0", "t1", "o1"])

    for batch in batches:
        raw, at = text_buffer(batch["text"])
        kind = 1 - batch["toxic"].to_numpy(zero_copy_only=False) + 2 * batch["half"].to_numpy(zero_copy_only=False)
        for low, high in slices(at, TEXT_STEP):
            value, first = grams(raw[at[low] : at[high]], at[low : high + 1] - at[low])
            row_kind = np.repeat(kind[low:high], np.diff(first))
            gram, back = np.unique(value, return_inverse=True)
            counts = np.bincount(row_kind * len(gram) + back, minlength=4 * len(gram)).reshape(4, -1)
            held.append((gram, counts))
            size += len(gram)
            if size > HELD_GRAMS:
                held = [merged()]
                size = len(held[0][0])
                if size > HELD_GRAMS * 3 // 4:
                    yield rows(*held[0])
                    held, size = [], 0
    if held:
        yield rows(*merged())


def _labelled(documents: DataFrame, labels: DataFrame, key: str, text: str) -> DataFrame:
    """(text, toxic, half, h) of documents with a label outside the held-out fold."""
    known = labels.where(F.col("toxic").isNotNull() & F.col(f"`{key}`").isNotNull()).groupBy(
        F.col(f"`{key}`").alias("key")).agg(F.max("toxic").alias("toxic")).where(~held_out(F.col("key")))
    if known.count() <= MAX_LABELS:
        known = F.broadcast(known)
    rows = documents.select(F.col(f"`{key}`").alias("key"), blank(F.col(f"`{text}`")).alias("text")).join(known, "key")
    return rows.select(
        "text", F.when(F.col("toxic") > 0, 1).otherwise(0).alias("toxic"),
        F.when(fold(F.col("key"), 5) > 2, 1).otherwise(0).alias("half"), F.xxhash64(F.lit(5), "key").alias("h"))


def logistic(features: np.ndarray, label: np.ndarray, rising: int = FEATURES - 1, ridge: float = 0.5) -> np.ndarray:
    """The constant and the weights of a logistic regression, by Newton steps on
    features of unit spread. The first ``rising`` features speak for the label:
    one that would get a negative weight is left out, so that more of it never
    lowers a score, also far from what was learned from."""
    centre, spread = features.mean(axis=0), features.std(axis=0) + 1e-9
    scaled = np.column_stack([np.ones(len(features)), (features - centre) / spread])
    used = list(range(scaled.shape[1]))
    while True:
        weights = np.zeros(scaled.shape[1])
        weights[used] = _newton(scaled[:, used], label, ridge)
        falling = [k for k in used if 1 <= k <= rising and weights[k] < 0]
        if not falling:
            break
        used.remove(min(falling, key=weights.__getitem__))
    slopes = weights[1:] / spread
    return np.append(weights[0] - centre @ slopes, slopes)


def _newton(features: np.ndarray, label: np.ndarray, ridge: float) -> np.ndarray:
    weights = np.zeros(features.shape[1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(features @ weights, -30, 30)))
        slope = features.T @ (p - label) + ridge * weights
        curve = (features * (p * (1 - p))[:, None]).T @ features + ridge * np.eye(len(weights))
        step = np.linalg.solve(curve, slope)
        weights -= step * min(1.0, 4 / (np.abs(step).max() + 1e-12))
        if np.abs(step).max() < 1e-8:
            break
    return weights


def learn(documents: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text") -> Model:
    """The model of all labelled documents outside the held-out fold, with every
    n-gram that they have. Two models of half the rows each score the other
    half (a bounded sample of whole texts by hash) to calibrate. A document
    with several labels is toxic if one says so, repeated rows count each time,
    and null texts are empty. Without labels of both classes every score is 0."""
    spark = documents.sparkSession
    share_code(spark)
    rows = _labelled(documents, labels, key, text)
    columns = ("t0", "o0", "t1", "o1")
    counts = rows.select("text", "toxic", "half").mapInArrow(
        _counted, "gram long, t0 long, o0 long, t1 long, o1 long")
    counts = stage(counts.groupBy("gram").agg(*[F.sum(c).alias(c) for c in columns]))
    sums = counts.agg(F.sum(F.col("t0") + F.col("t1")), F.sum(F.col("o0") + F.col("o1"))).first()
    none = np.append(-40.0, np.zeros(FEATURES))
    if not sums[0] or not sums[1]:
        return Model(spark.createDataFrame([], "part int, key long, value double"), 1, none)
    # models 0 and 1 of the halves, and 2 of all
    of = [(0, "t0", "o0"), (1, "t1", "o1"), (2, "t0 + t1", "o0 + o1")]
    each = F.explode(F.array(*[
        F.struct(F.lit(m).alias("m"), F.expr(t).alias("toxic"), F.expr(o).alias("ordinary")) for m, t, o in of]))
    counts = counts.select("gram", each.alias("c")).select("gram", "c.*").where("toxic + ordinary > 0")
    table = stage(ratios(counts))
    entries = dict(table.groupBy("m").count().collect())
    first, second, whole = (_model(table, m, entries.get(m, 0), none) for m in range(3))
    # a hash limit that leaves about the bound
    total = max(rows.count(), 1)
    limit = min(2**64 * CALIBRATION_ROWS // total - 2**63, 2**63 - 1)
    sample = stage(rows.where(F.col("h") <= limit).select("text", "toxic", "half"))
    rated = [_passes(sample.where(F.col("half") == half).drop("half"), model, False) for half, model in ((1, first), (0, second))]
    rated = rated[0].unionByName(rated[1]).toArrow()
    known = np.array(rated["features"].to_pylist(), np.float64).reshape(-1, FEATURES)
    weights = logistic(known, rated["toxic"].to_numpy().astype(np.float64)) if len(known) else none
    return whole._replace(weights=weights)


def _model(table: DataFrame, m: int, entries: int, weights: np.ndarray) -> Model:
    """Parts by context; an odd number of them, as contexts are bytes."""
    parts = 1 if entries <= PART_ENTRIES else -(-entries // PART_ENTRIES) | 1
    part = F.pmod(F.col("context"), F.lit(parts)).cast("int").alias("part")
    return Model(table.where(F.col("m") == m).select(part, "key", "value"), parts, weights)


def _pass(sent, weights: np.ndarray, last: bool, scores: bool):
    """Adds what one part of the model says of each word to what the parts
    before have said. The last pass turns it into features or a score."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = sent.value
        for batch in batches:
            raw, at = text_buffer(batch["text"])
            others = [c for c in batch.schema.names if c not in ("text", "words")]
            for low, high in slices(at, TEXT_STEP):
                word, edges = word_ratios(part, raw[at[low] : at[high]], at[low : high + 1] - at[low])
                piece = batch.slice(low, high - low)
                if "words" in batch.schema.names:
                    word = word + piece["words"].flatten().to_numpy()
                columns = [piece[c] for c in others]
                if not last:
                    lists = pa.ListArray.from_arrays(pa.array(edges, pa.int32()), pa.array(word))
                    yield pa.RecordBatch.from_arrays([*columns, piece["text"], lists], names=[*others, "text", "words"])
                    continue
                found = features(word, edges)
                if scores:
                    z = weights[0] + found @ weights[1:]
                    out = pa.array(1 / (1 + np.exp(-np.clip(z, -40, 40))))
                else:
                    out = pa.array(found.tolist(), pa.list_(pa.float64()))
                yield pa.RecordBatch.from_arrays([*columns, out], names=[*others, "score" if scores else "features"])

    return run


def _passes(rows: DataFrame, model: Model, scores: bool) -> DataFrame:
    """``rows`` with ``score`` or ``features`` in place of ``text``, after a pass
    for each part of the model; all but the last are written."""
    spark = rows.sparkSession
    schema = ", ".join(f"`{n}` {t}" for n, t in rows.dtypes if n != "text")
    for number in range(model.parts):
        last = number + 1 == model.parts
        more = ("score double" if scores else "features array<double>") if last else "text string, words array<double>"
        sent = spark.sparkContext.broadcast(model.part(number))
        rows = rows.mapInArrow(_pass(sent, model.weights, last, scores), f"{schema}, {more}" if schema else more)
        rows = rows if last else stage(rows)
    return rows


def score(documents: DataFrame, model: Model, keep: dict[str, Column], text: str = "text") -> DataFrame:
    """The columns of ``keep`` with ``score`` (0 to 1, higher is likelier
    toxic), from the text alone. ``keep`` must not use the names ``text``, ``words``,
    ``score`` or ``features``. Null is an empty text, which has the score of
    one blank. Rows are independent, so repeated ones come back as often; equal
    texts have equal scores; a long text is worked on by itself, whole; an empty
    table gives an empty table."""
    taken = {"text", "words", "score", "features"} & set(keep)
    if taken:
        raise ValueError(f"kept columns need other names: {sorted(taken)}")
    share_code(documents.sparkSession)
    rows = documents.select(*[c.alias(n) for n, c in keep.items()], blank(F.col(f"`{text}`")).alias("text"))
    return _passes(rows, model, True)


def held_out(doc_id: Column) -> Column:
    """Rows whose labels are not learned from."""
    return F.coalesce(fold(doc_id, 5) == 0, F.lit(False))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    model = learn(documents, read_table(spark, sf_dir, "labels").select("doc_id", "toxic"))
    scored = score(documents, model, {"doc_id": F.col("doc_id"), "held_out": held_out(F.col("doc_id"))})
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


SQL = None
