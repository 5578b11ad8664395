"""A corpus pipeline over ``documents``: languages, near duplicates, benchmark
passages, source weights, token ids.

Every stage takes (spark, docs, sf_dir) and works on all rows of ``docs``; all
but the last return rows of ``docs`` with its columns. A row is told by its id
and a hash of its text, so null and repeated ids are no trouble: rows that are
equal in both are copies, of which the near-duplicate stage keeps one. Columns
beyond those of documents are carried through; an empty table stays empty.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from weblode.llm import op01_repair, op02_jaccard, op04_mixing, op05_decontaminate, op07_language
from weblode.llm.common import blank, read_table, stage

#: A document whose best language has less of the score than this says nothing
#: about its language. Equal scores of four languages give a quarter.
LEAST_SCORE = 0.3

#: Names the stages use for themselves while they work.
_KEY, _PRINT = "_pipeline_key", "_pipeline_print"


def _print(text: Column) -> Column:
    return F.xxhash64(text)


def _rows(docs: DataFrame) -> DataFrame:
    """Documents with the two columns that tell a row."""
    return docs.withColumns({_KEY: F.coalesce(F.col("doc_id").cast("string"), F.lit("")), _PRINT: _print(F.col("text"))})


def _keyed(decisions: DataFrame, *columns: str) -> DataFrame:
    return decisions.select(
        F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias(_KEY), F.col("print").alias(_PRINT), *columns)


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps documents with letters that some language claims. Texts that are
    null, empty, without a letter or equally far from all languages go."""
    known = docs.where(F.col("lang").isNotNull() & ~op07_language.held_out(F.col("doc_id")))
    filters = op07_language.learn(known)
    keep = {f"k_{i}": F.col(f"`{c}`") for i, c in enumerate(docs.columns)}
    told = op07_language.predict(docs, filters, keep)
    kept = told.where((F.col("lang_pred") != "und") & (F.col("score") >= LEAST_SCORE))
    return kept.select(*[F.col(f"k_{i}").alias(c) for i, c in enumerate(docs.columns)])


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each group: the one with the smallest id, null
    last, and then the least hash of its text. Texts without words stay."""
    groups = op02_jaccard.jaccard_groups(docs.select("doc_id", "text"))
    first = F.min(F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "print")).alias("first")
    grouped = groups.where(F.col("group").isNotNull()).groupBy("group").agg(first).select("first.doc_id", "first.print")
    alone = groups.where(F.col("group").isNull()).select("doc_id", "print").distinct()
    keep = stage(grouped.unionByName(alone))
    kept = _rows(docs).join(_keyed(keep), [_KEY, _PRINT], "left_semi")
    return kept.dropDuplicates([_KEY, _PRINT]).drop(_KEY, _PRINT)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents of which a twentieth or more is benchmark text."""
    rows = docs.withColumn("print", _print(F.col("text")))
    found = op05_decontaminate.find_contamination(
        rows.select("print", "text"), read_table(spark, sf_dir, "benchmark"), key="print")
    bad = stage(found.where("contaminated").select(F.col("print").alias(_PRINT)).distinct())
    return _rows(docs).join(bad, _PRINT, "left_anti").drop(_KEY, _PRINT)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Draws documents so that sources reach their targets: a document taken
    twice is there twice, one not taken is gone."""
    sized = stage(docs.select(
        "doc_id", "source", _print(F.col("text")).alias("print"), op04_mixing.word_count(blank(F.col("text"))).alias("size")))
    targets = stage(op04_mixing.weighted_targets(sized.groupBy("source").agg(F.sum("size").alias("source_size"))))
    mixed = op04_mixing.mix(sized.withColumn("membership", F.array("source")), targets, "membership", "size", "doc_id")
    taken = stage(_keyed(mixed.where("copies > 0").groupBy("doc_id", "print").agg(F.max("copies").alias("copies")), "copies"))
    rows = _rows(docs).join(taken, [_KEY, _PRINT])
    rows = rows.withColumn("_pipeline_copy", F.explode(F.sequence(F.lit(1), "copies")))
    return rows.select(*[F.col(f"`{c}`") for c in docs.columns])


def write_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Writes the ids of all rows as grammar shards and reads them back:
    (doc_id, start, n_tokens, ids_crc32)."""
    return op01_repair.write_and_read(spark, docs.select("doc_id", "text"), op01_repair.tokenizer_path())


STAGES = [
    ("language_id", language),
    ("ngram_jaccard_join", near_duplicates),
    ("benchmark_decontamination", decontaminate),
    ("mixing_sources", mix_sources),
    ("token_id_output", write_tokens),
]

#: Languages are learned, which SQL cannot express; tests use brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in turn, each written as Parquet and read again by the next."""
    docs = read_table(spark, sf_dir, "documents")
    for _, function in STAGES:
        docs = stage(function(spark, docs, sf_dir))
    return docs
