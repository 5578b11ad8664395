"""The queries of this folder and of the pipeline, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

import corpus_pipeline
from weblode.llm import (
    op01_repair,
    op02_jaccard,
    op03_secrets,
    op04_mixing,
    op05_decontaminate,
    op06_html,
    op07_language,
    op08_toxicity,
    op09_embeddings,
    op10_pii,
    op11_conversations,
    op12_merkle,
    op13_warc,
)

_MODULES = (
    op01_repair, op02_jaccard, op03_secrets, op04_mixing, op05_decontaminate, op06_html, op07_language,
    op08_toxicity, op09_embeddings, op10_pii, op11_conversations,
    op12_merkle, op13_warc,
)

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {m.NAME: m.query for m in _MODULES}
QUERIES["pipeline"] = corpus_pipeline.run
ORACLE: dict[str, str] = {m.NAME: m.SQL for m in _MODULES if m.SQL}
if corpus_pipeline.ORACLE_SQL:
    ORACLE["pipeline"] = corpus_pipeline.ORACLE_SQL
