"""Index and rank a crawl, then load the results."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession

from weblode.operators.index import indexed_urls, inverted_index, parsed
from weblode.operators.links import link_graph
from weblode.operators.pagerank import ITERATIONS, page_rank
from weblode.plans.store import (
    HEAVY_POSTINGS,
    changing,
    check_append,
    exists,
    indexed_websites,
    store_postings,
    store_ranks,
    stored_own_ids,
    stored_words,
    website_ids,
)
from weblode.scratch import remove, scope, stage
from weblode.sources.keyed import check_unique
from weblode.sources.publish import TableExists, as_new, publishing, settle

JOBS = ("inv-index", "page-rank")
#: Where a run keeps the steps of its ranking until all its outputs are in place.
STATE = "_ranking"
OUTPUTS = {"inv-index": ("postings", "urls"), "page-rank": ("edges", "ranks")}


class OutputExists(FileExistsError):
    """The output is there already and ``force`` was not given."""


def run(
    pages: DataFrame,
    out: str,
    iterations: int = ITERATIONS,
    skip: Iterable[str] = (),
    force: bool = False,
) -> None:
    """Write ``postings``, ``urls``, ``edges`` and ``ranks`` below ``out``.

    ``skip`` names jobs to leave out. If an output of a job to be run exists,
    nothing is run, unless ``force`` replaces it. The outputs change together when
    all are written: a run that breaks off leaves the ones before as they were, and
    the next one over the same pages goes on with the ranking where it stopped.
    Every page is read and parsed once, to a scratch table that all jobs read and
    that is deleted at the end.
    """
    skipped = set(skip)
    if skipped - set(JOBS):
        raise ValueError(f"cannot skip {sorted(skipped - set(JOBS))}")
    spark = pages.sparkSession
    jobs = [job for job in JOBS if job not in skipped]
    settle(spark, out)
    taken = [t for j in jobs for t in OUTPUTS[j] if exists(spark, f"{out}/{t}")]
    if taken and not force:
        raise OutputExists(f"{', '.join(taken)} in {out}; use force to replace")
    mode, state = "overwrite" if force else "errorifexists", f"{out}/{STATE}"
    try:
        with scope(spark), publishing(spark, out) as publication:
            pages = stage(parsed(pages))
            if "inv-index" in jobs:
                as_new(inverted_index(pages), publication, "postings", mode)
                as_new(indexed_urls(pages), publication, "urls", mode)
            if "page-rank" in jobs:
                edges = as_new(link_graph(pages), publication, "edges", mode)
                as_new(page_rank(edges, iterations, state=state), publication, "ranks", mode)
    except TableExists as e:  # another run was faster
        raise OutputExists(f"{e}; use force to replace") from e
    remove(spark, state)


def load(
    store_path: str,
    postings: DataFrame | None = None,
    ranks: DataFrame | None = None,
    urls: DataFrame | None = None,
    mode: str = "errorifexists",
    check_keys: bool = False,
    heavy_postings: int = HEAVY_POSTINGS,
) -> None:
    """Load ``postings(word, url, count)``, ``ranks(url, rank)`` or both into
    store tables. Ranks go to the websites of the stored index.

    ``urls`` are the distinct URLs of the postings, if at hand. Mode
    ``append`` adds to a store: known websites keep their ids, and a posting or
    rank that is stored already is an error. ``check_keys`` makes it an error
    too if the input holds one twice; what ``run`` writes never does. All
    tables change together when everything is written and checked; a load that
    breaks off changes nothing and can be repeated. Words with more than
    ``heavy_postings`` pages get their best pages stored in order.
    """
    given = postings if postings is not None else ranks
    if given is None:
        return
    spark, inv_index, websites = given.sparkSession, None, None
    append = mode == "append"
    with changing(spark, store_path, mode, heavy_postings) as changes:
        known = stored_own_ids(spark, store_path) if append else None
        if postings is not None:
            websites = website_ids(indexed_websites(postings) if urls is None else urls, known)
            inv_index = store_postings(postings, known)
        if inv_index is not None:
            if check_keys:
                check_unique(inv_index, ["word", "website_id"])
            if append:
                check_append(spark, store_path, inv_index=inv_index)
            # where no other ids are known, the writer computes them
            changes.put_index(websites, inv_index if known is not None else stored_words(postings).select("word", "url", "count"))
        if ranks is not None:
            # ranks go to websites that are stored or come along
            if append:
                page_rank_rows = changes.ranks_of_known(ranks, known)
            else:
                page_rank_rows = store_ranks(ranks, changes.table("websites").select("website_id", "url"))
            if check_keys:
                check_unique(page_rank_rows, ["website_id"])
            if append:
                check_append(spark, store_path, page_rank=page_rank_rows)
            changes.put_ranks(page_rank_rows)
            if postings is not None and known is None and not append:
                changes.from_urls(stored_words(postings).select("word", "url", "count"), ranks)


def load_run(
    spark: SparkSession,
    source: str,
    store_path: str,
    jobs: Iterable[str] = JOBS,
    mode: str = "errorifexists",
    heavy_postings: int = HEAVY_POSTINGS,
) -> None:
    """Load what ``run`` wrote below ``source``."""

    settle(spark, source)

    def table(name: str, job: str) -> DataFrame | None:
        return spark.read.parquet(f"{source}/{name}") if job in jobs else None

    postings, urls = table("postings", "inv-index"), table("urls", "inv-index")
    load(store_path, postings, table("ranks", "page-rank"), urls, mode, heavy_postings=heavy_postings)
